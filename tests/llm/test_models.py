"""Language profiles, toxicity, token counts, embeddings and URL filters."""

import math
import random
import re
import struct
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from docweave.llm import langid, pivots, queries, tokens, toxicity, urls
from docweave.llm.pivots import near_vectors

DOC = "doc_id long, text string, lang string, source string, n_chars long, score string"


def test_language_accuracy(spark, sf_dir):
    got = queries.op2_language(spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(docs)
    held = [r for r in got if r.held_out and docs[r.doc_id].lang]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 for r in got)


def brute_language(text, tops, most):
    words = ["_" + w + "_" for w in re.findall(r"[^\W\d_]+", text.lower())]
    n = Counter(w[i : i + k] for w in words for k in (1, 2, 3) for i in range(len(w) - k + 1) if w[i : i + k] != "_")
    code = lambda g: int(langid_code(g))
    ranked = sorted(n, key=lambda g: (-n[g], code(g)))[:most]
    far = {x: sum(abs(place[code(g)] - k) if code(g) in place else most for k, g in enumerate(ranked)) for x, top in tops.items() for place in [{int(c): r for r, c in enumerate(top)}]}
    return min(sorted(far), key=far.get)


def langid_code(g):
    v = [0 if c == "_" else ord(c) for c in g]
    return v[0] | 3 << 62 if len(v) == 1 else v[0] << 21 | v[1] | 1 << 63 if len(v) == 2 else v[0] << 42 | v[1] << 21 | v[2]


def test_language_is_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    profiles = langid.fit(rows, most=100)
    tops = dict(zip(profiles.languages, profiles.tops, strict=True))
    for r in rows.limit(40).collect():
        text = re.sub(r"[^\w]|\d|_", " ", r.text)
        assert profiles.predict(text, profiles.lookup())[0] == brute_language(text, tops, 100)


def test_profiles_and_scores_are_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    some = [r for r in rows.collect() if r.lang][:60]
    profiles = langid.fit(spark.createDataFrame(some, "doc_id long, text string, lang string"), most=50)
    counts = defaultdict(Counter)
    for r in some:
        for w in re.findall(r"[^\W\d_]+", r.text.lower()):
            w = f"_{w}_"
            counts[r.lang].update(langid_code(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1) if w[i : i + k] != "_")
    signed = lambda c: c - (1 << 64) if c >> 63 else c
    assert profiles.languages == tuple(sorted(counts))
    for x, top in zip(profiles.languages, profiles.tops, strict=True):
        assert [int(c) for c in top] == sorted(counts[x], key=lambda c: (-counts[x][c], signed(c)))[:50]
    for r in some[:20]:
        top = [int(c) for c in langid.ranked(langid.grams(r.text), 50)]
        far = sorted(sum(abs(p[c] - k) if c in p else 50 for k, c in enumerate(top)) for t in profiles.tops for p in [{int(c): k for k, c in enumerate(t)}])
        assert profiles.predict(r.text, profiles.lookup())[1] == pytest.approx(1 - far[0] / far[1])


def test_language_edges(spark):
    rows = [(1, "the cat is here", "en", None, 0, "x"), (2, "der Hund ist da", "de", None, 0, "x"), (3, None, "en", None, 0, "x"), (None, "", None, None, 0, "x"), (4, "12 !?", None, None, 0, "x"), (4, "12 !?", None, None, 0, "x"), (5, "the " * 50_000, None, None, 0, "x")]
    df = spark.createDataFrame(rows, DOC)
    profiles = langid.fit(df)
    got = Counter((r.doc_id, r.lang_pred) for r in langid.identify(df, profiles).collect())
    assert got == Counter([(1, "en"), (2, "de"), (3, "und"), (None, "und"), (4, "und"), (4, "und"), (5, "en")])
    none = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}
    assert langid.identify(df.limit(0), profiles).count() == 0


def brute_links(rows, least=0.93):
    x = []
    for _, v, label in rows:
        ok = label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
        u = np.array(v, np.float64) if ok else None
        x.append(u / np.sqrt((u * u).sum()) if ok else None)
    links, group = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= least:
                links[i] += 1
                links[j] += 1
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least_id = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least_id[group[i]] = min(least_id.get(group[i], r[0]), r[0])
    return [(r[0], n, least_id.get(g)) for r, n, g in zip(rows, links, group, strict=True)]


def test_embeddings(spark, sf_dir):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(60):
        v = rng.standard_normal(16)
        label = int(k % 3)
        for _ in range(int(rng.integers(1, 12))):
            w = v + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.25])
            rows.append((len(rows), [float(np.float32(c)) for c in w], label))
    rows += [(900, [0.0] * 16, 1), (901, None, 1), (902, [float("nan")] * 16, 1), (903, [1.0, None], 1), (904, [], 1), (905, rows[0][1], None), (906, [float("inf")] * 16, 1), (907, rows[0][1][:8], 0), (908, [float(np.float32(3e38))] * 16, 0), (0, rows[0][1], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, n_links string")
    want = brute_links(rows)
    for block in (4_096, 7):
        got = near_vectors(df, block=block).collect()
        assert len(got) == len(rows)
        a, b = (Counter(x) for x in (want, [(r.vec_id, r.n_links, r.component_id) for r in got]))
        assert sum((a & b).values()) >= 0.97 * len(rows)
        assert sum(r.n_links for r in got) <= sum(n for _, n, _ in want)
        assert sum(r.n_links for r in got) >= 0.97 * sum(n for _, n, _ in want)
        assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert near_vectors(df.limit(0)).count() == 0
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in queries.op3_embeddings(spark, sf_dir).collect()) == sorted(brute_links(rows))


def test_embeddings_of_many_sizes(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for dim in (1, 2, 3, 4, 5, 7, 9):
        base = rng.normal(size=(6, dim))
        for k in range(24):
            rows.append((len(rows), (base[k % 6] + rng.normal(size=dim) * 0.05 * (k // 6)).tolist(), k % 2))
    monkeypatch.setattr(pivots, "OWN_SIZES", 2)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors(df, shared=1).collect())
    assert got == sorted(brute_links(rows))


def kernel(s, t):
    """All pairs of equal subsequences, straight from the definition."""
    from itertools import combinations

    def subs(w):
        out = defaultdict(float)
        for c in combinations(range(len(w)), toxicity.LENGTH):
            gaps = c[-1] - c[0] - toxicity.LENGTH + 1
            if gaps <= toxicity.GAPS and (w[c[-1]] or w[c[-2]]):
                out[tuple(w[i] for i in c)] += toxicity.DECAY**gaps
        return out

    a, b = subs(s), subs(t)
    return sum(v * b[u] for u, v in a.items() if u in b)


def test_string_kernel():
    rng = np.random.default_rng(2)
    w = rng.integers(0, 5, (6, toxicity.WINDOW)).astype(np.uint8)
    codes, weights = toxicity._features(w)
    got = toxicity._kernels(codes, weights, codes)
    assert np.allclose(got, [[kernel(a.tolist(), b.tolist()) for b in w] for a in w], rtol=1e-4)


def sentences(n, seed):
    rng = random.Random(seed)
    syllables = ["ba", "lo", "ti", "ren", "so", "ma", "di", "vek"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 3)))
    texts, labels = [], []
    for k in range(n):
        w = [word() for _ in range(rng.randint(5, 40))]
        if k % 4 == 0:
            w[rng.randrange(len(w))] = rng.choice(["grumpfjack", "zwixnut", "hoggle"])
        texts.append(" ".join(w))
        labels.append(int(k % 4 == 0))
    return texts, labels


def test_toxicity_learns_and_tolerates():
    machine = toxicity.train(*sentences(600, 1))
    texts, labels = sentences(400, 2)
    s = machine.score(machine.best(*toxicity._rows(texts)))
    y = np.array(labels) > 0
    assert ((s >= 0.7) == y).mean() > 0.97
    odd = machine.score(machine.best(*toxicity._rows(["ba lo z.w.i.x.n.u.t so", "ma grumqpfjack di", "HOGGLE"])))
    plain = machine.score(machine.best(*toxicity._rows(["ba lo ren so", "madi vek"])))
    assert odd.min() > plain.max()


def test_toxicity_inside_long_runs():
    machine = toxicity.train(*sentences(600, 1))
    insults, around = ["grumpfjack", "zwixnut", "hoggle"], ["tirensomabalo", "madivekbaloren"]
    score = lambda texts: machine.score(machine.best(*toxicity._rows(texts)))
    embedded = score([f"ba {a}{x}{b} so" for x in insults for a in around for b in ("", "di", "lotibaso")])
    plain = score([f"ba {a}{b} so" for a in around for b in ("", "di", "lotibaso")])
    assert (embedded >= 0.7).mean() > 0.8 and plain.max() < 0.7
    gapped = score([f"{a} {'.'.join(x)} {b}" for x in insults for a in ("ba", "lo") for b in ("ren", "so")])
    assert (gapped >= 0.7).mean() > 0.9
    s, _ = toxicity._rows(["x abcdefghijkl yz"])
    starts = toxicity._starts(s)
    assert starts.tolist() == [0, 2, 3, 4, 5, 6, 15]


def test_toxicity_edges(spark):
    texts, labels = sentences(200, 3)
    docs = [(i, t, None, None, 0, "x") for i, t in enumerate(texts)] + [(None, "hoggle", None, None, 0, "x"), (1000, None, None, None, 0, "x"), (1001, "", None, None, 0, "x"), (1002, "ba " * 60_000 + "hoggle", None, None, 0, "x")]
    df = spark.createDataFrame(docs, DOC)
    known = spark.createDataFrame([(i, x, "x") for i, x in enumerate(labels)] + [(None, 1, "x"), (5, None, "x")], "doc_id long, toxic int, text string")
    machine = toxicity.fit(df, known)
    got = {r.doc_id: r.score for r in toxicity.score(df, machine).collect()}
    assert got[1002] >= 0.7 and got[None] >= 0.7 and got[1000] == got[1001] < 0.5
    assert toxicity.score(df.limit(0), machine).count() == 0
    for one in (known.limit(0), known.where("toxic = 0"), known.where("toxic = 1")):
        s = [r.score for r in toxicity.score(df, toxicity.fit(df, one)).collect()]
        assert all(0 <= x <= 1 for x in s)
    short = toxicity.encode(np.array([0, 0, 2, 2]), np.frombuffer(b"ab", np.uint8))
    assert np.diff(short[1]).tolist() == [toxicity.WINDOW + n for n in (1, 4, 1)]


def test_toxicity_query(spark, sf_dir):
    got = queries.op8_toxicity(spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in got)


def test_token_histogram(spark, sf_dir):
    with open(tokens.VOCABULARY, "rb") as f:
        e = tokens.encoder(f.read(), tokens.PATTERN)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sizes = [len(e.encode_ordinary(t or "")) for t in texts]
    h = queries.op9_token_counts(spark, sf_dir)
    rows = {r.n_tokens: r for r in h.collect()}
    assert {k: r.n_docs for k, r in rows.items()} == Counter(sizes)
    for k, r in rows.items():
        assert r.docs_at_least == sum(s >= k for s in sizes) and r.tokens_at_least == sum(s for s in sizes if s >= k)
        assert r.tokens_truncated == sum(min(s, k) for s in sizes) and r.rank == sum(s <= k for s in sizes)
    a = tokens.Lengths(h)
    for limit in (0, 1, 100, 500, 10**7):
        assert a.truncated(limit) == sum(min(s, limit) for s in sizes)
    for q in (0.0, 0.1, 0.5, 0.99, 1.0):
        assert a.quantile(q) == sorted(sizes)[max(1, math.ceil(q * len(sizes))) - 1]


def test_token_edges(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "", "x"), (3, "a" * 100_000, "x"), (None, "<|endoftext|> é\U0001f600", "x")], "doc_id long, text string, n_tokens string")
    got = sorted((r.doc_id or 0, r.n_tokens) for r in tokens.token_counts(df).collect())
    assert got[1][1] == got[2][1] == 0 and got[3] == (2, 0) and got[4][1] > 1_000 and got[0][1] > 3
    h = tokens.length_histogram(tokens.token_counts(df.limit(0)))
    assert h.count() == 0 and tokens.Lengths(h).total() == 0 and tokens.Lengths(h).quantile(0.5) is None


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1])
    fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and m[2].startswith(p)]
    return host, m[2], max(fits)[1:] if fits else None


def brute_ratios(known, wanted, order):
    out = {}
    tables = {v: [defaultdict(Counter) for _ in range(order + 1)] for v in ("allow", "block")}
    for verdict, gram, n in known:
        for k in range(order + 1):
            tables[verdict][k][gram[order - k : order]][gram[-1]] += n
    for gram in wanted:
        p = {}
        for v, t in tables.items():
            p[v] = urls.UNSEEN
            for k in range(order + 1):
                seen = t[k].get(gram[order - k : order])
                if seen:
                    p[v] = (seen[gram[-1]] + len(seen) * p[v]) / (sum(seen.values()) + len(seen))
        out[gram] = math.log(p["allow"]) - math.log(p["block"])
    return out


def test_url_model(spark):
    rng = random.Random(8)
    known = [(rng.choice(["allow", "block"]), "".join(rng.choices("abc", k=4)), rng.randint(1, 5)) for _ in range(60)]
    wanted = {g for _, g, _ in known} | {"zzzz", "aazb", "abcz"}
    got = urls.log_ratios(spark.createDataFrame(known, "verdict string, gram string, n long"), spark.createDataFrame([(g,) for g in wanted], "gram string"), 3).collect()
    want = brute_ratios(known, wanted, 3)
    assert len(got) == len(want) and all(abs(r.ratio - want[r.gram]) < 1e-9 for r in got)


def test_urls(spark, sf_dir):
    some = ["http://A.Example.NET/en/x?y#z", "https://net", "https://net/", "https://xnet/", "https://a.org/fr/1", "http://org/fr", "x://example.com/de/", "x://y.example.com:80/de/", None, "", "no scheme", "http://", "http://?q", "http://é.org/fr/", "a://b://c/", None, "http://b.example.net/EN/"]
    pages = [(i if i % 5 else None, u, "h", "clash") for i, u in enumerate(some)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host string").select("page_id", "url", "html", "host")
    df = df.unionByName(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), allowMissingColumns=True)
    got = urls.judge(df).collect()
    assert len(got) == df.count()
    for r in got:
        host, path, rule = brute_url(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule[0] if rule else None), r
        assert r.verdict == rule[1] if rule else r.verdict in ("allow", "block")
    assert urls.judge(df.limit(0)).count() == 0
    alone = urls.judge(df.where("url like '%.com%'"), rules=()).collect()
    assert {r.rule for r in alone} <= {None}


@pytest.mark.parametrize("allow,block,want", [([2, 3], [-2, -1], (-1, 2)), ([], [1], (0, 0))])
def test_threshold(spark, allow, block, want):
    rows = [("allow", float(x)) for x in allow] + [("block", float(x)) for x in block]
    edge = urls._threshold(spark.createDataFrame(rows, "verdict string, ratio double"))
    assert want[0] <= edge <= want[1]


def test_url_verdicts_are_brute_force(spark, sf_dir):
    some = [(i, u) for i, u in enumerate([None, "", "no scheme", "http://q.com/?bad=1", "http://q.com/?bad=1", "http://q.com/#é\U0001f600", "https://net/a?b", "https://a.org/fr/1"])]
    df = spark.createDataFrame(some, "page_id long, url string").unionByName(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))
    got, order = urls.judge(df).collect(), urls.ORDER
    times, said = Counter(r.url or "" for r in got), {}
    for r in got:
        _, _, rule = brute_url(r.url)
        said[r.url or ""] = rule[1] if rule else None
    held = {u: struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(u.encode(), 42)))[0] % 5 == 0 for u in times}
    grams = {u: [t[i : i + order + 1] for t in ["\u0002" * order + u + "\u0003"] for i in range(len(u) + 1)] for u in times}
    known = [(said[u], g, times[u]) for u in times if said[u] and not held[u] for g in grams[u]]
    ratios = brute_ratios(known, {g for u in times for g in grams[u]}, order)
    mean = {u: sum(ratios[g] for g in grams[u]) / len(grams[u]) for u in times}
    scored = [(said[u], mean[u], times[u]) for u in times if said[u] and held[u]]
    edge = urls._threshold(spark.createDataFrame(scored, "verdict string, ratio double, n long"))
    unruled = [r for r in got if r.rule is None]
    assert len(unruled) > 20 and len({r.verdict for r in unruled}) == 2
    for r in unruled:
        assert abs(r.ratio - mean[r.url or ""]) < 1e-9
        assert abs(r.ratio - edge) < 1e-9 or r.verdict == ("allow" if r.ratio >= edge else "block")


def test_rare_url_grams_and_many_rules(spark, sf_dir, monkeypatch):
    df = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rows = lambda: sorted((r.page_id, r.url, r.rule, r.verdict, round(r.ratio or 0, 9)) for r in urls.judge(df).collect())
    want = rows()
    monkeypatch.setattr(urls, "BROADCAST_ROWS", 50)
    monkeypatch.setattr(urls, "EXPRESSION_RULES", 0)
    monkeypatch.setattr(urls, "SHORT", 20)
    assert rows() == want


def test_url_plan_is_linear(spark, sf_dir, monkeypatch):
    exchanges = []

    def written(df, f=urls.materialise):
        exchanges.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return f(df)

    monkeypatch.setattr(urls, "materialise", written)
    for order in (2, 4):
        exchanges.clear()
        urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), order=order)
        if order == 2:
            two = sum(exchanges)
    assert sum(exchanges) <= 40 and max(exchanges) <= 5 and sum(exchanges) - two <= 12


def test_toxicity_tolerates_words_never_distorted(monkeypatch):
    monkeypatch.setattr(toxicity, "_loosened", lambda w, rng: np.repeat(w, 3, axis=0))  # training sees the words as they are
    machine = toxicity.train(*sentences(600, 1))
    score = lambda texts: machine.score(machine.best(*toxicity._rows(texts)))
    for x in ("grumpfjack", "zwixnut", "hoggle"):
        forms = [" ".join(x), ".".join(x), *(x[:k] + c + x[k:] for k in range(1, len(x)) for c in "zq")]
        assert (score([f"ba lo {f} so ti" for f in forms]) >= 0.7).mean() > 0.8
    assert score(["ba lo ren so", "madi vek", "tirensomabalo so"]).max() < 0.3


def test_toxicity_of_long_texts_in_parts():
    rng = np.random.default_rng(3)
    table = rng.normal(0, 0.4, toxicity.SYMBOLS**toxicity.LENGTH).astype(np.float32)
    machine = toxicity.Machine(table, -0.5, (1.0, 1.0), 0.0, (1.0, 1.0))
    pieces = ["a", "b", "Z", " ", "  ", ".", "é", "É", "ж", "3", "a b c d e ", "abcdefghij ", "abcdefghijklmnop", "漢", "🙂", "\n", " abcdefghi "]
    for _ in range(400):
        raw = np.frombuffer("".join(rng.choice(pieces, rng.integers(0, 60))).encode(), np.uint8)
        size, at = int(rng.integers(4, 40)), np.array([0, len(raw)])
        s, _ = toxicity.encode(at, raw)
        assert np.array_equal(toxicity.encode_long(raw, size), s)
        lead = np.zeros(len(s), bool)
        lead[toxicity._starts(s)] = True
        lead[0] = True
        assert np.array_equal(np.concatenate([toxicity._leads(s, lo, min(lo + size, len(s))) for lo in range(0, len(s), size)]), lead)
        np.testing.assert_allclose(machine.scores(at, raw, size), machine.score(machine.best(*toxicity.encode(at, raw))), atol=1e-9)


@pytest.mark.parametrize("text", ["some words, of 4 letters. ", "x", "a b c d e f "])
def test_toxicity_memory_of_a_long_text(text):
    table = np.zeros(toxicity.SYMBOLS**toxicity.LENGTH, np.float32)
    machine = toxicity.Machine(table, -0.5, (1.0, 1.0), 0.0, (1.0, 1.0))
    raw = np.frombuffer((text * (16_000_000 // len(text))).encode(), np.uint8)
    tracemalloc.start()
    machine.scores(np.array([0, len(raw)]), raw)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < {"a": 30, "x": 6, "s": 10}[text[0]] * len(raw)


def test_toxicity_score_is_brute_force():
    """Evidence of whole texts from its definition, window by window."""
    machine = toxicity.train(*sentences(300, 3))
    rng = random.Random(4)
    texts = ["", "é", *("".join(rng.choices("grumpfjack zwixnut.hoggle  12", k=rng.randint(1, 60))) for _ in range(60))]
    s, at = toxicity._rows(texts)
    got = machine.best(s, at)

    def decision(w):
        total = machine.bias
        for o, weight in toxicity.OFFSETS:
            for p in range(toxicity.WINDOW - o[-1]):
                code = 0
                for x in (0, *o):
                    code = code * toxicity.SYMBOLS + int(w[p + x])
                total += weight * machine.table[code]
        return total

    for k in range(len(texts)):
        row = s[at[k] : at[k + 1]].tolist()
        runs = "".join(chr(65 + x) if x else " " for x in row).rstrip()
        starts, place = {0}, 0
        for run in runs.split(" "):
            if run:  # the gap before it, then letters until a window reaches the end of a long run
                starts |= {place - 1, *(place + i for i in range(len(run) - toxicity.WINDOW + 2) if len(run) > toxicity.WINDOW)} if len(run) > toxicity.WINDOW - 1 else {place - 1}
            place += len(run) + 1
        windows = [row[i : i + toxicity.WINDOW] + [0] * toxicity.WINDOW for i in sorted(starts) if i >= 0]
        values = [decision(w) for w in windows]
        words, now = [], []
        for run in [*runs.split(" "), "xx"]:
            if len(run) == 1:
                now.append(ord(run) - 65)
            elif run:
                words += [now] if len(now) >= toxicity.LENGTH else []
                now = []
        spelled = []
        for word in words:
            padded = [0, *word] + [0] * 2 * toxicity.WINDOW
            spelled.append(max(decision(padded[i : i + toxicity.WINDOW]) for i in range(len(word) + toxicity.WINDOW + 1)))
        assert abs(got[k][0] - np.clip(max(values + spelled), -3, 3)) < 1e-3, texts[k]


def test_very_long_texts(spark):
    """A text of megabytes among short ones: mixing counts all of it, and toxicity finds what stands anywhere in it."""
    from docweave.llm.mixing import mix

    machine = toxicity.train(*sentences(600, 1))
    calm = "ba lo ren so madi vek " * 60_000
    rows = [(1, calm, "a"), (2, "ba lo ren so", "a"), (3, None, "b"), (4, "x" * 2_000_000, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.score for r in toxicity.score(df, machine).collect()}
    assert len(got) == 4 and all(0 <= s < 0.7 for s in got.values())
    sizes = {r.doc_id: r["size"] for r in mix(df).collect()}
    assert sizes == {1: 360_000, 2: 4, 3: 0, 4: 1}


def test_vectors_of_rare_sizes_with_the_query_parameters(spark, monkeypatch):
    """Sizes that share an index lose no link among near copies at the query's own parameters."""
    monkeypatch.setattr(pivots, "OWN_SIZES", 1)
    rng = np.random.default_rng(8)
    rows, i = [], 0
    for size in (64, 64, 33, 40, 48, 63):
        for base in rng.normal(size=(12, size)):
            for _ in range(4):
                rows.append((i, (base + rng.normal(scale=0.05, size=size)).tolist(), 1))
                i += 1
    x = {r[0]: np.array(r[1]) / np.linalg.norm(r[1]) for r in rows}
    want = {a: sum(len(x[a]) == len(x[b]) and a != b and x[a] @ x[b] >= 0.93 for b in x) for a in x}
    got = {r.vec_id: r.n_links for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert sum(want.values()) > 800 and all(got[a] <= want[a] for a in want)
    assert sum(got.values()) >= 0.98 * sum(want.values())
