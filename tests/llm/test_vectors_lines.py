"""Whitening, line deduplication and clustering against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from docweave.llm import lines, queries, whitening
from docweave.llm.centroids import cluster, nearest
from docweave.llm.exact import parts
from docweave.llm.lines import drop_lines, line_bitmaps, line_digests
from docweave.llm.whitening import components, whiten

VEC = "vec_id long, embedding array<double>, label int, cluster string, x string"
DOC = "doc_id long, text string, lang string, t string, keep string"


# --- lines -------------------------------------------------------------------------


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))


def brute_lines(docs, least_chars=40, least_docs=5):
    split = [(d, (t or "").split("\n")) for d, t in docs]
    held = defaultdict(set)
    for d, ls in split:
        for line in ls:
            held[key_of(line)].add(d)
    rank = lambda d: -math.inf if d is None else d
    often = {k: max(v, key=rank) for k, v in held.items() if len(k) >= least_chars and len(v) >= least_docs}
    out = []
    for d, ls in split:
        keep = [x for x in ls if key_of(x) not in often or often[key_of(x)] == d]
        out.append((d, len(ls), len(ls) - len(keep), "\n".join(keep)))
    return out


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def some_documents(n=300, seed=5):
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcdefgh ÄÖéx", k=rng.choice([20, 39, 40, 41, 80]))) for _ in range(40)]
    docs = []
    for i in range(n):
        ls = ["The very common Line that a third of the documents have"] if i % 3 == 0 else []
        for _ in range(rng.choice([0, 1, 4, 9, 150])):
            line = rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choices("abcdefgh ", k=50))
            ls.append(rng.choice(["", " ", "\t\x0b", "\r"]) + (line.upper() if rng.random() < 0.2 else line) + rng.choice(["", "  ", "\r"]))
        docs.append((rng.choice([i, i, i, i // 2, None]), "\n".join(ls)))
    return docs + [(7, None), (8, ""), (9, "\n"), (9, "\n\n" + pool[0])] + docs[:5]


@pytest.mark.parametrize(("look", "parts"), [(10**9, lines.PARTS), (1, 100)])
def test_lines_are_brute_force(spark, monkeypatch, look, parts):
    monkeypatch.setattr(lines, "LOOK", look)  # with 1, frequent lines are told from all rows; with many, none is
    monkeypatch.setattr(lines, "PARTS", parts)
    docs = some_documents()
    df = spark.createDataFrame([(d, t, "en", "x", "y") for d, t in docs], DOC)
    want = brute_lines(docs)
    got = Counter(map(tuple, line_digests(df).collect()))
    assert got == Counter((d, n, k, digest(t)) for d, n, k, t in want)
    assert sum(k for _, _, k, _ in want) > 200
    kept = drop_lines(df)
    assert kept.columns == df.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter(t for *_, t in want)
    found = lines.frequent(lines.long_lines(df.selectExpr("doc_id", "xxhash64(text) t", "text"), 40)).count()
    assert (found > 0) == (look == 1)


def test_line_bitmaps_are_small(spark):
    same = "this line is in all of the documents, again and again"
    docs = [(i, "\n".join([f"own line {i} {j} " + "x" * 40 for j in range(1000)] + [same] * 3)) for i in range(6)]
    rows = line_bitmaps(spark.createDataFrame([(d, t, "en", "x", "y") for d, t in docs], DOC)).collect()
    assert sorted(r.n_dropped for r in rows) == [0, 3, 3, 3, 3, 3] and all(r.n_lines == 1003 for r in rows)
    for r in rows:
        assert r.keep is None if r.doc_id == 5 else [(w.word, w.bits) for w in r.keep] == [(15, ~(7 << 40))]


def test_line_edges(spark):
    df = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, None)], DOC)
    assert sorted(map(tuple, line_digests(df).collect()), key=str) == sorted([(None, 1, 0, digest("")), (1, 1, 0, digest(""))], key=str)
    assert line_digests(df.limit(0)).count() == 0 and drop_lines(df.limit(0)).columns == df.columns
    assert drop_lines(df).where("text is null").count() == 1
    long = "\n".join(["y" * 60] * 100_000 + ["z" * 3_000_000])
    rows = [(i, long, None, None, None) for i in range(5)]
    assert sorted(r.n_dropped for r in line_bitmaps(spark.createDataFrame(rows, DOC)).collect()) == [0] + [100_001] * 4


def test_lines_stream_without_another_shuffle(spark, tmp_path):
    docs = spark.createDataFrame([(d, t, "en", "x", "y") for d, t in some_documents(50)], DOC)
    rows = lines.materialise(lines.long_lines(docs.selectExpr("doc_id", "xxhash64(text) t", "text"), 40))
    plan = lines.repeats(rows, 5)._jdf.queryExecution().executedPlan().toString()
    cold = plan[: plan.index("rangepartitioning")]
    assert "hashpartitioning" not in cold and "Python" not in plan and "Arrow" not in plan


# --- centroids ---------------------------------------------------------------------


def brute_clusters(rows, k=16, rounds=3, size=64):
    kept = [(i, [math.floor(64 * Fraction(v)) for v in e]) for i, e in rows if e is not None and len(e) == size and all(v is not None and math.isfinite(v) for v in e)]
    name = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest())
    cents = [x for _, x in sorted(kept, key=name)[:k]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    pick = lambda x: min((far(x, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        got = [pick(x)[1] for _, x in kept]
        for j in range(len(cents)):
            mine = [x for (_, x), g in zip(kept, got, strict=True) if g == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    out = [(i, *pick(x)) for i, x in kept]
    each = Counter()
    for _, d, j in out:
        each[j] += d
    fits = lambda v: v if v < 1 << 63 else None
    return [(i, j, fits(d), fits(each[j]), fits(sum(each.values())), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, d, j in out]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_clusters_are_brute_force(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 0.2, (150, 64)), rng.normal(0.5, 0.05, (60, 64)), np.round(rng.normal(0, 0.02, (60, 64)) * 64) / 64])
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    rows += [(900 + i, rows[3][1]) for i in range(40)]  # equal vectors, also among centroids
    rows += [(1000, None), (1001, []), (1002, [1.0] * 63), (1003, [None] * 64), (1004, [float("nan")] * 64), (1005, [float("inf")] * 64), (5, rows[5][1]), (None, rows[6][1])]
    df = spark.createDataFrame([(i, v, 1, "c", "x") for i, v in rows], VEC)
    assert ordered(cluster(df).collect()) == ordered(brute_clusters(rows))
    few = rows[:5] + [(77, rows[0][1])]
    df = spark.createDataFrame([(i, v, 1, "c", "x") for i, v in few], VEC)
    assert ordered(cluster(df).collect()) == ordered(brute_clusters(few))
    assert cluster(df.limit(0)).count() == 0 and cluster(df.limit(0)).columns == cluster(df).columns


def test_clusters_of_huge_values(spark):
    rows = [(i, [float(v) * 10.0**e for v in range(64)]) for i, e in enumerate([0, 3, 6, 9, 17, 18, 30, 300, 0, 3])]
    df = spark.createDataFrame([(i, v, 1, "c", "x") for i, v in rows], VEC)
    assert ordered(cluster(df, k=3).collect()) == ordered(brute_clusters(rows, k=3))


def test_partial_distances_equal_whole_ones():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x, c = rng.integers(-3, 3, (300, 20)), rng.integers(-3, 3, (9, 20))
        far = ((x[:, None] - c[None]) ** 2).sum(2)
        label, best = nearest(x, c, rng.permutation(20), step=3)
        assert (label == far.argmin(1)).all() and (best == far.min(1)).all()


def test_parts_of_sums():
    for v in (0, 5, -5, 1 << 40, -(1 << 40), (1 << 39) - 1, 10**60, -(10**60), -1):
        assert sum(p << (32 * k) for k, p in parts(v)) == v and all(abs(p) <= 1 << 40 for _, p in parts(v))


# --- whitening ---------------------------------------------------------------------


def check_whitening(got, rows, k=16):
    kept = [(i, e) for i, e in rows if e and all(v is not None and math.isfinite(v) for v in e)]
    x = [(i, [math.floor(64 * v) + 1_000_000 for v in e]) for i, e in kept]
    fit = sorted({tuple(v) for _, v in x})
    n, size = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit, strict=True)]
    mid = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(row, sums, strict=True)] for row in fit])
    cov = mid.T @ mid / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, size)
    by = defaultdict(list)
    for r in got:
        by[r.vec_id].append(r)
        assert r.n == n and r.identity_error <= 1e-9
        assert abs(r.explained - values[r.component - 1] / np.trace(cov)) <= 1e-9 * r.explained + 1e-15
    assert len(got) == k * len(kept)
    sign = {}
    for i, v in x:
        own = [r for r in by[i] if r.deviation == sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))]
        assert own and {r.component for r in own} == set(range(1, k + 1))
        z = np.array([float(Fraction(n * a - s, n)) for a, s in zip(v, sums, strict=True)])
        for r in own:
            if values[r.component - 1] <= 1e-9 * values[0]:
                assert r.whitened is None
                continue
            want = z @ vectors[:, r.component - 1] / np.sqrt(values[r.component - 1])
            s = sign.setdefault(r.component, 1 if (want > 0) == (r.whitened > 0) else -1)
            assert abs(r.whitened - s * want) < 1e-7 * max(1, abs(want)) or abs(want) < 1e-6
    return mid


@pytest.mark.parametrize("low", [False, True])
def test_whitening(spark, low):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (200, 40)) * np.linspace(1, 3, 40)
    if low:  # few directions hold all variance, so that no pass over all dimensions is needed
        x = np.round(rng.normal(0, 1, (200, 5)) * 64) / 64 @ np.eye(5, 40)
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)] + [(i, x[3].tolist()) for i in range(500, 540)]
    bad = [(1000, None), (1001, []), (1003, [None] * 40), (1004, [float("nan")] * 40), (1005, [float("-inf")] * 40)]
    df = spark.createDataFrame([(i, v, 1, "c", "x") for i, v in rows + bad], VEC)
    check_whitening(whiten(df).collect(), rows)
    asked = []
    apply = lambda q: asked.append(q.shape[1]) or np.cov(x.T, bias=True) @ q
    components(apply, 40, 16)
    assert (40 in asked) != low


def test_whitening_edges(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 1, "c", "x"), (2, [1.0, 2.0], 1, "c", "x"), (3, [5.0], 1, "c", "x"), (4, [7.0], 1, "c", "x"), (5, [1e300], 1, "c", "x")], VEC)
    got = whiten(df).collect()
    of = lambda i: [r for r in got if r.vec_id == i]
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in of(1)] == [(1, 0, None, None, 0.0)] * 2
    assert len(of(2)) == 2 and len(of(3)) == 1 and of(3)[0].n == 3 and of(5)[0].deviation is None and of(5)[0].explained == pytest.approx(1)
    assert whiten(df.limit(0)).count() == 0 and whiten(df.limit(0)).columns == whiten(df).columns
    two = whiten(df.where("vec_id in (3, 4)")).collect()
    assert sorted(abs(r.whitened) for r in two) == pytest.approx([1, 1]) and [r.deviation for r in two] == [128**2, 128**2]


def test_deviations_are_exact_or_null():
    t = np.array([[1 << 30, 5], [1 << 31, (1 << 31) - 1], [(1 << 31) + 7, 1 << 31], [1 << 60, 0]], object)
    want = [sum(int(v) ** 2 for v in row) for row in t]
    assert whitening.deviations(t) == [w if w < 1 << 63 else None for w in want]


def test_whitening_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check_whitening(queries.op11_whitening(spark, sf_dir).collect(), rows)
