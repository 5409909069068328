"""Stages of the pipeline against brute force, and the pipeline as a whole."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
from docweave.llm import simhash, stages, toxicity
from test_mix_decon_simhash import brute_contamination
from test_secrets import brute as brute_secrets

DOC = "doc_id long, text string, lang string, source string, n_chars long, size string"


def load(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def test_one_of_each(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    rows = docs.collect()
    groups = jaccard_groups([r.text for r in rows])
    want = {}
    for r, g in zip(rows, groups, strict=True):
        want[g] = min(want.get(g, r.doc_id), r.doc_id)
    got = stages.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(want.values())


def test_one_of_each_edges(spark):
    rng = random.Random(3)
    long = " ".join(rng.choices("abcdefghijklmnop", k=400))
    near = long.replace("a b", "a b z", 1)
    rows = [(5, long, "en", "s", 1, "x"), (5, long, "en", "s", 1, "x"), (2, near, "en", "s", 1, "x"), (2, near, "fr", "s", 1, "x"), (None, long, None, None, None, "x"), (7, None, None, None, None, "x"), (8, "", None, None, None, "x"), (None, "only this one here now yes", None, None, None, "x")]
    df = spark.createDataFrame(rows, DOC)
    got = Counter((r.doc_id, r.text) for r in stages.one_of_each(df).collect())
    assert got == Counter([(2, near), (7, None), (None, "only this one here now yes")])
    assert stages.one_of_each(df.limit(0)).count() == 0


def jaccard_groups(texts, similarity=0.8):
    words = [(t or "").lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if (shared >= similarity * (len(sets[i]) + len(sets[j]) - shared)) and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return group


def test_one_of_each_is_jaccard(spark):
    rng = random.Random(11)
    vocab = [f"w{k}" for k in range(500)]
    texts = []
    for k in range(60):
        base = rng.choices(vocab, k=rng.choice([9, 12, 40, 200, 600]))
        texts.append(" ".join(base))
        for _ in range(3):
            w = list(base)
            for _ in range(rng.choice([1, len(w) // 60, len(w) // 45, len(w) // 30, len(w) // 20])):
                w[rng.randrange(len(w))] = "new" + str(rng.random())
            texts.append(" ".join(w))
        line = " ".join(rng.choices(vocab, k=12)) + " "
        texts += [line * 30 + " ".join(rng.choices(vocab, k=60)) for _ in range(2)] if k < 10 else []
    groups = jaccard_groups(texts)
    want = sorted({g for g in groups})
    df = spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in enumerate(texts)], DOC)
    assert sorted(r.doc_id for r in stages.one_of_each(df).collect()) == want


def test_candidates_are_few_bits_apart():
    """Pairs of sets at 0.8: the bounds of candidates leave out about none of them."""
    rng = np.random.default_rng(1)
    missed = 0
    for n in (5, 9, 64, 200):
        for _ in range(250):
            shared = -(-16 * n // 18)
            v = rng.integers(0, 2**64, 2 * n - shared, dtype=np.uint64)
            far = np.bitwise_count(simhash.voted(v[:n], 4) ^ simhash.voted(v[n - shared :], 4))
            missed += far[0] > simhash.candidate_bits(0.8, 64, n) or far.sum() > simhash.candidate_bits(0.8, 256)
    assert missed <= 2


def test_jaccard_in_blocks(spark, monkeypatch):
    base = [f"w{k}" for k in range(100)]
    texts = [" ".join([*base[:k], "x" + str(k), *base[k:]]) for k in range(40)] + [" ".join(base[k:] + base[:k]) for k in range(0, 100, 25)]
    monkeypatch.setattr(simhash, "ROW_BLOCK", 5)
    df = spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in enumerate(texts)], DOC)
    assert sorted(r.doc_id for r in stages.one_of_each(df).collect()) == sorted(set(jaccard_groups(texts)))


def test_jaccard_across_blocks(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(100)]
    texts = []
    for k in range(60):  # one change each: 0.8 and more; more changes: candidates that are less
        words = list(base)
        for _ in range(1 + k % 3):
            words[rng.randrange(100)] = f"x{k}"
        texts.append(" ".join(words))
    monkeypatch.setattr(simhash, "ROW_BLOCK", 6)
    df = spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in enumerate(texts)], DOC)
    groups = jaccard_groups(texts)
    assert 5 < len(set(groups)) < 50
    assert sorted(r.doc_id for r in stages.one_of_each(df).collect()) == sorted(set(groups))


def test_other_stages(spark, sf_dir):
    docs, items = load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    rows = docs.collect()
    machine = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    score = machine.score(machine.best(*toxicity._rows([r.text for r in rows])))
    got = stages.reject_toxic(docs, load(spark, sf_dir, "labels"))
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r, s in zip(rows, score, strict=True) if s < 0.7)
    bench = [(r.item_id, r.text) for r in items.collect()]
    clean = [d[0] for d in brute_contamination([(r.doc_id, r.text) for r in rows[:60]], bench) if d[3] == 0]
    got = stages.decontaminate(docs, items).where(docs.doc_id.isin([r.doc_id for r in rows[:60]]))
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == sorted(clean)
    red = {r.doc_id: r for r in stages.redact_secrets(docs).collect()}
    assert len(red) == len(rows)
    for r in rows:
        assert not brute_secrets(red[r.doc_id].text) or "[" in red[r.doc_id].text
        assert (red[r.doc_id].text == r.text) or red[r.doc_id].n_chars == len(red[r.doc_id].text)
        if not brute_secrets(r.text) and "BEGIN" not in r.text:
            assert red[r.doc_id].text == r.text


def test_mix_stage(spark):
    rows = [(i, "w " * (1 + i % 9), "en", f"s{i % 4}", 1, "x") for i in range(200)] + [(None, None, None, None, None, "x")]
    df = spark.createDataFrame(rows, DOC)
    got = stages.mix_sources(df)
    assert got.columns == [*df.columns, "copy"]
    words = sum(len((r.text or "").split()) for r in got.collect())
    assert abs(words - 1.5 * sum(len((r[1] or "").split()) for r in rows)) < 60
    assert {r.copy for r in got.collect()} == {1, 2}
    assert stages.mix_sources(df.limit(0)).count() == 0


def test_pipeline(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == [*docs.columns, "copy"]
    n = got.select("doc_id").distinct().count()
    assert 0.3 * docs.count() < n < docs.count()


def test_stages_take_any_table(spark, sf_dir):
    """Empty tables, nulls, repeated rows, very long texts, and columns with the names that stages use inside."""
    long = "word " * 200_000 + "password = hunter22 "
    rows = [(1, long, "s", "a", 1, "c", 0.5), (1, long, "s", "a", 1, "c", 0.5), (None, None, None, None, None, None, None), (2, "", "t", "b", 2, "d", 0.1), (3, "one two three four five six", "t", "e", 3, "f", 0.2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _k1 string, _k2 long, _doc string, score double")
    labels, items = load(spark, sf_dir, "labels"), load(spark, sf_dir, "benchmark")
    every = Counter(map(tuple, rows))
    taken = lambda df: Counter(tuple(r) for r in df.collect())
    for stage in (lambda d: stages.reject_toxic(d, labels.limit(0)), lambda d: stages.decontaminate(d, items), lambda d: stages.decontaminate(d, items.limit(0))):
        assert taken(stage(df)) == every and stage(df.limit(0)).columns == df.columns and stage(df.limit(0)).count() == 0
    red = stages.redact_secrets(df)
    assert red.columns == df.columns and red.where("text like '%[assign] '").count() == 2 and red.count() == 5 and stages.redact_secrets(df.limit(0)).count() == 0
    once = stages.one_of_each(df)
    assert taken(once) == Counter([rows[0], rows[3], rows[4]]) and stages.one_of_each(df.limit(0)).count() == 0
    mixed = stages.mix_sources(df)
    assert mixed.columns == [*df.columns, "copy"] and mixed.where("text is null").count() == 0 and mixed.where("doc_id = 1").count() >= 2
