"""Mixing, decontamination and SimHash against brute force."""

import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from docweave.llm import common, decontaminate, oracles, queries, words
from docweave.llm.decontaminate import contamination
from docweave.llm.mixing import mix
from docweave.llm.simhash import fingerprint, near_duplicates, within

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def tables(sf_dir, *names):
    con = duckdb.connect()
    for n in names:
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{sf_dir}/{n}.parquet')")
    return con


def same(got: pd.DataFrame, want: pd.DataFrame):
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    key = lambda df: df[cols].sort_values(cols, ignore_index=True)
    pd.testing.assert_frame_equal(key(got), key(want), check_dtype=False, rtol=1e-12)


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_oracles(spark, sf_dir, name):
    con = tables(sf_dir, "documents", "benchmark", "embeddings")
    same(queries.queries()[name](spark, sf_dir).toPandas(), con.sql(oracles.oracle_sql()[name]).df())


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(docs, items, window=8):
    out = []
    wins = []
    for item_id, text in items:
        w = words_of(text)
        m = min(window, len(w))
        wins += [(item_id, tuple(w[i : i + m])) for i in range(len(w) - m + 1) if m]
    for doc_id, text in docs:
        w = words_of(text)
        hit, ids = set(), set()
        for item_id, g in wins:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    ids |= {item_id} - {None}
        out.append((doc_id, len(w), len(hit), len(ids), sorted(map(str, ids)), len(ids) >= 2))
    return out


def key(rows):
    return sorted(rows, key=repr)


def test_parts_of_long_texts():
    rng = np.random.default_rng(3)
    pieces = ["ab", "c", "Z", " ", "  ", ".", "é", "word", " and ", "longlonglonglonglong", "\n"]
    for _ in range(500):
        raw = np.frombuffer("".join(rng.choice(pieces, rng.integers(0, 80))).encode(), np.uint8)
        whole = words.Words(np.array([0, len(raw)]), raw)
        every = whole.slice(0, int(whole.counts()[0]))
        size, shared, end = int(rng.integers(1, 60)), int(rng.integers(0, 8)), 0
        for i, (before, w) in enumerate(words.parts(raw, shared, size)):
            n = int(w.counts()[0])
            assert w.slice(0, n) == every[before : before + n] and before == (end - shared if i else 0) and (not i or n > shared)
            end = before + n
        assert end == len(every)


def test_contamination_of_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", 64)
    rng = random.Random(5)
    vocab = ["a", "b", "É9", "x1"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([2, 5, 7, 8, 9, 14, 90])))) for i in range(12)] + [(50, "a b " * 3 + "." * 200), (51, "." * 300 + "x1 a")]
    docs = [(i, ("-" * rng.choice([1, 1, 9])).join(rng.choices(vocab, k=rng.choice([4, 8, 60, 300])))) for i in range(30)]
    docs += [(97, "q" * 1000), (98, "." * 1000), (99, items[6][1] + " " + "q" * 500 + " " + items[6][1])]
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    rows = [(r.doc_id, r.n_words, r.n_hit, r.n_items, list(r.item_ids), r.contaminated) for r in got]
    assert key(rows) == key(brute_contamination(docs, items))


def test_contamination_edges(spark):
    rng = random.Random(3)
    vocab = ["a", "b", "É9", "x1"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 2, 5, 7, 8, 9, 14])))) for i in range(25)]
    items += [(None, "zz yy xx ww vv uu tt ss rr"), (99, None), (5, "q q q q q q q q q"), (5, "q q q q q q q q q")]
    docs = [(i, "-".join(rng.choices(vocab, k=rng.choice([0, 1, 4, 7, 8, 20, 60])))) for i in range(40)]
    docs += [(None, "zz YY xx ww vv uu tt ss"), (7, None), (8, ""), (8, ""), (9, "Q " * 30), (10, "n " * 3000 + "q " * 8 + "n " * 3000)]
    d = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, text string, n_words string")
    i = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.item_ids, r.contaminated) for r in contamination(d, i).collect()]
    assert key(got) == key(brute_contamination(docs, items))
    assert contamination(d.limit(0), i).count() == 0
    assert contamination(d, i.limit(0)).where("n_hit > 0").count() == 0


def test_contamination_holds_little_at_a_time(spark):
    """A text of nothing but hits is handed on in bounded batches, and so are the texts that come to Python."""
    import numpy as np
    import pyarrow as pa

    class Table:  # keeps the function that Spark would run on batches
        schema = spark.createDataFrame([], "id long, text string").schema

        def mapInArrow(self, run, _):  # noqa: N802
            return run

    text = " ".join(random.Random(4).choices(["a", "b", "c", "d"], k=20_000))
    seen = type("All", (), {"value": np.full(1 << 10, ~np.uint64(0))})
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([text, None])], names=["id", "text"])
    got = list(decontaminate._scan(Table(), 8, 5, [3], False, seen)(iter([batch])))
    assert sum(b.num_rows for b in got) > 20_000
    assert max(b.num_rows for b in got) <= 5_000
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(256 << 20))
    try:
        contamination(spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([("i", "a")], "item_id string, text string"))
        assert int(spark.conf.get(name)) == common.BATCH_BYTES
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_mix_edges(spark):
    rows = [(i, "w " * (i % 7), None, None if i % 11 == 0 else f"s{i % 5}", 0, "x") for i in range(300)]
    rows += [(None, None, None, "s1", 0, "x"), (1, "w " * 500, None, "zero", 0, "x"), (2, None, None, "empty", 0, "x"), (3, "a\t b\x0b\r\n c", None, "s1", 0, "x")] * 2
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("extra", "base")
    got = mix(df).toPandas()
    assert len(got) == len(rows)
    assert (got.taken <= 2 * got["size"]).all()
    total = got["size"].sum()
    per = got.groupby("source", dropna=False).agg(t=("taken", "sum"), target=("target", "first"), s=("source_size", "first"), most=("size", "max"))
    assert abs(per.target.sum() - 1.5 * total) < 1e-6 * total
    assert ((per.t - per.target).abs() <= 2 * per.most).all()
    assert (per.target <= 2 * per.s + 1e-9).all()
    again = mix(df).toPandas()
    same(got, again)
    assert mix(df.limit(0)).count() == 0
    assert mix(df.where("text is null")).agg({"taken": "sum"}).first()[0] == 0


def brute_fingerprint(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, radius):
    group = list(range(len(ids)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) for i in range(len(ids))]


def test_simhash_sf(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text, 4) for r in docs]
    want = brute_components(fps, [r.doc_id for r in docs], 4)
    got = queries.op5_simhash(spark, sf_dir).collect()
    assert key((r.doc_id, r.fingerprint, r.component_id) for r in got) == key((d.doc_id, f"{f:016x}", c) for d, f, c in zip(docs, fps, want, strict=True))


def test_simhash_edges(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choices("abcdefgh", k=k)) for k in (1, 3, 4, 5, 300)]
    docs = [(i, t, "x") for i, t in enumerate(base * 3)] + [(None, base[4], "x"), (50, None, "x"), (51, "", "x"), (52, " \t\n", "x"), (3, base[4] + " z", "x")]
    docs += [(100 + i, base[4].replace("a", "B", i), "x") for i in range(20)] + [(200, "long " * 70_000, "x"), (201, "Été x y z w v", "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, fp string")
    fps = [brute_fingerprint(t, 4) if len(t or "") < 10_000 else fingerprint(t.encode(), 4) for _, t, _ in docs]
    want = brute_components(fps, [d[0] for d in docs], 4)
    got = near_duplicates(df, shingle=4).collect()
    assert key((r.doc_id, r.component_id) for r in got) == key((d[0], c) for d, c in zip(docs, want, strict=True))
    assert near_duplicates(df.limit(0)).count() == 0


def test_within_is_exact():
    import numpy as np

    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = np.concatenate([seeds ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a, b in rng.integers(0, 63, (40, 2))] + [rng.integers(0, 2**63, 500, dtype=np.uint64)])
    values = np.unique(values)
    other = values[::3]
    d = np.bitwise_count(values[:, None] ^ other[None, :])
    want = set(zip(*map(list, np.nonzero(d <= 4)), strict=True))
    got = {(int(i), int(j)) for a, b in within(values, other, 4) for i, j in zip(a, b, strict=True)}
    assert got == {(int(i), int(j)) for i, j in want}
