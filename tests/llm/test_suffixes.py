"""Repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
from docweave.llm import common, queries, suffixes
from docweave.llm.bwt import repeated
from docweave.llm.suffixes import remove_repeats


def brute(rows, least):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + least] for _, b in data for i in range(len(b) - least + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - least + 1):
            if seen[b[i : i + least]] > 1:
                gone[i : i + least] = b"\x01" * least
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_bwt():
    rng = random.Random(1)
    for _ in range(200):
        least = rng.choice([1, 2, 3, 5, 9, 17, 40])
        pool = [bytes(rng.choices(b"ab\x00\xff", k=rng.randint(0, 60))) for _ in range(3)]
        texts = [b"".join(rng.choices([*pool, bytes(rng.choices(b"abc\x00", k=rng.randint(0, 9)))], k=rng.randint(0, 3))) for _ in range(rng.randint(1, 6))]
        c = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
        assert [x.tolist() for x in repeated(texts, least)] == [[i + least <= len(t) and c[t[i : i + least]] > 1 for i in range(len(t))] for t in texts]


def case(seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choices("abcdé \n", k=n))
    shared = [word(n) for n in (30, 60, 90, 200)]
    rows = []
    for i in range(60):
        rows.append((i, "".join(rng.choice([word(rng.randint(0, 80)), rng.choice(shared), rng.choice(shared)[rng.randint(0, 20) :]]) for _ in range(rng.randint(0, 5)))))
    rows += [(60, None), (61, ""), (None, shared[3]), (62, shared[3] + "x"), (62, shared[3] + "x"), (63, "z" * 300), (64, "zy" * 150), (65, word(3_000) * 2)]
    return rows


def test_small(spark):
    rows = case(1)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, key string, n_bytes string")
    assert got(remove_repeats(df, least=40, k=8)) == brute(rows, 40)
    assert remove_repeats(df.limit(0), least=40, k=8).count() == 0


def test_split_anchors(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 300)
    rows = case(2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(remove_repeats(df, least=40, k=8)) == brute(rows, 40)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got(queries.op7_repeats(spark, sf_dir)) == brute(rows, 400)


def test_holds_little_at_a_time(spark, monkeypatch):
    """Runs of a text are handed on in bounded batches, and so are the texts that come to Python."""

    class Table:  # keeps the function that Spark would run on batches
        def join(self, *_):
            return self

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):  # noqa: N802
            return run

    monkeypatch.setattr(suffixes, "_texts", lambda *_: Table())
    cut = suffixes._texts_of(spark.createDataFrame([], "key binary, lo int, n int, x int, h long, c long, d long"), None, 400)
    runs = [{"lo": i, "n": 200, "x": 0, "h": i, "c": 0, "d": 0} for i in range(0, 20_000, 2)]
    kind = pa.list_(pa.struct([(c, pa.int64() if c in "hcd" else pa.int32()) for c in ("lo", "n", "x", "h", "c", "d")]))
    text = "".join(random.Random(5).choices("abcdef", k=21_000))
    batch = pa.RecordBatch.from_arrays([pa.array([b"k", b"l"]), pa.array([text, "short"]), pa.array([runs, []], kind)], names=["key", "text", "runs"])
    out = list(cut(iter([batch])))
    assert [(r["h"], r["bytes"].decode()) for b in out for r in b.to_pylist()] == [(i, text[i : i + 599]) for i in range(0, 20_000, 2)]
    assert max(b.nbytes for b in out) < 1.2 * common.CHUNK_BYTES
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(256 << 20))
    monkeypatch.undo()
    try:
        remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), least=40, k=8)
        assert int(spark.conf.get(name)) == common.BATCH_BYTES
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_passages_of_400_bytes_are_all_found(spark):
    """Of planted passages of 51 to 80 words, those of 400 bytes and more lose every copy; shorter ones aren't repeats of 400 bytes."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 12)))
    fill = lambda: " ".join(word() for _ in range(rng.randint(20, 120)))
    passages = [" ".join(word() for _ in range(rng.randint(51, 80))) for _ in range(60)]
    rows = [(3 * p + c, f"{fill()} {passage} {fill()}") for p, passage in enumerate(passages) for c in range(3)]
    rows += [(1_000 + i, fill()) for i in range(60)]
    found = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), least=400).collect()}
    for p, passage in enumerate(passages):
        for c in range(3):
            r = found[3 * p + c]
            assert r.has_repeat == (r.n_removed > 0) == (len(passage) >= 398) or abs(len(passage) - 399) < 3
            assert r.n_removed >= len(passage) or not r.has_repeat
    assert sum(len(p) >= 400 for p in passages) > 20 and not any(found[1_000 + i].has_repeat for i in range(60))
