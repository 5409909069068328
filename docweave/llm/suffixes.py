"""Removing every byte that lies in a long string which starts anywhere else as well.

Windows of ``least`` bytes are dealt by content first: the k-gram with the least
hash in a window (the last of equal ones) is its anchor, so equal windows have
equal anchors at equal places.  Neighbouring windows with one anchor form a run;
equal runs, by a digest of 128 bits, are one class with a count.  Different classes of
an anchor that may share a window are compared by threshold-bounded interval expansion
on a Burrows-Wheeler transform of their bytes (``bwt``); of a class that occurs again every
window is repeated.  Anchors are packed into transforms of bounded size.  An
anchor with too many runs for one is split by the place of the anchor in the window,
together with more of the text around it, which keeps equal windows together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bwt import repeated
from .common import CHUNK_BYTES, buffers, hash_map, in_map, materialise, pieces, small_batches
from .words import mixed, powers

K = 48
#: Bytes that one transform holds at most; an anchor with more is split.
BUCKET_BYTES = 1 << 20
#: Tasks of the comparison at most; each goes through its anchors one transform at a time.
MOST_TASKS = 50_000
#: Low bits of an anchor's hash that give way to its place in the piece of text.
_ROOM = 24
_NONE = hashlib.sha256(b"").hexdigest()


class Hashes:
    """Hash of any part of a buffer."""

    def __init__(self, raw: np.ndarray) -> None:
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        if len(raw):
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(len(raw)), out=self.sums[1:])
        self.back = powers(max(1, len(raw)), True)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])


def _least_of(a: np.ndarray, window: int) -> np.ndarray:
    """Minimum of each ``window`` values in a row."""
    n = len(a) - window + 1
    rows = -(-len(a) // window)
    grid = np.full(rows * window, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(a)] = a
    grid = grid.reshape(rows, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[window - 1 : window - 1 + n])


def runs(at: np.ndarray, raw: np.ndarray, least: int, k: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: row, first window in it, windows, place and hash of the anchor, digest of the run
    (two numbers), and hash of the anchor with half of the rest of a window on its left and right, 0 where a run has less.

    Anchors are chosen by the upper 40 bits of their hash, the last of equal ones, whatever else is in ``raw``.
    """
    nothing = tuple(np.zeros(0, np.int64) for _ in range(9))
    if len(raw) < least:
        return nothing
    h = Hashes(raw)
    n = len(raw) - k + 1
    grams = h.of(np.arange(n), np.arange(n) + k)
    room, low = np.uint64(_ROOM), np.uint64((1 << _ROOM) - 1)
    packed = (grams >> room << room) | (low - np.arange(n, dtype=np.uint64))
    anchor = (low - (_least_of(packed, least - k + 1) & low)).astype(np.int64)
    size = np.diff(at)
    many = np.maximum(0, size - least + 1)
    row = np.repeat(np.arange(len(size)), many)
    if not len(row):
        return nothing
    first = np.arange(len(row)) + np.repeat(at[:-1] - (np.cumsum(many) - many), many)
    mine = anchor[first]
    new = np.concatenate([[True], (mine[1:] != mine[:-1]) | (row[1:] != row[:-1])])
    start = np.flatnonzero(new)
    count = np.diff(np.concatenate([start, [len(row)]]))
    lo, pos, row = first[start], mine[start], row[start]
    end, half = lo + count - 1 + least, (least - k) // 2
    left = np.where(pos - half >= lo, h.of(np.maximum(pos - half, 0), pos + k), np.uint64(0))
    right = np.where(pos + k + half <= end, h.of(pos, np.minimum(pos + k + half, len(raw))), np.uint64(0))
    data = raw.tobytes()
    digests = b"".join([hashlib.blake2b(data[i:j], digest_size=16).digest() for i, j in zip(lo.tolist(), end.tolist(), strict=True)])
    c, d = np.frombuffer(digests, np.int64).reshape(-1, 2).T
    return row, lo - at[row], count, pos - lo, grams[pos].view(np.int64), c, d, left.view(np.int64), right.view(np.int64)


_RUN = "lo int, n int, x int, h long, c long, d long, left long, right long"
#: What tells different runs of one anchor apart.
_SAME = ["h", "x", "n", "c", "d"]


def _text_key() -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))


def _scan(docs: DataFrame, least: int, k: int) -> DataFrame:
    """(key, runs) for every row; key is the hash of the whole text."""
    kind = pa.list_(pa.struct([(f.split()[0], pa.int64() if f.endswith("long") else pa.int32()) for f in _RUN.split(", ")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for first, end, place, last, at, raw in pieces(batch.column(1), least - 1):
                row, lo, *more = runs(at, raw, least, k)
                held.append((row, lo + place, *more))
                if not last:
                    continue
                row, *cols = (np.concatenate(c) for c in zip(*held, strict=True))
                held = []
                cuts = pa.array(np.searchsorted(row, np.arange(end - first + 1)).astype(np.int32))
                parts = [pa.array(v.astype(np.int32)) for v in cols[:3]] + [pa.array(v) for v in cols[3:]]
                found = pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays(parts, fields=list(kind.value_type)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), found], names=["key", "runs"])

    rows = docs.select(_text_key().alias("key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"key binary, runs array<struct<{', '.join(f.replace(' ', ':') for f in _RUN.split(', '))}>>")


def _texts(docs: DataFrame, keys: DataFrame, sent: list[Broadcast]) -> DataFrame:
    """(key, text) of rows whose key may be among ``keys`` (materialised), once a task, so that few others are shuffled; the map of keys joins ``sent``."""
    known = docs.sparkSession.sparkContext.broadcast(hash_map(keys.select(F.xxhash64("key").alias("mark")), "mark"))
    sent.append(known)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            hit = in_map(known.value, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64))
            for i in np.flatnonzero(hit).tolist():
                key = batch.column(0)[i].as_py()
                hit[i] = key not in seen
                seen.add(key)
            yield batch.filter(pa.array(hit)).select(["key", "text"])

    rows = docs.select(_text_key().alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("mark", F.xxhash64("key"))
    return rows.mapInArrow(keep, "key binary, text string")


def _spans_of(flags: np.ndarray) -> list[dict]:
    """Runs of True as first and end."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"i": i, "j": j} for i, j in edge.reshape(-1, 2).tolist()]


_SPANS = "array<struct<i:int,j:int>>"
_SPANS_ARROW = pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32())]))


def _texts_of(runs_: DataFrame, docs: DataFrame, least: int, sent: list[Broadcast] | None = None) -> DataFrame:
    """``runs_`` (key, lo, n, more) with the bytes of each run, taken from the texts with that key.

    Runs of a text overlap and are several times as long as it is, so they are handed on by about CHUNK_BYTES.
    """
    more = [c for c in runs_.columns if c not in ("key", "lo")]
    arrow = {"bigint": pa.int64(), "int": pa.int32()}
    wanted = materialise(runs_.groupBy("key").agg(F.collect_list(F.struct("lo", *more)).alias("runs")))
    rows = _texts(docs, wanted, [] if sent is None else sent).join(wanted, "key").select("key", "text", "runs")
    kinds = {f.name: f.dataType.simpleString() for f in runs_.schema}
    types = pa.schema([(c, arrow[kinds[c]]) for c in more] + [("bytes", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # copies of a text in one task give its runs once
        for batch in batches:
            at, raw = buffers(batch.column(1))
            out: list[dict] = []
            size = 0
            for row, key in enumerate(batch.column(0).to_pylist()):
                if key in seen:
                    continue
                seen.add(key)
                for of in batch.column(2)[row]:
                    r = of.as_py()
                    lo = int(at[row]) + r.pop("lo")
                    out.append(r | {"bytes": raw[lo : lo + r["n"] - 1 + least].tobytes()})
                    size += r["n"] - 1 + least
                    if size >= CHUNK_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema=types)
                        out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, schema=types)

    return rows.mapInArrow(cut, ", ".join(f"{c} {kinds[c]}" for c in more) + ", bytes binary")


def _shared(kinds: DataFrame, least: int) -> DataFrame:
    """Classes of one anchor that may have a window in common with others, with the bytes of all such classes of the anchor.

    A window reaches at least half of what the anchor leaves of it to the left or to
    the right, so two runs must have that much beside the anchor in common.  Counts are
    written before they are joined, so that adaptive execution can split a hot anchor.
    """
    several = materialise(kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    known = kinds.sparkSession.sparkContext.broadcast(hash_map(several, "h"))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # most anchors have one class, which needn't be shuffled
            yield batch.filter(pa.array(in_map(known.value, batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64))))

    kinds = kinds.mapInArrow(some, kinds.schema)
    rows = materialise(kinds.join(several, "h").select(*_SAME, "first.*", "left", "right"), known)
    near = F.lit(False)
    for side in ("left", "right"):
        often = rows.where(f"{side} <> 0").groupBy("h", side).agg(F.count("*").alias("times")).where("times > 1")
        rows = rows.join(materialise(often.withColumnRenamed("times", f"{side}_times")), ["h", side], "left")
        near = near | F.col(f"{side}_times").isNotNull()
    rows = materialise(rows.where(near).select(*_SAME, "key", "lo"))
    size = F.col("n") + least  # with a separator
    return rows.join(materialise(rows.groupBy("h").agg(F.sum(size).alias("bytes_all"))), "h")


def _packed(parts: DataFrame, least: int, total: int, group: str) -> DataFrame:
    """(h, x, n, c, d, spans): windows of each run that also start elsewhere in ``parts`` (h, x, n, c, d, off, bytes).

    Runs of one ``group``, BUCKET_BYTES of them at most, go into one transform, with
    as many other groups as there is room for.  Repeated rows count once.
    """
    kind = pa.schema([("h", pa.int64()), ("x", pa.int32()), ("n", pa.int32()), ("c", pa.int64()), ("d", pa.int64()), ("spans", _SPANS_ARROW)])
    names = [*_SAME, "off", "bytes"]

    def compare(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        for (*same, off, _), flags in zip(rows, repeated([r[-1] for r in rows], least), strict=True):
            if flags.any():
                out.append((*same, [{"i": s["i"] + off, "j": s["j"] + off} for s in _spans_of(flags)]))
        cols = zip(*out, strict=True) if out else [[]] * len(kind)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kind, strict=True)], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full: list[tuple] = []  # whole groups
        open_: list[tuple] = []
        sizes, last, before = [0, 0], None, None
        for batch in batches:
            for now, *row in zip(*(batch.column(c).to_pylist() for c in ("group", *names)), strict=True):
                if now != last:
                    full += open_
                    open_, sizes, last = [], [sum(sizes), 0], now
                if row[:-1] == before:
                    continue
                before = row[:-1]
                size = len(row[-1]) + 1
                if full and sum(sizes) + size > BUCKET_BYTES:
                    yield compare(full)
                    full, sizes[0] = [], 0
                open_.append(tuple(row))
                sizes[1] += size
        if full or open_:
            yield compare(full + open_)

    dealt = parts.select(F.col(group).alias("group"), *names)
    dealt = dealt.repartition(min(MOST_TASKS, 1 + total // (2 * BUCKET_BYTES)), "group").sortWithinPartitions("group", *_SAME, "off")
    return dealt.mapInArrow(run, f"h long, x int, n int, c long, d long, spans {_SPANS}")


def _split(parts: DataFrame, least: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Runs of an anchor with too many of them, dealt again until all groups fit a task: (results, what is left to compare).

    A part of a run holds its windows in which the anchor is x0 to x1 bytes from
    the start.  All of them contain the bytes from x0 before the anchor to
    ``least`` - x1 after its start, so equal windows agree in these.  Equal parts
    are counted as one; of those that occur again every window is repeated.
    """
    kinds = "h long, x int, n int, c long, d long, x0 int, x1 int, off int, near binary, whole binary, bytes binary"

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                # the part's windows are those at off.. of its run; the anchor is x - off before the first
                n = len(r["bytes"]) - least + 1
                high = r["x"] - r["off"]
                low = high - n + 1
                middle = (r["x0"] + r["x1"] + 1) // 2
                for x0, x1 in ((middle, r["x1"]), (r["x0"], middle - 1)):
                    a, b = max(low, x0), min(high, x1)
                    if x0 <= x1 and a <= b:
                        part = r["bytes"][high - b : high - a + least]
                        common = part[b - x0 : b + least - x1]
                        digest = lambda s: hashlib.blake2b(s, digest_size=16).digest()
                        out.append({**r, "x0": x0, "x1": x1, "off": r["off"] + high - b, "near": digest(common), "whole": digest(b"%d %d " % (a, b) + part), "bytes": part})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema(
        [("h", pa.int64()), ("x", pa.int32()), ("n", pa.int32()), ("c", pa.int64()), ("d", pa.int64()), ("x0", pa.int32()), ("x1", pa.int32())]
        + [("off", pa.int32()), ("near", pa.binary()), ("whole", pa.binary()), ("bytes", pa.binary())]
    )
    none = F.lit(b"")
    now = parts.withColumns({"x0": F.lit(0), "x1": F.lit(least - k), "near": none, "whole": none}).select([f.name for f in schema])
    node = ["h", "x0", "x1", "near"]
    done, rest = [], []
    while True:
        now = materialise(now.mapInArrow(halve, kinds))
        each = now.groupBy(*node, "whole").agg(F.count("*").alias("m"), F.min(F.struct(*_SAME[1:], "off")).alias("first"), F.max(F.length("bytes") + 1).alias("size"))
        each = materialise(each)
        found = now.join(materialise(each.where("m > 1").select(*node, "whole")), [*node, "whole"], "left_semi")
        windows = F.length("bytes") - least + 1
        done.append(found.select(*_SAME, F.array(F.struct(F.col("off").alias("i"), (F.col("off") + windows).cast("int").alias("j"))).alias("spans")))
        sums = each.groupBy(*node).agg(F.count("*").alias("kinds"), F.sum("size").alias("bytes_all")).where("kinds > 1 and x0 < x1")
        sums = materialise(sums)
        one = each.select(*node, "whole", "first.*").join(sums, node).select(*node, *_SAME[1:], "off", "bytes_all")
        left = now.join(one, [*node, *_SAME[1:], "off"]).select([f.name for f in schema] + ["bytes_all"])
        left = materialise(left.dropDuplicates([*node, *_SAME[1:], "off"]))
        rest.append(left.where(F.col("bytes_all") <= BUCKET_BYTES).drop("bytes_all"))
        now = left.where(F.col("bytes_all") > BUCKET_BYTES).drop("bytes_all")
        if now.isEmpty():
            break
    results, compare = done[0], rest[0]
    for d, r in zip(done[1:], rest[1:], strict=True):
        results, compare = results.unionByName(d), compare.unionByName(r)
    return results, compare


def repeated_spans(docs: DataFrame, least: int = 400, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows (doc_id, key, n_bytes, copies); spans (key, spans) of bytes to remove from texts with that key.

    Texts that occur more than once are left out of ``spans`` if they are of
    ``least`` bytes or more, since all of them goes.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", _text_key().alias("key"), F.coalesce(F.octet_length(F.col("text")), F.lit(0)).cast("long").alias("n_bytes"))
    texts = materialise(_scan(docs, least, k).groupBy("key").agg(F.count("*").alias("copies"), F.first("runs").alias("runs")))
    marks = texts.select("key", "copies", F.explode("runs").alias("r")).select("key", "copies", "r.*")
    first = [F.min(F.struct("key", "lo")).alias("first"), F.min("left").alias("left"), F.min("right").alias("right")]
    kinds = materialise(marks.groupBy(*_SAME).agg(F.sum("copies").alias("m"), *first))
    wanted = materialise(_shared(kinds, least))
    sent: list[Broadcast] = []
    parts = materialise(_texts_of(wanted, docs, least, sent).withColumn("off", F.lit(0)), *sent)
    fits = F.col("bytes_all") <= BUCKET_BYTES
    total = wanted.agg(F.sum(F.when(fits, F.col("n") + least))).first()[0] or 0
    every = F.array(F.struct(F.lit(0).alias("i"), F.col("n").alias("j")))
    found = [kinds.where("m > 1").select(*_SAME, every.alias("spans")), _packed(parts.where(fits), least, total, "h")]
    large = parts.where(~fits).drop("bytes_all")
    if not large.isEmpty():
        sure, rest = _split(large.dropDuplicates(_SAME), least, k)
        size = rest.agg(F.sum(F.length("bytes"))).first()[0] or 0
        found += [sure, _packed(rest.withColumn("node", F.xxhash64("h", "x0", "x1", "near")).drop("x0", "x1"), least, size, "node")]
    hits = found[0]
    for f in found[1:]:
        hits = hits.unionByName(f)
    hits = materialise(hits)
    windows = marks.where("copies = 1").join(hits, _SAME).select("key", F.transform("spans", lambda s: F.struct((F.col("lo") + s["i"]).alias("i"), (F.col("lo") + s["j"] - 1 + least).alias("j"))).alias("spans"))
    spans = windows.groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    return materialise(rows.join(texts.select("key", "copies"), "key")), materialise(spans)


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in spans:  # sorted
        if out and s["i"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["j"]))
        else:
            out.append((s["i"], s["j"]))
    return out


def remove_repeats(docs: DataFrame, least: int = 400, k: int = K) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, has_repeat) for every row of ``docs`` (doc_id, text, more).

    A byte goes if it lies in a string of ``least`` bytes of its text that also
    starts at another place, in the same text or any other; judged on the input.
    Null and empty texts have no bytes; repeated rows and null ids are rows of
    their own.  An empty table gives an empty table.  ``least`` must exceed ``k``.
    """
    rows, spans = repeated_spans(docs, least, k)
    sent: list[Broadcast] = []
    texts = _texts(docs, spans, sent).join(spans, "key").select("key", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = buffers(batch.column(1))
            removed, number, digest = [], [], []
            for row, spans_ in enumerate(batch.column(2).to_pylist()):
                gone = _merged(spans_)
                text = raw[at[row] : at[row + 1]]
                keep = np.ones(len(text), bool)
                for i, j in gone:
                    keep[i:j] = False
                removed.append(int(len(text) - keep.sum()))
                number.append(len(gone))
                digest.append(hashlib.sha256(text[keep].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(number, pa.int64()), pa.array(digest, pa.string())], names=["key", "n_removed", "n_spans", "kept_sha256"])

    kept = materialise(texts.mapInArrow(cut, "key binary, n_removed long, n_spans long, kept_sha256 string"), *sent)
    # only texts without copies have spans, so no key is hot here
    out = rows.where("copies = 1").join(kept, "key", "left").unionByName(rows.where("copies > 1"), allowMissingColumns=True)
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= least)
    removed = F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long")
    return out.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(_NONE)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("key")))).alias("kept_sha256"),
        (removed > 0).alias("has_repeat"),
    )
