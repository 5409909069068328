"""SimHash near-deduplication by tiled exact comparison.

Fingerprints come from one pass over the texts.  Distinct fingerprints are dealt
to tiles by their number of one bits; two tiles whose counts all differ by more than
the radius can't hold a link and are never compared.  The other tile pairs are
compared exactly with exclusive-or and bit counts, in sub-tiles that are skipped
by the same rule on parts of the fingerprint.  A tile pair returns a spanning
forest of its links, so that a group of any size gives a linear number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, buffers, grouped, hash_map, in_map, materialise
from .components import Forest, connected_components
from .words import mixed

#: Fingerprints in a block of a tile; a pair of blocks is one group of a task.
BLOCK = 65_536
#: Comparisons that one numpy step makes at most.
STEP = 1 << 21
#: Shingles and texts in a block of candidates, about; a block or a pair of them is one group of a task.
SET_BLOCK, ROW_BLOCK = 1 << 20, 2_048
#: Shingles from which on the share of differing bits is that of large sets.
LARGE = 64


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """Majority bits over the XXH64 of all word shingles, repeats included.

    A-Z count as a-z.  Words are runs without ASCII white space.  Fewer words than
    ``shingle`` make one shingle, no words make 0.
    """
    return int(fingerprints(text, shingle, 1, seed)[0])


def shingles(text: bytes, shingle: int, seed: int = 42) -> np.ndarray:
    """Hashes of all word shingles in order, repeats included; none without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = len(words)
    if n <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        flat = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
        starts = np.concatenate([[0], ends[: n - shingle]]).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(flat[i:j], seed) for i, j in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    return np.array(hashes, np.uint64)


def fingerprints(text: bytes, shingle: int, width: int, seed: int = 42) -> np.ndarray:
    """``width`` words of 64 bits; the first takes the hashes as they are, others spread them anew."""
    return voted(shingles(text, shingle, seed), width)


def voted(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` words of majority bits over hashes; zeros without any."""
    votes, total = np.zeros((width, 64), np.int64), len(values)
    for at in range(0, total, 65_536):
        part = values[at : at + 65_536]
        for k in range(width):
            bits = part if not k else mixed(part + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            votes[k] += np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(votes * 2 > total, axis=1, bitorder="little").view(np.uint64).ravel()


def simhash(docs: DataFrame, shingle: int = 5, text: str = "text", fp: str = "fp") -> DataFrame:
    """``docs`` without ``text``, with the fingerprint of it as a long (two's complement).

    Null texts count as empty.  Rows are kept as they are, repeated ones too; a column ``fp`` is replaced.
    """
    keep = [c for c in docs.columns if c not in (text, fp)]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = buffers(batch.column(batch.num_columns - 1))
            out = [fingerprints(raw[i:j].tobytes(), shingle, 1) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            found = np.array(out, np.uint64).reshape(-1).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=[*keep, fp])

    return docs.select(*keep, text).mapInArrow(run, f"{fields}{fp} long")


def sketches(docs: DataFrame, shingle: int = 5, width: int = 4) -> DataFrame:
    """``docs`` without ``text``, with fp and more (the words of a fingerprint), same (a hash of the set) and n of its shingles.

    Repeated shingles count once.  Null texts count as empty.  Columns of these names are replaced.
    """
    keep = [c for c in docs.columns if c not in ("text", "fp", "more", "same", "n")]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = buffers(batch.column(batch.num_columns - 1))
            words, same, n = [], [], []
            for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                values = np.unique(shingles(raw[i:j].tobytes(), shingle))
                words.append(voted(values, width))
                same.append(xxhash.xxh64_intdigest(values.tobytes()))
                n.append(len(values))
            found = np.array(words, np.uint64).reshape(-1, width).view(np.int64)
            more = pa.array(found[:, 1:].tolist(), pa.list_(pa.int64()))
            cols = [pa.array(found[:, 0]), more, pa.array(np.array(same, np.uint64).view(np.int64)), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], names=[*keep, "fp", "more", "same", "n"])

    return docs.select(*keep, "text").mapInArrow(run, f"{fields}fp long, more array<long>, same long, n long")


def _parts(values: np.ndarray, parts: int) -> np.ndarray:
    width = -(-64 // parts)
    mask = np.uint64((1 << width) - 1) if width < 64 else np.uint64(2**64 - 1)
    return np.stack([np.bitwise_count((values >> np.uint64(width * k)) & mask) for k in range(parts)], 1).astype(np.int16)


def _subtiles(values: np.ndarray, parts: int) -> list[tuple[np.ndarray, np.ndarray]]:
    counts = _parts(values, parts)
    keys, group = np.unique(counts, axis=0, return_inverse=True)
    order = np.argsort(group.ravel(), kind="stable")
    cuts = np.searchsorted(group.ravel()[order], np.arange(len(keys) + 1))
    return [(keys[k], order[cuts[k] : cuts[k + 1]]) for k in range(len(keys))]


def within(left: np.ndarray, right: np.ndarray | None, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of values at ``radius`` differing bits or fewer; right None: pairs inside left."""
    other = left if right is None else right
    parts = 1 + int(np.searchsorted([1_000, 6_000, 60_000], max(len(left), len(other)))) if radius <= 8 else 1
    a = _subtiles(left, parts)
    b = a if right is None else _subtiles(other, parts)
    keys = np.stack([k for k, _ in b])
    for n, (key, rows) in enumerate(a):
        near = np.flatnonzero(np.abs(keys - key).sum(1) <= radius)
        if right is None:
            near = near[near >= n]
        if not len(near):
            continue
        cols = np.concatenate([b[m][1] for m in near])
        step = max(1, STEP // len(rows))
        for at in range(0, len(cols), step):
            part = cols[at : at + step]
            wide = max(1, STEP // len(part))
            for up in range(0, len(rows), wide):
                x = rows[up : up + wide]
                i, j = np.nonzero(np.bitwise_count(left[x][:, None] ^ other[part][None, :]) <= radius)
                if len(i):
                    yield x[i], part[j]


def _tiles(rows: DataFrame, tile: list[Column], near: Column, cols: list[str], block: int) -> DataFrame:
    """``rows`` once for each pair of blocks of tiles that they take part in: cols, lo and hi (the blocks), second (belongs to hi).

    ``tile`` holds integers that name a row's tile, ``near`` the arrays of such integers
    with which a row of it may be linked, itself among them.  There are few tiles; they are
    cut into blocks by hash.
    """
    names = [f"_t{k}" for k in range(len(tile))]
    named = rows.select(*cols, *[c.cast("int").alias(n) for n, c in zip(names, tile, strict=True)])
    sizes = named.groupBy(*names).count().collect()
    blocks = {tuple(r[n] for n in names): -(-r["count"] // block) for r in sizes}
    if not blocks:
        return named.select(*cols, F.struct("_t0").alias("lo"), F.struct("_t0").alias("hi"), F.lit(False).alias("second"))
    have = F.create_map(*[x for t, n in blocks.items() for x in (F.array(*[F.lit(v) for v in t]), F.lit(n))])
    key = F.array(*names)
    mine = F.pmod(F.xxhash64("id", F.lit(7)), have[key]).cast("int")
    others = F.filter(near, lambda t: have[t].isNotNull())
    pairs = F.flatten(F.transform(others, lambda t: F.transform(F.sequence(F.lit(0), have[t] - 1), lambda n: F.struct(t.alias("t"), n.alias("n")))))
    dealt = named.select(*cols, F.struct(key.alias("t"), mine.alias("n")).alias("me"), F.explode(pairs).alias("it"))
    return dealt.select(*cols, F.least("me", "it").alias("lo"), F.greatest("me", "it").alias("hi"), (F.col("me") > F.col("it")).alias("second"))


def hamming_forest(values: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``values`` (fp) that differ in ``radius`` bits or fewer.

    The links of a tile pair are returned as a spanning forest of it.
    """
    # tiles of neighbouring counts, so that a wide radius doesn't send rows to every count
    width = max(1, radius // 2)
    reach = (radius - 1) // width + 1 if radius else 0
    tile = F.floor(F.bit_count("fp") / width)
    near = F.transform(F.sequence(F.col("_t0") - reach, F.col("_t0") + reach), lambda t: F.array(t))
    dealt = _tiles(values.select(F.col("fp").alias("id"), "fp"), [tile], near, ["id", "fp"], block)

    def compare(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        second = table.column("second").to_numpy(zero_copy_only=False)
        forest = Forest(len(fps))
        x, y = np.flatnonzero(~second), np.flatnonzero(second)
        if table.column("lo")[0].as_py() == table.column("hi")[0].as_py():
            for i, j in within(fps, None, radius):
                forest.link(i, j)
        elif len(x) and len(y):
            for i, j in within(fps[x], fps[y], radius):
                forest.link(x[i], y[j])
        a, b = forest.edges(table.column("id").to_numpy())
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("lo", "hi").applyInArrow(compare, "a long, b long")


def _words_of(table: pa.Table) -> np.ndarray:
    """Fingerprints of the rows of a table, one row of words each."""
    more = table.column("more").combine_chunks().flatten().to_numpy()
    return np.column_stack([table.column("fp").to_numpy(), more.reshape(len(table), -1)]).view(np.uint64)


def candidate_forest(rows: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all candidates among ``rows`` (id, n, fp, more).

    Candidates differ in ``candidate_bits`` or fewer, of the first word and of all.
    Sets of which one is smaller than ``similarity`` times the other can't be that
    similar: tiles are bands of sizes and of bit counts, rows of a tile are sorted by
    size, and what is farther apart in either is never compared.
    """
    width = 1 + (rows.select(F.max(F.size("more"))).first()[0] or 0)
    first, total = [candidate_bits(similarity, 64, n) for n in (1, LARGE)], candidate_bits(similarity, 64 * width)
    ones = F.bit_count("fp") + F.aggregate("more", F.lit(0), lambda s, x: s + F.bit_count(x))
    tile = [F.floor(F.log("n") / (1.0001 * np.log(1 / similarity))), F.floor(ones / (total + 1))]
    by = lambda c: F.sequence(F.col(c) - 1, F.col(c) + 1)
    near = F.flatten(F.transform(by("_t0"), lambda s: F.transform(by("_t1"), lambda t: F.array(s, t))))
    dealt = _tiles(rows.where("n > 0"), tile, near, ["id", "n", "fp", "more"], block)

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("second", "ascending"), ("n", "ascending")])
        fps, n = _words_of(table), table.column("n").to_numpy()
        cut = int((~table.column("second").to_numpy(zero_copy_only=False)).sum())
        alone = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
        start, end = (0, len(n)) if alone else (cut, len(n))
        forest = Forest(len(n))
        head = np.ascontiguousarray(fps[:, 0])
        for at in range(0, cut, 256):
            upto = min(at + 256, cut)
            # rows are sorted by size, so what may be similar to these is one range
            lo = start + int(np.searchsorted(n[start:end], similarity * n[at] - 1e-6))
            hi = start + int(np.searchsorted(n[start:end], n[upto - 1] / similarity + 1e-6, "right"))
            if alone:
                lo = max(lo, at)
            radius = first[int(n[at] >= LARGE)]
            for col in range(lo, hi, STEP >> 8):
                last = min(hi, col + (STEP >> 8))
                i, j = np.nonzero(np.bitwise_count(head[at:upto, None] ^ head[None, col:last]) <= radius)
                i, j = i + at, j + col
                keep = (i != j) & (np.bitwise_count(fps[i] ^ fps[j]).sum(1) <= total)
                forest.link(i[keep], j[keep])
        a, b = forest.edges(table.column("id").to_numpy())
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("lo", "hi").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component_id): the smallest key that is reachable by links of ``radius`` bits or fewer.

    One row per row of ``docs``.  Equal fingerprints are compared once, whatever
    the number of rows that share them.  Null keys stay null and name a group only
    if it has no other key.  An empty table gives an empty table.
    """
    rows = materialise(simhash(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), shingle))
    return components_of(rows, radius).withColumnRenamed("doc_id", key)


def components_of(rows: DataFrame, radius: int) -> DataFrame:
    """(doc_id, fp, component_id) for materialised rows (doc_id, fp)."""
    known = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = connected_components(hamming_forest(known.select("fp"), radius))
    named = known.join(links.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = materialise(named)
    first = named.groupBy("component").agg(F.min("least").alias("component_id"))
    label = named.join(first, "component").select("fp", "component_id")
    return rows.join(label, "fp").select("doc_id", "fp", "component_id")


def similar_bits(similarity: float, bits: int) -> float:
    """Expected number of differing bits of two texts with this Jaccard similarity of shingles."""
    return bits * float(np.arccos(2 * similarity / (1 + similarity))) / np.pi


def candidate_bits(similarity: float, bits: int, n: int = 1) -> int:
    """Most differing bits of a candidate: what texts of this similarity differ in, and four standard deviations.

    Sets of four and five shingles differ in 3/16 of the bits at 0.8, more than those of ``LARGE`` and more.
    """
    share = max(similar_bits(similarity, 1), 3 / 16 if n < LARGE else 0.0)
    return int(bits * share + 4 * np.sqrt(bits * share * (1 - share)))


class _Sets:
    """The shingle sets of a task's rows, and the links between them."""

    def __init__(self, table: pa.Table, similarity: float, label: np.ndarray | None = None) -> None:
        data = table.column("shingles").combine_chunks()
        _, offsets, raw = data.cast(pa.large_binary()).buffers()
        at = np.frombuffer(offsets, np.int64)[data.offset : data.offset + len(data) + 1]
        self.at, self.n = (at - at[0]) // 8, np.diff(at) // 8
        kinds, self.codes = np.unique(np.frombuffer(raw, np.uint64, int(self.at[-1]), int(at[0])), return_inverse=True)
        self.mark = np.zeros(len(kinds), bool)
        self.fps, self.similarity = _words_of(table), similarity
        bits = 64 * self.fps.shape[1]
        self.total = candidate_bits(similarity, bits)
        self.forest = Forest(len(self.n))
        if label is not None:  # what is connected already
            _, first, self.forest.label = np.unique(label, return_index=True, return_inverse=True)
            self.forest.label = first[self.forest.label.ravel()]

    def link(self, i: int, js: np.ndarray) -> None:
        """Link row i with those of ``js`` that are similar, candidates only, and none that is connected already."""
        n, at, s = self.n, self.at, self.similarity
        js = js[(self.forest.label[js] != self.forest.label[i]) & (np.minimum(n[js], n[i]) >= s * np.maximum(n[js], n[i]) - 1e-9) & (n[js] > 0)]
        js = js[np.bitwise_count(self.fps[js] ^ self.fps[i]).sum(1) <= self.total]
        if not len(js):
            return
        own = self.codes[at[i] : at[i + 1]]
        self.mark[own] = True
        ends = np.cumsum(n[js])
        for part in np.split(js, np.searchsorted(ends, np.arange(STEP, ends[-1], STEP))):
            if len(part):
                starts = np.cumsum(n[part]) - n[part]
                hits = self.mark[self.codes[np.arange(n[part].sum()) + np.repeat(at[part] - starts, n[part])]]
                shared = np.add.reduceat(hits, starts, dtype=np.int64)
                part = part[shared >= s * (n[part] + n[i] - shared) - 1e-9]
                self.forest.link(np.full(len(part), i), part)
        self.mark[own] = False


_LINKS = "component long, a long, b long"


def _inside(sets: DataFrame, similarity: float) -> DataFrame:
    """(component, a, b): links inside each block of ``sets``, and a row with b null for one text of the block's largest group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["component", "block"]):
            s, ids = _Sets(table, similarity), table.column("id").to_numpy()
            for i in range(len(ids) - 1):
                s.link(i, np.arange(i + 1, len(ids)))
            a, b = s.forest.edges(ids)
            head = ids[int(np.bincount(s.forest.label).argmax())]
            cols = [pa.array(np.full(len(a) + 1, table.column("component")[0].as_py())), pa.array(np.append(a, head)), pa.concat_arrays([pa.array(b), pa.nulls(1, pa.int64())])]
            yield pa.RecordBatch.from_arrays(cols, names=["component", "a", "b"])

    return sets.repartition("component", "block").sortWithinPartitions("component", "block", "id").mapInArrow(run, _LINKS)


def _across(sets: DataFrame, similarity: float) -> DataFrame:
    """(component, a, b): links between the blocks of a component's ``sets`` (with label: what is connected already).

    Labels with many rows have blocks of their own, so pairs of blocks of one label need no comparison.
    """
    large = materialise(sets.groupBy("component", "label").count().where(F.col("count") > ROW_BLOCK // 2))
    named = sets.join(bounded(large), ["component", "label"], "left").withColumn("own", F.when(F.col("count").isNotNull(), F.col("label"))).drop("count")
    size = named.groupBy("component", "own").agg(_blocks().alias("blocks"))
    size = materialise(size.withColumn("key", F.xxhash64("own")))
    mine = named.withColumn("key", F.xxhash64("own")).drop("blocks", "block").join(size.select("component", "key", "blocks"), ["component", "key"])
    mine = mine.withColumn("block", F.pmod(F.xxhash64("id", F.lit(11)), "blocks").cast("int"))
    mine = materialise(mine.withColumn("me", F.struct("key", "block")).drop("key", "block", "blocks"))
    every = size.select("component", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda n: F.struct("key", n.alias("block")))).alias("it"), F.col("own").isNotNull().alias("one"))
    # pairs of a component's blocks, of which there are few; each row goes to those of its own
    dealt = mine.join(materialise(every), "component").where("not one or it.key <> me.key")
    dealt = dealt.withColumns({"lo": F.least("me", "it"), "hi": F.greatest("me", "it"), "second": F.col("me") > F.col("it")}).drop("me", "it", "one", "own")

    def verify(table: pa.Table) -> pa.Table:
        second = table.column("second").to_numpy(zero_copy_only=False)
        alone = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
        a = b = np.zeros(0, np.int64)
        if alone or 0 < second.sum() < len(second):
            s = _Sets(table, similarity, table.column("label").to_numpy())
            right = np.flatnonzero(second)
            before = s.forest.label.copy()
            for i in np.flatnonzero(~second).tolist():
                s.link(i, np.arange(i + 1, len(second)) if alone else right)
            a, b = s.forest.edges(table.column("id").to_numpy())
            new = np.flatnonzero(s.forest.label != np.arange(len(before)))
            keep = s.forest.label[new] != before[new]
            a, b = a[keep], b[keep]
        return pa.table({"component": np.full(len(a), table.column("component")[0].as_py()), "a": a, "b": b})

    return dealt.groupBy("component", "lo", "hi").applyInArrow(verify, _LINKS)


def _blocks() -> Column:
    return F.ceil(F.greatest(F.sum("n") / SET_BLOCK, F.count("*") / ROW_BLOCK)).cast("int")


def _blocked(rows: DataFrame) -> DataFrame:
    """``rows`` (id, component, n, more) with the number of blocks of their component and their own."""
    sizes = materialise(rows.groupBy("component").agg(_blocks().alias("blocks")))
    return rows.join(bounded(sizes), "component").withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), "blocks").cast("int"))


def near_texts(rows: DataFrame, docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, component): texts connected by links of at least this Jaccard similarity of their sets of shingles.

    ``rows`` (id long, fp, more, n, _k1, _k2) are the distinct texts' sketches, ``docs``
    (_k1, _k2, text) has their texts.  Fingerprints only find candidates; texts that
    candidates connect are compared by their shingles in blocks.  What the first pass
    over blocks leaves unconnected is compared across blocks; before that, one text of
    each block is compared with one of every other, so that a large group of near
    copies is connected without meeting itself.  Rows without links aren't returned.
    """
    maybe = materialise(candidate_forest(rows.select("id", "n", "fp", "more"), similarity))
    parts = connected_components(maybe).withColumnRenamed("node", "id")
    maybe = materialise(rows.select("id", "n", "fp", "more", "_k1", "_k2").join(parts, "id"))
    maybe = materialise(_blocked(maybe))
    known = docs.sparkSession.sparkContext.broadcast(hash_map(maybe, "_k1"))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # repeated rows of one task
        for batch in batches:
            keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
            hit = in_map(known.value, keys[0].view(np.uint64))
            for i in np.flatnonzero(hit).tolist():
                key = (int(keys[0][i]), int(keys[1][i]))
                hit[i] = key not in seen
                seen.add(key)
            yield batch.filter(pa.array(hit))

    texts = docs.select("_k1", "_k2", "text").mapInArrow(some, "_k1 long, _k2 long, text string")
    cols = ["id", "component", "block", "blocks", "n", "fp", "more"]
    found = texts.join(bounded(maybe), ["_k1", "_k2"]).select(*cols, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = buffers(batch.column(7))
            sets = [np.unique(shingles(raw[i:j].tobytes(), shingle)).tobytes() for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(sets, pa.binary())], names=[*cols, "shingles"])

    kinds = "id long, component long, block int, blocks int, n long, fp long, more array<long>, shingles binary"
    sets = materialise(found.mapInArrow(run, kinds), known)
    links = [materialise(_inside(sets, similarity))]
    wide = sets.where("blocks > 1")
    if not wide.isEmpty():
        before = None
        while True:
            heads = links[-1].where("b is null").select(F.col("a").alias("id"))
            heads = materialise(_blocked(wide.drop("blocks", "block").join(heads, "id").dropDuplicates(["id"])))
            links.append(materialise(_inside(heads, similarity)))
            number = heads.count()
            if number == before or heads.where("blocks > 1").isEmpty():
                break
            before = number
        so_far = connected_components(_union(links).where("b is not null").select("a", "b"))
        label = so_far.select(F.col("node").alias("id"), F.col("component").alias("label"))
        wide = materialise(wide.join(label, "id", "left").withColumn("label", F.coalesce("label", "id")))
        open_ = wide.groupBy("component").agg((F.min("label") < F.max("label")).alias("open")).where("open").select("component")
        rest = materialise(wide.join(materialise(open_), "component", "left_semi"))
        if not rest.isEmpty():
            links.append(materialise(_across(rest, similarity)))
    return connected_components(_union(links).where("b is not null").select("a", "b")).withColumnRenamed("node", "id")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def hexed(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


__all__ = ["components_of", "fingerprint", "hamming_forest", "hexed", "near_duplicates", "near_texts", "simhash", "sketches", "within"]
