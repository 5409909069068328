"""Toxicity by a subsequence string kernel machine with Nyström landmarks.

The kernel counts the common subsequences of ``LENGTH`` characters of two
fragments, also gapped ones, each weighing ``DECAY`` for every character it skips
on either side; subsequences that skip more than ``GAPS`` characters or end with two
gaps between words are left out.  A linear support vector machine is trained on the Nyström features of
labelled fragments.  Its decision is a weighted sum of kernels with landmarks and
so a sum of one weight for each subsequence of a fragment; these weights are
tabulated, and a whole text is scored in one pass over its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks
from .mixing import HASH_BITS, hash_of

LENGTH, GAPS, DECAY = 4, 3, 0.8
#: Characters of a window, the unit that is scored; a sentence is cut into windows at its words, and inside runs longer than a window at every letter.
WINDOW = 10
#: Toxic rows that the machine is trained on, about, at most, and twice as many others; chosen by hash.
SAMPLE_ROWS = 1_500
#: Longer texts aren't used for training.
TRAIN_CHARS = 20_000
LANDMARKS = 512
SYMBOLS = 40
#: Occurrences in one text that count in training, and how much more frequent in toxic texts a window of others must be to be blamed.
OFTEN, RATHER = 3, 4.0
#: Windows of a toxic text that are blamed at most in each round, and their share of the highest value at least.
BLAMED, BLAMED_SHARE = 12, 0.2
#: Share of the empty window among others, so that it is never toxic.
EMPTY = 0.05
#: Different windows that are blamed at most, the most frequent ones.
MOST_BLAMED = 3_000
#: Windows whose subsequences are held at a time in training.
STEP = 20_000

#: Positions of a subsequence after its first character, and the weight of the gaps.
OFFSETS = tuple((o, DECAY ** (o[-1] - LENGTH + 1)) for o in combinations(range(1, LENGTH + GAPS), LENGTH - 1))


def _symbols() -> np.ndarray:
    """Symbol of each byte: gap 0, letters 1 to 26, digits as the letters they stand for, others 27 to 39."""
    to = np.zeros(256, np.uint8)
    to[65:91] = to[97:123] = np.arange(1, 27)
    for digit, letter in zip(b"013457", b"oieast", strict=True):
        to[digit] = letter - 96
    to[128:192] = 27 + np.arange(64) % 13  # second bytes tell letters of one alphabet apart
    to[192:] = 255  # first bytes are dropped
    return to


_TO = _symbols()


def encode(at: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all rows and their offsets; upper case counts as lower, runs of other characters as one gap.

    Every row starts with a gap and ends with as many as a window is long, so that
    no window of it reaches the next row.
    """
    text = raw.copy()
    upper = np.flatnonzero((text[1:] >= 0x80) & (text[1:] < 0x9F) & (text[:-1] == 0xC3)) + 1
    text[upper] += 0x20  # upper case letters of Latin-1, as the lower ones
    rows = len(at) - 1
    s = np.zeros(len(raw) + 2 * rows, np.uint8)
    place = np.arange(len(raw)) + 1 + 2 * np.repeat(np.arange(rows), np.diff(at))
    s[place] = _TO[text]
    edge = at + 2 * np.arange(rows + 1)
    keep = s != 255
    real = np.where(keep, s, 1)
    gap = s == 0
    last = np.zeros(len(s), bool)
    # a gap after a gap of the same row goes; first bytes between them don't occur
    last[1:] = gap[1:] & gap[:-1]
    last[edge[:-1][edge[:-1] < len(s)]] = False
    keep &= ~last
    counts = np.concatenate([[0], np.cumsum(keep)])
    ends = counts[edge]
    size = ends[-1] + rows * WINDOW
    out = np.zeros(size, np.uint8)
    out[np.arange(ends[-1]) + WINDOW * np.repeat(np.arange(rows), np.diff(ends))] = real[keep]
    return out, ends + WINDOW * np.arange(rows + 1)


def encode_long(raw: np.ndarray, size: int = CHUNK_BYTES) -> np.ndarray:
    """Symbols of one text as ``encode`` gives them, made from parts of about ``size`` bytes, so that little more than the symbols is held."""
    parts, lo, gap = [], 0, _TO == 0
    while lo < len(raw):
        hi = min(len(raw), lo + size)
        while hi < len(raw) and hi > lo + 1 and raw[hi] & 0xC0 == 0x80:  # characters stay whole
            hi -= 1
        part = encode(np.array([0, hi - lo]), raw[lo:hi])[0][:-WINDOW]
        # of the gaps that encode puts around a part, those stay that are in the text, once each
        first = int(lo > 0 and bool(not gap[raw[lo]] or gap[raw[lo - 1]]))
        last = int(hi < len(raw) and not gap[raw[hi - 1]])
        parts.append(part[first : len(part) - last])
        lo = hi
    return np.concatenate([*parts, np.zeros(WINDOW, np.uint8)]) if parts else encode(np.array([0, 0]), raw)[0]


def codes(s: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """Code of the subsequence at these offsets from every position on; beyond the end are gaps."""
    out = s.astype(np.int32)
    for o in offsets:
        out *= SYMBOLS
        out[: max(0, len(s) - o)] += s[o:]
    return out


#: A window counts in part as a hit from a decision of EDGE up to UNSURE more; hits and words that every text has from the outset.
EDGE, UNSURE, PRIOR_HITS, PRIOR_WORDS = 0.4, 0.3, 0.02, 10


def _hit(value: np.ndarray) -> np.ndarray:
    return np.clip((value - EDGE) / UNSURE, 0, 1)


@dataclass(frozen=True)
class Machine:
    """Weights of subsequences, the bias, and the calibration: what a text's evidence weighs, and where the middle is;
    and the same for its best window alone, as one window may be enough in a text of any length."""

    table: np.ndarray
    bias: float
    weights: tuple[float, float] = (0.0, 0.0)
    middle: float = 0.0
    alone: tuple[float, float] = (0.0, 20.0)

    def windows(self, s: np.ndarray) -> np.ndarray:
        """Decision of the window that starts at each position, over the subsequences that stay inside it."""
        n, total = len(s), np.full(len(s), self.bias)
        for last in sorted({o[-1] for o, _ in OFFSETS}):
            each = np.zeros(n, np.float32)
            for o, weight in OFFSETS:
                if o[-1] == last:
                    each += np.float32(weight) * self.table[codes(s, o)]
            sums = np.concatenate([[0.0], np.cumsum(each, dtype=np.float64)])
            total += sums[np.minimum(np.arange(n) + WINDOW - last, n)] - sums[:n]
        return total

    def best(self, s: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The evidence of each row: the highest decision of its windows, and the log of the share of words that are hits.

        Windows start at a word, inside a long run, or at the start of the row.
        """
        rows = len(at) - 1
        if not rows:
            return np.zeros((0, 2))
        value = self.windows(s)
        lead = np.zeros(len(s), bool)
        lead[_starts(s)] = True
        lead[at[:-1]] = True
        top = np.maximum.reduceat(np.where(lead, value, -np.inf), at[:-1])
        words = np.maximum(1, np.diff(at) - WINDOW - np.add.reduceat(s > 0, at[:-1], dtype=np.int64))  # gaps
        hits = np.add.reduceat(np.where(lead, _hit(value), 0), at[:-1])
        spelled, ends, row = _spelled(s, at)
        if len(row):
            value = self.windows(spelled)
            found = np.maximum.reduceat(value, ends[:-1])
            np.maximum.at(top, row, found)
            np.add.at(hits, row, _hit(found))
        return np.column_stack([np.clip(top, -3, 3), np.log((hits + PRIOR_HITS) / (words + PRIOR_WORDS))])

    def best_long(self, s: np.ndarray, size: int = CHUNK_BYTES) -> np.ndarray:
        """As ``best`` for one text of any length (symbols of ``encode_long``), ``size`` windows at a time."""
        top, hits = -np.inf, 0.0
        words = max(1, len(s) - WINDOW - int(np.count_nonzero(s)))  # gaps
        for lo in range(0, len(s), size):
            hi = min(len(s), lo + size)
            value = self.windows(s[lo : hi + WINDOW])[: hi - lo][_leads(s, lo, hi)]
            if len(value):
                top, hits = max(top, float(value.max())), hits + float(_hit(value).sum())
        spelled, ends, row = _spelled(s, np.array([0, len(s)]))
        found = np.full(len(row), -np.inf)
        for lo in range(0, len(spelled), size):
            hi = min(len(spelled), lo + size)
            value = self.windows(spelled[lo : hi + WINDOW])[: hi - lo]
            k = np.arange(np.searchsorted(ends, lo, "right") - 1, np.searchsorted(ends, hi, "left"))
            np.maximum.at(found, k, np.maximum.reduceat(value, np.maximum(ends[k] - lo, 0)))
        if len(row):
            top, hits = max(top, float(found.max())), hits + float(_hit(found).sum())
        return np.array([[np.clip(top, -3, 3), np.log((hits + PRIOR_HITS) / (words + PRIOR_WORDS))]])

    def score(self, best: np.ndarray) -> np.ndarray:
        value = np.maximum(best @ np.array(self.weights) - self.middle, best[:, 0] * self.alone[0] - self.alone[1])
        return 1 / (1 + np.exp(-np.clip(value, -30, 30)))

    def scores(self, at: np.ndarray, raw: np.ndarray, size: int = CHUNK_BYTES) -> np.ndarray:
        """Scores of the texts of a chunk; one of more than ``size`` bytes comes alone and is worked on in parts."""
        if len(raw) > size and len(at) == 2:
            return self.score(self.best_long(encode_long(raw, size), size))
        return self.score(self.best(*encode(at, raw)))


def _rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = [t.encode("utf-8", "replace") for t in texts]
    at = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    return encode(at, np.frombuffer(b"".join(data), np.uint8))


def _parts_of(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """First number and texts of runs of about a chunk's size."""
    start, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size > CHUNK_BYTES // 2 or k == len(texts) - 1:
            yield start, texts[start : k + 1]
            start, size = k + 1, 0



def _starts(s: np.ndarray) -> np.ndarray:
    """Where windows start: before every run, and at each letter of a run that is longer than a window until one reaches its end."""
    gaps = np.flatnonzero(s == 0)
    size = np.diff(gaps)
    many = np.where(size > WINDOW, size - WINDOW + 2, size > 1).astype(np.int64)
    return np.arange(many.sum()) + np.repeat(gaps[:-1] - (np.cumsum(many) - many), many)


def _leads(s: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Whether a window starts at each position from ``lo`` to ``hi`` of one text: as ``_starts`` says, and at the start of the text."""
    near = np.concatenate([np.zeros(int(lo == 0), np.uint8), s[max(lo - 1, 0) : hi + WINDOW]])
    gap = np.concatenate([near == 0, np.ones(WINDOW + 1, bool)])
    seen = np.concatenate([[0], np.cumsum(gap, dtype=np.int32)])
    p = np.arange(1, 1 + hi - lo)
    inside = (seen[p + WINDOW - 1] == seen[p]) & ~(gap[p - 1] & gap[p + WINDOW - 1])
    out = np.where(gap[p], ~gap[p + 1], inside)
    out[: int(lo == 0)] = True
    return out


def _spelled(s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words that are spelled with a gap after every letter, without these gaps: symbols and offsets as of encode, and their rows."""
    gaps = np.flatnonzero(s == 0)
    one = np.concatenate([[False], np.diff(gaps) == 2, [False]])
    edge = np.flatnonzero(one[1:] != one[:-1]).reshape(-1, 2)
    edge = edge[edge[:, 1] - edge[:, 0] >= LENGTH]
    n = edge[:, 1] - edge[:, 0]
    ends = np.concatenate([[0], np.cumsum(n + 1 + WINDOW)])
    out = np.zeros(ends[-1], np.uint8)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(ends[:-1] + 1, n) + k] = s[gaps[np.repeat(edge[:, 0], n) + k] + 1]
    return out, ends, np.searchsorted(at, gaps[edge[:, 0]], "right") - 1


def _windows_of(s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of every row that start at a word or inside a long run (as rows of symbols, gaps after the end), those of spelled words too, and their rows."""
    starts = _starts(s)
    row = np.searchsorted(at, starts, "right") - 1
    words, ends, of = _spelled(s, at)
    more = _starts(words)
    row = np.concatenate([row, of[np.searchsorted(ends, more, "right") - 1]])
    w = np.concatenate([s[starts[:, None] + np.arange(WINDOW)], words[more[:, None] + np.arange(WINDOW)]])
    order = np.argsort(row, kind="stable")
    return w[order], row[order]


def _packed(w: np.ndarray) -> np.ndarray:
    """Windows (rows of symbols) as one number each."""
    out = np.zeros(len(w), np.int64)
    for k in range(WINDOW):
        out *= SYMBOLS
        out += w[:, k]
    return out


def _unpacked(codes_: np.ndarray) -> np.ndarray:
    out = np.empty((len(codes_), WINDOW), np.uint8)
    for k in reversed(range(WINDOW)):
        codes_, out[:, k] = np.divmod(codes_, SYMBOLS)
    return out


def _features(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights of all subsequences inside windows; places that leave the window weigh 0."""
    wide = np.concatenate([w, np.zeros((len(w), LENGTH + GAPS), np.uint8)], 1).astype(np.int32)
    parts, weights = [], []
    for o, weight in OFFSETS:
        n = WINDOW - o[-1]
        if n <= 0:
            continue
        c = wide[:, :n]
        for x in o:
            c = c * SYMBOLS + wide[:, x : x + n]
        parts.append(c)
        weights += [weight] * n
    return np.concatenate(parts, 1), np.array(weights, np.float32)


def _kernels(codes_: np.ndarray, weights: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Kernel of each window with each landmark (rows of codes)."""
    out = np.empty((len(codes_), len(marks)), np.float32)
    table = np.zeros(SYMBOLS**LENGTH, np.float32)
    for j, m in enumerate(marks):
        np.add.at(table, m, weights)
        table[:: SYMBOLS**2] = 0
        out[:, j] = table[codes_] @ weights
        table[m] = 0
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1_000.0, steps: int = 60) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps; y is 1 or -1."""
    w = np.zeros(x.shape[1] + 1)
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        on = np.flatnonzero(y * (x @ w[:-1].astype(x.dtype) + w[-1]) < 1)
        h, g = ridge.copy(), np.zeros(len(w))
        for part in np.array_split(on, 1 + len(on) // 2_000):
            some, c = np.column_stack([x[part].astype(np.float64), np.ones(len(part))]), weight[part] * penalty
            h += (some * c[:, None]).T @ some
            g += some.T @ (c * y[part])
        new = np.linalg.solve(h, g)
        if np.allclose(new, w, rtol=1e-6, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def _loosened(w: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The same windows with gaps, and with a chance character, put into their words, and joined behind one, cut to size."""
    out = np.zeros((3 * len(w), w.shape[1]), w.dtype)
    for k in range(len(out)):
        row = w[k // 3]
        first = int(row[0] == 0)  # inside a long run there is no gap before
        end = 1 + int(np.argmax(row[1:] == 0)) if (row[1:] == 0).any() else len(row)
        if k % 3 == 2:
            out[k] = row
            out[k, 0] = int(rng.integers(1, 27))
            if end < len(row):
                out[k, end:] = rng.integers(1, 27, len(row) - end)
            continue
        if k % 3:
            word = [x for c in row[first:end] for x in (c, 0)]
        else:
            at = int(rng.integers(2, max(3, end)))
            word = [*row[first:at], int(rng.integers(1, 27)), *row[at:end]]
        word = [0, *word][:WINDOW]
        out[k, : len(word)] = word
    return out


def train(texts: list[str], toxic: list[int], rounds: int = 3, seed: int = 1) -> Machine:
    """Machine for labelled texts.

    A label holds for some window of a toxic text and for most windows of others.
    The first guess at the windows to blame is by how often their subsequences
    occur in texts of either label; each round trains the machine and picks again.
    A window that occurs in other texts too is to blame only if it is far more frequent
    in toxic ones.  A quarter of the texts calibrates the score only.
    """
    y = np.array(toxic) > 0
    if not y.any() or y.all():
        return Machine(np.zeros(SYMBOLS**LENGTH, np.float32), 0.0, middle=-20.0 if y.any() else 20.0)
    rng = np.random.default_rng(seed)
    held = np.zeros(len(y), bool)
    for own in (np.flatnonzero(y), np.flatnonzero(~y)):
        held[own[3::4]] = True
    if not held[y].any() or not held[~y].any():
        held[:] = False
    fit = np.flatnonzero(~held)
    found = [(_packed(w), row.astype(np.int32) + np.int32(first)) for first, part in _parts_of([texts[i] for i in fit]) for w, row in [_windows_of(*_rows(part))]]
    w, row = (np.concatenate(x) for x in zip(*found, strict=True))
    del found
    yes = y[fit][row]
    counts = {label: np.zeros(SYMBOLS**LENGTH, np.float32) for label in (True, False)}
    for part in np.array_split(np.arange(len(fit)), max(1, len(w) // STEP)):  # whole texts, so that each counts once
        rows = np.arange(np.searchsorted(row, part[0]), np.searchsorted(row, part[-1], "right")) if len(part) else part
        dense = _features(_unpacked(w[rows]))[0][:, : WINDOW - LENGTH + 1]  # subsequences without gaps come first
        pairs, times = np.unique(row[rows].astype(np.int64).repeat(dense.shape[1]) * SYMBOLS**LENGTH + dense.ravel(), return_counts=True)
        label = y[fit][pairs // SYMBOLS**LENGTH]
        for k, into in counts.items():
            np.add.at(into, pairs[label == k] % SYMBOLS**LENGTH, np.minimum(times[label == k], OFTEN))
    in_yes, in_no = counts[True], counts[False]
    w, back = np.unique(w, return_inverse=True)
    back = back.ravel().astype(np.int32)
    n_yes, n_no = max(1, y[fit].sum()), max(1, (~y[fit]).sum())
    # the log of the ratio less two standard deviations, so that rare ones don't win by chance
    odds = np.log((in_yes + 0.5) / (n_yes + 1)) - np.log((in_no + 0.5) / (n_no + 1)) - 2 * np.sqrt(1 / (in_yes + 0.5) + 1 / (in_no + 0.5))
    odds[in_yes < 3] = 0
    odds[:: SYMBOLS**2] = 0

    def valued(table: np.ndarray, features: int | None, weights: np.ndarray | float) -> np.ndarray:
        """Sum of the table over the features of all windows."""
        parts = np.array_split(w, max(1, len(w) // STEP))
        return np.concatenate([(table[_features(_unpacked(x))[0][:, :features]] * weights).sum(1) for x in parts])

    weights = _features(_unpacked(w[:0]))[1]
    value = valued(odds, WINDOW - LENGTH + 1, 1.0)
    del counts, in_yes, in_no, odds
    # occurrences of each window in texts of either label, a text's up to OFTEN
    pairs, times = np.unique(row.astype(np.int64) * len(w) + back, return_counts=True)
    kind, label = pairs % len(w), y[fit][pairs // len(w)]
    seen = {k: np.bincount(kind[label == k], np.minimum(times[label == k], OFTEN), len(w)) for k in (True, False)}
    del pairs, times, kind, label
    clean = seen[False] > 0
    spared = clean & (seen[True] / n_yes < RATHER * seen[False] / n_no)
    del seen
    machine = None
    for _ in range(rounds):
        score = np.where(spared, -np.inf, value)[back]
        blame = []
        for r in np.unique(row[yes]):
            own = np.arange(np.searchsorted(row, r), np.searchsorted(row, r, "right"))
            pick = own[np.argsort(-score[own], kind="stable")[:BLAMED]]
            blame += [p for p in pick[np.isfinite(score[pick])].tolist() if p == pick[0] or score[p] > BLAMED_SHARE * score[pick[0]]]
        good, often = np.unique(back[blame], return_counts=True)
        if len(good) > MOST_BLAMED:
            first = np.sort(np.argsort(-often, kind="stable")[:MOST_BLAMED])
            good, often = good[first], often[first]
        no = np.flatnonzero(clean)
        hard = no[np.argsort(-value[no], kind="stable")[:3_000]]
        rest = rng.choice(no, min(len(no), 5_000), replace=False)
        bad = np.unique(np.concatenate([hard, rest]))
        near_good, near_bad = _features(_unpacked(w[good]))[0], _features(_unpacked(np.append(w[bad], 0)))[0]  # and an empty one
        x = np.concatenate([near_good, _features(_loosened(_unpacked(w[good]), rng))[0], near_bad])
        label = np.concatenate([np.ones(4 * len(good)), -np.ones(len(bad) + 1)])
        many = np.concatenate([often, np.repeat(0.25 * often, 3), np.ones(len(bad)), [EMPTY * len(bad)]]).astype(np.float64)
        many[label > 0] *= len(bad) / many[label > 0].sum()
        order = np.argsort(-often, kind="stable")
        marks = np.concatenate([near_good[order[: LANDMARKS * 3 // 4]], near_bad[rng.choice(len(bad), min(len(bad), LANDMARKS // 4), replace=False)]])
        k_mm = _kernels(marks, weights, marks).astype(np.float64)
        vals, vecs = np.linalg.eigh(k_mm)
        use = vals > 1e-6 * vals[-1]
        root = vecs[:, use] / np.sqrt(vals[use])
        scale = float(np.sqrt(np.mean(weights**2) * len(weights)))
        to = (root / scale).astype(np.float32)
        v, bias = _svm(np.concatenate([_kernels(part, weights, marks) @ to for part in np.array_split(x, 8)]), label, many / len(many))
        alpha = root @ v / scale
        table = np.zeros(SYMBOLS**LENGTH, np.float32)
        for a, m in zip(alpha, marks, strict=True):
            np.add.at(table, m, np.float32(a) * weights)
        table[:: SYMBOLS**2] = 0
        machine = Machine(table, bias)
        value = valued(table, None, weights) + bias
    use = np.flatnonzero(held) if held.any() else fit
    best = np.concatenate([machine.best(*_rows(part)) for _, part in _parts_of([texts[i] for i in use])])
    (slope,), middle = _calibrated(best[:, :1], y[use])
    if not y[use].all():  # alone, a window must exceed those of all other texts
        middle = max(middle, slope * float(best[~y[use], 0].max()))
    return Machine(machine.table, machine.bias, *_calibrated(best, y[use]), (slope, middle))


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Weights of the evidence, none of them negative, and the middle of a sigmoid, by Newton steps on smoothed labels.

    A label weighs in all as the root of its number, so that a rare one isn't lost among errors of the other.
    """
    n1, n0 = y.sum(), (~y).sum()
    use = np.ones(x.shape[1], bool)
    if not n1 or not n0:
        return tuple(np.ones(x.shape[1]).tolist()), 0.0
    t = np.where(y, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    much = np.where(y, np.sqrt(n0 / n1), 1.0)
    spread = np.where(x.std(0) > 0, x.std(0), 1.0)
    while True:
        z = np.column_stack([(x - x.mean(0)) / spread * use, np.ones(len(x))])
        w = np.zeros(z.shape[1])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            g = z.T @ (much * (p - t)) + 1e-3 * w
            h = (z * (much * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(len(w))
            step = np.linalg.solve(h, g)
            w -= np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        if (w[:-1] >= 0).all():
            break
        use &= w[:-1] >= 0
    weights = w[:-1] * use / spread
    return tuple(weights.tolist()), float(weights @ x.mean(0) - w[-1])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, key: str = "doc_id") -> Machine:
    """Machine from documents (key, text) and labels (key, toxic), on about ``sample_rows`` toxic rows and twice as many others at most.

    Rows with a null key, text or label, and texts of more than ``TRAIN_CHARS``
    characters, aren't used.  The rows are chosen by the hash of the key.
    """
    known = labels.where(f"`{key}` is not null and toxic is not null").select(F.col(key).alias("key"), (F.col("toxic") > 0).cast("int").alias("toxic")).distinct()
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    upto = {t: int(min(1.0, (2 - t) * sample_rows / n) * (1 << HASH_BITS)) for t, n in sizes.items()}
    limit = F.when(F.col("toxic") == 1, upto.get(1, 0)).otherwise(upto.get(0, 0))
    hashed = hash_of(F.col("key"))
    chosen = known.where(hashed < limit).orderBy(hashed, "key", "toxic").limit(4 * sample_rows)
    rows = docs.select(F.col(key).alias("key"), "text").where(f"length(text) <= {TRAIN_CHARS}").join(F.broadcast(chosen), "key")
    # repeated rows are one; of a key's several texts those with the least hashes are used
    rows = rows.groupBy("key", "toxic", F.xxhash64("text").alias("mark")).agg(F.first("text").alias("text"))
    rows = rows.orderBy(F.xxhash64("key", "mark"), "toxic").limit(4 * sample_rows).collect()
    rows.sort(key=lambda r: (r["key"], r["text"], r["toxic"]))
    return train([r["text"] for r in rows], [r["toxic"] for r in rows])


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` and with score (0 to 1) of the whole text, from its best window and the share of its words that are hits.

    Null and empty texts score as a window of nothing does; long ones are worked on in parts, windows across parts included.  Rows are scored one by one, repeated ones too, and other
    columns stay but for one named ``score``, which is replaced; an empty table gives an empty table.
    """
    keep = [c for c in docs.columns if c not in (text, "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, at, raw in chunks(batch.column(batch.num_columns - 1)):
                found = machine.scores(at, raw)
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found)], names=[*keep, "score"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    return docs.select(*keep, text).mapInArrow(run, f"{fields}score double")
