"""Secret scans: all rules in one deterministic automaton, one pass over the bytes of each text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .automaton import Automaton
from .common import buffers


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches with fewer than ``least`` characters are dropped.

    With ``group``, which must be the run at the pattern's end, its characters are counted.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("code_host", r"gh[opsru]_[A-Za-z0-9]+", 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("maps", r"AIza[A-Za-z0-9_-]+", 39),
)
RULES = BASE + MORE


@lru_cache(maxsize=4)
def automaton(rules: tuple[Rule, ...] = RULES) -> Automaton:
    return Automaton([(r.pattern, r.any_case, r.least) for r in rules])


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules, self.auto = rules, automaton(rules)

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule number) in code points, by start and rule."""
        found = []
        for start, end, k, first in self.auto.spans(data):
            rule = self.rules[k]
            # the run at the end of a pattern is where it first matches
            if end - (first if rule.group else start) >= rule.least:
                found.append((start, end, k))
        if found and not data.isascii():
            chars = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
            found = [(int(chars[a]), int(chars[b]), k) for a, b, k in found]
        return found


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` and with ``found``: array of (kind, start, end), code points, end exclusive.

    Sorted by start, then by the order of the rules.  Null and empty texts have
    none.  Every row is scanned by itself, so repeated rows and null keys need no care.  Other columns stay but
    for one named ``found``, which is replaced; an empty table gives an empty table.
    """
    keep = [c for c in docs.columns if c not in (text, "found")]
    scanner = Scanner(rules)
    names = [r.kind for r in rules]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = buffers(batch.column(batch.num_columns - 1))
            found = [[{"kind": names[k], "start": i, "end": j} for i, j, k in scanner.spans(raw[a:b].tobytes())] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, kind)], names=[*keep, "found"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, text).mapInArrow(run, f"{fields}{', ' if fields else ''}found array<struct<kind:string,start:bigint,end:bigint>>")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", mark: str = "[{kind}]") -> DataFrame:
    """``docs`` with each span in ``text`` replaced by a mark of its kind; overlapping spans become one.

    A length column ``n_chars`` is kept true.  Rows without secrets stay as they
    are; null texts stay null.
    """
    scanner, cols, count = Scanner(rules), docs.columns, "n_chars" in docs.columns
    where = cols.index(text)

    def clean(data: str | None) -> str | None:
        if not data or not (spans := scanner.spans(data.encode())):
            return data
        out, done = [], 0
        for i, j, k in spans:
            if i >= done:
                out += [data[done:i], mark.format(kind=scanner.rules[k].kind)]
            done = max(done, j)
        return "".join([*out, data[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(where).to_pylist()
            new = [clean(t) for t in old]
            arrays = list(batch.columns)
            arrays[where] = pa.array(new, pa.string())
            if count:
                at = cols.index("n_chars")
                sizes = [len(b) if b is not None and b != a else n for a, b, n in zip(old, new, arrays[at].to_pylist(), strict=True)]
                arrays[at] = pa.array(sizes, arrays[at].type)
            yield pa.RecordBatch.from_arrays(arrays, names=cols)

    return docs.mapInArrow(run, docs.schema)
