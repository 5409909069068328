"""Reading a database in parts, at one moment.

Parts are planned from the catalogue's estimates of rows: ranges of a table's pages
where the database can read those, else ranges of its key with bounds that the database
finds on the key's index.  One moment is an exported snapshot that all connections take up,
or else read locks, for which writers wait until the import is over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from math import ceil
from typing import Any

from pyspark.sql import SparkSession

_INFORMATION = "select table_name from information_schema.tables where table_schema = "


@dataclass(frozen=True)
class Dialect:
    """What differs between databases.

    ``tables`` lists tables, ``rows`` gives a table's estimated rows (and pages), ``one_row`` is what a query of constants
    is taken from, ``quote`` stands around names.  ``numbered`` gives keys with their numbers in order.  ``pages`` is the predicate of a range of pages.  ``export`` gives the
    name of a snapshot that ``take`` takes up in another connection; without it ``lock`` keeps writers out.
    """

    tables: str
    rows: str = "select count(*) as n_rows, 0 as n_pages from {table}"
    one_row: str = ""
    quote: str = '"'
    numbered: str = "select row_number() over (order by {key}) as n, {key} as k from {table} where {key} is not null"
    pages: str | None = None
    export: str | None = None
    take: str = ""
    lock: str | None = None


DIALECTS = {
    "postgresql": Dialect(
        _INFORMATION + "'public'",
        rows="select greatest(reltuples, 0)::bigint as n_rows, relpages as n_pages from pg_class where oid = '{table}'::regclass",
        pages="ctid >= '({lo},0)'::tid and ctid < '({hi},0)'::tid",
        export="select pg_export_snapshot()",
        take="set transaction isolation level repeatable read, read only; set transaction snapshot '{name}'",
    ),
    "mysql": Dialect(_INFORMATION + "database()", rows="select table_rows as n_rows, 0 as n_pages from information_schema.tables where table_schema = database() and table_name = '{table}'", quote="`", lock="lock tables {tables} read"),
    "derby": Dialect(
        "select lower(tablename) as table_name from sys.systables where tabletype = 'T'",
        one_row=" from sysibm.sysdummy1",
        numbered="select row_number() over () as n, k from (select {key} as k from {table} where {key} is not null order by {key}) as a",
        lock="lock table {table} in share mode",
    ),
}
OTHER = Dialect(_INFORMATION + "'public'")


def n_parts(rows: int, rows_per_part: int, most: int) -> int:
    return max(1, min(most, ceil(rows / rows_per_part)))


def page_parts(dialect: Dialect, pages: int, n: int) -> list[str]:
    """Ranges of pages; the last has no end, so that pages the estimate doesn't know are read as well."""
    cuts = sorted({k * pages // n for k in range(n)})
    return [dialect.pages.format(lo=lo, hi=hi) for lo, hi in zip(cuts, [*cuts[1:], (1 << 32) - 1], strict=True)]


def bounds_query(dialect: Dialect, table: str, key: str, step: int) -> str:
    """(n, k): every ``step``-th key and its number, in the database's own order, which its comparisons follow."""
    return f"select n, k from ({dialect.numbered.format(table=table, key=key)}) as b where mod(n, {step}) = 0"


def key_parts(key: str, bounds: Iterable[str]) -> list[str]:
    """Ranges of a key between bounds in order, each in one part; nulls are in the first, and the last has no end."""
    quoted = ["'" + b.replace("'", "''") + "'" for b in dict.fromkeys(bounds)]
    if not quoted:
        return ["1 = 1"]
    inner = [f"{key} > {a} and {key} <= {b}" for a, b in zip(quoted[:-1], quoted[1:], strict=True)]
    return [f"{key} <= {quoted[0]} or {key} is null", *inner, f"{key} > {quoted[-1]}"]


class Moment:
    """Holds a connection, as a context: its readers' properties see all ``tables`` at the moment it is entered."""

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str], dialect: Dialect, tables: Iterable[str]) -> None:
        self.jvm, self.url, self.properties, self.dialect, self.tables = spark._jvm, url, dict(properties), dialect, list(tables)
        self.connection: Any = None

    def __enter__(self) -> dict[str, str]:
        if not self.dialect.export and not self.dialect.lock:
            return {}
        if driver := self.properties.get("driver"):
            self.jvm.java.lang.Class.forName(driver, True, self.jvm.java.lang.Thread.currentThread().getContextClassLoader())
        login = self.jvm.java.util.Properties()
        for k, v in self.properties.items():
            login.setProperty(k, v)
        self.connection = self.jvm.java.sql.DriverManager.getConnection(self.url, login)
        try:
            self.connection.setAutoCommit(False)
            statement = self.connection.createStatement()
            if self.dialect.export:
                statement.execute("set transaction isolation level repeatable read, read only")
                found = statement.executeQuery(self.dialect.export)
                found.next()
                # rows come by the thousand, without which the connection is left before the snapshot is taken up
                return {"fetchsize": self.properties.get("fetchsize", "10000"), "sessionInitStatement": self.dialect.take.format(name=found.getString(1))}
            if "{tables}" in self.dialect.lock:
                statement.execute(self.dialect.lock.format(tables=" read, ".join(self.tables)))
            else:
                for t in self.tables:
                    statement.execute(self.dialect.lock.format(table=t))
        except BaseException:
            self.__exit__()
            raise
        return {}

    def __exit__(self, *_: object) -> None:
        if self.connection is not None:
            self.connection.rollback()
            self.connection.close()
            self.connection = None


Reader = Callable[[str], list]


def plan(read: Reader, dialect: Dialect, table: str, key: str, most: int, rows_per_part: int, still: bool = False) -> list[str]:
    """Predicates of the parts of a table, each row in one of them; ``read`` runs a statement and gives its rows.

    Pages are told apart only if all parts are read from one snapshot (``still``), as a row that changes may move to another; its key stays.
    """
    if most < 2:
        return ["1 = 1"]
    found = read(dialect.rows.format(table=table))
    rows, pages = (int(found[0][0] or 0), int(found[0][1] or 0)) if found else (0, 0)
    n = n_parts(rows, rows_per_part, most)
    if n < 2:
        return ["1 = 1"]
    if still and dialect.pages and pages >= n:
        return page_parts(dialect, pages, n)
    found = sorted((int(r[0]), str(r[1])) for r in read(bounds_query(dialect, table, key, max(1, ceil(rows / n)))))
    return key_parts(key, [k for _, k in found])
