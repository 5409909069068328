"""Writing documents: versioned indices with a pointer to the current one.

In a store of files, an index ``alias`` is a folder with versions ``alias_0``,
``alias_1``, ...  A build claims the next version of each of its indices, writes them, and adds a
file that names all current versions when all of it is there: nothing that is read is ever
replaced, so readers see one build or the other.

In a search engine, versions are indices and the pointer is an alias of it.
"""

from __future__ import annotations

import base64
import json
import ssl
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import UTC, datetime, timedelta
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .functions.types import array_fields, field_mapping
from .model import id_column
from .streaming.gating import stamp


class _Files:
    """Files in whatever store Spark reaches."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *parts: str) -> Any:
        return self.path("/".join((self.root, *parts)))

    def exists(self, *parts: str) -> bool:
        return self.fs.exists(self.at(*parts))

    def names(self, *parts: str) -> list[str]:
        if not self.exists(*parts):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(*parts)))

    def read(self, *parts: str) -> str:
        stream = self.fs.open(self.at(*parts))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, text: str, *parts: str) -> bool:
        """A new file, by a file beside it and a rename; False if it is there already."""
        new = self.at(*parts[:-1], f".{parts[-1]}.{uuid.uuid4().hex}")
        stream = self.fs.create(new, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        done = not self.exists(*parts) and self.fs.rename(new, self.at(*parts))
        if not done:
            self.fs.delete(new, False)
        return bool(done)

    def claim(self, *parts: str) -> bool:
        """Create an empty file; False if somebody else has."""
        self.fs.mkdirs(self.at(*parts[:-1]))
        return bool(self.fs.createNewFile(self.at(*parts)))

    def modified(self, *parts: str) -> float:
        return self.fs.getFileStatus(self.at(*parts)).getModificationTime() / 1000

    def delete(self, *parts: str) -> None:
        self.fs.delete(self.at(*parts), True)


#: How long a build may take: versions that were never made current are failed ones after it.
STALE = timedelta(days=1)


class IndexStore:
    """Indices below a folder, in any of Spark's formats of files.

    Files _current.0, _current.1, ... name the current version of every index; the last one holds.
    A run stages its indices and commits them together, so that readers see all of it or none.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", options: dict[str, str] | None = None) -> None:
        self.spark, self.fmt, self.options = spark, fmt, options or {}
        self.files = _Files(spark, root)

    def versions(self, alias: str) -> list[int]:
        found = (n.rpartition("_") for n in self.files.names(alias))
        return sorted(int(v) for name, _, v in found if name == alias and v.isdigit())

    def _numbers(self, name: str, *parts: str) -> list[int]:
        found = (n.partition(".") for n in self.files.names(*parts))
        return sorted(int(k) for first, _, k in found if first == name and k.isdigit())

    def _generation(self) -> tuple[int, dict[str, str]]:
        """Number and contents of the last file of current versions."""
        while True:
            last = self._numbers("_current")[-1:]
            if not last:
                return -1, {}
            try:
                return last[0], json.loads(self.files.read(f"_current.{last[0]}"))
            except Py4JJavaError:
                if self._numbers("_current")[-1:] == last:
                    raise  # else it went meanwhile, as newer ones came

    def current(self, alias: str) -> str | None:
        name = self._generation()[1].get(alias)
        if name is None and (last := self._numbers("CURRENT", alias)[-1:]):  # of stores in which each index had its own
            name = self.files.read(alias, f"CURRENT.{last[0]}").strip()
        return name

    def manifest(self, alias: str) -> dict[str, Any] | None:
        """Of the current version: its time stamp, field mapping, and array fields."""
        name = self.current(alias)
        return json.loads(self.files.read(alias, f"{name}.json")) if name else None

    def write(self, df: DataFrame, alias: str, doc_type: str, built: datetime | None = None, partitions: int | None = None) -> str:
        """Write the next version and make it the current one; its name is returned."""
        name = self.stage(df, alias, doc_type, built, partitions)
        self.commit({alias: name})
        return name

    def stage(self, df: DataFrame, alias: str, doc_type: str, built: datetime | None = None, partitions: int | None = None, unique: bool = True) -> str:
        """Write the next version, which readers don't see before it is committed; its name is returned."""
        version = max(self.versions(alias), default=-1) + 1
        while not self.files.claim(alias, f".claim_{version}"):
            version += 1
        name = f"{alias}_{version}"
        out = df.repartition(partitions) if partitions else df
        out.write.format(self.fmt).options(**self.options).save(f"{self.files.root}/{alias}/{name}")
        about = {"built": stamp(built or datetime.now(UTC)), "doc_type": doc_type, "arrays": array_fields(df.schema), "staged": True, **field_mapping(df.schema, doc_type)}
        self.files.write(json.dumps(about), alias, f"{name}.json")
        return name

    def commit(self, names: Mapping[str, str]) -> None:
        """Make versions current, those of all indices at one moment; older ones too."""
        for alias, name in names.items():
            if not self.files.exists(alias, name):
                raise FileNotFoundError(f"{alias} has no version {name}")
        while True:
            number, now = self._generation()
            if self.files.write(json.dumps(now | dict(names), sort_keys=True), f"_current.{number + 1}"):
                break  # else somebody else has committed meanwhile
        for alias, name in names.items():
            self.files.claim(alias, f".done_{name.rpartition('_')[2]}")
        for k in self._numbers("_current")[:-2]:  # the one before may be being read
            self.files.delete(f"_current.{k}")

    def point(self, alias: str, name: str) -> None:
        """Move the alias, also back to an older version."""
        self.commit({alias: name})

    def read(self, alias: str) -> DataFrame:
        name = self.current(alias)
        if name is None:
            raise FileNotFoundError(f"no index {alias}")
        return self.spark.read.format(self.fmt).load(f"{self.files.root}/{alias}/{name}")

    def backup(self, alias: str) -> str | None:
        """Copy the current version to the next free backup, ``<n>_<version>``."""
        name = self.current(alias)
        if name is None:
            return None
        taken = [int(n.partition("_")[0]) for n in self.files.names(alias, "backup") if n.partition("_")[0].isdigit()]
        copy = f"{max(taken, default=-1) + 1}_{name}"
        self.read(alias).write.format(self.fmt).save(f"{self.files.root}/{alias}/backup/{copy}")
        return copy

    def failed(self, alias: str, stale: timedelta = STALE) -> list[int]:
        """Versions above the current one that were begun so long ago and never made current."""
        name = self.current(alias)
        now, held = int(name.rpartition("_")[2]) if name else -1, set(self.files.names(alias))
        begun = sorted(int(v) for n in held if n.startswith(".claim_") and (v := n.removeprefix(".claim_")).isdigit() and int(v) > now)
        early = (datetime.now(UTC) - stale).timestamp()
        old = [v for v in begun if f".done_{v}" not in held and self.files.modified(alias, f".claim_{v}") <= early]
        # of stores whose manifests don't tell, all that have one are done
        return [v for v in old if f"{alias}_{v}.json" not in held or json.loads(self.files.read(alias, f"{alias}_{v}.json")).get("staged")]

    def clean(self, alias: str, keep: int = 1, stale: timedelta = STALE) -> list[str]:
        """Delete all but the current and the ``keep`` versions before it, and failed ones above it."""
        name = self.current(alias)
        now = int(name.rpartition("_")[2]) if name else -1
        old = [v for v in self.versions(alias) if v < now][: -keep or None] + self.failed(alias, stale)
        for v in old:
            self.files.delete(alias, f"{alias}_{v}")
            for n in (f"{alias}_{v}.json", f".claim_{v}", f".done_{v}"):
                self.files.delete(alias, n)
        return [f"{alias}_{v}" for v in old]

    def stamps(self, aliases: Iterable[str]) -> list[str | None]:
        """Build times of indices, None where there is none."""
        return [(m or {}).get("built") for m in map(self.manifest, aliases)]


class IncompleteIndex(RuntimeError):
    """An index holds another number of documents than were written."""


class RestClient:
    """The few calls of a search engine's HTTP interface that versions and aliases need.

    With ``user`` and ``password`` each call logs in; ``ca`` is a file of certificates for https, without it the system's count.
    """

    def __init__(self, address: str, user: str | None = None, password: str | None = None, ca: str | None = None, timeout: float = 60.0, every: float = 2.0) -> None:
        self.address, self.timeout, self.every = address.rstrip("/"), timeout, every
        self.headers = {"Content-Type": "application/json"}
        if user is not None:
            self.headers["Authorization"] = "Basic " + base64.b64encode(f"{user}:{password or ''}".encode()).decode()
        self.tls = ssl.create_default_context(cafile=ca) if self.address.startswith("https://") else None

    def call(self, method: str, path: str, body: Any = None, none_for: tuple[int, ...] = (404,)) -> Any:
        """The answer, or None if there is no such thing."""
        data = None if body is None else json.dumps(body).encode()
        request = urllib.request.Request(f"{self.address}/{path}", data, self.headers, method=method)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout, context=self.tls) as answer:
                return json.loads(answer.read() or b"null")
        except urllib.error.HTTPError as e:
            if e.code in none_for:
                return None
            raise

    def indices(self, alias: str) -> list[str]:
        return sorted(self.call("GET", f"{alias}_*") or {})

    def create(self, name: str, mapping: dict[str, Any]) -> bool:
        """False if there is such an index already."""
        try:
            self.call("PUT", name, mapping)
        except urllib.error.HTTPError as e:
            if e.code == 400 and self.call("GET", name) is not None:
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.call("DELETE", name)

    def holders(self, alias: str) -> list[str]:
        """Indices that have the alias."""
        return sorted(self.call("GET", f"_alias/{alias}") or {})

    def point(self, names: Mapping[str, Iterable[str]]) -> None:
        """Give each index its aliases, the first of them taken from all that have it, in one call for all."""
        actions: list[dict[str, Any]] = []
        for name, (alias, *extra) in names.items():
            actions += [{"remove": {"index": i, "alias": alias}} for i in self.holders(alias)]
            actions += [{"add": {"index": name, "alias": a}} for a in (alias, *extra)]
        self.call("POST", "_aliases", {"actions": actions})

    def aliases(self, name: str) -> list[str]:
        return sorted(((self.call("GET", f"{name}/_alias") or {}).get(name) or {}).get("aliases", {}))

    def count(self, name: str) -> int:
        """Documents that a search would see."""
        self.call("POST", f"{name}/_refresh")
        return int(self.call("GET", f"{name}/_count")["count"])

    def created(self, name: str) -> datetime:
        of = self.call("GET", f"{name}/_settings")[name]["settings"]["index"]["creation_date"]
        return datetime.fromtimestamp(int(of) / 1000, UTC)

    def copy(self, source: str, target: str) -> None:
        """Copy all documents: a task of the engine's that is asked for until it is done, however long that takes."""
        task = self.call("POST", "_reindex?wait_for_completion=false", {"source": {"index": source}, "dest": {"index": target}})["task"]
        while not (state := self.call("GET", f"_tasks/{task}") or {"completed": True, "error": "the task is gone"})["completed"]:
            time.sleep(self.every)
        wrong = state.get("error") or (state.get("response") or {}).get("failures")
        if wrong:
            raise IncompleteIndex(f"{target}: {wrong}")
        if (have := self.count(target)) != (want := self.count(source)):
            raise IncompleteIndex(f"{target} has {have} documents of {want}")

    def mapping(self, name: str) -> dict[str, Any]:
        return ((self.call("GET", f"{name}/_mapping") or {}).get(name) or {})


#: Column that holds a document's id on its way to a search engine; it isn't stored.
DOCUMENT_ID = "_document_id"


def identified(df: DataFrame, doc_type: str, unique: bool = True) -> DataFrame:
    """``df`` with an id for each document, so that one that is sent twice is there once.

    It is the document's key and project, or a hash of the row where it has no key.  Where several rows may
    have one key (``unique`` false), they are numbered in the order of their contents.
    """
    key, project = id_column(doc_type), dict(df.dtypes).get("project_id")
    content = F.to_json(F.struct(*df.columns))
    if key not in df.columns:
        return df.withColumn(DOCUMENT_ID, F.sha2(content, 256))
    parts = [F.col(key).cast("string"), *([F.col("project_id")] if project == "string" else [])]
    found = F.when(parts[0].isNull(), F.sha2(content, 256)).otherwise(F.concat_ws("/", *parts))
    if not unique:
        found = F.concat_ws("/", found, F.row_number().over(Window.partitionBy(*parts).orderBy(content)))
    return df.withColumn(DOCUMENT_ID, found)


class SearchStore:
    """Indices of a search engine: documents go through a Spark connector, versions and aliases through ``client``.

    ``write`` gets a frame with DOCUMENT_ID and a resource ``<index>/<doc_type>``; by default it is the connector
    ``fmt`` with ``options``.  The time of a build is a second alias of its index.  Documents have ids, so what a task sends
    again after it has failed replaces what it had sent, and an index is made current only if it has as many
    documents as the tasks that ended well have sent.
    """

    def __init__(self, client: RestClient, fmt: str = "org.elasticsearch.spark.sql", options: dict[str, str] | None = None, write: Callable[[DataFrame, str], None] | None = None) -> None:
        self.client, self.fmt, self.options = client, fmt, options or {}
        self.save = write or self._save
        self._built: dict[str, str] = {}

    def _save(self, df: DataFrame, resource: str) -> None:
        by_id = {"es.mapping.id": DOCUMENT_ID, "es.mapping.exclude": DOCUMENT_ID, "es.write.operation": "index"}
        df.write.format(self.fmt).options(**(by_id | self.options)).mode("append").save(resource)

    def versions(self, alias: str) -> list[int]:
        found = (n.rpartition("_") for n in self.client.indices(alias))
        return sorted(int(v) for name, _, v in found if name == alias and v.isdigit())

    def current(self, alias: str) -> str | None:
        return next(iter(self.client.holders(alias)), None)

    def write(self, df: DataFrame, alias: str, doc_type: str, built: datetime | None = None, partitions: int | None = None) -> str:
        """Create the next version with its field mapping, fill it, and point the alias at it; its name is returned."""
        name = self.stage(df, alias, doc_type, built, partitions)
        self.commit({alias: name})
        return name

    def stage(self, df: DataFrame, alias: str, doc_type: str, built: datetime | None = None, partitions: int | None = None, unique: bool = True) -> str:
        """Create and fill the next version, which readers don't see before it is committed; its name is returned."""
        version = max(self.versions(alias), default=-1) + 1
        while not self.client.create(f"{alias}_{version}", field_mapping(df.schema, doc_type)):
            version += 1  # another build has taken it
        name, sent = f"{alias}_{version}", Observation()
        out = identified(df.repartition(partitions) if partitions else df, doc_type, unique)
        self.save(out.observe(sent, F.count(F.lit(1)).alias("rows")), f"{name}/{doc_type}")
        if (have := self.client.count(name)) != (want := sent.get["rows"]):
            raise IncompleteIndex(f"{name} has {have} documents of {want}")
        self._built[name] = f"time_{stamp(built or datetime.now(UTC))}"
        return name

    def commit(self, names: Mapping[str, str]) -> None:
        """Make versions current, those of all indices in one call."""
        for alias, name in names.items():
            if name not in self.client.indices(alias):
                raise FileNotFoundError(f"{alias} has no version {name}")
        self.client.point({name: [alias, *([self._built[name]] if name in self._built else [])] for alias, name in names.items()})

    def point(self, alias: str, name: str) -> None:
        self.commit({alias: name})

    def backup(self, alias: str) -> str | None:
        """Copy the current version to the next free backup, ``backup_<n>_<version>``."""
        name = self.current(alias)
        if name is None:
            return None
        n = 0
        while self.client.mapping(f"backup_{n}_{name}"):
            n += 1
        self.client.create(f"backup_{n}_{name}", self.client.mapping(name))
        self.client.copy(name, f"backup_{n}_{name}")
        return f"backup_{n}_{name}"

    def failed(self, alias: str, stale: timedelta = STALE) -> list[str]:
        """Versions above the current one that were created so long ago and never made current."""
        name = self.current(alias)
        now, early = int(name.rpartition("_")[2]) if name else -1, datetime.now(UTC) - stale
        above = [f"{alias}_{v}" for v in self.versions(alias) if v > now]
        return [n for n in above if not any(a.startswith("time_") for a in self.client.aliases(n)) and self.client.created(n) <= early]

    def clean(self, alias: str, keep: int = 1, stale: timedelta = STALE) -> list[str]:
        """Delete all but the current and the ``keep`` versions before it, and failed ones above it."""
        name = self.current(alias)
        now = int(name.rpartition("_")[2]) if name else -1
        old = [f"{alias}_{v}" for v in self.versions(alias) if v < now][: -keep or None] + self.failed(alias, stale)
        for v in old:
            self.client.delete(v)
        return old

    def stamps(self, aliases: Iterable[str]) -> list[str | None]:
        """Build times of current versions, None where there is none."""
        found = [self.current(a) for a in aliases]
        return [next((a.removeprefix("time_") for a in self.client.aliases(n) if a.startswith("time_")), None) if n else None for n in found]


def as_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON text; with a key that is named, it stands beside the text and in it, also as node_id."""
    if not key:
        return df.select(F.to_json(F.struct(*df.columns)).alias("document"))
    cols = [c for c in df.columns if c not in (key, "node_id")]
    doc = F.to_json(F.struct(*cols, key, F.col(key).alias("node_id"))).alias("document")
    return df.select(F.col(key).cast("string").alias("key"), doc)


def array_config(df: DataFrame, index: str, built: datetime | None = None) -> DataFrame:
    """One row that tells which fields of an index hold arrays."""
    return df.sparkSession.createDataFrame([(index, sorted(array_fields(df.schema)), stamp(built or datetime.now(UTC)))], "index string, array array<string>, timestamp string")
