"""Command line: import tables from a database, and build the documents of a mapping file.

python -m docweave.cli --mapping etl.yaml --dictionary schema.json --source dump:/data/graphs --out /data/indices
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from .mapping import load_mappings, load_resource_paths
from .model import GraphModel
from .plans.compiler import auth_plugin, compile_all
from .sinks import IndexStore, RestClient, SearchStore, array_config
from .sources.graph import BAD, DumpSource, GraphSource, JdbcSource, ParquetSource
from .streaming.gating import must_build, transaction_time, watch


def pairs_of(given: Sequence[str]) -> dict[str, str]:
    """``name=value`` by name; ``name=@file`` takes the value from a file, so that passwords needn't be on the command line."""
    out = {}
    for text in given:
        name, found, value = text.partition("=")
        if not found:
            raise ValueError(f"{text} isn't name=value")
        if value.startswith("@"):
            with open(value[1:], encoding="utf-8") as f:
                value = f.read().strip()
        out[name] = value
    return out


def source_of(
    spark: SparkSession, spec: str, model: GraphModel, properties: Mapping[str, str] | None = None, partitions: int = 1, rows_per_part: int = 1_000_000, bad: str = "fail"
) -> GraphSource:
    """``dump:path``, ``parquet:path`` or a JDBC address."""
    kind, _, path = spec.partition(":")
    if kind == "jdbc":
        return JdbcSource(spark, spec, model, properties, partitions, rows_per_part=rows_per_part, bad=bad)
    return {"dump": DumpSource, "parquet": ParquetSource}[kind](spark, path, model, bad)


def store_of(spark: SparkSession, out: str, fmt: str, options: Mapping[str, str] | None = None) -> IndexStore | SearchStore:
    """A folder, or a search engine by its address (``http://host:port``) with the connector ``fmt``.

    Of ``options``, user, password and ca are the engine's login and certificates, for the connector too; all others go to the writer.
    """
    more = dict(options or {})
    if not out.startswith(("http://", "https://")):
        return IndexStore(spark, out, fmt, more)
    scheme, _, host = out.partition("://")
    name, _, port = host.rstrip("/").partition(":")
    user, password, ca = (more.pop(k, None) for k in ("user", "password", "ca"))
    login = {"es.net.http.auth.user": user, "es.net.http.auth.pass": password or ""} if user else {}
    tls = {"es.net.ssl": "true"} if scheme == "https" else {}
    found = {"es.nodes": name, "es.port": port or "9200", "es.nodes.wan.only": "true"} | login | tls | more
    return SearchStore(RestClient(out, user, password, ca), *([fmt] if fmt != "parquet" else []), options=found)


def main(argv: Sequence[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--mapping", required=True)
    p.add_argument("--dictionary", required=True, help="JSON schemas of the graph's node types by label")
    p.add_argument("--source", required=True)
    p.add_argument("--out", required=True, help="folder of indices, or the address of a search engine")
    p.add_argument("--step", choices=("import", "transform", "all"), default="all")
    p.add_argument("--import-to", help="folder for tables copied from a database")
    p.add_argument("--transactions", help="Parquet log of transactions; nothing is built if all indices are newer")
    p.add_argument("--resources", help="YAML: users and rights, for access paths by project")
    p.add_argument("--format", default="parquet")
    p.add_argument("--config", help="index that tells which fields are arrays; written with each build")
    p.add_argument("--keep", type=int, default=1, help="old versions of an index that stay after a build")
    p.add_argument("--watch", help="checkpoint folder: build for each new transaction that is in --transactions, instead of once")
    p.add_argument("--every", help="with --watch: go on for ever, looking again after this time")
    p.add_argument("--force", action="store_true")
    p.add_argument("--partitions", type=int, default=1, help="parts that a table of a database is read in, at most")
    p.add_argument("--rows-per-part", type=int, default=1_000_000)
    p.add_argument("--property", action="append", default=[], metavar="NAME=VALUE", help="login and options of the database; VALUE may be @file")
    p.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="options of the writer; user, password and ca of a search engine")
    p.add_argument("--bad", choices=BAD, default="fail", help="records that can't be read end the build, or are left out")
    p.add_argument("--quarantine", help="folder for the bad records of a dump")
    p.add_argument("--bypass-multiplicity", action="store_true")
    p.add_argument("--selective", action="store_true", help="filters of documents leave few: find these first and start all else from them")
    args = p.parse_args(argv)
    if args.watch and not args.transactions:
        p.error("--watch needs --transactions")
    spark = SparkSession.builder.appName("docweave").getOrCreate()
    with open(args.dictionary, encoding="utf-8") as f:
        model = GraphModel.from_dictionary(json.load(f))
    docs = load_mappings(args.mapping)
    source = source_of(spark, args.source, model, pairs_of(args.property), args.partitions, args.rows_per_part, args.bad)
    if args.quarantine and isinstance(source, DumpSource):
        for table, n in sorted(source.quarantine(args.quarantine).items()):
            print(f"{table}: {n} bad records")
    if args.import_to and args.step in ("import", "all"):
        for table, n in source.export(args.import_to).items():
            print(f"{table}: {n} rows")
        source = ParquetSource(spark, args.import_to, model, args.bad)
    if args.step == "import":
        return 0
    store = store_of(spark, args.out, args.format, pairs_of(args.option))
    overrides = load_resource_paths(args.resources)

    def build(*_: object) -> None:
        now, kept, arrays = datetime.now(UTC), [], None
        found = compile_all(source, docs, (auth_plugin(overrides),), args.bypass_multiplicity, kept, args.selective)
        names = {}
        for d, (doc_type, df) in zip(docs, found.items(), strict=True):
            names[d.name] = store.stage(df, d.name, doc_type, now, unique=not args.bypass_multiplicity)
            row = array_config(df, d.name, now)
            arrays = row if arrays is None else arrays.unionByName(row)
        if args.config and arrays is not None:
            names[args.config] = store.stage(arrays, args.config, "array_config", now)
        store.commit(names)  # readers see the whole build or none of it
        for name in [d.name for d in docs] + ([args.config] if args.config else []):
            store.clean(name, args.keep)
        for df in kept:
            df.unpersist()

    if args.watch:
        log = spark.readStream.schema(spark.read.parquet(args.transactions).schema).parquet(args.transactions)
        watch(log, build, args.watch, every=args.every).awaitTermination()
    elif not args.transactions or must_build(store.stamps(d.name for d in docs), transaction_time(spark.read.parquet(args.transactions)), args.force):
        build()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
