"""One query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, secrets, toxicity
from .centroids import cluster
from .common import read
from .decontaminate import contamination
from .lines import line_digests
from .mixing import mix
from .pivots import near_vectors
from .simhash import hexed, near_duplicates
from .suffixes import remove_repeats
from .tokens import histogram_of
from .urls import judge
from .whitening import whiten


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "source")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    left = langid.remainder(F.col("doc_id"), 5)
    profiles = langid.fit(docs.where(left != 0).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", F.coalesce(left == 0, F.lit(False)).alias("held_out"), "text")
    return langid.identify(rows, profiles)


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"), shingle=4, radius=4)
    return out.select("doc_id", hexed().alias("fingerprint"), "component_id")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secrets.BASE]
    number = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    joined = lambda xs: F.concat_ws(",", F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))
    of_base = joined(F.filter("found", lambda x: x["kind"].isin(base)))
    return found.select("doc_id", *[number(k).alias(f"n_{k}") for k in base], F.sha2(of_base, 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"), least=400)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    left = langid.remainder(F.col("doc_id"), 3)
    machine = toxicity.fit(docs.select("doc_id", "text"), labels.where(left != 1).select("doc_id", "toxic"))
    rows = docs.select("doc_id", F.coalesce(left == 1, F.lit(False)).alias("held_out"), "text")
    return toxicity.score(rows, machine).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_of(spark, read(spark, sf_dir, "documents"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(read(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
