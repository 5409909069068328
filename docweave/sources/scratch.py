"""Folders for intermediate tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share; a local one only where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(found or '/tmp/checkpoints/docweave').rstrip('/')}/{uuid.uuid4().hex}"
