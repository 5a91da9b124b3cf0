"""Folders for files that a query writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share; in local mode a temporary one will do."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own.setdefault(context.applicationId, tempfile.mkdtemp(prefix="spark-work-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
