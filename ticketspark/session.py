"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that a task hands to its Python worker at once; a longer row goes alone.
BATCH_BYTES = 4 << 20


def get_session(app: str = "ticketspark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume: UTC and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="ticketspark-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared directory the cluster names.

    Only a session on one machine may do without ``spark.checkpoint.dir``; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/ticketspark/{name}-{uuid.uuid4().hex}"


def in_small_batches(df: DataFrame, size: int = BATCH_BYTES) -> DataFrame:
    """``df``, whose session from now on hands rows to Python workers in batches of about ``size`` bytes.

    Spark's own bound is 64 MiB, and a batch of whole texts stands in the JVM and in the worker, in each of an
    executor's tasks. Results do not depend on it; a smaller bound of the session stays.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)([bkmgtp]?)b?", (conf.get(name, None) or "").lower())
    if not now or int(now[1]) * 1024 ** "bkmgtp".index(now[2] or "b") > size:
        conf.set(name, str(size))
    return df


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and outlives lost executors, unlike a cached table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
