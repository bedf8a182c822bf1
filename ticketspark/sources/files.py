"""CSV folders, prediction files, artefact tables and feature metadata.

Listing goes through the Hadoop file system of the path, so any store Spark can read will do.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import normalize_columns
from ..operators.reshape import union_by_name

# fixed values: columns a prediction file must have
PREDICTION_COLUMNS = {"date", "split", "y_true", "y_pred", "model"}


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in (found or []))


def _first_line(spark: SparkSession, file: str) -> str | None:
    """First line of a file, None when it cannot be read or is empty."""
    jvm = spark.sparkContext._jvm
    try:
        path = jvm.org.apache.hadoop.fs.Path(file)
        stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
        try:
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()
    except Py4JJavaError:
        return None


def _headers(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by header. Reads the first line of each file and nothing else."""
    with ThreadPoolExecutor(max_workers=32) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line and line.strip():
            names = tuple(h.strip() for h in next(csv.reader([line])))
            groups.setdefault(names, []).append(file)
    return groups


def _read_group(spark: SparkSession, names: Sequence[str], files: Sequence[str], schema: T.StructType | None, bad: str) -> DataFrame:
    """Files of one header. Text columns, cast leniently when the schema names a type."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField(bad, T.StringType())])
    reader = spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad)
    reader = reader.option("ignoreCorruptFiles", True)
    df = normalize_columns(reader.option("enforceSchema", True).csv(list(files)))
    types = {f.name: f.dataType for f in schema.fields} if schema else {}
    return df.withColumns({n: F.col(n).try_cast(t) for n, t in types.items() if n in df.columns}) if types else df


def read_events(spark: SparkSession, path: str, schema: T.StructType | None = None, keep_corrupt: bool = False) -> DataFrame:
    """All CSV files of a folder, united by column name.

    Files with the same header are one scan; headers that differ are united with nulls for what is
    missing. Header names are stripped and lower-cased, values cast leniently. Unreadable files are
    skipped. Fails when no file matches.
    """
    pattern = path if re.search(r"[*?\[]", path) else f"{path.rstrip('/')}/*.csv"
    files = list_files(spark, pattern)
    if not files:
        raise FileNotFoundError(f"no CSV file matches {pattern}")
    groups = _headers(spark, files)
    if not groups:
        raise FileNotFoundError(f"no readable CSV file matches {pattern}")
    df = union_by_name(*[_read_group(spark, names, paths, schema, "_corrupt") for names, paths in groups.items()])
    return df if keep_corrupt else df.drop("_corrupt")


def read_daily(spark: SparkSession, path: str, schema: T.StructType, date: str = "date") -> DataFrame:
    """One CSV file or folder with a given schema; the date column is parsed leniently."""
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name == date else f.dataType) for f in schema.fields])
    df = spark.read.schema(text).option("header", True).csv(path)
    return df.withColumn(date, F.col(date).try_cast("date"))


def read_predictions(spark: SparkSession, pattern: str) -> DataFrame:
    """Prediction files as the long prediction table.

    Every file must have the required columns. A file without a horizon is for one day ahead.
    """
    files = list_files(spark, pattern)
    if not files:
        raise FileNotFoundError(f"no prediction file matches {pattern}")
    parts = []
    for names, paths in _headers(spark, files).items():
        missing = PREDICTION_COLUMNS - set(names)
        if missing:
            raise ValueError(f"{paths[0]} lacks columns {sorted(missing)}")
        df = _read_group(spark, names, paths, None, "_corrupt").drop("_corrupt")
        parts.append(df if "horizon" in names else df.withColumn("horizon", F.lit("1")))
    df = union_by_name(*parts)
    return df.withColumns(
        {
            "date": F.col("date").try_cast("date"),
            "y_true": F.col("y_true").try_cast("double"),
            "y_pred": F.col("y_pred").try_cast("double"),
            "horizon": F.coalesce(F.col("horizon").try_cast("int"), F.lit(1)),
        }
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    reader = reader.schema(schema) if schema else reader
    return reader.option("header", True).load(path) if fmt == "csv" else reader.load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Write a table, one folder per partition value.

    Rebalancing gathers the rows of each value, joins small ones and splits a large one by its size.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
    return path


def save_meta(path: str, ranges: DataFrame, cells: DataFrame, modes: DataFrame) -> str:
    """Value ranges, the cell table and the usual month, as one folder of tables."""
    for name, df in (("ranges", ranges), ("cells", cells), ("modes", modes)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return path


def load_meta(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("ranges", "cells", "modes")}
