"""Hourly message folders with many small files, made into few large ones while their stream goes on.

The stream's files are never touched: compaction publishes the rows of a range of days as Parquet beside them, each with the name of
the file it came from. So one manifest tells both what is compacted and which files that covers, and a reader sees every row once,
whatever a stream or a compaction is just doing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpi_shift.sources.published import publish_range, read_published

SOURCE_FILE = "source_file"
BY = ("date", "hour")


def _compacted(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_published(spark, path)
    except FileNotFoundError:
        return None


def uncovered_files(spark: SparkSession, source: str, covered: DataFrame | None) -> list[str]:
    """Files of the stream that no compaction covers; only names are read. They are as many as came since the last compaction."""
    files = spark.read.format("binaryFile").load(source).select("path")
    if covered is not None:
        files = files.withColumn(SOURCE_FILE, F.substring_index("path", "/", -1)).join(covered.select(SOURCE_FILE).distinct(), SOURCE_FILE, "left_anti")
    return sorted(r.path for r in files.select("path").collect())


def _all_rows(spark: SparkSession, source: str, schema: T.StructType, path: str) -> DataFrame:
    # the manifest comes first: a file that is compacted after this is still read from the stream
    compacted = _compacted(spark, path)
    files = uncovered_files(spark, source, compacted)
    if not files:
        rows = spark.createDataFrame([], schema).withColumn(SOURCE_FILE, F.lit(None).cast("string"))
    else:
        rows = spark.read.schema(schema).option("basePath", source).json(files).select(*schema.names, F.col("_metadata.file_name").alias(SOURCE_FILE))
    return rows if compacted is None else compacted.select(*rows.columns).unionByName(rows)


def read_messages(spark: SparkSession, source: str, schema: T.StructType, path: str) -> DataFrame:
    """Every row that the stream has written to ``source``, from compacted files where there are any."""
    return _all_rows(spark, source, schema, path).drop(SOURCE_FILE)


def compact(spark: SparkSession, source: str, schema: T.StructType, path: str, start: str, end: str) -> int:
    """Publish the rows of the days from ``start`` until ``end`` in files as large as adaptive execution's advisory size allows.

    Each hour has one file, or as many as its bytes fill. Compacting a range again takes in what came late, from the late files and
    the compacted ones alone. Rows without a date stay in the stream's files. Returns the manifest's number.
    """
    rows = _all_rows(spark, source, schema, path).filter(f"date >= DATE'{start}' AND date < DATE'{end}'")
    return publish_range(rows, path, BY, ("date", start, end))
