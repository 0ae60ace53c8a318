"""Reading dated files, directories and tables."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How a day is written in file names.
ISO_DAY = r"\d{4}-\d{2}-\d{2}"
COMPACT_DAY = r"(\d{4})(\d{2})(\d{2})"
#: Headers fetched at a time.
HEADER_READERS = 16


def empty_table(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    """No rows, text columns."""
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def read_csv(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """CSV with header, all text unless a ``schema`` or ``inferSchema`` says otherwise. Globs and gzip are fine."""
    schema = options.pop("schema", None)
    reader = spark.read.options(header=True, **options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def read_csv_tree(spark: SparkSession, path: str, name_glob: str = "*.csv", **options) -> DataFrame:
    """All CSV files below a folder, however deep."""
    return read_csv(spark, path, recursiveFileLookup=True, pathGlobFilter=name_glob, **options)


def csv_header(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Column names of a CSV file, or of the first file in a folder or glob; none without a file.

    Only the first line is fetched, by the driver and without a Spark job. Where that line does not name the columns plainly (a name
    is empty, repeated or runs over the line), Spark is asked.
    """
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    settings = spark._jsc.hadoopConfiguration()
    files = at.getFileSystem(settings)
    found = sorted((s.getPath() for s in files.globStatus(at) or () if not s.isDirectory()), key=str)
    if not found:
        below = [s for s in files.globStatus(at) or ()]
        inside = [f.getPath() for s in below for f in files.listStatus(s.getPath()) if f.isFile()]
        found = sorted((f for f in inside if f.getName()[0] not in "._"), key=str)
    if not found:
        return None
    stream = files.open(found[0])
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(found[0])
        plain = stream if codec is None else codec.createInputStream(stream)
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()
    names = next(csv.reader([line.removeprefix("\ufeff")]), []) if line else []
    plainly = names and all(n and n == n.strip() for n in names) and len({n.lower() for n in names}) == len(names) and line.count('"') % 2 == 0
    return tuple(names) if plainly else tuple(read_csv(spark, path).columns)


def read_daily_csv(
    spark: SparkSession,
    pattern: str,
    days: Sequence[str],
    columns: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] | None = None,
    source_day: str | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Rows of one CSV per day; ``pattern`` has ``{}`` for the day. Days without a file are skipped.

    Columns are matched by name, and a file that lacks one of ``columns`` gives null there. The driver looks only at
    headers, several at a time: files with the same header are read by one multi-path scan, so the plan grows with the number of layouts,
    not of days. ``transform`` is applied once per layout. ``source_day`` names a column for the day taken from the
    file name. ``distinct`` costs a shuffle of all rows; leave it out where the next step removes copies anyway.
    Without any file the result is empty.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    paths = [pattern.format(day) for day in days]
    with ThreadPoolExecutor(HEADER_READERS) as readers:
        headers = list(readers.map(lambda path: csv_header(spark, path), paths))
    for path, header in zip(paths, headers, strict=True):
        if header is not None:
            layouts.setdefault(header, []).append(path)
    scans = []
    for header, paths in layouts.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        # a file of another header than its path's fails instead of filling the wrong columns
        scan = read_csv(spark, paths, schema=schema, enforceSchema=False)
        if source_day is not None:
            scan = scan.withColumn(source_day, F.regexp_extract("_metadata.file_path", f"({ISO_DAY})", 1).cast("date"))
        scans.append(transform(scan) if transform else scan)
    if not scans:
        return empty_table(spark, columns)
    return union_tables(scans, columns, distinct)


def union_tables(tables: Sequence[DataFrame], columns: Sequence[str] = (), distinct: bool = True) -> DataFrame:
    """Rows of several tables, by default distinct, matched by column name; columns a table lacks are null."""
    if not tables:
        raise ValueError("nothing to unite")
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    absent = {c: F.lit(None).cast("string") for c in columns if c not in merged.columns}
    merged = merged.withColumns(absent) if absent else merged
    return merged.distinct() if distinct else merged


def list_dated_files(spark: SparkSession, folder: str, day_pattern: str = ISO_DAY) -> DataFrame:
    """(path, day) of the files below ``folder`` whose own or directory name holds a day; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    below = F.substring_index("path", folder.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
    form = "yyyyMMdd" if day_pattern == COMPACT_DAY else "yyyy-MM-dd"
    day = F.try_to_date(F.regexp_extract(below, f"({day_pattern})", 1), form)
    return files.select("path", day.alias("day")).filter(F.col("day").isNotNull())


def latest_snapshot(snapshots: DataFrame, as_of: str, date_column: str = "date", static: DataFrame | None = None) -> DataFrame:
    """Rows of the newest snapshot up to ``as_of``; ``static`` steps in where there is none.

    The newest day is a scalar subquery over the partition column, so only that partition is scanned.
    """
    day = F.col(date_column)
    newest = snapshots.filter(day <= F.lit(as_of).cast("date")).agg(F.max(date_column))
    rows = snapshots.filter(day == newest.scalar())
    if static is None:
        return rows
    return rows.drop(date_column).unionByName(static.filter(newest.scalar().isNull()), allowMissingColumns=True)


def dated_partitions(table: DataFrame, start: str, end: str, date_column: str = "date") -> DataFrame:
    """Partitions ``start`` .. ``end``; those that do not exist are simply absent."""
    return table.filter(F.col(date_column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def read_ticket_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON records (enodeb_id, count, day): the day is the one asked for."""
    return spark.read.schema("enodeb_id string, count long, day date").json(path)
