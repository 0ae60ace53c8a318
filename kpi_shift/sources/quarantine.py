"""Daily files of which some are damaged: sound days are read, the rest goes to a table of rejects."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatchcase
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpi_shift.functions.stage import stage
from kpi_shift.sources.daily import HEADER_READERS, ISO_DAY, csv_header, empty_table, read_csv, union_tables

REJECTS = "path string, day date, reason string, record string"
# Reasons of a reject.
UNREADABLE, NO_HEADER, MALFORMED = "unreadable file", "no header", "malformed record"
#: Columns of a scan beside those of its files.
RECORD, PATH = "_record", "_path"
#: How Spark names the file at which a task gave up.
FAILED_FILE = re.compile(r"FAILED_READ_FILE[^\n]*? file (\S+?)\.?\s+SQLSTATE")


class Sorted(NamedTuple):
    """Rows of the sound days, and what was set aside."""

    rows: DataFrame
    rejects: DataFrame


def _failed_file(spark: SparkSession, error: Exception) -> str | None:
    """The file that a job failed to read, as Hadoop writes paths; none if it failed otherwise."""
    found = FAILED_FILE.search(str(error))
    if found is None:
        return None
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(found[1])).toString()


def _holds(spark: SparkSession, path: str, file: str) -> bool:
    """Whether a path (a file, folder or glob) names a file or the folder it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return file == whole or file.startswith(f"{whole}/") or fnmatchcase(file, whole) or fnmatchcase(file, f"{whole}/*")


def read_sound(
    spark: SparkSession, paths: Sequence[str], read: Callable[[list[str]], DataFrame], name: str
) -> tuple[list[DataFrame], list[str]]:
    """Written rows of the paths that can be read to their end, and the paths that cannot.

    All paths are read by one job, which writes what it reads. Only if it fails at a file is the list cut: that file's path is
    tried again alone, the others in two halves. So sound input costs one job, k damaged paths some 2k more, and what one half has
    written stays. A path is given up only when it fails alone too: a store that fails once rejects nothing. Errors other than
    of reading a file are raised.
    """
    sound, damaged, pending = [], [], [list(paths)]
    while pending:
        group = pending.pop()
        if not group:
            continue
        try:
            sound.append(stage(read(group), name))
        except (Py4JJavaError, PySparkException) as error:
            file = _failed_file(spark, error)
            if file is None:
                raise
            if len(group) == 1:
                damaged.append(group[0])
                continue
            named = [p for p in group if _holds(spark, p, file)][:1]
            rest = [p for p in group if p not in named]
            half = (len(rest) + 1) // 2
            pending += [rest[half:], rest[:half], named]
    return sound, damaged


def _header(spark: SparkSession, path: str) -> tuple[str, ...] | None | Exception:
    try:
        return csv_header(spark, path)
    except (Py4JJavaError, PySparkException) as error:
        return error


def read_daily_sorted(
    spark: SparkSession,
    pattern: str,
    days: Sequence[str],
    columns: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] | None = None,
    source_day: str | None = None,
    distinct: bool = True,
) -> Sorted:
    """``read_daily_csv`` that goes on past damaged files; all columns are text.

    A day with a file that cannot be read to its end, or whose files differ in their headers, is set aside whole, since part of a day would
    pass for low traffic. Of sound days, records with more or fewer fields than the header are set aside one by one. ``rejects``
    has path, day (of the path), reason, and a malformed record's text. Absent days are neither rows nor rejects. Rows are written
    once to the shared folder, so later steps do not read the raw files again.
    """
    paths = {pattern.format(day): day for day in days}
    with ThreadPoolExecutor(HEADER_READERS) as readers:
        headers = dict(zip(paths, readers.map(lambda path: _header(spark, path), paths), strict=True))
    layouts: dict[tuple[str, ...], list[str]] = {}
    set_aside: list[tuple[str, str]] = []
    for path, header in headers.items():
        if isinstance(header, Exception):
            # a job judges: a header that the driver could not fetch may be there for the tasks
            _, damaged = read_sound(spark, [path], lambda group: spark.read.text(group), "unread")
            if not damaged:
                raise header
            set_aside.append((path, UNREADABLE))
        elif header == ():
            set_aside.append((path, NO_HEADER))
        elif header is not None:
            layouts.setdefault(header, []).append(path)
    scans = []
    for header, group in layouts.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, RECORD)])

        def read(part: list[str], schema=schema) -> DataFrame:
            rows = read_csv(spark, part, schema=schema, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD)
            return rows.withColumn(PATH, F.col("_metadata.file_path"))

        sound, damaged = read_sound(spark, group, read, "sound-days")
        scans += sound
        set_aside += [(path, UNREADABLE) for path in damaged]
    aside = spark.createDataFrame([(p, paths[p], r) for p, r in set_aside], "path string, day string, reason string")
    rejects = [aside.select("path", F.col("day").cast("date").alias("day"), "reason", F.lit(None).cast("string").alias("record"))]
    day = F.regexp_extract(PATH, f"({ISO_DAY})", 1).try_cast("date")
    for scan in scans:
        malformed = scan.filter(F.col(RECORD).isNotNull())
        rejects.append(malformed.select(F.col(PATH).alias("path"), day.alias("day"), F.lit(MALFORMED).alias("reason"), F.col(RECORD).alias("record")))
    good = [s.filter(F.col(RECORD).isNull()) for s in scans]
    good = [(g.withColumn(source_day, day) if source_day is not None else g).drop(RECORD, PATH) for g in good]
    good = [transform(g) for g in good] if transform else good
    rows = union_tables(good, columns, distinct) if good else empty_table(spark, columns)
    return Sorted(rows, union_tables(rejects, distinct=False))
