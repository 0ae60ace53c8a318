"""Writing results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


SCHEMA_FOLDER = "_schema"  # readers of the table skip names that begin so


def write_partitions(
    df: DataFrame, path: str, by: Sequence[str] = ("event_date", "day"), between: tuple[str, str, str] | None = None
) -> None:
    """Replace the partitions of a range: those that ``df`` holds, and no others are left in it.

    ``between`` is (column of ``by``, first value, end value, exclusive): partitions in it that ``df`` does not hold are
    removed once the new ones are written. So a repeated or corrected run gives the same table as a first one. Without
    it, only the partitions of ``df`` are replaced. Rows are rebalanced by adaptive execution, so files stay of useful
    size. The schema is kept beside the data, so that a table without rows can be read. For readers that must not see
    the steps of a replacement there is ``published.publish_range``.
    """
    spark = df.sparkSession
    if not table_exists(spark, path) or _kept_schema(spark, path) != df.schema:
        df.limit(0).write.mode("overwrite").parquet(f"{path}/{SCHEMA_FOLDER}")
    before = _partition_files(spark, path, by, between) if between is not None else {}
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    if not before:
        return
    # a partition that was written has other files than before
    after = _partition_files(spark, path, by, between)
    files = _file_system(spark, path)
    for folder, held in before.items():
        if after.get(folder) == held:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)
    spark.catalog.refreshByPath(path)


def _file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _kept_schema(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/{SCHEMA_FOLDER}").schema


def _partition_files(spark: SparkSession, path: str, by: Sequence[str], between: tuple[str, str, str]) -> dict[str, list[str]]:
    """File names of the partitions of a range, by folder. Folders outside the range are not opened, apart from those above its column."""
    column, first, end = between
    files, folders = _file_system(spark, path), [path]
    for name in by:
        found = []
        for folder in folders:
            at = spark._jvm.org.apache.hadoop.fs.Path(folder)
            for status in files.listStatus(at) if files.exists(at) else ():
                part, _, value = status.getPath().getName().partition("=")
                if part == name and (name != column or first <= value < end):
                    found.append(status.getPath().toString())
        folders = found
    return {f: sorted(s.getPath().getName() for s in files.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f))) for f in folders}


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``write_partitions`` has written there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{SCHEMA_FOLDER}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def drop_partitions(spark: SparkSession, path: str, column: str, first: str) -> None:
    """Remove the partitions of the leading partition column from the value ``first`` on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*")) or []:
        if status.getPath().getName().partition("=")[2] >= first:
            files.delete(status.getPath(), True)
    spark.catalog.refreshByPath(path)


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``write_partitions``; without rows if no partition is left."""
    return spark.read.schema(_kept_schema(spark, path)).parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with header. ``files`` limits the number of files of a small export; by default every task writes one."""
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_documents(df: DataFrame, path: str) -> None:
    """JSON lines; null fields are written too, so every document has all fields."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def publish(messages: DataFrame, fmt: str, options: Mapping[str, str], mode: str = "append") -> None:
    """Hand the ``value`` column to any installed message connector (or file format)."""
    messages.select("value").write.format(fmt).options(**options).mode(mode).save()
