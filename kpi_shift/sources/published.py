"""Tables that readers can use while a job replaces a range of them: versions beside each other, one manifest step.

``<path>/data/version=<id>/<partitions>`` holds what one publication wrote and is never changed. ``<path>/manifests/<number>``
lists the partition folders that make up the table; the greatest number counts. A publication writes its folders first,
and then one manifest: the partitions of its range go, its own come in. Until that file is there readers see the old table
whole, and a job that is stopped before leaves nothing but folders that no manifest names. Two jobs that publish at once cannot
lose each other's range: the second one finds its number taken, and lists again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DATA, MANIFESTS, VERSION = "data", "manifests", "version"
#: Times that a publication tries for the next number.
ATTEMPTS = 20


class _Files:
    """The few file operations that manifests need, on whatever file system the path is."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.system = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        at = self._at(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self.system.listStatus(at)] if self.system.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self._at(f"{self.path}/{name}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Make a file with its whole content visible at once, under a name that nobody else has taken."""
        draft = self._at(f"{self.path}/{MANIFESTS}/.{uuid.uuid4().hex}")
        stream = self.system.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        target = self._at(f"{self.path}/{name}")
        if not self.system.exists(target) and self.system.rename(draft, target):
            return True
        self.system.delete(draft, False)
        return False

    def delete(self, name: str) -> None:
        self.system.delete(self._at(f"{self.path}/{name}"), True)


def _numbers(files: _Files) -> list[int]:
    return sorted(int(n) for n in files.names(MANIFESTS) if n.isdigit())


def _manifest(files: _Files, number: int | None = None) -> dict | None:
    numbers = _numbers(files)
    if not numbers:
        return None
    return json.loads(files.read(f"{MANIFESTS}/{number if number is not None else numbers[-1]}"))


def _value(folder: str, column: str) -> str:
    return next(part.partition("=")[2] for part in folder.split("/") if part.startswith(f"{column}="))


def write_version(df: DataFrame, path: str, by: Sequence[str]) -> tuple[str, list[str]]:
    """Write the rows beside the table; (version folder, its partition folders). Nobody sees them yet."""
    spark = df.sparkSession
    folder = f"{DATA}/{VERSION}={uuid.uuid4().hex}"
    df.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{path}/{folder}")
    files, held = _Files(spark, path), [folder]
    for column in by:  # only what was just written is listed
        held = [f"{parent}/{name}" for parent in held for name in files.names(parent) if name.startswith(f"{column}=")]
    return folder, held


def commit_version(spark: SparkSession, path: str, held: list[str], schema: T.StructType, between: tuple[str, str, str]) -> int:
    """Make partition folders visible in place of those of the range ``between`` = (column, first value, end value); returns the manifest's number."""
    column, first, end = between
    astray = [f for f in held if not first <= _value(f, column) < end]
    if astray:
        raise ValueError(f"partitions outside {first} .. {end}: {astray[:3]}")
    files = _Files(spark, path)
    files.system.mkdirs(files._at(f"{path}/{MANIFESTS}"))
    for _ in range(ATTEMPTS):
        number = (_numbers(files) or [0])[-1]
        old = _manifest(files, number) if number else None
        kept = [f for f in (old["partitions"] if old else []) if not first <= _value(f, column) < end]
        made = {"schema": json.loads(schema.json()), "partitions": [*kept, *held]}
        if files.create(f"{MANIFESTS}/{number + 1}", json.dumps(made)):
            return number + 1
    raise RuntimeError(f"{path}: no manifest could be written, other jobs were always faster")


def publish_range(df: DataFrame, path: str, by: Sequence[str], between: tuple[str, str, str]) -> int:
    """Replace the partitions of a range by the rows of ``df``, which all lie in it, in one visible step.

    Rows are written once, and only the new version's folders are listed. Publishing a range without rows empties it.
    """
    _, held = write_version(df, path, by)
    return commit_version(df.sparkSession, path, held, df.schema, between)


def read_published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as of the newest manifest, or of the one with that number. What is published later does not change it."""
    manifest = _manifest(_Files(spark, path), number)
    if manifest is None:
        raise FileNotFoundError(f"nothing has been published at {path}")
    schema = T.StructType.fromJson(manifest["schema"])
    if not manifest["partitions"]:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{f}" for f in manifest["partitions"]]
    return spark.read.schema(schema).option("basePath", f"{path}/{DATA}").parquet(*folders).select(*schema.names)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the newest ``keep`` manifests, and the versions that none of those names; returns the versions removed.

    Run it while no job publishes: a version that is not committed yet is named by no manifest.
    """
    files = _Files(spark, path)
    numbers = _numbers(files)
    named = {f.split("/")[1] for n in numbers[-keep:] for f in _manifest(files, n)["partitions"]}
    for number in numbers[:-keep]:
        files.delete(f"{MANIFESTS}/{number}")
    gone = [v for v in files.names(DATA) if v.startswith(f"{VERSION}=") and v not in named]
    for version in gone:
        files.delete(f"{DATA}/{version}")
    return gone
