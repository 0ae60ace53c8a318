"""Written intermediate tables: cut lineage, survive lost executors, give the planner true sizes."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the one given to
    ``SparkContext.setCheckpointDir``; only a local master may fall back to a fresh temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"Set {CHECKPOINT_DIR} to a folder that the driver and all executors share.")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="kpi-shift-")
    return _own_folders[application]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call has been given."""
    return f"{shared_folder(spark).rstrip('/')}/kpi_shift/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    File sizes are exact, so a staged lookup is broadcast only when it really is below the broadcast threshold.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
