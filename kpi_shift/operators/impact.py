"""Call-failure records and the users behind abnormal KPIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpi_shift.functions.lookup import lookup_join
from kpi_shift.spec import Level

# Cause codes that are kept, and the codes belonging to each alerting KPI.
CAUSE_CODES = ("8000", "8001", "8002", "8010", "8011", "8012", "8013", "8020", "8021", "8040")
CAUSES_OF_ALERT = {
    "bearer_drop_rate_alert": ("8000", "8001"),
    "sip_dc_rate_alert": ("8002", "8000", "8001"),
    "dl_data_volume_alert": ("8040",),
    "rrc_setup_failure_alert": ("8010", "8013", "8011", "8012"),
    "rtp_gap_alert": ("8021", "8020", "8010", "8013", "8011", "8012"),
}
# Joint of flattened names, leading cause digits, and where the ten digits of a number start.
NAME_JOINT = "_b_"
CAUSE_PATTERN = r"^(\d{4})"
MSISDN_START, FROM_URI_START, NUMBER_LENGTH = 2, 7, 10


def flatten_nested(df: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Structs to ``parent_b_child`` columns and arrays to rows, until neither is left. Maps stay.

    Only the schema decides, so the plan is fixed before any data is read. A row with a null or empty array vanishes
    unless ``keep_empty``; several arrays give their product.
    """
    unnest = F.explode_outer if keep_empty else F.explode
    while True:
        fields = df.schema.fields
        if any(isinstance(f.dataType, T.StructType) for f in fields):
            plain = [F.col(f"`{f.name}`") for f in fields if not isinstance(f.dataType, T.StructType)]
            nested = [
                F.col(f"`{f.name}`.`{child}`").alias(f"{f.name}{NAME_JOINT}{child}")
                for f in fields
                if isinstance(f.dataType, T.StructType)
                for child in f.dataType.names
            ]
            df = df.select(*plain, *nested)
            continue
        arrays = [f.name for f in fields if isinstance(f.dataType, T.ArrayType)]
        if not arrays:
            return df
        df = df.withColumn(arrays[0], unnest(F.col(f"`{arrays[0]}`")))


def cause_histogram(df: DataFrame, cause: str) -> DataFrame:
    """Rows per cause, most frequent first."""
    return df.groupBy(cause).agg(F.count("*").alias("count")).orderBy(F.desc("count"), F.asc(cause))


def normalise_failures(
    flat: DataFrame,
    codes: Sequence[str] = CAUSE_CODES,
    prefix: str = f"data{NAME_JOINT}",
    level_column: str = "tower",
) -> DataFrame:
    """Add four-digit cause, tower id and both ten-digit numbers; keep records of the listed causes."""
    cause, cell = F.col(f"{prefix}cause_code"), F.col(f"{prefix}enodeb")
    return flat.withColumns(
        {
            "cause_code": F.regexp_extract(cause, CAUSE_PATTERN, 1),
            level_column: F.split(cell, "_")[0],
            "msisdn_num": F.substring(f"{prefix}msisdn", MSISDN_START, NUMBER_LENGTH),
            "fromuri_num": F.substring(f"{prefix}from_uri", FROM_URI_START, NUMBER_LENGTH),
        }
    ).filter(F.col(level_column).isNotNull() & F.col("cause_code").isin(*codes))


def impacted_users(failures: DataFrame, scored: DataFrame, level: Level) -> DataFrame:
    """Failure records on a tower's abnormal days whose cause belongs to a raised alert, one row per record and alert.

    ``failures`` is normalised and has the ``day``. Rows meet the abnormal rows of their tower and day, and the raised alerts to
    which their cause belongs are picked then: no side is multiplied before the join, and the side of the alerts is a plain filter of a
    table. So beyond the broadcast threshold Spark can make Bloom filters of its towers and days and apply them in the scan of the
    failures, before these are shuffled (``spark.sql.optimizer.runtime.bloomFilter``).
    """
    alerts = list(CAUSES_OF_ALERT)
    abnormal = scored.filter(F.col("has_abnormal_kpi") == 1).select(level.tower, "day", *alerts)
    found = lookup_join(failures.select(level.tower, "day", "cause_code", "fromuri_num", "msisdn_num"), abnormal, [level.tower, "day"])
    raised = F.array(*[F.when((F.col(name) == 1) & F.col("cause_code").isin(*codes), F.lit(name)) for name, codes in CAUSES_OF_ALERT.items()])
    features = F.explode(F.array_compact(raised)).alias("abnormal_feature")
    return found.select(level.tower, "day", "fromuri_num", "msisdn_num", "cause_code", features)
