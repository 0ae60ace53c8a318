"""Joining many rows with a lookup whose size is not known beforehand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    summarised: bool = False,
) -> DataFrame:
    """Equi-join ``rows`` with a ``lookup``; ``how`` keeps the left side: inner, left, left_semi or left_anti.

    No broadcast is forced. Spark broadcasts the lookup where its size (exact for a written table, measured at run time
    for the rest) is under ``spark.sql.autoBroadcastJoinThreshold``. Beyond it the join is a sort-merge join in which
    adaptive execution splits the partition of a hot key over many tasks, each with a copy of the lookup's part. For
    both, nothing may multiply the lookup's rows between the point of measuring and the join, and the lookup needs a
    shuffle of its own. A lookup aggregated on the join keys (``summarised``) would reuse the aggregation's, and the
    hot key could not be split; the rebalance gives it one.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join keeps the rows of the left side; {how!r} does not")
    return rows.join(lookup.hint("rebalance") if summarised else lookup, list(on), how)
