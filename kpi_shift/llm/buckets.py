"""Rows dealt by a bucket number, and a function called on one bucket after another."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def by_bucket(rows: DataFrame, *order: str) -> DataFrame:
    """Each bucket in one partition, its rows together and in ``order``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket", *order)


def each_bucket(found: Callable[[pa.Table], pa.Table | None]) -> Callable:
    """Calls ``found`` with the rows of one bucket after another; a partition is sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None

        def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
            bucket = table.column("bucket").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]))
            made = [found(table.slice(a, b - a)) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) if b - a > 1]
            made = [m for m in made if m is not None and m.num_rows]
            if made:
                yield from pa.concat_tables(made).combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if waiting is None else pa.concat_tables([waiting, table])
            bucket = table.column("bucket").to_numpy()
            last = len(bucket) - int(np.argmax(bucket[::-1] != bucket[-1])) if bucket[0] != bucket[-1] else 0
            waiting = table.slice(last)
            if last:
                yield from emit(table.slice(0, last))
        if waiting is not None:
            yield from emit(waiting)

    return run
