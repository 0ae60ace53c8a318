"""Document fingerprints by order MinHash.

Every run of ``K`` bytes of a text, numbered by its occurrences so far, is hashed. Each of ``SKETCHES`` hash functions
selects the ``TUPLE`` runs with the least values, keeps them in text order, and hashes them as a tuple. Two texts agree
in a place of their fingerprints the likelier, the smaller their edit distance: both contents and order count.

Comparing a document with the next one needs neighbours: documents are dealt by ranges of doc_id and sorted inside a
range, and the first document of a range is also sent to the range before it. So each text is shuffled once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.llm.text import mix, text_or_empty

K = 12
SKETCHES = 32
TUPLE = 2
BLOCK = 1 << 16
_U = np.uint64
_FACTORS = (mix(np.arange(1, SKETCHES + 1, dtype=_U)) >> _U(32)).astype(np.uint32)[:, None] | np.uint32(1)
_BYTES = mix(np.arange(1001, 1257, dtype=_U))
_ODD = _U(0x9FB21C651E98DF25)


def _numbered(runs: np.ndarray) -> np.ndarray:
    """Hash of each run together with the number of its occurrence."""
    n = len(runs)
    if n < 1 << 24:  # value and place in one sortable number
        order = (runs & ~_U((1 << 24) - 1)) | np.arange(n, dtype=_U)
        order.sort()
        place, value = (order & _U((1 << 24) - 1)).astype(np.int64), order >> _U(24)
    else:
        place = np.argsort(runs >> _U(24), kind="stable")
        value = runs[place] >> _U(24)
    first = np.ones(n, bool)
    first[1:] = value[1:] != value[:-1]
    number = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    out = np.empty(n, _U)
    out[place] = mix(value + number.astype(_U) * _ODD)
    return out


def fingerprint(text: bytes) -> np.ndarray:
    """One 32-bit value per sketch; a text shorter than a run is one run, an empty text has zeros."""
    if not text:
        return np.zeros(SKETCHES, np.uint32)
    data = _BYTES[np.frombuffer(text, np.uint8)]
    n = max(1, len(data) - K + 1)
    runs = np.zeros(n, _U)
    for i in range(min(K, len(data))):
        runs = runs * _ODD + data[i : i + n]
    runs = mix(runs)
    small = (_numbered(runs) >> _U(32)).astype(np.uint32)
    least = np.full((SKETCHES, 0), 0, np.uint64)
    places = np.zeros((SKETCHES, 0), np.int64)
    for at in range(0, n, BLOCK):  # a bounded part of a long text at a time
        values = small[at : at + BLOCK] * _FACTORS
        for _ in range(min(TUPLE, values.shape[1])):
            lowest = values.argmin(axis=1)[:, None]
            least = np.append(least, np.take_along_axis(values, lowest, 1), 1)
            places = np.append(places, lowest + at, 1)
            np.put_along_axis(values, lowest, np.uint32(0xFFFFFFFF), 1)
    if n > BLOCK:
        best = np.argsort(least, axis=1, kind="stable")[:, :TUPLE]
        places = np.take_along_axis(places, best, 1)
    places.sort(axis=1)
    tuples = np.zeros(SKETCHES, _U)
    for i in range(places.shape[1]):
        tuples = mix(tuples * _ODD + runs[places[:, i]])
    return (tuples >> _U(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal places."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many, or all, of the text that follows."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of bucket and doc_id; the mark of a bucket's last row is the first row of the next bucket."""
    schema = None
    held: tuple | None = None  # bucket, id, text, fingerprint of the row that waits for its successor
    out: list[list] = [[] for _ in range(7)]

    def finish(following: str, theirs: np.ndarray) -> None:
        _, doc, text, own = held
        changed = edited(text, following)
        raw = changed.encode()
        other = fingerprint(raw)
        row = (doc, len(text), hashlib.sha256(raw).hexdigest(), own.tobytes().hex(), other.tobytes().hex(), likeness(own, other), likeness(own, theirs))
        for column, v in zip(out, row, strict=True):
            column.append(v)

    def flush() -> pa.RecordBatch:
        types = (schema, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)
        for column in out:
            column.clear()
        return batch

    for batch in batches:
        schema = batch.schema.field("doc_id").type
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256).to_pydict()
            for bucket, mark, doc, text in zip(part["bucket"], part["mark"], part["doc_id"], part["text"], strict=True):
                own = fingerprint(text.encode())
                if held is not None and held[0] == bucket:
                    finish(text, own)
                held = None if mark else (bucket, doc, text, own)
            yield flush()


def fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprint of each text, of its edited text (see ``edited``), and how like both and the next document's are.

    The next document is the one with the next greater (doc_id, text), after the last the first; null ids come first and a
    null text is empty. A table of one row is its own successor, an empty table gives an empty result. Repeated ids follow each other in
    the order of their texts. Further columns are not read.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", text_or_empty().alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(i / parts) for i in range(parts)])
    spread = F.percentile_approx("doc_id", shares, F.lit(max(10_000, 20 * parts)))
    found = rows.agg(F.min("doc_id").alias("low"), spread.alias("cuts"), F.count("*").alias("n"), F.count("doc_id").alias("known")).first()
    # bucket 0 holds null ids, bucket i the ids from the i-th cut to below the next; each cut is the id of a document
    cuts = sorted({found.low, *(found.cuts or ())}) if found.known else []
    nulls = found.n > found.known
    stride = max(1, math.isqrt(len(cuts)))
    tops = F.array(*[F.lit(c) for c in cuts[::stride]]) if cuts else F.array().cast("array<bigint>")
    every = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    coarse = F.greatest(F.lit(0), F.size(F.filter(tops, lambda c: c <= F.col("doc_id"))) - 1) * stride
    fine = F.size(F.filter(F.slice(every, F.col("coarse") + 1, F.lit(stride)), lambda c: c <= F.col("doc_id")))
    placed = rows.withColumn("coarse", F.when(F.col("doc_id").isNull(), 0).otherwise(coarse))
    placed = placed.withColumn("bucket", F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("coarse") + fine))
    first = F.col("bucket").eqNullSafe(0) | (F.col("doc_id") == F.element_at(every, F.greatest(F.col("bucket"), F.lit(1)))) if cuts else F.lit(True)
    lowest = 0 if nulls else 1
    before = F.when(F.col("bucket") == lowest, len(cuts)).otherwise(F.col("bucket") - 1)
    own, mark = F.struct("bucket", F.lit(False).alias("mark")), F.struct(before.alias("bucket"), F.lit(True).alias("mark"))
    places = F.explode(F.when(first, F.array(own, mark)).otherwise(F.array(own)))
    dealt = placed.select("doc_id", "text", places.alias("to")).select("to.bucket", "to.mark", "doc_id", "text")
    ordered = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "mark", "doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return ordered.mapInArrow(
        _fingerprint_rows,
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
