"""Lines that several documents share: two Bloom filters, dealt by hash, tell which lines are worth confirming.

A line that is long enough is named by 128 bits of its key. What one batch of documents shows to be shared by two of them
is suspected at once; all else travels as its name and document, no text, to the filters of its hash range. There the
first filter holds what was seen once, the second what was seen twice, so a name whose bits are all in the second is suspected,
and a false alarm costs a row, never a result. Batches send a name that they have seen twice only once, so a line that
a third of all documents share is a row per batch there, and its pairs pass the filters by, dealt evenly.

Only suspects are shuffled again: distinct pairs of line and document are counted exactly, and the greatest document that
holds a line is chosen. Filters are as large as their hash range is, and ranges grow in number with the lines, so no filter is
broadcast and none outgrows its task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.lookup import lookup_join
from kpi_shift.functions.stage import stage
from kpi_shift.llm.text import mix, packed, text_or_empty, unpacked

MIN_CHARS = 20
MIN_DOCS = 3
#: Text bytes for each range of hashes: some hundred thousand lines and a filter of about a megabyte.
RANGE_BYTES = 64 << 20
BITS = 12
PROBES = 4
BLANKS = b" \t\n\r\x0b\x0c"
_U = np.uint64
SEND, SURE, SEEN_TWICE = 0, 1, 2


def key_of(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128 bits that name the key of a line; none if the key is shorter than ``min_chars`` code points."""
    key = line.strip(BLANKS).lower()  # bytes: only A-Z
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class Bloom:
    """A set of 64-bit hashes that may contain more than was put in, never less."""

    def __init__(self, capacity: int):
        self.bits = _U(1 << max(10, math.ceil(math.log2(max(1, capacity) * BITS))))
        self.words = np.zeros(int(self.bits) // 64, _U)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        step = mix(hashes) | _U(1)
        return np.array([hashes + _U(i) * step for i in range(PROBES)]) & (self.bits - _U(1))

    def add(self, hashes: np.ndarray) -> None:
        places = self._places(hashes)
        np.bitwise_or.at(self.words, places >> _U(6), _U(1) << (places & _U(63)))

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        places = self._places(hashes)
        return ((self.words[places >> _U(6)] >> (places & _U(63))) & _U(1)).all(axis=0)


def _named(min_chars: int):
    """Each batch's lines as (range key, high, low, doc_id, kind), one row per line and document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, owners = [], []
            for row, text in enumerate(batch.column(1).cast(pa.large_binary())):
                found = {key_of(line, min_chars) for line in text.as_py().split(b"\n")} - {None}
                names.extend(found)
                owners.append((row, len(found)))
            if not names:
                continue
            halves = np.frombuffer(b"".join(names), "<i8").reshape(-1, 2)
            rows = np.repeat([r for r, _ in owners], [n for _, n in owners])
            order = np.lexsort((halves[:, 1], halves[:, 0]))
            halves, rows = halves[order], rows[order]
            new = np.ones(len(halves), bool)
            new[1:] = (halves[1:] != halves[:-1]).any(axis=1)
            group = np.cumsum(new) - 1
            shared = np.bincount(group)[group] > 1
            first = np.flatnonzero(new & shared)
            docs = batch.column(0).take(pa.array(np.concatenate((rows, rows[first]))))
            kind = np.concatenate((np.where(shared, SURE, SEND), np.full(len(first), SEEN_TWICE))).astype(np.int8)
            halves = np.concatenate((halves, halves[first]))
            # pairs that need no filter are dealt by row, so that a frequent line's spread
            spread = mix(np.concatenate((rows, rows[first])).astype(_U) + halves[:, 1].view(_U)).view(np.int64)
            dealt = np.where(kind == SURE, spread, halves[:, 0])
            columns = [pa.array(dealt), pa.array(halves[:, 0]), pa.array(halves[:, 1]), docs, pa.array(kind, pa.int8())]
            yield pa.RecordBatch.from_arrays(columns, ["dealt", "high", "low", "doc_id", "kind"])

    return run


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of one hash range whose name was seen twice, or passes a filter as if it were."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    once, twice = (Bloom(sum(b.num_rows for b in held)) for _ in range(2))
    for batch in held:
        hashes, kind = batch.column(1).to_numpy().view(_U), batch.column(4).to_numpy()
        several = np.unique(hashes[kind == SEEN_TWICE])
        hashes, counts = np.unique(hashes[kind == SEND], return_counts=True)
        twice.add(np.concatenate((several, hashes[once.holds(hashes) | (counts > 1)])))
        once.add(np.concatenate((hashes, several)))
    for batch in held:
        kind = batch.column(4).to_numpy()
        kept = (kind == SURE) | (kind == SEND) & twice.holds(batch.column(1).to_numpy().view(_U))
        yield batch.filter(pa.array(kept)).select(["high", "low", "doc_id"])


def repeated_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, names): the lines that a document loses, by the 128-bit name of their key.

    A line's key is the line without blanks at both ends, A-Z lower-cased. Keys of at least ``min_chars`` code points in at
    least ``min_docs`` documents go from all of them but the greatest doc_id. Rows with the same doc_id are one document,
    those without an id too, which counts as the least. A null or empty text has no such line. An empty table gives an empty result;
    further columns are not read.
    """
    spark = documents.sparkSession
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", text_or_empty().alias("text"))
    # a filter's share of the lines must not grow with the corpus
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / RANGE_BYTES))
    named = rows.mapInArrow(_named(min_chars), f"dealt bigint, high bigint, low bigint, doc_id {kind}, kind tinyint")
    suspects = named.repartition(ranges, "dealt").mapInArrow(_suspects, f"high bigint, low bigint, doc_id {kind}")
    pairs = stage(suspects.distinct(), "line-pairs")
    confirmed = pairs.groupBy("high", "low").agg(F.count("*").alias("n"), F.max("doc_id").alias("kept")).where(F.col("n") >= min_docs)
    found = lookup_join(pairs, confirmed.drop("n"), ["high", "low"], summarised=True).where(~F.col("doc_id").eqNullSafe(F.col("kept")))
    # at most the lines of one document
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("high", "low")).alias("names"))


def _kept(min_chars: int):
    """What is left of the last but one column's text without the names of the last; adds the numbers of lines and lines dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, names, counts, gone = [], batch.column(batch.num_columns - 1), [], []
            for i, text in enumerate(batch.column(batch.num_columns - 2).to_pylist()):
                raw = (text or "").encode()
                lines = raw.split(b"\n")
                lost = names[i].values if names[i].is_valid else None
                if lost is not None and len(lost):
                    pair = np.column_stack([lost.field(j).to_numpy() for j in range(2)]).astype("<i8")
                    drop = {p.tobytes() for p in pair}
                    left = [x for x in lines if key_of(x, min_chars) not in drop]
                    texts.append(b"\n".join(left).decode())
                    gone.append(len(lines) - len(left))
                else:
                    texts.append(text)
                    gone.append(0)
                counts.append(len(lines))
            kept = [batch.column(i) for i in range(batch.num_columns - 2)]
            columns = [*kept, pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-2], "text", "n_lines", "n_dropped"])

    return run


def drop_repeated_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with all their columns, ``text`` without the lines of ``repeated_lines``, as (row, text, n_lines, n_dropped).

    ``row`` holds the columns by position (see ``text.unpacked``). A null text stays null and counts as one empty line; a text that
    loses all lines is empty. Lines that stay are unchanged and joined by a line feed. Repeated rows stay, each with its lines.
    """
    lost = stage(repeated_lines(documents, min_chars, min_docs), "lost-lines")
    rows = packed(documents).withColumn("doc_id", F.col(f"row.c{documents.columns.index('doc_id')}"))
    lost = lost.select(F.col("doc_id").alias("lost_id"), "names")
    joined = rows.join(lost, F.col("doc_id").eqNullSafe(F.col("lost_id")), "left").select("row", "text", "names")
    kind = rows.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_kept(min_chars), f"row {kind}, text string, n_lines bigint, n_dropped bigint")


def without_repeated_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``drop_repeated_lines`` with the columns of the documents."""
    return drop_repeated_lines(documents, min_chars, min_docs).select(*unpacked(documents.columns, text=F.col("text")))


def line_report(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) per row; the hash is of what is left of its text, a null text being empty."""
    left = drop_repeated_lines(documents.select("doc_id", "text"), min_chars, min_docs)
    return left.select(F.col("row.c0").alias("doc_id"), "n_lines", "n_dropped", F.sha2(text_or_empty().cast("binary"), 256).alias("kept_sha256"))
