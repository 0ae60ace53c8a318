"""Benchmark passages in a corpus: every suffix of the benchmark is searched in suffix arrays of the corpus.

Each task turns its documents into shards of about a million words and sorts the shard's suffixes that begin with a word
pair of the benchmark (no other suffix can match). All benchmark suffixes then descend the array together, word by word:
two binary searches per word narrow the interval of suffixes that still agree, which yields every verbatim match of a
window and its locations. Nothing is shuffled, and a lost task is repeated from its input alone.

The benchmark is read in blocks of bounded size, each broadcast to one pass over the documents; usually there is one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.stage import stage
from kpi_shift.llm.text import PLAIN, hashed_words, packed, rolling, texts_of, unpacked

WINDOW = 13
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 16 << 20
MATCH = pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("length", pa.int64())])
HIT = pa.struct([("spans", pa.list_(pa.struct([("doc_start", pa.int64()), ("length", pa.int64())]))), ("items", pa.list_(pa.string()))])
HITS = "struct<spans:array<struct<doc_start:bigint,length:bigint>>,items:array<string>>"
MATCHES = "array<struct<item_id:string,item_start:bigint,doc_start:bigint,length:bigint>>"


@dataclass
class Block:
    """Benchmark items as hashed words; a query is a distinct window, whatever number of items hold it."""

    ids: list[str | None]
    words: np.ndarray
    start: np.ndarray  # of each query, in words, where it occurs first
    length: np.ndarray  # words of each query's window
    holders: np.ndarray  # first place of each query in the two lists below, and their end
    item: np.ndarray  # the items that hold a query
    at: np.ndarray  # and where in them, in words


def _block(ids: list, texts: list, window: int) -> Block:
    parts, item, at, offset, length, names, n = [], [], [], [], [], [], 0
    for first, _, data, offsets in texts_of(pa.array(texts, pa.string())):
        words, _, _, counts = hashed_words(data, offsets, PLAIN)
        parts.append(words)
        begin = 0
        for i, count in enumerate(counts.tolist()):
            size = min(count, window)
            if count:
                own = words[begin : begin + count]
                starts = np.arange(count - size + 1)
                item.append(np.full(len(starts), first + i))
                at.append(starts)
                offset.append(np.full(len(starts), n + begin))
                length.append(np.full(len(starts), size))
                # two hashes of 64 bits name a window
                names.append(np.stack([rolling(own, size), rolling(own, size, 0x9E3779B97F4A7C15)]))
            begin += count
        n += begin
    item, at, offset, length = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (item, at, offset, length))
    name = np.concatenate(names, axis=1) if names else np.zeros((2, 0), np.uint64)
    by = np.lexsort((at, item, name[1], name[0], length))
    name, item, at, offset, length = name[:, by], item[by], at[by], offset[by], length[by]
    new = np.ones(len(by), bool)
    new[1:] = (name[:, 1:] != name[:, :-1]).any(axis=0) | (length[1:] != length[:-1])
    first_of = np.flatnonzero(new)
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    start = offset + at
    return Block(ids, words, start[first_of], length[first_of], np.append(first_of, len(by)), item, at)


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The items in blocks of at most ``block_bytes`` of text (one item at least); one block at a time is on the driver."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.coalesce("text", F.lit(""))).toLocalIterator()
    for item, text in rows:
        if ids and size + len(text) > block_bytes:
            yield _block(ids, texts, window)
            ids, texts, size = [], [], 0
        ids.append(item)
        texts.append(text)
        size += len(text)
    yield _block(ids, texts, window)


def suffix_array(words: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """``positions`` in the order of the word sequences that start there, as far as ``depth`` words."""
    order = positions[np.argsort(words[positions], kind="stable")]
    keys = words[order]
    group = np.concatenate(([0], np.cumsum(keys[1:] != keys[:-1]))) if len(order) else np.zeros(0, np.int64)
    tied = np.arange(len(order))
    for d in range(1, depth):
        same = group[tied]
        repeats = np.zeros(len(tied), bool)
        repeats[1:] = same[1:] == same[:-1]
        repeats[:-1] |= repeats[1:]
        tied = tied[repeats]
        if not len(tied):
            break
        keys = words[np.minimum(order[tied] + d, len(words) - 1)]  # the last word is a gap, so going over it is harmless
        by = np.lexsort((keys, group[tied]))
        order[tied] = order[tied[by]]
        keys = keys[by]
        same = group[tied]
        new = np.ones(len(tied), bool)
        new[1:] = (same[1:] != same[:-1]) | (keys[1:] != keys[:-1])
        # ranks stay in order: a group's members take the place of their first
        group[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
    return order


def _narrow(keys_at, low: np.ndarray, high: np.ndarray, key: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of each ``key`` between ``low`` and ``high``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        seen = keys_at(np.where(open_, middle, 0))
        before = open_ & ((seen <= key) if right else (seen < key))
        low = np.where(before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)


def _search(words: np.ndarray, array: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries with matches, and the interval of the array in which their whole window matches."""
    query = np.arange(len(block.start))
    low, high = np.zeros(len(query), np.int64), np.full(len(query), len(array), np.int64)
    done = []
    d = 0
    while len(query) and len(array):
        key = block.words[block.start[query] + d]

        def keys_at(i, d=d):
            return words[np.minimum(array[i] + d, len(words) - 1)]

        low, high = _narrow(keys_at, low, high, key, False), _narrow(keys_at, low, high, key, True)
        d += 1
        alive = low < high
        query, low, high = query[alive], low[alive], high[alive]
        full = block.length[query] == d
        done.append((query[full], low[full], high[full]))
        query, low, high = query[~full], low[~full], high[~full]
    if not done:
        return query, low, high
    return tuple(np.concatenate(x) for x in zip(*done, strict=True))


def _occurrences(words: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Query and place of every occurrence of a window in a shard; ``words`` has a gap (0) after each document."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(block.start):
        return nothing
    width = min(2, int(block.length.min()))
    first = np.unique(block.words[block.start])
    at = np.searchsorted(first, words)
    near = np.flatnonzero((first[np.minimum(at, len(first) - 1)] == words) & (words != 0))
    if width == 2:
        pairs = np.unique(block.words[block.start] * np.uint64(3) + block.words[block.start + 1])
        own = words[near] * np.uint64(3) + words[np.minimum(near + 1, len(words) - 1)]
        at = np.minimum(np.searchsorted(pairs, own), len(pairs) - 1)
        near = near[pairs[at] == own]
    if not len(near):
        return nothing
    array = suffix_array(words, near, int(block.length.max()))
    query, low, high = _search(words, array, block)
    times = high - low
    return np.repeat(query, times), array[_runs(low, times)] if len(query) else nothing[1]


def _runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``first[i]``, ``first[i] + 1``, ... for ``sizes[i]`` numbers, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)


def _shard_matches(words: np.ndarray, doc_of: np.ndarray, doc_first: np.ndarray, block: Block) -> list[list[dict]]:
    """Maximal matches of each document of a shard, one for every item that holds them."""
    found: list[list[dict]] = [[] for _ in doc_first]
    query, position = _occurrences(words, block)
    if not len(query):
        return found
    times = block.holders[query + 1] - block.holders[query]
    holder = _runs(block.holders[query], times)
    position, length = np.repeat(position, times), np.repeat(block.length[query], times)
    doc, item, start = doc_of[position], block.item[holder], block.at[holder]
    by = np.lexsort((start, position - start, item, doc))
    doc, item, start, length, position = (x[by] for x in (doc, item, start, length, position))
    # windows one word apart on one diagonal are one longer match
    joins = (doc[1:] == doc[:-1]) & (item[1:] == item[:-1]) & (position[1:] == position[:-1] + 1) & (start[1:] == start[:-1] + 1)
    begins = np.flatnonzero(np.concatenate(([True], ~joins)))
    lasts = np.concatenate((begins[1:], [len(doc)])) - 1
    for b, e in zip(begins.tolist(), lasts.tolist(), strict=True):
        d = doc[b]
        found[d].append(
            {
                "item_id": block.ids[item[b]],
                "item_start": int(start[b]),
                "doc_start": int(position[b] - doc_first[d]),
                "length": int(length[b] + (e - b)),
            }
        )
    return found


def _shard_hits(words: np.ndarray, doc_of: np.ndarray, doc_first: np.ndarray, block: Block) -> list[dict]:
    """Spans of hit words and the items met, by document of a shard; items times places are never spelled out."""
    found: list[dict] = [{"spans": [], "items": []} for _ in doc_first]
    query, position = _occurrences(words, block)
    if not len(query):
        return found
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, position, 1)
    np.add.at(change, position + block.length[query], -1)
    hit = np.concatenate(([0], (np.cumsum(change) > 0).astype(np.int8)))
    # a gap between documents is never hit, so no span goes over one
    edges = np.diff(hit)
    for s, e in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
        d = doc_of[s]
        found[d]["spans"].append({"doc_start": int(s - doc_first[d]), "length": e - s})
    doc = doc_of[position]
    by = np.lexsort((query, doc))
    doc, query = doc[by], query[by]
    begins = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    known: dict[bytes, list[str]] = {}  # many documents hold the same passages
    for d, own in zip(doc[begins].tolist(), np.split(query, begins[1:]), strict=True):
        own = np.unique(own)
        items = known.get(own.tobytes())
        if items is None:
            sizes = block.holders[own + 1] - block.holders[own]
            met = np.unique(block.item[_runs(block.holders[own], sizes)]).tolist()
            items = known[own.tobytes()] = sorted({block.ids[i] for i in met if block.ids[i] is not None})
        found[d]["items"] = items
    return found


def _shards(column: pa.Array, shard_words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows with their words (a gap after each text), the row of each word and the first word of each row."""
    first, parts, counts, size = 0, [], [], 0

    def shard(end: int):
        n = np.concatenate(counts)
        ends = np.cumsum(n)
        words = np.insert(np.concatenate(parts), ends, np.uint64(0))
        return first, end, words, np.repeat(np.arange(len(n)), n + 1), np.concatenate(([0], np.cumsum(n + 1)[:-1])), n

    for _, end, data, offsets in texts_of(column):
        words, _, _, n = hashed_words(data, offsets, PLAIN)
        parts.append(words)
        counts.append(n)
        size += len(words)
        if size >= shard_words:
            yield shard(end)
            first, parts, counts, size = end, [], [], 0
    if counts:
        yield shard(len(column))


def _scan(block, shard_words: int, search, kind: pa.DataType, merge):
    """Add what ``search`` finds in a block to the column ``found`` by ``merge``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            totals, found = np.zeros(batch.num_rows, np.int64), []
            before = batch.column(batch.schema.get_field_index("found")).to_pylist()
            text = batch.column(batch.schema.get_field_index("text"))
            for first, end, words, doc_of, doc_first, n in _shards(text, shard_words):
                totals[first:end] = n
                found += search(words, doc_of, doc_first, block.value)
            merged = [f if b is None else merge(b, f) for b, f in zip(before, found, strict=True)]
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            columns |= {"n_words": pa.array(totals), "found": pa.array(merged, kind)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _both(a: dict, b: dict) -> dict:
    return {"spans": a["spans"] + b["spans"], "items": sorted({*a["items"], *b["items"]})}


def _searched(documents, benchmark, search, kind, sql_type, merge, window=WINDOW, block_bytes=BLOCK_BYTES, shard_words=SHARD_WORDS) -> DataFrame:
    spark = documents.sparkSession
    rows = documents.select("doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(sql_type).alias("found"))
    for i, block in enumerate(benchmark_blocks(benchmark, window, block_bytes)):
        if i:
            rows = stage(rows, "benchmark-matches")
        rows = rows.mapInArrow(_scan(spark.sparkContext.broadcast(block), shard_words, search, kind, merge), rows.schema)
    return rows


def benchmark_matches(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``doc_id`` and ``text`` of every document with ``n_words`` and all maximal verbatim ``matches`` of a window or more.

    A match is (item_id, item_start, doc_start, length), in words. An item shorter than a window matches as a whole. A
    null or empty text has no words and no matches; repeated rows, also of one id, are judged each for itself; an empty
    table gives an empty result, an empty benchmark no matches. An item without id hits words, but is not named. Further columns of either table are not looked at.
    A passage that many items share is a match for each of them; ``contamination`` does not spell these out.
    """
    rows = _searched(documents, benchmark, _shard_matches, pa.list_(MATCH), MATCHES, list.__add__, window, block_bytes, shard_words)
    return rows.withColumnRenamed("found", "matches")


def _hit_words() -> str:
    """Words inside any span: lengths of the union of the spans, which are visited by their start."""
    return """aggregate(
        array_sort(transform(found.spans, m -> struct(m.doc_start as s, m.doc_start + m.length as e))),
        struct(0L as covered, 0L as upto),
        (a, m) -> struct(a.covered + greatest(0L, m.e - greatest(m.s, a.upto)) as covered, greatest(a.upto, m.e) as upto),
        a -> a.covered)"""


def contamination(documents: DataFrame, benchmark: DataFrame, share: int = 20, **options) -> DataFrame:
    """Per document: words, words inside benchmark windows, the items met, and whether hits are 1/``share`` or more.

    Rows, nulls and empty tables as in ``benchmark_matches``.
    """
    rows = _searched(documents, benchmark, _shard_hits, HIT, HITS, _both, **options)
    return (
        rows.select("doc_id", "n_words", F.expr(_hit_words()).alias("n_hit"), F.col("found.items").alias("items"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
        .select("doc_id", "n_words", "n_hit", "items", "contaminated")
    )


def digest(report: DataFrame) -> DataFrame:
    """The report with the items as their number and a hash of their ids."""
    return report.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    The rows travel through the scan beside their text, so none is joined back.
    """
    rows = packed(documents).withColumnRenamed("row", "doc_id")
    kept = contamination(rows, benchmark, **options).where(~F.col("contaminated"))
    return kept.select(F.col("doc_id").alias("row")).select(*unpacked(documents.columns))
