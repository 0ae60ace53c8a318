"""Passages of 50 words or more that an earlier document holds, found by suffix automata of reference shards.

1. Anchors: in each window of 50 words the run of ten words with the least hash. Equal windows have equal anchors, so only
   windows around anchors of several documents can repeat. A copy of a whole earlier document needs no search.
2. Reference: the first document of each repeated window. Its windows, joined to passages, are all that automata need.
3. Shards: the reference is dealt by document into shards of bounded size. A shard's suffix automaton knows for each state the
   first document that holds its words. Passages of later documents stream through the automata of their shards; where
   the match is a window or longer and its first document an earlier one, the words go.

An automaton is sent to the tasks that have passages for it, instead of to all: broadcasting each shard to every task would
read the corpus once a shard. A shard that many documents share (a passage in a third of all documents) is sent to
several tasks, between which its passages are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.lookup import lookup_join
from kpi_shift.functions.stage import stage
from kpi_shift.llm.buckets import by_bucket, each_bucket
from kpi_shift.llm.text import SPACED, hashed_words, mix, rolling, texts_of

WINDOW = 50
RUN = 10
SHARD_WINDOWS = 40_000
STREAM_WORDS = 200_000
_U = np.uint64
_PLACE = _U((1 << 26) - 1)


def anchors(words: np.ndarray, window: int, run: int) -> np.ndarray:
    """Places of the runs of ``run`` words that are the least, the first of equals, in some window."""
    hashes = rolling(words, run)
    span = window - run + 1
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    # the place in the low bits makes the first of equal runs the least; a longer text takes its places in turns
    value = (hashes & ~_PLACE) | (np.arange(len(hashes), dtype=_U) & _PLACE)
    width = 1
    while 2 * width <= span:
        value = np.minimum(value[: len(value) - width], value[width:])
        width *= 2
    low = np.minimum(value[:n], value[span - width : span - width + n]) & _PLACE
    starts = np.arange(n)
    return np.unique(starts + ((low.astype(np.int64) - starts) & int(_PLACE)))


def _whole(words: np.ndarray) -> bytes:
    """128 bits that name a sequence of words."""
    place = mix(np.arange(1, len(words) + 1, dtype=_U))
    return np.array([mix(words ^ place).sum(dtype=_U), mix(words + place).sum(dtype=_U) ^ _U(len(words))], "<u8").tobytes()


def _tag(key: bytes) -> int:
    """64 bits of a key: they tell the texts of one id apart, and texts that are no copies."""
    return int.from_bytes(key[:8], "little", signed=True)


def _documents(column: pa.Array) -> Iterator[tuple[int, np.ndarray, bytes, np.ndarray, np.ndarray]]:
    """Row, hashed words, text, and where its words start and end in it."""
    for first, end, data, offsets in texts_of(column):
        words, starts, ends, counts = hashed_words(data, offsets, SPACED)
        upto = np.cumsum(counts)
        for i in range(end - first):
            part = slice(int(upto[i] - counts[i]), int(upto[i]))
            text = data[offsets[i] : offsets[i + 1]].tobytes()
            yield first + i, words[part], text, starts[part] - offsets[i], ends[part] - offsets[i]


def _describe(window: int, run: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for _, words, text, _, _ in _documents(batch.column(1)):
                at = anchors(words, window, run)
                hashes = rolling(words, run)[at].view(np.int64) if len(at) else np.zeros(0, np.int64)
                kept = hashlib.sha256(b" ".join(text.split())).hexdigest()
                key = _whole(words)
                for column, v in zip(out, (key, _tag(key), len(words), kept, hashes, at.astype(np.int32)), strict=True):
                    column.append(v)
            types = (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(out, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", "tag", "n_words", "kept_sha256", "anchors", "places"])

    return describe


def _same_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text is the one that their tag names; ids may repeat."""
    for batch in batches:
        tags = batch.column(batch.schema.get_field_index("tag")).to_pylist()
        same = [_tag(_whole(words)) == tags[row] for row, words, _, _, _ in _documents(batch.column(batch.schema.get_field_index("text")))]
        yield batch.filter(pa.array(same, pa.bool_()))


def _starts(places: np.ndarray, n_words: int, window: int, run: int) -> np.ndarray:
    """Windows that hold one of the runs at ``places``."""
    last = n_words - window
    steps = np.zeros(last + 2, np.int64)
    np.add.at(steps, np.maximum(places - (window - run), 0), 1)
    np.add.at(steps, np.minimum(places, last) + 1, -1)
    return np.flatnonzero(np.cumsum(steps[:-1]) > 0)


def _windows(window: int, run: int):
    """(hash, doc_id, tag, start) of each window around a repeated anchor."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column(0), batch.column(1)
            places = batch.column(3).to_pylist()
            rows, starts, hashes = [], [], []
            for row, words, _, _, _ in _documents(batch.column(2)):
                at = _starts(np.array(places[row], np.int64), len(words), window, run)
                rows.append(np.full(len(at), row))
                starts.append(at)
                hashes.append(rolling(words, window)[at])
            if not rows:
                continue
            row = pa.array(np.concatenate(rows), pa.int64())
            columns = [pa.array(np.concatenate(hashes).view(np.int64)), ids.take(row), tags.take(row), pa.array(np.concatenate(starts).astype(np.int32))]
            whole = pa.RecordBatch.from_arrays(columns, ["window", "doc_id", "tag", "start"])
            for first in range(0, whole.num_rows, 50_000):
                yield whole.slice(first, 50_000)

    return windows


def _passages(window: int, shards: int):
    """Runs of windows with their text: a reference where the document is the first to hold them, else to be streamed."""

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags, found = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()
            out: list[list] = [[], [], [], [], [], []]
            for row, _, text, starts, ends in _documents(batch.column(2)):
                pairs = sorted({(f["start"], f["first"]) for f in found[row]})
                start, first = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
                shard = (mix(first.view(_U)) % _U(shards)).astype(np.int64)
                own = first == ids[row]
                cut = (start[1:] != start[:-1] + 1) | (shard[1:] != shard[:-1]) | (own[1:] != own[:-1])
                begins = np.flatnonzero(np.concatenate(([True], cut)))
                for b, e in zip(begins.tolist(), [*(begins[1:] - 1).tolist(), len(start) - 1], strict=True):
                    part = text[starts[start[b]] : ends[start[e] + window - 1]]
                    for column, v in zip(out, (int(shard[b]), not own[b], ids[row], tags[row], int(start[b]), part), strict=True):
                        column.append(v)
            types = (pa.int64(), pa.bool_(), batch.column(0).type, pa.int64(), pa.int64(), pa.binary())
            names = ["shard", "streamed", "doc_id", "tag", "start", "words"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return passages


class SuffixAutomaton:
    """All substrings of the texts added, each state with the first (least) document that holds its substrings."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [float("inf")]

    def _state(self, length: int, link: int, after: dict) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.first.append(float("inf"))
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """The part of ``q`` that is one longer than ``p``, as a state of its own."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.first[clone] = self.first[q]
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words: list[int], document: int) -> None:
        last = 0
        for c in words:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
            else:
                p, last = last, self._state(self.length[last] + 1, 0, {})
                while p >= 0 and c not in self.next[p]:
                    self.next[p][c] = last
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][c]
                    self.link[last] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
            self.first[last] = min(self.first[last], document)

    def finish(self) -> None:
        """What holds a substring holds its suffixes: the first document passes along the suffix links."""
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[v]
            self.first[up] = min(self.first[up], self.first[v])

    def matches(self, words: list[int], window: int) -> Iterator[tuple[int, int]]:
        """Starts of the windows of ``words`` that occur, and the first document of each."""
        v, size = 0, 0
        following, link, length = self.next, self.link, self.length
        for i, c in enumerate(words):
            while v and c not in following[v]:
                v = link[v]
                size = length[v]
            q = following[v].get(c)
            if q is None:
                continue
            v, size = q, size + 1
            while length[link[v]] >= window:  # the state of the last ``window`` words
                v = link[v]
                size = length[v]
            if size >= window:
                yield i - window + 1, self.first[v]


def _stream(window: int):
    def stream(rows: pa.Table) -> pa.Table | None:
        automaton = SuffixAutomaton()
        ids, tags, starts = (rows.column(c).to_pylist() for c in ("doc_id", "tag", "start"))
        words = [w.tolist() for _, w, _, _, _ in _documents(rows.column("words"))]
        streamed = rows.column("streamed").to_pylist()
        for doc, own, later in zip(ids, words, streamed, strict=True):
            if not later:
                automaton.add(own, doc)
        automaton.finish()
        out: list[list] = [[], [], [], []]
        for doc, tag, start, own, later in zip(ids, tags, starts, words, streamed, strict=True):
            if not later:
                continue
            begin = end = -1
            for at, first in automaton.matches(own, window):
                if first >= doc:
                    continue
                if at > end:  # no word in common with the span so far
                    if end >= 0:
                        out[0].append(doc), out[1].append(tag), out[2].append(start + begin), out[3].append(start + end)
                    begin = at
                end = at + window
            if end >= 0:
                out[0].append(doc), out[1].append(tag), out[2].append(start + begin), out[3].append(start + end)
        types = (rows.column("doc_id").type, pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["doc_id", "tag", "start", "end"])

    return stream


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words outside the spans, joined by one blank."""
    for batch in batches:
        spans = batch.column(2).to_pylist()
        out: list[list] = [[], [], []]
        for row, words, text, starts, ends in _documents(batch.column(1)):
            steps = np.zeros(len(words) + 1, np.int64)
            for s in spans[row] or []:
                steps[s["start"]] += 1
                steps[s["end"]] -= 1
            stays = np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()
            kept = b" ".join([text[starts[i] : ends[i]] for i in stays])
            for column, v in zip(out, (kept.decode("utf-8", "replace"), len(words), len(words) - len(stays)), strict=True):
                column.append(v)
        arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.int64()), strict=True))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text", "n_words", "n_removed"])


def _parts(documents: DataFrame, window: int, run: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Described documents; copies of whole earlier ones; documents with repeated anchors and their texts; spans to remove."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.col("text"))
    described = rows.mapInArrow(
        _describe(window, run), f"doc_id {kind}, key binary, tag bigint, n_words bigint, kept_sha256 string, anchors array<bigint>, places array<int>"
    )
    described = stage(described, "anchors")
    first = described.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("key", "first")
    long = described.where(F.col("n_words") >= window).select("doc_id", "key", "tag")
    copies = stage(lookup_join(long, first, ["key"], summarised=True).where("doc_id > first").select("doc_id", "tag").distinct(), "copies")
    originals = described.where(F.col("doc_id").isNotNull() & (F.size("anchors") > 0)).join(copies, ["doc_id", "tag"], "left_anti")
    # without the copies, a tag is one text of one document
    at = originals.select("doc_id", "tag", F.explode(F.arrays_zip("anchors", "places")).alias("at")).select("doc_id", "tag", "at.anchors", "at.places")
    repeated = at.groupBy("anchors").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchors")
    near = lookup_join(at, repeated, ["anchors"], summarised=True).groupBy("tag").agg(F.min("doc_id").alias("doc_id"), F.collect_set("places").alias("places"))
    texts = rows.join(near, "doc_id").select("doc_id", "tag", "text", "places")
    texts = stage(texts.mapInArrow(_same_text, texts.schema), "candidates")
    windows = texts.mapInArrow(_windows(window, run), f"window bigint, doc_id {kind}, tag bigint, start int")
    firsts = windows.groupBy("window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("window", "first")
    firsts = stage(firsts, "windows")
    shards = max(1, -(-firsts.count() // SHARD_WINDOWS))
    found = windows.select("window", "tag", "start").join(firsts, "window").groupBy("tag").agg(F.collect_list(F.struct("start", "first")).alias("found"))
    joined = texts.select("doc_id", "tag", "text").dropDuplicates(["doc_id", "tag"]).join(found, "tag").select("doc_id", "tag", "text", "found")
    passages = joined.mapInArrow(
        _passages(window, shards), f"shard bigint, streamed boolean, doc_id {kind}, tag bigint, start bigint, words binary"
    )
    passages = stage(passages, "passages")
    # a word has some six bytes and a blank
    size = F.sum(F.octet_length("words") / 7)
    loads = passages.where("streamed").groupBy("shard").agg(F.ceil(size / STREAM_WORDS).cast("int").alias("tasks"))
    loads = stage(loads, "loads")
    dealt = passages.join(loads, "shard")
    task = F.when(F.col("streamed"), F.array(F.pmod(F.xxhash64("doc_id", "start"), F.col("tasks")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("tasks") - 1))
    dealt = dealt.withColumn("task", F.explode(task)).select(F.xxhash64("shard", "task").alias("bucket"), "streamed", "doc_id", "tag", "start", "words")
    spans = by_bucket(dealt).mapInArrow(each_bucket(_stream(window)), f"doc_id {kind}, tag bigint, start bigint, end bigint")
    spans = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return described, copies, texts, stage(spans, "spans")


def repeats_removed(documents: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """Per document ``n_words``, ``n_removed`` and ``kept_sha256`` of the words kept, joined by one blank.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller doc_id. A null or
    empty text has no words. Rows with a null id are neither searched nor a reference; rows of one id are no repeats of
    each other, and equal rows get equal results. An empty table gives an empty result; further columns are not read.
    """
    described, copies, texts, spans = _parts(documents, window, run)
    small = described.select("doc_id", "tag", "n_words", "kept_sha256")
    pairs = ["doc_id", "tag"]
    nothing = hashlib.sha256(b"").hexdigest()
    gone = small.join(copies, pairs).select("doc_id", "n_words", F.col("n_words").alias("n_removed"), F.lit(nothing).alias("kept_sha256"))
    changed = texts.join(spans, pairs).select("doc_id", "text", "spans").mapInArrow(_keep, _kept_schema(documents))
    changed = changed.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
    touched = copies.unionByName(spans.select(*pairs))
    same = small.join(touched, pairs, "left_anti").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256")
    return same.unionByName(gone).unionByName(changed)


def _kept_schema(documents: DataFrame) -> str:
    return f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, text string, n_words bigint, n_removed bigint"


def shortened_texts(documents: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """``doc_id`` and the text that is left of every document that loses words."""
    _, copies, texts, spans = _parts(documents, window, run)
    changed = texts.join(spans, ["doc_id", "tag"]).select("doc_id", "text", "spans").mapInArrow(_keep, _kept_schema(documents))
    return changed.select("doc_id", "text").unionByName(copies.select("doc_id", F.lit("").alias("text")))
