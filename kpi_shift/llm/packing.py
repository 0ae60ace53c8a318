"""Documents as token sequences of fixed capacity, packed by bounded-space online best-fit.

A group of pieces is packed in its order of arrival with a fixed number of open bins. The free spaces of the open bins
are the bits of one integer: the lowest set bit at or above a piece's length is the best fit. A piece that fits nowhere
opens a bin, and if all are in use, the fullest closes first.

Pieces are dealt by a hash of (doc_id, piece) into groups of bounded size, so no document, source or group of copies
weighs on one task. Bins that are open when a group ends are packed again as if each were one piece, until what is left
is one group's work; so only the last few bins of the whole corpus stay partly empty for want of pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.stage import stage
from kpi_shift.llm.text import text_or_empty

CAPACITY = 2048
OPEN_BINS = 256
GROUP_ROWS = 40_000
CACHED_CHUNKS = 400_000
CACHED_WORDS = 800_000
# The vocabulary's pattern of words, for lower-case Latin text, and the characters it covers here.
COMMON = re.compile("[!-~À-ÖØ-öø-ÿ]+")
WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_tokenizers: dict = {}


class _Ids(dict):
    """Token ids, as bytes, of runs of characters without blanks. Kept in a worker while there is room.

    Runs of common Latin characters are cut into words as the vocabulary's own pre-tokenizer does, and each word is
    encoded once; any other run is encoded as it stands.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        # the characters that stand for the bytes of other than ASCII characters
        spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.bytes = {i: spell(chr(i))[0][0] for i in range(0xC0, 0x100)}

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHED_CHUNKS:
            self.clear()
            self[""] = b""
        if COMMON.fullmatch(chunk) and "<|" not in chunk:
            found = b"".join([self.words.get(w) or self._learn_word(w) for w in WORDS.findall(chunk.lower())])
        else:
            found = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        self[chunk] = found
        return found

    def _learn_word(self, word: str) -> bytes:
        if len(self.words) >= CACHED_WORDS:
            self.words.clear()
        found = np.array([t.id for t in self.tokenizer.model.tokenize(word.translate(self.bytes))], "<u4").tobytes()
        self.words[word] = found
        return found


def _ids(path: str) -> _Ids:
    if path not in _tokenizers:
        _tokenizers[path] = _Ids(path)
    return _tokenizers[path]


def _tokenize(path: str, capacity: int, end_id: int, with_ids: bool):
    """Tokens never span a blank with this vocabulary's pre-tokenizer, so each run between blanks is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids_of = _ids(path).__getitem__  # learns what it does not know
        close = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for i in range(0, batch.num_rows, 256):
                ids = batch.column(0).slice(i, 256).to_pylist()
                texts = batch.column(1).slice(i, 256).to_pylist()
                split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
                for doc, chunks in zip(ids, split, strict=True):
                    tokens = b"".join(map(ids_of, chunks)) + close
                    for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                        part = tokens[at : at + 4 * capacity]
                        for column, v in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part), strict=True):
                            column.append(v)
            columns = dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), out, strict=False))
            types = (batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns.values(), types, strict=True)]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(b, "<u4").astype(np.int32) for b in out[5]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, [*columns, *(["ids"] if with_ids else [])])

    return run


def tokenized_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Each document's token ids followed by ``end_id``, cut into pieces of ``capacity``; the last may be shorter.

    ``tokenizer`` is the path of a vocabulary whose pre-tokenizer drops white space, on every executor. A null text
    counts as empty and is one piece of ``end_id``. ``with_ids`` adds the ids themselves.
    """
    schema = PIECES.replace("bigint", documents.schema["doc_id"].dataType.simpleString(), 1) + (", ids array<int>" if with_ids else "")
    rows = documents.select("doc_id", text_or_empty().alias("text"))
    return rows.mapInArrow(_tokenize(tokenizer, capacity, end_id, with_ids), schema)


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int], set[int]]:
    """Bin and offset of each piece, in order, and the bins that are still open at the end."""
    free_bits, by_free = 0, [[] for _ in range(capacity + 1)]
    bins, offsets, used, n_open, last = [], [], [], 0, 0

    def close(free: int) -> None:
        nonlocal free_bits
        by_free[free].pop()
        if not by_free[free]:
            free_bits ^= 1 << free

    for length in lengths:
        fits = free_bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            chosen = by_free[free][-1]
            close(free)
            n_open -= 1
        else:
            chosen, free = len(used), capacity
            used.append(0)
            if n_open >= open_bins and length < capacity:
                close((free_bits & -free_bits).bit_length() - 1)
                n_open -= 1
        bins.append(chosen)
        offsets.append(used[chosen])
        used[chosen] += length
        free -= length
        if free:
            by_free[free].append(chosen)
            free_bits |= 1 << free
            n_open += 1
    return bins, offsets, {b for same in by_free for b in same}


def _pack_group(capacity: int, open_bins: int, keys: list[str], level: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["deal", *keys], kind="stable").reset_index(drop=True)
        bins, offsets, still = best_fit(rows["length"].tolist(), capacity, open_bins)
        base = (level << 58) + (int(key[0]) << 26)  # a group has fewer than 2^26 rows, a level fewer than 2^32 groups
        rows["sequence_id"] = np.array(bins, np.int64) + base
        rows["offset"] = np.array(offsets, np.int64)
        rows["unfilled"] = [b in still for b in bins]
        return rows.drop(columns=["group", "deal"])

    return run


def _pack_once(rows: DataFrame, keys: list[str], capacity: int, open_bins: int, group_rows: int, level: int) -> tuple[DataFrame, int]:
    groups = max(1, -(-rows.count() // group_rows))
    dealt = rows.withColumn("deal", F.xxhash64(*keys, F.lit(level)))
    dealt = dealt.withColumn("group", F.pmod("deal", F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    pack = _pack_group(capacity, open_bins, keys, level)
    packed = dealt.groupBy("group").applyInPandas(pack, schema + ", sequence_id bigint, offset bigint, unfilled boolean")
    return stage(packed, "packed"), groups


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, group_rows: int = GROUP_ROWS, keys: tuple[str, ...] = ("doc_id", "piece")
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and gapless ``offset``; ``keys`` tell pieces apart and set their order of arrival.

    Ties and repeated rows are packed as pieces of their own. Null keys are dealt like any value, further columns are kept.
    Lengths must be between 1 and ``capacity``. An empty table gives an empty result.
    """
    packed, groups = _pack_once(stage(pieces, "pieces"), list(keys), capacity, open_bins, group_rows, 0)
    done = packed.where("not unfilled").drop("unfilled")
    loose, level = packed.where("unfilled").drop("unfilled"), 0
    while groups > 1:
        level += 1
        bins = loose.groupBy(F.col("sequence_id").alias("bin")).agg(F.max(F.col("offset") + F.col("length")).alias("length"))
        moved, groups = _pack_once(bins, ["bin"], capacity, open_bins, group_rows, level)
        moved = moved.select("bin", F.col("sequence_id").alias("to"), F.col("offset").alias("shift"), "unfilled")
        loose = loose.join(moved, loose.sequence_id == moved.bin).withColumns(
            {"sequence_id": F.col("to"), "offset": F.col("offset") + F.col("shift")}
        )
        if groups > 1:
            loose = stage(loose, "loose")
            done = done.unionByName(loose.where("not unfilled").select(*done.columns))
            loose = loose.where("unfilled")
        loose = loose.select(*done.columns)
    return done.unionByName(loose)


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """Pieces of all documents with the sequence and the offset at which each of them is placed."""
    return pack(tokenized_pieces(documents, tokenizer, capacity), capacity, **options)
