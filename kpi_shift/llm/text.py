"""Hashed words of whole Arrow string columns, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass(frozen=True)
class Alphabet:
    """Which UTF-8 bytes form words; ``fold`` treats A-Z as a-z."""

    breaks: bytes
    fold: bool = False

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        return _tables(self)


@lru_cache
def _tables(alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    inside = np.ones(256, bool)
    inside[list(alphabet.breaks)] = False
    values = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
    if alphabet.fold:
        values[65:91] = values[97:123]
        inside[65:91] = True
    return inside, values


#: Words between white space, unchanged.
SPACED = Alphabet(b" \t\n\r\x0b\x0c")
#: Runs of digits, letters and everything beyond ASCII, A-Z lower-cased.
PLAIN = Alphabet(bytes(i for i in range(128) if not (48 <= i < 58 or 65 <= i < 91 or 97 <= i < 123)), fold=True)


@lru_cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    return tuple(
        np.concatenate(([_U(1)], np.cumprod(np.full(size, b, _U), dtype=_U))) for b in (_BASE, pow(_BASE, -1, 1 << 64))
    )


def hashed_words(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, ...]:
    """Hash, first byte and end of each word of the texts ``data[offsets[i]:offsets[i + 1]]``, and words per text."""
    n, texts = len(data), len(offsets) - 1
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, _U), none, none, np.zeros(texts, np.int64)
    inside, values = alphabet.tables()
    word = inside[data]
    edge = np.ones(n + 1, bool)
    edge[1:n] = ~word[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(word & edge[:-1])
    edge = np.ones(n + 1, bool)
    edge[:n] = ~word
    edge[offsets] = True
    ends = np.flatnonzero(word & edge[1:]) + 1
    power, inverse = _powers(1 << max(20, int(n).bit_length()))
    sums = np.zeros(n + 1, _U)
    np.cumsum(values[data] * power[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    hashes[hashes == 0] = 1  # 0 is free to mark the gap between two texts
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, starts, ends, counts


def texts_of(column: pa.Array | pa.ChunkedArray, chunk: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts in runs of about ``chunk`` bytes: first and end row, bytes, and where each text starts in them.

    A null text counts as an empty one; a text longer than ``chunk`` is a run of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    body = column.buffers()[2] if len(column) else None
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + chunk, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def rolling(words: np.ndarray, size: int, odd: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of each run of ``size`` words; empty if there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    for i in range(size):
        total = total * _U(odd) + words[i : i + n]
    return mix(total)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def packed(documents: DataFrame, text: str = "text") -> DataFrame:
    """The whole row as one column ``row``, beside its ``text``: further columns travel along, whatever their names."""
    names = [f"c{i}" for i in range(len(documents.columns))]
    whole = F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(documents.columns, names, strict=True)])
    return documents.select(whole.alias("row"), F.col(text).alias("text"))


def unpacked(columns: list[str], **replaced: Column) -> list[Column]:
    """The columns of a packed row again, those in ``replaced`` with another value."""
    return [replaced.get(c, F.col(f"row.c{i}")).alias(c) for i, c in enumerate(columns)]
