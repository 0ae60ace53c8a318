"""Fill-in-middle documents, assembled by a secondary sort.

A document is cut into units (lines), and two cuts between units, drawn from a hash of its id, make prefix, middle and suffix.
What is moved are pieces: whole units up to ``CHUNK`` bytes (a longer unit in several), keyed by their row and their position in
the output. One shuffle deals rows to partitions and sorts each by (row, position); a task streams the sorted pieces into
the running digest of the output, whatever its length. For restoration the output is read as it stands: a sentinel at the
head of a piece opens a section, which gives the piece its place in the text; the same partition, sorted again by that
place, is streamed into a second digest. No text is ever put together in one row or one task's memory once it is in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.llm.text import text_or_empty

# The sentinels, and the seed before a document's id.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = "7:"
RATE, SPM_RATE = 100, 50
CHUNK = 1 << 18
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: What only the first piece of a row carries.
HEAD = "form string, n bigint, prefix_chars bigint, middle_chars bigint"
#: Sections in the order of the text; a row's end comes after them.
SECTION_OF = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
END = 3


def draws(doc_id: object, seed: str = SEED) -> list[int]:
    """Four numbers from the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def unit_ends(raw: bytes) -> list[int]:
    """Where each unit, a line with its line feed or the rest, ends."""
    ends, at = [], raw.find(b"\n") + 1
    while at:
        ends.append(at)
        at = raw.find(b"\n", at) + 1
    return ends if not raw or raw.endswith(b"\n") else [*ends, len(raw)]


def form_of(raw: bytes, numbers: list[int], rate: int = RATE, spm_rate: int = SPM_RATE) -> str:
    if not raw or any(s in raw for s in SECTION_OF) or numbers[2] % 100 >= rate:
        return PLAIN
    return SPM if numbers[3] % 100 < spm_rate else PSM


def sections(raw: bytes, doc_id: object, seed: str = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[str, int, list[tuple[bytes, int, int]]]:
    """Form, number of units, and the output's sections in order: sentinel, first byte, end."""
    numbers, ends = draws(doc_id, seed), unit_ends(raw)
    form = form_of(raw, numbers, rate, spm_rate)
    if form == PLAIN:
        return form, len(ends), [(b"", 0, len(raw))]
    cuts = [0, *ends]
    low, high = sorted(cuts[h % len(cuts)] for h in numbers[:2])
    prefix, middle, suffix = (PREFIX, 0, low), (MIDDLE, low, high), (SUFFIX, high, len(raw))
    return form, len(ends), [prefix, suffix, middle] if form == PSM else [suffix, prefix, middle]


def _pieces(raw: bytes, sentinel: bytes, first: int, end: int, chunk: int) -> Iterator[bytes]:
    """One section in pieces of whole units; a unit longer than a chunk is cut."""
    head = sentinel
    while end - first > chunk:
        cut = raw.rfind(b"\n", first, first + chunk) + 1 or first + chunk
        yield head + raw[first:cut]
        head, first = b"", cut
    yield head + raw[first:end]


def _cut(seed: str, rate: int, spm_rate: int, chunk: int) -> Callable:
    """Rows (row, doc_id, text) to pieces (row, position, doc_id, head of the row, piece)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            held = 0

            def flush() -> pa.RecordBatch:
                nonlocal held
                types = (pa.int64(), pa.int32(), batch.schema.field("doc_id").type, pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ("row", "position", "doc_id", "form", "n", "prefix_chars", "middle_chars", "piece")
                made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)
                for column in out:
                    column.clear()
                held = 0
                return made

            for row, doc, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                row, doc, raw = row.as_py(), doc.as_py(), text.as_py().encode()
                form, n, parts = sections(raw, doc, seed, rate, spm_rate)
                chars = {s: None if form == PLAIN else len(raw[a:b].decode()) for s, a, b in parts}
                header = (doc, form, n, chars.get(PREFIX), chars.get(MIDDLE))
                position = 0
                for sentinel, first, end in parts:
                    for piece in _pieces(raw, sentinel, first, end, chunk):
                        values = (row, position, *(header if position == 0 else (None,) * 5), piece)
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                        position, held = position + 1, held + len(piece)
                    if held > 16 * chunk:
                        yield flush()
            if out[0]:
                yield flush()

    return run


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in output order: each gets its place in the text (section, position), and each row an end with its output's digest."""
    row = header = digest = kind = None
    section = 0
    out: list[list] = [[] for _ in range(9)]

    def emit(*values: object) -> None:
        for column, value in zip(out, values, strict=True):
            column.append(value)

    for batch in batches:
        kind = batch.schema.field("doc_id").type
        rows, positions = (batch.column(i).to_pylist() for i in range(2))
        heads = batch.select(["doc_id", "form", "n", "prefix_chars", "middle_chars"])
        for i, piece in enumerate(batch.column(7)):
            piece = piece.as_py()
            if rows[i] != row:
                if row is not None:
                    emit(row, END, 0, *header, digest.digest())
                row, digest, section = rows[i], hashlib.sha256(), 0
                header = [column[i].as_py() for column in heads.columns]
            digest.update(piece)
            if header[1] != PLAIN and piece[:3] in SECTION_OF:
                section, piece = SECTION_OF[piece[:3]], piece[3:]
            emit(row, section, positions[i], *(None,) * 5, piece)
        yield _placed(out, kind)
        out = [[] for _ in range(9)]
    if row is not None:
        emit(row, END, 0, *header, digest.digest())
        yield _placed(out, kind)


def _placed(out: list[list], kind: pa.DataType) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int32(), kind, pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ("row", "section", "position", "doc_id", "form", "n", "prefix_chars", "middle_chars", "piece")
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in text order to one row of results per document."""
    digest = hashlib.sha256()
    for batch in batches:
        done, hashes = [], []
        section = batch.column(1).to_numpy()
        for i, piece in enumerate(batch.column(8)):
            if section[i] != END:
                digest.update(piece.as_py())
                continue
            done.append(i)
            hashes.append((piece.as_py().hex(), digest.hexdigest()))
            digest = hashlib.sha256()
        if done:
            ends = batch.take(pa.array(done)).select(["doc_id", "form", "n", "prefix_chars", "middle_chars"])
            for j, name in enumerate(("output_sha256", "restored_sha256")):
                ends = ends.append_column(name, pa.array([h[j] for h in hashes], pa.string()))
            yield ends


def infill_pieces(documents: DataFrame, seed: str = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, chunk: int = CHUNK) -> DataFrame:
    """(row, position, doc_id, form, n, prefix_chars, middle_chars, piece): the outputs in pieces, each partition sorted by row and position.

    ``row`` numbers the rows of ``documents``; the pieces of one make up its output. Its first piece alone carries id, form,
    number of units, and code points of prefix and middle (null if plain). ``rate`` per cent of the documents are
    transformed, ``spm_rate`` per cent of them with the suffix first. Empty and null texts, and those that contain a sentinel,
    stay plain. Repeated rows, and rows with equal ids, are transformed each for itself; a null id draws as an empty one.
    An empty table gives an empty result; further columns are not read.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_or_empty().alias("text"))
    cut = rows.mapInArrow(_cut(seed, rate, spm_rate, chunk), f"row bigint, position int, doc_id {kind}, {HEAD}, piece binary")
    return cut.repartition("row").sortWithinPartitions("row", "position")


def infill_report(documents: DataFrame, seed: str = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, chunk: int = CHUNK) -> DataFrame:
    """Per row of ``documents``: doc_id, form, n, prefix_chars, middle_chars, and the digests of the output and of the text restored from it.

    See ``infill_pieces`` for what awkward rows give.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    pieces = infill_pieces(documents, seed, rate, spm_rate, chunk)
    placed = pieces.mapInArrow(_assembled, f"row bigint, section int, position int, doc_id {kind}, {HEAD}, piece binary")
    again = placed.sortWithinPartitions("row", "section", "position")
    return again.mapInArrow(_restored, f"doc_id {kind}, {HEAD}, output_sha256 string, restored_sha256 string")
