"""Spelling variants of a corpus's words: range searches in k-d trees over letter counts.

One inserted or deleted letter moves a word's vector of letter counts by 1 in L1 distance, one replaced letter by 2. So the
near words of a word lie in a small ball, and for each pair of lengths (equal, or one apart) a k-d tree over the longer
words' vectors is searched for it; boxes farther away than the edit allows are pruned, and what is left is verified letter
by letter.

The trees are dealt: for each length the upper levels, fitted to a sample of at most ``SAMPLE`` words, cut the space into
cells. Each word is held by one cell and visits those that its ball touches. A task builds the lower levels of one cell from its words and
streams the visitors through it. Pairs never leave a cell: a word gets its number of near words there and the best of them, and
these are combined by word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.lookup import lookup_join
from kpi_shift.functions.stage import stage

MIN_CHARS = 5
MIN_COUNT = 3
GAIN = 2
# Letters of a word; only A-Z are lower-cased. One run in SPOILT loses a letter.
RUN = "[a-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPOILT = 97

SAMPLE = 50_000
CELL = 8_192
#: A cell of the sample is not cut below this size.
CELL_SAMPLE = 24
LEAF = 64
#: Cuts between two levels whose boxes are tested.
STRIDE = 4
QUESTIONS = 4_096
#: From this length on cells hold fewer words.
LONG = 64
LETTERS = 26 + 64
OWN, INSIDER, VISITOR = 0, 1, 2


def word_counts(documents: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, spoilt: int | None = SPOILT) -> DataFrame:
    """(word, n) of the words of at least ``min_chars`` code points that occur at least ``min_count`` times in all texts.

    A word is a maximal run of letters up to U+00FF with A-Z lower-cased. With ``spoilt``, a run for which that number divides the hash of
    "<doc_id>:<run>" loses the letter at the hash modulo its length. A null text has no words, a null id counts as empty.
    """
    runs = F.regexp_extract_all(F.translate("text", CAPITALS, SMALL), F.lit(f"({RUN})"), F.lit(1))
    rows = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    rows = rows.where(F.length("run") >= min_chars)
    word = F.col("run")
    if spoilt:
        rows = rows.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
        less = F.expr("overlay(run placing '' from cast(h % length(run) as int) + 1 for 1)")
        word = F.when(F.col("h") % spoilt == 0, less).otherwise(word)
    counted = rows.select(word.alias("word")).where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def codes_of(words: list[str]) -> np.ndarray:
    """The code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def vectors(codes: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each row."""
    letter = np.where(codes < 192, codes.astype(np.int64) - 97, codes.astype(np.int64) - 192 + 26)
    at = (np.arange(len(codes))[:, None] * LETTERS + letter).ravel()
    return np.bincount(at, minlength=len(codes) * LETTERS).reshape(-1, LETTERS).astype(np.int32)


def best_cut(points: np.ndarray) -> tuple[int, int] | None:
    """Letter and count that split the points (at most, more) most evenly; none if all are equal."""
    low, high = points.min(axis=0), points.max(axis=0)
    best, found = 2.0, None
    for count in (0, 1, 2):
        off = np.abs((points <= count).mean(axis=0) - 0.5)
        off[(low > count) | (high <= count)] = 2
        letter = int(off.argmin())
        if off[letter] < best:
            best, found = float(off[letter]), (letter, count)
    if found is None and (high > low).any():  # all counts are large
        letter = int((high - low).argmax())
        found = letter, int(low[letter] + (high[letter] - low[letter]) // 2)
    return found


@dataclass
class Node:
    """A box of a k-d tree: its parts some cuts below it, or the points in it. Boxes of parts are kept together, as unary rows."""

    rows: np.ndarray
    parts: list[Node]
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Tree:
    """A k-d tree over letter counts.

    Counts are written in unary, up to the greatest that matters for a letter (``caps``), so that the product of two rows is
    the number of letters they share. With it a box tells for many points at once how many letters a word in it has too many
    (``lack``) or too few (``over``) at least. ``cells`` says that boxes are the half-spaces of the cuts, not the least boxes around the points.
    """

    def __init__(self, points: np.ndarray, leaf: int, cells: bool = False):
        self.cells, self.leaves = cells, 0
        self.caps = np.zeros(LETTERS, np.int32) if cells else points.max(axis=0)
        everywhere = np.zeros(LETTERS, np.int32), np.full(LETTERS, np.iinfo(np.int32).max, np.int32)
        self.root, boxes = self._grow(points, np.arange(len(points)), *everywhere, leaf), []
        self.columns = [(letter, k) for letter in range(LETTERS) for k in range(1, int(self.caps[letter]) + 1)]
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if node.parts:
                boxes = node.low, node.high
                node.low, node.high = (self.unary(np.array(side)) for side in boxes)
                waiting += node.parts

    def _grow(self, points: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray, leaf: int) -> Node:
        pieces = [(rows, low, high)]
        for _ in range(STRIDE):
            cut_further = []
            for rows_, low_, high_ in pieces:
                cut = best_cut(points[rows_]) if len(rows_) > leaf else None
                if cut is None:
                    cut_further.append((rows_, low_, high_))
                    continue
                letter, count = cut
                if self.cells:
                    self.caps[letter] = max(self.caps[letter], count + 1)
                under, under_high, over_low = points[rows_, letter] <= count, high_.copy(), low_.copy()
                under_high[letter], over_low[letter] = count, count + 1
                cut_further += [(rows_[under], low_, under_high), (rows_[~under], over_low, high_)]
            pieces = cut_further
        if len(pieces) == 1:
            self.leaves += 1
            return Node(rows if not self.cells else np.array([self.leaves - 1]), [])
        parts = [self._grow(points, *piece, leaf) for piece in pieces]
        if self.cells:
            return Node(rows, parts, [low_ for _, low_, _ in pieces], [high_ for _, _, high_ in pieces])
        own = [points[rows_] for rows_, _, _ in pieces]
        return Node(rows, parts, [o.min(axis=0) for o in own], [o.max(axis=0) for o in own])

    def unary(self, points: np.ndarray) -> np.ndarray:
        letter = np.array([c for c, _ in self.columns], np.int64)
        return (points[:, letter] >= np.array([k for _, k in self.columns], np.int64)).astype(np.float32)

    def near(self, points: np.ndarray, lack: int, over: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Members of leaves, with the rows (and their unary form) that have at most ``lack`` letters too few and ``over`` too many for a word in the leaf's box."""
        written = self.unary(points)
        size = written.sum(axis=1) if self.cells else points.sum(axis=1)
        waiting = [(self.root, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            own = written[rows]
            if not node.parts:
                yield node.rows, rows, own
                continue
            short = node.low.sum(axis=1) - own @ node.low.T
            spare = size[rows][:, None] - own @ node.high.T
            open_ = (short <= lack) & (spare <= over)
            waiting += [(part, rows[open_[:, i]]) for i, part in enumerate(node.parts) if open_[:, i].any()]


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows in which the two words differ by exactly one replaced letter (equal lengths) or one inserted one."""
    size = short.shape[1]
    if size == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    ahead, behind = short != long[:, :-1], short != long[:, 1:]
    kept = np.where(ahead.any(axis=1), ahead.argmax(axis=1), size)  # letters before the inserted one
    return ~(behind & (np.arange(size) >= kept[:, None])).any(axis=1)


class Cell:
    """The words of one length in one cell, with their tree."""

    def __init__(self, words: list[str], counts: np.ndarray):
        self.words, self.counts, self.codes = np.array(words, object), counts, codes_of(words)
        self.points = vectors(self.codes)
        self.tree = Tree(self.points, LEAF)
        self.written = self.tree.unary(self.points)
        self.rank = ranks(self.words, counts)

    def pairs(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of ``codes``, own rows) that are one edit apart, leaf by leaf: they share all letters but the one replaced, or all of the shorter word."""
        replaced = int(self.codes.shape[1] == codes.shape[1])
        for held, asked, written in self.tree.near(vectors(codes), 1, replaced):
            shared = written @ self.written[held].T
            a, b = np.nonzero(shared == codes.shape[1] - replaced)
            a, b = asked[a], held[b]
            right = one_edit(codes[a], self.codes[b])
            if right.any():
                yield a[right], b[right]


def ranks(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places in the order of descending count, equal ones by word."""
    out = np.empty(len(words), np.int64)
    out[np.lexsort((np.argsort(np.argsort(words)), -counts))] = np.arange(len(words))
    return out


class Tally:
    """Numbers of near words and the best of them (count, word), for a list of words."""

    def __init__(self, size: int):
        self.near = np.zeros(size, np.int64)
        self.best: list[tuple[int, str] | None] = [None] * size

    def add(self, rows: np.ndarray, ranks: np.ndarray, others: np.ndarray, counts: np.ndarray) -> None:
        """Near words ``others`` of ``rows``; the one of least rank is a row's best."""
        order = np.lexsort((ranks, rows))
        rows, others, counts = rows[order], others[order], counts[order]
        first = np.concatenate(([True], rows[1:] != rows[:-1]))
        np.add.at(self.near, rows, 1)
        for row, word, n in zip(rows[first].tolist(), others[first].tolist(), counts[first].tolist(), strict=True):
            if self.best[row] is None or (-n, word) < (-self.best[row][0], self.best[row][1]):
                self.best[row] = (n, word)

    def told(self, words: list[str]) -> pa.RecordBatch | None:
        found = [i for i, b in enumerate(self.best) if b is not None]
        if not found:
            return None
        columns = [
            pa.array([words[i] for i in found], pa.string()),
            pa.array(self.near[found], pa.int64()),
            pa.array([-self.best[i][0] for i in found], pa.int64()),
            pa.array([self.best[i][1] for i in found], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "less", "form"])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, side, size): a cell's own words, then those that ask there, the shorter ones first."""
    current, held, counts = None, [], []
    cell: Cell | None = None
    owed: Tally | None = None
    for batch in batches:
        names, side, size = (batch.column(c).to_numpy() for c in ("cell", "side", "size"))
        word, n = batch.column("word"), batch.column("n")
        cuts = np.flatnonzero((names[1:] != names[:-1]) | (side[1:] != side[:-1]) | (size[1:] != size[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(names)], strict=True):
            if a == b:
                continue
            if names[a] != current:
                if owed is not None and (told := owed.told(cell.words.tolist())) is not None:
                    yield told
                current, held, counts, cell, owed = names[a], [], [], None, None
            if side[a] == OWN:
                held += word[a:b].to_pylist()
                counts += n[a:b].to_pylist()
                continue
            if not held:
                continue  # nothing to find
            if cell is None:
                cell, owed = Cell(held, np.array(counts, np.int64)), Tally(len(held))
            for at in range(a, b, QUESTIONS):
                asking = np.array(word[at : min(b, at + QUESTIONS)].to_pylist(), object)
                asked = n[at : min(b, at + QUESTIONS)].to_numpy()
                tally, rank = Tally(len(asking)), ranks(asking, asked)
                for theirs, own in cell.pairs(codes_of(asking.tolist())):
                    tally.add(theirs, cell.rank[own], cell.words[own], cell.counts[own])
                    if side[a] == VISITOR:  # a cell's own words ask each other both ways
                        owed.add(own, rank[theirs], asking[theirs], asked[theirs])
                if (told := tally.told(asking.tolist())) is not None:
                    yield told
    if owed is not None and (told := owed.told(cell.words.tolist())) is not None:
        yield told


def _dealt(trees: dict[int, Tree]):
    """Each word to the cell that holds it, to hold and to ask, and to cells it visits: of the next length, and those of its own that come after its own.

    A pair of equal lengths in two cells meets in the later one only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
            sizes = np.array([len(w) for w in words], np.int64)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                points = vectors(codes_of(words[rows].tolist()))
                home, made = np.zeros(len(rows), np.int64), []
                if size in trees:
                    for number, inside, _ in trees[size].near(points, 0, 0):
                        home[inside] = number[0]
                    for number, asked, _ in trees[size].near(points, 1, 1):
                        asked = asked[number[0] > home[asked]]
                        made.append((asked, size, number[0], VISITOR))
                every = np.arange(len(rows))
                made += [(every, size, home, OWN), (every, size, home, INSIDER)]
                if size + 1 in trees:
                    made += [(asked, size + 1, number[0], VISITOR) for number, asked, _ in trees[size + 1].near(points, 1, 0)]
                else:
                    made.append((every, size + 1, 0, VISITOR))
                at = rows[np.concatenate([m[0] for m in made])]
                cell = np.concatenate([np.broadcast_to((length << 24) + np.asarray(number, np.int64), len(some)) for some, length, number, _ in made])
                side = np.concatenate([np.full(len(some), side, np.int8) for some, _, _, side in made])
                columns = [pa.array(cell), pa.array(side), pa.array(words[at], pa.string()), pa.array(n[at]), pa.array(sizes[at])]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "side", "word", "n", "size"])

    return run


def fit_cells(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> dict[int, Tree]:
    """Trees of cells of about ``cell`` words (fewer very long ones), for the lengths with more than that, from a sample of at most ``sample`` words.

    The sample bounds the trees: a cell holds ``CELL_SAMPLE`` of it at least. In a vocabulary of over ``sample * cell / CELL_SAMPLE``
    words the cells grow instead.
    """
    total = words.count()
    if not total:
        return {}
    # a share that gives about `sample` words; tasks send the driver no more than that together
    rate = max(1, math.ceil(total / (0.9 * sample)))
    chosen = [r.word for r in words.select("word").where(F.pmod(F.xxhash64("word"), F.lit(rate)) == 0).limit(sample).collect()]
    by_length: dict[int, list[str]] = {}
    for word in chosen:
        by_length.setdefault(len(word), []).append(word)
    trees = {}
    for length, some in by_length.items():
        expected = len(some) * total / len(chosen)
        size = min(cell, math.ceil(cell * LONG / length))
        if expected > size and len(some) > CELL_SAMPLE:
            trees[length] = Tree(vectors(codes_of(some)), max(CELL_SAMPLE, math.ceil(size * len(some) / expected)), cells=True)
    return trees


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """(word, n_near, form, form_n) of the distinct ``words`` (word, n) that have near words; ``form`` is the one of greatest n, of equals the smallest."""
    dealt = words.mapInArrow(_dealt(fit_cells(words, cell, sample)), "cell bigint, side tinyint, word string, n bigint, size bigint")
    ordered = dealt.repartition("cell").sortWithinPartitions("cell", "side", "size")
    found = ordered.mapInArrow(_searched, "word string, n_near bigint, less bigint, form string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best"))
    return best.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(words: DataFrame) -> DataFrame:
    """(word, root) of the words (word, form) that have a form: the end of the chain of forms.

    Every step doubles the part of a chain that is known, and chains are as short as the counts' growth along them
    makes them, so a few steps do.
    """
    known = stage(words.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stage(lookup_join(known, onward, ["root"], "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        known = further.select("word", "root")
        if further.where("next is not null").isEmpty():
            return known


def spelling_variants(words: DataFrame, gain: int = GAIN, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each of the distinct ``words`` (word, n), which are all of letters up to U+00FF.

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its near word of greatest n, of equals
    the smallest, if that n is at least ``gain`` times its own (``gain`` above 1, so that chains end); else form and form_n are null and the word is its own root.
    An empty table gives an empty result; further columns are not read.
    """
    words = stage(words.select("word", F.col("n").cast("bigint").alias("n")), "words")
    near = near_words(words, cell, sample)
    joined = words.join(near, "word", "left")
    is_form = F.col("form_n") >= gain * F.col("n")
    told = joined.select(
        "word",
        F.when(is_form, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("form_n")).alias("form_n"),
    )
    told = stage(told, "forms")
    ends = roots(told)
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants_of_texts(documents: DataFrame) -> DataFrame:
    """``spelling_variants`` of the ``word_counts`` of the documents."""
    return spelling_variants(word_counts(documents))
