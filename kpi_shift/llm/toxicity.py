"""Toxic texts: a lexicon, its misspellings, and the words around each find.

The lexicon is learned from labelled documents: words, and beginnings of words, whose documents are toxic more often than
chance explains. It is kept as a trie. Each word of a text becomes a Levenshtein automaton (bit masks of the positions
reached with 0..k errors) that walks the trie, so all entries within reach are found at once, errors included.

Each entry and number of errors has its own evidence: the log-odds of the labelled documents in which it occurs. Words
in a window around a find add to it or take from it. Quotation marks and words of report count against abuse, direct
address for it; labelled documents move these weights. Evidence becomes a probability by a fitted logistic curve.

The lexicon and the weights are fitted to at most ``SAMPLE`` labelled rows, those whose ids hash lowest.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.stage import stage
from kpi_shift.llm.quality import labelled_sample, logistic_curve
from kpi_shift.llm.text import packed, unpacked

SAMPLE = 10_000
STEM = 4  # shortest beginning of a word that can be an entry
LONGEST = 12  # longest beginning
FUZZY = 5  # entries of so many letters may have an error
WINDOW = 6
ENTRIES = 5_000
ROUNDS = 5
CACHE = 300_000
THRESHOLD = 0.3
WORD = re.compile(r"\w+|[\"“”„«»‹›]")
QUOTES = frozenset("\"“”„«»‹›")
# Words of report and of direct address in the languages at hand.
REPORT = frozenset(
    "quote quoted quotes said says wrote word term called reported zitat zitiert sagte schrieb wort genannt "
    "cita citado dijo escribió palabra llamado cite citation dit écrit mot appelé".split()
)
ADDRESS = frozenset("you your you're ure du dein dich ihr tú tu eres vous votre ton toi".split())


@dataclass
class Entry:
    text: str
    stem: bool
    evidence: list[float] = field(default_factory=lambda: [0.0, 0.0])


def build_trie(entries: list[Entry]) -> dict:
    """Nested dicts by letter; the key "" holds the entries that end there."""
    root: dict = {}
    for i, e in enumerate(entries):
        node = root
        for c in e.text:
            node = node.setdefault(c, {})
        node.setdefault("", []).append(i)
    return root


def lookup(word: str, trie: dict, entries: list[Entry]) -> tuple[int, int] | None:
    """The entry with the fewest errors in ``word`` (at most one, none in short entries), and the errors.

    ``exact`` and ``loose`` are sets of positions in the word, as bits, reached without and with at most one error.
    """
    size = len(word)
    end = 1 << size
    at: dict[str, int] = {}
    for i, c in enumerate(word):
        at[c] = at.get(c, 0) | (1 << i)
    best: tuple[int, int, int] | None = None
    todo = [(trie, 1, 3)]
    while todo:
        node, exact, loose = todo.pop()
        for c, child in node.items():
            if c == "":
                for i in child:
                    e = entries[i]
                    errors = 0 if (exact if e.stem else exact & end) else 1 if len(e.text) >= FUZZY and (loose if e.stem else loose & end) else 2
                    if errors < 2 and (best is None or (errors, -len(e.text), i) < best):
                        best = (errors, -len(e.text), i)
                continue
            mask = at.get(c, 0)
            next_exact = (exact & mask) << 1
            # the letter agrees, is wrong, is missing from the word, or one of the word's letters is surplus
            next_loose = ((loose & mask) << 1) | exact | (exact << 1) | next_exact | (next_exact << 1)
            next_loose &= (end << 1) - 1
            if next_exact | next_loose:
                todo.append((child, next_exact, next_loose))
    return None if best is None else (best[2], best[0])


@dataclass
class Model:
    entries: list[Entry]
    cues: dict[str, float]
    slope: float
    offset: float


class _Finder(dict):
    """Finds by word; kept while there is room.

    One error leaves one half of an entry as it is: only words with a half in its place are made into automata.
    """

    def __init__(self, entries: list[Entry]):
        super().__init__()
        self.entries, self.trie = entries, build_trie(entries)
        self.parts: dict[int, list] = {}

    def _parts(self, size: int) -> list[tuple[int, int, set]]:
        """(place, length, halves) that a word of ``size`` letters shares with any entry in reach."""
        found: dict[tuple[int, int], set] = defaultdict(set)
        for e in self.entries:
            errors = len(e.text) >= FUZZY
            if size < len(e.text) - errors or not e.stem and size > len(e.text) + errors:
                continue
            half = len(e.text) // 2 if errors else len(e.text)
            found[0, half].add(e.text[:half])
            if errors:
                rest = e.text[half:]
                for place in (half - 1, half, half + 1) if e.stem else (size - len(rest),):
                    found[place, len(rest)].add(rest)
        return [(place, place + n, halves) for (place, n), halves in found.items()]

    def possible(self, word: str) -> bool:
        parts = self.parts.get(len(word))
        if parts is None:
            parts = self.parts[len(word)] = self._parts(len(word))
        for a, b, halves in parts:
            if word[a:b] in halves:
                return True
        return False

    def __missing__(self, word: str):
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = lookup(word, self.trie, self.entries) if self.possible(word) else None
        return found


def finds(words: list[str], finder: _Finder) -> list[tuple[int, int, int]]:
    """Place, entry and errors of every find."""
    return [(i, *f) for i, f in enumerate(map(finder.__getitem__, words)) if f is not None]


def context(words: list[str], place: int) -> set[str]:
    """Cues around a find: quotation marks on both sides, words of report or address, and the words themselves."""
    before, after = words[max(0, place - WINDOW) : place], words[place + 1 : place + 1 + WINDOW]
    cues = {"w:" + w for w in (*before, *after)}
    if QUOTES.intersection(before) and QUOTES.intersection(after):
        cues.add("quoted")
    if REPORT.intersection(before):
        cues.add("report")
    if ADDRESS.intersection(before) or ADDRESS.intersection(after):
        cues.add("address")
    return cues


#: Log-odds of a cue before any label is seen, worth so many documents.
PRIOR = {"quoted": -5.0, "report": -2.0, "address": 0.5}
PRIOR_WEIGHT = 8


def evidence(text: str | None, finder: _Finder, cues: dict[str, float]) -> float:
    """Sum over the distinct entries of a text of their strongest find."""
    words = WORD.findall((text or "").lower())
    best: dict[int, float] = {}
    for place, entry, errors in finds(words, finder):
        weight = finder.entries[entry].evidence[errors]
        around = sum(cues.get(c, 0.0) for c in context(words, place)) if cues else 0.0
        best[entry] = max(best.get(entry, 0.0), max(0.0, weight + min(1.0, around)))
    return sum(best.values())


def _terms(words: set[str]) -> set[str]:
    """Words, and beginnings of words, marked by a star."""
    return words | {w[:n] + "*" for w in words for n in range(STEM, min(len(w), LONGEST) + 1)}


def _term_counts(known, wanted=None):
    """Documents without a find so far, by term: those of toxic ones, or of all where a term is ``wanted``.

    The term "" counts the documents themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        finder, chosen = _Finder(known.value), None if wanted is None else wanted.value
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {w for w in WORD.findall((text or "").lower()) if len(w) > 2}
                if any(found is not None and not found[1] for found in map(finder.__getitem__, words)):
                    continue
                counts[label][""] += 1
                if chosen is not None:
                    counts[label].update(_terms(words) & chosen)
                elif label:
                    counts[label].update(_terms(words))
        terms = sorted(counts[0].keys() | counts[1].keys())
        for i in range(0, len(terms), 10_000):
            part = terms[i : i + 10_000]
            columns = [pa.array(part, pa.string()), *(pa.array([counts[k][t] for t in part], pa.int64()) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["term", "clean", "toxic"])

    return run


def choose_entries(rows: list[tuple[str, int, int, float]], known: list[Entry]) -> list[Entry]:
    """Further entries from (term, clean, toxic, gain), greatest gain first; none lies inside another's reach."""
    chosen = list(known)
    stems, taken = {e.text for e in known if e.stem}, {e.text for e in known}
    for term, *_ in sorted(rows, key=lambda r: (-r[3], -r[2], r[1], r[0].endswith("*"), -len(r[0]), r[0])):
        text, stem = term.rstrip("*"), term.endswith("*")
        if text in taken or stems & {text[:n] for n in range(1, len(text))} or stem and any(t.startswith(text) for t in taken):
            continue
        chosen.append(Entry(text, stem))
        taken.add(text)
        if stem:
            stems.add(text)
    return chosen


def _labelled_evidence(chosen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder(chosen.value)
        for batch in batches:
            out: list[list] = [[], [], []]
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = WORD.findall((text or "").lower())
                found = finds(words, finder)
                around = set().union(*(context(words, p) for p, _, _ in found)) if found else set()
                out[0].append(label)
                out[1].append(sorted({f"{e}:{n}" for _, e, n in found}))
                out[2].append(sorted(around))
            types = (pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["label", "found", "around"])

    return run


def _next_entries(rows: DataFrame, known: list[Entry]) -> list[Entry]:
    """Entries that stand out in the documents in which nothing was found so far.

    Only terms of so many toxic documents that they could stand out are counted in the clean ones too; the sample bounds
    their number.
    """
    context = rows.sparkSession.sparkContext
    entries = context.broadcast(known)

    def counted(wanted=None) -> DataFrame:
        counts = rows.mapInArrow(_term_counts(entries, wanted), "term string, clean bigint, toxic bigint")
        return counts.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))

    terms = stage(counted(), "terms")
    total = terms.where("term = ''").first()
    if total is None or not total.clean or not total.toxic:
        return known
    share = total.toxic / (total.clean + total.toxic)
    # a term must stand out from all those that do so by chance, and there are about a few dozen per document
    least = 4.0 + math.log(total.clean + total.toxic)
    enough = terms.where((F.col("term") != "") & (F.col("toxic") * -math.log(share) > least)).select("term")
    wanted = frozenset(r.term for r in enough.collect())
    if not wanted:
        return known
    rate = (F.col("toxic") + 0.5) / (F.col("clean") + F.col("toxic") + 1)
    gain = F.col("toxic") * F.log(rate / share) + F.col("clean") * F.log((1 - rate) / (1 - share))
    strong = counted(context.broadcast(wanted)).where(
        (F.col("term") != "") & (rate > share) & (gain > least)
    ).withColumn("gain", F.round(gain, 6))
    return choose_entries([tuple(r) for r in strong.select("term", "clean", "toxic", "gain").orderBy(F.desc("gain"), F.desc("toxic"), "clean", "term").limit(ENTRIES).collect()], known)


def _log_odds(toxic: float, clean: float, all_toxic: int, all_clean: int) -> float:
    return math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))


def train(documents: DataFrame, labels: DataFrame, training: Column, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit to at most ``sample`` of the rows of ``labels`` for which ``training`` holds.

    Only the sample's ids and labels are broadcast. Entries are chosen in rounds, each from the documents in which nothing
    is found yet, so that rare ones stand out too; only terms that pass the test of significance, at most ``ENTRIES`` a
    round, come to the driver. With a single class, or no label, there is no lexicon: every score is
    the share of toxic labels, drawn towards a tenth as by one more label.
    """
    spark = documents.sparkSession
    chosen = labelled_sample(labels, label, training, sample)
    rows = stage(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text"), "labelled")
    sizes = dict(rows.groupBy("label").count().collect())
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        return Model([], {}, 0.0, math.log((n_toxic + 0.1) / (n_clean + 0.9)))
    entries: list[Entry] = []
    for _ in range(ROUNDS):
        more = _next_entries(rows, entries)
        if len(more) == len(entries):
            break
        entries = more
    seen = rows.mapInArrow(
        _labelled_evidence(spark.sparkContext.broadcast(entries)), "label int, found array<string>, around array<string>"
    )
    n = {0: n_clean, 1: n_toxic}

    def counts(column: str) -> dict:
        by: dict = defaultdict(lambda: [0, 0])
        one = seen.select("label", F.explode(column).alias("key")).groupBy("key", "label").count()
        if column == "around":  # words around finds: only the frequent ones can have a weight
            one = one.where((F.col("count") >= 20) | ~F.col("key").startswith("w:"))
        for key, k, c in one.orderBy(F.desc("count"), "key").limit(4 * ENTRIES).collect():
            by[key][k] = c
        return by

    by_find = counts("found")
    fuzzy = [sum(v[k] for key, v in by_find.items() if key.endswith(":1")) for k in (0, 1)]
    general = _log_odds(fuzzy[1], fuzzy[0], n[1], n[0])
    for i, e in enumerate(entries):
        clean, toxic = by_find.get(f"{i}:0", (0, 0))
        e.evidence[0] = _log_odds(toxic, clean, n[1], n[0])
        clean, toxic = by_find.get(f"{i}:1", (0, 0))
        # misspellings of an entry that labels say nothing about are judged as misspellings in general
        e.evidence[1] = _log_odds(toxic, clean, n[1], n[0]) if clean + toxic >= 3 else min(e.evidence[0], max(general, 0.0) if sum(fuzzy) else 0.8 * e.evidence[0])
    with_find = seen.where(F.size("found") > 0).groupBy("label").count().collect()
    finds_of = {0: 0, 1: 0} | dict(with_find)
    cues = dict(PRIOR)
    for key, (clean, toxic) in counts("around").items():
        own = _log_odds(toxic, clean, finds_of[1], finds_of[0])
        weight = (clean + toxic) / (clean + toxic + PRIOR_WEIGHT)
        if key in PRIOR:
            cues[key] = own * weight + PRIOR[key] * (1 - weight) if min(finds_of.values()) else PRIOR[key]
        elif min(finds_of.values()) >= 20 and clean >= 20 and own < -1:
            cues[key] = max(own, -2.0)
    model = Model(entries, cues, 1.0, 0.0)
    got = rows.mapInArrow(_score(spark.sparkContext.broadcast(model), True), "label int, score double").collect()
    x, y = np.array([r.score for r in got]), np.array([float(r.label) for r in got])
    model.slope, model.offset = logistic_curve(x, y)
    return model


def _score(model, raw: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        finder = _Finder(m.entries)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            values = np.zeros(batch.num_rows)
            if m.entries:
                for first in range(0, batch.num_rows, 256):
                    values[first : first + 256] = [evidence(t, finder, m.cues) for t in texts.slice(first, 256).to_pylist()]
            if not raw:
                values = 1 / (1 + np.exp(-np.clip(m.slope * values + m.offset, -30, 30)))
            yield batch.drop_columns(["text"]).append_column("score", pa.array(values))

    return run


def score(documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``score``, the probability of being toxic, of every row.

    A null or empty text has no finds and gets the lowest score. Repeated rows are scored each for itself, an empty table
    gives an empty result; columns other than ``text`` and ``keep`` are not read.
    """
    rows = documents.select(*keep, "text")
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep) + ", score double"
    return rows.mapInArrow(_score(documents.sparkSession.sparkContext.broadcast(model)), schema)


def reject_toxic(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below ``threshold``, with all their columns."""
    scored = score(packed(documents), model, ("row",))
    return scored.where(F.col("score") < threshold).select(*unpacked(documents.columns))
