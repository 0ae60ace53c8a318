import hashlib
import random

import numpy as np
import pytest

from kpi_shift.llm import substrings
from tests.llm.helpers import clashing, documents, prose, spaced


def brute(pairs, window):
    first = {}
    for d, text in pairs:
        w = spaced(text)
        for i in range(len(w) - window + 1) if d is not None else ():
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, text in pairs:
        w = spaced(text)
        gone = set()
        for i in range(len(w) - window + 1) if d is not None else ():
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def case():
    rng = random.Random(6)
    shared = [prose(n, 500 + n) for n in (49, 50, 51, 60, 120)]
    pairs = []
    for i in range(50):
        parts = [prose(rng.randrange(0, 90), i)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared), prose(rng.randrange(0, 60), 1000 + rng.randrange(10**6))]
        pairs.append((i * 3, rng.choice([" ", "\n", " \t"]).join(parts)))
    pairs += [(7, pairs[4][1]), (8, pairs[4][1]), (12, pairs[4][1]), (12, pairs[4][1]), (12, shared[4]), (None, shared[4]), (None, None)]
    pairs += [(200, None), (201, ""), (202, "a " * 300), (203, "a " * 200), (204, "short"), (205, "short"), (206, prose(9000, 1)), (207, prose(9000, 1)[20:]), (208, "\x1c é " * 40)]
    rng.shuffle(pairs)
    return pairs


@pytest.mark.parametrize(("window", "run", "loads"), [(50, 10, 200_000), (12, 4, 100)])
def test_equals_brute_force(spark, monkeypatch, window, run, loads):
    monkeypatch.setattr(substrings, "STREAM_WORDS", loads)
    monkeypatch.setattr(substrings, "SHARD_WINDOWS", loads)
    pairs = case()
    got = substrings.repeats_removed(clashing(documents(spark, pairs)), window, run)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(pairs, window)


def test_empty_table_and_nothing_repeated(spark):
    docs = documents(spark, [prose(60, 1), prose(60, 2)])
    assert substrings.repeats_removed(docs.limit(0)).count() == 0
    assert {r.n_removed for r in substrings.repeats_removed(docs).collect()} == {0}
    texts = documents(spark, [prose(60, 1), "new " + prose(60, 1) + " end", prose(60, 1)])
    assert sorted(map(tuple, substrings.shortened_texts(texts).collect())) == [(1, "new end"), (2, "")]


def test_every_window_has_an_anchor():
    words = np.random.default_rng(1).integers(1, 50, 3000).astype(np.uint64)
    at = substrings.anchors(words, 50, 10)
    starts = np.arange(len(words) - 49)
    nxt = at[np.minimum(np.searchsorted(at, starts), len(at) - 1)]
    assert (nxt >= starts).all() and (nxt <= starts + 40).all()
    # equal windows have equal anchors
    twice = np.concatenate((words[100:180], words[500:520], words[100:180]))
    a = substrings.anchors(twice, 50, 10)
    inner = [x for x in a if x + 10 <= 80 and x >= 0]
    assert {x + 100 for x in inner if 40 <= x + 100 <= 110} <= set(a.tolist()) | {x + 100 for x in inner}


def test_automaton_matches_substrings():
    rng = random.Random(2)
    texts = [[rng.randrange(3) for _ in range(rng.randrange(1, 40))] for _ in range(12)]
    automaton = substrings.SuffixAutomaton()
    for d, t in enumerate(texts):
        automaton.add(t, d)
    automaton.finish()
    for t in [[rng.randrange(3) for _ in range(60)] for _ in range(10)] + texts:
        found = dict(automaton.matches(t, 5))
        for i in range(len(t) - 4):
            holders = [d for d, x in enumerate(texts) if any(x[k : k + 5] == t[i : i + 5] for k in range(len(x) - 4))]
            assert found.get(i) == (min(holders) if holders else None)
