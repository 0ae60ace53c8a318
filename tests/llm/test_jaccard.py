import random

import numpy as np
import pyarrow as pa
import pytest

from kpi_shift.llm import jaccard
from tests.llm.helpers import clashing, documents, prose, spaced


def shingles(text):
    w = spaced(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(pairs):
    sets = [shingles(t) for _, t in pairs]
    near = [[j for j in range(len(sets)) if j != i and sets[i] and len(sets[i] & sets[j]) * 10 >= 8 * len(sets[i] | sets[j])] for i in range(len(sets))]
    group = list(range(len(sets)))
    for _ in group:
        group = [min([group[i], *(group[j] for j in near[i])]) for i in range(len(sets))]
    least = {}
    for i, g in enumerate(group):
        ids = [x for x in (least.get(g), pairs[i][0]) if x is not None]
        least[g] = min(ids) if ids else None
    return sorted(((pairs[i][0], least[group[i]], len(near[i]), len({sets[j] for j in near[i]} - {sets[i]})) for i in range(len(sets))), key=repr)


def case(family=40):
    rng = random.Random(4)
    pairs = [(i, prose(rng.randrange(1, 120), i)) for i in range(30)]
    base = prose(90, 999).split()
    for i in range(family):  # near copies of one text, of all degrees
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(50)}"
        pairs.append((100 + i, " ".join(w)))
    pairs += [(200 + i, pairs[3][1]) for i in range(5)] + [(300, None), (301, ""), (302, "  \n"), (303, "a b"), (304, "a b"), (305, "a c"), (306, prose(3000, 8)), (307, prose(3000, 8) + " end")]
    pairs += [(7, pairs[7][1]), (None, pairs[9][1])]
    rng.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("leaf", [1024, 20, 5])
def test_equals_brute_force(spark, leaf):
    pairs = case()
    found = jaccard.near_duplicates(clashing(documents(spark, pairs)), leaf=leaf)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(pairs)


def test_one_of_each_group_stays(spark):
    pairs = case(10)
    docs = clashing(documents(spark, pairs))
    kept = jaccard.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    groups = {r[1] for r in brute(pairs)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(groups)


def test_empty_table_and_no_links(spark):
    docs = documents(spark, ["a b c d e f", "g h i j k l"])
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0
    assert sorted(map(tuple, jaccard.near_duplicates(docs).collect())) == [(0, 0, 0, 0), (1, 1, 0, 0)]


def test_runs_reach_the_recall():
    assert jaccard.runs(0.8) == 8 and 1 - 0.2 ** jaccard.runs(0.8) >= jaccard.RECALL


def test_deep_levels_keep_the_recall_and_count_a_pair_once():
    """Pairs of signatures that agree in each place with their similarity, all buckets of the first levels left to the next."""
    plan = jaccard.levels(0.8)
    assert [len(paths) for paths in plan] == [jaccard.runs(0.8**d) for d in (1, 2, 3, 4)] and plan[1][0][0] not in {p for q in plan[0] for p in q}
    rng = np.random.default_rng(1)
    for deep in range(4):  # the level on which buckets are small enough
        first, n = [sum(len(p) for p in plan[:d]) for d in range(5)], 2000
        agree = rng.random((n, jaccard.PLACES)) < 0.8
        found = np.zeros(n, int)
        for i in range(n):
            places = np.stack([np.zeros(jaccard.PLACES, int), np.where(agree[i], 0, 1)])
            left = [r for d in range(deep) for r, path in enumerate(plan[d], first[d]) if agree[i, list(path)].all()]
            if any(not set(range(first[d], first[d + 1])) & set(left) for d in range(deep)):
                continue  # never met there
            for run, path in enumerate(plan[deep], first[deep]):
                if agree[i, list(path)].all():
                    rows = pa.table({"run": pa.array([run] * 2), "cross": [False] * 2, "side": [0, 0], "left": pa.array([left] * 2, pa.list_(pa.int32()))})
                    found[i] += jaccard._allowed(places, rows, plan)[0, 1]
        assert found.max() == 1 and (found == 0).sum() <= 2


def test_long_texts_make_smaller_leaves(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF_SHINGLES", 2000)
    pairs = case()
    found = jaccard.near_duplicates(documents(spark, pairs), leaf=64)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(pairs)
