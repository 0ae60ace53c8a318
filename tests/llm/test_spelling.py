import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kpi_shift.llm import spelling
from tests.llm.helpers import clashing, documents


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counts(pairs):
    found = Counter()
    for i, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def brute(words):
    form, rows = {}, []
    for w, n in words.items():
        all_near = [v for v in words if near(w, v)]
        best = min(all_near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
        rows.append((w, n, len(all_near)))
    out = []
    for w, n, k in rows:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, k, words.get(form[w])))
    return sorted(out)


def vocabulary(size, seed=2, letters="abcdeé×ÿ"):
    rng = random.Random(seed)
    words = {}
    while len(words) < size:
        w = "".join(rng.choice(letters) for _ in range(rng.choice((5, 5, 6, 6, 7, 9))))
        words[w] = rng.choice((3, 4, 8, 9, 20, 50, 200))
        for _ in range(rng.randrange(3)):  # a variant of it
            i, kind = rng.randrange(len(w)), rng.randrange(3)
            v = w[:i] + rng.choice(letters) * (kind != 0) + w[i + (kind != 1) :]
            if len(v) >= 5:
                words[v] = rng.choice((3, 4, 9, 30))
    return words


LONG = "xy" * 400


@pytest.mark.parametrize("cell", [8_192, 40])
def test_equals_brute_force(spark, settings, cell):
    settings(execution__arrow__maxRecordsPerBatch="64" if cell == 40 else "10000")
    words = {**vocabulary(700), **vocabulary(100, 3, "abcdefghijklmnopqrstuvwxyz"), LONG: 9, LONG + "x": 3, LONG[:-1] + "z": 50, "aaaaa" * 60: 5, "aaaaa" * 60 + "b": 10}
    rows = clashing(spark.createDataFrame(list(words.items()), "word string, n int"))
    if cell == 40:
        assert len(spelling.fit_cells(rows, cell)) >= 3
    found = spelling.spelling_variants(rows, cell=cell)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect())) == brute(words)


def test_words_of_texts(spark):
    rng = random.Random(9)
    base = ["Haus", "Straße", "STRASSE", "größer", "wonderful", "wonderfull", "Élan", "élans", "élanß", "naïve", "naïves", "a" * 300, "x1y", "hello", "hallo", "abcd", "abcde"]
    pairs = [(i, " ".join(rng.choice(base) + rng.choice((" ", "-", "2", "_")) for _ in range(200))) for i in range(60)]
    pairs += [(70, None), (71, ""), (72, "12 34"), (None, "hello wonderful"), (3, pairs[3][1]), (73, "ÀÉ×÷ÿŒ" * 40), (74, "word " * 20_000)]
    docs = clashing(documents(spark, pairs))
    words = counts(pairs)
    assert {r.word: r.n for r in spelling.word_counts(docs).collect()} == words
    assert sorted(map(tuple, spelling.variants_of_texts(docs).collect())) == brute(words)
    assert spelling.variants_of_texts(docs.limit(0)).count() == 0
    assert spelling.variants_of_texts(docs.where("doc_id between 70 and 72")).count() == 0


def test_chains_of_forms(spark):
    words = {"a" * 5 + "bcdefghij"[:k]: 3 * 2**k for k in range(9)}
    assert {r[2] for r in brute(words)} == {"aaaaabcdefghi"[:13]}
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted(map(tuple, spelling.spelling_variants(rows).collect())) == brute(words)


def test_trees_hold_every_point_and_prune():
    rng = np.random.default_rng(4)
    points = rng.poisson(0.3, (3000, spelling.LETTERS)).astype(np.int32)
    asked = points[:200]
    tree = spelling.Tree(points, 50)
    met = {(q, int(p)) for held, rows, _ in tree.near(asked, 1, 1) for q in rows.tolist() for p in held}
    lack, over = (np.maximum(s * (points[None] - asked[:, None]), 0).sum(axis=2) for s in (1, -1))
    assert set(zip(*map(np.ndarray.tolist, np.nonzero((lack <= 1) & (over <= 1))))) <= met
    assert len(met) < 0.2 * 200 * 3000
    cells = spelling.Tree(points[:500], 50, cells=True)
    home = [(int(number[0]), q) for number, rows, _ in cells.near(points, 0, 0) for q in rows.tolist()]
    assert sorted(q for _, q in home) == list(range(3000)) and len({c for c, _ in home}) == cells.leaves > 8
    home = {q: c for c, q in home}
    visited = {(q, int(number[0])) for number, rows, _ in cells.near(asked, 1, 0) for q in rows.tolist()}
    assert {(q, home[p]) for q, p in zip(*map(np.ndarray.tolist, np.nonzero((lack <= 1) & (over <= 0))))} <= visited
