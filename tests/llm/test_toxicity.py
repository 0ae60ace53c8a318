import random

from pyspark.sql import functions as F

from kpi_shift.llm import quality, toxicity
from kpi_shift.llm.toxicity import Entry
from tests.llm.helpers import clashing, documents, prose
from tests.llm.test_quality import labels

ENTRIES = [Entry(w, False) for w in ("idiot", "scum", "worthless")] + [Entry(w, True) for w in ("lowei", "vequ")]


def distance_row(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row


def brute(word):
    best = []
    for i, e in enumerate(ENTRIES):
        row = distance_row(e.text, word)
        errors = min(row) if e.stem else row[-1]
        if errors == 0 or errors == 1 and len(e.text) >= toxicity.FUZZY:
            best.append((errors, -len(e.text), i))
    return (min(best)[2], min(best)[0]) if best else None


def test_automaton_finds_what_edit_distance_says():
    rng, finder = random.Random(3), toxicity._Finder(ENTRIES)
    words = {e.text for e in ENTRIES} | {prose(1, s) for s in range(50)} | {"", "é", "idiots", "xidiot"}
    for e in ENTRIES:
        for _ in range(150):
            w = list(e.text + rng.choice(["", "", "ab", "xyz"]))
            for _ in range(rng.randrange(3)):
                i = rng.randrange(len(w) + 1)
                w[i : i + rng.randrange(2)] = rng.choice(["", "a", "o", "é"])
            words.add("".join(w))
    for w in words:
        assert toxicity.lookup(w, finder.trie, ENTRIES) == brute(w), w
        assert finder[w] == brute(w), w


def test_learned_terms_stems_and_misspellings(spark):
    rng = random.Random(1)
    texts, known = [], []
    for i in range(240):
        bad = i % 6 == 0
        words = prose(30, i, 300).split()
        if bad:
            words[rng.randrange(30)] = "idiot" if i % 12 else f"lowei{rng.choice(['er', 'ung', 'ix', 'ol', 'am'])}"
        texts.append(" ".join(words))
        known.append((i, 1, int(bad)))
    more = ["w1 w2 idjot w3", 'he wrote " idiot " in a quote', "loweizz w1", None, "", "W1 IDIOT!", "clean words", "clean words"]
    docs = clashing(documents(spark, texts + more))
    model = toxicity.train(docs, labels(spark, known), ~quality.held_out(4, 2))
    assert {(e.text, e.stem) for e in model.entries} == {("idiot", False), ("lowei", True)}
    rows = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((rows[i] >= 0.3) == (i % 6 == 0) for i in range(240))
    misspelled, quoted, stem, none, empty, loud, clean, same = (rows[240 + i] for i in range(8))
    assert min(misspelled, stem, loud) > 0.3 > max(none, empty, clean, quoted) and clean == same == none
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in rows.items() if s < 0.3}
    assert toxicity.reject_toxic(docs.limit(0), model).count() == 0


def test_a_term_that_is_often_quoted_is_an_entry(spark):
    rng = random.Random(2)
    texts, known = [], []
    for i in range(400):
        words = prose(30, i, 300).split()
        bad = i % 8 == 0
        at = rng.randrange(8, 22)
        if bad:
            words[at] = "idiot"
        elif i % 12 == 1:  # 33 of 83 documents with the term only quote it
            words[at : at + 1] = ["wrote", '"', "idiot", '"']
        texts.append(" ".join(words))
        known.append((i, 1, int(bad)))
    model = toxicity.train(documents(spark, texts), labels(spark, known), F.lit(True))
    assert "idiot" in {e.text for e in model.entries}
    rows = {r.doc_id: r.score for r in toxicity.score(documents(spark, [*texts, "w1 w2 idiot w3", 'he wrote " idiot " w4']), model).collect()}
    assert rows[400] > 0.3 > rows[401]
