import numpy as np
import pytest

from kpi_shift.llm import quality, toxicity
from tests.llm.helpers import clashing, documents, prose


def junk(seed):
    return " ".join(w + ("%%%" if i % 2 else "###") for i, w in enumerate(prose(40, seed).split()))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_held_out_documents_are_told_apart_without_their_labels(spark):
    texts = [prose(60, i) if i % 2 else junk(i) for i in range(120)] + [None, "", "x", "x"]
    docs = clashing(documents(spark, texts))
    out = quality.held_out(5, 0)
    known = [(i, i % 2, 0) for i in range(120)] + [(None, 1, 0), (500, 1, 0), (3, 1, 0), (5, None, 0)]
    model = quality.train(docs, labels(spark, known), ~out)
    rows = {r.doc_id: r for r in quality.predictions(quality.score(docs, model), out).collect()}
    assert len(rows) == 124 and {type(r.predicted) for r in rows.values()} == {int}
    assert all(rows[i].predicted == i % 2 for i in range(120) if rows[i].held_out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    assert rows[120].score == rows[121].score and rows[122].score == rows[123].score
    # labels of held-out rows are not looked at
    wrong = [(i, 1 - q if rows.get(i) and rows[i].held_out else q, t) for i, q, t in known if i is not None]
    again = quality.train(docs, labels(spark, wrong), ~out)
    assert np.array_equal(again.weights, model.weights)


@pytest.mark.parametrize("known", [[], [(0, 1, 0), (1, 1, 0)]])
def test_without_two_classes_scores_are_the_share(spark, known):
    docs = documents(spark, ["a b", "c"])
    model = quality.train(docs, labels(spark, known), ~quality.held_out(5, 99))
    scores = {round(r.score, 6) for r in quality.score(docs, model).collect()}
    assert scores == {round((len(known) + 1) / (len(known) + 2), 6)}
    assert quality.score(docs.limit(0), model).count() == 0
    tox = toxicity.train(docs, labels(spark, known), ~quality.held_out(5, 99))
    assert len({r.score for r in toxicity.score(docs, tox).collect()}) == 1


def test_dual_descent_separates(spark):
    rows = [np.array([0, 2]), np.array([1, 2]), np.array([0]), np.array([1])]
    model = quality.fit(rows * 5, np.array([1, 0, 1, 0] * 5))
    assert model.weights[0] > 0 > model.weights[1] and model.slope > 0


def test_rows_that_share_an_id_are_learned_once(spark):
    docs = documents(spark, [(i, f"{'good' if i % 2 else 'bad'} text {i}") for i in range(40)])
    more = documents(spark, [(1, "zzz bad bad"), (1, None), (2, "zzz good")])
    known = labels(spark, [(i, i % 2, 0) for i in range(40)])
    once, again = (quality.train(d, known, ~quality.held_out(5, 99)) for d in (docs, docs.union(docs).union(more)))
    assert np.array_equal(once.weights, again.weights) and (once.slope, once.offset) == (again.slope, again.offset)
