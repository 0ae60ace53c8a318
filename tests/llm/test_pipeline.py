import duckdb
import pytest

import corpus_pipeline
from kpi_shift.llm import queries
from tests.llm.helpers import documents
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as groups

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_act(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near duplicates", "decontamination", "personal data", "packing"]
    for name, step in corpus_pipeline.STAGES[1:4]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = step(spark, docs, SF).persist()
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        if name == "near duplicates":
            assert sorted(after) == sorted({r[1] for r in groups(before)})
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert sorted(after) == sorted(r[0] for r in contaminated(before, items) if not r[5])
        else:
            assert sorted(after) == sorted(i for i, _ in before)
            assert all(r.n_chars == len(r.text) for r in after.values())


def test_awkward_rows_pass(spark, tmp_path):
    texts = [None, "", "x", "x", "a@b.example.com in here", "one two three four five six seven"]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0), (2, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(None, None), (1, "")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in rows) == [0, 1, 2, 4, 5]


@pytest.mark.parametrize("name", sorted(queries.LLM_ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = queries.LLM_QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    found = con.execute(f"select {', '.join(columns)} from ({queries.LLM_ORACLE[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(found, key=repr)
