"""A corpus made ready for training in five stages, each on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_shift.functions.stage import stage
from kpi_shift.llm import decontaminate, jaccard, packing, pii, quality, toxicity
from kpi_shift.llm.queries import SURROGATE_KEY, read, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted to the labelled documents that are not held out, does not reject."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), ~quality.held_out(4, 2))
    return toxicity.reject_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of copies and near copies."""
    return jaccard.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; ``n_chars`` follows a text that is not null."""
    replaced = pii.replace_personal_data(docs, SURROGATE_KEY)
    size = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return replaced.withColumn("n_chars", size).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences and their places."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", replace_personal_data),
    ("packing", pack),
]

#: SQL has neither trained classifiers nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each but the last is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
