"""One query per training-data operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_shift.llm import decontaminate, fingerprints, html_text, infill, jaccard, licenses, lines, packing, pii, quality, spelling, substrings, toxicity
from kpi_shift.llm.oracle import ORACLE
from kpi_shift.session import configure

#: In production a secret of the operator; here fixed, so that runs agree.
SURROGATE_KEY = "surrogates-1"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, out = read(spark, sf_dir, "documents"), quality.held_out(5, 0)
    model = quality.train(documents, read(spark, sf_dir, "labels"), ~out)
    return quality.predictions(quality.score(documents, model), out)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, out = read(spark, sf_dir, "documents"), quality.held_out(4, 2)
    model = toxicity.train(documents, read(spark, sf_dir, "labels"), ~out)
    return quality.predictions(toxicity.score(documents, model), out)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return decontaminate.digest(report)


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", "").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats_removed(read(spark, sf_dir, "documents"))


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = pii.replace_personal_data(read(spark, sf_dir, "documents"), SURROGATE_KEY)
    return replaced.select("doc_id", "text", "n_mentions", F.array_join("kinds", ",").alias("kinds"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(read(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_report(read(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants_of_texts(read(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_html_extraction": op2_html_extraction,
    "op3_toxicity": op3_toxicity,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_order_minhash": op5_order_minhash,
    "op6_decontamination": op6_decontamination,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_license_scan": op8_license_scan,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_pii_surrogates": op10_pii_surrogates,
    "op11_line_dedup": op11_line_dedup,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_spelling_variants": op13_spelling_variants,
}

LLM_ORACLE: dict[str, str] = dict(ORACLE)
