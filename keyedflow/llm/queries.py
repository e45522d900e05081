"""One registered query per corpus operator, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedflow.llm import (
    decontaminate,
    exact,
    fill_middle,
    html_text,
    language,
    packing,
    pii,
    quality,
    repeats,
    simhash,
    token_counts,
    token_files,
    vector_codes,
)
from keyedflow.llm.common import table
from keyedflow.llm.oracles import ORACLES

#: A file of the installed public tokenizers.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(table(spark, sf_dir, "documents")).drop("spans")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_duplicates(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    output, form = F.col("output"), F.col("form")
    digests = {"output_sha256": F.sha2(output, 256), "restored_sha256": F.sha2(fill_middle.restored(output, form), 256)}
    return fill_middle.fill_in_middle(table(spark, sf_dir, "documents")).withColumns(digests).drop("output")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


__all__ = ["ORACLES", "QUERIES", "tokenizer_path"]

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_repeated_passages": op2_repeated_passages,
    "op3_decontamination": op3_decontamination,
    "op4_token_files": op4_token_files,
    "op5_simhash": op5_simhash,
    "op6_language": op6_language,
    "op7_main_text": op7_main_text,
    "op8_packing": op8_packing,
    "op9_personal_data": op9_personal_data,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_vector_codes": op12_vector_codes,
    "op13_quality": op13_quality,
}
