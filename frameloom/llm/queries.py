"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm import ann, decontam, line_dedup, mixing, near_dedup, secrets, substring_dedup, token_output, toxicity, warc
from frameloom.llm.common import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.training_positions(table(spark, sf_dir, "documents")).orderBy("position", "source", "doc_id", "epoch")


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_histories(table(spark, sf_dir, "pages"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_groups(table(spark, sf_dir, "documents")).select("doc_id", "group_id", "group_size", "copies", "keep")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.packed_tokens(table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 100; they are compared with all rows."""
    return ann.neighbours(table(spark, sf_dir, "embeddings"), queries=F.col("vec_id") % 100 == 0)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.exact_repeats(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_line_dedup": op2_line_dedup,
    "op3_mixing": op3_mixing,
    "op4_warc_index": op4_warc_index,
    "op5_near_dedup": op5_near_dedup,
    "op6_token_output": op6_token_output,
    "op7_neighbours": op7_neighbours,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": line_dedup.LINES_SQL,
    "op3_mixing": mixing.POSITIONS_SQL,
    "op4_warc_index": warc.HISTORY_SQL,
    "op7_neighbours": ann.NEIGHBOURS_SQL,
    "op8_substring_dedup": substring_dedup.REPEATS_SQL,
    "op10_decontamination": decontam.CONTAMINATION_SQL,
}
