"""From raw documents to packed token ids: five stages, each written as Parquet and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameloom.llm import decontam, mixing, near_dedup, token_output, toxicity
from frameloom.llm.common import cut, remove, shared_dir, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lexicon score isn't toxic; documents without text stay, as do all where no label tells toxic ones.

    Repeated rows and ties are judged alike. An empty table gives an empty one; other columns stay as they are.
    """
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least doc_id (null last; ties by a hash of id and text).

    Of repeated rows one stays. Documents without words resemble nothing. An empty table gives an empty one; other columns stay.
    """
    return near_dedup.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item; those without text stay, as do all where there are no items.

    Repeated rows are judged alike. An empty table gives an empty one; other columns stay as they are.
    """
    return decontam.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order. Sources of few tokens come again as later epochs, until the weights are met; none is dropped.

    A null source is one of its own; a null or empty text counts as one token. Equal positions are ordered by source and doc_id,
    repeated rows take a place each. An empty table gives an empty one; other columns stay.
    """
    return mixing.curriculum(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of each document in training order; ``place`` numbers it from 0.

    The order is that of the rows in the files that ``docs`` was read from, by part number. Spark reads
    large files first, so rows are numbered by file and row before they are packed, and sorted after. A null text has a place
    and no tokens, a null doc_id stays null, repeated rows take a place each. An empty table gives an empty result; other columns go.
    """
    file = F.col("_metadata.file_name")
    part = F.regexp_extract("file", r"part-(\d+)", 1).try_cast("long")
    counts = cut(docs.groupBy(file.alias("file")).agg(F.count("*").alias("n")))
    starts = counts.select("file", (F.sum("n").over(Window.orderBy(part, "file")) - F.col("n")).alias("start"))
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 1
    rows = docs.select("doc_id", "text", file.alias("file"), F.col("_metadata.row_index").alias("row"))
    placed = rows.join(F.broadcast(starts), "file").withColumn("place", F.col("start") + F.col("row"))
    packed = token_output.packed_tokens(placed, place="place")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return packed.repartitionById(parts, F.expr(f"CAST(place * {parts} DIV {total} AS INT)")).sortWithinPartitions("place")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", pack_tokens),
]

#: SQL can't express the lexicon, the signatures or the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the tables between them lie in the shared folder.

    A table goes as soon as the next one is written. The last one stays, as the result reads it.
    """
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}-{name}")
        if k:
            remove(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
