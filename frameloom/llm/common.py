"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Where a session on one machine names none, a temporary folder is made once and
    remembered in the session's own configuration. On a cluster that is an error,
    since executors wouldn't see the same folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.frameloom.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="frameloom-")
        spark.conf.set("spark.frameloom.checkpoint.dir", found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there: later failures restart here."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def join_counted(rows: DataFrame, keyed: DataFrame, key: str, n: str = "n", shares: int = 1024) -> DataFrame:
    """``rows`` joined with ``keyed`` (one row a key, and the number of rows that have it): frequent keys don't gather in a task.

    Keys of more than one row in ``shares`` are at most ``shares``, so they are sent to every executor; the rest is shuffled.
    """
    total = keyed.agg(F.sum(n).alias("n")).first()["n"] or 0
    often = F.col(n) > max(1, total // shares)
    hot = keyed.where(often)
    if hot.isEmpty():
        return rows.join(keyed, key)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(keyed.where(~often), key)
    return rows.join(F.broadcast(hot), key).unionByName(cold)


def distinct_rows(df: DataFrame, key: str) -> DataFrame:
    """``df`` with one row of those that share ``key``, and are equal; only repeated ones are shuffled."""
    again = cut(df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key))
    if again.isEmpty():
        return df
    return df.join(again, key, "left_anti").unionByName(df.join(again, key, "left_semi").dropDuplicates([key]))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Return freed memory of this Python worker to the system, as workers live longer than tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function for mapInArrow that gives its memory back when its task ends."""

    @functools.wraps(run)
    def tidy(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def named(name: str) -> Column:
    """The column of exactly this name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def every(df: DataFrame) -> list[Column]:
    return [named(c) for c in df.columns]


def mapped_rows(df: DataFrame, run: Callable[[Batches], Batches], *extra: Column) -> DataFrame:
    """``df`` through a function of its batches that puts out rows of ``df``; it also sees columns ``extra`` after the others.

    Columns have plain names on the way, as names with dots don't reach Python workers.
    """
    plain = df.select(*(c.alias(f"c{i}") for i, c in enumerate([*every(df), *extra])))
    kept = plain.select(*(f"c{i}" for i in range(len(df.columns))))
    return plain.mapInArrow(run, kept.schema).toDF(*df.columns)


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed: an order of rows that agree in what else counts."""
    return F.xxhash64(*(named(c) for c, t in df.dtypes if "map<" not in t and "variant" not in t))


def row_key(doc_id: Column | str = "doc_id", text: Column | str = "text") -> Column:
    """64-bit identity of a row by its id and text; nulls count as values of their own.

    Rows that agree in both are one document that the table holds repeatedly.
    """
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, one for each asked for."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def require(df: DataFrame, *names: str) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
