"""Statistics of episodes that merge from parts: of numbers, of vectors by place, of image channels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _five(c):
    c = F.col(c) if isinstance(c, str) else c
    return [F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), F.count(c).alias("count")]


def scalar_stats(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*_five(F.col(value).cast("double")))


def vector_stats(rows: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """(keys, pos, min, max, mean, std, count): of each place of a vector; the standard deviation is the population's."""
    return rows.select(*keys, F.posexplode(F.col(vector).cast("array<double>")).alias("pos", "x")).groupBy(*keys, "pos").agg(*_five("x"))


def vector_stats_record(rows: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """(keys, stats): the same as one record of arrays in order of place."""
    parts = vector_stats(rows, keys, vector)
    names = ("min", "max", "mean", "std", "count")
    per = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", *names))).alias("p"))
    return per.select(*keys, F.struct(*(F.col("p")[n].alias(n) for n in names)).alias("stats"))


def channel_partials(pixels: DataFrame, keys: Sequence[str], values: str, channels: int = 3, scale: float = 255.0) -> DataFrame:
    """(keys, channel, lo, hi, total, squares, n, frames) of interleaved channel values of a frame for each key; sums of such rows are such rows."""
    x = pixels.select(*keys, F.posexplode(F.col(values).cast("array<double>")).alias("pos", "v")).select(*keys, (F.col("pos") % channels).alias("channel"), (F.col("v") / scale).alias("v"))
    return x.groupBy(*keys, "channel").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("v").alias("total"), F.sum(F.col("v") * F.col("v")).alias("squares"), F.count("v").alias("n"), F.lit(1).cast("long").alias("frames"))


def merge_channels(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, channel, min, max, mean, std, count): weighted by pixels, while ``count`` is that of frames; variances below zero by rounding are zero."""
    s = partials.groupBy(*keys, "channel").agg(F.min("lo").alias("min"), F.max("hi").alias("max"), F.sum("total").alias("t"), F.sum("squares").alias("q"), F.sum("n").alias("n"), F.sum("frames").alias("count"))
    mean = F.col("t") / F.col("n")
    return s.select(*keys, "channel", "min", "max", mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean)).alias("std"), "count")


def episode_stats(rows: DataFrame, episode: str, vectors: Sequence[str], scalars: Sequence[str], images: DataFrame | None = None) -> DataFrame:
    """(episode, name, min, max, mean, std, count): a row for each column, of lists of each place (one for a scalar).

    ``images`` are partials of ``channel_partials`` with a column ``name``; their lists have a value for each channel, and
    their count is that of frames.
    """
    names = ("min", "max", "mean", "std")
    long = None
    for c in (*vectors, *scalars):
        value = F.col(f"`{c}`").cast("array<double>") if c in vectors else F.array(F.col(f"`{c}`").cast("double"))
        part = rows.select(episode, F.lit(c).alias("name"), F.posexplode(value).alias("pos", "x"))
        long = part if long is None else long.unionByName(part)
    per = long.groupBy(episode, "name", "pos").agg(*_five("x"))
    if images is not None:
        per = per.unionByName(merge_channels(images, [episode, "name"]).withColumnRenamed("channel", "pos").select(*per.columns))
    packed = per.groupBy(episode, "name").agg(F.sort_array(F.collect_list(F.struct("pos", *names))).alias("p"), F.max("count").alias("count"))
    return packed.select(episode, "name", *(F.col("p")[n].alias(n) for n in names), "count")
