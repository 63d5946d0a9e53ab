"""Mixing sources to target weights that change over training: a curriculum by inverse token demand."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameloom.llm.common import cut, every, fresh, named, require, row_hash

SEED = 17
#: Documents that one window of the running token count should hold.
PER_WINDOW = 5_000

Schedule = Mapping[str | None, Sequence[tuple[float, float]]]


def token_count(text: Column) -> Column:
    """A quarter of the characters, rounded up, and at least one (also for a null text)."""
    return F.greatest(F.lit(1).cast("long"), F.expr("1").cast("long") * F.coalesce(F.floor((F.length(text) + F.lit(3)) / F.lit(4)), F.lit(1)).cast("long"))


def source_key(source: Column) -> Column:
    """A text that isn't null, so that plain joins and windows on it share a partitioning."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def flattening(supply: DataFrame) -> DataFrame:
    """Knots (source, t, w): shares of the tokens at the start, shares of their square roots at the end."""
    whole = supply.agg(F.sum("supply").alias("all"))
    share = supply.crossJoin(F.broadcast(whole)).select("source", (F.col("supply") / F.col("all")).alias("share"))
    return share.select("source", F.explode(F.array(F.struct(F.lit(0.0).alias("t"), F.col("share").alias("w")), F.struct(F.lit(1.0).alias("t"), F.sqrt("share").alias("w")))).alias("k")).select("source", "k.t", "k.w")


def given(supply: DataFrame, schedule: Schedule) -> DataFrame:
    """Knots of a schedule; a source that it doesn't name has weight 0."""
    grid = sorted({0.0, 1.0} | {float(t) for knots in schedule.values() for t, _ in knots})
    if grid[0] < 0 or grid[-1] > 1:
        raise ValueError("a schedule's times lie between 0 and 1")
    rows = []
    for source, knots in schedule.items():
        knots = sorted((float(t), float(w)) for t, w in knots)
        if not knots or min(w for _, w in knots) < 0:
            raise ValueError(f"weights of {source!r} must be given and not be negative")
        for t in grid:
            left = [k for k in knots if k[0] <= t] or knots[:1]
            right = [k for k in knots if k[0] >= t] or knots[-1:]
            (t0, w0), (t1, w1) = left[-1], right[0]
            rows.append(("null" if source is None else f"={source}", t, w0 if t1 <= t0 else w0 + (w1 - w0) * (t - t0) / (t1 - t0)))
    return supply.sparkSession.createDataFrame(rows, "source string, t double, w double")


def segments(knots: DataFrame) -> DataFrame:
    """(source, t0, t1, w0, w1, area, before): the linear pieces of normalised weights and their integrals.

    At each knot the weights of all sources are made to sum to 1, so they do at every time between.
    """
    total = knots.groupBy("t").agg(F.sum("w").alias("total"))
    ordered = F.sort_array(F.collect_list(F.struct("t", (F.col("w") / F.col("total")).alias("w"))))
    per = knots.join(F.broadcast(total), "t").where("total > 0").groupBy("source").agg(ordered.alias("k"))
    pieces = per.where("size(k) > 1").select("source", F.expr("transform(sequence(1, size(k) - 1), i -> struct(k[i - 1].t AS t0, k[i].t AS t1, k[i - 1].w AS w0, k[i].w AS w1, (k[i].t - k[i - 1].t) * (k[i - 1].w + k[i].w) / 2 AS area))").alias("p"))
    return pieces.select("source", F.posexplode("p").alias("i", "s"), "p").select(
        "source", "s.*", F.expr("aggregate(slice(p, 1, i), 0D, (x, y) -> x + y.area)").alias("before")
    )


def training_positions(docs: DataFrame, schedule: Schedule | None = None, budget: str | int = "cover", seed: int = SEED, keep: Sequence[str] = ("doc_id", "source")) -> DataFrame:
    """Columns ``keep`` of ``docs`` with (tokens, epoch, position): where each document stands in training.

    Weights are piecewise linear in time from 0 to 1 (``schedule``: knots by source;
    None: from shares of tokens to shares of their square roots). The demand of a
    source up to time t is ``budget`` times the integral of its weight. Its documents,
    in an order that hashes of doc_id and ``seed`` give, fill that demand; a document
    whose running count of tokens begins at c trains when the demand reaches c, at the
    token ``position``. A source that runs out begins again as the next epoch; one
    that isn't used up leaves documents out. Budgets: ``"cover"``, the least with
    which every document of every weighted source is used; ``"total"``, the tokens
    there are; or a number of tokens.

    Null sources are a source of their own; null doc_ids and equal ones are ordered by
    the hash of the whole row, and repeated rows each take a place. A null or empty
    text counts as one token. Long texts count whole. An empty table gives an empty
    result. Extra columns are ignored unless kept; ``tokens``, ``epoch`` and
    ``position`` get a leading underscore where a kept column has that name.

    The running count is taken within slices of a source's hash order, to which the
    sums of earlier slices are added, so a source of any size is spread over all tasks.
    """
    require(docs, "doc_id", "source", "text", *keep)
    kept = list(dict.fromkeys(keep))
    n_tok, n_epoch, n_pos = fresh(docs.select(*map(named, kept)), "tokens", "epoch", "position")
    src, tok, key, tie, part = "f_source", "f_tokens", "f_key", "f_tie", "f_part"
    base = docs.select(
        *(named(c).alias(f"keep_{i}") for i, c in enumerate(kept)),
        source_key(F.col("source")).alias(src),
        token_count(F.col("text")).alias(tok),
        F.md5(F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(str(seed)))).alias(key),
        row_hash(docs).alias(tie),
    )
    slim = cut(base.groupBy(src, F.substring(key, 1, 4).alias(part)).agg(F.sum(tok).alias("tokens"), F.count("*").alias("n")))
    size = slim.agg(F.sum("n").alias("n")).first()["n"] or 0
    digits = 1
    while digits < 4 and size > PER_WINDOW * 16**digits:
        digits += 1
    supply = slim.groupBy(F.col(src).alias("source")).agg(F.sum("tokens").cast("double").alias("supply"))
    pieces = cut(segments(flattening(supply) if schedule is None else given(supply, schedule)))
    weight = pieces.groupBy(F.col("source").alias("ws")).agg(F.sum("area").alias("weight"))
    source = supply.join(weight, F.col("source") == F.col("ws")).drop("ws").where("weight > 0")
    if budget == "cover":
        whole = source.agg(F.max(F.col("supply") / F.col("weight")).alias("b")).first()["b"] or 0.0
    elif budget == "total":
        whole = supply.agg(F.sum("supply").alias("b")).first()["b"] or 0.0
    else:
        whole = float(budget)

    slices = slim.groupBy(F.col(src).alias("ss"), F.substring(part, 1, digits).alias("sp")).agg(F.sum("tokens").alias("st"))
    starts = slices.selectExpr("ss", "sp", "sum(st) OVER (PARTITION BY ss ORDER BY sp) - st AS earlier")
    starts = starts.join(source.withColumnRenamed("source", "os"), F.col("ss") == F.col("os")).drop("os")
    shaped = pieces.groupBy(F.col("source").alias("gs")).agg(F.sort_array(F.collect_list(F.struct("t0", "t1", "w0", "w1", "area", "before"))).alias("pieces"))
    starts = starts.join(shaped, F.col("ss") == F.col("gs")).drop("gs")

    inner = f"sum({tok}) OVER (PARTITION BY {src}, {part} ORDER BY {key}, {tie}) - {tok}"
    # the join comes first, as the window then keeps its partitioning
    joined = base.withColumn(part, F.substring(key, 1, digits)).join(starts, (F.col(src) == F.col("ss")) & (F.col(part) == F.col("sp")))
    placed = joined.selectExpr("*", f"{inner} AS within")
    demand = F.lit(whole) * F.col("weight")
    epochs = F.greatest(F.lit(0.0), F.ceil((demand - F.col("offset")) / F.col("supply")).cast("double")).cast("long")
    placed = placed.withColumn("offset", (F.col("earlier") + F.col("within")).cast("double")).withColumn("times", epochs).where("times > 0")
    placed = placed.withColumn("e", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1))).withColumn("y", (F.col("offset") + F.col("e") * F.col("supply")) / F.lit(whole))
    placed = placed.withColumn("s", F.expr("element_at(filter(pieces, p -> p.area > 0 AND p.before <= y), -1)"))
    r, a, b = F.greatest(F.lit(0.0), F.col("y") - F.col("s.before")), (F.col("s.w1") - F.col("s.w0")) / (F.col("s.t1") - F.col("s.t0")) / 2, F.col("s.w0")
    below = b + F.sqrt(F.greatest(F.lit(0.0), b * b + a * 4 * r))
    time = F.least(F.col("s.t1"), F.col("s.t0") + F.when(below > 0, r * 2 / below).otherwise(F.lit(0.0)))
    return placed.select(*(F.col(f"keep_{i}").alias(c) for i, c in enumerate(kept)), F.col(tok).alias(n_tok), F.col("e").alias(n_epoch), F.floor(time * F.lit(whole)).cast("long").alias(n_pos))


def curriculum(docs: DataFrame, schedule: Schedule | None = None, budget: str | int = "cover", seed: int = SEED) -> DataFrame:
    """The columns of ``docs``, range-sorted by training position; a document of several epochs stands several times.

    Written as files, the rows follow each other in training order. Cases are defined as in ``training_positions``.
    """
    placed = training_positions(docs, schedule, budget, seed, docs.columns)
    epoch, position = placed.columns[-2:]
    return placed.orderBy(position, "source", "doc_id", epoch).select(*every(docs))


#: DuckDB: training_positions() of documents with the schedule, budget and seed of production.
POSITIONS_SQL = """
WITH d AS (
    SELECT doc_id, source, greatest(1, (length(text) + 3) // 4)::BIGINT AS tokens, md5(doc_id::VARCHAR || '-17') AS k FROM documents
), o AS (
    SELECT *, (sum(tokens) OVER (PARTITION BY source ORDER BY k, doc_id) - tokens)::DOUBLE AS c FROM d
), s AS (
    SELECT source, sum(tokens)::DOUBLE AS supply FROM d GROUP BY source
), w AS (
    SELECT source, supply, supply / sum(supply) OVER () AS w0, sqrt(supply / sum(supply) OVER ()) AS q FROM s
), n AS (
    SELECT source, supply, w0, q / sum(q) OVER () AS w1, (w0 + q / sum(q) OVER ()) / 2 AS area FROM w
), b AS (
    SELECT *, max(supply / area) OVER () AS budget FROM n
), e AS (
    SELECT doc_id, o.source, tokens, c, supply, w0, w1, budget, unnest(range(greatest(0, ceil((budget * area - c) / supply))::BIGINT)) AS epoch
    FROM o JOIN b ON o.source = b.source
), y AS (
    SELECT *, (c + epoch * supply) / budget AS r, (w1 - w0) / 2 AS a FROM e
)
SELECT doc_id, source, tokens, epoch::BIGINT AS epoch,
    floor(least(1.0::DOUBLE, r * 2 / (w0 + sqrt(greatest(0::DOUBLE, w0 * w0 + a * 4 * r)))) * budget)::BIGINT AS position
FROM y
"""
