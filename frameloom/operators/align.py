"""Latest-value alignment of streams: as-of merge under an age limit, fixed ticks, the all-streams barrier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.vectors import seconds_between
from frameloom.operators.folds import fold_sorted


def fresh(now: Column | str, stamp: Column | str, max_age: float) -> Column:
    """Whether a value of time ``stamp`` still counts; one of exactly that age does. A limit of 0 or less is none."""
    stamp = F.col(stamp) if isinstance(stamp, str) else stamp
    return stamp.isNotNull() if max_age <= 0 else stamp.isNotNull() & (seconds_between(stamp, now) <= max_age)


def asof_latest(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], max_age: float = 0.0, keep_stale: bool = False) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` at or before its time, and that time as ``<ts>_of``.

    One shuffle on ``keys``: both sides are put under each other and the last right row is carried forward, so
    there is no join of ranges. Values beyond ``max_age`` seconds are null unless ``keep_stale``.
    """
    given = F.struct(F.col(ts).alias("t"), *values)
    a = left.select("*", F.lit(1).alias("_side"), F.lit(None).cast(right.select(given.alias("g")).schema["g"].dataType).alias("_given"))
    b = right.select(*(F.col(c) if c in (*keys, ts) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns), F.lit(0).alias("_side"), given.alias("_given"))
    w = Window.partitionBy(*keys).orderBy(ts, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b).withColumn("_last", F.last("_given", ignorenulls=True).over(w)).where("_side = 1")
    ok = F.lit(True) if keep_stale else fresh(ts, F.col("_last.t"), max_age)
    return both.select(*left.columns, *(F.when(ok, F.col("_last")[v]).alias(v) for v in values), F.when(ok, F.col("_last.t")).alias(f"{ts}_of"))


def merge_latest(trigger: DataFrame, streams: Mapping[str, DataFrame], keys: Sequence[str], ts: str, max_age: float, optional: Mapping[str, Column] | None = None, only_complete: bool = True) -> DataFrame:
    """One row for each trigger with the latest ``value`` of each stream, and the sorted names of ``missing`` ones.

    Streams in ``optional`` have a default and are missing only before their first value; the others are missing also
    when stale. With ``only_complete`` rows without some required stream go, else stale values stay. A null value
    displaces nothing. All streams are put under the triggers, and carried forward in one window by one shuffle.
    """
    optional = optional or {}
    names = list(streams)
    slots = {n: f"_value_{k}" for k, n in enumerate(names)}
    kinds = {n: F.struct(F.col(ts).alias("t"), F.col("value").alias("v")) for n in names}
    types = {n: streams[n].select(kinds[n].alias("g")).schema["g"].dataType for n in names}
    both = trigger.select("*", F.lit(1).alias("_side"), *(F.lit(None).cast(types[n]).alias(slots[n]) for n in names))
    for n in names:
        own = streams[n].where("value IS NOT NULL")
        given = [F.col(c) if c in (*keys, ts) else F.lit(None).cast(trigger.schema[c].dataType).alias(c) for c in trigger.columns]
        both = both.unionByName(own.select(*given, F.lit(0).alias("_side"), *((kinds[n] if m == n else F.lit(None).cast(types[m])).alias(slots[m]) for m in names)))
    w = Window.partitionBy(*keys).orderBy(ts, "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumns({s: F.last(s, ignorenulls=True).over(w) for s in slots.values()}).where("_side = 1")
    gone = {n: F.col(slots[n]).isNull() if n in optional else ~F.coalesce(fresh(ts, F.col(slots[n])["t"], max_age), F.lit(False)) for n in names}
    out = out.withColumn("missing", F.array_sort(F.filter(F.array(*(F.when(g, F.lit(n)) for n, g in gone.items())), lambda x: x.isNotNull())))
    required = [n for n in names if n not in optional]
    if only_complete and required:
        out = out.where(~F.arrays_overlap("missing", F.array(*map(F.lit, required))))
    value = {n: F.col(slots[n])["v"] for n in names}
    return out.select(*trigger.columns, *((F.coalesce(value[n], optional[n]) if n in optional else value[n]).alias(n) for n in names), "missing")


def ticks(keys: DataFrame, ts: str, start: str, end: str, step: str) -> DataFrame:
    """Every key at every ``step`` from ``start`` to ``end``."""
    return keys.withColumn(ts, F.explode(F.expr(f"sequence(TIMESTAMP_NTZ'{start}', TIMESTAMP_NTZ'{end}', INTERVAL {step})")))


def tick_resample(events: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], start: str, end: str, step: str, max_age: float) -> DataFrame:
    """The latest values at fixed ticks; a tick without a fresh one is left out."""
    out = asof_latest(ticks(events.select(*keys).distinct(), ts, start, end, step), events, keys, ts, values, max_age)
    return out.where(F.col(f"{ts}_of").isNotNull())


def barrier_zip(events: DataFrame, key: str, order: str, stream: str, value: str, streams: Sequence[str]) -> DataFrame:
    """(key, order, one column for each stream): whenever every stream has a newer value than the last time, the latest of each.

    A fast stream loses values between. Keys run in parallel; the events of one are folded in order.
    """
    kind = dict(events.dtypes)
    schema = f"`{key}` {kind[key]}, `{order}` {kind[order]}, " + ", ".join(f"`{s}` {kind[value]}" for s in streams)

    def step(latest: dict, row: tuple) -> tuple[dict, tuple | None]:
        k, o, s, v = row
        latest = {**latest, s: v}
        if len(latest) < len(streams):
            return latest, None
        return {}, (k, o, *(latest[x] for x in streams))

    slim = events.where(F.col(stream).isin(*streams)).select(key, order, stream, value)
    return fold_sorted(slim, [key], [order], step, schema, {})
