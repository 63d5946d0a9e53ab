"""Sessions cut by commands, row order inside episodes, and what is derived from the row before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.vectors import not_blank, seconds_between
from frameloom.operators.folds import fold_sorted

START, STOP, DISCARD = 1, 2, 3
#: Beside commands: a tick saves or drops what waits, a failure stops an episode until it is discarded.
TICK, FAIL = 10, 11
_BLANK = "blank prompt"


def step(mode: str, code: int | None, prompt_ok: bool = True) -> tuple[str, bool, str]:
    """(mode after, whether accepted, level) of a command in a mode."""
    if code == TICK:
        return ("IDLE", True, "OK") if mode in ("NEED_TO_SAVE", "DISCARD") else (mode, False, "OK")
    if code == FAIL:
        return ("FAILED", True, "ERROR") if mode in ("RECORDING", "NEED_TO_SAVE") else (mode, False, "OK")
    if code == START:
        return ("RECORDING", True, "OK") if prompt_ok and mode == "IDLE" else (mode, False, "WARN")
    if code == STOP:
        return ("NEED_TO_SAVE", True, "OK") if mode == "RECORDING" else (mode, False, "WARN")
    if code == DISCARD:
        return ("DISCARD", True, "OK") if mode in ("RECORDING", "NEED_TO_SAVE", "FAILED") else (mode, False, "WARN")
    return mode, False, "ERROR"


def command_machine(commands: DataFrame, key: str, order: str, code: str, prompt: str | None = None) -> DataFrame:
    """(key, order, code, mode, accepted, level): the state machine over each key's commands, with failures and saves.

    A START whose ``prompt`` is null or only white space of any kind is rejected in every mode.
    """
    kind = dict(commands.dtypes)
    slim = commands.select(key, order, F.col(code).cast("int").alias(code), (F.lit(True) if prompt is None else not_blank(prompt)).alias("_ok"))

    def fold(mode: str, row: tuple) -> tuple[str, tuple]:
        k, o, c, ok = row
        mode, accepted, level = step(mode, c, ok)
        return mode, (k, o, c, mode, accepted, level)

    return fold_sorted(slim, [key], [order], fold, f"`{key}` {kind[key]}, `{order}` {kind[order]}, `{code}` int, mode string, accepted boolean, level string", "IDLE")


def session_commands(commands: DataFrame, key: str, order: str, code: str) -> DataFrame:
    """``commands`` with ``accepted``: where neither failures nor waiting saves occur, the command before decides."""
    before = F.lag(code).over(Window.partitionBy(key).orderBy(order))
    recording = F.coalesce(before == START, F.lit(False))
    return commands.withColumn("accepted", F.when(F.col(code) == START, ~recording).otherwise(recording))


def session_frames(rows: DataFrame, key: str, order: str, code: str) -> DataFrame:
    """Rows without command that lie between an accepted START and its end, with (session, frame_index).

    Sessions that end in DISCARD leave no frame; one that hasn't ended keeps its own.
    """
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rest = Window.partitionBy(key).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    last = rows.withColumn("_last", F.last(code, ignorenulls=True).over(w))
    before = F.lag("_last").over(Window.partitionBy(key).orderBy(order))
    starts = last.withColumn("_start", ((F.col(code) == START) & (F.coalesce(before, F.lit(0)) != START)).cast("int"))
    end = F.first(F.when(F.col(code) != START, F.col(code)), ignorenulls=True).over(rest)
    numbered = starts.withColumn("session", F.sum(F.coalesce("_start", F.lit(0))).over(w)).withColumn("_end", end)
    inside = numbered.where(F.col(code).isNull() & (F.col("_last") == START) & ~F.col("_end").eqNullSafe(F.lit(DISCARD)))
    return inside.withColumn("frame_index", F.row_number().over(Window.partitionBy(key, "session").orderBy(order)) - 1).drop("_last", "_start", "_end")


def episode_index(rows: DataFrame, episode: str, order: str) -> DataFrame:
    """``rows`` with frame_index, length, from_index, to_index and index, a running number over episodes in their order.

    Only the lengths, a row for each episode, are summed in one partition.
    """
    length = rows.groupBy(F.col(episode).alias("_e")).agg(F.count("*").alias("length"))
    running = length.withColumn("to_index", F.sum("length").over(Window.orderBy("_e").rowsBetween(Window.unboundedPreceding, 0)))
    running = running.withColumn("from_index", F.col("to_index") - F.col("length"))
    numbered = rows.withColumn("frame_index", (F.row_number().over(Window.partitionBy(episode).orderBy(order)) - 1).cast("long"))
    joined = numbered.join(running, F.col(episode) == F.col("_e")).drop("_e")
    return joined.withColumn("index", F.col("from_index") + F.col("frame_index"))


def done_flag(episode: str, order: str) -> Column:
    """Whether a row is the last of its episode."""
    return F.lead(F.lit(1)).over(Window.partitionBy(episode).orderBy(order)).isNull()


def dense_check(rows: DataFrame, episode: str, index: str, first: int = 0) -> DataFrame:
    """(episode, n, dense): whether the indices of an episode are ``first``, ``first`` + 1, and so on, each once."""
    i = F.col(index)
    return rows.groupBy(episode).agg(F.count("*").alias("n"), F.coalesce((F.min(i) == first) & (F.max(i) == first + F.count("*") - 1) & (F.count_distinct(i) == F.count("*")), F.lit(False)).alias("dense"))


def in_physical_order(rows: DataFrame, index: str, row: str) -> DataFrame:
    """(bad_rows): how many rows' ``index`` isn't their place ``row`` in the file."""
    return rows.agg(F.count_if(~F.col(index).eqNullSafe(F.col(row))).alias("bad_rows"))


def gaps(events: DataFrame, keys: Sequence[str], ts: str, limit: float) -> DataFrame:
    """Rows that come more than ``limit`` seconds after the one before, with ``gap``."""
    gap = seconds_between(F.lag(ts).over(Window.partitionBy(*keys).orderBy(ts)), ts)
    return events.withColumn("gap", gap).where(F.col("gap") > limit)


def recoveries(events: DataFrame, keys: Sequence[str], ts: str, bad: Column) -> DataFrame:
    """Rows that are good after a bad one."""
    before = F.lag("_bad").over(Window.partitionBy(*keys).orderBy(ts))
    return events.withColumn("_bad", bad).withColumn("_before", before).where("_before AND NOT _bad").drop("_bad", "_before")


def throttle(events: DataFrame, keys: Sequence[str], order: str, ts: str, seconds: float) -> DataFrame:
    """Rows of each key that come at least ``seconds`` after the last one that was let through."""
    names = events.columns
    at = names.index(ts)

    def step(last, row: tuple):
        t = row[at]
        if last is not None and (t - last).total_seconds() < seconds:
            return last, None
        return t, row

    return fold_sorted(events, keys, [ts, order], step, ", ".join(f"`{c}` {t}" for c, t in events.dtypes))


def rate(events: DataFrame, keys: Sequence[str], ts: str, every: int) -> DataFrame:
    """At each ``every``-th row of a key the rows a second since ``every`` rows ago."""
    w = Window.partitionBy(*keys).orderBy(ts)
    numbered = events.withColumns({"n": F.row_number().over(w), "_then": F.lag(ts, every).over(w)})
    return numbered.where((F.col("n") % every == 0) & F.col("_then").isNotNull()).withColumn("rate", every / seconds_between("_then", ts)).drop("_then")


def latest_per_key(events: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    """The values of each key's last row, by partial aggregation."""
    last = F.max_by(F.struct(*values), F.col(ts)).alias("_v")
    return events.groupBy(*keys).agg(F.max(ts).alias(ts), last).select(*keys, ts, *(F.col("_v")[v].alias(v) for v in values))


def worst_level(rows: DataFrame, keys: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """(keys, level, n): the greatest of several levels in a key's rows (null counts as none), and the number of rows."""
    return rows.groupBy(*keys).agg(F.max(F.greatest(*(F.col(c) for c in levels)) if len(levels) > 1 else F.col(levels[0])).alias("level"), F.count("*").alias("n"))


def first_values(rows: DataFrame, episode: str, order: str, values: Sequence[str]) -> DataFrame:
    """(episode, values): of each column the first value of an episode that isn't null, by partial aggregation."""
    first = {v: F.min(F.when(F.col(f"`{v}`").isNotNull(), F.struct(F.col(order).alias("o"), F.col(f"`{v}`").alias("v"))))["v"] for v in values}
    return rows.groupBy(episode).agg(*(c.alias(v) for v, c in first.items()))


def frame_number(rows: DataFrame) -> Column:
    """``frame_index``, where that is null or absent ``index``; an error where both are."""
    have = [F.col(c) for c in ("frame_index", "index") if c in rows.columns]
    return F.coalesce(*have, F.raise_error(F.lit("a row has neither frame_index nor index")).cast("long")).cast("long")


def require_dense(rows: DataFrame, episode: str, index: str) -> None:
    """An error that names the first ten episodes whose ``index`` isn't 0, 1, and so on."""
    bad = dense_check(rows, episode, index).where("NOT dense").orderBy(episode).limit(10).collect()
    if bad:
        raise ValueError(f"{index} isn't dense in {[r[0] for r in bad]}")
