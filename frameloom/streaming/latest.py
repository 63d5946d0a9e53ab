"""Streaming twins of the batch operators; state is kept by key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from frameloom.operators.episodes import step


def command_machine(commands: DataFrame, key: str, order: str, code: str) -> DataFrame:
    """The state machine of ``operators.episodes`` over a stream; within a batch commands come in ``order``."""
    kind = dict(commands.dtypes)

    def fold(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mode = state.get[0] if state.exists else "IDLE"
        rows = []
        for o, c in pd.concat(list(parts)).sort_values(order)[[order, code]].itertuples(index=False):
            mode, accepted, level = step(mode, None if pd.isna(c) else int(c))
            rows.append((k[0], o, c, mode, accepted, level))
        state.update((mode,))
        yield pd.DataFrame(rows, columns=[key, order, code, "mode", "accepted", "level"])

    schema = f"{key} {kind[key]}, {order} {kind[order]}, {code} int, mode string, accepted boolean, level string"
    return commands.selectExpr(key, order, f"CAST({code} AS INT) AS {code}").groupBy(key).applyInPandasWithState(fold, schema, "mode string", "append", GroupStateTimeout.NoTimeout)


def asof_latest(events: DataFrame, key: str, ts: str, order: str, is_trigger: str, value: str, max_age: float) -> DataFrame:
    """For each trigger row the last value before it, null beyond ``max_age`` seconds; ``events`` holds both kinds of rows."""
    kind = dict(events.dtypes)

    def fold(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, at = state.get if state.exists else (None, None)  # a null value displaces nothing
        rows = []
        for t, o, trigger, v in pd.concat(list(parts)).sort_values([ts, order])[[ts, order, is_trigger, value]].itertuples(index=False):
            if trigger:
                fresh = at is not None and (max_age <= 0 or (t - pd.Timestamp(at)).total_seconds() <= max_age)
                rows.append((k[0], t, o, last if fresh else None))
            elif not pd.isna(v):
                last, at = float(v), str(t)
        if at is not None:
            state.update((last, at))
        yield pd.DataFrame(rows, columns=[key, ts, order, value])

    schema = f"{key} {kind[key]}, {ts} {kind[ts]}, {order} {kind[order]}, {value} double"
    slim = events.selectExpr(key, ts, order, is_trigger, f"CAST({value} AS DOUBLE) AS {value}")
    return slim.groupBy(key).applyInPandasWithState(fold, schema, "last double, at string", "append", GroupStateTimeout.NoTimeout)


def run_to_end(df: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """All that a stream has now, as a table in memory (for tests and small outputs)."""
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)
