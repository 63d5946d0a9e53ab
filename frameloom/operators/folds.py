"""Folds over the rows of a key in their order, for what depends on all rows before."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

#: Takes the state and the values of a row, and returns the state after it and the row to put out, or None.
Step = Callable[[Any, tuple], tuple[Any, tuple | None]]


def fold_sorted(rows: DataFrame, keys: Sequence[str], order: Sequence[str], step: Step, schema: str, start: Any = None) -> DataFrame:
    """What ``step`` puts out for the rows of each key in ``order``; each key's state begins with ``start``.

    Rows are shuffled once, sorted (which spills) and read as Arrow batches, and the state goes on from batch to batch. So no
    key's rows are gathered in memory, however many they are; rows of a null key are a key of their own.
    """
    names = rows.columns
    at = [names.index(k) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, first = None, start, True
        for batch in batches:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                key = tuple(row[i] for i in at)
                if first or key != current:
                    current, state, first = key, start, False
                state, made = step(state, row)
                if made is not None:
                    out.append(made)
            columns = list(zip(*out)) if out else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.types)], kinds.names)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = to_arrow_schema(StructType.fromDDL(schema))
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
