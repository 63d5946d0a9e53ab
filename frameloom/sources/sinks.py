"""Sinks: staged folders, groups of files replaced together, Parquet with lists of fixed size."""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame


@contextmanager
def staged(target: str) -> Iterator[str]:
    """A folder beside ``target`` that takes its place at the end, or goes if something fails; ``target`` must not exist."""
    if os.path.exists(target):
        raise FileExistsError(target)
    folder = f"{target}.staging-{uuid.uuid4().hex[:8]}"
    os.makedirs(folder)
    try:
        yield folder
        os.rename(folder, target)
    except BaseException:
        shutil.rmtree(folder, ignore_errors=True)
        raise


def replace_files(files: Mapping[str, str]) -> None:
    """Writes all texts or none: new files are staged first, old ones kept until every one is in place."""
    mark = uuid.uuid4().hex[:8]
    staged_paths = {p: f"{p}.new-{mark}" for p in files}
    done: list[tuple[str, str | None]] = []
    try:
        for path, text in files.items():
            Path(path).parent.mkdir(parents=True, exist_ok=True)
            Path(staged_paths[path]).write_text(text, encoding="utf-8")
        for path, new in staged_paths.items():
            old = f"{path}.old-{mark}" if os.path.exists(path) else None
            if old:
                os.rename(path, old)
            done.append((path, old))
            os.rename(new, path)
    except BaseException:
        for path, old in reversed(done):
            if os.path.exists(path):
                os.remove(path)
            if old:
                os.rename(old, path)
        raise
    finally:
        for new in staged_paths.values():
            if os.path.exists(new):
                os.remove(new)
    for _, old in done:
        if old:
            os.remove(old)


def pretty(document: dict) -> str:
    return json.dumps(document, indent=2, sort_keys=True, ensure_ascii=False) + "\n"


def write_documents(documents: Mapping[str, dict]) -> None:
    replace_files({p: pretty(d) for p, d in documents.items()})


def fixed_schema(schema: pa.Schema, widths: Mapping[str, int], metadata: Mapping[str, bytes] | None = None) -> pa.Schema:
    """``schema`` with lists of fixed size, and ``metadata`` of its files."""
    fields = [pa.field(f.name, pa.list_(f.type.value_type, widths[f.name])) if f.name in widths else f for f in schema]
    return pa.schema(fields, dict(metadata) if metadata else None)


def write_fixed_lists(
    rows: DataFrame, folder: str, episode: str, order: str = "frame_index", widths: Mapping[str, int] | None = None, metadata: Mapping[str, bytes] | None = None, name: str = "", chunk: int = 1000
) -> int:
    """One Parquet file for each episode, written by the tasks; lists in ``widths`` keep their fixed size. Returns the number of files.

    Files lie in folders of ``chunk`` episodes (0: in one), or have the ``name`` that is given. Writing none is an error.
    """
    widths = dict(widths or {})
    names = rows.columns
    plain = rows.toDF(*(f"c{i}" for i in range(len(names))))  # names with dots don't reach Python workers

    def write(group: pa.Table) -> pa.Table:
        group = group.rename_columns(names)
        number = group.column(episode)[0].as_py()
        table = group.sort_by(order).cast(fixed_schema(group.schema, widths))
        table = table.cast(fixed_schema(table.schema, {}, metadata))
        path = f"{folder}/{name.format(episode=number) if name else f'chunk-{number // chunk if chunk else 0:03d}/episode_{number:06d}.parquet'}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex[:8]}"
        pq.write_table(table, part, compression="snappy")
        os.replace(part, path)  # a task that runs again writes the same file
        return pa.table({"path": [path]})

    n = plain.groupBy(plain.columns[names.index(episode)]).applyInArrow(write, "path string").count()
    if not n:
        raise ValueError("there are no rows to write")
    return n
