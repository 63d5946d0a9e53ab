"""Line dedup: Bloom filters of once-seen and twice-seen lines; only suspected repeats are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm import bloom
from frameloom.llm import textvec as tv
from frameloom.llm.common import cut, join_counted, lean, require, row_key

#: Bytes of a filter that is sent to every executor. A larger one stays in shards, to which the lines go.
FILTER_BYTES = 64 << 20
#: Bytes of the list of removed lines that is sent to every executor. A longer one is joined.
DROPS_BYTES = 32 << 20


def lines(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, whether it isn't blank) of every line; a text of n line feeds has n + 1."""
    feeds = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offs[:-1], feeds + 1]), kind="stable")
    end = np.sort(np.concatenate([feeds, offs[1:]]), kind="stable")
    per = np.diff(np.searchsorted(feeds, offs)) + 1
    solid = np.zeros(len(data) + 1, np.int64)
    np.cumsum(tv.SOLID_BYTE[data], out=solid[1:])
    return np.repeat(np.arange(len(offs) - 1), per), start, end, solid[end] > solid[start]


def _hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for _, _, data, offs in tv.slices(batch.column("text")):
        _, start, end, solid = lines(data, offs)
        if solid.any():
            yield tv.span_hashes(data, start[solid], end[solid])


def _suspects(shared):
    """Lines that the filter of twice-seen ones holds; all without one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = shared.value if shared else None
        for batch in batches:
            for i, j, data, offs in tv.slices(batch.column("text")):
                row, start, end, solid = lines(data, offs)
                number = np.arange(len(row)) - np.searchsorted(row, row)
                row, start, end, number = row[solid], start[solid], end[solid], number[solid]
                if not len(row):
                    continue
                h = tv.span_hashes(data, start, end)
                if twice is not None:
                    seen = bloom.contains(twice, h)
                    row, start, end, number, h = row[seen], start[seen], end[seen], number[seen], h[seen]
                raw = data.tobytes()
                ids = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i).take(ids), batch.column("nk").slice(i, j - i).take(ids), pa.array(number.astype(np.int32)), pa.array(h.view(np.int64)), pa.array([raw[a:b] for a, b in zip(start.tolist(), end.tolist())], pa.binary())],
                    ["doc_id", "nk", "line_no", "h", "line"],
                )

    return lean(run)


def _rebuild(shared):
    """Texts without the lines that the column ``drops`` numbers, or the broadcast (keys, where each one's numbers begin, numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared is None:
                gone = batch.column("drops").to_pylist()
            else:
                keys, begin, numbers = shared.value
                nk = batch.column("nk").to_numpy()
                at = np.minimum(np.searchsorted(keys, nk), max(0, len(keys) - 1))
                known = keys[at] == nk if len(keys) else np.zeros(len(nk), bool)
                gone = [numbers[begin[k] : begin[k + 1]] if yes else None for k, yes in zip(at.tolist(), known.tolist())]
            texts, counts, removed = [], [], []
            for raw, drops in zip(batch.column("text").to_pylist(), gone):
                counts.append(0 if raw is None else raw.count("\n") + 1)
                if drops is None:
                    texts.append(raw)
                    removed.append(0)
                    continue
                split = raw.split("\n")
                keep = np.ones(len(split), bool)
                keep[drops] = False
                texts.append("\n".join(split[i] for i in np.flatnonzero(keep).tolist()))
                removed.append(len(split) - int(keep.sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], ["doc_id", "text", "n_lines", "n_removed"])

    return lean(run)


def repeated_lines(docs: DataFrame, limit: int = FILTER_BYTES) -> DataFrame:
    """(nk, drops): by row key, the numbers of the lines that stood before, in this document or in an earlier one."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("nk"), "text").where("text IS NOT NULL AND text <> ''")
    n = slim.agg(F.sum(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"))) + 1).alias("n")).first()["n"] or 0
    size = bloom.n_words(n)
    schema = "doc_id long, nk long, line_no int, h long, line binary"
    if 8 * size <= limit:
        twice = bloom.filters(slim.select("text"), _hashes, size)[1]
        suspects = slim.mapInArrow(_suspects(docs.sparkSession.sparkContext.broadcast(twice)), schema)
    else:
        suspects = bloom.sharded(slim.mapInArrow(_suspects(None), schema).withColumn("index", F.lit(True)), n)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "nk", "line_no")
    suspects = cut(suspects.select("doc_id", "nk", "line_no", "line"))
    first = suspects.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = join_counted(suspects, cut(first), "line").where("nk <> first.nk OR line_no <> first.line_no")
    return later.groupBy("nk").agg(F.collect_set("line_no").alias("drops"))


RESULT = "doc_id long, text string, n_lines long, n_removed long"


def dedup_lines(docs: DataFrame, limit: int = FILTER_BYTES, drops_limit: int = DROPS_BYTES) -> DataFrame:
    """(doc_id, text, n_lines, n_removed): each document with only the first occurrences of its lines.

    Lines are what line feeds separate, compared byte by byte. The first occurrence of a line is that of
    the least doc_id (null last; ties by row key), then of the least line number; all later ones are
    removed. Blank lines (of white space only) stay always.

    Rows that agree in doc_id and text are one document and get the same cleaned text. A null text stays null
    with 0 lines; an empty one stays empty with 1. A text of repeated lines only becomes empty. Texts of any
    length are read whole. An empty table gives an empty result; other columns are left out. Ids are whole numbers.

    Filters are built over all lines; a line that the second doesn't hold certainly occurs once and goes no further. Filters
    beyond ``limit`` bytes stay in shards, to which the lines go. The numbers of the lines to remove are sent to
    every executor up to ``drops_limit`` bytes; beyond it only documents that have such lines (by a filter of
    their keys) are joined with them, so texts that stay as they are aren't shuffled. Results are equal.
    """
    require(docs, "doc_id", "text")
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("nk"))
    drops = cut(repeated_lines(docs, limit))
    sums = drops.agg(F.count("*").alias("docs"), F.sum(F.size("drops")).alias("lines")).first()
    if 16 * sums["docs"] + 4 * (sums["lines"] or 0) <= drops_limit:
        got = drops.toArrow().sort_by("nk")
        lists = got.column("drops").combine_chunks()
        begin = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        shared = spark.sparkContext.broadcast((got.column("nk").to_numpy(), begin, lists.flatten().to_numpy()))
        return slim.mapInArrow(_rebuild(shared), RESULT)
    size = bloom.n_words(sums["docs"])
    if 8 * size > limit:
        return slim.join(drops, "nk", "left").mapInArrow(_rebuild(None), RESULT)
    shared = spark.sparkContext.broadcast(bloom.filters(drops.select("nk"), lambda batch: [tv.mix(batch.column("nk").to_numpy().view(np.uint64))], size)[0])

    @F.pandas_udf("boolean")
    def touched(nk: pd.Series) -> pd.Series:
        return pd.Series(bloom.contains(shared.value, tv.mix(nk.to_numpy(np.int64).view(np.uint64))))

    mine = slim.withColumn("touched", touched("nk"))
    whole = mine.where("NOT touched").select("doc_id", "text", "nk", F.lit(None).cast("array<int>").alias("drops"))
    return whole.unionByName(mine.where("touched").join(drops, "nk", "left").select("doc_id", "text", "nk", "drops")).mapInArrow(_rebuild(None), RESULT)


#: DuckDB: dedup_lines() of documents.
LINES_SQL = """
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM documents
), k AS (
    SELECT *, regexp_full_match(line, '[\\t\\x0b\\f\\r ]*') OR row_number() OVER (PARTITION BY line ORDER BY doc_id, no) = 1 AS keep FROM l
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(string_agg(k.line, chr(10) ORDER BY k.no) FILTER (WHERE k.keep), '') END AS text,
    count(k.no)::BIGINT AS n_lines, count(k.no) FILTER (WHERE NOT k.keep)::BIGINT AS n_removed
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id GROUP BY d.doc_id, d.text
"""
