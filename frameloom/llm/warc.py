"""Capture index of web pages: locally sorted runs, range shuffle, k-way loser-tree merge, capture histories."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm.common import cut, require

#: Time of the capture of page 0 in tables without capture times; later pages follow by the second.
EPOCH = 1704067200
#: Bytes of a run that is sorted in memory; a task with more makes several runs.
RUN_BYTES = 64 << 20
#: Captures that one merging task should have, and merging tasks at most (each sends one row to the driver).
MERGE_ROWS, MERGE_TASKS = 250_000, 50_000
OUT_ROWS = 20_000

_PARTS = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^?#]*)(?:[?]([^#]*))?"
INDEX = "url_key string, captured_at long, page_id long, url string, digest string, length long, k_time long, k_none int, k_page long"
_ORDER = ["url_key", "k_time", "k_none", "k_page", "digest", "url"]


def url_key(url: str = "url") -> str:
    """SQL of the sort-friendly key of a URL.

    Host labels are reversed ("com,example)/path?query"), without "www.", user, usual port and fragment; slashes at the
    end of the path and utm_ parameters go, parameters are sorted. What has no host is its own key; null is "".
    """
    host = f"regexp_replace(lower(regexp_extract({url}, r'{_PARTS}', 1)), '^www[0-9]*[.]', '')"
    port = f"regexp_extract({url}, r'{_PARTS}', 2)"
    path = f"regexp_replace(regexp_extract({url}, r'{_PARTS}', 3), '/+$', '')"
    query = f"array_sort(filter(split(regexp_extract({url}, r'{_PARTS}', 4), '&'), x -> x <> '' AND NOT (lower(x) LIKE 'utm\\\\_%')))"
    made = f"array_join(reverse(split({host}, '[.]')), ',') || CASE WHEN {port} IN ('', '80', '443') THEN '' ELSE ':' || {port} END || ')' || CASE WHEN {path} = '' THEN '/' ELSE {path} END || CASE WHEN size({query}) = 0 THEN '' ELSE '?' || array_join({query}, '&') END"
    return f"CASE WHEN {url} IS NULL THEN '' WHEN {host} = '' THEN {url} ELSE {made} END"


def captures(pages: DataFrame) -> DataFrame:
    """Index entries of pages, made by built-in expressions only."""
    at = F.col("captured_at").cast("long") if "captured_at" in pages.columns else F.lit(EPOCH) + F.col("page_id").cast("long")
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), at.alias("captured_at"), F.col("url").cast("string").alias("url"), "html")
    return slim.select(
        F.expr(url_key()).alias("url_key"),
        "captured_at",
        "page_id",
        "url",
        F.sha1(F.col("html").cast("binary")).alias("digest"),
        F.octet_length("html").cast("long").alias("length"),
        F.coalesce("captured_at", F.lit(-(1 << 63))).cast("long").alias("k_time"),
        F.col("page_id").isNull().cast("int").alias("k_none"),
        F.coalesce("page_id", F.lit(0)).cast("long").alias("k_page"),
    )


def _sorted(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in _ORDER], null_placement="at_start"))


def _runs(run_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            kept.append(batch)
            size += batch.nbytes
            if size >= run_bytes:
                yield from _sorted(pa.Table.from_batches(kept)).to_batches(OUT_ROWS)
                kept, size = [], 0
        if kept:
            yield from _sorted(pa.Table.from_batches(kept)).to_batches(OUT_ROWS)

    return run


class LoserTree:
    """The least head of ``k`` sorted runs, in one comparison for each level of the tree.

    ``runs`` are lists of keys that can be compared; an inner node holds the run that lost there and the root's
    place 0 the winner. Equal heads come in the order of their runs.
    """

    def __init__(self, runs: list[list]) -> None:
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.heads = [(False, r[0], j) if r else (True, None, j) for j, r in enumerate(runs)]
        self.tree = [0] * max(1, self.k)
        win = [0] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = win[2 * node], win[2 * node + 1]
            win[node], self.tree[node] = (a, b) if self._before(a, b) else (b, a)
        self.tree[0] = win[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x[0] or y[0]:
            return not x[0] or (y[0] and a < b)
        return x[1:] < y[1:]

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place in it) of every entry in order."""
        tree, heads, at, k = self.tree, self.heads, self.at, self.k
        while k and not heads[tree[0]][0]:
            w = tree[0]
            yield w, at[w]
            at[w] += 1
            heads[w] = (False, self.runs[w][at[w]], w) if at[w] < len(self.runs[w]) else (True, None, w)
            node = (w + k) >> 1
            while node:
                if self._before(tree[node], w):
                    tree[node], w = w, tree[node]
                node >>= 1
            tree[0] = w


def natural_runs(keys: list) -> list[int]:
    """Where ascending runs begin."""
    return [0] * bool(keys) + [i for i in range(1, len(keys)) if keys[i] < keys[i - 1]]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = [b for b in batches if b.num_rows]
    if not kept:
        return
    table = pa.Table.from_batches(kept).combine_chunks()
    cols = [table.column(c).to_pylist() for c in _ORDER]
    keys = list(zip(cols[0], cols[1], cols[2], cols[3], [x or "" for x in cols[4]], [x or "" for x in cols[5]]))
    edges = [*natural_runs(keys), len(keys)]  # what a map task sorted comes as one run
    order = np.fromiter((edges[r] + p for r, p in LoserTree([keys[a:b] for a, b in zip(edges, edges[1:])])), np.int64, len(keys))
    for i in range(0, len(order), OUT_ROWS):
        yield from table.take(pa.array(order[i : i + OUT_ROWS])).combine_chunks().to_batches()


HISTORY = "url_key string, captured_at long, page_id long, url string, digest string, length long, capture_no long, seconds_since long, revisit boolean"
_EDGE = "part int, n long, first_key string, last_key string, last_n long, last_time long, last_digest string"


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = first = last = time = digest = None
    n = tail = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("url_key").to_pylist()
        part, first = batch.column("part")[0].as_py(), keys[0] if first is None else first
        k = len(keys)
        while k and keys[k - 1] == keys[-1]:
            k -= 1
        tail = len(keys) - k + (tail if k == 0 and last == keys[-1] else 0)
        last, time, digest, n = keys[-1], batch.column("captured_at")[-1].as_py(), batch.column("digest")[-1].as_py(), n + len(keys)
    if n:
        yield pa.RecordBatch.from_pylist(
            [dict(part=part, n=n, first_key=first, last_key=last, last_n=tail, last_time=time, last_digest=digest)],
            pa.schema([("part", pa.int32()), ("n", pa.int64()), ("first_key", pa.string()), ("last_key", pa.string()), ("last_n", pa.int64()), ("last_time", pa.int64()), ("last_digest", pa.string())]),
        )


def _histories(carried):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if before is None:
                before = carried.value.get(batch.column("part")[0].as_py(), (None, 0, None, None))
            last, n, time, digest = before
            number, since, again = [], [], []
            for key, t, d in zip(*(batch.column(c).to_pylist() for c in ("url_key", "captured_at", "digest"))):
                same = key == last
                n = n + 1 if same else 1
                number.append(n)
                since.append(t - time if same and t is not None and time is not None else None)
                again.append(bool(same and d is not None and d == digest))
                last, time, digest = key, t, d
            before = (last, n, time, digest)
            names = ["url_key", "captured_at", "page_id", "url", "digest", "length"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(number, pa.int64()), pa.array(since, pa.int64()), pa.array(again, pa.bool_())], [*names, "capture_no", "seconds_since", "revisit"])

    return run


def capture_histories(pages: DataFrame, run_bytes: int = RUN_BYTES, merge_rows: int = MERGE_ROWS) -> DataFrame:
    """(url_key, captured_at, page_id, url, digest, length, capture_no, seconds_since, revisit), in order over all partitions.

    Every task sorts its captures into runs; ranges of (url_key, captured_at, page_id) go to merging tasks, which
    find the runs again and merge them by a loser tree. Written as files, entries follow each other by URL key and time.
    ``capture_no`` counts the captures of a key, ``seconds_since`` is the time since the one before, and ``revisit`` says
    that it has the same digest (SHA-1). A key of any number of captures may span partitions: what one needs of
    the partitions before is carried over, a row for each of at most ``MERGE_TASKS`` partitions.

    ``captured_at`` is taken from the table; where it has no such column, page_id counts seconds from ``EPOCH``.
    A null time comes first, a null page_id last. A null URL has the key "", see ``url_key``; a null html has no digest or
    length and is no revisit. Ties are in the order of digest and URL; repeated rows are each a capture. Pages
    of any length are digested whole. An empty table gives an empty result; other columns are ignored.
    """
    require(pages, "page_id", "url", "html")
    spark = pages.sparkSession
    runs = cut(captures(pages).mapInArrow(_runs(run_bytes), INDEX))
    parts = max(1, min(MERGE_TASKS, -(-runs.count() // merge_rows)), spark.sparkContext.defaultParallelism)
    ranged = runs.repartitionByRange(parts, "url_key", "k_time", "k_none", "k_page")
    merged = cut(ranged.mapInArrow(_merge, INDEX)).withColumn("part", F.spark_partition_id())
    carried: dict[int, tuple] = {}
    last: tuple = (None, 0, None, None)
    for e in sorted(merged.mapInArrow(_edges, _EDGE).collect(), key=lambda e: e["part"]):
        carried[e["part"]] = last
        whole = e["first_key"] == e["last_key"] == last[0]
        last = (e["last_key"], e["last_n"] + (last[1] if whole else 0), e["last_time"], e["last_digest"])
    return merged.mapInArrow(_histories(spark.sparkContext.broadcast(carried)), HISTORY)


_HOST = f"regexp_replace(lower(regexp_extract(url, '{_PARTS}', 1)), '^www[0-9]*[.]', '')"
#: DuckDB: capture_histories() of pages.
HISTORY_SQL = f"""
WITH u AS (
    SELECT page_id, {EPOCH} + page_id AS captured_at, url, html, {_HOST} AS host, regexp_extract(url, '{_PARTS}', 2) AS port, regexp_replace(regexp_extract(url, '{_PARTS}', 3), '/+$', '') AS path,
        list_sort(list_filter(string_split(regexp_extract(url, '{_PARTS}', 4), '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_'))) AS params FROM pages
), k AS (
    SELECT CASE WHEN url IS NULL THEN '' WHEN host = '' THEN url ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || CASE WHEN port IN ('', '80', '443') THEN '' ELSE ':' || port END || ')'
        || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(params) = 0 THEN '' ELSE '?' || array_to_string(params, '&') END END AS url_key,
        captured_at, page_id, url, sha1(html) AS digest, strlen(html)::BIGINT AS length FROM u
)
SELECT *, row_number() OVER w AS capture_no, captured_at - lag(captured_at) OVER w AS seconds_since, coalesce(digest = lag(digest) OVER w, false) AS revisit
FROM k WINDOW w AS (PARTITION BY url_key ORDER BY captured_at NULLS FIRST, page_id NULLS LAST, digest, url)
"""
