"""Exact repeats of long passages: fixed blocks as anchors, rolling windows as probes, extension to maximal length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.llm import bloom
from frameloom.llm import textvec as tv
from frameloom.llm.common import cut, distinct_rows, lean, require, row_key

MIN_WORDS = 50
#: Bytes of a filter that is sent to every executor. A larger one stays in shards, to which the windows' hashes go.
FILTER_BYTES = 64 << 20
#: Runs that more than one row in so many has are frequent; a task holds some counts of what may be.
FREQUENT, HELD_COUNTS = 1024, 200_000
#: Runs of a segment at most, and segments of a batch.
SEGMENT, SEGMENTS = 64, 16_384
#: Runs that follow each other: where they are compared, their document (no id, the id or else the row key), half of the row key with the place
#: of the first and whether each comes again, its start and size, the hashes of all, and how far start and end are from those before.
SEGMENT_ROW = "route long, none boolean, key long, at long, chars long, h binary, steps binary"
#: A place: document, half of the row key with the place, start.
PLACE = "none boolean, key long, at long, start int"
#: Runs of one segment that stood before and are linked: document, place of the first, their number, characters, reference of the first and the last.
PIECE = "none boolean, key long, at long, n int, start int, end int, ref_none boolean, ref_key long, ref_at long, ref_start int, last_none boolean, last_key long, last_at long"


def block_words(min_words: int) -> int:
    """The longest block of which every run of ``min_words`` words holds a whole one, wherever blocks begin."""
    return (min_words + 1) // 2


class Words:
    """The words of some texts (white space separates them), with their numbers and the hashes of runs of them."""

    def __init__(self, data: np.ndarray, offs: np.ndarray) -> None:
        self.data, self.offs = data, offs
        self.row, self.start, self.end = tv.spans(data, offs, tv.SOLID_BYTE)
        self.codes = tv.span_hashes(data, self.start, self.end) if len(self.row) else np.zeros(0, np.uint64)
        self.place = np.arange(len(self.row)) - np.searchsorted(self.row, self.row)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``n`` words from each word on, and whether they are in one text."""
        h = tv.window_hashes(self.codes, n)
        return h, self.row[: len(h)] == self.row[n - 1 :][: len(h)]

    def chars(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word in characters of its text."""
        at = tv.char_index(self.data)
        base = at[self.offs[:-1]][self.row]
        return at[self.start] - base, at[self.end] - base


def _blocks(n: int):
    def extract(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, data, offs in tv.slices(batch.column("text")):
            w = Words(data, offs)
            h, inside = w.windows(n)
            yield h[inside & (w.place[: len(h)] % n == 0)]

    return extract


def _anchors(n: int, shared):
    """Hashes of the windows that equal a block elsewhere, as far as filters tell."""

    def extract(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        once, twice = shared.value
        for _, _, data, offs in tv.slices(batch.column("text")):
            w = Words(data, offs)
            h, inside = w.windows(n)
            block = w.place[: len(h)] % n == 0
            yield np.concatenate([x[bloom.contains(f, x)] for f, x in ((once, h[inside & ~block]), (twice, h[inside & block]))])

    return extract


def _all_windows(n: int):
    """(h, nk, pos, index) of every window of ``n`` words; blocks are the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in tv.slices(batch.column("text")):
                w = Words(data, offs)
                h, inside = w.windows(n)
                at = np.flatnonzero(inside)
                nk = batch.column("nk").slice(i, j - i).take(pa.array(w.row[at]))
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), nk, pa.array(w.place[at].astype(np.int32)), pa.array(w.place[at] % n == 0)], ["h", "nk", "pos", "index"])

    return lean(run)


class _Frequent:
    """Counts of what comes often among many hashes (lossy counting): none of more than one in ``FREQUENT`` is missed."""

    def __init__(self) -> None:
        self.h, self.n, self.total = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def add(self, h: np.ndarray) -> None:
        u, n = np.unique(h, return_counts=True)
        self.total += len(h)
        self.h, at = np.unique(np.concatenate([self.h, u]), return_inverse=True)
        self.n = np.bincount(at, np.concatenate([self.n, n])).astype(np.int64)
        if len(self.h) > HELD_COUNTS:
            some = self.n > self.total // (8 * FREQUENT)
            self.h, self.n = self.h[some], self.n[some]

    def found(self) -> tuple[list, list]:
        """The candidates and their counts, and the number of all as that of a null."""
        some = self.n > max(1, self.total // (4 * FREQUENT))
        return [*self.h[some].tolist(), None], [*self.n[some].tolist(), self.total]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of every ``n`` consecutive values."""
    span = 1
    while 2 * span <= n:
        x, span = np.minimum(x[:-span], x[span:]), 2 * span
    return np.minimum(x[: len(x) - (n - span)], x[n - span :])


def _among(some: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Where each of ``x`` is in a sorted array, or -1."""
    if not len(some):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(some, x), len(some) - 1)
    return np.where(some[at] == x, at, -1)


class _Runs:
    """Runs of ``least`` words in a slice of a batch that hold an anchor of ``n`` words: by the broadcast filter of anchors, or the column ``hits`` of their places.

    Of each its first word (``at``), hash and the least hash of the windows of ``n`` words in it.
    """

    def __init__(self, batch: pa.RecordBatch, i: int, j: int, data: np.ndarray, offs: np.ndarray, n: int, least: int, shared) -> None:
        self.words = w = Words(data, offs)
        h, inside = w.windows(least)
        if not len(h):
            self.at, self.h, self.m = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            return
        windows = w.windows(n)[0]
        if shared is not None:
            anchor = bloom.contains(shared.value, windows)
        else:
            hits = batch.column("hits").slice(i, j - i)
            own = np.repeat(np.arange(j - i), hits.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            anchor = np.zeros(len(windows), bool)
            anchor[np.searchsorted(w.row, own) + hits.flatten().to_numpy(zero_copy_only=False)] = True
        before = np.concatenate([[0], np.cumsum(anchor)])
        self.at = np.flatnonzero(inside & (before[least - n + 1 :][: len(h)] > before[: len(h)]))
        self.h, self.m = h[self.at].view(np.int64), _least(windows, least - n + 1)[self.at].view(np.int64)
        self.row, self.place = w.row[self.at], w.place[self.at]
        doc, nk = (batch.column(c).slice(i, j - i) for c in ("doc_id", "nk"))
        self.none, self.key = (x.to_numpy(zero_copy_only=False)[self.row] for x in (doc.is_null(), pc.coalesce(doc, nk)))
        self.half = (nk.to_numpy().astype(np.int32).astype(np.int64) << 32)[self.row]
        start, end = w.chars()
        self.start, self.end = start[self.at], end[self.at + least - 1]

    def again(self, least: int) -> np.ndarray:
        """Whether the same run stands up to ``least`` words before in the text, as in one word that goes on."""
        order = np.lexsort((self.at, self.h, self.row))
        s, r, h = self.at[order], self.row[order], self.h[order]
        out = np.zeros(len(s), bool)
        out[order[1:]] = (h[1:] == h[:-1]) & (r[1:] == r[:-1]) & (s[1:] - s[:-1] <= least)
        return out


def _each(batches: Iterator[pa.RecordBatch], *args) -> Iterator[_Runs]:
    for batch in batches:
        for part in tv.slices(batch.column("text")):
            runs = _Runs(batch, *part, *args)
            if len(runs.at):
                yield runs


def _counts(*args):
    """(run, h, n): how often the frequent runs come, and the frequent least windows of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {True: _Frequent(), False: _Frequent()}
        for runs in _each(batches, *args):
            counts[True].add(runs.h)
            counts[False].add(runs.m)
        for kind, c in counts.items():
            h, n = c.found()
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(h)), pa.array(h, pa.int64()), pa.array(n, pa.int64())], ["run", "h", "n"])

    return lean(run)


def _earliest(often: np.ndarray, *args):
    """The earliest place in some texts of each run in ``often``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _each(batches, *args):
            some = np.flatnonzero(_among(often, r.h) >= 0)
            some = some[np.lexsort((r.place[some], r.half[some], r.key[some], r.none[some], r.h[some]))]
            some = some[np.concatenate([[True], r.h[some[1:]] != r.h[some[:-1]]])] if len(some) else some
            at = r.half[some] | (r.place[some] << 1)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (r.h[some], r.none[some], r.key[some], at, r.start[some].astype(np.int32))], ["h", *_names(PLACE)])

    return lean(run)


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Stretches of ``values`` between ``edges`` as bytes."""
    offs = ((edges - edges[0]) * values[:1].nbytes).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(values[edges[0] : edges[-1]]))])


def _segments(often: np.ndarray, crowded: np.ndarray, least: int, *args):
    """Runs as segments, so that a run costs little more than its hash.

    Runs that are equal have the same least window, and so have most of those that follow each other: they go together to where that is compared.
    Of a window in ``crowded``, each goes by its own hash. Runs in ``often`` are known, so they stay together wherever they are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _each(batches, *args):
            again = r.again(least)
            route = np.where(_among(crowded, r.m) >= 0, r.h, r.m)
            known = np.flatnonzero(_among(often, r.h) >= 0)
            route[known] = tv.mix((r.key[known] ^ r.half[known] ^ (r.place[known] // SEGMENT)).view(np.uint64)).view(np.int64)
            new = np.ones(len(r.at), bool)
            steps = np.zeros((len(r.at), 2), np.int64)
            steps[1:, 0], steps[1:, 1] = np.diff(r.start), np.diff(r.end)
            new[1:] = (np.diff(r.at) != 1) | (np.diff(r.row) != 0) | (np.diff(route) != 0) | (again[1:] != again[:-1]) | (steps[1:] > 255).any(axis=1)
            first = np.flatnonzero(new)
            new |= (np.arange(len(new)) - np.repeat(first, np.diff(np.append(first, len(new))))) % SEGMENT == 0
            steps[new] = 0
            steps = steps.astype(np.uint8)
            first = np.flatnonzero(new)
            edges = np.append(first, len(new))
            at, chars = r.half | (r.place << 1) | again, r.start << 32 | (r.end - r.start)
            for a in range(0, len(first), SEGMENTS):
                f, e = first[a : a + SEGMENTS], edges[a : a + SEGMENTS + 1]
                yield pa.RecordBatch.from_arrays([*(pa.array(x[f]) for x in (route, r.none, r.key, at, chars)), _binary(r.h, e), _binary(steps, e)], _names(SEGMENT_ROW))

    return lean(run)


def _pieces(often: np.ndarray, places: list[np.ndarray]):
    """Pieces of passages, from segments in the order of route, document and place; ``places`` are the earliest of the runs in ``often``.

    The first place that comes of a run is its earliest. Besides a batch, the different runs of its last route are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_route = [np.zeros(0, np.int64), np.zeros(0, bool), *(np.zeros(0, np.int64) for _ in range(3))], None
        for batch in batches:
            if not len(batch):
                continue
            routes, none, key, base, chars = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("route", "none", "key", "at", "chars"))
            data, offs = tv.buffers(batch.column("h"))
            h, edges = data.view(np.int64), offs // 8
            first, size = edges[:-1], np.diff(edges)
            seg = np.repeat(np.arange(len(size)), size)
            steps = np.cumsum(tv.buffers(batch.column("steps"))[0].reshape(-1, 2), axis=0, dtype=np.int64)
            steps -= steps[first][seg]
            start = (chars >> 32)[seg] + steps[:, 0]
            end = ((chars >> 32) + (chars & 0xFFFFFFFF))[seg] + steps[:, 1]
            at = base[seg] + 2 * (np.arange(len(seg)) - first[seg])
            own = [h, none[seg], key[seg], at, start]
            if held_route != routes[0]:
                held = [x[:0] for x in held]
            n = len(held[0])
            both = [np.concatenate([a, b]) for a, b in zip(held, own)]
            _, earliest, which = np.unique(both[0], return_index=True, return_inverse=True)
            ref = [x[earliest[which[n:]]] for x in both[1:]]
            last = np.concatenate([np.full(n, held_route == routes[-1]), (routes == routes[-1])[seg]])
            keep = earliest[last[earliest]]
            held, held_route = [x[keep] for x in both], routes[-1]
            known = _among(often, h)
            some = np.flatnonzero(known >= 0)
            for x, p in zip(ref, places):
                x[some] = p[known[some]]
            later = np.flatnonzero((ref[0] != own[1]) | (ref[1] != own[2]) | (ref[2] >> 1 != at >> 1))
            if not len(later):
                continue
            r0, r1, r2, r3 = (x[later] for x in ref)
            linked = (at[later] & 1 == 1)[1:] | ((r0[1:] == r0[:-1]) & (r1[1:] == r1[:-1]) & (r2[1:] >> 1 == (r2[:-1] >> 1) + 1))
            new = np.concatenate([[True], (np.diff(later) != 1) | (np.diff(seg[later]) != 0) | ~linked])
            a = np.flatnonzero(new)
            b = np.append(a[1:], len(new)) - 1
            i, k = later[a], later[b]
            columns = (own[1][i], own[2][i], at[i], (b - a + 1).astype(np.int32), start[i].astype(np.int32), end[k].astype(np.int32), r0[a], r1[a], r2[a], r3[a].astype(np.int32), r0[b], r1[b], r2[b])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _names(PIECE))

    return lean(run)


def repeated_runs(docs: DataFrame, min_words: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Segments of the runs of ``min_words`` words that may stand elsewhere, too (all that do are among them), of documents (doc_id, nk, text), and the most frequent runs with their earliest place."""
    spark, n = docs.sparkSession, block_words(min_words)
    spaces = docs.agg(F.sum(F.ceil(F.octet_length("text") / 2 / n)).alias("n")).first()["n"] or 0
    count = max(1, int(spaces) // 3)  # a word and its space have six bytes, as a rule; a fuller filter only lets more through
    size = bloom.n_words(count)
    if 8 * size <= limit:
        filters = bloom.filters(docs.select("text"), _blocks(n), size)
        anchors = bloom.filters(docs.select("text"), _anchors(n, spark.sparkContext.broadcast(filters)), size)[0]
        shared, anchored = spark.sparkContext.broadcast(anchors), docs
    else:
        hits = bloom.sharded(docs.mapInArrow(_all_windows(n), "h long, nk long, pos int, index boolean"), count)
        shared, anchored = None, cut(docs.join(hits.groupBy("nk").agg(F.collect_list("pos").alias("hits")), "nk"))
    how = (n, min_words, shared)
    counts = cut(anchored.mapInArrow(_counts(*how), "run boolean, h long, n long").groupBy("run", "h").agg(F.sum("n").alias("n")))
    total = counts.where("run AND h IS NULL").agg(F.sum("n").alias("n")).first()["n"] or 0
    found = counts.where("h IS NOT NULL").where(F.col("n") > max(1, 3 * total // (4 * FREQUENT))).collect()  # fewer than 4/3 of ``FREQUENT`` of a kind
    often, crowded = (np.array(sorted(r["h"] for r in found if r["run"] == kind), np.int64) for kind in (True, False))
    known = spark.createDataFrame([], f"h long, {PLACE}")
    if len(often):
        places = anchored.mapInArrow(_earliest(often, *how), known.schema)
        known = cut(places.groupBy("h").agg(F.min(F.struct(*_names(PLACE))).alias("r")).select("h", "r.*"))
    return anchored.mapInArrow(_segments(often, crowded, min_words, *how), SEGMENT_ROW), known


def exact_repeats(docs: DataFrame, min_words: int = MIN_WORDS, limit: int = FILTER_BYTES) -> DataFrame:
    """(doc_id, start, end, n_words, ref_doc_id, ref_start): passages that stood before.

    A run of ``min_words`` words (between white space, compared by 64-bit hashes) stood before if it also stands in an
    earlier document or earlier in the same one: of a lesser doc_id (null last; ties by row key), then at a lesser position.
    Its earliest place is its reference. Runs that follow each other in a document, word by word, are one passage if
    their references do so, too, or if the text itself repeats the run within ``min_words`` words. So every run that
    stood before lies in one passage, which is as long as both places agree or until an earlier place begins; a
    word or phrase that goes on for long is one passage. ``start``, ``end`` and ``ref_start`` (of the first run) count characters.

    Runs are compared where the least window in them is, in one sort; those that follow each other go there together, and on as one piece if
    they stay linked. The most frequent are looked up and spread over all tasks.
    Any run holds a whole block of (min_words + 1) // 2 words at a multiple of that length. Blocks are the index, every rolling
    window of that length probes it, and only runs through an anchor so found are compared. Filters beyond ``limit``
    bytes stay in shards, to which the hashes of windows go, with equal results. Texts are never shuffled but then.

    Rows that agree in doc_id and text are one document, reported once. Null, empty and short texts have no
    passages; a null doc_id is reported as null. Ids are whole numbers. Texts of any length are read whole. An empty
    table gives an empty result; other columns are ignored.
    """
    require(docs, "doc_id", "text")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("nk"), "text").where(F.octet_length("text") >= 2 * min_words - 1)
    slim = distinct_rows(slim, "nk")
    segments, often = repeated_runs(slim, min_words, limit)
    known = sorted(map(tuple, often.collect()))
    h, *places = (np.array(x, t) for x, t in zip(zip(*known) if known else [()] * 5, (np.int64, bool, np.int64, np.int64, np.int64)))
    pieces = segments.repartition("route").sortWithinPartitions("route", "none", "key", "at").mapInArrow(_pieces(h, places), PIECE)
    spot = lambda c: F.shiftright(c, 1)
    w = Window.partitionBy("none", "key", "half").orderBy("at")
    before = lambda c: F.lag(c).over(w)
    again, next_to = F.col("at").bitwiseAND(1) == 1, spot("at") == spot(before("at")) + before("n")
    lockstep = (F.col("ref_none") == before("last_none")) & (F.col("ref_key") == before("last_key")) & (spot("ref_at") == spot(before("last_at")) + 1)
    parts = pieces.withColumn("half", F.shiftright("at", 32).cast("int"))
    parts = parts.withColumn("new", F.when(next_to & (again | lockstep), 0).otherwise(1)).withColumn("part", F.sum("new").over(w))
    passages = parts.groupBy("none", "key", "half", "part").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.sum("n") + min_words - 1).cast("int").alias("n_words"), F.min(F.struct("at", "ref_none", "ref_key", "ref_start")).alias("r"),
    )
    ref = F.when(~F.col("r.ref_none"), F.col("r.ref_key"))
    return passages.select(F.when(~F.col("none"), F.col("key")).alias("doc_id"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "n_words", ref.alias("ref_doc_id"), F.col("r.ref_start").cast("long").alias("ref_start"))


_S = r"\t\n\x0b\f\r "
#: DuckDB: exact_repeats() of documents.
REPEATS_SQL = rf"""
WITH l AS (
    SELECT doc_id, regexp_extract_all(text, '[^{_S}]+') AS w, regexp_extract_all(text, '[^{_S}]+[{_S}]*') AS f, length(regexp_extract(text, '^[{_S}]*')) AS skip FROM documents
), g AS (
    SELECT doc_id, w, skip, unnest(range(len(w))) AS pos, unnest(w) AS word, unnest(f) AS f FROM l WHERE len(w) >= {MIN_WORDS}
), c AS (
    SELECT doc_id, pos, word, skip + sum(length(f)) OVER (PARTITION BY doc_id ORDER BY pos) - length(f) AS start, len(w) AS n FROM g
), p AS (
    SELECT *, lead(start + length(word), {MIN_WORDS - 1}) OVER (PARTITION BY doc_id ORDER BY pos) AS "end" FROM c
), t AS (
    SELECT doc_id, unnest(range(len(w) - {MIN_WORDS - 1})) AS pos, unnest(list_transform(range(1, len(w) - {MIN_WORDS - 2}), lambda i: md5(array_to_string(w[i : i + {MIN_WORDS - 1}], ' ')))) AS h FROM l WHERE len(w) >= {MIN_WORDS}
), e AS (
    SELECT t.doc_id, t.pos, p.start, p."end", first_value(t.doc_id) OVER o AS rd, first_value(t.pos) OVER o AS rp, first_value(p.start) OVER o AS rs,
        coalesce(t.pos - lag(t.pos) OVER (PARTITION BY h, t.doc_id ORDER BY t.pos) <= {MIN_WORDS}, false) AS again
    FROM t JOIN p ON t.doc_id = p.doc_id AND t.pos = p.pos WINDOW o AS (PARTITION BY h ORDER BY t.doc_id, t.pos)
), x AS (
    SELECT *, CASE WHEN pos = lag(pos) OVER w + 1 AND (again OR (rd = lag(rd) OVER w AND rp = lag(rp) OVER w + 1)) THEN 0 ELSE 1 END AS new
    FROM e WHERE doc_id <> rd OR pos <> rp WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), k AS (
    SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS part FROM x
)
SELECT doc_id, min(start)::BIGINT AS start, max("end")::BIGINT AS "end", (max(pos) - min(pos) + {MIN_WORDS})::INTEGER AS n_words,
    arg_min(rd, pos) AS ref_doc_id, arg_min(rs, pos)::BIGINT AS ref_start
FROM k GROUP BY doc_id, part
"""
