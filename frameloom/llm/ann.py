"""Nearest neighbours by a block matrix join: int8 product tiles, error bounds, float recomputation, heaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameloom.llm.common import cut, lean, require

K = 10
#: Bytes of the vectors of a block, and of a block of queries, at most; a task holds one of each.
BLOCK_BYTES, QUERY_BYTES = 8 << 20, 32 << 20
LEAST_ROWS = 512
#: Blocks that one task reads; with more, several tasks search for the same queries and their heaps are merged.
BLOCKS_PER_TASK = 64
#: Queries of a tile, and pairs recomputed at a time.
TILE_ROWS = 256
PAIRS = 100_000
#: Sums of int8 products are exact in 32-bit floats up to so many dimensions.
PANEL = 1024
#: Decimals to which squared distances count, so that equal ones tie.
DECIMALS = 9
_LAST = np.iinfo(np.int64).max


class Quantised:
    """int8 codes (held as floats for BLAS), scale, norm, norm of the codes and norm of the rounding error of each row."""

    def __init__(self, x: np.ndarray) -> None:
        top = np.abs(x).max(axis=1).astype(np.float64)
        self.scale = np.where(top > 0, top / 127, 1.0)
        codes = np.rint(x / self.scale[:, None])
        self.codes = np.clip(codes, -127, 127).astype(np.int8).astype(np.float32)
        near = self.codes.astype(np.float64) * self.scale[:, None]
        self.square = np.einsum("ij,ij->i", x, x, dtype=np.float64)
        self.near_norm = np.sqrt(np.einsum("ij,ij->i", near, near))
        self.error = np.linalg.norm(x - near, axis=1)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of two tiles of codes."""
    out = a[:, :PANEL] @ b[:, :PANEL].T
    for i in range(PANEL, a.shape[1], PANEL):
        out = out.astype(np.float64) + a[:, i : i + PANEL] @ b[:, i : i + PANEL].T
    return out


class Heaps:
    """For each of n rows a max-heap of the ``k`` least (distance, id, key); all rows sift together."""

    def __init__(self, n: int, k: int) -> None:
        self.d, self.i, self.n = np.full((n, k), np.inf), np.full((n, k), _LAST), np.full((n, k), _LAST)

    def _less(self, rows, at, d, i, n) -> np.ndarray:
        """Whether the given entries are less than those at ``at``."""
        hd, hi, hn = self.d[rows, at], self.i[rows, at], self.n[rows, at]
        return (d < hd) | ((d == hd) & ((i < hi) | ((i == hi) & (n < hn))))

    def push(self, rows: np.ndarray, d: np.ndarray, i: np.ndarray, n: np.ndarray) -> None:
        """One entry for each of some distinct rows; it replaces the greatest if it is less."""
        ok = self._less(rows, 0, d, i, n)
        rows, d, i, n = rows[ok], d[ok], i[ok], n[ok]
        at, k = np.zeros(len(rows), np.int64), self.d.shape[1]
        while len(rows):
            left = 2 * at + 1
            right = np.minimum(left + 1, k - 1)
            inner = left < k
            left = np.minimum(left, k - 1)
            child = np.where(self._less(rows, right, self.d[rows, left], self.i[rows, left], self.n[rows, left]), right, left)
            down = inner & self._less(rows, child, d, i, n)
            for to, new in ((self.d, d), (self.i, i), (self.n, n)):
                to[rows, at] = np.where(down, to[rows, child], new)
            rows, d, i, n, at = rows[down], d[down], i[down], n[down], child[down]

    def add(self, rows: np.ndarray, d: np.ndarray, i: np.ndarray, n: np.ndarray) -> None:
        order = np.lexsort((n, i, d, rows))
        rows, d, i, n = rows[order], d[order], i[order], n[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        for r in range(min(self.d.shape[1], int(place.max(initial=-1)) + 1)):
            own = place == r
            self.push(rows[own], d[own], i[own], n[own])


class Queries:
    """A block of vectors, with the keys of their rows, that meets one block after another."""

    def __init__(self, x: np.ndarray, own: np.ndarray, k: int) -> None:
        self.x, self.own, self.q, self.heaps = x, own, Quantised(x), Heaps(len(x), k)

    def meet(self, y: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> int:
        """Takes the neighbours that a block of vectors holds; returns how many pairs were recomputed. ``keys`` ascend."""
        q, r = self.q, Quantised(y)
        half, k, done = (r.square / 2).astype(np.float32), self.heaps.d.shape[1], 0
        widest = np.sqrt(r.square.max())
        at = np.minimum(np.searchsorted(keys, self.own), len(keys) - 1)
        same = np.where(keys[at] == self.own, at, -1)  # where a query itself stands in the block
        for a in range(0, len(self.x), TILE_ROWS):
            b = min(len(self.x), a + TILE_ROWS)
            dots = product(q.codes[a:b], r.codes)
            dots *= r.scale.astype(np.float32)
            dots *= q.scale[a:b, None].astype(np.float32)
            dots -= half
            # |x.y - x'.y'| <= |x'||y - y'| + |x - x'||y|; the rest covers rounding of 32-bit floats and of DECIMALS
            norm = np.sqrt(q.square[a:b])
            error = q.near_norm[a:b] * r.error.max() + q.error[a:b] * widest + 1e-6 * (norm + widest) ** 2 + 10.0**-DECIMALS
            mine = np.flatnonzero(same[a:b] >= 0)
            dots[mine, same[a:b][mine]] = -np.inf
            least = (q.square[a:b] - self.heaps.d[a:b, 0]) / 2 - error
            full = np.isfinite(least)
            if not full.all() and dots.shape[1] > k:
                least = np.where(full, least, np.partition(dots, dots.shape[1] - k, axis=1)[:, -k] - 2 * error)
            row, col = np.nonzero(dots >= least.astype(np.float64)[:, None])
            other = same[row + a] != col
            row, col = row[other], col[other]
            done += len(row)
            for s in range(0, len(row), PAIRS):
                i, j = row[s : s + PAIRS] + a, col[s : s + PAIRS]
                far = self.x[i].astype(np.float64) - y[j]
                d = np.round(np.einsum("ij,ij->i", far, far), DECIMALS)
                near = d <= self.heaps.d[i, 0]
                self.heaps.add(i[near], d[near], ids[j[near]], keys[j[near]])
        return done


def _pack(group: pa.Table) -> pa.Table:
    group = group.combine_chunks()
    keys = group.column("nk").to_numpy()
    _, at = np.unique(keys, return_index=True)
    group = group.take(pa.array(at))
    flat = group.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    none = np.asarray(group.column("vec_id").combine_chunks().is_null())
    ids = group.column("vec_id").combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False)
    one = {c: group.column(c).slice(0, 1).combine_chunks() for c in ("dim", "block")}
    return pa.table(one | {k: pa.array([v.tobytes()], pa.binary()) for k, v in (("ids", ids.astype(np.int64)), ("none", none), ("nks", keys[at]), ("vecs", flat))})


FOUND = "nk long, vec_id long, d double, none boolean, neighbour_id long, neighbour_nk long"


def _result(queries: Queries, ids: np.ndarray, none: np.ndarray, nulls: set[int]) -> pa.RecordBatch:
    h = queries.heaps
    n, k = h.d.shape
    row, d, i, key = np.repeat(np.arange(n), k), h.d.reshape(-1), h.i.reshape(-1), h.n.reshape(-1)
    some = np.flatnonzero(np.isfinite(d))
    gone = np.isin(key[some], np.array(sorted(nulls), np.int64)) & (i[some] == _LAST)
    return pa.RecordBatch.from_arrays(
        [pa.array(queries.own[row[some]]), pa.array(ids[row[some]], mask=none[row[some]]), pa.array(d[some]), pa.array(gone), pa.array(i[some], mask=gone), pa.array(key[some])],
        [c.split()[0] for c in FOUND.split(", ")],
    )


def _search(k: int):
    """The ``k`` nearest of each query among the blocks that follow its block of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, ids, none, nulls = None, None, None, set()
        for batch in batches:
            for r in range(batch.num_rows):
                parts = {c: np.frombuffer(batch.column(c)[r].as_buffer(), t) for c, t in (("ids", np.int64), ("none", bool), ("nks", np.int64), ("vecs", np.float32))}
                x = parts["vecs"].reshape(len(parts["ids"]), -1)
                if batch.column("asks")[r].as_py():
                    if queries is not None:
                        yield _result(queries, ids, none, nulls)
                    queries, ids, none, nulls = Queries(x, parts["nks"], k), parts["ids"], parts["none"], set()
                else:
                    nulls.update(parts["nks"][parts["none"]].tolist())
                    queries.meet(x, parts["ids"], parts["nks"])
        if queries is not None:
            yield _result(queries, ids, none, nulls)

    return lean(run)


def neighbours(vectors: DataFrame, k: int = K, queries: Column | None = None, block_bytes: int = BLOCK_BYTES, query_bytes: int = QUERY_BYTES, blocks_per_task: int = BLOCKS_PER_TASK) -> DataFrame:
    """(vec_id, neighbour_id, rank, distance): the ``k`` nearest other vectors of each query, by Euclidean distance; exact.

    Queries are the rows of ``vectors`` for which the condition ``queries`` on its columns holds (all without one); each is
    compared with all rows. A grid of tasks takes a block of queries and some blocks of vectors each. A tile of int8
    products gives each distance up to the error bound of its two roundings; a pair that the bound rules out of
    the ``k`` nearest so far goes, every other one is recomputed from the 32-bit floats and enters the heap of its
    query. At the end the heaps of a query's tasks are merged.

    Distances are equal if their squares agree to ``DECIMALS`` decimals; the lesser neighbour_id comes first then
    (null last; ties by a hash of the row). Rows that agree in vec_id and vector are one. A vector that is null, empty or holds
    a null or a value that isn't finite is neither query nor neighbour. Vectors of different length are not
    compared. Where fewer than ``k`` others exist, all are given; an empty table gives an empty result. Other
    columns are ignored. Ids are whole numbers.

    A task's memory is bounded by the bytes of its blocks. Work is queries times rows, as in any exact search by a matrix
    product; data sent are the table times the number of query blocks.
    """
    require(vectors, "vec_id", "embedding")
    tasks = 2 * max(1, vectors.sparkSession.sparkContext.defaultParallelism)
    asks = F.lit(True) if queries is None else F.coalesce(queries, F.lit(False))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("vec"), asks.alias("asks")).where((F.size("vec") > 0) & sound)
    slim = slim.select("vec_id", "vec", "asks", F.size("vec").alias("dim"), F.xxhash64(F.col("vec_id").isNull(), "vec_id", "vec").alias("nk"))

    def packed(rows: DataFrame, most: int) -> DataFrame:
        per = F.least(F.greatest(F.lit(LEAST_ROWS), F.ceil(F.col("n") / tasks)), F.greatest(F.lit(1), F.floor(F.lit(most) / (F.col("dim") * 4))))
        sizes = rows.groupBy("dim").agg(F.count("*").alias("n")).select("dim", F.ceil(F.col("n") / per).alias("blocks"))
        in_blocks = rows.drop("asks").join(sizes, "dim").withColumn("block", F.pmod("nk", "blocks").cast("int"))
        return cut(in_blocks.groupBy("dim", "block").applyInArrow(_pack, "dim int, block int, ids binary, none binary, nks binary, vecs binary"))

    blocks, asked = packed(slim, block_bytes), packed(slim.where("asks"), query_bytes)
    blobs = ["ids", "none", "nks", "vecs"]
    part = F.floor(F.col("block") / blocks_per_task)
    present = asked.select("dim", F.col("block").alias("q"))
    parts = blocks.select("dim", part.alias("part")).distinct()
    sent = asked.withColumnRenamed("block", "q").join(parts, "dim").select("dim", "q", "part", F.lit(True).alias("asks"), F.lit(-1).alias("block"), *blobs)
    sent = sent.unionByName(blocks.join(present, "dim").select("dim", "q", part.alias("part"), F.lit(False).alias("asks"), "block", *blobs))
    n = max(1, present.join(parts, "dim").count())
    placed = sent.repartition(n, "dim", "q", "part").sortWithinPartitions("dim", "q", "part", "block")
    found = placed.select("asks", *blobs).mapInArrow(_search(k), FOUND)
    best = found.groupBy("nk").agg(F.first("vec_id").alias("vec_id"), F.slice(F.sort_array(F.collect_list(F.struct("d", "none", "neighbour_id", "neighbour_nk"))), 1, k).alias("near"))
    ranked = best.select("vec_id", F.posexplode("near").alias("r", "x"))
    return ranked.select("vec_id", F.col("x.neighbour_id").alias("neighbour_id"), (F.col("r") + 1).alias("rank"), F.sqrt("x.d").alias("distance"))


#: DuckDB: neighbours() of embeddings for the queries of every hundredth id.
NEIGHBOURS_SQL = f"""
WITH v AS (
    SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
    SELECT a.vec_id, b.vec_id AS neighbour_id, round(list_sum(list_transform(list_zip(a.e, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), {DECIMALS}) AS d
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0
), r AS (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour_id)::INTEGER AS rank FROM p
)
SELECT vec_id, neighbour_id, rank, sqrt(d) AS distance FROM r WHERE rank <= {K}
"""
