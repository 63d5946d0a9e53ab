"""Bloom filters of 64-bit hashes seen once and seen twice.

A filter that suits every executor is built in parts, merged by shards and sent. A larger one stays in its shards:
hashes go to the shard of their range, are looked up there, and only suspects come back.
The bits of a hash lie in two 64-bit words, so that a lookup is two memory accesses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm import textvec as tv
from frameloom.llm.common import lean

BITS_PER_HASH = 16
#: Hashes of a shard's filter, about.
PER_SHARD = 4_000_000
SHARD_WORDS = 8192
_U64 = np.uint64

Extract = Callable[[pa.RecordBatch], Iterable[np.ndarray]]


def n_words(n: int) -> int:
    """Words (a power of two) of a filter for ``n`` hashes."""
    return max(SHARD_WORDS, 1 << max(0, (n * BITS_PER_HASH + 63) // 64 - 1).bit_length())


def places(h: np.ndarray, size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k``-th word of each hash and its bits there."""
    if k:
        h = h * _U64(0x9E3779B97F4A7C15)
        h ^= h >> _U64(29)
        h *= _U64(0xBF58476D1CE4E5B9)
    at = (h >> _U64(64 - (size.bit_length() - 1))).astype(np.int64)
    bits = _U64(1) << (h & _U64(63))
    for shift in (6, 12, 18):
        bits = bits | (_U64(1) << ((h >> _U64(shift)) & _U64(63)))
    return at, bits


def contains(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    at, bits = places(h, len(words), 0)
    found = (words[at] & bits) == bits
    some = np.flatnonzero(found)
    at, bits = places(h[some], len(words), 1)
    found[some] = (words[at] & bits) == bits
    return found


def add(words: np.ndarray, h: np.ndarray) -> None:
    for k in range(2):
        at, bits = places(h, len(words), k)
        np.bitwise_or.at(words, at, bits)


def _count(once: np.ndarray, twice: np.ndarray, h: np.ndarray) -> None:
    u, count = np.unique(h, return_counts=True)
    add(twice, u[contains(once, u) | (count > 1)])
    add(once, u)


def _partial(extract: Extract, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(size, _U64), np.zeros(size, _U64)
        for batch in batches:
            for h in extract(batch):
                _count(once, twice, h)
        shards = [(k, once[i : i + SHARD_WORDS], twice[i : i + SHARD_WORDS]) for k, i in enumerate(range(0, size, SHARD_WORDS))]
        shards = [(k, a.tobytes(), b.tobytes()) for k, a, b in shards if a.any()]
        for i in range(0, len(shards), 64):
            k, a, b = zip(*shards[i : i + 64])
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["shard", "once", "twice"])

    return lean(run)


def _merge(parts: pa.Table) -> pa.Table:
    once = twice = np.zeros(SHARD_WORDS, _U64)
    for a, b in zip(parts.column("once"), parts.column("twice")):
        a, b = np.frombuffer(a.as_buffer(), _U64), np.frombuffer(b.as_buffer(), _U64)
        twice = twice | b | (once & a)
        once = once | a
    return pa.table({"shard": parts.column("shard").slice(0, 1).combine_chunks(), "once": pa.array([once.tobytes()], pa.binary()), "twice": pa.array([twice.tobytes()], pa.binary())})


def filters(df: DataFrame, extract: Extract, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(once, twice): every hash of ``df`` is in the first, every one that occurs again is in the second.

    There is a part for each task that can run at a time, so that what is merged follows the
    number of hashes and not that of input files. The caller has checked that ``size`` suits the driver.
    """
    parts = df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism))
    merged = parts.mapInArrow(_partial(extract, size), "shard int, once binary, twice binary").groupBy("shard").applyInArrow(_merge, "shard int, once binary, twice binary")
    once, twice = np.zeros(size, _U64), np.zeros(size, _U64)
    for r in merged.toLocalIterator():
        i = r["shard"] * SHARD_WORDS
        once[i : i + SHARD_WORDS], twice[i : i + SHARD_WORDS] = np.frombuffer(r["once"], _U64), np.frombuffer(r["twice"], _U64)
    return once, twice


def _lookup(size: int, names: list[str]):
    """Rows of a partition of few shards in the order of ``kind``: hashes of the index, probes, and what the index stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, once, twice, asked = None, None, None, None
        for batch in batches:
            shards, kinds, hashes = (batch.column(c).to_numpy() for c in ("shard", "kind", "h"))
            edges = np.concatenate([[0], np.flatnonzero((shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1])) + 1, [len(shards)]]) if len(shards) else []
            for a, b in zip(edges[:-1], edges[1:]):
                if shards[a] != shard:
                    shard, once, twice, asked = shards[a], *(np.zeros(size, _U64) for _ in range(3))
                h = tv.mix(hashes[a:b].view(_U64))
                if kinds[a] == 0:
                    _count(once, twice, h)
                    continue
                if kinds[a] == 1:
                    seen = contains(once, h)
                    add(asked, np.unique(h[seen]))
                else:
                    seen = contains(twice, h) | contains(asked, h)
                yield batch.slice(a, b - a).select(names).filter(pa.array(seen))

    return lean(run)


def sharded(rows: DataFrame, n: int, per_shard: int = PER_SHARD) -> DataFrame:
    """Suspects among ``rows`` (h, index, and others): rows whose hash another row of the index may have.

    Rows with ``index`` make the filters of their shard, of at most about ``n`` hashes in all; the others probe them. A row of the
    index is put out if its hash was seen twice or a probe hit it. Hashes that more than one row of the index in 1,024
    has are suspects without a lookup, so that no shard is swamped by one.
    """
    names = rows.columns
    index = rows.where("index").select("h")
    counts = index.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > max(1, n // 1024)).select("h")
    hot = F.broadcast(counts)  # of at most 1,024 rows, as ``n`` bounds the index
    cold = rows.join(hot, "h", "left_anti")
    shards = max(1, -(-n // per_shard))
    none = [F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c != "h"]
    tagged = cold.withColumn("kind", F.when(F.col("index"), 2).otherwise(1)).unionByName(cold.where("index").select("h", *none, F.lit(0).alias("kind")))
    tagged = tagged.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    placed = tagged.repartitionById(shards, "shard").sortWithinPartitions("shard", "kind")
    out = placed.mapInArrow(_lookup(n_words(min(n, per_shard)), names), rows.schema)
    return out.unionByName(rows.join(hot, "h", "left_semi").select(*names))
