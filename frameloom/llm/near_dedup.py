"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm import textvec as tv
from frameloom.llm.common import cut, every, fresh, lean, require, row_hash, row_key
from frameloom.llm.components import connected_components, find, union

SLOTS = 128
ROWS = 4
SHINGLE = 3
THRESHOLD = 0.55
#: Members of a bucket that meet as one block.
BLOCK = 4096
#: Bytes of the list of documents that go which is sent to every executor. A longer one is joined.
DROPS_BYTES = 16 << 20
_VALUE_BITS = 24
_U64 = np.uint64


def shingles(data: np.ndarray, offs: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``size`` words; a text of fewer words has one shingle of all of them."""
    row, start, end = tv.spans(data, offs, tv.WORD_BYTE)
    if not len(row):
        return row, np.zeros(0, _U64)
    h = tv.span_hashes(data, start, end, fold=True)
    count = np.bincount(row, minlength=len(offs) - 1)
    runs = tv.window_hashes(h, size)
    inside = row[: len(runs)] == row[size - 1 :][: len(runs)]
    rows, out = row[: len(runs)][inside], runs[inside]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.searchsorted(row, short)
        extra = np.zeros(len(short), _U64)
        for k in range(size - 1):
            more = count[short] > k
            extra[more] = tv.mix(extra[more] * _U64(31) + h[first[more] + k])
        rows, out = np.concatenate([rows, short]), np.concatenate([out, extra])
    return rows, out


def superminhash(rows: np.ndarray, elements: np.ndarray, n: int, m: int = SLOTS) -> np.ndarray:
    """n x m registers (uint32) of the sets whose elements are listed with their row.

    In step j an element draws a random value and the j-th entry of its own random
    permutation of the slots, and offers j + value to that slot. All elements take
    step j together; a row stops as soon as its largest register is below j + 1,
    since no later step can lower it.
    """
    empty = np.uint32(0xFFFFFFFF)
    registers = np.full((n, m), empty, np.uint32)
    flat = registers.reshape(-1)
    perm = np.zeros((0, 0), np.uint8)
    for j in range(m):
        if not len(rows):
            break
        r = tv.mix(elements + _U64((0x9E3779B97F4A7C15 * (j + 1)) & 0xFFFFFFFFFFFFFFFF))
        value = (np.uint32(j) << np.uint32(_VALUE_BITS)) | (r >> _U64(64 - _VALUE_BITS)).astype(np.uint32)
        pick = j + (((r & _U64(0xFFFFFFFF)) * _U64(m - j)) >> _U64(32)).astype(np.int64)
        if j == 0:
            slot = pick
        else:
            at = np.arange(len(rows))
            slot = perm[at, pick].astype(np.int64)
            perm[at, pick] = perm[at, j]
        np.minimum.at(flat, rows * m + slot, value)
        open_rows = registers.max(axis=1) >= np.uint64((j + 1) << _VALUE_BITS)
        going = open_rows[rows]
        if j == 0:
            rows, elements, pick = rows[going], elements[going], pick[going]
            perm = np.broadcast_to(np.arange(m, dtype=np.uint8), (len(rows), m)).copy()
            perm[np.arange(len(rows)), pick] = 0
        elif not going.all():
            rows, elements, perm = rows[going], elements[going], perm[going]
    return registers


@lean
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A signature of 16 bits a register for each text; null for texts without words."""
    for batch in batches:
        for i, j, data, offs in tv.slices(batch.column("text")):
            rows, elements = shingles(data, offs)
            some = np.unique(rows)
            sig = np.zeros((j - i, SLOTS), "<u2")
            if len(some):
                sig[some] = tv.mix(superminhash(np.searchsorted(some, rows), elements, len(some)).astype(_U64)).astype("<u2")
            none = np.ones(j - i, bool)
            none[some] = False
            valid = pa.array(~none).buffers()[1]
            edges = (np.arange(j - i + 1) * 2 * SLOTS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("nk").slice(i, j - i), batch.column("doc_id").slice(i, j - i), pa.Array.from_buffers(pa.binary(), j - i, [valid, pa.py_buffer(edges), pa.py_buffer(sig)])], ["nk", "doc_id", "sig"]
            )


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of signatures, without the share of registers that agree by chance."""
    equal = (a == b).mean(axis=-1)
    return (equal - 2.0**-16) / (1 - 2.0**-16)


def _signatures(column: pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(tv.buffers(column)[0].tobytes(), "<u2").reshape(n, -1)


def _alike(threshold: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (_signatures(batch.column(c), batch.num_rows) for c in ("sa", "sb"))
                yield batch.select(["a", "b"]).filter(pa.array(similarity(a, b) >= threshold))

    return lean(keep)


def _links(roots: np.ndarray, sigs: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Pairs of roots that any two alike members join: a spanning forest of them."""
    parent: dict[int, int] = {}
    found = []
    step = max(1, (1 << 22) // max(1, sigs.size))
    for i in range(0, len(sigs), step):
        near = similarity(sigs[i : i + step, None], sigs[None, i:]) >= threshold
        x, y = np.nonzero(near)
        pairs = np.stack([roots[x + i], roots[y + i]], axis=1)
        for a, b in np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0).tolist():
            if find(parent, a) != find(parent, b):
                union(parent, a, b)
                found.append((a, b))
    return found


def _meet(threshold: float):
    """Edges between roots from rows (unit, root, sig) sorted by unit; members of a unit all meet, in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
            roots, sigs = (np.concatenate(x) for x in zip(*parts))
            return _links(roots, sigs, threshold)

        held, unit = [], None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            units, roots, sigs = batch.column("unit").to_numpy(), batch.column("root").to_numpy(), _signatures(batch.column("sig"), n)
            edges = np.concatenate([[0], np.flatnonzero(units[1:] != units[:-1]) + 1, [n]])
            out = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if held and units[a] != unit:
                    out += links(held)
                    held = []
                unit = units[a]
                held.append((roots[a:b], sigs[a:b]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])
        if held:
            out = links(held)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    return lean(run)


def near_duplicate_groups(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(doc_id, nk, group_id, group_size, copies, keep) for each document that has a near duplicate.

    Two documents are near duplicates if they share a band of ``ROWS`` registers and the similarity of their sets of
    3-word shingles (letters and digits, without regard to case), as all registers estimate it, reaches
    ``threshold``; groups are the connected components. The document
    with the least doc_id (null last; ties by row key) of each group has
    ``keep``; ``group_id`` is its doc_id and ``group_size`` counts rows.

    Rows that agree in doc_id and text are one document with ``copies`` > 1:
    one result row, and a group even when nothing else resembles it. A null,
    empty or wordless text resembles nothing. Texts of any length are read
    whole. An empty table gives an empty result; other columns are ignored. Ids are whole numbers.

    Documents of equal signatures are one class from the start, so exact copies meet no bucket. In each bucket
    of a band every class is compared with those of least and greatest key. Where that leaves a bucket's classes in
    several components, all of them meet in blocks of ``block``, in memory; only edges that join components are
    put out. So each pair that shares a bucket is verified or known to be connected, at any size of bucket.
    """
    require(docs, "doc_id", "text")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("nk"), F.lower("text").alias("text"))
    signed = cut(slim.mapInArrow(_sign, "nk long, doc_id long, sig binary").withColumn("c", F.coalesce(F.when(F.col("sig").isNotNull(), F.xxhash64("sig")), F.col("nk"))))
    signature = cut(signed.where("sig IS NOT NULL").select("c", "sig").dropDuplicates(["c"]))

    bands = F.array(*(F.xxhash64(F.lit(k), F.substring("sig", 2 * ROWS * k + 1, 2 * ROWS)) for k in range(SLOTS // ROWS)))
    in_bands = signature.select("c", F.explode(bands).alias("bh"))
    buckets = in_bands.groupBy("bh").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    members = cut(in_bands.join(buckets, "bh"))

    left = signature.select(F.col("c").alias("a"), F.col("sig").alias("sa"))
    right = signature.select(F.col("c").alias("b"), F.col("sig").alias("sb"))
    led = members.select(F.col("low").alias("a"), F.col("c").alias("b")).where("a <> b").unionByName(members.select(F.col("c").alias("a"), F.col("high").alias("b")).where("a <> b")).distinct()
    good = cut(led.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(_alike(threshold), "a long, b long"))
    linked = cut(connected_components(good))

    placed = cut(members.select("bh", "c").join(linked.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c")))
    several = placed.groupBy("bh").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("n")).where("least <> most")
    mixed = placed.join(several.select("bh", F.ceil(F.col("n") / block).alias("blocks")), "bh")
    own = F.pmod(F.xxhash64("c"), F.col("blocks"))
    met = mixed.select("c", "root", "bh", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    units = met.select("c", "root", F.xxhash64("bh", F.least("own", "other"), F.greatest("own", "other")).alias("unit")).join(signature, "c")
    joined = cut(units.select("unit", "root", "sig").repartition("unit").sortWithinPartitions("unit").mapInArrow(_meet(threshold), "a long, b long"))
    found = connected_components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(joined))

    rows = signed.groupBy("nk").agg(F.first("doc_id").alias("doc_id"), F.first("c").alias("c"), F.count("*").alias("copies"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "nk"))
    classes = rows.groupBy("c").agg(F.sum("copies").alias("n"), least.alias("best"))
    classes = classes.join(found.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    groups = classes.groupBy("root").agg(F.sum("n").alias("group_size"), F.min("best").alias("best")).where("group_size > 1")
    named_classes = classes.select("c", "root").join(groups, "root")
    return rows.join(named_classes, "c").select("doc_id", "nk", F.col("best.doc_id").alias("group_id"), "group_size", "copies", (F.col("nk") == F.col("best.nk")).alias("keep"))


def keep_one_of_each(docs: DataFrame, threshold: float = THRESHOLD, limit: int = DROPS_BYTES) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, and one row of repeated rows; all columns stay.

    Of rows that agree in doc_id and text but not in other columns, that of the least hash of the row stays.
    Documents without words stay unless their row is repeated (see near_duplicate_groups). Texts are shuffled only where the
    keys of those that go have more than ``limit`` bytes.
    """
    nk, row = fresh(docs, "nk", "row")
    groups = cut(near_duplicate_groups(docs, threshold).select(F.col("nk").alias(nk), "keep", "copies"))
    keyed = docs.withColumn(nk, row_key())
    gone, again = groups.where("NOT keep").select(nk), groups.where("keep AND copies > 1").select(nk)
    if 8 * gone.count() <= limit:
        gone = F.broadcast(gone)
    n_again = again.count()
    if 8 * n_again <= limit:
        again = F.broadcast(again)
    kept = keyed.join(gone, nk, "left_anti")
    if n_again:
        one = kept.join(again, nk, "left_semi").groupBy(nk).agg(F.min_by(F.struct(*every(docs)), row_hash(docs)).alias(row))
        kept = kept.join(again, nk, "left_anti").select(*every(docs)).unionByName(one.select(*(F.col(row)[c].alias(c) for c in docs.columns)))
    return kept.select(*every(docs))
