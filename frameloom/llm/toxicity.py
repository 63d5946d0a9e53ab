"""Toxicity scores from an induced lexicon: random walks from seed terms over a graph of positive PMI."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.llm import textvec as tv
from frameloom.llm.common import cut, every, fresh, lean, mapped_rows, require, row_key

#: Labelled documents from which seeds and the threshold are fitted, at most (those of least hash).
MAX_LABELS = 20_000
#: Labelled documents of a toxic seed among whose words its clean counterpart is looked for.
PER_SEED = 20
#: Chance that any seed at all is none: a bound for all terms together.
SEED_ERROR = 0.05
CHUNK = 100
#: Words on each side of a seed by which copied passages are known.
BESIDE = 2
#: (word, seed) rows that a task holds, and pairs that it makes at a time.
HELD_ROWS, PAIRS = 1_000_000, 200_000
MIN_SUPPORT = 3
RESTART = 0.2
#: Standard deviations by which a pair must exceed the expected count.
CHANCE = 4.0
POLARITY = 0.5
#: Bytes of a lexicon that is sent to every executor; a larger one is joined.
LEXICON_BYTES = 64 << 20
#: Bytes of the list of copied places of seeds that is sent to every executor; a longer one is joined.
COPIES_BYTES = 32 << 20
#: Seeds for which the matrix of the walk is held; for more, each step goes over the graph.
GRAM_SEEDS = 2048
#: Difference from a count of chunks, which sums fractions.
TINY = 1e-9
_U64 = np.uint64


@dataclass
class Lexicon:
    """Terms (64-bit hashes, sorted) and polarities above ``POLARITY``, or the table of them; the score from which a text is toxic."""

    terms: np.ndarray
    weights: np.ndarray
    threshold: float
    table: DataFrame | None = None


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row, start, end = tv.spans(data, offs, tv.WORD_BYTE)
    return row, tv.span_hashes(data, start, end, fold=True).view(np.int64) if len(row) else np.zeros(0, np.int64)


def distinct_pairs(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (row, hash) once; rows, which come in order, stay so."""
    _, at = np.unique(tv.mix(h.view(_U64) ^ (row.astype(_U64) * _U64(0x9E3779B97F4A7C15))), return_index=True)
    at.sort()
    return row[at], h[at]


def _list(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


@lean
def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offs in tv.slices(batch.column("text")):
            row, h = words(data, offs)
            n = j - i
            low = np.full((2, n), np.iinfo(np.int64).max)
            runs = tv.window_hashes(h.view(_U64), 3)
            inside = row[: len(runs)] == row[2:][: len(runs)]
            for k in range(2):
                np.minimum.at(low[k], row[: len(runs)][inside], (tv.mix(runs[inside] + _U64(k + 1)) >> _U64(1)).view(np.int64))
            r, d = distinct_pairs(row, h)
            yield pa.RecordBatch.from_arrays(
                [batch.column("nk").slice(i, n), batch.column("toxic").slice(i, n), pa.array(low[0]), pa.array(low[1]), _list(d, np.bincount(r, minlength=n))],
                ["nk", "toxic", "m1", "m2", "words"],
            )


def labelled(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELS) -> DataFrame:
    """(nk, toxic, m1, m2, words) of the labelled documents; m1 and m2 are min-hashes that copies share."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("label_id"), "label_id").limit(limit)
    text = docs.select(F.col("doc_id").cast("long").alias("label_id"), row_key().alias("nk"), F.lower("text").alias("text")).where("text IS NOT NULL")
    joined = text.join(F.broadcast(known), "label_id")  # of at most ``limit`` rows
    return cut(joined.select("nk", "text", "toxic").mapInArrow(_features, "nk long, toxic int, m1 long, m2 long, words array<long>"))


def seed_terms(sample: DataFrame, error: float = SEED_ERROR) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of seed terms: all that labels mark clearly as toxic, and for each a clean term.

    A toxic term stands in more toxic documents than clean ones, and so many that the chance of it (Chernoff's bound
    for a term without polarity) times the number of terms is at most ``error``. The clean term is as usual
    in toxic documents as a term without polarity, stands in a document of the toxic one and is about as
    frequent, so that both sets of seeds cover the same languages and topics. Of documents that share a
    min-hash, as copies do, one counts.
    """
    slim = sample.select("nk", "toxic", "m1", "m2")
    for m in ("m1", "m2"):
        slim = slim.withColumn("r", F.row_number().over(Window.partitionBy(m, "toxic").orderBy("nk"))).where("r = 1").drop("r")
    once = sample.join(F.broadcast(slim.select("nk").distinct()), "nk", "left_semi")  # of at most as many rows as labels
    all_of = once.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).first()
    a_all, b_all = all_of["a"] or 0, all_of["b"] or 0
    if not a_all or not b_all:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    terms = once.select("toxic", F.explode("words").alias("w")).groupBy("w").agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
    terms = terms.where("a + b >= 3").selectExpr("w", "a", "a + b AS n", "a / (a + b) AS share", f"{a_all / (a_all + b_all)}D AS rate")
    far = "a * ln(share / rate) + CASE WHEN share < 1 THEN (n - a) * ln((1 - share) / (1 - rate)) ELSE 0D END"
    terms = cut(terms.withColumns({"g": F.when(F.col("share") > F.col("rate"), F.expr(far)).otherwise(0.0), "z": F.expr("(a - n * rate) / sqrt(n * rate * (1 - rate))")}))
    bound = float(np.log(max(1, terms.count()) / error))
    bad = terms.where((F.col("g") >= bound) & (F.col("share") > 0.5)).select("w", "n")
    chosen = bad.toPandas()  # terms of at most ``limit`` labelled documents
    if chosen.empty:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = cut(bad.select(F.col("w").alias("seed"), F.col("n").alias("seed_n")))
    near = once.select("nk", F.explode("words").alias("seed")).join(F.broadcast(sizes), "seed", "left_semi")  # as many rows as seeds
    some = near.withColumn("r", F.row_number().over(Window.partitionBy("seed").orderBy("nk"))).where(F.col("r") <= PER_SEED)
    some = once.join(F.broadcast(some.select("nk", "seed")), "nk")  # of at most ``PER_SEED`` rows a seed
    pairs = some.select("seed", F.explode("words").alias("w")).distinct().join(terms.where(F.abs("z") < 1).select("w", "n"), "w").join(F.broadcast(sizes), "seed")
    first = Window.partitionBy("seed").orderBy(F.abs(F.log(F.col("n") / F.col("seed_n"))), F.xxhash64("w", "seed"))
    good = pairs.withColumn("r", F.row_number().over(first)).where("r = 1").select("w").distinct()
    return np.sort(chosen.w.to_numpy(np.int64)), np.sort(good.toPandas().w.to_numpy(np.int64))


def chunks(row: np.ndarray, size: int = CHUNK) -> np.ndarray:
    """Number of the chunk of each word: ``size`` words of a row, or what is left of it."""
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return np.cumsum(place % size == 0) - 1


class _Seeds:
    """Seed terms and the places where they stand."""

    def __init__(self, seeds: np.ndarray) -> None:
        self.order = np.argsort(seeds)
        self.seeds, self.ranked = seeds, seeds[self.order]

    def places(self, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, seed, key) of each; the key is a hash of the words around it, which copies share."""
        if not len(self.ranked) or not len(h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.ranked, h), len(self.ranked) - 1)
        hit = np.flatnonzero(self.ranked[at] == h)
        key = np.zeros(len(hit), _U64)
        for k in range(-BESIDE, BESIDE + 1):
            other = np.clip(hit + k, 0, len(h) - 1)
            key = tv.mix(key + np.where(row[other] == row[hit], h[other].view(_U64), _U64(0)))
        return hit, self.order[at[hit]], key.view(np.int64)


def _seed_keys(seeds: np.ndarray, placed: bool):
    """Rows (key, n) of the places of seeds, or with ``placed`` (nk, pos, key) of each."""
    found = _Seeds(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in tv.slices(batch.column("text")):
                row, h = words(data, offs)
                hit, _, key = found.places(row, h)
                if not len(hit):
                    continue
                if placed:
                    pos = hit - np.searchsorted(row, row[hit])
                    yield pa.RecordBatch.from_arrays([batch.column("nk").slice(i, j - i).take(pa.array(row[hit])), pa.array(pos.astype(np.int32)), pa.array(key)], ["nk", "pos", "key"])
                else:
                    u, n = np.unique(key, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n)], ["key", "n"])

    return lean(run)


class _Counts:
    """Sums of counts by (word, seed) in bounded memory: what grows beyond it is put out as partial sums."""

    def __init__(self, most: int = HELD_ROWS) -> None:
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.held, self.most = 0, most

    def add(self, w: np.ndarray, s: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.rows.append((w, s, n))
        self.held += len(w)
        if self.held > self.most:
            self.fold()
            if self.held > self.most // 2:
                yield from self.flush()

    def fold(self) -> None:
        if not self.rows:
            return
        w, s, n = (np.concatenate(c) for c in zip(*self.rows))
        self.rows = []
        order = np.argsort(tv.mix(w.view(_U64)) + (s + 2).astype(_U64))  # rows of a word stand together, which compresses well
        w, s, n = w[order], s[order], n[order]
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (s[1:] != s[:-1])
        at = np.flatnonzero(new)
        self.rows = [(w[at], s[at], np.add.reduceat(n, at))] if len(at) else []
        self.held = len(at)

    def flush(self) -> Iterator[pa.RecordBatch]:
        self.fold()
        for w, s, n in self.rows:
            for k in range(0, len(w), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 200_000]) for x in (w, s, n)], ["w", "s", "n"])
        self.rows, self.held = [], 0


def _cooccur(seeds: np.ndarray, chunk: int, copies):
    """Rows (w, s, n): chunks with word w (s = -1), all (s = -2, w = 0), weights of seed w (s = -3), weights of w and seed s together.

    A seed weighs 1 / the number of places with its key: by the broadcast ``copies`` or by the column ``copied`` of (pos, n).
    """
    found = _Seeds(seeds)

    def weights(key: np.ndarray, row: np.ndarray, pos: np.ndarray, copied: pa.Array | None) -> np.ndarray:
        if copied is None:
            keys, times = copies.value
            if not len(keys):
                return np.ones(len(key))
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return np.where(keys[at] == key, 1.0 / times[at], 1.0)
        flat = copied.flatten()
        own = np.repeat(np.arange(len(copied)), copied.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        known = own << 32 | flat.field("pos").to_numpy(zero_copy_only=False)
        times = flat.field("n").to_numpy(zero_copy_only=False)
        order = np.argsort(known)
        known, times = known[order], times[order]
        if not len(known):
            return np.ones(len(key))
        want = row << 32 | pos
        at = np.minimum(np.searchsorted(known, want), len(known) - 1)
        return np.where(known[at] == want, 1.0 / times[at], 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = _Counts(), 0
        for batch in batches:
            for i, j, data, offs in tv.slices(batch.column("text")):
                row, h = words(data, offs)
                if not len(row):
                    continue
                part = chunks(row, chunk)
                total += int(part[-1]) + 1
                c, w = distinct_pairs(part, h)
                u, n = np.unique(w, return_counts=True)
                yield from counts.add(u, np.full(len(u), -1, np.int32), n.astype(float))
                hit, hs, key = found.places(row, h)
                if not len(hit):
                    continue
                weight = weights(key, row[hit], hit - np.searchsorted(row, row[hit]), None if copies is not None else batch.column("copied").slice(i, j - i))
                order = np.lexsort((-weight, hs, part[hit]))  # of a seed that stands twice in a chunk the greater weight counts
                hc, hs, weight = part[hit][order], hs[order], weight[order]
                new = np.ones(len(hc), bool)
                new[1:] = (hc[1:] != hc[:-1]) | (hs[1:] != hs[:-1])
                hc, hs, weight = hc[new], hs[new], weight[new]
                yield from counts.add(seeds[hs], np.full(len(hs), -3, np.int32), weight)
                lo, hi = np.searchsorted(c, hc), np.searchsorted(c, hc, "right")
                ends = np.cumsum(hi - lo)
                a = 0
                while a < len(hc):
                    b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, "right")))
                    size = (hi - lo)[a:b]
                    which = np.repeat(np.arange(a, b), size)
                    pos = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + lo[which]
                    other = w[pos] != seeds[hs[which]]
                    which, pos = which[other], pos[other]
                    yield from counts.add(w[pos], hs[which].astype(np.int32), weight[which])
                    a = b
        yield from counts.add(np.zeros(1, np.int64), np.full(1, -2, np.int32), np.array([float(total)]))
        yield from counts.flush()

    return lean(run)


def cooccurrence(docs: DataFrame, seeds: np.ndarray, chunk: int = CHUNK, limit: int = COPIES_BYTES) -> DataFrame:
    """(w, n, total, own, near): for each word the chunks it is in, its weight as a seed, and for each seed near it how often.

    Places of a seed that agree in the words around it, as those of copied passages do, weigh as one together.
    The list of such places is sent if it has at most ``limit`` bytes; else it is joined with the documents, with the same result.
    """
    slim = docs.select(row_key().alias("nk"), F.lower("text").alias("text")).where("text IS NOT NULL")
    copied = cut(slim.select("text").mapInArrow(_seed_keys(seeds, False), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1"))
    schema = "w long, s int, n double"
    if 16 * copied.count() <= limit:
        got = copied.toPandas().sort_values("key")
        shared = docs.sparkSession.sparkContext.broadcast((got.key.to_numpy(np.int64), got.n.to_numpy(np.float64)))
        counted = slim.select("text").mapInArrow(_cooccur(seeds, chunk, shared), schema)
    else:
        of = slim.mapInArrow(_seed_keys(seeds, True), "nk long, pos int, key long").distinct().join(copied, "key")
        of = of.groupBy("nk").agg(F.collect_list(F.struct("pos", F.col("n").cast("double").alias("n"))).alias("copied"))
        counted = slim.join(of, "nk", "left").select("text", "copied").mapInArrow(_cooccur(seeds, chunk, None), schema)
    summed = counted.repartition("w").groupBy("w", "s").agg(F.sum("n").alias("n"))

    def alone(s: int):
        return F.coalesce(F.sum(F.when(F.col("s") == s, F.col("n"))), F.lit(0.0))

    near = F.when(F.col("s") >= 0, F.struct("s", "n"))
    return summed.groupBy("w").agg(alone(-1).alias("n"), alone(-2).alias("total"), alone(-3).alias("own"), F.collect_list(near).alias("near"))


def _pairs(batch: pa.RecordBatch, total: float, seed_n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, seed, times together, times expected of independent words) of a batch of ``cooccurrence``."""
    near = batch.column("near")
    flat = near.flatten()
    row = np.repeat(np.arange(batch.num_rows), near.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    s, n = flat.field("s").to_numpy(zero_copy_only=False).astype(np.int64), flat.field("n").to_numpy(zero_copy_only=False)
    return row, s, n, seed_n[s] * batch.column("n").to_numpy(zero_copy_only=False)[row] / max(total, 1.0)


def _edges(batch: pa.RecordBatch, total: float, seed_n: np.ndarray, usual: np.ndarray, support: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, seed, positive PMI beyond the seed's usual one); pairs that chance explains are left out."""
    row, s, n, expected = _pairs(batch, total, seed_n)
    expected = expected * np.exp(usual[s])
    ok = (n >= support - TINY) & (n >= expected + CHANCE * np.sqrt(expected + 1))
    return row[ok], s[ok], np.log(n[ok] / expected[ok])


def _usual(total: float, seed_n: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(seed_n)))
        for batch in batches:
            _, s, n, expected = _pairs(batch, total, seed_n)
            np.add.at(sums[0], s, n * np.log(n / expected))
            np.add.at(sums[1], s, n)
        yield pa.RecordBatch.from_arrays([pa.array([sums[0].tobytes()]), pa.array([sums[1].tobytes()])], ["k", "r"])

    return lean(run)


def _gram(total: float, seed_n: np.ndarray, usual: np.ndarray, support: float):
    size = len(seed_n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, r = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            row, s, a = _edges(batch, total, seed_n, usual, support)
            np.add.at(r, s, a)
            some, at = np.unique(row, return_inverse=True)
            for i in range(0, len(some), 256):
                own = (at >= i) & (at < i + 256)
                dense = np.zeros((min(256, len(some) - i), size))
                dense[at[own] - i, s[own]] = a[own]
                k += dense.T @ (dense / dense.sum(axis=1, keepdims=True))
        yield pa.RecordBatch.from_arrays([pa.array([k.tobytes()]), pa.array([r.tobytes()])], ["k", "r"])

    return lean(run)


@lean
def _sum_gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    k = r = None
    for batch in batches:
        for a, b in zip(batch.column(0), batch.column(1)):
            x, y = np.frombuffer(a.as_py()), np.frombuffer(b.as_py())
            k, r = (x.copy(), y.copy()) if k is None else (k + x, r + y)
    if k is not None:
        yield pa.RecordBatch.from_arrays([pa.array([k.tobytes()]), pa.array([r.tobytes()])], ["k", "r"])


def _step(total: float, seed_n: np.ndarray, usual: np.ndarray, support: float, p: np.ndarray, rows: np.ndarray):
    """Where a step seed - word - seed from ``p`` leads, as a sum over words."""
    per = np.divide(p, rows, out=np.zeros_like(p), where=rows > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = np.zeros(len(p))
        for batch in batches:
            row, s, a = _edges(batch, total, seed_n, usual, support)
            n = batch.num_rows
            share = np.divide(np.bincount(row, a * per[s], n), np.bincount(row, a, n), out=np.zeros(n), where=np.bincount(row, minlength=n) > 0)
            np.add.at(k, s, a * share[row])
        yield pa.RecordBatch.from_arrays([pa.array([k.tobytes()]), pa.array([k.tobytes()])], ["k", "r"])

    return lean(run)


def _degrees(total: float, seed_n: np.ndarray, usual: np.ndarray, support: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros(len(seed_n))
        for batch in batches:
            _, s, a = _edges(batch, total, seed_n, usual, support)
            np.add.at(r, s, a)
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()]), pa.array([r.tobytes()])], ["k", "r"])

    return lean(run)


def _visits(total: float, seed_n: np.ndarray, usual: np.ndarray, support: float, bad: np.ndarray, good: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, s, a = _edges(batch, total, seed_n, usual, support)
            p = np.bincount(row, a * bad[s], batch.num_rows).astype(float)
            q = np.bincount(row, a * good[s], batch.num_rows).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column("w"), pa.array(p), pa.array(q)], ["w", "p", "q"])

    return lean(run)


def walk(gram: np.ndarray, rows: np.ndarray, start: np.ndarray, restart: float = RESTART) -> np.ndarray:
    """Where a walk from ``start`` over seed - word - seed steps stands in the long run, when each step restarts with that probability."""
    step = np.divide(gram, rows[:, None], out=np.zeros_like(gram), where=rows[:, None] > 0)
    return settle(lambda p: p @ step, start, restart)


def settle(step, start: np.ndarray, restart: float = RESTART) -> np.ndarray:
    p = start.copy()
    for _ in range(1000):
        new = (1 - restart) * step(p) + restart * start
        new /= max(new.sum(), 1e-300)
        if np.abs(new - p).sum() < 1e-12:
            break
        p = new
    return p


def _scores(lexicon_terms: np.ndarray, weights: np.ndarray, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score, number of lexicon terms) of each text."""
    n = len(offs) - 1
    row, h = words(data, offs)
    if not len(lexicon_terms) or not len(row):
        return np.zeros(n), np.zeros(n, np.int64)
    at = np.minimum(np.searchsorted(lexicon_terms, h), len(lexicon_terms) - 1)
    hit = lexicon_terms[at] == h
    r, k = distinct_pairs(row[hit], at[hit])
    return np.bincount(r, weights[k], n).astype(float), np.bincount(r, minlength=n)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, threshold = shared.value
        for batch in batches:
            for i, j, data, offs in tv.slices(batch.column("text")):
                score, n = _scores(terms, weights, data, offs)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(score), pa.array(n), pa.array(score >= threshold)], ["doc_id", "score", "n_terms", "toxic"])

    return lean(run)


def best_threshold(scores: np.ndarray, toxic: np.ndarray) -> float:
    """Between the two scores where labels are told apart with the greatest F1 value; infinite without toxic labels."""
    if not toxic.any():
        return float("inf")
    order = np.argsort(-scores, kind="stable")
    s, t = scores[order], toxic[order].astype(float)
    hit = np.cumsum(t)
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + t.sum())
    edge = np.append(s[1:] < s[:-1], True) & (s > 0)
    if not edge.any():
        return float("inf")
    k = int(np.argmax(np.where(edge, f1, -1)))
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0.0)) / 2)


def induce(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, chunk: int = CHUNK, support: float = MIN_SUPPORT, least: float = POLARITY, limit: int = LEXICON_BYTES, gram_seeds: int = GRAM_SEEDS, copies_limit: int = COPIES_BYTES) -> Lexicon:
    """The lexicon that ``docs`` and ``labels`` give.

    Seeds come from labelled documents (at most ``max_labels``). Over all documents, positive PMI between
    a seed and any word of the same chunk (of ``chunk`` words; see ``cooccurrence`` for copies) makes the edges of a graph; the PMI that a seed has with
    its company on the average (as words of one language have) is taken off first. Walks with restart go
    from the toxic and from the clean seeds, and a word's polarity compares how often they come by.
    The toxic seeds themselves have polarity 1.
    """
    require(docs, "doc_id", "text")
    require(labels, "doc_id", "toxic")
    sample = labelled(docs, labels, max_labels)
    bad, good = seed_terms(sample)
    none = Lexicon(np.zeros(0, np.int64), np.zeros(0), float("inf"))
    if not len(bad):
        return none
    all_seeds = np.concatenate([bad, good])
    graph = cut(cooccurrence(docs, all_seeds, chunk, copies_limit))
    total = float(graph.where("w = 0").agg(F.sum("total").alias("t")).first()["t"] or 0)
    listed = docs.sparkSession.createDataFrame([(int(w),) for w in np.unique(all_seeds)], "w long")
    n_of = {r["w"]: r["own"] for r in graph.join(F.broadcast(listed), "w").select("w", "own").collect()}  # as many rows as seeds
    seed_n = np.array([n_of.get(int(s), 0) for s in all_seeds], float)
    linked = graph.where("size(near) > 0")
    near = linked.select("w", "n", "near")

    tasks = max(1, docs.sparkSession.sparkContext.defaultParallelism)

    def added(f) -> tuple[np.ndarray, np.ndarray]:
        """Sums by tasks, by groups of tasks, and of all: as many parts as tasks run at a time, whatever the size of the graph."""
        parts = near.coalesce(tasks).mapInArrow(f, "k binary, r binary").repartition(max(1, round(tasks**0.5)))
        got = parts.mapInArrow(_sum_gram, "k binary, r binary").repartition(1).mapInArrow(_sum_gram, "k binary, r binary").first()
        return (np.frombuffer(got["k"]), np.frombuffer(got["r"])) if got else (np.zeros(0), np.zeros(0))

    weighted, times = added(_usual(total, seed_n))
    if not times.any():
        return none
    usual = np.divide(weighted, times, out=np.zeros_like(times), where=times > 0)
    if len(all_seeds) <= gram_seeds:
        gram, rows = added(_gram(total, seed_n, usual, support))
        gram = gram.reshape(len(all_seeds), -1)
    else:
        gram, rows = None, added(_degrees(total, seed_n, usual, support))[0]
    start = np.zeros((2, len(all_seeds)))
    start[0, : len(bad)] = 1 / len(bad)
    start[1, len(bad) :] = 1 / max(1, len(good))
    if gram is not None:
        p, q = (walk(gram, rows, x) for x in start)
    else:
        p, q = (settle(lambda v: added(_step(total, seed_n, usual, support, v, rows))[0], x) for x in start)
    per = np.divide(np.vstack([p, q]), rows, out=np.zeros((2, len(rows))), where=rows > 0)
    visits = cut(near.mapInArrow(_visits(total, seed_n, usual, support, per[0], per[1]), "w long, p double, q double").where("p + q > 0"))
    base = visits.agg(F.percentile_approx(F.col("p") + F.col("q"), 0.5).alias("b")).first()["b"] or 0.0
    table = visits.select("w", ((F.col("p") - F.col("q")) / (F.col("p") + F.col("q") + base)).alias("weight")).where(F.col("weight") >= least)
    known = docs.sparkSession.createDataFrame([(int(w), 1.0) for w in bad], "w long, weight double")
    table = cut(table.join(F.broadcast(known), "w", "left_anti").unionByName(known))
    n = table.count()
    if 16 * n > limit:
        return Lexicon(none.terms, none.weights, _joined_threshold(sample, table), table)
    got = table.orderBy("w").toPandas()
    terms, weights = got.w.to_numpy(np.int64), got.weight.to_numpy(float)
    found = sample.select("toxic", F.expr("words")).mapInArrow(_sample_scores(terms, weights), "score double, toxic int").toPandas()
    return Lexicon(terms, weights, best_threshold(found.score.to_numpy(), found.toxic.to_numpy() > 0))


def _sample_scores(terms: np.ndarray, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("words")
            row = np.repeat(np.arange(batch.num_rows), col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            h = col.flatten().to_numpy(zero_copy_only=False)
            score = np.zeros(batch.num_rows)
            if len(terms) and len(h):
                at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
                hit = terms[at] == h
                score = np.bincount(row[hit], weights[at[hit]], batch.num_rows).astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(score), batch.column("toxic")], ["score", "toxic"])

    return lean(run)


def _joined_threshold(sample: DataFrame, table: DataFrame) -> float:
    scored = sample.select("nk", "toxic", F.explode("words").alias("w")).join(table, "w").groupBy("nk").agg(F.sum("weight").alias("score"))
    found = sample.select("nk", "toxic").join(scored, "nk", "left").select(F.coalesce("score", F.lit(0.0)).alias("score"), "toxic").toPandas()
    return best_threshold(found.score.to_numpy(), found.toxic.to_numpy() > 0)


@lean
def _doc_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offs in tv.slices(batch.column("text")):
            row, h = distinct_pairs(*words(data, offs))
            yield pa.RecordBatch.from_arrays([batch.column("nk").slice(i, j - i).take(pa.array(row)), pa.array(h)], ["nk", "w"])


def _joined_scores(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(nk, score, n_terms) by a join, for lexicons too large to send."""
    text = docs.select(row_key().alias("nk"), F.lower("text").alias("text")).where("text IS NOT NULL").mapInArrow(_doc_words, "nk long, w long").distinct()
    return text.join(table, "w").groupBy("nk").agg(F.sum("weight").alias("score"), F.count("*").alias("n_terms"))


def score_documents(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """(doc_id, score, n_terms, toxic) of each row of ``docs``.

    The score is the sum of the polarities of the distinct lexicon terms in the text (see ``induce``);
    from the threshold fitted on labelled documents a text is toxic.

    A null, empty or wordless text scores 0 and isn't toxic; a null doc_id stays null. Texts of any length are
    read whole. Repeated rows score alike. Labels without id or value are ignored; of several for one id the
    greatest counts. Without documents the result is empty; without toxic and clean labels, or if
    no term stands out, every score is 0 and nothing is toxic. Other columns are ignored.
    """
    lexicon = induce(docs, labels, **how)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    if lexicon.table is not None:
        scored = _joined_scores(docs, lexicon.table)
        all_rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("nk")).join(scored, "nk", "left")
        score = F.coalesce("score", F.lit(0.0))
        return all_rows.select("doc_id", score.alias("score"), F.coalesce("n_terms", F.lit(0)).cast("long").alias("n_terms"), (score >= lexicon.threshold).alias("toxic"))
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.terms, lexicon.weights, lexicon.threshold))
    return slim.mapInArrow(_score(shared), "doc_id long, score double, n_terms long, toxic boolean")


def _keep_clean(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, threshold = shared.value
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for i, j, data, offs in tv.slices(batch.column(batch.num_columns - 1)):
                keep[i:j] = _scores(terms, weights, data, offs)[0] < threshold
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(keep))

    return lean(run)


def without_toxic(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``docs`` without the toxic ones; all columns of the others stay. Cases are defined as in ``score_documents``."""
    lexicon = induce(docs, labels, **how)
    if lexicon.table is not None:
        bad = _joined_scores(docs, lexicon.table).where(F.col("score") >= lexicon.threshold).select(F.col("nk").alias("f_nk"))
        (nk,) = fresh(docs, "f_nk")
        return docs.withColumn(nk, row_key()).join(bad.withColumnRenamed("f_nk", nk), nk, "left_anti").select(*every(docs))
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.terms, lexicon.weights, lexicon.threshold))
    return mapped_rows(docs, _keep_clean(shared), F.lower("text"))
