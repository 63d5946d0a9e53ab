"""Benchmark decontamination: one Aho-Corasick automaton of normalised test items, over each text once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm import textvec as tv
from frameloom.llm.common import lean, mapped_rows, require

WINDOW = 13
MIN_WORDS = 8
#: Words around a passage of an item in which its short texts (answers) count.
BESIDE = 50
#: Bytes of an automaton for each byte of pattern, as measured (32 a node and 8 a link), and of its texts.
NODE_BYTES = 42
#: Bytes of an automaton, at most. Larger benchmarks are spread over several, by item.
AUTOMATON_BYTES = 256 << 20

HITS = "doc_id long, item_id long, start long, end long, n_words int, text string"
#: First bytes of characters of scripts that put no space between words: most of U+3040-U+9FFF and U+F900-U+FAFF.
_UNSPACED = np.zeros(256, bool)
_UNSPACED[0xE3:0xEA] = True
_built: dict[str, Machine] = {}

Span = tuple[int, int, int]


class Normal:
    """Normal forms of texts, and where each of their bytes (before lower-casing) comes from.

    Runs of anything but letters and digits (ASCII and general punctuation, symbols and white space) become one space,
    with one before and after the text; capitals become small letters. Characters of scripts without spaces
    (Chinese, Japanese) are a word each.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray) -> None:
        word = tv.WORD_BYTE[data]
        if len(data) > 2:
            for lead, second, wide in ((0xE2, (0x80, 0x81), 3), (0xE3, (0x80, 0x80), 3), (0xC2, (0x80, 0xBF), 2)):
                at = np.flatnonzero((data[:-1] == lead) & (data[1:] >= second[0]) & (data[1:] <= second[1]))
                for k in range(wide):
                    word[np.minimum(at + k, len(data) - 1)] = False
        before = np.ones(len(data), bool)
        before[1:] = word[:-1]
        at = offs[:-1][offs[:-1] < len(data)]
        before[at] = True
        keep = word | before
        flat = np.where(word, data, np.uint8(32))
        self.texts: list[str] = []
        self.raws: list[np.ndarray] = []
        self.origins: list[np.ndarray] = []
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
            k = np.flatnonzero(keep[a:b])
            if len(k) and not word[a + k[0]]:
                k = k[1:]
            if len(k) and not word[a + k[-1]]:
                k = k[:-1]
            raw = flat[a:b][k]
            alone = _UNSPACED[raw]
            if alone.any():
                lead = (raw & 0xC0) != 0x80
                start = np.flatnonzero(lead)
                own = alone[start]
                split = np.flatnonzero((own[1:] | own[:-1]) & (raw[start[1:]] != 32) & (raw[start[:-1]] != 32)) + 1
                raw, k = np.insert(raw, start[split], 32), np.insert(k, start[split], k[start[split]])
            self.texts.append(" " + raw.tobytes().decode("utf-8", "replace").lower() + " ")
            self.raws.append(raw)
            self.origins.append(k)

    def original(self, k: int, data: np.ndarray, a: int, b: int) -> tuple[int, int]:
        """Characters of the ``k``-th original, of bytes ``data``, for characters a to b of its normal form."""
        raw, origin = self.raws[k], self.origins[k]
        first = np.flatnonzero((raw & 0xC0) != 0x80)
        if len(first) != len(self.texts[k]) - 2:  # lower-casing changed the number of characters
            kept = raw.tobytes().decode("utf-8", "replace")
            first = first[np.repeat(np.arange(len(kept)), [len(c.lower()) for c in kept])]
        chars = tv.char_index(data)
        last = len(first) - 1
        return int(chars[origin[first[min(a - 1, last)]]]), int(chars[origin[first[min(b - 2, last)]]]) + 1


def normal_text(text: str) -> str:
    data = np.frombuffer(text.encode(), np.uint8)
    return Normal(data, np.array([0, len(data)])).texts[0]


def equal_before(x: str, i: int, y: str, j: int) -> int:
    """How many characters before x[i] and y[j] agree."""
    return _equal(lambda n, k: x[i - n - k : i - n] == y[j - n - k : j - n], min(i, j))


def equal_after(x: str, i: int, y: str, j: int) -> int:
    """How many characters from x[i] and y[j] on agree."""
    return _equal(lambda n, k: x[i + n : i + n + k] == y[j + n : j + n + k], min(len(x) - i, len(y) - j))


def _equal(same, most: int) -> int:
    n, k = 0, 64
    while n < most and k:
        k = min(k, most - n)
        if same(n, k):
            n += k
            k *= 2
        else:
            most = n + k - 1  # the next piece differs somewhere
            k //= 2
    return n


class Machine:
    """An automaton of blocks of test items.

    Every run of ``window`` words of an item holds one of its blocks of (window + 1) // 2 words that stand one after
    another; a block found in a text is extended as far as text and item agree, and counts from ``window`` words.
    Items of fewer words are one block, found only whole.
    """

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW, min_words: int = MIN_WORDS) -> None:
        self.auto, self.items, size = ahocorasick.Automaton(), [], (window + 1) // 2
        blocks: dict[str, list[tuple[int, int]]] = {}
        for item, text in dict.fromkeys((i, normal_text(t)) for i, t in items):
            spaces = [p for p, c in enumerate(text) if c == " "]
            n = len(spaces) - 1
            if n < 1 or text == "  ":
                continue
            step = size if n >= window else n
            for w in range(0, n - step + 1, step):
                blocks.setdefault(text[spaces[w] : spaces[w + step] + 1], []).append((len(self.items), spaces[w]))
            self.items.append((item, text, min(n, window), n < min_words))
        for text, places in blocks.items():
            self.auto.add_word(text, (len(text), places))
        if blocks:
            self.auto.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int, bool]]:
        """(item, start, end, whether the item is short) of each maximal run that counts, in characters of the normal form."""
        if not self.items:
            return
        done: dict[tuple[int, int], int] = {}
        for end, (size, places) in self.auto.iter(text):
            a = end - size + 1
            for k, q in places:
                item, other, need, short = self.items[k]
                if done.get((k, a - q), -1) >= end:
                    continue
                low = a - equal_before(text, a, other, q)
                high = end + equal_after(text, end, other, q + size - 1)
                low, high = text.find(" ", low, a + 1), text.rfind(" ", end, high)
                done[k, a - q] = high
                if text.count(" ", low, high) >= need:
                    yield item, low + 1, high, short

    def spans(self, text: str) -> list[Span]:
        """(item, start, end) of passages; runs of an item that meet are one, short texts count beside a passage of their item."""
        found: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        for item, a, b, short in self.matches(text):
            found.setdefault((item, short), []).append((a, b))
        out: dict[int, list[tuple[int, int]]] = {i: own for (i, short), own in found.items() if not short}
        for (item, short), own in found.items():
            if short and item in out:
                out[item] = out[item] + [(a, b) for a, b in own if any(text.count(" ", min(b, d), max(a, c)) <= BESIDE for c, d in out[item])]
        merged = []
        for item, own in out.items():
            last = None
            for a, b in sorted(own):
                if last and a <= last[1] + 1:
                    last[1] = max(last[1], b)
                else:
                    last = [a, b]
                    merged.append((item, last))
        return [(item, a, b) for item, (a, b) in merged]

    def holds(self, text: str) -> bool:
        return any(not short for *_, short in self.matches(text))


def _machine(shared) -> Machine:
    key, items, window, min_words = shared.value
    if key not in _built:
        _built.clear()
        _built[key] = Machine(items, window, min_words)
    return _built[key]


def _hits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(shared)
        for batch in batches:
            rows: list[tuple] = []
            for i, j, data, offs in tv.slices(batch.column("text")):
                normal = Normal(data, offs)
                for k, text in enumerate(normal.texts):
                    found = machine.spans(text)
                    if not found:
                        continue
                    own = data[offs[k] : offs[k + 1]]
                    whole = own.tobytes().decode("utf-8", "replace")
                    doc = batch.column("doc_id")[i + k].as_py()
                    for item, a, b in found:
                        start, end = normal.original(k, own, a, b)
                        rows.append((doc, item, start, end, text[a:b].count(" ") + 1, whole[start:end]))
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()))],
                ["doc_id", "item_id", "start", "end", "n_words", "text"],
            )

    return lean(run)


def _clean(shared, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(shared)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for i, _, data, offs in tv.slices(batch.column(column)):
                for k, text in enumerate(Normal(data, offs).texts):
                    keep[i + k] = not machine.holds(text)
            yield batch.filter(pa.array(keep))

    return lean(run)


def _shares(docs: DataFrame, benchmark: DataFrame, window: int, min_words: int, limit: int) -> list:
    """Broadcast items, in shares of at most some ``limit`` bytes of automaton (one share for all but huge benchmarks).

    An item is never split. Each broadcast has a key of its own, so that no worker mistakes it for another.
    """
    require(benchmark, "item_id", "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item")).where("item_id IS NOT NULL AND item IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("item") + 2).alias("n")).first()["n"] or 0
    parts = max(1, -(-size * NODE_BYTES // limit))
    made = []
    for k in range(parts):
        own = items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k)
        rows = [tuple(r) for r in own.orderBy("item_id", "item").toLocalIterator()]
        made.append(docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, rows, window, min_words)))
    return made


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_words: int = MIN_WORDS, limit: int = AUTOMATON_BYTES) -> DataFrame:
    """(doc_id, item_id, start, end, n_words, text): the passages that documents share with test items.

    A passage is a run of at least ``window`` words in normal form (see ``Normal``) that document and item share, as
    long as both agree; passages of an item that overlap or adjoin are one. ``start`` and ``end`` count characters
    of the original text, which ``text`` quotes. Texts of items with fewer than ``window`` words count whole. Those of
    fewer than ``min_words``, as answers often are, prove nothing alone and count within ``BESIDE`` words of another
    passage of the same item_id, so question and answers may be rows of one item; an item that has only such
    texts is never found.

    Items without id or text are left out; repeated ones count once. Documents without text, or with an empty one, have no
    passages; a null doc_id is reported as null; repeated rows report each their own. Ids are whole numbers.
    Texts of any length are read whole. Empty tables give an empty result; other columns are ignored. The benchmark is
    gathered on the driver in shares of ``limit`` bytes of automaton; each share is a scan of its own, with equal results.
    """
    require(docs, "doc_id", "text")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = [slim.mapInArrow(_hits(s), HITS) for s in _shares(docs, benchmark, window, min_words, limit)]
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out


def without_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_words: int = MIN_WORDS, limit: int = AUTOMATON_BYTES) -> DataFrame:
    """``docs`` without those that hold a passage of a test item; all columns of the others stay, without a shuffle.

    Cases are defined as in ``contamination``; a document with a null or empty text stays.
    """
    require(docs, "text")
    out = docs
    for s in _shares(docs, benchmark, window, min_words, limit):
        out = mapped_rows(out, _clean(s, docs.columns.index("text")))
    return out


_PLAIN = r"0-9A-Za-z\x{C0}-\x{1FFF}\x{2080}-\x{2FFF}\x{A000}-\x{10FFFF}"
_WORD = rf"[\x{{3040}}-\x{{9FFF}}]|[{_PLAIN}]+"
#: DuckDB: contamination() of documents and benchmark.
CONTAMINATION_SQL = rf"""
WITH iw AS (
    SELECT item_id, list_transform(regexp_extract_all(text, '{_WORD}'), lambda x: lower(x)) AS w FROM benchmark WHERE item_id IS NOT NULL
), ig AS (
    SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, unnest(list_transform(range(1, len(w) - least(len(w), {WINDOW}) + 2), lambda i: array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' '))) AS gram
    FROM iw WHERE len(w) >= {MIN_WORDS}
), dw AS (
    SELECT doc_id, text, list_transform(regexp_extract_all(text, '{_WORD}'), lambda x: lower(x)) AS w,
        regexp_extract_all(text, '(?:{_WORD})[^0-9A-Za-z\x{{C0}}-\x{{1FFF}}\x{{2080}}-\x{{2FFF}}\x{{3040}}-\x{{10FFFF}}]*') AS full_w,
        length(regexp_extract(text, '^[^0-9A-Za-z\x{{C0}}-\x{{1FFF}}\x{{2080}}-\x{{2FFF}}\x{{3040}}-\x{{10FFFF}}]*')) AS skip FROM documents
), sizes AS (
    SELECT DISTINCT n FROM ig
), dg AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS gram FROM dw, sizes
), hit AS (
    SELECT DISTINCT doc_id, item_id, p, p + n AS e FROM dg JOIN ig USING (n, gram)
), edge AS (
    SELECT *, CASE WHEN p <= max(e) OVER (PARTITION BY doc_id, item_id ORDER BY p, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM hit
), grouped AS (
    SELECT *, sum(new) OVER (PARTITION BY doc_id, item_id ORDER BY p, e) AS g FROM edge
), span AS (
    SELECT doc_id, item_id, min(p) AS p, max(e) AS e FROM grouped GROUP BY doc_id, item_id, g
), placed AS (
    SELECT s.doc_id, item_id, e - p AS n_words, skip + coalesce(list_sum(list_transform(full_w[1 : p - 1], lambda x: length(x))), 0) AS start,
        skip + coalesce(list_sum(list_transform(full_w[1 : e - 2], lambda x: length(x))), 0) + length(w[e - 1]) AS "end", text
    FROM span s JOIN dw ON s.doc_id = dw.doc_id
)
SELECT doc_id, item_id, start::BIGINT AS start, "end"::BIGINT AS "end", n_words::INTEGER AS n_words, substring(text, start::BIGINT + 1, ("end" - start)::BIGINT) AS text FROM placed
"""
