"""Secret scan: values in credential context, judged by the least number of guesses that would find them."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm import textvec as tv
from frameloom.llm.common import cut, join_counted, lean, require

#: What names a credential. A name may have more before and after it ("db_password_2").
KEYWORDS = re.compile(r"(?ai)password|passwd|passphrase|passcode|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth[_-]?key|credentials?|bearer")
#: One of these stands in every name above.
_CORES = (b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"bearer")
#: A whole name, what stands between, and a value. Possessive, so that time follows the length of the text.
ASSIGNED = re.compile(r"(?ai)(?<![a-z0-9_-])([a-z0-9_-]++)[\"']?[ \t]*+(?:=>|:=|[=:])[ \t]*+(?:\"([^\"\r\n]{4,})\"|'([^'\r\n]{4,})'|([^ \t\r\n\"'<>,;]{4,}))")
#: A bearer token, as it stands in headers.
BEARER = re.compile(r"(?ai)(?<![a-z0-9_-])(bearer)[ \t]++([a-z0-9_.~+/=-]{16,})")
#: Bits of guesses from which a value is a secret and not a placeholder.
MIN_BITS = 40.0
#: Bits that each further segment costs: where it begins and of which kind it is.
SEGMENT_BITS = 2.0
MIN_WORD = 3
#: Letters by which a longer word is looked up.
LONG_WORD = 24
#: Bytes of candidate words that are sent to every executor; more are joined.
WORDS_BYTES = 32 << 20

#: Passwords that everybody tries, the first first.
USUAL = (
    "123456 password 12345678 qwerty 123456789 12345 1234 111111 1234567 dragon 123123 baseball abc123 football monkey letmein shadow master 666666 "
    "qwertyuiop 123321 mustang 1234567890 michael 654321 superman 1qaz2wsx 7777777 121212 000000 qazwsx 123qwe killer trustno1 jordan jennifer zxcvbnm asdfgh "
    "hunter buster soccer harley batman andrew tigger sunshine iloveyou 2000 charlie robert thomas hockey ranger daniel starwars klaster 112233 george "
    "computer michelle jessica pepper 1111 zxcvbn 555555 11111111 131313 freedom 777777 pass maggie 159753 aaaaaa ginger princess joshua cheese amanda summer "
    "love ashley nicole chelsea biteme matthew access yankees 987654321 dallas austin thunder taylor matrix admin root test guest changeme welcome secret "
    "example sample placeholder default user login token key demo dummy your"
).split()
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_SHIFT = dict(zip("~!@#$%^&*()_+{}|:\"<>?", "`1234567890-=[]\\;',./"))


def _keyboard() -> dict[str, set[str]]:
    at = {c: (y, x + 0.5 * y) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
    return {c: {d for d, (v, u) in at.items() if d != c and abs(v - y) <= 1 and abs(u - x) <= 1} for c, (y, x) in at.items()}


NEAR = _keyboard()
_STARTS = math.log2(len(NEAR))
_TURNS = math.log2(sum(map(len, NEAR.values())) / len(NEAR))
#: Days of 1900 to 2099, and ways to write one.
_DATE_BITS = math.log2(200 * 366 * 4)
_YEAR_BITS = math.log2(200)
_DATE = re.compile(r"(?=(?:(19|20)\d\d([-/._]?)(0[1-9]|1[0-2])\2(0[1-9]|[12]\d|3[01])|(0[1-9]|[12]\d|3[01])([-/._]?)(0[1-9]|1[0-2])\6(?:19|20)\d\d))")
_YEAR = re.compile(r"(?=(19|20)\d\d)")
Segment = tuple[int, int, str, float]


def char_bits(c: str) -> float:
    """Bits of one character in a brute-force span: of the class it belongs to."""
    if c.isascii():
        return math.log2(10 if c.isdigit() else 26 if c.isalpha() else 33)
    return math.log2(1 << 12)


def case_bits(word: str) -> float:
    """Bits of the pattern of capitals in a word."""
    if word == word.lower():
        return 0.0
    if word == word.upper() or (word[:1] != word[:1].lower() and word[1:] == word[1:].lower()):
        return 1.0
    n, k = len(word), sum(c != c.lower() for c in word)
    return math.log2(sum(math.comb(n, j) for j in range(1, min(k, n - k) + 1)) or 1) + 1


def lower(value: str) -> str:
    """Small letters, as many as characters."""
    small = value.lower()
    return small if len(small) == len(value) else "".join(c.lower() if len(c.lower()) == 1 else c for c in value)


def fixed_segments(value: str, words: Mapping[str, float]) -> Iterator[Segment]:
    """(start, end, kind, bits) of the words and dates in a value."""
    n, small = len(value), lower(value)
    longest = max(map(len, words), default=0)
    for i in range(n):
        for j in range(i + MIN_WORD, min(n, i + longest) + 1):
            bits = words.get(small[i:j])
            if bits is not None:
                yield i, j, "word", bits + case_bits(value[i:j])
    for m in _DATE.finditer(value):
        size = 8 + 2 * len(m[2] or m[6] or "")
        yield m.start(), m.start() + size, "date", _DATE_BITS
    for m in _YEAR.finditer(value):
        yield m.start(), m.start() + 4, "date", _YEAR_BITS


class Walks:
    """Keyboard walks of at least three keys: where one begins, its turns and how many capitals it has cost bits."""

    def __init__(self, value: str) -> None:
        n, keys = len(value), [_SHIFT.get(c, c.lower()) for c in value]
        near = [k > 0 and keys[k] in NEAR.get(keys[k - 1], ()) for k in range(n)]
        step = [ord(keys[k]) - ord(keys[k - 1]) if near[k] else None for k in range(n)]
        self.since = list(range(n + 1))  # for each end, where the walk to it may begin at the earliest
        for k in range(n):
            self.since[k + 1] = self.since[k] if near[k] else k
        self.turns = np.concatenate([[0], np.cumsum([bool(near[k] and step[k] != step[k - 1]) for k in range(n)])]).astype(float)
        self.shifted = np.concatenate([[0], np.cumsum([c in _SHIFT or c != c.lower() for c in value])]).astype(float)

    def to(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and bits of all walks that end at ``j``."""
        starts = np.arange(self.since[j], j - 2) if j - self.since[j] >= 3 else np.zeros(0, np.int64)
        size, shifted = j - starts, self.shifted[j] - self.shifted[starts]
        turns = 1 + self.turns[j] - self.turns[np.minimum(starts + 2, j)]  # the first step counts as one
        return starts, _STARTS + np.log2(size) + turns * _TURNS + np.minimum(shifted, size - shifted + 1)


def repeats(value: str) -> list[tuple[int, int, int]]:
    """(start, end, unit) of the maximal stretches in which each character equals the one ``unit`` before; no unit is a repeat itself.

    Each has at least two units, or three of one character.
    """
    n, whole, found = len(value), np.array([ord(c) for c in value], np.int64), []
    seen: set[tuple[int, int]] = set()
    for unit in range(1, n // 2 + 1):
        same = np.concatenate([[False], whole[unit:] == whole[:-unit], [False]])
        flips = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(flips[::2].tolist(), flips[1::2].tolist()):
            if b - a >= unit * (2 if unit == 1 else 1) and not any(x <= a and b + unit <= y and unit % u == 0 for x, y, u in found if y - x >= 2 * u):
                found.append((a, b + unit, unit))
    return found


def guess_bits(value: str, words: Mapping[str, float], memo: dict[str, float] | None = None) -> tuple[float, list[tuple[str, str]]]:
    """The least bits of a segmentation, and its (kind, text) parts.

    A value is cut into words, dates, keyboard walks, repeats of a unit and brute-force spans. Its cost is the sum of
    theirs and ``SEGMENT_BITS`` for each segment after the first. A repeat costs the best segmentation of its
    unit, which is no repeat itself, and the logarithm of the number of times, of which any from two (three for one character) may be
    taken. The best segmentation of each prefix is kept; for each end all starts of a walk or repeat are
    weighed at once, as arrays.
    """
    n = len(value)
    if not n:
        return 0.0, []
    memo = {} if memo is None else memo
    ends: dict[int, list[tuple[int, str, float]]] = {}
    for i, j, kind, bits in fixed_segments(value, words):
        ends.setdefault(j, []).append((i, kind, bits))
    walks, stretches = Walks(value), repeats(value)
    open_at: dict[int, list[tuple[int, int, int]]] = {}
    for a, b, unit in stretches:
        for j in range(a + unit * (3 if unit == 1 else 2), b + 1):
            open_at.setdefault(j, []).append((a, b, unit))

    def unit_bits(text: str) -> float:
        if text not in memo:
            memo[text] = char_bits(text) if len(text) == 1 else guess_bits(text, words, memo)[0]
        return memo[text]

    best, brute = np.full(n + 1, math.inf), [math.inf] * (n + 1)
    best[0] = 0.0
    back: list[tuple[int, str]] = [(0, "")] * (n + 1)
    since = [0] * (n + 1)
    done = [0.0] + [math.inf] * n
    more = np.full(n + 1, SEGMENT_BITS)
    more[0] = 0.0
    for j in range(1, n + 1):
        one = char_bits(value[j - 1])
        fresh = done[j - 1] + (SEGMENT_BITS if j > 1 else 0.0) + one
        longer = brute[j - 1] + one
        brute[j], since[j] = (longer, since[j - 1]) if longer <= fresh else (fresh, j - 1)
        options = [(best[i] + bits + more[i], i, kind) for i, kind, bits in ends.get(j, ())]
        starts, bits = walks.to(j)
        if len(starts):
            cost = best[starts] + bits + more[starts]
            k = int(np.argmin(cost))
            options.append((cost[k], int(starts[k]), "walk"))
        for a, _, unit in open_at.get(j, ()):
            times = np.arange(3 if unit == 1 else 2, (j - a) // unit + 1)
            starts = j - unit * times
            cost = best[starts] + np.log2(times) + more[starts]
            k = int(np.argmin(cost))
            options.append((cost[k] + unit_bits(value[j - unit : j]), int(starts[k]), "repeat"))
        for cost, i, kind in options:
            if cost < done[j]:
                done[j], back[j] = float(cost), (i, kind)
        best[j] = min(done[j], brute[j])
    parts, j, after = [], n, False
    while j:
        if brute[j] < done[j] and not after:
            i, kind = since[j], "brute"
        else:
            i, kind = back[j]
        parts.append((kind, value[i:j]))
        after = kind == "brute"  # what stands before a brute-force span isn't one
        j = i
    return float(best[n]), parts[::-1]


def find(text: str) -> list[tuple[int, int, int, int, str]]:
    """(start and end of the match, start and end of the value, keyword) of the values in credential context, in order."""
    found = []
    for m in ASSIGNED.finditer(text):
        name = KEYWORDS.search(m[1])
        if name:
            k = 2 if m[2] is not None else 3 if m[3] is not None else 4
            found.append((m.start(), m.end(), m.start(k), m.end(k), name[0].lower()))
    taken = {f[2] for f in found}
    found += [(m.start(), m.end(), m.start(2), m.end(2), "bearer") for m in BEARER.finditer(text) if m.start(2) not in taken]
    return sorted(found)


def _maybe(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows of a slice in which the core of a keyword stands."""
    small, at = data.tobytes().lower(), []
    for core in _CORES:
        k = small.find(core)
        while k >= 0:
            row = int(np.searchsorted(offs, k, "right")) - 1
            at.append(row)
            k = small.find(core, int(offs[row + 1]) - len(core) + 1 if row + 1 < len(offs) else len(small))
    return np.unique(np.array(at, np.int64))


FOUND = "doc_id long, start long, end long, keyword string, value string"


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i, _, data, offs in tv.slices(batch.column("text")):
            for r in _maybe(data, offs).tolist():
                text = data[offs[r] : offs[r + 1]].tobytes().decode("utf-8", "replace")
                doc = batch.column("doc_id")[i + r].as_py()
                rows += [(doc, a, b, keyword, text[a:b]) for _, _, a, b, keyword in find(text)]
        cols = list(zip(*rows)) or [[]] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "start", "end", "keyword", "value"])


def _letters(value: str) -> list[str]:
    """Runs of letters, in small ones."""
    return "".join(c if c.isalpha() else " " for c in lower(value)).split()


def candidate_words(value: str) -> set[str]:
    """Parts of its letters that may be words of up to ``LONG_WORD`` bytes."""
    found = set()
    for run in _letters(value):
        for i in range(len(run)):
            for j in range(i + MIN_WORD, min(len(run), i + LONG_WORD) + 1):
                if len(run[i:j].encode()) > LONG_WORD:
                    break
                found.add(run[i:j])
    return found


def long_beginnings(value: str) -> set[bytes]:
    """First ``LONG_WORD`` bytes of what may be longer words in it."""
    found = set()
    for run in _letters(value):
        for i in range(len(run)):
            raw = run[i : i + LONG_WORD + 1].encode()
            if len(raw) > LONG_WORD:
                found.add(raw[:LONG_WORD])
    return found


def _hashes(raw: list[bytes]) -> np.ndarray:
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return tv.span_hashes(np.frombuffer(b"".join(raw), np.uint8), offs[:-1], offs[1:], fold=True).view(np.int64)


def _value_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, word, h) of candidate words, and of the beginnings of long ones with a null word."""
    for batch in batches:
        for value in batch.column("value").to_pylist():
            short, long = sorted(candidate_words(value)), sorted(long_beginnings(value))
            if short or long:
                h = _hashes([*(w.encode() for w in short), *long])
                yield pa.RecordBatch.from_arrays([pa.array([value] * len(h)), pa.array([*short, *([None] * len(long))], pa.string()), pa.array(h)], ["value", "word", "h"])


def _count(wanted):
    """Rows (h, word, n) outside of values: of wanted words (all without a list), of long words that begin as wanted, and (0, null, all words)."""

    def known(some: np.ndarray, h: np.ndarray) -> np.ndarray:
        return some[np.minimum(np.searchsorted(some, h), len(some) - 1)] == h if len(some) else np.zeros(len(h), bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = wanted.value if wanted is not None else None
        total, sums = 0, np.zeros(0 if some is None else len(some), np.int64)
        for batch in batches:
            for _, _, data, offs in tv.slices(batch.column("text")):
                data = data.copy()
                for r in _maybe(data, offs).tolist():
                    raw = data[offs[r] : offs[r + 1]]
                    text = raw.tobytes().decode("utf-8", "replace")
                    spans = find(text)
                    if spans:
                        byte = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
                        for a, b, *_ in spans:
                            raw[byte[a] : byte[b]] = 32
                _, start, end = tv.spans(data, offs, tv.WORD_BYTE)
                if not len(start):
                    continue
                total += len(start)
                h = tv.span_hashes(data, start, end, fold=True).view(np.int64)
                long = np.flatnonzero(end - start > LONG_WORD)
                if len(long):
                    first = tv.span_hashes(data, start[long], start[long] + LONG_WORD, fold=True).view(np.int64)
                    if some is not None:
                        own = known(some, first)
                        long, first = long[own], first[own]
                    text = [data[a:b].tobytes().decode("utf-8", "replace").lower() for a, b in zip(start[long].tolist(), end[long].tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(text, pa.string()), pa.array(np.ones(len(long), np.int64))], ["h", "word", "n"])
                if some is None:
                    u, n = np.unique(h, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.nulls(len(u), pa.string()), pa.array(n.astype(np.int64))], ["h", "word", "n"])
                elif len(some):
                    own = known(some, h)
                    sums += np.bincount(np.searchsorted(some, h[own]), minlength=len(some))
        own = np.flatnonzero(sums)
        h = np.append(some[own] if len(own) else np.zeros(0, np.int64), 0)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.nulls(len(h), pa.string()), pa.array(np.append(sums[own], total))], ["h", "word", "n"])

    return lean(run)


def word_bits(docs: DataFrame, values: DataFrame, limit: int = WORDS_BYTES) -> DataFrame:
    """(value, words): for each value the words it holds, with the logarithm of all words of the corpus over those equal to each.

    Every document counts, without the values themselves, else a leaked password in many copies would be a usual word.
    """
    spark = docs.sparkSession
    held = cut(values.mapInArrow(lean(_value_words), "value string, word string, h long"))
    wanted = held.select("h").distinct()
    shared = None
    if 8 * wanted.count() <= limit:
        shared = spark.sparkContext.broadcast(np.sort(wanted.toPandas().h.to_numpy(np.int64)))
    counted = docs.where("text IS NOT NULL").mapInArrow(_count(shared), "h long, word string, n long")
    counted = cut(counted.groupBy("h", "word").agg(F.sum("n").alias("n")))
    total = counted.where("h = 0").select(F.col("n").alias("total"))
    short = held.where("word IS NOT NULL").join(counted.where("h <> 0 AND word IS NULL").select("h", "n"), "h")
    long = held.where("word IS NULL").select("value", "h").join(counted.where("word IS NOT NULL"), "h").where(F.lower("value").contains(F.col("word")))
    both = short.select("value", "word", "n").unionByName(long.select("value", "word", "n")).crossJoin(F.broadcast(total))  # one row
    return both.groupBy("value").agg(F.collect_list(F.struct("word", F.log2(F.col("total") / F.col("n")).alias("bits"))).alias("words"))


def judge(value: str, known: Mapping[str, float]) -> tuple[float, str]:
    words = dict(known)
    for k, w in enumerate(USUAL):
        words[w] = min(words.get(w, math.inf), math.log2(k + 2))
    bits, parts = guess_bits(value, words)
    return bits, "|".join(k for k, _ in parts)


def _judge(min_bits: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        usual = {w: math.log2(k + 2) for k, w in enumerate(USUAL)}
        for batch in batches:
            bits, kinds = [], []
            for value, words in zip(batch.column("value").to_pylist(), batch.column("words").to_pylist()):
                own = {w["word"]: w["bits"] for w in words or ()}
                own |= {w: min(b, own.get(w, math.inf)) for w, b in usual.items()}
                b, parts = guess_bits(value, own)
                bits.append(b)
                kinds.append("|".join(k for k, _ in parts))
            yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(bits, pa.float64()), pa.array(kinds, pa.string()), pa.array([b >= min_bits for b in bits])], ["value", "bits", "segments", "secret"])

    return lean(run)


def scan(docs: DataFrame, min_bits: float = MIN_BITS, limit: int = WORDS_BYTES) -> DataFrame:
    """(doc_id, start, end, keyword, value, bits, segments, secret) of each value that stands in credential context.

    A value follows the name of a credential and "=", ":", ":=" or "=>", or is a token after "Bearer"; ``start`` and ``end``
    are its characters in the text. Names are ASCII without regard to case. ``bits`` is the logarithm of the guesses that the
    cheapest segmentation needs (see ``guess_bits``), ``segments`` names its parts, and from ``min_bits`` the value is a
    ``secret``. Words are the usual passwords and those of the corpus, at the cost of their frequency in all documents.

    Null, empty and other texts without such context give no rows; a null doc_id is reported as null, repeated rows
    report each their own. Ids are whole numbers. Texts and values of any length are read whole; time follows the length of a
    text, and the square of that of a value that is one walk or repeat. An empty table gives an empty result;
    other columns are ignored. Texts are read twice, to find values and to count words; each distinct value is judged once.
    """
    require(docs, "doc_id", "text")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    found = cut(slim.mapInArrow(lean(_candidates), FOUND))
    values = found.select("value").distinct()
    priced = word_bits(docs.select("text"), values, limit).withColumnRenamed("value", "of")
    judged = values.join(priced, F.col("value") == F.col("of"), "left").select("value", "words").mapInArrow(_judge(min_bits), "value string, bits double, segments string, secret boolean")
    counts = found.groupBy("value").agg(F.count("*").alias("n"))
    return join_counted(found, cut(judged.join(counts, "value")), "value").select("doc_id", "start", "end", "keyword", "value", "bits", "segments", "secret")
