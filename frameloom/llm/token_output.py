"""Token ids in Simple-8b words: 64-bit words of as many ids as fit, in blocks that decode on their own."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm import textvec as tv
from frameloom.llm.common import lean, require

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK = 128
#: (ids in a word, bits of each) by selector, which stands in the top four bits. Selector 0 is the
#: escape: the word after it is one id of more than 60 bits. 15 isn't used.
SELECTORS = [(1, 64), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
_COUNTS = np.array([n for n, _ in SELECTORS] + [0], np.int64)
_U64 = np.uint64
#: Ids of width class k have at most the bits of the k-th narrowest selector.
_LIMITS = np.array([1 << b for b in sorted({b for _, b in SELECTORS[1:]})], np.uint64)
_WIDTH_CLASS = {b: k for k, b in enumerate(sorted({b for _, b in SELECTORS[1:]}))}


def encode(ids: np.ndarray, sizes: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of consecutive lists of ``sizes`` ids, without a loop over ids.

    Returns (words, first word of each block and the end, blocks of each list,
    words of each list). Each block holds ``block`` ids (the last of a list fewer)
    and begins with a word of its own.
    """
    ids, sizes = ids.astype(_U64, copy=False), sizes.astype(np.int64)
    total = len(ids)
    blocks = -(-sizes // block)
    n_blocks = int(blocks.sum())
    if not n_blocks:
        return np.zeros(0, _U64), np.zeros(1, np.int64), blocks, np.zeros(len(sizes), np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    inner = np.arange(n_blocks) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = np.repeat(starts[:-1], blocks) + inner * block
    end = np.minimum(begin + block, np.repeat(starts[1:], blocks))

    stop = np.repeat(end.astype(np.int32), end - begin)
    here = np.arange(total, dtype=np.int32)
    width_of = np.searchsorted(_LIMITS, ids, "right").astype(np.uint8)
    selector = np.zeros(total, np.int8)
    for s in range(len(SELECTORS) - 1, 0, -1):  # more ids in a word come later and win
        n, bits = SELECTORS[s]
        big = width_of > _WIDTH_CLASS[bits]
        if n == 1:
            selector[~big] = s
            continue
        at = np.flatnonzero(big)
        if len(at) and max(int(at[0]), total - 1 - int(at[-1]), int(np.diff(at).max(initial=1)) - 1) < n:
            continue  # no run of n such ids; what is left at the end of a list is packed with more bits each
        over = np.zeros(total + 1, np.int32)
        np.cumsum(big, out=over[1:])
        fits = over[np.minimum(here + np.int32(n), stop)] == over[:-1]
        selector[fits] = s
    step = np.minimum(_COUNTS[selector], stop - here)

    at, which, firsts, owners = begin.copy(), np.arange(n_blocks), [], []
    while len(at):
        firsts.append(at)
        owners.append(which)
        at = at + step[at]
        going = at < end[which]
        at, which = at[going], which[going]
    first, owner = np.concatenate(firsts), np.concatenate(owners)
    order = np.argsort(first, kind="stable")
    first, owner = first[order], owner[order]

    sel = selector[first]
    width = np.where(sel == 0, 2, 1)
    place = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), _U64)
    words[place] = sel.astype(_U64) << _U64(60)
    escaped = sel == 0
    words[place[escaped] + 1] = ids[first[escaped]]
    for s in np.unique(sel[~escaped]).tolist():
        n, bits = SELECTORS[s]
        own = np.flatnonzero(sel == s)
        p, have, packed = first[own], step[first[own]], np.zeros(len(own), _U64)
        for k in range(n):
            some = have > k
            if not some.any():
                break
            packed |= np.where(some, ids[np.minimum(p + k, total - 1)], _U64(0)) << _U64(bits * k)
        words[place[own]] |= packed
    per_block = np.bincount(owner, weights=width, minlength=n_blocks).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(per_block)])
    edge = np.concatenate([[0], np.cumsum(blocks)])
    return words, offsets, blocks, offsets[edge[1:]] - offsets[edge[:-1]]


def decode(words: np.ndarray, n: int, offsets: np.ndarray | None = None, block: int = BLOCK) -> np.ndarray:
    """The ``n`` ids of one list (or of one of its blocks, given its words); ``offsets`` as written beside them."""
    words = np.asarray(words, _U64)
    out = np.zeros(n, _U64)
    if not n:
        return out
    edges = np.asarray([0, len(words)] if offsets is None else offsets, np.int64)
    sel = (words >> _U64(60)).astype(np.int64)
    head = np.ones(len(words), bool)
    zero = np.flatnonzero(sel == 0)
    if len(zero):
        # the word after an escape is raw and may look like an escape; in a run of words that do, the first is one,
        # as what stands before the run isn't, and then every second
        begins = np.ones(len(zero), bool)
        begins[1:] = np.diff(zero) != 1
        start = zero[begins][np.cumsum(begins) - 1]
        escape = zero[(zero - start) % 2 == 0]
        head[escape + 1] = False
    at = np.flatnonzero(head)
    count = _COUNTS[sel[at]]
    owner = np.searchsorted(edges, at, "right") - 1
    before = np.cumsum(count) - count
    base = before[np.searchsorted(at, edges[owner])]
    target = before - base + owner * block
    limit = np.minimum((owner + 1) * block, n) if offsets is not None else np.full(len(at), n)
    for s in np.unique(sel[at]).tolist():
        m, bits = SELECTORS[s]
        own = sel[at] == s
        if s == 0:
            out[target[own]] = words[at[own] + 1]
            continue
        shift = np.arange(m, dtype=_U64) * _U64(bits)
        value = (words[at[own]][:, None] >> shift) & _U64((1 << bits) - 1)
        place = target[own][:, None] + np.arange(m)
        inside = place < limit[own][:, None]
        out[place[inside]] = value[inside]
    return out


_encoders: dict[tuple[str, str], object] = {}


def encoder(vocabulary: str = VOCABULARY, split: str = SPLIT):
    """The tokenizer of a file of base64 tokens and ranks; made once in each Python process."""
    import tiktoken

    if (vocabulary, split) not in _encoders:
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        _encoders[vocabulary, split] = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=ranks, special_tokens={})
    return _encoders[vocabulary, split]


#: Longer texts are tokenised in pieces of at least so many characters, for the regular expression's sake. They end where
#: white space follows something else, which no token spans; so a piece without such a place is longer.
PIECE = 1 << 18
_CUT = re.compile(r"\S(?=\s)")


def tokens(text: str, enc) -> np.ndarray:
    if len(text) <= PIECE:
        return enc.encode_to_numpy(text, disallowed_special=()).astype(_U64)
    out, i = [], 0
    while i < len(text):
        found = _CUT.search(text, i + PIECE)
        j = found.end() if found else len(text)
        out.append(enc.encode_to_numpy(text[i:j], disallowed_special=()).astype(_U64))
        i = j
    return np.concatenate(out)


def _pack(vocabulary: str, block: int, place: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        none = np.zeros(0, _U64)
        for batch in batches:
            for i, j, _, _ in tv.slices(batch.column("text")):
                texts = batch.column("text").slice(i, j - i)
                lists = [tokens(t, enc) if t else none for t in texts.to_pylist()]
                sizes = np.array([len(x) for x in lists], np.int64)
                words, offsets, blocks, per = encode(np.concatenate(lists) if lists else none, sizes, block)
                edge = np.concatenate([[0], np.cumsum(blocks)])
                first = np.repeat(offsets[edge[:-1]], blocks + 1)
                pos = np.arange(len(first)) - np.repeat(np.arange(len(sizes)), blocks + 1)
                relative = (offsets[np.minimum(pos, len(offsets) - 1)] - first).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(i, j - i) for c in place),
                        batch.column("doc_id").slice(i, j - i),
                        pa.array(sizes, mask=np.asarray(texts.is_null())),
                        pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((np.concatenate([[0], np.cumsum(per)]) * 8).astype(np.int32)), pa.py_buffer(words.astype("<u8"))]),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(blocks + 1)]).astype(np.int32)), pa.array(relative)),
                    ],
                    [*place, "doc_id", "n_tokens", "words", "block_offsets"],
                )

    return lean(run)


def packed_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, block: int = BLOCK, place: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, words, block_offsets) for each row of ``docs``, in their order; before them the number ``place``, if named.

    ``words`` are little-endian 64-bit Simple-8b words; ``block_offsets`` has the first
    word of each block of ``block`` ids and the number of words, so that any block
    decodes on its own (see ``decode``). A null text has n_tokens null and no words; an
    empty one has n_tokens 0. Texts of any length are tokenised whole; those above
    ``PIECE`` characters in pieces cut before white space, with the same ids. Repeated rows are
    encoded each; a null doc_id stays null. An empty table gives an empty result; other
    columns are left out. There is no shuffle. ``vocabulary`` is a file that every
    executor can read.
    """
    require(docs, "doc_id", "text")
    kept = [place] if place else []
    slim = docs.select(*(F.col(c).cast("long").alias(c) for c in kept), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(_pack(vocabulary, block, kept), "".join(f"{c} long, " for c in kept) + "doc_id long, n_tokens long, words binary, block_offsets array<int>")
