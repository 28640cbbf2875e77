"""Words of whole texts as 64-bit hashes, computed on the byte buffer of an Arrow batch."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at once; a longer text makes a chunk of its own. Words whose bytes are hashed at once.
CHUNK_BYTES, HASHED_WORDS = 1 << 20, 1 << 15

BYTES = np.arange(256)
LOWER = np.where((BYTES >= 65) & (BYTES <= 90), BYTES + 32, BYTES).astype(np.uint8)
#: Word bytes after lower-casing. In UTF-8 every byte of a non-ASCII character is 0x80 or more, so bytes decide as characters would.
NOT_SPACE = ~((BYTES == 0x20) | ((BYTES >= 0x09) & (BYTES <= 0x0D)))
ALNUM = ((BYTES >= 0x30) & (BYTES <= 0x39)) | ((BYTES >= 0x61) & (BYTES <= 0x7A)) | (BYTES >= 0x80)

BASE = U64(0x9E3779B97F4A7C15)


def powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(max(n - 1, 0), BASE, U64)]))[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the one of splitmix64), on a copy."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed numbers without a pattern."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * BASE + U64(seed))


#: A word's hash is the sum of a place's number times a letter's. A polynomial's powers would not do: modulo 2^64 some words meet whatever the base.
_PLACES, _LETTERS = numbers(1024, 1), numbers(256, 1 << 40) | U64(1)


@dataclass
class Words:
    """``hashes``: of all words in order; text i has those from ``first[i]`` to ``first[i + 1]``. ``start``, ``length``: in the bytes ``data``."""

    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    length: np.ndarray
    data: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without nulls, and each text's offset in them."""
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[off[0] : off[-1]] if body is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def scan(data: np.ndarray, off: np.ndarray, kind: np.ndarray = NOT_SPACE) -> Words:
    """Words of the texts in ``data``, A-Z lower-cased."""
    low = LOWER[data]
    is_word = kind[low]
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    heads = off[:-1][off[:-1] < len(data)]
    begins[heads] = is_word[heads]  # a word ends with its text
    start = np.flatnonzero(begins)
    first = np.searchsorted(start, off)
    if not len(start):
        return Words(np.zeros(0, U64), first, start, np.zeros(0, np.int64), low)
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:] | begins[1:]
    length = np.flatnonzero(ends) + 1 - start
    global _PLACES
    if (longest := int(length.max())) > len(_PLACES):
        _PLACES = numbers(2 * longest, 1)
    h = np.empty(len(start), U64)
    for i in range(0, len(start), HASHED_WORDS):  # the numbers below take many bytes for each of the words'
        own = slice(i, i + HASHED_WORDS)
        n = length[own]
        at = np.cumsum(n) - n
        nth = np.arange(int(n.sum()), dtype=np.int32) - np.repeat(at.astype(np.int32), n)
        with np.errstate(over="ignore"):
            part = _PLACES[nth]
            part *= _LETTERS[low[nth + np.repeat(start[own], n)]]
            h[own] = np.add.reduceat(part, at)
    return Words(mix(h ^ (length.astype(U64) << U64(48))), first, start, length, low)


def chunks(off: np.ndarray, most: int = CHUNK_BYTES, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold ``most`` bytes or are a single text, and no more than ``rows`` of them."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        j = min(j, i + rows) if rows else j
        yield i, j
        i = j


def scan_batch(texts: pa.Array, kind: np.ndarray = NOT_SPACE, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) over the batch's rows; nulls count as empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    data, off = text_bytes(texts)
    for i, j in chunks(off, most):
        yield i, j, scan(data[off[i] : off[j]], off[i : j + 1] - off[i], kind)


def scan_all(texts: pa.Array, kind: np.ndarray = NOT_SPACE) -> Words:
    """Words of the whole batch (without its bytes), scanned in chunks so that working memory stays that of a chunk."""
    parts = [w for _, _, w in scan_batch(texts, kind)]
    counts = np.concatenate([[0], *[np.diff(w.first) for w in parts]])
    empty = np.zeros(0, np.int64)
    return Words(np.concatenate([np.zeros(0, U64), *[w.hashes for w in parts]]), np.cumsum(counts), empty, empty, np.zeros(0, np.uint8))


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``n`` words inside a text, and where each text's begin. A text of fewer words, but not none, has its whole sequence as one."""
    count = np.diff(w.first)
    out = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
    first = np.concatenate([[0], np.cumsum(out)])
    with np.errstate(over="ignore"):
        odd = powers(n + 1) | U64(1)
        h = w.hashes
        rolled = np.zeros(max(len(h) - n + 1, 0), U64)
        for k in range(n):
            rolled += h[k : k + len(rolled)] * odd[k]
        runs = np.zeros(int(first[-1]), U64)
        long = np.flatnonzero(count >= n)
        if len(long):
            size = out[long]
            ramp = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            runs[ramp + np.repeat(first[long], size)] = rolled[ramp + np.repeat(w.first[long], size)]
        for i in np.flatnonzero((count > 0) & (count < n)):
            part = h[w.first[i] : w.first[i + 1]]
            runs[first[i]] = (part * odd[: len(part)]).sum(dtype=U64) + U64(len(part))
    return mix(runs), first


def give_back() -> None:
    """Return freed memory to the system: a worker lives on between tasks, and what it once needed would stay with it."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def regroup(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of the text column, a longer text in a batch with few others."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        _, off = text_bytes(batch.column(column).fill_null(""))
        for i, j in chunks(off, max(most // 4, 1)):
            held.append(batch.slice(i, j - i))
            size += int(off[j] - off[i])
            if size >= most:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()
    held.clear()
    give_back()
