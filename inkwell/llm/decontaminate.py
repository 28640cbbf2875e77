"""Benchmark decontamination with an FM-index per shard of documents.

A shard's words become symbols: the words of those windows all of whose words occur in the shard
keep a number each, and a run of other words (no such window can cross it) is one terminator, as is every
end of a text. The suffixes are sorted with every terminator smaller than all words and terminators in order of
place; the Burrows-Wheeler transform of that order is kept as a wavelet matrix of packed bits, whose
ranks answer the backward search of all windows at once, a suffix that windows share once for all of them.
Occurrences are located by walking back to a sampled suffix (every 16th word of a run and each run's
first), and the words that they cover are merged into spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.scratch import Shipped
from inkwell.llm.words import ALNUM, regroup, scan_all

#: Words in a window, bytes of text in a shard, characters of benchmark text in one broadcast, broadcasts that a worker keeps, words between sampled suffixes.
WINDOW, SHARD_BYTES, PHRASE_CHARS, KEPT_PARTS, SAMPLE = 13, 1 << 20, 1 << 20, 8, 16


@dataclass
class Phrases:
    """Distinct windows as rows of symbols from the last word back (1 and up, 0 fills up), sorted; window i belongs to ``items[first[i]:first[i + 1]]``, to none where only items without id have it."""

    vocabulary: np.ndarray
    back: np.ndarray
    length: np.ndarray
    first: np.ndarray
    items: np.ndarray  # of strings


def phrases(ids: list, texts: list[str | None], window: int = WINDOW) -> Phrases:
    w = scan_all(pa.array([t or "" for t in texts], pa.large_string()), ALNUM)
    vocabulary, symbol = np.unique(w.hashes, return_inverse=True)
    count = np.diff(w.first)
    many = np.where(count >= window, count - window + 1, (count > 0).astype(count.dtype))
    item = np.repeat(np.arange(len(ids)), many)
    nth = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
    length = np.minimum(count[item], window)
    last = w.first[item] + nth + length - 1
    back = np.zeros((len(item), window), np.int32)
    for k in range(window):
        long = np.flatnonzero(length > k)
        back[long, k] = symbol[last[long] - k] + 1
    order = np.lexsort(back.T[::-1])
    back, length, item = back[order], length[order], item[order]
    new = np.append(True, (back[1:] != back[:-1]).any(1)) if len(back) else np.zeros(0, bool)
    names: dict[str, int] = {}
    name = np.array([-1 if i is None else names.setdefault(str(i), len(names)) for i in ids], np.int64)[item]
    pairs = np.unique(np.stack([np.cumsum(new) - 1, name], 1)[name >= 0], axis=0)
    first = np.searchsorted(pairs[:, 0], np.arange(int(new.sum()) + 1))
    return Phrases(vocabulary, back[new], length[new], first, np.array(list(names), object)[pairs[:, 1]])


class Bits:
    """Packed bits that know how many are set before any place."""

    def __init__(self, bit: np.ndarray):
        packed = np.packbits(bit, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(8 - len(packed) % 8, np.uint8)]).view("<u8")  # one zero byte or more, so the end has a word too
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))[:-1]]).astype(np.int32)
        self.zeros = len(bit) - int(bit.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def at(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class FMIndex:
    """Over ``sequence``: symbols 1..top, 0 for terminators; it must end with one."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.n = n = len(sequence)
        self.bits = bits = max(1, int(top).bit_length())
        stops = np.flatnonzero(sequence == 0).astype(np.int32)
        self.run = stops[np.searchsorted(stops, np.arange(n, dtype=np.int32))] - np.arange(n, dtype=np.int32)  # words to the run's end
        order = self._sorted(sequence, bits).astype(np.int32)
        begin = np.concatenate([np.full(1, -1, np.int32), stops])[np.searchsorted(stops, order)] + 1  # each suffix's run's first word
        sampled = (order - begin) % SAMPLE == 0
        self.marked, self.places = Bits(sampled), order[sampled]
        rest = sequence[order - 1]
        self.less = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=top + 1))])
        self.levels: list[Bits] = []
        for level in reversed(range(bits)):
            high = ((rest >> level) & 1).astype(bool)
            self.levels.append(Bits(high))
            rest = np.concatenate([rest[~high], rest[high]])
        symbols = np.arange(top + 1)
        self.origin = self._down(symbols, np.zeros(top + 1, np.int64))

    def _sorted(self, s: np.ndarray, bits: int) -> np.ndarray:
        """Suffix order by prefix doubling; a suffix ends at its terminator, and equal ones stand in order of place."""
        n, cover = self.n, max(1, 62 // bits)
        key = np.zeros(n, np.int64)
        for j in range(cover):
            key <<= bits
            if j < n:
                key[: n - j] |= np.where(self.run[: n - j] >= j, s[j:], 0)
        longest = int(self.run.max())
        while cover <= longest:
            distinct, rank = np.unique(key, return_inverse=True)
            key = (rank + 1) * (len(distinct) + 2)
            more = np.flatnonzero(self.run[: n - cover] >= cover)
            key[more] += rank[more + cover] + 1
            cover *= 2
        return np.argsort(key, kind="stable")

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the wavelet matrix leads position ``at`` for ``symbol``; less ``origin``, that is the symbol's rank."""
        for level, bits in zip(reversed(range(self.bits)), self.levels, strict=True):
            o = bits.rank(at)
            at = np.where((symbol >> level) & 1, bits.zeros + o, at - o)
        return at

    def _back(self, row: np.ndarray) -> np.ndarray:
        """The rows of the suffixes one word longer (which are not a run's first)."""
        symbol, at = np.zeros(len(row), np.int64), row
        for bits in self.levels:
            o, bit = bits.rank(at), bits.at(at)
            symbol = (symbol << 1) | bit
            at = np.where(bit, bits.zeros + o, at - o)
        return self.less[symbol] + at - self.origin[symbol]

    def search(self, back: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, place) of every occurrence of the phrases: rows of symbols from the last one back, in sorted order."""
        live = np.arange(len(length))
        low, high = np.zeros(len(length), np.int64), np.full(len(length), self.n, np.int64)
        done = []
        for step in range(back.shape[1] if len(length) else 0):
            c = back[live, step]
            # Phrases of the same suffix so far stand together, and only they have the same range of rows.
            new = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (c[1:] != c[:-1]))
            one, of = np.flatnonzero(new), np.cumsum(new) - 1
            shift = self.less[c[one]] - self.origin[c[one]]
            low, high = (shift + self._down(c[one], low[one]))[of], (shift + self._down(c[one], high[one]))[of]
            some = high > low
            live, low, high = live[some], low[some], high[some]
            ended = length[live] == step + 1
            done.append((live[ended], low[ended], high[ended]))
            live, low, high = live[~ended], low[~ended], high[~ended]
            if not len(live):
                break
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        live, low, high = (np.concatenate(x) for x in zip(*done, strict=True))
        count = high - low
        rows = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        return np.repeat(live, count), self.locate(rows)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, left, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
        while len(left):
            hit = self.marked.at(rows)
            out[left[hit]] = self.places[self.marked.rank(rows[hit])] + steps
            left, rows, steps = left[~hit], self._back(rows[~hit]), steps + 1
        return out


def occurrences(hashes: np.ndarray, first: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of the windows' occurrences in texts whose words' hashes are given."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(p.vocabulary) or not len(hashes):
        return nothing
    near = np.minimum(np.searchsorted(p.vocabulary, hashes), len(p.vocabulary) - 1)
    kept = np.flatnonzero(p.vocabulary[near] == hashes)
    present = np.zeros(len(p.vocabulary) + 1, bool)
    present[0] = True
    present[near[kept] + 1] = True
    may = np.flatnonzero(present[p.back].all(1))
    if not len(may):
        return nothing
    back = p.back[may]
    useful = np.zeros(len(present), bool)
    useful[back] = True
    useful[0] = False
    number = np.cumsum(useful).astype(np.int32) * useful  # keeps the order, so rows of ``back`` stay sorted
    kept = kept[useful[near[kept] + 1]]
    heads = np.zeros(len(hashes) + 1, bool)
    heads[first[:-1]] = True
    cut = np.append(True, np.diff(kept) != 1) | heads[kept]
    spot = np.arange(len(kept)) + np.cumsum(cut)
    sequence, word = np.zeros(spot[-1] + 2, np.int32), np.zeros(spot[-1] + 2, np.int64)
    sequence[spot], word[spot] = number[near[kept] + 1], kept
    window, place = FMIndex(sequence, int(useful.sum())).search(number[back], p.length[may])
    return may[window], word[place]


SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, spans array<struct<from: long, to: long>>"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("spans", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))])


def _hits(texts: pa.Array, parts: list) -> tuple[np.ndarray, np.ndarray, dict[int, set[str]]]:
    """Which words of a shard's texts are hit, where each text's words begin, and each text's items."""
    w = scan_all(texts, ALNUM)
    step = np.zeros(len(w.hashes) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for part in parts:
        p: Phrases = part.value
        if len(parts) > KEPT_PARTS:
            part.drop()
        window, at = occurrences(w.hashes, w.first, p)
        np.add.at(step, at, 1)
        np.add.at(step, at + p.length[window], -1)
        doc = np.searchsorted(w.first, at, "right") - 1
        for d, k in np.unique(np.stack([doc, window], 1), axis=0).tolist() if len(at) else ():
            items.setdefault(d, set()).update(p.items[p.first[k] : p.first[k + 1]].tolist())
    return np.cumsum(step[:-1]) > 0, w.first, items


def _find(parts: list):
    no_items = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, 1, SHARD_BYTES):
            hit, first, items = _hits(batch.column(1), parts)
            n = batch.num_rows
            total = np.concatenate([[0], np.cumsum(hit)])
            n_hit = total[first[1:]] - total[first[:-1]]
            spans: list = [[]] * n
            shas, n_items = [no_items] * n, np.zeros(n, np.int64)
            for d, own in items.items():
                edge = np.flatnonzero(np.diff(np.concatenate([[False], hit[first[d] : first[d + 1]], [False]]).astype(np.int8)))
                spans[d] = [{"from": x, "to": y} for x, y in edge.reshape(-1, 2).tolist()]
                shas[d] = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
                n_items[d] = len(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(first)), pa.array(n_hit), pa.array(n_items), pa.array(shas), pa.array(spans, ARROW.field("spans").type)], schema=ARROW)

    return run


def _parts(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> list:
    """The benchmark's windows in broadcasts of a bounded size each; the driver holds one part's texts at a time."""
    parts, ids, texts, size = [], [], [], 0

    def send() -> None:
        parts.append(Shipped(benchmark.sparkSession, phrases(ids, texts, window)))
        parts[-1].drop()

    for row in benchmark.select(F.col(item_col), F.col(text_col)).filter(F.col(text_col).isNotNull()).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1])
        if size >= PHRASE_CHARS:
            send()
            ids, texts, size = [], [], 0
    if ids:
        send()
    return parts


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, spans (merged ranges of hit words), contaminated.

    Words are runs of letters, digits and non-ASCII characters after lower-casing A-Z. A window is ``window``
    consecutive words of an item, or all of them where there are fewer. A null or empty text has no words and
    no hits; an item without words has no windows. The words of an item without an id are hit like others', but it
    is not among the items counted or hashed. Items that repeat an id count once; rows that repeat a document each get their own row. Empty tables on either side give no rows or no
    hits. The benchmark is broadcast in parts of a bounded size, searched one after the other.
    """
    parts = _parts(benchmark, item_col, text_col, window)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_find(parts), SCHEMA).withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def reject(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns as they are."""
    parts, at = _parts(benchmark, item_col, text_col, window), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, at, SHARD_BYTES):
            hit, first, _ = _hits(batch.column(at), parts)
            total = np.concatenate([[0], np.cumsum(hit)])
            n_hit = total[first[1:]] - total[first[:-1]]
            yield batch.filter(pa.array((n_hit == 0) | (20 * n_hit < np.diff(first))))

    return docs.mapInArrow(run, docs.schema)
