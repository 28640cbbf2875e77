"""A word n-gram model as a weighted backoff automaton, trained and walked over blocks of text.

A state is a history that training has seen, from none (the root) up to order - 1 words. Its arcs
carry the smoothed probabilities of the words seen after it, and lead to the longest suffix that is a state
again. Its failure arc leads to the next shorter history, and its weight is what the history
leaves to that one. Smoothing is Dirichlet's: P(w | h) = (c(h w) + m P(w | h')) / (c(h) + m), so
the failure arc of h weighs m / (c(h) + m), by how much has been seen of h itself.

No task holds the model. Documents are encoded once into blocks, and a block builds the part of the
automaton that its own texts can reach. To that end it asks for the counts of its distinct
n-grams, one order after the other: requests are dealt by hash into buckets, and a bucket adds up
what all blocks have seen in training and answers each block. An answer also says whether any other
block holds the n-gram, and gives it a number. A longer n-gram is asked for by the numbers of
its history and its word, so that no two n-grams can be taken for one another; it is not asked for at all where a
part of it has never been seen (then neither has it) or is in this block alone (then so is it,
and the block's own count is the whole one).

Requests and answers travel as packed arrays, so a bucket's memory is its requests, and
an n-gram that all documents share costs one entry a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.scratch import Scratch
from inkwell.llm.words import U64, chunks, give_back, mix, regroup, scan, text_bytes

#: Bytes of text in a block, requested n-grams in a bucket on average, longest n-gram, Dirichlet's mass.
BLOCK_BYTES, BUCKET_GRAMS, ORDER, MASS = 4 << 20, 1_000_000, 3, 16.0
#: Tokens that one lane of a walk scores.
LANE = 256
#: What stands for the end of a text among words, which hold no blank; its hash, which a word has by a chance of 2^-64.
END, END_HASH = b" ", U64(0x0123456789ABCDEF)


def _squeeze(numbers: np.ndarray) -> bytes:
    """64-bit numbers, their bytes in planes, so that those that hardly change take little."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unsqueeze(packed: bytes, n: int) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(8 * n, 1)), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).reshape(-1).view("<i8")


def _counts(c: np.ndarray) -> bytes:
    """Small numbers in a byte each; others follow as 8 bytes, in order."""
    big = c >= 255
    return np.where(big, 255, c).astype(np.uint8).tobytes() + c[big].astype("<i8").tobytes()


def _uncounts(b: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(b, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(b, "<i8", offset=n)
    return out


class Grams:
    """The n-grams of a block's texts. ``ids[k]``: at each token the number of the (k + 1)-gram that ends there, -1 where the text has not begun long enough;
    ``head[k]``, ``word[k]`` and ``tail[k]``: the numbers of a (k + 1)-gram's first k words, its last word and its last k words."""

    def __init__(self, kinds: int, tokens: np.ndarray, first: np.ndarray, order: int):
        word = np.arange(kinds)
        self.ids, self.head, self.word, self.tail = [tokens.astype(np.int64)], [word], [word], [word]
        place = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
        for k in range(1, order):
            ok = np.flatnonzero(place >= k)
            pairs, inverse = np.unique(self.ids[k - 1][ok - 1] * kinds + self.ids[0][ok], return_inverse=True)
            ids = np.full(len(tokens), -1, np.int64)
            ids[ok] = inverse
            tail = np.zeros(len(pairs), np.int64)
            tail[inverse] = self.ids[k - 1][ok]
            self.ids.append(ids)
            self.head.append(pairs // kinds)
            self.word.append(pairs % kinds)
            self.tail.append(tail)


#: Two rows a block: ``part`` 0 with its texts, and 1 with its words and their counts, which only the first round reads.
BLOCK = "part int, block long, n_tokens long, payload binary"
BLOCK_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())])


def _vocabulary(texts: pa.Array) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
    """Of a block's texts: the distinct words' hashes, their lengths and bytes, every token as a number among them, and how many words each text has."""
    data, off = text_bytes(texts)
    parts, counts, seen, sizes, bodies = [], [], [], [], []
    for i, j in chunks(off):
        w = scan(data[off[i] : off[j]], off[i : j + 1] - off[i])
        counts.append(np.diff(w.first))
        parts.append(w.hashes)
        own, at = np.unique(w.hashes, return_index=True)
        size = w.length[at]
        seen.append(own)
        sizes.append(size)
        bodies.append(w.data[np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(w.start[at], size)])
    nothing = np.zeros(0, np.int64)
    own, size, body = np.concatenate([*seen, [END_HASH]]).astype(U64), np.concatenate([nothing, *sizes, [1]]), np.concatenate([np.zeros(0, np.uint8), *bodies, np.frombuffer(END, np.uint8)])
    kinds, at = np.unique(own, return_index=True)
    begin = (np.cumsum(size) - size)[at]
    size = size[at]
    body = body[np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)]
    n = np.concatenate([nothing, *counts])
    first = np.concatenate([[0], np.cumsum(n + 1)])  # each text's words and its end
    stream = np.full(int(first[-1]), END_HASH, U64)
    inside = np.ones(len(stream), bool)
    inside[first[1:] - 1] = False
    stream[inside] = np.concatenate([np.zeros(0, U64), *parts])
    return kinds, (size, body), np.searchsorted(kinds, stream), n


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, train) to blocks. A block's number comes from its partition, so that it stays the same when a task runs again."""
    import zstandard
    from pyspark import TaskContext

    squeeze, made = zstandard.ZstdCompressor(level=1), 0
    partition = TaskContext.get().partitionId()
    for one in regroup(batches, 1, BLOCK_BYTES):
        ids = one.column(0)
        kinds, (size, body), tokens, n = _vocabulary(one.column(1))
        flags = np.stack([ids.is_valid().to_numpy(zero_copy_only=False), one.column(2).to_numpy(zero_copy_only=False)])
        docs = [ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), flags.astype(np.uint8).tobytes(), (n + 1).astype("<i8").tobytes()]
        payload = np.array([one.num_rows, len(kinds), len(tokens)], "<i8").tobytes() + squeeze.compress(b"".join([*docs, tokens.astype("<u4").tobytes()]))
        seen = np.bincount(tokens[np.repeat(flags[1], n + 1)], minlength=len(kinds))
        words = np.array([len(kinds)], "<i8").tobytes() + squeeze.compress(b"".join([size.astype("<i4").tobytes(), seen.astype("<i4").tobytes(), body.tobytes()]))
        made += 1
        number = partition * (1 << 32) + made
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([number] * 2), pa.array([len(tokens), 0]), pa.array([payload, words], pa.binary())], schema=BLOCK_ARROW)


class Block:
    """A block's texts and what it knows of its n-grams: ``totals[k]`` are the counts of the (k + 1)-grams in all training texts."""

    def __init__(self, payload: bytes, order: int):
        import zstandard

        docs, self.kinds, tokens = np.frombuffer(payload, "<i8", 3).tolist()
        raw = zstandard.ZstdDecompressor().decompress(payload[24:], max_output_size=18 * docs + 4 * tokens + 1)
        self.ids, self.valid, self.train = np.frombuffer(raw, "<i8", docs), np.frombuffer(raw, np.uint8, docs, 8 * docs).astype(bool), np.frombuffer(raw, np.uint8, docs, 9 * docs).astype(bool)
        self.n = np.frombuffer(raw[10 * docs : 18 * docs], "<i8")
        self.tokens = np.frombuffer(raw[18 * docs :], "<u4").astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        self.grams = Grams(self.kinds, self.tokens, self.first, order)
        self.totals: list[np.ndarray] = []
        self.alone: list[np.ndarray] = []
        self.number: list[np.ndarray] = []

    def learned(self, k: int) -> np.ndarray:
        """How often each (k + 1)-gram occurs in the block's training texts."""
        ids = self.grams.ids[k][np.repeat(self.train, self.n)]
        return np.bincount(ids[ids >= 0], minlength=len(self.grams.word[k]))

    def unsure(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The (k + 1)-grams whose counts must be asked for, and whether each is known to be in this block alone."""
        head, tail = self.grams.head[k], self.grams.tail[k]
        if not k:
            return np.arange(self.kinds), np.zeros(self.kinds, bool)
        alone = self.alone[k - 1][head] | self.alone[k - 1][tail]
        return np.flatnonzero(~alone & (self.totals[k - 1][head] > 0) & (self.totals[k - 1][tail] > 0)), alone

    def dealt(self, k: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The (k + 1)-grams to ask for, in order of bucket and, within one, of their histories' numbers; where each bucket's begin; the buckets."""
        asked = self.unsure(k)[0]
        a, b = self.number[k - 1][self.grams.head[k][asked]], self.number[0][self.grams.word[k][asked]]
        with np.errstate(over="ignore"):
            to = (mix(mix(a.astype(U64)) + b.astype(U64)) % U64(buckets)).astype(np.int64)
        rank = np.empty(len(self.number[k - 1]), np.int64)
        rank[np.argsort(self.number[k - 1], kind="stable")] = np.arange(len(rank))
        by = np.argsort(rank[self.grams.head[k][asked]] * self.kinds + self.grams.word[k][asked])  # no two are equal
        by = by[np.argsort(to[by].astype(np.uint16) if buckets <= 1 << 16 else to[by], kind="stable")]
        return asked[by], *_edges(to[by])

    def learn(self, k: int, buckets: int, answers: dict[int, bytes]) -> None:
        """Take in the answers, by bucket, to what was asked of (k + 1)-grams."""
        alone = self.unsure(k)[1]
        totals, number = np.where(alone, self.learned(k), 0), np.full(len(alone), -1, np.int64)
        if k:
            asked, edge, to = self.dealt(k, buckets)
        else:  # words stand in order of bucket
            to = np.array(sorted(answers))
            edge, asked = np.cumsum([0, *(_size(answers[r]) for r in to.tolist())]), np.arange(self.kinds)
        for i, j, r in zip(edge[:-1].tolist(), edge[1:].tolist(), to.tolist(), strict=True):
            own = asked[i:j]
            totals[own], alone[own], number[own] = _answered(answers[r])
        self.totals.append(totals)
        self.alone.append(alone)
        self.number.append(number)


def _edges(to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal numbers begin and the last one ends, and the number of each."""
    heads = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, np.int64)
    return np.append(heads, len(to)), to[heads]


def _block(row: pa.Table, answers: pa.Table, order: int, buckets: list[int]) -> Block:
    payload = row.column("payload").to_pylist()
    if len(payload) != 1:
        raise ValueError(f"a block has {len(payload)} payloads")
    b, got = Block(payload[0], order), {}
    for n, r, a in zip(answers.column("n").to_pylist(), answers.column("bucket").to_pylist(), answers.column("answer"), strict=True):
        got.setdefault(n, {})[r] = a.as_py()
    for k, many in enumerate(buckets):
        b.learn(k, many, got.get(k + 1, {}))
    return b


ASKED = "bucket long, block long, many int, keys binary, more binary, seen binary"
ASKED_ARROW = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("many", pa.int32()), ("keys", pa.binary()), ("more", pa.binary()), ("seen", pa.binary())])


def _asked(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * len(ASKED_ARROW), ASKED_ARROW.types, strict=True)]


def _ask_words(buckets: int):
    """Blocks' words to requests, which name them by their bytes. Words stand in order of hash, and a bucket is a range of hashes."""
    import zstandard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, spread = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            for number, packed in zip(batch.column("block").to_pylist(), batch.column("payload"), strict=True):
                packed = packed.as_py()
                n, raw = int(np.frombuffer(packed, "<i8", 1)[0]), spread.decompress(packed[8:])
                size, seen, body = np.frombuffer(raw, "<i4", n).astype(np.int64), np.frombuffer(raw, "<i4", n, 4 * n), raw[8 * n :]
                begin = np.append(0, np.cumsum(size))
                w = scan(np.frombuffer(body, np.uint8), begin)
                hashes = np.full(n, END_HASH, U64)
                hashes[np.diff(w.first) > 0] = w.hashes
                edge, to = _edges((((hashes >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(_asked([(r, number, j - i, squeeze.compress(body[begin[i] : begin[j]]), _squeeze(size[i:j]), _counts(seen[i:j])) for i, j, r in zip(edge[:-1].tolist(), edge[1:].tolist(), to.tolist(), strict=True)]), schema=ASKED_ARROW)
        give_back()

    return run


def _ask(k: int, buckets: list[int], many: int):
    """A block and the answers so far to its requests for (k + 1)-grams, which are named by the numbers of their history and their word."""

    def run(key: tuple[pa.Scalar, ...], row: pa.Table, answers: pa.Table) -> pa.Table:
        b = _block(row, answers, k + 1, buckets)
        asked, edge, to = b.dealt(k, many)
        seen, head, word = b.learned(k)[asked], b.number[k - 1][b.grams.head[k][asked]], b.number[0][b.grams.word[k][asked]]
        rows = [(r, key[0].as_py(), j - i, _squeeze(np.diff(head[i:j], prepend=0)), _squeeze(word[i:j]), _counts(seen[i:j])) for i, j, r in zip(edge[:-1].tolist(), edge[1:].tolist(), to.tolist(), strict=True)]
        give_back()
        return pa.Table.from_arrays(_asked(rows), schema=ASKED_ARROW)

    return run


ANSWER = "n int, bucket long, block long, answer binary, tokens long, kinds long"
ANSWER_ARROW = pa.schema([("n", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("answer", pa.binary()), ("tokens", pa.int64()), ("kinds", pa.int64())])


def _packed(totals: np.ndarray, alone: np.ndarray, number: np.ndarray) -> bytes:
    counts = _counts(totals)
    return np.array([len(totals), len(counts)], "<i8").tobytes() + counts + np.packbits(alone).tobytes() + _squeeze(number[~alone & (totals > 0)])


def _size(answer: bytes) -> int:
    return int(np.frombuffer(answer, "<i8", 1)[0])


def _answered(answer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, counts = np.frombuffer(answer, "<i8", 2).tolist()
    at, end = 16 + counts, 16 + counts + -(-n // 8)
    totals, alone = _uncounts(answer[16:at], n), np.unpackbits(np.frombuffer(answer[at:end], np.uint8), count=n).astype(bool)
    number, some = np.full(n, -1, np.int64), ~alone & (totals > 0)
    number[some] = _unsqueeze(answer[end:], int(some.sum()))
    return totals, alone, number


def _answer(n: int, buckets: int):
    """A bucket's requests to its answers; ``tokens`` and ``kinds`` stand in the first: its training total and the number of n-grams seen there."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        blocks, many, keys, more, seen = [], [], [], [], []
        for batch in batches:
            blocks += batch.column("block").to_pylist()
            for m, a, b, c in zip(batch.column("many").to_pylist(), batch.column("keys"), batch.column("more"), batch.column("seen"), strict=True):
                many.append(m)
                keys.append(zstandard.ZstdDecompressor().decompress(a.as_py()) if n == 1 else np.cumsum(_unsqueeze(a.as_py(), m)))
                more.append(_unsqueeze(b.as_py(), m))
                seen.append(_uncounts(c.as_py(), m))
        more, seen = np.concatenate(more), np.concatenate(seen)
        if n == 1:
            edge = np.concatenate([[0], np.cumsum(more)])
            names = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(more), [None, pa.py_buffer(edge), pa.py_buffer(b"".join(keys))])
            kind = names.dictionary_encode().indices.to_numpy().astype(np.int64)
        else:
            keys = np.concatenate(keys)
            order = np.lexsort((more, keys))
            x, y = keys[order], more[order]
            kind = np.empty(len(order), np.int64)
            kind[order] = np.cumsum(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))) - 1
            del x, y, order
        del keys, more
        held = np.bincount(kind)  # an n-gram occurs once in a block's request
        totals = np.zeros(len(held), np.int64)
        np.add.at(totals, kind, seen)
        del seen
        bucket, at = key[0].as_py(), 0
        for block, m in zip(blocks, many, strict=True):
            own = kind[at : at + m]
            answer = _packed(totals[own], held[own] == 1, own * buckets + bucket)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int32()), pa.array([bucket]), pa.array([block]), pa.array([answer], pa.binary()), pa.array([0 if at else int(totals.sum())]), pa.array([0 if at else int((totals > 0).sum())])],
                schema=ANSWER_ARROW,
            )
            at += m
        give_back()

    return run


class Automaton:
    """The states that a block's texts can reach: the root is 0, then come the histories of one word, of two, and so on.

    ``fail`` and ``failed``: a state's failure arc and its log10 weight. Arcs stand in order of state and word: ``keys`` is
    state * words + word, ``weight`` the log10 probability, ``to`` the next state. The root has an arc for each word.
    """

    def __init__(self, grams: Grams, totals: list[np.ndarray], ends: int, n_all: int, n_kinds: int, mass: float):
        """``ends``: the number of the end token, which no history holds."""
        self.words, order = len(grams.word[0]), len(grams.word)
        base = (totals[0] + 1) / (n_all + 1.0 * (n_kinds + 1))
        state, states = [np.zeros(0, np.int64)] * order, 1  # of each n-gram that is a history, else 0
        fail, failed = [np.zeros(1, np.int64)], [np.zeros(1)]
        for k in range(order - 1):
            some = np.flatnonzero((totals[k] > 0) & (grams.word[k] != ends))
            state[k] = np.zeros(len(totals[k]), np.int64)
            state[k][some] = states + np.arange(len(some))
            states += len(some)
            fail.append(state[k - 1][grams.tail[k][some]] if k else np.zeros(len(some), np.int64))
            failed.append(np.log10(mass / (totals[k][some] + mass)))
        self.fail, self.failed = np.concatenate(fail), np.concatenate(failed)
        keys, weight, to, p = [np.arange(self.words)], [np.log10(base)], [state[0] if order > 1 else np.zeros(self.words, np.int64)], base
        for k in range(1, order):
            head, tail, word = grams.head[k], grams.tail[k], grams.word[k]
            history = totals[k - 1][head]
            # Of an n-gram that has not been seen, too: what its tail needs below is this probability by way of the failure arc.
            p = np.where(history > 0, (totals[k] + mass * p[tail]) / np.where(history > 0, history + mass, 1), p[tail])
            arcs = np.flatnonzero(totals[k] > 0)
            keys.append(state[k - 1][head[arcs]] * self.words + word[arcs])
            weight.append(np.log10(p[arcs]))
            to.append((state[k] if k < order - 1 else state[k - 1][tail])[arcs])
        keys = np.concatenate(keys)
        by = np.argsort(keys)  # no two are equal
        self.keys, self.weight, self.to = keys[by], np.concatenate(weight)[by], np.concatenate(to)[by]

    def walk(self, tokens: np.ndarray, at: np.ndarray, last: np.ndarray, scored: np.ndarray) -> np.ndarray:
        """log10 of each token's probability: lanes of tokens from ``at`` to ``last`` go on a token at each step, and give those from ``scored`` on.

        A lane carries its state. Where that has no arc for the token, the lane takes the failure arc, and
        its weight, until there is one; it then takes the arc, and its weight.
        """
        out, state = np.empty(len(tokens)), np.zeros(len(at), np.int64)
        while len(at):
            word, lost = tokens[at], np.zeros(len(at))
            left, arc = np.arange(len(at)), np.empty(len(at), np.int64)
            while True:
                root = state[left] == 0  # whose arcs come first, one for each word
                arc[left[root]] = word[left[root]]
                left = left[~root]
                if not len(left):
                    break
                key = state[left] * self.words + word[left]
                spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                found = self.keys[spot] == key
                arc[left[found]] = spot[found]
                left = left[~found]
                lost[left] += self.failed[state[left]]
                state[left] = self.fail[state[left]]
            keep = at >= scored
            out[at[keep]] = (lost + self.weight[arc])[keep]
            going = at + 1 < last
            state, at, last, scored = self.to[arc[going]], at[going] + 1, last[going], scored[going]
        return out


def lanes(first: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut into lanes: where each begins, ends, and scores from. One inside a text begins order - 1 tokens early: whatever stood before them, the state after them is the same."""
    many = -(-np.diff(first) // LANE)
    text = np.repeat(np.arange(len(many)), many)
    scored = first[text] + LANE * (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many))
    return np.maximum(scored - (order - 1), first[text]), np.minimum(scored + LANE, first[text + 1]), scored


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"
SCORES_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _score(order: int, buckets: list[int], n_all: int, n_kinds: int, mass: float):
    def run(key: tuple[pa.Scalar, ...], row: pa.Table, answers: pa.Table) -> pa.Table:
        b = _block(row, answers, order, buckets)
        machine = Automaton(b.grams, b.totals, int(b.tokens[b.first[1] - 1]), n_all, n_kinds, mass)
        score = machine.walk(b.tokens, *lanes(b.first, order))
        head, known = b.first[:-1], b.totals[0][b.tokens]
        base = np.log10((known + 1) / (n_all + 1.0 * (n_kinds + 1)))
        give_back()
        return pa.Table.from_arrays(
            [pa.array(b.ids, pa.int64(), mask=~b.valid), pa.array(b.n, pa.int64()), pa.array(np.add.reduceat((known > 0).astype(np.int64), head)), pa.array(np.add.reduceat(base, head)), pa.array(np.add.reduceat(score, head))],
            schema=SCORES_ARROW,
        )

    return run


def score_texts(docs: DataFrame, train: str, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, mass: float = MASS, bucket_grams: int = BUCKET_GRAMS) -> DataFrame:
    """Learn from the rows where the SQL condition ``train`` holds and score all rows.

    doc_id, n_tokens, n_known, train_tokens, base_score, score; a row per input row. A null or empty text is
    its end token alone. Rows that repeat one another count each time. Without training rows all counts
    are 0 and scores are those of one unknown kind. An empty table gives no rows. Only the id, the text
    and what ``train`` names are read; columns of other names do not matter.
    """
    spark = docs.sparkSession
    with Scratch(spark, "backoff") as scratch:
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(F.expr(train), F.lit(False)).alias("train"))
        rows.mapInArrow(_encode, BLOCK).write.partitionBy("part").parquet(scratch.path("blocks"))
        part = lambda k: spark.read.schema(BLOCK.split(", ", 1)[1]).parquet(scratch.path(f"blocks/part={k}"))
        if rows.isEmpty():
            return spark.createDataFrame([], SCORES + ", train_tokens long")
        tokens = part(0).agg(F.sum("n_tokens").alias("n")).first().n
        many = int(tokens // bucket_grams) + 1  # a block asks for an n-gram of a length once, so for no more than its tokens
        texts, answers, buckets, stats = part(0).select("block", "payload").groupBy("block"), None, [], None
        for k in range(order):
            asked = texts.cogroup(answers.groupBy("block")).applyInArrow(_ask(k, buckets, many), ASKED) if k else part(1).select("block", "payload").mapInArrow(_ask_words(many), ASKED)
            one = scratch.save(asked.groupBy("bucket").applyInArrow(_answer(k + 1, many), ANSWER), f"answers{k + 1}")
            if not k:
                stats = one.agg(F.sum("tokens").alias("t"), F.sum("kinds").alias("k")).first()
                scratch.drop("blocks/part=1")
            one = one.select("block", "n", "bucket", "answer")
            answers, buckets = answers.unionByName(one) if k else one, [*buckets, many]
            del asked
            scratch.release()
        n_all, n_kinds = stats.t or 0, stats.k or 0
        scored = texts.cogroup(answers.groupBy("block")).applyInArrow(_score(order, buckets, n_all, n_kinds, mass), SCORES)
        return scratch.result(scored.withColumn("train_tokens", F.lit(n_all).cast("long")))
