"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

Every sentence gets a probability from the words and word beginnings it holds; a document's is
their noisy-or, 1 - prod(1 - p). Only documents are labelled, so the likelihood of the labels
under the noisy-or trains the sentence model, which then also says which sentences offend.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.scratch import Scratch, Shipped
from inkwell.llm.words import ALNUM, U64, Words, chunks, mix, scan, text_bytes

#: Bounds of the labelled rows that training sees (those with the least md5 of their id), and of their texts' bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 32 << 20
#: Slots of hashed features; lengths in bytes of the word beginnings used beside whole words.
SLOTS, PREFIXES = 1 << 18, (4, 5, 6)
#: Steps and rate of the descent, its decay; documents that must hold a slot, and by how many standard deviations toxic ones must hold it more often.
ROUNDS, RATE, DECAY, RARE, SIGMAS = 200, 0.5, 1e-4, 3, 4.25
ENDS = np.isin(np.arange(256), [ord(c) for c in ".!?\n"])


def features(w: Words) -> np.ndarray:
    """Slots of each word's features, a row per word: the word, then its beginnings (the word's own slot again where it is shorter)."""
    out = np.empty((len(w.hashes), 1 + len(PREFIXES)), np.int32)
    out[:, 0] = (w.hashes & U64(SLOTS - 1)).astype(np.int32)
    code = np.zeros(len(w.hashes), U64)
    for k in range(max(PREFIXES)):
        some = np.flatnonzero(w.length > k)
        code[some] |= w.data[w.start[some] + k].astype(U64) << U64(8 * k)
        if k + 1 in PREFIXES:
            slot = (mix(code + U64((k + 1) << 56)) & U64(SLOTS - 1)).astype(np.int32)
            out[:, 1 + PREFIXES.index(k + 1)] = np.where(w.length >= k + 1, slot, out[:, 0])
    return out


def sentences(w: Words, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of every sentence that has words, and its text."""
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.flatnonzero(ENDS[w.data])
    nth = np.searchsorted(ends, w.start)
    text = np.searchsorted(w.first, np.arange(len(w.start)), "right") - 1
    new = np.append(True, (nth[1:] != nth[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    return first, text[first]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Model:
    """weights by slot, bias of a sentence."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def sentence_logits(self, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not len(first):
            return np.zeros(0)
        return np.add.reduceat(self.weights[slots].sum(1, dtype=np.float64), first) + self.bias


def train(slots: list[np.ndarray], first: list[np.ndarray], y: np.ndarray) -> Model:
    """Documents as arrays of word slots and of their sentences' first words."""
    words = np.array([len(s) for s in slots])
    y = y[words > 0]
    slots, first = [s for s in slots if len(s)], [f for f, n in zip(first, words, strict=True) if n]
    if not len(slots) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(SLOTS), 5.0 if rate > 0.5 else -12.0)
    begin = np.concatenate([[0], np.cumsum(words[words > 0])])[:-1]
    x = np.asfortranarray(np.concatenate(slots))
    sent = np.concatenate([f + b for f, b in zip(first, begin, strict=True)])
    doc_first = np.concatenate([[0], np.cumsum([len(f) for f in first])])[:-1]
    per_doc = np.diff(np.append(doc_first, len(sent)))
    # Only slots that toxic documents have far more often than chance take a weight: most words of a bag say nothing, and together they would be learned by heart.
    spread, toxic = np.zeros(SLOTS), np.zeros(SLOTS)
    for own, label in zip(slots, y.tolist(), strict=True):
        held = np.unique(own)
        spread[held] += 1
        toxic[held] += label
    rate = y.mean()
    usable = (spread >= RARE) & (toxic - spread * rate >= SIGMAS * np.sqrt(spread * rate * (1 - rate)))
    del slots
    word, column = np.nonzero(usable[x])
    slot, of = x[word, column], np.searchsorted(sent, word, "right") - 1  # what is left of the words: slots and their sentences
    del x
    weights, bias = np.zeros(SLOTS), -np.log(len(sent) / max(y.sum(), 1))
    sum_w, sum_b = np.full(SLOTS, 1e-6), 1e-6
    pull = np.where(y == 1, 0.5 / max(rate, 1e-6), 0.5 / max(1 - rate, 1e-6)) ** 0.5
    for _ in range(ROUNDS):
        z = np.bincount(of, weights[slot], len(sent)) + bias
        total = np.add.reduceat(_softplus(z), doc_first)  # -log(1 - p) of the noisy-or
        push = np.where(y == 1, -1 / np.expm1(np.clip(total, 1e-9, 500)), 1.0) * pull
        g = _sigmoid(z) * np.repeat(push, per_doc)
        grad = np.where(usable, np.bincount(slot, g[of], SLOTS) / len(y) + DECAY * weights, 0)
        sum_w += grad**2
        weights -= RATE * grad / np.sqrt(sum_w)
        gb = g.sum() / len(y)
        sum_b += gb**2
        bias -= RATE * gb / np.sqrt(sum_b)
    return Model(weights, bias)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = text_bytes(batch.column(0))
        for i, j in chunks(off):
            w = scan(data[off[i] : off[j]], off[i : j + 1] - off[i], ALNUM)
            slots, (first, text) = features(w), sentences(w, off)
            cut = np.searchsorted(text, np.arange(j - i + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([slots[w.first[k] : w.first[k + 1]].tobytes() for k in range(j - i)], pa.binary()),
                    pa.array([(first[cut[k] : cut[k + 1]] - w.first[k]).astype("<i4").tobytes() for k in range(j - i)], pa.binary()),
                    batch.column(1).slice(i, j - i),
                ],
                names=["slots", "first", "y"],
            )


def fit(docs: DataFrame, labels: DataFrame, fold: str, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """Train on at most ``rows`` labelled documents, and ``SAMPLE_BYTES`` of text or one document, for which ``fold`` holds: a bounded sample, the same in every run.

    Rows without label or id do not train. Of rows that repeat an id the least text does, with the greatest label.
    """
    spark = docs.sparkSession
    chosen = labels.filter(F.expr(fold)).filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    chosen = chosen.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y")).orderBy(F.md5(F.col("k").cast("string")), "k", "y").limit(rows).collect()
    if not chosen:
        return Model(np.zeros(SLOTS), -12.0)
    picked = spark.createDataFrame(chosen, "k long, y int").groupBy("k").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(id_col).alias("k"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked), "k")  # no more than ``rows`` rows
    with Scratch(spark, "toxicity") as scratch:
        texts = scratch.save(texts.groupBy("k", "y").agg(F.min("text").alias("text")), "sample")
        sizes = sorted((hashlib.md5(str(r.k).encode()).hexdigest(), r.k, r.n) for r in texts.select("k", F.octet_length("text").alias("n")).collect())
        held = np.cumsum([n for _, _, n in sizes])
        used = [k for (_, k, _), n in zip(sizes, held.tolist(), strict=True) if n <= max(SAMPLE_BYTES, held[0])]
        texts = texts.filter(F.col("k").isin(used)) if len(used) < len(sizes) else texts
        got = [(bytes(r.slots), bytes(r.first), r.y) for r in texts.select("text", "y").mapInArrow(_examples, "slots binary, first binary, y int").toLocalIterator()]
    got.sort()
    width = 1 + len(PREFIXES)
    return train([np.frombuffer(s, np.int32).reshape(-1, width) for s, _, _ in got], [np.frombuffer(f, "<i4").astype(np.int64) for _, f, _ in got], np.array([y for _, _, y in got]))


SCHEMA = "doc_id long, score double, offending array<int>"
ARROW = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("offending", pa.list_(pa.int32()))])


def _apply(model, carried: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for i, j in chunks(off):
                w = scan(data[off[i] : off[j]], off[i : j + 1] - off[i], ALNUM)
                first, text = sentences(w, off)
                z = m.sentence_logits(features(w), first)
                total = np.bincount(text, _softplus(z), j - i)
                where: list = [[]] * (j - i)
                cut = np.searchsorted(text, np.arange(j - i + 1))
                for d in np.unique(text[z >= 0]).tolist():
                    where[d] = np.flatnonzero(z[cut[d] : cut[d + 1]] >= 0).tolist()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(-np.expm1(-total)), pa.array(where, pa.list_(pa.int32())), *[batch.column(c).slice(i, j - i) for c in range(2, 2 + carried)]], names=[*ARROW.names, *batch.schema.names[2:]])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score (0 to 1), offending (numbers of the sentences that have words and a probability of 0.5 or more) of every row, and ``carry`` as ``kept_<name>``.

    The whole text counts. A null or empty text, or one without words, has no sentence and scores 0. Rows that
    repeat one another score the same. An empty table gives no rows. No column but the text is an input.
    """
    shared = Shipped(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *[F.col(c).alias(f"kept_{c}") for c in carry])
    kinds = "".join(f", kept_{c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(_apply(shared, len(carry)), SCHEMA + kinds)


def reject(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns as they are."""
    shared, at = Shipped(docs.sparkSession, model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            data, off = text_bytes(batch.column(at).fill_null(""))
            for i, j in chunks(off):
                w = scan(data[off[i] : off[j]], off[i : j + 1] - off[i], ALNUM)
                first, text = sentences(w, off)
                total = np.bincount(text, _softplus(m.sentence_logits(features(w), first)), j - i)
                yield batch.slice(i, j - i).filter(pa.array(-np.expm1(-total) < threshold))

    return docs.mapInArrow(run, docs.schema)
