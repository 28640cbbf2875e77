"""Quality by random Fourier features, ridge regression and isotonic calibration.

Every text is summed up in a few statistics. Random Fourier features of the standardised statistics approximate a
Gaussian kernel; ridge regression on them needs only the sums Z'Z and Z'y, which partitions
compute on their own and which are then added up. Scores on rows that the ridge has not seen are
calibrated to probabilities by isotonic regression.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.scratch import Scratch, Shipped
from inkwell.llm.words import NOT_SPACE, chunks, scan, text_bytes

#: Fourier features, kernel width in standard deviations a statistic, ridge penalty a row, steps of the calibration grid.
FEATURES, WIDTH, PENALTY, GRID = 256, 1.0, 1e-3, 2000
CODES = np.arange(256)
CLASSES = {
    "upper": (CODES >= 65) & (CODES <= 90),
    "lower": (CODES >= 97) & (CODES <= 122),
    "digit": (CODES >= 48) & (CODES <= 57),
    "high": CODES >= 128,
    "space": ~NOT_SPACE,
    "line": CODES == 10,
    "stop": np.isin(CODES, [ord(c) for c in ".,;:?"]),
    "bang": CODES == ord("!"),
    "mark": np.isin(CODES, [ord(c) for c in "#$%&*+/<=>@\\^_`{|}~[]()"]),
}
STATS = [*CLASSES, "log_bytes", "log_words", "word_length", "word_spread", "distinct", "repeated", "line_words", "stop_words"]


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of ``STATS`` for each text: shares of byte classes, lengths, distinct and repeated words. A text without words has zeros."""
    w = scan(data, off)
    n_bytes, n = np.diff(off).astype(float), np.diff(w.first).astype(float)
    some, words = np.maximum(n_bytes, 1), np.maximum(n, 1)
    total = lambda x, cut: np.diff(np.concatenate([[0], np.cumsum(x)])[cut])
    cols = [total(of[data], off) / some for of in CLASSES.values()]
    length = total(w.length, w.first) / words
    square = total(w.length.astype(float) ** 2, w.first) / words
    again = np.append(False, w.hashes[1:] == w.hashes[:-1]) if len(w.hashes) else np.zeros(0, bool)
    again[w.first[:-1][w.first[:-1] < len(again)]] = False
    kinds = np.array([len(np.unique(w.hashes[a:b])) for a, b in zip(w.first[:-1], w.first[1:], strict=True)], float)
    lines = cols[5] * some + 1
    stops = cols[6] * some + 1
    cols += [np.log1p(n_bytes), np.log1p(n), np.log1p(length), np.log1p(np.sqrt(np.maximum(square - length**2, 0))), kinds / words, total(again, w.first) / words, np.log1p(n / lines), np.log1p(n / stops)]
    return np.stack(cols, 1) if len(n) else np.zeros((0, len(STATS)))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = text_bytes(batch.column(1))
        for i, j in chunks(off):
            x = statistics(data[off[i] : off[j]], off[i : j + 1] - off[i])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *(pa.array(c) for c in np.ascontiguousarray(x.T))], names=["doc_id", *STATS])


def statistics_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_statistics, "doc_id long, " + ", ".join(f"{c} double" for c in STATS))


class Fourier:
    """cos(Wx + b) of standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int, features: int = FEATURES, width: float = WIDTH):
        draw = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.w = draw.normal(0, 1 / (width * np.sqrt(len(mean))), (len(mean), features))
        self.b = draw.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8) @ self.w + self.b
        return np.concatenate([np.ones((len(x), 1)), np.cos(z) * np.sqrt(2 / len(self.b))], 1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATS], 1)


def _sums(fourier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f: Fourier = fourier.value
        k = len(f.b) + 1
        a, b = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            z, y = f(_matrix(batch)), batch.column("y").to_numpy(zero_copy_only=False)
            a += z.T @ z
            b += z.T @ y
        full = np.concatenate([a, b[:, None]], 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(full.tolist(), pa.list_(pa.float64()))], names=["i", "row"])

    return run


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Values of the non-decreasing step function nearest to ``y`` at sorted ``x``, by pooling adjacent violators."""
    value, mass, size = [], [], []
    for v, m in zip(y.tolist(), weight.tolist(), strict=True):
        value.append(v)
        mass.append(m)
        size.append(1)
        while len(value) > 1 and value[-2] >= value[-1]:
            m = mass[-2] + mass[-1]
            value[-2:] = [(value[-2] * mass[-2] + value[-1] * mass[-1]) / m]
            size[-2:] = [size[-2] + size[-1]]
            mass[-2:] = [m]
    return np.repeat(value, size)


class Model:
    def __init__(self, fourier: Fourier, beta: np.ndarray, at: np.ndarray, level: np.ndarray):
        self.fourier, self.beta, self.at, self.level = fourier, beta, at, level

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.beta

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.level), 0, 1) if len(self.at) else np.clip(self.raw(x), 0, 1)


def fit(stats: DataFrame, labels: DataFrame, train: str, calibrate: str, id_col: str = "doc_id", label_col: str = "quality", seed: int = 7) -> Model:
    """Ridge on the labelled rows where ``train`` holds, calibration on those where ``calibrate`` holds: all of them, by sums. Rows without label or id take no part."""
    spark = stats.sparkSession
    y = labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y"))
    rows = stats.join(y, "doc_id")
    known = rows.filter(F.expr(train))
    moments = known.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"), *[F.avg(c).alias(f"m_{c}") for c in STATS], *[F.stddev_pop(c).alias(f"s_{c}") for c in STATS]).first()
    k, n = FEATURES + 1, moments.n
    if not n:
        return Model(Fourier(np.zeros(len(STATS)), np.ones(len(STATS)), seed), np.eye(k)[0] * 0.5, np.zeros(0), np.zeros(0))
    fourier = Fourier(np.array([moments[f"m_{c}"] for c in STATS]), np.array([moments[f"s_{c}"] for c in STATS]), seed)
    shared = Shipped(spark, fourier)
    parts = known.select(*STATS, "y").mapInArrow(_sums(shared), "i long, row array<double>")
    cell = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    full = np.zeros((k, k + 1))
    for r in cell:
        full[r.i, r.j] = r.v
    beta = np.linalg.solve(full[:, :k] + PENALTY * n * np.eye(k) / k, full[:, k])
    model = Model(fourier, beta, np.zeros(0), np.zeros(0))
    shared = Shipped(spark, model)
    held = rows.filter(F.expr(calibrate)).select("doc_id", *STATS, "y").mapInArrow(_apply(shared, raw=True), "doc_id long, score double, y double")
    step = F.round(F.least(F.greatest(F.col("score"), F.lit(-0.5)), F.lit(1.5)) * (GRID / 2))
    bins = sorted((r.b / (GRID / 2), r.y, r.n) for r in held.groupBy(step.alias("b")).agg(F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")).collect())
    if bins:
        at, ys, ns = (np.array(c, float) for c in zip(*bins, strict=True))
        model = Model(fourier, beta, at, isotonic(at, ys, ns))
    return model


def _apply(model, raw: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            x = _matrix(batch)
            out = [batch.column("doc_id"), pa.array((m.raw if raw else m)(x))]
            yield pa.RecordBatch.from_arrays([*out, batch.column("y")] if raw else out, names=["doc_id", "score", "y"][: 2 + raw])

    return run


def score(docs: DataFrame, labels: DataFrame, train: str, calibrate: str, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id and score (0 to 1, the calibrated chance that ``label_col`` is 1) of every row.

    The whole text counts. A null, empty or blank text has statistics of zero and is scored on them. Rows that
    repeat one another score the same. Without labelled rows every score is 0.5. An empty table gives no
    rows. Nothing but the text is an input of a score.
    """
    spark = docs.sparkSession
    with Scratch(spark, "quality") as scratch:
        stats = scratch.save(statistics_table(docs, id_col, text_col), "stats")
        model = fit(stats, labels, train, calibrate, id_col, label_col)
        return scratch.result(stats.mapInArrow(_apply(Shipped(spark, model)), "doc_id long, score double"))
