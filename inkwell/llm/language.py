"""Language by hierarchical discrimination: first the family, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.scratch import Scratch, Shipped
from inkwell.llm.words import LOWER, U64, chunks, give_back, mix, text_bytes

#: ISO 639-1 codes by family. A language that stands nowhere is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl no nb nn sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk tr uz",
}
#: Bound of the rows that train a machine's side; slots of hashed byte triples; steps and penalty of the descent; texts whose profiles stand in memory at once.
SAMPLE_ROWS, SLOTS, STEPS, PENALTY, TEXTS = 1500, 4096, 150, 1e-4, 256
UNKNOWN = "und"


def family(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes.split()), lang)


ASCII_LETTER = ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | ((np.arange(256) >= 65) & (np.arange(256) <= 90))
#: Bytes that no letter has count as one blank.
BLANKED = np.where(ASCII_LETTER | (np.arange(256) >= 128), LOWER, 32).astype(np.uint8)


def profile(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Square roots of byte-triple counts, scaled to length 1: a row per text. Triples do not cross texts."""
    n = len(off) - 1
    out = np.zeros((n, SLOTS), np.float32)
    if len(data) >= 3:
        b = BLANKED[data].astype(np.uint32)
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        text = np.repeat(np.arange(n), np.diff(off))
        same = (text[:-2] == text[2:]) & (code != 0x202020)
        slot = (mix(code[same].astype(U64)) & U64(SLOTS - 1)).astype(np.int64)
        out = np.sqrt(np.bincount(text[:-2][same] * SLOTS + slot, minlength=n * SLOTS).reshape(n, SLOTS)).astype(np.float32)
    norm = np.sqrt((out**2).sum(1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(ASCII_LETTER[data])])
    out = total[off[1:]] > total[off[:-1]]
    for i in np.flatnonzero(~out & (np.diff(off) > 0)).tolist():
        out[i] = any(c.isalpha() for c in data[off[i] : off[i + 1]].tobytes().decode("utf-8", "ignore"))
    return out


def svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (a bias last) of a linear machine with squared hinge loss, both classes of equal weight; y is -1 or 1."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, momentum, ahead = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    for t in range(STEPS):
        slack = np.maximum(1 - y * (x @ ahead), 0).astype(np.float32)
        after = ahead - 0.4 * (PENALTY * ahead - 2 * ((slack * share * y) @ x))
        momentum, w = after - w, after
        ahead = w + (t / (t + 3)) * momentum
    return w


class Model:
    def __init__(self, langs: list[str], machines: dict[tuple, np.ndarray]):
        self.langs, self.machines = langs, machines
        self.families = sorted({family(x) for x in langs})

    @staticmethod
    def _vote(x: np.ndarray, names: list[str], machines: dict[tuple, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``names``, confidence) by one-versus-one votes; margins settle ties."""
        votes, least = np.zeros((len(x), len(names))), np.full((len(x), len(names)), np.inf)
        for (a, b), w in machines.items():
            i, j = names.index(a), names.index(b)
            m = x @ w[:-1] + w[-1]
            for k, s in ((i, m), (j, -m)):
                votes[:, k] += (s >= 0) + 1e-3 * np.tanh(s)
                least[:, k] = np.minimum(least[:, k], s)
        best = votes.argmax(1)
        margin = least[np.arange(len(x)), best]
        return best, np.where(np.isinf(margin), 1.0, 1 / (1 + np.exp(-np.clip(3 * margin, -30, 30))))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        top, sure = self._vote(x, self.families, {k[1:]: w for k, w in self.machines.items() if k[0] == "family"})
        out, score = np.empty(len(x), object), np.zeros(len(x))
        for k, name in enumerate(self.families):
            rows = np.flatnonzero(top == k)
            own = [v for v in self.langs if family(v) == name]
            best, s = self._vote(x[rows], own, {m[1:]: w for m, w in self.machines.items() if m[0] == name})
            out[rows], score[rows] = np.array(own, object)[best], sure[rows] * s
        return out.tolist(), score


def pairings(langs: list[str]) -> list[tuple[str, str, str]]:
    """The machines that the languages need: families against families, and languages against one another within a family."""
    families = sorted({family(v) for v in langs})
    out = [("family", a, b) for a, b in combinations(families, 2)]
    return out + [(name, a, b) for name in families for a, b in combinations([v for v in langs if family(v) == name], 2)]


SAMPLE = "at long, lang string, slots binary, weights binary"
SAMPLE_ARROW = pa.schema([("at", pa.int64()), ("lang", pa.string()), ("slots", pa.binary()), ("weights", pa.binary())])


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (at, lang, text) with their profiles, of which only the slots in use are kept."""
    for batch in batches:
        data, off = text_bytes(batch.column(2))
        for i, j in chunks(off, rows=TEXTS):
            x = profile(data[off[i] : off[j]], off[i : j + 1] - off[i])
            used = [np.flatnonzero(r) for r in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array([u.astype("<u2").tobytes() for u in used], pa.binary()), pa.array([r[u].astype("<f2").tobytes() for r, u in zip(x, used, strict=True)], pa.binary())],
                schema=SAMPLE_ARROW,
            )
    give_back()


MACHINE = "machine int, weights binary"


def _train(table: pa.Table) -> pa.Table:
    """A machine's rows, in an order that does not depend on how they came, to its weights."""
    table = table.sort_by([("y", "ascending"), ("lang", "ascending"), ("at", "ascending")])
    x = np.zeros((table.num_rows, SLOTS), np.float32)
    for row, slots, weights in zip(x, table.column("slots"), table.column("weights"), strict=True):
        row[np.frombuffer(slots.as_py(), "<u2")] = np.frombuffer(weights.as_py(), "<f2")
    w = svm(x, table.column("y").to_numpy().astype(np.float32))
    del x
    give_back()
    return pa.table({"machine": table.column("machine").slice(0, 1).cast(pa.int32()), "weights": pa.array([w.astype("<f4").tobytes()], pa.binary())})


def fit(docs: DataFrame, fold: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> Model:
    """Train on the rows with text and language where ``fold`` holds: of each language about ``rows`` at most, those whose hash of id and text is least; rows that repeat both are one.

    Each machine trains in a task of its own, on about ``rows`` rows a side (a family's languages share them). The
    driver gets the weights alone.
    """
    spark = docs.sparkSession
    at = F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), 32)
    known = docs.filter(F.expr(fold)).filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(at.alias("at"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    with Scratch(spark, "language") as scratch:
        limits = known.groupBy("lang").agg((F.least(F.lit(1.0), F.lit(rows) / F.approx_count_distinct("at")) * 2.0**32).alias("limit"))
        some = known.join(scratch.save(limits, "limits"), "lang").filter(F.col("at") < F.col("limit")).groupBy("lang", "at").agg(F.min("text").alias("text"))
        sample = scratch.save(some.select("at", "lang", "text").mapInArrow(_profiles, SAMPLE), "sample")
        langs = sorted(r.lang for r in sample.select("lang").distinct().collect())
        named = pairings(langs)
        if not named:
            return Model(langs or [UNKNOWN], {})
        sides = []
        for m, (name, a, b) in enumerate(named):
            for side, y in ((a, 1), (b, -1)):
                own = [v for v in langs if family(v) == side] if name == "family" else [side]
                sides += [(m, v, y, len(own)) for v in own]
        sides = spark.createDataFrame(sides, "machine int, lang string, y int, share int")
        got = sample.join(sides, "lang").filter("at % share = 0").groupBy("machine").applyInArrow(_train, MACHINE).collect()
    weights = {named[r.machine]: np.frombuffer(r.weights, "<f4") for r in got}
    # A family whose few rows all fell to others' shares has no machine, and no row speaks for or against it.
    return Model(langs, {k: weights[k] for k in named if k in weights})


def _apply(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for i, j in chunks(off, rows=TEXTS):
                part, cut = data[off[i] : off[j]], off[i : j + 1] - off[i]
                lang, score = m.predict(profile(part, cut))
                ok = has_letter(part, cut)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([v if k else UNKNOWN for v, k in zip(lang, ok, strict=True)], pa.string()), pa.array(np.where(ok, score, 0.0))], names=["doc_id", "lang_pred", "score"])
        give_back()

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1: family's times language's confidence) of every row.

    The whole text counts and nothing else does. A null text, or one without a letter, is ``und`` with score
    0. Rows that repeat one another get the same. Without training rows all are ``und``. An empty table gives no rows.
    """
    shared = Shipped(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_apply(shared), "doc_id long, lang_pred string, score double")
