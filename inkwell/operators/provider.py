"""Calls to a model provider: batches out, answers back, under budgets and retries.

A provider is a plain callable ``ask(ids, payload) -> text`` that may raise ``ProviderError``.
Everything it does not do itself is here, so it can be replaced in tests. Answers are
written before anything reads them: a paid call is not made again because a plan is run twice.
"""

from __future__ import annotations

import json
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.policy import USEFUL_MS, WAIT_DEFAULT_MS, WAIT_MAX_MS
from inkwell.operators.structured import first_object


class ProviderError(Exception):
    def __init__(self, kind: str, message: str = "", wait_ms: int | None = None):
        super().__init__(message or kind)
        self.kind, self.wait_ms = kind, wait_ms


@dataclass
class Stage:
    """State of one stage in one task: what is left of its time, and the breaker, whose first reason stays."""

    budget_ms: float
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    open_reason: str | None = None
    attempts: int = 0
    spacing_ms: float = 0
    started: float | None = None
    began: float = field(default=0.0)

    def __post_init__(self) -> None:
        self.began = self.clock()

    def left_ms(self) -> float:
        return self.budget_ms - (self.clock() - self.began) * 1000

    def trip(self, reason: str) -> None:
        self.open_reason = self.open_reason or reason

    def next_start(self) -> None:
        """Wait until ``spacing_ms`` have passed since the last request began; without the time for that the breaker opens."""
        wait = 0.0 if self.started is None else self.spacing_ms - (self.clock() - self.started) * 1000
        if wait > 0:
            if not self.can_wait(wait):
                self.trip("budget exhausted")
                raise ProviderError("breaker", self.open_reason)
            self.sleep(wait / 1000)
        self.started = self.clock()

    def can_wait(self, wait_ms: float) -> bool:
        return self.left_ms() >= wait_ms + USEFUL_MS


def ask_once(stage: Stage, ask: Callable[[list[str], str], str], ids: list[str], payload: str) -> str:
    """One request with the retry policy: a rate limit waits once, a server error a second once; time-outs, network and credentials open the breaker."""
    waited = 0
    while True:
        if stage.open_reason:
            raise ProviderError("breaker", stage.open_reason)
        if stage.left_ms() < USEFUL_MS:
            stage.trip("budget exhausted")
            raise ProviderError("breaker", stage.open_reason)
        stage.next_start()
        stage.attempts += 1
        try:
            return ask(ids, payload)
        except ProviderError as e:
            wait = min(WAIT_MAX_MS, e.wait_ms if e.wait_ms is not None else WAIT_DEFAULT_MS) if e.kind == "rate_limit" else 1000
            if e.kind in ("rate_limit", "server_error") and not waited and stage.can_wait(wait):
                waited = 1
                stage.sleep(wait / 1000)
                continue
            if e.kind in ("timeout", "network", "auth", "config"):
                stage.trip(e.kind)
            raise


def verdicts_of(text: str) -> dict[str, str]:
    """Verdicts by id, the last one of an id; raises if the answer is not valid as a whole."""
    found = first_object(text)
    try:
        rows = json.loads(found or "")["results"]
        out = {r["id"]: r["verdict"] for r in rows}
    except (ValueError, KeyError, TypeError) as e:
        raise ProviderError("parse", "no valid results") from e
    if not all(isinstance(k, str) and v in ("yes", "no", "not_sure") for k, v in out.items()):
        raise ProviderError("parse", "no valid results")
    return out


def _rows_of(text: str) -> list:
    try:
        rows = json.loads(first_object(text) or "")["results"]
    except (ValueError, KeyError, TypeError) as e:
        raise ProviderError("parse", "no valid results") from e
    if not isinstance(rows, list):
        raise ProviderError("parse", "no valid results")
    return rows


def confidences_of(text: str) -> dict[str, str]:
    """Confidences by id, as text; an id that comes twice, or whose confidence is none from 0 to 1, has none. Rows without an id make the answer invalid."""
    rows = _rows_of(text)
    if not all(isinstance(r, dict) and isinstance(r.get("id"), str) and r["id"] for r in rows):
        raise ProviderError("parse", "no valid results")
    seen = Counter(r["id"] for r in rows)
    sound = lambda c: isinstance(c, int | float) and not isinstance(c, bool) and 0 <= c <= 1
    return {r["id"]: repr(float(r["confidence"])) for r in rows if seen[r["id"]] == 1 and sound(r.get("confidence"))}


def titles_of(text: str) -> dict[str, str]:
    """Titles by id, trimmed: rows stand alone, and what is not text or blank is left out; an id that comes twice has none."""
    rows = [r for r in _rows_of(text) if isinstance(r, dict) and isinstance(r.get("id"), str)]
    seen = Counter(r["id"].strip() for r in rows)
    return {r["id"].strip(): r["title"].strip() for r in rows if isinstance(r.get("title"), str) and r["title"].strip() and seen[r["id"].strip()] == 1}


def json_mode(strict: Callable[[list[str], str], str], plain: Callable[[list[str], str], str]) -> Callable[[list[str], str], str]:
    """Ask in JSON mode until the provider says that it has none (kind ``json_mode``), and plainly from then on."""
    refused: list[bool] = []

    def ask(ids: list[str], payload: str) -> str:
        if not refused:
            try:
                return strict(ids, payload)
            except ProviderError as e:
                if e.kind != "json_mode":
                    raise
                refused.append(True)
        return plain(ids, payload)

    return ask


def classify(
    stage: Stage, ask: Callable[[list[str], str], str], items: list[tuple[str, str]], depth: int = 3, read: Callable[[str], dict[str, str]] = verdicts_of
) -> tuple[dict[str, str], dict[str, str]]:
    """(answers, failed ids with the kind of failure) of a batch of (id, payload); ``read`` finds the answers by id in what a stage is told.

    A long or unparsable answer splits the batch in halves, down to ``depth``. Ids missing from a good answer are asked
    once more (alone, or with their half of the batch where one is missing), and only those are taken from it.
    """
    if not items:
        return {}, {}
    ids = [i for i, _ in items]
    try:
        got = {k: v for k, v in read(ask_once(stage, ask, ids, _payload(items))).items() if k in set(ids)}
    except ProviderError as e:
        if e.kind in ("length", "parse") and depth > 0 and len(items) > 1:
            half = (len(items) + 1) // 2
            a, x = classify(stage, ask, items[:half], depth - 1, read)
            b, y = classify(stage, ask, items[half:], depth - 1, read)
            return a | b, x | y
        return {}, dict.fromkeys(ids, e.kind)
    lost = [i for i in ids if i not in got]
    if lost:
        half = (len(items) + 1) // 2
        again = [x for x in items if x[0] in lost] if len(lost) > 1 else items[:half] if lost[0] in ids[:half] else items[half:]
        try:
            more = read(ask_once(stage, ask, [i for i, _ in again], _payload(again)))
            got |= {i: more[i] for i in lost if i in more}
        except ProviderError:
            pass
    return got, {i: "missing" for i in ids if i not in got}


def _payload(items: list[tuple[str, str]]) -> str:
    return '{"papers":[' + ",".join(p for _, p in items) + "]}"


ANSWERS = "id string, value string, failure string"
ANSWERS_ARROW = pa.schema([("id", pa.string()), ("value", pa.string()), ("failure", pa.string())])


def run_stage(
    packed: DataFrame, ask: Callable[[list[str], str], str], read: Callable[[str], dict[str, str]], path: str, budget_ms: float = 300_000, depth: int = 3, concurrency: int = 2, spacing_ms: float = 0
) -> DataFrame:
    """``packed(batch, id, payload)`` to ``id, value, failure``, written to ``path`` and read back: the driver of any stage whose answers ``read`` finds by id.

    At most ``concurrency`` tasks call at a time, each with starts ``concurrency`` times ``spacing_ms`` apart, so all starts together keep to the
    spacing on average. Batches stream through a task in order, one held at a time; every id ends with a value or a failure.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stage, batch, items = Stage(budget_ms, spacing_ms=spacing_ms * concurrency), None, []

        def done() -> pa.RecordBatch:
            got, failed = classify(stage, ask, items, depth, read)
            return pa.RecordBatch.from_pylist([{"id": i, "value": got.get(i), "failure": failed.get(i)} for i, _ in items], schema=ANSWERS_ARROW)

        for part in parts:
            for b, i, p in zip(*(part.column(c).to_pylist() for c in ("batch", "id", "payload")), strict=True):
                if items and b != batch:
                    yield done()
                    items = []
                batch = b
                items.append((i, p))
        if items:
            yield done()

    packed.select("batch", "id", "payload").repartition(concurrency, "batch").sortWithinPartitions("batch").mapInArrow(run, ANSWERS).write.mode("overwrite").parquet(path)
    return packed.sparkSession.read.schema(ANSWERS).parquet(path)


def classify_batches(packed: DataFrame, ask: Callable[[list[str], str], str], path: str, budget_ms: float = 300_000, depth: int = 3, concurrency: int = 2, spacing_ms: float = 0) -> DataFrame:
    """``packed(batch, id, payload)`` to ``id, verdict, failure`` (see ``run_stage``)."""
    return run_stage(packed, ask, verdicts_of, path, budget_ms, depth, concurrency, spacing_ms).withColumnRenamed("value", "verdict")


def spatial_batches(packed: DataFrame, ask: Callable[[list[str], str], str], path: str, **more: float) -> DataFrame:
    """``id, confidence, failure``: a stage whose papers without a sound confidence fall back to their keywords."""
    return run_stage(packed, ask, confidences_of, path, **more).select("id", F.col("value").cast("double").alias("confidence"), "failure")


def translate_batches(packed: DataFrame, ask: Callable[[list[str], str], str], path: str, **more: float) -> DataFrame:
    """``id, title, failure``."""
    return run_stage(packed, ask, titles_of, path, **more).withColumnRenamed("value", "title")


def stage_counts(answers: DataFrame, value: str) -> DataFrame:
    """requested, answered, failed, and failures by kind as a map, of a stage's rows."""
    kinds = answers.groupBy("failure").agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("got"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    by = F.sort_array(F.collect_list(F.when(F.col("failure").isNotNull(), F.struct("failure", "n"))))
    return kinds.agg(total("n").alias("requested"), total("got").alias("answered"), (total("n") - total("got")).alias("failed"), F.map_from_entries(by).alias("kinds"))


def cascade(primary: DataFrame, fallback: Callable[[DataFrame], DataFrame], requested: DataFrame, key: str = "id") -> DataFrame:
    """Results of ``primary``; those of ``fallback`` over the requested rows that it left open. ``by`` says who answered."""
    done = primary.withColumn("by", F.lit("primary"))
    rest = fallback(requested.join(primary.select(key), key, "left_anti")).withColumn("by", F.lit("fallback"))
    return done.unionByName(rest)
