"""Counters of stages, gathered while rows pass, that merge across stages and runs.

A counter is a kind (sum, least or greatest) and a value; counters of one kind and name merge in any order and grouping, and a stage that did
not run adds nothing. Values come from ``DataFrame.observe``, so a stage's rows are counted by the job that
uses them and by no second scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from inkwell.operators.routing import count_if

SCHEMA = "run string, stage string, counter string, kind string, value long"
MERGE = {"sum": lambda a, b: a + b, "least": min, "greatest": max}


@dataclass(frozen=True)
class Counters:
    """Values by (stage, counter) with their kind: a commutative monoid under ``+``, whose neutral element is ``Counters()``."""

    values: dict[tuple[str, str], tuple[str, int]] = field(default_factory=dict)

    def __add__(self, other: Counters) -> Counters:
        out = dict(self.values)
        for name, (kind, value) in other.values.items():
            if name not in out:
                out[name] = (kind, value)
                continue
            if out[name][0] != kind:
                raise ValueError(f"{'/'.join(name)} is both {out[name][0]} and {kind}")
            out[name] = (kind, MERGE[kind](out[name][1], value))
        return Counters(out)

    @staticmethod
    def total(all_: Iterable[Counters]) -> Counters:
        out = Counters()
        for c in all_:
            out = out + c
        return out

    def rows(self, run: str) -> list[tuple[str, str, str, str, int]]:
        return [(run, stage, name, kind, value) for (stage, name), (kind, value) in sorted(self.values.items())]

    def frame(self, spark: SparkSession, run: str) -> DataFrame:
        return spark.createDataFrame(self.rows(run), SCHEMA)


class Stage:
    """Counts of one stage: ``rows`` always, ``sums`` by condition (rows that meet it) or number, ``least`` and ``greatest`` of columns."""

    def __init__(self, name: str, sums: dict[str, Column] | None = None, least: dict[str, Column] | None = None, greatest: dict[str, Column] | None = None):
        self.name, self.seen = name, Observation()
        self.kinds = {"rows": "sum", **dict.fromkeys(sums or {}, "sum"), **dict.fromkeys(least or {}, "least"), **dict.fromkeys(greatest or {}, "greatest")}
        self.columns = [F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(k) for k, c in (sums or {}).items()]]
        self.columns += [f(c.cast("long")).alias(k) for f, own in ((F.min, least), (F.max, greatest)) for k, c in (own or {}).items()]

    def of(self, df: DataFrame) -> DataFrame:
        """``df``, counted where it passes. It must be run whole, and once: rows that a limit leaves unread, or that a retry of a job reads again, are not told apart."""
        return df.observe(self.seen, *self.columns)

    def counters(self) -> Counters:
        """What was counted, once a job has run over ``of(df)``; a least or greatest of no value is absent."""
        got = self.seen.get
        return Counters({(self.name, k): (kind, int(got[k])) for k, kind in self.kinds.items() if got.get(k) is not None})


def merged(counters: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows as in ``SCHEMA`` of any runs, merged: by stage and counter, or by the columns named. Sums do not meet leasts: a counter of two kinds is an error."""
    keys = by or ["stage", "counter"]
    value = F.when(F.min("kind") != F.max("kind"), F.raise_error(F.lit("a counter of two kinds")).cast("long"))
    value = value.when(F.min("kind") == "sum", F.sum("value")).when(F.min("kind") == "least", F.min("value")).otherwise(F.max("value"))
    return counters.groupBy(*keys).agg(F.min("kind").alias("kind"), value.alias("value"))


def tagging_stage(name: str = "tagging") -> Stage:
    """Counters of papers with line and line_method: by method and line, what a fallback tagged, and rows left without a line."""
    on = lambda method, line: (F.col("line_method") == method) & (F.col("line") == line)
    sums = {f"{m}_{x.replace('-', '_')}": F.coalesce(on(m, x), F.lit(False)) for m in ("llm", "keyword-fallback") for x in ("line-a", "line-b")}
    return Stage(name, {k.replace("-", "_"): v for k, v in sums.items()} | {"failed": F.col("line").isNull()})


def attempt_counters(attempts: DataFrame) -> DataFrame:
    """Stage diagnostics of an attempt log (stage, outcome, retry, wait_ms), as rows of counters: requests, retries, failures by outcome's group, waiting time and the longest wait."""
    d = attempts.groupBy("stage").agg(
        F.count(F.lit(1)).alias("requests"), count_if(F.col("retry") > 0, "retries"), count_if(F.col("outcome") == "ok", "answered"), count_if(F.col("outcome") != "ok", "failed"),
        F.coalesce(F.sum("wait_ms"), F.lit(0)).cast("long").alias("waited_ms"), F.max("wait_ms").cast("long").alias("longest_ms"),
    )
    names = ["requests", "retries", "answered", "failed", "waited_ms", "longest_ms"]
    one = F.array(*[F.struct(F.lit(n).alias("counter"), F.lit("greatest" if n == "longest_ms" else "sum").alias("kind"), F.col(n).cast("long").alias("value")) for n in names])
    return d.select("stage", F.explode(one).alias("c")).select("stage", "c.*").filter("value IS NOT NULL")
