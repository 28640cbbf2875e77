"""Layered settings: layers merged by key, and every fault as a row.

An entry is (scope, key, value as text) in a layer; a later layer hides an earlier one, and in a layer the entry with the
greater ``seq``. What a key may hold is a rule, and checking reports all that is wrong, with the layer it
comes from, in place of the first error alone.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import policy

ENTRY = "scope string, key string, value string, layer int, seq long"
EMAIL, URL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$", r"^https?://[^\s/]+.*$"


@dataclass(frozen=True)
class Rule:
    """What a key may hold. ``kind``: text, integer, number, boolean or list (a JSON array of texts)."""

    kind: str = "text"
    required: bool = False
    low: float | None = None
    high: float | None = None
    among: tuple[str, ...] = ()
    pattern: str | None = None
    default: object = None

    def fault(self, value: Column) -> Column:
        """What is wrong with a value that is there, else null."""
        number = F.trim(value).try_cast("double")
        parsed = {"integer": F.trim(value).rlike(r"^[+-]?\d+$"), "number": number.isNotNull() & ~F.isnan(number), "boolean": value.isin("true", "false"), "list": F.from_json(value, "array<string>").isNotNull()}
        out = F.when(~F.coalesce(parsed[self.kind], F.lit(False)), f"no {self.kind}") if self.kind in parsed else F.when(F.lit(False), "")
        if self.low is not None:
            out = out.when(number < self.low, f"below {self.low:g}")
        if self.high is not None:
            out = out.when(number > self.high, f"above {self.high:g}")
        if self.among:
            out = out.when(~value.isin(*self.among), "not one of " + ", ".join(self.among))
        if self.pattern:
            out = out.when(~value.rlike(self.pattern), "not of its form")
        return out


def resolve(entries: DataFrame) -> DataFrame:
    """``scope, key, value, layer`` of the entry that counts for each scope and key. Entries without a value hide nothing; of entries that tie in layer and seq, the greatest value counts."""
    best = F.max(F.struct("layer", "seq", "value"))
    return entries.filter("value IS NOT NULL").groupBy("scope", "key").agg(best.alias("b")).select("scope", "key", "b.value", "b.layer")


def faults(resolved: DataFrame, rules: Mapping[str, Rule], scopes: DataFrame | None = None) -> DataFrame:
    """``scope, key, value, layer, fault``: values against their rules, keys without a rule, and (for ``scopes``, else those that have an entry) required keys without a value."""
    known = F.col("key").isin(*rules)
    fault = F.when(~known, "unknown key")
    for key, rule in rules.items():
        fault = fault.when(F.col("key") == key, rule.fault(F.col("value")))
    wrong = resolved.select("scope", "key", "value", "layer", fault.alias("fault")).filter("fault IS NOT NULL")
    asked = [k for k, r in rules.items() if r.required]
    if not asked:
        return wrong
    all_ = (scopes if scopes is not None else resolved.select("scope")).distinct().select("scope", F.explode(F.array(*[F.lit(k) for k in asked])).alias("key"))
    lost = all_.join(resolved.select("scope", "key"), ["scope", "key"], "left_anti")
    return wrong.unionByName(lost.select("scope", "key", F.lit(None).cast("string").alias("value"), F.lit(None).cast("int").alias("layer"), F.lit("missing").alias("fault")))


# Settings of the daily run

_COUNT, _SHARE = Rule("integer", True, low=1), Rule("number", True, low=0, high=1)
_ENDPOINT = {"baseUrl": Rule(required=True, pattern=URL), "maxPapersPerBatch": _COUNT, "maxInputTokens": _COUNT, "maxTokens": _COUNT, "timeoutMs": _COUNT, "maxRetries": Rule("integer", True, low=0), "enableThinking": Rule("boolean", True)}
#: Groups of settings, their keys and what they may hold.
RULES = {
    "routing": _ENDPOINT,
    "digest": _ENDPOINT | {"maxFeatured": _COUNT, "spatialConfidenceThreshold": _SHARE, "overflowShowTitleZh": Rule("boolean", True)} | dict.fromkeys(("summarizeTimeoutMs", "summarizeFallbackTimeoutMs", "summarizeStageBudgetMs", "summarizeConcurrency", "summarizeFallbackConcurrency"), _COUNT) | {"summarizeMaxRetries": Rule("integer", True, low=0)},
    "email": {"fromEmail": Rule(required=True, pattern=EMAIL), "fromName": Rule(pattern=r"\S"), "subjectPrefix": Rule(required=True, pattern=r"\S"), "to": Rule("list", True)},
    "preprints": {"categories": Rule("list", True)},
}
#: The first layer.
DEFAULTS = {
    "digest": {"maxFeatured": policy.MAX_FEATURED, "spatialConfidenceThreshold": policy.CONFIDENCE, "overflowShowTitleZh": True, "enableThinking": False, "summarizeMaxRetries": 0},
    "routing": {"maxRetries": 0, "enableThinking": False},
}
#: Variables of the environment that are a layer of their own, after the files.
VARIABLES = {"DIGEST_FROM_EMAIL": ("email", "fromEmail"), "DIGEST_FROM_NAME": ("email", "fromName"), "DIGEST_SUBJECT_PREFIX": ("email", "subjectPrefix"), "DIGEST_TO_EMAIL": ("email", "to")}


def _text(value: object) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def entries(spark: SparkSession, files: list[Mapping[str, Mapping]], environment: Mapping[str, str] | None = None) -> DataFrame:
    """The layers of a run as rows: the defaults, each of ``files`` (group to settings), and the environment's variables, blank ones apart. Addresses there are separated by commas or white space."""
    rows = []
    for layer, groups in enumerate([DEFAULTS, *files]):
        rows += [(g, k, _text(v), layer, 0) for g, own in groups.items() for k, v in own.items()]
    for name, (group, key) in VARIABLES.items():
        value = (os.environ if environment is None else environment).get(name, "").strip()
        if value:
            rows.append((group, key, json.dumps([a for a in value.replace(",", " ").split() if a]) if key == "to" else value, len(files) + 1, 0))
    return spark.createDataFrame(rows, ENTRY)


class SettingsError(ValueError):
    """All faults, a line each."""


def settings(spark: SparkSession, group: str, files: list[Mapping[str, Mapping]], environment: Mapping[str, str] | None = None) -> dict[str, object]:
    """A group's settings with their types, or an error that names every fault. A few rows, collected."""
    own = resolve(entries(spark, files, environment).filter(F.col("scope") == group))
    rules = RULES[group]
    wrong = faults(own, rules, spark.createDataFrame([(group,)], "scope string")).orderBy("key").collect()
    if wrong:
        raise SettingsError("; ".join(f"{group}.{r.key}: {r.fault}" + (f" ({r.value}, layer {r.layer})" if r.value is not None else "") for r in wrong))
    return {r.key: r.value if rules[r.key].kind == "text" else json.loads(r.value) for r in own.collect()}
