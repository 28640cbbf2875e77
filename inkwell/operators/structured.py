"""Salvage and validation of model-produced JSON."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.text import trim_space


def first_object(text: str | None) -> str | None:
    """The JSON object in a model's answer: what a code fence holds, else the first balanced braces, those of ``{"results"`` before others. Braces in strings do not count."""
    if text is None:
        return None
    body = text.strip()
    if body.startswith("```"):
        body = body.split("\n", 1)[1] if "\n" in body else ""
        body = body.rsplit("```", 1)[0].strip() if "```" in body else body
        if body.startswith("{") and (found := _balanced(body, 0)):
            return found
    preferred = body.find('{"results"')
    for start in ([preferred] if preferred >= 0 else []) + [body.find("{")]:
        if start >= 0 and (found := _balanced(body, start)):
            return found
    return None


def _balanced(text: str, start: int) -> str | None:
    depth, quoted, escaped = 0, False, False
    for i in range(start, len(text)):
        c = text[i]
        if escaped:
            escaped = False
        elif quoted:
            escaped, quoted = c == "\\", c != '"'
        elif c == '"':
            quoted = True
        elif c in "{}":
            depth += 1 if c == "{" else -1
            if depth == 0:
                return text[start : i + 1]
    return None


def _scan_objects(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(first_object)


def json_object(text: Column) -> Column:
    """``first_object`` as a column. Answers that are one plain object already never leave the JVM."""
    plain = F.trim(text)
    whole = F.startswith(plain, F.lit("{")) & F.endswith(plain, F.lit("}")) & F.try_parse_json(plain).isNotNull()
    return F.when(whole, plain).otherwise(F.pandas_udf(_scan_objects, "string")(text))


def answer_object(content: Column, reasoning: Column) -> Column:
    """struct(json, error): from the content, else from the reasoning text; the error says which of them was missing or had no object."""
    blank = lambda c: F.coalesce(F.length(F.trim(c)) == 0, F.lit(True))
    found = F.coalesce(F.when(~blank(content), json_object(content)), F.when(~blank(reasoning), json_object(reasoning)))
    error = F.when(found.isNotNull(), None).when(blank(content) & blank(reasoning), "no content").otherwise("no json object")
    return F.struct(found.alias("json"), error.alias("error"))


def verdict_rows(answers: DataFrame, json: str = "json", key: str = "batch") -> DataFrame:
    """``key, pos, id, verdict`` of the batches that are valid as a whole: every row has an id and one of the three verdicts."""
    rows = F.from_json(F.col(json), "results array<struct<id: string, verdict: string>>")["results"]
    ok = F.forall(rows, lambda r: F.coalesce((F.length(r["id"]) > 0) & r["verdict"].isin("yes", "no", "not_sure"), F.lit(False)))
    return answers.filter(rows.isNotNull() & ok).select(key, F.posexplode(rows).alias("pos", "r")).select(key, "pos", "r.id", "r.verdict")


def confidence_rows(rows: DataFrame, requested: DataFrame, key: str = "id") -> DataFrame:
    """``id, confidence, status`` for every requested id: ok, or why it falls back (missing, duplicate, invalid).

    An id that the answer has twice loses all its rows; ids that were not asked for do not count here (see ``unknown``).
    """
    seen = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first("confidence").alias("_c"))
    met = requested.select(key).join(seen, key, "left")
    valid = F.coalesce(~F.isnan("_c") & F.col("_c").between(0.0, 1.0), F.lit(False))
    status = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "duplicate").when(~valid, "invalid").otherwise("ok")
    return met.select(key, F.when(status == "ok", F.col("_c")).alias("confidence"), status.alias("status"))


def salvage_titles(answers: DataFrame, requested: DataFrame, batch: str = "batch", json: str = "json") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(titles, issues, summary) of batches ``(batch, json)`` against ``requested(batch, id)``.

    A batch fails whole if its JSON does not parse or has no array of results. Else rows stand alone: a row is
    invalid if its id or title is not text or is blank, unknown if its id was not asked for, and an id that comes
    up again is a duplicate: all its titles go, and its later rows are still checked. One summary row a batch.
    """
    parsed = answers.select(batch, F.try_parse_json(json).alias("v"))
    results = F.try_variant_get("v", "$.results", "array<variant>")
    batches = parsed.select(batch, F.col("v").isNull().alias("bad_json"), results.alias("results")).withColumn("failed", F.col("bad_json") | F.col("results").isNull())
    rows = batches.filter("NOT failed").select(batch, F.posexplode("results").alias("pos", "row"))
    text = lambda f: F.when(F.schema_of_variant(F.try_variant_get("row", f"$.{f}", "variant")) == "STRING", trim_space(F.try_variant_get("row", f"$.{f}", "string")))
    rows = rows.select(batch, "pos", text("id").alias("id"), text("title").alias("title"))
    rows = rows.join(requested.select(batch, "id", F.lit(True).alias("asked")), [batch, "id"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    nth = F.when(F.col("asked"), F.row_number().over(Window.partitionBy(batch, "id").orderBy("pos"))).otherwise(1)
    rows = rows.withColumn("again", nth > 1).withColumn("times", F.when(F.col("asked"), F.count(F.lit(1)).over(Window.partitionBy(batch, "id"))).otherwise(1))
    blank = lambda c: F.coalesce(F.length(F.col(c)) == 0, F.lit(True))
    kind = F.when(F.col("id").isNull() | F.col("title").isNull(), "missing_field").when(blank("id"), "missing_field").when(blank("title"), "empty_title").when(~F.col("asked"), "unknown_id")
    rows = rows.withColumn("kind", kind)
    titles = rows.filter("kind IS NULL AND times = 1").select(batch, "id", "title")
    issues = rows.filter("again").select(batch, "pos", F.lit("duplicate_id").alias("kind"), "id").unionByName(rows.filter("kind IS NOT NULL").select(batch, "pos", "kind", "id"))
    issues = issues.unionByName(batches.filter("failed").select(batch, F.lit(-1).alias("pos"), F.when(F.col("bad_json"), "json_parse").otherwise("schema_shape").alias("kind"), F.lit(None).cast("string").alias("id")))
    counts = rows.groupBy(batch).agg(
        F.count_if(F.col("kind").isin("missing_field", "empty_title")).alias("invalid"), F.count_if("again").alias("duplicate"), F.count_if(F.col("kind") == "unknown_id").alias("unknown"), F.count_if(F.col("kind").isNull() & (F.col("times") == 1)).alias("salvaged")
    )
    asked = requested.groupBy(batch).agg(F.count(F.lit(1)).alias("requested"))
    summary = batches.select(batch, "failed").join(asked, batch, "left").join(counts, batch, "left").na.fill(0, ["requested", "invalid", "duplicate", "unknown", "salvaged"])
    return titles, issues, summary.withColumn("missing", F.col("requested") - F.col("salvaged"))


def summary_fields(json: Column, expected_id: Column) -> Column:
    """struct(title, summary, tags) of a one-row answer, or null: its id must match, its texts must not be blank, and 1 to 8 tags that are not blank must be left."""
    row = F.from_json(json, "id string, title string, summary string, tags array<string>")
    tags = F.filter(F.transform(row["tags"], trim_space), lambda t: F.length(t) > 0)
    ok = (row["id"] == expected_id) & (F.length(trim_space(row["title"])) > 0) & (F.length(trim_space(row["summary"])) > 0) & F.size(tags).between(1, 8)
    return F.when(F.coalesce(ok, F.lit(False)), F.struct(trim_space(row["title"]).alias("title"), trim_space(row["summary"]).alias("summary"), tags.alias("tags")))


def retry_batch(items: DataFrame, missing: DataFrame, batch: str = "batch", order: str = "ord", key: str = "id") -> DataFrame:
    """What is asked again: a batch's missing items where there are several; where one is missing, the half of the batch that holds it (the first half is the larger)."""
    w = Window.partitionBy(batch)
    d = items.join(missing.select(key, F.lit(True).alias("_missing")), key, "left").withColumn("_missing", F.coalesce("_missing", F.lit(False)))
    d = d.withColumn("_at", F.row_number().over(w.orderBy(order))).withColumn("_size", F.count(F.lit(1)).over(w)).withColumn("_many", F.count_if("_missing").over(w))
    d = d.withColumn("_first", F.col("_at") <= F.ceil(F.col("_size") / 2)).withColumn("_in_first", F.max(F.when(F.col("_missing"), F.col("_first"))).over(w))
    return d.filter((F.col("_many") > 1) & F.col("_missing") | (F.col("_many") == 1) & (F.col("_first") == F.col("_in_first"))).select(*items.columns)
