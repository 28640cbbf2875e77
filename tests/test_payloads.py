import json
import random

import pytest
from pyspark.sql import functions as F

from inkwell.operators import batching, layers, payloads

PAPER = "id string, title string, journal string, source string, scope string, line string, abstract string"


def brute(stage, p):
    """The same item by Python's own serialiser."""
    cut = lambda t: t if t is None or len(t) <= 2000 else t[:2000] + "…"
    item = {"id": p["id"], "title": p["title"] or ""}
    if stage == "gate":
        item["abstract"] = p["abstract"] or ""
    else:
        item["journal"] = p["journal"] or ""
    if stage in ("routing", "tagging", "summarize"):
        item["source_id"] = p["source"] or ""
    if stage in ("tagging", "summarize"):
        item["scope"] = p["scope"] or "life-science-only"
    if stage == "summarize":
        item["digest_line"] = p["line"] or "line-b"
    if stage in ("spatial", "tagging", "summarize") and p["abstract"] is not None:
        item["abstract"] = cut(p["abstract"].strip())
    return json.dumps(item, ensure_ascii=False, separators=(",", ":"))


def test_payloads_are_what_a_serialiser_writes(spark):
    odd = "".join(map(chr, range(1, 128))) + '\\u000B "quoted" \\ é漢🙂 </script>'
    rows = [("1", odd, odd, "s", "broad-science", "line-a", f"  {odd} "), ("2", None, None, None, None, None, None), ("3", "t", "", "s", None, None, "x" * 2001), ("4", "", "j", "s", "s", "l", "y" * 2000), ("5", "\0", "j", "s", "s", "l", "")]
    d = spark.createDataFrame(rows, PAPER)
    for stage in payloads.FIELDS:
        got = {r.id: r for r in payloads.with_payload(d, stage).collect()}
        for r in rows:
            wanted = brute(stage, dict(zip([c.split()[0] for c in PAPER.split(", ")], r, strict=True)))
            assert got[r[0]].payload == wanted and got[r[0]].payload_chars == len(wanted), (stage, r[0])
    body = d.select(F.collect_list(payloads.payload("gate", d.columns)).alias("i"))
    assert len(json.loads(body.select(payloads.request("gate", F.col("i"))).first()[0])["papers"]) == 5
    assert set(json.loads(body.select(payloads.request("summarize", F.col("i"))).first()[0])) == {"paper"}
    assert json.loads(spark.range(1).select(payloads.payload("routing", ["id"])).first()[0]) == {"id": "0", "title": "", "journal": "", "source_id": ""}


def test_all_stages_are_spelled_in_one_pass(spark, tmp_path):
    spark.createDataFrame([("1", 'a "b"\n', "j", "s", None, None, "\u2003 c\x0b\x1f\\ \t"), ("2", None, None, None, "s", "l", None), ("3", "\x7f", "", "", "", "", "\x85 x \x85")], PAPER).write.parquet(str(tmp_path / "p"))
    d = spark.read.parquet(str(tmp_path / "p"))
    got = payloads.with_payloads(d, list(payloads.FIELDS), ["id"])
    plain = [(r.id, s, r.payload, r.payload_chars) for s in payloads.FIELDS for r in payloads.with_payload(d, s).collect()]
    assert sorted(map(tuple, got.collect())) == sorted(plain) and len(plain) == 18
    assert any('"abstract":"\x85 x \x85"' in p for i, s, p, _ in plain if (i, s) == ("3", "spatial"))  # no white space there, so nothing is trimmed
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.lower().count("to_json") + plan.count("StructsToJson") <= 9  # a paper's text is neither read nor escaped once a stage


def test_one_stage_needs_no_pattern(spark):
    d = payloads.with_payload(spark.range(3).select(F.col("id").cast("string").alias("id"), F.col("id").cast("string").alias("abstract")), "spatial")
    plan = d._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "regexp_replace" not in plan and "rlike" not in plan


def test_batches_go_by_exact_lengths(spark, tmp_path):
    r = random.Random(8)
    d = spark.createDataFrame([(str(i), "t" * r.randrange(30), "j", "hot" if i % 5 else "cold", None, None, '"' * r.randrange(300)) for i in range(120)], PAPER).withColumn("ord", F.col("id").cast("int"))
    limits = (6, 300, None)
    got = payloads.planned(d, "tagging", "source", ["ord"], limits, str(tmp_path), "prompt")
    plain = batching.pack(payloads.with_payload(d, "tagging"), "source", ["ord"], "payload_chars", "tagging", *limits, 6)
    assert sorted(got.select("id", "batch").collect()) == sorted(plain.select("id", "batch").collect())
    for b in got.groupBy("source", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("payload_chars").alias("c")).collect():
        assert b.n == 1 or (b.n <= 6 and (6 + b.c + b.n - 1 + 45) / 4 <= 300)


def test_a_paper_is_spelled_once_and_lengths_alone_are_packed(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    texts = ["x" * 2500, None, '"\\ \x0b\x1f', " \\u00e9 ", ""]
    d = spark.createDataFrame([(str(i), texts[i % 3], "j", "hot" if i % 5 else None, None, None, texts[i % 5]) for i in range(90)], PAPER).mapInArrow(counted, PAPER).withColumn("ord", F.col("id").cast("int"))
    limits = (8, 1500, 8192)
    got = payloads.planned(d, "spatial", "source", ["ord"], limits, str(tmp_path / "a"), "prompt", whole=False)
    assert got.columns == ["source", "ord", "id", "payload_chars", "batch"] and "payload" not in spark.read.parquet(str(tmp_path / "a" / "rows")).columns
    rows = sorted(map(tuple, got.collect()), key=str)
    assert seen.value == len(rows) == 90
    whole = payloads.planned(d, "spatial", "source", ["ord"], limits, str(tmp_path / "b"), "prompt")
    assert sorted(map(tuple, whole.drop("payload").collect()), key=str) == rows and seen.value == 180
    plain = batching.pack(payloads.with_payload(d, "spatial"), "source", ["ord"], "payload_chars", "spatial", *limits, 6)
    assert sorted(map(tuple, plain.select(*got.columns).collect()), key=str) == rows


def test_an_item_is_spelled_at_once(spark, tmp_path):
    spark.createDataFrame([("1", "t", "j", "s", None, None, "a")], PAPER).write.parquet(str(tmp_path / "p"))
    own = payloads.with_payload(spark.read.parquet(str(tmp_path / "p")), "tagging").select("payload")
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    head = plan.split("lambdafunction")[0]  # what is worked out for every paper, and not only where a control character has been met
    assert head.lower().count("to_json") + head.count("StructsToJson") == 1


ROUTING = {"baseUrl": "https://x.org/v1", "maxPapersPerBatch": 40, "maxInputTokens": 28000, "maxTokens": 8192, "timeoutMs": 180000}


def test_layers_hide_one_another(spark):
    d = spark.createDataFrame([("a", "k", "1", 0, 0), ("a", "k", "2", 1, 5), ("a", "k", "3", 1, 9), ("a", "k", None, 2, 0), ("a", "j", "x", 0, 0), (None, "k", "n", 0, 0)], layers.ENTRY)
    assert sorted(map(tuple, layers.resolve(d).collect()), key=str) == sorted([("a", "k", "3", 1), ("a", "j", "x", 0), (None, "k", "n", 0)], key=str)
    got = layers.settings(spark, "routing", [{"routing": ROUTING}, {"routing": {"maxTokens": 100, "enableThinking": True}}], {})
    assert got == ROUTING | {"maxTokens": 100, "enableThinking": True, "maxRetries": 0}
    mail = layers.settings(spark, "email", [{"email": {"fromEmail": "a@b.org", "subjectPrefix": "P"}}], {"DIGEST_TO_EMAIL": "x@y.org, z@y.org", "DIGEST_FROM_EMAIL": "c@d.org", "DIGEST_FROM_NAME": " "})
    assert mail == {"fromEmail": "c@d.org", "subjectPrefix": "P", "to": ["x@y.org", "z@y.org"]}


def test_all_faults_are_reported(spark):
    file = {"baseUrl": "ftp:x", "maxPapersPerBatch": 0, "maxInputTokens": "many", "maxTokens": 1.5, "enableThinking": "yes", "typo": 1}
    with pytest.raises(layers.SettingsError) as e:
        layers.settings(spark, "routing", [{"routing": file}], {})
    said = str(e.value)
    for part in ("baseUrl: not of its form", "maxPapersPerBatch: below 1", "maxInputTokens: no integer", "maxTokens: no integer", "timeoutMs: missing", "typo: unknown key", "enableThinking: no boolean (yes, layer 1)"):
        assert f"routing.{part}" in said
    d = spark.createDataFrame([("a", "x", "nan", 0), ("b", "x", "-1", 1), ("c", "x", " 7 ", 1), ("c", "l", '["q"', 0)], "scope string, key string, value string, layer int")
    rules = {"x": layers.Rule("number", low=0, high=9), "l": layers.Rule("list", required=True)}
    wrong = sorted((tuple(r) for r in layers.faults(d, rules, spark.createDataFrame([("c",), ("z",)], "scope string")).collect()), key=str)
    assert wrong == sorted([("a", "x", "nan", 0, "no number"), ("b", "x", "-1", 1, "below 0"), ("c", "l", '["q"', 0, "no list"), ("z", "l", None, None, "missing")], key=str)
    assert layers.faults(d.filter("false"), rules).count() == 0
