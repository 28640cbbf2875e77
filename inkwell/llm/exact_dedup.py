"""Exact duplicates by distributed most-significant-digit radix partitioning.

Every pass splits the groups that are still open by their next bytes. A group
closes when it holds one text or when its texts end inside the pass's slice: its
members have then agreed on every byte, so no digest takes part in deciding equality.
Slices widen from pass to pass: most texts part in the first one, and a long copy
needs few passes. Counting is a pre-aggregated ``groupBy``, and members meet their
group's counts in a join that adaptive execution can split, so a group that holds a
third of all rows never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: First slice and how much wider each next one is; the last is repeated for as long as texts go on.
FIRST_SLICE, WIDER, WIDEST = 256, 16, 1 << 20


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone take the fast built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of equal texts: doc_id, keep_id, group_size, kept, text_sha256.

    A row per input row. Texts are equal when identical after lower-casing A-Z; null counts as
    empty. Of equal texts, the row with the largest id stays (a null id only among null ids).
    Rows that repeat an id and its text are one another's copies, and each that bears keep_id has
    kept = true. Other columns, whatever their names, are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    with Scratch(spark, "radix") as scratch:
        text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
        open_ = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.lit(0).cast("long").alias("gid"))
        open_ = open_.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.col("text").cast("binary").alias("rest"), "gid")
        closed, width, step = None, FIRST_SLICE, 0
        while True:
            cut = open_.select(
                "doc_id", "text_sha256", "gid",
                F.expr(f"substring(rest, 1, {width})").alias("slice"),
                F.expr(f"substring(rest, {width + 1})").alias("rest"),
            ).withColumn("ended", F.octet_length("rest") == 0)
            groups = cut.groupBy("gid", "slice", "ended").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id")).filter("n > 1")
            # Written before the join: its numbers then stay as they are, and adaptive execution can split the hot keys of a
            # merge join, which is asked for at every size so that no growing table is ever broadcast.
            groups = scratch.save(groups.withColumn("next_gid", F.monotonically_increasing_id()), f"groups{step}")
            met = cut.join(groups.hint("merge"), ["gid", "slice", "ended"], "left")
            state = scratch.save(
                met.select(
                    "doc_id",
                    "text_sha256",
                    F.coalesce("n", F.lit(1)).alias("n"),
                    F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.expr("ended OR n IS NULL").alias("done"),
                    F.col("next_gid").alias("gid"),
                    F.expr("CASE WHEN NOT ended AND n IS NOT NULL THEN rest END").alias("rest"),
                ),
                f"pass{step}",
            )
            done = state.filter("done").select("doc_id", "text_sha256", "n", "keep_id")
            closed = done if closed is None else closed.unionByName(done)
            open_ = state.filter("NOT done").select("doc_id", "text_sha256", "rest", "gid")
            if open_.isEmpty():
                break
            width, step = min(width * WIDER, WIDEST), step + 1
        out = closed.select(
            "doc_id",
            "keep_id",
            F.col("n").alias("group_size"),
            F.expr("doc_id <=> keep_id").alias("kept"),
            "text_sha256",
        )
        return scratch.result(out)
