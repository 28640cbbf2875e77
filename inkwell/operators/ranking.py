"""Orders and ranks over whole tables without a task that sees them whole.

Rows are dealt to ranges of the order and sorted there, and stand written with their range and place in it. Counts of the ranges
(of each group's part in them, where there are groups) give every range what stands before it, so a row's rank is a sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.policy import MISSING_PRIORITY
from inkwell.functions.rules import visible
from inkwell.operators.selection import rank_order
from inkwell.session import saved

PLACE = (1 << 33) - 1


def laid_out(df: DataFrame, order: list[Column], path: str) -> DataFrame:
    """``df`` with ``_part`` (a range of the order) and ``_at`` (rising inside it), written to ``path``. Rows that tie in the whole order stand as they come."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return saved(d.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE))}), path)


def ranked(df: DataFrame, order: list[Column], path: str, name: str = "position") -> DataFrame:
    """``df`` with its rank in ``order``, from 1. The driver holds a number a range."""
    d = laid_out(df, order, path)
    before, rows = 0, []
    for r in sorted(d.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first")).collect(), key=lambda r: r["_part"]):
        rows.append((r["_part"], before - r["first"] + 1))
        before += r["n"]
    shift = df.sparkSession.createDataFrame(rows, "_part int, _shift long")
    return d.join(F.broadcast(shift), "_part").withColumn(name, F.col("_at") + F.col("_shift")).select(*df.columns, name)


def parts_of(d: DataFrame, group: str, **more: Column) -> DataFrame:
    """Of a laid-out table, the parts that each group has in the ranges: ``_g`` (the group), ``_part``, ``_n``, ``_first``, ``_before`` (its rows in earlier ranges), ``_nth`` (of the group's parts), and ``more`` aggregates."""
    own = Window.partitionBy("_g").orderBy("_part")
    parts = d.groupBy(F.col(group).alias("_g"), "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"), *[c.alias(k) for k, c in more.items()])
    before = F.coalesce(F.sum("_n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.withColumns({"_before": before, "_nth": F.row_number().over(own) - 1})


def with_parts(d: DataFrame, parts: DataFrame, group: str) -> DataFrame:
    """Rows with what ``parts`` says of their part."""
    met = d.join(parts.withColumnRenamed("_part", "_p"), (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return met.drop("_p", "_g")


def ranked_in_groups(df: DataFrame, group: str, order: list[Column], path: str, name: str = "n") -> DataFrame:
    """``df`` with its rank within its group, from 1, however large the group."""
    d = laid_out(df, [F.col(group), *order], path)
    met = with_parts(d, parts_of(d, group), group)
    return met.withColumn(name, F.col("_before") + F.col("_at") - F.col("_first") + 1).select(*df.columns, name)


def global_display_order(papers: DataFrame, path: str) -> DataFrame:
    """``position`` of every row in the report's order (see ``selection.rank_order``), over all rows."""
    return ranked(papers, rank_order(), path)


def overflow_list(selected: DataFrame, path: str, most: int, journal: str = "journal", source: str = "source") -> DataFrame:
    """The report's overflow with its rows: label, priority, papers, position by (priority, label), and ``rows``: its first ``most`` papers (id, title, url where there is one) in the report's order.

    A label is the journal or, where that is blank, the source. Groups and rows are laid out in one order, so none is held or sorted whole.
    """
    label = F.coalesce(F.nullif(F.trim(F.col(journal)), F.lit("")), F.col(source))
    own = [c for c in ("id", "title", "url") if c in selected.columns]
    shown = selected.filter(visible(F.col("line")) & ~F.col("featured")).withColumns({"_label": label, "_rank": F.coalesce("priority", F.lit(MISSING_PRIORITY))})
    groups = shown.groupBy(F.col("_label").alias("_l")).agg(F.min("_rank").alias("_least"), F.count(F.lit(1)).alias("_papers"))
    d = shown.join(groups, F.col("_label").eqNullSafe(F.col("_l"))).select("_label", "_least", "_papers", *own, *[c.alias(f"_o{i}") for i, c in enumerate(rank_order())])
    d = laid_out(d, [F.col("_least"), F.collate("_label", "UNICODE"), F.col("_label"), *[F.col(f"_o{i}") for i in range(len(rank_order()))]], path)
    met = with_parts(d, parts_of(d, "_label"), "_label").withColumn("_i", F.col("_before") + F.col("_at") - F.col("_first")).filter(F.col("_i") < most)
    listed = met.groupBy("_label", "_least", "_papers").agg(F.sort_array(F.collect_list(F.struct("_i", F.struct(*own).alias("row")))).alias("rows"))
    listed = listed.select(F.col("_label").alias("label"), F.col("_least").alias("priority"), F.col("_papers").alias("papers"), F.transform("rows", lambda r: r["row"]).alias("rows"))
    return ranked(listed, [F.col("priority"), F.collate("label", "UNICODE"), F.col("label")], f"{path}-groups")


def _least(keys: list[str], order: list[str], k: int, held: int):
    def reduce(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in [*keys, *order]]).combine_chunks()
        change = np.zeros(max(table.num_rows - 1, 0), bool)
        for c in keys:
            codes = table.column(c).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            change |= codes[1:] != codes[:-1]
        starts = np.flatnonzero(np.append(True, change)) if table.num_rows else np.zeros(0, np.int64)
        nth = np.arange(table.num_rows) - np.repeat(starts, np.diff(np.append(starts, table.num_rows)))
        return table.filter(pa.array(nth < k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            own = pa.Table.from_batches([batch])
            kept = reduce(own if kept is None else pa.concat_tables([kept, own]))
            if kept.num_rows > held:  # many keys: what has been gathered goes on
                yield from kept.to_batches()
                kept = None
        if kept is not None:
            yield from kept.to_batches()

    return run


def least_of_each(df: DataFrame, keys: list[str], order: list[str], k: int, columns: list[str], held: int = 100_000) -> DataFrame:
    """``keys`` and ``sample``: the ``k`` rows (``columns``) of each key that come first by ``order``, nulls last.

    Every task keeps k rows a key before anything is shuffled, whatever the key's share of the rows, and what tasks have kept is
    merged the same way. ``order`` should be unique in a key; of rows that tie, any may be taken.
    """
    own = list(dict.fromkeys([*keys, *order, *columns]))
    d = df.select(*own)
    part = d.mapInArrow(_least(keys, order, k, held), d.schema)
    first = [x for c in order for x in (F.col(c).isNull().alias(f"_{c}"), F.col(c).alias(f"_v_{c}"))]
    listed = part.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list(F.struct(*first, F.struct(*columns).alias("row")))), 1, k).alias("s"))
    return listed.select(*keys, F.transform("s", lambda r: r["row"]).alias("sample"))
