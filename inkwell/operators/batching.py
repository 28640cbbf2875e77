"""Budgeted batches and request timing."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from inkwell.functions.policy import CAP_SHARE
from inkwell.functions.rules import COMPLETION
from inkwell.operators.ranking import laid_out, parts_of, with_parts
from inkwell.session import saved


def pack(df: DataFrame, group: str, order: list[str], chars: str, stage: str, max_items: int, max_input_tokens: int, max_completion_tokens: int | None, prompt_chars: int = 0) -> DataFrame:
    """``df`` with ``batch`` (from 0 in each group) by next fit.

    An item opens a new batch when with it the batch would have too many items, too many request tokens (a quarter of
    the characters of prompt, items, commas and frame) or a too long answer. One that is too large by itself has a batch of its own.
    Next fit looks at one item after the other, so a group's rows stream through one task, which holds one batch's sums.
    """
    base, each = COMPLETION[stage]
    schema = StructType([*df.schema.fields, StructField("batch", LongType())])
    at, by = df.columns.index(chars), df.columns.index(group)
    frame = len('{"papers":[]}') + 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, number, items, size = object(), 0, 0, 0
        for part in batches:
            out = []
            for g, n in zip(part.column(by).to_pylist(), part.column(at).to_pylist(), strict=True):
                n = n or 0
                if g != current:
                    current, number, items, size = g, 0, 0, 0
                more, total = items + 1, size + n + (1 if items else 0)
                over = more > max_items or ceil((prompt_chars + total + frame) / 4) > max_input_tokens or (max_completion_tokens is not None and base + each * more > CAP_SHARE * max_completion_tokens)
                if items and over:
                    number, items, size = number + 1, 1, n
                else:
                    items, size = more, total
                out.append(number)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.int64())], names=[*part.schema.names, "batch"])

    return df.repartition(group).sortWithinPartitions(group, *order).mapInArrow(run, schema)


def _reach(chars: np.ndarray, most: int, room: int) -> np.ndarray:
    """Of every row, where a batch that starts there would end: after ``most`` rows, or before the one that no longer fits into ``room`` characters (a comma between two), but after one row at least."""
    t = np.append(0, np.cumsum(chars)) + np.arange(len(chars) + 1)
    i = np.arange(len(chars))
    fits = np.searchsorted(t, t[:-1] + 1 + room, "right") - 1
    return np.minimum(np.maximum(i + 1, np.minimum(fits, i + most)), len(chars))


def _parted(table: pa.Table, keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows that are equal in ``keys``."""
    change = np.zeros(table.num_rows - 1, bool)
    for c in keys:
        codes = table.column(c).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        change |= codes[1:] != codes[:-1]
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        yield table.slice(a, b - a)


def _by_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole runs of equal keys from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in keys):
            yield from _parted(pa.Table.from_batches(held), keys)
            held = []
        held.append(batch)
        *whole, last = _parted(pa.Table.from_batches(held), keys)
        yield from whole
        held = last.to_batches()
    if held:
        yield from _parted(pa.Table.from_batches(held), keys)


def _jumps(most: int, room: int):
    """Rows of a part, and those after it that a batch may reach: for each entry (where its first batch starts) how far past the part's end the next one starts, and how many start in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_runs(batches, ["_g", "_nth"]):
            n = int(part.column("_n")[0].as_py())
            reach = _reach(part.column("_chars").to_numpy(), most, room).tolist()
            past, begun = [0] * (n + most), [0] * (n + most)
            for i in range(n + most - 1, -1, -1):
                if i >= n:
                    past[i] = i - n
                elif (j := reach[i]) >= n:
                    past[i], begun[i] = j - n, 1
                else:
                    past[i], begun[i] = past[j], begun[j] + 1
            same = [part.column(c)[0] for c in ("_g", "_nth")]
            yield pa.RecordBatch.from_arrays([*[pa.array([v.as_py()] * most, v.type) for v in same], pa.array(range(most), pa.int32()), pa.array(past[:most], pa.int32()), pa.array(begun[:most], pa.int64())], names=["_g", "_nth", "_e", "_past", "_begun"])

    return run


def _numbers(most: int, room: int, names: list[str]):
    """Rows of a part that know where its first batch starts, and how many started before it, with their batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_runs(batches, ["_g", "_nth"]):
            reach = _reach(part.column("_chars").to_numpy(), most, room).tolist()
            starts, i = np.zeros(part.num_rows, np.int64), int(part.column("_e")[0].as_py())
            while i < len(starts):
                starts[i] = 1
                i = reach[i]
            number = np.cumsum(starts) + part.column("_base")[0].as_py() - 1
            yield from part.select(names).append_column("batch", pa.array(number)).to_batches()

    return run


def pack_ranges(df: DataFrame, group: str, order: list[str], chars: str, stage: str, max_items: int, max_input_tokens: int, max_completion_tokens: int | None, path: str, prompt_chars: int = 0) -> DataFrame:
    """As ``pack``, but a group is no longer one task's: its rows lie in ranges, and each range works out its part of the answer for every start.

    The batch that comes over from the range before ends within the next ``max_items`` rows, so a range has that many
    possible beginnings. For each it says where the batch after its last one would begin and how many begin in it.
    These jump tables are put together by doubling: after k rounds a table spans 2^k ranges, and the ranges whose beginning is
    known are doubled too. Then every range numbers its own rows. ``group`` with ``order`` should be unique. Tables in between go to ``path``.
    """
    base, each = COMPLETION[stage]
    most = max_items if max_completion_tokens is None else min(max_items, int((CAP_SHARE * max_completion_tokens - base) // each))
    most, room = max(1, most), 4 * max_input_tokens - prompt_chars - len('{"papers":[]}') - 32
    plain = laid_out(df.withColumn("_chars", F.coalesce(F.col(chars), F.lit(0)).cast("long")), [F.col(group), *[F.col(c) for c in order]], f"{path}/rows")
    parts = saved(parts_of(plain, group), f"{path}/parts")
    rows = with_parts(plain, parts, group).withColumn("_g", F.col(group)).withColumn("_i", F.col("_before") + F.col("_at") - F.col("_first"))
    own = rows.select("_g", "_nth", "_n", "_i", "_chars")
    # The rows after a part's end stand near the beginning of another, and are looked up by blocks of ``most`` rows.
    edge = rows.filter(F.col("_i") - F.col("_before") < most).select("_g", "_i", "_chars", F.expr(f"_i div {most}").alias("_block"))
    ends = parts.select(F.col("_g").alias("_eg"), F.col("_nth").alias("_en"), F.col("_n").alias("_size"), (F.col("_before") + F.col("_n")).alias("_end"))
    ends = ends.withColumn("_eb", F.explode(F.expr(f"sequence(_end div {most}, _end div {most} + 1)")))
    after = edge.join(ends, F.col("_g").eqNullSafe(F.col("_eg")) & (F.col("_block") == F.col("_eb")) & (F.col("_i") >= F.col("_end")) & (F.col("_i") < F.col("_end") + most))
    both = own.unionByName(after.select("_g", F.col("_en").alias("_nth"), F.col("_size").alias("_n"), "_i", "_chars"))
    kind = df.schema[group].dataType.simpleString()
    table = both.repartition("_g", "_nth").sortWithinPartitions("_g", "_nth", "_i").mapInArrow(_jumps(most, room), f"_g {kind}, _nth int, _e int, _past int, _begun long")
    table = saved(table, f"{path}/jumps0")
    known = parts.filter("_nth = 0").select("_g", "_nth", F.lit(0).alias("_e"), F.lit(0).cast("long").alias("_base"))
    span, last = 1, parts.agg(F.max("_nth").alias("n")).first().n or 0
    while span <= last:
        here = [F.col("k._g").eqNullSafe(F.col("t._g")), F.col("k._nth") == F.col("t._nth"), F.col("k._e") == F.col("t._e")]
        further = known.alias("k").join(table.alias("t"), here).select("k._g", (F.col("k._nth") + span).alias("_nth"), F.col("_past").alias("_e"), (F.col("_base") + F.col("_begun")).alias("_base"))
        known = saved(known.unionByName(further), f"{path}/known{span}")
        if 2 * span <= last:
            there = [F.col("a._g").eqNullSafe(F.col("b._g")), F.col("a._nth") + span == F.col("b._nth"), F.col("a._past") == F.col("b._e")]
            table = saved(table.alias("a").join(table.alias("b"), there).select("a._g", "a._nth", "a._e", "b._past", (F.col("a._begun") + F.col("b._begun")).alias("_begun")), f"{path}/jumps{2 * span}")
        span *= 2
    starts = known.withColumnsRenamed({"_g": "_kg", "_nth": "_kn"})
    met = rows.join(starts, F.col("_g").eqNullSafe(F.col("_kg")) & (F.col("_nth") == F.col("_kn"))).select(*df.columns, "_g", "_nth", "_i", "_chars", "_e", "_base")
    schema = StructType([*df.schema.fields, StructField("batch", LongType())])
    return met.repartition("_g", "_nth").sortWithinPartitions("_g", "_nth", "_i").mapInArrow(_numbers(most, room, df.columns), schema)


def batch_estimates(packed: DataFrame, group: str, chars: str, stage: str, prompt_chars: int = 0) -> DataFrame:
    base, each = COMPLETION[stage]
    frame = len('{"papers":[]}') + 32
    n = packed.groupBy(group, "batch").agg(F.count(F.lit(1)).alias("items"), F.sum(F.coalesce(chars, F.lit(0))).alias("_chars"))
    tokens = F.ceil((F.col("_chars") + F.col("items") - 1 + prompt_chars + frame) / 4)
    return n.select(group, "batch", "items", tokens.cast("long").alias("input_tokens"), (base + each * F.col("items")).alias("completion_tokens"))


def spaced_starts(df: DataFrame, bucket: str, arrival_ms: str, order: list[str], interval: Column | int, blocked_until_ms: Column | None = None) -> DataFrame:
    """``df`` with ``start_ms``: first come, first served, starts at least ``interval`` apart in a bucket, none before ``blocked_until_ms``.

    start(i) = max(arrival(i), start(i - 1) + interval) unrolls to i * interval + max over j <= i of (arrival(j) - j * interval): a running maximum.
    """
    w = Window.partitionBy(bucket).orderBy(*order)
    step = F.lit(interval) if isinstance(interval, int) else interval
    arrive = F.col(arrival_ms) if blocked_until_ms is None else F.greatest(F.col(arrival_ms), blocked_until_ms)
    d = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_free", arrive - F.col("_i") * step)
    running = F.max("_free").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return d.withColumn("start_ms", running + F.col("_i") * step).drop("_i", "_free")


def spaced_starts_ranges(df: DataFrame, bucket: str, arrival_ms: str, order: list[str], interval: int, path: str, blocked_until_ms: Column | None = None) -> DataFrame:
    """As ``spaced_starts`` with one interval, but a bucket's rows lie in ranges: the running maximum goes on from that of the ranges before, which are joined back as one number a range.

    In a range the free time is arrival less place times interval; shifting the place shifts all of a range's by the same, so one pass finds every range's greatest. ``bucket`` with ``order`` should be unique.
    """
    arrive = F.col(arrival_ms) if blocked_until_ms is None else F.greatest(F.col(arrival_ms), blocked_until_ms)
    d = laid_out(df.withColumn("_arrive", arrive.cast("long")), [F.col(bucket), *[F.col(c) for c in order]], path)
    parts = parts_of(d, bucket, _most=F.max(F.col("_arrive") - F.col("_at") * interval))
    shift = (F.col("_before") - F.col("_first")) * interval
    own = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_earlier", F.max(F.col("_most") - shift).over(own))
    met = with_parts(d, parts, bucket).withColumn("_place", (F.col("_at") + F.col("_before") - F.col("_first")) * interval)
    running = F.max(F.col("_arrive") - F.col("_place")).over(Window.partitionBy(bucket, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return met.withColumn("start_ms", F.greatest(running, F.col("_earlier")) + F.col("_place")).select(*df.columns, "start_ms")


def request_rate_slices(df: DataFrame, ts: str, order: list[str], bucket: str | None = None, seconds: int = 60, windows: int = 10) -> DataFrame:
    """As ``request_rate``, but time is cut into slices of ``windows`` windows: a slice counts over its own rows and those of one window before it, and has the last time of the slices before as a row of its own.

    A start adds one at its time and takes it away when its window has passed, so a running sum counts the starts of any window and
    each row is looked at twice, however dense the rows are. Rows without a time have neither count nor gap. Of rows at one time the gap goes by ``order``.
    """
    ms, width = F.unix_millis(F.col(ts).cast("timestamp")), 1000 * seconds
    long = width * windows
    own = F.col(bucket) if bucket else F.lit("").alias("_b")
    d = df.withColumns({"_ms": ms, "_b": own}).withColumn("_slice", F.expr(f"(_ms - pmod(_ms, {long})) div {long}"))
    timed, last = d.filter("_ms IS NOT NULL"), Window.partitionBy("_b").orderBy("_to")
    lasts = timed.groupBy("_b", F.col("_slice").alias("_to")).agg(F.max("_ms").alias("_last"))
    lasts = lasts.select("_b", "_to", F.lag("_last").over(last).alias("_ms")).filter("_ms IS NOT NULL").withColumns({"_at": F.col("_ms"), "_more": F.lit(0)})
    until = F.expr(f"(_ms + {width} - pmod(_ms + {width}, {long})) div {long}")
    entry = lambda to, at, more: F.struct(to.alias("_to"), at.alias("_at"), F.lit(more).alias("_more"))
    entries = F.concat(F.transform(F.sequence(F.col("_slice"), until), lambda s: entry(s, F.col("_ms"), 1)), F.array(entry(until, F.col("_ms") + width + 1, -1)))
    spread = timed.withColumn("_e", F.explode(entries)).select("*", "_e.*").drop("_e")
    # The columns go with a row's entry in its own slice alone.
    here = (F.col("_more") == 1) & (F.col("_to") == F.col("_slice"))
    spread = spread.select("_b", "_to", "_at", "_more", F.when(F.col("_more") == 1, F.col("_ms")).alias("_ms"), here.alias("_own"), *[F.when(here, F.col(c)).alias(c) for c in df.columns])
    met = spread.unionByName(lasts, allowMissingColumns=True)
    earlier = Window.partitionBy("_b", "_to").orderBy("_at", *order).rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumn("_before", F.last("_ms", ignorenulls=True).over(earlier))
    met = met.withColumn("recent", F.sum("_more").over(Window.partitionBy("_b", "_to").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    out = met.filter("_own").select(*df.columns, "recent", (F.col("_ms") - F.col("_before")).alias("gap_ms"))
    return out.unionByName(df.filter(ms.isNull()).withColumns({"recent": F.lit(None).cast("long"), "gap_ms": F.lit(None).cast("long")}))


def request_rate(df: DataFrame, ts: str, bucket: str | None = None, seconds: int = 60) -> DataFrame:
    """``df`` with ``recent`` (starts in the last ``seconds``, both ends included) and ``gap_ms`` since the one before."""
    ms = F.unix_millis(F.col(ts).cast("timestamp"))
    order = Window.partitionBy(F.col(bucket) if bucket else F.lit(1)).orderBy(ms)
    recent = F.count(F.lit(1)).over(order.rangeBetween(-1000 * seconds, 0))
    return df.withColumn("recent", recent).withColumn("gap_ms", ms - F.lag(ms).over(order))
