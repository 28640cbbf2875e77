"""Exact rolling medians and MADs over an indexable skip list, in time slices with a halo.

A series' time is cut into slices. A slice gets its own rows and, as a halo, those of the window's length before it, so
every window is whole in one place and slices need nothing of one another. Rows arrive sorted by slice, series and
time and stream through: a task holds one window. Rows of one time are entered together, after those that are
then too old have been taken out. The rows' values stand in a skip list whose links know how many values they
skip, so the value of any rank is found by adding up spans, and ranks drive both the median and the MAD.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.llm.words import give_back

MINUTES, SLICE_WINDOWS, LEAST = 360, 2, 5
#: Values of a node before it is split; share of nodes that stand on a further level; levels at most. Values that are no cents: their doubled deviations would not fit.
MOST, RISE, LEVELS, LIMIT = 1024, 0.25, 16, 1 << 57


class Node:
    """A run of sorted values from ``low`` on, up to the next node's. ``nexts`` and ``spans`` by level: the next node there, and how many values stand from here up to it."""

    __slots__ = ("low", "nexts", "spans", "values")

    def __init__(self, low: float, values: list[int], levels: int):
        self.low, self.values = low, values
        self.nexts: list[Node | None] = [None] * levels
        self.spans = [0] * levels


class SkipList:
    """A sorted multiset of integers: insert, remove, and the value at a rank, each in logarithmic time. Equal values share a node."""

    def __init__(self, most: int = MOST, seed: int = 42):
        self.most, self.random = most, Random(seed)
        self.head = Node(float("-inf"), [], LEVELS)
        self.levels, self.size, self.start = 1, 0, 0

    def insert(self, value: int) -> None:
        node = self.head
        for i in range(self.levels - 1, -1, -1):
            while (ahead := node.nexts[i]) is not None and ahead.low <= value:
                node = ahead
            node.spans[i] += 1
        insort(node.values, value)
        self.size += 1
        if len(node.values) > self.most:
            self._split(node)

    def remove(self, value: int) -> None:
        """Take out one of the values equal to ``value``, which must be there."""
        node = self.head
        for i in range(self.levels - 1, -1, -1):
            while (ahead := node.nexts[i]) is not None and ahead.low <= value:
                node = ahead
            node.spans[i] -= 1
        own = node.values
        at = bisect_right(own, value) - 1
        if at < 0 or own[at] != value:
            raise KeyError(value)
        del own[at]
        self.size -= 1
        if not own and node is not self.head:
            self._unlink(node)

    def _path(self, node: Node) -> list[tuple[Node, int]]:
        """By level, the last node before ``node`` and how many values stand from it up to ``node``."""
        x, passed, path = self.head, 0, []
        for i in range(self.levels - 1, -1, -1):
            while (ahead := x.nexts[i]) is not None and ahead.low < node.low:
                passed += x.spans[i]
                x = ahead
            path.append((x, passed))
        total = passed + (x.spans[0] if x is not node else 0)
        return [(x, total - before) for x, before in reversed(path)]

    def _split(self, node: Node) -> None:
        own = node.values
        cut = bisect_left(own, own[len(own) // 2]) or bisect_right(own, own[len(own) // 2])
        if cut == len(own):  # all values are equal
            return
        levels = 1
        while levels < LEVELS and self.random.random() < RISE:
            levels += 1
        for i in range(self.levels, levels):
            self.head.spans[i] = self.size
        self.levels = max(self.levels, levels)
        right = Node(own[cut], own[cut:], levels)
        del own[cut:]
        path = self._path(node) if node is not self.head else [(self.head, 0)] * self.levels
        for i in range(levels):
            before, gap = (node, 0) if i < len(node.nexts) else path[i]
            gap += len(own)
            right.nexts[i], right.spans[i] = before.nexts[i], before.spans[i] - gap
            before.nexts[i], before.spans[i] = right, gap

    def _unlink(self, node: Node) -> None:
        for i, (before, _) in enumerate(self._path(node)[: len(node.nexts)]):
            before.nexts[i] = node.nexts[i]
            before.spans[i] += node.spans[i]

    def find(self, rank: int) -> tuple[list[int], int]:
        """The run that holds the value of a rank (from 0), and its place there."""
        node = self.head
        for i in range(self.levels - 1, -1, -1):
            while rank >= (span := node.spans[i]) and node.nexts[i] is not None:
                rank -= span
                node = node.nexts[i]
        return node.values, rank

    def at(self, rank: int) -> int:
        run, i = self.find(rank)
        return run[i]

    def median2(self) -> int:
        """The sum of the two middle values, or twice the only one."""
        run, i = self.find((self.size - 1) // 2)
        if self.size % 2:
            return 2 * run[i]
        return run[i] + (run[i + 1] if i + 1 < len(run) else self.at(self.size // 2))

    def mad4(self, middle: int) -> int:
        """The doubled median of |2 * value - middle|.

        The k least deviations are those of k neighbours in order, from rank a on: a is the first rank whose value is
        no further below the middle than the value k ranks on lies above it. It moves little from one
        window to the next, so the search starts where the last one ended, within two runs of values.
        """
        n, k = self.size, (self.size + 1) // 2
        a, known = min(self.start, n - k - 1), n - k
        while True:
            low, i = self.find(a)
            high, j = self.find(a + k)
            first, past = -min(i, j), min(len(low) - i, len(high) - j)
            x, y = first, past
            while x < y:
                s = (x + y) // 2
                if low[i + s] + high[j + s] >= middle:
                    y = s
                else:
                    x = s + 1
            if x == first and a + x > 0 and a + x <= known and x < past:  # the first may lie further down
                known = a + x
                a = known - 1
                continue
            a += x
            if x < past or a >= known:
                break
        i, j = i + x, j + x
        self.start = a
        below = low[i] if 0 <= i < len(low) else self.at(a)
        above = high[j - 1] if 0 < j <= len(high) else self.at(a + k - 1)
        far = max(middle - 2 * below, 2 * above - middle)
        if n % 2:
            return 2 * far
        ends = []
        if a > 0:
            ends.append(middle - 2 * (low[i - 1] if 0 < i <= len(low) else self.at(a - 1)))
        if a + k < n:
            ends.append(2 * (high[j] if 0 <= j < len(high) else self.at(a + k)) - middle)
        return far + min(ends)


class Window:
    """What one series' slice has gathered: the values by age, and sorted."""

    def __init__(self, micros: int):
        self.micros, self.sorted, self.times, self.values, self.oldest = micros, SkipList(), [], [], 0

    def move(self, time: int, values: list[int]) -> None:
        limit, times, queue, i = time - self.micros, self.times, self.values, self.oldest
        while i < len(times) and times[i] < limit:
            self.sorted.remove(queue[i])
            i += 1
        if i > 4096 and 2 * i > len(times):
            del times[:i], queue[:i]
            i = 0
        self.oldest = i
        for v in values:
            self.sorted.insert(v)
            times.append(time)
            queue.append(v)

    def answer(self) -> tuple[int, int, int]:
        n = self.sorted.size
        if n < LEAST:
            return n, 0, 0
        middle = self.sorted.median2()
        return n, middle, self.sorted.mad4(middle)


def _slices(micros: int, length: int, schema: pa.Schema):
    """Sorted rows (slice, series, time, id, cents) to answers for the slices' own rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, owner, held = None, None, None

        def answer(rows: pa.Table) -> pa.RecordBatch:
            nonlocal window, owner
            number, time = rows.column("slice").to_numpy(), rows.column("t").to_numpy()
            series = rows.column("series").combine_chunks().dictionary_encode(null_encoding="encode")
            names, series = series.dictionary.to_pylist(), series.indices.to_numpy()
            cents = rows.column("cents").combine_chunks()
            has = cents.is_valid().to_numpy(zero_copy_only=False)
            cents = cents.fill_null(0).to_numpy()
            starts = np.flatnonzero(np.append(True, (number[1:] != number[:-1]) | (series[1:] != series[:-1]) | (time[1:] != time[:-1])))
            values = cents[has].tolist()
            counted = np.append(0, np.cumsum(has))
            value_at = counted[np.append(starts, len(time))].tolist()
            own = number == time // length
            groups = zip(number[starts].tolist(), series[starts].tolist(), time[starts].tolist(), own[starts].tolist(), strict=True)
            got = []
            for g, (s, name, t, counts) in enumerate(groups):
                if owner != (s, names[name]):
                    window, owner = Window(micros), (s, names[name])
                window.move(t, values[value_at[g] : value_at[g + 1]])
                got.append(window.answer() if counts else (0, 0, 0))
            n, middle, mad = np.repeat(np.array(got, np.int64).T, np.diff(np.append(starts, len(time))), axis=1)[:, own]
            few, c = n < LEAST, cents[own]
            far = 2 * np.abs(2 * c - middle) > 5 * mad
            kept = rows.filter(pa.array(own)).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [*[kept.column(x).combine_chunks() for x in ("id", "series")], pa.array(n), pa.array(middle, mask=few), pa.array(mad, mask=few), pa.array(far, mask=few | ~has[own])], schema=schema
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            last = [rows.column(c)[-1] for c in ("slice", "series", "t")]
            i = batch.num_rows  # rows of the last time may go on in the next batch
            keys = [batch.column(c) for c in ("slice", "series", "t")]
            while i and all(k[i - 1] == v for k, v in zip(keys, last, strict=True)):
                i -= 1
            whole = rows.num_rows - batch.num_rows + i
            if i == 0 and held is not None and all(held.column(c)[-1] == v for c, v in zip(("slice", "series", "t"), last, strict=True)):
                held = rows
                continue
            if whole:
                yield answer(rows.slice(0, whole))
            held = rows.slice(whole)
        if held is not None:
            yield answer(held)
        give_back()

    return run


def micros_of(ts: Column) -> Column:
    """Microseconds since 1970 of a time as its clock shows it, whatever the session's zone."""
    seconds = F.unix_date(ts.cast("date")).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def cents_of(value: Column) -> Column:
    """floor(100 * value + 0.5); null for a null, and for what is not finite or too large to be doubled four times as a long."""
    x = value.cast("double") * 100
    return F.floor(F.when(F.abs(x) < float(LIMIT), x + 0.5)).cast("long")


def once(events: DataFrame, key: Column, ts: Column, series: Column, value: Column) -> DataFrame:
    """``id, series, t, cents``: each id once, reduced before the shuffle; of rows that differ under one id, the earliest, then the least series and value."""
    d = events.select(key.cast("long").alias("id"), series.cast("string").alias("series"), micros_of(ts).alias("t"), cents_of(value).alias("cents"))
    first = F.min(F.struct(F.col("t").isNull().alias("x"), "t", "series", "cents"))
    d = d.groupBy("id").agg(first.alias("r"))
    return d.filter("NOT r.x").select("id", "r.series", "r.t", "r.cents")


def rolling_mad(
    events: DataFrame, id_col: str = "click_id", ts_col: str = "ts", series_col: str = "kind", value_col: str = "value", minutes: int = MINUTES, slice_windows: int = SLICE_WINDOWS
) -> DataFrame:
    """Per event: id, series, n (values in its window), median2, mad4 (doubled median, and doubled median of |2 * value - median2|), far.

    An event's window holds the values, as cents, of its series' events from ``minutes`` before it up to its own time, all events at its own
    time included. Under ``LEAST`` values there is no median, MAD or ``far``; without a value of its own an event has no
    ``far``. Each id counts once (see ``once``; rows without id count as one id), events without time are left out, a null series is a
    series, and a value that is null, not finite or beyond 2^57 cents is none. An empty table gives no rows; other columns,
    whatever their names, are not read. A slice is ``slice_windows`` windows long.
    """
    micros = minutes * 60_000_000
    length = micros * slice_windows
    d = once(events, F.col(id_col), F.col(ts_col), F.col(series_col), F.col(value_col))
    of = lambda t: F.expr(f"({t} - pmod({t}, {length}L)) DIV {length}L")
    d = d.withColumn("slice", F.explode(F.sequence(of("t"), of(f"(t + {micros}L)"))))
    d = d.repartition("slice", "series").sortWithinPartitions("slice", "series", "t")
    out = StructType()
    for name, kind in ((id_col, "long"), (series_col, "string"), ("n", "long"), ("median2", "long"), ("mad4", "long"), ("far", "boolean")):
        out = out.add(name, kind)
    arrow = pa.schema([(id_col, pa.int64()), (series_col, pa.string()), ("n", pa.int64()), ("median2", pa.int64()), ("mad4", pa.int64()), ("far", pa.bool_())])
    return d.select("slice", "series", "t", "id", "cents").mapInArrow(_slices(micros, length, arrow), out)
