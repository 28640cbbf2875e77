"""Near duplicates by SimHash fingerprints and BK-trees.

A text's fingerprint has a bit for each of the 64 bits of its shingles' hashes: 1 where over half of them have it.
Two fingerprints link when they differ in at most ``radius`` bits. Cut into ``radius + r`` blocks of bits, two such
fingerprints agree on ``r`` blocks at least; each choice of ``r`` blocks and their contents is a shard, so no link
is lost, and ``r`` grows with the number of fingerprints so that a shard stays small. A shard gets a BK-tree: a
child's edge is its Hamming distance to the parent, and a query at distance d from a node follows the edges from
d - radius to d + radius alone. A shard that holds too many (texts that hardly differ agree on all blocks) is split
in parts, and every part's tree meets the queries of every part. A tree and its queries send on no more links than
connect what they connect, so that a group of copies is never expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.components import components
from inkwell.llm.scratch import Scratch
from inkwell.llm.words import LOWER, give_back

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Shingles hashed at once. Fingerprints that a shard should hold on average, and that one tree holds at most. Pairs of query and node looked at at once.
HASHED, SHARD, PART, FRONTIER = 1 << 15, 64, 2048, 1 << 20
ROWS = "doc_id long, fp long"
ROWS_ARROW = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
LINKS = "a long, b long"
LINKS_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])
TABLE = LOWER.tobytes()


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Of a whole text; 0 for one without words. Words are parted by ASCII white space, A-Z lower-cased, a shingle's words joined by one blank."""
    from xxhash import xxh64_intdigest

    joined = b" ".join(text.translate(TABLE).split())
    if not joined:
        return 0
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    first, last = np.append(0, blanks + 1), np.append(blanks, len(joined))
    total = max(len(first) - shingle + 1, 1)
    first, last = first[:total], last[min(shingle, len(last)) - 1 :]
    ones = np.zeros(64, np.int64)
    for i in range(0, total, HASHED):
        own = zip(first[i : i + HASHED].tolist(), last[i : i + HASHED].tolist(), strict=True)
        h = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in own], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _prints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], schema=ROWS_ARROW)
        give_back()

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) per row; a null text counts as empty, whose fingerprint is 0."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_prints(shingle), ROWS)


def blocks_of(radius: int, agree: int) -> list[int]:
    """Masks of every choice of ``agree`` out of ``radius + agree`` blocks of bits."""
    ends = [64 * i // (radius + agree) for i in range(radius + agree + 1)]
    own = [(1 << hi) - (1 << lo) for lo, hi in zip(ends, ends[1:], strict=False)]
    return [sum(c) for c in combinations(own, agree)]


def agreement(count: int, radius: int) -> int:
    """The least number of blocks that parts ``count`` evenly spread fingerprints into shards of about ``SHARD``."""
    r = 1
    while r < 8 and count >> (64 // (radius + r) * r) > SHARD:
        r += 1
    return r


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class Forest:
    """A BK-tree for each unit, all grown together level by level; a unit's first member is its root, as if its members had been inserted one after the other.

    ``fp``: fingerprints, distinct within a unit. ``unit``: numbers from 0 up, not falling. ``tree``: which members are in the trees.
    """

    def __init__(self, fp: np.ndarray, unit: np.ndarray, tree: np.ndarray):
        self.fp, self.unit = fp, unit
        member = np.flatnonzero(tree)
        units = int(unit[-1]) + 1 if len(unit) else 0
        self.root = np.full(units, -1, np.int64)
        named, first = np.unique(unit[member], return_index=True)
        self.root[named] = member[first]
        self.size = np.bincount(unit[member], minlength=units)
        member = np.delete(member, first)
        parent = self.root[unit[member]]
        edges, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(member):
            edge, first, nth = np.unique(parent * 128 + np.bitwise_count(fp[member] ^ fp[parent]), return_index=True, return_inverse=True)
            edges.append(edge)
            children.append(member[first])
            rest = np.ones(len(member), bool)
            rest[first] = False
            member, parent = member[rest], member[first][nth[rest]]
        edge, child = np.concatenate(edges), np.concatenate(children)
        order = np.argsort(edge)
        self.edge, self.child = edge[order], child[order]

    def search(self, query: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, member) pairs of members within ``radius`` of a query of their unit, itself left out."""
        query = query[self.root[self.unit[query]] >= 0]
        cost = np.cumsum(self.size[self.unit[query]])
        at = 0
        while at < len(query):
            to = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + FRONTIER, "right")))
            q = query[at:to]
            node = self.root[self.unit[q]]
            while len(q):
                d = np.bitwise_count(self.fp[q] ^ self.fp[node]).astype(np.int64)
                near = (d <= radius) & (q != node)
                if near.any():
                    yield q[near], node[near]
                low = np.searchsorted(self.edge, node * 128 + np.maximum(d - radius, 0))
                n = np.searchsorted(self.edge, node * 128 + np.minimum(d + radius, 127), "right") - low
                node = self.child[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
                q = np.repeat(q, n)
            at = to


def connect(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (of each member the least of its component, as far as known) after links a-b."""
    while True:
        p, q = label[a], label[b]
        open_ = p != q
        if not open_.any():
            return label
        a, b, p, q = a[open_], b[open_], p[open_], q[open_]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while not np.array_equal(further := label[label], label):
            label = further


def _joined(radius: int):
    """Rows of whole units, in order of (c, key, x, y): links that connect what each unit's trees and queries connect."""

    def links(table: pa.Table) -> pa.RecordBatch:
        fp = table.column("fp").to_numpy().view(np.uint64)
        keys = np.stack([table.column(c).to_numpy() for c in ("c", "key", "x", "y")])
        unit = np.append(0, np.cumsum((keys[:, 1:] != keys[:, :-1]).any(0)))
        part = table.column("part").to_numpy()
        forest = Forest(fp, unit, part == keys[2])
        label = np.arange(len(fp))
        for a, b in forest.search(np.flatnonzero(part == keys[3]), radius):
            label = connect(label, a, b)
        own = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[own].view(np.int64)), pa.array(fp[label[own]].view(np.int64))], schema=LINKS_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("c", "key", "x", "y")])
            if not batch.num_rows:
                continue
            begins = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in ("c", "key", "x", "y")):
                begins = np.append(0, begins)
            if len(begins):  # the last unit may go on in the next batch
                yield links(pa.Table.from_batches([*held, batch.slice(0, begins[-1])]).combine_chunks()) if held or begins[-1] else pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, schema=LINKS_ARROW)
                held = [batch.slice(begins[-1])]
            else:
                held.append(batch)
        if held:
            yield links(pa.Table.from_batches(held).combine_chunks())
        give_back()

    return run


def _links(scratch: Scratch, distinct: DataFrame, radius: int, part: int) -> DataFrame:
    """``a, b``: links that connect whatever links of fingerprints connect."""
    masks = blocks_of(radius, agreement(distinct.count(), radius))
    key = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key")) for i, m in enumerate(masks)]))
    members = distinct.select("fp", key.alias("k")).select("k.c", "k.key", "fp")
    large = scratch.save(members.groupBy("c", "key").agg(F.count(F.lit(1)).alias("held")).filter(f"held > {part}"), "large")
    none = F.lit(0).cast("long")
    small = members if large.isEmpty() else members.join(large.hint("merge"), ["c", "key"], "left_anti")
    small = small.select("c", "key", none.alias("x"), none.alias("y"), none.alias("part"), "fp")
    split = members.join(large.hint("merge"), ["c", "key"]).withColumn("_parts", F.ceil(F.col("held") / (part // 2)).cast("long"))
    split = split.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("_parts"))).withColumn("_other", F.explode(F.expr("sequence(0L, _parts - 1)")))
    split = split.select("c", "key", F.least("part", "_other").alias("x"), F.greatest("part", "_other").alias("y"), "part", "fp")
    order = ["c", "key", "x", "y"]
    meet = lambda d: d.repartition(*order).sortWithinPartitions(*order, "fp").mapInArrow(_joined(radius), LINKS)
    found = meet(small)
    return scratch.save(found if large.isEmpty() else found.unionByName(meet(split)), "links")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, part: int = PART) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id reachable by links of at most ``radius`` bits, its own included).

    Texts with equal fingerprints are of one component, and so are all rows without words or text, whose fingerprint
    is zero. A row without id takes part; its component is the smallest id there is, or null. Repeated rows
    each come back. An empty table gives no rows. Only id and text are read, whatever other columns are named.
    """
    with Scratch(docs.sparkSession, "simhash") as scratch:
        prints = scratch.save(fingerprints(docs, id_col, text_col, shingle), "prints")
        distinct = scratch.save(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct")
        labels = components(_links(scratch, distinct, radius, part), scratch, "near").withColumnRenamed("node", "fp")
        of = scratch.save(distinct.join(labels.hint("merge"), "fp", "left").select("fp", "id", F.coalesce("label", "fp").alias("label")), "of")
        least = of.groupBy("label").agg(F.min("id").alias("component_id"))
        named = scratch.save(of.join(least.hint("merge"), "label").select("fp", "component_id"), "named")
        out = prints.join(named.hint("merge"), "fp")
        return scratch.result(out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
