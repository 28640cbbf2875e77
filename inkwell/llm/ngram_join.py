"""Exact n-gram Jaccard self-join by a forest of count-vector R-trees.

A text's shingles are hashed into groups, and a text is the point of its group counts: two
texts share at most the summed minima of their coordinates. A single tree over all points
cannot prune: a radius of J >= 0.85 spans 16 % of a text's shingles, and random texts are
farther apart than that only in so many dimensions that every bounding box of a few points
covers the query. So points are first routed to cells: the groups are dealt into P blocks,
more than the shingles that two linked texts can differ in, hence linked texts hold the very same
shingles in some block, and a block's content is a cell. Cells where all members
turn out connected are done after a star of checks around their smallest member. In each
other cell an R-tree over the members' group counts finds the pairs whose bound reaches the
threshold, and these are verified on whole shingle sets.

Block counts hold for a class of sizes; a text is dealt for each class its larger partners
can be of. Texts of equal shingle sets are one node from the start, so copies cost nothing.
Cells with many members are dealt again by another hash, which loses no pair since linked texts
agree on a block under every hash; those that stay large are joined in parts, each part with each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.components import components
from inkwell.llm.scratch import Scratch
from inkwell.llm.words import U64, chunks, give_back, mix, regroup, scan_batch, shingles

SHINGLE, PERCENT = 4, 85
#: Growth of size classes; bytes of text in a chunk; cell entries in a bucket on average; members, and their shingles, that one tree joins.
CLASS_GROWTH, CHUNK, BUCKET_ENTRIES, CELL_MEMBERS, CELL_SHINGLES = 1.4, 2 << 20, 1_000_000, 4000, 4_000_000
#: What one round may carry between tasks beside its keys: this share of all bytes of text, and no fewer bytes than these.
ROUND_SHARE, ROUND_BYTES = 0.5, 64 << 20
#: Shingles whose cells are found at once.
SHINGLES_AT_ONCE = 1 << 16
#: Members of a part of a cell that no hash divides; a tree joins two parts.
PART_MEMBERS = 2000
#: How many comparisons of points a group costs besides its own.
GROUP_COST = 2000
#: R-tree: points in a leaf, nodes in a node.
LEAF, FAN = 16, 8


def size_classes(percent: int, upto: int) -> np.ndarray:
    """Lower bounds of the size classes."""
    out = [1]
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, int(out[-1] * CLASS_GROWTH)))
    return np.array(out, np.int64)


def blocks_of(top: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(blocks, spare) of a class whose largest size is ``top``: linked texts differ in at most r shingles, so of r + 1 + 2 spare blocks they share 1 + 2 spare; each may leave out ``spare``."""
    r = 2 * (100 - percent) * top // (100 + percent)
    spare = r // 20
    return np.where(r > 0, r + 1 + 2 * spare, 0), spare


def distinct_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, in a row, and where each text's begin."""
    values, counts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for _, _, w in scan_batch(texts):
        h, first = shingles(w, n)
        keep = np.ones(len(h), bool)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            h[a:b].sort()
        keep[1:] = h[1:] != h[:-1]
        keep[first[:-1][first[:-1] < len(h)]] = True
        total = np.concatenate([[0], np.cumsum(keep)])
        values.append(h[keep])
        counts.append(total[first[1:]] - total[first[:-1]])
    return np.concatenate(values), np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)


def set_ids(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; 0 for the empty one."""
    size = np.diff(first)
    total = np.concatenate([[U64(0)], np.cumsum(mix(h), dtype=U64)])
    with np.errstate(over="ignore"):
        return np.where(size > 0, mix(total[first[1:]] - total[first[:-1]] + size.astype(U64)), U64(0)).view(np.int64)


def cells(h: np.ndarray, first: np.ndarray, percent: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, text) of every block that each text's set takes part in; of some texts at a time, since a shingle takes many numbers on the way."""
    parts = [(_cells(h[first[i] : first[j]], first[i : j + 1] - first[i], percent, seed), i) for i, j in chunks(first, SHINGLES_AT_ONCE)]
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *[key for (key, _), _ in parts]]), np.concatenate([nothing, *[text + i for (_, text), i in parts]])


def _cells(h: np.ndarray, first: np.ndarray, percent: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(first)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lows = size_classes(percent, int(size.max()) * 100 // percent + 1)
    own = np.searchsorted(lows, size, "right") - 1
    last = np.searchsorted(lows, size * 100 // percent, "right") - 1
    text, kind = [], []
    for more in range(int((last - own).max()) + 1):
        some = np.flatnonzero((own + more <= last) & (size > 0))
        text.append(some)
        kind.append(own[some] + more)
    text, kind = np.concatenate(text), np.concatenate(kind)
    count, spare = blocks_of(lows[np.minimum(kind + 1, len(lows) - 1)] - 1, percent)
    text, kind, count, spare = (x[count > 0] for x in (text, kind, count, spare))
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = size[text]
    entry = np.repeat(np.arange(len(text)), n)
    value = h[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[text], n)]
    base = np.concatenate([[0], np.cumsum(count)])
    salt = mix((kind + 1 + 1000 * seed).astype(U64))
    v = mix(value ^ salt[entry])
    slot = base[entry] + ((v >> U64(32)) % count.astype(U64)[entry]).astype(np.int64)
    many = np.bincount(slot, minlength=base[-1])
    # Sums of 32-bit halves are exact in doubles up to 2^21 shingles a block.
    v = mix(v)
    low = np.bincount(slot, (v & U64(0xFFFFFFFF)).astype(np.float64), base[-1])
    high = np.bincount(slot, (v >> U64(32)).astype(np.float64), base[-1])
    of = np.repeat(np.arange(len(text)), count)
    nth = np.arange(base[-1]) - base[of]
    with np.errstate(over="ignore"):
        key = mix(low.astype(U64) + (high.astype(U64) << U64(32)) + mix(salt[of] + nth.astype(U64)) + many.astype(U64))
    if spare.any():  # leave out each text's poorest blocks, in an order that depends on their content alone
        order = np.lexsort((key, many, of))
        kept = order[nth >= spare[of]]  # entries stand in order, so nth also counts within the sorted ones
        key, of = key[kept], of[kept]
    return key.view(np.int64), text[of]


def group_count(n: int) -> int:
    """Groups of a set of n shingles, a power of two: one or two shingles fall into each, so that the bound comes near the overlap itself."""
    return min(1 << max(5, int(n).bit_length() - 1), 8192)


def point(h: np.ndarray) -> bytes:
    """A set as group counts; nothing where a count does not fit, which bounds nothing."""
    counts = np.bincount((h >> U64(20)).astype(np.int64) & (group_count(len(h)) - 1), minlength=group_count(len(h)))
    if not len(h) or counts.max() < 1 << 8:
        return b"1" + zlib.compress(counts.astype("<u1").tobytes(), 1)
    return b"2" + zlib.compress(counts.astype("<u2").tobytes(), 1) if counts.max() < 1 << 16 else b""


def counts_of(point: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(point[1:]), f"<u{point[:1].decode()}")


NODE = "doc_id long, n long, sid long, uid string, point binary"
NODE_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sid", pa.int64()), ("uid", pa.string()), ("point", pa.binary())])
DEALT = "bucket long, keys binary, sids binary"
DEALT_ARROW = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("sids", pa.binary())])
#: The first of the numbers, downwards, that stand for members that meet inside a chunk already.
WITHIN = -1


def _members(key: np.ndarray, sid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (cell, node), and True at those whose cell has others."""
    order = np.lexsort((sid, key))
    key, sid = key[order], sid[order]
    new = np.append(True, (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])) if len(key) else np.zeros(0, bool)
    key, sid = key[new], sid[new]
    same = key[1:] == key[:-1]
    return key, sid, np.append(False, same) | np.append(same, False) if len(key) else np.zeros(0, bool)


def _name(shingle: int):
    """Texts to their nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, 1, CHUNK):
            h, first = distinct_sets(batch.column(1), shingle)
            points = pa.array([point(h[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(first)), pa.array(set_ids(h, first)), batch.column(2), points], schema=NODE_ARROW)

    return run


def _deal(shingle: int, percent: int, buckets: int):
    """Texts to the cells they take part in, packed by buckets of cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, 0, CHUNK):
            h, first = distinct_sets(batch.column(0), shingle)
            key, text = cells(h, first, percent, 0)
            key, sid, shared = _members(key, set_ids(h, first)[text])
            rows = [(WITHIN - int(key[shared][0].view(U64) % U64(buckets)), key[shared].tobytes(), sid[shared].tobytes())] if shared.any() else []
            lead = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
            key, sid = key[lead], sid[lead]  # one member of a cell stands for the chunk's others
            to = (key.view(U64) % U64(buckets)).astype(np.int64)
            by = np.argsort(to, kind="stable")
            ends = np.searchsorted(to[by], np.arange(buckets + 1))
            rows += [(r, key[own].tobytes(), sid[own].tobytes()) for r in range(buckets) if len(own := by[ends[r] : ends[r + 1]])]
            if rows:
                r, k, s = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(k, pa.binary()), pa.array(s, pa.binary())], schema=DEALT_ARROW)

    return run


MEMBER = "cell long, sid long"
MEMBER_ARROW = pa.schema([("cell", pa.int64()), ("sid", pa.int64())])


def _meet(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's cells that have more than one member, and what met inside chunks as it is."""
    keys, sids = [], []
    for batch in batches:
        for k, s in zip(batch.column("keys"), batch.column("sids"), strict=True):
            k, s = np.frombuffer(k.as_py(), np.int64), np.frombuffer(s.as_py(), np.int64)
            if key[0].as_py() <= WITHIN:
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(s)], schema=MEMBER_ARROW)
            else:
                keys.append(k)
                sids.append(s)
    if keys:
        k, s, shared = _members(np.concatenate(keys), np.concatenate(sids))
        yield pa.RecordBatch.from_arrays([pa.array(k[shared]), pa.array(s[shared])], schema=MEMBER_ARROW)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    most = min(len(a), len(b))
    if 100 * most < percent * max(len(a), len(b)):
        return False
    inter = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * inter >= percent * (len(a) + len(b) - inter)


PAIR = "a long, b long"
PAIR_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


NEAR = "hub long, sid long, star boolean"
NEAR_ARROW = pa.schema([("hub", pa.int64()), ("sid", pa.int64()), ("star", pa.bool_())])


def _neighbours(percent: int):
    """A hub's group to those members that have another within the bound; ``star``: the hub itself is."""

    def run(table: pa.Table) -> pa.Table:
        hub, sid, n = table.column("hub")[0].as_py(), table.column("sid").to_pylist(), table.column("n").to_numpy()
        raw = table.column("point").to_pylist()
        open_, star = np.array([not p for p in raw]), np.zeros(len(sid), bool)
        some = np.flatnonzero(~open_)
        if len(some):
            unpacked = [counts_of(raw[i]) for i in some.tolist()]
            m = min(map(len, unpacked))
            kind = np.uint16 if n.max() < 1 << 16 else np.int64
            points = np.stack([u.reshape(-1, m).sum(0, dtype=kind) for u in unpacked])
            met = np.full(len(some), open_.any())
            at = next((k for k, i in enumerate(some.tolist()) if sid[i] == hub), None)
            if len(some) <= 2 * LEAF:
                size = n[some]
                near = RTree.may(points[:, None], size[:, None], points[None], size[None], size[None], percent)
                np.fill_diagonal(near, False)
                met |= near.any(1)
                if at is not None:
                    star[some[near[at]]] = True
            else:
                tree = RTree(points, n[some])
                for k in range(len(some)):
                    if not met[k] or k == at:
                        found = tree.search(points[k], int(n[some[k]]), percent)
                        others = found[found != k]
                        met[k] |= len(others) > 0
                        met[others] = True
                        if k == at:
                            star[some[others]] = True
            open_[some] = met
        if not raw[sid.index(hub)]:
            star[:] = True
        star |= np.array([not p for p in raw])
        star[sid.index(hub)] = False
        keep = np.flatnonzero(open_)
        return pa.Table.from_arrays([pa.array(np.full(len(keep), hub)), pa.array([sid[i] for i in keep.tolist()], pa.int64()), pa.array(star[keep])], schema=NEAR_ARROW)

    return run


def _verify(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                (x, fx), (y, fy) = (distinct_sets(part.column(c), shingle) for c in ("text_a", "text_b"))
                good = [_linked(x[fx[i] : fx[i + 1]], y[fy[i] : fy[i + 1]], percent) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], schema=PAIR_ARROW).filter(pa.array(good, pa.bool_()))

    return run


SET = "sid long, n long, shingles binary"


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                h, f = distinct_sets(part.column("text"), shingle)
                yield pa.RecordBatch.from_arrays([part.column("sid"), pa.array(np.diff(f)), pa.array([h[a:b].tobytes() for a, b in zip(f[:-1], f[1:], strict=True)], pa.binary())], names=["sid", "n", "shingles"])

    return run


def _cells_again(percent: int, seed: int):
    """Sets to their cells under another hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, s in zip(batch.column("sid").to_pylist(), batch.column("shingles"), strict=True):
                h = np.frombuffer(s.as_py(), U64)
                key, _ = cells(h, np.array([0, len(h)]), percent, seed)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(len(key), sid))], schema=MEMBER_ARROW)

    return run


class RTree:
    """Points of group counts, packed in order of size; every node knows its box's upper corner and its smallest size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # corner, smallest, largest, first child
        corner, low, high, step = self.points, self.sizes, self.sizes, LEAF
        while True:
            first = np.arange(0, len(corner), step)
            corner, low, high = np.maximum.reduceat(corner, first), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
            self.levels.append((corner, low, high, np.append(first, len(self.points) if len(self.levels) == 0 else len(self.levels[-1][1]))))
            if len(first) == 1:
                break
            step = FAN

    @staticmethod
    def may(point: np.ndarray, size: int, corner: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> np.ndarray:
        """Overlap is at most the summed minima, and J >= t needs t / (1 + t) of both sizes together."""
        bound = np.minimum(corner, point).sum(-1, dtype=np.int64)
        return ((100 + percent) * bound >= percent * (size + low)) & (100 * high >= percent * size) & (100 * size >= percent * low)

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Positions (as given) of the points that may reach the threshold."""
        nodes = np.arange(len(self.levels[-1][1]))
        for corner, low, high, first in reversed(self.levels):
            nodes = nodes[self.may(point, size, corner[nodes], low[nodes], high[nodes], percent)]
            if not len(nodes):
                return nodes
            n = first[nodes + 1] - first[nodes]
            nodes = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[nodes], n)
        return self.order[nodes[self.may(point, size, self.points[nodes], self.sizes[nodes], self.sizes[nodes], percent)]]


def tree_links(sets: list[np.ndarray], labels: list[int], percent: int) -> list[tuple[int, int]]:
    """Links (positions in ``sets``) that join sets of different labels: enough of them to connect whatever the cell connects."""
    sizes = np.array([len(s) for s in sets])
    groups = group_count(int(sizes.max()))
    points = np.stack([np.bincount((s >> U64(20)).astype(np.int64) & (groups - 1), minlength=groups) for s in sets]).astype(np.uint16 if sizes.max() < 1 << 16 else np.int64)
    tree, root, out = RTree(points, sizes), {x: x for x in labels}, []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, s in enumerate(sets):
        for j in tree.search(points[i], int(sizes[i]), percent).tolist():
            if j > i and (p := find(labels[i])) != (q := find(labels[j])) and _linked(s, sets[j], percent):
                root[q] = p
                out.append((i, j))
    return out


def _cell_join(percent: int):
    def run(table: pa.Table) -> pa.Table:
        sid, label = table.column("sid").to_pylist(), table.column("label").to_pylist()
        sets = [np.frombuffer(s.as_py(), U64) for s in table.column("shingles")]
        found = tree_links(sets, label, percent)
        return pa.Table.from_arrays([pa.array([sid[i] for i, _ in found], pa.int64()), pa.array([sid[j] for _, j in found], pa.int64())], schema=PAIR_ARROW)

    return run


def _in_rounds(scratch: Scratch, name: str, held: int, room: int, step) -> DataFrame:
    """What ``step(own)`` gives, where ``own(rows, *keys)`` are a round's rows: all rows with equal keys in the same one of as many rounds as ``held`` bytes need.

    Points, texts and sets travel once for each group they take part in, and groups grow with the input: together that may be
    many times the input, so no more than ``room`` bytes of it are there at a time."""
    rounds, out = max(1, -(-int(held) // room)), None
    for k in range(rounds):
        part = scratch.save(step(lambda rows, *keys, k=k: rows.filter(F.pmod(F.xxhash64(*keys), F.lit(rounds)) == k) if rounds > 1 else rows), f"{name}-{k}")
        out = part if out is None else out.unionByName(part)
        scratch.release()
    return out


def _solve(scratch: Scratch, rows: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``rows(doc_id, text, uid)`` to nodes(doc_id, n, sid, uid), a row each, and labels(sid, label) of every set."""
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    buckets = max(1, int(size * 0.05 // BUCKET_ENTRIES) + 1)  # a text has about one cell for 20 bytes
    room = max(ROUND_BYTES, int(size * ROUND_SHARE))
    nodes = scratch.save(rows.select("doc_id", "text", "uid").mapInArrow(_name(shingle), NODE), "nodes")
    # Cells go straight to where they meet; written first, they would take as much disk once more.
    members = scratch.save(rows.select("text").mapInArrow(_deal(shingle, percent, buckets), DEALT).groupBy("bucket").applyInArrow(_meet, MEMBER), "members")
    scratch.release()

    hubs = scratch.save(members.groupBy("cell").agg(F.min("sid").alias("hub"), F.max("sid").alias("other"), F.count(F.lit(1)).alias("held")).filter("hub <> other").select("cell", "hub", "held"), "hubs")
    pairs = scratch.save(members.join(hubs.hint("merge"), "cell").filter("sid <> hub").select(F.col("hub").alias("a"), F.col("sid").alias("b")).distinct(), "pairs")
    points = nodes.groupBy("sid").agg(F.min("n").alias("n"), F.min("point").alias("point"))
    around = pairs.select(F.col("a").alias("hub"), F.col("b").alias("sid")).unionByName(pairs.select(F.col("a").alias("hub"), F.col("a").alias("sid")).distinct())
    around = scratch.save(around.join(points.hint("merge"), "sid"), "around")
    nodes_of = around.groupBy("hub").agg(F.count(F.lit(1)).alias("nodes"))
    by_cell = hubs.groupBy("hub").agg(F.sum(F.expr(f"held * held + {GROUP_COST}")).alias("cost"))
    groups = nodes_of.join(by_cell.hint("merge"), "hub").filter(f"nodes > {CELL_MEMBERS} OR nodes * nodes > cost").select("hub")
    groups = scratch.save(groups, "groups")
    points_of = lambda d: d.agg(F.sum(F.coalesce(F.length("point"), F.lit(0)) + 40).alias("b")).first().b or 0
    near = _in_rounds(scratch, "near_hubs", points_of(around), room, lambda own: own(around, "hub").join(groups.hint("merge"), "hub", "left_anti").groupBy("hub").applyInArrow(_neighbours(percent), NEAR))
    scratch.drop("around")
    # A hub with more around it than one tree should join gets a tree for each of its cells; of a cell that is still too large, all are kept.
    within = members.join(hubs.hint("merge"), "cell").join(groups.hint("merge"), "hub", "left_semi").select("cell", "hub", "sid").distinct()
    within = scratch.save(within.join(points.hint("merge"), "sid"), "within")
    huge = scratch.save(within.groupBy("cell").agg(F.count(F.lit(1)).alias("nodes")).filter(f"nodes > {CELL_MEMBERS}").select("cell"), "huge")
    near = near.unionByName(_in_rounds(scratch, "near_cells", points_of(within), room, lambda own: own(within, "cell").join(huge.hint("merge"), "cell", "left_anti").groupBy("cell").applyInArrow(_neighbours(percent), NEAR)))
    near = near.unionByName(within.join(huge.hint("merge"), "cell", "left_semi").select("hub", "sid", (F.col("sid") != F.col("hub")).alias("star")))
    near = scratch.save(near.groupBy("hub", "sid").agg(F.max("star").alias("star")), "near")
    scratch.drop("within")
    pairs = near.filter("star").select(F.col("hub").alias("a"), F.col("sid").alias("b"))
    asked = scratch.save(near.select("sid").unionByName(pairs.select(F.col("a").alias("sid"))).distinct(), "asked")
    one = nodes.groupBy("sid").agg(F.min("uid").alias("uid")).join(asked.hint("merge"), "sid")
    texts = rows.select("uid", "text").join(one.hint("merge"), "uid").groupBy("sid").agg(F.first("text").alias("text"))
    texts = scratch.save(texts, "texts")
    scratch.release()
    side = lambda c: texts.select(F.col("sid").alias(c), F.col("text").alias(f"text_{c}")).hint("merge")
    held = pairs.join(texts.select(F.col("sid").alias("a"), F.octet_length("text").alias("held")).hint("merge"), "a").agg(F.sum("held").alias("held")).first().held or 0
    links = _in_rounds(scratch, "links1", held, room, lambda own: own(pairs, "a").join(side("a"), "a").join(side("b"), "b").mapInArrow(_verify(shingle, percent), PAIR))
    labels = components(links, scratch, "round1")

    open_ = members.join(asked.hint("merge"), "sid", "left_semi").join(labels.withColumnRenamed("node", "sid").hint("merge"), "sid", "left").select("cell", "sid", F.coalesce("label", "sid").alias("label")).distinct()
    more = _tree_rounds(scratch, open_, texts, shingle, percent, room)
    links = scratch.save(links.unionByName(more), "links2")
    labels = components(links, scratch, "round2").withColumnRenamed("node", "sid")
    named = scratch.save(nodes.select("sid").distinct().join(labels.hint("merge"), "sid", "left").select("sid", F.coalesce("label", "sid").alias("label")), "named")
    scratch.release()
    return nodes, named


def _rows(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)
    own = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text")]
    return rows.withColumn("uid", F.concat(F.hex(F.xxhash64(*own)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *own))))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable by links, its own included).

    Words are runs of characters other than ASCII white space, A-Z lower-cased; two texts link when
    100 * intersection >= percent * union of their distinct word ``shingle``-grams (a text of fewer words has its
    whole sequence as one). A null text or one without words links with nothing and keeps its own id. A row
    without id takes part; its component is the smallest id that is there, or null. Rows that repeat
    one another are links of one component. An empty table gives no rows. Only id and text are read.
    """
    with Scratch(docs.sparkSession, "ngram") as scratch:
        nodes, labels = _solve(scratch, _rows(docs, id_col, text_col), shingle, percent)
        of = scratch.save(nodes.groupBy("sid").agg(F.min("doc_id").alias("id")).join(labels.hint("merge"), "sid"), "of")
        least = of.groupBy("label").agg(F.min("id").alias("component_id"))
        named = scratch.save(of.join(least.hint("merge"), "label").select("sid", "component_id"), "components")
        out = nodes.join(named.hint("merge"), "sid")
        return scratch.result(out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Of each component's rows the one with the smallest id, with all its columns as they are; texts without words all stay. Rows that repeat both id and text are one. A null id comes after all others. An empty table gives no rows; columns of any names stay."""
    with Scratch(docs.sparkSession, "ngram") as scratch:
        nodes, labels = _solve(scratch, _rows(docs, id_col, text_col), shingle, percent)
        # By set first, so that copies are counted before they meet.
        best = F.min(F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("id"), F.col("uid").alias("uid")))
        of = nodes.filter("n > 0").groupBy("sid").agg(best.alias("best")).join(labels.hint("merge"), "sid")
        keep = of.groupBy("label").agg(F.min("best").alias("best")).select("best.uid").unionByName(nodes.filter("n = 0").select("uid")).distinct()
        keep = scratch.result(keep, "keep")
        rows = _rows(docs, id_col, text_col, F.struct(*docs.columns).alias("row")).select("uid", "row")
        kept = rows.join(keep.hint("merge"), "uid").groupBy("uid").agg(F.first("row").alias("row"))
        return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _still_open(members: DataFrame, least: int) -> DataFrame:
    """The members of cells with more than one label and ``least`` members or more, one of the cells that have the same members."""
    per = members.groupBy("cell").agg(F.count(F.lit(1)).alias("many"), F.min("label").alias("x"), F.max("label").alias("y"), F.sum(F.xxhash64("sid").cast("decimal(38,0)")).alias("same"))
    per = per.filter(f"x <> y AND many >= {least}").groupBy("many", "same").agg(F.min("cell").alias("cell"))
    return members.join(per.select("cell", "many").hint("merge"), "cell")


def _in_parts(members: DataFrame) -> DataFrame:
    """Members of large cells in parts, each with every part of its cell, so that any two members meet in a tree."""
    d = members.withColumn("_parts", F.ceil(F.col("many") / PART_MEMBERS)).withColumn("_own", F.pmod(F.xxhash64("sid"), F.col("_parts")))
    d = d.withColumn("_other", F.explode(F.expr("sequence(0L, _parts - 1)")))
    return d.select("cell", "sid", "label", F.least("_own", "_other").alias("x"), F.greatest("_own", "_other").alias("y"))


def _tree_rounds(scratch: Scratch, members: DataFrame, texts: DataFrame, shingle: int, percent: int, room: int) -> DataFrame:
    """Links found by R-trees among the members of the cells that the stars have left open. Two members may be left of a cell whose hub has no possible partner, and that hub's star did not compare them.

    The cells of one smallest member share most of their members, so they get one tree and a set travels once to
    it. Where that would be more than a task should join, each cell gets its own; a cell that is
    still too large is dealt again by another hash, and what that leaves in one large cell is joined in parts.
    """
    seed = 1
    open_ = scratch.save(_still_open(members, 2), "open0")
    sets = texts.join(open_.select("sid").distinct().hint("merge"), "sid", "left_semi").mapInArrow(_sets(shingle), SET)
    sets = scratch.save(sets, "sets")
    hubs = open_.groupBy("cell").agg(F.min("sid").alias("hub"))
    around = open_.join(hubs.hint("merge"), "cell").select("hub", "sid", "label").distinct().join(sets.select("sid", "n").hint("merge"), "sid")
    around = scratch.save(around, "held")
    fits = around.groupBy("hub").agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("held")).filter(f"nodes <= {CELL_MEMBERS} AND held <= {CELL_SHINGLES}").select("hub")
    fits = scratch.save(fits, "fits")
    sizes = sets.select("sid", F.expr("8 * n + 40").alias("b")).hint("merge")
    sets_of = lambda d: d.join(sizes, "sid").agg(F.sum("b").alias("b")).first().b or 0
    once = around.join(fits.hint("merge"), "hub").drop("n")
    out = _in_rounds(scratch, "found0", sets_of(once), room, lambda own: own(once, "hub").join(sets.hint("merge"), "sid").groupBy("hub").applyInArrow(_cell_join(percent), PAIR))
    open_ = open_.join(hubs.hint("merge"), "cell").join(fits.hint("merge"), "hub", "left_anti").drop("hub")
    open_ = scratch.save(open_, "large0")
    while not open_.isEmpty():
        last = seed > 1  # a cell that another hash leaves large is held together by what its texts share, and no hash parts it: it is joined part by part
        small = open_.filter(f"many <= {CELL_MEMBERS}")
        out = out.unionByName(_in_rounds(scratch, f"found{seed}", sets_of(small), room, lambda own, small=small: own(small, "cell").join(sets.hint("merge"), "sid").groupBy("cell").applyInArrow(_cell_join(percent), PAIR)))
        if last:
            each = _in_parts(open_.filter(f"many > {CELL_MEMBERS}"))
            out = out.unionByName(_in_rounds(scratch, "parts", sets_of(each), room, lambda own, each=each: own(each, "cell", "x", "y").join(sets.hint("merge"), "sid").groupBy("cell", "x", "y").applyInArrow(_cell_join(percent), PAIR)))
        large = open_.filter(f"many > {CELL_MEMBERS}")
        if last or large.isEmpty():
            break
        again = sets.join(large.select("sid").distinct().hint("merge"), "sid", "left_semi").mapInArrow(_cells_again(percent, seed), MEMBER)
        large = large.select("cell", "sid", "label").join(again.withColumnRenamed("cell", "inner").hint("merge"), "sid")
        large = scratch.save(large.select(F.xxhash64("cell", "inner").alias("cell"), "sid", "label"), f"again{seed}")
        open_ = scratch.save(_still_open(large, 2), f"open{seed}")
        seed += 1
    return out
