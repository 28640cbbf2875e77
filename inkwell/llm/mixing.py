"""Mixing sources to target weights by Sainte-Lague apportionment, in built-in functions alone.

A source's words are laid out as a stream: its rows are dealt to shards by a seeded hash and
stand inside a shard in seeded order. A shard's stream is cut into blocks of (nearly) equal
words, smaller ones in a small source. The mix's words are seats: sources win them by the highest quotients
``target / (2k + 1)``, then a source's shards win its blocks the same way, which gives every
shard an integer quota. A quota takes the whole shard as often as it fits and, for the rest, a
run of blocks that starts at a seeded place, so few documents are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Words in a block at most, blocks that a source has at least (of one word, if need be), and rows in a shard on average (a shard is sorted in one task).
BLOCK_WORDS, LEAST_BLOCKS, SHARD_ROWS = 32, 256, 2_000
#: Steps of a quotient's height for each price of a seat.
HEIGHTS = 1 << 14


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _seeded(*cols: Column | str, seed: int) -> Column:
    """0 to 2^32 - 1 from an MD5, which other engines can compute too."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c, F.lit("\x00")) for c in cols])), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: tuple[int, int], most: int) -> DataFrame:
    """``source, source_size`` to the same with ``target``: shares by weight of ``share`` (a fraction) of all
    sizes, none above ``most`` times its size, the excess reshared by weight among the others.

    Sources stand in order of code point, null last, and take the weights in turn. Filling is done
    in closed form: with sources in order of cap / weight, the level is the first that does not
    reach the next source's cap. One row per source passes through one task.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ordered = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    d = sizes.withColumn("w", F.element_at(cycle, ((F.row_number().over(ordered) - 1) % len(weights) + 1).cast("int")))
    d = d.withColumn("cap", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary"))
    before, whole = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum("source_size").over(whole)
    left = F.coalesce(F.sum("w").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)), F.lit(0.0))
    d = d.withColumn("level", (total * share[0] - F.coalesce(F.sum("cap").over(before), F.lit(0)) * share[1]) / (left * share[1]))
    d = d.withColumn("nth", F.row_number().over(by_level))
    level = F.min_by("level", F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("nth"))).over(whole)
    filled = F.when(level.isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("w") * level))
    return d.withColumn("target", filled).select("source", "source_size", "target")


def sainte_lague(parties: DataFrame, group: list[str], votes: str, seats: str, name: list[str]) -> DataFrame:
    """``parties`` with ``won``: the seats of each by the highest quotients votes / (2k + 1), within each ``group``.

    ``seats`` is a column that is the same in a whole group. Only contested seats are listed: a
    party's number lies within parties / 2 + 1 of its exact share in proportion to its votes, so the
    list holds a few rows per party, whatever the number of seats, and of these a task orders only a group's that stand
    as high as its last seat. Ties fall to the first by ``name``. A group without seats or votes wins nothing, and no parties give no rows.
    """
    w = Window.partitionBy(*group)
    d = parties.withColumn("_all", F.sum(votes).over(w)).withColumn("_m", F.count(F.lit(1)).over(w))
    share = F.when(F.col("_all") > 0, F.col(seats) * F.col(votes) / F.col("_all")).otherwise(F.lit(0.0))
    slack = F.when(F.col("_all") > 0, F.col("_m") * F.col(votes) / (2 * F.col("_all"))).otherwise(F.lit(0.0)) + 1
    d = d.withColumn("_base", F.greatest(F.lit(0), F.floor(share - slack)).cast("long")).withColumn("_top", F.ceil(share + slack).cast("long"))
    d = d.withColumn("_open", F.col(seats) - F.sum("_base").over(w))
    d = d.withColumn("_price", F.when(F.col("_all") > 0, 2 * F.col(seats) / F.col("_all")).otherwise(F.lit(0.0)))
    listed = d.filter(F.col(votes) > 0).select(*dict.fromkeys([*group, *name]), votes, "_open", "_price", F.explode(F.expr("sequence(_base, _top)")).alias("_k"))
    # Quotients are counted by their height over the seats' average price, so that only those as high as the last winner's need an order.
    listed = listed.withColumn("_q", F.col(votes) / (2 * F.col("_k") + 1)).withColumn("_height", F.floor(F.col("_q") * F.col("_price") * HEIGHTS))
    per = listed.groupBy(*group, "_height").agg(F.count(F.lit(1)).alias("_n"), F.first("_open").alias("_open"))
    above = F.coalesce(F.sum("_n").over(Window.partitionBy(*group).orderBy(F.col("_height").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.withColumn("_left", F.col("_open") - above).filter("_left > 0").select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_height").alias("_h"), "_left", "_n")
    met = listed.join(per, [*[F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group], F.col("_height") == F.col("_h")])
    best = Window.partitionBy(*group).orderBy(F.col("_q").desc(), *[F.col(c).isNull() for c in name], *[F.col(c) for c in name], "_k")
    keys = list(dict.fromkeys([*group, *name]))
    last = met.filter("_n > _left").withColumn("_rank", F.row_number().over(best)).filter("_rank <= _left").select(*keys)
    won = met.filter("_n <= _left").select(*keys).unionByName(last).groupBy(*keys).agg(F.count(F.lit(1)).alias("_more"))
    met = d.alias("p").join(won.select(*[F.col(c).alias(f"_w_{c}") for c in keys], "_more"), [F.col(f"p.{c}").eqNullSafe(F.col(f"_w_{c}")) for c in keys], "left")
    return met.withColumn("won", F.col("_base") + F.coalesce("_more", F.lit(0))).select(*[F.col(f"p.{c}") for c in parties.columns], "won")


class Plan:
    """Seats, quotas and where each shard's run of blocks begins, for one table and one seed. Its tables of sources and shards outlive ``scratch``."""

    def __init__(self, scratch: Scratch, docs: DataFrame, weights: tuple[float, ...], share: tuple[int, int], most: int, block_words: int, shard_rows: int, seed: int, columns: tuple[str, str, str]):
        self.columns, self.seed = columns, seed
        self.rows = d = scratch.save(self._sized(docs), "rows")
        sources = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
        sources = scratch.save(sources, "sizes").coalesce(1)  # a row a source: what follows orders them all
        targets = source_targets(sources.select("source", "source_size"), weights, share, most)
        targets = targets.withColumn("_seats", F.round(F.sum("target").over(Window.partitionBy())).cast("long"))
        quotas = sainte_lague(targets.withColumn("_one", F.lit(0)), ["_one"], "target", "_seats", ["source"])
        quotas = quotas.select(F.col("source").alias("q_source"), "target", F.col("won").alias("_seats"))
        sources = sources.join(quotas, F.col("source").eqNullSafe(F.col("q_source"))).drop("q_source").withColumn("_shards", F.ceil(F.col("_rows") / shard_rows).cast("long"))
        block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.expr(f"source_size div {LEAST_BLOCKS}"))).cast("long")
        sources = sources.withColumn("_block", block).withColumn("_seats", F.round(F.col("_seats") / F.col("_block")).cast("long"))
        self.sources = scratch.result(sources.drop("_rows"), "sources")

        shards = self._in_shards(d).groupBy("source", "_shard").agg(F.sum("size").alias("_words"), F.first("_seats").alias("_seats"), F.first("_block").alias("_block"))
        shards = shards.withColumn("_blocks", F.when(F.col("_words") > 0, F.greatest(F.lit(1), F.round(F.col("_words") / F.col("_block")))).otherwise(F.lit(0)).cast("long"))
        room = F.sum("_blocks").over(Window.partitionBy("source")) * most
        shards = sainte_lague(shards.withColumn("_seats", F.least(F.col("_seats"), room)), ["source"], "_blocks", "_seats", ["_shard"])
        shards = shards.withColumn("_at", F.when(F.col("_blocks") > 0, _seeded("source", "_shard", seed=seed + 1) % F.col("_blocks")).otherwise(F.lit(0)))
        shards = shards.select(F.col("source").alias("h_source"), F.col("_shard").alias("h_shard"), "_words", "_blocks", "_at", F.least(F.col("won"), F.col("_blocks") * most).alias("_quota"))
        self.shards = scratch.result(shards, "shards")

    def _sized(self, docs: DataFrame, *more: Column) -> DataFrame:
        i, text, source = self.columns
        d = docs.select(F.col(i).alias("doc_id"), word_count(F.col(text)).alias("size"), F.col(source).alias("source"), F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_md5"), *more)
        return d.withColumn("_hash", _seeded("doc_id", "_md5", seed=self.seed)).drop("_md5")  # so that rows without an id, or with the same one, part

    def _in_shards(self, d: DataFrame) -> DataFrame:
        s = self.sources.withColumnRenamed("source", "s_source")
        return d.join(s, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source").withColumn("_shard", F.col("_hash") % F.col("_shards"))

    def apply(self, d: DataFrame) -> DataFrame:
        d = self._in_shards(d).join(self.shards, F.col("source").eqNullSafe(F.col("h_source")) & (F.col("_shard") == F.col("h_shard"))).drop("h_source", "h_shard")
        stream = Window.partitionBy("source", "_shard").orderBy("_hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        d = d.withColumn("_to", F.sum("size").over(stream)).withColumn("_from", F.col("_to") - F.col("size"))
        d = d.withColumn("copies", F.expr("CASE WHEN _blocks > 0 THEN _quota div _blocks ELSE 0 END")).withColumn("_rest", F.expr("CASE WHEN _blocks > 0 THEN _quota % _blocks ELSE 0 END"))
        # The run [_at, _at + _rest) of blocks, as one or two ranges of words: what passes the end goes on at the start.
        edge = lambda block: f"(({block}) * _words div _blocks)"
        ranges = f"""CASE WHEN _rest = 0 THEN cast(array() AS array<struct<a: bigint, b: bigint>>)
            WHEN _at + _rest <= _blocks THEN array(struct({edge("_at")} AS a, {edge("_at + _rest")} AS b))
            ELSE array(struct({edge("_at")} AS a, _words AS b), struct(0L AS a, {edge("_at + _rest - _blocks")} AS b)) END"""
        d = d.withColumn("_ranges", F.expr(ranges))
        d = d.withColumn("runs", F.expr("filter(transform(_ranges, r -> struct(greatest(r.a, _from) - _from AS a, least(r.b, _to) - _from AS b)), r -> r.b > r.a)"))
        return d.withColumn("taken", F.expr("copies * size + aggregate(runs, 0L, (s, r) -> s + r.b - r.a)"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: tuple[int, int] = (3, 2),
    most: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_rows: int = SHARD_ROWS,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """What a mix takes of every row: doc_id, size, source_size, target, taken, ``copies`` (whole copies taken), ``runs`` (up to two [a, b) ranges of words taken once more).

    A row per input row. Texts of null or without a word have size 0 and give nothing. A null source is a
    source like the others, and last. Rows that repeat one another are separate supplies (their order in
    the shard is then open, but equal rows of equal size trade places without a change of the sizes
    taken). An empty table gives no rows. Columns other than the named ones are not read.
    """
    with Scratch(docs.sparkSession, "mix") as scratch:
        plan = Plan(scratch, docs, weights, share, most, block_words, shard_rows, seed, (id_col, text_col, source_col))
        return scratch.result(plan.apply(plan.rows).select("doc_id", "size", "source_size", "target", "taken", "copies", "runs"))


def take(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: tuple[int, int] = (3, 2), most: int = 2, block_words: int = BLOCK_WORDS, shard_rows: int = SHARD_ROWS, seed: int = 42) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole copy, and for a text that a run cuts one row of the words it takes (white space between them as it was; n_chars counted anew).

    Rows without words are taken by none. Nulls, repeated rows and an empty table are as in ``mix``; columns of any names stay.
    """
    with Scratch(docs.sparkSession, "mix") as scratch:
        plan = Plan(scratch, docs, weights, share, most, block_words, shard_rows, seed, ("doc_id", "text", "source"))
    d = plan.apply(plan._sized(docs, F.struct(*docs.columns).alias("row")))
    pieces = F.regexp_extract_all("row.text", F.lit(WORD + WORD[0] + WORD[2:-1] + "*"), F.lit(0))
    words = F.aggregate("runs", F.lit(""), lambda s, r: F.concat(s, F.array_join(F.slice(F.col("_pieces"), r.a.cast("int") + 1, (r.b - r.a).cast("int")), "")))
    whole = F.expr("size(runs) > 0 AND aggregate(runs, 0L, (s, r) -> s + r.b - r.a) = size")
    d = d.withColumn("_cut", F.expr("size(runs) > 0") & ~whole).withColumn("_pieces", F.when(F.col("_cut"), pieces))
    d = d.withColumn("_n", F.col("copies") + F.when(F.expr("size(runs) > 0"), 1).otherwise(0)).filter("_n > 0")
    d = d.withColumn("_last", F.when(F.col("_cut"), words).otherwise(F.col("row.text")))
    d = d.select("row", "_last", "copies", F.explode(F.expr("sequence(1L, _n)")).alias("_k"))
    text = F.when(F.col("_k") > F.col("copies"), F.col("_last")).otherwise(F.col("row.text"))
    columns = [text.alias(c) if c == "text" else F.length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return d.select(*columns)
