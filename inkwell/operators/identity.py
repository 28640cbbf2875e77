"""Order-aware duplicates and keyed matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.text import squeeze
from inkwell.session import saved


def _winners(named: DataFrame, keys: list[Column], last: bool) -> DataFrame:
    """``_k0, _k1, _best`` of each key of ``named`` (with ``_k0, _k1``, two hashes of the key, and ``_o``, the order).

    Keys can be whole texts, so hashes group them first, with a number to keep. A hash that one row alone has names its key; rows that
    share one are grouped once more by the keys themselves, so no two keys are ever taken for one another.
    """
    best = (F.max if last else F.min)("_o").alias("_best")
    groups = saved(named.groupBy("_k0", "_k1").agg(F.count(F.lit(1)).alias("_n"), best))
    shared = named.select("_k0", "_k1", "_o", *[k.alias(f"_key{i}") for i, k in enumerate(keys)])
    shared = shared.join(groups.filter("_n > 1").select("_k0", "_k1"), ["_k0", "_k1"], "left_semi")
    exact = shared.groupBy("_k0", "_k1", *[f"_key{i}" for i in range(len(keys))]).agg(best)
    return groups.filter("_n = 1").select("_k0", "_k1", "_best").unionByName(exact.select("_k0", "_k1", "_best"))


def _pick(df: DataFrame, keys: list[str | Column], order: str | Column, columns: list[str] | None, last: bool) -> DataFrame:
    """One row a key: the key's first or last order is found from narrow rows, and the rows that bear it are taken."""
    own = [F.col(k) if isinstance(k, str) else k for k in keys]
    parts = [x for k in own for x in (k, k.isNull())]
    named = df.withColumns({"_k0": F.xxhash64(*parts), "_k1": F.xxhash64(F.lit(1), *parts), "_o": F.col(order) if isinstance(order, str) else order})
    rows = named.select("_k0", "_k1", "_o", F.struct(*[F.col(c) for c in columns or df.columns]).alias("_row"))
    won = _winners(named, own, last).withColumnsRenamed({"_k0": "_w0", "_k1": "_w1"})
    met = (F.col("_k0") == F.col("_w0")) & (F.col("_k1") == F.col("_w1")) & F.col("_o").eqNullSafe(F.col("_best"))
    return rows.join(won, met, "left_semi").select("_row.*")


def first_wins(df: DataFrame, keys: list[str | Column], order: str | Column, columns: list[str] | None = None) -> DataFrame:
    """The first row of each key by ``order``, which must be unique in a key (rows that tie all stay; a key without any order keeps all its rows); of it, ``columns`` or all. A null key is a key."""
    return _pick(df, keys, order, columns, False)


def last_wins(df: DataFrame, keys: list[str | Column], order: str | Column, columns: list[str] | None = None) -> DataFrame:
    """As ``first_wins``, the last row."""
    return _pick(df, keys, order, columns, True)


def newest(df: DataFrame, key: str, columns: list[str], order: str | None = None) -> DataFrame:
    """``key`` and ``_new``, the struct of ``columns``: of rows that repeat a key the last by ``order`` as a whole, or without one the greatest as a whole. Columns of two rows are never mixed."""
    row = F.struct(*columns)
    return df.groupBy(key).agg((F.max(row) if order is None else F.max_by(row, F.struct(order, row))).alias("_new"))


def drop_repeated(df: DataFrame, key: str) -> DataFrame:
    """Fail-closed: a key seen twice loses all its rows."""
    once = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").select(key)
    return df.join(once, key, "left_semi")


def two_level(df: DataFrame, group: str, key: str | Column, order: str, keep: Column, columns: list[str] | None = None) -> DataFrame:
    """First of each key in its group, those that ``keep`` accepts, then first of each key over all; of these, ``columns`` or all."""
    named = df.withColumns({"_key": F.col(key) if isinstance(key, str) else key, "_keep": keep})
    own = list(dict.fromkeys([*(columns or df.columns), order, "_key", "_keep"]))
    once = saved(first_wins(named, [group, "_key"], order, own).filter("_keep"))  # read more than once, and no plan within a plan
    return first_wins(once, ["_key"], order, columns or df.columns)


def missing(requested: DataFrame, returned: DataFrame, key: str) -> DataFrame:
    return requested.join(returned.select(key), key, "left_anti")


def unknown(requested: DataFrame, returned: DataFrame, key: str) -> DataFrame:
    return missing(returned, requested, key)


def match_by_id_or_title(rows: DataFrame, papers: DataFrame, row_id: str, row_title: str, paper_id: str, paper_title: str) -> DataFrame:
    """``rows`` with ``matched``, the paper they belong to: by id, else by a title that one paper alone bears; unmatched rows are left out."""
    fold = lambda c: F.lower(squeeze(F.col(c)))
    by_id = rows.join(papers.select(F.col(paper_id).alias("matched")), F.col(row_id) == F.col("matched")).withColumn("matched_by", F.lit("id"))
    rest = rows.join(papers.select(F.col(paper_id).alias("_p")), F.col(row_id) == F.col("_p"), "left_anti")
    titles = papers.groupBy(fold(paper_title).alias("_title")).agg(F.count(F.lit(1)).alias("_n"), F.first(paper_id).alias("matched")).filter("_n = 1").drop("_n")
    by_title = rest.withColumn("_title", fold(row_title)).join(titles, "_title").drop("_title").withColumn("matched_by", F.lit("title"))
    return by_id.unionByName(by_title)


def overlay(papers: DataFrame, fields: DataFrame, key: str, columns: list[str], order: str | None = None) -> DataFrame:
    """New values where ``fields`` has them, the old ones elsewhere. Of rows of ``fields`` that repeat an id one counts as a whole (see ``newest``)."""
    met = papers.join(newest(fields, key, columns, order), key, "left")
    return met.select(*[F.coalesce(F.col(f"_new.{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in papers.columns])


def numbered(df: DataFrame, group: str, order: str, name: str = "n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(order)))
