"""What each stage sends for a paper: JSON in a fixed spelling, pruned to the stage's fields, whose lengths drive the batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import bound, trim_space, truncate
from inkwell.operators.batching import pack_ranges
from inkwell.session import saved

#: Short spellings of control characters; the others are written as \u and four digits in lower case.
SHORT = {0x08: "b", 0x09: "t", 0x0A: "n", 0x0C: "f", 0x0D: "r"}
#: Fields of a stage's item in order, after the id and the title; a field with ``?`` is left out where it is null.
FIELDS = {
    "gate": ["abstract"],
    "routing": ["journal", "source_id"],
    "spatial": ["journal", "abstract?"],
    "tagging": ["journal", "source_id", "scope", "abstract?"],
    "translate": ["journal"],
    "summarize": ["journal", "source_id", "scope", "digest_line", "abstract?"],
}


def json_string(x: Column) -> Column:
    """A string as JSON spells it: quotation marks, backslashes and control characters escaped and nothing else. Control characters without a short spelling are rare, and looked for only where one has been met."""

    def escaped(t: Column) -> Column:
        for char, short in (("\\", "\\\\"), ('"', '\\"'), *((chr(c), "\\" + SHORT.get(c, f"u{c:04x}")) for c in range(32))):
            t = F.replace(t, F.lit(char), F.lit(short))
        return F.concat(F.lit('"'), t, F.lit('"'))

    plain = lambda j: F.substring(j, F.lit(2), F.length(j) - 2)  # noqa: E731  without the array's brackets
    spelled = lambda t: bound(F.to_json(F.array(t)), lambda j: F.when(j.contains("\\u00"), escaped(t)).when(t.isNotNull(), plain(j)))
    return bound(x, spelled)


def _fields(columns: list[str]) -> dict[str, Column]:
    """Every field's value from a paper's columns; what a table lacks is null."""
    of = lambda c: F.col(c) if c in columns else F.lit(None).cast("string")
    return {
        "id": of("id").cast("string"), "title": of("title"), "journal": of("journal"), "source_id": of("source"), "scope": F.coalesce(of("scope"), F.lit("life-science-only")),
        "digest_line": F.coalesce(of("line"), F.lit("line-b")), "abstract": of("abstract"),
    }


def _values(stage: str, columns: list[str]) -> dict[str, Column]:
    """A stage's fields in order, by their names in ``FIELDS``; a required one that is null is an empty string."""
    value = _fields(columns)
    if stage != "gate":
        value["abstract"] = bound(trim_space(value["abstract"]), lambda t: truncate(t))
    return {name: value[name.removesuffix("?")] if name.endswith("?") else F.coalesce(value[name], F.lit("")) for name in ["id", "title", *FIELDS[stage]]}


def _pieces(stage: str, columns: list[str]) -> dict[tuple[str, bool], Column]:
    """A stage's fields in order, spelled with their keys; by name, and whether that is the whole abstract."""
    return {(name, stage == "gate" and name == "abstract"): F.concat(F.lit(f'"{name.removesuffix("?")}":'), json_string(v)) for name, v in _values(stage, columns).items()}


def _item(pieces: Iterable[Column | str]) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *pieces), F.lit("}"))


def payload(stage: str, columns: list[str]) -> Column:
    """The item of a paper with these columns. The gate gets the abstract as it is, other stages trimmed and cut to 2,000 characters; a required field that is null is an empty string. An item is spelled at once, and field by field only where a control character without a short spelling has been met."""
    item = F.struct(*[v.alias(name.removesuffix("?")) for name, v in _values(stage, columns).items()])
    return bound(F.to_json(item, {"ignoreNullFields": "true"}), lambda j: F.when(j.contains("\\u00"), _item(_pieces(stage, columns).values())).otherwise(j))


def with_payload(papers: DataFrame, stage: str) -> DataFrame:
    """``papers`` with ``payload`` and ``payload_chars``."""
    d = papers.withColumn("payload", payload(stage, papers.columns))
    return d.withColumn("payload_chars", F.length("payload").cast("long"))


def with_payloads(papers: DataFrame, stages: list[str], columns: list[str]) -> DataFrame:
    """A row a paper and stage: ``columns``, ``stage``, ``payload``, ``payload_chars``. Papers are read once, and each field is spelled once for all stages."""
    of = {s: _pieces(s, papers.columns) for s in stages}
    own = {k: (f"_f{i}", c) for i, (k, c) in enumerate({k: c for p in of.values() for k, c in p.items()}.items())}
    d = papers.select(*columns, *[c.alias(name) for name, c in own.values()])
    items = F.array(*[F.struct(F.lit(s).alias("stage"), _item([own[k][0] for k in p]).alias("payload")) for s, p in of.items()])
    d = d.select(*columns, F.explode(items).alias("_e")).select(*columns, "_e.*")
    return d.withColumn("payload_chars", F.length("payload").cast("long"))


def request(stage: str, items: Column) -> Column:
    """The body of a request over items in order; a summary is asked for one paper."""
    return F.concat(F.lit('{"paper":'), F.get(items, F.lit(0)), F.lit("}")) if stage == "summarize" else F.concat(F.lit('{"papers":['), F.array_join(items, ","), F.lit("]}"))


def planned(papers: DataFrame, stage: str, group: str, order: list[str], limits: tuple[int, int, int | None], path: str, prompt: str = "", pack: Callable[..., DataFrame] = pack_ranges, whole: bool = True) -> DataFrame:
    """``group, order, id, payload, payload_chars, batch``: batches by the exact lengths of what is sent. ``limits``: items, input tokens, completion tokens.

    Without ``whole`` the lengths alone are laid out and packed, and there is no ``payload``. Either way they stand written first, as ranges are found by a pass of their own, which would spell every paper once more.
    """
    own = [group, *order, "id", *(["payload"] if whole else []), "payload_chars"]
    d = saved(with_payload(papers, stage).select(*dict.fromkeys(own)), f"{path}/payloads")
    return pack(d, group, order, "payload_chars", stage, *limits, path, len(prompt))
