"""Feed records from JSON to typed columns, without Python functions on rows.

A missing key and a JSON null differ: a missing count is 0, a null count is a
bad record. Each field is therefore taken out of the record as a variant first,
which is NULL only if the key is missing, and converted after that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmart.schemas import NULL_TAG, PARSED, TAG_SEPARATOR

_COUNTS = {
    "stories": ("score", "descendants", "time"),
    "articles": ("positive_reactions_count", "public_reactions_count", "comments_count", "reading_time_minutes"),
}
_MARK = "end of record"


def parse_stories(df: DataFrame, raw: str = "value", keep: Sequence[str] = (), on_bad: str = "mark") -> DataFrame:
    """Story records to id, title, score, by, descendants, time, url and `ok`.

    `raw` is a text or variant column with one JSON record per row; unknown keys
    are dropped. With `on_bad="mark"`, bad rows stay, with `ok` false. With
    `on_bad="fail"`, a record that cannot be converted raises; a null item is
    still only marked.
    """
    return _parse(df, "stories", raw, keep, on_bad)


def parse_articles(df: DataFrame, raw: str = "value", keep: Sequence[str] = (), on_bad: str = "mark") -> DataFrame:
    """Article records to their ten fields and `ok`; the same options as `parse_stories`."""
    return _parse(df, "articles", raw, keep, on_bad)


PARSERS = {"stories": parse_stories, "articles": parse_articles}


def split_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows (without `ok`) and bad rows of a parsed frame."""
    return parsed.where("ok").drop("ok"), parsed.where("not ok")


def count_outcomes(parsed: DataFrame) -> DataFrame:
    """One row: how many records were parsed and how many failed."""
    return parsed.agg(
        F.count_if(F.col("ok")).alias("rows_fetched"),
        F.count_if(~F.col("ok")).alias("errors"),
    )


def _parse(df: DataFrame, feed: str, raw: str, keep: Sequence[str], on_bad: str) -> DataFrame:
    if on_bad not in ("mark", "fail"):
        raise ValueError(f"on_bad must be 'mark' or 'fail', not {on_bad!r}")
    fields = PARSED[feed].names
    is_text = isinstance(df.schema[raw].dataType, T.StringType)
    # JSON functions stop at the end of the first value and would take a record
    # with something behind it. As an item of an array, with a mark as the next
    # item, the record is what it should be only if the mark is found there and
    # nothing behind it.
    record = F.try_parse_json(F.concat(F.lit("["), raw, F.lit(f',"{_MARK}"]'))) if is_text else F.col(raw)
    root = "$[0]" if is_text else "$"

    # The members are taken out at once and each number is converted once, in
    # projections of their own: `inline` would convert it at every mention.
    members = ["user" if name == "author" else name for name in fields]
    layout = ", ".join(f"{name}: variant" for name in members)
    numbers = ("id", *_COUNTS[feed])
    parts = df.select(*keep, raw, record.alias("_rec")).select(
        *keep, raw, "_rec", F.try_variant_get("_rec", root, f"struct<{layout}>").alias("_members")
    ).select(*keep, raw, "_rec", *[F.col("_members")[name].alias(f"_{name}") for name in members]).select(
        *keep, raw, "_rec", *[f"_{name}" for name in members],
        *[F.try_variant_get(f"_{name}", "$", "bigint").alias(f"_{name}_number") for name in numbers],
    )

    converted = {"id": F.col("_id_number")}
    valid = [_is_object(raw, is_text), F.col("_id").isNull() | F.col("_id_number").isNotNull()]
    for name in fields:
        part = f"_{name}"
        if name in _COUNTS[feed]:
            number = F.col(f"{part}_number")
            converted[name] = F.when(F.col(part).isNull(), F.lit(0).cast("bigint")).otherwise(number)
            valid.append(F.col(part).isNull() | number.isNotNull())
        elif name == "tag_list":
            converted[name] = _tags(part)
        elif name == "author":
            converted[name] = F.nullif(F.try_variant_get("_user", "$.username", "string"), F.lit(""))
        elif name != "id":
            converted[name] = F.nullif(F.try_variant_get(part, "$", "string"), F.lit(""))
    if feed == "articles":
        valid.append(_user_readable("_user"))

    ok = valid[0]
    for condition in valid[1:]:
        ok = ok & condition
    ok = F.coalesce(ok, F.lit(False))
    if on_bad == "fail":
        item = F.try_variant_get("_rec", root, "variant")
        null_item = F.col(raw).isNull() | F.coalesce(F.is_variant_null(item), F.lit(False))
        message = F.concat(F.lit(f"{feed} record cannot be parsed: "), F.col("_text"))
        ok = F.when(ok, True).when(null_item, False).otherwise(F.raise_error(message).cast("boolean"))
    text = F.col(raw) if is_text else F.to_json(raw)
    row = F.struct(*[converted[name].alias(name) for name in fields], ok.alias("ok"))

    # `inline` keeps a later filter on `ok` above the parse. A plain projection
    # would be copied into that filter and parse every record once per field.
    return parts.withColumn("_text", text).select(
        *keep, F.col("_text").alias("raw"), F.inline(F.array(row))
    )


def _is_object(raw: str, is_text: bool) -> Column:
    """Whether the input is one JSON object and nothing else."""
    if not is_text:
        return F.schema_of_variant("_rec").startswith("OBJECT")
    has_fields = F.col("_id").isNotNull() | F.col(raw).rlike(r"^\s*\{")
    two_items = (F.try_variant_get("_rec", "$[1]", "string") == _MARK) & F.try_variant_get("_rec", "$[2]", "variant").isNull()
    return has_fields & two_items


def _tags(part: str) -> Column:
    kind = F.schema_of_variant(part)
    joined = F.array_join(F.try_variant_get(part, "$", "array<string>"), TAG_SEPARATOR, NULL_TAG)
    text = F.when(kind.startswith("ARRAY"), joined).when(kind == "STRING", F.try_variant_get(part, "$", "string"))
    return F.nullif(text, F.lit(""))


def _user_readable(part: str) -> Column:
    """Whether the user holds fields or counts as absent: null, '', 0, false or []."""
    kind = F.schema_of_variant(part)
    return (
        F.when(kind.isNull() | kind.startswith("OBJECT") | (kind == "VOID"), True)
        .when(kind == "STRING", F.try_variant_get(part, "$", "string") == "")
        .when(kind == "BOOLEAN", ~F.try_variant_get(part, "$", "boolean"))
        .when(kind.startswith("ARRAY"), F.to_json(part) == "[]")
        .otherwise(F.try_variant_get(part, "$", "double") == 0)
    )
