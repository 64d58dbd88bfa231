"""Predicates on raw JSON text, held as VARIANT.

Types are read from the variant and never from a cast: casts would turn "5" into 5.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats (fixed values).
UUID_FORMAT = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
DATETIME_FORMAT = (
    r"^\d{4}-\d{2}-\d{2}T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?(Z|[+-]\d{2}:?\d{2})$"
)


def staged(frame: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that later steps refer to without computing them again.

    Catalyst would copy a projected expression into every filter and column that uses it, and so
    parse the same text several times. It does not look through a generator.
    """
    return frame.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_document(frame: DataFrame, text: str, name: str = "_doc") -> DataFrame:
    """Adds the one JSON document in `text` as VARIANT, or NULL when the text is not exactly that.

    The parser stops after the first document, so the text is parsed as the only element of an
    array: `{} x` and `1,2` then fail. Text that closes this array itself (`1] x`) is caught by a
    second parse inside an object, needed only where a `]` occurs.
    """
    value, listed = F.col(text), F.col("_listed")
    wrapped = staged(frame, _listed=F.try_parse_json(F.concat(F.lit("["), value, F.lit("]"))))
    nested = F.try_parse_json(F.concat(F.lit('{"v":'), value, F.lit("}")))
    first, second = (F.try_variant_get(listed, f"$[{i}]", "variant") for i in (0, 1))
    exact = second.isNull() & (~F.contains(value, F.lit("]")) | nested.isNotNull())
    return staged(wrapped, **{name: F.when(exact, first)}).drop("_listed")


def kind(v: Column) -> Column:
    """STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID (JSON null), OBJECT<..>, ARRAY<..>; NULL if absent."""
    return F.schema_of_variant(v)


def member(doc: Column, name: str) -> Column:
    return F.try_variant_get(doc, f"$.{name}", "variant")


def members(doc: Column, *names: str) -> Column:
    """Struct of members, read in one pass over the object."""
    fields = ", ".join(f"{n}: variant" for n in names)
    return F.try_variant_get(doc, "$", f"struct<{fields}>")


def text(v: Column) -> Column:
    """String value; NULL when absent or of another type."""
    return F.when(kind(v) == "STRING", v.cast("string"))


def text_member(doc: Column, name: str) -> Column:
    return text(member(doc, name))


def is_object(v: Column) -> Column:
    return F.coalesce(kind(v).startswith("OBJECT"), F.lit(False))


def is_true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def utf16_length(s: Column) -> Column:
    return F.octet_length(F.encode(s, "UTF-16BE")) / 2


def length_between(s: Column, low: int, high: int) -> Column:
    """Length in UTF-16 units; the exact count is needed only in the upper half of the range."""
    n = F.char_length(s)
    return is_true((n >= low) & ((n <= high // 2) | ((n <= high) & (utf16_length(s) <= high))))


def instant_text(s: Column) -> Column:
    """Timestamp of an ISO text with offset; NULL when the format or the calendar date is wrong."""
    return F.when(s.rlike(DATETIME_FORMAT), F.coalesce(F.try_to_timestamp(s), _far_offset(s)))


def _far_offset(s: Column) -> Column:
    """Offsets from 18 to 23 hours, which the parser refuses: the local time less the offset."""
    offset = F.regexp_extract(s, r"[+-](1[89]|2[0-3]):?[0-5]\d$", 0)
    local = F.try_to_timestamp(F.concat(F.regexp_replace(s, r"[+-]\d{2}:?\d{2}$", ""), F.lit("Z")))
    minutes = F.substring(offset, 2, 2).cast("bigint") * 60 + F.right(offset, F.lit(2)).cast("bigint")
    ahead = F.when(F.startswith(offset, F.lit("+")), minutes).otherwise(-minutes)
    return F.when(offset != "", F.timestamp_micros(F.unix_micros(local) - ahead * 60_000_000))


def variants(v: Column) -> Column:
    return v.try_cast("map<string,variant>")


def numbers(v: Column) -> Column:
    return v.try_cast("map<string,double>")


def strings(v: Column) -> Column:
    return v.try_cast("map<string,string>")


def numbers_valid(members: Column, values: Column, max_key: int = 64) -> Column:
    """Whether an object's members are finite numbers under bounded keys (JSON numbers have three kinds)."""
    return is_true(
        F.forall(F.map_values(members), lambda x: kind(x).substr(1, 2).isin("BI", "DE", "DO"))
        & F.forall(F.map_values(values), lambda x: F.abs(x) < float("inf"))
        & F.forall(F.map_keys(members), lambda k: length_between(k, 1, max_key))
    )


def strings_valid(members: Column) -> Column:
    return is_true(F.forall(F.map_values(members), lambda x: kind(x) == "STRING"))


def numbers_map(v: Column) -> Column:
    """map<string,double> when `v` is an object of finite numbers under bounded keys, else NULL."""
    return F.when(is_object(v) & numbers_valid(variants(v), numbers(v)), numbers(v))


def strings_map(v: Column) -> Column:
    """map<string,string> when `v` is an object of strings, else NULL."""
    return F.when(is_object(v) & strings_valid(variants(v)), strings(v))
