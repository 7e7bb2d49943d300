"""Typed reads of a VARIANT: a field counts as text only if JSON says it is a string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decimals import java_trim


def payload_text(payload: Column) -> Column:
    """UTF-8 text of the frame; bad byte runs become U+FFFD instead of failing the job."""
    return F.make_valid_utf8(payload.cast("string"))


def parse_object(text: Column) -> Column:
    """VARIANT of a JSON object; NULL for malformed text and for any other root."""
    # The root type shows in the first character, which is cheaper than deriving a schema.
    return F.when(text.rlike(r"^[ \t\r\n]*\{"), F.try_parse_json(text))


def field(variant: Column, name: str) -> Column:
    return F.try_variant_get(variant, f"$.{name}", "variant")


def kind(value: Column) -> Column:
    """JSON type of a VARIANT: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID, ..."""
    return F.schema_of_variant(value)


def elements(variant: Column, name: str) -> Column:
    """``array<variant>``, NULL unless the field is an array."""
    return F.try_variant_get(variant, f"$.{name}", "array<variant>")


def pull(variant: Column, names: list[str]) -> Column:
    """Several fields of an object in one pass, each still a VARIANT (NULL for a non-object)."""
    return F.try_variant_get(variant, "$", "struct<" + ",".join(f"{n}:variant" for n in names) + ">")


def text_of(value: Column, k: Column | None = None) -> Column:
    """The VARIANT when it is a JSON string, else NULL; ``k`` is its kind where already known."""
    return F.when((kind(value) if k is None else k) == "STRING", F.try_variant_get(value, "$", "string"))


def any_text_of(value: Column, k: Column | None = None) -> Column:
    k = kind(value) if k is None else k
    return (
        F.when(k.isNull() | (k == "VOID"), F.lit(None).cast("string"))
        .when(k.startswith("OBJECT") | k.startswith("ARRAY"), F.lit(""))
        .otherwise(F.try_variant_get(value, "$", "string"))
    )


def text(variant: Column, name: str) -> Column:
    """The field when it is a JSON string, else NULL (numbers are not coerced)."""
    return text_of(field(variant, name))


def as_text(variant: Column, name: str) -> Column:
    """The field as text whatever scalar it is; empty for containers, NULL when absent or null."""
    return any_text_of(field(variant, name))


def is_number(k: Column) -> Column:
    return k.isin("BIGINT", "DOUBLE", "FLOAT") | k.startswith("DECIMAL")


def number(value: Column, k: Column) -> Column:
    """Text of a VARIANT number or numeric string (trimmed) whose :func:`kind` is ``k``, else NULL."""
    raw = F.try_variant_get(value, "$", "string")
    return F.when(is_number(k), raw).when(k == "STRING", java_trim(raw))
