"""Strict JSON decoding.

``from_json`` reads the fields, but it also turns numbers into strings and ignores
what follows the document. So a text must be shown to be strict. Nearly all are in
the form the encoder writes, which one regular expression recognises. Only other
texts are parsed as the single element of an array: trailing bytes, a second document
or a truncated one then make the array invalid or longer than one, and the types of
the fields are read off the parsed variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WANTED = {T.StringType(): "STRING", T.LongType(): "BIGINT"}
_SPACE = " \t\r\n"


def _at(only: bool) -> str:
    return "$[0]" if only else "$"


def encoder_form(text: Column, schema: T.StructType) -> Column:
    """True for a document as the encoder writes it: every field, in order, no escapes."""
    values = {"STRING": r'"[^"\\\x00-\x1f]*+"', "BIGINT": r"(?:0|-?[1-9][0-9]{0,17})"}
    fields = ",".join(f'"{f.name}":{values[_WANTED[f.dataType]]}' for f in schema)
    return F.coalesce(text.rlike(r"\A\{" + fields + r"\}\z"), F.lit(False))


def parse(text: Column, only: bool = True) -> Column:
    """The text as a variant: a one-element array with ``only``, else its first document.

    The second form reads like a request decoder, which ignores the bytes after it.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")) if only else text)


def value_of(doc: Column, field: T.StructField) -> Column:
    """Missing and null fields read as '' or 0."""
    empty = F.lit(0) if isinstance(field.dataType, T.LongType) else F.lit("")
    return F.coalesce(doc[field.name], empty.cast(field.dataType))


def text_fields(schema: T.StructType) -> Column:
    """The names of the schema's string fields, as an array."""
    return F.array(*[F.lit(f.name) for f in schema if isinstance(f.dataType, T.StringType)])


def has_wrong_type(parsed: Column, texts: Column, only: bool = True) -> Column:
    """True when a field is present, not null, and of another JSON type.

    ``texts`` names the string fields; ``timestamp`` is an integer. One lambda serves
    all fields: written out per field, the generated code gets too long to run fast.
    """
    fields = F.try_variant_get(parsed, _at(only), "map<string,variant>")

    def is_one(name: Column, kind: str) -> Column:
        found = F.schema_of_variant(F.try_element_at(fields, name))
        return F.coalesce(found, F.lit("VOID")).isin("VOID", kind)

    return ~(F.forall(texts, lambda name: is_one(name, "STRING")) & is_one(F.lit("timestamp"), "BIGINT"))


def is_no_object(text: Column, parsed: Column, only: bool = True) -> Column:
    """True unless the text is one JSON object, or null (which reads as an empty one)."""
    body = F.btrim(text, F.lit(_SPACE))
    null = body == "null" if only else F.startswith(body, F.lit("null"))
    bad = parsed.isNull() | ~(F.startswith(body, F.lit("{")) | null)
    if only:
        bad = bad | F.try_variant_get(parsed, "$[1]", "variant").isNotNull()
    return F.coalesce(bad, F.lit(True))


def unpack(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns computed from ``_``-prefixed helper columns, and drop those.

    The row passes through a one-element ``inline``: later filters on the new
    columns then stay above it, rather than being rewritten into repeated parses.
    """
    keep = [name for name in rows.columns if not name.startswith("_")]
    values = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.select(*keep, F.inline(F.array(values)))
