"""Reading a span's metadata, a JSON object in a string.

The string is parsed once, to a variant; an empty, invalid or non-object one
has no keys. Values that can't be read as asked are null; ``strict`` raises
instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(metadata: str | Column) -> Column:
    """The metadata as a variant, null if it isn't an object."""
    column = F.col(metadata) if isinstance(metadata, str) else metadata
    return F.when(F.trim(column).startswith("{"), F.try_parse_json(column))


def text(md: str, path: str) -> Column:
    """A string as it is, another value as JSON."""
    return F.try_variant_get(md, f"$.{path}", "string")


def number(md: str, path: str, strict: bool = False) -> Column:
    """A number, a numeric string or a boolean as a double."""
    value = F.try_variant_get(md, f"$.{path}", "double")
    if not strict:
        return value
    return F.when(text(md, path).isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit(f"metadata.{path} is no number: "), text(md, path))).cast("double")).otherwise(value)


def amount(md: str, path: str) -> Column:
    """A number, 0 where there is none."""
    return F.coalesce(number(md, path), F.lit(0.0))


def flag(md: str, path: str) -> Column:
    """1.0 for true, 1 and their spellings, 0.0 for any other value, null where there is none."""
    value = text(md, path)
    return F.when(value.isNull(), F.lit(None).cast("double")).when(value.isin("true", "True", "1", "1.0"), 1.0).otherwise(0.0)


def moment(column: Column) -> Column:
    """A time written with a blank, with or without fractions of a second; null for any other text."""
    return F.when(column.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?$"), column.try_cast("timestamp"))


def moment_or_fail(column: Column) -> Column:
    """moment, but any other text that isn't null is an error."""
    value = moment(column)
    return F.when(column.isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit("no time: "), column)).cast("timestamp")).otherwise(value)


def millis(later: Column, earlier: Column) -> Column:
    """Milliseconds between two times, with fractions; negative if they are the other way round."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1000.0)


def kind(value: Column) -> Column:
    """What a variant holds: 'object', 'array', 'string', 'number', 'boolean', 'void', or null if there is none."""
    schema = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), F.lit(None))
        .when(schema.startswith("OBJECT"), "object").when(schema.startswith("ARRAY"), "array").when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean").when(schema == "VOID", "void").otherwise("number")
    )
