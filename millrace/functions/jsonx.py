"""Column expressions for the loosely typed ``info`` documents and the ids inside them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed form: an image id is a run of 64 hex digits, whatever stands around it.
IMAGE_ID = "(?<![0-9a-f])[0-9a-f]{64}(?![0-9a-f])"


def is_object(info: Column) -> Column:
    """True where the whole string is one valid JSON object, else False (also for null).

    The string is set inside an array beside another item: anything before or after the object, a
    second object, a cut-off string or a bare bracket changes the length or makes it invalid.
    """
    whole = F.json_array_length(F.concat(F.lit("["), info, F.lit(",0]"))) == 2
    return F.coalesce(info.rlike(r'^[ \t\r\n]*\{[ \t\r\n]*["}]') & whole, F.lit(False))


def fields(info: Column, *names: str) -> Column:
    """Struct of the named members as text; null unless ``info`` is a valid object.

    Nested values come as JSON text, JSON null and absent members as null.
    """
    schema = ", ".join(f"`{n}` string" for n in names)
    return F.when(is_object(info), F.from_json(info, schema))


def image_ids(value: Column) -> Column:
    """All image ids in a text, lower case, in order, repeats kept; null gives an empty list."""
    return F.coalesce(F.regexp_extract_all(F.lower(value), F.lit(IMAGE_ID), F.lit(0)), F.array().cast("array<string>"))


def image_id(value: Column) -> Column:
    """The image id in a value, or null where there is none."""
    return F.nullif(F.regexp_extract(F.lower(value), IMAGE_ID, 0), F.lit(""))
