"""JSON payloads as variants: members, truth and text of single values, and arrays element by element.

An element that isn't what it should be is judged by itself; its neighbours stay.  Truth is that of a dynamic language:
null, false, 0, empty text, empty arrays and empty objects are false, anything else (``"0"`` too) is true.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatlake.functions.scalars import json_true


def member(v: Column, *path: str) -> Column:
    """The value at a path of names; null where something on the way is no object."""
    return F.try_variant_get(v, ".".join(["$", *path]), "variant")


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def true(v: Column, *path: str) -> Column:
    return json_true(v, ".".join(["$", *path]))


def text(v: Column, *path: str) -> Column:
    """The value as text: strings as they are, numbers and truth values as JSON shows them; null for null."""
    return F.try_variant_get(v, ".".join(["$", *path]), "string")


def number(v: Column, *path: str) -> Column:
    """The value as a whole number, of digits in a string too; null for anything else."""
    return F.try_variant_get(v, ".".join(["$", *path]), "bigint")


def elements(v: Column, *path: str) -> Column:
    """The elements of an array; null where there is none."""
    return F.try_variant_get(v, ".".join(["$", *path]), "array<variant>")


def first_true(*values: Column) -> Column:
    """The first of some variants that is true, else the last, as text."""
    out = text(values[-1])
    for v in reversed(values[:-1]):
        out = F.when(true(v), text(v)).otherwise(out)
    return out


# A number with a fraction or an exponent, beside the strings in which one may stand too.
_FLOAT = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|(-?[0-9]+(?:\.[0-9]+(?:[eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+))'


def sorted_json(raw: Column) -> Column:
    """Compact JSON of a JSON text with the names of each object in order; ``3.0`` stays ``3.0``.

    A variant shows whole floats as integers, so they pass through it as marked strings.
    """
    marked = F.regexp_replace(F.regexp_replace(raw, _FLOAT, "$1\u0001$2\u0002"), "\u0001\u0002", "")
    quoted = F.regexp_replace(marked, "\u0001([^\u0002]*)\u0002", '"\\\\u0001$1\\\\u0002"')
    return F.regexp_replace(F.to_json(F.try_parse_json(quoted)), r'"\\u0001([^"\\]*)\\u0002"', "$1")
