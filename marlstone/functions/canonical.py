"""Canonical JSON of objects, and keys on it: equal for objects that differ in the order of fields, blanks and escapes only.

A VARIANT keeps an object's fields in the order of their names, so writing a
parsed text again sorts it at every depth.  Numbers count by value (1.0 is 1).
Text that is no JSON, or repeats a name within an object, has no canonical form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import normal_space

#: A string of a canonical JSON text, a field's name with its colon, or what lies between them.  The possessive
#: repeat keeps no state for each character, so a long string needs no deep stack.
PIECE = r'"(?:[^"\\]|\\.)*+":?|[^"]+'


def canonical(json: Column) -> Column:
    """The text with sorted fields and no blanks; null if it is no JSON."""
    return F.to_json(F.try_parse_json(json))


def structured_key(json: Column) -> Column:
    """canonical() of an object; null for anything else."""
    out = canonical(json)
    return F.when(F.startswith(out, F.lit("{")), out)


def _string(quoted: Column) -> Column:
    """The value of a JSON string, and back."""
    return F.element_at(F.from_json(F.concat(F.lit("["), quoted, F.lit("]")), "array<string>"), 1)


def _quoted(value: Column) -> Column:
    # Only the array's own brackets stand outside the quotes.
    return F.btrim(F.to_json(F.array(value)), F.lit("[]"))


def normal_values(json: Column, normal=normal_space) -> Column:
    """canonical() with every string value, at any depth, in the form normal(column); names of fields stay."""
    pieces = F.regexp_extract_all(canonical(json), F.lit(PIECE), 0)
    # In canonical text a name is a string right before a colon; each piece tells by itself which it is.
    is_value = lambda x: F.startswith(x, F.lit('"')) & F.endswith(x, F.lit('"'))
    return F.array_join(F.transform(pieces, lambda x: F.when(is_value(x), _quoted(normal(_string(x)))).otherwise(x)), "")


def row_key(json: Column, normal=normal_space) -> Column:
    """SHA-256 of normal_values(): rows that differ in case, blanks and the order of fields only have the same."""
    return F.sha2(normal_values(json, normal).cast("binary"), 256)


def reader_view(turns: Column) -> Column:
    """Turns (array of struct with role and text) as canonical JSON, with the fields' names in order."""
    return F.to_json(F.transform(turns, lambda t: F.struct(F.coalesce(t["text"], F.lit("")).alias("content"), t["role"].alias("role"))))
