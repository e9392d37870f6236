"""Structural templates: what stays of a text or a row when names, slots, quotes and numbers are taken out of it."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

#: Fields of a row that are no part of its template, and patterns in the order in which they apply (fixed values).
LEFT_OUT = ("type", "answer", "correct_index", "verification_answer", "verification_expression")
ENTITY = r"(?U)\b(?:[A-Z][a-z]+)(?:\s+[A-Z][a-z]+){1,3}\b"
QUOTED = r"([\"'`])[^\n\"'`]{1,120}\1"
NUMBER = r"(?U)(?<![\w])[-+]?\d+(?:[.,:/-]\d+)*(?![\w])"
TOKEN = r"<[a-z_]+>|[a-z]+|[-+*/<>=]+|[{}()\[\],.:;]"
CHOICE_LINE = r"(?im)^answer:\s*[a-d]\s*$"
FIELD = " <field> "


def slot_pattern(slots: tuple[str, ...]) -> str | None:
    """A pattern of the values that fill slots, of three characters or more, longest first."""
    kept = sorted({s for s in slots if len(s) >= 3}, key=lambda s: (-len(s), s))
    return rf"(?iU)(?<!\w)(?:{'|'.join(map(re.escape, kept))})(?!\w)" if kept else None


def template_text(text: Column, slots: tuple[str, ...] = (), choice: Column | None = None) -> Column:
    """The tokens of text that are no content: names of two to four words, slot values, quotes and numbers are marks.

    slots: a vocabulary of bounded size.  choice: where it is true, a line that
    tells the answer's letter is a mark too.  Texts in compatibility forms or
    beyond simple case should come as NFKC.
    """
    out = text if choice is None else F.when(choice, F.regexp_replace(text, CHOICE_LINE, "Answer: <choice>")).otherwise(text)
    rules = [(ENTITY, " <entity> "), (slot_pattern(slots), " <slot> "), (QUOTED, " <quoted> "), (NUMBER, " <num> ")]
    for pattern, mark in rules:
        if pattern:
            out = F.regexp_replace(out, pattern, mark)
    return F.array_join(F.regexp_extract_all(F.lower(out), F.lit(TOKEN), 0), " ")


def leaves(value: Column, kind: DataType) -> Column:
    """array<string> of all texts within a value, in its order; other values have none."""
    none = F.array().cast("array<string>")
    if isinstance(kind, StringType):
        out = F.array(value)
    elif isinstance(kind, ArrayType):
        out = F.flatten(F.transform(value, lambda x: leaves(x, kind.elementType)))
    elif isinstance(kind, StructType):
        parts = [leaves(value[f.name], f.dataType) for f in kind.fields]
        out = F.flatten(F.array(*parts)) if parts else none
    elif isinstance(kind, MapType):
        out = F.flatten(F.transform(F.map_values(value), lambda x: leaves(x, kind.valueType)))
    else:
        return none
    return F.array_compact(F.coalesce(out, none))


def row_template(schema: StructType, slots: tuple[str, ...] = (), left_out: tuple[str, ...] = LEFT_OUT) -> Column:
    """The templates of a row's texts, fields in the order of their names, joined by a mark; the same whatever the order of the columns."""
    texts = [leaves(F.col(f"`{f.name}`"), f.dataType) for f in sorted(schema.fields, key=lambda f: f.name) if f.name not in left_out]
    if not texts:
        return F.lit("")
    each = F.transform(F.flatten(F.array(*texts)), lambda t: template_text(t, slots))
    return F.array_join(F.filter(each, lambda t: t != ""), FIELD)
