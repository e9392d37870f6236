"""Whether a rendered question keeps the facts it was made from: bags of numbers, required texts, no answer given away."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .validators import codes

#: A whole number that is no part of a word (fixed value).
LITERAL = r"(?U)(?<![\w])-?\d+(?![\w])"


def numeric_literals(text: Column) -> Column:
    """array<string> of the whole numbers in a text, in order, repeats included."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(LITERAL), 0)


def bag(values: Column) -> Column:
    """map<string, long>: how often each value of an array stands in it."""
    return F.map_from_entries(F.transform(F.array_distinct(values), lambda v: F.struct(v, F.size(F.filter(values, lambda x: x == v)).cast("long"))))


def bag_except(a: Column, b: Column) -> Column:
    """map<string, long>: the values that a has more often than b, and how many more."""
    more = lambda v: F.size(F.filter(a, lambda x: x == v)) - F.size(F.filter(b, lambda x: x == v))
    entries = F.transform(F.array_sort(F.array_distinct(a)), lambda v: F.struct(v.alias("value"), more(v).cast("long").alias("n")))
    return F.map_from_entries(F.filter(entries, lambda e: e["n"] > 0))


def _listed(bag_: Column) -> Column:
    return F.array_join(F.transform(F.map_entries(bag_), lambda e: F.concat(e["key"], F.lit("x"), e["value"].cast("string"))), " ")


def rendering(question: Column, required: Column, texts: Column, answer: Column) -> Column:
    """struct<issues, missing, extra>: codes of what a rendering got wrong, and the numbers it lost and added (value x times).

    required: the numbers that the question must have, as often as they stand
    there; texts: texts it must hold, whatever their case.  A number that is
    required once and written twice is `repeated_numeric_fact`.
    """
    asked = F.trim(F.coalesce(question, F.lit("")))
    want = F.coalesce(required, F.array().cast("array<string>"))
    seen = numeric_literals(asked)
    lost, added = bag_except(want, seen), bag_except(seen, want)
    dropped = F.filter(F.coalesce(texts, F.array().cast("array<string>")), lambda t: ~F.contains(F.lower(asked), F.lower(t)))
    again = F.exists(F.map_keys(added), lambda v: F.array_contains(want, v))
    new = F.exists(F.map_keys(added), lambda v: ~F.array_contains(want, v))
    leak = F.array_contains(seen, answer) & ~F.array_contains(want, answer)
    rules = [
        (asked == "", "empty_question"),
        (F.size(lost) > 0, "missing_numeric_fact"),
        (new, "extra_numeric_fact"),
        (again, "repeated_numeric_fact"),
        (F.size(dropped) > 0, "dropped_semantic_context"),
        (leak, "leaks_answer"),
    ]
    return F.struct(codes(*[(F.coalesce(hit, F.lit(False)), code) for hit, code in rules]).alias("issues"), _listed(lost).alias("missing"), _listed(added).alias("extra"))
