"""Validators: arrays of issue codes, empty for a valid row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import jaccard, normal_space, tokens, word_count

#: Markers (fixed values).
PLACEHOLDERS = ("lorem ipsum", "todo", "tbd", "[insert", "<placeholder>")
REFUSALS = ("i cannot", "i can't", "i am unable", "as an ai")
LEAKS = ('"prompt":', '"response":', '"metadata":')


def codes(*rules: tuple[Column, str]) -> Column:
    """The codes of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(hit, F.lit(code)) for hit, code in rules]))


def plain_codes(*rules: tuple[Column, str]) -> Column:
    """codes() without a lambda, under which every rule would be interpreted; for rules on columns that hold the costly parts."""
    none = F.array().cast("array<string>")
    return F.flatten(F.array(*[F.when(hit, F.array(F.lit(code))).otherwise(none) for hit, code in rules]))


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for w in words:
        out = out | F.contains(low, F.lit(w))
    return out


def role_sequence(roles: Column) -> Column:
    """roles: array of a conversation's roles in order."""
    n = F.size(roles)
    pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: (F.element_at(roles, i) == F.element_at(roles, i + 1)) & (F.element_at(roles, i) != "system"))
    first = F.element_at(F.filter(roles, lambda r: r != "system"), 1)
    return codes(
        (n == 0, "empty_messages"),
        (F.exists(F.slice(roles, F.lit(2), F.greatest(n, F.lit(1))), lambda r: r == "system"), "misplaced_system"),
        ((n > 1) & F.exists(F.when(n > 1, pairs).otherwise(F.array(F.lit(False))), lambda x: x), "repeated_role"),
        (first == "assistant", "leading_assistant"),
        ((n > 0) & (F.element_at(roles, F.when(n > 0, -1).otherwise(None)) != "assistant"), "final_role_not_assistant"),
    )


def response_quality(prompt: Column, response: Column) -> Column:
    text = F.trim(F.coalesce(response, F.lit("")))
    return codes(
        (text == "", "empty_response"),
        ((text != "") & (word_count(text) < 3), "too_short"),
        ((text != "") & (normal_space(text) == normal_space(prompt)), "repeats_prompt"),
        (contains_any(text, LEAKS), "schema_leakage"),
        (contains_any(text, REFUSALS), "unexpected_refusal"),
    )


def pair_quality(prompt: Column, chosen: Column, rejected: Column) -> Column:
    a, b = F.array_distinct(tokens(chosen)), F.array_distinct(tokens(rejected))
    la, lb = F.length(chosen), F.length(rejected)
    close = (jaccard(a, b) >= 0.92) & (F.abs(la - lb) <= 0.08 * F.greatest(la, lb)) & (F.size(F.array_union(a, b)) >= 6)
    return codes(
        (word_count(chosen) < 3, "chosen_too_short"),
        (word_count(rejected) < 3, "rejected_too_short"),
        (normal_space(chosen) == normal_space(rejected), "identical_pair"),
        ((normal_space(chosen) != normal_space(rejected)) & close, "non_contrastive"),
        (normal_space(chosen) == normal_space(prompt), "chosen_copies_prompt"),
        (contains_any(chosen, LEAKS), "chosen_schema_leakage"),
    )


def output_constraints(text: Column, min_words: int, max_words: int, required: tuple[str, ...] = (), forbidden: tuple[str, ...] = (), exact_lines: int | None = None) -> dict[str, Column]:
    """A boolean for each constraint."""
    low, n = F.lower(text), word_count(text)
    out = {"min_words": n >= min_words, "max_words": n <= max_words}
    out |= {f"requires_{w}": F.contains(low, F.lit(w)) for w in required}
    out |= {f"forbids_{w}": ~F.contains(low, F.lit(w)) for w in forbidden}
    if exact_lines is not None:
        out["exact_lines"] = F.size(F.filter(F.split(text, "\n"), lambda line: F.trim(line) != "")) == exact_lines
    return out


def negative_pattern(chosen: Column, rejected: Column) -> Column:
    """The first pattern that tells how the rejected text fails."""
    a, b = normal_space(chosen), normal_space(rejected)
    digits = lambda t: F.array_join(F.regexp_extract_all(t, F.lit("[0-9]+"), 0), ",")
    return (
        F.when(b == "", "empty")
        .when(a == b, "identical")
        .when(F.contains(b, a), "chosen_contained")
        .when(F.contains(a, b), "truncation")
        .when(contains_any(F.substring(b, 1, 40), REFUSALS), "refusal")
        .when(digits(a) != digits(b), "numeric_substitution")
        .when(F.length(b) < F.length(a) / 2, "much_shorter")
        .when(F.length(b) > F.length(a) * 2, "much_longer")
        .otherwise("rewrite")
    )


def record_issues(text: Column) -> Column:
    return codes(
        (F.coalesce(F.trim(text), F.lit("")) == "", "empty_text"),
        (contains_any(text, PLACEHOLDERS), "generated_placeholder_text"),
        (word_count(text) < 5, "too_short"),
        (F.regexp_count(text, F.lit("[!]{2,}")) > 5, "shouting"),
        (F.contains(text, F.lit("%%%")), "symbol_noise"),
    )
