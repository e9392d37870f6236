"""Public metadata of prompt records, and canonical totals of manifests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Template families and difficulties by signal, operators, restraint terms, total fields and units by kind of run.
TEMPLATE_FAMILY = {
    "code": "python_function_generation",
    "debugging": "python_debugging_explanation",
    "database": "sql_grouping_query",
    "cloud": "cloud_architecture_explanation",
    "data_transform": "data_transformation_plan",
    "educational_qa": "educational_explanation",
    "factual_restraint": "factual_restraint",
    "planning": "operational_planning_checklist",
    "instruction": "instruction_rewrite",
}
EASY = ("arithmetic", "educational_qa", "instruction")
EXPRESSION = r"-?\d+\s*([+\-*/x×÷])\s*-?\d+"
OPERATORS = {"+": "integer_addition", "-": "integer_subtraction", "*": "integer_multiplication", "x": "integer_multiplication", "×": "integer_multiplication", "/": "integer_division", "÷": "integer_division"}
FUTURE = ("next month", "next season", "future", "will definitely")
PRIVATE = ("private", "password", "home address", "medical diagnosis")
TOTAL_FIELD = {"pretrain": "total_records", "sft": "total_rows", "dpo": "total_pairs", "distillation-sft": "total_rows", "distillation-dpo": "total_pairs"}
UNIT = {"pretrain": "records", "sft": "rows", "dpo": "pairs", "distillation-sft": "rows", "distillation-dpo": "pairs"}


def lookup(values: dict[str, str], key: Column) -> Column:
    """The value of a key; null where there is none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def public_metadata(signal: Column, prompt: Column) -> Column:
    """struct(category, difficulty, template_family, eval_family); null for an empty prompt or an unknown signal."""
    sums = signal == "arithmetic"
    low = F.lower(prompt)
    says = lambda terms: F.rlike(low, F.lit("|".join(terms)))
    operator = F.regexp_extract(prompt, EXPRESSION, 1)
    family = F.when(sums, F.when(operator == "", "arithmetic_word_problem").otherwise(lookup(OPERATORS, operator))).otherwise(lookup(TEMPLATE_FAMILY, signal))
    direct = F.startswith(family, F.lit("integer_"))
    restraint = F.when(says(FUTURE), "future_event_restraint").when(says(PRIVATE), "private_info_restraint").otherwise("unknown_fact_restraint")
    category = F.when(sums, F.when(direct, "direct_arithmetic").otherwise("word_problem_arithmetic")).when(signal == "code", "code_generation").when(signal == "factual_restraint", restraint).otherwise("general_instruction_following")
    evaluated = F.when(sums, F.when(family == "integer_subtraction", "direct_subtraction").when(family == "integer_division", "direct_division").otherwise("basic_arithmetic_qa")).when(signal == "code", "code_generation_function")
    made = F.struct(category.alias("category"), F.when(signal.isin(*EASY), 1).otherwise(2).alias("difficulty"), family.alias("template_family"), evaluated.alias("eval_family"))
    return F.when(family.isNotNull() & (F.trim(prompt) != ""), made)


def canonical_totals(kind: Column, count: Column) -> list[Column]:
    """total_records, total_rows and total_pairs of a run: only the kind's own field is set; pretrain keeps rows as well."""
    field = lookup(TOTAL_FIELD, kind)
    also = {"total_rows": kind == "pretrain"}
    return [F.when((field == f) | also.get(f, F.lit(False)), count).alias(f) for f in ("total_records", "total_rows", "total_pairs")]


def target_mismatch(kind: Column, unit: Column, accepted: Column, count: Column) -> Column:
    """Whether a target in the kind's own unit says another count than was found; targets in other units, or without a count, say nothing."""
    return F.coalesce((lookup(UNIT, kind) == unit) & (accepted != count), F.lit(False))
