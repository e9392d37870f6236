"""Exact evaluation of whole-number expressions, and the contracts of records that carry one.

An expression of integers, + - * /, signs and parentheses is evaluated as one
fold over its tokens: no eval.  The state is a stack of frames, one for each
open parenthesis: the sum so far, the sign of the term in progress, that term,
the operator before its next factor and that factor's sign, all numbers as
fractions of 38 digits.  So precedence needs no second pass.  The fold is a
small helper on Arrow batches; the contracts are built-in functions.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from .text import normal_space
from .validators import plain_codes

# Python workers need no copy of the repository.
register_pickle_by_value(sys.modules[__name__])

#: Limits, patterns and markers (fixed values).
MOST_CHARACTERS = 120
WHOLE = r"^[+-]?\d+$"
STEP_MARKERS = ("cannot determine", "can't determine", "without knowing", "not enough information", "assuming", "if initially", "question implies", "correct the understanding", "ambiguous", "unclear")
MATH_MARKERS = ("provided choices", "provided options", "answer should be based on", "different interpretation", "error in the question", "error in question", "question generation", "incorrectly generated", "seems to be an error")
GENERAL_MARKERS = ("held answer", "held correct choice", "supplied answer", "provided answer", "answer key", "matching the held", "question generation", "generation process")

TOKEN = re.compile(r"\*\*|//|[0-9][0-9_]*|[^\s]", re.ASCII)
NUMBER = re.compile(r"0(?:_?0)*|[1-9](?:_?[0-9])*")
APART = re.compile(r"[0-9_]\s+[0-9_]", re.ASCII)
WIDE = "decimal(38,0)"
#: Numbers have 38 digits, quotients 32.
MOST, MOST_QUOTIENT = 10**38, 10**32


class _NoValue(ArithmeticError):
    """The expression divides by 0 or needs too many digits."""


def _wide(x: int) -> int:
    if -MOST < x < MOST:
        return x
    raise _NoValue


def _fraction(n: int, d: int) -> tuple[int, int]:
    """n / d with a positive denominator, 1 where it divides n."""
    if d == 1:
        return n, 1
    if d == 0:
        raise _NoValue
    if n % d == 0:
        q = n // d
        if d != -1 and not -MOST_QUOTIENT < q < MOST_QUOTIENT:
            raise _NoValue
        return q, 1
    return (n, d) if d > 0 else (-n, -d)


def _total(f: list) -> tuple[int, int]:
    """The value of a frame: sum and term."""
    sn, sd, add, tn, td, _, _ = f
    if sd == td == 1:
        return _wide(sn + add * tn), 1
    return _fraction(_wide(_wide(sn * td) + _wide(tn * sd) * add), _wide(sd * td))


def _factor(f: list, n: int, d: int) -> None:
    """The frame's term multiplied or divided by n / d."""
    n *= f[6]
    if f[5] == "/":
        n, d = d, n
    f[3], f[4] = _fraction(_wide(f[3] * n), _wide(f[4] * d))
    f[5], f[6] = "", 1


def _value(expression: str) -> tuple[int, int] | None:
    """evaluated() of one text."""
    text = expression.strip(" ")
    if not 0 < len(text) <= MOST_CHARACTERS or APART.search(text):
        return None
    # sum, its denominator, sign of the term, term, its denominator, operator before the next factor, that factor's sign
    stack, awaits = [[0, 1, 1, 1, 1, "*", 1]], True
    try:
        for token in TOKEN.findall(text):
            top = stack[-1]
            if awaits:
                if NUMBER.fullmatch(token):
                    _factor(top, _wide(int(token)), 1)
                    awaits = False
                elif token == "(":
                    stack.append([0, 1, 1, 1, 1, "*", 1])
                elif token == "-":
                    top[6] = -top[6]
                elif token != "+":
                    return None
            elif token == ")" and len(stack) > 1:
                stack.pop()
                _factor(stack[-1], *_total(top))
            elif token in ("*", "/"):
                top[5], awaits = token, True
            elif token in ("+", "-"):
                top[:] = [*_total(top), 1 if token == "+" else -1, 1, 1, "*", 1]
                awaits = True
            else:
                return None
        return None if awaits or len(stack) > 1 else _total(stack[0])
    except _NoValue:
        return None


@F.arrow_udf(StructType([StructField("n", DecimalType(38, 0)), StructField("d", DecimalType(38, 0))]))
def _evaluated(expressions: pa.Array) -> pa.Array:
    values = [x if x is None else _value(x) for x in expressions.to_pylist()]
    wide = pa.decimal128(38, 0)
    sides = [pa.array([v if v is None else v[i] for v in values], wide) for i in (0, 1)]
    return pa.StructArray.from_arrays(sides, ["n", "d"], mask=pa.array([v is None for v in values], pa.bool_()))


def evaluated(expression: Column) -> Column:
    """struct<n, d> of the expression's value, d > 0, and d = 1 if it is whole; null if it is no such expression, divides by 0, or needs more than 38 digits.

    Integers are decimal, without leading zeros, underscores between digits
    allowed; at most MOST_CHARACTERS characters.  Give it a column of its own
    where it is used more than once.
    """
    return _evaluated(expression)


def whole_number(text: Column) -> Column:
    """The integer that a text is, thousands commas left out; null if it is none or has more than 38 digits."""
    plain = F.regexp_replace(F.trim(text), ",", "")
    return F.when(F.regexp_like(plain, F.lit(WHOLE)), plain.try_cast(WIDE))


def _says(text: Column, markers: tuple[str, ...]) -> Column:
    return F.regexp_like(normal_space(text), F.lit("|".join(rf"\Q{m}\E" for m in markers)))


def _empty(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit(""))) == ""


def arithmetic_parts(answer: Column, expression: Column, verification_answer: Column) -> dict[str, Column]:
    """What the rules of arithmetic_record() look at more than once; as columns of a table each is computed once."""
    return {"_value": evaluated(expression), "_said": whole_number(verification_answer), "_own": whole_number(answer)}


def arithmetic_record(question: Column, steps: Column, answer: Column, expression: Column | None = None, verification_answer: Column | None = None, parts: dict[str, Column] | None = None) -> Column:
    """Issue codes of an arithmetic record; with an expression and its answer, those of the verification too.

    steps: array<string>; parts: columns that have arithmetic_parts() already.
    """
    bad_steps = steps.isNull() | (F.size(steps) == 0) | F.exists(steps, _empty)
    shape = [
        (_empty(question), "empty_question"),
        (bad_steps, "bad_steps"),
        (~bad_steps & _says(F.array_join(F.transform(steps, lambda s: F.trim(s)), " "), STEP_MARKERS), "arithmetic_meta_commentary"),
        (_empty(answer), "empty_answer"),
    ]
    if expression is None:
        return _codes(shape)
    parts = parts or arithmetic_parts(answer, expression, verification_answer)
    value, said, own = parts["_value"], parts["_said"], parts["_own"]
    whole = value["d"] == 1
    return _codes([
        *shape,
        (_empty(expression), "arithmetic_missing_verification_expression"),
        (~_empty(expression) & value.isNull(), "arithmetic_invalid_verification_expression"),
        (value.isNotNull() & ~whole, "arithmetic_non_integer_verified_answer"),
        (said.isNull(), "arithmetic_bad_verification_answer"),
        (own.isNull(), "arithmetic_bad_answer"),
        (whole & (value["n"] != said), "arithmetic_verification_answer_mismatch"),
        (own != said, "arithmetic_answer_mismatch"),
    ])


def _codes(rules: list) -> Column:
    """plain_codes() of rules that may be null, which do not hold then."""
    return plain_codes(*[(F.coalesce(hit, F.lit(False)), code) for hit, code in rules])


def _choice_rules(choices: Column) -> tuple[Column, list]:
    """Whether the choices are four texts, and the rules of what they lack."""
    given = choices.isNotNull()
    four = given & (F.size(choices) == 4)
    full = four & ~F.exists(choices, _empty)
    return full, [
        (~given, "bad_choices"),
        (given & ~four, "choices_not_four"),
        (four & ~full, "empty_choice"),
        (full & (F.size(F.array_distinct(F.transform(choices, normal_space))) != 4), "duplicate_choices"),
    ]


def _index_rules(index: Column) -> list:
    return [(index.isNull(), "bad_correct_index_type"), ((index < 0) | (index > 3), "correct_index_out_of_bounds")]


def contains_number(text: Column, number: Column) -> Column:
    """The number stands in the text (commas left out), not within a longer one."""
    plain = F.replace(text, F.lit(","), F.lit(""))
    # Fixed patterns: one made of each row's number would be compiled for each row.
    return F.array_contains(F.regexp_extract_all(plain, F.when(number < 0, F.lit(r"(?<!\d)-\d+")).otherwise(F.lit(r"\d+")), F.lit(0)), number.cast("string"))


def math_parts(choices: Column, expression: Column, verification_answer: Column) -> dict[str, Column]:
    """What the rules of math_question() look at more than once; as columns of a table each is computed once."""
    return {"_value": evaluated(expression), "_said": whole_number(verification_answer), "_numbers": F.transform(choices, whole_number)}


def math_hits(choices: Column, parts: dict[str, Column]) -> dict[str, Column]:
    """Those that need math_parts(): whether all choices are numbers, and how many of them are the verified answer."""
    numbers = parts["_numbers"]
    return {"_numeric": _choice_rules(choices)[0] & ~F.exists(numbers, lambda n: n.isNull()), "_hits": F.size(F.filter(numbers, lambda n: n == parts["_said"]))}


def math_question(question: Column, choices: Column, explanation: Column, expression: Column, verification_answer: Column, parts: dict[str, Column] | None = None) -> tuple[Column, Column]:
    """(issue codes, index) of a question of mathematics with four choices: the index is where the verified answer stands, from 0, if it stands there once.

    parts: columns that have math_parts() and math_hits() already.
    """
    if parts is None:
        parts = math_parts(choices, expression, verification_answer)
        parts |= math_hits(choices, parts)
    value, said, numbers, numeric, hits = (parts[k] for k in ("_value", "_said", "_numbers", "_numeric", "_hits"))
    full, shape = _choice_rules(choices)
    whole = value["d"] == 1
    issues = _codes([
        (_empty(question), "empty_question"),
        *shape,
        (_empty(explanation), "empty_explanation"),
        (_empty(expression), "mcq_missing_verification_expression"),
        (~_empty(expression) & value.isNull(), "mcq_invalid_verification_expression"),
        (value.isNotNull() & ~whole, "mcq_non_integer_verified_answer"),
        (said.isNull(), "mcq_bad_verification_answer"),
        (whole & (value["n"] != said), "mcq_verification_answer_mismatch"),
        (full & ~numeric, "mcq_non_integer_choice"),
        (numeric & said.isNotNull() & (hits == 0), "mcq_verified_answer_missing_from_choices"),
        (numeric & said.isNotNull() & (hits > 1), "mcq_verified_answer_not_unique"),
        (said.isNotNull() & ~_empty(explanation) & ~contains_number(explanation, said), "mcq_explanation_missing_answer"),
        (~_empty(explanation) & _says(explanation, MATH_MARKERS), "mcq_math_meta_commentary"),
    ])
    return issues, F.when(numeric & (hits == 1), F.array_position(numbers, said).cast("int") - 1)


def general_question(evidence: Column, question: Column, choices: Column, index: Column, explanation: Column) -> Column:
    """Issue codes of a question on a piece of evidence with four choices."""
    _, shape = _choice_rules(choices)
    return _codes([
        (_empty(question), "empty_question"),
        *shape,
        *_index_rules(index),
        (_empty(explanation), "empty_explanation"),
        (_empty(evidence), "empty_evidence"),
        (_says(F.coalesce(explanation, F.lit("")), GENERAL_MARKERS), "mcq_general_meta_commentary"),
    ])
