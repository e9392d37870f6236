"""Contracts of records, responses and preference pairs: arrays of issue codes, empty for a valid row.

Null text counts as empty.  Patterns know ASCII words and blanks; texts beyond
ASCII are lower-cased, not case-folded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import normal_space
from .validators import codes, plain_codes

#: Patterns and limits (fixed values).
RESPONSE_FIELDS = r'"(?:id|prompt|reasoning|response|metadata)"\s*:'
PAIR_FIELDS = r'"(?:id|prompt|chosen|rejected|metadata|role|content)"\s*:'
REFUSAL = r"\b(?:i\s+can(?:not|'?t)|i\s+am\s+unable|i'm\s+unable|unable\s+to|can(?:not|'?t)\s+provide|i\s+do\s+not\s+have\s+access|i\s+don't\s+have\s+access|not\s+enough\s+information|insufficient\s+information|as\s+an\s+ai)\b"
RESTRAINT = r"\b(?:can(?:not|'?t)|do\s+not|don't|should\s+not|will\s+not|won't|unverifiable|unknown|not\s+publicly|not\s+available|unavailable|not\s+enough|insufficient|no\s+reliable|avoid\s+inventing|cannot\s+determine|private|no\s+source)\b"
ARITHMETIC = r"(-?\d+)\s*([+\-*/x×÷])\s*(-?\d+)"
WORD_PROBLEMS = (
    (r"(?i)\bhas\s+(\d+)\s+pencils\b.*\binto\s+(\d+)\s+bags\b", "/"),
    (r"(?i)\bhas\s+(\d+)\s+shelves\b.*\bwith\s+(\d+)\s+books\b", "*"),
    (r"(?i)\bbuys\s+(\d+)\s+packs\b.*\bwith\s+(\d+)\s+markers\b", "*"),
    (r"(?i)\bhas\s+(\d+)\s+cars\b.*\bwith\s+(\d+)\s+seats\b", "*"),
    (r"(?i)\buses\s+(\d+)\s+cups\b.*\bfor\s+(\d+)\s+loaves\b", "*"),
    (r"(?i)\bcompletes\s+(\d+)\s+laps\b.*\bof\s+(\d+)\s+meters\b", "*"),
    (r"(?i)\bships\s+(\d+)\s+boxes\b.*\bwith\s+(\d+)\s+items\b", "*"),
    (r"(?i)\bhas\s+(\d+)\s+students\b.*\binto\s+(\d+)\s+groups\b", "/"),
    (r"(?i)\bsold\s+(\d+)\s+morning\s+tickets\b.*\band\s+(\d+)\s+afternoon\s+tickets\b", "+"),
)
NAMED_FUNCTION = r"(?i)\bfunction\s+named\s+([A-Za-z_]\w*)\b"
EXPECTED_FUNCTION = r"(?i)\bnamed\s+([A-Za-z_]\w*)\b"
SIGNATURE_ONLY = r"^\s*(?:async\s+)?def\s+[A-Za-z_]\w*\s*\([^\n]*\)\s*:\s*$"
FUNCTION = r"\b(?:async\s+)?def\s+[A-Za-z_]\w*\s*\("
FUNCTION_NAME = r"\bdef\s+([A-Za-z_]\w*)\s*\("
INTEGER = r"^[+-]?\d+$"
MIN_CONTRAST_WORDS, CONTRAST_JACCARD, CONTRAST_LENGTH = 6, 0.92, 0.08
MAX_RESTRAINT_WORDS, MAX_REWRITE_WORDS = 60, 18
COPY_LEAST = 24


def _text(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")


def pair_text(c: Column) -> Column:
    """Lower case, Markdown marks as blanks, blanks collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[`*_#>\-]+", " "), r"\s+", " "))


def seed_key(c: Column) -> Column:
    return F.btrim(normal_space(F.coalesce(c, F.lit(""))), F.lit(" .!?;:"))


def unescaped_code(c: Column) -> Column:
    r"""Code of one line whose line breaks and tabs are written \n and \t, with real ones."""
    flat = ~F.contains(c, F.lit("\n")) & F.contains(c, F.lit("\\n"))
    return F.when(flat, F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t"))).otherwise(c)


def exact_keys(keys: Column, allowed: tuple[str, ...]) -> Column:
    """keys: array<string>.  unexpected_fields:a,b and missing_fields:c, each sorted."""
    want = F.array(*[F.lit(k) for k in allowed])
    more, less = (F.array_join(F.array_sort(F.array_except(*p)), ",") for p in ((keys, want), (want, keys)))
    return F.array_compact(F.array(F.when(more != "", F.concat(F.lit("unexpected_fields:"), more)), F.when(less != "", F.concat(F.lit("missing_fields:"), less))))


def mcq(choices: Column, index: Column, explanation: Column) -> Column:
    """Four choices, none empty, all different in normal form, an index among them and an explanation."""
    clean = F.transform(choices, normal_space)
    return codes(
        (choices.isNull(), "bad_choices"),
        (F.size(choices) != 4, "choices_not_four"),
        (F.exists(clean, lambda c: F.coalesce(c, F.lit("")) == ""), "empty_choice"),
        (F.size(F.array_distinct(clean)) != 4, "duplicate_choices"),
        (index.isNull(), "bad_correct_index_type"),
        ((index < 0) | (index > 3), "correct_index_out_of_bounds"),
        (_text(explanation) == "", "empty_explanation"),
    )


def corrected_index(choices: Column, answer: Column) -> Column:
    """Where the verified answer stands among the choices, from 0; null unless it stands there once."""
    clean, want = F.transform(choices, normal_space), normal_space(answer)
    return F.when(F.size(F.filter(clean, lambda c: c == want)) == 1, F.array_position(clean, want).cast("int") - 1)


def safe_answer(text: Column) -> Column:
    t = _text(text)
    return codes((t == "", "empty_safe_answer"), (F.startswith(F.lower(t), F.lit("do not ")), "factual_restraint_policy_instruction_voice"))


def copies(prompt: Column, answer: Column) -> Column:
    """The answer is the prompt, or begins with a long one and adds little."""
    rest = F.length(F.trim(F.substr(answer, F.length(prompt) + 1)))
    longer = (F.length(prompt) >= COPY_LEAST) & F.startswith(answer, prompt) & (rest < F.greatest(F.lit(12), F.floor(F.length(prompt) / 5)))
    return (prompt != "") & (answer != "") & ((prompt == answer) | longer)


def leaks(text: Column, fields: str) -> Column:
    """A field of the rows' own schema, or JSON whole or broken."""
    return F.regexp_like(text, F.lit(fields)) | F.substring(text, 1, 1).isin("{", "[")


def _applied(a: Column, op: Column, b: Column) -> Column:
    """a op b of two digit strings; null where it is no integer."""
    a, b = a.try_cast("bigint"), b.try_cast("bigint")
    whole = (b != 0) & (F.try_mod(a, b) == 0)
    times, over = op.isin("*", "x", "×"), op.isin("/", "÷")
    return F.when(op == "+", F.try_add(a, b)).when(op == "-", F.try_subtract(a, b)).when(times, F.try_multiply(a, b)).when(over & whole, F.try_divide(a, b).cast("bigint"))


def arithmetic_result(prompt: Column) -> Column:
    """The result of the first operation of two integers, else of the first kind of word problem that the prompt is; null if there is none or it is no integer."""
    a, op, b = (F.regexp_extract(prompt, ARITHMETIC, i) for i in (1, 2, 3))
    out = F.when(op != "", _applied(a, op, b))
    for pattern, op_ in WORD_PROBLEMS:
        out = out.when(F.regexp_like(prompt, F.lit(pattern)), _applied(F.regexp_extract(prompt, pattern, 1), F.lit(op_), F.regexp_extract(prompt, pattern, 2)))
    return out


def response(signal: Column, prompt: Column, answer: Column) -> Column:
    """Issue codes of a response by its signal; whether code parses is not looked at."""
    p, t = F.coalesce(prompt, F.lit("")), _text(answer)
    low, want = F.lower(t), arithmetic_result(p)
    full = (t != "") & (p != "")
    only = F.contains(F.lower(p), F.lit("only the integer result"))
    integer = F.regexp_like(t, F.lit(INTEGER))
    sums = (signal == "arithmetic") & full & want.isNotNull()
    shaped = F.regexp_like(t, F.lit(r"\bdef\s+\w+\s*\(|\blambda\b"))
    required = F.nullif(F.regexp_extract(p, NAMED_FUNCTION, 1), F.lit(""))
    named = F.array_contains(F.regexp_extract_all(t, F.lit(FUNCTION_NAME), 1), required)
    asks = F.contains(F.lower(p), F.lit("sql query")) | F.contains(F.lower(p), F.lit("write a query")) | F.contains(F.lower(p), F.lit("write a select")) | F.contains(F.lower(p), F.lit("write a sql"))
    return codes(
        (t == "", "empty_response"),
        ((t != "") & (F.length(t) < 3) & ~((signal == "arithmetic") & integer), "too_short_response"),
        (copies(seed_key(p), seed_key(t)), "repeats_prompt"),
        ((t != "") & leaks(t, RESPONSE_FIELDS), "schema_leakage"),
        ((signal != "factual_restraint") & F.regexp_like(low, F.lit(REFUSAL)), "unexpected_refusal"),
        (sums & only & ~integer, "arithmetic_non_integer_answer"),
        (sums & ~(only & ~integer) & ~F.array_contains(F.regexp_extract_all(t, F.lit(r"[+-]?\d+"), 0), want.cast("string")), "arithmetic_wrong_answer"),
        ((signal == "code") & full & F.contains(t, F.lit("```")), "markdown_fence"),
        ((signal == "code") & full & F.contains(F.lower(p), F.lit("python function")) & ~shaped, "code_missing_function_definition"),
        ((signal == "code") & full & shaped & ~F.contains(t, F.lit("```")) & required.isNotNull() & ~named, "code_wrong_function_name"),
        ((signal == "database") & full & asks & ~(F.contains(low, F.lit("select")) & F.contains(low, F.lit("from"))), "database_missing_sql_query"),
        ((signal == "factual_restraint") & (t != "") & ~F.regexp_like(low, F.lit(RESTRAINT)), "factual_restraint_missing_restraint"),
    )


def machine_verified(signal: Column, prompt: Column, answer: Column) -> Column:
    """An arithmetic response that is the exact integer and nothing else."""
    return F.coalesce((signal == "arithmetic") & (_text(answer) == arithmetic_result(F.coalesce(prompt, F.lit(""))).cast("string")), F.lit(False))


def pair_parts(prompt: Column, chosen: Column, rejected: Column) -> dict[str, Column]:
    """What the rules of pair() look at more than once; as columns of a table each is computed once."""
    return {"_c": pair_text(chosen), "_r": pair_text(rejected), "_p": pair_text(prompt), "_tc": _text(chosen), "_tr": _text(rejected)}


def pair_words(parts: dict[str, Column]) -> dict[str, Column]:
    """Those that need pair_parts(): the distinct words of either text."""
    return {f"_w{k}": F.array_distinct(F.regexp_extract_all(parts[k], F.lit("[a-z0-9]+"), 0)) for k in ("_c", "_r")}


def pair(prompt: Column, chosen: Column, rejected: Column, parts: dict[str, Column] | None = None) -> Column:
    """Issue codes of a preference pair of any category.

    parts: columns that have pair_parts() and pair_words() already.
    """
    make = codes if parts is None else plain_codes
    if parts is None:
        parts = pair_parts(prompt, chosen, rejected)
        parts |= pair_words(parts)
    c, r, p, tc, tr, a, b = (parts[k] for k in ("_c", "_r", "_p", "_tc", "_tr", "_w_c", "_w_r"))
    short = lambda t: (F.length(t) < 2) & ~F.regexp_like(t, F.lit(INTEGER))
    union, both = F.size(F.array_union(a, b)), F.size(F.array_intersect(a, b))
    longest = F.greatest(F.length(c), F.length(r))
    close = (union >= MIN_CONTRAST_WORDS) & (both / F.greatest(union, F.lit(1)) >= CONTRAST_JACCARD) & (F.abs(F.length(c) - F.length(r)) <= CONTRAST_LENGTH * longest)
    full = (c != "") & (r != "")
    return make(
        ((tc == "") | (tr == ""), "empty_pair_text"),
        (short(tc) | short(tr), "too_short_pair_text"),
        (full & (c == r), "identical_pair"),
        (full & (c != r) & close, "non_contrastive_pair"),
        (copies(p, c) | copies(p, r), "prompt_copy_pair"),
        (leaks(tc, PAIR_FIELDS) | leaks(tr, PAIR_FIELDS), "schema_leakage"),
    )


def with_pair_issues(rows: DataFrame) -> DataFrame:
    """rows (prompt, chosen, rejected) with their pair() as column issues, each part computed once."""
    text = F.col("prompt"), F.col("chosen"), F.col("rejected")
    one = pair_parts(*text)
    rows = rows.withColumns(one)
    two = pair_words({k: F.col(k) for k in one})
    rows = rows.withColumns(two)
    return rows.withColumn("issues", pair(*text, {k: F.col(k) for k in (*one, *two)})).drop(*one, *two)


def code_pair(prompt: Column, chosen: Column, rejected: Column, failure_mode: Column) -> Column:
    """Issue codes of a pair of code answers, by the shape of functions; whether code parses is not looked at."""
    c, r = _text(chosen), _text(rejected)
    expected = F.nullif(F.regexp_extract(F.coalesce(prompt, F.lit("")), EXPECTED_FUNCTION, 1), F.lit(""))
    names = F.regexp_extract_all(c, F.lit(FUNCTION_NAME), 1)
    only = F.regexp_like(c, F.lit(SIGNATURE_ONLY))
    return codes(
        (only, "chosen_code_signature_only"),
        (~only & (F.size(names) == 0), "chosen_code_missing_function"),
        (~only & (F.size(names) > 0) & expected.isNotNull() & ~F.array_contains(names, expected), "chosen_code_wrong_function_name"),
        ((failure_mode == "code_syntax_error") & ~F.regexp_like(r, F.lit(FUNCTION)), "rejected_code_not_python_function"),
    )


def restraint_length(category: Column, chosen: Column) -> Column:
    """Whether an answer that holds back private information does so at length."""
    return codes(((category == "private_info_restraint") & (F.regexp_count(F.lower(F.coalesce(chosen, F.lit(""))), F.lit("[a-z0-9]+")) > MAX_RESTRAINT_WORDS), "chosen_restraint_too_verbose"))


def pair_contract(family: Column, prompt: Column, chosen: Column, rejected: Column) -> Column:
    """Issue codes of pairs whose template lets a machine tell the right answer."""
    c, r = _text(chosen), _text(rejected)
    found = lambda pattern, i=1: F.nullif(F.regexp_extract(F.coalesce(prompt, F.lit("")), pattern, i), F.lit(""))
    status, region = found(r"(?i)deployment status ([a-z]+)"), found(r"(?i)belongs to region ([a-z]+)")
    less = found(r"([+-]?\d+)\s*-\s*([+-]?\d+)").try_cast("bigint") - found(r"([+-]?\d+)\s*-\s*([+-]?\d+)", 2).try_cast("bigint")
    times = found(r"(?i)contains (\d+) boxes with (\d+) items").try_cast("bigint") * found(r"(?i)contains (\d+) boxes with (\d+) items", 2).try_cast("bigint")
    number = F.when(family == "integer_subtraction", less).when(family == "inventory_word_problem", times)
    token, n = found(r"(?i)Repeat (\S+) exactly (\d+) times"), found(r"(?i)Repeat (\S+) exactly (\d+) times", 2).try_cast("int")
    repeated = F.array_join(F.array_repeat(token, n), ",")
    values = F.transform(F.regexp_extract_all(found(r"(?i)ascending order:\s*([^.]+)"), F.lit(r"[+-]?\d+"), 0), lambda v: v.cast("bigint"))
    ordered = F.array_join(F.array_sort(values), ", ")
    lines = F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    n_words = F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    is_ = lambda name: family == name
    single = lambda t: F.when(F.regexp_like(t, F.lit(INTEGER)), t.try_cast("bigint"))
    return codes(
        (is_("grounded_record_fact") & (F.lower(c) != F.lower(status)), "chosen_wrong_grounded_fact"),
        (is_("grounded_record_fact") & (F.lower(r) == F.lower(status)), "rejected_matches_grounded_fact"),
        (number.isNotNull() & ~single(c).eqNullSafe(number), "chosen_wrong_numeric_answer"),
        (number.isNotNull() & single(r).eqNullSafe(number), "rejected_matches_numeric_answer"),
        (is_("grounded_answer_only") & (F.lower(c) != F.lower(region)), "chosen_answer_only_violation"),
        (is_("grounded_answer_only") & (F.lower(r) == F.lower(region)), "rejected_not_answer_only_violation"),
        (is_("exact_token_repeat") & (c != repeated), "chosen_exact_format_violation"),
        (is_("exact_token_repeat") & (r == repeated), "rejected_matches_exact_format"),
        (is_("missing_transformation_context") & ~F.endswith(c, F.lit("?")), "chosen_missing_clarifying_question"),
        (is_("benign_task_over_refusal") & (c != ordered), "chosen_incorrect_benign_sort"),
        (is_("benign_task_over_refusal") & (r == ordered), "rejected_not_over_refusal"),
        (is_("exact_two_bullets") & ((F.size(lines) != 2) | F.exists(lines, lambda x: ~F.startswith(x, F.lit("- ")))), "chosen_two_bullet_violation"),
        (is_("instruction_rewrite") & (n_words > MAX_REWRITE_WORDS), "chosen_rewrite_too_verbose"),
    )


def constraint_checks(text: Column, limits: dict) -> Column:
    """array<struct<constraint, expected, observed, passed>> of the declared limits, all ten kinds, in their order.

    min_words, max_words, exact_nonempty_lines, min_list_items, max_list_items,
    exact_list_items (numbers); required_terms, forbidden_terms,
    required_headings, exact_json_keys (lists).
    """
    t = F.coalesce(text, F.lit(""))
    low = F.lower(t)
    lines = F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    listed = F.size(F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit(r"^\s*(?:[-*+]\s+|\d+[.)]\s+)"))))
    seen = {"words": F.regexp_count(t, F.lit(r"[A-Za-z0-9]+(?:['-][A-Za-z0-9]+)*")), "lines": F.size(lines), "items": listed}
    headings = F.transform(lines, lambda x: F.rtrim(F.lower(F.trim(F.regexp_replace(x, r"^#{1,6}\s*", ""))), F.lit(":")))
    keys = F.array_sort(F.json_object_keys(t))
    row = lambda kind, expected, observed, ok: F.struct(F.lit(kind).alias("constraint"), F.lit(str(expected)).alias("expected"), observed.cast("string").alias("observed"), F.coalesce(ok, F.lit(False)).alias("passed"))
    out = []
    for kind, what, holds in (
        ("min_words", "words", lambda x, y: x >= y), ("max_words", "words", lambda x, y: x <= y), ("exact_nonempty_lines", "lines", lambda x, y: x == y),
        ("min_list_items", "items", lambda x, y: x >= y), ("max_list_items", "items", lambda x, y: x <= y), ("exact_list_items", "items", lambda x, y: x == y),
    ):
        if kind in limits:
            out.append(row(kind, limits[kind], seen[what], holds(seen[what], limits[kind])))
    for term in limits.get("required_terms", ()):
        has = F.contains(low, F.lit(term.lower()))
        out.append(row("required_term", term, has, has))
    for term in limits.get("forbidden_terms", ()):
        has = F.regexp_like(low, F.lit(rf"(^|\W)\Q{term.lower()}\E(\W|$)"))
        out.append(row("forbidden_term", term, has, ~has))
    for heading in limits.get("required_headings", ()):
        has = F.array_contains(headings, heading.lower().rstrip(":"))
        out.append(row("required_heading", heading, has, has))
    if "exact_json_keys" in limits:
        want = sorted(limits["exact_json_keys"])
        out.append(row("exact_json_keys", ",".join(want), F.array_join(keys, ","), keys == F.array(*[F.lit(k) for k in want])))
    return F.array(*out)
