"""Reading what models return: labelled decisions, objects in fences, messages under a wrong role, tool signatures; and rendering records as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .validators import codes

#: Labels, their values and patterns (fixed values).
JUDGE, REVIEW = ("ASSESSABLE", "DECISION", "REASON"), ("AGREE", "REASON")
YES_NO, VERDICTS = ("YES", "NO"), ("ACCEPT", "REJECT")
SIGNATURE = r"^\s*([A-Za-z_][A-Za-z0-9_]*)\s*\((.*?)\)\s*$"
NAME = r"^[A-Za-z_][A-Za-z0-9_]*$"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
BLANKS = r"^\s+|\s+$"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, "")


def label(text: Column, name: str) -> Column:
    """What follows `NAME:` on the first line that begins with it, whatever its case; null if there is none or nothing follows."""
    lines = F.split(text, LINE_BREAK, -1)
    own = F.filter(lines, lambda x: F.contains(x, F.lit(":")) & (F.upper(_strip(F.substring_index(x, ":", 1))) == name))
    value = F.get(own, F.lit(0))
    return F.nullif(_strip(F.substring(value, F.instr(value, ":") + 1, F.length(value))), F.lit(""))


def _missing(labels: dict[str, Column]) -> Column:
    lost = F.array_compact(F.array(*[F.when(v.isNull(), F.lit(k)) for k, v in labels.items()]))
    return F.when(F.size(lost) > 0, F.concat(F.lit("missing_labels:"), F.array_join(lost, ",")))


def judge_decision(text: Column) -> Column:
    """struct<assessable, accepted, reason, issues> of a judge's answer; what is assessable and accepted is null where there are issues."""
    said = {k: label(text, k) for k in JUDGE}
    able, verdict = F.upper(said["ASSESSABLE"]), F.upper(said["DECISION"])
    issues = F.array_compact(F.array(_missing(said), F.when(~able.isin(*YES_NO), "bad_assessable"), F.when(~verdict.isin(*VERDICTS), "bad_decision")))
    good = F.size(issues) == 0
    return F.struct(F.when(good, able == "YES").alias("assessable"), F.when(good, (able == "YES") & (verdict == "ACCEPT")).alias("accepted"), said["REASON"].alias("reason"), issues.alias("issues"))


def review_decision(text: Column) -> Column:
    """struct<agreed, reason, issues> of a reviewer's answer."""
    said = {k: label(text, k) for k in REVIEW}
    agree = F.upper(said["AGREE"])
    issues = F.array_compact(F.array(_missing(said), F.when(~agree.isin(*YES_NO), "bad_agree")))
    return F.struct(F.when(F.size(issues) == 0, agree == "YES").alias("agreed"), said["REASON"].alias("reason"), issues.alias("issues"))


def json_object(text: Column) -> Column:
    """VARIANT of the one JSON object that a text is, a Markdown fence around it left out; null for anything else."""
    bare = _strip(text)
    fenced = _strip(F.regexp_replace(F.regexp_replace(bare, r"^```(?i:json)?\s*", ""), r"\s*```$", ""))
    body = F.when(F.startswith(bare, F.lit("```")), fenced).otherwise(bare)
    return F.when(F.startswith(body, F.lit("{")), F.try_parse_json(body))


def repaired_role(messages: Column) -> Column:
    """A single message with content under user or system becomes the assistant's; other messages (array of struct with role and content) stay."""
    only = F.get(messages, F.lit(0))
    wrong = (F.size(messages) == 1) & only["role"].isin("user", "system") & (_strip(F.coalesce(only["content"], F.lit(""))) != "")
    return F.when(wrong, F.transform(messages, lambda m: m.withField("role", F.lit("assistant")))).otherwise(messages)


def tool_signature(text: Column) -> Column:
    """struct<name, properties, required> of a signature like `find(city, day?, n: int)`; null if it is none.

    A parameter is optional where a ? stands anywhere in it; what follows a
    colon is left out, and so are parameters that have no proper name.
    """
    bare = _strip(text)
    name, inner = F.regexp_extract(bare, SIGNATURE, 1), F.regexp_extract(bare, SIGNATURE, 2)
    parts = F.transform(F.split(inner, ","), lambda p: F.struct(F.rtrim(_strip(F.substring_index(_strip(p), ":", 1)), F.lit("?")).alias("name"), F.contains(p, F.lit("?")).alias("optional")))
    named = F.filter(parts, lambda p: F.regexp_like(p["name"], F.lit(NAME)))
    all_, required = F.transform(named, lambda p: p["name"]), F.transform(F.filter(named, lambda p: ~p["optional"]), lambda p: p["name"])
    return F.when(name != "", F.struct(name.alias("name"), F.array_distinct(all_).alias("properties"), required.alias("required")))


def tool_schema(text: Column) -> Column:
    """The JSON schema of a signature's function, as text; null if it is none."""
    tool = tool_signature(text)
    described = F.concat(F.lit("Grounded "), tool["name"], F.lit(" operation for this candidate."))
    properties = F.map_from_entries(F.transform(tool["properties"], lambda p: F.struct(p, F.struct(F.lit("string").alias("type")))))
    required = F.when(F.size(tool["required"]) > 0, tool["required"])
    parameters = F.struct(F.lit("object").alias("type"), properties.alias("properties"), required.alias("required"))
    return F.when(tool.isNotNull(), F.to_json(F.struct(F.lit("function").alias("type"), F.struct(tool["name"].alias("name"), described.alias("description"), parameters.alias("parameters")).alias("function"))))


def numbered(lines: Column) -> Column:
    return F.array_join(F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def lettered(choices: Column) -> Column:
    return F.array_join(F.transform(choices, lambda x, i: F.concat(F.char(F.lit(65) + i), F.lit(". "), x)), "\n")


def rendered(signal: Column, row: dict[str, Column]) -> Column:
    """The public text of a record by its signal; row has the columns of every signal that occurs; null for other signals."""
    def lines(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    of = lambda c: row.get(c, F.lit(None).cast("string"))
    listed = lambda c: row.get(c, F.lit(None).cast("array<string>"))
    choice = lines("Question: ", of("question"), "\nChoices:\n", lettered(listed("choices")), "\nAnswer: ", F.char(F.lit(65) + row.get("correct_index", F.lit(None).cast("int"))), "\nExplanation: ", of("explanation"))
    return (
        F.when(signal == "arithmetic", lines("Question: ", of("question"), "\nSolution:\n", numbered(listed("steps")), "\nAnswer: ", of("answer")))
        .when(signal == "task_code", lines("Task: ", of("task"), "\nPlan:\n", numbered(listed("plan")), "\nCode:\n```python\n", of("code"), "\n```"))
        .when(signal == "educational_qa_mcq_math", choice)
        .when(signal == "educational_qa_mcq_general", lines("Evidence: ", of("evidence"), "\n", choice))
        .when(signal == "factual_restraint", lines("Question: ", of("question"), "\nAnswer: ", of("safe_answer")))
    )


def prompt_requirements(turns: Column, required: Column) -> Column:
    """array<struct<requirement, passed>>: whether each text stands in what comes before the last answer, whatever its case; turns: array of struct with role and text."""
    index = F.array_max(F.transform(turns, lambda t, i: F.when((t["role"] == "assistant") & (_strip(F.coalesce(t["text"], F.lit(""))) != ""), i)))
    before = F.lower(F.array_join(F.transform(F.slice(turns, F.lit(1), F.coalesce(index, F.greatest(F.size(turns) - 1, F.lit(0)))), lambda t: t["text"]), "\n"))
    return F.transform(required, lambda r: F.struct(r.alias("requirement"), F.contains(before, F.lower(r)).alias("passed")))


def branch_evidence(chosen: Column, rejected: Column) -> Column:
    """struct<status, declared, chosen_failed, rejected_failed> of both branches' checks (array of struct with constraint and passed): the chosen one must pass, the rejected one is only observed."""
    failed = lambda checks: F.transform(F.filter(checks, lambda c: ~c["passed"]), lambda c: c["constraint"])
    return F.struct(F.when(F.size(failed(chosen)) == 0, "passed").otherwise("failed").alias("status"), F.size(chosen).alias("declared"), failed(chosen).alias("chosen_failed"), failed(rejected).alias("rejected_failed"))


def domain_issues(values: dict[str, tuple[Column, tuple[str, ...]]], difficulty: Column, family: Column) -> Column:
    """Issue codes of a row's enumerated fields (name: value and what it may be, in lower case without blanks at the ends), its difficulty (1 to 5) and its family's name."""
    rules = [(~F.coalesce(F.lower(_strip(v)).isin(*allowed), F.lit(False)), f"invalid_{name}") for name, (v, allowed) in values.items()]
    rules += [(~F.coalesce(difficulty.between(1, 5), F.lit(False)), "invalid_difficulty"), (~F.coalesce(F.regexp_like(family, F.lit("^[a-z][a-z0-9]*(?:_[a-z0-9]+)*$")), F.lit(False)), "invalid_template_family")]
    return codes(*rules)
