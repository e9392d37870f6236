"""Decisions, signatures, roles and rendered records on small tables with nulls, blanks and ties."""

import json

import pytest
from pyspark.sql import functions as F

from marlstone.functions import decisions as dc
from marlstone.operators import acceptance
from marlstone.sources import jsonl


def values(spark, column, schema, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_row int, " + schema)
    return [r.x for r in df.select("_row", column.alias("x")).orderBy("_row").collect()]


def test_judges_and_reviewers(spark):
    texts = [
        "assessable: yes\n Decision : Accept \nREASON: it is: good\nreason: later", "ASSESSABLE: no\r\nDECISION: ACCEPT\r\nREASON: x", "ASSESSABLE: maybe\nDECISION: drop\nREASON: x", "DECISION: REJECT\nREASON:  \nno label", "", None, "ASSESSABLE:\nASSESSABLE: yes\nDECISION: accept\nREASON: r",
    ]
    got = values(spark, dc.judge_decision(F.col("t")), "t string", [(t,) for t in texts])
    assert [(r.assessable, r.accepted, r.reason, r.issues) for r in got] == [
        (True, True, "it is: good", []), (False, False, "x", []), (None, None, "x", ["bad_assessable", "bad_decision"]), (None, None, None, ["missing_labels:ASSESSABLE,REASON"]),
        (None, None, None, ["missing_labels:ASSESSABLE,DECISION,REASON"]), (None, None, None, ["missing_labels:ASSESSABLE,DECISION,REASON"]), (None, None, "r", ["missing_labels:ASSESSABLE"]),
    ]
    got = values(spark, dc.review_decision(F.col("t")), "t string", [("Agree: YES\nReason: ok",), ("agree: nope\nreason: ok",), ("x",)])
    assert [(r.agreed, r.issues) for r in got] == [(True, []), (None, ["bad_agree"]), (None, ["missing_labels:AGREE,REASON"])]


def test_objects_in_fences(spark):
    texts = ['```json\n{"a": 1}\n```', ' {"b": [2]} ', '```\n{"a": 1}```', "[1]", "```json\n[1]\n```", "{broken", "", None]
    got = values(spark, F.to_json(dc.json_object(F.col("t"))), "t string", [(t,) for t in texts])
    assert got == ['{"a":1}', '{"b":[2]}', '{"a":1}', None, None, None, None, None]


def test_single_messages_under_a_wrong_role(spark):
    rows = [([("user", "hi")],), ([("system", "x")],), ([("user", " ")],), ([("user", None)],), ([("tool", "x")],), ([("user", "a"), ("user", "b")],), ([],), (None,), ([("assistant", "y")],)]
    got = values(spark, dc.repaired_role(F.col("m")), "m array<struct<role: string, content: string>>", rows)
    assert [None if m is None else [x.role for x in m] for m in got] == [["assistant"], ["assistant"], ["user"], ["user"], ["tool"], ["user", "user"], [], None, ["assistant"]]


def test_tool_signatures(spark):
    texts = [" find(city, day?, n: int) ", "now()", "f( a , b ?, 2x, , c:str? )", "bad", "1f(a)", "f(a", "f(a, a?)", "", None]
    got = values(spark, dc.tool_signature(F.col("t")), "t string", [(t,) for t in texts])
    assert [r and (r.name, r.properties, r.required) for r in got] == [("find", ["city", "day", "n"], ["city", "n"]), ("now", [], []), ("f", ["a", "c"], ["a"]), None, None, None, ("f", ["a"], ["a"]), None, None]
    schemas = values(spark, dc.tool_schema(F.col("t")), "t string", [(texts[0],), (texts[1],), ("bad",)])
    assert json.loads(schemas[0]) == {"type": "function", "function": {"name": "find", "description": "Grounded find operation for this candidate.", "parameters": {"type": "object", "properties": {k: {"type": "string"} for k in ("city", "day", "n")}, "required": ["city", "n"]}}}
    assert json.loads(schemas[1])["function"]["parameters"] == {"type": "object", "properties": {}} and schemas[2] is None


def test_rendered_records(spark):
    names = ("question", "steps", "answer", "task", "plan", "code", "choices", "correct_index", "explanation", "evidence", "safe_answer")
    schema = "signal string, question string, steps array<string>, answer string, task string, plan array<string>, code string, choices array<string>, correct_index int, explanation string, evidence string, safe_answer string"
    base = dict.fromkeys(names)
    row = lambda signal, **x: (signal, *(base | x).values())
    rows = [
        row("arithmetic", question="1+1?", steps=["add", "done"], answer="2"), row("task_code", task="T", plan=["p"], code="x = 1"), row("educational_qa_mcq_math", question="Q", choices=list("wxyz"), correct_index=2, explanation="E"),
        row("educational_qa_mcq_general", question="Q", choices=list("wxyz"), correct_index=0, explanation="E", evidence="V"), row("factual_restraint", question="Q", safe_answer="No"), row("other", question="Q"), row("factual_restraint", question="Q"),
    ]
    got = values(spark, dc.rendered(F.col("signal"), {n: F.col(n) for n in names}), schema, rows)
    choices = "Question: Q\nChoices:\nA. w\nB. x\nC. y\nD. z\nAnswer: {}\nExplanation: E"
    assert got == ["Question: 1+1?\nSolution:\n1. add\n2. done\nAnswer: 2", "Task: T\nPlan:\n1. p\nCode:\n```python\nx = 1\n```", choices.format("C"), "Evidence: V\n" + choices.format("A"), "Question: Q\nAnswer: No", None, None]
    assert values(spark, dc.rendered(F.col("signal"), {}), "signal string", [("arithmetic",)]) == [None]


def test_prompt_requirements_and_branches(spark):
    turns = [("system", "Be Kind"), ("user", "About CATS"), ("assistant", "Dogs"), ("assistant", " ")]
    got = values(spark, dc.prompt_requirements(F.col("t"), F.col("r")), "t array<struct<role: string, text: string>>, r array<string>", [(turns, ["kind", "cats", "dogs"]), ([], ["x"]), (turns, [])])
    assert [[c.passed for c in r] for r in got] == [[True, True, False], [False], []]
    check = "array<struct<constraint: string, passed: boolean>>"
    got = values(spark, dc.branch_evidence(F.col("a"), F.col("b")), f"a {check}, b {check}", [([("min", True)], [("min", False)]), ([("min", False), ("max", True)], [("min", True)]), ([], [])])
    assert [(r.status, r.declared, r.chosen_failed, r.rejected_failed) for r in got] == [("passed", 1, [], ["min"]), ("failed", 2, ["min"], []), ("passed", 0, [], [])]


def test_domains(spark):
    c = dc.domain_issues({"mode": (F.col("m"), ("single", "multi"))}, F.col("d"), F.col("f"))
    rows = [(" Single ", 1, "two_words2"), ("other", 6, "Two"), (None, None, None), ("multi", 5, "a__b")]
    assert values(spark, c, "m string, d int, f string", rows) == [[], ["invalid_mode", "invalid_difficulty", "invalid_template_family"], ["invalid_mode", "invalid_difficulty", "invalid_template_family"], ["invalid_template_family"]]


LINES = ['{"id": "a", "n": 1}', "", "[1]", '{"id": "b", "n": "x"}', "{broken", '{"n": 3, "role": 1}']


def test_strict_scans_name_the_line_and_error_tables_the_rows(spark, tmp_path):
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text("\n".join(LINES[:2]) + '\n{"id": "c", "n": 2, "more": []}\n')
    bad.write_text("\n".join(LINES))
    assert sorted(map(tuple, jsonl.read_strict(spark, str(good), "id string, n int").collect())) == [("a", 1), ("c", 2)]
    with pytest.raises(Exception, match=r"good.jsonl line 3: low"):
        jsonl.read_strict(spark, str(good), "id string, n int", F.when(F.try_variant_get("row", "$.n", "int") > 1, F.array(F.lit("low")))).collect()
    for lines, message in ((LINES[:3], r"line 3: not_object"), ([LINES[3]], r"line 1: bad_type"), ([LINES[0], LINES[4]], r"line 2: bad_json")):
        one = tmp_path / "one.jsonl"
        one.write_text("\n".join(lines))
        with pytest.raises(Exception, match=message):
            jsonl.read_strict(spark, str(one), "id string, n int").collect()
    checks = F.array_compact(F.array(F.when(F.try_variant_get("row", "$.role", "int").isNotNull(), "bad_role"), F.when(F.try_variant_get("row", "$.id", "string").isNull(), "no_id")))
    got = [(r.line, r.id, r.error, r.tool_or_role) for r in jsonl.error_table(spark, str(bad), checks).orderBy("line", "error").collect()]
    assert got == [(2, None, "empty_line", False), (3, None, "not_object", False), (5, None, "bad_json", False), (6, None, "bad_role", True), (6, None, "no_id", False)]


def test_validated_overwrite_counts_or_replaces_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a"), (2, "b\nc")], "k long, t string")
    checks = F.array_compact(F.array(F.when(F.col("k") > 2, "too_large")))
    assert jsonl.write_validated(df, path, checks) == 2
    with pytest.raises(ValueError, match="too_large"):
        jsonl.write_validated(df.withColumn("k", F.col("k") + 1), path, checks)
    assert sorted(map(tuple, spark.read.schema("k long, t string").json(path).collect())) == [(1, "a"), (2, "b\nc")]
    assert jsonl.write_validated(df.limit(0), path, checks) == 0


def test_source_inventories(spark):
    rows = [
        ("g", "one", "t1", "text", None, "s1"), ("g", "two_variant2", "t1", "tool_call", ["tool_mediated"], "s2"), ("g", "three", "t2", "tool_call", ["single_turn"], "s3"), ("g", "four", "t3", "text", [], "s1"), ("g", "five", "t4", None, None, None),
        ("h", "one", "t1", "text", None, "s5"), ("h", " ", "t2", "text", None, "s6"), (None, None, "t", "text", None, "s7"),
    ]
    df = spark.createDataFrame(rows, "grp string, k string, t string, m string, how array<string>, s string")
    got = sorted(map(tuple, acceptance.source_issues(df, "grp", "k", "t", F.col("m"), F.col("how"), F.col("s")).collect()), key=repr)
    assert got == sorted([
        ("h", None, "too_few_sources"), ("h", None, "concentrated_template"), (None, None, "too_few_sources"), (None, None, "concentrated_template"), ("g", "two_variant2", "numbered_variant"), ("g", "three", "tool_call_without_tools"),
        ("g", "one", "repeated_key"), ("h", "one", "repeated_key"), ("g", "one", "superficial_copy"), ("g", "four", "superficial_copy"), ("h", " ", "missing_key"), (None, None, "missing_key"),
    ], key=repr)


def test_controller_totals(spark):
    schema = "i int, current int, maximum int, minimum int, observed_minimum int, observed_peak int, increases int, decreases int, successes int, failures int"
    df = spark.createDataFrame([(2, 8, 64, 1, 4, 16, 1, 0, 5, 1), (1, 4, 32, 2, 2, 40, 0, 3, 6, 2)], schema)
    assert tuple(acceptance.controller_totals(df, "i").first()) == (8, 64, 1, 2, 40, 1, 3, 11, 3)
    assert tuple(acceptance.controller_totals(df.limit(0), "i").first()) == (0,) * 9
