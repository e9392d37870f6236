"""Conversations with tools and rendered answers on small tables, with nulls and empty lists."""

from pyspark.sql import functions as F

from marlstone.functions import chat

CALLS = "array<struct<id string, name string, arguments string>>"
MESSAGES = f"array<struct<role string, content string, tool_calls {CALLS}, tool_call_id string>>"
TOOLS = "array<struct<name string, description string, parameters string>>"

S, U, A = ("system", "be brief", None, None), ("user", "hello", None, None), ("assistant", "hi", None, None)
SEARCH = [("search", "finds", '{"type": "object"}')]


def call(*ids, name="search", arguments="{}", content=None):
    return ("assistant", content, [(i, name, arguments) for i in ids], None)


def answer(i):
    return ("tool", "found", None, i)


def issues(spark, rows, final="assistant"):
    df = spark.createDataFrame([(n, m, t) for n, (m, t) in enumerate(rows)], f"n int, m {MESSAGES}, t {TOOLS}")
    return [r.x for r in df.select("n", chat.conversation_issue(F.col("m"), F.col("t"), final).alias("x")).orderBy("n").collect()]


def test_valid_conversations(spark):
    rows = [([U, A], None), ([S, U, A, U, A], None), ([U, call("1"), answer("1"), A], SEARCH), ([U, call("1", "2", content="wait"), answer("2"), answer("1"), call("3"), answer("3"), A], SEARCH), ([(" USER", "x", None, None), A], SEARCH)]
    assert issues(spark, rows) == [None] * 5


def test_turns_out_of_order(spark):
    rows = {
        "empty_messages": ([], None), "misplaced_system": ([U, S, A], None), "misplaced_user": ([U, U, A], None), "misplaced_assistant": ([U, A, A], None), "unresolved_tool_call": ([U, call("1"), A], SEARCH),
        "calls_without_tools": ([U, call("1"), answer("1"), A], None), "undeclared_tool": ([U, call("1", name="other"), answer("1"), A], SEARCH), "reused_call_id": ([U, call("1"), answer("1"), call("1"), answer("1"), A], SEARCH),
        "answer_without_call": ([U, A, answer("1")], SEARCH), "unknown_answer_id": ([U, call("1", "2"), answer("1"), answer("1"), A], SEARCH), "no_user_message": ([S], None), "final_role_not_assistant": ([U, A, U], None),
    }
    assert issues(spark, list(rows.values())) == list(rows)
    assert issues(spark, [(None, None), ([U, call("1")], SEARCH), ([A], None)]) == ["empty_messages", "unresolved_tool_call", "misplaced_assistant"]
    assert issues(spark, [([U, A, U], None), ([U, A], None)], "user") == [None, "final_role_not_user"]


def test_shapes_of_messages_come_before_their_order(spark):
    rows = {
        "unsupported_role": [("robot", "x", None, None)], "empty_role": [(None, "x", None, None)], "assistant_says_nothing": [U, ("assistant", None, None, None)], "empty_content": [U, ("assistant", " ", None, None)],
        "empty_tool_calls": [U, ("assistant", None, [], None)], "duplicate_call_id": [U, call("1", "1")], "empty_call_id": [U, call(" ")], "empty_call_name": [U, call("1", name=None)], "arguments_not_object": [U, call("1", arguments="[1]")],
        "empty_tool_call_id": [U, answer(None)], "unexpected_tool_calls": [("user", "x", [("1", "search", "{}")], None)], "unexpected_tool_call_id": [("user", "x", None, "1")],
    }
    assert issues(spark, [(m, SEARCH) for m in rows.values()]) == list(rows)


def test_tool_lists(spark):
    ok = '{"type": "object", "properties": {}}'
    rows = {
        "empty_tools": [], "empty_tool_name": [(" ", "d", ok)], "duplicate_tool_name": [("a", "d", ok), ("a", "d", ok)], "empty_tool_description": [("a", None, ok)],
        "parameters_not_object": [("a", "d", "[]")], "parameters_type_not_object": [("a", "d", "{}")], "properties_not_object": [("a", "d", '{"type": "object", "properties": 3}')],
    }
    assert issues(spark, [([U, A], t) for t in rows.values()]) == list(rows)
    assert issues(spark, [([U, A], [("a", "d", ok), ("b", "d", ok)])]) == [None]


def test_output_modes(spark):
    rows = [
        ("structured_json", '{"a": 1}', None), ("structured_json", "```json\n[1]\n```", None), ("structured_json", "3", "output_mode_not_satisfied"), ("structured_json", '{"a": 1} and more', "output_mode_not_satisfied"), ("structured_json", "{", "output_mode_not_satisfied"),
        ("table", "| a |\n|---|\n| 1 |", None), ("table", "| a |", "output_mode_not_satisfied"), ("code", "```\nx\n```", None), ("code", "x", "output_mode_not_satisfied"),
        ("prose", "x", None), (None, "x", None), ("table", None, "no_final_content"), ("prose", " \n", "no_final_content"),
    ]
    df = spark.createDataFrame([(n, *r[:2]) for n, r in enumerate(rows)], "n int, mode string, t string")
    got = [r.x for r in df.select("n", chat.mode_issue(F.col("t"), F.col("mode")).alias("x")).orderBy("n").collect()]
    assert got == [r[2] for r in rows]
