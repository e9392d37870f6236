"""Conversations with tools: the first issue of tool lists, messages, calls and turn orders, and of rendered answers; null for valid ones.

messages: array<struct<role string, content string, tool_calls array<struct<id, name, arguments>>, tool_call_id string>>;
tools: array<struct<name string, description string, parameters string>>, parameters and arguments being JSON texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
ROLES = ("system", "user", "assistant", "tool")
NAME = r"^\s*$"
TABLE_RULE = r"^[|:\-\s]*-[|:\-\s]*$"


def _blank(c: Column) -> Column:
    return F.regexp_like(F.coalesce(c, F.lit("")), F.lit(NAME))


def _whole(text: Column) -> Column:
    """The text is one JSON value and nothing behind it: the parsers stop at its end, but in a list and in an object they do not."""
    listed, keyed = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))), F.json_object_keys(F.concat(F.lit('{"a":'), text, F.lit("}")))
    return F.coalesce((listed == 1) & keyed.isNotNull(), F.lit(False))


def _object(text: Column) -> Column:
    """The text is a JSON object."""
    return _whole(text) & F.startswith(F.ltrim(text), F.lit("{"))


def _first(*rules: tuple[Column, str]) -> Column:
    """The code of the first rule that holds, else null."""
    return F.coalesce(*[F.when(hit, F.lit(code)) for hit, code in rules])


def tool_issue(tools: Column) -> Column:
    """A list of tools that is not null must have some, each named once, described, with parameters of type object."""
    names = F.transform(tools, lambda t: t["name"])
    type_ = lambda t: F.get_json_object(t["parameters"], "$.type")
    properties = lambda t: F.get_json_object(t["parameters"], "$.properties")
    return F.when(
        tools.isNotNull(),
        _first(
            (F.size(tools) == 0, "empty_tools"),
            (F.exists(tools, lambda t: _blank(t["name"])), "empty_tool_name"),
            (F.size(F.array_distinct(names)) < F.size(names), "duplicate_tool_name"),
            (F.exists(tools, lambda t: _blank(t["description"])), "empty_tool_description"),
            (F.exists(tools, lambda t: ~_object(t["parameters"])), "parameters_not_object"),
            (F.exists(tools, lambda t: ~type_(t).eqNullSafe(F.lit("object"))), "parameters_type_not_object"),
            (F.exists(tools, lambda t: properties(t).isNotNull() & ~_object(properties(t))), "properties_not_object"),
        ),
    )


def message_issue(m: Column) -> Column:
    """The shape of one message by its role; an assistant says something, calls tools, or both."""
    role, calls = F.lower(F.btrim(F.coalesce(m["role"], F.lit("")))), m["tool_calls"]
    ids = F.transform(calls, lambda c: c["id"])
    return _first(
        (role == "", "empty_role"),
        (~role.isin(*ROLES), "unsupported_role"),
        ((role != "assistant") & calls.isNotNull(), "unexpected_tool_calls"),
        ((role != "tool") & m["tool_call_id"].isNotNull(), "unexpected_tool_call_id"),
        ((role == "assistant") & m["content"].isNull() & calls.isNull(), "assistant_says_nothing"),
        (((role != "assistant") | m["content"].isNotNull()) & _blank(m["content"]), "empty_content"),
        ((role == "tool") & _blank(m["tool_call_id"]), "empty_tool_call_id"),
        (F.size(calls) == 0, "empty_tool_calls"),
        (F.exists(calls, lambda c: _blank(c["id"])), "empty_call_id"),
        (F.size(F.array_distinct(ids)) < F.size(ids), "duplicate_call_id"),
        (F.exists(calls, lambda c: _blank(c["name"])), "empty_call_name"),
        (F.exists(calls, lambda c: ~_object(c["arguments"])), "arguments_not_object"),
    )


def conversation_issue(messages: Column, tools: Column, final: str = "assistant") -> Column:
    """The first issue of a conversation, tools and messages first, then the turns in order, then its end.

    Turns: a system message may open; user and assistant alternate; an
    assistant that calls declared tools, by ids not used before, is followed
    by one answer to each call and then speaks again.  final: the role that
    must speak last, "assistant" or "user"; an assistant's last turn calls
    nothing.  A null or empty conversation is `empty_messages`.
    """
    # Lists that are null are empty here: a fold over null would make the whole state null.
    none = F.array().cast("array<string>")
    named = F.coalesce(F.transform(tools, lambda t: t["name"]), none)
    turns = F.transform(
        messages,
        lambda m, i: F.struct(
            F.lower(F.btrim(m["role"])).alias("role"), i.alias("i"), m["tool_call_id"].alias("answers"),
            F.coalesce(F.transform(m["tool_calls"], lambda c: c["id"]), none).alias("ids"),
            F.coalesce(F.transform(m["tool_calls"], lambda c: c["name"]), none).alias("names"),
        ),
    )
    start = F.struct(F.lit("opening").alias("expect"), none.alias("pending"), none.alias("used"), F.lit(None).cast("string").alias("issue"))

    def step(s: Column, t: Column) -> Column:
        role, calls = t["role"], F.size(t["ids"]) > 0
        found = _first(
            ((role == "system") & (t["i"] > 0), "misplaced_system"),
            ((role == "user") & ~s["expect"].isin("opening", "user"), "misplaced_user"),
            ((role == "assistant") & (s["expect"] == "tool"), "unresolved_tool_call"),
            ((role == "assistant") & (s["expect"] != "assistant"), "misplaced_assistant"),
            ((role == "assistant") & calls & tools.isNull(), "calls_without_tools"),
            ((role == "assistant") & (F.size(F.array_except(t["names"], named)) > 0), "undeclared_tool"),
            ((role == "assistant") & F.arrays_overlap(t["ids"], s["used"]), "reused_call_id"),
            ((role == "tool") & (s["expect"] != "tool"), "answer_without_call"),
            ((role == "tool") & ~F.array_contains(s["pending"], t["answers"]), "unknown_answer_id"),
        )
        pending = F.when(role == "assistant", t["ids"]).when(role == "tool", F.array_remove(s["pending"], t["answers"])).otherwise(s["pending"])
        expect = (
            F.when(role == "system", "user").when(role == "user", "assistant")
            .when((role == "assistant") & ~calls, "user")
            .when((role == "tool") & (F.size(pending) == 0), "assistant").otherwise("tool")
        )
        return F.struct(expect.alias("expect"), pending.alias("pending"), F.array_union(s["used"], t["ids"]).alias("used"), F.coalesce(s["issue"], found).alias("issue"))

    end = F.aggregate(turns, start, step, lambda s: F.coalesce(s["issue"], F.when(F.size(s["pending"]) > 0, "unresolved_tool_call")))
    last = F.try_element_at(turns, F.lit(-1))
    return F.coalesce(
        F.when(messages.isNull() | (F.size(messages) == 0), "empty_messages"),
        tool_issue(tools),
        F.try_element_at(F.filter(F.transform(messages, message_issue), lambda x: x.isNotNull()), F.lit(1)),
        end,
        F.when(~F.exists(turns, lambda t: t["role"] == "user"), "no_user_message"),
        F.when(last["role"] != final, f"final_role_not_{final}"),
        F.when((last["role"] == "assistant") & (F.size(last["ids"]) > 0), "final_turn_calls_tools"),
    )


def _filled_lines(text: Column) -> Column:
    return F.filter(F.split(text, r"\r?\n"), lambda x: ~_blank(x))


def mode_issue(text: Column, mode: Column) -> Column:
    """The form an answer must have: structured_json an object or array, bare or in a fence; table a line with bars and a rule; code a fence.

    Other modes ask for some text only.
    """
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    fenced = F.regexp_extract(t, r"(?s)^```[^\n]*\n(.*)\n\s*```$", 1)
    inner = F.btrim(F.when(fenced != "", fenced).otherwise(t), F.lit(" \t\r\n"))
    json = _whole(inner) & F.substring(inner, 1, 1).isin("{", "[")
    lines = _filled_lines(t)
    table = F.exists(lines, lambda x: F.contains(x, F.lit("|"))) & F.exists(lines, lambda x: F.regexp_like(x, F.lit(TABLE_RULE)))
    wrong = reduce(lambda a, b: a | b, [(mode == "structured_json") & ~json, (mode == "table") & ~table, (mode == "code") & ~F.contains(t, F.lit("```"))])
    return _first((t == "", "no_final_content"), (wrong, "output_mode_not_satisfied"))
