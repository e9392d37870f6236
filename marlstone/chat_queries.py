"""Queries of conversations with tools and of rendered answers, each with its DuckDB SQL.

The driver's tables hold no tool calls, so conversations are made from rows of
`orders` by expressions that both engines read: a pattern of letters (s, u, a;
x and y call one and two tools, t answers), varied by the row's number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import chat
from .queries import query
from .sources.shared import table

BASE = "case k % 4 when 0 then 'ua' when 1 then 'sua' when 2 then 'uxta' else 'suyttaua' end"
PATTERN = (
    "case k % 11 when 1 then replace(b, 'xt', 'x') when 2 then reverse(b) when 3 then concat(b, 'u') when 4 then concat(b, 'a') when 5 then concat(b, 'ux') when 6 then replace(b, 'y', 'x') "
    "when 7 then replace(b, 'u', 's') when 8 then case when k % 5 = 0 then '' else b end when 9 then replace(b, 'a', 't') when 10 then concat(b, 'uxta') else b end"
)
#: Of message i (from 0); q is the pattern behind two blanks, so that the letters before it can be asked for.
LETTER, BEFORE, BEFORE_THAT = "substring(q, cast(i as int) + 3, 1)", "substring(q, cast(i as int) + 2, 1)", "substring(q, cast(i as int) + 1, 1)"
ROLE = f"case when k % 37 = 5 and i = 1 then 'Robot' when {LETTER} = 's' then 'system' when {LETTER} = 'u' then ' User' when {LETTER} = 't' then 'tool' else 'assistant' end"
CONTENT = f"case when {LETTER} in ('x', 'y') then null when k % 29 = 3 and i = 1 then ' ' else concat('text ', i) end"
CALL = "case when k % 31 = 4 then 'c' else concat('{0}', {1}) end"
NAME = "case when k % 23 = 7 then 'unknown' else '{0}' end"
ARGUMENTS = """case when k % 41 = 3 then '[1]' else '{"q": 1}' end"""
ANSWERS = f"case when {LETTER} <> 't' then null when {BEFORE} in ('x', 'y') then {CALL.format('c', 'i - 1')} when {BEFORE_THAT} = 'y' then {CALL.format('d', 'i - 2')} else 'z' end"
TOOL_NAME = "case when k % 43 = 2 then 'search' else 'lookup' end"
DESCRIBED = "case when k % 59 = 8 then ' ' else 'finds things' end"
PARAMETERS = """case when k % 47 = 3 then '{"type": "array"}' when k % 61 = 9 then '{"type": "object", "properties": [1]}' when k % 67 = 4 then 'none' else '{"type": "object", "properties": {"q": {}}}' end"""
TOOLS = "case when k % 53 = 1 then 'none' when k % 7 = 2 then 'null' else 'two' end"

ROWS = f"b as (select o_orderkey as k, {BASE.replace('k %', 'o_orderkey %')} as b from orders), r as (select k, concat('  ', {PATTERN}) as q, {TOOLS} as has, {TOOL_NAME} as second, {DESCRIBED} as described, {PARAMETERS} as parameters from b)"
TOOL_ISSUE = r"""case when has = 'null' then null when has = 'none' then 'empty_tools' when second = 'search' then 'duplicate_tool_name' when trim(described) = '' then 'empty_tool_description'
 when parameters not like '{%' then 'parameters_not_object' when parameters like '%"array"%' then 'parameters_type_not_object' when parameters like '%[1]%' then 'properties_not_object' end"""


def _rows(spark, d) -> DataFrame:
    """k, messages and tools."""
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).withColumn("b", F.expr(BASE)).withColumn("q", F.expr(f"concat('  ', {PATTERN})"))
    call = lambda c, n: f"named_struct('id', {CALL.format(c, 'i')}, 'name', {NAME.format(n)}, 'arguments', {ARGUMENTS})"
    calls = f"case {LETTER} when 'x' then array({call('c', 'search')}) when 'y' then array({call('c', 'search')}, {call('d', 'lookup')}) end"
    message = f"named_struct('role', {ROLE}, 'content', {CONTENT}, 'tool_calls', {calls}, 'tool_call_id', {ANSWERS})"
    messages = f"case when length(q) > 2 then transform(sequence(0, length(q) - 3), i -> {message}) end"
    tool = lambda n: f"named_struct('name', {n}, 'description', {DESCRIBED}, 'parameters', {PARAMETERS})"
    tools = f"case {TOOLS} when 'two' then array({tool(chr(39) + 'search' + chr(39))}, {tool(TOOL_NAME)}) when 'none' then slice(array({tool(TOOL_NAME)}), 1, 0) end"
    return rows.select("k", F.expr(messages).alias("messages"), F.expr(tools).alias("tools"))


@query(f"with {ROWS} select k, {TOOL_ISSUE} as issue from r")
def tool_list_issues(spark, d):
    return _rows(spark, d).select("k", chat.tool_issue(F.col("tools")).alias("issue"))


TURNS = f"""{ROWS}, l as (select r.*, cast(u.i as int) as i, {LETTER} as letter from r, unnest(range(length(q) - 2)) as u(i)),
t as (select k, has, i, letter, lower(trim({ROLE})) as role, {CONTENT} as content, {ANSWERS} as answers, {ARGUMENTS} as arguments,
 case letter when 'x' then [{CALL.format('c', 'i')}] when 'y' then [{CALL.format('c', 'i')}, {CALL.format('d', 'i')}] else cast([] as varchar[]) end as ids, case when letter in ('x', 'y') then {NAME.format('search')} end as called,
 case when has = 'null' and letter in ('x', 'y') then 'calls_without_tools' end as untooled from l),
m as (select *, case when role not in ('system', 'user', 'assistant', 'tool') then 'unsupported_role' when role <> 'assistant' and len(ids) > 0 then 'unexpected_tool_calls' when role <> 'tool' and answers is not null then 'unexpected_tool_call_id'
 when (role <> 'assistant' or content is not null) and trim(coalesce(content, '')) = '' then 'empty_content' when len(list_distinct(ids)) < len(ids) then 'duplicate_call_id' when len(ids) > 0 and arguments like '[%' then 'arguments_not_object' end as shape from t)"""


@query(f"with {TURNS} select k, i, role, shape as issue from m where shape is not null")
def message_issues(spark, d):
    rows = _rows(spark, d).select("k", F.posexplode("messages").alias("i", "m"))
    return rows.select("k", "i", F.lower(F.trim("m.role")).alias("role"), chat.message_issue(F.col("m")).alias("issue")).where("issue is not null")


@query(f"""with recursive {TURNS},
w as (select k, 0 as i, 'opening' as expect, cast([] as varchar[]) as pending, cast([] as varchar[]) as used, cast(null as varchar) as issue from r
 union all select w.k, w.i + 1, case role when 'system' then 'user' when 'user' then 'assistant' when 'assistant' then case when len(ids) > 0 then 'tool' else 'user' end else case when len(list_filter(pending, lambda x: x <> answers)) = 0 then 'assistant' else 'tool' end end,
  case role when 'assistant' then ids when 'tool' then list_filter(pending, lambda x: x <> answers) else pending end, list_concat(used, ids),
  coalesce(issue, case when role = 'system' and m.i > 0 then 'misplaced_system' when role = 'user' and expect not in ('opening', 'user') then 'misplaced_user' when role = 'assistant' and expect = 'tool' then 'unresolved_tool_call' when role = 'assistant' and expect <> 'assistant' then 'misplaced_assistant'
   when role = 'assistant' and untooled is not null then untooled when called = 'unknown' then 'undeclared_tool' when role = 'assistant' and list_has_any(ids, used) then 'reused_call_id' when role = 'tool' and expect <> 'tool' then 'answer_without_call' when role = 'tool' and not list_contains(pending, answers) then 'unknown_answer_id' end)
 from w join m on m.k = w.k and m.i = w.i),
e as (select k, max_by(issue, i) as issue, max_by(pending, i) as pending from w group by k), s as (select k, min_by(shape, i) filter (where shape is not null) as shape, count(*) filter (where role = 'user') as users, max_by(role, i) as last, max_by(len(ids), i) as calls from m group by k)
select r.k, coalesce(case when s.k is null then 'empty_messages' end, {TOOL_ISSUE}, shape, issue, case when len(pending) > 0 then 'unresolved_tool_call' when users = 0 then 'no_user_message' when last <> 'assistant' then 'final_role_not_assistant' when calls > 0 then 'final_turn_calls_tools' end) as issue
from r join e on r.k = e.k left join s on r.k = s.k""")
def tool_conversation_issues(spark, d):
    return _rows(spark, d).select("k", chat.conversation_issue(F.col("messages"), F.col("tools")).alias("issue"))


MODE = "case k % 4 when 0 then 'structured_json' when 1 then 'table' when 2 then 'code' else 'prose' end"
RENDERED = (
    "case k % 9 when 0 then '{\"a\": [1, 2]}' when 1 then concat('```json', chr(10), '[1, 2]', chr(10), '```') when 2 then concat('| a | b |', chr(10), '|---|:-:|', chr(10), '| 1 | 2 |') when 3 then concat('a | b', chr(10), 'no rule') "
    "when 4 then concat('Run:', chr(10), '```', chr(10), 'x = 1', chr(10), '```') when 5 then '  ' when 6 then '3' when 7 then '{\"a\": ' else null end"
)


@query(rf"""with r as (select o_orderkey as k from orders), s as (select k, {MODE} as mode, trim(coalesce({RENDERED}, '')) as t from r),
j as (select *, case when starts_with(t, '```') then array_to_string(string_split(t, chr(10))[2:-2], chr(10)) else t end as inner_text, string_split(t, chr(10)) as lines from s)
select k, mode, case when t = '' then 'no_final_content' when (mode = 'structured_json' and not (json_valid(inner_text) and json_type(case when json_valid(inner_text) then inner_text end) in ('OBJECT', 'ARRAY')))
 or (mode = 'table' and not (contains(t, '|') and len(list_filter(lines, lambda x: contains(x, '-') and regexp_full_match(x, '[-|: ]+'))) > 0)) or (mode = 'code' and not contains(t, '```')) then 'output_mode_not_satisfied' end as issue from j""")
def output_mode_issues(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).select("k", F.expr(MODE).alias("mode"), F.expr(RENDERED).alias("t"))
    return rows.select("k", "mode", chat.mode_issue(F.col("t"), F.col("mode")).alias("issue"))
