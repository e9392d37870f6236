"""Queries of record contracts, joins of stages, and reports on them, each with its DuckDB SQL.

The driver's tables hold no such records, so they are made from rows of
`orders`, `part` and `events` by expressions (MADE) that both engines read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .functions import contracts as ct
from .functions import text as tx
from .operators import dedup, reports
from .plans import planning
from .queries import FP, KEY, _conversations, _docs, _key, query
from .sources.shared import table

#: k is the row's number.  Expressions that Spark and DuckDB both read.
MADE = {
    "response": {
        "signal": "case k % 4 when 0 then 'arithmetic' when 1 then 'code' when 2 then 'database' else 'factual_restraint' end",
        "prompt": "case k % 4 when 0 then concat('Compute ', k % 40, ' + ', k % 9, case when k % 3 = 0 then '. Reply with only the integer result' else '' end) when 1 then 'Write a Python function that adds two numbers' when 2 then 'Write a SQL query for all orders' else 'Tell me the private number of this person' end",
        "answer": "case k % 7 when 0 then cast(k % 40 + k % 9 as varchar(20)) when 1 then 'def add(a, b): return a + b' when 2 then 'select a from b' when 3 then case when k % 2 = 0 then '' else '  ok' end when 4 then 'I cannot help, it is unavailable' when 5 then '{\"response\": 1}' else case k % 4 when 1 then '```Write a Python function that adds two numbers```' when 2 then 'Write a SQL query for all orders.' else concat('It is about ', k % 40 + k % 9, ' or so') end end",
    },
    "pair": {
        "family": "case k % 9 when 0 then 'grounded_record_fact' when 1 then 'integer_subtraction' when 2 then 'inventory_word_problem' when 3 then 'grounded_answer_only' when 4 then 'exact_token_repeat' when 5 then 'missing_transformation_context' when 6 then 'benign_task_over_refusal' when 7 then 'exact_two_bullets' else 'instruction_rewrite' end",
        "prompt": "case k % 9 when 0 then 'Note: deployment status Green today' when 1 then concat('What is ', k % 50, ' - ', k % 11, '?') when 2 then concat('A room contains ', k % 6, ' boxes with ', k % 8, ' items') when 3 then 'The host belongs to region north now' when 4 then concat('Repeat ab exactly ', k % 3 + 1, ' times') when 6 then concat('Sort in ascending order: ', k % 5, ', ', k % 3, ', 12.') else 'Please rewrite this instruction' end",
        "chosen": "case k % 4 when 0 then case k % 9 when 0 then 'green' when 3 then ' North ' when 4 then 'ab,ab' when 5 then 'Which text?' when 7 then '- a' else cast(k % 50 - k % 11 as varchar(20)) end when 1 then cast((k % 6) * (k % 8) as varchar(20)) when 2 then 'one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen' else case when k % 5 = 0 then '' else 'Please rewrite this instruction' end end",
        "rejected": "case k % 5 when 0 then 'Green' when 1 then cast(k % 50 - k % 11 as varchar(20)) when 2 then 'ab,ab' when 3 then 'Please *rewrite* this instruction' else 'one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen  Nineteen' end",
    },
    "mcq": {
        "a": "case when k % 13 = 0 then ' ' else concat('Answer ', k % 3) end",
        "b": "concat('answer  ', k % 5)",
        "c": "concat('Choice ', k % 7)",
        "d": "case when k % 11 = 0 then null else 'None of these' end",
        "idx": "case when k % 17 = 0 then null else k % 6 - 1 end",
        "why": "case when k % 9 = 0 then ' ' else 'because' end",
        "answer": "concat('choice ', k % 7)",
    },
}


def _sql(kind: str) -> str:
    return "m as (select o_orderkey as k, " + ", ".join(f"{e} as {n}" for n, e in MADE[kind].items()) + " from orders)"


def _made(spark, d, kind: str) -> DataFrame:
    # Keys are spread over all cores, however few parts their file has: the work on a row is many times its reading.
    keys = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).repartition(2 * spark.sparkContext.defaultParallelism, "k")
    return keys.select("k", *[F.expr(e).alias(n) for n, e in MADE[kind].items()])


TRIM = r"regexp_replace(coalesce({0}, ''), '^\s+|\s+$', '', 'g')"
JOINED = "array_to_string(list_filter([{0}], lambda x: x is not null), ',')"
SEED = "trim(" + KEY.format("coalesce({0}, '')") + ", ' .!?;:')"
RESULT = r"""case when regexp_matches(prompt, '-?\d+\s*\+\s*-?\d+') then cast(regexp_extract(prompt, '(-?\d+)\s*\+\s*(-?\d+)', 1) as bigint) + cast(regexp_extract(prompt, '(-?\d+)\s*\+\s*(-?\d+)', 2) as bigint) end"""
COPY = "({0} <> '' and {1} <> '' and ({0} = {1} or (length({0}) >= 24 and starts_with({1}, {0}) and length(trim(substr({1}, length({0}) + 1))) < greatest(12, length({0}) // 5))))"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


RESPONSES = rf"""{_sql('response')}, t as (select *, {TRIM.format('answer')} as t, {RESULT} as want from m), s as (select *, lower(t) as low, {SEED.format('prompt')} as sp, {SEED.format('t')} as st, regexp_matches(t, '^[+-]?\d+$') as whole, contains(lower(prompt), 'only the integer result') as only_ from t),
issued as (select k, signal, {JOINED.format(rf'''case when t = '' then 'empty_response' end, case when t <> '' and length(t) < 3 and not (signal = 'arithmetic' and whole) then 'too_short_response' end,
 case when {COPY.format('sp', 'st')} then 'repeats_prompt' end, case when t <> '' and (regexp_matches(t, {lit(ct.RESPONSE_FIELDS)}) or t[1] in ('{{', '[')) then 'schema_leakage' end,
 case when signal <> 'factual_restraint' and regexp_matches(low, {lit(ct.REFUSAL)}) then 'unexpected_refusal' end,
 case when signal = 'arithmetic' and t <> '' and want is not null and only_ and not whole then 'arithmetic_non_integer_answer' end,
 case when signal = 'arithmetic' and t <> '' and want is not null and not (only_ and not whole) and not list_contains(regexp_extract_all(t, '[+-]?\d+'), cast(want as varchar)) then 'arithmetic_wrong_answer' end,
 case when signal = 'code' and contains(t, '```') then 'markdown_fence' end,
 case when signal = 'code' and t <> '' and contains(lower(prompt), 'python function') and not regexp_matches(t, '\bdef\s+\w+\s*\(|\blambda\b') then 'code_missing_function_definition' end,
 case when signal = 'database' and t <> '' and contains(lower(prompt), 'sql query') and not (contains(low, 'select') and contains(low, 'from')) then 'database_missing_sql_query' end,
 case when signal = 'factual_restraint' and t <> '' and not regexp_matches(low, {lit(ct.RESTRAINT)}) then 'factual_restraint_missing_restraint' end''')} as issues,
 coalesce(signal = 'arithmetic' and t = cast(want as varchar), false) as machine_verified from s)"""


def _responses(spark, d) -> DataFrame:
    m = _made(spark, d, "response")
    args = F.col("signal"), F.col("prompt"), F.col("answer")
    return m.select("k", "signal", F.array_join(ct.response(*args), ",").alias("issues"), ct.machine_verified(*args).alias("machine_verified"))


@query(f"with {RESPONSES} select * from issued")
def response_quality_by_signal(spark, d):
    return _responses(spark, d)


@query(f"with {RESPONSES} select signal, reason, count(*) as n from (select signal, unnest(string_split(issues, ',')) as reason from issued where issues <> '') group by all")
def rejection_reason_rollup(spark, d):
    return reports.reason_counts(_responses(spark, d).select("signal", F.filter(F.split("issues", ","), lambda x: x != "").alias("issues")), "issues", "signal")


PAIR_TEXT = r"trim(regexp_replace(regexp_replace(lower(coalesce({0}, '')), '[`*_#>\-]+', ' ', 'g'), '\s+', ' ', 'g'))"


@query(rf"""with {_sql('pair')}, t as (select *, {PAIR_TEXT.format('chosen')} as c, {PAIR_TEXT.format('rejected')} as r, {PAIR_TEXT.format('prompt')} as p, {TRIM.format('chosen')} as tc, {TRIM.format('rejected')} as tr from m),
w as (select *, list_distinct(regexp_extract_all(c, '[a-z0-9]+')) as a, list_distinct(regexp_extract_all(r, '[a-z0-9]+')) as b from t),
x as (select *, len(list_intersect(a, b)) as i, len(a) + len(b) - len(list_intersect(a, b)) as u from w)
select k, {JOINED.format(rf'''case when tc = '' or tr = '' then 'empty_pair_text' end,
 case when (length(tc) < 2 and not regexp_matches(tc, '^[+-]?\d+$')) or (length(tr) < 2 and not regexp_matches(tr, '^[+-]?\d+$')) then 'too_short_pair_text' end,
 case when c <> '' and r <> '' and c = r then 'identical_pair' end,
 case when c <> '' and r <> '' and c <> r and u >= 6 and i / u >= 0.92 and abs(length(c) - length(r)) <= 0.08 * greatest(length(c), length(r)) then 'non_contrastive_pair' end,
 case when {COPY.format('p', 'c')} or {COPY.format('p', 'r')} then 'prompt_copy_pair' end,
 case when regexp_matches(tc, {lit(ct.PAIR_FIELDS)}) or regexp_matches(tr, {lit(ct.PAIR_FIELDS)}) or tc[1] in ('{{', '[') or tr[1] in ('{{', '[') then 'schema_leakage' end''')} as issues from x""")
def pair_quality_full(spark, d):
    return ct.with_pair_issues(_made(spark, d, "pair")).select("k", F.array_join("issues", ",").alias("issues"))


@query(rf"""with {_sql('pair')}, t as (select *, {TRIM.format('chosen')} as c, {TRIM.format('rejected')} as r, case when family = 'integer_subtraction' then k % 50 - k % 11 when family = 'inventory_word_problem' then (k % 6) * (k % 8) end as num from m),
s as (select *, case when regexp_matches(c, '^[+-]?\d+$') then cast(c as bigint) end as cn, case when regexp_matches(r, '^[+-]?\d+$') then cast(r as bigint) end as rn,
 case when family = 'exact_token_repeat' then 'ab' || repeat(',ab', cast(k % 3 as int)) end as rep, case when family = 'benign_task_over_refusal' then least(k % 5, k % 3) || ', ' || greatest(k % 5, k % 3) || ', 12' end as ord,
 list_filter(list_transform(string_split(c, chr(10)), lambda l: trim(l)), lambda l: l <> '') as lines, len(list_filter(string_split_regex(c, '\s+'), lambda l: l <> '')) as words from t)
select k, family, {JOINED.format('''case when family = 'grounded_record_fact' and lower(c) <> 'green' then 'chosen_wrong_grounded_fact' end, case when family = 'grounded_record_fact' and lower(r) = 'green' then 'rejected_matches_grounded_fact' end,
 case when num is not null and cn is distinct from num then 'chosen_wrong_numeric_answer' end, case when num is not null and rn is not distinct from num then 'rejected_matches_numeric_answer' end,
 case when family = 'grounded_answer_only' and lower(c) <> 'north' then 'chosen_answer_only_violation' end, case when family = 'grounded_answer_only' and lower(r) = 'north' then 'rejected_not_answer_only_violation' end,
 case when c <> rep then 'chosen_exact_format_violation' end, case when r = rep then 'rejected_matches_exact_format' end,
 case when family = 'missing_transformation_context' and not ends_with(c, '?') then 'chosen_missing_clarifying_question' end,
 case when c <> ord then 'chosen_incorrect_benign_sort' end, case when r = ord then 'rejected_not_over_refusal' end,
 case when family = 'exact_two_bullets' and (len(lines) <> 2 or len(list_filter(lines, lambda l: not starts_with(l, '- '))) > 0) then 'chosen_two_bullet_violation' end,
 case when family = 'instruction_rewrite' and words > 18 then 'chosen_rewrite_too_verbose' end''')} as issues from s""")
def pair_contracts(spark, d):
    m = _made(spark, d, "pair")
    return m.select("k", "family", F.array_join(ct.pair_contract(F.col("family"), F.col("prompt"), F.col("chosen"), F.col("rejected")), ",").alias("issues"))


NORM = "list_transform([a, b, c, d], lambda x: " + KEY.format("x") + ")"


@query(rf"""with {_sql('mcq')}, n as (select *, {NORM} as ch from m)
select k, {JOINED.format('''case when len(list_filter(ch, lambda x: coalesce(x, '') = '')) > 0 then 'empty_choice' end, case when len(list_distinct(ch)) + case when list_position(ch, null) is not null or len(list_filter(ch, lambda x: x is null)) > 0 then 1 else 0 end <> 4 then 'duplicate_choices' end,
 case when idx is null then 'bad_correct_index_type' end, case when idx < 0 or idx > 3 then 'correct_index_out_of_bounds' end, case when trim(why) = '' then 'empty_explanation' end''')} as issues,
 case when len(list_filter(ch, lambda x: x = answer)) = 1 then cast(list_position(ch, answer) - 1 as int) end as corrected from n""")
def mcq_issues(spark, d):
    m = _made(spark, d, "mcq").withColumn("choices", F.array("a", "b", "c", "d"))
    return m.select("k", F.array_join(ct.mcq(F.col("choices"), F.col("idx"), F.col("why")), ",").alias("issues"), ct.corrected_index(F.col("choices"), F.col("answer")).alias("corrected"))


@query("""with m as (select event_id, case when event_id % 3 = 0 then props when event_id % 3 = 1 then '{"k": 1, "z": 2, "b": 3}' else '{"x": 1}' end as row from events), e as (select event_id, json_keys(row) as ks from m)
select event_id, array_to_string(list_filter([case when len(list_filter(ks, lambda x: x not in ('k', 'b'))) > 0 then 'unexpected_fields:' || array_to_string(list_sort(list_filter(ks, lambda x: x not in ('k', 'b'))), ',') end,
 case when not (list_contains(ks, 'k') and list_contains(ks, 'b')) then 'missing_fields:' || array_to_string(list_filter(['b', 'k'], lambda x: not list_contains(ks, x)), ',') end], lambda x: x is not null), ';') as issues from e""")
def exact_key_issues(spark, d):
    row = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.lit('{"k": 1, "z": 2, "b": 3}')).otherwise(F.lit('{"x": 1}'))
    return table(spark, d, "events").select("event_id", F.array_join(ct.exact_keys(F.json_object_keys(row), ("k", "b")), ";").alias("issues"))


LIMITS = {"min_words": 20, "max_words": 150, "exact_nonempty_lines": 1, "min_list_items": 0, "max_list_items": 0, "exact_list_items": 1, "required_terms": ["the"], "forbidden_terms": ["und"], "required_headings": ["Summary:"], "exact_json_keys": ["a", "b"]}


@query(r"""with t as (select conv_id, turn, case when conv_id % 7 = 0 then '{"b": 1, "a": 2}' when conv_id % 7 = 1 then '## Summary:' || chr(10) || '- one item' else coalesce(text, '') end as t from conversations where role = 'assistant'),
o as (select *, len(regexp_extract_all(t, '[A-Za-z0-9]+(?:[''-][A-Za-z0-9]+)*')) as w, list_filter(list_transform(string_split(t, chr(10)), lambda l: trim(l)), lambda l: l <> '') as ls,
 len(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '^\s*(?:[-*+]\s+|\d+[.)]\s+)'))) as li, case when json_valid(t) and json_type(t) = 'OBJECT' then list_sort(json_keys(t)) end as ks from t),
c as (select conv_id, turn, [{'c': 'min_words', 'ok': w >= 20}, {'c': 'max_words', 'ok': w <= 150}, {'c': 'exact_nonempty_lines', 'ok': len(ls) = 1}, {'c': 'min_list_items', 'ok': true}, {'c': 'max_list_items', 'ok': li <= 0}, {'c': 'exact_list_items', 'ok': li = 1},
 {'c': 'required_term', 'ok': contains(lower(t), 'the')}, {'c': 'forbidden_term', 'ok': not regexp_matches(lower(t), '(^|\W)und(\W|$)')},
 {'c': 'required_heading', 'ok': len(list_filter(ls, lambda l: rtrim(lower(trim(regexp_replace(l, '^#{1,6}\s*', ''))), ':') = 'summary')) > 0}, {'c': 'exact_json_keys', 'ok': coalesce(ks = ['a', 'b'], false)}] as cs from o)
select conv_id, turn, u.c as constraint_name, u.ok as passed from (select conv_id, turn, unnest(cs) as u from c)""")
def output_constraint_checks(spark, d):
    t = F.when(F.col("conv_id") % 7 == 0, '{"b": 1, "a": 2}').when(F.col("conv_id") % 7 == 1, "## Summary:\n- one item").otherwise(F.col("text"))
    rows = table(spark, d, "conversations").where("role = 'assistant'").select("conv_id", "turn", F.explode(ct.constraint_checks(t, LIMITS)).alias("c"))
    return rows.select("conv_id", "turn", F.col("c.constraint").alias("constraint_name"), F.col("c.passed").alias("passed"))


@query(f"select doc_id, {JOINED.format('''case when coalesce(trim(text), '') = '' then 'empty_safe_answer' end, case when starts_with(lower(ltrim(text)), 'do not ') then 'factual_restraint_policy_instruction_voice' end''')} as issues from (select doc_id, case when doc_id % 5 = 0 then 'Do not ' || text when doc_id % 7 = 0 then ' ' else text end as text from documents)")
def restraint_issues(spark, d):
    t = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("Do not "), "text")).when(F.col("doc_id") % 7 == 0, " ").otherwise(F.col("text"))
    return _docs(spark, d).select("doc_id", F.array_join(ct.safe_answer(t), ",").alias("issues"))


@query("""with r as (select doc_id as id from documents where doc_id % 3 <> 0), o as (select doc_id as id, count(*) as n from (select doc_id from labels union all select doc_id from labels where doc_id % 5 = 0) group by 1)
select coalesce(r.id, o.id) as id, case when o.id is null then 'missing' when r.id is null then 'unexpected' when n > 1 then 'duplicate' else 'matched' end as status from r full join o on r.id = o.id""")
def teacher_output_join(spark, d):
    records = _docs(spark, d).where("doc_id % 3 <> 0").select(F.col("doc_id").alias("id"))
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("id"))
    return reports.coverage(records, labels.union(labels.where("id % 5 = 0")), "id")


@query("""with s as (select doc_id, case when doc_id % 13 = 0 then 'xx' else lang end as lang from documents where doc_id % 11 <> 0) select coalesce(d.doc_id, s.doc_id) as doc_id,
case when s.doc_id is null then 'missing_spec' when s.lang is distinct from d.lang then 'lang_mismatch' end as issue from documents d full join s on d.doc_id = s.doc_id where s.doc_id is null or s.lang is distinct from d.lang""")
def spec_mismatch(spark, d):
    rows = _docs(spark, d).select("doc_id", "lang")
    specs = rows.where("doc_id % 11 <> 0").withColumn("lang", F.when(F.col("doc_id") % 13 == 0, "xx").otherwise(F.col("lang")))
    return reports.field_mismatches(rows, specs, "doc_id", ["lang"])


@query("""with c as (select conv_id, text, row_number() over (partition by conv_id order by turn, text) as i from conversations where role = 'user'), r as (select conv_id, text, row_number() over (partition by conv_id order by turn, text) as i from conversations where role = 'assistant')
select coalesce(c.conv_id, r.conv_id) as conv_id, cast(coalesce(c.i, r.i) as bigint) as i, c.text as chosen, r.text as rejected, c.conv_id is null or r.conv_id is null as unpaired from c full join r on c.conv_id = r.conv_id and c.i = r.i""")
def stage_zip(spark, d):
    c = table(spark, d, "conversations")
    return dedup.zipped(c.where("role = 'user'"), c.where("role = 'assistant'"), "conv_id", ["turn", "text"], "text")


@query(f"""with k as (select {FP.format('text')} as h from documents), need as (select h from k group by h having count(*) > 1), dec as (select distinct {FP.format('text')} as h, case when doc_id % 2 = 0 then 'keep' else 'reject' end as decision from documents where doc_id % 4 = 0 or doc_id % 9 = 0),
one as (select h, min(decision) as decision, count(*) as n from dec group by h)
select coalesce(need.h, one.h) as member, case when one.h is null then 'missing' when need.h is null then 'unexpected' when n > 1 then 'duplicate' else 'matched' end as status, coalesce(one.decision, 'keep') as decision from need full join one on need.h = one.h""")
def adjudication_coverage(spark, d):
    docs = _docs(spark, d).select("doc_id", tx.fingerprint(F.col("text")).alias("member"))
    need = docs.groupBy("member").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("member")
    decided = docs.where("doc_id % 4 = 0 or doc_id % 9 = 0").select("member", F.when(F.col("doc_id") % 2 == 0, "keep").otherwise("reject").alias("decision")).distinct()
    first = decided.groupBy("member").agg(F.min("decision").alias("decision"))
    return reports.coverage(need, decided.select("member"), "member").join(first, "member", "left").withColumn("decision", F.coalesce("decision", F.lit("keep")))


@query(f"select count(*) as total, count(distinct {FP.format('text')}) as unique_count, count(distinct {FP.format('text')}) >= 1500 and count(distinct {FP.format('text')}) / count(*) >= 0.75 as passed from documents where text is not null")
def prompt_uniqueness_gate(spark, d):
    u = reports.uniqueness(_docs(spark, d).where("text is not null"), tx.fingerprint(F.col("text")))
    return u.select("total", "unique_count", ((F.col("unique_count") >= 1500) & (F.col("unique_count") / F.col("total") >= 0.75)).alias("passed"))


@query("select source, count(*) filter (where doc_id % 3 = 0) as raw, count(*) filter (where doc_id % 3 = 1) as validated, count(*) filter (where doc_id % 3 = 2) as deduped from documents group by source")
def stage_counts(spark, d):
    stage = F.element_at(F.array(*map(F.lit, ("raw", "validated", "deduped"))), (F.col("doc_id") % 3 + 1).cast("int"))
    counts = _docs(spark, d).select("source", stage.alias("stage")).groupBy("source").pivot("stage", ["raw", "validated", "deduped"]).count()
    return counts.na.fill(0, ["raw", "validated", "deduped"])


@query("with w as (select event_type, user_id, max(event_id) as peak, count(*) as n, sum(value) as v from events group by all) select event_type, cast(sum(peak) as bigint) as counter, cast(sum(n) as bigint) as n, round(sum(v), 4) as total from w group by event_type")
def telemetry_two_level(spark, d):
    each = table(spark, d, "events").groupBy("event_type", "user_id").agg(F.max("event_id").alias("peak"), F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    return each.groupBy("event_type").agg(F.sum("peak").alias("counter"), F.sum("n").alias("n"), F.round(F.sum("v"), 4).alias("total"))


@query("select lang, source, grouping_id(lang, source) as level, count(*) as n, count(distinct text) as texts, cast(coalesce(sum(length(text)), 0) as bigint) as chars from documents group by grouping sets ((), (lang), (source), (lang, source))")
def coverage_sets(spark, d):
    # Of a text only its hash and length are needed: whole texts are not sent once for each set.
    rows = _docs(spark, d).select("lang", "source", F.sha2(F.col("text").cast("binary"), 256).alias("h"), F.length("text").alias("chars"))
    sets = rows.groupingSets([[], ["lang"], ["source"], ["lang", "source"]], "lang", "source")
    return sets.agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"), F.count_distinct("h").alias("texts"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"))


@query("with r as (select doc_id // 256 as part, doc_id, sha256(doc_id || ':' || coalesce(text, '')) as h from documents), p as (select part, sha256(string_agg(h, '' order by doc_id, h)) as h from r group by part) select sha256(string_agg(h, '' order by part)) as fingerprint, count(*) as parts from p")
def dataset_fingerprint(spark, d):
    return reports.ordered_fingerprint(_docs(spark, d), "doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.coalesce("text", F.lit(""))), 256)


@query("select source, doc_id from (select source, doc_id, row_number() over (partition by source order by doc_id) as r from documents) where r <= 12")
def truncate_to_target(spark, d):
    return reports.first_by_group(_docs(spark, d).select("source", "doc_id"), "source", "doc_id", 12)


@query(f"with e as (select source, {FP.format('text')} as h, count(*) as n from documents group by all) select h as cluster, cast(sum(n) as bigint) as occurrences from e group by h having count(*) > 1 order by occurrences desc, h limit 20")
def top_overlaps(spark, d):
    each = _docs(spark, d).groupBy(tx.fingerprint(F.col("text")).alias("cluster"), "source").agg(F.count(F.lit(1)).alias("n"))
    found = each.groupBy("cluster").agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("occurrences")).where("sources > 1")
    return found.select("cluster", "occurrences").orderBy(F.desc("occurrences"), "cluster").limit(20)


@query(f"with k as (select {KEY.format('text')} as t, count(*) as n from documents where text is not null group by 1 having count(*) > 1) select substr(t, 1, 160) as example, n, sha256(t) as cluster from k order by n desc, sha256(t) limit 10")
def duplicate_examples(spark, d):
    """By count, then fingerprint; ties are not ordered by whole texts."""
    n = _docs(spark, d).where("text is not null").groupBy(_key().alias("t")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return n.select(F.substring("t", 1, 160).alias("example"), "n", F.sha2(F.col("t").cast("binary"), 256).alias("cluster")).orderBy(F.desc("n"), "cluster").limit(10)


@query("with f as (select source as dataset, doc_id % 3 <> 0 as is_shard, doc_id from documents), g as (select *, bool_and(is_shard) over (partition by dataset, doc_id // 30) as no_final from f) select dataset, doc_id from g where no_final or not is_shard")
def final_over_shards(spark, d):
    files = _docs(spark, d).select(F.col("source").alias("dataset"), F.floor(F.col("doc_id") / 30).alias("name"), (F.col("doc_id") % 3 != 0).alias("is_shard"), "doc_id")
    return planning.prefer_final(files, ["dataset", "name"], "is_shard").select("dataset", "doc_id")


GATE = f"""with p as (select conv_id, {TRIM.format("string_agg(text, chr(30) order by turn, text) filter (where role = 'user')")} as prompt, string_agg(text, chr(30) order by turn, role, text) as triple from conversations group by conv_id)
select 'duplicate_prompts' as code, cast(count(prompt) - count(distinct prompt) as bigint) as n from p union all select 'duplicate_triples', cast(count(triple) - count(distinct triple) as bigint) from p union all select 'empty_prompts', count(*) filter (where coalesce(prompt, '') = '') from p"""


@query(f"select * from ({GATE}) where n > 0")
def preference_gate(spark, d):
    rows = _conversations(spark, d)
    prompt = F.regexp_replace(F.coalesce(F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "user"), lambda t: t["text"]), "\x1e"), F.lit("")), r"^\s+|\s+$", "")
    p = rows.select(prompt.alias("prompt"), F.array_join(F.transform("turns", lambda t: t["text"]), "\x1e").alias("triple"))
    n = lambda c: reports.uniqueness(p, F.sha2(F.col(c).cast("binary"), 256)).select(F.lit(f"duplicate_{c}s").alias("code"), F.col("duplicate_count").alias("n"))
    empty = p.agg(F.count_if(F.col("prompt") == "").alias("n")).select(F.lit("empty_prompts").alias("code"), "n")
    return n("prompt").unionByName(n("triple")).unionByName(empty).where("n > 0")


@query(r"select doc_id, sha256(" + PAIR_TEXT.format("text") + ") as pair_key, sha256(" + SEED.format("text") + r") as seed_key, sha256(regexp_replace(" + KEY.format("coalesce(text, '')") + r", '[0-9]+(?:[.,][0-9]+)*', '<num>', 'g')) as masked_key from documents")
def text_keys(spark, d):
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return _docs(spark, d).select("doc_id", sha(ct.pair_text(F.col("text"))).alias("pair_key"), sha(ct.seed_key(F.col("text"))).alias("seed_key"), sha(tx.masked_numbers(F.coalesce("text", F.lit("")))).alias("masked_key"))


@query(r"""with m as (select p_partkey, case p_partkey % 3 when 0 then 'def f():\n\treturn 1' when 1 then 'a' || chr(10) || '\n' else p_name end as c from part) select p_partkey, case when not contains(c, chr(10)) and contains(c, '\n') then replace(replace(c, '\n', chr(10)), '\t', chr(9)) else c end as code from m""")
def code_unescape(spark, d):
    c = F.when(F.col("p_partkey") % 3 == 0, "def f():\\n\\treturn 1").when(F.col("p_partkey") % 3 == 1, "a\n\\n").otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", ct.unescaped_code(c).alias("code"))


@query("with c as (select source, count(*) as capacity, count(*) filter (where quality = 1) as ok, count(quality) as seen from documents left join labels using (doc_id) group by source) select source, capacity, round(ok / greatest(seen, 1), 6) as yield_rate, cast(floor(capacity * (ok / greatest(seen, 1))) as bigint) as projected, cast(floor(capacity * (ok / greatest(seen, 1))) as bigint) - 20 as headroom from c")
def yield_projection(spark, d):
    rows = _docs(spark, d).select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left")
    c = rows.groupBy("source").agg(F.count(F.lit(1)).alias("capacity"), F.count_if(F.col("quality") == 1).alias("ok"), F.count("quality").alias("seen"))
    return planning.yields(c, "source", 20)


@query("select p_partkey, ['short', 'plain', 'formal', 'terse'][cast(('0x' || substr(md5('profile:' || p_partkey), 1, 8))::bigint % 4 as int) + 1] as profile from part")
def profile_choice(spark, d):
    return table(spark, d, "part").select("p_partkey", planning.choice(F.col("p_partkey"), "profile:", ("short", "plain", "formal", "terse")).alias("profile"))


def _first_of_union(spark, d) -> DataFrame:
    rows = _docs(spark, d)
    parts = [rows.where(F.col("doc_id") % 2 == k).select((F.col("doc_id") + k * 1_000_000).alias("seq"), F.lit(s).alias("signal"), "text") for k, s in enumerate(("even", "odd"))]
    return dedup.first_wins(parts[0].unionByName(parts[1]), _key(), "seq")


@query(f"with u as (select doc_id + doc_id % 2 * 1000000 as seq, case doc_id % 2 when 0 then 'even' else 'odd' end as signal, {FP.format('text')} as h from documents), f as (select *, min(seq) over (partition by h) as m from u) select signal, count(*) filter (where h is null or m = seq) as accepted, count(*) filter (where h is not null and m <> seq) as rejected from f group by signal")
def signal_union_dedup(spark, d):
    return _first_of_union(spark, d).groupBy("signal").agg(F.count_if(F.col("status") == "accepted").alias("accepted"), F.count_if(F.col("status") == "duplicate").alias("rejected"))
