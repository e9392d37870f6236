"""Queries of near-duplicate templates, records that carry an expression, canonical keys and renderings, each with its DuckDB SQL.

Records are made from columns of `lineitem`, texts are those of `documents`,
`conversations` and `events`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import arithmetic as ar
from .functions import canonical as cn
from .functions import decisions as dc
from .functions import fidelity as fd
from .functions import templates as tp
from .functions import text as tx
from .operators import minhash
from .queries import FP, KEY, _conversations, _docs, query
from .sources.shared import discard, materialise, table

TEMPLATE = KEY.format("""regexp_replace(regexp_replace(coalesce(text, ''), '"[^"]*"', '<quoted>', 'g'), '[0-9]+(?:[.,][0-9]+)*', '<num>', 'g')""")
NEAR = f"""with recursive t as (select source, {TEMPLATE} as t, count(*) as n, min(doc_id) as id from documents group by 1, 2),
w as (select *, regexp_extract_all(t, '[a-z0-9]+') as w from t),
s as (select distinct id, source, array_to_string(w[i:i + 4], ' ') as g from w, unnest(range(1, case when len(w) = 0 then 0 else greatest(len(w) - 4, 1) end + 1)) as x(i)),
c as (select id, count(*) as c from s group by id),
p as (select a.id as u, b.id as v, count(*) as k from s a join s b on a.g = b.g and a.source is not distinct from b.source and a.id < b.id group by all),
e as (select u, v from p join c x on u = x.id join c y on v = y.id where k / (x.c + y.c - k) >= 0.8),
b as (select u, v from e union select v, u from e), r as (select u, v from b union select r.u, b.v from r join b on r.v = b.u),
low as (select u, min(v) as low from r group by u), m as (select source, id, n, least(id, coalesce(low, id)) as cluster from t left join low on u = id)"""


def _templates(spark, d) -> DataFrame:
    """(source, id, n, s): the distinct templates of each source, how many texts have them, and their shingles."""
    t = _docs(spark, d).select("doc_id", "source", tx.template(F.coalesce("text", F.lit(""))).alias("t"))
    # The template of a text is made once; its words go on as hashes, of which only one text of each template is looked at further.
    key = t.withColumns({"h": F.sha2(F.col("t").cast("binary"), 256), "w": tx.tokens(F.col("t"))})
    key = materialise(key.select("doc_id", "source", "h", F.transform("w", lambda w: F.xxhash64(w)).alias("w")), "template-words")
    each = key.groupBy("source", "h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("id"))
    texts = each.join(key.select(F.col("doc_id").alias("id"), "w"), "id")
    rows = materialise(texts.select("source", "id", "n", tx.hashed_shingles(F.col("w"), 5).alias("s")), "templates")
    discard(key)
    return rows


def _clustered(spark, d) -> DataFrame:
    rows = _templates(spark, d)
    near = minhash.near_clusters(rows, "id", "s", 0.80, "source")
    return rows.select("source", "id", "n").join(near, "id")


@query(f"{NEAR} select source, id, n, cluster from m")
def near_template_members(spark, d):
    return _clustered(spark, d).select("source", "id", "n", "cluster")


@query(f"""{NEAR}, k as (select source, cluster, sum(n) as rows_, count(*) as texts, coalesce(sum(n) filter (n > 1), 0) as copied from m group by all)
select source, cast(sum(rows_) as bigint) as n_rows, cast(sum(texts) as bigint) as n_templates, cast(sum(copied) as bigint) as exact_repeated_rows, count(*) filter (rows_ > 1) as near_clusters,
 cast(coalesce(sum(rows_) filter (rows_ > 1), 0) as bigint) as near_rows, cast(coalesce(max(rows_) filter (rows_ > 1), 0) as bigint) as largest_cluster,
 round(sum(texts) / sum(rows_), 6) as unique_ratio, round(coalesce(sum(rows_) filter (rows_ > 1), 0) / sum(rows_), 6) as near_ratio from k group by source""")
def near_template_report(spark, d):
    return minhash.cluster_summary(_clustered(spark, d), "source")


#: Values of records made from lineitem: Spark's and DuckDB's expressions of the same columns.
LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_tax, l_discount, l_linestatus"
P, S, Q = "cast(l_partkey as bigint)", "cast(l_suppkey as bigint)", "cast(l_quantity as bigint)"
EXPRESSION = f"""case l_linenumber when 1 then concat({Q}, ' + ', {P}, ' * ', {S}) when 2 then concat('(', {P}, ' - ', {S}, ') / ', {Q}) when 3 then concat('-', {P}, ' * (', {S}, '+', {Q}, ') - -', {Q})
 when 4 then concat({P}, ' / ', {Q}, ' / ', {S}) when 5 then case when l_suppkey % 2 = 0 then concat('2 ** ', {Q}) else concat('((', {P}, ') - (', {S}, ')') end
 when 6 then concat({P}, '-', {S}, '-(', {Q}, '-', {S}, ')*3') else concat({P}, '_000 * (', {S}, ' + 1) / 1_000') end"""
#: (numerator, denominator) by number of the line; a null denominator is no expression, and 0 divides by nothing.
VALUE = f"""case l_linenumber when 1 then {Q} + {P} * {S} when 2 then {P} - {S} when 3 then -{P} * ({S} + {Q}) + {Q} when 4 then {P} when 6 then {P} - {S} - ({Q} - {S}) * 3 else {P} * ({S} + 1) end as num,
 case l_linenumber when 2 then {Q} when 4 then {Q} * {S} when 5 then null else 1 end as den"""
MADE = f"""v as (select {LINE}, {EXPRESSION} as expression, {VALUE} from lineitem),
m as (select *, coalesce(num % nullif(den, 0) = 0, false) as whole, case when num % nullif(den, 0) = 0 then num // nullif(den, 0) else num end as want from v),
a as (select *, case when l_tax = 0.03 then want + 1 when l_tax = 0.05 then null else want end as said from m)"""
JOINED = "array_to_string(list_filter([{0}], lambda x: x is not null), ',')"
VERIFIED = """case when den is null or den = 0 then '{0}_invalid_verification_expression' end, case when den is not null and den <> 0 and not whole then '{0}_non_integer_verified_answer' end, case when said is null then '{0}_bad_verification_answer' end"""


def _lines(spark, d) -> DataFrame:
    """(LINE, expression, want, said): want is the value where it is whole, else any number."""
    made = table(spark, d, "lineitem").selectExpr(*LINE.split(", "), f"{EXPRESSION} as expression", *[f"{x.strip()}" for x in _split(VALUE)])
    whole = F.coalesce((F.col("den") != 0) & (F.try_mod(F.col("num"), F.col("den")) == 0), F.lit(False))
    want = F.when(whole, F.expr("num div nullif(den, 0)")).otherwise(F.col("num"))
    return made.withColumn("want", want).withColumn("said", F.when(F.col("l_tax") == 0.03, F.col("want") + 1).when(F.col("l_tax") == 0.05, None).otherwise(F.col("want")))


def _split(two: str) -> list[str]:
    at = two.index(" as num,") + len(" as num")
    return [two[:at], two[at + 1 :]]


ANSWER = "case when l_linestatus = 'F' then cast({0} as varchar(30)) else concat('about ', {0}) end"


@query(f"""with {MADE} select {LINE.replace(', l_tax, l_discount, l_linestatus', '')}, case when den is null or den = 0 then null when whole then cast(want as varchar) else 'fraction' end as value,
 {JOINED.format("case when l_discount = 0.02 then 'bad_steps' when l_discount = 0.04 then 'arithmetic_meta_commentary' end, " + VERIFIED.format('arithmetic') + ''',
 case when l_linestatus <> 'F' then 'arithmetic_bad_answer' end, case when whole and said <> want then 'arithmetic_verification_answer_mismatch' end, case when l_linestatus = 'F' and said <> want then 'arithmetic_answer_mismatch' end''')} as issues from a""")
def arithmetic_records(spark, d):
    rows = _lines(spark, d).withColumn("answer", F.expr(ANSWER.format("want")))
    parts = ar.arithmetic_parts(F.col("answer"), F.col("expression"), F.col("said").cast("string"))
    rows = rows.withColumns(parts)
    steps = F.when(F.col("l_discount") == 0.02, F.array(F.lit("add"), F.lit(" "))).when(F.col("l_discount") == 0.04, F.array(F.lit("It is"), F.lit("Ambiguous here"))).otherwise(F.array(F.lit("compute"), F.col("expression")))
    issues = ar.arithmetic_record(F.lit("What is it?"), steps, F.col("answer"), F.col("expression"), F.col("said").cast("string"), {k: F.col(k) for k in parts})
    value = F.col("_value")
    shown = F.when(value.isNotNull(), F.when(value["d"] == 1, value["n"].cast("string")).otherwise("fraction"))
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", shown.alias("value"), F.array_join(issues, ",").alias("issues"))


CHOICES = "case when l_discount = 0.01 then 'none' else cast(want + 1 as varchar(30)) end", "concat(' ', want)", "cast(want - 2 as varchar(30))", "case when l_discount = 0.03 then concat('+', abs(want)) when l_discount = 0.05 then cast(want as varchar(30)) when l_discount = 0.07 then ' ' else cast(want + 10 as varchar(30)) end"
WHY = "case l_suppkey % 4 when 0 then concat('So it is ', {0}, '.') when 1 then concat('It is ', {0}, '1 or so') when 2 then concat('There is an error in  the question: ', {0}) else '' end"


@query(f"""with {MADE}, c as (select *, [{', '.join(CHOICES)}] as ch, {WHY.format('want')} as why from a), n as (select *, l_discount <> 0.07 as full_, l_discount not in (0.01, 0.07) as numeric_,
 (case when want + 1 = said then 1 else 0 end) + (case when want = said then 1 else 0 end) + (case when l_discount = 0.05 and want = said then 1 else 0 end) + (case when l_discount = 0.03 and abs(want) = said then 1 else 0 end) + (case when want - 2 = said then 1 else 0 end) + (case when l_discount not in (0.03, 0.05) and want + 10 = said then 1 else 0 end) as hits from c)
select {LINE.replace(', l_tax, l_discount, l_linestatus', '')}, {JOINED.format("case when not full_ then 'empty_choice' when l_discount = 0.05 then 'duplicate_choices' end, case when why = '' then 'empty_explanation' end, " + VERIFIED.format('mcq') + ''',
 case when whole and said <> want then 'mcq_verification_answer_mismatch' end, case when full_ and not numeric_ then 'mcq_non_integer_choice' end, case when numeric_ and said is not null and hits = 0 then 'mcq_verified_answer_missing_from_choices' end,
 case when numeric_ and said is not null and hits > 1 then 'mcq_verified_answer_not_unique' end,
 case when said is not null and why <> '' and not list_contains(regexp_extract_all(why, '-?[0-9]+'), cast(said as varchar)) and not (said >= 0 and list_contains(regexp_extract_all(why, '[0-9]+'), cast(said as varchar))) then 'mcq_explanation_missing_answer' end,
 case when l_suppkey % 4 = 2 then 'mcq_math_meta_commentary' end''')} as issues,
 case when numeric_ and hits = 1 then cast(case when want + 1 = said then 0 when want = said then 1 when want - 2 = said then 2 else 3 end as int) end as correct from n""")
def math_questions(spark, d):
    rows = _lines(spark, d).withColumn("choices", F.array(*map(F.expr, CHOICES))).withColumn("why", F.expr(WHY.format("want")))
    parts = ar.math_parts(F.col("choices"), F.col("expression"), F.col("said").cast("string"))
    rows = rows.withColumns(parts)
    hits = ar.math_hits(F.col("choices"), {k: F.col(k) for k in parts})
    rows = rows.withColumns(hits)
    issues, correct = ar.math_question(F.lit("What is it?"), F.col("choices"), F.col("why"), F.col("expression"), F.col("said").cast("string"), {k: F.col(k) for k in (*parts, *hits)})
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.array_join(issues, ",").alias("issues"), correct.alias("correct"))


@query(rf"""with x as (select doc_id, coalesce(text, '') as text, list_filter(string_split_regex(coalesce(text, ''), '[ \t\r\n]+'), lambda w: w <> '')[1:4] as ch, nullif(doc_id % 7, 6) - 1 as idx,
  case when n_chars % 5 = 0 then 'As the Answer  Key says' when n_chars % 5 = 1 then ' ' else source end as why from documents), n as (select *, list_distinct(list_transform(ch, lambda x: {KEY.format('x')})) as u from x)
select doc_id, {JOINED.format('''case when len(ch) <> 4 then 'choices_not_four' when len(u) <> 4 then 'duplicate_choices' end, case when idx is null then 'bad_correct_index_type' end, case when idx < 0 or idx > 3 then 'correct_index_out_of_bounds' end,
 case when trim(coalesce(why, '')) = '' then 'empty_explanation' end, case when trim(text) = '' then 'empty_evidence' end, case when why = 'As the Answer  Key says' then 'mcq_general_meta_commentary' end''')} as issues from n""")
def general_questions(spark, d):
    """Which of its first four words a text begins with: texts of fewer words, or that repeat one, give no question."""
    t = table(spark, d, "documents").select("doc_id", "n_chars", "source", F.coalesce("text", F.lit("")).alias("text"))
    choices = F.slice(F.filter(F.split("text", tx.SPACE), lambda w: w != ""), 1, 4)
    why = F.when(F.col("n_chars") % 5 == 0, "As the Answer  Key says").when(F.col("n_chars") % 5 == 1, " ").otherwise(F.col("source"))
    issues = ar.general_question(F.col("text"), F.concat(F.lit("What does it begin with? "), F.col("doc_id")), choices, F.nullif(F.col("doc_id") % 7, F.lit(6)) - 1, why)
    return t.select("doc_id", F.array_join(issues, ",").alias("issues"))


KEYED = """concat('{{"user": ', user_id, ', "tags": [{{"z": 1, "a": "', event_type, '"}}, ', event_id % 3, '], "props": ', props, '}}')"""
TURNED = """concat('{{ "props" :', props, ',  "tags":[ {{"a":"', event_type, '","z":1}},', event_id % 3, ' ],\n"user":', user_id, '}}')"""


@query("""with h as (select distinct user_id, event_type, props, event_id % 3 as k from events where event_id % 50 = 7)
select event_id, concat('{"props":', replace(props, ' ', ''), ',"tags":[{"a":"', event_type, '","z":1},', event_id % 3, '],"user":', user_id, '}') as key,
 exists (select 1 from h where h.user_id = e.user_id and h.event_type = e.event_type and h.props = e.props and h.k = e.event_id % 3) as held_out from events e""")
def structured_holdouts(spark, d):
    """The registry writes an object's fields in another order, with other blanks, than the rows that are looked up in it."""
    events = table(spark, d, "events")
    held = events.where("event_id % 50 = 7").select(cn.structured_key(F.expr(TURNED.format())).alias("h")).distinct().withColumn("held_out", F.lit(True))
    keyed = events.select("event_id", cn.structured_key(F.expr(KEYED.format())).alias("key"))
    return keyed.join(held, F.col("key") == F.col("h"), "left").select("event_id", "key", F.coalesce("held_out", F.lit(False)).alias("held_out"))


TURN_JSON = f"concat('{{\"content\":', to_json({KEY.format(chr(39) + chr(39) + ' || coalesce(text, ' + chr(39) + chr(39) + ')')}), ',\"role\":', to_json(role), '}}')"


@query(f"""with c as (select conv_id, sha256(concat('{{"messages":[', string_agg({TURN_JSON}, ',' order by turn, role, text), ']}}')) as key from conversations group by conv_id)
select key, count(*) as conversations, min(conv_id) as first from c group by key""")
def row_fingerprints(spark, d):
    """Conversations by the fingerprint of their rows, whatever the case and blanks of their texts."""
    rows = _conversations(spark, d).select("conv_id", F.concat(F.lit('{"messages":'), cn.reader_view(F.col("turns")), F.lit("}")).alias("row"))
    return rows.groupBy(cn.row_key(F.col("row")).alias("key")).agg(F.count(F.lit(1)).alias("conversations"), F.min("conv_id").alias("first"))


#: A vocabulary of slot values (any bounded one will do).
SLOTS = ("The", "and", "der", "und", "les", "des", "los", "las")


def _row_templates(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "text")
    row = docs.select("doc_id", "source", "lang", F.split("text", "\n").alias("lines"), F.struct("lang").alias("about"))
    template = tp.row_template(row.select("lines", "about").schema, SLOTS)
    return row.select("doc_id", "source", F.sha2(template.cast("binary"), 256).alias("template"))


@query(None)
def template_overlap(spark, d):
    """Templates of whole rows that several sources have, with each source's number of rows; tested against plain Python."""
    counts = _row_templates(spark, d).groupBy("template", "source").agg(F.count(F.lit(1)).alias("n"))
    several = counts.groupBy("template").agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("occurrences")).where("sources > 1")
    return counts.join(several, "template").select("template", "source", "n", "sources", "occurrences")


ASKED = "case l_linenumber when 1 then concat('Add ', {1}, ' and ', {2}, ' to ', {1}, ' on deck') when 2 then concat('Take ', {2}, ' from ', {1}) when 3 then concat('Is ', {1}, ' times ', {2}, ' equal to ', {1} * {2}, '?') when 4 then concat('Of x', {1}, ' keep ', {2}, ', ', {2}, ' and again ', {2}) when 5 then ' ' else concat('Move ', {1}, ' onto the DECK by -', {2}) end"
NEEDED = "case when l_linenumber = 3 then '{1} {2} {2}' else '{1} {2}' end"


@query(f"""with r as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, {ASKED.format('', P, S)} as q, [cast({P} as varchar), cast({S} as varchar)] as want, cast({P} * {S} as varchar) as answer from lineitem),
s as (select *, list_filter(string_split_regex(q, '[^A-Za-z0-9_-]+'), lambda x: regexp_full_match(x, '-?[0-9]+')) as seen from r),
b as (select *, list_sort(list_distinct(want || seen)) as vs from s),
c as (select *, list_transform(vs, lambda v: struct_pack(v := v, k := len(list_filter(seen, lambda x: x = v)) - len(list_filter(want, lambda x: x = v)))) as ds from b),
i as (select *, list_filter(ds, lambda e: e.k < 0) as lost, list_filter(ds, lambda e: e.k > 0) as more from c)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, {JOINED.format('''case when trim(q) = '' then 'empty_question' end, case when len(lost) > 0 then 'missing_numeric_fact' end, case when len(list_filter(more, lambda e: not list_contains(want, e.v))) > 0 then 'extra_numeric_fact' end,
 case when len(list_filter(more, lambda e: list_contains(want, e.v))) > 0 then 'repeated_numeric_fact' end, case when not contains(lower(q), 'deck') then 'dropped_semantic_context' end, case when list_contains(seen, answer) and not list_contains(want, answer) then 'leaks_answer' end''')} as issues,
 array_to_string(list_transform(lost, lambda e: e.v || 'x' || -e.k), ' ') as missing, array_to_string(list_transform(more, lambda e: e.v || 'x' || e.k), ' ') as extra from i""")
def rendering_fidelity(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.expr(ASKED.format("", P, S)).alias("q"))
    want = F.array(F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    found = fd.rendering(F.col("q"), want, F.array(F.lit("Deck")), (F.col("l_partkey") * F.col("l_suppkey")).cast("string"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", found.alias("f")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array_join("f.issues", ",").alias("issues"), "f.missing", "f.extra")


SAID = "concat(case when doc_id % 5 = 0 then '' when toxic = 1 then ' assessable : No\n' else 'ASSESSABLE: yes\n' end, 'Decision: ', case when quality = 1 then 'accept' when doc_id % 7 = 0 then 'later' else 'REJECT' end, '\nReason: label ', quality, '\nREASON: none')"


@query(f"""with s as (select doc_id, quality, toxic, doc_id % 5 = 0 as lost, quality <> 1 and doc_id % 7 = 0 as bad from labels)
select doc_id, case when not lost and not bad then toxic <> 1 end as assessable, case when not lost and not bad then toxic <> 1 and quality = 1 end as accepted, 'label ' || quality as reason,
 array_to_string(list_filter([case when lost then 'missing_labels:ASSESSABLE' end, case when bad then 'bad_decision' end], lambda x: x is not null), ';') as issues from s""")
def judge_labels(spark, d):
    """Answers of a judge, made of the labels, as lines in which names and values vary in case and blanks."""
    said = table(spark, d, "labels").select("doc_id", dc.judge_decision(F.expr(SAID)).alias("j"))
    return said.select("doc_id", "j.assessable", "j.accepted", "j.reason", F.array_join("j.issues", ";").alias("issues"))


SIGNED = "concat('  ', case when p_size % 9 = 0 then '9' else '' end, replace(p_name, ' ', '_'), ' (', lower(p_type), case when p_size % 2 = 0 then '?' else '' end, ', size : int, ', case when p_size % 3 = 0 then '' else ' 1bad,' end, ' brand?: ', p_brand, ')')"


@query("""with t as (select p_partkey, p_size % 9 <> 0 as good, replace(p_name, ' ', '_') as name, lower(p_type) as kind, p_size % 2 = 0 as optional from part)
select p_partkey, case when good then name end as name, case when good then array_to_string([kind, 'size', 'brand'], ',') end as properties, case when good then case when optional then 'size' else kind || ',size' end end as required from t""")
def tool_signatures(spark, d):
    """Signatures of tools by the names and types of parts, with optional, typed and misnamed parameters."""
    tool = table(spark, d, "part").select("p_partkey", dc.tool_signature(F.expr(SIGNED)).alias("t"))
    return tool.select("p_partkey", "t.name", F.array_join("t.properties", ",").alias("properties"), F.array_join("t.required", ",").alias("required"))


@query(r"""with l as (select doc_id, source, string_split(coalesce(text, ''), chr(10)) as l from documents),
n as (select *, array_to_string(list_transform(l[2:5], lambda x, i: i || '. ' || x), chr(10)) as steps, array_to_string(list_transform(l[2:5], lambda x, i: chr(cast(64 + i as int)) || '. ' || x), chr(10)) as letters from l)
select doc_id, sha256(case doc_id % 4 when 0 then 'Question: ' || l[1] || chr(10) || 'Solution:' || chr(10) || steps || chr(10) || 'Answer: ' || source
 when 1 then 'Task: ' || l[1] || chr(10) || 'Plan:' || chr(10) || steps || chr(10) || 'Code:' || chr(10) || '```python' || chr(10) || source || chr(10) || '```'
 when 2 then 'Evidence: ' || source || chr(10) || 'Question: ' || l[1] || chr(10) || 'Choices:' || chr(10) || letters || chr(10) || 'Answer: ' || chr(cast(65 + doc_id % 3 as int)) || chr(10) || 'Explanation: ' || source
 else 'Question: ' || l[1] || chr(10) || 'Answer: ' || source end) as rendered from n""")
def rendered_records(spark, d):
    """Records of four signals, made of each text's lines, as the text that is published."""
    rows = table(spark, d, "documents").select("doc_id", "source", F.split(F.coalesce("text", F.lit("")), "\n").alias("l"))
    signal = F.element_at(F.array(*map(F.lit, ("arithmetic", "task_code", "educational_qa_mcq_general", "factual_restraint"))), (F.col("doc_id") % 4 + 1).cast("int"))
    first, rest, source = F.element_at("l", 1), F.slice("l", 2, 4), F.col("source")
    row = {"question": first, "steps": rest, "answer": source, "task": first, "plan": rest, "code": source, "choices": rest, "correct_index": (F.col("doc_id") % 3).cast("int"), "explanation": source, "evidence": source, "safe_answer": source}
    return rows.select("doc_id", F.sha2(dc.rendered(signal, row).cast("binary"), 256).alias("rendered"))
