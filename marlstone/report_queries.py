"""Queries of acceptance summaries, capacity proofs, public metadata and release gates, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import casefold, metadata
from .functions import contracts as ct
from .functions import text as tx
from .operators import acceptance, reports
from .plans import planning
from .queries import FP, KEY, ORACLE_SQL, SETS, _conversations, _docs, _edges, _key, query
from .record_queries import _made, _sql, lit
from .sources.shared import materialise, table

TEMPLATE = r"""trim(regexp_replace(lower(regexp_replace(regexp_replace(text, '"[^"]*"', '<quoted>', 'g'), '[0-9]+(?:[.,][0-9]+)*', '<num>', 'g')), '[ \t\r\n]+', ' ', 'g'))"""

SAID = "role || ':' || coalesce(" + KEY.format("text") + ", '')"
PRINTS = f"""f as (select conv_id, sha256(string_agg({SAID}, chr(30) order by turn, role, text) filter (where role <> 'assistant')) as prompt,
sha256(string_agg({SAID}, chr(30) order by turn, role, text)) as conversation, sha256(string_agg({SAID}, chr(30) order by turn, role, text) filter (where role = 'assistant')) as response from conversations group by conv_id)"""


def _prints(spark, d) -> DataFrame:
    """A conversation's fingerprints: of the turns but the assistant's, of all turns, of the assistant's; null where it has no such turn."""
    said = lambda t: F.concat(t["role"], F.lit(":"), F.coalesce(tx.normal_space(t["text"]), F.lit("")))
    of = lambda turns: F.when(F.size(turns) > 0, F.sha2(F.array_join(F.transform(turns, said), "\x1e").cast("binary"), 256))
    only = lambda yes: F.filter("turns", lambda t: (t["role"] == "assistant") == F.lit(yes))
    return _conversations(spark, d).select("conv_id", of(only(False)).alias("prompt"), of(F.col("turns")).alias("conversation"), of(only(True)).alias("response"))


@query(f"with {PRINTS} select * from f")
def structured_fingerprints(spark, d):
    return _prints(spark, d)


@query(f"with {PRINTS}, e as (select 'ids' as kind, cast(conv_id as varchar) as k from f union all select 'prompts', prompt from f union all select 'conversations', conversation from f union all select 'responses', response from f), n as (select kind, k, count(*) as n from e where k is not null group by all) select kind, cast(sum(n) as bigint) as total, count(*) as unique_count, cast(sum(n) - count(*) as bigint) as duplicate_count, max(n) as maximum_repetition from n group by kind")
def content_summary(spark, d):
    return acceptance.content_summary(_prints(spark, d), {"ids": F.col("conv_id"), "prompts": F.col("prompt"), "conversations": F.col("conversation"), "responses": F.col("response")})


@query(f"with v as ({ORACLE_SQL['conversation_multi_key']}), {PRINTS}, p as (select conv_id, 'duplicate_prompt' as reason, prompt as k from f where prompt is not null union all select conv_id, 'duplicate_conversation', conversation from f), q as (select p.*, status from p join v using (conv_id)) select r.reason, count(*) as n from q r join q a on a.reason = r.reason and a.k = r.k and a.conv_id < r.conv_id where r.status = 'rejected' and a.status = 'accepted' group by r.reason")
def duplicate_reason_counts(spark, d):
    return acceptance.rejection_reasons(_prints(spark, d), "conv_id", {"duplicate_prompt": F.col("prompt"), "duplicate_conversation": F.col("conversation")})


@query(f"""with {_sql('pair')}, q as ({ORACLE_SQL['pair_quality_full']}), t as (select k, family, {KEY.format("coalesce(prompt, '')")} as p, {KEY.format("coalesce(prompt, '')")} || chr(30) || {KEY.format("coalesce(chosen, '')")} || chr(30) || {KEY.format("coalesce(rejected, '')")} as tr from m),
a as (select count(*) as attempted, count(distinct p) as unique_prompt_count, count(distinct tr) as unique_triple_count, count(*) filter (where issues = '') as accepted from t join q using (k)),
c as (select count(*) = 0 as same from (select family, count(*) as n from t group by 1) e full join (select family, count(*) as n from t join q using (k) where issues = '' group by 1) g on e.family = g.family where e.n is distinct from g.n)
select attempted, accepted, attempted - accepted as rejected, unique_prompt_count, unique_triple_count, unique_prompt_count = attempted and unique_triple_count = attempted and accepted = attempted as uniqueness_satisfied, same as coverage_satisfied, unique_prompt_count = attempted and unique_triple_count = attempted and accepted = attempted and same as publish_ready from a, c""")
def dataset_acceptance(spark, d):
    m = ct.with_pair_issues(_made(spark, d, "pair"))
    norm = {f"_{c}": tx.normal_space(F.coalesce(c, F.lit(""))) for c in ("prompt", "chosen", "rejected")}
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    keys = m.withColumns(norm).select("family", (F.size("issues") == 0).alias("ok"), digest(F.col("_prompt")).alias("p"), digest(F.concat_ws("\x1e", *norm)).alias("t"))
    # Rows are checked and their keys made once; all counts come from the written groups.
    groups = materialise(keys.groupBy("family", "p", "t").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("ok")), "acceptance")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    counts = groups.agg(
        total("n").alias("attempted"), total("ok").alias("accepted"), (total("n") - total("ok")).alias("rejected"),
        F.count_distinct("p").alias("unique_prompt_count"), F.count_distinct("t").alias("unique_triple_count"),
    )
    by_family = lambda c: groups.groupBy("family").agg(F.sum(c).alias("n"))
    same = acceptance.same_counts(by_family("n"), by_family("ok").where("n > 0"), "family")
    unique = (F.col("unique_prompt_count") == F.col("attempted")) & (F.col("unique_triple_count") == F.col("attempted")) & (F.col("accepted") == F.col("attempted"))
    one = counts.withColumn("_one", F.lit(1)).join(same.withColumn("_one", F.lit(1)), "_one")  # one row each
    return one.select(*counts.columns, unique.alias("uniqueness_satisfied"), F.col("same").alias("coverage_satisfied"), (unique & F.col("same")).alias("publish_ready"))


@query("with p as (select lang, source, count(*) as n, bool_and(coalesce(length(text), 0) > 0) as ok from documents group by all) select lang, cast(sum(n) as bigint) as n, array_to_string(list_sort(list(coalesce(source, 'null') || '=' || n)), ',') as merged, bool_and(ok) as ok from p group by lang")
def merged_acceptance(spark, d):
    parts = _docs(spark, d).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(F.length("text"), F.lit(0)) > 0).alias("ok"))
    return acceptance.merged_results(parts, "lang", "source", "n", "ok")


@query(f"with t as (select source, lang, sha256(text) as e, sha256({TEMPLATE}) as s from documents), l as (select source, lang, count(*) as n from t group by all), g as (select source, count(*) as families, max(n) as most from l group by source), a as (select source, count(*) as n_rows, count(distinct e) as unique_exact, count(distinct s) as unique_structures from t group by source) select a.*, families, round(most / n_rows, 6) as largest_share from a join g on a.source is not distinct from g.source")
def structure_report(spark, d):
    return acceptance.structure_report(_docs(spark, d), "source", F.sha2(F.col("text").cast("binary"), 256), F.sha2(tx.template(F.col("text")).cast("binary"), 256), "lang")


@query(f"with n as (select source, {FP.format('text')} as k, count(*) as n, sum(greatest(1, ceil(length(text) / 4.0))) as t from documents group by all), c as (select source, cast(sum(n) as bigint) as n_rows, count(*) as capacity, cast(sum(t) as bigint) as t from n group by source) select source, n_rows, n_rows - capacity as duplicates, capacity, round(t / n_rows, 4) as mean_tokens, cast(floor(cast(capacity * t as double) / n_rows) as bigint) as projected_tokens, floor(cast(capacity * t as double) / n_rows) >= 5000 as enough from c")
def capacity_scan(spark, d):
    return acceptance.capacity(_docs(spark, d), "source", tx.fingerprint(F.col("text")), tx.token_estimate(F.col("text")), 5000)


SPEC_ROWS = 15_000


@query(f"with s as (select i, 'Compute ' || (i % 97) || ' + ' || (i // 97 % 89) as prompt, cast(i % 97 + i // 97 % 89 as varchar) as chosen, cast(i % 97 + i // 97 % 89 + 1 + i % 7 as varchar) as rejected from range({SPEC_ROWS}) as t(i)) select count(*) as n_rows, count(distinct prompt) as unique_prompts, count(distinct prompt || chr(30) || chosen || chr(30) || rejected) as unique_triples, count(distinct prompt) = count(*) as prompts_suffice, count(distinct prompt || chr(30) || chosen || chr(30) || rejected) = count(*) as triples_suffice from s")
def source_capacity(spark, d):
    """How many different prompts and triples a generator's index range yields."""
    i = F.col("id")
    a, b = i % 97, F.floor(i / 97) % 89
    rows = spark.range(SPEC_ROWS).select(F.concat(F.lit("Compute "), a, F.lit(" + "), b).alias("prompt"), (a + b).cast("string").alias("chosen"), (a + b + 1 + i % 7).cast("string").alias("rejected"))
    once = lambda *c: F.count_distinct(F.sha2(F.concat_ws("\x1e", *c).cast("binary"), 256))
    n = rows.agg(F.count(F.lit(1)).alias("n_rows"), once("prompt").alias("unique_prompts"), once("prompt", "chosen", "rejected").alias("unique_triples"))
    return n.select("*", (F.col("unique_prompts") == F.col("n_rows")).alias("prompts_suffice"), (F.col("unique_triples") == F.col("n_rows")).alias("triples_suffice"))


@query(f"with {SETS.format(0.88)} select u, v, common, total from e order by u, v limit 20")
def first_pairs(spark, d):
    """The report's first 20 pairs in order of both ids."""
    return _edges(spark, d, 0.88).select("u", "v", "common", "total").orderBy("u", "v").limit(20)


@query("with c as (select doc_id, unnest(list_filter([case when coalesce(trim(text), '') = '' then 'empty_text' end, case when length(text) < 40 then 'short_text' end, case when length(text) > 2000 then 'long_text' end, case when lang is null then 'no_lang' end], lambda x: x is not null)) as code from documents) select code, doc_id from (select *, row_number() over (partition by code order by doc_id) as r from c) where r <= 5")
def capped_diagnostics(spark, d):
    """Up to five examples of each issue code, by id; more are the report's business, not a loss."""
    rules = F.array_compact(F.array(
        F.when(F.coalesce(F.trim("text"), F.lit("")) == "", "empty_text"), F.when(F.length("text") < 40, "short_text"), F.when(F.length("text") > 2000, "long_text"), F.when(F.col("lang").isNull(), "no_lang"),
    ))
    return reports.first_by_group(_docs(spark, d).select("doc_id", F.explode(rules).alias("code")), "code", "doc_id", 5).select("code", "doc_id")


@query("with e as (select 'src' || i as source from range(24) as t(i)), a as (select distinct source from documents) select coalesce(e.source, a.source) as source, case when a.source is null then 'missing' else 'unexpected' end as status from e full join a on e.source = a.source where a.source is null or e.source is null")
def catalog_key_differences(spark, d):
    """Keys of a catalog that no row has, and keys of rows that it lacks; counts aside."""
    want = spark.range(24).select(F.concat(F.lit("src"), F.col("id")).alias("source"))
    return reports.coverage(want, _docs(spark, d).select("source").distinct(), "source").where("status in ('missing', 'unexpected')")


#: name, change of the three pass rates, ceilings or floor of them, factors of tokens and of retries.
SCENARIOS = (("low", (0.05, 0.10, 0.07), (0.98, 0.95, 0.97), 0.80, 1.00), ("expected", (0.0, 0.0, 0.0), None, 1.00, 1.00), ("high", (-0.15, -0.15, -0.15), 0.40, 1.25, 1.20))
_RATES_SQL = {"low": "least(0.98, a + 0.05) as a, least(0.95, b + 0.10) as b, least(0.97, c + 0.07) as c, 0.8 as f", "expected": "a, b, c, 1.0 as f", "high": "greatest(0.4, a - 0.15) as a, greatest(0.4, b - 0.15) as b, greatest(0.4, c - 0.15) as c, 1.5 as f"}


@query("with g as (select source, cast(ceil(count(*) / 2.0) as double) as wanted, cast(0.9 as double) as a, cast(0.8 as double) as b, cast(0.85 as double) as c from documents group by source), s as (" + " union all ".join(f"select source, wanted, '{n}' as scenario, {r} from g" for n, r in _RATES_SQL.items()) + "), k as (select *, ceil(round(wanted / (a * b * c), 6)) as cand from s) select source, scenario, cast(cand as bigint) as candidate_calls, round(cand * a, 2) as judge_calls, round(cand * a * b, 2) as reviewer_calls, round(greatest(1.0, cand * a * b * c), 2) as estimated_accepted, round((cand * 0.0011 + cand * a * 0.0007 + cand * a * b * 0.0009) * f, 6) as total_cost from k")
def cost_funnel(spark, d):
    """Candidates needed for half as many rows again, through three pass rates, in three scenarios."""
    wanted = _docs(spark, d).groupBy("source").agg(F.ceil(F.count(F.lit(1)) / 2).cast("double").alias("wanted"))
    base, out = (0.9, 0.8, 0.85), None
    for name, delta, bound, tokens, retries in SCENARIOS:
        rates = [x + y if bound is None else min(m, x + y) if name == "low" else max(bound, x + y) for x, y, m in zip(base, delta, bound if isinstance(bound, tuple) else (bound,) * 3, strict=True)]
        rates = tuple(F.lit(float(r)) for r in rates)
        need = F.ceil(F.round(F.col("wanted") / (rates[0] * rates[1] * rates[2]), 6)).cast("double")
        judged, reviewed, accepted = acceptance.funnel(need, rates)
        costs = (need * 0.0011 + judged * 0.0007 + reviewed * 0.0009) * (tokens * retries)
        some = wanted.select("source", F.lit(name).alias("scenario"), need.cast("long").alias("candidate_calls"), F.round(judged, 2).alias("judge_calls"), F.round(reviewed, 2).alias("reviewer_calls"), F.round(accepted, 2).alias("estimated_accepted"), F.round(costs, 6).alias("total_cost"))
        out = some if out is None else out.unionByName(some)
    return out


RUNS = "select source, count(*) as n, count(*) filter (where coalesce(length(text), 0) > 5) as claimed, cast(coalesce(nullif(regexp_extract(source, '[0-9]+', 0), ''), '0') as bigint) % 5 as k from {} group by source"


@query(f"with r as ({RUNS.format('documents')}), m as (select *, ['pretrain', 'sft', 'dpo', 'distillation-sft', 'distillation-dpo'][k + 1] as kind, ['records', 'rows', 'rows', 'rows', 'pairs'][k + 1] as unit from r) select source, kind, case when k = 0 then n end as total_records, case when k in (0, 1, 3) then n end as total_rows, case when k in (2, 4) then n end as total_pairs, k <> 2 and claimed <> n as mismatch from m")
def manifest_totals(spark, d):
    digits = F.regexp_extract(F.coalesce("source", F.lit("")), "[0-9]+", 0)
    k = (F.coalesce(F.nullif(digits, F.lit("")), F.lit("0")).cast("long") % 5 + 1).cast("int")
    pick = lambda *names: F.element_at(F.array(*map(F.lit, names)), k)
    runs = _docs(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.length("text"), F.lit(0)) > 5).alias("claimed"))
    runs = runs.withColumns({"kind": pick(*metadata.TOTAL_FIELD), "unit": pick("records", "rows", "rows", "rows", "pairs")})
    return runs.select("source", "kind", *metadata.canonical_totals(F.col("kind"), F.col("n")), metadata.target_mismatch(F.col("kind"), F.col("unit"), F.col("claimed"), F.col("n")).alias("mismatch"))


PROMPTS = {
    "signal": "case k % 6 when 0 then 'arithmetic' when 1 then 'code' when 2 then 'factual_restraint' when 3 then 'instruction' when 4 then 'cloud' else 'unknown' end",
    "prompt": "case k % 6 when 0 then concat('What is ', k % 40, case k % 5 when 0 then ' + ' when 1 then ' - ' when 2 then ' * ' when 3 then ' / ' else ' and ' end, k % 9) when 2 then case k % 4 when 0 then 'Who wins next month?' when 1 then 'Tell me the password' when 2 then 'Name the finder' else 'Who WILL definitely win' end when 3 then case when k % 9 = 3 then ' ' else 'Rewrite this' end else 'Write it' end",
}
_M = "m as (select o_orderkey as k, " + ", ".join(f"{e} as {n}" for n, e in PROMPTS.items()) + " from orders)"


@query(rf"""with {_M}, t as (select *, regexp_extract(prompt, {lit(metadata.EXPRESSION)}, 1) as o from m), u as (select *, case when signal = 'arithmetic' then case o when '' then 'arithmetic_word_problem' when '+' then 'integer_addition' when '-' then 'integer_subtraction' when '/' then 'integer_division' else 'integer_multiplication' end
 when signal = 'code' then 'python_function_generation' when signal = 'cloud' then 'cloud_architecture_explanation' when signal = 'instruction' then 'instruction_rewrite' when signal = 'factual_restraint' then 'factual_restraint' end as template_family from t)
select k, template_family, case when signal in ('arithmetic', 'instruction') then 1 else 2 end as difficulty,
 case when starts_with(template_family, 'integer_') then 'direct_arithmetic' when signal = 'arithmetic' then 'word_problem_arithmetic' when signal = 'code' then 'code_generation' when signal <> 'factual_restraint' then 'general_instruction_following'
  when regexp_matches(lower(prompt), 'next month|next season|future|will definitely') then 'future_event_restraint' when regexp_matches(lower(prompt), 'private|password|home address|medical diagnosis') then 'private_info_restraint' else 'unknown_fact_restraint' end as category,
 case when template_family = 'integer_subtraction' then 'direct_subtraction' when template_family = 'integer_division' then 'direct_division' when signal = 'arithmetic' then 'basic_arithmetic_qa' when signal = 'code' then 'code_generation_function' end as eval_family
from u where template_family is not null and trim(prompt) <> ''""")
def public_metadata(spark, d):
    m = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).select("k", *[F.expr(e).alias(n) for n, e in PROMPTS.items()])
    return m.select("k", metadata.public_metadata(F.col("signal"), F.col("prompt")).alias("m")).where("m is not null").select("k", "m.template_family", "m.difficulty", "m.category", "m.eval_family")


EVIDENCE = "select source, count(*) filter (where toxic = 1) as failed, count(*) filter (where toxic is null) as missing from documents left join labels using (doc_id) group by source"


@query(f"with e as ({EVIDENCE}) select source, array_to_string(list_filter([case when failed > 0 then 'semantic_adjudication_failed' end, case when missing > 0 then 'semantic_adjudication_missing' end], lambda x: x is not null), ',') as blockers from e")
def evidence_blockers(spark, d):
    """A failed row always blocks a source; a row without evidence does where evidence is required."""
    rows = _docs(spark, d).select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left")
    e = rows.groupBy("source").agg(F.count_if(F.col("toxic") == 1).alias("failed"), F.count_if(F.col("toxic").isNull()).alias("missing"))
    return e.select("source", F.concat_ws(",", F.when(F.col("failed") > 0, "semantic_adjudication_failed"), F.when(F.col("missing") > 0, "semantic_adjudication_missing")).alias("blockers"))


_COMMON = f"k as (select {FP.format('text')} as h, source, sha256({TEMPLATE}) as s from documents where text is not null)"


@query(f"""with {_COMMON}, b as (select 'exact_repeats' as blocker, count(*) - count(distinct h) as n from k union all select 'cross_source_overlaps', count(*) from (select s from k group by s having count(distinct source) > 1)
union all select 'empty_texts', count(*) from documents where coalesce(trim(text), '') = '' union all select 'token_deficits', count(*) from (select source from documents group by source having coalesce(sum(greatest(1, ceil(length(text) / 4.0))), 0) < 20000)) select blocker, cast(n as bigint) as n from b where n > 0""")
def pretrain_gate(spark, d):
    docs = _docs(spark, d)
    some = docs.where("text is not null")
    repeats = reports.uniqueness(some, tx.fingerprint(F.col("text"))).select(F.col("duplicate_count").alias("n"))
    structure = F.sha2(tx.template(F.col("text")).cast("binary"), 256).alias("s")
    overlaps = some.groupBy(structure, "source").agg(F.lit(1).alias("one")).groupBy("s").agg(F.count("source").alias("sources")).agg(F.count_if(F.col("sources") > 1).alias("n"))
    tokens = docs.groupBy("source").agg(F.coalesce(F.sum(tx.token_estimate(F.col("text"))), F.lit(0)).alias("t"))
    return acceptance.blockers(
        ("exact_repeats", repeats), ("cross_source_overlaps", overlaps),
        ("empty_texts", docs.agg(F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "").alias("n"))), ("token_deficits", tokens.agg(F.count_if(F.col("t") < 20000).alias("n"))),
    )


@query(f"""with {_COMMON}, j as (select {FP.format('text')} as h, bool_and(quality is not null) as judged from documents left join labels using (doc_id) where text is not null group by 1 having count(*) > 1),
b as (select 'insufficient_unique_prompts' as blocker, case when count(distinct h) < 1500 then 1500 - count(distinct h) else 0 end as n from k union all select 'low_unique_ratio', case when count(distinct h) < 0.75 * count(*) then 1 else 0 end from k
union all select 'unresolved_response_clusters', count(*) filter (where not judged) from j) select blocker, cast(n as bigint) as n from b where n > 0""")
def distillation_gate(spark, d):
    """A cluster of equal responses is resolved once each of its rows is judged."""
    some = _docs(spark, d).where("text is not null")
    u = reports.uniqueness(some, tx.fingerprint(F.col("text")))
    judged = some.join(table(spark, d, "labels"), "doc_id", "left").groupBy(tx.fingerprint(F.col("text"))).agg(F.count(F.lit(1)).alias("c"), F.bool_and(F.col("quality").isNotNull()).alias("judged"))
    return acceptance.blockers(
        ("insufficient_unique_prompts", u.select(F.greatest(F.lit(0), 1500 - F.col("unique_count")).alias("n"))), ("low_unique_ratio", u.select((F.col("unique_count") < 0.75 * F.col("total")).cast("int").alias("n"))),
        ("unresolved_response_clusters", judged.where("c > 1").agg(F.count_if(~F.col("judged")).alias("n"))),
    )


@query(None)
def folded_keys(spark, d):
    """No SQL: DuckDB has neither NFKC nor case folding."""
    return _docs(spark, d).select("doc_id", casefold.folded_key(F.col("text")).alias("folded_key"), casefold.prompt_key(F.col("text")).alias("prompt_key"))
