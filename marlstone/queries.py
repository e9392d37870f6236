"""Queries of the library's operators on the driver's tables, each with independent DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as tx
from .functions import validators as vd
from .operators import dedup, frames, reports, similarity
from .operators.components import components
from .plans import planning
from .sources.shared import materialise, shuffles_end, table
from .streaming.incremental import windowed_counts

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

#: SQL for the exact-match key, its fingerprint and the token list.
KEY = r"trim(regexp_replace(lower({0}), '[ \t\r\n]+', ' ', 'g'))"
FP = f"sha256({KEY})"
WORDS = r"len(list_filter(string_split_regex(coalesce({0}, ''), '[ \t\r\n]+'), lambda w: w <> ''))"


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text", "lang", "source")


def _key(c: str = "text"):
    return tx.normal_space(F.col(c))


#: Of equal keys one row is the first, also where ids repeat; a null text is no copy.
FIRST = f"with k as (select *, {FP.format('text')} as h from documents), f as (select *, min(doc_id) over (partition by h) as m, h is null or row_number() over (partition by h order by doc_id) = 1 as one from k)"


@query(f"{FIRST} select doc_id, source, case when one then 'accepted' else 'duplicate' end as status, case when not one then m end as matched from f")
def exact_dedup(spark, d):
    return dedup.first_wins(_docs(spark, d).select("doc_id", "source", "text"), _key(), "doc_id").drop("text")


@query(f"{FIRST} select source, count(*) filter (where one) as accepted, count(*) filter (where not one) as duplicates, cast(sum(case when one then greatest(1, ceil(length(text) / 4.0)) else 0 end) as bigint) as accepted_tokens from f group by source")
def exact_dedup_report(spark, d):
    got = dedup.first_wins(_docs(spark, d).withColumn("tokens", tx.token_estimate(F.col("text"))), _key(), "doc_id")
    ok = F.col("status") == "accepted"
    return got.groupBy("source").agg(F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("duplicates"), F.sum(F.when(ok, F.col("tokens")).otherwise(0)).alias("accepted_tokens"))


@query(f"select {FP.format('text')} as cluster, count(distinct source) as sources, count(*) as occurrences from documents group by 1 having count(distinct source) > 1")
def cross_source_exact_dups(spark, d):
    each = _docs(spark, d).groupBy(tx.fingerprint(F.col("text")).alias("cluster"), "source").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("cluster").agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("occurrences")).where("sources > 1")


@query("select lang, source, count(*) as n_rows, cast(sum(greatest(1, ceil(length(text) / 4.0))) as bigint) as tokens from documents group by all")
def token_estimates(spark, d):
    return _docs(spark, d).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(tx.token_estimate(F.col("text"))).alias("tokens"))


@query("select lang, count(*) as n_rows, round(avg(length(text)), 2) as mean_length, median(length(text)) as median_length, cast(quantile_disc(length(text), 0.9) as bigint) as p90_length, cast(ceil(avg(length(text))) as bigint) as ceil_mean from documents group by lang")
def length_stats(spark, d):
    return reports.length_stats(_docs(spark, d), "lang", F.length("text"))


@query(f"select source as grp, count(*) as n_rows, count(distinct {FP.format('text')}) as n_unique, count(*) - count(distinct {FP.format('text')}) as n_duplicates, round((count(*) - count(distinct {FP.format('text')})) / count(*), 6) as rate from documents group by rollup (source)")
def duplicate_rate_rollup(spark, d):
    return reports.duplicate_rate(_docs(spark, d), "source", _key())


@query(f"select cast(sum(n) as bigint) as total, count(*) as unique_count, cast(sum(n) - count(*) as bigint) as duplicate_count, round(count(*) / sum(n), 6) as unique_ratio, count(*) filter (where n > 1) as repeated_value_count, max(n) as maximum_repetition from (select {FP.format('text')} as h, count(*) as n from documents group by 1)")
def uniqueness_summary(spark, d):
    return reports.uniqueness(_docs(spark, d), tx.fingerprint(F.col("text")))


@query("select 'lang' as field, coalesce(lang, 'null') as value, count(*) as n from documents group by 2 union all select 'source', coalesce(source, 'null'), count(*) from documents group by 2")
def metadata_counts(spark, d):
    return reports.value_counts(_docs(spark, d), ["lang", "source"])


@query("select role, count(distinct conv_id) as conversations from conversations group by role")
def list_metadata_counts(spark, d):
    roles = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("roles"))
    return roles.select(F.explode("roles").alias("role")).groupBy("role").agg(F.count(F.lit(1)).alias("conversations"))


@query("select lang, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share, count(*) / sum(count(*)) over () > 0.4 and count(*) > 1 as over_limit from documents group by lang")
def template_concentration(spark, d):
    return reports.concentration(_docs(spark, d), "lang")


CLUSTERS = f"select {FP.format('text')} as cluster, count(*) as size, min(doc_id) as first_member, array_to_string(list_sort(list(distinct doc_id))[1:5], ',') as members from documents group by 1 having count(*) > 1"


@query(CLUSTERS)
def response_clusters(spark, d):
    return reports.clusters(_docs(spark, d), "doc_id", _key())


@query(f"with k as (select doc_id, {FP.format('text')} as cluster from documents) select distinct cluster, doc_id from k where cluster in (select cluster from k group by cluster having count(*) > 1)")
def response_cluster_members(spark, d):
    return reports.cluster_members(_docs(spark, d), "doc_id", _key())


@query(f"select * from ({CLUSTERS}) order by size desc, first_member limit 20")
def top_response_clusters(spark, d):
    return reports.top_clusters(reports.clusters(_docs(spark, d), "doc_id", _key()))


@query(f"select {FP.format('text')} as cluster, count(*) as size, case when bool_and(coalesce(quality, 0) = 1) then 'cleared' else 'review' end as decision from documents left join labels using (doc_id) group by 1 having count(*) > 1")
def cluster_review(spark, d):
    rows = _docs(spark, d).join(table(spark, d, "labels"), "doc_id", "left")
    return rows.groupBy(tx.fingerprint(F.col("text")).alias("cluster")).agg(F.count(F.lit(1)).alias("size"), F.when(F.every(F.coalesce("quality", F.lit(0)) == 1), "cleared").otherwise("review").alias("decision")).where("size > 1")


TOKENS = "regexp_extract_all(lower(text), '[a-z0-9]+')"
SETS = f"""w as (select doc_id, source, {TOKENS} as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g from w, unnest(range(1, case when len(w) = 0 then 0 else greatest(len(w) - 4, 1) end + 1)) as t(i)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as u, b.doc_id as v, count(*) as common from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (select u, v, common, x.n + y.n - common as total from p join n x on u = x.doc_id join n y on v = y.doc_id where common / (x.n + y.n - common) >= {{0}})"""


def _classes(spark, d, threshold: float = 0.80) -> tuple[DataFrame, DataFrame]:
    def made(docs: DataFrame) -> DataFrame:
        # Tokens are a column of their own: inside the shingles' lambda the expression would run anew for each shingle.
        hashes = docs.select("doc_id", tx.tokens(F.col("text")).alias("w")).select("doc_id", F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
        return hashes.select("doc_id", tx.hashed_shingles(F.col("h"), 5).alias("s"))

    return similarity.jaccard_classes(_docs(spark, d).select("doc_id", "text"), "doc_id", "s", threshold, made)


def _edges(spark, d, threshold: float = 0.80) -> DataFrame:
    return similarity.expanded(*_classes(spark, d, threshold))


@query(f"with {SETS.format(0.80)} select * from e")
def shingle_edges(spark, d):
    return _edges(spark, d)


@query(f"with {SETS.format(0.88)} select * from e")
def prefix_jaccard_pairs(spark, d):
    return _edges(spark, d, 0.88)


GREEDY = """,
adj as (select v, list(u) as us from c group by v),
o as (select doc_id, row_number() over (order by doc_id) as i from documents),
walk as (select cast(0 as bigint) as i, cast([] as bigint[]) as ok union all
  select o.i, case when list_has_any(coalesce(us, []), ok) then ok else list_append(ok, doc_id) end from walk join o on o.i = walk.i + 1 left join adj on v = doc_id),
fin as (select ok from walk order by i desc limit 1)
select doc_id, case when list_contains(ok, doc_id) then 'accepted' else 'rejected' end as status,
  case when not list_contains(ok, doc_id) then list_min(list_filter(us, lambda x: list_contains(ok, x))) end as matched
from documents left join adj on v = doc_id, fin"""


@query(f"with recursive {SETS.format(0.80)}, x as (select doc_id, {FP.format('text')} as h from documents), c as (select u, v from e union select a.doc_id, b.doc_id from x a join x b on a.h = b.h and a.doc_id < b.doc_id)" + GREEDY)
def near_dup_greedy(spark, d):
    docs = _docs(spark, d)
    pairs, copies = _classes(spark, d)
    # Texts without tokens have no set; their exact copies are told by the key.
    bare = docs.where(F.size(tx.tokens(F.col("text"))) == 0).select("doc_id", "text")
    exact = dedup.first_wins(bare, _key(), "doc_id").where("matched is not null").select("doc_id", F.col("matched").alias("first"))
    return dedup.greedy_accept(docs, "doc_id", pairs, copies.select(F.col("id").alias("doc_id"), "first").unionByName(exact))


HEAD = r"array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+')[1:3], ' ')"


@query(f"with recursive x as (select doc_id, {FP.format('text')} as h, {HEAD} as g from documents), c as (select a.doc_id as u, b.doc_id as v from x a join x b on (a.h = b.h or a.g = b.g) and a.doc_id < b.doc_id)" + GREEDY)
def multi_key_first_wins(spark, d):
    docs = _docs(spark, d)
    keys = [_key(), F.array_join(F.slice(tx.tokens(F.col("text")), 1, 3), " ")]
    return dedup.multi_key_accept(docs, "doc_id", keys)


TURN = f"role || ':' || coalesce({KEY.format('text')}, '')"
TURNS = f"x as (select conv_id, string_agg({TURN}, chr(30) order by turn, role, text) as h, string_agg({TURN}, chr(30) order by turn, role, text) filter (where role <> 'assistant') as g from conversations group by conv_id)"


@query(f"with recursive {TURNS}, c as (select a.conv_id as u, b.conv_id as v from x a join x b on (a.h = b.h or a.g = b.g) and a.conv_id < b.conv_id)" + GREEDY.replace("documents", "x").replace("doc_id", "conv_id"))
def conversation_multi_key(spark, d):
    """On whole values: the id (one row is made of each), all turns but the assistant's, and all turns."""
    said = lambda t: F.concat(t["role"], F.lit(":"), F.coalesce(tx.normal_space(t["text"]), F.lit("")))
    joined = lambda turns: F.array_join(F.transform(turns, said), "\x1e")
    prompt = F.filter("turns", lambda t: t["role"] != "assistant")
    keys = [F.when(F.size(prompt) > 0, joined(prompt)), joined(F.col("turns"))]
    return dedup.multi_key_accept(_conversations(spark, d), "conv_id", keys)


@query(f"with recursive {SETS.format(0.80)}, b as (select u, v from e union select v, u from e), r as (select u, v from b union select r.u, b.v from r join b on r.v = b.u), c as (select u as doc_id, least(u, min(v)) as component from r group by u) select doc_id, component, count(*) over (partition by component) as size from c")
def near_dup_components(spark, d):
    pairs, copies = _classes(spark, d)
    with shuffles_end(spark):
        found = components(pairs.select("u", "v").union(copies.select("id", "first")))
    named = found.select(F.col("node").alias("doc_id"), F.col("comp").alias("component"))
    return named.join(named.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component").select("doc_id", "component", "size")


@query(f"with {SETS.format(0.80)} select u, v, x.source as source_u, y.source as source_v from e join documents x on u = x.doc_id join documents y on v = y.doc_id where x.source <> y.source")
def cross_source_near_dups(spark, d):
    of = _docs(spark, d).select("doc_id", "source")
    e = _edges(spark, d).join(of.select(F.col("doc_id").alias("u"), F.col("source").alias("source_u")), "u").join(of.select(F.col("doc_id").alias("v"), F.col("source").alias("source_v")), "v")
    return e.where("source_u <> source_v").select("u", "v", "source_u", "source_v")


def _holdouts(spark, d) -> DataFrame:
    """Fingerprints of the benchmark and, so that exact hits occur, of documents whose id ends in 7."""
    extra = _docs(spark, d).where("doc_id % 10 = 7").select("text")
    return table(spark, d, "benchmark").select("text").union(extra).select(tx.fingerprint(F.col("text")).alias("h")).distinct()


HOLD = f"with h as (select {FP.format('text')} as h from benchmark union select {FP.format('text')} from documents where doc_id % 10 = 7)"


@query(f"{HOLD} select doc_id from documents where {FP.format('text')} in (select h from h)")
def holdout_semi(spark, d):
    return _docs(spark, d).withColumn("h", tx.fingerprint(F.col("text"))).join(_holdouts(spark, d), "h", "left_semi").select("doc_id")


@query(f"{HOLD} select source, count(*) as kept from documents where {FP.format('text')} not in (select h from h) group by source")
def holdout_clean_corpus(spark, d):
    return _docs(spark, d).withColumn("h", tx.fingerprint(F.col("text"))).join(_holdouts(spark, d), "h", "left_anti").groupBy("source").agg(F.count(F.lit(1)).alias("kept"))


@query(f"with h as (select {FP.format('text')} as h from conversations where role = 'user' and conv_id % 10 = 3) select distinct conv_id from conversations where role = 'user' and {FP.format('text')} in (select h from h)")
def conversation_holdouts(spark, d):
    user = table(spark, d, "conversations").where("role = 'user'").withColumn("h", tx.fingerprint(F.col("text")))
    return user.join(user.where("conv_id % 10 = 3").select("h").distinct(), "h", "left_semi").select("conv_id").distinct()


def _conversations(spark, d) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(turns.alias("turns"))
    return rows.withColumn("roles", F.transform("turns", lambda t: t["role"]))


@query("""with c as (select conv_id, list(role order by turn) as r from conversations group by conv_id),
f as (select conv_id, r, list_filter(r, lambda x: x <> 'system')[1] as first from c)
select conv_id, array_to_string(list_filter([case when list_contains(r[2:], 'system') then 'misplaced_system' end,
  case when len(list_filter(range(1, len(r)), lambda i: r[i] = r[i + 1] and r[i] <> 'system')) > 0 then 'repeated_role' end,
  case when first = 'assistant' then 'leading_assistant' end, case when r[-1] <> 'assistant' then 'final_role_not_assistant' end], lambda x: x is not null), ',') as issues from f""")
def role_sequence_issues(spark, d):
    return _conversations(spark, d).select("conv_id", F.array_join(vd.role_sequence(F.col("roles")), ",").alias("issues"))


@query("""with c as (select conv_id, count(*) filter (where role = 'user') as users, count(*) filter (where role = 'system') > 0 as has_system from conversations group by conv_id)
select case when users > 1 then 'multi_turn' else 'single_turn' end as mode, has_system, count(*) as n from c group by all""")
def interaction_modes(spark, d):
    users = F.size(F.filter("roles", lambda r: r == "user"))
    return _conversations(spark, d).select(F.when(users > 1, "multi_turn").otherwise("single_turn").alias("mode"), F.array_contains("roles", "system").alias("has_system")).groupBy("mode", "has_system").agg(F.count(F.lit(1)).alias("n"))


@query(rf"""select conv_id, turn, {WORDS.format('text')} >= 20 as min_words, {WORDS.format('text')} <= 150 as max_words, contains(lower(text), 'the') as requires_the, not contains(lower(text), 'und') as forbids_und,
len(list_filter(string_split(text, chr(10)), lambda l: trim(l) <> '')) = 1 as exact_lines from conversations where role = 'assistant'""")
def output_constraints(spark, d):
    rows = table(spark, d, "conversations").where("role = 'assistant'")
    return rows.select("conv_id", "turn", *[c.alias(n) for n, c in vd.output_constraints(F.col("text"), 20, 150, ("the",), ("und",), 1).items()])


def _exchanges(spark, d) -> DataFrame:
    """Each assistant turn with the user turn right before it."""
    c = table(spark, d, "conversations")
    prompt = c.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt"))
    return c.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("response")).join(prompt, ["conv_id", "turn"])


EXCHANGES = "x as (select a.conv_id, a.turn, u.text as prompt, a.text as response from conversations a join conversations u on a.conv_id = u.conv_id and a.turn = u.turn + 1 where a.role = 'assistant' and u.role = 'user')"


@query(rf"""with {EXCHANGES}, y as (select *, trim(response) as t, lower(trim(response)) as l from x)
select conv_id, turn, array_to_string(list_filter([case when t = '' then 'empty_response' end, case when t <> '' and {WORDS.format('t')} < 3 then 'too_short' end,
 case when t <> '' and {KEY.format('t')} = {KEY.format('prompt')} then 'repeats_prompt' end,
 case when contains(l, '"prompt":') or contains(l, '"response":') or contains(l, '"metadata":') then 'schema_leakage' end,
 case when contains(l, 'i cannot') or contains(l, 'i can''t') or contains(l, 'i am unable') or contains(l, 'as an ai') then 'unexpected_refusal' end], lambda x: x is not null), ',') as issues from y""")
def response_quality(spark, d):
    return _exchanges(spark, d).select("conv_id", "turn", F.array_join(vd.response_quality(F.col("prompt"), F.col("response")), ",").alias("issues"))


def _pairs(spark, d) -> DataFrame:
    """Two assistant turns of one conversation, the earlier as chosen."""
    a = table(spark, d, "conversations").where("role = 'assistant'")
    left = a.groupBy("conv_id").agg(F.min(F.struct("turn", "text")).alias("c"), F.max(F.struct("turn", "text")).alias("r"))
    return left.where("c.turn < r.turn").select("conv_id", F.col("c.text").alias("chosen"), F.col("r.text").alias("rejected"))


PAIRS = "p as (select conv_id, arg_min(text, turn) as chosen, arg_max(text, turn) as rejected from conversations where role = 'assistant' group by conv_id having min(turn) < max(turn))"


@query(rf"""with {PAIRS}, t as (select *, list_distinct(regexp_extract_all(lower(chosen), '[a-z0-9]+')) as a, list_distinct(regexp_extract_all(lower(rejected), '[a-z0-9]+')) as b, {KEY.format('chosen')} as kc, {KEY.format('rejected')} as kr from p),
j as (select *, len(list_intersect(a, b)) as i, len(a) + len(b) - len(list_intersect(a, b)) as u from t)
select conv_id, array_to_string(list_filter([case when {WORDS.format('chosen')} < 3 then 'chosen_too_short' end, case when {WORDS.format('rejected')} < 3 then 'rejected_too_short' end, case when kc = kr then 'identical_pair' end,
 case when kc <> kr and i / u >= 0.92 and abs(length(chosen) - length(rejected)) <= 0.08 * greatest(length(chosen), length(rejected)) and u >= 6 then 'non_contrastive' end], lambda x: x is not null), ',') as issues,
 round(case when u = 0 then 1.0 else i / u end, 6) as similarity from j""")
def pair_quality(spark, d):
    p = _pairs(spark, d)
    similar = tx.jaccard(F.array_distinct(tx.tokens(F.col("chosen"))), F.array_distinct(tx.tokens(F.col("rejected"))))
    return p.select("conv_id", F.array_join(vd.pair_quality(F.lit(None).cast("string"), F.col("chosen"), F.col("rejected")), ",").alias("issues"), F.round(similar, 6).alias("similarity"))


@query(rf"""with {PAIRS}, t as (select {KEY.format('chosen')} as a, {KEY.format('rejected')} as b from p)
select case when b = '' then 'empty' when a = b then 'identical' when contains(b, a) then 'chosen_contained' when contains(a, b) then 'truncation'
 when array_to_string(regexp_extract_all(a, '[0-9]+'), ',') <> array_to_string(regexp_extract_all(b, '[0-9]+'), ',') then 'numeric_substitution'
 when length(b) < length(a) / 2 then 'much_shorter' when length(b) > length(a) * 2 then 'much_longer' else 'rewrite' end as pattern, count(*) as n from t group by 1""")
def negative_patterns(spark, d):
    return _pairs(spark, d).groupBy(vd.negative_pattern(F.col("chosen"), F.col("rejected")).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


@query(rf"""with t as (select text, lower(text) as l, regexp_extract_all(text, '[!]{{2,}}') as b from documents),
i as (select unnest(list_filter([case when coalesce(trim(text), '') = '' then 'empty_text' end,
 case when contains(l, 'lorem ipsum') or contains(l, 'todo') or contains(l, 'tbd') or contains(l, '[insert') or contains(l, '<placeholder>') then 'generated_placeholder_text' end,
 case when {WORDS.format('text')} < 5 then 'too_short' end, case when len(b) > 5 then 'shouting' end, case when contains(text, '%%%') then 'symbol_noise' end], lambda x: x is not null)) as issue from t)
select issue, count(*) as n from i group by issue""")
def issue_histogram(spark, d):
    return _docs(spark, d).select(F.explode(vd.record_issues(F.col("text"))).alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@query("select doc_id, case when quality is null then 'missing' when quality = 1 and toxic = 0 then 'passed' else 'failed' end as status from documents left join labels using (doc_id)")
def evidence_status(spark, d):
    return reports.evidence_status(_docs(spark, d), table(spark, d, "labels"), "doc_id", (F.col("quality") == 1) & (F.col("toxic") == 0))


@query("select source, count(*) filter (where quality = 1 and toxic = 0) as passed, count(*) filter (where quality is not null and not (quality = 1 and toxic = 0)) as failed, count(*) filter (where quality is null) as missing from documents left join labels using (doc_id) group by source")
def evidence_by_group(spark, d):
    status = evidence_status(spark, d).join(_docs(spark, d).select("doc_id", "source"), "doc_id")
    return status.groupBy("source").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("passed", "failed", "missing")])


@query("with e as (select source, count(*) as n from documents group by 1), a as (select source, count(*) as n from documents join labels using (doc_id) where quality = 1 group by 1) select coalesce(e.source, a.source) as source, coalesce(e.n, 0) as expected, coalesce(a.n, 0) as actual from e full join a on e.source = a.source where coalesce(e.n, 0) <> coalesce(a.n, 0)")
def manifest_count_mismatch(spark, d):
    docs = _docs(spark, d)
    accepted = docs.join(table(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi")
    return reports.count_mismatch(*[x.groupBy("source").agg(F.count(F.lit(1)).alias("n")) for x in (docs, accepted)], "source")


@query("select user_id, count(*) as attempts, count(*) filter (where event_type = 'error') as errors, round(sum(value), 4) as cost, max(value) as max_value, min(value) filter (where value > 0) as min_positive, arg_min(event_type, (ts, event_id)) as first_type from events group by user_id")
def telemetry_rollup(spark, d):
    return reports.telemetry(table(spark, d, "events"))


@query("select source, count(*) as judged, count(*) filter (where quality = 0) as rejected, round(avg(case when quality = 0 then 1.0 else 0.0 end), 6) as rate, avg(case when quality = 0 then 1.0 else 0.0 end) >= 0.05 as investigate from documents join labels using (doc_id) group by source")
def judge_rejection_rate(spark, d):
    rate = F.avg(F.when(F.col("quality") == 0, 1.0).otherwise(0.0))
    judged = _docs(spark, d).select("doc_id", "source").join(table(spark, d, "labels"), "doc_id")
    return judged.groupBy("source").agg(F.count(F.lit(1)).alias("judged"), F.count_if(F.col("quality") == 0).alias("rejected"), F.round(rate, 6).alias("rate"), (rate >= 0.05).alias("investigate"))


@query("with h as (select doc_id, source, row_number() over (partition by source order by sha256('seed:' || doc_id), doc_id) as rank from documents) select doc_id, source, rank from h where rank <= 10")
def reservoir_by_group(spark, d):
    return reports.sample_by_group(_docs(spark, d).select("doc_id", "source"), "source", "doc_id", 10, "seed:").select("doc_id", "source", F.col("rank").cast("long").alias("rank"))


@query("with s as (select distinct source from documents), r as (select source, row_number() over (order by source) as k, count(*) over () as n from s) select source, cast(100003 // n + case when k <= 100003 % n then 1 else 0 end as bigint) as planned from r")
def count_plan(spark, d):
    return planning.even_split(_docs(spark, d).select("source").distinct(), "source", 100_003)


MEANS = "with g as (select lang, count(*) as n, avg(length(text)) / 4 as m from documents group by lang), t as (select lang, round(n / sum(n) over (), 4) as share, round(m, 2) as mean_tokens, n * 50 as capacity from g)"


def _means(spark, d) -> DataFrame:
    from pyspark.sql import Window

    g = _docs(spark, d).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), (F.avg(F.length("text")) / 4).alias("m"))
    return g.select("lang", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 4).alias("share"), F.round("m", 2).alias("mean_tokens"), (F.col("n") * 50).alias("capacity"))


@query(f"{MEANS} select lang, cast(round(share * 1000000) as bigint) as token_target, least(cast(ceil(cast(round(share * 1000000) as bigint) / mean_tokens) as bigint), capacity) as planned_rows from t")
def token_targets(spark, d):
    return planning.token_targets(_means(spark, d), "lang", "share", "mean_tokens", "capacity", 1_000_000)


COMPLETION = "with r as (select source, count(*) as n, count(*) filter (where quality = 1) as got from documents left join labels using (doc_id) group by source), c as (select source, cast(n // 3 as bigint) as target, got, cast(greatest(n // 3 - got, 0) as bigint) as deficit, case when got >= n // 3 then 'complete' when got = 0 then 'empty' else 'underfilled' end as status from r)"


@query(f"{COMPLETION} select * from c")
def completion_report(spark, d):
    docs = _docs(spark, d)
    targets = docs.groupBy("source").agg(F.floor(F.count(F.lit(1)) / 3).cast("long").alias("target"))
    got = docs.join(table(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("got"))
    return planning.completion(targets, got, "source")


@query(f"{COMPLETION} select *, least(cast(ceil(deficit / 0.6) as bigint), 1000) as to_generate from c where deficit > 0")
def replacement_plan(spark, d):
    return planning.replacements(completion_report(spark, d), 0.6, 1000)


@query("select i, i % 10 as archetype, i // 10 % 15 as context, i // 150 % 7 as variation from range(3000) as t(i)")
def mixed_radix_plan(spark, d):
    return planning.mixed_radix(spark, 3000, {"archetype": 10, "context": 15, "variation": 7})


@query("select i, ['a', 'a', 'a', 'b', 'b', 'c'][i % 6 + 1] as category, cast(case when i % 6 < 3 then i // 6 * 3 + i % 6 when i % 6 < 5 then i // 6 * 2 + i % 6 - 3 else i // 6 end as bigint) as ordinal from range(2000) as t(i)")
def weighted_schedule(spark, d):
    return planning.weighted_schedule(spark, 2000, {"a": 3, "b": 2, "c": 1})


@query("with r as (select l_suppkey, l_partkey as s, l_partkey + cast(l_quantity as bigint) as e from lineitem), w as (select *, max(e) over (partition by l_suppkey order by s, e rows between unbounded preceding and 1 preceding) as b from r) select l_suppkey, b as gap_start, s as gap_stop from w where s > b")
def range_gaps(spark, d):
    r = table(spark, d, "lineitem").select("l_suppkey", F.col("l_partkey").alias("s"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("e"))
    return frames.gaps(r, "l_suppkey", "s", "e")


@query("with w as (select event_id, user_id, count(*) over (partition by user_id order by ts range between interval 3600 seconds preceding and current row) as recent from events) select * from w where recent > 2")
def rate_limit_bursts(spark, d):
    return reports.bursts(table(spark, d, "events").select("event_id", "user_id", "ts"), 3600, 2)


@query("select p_partkey, row_number() over (order by sha256('salt:' || p_partkey), p_partkey) as rank from part")
def catalog_hash_order(spark, d):
    return planning.hash_order(table(spark, d, "part"), "p_partkey", "salt:")


@query(f"select 'ids_unique' as check_name, count(*) = count(distinct doc_id) as passed from documents union all select 'text_not_empty', count(*) filter (where coalesce(trim(text), '') = '') = 0 from documents union all select 'no_exact_duplicates', count(*) = count(distinct {FP.format('text')}) from documents union all select 'no_toxic_label', count(*) filter (where toxic = 1) = 0 from labels")
def publish_gate(spark, d):
    docs = _docs(spark, d)
    once = lambda c: (F.max("n") == 1, c)
    repeated = lambda c: docs.groupBy(c.alias("k")).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(1)) == 1)
    return planning.gate({
        "ids_unique": repeated(F.col("doc_id")),
        "text_not_empty": docs.agg(F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "") == 0),
        "no_exact_duplicates": repeated(tx.fingerprint(F.col("text"))),
        "no_toxic_label": table(spark, d, "labels").agg(F.count_if(F.col("toxic") == 1) == 0),
    })


@query("with o as (select source, count(*) as n from documents where lang <> 'es' group by 1), n as (select source, count(*) as n from documents group by 1) select coalesce(o.source, n.source) as source, o.n as old_value, n.n as new_value from o full join n on o.source = n.source where o.n is distinct from n.n")
def stale_report_diff(spark, d):
    count = lambda x: x.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    docs = _docs(spark, d)
    return planning.changed(count(docs.where("lang <> 'es'")), count(docs), "source", "n")


@query("with t as (select lang, cast(sum(greatest(1, ceil(length(text) / 4.0))) as bigint) as tokens from documents group by lang), p(model, price_in, price_out) as (values ('small', 0.15, 0.6), ('large', 3.0, 15.0)) select lang, model, tokens, round((tokens * cast(price_in as double) + tokens * cast(price_out as double)) / 1000000, 6) as cost from t, p")
def cost_scenarios(spark, d):
    tokens = _docs(spark, d).groupBy("lang").agg(F.sum(tx.token_estimate(F.col("text"))).alias("tokens"))
    prices = {"small": (0.15, 0.6), "large": (3.0, 15.0)}
    each = [F.struct(F.lit(m).alias("model"), F.col("tokens").alias("tokens"), planning.cost(F.col("tokens"), F.col("tokens"), a, b).alias("cost")) for m, (a, b) in prices.items()]
    return tokens.select("lang", F.inline(F.array(*each)))


@query(f"{FIRST} select doc_id, case when coalesce(trim(text), '') = '' then 'empty_text' when not one then 'exact_duplicate' else 'ok' end as verdict from f")
def public_audit(spark, d):
    got = dedup.first_wins(_docs(spark, d).select("doc_id", "text"), _key(), "doc_id")
    return got.select("doc_id", F.when(F.coalesce(F.trim("text"), F.lit("")) == "", "empty_text").when(F.col("status") == "duplicate", "exact_duplicate").otherwise("ok").alias("verdict"))


VALID_SOURCE = "^src[0-9]+$"
#: The audit's verdicts by rank, the first that holds; a copy and a near copy are of an earlier row.
AUDIT = f"""with {SETS.format(0.80)}, near as (select distinct v as doc_id from e),
k as (select *, {FP.format('text')} as h, count(*) over (partition by doc_id) as ids, min(doc_id) over (partition by {FP.format('text')}) as m from documents),
audit as (select k.doc_id, case when k.doc_id is null or ids > 1 then 'duplicate_id' when coalesce(trim(text), '') = '' then 'empty_text'
  when not coalesce(regexp_matches(source, '{VALID_SOURCE}'), false) then 'invalid_source' when m <> k.doc_id then 'exact_duplicate' when near.doc_id is not null then 'near_duplicate' else 'ok' end as verdict
from k left join near on k.doc_id = near.doc_id)"""


@query(f"{AUDIT} select * from audit")
def public_audit_full(spark, d):
    docs = _docs(spark, d)
    # A copy is near its first; a first is near an earlier row if and only if it is near an earlier first.
    pairs, copies = _classes(spark, d)
    near = pairs.select(F.col("v").alias("doc_id")).union(copies.select("id")).distinct().withColumn("near", F.lit(True))
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("ids")).where("ids > 1")
    # What the verdict asks of a text and a source goes on, they do not.
    blank, valid = F.coalesce(F.trim("text"), F.lit("")) == "", F.coalesce(F.col("source").rlike(VALID_SOURCE), F.lit(False))
    asked = docs.select("doc_id", tx.fingerprint(F.col("text")).alias("key"), blank.alias("blank"), valid.alias("valid"))
    with shuffles_end(spark):
        first = dedup.first_wins(asked, F.col("key"), "doc_id")
    got = first.join(repeated, "doc_id", "left").join(near, "doc_id", "left")
    verdict = (
        F.when(F.col("doc_id").isNull() | F.col("ids").isNotNull(), "duplicate_id")
        .when(F.col("blank"), "empty_text")
        .when(~F.col("valid"), "invalid_source")
        .when(F.col("matched").isNotNull(), "exact_duplicate")
        .when(F.col("near"), "near_duplicate")
        .otherwise("ok")
    )
    return got.select("doc_id", verdict.alias("verdict"))


@query(f"{AUDIT} select 'no_' || c as check_name, count(*) filter (where verdict = c) = 0 as passed from (values ('duplicate_id'), ('empty_text'), ('invalid_source'), ('exact_duplicate'), ('near_duplicate')) t(c), audit group by c union all select 'no_toxic_label', count(*) filter (where toxic = 1) = 0 from labels")
def publish_gate_full(spark, d):
    verdicts = public_audit_full(spark, d)
    with shuffles_end(spark):
        audit = materialise(verdicts, "audit")
    checks = {f"no_{c}": audit.agg(F.count_if(F.col("verdict") == c) == 0) for c in ("duplicate_id", "empty_text", "invalid_source", "exact_duplicate", "near_duplicate")}
    return planning.gate(checks | {"no_toxic_label": table(spark, d, "labels").agg(F.count_if(F.col("toxic") == 1) == 0)})


@query(f"select 'id' as key_kind, cast(count(*) - count(distinct doc_id) as bigint) as extra from documents union all select 'text', cast(count(*) - count(distinct text) as bigint) from documents union all select 'normal_text', cast(count(*) - count(distinct {FP.format('text')}) as bigint) from documents")
def prompt_preflight(spark, d):
    docs, out = _docs(spark, d), None
    for kind, key in (("id", F.col("doc_id").cast("string")), ("text", F.sha2(F.col("text").cast("binary"), 256)), ("normal_text", tx.fingerprint(F.col("text")))):
        row = reports.uniqueness(docs, key).select(F.lit(kind).alias("key_kind"), F.col("duplicate_count").alias("extra"))
        out = row if out is None else out.unionByName(row)
    return out


@query("select cast(epoch(time_bucket(interval 1 hour, ts)) as bigint) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def event_windows(spark, d):
    return windowed_counts(table(spark, d, "events"))


@query("select doc_id, 'pretrain_' || substr(sha256(trim(text, ' ')), 1, 24) as public_id from documents")
def public_projection(spark, d):
    return _docs(spark, d).select("doc_id", tx.public_id(F.col("text")).alias("public_id"))


@query(rf"""select sha256(trim(regexp_replace(lower(regexp_replace(regexp_replace(text, '"[^"]*"', '<quoted>', 'g'), '[0-9]+(?:[.,][0-9]+)*', '<num>', 'g')), '[ \t\r\n]+', ' ', 'g'))) as template, count(*) as n, min(doc_id) as first from documents group by 1""")
def template_fingerprints(spark, d):
    return _docs(spark, d).groupBy(F.sha2(tx.template(F.col("text")).cast("binary"), 256).alias("template")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
