"""Queries on ordered keys that are cut into parts, on hash trees and on sessions, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import acceptance, frames, hashtree
from .queries import query
from .sources.shared import table
from .streaming import stateful

PLAN_WIDTH = 40


@query(f"""with p as (select distinct l_suppkey, unnest(range(l_partkey, l_partkey + {PLAN_WIDTH})) as x from lineitem where l_returnflag <> 'R'),
c as (select distinct l_suppkey, unnest(range(l_partkey, l_partkey + cast(l_quantity as bigint))) as x from lineitem where l_returnflag <> 'A'),
o as (select * from p except select * from c), g as (select *, x - row_number() over (partition by l_suppkey order by x) as island from o)
select l_suppkey, cast(min(x) as bigint) as start, cast(max(x) + 1 as bigint) as stop from g group by l_suppkey, island""")
def planned_ranges_open(spark, d):
    """What is planned and not completed, of ranges that overlap and nest; the SQL goes through every single index."""
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", F.col("l_partkey").alias("start"), F.col("l_quantity").cast("long").alias("n"))
    planned = lines.where("l_returnflag <> 'R'").select("l_suppkey", "start", (F.col("start") + PLAN_WIDTH).alias("stop"))
    completed = lines.where("l_returnflag <> 'A'").select("l_suppkey", "start", (F.col("start") + F.col("n")).alias("stop"))
    return frames.uncovered(planned, completed, "l_suppkey", "start", "stop")


@query("""select event_id, user_id, count(*) over w as recent, count(*) filter (where event_type = 'error') over w as errors, cast(date_diff('microsecond', min(ts) over w, ts) as bigint) as span
from events window w as (partition by user_id order by ts, event_id rows between 59 preceding and current row)""")
def last_sixty(spark, d):
    """A user's last 60 events at each: how many, how many errors, and how long they took."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    over = {"recent": F.count(F.lit(1)), "errors": F.count_if(F.col("event_type") == "error"), "began": F.min("us")}
    out = frames.last_rows(events, "user_id", "us", ["event_id"], 60, over)
    return out.select("event_id", "user_id", "recent", "errors", (F.col("us") - F.col("began")).alias("span"))


#: Documents are leaf doc_id; a tree of this height holds so many.
HEIGHT = 4
HALVES = ", ".join(f"cast(sum(cast(('0x' || h[{1 + 15 * i}:{15 + 15 * i}])::bigint as hugeint)) as varchar) as s{i}" for i in range(4))
LEVEL = "select node // {f} as node, sha256(string_agg(cast(node % {f} as varchar) || ':' || h, ',' order by node % {f})) as h from {t} group by 1"


@query(f"""with r as (select doc_id, sha256(coalesce(text, '')) as h from documents where doc_id is not null), s as (select doc_id as node, {HALVES}, cast(count(*) as varchar) as n from r group by 1),
l0 as (select node, sha256(concat_ws(',', n, s0, s1, s2, s3)) as h from s), {', '.join(f"l{k} as ({LEVEL.format(f=hashtree.FAN, t=f'l{k - 1}')})" for k in range(1, HEIGHT + 1))}
select cast(node as bigint) as node, h from l{HEIGHT}""")
def fingerprint_tree(spark, d) -> DataFrame:
    return hashtree.root(table(spark, d, "documents").select("doc_id", "text"), "doc_id", F.col("text"), HEIGHT)


@query("""with e as (select *, case when ts >= lag(ts) over (partition by user_id order by ts, event_id) + interval 30 minutes then 1 else 0 end as fresh from events),
s as (select *, sum(fresh) over (partition by user_id order by ts, event_id) as k from e)
select user_id, cast(epoch_us(min(ts)) as bigint) as start, cast(epoch_us(max(ts) + interval 30 minutes) as bigint) as stop, count(*) as n, round(sum(value), 4) as total from s group by user_id, k""")
def user_sessions(spark, d):
    return stateful.sessions(table(spark, d, "events"))


@query("""select event_type, cast(epoch(w) as bigint) as start, count(*) as n, max(value) as highest
from (select *, unnest([time_bucket(interval 15 minutes, ts) - k * interval 15 minutes for k in range(4)]) as w from events) group by all""")
def sliding_windows(spark, d):
    return stateful.sliding(table(spark, d, "events"))


SURFACE = "trim(regexp_replace(lower(regexp_replace(p_name, ' .*', '')), '[^a-z]+', ' '{g}))"


@query(f"""with r as (select p_brand as grp, case when p_partkey % 11 = 0 then ' ' when p_partkey % 3 = 0 then replace(p_name, ' ', '_') || '_' || p_size else p_name || ' of ' || p_brand end as key, p_type as t, p_size % 5 = 0 as call, p_size % 2 = 0 as tools, {SURFACE.format(g=", 'g'")} as surface from part),
g as (select grp, count(*) as n from r group by grp), m as (select grp, max(n) as most from (select grp, t, count(*) as n from r group by grp, t) group by grp)
select grp as "group", null as key, 'too_few_sources' as issue from g where n < 3 union all select grp, null, 'concentrated_template' from g join m using (grp) where most > 0.4 * n
union all select grp, key, 'missing_key' from r where trim(key) = '' union all select grp, key, 'numbered_variant' from r where regexp_matches(trim(key), '(?:_|-)(?:variant|version|style|tone)?[0-9]+$')
union all select grp, key, 'tool_call_without_tools' from r where call and not tools union all select grp, key, 'repeated_key' from r where trim(key) <> '' and key in (select key from r group by key having count(*) > 1)
union all select grp, key, 'superficial_copy' from r where surface in (select surface from r group by surface having count(*) > 1)""")
def source_inventory(spark, d):
    """Parts as sources: brands as groups, types as templates, names as surfaces."""
    key = "case when p_partkey % 11 = 0 then ' ' when p_partkey % 3 = 0 then concat(replace(p_name, ' ', '_'), '_', p_size) else concat(p_name, ' of ', p_brand) end"
    rows = table(spark, d, "part").selectExpr("p_brand", f"{key} as key", "p_type", "p_size", f"{SURFACE.format(g='')} as surface")
    mode = F.when(F.col("p_size") % 5 == 0, "tool_call").otherwise("text")
    how = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("tool_mediated"))).otherwise(F.array(F.lit("single_turn")))
    return acceptance.source_issues(rows, "p_brand", "key", "p_type", mode, how, F.col("surface"))


@query("""select coalesce(max_by(cast(value * 10 as bigint), event_id), 0) as current, cast(coalesce(max(user_id), 0) as bigint) as maximum, cast(coalesce(min(user_id), 0) as bigint) as minimum, cast(coalesce(min(cast(value as bigint)), 0) as bigint) as observed_minimum,
 cast(coalesce(max(cast(value as bigint)), 0) as bigint) as observed_peak, count(*) filter (where event_type = 'click') as increases, count(*) filter (where event_type = 'error') as decreases, cast(sum(user_id) as bigint) as successes, count(*) as failures from events""")
def controller_totals(spark, d):
    rows = table(spark, d, "events").select("event_id", F.bround(F.col("value") * 10).cast("long").alias("current"), F.col("user_id").alias("maximum"), F.col("user_id").alias("minimum"), F.bround("value").cast("long").alias("observed_minimum"), F.bround("value").cast("long").alias("observed_peak"), (F.col("event_type") == "click").cast("long").alias("increases"), (F.col("event_type") == "error").cast("long").alias("decreases"), F.col("user_id").alias("successes"), F.lit(1).alias("failures"))
    return acceptance.controller_totals(rows, "event_id")
