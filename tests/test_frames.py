"""Frames that split a key, sweeps, hash trees and stateful streams against loops over the rows; one key has a third of all rows and more."""

import hashlib
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from marlstone.functions.text import normal_space
from marlstone.operators import frames, hashtree
from marlstone.streaming import stateful


@pytest.fixture(scope="module")
def timed():
    rng = random.Random(4)
    rows, i = [], 0
    for key, n in ((1, 140), (2, 60), (None, 40), (3, 1)):
        for _ in range(n):
            rows.append((i, key, rng.choice((rng.randint(0, 500), 77, rng.randint(0, 5000))), rng.randint(1, 9)))
            i += 1
    return rows


SCHEMA = "id long, k long, t long, v long"


def test_last_span_is_that_of_a_loop(spark, timed):
    df = spark.createDataFrame(timed, SCHEMA)
    want = {i: sum(w for _, k2, u, w in timed if k2 == k and t - 40 <= u <= t) for i, k, t, _ in timed}
    for parts in (1, 3, 1000):
        got = frames.within_last(df, "k", "t", 40, {"s": F.sum("v")}, parts)
        assert {r.id: r.s for r in got.collect()} == want and got.count() == len(timed)


def test_ranks_and_last_rows_are_those_of_a_loop(spark, timed):
    df = spark.createDataFrame(timed, SCHEMA)
    ordered = {}
    for i, k, t, v in sorted(timed, key=lambda r: (r[2], r[0])):
        ordered.setdefault(k, []).append((i, t, v))
    ranks = {i: n for rows in ordered.values() for n, (i, _, _) in enumerate(rows)}
    sums = {i: (sum(v for _, _, v in rows[max(0, n - 6) : n + 1]), min(t for _, t, _ in rows[max(0, n - 6) : n + 1])) for rows in ordered.values() for n, (i, _, _) in enumerate(rows)}
    for size in (1, 9, 50_000):
        assert {r.id: r["_rank"] for r in frames.ranked(df, "k", "t", ["id"], size).collect()} == ranks
        some = df.withColumn("t", F.when(F.col("id") % 3 > 0, F.col("t")))
        order = lambda r: (r["t"] is not None, r["t"], r["id"])
        by_key = {}
        for r in sorted(frames.ranked(some, "k", "t", ["id"], size).collect(), key=order):
            by_key.setdefault(r["k"], []).append(r["_rank"])
        assert all(r == list(range(len(r))) for r in by_key.values()) and sum(map(len, by_key.values())) == len(timed)
        got = frames.last_rows(df, "k", "t", ["id"], 7, {"s": F.sum("v"), "low": F.min("t")}, size).collect()
        assert {r.id: (r.s, r.low) for r in got} == sums and len(got) == len(timed)


def ranges_of(rng, n):
    out = []
    for _ in range(n):
        k = rng.choice((1, 1, 1, 2, None))
        a = rng.randint(0, 300)
        out.append((k, a, a + rng.choice((0, 1, 3, 20, 80))))
    return out


def points(rows):
    out = {}
    for k, a, b in rows:
        out.setdefault(k, set()).update(range(a, b))
    return out


def test_uncovered_pieces_are_those_of_single_points(spark):
    rng = random.Random(5)
    for _ in range(3):
        planned, completed = ranges_of(rng, 25), ranges_of(rng, 30)
        planned += planned[:3] + [(9, 5, 5), (8, 10, 90), (8, 20, 30), (7, 0, 3)]
        completed += completed[:3] + [(8, 5, 12), (8, 20, 25), (8, 24, 40), (8, 90, 95), (6, 0, 5)]
        p, c = points(planned), points(completed)
        want = set()
        for k, xs in p.items():
            left = sorted(xs - c.get(k, set()))
            for x in left:
                if x - 1 not in left:
                    want.add((k, x, next(y for y in range(x, 10**6) if y not in left)))
        a, b = (spark.createDataFrame(x, "k long, start long, stop long") for x in (planned, completed))
        for size in (2, 11, 50_000):
            got = [tuple(r) for r in frames.uncovered(a, b, "k", "start", "stop", size).collect()]
            assert sorted(got, key=repr) == sorted(want, key=repr), size
    assert frames.uncovered(a, b.limit(0), "k", "start", "stop").where("k = 8").collect() == [(8, 10, 90)]
    assert frames.uncovered(a.limit(0), b, "k", "start", "stop").count() == 0


def test_gaps_are_those_of_a_loop(spark):
    rng = random.Random(7)
    rows = ranges_of(rng, 40)
    want = []
    for k in (1, 2, None):
        end = None
        for a, b in sorted((a, b) for k2, a, b in rows if k2 == k):
            if end is not None and a > end:
                want.append((k, end, a))
            end = b if end is None else max(end, b)
    df = spark.createDataFrame(rows, "k long, s long, e long")
    for size in (1, 6, 50_000):
        assert sorted(map(tuple, frames.gaps(df, "k", "s", "e", size).collect()), key=repr) == sorted(want, key=repr)
    assert frames.gaps(df.limit(0), "k", "s", "e").count() == 0


def test_one_key_is_dealt_into_many_parts(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    parts = frames.cut_by_range(df.withColumn("k", F.when(F.col("k") < 2, 0).otherwise(F.col("k"))), "k", "t", 100).groupBy("k", "_part").count()
    rows = parts.collect()
    assert len(rows) == 30 and max(r["count"] for r in rows) <= 110
    wide = spark.createDataFrame([(1, -(2**62)), (1, 2**62), (1, 0)], "k long, t long")
    assert sorted(r["_part"] for r in frames.cut_by_range(wide, "k", "t", 1).collect()) == [0, 1, 2]


def plain_root(rows, levels, fan):
    by = {}
    for seq, text in rows:
        if seq is not None:
            by.setdefault(seq, []).append(hashlib.sha256((text or "").encode()).hexdigest())
    now = {}
    for seq, hs in by.items():
        sums = [str(sum(int(h[15 * i : 15 * i + 15], 16) for h in hs)) for i in range(4)]
        now[seq] = hashlib.sha256(",".join([str(len(hs)), *sums]).encode()).hexdigest()
    for _ in range(levels):
        above = {}
        for n, h in now.items():
            above.setdefault(n // fan, []).append((n % fan, h))
        now = {k: hashlib.sha256(",".join(f"{a}:{h}" for a, h in sorted(c)).encode()).hexdigest() for k, c in above.items()}
    return now


def test_hash_tree_and_its_proofs(spark):
    rng = random.Random(9)
    rows = [(i, f"text {i}") for i in rng.sample(range(60), 45)] + [(3, "again"), (3, "again"), (3, None), (None, "lost")]
    df = spark.createDataFrame(rows, "seq long, t string").repartition(3)
    fan, levels = 4, 3
    want = plain_root(rows, levels, fan)
    built = hashtree.tree(df, "seq", F.col("t"), levels, fan)
    assert {r.node: r.h for r in hashtree.root(df, "seq", F.col("t"), levels, fan).collect()} == want and list(want) == [0]
    nodes = {(r.level, r.node): r.h for r in built.collect()}
    assert max(len([1 for (lv, n) in nodes if lv == k and n // fan == p]) for k in range(levels) for p in range(16)) <= fan
    for seq in sorted({s for s, _ in rows if s is not None})[::9]:
        steps = [r.asDict(recursive=True) for r in hashtree.proof(built, seq, levels, fan).collect()]
        assert all(len(s["children"]) <= fan for s in steps)
        assert hashtree.proven(steps, nodes[0, seq]) == want[0] and hashtree.proven(steps, "0" * 64) is None
        steps[0]["children"][0]["h"] = "f" * 64
        assert hashtree.proven(steps, nodes[0, seq]) != want[0]
    changed = spark.createDataFrame([*rows[:-5], (rows[-5][0], "other"), *rows[-4:]], "seq long, t string")
    assert hashtree.root(changed, "seq", F.col("t"), levels, fan).first().h != want[0]
    assert hashtree.root(df.limit(0), "seq", F.col("t"), levels, fan).count() == 0


def arrive(path, name, rows):
    """A file that is newer than those before it: streams take files by their time."""
    n = len(os.listdir(path))
    with open(f"{path}/{name}.json", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    os.utime(f"{path}/{name}.json", (1_700_000_000 + 60 * n,) * 2)


def test_stream_accepts_the_first_of_each_key_and_seals_its_shards(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    os.makedirs(source)
    stream = lambda: spark.readStream.schema("seq long, t string").option("maxFilesPerTrigger", 1).json(source)
    run = lambda: stateful.accept_stream(stream(), normal_space(F.col("t")), "seq", out, checkpoint).awaitTermination()
    arrive(source, "a", [{"seq": 5, "t": "One"}, {"seq": 2, "t": "one "}, {"seq": 2, "t": "one "}, {"seq": 9, "t": None}, {"seq": 9, "t": None}])
    run()
    rows = lambda: sorted(((r.seq, r.t) for r in spark.read.parquet(out).collect()), key=repr)
    assert rows() == [(2, "one "), (9, None), (9, None)]
    sealed = stateful.manifest(spark, out).collect()
    assert sum(r.n_rows for r in sealed) == 3
    for r in sealed:
        data = open(f"{out}/{r.shard}", "rb").read()
        assert (hashlib.sha256(data).hexdigest(), len(data)) == (r.sha256, r.n_bytes)
    sealed = spark.createDataFrame(sealed)
    arrive(source, "b", [{"seq": 1, "t": "ONE"}, {"seq": 7, "t": "two"}, {"seq": 7, "t": "two"}, {"seq": 6, "t": "Two"}])
    run()
    run()  # nothing new: nothing changes
    assert rows() == [(2, "one "), (6, "Two"), (9, None), (9, None)]
    assert stateful.damaged(stateful.shards(spark, out), sealed).count() == 0
    full = sorted(sealed.where("n_rows > 0").collect(), key=lambda r: r.shard)[0].shard
    os.remove(f"{out}/.{full}.crc")  # a store that keeps no sums of its own
    with open(f"{out}/{full}", "rb+") as f:
        f.seek(30)
        byte = f.read(1)
        f.seek(30)
        f.write(bytes([byte[0] ^ 1]))
    found = stateful.shards(spark, out)
    assert [tuple(r) for r in stateful.damaged(found, sealed).collect()] == [(full, "changed")]
    assert {r.issue for r in stateful.damaged(found.limit(0), sealed).collect()} == {"missing"}


EVENTS = "event_id long, user_id long, ts timestamp, event_type string, value double"


def test_sessions_and_sliding_windows_of_a_stream_are_those_of_the_table(spark, tmp_path):
    at = lambda m: f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
    rows = [(1, 1, 0), (2, 1, 20), (3, 1, 50), (4, 1, 49), (5, 2, 10), (6, 2, 41), (7, 1, 200), (8, 2, 205)]
    first = [{"event_id": i, "user_id": u, "ts": at(m), "event_type": "ab"[i % 2], "value": i / 4} for i, u, m in rows]
    source = str(tmp_path / "in")
    os.makedirs(source)
    arrive(source, "a", first[:5] + first[:2])
    table = spark.createDataFrame([(r["event_id"], r["user_id"], r["ts"], r["event_type"], r["value"]) for r in first + first[3:6]], EVENTS.replace("ts timestamp", "ts string"))
    table = table.withColumn("ts", F.col("ts").cast("timestamp"))

    def streamed(job, name):
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(source)
        q = job(stream).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        return {tuple(r) for r in spark.table(name).collect()}

    last = [{"event_id": 90, "user_id": 9, "ts": at(1200), "event_type": "a", "value": 1.0}]
    late = [{"event_id": 91, "user_id": 1, "ts": at(30), "event_type": "a", "value": 9.0}]
    for n, more in enumerate((first[5:] + first[6:], last, late, [{**last[0], "event_id": 92, "ts": at(1201)}])):
        arrive(source, f"b{n}", more)
    for job, name in ((stateful.sessions, "held_sessions"), (stateful.sliding, "held_slides")):
        got, want = streamed(job, name), {tuple(r) for r in job(table).collect()}
        assert got == want and want
    micros = lambda m: 1704067200_000_000 + m * 60_000_000
    assert (1, micros(0), micros(80), 4, 2.5) in {tuple(r) for r in stateful.sessions(table).collect()}
    assert {(r.user_id, r.n) for r in stateful.sessions(table).collect()} == {(1, 4), (2, 1), (1, 1)}


def test_small_keys_are_swept_in_one_shuffle(spark):
    """Keys below part_rows are not cut; beside a large key, a null one and a small one all answer as one sweep of each would."""
    rows = [("big", i * 3, i * 3 + (2 if i % 4 else 5)) for i in range(60)] + [("few", 1, 4), ("few", 2, 3), ("few", 9, 12), (None, 5, 6), (None, 8, 9)]
    df = spark.createDataFrame(rows, "k string, s long, e long")
    want = set()
    for k in {r[0] for r in rows}:
        end = None
        for _, s, e in sorted(r for r in rows if r[0] == k):
            if end is not None and s > end:
                want.add((k, end, s))
            end = e if end is None else max(end, e)
    assert {tuple(r) for r in frames.gaps(df, "k", "s", "e", 20).collect()} == want
    assert {tuple(r) for r in frames.gaps(df, "k", "s", "e").collect()} == want
    plan = frames.gaps(df, "k", "s", "e")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
