"""Greedy acceptance on small tables, against a loop over the rows."""

import os
import random

import pyarrow as pa
from pyspark.sql import functions as F

from marlstone.functions.text import normal_space
from marlstone.operators import dedup, similarity
from marlstone.sources.shared import shuffles_end


def by_loop(rows):
    kept, out = [], {}
    for i, *keys in sorted(rows):
        hit = [j for j, *other in kept if any(a is not None and a == b for a, b in zip(keys, other))]
        out[i] = min(hit, default=None)
        if not hit:
            kept.append((i, *keys))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "id long, a string, b string")
    got = dedup.greedy_accept(df, "id", *dedup.key_conflicts(df, "id", [F.col("a"), F.col("b")]))
    assert {r["id"]: r.matched for r in got.collect()} == by_loop(rows)
    assert all((r.status == "accepted") == (r.matched is None) for r in got.collect())


def test_copy_of_a_rejected_first_is_rejected_by_the_same_row(spark):
    check(spark, [(1, "x", "p"), (2, "y", "p"), (3, "y", "p"), (4, "y", "q"), (5, "y", "q")])


def test_null_keys_conflict_with_nothing(spark):
    check(spark, [(1, None, None), (2, None, None), (3, "x", None), (4, "x", None), (5, None, "p"), (6, "x", "p")])


def test_no_rows(spark):
    check(spark, [])


def test_pairs_of_equal_sets_come_from_their_firsts(spark):
    """Whatever is collapsed, all pairs return; empty and null sets have none."""
    base = list(range(20))
    sets = {1: base, 2: base[::-1], 3: base[:-1] + [99], 4: base, 5: [], 6: [], 7: None, 8: [7], 9: [7], 10: base[:-1] + [99], 11: list(range(40, 50))}
    df = spark.createDataFrame([(i, s) for i, s in sets.items()], "id long, s array<bigint>")
    want = set()
    for u in sets:
        for v in sets:
            a, b = set(sets[u] or ()), set(sets[v] or ())
            if u < v and a and b and len(a & b) / len(a | b) >= 0.8:
                want.add((u, v, len(a & b), len(a | b)))
    pairs, copies = similarity.jaccard_classes(df, "id", "s", 0.8)
    assert sorted((r.id, r["first"]) for r in copies.collect()) == [(2, 1), (4, 1), (9, 8), (10, 3)]
    assert [(r.u, r.v) for r in pairs.collect()] == [(1, 3)]
    got = [tuple(r) for r in similarity.expanded(pairs, copies).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {tuple(r) for r in similarity.jaccard_pairs(df, "id", "s", 0.8).collect()} == want
    none, no_copies = similarity.jaccard_classes(df.limit(0), "id", "s", 0.8)
    assert similarity.expanded(none, no_copies).count() == 0


def test_first_wins_accepts_one_of_repeated_rows(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "A ", "y"), (2, "a", "x"), (3, "b", "z"), (3, "b", "z"), (3, "b", "z"), (4, None, "n"), (4, None, "n"), (None, "c", "x"), (7, "c", "x")]
    df = spark.createDataFrame(rows, "id long, t string, more string").repartition(3)
    got = dedup.first_wins(df, normal_space(F.col("t")), "id").collect()
    accepted = sorted([(r.id, (r.t or "").strip().lower()) for r in got if r.status == "accepted"], key=repr)
    assert accepted == sorted([(1, "a"), (3, "b"), (4, ""), (4, ""), (None, "c")], key=repr)
    assert sorted([(r.id, r.matched) for r in got if r.status == "duplicate"], key=repr) == sorted([(1, 1), (1, 1), (2, 1), (3, 3), (3, 3), (7, None)], key=repr)


def test_repeated_ids_lose_no_link(spark):
    a, b = list(range(100, 120)), list(range(200, 220))
    rows = [(1, a), (5, a), (5, b), (7, b[:-1] + [9]), (8, b), (9, b), (9, b)]
    pairs, copies = similarity.jaccard_classes(spark.createDataFrame(rows, "id long, s array<bigint>"), "id", "s", 0.8)
    assert {tuple(r) for r in pairs.collect()} == {(5, 7, 19, 21)}
    assert sorted(map(tuple, copies.collect())) == [(5, 1, 20), (8, 5, 20), (9, 5, 20), (9, 5, 20)]


def test_sets_are_not_written_and_all_pairs_are_found(spark, monkeypatch):
    """Of many sets that share passages only the near ones are written whole; the pairs are those of all against all."""
    rng = random.Random(5)
    passages = [[rng.getrandbits(62) for _ in range(40)] for _ in range(30)]
    sets = {i: [x for p in rng.sample(passages, 6) for x in p] + [rng.getrandbits(62) for _ in range(60)] for i in range(200)}
    for i in range(200, 240):
        s = sets[i - 200]
        sets[i] = s[: len(s) - i % 40] + [rng.getrandbits(62) for _ in range(i % 40)]
    sets |= {240: sets[0], 241: sets[0], 242: [1], 243: [1], 244: list(range(5000)), 245: list(range(600, 5000))}
    want = set()
    for u in sets:
        for v in sets:
            if u < v and len(set(sets[u]) & set(sets[v])) >= 0.8 * len(set(sets[u]) | set(sets[v])):
                want.add((u, v, len(set(sets[u]) & set(sets[v])), len(set(sets[u]) | set(sets[v]))))
    items = {}
    real = similarity.materialise

    def noted(df, tag):
        items[tag] = real(df, tag)
        return items[tag]

    monkeypatch.setattr(similarity, "materialise", noted)
    df = spark.createDataFrame(list(sets.items()), "id long, s array<bigint>")
    pairs, copies = similarity.jaccard_classes(df, "id", "s", 0.8)
    assert {tuple(r) for r in similarity.expanded(pairs, copies).collect()} == want and len(want) > 40
    whole = [r[0] for r in items["jaccard-firsts"].select(F.size("s")).collect()]
    assert sum(whole) < 0.5 * sum(map(len, sets.values())) and "jaccard-sets" not in items


def test_bitmaps_of_repeated_rows_rule_nothing_out(spark):
    s = list(range(100, 140))
    rows = [(1, s), (1, s), (2, s[:-1] + [7]), (3, s[2:]), (3, s[2:])]
    pairs, _ = similarity.jaccard_classes(spark.createDataFrame(rows, "id long, s array<bigint>"), "id", "s", 0.8)
    assert {tuple(r) for r in pairs.collect()} == {(1, 2, 39, 41), (1, 3, 38, 40), (2, 3, 37, 41)}


def near(sets, threshold=0.8):
    out = set()
    for u in sets:
        for v in sets:
            if u < v:
                both = len(set(sets[u]) & set(sets[v]))
                if both >= threshold * (total := len(set(sets[u]) | set(sets[v]))):
                    out.add((u, v, both, total))
    return out


def tables_of(monkeypatch):
    """Rows of each table that the join writes, summed by tag."""
    rows, real = {}, similarity.materialise

    def noted(df, tag):
        out = real(df, tag)
        rows[tag] = rows.get(tag, 0) + out.count()
        return out

    monkeypatch.setattr(similarity, "materialise", noted)
    return rows


def test_a_set_is_sent_once_for_its_near_copies(spark, monkeypatch):
    """A group's sets go to few tiles, not to each pair of the group; its pairs are made about once, not for each shared item."""
    rng = random.Random(3)
    base = [rng.getrandbits(62) for _ in range(120)]
    sets = {i: base[i % 7 :] + [rng.getrandbits(62) for _ in range(rng.randrange(4, 14))] for i in range(70)}
    want, rows = near(sets), tables_of(monkeypatch)
    pairs, copies = similarity.jaccard_classes(spark.createDataFrame(list(sets.items()), "id long, s array<bigint>"), "id", "s", 0.8)
    assert {tuple(r) for r in pairs.collect()} == want and len(want) > 1000 and copies.count() == 0
    assert rows["jaccard-sent"] < 12 * len(sets) and rows["jaccard-near"] < 1.2 * len(want)


def test_unrelated_sets_of_a_frequent_passage_are_not_listed(spark, monkeypatch):
    """Pairs that share a frequent item are held against the bitmaps before they are written; those of sets of any size are found."""
    rng = random.Random(4)
    made = lambda n: [rng.getrandbits(62) for _ in range(n)]
    line = list(range(-(1 << 62), -(1 << 62) + 30))  # the smallest items, so that prefixes hold them
    monkeypatch.setattr(similarity, "FREQUENT", 0)
    sets = {i: line + made(100) for i in range(120)}
    for k, n in enumerate((1300, 1480, 1700, 4000)):
        long = made(n)
        sets |= {1000 * (k + 1) + i: line + long[i:] + made(rng.randrange(n // 5)) for i in range(11)}
    want, rows = near(sets), tables_of(monkeypatch)
    pairs = similarity.jaccard_classes(spark.createDataFrame(list(sets.items()), "id long, s array<bigint>"), "id", "s", 0.8)[0]
    assert {tuple(r) for r in pairs.collect()} == want and len({u // 1000 for u, *_ in want}) == 4
    assert rows["jaccard-candidates"] + rows["jaccard-near"] < 2 * len(want)


def test_pairs_of_sets_that_share_a_name_are_all_counted():
    sets = pa.table({"key": [0] * 4, "c": [5, 3, 5, 9], "id": [1, 2, 4, 7], "s": pa.array([[1, 2, 3, 4], [1, 2, 3, 4, 5], [8], [1, 2, 3, 5]], pa.list_(pa.int64()))})
    pairs = pa.table({"key": [0, 0, 0], "u": [3, 5, 3], "v": [5, 9, 9]})
    got = similarity._counted(0.6)(pairs, sets)
    assert sorted(zip(*(c.to_pylist() for c in got.columns), strict=True)) == [(1, 7, 3, 5), (2, 1, 4, 5), (2, 7, 4, 5)]
    assert similarity._counted(0.6)(pairs.slice(0, 0), sets).num_rows == similarity._counted(0.6)(pairs, sets.slice(0, 0)).num_rows == 0


def test_shuffle_files_end_with_their_statement(spark, tmp_path):
    held = lambda: sum(f.startswith("shuffle_") for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString() for _, _, names in os.walk(d) for f in names)
    key, df = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark.range(1000).repartition(3, "id").repartition(5)
    before, files = spark.conf.get(key), held()
    with shuffles_end(spark):
        df.write.parquet(str(tmp_path / "one"))
    assert held() <= files and spark.conf.get(key) == before and spark.read.parquet(str(tmp_path / "one")).count() == 1000
    df.write.parquet(str(tmp_path / "two"))
    assert held() > files
