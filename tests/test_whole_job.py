"""Operators that do the whole job, on small tables with the cases that a narrower one misses."""

import os
import random

from pyspark.sql import functions as F
from test_dedup import by_loop

from marlstone import queries
from marlstone.operators import dedup, reports
from marlstone.sources.shared import shared_dir


def test_multi_key_accept_equals_the_loop(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("abcdefgh") if i % 9 else None, rng.choice("pqrstuvwxyz") if i % 7 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    got = dedup.multi_key_accept(df, "id", [F.col("a"), F.col("b")])
    assert {r["id"]: r.matched for r in got.collect()} == by_loop(rows)
    assert dedup.multi_key_accept(df.limit(0), "id", [F.col("a"), F.col("b")]).count() == 0


def test_conversations_that_open_alike_are_kept(spark, tmp_path):
    """Whole prompts and conversations decide, not their first words; equal prompts with other answers conflict."""
    says = {1: ("tell me a story of a fox", "once"), 2: ("tell me a story of a hen", "once"), 3: ("Tell me  a story of a fox", "twice"), 4: ("tell me a", "once")}
    rows = [(c, t, role, text) for c, (q, a) in says.items() for t, (role, text) in enumerate((("user", q), ("assistant", a)))]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r.matched for r in queries.QUERIES["conversation_multi_key"](spark, str(tmp_path)).collect()}
    assert got == {1: None, 2: None, 3: 1, 4: None}


def test_audit_finds_near_copies_repeated_ids_and_invalid_sources(spark, tmp_path):
    """The audit and the gate see what an audit of empty and exact copies calls ok."""
    body = " ".join(f"w{i}" for i in range(60))
    rows = [(1, body, "src1"), (2, body + " end", "src1"), (3, "one two", "src2"), (3, "three four", "src2"), (4, " ", "src1"), (5, "five six", "bad"), (6, "seven", None), (7, body.upper(), "src3"), (8, "eight", "src1")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = sorted((r.doc_id, r.verdict) for r in queries.QUERIES["public_audit_full"](spark, str(tmp_path)).collect())
    assert got == [(1, "ok"), (2, "near_duplicate"), (3, "duplicate_id"), (3, "duplicate_id"), (4, "empty_text"), (5, "invalid_source"), (6, "invalid_source"), (7, "exact_duplicate"), (8, "ok")]
    gate = {r.check_name: r.passed for r in queries.QUERIES["publish_gate_full"](spark, str(tmp_path)).collect()}
    assert gate == {"no_duplicate_id": False, "no_empty_text": False, "no_invalid_source": False, "no_exact_duplicate": False, "no_near_duplicate": False, "no_toxic_label": True}


def test_every_member_of_a_cluster_is_listed(spark):
    df = spark.createDataFrame([(i, "same") for i in range(12)] + [(20, "other"), (21, "two"), (21, "two")], "doc_id long, text string")
    got = [tuple(r) for r in reports.cluster_members(df, "doc_id", F.col("text")).select("doc_id").collect()]
    assert sorted(got) == [(i,) for i in [*range(12), 21]]
    found = reports.clusters(df, "doc_id", F.col("text"))
    assert sorted(tuple(r)[1:] for r in found.collect()) == [(2, 21, "21"), (12, 0, "0,1,2,3,4")]
    assert "collect_set" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_the_audit_sends_no_texts(spark, tmp_path, monkeypatch):
    """What goes through the audit's joins is what the verdict asks of a text; the verdicts of null and blank texts and sources stay."""
    rows = [(1, "a b", "src1"), (2, None, "src1"), (3, None, "src2"), (4, "  ", "src1"), (5, "A  b", "src9"), (6, "c", None), (None, "d", "src1")]
    spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    seen, real = [], dedup.first_wins
    monkeypatch.setattr(dedup, "first_wins", lambda rows, key, seq: (seen.extend(rows.columns), real(rows, key, seq))[1])
    got = {r.doc_id: r.verdict for r in queries.QUERIES["public_audit_full"](spark, str(tmp_path)).collect()}
    assert got == {1: "ok", 2: "empty_text", 3: "empty_text", 4: "empty_text", 5: "exact_duplicate", 6: "invalid_source", None: "duplicate_id"}
    assert seen and "text" not in seen and "source" not in seen


def test_greedy_rounds_leave_no_edges(spark):
    """Of each round what it rejects stays, not the edges that were left."""
    top = shared_dir(spark).removeprefix("file://")
    tables = lambda: {f for f in os.listdir(top) if f.startswith("greedy-")} if os.path.isdir(top) else set()
    before, n = tables(), 11
    got = dedup.greedy_accept(spark.range(n).withColumnRenamed("id", "i"), "i", spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "u long, v long"))
    assert {r.i: r.matched for r in got.collect()} == {i: i - 1 if i % 2 else None for i in range(n)}
    assert len(tables() - before) <= 2 + n // 2
