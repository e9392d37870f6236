"""Acceptance summaries, folded keys, public metadata and files on small tables with nulls, repeats and empty inputs."""

import json
import re
import unicodedata

from pyspark.sql import functions as F

from marlstone import queries, record_queries, report_queries  # noqa: F401
from marlstone.functions import casefold, metadata
from marlstone.operators import acceptance
from marlstone.sources import files, jsonl


def plain_prompt_key(t):
    t = unicodedata.normalize("NFKC", t).casefold()
    for a, b in (("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'")):
        t = t.replace(a, b)
    t = " ".join(t.split())
    for pattern, new in ((r"\s+([,.;:!?])", r"\1"), (r"([([{])\s+", r"\1"), (r"\s+([)\]}])", r"\1"), (r"\s*([+*/=])\s*", r"\1")):
        t = re.sub(pattern, new, t)
    return t.strip(" \t\r\n\"'`.,;:!?")


def test_folded_keys(spark):
    texts = ["", " A  b\tC ", "ﬁne Straße ＡＢＣ", "“Quoted” , ‘so’ !", "( a + b ) = [ c ]", "x y z", "...", "1 * 2 / 3 ?", "İstanbul ΣΑΣ", "a " * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    got = df.select("i", casefold.folded_key(F.col("t")).alias("k"), casefold.prompt_key(F.col("t")).alias("p")).orderBy("i").collect()
    assert [r.k for r in got] == [" ".join(unicodedata.normalize("NFKC", t).casefold().split()) for t in texts] + [None]
    assert [r.p for r in got] == [plain_prompt_key(t) for t in texts] + [None]
    assert df.limit(0).select(casefold.prompt_key(F.col("t"))).count() == 0


def test_public_metadata(spark):
    rows = [("arithmetic", "3 × 4"), ("arithmetic", "how many are left"), ("arithmetic", "8-2"), ("code", "f"), ("factual_restraint", "in the FUTURE"), ("planning", "x"), ("none", "x"), (None, "x"), ("code", None), ("code", "  ")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s string, p string")
    got = [tuple(r.m) if r.m else None for r in df.select("i", metadata.public_metadata(F.col("s"), F.col("p")).alias("m")).orderBy("i").collect()]
    assert got == [
        ("direct_arithmetic", 1, "integer_multiplication", "basic_arithmetic_qa"), ("word_problem_arithmetic", 1, "arithmetic_word_problem", "basic_arithmetic_qa"), ("direct_arithmetic", 1, "integer_subtraction", "direct_subtraction"),
        ("code_generation", 2, "python_function_generation", "code_generation_function"), ("future_event_restraint", 2, "factual_restraint", None), ("general_instruction_following", 2, "operational_planning_checklist", None), None, None, None, None,
    ]


def test_rejection_reasons_count_each_held_key(spark):
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "b", "x"), (5, "b", "y"), (6, None, None), (7, None, None)]
    df = spark.createDataFrame(rows, "n long, p string, c string")
    seen, want = set(), {}
    for _, p, c in rows:
        hit = [(k, v) for k, v in (("p", p), ("c", c)) if v is not None and (k, v) in seen]
        for k, _v in hit:
            want[k] = want.get(k, 0) + 1
        if not hit:
            seen |= {("p", p), ("c", c)}
    keys = {"p": F.col("p"), "c": F.col("c")}
    assert {r.reason: r.n for r in acceptance.rejection_reasons(df, "n", keys).collect()} == want
    assert acceptance.rejection_reasons(df.limit(0), "n", keys).count() == 0


def test_summaries_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([("a", "k", 1, True), ("a", "k", 2, True), ("a", None, 3, False), (None, "k", 4, True)], "g string, m string, n long, ok boolean")
    got = {r.g: (r.n, r.merged, r.ok) for r in acceptance.merged_results(df, "g", "m", "n", "ok").collect()}
    assert got == {"a": (6, "k=3,null=3", False), None: (4, "k=4", True)}
    assert acceptance.same_counts(df.select("m", "n").limit(0), df.select("m", "n").limit(0), "m").first().same
    assert not acceptance.same_counts(df.select("m", "n"), df.where("m is not null").select("m", "n"), "m").first().same
    assert {r.kind: (r.total, r.unique_count) for r in acceptance.content_summary(df, {"m": F.col("m"), "g": F.col("g")}).collect()} == {"m": (3, 1), "g": (3, 1)}
    report = {r.g: (r.n_rows, r.unique_exact, r.families, r.largest_share) for r in acceptance.structure_report(df, "g", F.col("n"), F.col("m"), "m").collect()}
    assert report == {"a": (3, 3, 2, 0.666667), None: (1, 1, 1, 1.0)}
    assert acceptance.capacity(df.limit(0), "g", F.col("m"), F.col("n"), 1).count() == 0
    assert acceptance.blockers(("x", df.agg(F.lit(0).alias("n"))), ("y", df.agg(F.count(F.lit(1)).alias("n")))).collect() == [("y", 4)]


def test_files_are_found_and_told_apart(spark, tmp_path):
    (tmp_path / "inner").mkdir()
    for name in ("a.jsonl", "b.run.jsonl", "b.batch1.jsonl", "inner/c.jsonl", "note.txt"):
        (tmp_path / name).write_text("{}\n")
    got = {r.file.rsplit("/", 1)[1]: (r.dataset, r.bytes, r.issue) for r in files.discover(spark, str(tmp_path)).collect()}
    assert got == {"a.jsonl": ("a", 3, None), "b.run.jsonl": ("b", 3, None), "b.batch1.jsonl": ("b", 3, "batch"), "c.jsonl": ("c", 3, "nested")}


def test_manifests_say_what_is_wrong(spark, tmp_path):
    for name, text in (("a", json.dumps({"metadata": {"n": 3}, "other": [1]}, indent=1)), ("b", "{"), ("c", '{"x": 1}')):
        (tmp_path / f"{name}.json").write_text(text)
    got = {r.file.rsplit("/", 1)[1]: (r.metadata and r.metadata.n, r.issue) for r in files.manifests(spark, str(tmp_path), "n: long").collect()}
    assert got == {"a.json": (3, None), "b.json": (None, "bad_json"), "c.json": (None, "no_metadata")}


def test_consolidation_counts_what_was_written(spark, tmp_path):
    rows = spark.createDataFrame([("x", 1), ("x", 1), ("y", 2)], "g string, v long")
    expected = spark.createDataFrame([("x", 2), ("y", 3), ("z", 1)], "g string, expected long")
    out = str(tmp_path / "out")
    assert {tuple(r) for r in files.consolidate(rows, expected, "g", out).collect()} == {("y", 3, 1), ("z", 1, None)}
    assert sorted(r.v for r in jsonl.read_strict(spark, f"{out}/g=x", "v long").collect()) == [1, 1]


def test_rejected_rows_keep_spec_and_decision(spark, tmp_path):
    specs = spark.createDataFrame([(1, "s1")], "id long, spec_name string")
    rows = spark.createDataFrame([(1, "t1"), (2, "t2")], "id long, text string")
    decisions = spark.createDataFrame([(1, "reject"), (2, "keep"), (3, "reject"), (None, "reject")], "id long, decision string")
    got = {r.id: (r.spec, r.row, r.decision) for r in files.rejected_audit(specs, rows, decisions, "id", F.col("decision") == "reject").collect()}
    lost = '{"decision":"reject"}'
    assert got == {1: ('{"spec_name":"s1"}', '{"text":"t1"}', lost), 3: (None, None, lost), None: (None, None, lost)}
    run = files.write_manifest(rows.groupBy().count(), str(tmp_path / "m"), kind="sft")
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "m")).select("count", "kind", "run_id").collect()] == [(2, "sft", run)]


def test_acceptance_checks_each_pair_once_on_all_cores(spark):
    """All counts come from written groups, not from three scans of the pairs; the pairs are dealt over all cores, however few parts their file has."""
    plan = queries.QUERIES["dataset_acceptance"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" not in plan and "regexp" not in plan, plan
    assert record_queries._made(spark, "/root/testdata/sf0.001", "pair").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
