"""Contracts, joins of stages, sources and streams on small tables with nulls, repeats and empty inputs."""

import json

from pyspark.sql import functions as F

from marlstone.functions import contracts as ct
from marlstone.operators import dedup, reports
from marlstone.plans import planning
from marlstone.sources import jsonl
from marlstone.streaming import incremental


def issues(spark, f, kinds, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{k} {t}" for k, t in enumerate(kinds)))
    return [r.x for r in df.select("i", f(*[F.col(f"c{k}") for k in range(len(kinds))]).alias("x")).orderBy("i").collect()]


def test_responses(spark):
    rows = [
        ("arithmetic", "What is 3 + 4? Give only the integer result", "7"), ("arithmetic", "What is 3 + 4? Give only the integer result", "It is 7"), ("arithmetic", "9 / 2", "4"), ("arithmetic", "8 / 2", "it is 5"), ("arithmetic", "8 / 0", "none at all"),
        ("code", "Write a Python function", "nothing here"), ("code", "Write a Python function", "def f(x): pass"), ("database", "write a select", "DROP"), ("factual_restraint", "who?", "I cannot say"), ("factual_restraint", "who?", "Ada Byron"),
        ("code", None, None), ("database", "tell me all about the big red tables", "Tell me all about the big red tables ok"), ("code", "x y", "{broken"),
    ]
    assert issues(spark, ct.response, ["string"] * 3, rows) == [
        [], ["arithmetic_non_integer_answer"], [], ["arithmetic_wrong_answer"], [],
        ["code_missing_function_definition"], [], ["database_missing_sql_query"], [], ["factual_restraint_missing_restraint"],
        ["empty_response"], ["repeats_prompt"], ["schema_leakage"],
    ]
    assert issues(spark, ct.machine_verified, ["string"] * 3, rows[:4]) == [True, False, False, False]


def test_word_problems_and_named_functions(spark):
    rows = [
        ("arithmetic", "Ann has 12 pencils and puts them into 4 bags", "It is 3"), ("arithmetic", "It sold 5 morning tickets, 2 left, and 7 afternoon tickets", "11"), ("arithmetic", "6 × 7?", "42"), ("arithmetic", "12 ÷ 5?", "is 2"), ("arithmetic", "12 ÷ 4?", "four"),
        ("arithmetic", "He uses 3 cups of flour for 4 loaves", "13"), ("arithmetic", "Ann has 12 pencils and puts them into 0 bags", "any"), ("code", "Write a Python function named add_up", "def add(x): pass"), ("code", "a function named f", "def g(x): pass\ndef f(): pass"), ("code", "a function named f", "```def g(): pass```"),
        ("code", "x", 'has "role": and "chosen": in it'), ("code", "x", 'has "response" : in it'),
    ]
    assert issues(spark, ct.response, ["string"] * 3, rows) == [
        [], ["arithmetic_wrong_answer"], [], [], ["arithmetic_wrong_answer"], ["arithmetic_wrong_answer"], [], ["code_wrong_function_name"], [], ["markdown_fence"], [], ["schema_leakage"],
    ]
    pairs = [("p", 'has "response": in it', "plain text"), ("p", 'has "role": in it', "plain text"), ("p", "plain text", '"chosen" : 1')]
    assert issues(spark, ct.pair, ["string"] * 3, pairs) == [[], ["schema_leakage"], ["schema_leakage"]]


def test_code_pairs_and_length_of_restraint(spark):
    rows = [("named add", "def add(a): return a", "def add(a: return", "code_syntax_error"), ("named add", "def add(a):", "text", "code_syntax_error"), ("x", "print(1)", None, None), ("is named add", "async def sum(a):\n  return a", "text", "code_logic_error")]
    assert issues(spark, ct.code_pair, ["string"] * 4, rows) == [[], ["chosen_code_signature_only", "rejected_code_not_python_function"], ["chosen_code_missing_function"], ["chosen_code_wrong_function_name"]]
    assert issues(spark, ct.restraint_length, ["string"] * 2, [("private_info_restraint", "no " * 60), ("private_info_restraint", "no " * 61), ("other", "no " * 99), ("private_info_restraint", None)]) == [[], ["chosen_restraint_too_verbose"], [], []]


def test_pairs(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [("p", "yes it is", "no it is not"), ("p", "same  *text*", "Same text"), ("p", "", "b c"), ("p", "x", "7"), ("p", long, long + "."), ("p", '{"id": 1}', "plain"), (None, "a b", None), (long, long, "other")]
    assert issues(spark, ct.pair, ["string"] * 3, rows) == [[], ["identical_pair"], ["empty_pair_text", "too_short_pair_text"], ["too_short_pair_text"], ["non_contrastive_pair"], ["schema_leakage"], ["empty_pair_text", "too_short_pair_text"], ["prompt_copy_pair"]]


def test_choices(spark):
    rows = [(["a", "b", "c", "d"], 0, "x"), (["a", "A ", "c", "d"], 4, ""), (["a", None, "c"], None, None), (None, 1, "x")]
    assert issues(spark, ct.mcq, ["array<string>", "int", "string"], rows) == [[], ["duplicate_choices", "correct_index_out_of_bounds", "empty_explanation"], ["choices_not_four", "empty_choice", "duplicate_choices", "bad_correct_index_type", "empty_explanation"], ["bad_choices"]]
    assert issues(spark, ct.corrected_index, ["array<string>", "string"], [(["a", "B"], "b"), (["a", "a"], "a"), (["a"], None)]) == [1, None, None]


def test_null_keys_are_no_copies(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "A "), (5, "b")], "id long, t string")
    from marlstone.functions.text import normal_space

    got = {r.id: (r.status, r.matched) for r in dedup.first_wins(df, normal_space(F.col("t")), "id").collect()}
    assert got == {1: ("accepted", None), 2: ("accepted", None), 3: ("accepted", None), 4: ("duplicate", 3), 5: ("accepted", None)}
    assert [r.first_member for r in reports.clusters(df, "id", normal_space(F.col("t"))).collect()] == [3]
    assert dedup.first_wins(df.limit(0), F.col("t"), "id").count() == 0


def test_long_chains_of_conflicts_are_decided(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 9)], "u long, v long")
    got = dedup.greedy_accept(spark.range(1, 10).withColumnRenamed("id", "n"), "n", edges).collect()
    assert {r.n for r in got if r.status == "accepted"} == {1, 3, 5, 7, 9}


def test_coverage_and_mismatches(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z"), (None, "n")], "id long, f string")
    b = spark.createDataFrame([(1, "y"), (2, None), (2, None), (4, "w")], "id long, f string")
    assert {r.id: r.status for r in reports.coverage(a, b, "id").collect()} == {1: "matched", 2: "duplicate", 3: "missing", 4: "unexpected", None: "missing"}
    assert {r.id: r.issue for r in reports.field_mismatches(a, b.distinct(), "id", ["f"]).collect()} == {1: "f_mismatch", 3: "missing_spec", 4: "missing_row", None: "missing_spec"}


def test_hash_order_is_a_permutation(spark):
    got = planning.hash_order(spark.range(500), "id", "s:").collect()
    import hashlib

    expected = sorted(range(500), key=lambda i: hashlib.sha256(f"s:{i}".encode()).hexdigest())
    assert [r.id for r in sorted(got, key=lambda r: r.rank)] == expected


def test_jsonl_scan_numbers_lines_and_tags_bad_ones(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n[1]\nnot json\n{"a": 2}\n')
    got = sorted((r.line, tuple(r.issues)) for r in jsonl.scan(spark, str(tmp_path / "a.jsonl")).select("line", "issues").collect())
    assert got == [(1, ()), (2, ("empty_line",)), (3, ("not_object",)), (4, ("bad_json",)), (5, ())]


def test_split_and_group_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", []), (2, "b", ["bad"]), (3, "a", [])], "id long, g string, issues array<string>")
    jsonl.write_split(df, str(tmp_path / "split"))
    back = spark.read.json(str(tmp_path / "split"))
    assert sorted((r.id, r.status) for r in back.select("id", "status").collect()) == [(1, "accepted"), (2, "rejected"), (3, "accepted")]
    jsonl.write_groups(df.drop("issues"), str(tmp_path / "groups"), "g")
    assert sorted(p.name for p in (tmp_path / "groups").iterdir() if p.is_dir()) == ["g=a", "g=b"]
    assert jsonl.read_strict(spark, str(tmp_path / "groups"), "id long, g string").count() == 3


def test_stream_accepts_each_key_once_over_batches(spark, tmp_path):
    source, out, at = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    source.mkdir()

    def arrive(name, rows):
        (source / name).write_text("".join(json.dumps({"id": i, "t": t}) + "\n" for i, t in rows))
        stream = spark.readStream.schema("id long, t string").json(str(source))
        incremental.accept_stream(stream, F.col("t"), "id", out, at).awaitTermination()
        return sorted((r.id, r.t) for r in spark.read.parquet(out).select("id", "t").collect())

    assert arrive("1.json", [(1, "a"), (2, "a"), (3, "b")]) == [(1, "a"), (3, "b")]
    assert arrive("2.json", [(4, "b"), (5, "c")]) == [(1, "a"), (3, "b"), (5, "c")]
