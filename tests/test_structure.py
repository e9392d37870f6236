"""Expressions, canonical keys, templates, renderings and MinHash links against plain Python on small tables."""

import ast
import hashlib
import itertools
import json
import operator
import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from marlstone import queries
from marlstone.functions import arithmetic as ar
from marlstone.functions import canonical as cn
from marlstone.functions import casefold
from marlstone.functions import fidelity as fd
from marlstone.functions import templates as tp
from marlstone.functions import text as tx
from marlstone.operators import minhash, similarity
from marlstone.structure_queries import SLOTS, template_overlap

OPS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv}


def plain_value(text):
    """The value by Python's own parser; None if it is no such expression."""

    def value(node):
        if isinstance(node, ast.Constant) and type(node.value) is int:
            return Fraction(node.value)
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.UAdd, ast.USub)):
            return value(node.operand) * (1 if isinstance(node.op, ast.UAdd) else -1)
        if isinstance(node, ast.BinOp) and type(node.op) in OPS:
            return OPS[type(node.op)](value(node.left), value(node.right))
        raise ValueError

    try:
        return value(ast.parse(text.strip(), mode="eval").body) if len(text.strip()) <= 120 else None
    except (ValueError, SyntaxError, ZeroDivisionError):
        return None


def evaluate(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", ar.evaluated(F.col("t")).alias("v")).orderBy("i").collect()
    return [None if r.v is None else Fraction(int(r.v.n), int(r.v.d)) for r in rows], [r.v for r in rows]


def test_expressions_have_python_s_values(spark):
    rng = random.Random(1)

    def expression(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.25:
            return str(rng.choice((0, 1, 2, 3, 7, 12, 100)))
        if kind < 0.4:
            return rng.choice("+-") + expression(depth - 1)
        if kind < 0.55:
            return f"({expression(depth - 1)})"
        return expression(depth - 1) + rng.choice((" ", "")) + rng.choice("+-*/") + rng.choice((" ", "")) + expression(depth - 1)

    texts = [t for t in (expression(rng.randint(1, 4)) for _ in range(260)) if len(t) <= 120]
    broken = ["", " ", "1 +", "* 2", "(1", "1)", "()", "2 ** 3", "7 // 2", "1.5", "1e3", "x", "2 3", "2(3)", "(2)3", "007", "00", "1_000 + 0_0", "1__0", "1_", "_1", "--+-5", "1/0", "1/(2-2)", "0/5", "1 % 2", "1,000", "9" * 130, "(((1)))", "((1)", "- (2 - 3) * -4", "6/4*2", "1 - -1", "²"]
    got, raw = evaluate(spark, texts + broken + [None])
    for text, value in zip(texts + broken, got):
        assert value == plain_value(text), text
    assert got[-1] is None
    assert all(v is None or (v.d == 1) == (int(v.n) % int(v.d) == 0) for v in raw if v is not None)


def test_numbers_beyond_38_digits_have_no_value(spark):
    got, _ = evaluate(spark, ["9" * 38, "9" * 39, "9" * 30 + " * 10", "(" + "9" * 38 + ") / -1", "9" * 30 + "0 / 10", "9" * 20 + " * " + "9" * 20, "10000000000000000000 * 1000000000000000000 + 1", "1/3 + 1/3 + 1/3"])
    assert got == [10**38 - 1, None, (10**30 - 1) * 10, 1 - 10**38, 10**30 - 1, None, 10**37 + 1, 1]


def issues(spark, column, schema, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_row int, " + schema)
    return [r.x for r in df.select("_row", column.alias("x")).orderBy("_row").collect()]


def test_arithmetic_records(spark):
    schema = "q string, s array<string>, a string, e string, v string"
    c = ar.arithmetic_record(*map(F.col, "qsaev"))
    rows = [
        ("Sum?", ["add"], "5", "2 + 3", "5"), (" ", [], None, None, None), ("Sum?", ["Assuming it", "x"], "1,005", " 1_000 + 5 ", "+1005"), ("q", ["a", " "], "five", "2 +", "5"),
        ("q", ["a"], "5", "1 / 2", "5"), ("q", None, "6", "2 + 3", "6"), ("q", ["a", None], "6", "2 + 3", "5"),
    ]
    assert issues(spark, c, schema, rows) == [
        [], ["empty_question", "bad_steps", "empty_answer", "arithmetic_missing_verification_expression", "arithmetic_bad_verification_answer", "arithmetic_bad_answer"], ["arithmetic_meta_commentary"],
        ["bad_steps", "arithmetic_invalid_verification_expression", "arithmetic_bad_answer"], ["arithmetic_non_integer_verified_answer"],
        ["bad_steps", "arithmetic_verification_answer_mismatch"], ["bad_steps", "arithmetic_answer_mismatch"],
    ]
    assert issues(spark, ar.arithmetic_record(F.col("q"), F.col("s"), F.col("a")), schema, rows[:1] + rows[3:4]) == [[], ["bad_steps"]]


def test_costly_parts_of_records_are_made_once_and_not_interpreted(spark):
    for name in ("arithmetic_records", "math_questions"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython [") == 1 and "aggregate(" not in plan and "filter(array(CASE" not in plan, plan


def test_math_questions(spark):
    schema = "q string, c array<string>, w string, e string, v string"
    both = ar.math_question(*map(F.col, "qcwev"))
    rows = [
        ("q", ["4", " 5 ", "6", "7"], "It is 5.", "2 + 3", "5"), ("q", ["4", "1,005", "6", "7"], "so 1,005", "1_005", "1005"), ("q", ["4", "15", "6", "7"], "It is 15", "2 + 3", "5"), ("q", ["5", "+5", "6", "7"], "5", "5", "5"),
        ("q", ["a", "5", "6", "7"], "-5", "-5", "-5"), ("q", ["4", "5"], "The provided  choices say 5", "5/2", "5"), ("q", ["4", "5", None, "7"], None, "x", "x"), ("", None, "5", "", None), ("q", ["5", "5", "6", "7"], "5", "5", "5"),
    ]
    assert issues(spark, both[0], schema, rows) == [
        [], [], ["mcq_verified_answer_missing_from_choices", "mcq_explanation_missing_answer"], ["mcq_verified_answer_not_unique"],
        ["mcq_non_integer_choice"], ["choices_not_four", "mcq_non_integer_verified_answer", "mcq_math_meta_commentary"], ["empty_choice", "empty_explanation", "mcq_invalid_verification_expression", "mcq_bad_verification_answer"],
        ["empty_question", "bad_choices", "mcq_missing_verification_expression", "mcq_bad_verification_answer"], ["duplicate_choices", "mcq_verified_answer_not_unique"],
    ]
    assert issues(spark, both[1], schema, rows) == [1, 1, None, None, None, None, None, None, None]


def test_general_questions(spark):
    schema = "v string, q string, c array<string>, i int, w string"
    c = ar.general_question(*map(F.col, "vqciw"))
    rows = [("e", "q", ["a", "b", "c", "d"], 3, "for b"), (" ", None, ["a", "A ", "c", "d"], 4, "the held  Answer"), ("e", "q", ["a", "b", "c", ""], None, ""), ("e", "q", [], -1, "x")]
    assert issues(spark, c, schema, rows) == [
        [], ["empty_question", "duplicate_choices", "correct_index_out_of_bounds", "empty_evidence", "mcq_general_meta_commentary"], ["empty_choice", "bad_correct_index_type", "empty_explanation"], ["choices_not_four", "correct_index_out_of_bounds"],
    ]


def test_numbers_within_longer_ones_do_not_count(spark):
    rows = [("It is 5.", 5), ("It is 15 or 51", 5), ("1,005", 1005), ("-5", -5), ("-5", 5), ("a5b", 5), ("", 5), ("x", 0), ("55 5", 5), ("11 or 111", 1), ("-5-5", -5), (None, 5)]
    got = issues(spark, ar.contains_number(F.col("t"), F.col("n").cast("decimal(38,0)")), "t string, n long", rows)
    assert got[:-1] == [bool(re.search(rf"(?<!\d){n}(?!\d)", t.replace(",", ""))) for t, n in rows[:-1]] and not got[-1]


def test_canonical_json(spark):
    rows = ['{"b": 1, "a": {"d": [1, {"z": null, "y": "ü\\u00fc \\n"}], "c": true}}', '{"a":{"c":true,"d":[1,{"y":"üü \\n","z":null}]},"b":1}', "[2, 1]", "nonsense", "", None, '{"a": 1, "a": 2}', '"x"', '{"Z": 1, "a": 2, "é": 3, "": 4}']
    got = issues(spark, cn.canonical(F.col("t")), "t string", [(r,) for r in rows])
    want = [json.dumps(json.loads(r), sort_keys=True, separators=(",", ":"), ensure_ascii=False) for r in (rows[0], rows[1], rows[2])]
    assert got[:3] == want and got[0] == got[1]
    assert got[3:7] == [None] * 4 and got[7] == '"x"'
    assert got[8] == json.dumps(json.loads(rows[8]), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert issues(spark, cn.structured_key(F.col("t")), "t string", [(r,) for r in rows])[2:8] == [None] * 6


def test_values_are_normal_at_any_depth_and_names_stay(spark):
    def normal(v):
        if isinstance(v, str):
            return re.sub("[ \t\r\n]+", " ", v.lower()).strip(" ")
        if isinstance(v, dict):
            return {k: normal(x) for k, x in v.items()}
        return [normal(x) for x in v] if isinstance(v, list) else v

    rows = ['{"Role": "USER", "Text": "  A \\"Quote\\" : B\\n\\tC  ", "n": [1, "X", {"K": "Y", "k": ["Z:", ": "]}]}', '{"a": "\\\\", "b": "\\\\\\"", "C": ""}', "{}", '["A", {"B": "C"}]']
    got = issues(spark, cn.normal_values(F.col("t")), "t string", [(r,) for r in rows])
    assert got == [json.dumps(normal(json.loads(r)), sort_keys=True, separators=(",", ":"), ensure_ascii=False) for r in rows]
    keys = issues(spark, cn.row_key(F.col("t")), "t string", [('{"a": "X  y", "b": 1}',), ('{"b":1,"a":" x Y"}',), ("no",)])
    assert keys[0] == keys[1] == hashlib.sha256(b'{"a":"x y","b":1}').hexdigest() and keys[2] is None
    assert casefold.folded_key is not tx.normal_space  # any column function will do as the normal form


def test_long_strings_are_normalised(spark):
    """A string of any length, escapes included, in a fixed depth of stack, and brackets at its ends stay."""
    long = '[X\\"y  ' * 40_000 + "]"
    got = issues(spark, cn.normal_values(F.col("t")), "t string", [(f'{{"K": "{long}", "b": ["[A]", "]"]}}',)])
    assert got == ['{"K":"' + '[x\\"y ' * 40_000 + ']","b":["[a]","]"]}']


def plain_template(t, slots=SLOTS):
    pattern = "|".join(map(re.escape, sorted({s for s in slots if len(s) >= 3}, key=lambda s: (-len(s), s))))
    t = re.sub(r"\b(?:[A-Z][a-z]+)(?:\s+[A-Z][a-z]+){1,3}\b", " <entity> ", t)
    t = re.sub(rf"(?<!\w)(?:{pattern})(?!\w)", " <slot> ", t, flags=re.IGNORECASE)
    t = re.sub(r"([\"'`])[^\n\"'`]{1,120}\1", " <quoted> ", t)
    t = re.sub(r"(?<![\w])[-+]?\d+(?:[.,:/-]\d+)*(?![\w])", " <num> ", t)
    return " ".join(re.findall(r"<[a-z_]+>|[a-z]+|[-+*/<>=]+|[{}()\[\],.:;]", t.lower()))


def test_templates(spark):
    texts = [
        "Ada Byron met the Big Red Dog in Paris on 12/03/2020, and paid -5.50 (x5, 5x).", 'He said "no way 7" and `code 1` and \'it\'; then THE end', "Étion Deux laÉtion Ab Cd é", "other anderson and", "a-5 +6 5+6 7-8-9 1,000,000.5", "", "   ", "({[<=>]}): x*y", "A B", "Aa Bb Cc Dd Ee Ff",
    ]
    assert issues(spark, tp.template_text(F.col("t"), SLOTS), "t string", [(t,) for t in texts]) == [plain_template(t) for t in texts]
    assert issues(spark, tp.template_text(F.col("t")), "t string", [("the end",)]) == ["the end"]
    assert issues(spark, tp.template_text(F.col("t"), (), F.col("m")), "t string, m boolean", [("Q?\nAnswer: B \nend", True), ("Answer: b", False), ("an answer: c", True)]) == ["q answer : <choice> end", "answer : b", "an answer : c"]


def test_row_templates_do_not_depend_on_the_order_of_columns(spark):
    rows = [("Ada Byron is here", ["one 5", None, ""], {"k": "Two 6", "l": None}, [("x 7", 1)], 9, "left out", "2")]
    schema = "question string, steps array<string>, about map<string,string>, more array<struct<t: string, n: int>>, n int, answer string, type string"
    df = spark.createDataFrame(rows, schema)
    one = df.select(tp.row_template(df.schema).alias("t")).first().t
    turned = df.select(*sorted(df.columns, reverse=True))
    assert one == turned.select(tp.row_template(turned.schema).alias("t")).first().t
    assert one == "two <num> <field> x <num> <field> <entity> is here <field> one <num>"
    only = df.select("answer", "n")
    assert only.select(tp.row_template(only.schema).alias("t")).first().t == ""


def test_template_overlap_is_that_of_plain_python(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.choice(("en", "de", None)), rng.choice(("s1", "s2", None)), rng.choice((f"Ada Byron has {i}\nof the 5 cats", f"Bob Stone has {i + 1}\nof und 7 cats", "other text", "", None))) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    counts = {}
    for _, lang, source, text in rows:
        parts = [x for x in [lang or "", *(text or "").split("\n")] if plain_template(x)]
        key = hashlib.sha256(" <field> ".join(map(plain_template, parts)).encode()).hexdigest()
        counts.setdefault(key, Counter())[source] += 1
    want = {(k, s, n, len(c), sum(c.values())) for k, c in counts.items() if len(c) > 1 for s, n in c.items()}
    assert {tuple(r) for r in template_overlap(spark, str(tmp_path)).select("template", "source", "n", "sources", "occurrences").collect()} == want and want


def test_renderings(spark):
    schema = "q string, r array<string>, t array<string>, a string"
    rows = [
        ("Add 3 and 4, on Deck", ["3", "4"], ["deck"], "7"), ("Add 3, 3 and 5", ["3", "4"], ["deck", "ADD"], "7"), ("3 4 7", ["3", "4"], None, "7"), ("7 and 3", ["3", "7"], [], "7"), ("-3 x4 4x a-5", ["-3"], [], "1"), (None, ["1", "1"], None, None), ("5 5 5", ["5"], [], "9"), ("", None, None, None),
    ]
    got = issues(spark, fd.rendering(*map(F.col, "qrta")), schema, rows)

    def plain(q, required, texts, answer):
        q = (q or "").strip()
        seen, want = Counter(re.findall(r"(?<![\w])-?\d+(?![\w])", q)), Counter(required or [])
        lost, more = want - seen, seen - want
        hits = [(q == "", "empty_question"), (bool(lost), "missing_numeric_fact"), (any(v not in want for v in more), "extra_numeric_fact"), (any(v in want for v in more), "repeated_numeric_fact")]
        hits += [(any(t.lower() not in q.lower() for t in texts or []), "dropped_semantic_context"), (answer in seen and answer not in want, "leaks_answer")]
        show = lambda b: " ".join(f"{v}x{n}" for v, n in sorted(b.items()))
        return [c for hit, c in hits if hit], show(lost), show(more)

    assert [(r.issues, r.missing, r.extra) for r in got] == [plain(*r) for r in rows]
    assert issues(spark, fd.bag(F.col("v")), "v array<string>", [(["a", "b", "a"],), ([],)]) == [{"a": 2, "b": 1}, {}]


@pytest.fixture(scope="module")
def near_sets():
    rng = random.Random(6)
    out = {}
    for c in range(25):
        base = [rng.getrandbits(60) for _ in range(rng.choice((1, 5, 40, 120)))]
        for _ in range(rng.choice((1, 2, 9))):
            own = [x if rng.random() > 0.06 else rng.getrandbits(60) for x in base]
            out[len(out)] = sorted(set(own))
    hot = [rng.getrandbits(60) for _ in range(50)]
    for _ in range(90):
        own = list(hot)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(50)] = rng.getrandbits(60)
        out[len(out)] = sorted(set(own))
    out[len(out)] = []
    return out


def exact_pairs(sets, threshold):
    return {(u, v) for u, v in itertools.combinations(sorted(sets), 2) if sets[u] and sets[v] and len(set(sets[u]) & set(sets[v])) / len(set(sets[u]) | set(sets[v])) >= threshold}


def components_of(pairs, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in pairs:
        root[max(find(u), find(v))] = min(find(u), find(v))
    return {i: find(i) for i in ids}


def test_minhash_links_are_right_and_find_what_the_exact_join_finds(spark, near_sets, tmp_path):
    rows = [(i, s, "g") for i, s in near_sets.items()] + [(1000, None, "g")]
    spark.createDataFrame(rows, "id long, s array<bigint>, g string").write.parquet(str(tmp_path / "sets"))
    df = spark.read.parquet(str(tmp_path / "sets"))
    want = exact_pairs(near_sets, 0.8)
    for tile in (7, minhash.TILE):
        got = {(r.u, r.v): (r.common, r.total) for r in minhash.links(df, "id", "s", 0.8, tile=tile).collect()}
        assert set(got) <= want
        assert all(common == len(set(near_sets[u]) & set(near_sets[v])) and total == len(set(near_sets[u]) | set(near_sets[v])) for (u, v), (common, total) in got.items())
        # Links that the components imply already need not be listed.
        a, b = components_of(got, near_sets), components_of(want, near_sets)
        found = sum(a[u] == a[v] for u, v in want) / len(want)
        assert found >= 0.99 and len(got) < len(want) / 2, found
        assert sum(a[i] == b[i] for i in b) / len(b) >= 0.97
    exact = {(r.u, r.v) for r in similarity.jaccard_pairs(df.where("s is not null"), "id", "s", 0.8).collect()}
    assert exact == want
    clusters = {r.id: r.cluster for r in minhash.near_clusters(df, "id", "s", 0.8).collect()}
    assert clusters == {**a, 1000: 1000}


def test_signatures_take_one_pass_and_no_row_for_each_item(spark):
    rows = [(i, [hash((i, j)) for j in range(n)]) for i, n in enumerate((1, 0, 3, 70, 5))] + [(9, None)]
    got = minhash.signatures(spark.createDataFrame(rows, "id long, s array<bigint>"), "id", "s", 16)
    assert {r.id for r in got.collect()} == {0, 2, 3, 4} and all(len(r.sig) == 16 for r in got.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan
    turned = minhash.signatures(spark.createDataFrame([(i, s and s[::-1]) for i, s in rows], "id long, s array<bigint>"), "id", "s", 16)
    assert {r.id: r.sig for r in turned.collect()} == {r.id: r.sig for r in got.collect()}


def test_minhash_keeps_groups_apart_and_stands_empty_tables(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], "a"), (2, [1, 2, 3], "b"), (3, [1, 2, 3], "a"), (4, [1, 2, 3], None), (5, [1, 2, 3], None)], "id long, s array<bigint>, g string")
    assert {(r.u, r.v) for r in minhash.links(df, "id", "s", 0.8, "g").collect()} == {(1, 3), (4, 5)}
    assert minhash.links(df.limit(0), "id", "s", 0.8).count() == 0


def test_bands_reach_the_recall():
    for t in (0.5, 0.8, 0.88, 0.95):
        n, rows = minhash.bands(t)
        assert n * rows <= minhash.PERMUTATIONS and 1 - (1 - t**rows) ** n >= minhash.RECALL


def test_cluster_summary_counts_multiplicities(spark):
    rows = [("a", 1, 3), ("a", 1, 1), ("a", 5, 1), ("a", 6, 2), ("b", 9, 1)]
    got = {r.g: r for r in minhash.cluster_summary(spark.createDataFrame(rows, "g string, cluster long, n long"), "g").collect()}
    a, b = got["a"], got["b"]
    assert (a.n_rows, a.n_templates, a.exact_repeated_rows, a.near_clusters, a.near_rows, a.largest_cluster, a.unique_ratio, a.near_ratio) == (7, 4, 5, 2, 6, 4, 0.571429, 0.857143)
    assert (b.n_rows, b.near_clusters, b.near_rows, b.largest_cluster, b.near_ratio) == (1, 0, 0, 0, 0.0)
