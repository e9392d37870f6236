"""SimHash links, the filter audit and collocations: small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, against brute force and SQL."""

import itertools
import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
import xxhash

from marlstone.llm import collocations, filteraudit, packing, simhash

DOCS = "doc_id long, text string, lang string, fp long, comp long, part string, bucket string, mask string, phrase string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "p", "b", "m", "x", 3) for r in rows], DOCS)


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(40)] + ["x" * 40]
    base = [rng.choice(vocabulary) for _ in range(220)]
    rows = []
    for i in range(90):
        words = [rng.choice(vocabulary) for _ in range(rng.choice((3, 30, 120, 260)))]
        if i % 3 == 0:
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        text = "".join(w + rng.choice((" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ! ")) for w in words)
        rows.append((i, text.upper() if i % 10 == 9 else text, ("en", "de", None, "")[i % 4]))
    long = [rng.choice(vocabulary) + rng.choice("xyz") for _ in range(2500)]
    for i in range(100, 108):
        words = list(long)
        words[rng.randrange(len(words))] = "other"
        rows.append((i, " ".join(words), "en"))
    return rows + [
        (200, None, None), (201, "", "en"), (202, " \n\t", "de"), (203, "One Two", "en"), (204, "one two", "und"), (204, "one two", "und"), (None, rows[0][1], "en"), (None, rows[0][1], "en"),
        (205, rows[3][1], "fr"), (3, rows[3][1], "en"), (206, "# $ | " * 40, "en"), (207, "a b c. " * 3000, "de"), (208, "A b. a B; A\tb: a  b\x0ba b " * 9, "en"),
    ]


def shingled(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []


def plain_fingerprint(text):
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingled(text)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, differ=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= differ:
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_simhash_is_that_of_plain_counts_and_links(spark, corpus, tmp_path):
    path = str(tmp_path / "documents.parquet")
    frame(spark, corpus).repartition(5).write.parquet(path)
    got = sorted(simhash.query(spark, str(tmp_path)).collect(), key=repr)
    prints = [plain_fingerprint(t) for _, t, _ in corpus]
    comp = plain_components(prints)
    least = {}
    for (doc_id, _, _), c in zip(corpus, comp):
        least[c] = min((x for x in (least.get(c), doc_id) if x is not None), default=None)
    want = sorted(((d, f"{p:016x}", least[c]) for (d, _, _), p, c in zip(corpus, prints, comp)), key=lambda r: repr(r))
    assert sorted(map(tuple, got), key=repr) == want
    assert len(set(comp)) < len(set(prints))  # something links that is not equal


def test_links_of_hot_buckets_are_those_of_plain_comparison(spark, tmp_path):
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    chain = [rng.getrandbits(64)]
    for _ in range(12):
        chain.append(flip(chain[-1], 4))
    prints = {0, (1 << 64) - 1, centre, *(flip(centre, rng.randint(1, 7)) for _ in range(150)), *chain, *(rng.getrandbits(64) for _ in range(60))}
    prints |= {centre & ~0xFFFF | i << 4 for i in range(64)} | {flip(p, 5) for p in chain[:4]}
    prints = sorted(prints)
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    nodes.write.parquet(str(tmp_path / "nodes"))
    comp = plain_components(prints)
    size = Counter(comp)
    want = {}
    for p, c in zip(prints, comp):
        if size[c] > 1:
            want.setdefault(c, set()).add(signed(p))
    for hot in (2, 20, simhash.HOT):
        got = {}
        for node, name in simhash.link_fingerprints(spark.read.parquet(str(tmp_path / "nodes")), hot).collect():
            got.setdefault(name, set()).add(node)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())), hot
        assert all(name == min(members) for name, members in got.items())


def test_gray_index_factors_patterns_and_finds_what_a_scan_finds():
    rng = np.random.default_rng(4)
    near = rng.integers(0, 1 << 62, 3, dtype=np.uint64)[:, None] ^ (np.uint64(1) << rng.integers(0, 64, (3, 60), dtype=np.uint64))
    fp = np.unique(np.concatenate((near.ravel(), rng.integers(0, 1 << 63, 200, dtype=np.uint64))))
    bucket = np.sort(rng.integers(0, 3, len(fp)))
    order = np.lexsort((simhash.gray_rank(fp), bucket))
    fp, bucket = fp[order], bucket[order]
    index = simhash.GrayIndex(fp, bucket)
    # The masks of a path from root to leaf are disjoint and cover all bits; their patterns are the fingerprint.
    for i in range(len(fp)):
        masks = patterns = np.uint64(0)
        for first, mask, pattern in zip(index.first, index.mask, index.pattern):
            k = np.searchsorted(first, i, "right") - 1
            assert masks & mask[k] == 0
            masks, patterns = masks | mask[k], patterns | pattern[k]
        assert masks == ~np.uint64(0) and patterns == fp[i]
    apart = [np.full(len(f), -1) for f in index.first]
    u, v = index.search(np.arange(len(fp)), apart, np.zeros(len(fp), np.int64))
    got = set(zip(u.tolist(), v.tolist()))
    want = {(i, j) for i, j in itertools.combinations(range(len(fp)), 2) if bucket[i] == bucket[j] and (int(fp[i]) ^ int(fp[j])).bit_count() <= 4}
    assert got == want and len(want) > 50
    gray = [i ^ i >> 1 for i in range(64)]
    assert simhash.gray_rank(np.array(gray, np.uint64)).tolist() == list(range(64))


def test_cuts_share_out_the_free_bits():
    level = [0]
    while children := [c for m in level for c in simhash.cut(m)]:
        for m in level:
            parts = [c & ~m for c in simhash.cut(m)]
            assert len(parts) == simhash.DIFFER + 1 and sum(parts) == ~m & (1 << 64) - 1
        level = children[:7]


def duck(sql, tables):
    con = duckdb.connect()
    con.execute("set temp_directory = ''")
    for name, path in tables.items():
        con.execute(f"create view {name} as select * from read_parquet('{path}/*.parquet')")
    cursor = con.execute(sql)
    rows = [dict(zip([c[0] for c in cursor.description], r)) for r in cursor.fetchall()]
    con.close()
    return sorted(map(repr, (sorted(r.items()) for r in rows)))


def spark_rows(df):
    return sorted(map(repr, (sorted(r.asDict().items()) for r in df.collect())))


def plain_audit(rows, labels):
    text = [t or "" for _, t, _ in rows]
    least = {}
    for (i, _, _), t in zip(rows, text):
        if i is not None:
            least[t] = min(least.get(t, i), i)
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    out = {}
    parts = {lang or "" for _, _, lang in rows}
    failed = []
    for (i, _, lang), t in zip(rows, text):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t))}
        f["E"] = t in least and (i is None or least[t] < i)
        failed.append((lang or "", {k for k, v in f.items() if v}, i in good, i in toxic))
    for part in parts:
        own = [x for x in failed if x[0] == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, k in enumerate(order, 1):
                removed = [x for x in left if k in x[1]]
                left = [x for x in left if k not in x[1]]
                shapley[k] += len(removed)
                out[part, "".join(order), step] = [len(left), len(removed), sum(k in x[1] for x in own) - len(removed), sum(x[1] == {k} for x in own), sum(x[2] for x in removed), sum(x[3] for x in removed)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def test_filter_audit_is_that_of_applying_the_filters(spark, corpus, tmp_path):
    labels = [(i, i % 3, (i + 1) % 2) for i in range(0, 210, 2)] + [(4, 1, None), (4, None, 1), (None, 1, 1), (6, None, None)]
    frame(spark, corpus).drop("part", "mask").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    df = filteraudit.query(spark, str(tmp_path))
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    got = {(r.part, r.filter_order, r.step): [r[c] for c in names] for r in df.collect()}
    assert got == plain_audit(corpus, labels)
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {"part": "string", "filter_order": "string", "step": "int"} | dict.fromkeys(names, "bigint")
    sql = filteraudit.ORACLE.replace("{documents}", "documents")
    assert spark_rows(df) == duck(sql, {t: tmp_path / f"{t}.parquet" for t in ("documents", "labels")})


def plain_collocations(rows):
    f, n = Counter(), Counter()
    for _, t, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang if lang is not None else "und"] += len(w)
            for k in (1, 2, 3):
                f.update((lang if lang is not None else "und", tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < 10:
            continue
        if any(len(q) == 3 and g == lang and p in (q[:2], q[1:]) and b >= 10 and 100 * b >= 50 * a for (g, q), b in f.items() if len(p) == 2):
            continue
        cuts = [(Fraction(1_000_000 * a * a, f[lang, p[:k]] * f[lang, p[k:]]).__floor__(), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        s, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-s, -a, " ".join(p).encode(), left, right))
    return {(lang, i): (p.decode(), -a, left, right, n[lang], -s) for lang, rows_ in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rows_)[:2000], 1)}


def test_collocations_are_those_of_exact_counts(spark, corpus, tmp_path, monkeypatch):
    frame(spark, corpus).drop("part", "phrase", "n").repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    df = collocations.query(spark, str(tmp_path))
    got = {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}
    want = plain_collocations(corpus)
    assert got == want and len(want) > 30
    assert spark_rows(df) == duck(collocations.ORACLE.replace("{documents}", "documents"), {"documents": tmp_path / "documents.parquet"})
    # A sketch in which most counters are full, and tasks that hand on early, change nothing.
    monkeypatch.setattr(collocations, "MIN_BITS", 5)
    monkeypatch.setattr(collocations, "MAX_BITS", 5)
    monkeypatch.setattr(collocations, "ADDED", 50)
    monkeypatch.setattr(collocations, "COUNTED", 20)
    again = collocations.query(spark, str(tmp_path))
    assert {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in again.collect()} == want


def test_sketch_lets_through_few_that_are_rare(spark, tmp_path):
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(300)) + ". often met", "en") for i in range(40)]
    texts = spark.createDataFrame(rows, "doc_id long, text string, part string").select("text", "part")
    bits = 16
    sketch = spark.sparkContext.broadcast(collocations.frequent_bits(texts, bits))
    counted = collocations.counted(texts, sketch, bits, 4).where("range >= 0").collect()
    assert sum(len(packing.unpack(bytes(r.counts))[0]) for r in counted) < 100 * len({r.range for r in counted})  # of 36,000 n-grams
    frequent = collocations.frequent_phrases(texts).where("k > 0").collect()
    assert {(r.k, r.phrase, r.n) for r in frequent} == {(1, "often", 40), (1, "met", 40), (2, "often met", 40)}


def test_scores_beyond_64_bits_are_exact(spark):
    big = 3_000_000_000_007
    rows = [("en", 1, "a", 2 * big), ("en", 1, "b", big + 1), ("en", 2, "a b", big), ("en", 0, "", 9)]
    got = collocations.scored(spark.createDataFrame(rows, "part string, k int, phrase string, n long")).collect()
    assert [(r.a, r.l, r.r, r.score) for r in got] == [(big, 2 * big, big + 1, 1_000_000 * big * big // (2 * big * (big + 1)))]


@pytest.mark.parametrize("query", [simhash.query, collocations.query, filteraudit.query])
def test_an_empty_table_gives_no_rows(spark, tmp_path, query):
    frame(spark, []).drop("part", "n", "phrase").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert query(spark, str(tmp_path)).count() == 0


def test_top_of_each_part_is_ranked_with_ties(spark):
    rows = [("p", f"w{i:04d} x", 10 + i % 3, 20, 20, 7) for i in range(500)]
    got = collocations.ranked(spark.createDataFrame(rows, "part string, phrase string, a long, l long, r long, score long"), 120).orderBy("rank").collect()
    want = sorted(rows, key=lambda r: (-r[5], -r[2], r[1]))[:120]
    assert [(r.phrase, r.a) for r in got] == [(w[1], w[2]) for w in want] and [r["rank"] for r in got] == list(range(1, 121))


def test_licenses_and_media_stand_columns_of_any_name(spark):
    from marlstone.llm import licenses, media

    df = spark.createDataFrame([(1, "under the MIT license", "x", "y", "z", 7)], "doc_id long, text string, _text string, media string, c0 string, `a.b` int")
    row = licenses.scan_licenses(df).first()
    assert (row.doc_id, row["_text"], row.media, row.c0, row["a.b"], row.base_labels) == (1, "x", "y", "z", 7, "mit")
    row = media.read_media(media.to_media(df)).first()
    assert (row.doc_id, row["_text"], row.c0, row["a.b"], row.n_bytes, row.payload_bytes) == (1, "x", "z", 7, 21, 64)
