"""The corpus pipeline's stages and its whole run against plain Python, on tables with nulls, repeats, empty inputs and columns that clash."""

import random
from collections import Counter

import pytest
from test_operators import contaminated, corpus, frame, links  # noqa: F401

import corpus_pipeline
from marlstone.llm import decontam, kdshard, mixing, ngramjoin, quality
from marlstone.llm.common import DOCUMENT_COLUMNS

#: Texts of the benchmark; one equals a document's words, one is null, one shorter than a window.
ITEMS = [("q1", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (None, "Tiny Item"), ("q3", None), ("q4", " ")]


def texts(rows):
    return Counter((r[0], r[1], r[2], r[3]) for r in rows)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, corpus):  # noqa: F811
    """A folder with documents, labels and benchmark, and the rows of documents."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows, labels = list(corpus), [(900, None, None), (None, 1, 0)]
    for i in range(200, 500):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(20, 80))]
        good = i % 3 > 0
        if good and i % 10 == 0:
            body[5:5] = ITEMS[0][1].upper().split()
        rows.append((i, " ".join(body) if good else " ".join(w.upper() + "!!" for w in body), ["en", "de", None][i % 3], f"s{i % 4}"))
        labels.append((i, int(good), 0))
    rows += [(600, "x y TINY item! z", "en", "s0"), rows[-1], (601, rows[-2][1], "en", "s1")]
    folder = tmp_path_factory.mktemp("pipeline")
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def test_keep_stage_keeps_what_the_model_says(spark, tables):
    folder, rows = tables
    docs = frame(spark, rows)
    scored = quality.score_quality(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    kept = quality.keep_stage(spark, docs, folder)
    assert tuple(kept.columns) == DOCUMENT_COLUMNS
    kept = kept.collect()
    assert texts(kept) == texts([(r.doc_id, r.text, r.lang, r.source) for r in scored if r.score >= 0.5])
    kept_ids = {r.doc_id for r in kept}
    clean, bad = [i for i in range(200, 500) if i % 3], [i for i in range(200, 500) if i % 3 == 0]
    assert sum(i in kept_ids for i in clean) >= 0.97 * len(clean) and sum(i in kept_ids for i in bad) <= 0.03 * len(bad)


def test_clean_stage_drops_whoever_holds_a_window(spark, tables):
    folder, rows = tables
    got = decontam.clean_stage(spark, frame(spark, rows), folder)
    assert tuple(got.columns) == DOCUMENT_COLUMNS
    want = [r for r in rows if not contaminated(r[1], ITEMS)[-1]]
    assert 0 < len(want) < len(rows) - 10 and texts(got.collect()) == texts(want)


def test_shard_stage_places_every_row(spark, tables):
    folder, rows = tables
    got = kdshard.shard_stage(spark, frame(spark, rows), folder).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    at = {}
    for r in got:
        at.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in at.values())


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_of_nothing(spark, tables, stage):
    folder, rows = tables
    assert stage(spark, frame(spark, rows).limit(0), folder).count() == 0


def test_run_is_its_stages_on_what_is_left(spark, tables):
    folder, rows = tables
    got = corpus_pipeline.run(spark, folder).collect()
    kept = [tuple(r) for r in quality.keep_stage(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()]
    # Of each group of near copies one row is left; which of several with one id does not matter here.
    firsts = {c for d, _, c in links([r[:4] for r in kept]) if d is not None}
    one = ngramjoin.one_of_each_stage(spark, spark.createDataFrame(kept, "doc_id long, text string, lang string, source string, n_chars long"), folder).collect()
    assert {r.doc_id for r in one} - {None} == firsts
    clean = [tuple(r) for r in one if not contaminated(r.text, ITEMS)[-1]]
    mixed = mixing.mix_stage(spark, spark.createDataFrame(clean, "doc_id long, text string, lang string, source string, n_chars long"), folder).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in mixed) and got
    assert {"doc_id", "size", "shard", "slot"} <= set(got[0].asDict())
