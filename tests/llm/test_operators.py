"""Each operator on small tables with nulls, empty texts, repeated rows and clashing columns, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from marlstone.llm import ctw, decontam, kdshard, licenses, mixing, ngramjoin, packing, quality, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, size string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), "clash", "clash") for r in rows], DOCS)


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    shared = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for i in range(60):
        kind = i % 6
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        if kind in (1, 2):
            base = list(shared)
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(30)] = rng.choice(vocabulary)
        if kind == 3:
            base = base + shared
        rows.append((i, " ".join(base), "en", f"s{i % 3}" if i % 7 else None))
    rows += [(100, None, None, None), (101, "", "en", "s0"), (102, " \n", "en", "s0"), (103, "one Two", "de", "s1"), (104, "one two", "de", "s1"), (5, rows[5][1], "en", "s2"), (5, rows[5][1], "en", "s2"), (None, rows[7][1], "en", "s1"), (105, "x " * 3000, "en", "s9"), (106, rows[1][1].upper().replace("É", "é"), "fr", "s9")]
    return rows


def links(rows):
    sets = []
    for _, t, *_ in rows:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min((x for x in groups[find(i)] if x is not None), default=None)) for i in range(len(rows))]


@pytest.mark.parametrize("limits", [{}, {"TILE": 3, "CHUNK": 500, "REMEMBERED": 5}, {"BITS": 64, "CHUNK_ROWS": 7, "TRIE_SETS": 2}])
def test_ngram_join(spark, corpus, limits, monkeypatch):
    for name, value in limits.items():
        monkeypatch.setattr(ngramjoin, name, value)
    got = ngramjoin.link_components(frame(spark, corpus)).collect()
    expected = links(corpus)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == Counter(e for e in expected if e[0] is not None)
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [e[1:] for e in expected if e[0] is None]
    assert ngramjoin.link_components(frame(spark, corpus).limit(0)).count() == 0


@pytest.mark.parametrize("limits", [{}, {"TILE": 8, "BITS": 128, "REMEMBERED": 9}])
def test_ngram_join_of_near_copies_about_the_threshold(spark, limits, monkeypatch):
    """Groups in which some pairs link and others just fail to, and chains that link only with their neighbours."""
    for name, value in limits.items():
        monkeypatch.setattr(ngramjoin, name, value)
    rng, rows = random.Random(8), []
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(60)]
        for _ in range(30):
            own = list(base)
            for at in rng.sample(range(60), rng.randint(0, 4)):
                own[at] = f"x{rng.randrange(40)}"
            rows.append((len(rows), " ".join(own), "en", "s"))
    base = [f"w{i}" for i in range(80)]
    rows += [(900 + i, " ".join(base[i * 6 : i * 6 + 44]), "en", "s") for i in range(6)]
    got = {r.doc_id: r.component_id for r in ngramjoin.link_components(frame(spark, rows)).collect()}
    expected = {d: c for d, _, c in links(rows)}
    assert got == expected and len(set(expected.values())) > 8


def test_words_that_a_polynomial_confuses_stay_apart(spark):
    """Thue-Morse words and their complements have one hash under any polynomial modulo a power of two."""
    rows = []
    for bits in (9, 10, 11, 12):
        word = "".join("ab"[i.bit_count() % 2] for i in range(1 << bits))
        rows += [(len(rows), word, "en", "s"), (len(rows) + 1, word.translate(str.maketrans("ab", "ba")), "en", "s")]
    got = {r.doc_id: r.component_id for r in ngramjoin.link_components(frame(spark, rows)).collect()}
    assert got == {i: i for i in range(8)}


def test_packed_arrays_come_back():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 1000):
        h = np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        small = rng.integers(0, 300, n).astype(np.uint64)
        back = packing.sort_unpack(packing.sort_pack(h, small))
        assert np.array_equal(back[0], h) and np.array_equal(back[1], small)


def test_trie_join_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(60):
        sets = [np.sort(rng.choice(40, rng.integers(1, 30), replace=False)).astype(np.uint64) for _ in range(12)]
        probe = sets[0]
        expected = {i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, probe)) >= 75 * len(np.union1d(s, probe))}
        assert {i for i, _ in ngramjoin.trie_join(probe, len(probe), sets, [len(s) for s in sets], step=int(rng.integers(1, 9)))} == expected


def test_one_of_each_stage(spark, corpus):
    kept = ngramjoin.one_of_each_stage(spark, frame(spark, corpus), "").collect()
    assert Counter(r.doc_id for r in kept if r.doc_id is not None) == Counter({c for d, _, c in links(corpus) if d is not None})


ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(text, items, n=10):
    w = ITEM.findall(lower(text or ""))
    hit, found = set(), set()
    for item, t in items:
        v = ITEM.findall(lower(t or ""))
        k = min(n, len(v))
        for win in {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if v else ():
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) == win:
                    hit |= set(range(i, i + k))
                    found |= {str(item)} - {"None"}
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 200])
def test_decontamination(spark, corpus, block_bytes):
    items = [(1, corpus[3][1]), (10, "One, two!"), (2, None), (3, " ?! "), (11, " ".join(corpus[1][1].split()[4:18])), (None, corpus[9][1]), (12, corpus[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontam.decontaminate(frame(spark, corpus), bench, block_bytes=block_bytes).collect())
    assert got == Counter((r[0], *contaminated(r[1], items)) for r in corpus)
    spans = decontam.find_spans(frame(spark, [(1, "¡ONE—twö; One,  Two!", "en", "s")]), bench).first()
    assert spans["items"] == ["10"]
    spans = spans.spans
    assert [(s.first, s.last) for s in spans] == [(1, 2)]
    text = "¡ONE—twö; One,  Two!".encode()
    assert text[spans[0].start : spans[0].stop] == b"One,  Two"
    assert decontam.decontaminate(frame(spark, corpus), bench.limit(0)).where("contaminated").count() == 0


def fill(sizes):
    total, left = sum(sizes), [s * 3 for s in sizes]
    weights, out = [i % 3 + 1 for i in range(len(sizes))], [0.0] * len(sizes)
    free = set(range(len(sizes)))
    rest = total
    while free:
        ws = sum(weights[i] for i in free)
        over = [i for i in free if rest * weights[i] / ws > left[i]]
        if not over:
            for i in free:
                out[i] = rest * weights[i] / ws
            return out
        for i in over:
            out[i] = left[i]
            rest -= left[i]
            free.discard(i)
    return out


def scheduled(rows, want):
    """(doc_id, source, size, taken, first_slot) by the schedule, slot by slot and word by word."""
    order = sorted(want, key=lambda s: (s is None, s))
    quota = {s: math.floor(want[s] + 0.5) for s in order}
    every, upto, bounds = sum(quota.values()), 0, {}
    for s in order:
        bounds[s] = [math.floor(q / every * mixing.POINTS) for q in (upto, upto + quota[s])]
        upto += quota[s]
    docs = {s: [] for s in order}
    for i, r in enumerate(rows):
        docs[r[3]].append((hashlib.md5(str(r[0] or 0).encode()).hexdigest(), len(words(r[1])), i))
    laid = {s: [i for _, n, i in sorted(d) for _ in range(n)] for s, d in docs.items()}
    slots = {s: [] for s in order}
    for slot in range(math.ceil(sum(map(len, laid.values())) / mixing.BLOCK)):
        u = slot * mixing.GOLDEN % mixing.POINTS
        for s in order:
            if bounds[s][0] <= u < bounds[s][1]:
                slots[s].append(slot)
    taken, first = Counter(), {}
    for s in order:
        for w in range(quota[s]):
            i = laid[s][w % len(laid[s])]
            taken[i] += 1
            if i not in first:
                block = w // mixing.BLOCK
                first[i] = slots[s][block] if block < len(slots[s]) else None
    return [(r[0], r[3], len(words(r[1])), taken[i], first.get(i)) for i, r in enumerate(rows)]


def test_source_mix(spark, corpus):
    got = mixing.mix(frame(spark, corpus)).collect()
    assert len(got) == len(corpus)
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((r[0], r[3], len(words(r[1]))) for r in corpus)
    sizes = Counter()
    for r in corpus:
        sizes[r[3]] += len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = dict(zip(order, fill([sizes[s] for s in order])))
    for s in order:
        own = [r for r in got if r.source == s]
        assert all(math.isclose(r.target, want[s]) and r.source_size == sizes[s] for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= 0.5
        assert all(0 <= r.taken <= 3 * r["size"] for r in own)
    assert Counter((r.doc_id, r.source, r["size"], r.taken, r.first_slot) for r in got) == Counter(scheduled(corpus, want))
    again = mixing.mix(frame(spark, corpus).repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.mix(frame(spark, corpus).limit(0)).count() == 0


def test_sources_of_a_few_words_meet_their_targets(spark):
    rows = [(1000 + i, "w " * n, "en", f"s{n:03d}") for i, n in enumerate((1, 2, 5, 9, 30, 64, 65, 130, 200))] + [(i, "x " * 500, "en", "z") for i in range(20)]
    got = mixing.mix(frame(spark, rows)).collect()
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    targets = {r.source: r.target for r in got}
    assert all(abs(taken[s] - t) <= 0.5 for s, t in targets.items())
    assert targets["s001"] == 3 and taken["s001"] == 3 and taken["s200"] == 600
    assert sorted(map(tuple, got), key=repr) == sorted(((a, b, c, next(r.source_size for r in got if r.source == b), targets[b], d, e) for a, b, c, d, e in scheduled([(r[0], r[1], r[2], r[3]) for r in rows], targets)), key=repr)


def test_slots_decide_what_a_document_gives(spark, monkeypatch):
    """What is taken is summed over granted blocks: each has one slot, and a block without its grant gives nothing."""
    rows = [(i, "w " * (7 * i % 190 + 1), "en", f"s{i % 5}") for i in range(120)] + [(900, "tiny one", "en", "tiny"), (901, None, "en", "s0")]
    got = mixing.mix_blocks(frame(spark, rows)).collect()
    n = math.ceil(sum(r["size"] for r in got) / mixing.BLOCK)
    want = scheduled([(r[0], r[1] or "", r[2], r[3]) for r in rows], {r.source: r.target for r in got})
    assert Counter((r.doc_id, r.source, r["size"], r.taken, r.first_slot) for r in got) == Counter(want)
    for r in got:
        assert 0 <= r.late_words <= r.taken <= r.blocks * mixing.BLOCK and (r.last_slot is None) == (r.taken == 0) == (r.blocks == 0)
        assert (r.late_words > 0) == (r.last_slot is not None and r.last_slot >= n)
        assert r.first_slot is None or r.first_slot <= r.last_slot
    whole, seen = mixing.grants, []

    def without_block_1(*args):
        df = whole(*args)
        seen.extend(df.collect())
        return df.where("block <> 1")

    monkeypatch.setattr(mixing, "grants", without_block_1)
    less = Counter()
    for r in mixing.mix(frame(spark, rows)).collect():
        less[r.source] += r.taken
    assert len({r.slot for r in seen}) == len(seen) == len({(r["rank"], r.block) for r in seen})
    for s in {r[3] for r in rows}:
        quota = sum(r.taken for r in got if r.source == s)
        assert less[s] == quota - max(0, min(quota, 2 * mixing.BLOCK) - mixing.BLOCK)


def test_schedule_is_even_everywhere(spark):
    """Any stretch of the schedule holds each source's share of it."""
    rows = [(i, "w " * 500, "en", f"s{i % 4}") for i in range(400)]
    docs = frame(spark, rows)
    sized = docs.select(docs["source"].alias("_source"), mixing.word_count(docs["text"]).alias("_size"))
    sources = mixing.targets(sized).cache()
    words_ = 200_000
    slots = mixing.schedule(sources, words_).collect()
    quota = {r.rank: r.quota for r in sources.collect()}
    for cut in (100, 300, 600):
        seen = Counter(s.rank for s in slots if s.slot < cut)
        assert all(abs(seen[k] - cut * q / words_) <= 3 for k, q in quota.items())
    assert all(abs(n - quota[k] / mixing.BLOCK) <= 3 for k, n in Counter(s.rank for s in slots).items())


def test_mix_stage_repeats_rounded(spark, corpus):
    rows = [r for r in corpus if r[0] is not None]
    docs = frame(spark, rows)
    taken = Counter()
    for r in mixing.mix(docs).collect():
        if r["size"]:
            taken[r.doc_id] += math.floor(r.taken / r["size"] + 0.5)
    kept = mixing.mix_stage(spark, docs, "").collect()
    assert Counter(r.doc_id for r in kept) == +taken


def test_kd_shards(spark, corpus):
    rng = random.Random(2)
    rows = corpus + [(1000 + i, "z" * rng.randint(1, 300), rng.choice(["en", "de"]), f"s{i % 5}") for i in range(1500)] + [(5000 + i, "hot copy", "en", "s0") for i in range(700)]
    got = kdshard.shard(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    size, slots = Counter(), {}
    for r in got:
        size[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(size) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / 24
    assert max(size.values()) <= 1.25 * mean and min(size.values()) >= 0.75 * mean
    assert kdshard.shard(frame(spark, rows).limit(0)).count() == 0
    assert kdshard.shard(frame(spark, corpus[:2])).count() == 2


def plain_tree(rows, first, shards):
    """The first shard of each row's leaf: all orders and sums by hand, no digits."""
    if shards == 1 or not rows:
        return {r["i"]: first for r in rows}
    spread = [max(r[f"k{j}"] >> 32 for r in rows) - min(r[f"k{j}"] >> 32 for r in rows) for j in range(4)]
    k = f"k{spread.index(max(spread))}"
    want, share = sum(r["size"] for r in rows) * (shards // 2) / shards, sum(r["size"] for r in rows) / shards
    groups = {}
    for r in rows:
        groups.setdefault(r[k], []).append(r)
    under, left = 0, []
    for key in sorted(groups):
        w = sum(r["size"] for r in groups[key])
        if under + w >= want:
            if w <= share:
                left += groups[key] if under + w - want <= want - under else []
            else:
                for r in sorted(groups[key], key=lambda r: r["id_hash"]):
                    if under + r["size"] >= want:
                        left += [r] if under + r["size"] - want <= want - under else []
                        break
                    under += r["size"]
                    left.append(r)
            break
        under += w
        left += groups[key]
    chosen = {r["i"] for r in left}
    return plain_tree(left, first, shards // 2) | plain_tree([r for r in rows if r["i"] not in chosen], first + shards // 2, shards - shards // 2)


def test_kd_tree_is_that_of_a_plain_one(spark, corpus, monkeypatch):
    monkeypatch.setattr(kdshard, "TOLERANCE", 0)
    rng = random.Random(3)
    rows = corpus + [(1000 + i, "z" * rng.randint(1, 300), rng.choice(["en", "de", ""]), f"source_{i % 5}") for i in range(150)] + [(3000 + i, "hot copy " * 20, "en", f"s{i}") for i in range(120)]
    m = kdshard.materialise(kdshard.measured(frame(spark, rows)), "kd-test")
    plain = [r.asDict() | {"i": i} for i, r in enumerate(m.collect())]
    assert len({r["k2"] >> 32 for r in plain}) >= 10
    expected = plain_tree(plain, 0, 24)
    place = lambda r: tuple(r[c] for c in ("size", "text_crc32", "k0", "k1", "k2", "k3", "id_hash"))
    got = Counter((place(r), r.shard) for r in m.withColumn("shard", kdshard.assignment(kdshard.grow(m))).collect())
    assert got == Counter((place(r), expected[r["i"]]) for r in plain)


def test_equal_texts_share_a_shard(spark):
    rng = random.Random(5)
    rows = [(i, "t" * rng.randint(20, 400) + str(i), rng.choice(["en", "fr"]), f"s{i % 7}") for i in range(600)]
    rows += [(700 + i, rows[i % 40][1], rng.choice(["en", "de", None]), f"s{rng.randrange(9)}") for i in range(160)]
    shards = {}
    for r in kdshard.shard(frame(spark, rows)).collect():
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    assert len(shards) == 600 and all(len(s) == 1 for s in shards.values())


def test_warc_round_trip(spark):
    big = "é<p>" * 600
    pages = [(1, "http://a", "small"), (2, None, "small"), (3, "http://b", big), (4, "http://c\r\nX: y", big), (5, None, big), (6, None, None), (7, None, ""), (5, None, big), (None, None, big), (8, None, "\r\n\r\nWARC/1.0\r\n" * 200), (9, None, "y" * 200_000)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, record_type string")
    for segment in (300, warc.SEGMENT_BYTES):
        got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df, segment_bytes=segment).collect())
        expected = []
        for page, _, html in pages:
            body = (html or "").encode()
            revisit = html == big and page != 5
            expected.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", 5 if revisit else None))
        assert got == Counter(expected)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_ordinary_pages_are_segmented(spark, tmp_path):
    """Pages of some KB go through continuation records at the segment size of the query."""
    import gzip

    pages = [(i, "http://a", f"<p>{i} {'word ' * (400 * i)}</p>") for i in range(1, 7)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = str(tmp_path / "archives")
    warc.write_archives(df, path)
    records = [h for f in (tmp_path / "archives").glob("*.gz") for h, _ in warc.parse(gzip.decompress(f.read_bytes()))]
    assert len({h["WARC-Segment-Origin-ID"] for h in records if h["WARC-Type"] == "continuation"}) >= 4
    assert {(r.page_id, bytes(r.payload).decode()) for r in warc.read_archives(spark, path).collect()} == {(i, html) for i, _, html in pages}


def test_warc_detects_damage():
    record = warc.record("response", [("WARC-Record-ID", "x")], b"abc") + b"\r\n\r\n"
    assert list(warc.parse(record + record))[1][1] == b"abc"
    for bad in (record[:-3], record.replace(b"Length: 3", b"Length: 4"), b"junk" + record):
        with pytest.raises(ValueError):
            list(warc.parse(bad))
    assert warc.dechunked(warc.chunked(b"q" * 20_000)) == b"q" * 20_000
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_missing_segment_fails(spark, tmp_path):
    lost = [warc.record("response", [("WARC-Record-ID", "<a>"), ("WARC-Segment-Number", 1)], b"HTTP/1.1 200 OK\r\n\r\nabc"), warc.record("continuation", [("WARC-Record-ID", "<b>"), ("WARC-Segment-Origin-ID", "<a>"), ("WARC-Segment-Number", 3), ("WARC-Segment-Total-Length", 25)], b"end")]
    import gzip

    (tmp_path / "x.gz").write_bytes(gzip.compress(b"".join(r + b"\r\n\r\n" for r in lost)))
    with pytest.raises(Exception, match="incomplete segments"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_license_rules(spark, corpus):
    texts = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0; see CC BY-NC 4.0 and CC BY NC", "mit license under the mit license under the mit licensed", "GNU General Public License, version 3", "SPDX-License-Identifier: LGPL-2.1-or-later", "nothing here", None, "", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts, 2000)] + [r for r in corpus if r[0] is not None]
    got = {r.doc_id - 2000 if r.doc_id >= 2000 else r.doc_id + 5000: r for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    for d, t, *_ in rows:
        w, places = ITEM.findall(lower(t or "")), []
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        r = got[d - 2000 if d >= 2000 else d + 5000]
        at = [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert got[0].labels == "mit" and got[3].labels == "gpl-3" and got[4].labels == "lgpl-2.1" and got[5].labels == "" and got[8].labels == "mit"
    assert "cc-by-nc" in got[1].labels and "apache-2" in got[1].labels.split(",") and "apache" not in got[1].labels.split(",")
    assert len(licenses.rules()) > 400


def test_license_prefilter_loses_nothing():
    """Every rule's keywords occur in whatever its regex matches: running all rules changes nothing."""
    flat = b" licensed under the gnu general public license version 2 or later dual licensed under mpl all rights reserved cc by sa 4 0 license spdx license identifier mit 0 "
    every = sorted(licenses.Detection(flat.count(b" ", 0, m.start()) - 1, flat.count(b" ", 0, m.start()) - 1 + m.group().count(b" "), r.label, r.priority) for r in licenses.rules() for m in r.pattern.finditer(flat))
    assert sorted(licenses.detect(flat)) == every and every
    kept = licenses.resolve(every)
    for a in kept:
        assert not any(b is not a and b.first <= a.first and a.last <= b.last and b.priority > a.priority for b in kept)


def sample_of(parsed, rng):
    """A random text that a parsed pattern matches."""
    out = ""
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "IN":
            out += chr(next(iter(c[1] if str(c[0]) == "LITERAL" else rng.randint(*c[1]) if str(c[0]) == "RANGE" else ord("7" if "DIGIT" in str(c[1]) else "w") for c in rng.sample(arg, 1))))
        elif name == "BRANCH":
            out += sample_of(rng.choice(arg[1]), rng)
        elif name == "SUBPATTERN":
            out += sample_of(arg[3], rng)
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(sample_of(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 2))))
    return out


def test_license_rules_meet_whatever_their_patterns_do():
    """Texts drawn from each rule's own pattern pass its keywords."""
    from re import _parser

    rng = random.Random(1)
    for rule in licenses.rules():
        for _ in range(4):
            text = sample_of(_parser.parse(rule.pattern.pattern.decode()), rng)
            flat = f" before {text} after ".encode()
            assert any(d.label == rule.label and d.priority == rule.priority for d in licenses.detect(flat)), (rule, text)


def test_license_labels_equal_those_of_every_rule_and_every_pair(spark):
    """Labels and detections of random mixtures of notices, against all rules without keywords and a loop over all pairs."""
    from re import _parser

    rng, rows = random.Random(2), []
    for i in range(40):
        parts = [sample_of(_parser.parse(rng.choice(licenses.rules()).pattern.pattern.decode()), rng) for _ in range(rng.randint(0, 4))]
        rows.append((i, " and ".join(parts) + rng.choice(["", " under the MIT License", " the"]), "en", "s"))
    for r in licenses.scan_licenses(frame(spark, rows)).collect():
        w = ITEM.findall(lower(rows[r.doc_id][1]))
        flat = (" " + " ".join(w) + " ").encode()
        found = set()
        for rule in licenses.rules():
            for m in rule.pattern.finditer(flat):
                first = flat[: m.start()].count(b" ") - 1
                found.add((first, first + m.group().count(b" "), rule.label, rule.priority))
        kept = []
        for d in sorted(found, key=lambda d: (-d[3], d[0] - d[1], d[0], d[2])):
            if not any(k[0] <= d[0] and d[1] <= k[1] for k in kept):
                kept.append(d)
        assert [tuple(d) for d in r.detections] == sorted(kept)
        assert r.labels == ",".join(sorted({d[2] for d in kept} | set(filter(None, r.base_labels.split(",")))))
    assert licenses.scan_licenses(frame(spark, rows).limit(0)).count() == 0


def test_long_license_text_takes_time_in_proportion():
    import time

    took = []
    for n in (5_000, 40_000):
        began = time.perf_counter()
        licenses.resolve(licenses.detect(b" " + b"licensed under the mit license " * n))
        took.append(time.perf_counter() - began)
    assert took[1] < 24 * took[0]


def kt(zeros, ones):
    p, a, b = 1.0, 0, 0
    for _ in range(zeros):
        p *= (a + 0.5) / (a + b + 1)
        a += 1
    for _ in range(ones):
        p *= (b + 0.5) / (a + b + 1)
        b += 1
    return p


def test_context_tree_is_exact():
    """One byte's decisions, tree of depth 1 over two contexts: the CTW recursion by hand, in fractions of counts."""
    tree = ctw.Tree()
    tree.grow(np.array([1]), np.array([97]))
    root, a = np.zeros((1, 256)), np.zeros((1, 256))
    root[0, [97, 98]] = 5, 4
    a[0, [97, 98]] = 1, 3
    table = ctw.code_table(tree, [root, a])
    bits = lambda b: [b >> k & 1 for k in range(7, -1, -1)]
    for node, b in ((1, 97), (1, 98), (2, 98), (2, 5)):
        log = 0.0
        for k in range(8):
            prefix = bits(b)[:k]
            n = lambda c, bit: int(sum(c[0, x] for x in range(256) if bits(x)[:k] == prefix and bits(x)[k] == bit))
            r0, r1, a0, a1 = n(root, 0), n(root, 1), n(a, 0), n(a, 1)
            other = (r0 - a0, r1 - a1)
            stop = 0.5 * kt(r0, r1) / (0.5 * kt(r0, r1) + 0.5 * kt(a0, a1) * kt(*other))
            leaf = (a0, a1) if node == 2 else other
            bit = bits(b)[k]
            p = stop * ((r0, r1)[bit] + 0.5) / (r0 + r1 + 1) + (1 - stop) * (leaf[bit] + 0.5) / (sum(leaf) + 1)
            log += math.log10(p)
        assert math.isclose(table[node, b], log, rel_tol=1e-4)
    assert np.allclose((10.0 ** table[1:].astype(float)).sum(1), 1, atol=1e-4)


def test_context_counts_are_those_of_a_plain_count(spark, corpus):
    texts = [lower(t or "") for d, t, *_ in corpus][:20]
    tree, codes = ctw.train(spark.createDataFrame([(t,) for t in texts], "text string"), depth=3, share=64)
    children = tree.children()
    assert (children[(np.arange(len(tree.parent)) << 8)[0]] == 0) and len(tree.parent) > 10
    counts = Counter()
    for t in texts:
        b = t.encode() + b"\0"
        for i in range(len(b)):
            for d in range(1, 4):
                if i >= d:
                    counts[b[i - d : i]] += 1
    total = sum(len(t.encode()) + 1 for t in texts)
    kept = {k for k, n in Counter(t.encode()[i : i + d] + b"" for t in texts for d in (1, 2, 3) for i in range(len(t.encode()) - d + 1)).items() if n >= -(-total // 64)}
    paths = set()
    for i in range(2, len(tree.parent)):
        path, at = b"", i
        while at > 1:
            path, at = path + bytes([tree.byte[at]]), tree.parent[at]
        paths.add(path)
    assert {p for p in paths if b"\0" not in p} == kept


def test_context_tree_scores(spark, corpus):
    docs = frame(spark, corpus)
    got = ctw.score(docs, depth=2, share=256).collect()
    assert len(got) == len(corpus)
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    c, ends = Counter(), 0
    for d, t, *_ in corpus:
        if not held(d):
            c.update(words(t))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    expected = Counter()
    for d, t, *_ in corpus:
        w = words(t)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        expected[(d, held(d), len(w) + 1, sum(c[x] > 0 for x in w) + 1, n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected
    assert all(r.score < 0 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[103] == by[104]
    assert ctw.score(docs.limit(0)).count() == 0
    trained = [r for r in got if r.n_tokens > 20]
    assert sum(r.score for r in trained) > sum(-8 * math.log10(2) * (len((r.text or "").encode()) + 1) for r in trained)


@pytest.mark.parametrize("depth, share", [(5, 1 << 21), (5, 64), (4, 1), (2, 256)])
def test_context_tree_keeps_every_context_met_twice(spark, corpus, depth, share):
    """The distributed tree against the tree in one place; it holds the same contexts however many rows are added."""
    docs = frame(spark, corpus + [(10_000 + i, "zq " * 400, "en", "s") for i in range(40)])
    learn = docs.where(~ctw.hold_out("doc_id", 7, 2)).select("text")
    total = sum(len((r.text or "").encode()) + 1 for r in learn.collect())
    tree, codes = ctw.train(learn, depth, -(-total // ctw.LEAST))
    assert ctw.LEAST == 2 and len(tree.parent) > 50
    children = tree.children()
    for r in ctw.score(docs, depth, share).collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        text, _ = ctw.padded(data, np.array([0, len(data)]), depth)
        expected = codes[ctw.walk(children, text, depth, True), text[depth:]].astype(float).sum()
        assert math.isclose(r.score, expected, rel_tol=1e-5)


def test_quality_on_held_out_rows(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        body = [rng.choice(vocabulary) for _ in range(rng.randint(20, 80))]
        rows.append((i, " ".join(body) if good else rng.choice([" ".join(w.upper() + "!!" for w in body), " ".join([body[0]] * 50), " ".join(w + "%%%" for w in body)]), "en", "s"))
        labels.append((i, int(good), 0))
    rows += [(900, None, None, None), (901, "", "en", "s"), (1, rows[1][1], "en", "s"), (None, "x y", "en", "s")]
    labels += [(900, None, None)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.score_quality(frame(spark, rows), lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {d: q for d, q, _ in labels}
    held = [r for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert len(held) > 50 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert {r.score for r in got if r.doc_id in (900, 901)} == {next(r.score for r in got if r.doc_id == 901)}
    assert quality.score_quality(frame(spark, rows), lab.limit(0)).count() == len(rows)
    assert quality.score_quality(frame(spark, rows).limit(0), lab).count() == 0


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.AdditiveModel().fit(x[:3000], y[:3000])
    assert model.pairs[0] == (0, 1)
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    by_hand = model.bias + sum(t[np.searchsorted(e, x[0, j], "right")] for j, (e, t) in enumerate(zip(model.edges, model.tables))) + sum(g[np.searchsorted(model.coarse[a], x[0, a], "right"), np.searchsorted(model.coarse[b], x[0, b], "right")] for (a, b), g in zip(model.pairs, model.pair_tables))
    assert math.isclose(model.score(x[:1])[0], 1 / (1 + math.exp(-by_hand)))


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        body = [rng.choice(vocabulary) for _ in range(rng.randint(10, 80))]
        for _ in range(3 if toxic else 0):
            body.insert(rng.randrange(len(body)), rng.choice(["Zzidiot", "zzscum", "zztrash"]))
        rows.append((i, " ".join(body), "en", "s"))
        labels.append((i, 1, int(toxic)))
    rows += [(900, None, None, None), (901, "", "en", "s"), (1, rows[1][1], "en", "s"), (None, "x", "en", "s")]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(frame(spark, rows), lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in held) >= 0.97 * len(held)
    assert all(r.predicted == 0 for r in got if r.doc_id in (900, 901))
    assert toxicity.score_toxicity(frame(spark, rows), lab.limit(0)).count() == len(rows)
    assert toxicity.score_toxicity(frame(spark, rows).limit(0), lab).count() == 0


def test_gradients_are_those_of_finite_differences():
    rng = np.random.default_rng(1)
    net = toxicity.TextCNN()
    texts = [rng.integers(0, 30, (n, 2)) for n in (4, 7, 1, 5)]
    net.fit(texts, np.zeros(4, np.float32))
    net.p = {k: rng.normal(0, 0.5, v.shape) for k, v in net.p.items()}
    net.p["emb"][0] = 0
    words, first, y = np.concatenate(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts]))), np.array([0, 1, 1, 0])

    def loss():
        z = net.logits(words, first)
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    grads = net._gradients(words, first, y)
    emb = np.zeros_like(net.p["emb"])
    emb[grads["emb"][0]] = grads["emb"][1]
    for k, g in (grads | {"emb": emb}).items():
        for at in rng.integers(0, g.size, 12):
            i = np.unravel_index(at, g.shape)
            if k == "emb" and i[0] == 0:
                continue
            old, step = net.p[k][i], 1e-5
            net.p[k][i] = old + step
            up = loss()
            net.p[k][i] = old - step
            down = loss()
            net.p[k][i] = old
            assert math.isclose((up - down) / (2 * step), g[i], rel_tol=2e-3, abs_tol=2e-5), (k, i)


def test_quality_features_are_those_of_a_plain_count():
    texts = ["", "One two, two!\nOne two, two!", "é # | 12 AB\n\n", "x", " \n", "a" * 300 + " b b"]
    data = "".join(texts).encode()
    offs = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    got = quality.feature_rows(np.frombuffer(data, np.uint8), offs)
    for t, row in zip(texts, got, strict=True):
        b, w = t.encode(), [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", t)]
        n, size, lines = max(len(w), 1), max(len(b), 1), b.split(b"\n")
        letters = sum(65 <= c <= 90 or 97 <= c <= 122 for c in b)
        count = lambda chars: sum(c in chars for c in b)
        plain = {
            "log_words": math.log1p(len(w)), "mean_word": sum(map(len, w)) / n, "upper": sum(65 <= c <= 90 for c in b) / max(letters, 1), "exclamation": count(b"!") / n, "symbol": count(b"#$%&*@^~<>") / n,
            "bar": count(b"|") / n, "digit": count(b"0123456789") / size, "stop": count(b".") / n, "comma": count(b",") / n, "newline": count(b"\n") / n, "non_ascii": sum(c > 127 for c in b) / size,
            "distinct_words": len(set(w)) / n, "repeat_next": sum(x == y for x, y in zip(w, w[1:])) / n, "distinct_lines": len(set(lines)) / len(lines), "longest_word": math.log1p(max(map(len, w), default=0)), "letters": letters / size,
        }
        assert np.allclose(row, [plain[f] for f in quality.FEATURES])


def test_sample_is_bounded_and_the_same_again(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    some = quality.sampled(df, "doc_id", 2000)
    ids = {r.doc_id for r in some.collect()}
    assert 1500 < len(ids) <= 2000 and ids == {r.doc_id for r in quality.sampled(df.repartition(7), "doc_id", 2000).collect()}
    assert quality.sampled(df, "doc_id", 20_000).count() == 20_000


def test_guessed_language():
    text = "the cat and the dog of it|der hund und die katze ist|le chat et la souris est|el perro y los gatos por|qqq".split("|")
    got = []
    for t in text:
        b = np.frombuffer(t.encode(), np.uint8)
        got.append(int(toxicity.guess_language(toxicity.language_table(), *toxicity.buckets(b, np.array([0, len(b)])))[0]))
    assert got == [1, 3, 2, 4, 0]
