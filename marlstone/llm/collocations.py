"""Phrase collocation mining: count-min sketches find the n-grams that may be frequent, a second pass counts those exactly.

Texts are A-Z lower-cased and cut at PIECE_BYTES into pieces, those at space and
tab into words; phrases are up to LONGEST consecutive words of a piece.  All is
by group (a language): n counts the words, f(phrase) its places, overlaps
included.

1. Each task counts the 1- to LONGEST-grams of its texts in a count-min sketch
   (DEPTH rows of counters that stop at LEAST, by hash) and hands it on in
   slices; a slice's counters are added up over all tasks.  A counter is never
   below the true count of an n-gram that falls on it, as long as that is below
   LEAST, so of the merged sketch one bit a counter is kept: LEAST or more.
2. The bits are broadcast.  The second pass over the texts drops each n-gram of
   which any bit is unset, and counts all others exactly: in each task, then by
   phrase, in ranges of hashes.  A task's phrases of a range travel sorted and
   compressed.  So nothing frequent is lost, and what the sketch let through
   wrongly goes with its exact count.
3. A candidate is a phrase of 2 to LONGEST words with a = f(phrase) >= LEAST.  The
   parts of a candidate are at least as frequent, so they were counted too.  It
   is scored by its weakest cut into two parts, floor(SCALE * a * a / (l * r)),
   in decimals of 38 digits.
4. A candidate is subsumed, and dropped, by a longer one (dropped or not) that
   holds it and has SHARE of 100 of its places or more.
5. The first TOP of each group are ranked, in buckets first.

The sketch has a counter for every BYTES_A_COUNTER bytes of text, from 2^MIN_BITS
to 2^MAX_BITS in a row.  So a task holds DEPTH * 2^MAX_BITS bytes at most, and
DEPTH * 2^MAX_BITS / 8 bytes are broadcast at most.  Beyond, more rare n-grams
reach the exact count; the result is the same.

Edge cases: a null text is empty; a null group is called `und`, like a group of
that name; repeated rows count each; a text of no words gives nothing; a very
long text is whole and read by one task; other columns are ignored; an empty
table gives no rows.  Within a task words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise, table
from .packing import pack, unpack
from .textvec import SPACE_BYTES, blocks, lower_table, mix, pieces, spans, word_hashes

LEAST = 10
LONGEST = 3
SHARE = 50
SCALE = 1_000_000
TOP = 2000
NO_GROUP = "und"
PIECE_BYTES = b".,;:!?\x0a\x0b\x0c\x0d"
DEPTH = 2
BYTES_A_COUNTER, MIN_BITS, MAX_BITS = 32, 16, 26
#: Ranges of hashes for each shuffle partition; counters of a slice; n-grams that a task adds to its sketch, and survivors that it counts, at a time; buckets in which candidates are ranked first.
RANGES = 4
SLICE = 1 << 16
ADDED = 1 << 22
COUNTED = 1 << 20
RANKED_BY = 64


def _separated(data: np.ndarray, offs: np.ndarray):
    """Words of the rows in data: starts, ends, first word of each row (one more at the end), and for each word how many words of its piece follow it, LONGEST - 1 at most."""
    starts, ends, first = spans(data, offs, SPACE_BYTES + PIECE_BYTES)
    piece = np.zeros(256, bool)
    piece[np.frombuffer(PIECE_BYTES, np.uint8)] = True
    place = np.concatenate(([0], np.cumsum(piece[data])))[starts] if len(starts) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    after = np.zeros(len(starts), np.int64)
    for k in range(1, LONGEST):
        together = (place[k:] == place[:-k]) & (row[k:] == row[:-k])
        after[: len(after) - k] += together
    return starts, ends, first, row, after


def grams(hashes: np.ndarray, after: np.ndarray, group: np.ndarray):
    """(k, first word, key) for each k from 1 to LONGEST: the k-grams; group: a hash for each word's group."""
    key = mix(hashes ^ group)
    for k in range(1, LONGEST + 1):
        at = np.flatnonzero(after >= k - 1)
        yield k, at, mix(key[at] + np.uint64(k))
        if k < LONGEST:
            key[:-k] = mix(key[:-k] * np.uint64(0x9FB21C651E98DF25) + hashes[k:])


def _texts(batches):
    """For each block of rows: lower-cased bytes, words as _separated() has them, word hashes, the groups' names, the number of each row's, and each word's group hash."""
    import pyarrow.compute as pc

    for batch in pieces(batches, "text"):
        group = batch.column("part").dictionary_encode()
        names = group.dictionary.to_pylist()
        number = pc.fill_null(group.indices, 0).to_numpy(zero_copy_only=False)
        of = np.array([_name_hash(x) for x in names], np.uint64)
        for at, rows, data, offs in blocks(batch.column("text")):
            data = lower_table()[data]
            starts, ends, first, row, after = _separated(data, offs)
            own = number[at : at + rows]
            yield data, starts, ends, first, row, after, word_hashes(data, starts, ends), names, own, of[own][row]


def _name_hash(name: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def cells(key: np.ndarray, bits: int):
    """For each row of the sketch the counter of each key."""
    for d in range(DEPTH):
        yield (mix(key + np.uint64(d)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _sketched(bits: int):
    """A function for mapInArrow: texts -> the task's sketch, in compressed slices (slice, body)."""

    def run(batches):
        import pyarrow as pa

        sketch = np.zeros((DEPTH, 1 << bits), np.uint8)
        held: list[np.ndarray] = []
        n = 0

        def add() -> None:
            key, count = np.unique(np.concatenate(held), return_counts=True)
            for row, at in zip(sketch, cells(key, bits), strict=True):
                # The counters of equal cells are added first, so that none passes LEAST or a byte.
                order = np.argsort(at, kind="stable")
                head = np.flatnonzero(np.concatenate(([True], at[order][1:] != at[order][:-1])))
                sums, at = np.add.reduceat(count[order], head), at[order][head]
                row[at] = np.minimum(row[at] + sums, LEAST)

        for _, _, _, _, _, after, hashes, _, _, group in _texts(batches):
            for _, _, key in grams(hashes, after, group):
                held.append(key)
                n += len(key)
            if n >= ADDED:
                add()
                held, n = [], 0
        if n:
            add()
        width = min(SLICE, 1 << bits)
        flat = sketch.reshape(-1, width)
        for a in range(0, len(flat), 64):
            used = [i for i in range(a, min(a + 64, len(flat))) if flat[i].any()]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([pa.compress(flat[i].tobytes(), codec="zstd", asbytes=True) for i in used], pa.binary())], names=["slice", "body"])

    return run


def _merged(bits: int):
    """A function for mapInArrow: slices sorted by number -> (slice, bits): of each slice's sums one bit a counter."""

    def run(batches):
        import pyarrow as pa

        width = min(SLICE, 1 << bits)
        now, total = None, np.zeros(width, np.int64)

        def finish():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(total >= LEAST).tobytes()], pa.binary())], names=["slice", "bits"])

        for batch in batches:
            for k, body in zip(batch.column("slice").to_pylist(), batch.column("body").to_pylist(), strict=True):
                if k != now:
                    if now is not None:
                        yield finish()
                    now = k
                    total[:] = 0
                total += np.frombuffer(pa.decompress(body, decompressed_size=width, codec="zstd", asbytes=True), np.uint8)
        if now is not None:
            yield finish()

    return run


def frequent_bits(texts: DataFrame, bits: int) -> bytes:
    """The merged sketch of texts (text, part), one bit a counter: DEPTH << bits bits, a size that the parameter bounds."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = texts.mapInArrow(_sketched(bits), "slice int, body binary")
    merged = slices.repartition(parts, "slice").sortWithinPartitions("slice").mapInArrow(_merged(bits), "slice int, bits binary")
    width = min(SLICE, 1 << bits) // 8
    out = np.zeros((DEPTH << bits) // 8, np.uint8)
    for r in merged.collect():
        out[r.slice * width : (r.slice + 1) * width] = np.frombuffer(r.bits, np.uint8)
    return out.tobytes()


SENT = "part string, range int, phrases binary, counts binary"


def _counted(sketch, bits: int, ranges: int):
    """A function for mapInArrow: texts -> SENT: for each part and range the task's phrases that the sketch lets through, and their counts; range -1: the part's words."""

    def run(batches):
        import pyarrow as pa

        rows = np.frombuffer(sketch.value, np.uint8).reshape(DEPTH, -1)
        parts: dict[str, int] = {}
        words: list[int] = []
        # Of each survivor: its key in order, and by `place` its phrase and part.
        known, counts, place = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        phrases: list[bytes] = []
        part_of: list[np.ndarray] = []

        def out():
            if not len(known):
                return
            names, of = list(parts), np.concatenate(part_of)[place]
            where = of * ranges + (known % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(where[order])) + 1):
                own = place[some].tolist()
                by = sorted(range(len(own)), key=lambda i: phrases[own[i]])
                body = b"\n".join(phrases[own[i]] for i in by)
                p, r = divmod(int(where[some[0]]), ranges)
                yield sent([(names[p], r, struct.pack("<I", len(body)) + pa.compress(body, codec="zstd", asbytes=True), pack(counts[some[by]].astype(np.uint64)))])

        def sent(rows_):
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows_, strict=True), kinds, strict=True)], names=["part", "range", "phrases", "counts"])

        for data, starts, ends, first, row, after, hashes, names, own, group in _texts(batches):
            number = np.array([parts.setdefault(x, len(parts)) for x in names], np.int64)[own]
            words += [0] * (len(parts) - len(words))
            for p, c in zip(number.tolist(), np.diff(first).tolist(), strict=True):
                words[p] += c
            raw = data.tobytes()
            for k, at, key in grams(hashes, after, group):
                live = np.ones(len(key), bool)
                for bits_of, cell in zip(rows, cells(key, bits), strict=True):
                    live &= (bits_of[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
                key, head, n = np.unique(key[live], return_index=True, return_counts=True)
                head = at[live][head]
                found = np.searchsorted(known, key)
                old = np.zeros(len(key), bool)
                inside = found < len(known)
                old[inside] = known[found[inside]] == key[inside]
                counts[found[old]] += n[old]
                fresh = np.flatnonzero(~old)
                if not len(fresh):
                    continue
                where = np.arange(len(phrases), len(phrases) + len(fresh))
                phrases += [b" ".join(raw[a:b] for a, b in zip(starts[i : i + k].tolist(), ends[i : i + k].tolist(), strict=True)) for i in head[fresh].tolist()]
                part_of.append(number[row[head[fresh]]])
                known, counts, place = (np.insert(x, found[fresh], y) for x, y in ((known, key[fresh]), (counts, n[fresh]), (place, where)))
            if len(known) >= COUNTED:
                yield from out()
                known, counts, place = known[:0], counts[:0], place[:0]
                phrases.clear()
                part_of.clear()
        yield from out()
        if parts:
            yield sent([(name, -1, None, pack(np.array([n], np.uint64))) for name, n in zip(parts, words, strict=True)])

    return run


def _summed(batches):
    """Rows of SENT sorted by part and range -> (part, k, phrase, n): phrases met LEAST times or more, and with k 0 the part's words."""
    import pyarrow as pa

    now, total = None, {}

    def finish():
        part, r = now
        kept = [(p.count(b" ") + 1 if r >= 0 else 0, p.decode("utf-8", "replace"), n) for p, n in total.items() if n >= LEAST or r < 0]
        for i in range(0, len(kept), 50_000):
            k, phrase, n = zip(*kept[i : i + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(k), pa.string()), pa.array(k, pa.int32()), pa.array(phrase, pa.string()), pa.array(n, pa.int64())], names=["part", "k", "phrase", "n"])

    for batch in batches:
        for part, r, body, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "range", "phrases", "counts")), strict=True):
            if (part, r) != now:
                if now is not None:
                    yield from finish()
                now, total = (part, r), {}
            (n,) = unpack(counts)
            own = [b""] if r < 0 else pa.decompress(body[4:], decompressed_size=struct.unpack("<I", body[:4])[0], codec="zstd", asbytes=True).split(b"\n")
            for p, c in zip(own, n.tolist(), strict=True):
                total[p] = total.get(p, 0) + c
    if now is not None:
        yield from finish()


def counted(texts: DataFrame, sketch, bits: int, ranges: int) -> DataFrame:
    """(part, range, phrases, counts): what each task counts of what the sketch lets through."""
    return texts.mapInArrow(_counted(sketch, bits, ranges), SENT)


def frequent_phrases(texts: DataFrame) -> DataFrame:
    """(part, k, phrase, n), written: all phrases of 1 to LONGEST words met LEAST times or more in their part, and with k 0 each part's words; texts: text, part."""
    spark = texts.sparkSession
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(MAX_BITS, max(MIN_BITS, (size // BYTES_A_COUNTER).bit_length()))
    sketch = spark.sparkContext.broadcast(frequent_bits(texts, bits))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    some = counted(texts, sketch, bits, RANGES * partitions).repartition(partitions, "part", "range").sortWithinPartitions("part", "range")
    return materialise(some.mapInArrow(_summed, "part string, k int, phrase string, n long"), "phrases")


def scored(phrases: DataFrame) -> DataFrame:
    """(part, phrase, a, l, r, score) of each candidate in phrases that no longer one subsumes."""
    counted = phrases.where("k > 0")
    words = F.split("phrase", " ")
    cuts = counted.where("k > 1").select("part", "phrase", F.col("n").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    part_of = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = cuts.select("part", "phrase", "a", "cut", part_of(F.lit(1), F.col("cut")).alias("left"), part_of(F.col("cut") + 1, F.size("w") - F.col("cut")).alias("right"))
    side = lambda name, n: counted.select("part", F.col("phrase").alias(name), F.col("n").alias(n))
    met = cuts.join(side("left", "l"), ["part", "left"]).join(side("right", "r"), ["part", "right"])
    # 38 digits: a up to 10^16, l * r up to 10^38.
    wide = lambda c, p: F.col(c).cast(f"decimal({p},0)")
    score = F.call_function("div", wide("a", 15) * wide("a", 15) * F.lit(SCALE).cast("decimal(7,0)"), wide("l", 18) * wide("r", 18))
    weakest = met.groupBy("part", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("m"))
    # What lies inside each longer candidate.
    longer = counted.where("k > 2").select("part", "n", F.col("k").alias("k"), words.alias("w"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    within = longer.select("part", "n", F.explode(inner).alias("phrase")).groupBy("part", "phrase").agg(F.max("n").alias("most"))
    kept = weakest.join(within, ["part", "phrase"], "left").where(f"most is null or 100 * most < {SHARE} * a")
    return kept.select("part", "phrase", "a", "m.l", "m.r", F.col("m.score").cast("long").alias("score"))


def ranked(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """The first `top` of each part by score and a, descending, then phrase, numbered from 1; buckets give their own first ones before they meet."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = candidates.withColumn("_b", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_BY)))
    first = salted.withColumn("_r", F.row_number().over(Window.partitionBy("part", "_b").orderBy(*order))).where(F.col("_r") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("_b", "_r")


def collocations(documents: DataFrame, part: str = "lang", top: int = TOP) -> DataFrame:
    """(part, rank, phrase, a, l, r, n, score) of documents (text and the column that names its part)."""
    texts = documents.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col(part).cast("string"), F.lit(NO_GROUP)).alias("part"))
    phrases = frequent_phrases(texts)
    best = materialise(ranked(scored(phrases), top), "collocations")
    words = materialise(phrases.where("k = 0").select("part", "n"), "phrase-words")
    discard(phrases)
    return best.join(words, "part").select("part", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).withColumnRenamed("part", "lang")


ORACLE = rf"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from {{documents}}),
p as (select lang, unnest(regexp_extract_all(t, '[^.,;:!?\x0A-\x0D]+')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
total as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
g as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, w[i:i + k - 1] as words from w, range(1, 4) as ks(k), unnest(range(1, len(w) - k + 2)) as t(i)),
f as (select lang, k, phrase, any_value(words) as words, count(*) as f from g group by lang, k, phrase having count(*) >= 10),
halves as (select lang, phrase, f as a, j as cut, array_to_string(words[1:j], ' ') as l_phrase, array_to_string(words[j + 1:], ' ') as r_phrase from f, range(1, 3) as cs(j) where k > j),
cuts as (select h.lang, h.phrase, a, cut, l.f as l, r.f as r, cast(1000000 as hugeint) * a * a // (cast(l.f as hugeint) * r.f) as score
         from halves h join f l on l.lang = h.lang and l.phrase = l_phrase join f r on r.lang = h.lang and r.phrase = r_phrase),
weakest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inside as (select lang, array_to_string(words[i:i + 1], ' ') as phrase, max(f) as most from f, range(1, 3) as t(i) where k = 3 group by 1, 2),
kept as (select w.* from weakest w left join inside i on w.lang = i.lang and w.phrase = i.phrase where most is null or 100 * most < 50 * a)
select kept.lang, row_number() over (partition by kept.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, cast(score as bigint) as score
from kept join total on kept.lang = total.lang
qualify row_number() over (partition by kept.lang order by score desc, a desc, phrase) <= 2000
"""
