"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Texts and items are normalised to words of [0-9a-z] and non-ASCII bytes, A-Z
lower-cased.  Each item gives windows of WINDOW consecutive words (a shorter
item, but not an empty one, is one window).  The automaton holds every window
as the string of its words, each framed by blanks; a document is normalised
the same way, scanned once, and match ends are mapped back to word numbers and
from there to byte offsets of the original text.

The automaton is broadcast, so its size is checked: the items are dealt into
blocks of at most block_bytes normalised bytes.  Every task reads its texts
once; where a benchmark has several blocks it holds about HELD_BYTES of texts
and takes them past one automaton after the other.  A row's result is bounded
by its text: one span for each place and window length, one entry for each item.

Edge cases: null or empty text has no words and no hit; null or empty items
have no window; the windows of an item of null id count as hits, but the item
cannot be named, so it is in no list of items; repeated rows each get their row;
very long and very repetitive texts are scanned whole; an empty benchmark
leaves all documents clean; input columns named like an output are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, table
from .textvec import NON_WORD_BYTES

WINDOW = 10
BLOCK_BYTES = 4 << 20
HELD_BYTES = 64 << 20
SPANS = "array<struct<first:int,last:int,start:int,stop:int>>"


def normaliser():
    """bytes -> list of words."""
    to = bytearray(range(256))
    for b in range(65, 91):
        to[b] = b + 32
    for b in NON_WORD_BYTES:
        to[b] = 32
    to = bytes(to)
    return lambda text: text.translate(to).split()


def windows_of(words: list[bytes], window: int) -> set[bytes]:
    if not words:
        return set()
    if len(words) <= window:
        return {b" ".join(words)}
    return {b" ".join(words[i : i + window]) for i in range(len(words) - window + 1)}


def patterns_of(items: list[tuple[str | None, str | None]], window: int) -> list[tuple[str, int, list[str]]]:
    """(framed window, number of words, ids of the items that hold it)."""
    split, held = normaliser(), {}
    for item, text in items:
        for w in windows_of(split((text or "").encode()), window):
            held.setdefault(w, set()).add(item)
    return [(f" {w.decode('latin-1')} ", w.count(b" ") + 1, sorted(i for i in ids if i is not None)) for w, ids in held.items()]


def automaton(patterns: list[tuple[str, int, list[str]]]):
    import ahocorasick

    trie = ahocorasick.Automaton()
    for text, n, ids in patterns:
        trie.add_word(text, (n, ids))
    trie.make_automaton()
    return trie


def marks(trie, words: list[bytes]) -> tuple[set[tuple[int, int]], set[str]]:
    """(first, last) word of each place of a window, and the items of all windows met."""
    import bisect

    places, items, begins = set(), set(), []
    # Latin-1 gives each byte one character, so positions are byte positions.
    for end, (n, ids) in trie.iter(" " + b" ".join(words).decode("latin-1") + " "):
        if not begins:
            at = 1
            for w in words:
                begins.append(at)
                at += len(w) + 1
        last = bisect.bisect_left(begins, end) - 1
        places.add((last - n + 1, last))
        items.update(ids)
    return places, items


def _scanner(blocks_):
    """A function for mapInArrow that replaces _text by the number of words, the spans and the items of each row."""

    def scan(batches):
        import pyarrow as pa

        split = normaliser()
        alone = automaton(blocks_[0].value) if len(blocks_) == 1 else None

        def finish(group):
            texts = [[raw or b"" for raw in batch.column("_text").to_pylist()] for batch in group]
            found = [[(set(), set()) for _ in rows] for rows in texts]
            for block in blocks_:
                if not block.value:
                    continue
                trie = alone or automaton(block.value)
                for rows, out in zip(texts, found, strict=True):
                    for raw, (places, items) in zip(rows, out, strict=True):
                        if words := split(raw):
                            more, which = marks(trie, words)
                            places |= more
                            items |= which
            for batch, rows, out in zip(group, texts, found, strict=True):
                n_words, spans, items = [], [], []
                for raw, (places, which) in zip(rows, out, strict=True):
                    words, offsets, at = split(raw), [], 0
                    if places:
                        lowered = raw.lower()
                        for w in words:
                            at = lowered.index(w, at)
                            offsets.append((at, at + len(w)))
                            at += len(w)
                    n_words.append(len(words))
                    spans.append([{"first": a, "last": b, "start": offsets[a][0], "stop": offsets[b][1]} for a, b in sorted(places)])
                    items.append(sorted(which))
                span = pa.struct([(c, pa.int32()) for c in ("first", "last", "start", "stop")])
                new = {"_n_words": pa.array(n_words, pa.int64()), "_spans": pa.array(spans, pa.list_(span)), "_items": pa.array(items, pa.list_(pa.string()))}
                keep = [i for i, n in enumerate(batch.schema.names) if n != "_text"]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *new.values()], names=[*(batch.schema.names[i] for i in keep), *new])

        group, held = [], 0
        for batch in batches:
            group.append(batch)
            held += batch.column("_text").nbytes
            if alone or held > HELD_BYTES:
                yield from finish(group)
                group, held = [], 0
        if group:
            yield from finish(group)

    return scan


def find_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """documents with n_words (long), spans and items: word numbers first..last and byte offsets start..stop of each place of a window, and the ids of the items met."""
    spark = documents.sparkSession
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, math.ceil(total * window / block_bytes))
    made = ("n_words", "spans", "items")
    keep = [c for c in documents.columns if c not in made]
    df = documents.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col("text").cast("binary").alias("_text"))
    blocks_ = []
    for b in range(n_blocks):
        block = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == b).collect()
        blocks_.append(spark.sparkContext.broadcast(patterns_of([(r.item, r.text) for r in block], window)))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema if f.name != "_text")
    df = df.mapInArrow(_scanner(blocks_), f"{fields}_n_words long, _spans {SPANS}, _items array<string>")
    return df.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"_{c}").alias(c) for c in made])


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """documents with n_words, n_hit (words inside any span), n_items, items_sha256 and contaminated."""
    made = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    found = find_spans(documents.select(*[c for c in documents.columns if c not in made]), benchmark, window, block_bytes)
    # Windows of a text overlap heavily; sorted by first word, a span adds the words beyond the furthest one so far.
    swept = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("to")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(a["to"], s["first"] - 1))).cast("long").alias("n"),
            F.greatest(a["to"], s["last"]).alias("to"),
        ),
    )
    return found.select(
        *[c for c in found.columns if c not in ("spans", "items", "n_words")],
        "n_words",
        swept["n"].alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without any benchmark window."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).select(*DOCUMENT_COLUMNS)


def query(spark, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")).drop("text")


WORDS_SQL = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = f"""
with d as (select row_number() over () as r, doc_id, coalesce({WORDS_SQL.format('text')}, []) as w from {{documents}}),
b as (select cast(item_id as varchar) as item, {WORDS_SQL.format('text')} as w from benchmark where text is not null),
win as (select distinct item, least(10, len(w)) as n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as s
        from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as t(i) where len(w) > 0),
lens as (select distinct n from win),
places as (select r, i, n, array_to_string(w[i:i + n - 1], ' ') as s from d, lens, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) as t(i)),
hits as (select r, i, p.n, item from places p join win using (s) where p.n = win.n),
marks as (select r, count(distinct k) as n_hit from hits, unnest(range(i, i + n)) as t(k) group by r),
items as (select r, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct r, item from hits where item is not null) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join marks using (r) left join items using (r)
"""
