"""SimHash near-duplicates: a Gray-order hierarchical index over 64-bit fingerprints.

A text's words (A-Z lower-cased, cut at ASCII white space) give its SHINGLE-word
shingles, repeats included (fewer words, but not none: the whole sequence), each
space-joined and hashed by XXH64 (UTF-8, seed 42).  A bit of the fingerprint is
1 if more than half of the hashes have it.  Fingerprints link at DIFFER or fewer
differing bits; components are those of the links.

1. Equal fingerprints are one node; all later work is on nodes.
2. Of two linked fingerprints, cut into DIFFER + 1 blocks of bits, one block
   agrees.  So each fingerprint goes to one bucket for each block, by the bits
   of that block (`mask` tells which bits a bucket's members share).
3. Within a bucket fingerprints are sorted by Gray rank, where neighbours differ
   in few bits.  FAN neighbours make a node, FAN nodes one of the next level, up
   to the bucket's root.  What all members of a node share is factored into it:
   a mask of common bits and their pattern, less those of the nodes above.
   A search goes down from the root, adds the differences at each level's own
   bits, and leaves a whole subtree as soon as they exceed DIFFER, or when all
   of it is already in the searcher's component.  The sums at the leaves are
   exact distances.
4. A task hands on one edge for each fingerprint at most, to the first of its
   component there, so a group of near copies gives no pairs.
5. A bucket of more than HOT fingerprints does not meet in one task.  It is
   dealt by hash into parts of that size, which are searched; then its members
   go to the buckets of a finer cut, DIFFER + 1 blocks of the bits that they do
   not yet share, since two that link agree in one of those too.  Buckets whose
   members are all in one component by then are done.  This repeats as long as
   enough bits are left; no link is lost.

Edge cases: null, empty and blank text has fingerprint zero and is linked like
any other; repeated rows and ids each keep their row; null ids stay null and
name a component only if it has no other; a very long text is whole and hashed
in one task; other columns are ignored; an empty table gives no rows.
Documents must come from files or a written table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .common import discard, materialise, table
from .textvec import SPACE_BYTES, blocks, lower_table, pieces, spans

SHINGLE = 4
SEED = 42
DIFFER = 4
BITS = 64
#: Children of an index node; searchers that go down together; fingerprints of a bucket that one task searches, and of buckets that it indexes together.
FAN = 8
SEARCHERS = 2048
HOT = 1 << 14
INDEXED = 1 << 16
#: Blocks of fewer bits than this are not cut again.
LEAST_BITS = DIFFER + 1


def fingerprints(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The fingerprint of each text in data (bytes, rows by offs)."""
    import xxhash

    starts, ends, first = spans(lower_table()[data], offs, SPACE_BYTES)
    rows = len(first) - 1
    if not len(starts):
        return np.zeros(rows, np.uint64)
    # All words behind one another with single spaces between: a shingle is one slice.
    lengths = ends - starts
    to = np.cumsum(lengths + 1) - 1
    begin = to - lengths
    body = np.full(int(to[-1]), 0x20, np.uint8)
    inside = np.repeat(begin - starts, lengths) + (source := _ranges(starts, lengths))
    body[inside] = lower_table()[data[source]]
    n_words = np.diff(first)
    count = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, (n_words > 0).astype(np.int64))
    row = np.repeat(np.arange(rows), count)
    head = _ranges(first[:-1], count)
    tail = head + np.minimum(n_words, SHINGLE)[row] - 1
    raw, digest = body.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(begin[head].tolist(), to[tail].tolist(), strict=True)), np.uint64, len(head))
    return majority(h, row, count)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, behind one another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def majority(h: np.ndarray, row: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each row the bits that more than half of its hashes have; row: that of each hash, count: hashes of each row."""
    out = np.zeros(len(count), np.uint64)
    set_bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    lanes = np.ascontiguousarray(h, "<u8").view(np.uint8).reshape(-1, 8)
    for k in range(8):
        seen = np.bincount(row * 256 + lanes[:, k], minlength=256 * len(count)).reshape(-1, 256)
        more = 2 * (seen @ set_bits) > count[:, None]
        out |= np.packbits(more, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * k)
    return out


def _fingerprint(batches):
    import pyarrow as pa

    for batch in pieces(batches, "text"):
        found = [fingerprints(data, offs) for _, _, data, offs in blocks(batch.column("text"))]
        fp = np.concatenate(found) if found else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])


def fingerprinted(documents: DataFrame) -> DataFrame:
    """(doc_id, fp) of each row of documents (doc_id, text); fp has the fingerprint's bits as a long."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprint, "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each number in the Gray code's order, in which neighbours differ in one bit."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """A hierarchical index on fingerprints (unsigned, distinct within a bucket), sorted by bucket, then by Gray rank.

    levels[0] are the fingerprints, the last level one root for each bucket; a
    level has the mask and pattern of each node, of the bits that its members
    share and its parent's do not, and the index of its first member.
    """

    def __init__(self, fp: np.ndarray, bucket: np.ndarray):
        self.n = len(fp)
        low, high, at, of = fp, fp, np.arange(self.n), bucket
        shared, nodes = [np.full(self.n, ~np.uint64(0))], [fp]
        self.first = [at]
        self.child: list[np.ndarray] = [at]
        while len(of) > 1 and (of[1:] == of[:-1]).any():
            fresh = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            place = np.arange(len(of)) - np.repeat(fresh, np.diff(np.append(fresh, len(of))))
            head = np.flatnonzero(place % FAN == 0)
            low, high = np.bitwise_and.reduceat(low, head), np.bitwise_or.reduceat(high, head)
            at, of = at[head], of[head]
            shared.append(~(low ^ high))
            nodes.append(low)
            self.first.append(at)
            self.child.append(head)
        self.mask, self.pattern = [], []
        for k in range(len(nodes)):
            above = np.zeros(len(nodes[k]), np.uint64)
            if k + 1 < len(nodes):
                above = np.repeat(shared[k + 1], np.diff(np.append(self.child[k + 1], len(nodes[k]))))
            self.mask.append(shared[k] & ~above)
            self.pattern.append(nodes[k] & self.mask[k])
        self.fp = fp
        self.root_of = np.searchsorted(self.first[-1], np.arange(self.n), "right") - 1

    def search(self, who: np.ndarray, one_label: list[np.ndarray], label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (searcher, later member of its bucket) that link and have different labels; one_label: for each level the label of all members of a node, or -1."""
        q, node = who, self.root_of[who]
        differ = np.zeros(len(q), np.int64)
        for k in range(len(self.mask) - 1, -1, -1):
            if k < len(self.mask) - 1:
                head = self.child[k + 1]
                count = np.diff(np.append(head, len(self.mask[k])))[node]
                q, differ, node = np.repeat(q, count), np.repeat(differ, count), _ranges(head[node], count)
            differ = differ + np.bitwise_count((self.fp[q] ^ self.pattern[k][node]) & self.mask[k][node])
            last = np.append(self.first[k][1:], self.n)[node] - 1
            keep = (differ <= DIFFER) & (last > q) & (one_label[k][node] != label[q])
            q, node, differ = q[keep], node[keep], differ[keep]
        return q, node

    def link(self, label: np.ndarray) -> np.ndarray:
        """For each fingerprint the smallest position that it is linked to, directly or through others of its bucket; label: components known before."""
        label = label.copy()
        for at in range(0, self.n, SEARCHERS):
            uniform = []
            for first in self.first:
                low, high = np.minimum.reduceat(label, first), np.maximum.reduceat(label, first)
                uniform.append(np.where(low == high, low, -1))
            u, v = self.search(np.arange(at, min(at + SEARCHERS, self.n)), uniform, label)
            label = joined(label, u, v)
        return label


def joined(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """label (positions that name components) after linking u[i] and v[i]; the smallest name stays."""
    while len(u):
        a, b = label[u], label[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        low = np.arange(len(label))
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(low, deeper := low[low]):
            low = deeper
        label = low[label]
    return label


def _linked(batches):
    """Rows (bucket, fp, comp) sorted by bucket, each bucket whole -> edges (u, v) that link each fingerprint to the first of its component here."""
    import pyarrow as pa

    def search(bucket: np.ndarray, fp: np.ndarray, comp: np.ndarray):
        # Position by position: what is one component by now is one label from the start.
        order = np.lexsort((gray_rank(fp.view(np.uint64)), bucket))
        bucket, fp, comp = bucket[order], fp[order], comp[order]
        key = np.lexsort((np.arange(len(fp)), comp, bucket))
        fresh = np.ones(len(fp), bool)
        fresh[1:] = (comp[key][1:] != comp[key][:-1]) | (bucket[key][1:] != bucket[key][:-1])
        label = np.empty(len(fp), np.int64)
        label[key] = key[fresh][np.cumsum(fresh) - 1]
        after = GrayIndex(fp.view(np.uint64), bucket).link(label)
        new = np.flatnonzero((after != label) & (label == np.arange(len(fp))))
        return pa.RecordBatch.from_arrays([pa.array(fp[after[new]]), pa.array(fp[new])], names=["u", "v"])

    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "fp", "comp")))
        n += batch.num_rows
        if n >= INDEXED:
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            whole = int(np.searchsorted(cols[0], cols[0][-1]))  # the last bucket may go on
            if whole:
                yield search(*(c[:whole] for c in cols))
            held, n = [tuple(c[whole:] for c in cols)], len(cols[0]) - whole
    if n:
        yield search(*(np.concatenate(c) for c in zip(*held, strict=True)))


def cut(mask: int) -> list[int]:
    """mask joined by each of DIFFER + 1 blocks of the other bits; two fingerprints that link and agree in mask agree in one of these. Empty where too few bits are left."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    k = DIFFER + 1
    edges = [round(i * len(free) / k) for i in range(k + 1)]
    return [mask | sum(1 << b for b in free[lo:hi]) for lo, hi in zip(edges[:-1], edges[1:], strict=True)] if len(free) >= k * LEAST_BITS else []


def _long(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _posted(rows: DataFrame, parents: list[int]) -> DataFrame:
    """(mask, fp, comp): each row of rows (mask, fp, comp) once for each finer cut of its mask."""
    finer = F.create_map(*[x for m in parents for x in (F.lit(_long(m)), F.array(*[F.lit(_long(c)) for c in cut(m)]))])
    return rows.select(F.explode(F.element_at(finer, F.col("mask"))).alias("mask"), "fp", "comp")


def _bucket(*more: Column) -> Column:
    return F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask")), *more)


def _edges(rows: DataFrame) -> DataFrame:
    return rows.select("bucket", "fp", "comp").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_linked, "u long, v long")


def link_fingerprints(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """(node, comp) of each fingerprint that has a link; nodes: a written table of fp (long), distinct."""
    rows, level = nodes.select(F.lit(0).cast("long").alias("mask"), "fp", F.col("fp").alias("comp")), [0]
    comps, made = None, []
    while True:
        # Two cuts may share out the bits so that they have a finer one in common.
        children = sorted({c for m in level for c in cut(m)})
        posts = _posted(rows, level)
        posts = materialise(posts if comps is None else posts.dropDuplicates(["mask", "fp"]), "simhash-posts")
        if made:
            discard(made.pop())
        keyed = posts.withColumn("bucket", _bucket())
        # At first each node is a component of its own, and no bucket is done.
        done = F.lit(False) if comps is None else F.min("comp") == F.max("comp")
        size = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), done.alias("done")).where(F.col("done") | (F.col("n") > hot))
        size = materialise(size, "simhash-sizes")
        # Few buckets are hot; the planner broadcasts them or splits the join.
        cold = keyed.join(size, "bucket", "left_anti")
        last = not any(cut(c) for c in children)
        open_ = keyed.join(size.where("not done"), "bucket")
        if last:
            edges = _edges(cold.unionByName(open_.drop("n", "done")))
        else:
            parts = F.pmod(F.xxhash64("fp", "bucket"), F.ceil(F.col("n") / hot))
            edges = _edges(cold.unionByName(open_.withColumn("bucket", _bucket(parts)).drop("n", "done")))
        found = materialise(edges if comps is None else edges.unionByName(comps.select(F.col("comp").alias("u"), F.col("node").alias("v"))), "simhash-edges")
        comps = materialise(components(found), "simhash-components")
        discard(found)
        if last or size.where("not done").isEmpty():
            discard(posts)
            discard(size)
            return comps
        rows = open_.select("mask", "fp").join(comps, F.col("fp") == F.col("node"), "left").select("mask", "fp", F.coalesce("comp", "fp").alias("comp"))
        rows = materialise(rows, "simhash-open")
        made.append(rows)
        discard(posts)
        discard(size)
        level = children


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of each row of documents (doc_id, text)."""
    prints = materialise(fingerprinted(documents), "simhash-prints")
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    comps = link_fingerprints(nodes.select("fp"))
    named = nodes.join(comps, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("comp", "fp").alias("comp"), "least")
    low = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(low, "comp").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
