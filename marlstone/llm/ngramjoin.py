"""N-gram Jaccard join: a prefix-tree join over globally ordered n-gram sets.

A document's set is its distinct SHINGLE-word shingles (A-Z lower-cased, words
cut at ASCII white space); a text of fewer words, but not none, is one shingle.
Two documents link when 100 * intersection >= PERCENT * union.

1. Equal sets collapse into one node; all later work is on nodes.
2. One pass over the texts sends each node's shingles, packed by chunks of nodes,
   to the task of their range.  That task knows how many sets hold a shingle and
   sends back, to its chunk, each one that several sets hold.  Shingles of one
   set come first in the global order, then the shared ones, rare first.
3. Two linked sets share a shingle within a prefix of each.  Most prefixes are
   filled by shingles of one set, which join nothing, so few postings are left.
   A posting carries a bitmap of its node's shared shingles: the bits in which
   two differ bound their sets' difference from below.  A shingle of more than
   TILE sets is dealt out in tiles of two blocks of its nodes.
4. Within a task, pairs that pass the bounds of length, position and bitmap are
   candidates; only those of a spanning forest are handed on, so a group of
   near copies gives about one pair for each node, not all pairs.
5. The candidates are verified on whole sets.  A verified forest links all nodes
   of a tree.  The nodes of trees with a pair that did not link go through the
   postings once more, where all candidates between different components are
   handed on and verified, so no link between components is lost.
6. Verification of one set with many is a trie traversal: the sets lie in a
   prefix tree over the global order (frequent first, where copies agree),
   shared paths are intersected once, and a subtree is left as soon as the
   remaining lengths cannot reach the bound.

Edge cases: null, empty and blank text has an empty set, no link and itself as
component; repeated rows and ids each keep their row; null ids stay null and
never name a component if another id can; very long texts are whole (a text's
shingles meet in one task); other columns are ignored; an empty table gives no
rows.  Documents must come from files or a written table, so that a task that
runs again sees the same rows.  Shingles are identified by 64-bit hashes, sets
by 128 bits: sets that agree in the first half only end the job with an error.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .common import DOCUMENT_COLUMNS, discard, materialise, table
from .packing import pack, sort_pack, sort_unpack, unpack
from .textvec import SPACE_BYTES, blocks, lower_table, mix, pieces, shingles, spans, word_hashes

SHINGLE = 5
PERCENT = 75
#: Shingles and rows of a chunk, at most (a single text may have more); ranges of hashes for each shuffle partition.
CHUNK, CHUNK_ROWS = 1 << 22, 100_000
RANGES = 4
#: Bits of a posting's bitmap; nodes of a tile's block, about; sets in one trie, at most.
BITS = 512
TILE = 4096
TRIE_SETS = 256
#: Nodes whose trees one task remembers; beyond, it starts afresh and hands on some pairs more.
REMEMBERED = 1 << 20


def _sets(column):
    """(first row, names, checks, sizes, hashes, offsets) of blocks of texts: their distinct shingles in hash order."""
    for row, _, data, offs in blocks(column):
        data = lower_table()[data]
        starts, ends, first = spans(data, offs, SPACE_BYTES)
        h, at = shingles(word_hashes(data, starts, ends), first, SHINGLE)
        for a, b in zip(at[:-1], at[1:], strict=True):
            h[a:b].sort()
        fresh = np.ones(len(h), bool)
        fresh[1:] = h[1:] != h[:-1]
        fresh[at[:-1][at[:-1] < at[1:]]] = True
        size = np.diff(np.concatenate(([0], np.cumsum(fresh)))[at])
        h, at = h[fresh], np.concatenate(([0], np.cumsum(size)))
        names = []
        for seed in (0x5851F42D4C957F2D, 0x2545F4914F6CDD1D):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(seed)), dtype=np.uint64)))[at]
            names.append(mix(sums[1:] - sums[:-1] + size.astype(np.uint64)).view(np.int64))
        yield row, *names, size, h, at


SENT = "range int, chunk long, kind int, body binary"


def _sent(rows: list[tuple]):
    import pyarrow as pa

    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary())
    cols = zip(*rows, strict=True) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["range", "chunk", "kind", "body"])


def _post(ranges: int):
    """For each chunk of this task's rows a header (kind 0: its rows and its nodes), and for each range the shingles of its nodes (kind 1)."""

    def run(batches):
        from pyspark import TaskContext

        pid, k = TaskContext.get().partitionId(), 0
        seen: set[int] = set()
        rows: list[list[np.ndarray]] = []
        h, ordinal, nodes, sizes, held = [], [], [], [], 0

        def flush():
            chunk = pid << 20 | k
            of_rows = [np.concatenate(c).view(np.uint64) for c in zip(*rows, strict=True)]
            yield _sent([(k % ranges, chunk, 0, pack(*of_rows, np.array(nodes, np.int64).view(np.uint64), np.array(sizes, np.uint64)))])
            if h:
                hs, os_ = np.concatenate(h), np.concatenate(ordinal)
                order = np.argsort(hs)
                hs, os_ = hs[order], os_[order]
                of = ((hs >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                edges = np.searchsorted(of, np.arange(ranges + 1, dtype=np.uint64))
                out = []
                for r in range(ranges):
                    a, b = edges[r], edges[r + 1]
                    if b > a:
                        out.append((r, chunk, 1, sort_pack(hs[a:b], os_[a:b])))
                    if len(out) == 256:
                        yield _sent(out)
                        out = []
                if out:
                    yield _sent(out)

        for batch in pieces(batches, "text"):
            ids = batch.column("doc_id")
            valid = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for row, name, check, size, hs, at in _sets(batch.column("text")):
                own = slice(row, row + len(name))
                rows.append([ids[own].astype(np.int64), valid[own].astype(np.int64), name, check, size.astype(np.int64)])
                fresh = []
                for r in np.flatnonzero(size):
                    if int(name[r]) not in seen:
                        seen.add(int(name[r]))
                        fresh.append(r)
                if fresh:
                    take = np.zeros(len(size), bool)
                    take[fresh] = True
                    h.append(hs[np.repeat(take, size)])
                    ordinal.append(np.repeat(np.arange(len(nodes), len(nodes) + len(fresh), dtype=np.uint32), size[fresh]))
                    nodes += name[fresh].tolist()
                    sizes += size[fresh].tolist()
                    held += len(h[-1])
                if held >= CHUNK or sum(len(r[0]) for r in rows) >= CHUNK_ROWS:
                    yield from flush()
                    k += 1
                    rows, h, ordinal, nodes, sizes, held = [], [], [], [], [], 0
        if rows:
            yield from flush()

    return run


def _shared(batches):
    """Rows sorted by range -> the headers, and for each chunk of a range the shingles that several sets hold, with their number."""
    range_, parts = None, []

    def finish():
        if not parts:
            return
        h = np.concatenate([p[1] for p in parts])
        of = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
        ordinal = np.concatenate([p[2] for p in parts])
        order = np.argsort(h, kind="stable")
        hs = h[order]
        begin = np.flatnonzero(np.concatenate(([True], hs[1:] != hs[:-1])))
        n = np.diff(np.append(begin, len(hs)))
        n = np.repeat(n, n)
        keep = order[n > 1]
        count = np.zeros(len(h), np.uint64)
        count[order] = n
        keep = np.sort(keep)  # by chunk, then by hash
        edges = np.searchsorted(of[keep], np.arange(len(parts) + 1))
        yield _sent([(range_, parts[i][0], 1, sort_pack(h[own], count[own], ordinal[own])) for i in range(len(parts)) if len(own := keep[edges[i] : edges[i + 1]])])

    for batch in batches:
        through = []
        for r, chunk, kind, body in zip(*(batch.column(c).to_pylist() for c in ("range", "chunk", "kind", "body")), strict=True):
            if kind == 0:
                through.append((r, chunk, 0, body))
                continue
            if r != range_:
                yield from finish()
                range_, parts = r, []
            parts.append((chunk, *sort_unpack(body)))
        if through:
            yield _sent(through)
    yield from finish()


KINDS = "kind int, doc_id long, node long, check long, n long, grp long, side int, pos long, own long, body binary"
ROW, POSTING, SET = 0, 1, 2


def _assembled(kind: int, **columns):
    import pyarrow as pa

    names = [f.split() for f in KINDS.split(", ")]
    n = len(next(iter(columns.values())))
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    arrays = [pa.array([kind] * n, pa.int32()) if c == "kind" else columns[c] if c in columns else pa.nulls(n, types[t]) for c, t in names]
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, types[t]) for a, (_, t) in zip(arrays, names, strict=True)], names=[c for c, _ in names])


def prefix(n: np.ndarray) -> np.ndarray:
    return n - -(-n * PERCENT // 100) + 1


def bitmaps(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each set a bitmap of BITS bits: how often, modulo 2, its hashes fall on each."""
    rows = len(at) - 1
    cell = np.repeat(np.arange(rows), np.diff(at)) * BITS + (mix(h) & np.uint64(BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(cell, minlength=rows * BITS) & 1).astype(np.uint8)).reshape(rows, BITS // 8)


def _assemble(batches):
    """Rows sorted by chunk -> documents (ROW), postings of prefixes (POSTING) and the shared shingles of nodes that have postings (SET)."""
    import pyarrow as pa

    chunk, header, parts = None, None, []

    def binary(rows: list[bytes]):
        return pa.array(rows, pa.binary())

    def finish():
        if header is None:
            return
        ids, valid, name, check, size, nodes, sizes = header
        as_long = lambda x: x.view(np.int64)
        for i in range(0, len(ids), 50_000):
            s = slice(i, i + 50_000)
            empty = size[s] == 0
            yield _assembled(ROW, doc_id=pa.array(as_long(ids[s]), mask=valid[s] == 0), node=pa.array(as_long(name[s]), mask=empty), check=pa.array(as_long(check[s]), mask=empty), n=as_long(size[s]))
        if not parts:
            return
        h, count, ordinal = (np.concatenate(c) for c in zip(*parts, strict=True))
        ordinal = ordinal.astype(np.int64)
        order = np.lexsort((h, count, ordinal))
        h, count, ordinal = h[order], count[order].astype(np.int64), ordinal[order]
        n = sizes.astype(np.int64)
        s = np.bincount(ordinal, minlength=len(n))
        at = np.concatenate(([0], np.cumsum(s)))
        alone = n - s
        posted = prefix(n) - alone
        for i in range(0, len(n), 2000):
            some = i + np.flatnonzero(posted[i : i + 2000] > 0)
            if not len(some):
                continue
            index = np.repeat(at[some], s[some]) + np.arange(s[some].sum()) - np.repeat(np.cumsum(s[some]) - s[some], s[some])
            bits = bitmaps(h[index], np.concatenate(([0], np.cumsum(s[some]))))
            node = as_long(nodes[some])
            yield _assembled(SET, node=node, n=n[some], body=binary([h[at[j] : at[j + 1]][::-1].astype("<u8").tobytes() for j in some]))
            k = posted[some]
            where = np.repeat(at[some], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            of = np.repeat(np.arange(len(some)), k)
            tiles = -(-count[where] // TILE)
            copies = np.repeat(np.arange(len(where)), tiles)
            other = np.arange(len(copies)) - np.repeat(np.cumsum(tiles) - tiles, tiles)
            key, many = h[where][copies], tiles[copies]
            block = (mix(nodes[some][of[copies]]) % many.astype(np.uint64)).astype(np.int64)
            lo, hi = np.minimum(block, other), np.maximum(block, other)
            grp = np.where(many > 1, mix(key + mix((lo << 32 | hi).astype(np.uint64))), key)
            side = np.where(lo == hi, 0, np.where(block == lo, 1, 2))
            pos = alone[some][of] + np.arange(len(of)) - np.repeat(np.cumsum(k) - k, k)
            for a in range(0, len(copies), 50_000):
                c = copies[a : a + 50_000]
                o = of[c]
                yield _assembled(POSTING, node=node[o], n=n[some][o], grp=as_long(grp[a : a + 50_000]), side=side[a : a + 50_000].astype(np.int32), pos=pos[c], own=alone[some][o], body=binary([b.tobytes() for b in bits[o]]))

    for batch in batches:
        for c, kind, body in zip(*(batch.column(x).to_pylist() for x in ("chunk", "kind", "body")), strict=True):
            if c != chunk:
                yield from finish()
                chunk, header, parts = c, None, []
            if kind == 0:
                header = unpack(body)
            else:
                parts.append(sort_unpack(body))
    yield from finish()


class _Trees:
    """Union-find over names: which names are in one tree, and the tree's root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        if x < y:
            x, y = y, x
        self.parent[x] = y
        return True


def _need(n, m):
    """The least intersection of two sets of these sizes that link."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def candidates(i: int, others: np.ndarray, n: np.ndarray, pos: np.ndarray, own: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Those of others that pass all bounds with posting i of one group."""
    m = n[others]
    need = _need(n[i], m)
    ok = (100 * np.minimum(n[i], m) >= PERCENT * np.maximum(n[i], m)) & (n[i] - pos[i] >= need) & (m - pos[others] >= need)
    others, need, m = others[ok], need[ok], m[ok]
    differ = np.bitwise_count(bits[others] ^ bits[i]).sum(1, dtype=np.int64) + own[i] + own[others]
    return others[differ <= n[i] + m - 2 * need]


def _pairs(every: bool):
    """Postings sorted by group (with the component comp of each node) -> candidates between components: all of them, or a spanning forest of this task's.

    tree names the tree of the forest.
    """

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        pid, trees, met, epoch = TaskContext.get().partitionId(), _Trees(), set(), 0
        out: list[tuple[int, int, int, int]] = []
        cols, grp = [[] for _ in range(7)], None

        def group() -> None:
            node, n, side, pos, own, comp = (np.array(c, np.int64) for c in cols[:6])
            bits = np.frombuffer(b"".join(cols[6]), "<u8").reshape(len(node), -1)
            fresh = np.unique(node, return_index=True)[1]  # a node met in several chunks counts once
            fresh = fresh[np.argsort(n[fresh], kind="stable")]
            node, n, side, pos, own, comp, bits = (x[fresh] for x in (node, n, side, pos, own, comp, bits))
            if len(node) < 2:
                return
            root = comp if every else np.array([trees.root(c) for c in comp.tolist()])
            if (root == root[0]).all():
                return
            end = np.searchsorted(n, n * 100 // PERCENT, "right")
            for i in range(len(node)):
                later = np.arange(i + 1, end[i])
                later = later[(root[later] != root[i]) & ((side[later] != side[i]) | (side[i] == 0))]
                if not len(later):
                    continue
                for j in candidates(i, later, n, pos, own, bits).tolist():
                    a, b = sorted((int(node[i]), int(node[j])))
                    if every:
                        if (a, b) not in met:
                            met.add((a, b))
                            out.append((a, b, 0))
                    elif trees.join(int(root[i]), int(root[j])):
                        low = trees.root(int(root[i]))
                        out.append((a, b, low))
                        root[(root == root[i]) | (root == root[j])] = low

        def handed_on():
            # A tree is named by its root at the end.
            rows = [(a, b, hash((pid, epoch, t if every else trees.root(t)))) for a, b, t in out]
            cols_ = zip(*rows, strict=True) if rows else ((), (), ())
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols_], names=["a", "b", "tree"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("grp", "node", "n", "side", "pos", "own", "comp", "body")), strict=True):
                if row[0] != grp:
                    if grp is not None:
                        group()
                    grp = row[0]
                    for c in cols:
                        c.clear()
                    if len(trees.parent) > REMEMBERED or len(met) > REMEMBERED:
                        yield handed_on()
                        trees, epoch = _Trees(), epoch + 1
                        met.clear()
                for c, v in zip(cols, row[1:], strict=True):
                    c.append(v)
        if grp is not None:
            group()
        yield handed_on()

    return run


def trie_join(probe: np.ndarray, probe_size: int, sets: list[np.ndarray], sizes: list[int], step: int = 64) -> list[tuple[int, int]]:
    """(index, intersection) of the sets that link with probe; all are duplicate-free and in one global order.

    Each set is what other sets share of it; sizes are those of the whole sets.
    In the order of their bytes, sets that share a path of the trie follow one
    another: `path` is the current path from the root, `overlap[d]` how many of
    its first d shingles the probe has.
    """
    wanted = np.sort(probe)
    out: list[tuple[int, int]] = []
    path, overlap = np.zeros(0, probe.dtype), np.zeros(1, np.int64)
    for i in sorted(range(len(sets)), key=lambda i: sets[i].tobytes()):
        own = sets[i]
        need = int(_need(sizes[i], probe_size))
        m = min(len(path), len(own))
        differ = np.flatnonzero(path[:m] != own[:m])
        depth = int(differ[0]) if len(differ) else m
        known = [overlap[: depth + 1]]
        have = int(overlap[depth])
        # Each shingle of the probe is met once at most, so both remainders bound the overlap.
        while depth < len(own) and have + min(len(own) - depth, len(probe) - have) >= need:
            part = own[depth : depth + step]
            at = np.minimum(np.searchsorted(wanted, part), len(wanted) - 1)
            known.append(have + np.cumsum(wanted[at] == part))
            have = int(known[-1][-1])
            depth += len(part)
        path, overlap = own[:depth], np.concatenate(known)
        if depth == len(own) and have >= need:
            out.append((i, have))
    return out


def _traverse(batches):
    """Rows sorted by (a, chunk, b): the probe's set, then the members' sets.  Yields all pairs, and whether they link."""
    import pyarrow as pa

    key, probe, probe_n, nodes, sets, sizes, found = None, None, 0, [], [], [], []

    def finish() -> None:
        if probe is not None and sets:
            linked = {i for i, _ in trie_join(probe, probe_n, sets, sizes)}
            found.extend((key[0], v, i in linked) for i, v in enumerate(nodes))
        nodes.clear()
        sets.clear()
        sizes.clear()

    for batch in batches:
        for a, chunk, b, n, body in zip(*(batch.column(c).to_pylist() for c in ("a", "chunk", "b", "n", "body")), strict=True):
            if (a, chunk) != key:
                finish()
                key, probe = (a, chunk), None
            if b is None:
                probe, probe_n = np.frombuffer(body, "<u8"), n
            else:
                nodes.append(b)
                sizes.append(n)
                sets.append(np.frombuffer(body, "<u8"))
    finish()
    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.bool_())], names=["u", "v", "linked"])


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) -> (u, v, linked); sets: node, n, body."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    bodies = sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.first(F.struct("n", "body")).alias("s"))
    bodies = materialise(bodies.select("node", "s.n", "s.body"), "ngram-bodies")
    degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("degree"))
    members = pairs.join(degree, "a").select("a", F.pmod(F.xxhash64("b"), F.ceil(F.col("degree") / TRIE_SETS)).alias("chunk"), "b")
    probes = members.select("a", "chunk").distinct().join(bodies, F.col("a") == F.col("node")).select("a", "chunk", F.lit(None).cast("long").alias("b"), "n", "body")
    members = members.join(bodies, F.col("b") == F.col("node")).select("a", "chunk", "b", "n", "body")
    rows = probes.union(members).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    out = materialise(rows.mapInArrow(_traverse, "u long, v long, linked boolean"), "ngram-links")
    discard(bodies)
    return out


def assembled(documents: DataFrame) -> DataFrame:
    """Steps 1 and 2: the rows of KINDS."""
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    posted = texts.mapInArrow(_post(RANGES * partitions), SENT)
    shared = posted.repartition(partitions, "range").sortWithinPartitions("range").mapInArrow(_shared, SENT)
    return materialise(shared.repartition(partitions, "chunk").sortWithinPartitions("chunk").mapInArrow(_assemble, KINDS), "ngram-sets", "kind")


def linked_nodes(made: DataFrame) -> DataFrame:
    """(node, comp) of each node that has a link; made: assembled()."""
    sets = made.where(F.col("kind") == SET).select("node", "n", "body")
    postings = made.where(F.col("kind") == POSTING).select("grp", "node", "n", "side", "pos", "own", "body")
    by_group = lambda df, every: df.repartition("grp").sortWithinPartitions("grp").mapInArrow(_pairs(every), "a long, b long, tree long")
    forest = materialise(by_group(postings.withColumn("comp", F.col("node")), False), "ngram-forest")
    done = verify(forest.select("a", "b").distinct(), sets)
    comps = materialise(components(done.where("linked").select("u", "v")), "ngram-components")
    # Nodes of a tree with a pair that did not link: only their candidates may be in different components.
    broken = forest.join(done.where("not linked"), (F.col("a") == F.col("u")) & (F.col("b") == F.col("v")), "left_semi").select("tree").distinct()
    open_ = forest.join(broken, "tree", "left_semi").select(F.explode(F.array("a", "b")).alias("node")).distinct()
    again = postings.join(open_, "node", "left_semi").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    across = by_group(again, True).select("a", "b").distinct()
    across = materialise(across.join(done, (F.col("a") == F.col("u")) & (F.col("b") == F.col("v")), "left_anti"), "ngram-across")
    late = verify(across, sets).where("linked").select("u", "v")
    # Links between components: of their names.
    named = lambda c: late.select(F.col(c).alias("node")).distinct().join(comps, "node", "left").select(F.col("node").alias(c), F.coalesce("comp", "node").alias(f"{c}c"))
    between = late.join(named("u"), "u").join(named("v"), "v").select(F.col("uc").alias("u"), F.col("vc").alias("v"))
    joined = materialise(components(between), "ngram-joined")
    met = comps.union(late.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(comps, "node", "left_anti").select("node", F.col("node").alias("comp")))
    return met.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("low")), "comp", "left").select("node", F.coalesce("low", "comp").alias("comp"))


def placed(documents: DataFrame) -> DataFrame:
    """(doc_id, node, n_shingles, comp) of each row of documents (doc_id, text); node and comp are null for an empty set."""
    made = assembled(documents)
    rows = made.where(F.col("kind") == ROW).select("doc_id", "node", "check", F.col("n").alias("n_shingles"))
    twice = rows.where("node is not null").groupBy("node").agg(F.min("check").alias("x"), F.max("check").alias("y")).where("x <> y")
    if not twice.isEmpty():
        raise RuntimeError("two different sets have one name")
    comps = linked_nodes(made)
    return materialise(rows.join(comps, "node", "left").select("doc_id", "node", "n_shingles", F.coalesce("comp", "node").alias("comp")), "ngram-placed")


def link_components(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of documents (doc_id, text)."""
    rows = placed(documents).select("doc_id", "n_shingles", "comp")
    low = rows.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("low"))
    return rows.join(low, "comp", "left").select("doc_id", "n_shingles", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("component_id"))


def _name(batches):
    import pyarrow as pa

    for batch in pieces(batches, "text"):
        names = [np.where(size > 0, name, 0) for _, name, _, size, _, _ in _sets(batch.column("text"))]
        empty = [size == 0 for _, _, _, size, _, _ in _sets(batch.column("text"))]
        node = pa.array(np.concatenate(names), mask=np.concatenate(empty)) if names else pa.nulls(0, pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, node], names=[*batch.schema.names, "_node"])


def one_of_each_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one row stays, that of the smallest id (nulls last), then of the smallest hash of its columns.

    Texts without words are components of their own, by id; those of a null id
    stay.  Columns other than DOCUMENT_COLUMNS go.
    """
    docs = docs.select(*DOCUMENT_COLUMNS)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    comps = placed(docs).where("node is not null").select(F.col("node").alias("_node"), F.col("comp").alias("_comp")).distinct()
    rows = docs.mapInArrow(_name, f"{schema}, _node long").join(comps, "_node", "left").drop("_node")
    keyed = materialise(rows.withColumns({"_id": F.when(F.col("_comp").isNull(), F.col("doc_id")), "_hash": F.xxhash64(*DOCUMENT_COLUMNS)}), "ngram-keyed")
    grouped = keyed.where("_comp is not null or _id is not null")
    best = grouped.groupBy("_comp", "_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_hash")).alias("best"))
    best = best.select(F.col("_comp").alias("c"), F.col("_id").alias("i"), F.col("best.doc_id").alias("d"), F.col("best._hash").alias("h"))
    same = F.col("_comp").eqNullSafe(F.col("c")) & F.col("_id").eqNullSafe(F.col("i")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("_hash") == F.col("h"))
    # What is left of a component is one row, or equal rows.
    kept = grouped.join(best, same, "left_semi").dropDuplicates(["_comp", "_id"])
    return kept.unionByName(keyed.where("_comp is null and _id is null")).select(*DOCUMENT_COLUMNS)


def query(spark, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = r"""
with recursive d as (
  select row_number() over () as r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) as w from {documents}),
s as (select distinct r, doc_id, array_to_string(w[i:i + 4], ' ') as g from d, unnest(range(1, case when len(w) = 0 then 0 else greatest(len(w) - 4, 1) end + 1)) as t(i)),
n as (select r, doc_id, count(*) as n from s group by r, doc_id),
p as (select a.r as x, b.r as y, count(*) as k from s a join s b on a.g = b.g and a.r < b.r group by a.r, b.r),
e as (select nx.doc_id as u, ny.doc_id as v from p join n nx on x = nx.r join n ny on y = ny.r where 100 * k >= 75 * (nx.n + ny.n - k)),
both_ways as (select u, v from e union select v, u from e),
reach as (select u, v from both_ways union select reach.u, b.v from reach join both_ways b on reach.v = b.u),
low as (select u, min(v) as low from reach group by u)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) as component_id
from d left join n using (r) left join low on low.u = d.doc_id
"""
