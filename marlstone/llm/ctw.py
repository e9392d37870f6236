"""LM scoring by context-tree weighting over binary-decomposed bytes.

Model: each byte (A-Z lower-cased; a zero byte ends a text) is eight binary
decisions.  For every decision a context tree over up to DEPTH preceding bytes
mixes the Krichevsky-Trofimov estimates of all depths with CTW's weights.  The
block probabilities depend on counts alone, so counting is distributed and the
mixture is exact for the tree.  The tree holds every context met LEAST times or
more; that number does not depend on the size of the corpus.  Each context has
one further child for all other continuations.

A path is a context's bytes, the newest first, in one number; with the byte that
follows it is a key.  One pass counts the keys of all texts and sends them,
packed, to the task of their range, a hash of the TOP newest bytes, so that a
task has whole subtrees (of 256 ** (DEPTH - TOP) contexts at most).  It sums up
the weights of its subtrees for their parents, the driver weighs the contexts
shorter than TOP bytes, and a second pass over the packed keys gives each key
that occurs in any text its probability.  Keys that make up at least one
SHARE-th of all places (so SHARE of them at most) are broadcast, which saves
work and changes nothing; the others are looked up by range, and what returns
is one sum for each text and range.

Base: a unigram model with add-one smoothing over words cut at ASCII white space, and one end for each text.
Words are identified by 64-bit hashes.  Counts of words that make up at least
one FREQUENT-th of the training tokens (so FREQUENT of them at most) are
broadcast; the others are looked up by range like keys.

Edge cases: null text counts as empty, which is one end; with no training text
every byte has probability 1/2 ** 8 and every token 1; a null id is scored and, its crc32 being
that of the empty text, learned from; repeated rows each keep their row;
input columns named like an output are replaced; a very long text is scored whole in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays
from .common import hold_out, materialise, table
from .packing import pack, sort_pack, sort_unpack, unpack
from .textvec import SPACE_BYTES, blocks, lower_table, mix, pieces, spans, word_hashes

DEPTH = 5
LEAST = 2
TOP = 3
SHARE = 1 << 21
FREQUENT = 1 << 18
HALF = float(np.log(0.5))
#: Ranges of keys for each shuffle partition; entries and rows that a task gathers before it sends them on, about.
RANGES = 4
GATHERED, GATHERED_ROWS = 1 << 21, 50_000
#: Log probabilities are summed as whole numbers of this fraction, so that no order of summing shows.
UNIT = 1 << 30


class Tree:
    """Contexts: node 0 is none, 1 the empty context; a child extends its parent's context by one older byte."""

    def __init__(self):
        self.parent, self.byte = np.zeros(2, np.int64), np.zeros(2, np.int64)
        self.first = [1, 2]  # of the nodes of each depth

    def grow(self, parents: np.ndarray, older: np.ndarray) -> None:
        self.parent, self.byte = np.append(self.parent, parents), np.append(self.byte, older)
        self.first.append(len(self.parent))

    def children(self) -> np.ndarray:
        """children[node << 8 | byte], 0 if the tree has none."""
        out = np.zeros(len(self.parent) << 8, np.int32)
        out[self.parent[2:] << 8 | self.byte[2:]] = np.arange(2, len(self.parent))
        return out


def padded(data: np.ndarray, offs: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts, lower-cased, each after depth zero bytes and before one; and where each text's bytes begin."""
    n = len(offs) - 1
    begin = offs[:-1] + depth + (depth + 1) * np.arange(n)
    out = np.zeros(len(data) + (depth + 1) * n, np.uint8)
    out[np.arange(len(data)) + np.repeat(begin - offs[:-1], np.diff(offs))] = lower_table()[data]
    return out, begin


def walk(children: np.ndarray, text: np.ndarray, depth: int, longest: bool) -> np.ndarray:
    """For each place from depth on the node of its context of that depth, 0 if none; or of its longest context up to that depth."""
    at = np.ones(len(text) - depth, np.int32)
    best = at.copy()
    for d in range(1, depth + 1):
        at = children[(at << 8) | text[depth - d : len(text) - d]]
        if longest:
            np.copyto(best, at, where=at > 0)
    return best if longest else at


def _count(tree, depth: int):
    """This task's counts of bytes after each context of the depth."""

    def run(batches):
        from pyspark import TaskContext

        t = tree.value
        children, base = t.children(), t.first[depth]
        counts = np.zeros((t.first[depth + 1] - base) << 8, np.uint64)
        for batch in batches:
            for _, _, data, offs in blocks(batch.column("text"), 1 << 22):
                text, begin = padded(data, offs, depth)
                node = walk(children, text, depth, False).astype(np.int64)
                # The zeros before a text are not predicted.
                skip = (begin[:, None] - depth - np.arange(1, depth + 1)).ravel()
                node[skip[skip >= 0]] = 0
                seen = node > 0
                counts += np.bincount((node[seen] - base) << 8 | text[depth:][seen], minlength=len(counts)).astype(np.uint64)
        yield arrays.partial(counts, TaskContext.get().partitionId())

    return run


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0, by Stirling's series at x + 8."""
    product = x.copy()
    for k in range(1, 8):
        product *= x + k
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - np.log(product)


def binary(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones met at each of the 256 decisions (heap order, the first unused), for each row of byte counts."""
    heap = np.zeros((len(counts), 512))
    heap[:, 256:] = counts
    for k in (128, 64, 32, 16, 8, 4, 2, 1):
        heap[:, k : 2 * k] = heap[:, 2 * k : 4 * k : 2] + heap[:, 2 * k + 1 : 4 * k : 2]
    return heap[:, 0::2].copy(), heap[:, 1::2].copy()


def kt_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The log of the KT probability of any sequence with these counts."""
    out, met = np.zeros(zeros.shape), zeros + ones > 0
    z, o = zeros[met], ones[met]
    out[met] = log_gamma(z + 0.5) + log_gamma(o + 0.5) - np.log(np.pi) - log_gamma(z + o + 1)
    return out


def summed(rows: np.ndarray, parent: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows of each of n parents."""
    out = np.zeros((n, 256))
    np.add.at(out, parent, rows)
    return out


def weigh(counts: np.ndarray, below: np.ndarray | None, split: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log block and weighted probabilities of nodes, and their counts outside of their children.

    below, split: sums of the children's counts and log weighted probabilities; None at the last depth.
    """
    block = kt_block(*binary(counts))
    if below is None:
        return block, block, counts
    other = counts - below
    return block, np.logaddexp(HALF + block, HALF + split + kt_block(*binary(other))), other


def mix_level(counts: np.ndarray, other: np.ndarray, block: np.ndarray, weighted: np.ndarray, before, left, last: bool):
    """(mixed, left, codes) of nodes: the mixture down to them, the weight that is left, and log10 of each byte's probability after them as the longest context.

    before, left: mixed and left of each node's parent.
    """
    zeros, ones = binary(counts)
    p = (ones + 0.5) / (zeros + ones + 1)
    if last:
        mixed, rest, final = None, None, before + left * p
    else:
        keep = np.exp(HALF + block - weighted)  # the weight of stopping at a node
        mixed, rest = before + left * keep * p, left * (1 - keep)
        zeros, ones = binary(other)
        final = mixed + rest * (ones + 0.5) / (zeros + ones + 1)
    heap = np.zeros((len(final), 512))
    for k in (1, 2, 4, 8, 16, 32, 64, 128):
        heap[:, 2 * k : 4 * k : 2] = heap[:, k : 2 * k] + np.log10(1 - final[:, k : 2 * k])
        heap[:, 2 * k + 1 : 4 * k : 2] = heap[:, k : 2 * k] + np.log10(final[:, k : 2 * k])
    return mixed, rest, heap[:, 256:].astype(np.float32)


def code_table(tree: Tree, counts: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each byte, for each node as the longest context of a place.

    counts: for each depth the byte counts of its nodes.
    """
    depth = len(counts) - 1
    up = [tree.parent[tree.first[d] : tree.first[d + 1]] - tree.first[max(d - 1, 0)] for d in range(depth + 1)]
    levels = climb([c.astype(np.float64) for c in counts], up, 0)
    return np.concatenate([np.zeros((1, 256), np.float32), *descend(levels, up, np.zeros((1, 256)), np.ones((1, 256)), 0)])


def climb(counts: list[np.ndarray], up: list[np.ndarray], first: int, below=None, split=None) -> list[tuple]:
    """(counts, other, block, weighted) of each depth from first on; below and split stand for the children of the last, if it has any."""
    levels: list[tuple] = []
    for d in range(len(counts) - 1, first - 1, -1):
        block, weighted, other = weigh(counts[d], below, split)
        levels.insert(0, (counts[d], other, block, weighted))
        if d > first:
            below, split = summed(counts[d], up[d], len(counts[d - 1])), summed(weighted, up[d], len(counts[d - 1]))
    return levels


def descend(levels: list[tuple], up: list[np.ndarray], mixed: np.ndarray, left: np.ndarray, first: int, ends: bool = True, state: list | None = None) -> list[np.ndarray]:
    """The codes of each depth from first on; mixed and left are those of the parents of the first.  ends: the last depth has no children."""
    out = []
    for d, level in enumerate(levels, first):
        at = up[d] if d else np.zeros(1, np.int64)
        mixed, left, codes = mix_level(*level, mixed[at], left[at], ends and d == first + len(levels) - 1)
        out.append(codes)
    if state is not None:
        state[:] = [mixed, left]
    return out


def train(texts: DataFrame, depth: int = DEPTH, share: int = SHARE) -> tuple[Tree, np.ndarray]:
    """The context tree of all rows of texts (text) in one place, of contexts that make up one share-th of all bytes, and its code table.

    score() does not use it; tests hold the distributed tree against it.
    """
    spark = texts.sparkSession
    tree, counts = Tree(), []
    n_pids = texts.rdd.getNumPartitions()
    for d in range(depth + 1):
        held = spark.sparkContext.broadcast(tree)
        n = tree.first[d + 1] - tree.first[d]
        got = arrays.merged(texts.mapInArrow(_count(held, d), arrays.SCHEMA), n_pids, n << 8, np.uint64, np.add) if n else np.zeros(0, np.uint64)
        counts.append(got.reshape(n, 256))
        if d < depth:
            # The context x + y occurs as often as y follows x; its suffix has been kept before.
            least = max(1, -(-int(counts[0].sum()) // share))
            node, last = np.nonzero(counts[d] >= least)
            node += tree.first[d]
            context = []
            for k in range(d):  # the bytes of x, the oldest last; x's path starts at its newest byte
                context.append(tree.byte[node])
                node = tree.parent[node]
            at, children = np.ones(len(last), np.int64), tree.children()
            older = [last, *context[::-1]]
            for b in older[:-1]:
                at = children[at << 8 | b].astype(np.int64)
            known = at > 0
            tree.grow(at[known], older[-1][known])
    return tree, code_table(tree, counts)


def places(data: np.ndarray, offs: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of each byte of each text and of its end, and for each text the index of its first."""
    text, begin = padded(data, offs, depth)
    keys = text[depth:].astype(np.int64)
    for k in range(1, depth + 1):
        keys |= text[depth - k : len(text) - k].astype(np.int64) << (8 * (depth - k + 1))
    # The zeros before a text are not predicted.
    real = np.ones(len(keys), bool)
    skip = (begin[:, None] - depth - np.arange(1, depth + 1)).ravel()
    real[skip[skip >= 0]] = False
    return keys[real], np.concatenate(([0], np.cumsum(np.diff(offs) + 1)))


class _Counts:
    """Counts of numbers, merged when there are many."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, values: np.ndarray) -> bool:
        """Whether there is enough to send on."""
        self.held.append(np.unique(values, return_counts=True))
        self.size += len(self.held[-1][0])
        if self.size > 2 * GATHERED:
            self.held = [self.merged()]
            self.size = len(self.held[0][0])
        return self.size > GATHERED

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        value, at = np.unique(np.concatenate([h[0] for h in self.held]), return_inverse=True)
        return value, np.bincount(at, np.concatenate([h[1] for h in self.held])).astype(np.int64)


PACKED = "range int, chunk long, kind int, body binary"


def _packed(rows: list[tuple]):
    import pyarrow as pa

    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary())
    cols = zip(*rows, strict=True) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["range", "chunk", "kind", "body"])


def by_range(values: np.ndarray, ranges: int, of: np.ndarray):
    """(range, indices) of sorted values; of: what decides their range."""
    of = (mix(of.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % ranges
    order = np.argsort(of, kind="stable")
    edges = np.searchsorted(of[order], np.arange(ranges + 1))
    for r in np.flatnonzero(np.diff(edges)):
        yield int(r), order[edges[r] : edges[r + 1]]


def _count_keys(depth: int, top: int, ranges: int):
    """For each range this task's keys, how often they occur in the texts that are learned from, and in all."""

    def run(batches):
        counts = _Counts()

        def send():
            both, c = counts.merged()
            key, at = np.unique(both >> 1, return_inverse=True)
            n, m = np.bincount(at, c * (both & 1)).astype(np.uint64), np.bincount(at, c).astype(np.uint64)
            yield _packed([(r, 0, 0, sort_pack(key[i].astype(np.uint64), n[i], m[i])) for r, i in by_range(key, ranges, key >> 8 * (depth - top + 1))])

        for batch in pieces(batches, "text"):
            learn = batch.column("learn").to_numpy(zero_copy_only=False).astype(np.int64)
            for row, n, data, offs in blocks(batch.column("text"), 1 << 22):
                keys, first = places(data, offs, depth)
                if counts.add(keys << 1 | np.repeat(learn[row : row + n], np.diff(first))):
                    yield from send()
                    counts = _Counts()
        if counts.held:
            yield from send()

    return run


def _ranges(batches, kinds: tuple = (0,)):
    """Rows sorted by range -> (range, for each kind the (chunk, unpacked body) of its rows)."""
    range_, parts = None, {k: [] for k in kinds}
    for batch in batches:
        for r, chunk, kind, body in zip(*(batch.column(c).to_pylist() for c in ("range", "chunk", "kind", "body")), strict=True):
            if r != range_:
                if range_ is not None:
                    yield range_, parts
                range_, parts = r, {k: [] for k in kinds}
            parts[kind].append((chunk, sort_unpack(body)))
    if range_ is not None:
        yield range_, parts


def summed_keys(parts: list) -> list[np.ndarray]:
    """The distinct keys of all parts, and the sums of what belongs to them."""
    key, at = np.unique(np.concatenate([p[1][0] for p in parts]), return_inverse=True)
    return [key, *(np.bincount(at, np.concatenate([p[1][k] for p in parts])).astype(np.uint64) for k in range(1, len(parts[0][1])))]


def _parts(keys: np.ndarray, n: np.ndarray, depth: int, top: int):
    """(slice, nodes, counts, up) of sorted keys, some whole subtrees at a time.

    nodes: for each depth from top on the node of each key's context there, -1 if it is not kept.
    """
    edges = np.append(np.flatnonzero(np.diff(keys >> 8 * (depth - top + 1), prepend=-1)), len(keys))
    i = 0
    while i < len(edges) - 1:
        j = max(i + 1, int(np.searchsorted(edges, edges[i] + (1 << 12), "right")) - 1)
        part = slice(edges[i], edges[j])
        i = j
        nodes, counts, up = [], [], []
        for d in range(top, depth + 1):
            at = np.cumsum(np.diff(keys[part] >> 8 * (depth - d + 1), prepend=-1) != 0) - 1
            kept = np.bincount(at, n[part]) >= LEAST
            of = np.where(kept, np.cumsum(kept) - 1, -1)
            node = of[at]
            seen = node >= 0
            size = int(kept.sum())
            counts.append(np.bincount(node[seen] << 8 | (keys[part][seen] & 255), n[part][seen], size << 8).reshape(size, 256))
            start = np.unique(node[seen], return_index=True)[1]
            up.append((nodes[-1] if nodes else np.zeros(len(node), np.int64))[seen][start])
            nodes.append(node)
        yield part, nodes, counts, up


GROWN = "kind int, range int, idx long, v double, body binary"
KEYS, BELOW, SHORT, SPLIT, PLACES = range(5)


def _grow(depth: int, top: int):
    """For each range its keys with their sums (KEYS); and what the driver needs for shorter contexts, by path and byte or decision.

    BELOW and SPLIT: sums of counts and log weighted probabilities over the subtrees of a context; SHORT: its own counts; PLACES: of all texts.
    """

    def numbers(range_: int, kind: int, idx: np.ndarray, v: np.ndarray):
        import pyarrow as pa

        idx, at = np.unique(idx, return_inverse=True)
        v = np.bincount(at, v)
        for i in range(0, len(idx), 100_000):
            k = len(idx[i : i + 100_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * k, pa.int32()), pa.array([range_] * k, pa.int32()), pa.array(idx[i : i + k].astype(np.int64)), pa.array(v[i : i + k].astype(np.float64)), pa.nulls(k, pa.binary())],
                names=["kind", "range", "idx", "v", "body"],
            )

    def run(batches):
        import pyarrow as pa

        for range_, parts in _ranges(batches):
            keys, n, m = summed_keys(parts[0])
            yield pa.RecordBatch.from_arrays([pa.array([KEYS], pa.int32()), pa.array([range_], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()), pa.array([sort_pack(keys, n, m)], pa.binary())], names=["kind", "range", "idx", "v", "body"])
            keys, n = keys.astype(np.int64), n.astype(np.float64)
            yield from numbers(range_, PLACES, np.zeros(1, np.int64), np.array([float(m.sum())]))
            short = 8 * (depth - top + 2)
            if (n > 0).any():
                yield from numbers(range_, SHORT, (keys >> short << 8 | keys & 255)[n > 0], n[n > 0])
            found: dict[int, list] = {BELOW: [], SPLIT: []}
            for part, nodes, counts, up in _parts(keys, n, depth, top):
                if not len(counts[0]):
                    continue
                level = climb([*[None] * top, *counts], [*[None] * top, *up], top)[0]
                start = np.unique(nodes[0][nodes[0] >= 0], return_index=True)[1]
                path = keys[part][nodes[0] >= 0][start] >> short
                for kind, values in ((BELOW, level[0]), (SPLIT, level[3])):
                    node, col = np.nonzero(values)
                    found[kind].append((path[node] << 8 | col, values[node, col]))
            for kind, some in found.items():
                if some:
                    yield from numbers(range_, kind, *(np.concatenate(c) for c in zip(*some, strict=True)))

    return run


def _codes(model, depth: int, top: int):
    """For each range its keys, their occurrences in all texts, and their probabilities after their longest contexts (in negative UNITs)."""

    def run(batches):
        shorter, mixed, left = model.value
        for batch in batches:
            for range_, body in zip(batch.column("range").to_pylist(), batch.column("body").to_pylist(), strict=True):
                keys, n, m = sort_unpack(body)
                keys, n = keys.astype(np.int64), n.astype(np.float64)
                code = np.zeros(len(keys), np.float32)
                for d, (paths, codes) in enumerate(shorter):
                    path = keys >> 8 * (depth - d + 1)
                    at = np.minimum(np.searchsorted(paths, path), len(paths) - 1)
                    hit = paths[at] == path if len(paths) else np.zeros(len(keys), bool)
                    code[hit] = codes[at[hit], keys[hit] & 255]
                for part, nodes, counts, up in _parts(keys, n, depth, top):
                    if len(counts[0]):
                        levels = climb([*[None] * top, *counts], [*[None] * top, *up], top)
                        start = np.unique(nodes[0][nodes[0] >= 0], return_index=True)[1]
                        up[0] = np.searchsorted(shorter[-1][0], keys[part][nodes[0] >= 0][start] >> 8 * (depth - top + 2))
                        for node, codes in zip(nodes, descend(levels, [*[None] * top, *up], mixed, left, top), strict=True):
                            code[part][node >= 0] = codes[node[node >= 0], keys[part][node >= 0] & 255]
                yield _packed([(range_, 0, 0, sort_pack(keys.astype(np.uint64), m, np.rint(-code.astype(np.float64) * UNIT).astype(np.uint64)))])

    return run


def _partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _dealt(packed: DataFrame) -> DataFrame:
    return packed.repartition(_partitions(packed.sparkSession), "range").sortWithinPartitions("range", "kind")


def key_codes(texts: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, int]:
    """The keys of texts (text, learn) with their codes as PACKED rows by range, and the number of their places."""
    spark = texts.sparkSession
    top = min(TOP, depth)
    counted = texts.mapInArrow(_count_keys(depth, top, RANGES * _partitions(spark)), PACKED)
    grown = materialise(_dealt(counted).mapInArrow(_grow(depth, top), GROWN), "ctw-keys", "kind")
    # Contexts shorter than top bytes: 256 ** (top - 1) at most, whatever the corpus.
    known = grown.where(F.col("kind") != KEYS).groupBy("kind", "idx").agg(F.sum("v").alias("v")).toArrow()
    kind, idx, v = (known[c].to_numpy() for c in ("kind", "idx", "v"))
    path, byte, n = idx[kind == SHORT] >> 8, idx[kind == SHORT] & 255, v[kind == SHORT]
    paths, counts, up = [], [], []
    for d in range(top):
        at = path >> 8 * (top - 1 - d)
        names, of = np.unique(at, return_inverse=True)
        kept = np.bincount(of, n, len(names)) >= LEAST if d else np.ones(len(names), bool)
        if d == 0 and not len(names):
            names, kept = np.zeros(1, np.int64), np.ones(1, bool)
        names = names[kept]
        node = np.minimum(np.searchsorted(names, at), max(len(names) - 1, 0))
        seen = names[node] == at if len(names) else np.zeros(len(at), bool)
        paths.append(names)
        counts.append(np.bincount(node[seen] << 8 | byte[seen], n[seen], len(names) << 8).reshape(len(names), 256))
        up.append(np.searchsorted(paths[d - 1], names >> 8) if d else np.zeros(1, np.int64))
    n_last = len(paths[-1])
    sums = np.zeros((2, n_last << 8))
    for k, which in enumerate((BELOW, SPLIT)):
        own = kind == which
        # A context of which a child is kept is kept itself.
        sums[k][np.searchsorted(paths[-1], idx[own] >> 8) << 8 | idx[own] & 255] = v[own]
    below, split = sums.reshape(2, n_last, 256)
    levels, state = climb(counts, up, 0, below, split), []
    codes = descend(levels, up, np.zeros((1, 256)), np.ones((1, 256)), 0, False, state)
    model = spark.sparkContext.broadcast((list(zip(paths, codes, strict=True)), *state))
    coded = grown.where(F.col("kind") == KEYS).select("range", "body").mapInArrow(_codes(model, depth, top), PACKED)
    return materialise(coded, "ctw-codes"), int(v[kind == PLACES].sum())


def _tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = lower_table()[data]
    starts, ends, first = spans(data, offs, SPACE_BYTES)
    return word_hashes(data, starts, ends), first


def _count_words(ranges: int):
    """For each range the words (as hashes) of this task, and how often they occur."""

    def run(batches):
        counts = _Counts()

        def send():
            word, n = counts.merged()
            yield _packed([(r, 0, 0, sort_pack(word[i], n[i].astype(np.uint64))) for r, i in by_range(word, ranges, word)])

        for batch in pieces(batches, "text"):
            for _, _, data, offs in blocks(batch.column("text")):
                if counts.add(_tokens(data, offs)[0]):
                    yield from send()
                    counts = _Counts()
        if counts.held:
            yield from send()

    return run


def _sum_words(batches):
    for range_, parts in _ranges(batches):
        word, n = summed_keys(parts[0])
        yield _packed([(range_, int(n.sum()), len(word), sort_pack(word, n))])


def word_counts(texts: DataFrame) -> tuple[DataFrame, int, int]:
    """Each word of texts (as a hash) and how often it occurs, as PACKED rows by range; all occurrences, and the number of words."""
    counted = texts.mapInArrow(_count_words(RANGES * _partitions(texts.sparkSession)), PACKED)
    words = materialise(_dealt(counted).mapInArrow(_sum_words, PACKED), "ctw-words")
    seen, distinct = words.agg(F.coalesce(F.sum("chunk"), F.lit(0)), F.coalesce(F.sum("kind"), F.lit(0))).first()
    return words.withColumns({"chunk": F.lit(0).cast("long"), "kind": F.lit(0)}), seen, distinct


def often(packed: DataFrame, least: float) -> list[np.ndarray]:
    """Of PACKED rows (key, occurrences, ...) those that occur at least so often, in the order of their keys."""

    def run(batches):
        for batch in batches:
            for body in batch.column("body").to_pylist():
                key, n, *rest = sort_unpack(body)
                keep = n >= least
                if keep.any():
                    yield _packed([(0, 0, 0, sort_pack(key[keep], n[keep], *(x[keep] for x in rest)))])

    found = [sort_unpack(r.body) for r in packed.mapInArrow(run, PACKED).select("body").collect()]
    if not found:
        return [np.zeros(0, np.uint64)] * 3
    cols = [np.concatenate(c) for c in zip(*found, strict=True)]
    order = np.argsort(cols[0])
    return [c[order] for c in cols]


def _lookup(table_: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value its place in the sorted table, and whether it is there."""
    at = np.minimum(np.searchsorted(table_, values), max(len(table_) - 1, 0))
    return at, table_[at] == values if len(table_) else np.zeros(len(values), bool)


def _score(cache, frequent, total: float, depth: int, top: int, ranges: int, kept: list[str]):
    """Rows (kind 0) with what the frequent keys and words give; and by range the other keys (kind 1) and words (kind 2) of the texts."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        cached, codes = cache.value
        words, counts = frequent.value
        gain = np.append(np.log10((counts + 1) / total), 0.0)
        codes = np.append(codes, 0)
        row = TaskContext.get().partitionId() << 40
        chunk, posts, size = row, {1: [], 2: []}, 0
        schema = None

        def send():
            rows = []
            for kind, found in posts.items():
                value, of = (np.concatenate(c) for c in zip(*found, strict=True)) if found else ((), ())
                if not len(value):
                    continue
                order = np.lexsort((of, value))
                value, of = value[order], of[order]
                fresh = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (of[1:] != of[:-1]))))
                n = np.diff(np.append(fresh, len(value)))
                value, of = value[fresh], of[fresh]
                rows += [(r, chunk, kind, sort_pack(value[i], of[i].astype(np.uint64), n[i].astype(np.uint64))) for r, i in by_range(value, ranges, value >> np.uint64(8 * (depth - top + 1)) if kind == 1 else value)]
            packed = _packed(rows)
            by = dict(zip(packed.schema.names, packed.columns, strict=True)) | {"kind": packed.column("kind")}
            return pa.RecordBatch.from_arrays([by[f.name] if f.name in by else pa.nulls(packed.num_rows, f.type) for f in schema], schema=schema)

        for batch in pieces(batches, "_text"):
            scores, base, known, tokens, sizes = [], [], [], [], []
            for begin, n, data, offs in blocks(batch.column("_text"), 1 << 22):
                sizes.append(np.diff(offs))
                keys, first = places(data, offs, depth)
                of = row + begin - chunk + np.repeat(np.arange(n), np.diff(first))
                keys = keys.astype(np.uint64)
                at, hit = _lookup(cached, keys)
                sums = np.concatenate(([0], np.cumsum(np.where(hit, codes[at], 0))))
                scores.append(sums[first[1:]] - sums[first[:-1]])
                posts[1].append((keys[~hit], of[~hit]))
                hashes, first = _tokens(data, offs)
                of = row + begin - chunk + np.repeat(np.arange(n), np.diff(first))
                at, hit = _lookup(words, hashes)
                sums = np.concatenate(([0.0], np.cumsum(np.where(hit, gain[at], 0.0))))
                hits = np.concatenate(([0], np.cumsum(hit)))
                base.append(sums[first[1:]] - sums[first[:-1]])
                known.append(hits[first[1:]] - hits[first[:-1]])
                tokens.append(np.diff(first))
                posts[2].append((hashes[~hit], of[~hit]))
                size += len(posts[1][-1][0]) + len(posts[2][-1][0])
            join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0), kind)
            k = batch.num_rows
            new = {
                "kind": pa.array(np.zeros(k, np.int32)), "range": pa.nulls(k, pa.int32()), "chunk": pa.nulls(k, pa.int64()), "body": pa.nulls(k, pa.binary()), "_row": pa.array(row + np.arange(k), pa.int64()), "_held": batch.column("_held"), "_bytes": join(sizes, pa.int64()),
                "_tokens": join(tokens, pa.int64()), "_known": join(known, pa.int64()), "_base": join(base, pa.float64()), "_score": join(scores, pa.int64()),
            }
            row += k
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new.values()], names=[*(f"c{i}" for i in range(len(kept))), *new])
            schema = out.schema
            yield out
            if size > GATHERED or row - chunk > GATHERED_ROWS:
                yield send()
                chunk, posts, size = row, {1: [], 2: []}, 0
        if schema is not None:
            yield send()

    return run


def _met(total: float):
    """PACKED rows of codes (kind 0), words (kind 3) and of what texts ask (kinds 1 and 2) -> (row, score, base, known)."""

    def run(batches):
        import pyarrow as pa

        none = float(np.log10(1 / total))
        for _, parts in _ranges(batches, (0, 1, 2, 3)):
            for asked, told in ((1, 0), (2, 3)):
                if not parts[asked]:
                    continue
                table_ = [np.concatenate(c) for c in zip(*(p[1] for p in parts[told]), strict=True)] if parts[told] else [np.zeros(0, np.uint64)] * 3
                order = np.argsort(table_[0])
                table_ = [c[order] for c in table_]
                for chunk, (value, of, n) in parts[asked]:
                    at, hit = _lookup(table_[0], value)
                    rows, back = np.unique(of, return_inverse=True)
                    rows = chunk + rows.astype(np.int64)
                    if asked == 1:
                        score = np.zeros(len(rows), np.int64)
                        np.add.at(score, back, np.where(hit, table_[2][at] if len(table_[0]) else 0, 0).astype(np.int64) * n.astype(np.int64))
                        base, known = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
                    else:
                        gain = np.where(hit, np.log10((table_[1][at].astype(np.float64) + 1) / total), none) if len(table_[0]) else np.full(len(value), none)
                        base = np.bincount(back, gain * n, len(rows))
                        known = np.bincount(back, hit * n, len(rows)).astype(np.int64)
                        score = np.zeros(len(rows), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(score), pa.array(base), pa.array(known)], names=["_row", "score", "base", "known"])

    return run


def score(documents: DataFrame, depth: int = DEPTH, share: int = SHARE, without: tuple[str, ...] = ()) -> DataFrame:
    """documents, but for the columns named in without, with held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte."""
    spark = documents.sparkSession
    made = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
    keep = [c for c in documents.columns if c not in (*made, *without)]
    learn = documents.where(~hold_out("doc_id", 7, 2)).select("text")
    codes, n_places = key_codes(documents.select("text", (~hold_out("doc_id", 7, 2)).alias("learn")), depth)
    words, seen, distinct = word_counts(learn)
    ends = learn.count()
    n, v = seen + ends, distinct + (ends > 0)
    total = float(n + v + 1)
    word, count = often(words, n / FREQUENT)[:2]  # FREQUENT at most
    frequent = spark.sparkContext.broadcast((word, count.astype(np.float64)))
    key, _, code = often(codes, n_places / share)  # share at most
    cache = spark.sparkContext.broadcast((key, code.astype(np.int64)))
    rows = documents.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], hold_out("doc_id", 7, 2).alias("_held"), F.col("text").alias("_text"))
    fields = "".join(f"c{i} {documents.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    made_by_row = "kind int, range int, chunk long, body binary, _row long, _held boolean, _bytes long, _tokens long, _known long, _base double, _score long"
    score_ = _score(cache, frequent, total, depth, min(TOP, depth), RANGES * _partitions(spark), [f"c{i}" for i in range(len(keep))])
    scored = materialise(rows.mapInArrow(score_, fields + made_by_row), "ctw-scored", "kind")
    asked = scored.where("kind > 0").select("range", "chunk", "kind", "body")
    told = codes.unionByName(words.withColumn("kind", F.lit(3)))
    met = _dealt(told.unionByName(asked)).mapInArrow(_met(total), "_row long, score long, base double, known long")
    met = met.groupBy("_row").agg(*[F.sum(c).alias(c) for c in ("score", "base", "known")])
    end = float(np.log10((ends + 1) / total))
    bits = -(F.col("_score") + F.coalesce("score", F.lit(0))) / F.lit(float(UNIT))
    return scored.where("kind = 0").join(met, "_row", "left").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_held").alias("held_out"),
        (F.col("_tokens") + 1).alias("n_tokens"),
        (F.col("_known") + F.coalesce("known", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("base", F.lit(0.0)) + end).alias("base_score"),
        bits.alias("score"),
        (-bits * float(np.log2(10)) / (F.col("_bytes") + 1)).alias("bits_per_byte"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"), without=("text",))
