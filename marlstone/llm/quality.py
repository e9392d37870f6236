"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives a vector of numeric features in one vectorised pass.  Features
are cut into quantile bins; shallow trees on one feature at a time (on a pair
of features for interactions) are boosted in cyclic order and summed into
lookup tables, so a score is a sum of table entries, added up by numpy for a
batch of rows at once.

The model is fitted on the driver to at most SAMPLE_ROWS labelled feature rows
(chosen by a hash of the id, so reruns agree; of rows that share an id and a
label the smallest feature row); all rows are scored, in one pass that writes nothing.

Edge cases: null and empty text give the feature vector of an empty text and
are scored like any other; rows with a null label or id are not learned from;
an id of both labels is learned from twice; with no labelled row, or with one
class only, the score is the smoothed share of label 1; repeated rows and ids
each keep their row; rows of equal features have equal scores, and a score at
THRESHOLD is label 1; very long texts are read whole; an empty table gives no
rows; input columns named like an output are replaced, other columns stay.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import DOCUMENT_COLUMNS, hold_out, materialise, sampled, table
from .textvec import SPACE_BYTES, blocks, spans, word_hashes

SAMPLE_ROWS = 20_000
MAX_BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS, PAIR_ROUNDS = 60, 30
RATE = 0.15
LEAVES = 3
THRESHOLD = 0.5

FEATURES = (
    "log_words", "mean_word", "upper", "exclamation", "symbol", "bar", "digit", "stop", "comma", "newline",
    "non_ascii", "distinct_words", "repeat_next", "distinct_lines", "longest_word", "letters",
)

BYTE_GROUPS = {"upper": range(65, 91), "exclamation": b"!", "symbol": b"#$%&*@^~<>", "bar": b"|", "digit": range(48, 58), "stop": b".", "comma": b",", "newline": b"\n", "non_ascii": range(128, 256), "letters": [*range(65, 91), *range(97, 123)]}


def feature_rows(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text."""
    groups = np.zeros((256, len(BYTE_GROUPS)))
    for j, members in enumerate(BYTE_GROUPS.values()):
        groups[list(members), j] = 1
    starts, ends, first = spans(data, offs, SPACE_BYTES)
    hashes = word_hashes(data, starts, ends)
    lengths = ends - starts
    n_bytes, n_words = np.diff(offs), np.diff(first)
    counts = np.empty((len(n_bytes), 256))
    distinct, repeats, lines, longest = (np.zeros(len(n_bytes)) for _ in range(4))
    for r in range(len(n_bytes)):
        piece = data[offs[r] : offs[r + 1]]
        counts[r] = np.bincount(piece, minlength=256)
        a, b = first[r], first[r + 1]
        if b > a:
            h = hashes[a:b]
            distinct[r] = len(np.unique(h)) / (b - a)
            repeats[r] = np.count_nonzero(h[1:] == h[:-1]) / (b - a)
            longest[r] = lengths[a:b].max()
        rows = piece.tobytes().split(b"\n")
        lines[r] = len(set(rows)) / len(rows)
    by = dict(zip(BYTE_GROUPS, (counts @ groups).T, strict=True))
    words, size = np.maximum(n_words, 1), np.maximum(n_bytes, 1)
    made = {
        "log_words": np.log1p(n_words), "mean_word": np.add.reduceat(np.append(lengths, 0), np.minimum(first[:-1], len(lengths))) * (n_words > 0) / words,
        "upper": by["upper"] / np.maximum(by["letters"], 1), "distinct_words": distinct, "repeat_next": repeats, "distinct_lines": lines, "longest_word": np.log1p(longest),
        "letters": by["letters"] / size, "non_ascii": by["non_ascii"] / size, "digit": by["digit"] / size,
    }
    made |= {k: by[k] / words for k in ("exclamation", "symbol", "bar", "stop", "comma", "newline")}
    return np.stack([made[k] for k in FEATURES], axis=1)


def features_of(column) -> np.ndarray:
    parts = [feature_rows(data, offs) for _, _, data, offs in blocks(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def _featurise(batches):
    import pyarrow as pa

    for batch in batches:
        x = features_of(batch.column("text"))
        column = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), column], names=["id", "label", "features"])


def best_tree(grad: np.ndarray, hess: np.ndarray, leaves: int, penalty: float) -> np.ndarray:
    """The step for each bin of a tree of so many leaves, each split taken where it gains most."""
    parts = [(0, len(grad))]
    g, h = (np.concatenate(([0.0], np.cumsum(v))) for v in (grad, hess))
    value = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + penalty)
    while len(parts) < leaves:
        gains = []
        for k, (a, b) in enumerate(parts):
            if b - a > 1:
                cuts = np.arange(a + 1, b)
                gain = (g[cuts] - g[a]) ** 2 / (h[cuts] - h[a] + penalty) + (g[b] - g[cuts]) ** 2 / (h[b] - h[cuts] + penalty) - value(a, b)
                j = int(np.argmax(gain))
                gains.append((float(gain[j]), k, int(cuts[j])))
        if not gains or max(gains)[0] <= 1e-9:
            break
        _, k, cut = max(gains)
        a, b = parts[k]
        parts[k : k + 1] = [(a, cut), (cut, b)]
    step = np.empty(len(grad))
    for a, b in parts:
        step[a:b] = (g[b] - g[a]) / (h[b] - h[a] + penalty)
    return step


def best_grid_tree(grad: np.ndarray, hess: np.ndarray, penalty: float) -> np.ndarray:
    """The step for each cell of a tree of two levels: one feature is cut once, each side then along the other."""
    best, out = 0.0, np.zeros_like(grad)
    for g, h, back in ((grad, hess, lambda m: m), (grad.T, hess.T, lambda m: m.T)):
        for cut in range(1, len(g)):
            step = np.empty_like(g)
            for side in (slice(0, cut), slice(cut, None)):
                step[side] = best_tree(g[side].sum(0), h[side].sum(0), 2, penalty)
            gain = float((g * step - 0.5 * h * step**2).sum())
            if gain > best:
                best, out = gain, back(step)
    return out


class AdditiveModel:
    """Lookup tables of single features and of pairs; score = 1 / (1 + exp(-sum of entries))."""

    def __init__(self, max_bins=MAX_BINS, pair_bins=PAIR_BINS, pairs=PAIRS, rounds=ROUNDS, pair_rounds=PAIR_ROUNDS, rate=RATE, penalty=1.0):
        self.max_bins, self.pair_bins, self.n_pairs, self.rounds, self.pair_rounds, self.rate, self.penalty = max_bins, pair_bins, pairs, rounds, pair_rounds, rate, penalty

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        n, k = x.shape
        self.bias = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
        cut = lambda v, bins: np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0)
        self.edges = [cut(x[:, j], self.max_bins) for j in range(k)]
        self.coarse = [cut(x[:, j], self.pair_bins) for j in range(k)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if not n or y.min() == y.max():
            return self
        bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)]
        z = np.full(n, self.bias)

        def gradients(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-z))
            return np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size)

        for _ in range(self.rounds):
            for j in range(k):
                step = self.rate * best_tree(*gradients(bins[j], len(self.tables[j])), LEAVES, self.penalty)
                self.tables[j] += step
                z += step[bins[j]]
        rough = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.coarse)]
        gains = []
        for a in range(k):
            for b in range(a + 1, k):
                wide = len(self.coarse[b]) + 1
                g, h = gradients(rough[a] * wide + rough[b], (len(self.coarse[a]) + 1) * wide)
                gains.append((float((g**2 / (h + 10 * self.penalty)).sum()), a, b))
        self.pairs = [(a, b) for _, a, b in sorted(gains, reverse=True)[: self.n_pairs]]
        self.pair_tables = [np.zeros((len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)) for a, b in self.pairs]
        for _ in range(self.pair_rounds):
            for (a, b), grid in zip(self.pairs, self.pair_tables, strict=True):
                g, h = (v.reshape(grid.shape) for v in gradients(rough[a] * grid.shape[1] + rough[b], grid.size))
                step = best_grid_tree(g, h, self.penalty)
                grid += self.rate * step
                z += self.rate * step[rough[a], rough[b]]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, j], "right")]
        for (a, b), grid in zip(self.pairs, self.pair_tables, strict=True):
            z += grid[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _scorer(model):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index("_last")
            yield batch.set_column(at, "_last", pa.array(model.value.score(features_of(batch.column("_last")))))

    return run


def fit_quality(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """labels: doc_id, quality.  Learns only from ids that are not held out."""
    learn = labels.where(~hold_out("doc_id", 3, 1) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    learn = learn.select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("label")).distinct()
    chosen = materialise(sampled(learn, "id", sample_rows), "quality-sample")
    rows = documents.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id").select("id", "label", "text")  # sample_rows rows at most
    kind = documents.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_featurise, f"id {kind}, label boolean, features array<double>").groupBy("id", "label").agg(F.min("features").alias("features"))
    rows = sorted(found.collect(), key=lambda r: (r.id, r.label))  # sample_rows at most
    x = np.array([r.features for r in rows]).reshape(len(rows), len(FEATURES))
    return AdditiveModel().fit(x, np.array([float(r.label) for r in rows]))


def score_quality(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """documents with held_out, score and predicted. labels: doc_id, quality."""
    keep = [c for c in documents.columns if c not in ("held_out", "score", "predicted")]
    model = documents.sparkSession.sparkContext.broadcast(fit_quality(documents, labels, sample_rows))
    rows = documents.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col("text").alias("_last"))
    schema = T.StructType([T.StructField("_last", T.DoubleType()) if f.name == "_last" else f for f in rows.schema])
    scored = rows.mapInArrow(_scorer(model), schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("_last"))
    return scored.select(*[F.col(c) for c in keep], hold_out("doc_id", 3, 1).alias("held_out"), F.col("_last").alias("score"), (F.col("_last") >= THRESHOLD).cast("int").alias("predicted"))


def keep_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents predicted to be of good quality."""
    return score_quality(docs, table(spark, sf_dir, "labels")).where("predicted = 1").select(*DOCUMENT_COLUMNS)


def query(spark, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")).drop("text")
