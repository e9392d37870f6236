"""Toxicity: a convolutional text classifier trained in numpy.

Words of [0-9a-z] and non-ASCII bytes (A-Z lower-cased) are hashed into
BUCKETS embedding rows, their first STEM_BYTES bytes into as many more; a
word's embedding is the sum of both rows, so that inflected and compounded
forms share what their stem has learned.  Filters of several widths slide over the whole text,
each keeps its largest response, and a logistic layer gives the logit.  The
decision thresholds are calibrated by language on a part of the sample that is
not trained on.  The language is guessed from the words of the text, never
read from a column: the logit is shifted by its guessed language's threshold,
so that every language's threshold comes to lie at a score of THRESHOLD.

Training rows: at most SAMPLE_PER_CLASS labelled ids of either label, chosen by
a hash of the id (so reruns agree), each with one text (of rows that share the
id, the smallest by its words); every text is read and scored whole.

Edge cases: null and empty text have no words and get the score of no response;
rows with a null label or id are not learned from; an id of both labels is
learned from twice; with no labelled row the score is that of a bias of zero;
repeated rows and ids each keep their row; equal texts have equal scores, and
a score at THRESHOLD is label 1; an empty table gives no rows; input columns
named like an output are replaced, other columns stay.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hold_out, materialise, sampled, table
from .textvec import NON_WORD_BYTES, blocks, lower_table, pieces, spans, word_hashes

BUCKETS = 1 << 20
STEM_BYTES = 6
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
SAMPLE_PER_CLASS = 2500
EPOCHS = 8
BATCH = 64
MIN_ROWS = 3
THRESHOLD = 0.3

#: Frequent function words (fixed values), by which a text's language is guessed.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are with as be this by",
    "fr": "le la les de des et un une est dans que qui pour pas sur avec du",
    "de": "der die das und ist von den dem nicht mit ein eine zu im für auf auch",
    "es": "el los las y un una en por con para del se su lo como más es",
}


def buckets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the buckets of the word and of its stem, and the index of each row's first word."""
    data = lower_table()[data]
    starts, ends, first = spans(data, offs, NON_WORD_BYTES)
    words, stems = word_hashes(data, np.concatenate((starts, starts)), np.concatenate((ends, np.minimum(ends, starts + STEM_BYTES)))).reshape(2, -1)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    return np.stack(((words >> shift).astype(np.int64), (stems >> shift).astype(np.int64) + BUCKETS), axis=1), first


def language_table() -> np.ndarray:
    out = np.zeros(BUCKETS, np.int8)
    for k, words in enumerate(FUNCTION_WORDS.values()):
        text = words.encode()
        out[buckets(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0][:, 0]] = k + 1
    return out


def guess_language(table_: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """0 if no function word occurs, else 1 + the language of most of them."""
    rows, k = len(first) - 1, len(FUNCTION_WORDS) + 1
    row = np.repeat(np.arange(rows), np.diff(first))
    counts = np.bincount(row * k + table_[words[:, 0]], minlength=rows * k).reshape(rows, k)
    counts[:, 0] = 0
    return counts.argmax(1)


class TextCNN:
    """Embedding, filters of WIDTHS words, ReLU, max pooling and a logistic layer, trained by Adam."""

    def __init__(self, seed: int = 7):
        self.rng = np.random.default_rng(seed)

    def _padded(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedding rows with max(WIDTHS) rows of padding (row 0, all zero) after each text, and where texts begin."""
        pad, n = max(WIDTHS), np.diff(first)
        begin = first[:-1] + pad * np.arange(len(n))
        out = np.zeros((len(words) + pad * len(n), 2), np.int64)
        row = np.repeat(np.arange(len(n)), n)
        out[np.arange(len(words)) + pad * row] = self.index[words]
        return out, begin

    def _respond(self, rows: np.ndarray) -> list[np.ndarray]:
        """For each width, the responses of its filters at each place."""
        e = self.p["emb"][rows[:, 0]] + self.p["emb"][rows[:, 1]]
        out = []
        for w in WIDTHS:
            r = np.tile(self.p[f"b{w}"], (len(rows), 1))
            for j in range(w):
                r[: len(rows) - j] += e[j:] @ self.p[f"w{w}"][j]
            out.append(r)
        return out

    def _pool(self, responses: list[np.ndarray], begin: np.ndarray) -> np.ndarray:
        return np.concatenate([np.maximum(np.maximum.reduceat(r, begin, axis=0), 0) for r in responses], axis=1)

    def logits(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        rows, begin = self._padded(words, first)
        return self._pool(self._respond(rows), begin) @ self.p["out"] + self.p["bias"][0]

    def fit(self, texts: list[np.ndarray], y: np.ndarray) -> TextCNN:
        n_rows = np.bincount(np.concatenate([np.unique(t) for t in texts] or [np.zeros(0, np.int64)]), minlength=2 * BUCKETS)
        known = np.flatnonzero(n_rows >= min(MIN_ROWS, max(1, len(texts) // 50)))
        self.index = np.zeros(2 * BUCKETS, np.int32)
        self.index[known] = np.arange(1, len(known) + 1)
        # Embeddings start at zero, so words not trained on respond like padding.
        self.p = {"emb": np.zeros((len(known) + 1, DIM), np.float32), "out": np.full(FILTERS * len(WIDTHS), 0.5, np.float32), "bias": np.full(1, -1 if len(y) else 0, np.float32)}
        for w in WIDTHS:
            self.p[f"w{w}"] = self.rng.normal(0, 0.4, (w, DIM, FILTERS)).astype(np.float32)
            self.p[f"b{w}"] = np.full(FILTERS, 0.01, np.float32)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for _ in range(EPOCHS if len(y) and y.min() != y.max() else 0):
            order = self.rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                take = order[at : at + BATCH]
                first = np.concatenate(([0], np.cumsum([len(texts[i]) for i in take])))
                grads = self._gradients(np.concatenate([texts[i] for i in take]), first, y[take])
                step += 1
                for k, g in grads.items():
                    if k == "emb":  # the rows that this batch touches
                        r, g = g
                        m[k][r] = 0.9 * m[k][r] + 0.1 * g
                        v[k][r] = 0.99 * v[k][r] + 0.01 * g * g
                        self.p[k][r] -= 0.02 * (m[k][r] / (np.sqrt(v[k][r]) + 1e-4) + 0.05 * self.p[k][r])
                        self.p[k][0] = 0
                    else:
                        m[k] = 0.9 * m[k] + 0.1 * g
                        v[k] = 0.99 * v[k] + 0.01 * g * g
                        self.p[k] -= 0.01 * m[k] / (np.sqrt(v[k]) + 1e-4)
        return self

    def _gradients(self, words: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict:
        rows, begin = self._padded(words, first)
        responses = self._respond(rows)
        pooled = self._pool(responses, begin)
        z = pooled @ self.p["out"] + self.p["bias"][0]
        d = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)).astype(np.float32)
        out = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
        at_rows, at_grads = [], []
        size = np.diff(np.append(begin, len(rows)))
        for k, (w, r) in enumerate(zip(WIDTHS, responses, strict=True)):
            top = pooled[:, k * FILTERS : (k + 1) * FILTERS]
            # The first place of each text at which each filter has its largest response.
            place, which = np.nonzero(r == np.repeat(top, size, axis=0))
            text = np.searchsorted(begin, place, "right") - 1
            _, one = np.unique(text * FILTERS + which, return_index=True)
            place, which, text = place[one], which[one], text[one]
            g = d[text] * self.p["out"][k * FILTERS + which]
            gw, gb = np.zeros_like(self.p[f"w{w}"]), np.zeros_like(self.p[f"b{w}"])
            np.add.at(gb, which, g)
            for j in range(w):
                e = rows[np.minimum(place + j, len(rows) - 1)]
                np.add.at(gw[j].T, which, self.p["emb"][e].sum(1) * g[:, None])
                at_rows += [e[:, 0], e[:, 1]]
                at_grads += 2 * [self.p[f"w{w}"][j].T[which] * g[:, None]]
            out |= {f"w{w}": gw, f"b{w}": gb}
        e, inverse = np.unique(np.concatenate(at_rows), return_inverse=True)
        total = np.zeros((len(e), DIM), np.float32)
        np.add.at(total, inverse, np.concatenate(at_grads))
        out["emb"] = (e, total)
        return out


def best_threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The logit that gives the best F1; of equal ones the middle of the widest gap."""
    order = np.argsort(z)
    z, y = z[order], y[order]
    cuts = np.concatenate(([z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]))
    gap = np.concatenate(([0], np.diff(z), [0]))
    hit = y.sum() - np.concatenate(([0], np.cumsum(y)))
    f1 = 2 * hit / np.maximum(len(y) - np.arange(len(y) + 1) + y.sum(), 1)
    return float(cuts[np.lexsort((gap, np.round(f1, 9)))[-1]])


class Classifier:
    """TextCNN with a threshold for each guessed language."""

    def __init__(self, texts: list[np.ndarray], y: np.ndarray):
        held = np.arange(len(texts)) % 5 == 4 if len(texts) >= 50 else np.zeros(len(texts), bool)
        self.net = TextCNN().fit([t for t, h in zip(texts, held, strict=True) if not h], y[~held].astype(np.float32))
        self.languages = language_table()
        self.cut = np.zeros(len(FUNCTION_WORDS) + 1)
        tune = held if held.any() else ~held
        if tune.any() and y[tune].min() != y[tune].max():
            some = [t for t, h in zip(texts, tune, strict=True) if h]
            first = np.concatenate(([0], np.cumsum([len(t) for t in some])))
            words = np.concatenate(some)
            z, of, label = self.net.logits(words, first), guess_language(self.languages, words, first), y[tune]
            self.cut[:] = best_threshold(z, label)
            for k in range(len(self.cut)):
                own = of == k
                if own.sum() >= 40 and 8 <= label[own].sum() <= own.sum() - 8:
                    self.cut[k] = best_threshold(z[own], label[own])

    def score(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        z = self.net.logits(words, first) - self.cut[guess_language(self.languages, words, first)]
        return 1 / (1 + np.exp(-np.clip(z + np.log(THRESHOLD / (1 - THRESHOLD)), -35, 35)))


def _to_buckets(batches):
    import pyarrow as pa

    for batch in pieces(batches, "text"):
        out = []
        for _, _, data, offs in blocks(batch.column("text")):
            words, first = buckets(data, offs)
            words = words.astype("<i4")
            out += [words[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(out, pa.binary())], names=["id", "label", "words"])


def _scorer(model):
    def run(batches):
        import pyarrow as pa

        for batch in pieces(batches, "_last"):
            scores = [model.value.score(*buckets(data, offs)) for _, _, data, offs in blocks(batch.column("_last"), 1 << 19)]
            yield batch.set_column(batch.schema.get_field_index("_last"), "_last", pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64()))

    return run


def fit_toxicity(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Classifier:
    """labels: doc_id, toxic.  Learns only from ids that are not held out."""
    learn = labels.where(~hold_out("doc_id", 4, 2) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    learn = learn.select(F.col("doc_id").alias("id"), (F.col("toxic") == 1).alias("label")).distinct()
    chosen = materialise(sampled(learn.where("label"), "id", per_class).unionByName(sampled(learn.where("not label"), "id", per_class)), "toxicity-sample")
    rows = documents.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id").select("id", "label", "text")  # 2 * per_class rows at most
    kind = documents.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_to_buckets, f"id {kind}, label boolean, words binary").groupBy("id", "label").agg(F.min("words").alias("words"))
    rows = sorted(found.collect(), key=lambda r: (zlib.crc32(str(r.id).encode()), r.id, r.label))  # 2 * per_class at most
    return Classifier([np.frombuffer(r.words, "<i4").astype(np.int64).reshape(-1, 2) for r in rows], np.array([r.label for r in rows], dtype=np.int64))


def score_toxicity(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """documents with held_out, score and predicted."""
    keep = [c for c in documents.columns if c not in ("held_out", "score", "predicted")]
    model = documents.sparkSession.sparkContext.broadcast(fit_toxicity(documents, labels, per_class))
    rows = documents.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col("text").alias("_last"))
    schema = T.StructType([T.StructField("_last", T.DoubleType()) if f.name == "_last" else f for f in rows.schema])
    scored = rows.mapInArrow(_scorer(model), schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("_last"))
    return scored.select(*[F.col(c) for c in keep], hold_out("doc_id", 4, 2).alias("held_out"), F.col("_last").alias("score"), (F.col("_last") >= THRESHOLD).cast("int").alias("predicted"))


def query(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")).drop("text")
