"""Quality classifier: supervised subword embeddings.

A document is the average of the learned vectors of its words and of the character
n-grams inside them (hashed to buckets); a softmax layer on the average gives the
class. The model is trained by stochastic gradient descent in numpy on a bounded
sample of labelled rows (``SAMPLE_ROWS`` rows of at most ``SAMPLE_CHARS`` characters,
chosen by a hash of the id) and is a few MB whatever the corpus.

Since the output is linear in the average, a trained model scores a text by the mean
of one number per feature. Scoring is a map over batches: no shuffle.

NULL and empty texts have no feature; their score is the bias alone. Without labelled
rows of both classes every score is 0.5. Rows that repeat get the same score; NULL
labels are not learned from; of several labels of one id the largest counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinepulse.llm.common import held_out, lean, with_columns

BUCKETS = 1 << 18
DIMENSION = 12
NGRAMS = (2, 3, 4)
SAMPLE_ROWS = 1500
SAMPLE_CHARS = 20_000
EPOCHS = 6
RATE = 0.1
THRESHOLD = 0.7
BLOCK_CHARS = 1 << 19
GROUP_CHARS = 1 << 17  # short texts are taken together up to this size; about 200 bytes a character
REPEATED = 0  # bucket of the feature "same word as before"

_M1, _M2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)
_SPACES = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], np.uint32)


def _mix32(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    x = (x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)
    return x ^ (x >> np.uint32(15))


def features(codes: np.ndarray, borders: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, position) of every word and n-gram of a text given as code points.

    A word is a run of characters that are not ASCII white space; an n-gram covers n
    characters of one word with its border as one more character at either end. A word
    that repeats the word before it has one more feature, the same for all words.
    ``borders``: ascending positions of the separators before each text."""
    padded = np.empty(len(codes) + 2, np.uint32)
    padded[0] = padded[-1] = 0x20
    padded[1:-1] = codes
    space = padded <= 0x20
    space &= np.isin(padded, _SPACES) if space.any() else False
    padded[space] = 0x20
    buckets, places = [], []
    inner = ~space
    for n in NGRAMS:
        m = len(padded) - n + 1
        if m < 1:
            continue
        h = np.full(m, n * 0x1F123BB5 & 0xFFFFFFFF, np.uint32)
        for j in range(n):
            h = (h ^ padded[j : j + m]) * _M1
            h ^= h >> np.uint32(13)
        ok = np.ones(m, bool)
        for j in range(1, n - 1):
            ok &= inner[j : j + m]
        ok &= inner[:m] | inner[n - 1 : n - 1 + m]
        at = np.flatnonzero(ok)
        buckets.append(_mix32(h[at]) & np.uint32(BUCKETS - 1))
        places.append(at)
    starts = np.flatnonzero(space[:-1] & inner[1:]) + 1
    if len(starts):
        ends = np.flatnonzero(inner[:-1] & space[1:]) + 1
        spread = padded * _M2
        # Word hash: characters weighted by their place in the word, summed.
        within = np.arange(len(padded), dtype=np.uint32)
        first = np.zeros(len(padded), np.uint32)
        first[starts] = starts.astype(np.uint32)
        within -= np.maximum.accumulate(first)
        total = np.zeros(len(padded) + 1, np.uint32)
        np.cumsum(_mix32(spread + within * _M1), out=total[1:], dtype=np.uint32)
        words = _mix32(total[ends] - total[starts] + np.uint32(1))
        again = words[1:] == words[:-1]
        if borders is not None:
            owner = np.searchsorted(borders, starts, "right")
            again &= owner[1:] == owner[:-1]
        again = starts[1:][again]
        buckets += [words & np.uint32(BUCKETS - 1), np.full(len(again), REPEATED, np.uint32)]
        places += [starts, again]
    if not buckets:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(places)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class Model:
    weights: np.ndarray  # BUCKETS x DIMENSION
    output: np.ndarray  # DIMENSION x 2
    bias: np.ndarray  # 2

    def per_feature(self) -> tuple[np.ndarray, float]:
        """One number per bucket, whose mean over a text plus the bias is the log odds."""
        side = self.output[:, 1] - self.output[:, 0]
        return (self.weights @ side).astype(np.float32), float(self.bias[1] - self.bias[0])


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Stochastic gradient descent over documents, one at a time, with a falling rate."""
    rng = np.random.default_rng(seed)
    model = Model(rng.uniform(-0.5, 0.5, (BUCKETS, DIMENSION)).astype(np.float32) / DIMENSION, np.zeros((DIMENSION, 2), np.float32), np.zeros(2, np.float32))
    model.output[:] = rng.normal(0, 0.1, model.output.shape)
    docs = []
    for t in texts:
        ids, n = np.unique(features(code_points(t))[0], return_counts=True)
        docs.append((ids, (n / max(1, n.sum())).astype(np.float32)))
    target = np.eye(2, dtype=np.float32)[np.array(labels, int)]
    total, done = epochs * len(docs), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            ids, part = docs[i]
            hidden = part @ model.weights[ids]
            logits = hidden @ model.output + model.bias
            p = np.exp(logits - logits.max())
            error = p / p.sum() - target[i]
            step = rate * (1 - done / total)
            back = model.output @ error
            model.output -= step * np.outer(hidden, error)
            model.bias -= step * error
            # The gradient of a feature's vector, scaled up as in an unaveraged sum.
            model.weights[ids] -= step * np.minimum(part * len(ids), 4.0)[:, None] * back
            done += 1
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text"):
    """The bounded training sample: (text, label) of up to ``rows`` labelled documents
    of at most ``chars`` characters that are not held out, lowest hashes of the id first."""
    known = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("quality").alias("label")).filter(~held_out("id"))
    ids = docs.select(F.col(id_col).cast("long").alias("id"), F.length(text_col).alias("n")).filter(F.col("n").between(1, chars)).join(known, "id")
    ids = ids.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(rows).select("id", "label")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.filter(F.length("text") <= chars).join(F.broadcast(ids), "id").orderBy("id", "text").select("text", "label").collect()


def fit(docs: DataFrame, labels: DataFrame, **columns: str) -> Model | None:
    sample = labelled_sample(docs, labels, **columns)
    if len({r["label"] for r in sample}) < 2:
        return None
    return train([r["text"] for r in sample], [int(r["label"]) for r in sample])


def text_scores(texts: list[str | None], values: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1; texts are taken whole, long ones block by block."""
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
    group, owners, size = [], [], 0

    def flush() -> None:
        if not group:
            return
        joined = "\n".join(group)
        bounds = np.cumsum([0] + [len(g) + 1 for g in group])
        # A feature that starts at the separator before a text belongs to that text.
        buckets, places = features(code_points(joined), bounds)
        owner = np.asarray(owners)[np.minimum(np.maximum(np.searchsorted(bounds, places, "right") - 1, 0), len(group) - 1)]
        sums[:] += np.bincount(owner, values[buckets], len(texts))
        counts[:] += np.bincount(owner, minlength=len(texts))
        group.clear(), owners.clear()

    for i, t in enumerate(texts):
        t = t or ""
        for a in range(0, len(t), BLOCK_CHARS):
            block = t[a : a + BLOCK_CHARS]
            group.append(block)
            owners.append(i)
            size += len(block)
            if size >= GROUP_CHARS:
                flush()
                size = 0
    flush()
    return 1 / (1 + np.exp(-np.clip(sums / np.maximum(counts, 1) + bias, -30, 30)))


def with_score(spark: SparkSession, docs: DataFrame, model: Model | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score as a further column."""
    if model is None:
        return docs.withColumn(score_col, F.lit(0.5))
    values, bias = model.per_feature()
    shared = spark.sparkContext.broadcast(values)  # one number per bucket: 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = text_scores(b.column(text_col).to_pylist(), shared.value, bias)
            yield with_columns(b, {score_col: pa.array(scores)})

    schema = docs.withColumn(score_col, F.lit(0.0)).schema
    return docs.mapInArrow(lean(run), schema)
