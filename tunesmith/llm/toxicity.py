"""Toxicity scores from subword-bag embeddings.

Every word contributes the vectors of its character n-grams (3 to 6 bytes, with word
marks), which live in ``BUCKETS`` hashed rows, so an unseen misspelling shares most
vectors with the word it distorts.  A text is the average of its vectors; a linear
softmax on top gives the probability.  Embeddings and softmax are trained jointly by
mini-batch descent in numpy, in one task, on a bounded sample of labelled texts
(``PER_CLASS`` of each label).  Because the softmax is linear, a trained model needs
only one number per hashed row.

Defined results: null and empty texts get the probability of an empty bag (the trained
bias); a label other than 0 and 1, a null label and a null key are not learnt from; a
key with several labels is learnt as often as it has them; repeated texts get the same
score; with no labelled text, or one class only, the score is the share of label 1, or
0 without labels.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import add_columns, bounded_sample, fold, prepare, text_hash
from tunesmith.llm.wordcodes import LETTERS_DIGITS, LOWER, SLICE, mix, utf8_parts

BUCKETS = 1 << 17
DIM = 8
PER_CLASS = 2500
EPOCHS = 15
BATCH = 64
#: Steps of the embeddings (plain descent: an n-gram moves with its share of a text) and
#: of the softmax.
RATE = 1000.0
SOFT_RATE = 0.05
SIZES = (3, 4, 5, 6)
SEED = 11


def bag(data: np.ndarray, start: int, end: int) -> np.ndarray:
    """Hashed n-grams of the words of one text, with repetitions."""
    found = []
    for at in range(start, end, SLICE):
        stop = min(end, at + SLICE)
        chars = LOWER[data[at:stop]]
        chars = np.where(LETTERS_DIGITS[chars], chars, 0)  # 0 marks the borders of words
        chars = np.concatenate(([0], chars, [0])).astype(np.uint64)
        gap = chars == 0
        code = chars
        inner = np.zeros(len(chars), dtype=np.int64)  # gaps inside, the first byte apart
        for n in range(2, max(SIZES) + 1):
            if len(chars) < n:
                break
            code = code[: len(chars) - n + 1] * np.uint64(257) + chars[n - 1 :] + np.uint64(1)
            # gaps strictly between first and last byte
            inner = inner[: len(chars) - n + 1] + (gap[n - 2 : len(chars) - 1] if n > 2 else 0)
            if n in SIZES:
                whole = code[inner == 0]
                found.append((mix(whole + np.uint64(n << 56)) % np.uint64(BUCKETS)).astype(np.int32))
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def fit(texts: list[str], labels: list[int]) -> tuple[np.ndarray, float]:
    """One weight per hashed row and a bias, from the jointly trained layers."""
    y = np.array(labels, dtype=np.int64)
    if len(set(labels)) < 2:
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    rows, counts = [], []
    for text in texts:
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        ids, n = np.unique(bag(raw, 0, len(raw)), return_counts=True)
        rows.append(ids)
        counts.append((n / max(1, n.sum())).astype(np.float32))
    rng = np.random.Generator(np.random.PCG64(SEED))
    embed = rng.uniform(-0.1 / DIM, 0.1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.3, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    past = np.full((DIM, 2), 1e-8, np.float32)  # squared gradients of the softmax so far
    share = np.bincount(y, minlength=2) / len(y)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(y))
        for a in range(0, len(order), BATCH):
            some = order[a : a + BATCH]
            ids = np.concatenate([rows[i] for i in some])
            part = np.concatenate([counts[i] for i in some])
            who = np.repeat(np.arange(len(some)), [len(rows[i]) for i in some])
            hidden = np.stack([np.bincount(who, embed[ids, d] * part, minlength=len(some)) for d in range(DIM)], axis=1)
            logits = hidden @ soft + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), y[some]] -= 1
            p /= (2 * share[y[some]])[:, None] * np.sqrt(len(some))  # classes count alike
            back = p @ soft.T
            down = hidden.T @ p
            past += down**2
            soft -= SOFT_RATE * down / np.sqrt(past)
            bias -= SOFT_RATE * p.sum(axis=0)
            for d in range(DIM):
                np.subtract.at(embed[:, d], ids, (rate * back[who, d] * part).astype(np.float32))
    return (embed @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def probabilities(weights: np.ndarray, bias: float, column: pa.Array) -> np.ndarray:
    data, starts, ends = utf8_parts(column)
    out = np.empty(len(column))
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        ids = bag(data, a, b)
        out[i] = (weights[ids].mean(dtype=np.float64) if len(ids) else 0.0) + bias
    return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def train(docs: DataFrame, marks: DataFrame, key: str, text: str, per_class: int = PER_CLASS):
    """Weights and bias from at most ``per_class`` distinct texts of each label.

    ``marks``: ``key`` and ``mark`` (0 or 1).  Labels meet hashes of texts, not texts.
    """
    hashes = docs.select(key, text_hash(text).alias("h"))
    labelled = hashes.join(marks.where("mark IN (0, 1)"), key).select(F.col("mark").cast("int").alias("label"), "h")
    sample = bounded_sample(labelled, docs, text, per_class).coalesce(1)

    def run(batches):
        texts, labels = [], []
        for batch in batches:
            labels += batch.column(0).to_pylist()
            texts += batch.column(1).to_pylist()
        order = sorted(range(len(texts)), key=lambda i: (labels[i], texts[i]))
        model = fit([texts[i] for i in order], [labels[i] for i in order])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    found = sample.mapInArrow(run, "model binary").collect()
    return pickle.loads(bytes(found[0].model)) if found else fit([], [])


def score(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    weights, bias = model

    def make():
        return lambda column: [probabilities(weights, bias, column)]

    done = add_columns(docs, text, "score double", make)
    return done.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity_report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    marks = labels.select(F.col(key).alias("key"), F.col(label).alias("mark")).where(fold("key", 5) != 0)
    model = train(rows, marks, "key", "text")
    done = score(rows, model).withColumn("held_out", F.coalesce(fold("key", 5) == 0, F.lit(False)))
    return done.select(F.col("key").alias(key), "held_out", "score", "predicted")
