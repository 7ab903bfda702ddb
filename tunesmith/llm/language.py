"""Language identification with string kernels.

Two texts are compared by the blended spectrum kernel of presence: the number of
character n-grams (n = 1 to ``MAX_N``) that both contain, divided by the root of the
product of their own numbers.  A bounded sample of labelled texts gives ``landmarks``
texts; the Nystroem map of a text is its kernel row against the landmarks times the
inverse root of the landmark kernel.  One-versus-rest kernel ridge regression is solved
on these maps.  The values are linear in the presence, so landmarks, map and weights are
one weight for each place and language, and scoring adds the weights of a text's places.

Presence is kept as a list of ``WIDTH`` hashed places, far more than the n-grams of a text
of some MB; a place that no landmark has weighs nothing.  The score is the softmax of the regression
values at ``SHARPNESS``.

Defined results: a null text or one without a letter gets ``und`` and score 0; very long
texts are read whole; repeated texts get the same result; with no labelled text at all
every text is ``und``; columns of the input that have the name of an added one are
replaced.  Language, source and key are never read when scoring.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import add_columns, bounded_sample, fold, prepare, text_hash
from tunesmith.llm.wordcodes import SLICE, mix, utf8_parts

MAX_N = 4
WIDTH = 1 << 20
#: Labelled texts per language, and landmarks in all.
PER_LANGUAGE = 400
LANDMARKS = 128
RIDGE = 1e-2
SHARPNESS = 6.0
UNKNOWN = "und"
#: Bytes at once while n-grams are hashed.
PIECE = SLICE // 4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[:65] = 32  # digits, signs, white space: one gap
_LOWER[91:97] = 32
_LOWER[123:128] = 32


def presence(column: pa.Array) -> list[np.ndarray]:
    """The hashed places of the n-grams of letters that each text contains."""
    data, starts, ends = utf8_parts(column)
    bits = np.uint64(64 - (WIDTH.bit_length() - 1))
    last = np.zeros(WIDTH, np.int32)

    def distinct(places):
        number = np.arange(len(places), dtype=np.int32)
        last[places] = number
        return places[last[places] == number]

    out = []
    for start, end in zip(starts.tolist(), ends.tolist()):
        found = np.zeros(0, np.int64)
        for at in range(start, end, PIECE):
            chars = _LOWER[data[at : min(end, at + PIECE + MAX_N - 1)]].astype(np.uint64)
            code, places = np.zeros(len(chars), np.uint64), [found]
            for n in range(1, MAX_N + 1):
                if len(chars) < n:
                    break
                code = code[: len(chars) - n + 1] * np.uint64(256) + chars[n - 1 :]
                # the last piece but one reads a little of the next: a set does not mind
                places.append((mix(code + np.uint64(n << 40)) >> bits).astype(np.int64))
            found = distinct(np.concatenate(places))
        out.append(found)
    return out


def _sums(places: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Sum of the rows of each text's places, over the root of their number."""
    sums = np.array([rows[p].sum(axis=0) for p in places], dtype=np.float64).reshape(len(places), rows.shape[1])
    return sums / np.sqrt(np.maximum([len(p) for p in places], 1))[:, None]


def fit(labels: list[str], texts: list[str]) -> dict | None:
    """Landmarks and weights from a bounded sample."""
    if not labels:
        return None
    names = sorted(set(labels))
    order = np.random.Generator(np.random.PCG64(7)).permutation(len(labels))
    x = [p for a in range(0, len(order), 64) for p in presence(pa.array([texts[i] for i in order[a : a + 64]]))]
    y = np.array([names.index(labels[i]) for i in order])
    per = max(1, LANDMARKS // len(names))
    marks = np.concatenate([np.flatnonzero(y == c)[:per] for c in range(len(names))])
    used = np.unique(np.concatenate([x[i] for i in marks]))
    row = np.full(WIDTH, len(used))  # the last row: places of no landmark
    row[used] = np.arange(len(used))
    land = np.zeros((len(used) + 1, len(marks)), np.float32)
    for k, i in enumerate(marks):
        land[row[x[i]], k] = 1 / np.sqrt(max(1, len(x[i])))
    kernel = _sums([row[p] for p in x], land)
    values, vectors = np.linalg.eigh(kernel[marks])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    maps = kernel @ root
    maps = np.hstack([maps, np.ones((len(maps), 1))])
    share = np.bincount(y, minlength=len(names))
    weight = (1 / share)[y][:, None]  # languages count alike
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    gram = maps.T @ (maps * weight) + RIDGE * np.eye(maps.shape[1])
    solved = np.linalg.solve(gram, maps.T @ (target * weight))
    return {
        "names": names,
        "places": used,
        "weights": (land[:-1] @ (root @ solved[:-1])).astype(np.float32),
        "bias": solved[-1].astype(np.float32),
    }


def has_letter(column: pa.Array) -> np.ndarray:
    return np.array([v is not None and any(c.isalpha() for c in v) for v in column.to_pylist()], dtype=bool)


def score_batch(model: dict | None, column: pa.Array, least_known: float = 0.0) -> list:
    if model is None:
        return [[UNKNOWN] * len(column), [0.0] * len(column)]
    known = has_letter(column)
    grams = presence(column)
    if "rows" not in model:  # once a worker
        model["rows"] = np.zeros((WIDTH, len(model["names"])), np.float32)
        model["rows"][model["places"]] = model["weights"]
    values = SHARPNESS * (_sums(grams, model["rows"]) + model["bias"])
    if least_known:
        used = model["rows"].any(axis=1)
        known &= np.array([len(g) and used[g].mean() >= least_known for g in grams], dtype=bool)
    values = np.exp(values - values.max(axis=1, keepdims=True))
    values /= values.sum(axis=1, keepdims=True)
    best = values.argmax(axis=1)
    labels = [model["names"][b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
    return [labels, np.where(known, values.max(axis=1), 0.0)]


def train(docs: DataFrame, text: str, label: str, per_language: int = PER_LANGUAGE) -> dict | None:
    """Model from at most ``per_language`` distinct texts of each language.

    The fit is one task on that bounded sample; only the model reaches the driver.
    """
    import pickle

    marks = docs.select(F.col(label).cast("string").alias("label"), text_hash(text).alias("h"))
    sample = bounded_sample(marks, docs, text, per_language).coalesce(1)

    def run(batches):
        labels, texts = [], []
        for batch in batches:
            labels += batch.column(0).to_pylist()
            texts += batch.column(1).to_pylist()
        order = sorted(range(len(texts)), key=lambda i: (labels[i], texts[i]))
        model = fit([labels[i] for i in order], [texts[i] for i in order])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    rows = sample.mapInArrow(run, "model binary").collect()
    return pickle.loads(bytes(rows[0].model)) if rows else None


def identify(docs: DataFrame, model: dict | None, text: str = "text", least_known: float = 0.0) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    With ``least_known``, texts that share less than this part of their n-grams with the
    landmarks (other scripts, mostly) are in no learnt language, either.
    """
    return add_columns(docs, text, "lang_pred string, score double", lambda: lambda c: score_batch(model, c, least_known))


def trained_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows that labels may be learnt from: crc32 of the key mod 4 is not 2."""
    return docs.where(fold(key, 4) != 2)


def language_report(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    prepare(docs.sparkSession)
    model = train(trained_rows(docs, key), text, label)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    done = identify(rows, model).withColumn("held_out", F.coalesce(fold("key", 4) == 2, F.lit(False)))
    return done.select(F.col("key").alias(key), "held_out", "lang_pred", "score")
