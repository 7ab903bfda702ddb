"""Substring deduplication by sliding sentence spans.

Texts are cut into sentences; every run of ``span`` and more consecutive sentences counts,
and sentences that are covered by a run which is not the first of its kind are removed.
"First" is the document with the smallest key, and the first place in it.

A sentence ends with its full stop, exclamation or question mark, in any script, or line
break (in Thai and Lao, which have no such signs, also with a space) and owns the
white space behind it, so the sentences of a text joined are the text.  Runs are
of sentences that hold words, and are equal if these sentences have equal words, one by
one, A-Z in lower case; what lies between two sentences of a run belongs to it.

A run of more than ``span`` sentences is equal to an earlier one only if each run of
``span`` sentences in it is equal to the earlier run at the same place there, and covers no
more than these do together.  So the runs of ``span`` sentences, slid along the text,
stand for the runs of every length: their hashes meet in one global aggregate, and nothing
is missed by leaving the longer ones out.  There are no least lengths.

Hashes, keys and text hashes are stored once and shuffled twice: for the aggregate, which
combines before the shuffle, and for its join, which has the runs that occur in several
documents on one side, so Spark splits a run that very many documents share.

Defined results: null and empty texts have no sentences and stay as they are; a text
of fewer than ``span`` sentences is never touched; rows that are equal in key and text are
one document, given more than once, and each keeps what is first in it; rows with one key
and different texts are ordered by a hash of the text, null keys come behind all others;
a text that loses all sentences becomes empty, its row stays; an empty table gives an
empty result; further columns stay, except that those with the name of an added one (in
any case) are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import add_columns, kept, output_names, prepare
from tunesmith.llm.suffixes import identified
from tunesmith.llm.wordcodes import NOT_SPACE, batch_words, mix

SPAN = 2
ENDS = (
    ".!?\\n\u2028\u2029\x85\u3002\uff0e\uff61\uff01\uff1f\u203c\u203d\u2047-\u2049\u037e\u0589\u061d-\u061f\u06d4\u0700-\u0702\u0964\u0965"
    "\u0df4\u0f0d\u0f0e\u104b\u1362\u1367\u1368\u166e\u17d4\u17d5\u1803\u1809\u1aa8-\u1aab\u1b5a\u1b5b\u1b5e\u1b5f\u1c3b\u1c3c\u1c7e\u1c7f\ua4ff\ua60e\ua60f\uaa5d-\uaa5f\uabeb"
)
SPACE = " \\t\\r\\n\u3000\u2028\u2029\x85"
#: Thai and Lao: a space ends a sentence.
SPACED = "\u0e00-\u0eff"
SENTENCE = re.compile(f"[^{ENDS}]*[{ENDS}]+[{SPACE}]*|[^{ENDS}]+")
SPACED_SENTENCE = re.compile(f"(?:[^{ENDS}{SPACED}]|[{SPACED}](?![ \\t\u3000]))*(?:[{SPACED}][ \\t\u3000]+|[{ENDS}]+[{SPACE}]*)|[^{ENDS}]+")
HAS_SPACED = re.compile(f"[{SPACED}][ \\t\u3000]")
WIDE_SPACE = re.compile("[\u3000\u2028\u2029\x85]")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def sentences(text: str) -> list[str]:
    if not text.isascii() and HAS_SPACED.search(text):
        return SPACED_SENTENCE.findall(text)
    return SENTENCE.findall(text)


def runs(texts: list[str | None], span: int):
    """For each text: its sentences, and ``(first, end, hash)`` arrays of its runs."""
    cut = [sentences(t) if t else [] for t in texts]
    flat = pa.array([s if s.isascii() else WIDE_SPACE.sub(" ", s) for c in cut for s in c], type=pa.string())
    _, codes, _, _, at = batch_words(flat, NOT_SPACE)
    powers = np.cumprod(np.full(len(codes) + 1, _FACTOR, np.uint64), dtype=np.uint64)
    down = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
    unpowers = np.cumprod(np.full(len(codes) + 1, down, np.uint64), dtype=np.uint64)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers[:-1], out=sums[1:])
    own = mix((sums[at[1:]] - sums[at[:-1]]) * unpowers[at[:-1]] + np.diff(at).astype(np.uint64))
    out, base = [], 0
    for c in cut:
        said = np.flatnonzero(np.diff(at[base : base + len(c) + 1]))  # sentences with words
        hashes, n = own[base + said], max(len(said) - span + 1, 0)
        total = np.full(n, np.uint64(span))
        for k in range(span):
            total = mix(total * _FACTOR + hashes[k : k + n])
        out.append((c, said[:n], said[span - 1 :] + 1 if n else said[:0], total.view(np.int64)))
        base += len(c)
    return out


def later_runs(docs: DataFrame, span: int) -> DataFrame:
    """``key``, ``id``, ``gone``: the runs of each document that a document before it has."""

    def make():
        def work(column):
            return [[np.unique(h).tolist() for *_, h in runs(column.to_pylist(), span)]]

        return work

    found = add_columns(docs, "text", "run array<bigint>", make).select("key", "id", "run")
    found = kept(found, "sentence_runs").select("key", "id", F.explode("run").alias("run"))
    order = F.struct(F.col("key").isNull().alias("none"), "key", "id")
    shared = found.groupBy("run").agg(F.min(order).alias("first"), F.max(order).alias("last")).where("first < last")
    later = found.join(shared.select("run", "first"), "run")
    later = later.where(~(F.col("first.key").eqNullSafe(F.col("key")) & (F.col("first.id") == F.col("id"))))
    return later.groupBy("id", "key").agg(F.collect_set("run").alias("gone"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """``docs`` with ``clean`` (the text that stays), ``n_sentences``, ``n_removed`` and
    ``removed`` (numbers of the sentences that went)."""
    if span < 2:
        raise ValueError("a run has several sentences")
    prepare(docs.sparkSession)
    rows = identified(docs, key, text)
    later = later_runs(rows.select("key", "id", "text"), span).withColumnRenamed("key", "of").withColumnRenamed("id", "of_id")
    joined = rows.join(later, (F.col("id") == F.col("of_id")) & F.col("key").eqNullSafe(F.col("of")), "left")
    source = F.struct(F.col("row").getField(text).alias("text"), "gone").alias("source")

    def make():
        def work(column):
            texts = column.field("text").to_pylist()
            gone = column.field("gone").to_pylist()
            clean, number, n_removed, removed = [], [], [], []
            for text_, hashes, (cut, first, end, h) in zip(texts, gone, runs(texts, span)):
                away = np.zeros(len(cut) + 1, np.int64)
                if len(h):
                    _, at, of = np.unique(h, return_index=True, return_inverse=True)
                    again = np.arange(len(h)) != at[of]  # a run that the text itself repeats
                    if hashes:
                        again |= np.isin(h, np.array(hashes, dtype=np.int64))
                    np.add.at(away, first[again], 1)
                    np.add.at(away, end[again], -1)
                covered = np.cumsum(away)[:-1] > 0
                clean.append("".join(s for s, c in zip(cut, covered) if not c) if covered.any() else text_)
                number.append(len(cut))
                n_removed.append(int(covered.sum()))
                removed.append(np.flatnonzero(covered).tolist())
            return [clean, number, n_removed, removed]

        return work

    added = "clean string, n_sentences bigint, n_removed bigint, removed array<bigint>"
    done = add_columns(joined.select("row", source), "source", added, make)
    return output_names(done, docs, ["clean", "n_sentences", "n_removed", "removed"])
