"""What grows with a batch or a row: calls of outside tokenizers, joined words, hashed places."""

import re
import tracemalloc

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tunesmith.functions.tokenizers import OutsideTokenizer, hashing_tokenizer
from tunesmith.operators import criteria, tokens
from tunesmith.operators.criteria import embed_tfidf
from tunesmith.operators.tokens import build_vocab, encode

SEGMENTS = "id INT, segments ARRAY<STRUCT<text STRING, generated BOOLEAN>>"


def test_an_outside_tokenizer_gets_a_batch_in_bounded_calls(spark):
    def load():
        def encode_all(texts):
            if sum(map(len, texts[:-1])) >= 1 << 18:
                raise ValueError("too much at once")
            return [([len(t)], [(0, len(t))]) for t in texts]

        return encode_all

    sizes = [5000 + i % 7 for i in range(400)] + [600_000, 0, 3]
    rows = [(i, [("a", False), ("x" * n, True)]) for i, n in enumerate(sizes)]
    got = encode(spark.createDataFrame(rows, SEGMENTS).coalesce(1), OutsideTokenizer(load, 2, 0)).collect()
    assert {r.id: (r.ids, r.generated) for r in got} == {i: ([n + 1], [int(n > 0)]) for i, n in enumerate(sizes)}


def test_the_hashing_tokenizer_keeps_little():
    encoder = hashing_tokenizer().loader()
    tracemalloc.start()
    for start in range(0, 400_000, 20_000):
        encoder(["".join(f"{i:06d}"[::-1] for i in range(start, start + 20_000)), "".join(map(chr, range(0x4E00, 0x9E00)))])
    for start in range(0, 300):
        encoder(["".join(chr(0x4E00 + (i * 7 + start * 13 + j) % 20_000) for i in range(1000) for j in (0, start, i % 97))])
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 20e6


def test_joined_words_come_back_per_block_of_rows(spark):
    texts = [" ".join(f"w{(i * 31 + j * j) % 300}" for j in range(i % 40)) for i in range(500)] + [None, "", "x " * 200_000, "y"]
    df = spark.createDataFrame(pd.DataFrame({"text": texts, "id": range(len(texts))}), "text STRING, id INT").coalesce(1)
    vocab = build_vocab(df, None)
    made = encode(df.select("id", F.array(F.struct("text", F.lit(True).alias("generated"))).alias("segments")), vocab, by_join=True)
    ids = {r.tok: r.id for r in vocab.collect()}
    for r in made.collect():
        want = [ids[t] for t in re.findall("[a-z]+|[0-9]+", texts[r.id] or "")]
        assert r.ids == want and r.generated == [1] * len(want)
    plan = made._jdf.queryExecution().analyzed().toString()
    assert "map_from" not in plan and "_block" in plan


def test_joined_words_of_null_segments_and_repeated_vocabulary(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [("a b", None)])], SEGMENTS)
    vocab = spark.createDataFrame([("a", 7), ("q", 8), ("q", 9)], "tok STRING, id INT")
    got = {r.id: (r.ids, r.generated) for r in encode(df, vocab, by_join=True).collect()}
    assert got == {1: (None, None), 2: ([], []), 3: ([7, 3], [None, None])}
    with pytest.raises(Exception, match="twice"):
        encode(df, vocab.union(vocab), by_join=True).collect()


def test_words_of_a_row_are_counted_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(criteria, "CACHED_WORDS", 3)
    rows = [(1, "a b a Ä ä x1"), (1, "b c"), (2, None), (3, ""), (None, "a a"), (4, "a")]
    vectors = embed_tfidf(spark.createDataFrame(rows, "doc_id LONG, text STRING"), dim=16)
    text = vectors._jdf.queryExecution().analyzed().toString()
    assert "md5" not in text and "regexp_extract_all" not in text  # counted once, and stored
    got = {}
    for r in vectors.collect():
        got.setdefault(r.doc_id, []).append(r.embedding)
    assert {k: len(v) for k, v in got.items()} == {1: 2, 2: 1, 3: 1, None: 1, 4: 1} and got[1][0] == got[1][1]
    assert not any(got[2][0]) and not any(got[3][0]) and not any(got[None][0])
    assert all(len(v[0]) == 16 for v in got.values()) and abs(sum(x * x for x in got[4][0]) - 1) < 1e-9


def test_blocks_end_by_rows_and_by_characters():
    lines = pd.Series(["a\nb", "b\nc"] * 40 + ["z\n" * 200_000 + "z", "a", None, ""])
    made = tokens._block_words(pd.Series(range(1000, 1000 + len(lines))), lines)
    assert list(dict.fromkeys(made.block)) == [1000, 1064, 1081]
    own = {b: o for b, o in zip(made.block, made.own) if o is not None}
    assert own[1000] == "a\nb\nc" and own[1064] == "a\nb\nc\nz" and own[1081] == "a"
    assert made.numbers[82] is None and len(made.numbers[83]) == 0 and list(made.numbers[1]) == [1, 2]
    assert len(tokens._block_words(pd.Series([], dtype=int), pd.Series([], dtype=object))) == 0
