"""Vocabulary, encoding, and token rows for the three training stages."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunesmith.fixed_values import (
    END,
    END_ID,
    FIRST_WORD_ID,
    IGNORE_LABEL,
    PAD,
    PAD_ID,
    PREFERENCE_LENGTH,
    REQUEST_PROMPT_TOKENS,
    REVISION_LENGTH,
    SFT_LENGTH,
    START,
    START_ID,
    UNKNOWN_ID,
)
from tunesmith.functions.tokenizers import OutsideTokenizer, Spans
from tunesmith.functions.text import split_tokens, split_words, truncate_to_tokens
from tunesmith.functions.tokenrows import (
    attention,
    ints,
    labels_from_mask,
    mask_with_end,
    padded,
)
from tunesmith.operators.chat import exchange, first_exchange, render_chat, valid_preferences
from tunesmith.operators.position import with_position
from tunesmith.session import store

SPECIAL_IDS = {PAD: PAD_ID, START: START_ID, END: END_ID}
SLOTS = 8192
#: Rows whose tokens share one list of words where the vocabulary is joined.
BLOCK_ROWS = 64
#: Largest vocabulary that is sent to the tasks as one value (Spark's estimate of it).
VALUE_BYTES = 64 << 20
#: Characters that Python works on at once (a call of an outside tokenizer, a block of
#: rows); a longer text comes by itself.
CALL_CHARS = 1 << 18


def build_vocab(df: DataFrame, size: int | None, text: str = "text") -> DataFrame:
    """The ``size`` most frequent words -> ``(tok, n, id)``; all words for ``None``.

    Ties go by spelling.  The count is combined map-side, the cut is a bounded
    top-k, and only its ``size`` rows are numbered; all words are numbered in ranges.
    """
    words = df.select(F.explode(split_words(F.col(text))).alias("tok"))
    counted = words.groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
    if size is None:
        ranked = with_position(counted.select("tok", (-F.col("n")).alias("less")), "tok", "less")
        number = (F.col("pos") + FIRST_WORD_ID).cast("int")
        return ranked.select("tok", (-F.col("less")).alias("n"), number.alias("id"))
    top = counted.orderBy(F.desc("n"), "tok").limit(size)
    rank = F.row_number().over(W.orderBy(F.desc("n"), "tok"))
    return top.withColumn("id", (rank + (FIRST_WORD_ID - 1)).cast("int"))


def _slot(tok: Column) -> Column:
    return F.pmod(F.hash(tok), F.lit(SLOTS))


def _with_specials(vocab: DataFrame) -> DataFrame:
    specials = vocab.sparkSession.createDataFrame(list(SPECIAL_IDS.items()), "tok STRING, id INT")
    return vocab.select("tok", "id").unionByName(specials)


def _fits_value(vocab: DataFrame) -> bool:
    """Whether Spark's estimate of the vocabulary's size is below ``VALUE_BYTES``."""
    plan = vocab._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes())) <= VALUE_BYTES


def _lookup_table(vocab: DataFrame) -> Column:
    """The vocabulary as one value: ``SLOTS`` small maps, found by the word's hash.

    Maps are searched from front to back; with a few words per slot that is cheap.
    """
    spark = vocab.sparkSession
    filled = _with_specials(vocab).groupBy(_slot(F.col("tok")).cast("bigint").alias("slot")).agg(
        F.collect_list(F.struct("tok", "id")).alias("words")
    )
    return (
        spark.range(SLOTS)
        .join(filled, F.col("id") == F.col("slot"), "left")
        .agg(F.array_sort(F.collect_list(F.struct("id", "words"))).alias("s"))
        .select(F.transform("s.words", lambda w: F.map_from_entries(w)).alias("slots"))
        .scalar()
    )


def _word_id(tok: Column, slots: Column) -> Column:
    return F.coalesce(
        F.try_element_at(F.element_at(slots, _slot(tok) + 1), tok), F.lit(UNKNOWN_ID)
    )


def encode(
    df: DataFrame,
    vocab: DataFrame | OutsideTokenizer,
    segments: str = "segments",
    drop_segments: bool = True,
    by_join: bool | None = None,
) -> DataFrame:
    """Add ``ids`` and ``generated`` (both ``ARRAY<INT>``) for rendered segments.

    No token crosses a segment border.  Unknown words get the unknown id.  A vocabulary
    of bounded size is one subquery value, so a corpus is encoded where it lies: no token
    rows, no join, no shuffle.  A larger one is joined to the distinct words of each block
    of rows, and the rows are encoded with the ids of these.  The result is the same;
    ``by_join`` overrides the choice by size.  An outside tokenizer encodes the text as
    one, so its tokens may cross borders (see ``encode_with_spans``).
    """
    if isinstance(vocab, OutsideTokenizer):
        return encode_with_spans(df, vocab, segments, drop_segments)
    cols = [c for c in df.columns if not (drop_segments and c == segments)]
    rows = df.select(*df.columns, F.col(f"{segments}.generated").alias("_flags"))
    if by_join or (by_join is None and not _fits_value(vocab)):
        return _encode_by_join(rows, vocab, segments, cols)
    # Every column is used once above the line that adds the vocabulary.  Only then
    # do the projections merge and the value stays a reference inside the lambda;
    # otherwise it would be copied into each row.
    rows = rows.withColumn("_slots", _lookup_table(vocab))
    per_segment = F.transform(
        segments,
        lambda s: F.transform(_tokens(s), lambda t: _word_id(t, F.col("_slots"))),
    )
    flags = F.zip_with(
        "_nested", "_flags", lambda ids, g: F.array_repeat(g.cast("int"), F.size(ids))
    )
    return rows.select(*cols, per_segment.alias("_nested"), "_flags").select(
        *cols, F.flatten("_nested").alias("ids"), F.flatten(flags).alias("generated")
    )


def _tokens(segment: Column) -> Column:
    return split_tokens(F.coalesce(segment["text"], F.lit("")))


def _encode_by_join(df: DataFrame, vocab: DataFrame, segments: str, cols: list[str]) -> DataFrame:
    """``encode`` for a vocabulary of any size; ``_flags`` are those of the segments.

    Rows are stored in blocks of at most ``BLOCK_ROWS``: a token is the number of its word
    in its block, the first row of a block holds the block's different words.  Only these
    are joined to the vocabulary; their ids come back as one array per block.  A word in
    very many blocks is split by Spark's skew join.  A vocabulary that holds a word of
    the rows twice fails.
    """
    nested = F.transform(segments, _tokens)
    split = df.select(
        *cols, "_flags", F.transform(nested, F.size).alias("_sizes"),
        F.array_join(F.flatten(nested), "\n").alias("_lines"), F.monotonically_increasing_id().alias("_row"),
    )
    number = F.pandas_udf(_block_words, "struct<block: bigint, own: string, numbers: array<int>>")
    made = split.select(*cols, "_flags", "_sizes", number("_row", "_lines").alias("_made"))
    rows = store(
        made.select(
            *cols, "_flags", "_sizes", F.col("_made.block").alias("_block"),
            F.col("_made.own").alias("_own"), F.col("_made.numbers").alias("_numbers"),
        ),
        "segments",
    )
    words = rows.select("_block", F.posexplode(F.split("_own", "\n")).alias("k", "tok")).join(_with_specials(vocab), "tok", "left")
    twice = F.raise_error(F.lit("a word occurs twice in the vocabulary")).cast("array<int>")
    own_ids = F.sort_array(F.collect_list(F.struct("k", F.coalesce("id", F.lit(UNKNOWN_ID)).alias("id"))))["id"]
    found = words.groupBy("_block").agg(
        F.when(F.count(F.lit(1)) > F.max("k") + 1, twice).otherwise(own_ids).alias("_ids")
    )
    flags = F.zip_with("_sizes", "_flags", lambda n, g: F.array_repeat(g.cast("int"), n))
    return rows.drop("_own").join(found, "_block", "left").select(
        *cols,
        F.transform("_numbers", lambda k: F.get(F.col("_ids"), k)).alias("ids"),
        F.flatten(flags).alias("generated"),
    )


def _block_words(row: pd.Series, lines: pd.Series) -> pd.DataFrame:
    """Tokens, one per line, as numbers of the different words of a block of rows.

    A block is named by its first row; it ends after ``BLOCK_ROWS`` rows, or with the
    row that brings it to ``CALL_CHARS`` characters.
    """
    blocks, owns, numbers = [], [], []
    known, first, held = {}, 0, 0
    for i, text in enumerate(lines):
        if i - first == BLOCK_ROWS or held >= CALL_CHARS:
            owns[first] = "\n".join(known) or None
            known, first, held = {}, i, 0
        tokens = text.split("\n") if text else []
        numbers.append(None if text is None else np.array([known.setdefault(t, len(known)) for t in tokens], np.int32))
        blocks.append(row.iat[first])
        owns.append(None)
        held += len(text or "")
    if owns:
        owns[first] = "\n".join(known) or None
    return pd.DataFrame({"block": blocks, "own": owns, "numbers": numbers})


Tokenizer = Callable[[list[str]], list[list[int]]]


def encode_with(
    df: DataFrame, loader: Callable[[], Tokenizer], text: str = "text", ids: str = "ids"
) -> DataFrame:
    """Add token ids from an outside tokenizer, opened once per Python worker."""
    opened: list[Tokenizer] = []

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        if not opened:
            opened.append(loader())
        return pd.Series(opened[0](texts.fillna("").tolist()), dtype="object")

    return df.withColumn(ids, run(F.col(text)))


def encode_with_spans(
    df: DataFrame, tokenizer: OutsideTokenizer, segments: str = "segments", drop_segments: bool = True
) -> DataFrame:
    """Add ``ids`` and ``generated`` for rendered segments, by an outside tokenizer.

    The segments are joined and encoded as one text.  A token is generated if any part
    of it lies in a generated segment, so one that straddles a border is, and so are all
    tokens that share the bytes of a generated character.  Empty tokens are not.  Null
    texts of segments are empty; a row without segments has no ids.  A narrow map: rows
    stay where they lie.  The tokenizer gets a batch in calls of about ``CALL_CHARS``
    characters, so that its objects live for one call; what a batch keeps are two arrays
    of four-byte numbers.
    """
    cols = [F.col(c) for c in df.columns if not (drop_segments and c == segments)]
    opened: list = []

    @F.pandas_udf("struct<ids: array<int>, generated: array<int>>")
    def run(texts: pd.Series, flags: pd.Series) -> pd.DataFrame:
        if not opened:
            opened.append(tokenizer.loader())
        ids, generated, flag = [], [], iter(flags)
        for parts in _calls(texts):
            encoded = opened[0](["".join(p) for p in parts])
            for part, made, (own, spans) in zip(parts, flag, encoded):
                size = [len(x) if tokenizer.unit == "chars" else len(x.encode()) for x in part]
                inside = overlaps(spans, size, [bool(g) for g in made] if made is not None else [])
                ids.append(np.array(own, np.int32))
                generated.append(np.array(inside, np.int32))
        return pd.DataFrame({"ids": ids, "generated": generated})

    made = run(F.col(f"{segments}.text"), F.col(f"{segments}.generated")).alias("_made")
    done = df.select(*cols, made).select(*cols, "_made.ids", "_made.generated")
    return done


def _calls(texts: Iterable) -> Iterator[list[list[str]]]:
    """The segments of consecutive rows, in groups that end when they hold ``CALL_CHARS``."""
    rows, held = [], 0
    for text in texts:
        rows.append([x or "" for x in text] if text is not None else [])
        held += sum(map(len, rows[-1]))
        if held >= CALL_CHARS:
            yield rows
            rows, held = [], 0
    if rows:
        yield rows


def overlaps(spans: Spans, sizes: list[int], generated: list[bool]) -> list[int]:
    """1 for each token span that shares something with a generated segment.

    Both lists lie in text order: a span is held against the last generated stretch
    that starts before its end.
    """
    if not len(spans):
        return []
    ends = np.cumsum(sizes) if sizes else np.zeros(0, np.int64)
    some = np.array([g and n > 0 for g, n in zip(generated, sizes)], bool)
    starts, ends = (ends - np.array(sizes, np.int64))[some], ends[some]
    token = np.array(spans, np.int64).reshape(-1, 2)
    at = np.searchsorted(starts, token[:, 1], "left") - 1
    inside = (at >= 0) & (token[:, 0] < token[:, 1])
    inside[inside] = ends[at[inside]] > token[inside, 0]
    return inside.astype(int).tolist()


def _end_id(vocab: DataFrame | OutsideTokenizer) -> int:
    return vocab.end_id if isinstance(vocab, OutsideTokenizer) else END_ID


def fit_length(df: DataFrame, length: int, overflow: str) -> DataFrame:
    """Apply the length policy to ``ids``/``generated`` (still without padding).

    ``overflow='truncate'`` cuts long rows, ``'drop'`` leaves them out.
    """
    if overflow == "drop":
        # A plain filter would be pushed below the encoder and encode every row a
        # second time; it does not pass a projection with a per-row id.
        once = df.withColumn("_row", F.monotonically_increasing_id())
        return once.where((F.size("ids") <= length) & (F.col("_row") >= 0)).drop("_row")
    if overflow != "truncate":
        raise ValueError(f"overflow: {overflow}")
    return df.withColumn("ids", F.slice("ids", 1, length)).withColumn(
        "generated", F.slice("generated", 1, length)
    )


def overflow_counts(df: DataFrame, length: int) -> DataFrame:
    """How many rows a ``'drop'`` policy would leave out."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.size("ids") > length).alias("n_too_long"),
    )


def _rendered_ids(pairs: DataFrame, vocab: DataFrame | OutsideTokenizer) -> DataFrame:
    """``(.., prompt, completion)`` -> ``(.., ids, generated)``."""
    keep = [c for c in pairs.columns if c not in ("prompt", "completion")]
    chat = pairs.withColumn("messages", exchange(F.col("prompt"), F.col("completion")))
    return encode(render_chat(chat.select(*keep, "messages")), vocab).select(
        *keep, "ids", "generated"
    )


def sft_examples(turns: DataFrame, vocab: DataFrame | OutsideTokenizer, length: int = SFT_LENGTH) -> DataFrame:
    """First exchanges as ``(conv_id, ids, labels)``; invalid or long ones are dropped.

    Rows are stored without padding; ``pad_examples`` adds it on export.
    """
    rows = fit_length(_rendered_ids(first_exchange(turns), vocab), length, "drop")
    mask = mask_with_end(F.col("ids"), F.col("generated"), _end_id(vocab))
    return rows.withColumn("mask", mask).select(
        "conv_id", "ids", labels_from_mask(F.col("ids"), F.col("mask")).alias("labels")
    )


def pad_examples(df: DataFrame, length: int, pad_id: int = PAD_ID) -> DataFrame:
    """``ids``/``labels`` -> fixed-length ``input_ids``, ``attention_mask``, ``labels``."""
    keep = [c for c in df.columns if c not in ("ids", "labels")]
    return df.select(
        *keep,
        padded(F.col("ids"), length, pad_id).alias("input_ids"),
        attention(F.col("ids"), length).alias("attention_mask"),
        padded(F.col("labels"), length, IGNORE_LABEL).alias("labels"),
    )


SIDES = ("chosen", "rejected")


def preference_examples(
    pairs: DataFrame, vocab: DataFrame | OutsideTokenizer, key: str = "conv_id", length: int = PREFERENCE_LENGTH
) -> DataFrame:
    """``(key, chosen, rejected)`` message arrays -> ids and masks of both sides.

    A pair is dropped if a side does not have two messages or is too long.
    """
    rows = valid_preferences(pairs).select(key, *SIDES)
    for side in SIDES:
        keep = [c for c in rows.columns if c != side]
        rows = encode(render_chat(rows, messages=side).drop("text"), vocab)
        rows = fit_length(rows, length, "drop").select(
            *keep,
            F.col("ids").alias(f"{side}_ids"),
            mask_with_end(F.col("ids"), F.col("generated"), _end_id(vocab)).alias(f"{side}_mask"),
        )
    return rows


def pad_preferences(df: DataFrame, length: int = PREFERENCE_LENGTH, pad_id: int = PAD_ID) -> DataFrame:
    keep = [c for c in df.columns if not c.endswith(("_ids", "_mask"))]
    arrays = []
    for side in SIDES:
        ids = F.col(f"{side}_ids")
        arrays += [
            padded(ids, length, pad_id).alias(f"{side}_input_ids"),
            attention(ids, length).alias(f"{side}_attention_mask"),
            padded(F.col(f"{side}_mask"), length, 0).alias(f"{side}_assistant_masks"),
        ]
    return df.select(*keep, *arrays)


def revision_examples(
    exchanges: DataFrame, vocab: DataFrame | OutsideTokenizer, key: str = "pos", length: int = REVISION_LENGTH
) -> DataFrame:
    """``(key, prompt, completion[, valid])`` -> truncated token rows.

    Nothing is dropped: an invalid exchange, or one whose reply was cut off as a
    whole, gives an empty row (``valid = false``) that still takes its batch slot.
    """
    if "valid" not in exchanges.columns:
        exchanges = exchanges.withColumn("valid", F.lit(True))
    rows = fit_length(
        _rendered_ids(exchanges.select(key, "valid", "prompt", "completion"), vocab),
        length,
        "truncate",
    )
    rows = rows.withColumn(
        "valid",
        F.col("valid") & F.coalesce(F.array_contains("generated", 1), F.lit(False)),
    ).withColumn("mask", mask_with_end(F.col("ids"), F.col("generated"), _end_id(vocab)))
    none = ints(F.array())
    return rows.select(
        key,
        "valid",
        F.when(F.col("valid"), F.col("ids")).otherwise(none).alias("ids"),
        F.when(F.col("valid"), labels_from_mask(F.col("ids"), F.col("mask")))
        .otherwise(none)
        .alias("labels"),
    )


def truncate_prompts(
    df: DataFrame, prompt: str = "prompt", limit: int = REQUEST_PROMPT_TOKENS
) -> DataFrame:
    """Cut prompts to their first ``limit`` tokens; shorter ones stay as they are."""
    return df.withColumn(prompt, truncate_to_tokens(F.col(prompt), limit))
