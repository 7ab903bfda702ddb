"""Shaping conversations.

The storage model is the long form ``(conv_id, turn, role, text)`` with a unique
``(conv_id, turn)``; messages are nested only on output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.fixed_values import (
    DEFAULT_SYSTEM,
    END,
    IMAGE_PAD,
    START,
    VIDEO_PAD,
    VISION_END,
    VISION_START,
)
from tunesmith.functions.text import text_or_none_word


# --- nesting ---------------------------------------------------------------


def nest_messages(turns: DataFrame) -> DataFrame:
    """Long form -> ``(conv_id, messages)`` in turn order, one row per conversation.

    A message is ``(role, content, turn)``.  Nesting is for output: operators that need
    no whole conversation in one value work on the long form.
    """
    return (
        turns.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
        .select(
            "conv_id",
            F.transform(
                "m",
                lambda x: F.struct(
                    x["role"].alias("role"), x["text"].alias("content"), x["turn"].alias("turn")
                ),
            ).alias("messages"),
        )
    )


def unnest_messages(df: DataFrame) -> DataFrame:
    """The inverse: ``(conv_id, turn, role, text)`` with the turns as they were."""
    return df.select("conv_id", F.explode("messages").alias("m")).select(
        "conv_id", F.col("m.turn").alias("turn"), F.col("m.role").alias("role"), F.col("m.content").alias("text")
    )


# --- picking turns -----------------------------------------------------------


def first_user_prompt(turns: DataFrame, keep_missing: bool = True) -> DataFrame:
    """``(conv_id, prompt)``: text of the first user turn, null if there is none."""
    is_user = F.col("role") == "user"
    if not keep_missing:
        turns = turns.where(is_user)
    slim = turns.select(
        "conv_id",
        F.when(is_user, F.col("turn")).alias("turn"),
        F.when(is_user, F.col("text")).alias("text"),
    )
    return slim.groupBy("conv_id").agg(F.min_by("text", "turn").alias("prompt"))


def first_exchange(turns: DataFrame, on_invalid: str = "drop") -> DataFrame:
    """First user turn and the first assistant turn behind it.

    Gives ``(conv_id, prompt, completion)``; system turns and later users are
    skipped.  ``on_invalid='drop'`` leaves out conversations without such a pair,
    ``'flag'`` keeps them with ``valid = false`` and null texts.

    Which turns are wanted is found on ids, turn numbers and roles alone: one aggregate
    for the first user turn, one for the first assistant turn behind it.  Texts are then
    fetched by ``(conv_id, turn)``, a key without hot values, at most two per conversation.
    """
    if on_invalid not in ("drop", "flag"):
        raise ValueError(f"on_invalid: {on_invalid}")
    narrow = turns.select("conv_id", "turn", "role")
    starts = narrow.groupBy("conv_id").agg(F.min(F.when(F.col("role") == "user", F.col("turn"))).alias("u"))
    replies = (
        narrow.where("role = 'assistant'")
        .join(starts.where("u IS NOT NULL"), "conv_id")
        .where("turn > u")
        .groupBy("conv_id")
        .agg(F.min("u").alias("u"), F.min("turn").alias("a"))
    )
    side = lambda turn, first: F.struct(F.col(turn).alias("turn"), F.lit(first).alias("first"))
    wanted = replies.select("conv_id", F.explode(F.array(side("u", True), side("a", False))).alias("w"))
    texts = turns.select("conv_id", "turn", "text").join(
        wanted.select("conv_id", "w.turn", "w.first"), ["conv_id", "turn"]
    )
    both = texts.groupBy("conv_id").agg(F.collect_list(F.struct("first", "text")).alias("t"))
    text = lambda first: F.filter("t", lambda x: x["first"] == F.lit(first))[0]["text"]
    pairs = both.select("conv_id", text(True).alias("prompt"), text(False).alias("completion"))
    if on_invalid == "drop":
        return pairs
    found = pairs.withColumn("valid", F.lit(True))
    flagged = starts.select("conv_id").join(found, "conv_id", "left")
    return flagged.select("conv_id", "prompt", "completion", F.coalesce("valid", F.lit(False)).alias("valid"))


# --- two-message conversations -------------------------------------------------


def exchange(prompt: Column, completion: Column) -> Column:
    """User and assistant message as an ``ARRAY<STRUCT<role, content>>`` column."""
    message = lambda role, text: F.struct(
        F.lit(role).alias("role"), text.alias("content")
    )
    return F.array(message("user", prompt), message("assistant", completion))


def to_exchange(records: DataFrame) -> DataFrame:
    """``(pos, x, y)`` -> ``(pos, messages)``; a null becomes the word ``None``."""
    return records.select(
        "pos",
        exchange(text_or_none_word(F.col("x")), text_or_none_word(F.col("y"))).alias("messages"),
    )


def zip_exchange(prompts: DataFrame, completions: DataFrame) -> DataFrame:
    """Aligned ``(pos, prompt)`` and ``(pos, completion)`` -> ``(pos, messages)``.

    Cut to the shorter side; texts are taken as they are.
    """
    return prompts.join(completions, "pos").select(
        "pos", exchange(F.col("prompt"), F.col("completion")).alias("messages")
    )


def extract_prompts(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Add ``prompt``: the content of message 0, as it is."""
    return df.withColumn("prompt", F.try_element_at(messages, F.lit(1))["content"])


def valid_preferences(df: DataFrame) -> DataFrame:
    """Rows whose ``chosen`` and ``rejected`` both have two messages."""
    return df.where((F.size("chosen") == 2) & (F.size("rejected") == 2))


# --- rendering -----------------------------------------------------------------


def _segment(text: Column, generated: Column | None = None) -> Column:
    flag = F.lit(False) if generated is None else generated
    return F.struct(text.alias("text"), flag.alias("generated"))


def _default_system() -> Column:
    return F.array(_segment(F.lit(f"{START}system\n{DEFAULT_SYSTEM}{END}\n")))


def _no_segments() -> Column:
    return F.array().cast("array<struct<text:string,generated:boolean>>")


def _one_text(message: Column, body: Column) -> Column:
    return F.flatten(
        F.array(
            F.array(_segment(F.concat(F.lit(START), message["role"], F.lit("\n")))),
            body,
            F.array(_segment(F.lit(f"{END}\n"))),
        )
    )


def _is_kind(part: Column, *kinds: str) -> Column:
    return part["kind"].isin(*kinds)


def _part_segments(parts: Column, add_vision_id: bool) -> Column:
    """Segments of the numbered parts of a whole conversation, still one per part."""

    def numbered(kinds: tuple[str, ...]) -> Column:
        return F.filter(
            F.transform(parts, lambda p, i: F.when(_is_kind(p, *kinds), i)),
            lambda i: i.isNotNull(),
        )

    def pad(label: str, token: str, nth: Column) -> Column:
        body = F.lit(f"{VISION_START}{token}{VISION_END}")
        if not add_vision_id:
            return body
        return F.concat(F.lit(f"{label} "), nth.cast("string"), F.lit(": "), body)

    images, videos = numbered(("image", "image_url")), numbered(("video",))
    return F.transform(
        parts,
        lambda p, i: F.when(
            _is_kind(p, "image", "image_url"),
            _segment(pad("Picture", IMAGE_PAD, F.array_position(images, i))),
        )
        .when(_is_kind(p, "video"), _segment(pad("Video", VIDEO_PAD, F.array_position(videos, i))))
        .otherwise(_segment(F.coalesce(p["text"], F.lit("")), p["role"] == "assistant")),
    )


def render_chat(
    df: DataFrame,
    messages: str = "messages",
    add_generation_prompt: bool = False,
    add_vision_id: bool = False,
) -> DataFrame:
    """Add ``segments ARRAY<STRUCT<text, generated>>`` and ``text``.

    A message has a ``content`` string or ``parts ARRAY<STRUCT<kind, text>>``.
    Assistant content is flagged as generated, its end token is not.  A missing system
    turn is filled in.
    """
    cols = df.columns
    fields = df.schema[messages].dataType.elementType.fieldNames()
    m = F.col(messages)
    if "parts" in fields:
        text_part = lambda x: F.array(
            F.struct(F.lit("text").alias("kind"), x["content"].alias("text"))
        )
        of = (
            (lambda x: F.coalesce(x["parts"], text_part(x)))
            if "content" in fields
            else (lambda x: x["parts"])
        )
        flat = F.flatten(
            F.transform(
                m,
                lambda x, n: F.transform(
                    of(x),
                    lambda p: F.struct(
                        n.alias("n"),
                        x["role"].alias("role"),
                        p["kind"].alias("kind"),
                        p["text"].alias("text"),
                    ),
                ),
            )
        )
        df = df.withColumn("_parts", flat)
        df = df.withColumn(
            "_parts",
            F.arrays_zip(
                F.col("_parts").alias("p"),
                _part_segments(F.col("_parts"), add_vision_id).alias("s"),
            ),
        )
        body = lambda x, n: F.transform(
            F.filter("_parts", lambda q: q["p"]["n"] == n), lambda q: q["s"]
        )
    else:
        body = lambda x, n: F.array(
            _segment(x["content"], x["role"] == "assistant")
        )
    turns = F.flatten(F.transform(m, lambda x, n: _one_text(x, body(x, n))))
    first_role = F.try_element_at(m, F.lit(1))["role"]
    lead = F.when(first_role != "system", _default_system()).otherwise(_no_segments())
    pieces = [lead, turns]
    if add_generation_prompt:
        pieces.append(F.array(_segment(F.lit(f"{START}assistant\n"))))
    return df.withColumn("segments", F.concat(*pieces)).select(
        *cols, "segments", F.array_join(F.col("segments.text"), "").alias("text")
    )


def render_turns(turns: DataFrame, **options) -> DataFrame:
    """Render a corpus in long form -> ``(conv_id, segments, text)``."""
    return render_chat(nest_messages(turns), **options).select("conv_id", "segments", "text")


def render_each_turn(turns: DataFrame) -> DataFrame:
    """Render turn by turn -> ``(conv_id, turn, segments, text)``, without nesting.

    The text of a conversation is the concatenation in turn order.  For conversations
    of any length: only ids and turn numbers are aggregated.
    """
    opening = turns.groupBy("conv_id").agg(F.min("turn").alias("opens"))
    fill = (F.col("turn") == F.col("opens")) & (F.col("role") != "system")
    lead = F.when(fill, _default_system()).otherwise(_no_segments())
    message = F.struct("role", F.col("text").alias("content"))
    body = F.array(_segment(F.col("text"), F.col("role") == "assistant"))
    rows = turns.join(opening, "conv_id").withColumn("segments", F.concat(lead, _one_text(message, body)))
    return rows.select("conv_id", "turn", "segments", F.array_join(F.col("segments.text"), "").alias("text"))
