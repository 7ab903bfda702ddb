"""Bindings for conversation shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith.catalog.registry import Entry, exchange_cte, registrar, table
from tunesmith.operators.chat import (
    exchange,
    extract_prompts,
    first_exchange,
    first_user_prompt,
    nest_messages,
    render_chat,
    render_turns,
    to_exchange,
    unnest_messages,
    valid_preferences,
    zip_exchange,
)
from tunesmith.operators.position import with_position

ENTRIES: dict[str, Entry] = {}
register = registrar(ENTRIES)


def _messages_text():
    return F.array_join(
        F.transform("messages", lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|"
    )


@register(
    """SELECT conv_id, count(*) AS n, string_agg(role || '=' || text, '|' ORDER BY turn) AS messages
       FROM conversations GROUP BY conv_id"""
)
def cv1_nest_messages(spark, sf):
    nested = nest_messages(table(spark, sf, "conversations"))
    return nested.select(
        "conv_id", F.size("messages").cast("bigint").alias("n"), _messages_text().alias("messages")
    )


@register("SELECT conv_id, turn, role, text FROM conversations")
def cv1_unnest_messages(spark, sf):
    return unnest_messages(nest_messages(table(spark, sf, "conversations")))


@register(
    """SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS prompt
       FROM conversations GROUP BY conv_id"""
)
def cv2_first_user_prompt(spark, sf):
    return first_user_prompt(table(spark, sf, "conversations"))


@register(f"WITH {exchange_cte()} SELECT conv_id, prompt, completion FROM fx")
def cv3_first_exchange(spark, sf):
    return first_exchange(table(spark, sf, "conversations"))


@register(
    f"""WITH {exchange_cte()} SELECT c.conv_id, prompt, completion, prompt IS NOT NULL AS valid
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN fx USING (conv_id)"""
)
def cv3_first_exchange_flagged(spark, sf):
    return first_exchange(table(spark, sf, "conversations"), "flag")


_SWAPPED = """swapped AS (SELECT conv_id, turn, text,
    CASE role WHEN 'user' THEN 'assistant' WHEN 'assistant' THEN 'user' ELSE role END AS role
    FROM conversations)"""


@register(f"WITH {_SWAPPED}, {exchange_cte('swapped')} SELECT conv_id, prompt, completion FROM fx")
def cv3_first_exchange_assistant_first(spark, sf):
    """The same corpus with the roles swapped: every conversation opens with an assistant."""
    role = F.col("role")
    turns = table(spark, sf, "conversations").withColumn(
        "role",
        F.when(role == "user", "assistant").when(role == "assistant", "user").otherwise(role),
    )
    return first_exchange(turns)


@register(
    """SELECT row_number() OVER (ORDER BY d.doc_id) - 1 AS pos, d.text AS user_text,
              coalesce(l.quality::VARCHAR, 'None') AS assistant_text
       FROM documents d LEFT JOIN labels l USING (doc_id)"""
)
def cv4_to_exchange(spark, sf):
    """Unlabelled documents have a null ``y``, which becomes the word ``None``."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("x"))
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    rows = to_exchange(with_position(docs.join(labels, "doc_id", "left"), "doc_id"))
    return rows.select(
        "pos",
        F.col("messages")[0]["content"].alias("user_text"),
        F.col("messages")[1]["content"].alias("assistant_text"),
    )


@register(
    """SELECT pos, d.text AS user_text, b.text AS assistant_text
       FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, text FROM documents) d
       JOIN (SELECT row_number() OVER (ORDER BY item_id) - 1 AS pos, text FROM benchmark) b USING (pos)"""
)
def cv4_zip_exchange(spark, sf):
    docs = with_position(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    items = with_position(table(spark, sf, "benchmark"), "item_id")
    rows = zip_exchange(
        docs.select("pos", F.col("text").alias("prompt")),
        items.select("pos", F.col("text").alias("completion")),
    )
    return rows.select(
        "pos",
        F.col("messages")[0]["content"].alias("user_text"),
        F.col("messages")[1]["content"].alias("assistant_text"),
    )


@register("SELECT conv_id, arg_min(text, turn) AS prompt FROM conversations GROUP BY conv_id")
def cv5_extract_prompts(spark, sf):
    return extract_prompts(nest_messages(table(spark, sf, "conversations"))).select("conv_id", "prompt")


def preference_pairs(spark, sf):
    """First user turn with the first (chosen) and the last (rejected) assistant turn.

    Where both are the same turn the rejected side has one message only.
    """
    turns = table(spark, sf, "conversations")
    last = (
        turns.where("role = 'assistant'")
        .groupBy("conv_id")
        .agg(F.max_by("text", "turn").alias("last_text"))
    )
    rows = first_exchange(turns).join(last, "conv_id")
    one = F.slice(exchange(F.col("prompt"), F.lit("")), 1, 1)
    return rows.select(
        "conv_id",
        exchange(F.col("prompt"), F.col("completion")).alias("chosen"),
        F.when(
            F.col("last_text") != F.col("completion"), exchange(F.col("prompt"), F.col("last_text"))
        )
        .otherwise(one)
        .alias("rejected"),
    )


PAIRS_CTE = f"""
    {exchange_cte()},
    la AS (SELECT conv_id, arg_max(text, turn) AS last_text FROM conversations
           WHERE role = 'assistant' GROUP BY conv_id),
    pairs AS (SELECT conv_id, prompt, completion AS chosen, last_text AS rejected
              FROM fx JOIN la USING (conv_id) WHERE last_text <> completion)"""


@register(f"WITH {PAIRS_CTE} SELECT conv_id, prompt, chosen, rejected FROM pairs")
def cv6_valid_preferences(spark, sf):
    return valid_preferences(preference_pairs(spark, sf)).select(
        "conv_id",
        F.col("chosen")[0]["content"].alias("prompt"),
        F.col("chosen")[1]["content"].alias("chosen"),
        F.col("rejected")[1]["content"].alias("rejected"),
    )


_LEAD = "'<|im_start|>system' || chr(10) || 'You are a helpful assistant.<|im_end|>' || chr(10)"


@register(
    f"""SELECT conv_id,
          CASE WHEN arg_min(role, turn) <> 'system' THEN {_LEAD} ELSE '' END
          || string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                        ORDER BY turn)
          || '<|im_start|>assistant' || chr(10) AS text,
          coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS n_generated
        FROM conversations GROUP BY conv_id"""
)
def cv7_render_turns(spark, sf):
    rows = render_turns(table(spark, sf, "conversations"), add_generation_prompt=True)
    generated = F.aggregate(
        F.filter("segments", lambda s: s["generated"]),
        F.lit(0).cast("bigint"),
        lambda n, s: n + F.length(s["text"]),
    )
    return rows.select("conv_id", "text", generated.alias("n_generated"))


@register(
    """SELECT conv_id, string_agg(piece, '' ORDER BY turn) AS text FROM (
         SELECT conv_id, turn,
           CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id) AND role <> 'system'
                THEN '<|im_start|>system' || chr(10) || 'You are a helpful assistant.<|im_end|>' || chr(10)
                ELSE '' END
           || '<|im_start|>' || role || chr(10)
           || 'Picture ' || row_number() OVER (PARTITION BY conv_id ORDER BY turn)
           || ': <|vision_start|><|image_pad|><|vision_end|>' || text
           || 'Video ' || row_number() OVER (PARTITION BY conv_id ORDER BY turn)
           || ': <|vision_start|><|video_pad|><|vision_end|><|im_end|>' || chr(10) AS piece
         FROM conversations) GROUP BY conv_id"""
)
def cv7_render_chat_parts(spark, sf):
    """Every turn as an image, its text, and a video, with labels."""
    part = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    none = F.lit(None).cast("string")
    nested = nest_messages(table(spark, sf, "conversations")).withColumn(
        "messages",
        F.transform(
            "messages",
            lambda m: F.struct(
                m["role"].alias("role"),
                F.array(part("image", none), part("text", m["content"]), part("video", none)).alias(
                    "parts"
                ),
            ),
        ),
    )
    return render_chat(nested, add_vision_id=True).select("conv_id", "text")
