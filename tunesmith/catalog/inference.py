"""Bindings for bulk generation and batch-inference files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith import fixed_values as V
from tunesmith.catalog.registry import TOKENS, Entry, registrar, table
from tunesmith.functions.text import clean_completion
from tunesmith.operators.inference import (
    batch_requests,
    batch_responses,
    reply_issues,
    write_requests,
)
from tunesmith.operators.position import with_position
from tunesmith.session import new_folder

ENTRIES: dict[str, Entry] = {}
register = registrar(ENTRIES)


@register("SELECT doc_id, text AS completion FROM documents")
def gn2_clean_completion(spark, sf):
    raw = F.concat(F.lit(V.PAD), "text", F.lit(V.END), "lang", F.lit(V.END))
    return table(spark, sf, "documents").select("doc_id", clean_completion(raw).alias("completion"))


_REQUEST = (
    "custom_id STRING, method STRING, url STRING, body STRUCT<model: STRING, messages: "
    "ARRAY<STRUCT<role: STRING, content: STRING>>, max_tokens: INT, temperature: DOUBLE, "
    "stop: ARRAY<STRING>, frequency_penalty: DOUBLE, presence_penalty: DOUBLE>"
)


@register(
    rf"""WITH p AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, text,
                    regexp_extract_all(text, '\s*(?:{TOKENS})') AS l FROM documents)
        SELECT 'request-' || pos AS custom_id, 'POST' AS method, '/v1/chat/completions' AS url,
          '{V.REQUEST_MODEL}' AS model, 'You are a helpful assistant.' AS system_text,
          CASE WHEN len(l) <= 600 THEN text ELSE array_to_string(l[1:600], '') END AS user_text,
          512 AS max_tokens, 0.0::DOUBLE AS temperature, '<|im_end|>' AS stop,
          1.5::DOUBLE AS frequency_penalty, 0.0::DOUBLE AS presence_penalty FROM p"""
)
def gn4_batch_requests(spark, sf):
    """Request lines are written, read back, and taken apart again."""
    placed = with_position(table(spark, sf, "documents"), "doc_id")
    path = new_folder(spark, "requests")
    write_requests(batch_requests(placed, prompt="text"), path)
    body = F.col("body")
    return spark.read.schema(_REQUEST).json(path).select(
        "custom_id",
        "method",
        "url",
        body["model"].alias("model"),
        body["messages"][0]["content"].alias("system_text"),
        body["messages"][1]["content"].alias("user_text"),
        body["max_tokens"].alias("max_tokens"),
        body["temperature"].alias("temperature"),
        F.array_join(body["stop"], ",").alias("stop"),
        body["frequency_penalty"].alias("frequency_penalty"),
        body["presence_penalty"].alias("presence_penalty"),
    )


def _replies(spark, sf):
    """Reply lines per document: German ones are missing, French ones come twice
    (the second counts), and those of source ``src3`` hold no message."""
    placed = with_position(table(spark, sf, "documents"), "doc_id")
    message = lambda text: F.array(
        F.struct(F.struct(F.lit("assistant").alias("role"), text.alias("content")).alias("message"))
    )
    choices = F.when(F.col("source") != "src3", message(F.concat("lang", F.lit(" "), "text", F.col("again"))))
    lines = (
        placed.where("lang <> 'de'")
        .withColumn(
            "again",
            F.explode(
                F.when(F.col("lang") == "fr", F.array(F.lit(" 1"), F.lit(" 2"))).otherwise(
                    F.array(F.lit(" 1"))
                )
            ),
        )
        .select(
            F.struct("pos", "again").alias("line"),
            F.to_json(
                F.struct(
                    F.concat(F.lit("request-"), F.col("pos").cast("string")).alias("custom_id"),
                    F.struct(F.struct(choices.alias("choices")).alias("body")).alias("response"),
                )
            ).alias("value"),
        )
    )
    return placed, lines


_PLACED = "p AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)"


@register(
    f"""WITH {_PLACED} SELECT 'request-' || pos AS custom_id,
          lang || ' ' || text || CASE WHEN lang = 'fr' THEN ' 2' ELSE ' 1' END AS content
        FROM p WHERE lang <> 'de' AND source <> 'src3'"""
)
def gn5_batch_responses(spark, sf):
    return batch_responses(_replies(spark, sf)[1])


@register(
    f"""WITH {_PLACED}
        SELECT 'missing' AS issue, 'request-' || pos AS custom_id, 1::BIGINT AS n FROM p
          WHERE lang = 'de' OR source = 'src3'
        UNION ALL SELECT 'repeated', 'request-' || pos, 2 FROM p WHERE lang = 'fr' AND source <> 'src3'
        UNION ALL SELECT 'unreadable', 'request-' || pos, CASE WHEN lang = 'fr' THEN 2 ELSE 1 END
          FROM p WHERE lang <> 'de' AND source = 'src3'"""
)
def gn5_reply_issues(spark, sf):
    return reply_issues(*_replies(spark, sf))
