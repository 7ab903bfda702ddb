"""Bindings for positions, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith.catalog.registry import Entry, registrar, table
from tunesmith.operators.position import (
    head_n,
    range_split,
    seeded_prompts,
    seeded_sample,
    with_position,
    with_shuffled_position,
)

ENTRIES: dict[str, Entry] = {}
register = registrar(ENTRIES)


@register("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents")
def sel1_with_position(spark, sf):
    return with_position(table(spark, sf, "documents").select("doc_id"), "doc_id")


@register(
    "SELECT event_id, row_number() OVER (ORDER BY floor(value / 40), event_id) - 1 AS pos FROM events"
)
def sel1_with_position_repeated_order(spark, sf):
    """Few distinct order values: each of them is cut into several ranges."""
    rows = table(spark, sf, "events").select("event_id", F.floor(F.col("value") / 40).alias("level"))
    return with_position(rows, "event_id", "level").select("event_id", "pos")


@register(
    """SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS pos
       FROM events"""
)
def sel1_with_position_by_group(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return with_position(rows, "event_id", "ts", by=["event_type"]).select("event_id", "pos")


@register(
    """SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS pos
       FROM documents"""
)
def sel1_with_shuffled_position(spark, sf):
    return with_shuffled_position(table(spark, sf, "documents").select("doc_id"), "doc_id", 42)


_SPLIT_AT = 150


@register(
    f"""SELECT doc_id, pos, CASE WHEN pos < {_SPLIT_AT} THEN 'train' ELSE 'val' END AS split FROM (
          SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)"""
)
def sel2_range_split(spark, sf):
    placed = with_position(table(spark, sf, "documents").select("doc_id"), "doc_id")
    parts = range_split(placed, {"train": (0, _SPLIT_AT), "val": (_SPLIT_AT, None)})
    named = [p.withColumn("split", F.lit(n)) for n, p in parts.items()]
    return named[0].unionByName(named[1])


@register(
    """SELECT doc_id, pos FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos
       FROM documents) WHERE pos < 100"""
)
def sel3_head_n(spark, sf):
    return head_n(with_position(table(spark, sf, "documents").select("doc_id"), "doc_id"), 100)


@register("SELECT doc_id, text FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 100")
def sel4_seeded_sample(spark, sf):
    return seeded_sample(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", 100, 42)


@register(
    """SELECT doc_id, prompt FROM (
         SELECT doc_id, CASE WHEN lang = 'en' THEN text WHEN lang = 'fr' THEN '' END AS prompt
         FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 100)
       WHERE prompt IS NOT NULL AND prompt <> ''"""
)
def sel5_seeded_prompts(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "en", F.col("text"))
        .when(F.col("lang") == "fr", F.lit(""))
        .alias("prompt"),
    )
    return seeded_prompts(rows, "doc_id", 100, 42)
