"""Bindings for sources, alignment, and category assignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith import fixed_values as V
from tunesmith.catalog.registry import WORDS, Entry, exchange_cte, registrar, table
from tunesmith.operators.align import (
    attach_criteria,
    fill_completions,
    missing_categories,
    missing_completions,
    rejoin_responses,
    unmatched,
    zip_join,
)
from tunesmith.operators.chat import first_exchange
from tunesmith.operators.criteria import (
    assign_nearest,
    centroids,
    criteria_dataset,
    embed_tfidf,
    revision_dataset,
    revision_prompts,
)
from tunesmith.functions.text import revision_prompt
from tunesmith.operators.inference import PROFILES
from tunesmith.operators.position import with_position
from tunesmith.session import new_folder, store
from tunesmith.sources import (
    append_metrics,
    append_shards,
    read_completions,
    read_corpus,
    read_prompts,
    read_records,
    write_json_arrays,
    write_records,
)

ENTRIES: dict[str, Entry] = {}
register = registrar(ENTRIES)


# --- sources and sinks: written by Spark, read back through the readers ---------------


@register("SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, text AS prompt FROM documents")
def io1_read_prompts(spark, sf):
    path = new_folder(spark, "prompts")
    ordered = table(spark, sf, "documents").orderBy("doc_id")
    write_records(ordered.select(F.col("text").alias("prompt")), path)
    return read_prompts(spark, path)


def _document_records(spark, sf):
    docs = with_position(table(spark, sf, "documents"), "doc_id")
    return docs.select("pos", F.col("text").alias("x"), F.col("lang").alias("y"), F.col("source").alias("c"))


@register(
    "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, text AS x, lang AS y, source AS c"
    " FROM documents"
)
def io2_read_records(spark, sf):
    path = new_folder(spark, "records")
    write_json_arrays(_document_records(spark, sf), path)
    return read_records(spark, f"{path}/*")


@register(
    "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, lang AS prompt, text AS completion"
    " FROM documents"
)
def io3_read_completions_objects(spark, sf):
    path = new_folder(spark, "completions")
    rows = _document_records(spark, sf).select(
        "pos", F.col("y").alias("prompt"), F.col("x").alias("completion")
    )
    write_json_arrays(rows, path)
    return read_completions(spark, f"{path}/*")


@register("SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, text AS completion FROM documents")
def io3_read_completions_strings(spark, sf):
    path = new_folder(spark, "completions")
    write_json_arrays(_document_records(spark, sf).select("pos", F.col("x").alias("value")), path)
    return read_completions(spark, f"{path}/*").select("pos", "completion")


@register(
    """SELECT row_number() OVER (ORDER BY shard, id) - 1 AS pos, completion FROM (
         SELECT 0 AS shard, doc_id AS id, text AS completion FROM documents
         UNION ALL SELECT 1, item_id, text FROM benchmark)"""
)
def io4_append_shards(spark, sf):
    first = with_position(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    second = with_position(table(spark, sf, "benchmark"), "item_id")
    shape = lambda d: d.select("pos", F.col("text").alias("completion"))
    return append_shards([shape(first), None, shape(second)])


@register("SELECT doc_id, text FROM documents WHERE lang = 'en' AND source = 'src1'")
def io5_read_corpus(spark, sf):
    path = new_folder(spark, "corpus")
    docs = table(spark, sf, "documents").select(
        "doc_id",
        "text",
        F.lit("docs").alias("name"),
        F.col("lang").alias("split"),
        F.col("source").alias("revision"),
    )
    docs.write.partitionBy("name", "split", "revision").parquet(path)
    return read_corpus(spark, path, "docs", "en", "src1")


@register("SELECT lang AS split, doc_id, text AS completion FROM documents")
def io6_write_records(spark, sf):
    path = new_folder(spark, "responses")
    rows = table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("completion"), F.col("lang").alias("split")
    )
    write_records(rows, path, split="split")
    return spark.read.schema("doc_id BIGINT, completion STRING, split STRING").json(path)


@register(
    """SELECT event_type AS tag, count(*) AS n, round(sum(value), 4) AS total,
              max(event_id) AS last_step FROM events GROUP BY event_type"""
)
def io7_append_metrics(spark, sf):
    path = new_folder(spark, "metrics")
    points = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("tag"),
        F.col("event_id").alias("step"),
        "value",
        F.col("ts").cast("timestamp").alias("ts"),
    )
    append_metrics(points.where(F.col("value") < 50), path)
    append_metrics(points.where(F.col("value") >= 50), path)
    return (
        spark.read.parquet(path)
        .groupBy("tag")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum("value"), 4).alias("total"),
            F.max("step").alias("last_step"),
        )
    )


# --- alignment ---------------------------------------------------------------------


def _placed(spark, sf, name, key):
    return with_position(table(spark, sf, name), key)


_PLACED = """
    d AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, doc_id, text FROM documents),
    l AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, quality FROM labels),
    e AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS pos, label FROM embeddings)"""


@register(f"WITH {_PLACED} SELECT d.pos, text, quality, label FROM d JOIN l USING (pos) JOIN e USING (pos)")
def jn1_zip_join(spark, sf):
    return zip_join(
        _placed(spark, sf, "documents", "doc_id").select("pos", "text"),
        _placed(spark, sf, "labels", "doc_id").select("pos", "quality"),
        _placed(spark, sf, "embeddings", "vec_id").select("pos", "label"),
    )


@register(
    f"""WITH {_PLACED} SELECT pos, 'left' AS side FROM d WHERE pos NOT IN (SELECT pos FROM l)
        UNION ALL SELECT pos, 'right' FROM l WHERE pos NOT IN (SELECT pos FROM d)"""
)
def jn1_unmatched(spark, sf):
    return unmatched(
        _placed(spark, sf, "documents", "doc_id"), _placed(spark, sf, "labels", "doc_id")
    )


def _criteria(spark, sf):
    """One criterion per label, derived from the labels in use."""
    return (
        table(spark, sf, "embeddings")
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("label").alias("ord"),
            F.concat(F.lit("category "), F.col("label").cast("string")).alias("category"),
            F.concat(F.lit("criterion "), F.col("label").cast("string")).alias("criterion"),
        )
    )


@register(
    """SELECT vec_id, 'category ' || label AS category, 'criterion ' || label AS criterion
       FROM embeddings"""
)
def jn2_attach_criteria(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        "vec_id", F.concat(F.lit("category "), F.col("label").cast("string")).alias("category")
    )
    return attach_criteria(rows, _criteria(spark, sf).select("category", "criterion"))


@register(
    """SELECT source AS category, count(*) AS n FROM documents
       WHERE source NOT IN (SELECT source FROM documents WHERE lang = 'en' AND source <> 'src1')
       GROUP BY source"""
)
def jn2_missing_categories(spark, sf):
    docs = table(spark, sf, "documents")
    known = docs.where("lang = 'en' AND source <> 'src1'").select(F.col("source").alias("category"))
    return missing_categories(docs.withColumnRenamed("source", "category"), known.distinct())


@register("SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, lang, text AS content FROM documents")
def jn3_rejoin_responses(spark, sf):
    placed = _placed(spark, sf, "documents", "doc_id")
    replies = placed.select(
        F.concat(F.lit("request-"), F.col("pos").cast("string")).alias("custom_id"),
        F.col("text").alias("content"),
    )
    return rejoin_responses(placed.select("pos", "lang"), replies).select("pos", "lang", "content")


def _cache_parts(spark, sf):
    """Documents as prompts; the labelled ones are in the cache already."""
    key = PROFILES["eval_sft"].key
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("prompt_id"),
        F.lit("base").alias("model_id"),
        F.lit(key).alias("decode_hash"),
        F.col("text").alias("prompt"),
    )
    cache = table(spark, sf, "labels").select(
        F.col("doc_id").alias("prompt_id"),
        F.lit("base").alias("model_id"),
        F.lit(key).alias("decode_hash"),
        F.concat(F.lit("cached "), F.col("quality").cast("string")).alias("completion"),
    )
    return docs, cache


@register(
    """SELECT doc_id AS prompt_id, text AS prompt FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""
)
def jn4_missing_completions(spark, sf):
    docs, cache = _cache_parts(spark, sf)
    return missing_completions(docs, cache).select("prompt_id", "prompt")


@register(
    """SELECT d.doc_id AS prompt_id, coalesce('cached ' || l.quality, 'fresh ' || d.lang) AS completion
       FROM documents d LEFT JOIN labels l USING (doc_id)"""
)
def jn4_fill_completions(spark, sf):
    docs, cache = _cache_parts(spark, sf)
    langs = table(spark, sf, "documents").select(F.col("doc_id").alias("prompt_id"), "lang")
    fresh = (
        missing_completions(docs, cache)
        .join(langs, "prompt_id")
        .withColumn("completion", F.concat(F.lit("fresh "), "lang"))
    )
    return fill_completions(docs, cache, fresh).select("prompt_id", "completion")


# --- categories and criteria ----------------------------------------------------------


def _exemplars(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("label").alias("ord"),
        F.concat(F.lit("category "), F.col("label").cast("string")).alias("category"),
        "embedding",
    )


_CENTROIDS = """
    parts AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i
              FROM embeddings),
    means AS (SELECT label, i, avg(v) AS v FROM parts GROUP BY label, i),
    cents AS (SELECT label, list(v ORDER BY i) AS vec FROM means GROUP BY label)"""

_NEAREST = f"""{_CENTROIDS},
    sims AS (SELECT e.vec_id, c.label,
                    round(list_cosine_similarity(e.embedding::DOUBLE[], c.vec), 6) AS sim,
                    list_cosine_similarity(e.embedding::DOUBLE[], c.vec) AS raw
             FROM embeddings e, cents c),
    best AS (SELECT vec_id, label, sim FROM sims
             QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY raw DESC, label) = 1)"""


@register(
    f"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORDS}')) AS w FROM documents),
        c AS (SELECT doc_id, (('0x' || substr(md5(w), 1, 8))::BIGINT % 256)::INT AS i, count(*) AS n FROM w GROUP BY ALL),
        f AS (SELECT i, count(*) AS docs FROM c GROUP BY i),
        x AS (SELECT doc_id, i, n * ln(((SELECT count(*) FROM documents) + 1.0) / (docs + 1.0)) AS x FROM c JOIN f USING (i))
        SELECT doc_id, i, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS v FROM x WHERE x <> 0"""
)
def ct0_embed_tfidf(spark, sf):
    vectors = embed_tfidf(table(spark, sf, "documents").select("doc_id", "text"))
    entries = vectors.select("doc_id", F.posexplode("embedding").alias("i", "v")).where("v <> 0")
    return entries.select("doc_id", "i", F.round("v", 6).alias("v"))


@register(
    f"WITH {_CENTROIDS} SELECT label AS ord, (i - 1)::INT AS i, round(v, 6) AS v FROM means"
)
def ct1_centroids(spark, sf):
    return centroids(_exemplars(spark, sf)).select("ord", F.posexplode("vec").alias("i", "v")).select(
        "ord", "i", F.round("v", 6).alias("v")
    )


@register(
    f"WITH {_NEAREST} SELECT vec_id, 'category ' || label AS category, sim AS similarity FROM best"
)
def ct2_assign_nearest(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return assign_nearest(rows, centroids(_exemplars(spark, sf))).select(
        "vec_id", "category", F.round("similarity", 6).alias("similarity")
    )


@register(
    f"""WITH {_NEAREST} SELECT vec_id AS pos, 'prompt ' || vec_id AS x, '' AS y,
        'criterion ' || label AS c FROM best"""
)
def ct3_criteria_dataset(spark, sf):
    prompts = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("pos"),
        F.concat(F.lit("prompt "), F.col("vec_id").cast("string")).alias("prompt"),
        "embedding",
    )
    return criteria_dataset(prompts, centroids(_exemplars(spark, sf)), _criteria(spark, sf))


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def revision_sql(x: str, c: str, r_0: str) -> str:
    a, b, d, e = (sql_text(p) for p in V.REVISION_PIECES)
    return f"{a} || {x} || {b} || {r_0} || {d} || {c} || {e}"


@register(f"SELECT doc_id, {revision_sql('text', 'lang', 'source')} AS prompt FROM documents")
def ct4_revision_prompt(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        revision_prompt(F.col("text"), F.col("lang"), F.col("source")).alias("prompt"),
    )


def revision_inputs(spark, sf):
    """Records, first replies and revisions, numbered by conversation."""
    turns = table(spark, sf, "conversations")
    placed = with_position(turns.select("conv_id").distinct(), "conv_id")
    last = (
        turns.where("role = 'assistant'")
        .groupBy("conv_id")
        .agg(F.max_by("text", "turn").alias("revision"))
    )
    rows = store(
        placed.join(first_exchange(turns), "conv_id").join(last, "conv_id"), "revision-inputs"
    )
    return (
        rows.select("pos", F.col("prompt").alias("x"), F.lit("be brief").alias("c")),
        rows.select("pos", "completion"),
        rows.select("pos", F.col("revision").alias("completion")),
    )


REVISION_CTE = f"""
    {exchange_cte()},
    placed AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS pos
               FROM (SELECT DISTINCT conv_id FROM conversations)),
    last_reply AS (SELECT conv_id, arg_max(text, turn) AS revision FROM conversations
                   WHERE role = 'assistant' GROUP BY conv_id),
    revs AS (SELECT pos, {revision_sql('prompt', sql_text('be brief'), 'completion')} AS prompt,
                    revision AS completion
             FROM fx JOIN placed USING (conv_id) JOIN last_reply USING (conv_id))"""


@register(f"WITH {REVISION_CTE} SELECT pos, prompt FROM revs")
def ct5_revision_prompts(spark, sf):
    records, replies, _ = revision_inputs(spark, sf)
    return revision_prompts(records, replies)


@register(f"WITH {REVISION_CTE} SELECT pos, prompt, completion FROM revs")
def ct6_revision_dataset(spark, sf):
    return revision_dataset(*revision_inputs(spark, sf)).select("pos", "prompt", "completion")
