"""The training-data operators bound to the tables, with the SQL that checks them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.llm import (
    decontaminate,
    jaccard,
    language,
    pages,
    periods,
    pieces,
    secrets,
    sentences,
    sharding,
    suffixes,
    toxicity,
    vectors,
    whitening,
)

#: Where the public tokenizer files are; a parameter of every function that reads one.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_report(table(spark, sf_dir, "pages"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.report(secrets.scanned(docs))


def op6_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentences.deduplicate(docs).drop("text").withColumnRenamed("clean", "text")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")))


def op8_sentencepiece(spark: SparkSession, sf_dir: str, model: str = TOKENIZER) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encoded(docs, pieces.load_model(model)).select("doc_id", "n_tokens", "ids", "round_trip")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text``), the words of one document in ten made periodic.

    With ``h`` the crc32 of the key, ``g`` a tenth of it and ``n`` words: from word
    ``g % n`` on, the words repeat the first ``1 + (n - g % n) // (3 + g % 8)`` of them.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.where((h % 10 == 0) & F.col("text").isNotNull())
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    # bound to lambda variables, so that the text is split once and not once a word
    some = chosen.select("doc_id", words.alias("words"), F.floor(h / 10).alias("g"))
    made = F.expr("""transform(
        transform(
            transform(array(words), w -> struct(w, g % greatest(size(w), 1) AS a)),
            s -> struct(s.w AS w, s.a AS a, 1 + floor((size(s.w) - s.a) / (3 + g % 8)) AS p)),
        s -> array_join(transform(s.w, (x, i) -> IF(i < s.a, x, s.w[int(s.a + (i - s.a) % s.p)])), ' '))[0]""")
    made = some.select("doc_id", made.alias("text"))
    others = docs.where(F.coalesce(h % 10 != 0, F.lit(True)) | F.col("text").isNull())
    return others.select("doc_id", "text").unionByName(made)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = periods.periodic_runs(planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return done.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whitened(table(spark, sf_dir, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    rows = done.select("vec_id", "n", "deviation", "identity_error", each)
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


@dataclass(frozen=True)
class Entry:
    run: object
    sql: str | None = None


# Reachability over a list of links, by walking to the smallest node.
_COMPONENTS = """
    sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach(node, seen) AS (SELECT a, b FROM sym UNION SELECT r.node, sym.b FROM reach r JOIN sym ON sym.a = r.seen),
    low AS (SELECT node, min(seen) AS least FROM reach GROUP BY node)"""

OP2_SQL = f"""
WITH RECURSIVE
    numbered AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, row_number() OVER () AS r FROM embeddings),
    usable AS (SELECT * FROM numbered WHERE label IS NOT NULL AND v IS NOT NULL
               AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
               AND len(list_filter(v, lambda x: x <> 0)) > 0),
    near AS (SELECT x.r AS rx, x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
             ON x.label = y.label AND len(x.v) = len(y.v) AND x.r <> y.r
             WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
    counted AS (SELECT rx, count(*) AS n FROM near GROUP BY rx),
    links AS (SELECT DISTINCT a, b FROM near),
    {_COMPONENTS}
SELECT numbered.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low.least, vec_id)) AS component_id,
       vec_id <= coalesce(low.least, vec_id) AS kept
FROM numbered LEFT JOIN counted ON rx = r LEFT JOIN low ON low.node = vec_id
"""

_SHINGLES = r"""
    words AS (SELECT doc_id, regexp_extract_all(
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
              FROM {docs}),
    shingles AS (SELECT DISTINCT doc_id, unnest(CASE
                     WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                     WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
              FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
              WHERE 100 * o >= 80 * (p.n + q.n - o))"""

OP4_SQL = f"""
WITH RECURSIVE {_SHINGLES.format(docs="documents")},
    {_COMPONENTS}
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(low.least, doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN low ON low.node = doc_id
"""

# Windows of ten item words (or whole shorter items) and the document words they cover.
OP7_SQL = r"""
WITH item_words AS (SELECT item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS k,
                    unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
                                          lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS s
                FROM item_words WHERE len(w) > 0),
    doc_words AS (SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    grams AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i,
                  unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
              FROM doc_words CROSS JOIN (SELECT DISTINCT k FROM windows)),
    hits AS (SELECT doc_id, i, g.k, item_id FROM grams g JOIN windows USING (k, s)),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP10_SQL = f"""
WITH keyed AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
        ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, '~'), coalesce(text, '~'))), 1, 15))::BIGINT AS h
    FROM documents),
    placed AS (SELECT *, h >> (60 - depth) AS prefix FROM keyed CROSS JOIN (SELECT unnest(range(0, 61)) AS depth)),
    sums AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs, min(h) = max(h) AS same
             FROM placed GROUP BY depth, prefix),
    fit AS (SELECT p.doc_id, p.n_bytes, p.h, min(p.depth) AS depth FROM placed p JOIN sums ON sums.depth = p.depth AND sums.prefix = p.prefix
            WHERE shard_bytes <= {sharding.LIMIT_BYTES} OR same GROUP BY p.doc_id, p.n_bytes, p.h)
SELECT doc_id, n_bytes, concat_ws('-', fit.depth, h >> (60 - fit.depth)) AS shard, fit.depth::INT AS depth, shard_bytes, shard_docs,
       shard_bytes > {sharding.LIMIT_BYTES} AS oversized
FROM fit JOIN sums ON sums.depth = fit.depth AND sums.prefix = h >> (60 - fit.depth)
"""

ENTRIES = {
    "op1_main_text": Entry(op1_main_text),
    "op2_near_vectors": Entry(op2_near_vectors, OP2_SQL),
    "op3_toxicity": Entry(op3_toxicity),
    "op4_jaccard_join": Entry(op4_jaccard_join, OP4_SQL),
    "op5_secret_scan": Entry(op5_secret_scan),
    "op6_sentence_dedup": Entry(op6_sentence_dedup),
    "op7_decontaminate": Entry(op7_decontaminate, OP7_SQL),
    "op8_sentencepiece": Entry(op8_sentencepiece),
    "op9_language": Entry(op9_language),
    "op10_sharding": Entry(op10_sharding, OP10_SQL),
    "op11_suffix_dedup": Entry(op11_suffix_dedup),
    "op12_periodic_runs": Entry(op12_periodic_runs),
    "op13_whitening": Entry(op13_whitening),
}


def entries() -> dict[str, Entry]:
    return dict(ENTRIES)
