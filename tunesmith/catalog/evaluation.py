"""Bindings for scores, win rates, and losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith import fixed_values as V
from tunesmith.catalog.chat import PAIRS_CTE, preference_pairs
from tunesmith.catalog.registry import WORDS, Entry, exchange_cte, registrar, table
from tunesmith.functions.text import split_words
from tunesmith.operators.chat import first_exchange, valid_preferences
from tunesmith.operators.losses import masked_nll, preference_loss
from tunesmith.operators.position import (
    seeded_prompts,
    with_position,
    with_shuffled_position,
)
from tunesmith.operators.scoring import (
    evaluate,
    parse_rewards,
    rejected_rewards,
    win_rate,
)
from tunesmith.session import store

ENTRIES: dict[str, Entry] = {}
register = registrar(ENTRIES)


def _raw_scores(spark, sf):
    """Raw replies of a scorer; documents of source ``src3`` get an unreadable one."""
    return table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("source") == "src3", "reward:none")
        .otherwise(F.concat(F.lit(" reward: "), (F.col("n_chars") % 7).cast("string"), F.lit(".5 ")))
        .alias("raw"),
    )


@register(
    """SELECT doc_id, CASE WHEN source <> 'src3' THEN (n_chars % 7 + 0.5)::DOUBLE END AS reward
       FROM documents"""
)
def ev1_parse_rewards(spark, sf):
    return parse_rewards(_raw_scores(spark, sf)).select("doc_id", "reward")


@register("SELECT doc_id, 'reward:none' AS raw FROM documents WHERE source = 'src3'")
def ev1_rejected_rewards(spark, sf):
    return rejected_rewards(parse_rewards(_raw_scores(spark, sf))).select("doc_id", "raw")


def _label_pairs(spark, sf):
    """Quality against toxicity per document, null where there is no label."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf, "labels").select(
        "doc_id",
        F.col("quality").cast("double").alias("reward_a"),
        F.col("toxic").cast("double").alias("reward_b"),
    )
    return docs.join(labels, "doc_id", "left")


_RATE_SQL = """count(*) AS n_prompts, count(reward_a + reward_b) AS n_scored,
    count(*) FILTER (WHERE reward_a {op} reward_b) AS n_wins,
    round(count(*) FILTER (WHERE reward_a {op} reward_b) / count(*)::DOUBLE, 6) AS win_rate,
    round(avg(reward_a) FILTER (WHERE reward_b IS NOT NULL), 6) AS mean_a,
    round(avg(reward_b) FILTER (WHERE reward_a IS NOT NULL), 6) AS mean_b"""
_LABEL_PAIRS = """SELECT d.doc_id, lang, source, quality AS reward_a, toxic AS reward_b
    FROM documents d LEFT JOIN labels l USING (doc_id)"""


def _rounded(df):
    return df.select(
        *[
            F.round(c, 6).alias(c) if c in ("win_rate", "mean_a", "mean_b") else c
            for c in df.columns
        ]
    )


@register(f"SELECT {_RATE_SQL.format(op='>')} FROM ({_LABEL_PAIRS})")
def ev2_win_rate_ties_lose(spark, sf):
    return _rounded(win_rate(_label_pairs(spark, sf)))


@register(f"SELECT {_RATE_SQL.format(op='>=')} FROM ({_LABEL_PAIRS})")
def ev2_win_rate_ties_win(spark, sf):
    return _rounded(win_rate(_label_pairs(spark, sf), prefer_a_on_tie=True))


@register(
    f"SELECT lang, source, {_RATE_SQL.format(op='>')} FROM ({_LABEL_PAIRS}) GROUP BY lang, source"
)
def ev3_mean_rewards_by_group(spark, sf):
    return _rounded(win_rate(_label_pairs(spark, sf), by=["lang", "source"]))


def _completions(spark, sf, seed):
    """Each document answered with the document at the same place of a shuffled order."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    prompts = with_position(docs.select("doc_id"), "doc_id")
    replies = with_shuffled_position(docs.select("doc_id"), "doc_id", seed)
    texts = docs.withColumnRenamed("text", "completion")
    answers = replies.join(texts, "doc_id").select("pos", "completion")
    return prompts.join(answers, "pos").select(F.col("doc_id").alias("prompt_id"), "completion")


def _length_reward(pairs):
    raw = F.concat(
        F.lit("reward:"), ((F.length("prompt") + F.length("response")) % 5).cast("string")
    )
    return parse_rewards(pairs.withColumn("raw", raw))


def _answers_sql(seed: str) -> str:
    return f"""SELECT p.doc_id, r.text FROM
        (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents) p JOIN
        (SELECT text, row_number() OVER (ORDER BY md5('{seed}|' || doc_id), doc_id) - 1 AS pos
         FROM documents) r USING (pos)"""


def _evaluation_sql(prompts: str, op: str, group: str = "") -> str:
    cols = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return f"""WITH a AS ({_answers_sql('a')}), b AS ({_answers_sql('b')}), p AS ({prompts}),
        s AS (SELECT p.*, ((length(p.text) + length(a.text)) % 5)::DOUBLE AS reward_a,
                     ((length(p.text) + length(b.text)) % 5)::DOUBLE AS reward_b
              FROM p JOIN a USING (doc_id) JOIN b USING (doc_id))
        SELECT {cols}{_RATE_SQL.format(op=op)} FROM s{tail}"""


@register(_evaluation_sql("SELECT doc_id, text, lang FROM documents", ">=", "lang"))
def ev4_evaluate_all_prompts(spark, sf):
    prompts = table(spark, sf, "documents").select(
        F.col("doc_id").alias("prompt_id"), F.col("text").alias("prompt"), "lang"
    )
    return _rounded(
        evaluate(
            prompts,
            _completions(spark, sf, "a"),
            _completions(spark, sf, "b"),
            _length_reward,
            prefer_a_on_tie=True,
            by=["lang"],
        )
    )


@register(
    _evaluation_sql(
        """SELECT * FROM (SELECT doc_id, text FROM documents ORDER BY md5('42|' || doc_id), doc_id
           LIMIT 100) WHERE text <> ''""",
        ">",
    )
)
def ev4_evaluate_sample(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").alias("prompt_id"), F.col("text").alias("prompt")
    )
    prompts = store(seeded_prompts(rows, "prompt_id", V.EVAL_SAMPLES, V.EVAL_SEED), "evaluation-prompts")
    return _rounded(
        evaluate(prompts, _completions(spark, sf, "a"), _completions(spark, sf, "b"), _length_reward)
    )


def _logged(words, key: str):
    """Log-probabilities of two models, derived from word lengths and positions."""
    one = words.select(key, "side", F.posexplode("toks").alias("pos", "tok"))
    n = F.length("tok")
    policy = -(F.lit(1.0) + (n + F.col("pos")) % 11) / 10
    reference = -(F.lit(1.0) + (n * 3 + F.col("pos")) % 7) / 10
    return one.select(
        key,
        "side",
        "pos",
        F.explode(
            F.array(
                F.struct(F.lit("policy").alias("model"), policy.alias("logp")),
                F.struct(F.lit("reference").alias("model"), reference.alias("logp")),
            )
        ).alias("m"),
    ).select(F.col(key).alias("example_id"), "side", "m.model", "pos", "m.logp")


def _preference_logps(spark, sf):
    pairs = valid_preferences(preference_pairs(spark, sf))
    words = pairs.select(
        "conv_id",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(s).alias("side"),
                        split_words(F.col(s)[1]["content"]).alias("toks"),
                    )
                    for s in ("chosen", "rejected")
                ]
            )
        ).alias("w"),
    ).select("conv_id", "w.side", "w.toks")
    examples = with_position(pairs.select("conv_id"), "conv_id").select(
        F.col("conv_id").alias("example_id"), F.floor(F.col("pos") / 2).alias("batch_id")
    )
    return _logged(words, "conv_id"), examples


_LOGP_CTE = f"""{PAIRS_CTE},
    ex AS (SELECT conv_id, (row_number() OVER (ORDER BY conv_id) - 1) // 2 AS batch_id FROM pairs),
    wl AS (SELECT conv_id, 1 AS sgn, regexp_extract_all(chosen, '{WORDS}') AS l FROM pairs
           UNION ALL SELECT conv_id, -1, regexp_extract_all(rejected, '{WORDS}') FROM pairs),
    wt AS (SELECT conv_id, sgn, unnest(l) AS tok, generate_subscripts(l, 1) - 1 AS pos FROM wl),
    zs AS (SELECT conv_id, pos, sum(sgn * ((1 + (length(tok) * 3 + pos) % 7) - (1 + (length(tok) + pos) % 11)) / 10.0::DOUBLE) AS z
           FROM wt GROUP BY conv_id, pos)"""
_NLS = "(ln(1 + exp(-abs(0.5 * {z}))) + greatest(-0.5 * {z}, 0))"


@register(
    f"""WITH {_LOGP_CTE},
        cell AS (SELECT conv_id, sum({_NLS.format(z='z')}) AS s, count(*) AS n FROM zs WHERE pos < 1024 GROUP BY conv_id)
        SELECT batch_id::BIGINT AS batch_id, count(*) AS n_examples,
          round((coalesce(sum(s), 0) + (count(*) * 1024 - coalesce(sum(n), 0)) * ln(2)) / (count(*) * 1024), 6) AS loss
        FROM ex LEFT JOIN cell USING (conv_id) GROUP BY batch_id"""
)
def ev5_preference_loss_token_grid(spark, sf):
    loss = preference_loss(*_preference_logps(spark, sf))
    return loss.select("batch_id", "n_examples", F.round("loss", 6).alias("loss"))


@register(
    f"""WITH {_LOGP_CTE}, m AS (SELECT conv_id, sum(z) AS z FROM zs GROUP BY conv_id)
        SELECT batch_id::BIGINT AS batch_id, count(*) AS n_examples,
          round(avg({_NLS.format(z='coalesce(z, 0)')}), 6) AS loss
        FROM ex LEFT JOIN m USING (conv_id) GROUP BY batch_id"""
)
def ev5_preference_loss_sequence(spark, sf):
    loss = preference_loss(*_preference_logps(spark, sf), reduce="sequence")
    return loss.select("batch_id", "n_examples", F.round("loss", 6).alias("loss"))


@register(
    f"""WITH {exchange_cte()},
        fp AS (SELECT *, (row_number() OVER (ORDER BY conv_id) - 1) // 4 AS batch_id FROM fx),
        wl AS (SELECT batch_id, regexp_extract_all(completion, '{WORDS}') AS l FROM fp),
        wt AS (SELECT batch_id, unnest(l) AS tok, generate_subscripts(l, 1) - 1 AS pos FROM wl)
        SELECT batch_id::BIGINT AS batch_id, count(*) AS n_tokens,
          round(avg((1 + (length(tok) + pos) % 11) / 10.0::DOUBLE), 6) AS loss
        FROM wt WHERE length(tok) > 1 GROUP BY batch_id"""
)
def ev6_masked_nll(spark, sf):
    """One-letter words are masked out."""
    rows = with_position(first_exchange(table(spark, sf, "conversations")), "conv_id")
    words = rows.select(
        F.floor(F.col("pos") / 4).alias("batch_id"),
        F.posexplode(split_words(F.col("completion"))).alias("i", "tok"),
    )
    logged = words.select(
        "batch_id",
        F.when(F.length("tok") > 1, F.length("tok")).otherwise(V.IGNORE_LABEL).alias("label"),
        (-(F.lit(1.0) + (F.length("tok") + F.col("i")) % 11) / 10).alias("logp"),
    )
    return masked_nll(logged).select("batch_id", "n_tokens", F.round("loss", 6).alias("loss"))
