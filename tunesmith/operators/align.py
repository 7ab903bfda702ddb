"""Alignment of corpora by position or id.

Everything that is "the i-th of each list" is an equi-join on a dense ``pos``;
inner joins cut to the shorter side by themselves.  No join here carries a
broadcast hint: small sides are found by Spark's own size threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zip_join(*frames: DataFrame, pos: str = "pos") -> DataFrame:
    """Rows with the same position, cut to the shortest frame."""
    return reduce(lambda a, b: a.join(b, pos), frames)


def unmatched(a: DataFrame, b: DataFrame, key: str = "pos") -> DataFrame:
    """``(key, side)`` for rows of ``a`` or ``b`` without a partner (strict zip)."""
    left = a.select(key, F.lit(True).alias("in_left"))
    right = b.select(key, F.lit(True).alias("in_right"))
    alone = left.join(right, key, "full").where("in_left IS NULL OR in_right IS NULL")
    return alone.select(key, F.when(F.col("in_left"), "left").otherwise("right").alias("side"))


def exact_join(df: DataFrame, other: DataFrame, key: str, what: str, on_missing: str = "raise") -> DataFrame:
    """Join in which every row of ``df`` must find its key.

    ``on_missing='raise'`` fails the job at the first row without a partner and names its
    key; ``'drop'`` leaves such rows out.
    """
    if on_missing == "drop":
        return df.join(other, key)
    if on_missing != "raise":
        raise ValueError(f"on_missing: {on_missing}")
    joined = df.join(other.withColumn("_found", F.lit(True)), key, "left")
    missing = F.raise_error(F.concat(F.lit(f"no {what} for "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    found = F.when(F.col("_found").isNull(), missing.cast("boolean")).otherwise(F.lit(True))
    return joined.where(found).drop("_found")


def attach_criteria(df: DataFrame, criteria: DataFrame, key: str = "category", on_missing: str = "raise") -> DataFrame:
    """Add the criterion of each row's category."""
    return exact_join(df, criteria, key, "criterion", on_missing)


def missing_categories(df: DataFrame, criteria: DataFrame, key: str = "category") -> DataFrame:
    """Categories without a criterion and their row counts; must be empty."""
    used = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return used.join(criteria, key, "left_anti")


def rejoin_responses(
    prompts: DataFrame, replies: DataFrame, pos: str = "pos", on_missing: str = "raise"
) -> DataFrame:
    """Put ``(custom_id, content)`` replies back to ``request-{pos}`` prompts."""
    wanted = prompts.withColumn("custom_id", request_id(pos))
    return exact_join(wanted, replies.select("custom_id", "content"), "custom_id", "reply", on_missing)


def missing_responses(prompts: DataFrame, replies: DataFrame, pos: str = "pos") -> DataFrame:
    """Prompts that got no reply."""
    wanted = prompts.withColumn("custom_id", request_id(pos))
    # one row per id, so that a much repeated id does not weigh on one task
    return wanted.join(replies.select("custom_id").distinct(), "custom_id", "left_anti")


def request_id(pos: str = "pos"):
    return F.concat(F.lit("request-"), F.col(pos).cast("string"))


CACHE_KEY = ("prompt_id", "model_id", "decode_hash")


def missing_completions(prompts: DataFrame, cache: DataFrame) -> DataFrame:
    """Prompts that the completion cache does not hold for this model and setting."""
    return prompts.join(cache.select(*CACHE_KEY).distinct(), list(CACHE_KEY), "left_anti")


def fill_completions(prompts: DataFrame, cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """Cached and newly made completions of exactly the wanted prompts."""
    columns = [*CACHE_KEY, "completion"]
    known = cache.select(*columns).join(
        prompts.select(*CACHE_KEY), list(CACHE_KEY), "left_semi"
    )
    return known.unionByName(fresh.select(*columns))
