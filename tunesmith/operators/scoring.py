"""Reward scores, win rates and evaluation summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.functions.text import last_number
from tunesmith.session import store

# from a list of (prompt, response) pairs to the raw reply texts
Scorer = Callable[[list[tuple[str, str]]], list[str]]


def score_with(
    df: DataFrame,
    loader: Callable[[], Scorer],
    prompt: str = "prompt",
    response: str = "response",
    raw: str = "raw",
    batch_size: int = 32,
) -> DataFrame:
    """Add the raw reply of an outside scorer (opened once per task) to every pair.

    Calls run in parallel over partitions; a rate limit belongs to the plug-in.
    """
    schema = df.drop(raw).withColumn(raw, F.lit("")).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = loader()
        for frame in frames:
            pairs = list(zip(frame[prompt], frame[response]))
            replies: list[str] = []
            for i in range(0, len(pairs), batch_size):
                replies.extend(score(pairs[i : i + batch_size]))
            yield frame.assign(**{raw: replies})

    return df.mapInPandas(run, schema)


def parse_rewards(df: DataFrame, raw: str = "raw", reward: str = "reward") -> DataFrame:
    """Add the reward read from the raw reply, null if it cannot be read."""
    return df.withColumn(reward, last_number(F.col(raw)))


def rejected_rewards(scored: DataFrame, raw: str = "raw", reward: str = "reward") -> DataFrame:
    """Pairs whose reply held no readable number."""
    return scored.where(F.col(raw).isNotNull() & F.col(reward).isNull())


def _wins(a: Column, b: Column, prefer_a_on_tie: bool) -> Column:
    better = (a >= b) if prefer_a_on_tie else (a > b)
    return better & ~F.isnan(a) & ~F.isnan(b)  # a NaN reward never wins


def win_rate(pairs: DataFrame, prefer_a_on_tie: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """One row per prompt ``(reward_a, reward_b)`` -> win rate and mean rewards.

    A prompt without scores stays in the denominator of the win rate but not in
    the means.  No prompts at all give one row with null rates.
    """
    a, b = F.col("reward_a"), F.col("reward_b")
    scored = a.isNotNull() & b.isNotNull()
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_prompts"),
        F.count_if(scored).alias("n_scored"),
        F.count_if(_wins(a, b, prefer_a_on_tie)).alias("n_wins"),
        F.try_divide(F.count_if(_wins(a, b, prefer_a_on_tie)), F.count(F.lit(1))).alias("win_rate"),
        F.avg(F.when(scored, a)).alias("mean_a"),
        F.avg(F.when(scored, b)).alias("mean_b"),
    )


def reward_pairs(
    prompts: DataFrame,
    completions_a: DataFrame,
    completions_b: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    key: str = "prompt_id",
) -> DataFrame:
    """Attach and score both models' completions, one row per prompt.

    ``score`` gets rows with ``prompt`` and ``response`` and adds ``reward``: a
    Column expression, or ``score_with`` followed by ``parse_rewards``.  A model has one
    completion per prompt at most.

    Both sides meet the prompts in one join and are scored in one pass, and the rewards
    are stored, so that a retry further down never calls an outside scorer again.
    """
    sides = [
        made.select(key, F.col("completion").alias("response"), F.lit(side).alias("side"))
        for side, made in (("a", completions_a), ("b", completions_b))
    ]
    pairs = prompts.select(key, "prompt").join(sides[0].unionByName(sides[1]), key)
    # one column, so that a scorer need not know of more than the pair
    known = pairs.select(F.struct(key, "side").alias("of"), "prompt", "response")
    scored = store(score(known).select("of", "reward"), "rewards")
    reward = lambda side: F.max(F.when(F.col("of.side") == side, F.col("reward")))
    both = scored.groupBy(F.col(f"of.{key}").alias(key)).agg(
        reward("a").alias("reward_a"), reward("b").alias("reward_b")
    )
    return prompts.drop("prompt").join(both, key, "left")


def evaluate(
    prompts: DataFrame,
    completions_a: DataFrame,
    completions_b: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    prefer_a_on_tie: bool = False,
    by: Sequence[str] = (),
    key: str = "prompt_id",
) -> DataFrame:
    """Compare two models: scores of both sides, then win rate and mean rewards."""
    pairs = reward_pairs(prompts, completions_a, completions_b, score, key)
    return win_rate(pairs, prefer_a_on_tie, by)
