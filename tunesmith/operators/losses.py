"""Losses computed from logged log-probabilities."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.fixed_values import BETA, IGNORE_LABEL, PREFERENCE_LENGTH


def neg_log_sigmoid(z: Column) -> Column:
    """-log(sigmoid(z)) without overflow for large margins."""
    return F.log1p(F.exp(-F.abs(z))) + F.greatest(-z, F.lit(0.0))


def _margin() -> Column:
    """(policy - reference) of chosen minus the same of rejected; absent = 0."""
    sign = (
        F.when(F.col("side") == "chosen", 1.0).otherwise(-1.0)
        * F.when(F.col("model") == "policy", 1.0).otherwise(-1.0)
    )
    return F.sum(sign * F.col("logp"))


def preference_loss(
    logps: DataFrame,
    examples: DataFrame,
    beta: float = BETA,
    length: int = PREFERENCE_LENGTH,
    reduce: str = "token_grid",
) -> DataFrame:
    """``(example_id, side, model, pos, logp)`` + ``(example_id, batch_id)`` -> batch losses.

    Only positions inside the assistant mask are stored.  ``token_grid`` is the mean
    over the padded grid of the batch (rows x ``length``): every position not stored
    has margin 0 and adds ln 2, which is added in closed form; positions behind
    ``length`` are not part of the grid.  ``sequence`` sums the
    margin over positions first and takes the mean over examples.
    """
    if reduce == "sequence":
        margins = logps.groupBy("example_id").agg(_margin().alias("z"))
        rows = examples.join(margins, "example_id", "left")
        return rows.groupBy("batch_id").agg(
            F.avg(neg_log_sigmoid(beta * F.coalesce("z", F.lit(0.0)))).alias("loss"),
            F.count(F.lit(1)).alias("n_examples"),
        )
    if reduce != "token_grid":
        raise ValueError(f"reduce: {reduce}")
    cells = logps.where(F.col("pos") < length).groupBy("example_id", "pos").agg(_margin().alias("z"))
    sums = cells.groupBy("example_id").agg(
        F.sum(neg_log_sigmoid(beta * F.col("z"))).alias("s"), F.count(F.lit(1)).alias("n")
    )
    per_batch = (
        examples.join(sums, "example_id", "left")
        .groupBy("batch_id")
        .agg(
            F.coalesce(F.sum("s"), F.lit(0.0)).alias("s"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.count(F.lit(1)).alias("n_examples"),
        )
    )
    grid = F.col("n_examples") * F.lit(length)
    loss = (F.col("s") + (grid - F.col("n")) * F.lit(math.log(2.0))) / grid
    return per_batch.select("batch_id", loss.alias("loss"), "n_examples")


def masked_nll(token_logps: DataFrame) -> DataFrame:
    """``(batch_id, label, logp)`` -> mean of -logp over labels that count.

    A batch in which nothing counts has no row.
    """
    return (
        token_logps.where(F.col("label") != IGNORE_LABEL)
        .groupBy("batch_id")
        .agg(F.avg(-F.col("logp")).alias("loss"), F.count(F.lit(1)).alias("n_tokens"))
    )
