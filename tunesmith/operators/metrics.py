"""Metric series and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RUN = ["run_id", "epoch"]
CHUNK = 65_536


def _usable(skip_nan: bool):
    used = F.col("used") & F.col("loss").isNotNull()
    return used & ~F.isnan("loss") if skip_nan else used


def running_loss(
    log: DataFrame,
    denom: str = "seen",
    every: int | None = None,
    skip_nan: bool = False,
    chunk: int = CHUNK,
) -> DataFrame:
    """``(run_id, epoch, i, loss, used)`` -> ``(run_id, epoch, i, step, avg_loss)``.

    ``i`` is the dense batch number within an epoch; skipped batches are logged with
    ``used = false``.  The running sum is divided by the batches seen (``i + 1``) or
    by the batches used so far.  With ``every`` only used batches with ``i`` a
    positive multiple of it are given out, otherwise every used batch.  The step
    counts on through the epochs by the epoch's own number of batches.

    The running sum is taken in chunks of consecutive ``i`` plus the totals of the
    chunks before, so a single long epoch is spread over many tasks.
    """
    if denom not in ("seen", "used"):
        raise ValueError(f"denom: {denom}")
    ok = _usable(skip_nan)
    rows = log.select(
        *RUN,
        "i",
        F.floor(F.col("i") / chunk).alias("c"),
        F.when(ok, F.col("loss")).otherwise(0.0).alias("loss"),
        ok.cast("bigint").alias("one"),
    )
    totals = rows.groupBy(*RUN, "c").agg(
        F.sum("loss").alias("s"), F.sum("one").alias("u"), F.count(F.lit(1)).alias("n")
    )
    earlier = W.partitionBy(*RUN).orderBy("c").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        *RUN,
        "c",
        F.coalesce(F.sum("s").over(earlier), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum("u").over(earlier), F.lit(0)).alias("u"),
        F.sum("n").over(W.partitionBy(*RUN)).alias("n_batches"),
    )
    inside = W.partitionBy(*RUN, "c").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    total = F.col("s") + F.sum("loss").over(inside)
    count = F.col("u") + F.sum("one").over(inside)
    divisor = F.col("i") + 1 if denom == "seen" else count
    series = rows.join(starts, [*RUN, "c"]).select(
        *RUN,
        "i",
        (F.col("epoch") * F.col("n_batches") + F.col("i")).alias("step"),
        F.try_divide(total, divisor).alias("avg_loss"),
        "one",
    )
    emitted = F.col("one") == 1
    if every is not None:
        emitted &= (F.col("i") % every == 0) & (F.col("i") != 0)
    return series.where(emitted).drop("one")


def running_points(series: DataFrame) -> DataFrame:
    """A running loss as metric points ``(run_id, tag, step, value)``."""
    return series.select(
        "run_id", F.lit("Loss/train").alias("tag"), F.col("step").cast("bigint").alias("step"),
        F.col("avg_loss").alias("value"),
    )


def epoch_summary(log: DataFrame, denom: str = "loader", skip_nan: bool = False) -> DataFrame:
    """``(run_id, epoch, phase, loss, used)`` -> mean loss per epoch and phase.

    Divided by the loader length (all logged batches) or by the batches used.
    """
    if denom not in ("loader", "used"):
        raise ValueError(f"denom: {denom}")
    ok = _usable(skip_nan)
    n = F.count(F.lit(1)) if denom == "loader" else F.count_if(ok)
    return log.groupBy(*RUN, "phase").agg(
        F.try_divide(F.coalesce(F.sum(F.when(ok, F.col("loss"))), F.lit(0.0)), n).alias("loss"),
        F.count(F.lit(1)).alias("n_batches"),
        F.count_if(ok).alias("n_used"),
    )


def epoch_points(summary: DataFrame) -> DataFrame:
    """Epoch summaries as metric points ``(run_id, tag, step, value)``."""
    tag = F.when(F.col("phase") == "train", "Loss/train_epoch").otherwise("Loss/val")
    return summary.select(
        "run_id", tag.alias("tag"), F.col("epoch").cast("bigint").alias("step"),
        F.col("loss").alias("value"),
    )


def stage_summary(summary: DataFrame) -> DataFrame:
    """Last train and validation loss of every ``(run_id, stage)``."""
    last = lambda phase: F.max_by(
        F.when(F.col("phase") == phase, F.col("loss")),
        F.when(F.col("phase") == phase, F.col("epoch")),
    )
    return summary.groupBy("run_id", "stage").agg(
        last("train").alias("train_loss"), last("val").alias("val_loss")
    )
