"""Batches and epoch plans as tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunesmith.fixed_values import STAGES
from tunesmith.operators.position import with_shuffled_position


def batch_count(rows: Column, size: int) -> Column:
    return F.ceil(rows / F.lit(size)).cast("bigint")


def make_batches(
    df: DataFrame, size: int, pos: str = "pos", valid: str = "valid"
) -> DataFrame:
    """Consecutive batches -> ``(batch_id, n_batches, n_rows, rows)``.

    Every row takes its slot first, invalid rows are removed afterwards, so a batch
    may be short; a batch without valid rows has no output row.  ``n_batches`` is
    the loader length with those batches included.
    """
    payload = [c for c in df.columns if c != valid]
    total = df.agg(batch_count(F.count(F.lit(1)), size).alias("n")).scalar()
    return (
        df.where(valid)
        .groupBy(F.floor(F.col(pos) / size).alias("batch_id"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.array_sort(F.collect_list(F.struct(pos, *[c for c in payload if c != pos]))).alias(
                "rows"
            ),
        )
        .select("batch_id", total.alias("n_batches"), "n_rows", "rows")
    )


def epoch_plan(
    ids: DataFrame, key: str, epochs: int, batch_size: int, seed: int | str = 0
) -> DataFrame:
    """A new row order per epoch -> ``(epoch, pos, batch_id, n_batches, key)``.

    Carries keys only; the payload is joined when a batch is read.
    """
    keys = ids.select(key)
    total = keys.agg(batch_count(F.count(F.lit(1)), batch_size).alias("n")).scalar()
    copies = keys.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    placed = with_shuffled_position(copies, key, seed, by=["epoch"])
    return placed.select(
        "epoch",
        "pos",
        F.floor(F.col("pos") / batch_size).alias("batch_id"),
        total.alias("n_batches"),
        key,
    )


@dataclass(frozen=True)
class Stage:
    name: str
    epochs: int


def stages(only: str = "all", epochs: int | None = None) -> list[Stage]:
    """The built-in curriculum, or one stage; an override holds for every stage run."""
    chosen = [Stage(n, epochs or e) for n, e in STAGES if only in ("all", n)]
    if not chosen:
        raise ValueError(f"unknown stage: {only}")
    return chosen


def curriculum_plan(
    data: dict[str, DataFrame],
    key: str,
    batch_size: int,
    run: Sequence[Stage] | None = None,
    seed: int | str = 0,
) -> DataFrame:
    """Stages one after another, each with its own keys and number of epochs.

    Gives ``(stage_ord, stage, epoch, batch_id, pos, global_batch, key)``;
    ``global_batch`` numbers all batches of the run in training order.
    """
    run = list(run or stages())
    tagged = [
        data[s.name].select(F.lit(i).alias("stage_ord"), F.lit(s.name).alias("stage"),
                            F.lit(s.epochs).alias("epochs"), key)
        for i, s in enumerate(run)
    ]
    keys = reduce(lambda a, b: a.unionByName(b), tagged)
    per_stage = keys.groupBy("stage_ord", "epochs").agg(
        batch_count(F.count(F.lit(1)), batch_size).alias("n")
    )
    # one row per stage
    steps = F.col("n") * F.col("epochs")
    starts = per_stage.select(
        "stage_ord",
        "n",
        (F.sum(steps).over(W.orderBy("stage_ord")) - steps).alias("first"),
    )
    copies = keys.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
    placed = with_shuffled_position(copies.drop("epochs"), key, seed, by=["stage_ord", "epoch"])
    placed = placed.withColumn("batch_id", F.floor(F.col("pos") / batch_size))
    return placed.join(F.broadcast(starts), "stage_ord").select(
        "stage_ord",
        "stage",
        "epoch",
        "batch_id",
        "pos",
        (F.col("first") + F.col("epoch") * F.col("n") + F.col("batch_id")).alias("global_batch"),
        key,
    )


def difficulty_buckets(
    df: DataFrame,
    length: Column,
    names: Sequence[str] = tuple(n for n, _ in STAGES),
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Add ``difficulty`` by response length.

    ``cuts`` are upper bounds (inclusive); without them they are the equal-share
    quantiles of the data.  These are exact: rows are counted per length, combined before
    the shuffle, and the running sum is over distinct lengths, at most as many as the
    longest text has tokens.
    """
    rows = df.withColumn("_length", length)
    if cuts is None:
        counts = rows.where("_length IS NOT NULL").groupBy("_length").agg(F.count(F.lit(1)).alias("n"))
        upto = counts.select(
            "_length",
            F.sum("n").over(W.orderBy("_length")).alias("upto"),
            F.sum("n").over(W.orderBy("_length").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("all"),
        )
        least = [
            F.min(F.when(F.col("upto") * len(names) >= F.col("all") * i, F.col("_length")))
            for i in range(1, len(names))
        ]
        bounds = upto.agg(F.array(*least).alias("q")).scalar()
    else:
        bounds = F.array(*[F.lit(c) for c in cuts])
    rows = rows.withColumn("_bounds", bounds)
    bucket = F.lit(names[-1])
    for i in reversed(range(len(names) - 1)):
        bucket = F.when(F.col("_length") <= F.element_at("_bounds", i + 1), names[i]).otherwise(
            bucket
        )
    return rows.withColumn("difficulty", bucket).drop("_length", "_bounds")
