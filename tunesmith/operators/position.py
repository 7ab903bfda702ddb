"""Dense row positions, and the splits and samples that are defined on them.

A dense position needs a total order.  One window over all rows would put them
all into one task, so the order is cut into buckets first:

    bucket of the sort key -> rows per bucket -> start of each bucket
    -> row_number *inside* the bucket + start

The bucket is a monotone function of the sort key: a range for sorted orders, the first
digits of the hash for shuffled ones.  The result is therefore a function of the values
alone: it does not depend on partitioning, retries or the bucket borders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunesmith.functions.text import order_hash
from tunesmith.session import store

HASH_DIGITS = 4  # 65,536 buckets for shuffled orders


def _number_within(
    df: DataFrame,
    bucket: Column,
    sort: Sequence[str],
    by: Sequence[str],
    pos: str,
) -> DataFrame:
    by = list(by)
    rows = df.withColumn("_bucket", bucket)
    sizes = rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # a window over buckets, not rows
    start = W.partitionBy(*by).orderBy("_bucket") if by else W.orderBy("_bucket")
    names = {c: f"_start_{c}" for c in [*by, "_bucket"]}
    starts = sizes.select(
        *[F.col(c).alias(n) for c, n in names.items()],
        (F.sum("_n").over(start) - F.col("_n")).alias("_first"),
    )
    if not by:
        # one row per bucket: at most 65,536, or the number of ranges
        starts = F.broadcast(starts)
    inside = W.partitionBy(*by, "_bucket").orderBy(*sort)
    return (
        rows.join(starts, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
        .withColumn(pos, F.col("_first") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_first", *names.values())
    )


def with_position(
    df: DataFrame,
    key: str,
    order: str | None = None,
    by: Sequence[str] = (),
    pos: str = "pos",
    parts: int | None = None,
) -> DataFrame:
    """Add dense 0-based positions in the order ``(order, key)``.

    ``key`` is unique, ``order`` may hold repeated values; both can be of any type that
    Spark sorts (numbers, strings, timestamps, structs).  ``by`` restarts the numbering
    per group.

    Keys alone are range-partitioned into ``parts`` buckets (the session's shuffle
    partitions if not given) and stored with their bucket: the ranges come from Spark's
    own sample, so they are balanced whatever the values are, and a stored bucket cannot
    change in a retry.  A value of ``order`` on a third of all rows is cut by ``key``.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [key] if order in (None, key) else [order, key]
    needed = list(dict.fromkeys([*by, *sort]))
    ranges = df.select(*needed).repartitionByRange(parts, *sort)
    stored = store(ranges.withColumn("_range", F.spark_partition_id()), "positions")
    placed = _number_within(stored, F.col("_range"), sort, by, pos).drop("_range")
    if set(df.columns) == set(needed):
        return placed.select(*df.columns, pos)
    found = placed.select(F.col(key).alias("_placed_key"), pos)
    return df.join(found, F.col(key).eqNullSafe(F.col("_placed_key"))).drop("_placed_key")


def with_shuffled_position(
    df: DataFrame,
    key: str,
    seed: int | str,
    by: Sequence[str] = (),
    pos: str = "pos",
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """Dense positions in a seeded random order of the unique ``key``.

    ``digits`` (1 to 4) sets the number of buckets, 16 to its power.

    With ``by`` every group gets its own order (the group is part of the hash).
    """
    if not 1 <= digits <= HASH_DIGITS:
        raise ValueError(f"digits: {digits}")
    rows = df.withColumn("_hash", order_hash(seed, *[F.col(c) for c in by], F.col(key)))
    bucket = F.conv(F.substring("_hash", 1, digits), 16, 10).cast("int")
    return _number_within(rows, bucket, ["_hash", key], by, pos).drop("_hash")


def range_split(
    df: DataFrame, bounds: Mapping[str, tuple[int, int | None]], pos: str = "pos"
) -> dict[str, DataFrame]:
    """Half-open position ranges -> one frame per name (``None`` = to the end)."""
    parts = {}
    for name, (start, end) in bounds.items():
        inside = F.col(pos) >= start
        if end is not None:
            inside &= F.col(pos) < end
        parts[name] = df.where(inside)
    return parts


def head_n(df: DataFrame, n: int | None, pos: str = "pos") -> DataFrame:
    """The first ``n`` rows by position (``None`` = all)."""
    return df if n is None else df.where(F.col(pos) < n)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable random sample of exactly ``n`` rows (or all, if fewer).

    Runs as a bounded top-``n`` per task; the table is not sorted as a whole.
    """
    return df.orderBy(order_hash(seed, F.col(key)), key).limit(n)


def seeded_prompts(
    df: DataFrame, key: str, n: int, seed: int = 42, prompt: str = "prompt"
) -> DataFrame:
    """Sample first, then drop missing and empty prompts: may give fewer than ``n``."""
    sample = seeded_sample(df, key, n, seed)
    return sample.where(F.col(prompt).isNotNull() & (F.col(prompt) != ""))
