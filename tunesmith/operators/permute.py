"""Row orders that are computed instead of sorted.

An epoch needs a new order of ``n`` stored positions.  Here that order is a keyed,
invertible permutation of ``[0, n)``: the place of a position and the position at a place
are expressions over one row.  No epoch is shuffled, sorted or stored; any batch of any
epoch can be read by itself, and a restart computes the same order again.

A number is written as ``left * cols + right`` on a grid of ``rows x cols`` cells.  In each
round one half is shifted by a keyed hash of the other (a Feistel network on unequal
halves); shifting back in reverse order is the inverse.  The grid has ``n`` cells or a few
more, and a number that lands on one of those is sent round again (cycle walking).  Where
the walk from each spare cell ends is known beforehand: the grid is the one with the fewest
spare cells, a handful, so rows make one pass and look the rest up.

The orders are those of a keyed hash, so tables of a handful of rows do not reach every
possible order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from math import isqrt

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRIME = 2**31 - 1
#: Multiplier between the two steps of a round's hash.
MIX = 1_103_515_245
ROUNDS = 6
#: Grids that are compared at most; beyond that many rows the best of them is taken.
TRIES = 1 << 22
LARGEST = 1 << 58
ADDED = {"epoch", "place", "batch_id", "n_batches"}


@dataclass(frozen=True)
class Grid:
    """``rows * cols`` cells for the numbers below ``n``."""

    n: int
    rows: int
    cols: int

    @property
    def spare(self) -> int:
        return self.rows * self.cols - self.n


def grid(n: int) -> Grid:
    """The grid for ``n`` numbers with the fewest spare cells; of these, the squarest."""
    if not 0 <= n <= LARGEST:
        raise ValueError(f"n: {n}")
    first = max(isqrt(n), 2 if n > 2 else 1)
    rows = np.arange(first, min(4 * first, first + TRIES) + 1, dtype=np.int64)
    best = int(rows[np.argmin(-n % rows)])
    return Grid(n, best, max(-(-n // best), 1))


def round_keys(seed: int | str, epoch: int) -> list[int]:
    """One key below 2^28 per round."""
    return [int(hashlib.md5(f"{seed}|{epoch}|{r}".encode()).hexdigest()[:7], 16) for r in range(ROUNDS)]


def _whole(number: str, size: int) -> Column:
    """Whole quotient of a long column."""
    return F.expr(f"`{number}` div {size}")


def _hash(half: Column, key: Column) -> Column:
    """A keyed hash below 2^31; products stay below 2^62."""
    one = (half + key) % PRIME * MIX % PRIME
    two = one.bitwiseXOR(F.shiftright(one, 15)) % PRIME * (key + 1)
    return two % PRIME


def _cell(number: int, cells: Grid, keys: list[int], back: bool) -> int:
    """One pass of a single number."""
    halves, sizes = list(divmod(number, cells.cols)), (cells.rows, cells.cols)
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        i, other, key = r % 2, halves[1 - r % 2], keys[r]
        one = (other + key) % PRIME * MIX % PRIME
        shift = (one ^ one >> 15) % PRIME * (key + 1) % PRIME % sizes[i]
        halves[i] = (halves[i] - shift if back else halves[i] + shift) % sizes[i]
    return halves[0] * cells.cols + halves[1]


def _walk_ends(cells: Grid, keys: list[int], back: bool) -> list[int]:
    """Where the walk from each spare cell ends (itself, if it only meets spare cells)."""
    ends = []
    for cell in range(cells.n, cells.n + cells.spare):
        number = _cell(cell, cells, keys, back)
        while number >= cells.n and number != cell:
            number = _cell(number, cells, keys, back)
        ends.append(number)
    return ends


def _permuted(df: DataFrame, cells: Grid, source: str, target: str, back: bool) -> DataFrame:
    """``target`` is the place of ``source`` (``back``: the position at the place ``source``);
    ``df`` carries the round keys.  One projection per round."""
    kept = [f"`{c}`" for c in df.columns]
    df = df.withColumns({"_left": _whole(source, cells.cols), "_right": F.col(f"`{source}`") % cells.cols})
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        moved, other, size = ("_left", "_right", cells.rows) if r % 2 == 0 else ("_right", "_left", cells.cols)
        shift = _hash(F.col(other), F.col(f"_key{r}")) % size
        new = (F.col(moved) + (size - shift if back else shift)) % size
        df = df.select(*kept, new.alias(moved), other)
    df = df.select(*kept, (F.col("_left") * cells.cols + F.col("_right")).alias(target))
    if cells.spare:
        walked = F.element_at("_ends", (F.col(target) - (cells.n - 1)).cast("int"))
        df = df.withColumn(target, F.when(F.col(target) < cells.n, F.col(target)).otherwise(walked))
    return df.drop("_ends", *[f"_key{r}" for r in range(ROUNDS)])


def _with_keys(df: DataFrame, cells: Grid, epochs: range, seed: int | str, back: bool = False) -> DataFrame:
    """Every row once per epoch, with the epoch's keys and ends of walks."""
    rows = []
    for epoch in epochs:
        keys = round_keys(seed, epoch)
        values = {f"_key{r}": F.lit(k).cast("bigint") for r, k in enumerate(keys)}
        ends = F.array(*[F.lit(e).cast("bigint") for e in _walk_ends(cells, keys, back)]).cast("array<bigint>")
        rows.append(F.struct(F.lit(epoch).alias("epoch"), *[v.alias(c) for c, v in values.items()], ends.alias("_ends")))
    return df.select("*", F.inline(F.array(*rows)))


def batches_of(n: int, size: int) -> int:
    return -(-n // size)


def epoch_places(
    df: DataFrame, n: int, epochs: int, batch_size: int, seed: int | str = 0, pos: str = "pos"
) -> DataFrame:
    """Rows with dense positions, once per epoch -> ``df`` with ``(epoch, place, batch_id, n_batches)``.

    ``n`` is the number of positions, counted once when they were stored; positions outside
    ``[0, n)`` and null ones are refused when the rows are read.  A map over the rows: nothing
    is shuffled, whatever the number of epochs.
    """
    if clash := ADDED & {c.lower() for c in df.columns}:
        raise ValueError(f"columns that the plan adds: {sorted(clash)}")
    known = F.when(F.col(f"`{pos}`").between(0, n - 1), F.col(f"`{pos}`")).otherwise(
        F.raise_error(F.concat(F.lit(f"position outside [0, {n}): "), F.coalesce(F.col(f"`{pos}`").cast("string"), F.lit("null"))))
    )
    cells = grid(n)
    copies = _with_keys(df.withColumn(pos, known.cast("bigint")), cells, range(epochs), seed)
    return _permuted(copies, cells, pos, "place", back=False).select(
        "epoch",
        "place",
        _whole("place", batch_size).alias("batch_id"),
        F.lit(batches_of(n, batch_size)).cast("bigint").alias("n_batches"),
        *[F.col(f"`{c}`") for c in df.columns],
    )


def batch_positions(
    spark: SparkSession,
    n: int,
    epoch: int,
    batch_size: int,
    first: int = 0,
    last: int | None = None,
    seed: int | str = 0,
) -> DataFrame:
    """``(batch_id, place, pos)`` of the batches ``first`` to ``last`` (exclusive) of an epoch.

    Only the places asked for are computed; joined to a table stored by ``pos``, they read
    these batches without a plan of the epoch.
    """
    end = batches_of(n, batch_size) if last is None else last
    places = spark.range(max(first, 0) * batch_size, max(min(end * batch_size, n), max(first, 0) * batch_size)).toDF("place")
    cells = grid(n)
    keyed = _with_keys(places, cells, range(epoch, epoch + 1), seed, back=True)
    return _permuted(keyed, cells, "place", "pos", back=True).select(
        _whole("place", batch_size).alias("batch_id"), "place", "pos"
    )


def read_batches(
    stored: DataFrame,
    n: int,
    epoch: int,
    batch_size: int,
    first: int = 0,
    last: int | None = None,
    seed: int | str = 0,
    pos: str = "pos",
) -> DataFrame:
    """The rows of some batches of an epoch, with ``batch_id`` and ``place``."""
    wanted = batch_positions(stored.sparkSession, n, epoch, batch_size, first, last, seed)
    wanted = wanted.withColumnRenamed("pos", "_wanted")
    return stored.join(wanted, F.col(f"`{pos}`") == F.col("_wanted")).drop("_wanted")


def curriculum_places(
    data: Mapping[str, tuple[DataFrame, int, int]], batch_size: int, seed: int | str = 0, pos: str = "pos"
) -> DataFrame:
    """Stages one after another -> ``epoch_places`` with ``(stage_ord, stage, global_batch)``.

    ``data`` holds, in training order, ``{stage: (rows, n, epochs)}``; ``global_batch`` numbers
    all batches of the run.
    """
    parts, start = [], 0
    for i, (name, (rows, n, epochs)) in enumerate(data.items()):
        placed = epoch_places(rows, n, epochs, batch_size, f"{seed}|{i}", pos)
        count = batches_of(n, batch_size)
        number = F.lit(start).cast("bigint") + F.col("epoch") * F.lit(count).cast("bigint") + F.col("batch_id")
        parts.append(placed.withColumns({"stage_ord": F.lit(i), "stage": F.lit(name), "global_batch": number}))
        start += epochs * count
    return reduce(lambda a, b: a.unionByName(b), parts)
