"""Periodic runs of words, found in tiles of every scale.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are equal) that
holds ``repeats`` periods and ``least`` words at least and cannot be made longer.

The periods are taken by octaves ``P <= q < 2 P``.  A text is exploded into overlapping
tiles for each octave: short enough to be one task's work, long enough for every run of
the octave to lie whole in one of them; the octaves whose tiles would be the same share
them, so a text of up to ``tile`` words is one tile.  Tiles of longer texts are dealt out.

A tile is solved by itself.  Boundaries stand every ``F`` words, so close that two words
``q`` apart stay equal over a whole block between two boundaries in each run.  Blocks
that occur again at a distance of the octave are found by fingerprints; at the boundaries
where that is so, a Z-function of the words ahead and one of the words behind, read
backwards, give how far words ``q`` apart are equal to either side, exactly.  The
intervals of one period are joined to fragments.  Where a fragment of a divisor of ``q``
covers a block and its copy, ``q`` is no smallest period and is left out.

Fragments are shuffled by document and period and stitched where they overlap, which is
where tiles do.  Last, runs that lie in a run of a divisor of their period are dropped.

Defined results: null and empty texts have no words and no runs; words are case
sensitive; runs of different periods may overlap, all are given; repeated rows give
the same result each; rows with one key and different texts are different documents; an
empty table gives an empty result; further columns stay, except that those with the name
of an added one (in any case) are replaced.  A very long text is tokenised by one task;
its tiles are many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.llm.common import add_columns, output_names, prepare
from tunesmith.llm.suffixes import identified
from tunesmith.llm.wordcodes import BASE, INVERSE, mix

LEAST = 24
REPEATS = 3
#: Words of the tiles that the small octaves share.
TILE = 1 << 16
#: Length and overlap of the tiles of an octave, in units of its longest period.
SPAN, OVERLAP = 16, 4


def block_of(period: int, least: int, repeats: int) -> int:
    """Words between boundaries for the octave from ``period``.

    Words ``q`` apart are equal over ``max(least, repeats * q) - q`` places of a run, and
    a stretch of ``2 F - 1`` places holds a whole block of ``F``.
    """
    return min((max(least, repeats * q) - q + 1) // 2 for q in (period, 2 * period - 1, max(period, min(least // repeats, 2 * period - 1))))


def tiles_of(n: int, tile: int, least: int, repeats: int) -> list[tuple[int, int, int, int]]:
    """``(start, end, first octave, last octave)``: the tiles of a text of ``n`` words."""
    if n < least:
        return []
    top = (n // repeats).bit_length() - 1  # octave of the longest period
    if n <= tile:
        return [(0, n, 0, top)]
    shared = max((tile // SPAN).bit_length() - 2, 0)
    groups = [(0, min(shared, top)), *((o, o) for o in range(shared + 1, top + 1))]
    out = []
    for low, high in groups:
        longest = 2 << high
        size = max(SPAN * longest, tile, 4 * least)
        step = size - max(OVERLAP * longest, 2 * least)
        for start in range(0, n, step):
            out.append((start, min(start + size, n), low, high))
            if start + size >= n:
                break
    return out


def z_function(words: list) -> list[int]:
    """For each place, the length of the prefix that is repeated there."""
    n = len(words)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and words[k] == words[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def fragments(codes: np.ndarray, low: int, high: int, least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """``(q, start, end)``: maximal intervals of places ``i`` of a tile with ``codes[i] ==
    codes[i + q]``, for the smallest periods of the octaves ``low`` to ``high``."""
    n = len(codes)
    up = np.cumprod(np.append(np.uint64(1), np.full(n, np.uint64(BASE))), dtype=np.uint64)
    down = np.cumprod(np.append(np.uint64(1), np.full(n, np.uint64(INVERSE))), dtype=np.uint64)
    sums = np.append(np.uint64(0), np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64))
    found: list[tuple[int, int, int]] = []
    for octave in range(low, high + 1):
        period = 1 << octave
        block = block_of(period, least, repeats)
        if period + block > n:
            break
        prints = (sums[block:] - sums[:-block]) * down[: n - block + 1]
        bounds = np.arange(0, n - block - period + 1, block)
        padded = np.append(prints, np.zeros(2 * period, np.uint64))
        hits = []
        for a in range(0, len(bounds), max(1, (1 << 20) // period)):
            some = bounds[a : a + max(1, (1 << 20) // period)]
            ahead = np.lib.stride_tricks.sliding_window_view(padded, period)[some + period]
            i, j = np.nonzero(ahead == prints[some][:, None])
            hits.append((some[i], j + period))
        at, q = (np.concatenate(x) for x in zip(*hits)) if hits else (np.zeros(0, np.int64),) * 2
        ok = at + q + block <= n
        for d, s, e in found:
            ok &= ~((q % d == 0) & (s <= at) & (at + q + block <= e + d))
        at, q = at[ok], q[ok]
        own: dict[int, list[list[int]]] = {}
        for bound, periods in zip(*_grouped(at, q)):
            z = z_function(codes[bound : bound + 2 * period + 2 * block].tolist())
            back = codes[max(bound - block, 0) : bound][::-1].tolist()
            end = min(bound + 2 * period, n)
            z_back = z_function([*back, -1, *codes[bound - len(back) : end][::-1].tolist()])
            for p in periods:
                if z[p] >= block:  # and not only their fingerprints are equal
                    start = bound - z_back[len(back) + 1 + end - bound - p]
                    spans = own.setdefault(p, [])
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], bound + z[p])
                    else:
                        spans.append([start, bound + z[p]])
        found += [(p, s, e) for p, spans in sorted(own.items()) for s, e in spans]
    return found


def _grouped(at: np.ndarray, q: np.ndarray):
    bounds, first = np.unique(at, return_index=True)
    return bounds.tolist(), [x.tolist() for x in np.split(q, first[1:])] if len(bounds) else []


def smallest(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` runs that lie in no run of a divisor of their period."""
    out: list[tuple[int, int, int]] = []
    for start, length, period in sorted(runs, key=lambda r: r[2]):
        if not any(period % p == 0 and s <= start and start + length <= s + n for s, n, p in out if p < period):
            out.append((start, length, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def tiled(docs: DataFrame, tile: int, least: int, repeats: int) -> DataFrame:
    """``key``, ``id``, ``start``, ``low``, ``high``, ``total`` and ``words`` (numbers) of all tiles."""

    def make():
        def work(column):
            at, starts, lows, highs, totals, words, ends = [0], [], [], [], [], [], [0]
            for text in column.to_pylist():
                cut = text.encode().split()  # at the six ASCII spaces only
                mine = tiles_of(len(cut), tile, least, repeats)
                if mine:
                    number = {w: i for i, w in enumerate(cut)}
                    codes = np.fromiter(map(number.__getitem__, cut), np.int32, len(cut))
                    for start, end, low, high in mine:
                        for to, x in zip((starts, lows, highs, totals), (start, low, high, len(cut))):
                            to.append(x)
                        words.append(codes[start:end])
                        ends.append(ends[-1] + end - start)
                at.append(len(starts))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(words) if words else [], pa.int32()))
            longs = [pa.array(x, pa.int64()) for x in (starts, lows, highs, totals)]
            items = pa.StructArray.from_arrays([*longs, lists], ["start", "low", "high", "total", "words"])
            return [pa.ListArray.from_arrays(pa.array(at, pa.int32()), items)]

        return work

    kind = "tiles array<struct<start:bigint,low:bigint,high:bigint,total:bigint,words:array<int>>>"
    made = add_columns(docs, "text", kind, make)
    return made.select("key", "id", F.explode("tiles").alias("t")).select("key", "id", "t.*")


def solved(tiles: DataFrame, least: int, repeats: int) -> DataFrame:
    """``key``, ``id``, ``period`` and the places ``s`` to ``e`` of the fragments of each tile.

    A fragment that ends inside its tile and is too short for a run is left out.
    """
    long = [F.lit(0).cast("long").alias(c) for c in ("period", "s", "e")]
    schema = tiles.select("key", "id", *long).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, out = [], []
            start, low, high, total = (batch.column(c).to_pylist() for c in ("start", "low", "high", "total"))
            for i, words in enumerate(batch.column("words")):
                codes = words.values.to_numpy(zero_copy_only=False)
                for q, s, e in fragments(codes, low[i], high[i], least, repeats):
                    open_ = s == 0 and start[i] or e + q == len(codes) and start[i] + len(codes) < total[i]
                    if open_ or e - s + q >= max(least, repeats * q):
                        of.append(i)
                        out.append((q, s + start[i], e + start[i]))
            keep = pa.array(of, pa.int64())
            values = np.array(out, np.int64).reshape(-1, 3)
            columns = [batch.column(c).take(keep) for c in ("key", "id")]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(values[:, k]) for k in range(3))], names=["key", "id", "period", "s", "e"])

    return tiles.mapInArrow(run, schema)


def stitched(found: DataFrame, least: int, repeats: int) -> DataFrame:
    """``key``, ``id``, ``start``, ``length``, ``period``: overlapping fragments made one."""
    by = Window.partitionBy("key", "id", "period").orderBy("s", "e")
    before = F.max("e").over(by.rowsBetween(Window.unboundedPreceding, -1))
    islands = found.withColumn("new", F.coalesce((F.col("s") > before).cast("int"), F.lit(1)))
    islands = islands.withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    runs = islands.groupBy("key", "id", "period", "island").agg(F.min("s").alias("start"), F.max("e").alias("e"))
    length = F.col("e") - F.col("start") + F.col("period")
    return runs.select("key", "id", "start", length.alias("length"), "period").where(
        F.col("length") >= F.greatest(F.lit(least), F.lit(repeats) * F.col("period"))
    )


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, repeats: int = REPEATS, tile: int = TILE
) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (``start``, ``length``, ``period``, in this order),
    ``strongest`` (the run with the most periods; of equal ones the first, with the smallest
    period; null without runs) and ``collapsed`` (the words outside the later periods of
    all runs, joined by one space)."""
    prepare(docs.sparkSession)
    rows = identified(docs, key, text)
    plain = rows.select("key", "id", "text")
    one = F.octet_length("text") < 2 * tile  # every word but the last is followed by a space
    tiles = tiled(plain.where(one), tile, least, repeats).unionByName(
        tiled(plain.where(~one), tile, least, repeats).repartition("key", "id", "start", "low")
    )
    runs = stitched(solved(tiles, least, repeats).distinct(), least, repeats)
    runs = runs.groupBy("id", "key").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    same = (F.col("id") == F.col("of_id")) & F.col("key").eqNullSafe(F.col("of"))
    joined = rows.join(runs.withColumnRenamed("key", "of").withColumnRenamed("id", "of_id"), same, "left")

    def make():
        def work(column):
            n_words, all_runs, strongest, collapsed = [], [], [], []
            for text_, found in zip(column.field("text").to_pylist(), column.field("runs").to_pylist()):
                words = text_.encode().split()
                mine = smallest([(r["start"], r["length"], r["period"]) for r in found or []])
                best, gone = None, np.zeros(len(words) + 1, np.int64)
                for run in mine:
                    start, length, period = run
                    if best is None or length * best[2] > best[1] * period:
                        best = run
                    gone[start + period] += 1
                    gone[start + length] -= 1
                if mine:
                    away = np.cumsum(gone)
                    words = [w for w, a in zip(words, away) if not a]
                n_words.append(len(gone) - 1)
                all_runs.append([dict(zip(("start", "length", "period"), r)) for r in mine])
                strongest.append(best and dict(zip(("start", "length", "period"), best)))
                collapsed.append(b" ".join(words).decode())
            return [n_words, all_runs, strongest, collapsed]

        return work

    run = "struct<start:bigint,length:bigint,period:bigint>"
    added = f"n_words bigint, runs array<{run}>, strongest {run}, collapsed string"
    done = add_columns(joined.select("row", F.struct("text", "runs").alias("source")), "source", added, make)
    return output_names(done, docs, ["n_words", "runs", "strongest", "collapsed"])
