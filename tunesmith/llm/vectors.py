"""Near-duplicate vectors by sorted projection passes.

Vectors are compared only within a label.  Each pass hashes a vector to the signs of its
products with random directions, written one after the other; vectors are ordered by
label and that bit string and every vector is compared with the ``window`` next ones.
Pairs whose cosine (double precision) reaches ``threshold`` are links, and the links of
all passes together form classes.

Vectors of a label often share a direction, which would give them the same bits, so the
label's mean is taken off before hashing; cosines are those of the vectors as they are.

The number of passes of a label is measured.  Over all its vectors, two trial passes count
the leading bits in which a vector agrees with the one a window further: a partner that
shares more of them is inside the window.  The length that is left of a vector without the
mean gives the chance that a partner of cosine ``threshold`` shares a bit.  So many passes
are made that such a pair is missed in all of them with probability ``MISS`` at most.  A
label that would need more than ``MOST_PASSES`` (its vectors lie so close to each other
that hashing hardly tells them apart) is compared exactly instead, block by block.

Windows find one link of a dense neighbourhood, not all.  An exact second step completes
them: all vectors of a class are compared with each other, in pairs of blocks, so
``n_links`` counts every link inside a class and no neighbour is cut off by a window.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers,
and vectors without a label, link with nothing; vectors of different length are not
compared; equal vectors (copies, repeated rows) are one item in the passes and count as
one vector each in the result; a null id does not take part in the minimum.  An empty
table gives no rows; columns other than the three named are not read, so their names
cannot clash.  A vector of any length is handled whole; a batch of them must fit a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import block_pairs, components, prepare, shuffle_width, whole_groups
from tunesmith.session import store

THRESHOLD = 0.93
#: Chance that no pass brings a pair at the threshold together.
MISS = 0.005
LEAST_PASSES = 12
#: A label that needs more passes than this is compared exactly.
MOST_PASSES = 384
TRIAL_PASSES = 2
WINDOW = 24
BITS = 60
BLOCK = 2048
SEED = 20240607


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    # scaled first, so that tiny and huge vectors keep their direction
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


#: Passes that are projected at once, which bounds the memory of a batch.
CHUNK = 16


def directions(dim: int, chunk: int, seed: int = SEED) -> np.ndarray:
    """Random directions of the passes of a chunk: ``CHUNK * BITS`` columns."""
    return np.random.Generator(np.random.PCG64([seed, dim, chunk])).standard_normal((dim, CHUNK * BITS))


def codes_of(rows: np.ndarray, passes: int) -> np.ndarray:
    """Bit strings of the rows as numbers, one column for each pass."""
    weights = np.int64(1) << np.arange(BITS - 1, -1, -1)
    made = []
    for chunk in range(-(-passes // CHUNK)):
        now = min(CHUNK, passes - chunk * CHUNK)
        bits = rows @ directions(rows.shape[1], chunk)[:, : now * BITS] > 0
        made.append((bits.reshape(len(rows), now, BITS) * weights).sum(axis=2))
    return np.concatenate(made, axis=1)


def passes_for(largest: int, threshold: float = THRESHOLD, window: int = WINDOW) -> int:
    """Passes that a label of ``largest`` distinct vectors needs.

    Two vectors get the same bit with probability ``1 - angle / pi``; ``largest`` vectors
    that share ``log2(largest / window)`` bits are about a window.
    """
    bits = max(0.0, math.log2(max(1, largest) / window))
    together = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** bits
    needed = math.log(MISS) / math.log1p(-together) if together < 1 else 1.0
    return max(LEAST_PASSES, math.ceil(needed))


def largest_label(items: DataFrame) -> int:
    sizes = items.groupBy("label", F.size("v")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def items_of(rows: DataFrame) -> DataFrame:
    """Distinct usable vectors: ``node``, ``label``, ``dim``, ``v``, ``copies``.

    ``rows``: ``key``, ``v`` (doubles), ``label``.
    """
    return rows.where("node IS NOT NULL").groupBy("node").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("copies")
    )


def with_node(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``key``, ``v``, ``label``, ``node``; the node is null for a vector that cannot link."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0)
    rows = df.select(F.col(key).alias("key"), v.alias("v"), F.col(label).alias("label"))
    return rows.withColumn("node", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "v")))


def with_mean(items: DataFrame) -> DataFrame:
    """``items`` with ``dim`` and ``mean``, that of the unit vectors of the label.

    Sums are made in each batch; means are one row for each label and length, stored, and
    joined without a hint.
    """

    def add(batches):
        for batch in batches:
            labels, dims = np.asarray(batch.column(0).to_pylist(), object), np.asarray(batch.column(1))
            for label, dim in sorted(set(zip(labels.tolist(), dims.tolist()))):
                at = (labels == label) & (dims == dim)
                total = _unit(_matrix(batch.column(2).filter(pa.array(at)))).sum(axis=0)
                columns = [pa.array([label], pa.string()), pa.array([dim], pa.int32()), pa.array([int(at.sum())], pa.int64()), pa.array([total.tolist()])]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "dim", "n", "total"])

    rows = items.withColumn("label", F.col("label").cast("string")).withColumn("dim", F.size("v"))
    sums = rows.select("label", "dim", "v").mapInArrow(add, "label string, dim int, n bigint, total array<double>")
    parts = sums.select("label", "dim", "n", F.posexplode("total").alias("i", "x"))
    each = parts.groupBy("label", "dim", "i").agg((F.sum("x") / F.sum("n")).alias("x"))
    listed = each.groupBy("label", "dim").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("at"))
    means = store(listed.select("label", "dim", F.col("at.x").alias("mean")), "vector_means")
    return rows.join(means, ["label", "dim"])


def passes_needed(rows: DataFrame, threshold: float, window: int, least: int) -> DataFrame:
    """``label``, ``dim``, ``passes`` as measured over all ``rows``; null beyond ``MOST_PASSES``.

    Labels of which nothing could be measured, being smaller than a window, have no row.
    """

    def project(batches):
        for batch in batches:
            dims = np.asarray(batch.column(2))
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                c = _unit(_matrix(part.column(3))) - _matrix(part.column(4))
                rest = np.maximum((c * c).sum(axis=1), 1e-300)
                angle = np.arccos(np.clip(1 - (1 - threshold) / rest, -1, 1))
                same = np.maximum(1 - angle / math.pi, 1e-3)
                codes = codes_of(c, TRIAL_PASSES)
                for at in range(TRIAL_PASSES):
                    columns = [part.column(1), part.column(2), pa.array(np.full(len(part), at, np.int32)),
                               pa.array(codes[:, at]), part.column(0), pa.array(-np.log2(same))]
                    yield pa.RecordBatch.from_arrays(columns, names=["label", "dim", "pass", "code", "node", "bit"])

    def measure(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            both = pa.concat_tables([t for t in (held, pa.Table.from_batches([batch])) if t is not None])
            both = both.combine_chunks().to_batches()[0]
            held = pa.Table.from_batches([both.slice(max(0, both.num_rows - window))])
            run, code, bit = (np.asarray(both.column(i)) for i in (2, 3, 4))
            at = np.flatnonzero(run[window:] == run[:-window])
            if not len(at):
                continue
            apart = (code[at] ^ code[at + window]).astype(np.float64)
            shared = BITS - np.frexp(apart)[1] + 1
            steps = np.ceil(4 * np.minimum(shared, BITS) * bit[at]).astype(np.int32)
            names, dims = both.column(0).take(pa.array(at)), both.column(1).take(pa.array(at))
            counted = pa.table([names, dims, pa.array(steps)], names=["label", "dim", "step"])
            counted = counted.group_by(["label", "dim", "step"]).aggregate([([], "count_all")])
            yield from counted.select(["label", "dim", "step", "count_all"]).rename_columns(_STEPS).to_batches()

    source = rows.select("node", "label", "dim", "v", "mean")
    coded = source.mapInArrow(project, "label string, dim int, pass int, code bigint, node bigint, bit double")
    order = ["pass", "label", "dim", "code", "node"]
    pieces = coded.repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)
    pieces = pieces.select("label", "dim", F.xxhash64("pass", "label", "dim").alias("run"), "code", "bit")
    steps = pieces.mapInArrow(measure, "label string, dim int, step int, n bigint")
    steps = steps.groupBy("label", "dim", "step").agg(F.sum("n").alias("n"))
    missed = lambda passes: F.sum(F.col("n") * F.pow(1 - F.pow(F.lit(2.0), -F.col("step") / 4), F.lit(passes))) / F.sum("n")
    tried, passes = [], least
    while passes <= MOST_PASSES:
        tried.append(passes)
        passes = math.ceil(passes * 1.2)
    enough = F.coalesce(*[F.when(missed(p) <= MISS, F.lit(p)) for p in tried], F.lit(None).cast("int"))
    return steps.groupBy("label", "dim").agg(enough.alias("passes"))


_STEPS = ["label", "dim", "step", "n"]


def window_links(rows: DataFrame, threshold: float, window: int) -> DataFrame:
    """Links ``(a, b)`` that the passes find; links that connect nothing new are left out.

    ``rows``: ``node``, ``label``, ``dim``, ``v``, ``mean`` and the number of ``passes``.
    """

    def project(batches):
        for batch in batches:
            kinds = np.stack([np.asarray(batch.column(2)), np.asarray(batch.column(5))], axis=1)
            for dim, passes in np.unique(kinds, axis=0).tolist():
                part = batch.filter(pa.array((kinds == (dim, passes)).all(axis=1)))
                codes = codes_of(_unit(_matrix(part.column(3))) - _matrix(part.column(4)), passes)
                ends = pa.array(np.arange(0, len(part) * passes + 1, passes, dtype=np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(codes.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*part.columns[:4], lists], names=["node", "label", "dim", "v", "codes"])

    source = rows.select("node", "label", "dim", "v", "mean", "passes")
    coded = source.mapInArrow(project, "node bigint, label string, dim int, v array<double>, codes array<bigint>")
    passed = coded.select("node", "label", "dim", "v", F.posexplode("codes").alias("pass", "code"))
    order = ["pass", "label", "dim", "code", "node"]
    run = F.xxhash64("pass", "label", "dim").alias("run")
    pieces = passed.repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)
    near = _neighbours(pieces.select(*order[:4], run, "node", "v"), threshold, window)
    found = store(near, "vector_windows")
    # rows at the ends of the pieces of the order meet their neighbours in the next piece
    ends = found.where("v IS NOT NULL").select(*order[:4], F.col("a").alias("node"), "v").distinct()
    ends = ends.repartition("pass", "label", "dim").sortWithinPartitions(*order)
    across = _neighbours(ends.select(*order[:4], run, "node", "v"), threshold, 2 * window)
    return found.where("v IS NULL").select("a", "b").unionByName(across.where("v IS NULL").select("a", "b"))


def block_links(rows: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links ``(a, b)`` of labels that are compared exactly, a forest for each pair of blocks."""
    sizes = rows.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("members"))
    known = rows.select("node", "label", "dim", "v").join(sizes, ["label", "dim"])
    known = known.withColumn("run", F.xxhash64("label", "dim"))
    pairs = block_pairs(known, "run", "members", "node", block, own_pairs=True).select("run", "bi", "bj", "node", "v")
    pairs = pairs.repartition("run", "bi", "bj").sortWithinPartitions("run", "bi", "bj", "node")

    def link(batches):
        for _, pieces in whole_groups(batches, 3):
            ids = np.concatenate([np.asarray(p.column(3)) for p in pieces])
            unit = _unit(np.concatenate([_matrix(p.column(4)) for p in pieces]))
            a, b = [], []
            for at in range(0, len(ids), 512):
                i, j = np.nonzero(np.triu(unit[at : at + 512] @ unit[at:].T >= threshold, 1))
                left, right = _forest(ids[at + i], ids[at + j])
                a += left
                b += right
            a, b = _forest(np.array(a, np.int64), np.array(b, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return pairs.mapInArrow(link, "a bigint, b bigint")


def found_links(items: DataFrame, threshold: float, passes: int | None, window: int, block: int) -> DataFrame:
    """Links that connect all classes: by passes, or exactly in labels where these are too many."""
    rows = with_mean(items)
    if passes is not None:
        return window_links(rows.withColumn("passes", F.lit(passes)), threshold, window)
    rows = store(rows, "vector_items")
    least = passes_for(largest_label(rows), threshold, window)
    needed = store(passes_needed(rows, threshold, window, least), "vector_passes")
    needed = needed.withColumn("measured", F.lit(True))
    known = rows.join(needed, ["label", "dim"], "left")
    known = known.withColumn("passes", F.when(F.col("measured").isNull(), F.lit(least)).otherwise(F.col("passes")))
    hashed = window_links(known.where("passes IS NOT NULL"), threshold, window)
    if needed.where("passes IS NULL").isEmpty():
        return hashed
    return hashed.unionByName(block_links(known.where("passes IS NULL"), threshold, block))


def _neighbours(ordered: DataFrame, threshold: float, window: int) -> DataFrame:
    """Links of each row with the ``window`` next ones, and the rows at both ends."""
    schema = "a bigint, b bigint, pass int, label string, dim int, code bigint, v array<double>"

    def end_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = batch.columns
        return pa.RecordBatch.from_arrays([c[5], pa.nulls(len(batch), pa.int64()), *c[:4], c[6]], names=_NAMES)

    def compare(batches):
        held: pa.Table | None = None
        seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if seen < window:
                yield end_rows(batch.slice(0, window - seen))
            seen += batch.num_rows
            both = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            both = both.combine_chunks().to_batches()[0]
            yield _window_forest(both, both.num_rows - batch.num_rows, threshold, window)
            held = pa.Table.from_batches([both.slice(max(0, both.num_rows - window))])
        if held is not None:
            yield end_rows(held.combine_chunks().to_batches()[0])

    return ordered.mapInArrow(compare, schema)


_NAMES = ["a", "b", "pass", "label", "dim", "code", "v"]


def _window_forest(batch: pa.RecordBatch, fresh: int, threshold: float, window: int) -> pa.RecordBatch:
    """Links of the rows from ``fresh`` on with the ``window`` rows before each."""
    runs, ids = np.asarray(batch.column(4)), np.asarray(batch.column(5))
    edges = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1], [True]))).tolist()
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start, end in zip(edges[:-1], edges[1:]):
        if end <= fresh or end - start < 2:
            continue
        unit = _unit(_matrix(batch.column(6).slice(start, end - start)))
        for gap in range(1, min(window, end - start - 1) + 1):
            at = np.flatnonzero((unit[gap:] * unit[:-gap]).sum(axis=1) >= threshold) + start
            at = at[at + gap >= fresh]
            a.append(ids[at])
            b.append(ids[at + gap])
    left, right = _forest(np.concatenate(a), np.concatenate(b))
    nulls = [pa.nulls(len(left), t) for t in (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64()), *nulls], names=_NAMES)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list, list]:
    """As many of the links ``(a, b)`` as keep the connections."""
    parent: dict[int, int] = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, right = [], []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q:
            parent[p] = q
            left.append(x)
            right.append(y)
    return left, right


def link_counts(items: DataFrame, classes: DataFrame, threshold: float, block: int) -> DataFrame:
    """``node``, ``links``: vectors of the class that are linked directly, copies counted."""
    sizes = classes.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    members = items.join(classes.join(sizes, "root"), "node")
    pairs = block_pairs(members, "root", "members", "node", block, own_pairs=True)
    rows = pairs.select("root", "bi", "bj", "node", "own", "copies", "v")
    rows = rows.repartition("root", "bi", "bj").sortWithinPartitions("root", "bi", "bj", "node")

    def count(batches):
        for (_, bi, bj), pieces in whole_groups(batches, 3):
            ids, own, copies = (np.concatenate([np.asarray(p.column(i)) for p in pieces]) for i in (3, 4, 5))
            unit = _unit(np.concatenate([_matrix(p.column(6)) for p in pieces]))
            total = np.zeros(len(ids))
            for at in range(0, len(ids), 512):
                near = unit[at : at + 512] @ unit.T >= threshold
                if bi == bj:
                    near[np.arange(len(near)), np.arange(at, at + len(near))] = False
                else:  # pairs inside a block are counted by its own task
                    near &= own[at : at + 512, None] != own[None, :]
                total[at : at + 512] = near @ copies.astype(np.float64)
            links = pa.array(total.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), links], names=["node", "links"])

    return rows.mapInArrow(count, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    passes: int | None = None,
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``df``: ``key``, ``n_links``, ``component_id``, ``kept``.

    ``passes``: as many as each label needs by measurement, if not given.
    """
    prepare(df.sparkSession)
    rows = store(with_node(df, key, vector, label), "vectors")
    items = items_of(rows)
    classes = components(found_links(items, threshold, passes, window, block), "vector_links")
    counts = link_counts(items, classes, threshold, block)
    linked = classes.join(counts, "node", "left")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("key").alias("low"), F.count(F.lit(1)).alias("copies"))
    named = nodes.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_node = named.join(least, "root").select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    some = rows.where("node IS NOT NULL").join(by_node, "node").select("key", "n_links", "component_id")
    none = rows.where("node IS NULL").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    both = some.unionByName(none).withColumn("kept", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)))
    return both.withColumnRenamed("key", key)
