"""Readers for prompt, record, completion and corpus files.

All formats are read in splits: JSON lines at line ends, JSON arrays as ``arrays`` says.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunesmith.schemas import PROMPTS
from tunesmith.session import store
from tunesmith.sources.arrays import array_elements


def read_prompts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines with a ``prompt`` field -> ``(pos, prompt)`` in file order.

    Files are read in splits.  Rows are numbered within their split while it is read;
    the rows of each split are counted, and a running sum over the splits (one short row
    each, in path order) puts them behind one another.  A line that is no JSON fails the
    job.
    """
    placed = _placed_lines(spark, path)
    record = F.from_json("value", PROMPTS, {"mode": "FAILFAST"})
    return placed.select("pos", record["prompt"].alias("prompt"))


def _placed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines that are not blank, with their place in their file (``i``) and in all (``pos``)."""
    lines = spark.read.text(path).where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        F.monotonically_increasing_id().alias("i"),
    )
    splits = lines.groupBy("file", "block").agg(F.min("i").alias("low"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.orderBy("file", "block")) - F.col("n")
    here = F.sum("n").over(W.partitionBy("file").orderBy("block")) - F.col("n")
    splits = splits.select("file", "block", "low", before.alias("first"), here.alias("here"))
    placed = lines.join(splits, ["file", "block"])
    at = F.col("i") - F.col("low")
    return placed.select("file", (F.col("first") + at).alias("pos"), (F.col("here") + at).alias("i"), "value")


def read_json_arrays(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files that each hold one JSON array, or JSON lines -> ``(pos BIGINT, value VARIANT)``.

    ``pos`` runs through all files in path order.  A file of any size is read by many
    tasks; its structure is found, and its elements are stored, when this is called, and
    each element is parsed once, so only the single element is bound by the variant size
    limit.  A file that starts with a bracket is one array; any other is read as JSON lines.  An empty file holds nothing; one that is neither fails with
    its name.
    """
    elements, sizes, names, others = array_elements(spark, path)
    found = elements.select("file", "i", "text")
    if others:
        lines = store(_placed_lines(spark, [names[f] for f in others]).select(F.xxhash64("file").alias("file"), "i", F.col("value").alias("text")), "lines")
        sizes = sizes | {r.file: r.n for r in lines.groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()}
        found = found.unionByName(lines)
    first, offsets = 0, []
    for file in sorted(sizes, key=names.get):  # one short row per file
        offsets.append((file, first, names[file]))
        first += sizes[file]
    if not offsets:
        return found.select(F.lit(0).cast("bigint").alias("pos"), F.try_parse_json("text").alias("value")).limit(0)
    placed = found.join(spark.createDataFrame(offsets, "file BIGINT, first BIGINT, name STRING"), "file")
    broken = F.raise_error(F.concat(F.lit("neither a JSON array nor JSON lines: "), F.col("name")))
    value = F.try_parse_json("text")
    return placed.select(
        (F.col("first") + F.col("i")).alias("pos"), F.when(value.isNull(), broken.cast("variant")).otherwise(value).alias("value")
    )


def read_records(
    spark: SparkSession, path: str | list[str], max_samples: int | None = None
) -> DataFrame:
    """``{x, y, c}`` objects -> ``(pos, x, y, c)``.

    Objects that carry their own ``pos``, as the record writer's do, keep it.
    """
    rows = _own_positions(read_json_arrays(spark, path))
    if max_samples is not None:
        rows = rows.where(F.col("pos") < max_samples)
    fields = [F.try_variant_get("value", f"$.{k}", "string").alias(k) for k in "xyc"]
    return rows.select("pos", *fields)


def _own_positions(rows: DataFrame) -> DataFrame:
    own = F.try_variant_get("value", "$.pos", "bigint")
    return rows.withColumn("pos", F.coalesce(own, F.col("pos")))


def read_completions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Arrays of strings or of ``{prompt, completion}`` -> ``(pos, prompt, completion)``.

    The form is decided element by element, so mixed files read as well.  An empty
    array gives no rows.
    """
    rows = _own_positions(read_json_arrays(spark, path)).withColumn(
        "is_object", F.schema_of_variant("value").startswith("OBJECT")
    )
    return rows.select(
        "pos",
        F.when(F.col("is_object"), F.try_variant_get("value", "$.prompt", "string")).alias(
            "prompt"
        ),
        F.when(F.col("is_object"), F.try_variant_get("value", "$.completion", "string"))
        .otherwise(F.try_variant_get("value", "$", "string"))
        .alias("completion"),
    )


def append_shards(shards: Sequence[DataFrame | None], pos: str = "pos") -> DataFrame:
    """Put densely numbered shards behind one another; ``None`` shards are skipped."""
    present = [s for s in shards if s is not None]
    tagged = [s.withColumn("shard", F.lit(i)) for i, s in enumerate(present)]
    rows = reduce(lambda a, b: a.unionByName(b), tagged)
    counts = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    # one row per element of ``shards``
    offsets = counts.select(
        "shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("first")
    )
    return (
        rows.join(F.broadcast(offsets), "shard")
        .withColumn(pos, F.col(pos) + F.col("first"))
        .drop("shard", "first")
    )


def read_corpus(
    spark: SparkSession, root: str, name: str, split: str, revision: str
) -> DataFrame:
    """One pinned split of a stored corpus.

    ``root`` is partitioned by ``name``, ``split`` and ``revision``; the three
    filters are partition filters, so no other folder is listed or read.
    """
    return (
        spark.read.parquet(root)
        .where(
            (F.col("name") == name)
            & (F.col("split") == split)
            & (F.col("revision") == revision)
        )
        .drop("name", "split", "revision")
    )
