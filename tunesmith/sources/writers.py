"""Writers for record files and the metric table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_records(
    df: DataFrame,
    path: str,
    split: str | None = None,
    fmt: str = "json",
    max_rows_per_file: int = 0,
) -> None:
    """Write rows as JSON lines (or Parquet), one folder per value of ``split``."""
    writer = df.write.format(fmt).option("maxRecordsPerFile", max_rows_per_file)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    if split:
        writer = writer.partitionBy(split)
    writer.save(path)


def write_json_arrays(
    df: DataFrame, path: str, pos: str = "pos", rows_per_file: int = 10_000
) -> None:
    """Write rows as JSON array files of at most ``rows_per_file`` elements each.

    A file holds one run of consecutive positions, so ``read_json_arrays`` gives
    back the same numbering; no array ever grows beyond one file's worth of rows.
    A single ``value`` column is written as an array of bare values.
    """
    fields = [c for c in df.columns if c != pos]
    item = F.col("value") if fields == ["value"] else F.struct(*fields)
    runs = df.groupBy(F.floor(F.col(pos) / rows_per_file).alias("run")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("pos"), item.alias("item")))).alias(
            "items"
        )
    )
    (
        runs.select(
            F.lpad(F.col("run").cast("string"), 12, "0").alias("shard"),
            F.to_json(F.col("items.item"), {"ignoreNullFields": "false"}).alias("value"),
        )
        .write.partitionBy("shard")
        .text(path)
    )


def append_metrics(points: DataFrame, path: str, job: str | None = None) -> None:
    """Append ``(run_id, tag, step, value, ts)`` points; one folder per tag.

    With ``job``, the points of that job are one folder, which a second try replaces, so a
    retried job adds nothing; the table then has a column ``job``.  A table is written
    either with jobs or without.
    """
    if job is None:
        points.write.mode("append").partitionBy("tag").parquet(path)
        return
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_.-]*", job):
        raise ValueError(f"job: {job!r}")
    points.write.mode("overwrite").partitionBy("tag").parquet(f"{path}/job={job}")
