"""Metric points that are delivered more than once."""

import pytest
from pyspark.sql import functions as F

from tunesmith.schemas import METRICS
from tunesmith.sources.writers import append_metrics
from tunesmith.streaming import each_point_once, metric_windows, read_metric_stream, run_available


def points(spark, days, factor=1.0):
    rows = spark.sql(f"SELECT explode(sequence(0, {days * 24 - 1})) AS h")
    return rows.select(
        (F.col("h") % 3).alias("run_id"), F.lit("loss").alias("tag"), F.col("h").alias("step"),
        (F.col("h") * factor).alias("value"),
        (F.timestamp_seconds(F.lit(1_700_006_400) + F.col("h") * 3600)).alias("ts"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in METRICS])


def test_repeated_files_and_a_restart(spark, tmp_path):
    source, out, kept = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    stream = lambda: metric_windows(read_metric_stream(spark, source, max_files_per_trigger=1), once=True)
    points(spark, 3).coalesce(1).write.parquet(source)
    points(spark, 3).coalesce(1).write.mode("append").parquet(source)
    run_available(stream(), out, kept)
    points(spark, 6).coalesce(1).write.mode("append").parquet(source)
    points(spark, 6).coalesce(1).write.mode("append").parquet(source)
    got = run_available(stream(), out, kept)
    whole = metric_windows(points(spark, 6))
    closed = whole.where(F.col("window_end") < F.lit(1_700_006_400 + 6 * 86400 - 2 * 3600).cast("timestamp"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, closed.collect()))
    assert got.count() == 15


def test_a_table_keeps_the_earliest(spark):
    twice = points(spark, 1).unionByName(points(spark, 1)).unionByName(points(spark, 1, 2.0))
    once = each_point_once(twice)
    assert once.columns == twice.columns
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, points(spark, 1).collect()))
    assert each_point_once(twice.limit(0)).count() == 0


def test_a_retried_job_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for job in ("a", "b", "b"):
        append_metrics(points(spark, 1), path, job)
    stored = spark.read.parquet(path)
    assert {r["job"]: r["count"] for r in stored.groupBy("job").count().collect()} == {"a": 24, "b": 24}
    with pytest.raises(ValueError):
        append_metrics(points(spark, 1), path, "a/b")
