"""Windowed roll-up of a live metric table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunesmith.schemas import METRICS

#: What makes two deliveries the same point.
POINT = ("run_id", "tag", "step")


def read_metric_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = METRICS,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The metric table (Parquet, appended to) as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def each_point_once(points: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Points ``(run_id, tag, step, ts, ..)`` without those that were delivered before.

    Works on a stream and on a table.  A point is known by ``POINT``; a stream keeps these
    keys in its state until the watermark has passed the point's time by ``watermark``, and
    a repeat that comes later is late itself.  So a point with its own time counts once,
    however often its file is delivered or the job restarted, and the state does not grow
    with the stream.  Of points that differ under one key, a table keeps the earliest (then
    the smallest value), a stream the first to arrive.
    """
    timed = points.withColumn("ts", F.col("ts").cast("timestamp"))
    if timed.isStreaming:
        return timed.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(list(POINT))
    rest = ["ts", *[c for c in timed.columns if c not in ("ts", *POINT)]]
    first = timed.groupBy(*POINT).agg(F.min(F.struct(*[f"`{c}`" for c in rest])).alias("_first"))
    return first.select(*POINT, "_first.*").select(*[f"`{c}`" for c in timed.columns])


def metric_windows(
    points: DataFrame, window: str = "1 day", watermark: str = "1 hour", once: bool = False
) -> DataFrame:
    """``(run_id, tag, value, ts)`` -> statistics per run, tag and time window.

    Works on a stream and on a table.  On a stream a window is given out once, when
    the watermark has passed its end; rows that come later than that are dropped.
    ``once``: points have a ``step``, and repeated ones count once (``each_point_once``).
    """
    timed = points.withColumn("ts", F.col("ts").cast("timestamp"))
    if once:
        timed = each_point_once(timed, watermark)
    elif timed.isStreaming:
        timed = timed.withWatermark("ts", watermark)
    return (
        timed.groupBy("run_id", "tag", F.window("ts", window).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("value").alias("mean"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
        .select(
            "run_id",
            "tag",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "n",
            "mean",
            "low",
            "high",
        )
    )


def run_available(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Work off what is there, append the closed windows to ``out``, and read it.

    Offsets and state live in ``checkpoint``; a later call goes on from there.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)
