"""Bindings for metric tables and the metric stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith.catalog.registry import Entry, registrar, table
from tunesmith.operators.metrics import epoch_points, epoch_summary, running_loss, running_points, stage_summary
from tunesmith.operators.position import with_position
from tunesmith.session import new_folder
from tunesmith.streaming import metric_windows, read_metric_stream, run_available

ENTRIES: dict[str, Entry] = {}
register = registrar(ENTRIES)

_EPOCHS = ("click", "error", "purchase", "signup", "view")


def _loss_log(spark, sf):
    """Events as a training log: user = run, event type = epoch, rank in time = batch.

    Batches with a value below 10 count as skipped.
    """
    kind = F.col("event_type")
    epoch = F.array_position(F.array(*[F.lit(e) for e in _EPOCHS]), kind) - 1
    events = table(spark, sf, "events").select(
        "event_id", "ts", F.col("user_id").alias("run_id"), epoch.cast("int").alias("epoch"), "value"
    )
    ranked = with_position(events, "event_id", "ts", by=["run_id", "epoch"], pos="i")
    return ranked.select(
        "run_id", "epoch", "i", F.col("value").alias("loss"), (F.col("value") >= 10).alias("used")
    )


_LOG = """SELECT user_id AS run_id,
      list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) - 1 AS epoch,
      row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS i,
      value AS loss, value >= 10 AS used FROM events"""


def _running_sql(divisor: str, keep: str) -> str:
    return f"""WITH log AS ({_LOG}),
        w AS (SELECT *, sum(CASE WHEN used THEN loss ELSE 0 END) OVER s AS total,
                count(*) FILTER (WHERE used) OVER s AS n_used, count(*) OVER (PARTITION BY run_id, epoch) AS n
              FROM log WINDOW s AS (PARTITION BY run_id, epoch ORDER BY i))
        SELECT run_id, epoch::INT AS epoch, i, (epoch * n + i)::BIGINT AS step,
               round(total / {divisor}, 6) AS avg_loss FROM w WHERE used AND {keep}"""


def _rounded_series(df):
    return df.withColumn("avg_loss", F.round("avg_loss", 6))


@register(_running_sql("(i + 1)", "i % 5 = 0 AND i <> 0"))
def mt1_running_loss_seen(spark, sf):
    return _rounded_series(running_loss(_loss_log(spark, sf), "seen", every=5))


@register(_running_sql("n_used", "i % 2 = 0 AND i <> 0"))
def mt1_running_loss_used(spark, sf):
    return _rounded_series(running_loss(_loss_log(spark, sf), "used", every=2))


@register(_running_sql("(i + 1)", "true"))
def mt1_running_loss_every_batch(spark, sf):
    """In chunks of four batches, so that every series crosses chunk borders."""
    return _rounded_series(running_loss(_loss_log(spark, sf), "seen", chunk=4))


@register(
    f"""SELECT run_id, 'Loss/train' AS tag, step, avg_loss AS value
        FROM ({_running_sql('(i + 1)', 'i % 10 = 0 AND i <> 0')})"""
)
def mt1_running_points(spark, sf):
    return running_points(_rounded_series(running_loss(_loss_log(spark, sf), "seen", every=10)))


def _phase_log(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"),
        F.floor((F.dayofmonth("ts") - 1) / 10).cast("int").alias("epoch"),
        F.when(F.get_json_object("props", "$.k").cast("int") < 60, "train")
        .otherwise("val")
        .alias("phase"),
        F.col("event_type").alias("stage"),
        F.col("value").alias("loss"),
        (F.col("value") >= 10).alias("used"),
    )


_PHASES = """SELECT user_id AS run_id, ((day(ts) - 1) // 10)::INT AS epoch,
      CASE WHEN (props->>'$.k')::INT < 60 THEN 'train' ELSE 'val' END AS phase,
      event_type AS stage, value AS loss, value >= 10 AS used FROM events"""


@register(
    f"""SELECT run_id, epoch, phase,
          round(coalesce(sum(loss) FILTER (WHERE used), 0) / count(*), 6) AS loss,
          count(*) AS n_batches, count(*) FILTER (WHERE used) AS n_used
        FROM ({_PHASES}) GROUP BY run_id, epoch, phase"""
)
def mt2_epoch_summary_loader(spark, sf):
    rows = epoch_summary(_phase_log(spark, sf), "loader")
    return rows.withColumn("loss", F.round("loss", 6))


@register(
    f"""SELECT run_id, CASE phase WHEN 'train' THEN 'Loss/train_epoch' ELSE 'Loss/val' END AS tag,
          epoch::BIGINT AS step,
          round(sum(loss) FILTER (WHERE used) / nullif(count(*) FILTER (WHERE used), 0), 6) AS value
        FROM ({_PHASES}) GROUP BY run_id, epoch, phase"""
)
def mt2_epoch_points_used(spark, sf):
    points = epoch_points(epoch_summary(_phase_log(spark, sf), "used"))
    return points.withColumn("value", F.round("value", 6))


@register(
    f"""WITH s AS (SELECT run_id, stage, epoch, phase, avg(loss) AS loss FROM ({_PHASES})
                   GROUP BY run_id, stage, epoch, phase)
        SELECT run_id, stage,
          round(arg_max(loss, epoch) FILTER (WHERE phase = 'train'), 6) AS train_loss,
          round(arg_max(loss, epoch) FILTER (WHERE phase = 'val'), 6) AS val_loss
        FROM s GROUP BY run_id, stage"""
)
def mt3_stage_summary(spark, sf):
    means = _phase_log(spark, sf).groupBy("run_id", "stage", "epoch", "phase").agg(
        F.avg("loss").alias("loss")
    )
    rows = stage_summary(means)
    return rows.select(
        "run_id", "stage", *[F.round(c, 6).alias(c) for c in ("train_loss", "val_loss")]
    )


def _metric_points(events, *more):
    return events.select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("tag"), "value", "ts", *more
    )


def _window_columns(df):
    return df.select(
        "run_id",
        "tag",
        F.date_format("window_start", "yyyy-MM-dd").alias("day"),
        "n",
        F.round("mean", 6).alias("mean"),
        "low",
        "high",
    )


_WINDOWS = """SELECT user_id AS run_id, event_type AS tag, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day,
      count(*) AS n, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high
    FROM events {where} GROUP BY user_id, event_type, date_trunc('day', ts)"""


@register(_WINDOWS.format(where=""))
def st1_metric_windows_batch(spark, sf):
    return _window_columns(metric_windows(_metric_points(table(spark, sf, "events"))))


@register(
    _WINDOWS.format(
        where="""WHERE date_trunc('day', ts) + INTERVAL 1 DAY
                 <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""
    )
)
def st1_metric_stream(spark, sf):
    """The stream worked off to its end: all windows closed by the watermark."""
    schema = table(spark, sf, "events").schema
    # a pattern, so that a single file and a folder of files both read as a stream
    events = read_metric_stream(spark, f"{sf}/event[s].parquet", schema)
    folder = new_folder(spark, "metric-windows")
    closed = run_available(
        metric_windows(_metric_points(events)), f"{folder}/out", f"{folder}/checkpoint"
    )
    return _window_columns(closed)


_CLOSED = """WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""


@register(_WINDOWS.format(where=_CLOSED))
def st1_metric_stream_once(spark, sf):
    """The first half of the points is delivered and worked off; then the job starts again
    and finds all points, the first half once more."""
    events = table(spark, sf, "events")
    points = _metric_points(events, F.col("event_id").alias("step"))
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    folder = new_folder(spark, "metric-deliveries")
    points.where(F.col("ts") < (low + (high - low) / 2 if low else None)).write.parquet(f"{folder}/in")
    for last in (False, True):
        stream = read_metric_stream(spark, f"{folder}/in", points.schema)
        closed = run_available(metric_windows(stream, once=True), f"{folder}/out", f"{folder}/checkpoint")
        if not last:
            points.write.mode("append").parquet(f"{folder}/in")
    return _window_columns(closed)
