"""Structured Streaming jobs."""

from tunesmith.streaming.metric_stream import each_point_once, metric_windows, read_metric_stream, run_available

__all__ = ["each_point_once", "metric_windows", "read_metric_stream", "run_available"]
