"""Readers and writers."""

from tunesmith.sources.readers import (
    append_shards,
    read_completions,
    read_corpus,
    read_json_arrays,
    read_prompts,
    read_records,
)
from tunesmith.sources.writers import append_metrics, write_json_arrays, write_records

__all__ = [
    "append_metrics",
    "append_shards",
    "read_completions",
    "read_corpus",
    "read_json_arrays",
    "read_prompts",
    "read_records",
    "write_json_arrays",
    "write_records",
]
