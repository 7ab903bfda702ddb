"""Bulk generation as table jobs.

Models are plug-ins: ``loader(profile)`` is called once per task and gives back a
function from a list of prompts to a list of completions.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import asdict, dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith import fixed_values as V
from tunesmith.functions.text import text_or_none_word
from tunesmith.operators.align import missing_responses, request_id
from tunesmith.operators.tokens import truncate_prompts
from tunesmith.schemas import REPLY


@dataclass(frozen=True)
class DecodeProfile:
    """Decoding settings that are handed to the plug-in, which applies them."""

    max_new_tokens: int
    repetition_penalty: float = 1.0
    stop: str | None = None
    decay_start: int | None = None
    decay_factor: float | None = None
    stop_ids: tuple[int, ...] = ()

    @property
    def key(self) -> str:
        """Stable hash, the ``decode_hash`` of cached completions."""
        return hashlib.md5(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


# The decoding settings of each use.
PROFILES = {
    "instruct": DecodeProfile(590, 1.0),
    "sft": DecodeProfile(590, 1 + 1e-5),
    "eval_sft": DecodeProfile(1024, 1 + 1e-5, V.END, 819, 1.0001),
    "eval_dpo": DecodeProfile(1024, 1.15, V.END, 819, 1.0001),
    "student": DecodeProfile(512, 1.12, V.END, 358, 1.1),
    "initial": DecodeProfile(250, 1.22, stop_ids=(151465,)),
}

Generator = Callable[[list[str]], list[str]]


def complete(
    df: DataFrame,
    loader: Callable[[DecodeProfile], Generator],
    profile: DecodeProfile,
    prompt: str = "prompt",
    completion: str = "completion",
    batch_size: int = 32,
) -> DataFrame:
    """Add a completion per row.  Keys travel along, so no order has to be kept."""
    schema = df.drop(completion).withColumn(completion, F.lit("")).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = loader(profile)
        for frame in frames:
            prompts = frame[prompt].tolist()
            made: list[str] = []
            for i in range(0, len(prompts), batch_size):
                made.extend(generate(prompts[i : i + batch_size]))
            yield frame.assign(**{completion: made})

    return df.mapInPandas(run, schema)


def initial_prompts(splits: Mapping[str, DataFrame]) -> DataFrame:
    """``{split: (pos, x, y)}`` -> ``(split, pos, prompt)``."""
    parts = [
        frame.select(F.lit(name).alias("split"), "pos", text_or_none_word(F.col("x")).alias("prompt"))
        for name, frame in splits.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def initial_responses(
    splits: Mapping[str, DataFrame],
    loader: Callable[[DecodeProfile], Generator],
    profile: DecodeProfile = PROFILES["initial"],
) -> DataFrame:
    """``{split: (pos, x, y)}`` -> ``(split, pos, prompt, completion)`` in one model pass."""
    return complete(initial_prompts(splits), loader, profile)


# --- batch-inference files -------------------------------------------------------


def batch_requests(
    prompts: DataFrame,
    pos: str = "pos",
    prompt: str = "prompt",
    model: str = V.REQUEST_MODEL,
    system: str = V.DEFAULT_SYSTEM,
    max_tokens: int = V.REQUEST_MAX_TOKENS,
) -> DataFrame:
    """``(pos, prompt)`` -> ``(custom_id, value)``: one JSON request line per prompt."""
    cut = truncate_prompts(prompts.select(pos, prompt), prompt)
    message = lambda role, text: F.struct(
        F.lit(role).alias("role"), text.alias("content")
    )
    body = F.struct(
        F.lit(model).alias("model"),
        F.array(message("system", F.lit(system)), message("user", F.col(prompt))).alias("messages"),
        F.lit(max_tokens).alias("max_tokens"),
        F.lit(V.REQUEST_TEMPERATURE).alias("temperature"),
        F.array(F.lit(V.END)).alias("stop"),
        F.lit(V.REQUEST_FREQUENCY_PENALTY).alias("frequency_penalty"),
        F.lit(V.REQUEST_PRESENCE_PENALTY).alias("presence_penalty"),
    )
    line = F.struct(
        request_id(pos).alias("custom_id"),
        F.lit(V.REQUEST_METHOD).alias("method"),
        F.lit(V.REQUEST_URL).alias("url"),
        body.alias("body"),
    )
    return cut.select(request_id(pos).alias("custom_id"), F.to_json(line).alias("value"))


def write_requests(requests: DataFrame, path: str, max_lines: int = 50_000) -> None:
    """Request files of at most ``max_lines`` lines each, the unit of one upload."""
    requests.select("value").write.option("maxRecordsPerFile", max_lines).text(path)


def read_reply_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Reply files -> ``(line, value)``; ``line`` orders by file, block, and line."""
    return spark.read.text(path).select(
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("nth"),
        ).alias("line"),
        "value",
    )


def parse_replies(lines: DataFrame) -> DataFrame:
    """``(line, value)`` -> ``(line, value, custom_id, content)``; nulls where unreadable."""
    reply = F.from_json("value", REPLY)
    return lines.withColumn("_r", reply).select(
        "line",
        "value",
        F.col("_r.custom_id").alias("custom_id"),
        F.try_element_at(F.col("_r.response.body.choices"), F.lit(1))["message"]["content"].alias(
            "content"
        ),
    )


def batch_responses(lines: DataFrame) -> DataFrame:
    """One ``(custom_id, content)`` per id; of repeated ids the last line counts."""
    good = parse_replies(lines).where("custom_id IS NOT NULL AND content IS NOT NULL")
    return good.groupBy("custom_id").agg(F.max_by("content", "line").alias("content"))


def reply_issues(prompts: DataFrame, lines: DataFrame, pos: str = "pos") -> DataFrame:
    """``(issue, custom_id, n)`` for missing, repeated and unreadable replies."""
    parsed = parse_replies(lines).select("custom_id", "content")
    readable = parsed.where("custom_id IS NOT NULL AND content IS NOT NULL")
    missing = missing_responses(prompts.select(pos), readable, pos).select(
        F.lit("missing").alias("issue"), "custom_id", F.lit(1).cast("bigint").alias("n")
    )
    repeated = (
        readable.groupBy("custom_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.lit("repeated").alias("issue"), "custom_id", "n")
    )
    unreadable = (
        parsed.where("custom_id IS NULL OR content IS NULL")
        .groupBy("custom_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("unreadable").alias("issue"), "custom_id", "n")
    )
    return missing.unionByName(repeated).unionByName(unreadable)
