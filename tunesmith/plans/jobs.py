"""The jobs a training run asks for, from stored inputs to stored outputs.

Stages that call a model are written before anything reads them, so a retry
further down never calls the model again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith import fixed_values as V
from tunesmith.functions.text import clean_completion
from tunesmith.operators.align import fill_completions, missing_completions, zip_join
from tunesmith.operators.batches import Stage, curriculum_plan, epoch_plan, stages
from tunesmith.operators.completions import CompletionCache, resumable_completions
from tunesmith.operators.criteria import (
    centroids,
    criteria_dataset,
    default_criteria,
    default_exemplars,
    embed,
    revision_dataset,
)
from tunesmith.operators.inference import PROFILES, DecodeProfile, complete, initial_prompts, initial_responses
from tunesmith.operators.position import range_split, seeded_prompts, with_position
from tunesmith.operators.scoring import evaluate
from tunesmith.operators.tokens import preference_examples, revision_examples, sft_examples
from tunesmith.session import store
from tunesmith.sources.readers import append_shards, read_completions, read_records
from tunesmith.sources.writers import write_records


def prepare_criteria(
    prompts: DataFrame,
    loader: Callable,
    out: str,
    exemplars: DataFrame | None = None,
    criteria: DataFrame | None = None,
) -> None:
    """``(pos, prompt)`` -> stored ``(pos, x, y, c)``.

    ``exemplars`` is ``(ord, category, example)``; both tables default to the
    built-in categories.
    """
    spark = prompts.sparkSession
    exemplars = default_exemplars(spark) if exemplars is None else exemplars
    criteria = default_criteria(spark) if criteria is None else criteria
    vectors = store(embed(prompts, loader, text="prompt"), "prompt-vectors")
    means = centroids(store(embed(exemplars, loader, text="example"), "example-vectors"))
    write_records(criteria_dataset(vectors, means, criteria), out)


def make_initial_responses(
    spark: SparkSession,
    inputs: Mapping[str, str],
    loader: Callable[[DecodeProfile], Callable],
    out: str,
    work: str | None = None,
) -> None:
    """``{split: path of x/y/c records}`` -> completions, one folder per split.

    With a folder ``work`` finished calls are kept there, and a job that is started again
    with the same folder goes on where it ended.
    """
    splits = {name: read_records(spark, path) for name, path in inputs.items()}
    if work is None:
        made = initial_responses(splits, loader)
    else:
        made = resumable_completions(initial_prompts(splits), loader, PROFILES["initial"], work, ["split", "pos"])
    write_records(made, out, split="split")


@dataclass(frozen=True)
class StageFiles:
    """Inputs of one stage: records, first replies, and shards of revisions in order."""

    records: str
    first_replies: str
    revisions: Sequence[str]


def revision_stage(
    spark: SparkSession,
    records: str,
    first_replies: str,
    revisions: Sequence[str],
    vocab: DataFrame,
    epochs: int,
    batch_size: int,
    out: str,
    max_samples: int | None = None,
    seed: int = 0,
) -> tuple[str, str]:
    """One stage of revision training: token rows and the order to read them in.

    Returns the paths of the two tables (``examples``, ``plan``); ``example`` in the
    plan is ``pos`` of the examples.
    """
    examples, plan = f"{out}/examples", f"{out}/plan"
    files = StageFiles(records, first_replies, revisions)
    ids = _write_examples(spark, files, vocab, max_samples, examples)
    epoch_plan(ids, "example", epochs, batch_size, seed).write.partitionBy("epoch").parquet(plan)
    return examples, plan


def revision_curriculum(
    spark: SparkSession,
    files: Mapping[str, StageFiles],
    vocab: DataFrame,
    batch_size: int,
    out: str,
    validation: tuple[DataFrame, DataFrame] | None = None,
    run: Sequence[Stage] | None = None,
    max_samples: int | None = None,
    seed: int = 0,
) -> dict[str, str]:
    """All stages of revision training, one after another, and their validation rows.

    ``files`` names the inputs of every stage in ``run`` (all built-in stages if not
    given).  ``validation`` is ``(pos, prompt)`` and ``(pos, completion)``, cut to the
    shorter side; its rows are the same for every stage and keep their order.

    Returns the paths of the tables: ``plan`` (``curriculum_plan``; ``example`` is ``pos``
    of the stage's examples), ``validation`` if there is one, and the examples of each
    stage under ``examples/<name>``.
    """
    run = list(run or stages())
    missing = [s.name for s in run if s.name not in files]
    if missing:
        raise ValueError(f"no files for stages: {', '.join(missing)}")
    paths, keys = {"plan": f"{out}/plan"}, {}
    for stage in run:
        path = paths[f"examples/{stage.name}"] = f"{out}/examples/{stage.name}"
        keys[stage.name] = _write_examples(spark, files[stage.name], vocab, max_samples, path)
    plan = curriculum_plan(keys, "example", batch_size, run, seed)
    plan.write.partitionBy("stage_ord", "epoch").parquet(paths["plan"])
    if validation is not None:
        paths["validation"] = f"{out}/validation"
        pairs = zip_join(validation[0].select("pos", "prompt"), validation[1].select("pos", "completion"))
        revision_examples(pairs, vocab).write.parquet(paths["validation"])
    return paths


def _write_examples(
    spark: SparkSession, files: StageFiles, vocab: DataFrame, max_samples: int | None, path: str
) -> DataFrame:
    """Writes the token rows of a stage; gives their positions as ``example``."""
    pairs = revision_dataset(
        read_records(spark, files.records, max_samples),
        read_completions(spark, files.first_replies),
        append_shards([read_completions(spark, p) for p in files.revisions]),
        max_samples,
    )
    revision_examples(pairs, vocab).write.parquet(path)
    return spark.read.parquet(path).select(F.col("pos").alias("example"))


def sft_split(
    turns: DataFrame, vocab: DataFrame, bounds: Mapping = V.SFT_BOUNDS
) -> dict[str, DataFrame]:
    """Chat corpus in long form -> token rows per positional split.

    Positions come from the conversation ids alone and are written once, because
    each split reads them.
    """
    ids = turns.select("conv_id").distinct()
    placed = store(with_position(ids, "conv_id"), "conversation-positions")
    rows = sft_examples(turns, vocab).join(placed, "conv_id")
    return range_split(rows, bounds)


def preference_split(
    pairs: DataFrame, vocab: DataFrame, key: str = "conv_id", bounds: Mapping = V.PREFERENCE_BOUNDS
) -> dict[str, DataFrame]:
    """Preference corpus ``(key, chosen, rejected)`` -> token rows per split."""
    placed = store(with_position(pairs.select(key), key), "preference-positions")
    rows = preference_examples(pairs, vocab, key).join(placed, key)
    return range_split(rows, bounds)


def compare_models(
    prompts: DataFrame,
    models: Mapping[str, Callable[[DecodeProfile], Callable]],
    profiles: Mapping[str, DecodeProfile],
    score: Callable[[DataFrame], DataFrame],
    prefer_a_on_tie: bool = False,
    n: int = V.EVAL_SAMPLES,
    seed: int = V.EVAL_SEED,
    cache: DataFrame | CompletionCache | None = None,
) -> DataFrame:
    """Sample prompts, complete them with two models, score, and compare.

    ``prompts`` is ``(prompt_id, prompt)``; the first entry of ``models`` is side A.
    Completions found in ``cache`` are used instead of calling the model.  A
    ``CompletionCache`` also keeps the ones that are made here; a table is only read.
    """
    sample = store(seeded_prompts(prompts, "prompt_id", n, seed), "evaluation-prompts")
    sides = []
    for name, loader in models.items():
        profile = profiles[name]
        if isinstance(cache, CompletionCache):
            kept = cache.fill(sample, loader, name, profile)
            sides.append(kept.select("prompt_id", clean_completion(F.col("completion")).alias("completion")))
            continue
        wanted = sample.withColumn("model_id", F.lit(name)).withColumn(
            "decode_hash", F.lit(profile.key)
        )
        todo = wanted if cache is None else missing_completions(wanted, cache)
        fresh = store(complete(todo, loader, profile), "completions")
        made = fresh if cache is None else fill_completions(wanted, cache, fresh)
        sides.append(
            made.select("prompt_id", clean_completion(F.col("completion")).alias("completion"))
        )
    return evaluate(sample, sides[0], sides[1], score, prefer_a_on_tie)

