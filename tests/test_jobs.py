"""Whole jobs from stored inputs to stored outputs."""

import json

import pytest
from pyspark.sql import functions as F
from stand_ins import echo_generator, length_scorer, letter_embedder

from tunesmith.operators.inference import PROFILES
from tunesmith.operators.scoring import parse_rewards, score_with
from tunesmith.operators.tokens import build_vocab
from tunesmith.operators.batches import Stage
from tunesmith.plans import (
    StageFiles,
    compare_models,
    make_initial_responses,
    prepare_criteria,
    preference_split,
    revision_curriculum,
    revision_stage,
    sft_split,
)
from tunesmith.sources.readers import read_completions, read_prompts, read_records


def arrays(tmp_path, **files):
    for name, value in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
    return {name: str(tmp_path / f"{name}.json") for name in files}


def test_prepare_criteria_with_own_and_built_in_categories(spark, tmp_path):
    prompts = spark.createDataFrame([(0, "aaaa b"), (1, "zz z")], "pos BIGINT, prompt STRING")
    exemplars = spark.createDataFrame([(0, "A", "aa"), (0, "A", "aab"), (1, "Z", "zzz")], "ord INT, category STRING, example STRING")
    criteria = spark.createDataFrame([(0, "A", "be A"), (1, "Z", "be Z")], "ord INT, category STRING, criterion STRING")
    prepare_criteria(prompts, letter_embedder, str(tmp_path / "own"), exemplars, criteria)
    got = spark.read.json(str(tmp_path / "own")).orderBy("pos").select("pos", "x", "y", "c").collect()
    assert [tuple(r) for r in got] == [(0, "aaaa b", "", "be A"), (1, "zz z", "", "be Z")]
    prepare_criteria(prompts, letter_embedder, str(tmp_path / "default"))
    assert spark.read.json(str(tmp_path / "default")).where("length(c) > 50").count() == 2


def test_initial_responses(spark, tmp_path):
    paths = arrays(tmp_path, short=[{"x": "q1", "y": "", "c": "c"}], test=[{"x": None, "y": "", "c": "c"}, {"x": "q3"}])
    make_initial_responses(spark, paths, echo_generator, str(tmp_path / "out"))
    got = spark.read.json(str(tmp_path / "out")).select("split", "pos", "prompt").collect()
    assert {tuple(r) for r in got} == {("short", 0, "q1"), ("test", 0, "None"), ("test", 1, "q3")}


def test_revision_stage(spark, tmp_path):
    paths = arrays(
        tmp_path,
        records=[{"x": f"q{i}", "y": "", "c": "c"} for i in range(5)],
        first=[f"r{i}" for i in range(5)],
        rev1=["new0", "new1"],
        rev2=["new2", "new3"],
    )
    vocab = build_vocab(spark.createDataFrame([("new",)], "text STRING"), 10)
    examples, plan = revision_stage(
        spark, paths["records"], paths["first"], [paths["rev1"], paths["rev2"]], vocab, 2, 2,
        str(tmp_path / "stage"), max_samples=3,
    )
    assert spark.read.parquet(examples).where("valid").count() == 3
    sizes = spark.read.parquet(plan).groupBy("epoch").agg(F.count_distinct("example").alias("n"))
    assert sorted(tuple(r) for r in sizes.collect()) == [(0, 3), (1, 3)]


def test_revision_curriculum(spark, tmp_path):
    files = {}
    for name, n in (("short", 5), ("med", 3), ("long", 1)):
        paths = arrays(tmp_path, **{f"{name}-records": [{"x": f"q{i}", "y": "", "c": "c"} for i in range(n)],
                                    f"{name}-first": [f"r{i}" for i in range(n)], f"{name}-rev": ["new"] * n})
        files[name] = StageFiles(paths[f"{name}-records"], paths[f"{name}-first"], [paths[f"{name}-rev"]])
    vocab = build_vocab(spark.createDataFrame([("new",)], "text STRING"), 10)
    prompts = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos BIGINT, prompt STRING")
    replies = spark.createDataFrame([(0, "x"), (1, "y")], "pos BIGINT, completion STRING")
    run = [Stage("short", 2), Stage("med", 1), Stage("long", 3)]
    paths = revision_curriculum(spark, files, vocab, 2, str(tmp_path / "run"), (prompts, replies), run)
    plan = spark.read.parquet(paths["plan"])
    # batches: 2 x 3, 1 x 2, 3 x 1
    assert sorted(r.global_batch for r in plan.select("global_batch").distinct().collect()) == list(range(11))
    assert [r.stage for r in plan.groupBy("stage").agg(F.min("global_batch").alias("b")).orderBy("b").collect()] == ["short", "med", "long"]
    for name, n, epochs in (("short", 5, 2), ("med", 3, 1), ("long", 1, 3)):
        rows = spark.read.parquet(paths[f"examples/{name}"])
        assert rows.where("valid").count() == n
        used = plan.where(F.col("stage") == name).drop("pos").join(rows, F.col("example") == F.col("pos"))
        assert used.count() == n * epochs
    assert sorted(r.pos for r in spark.read.parquet(paths["validation"]).collect()) == [0, 1]
    with pytest.raises(ValueError, match="long"):
        revision_curriculum(spark, {"short": files["short"], "med": files["med"]}, vocab, 2, str(tmp_path / "no"), run=run)


def test_positional_splits_of_token_rows(spark):
    turns = spark.createDataFrame(
        [(c, i, r, f"{r} {c}") for c in range(10, 16) for i, r in enumerate(("user", "assistant"))],
        "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    )
    vocab = build_vocab(turns, 10)
    parts = sft_split(turns, vocab, {"train": (0, 4), "val": (4, None)})
    assert sorted(r.conv_id for r in parts["val"].collect()) == [14, 15]
    assert parts["train"].count() == 4
    m = lambda t: F.array(*[F.struct(F.lit(r).alias("role"), F.lit(t).alias("content")) for r in ("user", "assistant")])
    pairs = spark.range(6).select(F.col("id").alias("conv_id"), m("a").alias("chosen"), m("b").alias("rejected"))
    parts = preference_split(pairs, vocab, bounds={"train": (0, 4), "val": (4, None)})
    assert [parts[k].count() for k in ("train", "val")] == [4, 2]


def test_compare_models_uses_the_cache(spark):
    prompts = spark.createDataFrame([(i, f"prompt {i}") for i in range(6)], "prompt_id BIGINT, prompt STRING")
    profile = PROFILES["eval_sft"]
    cache = spark.createDataFrame([(i, "base", profile.key, "x") for i in range(6)],
                                  "prompt_id BIGINT, model_id STRING, decode_hash STRING, completion STRING")

    def never(_):
        def generate(prompts):
            raise AssertionError("the cached model was called")
        return generate

    score = lambda pairs: parse_rewards(score_with(pairs, length_scorer))
    got = compare_models(
        prompts, {"tuned": echo_generator, "base": never},
        {"tuned": PROFILES["eval_dpo"], "base": profile}, score, True, n=4, cache=cache,
    ).first()
    assert (got.n_prompts, got.n_scored) == (4, 4)
    # "1024> prompt i" after cleaning: 14 characters, with the prompt 22; "x": 9
    assert (got.mean_a, got.mean_b) == (22 % 7, 9 % 7)


def test_jobs_read_each_other(spark, tmp_path):
    """Prompts -> criteria records -> first replies -> a revision stage, on files."""
    source = tmp_path / "prompts"
    source.mkdir()
    for part, rows in enumerate((["b", "a"], [], ["d\u00e9", None, "c"])):
        (source / f"{part}.jsonl").write_text("".join(json.dumps({"prompt": r, "other": 1}) + "\n\n" for r in rows))
    prompts = read_prompts(spark, str(source))
    assert [r.prompt for r in prompts.orderBy("pos").collect()] == ["b", "a", "d\u00e9", None, "c"]
    assert sorted(r.pos for r in prompts.collect()) == list(range(5))
    exemplars = spark.createDataFrame([(0, "A", "aa"), (1, "Z", "zzz")], "ord INT, category STRING, example STRING")
    criteria = spark.createDataFrame([(0, "A", "be A"), (1, "Z", "be Z")], "ord INT, category STRING, criterion STRING")
    records = str(tmp_path / "records")
    prepare_criteria(prompts.fillna("-"), letter_embedder, records, exemplars, criteria)
    assert [r.x for r in read_records(spark, records).orderBy("pos").collect()] == ["b", "a", "d\u00e9", "-", "c"]
    replies = str(tmp_path / "replies")
    make_initial_responses(spark, {"short": records}, echo_generator, replies)
    first = f"{replies}/split=short"
    assert [r.pos for r in read_completions(spark, first).orderBy("pos").collect()] == list(range(5))
    vocab = build_vocab(spark.createDataFrame([("new",)], "text STRING"), 10)
    examples, _ = revision_stage(spark, records, first, [first], vocab, 1, 2, str(tmp_path / "stage"))
    assert spark.read.parquet(examples).count() == 5


@pytest.mark.parametrize("text", ['[{"x": "1"}, {"x": ', '{"x": "1"}\n{"x": ', "nothing", '[1, 2]\n[3', '[1]\n[2]'])
def test_broken_files_fail_loudly(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="bad.json"):
        read_records(spark, str(tmp_path / "bad.json")).collect()


def test_broken_prompt_lines_fail(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"prompt": "a"}\n{"prompt": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_prompts(spark, str(tmp_path / "bad.jsonl")).collect()


def test_empty_and_line_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    (tmp_path / "b.json").write_text('{"x": "1", "y": null}\r\n\r\n{"x": true}\n')
    (tmp_path / "c.json").write_text(' [\n{"x": "3"}\n]')
    got = read_records(spark, str(tmp_path / "*.json")).orderBy("pos").collect()
    assert [(r.pos, r.x) for r in got] == [(0, "1"), (1, "true"), (2, "3")]
    (tmp_path / "d.jsonl").write_text('"one"\n{"completion": "two"}\n')
    assert [r.completion for r in read_completions(spark, str(tmp_path / "d.jsonl")).orderBy("pos").collect()] == ["one", "two"]
