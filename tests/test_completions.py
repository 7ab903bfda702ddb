"""Completions that are made once: calls are counted in files that tasks append to."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from stand_ins import length_scorer

from tunesmith.operators.completions import CompletionCache, resumable_completions
from tunesmith.operators.inference import PROFILES
from tunesmith.operators.scoring import parse_rewards, score_with
from tunesmith.plans import compare_models, make_initial_responses

PROFILE = PROFILES["eval_sft"]


def counting(folder, fails_on=None):
    """A generator that notes every prompt it is asked for, and may fail on one."""
    path = str(folder / "calls.txt")

    def loader(profile):
        def generate(prompts):
            if fails_on in prompts:
                raise RuntimeError("the model is gone")
            with open(path, "a") as f:
                f.write("".join(json.dumps(p) + "\n" for p in prompts))
            return [f"{profile.max_new_tokens}> {p}" for p in prompts]

        return generate

    return loader


def calls(folder):
    path = folder / "calls.txt"
    return Counter(json.loads(x) for x in path.read_text().splitlines()) if path.exists() else Counter()


def test_restart_makes_only_what_is_missing(spark, tmp_path):
    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(60)], "pos BIGINT, prompt STRING")
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="the model is gone"):
        resumable_completions(prompts, counting(tmp_path, "p41"), PROFILE, out, units=12, waves=6)
    committed = {r.unit for r in spark.read.parquet(f"{out}/commits").collect()}
    assert 0 < len(committed) < 12
    unit = F.pmod(F.xxhash64("pos"), F.lit(12))
    kept = {r.prompt for r in prompts.where(unit.isin(sorted(committed))).collect()}
    got = resumable_completions(prompts, counting(tmp_path), PROFILE, out, units=12, waves=6)
    assert sorted((r.pos, r.completion) for r in got.collect()) == [(i, f"1024> p{i}") for i in range(60)]
    assert all(calls(tmp_path)[p] == 1 for p in kept) and set(calls(tmp_path)) == {f"p{i}" for i in range(60)}
    before = calls(tmp_path)
    again = resumable_completions(prompts, counting(tmp_path), PROFILE, out, units=12, waves=6)
    assert again.count() == 60 and calls(tmp_path) == before


def test_changed_rows_and_settings_are_made_again(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = [(i, f"p{i}") for i in range(20)]
    make = lambda rows, profile=PROFILE: sorted(tuple(r) for r in resumable_completions(
        spark.createDataFrame(rows, "pos BIGINT, prompt STRING"), counting(tmp_path), profile, out, units=20, waves=2).collect())
    make(rows)
    rows[3] = (3, "new")
    assert make(rows) == sorted((i, p, f"1024> {p}") for i, p in rows)
    assert calls(tmp_path)["new"] == 1 and sum(calls(tmp_path).values()) < 30
    assert make(rows[:5]) == sorted((i, p, f"1024> {p}") for i, p in rows[:5])
    assert make(rows[:5], PROFILES["sft"]) == sorted((i, p, f"590> {p}") for i, p in rows[:5])


def test_null_keys_repeated_rows_and_empty_tables(spark, tmp_path):
    rows = [(None, "a"), (None, "b"), (1, "c"), (1, "c"), (2, None)]
    df = spark.createDataFrame(rows, "pos BIGINT, prompt STRING").withColumn("completion", F.lit("old"))
    got = resumable_completions(df.where("prompt IS NOT NULL"), counting(tmp_path), PROFILE, str(tmp_path / "a"), units=4, waves=2)
    assert Counter((r.pos, r.completion) for r in got.collect()) == Counter((k, f"1024> {p}") for k, p in rows[:4])
    assert resumable_completions(df.limit(0), counting(tmp_path), PROFILE, str(tmp_path / "b")).count() == 0


def test_initial_responses_go_on_where_they_ended(spark, tmp_path):
    (tmp_path / "short.json").write_text(json.dumps([{"x": f"q{i}", "y": "", "c": "c"} for i in range(9)]))
    files, work = {"short": str(tmp_path / "short.json"), "test": str(tmp_path / "short.json")}, str(tmp_path / "work")
    make_initial_responses(spark, files, counting(tmp_path), str(tmp_path / "one"), work)
    make_initial_responses(spark, files, counting(tmp_path), str(tmp_path / "two"), work)
    assert calls(tmp_path) == {f"q{i}": 2 for i in range(9)}  # once in each split
    one, two = (sorted((r.split, r.pos, r.completion) for r in spark.read.json(str(tmp_path / n)).collect()) for n in ("one", "two"))
    assert one == two and len(one) == 18


def test_comparison_fills_the_cache(spark, tmp_path):
    prompts = spark.createDataFrame([(i, f"prompt {i}") for i in range(8)], "prompt_id BIGINT, prompt STRING")
    cache = CompletionCache(spark, "kept_completions", str(tmp_path / "cache"), buckets=4)
    profiles = {"tuned": PROFILES["eval_dpo"], "base": PROFILES["eval_sft"]}
    score = lambda pairs: parse_rewards(score_with(pairs, length_scorer))
    run = lambda n, cache: compare_models(
        prompts, {k: counting(tmp_path) for k in profiles}, profiles, score, n=n, cache=cache).first()
    first = run(5, cache)
    assert sum(calls(tmp_path).values()) == 10
    assert run(5, cache) == first and sum(calls(tmp_path).values()) == 10
    run(8, cache)
    assert sum(calls(tmp_path).values()) == 16
    # another session's catalog finds the files
    spark.sql("DROP TABLE kept_completions")
    again = CompletionCache(spark, "kept_again", str(tmp_path / "cache"), buckets=4)
    assert again.completions("base", PROFILES["eval_sft"]).count() == 8
    run(8, again)
    assert sum(calls(tmp_path).values()) == 16


def test_commits_replace_themselves_and_look_ups_do_not_move_the_cache(spark, tmp_path):
    cache = CompletionCache(spark, "bucketed_completions", str(tmp_path / "cache"), buckets=4)
    rows = spark.range(50).select(F.col("id").alias("prompt_id"), F.lit("x").alias("completion"))
    cache.append(rows, "m", PROFILE, "one")
    cache.append(rows, "m", PROFILE, "one")
    assert spark.table("bucketed_completions").count() == 50
    cache.append(rows.where("prompt_id < 9"), "other", PROFILE, "one")
    assert cache.completions("m", PROFILE).count() == 50
    prompts = spark.range(60).select(F.col("id").alias("prompt_id"), F.lit("q").alias("prompt"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        todo = cache.missing(prompts, "m", PROFILE)
        assert sorted(r.prompt_id for r in todo.collect()) == list(range(50, 60))
        plan = todo._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1, plan  # the prompts
    assert "PartitionFilters: [isnotnull(model_id" in plan
