"""Shapes of the physical plans."""

import __spark_entry__ as contract
import pytest

SF = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "ct2_assign_nearest", "ct3_criteria_dataset", "sel1_with_position", "sel1_with_shuffled_position",
    "cv3_first_exchange", "tk2_encode_documents", "tk6_sft_examples", "tk10_make_batches",
    "tk11_epoch_plan", "ev4_evaluate_all_prompts", "mt1_running_loss_seen", "jn1_zip_join",
])
def test_no_cross_products(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name,column", [("ct2_assign_nearest", "_means"), ("tk2_encode", "_slots"),
                                         ("tk6_sft_examples", "_slots"), ("tk7_preference_examples", "_slots")])
def test_small_tables_are_not_copied_into_rows(spark, name, column):
    assert f" AS {column}" not in plan_of(spark, name)


@pytest.mark.parametrize("name,times", [("tk6_sft_examples", 1), ("tk7_preference_examples", 2), ("tk8_revision_examples", 1)])
def test_rows_are_encoded_once(spark, name, times):
    assert plan_of(spark, name).count("regexp_extract_all(coalesce") == times


def test_encoding_does_not_shuffle_rows(spark):
    outer = [l for l in plan_of(spark, "tk2_encode_documents").split("\n") if ":" not in l.split("(")[0]]
    assert not any("Exchange" in line for line in outer)


def test_criteria_do_not_shuffle_prompts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spark, "ct3_criteria_dataset")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main


def test_columns_are_pruned(spark):
    plan = plan_of(spark, "sel1_with_position")
    assert "ReadSchema: struct<doc_id:bigint,_range:int>" in plan and "text" not in plan


@pytest.mark.parametrize("name", ["sel1_with_position", "sel1_with_position_repeated_order", "sel1_with_position_by_group",
                                  "tk13_difficulty_buckets"])
def test_no_sketch_over_all_rows(spark, name):
    assert "percentile" not in plan_of(spark, name)


def test_partition_filters_reach_the_corpus_scan(spark):
    plan = plan_of(spark, "io5_read_corpus")
    assert "PartitionFilters: [isnotnull(name" in plan


def test_sample_is_a_bounded_top_k(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "sel4_seeded_sample")
