"""Computed row orders: permutations, inverses, batches by range, plans."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tunesmith.operators.permute import batch_positions, curriculum_places, epoch_places, grid, read_batches


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 97, 706, 1009, 4096])
def test_every_epoch_is_a_permutation_with_its_inverse(spark, n):
    rows = spark.range(n).toDF("pos")
    placed = [(r.epoch, r.pos, r.place, r.batch_id, r.n_batches) for r in epoch_places(rows, n, 3, 10, seed="s").collect()]
    assert len(placed) == 3 * n
    for epoch in range(3):
        order = {pos: place for e, pos, place, _, _ in placed if e == epoch}
        assert sorted(order) == sorted(order.values()) == list(range(n))
        back = {r.place: r.pos for r in batch_positions(spark, n, epoch, 10, seed="s").collect()}
        assert back == {place: pos for pos, place in order.items()}
    assert all(b == place // 10 and count == -(-n // 10) for _, _, place, b, count in placed)


def test_orders_differ_and_look_shuffled(spark):
    n = 5003
    got = epoch_places(spark.range(n).toDF("pos"), n, 4, 100, seed=1).toPandas().pivot(index="pos", columns="epoch", values="place")
    corr = got.reset_index().corr().to_numpy()
    assert abs(corr[~(corr > 0.999)]).max() < 0.06
    # neighbours are spread evenly: a third of n apart on average, as in a random order
    gaps = got.diff().abs().mean()
    assert ((gaps - n / 3).abs() < n / 40).all()


def test_large_numbers(spark):
    n = 2**50 + 3
    assert grid(n).spare < 200 and grid(10**12 + 39).spare < 8
    few = batch_positions(spark, 10**12 + 39, 1, 1000, 10**8, 10**8 + 1)
    rows = few.collect()
    assert len({r.pos for r in rows}) == 1000 and all(0 <= r.pos < 10**12 + 39 for r in rows)
    again = epoch_places(few.select("pos"), 10**12 + 39, 2, 1000).where("epoch = 1")
    assert {(r.pos, r.place) for r in again.collect()} == {(r.pos, r.place) for r in rows}


def test_epochs_are_not_shuffled(spark):
    rows = spark.range(1000).select(F.col("id").alias("pos"), F.lit("x").alias("a.b"))
    df = epoch_places(rows, 1000, 5, 10)
    assert "Exchange" not in plan(df) and "Sort" not in plan(df) and "a.b" in df.columns
    assert "Exchange" not in plan(batch_positions(spark, 1000, 3, 10, 5, 7))
    both = curriculum_places({"a": (rows, 1000, 2), "b": (rows.where("pos < 10"), 10, 3)}, 16)
    assert "Exchange" not in plan(both)
    assert both.agg(F.count_distinct("global_batch"), F.max("global_batch")).first()[:] == (2 * 63 + 3, 2 * 63 + 2)


def test_batches_are_read_by_range(spark):
    rows = spark.range(1000).select(F.col("id").alias("pos"), (F.col("id") * 7).alias("payload"))
    whole = {r.place: r.payload for r in epoch_places(rows, 1000, 3, 64).where("epoch = 2").collect()}
    got = read_batches(rows, 1000, 2, 64, 14, 20)
    assert {r.place: r.payload for r in got.collect()} == {k: v for k, v in whole.items() if k >= 14 * 64}
    assert read_batches(rows, 1000, 2, 64, 16, 20).count() == 0


def test_refused_input(spark):
    with pytest.raises(PySparkException, match="position outside"):
        epoch_places(spark.range(11).toDF("pos"), 10, 1, 4).collect()
    with pytest.raises(PySparkException, match="null"):
        epoch_places(spark.sql("SELECT cast(null AS bigint) AS pos"), 10, 1, 4).collect()
    with pytest.raises(ValueError):
        epoch_places(spark.sql("SELECT 1L AS pos, 2 AS Epoch"), 10, 1, 4)
    with pytest.raises(ValueError):
        grid(-1)
