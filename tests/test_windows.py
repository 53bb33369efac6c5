"""Skew-proof windows: the split path must give what Spark's plain windows give."""

import datetime as dt
import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataflow.operators import windows as w
from strataflow.operators.quantiles import group_percentiles

DAY = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def ledger(spark):
    """One key with a third of the rows, a null key, null times, ties in time."""
    rnd = random.Random(7)
    data = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None, f"k{i % 40}"])
        when = DAY + dt.timedelta(minutes=rnd.randrange(0, 6000)) if i % 29 else None
        data.append((i, key, when, rnd.randrange(-50, 50)))
    return spark.createDataFrame(data, "id long, key string, ts timestamp, v long").cache()


def _block():
    return F.unix_micros("ts")


def _order():
    return [F.asc_nulls_last("ts"), F.asc("id")]


@pytest.mark.parametrize("blocks", [1, 2, 7, 50, None])
def test_running_totals(ledger, blocks):
    got = w.running_totals(ledger, ["key"], _order(), _block(), {"total": F.col("v")}, "seq", blocks)
    plain = Window.partitionBy("key").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, 0)
    want = ledger.withColumn("total", F.sum("v").over(plain)).withColumn("seq", F.sum(F.lit(1).cast("long")).over(plain))
    cols = ["id", "total", "seq"]
    assert rows(got.select(cols), "id") == rows(want.select(cols), "id")


def test_blocks_split_a_crowded_hour(spark):
    """A third of the rows have one key and fall into one hour of a year."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"),
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") * 10_000).alias("second"),
    )
    sizes = w.with_blocks(df, F.col("second"), 30).groupBy("key", "_block").count()
    assert sizes.agg(F.max("count")).first()[0] <= 3 * 3000 / 30


@pytest.mark.parametrize("blocks", [1, 2, 7, 50, None])
def test_row_frames(ledger, blocks):
    frames = {"ma": w.moving_average("v", 7), "prev": w.lagged("v", 3)}
    got = w.row_frames(ledger, ["key"], _order(), _block(), frames, rows_per_block=11, blocks=blocks)
    base = Window.partitionBy("key").orderBy(*_order())
    want = ledger.withColumn("ma", F.avg("v").over(base.rowsBetween(-6, 0))).withColumn("prev", F.lag("v", 3).over(base))
    cols = ["id", "ma", "prev"]
    assert rows(got.select(cols), "id") == rows(want.select(cols), "id")


@pytest.mark.parametrize("block", [3600, 7200, 100_000])
def test_time_range_frames_include_both_ends(ledger, spark, block):
    edge = spark.createDataFrame(
        [(1000, "e", DAY, 1), (1001, "e", DAY + dt.timedelta(hours=1), 1), (1002, "e", DAY + dt.timedelta(hours=2, seconds=1), 1)],
        ledger.schema,
    )
    df = ledger.unionByName(edge)
    got = w.time_range_frames(
        df, ["key"], "ts", 3600, {"n": lambda: F.count(F.lit(1)), "s": lambda: F.sum("v")}, block_seconds=block
    )
    us = df.withColumn("us", F.unix_micros("ts"))
    frame = Window.partitionBy("key").orderBy("us").rangeBetween(-3600 * 1_000_000, 0)
    want = us.withColumn("n", F.count(F.lit(1)).over(frame)).withColumn("s", F.sum("v").over(frame))
    assert rows(got.select("id", "n", "s"), "id") == rows(want.select("id", "n", "s"), "id")
    assert [r[1] for r in rows(got.where("key = 'e'").select("id", "n"), "id")] == [1, 2, 1]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 60), tiles=st.integers(1, 7))
def test_distributed_ntile_equals_ntile(spark, n, tiles):
    df = spark.range(n).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(5)))
    got = w.distributed_ntile(df, tiles, [F.asc("v"), F.asc("id")], "t")
    want = df.withColumn("t", F.ntile(tiles).over(Window.orderBy("v", "id")))
    assert rows(got.select("id", "t"), "id") == rows(want.select("id", "t"), "id")


def test_dense_ids_have_no_gaps(spark):
    got = w.dense_ids(spark.range(100).repartition(7), [F.desc("id")], "k", start=5)
    assert rows(got.select("id", "k"), "id") == [(i, 104 - i) for i in range(100)]


def test_ntile_plan_has_no_single_partition_exchange_of_rows(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 10)
    plan = w.distributed_ntile(df, 5, [F.asc("v"), F.asc("id")], "t")._jdf.queryExecution().executedPlan().toString()
    # The only window runs over per-partition counts, below an aggregate.
    before_window = plan.split("Window")[-1]
    assert "HashAggregate" in before_window


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 10), ("a", 3, 10), ("a", 4, 5)], "k string, id int, v int")
    assert w.top_n_per_group(df, ["k"], [F.desc("v")], 2, ties="rank").count() == 3
    assert w.top_n_per_group(df, ["k"], [F.desc("v"), F.asc("id")], 2).count() == 2


def test_top_n_prunes_before_the_shuffle(spark, ledger):
    plan = w.top_n_per_group(ledger, ["key"], _order(), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_group_percentiles_equal_percentile(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        F.when(F.col("id") % 50 != 1, F.pmod(F.xxhash64("id"), F.lit(9000)) / 100).cast("decimal(18,2)").alias("v"),
    )
    names = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = group_percentiles(df, ["k"], "v", names, width=7.0)
    want = df.groupBy("k").agg(*[F.percentile(F.col("v").cast("double"), p).alias(n) for n, p in names.items()])
    for g, e in zip(rows(got.select("k", *names), "k"), rows(want.select("k", *names), "k")):
        assert g[0] == e[0]
        assert g[1:] == pytest.approx(e[1:])
