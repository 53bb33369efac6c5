"""Merges by bucket and their feed, single-read ingestion, distinct counts without expansion, tiles by selection."""

import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators.cuts import tiles_by_cuts
from strataflow.operators.distinct import Domain, count_distinct, count_distinct_each
from strataflow.operators.quantiles import group_summary
from strataflow.operators.windows import range_totals
from strataflow.plans import consumption
from strataflow.sources import sinks
from strataflow.sources.keyed import KeyedTable
from strataflow.streaming.ingest import consume, ingest_csv, parquet_stream

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("v", T.IntegerType())])


def make(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def table(spark, path, **more):
    return KeyedTable(spark, str(path), ("k", "name"), SCHEMA, **more)


def test_merges_follow_a_dictionary(spark, tmp_path):
    """Random upserts, inserts and deletes with null keys against a dict; the feed replays to the same table."""
    t = table(spark, tmp_path / "t", buckets=4, files=2)
    rng, want, replayed = random.Random(2), {}, {}
    key = lambda: (rng.choice([None, *range(12)]), rng.choice(["a", None]))
    for step in range(6):
        picked = {key(): rng.randrange(100) for _ in range(rng.randrange(1, 9))}
        source = make(spark, *[(*k, v) for k, v in picked.items()])
        if step % 3 == 0:
            t.upsert(source)
            want |= picked
        elif step % 3 == 1:
            t.insert_only(source)
            want = picked | want
        else:
            t.delete(source)
            want = {k: v for k, v in want.items() if k not in picked}
        assert {(r.k, r.name): r.v for r in t.read().collect()} == want
    for version in range(1, t.version + 1):
        changes = [r for r in t.changes(version - 1).collect() if r._version == version]
        for r in changes:
            if r._action == "DELETE":
                assert replayed.pop((r.k, r.name)) == r.v
        for r in changes:
            if r._action == "INSERT":
                assert (r.k, r.name) not in replayed
                replayed[r.k, r.name] = r.v
    assert replayed == want
    assert t.read(1).count() > 0  # an older version stays readable


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path / "t", buckets=16)
    t.upsert(make(spark, *[(k, "a", k) for k in range(200)]))
    first = t.written_by()
    files = {f for f in t.read().inputFiles()}
    t.upsert(make(spark, (3, "a", -3), (500, "a", 500)))
    second = t.written_by()
    rewritten = {b for b in second if second[b] != first.get(b)}
    assert 1 <= len(rewritten) <= 2 and set(second.values()) == {1, 2}
    assert len(files - set(t.read().inputFiles())) == len(rewritten)
    assert t.read().count() == 201
    assert t.upsert(make(spark).limit(0)) == 2  # nothing touched, nothing written
    t.insert_only(spark.createDataFrame([(7.0, "x", 900, "a")], "v double, more string, k long, name string"))
    assert rows(t.read().where("k = 900")) == [(900, "a", 7)]


def test_feed_is_made_up_after_a_crash_and_read_once(spark, tmp_path):
    t = table(spark, tmp_path / "t", buckets=2)
    t.upsert(make(spark, (1, "a", 1), (2, "a", 2)))
    args = (str(tmp_path / "out"), str(tmp_path / "cp"))
    assert consume(parquet_stream(spark, t.feed, t.feed_schema), *args).rows_in == 2
    t.upsert(make(spark, (1, "a", 5)))
    # As if the merge had died between its commit and its feed.
    sinks.drop_folder(spark, f"{t.feed}/_batch_id=2")
    t.upsert(make(spark, (2, "a", 2)))
    got = [tuple(r) for r in t.changes(1).select("k", "v", "_action", "_is_update", "_version").orderBy("_version", "_action").collect()]
    assert got == [(1, 1, "DELETE", True, 2), (1, 5, "INSERT", True, 2)]
    assert consume(parquet_stream(spark, t.feed, t.feed_schema), *args).rows_in == 2
    assert consume(parquet_stream(spark, t.feed, t.feed_schema), *args).rows_in == 0


def test_ingestion_writes_good_and_bad_rows_from_one_read(spark, tmp_path):
    schema = "id int, amount double"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,amount\n1,2.5\nx,3\n2,\n")
    args = (spark, str(tmp_path / "in"), schema, str(tmp_path / "rows"), str(tmp_path / "bad"), str(tmp_path / "cp"))
    done = ingest_csv(*args)
    assert (done.rows_in, done.rows_out, done.batches) == (3, 2, 1)
    (tmp_path / "in" / "b.csv").write_text("id,amount\n3,oops\n")
    assert (ingest_csv(*args).rows_in, ingest_csv(*args).rows_in) == (1, 0)
    assert rows(sinks.read_batches(spark, str(tmp_path / "rows")).select("id", "amount"), "id") == [(1, 2.5), (2, None)]
    bad = sinks.read_batches(spark, str(tmp_path / "bad"))
    assert rows(bad.select("id", "amount", "_bad_columns"), "id") == [("3", "oops", ["amount"]), ("x", "3", ["id"])]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


# Distinct counts


def facts(spark):
    rng = random.Random(5)
    data = [(rng.choice(["x", None, "y"]), rng.choice([None, *map(str, range(90))]), rng.choice([None, 1, 2, 3]), rng.randrange(50)) for _ in range(800)]
    return data, spark.createDataFrame(data, "g string, c string, u int, v int")


def brute(data):
    out = {}
    for g in {r[0] for r in data}:
        mine = [r for r in data if r[0] == g]
        out[g] = (len({r[1] for r in mine} - {None}), len({r[2] for r in mine} - {None}), len(mine), max(r[3] for r in mine))
    return out


def test_distinct_counts(spark):
    data, df = facts(spark)
    domain = Domain.of(df.select("c"))
    assert domain.words == 2
    got = count_distinct(df, ["g"], "u", {"c": domain}, {"n": (F.count(F.lit(1)), "sum"), "top": (F.max("v"), "max")})
    assert {r.g: (r.n_c, r.n_u, r.n, r.top) for r in got.collect()} == brute(data)
    each = count_distinct_each(df, ["g"], ["u", "v"], {"c": domain})
    assert {r.g: (r.n_c, r.n_u) for r in each.collect()} == {g: x[:2] for g, x in brute(data).items()}
    with pytest.raises(Exception, match="outside its domain"):
        count_distinct(df, ["g"], "u", {"c": Domain.of(df.where("c < '3'").select("c"))}, {}).collect()


def test_no_row_is_multiplied_for_distinct_counts(spark):
    schema = "customer_id int, customer_name string, merchant_name string, category string, channel string, txn_type string, amount decimal(18,2), is_flagged boolean, txn_date timestamp_ntz"
    e = spark.createDataFrame([], schema)
    domain = Domain.of(spark.createDataFrame([("a",)], "category string"))
    for df in (
        consumption.transaction_metrics(e, F.current_date(), domain),
        consumption.channel_performance(e, categories=domain),
        consumption.fraud_indicators(e, domain, domain),
        count_distinct_each(e, ["txn_type"], ["customer_id", "merchant_name"], {"category": domain}),
    ):
        assert "Expand" not in df._jdf.queryExecution().toString()
        assert df.count() == 0


# Tiles and summaries


def ntile(values, tiles):
    n = len(values)
    order = sorted(values, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    ends = [k * (n // tiles) + min(k, n % tiles) for k in range(1, tiles + 1)]
    return {b: next(t + 1 for t, e in enumerate(ends) if i < e) for i, (_, b) in enumerate(order)}


@pytest.mark.parametrize("n, spread, tiles", [(1, 5, 5), (3, 5, 5), (4, 1, 5), (500, 1, 4), (500, 3, 7), (3000, 10**6, 5), (1001, 40, 10)])
def test_tiles(spark, n, spread, tiles):
    rng = random.Random(n)
    data = [(None if rng.random() < 0.05 else Decimal(rng.randrange(spread)) / 100, k, rng.randrange(7)) for k in rng.sample(range(10 * n), n)]
    df = spark.createDataFrame(data, "a decimal(18,2), id int, f int").repartition(3)
    got = tiles_by_cuts(df, tiles, {"t": (F.col("a"), F.col("id")), "u": (-F.col("f"), F.col("id"))}).collect()
    assert {r.id: r.t for r in got} == ntile([(a, k) for a, k, _ in data], tiles)
    assert {r.id: r.u for r in got} == ntile([(-f, k) for _, k, f in data], tiles)


def test_group_summary(spark):
    data = [("a", Decimal(k % 7)) for k in range(50)] + [("a", None), (None, Decimal(2)), ("b", None)]
    got = group_summary(spark.createDataFrame(data, "g string, v decimal(18,2)"), ["g"], "v", {"median": 0.5})
    want = [("a", 51, 50, Decimal(sum(k % 7 for k in range(50))), Decimal(6), 3.0), ("b", 1, 0, None, None, None), (None, 1, 1, Decimal(2), Decimal(2), 2.0)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(g, n, m, t and t.quantize(Decimal("0.01")), h and h.quantize(Decimal("0.01")), p) for g, n, m, t, h, p in want], key=repr)


# Sums over time ranges


def test_range_totals(spark):
    """A key with a third of all rows inside one hour, equal instants, null times, keys and values, against brute force."""
    rng = random.Random(8)
    hour = 1_600_000_000
    data = [(1, hour + rng.randrange(3600), rng.choice([None, 1, 2])) for _ in range(300)]
    data += [(rng.choice([None, 2, 3]), hour + 60 * rng.randrange(-400, 400), rng.randrange(9)) for _ in range(400)]
    data += [(4, None, 5), (4, None, 6), (4, hour, 7), (5, hour, None), (5, hour + 3600, None), (5, hour + 7201, 1)]
    data = [(i, *r) for i, r in enumerate(data)]
    df = spark.createDataFrame(data, "id int, k int, s long, v int").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.id: (r.n, r.total) for r in range_totals(df, ["k"], "ts", 3600, {"n": F.lit(1), "total": F.col("v")}).collect()}
    for i, k, s, _ in data:
        frame = [r for r in data if r[1] == k and (r[2] is None if s is None else r[2] is not None and s - 3600 <= r[2] <= s)]
        values = [r[3] for r in frame if r[3] is not None]
        assert got[i] == (len(frame), sum(values) if values else None), (i, k, s)
    with pytest.raises(ValueError):
        range_totals(df, ["k"], "ts", 1, {"n": F.lit(1)}, parts=7)


def test_a_hot_hour_is_spread(spark):
    """What one task must hold of a key is a unit and its copy: a few thousandths of an hour's rows."""
    rng = random.Random(9)
    df = spark.createDataFrame([(1 if k % 3 else k, rng.randrange(3600 * 1000)) for k in range(9000)], "k int, ms long")
    out = range_totals(df.withColumn("ts", F.timestamp_millis("ms")), ["k"], "ts", 3600, {"n": F.lit(1)})
    assert out.count() == 9000
    units = df.where("k = 1").groupBy(F.floor(F.col("ms") / 15_000)).count()
    assert units.agg(F.max("count")).first()[0] * 20 < 6000


def test_windows_open_only_the_days_they_span(spark, tmp_path):
    from strataflow.streaming.windows import current_windows, in_windows, rows_of_days, run_windows

    e = spark.range(240).select(F.col("id"), F.timestamp_seconds(F.col("id") * 7200 + 1_600_000_000).alias("ts"))
    aggs = [F.count("*").alias("n")]
    for i, part in enumerate((e.where("id % 5 != 0"), e.where("id = 100"), e.where("id % 5 = 0 AND id != 100"))):
        part.write.parquet(f"{tmp_path}/in/drop={i}")
        run_windows(parquet_stream(spark, f"{tmp_path}/in", e.schema), f"{tmp_path}/out", f"{tmp_path}/cp", "ts", "6 hours", "3 hours", [], aggs)
    got = {r.window_start: r.n for r in current_windows(spark, f"{tmp_path}/out", []).collect()}
    want = {r.s: r.n for r in in_windows(e, "ts", "6 hours", "3 hours").groupBy(F.col("_w.start").cast("timestamp_ntz").alias("s")).agg(*aggs).collect()}
    assert got == want
    late = in_windows(e.where("id = 100"), "ts", "6 hours", "3 hours")
    read = rows_of_days(f"{tmp_path}/out/rows", late, 2)
    days = {f.split("_day=")[1][:10] for f in read.inputFiles()}
    assert len(days) <= 3 and read.count() < 60
