"""Null keys, odd documents, repeated batches and closed policies."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strataflow.functions import scoring
from strataflow.functions.factors import parse_risk_factors, register_table_function
from strataflow.operators import policy
from strataflow.operators.changes import apply_changes, snapshot_diff
from strataflow.plans.refresh import APPEND, TOUCHED, Graph
from strataflow.sources import sinks


def test_factor_forms_agree_on_odd_documents(spark):
    texts = [
        None, "{bad", "null", "5", "[1]", "{}", json.dumps({"risk_factors": None}), json.dumps({"risk_factors": [None, 3, "x", {"factor": None}]}),
        json.dumps({"credit_history": None, "risk_score": "7", "risk_factors": [{"factor": "a", "score": 2}]}),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, doc string")
    native = parse_risk_factors(df, "doc").select("id", "risk_score", "credit_history", "factor_name", "factor_score")
    register_table_function(spark)
    sql = spark.sql(
        "SELECT id, f.risk_score, f.credit_history, f.factor_name, f.factor_score FROM {d} d, LATERAL parse_risk_factors(d.doc) f", d=df
    )
    want = [
        (5, None, "UNKNOWN", "NONE", None), (6, None, "UNKNOWN", "NONE", None), (7, None, "UNKNOWN", "3", None), (7, None, "UNKNOWN", "NONE", None),
        (7, None, "UNKNOWN", "UNKNOWN", None), (7, None, "UNKNOWN", "x", None), (8, 7, "UNKNOWN", "a", 2),
    ]
    assert rows(native, "id", "factor_name") == want
    assert rows(sql, "id", "factor_name") == want


def test_scores_round_alike(spark):
    df = spark.range(4000).select((F.col("id") / 1000).alias("a"), F.lit(0.0).alias("m"), F.lit(1.25).alias("s"))
    scoring.register_sql_functions(spark)
    both = df.select(scoring.anomaly_score("a", "m", "s").alias("x"), F.expr("anomaly_score(a, m, s)").alias("y"))
    assert both.where("x <> y").count() == 0


def test_merges_take_null_keys_as_equal(spark, tmp_path):
    source = spark.createDataFrame([(None, 1), (2, 1)], "k int, v int")
    for _ in range(3):
        sinks.insert_only(spark, f"{tmp_path}/t", source, ["k"])
    assert sinks.read_current(spark, f"{tmp_path}/t").count() == 2
    sinks.upsert(spark, f"{tmp_path}/t", source.withColumn("v", F.lit(9)), ["k"])
    assert rows(sinks.read_current(spark, f"{tmp_path}/t"), "k") == [(None, 9), (2, 9)]


def test_snapshots_take_null_keys_as_equal(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b"), (2, None)], "k int, v string")
    assert snapshot_diff(old, old, ["k"]).count() == 0
    new = spark.createDataFrame([(None, "z"), (2, None), (3, None)], "k int, v string")
    changes = snapshot_diff(old, new, ["k"])
    assert sorted(map(repr, rows(changes))) == sorted(
        map(repr, [(None, "a", "DELETE", True), (None, "z", "INSERT", True), (1, "b", "DELETE", False), (3, None, "INSERT", False)])
    )
    assert rows(apply_changes(old, changes, ["k"]), "k") == [(None, "z"), (2, None), (3, None)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    df = spark.range(10).withColumn("amount", F.col("id") * 2)
    for _ in range(2):
        got = sinks.micro_batches(df, f"{tmp_path}/b", F.col("id") % 2, F.lit(True), "amount")
    assert rows(got.select("_batch_id", "n_rows"), "_batch_id") == [(0, 5), (1, 5)]


def test_tagged_columns_of_any_type_are_hidden(spark):
    df = spark.sql("SELECT true AS b, array(1) AS a, named_struct('x', 1) AS s, map('k', 1) AS m, X'01' AS r")
    for tag in ("PII", "RESTRICTED", "SENSITIVE"):
        masks = {f.name: policy.tag_mask(tag, f.dataType) for f in df.schema.fields}
        assert all(v is None for v in df.select(*[masks[c](F.col(c)).alias(c) for c in df.columns]).first())


def test_aggregates_that_show_rows_are_refused(spark):
    df = spark.range(20).withColumn("k", F.lit(1))
    ctx = policy.SessionContext(user="u", roles=frozenset())
    assert policy.guarded_aggregate(df, ["k"], [F.sum("id").alias("s"), F.count_distinct("id").alias("n")], ctx).first()["n"] == 20
    for agg in (F.collect_list("id"), F.max("id"), F.first("id"), F.array_join(F.collect_set(F.col("id").cast("string")), ",")):
        with pytest.raises(PermissionError):
            policy.guarded_aggregate(df, ["k"], [agg.alias("x")], ctx)
    assert policy.guarded_aggregate(df, ["k"], [F.max("id").alias("x")], ctx, extremes=True).first()["x"] == 19


def test_refresh_follows_a_lookup_that_comes_later(spark, tmp_path):
    g = Graph(spark, str(tmp_path))
    g.base("facts", f"{tmp_path}/facts")
    g.base("names", f"{tmp_path}/names")
    g.node("joined", ["facts", "names"], lambda f, n: f.drop("_batch_id").join(n.drop("_batch_id"), "k", "left"), APPEND)
    g.node("totals", ["joined"], lambda j: j.groupBy("month", "name").agg(F.sum("v").alias("v")), TOUCHED, "month", lambda j: j)
    sinks.write_batch(spark.createDataFrame([(1, None, 5), (2, "m", 7)], "k int, month string, v int"), f"{tmp_path}/facts", 0)
    sinks.write_batch(spark.createDataFrame([(1, "one")], "k int, name string"), f"{tmp_path}/names", 0)
    g.refresh("totals")
    sinks.write_batch(spark.createDataFrame([(1, None, 1)], "k int, month string, v int"), f"{tmp_path}/facts", 1)
    g.refresh("totals")
    assert rows(g.read("totals"), "v") == [(None, "one", 6), ("m", None, 7)]
    sinks.write_batch(spark.createDataFrame([(2, "two")], "k int, name string"), f"{tmp_path}/names", 1)
    g.refresh("totals")
    assert rows(g.read("totals"), "v") == [(None, "one", 6), ("m", "two", 7)]
    assert {s for _, s in g.refresh("totals", max_age=3600)} == {"FRESH"}
    assert {s for _, s in g.refresh("totals")} == {"SKIPPED"}
