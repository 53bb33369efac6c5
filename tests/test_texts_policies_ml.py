"""Text, search, similarity, policies, metric layer and evaluation on small fixtures."""

import math
import random
import re

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from strataflow.functions import text as tx
from strataflow.operators import joins, layout, ml, policy, quality, search, similarity, texts
from strataflow.operators.joins import lookup_by_hot_key
from strataflow.plans.metrics import FINANCE_MODEL, metric_query


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr).first()[0]


def test_tokens_and_sentences(spark):
    assert one(spark, "Été, l'App—don't 3x!", tx.tokens("t")) == ["été", "l", "app", "don", "t", "x"]
    assert one(spark, "One. Two!  Three\n\nFour", tx.sentences("t")) == ["One", "Two", "Three", "Four"]


@pytest.mark.parametrize("text,score", [("great great bad", 1 / 3), ("nothing here", 0.0), ("BAD", -1.0), (None, 0.0)])
def test_sentiment(spark, text, score):
    got = one(spark, text, tx.sentiment(tx.tokens("t")))
    assert got == pytest.approx(score) or (text is None and got in (0.0, None))


def test_classify(spark):
    c = one(spark, "my card was declined, card fee", tx.classify(tx.tokens("t"), tx.TICKET_TOPICS))
    assert (c["label"], c["confidence"]) == ("Card Services", 0.75)
    c = one(spark, "hello", tx.classify(tx.tokens("t"), tx.TICKET_TOPICS))
    assert (c["label"], c["confidence"]) == ("General Inquiry", 0.0)


def test_redaction(spark):
    text = "mail a.b@x.example.com, +1 (743) 555-3824, 10.0.0.1, 4539578763621486, 1234567812345678, 2024-01-31, Maria Garcia"
    assert one(spark, text, tx.redact("t")) == (
        "mail [EMAIL], [PHONE_NUMBER], [IP_ADDRESS], [CARD_NUMBER], 1234567812345678, [DATE], [NAME]"
    )
    assert one(spark, text, tx.redact("t", ["EMAIL"])).startswith("mail [EMAIL], +1 (743)")
    assert one(spark, None, tx.redact("t")) is None


DOCS = [
    (1, "The cat sat. The dog ran far away", "a"), (2, "The cat ate fish. Fish swim", "a"), (3, "Dogs bark loudly", "b"),
    (4, "The the the the", "b"), (5, "", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, lang string").cache()


def _words(s):
    return [w for w in "".join(c if c.isalpha() else " " for c in s.lower()).split()]


def test_summary_against_brute_force(docs):
    n = len(DOCS)
    df = {}
    for _, t, _ in DOCS:
        for w in set(_words(t)):
            df[w] = df.get(w, 0) + 1
    weight = {w: math.floor(math.log(n / c) * 1e6 + 0.5) for w, c in df.items()}
    want = {}
    for i, t, _ in DOCS:
        sents = [s.strip() for s in t.replace("\n", ".").split(".") if s.strip()]
        scored = sorted((-sum(weight[w] for w in _words(s)) / len(_words(s)), p) for p, s in enumerate(sents))
        if scored:
            want[i] = ". ".join(sents[p] for p in sorted(p for _, p in scored[:1]))
    assert {r["doc_id"]: r["summary"] for r in texts.summarize(docs, ["doc_id"], "text", 1).collect()} == want


def test_summaries_leave_the_words_where_they_are(docs, monkeypatch):
    """Words are neither written nor shuffled while their weights are few; rare ones that are shuffled give the same."""
    written = []
    monkeypatch.setattr(texts, "stage", lambda df, f=texts.stage: written.append(df.schema.simpleString()) or f(df))
    twice = docs.union(docs.where("doc_id = 2"))
    # One of the two copies of a text stands for both where one sentence is asked for; of three, both come.
    by_doc = lambda: [rows(texts.summarize(d, ["doc_id"], "text", n), "doc_id") for d, n in ((docs, 1), (twice, 3))]
    by_lang = lambda: [rows(texts.summarize_groups(d, ["doc_id"], "text", "lang", 2), "lang") for d in (docs, twice)]
    seen = by_doc(), by_lang()
    assert seen[0][1][1] == (2, "The cat ate fish. Fish swim. Fish swim", 3)
    assert seen[1][0] == [("a", 2, "Fish swim | The dog ran far away"), ("b", 3, "Dogs bark loudly | The the the the")]
    assert written and not [s for s in written if "words" in s]
    plan = texts.summarize(docs, ["doc_id"], "text")._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert dealt and not [d for d in dealt if "term" in d]
    monkeypatch.setattr(texts, "hot_limit", lambda df, c: joins.hot_limit(df, c, 3))
    monkeypatch.setattr(texts, "broadcast_groups", lambda df: joins.broadcast_groups(df, 0))
    assert (by_doc(), by_lang()) == seen


def test_most_frequent_keys_are_bounded(spark):
    seen = spark.createDataFrame([(str(i), 1 + i // 10) for i in range(100)], "term string, n long")
    assert joins.hot_limit(seen, "n", 100) == 1
    for most in (1, 10, 35, 99):
        assert seen.where(F.col("n") >= joins.hot_limit(seen, "n", most)).count() <= most


def test_hot_key_lookup_equals_join(spark):
    facts = spark.range(300).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 9).cast("string"))).alias("term"))
    lookup = facts.groupBy("term").agg(F.count("*").alias("n")).withColumn("w", F.length("term")).where("term <> 'k1'")
    want = rows(facts.join(lookup, "term").select("id", "term", "w"), "id")
    for hot in (1, 50, 10_000):
        assert rows(lookup_by_hot_key(facts, lookup, "term", "w", "n", hot).select("id", "term", "w"), "id") == want


def test_bm25_against_brute_force(docs, spark, tmp_path):
    terms = ["the", "cat", "fish"]
    toks = {i: _words(t) for i, t, _ in DOCS}
    n, avg = len(toks), sum(map(len, toks.values())) / len(toks)
    want = {}
    for i, ws in toks.items():
        s = 0.0
        for t in terms:
            tf, dfreq = ws.count(t), sum(t in w for w in toks.values())
            if tf:
                s += math.log(1 + (n - dfreq + 0.5) / (dfreq + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / avg))
        if s:
            want[i] = s
    path = str(tmp_path / "ix")
    search.refresh_index(docs.where("doc_id <= 2"), "doc_id", "text", path, 0)
    search.refresh_index(docs.where("doc_id > 2"), "doc_id", "text", path, 1)
    got = {r["doc"]: r["score"] for r in search.bm25(*search.read_index(spark, path), terms).collect()}
    assert got == pytest.approx(want, abs=1e-6)
    only_b = search.bm25(*search.read_index(spark, path), terms, docs, "doc_id", F.col("lang") == "b")
    assert [r["doc"] for r in only_b.collect()] == [4]


@pytest.mark.parametrize("phrase", ["cat sat. The d", "he c", "the", "ark", "sat. The dog ran far"])
def test_substring_search(docs, phrase):
    ix = search.postings(docs, "doc_id", "text")
    got = sorted(r["doc_id"] for r in search.substring_search(docs, ix, "doc_id", "text", phrase).collect())
    assert got == [i for i, t, _ in DOCS if phrase in t]


@pytest.mark.parametrize("shape", ["random", "clustered", "copies"])
def test_similar_pairs_against_brute_force(spark, shape):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(90, 8))
    if shape == "clustered":
        m = rng.normal(size=(4, 8))[rng.integers(0, 4, 90)] * 5 + rng.normal(size=(90, 8)) * 0.2
    if shape == "copies":
        m[::3] = m[0]  # a third of the rows are one vector
    m = m.astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, v array<float>")
    u = m.astype(np.float64) / np.linalg.norm(m.astype(np.float64), axis=1, keepdims=True)
    sims = np.round(u @ u.T, 6)
    want = sorted((-sims[i, j], i, j) for i in range(90) for j in range(i + 1, 90))[:7]
    for tile, pivots in ((8, 5), (8, 1), (4096, None)):
        got = similarity.top_similar_pairs(df, "id", "v", 7, tile_rows=tile, n_pivots=pivots).collect()
        assert [(r["id_a"], r["id_b"]) for r in got] == [(i, j) for _, i, j in want]
    right = df.where("id < 20").select(F.col("id").alias("rid"), F.col("v").alias("rv"))
    best = similarity.best_match(df, "id", "v", right, "rid", "rv", tile_rows=7)
    got = {r["id"]: r["match"] for r in best.collect()}
    assert got == {i: int(np.argmax(np.round(u @ u[:20].T, 6)[i])) for i in range(90)}


def test_tiles_of_one_pivot_are_skipped(spark):
    """Four far clusters below a single pivot: tiles of different clusters never meet, and no vector leaves its tile's ball."""
    rng = np.random.default_rng(4)
    m = np.eye(4, 8)[rng.integers(0, 4, 800)] * 5 + rng.normal(size=(800, 8)) * 0.05
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, vec array<float>")
    tiled, tiles = similarity.metric_tiles(df, 64, n_pivots=1)
    n = tiles.count()
    pairs = similarity.near_tiles(tiles, 0.9).count()
    assert n >= 13 and tiled.count() == 800 and 0 < pairs <= n * (n - 1) / 2 / 2
    assert tiled.groupBy("pivot", "tile", "part").count().agg(F.max("count")).first()[0] <= 2 * 64
    joined = tiled.join(tiles, ["pivot", "tile", "part"])
    assert joined.where(similarity._angle("vec", "centre") > F.col("radius") + 1e-3).count() == 0


@pytest.mark.parametrize("values", [1, 200, 1 << 22])
def test_tiles_meet_by_chunk_without_shuffling_vectors_again(spark, monkeypatch, values):
    """Vectors that repeat, have no length or a repeated id: exact for any size of chunk and block, also if the answers are
    reduced meanwhile, and no tile is sent to another one through an exchange."""
    monkeypatch.setattr(similarity, "CHUNK_VALUES", values, raising=False)
    monkeypatch.setattr(similarity, "BLOCK_VALUES", values, raising=False)
    monkeypatch.setattr(similarity, "SLICE_ROWS", 16, raising=False)
    monkeypatch.setattr(similarity, "ROUNDS", 2, raising=False)
    rng = np.random.default_rng(5)
    m = rng.normal(size=(60, 6)).astype(np.float32)
    m[10:20], m[33] = m[40:50], 0
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, v array<float>")
    n = np.linalg.norm(m.astype(np.float64), axis=1, keepdims=True)
    u = m / np.where(n > 0, n, 1)
    sims = np.round(u @ u.T, 6)
    want = sorted((-sims[i, j], i, j) for i in range(60) for j in range(i + 1, 60))
    for k in (5, 25):
        pairs = similarity.top_similar_pairs(df, "id", "v", k, tile_rows=6)
        assert [(r["id_a"], r["id_b"], r["similarity"]) for r in pairs.collect()] == [(i, j, -s) for s, i, j in want[:k]]
    left, right = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    best = similarity.best_match(left, "id", "v", right, "id", "v", tile_rows=6)
    to = np.arange(0, 60, 3)
    assert rows(best, "id") == [(i, int(to[np.argmax(sims[i, to])]), sims[i, to].max()) for i in range(60) if i % 3]
    for plan in (x._jdf.queryExecution().executedPlan().toString() for x in (pairs, best)):
        assert "InPandas" not in plan
    twice = similarity.best_match(left.union(left), "id", "v", right.union(right), "id", "v", tile_rows=6)
    assert rows(twice, "id") == rows(best, "id")


def test_topic_relations_count_without_pairs(spark):
    a = spark.createDataFrame([(1, ["x", "y"]), (2, ["x"]), (3, [])], "i long, topics array<string>")
    b = spark.createDataFrame([(7, ["x"]), (8, ["x"]), (9, ["z"])], "j long, topics array<string>")
    got = texts.topic_relations(a, b, ["i"], ["j"]).collect()
    assert [(r["topic"], r["n_pairs"], r["first_left"], r["first_right"]) for r in got] == [("x", 4, "1,2", "7,8")]


def ctx(*roles, user="u"):
    return policy.SessionContext(user, frozenset(roles))


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(i, f"secret{i}", "US" if i < 5 else "FR", float(i)) for i in range(9)], "id long, email string, country string, income double"
    ).cache()


def test_masks_never_leak_and_masked_columns_are_not_read(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    r = policy.PolicyRegistry()
    r.masks[("people", "email")] = policy.MaskPolicy(policy.mask_text)
    r.tag("data_classification", "SENSITIVE", "people", "country")
    r.tag("data_classification", "PII", "people", "income")
    seen = r.apply(df, "people", ctx("ANALYST"))
    assert {(x["email"], x["country"], x["income"]) for x in seen.collect()} == {("***MASKED***", "U***", -1.0), ("***MASKED***", "F***", -1.0)}
    plan = seen._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema:")[1]
    assert "email" not in schema and "income" not in schema
    assert rows(r.apply(df, "people", ctx("ADMIN")), "id") == rows(df, "id")
    # A column policy wins over the column's tag.
    r.tag("data_classification", "SENSITIVE", "people", "email")
    assert r.apply(df, "people", ctx()).first()["email"] == "***MASKED***"
    with pytest.raises(ValueError):
        r.tag("data_classification", "TOP_SECRET", "people", "email")


def test_row_policies(spark, people):
    mapping = spark.createDataFrame([("u", "US"), ("u", "US"), ("v", "US"), ("v", "FR")], "user string, key string")
    rp = policy.RowPolicy("country", mapping, mapped_roles=frozenset({"ANALYST"}), default_allow=True)
    assert [rp.apply(people, c).count() for c in (ctx("ANALYST"), ctx("ANALYST", user="v"), ctx("ANALYST", user="w"), ctx("OTHER"), ctx("ADMIN"))] == [5, 9, 0, 9, 9]
    strict = policy.RowPolicy("country", mapping, mapped_roles=frozenset({"AGENT"}))
    assert strict.apply(people, ctx("OTHER")).count() == 0


def test_guards(people):
    got = policy.guarded_aggregate(people, ["country"], [F.count("*").alias("n")], ctx("ANALYST"))
    assert rows(got) == [("US", 5)]  # the group of four stays hidden
    assert policy.guarded_aggregate(people, ["country"], [F.count("*").alias("n")], ctx("ADMIN")).count() == 2
    with pytest.raises(PermissionError):
        policy.guarded_aggregate(people, ["country"], [], ctx())
    g = policy.GuardedFrame(people, ["email"], ctx("ANALYST"))
    assert g.where("email = 'secret3'").select("id").first()["id"] == 3
    for bad in ("email", F.upper("email"), "*"):
        with pytest.raises(policy.ProjectionDenied):
            g.select(bad)
    assert policy.GuardedFrame(people, ["email"], ctx("ADMIN")).select("email").count() == 9


def test_role_closure_ends_on_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("d", "a")], "role string, inherits string")
    assert set(rows(policy.resolve_roles(e))) == {
        ("a", "b"), ("a", "c"), ("b", "c"), ("b", "b"), ("c", "b"), ("c", "c"), ("d", "a"), ("d", "b"), ("d", "c"),
    }


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a@b.com"), (None, "nodot@x"), (1, None)], "k int, email string")
    got = quality.run_checks({"t": df}, [quality.null_check("t", "k"), quality.format_check("t", "email", "%_@_%.__%")], F.lit("now"))
    assert {r["metric_name"]: r["issue_count"] for r in got.collect()} == {"null_k": 1, "email_format": 1}
    assert tuple(quality.key_violations(df, ["k"]).first()) == (1, 1)
    assert rows(quality.layer_summary(spark, {"t": df, "gone": None}), "table_name") == [("gone", -1), ("t", 3)]


def test_metric_query_rejects_unknown_names(spark):
    df = spark.createDataFrame([("GOLD", 5.0)], "customer_segment string, total_balance double")
    with pytest.raises(KeyError):
        metric_query(FINANCE_MODEL, "customer_360", df, ["nope"])
    with pytest.raises(ValueError):
        metric_query(FINANCE_MODEL, "customer_360", df, ["total_balance"], grain="second")
    got = metric_query(FINANCE_MODEL, "customer_360", df, ["total_balance", "customer_count"], ["customer_segment"])
    assert rows(got) == [("GOLD", 5.0, 1)]


def test_split_is_exact_per_class(spark):
    df = spark.range(103).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    got = ml.stratified_split(df, "y", "id").groupBy("y").agg(F.count_if("is_train").alias("n"))
    assert rows(got, "y") == [(0, 61), (1, 20)]
    t = ml.time_split(spark.range(11), "id")
    assert sorted(r["id"] for r in t.where("is_train").collect()) == list(range(8))


def test_auc_against_pairs(spark):
    rnd = random.Random(5)
    data = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(80)]
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    df = spark.createDataFrame(data, "y int, s double")
    assert ml.area_under_roc(ml.roc_points(df, "y", "s")).first()[0] == pytest.approx(want)


def test_regression_metrics_edges(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 2.0)], "y double, p double")
    r = ml.regression_metrics(df, "y", "p").first()
    assert (r["mae"], r["mape"]) == (0.5, None)


def test_models_learn(spark):
    df = spark.range(200).select(
        "id", (F.col("id") % 10).cast("double").alias("x"), F.pmod(F.xxhash64("id"), F.lit(7)).cast("double").alias("z")
    ).withColumn("label", (F.col("x") > 4).cast("double"))
    split = ml.stratified_split(df, "label", "id").cache()
    train, test = split.where("is_train"), split.where("NOT is_train")
    got = ml.compare_classifiers(train, test, ["x", "z"], "label", ml.classifiers("label", trees=5, boosting=3))
    assert {r["model"]: r["accuracy"] for r in got.collect()} == pytest.approx(
        {"logistic_regression": 1.0, "random_forest": 1.0, "gradient_boosting": 1.0}, abs=0.05
    )
    assert ml.best_model(got, "accuracy").count() == 1


def test_clustering_quality_sweep(spark, tmp_path):
    for i, (low, high) in enumerate([(0, 10), (5, 15), (20, 30), (30, 40)]):
        spark.createDataFrame([(low,), (high,)], "k int").coalesce(1).write.mode("append").parquet(str(tmp_path / "f"))
    q = layout.clustering_quality(spark.read.parquet(str(tmp_path / "f")), ["k"]).first()
    assert (q["n_files"], q["avg_overlaps"], q["max_depth"]) == (4, 1.0, 2)
