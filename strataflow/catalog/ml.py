"""Machine-learning data steps, models and evaluation (Y)."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import ml
from ..plans.consumption import CHURN_FEATURES, churn_features
from ..session import stage
from . import build
from .registry import VIEWS, query
from .scratch import scratch

FEATURES = ("annual_income", "credit_score", "tenure_days", "total_accounts", "total_balance", "total_transactions")

VIEWS["scored_docs"] = """SELECT l.doc_id, l.quality, CAST(n_chars % 100 AS DOUBLE) / 100 AS score,
    CASE WHEN n_chars % 100 >= 50 THEN 1 ELSE 0 END AS prediction FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def scored_docs(t):
    """Labels with a made-up rule's score, to check the evaluation against SQL."""
    cents = F.col("n_chars") % 100
    return t.raw("labels").join(t.raw("documents").select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", "quality", (cents.cast("double") / 100).alias("score"),
        F.when(cents >= 50, 1).otherwise(0).alias("prediction"),
    )


@query(
    "y01_assembled_features",
    "SELECT customer_id, " + " + ".join(f"COALESCE(CAST({f} AS DOUBLE), 0.0)" for f in CHURN_FEATURES)
    + f" AS feature_sum, {len(CHURN_FEATURES)} AS n_features FROM churn",
)
def y01(t):
    v = ml.assemble(build.churn(t), CHURN_FEATURES)
    arr = vector_to_array("features")
    return v.select(
        "customer_id", F.aggregate(arr, F.lit(0.0), lambda a, x: a + x).alias("feature_sum"), F.size(arr).alias("n_features")
    )


@query(
    "y02_stratified_split",
    """SELECT doc_id, quality, ROW_NUMBER() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR) || '-42'), doc_id) - 1
              < floor(COUNT(*) OVER (PARTITION BY quality) * 0.8::DOUBLE) AS is_train FROM labels""",
)
def y02(t):
    return ml.stratified_split(t.raw("labels").select("doc_id", "quality"), "quality", "doc_id")


@query(
    "y03_time_split",
    """SELECT strftime(revenue_month, '%Y-%m-%d') AS revenue_month,
              ROW_NUMBER() OVER (ORDER BY revenue_month) <= floor(COUNT(*) OVER () * 0.8::DOUBLE) AS is_train FROM monthly""",
)
def y03(t):
    return build.days(ml.time_split(build.monthly(t).select("revenue_month"), "revenue_month"), "revenue_month")


@query(
    "y04_standard_scaling",
    """WITH base AS (SELECT customer_id, CAST(credit_score AS DOUBLE) AS a, CAST(annual_income AS DOUBLE) AS b FROM customers),
       train AS (SELECT AVG(a) AS ma, STDDEV_SAMP(a) AS sa, AVG(b) AS mb, STDDEV_SAMP(b) AS sb FROM base WHERE customer_id % 5 <> 0)
       SELECT customer_id, ROUND((a - ma) / sa, 6) AS credit_scaled, ROUND((b - mb) / sb, 6) AS income_scaled FROM base, train""",
)
def y04(t):
    c = ml.numeric_features(t.customers(), ["credit_score", "annual_income"])
    model = ml.scaled(c.where(F.col("customer_id") % 5 != 0), ["credit_score", "annual_income"])
    x = model.transform(c).withColumn("_a", vector_to_array("features"))
    return x.select(
        "customer_id", F.round(F.col("_a")[0], 6).alias("credit_scaled"), F.round(F.col("_a")[1], 6).alias("income_scaled")
    )


def _churn_sets(t):
    """Training and test rows without the columns the label is computed from."""
    features = [f for f in CHURN_FEATURES if f not in ("days_since_last_txn", "active_accounts")]
    rows = churn_features(build.c360(t), build.as_of(), exclude_label_sources=True)
    rows = ml.numeric_features(rows, features).withColumn("label", F.col("is_churned").cast("double"))
    split = stage(ml.stratified_split(rows, "is_churned", "customer_id"))
    return split.where("is_train"), split.where("NOT is_train"), features


CHURN_SPLIT_SQL = """(SELECT is_churned, ROW_NUMBER() OVER (PARTITION BY is_churned ORDER BY md5(CAST(customer_id AS VARCHAR) || '-42'), customer_id) - 1
       < floor(COUNT(*) OVER (PARTITION BY is_churned) * 0.8::DOUBLE) AS is_train FROM churn)"""


@query(
    "y05_churn_classifiers",
    f"""SELECT model, n_test, n_positive, TRUE AS auc_in_range, TRUE AS beats_guessing
        FROM (SELECT COUNT(*) AS n_test, CAST(COUNT_IF(is_churned = 1) AS BIGINT) AS n_positive FROM {CHURN_SPLIT_SQL} WHERE NOT is_train)
        CROSS JOIN (VALUES ('logistic_regression'), ('random_forest'), ('gradient_boosting')) m(model)""",
)
def y05(t):
    """Three full models; what must hold for any sound fit, since exact scores depend on the trainer."""
    train, test, features = _churn_sets(t)
    r = ml.compare_classifiers(train, test, features, "label", ml.classifiers("label"))
    return r.select(
        "model", (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_test"), (F.col("tp") + F.col("fn")).alias("n_positive"),
        F.col("auc").between(0, 1).alias("auc_in_range"), (F.col("auc") > 0.5).alias("beats_guessing"),
    )


def _revenue_sets(t):
    rows = ml.revenue_features(build.monthly(t)).withColumn("label", F.col("monthly_volume"))
    skip = ("revenue_month", "label", "monthly_volume")
    features = [f.name for f in rows.schema.fields if f.name not in skip]
    rows = ml.numeric_features(rows, features)
    split = stage(ml.time_split(rows, "revenue_month"))
    return split.where("is_train"), split.where("NOT is_train"), features


REVENUE_SPLIT_SQL = """rf AS (SELECT * FROM (SELECT revenue_month, CAST(monthly_volume AS DOUBLE) AS y,
         LAG(CAST(monthly_volume AS DOUBLE)) OVER w AS a, LAG(CAST(monthly_transactions AS DOUBLE)) OVER w AS b,
         ROW_NUMBER() OVER w AS place FROM monthly WINDOW w AS (ORDER BY revenue_month)) WHERE place >= 6),
       sp AS (SELECT *, ROW_NUMBER() OVER (ORDER BY revenue_month) <= floor(COUNT(*) OVER () * 0.8::DOUBLE) AS is_train FROM rf)"""


@query(
    "y06_revenue_regressors",
    f"""WITH {REVENUE_SPLIT_SQL}
       SELECT model, n_train, n_test, train_volume, test_volume, TRUE AS errors_ordered, TRUE AS r2_at_most_one
       FROM (SELECT CAST(COUNT_IF(is_train) AS BIGINT) AS n_train, CAST(COUNT_IF(NOT is_train) AS BIGINT) AS n_test,
                    ROUND(SUM(y) FILTER (is_train), 2) AS train_volume, ROUND(SUM(y) FILTER (NOT is_train), 2) AS test_volume FROM sp) CROSS JOIN
            (VALUES ('linear_regression'), ('ridge'), ('lasso'), ('random_forest'), ('gradient_boosting')) m(model)""",
)
def y06(t):
    """Five full models beside the split they were fitted on; a mean error is never above the root mean square error, nor
    R2 above one."""
    train, test, features = _revenue_sets(t)
    size = lambda x, name: x.agg(F.count("*").alias(f"n_{name}"), F.round(F.sum("label"), 2).alias(f"{name}_volume"))
    n_train, n_test = size(train, "train").first(), size(test, "test").first()
    r = ml.compare_regressors(train, test, features, "label", ml.regressors("label", rows=n_train.n_train))
    return r.select(
        "model",
        *[F.lit(row[c]).alias(c) for row in (n_train, n_test) for c in row.__fields__],
        ((F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse") * (1 + 1e-9))).alias("errors_ordered"),
        (F.col("r2") <= 1).alias("r2_at_most_one"),
    )


#: Volume from last month's volume and count: centred sums of squares of the training months, solved by determinants. The
#: ridge penalty of 1 lies on weights of features divided by their deviation.
CLOSED_SQL = f"""WITH {REVENUE_SPLIT_SQL},
       s AS (SELECT COUNT(*) AS n, AVG(a) AS ma, AVG(b) AS mb, AVG(y) AS my, STDDEV_SAMP(a) AS sa, STDDEV_SAMP(b) AS sb FROM sp WHERE is_train),
       g AS (SELECT p.l, SUM((a - ma) / sa * (a - ma) / sa) + p.l AS aa, SUM((a - ma) / sa * (b - mb) / sb) AS ab,
                    SUM((b - mb) / sb * (b - mb) / sb) + p.l AS bb, SUM((a - ma) / sa * (y - my)) AS ay, SUM((b - mb) / sb * (y - my)) AS byy
             FROM sp, s, (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) p(l) WHERE is_train GROUP BY p.l),
       w AS (SELECT l, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS wa, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM g),
       e AS (SELECT l, y, y - (my + (a - ma) / sa * wa + (b - mb) / sb * wb) AS d FROM sp, s, w WHERE NOT is_train)"""


@query(
    "y06_closed_form_errors",
    CLOSED_SQL + """ SELECT CASE WHEN l = 0 THEN 'linear_regression' ELSE 'ridge' END AS model, ROUND(AVG(abs(d)), 2) AS mae,
              ROUND(sqrt(AVG(d * d)), 2) AS rmse, ROUND(1 - SUM(d * d) / (VAR_POP(y) * COUNT(*)), 6) AS r2, ROUND(AVG(abs(d / y)) * 100, 6) AS mape
       FROM e GROUP BY l""",
)
def y06_errors(t):
    train, test, _ = _revenue_sets(t)
    from ..operators.reshape import union_all

    out = []
    for name, ridge in (("linear_regression", 0.0), ("ridge", 1.0)):
        fit = ml.closed_form(train, ["volume_lag_1", "count_lag_1"], "label", ridge)
        m = ml.regression_metrics(test.withColumn("_p", fit.predict()), "label", "_p")
        out.append(m.select(F.lit(name).alias("model"), F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"), F.round("r2", 6).alias("r2"), F.round("mape", 6).alias("mape")))
    return union_all(out)


@query(
    "y06_closed_form_coefficients",
    CLOSED_SQL + """, c AS (SELECT CASE WHEN l = 0 THEN 'linear_regression' ELSE 'ridge' END AS model, my - wa / sa * ma - wb / sb * mb AS c0, wa / sa AS c1, wb / sb AS c2
                    FROM w, s)
       SELECT model, '(intercept)' AS feature, ROUND(c0, 2) AS coefficient FROM c
       UNION ALL SELECT model, 'volume_lag_1', ROUND(c1, 6) FROM c UNION ALL SELECT model, 'count_lag_1', ROUND(c2, 4) FROM c""",
)
def y06_coefficients(t):
    from ..operators.reshape import union_all

    train, _, _ = _revenue_sets(t)
    digits = F.when(F.col("feature") == "(intercept)", 2).when(F.col("feature") == "volume_lag_1", 6).otherwise(4)
    out = []
    for name, ridge in (("linear_regression", 0.0), ("ridge", 1.0)):
        c = ml.closed_form(train, ["volume_lag_1", "count_lag_1"], "label", ridge).coefficients(t.spark)
        scale = F.pow(F.lit(10.0), digits)
        out.append(c.select(F.lit(name).alias("model"), "feature", (F.round(F.col("coefficient") * scale) / scale).alias("coefficient")))
    return union_all(out)


@query(
    "y07_classification_metrics",
    """SELECT tp, fp, fn, tn, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy,
              CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS precision,
              CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS recall,
              CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1, ROUND(auc, 6) AS auc FROM (
         SELECT CAST(COUNT_IF(quality = 1 AND prediction = 1) AS BIGINT) AS tp, CAST(COUNT_IF(quality <> 1 AND prediction = 1) AS BIGINT) AS fp,
                CAST(COUNT_IF(quality = 1 AND prediction <> 1) AS BIGINT) AS fn, CAST(COUNT_IF(quality <> 1 AND prediction <> 1) AS BIGINT) AS tn
         FROM scored_docs), (
         SELECT AVG(CASE WHEN a.score > b.score THEN 1.0::DOUBLE WHEN a.score = b.score THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) AS auc
         FROM scored_docs a, scored_docs b WHERE a.quality = 1 AND b.quality <> 1)""",
)
def y07(t):
    from ..operators.reshape import combine_single_rows

    d = scored_docs(t)
    auc = ml.area_under_roc(ml.roc_points(d, "quality", "score")).select(F.round("auc", 6).alias("auc"))
    return combine_single_rows([ml.classification_metrics(d, "quality", "prediction"), auc])


PRED_SQL = """SELECT revenue_month, CAST(monthly_volume AS DOUBLE) AS actual,
       CAST(monthly_transactions AS DOUBLE) * 50000 AS predicted FROM monthly"""


def _predicted(t):
    return build.monthly(t).select(
        "revenue_month", F.col("monthly_volume").cast("double").alias("actual"),
        (F.col("monthly_transactions").cast("double") * 50000).alias("predicted"),
    )


@query(
    "y08_regression_metrics",
    f"""WITH p AS ({PRED_SQL}) SELECT ROUND(AVG(ABS(actual - predicted)), 4) AS mae,
              ROUND(SQRT(AVG((actual - predicted) * (actual - predicted))), 4) AS rmse,
              ROUND(1 - SUM((actual - predicted) * (actual - predicted)) / (VAR_POP(actual) * COUNT(*)), 6) AS r2,
              ROUND(AVG(ABS((actual - predicted) / actual)) * 100, 6) AS mape FROM p""",
)
def y08(t):
    m = ml.regression_metrics(_predicted(t), "actual", "predicted")
    return m.select(F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"), F.round("mape", 6).alias("mape"))


@query(
    "y09_confusion_matrix",
    """SELECT quality, CAST(COUNT_IF(prediction = 0) AS BIGINT) AS predicted_0, CAST(COUNT_IF(prediction = 1) AS BIGINT) AS predicted_1
       FROM scored_docs GROUP BY quality""",
)
def y09(t):
    return ml.confusion_matrix(scored_docs(t), "quality", "prediction")


@query(
    "y10_roc_points",
    """SELECT score, CAST(SUM(p) OVER w AS DOUBLE) / (SELECT COUNT(*) FROM scored_docs WHERE quality = 1) AS tpr,
              CAST(SUM(n) OVER w AS DOUBLE) / (SELECT COUNT(*) FROM scored_docs WHERE quality <> 1) AS fpr FROM (
         SELECT score, COUNT_IF(quality = 1) AS p, COUNT_IF(quality <> 1) AS n FROM scored_docs GROUP BY score)
       WINDOW w AS (ORDER BY score DESC)""",
)
def y10(t):
    return ml.roc_points(scored_docs(t), "quality", "score").select("score", "tpr", "fpr")


_CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, ROUND(CORR(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS correlation FROM churn"
    for a in FEATURES
    for b in FEATURES
)


@query("y11_correlation_matrix", _CORR)
def y11(t):
    return ml.correlation_matrix(build.churn(t), FEATURES).withColumn("correlation", F.round("correlation", 6))


@query(
    "y12_feature_importance",
    f"""SELECT {len(CHURN_FEATURES) - 2} AS n_features, 1.0::DOUBLE AS total, TRUE AS ranked, COUNT(*) AS n_train
        FROM {CHURN_SPLIT_SQL} WHERE is_train""",
)
def y12(t):
    """Importances of a full forest: one for each feature, in order, summing to one."""
    train, _, features = _churn_sets(t)
    prep = ml.scaled(train, features)
    model = ml.classifiers("label")["random_forest"].fit(prep.transform(train))
    i = ml.feature_importance(t.spark, model, features)
    by_rank = F.transform(F.array_sort(F.collect_list(F.struct("importance_rank", "importance"))), lambda x: x["importance"])
    falling = F.array_sort(by_rank, lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0))
    out = i.agg(F.count_distinct("feature").cast("int").alias("n_features"), F.round(F.sum("importance"), 6).alias("total"), (by_rank == falling).alias("ranked"))
    return out.withColumn("n_train", F.lit(train.count()))


@query(
    "y13_best_model",
    """SELECT model, accuracy FROM (
         SELECT 'length_rule' AS model, AVG(CASE WHEN quality = prediction THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM scored_docs
         UNION ALL SELECT 'always_good', AVG(CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0 END) FROM scored_docs)
       ORDER BY accuracy DESC, model LIMIT 1""",
)
def y13(t):
    d = scored_docs(t)
    rule = ml.classification_metrics(d, "quality", "prediction").withColumn("model", F.lit("length_rule"))
    always = d.withColumn("prediction", F.lit(1))
    both = rule.unionByName(ml.classification_metrics(always, "quality", "prediction").withColumn("model", F.lit("always_good")))
    return ml.best_model(both, "accuracy").select("model", "accuracy")


@query("y14_save_load_score", "SELECT COUNT(*) AS n_scored, COUNT(*) AS n_equal FROM customers")
def y14(t):
    root = scratch(t.spark, "model")
    c = ml.numeric_features(t.customers(), ["credit_score", "annual_income"])
    model = ml.scaled(c, ["credit_score", "annual_income"])
    ml.save_model(model, root, "scaler", 1)
    fresh = model.transform(c).select("customer_id", vector_to_array("features").alias("a"))
    again = ml.load_and_score(c, root, "scaler", 1).select("customer_id", vector_to_array("features").alias("b"))
    return fresh.join(again, "customer_id").agg(
        F.count("*").alias("n_scored"), F.count_if(F.col("a") == F.col("b")).alias("n_equal")
    )


@query(
    "y15_revenue_features",
    """WITH f AS (SELECT revenue_month, CAST(monthly_volume AS DOUBLE) AS v, CAST(monthly_transactions AS DOUBLE) AS c FROM monthly)
       SELECT strftime(revenue_month, '%Y-%m-%d') AS revenue_month, volume_lag_1, volume_lag_3, count_lag_2,
              ROUND(volume_roll_6, 4) AS volume_roll_6, ROUND(count_roll_3, 6) AS count_roll_3, growth FROM (
         SELECT revenue_month, LAG(v, 1) OVER w AS volume_lag_1, LAG(v, 3) OVER w AS volume_lag_3, LAG(c, 2) OVER w AS count_lag_2,
                AVG(v) OVER (ORDER BY revenue_month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS volume_roll_6,
                AVG(c) OVER (ORDER BY revenue_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS count_roll_3,
                v / LAG(v, 1) OVER w - 1 AS growth, ROW_NUMBER() OVER w AS rn FROM f WINDOW w AS (ORDER BY revenue_month)) WHERE rn >= 6""",
)
def y15(t):
    r = ml.revenue_features(build.monthly(t))
    return build.days(r, "revenue_month").select(
        "revenue_month", "volume_lag_1", "volume_lag_3", "count_lag_2", F.round("volume_roll_6", 4).alias("volume_roll_6"),
        F.round("count_roll_3", 6).alias("count_roll_3"), "growth",
    )


@query(
    "y16_residuals",
    f"""WITH p AS ({PRED_SQL}) SELECT strftime(revenue_month, '%Y-%m-%d') AS revenue_month, actual, predicted,
        actual - predicted AS residual FROM p""",
)
def y16(t):
    return build.days(_predicted(t).withColumn("residual", F.col("actual") - F.col("predicted")), "revenue_month")


@query(
    "y17_histogram",
    """SELECT CAST(CASE WHEN value = hi THEN 30 ELSE floor((value - lo) / ((hi - lo) / 30)) + 1 END AS INTEGER) AS bin, COUNT(*) AS n
       FROM (SELECT CAST(balance AS DOUBLE) AS value FROM accounts),
            (SELECT CAST(MIN(balance) AS DOUBLE) AS lo, CAST(MAX(balance) AS DOUBLE) AS hi FROM accounts) WHERE value IS NOT NULL GROUP BY 1""",
)
def y17(t):
    a = t.accounts()
    edges = a.agg(F.min("balance").cast("double").alias("lo"), F.max("balance").cast("double").alias("hi")).first()
    return ml.histogram(a.where(F.col("balance").isNotNull()), "balance", 30, F.lit(edges["lo"]), F.lit(edges["hi"]))


@query(
    "y18_class_balance",
    """SELECT is_churned, COUNT(*) AS n, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM churn) AS share FROM churn GROUP BY is_churned""",
)
def y18(t):
    return ml.class_balance(build.churn(t), "is_churned")
