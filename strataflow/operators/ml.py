"""Feature preparation, models and evaluation on pyspark.ml (Y)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .joins import broadcast_groups
from .reshape import combine_single_rows, union_all
from .windows import global_position, lagged, row_frames, running_totals

SEED = 42


def numeric_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as doubles without nulls."""
    return df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(numeric_features(df, features))


def stratified_split(df: DataFrame, label: str, key: str, share: float = 0.8, seed: int = SEED) -> DataFrame:
    """`is_train` for the first share of every class in a hash order of the key.

    Exact per class. Positions come from one order over all rows, cut at the class starts,
    so a large class is not ranked in one task. The classes are counted before they are broadcast.
    """
    shuffled = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))
    placed = global_position(df.withColumn("_h", shuffled), [F.asc(label), F.asc("_h"), F.asc(key)], "_pos")
    classes = placed.groupBy(F.col(label).alias("_label")).agg(
        F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("_n")
    )
    out = placed.join(broadcast_groups(classes), F.col(label).eqNullSafe(F.col("_label")))
    inside = F.col("_pos") - F.col("_start")
    return out.withColumn("is_train", inside < F.floor(F.col("_n") * share)).drop("_h", "_pos", "_label", "_start", "_n")


def time_split(df: DataFrame, time: str, share: float = 0.8) -> DataFrame:
    """`is_train` for the earliest share of the rows."""
    placed = global_position(df, [F.asc(time)], "_pos", "_n")
    return placed.withColumn("is_train", F.col("_pos") <= F.floor(F.col("_n") * share)).drop("_pos", "_n")


def scaled(train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Assembler and standard scaler fitted on the training rows only."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]
    return Pipeline(stages=stages).fit(train)


def classifiers(label: str, trees: int = 100, iterations: int = 1000, boosting: int = 100) -> dict[str, object]:
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "logistic_regression": LogisticRegression(maxIter=iterations, **common),
        "random_forest": RandomForestClassifier(numTrees=trees, seed=SEED, **common),
        "gradient_boosting": GBTClassifier(maxIter=boosting, seed=SEED, **common),
    }


def regressors(label: str, rows: int, trees: int = 100, boosting: int = 100) -> dict[str, object]:
    """Models by name. `rows` are the training rows: the ridge penalty of 1 belongs to a sum over rows, this loss is a
    mean."""
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "linear_regression": LinearRegression(**common),
        "ridge": LinearRegression(regParam=1.0 / max(rows, 1), elasticNetParam=0.0, **common),
        "lasso": LinearRegression(regParam=1.0, elasticNetParam=1.0, **common),
        "random_forest": RandomForestRegressor(numTrees=trees, seed=SEED, **common),
        "gradient_boosting": GBTRegressor(maxIter=boosting, seed=SEED, **common),
    }


@dataclass(frozen=True)
class LinearFit:
    """A linear model on standardised features: what the features' means, deviations and weights are."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    weights: tuple[float, ...]
    intercept: float

    def predict(self) -> Column:
        out = F.lit(self.intercept)
        for f, m, s, w in zip(self.features, self.means, self.deviations, self.weights, strict=True):
            out = out + (F.col(f).cast("double") - m) / s * w
        return out

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """(feature, coefficient) in the features' own units, the intercept among them."""
        own = [w / s for w, s in zip(self.weights, self.deviations, strict=True)]
        at_zero = self.intercept - sum(c * m for c, m in zip(own, self.means, strict=True))
        return spark.createDataFrame([("(intercept)", at_zero), *zip(self.features, own, strict=True)], "feature string, coefficient double")


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: count, means and all covariances of some columns, in one pass; its size depends on the columns alone.

    Covariances are merged around running means, so large values with small spread lose nothing."""
    value = {c: F.col(c).cast("double") for c in columns}
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(v).alias(f"mean_{c}") for c, v in value.items()],
        *[F.covar_samp(value[a], value[b]).alias(f"cov_{a}_{b}") for a, b in pairs],
    )


def closed_form(train: DataFrame, features: Sequence[str], label: str, ridge: float = 0.0) -> LinearFit:
    """Least squares from the normal equations of one `moments` row, with a penalty on standardised weights.

    `ridge` belongs to the sum of squared errors. A feature without spread gets no weight; of features that depend on each
    other the smallest weights that solve the equations are taken.
    """
    columns = [*features, label]
    m = moments(train, columns).first()
    cov = np.array([[m[f"cov_{a}_{b}" if i <= j else f"cov_{b}_{a}"] or 0.0 for j, b in enumerate(columns)] for i, a in enumerate(columns)])
    spread = np.sqrt(np.diag(cov))[:-1]
    scale = np.where(spread > 0, spread, 1.0)
    gram = (m["n"] - 1) * cov[:-1, :-1] / np.outer(scale, scale)
    target = (m["n"] - 1) * cov[:-1, -1] / scale
    weights = np.linalg.lstsq(gram + ridge * np.eye(len(features)), target, rcond=None)[0]
    means = tuple(float(m[f"mean_{f}"]) for f in features)
    return LinearFit(tuple(features), means, tuple(map(float, scale)), tuple(map(float, weights)), float(m[f"mean_{label}"]))


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class, from four counts."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    c = df.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))

    def share(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    return c.select(
        "tp", "fp", "fn", "tn",
        share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score, from the highest down: true and false positive rates.

    Rows are first counted per score; the running counts use score blocks, so no task walks
    all scores. Scores are probabilities in [0, 1].
    """
    counts = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
        .withColumn("_all", F.lit(0))
    )
    totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    running = running_totals(counts, ["_all"], [F.desc("score")], -F.col("score"), {"tp": F.col("pos"), "fp": F.col("neg")})
    out = running.withColumn("_t", totals).withColumns({"_p": F.col("_t.p"), "_n": F.col("_t.n")})
    return out.select(
        "score", "pos", "neg", "tp", "fp",
        (F.col("tp") / F.nullif(F.col("_p"), F.lit(0))).alias("tpr"),
        (F.col("fp") / F.nullif(F.col("_n"), F.lit(0))).alias("fpr"),
    )


def area_under_roc(points: DataFrame) -> DataFrame:
    """Trapezoids between the points; each point knows the step that led to it."""
    step = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    return points.agg((F.sum(step) / F.max("fp") / F.max("tp")).alias("auc"))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE, R2 and MAPE (null if any actual value is zero)."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    err = y - p
    s = df.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(y) * F.count(y)).alias("_sst"),
        F.avg(F.abs(err / F.nullif(y, F.lit(0.0)))).alias("_mape"),
        F.count_if(y == 0).alias("_zeros"),
    )
    return s.select(
        "mae", "rmse",
        F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.col("_sst")).alias("r2"),
        F.when(F.col("_zeros") == 0, F.col("_mape") * 100).alias("mape"),
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    return df.groupBy(label).agg(*[F.count_if(F.col(prediction) == c).alias(f"predicted_{c}") for c in classes])


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of every feature pair in long form; the matrix has one cell per pair."""
    vec = assemble(df, features).select("features")
    m = Correlation.corr(vec, "features").first()[0].toArray()
    rows = [(a, b, float(m[i][j])) for i, a in enumerate(features) for j, b in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, correlation double")


def feature_importance(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    values = model.featureImportances.toArray()
    rows = sorted(((f, float(v)) for f, v in zip(features, values)), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(
        [(i + 1, f, v) for i, (f, v) in enumerate(rows)], "importance_rank int, feature string, importance double"
    )


def compare_classifiers(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, models: dict[str, object]) -> DataFrame:
    """Fit each model on scaled training rows, one row of test metrics per model."""
    prep = scaled(train, features)
    fit_rows, test_rows = stage(prep.transform(train)), prep.transform(test)
    out = []
    for name, model in models.items():
        scored = model.fit(fit_rows).transform(test_rows)
        scored = scored.withColumn("_score", vector_to_array("probability")[1])
        auc = area_under_roc(roc_points(scored, label, "_score"))
        row = combine_single_rows([classification_metrics(scored, label, "prediction"), auc])
        out.append(row.withColumn("model", F.lit(name)))
    return union_all(out)


def compare_regressors(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, models: dict[str, object]) -> DataFrame:
    prep = scaled(train, features)
    fit_rows, test_rows = stage(prep.transform(train)), prep.transform(test)
    return union_all(
        [
            regression_metrics(m.fit(fit_rows).transform(test_rows), label, "prediction").withColumn("model", F.lit(n))
            for n, m in models.items()
        ]
    )


def best_model(results: DataFrame, metric: str, higher_is_better: bool = True) -> DataFrame:
    order = F.desc_nulls_last(metric) if higher_is_better else F.asc_nulls_last(metric)
    return results.orderBy(order, "model").limit(1)


def model_path(root: str, name: str, version: int) -> str:
    return f"{root}/models/{name}/v{version}"


def save_model(model: PipelineModel, root: str, name: str, version: int) -> str:
    path = model_path(root, name, version)
    model.write().overwrite().save(path)
    return path


def load_and_score(df: DataFrame, root: str, name: str, version: int) -> DataFrame:
    return PipelineModel.load(model_path(root, name, version)).transform(df)


def revenue_features(monthly: DataFrame, volume: str = "monthly_volume", count: str = "monthly_transactions") -> DataFrame:
    """Lags 1 to 3, rolling means of 3 and 6 full months and growth; incomplete months are dropped."""

    def rolling(c: str, n: int):
        def mean(w):
            f = w.rowsBetween(-(n - 1), 0)
            return F.when(F.count(F.lit(1)).over(f) >= n, F.avg(c).over(f))

        return n - 1, mean

    base = monthly.withColumns({volume: F.col(volume).cast("double"), count: F.col(count).cast("double")})
    frames = {f"volume_lag_{k}": lagged(volume, k) for k in (1, 2, 3)}
    frames |= {f"count_lag_{k}": lagged(count, k) for k in (1, 2, 3)}
    frames |= {"volume_roll_3": rolling(volume, 3), "volume_roll_6": rolling(volume, 6), "count_roll_3": rolling(count, 3)}
    frames["growth"] = (1, lambda w: F.col(volume) / F.lag(volume, 1).over(w) - 1)
    # One row per month: a constant key holds no more rows than the calendar has months.
    keyed = base.withColumn("_all", F.lit(0))
    out = row_frames(keyed, ["_all"], [F.asc("revenue_month")], F.year("revenue_month"), frames)
    return out.drop("_all").dropna(subset=list(frames))


def histogram(df: DataFrame, column: str, bins: int, low: Column, high: Column) -> DataFrame:
    """Equal-width bins between two bounds; the upper bound belongs to the last bin."""
    value = F.col(column).cast("double")
    raw = F.width_bucket(value, low.cast("double"), high.cast("double"), F.lit(bins))
    binned = F.when(value == high.cast("double"), F.lit(bins)).otherwise(raw).cast("int").alias("bin")
    return df.where(value.isNotNull()).groupBy(binned).agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    total = df.agg(F.count(F.lit(1))).scalar()
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.col("n") / total)
