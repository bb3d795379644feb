"""Feature preparation and regressions for next-period change, on Spark ML."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from quarterdeck.functions.missing import to_number
from quarterdeck.operators import moments


def prepare(df: DataFrame, numeric: Sequence[str], ticker: str | None = None, key: str = "Ticker") -> DataFrame:
    """Rows of one ticker (or all), numbers coerced, rows with a gap dropped."""
    if ticker is not None:
        df = df.filter(F.col(key) == ticker)
    return df.withColumns({c: to_number(c) for c in numeric}).dropna(subset=list(numeric))


def histogram(df: DataFrame, c: str, bins: int = 100) -> DataFrame:
    """Rows per equal-width bin between minimum and maximum; the maximum falls into the last bin."""
    ends = df.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"))).scalar()
    lo, hi = ends["lo"], ends["hi"]
    bucket = F.least(F.width_bucket(F.col(c), lo, hi, F.lit(bins)), F.lit(bins))
    return df.filter(F.col(c).isNotNull()).groupBy(bucket.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("rows"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one pass however many there are."""
    return moments.correlation_pairs(df, columns, columns).filter("i < j").select("a", "b", "correlation")


def top_correlations(df: DataFrame, columns: Sequence[str], target: str, n: int = 10) -> DataFrame:
    """The ``n`` strongest positive and the ``n`` strongest negative features against the target."""
    features = [c for c in columns if c != target]
    long = moments.correlation_pairs(df, features, [target]).select(F.col("a").alias("feature"), "correlation").filter(F.col("correlation").isNotNull())
    up = long.filter("correlation > 0").orderBy(F.col("correlation").desc(), "feature").limit(n)
    down = long.filter("correlation < 0").orderBy("correlation", "feature").limit(n)
    return up.withColumn("side", F.lit("positive")).unionByName(down.withColumn("side", F.lit("negative")))


def one_hot(df: DataFrame, c: str, values: Sequence[str]) -> DataFrame:
    """A 0/1 column per known value; the source column goes."""
    return df.withColumns({f"{c}_{v}": (F.coalesce(F.col(c) == v, F.lit(False))).cast("int") for v in values}).drop(c)


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, list(columns))


def hash_split(df: DataFrame, keys: Sequence[str], share: float = 0.7, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of their key: the same rows on every run and every cluster."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    slot = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 10000
    mark = df.withColumn("_slot", slot)
    edge = int(share * 10000)
    return mark.filter(F.col("_slot") < edge).drop("_slot"), mark.filter(F.col("_slot") >= edge).drop("_slot")


def min_max_scaled(df: DataFrame, columns: Sequence[str], by: DataFrame) -> DataFrame:
    """Columns scaled to [0, 1] by the smallest and largest value of the rows ``by``; 0.5 where they are equal."""
    ends = by.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]).first()

    def scaled(c: str):
        lo, hi = ends[c]["lo"], ends[c]["hi"]
        return F.lit(0.5) if lo is None or lo == hi else (F.col(c) - F.lit(lo)) / F.lit(hi - lo)

    return df.withColumns({c: scaled(c) for c in columns})


def linear_scores(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """RMSE, MSE and MAE on the test rows of least squares without intercept, on the features as they are and scaled by the training rows."""
    train, test = hash_split(df, keys)
    out = []
    for name, prepared in (("linear", lambda rows: rows), ("linear_scaled", lambda rows: min_max_scaled(rows, features, train))):
        fitted = moments.least_squares(prepared(train), features, target)
        scored = prepared(test).withColumn("prediction", moments.linear(fitted))
        out.append(moments.errors(scored, target).select(F.lit(name).alias("model"), "*"))
    return out[0].unionByName(out[1])


def linear_model(features: Sequence[str], target: str, scaled: bool = False) -> Pipeline:
    """Least squares without intercept, optionally on features scaled to [0, 1] by the training rows."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="raw" if scaled else "features")]
    if scaled:
        stages.append(MinMaxScaler(inputCol="raw", outputCol="features"))
    stages.append(LinearRegression(labelCol=target, fitIntercept=False))
    return Pipeline(stages=stages)


def forest_model(features: Sequence[str], target: str, trees: int = 5, depth: int = 10, seed: int = 42) -> Pipeline:
    """Random forest. Spark's trees end at depth 30, so a deeper one is refused."""
    if depth > 30:
        raise ValueError(f"depth {depth}: trees of at most 30 levels")
    forest = RandomForestRegressor(labelCol=target, numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), forest])


def evaluate(spark, predictions: DataFrame, target: str, model: str) -> DataFrame:
    """RMSE, MSE and MAE of predictions as one row."""
    scores = [RegressionEvaluator(labelCol=target, metricName=m).evaluate(predictions) for m in ("rmse", "mse", "mae")]
    return spark.createDataFrame([(model, *[float(s) for s in scores])], "model string, rmse double, mse double, mae double")


def fit_and_score(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], models: dict[str, Pipeline]) -> DataFrame:
    """Fit each pipeline on the training rows and score it on the others."""
    train, test = hash_split(df, keys)
    out = None
    for name, pipeline in models.items():
        row = evaluate(df.sparkSession, pipeline.fit(train).transform(test), target, name)
        out = row if out is None else out.unionByName(row)
    return out


def coefficients(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Coefficients of the linear model on all rows."""
    fitted = moments.least_squares(df, features, target)
    return df.sparkSession.createDataFrame(list(fitted.items()), "feature string, coefficient double")
