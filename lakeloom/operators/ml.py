"""Logistic regression on gold features: feature prep, time split, train, evaluate, predict.

Training is Spark ML's distributed L-BFGS (one aggregation job per iteration); evaluation is
one aggregate for the confusion counts and log loss plus the binned ROC of
``BinaryClassificationEvaluator`` — no prediction is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, TargetEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.session import shared_dir


def features(df: DataFrame, numeric: Sequence[str], label_expr: Column | None = None, label: str = "label",
             keep: Sequence[str] = ()) -> DataFrame:
    """Feature selection plus a boolean label expression cast to double (0/1)."""
    cols = [*keep, *numeric]
    out = df.select(*[F.col(c) for c in dict.fromkeys(cols)], *([label_expr.alias(label)] if label_expr is not None else []))
    if label_expr is not None:
        out = out.withColumn(label, F.col(label).cast("double"))
    return out.withColumns({c: F.col(c).cast("double") for c in numeric})


def split_time(df: DataFrame, ts: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """(train, test): rows before ``cut`` train the model, rows from ``cut`` on evaluate it."""
    bound = F.lit(cut).cast(dict(df.dtypes)[ts])
    return df.filter(F.col(ts) < bound), df.filter(F.col(ts) >= bound)


def earlier_days(df: DataFrame, key: str, day: str, values: Sequence[str], prefix: str = "earlier_", scale: int = 6) -> DataFrame:
    """Adds ``ln(1 + sum over the key's earlier days)`` of each value, rounded; what the day itself holds can't leak into it.

    The window runs over one row per key and day, so a key's partition is bounded by the days.
    """
    before = Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(F.col(c).cast("double")).over(before), F.lit(0.0))
    return df.withColumns({f"{prefix}{c}": F.round(F.log1p(total(c)), scale) for c in values})


def build_pipeline(numeric: Sequence[str], categorical: Sequence[str] = (), label: str = "label",
                   reg_param: float = 0.0, max_iter: int = 100, encoder: str = "onehot", smoothing: float = 0.0,
                   threshold: float = 0.5, tol: float = 1e-6) -> Pipeline:
    """Encoders, assembler and logistic regression.

    ``encoder`` is ``onehot`` (one column a category) or ``target`` (a category's share of positive labels, pulled to the
    share of all rows by ``smoothing`` rows; a new category has that share): the latter stays one column for any number of categories.
    """
    if encoder not in ("onehot", "target"):
        raise ValueError(f"unknown encoder {encoder}")
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in categorical]
    if encoder == "target" and categorical:
        stages.append(TargetEncoder(inputCols=[f"{c}__idx" for c in categorical], outputCols=[f"{c}__vec" for c in categorical],
                                    labelCol=label, targetType="binary", smoothing=smoothing, handleInvalid="keep"))
    else:
        stages += [OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__vec", handleInvalid="keep") for c in categorical]
    stages.append(VectorAssembler(inputCols=[*numeric, *[f"{c}__vec" for c in categorical]], outputCol="features", handleInvalid="keep"))
    stages.append(LogisticRegression(featuresCol="features", labelCol=label, regParam=reg_param, maxIter=max_iter, tol=tol,
                                     threshold=threshold))
    return Pipeline(stages=stages)


def train(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), label: str = "label",
          reg_param: float = 0.0, max_iter: int = 100, path: str | None = None, **how) -> PipelineModel:
    """Fits :func:`build_pipeline` (``how`` are its further parameters), saves the model at ``path`` (default: a folder below
    the shared one) and returns it as loaded from there: a model that was just fitted carries a summary bound to its
    session, which can't be sent to executors once that session observes a write (``quality.write_checked``)."""
    fitted = build_pipeline(numeric, categorical, label, reg_param, max_iter, **how).fit(df)
    return load(store(fitted, path or shared_dir(df.sparkSession, "model")))


def store(model: PipelineModel, path: str) -> str:
    """Saves a fitted model; :func:`load` reads it wherever it is used."""
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def coefficients(model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Model weights as a small DataFrame (feature, coefficient) plus the intercept."""
    lr = model.stages[-1]
    names = list(names) + [f"f{i}" for i in range(len(names), lr.numFeatures)]
    rows = [(n, float(w)) for n, w in zip(names, lr.coefficients.toArray())] + [("intercept", float(lr.intercept))]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, coefficient double")


def predict(model: PipelineModel, df: DataFrame, label_name: str = "predicted_label") -> DataFrame:
    """Input columns plus the predicted label and the probability of the positive class."""
    out = model.transform(df)
    return out.select(*df.columns, F.col("prediction").alias(label_name),
                      vector_to_array("probability")[1].alias("probability"))


def evaluate(model: PipelineModel, df: DataFrame, label: str = "label", bins: int = 1000) -> DataFrame:
    """One row: precision, recall, accuracy, f1_score, log_loss, roc_auc (positive class 1).

    The curve has ``bins`` points; 0 takes every distinct score.
    """
    scored = model.transform(df)
    p1 = vector_to_array("probability")[1]
    eps = F.lit(1e-15)
    clipped = F.least(F.greatest(p1, eps), 1 - eps)
    y = F.col(label)
    counts = scored.agg(
        F.count_if((F.col("prediction") == 1) & (y == 1)).alias("tp"),
        F.count_if((F.col("prediction") == 1) & (y == 0)).alias("fp"),
        F.count_if((F.col("prediction") == 0) & (y == 0)).alias("tn"),
        F.count_if((F.col("prediction") == 0) & (y == 1)).alias("fn"),
        F.avg(-(y * F.log(clipped) + (1 - y) * F.log(1 - clipped))).alias("log_loss"),
    )
    auc = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol=label,
                                        metricName="areaUnderROC", numBins=bins).evaluate(scored)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    return counts.select(
        precision.alias("precision"), recall.alias("recall"),
        ((tp + tn) / (tp + tn + fp + fn)).alias("accuracy"),
        F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0)).alias("f1_score"),
        F.col("log_loss"), F.lit(float(auc)).alias("roc_auc"))


def predicted_by(predictions: DataFrame, key: str, n: int = 10, prediction: str = "predicted_label") -> DataFrame:
    """SUM(predicted label) per key, top ``n`` (ties broken by key)."""
    s = predictions.groupBy(key).agg(F.sum(prediction).alias("total_predicted"))
    return s.orderBy(F.col("total_predicted").desc(), F.col(key)).limit(n)
