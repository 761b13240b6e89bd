"""Out-of-fold predictions and batch scoring with Spark ML."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.columns import quadrant, quadrant_name
from corpusflow.session import stage

# More folds than this are a wrong column, not a plan.
MAX_FOLDS = 100


def _assembler(features: Sequence[str]) -> VectorAssembler:
    # A training-ready table has no gaps; one that does is an error, not a silent loss of rows.
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error")


def _regressor(target: str, out: str, weight: str | None) -> LinearRegression:
    fit = LinearRegression(
        featuresCol="_features", labelCol=target, predictionCol=out, solver="normal"
    )
    return fit.setWeightCol(weight) if weight else fit


def _clip(name: str):
    return F.least(F.greatest(F.col(name), F.lit(0.0)), F.lit(1.0)).alias(name)


def _moments(columns: Sequence[str], weight: Column) -> list[Column]:
    """Weighted sums of all products of two columns, by rows of the upper triangle."""
    return [
        F.sum(weight * F.col(a) * F.col(b)).alias(f"{a}*{b}") for i, a in enumerate(columns) for b in columns[i:]
    ]


def _solve(gram: np.ndarray, k: int) -> np.ndarray:
    """(target, coefficient) of weighted least squares: the intercept, then one for each of ``k`` features.

    ``gram`` has the products of (1, features, targets). Features are centred and scaled; one that does not
    vary, or repeats others, gets the least coefficients that fit.
    """
    mean = gram[0] / gram[0, 0]
    spread = gram - np.outer(mean, mean) * gram[0, 0]
    x, y = slice(1, 1 + k), slice(1 + k, None)
    scale = np.sqrt(np.maximum(np.diag(spread)[x], 0.0))
    # Of a constant feature only rounding is left.
    scale[scale <= 1e-7 * np.sqrt(np.diag(gram)[x])] = 0.0
    safe = np.where(scale > 0, scale, 1.0)
    varies = np.outer(scale > 0, scale > 0)
    within = np.where(varies, spread[x, x] / np.outer(safe, safe), 0.0)
    found, *_ = np.linalg.lstsq(within, np.where(scale > 0, 1 / safe, 0.0)[:, None] * spread[x, y], rcond=1e-10)
    slopes = np.where(scale > 0, 1 / safe, 0.0)[:, None] * found
    return np.column_stack([mean[y] - mean[x] @ slopes, slopes.T])


def cross_fit(
    df: DataFrame,
    features: Sequence[str],
    targets: tuple[str, str],
    fold: str = "fold",
    weight: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Predict every row with a weighted regression that never saw its fold.

    One aggregation gives the sums of products (Gram matrix) of every fold; a model's matrix is the total
    less its own fold's, solved on the driver with a few numbers for each pair of columns. Returns (``keep``,
    fold, y_v, y_e, p_v, p_e) for every row, predictions in [0, 1].

    The folds are those of the ``fold`` column; a row without a fold, more than ``MAX_FOLDS`` of them, and a
    feature that is NULL or NaN are an error. Rows without a target or weight teach nothing but are
    predicted. With a single fold nothing is left to learn from, and predictions are NULL.
    """
    k = len(features)
    names = ["_one", *[f"_x{i}" for i in range(k)], "_v", "_e"]
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    plain = df.select(
        *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)],
        F.col(fold).alias("_fold"),
        F.lit(1.0).alias("_one"),
        *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)],
        *[F.col(t).cast("double").alias(n) for t, n in zip(targets, ("_v", "_e"))],
        w.alias("_w"),
    )
    # Read twice, for the sums and for the predictions: what the rows come from is worked out once.
    plain = stage(plain, "cross-fit")
    teaches = F.col("_v").isNotNull() & F.col("_e").isNotNull() & F.col("_w").isNotNull()
    used = F.when(teaches, F.col("_w")).otherwise(0.0)
    gap = reduce(lambda a, b: a | b, [F.col(n).isNull() | F.isnan(n) for n in names[1 : 1 + k]], F.lit(False))
    taught = plain.withColumn("_used", used).withColumns({n: F.coalesce(n, F.lit(0.0)) for n in ("_v", "_e")})
    sums = taught.groupBy("_fold").agg(F.count_if(gap).alias("_gaps"), *_moments(names, F.col("_used"))).limit(MAX_FOLDS + 1).collect()
    if any(r["_fold"] is None for r in sums) or len(sums) > MAX_FOLDS:
        raise ValueError(f"{fold} has more than {MAX_FOLDS} values" if len(sums) > MAX_FOLDS else f"{fold} has rows without a fold")
    if any(r["_gaps"] for r in sums):
        raise ValueError(f"rows without a number in {', '.join(features)}")

    upper = np.triu_indices(len(names))
    grams = {}
    for r in sums:
        grams[r["_fold"]] = np.zeros((len(names), len(names)))
        grams[r["_fold"]][upper] = r[2:]
        grams[r["_fold"]] += np.triu(grams[r["_fold"]], 1).T
    total = sum(grams.values(), np.zeros((len(names), len(names))))
    models = []
    for value, own in grams.items():
        rest = total - own
        lines = _solve(rest, k).tolist() if rest[0, 0] > 1e-9 * total[0, 0] else [None, None]
        models.append((value, *lines))
    kind = plain.schema["_fold"].dataType.simpleString()
    lines = df.sparkSession.createDataFrame(models, f"_fold {kind}, _bv array<double>, _be array<double>")

    def predicted(line: str, out: str) -> Column:
        value = reduce(lambda a, i: a + F.get(line, F.lit(i + 1)) * F.col(f"_x{i}"), range(k), F.get(line, F.lit(0)))
        return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))).alias(out)

    # One row a fold.
    return plain.join(F.broadcast(lines), "_fold").select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_fold").alias(fold),
        F.col("_v").alias("y_v"),
        F.col("_e").alias("y_e"),
        predicted("_bv", "p_v"),
        predicted("_be", "p_e"),
    )


def fit_final(
    df: DataFrame, features: Sequence[str], targets: tuple[str, str], weight: str | None = None
) -> dict[str, PipelineModel]:
    """One model per axis, fitted on all rows."""
    return {
        out: Pipeline(stages=[_assembler(features), _regressor(target, out, weight)]).fit(df)
        for target, out in zip(targets, ("p_v", "p_e"))
    }


def save_model(
    spark: SparkSession,
    models: dict[str, PipelineModel],
    path: str,
    vocab: DataFrame | None = None,
    config: dict | None = None,
) -> None:
    """Store both models with the vocabulary and the settings they were made with."""
    for out, model in models.items():
        model.write().overwrite().save(f"{path}/{out}")
    if vocab is not None:
        vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    text = spark.createDataFrame([(json.dumps(config or {}),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{path}/config")


def load_model(spark: SparkSession, path: str) -> tuple[dict[str, PipelineModel], dict]:
    models = {out: PipelineModel.load(f"{path}/{out}") for out in ("p_v", "p_e")}
    row = spark.read.text(f"{path}/config").first()
    return models, json.loads(row["value"]) if row else {}


def score(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Add both predictions, the quadrant and its name to every scorable row."""
    out = df
    for name in ("p_v", "p_e"):
        out = models[name].transform(out).drop("_features")
    rest = [c for c in out.columns if c not in ("p_v", "p_e")]
    clipped = out.select(*rest, _clip("p_v"), _clip("p_e"))
    return clipped.withColumn("quadrant", quadrant("p_v", "p_e")).withColumn(
        "quadrant_name", quadrant_name("quadrant")
    )
