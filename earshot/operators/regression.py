"""Linear models per listener, fitted for all listeners at once.

The rows are reduced to moments per listener in one aggregate: counts, means
and centred second moments. Everything else works on these few numbers: the
exact solution and each round of gradient descent need no further pass over the
rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions.columns import dot
from earshot.session import ship_with_jobs, stage

ship_with_jobs(__name__)

RANK_TOLERANCE = 1e-10
# rows of a listener that one task sums up alone
WHOLE_ROWS = 1 << 20


def labelled(
    plays: DataFrame, features: DataFrame, columns: Sequence[str], label: str = "play_count"
) -> DataFrame:
    """``(user_id, song_id, label, features…)``; rows with a missing value are dropped."""
    rows = plays.join(features.select("song_id", *columns), "song_id").select(
        "user_id", "song_id", F.col(label).cast("double").alias("label"),
        *[F.col(c).cast("double").alias(c) for c in columns],
    )
    return rows.dropna(subset=["label", *columns])


def user_moments(
    rows: DataFrame, features: Sequence[str], label: str = "label", whole_rows: int = WHOLE_ROWS
) -> DataFrame:
    """``(user_id, n_rows, means, label_mean, covariance, label_covariance, varies)`` per listener.

    ``covariance`` is the flattened symmetric matrix of the features, and
    ``label_variance`` the label's own. Spark
    merges centred second moments of parts stably, so a listener far from all
    others keeps its digits. The moments of a listener are hundreds of numbers,
    many times a row: rows are dealt by listener first, so that none of them are
    shuffled. Only listeners with more than ``whole_rows`` rows are reduced in
    each task before the shuffle, so one with very many rows is no burden.
    """
    d = len(features)
    names = [*features, label]
    complete = rows.dropna(subset=names).select("user_id", *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    pairs = [(i, j) for i in range(d + 1) for j in range(i, d + 1)]

    def summed(part: DataFrame) -> DataFrame:
        return part.groupBy("user_id").agg(
            F.count("*").alias("n_rows"),
            *[F.avg(f"x{i}").alias(f"s{i}") for i in range(d + 1)],
            *[(F.var_pop(f"x{i}") if i == j else F.covar_pop(f"x{i}", f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs],
            F.array(*[F.max(f"x{i}") > F.min(f"x{i}") for i in range(d)]).alias("varies"),
        )

    long = stage(
        rows.groupBy("user_id").agg(F.count("*").alias("n")).where(F.col("n") > whole_rows).select("user_id"), "long-listeners"
    )
    if long.isEmpty():
        moments = summed(complete.repartition("user_id"))
    else:
        short = complete.join(long, "user_id", "left_anti")
        moments = summed(short.repartition("user_id")).union(summed(complete.join(long, "user_id", "left_semi")))
    return moments.select(
        "user_id", "n_rows", "varies", F.col(f"s{d}").alias("label_mean"),
        F.array(*[F.col(f"s{i}") for i in range(d)]).alias("means"),
        F.array(*[F.col(f"p{min(i, j)}_{max(i, j)}") for i in range(d) for j in range(d)]).alias("covariance"),
        F.array(*[F.col(f"p{i}_{d}") for i in range(d)]).alias("label_covariance"), F.col(f"p{d}_{d}").alias("label_variance"),
    )


def _model_schema(moments: DataFrame) -> T.StructType:
    return T.StructType([
        moments.schema["user_id"],
        T.StructField("n_rows", T.LongType()),
        T.StructField("weights", T.ArrayType(T.DoubleType())),
        T.StructField("intercept", T.DoubleType()),
    ])


def _stacks(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    means = np.vstack(batch["means"].to_numpy())
    covariance = np.vstack(batch["covariance"].to_numpy()).reshape(len(batch), means.shape[1], -1)
    # what a constant feature leaves in its covariances is rounding only
    varies = np.vstack(batch["varies"].to_numpy()).astype(bool)
    covariance = covariance * varies[:, :, None] * varies[:, None, :]
    target = np.vstack(batch["label_covariance"].to_numpy()) * varies
    return means, covariance, target, batch["label_mean"].to_numpy()


def _scaled(covariance: np.ndarray, target: np.ndarray):
    """Correlations of the varying features; constant ones get scale 0."""
    variance = np.diagonal(covariance, axis1=1, axis2=2)
    inverse = np.where(variance > 0, 1.0 / np.sqrt(np.where(variance > 0, variance, 1.0)), 0.0)
    return covariance * inverse[:, :, None] * inverse[:, None, :], target * inverse, inverse


def _models(batch: pd.DataFrame, weights: np.ndarray, intercept: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({
        "user_id": batch["user_id"], "n_rows": batch["n_rows"],
        "weights": list(weights), "intercept": intercept,
    })


def fit_ols(rows: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Least squares with intercept: ``(user_id, n_rows, weights, intercept)``.

    Features are scaled by their deviation to find which combinations the rows
    determine. Where they leave a choice, the weights of least norm are taken.
    """
    moments = user_moments(rows, features, label)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            means, covariance, target, label_mean = _stacks(batch)
            correlation, scaled_target, inverse = _scaled(covariance, target)
            values, vectors = np.linalg.eigh(correlation)
            free = values <= RANK_TOLERANCE * np.maximum(values[:, -1:], 1e-300)
            gain = np.where(free, 0.0, 1.0 / np.where(free, 1.0, values))
            along = np.einsum("bji,bj->bi", vectors, scaled_target) * gain
            weights = np.einsum("bij,bj->bi", vectors, along) * inverse
            # take out what lies along undetermined directions of the unscaled features
            open_ways = vectors * inverse[:, :, None] * free[:, None, :]
            spare = np.einsum("bij,bj->bi", np.linalg.pinv(open_ways, rcond=RANK_TOLERANCE), weights)
            weights = weights - np.einsum("bij,bj->bi", open_ways, spare)
            yield _models(batch, weights, label_mean - np.einsum("bi,bi->b", weights, means))

    return moments.mapInPandas(solve, _model_schema(moments))


def fit_gradient_descent(
    rows: DataFrame, features: Sequence[str], label: str = "label", iterations: int = 10,
    step: float = 1.0, tolerance: float = 0.001, standardize: bool = True,
) -> DataFrame:
    """Full-batch gradient descent on the squared error, for all listeners at once.

    Weights start at 0 and no intercept is fitted; round ``t`` moves by
    ``step / sqrt(t)`` times the mean gradient. A listener stops once the weights
    move by less than ``tolerance`` relative to their size. With ``standardize``
    descent is on standardised features and the model is given in terms of the
    original ones. The mean gradient is ``second moments · w − label moments``,
    so the rows are read once, whatever the number of rounds.
    """
    moments = user_moments(rows, features, label)

    def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            means, covariance, target, label_mean = _stacks(batch)
            if standardize:
                second, first, scale = _scaled(covariance, target)
            else:
                second = covariance + means[:, :, None] * means[:, None, :]
                first = target + means * label_mean[:, None]
                scale = np.ones_like(means)
            weights = np.zeros_like(means)
            active = np.ones(len(batch), dtype=bool)
            for t in range(1, iterations + 1):
                gradient = np.einsum("bij,bj->bi", second, weights) - first
                moved = np.where(active[:, None], weights - step / np.sqrt(t) * gradient, weights)
                change = np.linalg.norm(moved - weights, axis=1)
                if t > 1:
                    active &= change >= tolerance * np.maximum(np.linalg.norm(moved, axis=1), 1.0)
                weights = moved
            weights = weights * scale
            shift = np.einsum("bi,bi->b", weights, means) if standardize else np.zeros(len(batch))
            yield _models(batch, weights, -shift)

    return moments.mapInPandas(descend, _model_schema(moments))


def fit_user_elastic_net(
    rows: DataFrame, features: Sequence[str], label: str = "label", max_iter: int = 100,
    reg_param: float = 0.3, elastic_net_param: float = 0.8, tolerance: float = 1e-10,
) -> DataFrame:
    """Elastic-net regression of every listener: ``(user_id, n_rows, weights, intercept)``.

    The objective of ``fit_elastic_net`` for each listener's own rows: half the
    mean squared error plus ``reg_param`` times the mixed penalty, where features
    and label are scaled by their deviation. Coordinate descent with soft thresholds runs on the moments of many
    listeners at once, so the rows are read once; it ends when no weight moves
    by more than ``tolerance`` or after ``max_iter`` rounds. A listener whose
    label does not vary, such as one with a single row, gets the mean alone.
    """
    moments = user_moments(rows, features, label)

    def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            means, covariance, target, label_mean = _stacks(batch)
            correlation, scaled_target, inverse = _scaled(covariance, target)
            deviation = np.sqrt(np.maximum(batch["label_variance"].to_numpy(), 0.0))
            moves = deviation > 0
            deviation = np.where(moves, deviation, 1.0)
            second, first = correlation, scaled_target / deviation[:, None]
            bend = np.where(moves, reg_param * elastic_net_param / deviation, np.inf)
            shrink = reg_param * (1 - elastic_net_param) / deviation
            own = np.diagonal(second, axis1=1, axis2=2) + shrink[:, None]
            weights = np.zeros_like(means)
            for _ in range(max_iter):
                moved = 0.0
                for j in range(means.shape[1]):
                    rest = first[:, j] - np.einsum("bi,bi->b", second[:, j], weights) + second[:, j, j] * weights[:, j]
                    cut = np.sign(rest) * np.maximum(np.abs(rest) - bend, 0.0)
                    new = np.where(inverse[:, j] > 0, cut / np.where(own[:, j] > 0, own[:, j], 1.0), 0.0)
                    moved = max(moved, float(np.abs(new - weights[:, j]).max()))
                    weights[:, j] = new
                if moved <= tolerance:
                    break
            weights = weights * deviation[:, None] * inverse
            yield _models(batch, weights, label_mean - np.einsum("bi,bi->b", weights, means))

    return moments.mapInPandas(descend, _model_schema(moments))


def fit_elastic_net(
    rows: DataFrame, features: Sequence[str], label: str = "label", max_iter: int = 10,
    reg_param: float = 0.3, elastic_net_param: float = 0.8,
) -> DataFrame:
    """Elastic-net regression over all given rows: ``(feature, coefficient)`` with the intercept."""
    spark = rows.sparkSession
    assembled = VectorAssembler(inputCols=list(features), outputCol="_vector").transform(
        rows.dropna(subset=[label, *features]).select(label, *features)
    )
    model = LinearRegression(
        featuresCol="_vector", labelCol=label, maxIter=max_iter, regParam=reg_param,
        elasticNetParam=elastic_net_param,
    ).fit(assembled.select("_vector", label))
    entries = [*zip(features, map(float, model.coefficients)), ("(intercept)", float(model.intercept))]
    return spark.createDataFrame(entries, "feature STRING, coefficient DOUBLE")


def predict_linear(models: DataFrame, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add ``prediction`` to the rows of listeners that have a model."""
    joined = rows.join(models.select("user_id", "weights", "intercept"), "user_id")
    value = dot(F.col("weights"), [F.col(c) for c in features]) + F.col("intercept")
    return joined.select(*rows.columns, value.alias("prediction"))


def mse(df: DataFrame, by: str | None = None, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mean squared error and its root, over all rows or per ``by``."""
    grouped = df.groupBy(by) if by else df.groupBy()
    error = F.avg(F.pow(F.col(label) - F.col(prediction), F.lit(2.0)))
    return grouped.agg(F.count("*").alias("n"), error.alias("mse"), F.sqrt(error).alias("rmse"))
