"""Elastic-net line fitting.

With one feature the fit is a closed form over moments: one aggregate, one read
of the table, and scoring is column arithmetic. With several features all products
of two columns are one aggregate too, and the fit is found on that small matrix
alone. The library's solver, which reads the table twice, remains for its model
and for very many features.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import line_value

LINE = "slope double, intercept double"
# An aggregate for each two of the features and the label.
MOST_FEATURES = 30


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(df)


def fit_line(
    df: DataFrame,
    features: list[str],
    label: str,
    reg: float = 0.3,
    mix: float = 0.8,
    max_iter: int = 10,
) -> LinearRegressionModel:
    """Fit ``label`` on ``features``; rows with a null in either are left out.

    The model knows its own predictions for the training rows. ``fit_one`` is
    the cheaper way to the same line for one feature, ``fit_plane`` for several.
    """
    rows = df.select(*features, F.col(label).cast("double").alias("label")).na.drop("any")
    regression = LinearRegression(
        featuresCol="features",
        labelCol="label",
        maxIter=max_iter,
        regParam=reg,
        elasticNetParam=mix,
    )
    return regression.fit(assemble(rows, features))


def line_parameters(df: DataFrame, model: LinearRegressionModel) -> DataFrame:
    """One row: slope of the first feature, and intercept."""
    row = (float(model.coefficients[0]), float(model.intercept))
    return df.sparkSession.createDataFrame([row], LINE)


def fit_by_moments(
    df: DataFrame, feature: str, label: str, reg: float = 0.3, mix: float = 0.8
) -> tuple[float, float]:
    """Slope and intercept of the same fit with one feature, from one aggregate.

    With one feature the elastic net has a closed form: in units of the
    population deviations the slope is the correlation, pulled towards zero by
    the first penalty and shrunk by the second. No vectors are built and one
    row reaches the driver.
    """
    moments = (
        df.select(F.col(feature).cast("double").alias("x"), F.col(label).cast("double").alias("y"))
        .na.drop("any")
        .agg(
            F.covar_pop("x", "y").alias("cov"),
            F.stddev_pop("x").alias("sx"),
            F.stddev_pop("y").alias("sy"),
            F.avg("x").alias("mx"),
            F.avg("y").alias("my"),
        )
        .first()
    )
    if moments["mx"] is None:
        raise ValueError("no complete row to fit")
    if not moments["sx"] or not moments["sy"]:
        return 0.0, moments["my"]
    r = moments["cov"] / (moments["sx"] * moments["sy"])
    pulled = max(abs(r) - reg * mix / moments["sy"], 0.0)
    shrunk = math.copysign(pulled, r) / (1 + reg * (1 - mix) / moments["sy"])
    slope = shrunk * moments["sy"] / moments["sx"]
    return slope, moments["my"] - slope * moments["mx"]


def fit_one(
    df: DataFrame, feature: str, label: str, reg: float = 0.3, mix: float = 0.8
) -> DataFrame:
    """One row: slope and intercept of the fit with one feature."""
    line = fit_by_moments(df, feature, label, reg, mix)
    return df.sparkSession.createDataFrame([line], LINE)


def score(df: DataFrame, features: list[str], model: LinearRegressionModel) -> DataFrame:
    """Predictions for any table that has the feature columns."""
    return model.transform(assemble(df, features)).drop("features")


def score_line(
    df: DataFrame, feature: str, slope: float, intercept: float, name: str = "prediction"
) -> DataFrame:
    """The same for one feature as column arithmetic, with no vector built."""
    return df.withColumn(name, line_value(slope, F.col(feature), intercept))


@dataclass(frozen=True)
class Plane:
    """A fit with several features."""

    features: tuple[str, ...]
    slopes: tuple[float, ...]
    intercept: float
    rows: int


@dataclass(frozen=True)
class Moments:
    """Count, means and covariances of complete rows, the label last."""

    rows: int
    means: np.ndarray
    covariances: np.ndarray


def moments(df: DataFrame, columns: list[str]) -> Moments:
    """One aggregate over one read; a single row reaches the driver.

    Rows in which a column is null or no number are left out.
    """
    count = len(columns)
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    axes = [F.col(c).cast("double").alias(f"axis_{i}") for i, c in enumerate(columns)]
    found = df.select(*axes).na.drop("any").agg(
        F.count("*").alias("rows"),
        *[F.avg(f"axis_{i}").alias(f"mean_{i}") for i in range(count)],
        *[F.covar_pop(f"axis_{i}", f"axis_{j}").alias(f"cov_{i}_{j}") for i, j in pairs],
    ).first()
    if not found["rows"]:
        raise ValueError("no complete row to fit")
    covariances = np.empty((count, count))
    for i, j in pairs:
        covariances[i, j] = covariances[j, i] = found[f"cov_{i}_{j}"]
    return Moments(found["rows"], np.array([found[f"mean_{i}"] for i in range(count)]), covariances)


def descend(gram: np.ndarray, target: np.ndarray, first: float, second: float, tol: float, rounds: int) -> np.ndarray:
    """The minimum of b'Gb/2 - t'b + first * |b| + second * b'b/2, coordinate by coordinate.

    Each step sets one coordinate to its best value with the others as they are:
    what is left of its pull, moved towards zero by the first penalty and divided
    by its curvature and the second.
    """
    slopes = np.zeros(len(target))
    for _ in range(rounds):
        before = slopes.copy()
        for i in range(len(target)):
            if gram[i, i] <= 0:
                continue
            pull = target[i] - gram[i] @ slopes + gram[i, i] * slopes[i]
            slopes[i] = math.copysign(max(abs(pull) - first, 0.0), pull) / (gram[i, i] + second)
        if np.abs(slopes - before).max(initial=0.0) <= tol:
            return slopes
    raise RuntimeError(f"no fit after {rounds} rounds; the features depend on each other")


def fit_plane(
    df: DataFrame,
    features: list[str],
    label: str,
    reg: float = 0.3,
    mix: float = 0.8,
    tol: float = 1e-12,
    rounds: int = 100_000,
) -> Plane:
    """The elastic-net fit of ``label`` on several features, from one aggregate.

    Penalties apply to the slopes in units of the deviations, as the library's do.
    A constant feature has slope zero; a constant label gives its mean.
    """
    if not 1 <= len(features) <= MOST_FEATURES:
        raise ValueError(f"1 to {MOST_FEATURES} features; fit_line takes more")
    known = moments(df, [*features, label])
    deviations = np.sqrt(np.maximum(np.diag(known.covariances), 0.0))
    units, sy = deviations[:-1], deviations[-1]
    mean = float(known.means[-1])
    if not sy:
        return Plane(tuple(features), (0.0,) * len(features), mean, known.rows)
    live = units > 0
    scale = np.where(live, units, 1.0)
    gram = np.where(np.outer(live, live), known.covariances[:-1, :-1] / np.outer(scale, scale), 0.0)
    target = np.where(live, known.covariances[:-1, -1] / (scale * sy), 0.0)
    shares = descend(gram, target, reg * mix / sy, reg * (1 - mix) / sy, tol, rounds)
    slopes = shares * sy / scale
    intercept = mean - float(slopes @ known.means[:-1])
    return Plane(tuple(features), tuple(map(float, slopes)), intercept, known.rows)


def score_plane(df: DataFrame, plane: Plane, name: str = "prediction") -> DataFrame:
    """Predictions as column arithmetic for any table that has the features."""
    total = F.lit(plane.intercept)
    for feature, slope in zip(plane.features, plane.slopes):
        total = total + F.lit(slope) * F.col(feature)
    return df.withColumn(name, total)
