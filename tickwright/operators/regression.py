"""Linear regression of the next close: fit, score, measure, store."""

from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwright.functions.predictions import LEGACY_PREDICTION
from tickwright.operators.training import chrono_split
from tickwright.schemas import FEATURES, MODEL, TARGET

RANK_TOLERANCE = 1e-12
STEADY_TOLERANCE = 1e-11


@dataclass(frozen=True)
class LinearModel:
    """A linear function of named columns; scoring it is an ordinary expression."""

    features: list[str]
    coefficients: list[float]
    intercept: float
    target: str = TARGET

    def expression(self) -> Column:
        terms = [F.col(f) * F.lit(w) for f, w in zip(self.features, self.coefficients)]
        return reduce(lambda total, term: total + term, terms, F.lit(self.intercept))


def least_squares(products: np.ndarray, cross: np.ndarray) -> np.ndarray:
    """Coefficients of least norm among those that solve the normal equations.

    Works on correlations, so that features of any scale keep their rank, and then takes
    out what lies in the null space of the unscaled features.
    """
    weights = np.zeros(len(cross))
    varying = np.flatnonzero(np.diag(products) > 0)
    if not len(varying):
        return weights
    scale = np.sqrt(np.diag(products)[varying])
    values, vectors = np.linalg.eigh(products[np.ix_(varying, varying)] / np.outer(scale, scale))
    full = values > RANK_TOLERANCE * values[-1]
    basis = vectors[:, full]
    solution = basis @ ((basis.T @ (cross[varying] / scale)) / values[full]) / scale
    if not full.all():
        null, _ = np.linalg.qr(vectors[:, ~full] / scale[:, None])
        solution -= null @ (null.T @ solution)
    weights[varying] = solution
    return weights


def moments(
    rows: DataFrame, features: list[str] = FEATURES, target: str = TARGET, by: tuple[str, ...] = ()
) -> DataFrame:
    """What a fit needs of the rows, in one pass: number, means, and products of deviations from them.

    One row, or one per group ``by``, such as the batch that rows were stored with. Products are of every
    pair of features and target, each with itself and those after it. They merge (``merged``), so a
    fit over many stored batches reads a row for each instead of their rows.
    """
    names = [*features, target]
    n = F.count(F.lit(1)).cast("double")
    pairs = combinations_with_replacement(names, 2)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in names]).alias("means"),
        F.array(*[F.covar_pop(a, b) * n for a, b in pairs]).alias("products"),
    )


def merged(table: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, means and products of all groups of ``moments`` together.

    The groups' means deviate from the mean of all, which adds to the products: two passes over
    rows as wide as a model, whose sums are all that the driver gets.
    """
    table = table.where(F.col("n") > 0)
    size = table.select(F.size("means").alias("k")).first()
    if size is None:
        raise ValueError("no rows to fit")
    k = size["k"]
    n = F.col("n")
    total = table.agg(F.sum(n).alias("n"), *[F.sum(n * F.col("means")[i]).alias(f"m{i}") for i in range(k)]).first()
    means = np.array([total[f"m{i}"] for i in range(k)]) / total["n"]
    apart = [F.col("means")[i] - F.lit(float(means[i])) for i in range(k)]
    pairs = list(combinations_with_replacement(range(k), 2))
    sums = table.agg(
        *[F.sum(F.col("products")[at] + n * apart[i] * apart[j]).alias(f"s{at}") for at, (i, j) in enumerate(pairs)]
    ).first()
    products = np.zeros((k, k))
    for at, (i, j) in enumerate(pairs):
        products[i, j] = products[j, i] = sums[f"s{at}"]
    return total["n"], means, products


def solve(
    n: int, means: np.ndarray, products: np.ndarray, features: list[str] = FEATURES, target: str = TARGET
) -> LinearModel:
    """The model of least squares with these moments."""
    if not np.isfinite(products).all():
        raise ValueError("features or target hold infinite values")
    # what varies no more than rounding makes it vary is a constant, and gets no weight
    steady = np.diag(products) <= n * (STEADY_TOLERANCE * means) ** 2
    products = np.where(steady[:, None] | steady, 0.0, products)
    weights = least_squares(products[:-1, :-1], products[:-1, -1])
    return LinearModel(
        list(features), weights.tolist(), float(means[-1] - weights @ means[:-1]), target
    )


def fit(train: DataFrame, features: list[str] = FEATURES, target: str = TARGET) -> LinearModel:
    """Ordinary least squares with intercept, from one pass over the rows.

    What reaches the driver is a matrix of the features' size. The usual features are collinear (the
    spread is high minus low), which leaves many best coefficients: the ones of least norm
    are taken.
    """
    found = moments(train, features, target).first()
    if not found["n"]:
        raise ValueError("no rows to fit")
    k = len(found["means"])
    products = np.zeros((k, k))
    for value, (i, j) in zip(found["products"], combinations_with_replacement(range(k), 2)):
        products[i, j] = products[j, i] = value
    return solve(found["n"], np.array(found["means"]), products, features, target)


def refit(table: DataFrame, features: list[str] = FEATURES, target: str = TARGET) -> LinearModel:
    """The model of all rows whose ``moments`` are in the table, without reading the rows again."""
    return solve(*merged(table), features, target)


def predict(model: LinearModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """``df`` plus the model's prediction; a plain projection, also on streams."""
    return df.withColumn(out, model.expression())


def metrics(scored: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """One row: mae, rmse and the number of scored rows."""
    miss = F.col(label) - F.col(prediction)
    return scored.agg(
        F.avg(F.abs(miss)).alias("mae"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.count(F.lit(1)).alias("n_test"),
    )


def single_feature(df: DataFrame, feature: str = "close", label: str = TARGET) -> DataFrame:
    """One row: slope, intercept and size of the least-squares line label ~ feature."""
    return df.agg(
        F.regr_slope(label, feature).alias("slope"),
        F.regr_intercept(label, feature).alias("intercept"),
        F.regr_count(label, feature).alias("n"),
    )


def train(rows: DataFrame, tie: str) -> tuple[LinearModel, dict]:
    """Fit on the chronological head of ``rows``, measure on the tail."""
    head, tail = chrono_split(rows, tie)
    model = fit(head)
    measured = metrics(predict(model, tail)).first().asDict()
    return model, {**measured, "n_train": rows.count() - measured["n_test"]}


def save(spark: SparkSession, model: LinearModel, measured: dict, path: str) -> None:
    """Store model and metrics as a table of one row."""
    values = {**vars(model), **measured}
    row = tuple(values.get(name) for name in MODEL.fieldNames())
    spark.createDataFrame([row], MODEL).coalesce(1).write.mode("overwrite").json(path)


def load(spark: SparkSession, path: str) -> tuple[LinearModel, dict]:
    """The stored model and its metrics; raises if there is none."""
    row = spark.read.schema(MODEL).json(path).first()
    if row is None:
        raise FileNotFoundError(f"no model at {path}")
    target = row["target"] or LEGACY_PREDICTION  # old models do not name theirs
    model = LinearModel(row["features"], row["coefficients"], row["intercept"], target)
    return model, {name: row[name] for name in ("mae", "rmse", "n_train", "n_test")}
