"""Ridge regression from one Gram matrix a month.

Every month's rows are summed once to the products of (values, missing marks, 1, target).
The matrix of any training window is the sum of its months, and median imputation is a
linear map on it, so that all folds are solved from the same table: only matrices of
twice the number of features reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.errors import ContractError
from panelkit.operators.boosting import PARTIAL, _summed

MEDIAN_ACCURACY = 10_000


@dataclass(frozen=True)
class RidgeModel:
    """Intercept, and per feature a coefficient and the value that stands for a missing one."""

    columns: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    medians: tuple[float, ...]

    def value(self) -> Column:
        made = F.lit(self.intercept)
        for c, b, m in zip(self.columns, self.coefficients, self.medians):
            if b:
                made = made + F.lit(b) * F.coalesce(F.col(c).cast("double"), F.lit(m))
        return made

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.value())

    def save(self, path: str) -> None:
        rows = [(-1, "", self.intercept, 0.0)]
        rows += [(i, *r) for i, r in enumerate(zip(self.columns, self.coefficients, self.medians))]
        schema = "slot int, feature string, coefficient double, median double"
        SparkSession.active().createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/ridge")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "RidgeModel":
        first, *rest = spark.read.parquet(f"{path}/ridge").orderBy("slot").collect()  # one row a feature
        return RidgeModel(*(tuple(r[k] for r in rest) if k else first["coefficient"] for k in ("feature", None, "coefficient", "median")))


def medians_of(rows: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> list:
    """Medians of every column: one row, or one per value of ``by``."""
    made = [F.percentile_approx(F.col(c).cast("double"), 0.5, MEDIAN_ACCURACY).alias(c) for c in columns]
    return rows.groupBy(*by).agg(*made).collect()


def monthly_grams(rows: DataFrame, columns: Sequence[str], centres: Mapping[str, float]) -> DataFrame:
    """(month, gram): products of (values, missing marks, 1, target) summed over the rows.

    Values are taken from ``centres``, which keeps the sums of large numbers exact.
    """
    middle = np.array([centres[c] for c in columns])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        sums: dict = {}
        for batch in batches:
            x = batch[[f"_x{i}" for i in range(len(columns))]].to_numpy(dtype=float, na_value=np.nan) - middle
            missing = np.isnan(x)
            z = np.column_stack([np.where(missing, 0.0, x), missing, np.ones(len(x)), batch["target"].to_numpy(dtype=float)])
            for month, own in batch.groupby("month").indices.items():
                made = z[own].T @ z[own]
                sums[month] = sums[month] + made if month in sums else made
        if sums:
            part = TaskContext.get().partitionId() % parts
            yield pd.DataFrame({"month": list(sums), "part": part, "hist": [g.tobytes() for g in sums.values()]})

    def packed(key, total):
        return {"month": key[0], "gram": total.tobytes()}

    parts = PARTIAL  # at most so many sums of a month in the second step
    typed = rows.select("month", "target", *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
    partial = typed.where("target IS NOT NULL").mapInPandas(run, "month date, part int, hist binary")
    step = _summed(partial, ["month", "part"], lambda k, t: {"month": k[0], "hist": t.tobytes()}, "month date, hist binary")
    return _summed(step, ["month"], packed, "month date, gram binary")


def solve(gram: np.ndarray, columns: Sequence[str], centres: Sequence[float], medians: Sequence[float | None], alpha: float) -> RidgeModel:
    """Closed form on standardised, median-imputed features; the intercept is free."""
    p = len(columns)
    centres = np.array(centres, dtype=float)
    used = np.array([m is not None for m in medians])
    filled = np.where(used, [0.0 if m is None else m for m in medians], centres)
    imputed = np.zeros((2 * p + 2, p + 2))
    imputed[np.arange(p), np.arange(p)] = 1.0
    imputed[p + np.arange(p), np.arange(p)] = filled - centres
    imputed[2 * p, p] = imputed[2 * p + 1, p + 1] = 1.0
    g = imputed.T @ gram @ imputed
    n = g[p, p]
    if n == 0:
        raise ContractError("no training rows in the window")
    means = g[p] / n
    cov = g / n - np.outer(means, means)
    spread = np.sqrt(np.clip(np.diag(cov)[:p], 0.0, None))
    steady = used & (spread > 1e-12 * (np.abs(means[:p]) + np.abs(centres) + 1e-300))
    scale = np.where(steady, spread, 1.0)
    corr = np.where(np.outer(steady, steady), cov[:p, :p] / np.outer(scale, scale), 0.0)
    side = np.where(steady, cov[:p, p + 1] / scale, 0.0)
    beta = np.linalg.solve(n * corr + alpha * np.eye(p), n * side) / scale
    beta = np.where(steady, beta, 0.0)
    intercept = means[p + 1] - float(beta @ (means[:p] + centres))
    return RidgeModel(tuple(columns), float(intercept), tuple(map(float, beta)), tuple(map(float, filled)))


def fit_ridge(rows: DataFrame, columns: Sequence[str], alpha: float) -> RidgeModel:
    """One model of all rows with a target."""
    own = rows.where("target IS NOT NULL")
    medians = medians_of(own, columns)[0].asDict()
    centres = {c: medians[c] or 0.0 for c in columns}
    grams = monthly_grams(own, columns, centres).collect()  # one row a month
    if not grams:
        raise ContractError("no training row has a target")
    return solve(_sum(grams, len(columns)), columns, [centres[c] for c in columns], [medians[c] for c in columns], alpha)


def fit_folds(rows: DataFrame, assigned: DataFrame, columns: Sequence[str], folds: Sequence, alpha: float) -> dict[int, RidgeModel]:
    """A model per fold from the same monthly table; ``assigned`` has fold and role."""
    first = min(f.train_start for f in folds)
    last = max(f.train_end for f in folds)
    own = rows.where(F.col("month").between(F.lit(first), F.lit(last)) & F.col("target").isNotNull())
    medians = {r["fold"]: r for r in medians_of(assigned.where("role = 'train' AND target IS NOT NULL"), columns, ["fold"])}
    some = next(iter(medians.values()), None)
    if some is None or len(medians) < len(folds):
        raise ContractError("a fold has no training rows")
    centres = {c: some[c] if some[c] is not None else 0.0 for c in columns}
    grams = monthly_grams(own, columns, centres).collect()  # one row a month
    out = {}
    for fold in folds:
        inside = [r for r in grams if fold.train_start <= r["month"] <= fold.train_end]
        row = medians[fold.fold]
        out[fold.fold] = solve(_sum(inside, len(columns)), columns, [centres[c] for c in columns], [row[c] for c in columns], alpha)
    return out


def _sum(grams: Sequence, features: int) -> np.ndarray:
    size = 2 * features + 2
    return sum(np.frombuffer(r["gram"], dtype=float).reshape(size, size) for r in grams)
