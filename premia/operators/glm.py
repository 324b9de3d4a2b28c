"""Ridge GLMs with log link, fitted by ``irls``; the summary with errors is Spark ML's GeneralizedLinearRegression.

The penalty ``alpha`` means: minimise sum(w * deviance / 2) / sum(w) + alpha / 2 * |beta|^2.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.spline import number
from premia.operators.design import DesignSpec, encode, log_contributions, terms

POWERS = {"poisson": 1.0, "gamma": 2.0}


class NotConverged(RuntimeError):
    pass


@dataclass(frozen=True)
class FittedGlm:
    family: str
    power: float
    alpha: float
    intercept: float
    coefficients: list[float]
    design: DesignSpec

    def log_rate(self) -> Column:
        parts = log_contributions(self.design, self.coefficients).values()
        return F.expr(" + ".join([number(self.intercept), *parts]))

    def prediction(self) -> Column:
        return F.exp(self.log_rate())

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "FittedGlm":
        raw = json.loads(text)
        return FittedGlm(**{**raw, "design": DesignSpec(**raw["design"])})


def fit_glm(cells: DataFrame, design: DesignSpec, family: str, alpha: float, power: float | None = None, max_iter: int = 1000) -> FittedGlm:
    """``cells`` carry the design's source columns, ``y`` and ``w``. A grid of one point: Newton steps over the stored
    codes of the cells, so neither encoded vectors nor a second fit per change of the penalty are needed."""
    from premia.operators.irls import Point, fit_many, stack

    return fit_many(stack({0: (cells, design)}), {0: design}, [Point(0, family, alpha, power)], max_iter)[0]


def independent_terms(encoded: DataFrame, tolerance: float = 1e-8) -> list[int]:
    """Positions of a largest set of columns that are linearly independent of each other and of the intercept.

    The correlation matrix is one distributed pass; columns are then taken in order while the part not explained by
    the earlier ones is above the tolerance.
    """
    matrix = Correlation.corr(encoded, "features").first()[0].toArray()
    left = np.nan_to_num(matrix.copy())
    chosen = []
    for j in range(len(left)):
        varies = len(left) == 1 or not np.isnan(np.delete(matrix[j], j)).all()
        if varies and left[j, j] > tolerance:
            chosen.append(j)
            left = left - np.outer(left[:, j], left[j]) / left[j, j]
    return chosen


def offset_summary(rows: DataFrame, design: DesignSpec, max_iter: int = 1000) -> DataFrame:
    """Unregularised Poisson on counts with ln(exposure) as offset: (param, coef, std_err, p_value).

    Terms that depend linearly on earlier ones (each spline block sums to one like the intercept) are left out of the
    fit and reported with coefficient zero and no error.
    """
    source = rows.withColumns(
        {"label": F.col("claim_nb").cast("double"), "w": F.lit(1.0), "log_exposure": F.log("exposure")}
    )
    kept = independent_terms(encode(source, design, []))
    encoded = encode(source, design, ["label", "w", "log_exposure"], kept).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        estimator = GeneralizedLinearRegression(
            family="poisson", link="log", labelCol="label", weightCol="w", offsetCol="log_exposure", maxIter=max_iter, tol=1e-9
        )
        model = estimator.fit(encoded)
        errors, p_values = model.summary.coefficientStandardErrors, model.summary.pValues
        names = [t.name for t in terms(design)]
        table = {name: (name, 0.0, None, None) for name in names}
        for i, j in enumerate(kept):
            table[names[j]] = (names[j], float(model.coefficients[i]), errors[i], p_values[i])
        table["const"] = ("const", float(model.intercept), errors[-1], p_values[-1])
    finally:
        encoded.unpersist()
    schema = "param string, coef double, std_err double, p_value double"
    return rows.sparkSession.createDataFrame(list(table.values()), schema)


def combine_freq_sev(frequency: Column, severity: Column) -> Column:
    return frequency * severity
