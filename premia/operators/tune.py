"""Grouped cross-validation of the GLMs."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.functions.deviance import mean_deviance
from premia.operators.design import GLM_SOURCES, DesignSpec, design_cells, fit_design
from premia.operators.features import kfold_assign
from premia.operators.glm import FittedGlm, fit_glm
from premia.operators.irls import Point, fit_many, stack
from premia.settings import Settings
from premia.workspace import stored

CV_TABLE = "family string, alpha double, power double, fold int, deviance double"


def model_sources(settings: Settings) -> list[str]:
    extra = ["veh_power"] if settings.features.interactions else []
    return [*GLM_SOURCES, *extra]


def cross_validate(train: DataFrame, family: str, grid: list[tuple[float, float | None]], settings: Settings) -> DataFrame:
    """(family, alpha, power, fold, deviance) for every (alpha, power) of ``grid`` and every fold.

    Rows are collapsed to design cells per fold once. For each fold the encoder is learned on the other folds; all fits
    of all folds then advance together, one pass over the encoded cells per step. The validation deviances of a fold's
    models come from a single pass over the fold.
    """
    return validate_folds(train, family, grid, settings, lambda inside: fit_design(inside, settings.features, rows="n_rows"), model_sources(settings))


def validate_folds(
    train: DataFrame, family: str, grid: list[tuple[float, float | None]], settings: Settings, learn: Callable[[DataFrame], DesignSpec], sources: list[str]
) -> DataFrame:
    """``cross_validate`` with an encoder of the caller's choice: ``learn`` gets the cells of the other folds. The columns
    that it needs are written once by fold, so that each fold's deviances read that fold alone."""
    m = settings.modelling
    rows = kfold_assign(train, m.folds).select("fold", *sources, "y", "sample_weight")
    rows = stored(rows, "cv-rows", "fold")
    cells = stored(design_cells(rows, sources, ["fold"]), "cv-cells")
    inside = {fold: cells.where(F.col("fold") != fold) for fold in range(m.folds)}
    with ThreadPoolExecutor(m.parallel_fits) as pool:
        designs = dict(zip(inside, pool.map(inheritable_thread_target(train.sparkSession)(learn), inside.values()), strict=True))
    tasks = [Point(fold, family, alpha, power) for fold in inside for alpha, power in grid]
    encoded = stack({fold: (part, designs[fold]) for fold, part in inside.items()})
    fitted = fit_many(encoded, designs, tasks, m.max_iter)

    weight = F.col("sample_weight").cast("double")

    def score(fold: int) -> list[tuple]:
        models = [model for point, model in zip(tasks, fitted, strict=True) if point.part == fold]
        held = rows.where(F.col("fold") == fold)
        held = held.withColumns({f"_p{i}": model.prediction() for i, model in enumerate(models)})
        parts = [mean_deviance(family, F.col("y"), F.col(f"_p{i}"), weight, model.power).alias(f"d{i}") for i, model in enumerate(models)]
        scores = held.agg(*parts).first()
        return [(family, model.alpha, model.power, fold, scores[i]) for i, model in enumerate(models)]

    with ThreadPoolExecutor(m.parallel_fits) as pool:
        out = [row for part in pool.map(inheritable_thread_target(train.sparkSession)(score), inside) for row in part]
    return train.sparkSession.createDataFrame(out, CV_TABLE)


def select_best(table: DataFrame) -> tuple[float, float, float]:
    """(alpha, power, mean deviance) with the lowest unweighted mean over folds; the first grid point wins ties."""
    means = table.groupBy("alpha", "power").agg(F.avg("deviance").alias("deviance"))
    best = means.orderBy("deviance", "alpha", "power").first()
    return best["alpha"], best["power"], best["deviance"]


def grid_of(family: str, settings: Settings) -> list[tuple[float, float | None]]:
    m = settings.modelling
    if family == "poisson":
        return [(a, None) for a in m.poisson_alphas]
    if family == "gamma":
        return [(a, None) for a in m.gamma_alphas]
    return [(m.tweedie_alpha, p) for p in m.tweedie_powers]


def train_glm(train: DataFrame, family: str, alpha: float, power: float | None, settings: Settings) -> FittedGlm:
    cells = stored(design_cells(train, model_sources(settings)), "glm-cells")
    design = fit_design(cells, settings.features, rows="n_rows")
    return fit_glm(cells, design, family, alpha, power, settings.modelling.max_iter)
