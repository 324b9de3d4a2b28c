"""Seeded random search over boosting parameters.

All trials read one binned table and run side by side as concurrent jobs. A trial is claimed by creating a file, so two
drivers that search the same folder share the work; finished trees are published as they come, so a search that is
started again goes on inside of the ensemble it was fitting, and finished trials are not fitted again.
"""

from __future__ import annotations

import hashlib
import json
import math
import random
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.functions.deviance import mean_deviance
from premia.operators.boost import BoostedModel, BoostParams, boost_table, fit_boosted, score_boosted
from premia.settings import Boosting
from premia.sources import commits

TRIALS = "trial int, params string, row_share double, deviance double, ended_by_time boolean"


def trial_params(trial: int, loss: str, settings: Boosting, seed: int = 42) -> tuple[BoostParams, float]:
    """Parameters of one trial. ``row_share`` is recorded only: without a bagging frequency it has no effect."""
    rng = random.Random(seed * 100_003 + trial)

    def log_uniform(bounds):
        return math.exp(rng.uniform(math.log(bounds[0]), math.log(bounds[1])))

    params = BoostParams(
        loss=loss,
        power=settings.tweedie_power,
        leaves=rng.randint(*settings.leaves),
        min_child_rows=rng.randint(*settings.min_child_rows),
        learning_rate=log_uniform(settings.learning_rate),
        trees=rng.randint(*settings.trees),
        ridge=log_uniform(settings.ridge),
        feature_share=rng.uniform(*settings.feature_share),
        depth=settings.depth,
        bins=settings.bins,
        seed=seed,
    )
    return params, rng.uniform(*settings.row_share)


def boost_deviance(scored: DataFrame, loss: str, power: float) -> float:
    value = mean_deviance(loss, F.col("y"), F.col("yhat"), F.col("w"), power)
    return scored.agg(value.alias("d")).first()["d"]


def _key(params: BoostParams) -> str:
    """Names a trial's files: a trial of another loss, seed or range is another one."""
    return hashlib.sha256(json.dumps(asdict(params)).encode()).hexdigest()[:32]


def finished_trials(spark, path: str) -> dict[str, tuple]:
    """Rows of the finished trials below ``path`` by trial key."""
    done = f"{path}/done"
    return {n.removesuffix(".json"): tuple(json.loads(commits.read_text(spark, f"{done}/{n}"))) for n in commits.names(spark, done)}


def _claimed(spark, path: str, key: str) -> bool:
    """Whether this application may fit the trial: nobody else has claimed it."""
    mine = spark.sparkContext.applicationId
    file = f"{path}/claims/{key}.json"
    return commits.publish(spark, file, json.dumps(mine)) or json.loads(commits.read_text(spark, file)) == mine


def release_claims(spark, path: str) -> None:
    """Give up the claims below ``path``: call it when the driver that made them is gone, then search again."""
    commits.delete(spark, f"{path}/claims")


def search(train: DataFrame, val: DataFrame, loss: str, settings: Boosting, trials_path: str, seed: int = 42, **fixed) -> DataFrame:
    """Run the missing trials, ``settings.parallel_trials`` at a time; returns the table of this search's trials.

    There is no time limit unless the settings name one; trials that it keeps from starting give a row without a score
    and with ``ended_by_time``. Trials that another driver holds are left to it and are in the table once they are
    done. ``fixed`` overrides parameters, for example a depth.
    """
    spark = train.sparkSession
    started = time.monotonic()
    wanted = {}
    for trial in range(settings.trials):
        params, row_share = trial_params(trial, loss, settings, seed)
        params = replace(params, **fixed)
        wanted[_key(params)] = (trial, params, row_share)
    done = finished_trials(spark, trials_path)
    missing = [k for k in wanted if k not in done]
    tables = {bins: boost_table(train, bins) for bins in {wanted[k][1].bins for k in missing}}

    def run(key: str) -> tuple | None:
        trial, params, row_share = wanted[key]
        if settings.timeout_s is not None and time.monotonic() - started > settings.timeout_s:
            return trial, json.dumps(asdict(params)), row_share, None, True
        if not _claimed(spark, trials_path, key):
            return None
        progress = f"{trials_path}/trees/{key}"
        model = fit_boosted(None, params, table=tables[params.bins], progress=progress)
        score = boost_deviance(score_boosted(val, model, ["y", "w"]), loss, settings.tweedie_power)
        row = (trial, json.dumps(asdict(params)), row_share, score, False)
        commits.publish(spark, f"{trials_path}/done/{key}.json", json.dumps(row))
        commits.delete(spark, progress)
        return row

    with ThreadPoolExecutor(max(1, settings.parallel_trials)) as pool:
        late = [r for r in pool.map(inheritable_thread_target(spark)(run), missing) if r and r[-1]]
    rows = [tuple(r) for k, r in finished_trials(spark, trials_path).items() if k in wanted]
    return spark.createDataFrame(sorted([*rows, *late]), TRIALS)


def best_params(trials: DataFrame) -> BoostParams:
    raw = json.loads(trials.where("deviance IS NOT NULL").orderBy("deviance", "trial").first()["params"])
    return BoostParams(**{**raw, "increasing": tuple(raw["increasing"])})


def fit_best(train: DataFrame, trials: DataFrame) -> BoostedModel:
    return fit_boosted(train, best_params(trials))
