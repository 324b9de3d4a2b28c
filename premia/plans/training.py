"""Training jobs: tune, fit, evaluate, log; stability over split seeds; drift of a file."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.functions.deviance import mean_deviance
from premia.operators import boost, evaluate, search, tune
from premia.operators.design import fit_design
from premia.operators.digest import content_digest
from premia.operators.drift import psi_report
from premia.operators.features import scored
from premia.operators.glm import FittedGlm, offset_summary
from premia.operators.quality import assert_claims_only
from premia.plans import runs
from premia.plans.gold import gold_table
from premia.settings import NUMERIC_FEATURES, Settings
from premia.sources.readers import read_split, read_table
from premia.sources.sinks import write_table
from premia.workspace import stored

FAMILIES = {"frequency": "poisson", "severity": "gamma", "tweedie": "tweedie"}
#: Seeds that are fitted at a time: their jobs fill the gaps that the many short jobs of one fit leave.
PARALLEL_SEEDS = 3
GOLD_OF = {"frequency": "frequency", "severity": "severity", "tweedie": "pure_premium"}


@dataclass(frozen=True)
class TrainedModel:
    kind: str
    text: str
    params: dict
    metrics: dict[str, float]
    glm: FittedGlm | None = None
    boosted: boost.BoostedModel | None = None

    def score(self, df: DataFrame) -> DataFrame:
        """policy_id, y, yhat, w"""
        if self.glm is not None:
            return scored(df, self.glm.prediction())
        return boost.score_boosted(boost_rows(df, ["policy_id"]), self.boosted, ["policy_id", "y", "w"])


def boost_rows(df: DataFrame, keep: list[str]) -> DataFrame:
    weighted = df.withColumn("w", F.col("sample_weight").cast("double"))
    return weighted.select(*keep, "y", "w", *[c for c in df.columns if c not in {*keep, "y", "w"}])


def _deviance(model: TrainedModel, df: DataFrame, kind: str, power: float | None) -> float:
    value = mean_deviance(kind, F.col("y"), F.col("yhat"), F.col("w"), power)
    return model.score(df).agg(value.alias("d")).first()["d"]


def fit_glm_model(kind: str, train: DataFrame, val: DataFrame, settings: Settings) -> TrainedModel:
    family = FAMILIES[kind]
    if kind == "severity":
        assert_claims_only(train)
        assert_claims_only(val)
    table = tune.cross_validate(train, family, tune.grid_of(family, settings), settings)
    alpha, power, cv = tune.select_best(table)
    glm = tune.train_glm(train, family, alpha, power, settings)
    params = {"power": power} if kind == "tweedie" else {"alpha": alpha}
    model = TrainedModel(kind, glm.to_json(), params, {f"cv_{family}_deviance": cv}, glm=glm)
    val_deviance = _deviance(model, val, family, power)
    return replace(model, metrics={**model.metrics, f"val_{family}_deviance": val_deviance})


def fit_challenger(
    use_case: str, train: DataFrame, val: DataFrame, settings: Settings, trials_path: str, **fixed
) -> TrainedModel:
    loss = "poisson" if use_case == "frequency" else "tweedie"
    rows, held = boost_rows(train, []), boost_rows(val, [])
    trials = search.search(rows, held, loss, settings.boosting, trials_path, **fixed)
    fitted = search.fit_best(rows, trials)
    params = trials.orderBy("deviance", "trial").first()["params"]
    model = TrainedModel("challenger", fitted.to_json(), {"best": params}, {}, boosted=fitted)
    return replace(model, metrics={f"val_{loss}_deviance": _deviance(model, val, loss, settings.boosting.tweedie_power)})


def test_metrics(model: TrainedModel, test: DataFrame, kind: str, power: float | None) -> dict[str, float]:
    rows = model.score(test)
    gini = evaluate.normalized_gini(rows).first()["normalized_gini"]
    value = mean_deviance(kind, F.col("y"), F.col("yhat"), F.col("w"), power)
    balance = F.sum(F.col("yhat") * F.col("w")) / F.sum(F.col("y") * F.col("w"))
    both = rows.agg(value.alias("d"), balance.alias("b")).first()
    return {"test_gini": gini, "test_balance": both["b"], "test_deviance": both["d"]}


test_metrics.__test__ = False


def train(
    spark: SparkSession,
    gold_path: str,
    runs_path: str,
    kind: str,
    settings: Settings,
    use_case: str | None = None,
    register_as: str | None = None,
    **fixed,
) -> tuple[str, dict[str, float]]:
    """Fit one of frequency, severity, tweedie or challenger on its gold table and log the run."""
    if kind != "challenger" and kind not in FAMILIES:
        raise ValueError(f"unknown model {kind!r}")
    case = GOLD_OF.get(kind) or use_case or "frequency"
    train_rows, val_rows, test_rows = (read_split(spark, f"{gold_path}/{case}", s) for s in ("train", "val", "test"))
    artifacts = {}
    if kind == "challenger":
        trials_path = f"{runs_path}/trials_{case}"
        model = fit_challenger(case, train_rows, val_rows, settings, trials_path, **fixed)
        deviance = ("poisson", None) if case == "frequency" else ("tweedie", settings.boosting.tweedie_power)
        artifacts["trials"] = trials_path
    else:
        model = fit_glm_model(kind, train_rows, val_rows, settings)
        deviance = (FAMILIES[kind], model.glm.power)
        if kind == "frequency" and settings.modelling.offset_summary:
            artifacts["offset_summary"] = f"{runs_path}/offset_summary"
            table = offset_summary(train_rows, fit_design(train_rows, settings.features), settings.modelling.max_iter)
            write_table(table, artifacts["offset_summary"])
    metrics = {**model.metrics, **test_metrics(model, test_rows, *deviance)}
    data_hash = content_digest(train_rows).first()["content_digest"]
    run_id = runs.run_log_append(
        spark,
        runs_path,
        f"{kind}_{case}",
        model.params,
        metrics,
        {"gold_content_digest": data_hash},
        model.text,
        artifacts,
        register_as,
    )
    return run_id, metrics


def stability_runs(silver: DataFrame, kind: str, settings: Settings, seeds: list[int] | None = None) -> DataFrame:
    """(seed, gini, balance): refit on a fresh split per seed. A split is written once; seeds run side by side."""

    def run(seed: int) -> tuple[int, float, float]:
        gold = stored(gold_table(silver, GOLD_OF[kind], settings, replace(settings.splitting, seed=seed)), "stability", "split")
        parts = {s: gold.where(F.col("split") == s) for s in ("train", "val", "test")}
        model = fit_glm_model(kind, parts["train"], parts["val"], settings)
        found = test_metrics(model, parts["test"], FAMILIES[kind], model.glm.power)
        return seed, found["test_gini"], found["test_balance"]

    spark = silver.sparkSession
    with ThreadPoolExecutor(PARALLEL_SEEDS) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(run), seeds or settings.splitting.seeds()))
    return spark.createDataFrame(rows, "seed int, gini double, balance double")


def stability(silver: DataFrame, kind: str, settings: Settings, seeds: list[int] | None = None) -> DataFrame:
    return evaluate.stability_report(stability_runs(silver, kind, settings, seeds), "seed", ["gini", "balance"])


def drift_of_file(spark: SparkSession, gold_path: str, input_path: str, settings: Settings) -> DataFrame:
    """PSI of a stored table against the frequency training split, on the numeric columns both have."""
    reference, current = read_split(spark, f"{gold_path}/frequency", "train"), read_table(spark, input_path)
    features = [f for f in NUMERIC_FEATURES if f in reference.columns and f in current.columns]
    return psi_report(reference, current, features, settings.monitoring)
