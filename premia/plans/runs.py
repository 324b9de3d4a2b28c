"""Run log and model store as numbered commits: a run or a model version appears whole, once and under its own number."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.sources import commits
from premia.sources.readers import read_commits

RUNS = (
    "run_id string, run_name string, params map<string,string>, metrics map<string,double>, "
    "tags map<string,string>, artifacts map<string,string>, started_at timestamp"
)
MODELS = "name string, version string, run_id string, model string"


def register_model(spark: SparkSession, path: str, name: str, run_id: str, model_json: str) -> int:
    """Store the model as the next version of its name. Writers that come at once get different versions: the one whose
    number is taken meanwhile goes on to the next."""

    def entry(number: int, _: list[str]) -> str:
        return json.dumps({"name": name, "version": str(number), "run_id": run_id, "model": model_json})

    return commits.commit(spark, f"{path}/models/{quote(name, safe='')}", entry)


def run_log_append(
    spark: SparkSession,
    path: str,
    run_name: str,
    params: dict,
    metrics: dict[str, float],
    tags: dict[str, str],
    model_json: str,
    artifacts: dict[str, str] | None = None,
    register_as: str | None = None,
) -> str:
    run_id = uuid.uuid4().hex
    row = {
        "run_id": run_id,
        "run_name": run_name,
        "params": {k: json.dumps(v) for k, v in params.items()},
        "metrics": {k: float(v) for k, v in metrics.items()},
        "tags": tags,
        "artifacts": artifacts or {},
        "started_at": datetime.now(timezone.utc).isoformat(),
    }
    commits.commit(spark, f"{path}/runs", lambda *_: json.dumps(row))
    if register_as:
        register_model(spark, path, register_as, run_id, model_json)
    return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_commits(spark, f"{path}/runs", RUNS)


def read_models(spark: SparkSession, path: str) -> DataFrame:
    return read_commits(spark, f"{path}/models", MODELS)


def run_log_metrics(runs: DataFrame, run_id: str | None = None) -> DataFrame:
    chosen = runs.where(F.col("run_id") == run_id) if run_id else runs
    return chosen.select("run_id", F.explode("metrics").alias("metric", "value"))


def model_latest(models: DataFrame) -> DataFrame:
    """The highest version of each name, compared as a number."""
    number = F.col("version").cast("int")
    last = F.max_by(F.struct("version", "run_id", "model"), number).alias("m")
    return models.groupBy("name").agg(last).select("name", "m.*")


def latest_version(models: DataFrame, name: str) -> int | None:
    row = model_latest(models).where(F.col("name") == name).first()
    return int(row["version"]) if row else None


def load_model(models: DataFrame, name: str, version: str = "latest") -> str:
    """The stored model text; raises when the name has no registered version."""
    named = models.where(F.col("name") == name)
    row = model_latest(named).first() if version == "latest" else named.where(F.col("version") == version).first()
    if row is None:
        raise ValueError(f"no registered version of model {name!r}")
    return row["model"]
