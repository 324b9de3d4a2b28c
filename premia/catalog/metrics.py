"""Queries for aggregates, ordered operators and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.catalog import layers
from premia.catalog.registry import query, rounded
from premia.operators import cleaning, evaluate
from premia.operators.ordered import prefix_sum
from premia.operators.quotes import quote_features

S = layers.SETTINGS
SEGMENTS = ["area", "veh_brand", "veh_gas", "region", "driv_age_band"]


def _segment_sql(table: str, segments: list[str]) -> str:
    parts = [f"SELECT '{c}' AS segment, {c} AS segment_value, y, yhat, w FROM {table}" for c in segments]
    return f"""SELECT segment, segment_value, count(*) AS n, round(sum(w), 4) AS exposure,
           round(sum(y * w) / sum(w), 6) AS mean_actual, round(sum(yhat * w) / sum(w), 6) AS mean_pred,
           round((sum(y * w) / sum(w)) / (sum(yhat * w) / sum(w)), 6) AS ae_ratio
        FROM ({' UNION ALL '.join(parts)}) WHERE segment_value IS NOT NULL GROUP BY segment, segment_value"""


def _tidy_segments(table):
    return rounded(rounded(table, 6, "mean_actual", "mean_pred", "ae_ratio"), 4, "exposure")


@query("segment_ae", _segment_sql("eval_f", SEGMENTS))
def segment_ae(spark, sf):
    return _tidy_segments(evaluate.segment_ae(layers.evaluation_rows_with(spark, sf, "frequency", SEGMENTS), SEGMENTS))


@query("actual_vs_expected", _segment_sql("eval_f", ["veh_power_band", "veh_age_band"]))
def actual_vs_expected(spark, sf):
    columns = ["veh_power_band", "veh_age_band"]
    return _tidy_segments(
        evaluate.actual_vs_expected(layers.evaluation_rows_with(spark, sf, "frequency", columns), columns)
    )


@query(
    "union_segments",
    f"SELECT segment, count(*) AS levels, sum(n)::BIGINT AS n FROM ({_segment_sql('eval_f', SEGMENTS)}) GROUP BY segment",
)
def union_segments(spark, sf):
    rows = layers.evaluation_rows_with(spark, sf, "frequency", SEGMENTS)
    stacked = reduce(DataFrame.unionByName, [evaluate.segment_ae(rows, [c]) for c in SEGMENTS])
    return stacked.groupBy("segment").agg(F.count(F.lit(1)).alias("levels"), F.sum("n").alias("n"))


@query(
    "segment_bar_widths",
    f"""SELECT segment, segment_value, ae_ratio, round(exposure / max(exposure) OVER (PARTITION BY segment), 5) AS width
        FROM ({_segment_sql('eval_f', SEGMENTS)})""",
)
def segment_bar_widths(spark, sf):
    table = evaluate.segment_ae(layers.evaluation_rows_with(spark, sf, "frequency", SEGMENTS), SEGMENTS)
    bars = evaluate.segment_bar_widths(table).select("segment", "segment_value", "ae_ratio", "width")
    return rounded(rounded(bars, 6, "ae_ratio"), 5, "width")


def _bins_sql(table: str, bins: int) -> str:
    return f"""SELECT *, least(CAST(floor(CAST(cw AS DOUBLE) / CAST(tw AS DOUBLE) * {bins}) AS INTEGER), {bins - 1}) AS bin
        FROM (SELECT *, sum(CAST(w AS DECIMAL(28,10))) OVER (ORDER BY yhat, policy_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cw,
                     sum(CAST(w AS DECIMAL(28,10))) OVER () AS tw FROM {table})"""


def _lift_sql(table: str, bins: int, digits: int) -> str:
    return f"""SELECT bin, count(*) AS n, round(sum(w), 4) AS exposure,
           round(sum(yhat * w) / sum(w), {digits}) AS mean_pred, round(sum(y * w) / sum(w), {digits}) AS mean_actual,
           round((sum(y * w) / sum(w)) / (sum(yhat * w) / sum(w)), 6) AS ratio
        FROM ({_bins_sql(table, bins)}) GROUP BY bin"""


def _tidy_lift(table, digits):
    return rounded(rounded(rounded(table, digits, "mean_pred", "mean_actual"), 6, "ratio"), 4, "exposure")


@query("weighted_bins", f"SELECT policy_id, bin FROM ({_bins_sql('eval_f', 10)})")
def weighted_bins(spark, sf):
    return evaluate.weighted_bins(layers.evaluation_rows(spark, sf, "frequency"), 10).select("policy_id", "bin")


@query("lift_table", _lift_sql("eval_f", 10, 6))
def lift_table(spark, sf):
    return _tidy_lift(evaluate.lift_table(layers.evaluation_rows(spark, sf, "frequency")), 6)


@query("calibration_table", _lift_sql("eval_p", 20, 4))
def calibration_table(spark, sf):
    return _tidy_lift(evaluate.calibration_table(layers.evaluation_rows(spark, sf, "pure_premium")), 4)


@query(
    "calibration_diagonal",
    f"""SELECT round(least(min(mean_pred), min(mean_actual)), 4) AS low,
               round(greatest(max(mean_pred), max(mean_actual)), 4) AS high FROM ({_lift_sql('eval_p', 20, 6)})""",
)
def calibration_diagonal(spark, sf):
    table = evaluate.calibration_table(layers.evaluation_rows(spark, sf, "pure_premium"))
    return rounded(evaluate.diagonal_bounds(table), 4, "low", "high")


@query("balance_check", "SELECT round(sum(yhat * w) / sum(y * w), 6) AS balance FROM eval_p")
def balance_check(spark, sf):
    return rounded(evaluate.balance_check(layers.evaluation_rows(spark, sf, "pure_premium")), 6, "balance")


POISSON_SQL = "sum(w * 2 * (CASE WHEN y > 0 THEN y * ln(y / {m}) ELSE 0 END - y + {m})) / sum(w)"
GAMMA_SQL = "sum(w * 2 * (ln({m} / y) + y / {m} - 1)) / sum(w)"
TWEEDIE_SQL = (
    "sum(w * 2 * (CASE WHEN y > 0 THEN pow(y, 0.5::DOUBLE) ELSE 0 END / (-0.25) + y * pow({m}, -0.5::DOUBLE) / 0.5 "
    "+ pow({m}, 0.5::DOUBLE) / 0.5)) / sum(w)"
)


@query("poisson_deviance", f"SELECT round({POISSON_SQL.format(m='yhat')}, 6) AS deviance FROM eval_f")
def poisson_deviance(spark, sf):
    return rounded(evaluate.deviance(layers.evaluation_rows(spark, sf, "frequency"), "poisson"), 6, "deviance")


@query("gamma_deviance", f"SELECT round({GAMMA_SQL.format(m='yhat')}, 6) AS deviance FROM eval_s")
def gamma_deviance(spark, sf):
    return rounded(evaluate.deviance(layers.evaluation_rows(spark, sf, "severity"), "gamma"), 6, "deviance")


@query("tweedie_deviance", f"SELECT round({TWEEDIE_SQL.format(m='yhat')}, 4) AS deviance FROM eval_p")
def tweedie_deviance(spark, sf):
    return rounded(evaluate.deviance(layers.evaluation_rows(spark, sf, "pure_premium"), "tweedie", 1.5), 4, "deviance")


def _explained_sql(kind: str, formula: str, table: str) -> str:
    return f"""SELECT '{kind}' AS kind, round(1 - ({formula.format(m='yhat')}) / ({formula.format(m='base')}), 6)
        AS deviance_explained FROM (SELECT *, sum(y * w) OVER () / sum(w) OVER () AS base FROM {table})"""


@query(
    "deviance_explained",
    " UNION ALL ".join(
        [
            _explained_sql("poisson", POISSON_SQL, "eval_f"),
            _explained_sql("gamma", GAMMA_SQL, "eval_s"),
            _explained_sql("tweedie", TWEEDIE_SQL, "eval_p"),
        ]
    ),
)
def deviance_explained(spark, sf):
    """Against the weighted mean of the target as baseline."""
    cases = [("poisson", "frequency", None), ("gamma", "severity", None), ("tweedie", "pure_premium", 1.5)]
    parts = []
    for kind, use_case, power in cases:
        rows = layers.evaluation_rows(spark, sf, use_case)
        mean = rows.agg((F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("m")).first()["m"]
        found = evaluate.deviance_explained(rows.withColumn("base", F.lit(mean)), "base", kind, power)
        parts.append(found.select(F.lit(kind).alias("kind"), "deviance_explained"))
    return rounded(reduce(DataFrame.unionByName, parts), 6, "deviance_explained")


BRAND_RUNS_SQL = """SELECT veh_brand, sum(yhat * w) / sum(y * w) AS balance, sum(y * w) / sum(w) AS mean_actual
    FROM eval_f GROUP BY veh_brand"""


def _brand_runs(spark, sf):
    """Metrics of one portfolio part per brand, as stand-ins for runs."""
    rows = layers.evaluation_rows_with(spark, sf, "frequency", ["veh_brand"])
    weighted = F.sum(F.col("y") * F.col("w"))
    return rows.groupBy("veh_brand").agg(
        (F.sum(F.col("yhat") * F.col("w")) / weighted).alias("balance"), (weighted / F.sum("w")).alias("mean_actual")
    )


@query(
    "stability_report",
    f"""SELECT metric, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM (
          SELECT 'balance' AS metric, balance AS value FROM ({BRAND_RUNS_SQL})
          UNION ALL SELECT 'mean_actual', mean_actual FROM ({BRAND_RUNS_SQL})) GROUP BY metric""",
)
def stability_report(spark, sf):
    report = evaluate.stability_report(_brand_runs(spark, sf), "veh_brand", ["balance", "mean_actual"])
    return rounded(report, 6, "mean", "std")


@query(
    "metrics_unpivot",
    f"""SELECT veh_brand, 'balance' AS metric, round(balance, 6) AS value FROM ({BRAND_RUNS_SQL})
        UNION ALL SELECT veh_brand, 'mean_actual', round(mean_actual, 6) FROM ({BRAND_RUNS_SQL})""",
)
def metrics_unpivot(spark, sf):
    return rounded(evaluate.metrics_long(_brand_runs(spark, sf), "veh_brand", ["balance", "mean_actual"]), 6, "value")


@query("split_counts", "SELECT split, count(*) AS n FROM gold_s GROUP BY split")
def split_counts(spark, sf):
    return evaluate.split_counts(layers.gold(spark, sf, "severity"))


@query(
    "claim_rate_by_split",
    "SELECT split, round(avg(CASE WHEN claim_nb > 0 THEN 1.0 ELSE 0.0 END), 6) AS claim_rate FROM gold_f GROUP BY split",
)
def claim_rate_by_split(spark, sf):
    return rounded(evaluate.claim_rate_by_split(layers.gold(spark, sf, "frequency")), 6, "claim_rate")


RUNNING = "OVER (ORDER BY yhat, policy_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query(
    "prefix_sum",
    f"""SELECT policy_id, round(sum(w) {RUNNING}, 4) AS cum_w, round(sum(y * w) {RUNNING}, 2) AS cum_y,
               round(sum(w) OVER (), 4) AS cum_w_total, round(sum(y * w) OVER (), 2) AS cum_y_total FROM eval_p""",
)
def running_totals(spark, sf):
    rows = layers.evaluation_rows(spark, sf, "pure_premium")
    measures = {"cum_w": F.col("w"), "cum_y": F.col("y") * F.col("w")}
    out = prefix_sum(rows, "yhat", "policy_id", measures)
    tidy = rounded(rounded(out, 4, "cum_w", "cum_w_total"), 2, "cum_y", "cum_y_total")
    return tidy.select("policy_id", "cum_w", "cum_y", "cum_w_total", "cum_y_total")


def _curve_sql(table: str) -> str:
    return f"""SELECT round(sum(w) {RUNNING} / sum(w) OVER (), 7) AS cum_w,
                      round(sum(y * w) {RUNNING} / sum(y * w) OVER (), 7) AS cum_y FROM {table}"""


@query("lorenz_curve", f"{_curve_sql('eval_f')} UNION ALL SELECT 0.0, 0.0")
def lorenz_curve(spark, sf):
    return rounded(evaluate.lorenz_curve(layers.evaluation_rows(spark, sf, "frequency")), 7, "cum_w", "cum_y")


@query(
    "lorenz_curves_by_model",
    f"""SELECT 'frequency' AS model, * FROM ({_curve_sql('eval_f')}) UNION ALL SELECT 'frequency', 0.0, 0.0
        UNION ALL SELECT 'pure_premium', * FROM ({_curve_sql('eval_p')}) UNION ALL SELECT 'pure_premium', 0.0, 0.0""",
)
def lorenz_curves_by_model(spark, sf):
    parts = [
        layers.evaluation_rows(spark, sf, m).withColumn("model", F.lit(m)) for m in ("frequency", "pure_premium")
    ]
    curves = evaluate.lorenz_curve(parts[0].unionByName(parts[1]), by=["model"])
    return rounded(curves, 7, "cum_w", "cum_y")


def _gini_sql(table: str, order_by: str) -> str:
    run = f"OVER (ORDER BY {order_by}, policy_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""SELECT 1 - 2 * sum(w / tw * (2 * cy / ty - y * w / ty) / 2) AS gini
        FROM (SELECT y, w, sum(y * w) {run} AS cy, sum(w) OVER () AS tw, sum(y * w) OVER () AS ty FROM {table})"""


@query("lorenz_gini", f"SELECT round(gini, 6) AS gini FROM ({_gini_sql('eval_f', 'yhat')})")
def lorenz_gini(spark, sf):
    return rounded(evaluate.lorenz_gini(layers.evaluation_rows(spark, sf, "frequency"), "yhat"), 6, "gini")


@query(
    "normalized_gini",
    f"""SELECT round(m.gini, 6) AS model_gini, round(p.gini, 6) AS perfect_gini,
               round(m.gini / p.gini, 6) AS normalized_gini
        FROM ({_gini_sql('eval_p', 'yhat')}) m, ({_gini_sql('eval_p', 'y')}) p""",
)
def normalized_gini(spark, sf):
    table = evaluate.normalized_gini(layers.evaluation_rows(spark, sf, "pure_premium"))
    return rounded(table, 6, *table.columns)


@query(
    "union_quotes",
    """SELECT area, count(*) AS n, round(sum(ln(density)), 4) AS log_density FROM quotes GROUP BY area""",
)
def union_quotes(spark, sf):
    """Arriving request parts stacked into one table before features are added."""
    quotes = layers.quotes(spark, sf)
    parts = [quotes.where(F.col("veh_gas") == g) for g in S.features.fuel_levels]
    rows = quote_features(reduce(DataFrame.unionByName, parts), S)
    table = rows.groupBy("area").agg(F.count(F.lit(1)).alias("n"), F.sum("log_density").alias("log_density"))
    return rounded(table, 4, "log_density")


@query(
    "train_val_test_union",
    "SELECT count(*) AS bronze_rows, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS surplus FROM freq",
)
def train_val_test_union(spark, sf):
    """Conservation: the three splits and the quarantine together are the bronze rows, nothing lost or doubled."""
    parts = [layers.split_of(spark, sf, "frequency", s).select("policy_id") for s in ("train", "val", "test")]
    _, rejected = cleaning.split_quarantine(layers.all_policies(spark, sf))
    stacked = reduce(DataFrame.unionByName, [*parts, rejected.select("policy_id")])
    bronze = layers.stored_policies(spark, sf).select(F.col("IDpol").alias("policy_id"))
    return (
        bronze.agg(F.count(F.lit(1)).alias("bronze_rows"))
        .withColumn("missing", bronze.exceptAll(stacked).agg(F.count(F.lit(1))).scalar())
        .withColumn("surplus", stacked.exceptAll(bronze).agg(F.count(F.lit(1))).scalar())
    )
