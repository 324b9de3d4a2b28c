"""Queries for pricing, explanation, monitoring and streaming."""

from __future__ import annotations


from pyspark.sql import functions as F

from premia.catalog import layers
from premia.catalog.reference_sql import rising
from premia.catalog.registry import query, rounded
from premia.operators import attribution, boost, cleaning, drift, explain, profile, quality, quotes
from premia.operators.design import DesignSpec
from premia.operators.glm import FittedGlm, combine_freq_sev
from premia.plans import pricing, training
from premia.settings import NUMERIC_FEATURES
from premia.sources import adapter, sinks
from premia.streaming import jobs
from premia.workspace import fresh_path

S = layers.SETTINGS

# Fixed model: levels and coefficients by rule, so that both engines use the same numbers.
BRANDS = [f"B{i}" for i in range(1, 8)]
REGIONS = sorted(f"R{i}" for i in range(25))
BANDS = ["[10.0, 15.0)", "[4.0, 6.0)", "[6.0, 8.0)", "[8.0, 10.0)", "nan"]
FIXED_DESIGN = DesignSpec(
    splines={"driv_age": [18.0, 100.0], "veh_age": [0.0, 100.0]},
    scaled={"log_density": [7.0, 1.5], "bonus_malus": [65.0, 11.0]},
    area_levels=list("ABCDEF"),
    one_hot={"veh_brand": BRANDS, "region": REGIONS, "veh_gas": ["Diesel", "Regular"], "veh_power_band": BANDS},
)
DRIVER_WEIGHTS = [0.41, 0.23, 0.05, -0.07, -0.11, 0.02, 0.19]
VEHICLE_WEIGHTS = [0.12, 0.03, -0.04, -0.13, -0.21, -0.17, -0.09]
LEVEL_WEIGHTS = {
    "veh_brand": [0.013 * (i - 3) for i in range(1, 7)],
    "region": [0.0071 * (i - 12.5) for i in range(1, 25)],
    "veh_gas": [0.047],
    "veh_power_band": [0.029 * i for i in range(1, 5)],
}
COEFFICIENTS = [
    *DRIVER_WEIGHTS, *VEHICLE_WEIGHTS, 0.083, 0.061, 0.011,
    *[b for weights in LEVEL_WEIGHTS.values() for b in weights],
]
FREQUENCY = FittedGlm("poisson", 1.0, 0.0, -1.2, COEFFICIENTS, FIXED_DESIGN)
SEVERITY = FittedGlm("gamma", 2.0, 0.0, 8.9, [b * 0.5 for b in COEFFICIENTS], FIXED_DESIGN)
ASSETS = quotes.PricingAssets(FREQUENCY, SEVERITY, 3, 12, 54.25)


def _log_parts_sql(scale: float) -> dict[str, str]:
    parts = {
        "driv_age": " + ".join(f"({scale * b!r}) * ({rising('driv_age', '18', '100', i)})" for i, b in enumerate(DRIVER_WEIGHTS)),
        "veh_age": " + ".join(f"({scale * b!r}) * ({rising('veh_age', '0', '100', i)})" for i, b in enumerate(VEHICLE_WEIGHTS)),
        "log_density": f"({scale * 0.083!r}) * (log_density - 7) / 1.5",
        "bonus_malus": f"({scale * 0.061!r}) * (bonus_malus - 65) / 11.0",
        "area": f"({scale * 0.011!r}) * (ascii(area) - 65)",
    }
    for factor, levels in FIXED_DESIGN.one_hot.items():
        cases = " ".join(f"WHEN '{v}' THEN {scale * b!r}" for v, b in zip(levels[1:], LEVEL_WEIGHTS[factor]))
        parts[factor] = f"CASE {factor} {cases} ELSE 0 END"
    return {k: f"CAST(({v}) AS DOUBLE)" for k, v in parts.items()}


def _rate_sql(intercept: float, scale: float) -> str:
    return f"exp({intercept} + " + " + ".join(_log_parts_sql(scale).values()) + ")"


FREQUENCY_SQL, SEVERITY_SQL = _rate_sql(-1.2, 1.0), _rate_sql(8.9, 0.5)
FACTORS_SQL = " UNION ALL ".join(
    f"SELECT policy_id, '{name}' AS feature, exp({log}) AS factor FROM good_quotes"
    for name, log in _log_parts_sql(1.0).items()
)
TOP_SQL = f"""SELECT policy_id, feature, factor, row_number() OVER (PARTITION BY policy_id
    ORDER BY abs(ln(factor)) DESC, feature) AS position FROM ({FACTORS_SQL})"""
PRICED_SQL = f"""SELECT policy_id, f, s, f * s * exposure AS pure,
    f * s * exposure * CAST(1.15 AS DOUBLE) * CAST(1.05 AS DOUBLE) + CAST(54.25 AS DOUBLE) * exposure AS technical
    FROM (SELECT policy_id, exposure, {FREQUENCY_SQL} AS f, {SEVERITY_SQL} AS s FROM good_quotes)"""


def _levels(spark, sf):
    return profile.feature_levels(layers.stored_policies(spark, sf), S)


def _rules(spark, sf):
    levels = _levels(spark, sf)
    return quality.quote_rules(S, profile.levels_of(levels, "region"), profile.levels_of(levels, "veh_brand"))


def _good_quotes(spark, sf):
    return quality.validate_lenient(layers.quotes(spark, sf), _rules(spark, sf))[0]


@query(
    "validate_quote",
    """SELECT policy_id, driv_age, CASE WHEN driv_age > 100 THEN 'in_range(18, 100)' ELSE '' END AS _reason
       FROM quotes""",
)
def validate_quote(spark, sf):
    return quality.with_reasons(layers.quotes(spark, sf), _rules(spark, sf)).select("policy_id", "driv_age", "_reason")


@query(
    "quote_features",
    """SELECT policy_id, round(log_density, 6) AS log_density, veh_power_band,
              CAST(CASE WHEN veh_age <= 1 THEN 1 ELSE 0 END AS BIGINT) AS is_new_vehicle FROM good_quotes""",
)
def quote_features(spark, sf):
    rows = quotes.quote_features(_good_quotes(spark, sf), S)
    return rounded(rows.select("policy_id", "log_density", "veh_power_band", "is_new_vehicle"), 6, "log_density")


@query(
    "combine_freq_sev",
    f"SELECT policy_id, round({FREQUENCY_SQL} * {SEVERITY_SQL}, 4) AS pure_rate FROM good_quotes",
)
def combine_freq_sev_query(spark, sf):
    rows = quotes.quote_features(_good_quotes(spark, sf), S)
    rate = combine_freq_sev(FREQUENCY.prediction(), SEVERITY.prediction())
    return rounded(rows.select("policy_id", rate.alias("pure_rate")), 4, "pure_rate")


CODES_SQL = f"""SELECT policy_id, string_agg(feature || CASE WHEN factor > 1 THEN ' increases' ELSE ' decreases' END, ', '
    ORDER BY position) AS codes FROM ({TOP_SQL}) WHERE position <= 3 GROUP BY policy_id"""


def _codes_text():
    codes = [F.get("reason_codes", F.lit(i)) for i in range(S.pricing.reason_codes)]
    return F.concat_ws(", ", *[F.concat_ws(" ", c["feature"], c["direction"]) for c in codes])


@query(
    "price_quotes",
    f"""SELECT policy_id, round(f, 6) AS frequency, round(s, 4) AS severity, round(pure, 4) AS premium_pure,
               round(technical, 4) AS premium_technical, 'EUR' AS currency, 'freq:3|sev:12' AS model_version, codes
        FROM ({PRICED_SQL}) JOIN ({CODES_SQL}) USING (policy_id)""",
)
def price_quotes(spark, sf):
    priced, _ = pricing.price_table(layers.quotes(spark, sf), _levels(spark, sf), ASSETS, S)
    table = priced.withColumn("codes", _codes_text()).drop("request_id", "reason_codes")
    return rounded(rounded(table, 6, "frequency"), 4, "severity", "premium_pure", "premium_technical")


@query("glm_contributions", f"SELECT policy_id, feature, round(factor, 6) AS factor FROM ({FACTORS_SQL})")
def glm_contributions(spark, sf):
    rows = quotes.quote_features(_good_quotes(spark, sf), S)
    return rounded(explain.glm_contributions(rows, FREQUENCY, ["policy_id"]).drop("value"), 6, "factor")


@query(
    "top_reason_codes",
    f"""SELECT policy_id, CAST(position - 1 AS INTEGER) AS position, feature, round(factor, 6) AS factor,
               CASE WHEN factor > 1 THEN 'increases' ELSE 'decreases' END AS direction
        FROM ({TOP_SQL}) WHERE position <= 3""",
)
def top_reason_codes(spark, sf):
    rows = quotes.quote_features(_good_quotes(spark, sf), S)
    rows = explain.with_reason_codes(rows, FREQUENCY, 3)
    codes = rows.select("policy_id", F.posexplode_outer("reason_codes").alias("position", "c"))
    return rounded(codes.select("policy_id", "position", "c.feature", "c.factor", "c.direction"), 6, "factor")


@query(
    "spline_effect",
    f"""WITH r AS (SELECT CAST(min(driv_age) AS DOUBLE) AS low, CAST(max(driv_age) AS DOUBLE) AS high FROM gold_f
                   WHERE split = 'train'),
            g AS (SELECT low + i * (high - low) / 40 AS driv_age FROM r, range(41) t(i))
       SELECT round(driv_age, 6) AS x, round(exp({_log_parts_sql(1.0)['driv_age']}), 6) AS effect FROM g""",
)
def spline_effect(spark, sf):
    grid = explain.value_grid(layers.split_of(spark, sf, "frequency", "train"), "driv_age", 41)
    return rounded(explain.spline_effect(grid, FREQUENCY, "driv_age"), 6, "x", "effect")


@query("shap_contributions")
def shap_contributions(spark, sf):
    rows = training.boost_rows(layers.split_of(spark, sf, "frequency", "train"), ["policy_id"])
    model = boost.fit_boosted(rows, boost.BoostParams(trees=4))
    held = training.boost_rows(layers.split_of(spark, sf, "frequency", "test"), ["policy_id"])
    return attribution.shap_contributions(held, model, ["policy_id"])


@query("shap_additivity", "SELECT count(*) AS policies, true AS additive FROM gold_f WHERE split = 'test'")
def shap_additivity(spark, sf):
    """Contributions and their base add up to the log prediction of every policy."""
    rows, held = (training.boost_rows(layers.split_of(spark, sf, "frequency", s), ["policy_id"]) for s in ("train", "test"))
    model = boost.fit_boosted(rows, boost.BoostParams(trees=4))
    parts = attribution.shap_contributions(held, model, ["policy_id"])
    total = sum((F.col(f"`{c}`") for c in parts.columns if c != "policy_id"), F.lit(0.0))
    both = parts.select("policy_id", total.alias("total")).join(boost.score_boosted(held, model, ["policy_id"]), "policy_id")
    gap = F.max(F.abs(F.col("total") - F.log("yhat")))
    return both.agg(F.count(F.lit(1)).alias("policies"), (gap < 1e-9).alias("additive"))


@query(
    "load_pricing_assets",
    """WITH v AS (SELECT CASE veh_gas WHEN 'Diesel' THEN 'motor_frequency' ELSE 'motor_severity' END AS name, driv_age,
                         'run-' || CAST(max(policy_id) AS VARCHAR) AS run_id, CAST(sum(claim_nb) AS BIGINT) AS c
                  FROM silver GROUP BY veh_gas, driv_age)
       SELECT name, CAST(driv_age AS VARCHAR) AS version, run_id, 'hash-' || run_id AS data_hash
       FROM v QUALIFY driv_age = max(driv_age) OVER (PARTITION BY name)""",
)
def load_pricing_assets(spark, sf):
    """Latest versions joined with their runs, over model and run tables derived from the portfolio."""
    name = F.when(F.col("veh_gas") == "Diesel", S.pricing.frequency_model).otherwise(S.pricing.severity_model)
    models = (
        layers.silver_policies(spark, sf)
        .groupBy(name.alias("name"), F.col("driv_age").cast("string").alias("version"))
        .agg(
            F.concat(F.lit("run-"), F.max("policy_id").cast("string")).alias("run_id"),
            F.sum("claim_nb").cast("string").alias("model"),
        )
    )
    log = models.select(
        "run_id",
        F.lit("2024-01-01").cast("timestamp").alias("started_at"),
        F.create_map(F.lit("gold_content_digest"), F.concat(F.lit("hash-"), "run_id")).alias("tags"),
    )
    return pricing.pricing_models(models, log, S).select("name", "version", "run_id", "data_hash")


FEATURES = list(NUMERIC_FEATURES)
DECILES = "[" + ", ".join(f"{i / 10}" for i in range(11)) + "]"


def _long_sql(table: str, where: str, features) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM {table} WHERE {where}" for f in features
    )


def _psi_sql(ref: str, cur: str, distinct: bool) -> str:
    edges = f"quantile_cont(v, {DECILES})"
    edges = f"list_sort(list_distinct({edges}))" if distinct else edges
    place = "len(list_filter(e[2:len(e) - 1], lambda x: x <= v))"
    return f"""WITH ref_long AS ({ref}), cur_long AS ({cur}),
        edges AS (SELECT feature, {edges} AS e FROM ref_long GROUP BY feature),
        grid AS (SELECT feature, unnest(range(len(e) - 1)) AS bin FROM edges),
        r AS (SELECT feature, {place} AS bin, count(*) AS n FROM ref_long JOIN edges USING (feature) GROUP BY ALL),
        c AS (SELECT feature, {place} AS bin, count(*) AS n FROM cur_long JOIN edges USING (feature) GROUP BY ALL),
        s AS (SELECT grid.feature, grid.bin,
                     greatest(coalesce(r.n, 0) / (SELECT sum(n) FROM r r2 WHERE r2.feature = grid.feature), 0.0001) AS a,
                     greatest(coalesce(c.n, 0) / (SELECT sum(n) FROM c c2 WHERE c2.feature = grid.feature), 0.0001) AS b
              FROM grid LEFT JOIN r USING (feature, bin) LEFT JOIN c USING (feature, bin)),
        p AS (SELECT feature, sum((b - a) * ln(b / a)) AS psi FROM s GROUP BY feature)
        SELECT feature, round(psi, 6) AS psi,
               CASE WHEN psi >= 0.25 THEN 'alert' WHEN psi >= 0.1 THEN 'watch' ELSE 'stable' END AS status FROM p"""


def _split_psi(features, distinct=True):
    return _psi_sql(
        _long_sql("gold_f", "split = 'train'", features), _long_sql("gold_f", "split = 'test'", features), distinct
    )


@query("psi", _split_psi(["log_density"]))
def psi(spark, sf):
    train, test = (layers.split_of(spark, sf, "frequency", s) for s in ("train", "test"))
    return rounded(drift.psi_report(train, test, ["log_density"], S.monitoring), 6, "psi")


@query("psi_report", _split_psi([*FEATURES, "exposure"]))
def psi_report(spark, sf):
    train, test = (layers.split_of(spark, sf, "frequency", s) for s in ("train", "test"))
    return rounded(drift.psi_report(train, test, [*FEATURES, "exposure"], S.monitoring), 6, "psi")


@query(
    "psi_status",
    _psi_sql(
        _long_sql("gold_f", "split = 'train'", FEATURES),
        _long_sql("gold_f", "split = 'test' AND (driv_age < 60 OR veh_age < 3) AND density > 900", FEATURES),
        True,
    ),
)
def psi_status(spark, sf):
    """Drift of a portfolio that changed on purpose: all three statuses occur."""
    train, test = (layers.split_of(spark, sf, "frequency", s) for s in ("train", "test"))
    changed = test.where("(driv_age < 60 OR veh_age < 3) AND exp(log_density) > 900")
    return rounded(drift.psi_report(train, changed, FEATURES, S.monitoring), 6, "psi")


@query("drift_report", _split_psi(FEATURES))
def drift_report(spark, sf):
    root = fresh_path(spark, "drift")
    sinks.write_by_split(layers.gold(spark, sf, "frequency"), f"{root}/frequency")
    sinks.write_table(layers.split_of(spark, sf, "frequency", "test"), f"{root}/input")
    return rounded(training.drift_of_file(spark, root, f"{root}/input", S), 6, "psi")


COLOURED = "CASE status WHEN 'alert' THEN 'tab:red' WHEN 'watch' THEN 'tab:orange' ELSE 'tab:green' END"


@query("psi_bars", f"SELECT *, {COLOURED} AS colour FROM ({_split_psi(FEATURES)})")
def psi_bars(spark, sf):
    train, test = (layers.split_of(spark, sf, "frequency", s) for s in ("train", "test"))
    return rounded(drift.psi_bars(drift.psi_report(train, test, FEATURES, S.monitoring)), 6, "psi")


PREDICTED = "CAST(0.05 AS DOUBLE) + CAST(0.002 AS DOUBLE) * bonus_malus + CAST(0.001 AS DOUBLE) * driv_age"


@query(
    "prediction_drift",
    _psi_sql(
        f"SELECT 'yhat' AS feature, {PREDICTED} AS v FROM gold_f WHERE split = 'train'",
        f"SELECT 'yhat' AS feature, {PREDICTED} AS v FROM gold_f WHERE split = 'val'",
        True,
    ),
)
def prediction_drift(spark, sf):
    train, val = (layers.evaluation_rows(spark, sf, "frequency", s) for s in ("train", "val"))
    return rounded(drift.prediction_drift(train, val, S.monitoring), 6, "psi")


@query(
    "reference_distribution",
    f"""WITH l AS ({_long_sql('gold_f', "split = 'train'", FEATURES)}),
             e AS (SELECT feature, quantile_cont(v, {DECILES}) AS e FROM l GROUP BY feature),
             n AS (SELECT feature, len(list_filter(e[2:10], lambda x: x <= v)) AS bin, count(*) AS n
                   FROM l JOIN e USING (feature) GROUP BY ALL),
             g AS (SELECT feature, unnest(range(10)) AS bin, e FROM e)
        SELECT feature, CAST(bin AS INTEGER) AS bin, round(e[bin + 1], 6) AS low, round(e[bin + 2], 6) AS high,
               coalesce(n, 0) AS n FROM g LEFT JOIN n USING (feature, bin)""",
)
def reference_distribution(spark, sf):
    table = drift.reference_distribution(layers.split_of(spark, sf, "frequency", "train"), FEATURES, S.monitoring)
    bins = table.select("feature", "bin_edges", F.posexplode("bin_counts").alias("bin", "n"))
    low, high = F.get("bin_edges", F.col("bin")), F.get("bin_edges", F.col("bin") + 1)
    return rounded(bins.select("feature", "bin", low.alias("low"), high.alias("high"), "n"), 6, "low", "high")


@query("psi_from_reference", _split_psi(FEATURES, distinct=False))
def psi_from_reference(spark, sf):
    test = layers.split_of(spark, sf, "frequency", "test")
    return rounded(drift.psi_from_reference(layers.reference(spark, sf), test, FEATURES, S.monitoring), 6, "psi")


QUOTE_DRIFT_SQL = _psi_sql(
    _long_sql("gold_f", "split = 'train'", FEATURES), _long_sql("good_quotes", "true", FEATURES), False
)


@query("join_drift_reference", QUOTE_DRIFT_SQL)
def join_drift_reference(spark, sf):
    return rounded(pricing.quote_drift(_good_quotes(spark, sf), layers.reference(spark, sf), S), 6, "psi")


BUCKETS_SQL = ", ".join(
    f"count(*) FILTER (WHERE value <= {b:g}) AS le_{b:g}" for b in S.pricing.latency_buckets_ms
)


@query(
    "stream_request_metrics",
    f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS request_count,
               {BUCKETS_SQL}, count(value) AS le_inf, round(sum(value), 3) AS latency_sum,
               count(value) AS latency_count,
               round(coalesce(avg(CASE WHEN event_type = 'purchase' THEN value * 10 END), 0), 4) AS prediction_mean
        FROM events GROUP BY date_trunc('hour', ts)""",
)
def stream_request_metrics(spark, sf):
    out = fresh_path(spark, "request-metrics")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    log = adapter.request_log(jobs.read_stream(spark, sf, schema, "events.parquet"))
    jobs.start_request_metrics(log, f"{out}/result", f"{out}/progress", S).awaitTermination()
    table = jobs.latest_rows(spark, f"{out}/result", ["window_start"]).drop("window_end")
    table = table.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))
    return rounded(rounded(table, 3, "latency_sum"), 4, "prediction_mean")


def _quote_files(spark, sf) -> str:
    """Quotes as a folder of arriving files, some of them sent twice."""
    path = fresh_path(spark, "quote-stream")
    rows = layers.quotes(spark, sf).withColumns(
        {
            "request_id": F.col("policy_id"),
            "ts": F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.col("policy_id"), F.lit(600))),
        }
    )
    rows.unionByName(rows.where("policy_id % 97 = 1")).write.parquet(path)
    return path


@query(
    "stream_price",
    f"""SELECT policy_id AS request_id, 'priced' AS side, round(pure, 4) AS premium_pure FROM ({PRICED_SQL})
        UNION ALL SELECT policy_id, 'in_range(18, 100)', NULL FROM quotes WHERE driv_age > 100""",
)
def stream_price(spark, sf):
    source, out = _quote_files(spark, sf), fresh_path(spark, "stream-price")
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema)
    jobs.start_pricing(stream, _rules(spark, sf), ASSETS, out, f"{out}/progress", S).awaitTermination()
    priced = spark.read.parquet(f"{out}/priced").select("request_id", F.lit("priced").alias("side"), "premium_pure")
    rejected = spark.read.parquet(f"{out}/quarantine").select(
        "request_id", F.col("_reason").alias("side"), F.lit(None).cast("double").alias("premium_pure")
    )
    return rounded(priced.unionByName(rejected), 4, "premium_pure")


STREAM_DRIFT_SQL = _psi_sql(
    _long_sql("gold_f", "split = 'train'", FEATURES),
    " UNION ALL ".join(
        [
            _long_sql("good_quotes", "true", FEATURES),
            _long_sql("good_quotes", "policy_id % 97 = 1", FEATURES),
        ]
    ),
    False,
)


@query("stream_drift", STREAM_DRIFT_SQL)
def stream_drift(spark, sf):
    """Every arriving record counts, repeated ones too; invalid ages are left out."""
    source, out = _quote_files(spark, sf), fresh_path(spark, "stream-drift")
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema).where("driv_age <= 100")
    rows = quotes.quote_features(stream, S)
    reference = layers.reference(spark, sf)
    jobs.start_bin_counts(rows, FEATURES, reference, f"{out}/counts", f"{out}/progress").awaitTermination()
    return rounded(drift.psi_from_bins(reference, jobs.bin_counts(spark, f"{out}/counts"), S.monitoring), 6, "psi")


@query("price_with_trained_models")
def price_with_trained_models(spark, sf):
    """Train, register, load and price through the run log."""
    root = fresh_path(spark, "pricing")
    settings = S
    for kind, name in (("frequency", S.pricing.frequency_model), ("severity", S.pricing.severity_model)):
        sinks.write_by_split(layers.gold(spark, sf, kind), f"{root}/gold/{kind}")
        training.train(spark, f"{root}/gold", f"{root}/runs", kind, settings, register_as=name)
    load = cleaning.large_loss_load(layers.all_policies(spark, sf))
    sinks.write_table(load, f"{root}/silver/large_loss_load")
    assets = pricing.load_pricing_assets(spark, f"{root}/runs", f"{root}/silver", settings)
    priced, _ = pricing.price_table(layers.quotes(spark, sf), _levels(spark, sf), assets, settings)
    return priced.drop("reason_codes")


