from dataclasses import replace
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from premia.catalog import modelling
from premia.operators import attribution, boost, design, evaluate, explain, glm, irls, search, tune
from premia.operators.features import scored
from premia.plans import runs, training
from premia.settings import Boosting, Modelling, Settings
from premia.sources.readers import read_split


def gold(spark, job_folders, case, split="train"):
    return read_split(spark, f"{job_folders['root']}/gold/{case}", split)


def newton(rows, spec, power, alpha):
    """Independent ridge solution of the same objective."""
    encoded = design.encoded_columns(rows, spec, ["y", "sample_weight"]).toPandas()
    y, w = encoded["y"].to_numpy(), encoded["sample_weight"].to_numpy(dtype=float)
    x = np.column_stack([np.ones(len(y)), encoded.iloc[:, 2:].to_numpy()])
    beta = np.zeros(x.shape[1])
    beta[0] = np.log(np.average(y, weights=w))
    ridge = alpha * np.eye(len(beta))
    ridge[0, 0] = 0
    for _ in range(100):
        mu = np.exp(x @ beta)
        gradient = x.T @ (w * (y - mu) * mu ** (1 - power)) / w.sum() - ridge @ beta
        hessian = (x * (w * mu ** (2 - power))[:, None]).T @ x / w.sum() + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-12:
            return beta
    raise AssertionError("no convergence")


@pytest.mark.parametrize(
    ("case", "family", "power", "alpha"),
    [("frequency", "poisson", 1.0, 0.01), ("severity", "gamma", 2.0, 0.01), ("pure_premium", "tweedie", 1.5, 1.0)],
)
def test_ridge_fit_equals_newton(spark, settings, job_folders, case, family, power, alpha):
    rows = gold(spark, job_folders, case)
    model = tune.train_glm(rows, family, alpha, power if family == "tweedie" else None, settings)
    expected = newton(rows, model.design, power, alpha)
    np.testing.assert_allclose([model.intercept, *model.coefficients], expected, atol=1e-6)


def test_fits_of_a_grid_equal_single_fits(spark, settings, job_folders):
    grids = {
        "frequency": [("poisson", 0.001, None), ("poisson", 1.0, None)],
        "severity": [("gamma", 0.01, None)],
        "pure_premium": [("tweedie", 1.0, 1.2), ("tweedie", 1.0, 1.8)],
    }
    parts, points = {}, []
    for no, (case, grid) in enumerate(grids.items()):
        cells = design.design_cells(gold(spark, job_folders, case), list(design.GLM_SOURCES))
        parts[no] = cells, design.fit_design(cells, settings.features, rows="n_rows")
        points += [irls.Point(no, *g) for g in grid]
    models = irls.fit_many(irls.stack(parts), {no: spec for no, (_, spec) in parts.items()}, points)
    for point, model in zip(points, models, strict=True):
        cells, spec = parts[point.part]
        single = glm.fit_glm(cells, spec, point.family, point.alpha, point.power)
        found, wanted = ([m.intercept, *m.coefficients] for m in (model, single))
        np.testing.assert_allclose(found, wanted, atol=1e-6)
        exact = newton(gold(spark, job_folders, list(grids)[point.part]), spec, point.p, point.alpha)
        np.testing.assert_allclose(found, exact, atol=1e-8)


def test_unregularised_poisson_is_balanced(spark, job_folders):
    rows = gold(spark, job_folders, "frequency")
    cells = design.design_cells(rows, ["area"])
    model = glm.fit_glm(cells, design.one_way_design(rows, "area"), "poisson", 0.0)
    assert evaluate.balance_check(scored(rows, model.prediction())).first()[0] == pytest.approx(1, abs=1e-6)


def test_cells_give_the_same_fit_as_rows(spark, settings, job_folders):
    rows = gold(spark, job_folders, "pure_premium")
    spec = design.one_way_design(rows, "veh_brand")
    plain = rows.withColumn("w", F.col("sample_weight").cast("double"))
    one = glm.fit_glm(plain, spec, "tweedie", 0.5, 1.6)
    two = glm.fit_glm(design.design_cells(rows, ["veh_brand"]), spec, "tweedie", 0.5, 1.6)
    np.testing.assert_allclose(one.coefficients, two.coefficients, atol=1e-7)


def test_offset_equals_rate_and_weight(spark, settings):
    # Closed form: with one factor each fitted rate is the level's claims over its exposure.
    ids = np.arange(900)
    exposure, band = 0.2 + 0.1 * (ids % 8), np.array(["A", "B", "C"])[ids % 3]
    claims = (ids * (1 + ids % 3) % 7 == 0).astype(int) + (ids % 11 == 0)
    pdf = pd.DataFrame({"exposure": exposure, "region": band, "claim_nb": claims, "y": claims / exposure, "sample_weight": exposure})
    rows = spark.createDataFrame(pdf)
    spec = design.one_way_design(rows, "region")
    rate = glm.fit_glm(design.design_cells(rows, ["region"]), spec, "poisson", 0.0)
    table = {r["param"]: r for r in glm.offset_summary(rows, spec).collect()}
    found = [table["const"]["coef"], table["region_B"]["coef"], table["region_C"]["coef"]]
    np.testing.assert_allclose(found, [rate.intercept, *rate.coefficients], atol=1e-6)
    logs = [np.log(claims[band == b].sum() / exposure[band == b].sum()) for b in "ABC"]
    np.testing.assert_allclose(found, [logs[0], logs[1] - logs[0], logs[2] - logs[0]], atol=1e-6)
    assert all(r["std_err"] > 0 for r in table.values())


def test_offset_summary_leaves_dependent_columns_out(spark, settings, job_folders):
    rows = gold(spark, job_folders, "frequency")
    table = {r["param"]: r for r in glm.offset_summary(rows, design.fit_design(rows, settings.features)).collect()}
    assert table["driv_age_sp_6"]["std_err"] is None and table["driv_age_sp_6"]["coef"] == 0.0
    assert table["bonus_malus"]["std_err"] > 0


def test_design_terms(spark, settings, job_folders):
    train = gold(spark, job_folders, "frequency")
    spec = design.fit_design(train, replace(settings.features, interactions=True))
    encoded = design.encoded_columns(train, spec, ["driv_age", "veh_power"]).toPandas()
    spline = encoded[[c for c in encoded if c.startswith("driv_age_sp")]].to_numpy()
    np.testing.assert_allclose(spline.sum(axis=1), 1, atol=1e-12)
    assert encoded["log_density"].std(ddof=0) == pytest.approx(1) and "veh_brand_B1" not in encoded
    assert (encoded["driv_age_x_veh_power"] == encoded["driv_age"] * encoded["veh_power"]).all()
    other = design.encoded_columns(gold(spark, job_folders, "frequency", "test"), spec, [])
    assert len(other.columns) == len(design.terms(spec))
    with pytest.raises(Exception, match="unseen veh_brand: B99"):
        design.encoded_columns(train.withColumn("veh_brand", F.lit("B99")), spec, []).collect()


def test_contributions_multiply_to_the_prediction(spark, settings, job_folders):
    rows = gold(spark, job_folders, "frequency")
    model = tune.train_glm(rows, "poisson", 0.01, None, settings)
    long = explain.glm_contributions(rows, model, ["policy_id"])
    product = long.groupBy("policy_id").agg(F.sum(F.log("factor")).alias("s"))
    both = rows.select("policy_id", model.log_rate().alias("eta")).join(product, "policy_id")
    assert both.agg(F.max(F.abs(F.col("eta") - F.col("s") - model.intercept))).first()[0] < 1e-10
    codes = explain.with_reason_codes(rows, model, 3).first()["reason_codes"]
    strengths = [abs(np.log(c["factor"])) for c in codes]
    assert len(codes) == 3 and strengths == sorted(strengths, reverse=True)
    assert all((c["direction"] == "increases") == (c["factor"] > 1) for c in codes)


def test_cross_validation_table_and_choice(spark, job_folders):
    settings = Settings(modelling=Modelling(folds=2, tweedie_powers=(1.3, 1.7)))
    rows = gold(spark, job_folders, "pure_premium")
    table = tune.cross_validate(rows, "tweedie", tune.grid_of("tweedie", settings), settings)
    assert table.count() == 4
    alpha, power, score = tune.select_best(table)
    assert alpha == 1.0 and power in (1.3, 1.7)
    means = {r["power"]: r["d"] for r in table.groupBy("power").agg(F.avg("deviance").alias("d")).collect()}
    assert score == min(means.values())


def test_ties_go_to_the_first_grid_point(spark):
    rows = [("poisson", a, 1.0, 0, 2.0) for a in (0.1, 0.001, 1.0)]
    assert tune.select_best(spark.createDataFrame(rows, tune.CV_TABLE))[0] == 0.001


PARAMS = boost.BoostParams(trees=4, depth=3, leaves=6, min_child_rows=5)


def one_by_one(bins, y, w, m, features, binning, params):
    """Best-first growth that splits one leaf after the other and sums every histogram anew."""

    def hist(rows):
        g, h = boost.gradients(params, y[rows], w[rows], m[rows])
        out = np.zeros((3, len(features), boost.MAX_BINS))
        for f in range(len(features)):
            for k, v in enumerate((g, h, np.ones(len(rows)))):
                np.add.at(out[k, f], bins[rows, f], v)
        return out

    leaves = {0: (np.arange(len(y)), (-np.inf, np.inf), 0)}
    splits, next_id = [], 1
    while len(leaves) < params.leaves:
        found = {}
        for node, (rows, bounds, depth) in leaves.items():
            if params.depth is None or depth < params.depth:
                candidate = boost.best_split(hist(rows), features, binning, params, bounds)
                if candidate:
                    found[node] = candidate
        if not found:
            break
        node = max(found, key=lambda n: (found[n].gain, -n))
        best, (rows, (low, high), depth) = found[node], leaves.pop(node)
        goes = best.split.goes_left(bins[rows, features.index(best.split.feature)])
        middle = (best.left[0] + best.right[0]) / 2
        tight = best.split.feature in params.increasing
        leaves[next_id] = rows[goes], (low, middle if tight else high), depth + 1
        leaves[next_id + 1] = rows[~goes], (middle if tight else low, high), depth + 1
        splits.append((node, best.split, int(goes.sum()), int((~goes).sum())))
        next_id += 2
    return splits


@pytest.mark.parametrize(("leaves", "depth", "loss"), [(100, None, "poisson"), (12, None, "tweedie"), (40, 4, "poisson")])
def test_growth_equals_splitting_one_leaf_at_a_time(leaves, depth, loss):
    rng = np.random.default_rng(7)
    n, features = 1000, ["a", "b", "c", "d"]
    binning = boost.Binning({"a": list(range(29)), "b": list(range(9)), "c": list(range(49))}, {"d": [f"l{i}" for i in range(8)]})
    bins = np.column_stack([rng.integers(0, binning.size(f), n) for f in features])
    w = rng.uniform(0.1, 1, n)
    y = rng.poisson(np.exp(0.05 * bins[:, 0] - 0.3 * (bins[:, 3] % 3) - 1) * w) / w
    m = np.full(n, np.log(np.average(y, weights=w)))
    params = boost.BoostParams(loss=loss, leaves=leaves, depth=depth, min_child_rows=4, increasing=("a",), ridge=0.5)
    counted = []

    def count(tree, nodes):
        counted.append(len(nodes))
        at, g_h = tree.places(bins, features), boost.gradients(params, y, w, m)
        out = {}
        for node in nodes:
            rows = at == node
            out[node] = np.stack(
                [[np.bincount(bins[rows, f], v[rows], boost.MAX_BINS) for f in range(len(features))] for v in (*g_h, np.ones(n))]
            )
        return out

    tree = boost.grow_tree(count, binning, params, features)
    want = one_by_one(bins, y, w, m, features, binning, params)
    assert [(n, s) for n, s in tree.splits.items()] == [(n, s) for n, s, _, _ in want]
    assert [tuple(tree.rows[c] for c in tree.children[n]) for n, *_ in want] == [x[2:] for x in want]
    assert len(tree.leaves()) == len(want) + 1 and (leaves != 100 or len(tree.leaves()) > 64)
    assert len(counted) <= tree.depth() + 4


def test_large_trees_on_spark_and_missing_bins(spark):
    n = 6000
    rows = spark.range(n).selectExpr(
        "cast(id % 251 as double) AS x", "nullif(id % 17, 3) AS z", "concat('k', id % 5) AS k", "cast(1 + id % 3 as double) AS w", "cast((id * 7919) % 1009 as double) / 100 AS y"
    )
    params = boost.BoostParams(trees=2, leaves=90, min_child_rows=5, increasing=())
    model = boost.fit_boosted(rows, params, numeric=("x", "z"), categorical=("k",))
    assert [len(t.leaves()) for t in model.trees] == [90, 90]
    for tree in model.trees:
        assert sum(tree.rows[leaf] for leaf in tree.leaves()) == n
    scored_rows = boost.score_boosted(rows, model, ["y", "w"]).toPandas()
    assert scored_rows["yhat"].notna().all()
    with pytest.raises(ValueError, match="monotone"):
        boost.fit_boosted(rows, boost.BoostParams(), numeric=("x",), categorical=("k",))


def test_a_fit_goes_on_after_its_finished_trees(spark, job_folders, tmp_path, monkeypatch):
    rows = training.boost_rows(gold(spark, job_folders, "frequency"), ["policy_id"])
    path, params = str(tmp_path / "trees"), boost.BoostParams(trees=3, leaves=5, min_child_rows=5, feature_share=0.5)
    whole = boost.fit_boosted(rows, params)
    grow, grown = boost.grow_tree, []

    def stops(*args):
        if len(grown) == 2:
            raise RuntimeError("driver lost")
        grown.append(1)
        return grow(*args)

    monkeypatch.setattr(boost, "grow_tree", stops)
    with pytest.raises(RuntimeError, match="driver lost"):
        boost.fit_boosted(rows, params, progress=path)
    monkeypatch.setattr(boost, "grow_tree", lambda *a: grown.append(1) or grow(*a))
    again = boost.fit_boosted(rows, params, progress=path)
    assert len(grown) == 3
    assert [list(t.splits.values()) for t in again.trees] == [list(t.splits.values()) for t in whole.trees]
    for one, two in zip(again.trees, whole.trees, strict=True):
        np.testing.assert_allclose(list(one.values.values()), list(two.values.values()), rtol=1e-9)


def brute_shapley(bins, tree, features):
    """Shapley values by all subsets, with absent features averaged by cover."""
    from itertools import combinations
    from math import factorial

    def expected(row, known, node=0):
        if node not in tree.children:
            return tree.values[node]
        split, (a, b) = tree.splits[node], tree.children[node]
        if split.feature in known:
            at = row[features.index(split.feature)]
            return expected(row, known, a if split.goes_left(np.array([at]))[0] else b)
        return (tree.rows[a] * expected(row, known, a) + tree.rows[b] * expected(row, known, b)) / tree.rows[node]

    d = len(features)
    out = np.zeros((len(bins), d))
    for r, row in enumerate(bins):
        for i, f in enumerate(features):
            others = [x for x in features if x != f]
            for k in range(d):
                for subset in combinations(others, k):
                    share = factorial(k) * factorial(d - k - 1) / factorial(d)
                    out[r, i] += share * (expected(row, {*subset, f}) - expected(row, set(subset)))
    return out


def test_attributions_equal_all_subsets(spark):
    rows = spark.range(800).selectExpr("cast(id % 13 as double) AS a", "cast((id * 7) % 11 as double) AS b", "cast((id * 3) % 5 as double) AS c", "concat('k', id % 4) AS k", "1D AS w", "cast((id * 31) % 97 as double) AS y")
    model = boost.fit_boosted(rows, boost.BoostParams(trees=2, leaves=14, depth=4, increasing=(), min_child_rows=3), numeric=("a", "b", "c"), categorical=("k",))
    features = model.binning.features
    bins = boost.binned(rows.limit(25), model.binning, []).toPandas().to_numpy()
    want = sum(brute_shapley(bins, t, features) for t in model.trees)
    np.testing.assert_allclose(attribution.tree_attributions(bins, model.trees, features), want, atol=1e-12)


@pytest.fixture(scope="module")
def boosted(spark, job_folders):
    rows = training.boost_rows(gold(spark, job_folders, "frequency"), ["policy_id"])
    return rows, boost.fit_boosted(rows, PARAMS)


def test_boosting_improves_on_the_mean(spark, boosted):
    rows, model = boosted
    score = boost.score_boosted(rows, model, ["y", "w"])
    mean = np.exp(model.base)
    fitted = search.boost_deviance(score, "poisson", 1.5)
    assert fitted < search.boost_deviance(score.withColumn("yhat", F.lit(float(mean))), "poisson", 1.5)


def test_predictions_rise_with_bonus_malus(spark, boosted):
    rows, model = boosted
    one = rows.limit(40).drop("bonus_malus").withColumn("id", F.monotonically_increasing_id())
    grid = one.join(spark.range(50, 200, 5).withColumnRenamed("id", "bonus_malus"))
    scored_grid = boost.score_boosted(grid, model, ["id", "bonus_malus"]).toPandas()
    for _, part in scored_grid.sort_values("bonus_malus").groupby("id"):
        assert part["yhat"].diff().dropna().min() >= -1e-12


def test_attributions_add_up(spark, boosted):
    rows, model = boosted
    values = attribution.shap_contributions(rows, model, ["policy_id"])
    total = sum((F.col(f) for f in model.binning.features), F.col("expected"))
    both = values.join(boost.score_boosted(rows, model, ["policy_id"]), "policy_id")
    assert both.agg(F.max(F.abs(total - F.log("yhat")))).first()[0] < 1e-12


def test_stored_model_scores_the_same(boosted):
    rows, model = boosted
    again = boost.BoostedModel.from_json(model.to_json())
    one, two = (boost.score_boosted(rows, m, ["policy_id"]) for m in (model, again))
    assert one.exceptAll(two).count() == 0


def test_search_resumes(spark, job_folders, tmp_path):
    train, val = (training.boost_rows(gold(spark, job_folders, "frequency", s), []) for s in ("train", "val"))
    path, fixed = str(tmp_path / "trials"), {"trees": 1, "depth": 2}
    first = search.search(train, val, "poisson", Boosting(trials=1), path, **fixed).collect()
    both = search.search(train, val, "poisson", Boosting(trials=2), path, **fixed)
    assert both.count() == 2 and first[0] in both.collect()
    assert search.best_params(both).trees == 1


def test_a_search_that_is_stopped_midway_ends_with_the_same_table(spark, job_folders, tmp_path, monkeypatch):
    train, val = (training.boost_rows(gold(spark, job_folders, "frequency", s), []) for s in ("train", "val"))
    settings, fixed = Boosting(trials=2, parallel_trials=2), {"trees": 2, "leaves": 4}
    whole = search.search(train, val, "poisson", settings, str(tmp_path / "whole"), **fixed).collect()
    path, fit, fits = str(tmp_path / "stopped"), search.fit_boosted, []

    def stops(*args, **kw):
        fits.append(1)
        if len(fits) == 2:
            raise RuntimeError("driver lost")
        return fit(*args, **kw)

    monkeypatch.setattr(search, "fit_boosted", stops)
    with pytest.raises(RuntimeError, match="driver lost"):
        search.search(train, val, "poisson", settings, path, **fixed)
    monkeypatch.setattr(search, "fit_boosted", fit)
    again = search.search(train, val, "poisson", settings, path, **fixed).collect()
    assert [r[:3] for r in again] == [r[:3] for r in whole]
    np.testing.assert_allclose([r.deviance for r in again], [r.deviance for r in whole], rtol=1e-9)


def test_a_trial_that_another_driver_holds_is_left_to_it(spark, job_folders, tmp_path, monkeypatch):
    train, val = (training.boost_rows(gold(spark, job_folders, "frequency", s), []) for s in ("train", "val"))
    path, settings = str(tmp_path / "trials"), Boosting(trials=1)
    with monkeypatch.context() as patch:
        patch.setattr(search, "_claimed", lambda *a: False)
        assert search.search(train, val, "poisson", settings, path, trees=1).count() == 0
    assert search._claimed(spark, path, "a") and search._claimed(spark, path, "a")
    search.release_claims(spark, path)
    assert search.search(train, val, "poisson", settings, path, trees=1, leaves=3).count() == 1


def test_training_job_logs_and_registers(spark, job_folders, tmp_path):
    settings = Settings(modelling=Modelling(poisson_alphas=(0.01,), folds=2))
    path = str(tmp_path)
    run_id, metrics = training.train(
        spark, f"{job_folders['root']}/gold", path, "frequency", settings, register_as="motor_frequency"
    )
    assert metrics["test_deviance"] > 0 and -0.2 <= metrics["test_gini"] <= 1
    logged = {r["metric"]: r["value"] for r in runs.run_log_metrics(runs.read_runs(spark, path), run_id).collect()}
    assert logged == metrics
    model = glm.FittedGlm.from_json(runs.load_model(runs.read_models(spark, path), "motor_frequency"))
    rows = gold(spark, job_folders, "frequency")
    assert evaluate.balance_check(scored(rows, model.prediction())).first()[0] == pytest.approx(1, abs=1e-2)
    with pytest.raises(ValueError, match="no registered version"):
        runs.load_model(runs.read_models(spark, path), "unknown")
    with pytest.raises(ValueError, match="unknown model"):
        training.train(spark, path, path, "forest", settings)


def test_latest_version_is_a_number(spark):
    rows = [("m", str(v), f"r{v}", "{}") for v in (2, 9, 10)]
    models = spark.createDataFrame(rows, runs.MODELS)
    assert runs.latest_version(models, "m") == 10


def test_the_search_query_runs_every_trial_of_the_settings(spark, monkeypatch):
    """All trials, each with the trees, leaves and other parameters that it draws."""
    seen = []
    monkeypatch.setattr(modelling, "_boost_rows", lambda spark, sf, use_case, split="train": split)
    monkeypatch.setattr(search, "search", lambda train, val, loss, settings, path, **fixed: seen.append((train, val, loss, settings, fixed)))
    modelling.gbm_search(spark, "unused")
    assert seen == [("train", "val", "poisson", Boosting(), {})]
    drawn = [search.trial_params(t, "poisson", Boosting())[0].trees for t in range(Boosting().trials)]
    assert len(drawn) == 50 and min(drawn) >= 50 and max(drawn) > 500


def test_a_fit_keeps_one_table_of_margins(spark, boosted, tmp_path, monkeypatch):
    """Hundreds of trees store dozens of tables; those before the last are deleted, and the shared one stays."""
    rows, _ = boosted
    made, stored = [], boost.stored
    monkeypatch.setattr(boost, "stored", lambda df, label: made.append(stored(df, label)) or made[-1])
    table = boost.boost_table(rows, 16)
    params = boost.BoostParams(trees=5, leaves=3, bins=16, store_every=2)
    model = boost.fit_boosted(None, params, table=table)
    assert len(made) == 3 and len(model.trees) == 5
    folders = [Path(df.inputFiles()[0].removeprefix("file://")).parent for df in made]
    assert [f.exists() for f in folders] == [True, False, False]
    assert boost.fit_boosted(None, params, table=table) == model


def test_the_challenger_query_searches_as_configured(spark, monkeypatch):
    """Neither fewer trials nor fewer trees than the settings name."""
    seen = []
    monkeypatch.setattr(modelling, "_gold_files", lambda spark, sf, use_case: f"gold/{use_case}")
    monkeypatch.setattr(training, "train", lambda spark, *args, **named: seen.append((args, named)))
    monkeypatch.setattr(runs, "read_runs", lambda *args: None)
    monkeypatch.setattr(runs, "run_log_metrics", lambda rows: spark.createDataFrame([("r", "m", 1.0)], "run_id string, metric string, value double"))
    assert modelling.train_report_challenger(spark, "unused").columns == ["metric", "value"]
    assert seen == [(("gold/pure_premium", "gold/pure_premium/runs", "challenger", Settings()), {"use_case": "pure_premium"})]
