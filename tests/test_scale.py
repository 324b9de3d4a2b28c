"""Registered queries and operators on small tables of their own: faults found on larger tables and odd inputs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from premia import workspace
from premia.catalog import all_queries, layers
from premia.catalog.online import FREQUENCY
from premia.operators import boost, cleaning, design, ordered
from premia.plans import training


def write_tables(root, n: int = 600, customers: int = 60):
    """Order tables of the adapter: every order a policy, each third with two claims."""
    key, cust = list(range(1, n + 1)), [1 + i * 7 % customers for i in range(1, n + 1)]
    pd.DataFrame({"o_orderkey": key, "o_custkey": cust, "o_orderstatus": ["FO"[i % 2] for i in key]}).to_parquet(f"{root}/orders.parquet")
    own = list(range(1, customers + 1))
    pd.DataFrame({"c_custkey": own, "c_nationkey": [i % 5 for i in own], "c_acctbal": [100.0 + 37.5 * i for i in own]}).to_parquet(f"{root}/customer.parquet")
    lines = [k for k in key if k % 3 == 0 for _ in range(2)]
    pd.DataFrame(
        {"l_orderkey": lines, "l_returnflag": "R", "l_quantity": 45.0, "l_extendedprice": [20_000.0 + 13 * k for k in lines]}
    ).to_parquet(f"{root}/lineitem.parquet")
    return dict(zip(key, cust, strict=True))


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    return str(root), write_tables(root)


def test_interaction_of_age_and_power(spark, tables):
    root, customer_of = tables
    rows = all_queries()["interaction_age_power"](spark, root).collect()
    assert len(rows) > 50
    for r in rows:
        c = customer_of[r["policy_id"]]
        assert r["driv_age_x_veh_power"] == float((18 + c % 83) * (4 + c % 12))


def test_boosting_passes_read_blocks(spark):
    """A pass costs Spark a row per block; odd numbers fall into the bins that the column expression gives."""
    values = [None, float("nan"), -0.0, 0.0, 1.0, 2.5, -3.0, float("inf")] * 2500
    levels = ["a", "b", None, "c"] * 5000
    rows = spark.createDataFrame([(x, k, 1.0, 0.5) for x, k in zip(values, levels, strict=True)], "x double, k string, y double, w double").coalesce(2)
    binning = boost.Binning({"x": [-1.0, 0.0, 2.0]}, {"k": ["a", "b"]})
    direct = rows.select("x", "k", F.coalesce(binning.column("x"), F.lit(-1)).alias("bx"), F.coalesce(binning.column("k"), F.lit(-1)).alias("bk"))
    by_numpy = boost.binned(rows, binning, ["x", "k"])
    wanted = sorted(map(str, direct.distinct().collect()))
    got = sorted(str(r).replace("b_x", "bx").replace("b_k", "bk") for r in by_numpy.distinct().collect())
    assert got == wanted
    table, _, _ = boost.boost_table(rows, 8, numeric=("x",), categorical=("k",))
    assert table.count() < 20 and table.agg(F.sum("n")).first()[0] == len(values)


def test_codes_expand_to_the_terms(spark):
    spec = design.DesignSpec(
        splines={"driv_age": [18.0, 90.0]}, scaled={"bonus_malus": [60.0, 12.0]}, area_levels=["A", "B", "C"],
        one_hot={"region": ["R1", "R2", "R3"], "veh_gas": ["Diesel"]}, interactions=True,
    )
    rows = spark.range(300).selectExpr(
        "nullif(id, 7) + 10 AS driv_age", "50 + id % 40 AS bonus_malus", "substr('ABC', cast(1 + id % 3 AS int), 1) AS area",
        "concat('R', 1 + id % 7 % 3) AS region", "'Diesel' AS veh_gas", "nullif(id % 12, 50) AS veh_power",
    )
    names = [t.name for t in design.terms(spec)]
    both = design.encoded_columns(rows.where("driv_age IS NOT NULL"), spec, []).toPandas()
    codes = rows.where("driv_age IS NOT NULL").select(F.array(*[F.expr(c) for c in design.codes(spec)]).alias("x")).toPandas()
    made = design.expanded(spec, np.array(codes["x"].tolist()))
    assert made.shape[1] == 1 + len(names) and (made[:, 0] == 1).all()
    np.testing.assert_allclose(made[:, 1:], both[names].to_numpy(), atol=1e-12)


def test_stability_computes_each_split_once(spark, settings, tables, monkeypatch):
    """Every seed's gold table is written; nothing downstream computes it again."""
    root, _ = tables
    seen = []

    def fit(kind, train, val, own):
        seen.append(train._jdf.queryExecution().optimizedPlan().toString())
        return training.TrainedModel(kind, "", {}, {}, glm=FREQUENCY)

    monkeypatch.setattr(training, "fit_glm_model", fit)
    found = training.stability_runs(layers.silver_policies(spark, root), "frequency", settings, [1, 2]).collect()
    assert [r["seed"] for r in found] == [1, 2] and len(seen) == 2
    assert all("md5" not in plan for plan in seen)


def test_measures_are_not_stored(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(ordered, "stored", lambda df, label: kept.append(df.columns) or df)
    rows = spark.createDataFrame([(1.0, 1, 2.0), (1.0, 2, 3.0), (float("nan"), 3, 4.0), (None, 4, 1.0)], "x double, id long, w double")
    out = {r["id"]: r["c"] for r in ordered.prefix_sum(rows, "x", "id", {"c": F.col("w") * 2}).collect()}
    assert out == {4: 2.0, 1: 6.0, 2: 12.0, 3: 20.0}
    assert kept == [["x", "id", "w", "_all"]]


def test_duplicates_are_counted_where_rows_meet(spark):
    """Rows are exchanged once by their covariates; hot groups, nulls and zeros of both signs are counted exactly."""
    rows = [("hot", 0.0 if i % 2 else -0.0, i) for i in range(500)]
    rows += [(None, None, i) for i in range(40)] + [(f"c{i // 3}", float(i // 3), i) for i in range(600)] + [("once", float("nan"), 1)]
    df = spark.createDataFrame(rows, "k string, x double, id long")
    sizes = {"hot": 500, None: 40, "once": 1}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = cleaning.flag_duplicates(df, ["k", "x"], "id")
        assert "SortMergeJoin" not in flagged._jdf.queryExecution().executedPlan().toString()
        found = flagged.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(map(str, ((r["k"], r["x"], r["id"]) for r in found))) == sorted(map(str, rows))
    for r in found:
        assert r["n_covariate_duplicates"] == sizes.get(r["k"], 3) and r["is_duplicate_group"] == (r["k"] != "once")


def test_silver_and_quotes_follow_from_stored_rows(spark, tables):
    """Neither is written or joined a second time."""
    root, _ = tables
    assert layers.silver_policies(spark, root).count() > 0 and layers.quotes(spark, root).count() == 600
    labels = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in workspace._written[spark.sparkContext.applicationId]}
    assert "silver-joined" in labels and not labels & {"silver", "quotes"}


def test_boosting_rows_are_narrow_and_cached(spark, monkeypatch):
    """A bin takes one byte where it fits, passes read cached rows, and nothing stays cached."""
    rows = [(float(i % 300), "ab"[i % 2], float(i % 3), 1.0) for i in range(3000)]
    train = spark.createDataFrame(rows, "x double, k string, y double, w double")
    for bins, width in ((255, 1), (8, 1)):
        table, _, _ = boost.boost_table(train, bins, numeric=("x",), categorical=("k",))
        assert all(len(r["bins"]) == 2 * width * r["n"] for r in table.collect())
    wide = np.array([[-1, 0], [255, 3], [7, 254]], np.int16)
    narrow = np.array([[-1, 0], [254, 3], [7, 254]], np.int16)
    for bins in (wide, narrow):
        ((back, *_),) = boost._blocks(iter([boost._block(np.asfortranarray(bins), *np.ones((3, 3)))]), 2)
        assert (back == bins).all()
    levels, counted = [], boost.histograms
    monkeypatch.setattr(boost, "histograms", lambda rows, *a: levels.append(rows.storageLevel.useMemory) or counted(rows, *a))
    params = boost.BoostParams(trees=5, leaves=4, bins=8, increasing=(), store_every=2)
    model = boost.fit_boosted(None, params, numeric=("x",), categorical=("k",), table=(table, *boost.boost_table(train, 8, numeric=("x",), categorical=("k",))[1:]))
    assert len(model.trees) == 5 and levels and all(levels)
    assert not table.storageLevel.useMemory
