import numpy as np
import pytest
from pyspark.sql import functions as F

from premia.operators import cleaning, quality
from premia.plans import silver
from premia.settings import Cleaning
from premia.sources.readers import read_table
from tests.conftest import make_portfolio

POLICY = "IDpol bigint, ClaimNb bigint, Exposure double"


def test_silver_and_quarantine_together_are_the_bronze_rows(job_folders):
    kept, rejected = job_folders["silver"]
    assert rejected == 1
    assert kept + rejected == len(job_folders["policies"])


def test_every_step_has_a_statistic(spark, job_folders):
    stats = read_table(spark, f"{job_folders['root']}/silver/clean_stats").orderBy("rank").collect()
    assert [r["step"] for r in stats] == [
        "cap_exposure", "cap_claim_nb", "flag_duplicates", "aggregate_severity", "cap_large_losses",
        "join_frequency_severity", "rename_snake_case", "assert_levels",
    ]
    exposure = job_folders["policies"]["Exposure"]
    assert stats[0]["rows_affected"] == int((exposure > 1).sum())
    assert all(r["rows_affected"] >= 0 for r in stats)


def test_caps_are_idempotent_and_leave_null_alone(spark):
    df = spark.createDataFrame([(1, 7, 1.2), (2, 0, 0.4), (3, None, None)], POLICY)
    once = cleaning.cap_claim_nb(cleaning.cap_exposure(df, 1.0), 4)
    twice = cleaning.cap_claim_nb(cleaning.cap_exposure(once, 1.0), 4)
    rows = sorted(tuple(r) for r in once.collect())
    assert rows == sorted(tuple(r) for r in twice.collect()) == [(1, 4, 1.0), (2, 0, 0.4), (3, None, None)]


def test_zero_fill_only_without_claims(spark, settings):
    policies = spark.createDataFrame([(1, 0, 1.0), (2, 1, 1.0), (3, 0, 1.0), (4, 2, 1.0)], POLICY)
    claims = spark.createDataFrame([(3, 10.0), (4, 5.0)], "IDpol bigint, ClaimAmount double")
    severity = cleaning.severity_per_policy(claims, settings.cleaning)
    rows = {r["IDpol"]: r for r in cleaning.join_frequency_severity(policies, severity).collect()}
    assert rows[1]["total_claim_amount"] == 0.0 and rows[2]["total_claim_amount"] is None
    assert rows[3]["total_claim_amount"] == 10.0 and rows[3]["claim_count_mismatch"]
    assert rows[4]["n_severity_rows"] == 1 and rows[4]["claim_count_mismatch"]
    assert not rows[2]["has_severity_record"]


def test_quantile_cap_equals_numpy(spark):
    _, claims = make_portfolio(3000, seed=5)
    found = cleaning.large_loss_cap(spark.createDataFrame(claims), Cleaning(large_loss_method="quantile"))
    assert found == pytest.approx(np.quantile(claims["ClaimAmount"], 0.995), rel=1e-14)


def test_unknown_cap_method_raises(spark):
    with pytest.raises(ValueError, match="method"):
        cleaning.large_loss_cap(spark.range(1), Cleaning(large_loss_method="median"))


def test_duplicate_groups_with_nulls_and_a_hot_group(spark):
    """A third of the rows share one covariate group; null covariates compare equal."""
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 10 == 1 else f"g{i % 50}")) for i in range(3000)]
    df = spark.createDataFrame(rows, "IDpol bigint, c string")
    found = {r["IDpol"]: r["n_covariate_duplicates"] for r in cleaning.flag_duplicates(df, ["c"]).collect()}
    sizes: dict = {}
    for _, c in rows:
        sizes[c] = sizes.get(c, 0) + 1
    assert found == {i: sizes[c] for i, c in rows}


def test_unseen_level_raises(spark, settings):
    df = spark.createDataFrame([("Z", "Regular", "R1", "B1")], "area string, veh_gas string, region string, veh_brand string")
    known = [("area", "A"), ("veh_gas", "Regular"), ("region", "R1"), ("veh_brand", "B1")]
    levels = spark.createDataFrame(known, "feature string, level string")
    with pytest.raises(ValueError, match="area"):
        quality.assert_levels(df, levels)


def test_large_loss_load_counts_quarantined_rows(spark):
    df = spark.createDataFrame([(1.0, 10.0), (1.0, None), (2.0, 2.0)], "exposure double, excess_claim_amount double")
    assert cleaning.large_loss_load(df).first()[0] == 3.0


def test_joined_policies_keep_the_uncapped_values(spark, settings):
    policies, claims = make_portfolio(200, seed=3)
    typed = spark.createDataFrame(policies).withColumns({"IDpol": F.col("IDpol").cast("bigint"), "ClaimNb": F.col("ClaimNb").cast("bigint")})
    rows = silver.joined_policies(typed, spark.createDataFrame(claims), settings)
    assert rows.where("_exposure > 1").count() == int((policies["Exposure"] > 1).sum())
    assert rows.where("Exposure > 1").count() == 0
