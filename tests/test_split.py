import math

import pytest
from pyspark.sql import functions as F

from premia.operators import evaluate
from premia.operators.features import kfold_assign
from premia.operators.split import assert_no_leakage, grouped_split
from premia.settings import Splitting


def quotas(n):
    test = math.ceil(0.2 * n)
    return {"test": test, "val": math.ceil(0.25 * (n - test)), "train": n - test - math.ceil(0.25 * (n - test))}


@pytest.fixture(scope="module")
def policies(spark):
    return spark.range(1, 1238).select(F.col("id").alias("policy_id"), (F.col("id") % 7 == 0).cast("bigint").alias("claim_nb"))


def test_quotas_are_exact_in_both_strata(spark, policies):
    rows = grouped_split(policies, Splitting())
    for condition in ("claim_nb > 0", "claim_nb = 0"):
        part = rows.where(condition)
        found = {r["split"]: r["n"] for r in evaluate.split_counts(part).collect()}
        assert found == quotas(part.count())


def test_claim_rates_agree(policies):
    rates = [r["claim_rate"] for r in evaluate.claim_rate_by_split(grouped_split(policies, Splitting())).collect()]
    assert max(rates) - min(rates) < 0.1


def test_labels_do_not_depend_on_layout_but_on_the_seed(policies):
    one = grouped_split(policies, Splitting()).select("policy_id", "split")
    two = grouped_split(policies.repartition(13), Splitting()).select("policy_id", "split")
    other = grouped_split(policies, Splitting(seed=43)).select("policy_id", "split")
    assert one.exceptAll(two).count() == 0
    assert one.exceptAll(other).count() > 100


def test_rows_of_an_id_stay_together(spark, policies):
    repeated = policies.unionByName(policies.where("policy_id % 5 = 0"))
    rows = grouped_split(repeated, Splitting())
    assert_no_leakage(rows)
    distinct = {r["split"]: r["n"] for r in evaluate.split_counts(rows.where("claim_nb > 0").dropDuplicates(["policy_id"])).collect()}
    assert distinct == quotas(policies.where("claim_nb > 0").count())


def test_severity_rows_keep_their_label(policies):
    whole = grouped_split(policies, Splitting()).where("claim_nb > 0").select("policy_id", "split")
    alone = grouped_split(policies.where("claim_nb > 0"), Splitting()).select("policy_id", "split")
    assert whole.exceptAll(alone).count() == 0


def test_leakage_is_detected(policies):
    rows = grouped_split(policies, Splitting())
    spoiled = rows.unionByName(rows.where("policy_id = 5").withColumn("split", F.lit("extra")))
    with pytest.raises(ValueError, match=r"\[5\]"):
        assert_no_leakage(spoiled)


def test_folds_cover_all_ids(policies):
    sizes = [r["count"] for r in kfold_assign(policies, 5).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 180
