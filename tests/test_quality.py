import pytest
from pyspark.sql import functions as F

from premia.operators import profile, quality
from premia.operators.skew import hot_keys, in_place, salted_lookup
from premia.sources.readers import read_table


def _bronze(spark, job_folders):
    return read_table(spark, f"{job_folders['root']}/bronze/policies")


def test_strict_passes_and_raises(spark, settings, job_folders):
    good = _bronze(spark, job_folders)
    rules = quality.bronze_policy_rules(settings)
    assert quality.validate_strict(good, rules) is good
    with pytest.raises(quality.ValidationError, match="DrivAge"):
        quality.validate_strict(good.withColumn("DrivAge", F.lit(200).cast("bigint")), rules)
    with pytest.raises(quality.ValidationError, match="field_uniqueness"):
        quality.validate_strict(good.unionByName(good.limit(1)), rules)


def test_layout_errors_are_not_swallowed(spark, settings, job_folders):
    rules = quality.bronze_policy_rules(settings)
    with pytest.raises(quality.ValidationError, match="missing"):
        quality.validate_lenient(_bronze(spark, job_folders).drop("Area"), rules)
    with pytest.raises(quality.ValidationError, match="Density"):
        quality.validate_lenient(_bronze(spark, job_folders).withColumn("Density", F.lit("x")), rules)


def test_lenient_reasons_are_sorted_and_distinct(spark, settings, job_folders):
    rows = _bronze(spark, job_folders)
    first = rows.orderBy("IDpol").limit(1).withColumns(
        {"IDpol": F.lit(-1).cast("bigint"), "DrivAge": F.lit(5).cast("bigint"), "Exposure": F.lit(0.0), "Region": F.lit(None).cast("string")}
    )
    valid, bad = quality.validate_lenient(rows.unionByName(first), quality.bronze_policy_rules(settings))
    assert valid.count() == rows.count()
    assert [r["_reason"] for r in bad.collect()] == ["greater_than(0), in_range(18, 100), not_nullable"]


def test_every_row_of_a_duplicate_group_is_reported(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")] + [(9, str(i)) for i in range(50)], "k bigint, v string")
    found = quality.rows_with_duplicate_key(df, "k", ["v"])
    assert found.count() == 52 and found.where("k = 2").count() == 0


def test_salted_lookup_equals_a_plain_join_under_skew(spark):
    facts = spark.range(5000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 1, F.lit(None)).otherwise(F.col("id") % 100).alias("k")
    )
    lookup = spark.createDataFrame([(None, -1)] + [(i, i * i) for i in range(90)], "k bigint, sq bigint")
    for how in ("left", "inner"):
        salted = salted_lookup(facts, lookup, ["k"], ["id"], how)
        other = lookup.withColumnRenamed("k", "k2")
        plain = facts.join(other, facts["k"].eqNullSafe(other["k2"]), how).drop("k2")
        assert salted.columns == ["id", "k", "sq"]
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_salting_spreads_the_hot_key(spark):
    facts = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    lookup = spark.range(9000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    plan = salted_lookup(facts, lookup, ["k"], ["id"], salts=16)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_hot_keys_from_the_counts_of_the_lookup_give_the_same_join(spark):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 200).alias("k"))
    lookup = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    counted = salted_lookup(facts, lookup, ["k"], ["id"])
    given = salted_lookup(facts, lookup, ["k"], ["id"], rows="n")
    assert counted.exceptAll(given).count() == 0 and given.count() == 3000


def test_hot_keys_of_equal_counts_are_the_same_in_every_evaluation(spark):
    facts = spark.range(4000).select((F.col("id") % 1000).alias("k"))
    for df in (facts, facts.repartition(13), facts.repartition(3, "k")):
        assert sorted(r["k"] for r in hot_keys(df, ["k"], 50).collect()) == list(range(50))


def test_salts_do_not_depend_on_the_order_a_shuffle_delivers(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(500).withColumn("k", F.col("id") % 5).write.parquet(path)
    scan = spark.read.parquet(path).where("k < 4").selectExpr("id", "k", "id + 1 AS next")
    assert in_place(scan) is scan
    for moved in (scan.repartition(4), scan.groupBy("k").count(), scan.distinct(), scan.join(scan.select("id"), "id"), scan.unionByName(scan)):
        kept = in_place(moved)
        assert kept is not moved and kept.exceptAll(moved).count() == 0 and kept.count() == moved.count()


def test_profile_covers_all_columns(spark, job_folders):
    table = {r["column"]: r for r in read_table(spark, f"{job_folders['root']}/bronze/profile_policies").collect()}
    rows = job_folders["policies"]
    assert set(table) == set(rows.columns) | {"_ingested_at", "_source_hash"}
    assert table["IDpol"]["n_unique"] == len(rows) and table["IDpol"]["cardinality_ratio"] == 1.0
    assert table["Density"]["max"] == rows["Density"].max() and table["Area"]["min"] is None
    assert table["Area"]["top_value_share"] == rows["Area"].value_counts().iloc[0] / len(rows)


def test_levels_list_seen_and_configured_values(spark, settings, job_folders):
    levels = read_table(spark, f"{job_folders['root']}/bronze/levels")
    assert profile.levels_of(levels, "region") == ["R11", "R24", "R93"]
    assert profile.levels_of(levels, "area") == list("ABCDEF")


def test_quote_rules(spark, settings):
    rules = quality.quote_rules(settings, ["R11"], ["B1"])
    base = (1, 0.5, "A", 6, 3, 40, 100, "B1", "Regular", 1000.0, "R11")
    ddl = (
        "policy_id bigint, exposure double, area string, veh_power bigint, veh_age bigint, driv_age bigint, "
        "bonus_malus bigint, veh_brand string, veh_gas string, density double, region string"
    )
    bad_age, bad_region = list(base), list(base)
    bad_age[5], bad_region[10], bad_region[1] = 200, "R99", 1.5
    judged = quality.with_reasons(spark.createDataFrame([base, tuple(bad_age), tuple(bad_region)], ddl), rules)
    assert [r["_reason"] for r in judged.collect()] == ["", "in_range(18, 100)", "isin(['R11'])"]


def test_claims_only(spark):
    df = spark.createDataFrame([(1,), (0,)], "claim_nb bigint")
    with pytest.raises(ValueError, match="claim_nb"):
        quality.assert_claims_only(df)
    quality.assert_claims_only(quality.claims_only(df))


def test_a_factor_with_too_many_levels_is_an_error(spark):
    levels = spark.range(profile.MAX_RULE_LEVELS + 1).select(F.lit("region").alias("feature"), F.format_string("R%05d", "id").alias("level"))
    kept = levels.where("level <> 'R00000'")
    assert profile.levels_of(kept.unionByName(kept.limit(3)), "region") == [f"R{i:05d}" for i in range(1, profile.MAX_RULE_LEVELS + 1)]
    with pytest.raises(ValueError, match="region"):
        profile.levels_of(levels, "region")
