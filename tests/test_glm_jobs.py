"""Jobs that a single GLM fit takes."""

from premia.operators import design, glm


def test_a_penalised_tweedie_fit_takes_few_jobs(spark):
    """One pass over the cells per Newton step, whatever the penalty."""
    rows = [(f"B{i % 3}", float(i % 5 == 0) * (10.0 + i % 7), 0.5 + (i % 4) / 4) for i in range(300)]
    cells = spark.createDataFrame(rows, "veh_brand string, y double, w double")
    spark.sparkContext.setJobGroup("one-fit", "one fit")
    try:
        model = glm.fit_glm(cells, design.DesignSpec(one_hot={"veh_brand": ["B0", "B1", "B2"]}), "tweedie", 0.5, 1.5)
    finally:
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("one-fit")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.coefficients) == 2 and len(jobs) < 30
