import hashlib
import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from premia import workspace
from premia.operators import digest, drift, quality
from premia.plans import bronze, lineage, pricing, runs
from premia.sources import adapter, commits, sinks
from premia.sources.readers import read_table
from premia.streaming import jobs


def test_gold_files_follow_the_quotas(spark, job_folders):
    total = job_folders["silver"][0]
    assert sum(job_folders["gold"]["frequency"].values()) == total
    assert job_folders["gold"]["frequency"] == job_folders["gold"]["pure_premium"]
    severity = read_table(spark, f"{job_folders['root']}/gold/severity")
    assert severity.where("claim_nb <= 0").isEmpty()


def test_reading_one_split_prunes_the_others(spark, job_folders):
    rows = read_table(spark, f"{job_folders['root']}/gold/frequency").where("split = 'val'").select("y")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split#" in plan.split("PartitionFilters")[1][:80]
    assert "ReadSchema: struct<y:double>" in plan


def test_lineage_chain(spark, job_folders):
    table = lineage.read_lineage(spark, f"{job_folders['root']}/lineage")
    assert lineage.lineage_check(table).where("NOT linked").isEmpty()
    last = {r["layer"]: r for r in lineage.bundles(table).collect()}
    assert last["silver"]["upstream"] == last["bronze"]["bundle"]
    assert last["gold/severity"]["upstream"] == last["silver"]["bundle"]
    broken = table.withColumn("upstream", F.when(F.col("layer") == "silver", "x").otherwise(F.col("upstream")))
    assert [r["layer"] for r in lineage.lineage_check(broken).where("NOT linked").collect()] == ["silver"]
    with pytest.raises(FileNotFoundError):
        lineage.latest_bundle(spark, f"{job_folders['root']}/lineage", "platinum", required=True)


def test_digest_ignores_order_and_sees_changes(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 2.5)
    one, two = (digest.content_digest(d).first() for d in (df, df.repartition(7).orderBy(F.desc("id"))))
    assert one == two
    assert digest.content_digest(df.withColumn("v", F.when(F.col("id") == 3, 0.0).otherwise(F.col("v")))).first() != one
    assert digest.content_digest(df.unionByName(df.limit(1))).first() != one


def test_digests_of_parts_merge_to_that_of_the_whole(spark):
    df = spark.sql("SELECT id, IF(id % 3 = 0, NULL, repeat('x', id % 5)) AS t, array(id, NULL) AS a, id / 7 AS v FROM range(500)")
    parts = [df.where(f"id % 4 = {i}") for i in range(4)] + [df.where("id < 0"), df.limit(3)]
    states = [digest.digest_state(p) for p in parts]
    whole = digest.content_digest(df.unionByName(df.limit(3))).first()
    assert digest.finished(digest.merged(*states)).first() == whole
    assert digest.finished(digest.merged(digest.merged(*states[:2]), digest.merged(*states[2:]))).first() == whole
    assert digest.finished(digest.merged(*states[:-1])).first() != whole
    with pytest.raises(Exception, match="different columns"):
        digest.merged(states[0], digest.digest_state(df.select("id"))).collect()


def test_digest_tells_nulls_texts_and_columns_apart(spark):
    tables = ["SELECT NULL AS a, 'x' AS b", "SELECT 'x' AS a, NULL AS b", "SELECT 'null' AS a, 'x' AS b", "SELECT '' AS a, 'x' AS b", "SELECT 'x\",' AS a, '' AS b"]
    found = [digest.content_digest(spark.sql(t)).first()["content_digest"] for t in tables]
    assert len(set(found)) == len(tables)
    # By hand: the SHA-256 of one row's text in limbs.
    state = digest.digest_state(spark.sql("SELECT 'k' AS a, 7 AS b, CAST(NULL AS INT) AS c"), ["a", "b", "c"]).first()
    h = hashlib.sha256(b"k|7|~").hexdigest()
    assert state["limbs"] == [int(h[i : i + 8], 16) for i in range(0, 64, 8)] and (state["rows"], state["cols"]) == (1, 3)


def test_drift_state_is_bins_whatever_the_values(spark, settings, tmp_path):
    """Files arrive one by one and the job is started twice; the state equals counting all rows at once."""
    base = spark.sql("SELECT id AS k, CAST(id AS DOUBLE) AS v, timestamp_seconds(86400 * (id % 3)) AS ts FROM range(3000)")
    reference = workspace.stored(drift.reference_distribution(base, ["v", "k"], settings.monitoring), "reference")
    moved = base.withColumn("v", F.when(F.col("k") % 10 == 0, None).otherwise(F.col("v") * 1.7 + F.rand(3)))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (0, 1):
        moved.where(f"k % 2 = {part}").repartition(3).write.mode("append").parquet(source)
        stream = jobs.read_stream(spark, source, base.schema)
        writer = jobs.start_bin_counts(stream, ["v", "k"], reference, f"{out}/state", f"{out}/progress", window="1 day")
        writer.awaitTermination()
        state = jobs.bin_counts(spark, f"{out}/state")
        assert state.agg(F.sum("rows")).first()[0] == sum(moved.where(f"k % 2 <= {part}").agg(F.count("v"), F.count("k")).first())
        assert state.count() <= 2 * settings.monitoring.bins * 3
    live = {r["feature"]: r["psi"] for r in drift.psi_from_bins(reference, state, settings.monitoring).collect()}
    batch = {r["feature"]: r["psi"] for r in drift.psi_from_reference(reference, moved, ["v", "k"], settings.monitoring).collect()}
    assert live == pytest.approx(batch, abs=1e-12)
    days = state.groupBy("window_start").agg(F.sum("rows").alias("n")).collect()
    assert len(days) == 3
    assert jobs.bin_counts(spark, str(tmp_path / "nothing")).isEmpty()


LOG = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id bigint, ts string, event_type string, value double").selectExpr(
        "event_id", "cast(ts AS timestamp) AS ts", "cast(0 AS bigint) AS user_id", "event_type", "value", "'' AS props"
    )


def test_request_metrics_stream_equals_batch_and_resumes(spark, settings, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("events", "out", "progress"))
    first = [(i, f"2024-01-01 0{i % 3}:10:00", "purchase" if i % 4 == 0 else "view", float(i * 7)) for i in range(60)]
    late = [(100 + i, f"2024-01-01 0{2 + i % 2}:40:00", "view", float(i * 90)) for i in range(20)]
    for rows in (first, late):
        _events(spark, rows).write.mode("append").parquet(source)
        stream = adapter.request_log(jobs.read_stream(spark, source, LOG))
        jobs.start_request_metrics(stream, out, progress, settings).awaitTermination()
    found = jobs.latest_rows(spark, out, ["window_start"])
    batch = jobs.request_metrics(adapter.request_log(spark.read.parquet(source)), settings.pricing.latency_buckets_ms)
    names = ["window_start", "request_count", "le_5", "le_1000", "le_inf", "latency_sum", "prediction_mean"]
    assert found.select(*names).exceptAll(batch.select(*names)).count() == 0
    assert found.count() == batch.count() == 4


def test_priced_stream_takes_each_request_once(spark, settings, tmp_path):
    from premia.catalog.online import ASSETS

    row = (1, 0.5, "A", 6, 3, 40, 100, "B1", "Regular", 1000.0, "R11")
    ddl = (
        "policy_id bigint, exposure double, area string, veh_power bigint, veh_age bigint, driv_age bigint, "
        "bonus_malus bigint, veh_brand string, veh_gas string, density double, region string"
    )
    base = spark.createDataFrame([row], ddl).crossJoin(spark.range(6).withColumnRenamed("id", "request_id"))
    base = base.withColumns(
        {"ts": F.lit("2024-01-01 10:00:00").cast("timestamp"), "driv_age": F.when(F.col("request_id") == 5, 200).otherwise(40).cast("bigint")}
    )
    source, out = str(tmp_path / "quotes"), str(tmp_path / "out")
    base.unionByName(base.where("request_id < 2")).write.parquet(source)
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema)
    rules = quality.quote_rules(settings, ["R11"], ["B1"])
    jobs.start_pricing(stream, rules, ASSETS, out, f"{out}/progress", settings).awaitTermination()
    priced = spark.read.parquet(f"{out}/priced")
    assert sorted(r["request_id"] for r in priced.collect()) == [0, 1, 2, 3, 4]
    one = priced.first()
    assert one["currency"] == "EUR" and one["premium_technical"] > one["premium_pure"] > 0
    assert len(one["reason_codes"]) == 3
    rejected = spark.read.parquet(f"{out}/quarantine").collect()
    assert [(r["request_id"], r["_reason"]) for r in rejected] == [(5, "in_range(18, 100)")]


def test_every_quote_is_priced_once_or_set_aside_with_its_reason(spark, settings, tmp_path):
    from premia.catalog.online import ASSETS

    ddl = (
        "request_id bigint, ts timestamp, policy_id bigint, exposure double, area string, veh_power bigint, veh_age bigint, "
        "driv_age bigint, bonus_malus bigint, veh_brand string, veh_gas string, density double, region string"
    )

    def quote(request_id, ts, age=40):
        return (request_id, datetime.fromisoformat(ts) if ts else None, 1, 0.5, "A", 6, 3, age, 100, "B1", "Regular", 1000.0, "R11")

    day = "2024-01-0"
    batches = [
        [quote(1, day + "3 10:00"), quote(2, day + "3 10:01"), quote(2, day + "3 10:01"), quote(None, day + "3 10:00"), quote(None, day + "3 10:00")],
        # Two days late, without a time, a repetition from the batch before, an invalid one, a new one.
        [quote(3, day + "1 10:00"), quote(4, None), quote(1, day + "3 10:02"), quote(5, day + "3 10:03", 200), quote(6, day + "3 10:30")],
        # Out of the delay the same id is late, not repeated; within it a timely one is priced.
        [quote(1, day + "3 10:00"), quote(7, day + "3 10:25")],
    ]
    source, out = str(tmp_path / "quotes"), str(tmp_path / "out")
    for rows in batches:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.read_stream(spark, source, ddl)
        jobs.start_pricing(stream, quality.quote_rules(settings, ["R11"], ["B1"]), ASSETS, out, f"{out}/progress", settings).awaitTermination()
    ids = lambda name: sorted((r["request_id"] for r in spark.read.parquet(f"{out}/{name}").collect()), key=str)
    assert ids("priced") == [1, 2, 6, 7, None, None] and ids("repeated") == [1, 2]
    reasons = sorted((r["request_id"], r["_reason"]) for r in spark.read.parquet(f"{out}/quarantine").collect())
    assert reasons == [(1, "late"), (3, "late"), (4, "late"), (5, "in_range(18, 100)")]
    assert len(ids("priced")) + len(ids("repeated")) + len(reasons) == sum(map(len, batches))


def test_writers_that_come_at_once_get_versions_of_their_own(spark, tmp_path):
    path = str(tmp_path)
    with ThreadPoolExecutor(4) as pool:
        given = list(pool.map(lambda i: runs.register_model(spark, path, "motor/x", f"r{i}", json.dumps({"no": i})), range(40)))
    assert sorted(given) == list(range(1, 41))
    models = runs.read_models(spark, path).collect()
    assert sorted(int(m["version"]) for m in models) == list(range(1, 41))
    assert {m["run_id"]: json.loads(m["model"])["no"] for m in models} == {f"r{i}": i for i in range(40)}
    assert runs.latest_version(runs.read_models(spark, path), "motor/x") == 40
    assert not [f for f in (tmp_path / "models").rglob("*draft*") if not f.name.startswith(".")]


def test_a_failed_write_leaves_the_layer_before(spark, tmp_path):
    path = str(tmp_path / "layer")
    sinks.write_table(spark.range(5), path)
    broken = spark.range(8).selectExpr("IF(id = 7, cast(raise_error('disk lost') AS bigint), id) AS id")
    with pytest.raises(Exception, match="disk lost"):
        sinks.write_table(broken, path)
    assert read_table(spark, path).count() == 5
    for n in (6, 7, 8):
        sinks.write_table(spark.range(n), path)
    assert read_table(spark, path).count() == 8
    assert len(list((tmp_path / "layer").glob("v-*/_SUCCESS"))) == 2


def test_published_files_are_whole_and_not_replaced(spark, tmp_path):
    path = f"{tmp_path}/folder/a.json"
    assert commits.publish(spark, path, "é 1") and not commits.publish(spark, path, "2")
    assert commits.read_text(spark, path) == "é 1" and commits.names(spark, f"{tmp_path}/folder") == ["a.json"]
    assert commits.latest(spark, f"{tmp_path}/nothing") is None


def test_bronze_tables_are_validated_and_counted(spark, settings, job_folders, tmp_path):
    counts = {r["table_name"]: r["rows"] for r in bronze.validate_bronze(spark, f"{job_folders['root']}/bronze", settings).collect()}
    assert counts == {"policies": len(job_folders["policies"]), "claims": len(job_folders["claims"])}
    sinks.write_table(read_table(spark, f"{job_folders['root']}/bronze/claims"), f"{tmp_path}/claims")
    bad = read_table(spark, f"{job_folders['root']}/bronze/policies").withColumn("Exposure", F.lit(-1.0))
    sinks.write_table(bad, f"{tmp_path}/policies")
    with pytest.raises(Exception, match="Exposure"):
        bronze.validate_bronze(spark, str(tmp_path), settings).collect()


def test_pricing_assets_carry_models_load_and_reference(spark, settings, job_folders, tmp_path):
    from premia.catalog.online import FREQUENCY, SEVERITY

    path, root, p = str(tmp_path), job_folders["root"], settings.pricing
    for name, model in ((p.frequency_model, FREQUENCY), (p.severity_model, SEVERITY)):
        runs.run_log_append(spark, path, name, {}, {"m": 1.0}, {"gold_content_digest": "h"}, model.to_json(), register_as=name)
    assets = pricing.load_pricing_assets(spark, path, f"{root}/silver", settings, f"{root}/gold")
    assert assets.frequency.to_json() == FREQUENCY.to_json() and assets.severity.to_json() == SEVERITY.to_json()
    assert (assets.frequency_version, assets.severity_version, assets.data_hash) == (1, 1, "h") and assets.trained_at
    assert assets.reference.count() > 0
    rows = read_table(spark, f"{root}/silver/policies").where("veh_age < 5")
    drifted = {r["feature"]: r["psi"] for r in pricing.quote_drift(rows, assets.reference, settings).collect()}
    assert drifted["veh_age"] > drifted["driv_age"]


class FakeSession:
    """Stands in for a session whose master is a cluster."""

    def __init__(self, master, folder=None):
        self.conf = self
        self.sparkContext = self
        self.master, self.folder, self.applicationId = master, folder, f"app-{master}-{folder}"

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return None


def test_scratch_folder_comes_from_the_session():
    assert workspace.shared_root(FakeSession("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        workspace.shared_root(FakeSession("yarn"))
    assert workspace.shared_root(FakeSession("local[2]"))


def test_scratch_tables_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "_written", {})
    monkeypatch.setattr(workspace, "shared_root", lambda _: str(tmp_path))
    assert workspace.stored(spark.range(5), "numbers").count() == 5
    assert len(list(tmp_path.iterdir())) == 1
    assert workspace.clear_scratch(spark) == 1
    assert not list(tmp_path.iterdir())
