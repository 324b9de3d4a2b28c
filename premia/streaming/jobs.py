"""Structured Streaming jobs: request metrics, quote pricing and drift of arriving records.

Every job writes to a folder and keeps its progress in a checkpoint folder, so it resumes after a failure. Jobs that
revise results write each micro-batch to its own sub-folder: a repeated batch replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from premia.operators.drift import counts_in_bins
from premia.operators.quality import TableRules, with_reasons
from premia.operators.quotes import PricingAssets, price_quotes
from premia.settings import Settings
from premia.sources import commits

#: How late a row may be by default. Request rows that are later are not counted, quotes that are later go to quarantine;
#: a source that is later than that needs a longer delay, which costs state.
WATERMARK = "10 minutes"
BIN_COUNTS = "feature string, bin int, window_start timestamp, rows bigint"


def read_stream(spark: SparkSession, folder: str, schema, pattern: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def _bucket_columns(bounds) -> list[Column]:
    named = [(f"le_{b:g}", F.count_if(F.col("latency_ms") <= b)) for b in bounds]
    return [c.alias(n) for n, c in named]


def request_metrics(log: DataFrame, bounds, window: str = "1 hour", delay: str = WATERMARK) -> DataFrame:
    """Per window: requests, cumulative latency histogram, latency sum and count, mean prediction (0 without any).

    A stream leaves out rows that are more than ``delay`` behind the latest one.
    """
    source = log.withWatermark("ts", delay) if log.isStreaming else log
    return (
        source.groupBy(F.window("ts", window).alias("slot"))
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            *_bucket_columns(bounds),
            F.count("latency_ms").alias("le_inf"),
            F.sum("latency_ms").alias("latency_sum"),
            F.count("latency_ms").alias("latency_count"),
            F.coalesce(F.avg("prediction"), F.lit(0.0)).alias("prediction_mean"),
        )
        .select(F.col("slot.start").alias("window_start"), F.col("slot.end").alias("window_end"), "*")
        .drop("slot")
    )


def _per_batch(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def start_revising(result: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Update-mode sink: changed rows of every micro-batch go to ``path/batch=<id>``."""
    writer = result.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(_per_batch(path)).trigger(**(trigger or {"availableNow": True})).start()


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last revision of every key."""
    rows = spark.read.parquet(path)
    others = [c for c in rows.columns if c not in {*keys, "batch"}]
    last = F.max_by(F.struct(*others), F.col("batch").cast("bigint")).alias("r")
    return rows.groupBy(*keys).agg(last).select(*keys, "r.*")


def start_request_metrics(
    events: DataFrame, path: str, checkpoint: str, settings: Settings, delay: str = WATERMARK, **trigger
) -> StreamingQuery:
    metrics = request_metrics(events, settings.pricing.latency_buckets_ms, delay=delay)
    return start_revising(metrics, path, checkpoint, **trigger)


def start_pricing(
    quotes: DataFrame,
    rules: TableRules,
    assets: PricingAssets,
    path: str,
    checkpoint: str,
    settings: Settings,
    delay: str = WATERMARK,
    **trigger,
) -> StreamingQuery:
    """Prices arriving quotes (request_id, ts and the quote fields) once each. Every quote comes out once: in ``priced``,
    in ``quarantine`` with the rules it fails, or ``late`` where it is more than ``delay`` behind the latest quote of
    the batches before, or in ``repeated`` where its id came before within ``delay`` (or earlier in its batch).

    What has been seen is a table per micro-batch below ``path/seen``: ids within the delay, and the latest time. A
    batch reads that of the batch before and writes its own, so a repeated batch gives the same rows again; a quote
    without a time is late, one without an id is never a repetition.
    """
    spark = quotes.sparkSession
    seen_schema = "request_id " + quotes.schema["request_id"].dataType.simpleString() + ", ts timestamp"

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = _seen(spark, f"{path}/seen", batch_id - 1, seen_schema)
        latest = seen.agg(F.max("ts")).first()[0]
        patience = F.expr(f"INTERVAL {delay}")
        behind = F.col("ts").isNull() | (F.lit(False) if latest is None else F.col("ts") < F.lit(latest) - patience)
        rows = batch.withColumn("_row", F.monotonically_increasing_id()).withColumn("_late", behind).persist()
        try:
            known = seen.select("request_id").where("request_id IS NOT NULL").distinct().withColumn("_known", F.lit(True))
            timely = rows.where("NOT _late").join(known, "request_id", "left")
            first = timely.where("request_id IS NOT NULL").groupBy("request_id").agg(F.min("_row").alias("_first"))
            timely = timely.join(first, "request_id", "left")
            again = F.coalesce(F.col("_known"), F.lit(False)) | F.coalesce(F.col("_row") != F.col("_first"), F.lit(False))
            timely = timely.withColumn("_again", again).persist()
            fresh = with_reasons(timely.where("NOT _again").select(*batch.columns), rules)
            late = rows.where("_late").select(*batch.columns, F.lit("late").alias("_reason"))
            good = fresh.where("_reason = ''").drop("_reason")
            price_quotes(good, assets, settings, keep=["request_id"]).write.mode("overwrite").parquet(f"{path}/priced/batch={batch_id}")
            rejected = fresh.where("_reason <> ''").unionByName(late)
            rejected.write.mode("overwrite").parquet(f"{path}/quarantine/batch={batch_id}")
            timely.where("_again").select(*batch.columns).write.mode("overwrite").parquet(f"{path}/repeated/batch={batch_id}")
            now = seen.unionByName(rows.select("request_id", "ts"))
            newest = F.lit(now.agg(F.max("ts")).first()[0])
            now = now.where(F.col("ts") >= newest - patience).groupBy("request_id").agg(F.max("ts").alias("ts"))
            now.write.mode("overwrite").parquet(f"{path}/seen/batch={batch_id}")
            timely.unpersist()
        finally:
            rows.unpersist()
        commits.delete(spark, f"{path}/seen/batch={batch_id - 2}")

    writer = quotes.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start()


def _seen(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    folder = f"{path}/batch={batch_id}"
    return spark.read.schema(schema).parquet(folder) if commits.exists(spark, folder) else spark.createDataFrame([], schema)


def start_bin_counts(
    records: DataFrame, features: list[str], stored_bins: DataFrame, path: str, checkpoint: str, window: str | None = None, **trigger
) -> StreamingQuery:
    """Rows per (feature, bin of the stored reference, window), the state of the drift score. ``window`` is a duration
    over the column ``ts``; without one there is a single window, ``window_start`` null, and no ``ts`` is needed.

    A micro-batch is binned as it arrives and added to the state of the batch before, which is then deleted; so the
    state never has more than features x bins x windows rows. A repeated batch starts from the same state again. Late
    records count in their own window. ``bin_counts`` reads the last state that is complete.
    """
    spark = records.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        start = F.window("ts", window).start if window else F.lit(None).cast("timestamp")
        wide = batch.select(start.alias("window_start"), *[F.col(f).cast("double").alias(f) for f in features])
        long = wide.unpivot(["window_start"], features, "feature", "value").withColumn("rows", F.lit(1).cast("bigint"))
        fresh = counts_in_bins(stored_bins, long, "window_start").select("feature", F.col("bin").cast("int").alias("bin"), "window_start", "rows")
        before = f"{path}/batch={batch_id - 1}"
        if commits.exists(spark, f"{before}/_SUCCESS"):
            fresh = spark.read.schema(BIN_COUNTS).parquet(before).unionByName(fresh)
        state = fresh.groupBy("feature", "bin", "window_start").agg(F.sum("rows").alias("rows"))
        state.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        commits.delete(spark, f"{path}/batch={batch_id - 2}")

    writer = records.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start()


def bin_counts(spark: SparkSession, path: str) -> DataFrame:
    """The last complete state of ``start_bin_counts``; no rows before the first batch is done."""
    ids = sorted((int(n.split("=")[1]) for n in commits.names(spark, path) if n.startswith("batch=")), reverse=True)
    whole = next((i for i in ids if commits.exists(spark, f"{path}/batch={i}/_SUCCESS")), None)
    return spark.createDataFrame([], BIN_COUNTS) if whole is None else spark.read.schema(BIN_COUNTS).parquet(f"{path}/batch={whole}")
