"""File-stream jobs fed from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hammerprice.learning.estimators import least_squares
from hammerprice.learning.preparation import regression_pipeline
from hammerprice.queries.frame import table
from hammerprice.queries.records import EVENT_RECORD, EVENT_RECORD_SQL, event_records
from hammerprice.queries.registry import query
from hammerprice.session import scratch_path
from hammerprice.sources.snapshots import land_snapshot, snapshot_folder
from hammerprice.streaming.arrivals import on_new_snapshots
from hammerprice.streaming.scoring import score_stream


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus AS status, 1 AS batch FROM orders
"""
)
def stream_snapshots(spark, sf_dir):
    """Snapshots land, the stream notices, the job rebuilds its table from the newest complete one of each source."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string"), F.col("o_orderstatus").alias("status"))
    root, output = scratch_path(spark, "landing"), scratch_path(spark, "current")
    checkpoint = scratch_path(spark, "arrivals")

    def rebuild(current, batch_id):
        current.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    finished = F.col("status") == "F"
    land_snapshot(orders.where(finished), root, "finished", "2024-01-01")
    land_snapshot(orders.where(F.col("status") == "P"), root, "open", "2024-01-01")
    on_new_snapshots(spark, root, rebuild, checkpoint).awaitTermination()
    land_snapshot(orders.where(~finished), root, "open", "2024-01-08")
    unfinished = orders.limit(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False)
    unfinished.options(header=True).csv(snapshot_folder(root, "finished", "2024-02-01"))
    on_new_snapshots(spark, root, rebuild, checkpoint).awaitTermination()
    return spark.read.parquet(f"{output}/batch=1")


@query(
    f"""
WITH {EVENT_RECORD_SQL},
m AS (SELECT regr_slope(value, user_id) AS b, regr_intercept(value, user_id) AS a FROM events)
SELECT raw, k, round(a + b * k, 6) AS prediction,
       CASE WHEN k IS NULL OR v IS NULL OR name IS NULL THEN 'rejected' ELSE 'scored' END AS outcome
FROM (SELECT event_id, raw FROM raw) JOIN fields USING (event_id), m
WHERE k IS NOT NULL AND v IS NOT NULL AND name IS NOT NULL
UNION ALL
SELECT raw, NULL, NULL, 'rejected' FROM (SELECT event_id, raw FROM raw) JOIN fields USING (event_id)
WHERE k IS NULL OR v IS NULL OR name IS NULL
"""
)
def stream_scores(spark, sf_dir):
    """Every event as a JSON record through the scoring stream; bad ones are set aside."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), F.col("value").alias("v"))
    model = regression_pipeline(least_squares("v"), ["k"], []).fit(events)
    inbox, output = scratch_path(spark, "inbox"), scratch_path(spark, "scores")
    event_records(spark, sf_dir).select(F.col("raw").alias("value")).write.text(inbox)
    score_stream(spark, inbox, model, output, scratch_path(spark, "scoring"), EVENT_RECORD).awaitTermination()
    scored = spark.read.parquet(f"{output}/scored").select(
        F.col("value").alias("raw"), "k", F.round("prediction", 6).alias("prediction"), F.lit("scored").alias("outcome")
    )
    aside = spark.read.parquet(f"{output}/rejected").select(F.col("value").alias("raw"), F.lit("rejected").alias("outcome"))
    return scored.unionByName(aside, allowMissingColumns=True)
