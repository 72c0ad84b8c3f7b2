"""Files in and out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hammerprice.functions.parsing import json_text, to_double
from hammerprice.operators.combine import union_all
from hammerprice.operators.metrics import regression_report
from hammerprice.operators.splits import label_splits, year_rules
from hammerprice.queries.frame import rounded, table
from hammerprice.queries.registry import query
from hammerprice.session import scratch_path
from hammerprice.sources.csv_files import read_bad_records, read_processed_csv, read_raw_csv, scan_raw_csv, write_csv
from hammerprice.sources.metric_log import log_metrics, read_metrics
from hammerprice.sources.snapshots import land_snapshot, read_latest, snapshot_folder
from hammerprice.sources.tables import read_split, write_splits


def _order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.col("o_totalprice").cast("string"),
        "o_orderpriority",
    )


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m') AS month,
       o_totalprice, CASE WHEN year(o_orderdate) < 1999 THEN o_orderpriority END AS o_orderpriority
FROM orders
"""
)
def csv_union(spark, sf_dir):
    """CSV files with three different headers, one of them a column short, united by name."""
    texts = _order_texts(spark, sf_dir)
    year = F.left("month", F.lit(4))
    root = scratch_path(spark, "csv-union")
    write_csv(texts.where(year < "1997"), f"{root}/first")
    write_csv(texts.where((year >= "1997") & (year < "1999")).select(*reversed(texts.columns)), f"{root}/second")
    write_csv(texts.where(year >= "1999").drop("o_orderpriority"), f"{root}/third")
    return read_raw_csv(spark, root).withColumn("o_totalprice", to_double(F.col("o_totalprice")))


_NOTES_SQL = """
SELECT c_custkey, c_name || chr(10) || 'says "' || c_mktsegment || '", twice' || chr(13) || chr(10) || '"' AS note,
       nullif(c_mktsegment, 'BUILDING') AS segment
FROM customer
"""


def _notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.concat("c_name", F.lit('\nsays "'), "c_mktsegment", F.lit('", twice\r\n"'))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", note.alias("note"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )


@query(_NOTES_SQL)
def csv_newlines(spark, sf_dir):
    """Texts with line breaks and quotes, written as CSV and read back with a schema."""
    path = scratch_path(spark, "csv-newlines")
    notes = _notes(spark, sf_dir)
    write_csv(notes, path)
    return read_processed_csv(spark, path, notes.schema)


@query(
    """
SELECT 'record' AS kind, CAST(s_suppkey AS VARCHAR) AS text FROM supplier WHERE s_suppkey % 7 <> 3
UNION ALL
SELECT 'surplus fields', s_suppkey || ',' || s_name || ',one too many' FROM supplier WHERE s_suppkey % 7 = 3
"""
)
def csv_surplus_fields(spark, sf_dir):
    """Records with a field too many are set aside as they stand, those with one too few are kept."""
    path = scratch_path(spark, "csv-surplus")
    key, name = F.col("s_suppkey").cast("string"), F.col("s_name")
    line = (
        F.when(F.col("s_suppkey") % 7 == 3, F.concat_ws(",", key, name, F.lit("one too many")))
        .when(F.col("s_suppkey") % 7 == 4, key)
        .otherwise(F.concat_ws(",", key, name))
    )
    lines = table(spark, sf_dir, "supplier").select(line.alias("s_suppkey,s_name"))
    # One column whose name is the header of every file, its lines as they stand.
    as_is = {"header": True, "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.write.options(**as_is).csv(path)
    kept = read_raw_csv(spark, path, bad_records="aside").select(F.lit("record").alias("kind"), F.col("s_suppkey").alias("text"))
    return kept.unionAll(read_bad_records(spark, path).select("reason", "record"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_name_filter(spark, sf_dir):
    """Only the files whose name contains ".csv"; the folder also holds JSON files."""
    root = scratch_path(spark, "csv-filter")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    write_csv(customers, root)
    customers.write.mode("append").json(root)
    scanned = union_all(scan_raw_csv(spark, root))
    return scanned.select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_acctbal").cast("double"))


@query("SELECT s_suppkey, s_acctbal FROM supplier")
def csv_projected(spark, sf_dir):
    """A typed CSV, projected to a configured column list."""
    path = scratch_path(spark, "csv-projected")
    suppliers = table(spark, sf_dir, "supplier")
    write_csv(suppliers, path)
    return read_processed_csv(spark, path, suppliers.schema, ["s_suppkey", "s_acctbal"])


@query(
    """
SELECT CASE WHEN year(o_orderdate) <= 1998 THEN 'train' WHEN year(o_orderdate) = 1999 THEN 'test'
            ELSE 'deploy' END AS split,
       count(*) AS orders, round(sum(o_totalprice), 2) AS revenue
FROM orders GROUP BY 1
"""
)
def parquet_by_split(spark, sf_dir):
    """One Parquet folder per split, each read back alone."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    path = scratch_path(spark, "by-split")
    write_splits(label_splits(orders, year_rules("o_orderdate", 1995, 1998, 1999)), path)
    schema = orders.schema
    parts = [
        read_split(spark, path, name, schema, columns=["o_totalprice"]).withColumn("split", F.lit(name))
        for name in ("train", "test", "deploy")
    ]
    totals = union_all(parts).groupBy("split").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("revenue")
    )
    return rounded(totals, 2, "revenue")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def snapshot_latest(spark, sf_dir):
    """Two sources; of one that landed more than once the newest complete snapshot counts."""
    texts = _order_texts(spark, sf_dir)
    early = F.left("month", F.lit(4)) < "1998"
    root = scratch_path(spark, "snapshots")
    land_snapshot(texts.where(early & (F.col("o_orderpriority") != "1-URGENT")), root, "early", "2024-01-01")
    land_snapshot(texts.where(early), root, "early", "2024-01-08")
    land_snapshot(texts.where(~early).select(*reversed(texts.columns)), root, "late", "2024-01-01")
    unfinished = texts.where(early).limit(1)  # newer, but its writer has not closed it
    unfinished.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).options(header=True).csv(
        snapshot_folder(root, "early", "2024-02-01")
    )
    return read_latest(spark, root).select("o_orderkey", "month")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", json_text(F.col("props"), "$.k").alias("k"))


@query(
    """
WITH s AS (
  SELECT l_returnflag AS run_id, avg(abs(l_extendedprice - l_quantity * 1000)) AS mae,
         sqrt(avg(pow(l_extendedprice - l_quantity * 1000, 2))) AS rmse
  FROM lineitem GROUP BY 1
)
SELECT run_id, 'mean_absolute_error' AS metric, round(mae, 3) AS value, 'quantity' AS model FROM s
UNION ALL SELECT run_id, 'root_mean_squared_error', round(rmse, 3), 'quantity' FROM s
"""
)
def metric_log(spark, sf_dir):
    """Scores of three runs, appended to the metric log and read back."""
    lines = table(spark, sf_dir, "lineitem").withColumn("guess", F.col("l_quantity") * 1000)
    scores = regression_report(lines, "l_extendedprice", "guess", ["l_returnflag"])
    path = scratch_path(spark, "metric-log")
    for row in scores.collect():  # one row per run
        kept = {name: row[name] for name in ("mean_absolute_error", "root_mean_squared_error")}
        log_metrics(spark, path, "guess", row["l_returnflag"], kept, {"model": "quantity"})
    return read_metrics(spark, path).select("run_id", "metric", "value", F.col("params")["model"].alias("model"))
