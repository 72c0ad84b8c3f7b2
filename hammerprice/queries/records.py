"""JSON records: validation and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hammerprice.operators.contracts import validate_records
from hammerprice.queries.frame import table
from hammerprice.queries.registry import query
from hammerprice.session import scratch_path
from hammerprice.sources.tables import load_config, records

EVENT_RECORD = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("v", T.DoubleType()),
        T.StructField("name", T.StringType()),
    ]
)


def event_records(spark, sf_dir):
    """One JSON text per event; some have a fraction, a text or nothing where it does not belong."""
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    k = F.when(kind == "error", F.lit('"x"')).when(kind == "click", F.concat(user, F.lit(".5"))).otherwise(user)
    v = F.when(F.col("user_id") % 7 == 0, F.lit("null")).otherwise(F.col("value").cast("string"))
    name = F.when(F.col("user_id") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(', "name": "'), kind, F.lit('"')))
    text = F.concat(F.lit('{"k": '), k, F.lit(', "v": '), v, name, F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", text.alias("raw"))


EVENT_RECORD_SQL = """
raw AS (
  SELECT event_id, '{"k": ' || CASE event_type WHEN 'error' THEN '"x"' WHEN 'click' THEN user_id || '.5'
                                    ELSE CAST(user_id AS VARCHAR) END
         || ', "v": ' || CASE WHEN user_id % 7 = 0 THEN 'null' ELSE CAST(value AS VARCHAR) END
         || CASE WHEN user_id % 5 = 0 THEN '' ELSE ', "name": "' || event_type || '"' END || '}' AS raw
  FROM events
),
doc AS (SELECT event_id, raw::JSON AS j FROM raw),
fields AS (
  SELECT event_id,
         CASE WHEN json_type(j, '$.k') IN ('BIGINT', 'UBIGINT') THEN CAST(json_extract(j, '$.k') AS BIGINT) END AS k,
         CASE WHEN json_type(j, '$.v') IN ('BIGINT', 'UBIGINT', 'DOUBLE')
              THEN CAST(json_extract(j, '$.v') AS DOUBLE) END AS v,
         CASE WHEN json_type(j, '$.name') = 'VARCHAR' THEN json_extract_string(j, '$.name') END AS name
  FROM doc
)
"""


@query(
    f"""
WITH {EVENT_RECORD_SQL}
SELECT event_id, k, v, name, concat_ws(',', CASE WHEN k IS NULL THEN 'k' END, CASE WHEN v IS NULL THEN 'v' END,
                                       CASE WHEN name IS NULL THEN 'name' END) AS rejected
FROM fields
"""
)
def record_validation(spark, sf_dir):
    """Typed fields of every record and the names of those that are missing or wrong."""
    checked = validate_records(event_records(spark, sf_dir), "raw", EVENT_RECORD)
    return checked.select("event_id", "k", "v", "name", F.array_join("rejected_fields", ",").alias("rejected"))


@query("SELECT n_nationkey, n_name, n_regionkey, n_regionkey = 0 AS first FROM nation")
def literal_records(spark, sf_dir):
    """Records given as plain values; a field that a record lacks is NULL."""
    nations = table(spark, sf_dir, "nation")
    rows = [row.asDict() for row in nations.collect()]  # a list that is short by nature
    some = [{k: v for k, v in row.items() if k != "n_regionkey" or v == 0} for row in rows]
    given = records(spark, some, nations.schema).select("n_nationkey", "n_name", F.col("n_regionkey").alias("known"))
    return given.join(nations.select("n_nationkey", "n_regionkey"), "n_nationkey").select(
        "n_nationkey", "n_name", "n_regionkey", F.col("known").isNotNull().alias("first")
    )


@query(
    """
SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, count(*) AS n FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY o_orderpriority
"""
)
def config_domains(spark, sf_dir):
    """Value lists from a configuration file, and the values of a table that they lack."""
    path = scratch_path(spark, "config") + ".json"
    lists = table(spark, sf_dir, "orders").where("o_orderpriority < '3'").select("o_orderpriority").distinct()
    named = lists.agg(F.sort_array(F.collect_list("o_orderpriority")).alias("o_orderpriority"))
    named.select(F.to_json(F.struct("o_orderpriority"))).coalesce(1).write.text(path)
    domains = load_config(spark, path)
    orders = table(spark, sf_dir, "orders").select("o_orderpriority")
    outside = orders.where(~F.col("o_orderpriority").isin(domains["o_orderpriority"]))
    return outside.groupBy(F.col("o_orderpriority").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("o_orderpriority").alias("column"), "value", "n"
    )
