"""Score arriving JSON records."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hammerprice.operators.contracts import accepted, rejected, validate_records
from hammerprice.schemas import SCORING


def score_records(
    lines: DataFrame, model: Model, schema: T.StructType = SCORING, raw: str = "value",
    prediction: str = "prediction",
) -> DataFrame:
    """Valid records with a ``{"Prediction": x}`` reply each; works on tables and on streams."""
    return _score(validate_records(lines.select(raw), raw, schema), model, schema, raw, prediction)


def _score(
    validated: DataFrame, model: Model, schema: T.StructType, raw: str = "value", prediction: str = "prediction"
) -> DataFrame:
    reply = F.to_json(F.struct(F.col(prediction).alias("Prediction")))
    return model.transform(accepted(validated)).select(raw, *schema.names, prediction, reply.alias("reply"))


def score_stream(
    spark: SparkSession, inbox: str, model: Model, output: str, checkpoint: str,
    schema: T.StructType = SCORING, files_per_batch: int = 1000,
) -> StreamingQuery:
    """Score every new line of JSON under `inbox` into ``output/scored``, bad ones into ``output/rejected``.

    Records are stateless, so there is no watermark. A backlog is taken `files_per_batch` files at a time, so
    that a batch stays of a size that can be held while both outputs are written. Each batch is read and parsed once and owns the folder
    ``batch=<id>`` of both outputs; a batch repeated after a failure replaces its own rows only.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        validated = validate_records(batch, "value", schema).persist()
        try:
            _score(validated, model, schema).write.mode("overwrite").parquet(f"{output}/scored/batch={batch_id}")
            rejected(validated, "value").write.mode("overwrite").parquet(f"{output}/rejected/batch={batch_id}")
        finally:
            validated.unpersist()

    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(inbox)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
