"""Standardise numbers, one-hot encode texts, assemble one vector."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerprice.operators.columns import numeric_columns, text_columns

FEATURES = "features"


class PopulationScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Centre and scale columns by mean and *population* standard deviation.

    ``pyspark.ml`` scales by the sample deviation. The fitted stage is an ordinary SQLTransformer, so a
    pipeline model that holds it saves and loads without this class. A constant column becomes 0.
    """

    @keyword_only
    def __init__(self, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        names = self.getInputCols()
        moments = dataset.agg(
            *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(names)],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(names)],
        ).first()
        found = [(moments[f"m{i}"], moments[f"s{i}"]) for i in range(len(names))]
        return scaling(names, self.getOutputCols(), found)


def scaling(names: list[str], outputs: list[str], moments: list[tuple[float | None, float]]) -> SQLTransformer:
    """The fitted `PopulationScaler` of known means and deviations."""
    terms = []
    for name, out, (mean, spread) in zip(names, outputs, moments):
        if mean is None:
            raise ValueError(f"column {name} holds no value to scale by")
        terms.append(f"(CAST(`{name}` AS DOUBLE) - ({float(mean)!r}D)) / ({float(spread or 1.0)!r}D) AS `{out}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def preparation_stages(
    numeric: list[str], text: list[str], output: str = FEATURES, handle_invalid: str = "error"
) -> list:
    """Numbers first, then the one-hot slots of each text column in sorted order.

    A text value not seen in fitting, and NULL, becomes all zeros: the indexer keeps an extra slot for
    them, and that last slot is the one the encoder drops.
    """
    scaled = [f"{c}_scaled" for c in numeric]
    indexed = [f"{c}_index" for c in text]
    encoded = [f"{c}_onehot" for c in text]
    stages: list = []
    if numeric:
        stages.append(PopulationScaler(inputCols=numeric, outputCols=scaled))
    if text:
        stages.append(
            StringIndexer(inputCols=text, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc")
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True))
    stages.append(VectorAssembler(inputCols=scaled + encoded, outputCol=output, handleInvalid=handle_invalid))
    return stages


def regression_pipeline(regressor, numeric: list[str], text: list[str], handle_invalid: str = "error") -> Pipeline:
    return Pipeline(stages=[*preparation_stages(numeric, text, handle_invalid=handle_invalid), regressor])


def pipeline_by_type(regressor, df: DataFrame, label: str, exclude: tuple[str, ...] = ()) -> Pipeline:
    """Every numeric column but the label is scaled, every text column is encoded."""
    return regression_pipeline(regressor, numeric_columns(df, (label, *exclude)), text_columns(df, exclude))
