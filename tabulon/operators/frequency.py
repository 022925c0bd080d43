"""Frequency encoding as a stage of Spark ML pipelines (FE-3, FE-7, FE-8).

``FrequencyEncoder`` counts the values of its columns on the rows that it is fitted on;
``FrequencyEncoderModel`` replaces each column by ``<column>_encoded``, the share of those rows with
the value. Fitted pipelines that hold it are saved and loaded like others: the parameters as
metadata, the dictionary (column, value, frequency), which grows with the number of values, as
Parquet beside them. It never passes the driver.

Values are compared as text; NULL is a value like others. Values that the fitted rows did not hold
have the frequency ``unseen`` (0 by default, the share they had; NaN makes an assembler complain).
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.profile import value_counts
from tabulon.plans.lookup import attach, materialised


class _FrequencyParams(HasInputCols):
    suffix = Param(Params._dummy(), "suffix", "ending of the encoded columns", typeConverter=TypeConverters.toString)
    unseen = Param(Params._dummy(), "unseen", "frequency of values that were not seen", typeConverter=TypeConverters.toFloat)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(suffix="_encoded", unseen=0.0, inputCols=[])

    def encoded_columns(self) -> list[str]:
        return [f"{c}{self.getOrDefault(self.suffix)}" for c in self.getInputCols()]


class FrequencyEncoder(Estimator, _FrequencyParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, suffix: str = "_encoded", unseen: float = 0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FrequencyEncoderModel:
        cols = self.getInputCols()
        texts = dataset.select(*[F.col(c).cast("string").alias(c) for c in cols])
        counts = materialised(value_counts(texts, cols)) if cols else None
        rows = (counts.groupBy("column").agg(F.count(F.lit(1)).alias("values"), F.sum("n_rows").alias("rows")).collect()
                if cols else [])  # one row for each encoded column
        total = float(rows[0]["rows"]) if rows else 1.0
        table = counts.select("column", "value", (F.col("n_rows").cast("double") / F.lit(total)).alias("frequency")) if cols else None
        return self._copyValues(FrequencyEncoderModel(table, {r["column"]: r["values"] for r in rows}))


class FrequencyEncoderModel(Model, _FrequencyParams, MLReadable, MLWritable):
    def __init__(self, frequencies: DataFrame | None = None, values: dict[str, int] | None = None):
        super().__init__()
        #: (column, value, frequency) of the fitted rows, and the number of values of each column.
        self.frequencies, self.values = frequencies, values or {}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for c, name in zip(self.getInputCols(), self.encoded_columns()):
            own = self.frequencies.filter(F.col("column") == F.lit(c)).select(
                F.col("value").alias("_key"), F.col("frequency").alias("_share"))
            joined = attach(out.withColumn("_key", F.col(c).cast("string")), own, ["_key"], how="left", rows=self.values.get(c, 0))
            out = joined.withColumn(name, F.coalesce("_share", F.lit(self.getOrDefault(self.unseen)))).drop("_key", "_share", c)
        return out

    def write(self) -> MLWriter:
        return _FrequencyWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FrequencyReader()


class _FrequencyWriter(MLWriter):
    def __init__(self, model: FrequencyEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"values": self.model.values})
        if self.model.frequencies is not None:
            self.model.frequencies.write.parquet(f"{path}/frequencies")


class _FrequencyReader(MLReader):
    def load(self, path: str) -> FrequencyEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        values = metadata.get("values") or {}
        table = self.sparkSession.read.parquet(f"{path}/frequencies") if values else None
        model = FrequencyEncoderModel(table, values)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
