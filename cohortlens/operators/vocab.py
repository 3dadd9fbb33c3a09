"""M4/M5/M7: learned vocabularies of any size as a pipeline stage.

The model is a table (column, value, idx) in the shared folder, never on the driver: each column
meets its part of it in one equi-join at transform time (broadcast by Spark's own size check while it
is small, a skew-split shuffle join when it is not). Codes are positions in the sorted vocabulary;
unseen and null values get -1. Values are compared as strings.
"""

from __future__ import annotations

import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCols, Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import encode as E
from cohortlens.session import written


class _Suffix(HasInputCols):
    suffix = Param(Params._dummy(), "suffix", "ending of the code columns", TypeConverters.toString)


class VocabIndexer(Estimator, _Suffix, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the sorted distinct values of every input column."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, suffix: str = "__code"):
        super().__init__()
        self._setDefault(suffix="__code")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "VocabIndexerModel":
        table = written(E.fit_vocab(df, self.getInputCols()), "vocabulary")
        return VocabIndexerModel(table)._set(inputCols=self.getInputCols(), suffix=self.getOrDefault(self.suffix))


class VocabIndexerModel(Model, _Suffix, MLReadable, MLWritable):
    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self._setDefault(suffix="__code")
        self.table = table

    def _transform(self, df: DataFrame) -> DataFrame:
        for c in self.getInputCols():
            code = c + self.getOrDefault(self.suffix)
            part = self.table.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("idx").alias("__idx"))
            joined = df.join(part, F.col(c).cast("string") == F.col("__value"), "left")
            df = joined.select(*[df[x] for x in df.columns], F.coalesce("__idx", F.lit(-1)).cast("double").alias(code))
        return df

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: VocabIndexerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table.write.mode("overwrite").partitionBy("column").parquet(os.path.join(path, "vocabulary"))


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> VocabIndexerModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        schema = "value string, idx int, column string"
        model = self.cls(spark.read.schema(schema).parquet(os.path.join(path, "vocabulary")))
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._resetUid(metadata["uid"])
        return model
