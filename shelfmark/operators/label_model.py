"""Label codes as a fitted stage that keeps its labels in a table and not in itself."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators.labels import label_tables, with_codes

CODES = "column string, label string, n bigint, code bigint"


class _Labelled(HasInputCols, HasOutputCols):
    """Columns whose labels get codes, and the names of those."""

    def pairs(self) -> Mapping[str, str]:
        return dict(zip(self.getInputCols(), self.getOutputCols(), strict=True))


class LabelCoder(Estimator, _Labelled, DefaultParamsReadable, DefaultParamsWritable):
    """Counts the labels of all columns in one pass; code 0 is the most frequent, ties by label."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LabelCoderModel:
        return self._copyValues(LabelCoderModel(label_tables(dataset, self.getInputCols())))


class LabelCoderModel(Model, _Labelled, MLReadable, MLWritable):
    """Codes by a join with the table of labels; null and unknown ones get the code after the last."""

    def __init__(self, codes: DataFrame | None = None):
        super().__init__()
        self.codes = codes

    def copy(self, extra=None) -> LabelCoderModel:
        made = super().copy(extra)
        made.codes = self.codes
        return made

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_codes(dataset, self.pairs(), self.codes, "double")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: LabelCoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.codes.write.parquet(f"{path}/codes")


class _Reader(MLReader):
    def load(self, path: str) -> LabelCoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = LabelCoderModel(SparkSession.active().read.schema(CODES).parquet(f"{path}/codes"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
