"""Reading tables and fitted models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.project import cast_columns, try_cast


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
    null_value: str = "", multiline: bool = False, escape: str | None = None, mode: str = "PERMISSIVE",
    header: bool = True,
) -> DataFrame:
    """Headed CSV, one file or a folder of them, under a declared schema.

    Empty fields are null. Whole-number columns also take "2.0". A cell that does
    not fit its type is null. ``multiline`` allows line breaks inside quotes (such
    files are read by one task each); ``escape='"'`` reads doubled quotes.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    reader = spark.read.schema(text).option("header", header).option("nullValue", null_value)
    reader = reader.option("multiLine", multiline).option("mode", mode)
    if mode == "DROPMALFORMED":
        # A row is judged by all its fields, also where few columns are wanted.
        reader = reader.option("columnPruning", False)
    if escape is not None:
        reader = reader.option("escape", escape)
    paths = path if isinstance(path, str) else list(path)
    return reader.csv(paths).select(*[
        (F.col(f"`{f.name}`") if isinstance(f.dataType, T.StringType)
         else try_cast(F.col(f"`{f.name}`"), f.dataType.simpleString())).alias(f.name)
        for f in schema.fields
    ])


def read_csv_inferred(
    spark: SparkSession, path: str, types: Mapping[str, str] | None = None, multiline: bool = False,
) -> DataFrame:
    """Headed CSV with guessed types (an extra pass over the file), then explicit casts."""
    reader = spark.read.option("header", True).option("inferSchema", True).option("nullValue", "")
    df = reader.option("multiLine", multiline).option("escape", '"').csv(path)
    return cast_columns(df, types or {})


def read_lenient(
    spark: SparkSession, path: str, schema: T.StructType | str, numeric: Sequence[str] = (),
    header: bool = True, multiline: bool = False,
) -> DataFrame:
    """CSV that may be broken: rows with a wrong number of fields are skipped, bad numbers are null.

    With ``multiline``, quoted fields may hold line breaks; then a file is one task.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    df = read_csv(spark, path, schema, multiline=multiline, escape='"', mode="DROPMALFORMED", header=header)
    return cast_columns(df, {c: "double" for c in numeric})


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder, all parts."""
    return spark.read.parquet(path)


def _load(kind, path: str):
    spark = SparkSession.active()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        raise FileNotFoundError(f"no {kind.__name__} at {path}")
    return kind.load(path)


def load_als(path: str) -> ALSModel:
    """A saved recommender; FileNotFoundError if there is none."""
    return _load(ALSModel, path)


def load_features(path: str) -> PipelineModel:
    """Saved feature stages; FileNotFoundError if there are none."""
    return _load(PipelineModel, path)
