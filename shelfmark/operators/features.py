"""Numbers for models: codes, scaled values, vectors, the feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.derive import assign_bucket, rescale_to_int
from shelfmark.operators.label_model import LabelCoder
from shelfmark.operators.labels import index_labels, label_codes, label_tables, with_codes  # noqa: F401
from shelfmark.operators.project import select_existing
from shelfmark.sources.staging import stage


def min_max(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Columns scaled to 0..1 by their range, under new names; a constant column becomes 0.5."""
    ranges = df.agg(*[
        F.struct(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi")).alias(c)
        for c in cols
    ]).select(F.struct(*cols)).scalar()
    scaled: dict[str, Column] = {}
    for c, name in cols.items():
        lo, hi = ranges.getField(c).getField("lo"), ranges.getField(c).getField("hi")
        unit = F.when(lo == hi, F.lit(0.5)).otherwise(F.try_divide(F.col(c) - lo, hi - lo))
        scaled[name] = F.when(F.col(c).isNotNull(), unit)
    return df.withColumns(scaled)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Columns as one ML vector; nulls become NaN."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def fit_features(
    df: DataFrame, labels: Mapping[str, str], scaled: Mapping[str, str], plain: Sequence[str] = (),
    out: str = "features",
) -> PipelineModel:
    """Fitted stages: label codes, scaled columns, and all of them as one vector.

    ``labels`` and ``scaled`` map input to output names. The model keeps the labels in
    a table that is saved and loaded with it, however many they are.
    """
    stages = []
    for c, o in scaled.items():
        stages += [
            VectorAssembler(inputCols=[c], outputCol=f"_{c}_vec", handleInvalid="keep"),
            MinMaxScaler(inputCol=f"_{c}_vec", outputCol=o),
        ]
    if labels:
        stages.append(LabelCoder(inputCols=list(labels), outputCols=list(labels.values())))
    stages.append(VectorAssembler(
        inputCols=[*scaled.values(), *labels.values(), *plain], outputCol=out, handleInvalid="keep"))
    return Pipeline(stages=stages).fit(stage(select_existing(df, list(dict.fromkeys([*labels, *scaled, *plain]))), "fitted"))


def feature_table(
    df: DataFrame, key: str, labels: Mapping[str, str], score: str, keep: Sequence[str],
    users: int = 200, user: str = "user_id", interaction: str = "interaction_score",
) -> DataFrame:
    """Scalar features per item: label codes, a user bucket and a 1..5 interaction score.

    Codes are doubles, as in ML vectors. ``score`` is scaled by its range first. The
    columns that are needed are written once, as ranges and labels are counted on them.
    """
    needed = dict.fromkeys([key, score, *labels, *keep])
    df = stage(select_existing(df, list(needed)), "items")
    out = min_max(df, {score: "_unit"}).withColumns({
        user: assign_bucket(key, users), interaction: rescale_to_int("_unit"),
    })
    out = with_codes(out, labels, label_tables(df, list(labels)), "double")
    return select_existing(out, [*keep, *labels.values(), user, interaction])
