"""A collaborative recommender on (user, item, score) tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.derive import md5_number
from shelfmark.functions.presets import ALS_PARAMS, TRAIN_PERCENT
from shelfmark.operators.best_items import best_items
from shelfmark.operators.cleaning import dedup
from shelfmark.operators.joins import skew_join
from shelfmark.operators.project import select_existing
from shelfmark.sources.staging import ensure_checkpoint_dir, free_unreferenced, scratch_path


def in_training(keys: Sequence[str], seed: int = ALS_PARAMS["seed"], percent: int = TRAIN_PERCENT) -> Column:
    """Whether a row belongs to the training part: a fixed property of its keys and the seed."""
    text = F.concat_ws("-", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.pmod(md5_number(text), F.lit(100)) < percent


def split(
    df: DataFrame, keys: Sequence[str], seed: int = ALS_PARAMS["seed"], percent: int = TRAIN_PERCENT,
) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, complete, and the same however the table is partitioned."""
    train = in_training(keys, seed, percent)
    return df.where(train), df.where(~train)


def train_als(
    train: DataFrame, user: str, item: str, score: str, params: Mapping | None = None,
) -> ALSModel:
    """Explicit-feedback ALS; rows of unseen users or items are dropped when predicting.

    Ids must be whole numbers in the int range (ALS checks); see ``index_labels``.
    Factors lie in as many blocks as the session runs tasks at a time, at least the
    ten that are usual; ``params`` may set numUserBlocks and numItemBlocks. Each
    iteration sends a factor to almost every block: with a checkpoint in each of them
    (checkpointInterval) the shuffles of the one before are deleted, else all stay. The
    factors of the model are written tables, and what training kept is let go.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    blocks = max(10, spark.sparkContext.defaultParallelism)
    settings = {"numUserBlocks": blocks, "numItemBlocks": blocks, "checkpointInterval": 1, **ALS_PARAMS, **(params or {})}
    als = ALS(userCol=user, itemCol=item, ratingCol=score, coldStartStrategy="drop", implicitPrefs=False, **settings)
    path = scratch_path(spark, "als")
    als.fit(train.select(user, item, F.col(score).cast("float"))).write().save(path)
    free_unreferenced(spark)
    return ALSModel.load(path)


def predict(model: ALSModel, test: DataFrame) -> DataFrame:
    """Test rows with a prediction; ids keep the types they came with."""
    ids = {c: F.col(c).cast(test.schema[c].dataType) for c in (model.getUserCol(), model.getItemCol())}
    return model.transform(test).where(F.col("prediction").isNotNull()).withColumns(ids)


def _lists(model: ALSModel, n: int, digits: int, users: DataFrame | None = None, every: bool = False) -> DataFrame:
    """One row per recommendation; ids are bigint as everywhere outside the model."""
    user, item = model.getUserCol(), model.getItemCol()
    factors = model.userFactors
    if users is not None:
        wanted = users.select(F.col(user).cast("bigint").alias("id")).distinct()
        factors = factors.select(F.col("id").cast("bigint").alias("id"), "features").join(wanted, "id", "left_semi")
    return best_items(factors, model.itemFactors, n, every=every).select(
        F.col("user").alias(user), F.col("item").alias(item), F.round(F.col("score").cast("float"), digits).alias("predicted_score"))


def recommend_all(model: ALSModel, n: int = 10, digits: int = 4, every: bool = False) -> DataFrame:
    """The top ``n`` items of every user, one row each, of equal scores the smaller item first.

    The lists of ``recommendForAllUsers`` by ``best_items``: Spark's own form shuffles
    ``n`` rows per user for each 4,096 items. Products are of doubles here, of floats
    there, so a score may differ in its last digit. With ``every`` every user is scored
    with every item, and no bound is relied on.
    """
    return _lists(model, n, digits, every=every)


def recommend_best(model: ALSModel, n: int = 10, digits: int = 4, users: DataFrame | None = None) -> DataFrame:
    """The lists of ``recommend_all``, without scoring all pairs: see ``best_items``.

    ``users`` names some users only; unknown ones give no row.
    """
    return _lists(model, n, digits, users)


def recommend_for(model: ALSModel, users: DataFrame, n: int = 10, digits: int = 4) -> DataFrame:
    """The top ``n`` items of the given users only; unknown users give no row."""
    return _lists(model, n, digits, users)


def item_metadata(
    items: DataFrame, index: str, key: str, details: DataFrame, cols: Sequence[str],
) -> DataFrame:
    """One row per item index with the details known for its key."""
    ids = items.select(key, index).distinct()
    joined = skew_join(ids, select_existing(details, [key, *cols]), [key], how="left")
    return dedup(joined, [index], [key])


def enrich(
    recs: DataFrame, metadata: DataFrame, item: str, cols: Sequence[str], order: Sequence[Column] = (),
) -> DataFrame:
    """Recommendations with item details, in the given column order; unknown items keep nulls."""
    out = skew_join(recs, metadata, [item], how="left").select(*cols)
    return out.orderBy(*order) if order else out


def enrich_bucketed(recs: DataFrame, metadata: DataFrame, item: str, cols: Sequence[str]) -> DataFrame:
    """``enrich`` for tables that both lie in as many buckets by ``item`` (``write_bucketed``): no row is moved.

    A bucket is a task, so ``enrich`` is the one to use where one item holds a large
    part of all recommendations.
    """
    return recs.join(metadata.hint("merge"), item, "left").select(*cols)


def recommendations_table(
    model: ALSModel, metadata: DataFrame, cols: Sequence[str], n: int = 10,
) -> DataFrame:
    """All recommendations with item details, best first per user."""
    user, item = model.getUserCol(), model.getItemCol()
    return enrich(
        recommend_all(model, n), metadata, item, [user, item, "predicted_score", *cols],
        [F.col(user), F.col("predicted_score").desc(), F.col(item)])
