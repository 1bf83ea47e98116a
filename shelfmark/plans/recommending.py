"""From interactions to recommendations and their metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame

from shelfmark.functions.presets import ALS_PARAMS
from shelfmark.operators import evaluate as ev
from shelfmark.operators import recommend as rc
from shelfmark.sources.staging import hand_out, scope


@dataclass(frozen=True)
class Recommendation:
    """What one training run leaves behind; the tables are written copies."""

    model: ALSModel
    predictions: DataFrame
    recommendations: DataFrame
    metrics: DataFrame


def recommend(
    interactions: DataFrame, metadata: DataFrame, user: str, item: str, score: str, attribute: str,
    cols: Sequence[str], n: int = 10, params: Mapping | None = None, seed: int = ALS_PARAMS["seed"],
) -> Recommendation:
    """Split, train, predict, recommend and evaluate once.

    ``interactions`` should be a written table: training reads it many times.
    The recommendations are computed once and serve the list, coverage and
    diversity alike.
    """
    settings = {**ALS_PARAMS, **(params or {})}
    train, test = rc.split(interactions, [user, item], seed)
    model = rc.train_als(train, user, item, score, settings)
    predictions = rc.predict(model, test)
    with scope():
        recs = hand_out(rc.recommend_all(model, n), "recommendations")
    metrics = ev.metrics_row(
        ev.rating_error(predictions, score),
        ev.coverage(recs, interactions, item),
        ev.diversity(recs, metadata, user, item, attribute),
        settings,
    )
    table = rc.enrich(recs, metadata, item, [user, item, "predicted_score", *cols])
    return Recommendation(model, predictions, table, metrics)
