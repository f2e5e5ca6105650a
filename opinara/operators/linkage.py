"""Joins between articles, predictions and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.labels import normalize_label
from opinara.functions.text import normalize_id, strip
from opinara.operators.skew import keep_first

# Share of predicted rows under which the legacy labels fill in; confidence that replaces a label.
COVERAGE_FLOOR = 0.3
CONFIDENCE_MINIMUM = 0.7


def new_articles(incoming: DataFrame, stored: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Rows whose hash is neither stored nor earlier in the batch; the anti-join reads only the stored hashes."""
    first = keep_first(incoming, ["fingerprint"], order or [F.col("id")])
    return first.join(stored.select("fingerprint"), "fingerprint", "left_anti")


def last_prediction(predictions: DataFrame, order: list[str]) -> DataFrame:
    """Newest prediction per id."""
    fields = ("predicted_sentiment", "predicted_sentiment_score", "confidence")
    keyed = predictions.withColumn("id", normalize_id(F.col("id")))
    newest = keyed.groupBy("id").agg(F.max(F.struct(*order, *fields)).alias("_p"))
    return newest.select("id", *[F.col(f"_p.{f}").alias(f) for f in fields])


def enriched_articles(articles: DataFrame, predictions: DataFrame, legacy: DataFrame, order: list[str]) -> DataFrame:
    """Articles with their prediction; legacy labels fill the gaps only when few articles were predicted.

    The share of predicted articles is a one-row subquery, so the choice stays inside one plan.
    """
    base = articles.withColumn("id", normalize_id(F.col("id")))
    joined = base.join(last_prediction(predictions, order), "id", "left")
    coverage = joined.agg(F.avg(F.when(F.col("predicted_sentiment").isNotNull(), 1.0).otherwise(0.0))).scalar()
    old = legacy.select(
        normalize_id(F.col("id")).alias("id"),
        F.col("sentiment").alias("_old"),
        F.col("sentiment_score").alias("_old_score"),
    ).groupBy("id").agg(F.max(F.struct("_old", "_old_score")).alias("_l"))
    fill = F.col("_coverage") < COVERAGE_FLOOR
    return (
        joined.join(old, "id", "left")
        .withColumn("_coverage", coverage)
        .withColumns(
            {
                "sentiment": F.coalesce("predicted_sentiment", F.when(fill, F.col("_l._old"))),
                "sentiment_score": F.coalesce("predicted_sentiment_score", F.when(fill, F.col("_l._old_score"))),
            }
        )
        .drop("_coverage", "_l")
    )


def predictions_with_context(predictions: DataFrame, app_input: DataFrame) -> DataFrame:
    """Predictions with the columns they lack, taken from the app input by trimmed text id."""
    missing = [c for c in app_input.columns if c not in predictions.columns]
    context = app_input.select(strip(F.col("id").cast("string")).alias("id"), *missing)
    return predictions.withColumn("id", strip(F.col("id").cast("string"))).join(context, "id", "left")


def bootstrap_labels(labelled: DataFrame, predictions: DataFrame, minimum: float = CONFIDENCE_MINIMUM) -> DataFrame:
    """Lexical labels replaced by confident model labels; ``label_source`` tells which one a row carries."""
    strong = (
        predictions.filter(F.col("confidence") >= minimum)
        .groupBy(F.col("id").cast("string").alias("id"))
        .agg(F.max(F.struct("date", "run", normalize_label(F.col("predicted_sentiment")).alias("label"))).alias("_p"))
    )
    label = F.coalesce("_p.label", "sentiment_label")
    return (
        labelled.withColumn("id", F.col("id").cast("string"))
        .join(strong, "id", "left")
        .withColumn("label_source", F.when(F.col("_p.label").isNotNull(), "ml_model").otherwise("lexical"))
        .withColumns({"sentiment_label": label, "sentiment": F.coalesce("_p.label", "sentiment")})
        .drop("_p")
    )
