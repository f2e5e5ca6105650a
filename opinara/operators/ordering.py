"""Top-n selections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_articles(df: DataFrame, n: int = 10, order_by: str = "sentiment_score", unique: str = "id") -> DataFrame:
    """Best rows by a score, or by id when the frame lacks it; each task keeps only its own best ``n``."""
    keys = [F.desc(order_by)] if order_by in df.columns else []
    return df.orderBy(*keys, F.desc(unique)).limit(n)


def newest_of_day(df: DataFrame, day: str, n: int = 400) -> DataFrame:
    return df.filter(F.col("date") == day).orderBy(F.desc("id")).limit(n)


def rows_since(df: DataFrame, previous_max: int, n: int = 200) -> DataFrame:
    return df.filter(F.col("id") > previous_max).orderBy("id").limit(n)


def latest_run(predictions: DataFrame) -> DataFrame:
    """The largest run of the newest date."""
    sizes = predictions.groupBy("date", "run").agg(F.count("*").alias("rows"))
    return sizes.orderBy(F.desc("date"), F.desc("rows"), F.desc("run")).limit(1)
