"""Row filters, column edits and dataset contracts."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.text import or_empty, strip

# Columns removed from inference input, and the names that must never appear in it.
TARGET_COLUMNS = ("sentiment_label", "label", "target", "y_true", "sentiment")
FORBIDDEN_COLUMNS = ("sentiment_label", "label", "target", "y_true")

# Source groups of the insight reports.
SOURCE_GROUPS = {
    "participatory": ("reddit_france", "trustpilot_reviews", "monavis_citoyen", "agora_consultations"),
    "media": ("rss_french_news", "google_news_rss", "yahoo_finance", "gdelt_events"),
    "economic": ("yahoo_finance", "insee_indicators", "datagouv_datasets"),
    "weather": ("openweather_api", "open_meteo"),
}
THEME_MINIMUM = 10


def where_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == value)


def where_sql(df: DataFrame, condition: str) -> DataFrame:
    """Rows meeting a SQL condition; a bare word asks for that sentiment."""
    if re.fullmatch(r"\w+", condition.strip()):
        return where_equal(df, "sentiment", condition.strip())
    return df.filter(F.expr(condition))


def delete_where(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the condition is false; an unknown condition removes the row too."""
    return df.filter(~F.expr(condition))


def replace_value(df: DataFrame, column: str, old: object, new: object) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == old, new).otherwise(F.col(column)))


def add_and_drop(df: DataFrame, add: dict[str, object], drop: Iterable[str]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in add.items()}).drop(*drop)


def with_topics(df: DataFrame, topics: Iterable[str]) -> DataFrame:
    """Rows whose first or second topic is on the list."""
    wanted = [t.strip().lower() for t in topics]

    def listed(column: str) -> Column:
        return F.lower(strip(or_empty(F.col(column)))).isin(*wanted)

    return df.filter(listed("topic_1") | listed("topic_2"))


def mentions(text: Column, parts: Iterable[str]) -> Column:
    """True when the lower-cased text holds any of the parts."""
    low = F.lower(or_empty(text))
    found = F.lit(False)
    for part in parts:
        found = found | low.contains(part)
    return found


def with_theme(df: DataFrame, stems: Iterable[str], minimum: int = THEME_MINIMUM) -> DataFrame:
    """Rows on a theme, or all rows unless more than ``minimum`` match; the count is a one-row subquery."""
    match = mentions(F.col("topic_1"), stems) | mentions(F.col("title"), stems)
    matched = df.agg(F.count_if(match)).scalar()
    return df.filter(match | (F.coalesce(matched, F.lit(0)) <= minimum))


def in_source_group(df: DataFrame, group: str) -> DataFrame:
    return df.filter(F.col("source").isin(*SOURCE_GROUPS[group]))


def confident(df: DataFrame, minimum: float, topic: str | None = None) -> DataFrame:
    rows = df.filter(F.col("confidence") >= minimum)
    return rows if topic is None else rows.filter(F.lower("topic_1").contains(topic.lower()))


def watch(df: DataFrame, keywords: Iterable[str], *columns: str) -> DataFrame:
    """Rows whose joined columns hold any watched keyword."""
    return df.filter(mentions(F.concat_ws(" ", *columns), [k.lower() for k in keywords]))


def at_least_chars(df: DataFrame, column: str, minimum: int) -> DataFrame:
    return df.filter(F.length(or_empty(F.col(column))) >= minimum)


def assert_no_leak(columns: Iterable[str]) -> None:
    leaked = sorted(set(columns) & set(FORBIDDEN_COLUMNS))
    if leaked:
        raise ValueError(f"target columns in inference input: {', '.join(leaked)}")


def assert_labelled(columns: Iterable[str], label: str = "sentiment_label") -> None:
    if label not in set(columns):
        raise ValueError(f"training data lacks the label column {label}")


def app_input(df: DataFrame) -> DataFrame:
    """Inference branch: no target column survives."""
    result = df.drop(*TARGET_COLUMNS)
    assert_no_leak(result.columns)
    return result
