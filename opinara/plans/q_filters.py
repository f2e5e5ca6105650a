"""Projections, filters and predicates over GOLD and predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.operators import filters
from opinara.plans import corpus
from opinara.plans.registry import query
from opinara.plans.vocabulary import THEME_STEMS, WATCH_KEYWORDS

CORE = ("id", "source", "topic_1", "sentiment", "sentiment_score")
SQL_CORE = "SELECT id, source, topic_1, sentiment, sentiment_score FROM gold"


def _any(column: str, parts) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{p}')" for p in parts) + ")"


@query("filter_sentiment", f"{SQL_CORE} WHERE sentiment = 'positif'")
def filter_sentiment(spark, sf_dir):
    return filters.where_equal(corpus.gold(spark, sf_dir), "sentiment", "positif").select(*CORE)


@query("filter_source", f"{SQL_CORE} WHERE source = 'reddit_france'")
def filter_source(spark, sf_dir):
    return filters.where_equal(corpus.gold(spark, sf_dir), "source", "reddit_france").select(*CORE)


@query("filter_sql", f"{SQL_CORE} WHERE sentiment = 'negatif' UNION ALL {SQL_CORE} WHERE sentiment_score > 0.6 AND topic_1 = 'sport'")
def filter_sql(spark, sf_dir):
    gold = corpus.gold(spark, sf_dir)
    bare = filters.where_sql(gold, "negatif")
    return bare.unionAll(filters.where_sql(gold, "sentiment_score > 0.6 AND topic_1 = 'sport'")).select(*CORE)


@query("delete_rows", "SELECT raw_data_id, resource_id FROM (SELECT action_log_id AS raw_data_id, resource_id FROM audit_log) WHERE NOT (resource_id > 60)")
def delete_rows(spark, sf_dir):
    log = corpus.audit_log(spark, sf_dir).select(F.col("action_log_id").alias("raw_data_id"), "resource_id")
    return filters.delete_where(log, "resource_id > 60")


@query("replace_value", "SELECT id, CASE WHEN sentiment = 'neutre' THEN 'neutral' ELSE sentiment END AS sentiment FROM gold")
def replace_value(spark, sf_dir):
    return filters.replace_value(corpus.gold(spark, sf_dir), "sentiment", "neutre", "neutral").select("id", "sentiment")


@query("add_drop_column", "SELECT id, source, topic_1, topic_1_score, 'batch' AS origin FROM gold")
def add_drop_column(spark, sf_dir):
    gold = corpus.gold(spark, sf_dir).select("id", "source", "topic_1", "topic_1_score", "sentiment")
    return filters.add_and_drop(gold, {"origin": "batch"}, ["sentiment"])


@query("filter_topics", "SELECT id, topic_1, topic_2 FROM gold WHERE lower(trim(topic_1)) IN ('finance', 'meteo') OR lower(trim(topic_2)) IN ('finance', 'meteo')")
def filter_topics(spark, sf_dir):
    return filters.with_topics(corpus.gold(spark, sf_dir), ["Finance", " meteo"]).select("id", "topic_1", "topic_2")


def _theme_sql(theme: str) -> str:
    match = f"({_any('topic_1', THEME_STEMS[theme])} OR {_any('title', THEME_STEMS[theme])})"
    return f"SELECT '{theme}' AS theme, id FROM gold WHERE {match} OR (SELECT count(*) FROM gold WHERE {match}) <= 10"


@query("filter_theme", " UNION ALL ".join(_theme_sql(t) for t in THEME_STEMS))
def filter_theme(spark, sf_dir):
    """One theme with many matches, one with too few (which keeps the whole layer)."""
    gold = corpus.gold(spark, sf_dir).select("id", "title", "topic_1")
    parts = [
        filters.with_theme(gold, stems).select(F.lit(theme).alias("theme"), "id") for theme, stems in THEME_STEMS.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "filter_source_group",
    " UNION ALL ".join(
        f"SELECT '{g}' AS source_group, id, source FROM gold WHERE source IN ({', '.join(repr(s) for s in names)})"
        for g, names in filters.SOURCE_GROUPS.items()
    ),
)
def filter_source_group(spark, sf_dir):
    gold = corpus.gold(spark, sf_dir).select("id", "source")
    frames = [
        filters.in_source_group(gold, g).select(F.lit(g).alias("source_group"), "id", "source")
        for g in filters.SOURCE_GROUPS
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


@query(
    "filter_confidence",
    "SELECT p.id, p.confidence, g.topic_1 FROM latest_run p JOIN gold g ON CAST(g.id AS VARCHAR) = p.id"
    " WHERE p.confidence >= 0.6 AND contains(lower(g.topic_1), 'poli')",
)
def filter_confidence(spark, sf_dir):
    topics = corpus.gold(spark, sf_dir).select(F.col("id").cast("string").alias("id"), "topic_1")
    scored = corpus.latest_run(spark, sf_dir).select("id", "confidence").join(topics, "id")
    return filters.confident(scored, 0.6, "Poli")


@query("keyword_watch", f"SELECT id, title FROM gold WHERE {_any(chr(39).join(['title || ', ' ', ' || url']), WATCH_KEYWORDS)}")
def keyword_watch(spark, sf_dir):
    return filters.watch(corpus.gold(spark, sf_dir), WATCH_KEYWORDS, "title", "url").select("id", "title")


@query("min_chars", "SELECT id, length(content) AS chars FROM gold WHERE length(coalesce(content, '')) >= 400")
def min_chars(spark, sf_dir):
    rows = filters.at_least_chars(corpus.gold(spark, sf_dir), "content", 400)
    return rows.select("id", F.length("content").alias("chars"))


@query("app_input", "SELECT id, source, title, topic_1, sentiment_score FROM gold")
def app_input(spark, sf_dir):
    gold = corpus.gold(spark, sf_dir).select("id", "source", "title", "topic_1", "sentiment", "sentiment_score")
    return filters.app_input(gold)


@query("label_contract", "SELECT id, sentiment AS sentiment_label FROM gold")
def label_contract(spark, sf_dir):
    rows = corpus.gold(spark, sf_dir).select("id", F.col("sentiment").alias("sentiment_label"))
    filters.assert_labelled(rows.columns)
    return rows
