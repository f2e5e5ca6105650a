"""Flagship query and the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import lexicon, text
from opinara.operators import layers
from opinara.operators.skew import keep_first
from opinara.plans import corpus
from opinara.plans.oracle import LADDER_LABEL, LADDER_SCORE, lexicon_cte, topics_of
from opinara.plans.registry import query
from opinara.plans.vocabulary import LARGE_LEXICON, LARGE_TOPICS, LEXICON, TOPICS


@query(
    "flagship_source_scores",
    f"""SELECT p.source, count(*) AS articles, round(avg(p.score), 10) AS avg_sentiment_score, CAST(sum(CASE WHEN t.best[1].t <> 'autre' THEN 1 ELSE 0 END) AS BIGINT) AS on_topic
  FROM (SELECT id, source, {LADDER_SCORE} AS score FROM clean_pass) p JOIN clean_topic t USING (id) GROUP BY p.source""",
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cleaned, validated, deduplicated and enriched, then counted and averaged by source."""
    clean = text.clean_articles(corpus.articles(spark, sf_dir))
    hashed = clean.withColumn("fingerprint", text.fingerprint(F.col("title"), F.col("content")))
    unique = keep_first(
        hashed.filter(text.is_valid(F.col("title"), F.col("content"))), ["fingerprint"], [F.col("id")]
    )
    enriched = lexicon.add_topic_columns(lexicon.add_sentiment(unique, LEXICON), TOPICS)
    return enriched.groupBy("source").agg(
        F.count("*").alias("articles"),
        F.round(F.avg("sentiment_score"), 10).alias("avg_sentiment_score"),
        F.sum(F.when(F.col("topic_1") != lexicon.FALLBACK_TOPIC, 1).otherwise(0)).alias("on_topic"),
    )


@query("gold_layer", "SELECT id, source, topic_1, topic_1_score, topic_2, topic_2_score, sentiment, sentiment_score FROM gold")
def gold_layer(spark, sf_dir):
    g = layers.gold(corpus.silver(spark, sf_dir), corpus.model_output(spark, sf_dir))
    return g.select(
        "id", "source", "topic_1", "topic_1_score", "topic_2", "topic_2_score", "sentiment", "sentiment_score"
    )


@query("topic_assign", "SELECT raw_data_id, topic, confidence_score, tagger FROM topic_links")
def topic_assign(spark, sf_dir):
    return corpus.topic_links(corpus.raw(spark, sf_dir)).drop("doc_topic_id")


@query("lexicon_sentiment", f"SELECT id, {LADDER_LABEL} AS sentiment, {LADDER_SCORE} AS sentiment_score FROM pass_all")
def lexicon_sentiment(spark, sf_dir):
    return lexicon.add_sentiment(corpus.raw(spark, sf_dir), LEXICON).select("id", "sentiment", "sentiment_score")


@query("topic_assign_large", f"SELECT id, best[1].t AS topic_1, -best[1].s AS topic_1_score FROM ({topics_of('raw', LARGE_TOPICS)})")
def topic_assign_large(spark, sf_dir):
    """Topics from 806 keywords, found in one pass over each text."""
    return lexicon.add_topic_columns(corpus.raw(spark, sf_dir), LARGE_TOPICS).select("id", "topic_1", "topic_1_score")


@query(
    "lexicon_sentiment_large",
    f"""SELECT id, {LADDER_LABEL} AS sentiment, {LADDER_SCORE} AS sentiment_score FROM ({lexicon_cte('raw', "(title || ' ' || content)", 'id', LARGE_LEXICON)})""",
)
def lexicon_sentiment_large(spark, sf_dir):
    """Sentiment from 800 words."""
    return lexicon.add_sentiment(corpus.raw(spark, sf_dir), LARGE_LEXICON).select("id", "sentiment", "sentiment_score")
