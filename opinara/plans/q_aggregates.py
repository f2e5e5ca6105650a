"""Distributions, statistics, drift and insight facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.operators import aggregates as agg
from opinara.operators import filters
from opinara.operators.filters import SOURCE_GROUPS
from opinara.plans import corpus
from opinara.plans.registry import query
from opinara.plans.vocabulary import CRISIS_PATTERNS, EVENT_PATTERNS


def _in(group: str) -> str:
    return "(" + ", ".join(f"'{s}'" for s in SOURCE_GROUPS[group]) + ")"


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 10) for c in columns})


@query("agg_sentiment", "SELECT sentiment, count(*) AS count FROM gold GROUP BY 1")
def agg_sentiment(spark, sf_dir):
    return agg.by_sentiment(corpus.gold(spark, sf_dir))


@query("agg_source", "SELECT source, count(*) AS count, round(avg(sentiment_score), 10) AS avg_sentiment_score FROM gold GROUP BY 1")
def agg_source(spark, sf_dir):
    return _rounded(agg.by_source(corpus.gold(spark, sf_dir)), "avg_sentiment_score")


@query(
    "agg_topic",
    "SELECT topic, count(*) AS count FROM (SELECT unnest([t for t in [topic_1, topic_2] if t <> '']) AS topic FROM gold) GROUP BY 1",
)
def agg_topic(spark, sf_dir):
    gold = corpus.gold(spark, sf_dir)
    listed = gold.select(agg.topic_list(F.concat_ws(",", "topic_1", "topic_2")).alias("topics"))
    return agg.by_topic(listed)


@query("top_topics", "SELECT topic_1 AS topic, count(*) AS count FROM gold GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def top_topics(spark, sf_dir):
    return agg.top_topics(corpus.gold(spark, sf_dir), 3)


@query(
    "dist_sentiment",
    "SELECT sentiment, count(*) AS count, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM gold), 10) AS percentage FROM gold GROUP BY 1",
)
def dist_sentiment(spark, sf_dir):
    return _rounded(agg.sentiment_distribution(corpus.gold(spark, sf_dir)), "percentage")


@query("daily_trend", "SELECT strftime(collected_at, '%Y-%m-%d') AS date, sentiment, count(*) AS count FROM gold GROUP BY 1, 2")
def daily_trend(spark, sf_dir):
    return agg.daily_trend(corpus.gold(spark, sf_dir), "collected_at")


@query(
    "statistics",
    """SELECT count(*) AS total_articles, count(DISTINCT source) AS total_sources, round(avg(sentiment_score), 10) AS avg_score,
  max(sentiment_score) AS max_score, min(sentiment_score) AS min_score,
  (SELECT string_agg(sentiment || '=' || n, ',' ORDER BY sentiment) FROM (SELECT sentiment, count(*) AS n FROM gold GROUP BY 1)) AS sentiment_distribution
  FROM gold""",
)
def statistics(spark, sf_dir):
    entries = F.transform(
        F.map_entries("sentiment_distribution"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    stats = agg.statistics(corpus.gold(spark, sf_dir))
    return _rounded(stats, "avg_score").withColumn("sentiment_distribution", F.array_join(F.array_sort(entries), ","))


_DRIFT = """
  CASE WHEN classes > 1 THEN bits ELSE 0 END AS h, CASE WHEN classes > 1 THEN bits / log2(classes) ELSE 0 END AS spread, top / n AS dominance"""


@query(
    "drift_metrics",
    f"""SELECT n AS articles_total, round_even(h, 4) AS sentiment_entropy, round_even(dominance, 4) AS topic_dominance,
  round_even(0.5::DOUBLE * (1 - spread) + 0.5::DOUBLE * dominance, 4) AS drift_score FROM (SELECT n, {_DRIFT} FROM (
  SELECT sum(c)::BIGINT AS n, count(*) AS classes, log2(sum(c)) - sum(c * log2(c)) / sum(c) AS bits,
  (SELECT max(c) FROM (SELECT count(*) AS c FROM gold WHERE topic_1 IS NOT NULL GROUP BY topic_1)) AS top
  FROM (SELECT count(*) AS c FROM gold GROUP BY sentiment)))""",
)
def drift_metrics(spark, sf_dir):
    return agg.drift_metrics(corpus.gold(spark, sf_dir))


@query(
    "sentiment_drift",
    """SELECT coalesce(a.sentiment, b.sentiment) AS sentiment, round(coalesce(a.p, 0), 10) AS current_pct,
  round(coalesce(b.p, 0), 10) AS previous_pct, round(coalesce(a.p, 0) - coalesce(b.p, 0), 10) AS delta,
  abs(coalesce(a.p, 0) - coalesce(b.p, 0)) >= 5.0 AS alert FROM
  (SELECT sentiment, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM gold) AS p FROM gold GROUP BY 1) a FULL JOIN
  (SELECT sentiment, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM gold WHERE date < DATE '2024-01-08') AS p
   FROM gold WHERE date < DATE '2024-01-08' GROUP BY 1) b USING (sentiment)""",
)
def sentiment_drift(spark, sf_dir):
    gold = corpus.gold(spark, sf_dir)
    drift = agg.sentiment_drift(gold, gold.filter(F.col("date") < "2024-01-08"))
    return _rounded(drift, "current_pct", "previous_pct", "delta")


@query(
    "corpus_profile",
    """WITH sized AS (SELECT 1)
SELECT 'label' AS section, sentiment AS name, count(*)::DOUBLE AS value FROM gold GROUP BY 2
UNION ALL SELECT 'canonical', sentiment, count(*) FROM gold GROUP BY 2
UNION ALL SELECT 'topic', topic_1, count(*) FROM gold WHERE topic_1 <> '' GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'source', source, count(*)::DOUBLE AS value FROM gold GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 8)
UNION ALL SELECT 'overall', 'rows', count(*) FROM gold
UNION ALL SELECT 'overall', 'alias_rows', 0
UNION ALL SELECT 'overall', 'distinct_topics', count(DISTINCT nullif(topic_1, '')) FROM gold
UNION ALL SELECT 'overall', 'fallback_rows', count(*) FILTER (WHERE topic_1 = 'autre') FROM gold
UNION ALL SELECT 'overall', 'mean_score', round(avg(sentiment_score), 10) FROM gold
UNION ALL SELECT 'overall', 'std_score', round(stddev_samp(sentiment_score), 10) FROM gold
UNION ALL SELECT 'ids', 'missing_ids', 0 UNION ALL SELECT 'ids', 'duplicate_ids', 0""",
)
def corpus_profile(spark, sf_dir):
    return _rounded(agg.corpus_profile(corpus.gold(spark, sf_dir)), "value")


@query("label_mapping", "SELECT sentiment, count(*) AS count, sentiment AS canonical FROM gold GROUP BY 1")
def label_mapping(spark, sf_dir):
    return agg.label_mapping(corpus.gold(spark, sf_dir))


_COVER = "round(avg(CASE WHEN topic_1 <> '' THEN 1.0::DOUBLE ELSE 0 END), 10)"


@query(
    "layer_profile",
    f"""SELECT 'raw' AS layer, count(*) AS rows, 12 AS columns, 0.0::DOUBLE AS sentiment_coverage, 0.0::DOUBLE AS topic_coverage FROM raw
UNION ALL SELECT 'silver', count(*), 16, 0.0, {_COVER} FROM silver
UNION ALL SELECT 'gold', count(*), 18, 1.0, {_COVER} FROM gold""",
)
def layer_profile(spark, sf_dir):
    layers = {
        "raw": corpus.raw(spark, sf_dir), "silver": corpus.silver(spark, sf_dir), "gold": corpus.gold(spark, sf_dir)
    }
    return _rounded(agg.layer_profile(layers), "sentiment_coverage", "topic_coverage")


@query(
    "flow_kpis",
    f"SELECT count(*) AS rows, 18 AS columns, 1.0::DOUBLE AS sentiment_coverage, {_COVER} AS topic_coverage, count(DISTINCT source) AS sources FROM gold",
)
def flow_kpis(spark, sf_dir):
    return _rounded(agg.flow_kpis(corpus.gold(spark, sf_dir)), "sentiment_coverage", "topic_coverage")


@query(
    "insight_facts",
    """SELECT (SELECT count(*) FROM gold) AS total, (SELECT round(avg(sentiment_score), 10) FROM gold) AS mean_score, l.sentiment AS dominant,
  round(l.n::DOUBLE / (SELECT count(*) FROM gold), 10) AS dominant_share,
  (SELECT topic_1 FROM gold WHERE topic_1 <> '' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_topic,
  (SELECT string_agg(source, ',' ORDER BY n DESC, source) FROM (SELECT source, count(*) AS n FROM gold GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3)) AS top_sources
  FROM (SELECT sentiment, count(*) AS n FROM gold GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1) l""",
)
def insight_facts(spark, sf_dir):
    return _rounded(agg.insight_facts(corpus.gold(spark, sf_dir)), "mean_score", "dominant_share")


@query(
    "source_mix",
    "SELECT source, count(*) AS count, round(count(*)::DOUBLE / (SELECT count(*) FROM gold), 10) AS share FROM gold GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 4",
)
def source_mix(spark, sf_dir):
    return _rounded(agg.source_mix(corpus.gold(spark, sf_dir)), "share")


@query(
    "risk_score",
    """SELECT round(s, 10) AS negative_share, CASE WHEN s >= 0.45 THEN 8 WHEN s >= 0.35 THEN 6 WHEN s >= 0.25 THEN 4 ELSE 2 END AS risk
  FROM (SELECT avg(CASE WHEN contains(lower(sentiment), 'neg') THEN 1.0::DOUBLE ELSE 0 END) AS s FROM gold)""",
)
def risk_score(spark, sf_dir):
    return _rounded(agg.risk_score(corpus.gold(spark, sf_dir)), "negative_share")


@query(
    "temporal_trend",
    """SELECT round(r, 10) AS score_recent, round(o, 10) AS score_old, CASE WHEN r > o + 0.05 THEN 'hausse' WHEN r < o - 0.05 THEN 'baisse' ELSE 'stable' END AS trend
  FROM (SELECT avg(sentiment_score) FILTER (WHERE epoch_us(collected_at) >= m) AS r, avg(sentiment_score) FILTER (WHERE epoch_us(collected_at) < m) AS o, count(*) AS n
  FROM gold, (SELECT quantile_cont(epoch_us(collected_at)::DOUBLE, 0.5) AS m FROM gold)) WHERE n >= 20""",
)
def temporal_trend(spark, sf_dir):
    return _rounded(agg.temporal_trend(corpus.gold(spark, sf_dir)), "score_recent", "score_old")


def _themes_sql(patterns, titles: int) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{theme}' AS theme, id, title, sentiment, sentiment_score FROM gold WHERE "
        + " OR ".join(f"contains(lower(title), '{p}')" for p in parts)
        for theme, parts in patterns.items()
    )
    return f"""WITH hit AS ({rows}) SELECT theme, count(*) AS count, round(avg(sentiment_score), 10) AS mean_score,
  (SELECT sentiment FROM hit h WHERE h.theme = t.theme GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS dominant_sentiment,
  (SELECT string_agg(title, ' | ' ORDER BY id) FROM (SELECT id, title FROM hit h WHERE h.theme = t.theme ORDER BY id LIMIT {titles})) AS sample_titles
  FROM hit t GROUP BY theme"""


@query("crisis_signals", _themes_sql(CRISIS_PATTERNS, 3))
def crisis_signals(spark, sf_dir):
    return _rounded(agg.crisis_signals(corpus.gold(spark, sf_dir), CRISIS_PATTERNS), "mean_score")


@query("event_signals", _themes_sql(EVENT_PATTERNS, 2))
def event_signals(spark, sf_dir):
    return _rounded(agg.event_signals(corpus.gold(spark, sf_dir), EVENT_PATTERNS), "mean_score")


@query(
    "event_signals_fallback",
    """WITH hit AS (SELECT * FROM gold WHERE topic_1 = 'sport') SELECT 'Sport (topic)' AS theme, count(*) AS count,
  round(avg(sentiment_score), 10) AS mean_score, (SELECT sentiment FROM hit GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS dominant_sentiment,
  (SELECT string_agg(title, ' | ' ORDER BY id) FROM (SELECT id, title FROM hit ORDER BY id LIMIT 2)) AS sample_titles FROM hit""",
)
def event_signals_fallback(spark, sf_dir):
    """Patterns that never match fall back to one bucket of the topic."""
    return _rounded(agg.event_signals(corpus.gold(spark, sf_dir), {"none": ("xyloph",)}), "mean_score")


_WEATHER = f"SELECT * FROM gold WHERE source IN {_in('weather')} OR lower(topic_1) = 'meteo' ORDER BY collected_at DESC, id DESC LIMIT 8"


def _bulletin(df):
    """Weather articles get bulletin titles so that city and temperature can be read back."""
    title = F.concat(
        F.lit("Bulletin meteo "), F.initcap("lang"), F.lit(": "), (F.length("content") % 40).cast("string"),
        F.lit(".5C - "), F.when(F.length("title") % 3 == 0, "ensoleille").otherwise("orages"),
    )
    return df.withColumn("title", title)


@query(
    "weather_block",
    f"""WITH w AS (SELECT *, row_number() OVER (ORDER BY collected_at DESC, id DESC) AS place,
  lower('Bulletin meteo ' || upper(lang[1]) || lang[2:] || ': ' || (length(content) % 40) || '.5C - ' ||
  CASE WHEN length(title) % 3 = 0 THEN 'ensoleille' ELSE 'orages' END) AS low FROM ({_WEATHER}))
SELECT count(*) AS weather_count, round(avg(sentiment_score), 10) AS weather_mean_score,
  string_agg(upper(lang[1]) || lang[2:], ',' ORDER BY place) FILTER (WHERE place <= 5) AS cities,
  round(avg(CAST(regexp_extract(low, '([\\d.]+)\\s*c', 1) AS DOUBLE)) FILTER (WHERE place <= 5), 10) AS avg_temp,
  count(*) FILTER (WHERE place <= 5 AND contains(low, 'orages')) AS alert_mentions,
  count(*) FILTER (WHERE place <= 5 AND contains(low, 'ensoleill')) >= 2 AND count(*) FILTER (WHERE place <= 5 AND contains(low, 'orages')) = 0 AS mild_regime
FROM w""",
)
def weather_block(spark, sf_dir):
    return _rounded(agg.weather_block(_bulletin(corpus.gold(spark, sf_dir))), "weather_mean_score", "avg_temp")


@query(
    "weather_week_overlap",
    f"""SELECT count(*) AS rows, round(avg(sentiment_score), 10) AS mean_score FROM gold, (SELECT max(collected_at) AS m FROM ({_WEATHER}))
  WHERE topic_1 = 'sante' AND collected_at BETWEEN m - INTERVAL 7 DAYS AND m""",
)
def weather_week_overlap(spark, sf_dir):
    gold = corpus.gold(spark, sf_dir)
    return _rounded(agg.weather_week_overlap(gold, filters.where_equal(gold, "topic_1", "sante")), "mean_score")


@query(
    "participation_vs_media",
    f"""SELECT * FROM (SELECT CASE WHEN source IN {_in('participatory')} THEN 'participatory' WHEN source IN {_in('media')} THEN 'media' ELSE 'other' END AS voice,
  count(*) AS count, round(avg(sentiment_score), 10) AS mean_score, round(count(*)::DOUBLE / (SELECT count(*) FROM gold), 10) AS share FROM gold GROUP BY 1) WHERE voice <> 'other'""",
)
def participation_vs_media(spark, sf_dir):
    return _rounded(agg.participation_vs_media(corpus.gold(spark, sf_dir)), "mean_score", "share")


@query(
    "economic_signal",
    f"""SELECT total, sentiment AS dominant, round(n::DOUBLE / total, 10) AS dominant_share FROM
  (SELECT sentiment, count(*) AS n, (SELECT count(*) FROM gold WHERE source IN {_in('economic')}) AS total FROM gold
   WHERE source IN {_in('economic')} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1) WHERE total >= 5""",
)
def economic_signal(spark, sf_dir):
    return _rounded(agg.economic_signal(corpus.gold(spark, sf_dir)), "dominant_share")


@query(
    "score_histogram",
    "SELECT CASE WHEN sentiment_score >= 1 THEN 21 ELSE floor(sentiment_score * 20)::BIGINT + 1 END AS bucket, count(*) AS count FROM gold GROUP BY 1",
)
def score_histogram(spark, sf_dir):
    return agg.score_histogram(corpus.gold(spark, sf_dir))


@query("mean_by_label", "SELECT sentiment, count(*) AS count, round(avg(sentiment_score), 10) AS mean_score FROM gold GROUP BY 1")
def mean_by_label(spark, sf_dir):
    return _rounded(agg.mean_by_label(corpus.gold(spark, sf_dir)), "mean_score")


@query(
    "latency_percentiles",
    """SELECT round(avg(value), 10) AS mean, round(quantile_cont(value, 0.5), 10) AS p50, round(quantile_cont(value, 0.9), 10) AS p90,
  round(quantile_cont(value, 0.99), 10) AS p99, max(value) AS max, round(avg(CASE WHEN value <= 300 THEN 1.0::DOUBLE ELSE 0 END), 10) AS within_limit FROM events""",
)
def latency_percentiles(spark, sf_dir):
    report = agg.latency_percentiles(corpus.events(spark, sf_dir), "value")
    return _rounded(report, "mean", "p50", "p90", "p99", "within_limit")


@query("latency_percentiles_approx")
def latency_percentiles_approx(spark, sf_dir):
    return agg.latency_percentiles_approx(corpus.events(spark, sf_dir), "value")


@query(
    "confidence_profile",
    """SELECT round(avg(confidence), 10) AS mean_confidence, round(avg(CASE WHEN confidence < 0.55 THEN 1.0::DOUBLE ELSE 0 END), 10) AS share_low,
  round(avg(CASE WHEN confidence > 0.75 THEN 1.0::DOUBLE ELSE 0 END), 10) AS share_high FROM latest_run""",
)
def confidence_profile(spark, sf_dir):
    return _rounded(agg.confidence_profile(corpus.latest_run(spark, sf_dir)), "mean_confidence", "share_low", "share_high")


@query(
    "topic_coherence",
    """WITH c AS (SELECT g.topic_1, p.predicted_sentiment AS s, count(*) AS n FROM latest_run p JOIN gold g ON CAST(g.id AS VARCHAR) = p.id GROUP BY 1, 2)
SELECT topic_1, sum(n)::BIGINT AS articles, (SELECT s FROM c d WHERE d.topic_1 = c.topic_1 ORDER BY n DESC, s LIMIT 1) AS dominant,
  round(max(n) / sum(n)::DOUBLE, 10) AS dominant_share FROM c GROUP BY topic_1 ORDER BY articles DESC, topic_1 LIMIT 5""",
)
def topic_coherence(spark, sf_dir):
    topics = corpus.gold(spark, sf_dir).select(F.col("id").cast("string").alias("id"), "topic_1")
    scored = corpus.latest_run(spark, sf_dir).select("id", "predicted_sentiment").join(topics, "id")
    return _rounded(agg.topic_coherence(scored), "dominant_share")
