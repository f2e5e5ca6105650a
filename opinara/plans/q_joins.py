"""Joins, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions.text import is_readable, is_valid
from opinara.operators import filters, layers, linkage, timeline, tracking
from opinara.operators.skew import top_per_group
from opinara.plans import corpus
from opinara.plans.oracle import readable, strip
from opinara.plans.registry import query

SPLIT_DAY = "2024-01-15"


def _day(column):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 10) for c in columns})


@query(
    "raw_with_source",
    """SELECT r.id, s.source_id, s.name, s.source_type, s.active FROM
  (SELECT id, CAST(regexp_extract(url, 'src(\\d+)', 1) AS BIGINT) AS source_id FROM raw) r JOIN sources s USING (source_id)""",
)
def raw_with_source(spark, sf_dir):
    number = F.regexp_extract("url", r"src(\d+)", 1).cast("bigint").alias("source_id")
    keyed = corpus.raw(spark, sf_dir).select("id", number)
    return layers.with_source(keyed, corpus.sources(spark, sf_dir)).select("id", "source_id", "name", "source_type", "active")


@query("silver_layer", "SELECT id, source, quality_score, topic_1, topic_1_score, topic_2, topic_2_score FROM silver")
def silver_layer(spark, sf_dir):
    rows = layers.silver(corpus.raw(spark, sf_dir), corpus.document_topic(spark, sf_dir))
    return rows.select("id", "source", "quality_score", "topic_1", "topic_1_score", "topic_2", "topic_2_score")


_VALID = "length(trim(title)) > 3 AND length(trim(content)) > 10"


@query(
    "dedup_insert",
    f"""SELECT id, fingerprint FROM (SELECT * FROM landed WHERE date >= DATE '{SPLIT_DAY}' AND {_VALID}
  QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY id) = 1) n
  WHERE NOT EXISTS (SELECT 1 FROM landed o WHERE o.date < DATE '{SPLIT_DAY}' AND o.fingerprint = n.fingerprint)""",
)
def dedup_insert(spark, sf_dir):
    landed = corpus.landed(spark, sf_dir)
    incoming = landed.filter(F.col("date") >= SPLIT_DAY).filter(is_valid(F.col("title"), F.col("content")))
    return linkage.new_articles(incoming, landed.filter(F.col("date") < SPLIT_DAY)).select("id", "fingerprint")


@query(
    "merge_overlap",
    f"""WITH n AS (SELECT DISTINCT fingerprint FROM landed WHERE date >= DATE '{SPLIT_DAY}'),
  e AS (SELECT DISTINCT fingerprint FROM landed WHERE date < DATE '{SPLIT_DAY}')
  SELECT (SELECT count(*) FROM n) AS new_ids, (SELECT count(*) FROM e) AS existing_ids,
  (SELECT count(*) FROM n JOIN e USING (fingerprint)) AS shared_ids""",
)
def merge_overlap(spark, sf_dir):
    landed = layers.harmonize_id(corpus.landed(spark, sf_dir))
    return layers.merge_overlap(landed.filter(F.col("date") >= SPLIT_DAY), landed.filter(F.col("date") < SPLIT_DAY))


@query(
    "new_rows_preview",
    f"""SELECT n.fingerprint AS id, n.title FROM landed n WHERE n.date >= DATE '{SPLIT_DAY}'
  AND NOT EXISTS (SELECT 1 FROM landed o WHERE o.date < DATE '{SPLIT_DAY}' AND o.fingerprint = n.fingerprint)""",
)
def new_rows_preview(spark, sf_dir):
    landed = corpus.landed(spark, sf_dir)
    merged = layers.harmonize_id(landed.filter(F.col("date") < SPLIT_DAY))
    return layers.new_rows(landed.filter(F.col("date") >= SPLIT_DAY), merged).select("id", "title")


def _enriched_sql(run: str, fill: bool) -> str:
    label = "coalesce(p.predicted_sentiment, g.sentiment)" if fill else "p.predicted_sentiment"
    score = "coalesce(p.predicted_sentiment_score, g.sentiment_score)" if fill else "p.predicted_sentiment_score"
    return f"""SELECT '{run}' AS run, CAST(g.id AS VARCHAR) AS id, {label} AS sentiment, {score} AS sentiment_score
  FROM gold g LEFT JOIN (SELECT * FROM predictions WHERE run = '{run}') p ON p.id = CAST(g.id AS VARCHAR)"""


@query("enriched_articles", f"{_enriched_sql(corpus.RUN_2, False)} UNION ALL {_enriched_sql(corpus.RUN_3, True)}")
def enriched_articles(spark, sf_dir):
    """A complete run needs no legacy label; the small run falls under the floor and is filled."""
    gold = corpus.gold(spark, sf_dir)
    articles = filters.app_input(gold.select("id", "source", "title", "sentiment"))
    legacy = gold.select("id", "sentiment", "sentiment_score")
    frames = []
    for run in (corpus.RUN_2, corpus.RUN_3):
        predictions = corpus.predictions(spark, sf_dir).filter(F.col("run") == run)
        rows = linkage.enriched_articles(articles, predictions, legacy, ["date", "run"])
        frames.append(rows.select(F.lit(run).alias("run"), "id", "sentiment", "sentiment_score"))
    return frames[0].unionByName(frames[1])


@query(
    "predictions_with_context",
    """SELECT p.id, p.predicted_sentiment, p.title, g.source, g.topic_1 FROM latest_run p
  LEFT JOIN gold g ON CAST(g.id AS VARCHAR) = p.id""",
)
def predictions_with_context(spark, sf_dir):
    scored = corpus.latest_run(spark, sf_dir).select("id", "predicted_sentiment", "title")
    return linkage.predictions_with_context(scored, corpus.gold(spark, sf_dir).select("id", "title", "source", "topic_1"))


_STRONG = """strong AS (SELECT id, predicted_sentiment FROM predictions WHERE confidence >= 0.7
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY date DESC, run DESC) = 1),
  boot AS (SELECT CAST(g.id AS VARCHAR) AS id, coalesce(s.predicted_sentiment, g.sentiment) AS sentiment_label,
  coalesce(s.predicted_sentiment, g.sentiment) AS sentiment, CASE WHEN s.id IS NULL THEN 'lexical' ELSE 'ml_model' END AS label_source
  FROM gold g LEFT JOIN strong s ON s.id = CAST(g.id AS VARCHAR))"""


def _bootstrapped(spark, sf_dir):
    labelled = corpus.gold(spark, sf_dir).select("id", "sentiment", F.col("sentiment").alias("sentiment_label"))
    return labelled, linkage.bootstrap_labels(labelled, corpus.predictions(spark, sf_dir))


@query("bootstrap_labels", f"WITH {_STRONG} SELECT id, sentiment, sentiment_label, label_source FROM boot")
def bootstrap_labels(spark, sf_dir):
    return _bootstrapped(spark, sf_dir)[1].select("id", "sentiment", "sentiment_label", "label_source")


@query(
    "bootstrap_report",
    f"""WITH {_STRONG}, o AS (SELECT sentiment AS value, count(*) AS b FROM gold GROUP BY 1),
  n AS (SELECT sentiment_label AS value, count(*) AS a, count(*) FILTER (WHERE label_source = 'ml_model') AS r FROM boot GROUP BY 1)
  SELECT value, coalesce(b, 0) AS before, coalesce(a, 0) AS after, coalesce(a, 0) - coalesce(b, 0) AS delta, coalesce(r, 0) AS replaced
  FROM o FULL JOIN n USING (value)""",
)
def bootstrap_report(spark, sf_dir):
    from opinara.operators.aggregates import before_after

    old, new = _bootstrapped(spark, sf_dir)
    replaced = new.groupBy(F.col("sentiment_label").alias("value")).agg(F.count_if(F.col("label_source") == "ml_model").alias("replaced"))
    return before_after(old, new, "sentiment_label").join(replaced, "value", "left").na.fill(0, ["replaced"])


def _tables(spark, sf_dir):
    return corpus.raw(spark, sf_dir), corpus.document_topic(spark, sf_dir), corpus.model_output(spark, sf_dir)


_KW = "(SELECT DISTINCT raw_data_id FROM model_output WHERE model_name = 'sentiment_keyword')"


@query(
    "enriched_count",
    f"SELECT count(*) AS enriched FROM raw WHERE id IN (SELECT raw_data_id FROM document_topic) AND id IN {_KW}",
)
def enriched_count(spark, sf_dir):
    return tracking.enriched_count(*_tables(spark, sf_dir))


_FLAGS = f"""flags AS (SELECT r.*, CASE WHEN t.raw_data_id IS NULL THEN 0 ELSE 1 END AS tagged, CASE WHEN m.raw_data_id IS NULL THEN 0 ELSE 1 END AS analysed
  FROM raw r LEFT JOIN (SELECT DISTINCT raw_data_id FROM document_topic) t ON t.raw_data_id = r.id LEFT JOIN {_KW} m ON m.raw_data_id = r.id)"""


@query("enrichment_backlog", f"WITH {_FLAGS} SELECT id, tagged, analysed FROM flags WHERE tagged = 0 OR analysed = 0")
def enrichment_backlog(spark, sf_dir):
    return tracking.enrichment_backlog(*_tables(spark, sf_dir)).select("id", "tagged", "analysed")


@query("new_today_by_source", "SELECT source AS name, count(*) AS added FROM raw WHERE date = DATE '2024-01-10' GROUP BY 1")
def new_today_by_source(spark, sf_dir):
    return tracking.new_by_source(corpus.sources(spark, sf_dir), corpus.raw(spark, sf_dir), "2024-01-10")


@query(
    "retention_purge",
    """WITH kept AS (SELECT id FROM raw WHERE collected_at >= TIMESTAMP '2024-01-23')
  SELECT 'raw' AS name, count(*) AS rows FROM kept
  UNION ALL SELECT 'document_topic', count(*) FROM document_topic WHERE raw_data_id IN (SELECT id FROM kept)
  UNION ALL SELECT 'model_output', count(*) FROM model_output WHERE raw_data_id IN (SELECT id FROM kept)""",
)
def retention_purge(spark, sf_dir):
    kept = tracking.retention_purge(*_tables(spark, sf_dir), keep_days=7, today="2024-01-30")
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, df in zip(("raw", "document_topic", "model_output"), kept, strict=True)
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "source_deltas",
    """WITH c AS (SELECT source, count(*) AS n FROM raw WHERE date >= DATE '2024-01-20' GROUP BY 1),
  p AS (SELECT source, count(*) AS n FROM raw WHERE date < DATE '2024-01-11' GROUP BY 1)
  SELECT source, c.n AS current, coalesce(p.n, 0) AS previous, c.n - coalesce(p.n, 0) AS delta FROM c LEFT JOIN p USING (source)
  WHERE c.n <> coalesce(p.n, 0)""",
)
def source_deltas(spark, sf_dir):
    raw = corpus.raw(spark, sf_dir)

    def counted(rows):
        return rows.groupBy("source").agg(F.count("*").alias("articles"))

    return tracking.source_deltas(counted(raw.filter("date >= '2024-01-20'")), counted(raw.filter("date < '2024-01-11'")))


_MERGED = "merged AS (SELECT *, CASE WHEN source = 'kaggle_reviews' THEN NULL ELSE id END AS raw_data_id FROM landed)"


def _merged(spark, sf_dir):
    """All-dates table that still holds copies and rows without a stored id."""
    keep = F.when(F.col("source") != "kaggle_reviews", F.col("id"))
    return corpus.landed(spark, sf_dir).withColumn("raw_data_id", keep)


_LINK = """SELECT count(*) AS rows, count(raw_data_id) AS with_id, count(*) - count(raw_data_id) AS without_id, count(r.id) AS in_raw,
  count(raw_data_id) - count(r.id) AS not_in_raw, round_even(count(raw_data_id)::DOUBLE / count(*), 10) AS coverage
  FROM merged m LEFT JOIN (SELECT id FROM raw) r ON r.id = m.raw_data_id"""


@query("linkage_coverage", f"WITH {_MERGED} {_LINK}")
def linkage_coverage(spark, sf_dir):
    return tracking.linkage_coverage(_merged(spark, sf_dir), corpus.raw(spark, sf_dir))


@query(
    "row_trace",
    """WITH w AS (SELECT fingerprint FROM landed WHERE lang = 'es'),
  a AS (SELECT fingerprint FROM landed WHERE fingerprint IN (SELECT fingerprint FROM w)),
  b AS (SELECT fingerprint FROM raw WHERE fingerprint IN (SELECT fingerprint FROM w)),
  c AS (SELECT fingerprint FROM gold WHERE date < DATE '2024-01-20' AND fingerprint IN (SELECT fingerprint FROM w))
  SELECT 'landed' AS layer, count(*) AS hits FROM a UNION ALL SELECT 'raw', count(*) FROM b UNION ALL SELECT 'gold', count(*) FROM c
  UNION ALL SELECT 'all', count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b INTERSECT SELECT * FROM c)""",
)
def row_trace(spark, sf_dir):
    landed = corpus.landed(spark, sf_dir)
    wanted = landed.filter("lang = 'es'").select("fingerprint")
    traced = {"landed": landed, "raw": corpus.raw(spark, sf_dir), "gold": corpus.gold(spark, sf_dir).filter("date < '2024-01-20'")}
    return tracking.row_trace(traced, wanted)


@query(
    "audit_journal",
    """SELECT a.action_log_id, a.action_type, c.username, c.role FROM audit_log a LEFT JOIN accounts c USING (profil_id)
  WHERE c.role = 'MACHINERY' ORDER BY a.action_date DESC, a.action_log_id DESC LIMIT 100""",
)
def audit_journal(spark, sf_dir):
    rows = tracking.audit_journal(corpus.audit_log(spark, sf_dir), corpus.accounts(spark, sf_dir), "MACHINERY")
    return rows.select("action_log_id", "action_type", "username", "role")


@query(
    "article_journey",
    """WITH n AS (SELECT * FROM raw WHERE date = DATE '2024-01-12' ORDER BY id DESC LIMIT 60)
  SELECT n.id, n.source, (SELECT topic FROM document_topic d WHERE d.raw_data_id = n.id ORDER BY confidence_score DESC, doc_topic_id LIMIT 1) AS topic_1,
  (SELECT topic FROM document_topic d WHERE d.raw_data_id = n.id ORDER BY confidence_score, doc_topic_id LIMIT 1) AS topic_2,
  o.sentiment, o.sentiment_score FROM n LEFT JOIN latest_output o USING (id)""",
)
def article_journey(spark, sf_dir):
    rows = tracking.article_journey(*_tables(spark, sf_dir), day="2024-01-12")
    return rows.select("id", "source", "topic_1", "topic_2", "sentiment", "sentiment_score")


@query(
    "gold_wide",
    """SELECT r.id, t.topics, o.model_name, o.label, o.score, strftime(r.collected_at, '%Y-%m-%d') AS partition_date FROM raw r
  LEFT JOIN (SELECT raw_data_id, string_agg(topic, '|' ORDER BY confidence_score DESC, doc_topic_id) AS topics FROM document_topic GROUP BY 1) t ON t.raw_data_id = r.id
  LEFT JOIN (SELECT * FROM model_output QUALIFY row_number() OVER (PARTITION BY raw_data_id ORDER BY output_id DESC) = 1) o ON o.raw_data_id = r.id""",
)
def gold_wide(spark, sf_dir):
    rows = layers.gold_wide(*_tables(spark, sf_dir))
    return rows.select("id", "topics", "model_name", "label", "score", "partition_date")


# Catalogue of ad-hoc questions: one text for both engines.
CATALOGUE = {
    "catalogue_q01": """SELECT r.id, r.source, r.title, m.label AS sentiment, m.score AS sentiment_score FROM {raw} r LEFT JOIN {model_output} m
  ON m.raw_data_id = r.id AND m.model_name = 'sentiment_keyword' ORDER BY r.collected_at DESC, r.id DESC, m.output_id DESC LIMIT 20""",
    "catalogue_q02": """SELECT label AS sentiment, COUNT(*) AS count, ROUND(AVG(score), 10) AS avg_score FROM {model_output}
  WHERE model_name = 'sentiment_keyword' GROUP BY label ORDER BY count DESC""",
    "catalogue_q03": """SELECT r.id, r.source, m.score AS sentiment_score, m.output_id FROM {raw} r JOIN {model_output} m ON m.raw_data_id = r.id
  WHERE m.model_name = 'sentiment_keyword' AND m.label = 'positif' ORDER BY m.score DESC, m.output_id LIMIT 20""",
    "catalogue_q04": """SELECT r.id, r.source, m.score AS sentiment_score, m.output_id FROM {raw} r JOIN {model_output} m ON m.raw_data_id = r.id
  WHERE m.model_name = 'sentiment_keyword' AND m.label = 'negatif' ORDER BY m.score DESC, m.output_id LIMIT 20""",
    "catalogue_q05": """SELECT r.id, r.source, t.name AS topic, d.confidence_score FROM {raw} r JOIN {document_topic} d ON d.raw_data_id = r.id
  JOIN {topics} t ON t.name = d.topic ORDER BY d.confidence_score DESC, d.doc_topic_id LIMIT 20""",
    "catalogue_q06": """SELECT r.id, r.source, d.topic AS topic_1, d.confidence_score AS topic_1_score, m.label AS sentiment FROM {raw} r
  LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY raw_data_id ORDER BY confidence_score DESC, doc_topic_id) AS rn FROM {document_topic}) d
  ON d.raw_data_id = r.id AND d.rn = 1 LEFT JOIN {model_output} m ON m.raw_data_id = r.id AND m.model_name = 'sentiment_keyword'
  ORDER BY r.collected_at DESC, r.id DESC, m.output_id DESC LIMIT 20""",
    "catalogue_q07": """SELECT s.name AS source, COUNT(DISTINCT r.id) AS total_articles, COUNT(DISTINCT CASE WHEN m.label = 'positif' THEN r.id END) AS positifs,
  COUNT(DISTINCT CASE WHEN m.label = 'negatif' THEN r.id END) AS negatifs, COUNT(DISTINCT CASE WHEN m.label = 'neutre' THEN r.id END) AS neutres
  FROM {sources} s LEFT JOIN {raw} r ON r.source = s.name LEFT JOIN {model_output} m ON m.raw_data_id = r.id AND m.model_name = 'sentiment_keyword' GROUP BY s.name""",
    "catalogue_q08": """SELECT t.name AS topic, COUNT(d.raw_data_id) AS count, ROUND(AVG(d.confidence_score), 10) AS avg_confidence
  FROM {topics} t LEFT JOIN {document_topic} d ON d.topic = t.name GROUP BY t.name""",
    "catalogue_q09": """SELECT r.id, r.source, m.label AS sentiment, m.output_id FROM {raw} r LEFT JOIN {model_output} m ON m.raw_data_id = r.id
  AND m.model_name = 'sentiment_keyword' WHERE r.date = (SELECT MAX(date) FROM {raw})""",
    "catalogue_q10": """SELECT r.id, r.source, m.label AS sentiment, m.score AS sentiment_score, m.output_id FROM {raw} r JOIN {model_output} m ON m.raw_data_id = r.id
  WHERE m.model_name = 'sentiment_keyword' AND m.label <> 'neutre' ORDER BY m.score DESC, m.output_id LIMIT 30""",
}
_NAMES = ("raw", "sources", "document_topic", "model_output", "topics")


def _catalogue(text: str):
    def run(spark, sf_dir):
        frames = {name: getattr(corpus, name) for name in _NAMES if f"{{{name}}}" in text}
        return spark.sql(text, **{n: f(spark) if n == "topics" else f(spark, sf_dir) for n, f in frames.items()})

    return run


for _slug, _text in CATALOGUE.items():
    query(_slug, _text.format(**{name: name for name in _NAMES}))(_catalogue(_text))


@query(
    "merge_dedup",
    """SELECT fingerprint AS id, max(id) AS raw_id FROM (SELECT fingerprint, id, row_number() OVER (PARTITION BY fingerprint ORDER BY collected_at DESC, id DESC) AS rn
  FROM landed) WHERE rn = 1 GROUP BY 1""",
)
def merge_dedup(spark, sf_dir):
    rows = corpus.landed(spark, sf_dir).withColumn("raw_id", F.col("id"))
    return layers.merge_dedup(layers.harmonize_id(rows)).select("id", "raw_id")


@query("topic_rank", "SELECT raw_data_id, topic, rank FROM topic_ranked")
def topic_rank(spark, sf_dir):
    return layers.topic_rank(corpus.document_topic(spark, sf_dir)).select("raw_data_id", "topic", "rank")


@query("latest_output", "SELECT id, sentiment, sentiment_score FROM latest_output")
def latest_output(spark, sf_dir):
    return layers.latest_output(corpus.model_output(spark, sf_dir))


@query(
    "source_volume_delta",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY sync_date DESC, sync_log_id DESC) AS rn FROM sync_log WHERE status = 'OK'),
  p AS (SELECT source_id, max(rows_synced) FILTER (WHERE rn = 1) AS now, coalesce(max(rows_synced) FILTER (WHERE rn = 2), 0) AS previous FROM r WHERE rn <= 2 GROUP BY 1)
  SELECT *, round(CASE WHEN previous > 0 THEN (now - previous) * 100.0::DOUBLE / previous END, 10) AS delta_pct,
  CASE WHEN previous > 0 AND now = 0 THEN 'no volume' WHEN previous > 0 AND (now - previous) * 100.0 / previous <= -80 THEN 'volume drop' END AS anomaly FROM p""",
)
def source_volume_delta(spark, sf_dir):
    return _rounded(timeline.source_volume_delta(corpus.sync_log(spark, sf_dir)), "delta_pct")


@query(
    "cumulative_rows",
    "SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS rows, CAST(sum(count(*)) OVER (ORDER BY date) AS BIGINT) AS total FROM gold GROUP BY gold.date",
)
def cumulative_rows(spark, sf_dir):
    return timeline.cumulative_rows(corpus.gold(spark, sf_dir).select("date")).select(_day("date"), "rows", "total")



@query(
    "runs_by_day",
    """WITH seen AS (SELECT CAST(generated_at AS DATE) AS day, reason, min(generated_at) AS g, min(i) AS i FROM
  (SELECT generated_at, unnest(reasons) AS reason, unnest(range(1, len(reasons) + 1)) AS i FROM runs) GROUP BY 1, 2)
  SELECT strftime(d.day, '%Y-%m-%d') AS day, d.loaded, d.status, d.run_count,
  coalesce((SELECT string_agg(reason, '; ' ORDER BY g, i) FROM seen s WHERE s.day = d.day), '') AS reasons
  FROM (SELECT CAST(generated_at AS DATE) AS day, CAST(sum(loaded) AS BIGINT) AS loaded, max(status) AS status, count(*) AS run_count FROM runs GROUP BY 1) d""",
)
def runs_by_day(spark, sf_dir):
    rows = timeline.runs_by_day(corpus.runs(spark, sf_dir))
    return rows.select(_day("day"), "loaded", "status", "run_count", "reasons")


@query(
    "runs_by_day_alerts",
    "SELECT strftime(CAST(generated_at AS DATE), '%Y-%m-%d') AS day, CAST(sum(loaded) AS BIGINT) AS loaded, count(*) AS run_count FROM runs WHERE status = 'WARN' GROUP BY 1",
)
def runs_by_day_alerts(spark, sf_dir):
    rows = timeline.runs_by_day(corpus.runs(spark, sf_dir), only_alerts=True)
    return rows.select(_day("day"), "loaded", "run_count")


@query(
    "run_calendar",
    """WITH d AS (SELECT CAST(generated_at AS DATE) AS day, CAST(sum(loaded) AS BIGINT) AS loaded, max(status) AS status, count(*) AS run_count FROM runs WHERE loaded >= 1000 GROUP BY 1),
  c AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM d), (SELECT max(day) FROM d), INTERVAL 1 DAY)) AS DATE) AS day),
  f AS (SELECT c.day, coalesce(d.loaded, 0) AS loaded, coalesce(d.status, 'ABSENT') AS status, coalesce(d.run_count, 0) AS run_count FROM c LEFT JOIN d USING (day))
  SELECT strftime(day, '%Y-%m-%d') AS day, loaded, status, run_count,
  coalesce(lag(status) OVER (ORDER BY day) = 'ABSENT' AND status <> 'ABSENT' AND loaded > 0, false) AS catch_up FROM f""",
)
def run_calendar(spark, sf_dir):
    """Only runs that loaded much count as runs here, so that absent days occur."""
    by_day = timeline.runs_by_day(corpus.runs(spark, sf_dir).filter("loaded >= 1000"))
    return timeline.run_calendar(by_day).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "growth_timeline",
    """SELECT strftime(CAST(generated_at AS DATE), '%Y-%m-%d') AS day, loaded, status FROM runs
  QUALIFY row_number() OVER (PARTITION BY CAST(generated_at AS DATE) ORDER BY generated_at DESC) = 1""",
)
def growth_timeline(spark, sf_dir):
    return timeline.growth_timeline(corpus.runs(spark, sf_dir)).select(_day("day"), "loaded", "status")


@query(
    "pareto_frontier",
    """SELECT event_id, event_type, value, k FROM (SELECT *, max(k) OVER (PARTITION BY event_type ORDER BY value, k DESC, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))
  WHERE best IS NULL OR k > best""",
)
def pareto_frontier(spark, sf_dir):
    scored = corpus.events(spark, sf_dir).select(
        "event_id", "event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k")
    )
    return timeline.pareto_frontier(scored, "event_type", "value", "k", "event_id")


@query("recent_titles", "SELECT id, title FROM gold ORDER BY collected_at DESC, id DESC LIMIT 7")
def recent_titles(spark, sf_dir):
    return corpus.gold(spark, sf_dir).orderBy(F.desc("collected_at"), F.desc("id")).limit(7).select("id", "title")


@query(
    "first_topic_dist",
    "SELECT topic, count(*) AS articles FROM (SELECT topic FROM document_topic QUALIFY row_number() OVER (PARTITION BY raw_data_id ORDER BY doc_topic_id) = 1) GROUP BY 1",
)
def first_topic_dist(spark, sf_dir):
    return tracking.first_topic_dist(corpus.document_topic(spark, sf_dir))


@query("top_articles", "SELECT id, sentiment_score FROM gold ORDER BY sentiment_score DESC, id DESC LIMIT 10")
def top_articles(spark, sf_dir):
    from opinara.operators.ordering import top_articles as top

    return top(corpus.gold(spark, sf_dir).select("id", "sentiment_score"), 10)


@query("newest_of_day", "SELECT id, title FROM raw WHERE date = DATE '2024-01-12' ORDER BY id DESC LIMIT 400")
def newest_of_day(spark, sf_dir):
    from opinara.operators.ordering import newest_of_day as newest

    return newest(corpus.raw(spark, sf_dir).select("id", "title", "date"), "2024-01-12").select("id", "title")


@query("rows_since", "SELECT id, source FROM raw WHERE id > 500 ORDER BY id LIMIT 200")
def rows_since(spark, sf_dir):
    from opinara.operators.ordering import rows_since as since

    return since(corpus.raw(spark, sf_dir).select("id", "source"), 500)


@query(
    "readable_samples",
    f"""SELECT id, source, readable, source_place, title_length FROM (SELECT id, source, {readable('t')} OR {readable('c')} AS readable,
  CASE WHEN source IN ('gdelt_events', 'GDELT_Last15_English') THEN 99 WHEN source = 'reddit_france' THEN 0 WHEN source = 'yahoo_finance' THEN 1 ELSE 50 END AS source_place,
  topic_1 <> '' AND sentiment <> '' AS enriched, length(trim(title)) AS title_length
  FROM (SELECT *, {strip('title')} AS t, {strip('content')} AS c FROM gold))
  ORDER BY readable DESC, source_place, enriched DESC, title_length DESC, id LIMIT 20""",
)
def readable_samples(spark, sf_dir):
    gold = corpus.gold(spark, sf_dir)
    legible = is_readable(F.col("title")) | is_readable(F.col("content"))
    return tracking.readable_rank(gold, legible, ("reddit_france", "yahoo_finance"), ("gdelt_events", "GDELT_Last15_English"), 20).select(
        "id", "source", "readable", "source_place", "title_length"
    )


@query(
    "samples_per_label",
    "SELECT sentiment, id, title FROM gold QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY sentiment_score DESC, id) <= 3",
)
def samples_per_label(spark, sf_dir):
    rows = corpus.gold(spark, sf_dir).select("sentiment", "id", "title", "sentiment_score")
    return top_per_group(rows, ["sentiment"], [F.desc("sentiment_score"), F.col("id")], 3, "id").drop("sentiment_score")


@query(
    "latest_prediction_run",
    "SELECT strftime(date, '%Y-%m-%d') AS date, run, count(*) AS rows FROM predictions GROUP BY predictions.date, run ORDER BY predictions.date DESC, rows DESC LIMIT 1",
)
def latest_prediction_run(spark, sf_dir):
    from opinara.operators.ordering import latest_run

    return latest_run(corpus.predictions(spark, sf_dir)).select(_day("date"), "run", "rows")


@query(
    "union_layers",
    """SELECT id, source, NULL AS topic_1, NULL AS sentiment FROM raw UNION ALL SELECT id, source, topic_1, NULL FROM silver
  UNION ALL SELECT id, source, topic_1, sentiment FROM gold""",
)
def union_layers(spark, sf_dir):
    merged = layers.union_layers(corpus.raw(spark, sf_dir), corpus.silver(spark, sf_dir), corpus.gold(spark, sf_dir))
    return merged.select("id", "source", "topic_1", "sentiment")


@query(
    "dates_to_merge",
    f"SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date FROM gold WHERE gold.date >= DATE '{SPLIT_DAY}'",
)
def dates_to_merge(spark, sf_dir):
    gold = corpus.gold(spark, sf_dir)
    return layers.new_dates(gold, gold.filter(F.col("date") < SPLIT_DAY)).select(_day("date"))
