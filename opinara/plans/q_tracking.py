"""Coverage, lineage, coherence and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import text
from opinara.operators import tracking
from opinara.operators.aggregates import before_after
from opinara.operators.timeline import source_volume_delta
from opinara.plans import corpus
from opinara.plans.q_joins import _FLAGS, _KW, _LINK, _MERGED, _merged, _rounded, _tables
from opinara.plans.registry import query

DAY = "2024-01-12"


def _stamp(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


@query(
    "by_source_stats",
    """SELECT s.name, count(r.id) AS total, count(DISTINCT r.fingerprint) AS unique_articles, strftime(max(r.collected_at), '%Y-%m-%d %H:%M:%S') AS last_collected
  FROM sources s LEFT JOIN landed r ON r.source = s.name GROUP BY s.name""",
)
def by_source_stats(spark, sf_dir):
    rows = tracking.by_source_stats(corpus.sources(spark, sf_dir), corpus.landed(spark, sf_dir))
    return rows.select("name", "total", "unique_articles", _stamp("last_collected"))


@query(
    "topic_coverage",
    "SELECT count(DISTINCT raw_data_id) AS tagged_articles, count(DISTINCT topic) AS topics_used, round(avg(confidence_score), 10) AS avg_confidence FROM document_topic",
)
def topic_coverage(spark, sf_dir):
    return _rounded(tracking.topic_coverage(corpus.document_topic(spark, sf_dir)), "avg_confidence")


@query(
    "sentiment_stats",
    "SELECT label, count(*) AS count, round(avg(score), 10) AS avg_score FROM model_output WHERE model_name = 'sentiment_keyword' GROUP BY 1",
)
def sentiment_stats(spark, sf_dir):
    return _rounded(tracking.sentiment_stats(corpus.model_output(spark, sf_dir)), "avg_score")


@query(
    "topic_dist",
    "SELECT t.name, count(d.raw_data_id) AS count, round(avg(d.confidence_score), 10) AS avg_confidence FROM topics t LEFT JOIN document_topic d ON d.topic = t.name GROUP BY 1",
)
def topic_dist(spark, sf_dir):
    return _rounded(tracking.topic_distribution(corpus.topics(spark), corpus.document_topic(spark, sf_dir)), "avg_confidence")


@query("unique_articles", "SELECT count(*) AS total, count(DISTINCT fingerprint) AS distinct_fingerprints FROM landed")
def unique_articles(spark, sf_dir):
    return tracking.unique_articles(corpus.landed(spark, sf_dir))


@query(
    "synthetic_status",
    "SELECT s.name, s.active, count(r.id) AS articles FROM sources s LEFT JOIN raw r ON r.source = s.name WHERE lower(s.name) LIKE 'zzdb%' GROUP BY 1, 2",
)
def synthetic_status(spark, sf_dir):
    return tracking.synthetic_status(corpus.sources(spark, sf_dir), corpus.raw(spark, sf_dir))


_BY_SOURCE = """SELECT source, count(*) AS collected, CAST(sum(tagged) AS BIGINT) AS tagged, CAST(sum(analysed) AS BIGINT) AS analysed,
  CAST(sum(tagged * analysed) AS BIGINT) AS enriched FROM flags"""


@query("session_report", f"WITH {_FLAGS} {_BY_SOURCE} WHERE collected_at >= TIMESTAMP '2024-01-25' GROUP BY 1")
def session_report(spark, sf_dir):
    return tracking.session_report(*_tables(spark, sf_dir), start="2024-01-25 00:00:00")


@query("enrichment_by_source", f"WITH {_FLAGS} {_BY_SOURCE} WHERE date = DATE '2024-01-29' GROUP BY 1")
def enrichment_by_source(spark, sf_dir):
    raw, links, outputs = _tables(spark, sf_dir)
    return tracking.enrichment_by_source(raw.filter("date = '2024-01-29'"), links, outputs)


@query(
    "source_sentiment_pivot",
    """SELECT s.name, count(DISTINCT r.id) AS total_articles, count(DISTINCT r.id) FILTER (WHERE m.label = 'positif') AS positifs,
  count(DISTINCT r.id) FILTER (WHERE m.label = 'negatif') AS negatifs, count(DISTINCT r.id) FILTER (WHERE m.label = 'neutre') AS neutres
  FROM sources s LEFT JOIN raw r ON r.source = s.name LEFT JOIN model_output m ON m.raw_data_id = r.id AND m.model_name = 'sentiment_keyword' GROUP BY 1""",
)
def source_sentiment_pivot(spark, sf_dir):
    raw, _, outputs = _tables(spark, sf_dir)
    return tracking.source_sentiment_pivot(corpus.sources(spark, sf_dir), raw, outputs)


_LINEAGE = f"""SELECT s.name AS source, coalesce(c.n, 0) AS collected, coalesce(a.n, 0) AS added, greatest(coalesce(c.n, 0) - coalesce(a.n, 0), 0) AS duplicates
  FROM sources s LEFT JOIN (SELECT source_id, CAST(sum(rows_synced) AS BIGINT) AS n FROM sync_log WHERE CAST(sync_date AS DATE) = DATE '{DAY}' AND status = 'OK' GROUP BY 1) c USING (source_id)
  LEFT JOIN (SELECT source, count(*) AS n FROM raw WHERE date = DATE '{DAY}' GROUP BY 1) a ON a.source = s.name WHERE coalesce(c.n, 0) > 0 OR coalesce(a.n, 0) > 0"""


def _lineage(spark, sf_dir):
    return tracking.daily_lineage(corpus.sources(spark, sf_dir), corpus.raw(spark, sf_dir), corpus.sync_log(spark, sf_dir), DAY)


@query("daily_lineage", _LINEAGE)
def daily_lineage(spark, sf_dir):
    return _lineage(spark, sf_dir)


@query(
    "daily_totals",
    f"""SELECT b AS before, a AS added, c AS collected, b + a AS after, greatest(c - a, 0) AS duplicates FROM
  (SELECT count(*) FILTER (WHERE date < DATE '{DAY}') AS b, count(*) FILTER (WHERE date = DATE '{DAY}') AS a,
  (SELECT CAST(sum(rows_synced) AS BIGINT) FROM sync_log WHERE CAST(sync_date AS DATE) = DATE '{DAY}' AND status = 'OK') AS c FROM raw)""",
)
def daily_totals(spark, sf_dir):
    return tracking.day_totals(corpus.raw(spark, sf_dir), corpus.sync_log(spark, sf_dir), DAY)


@query(
    "layer_totals",
    f"""SELECT 'raw' AS layer, count(*) AS rows FROM raw UNION ALL SELECT 'tagged', count(DISTINCT raw_data_id) FROM document_topic
  UNION ALL SELECT 'scored', count(*) FROM {_KW} UNION ALL SELECT 'merged', count(*) FROM gold""",
)
def layer_totals(spark, sf_dir):
    return tracking.layer_totals(*_tables(spark, sf_dir), merged=corpus.gold(spark, sf_dir))


@query(
    "lineage_history",
    """SELECT strftime(c.day, '%Y-%m-%d') AS day, c.n AS collected, coalesce(a.n, 0) AS added, greatest(c.n - coalesce(a.n, 0), 0) AS duplicates FROM
  (SELECT CAST(sync_date AS DATE) AS day, CAST(sum(rows_synced) AS BIGINT) AS n FROM sync_log WHERE status = 'OK' GROUP BY 1) c
  LEFT JOIN (SELECT date AS day, count(*) AS n FROM raw GROUP BY 1) a ON a.day = c.day ORDER BY c.day DESC LIMIT 40""",
)
def lineage_history(spark, sf_dir):
    rows = tracking.lineage_history(corpus.raw(spark, sf_dir), corpus.sync_log(spark, sf_dir))
    return rows.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def _rejected(spark, sf_dir):
    """Rejects by cleaning: landed titles against the first line, so that short ones occur."""
    reason = text.reject_reason(F.col("title"), F.col("content"), F.col("url"))
    return corpus.landed(spark, sf_dir).withColumn("reason", reason).filter(F.col("reason").isNotNull())


_REASON = """CASE WHEN length(trim(title)) > 3 AND length(trim(content)) > 10 THEN NULL WHEN trim(title) = '' THEN 'empty_title' WHEN trim(content) = '' THEN 'empty_content'
  WHEN length(trim(title)) <= 3 THEN 'title_too_short' WHEN length(trim(content)) <= 10 THEN 'content_too_short' ELSE 'other_invalid' END"""


@query(
    "cleaning_rejects",
    f"""WITH rej AS (SELECT id, {_REASON} AS reason FROM landed), r AS (SELECT unnest(['empty_title', 'empty_content', 'title_too_short', 'content_too_short', 'invalid_url', 'other_invalid']) AS reason)
  SELECT r.reason, (SELECT count(*) FROM rej j WHERE j.reason = r.reason) AS rows,
  coalesce((SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FROM (SELECT id FROM rej j WHERE j.reason = r.reason ORDER BY id LIMIT 5)), '') AS examples FROM r""",
)
def cleaning_rejects(spark, sf_dir):
    return tracking.cleaning_rejects(_rejected(spark, sf_dir), text.REJECT_REASONS)


@query(
    "ingest_rejects",
    f"""WITH l AS ({_LINEAGE}), j AS (SELECT source, count(*) AS n FROM landed WHERE {_REASON} IS NOT NULL GROUP BY 1)
  SELECT coalesce(l.source, j.source) AS source, coalesce(collected, 0) AS collected, coalesce(added, 0) AS added, coalesce(duplicates, 0) AS duplicates, coalesce(j.n, 0) AS rejected
  FROM l FULL JOIN j ON j.source = l.source""",
)
def ingest_rejects(spark, sf_dir):
    return tracking.ingest_rejects(_lineage(spark, sf_dir), _rejected(spark, sf_dir))


@query(
    "state_report",
    f"""WITH k AS (SELECT raw_data_id, count(*) AS n FROM model_output WHERE model_name = 'sentiment_keyword' GROUP BY 1),
  s AS (SELECT count(*) AS a, min(id) AS b, max(id) AS c, min(collected_at) AS d, max(collected_at) AS e FROM raw)
  SELECT 'raw' AS section, unnest(['total_rows', 'min_id', 'max_id', 'first_collected', 'last_collected']) AS name,
  unnest([CAST(a AS VARCHAR), CAST(b AS VARCHAR), CAST(c AS VARCHAR), strftime(d, '%Y-%m-%d %H:%M:%S'), strftime(e, '%Y-%m-%d %H:%M:%S')]) AS value FROM s
  UNION ALL SELECT 'enrichment', 'keyword_rows', CAST(sum(n) AS BIGINT)::VARCHAR FROM k UNION ALL SELECT 'enrichment', 'articles_scored', count(*)::VARCHAR FROM k
  UNION ALL SELECT 'enrichment', 'duplicate_outputs', (count(*) FILTER (WHERE n > 1))::VARCHAR FROM k
  UNION ALL SELECT 'topics', 'topic_rows', count(*)::VARCHAR FROM document_topic
  UNION ALL SELECT 'topics', 'articles_tagged', count(DISTINCT raw_data_id)::VARCHAR FROM document_topic
  UNION ALL SELECT 'label', label, count(*)::VARCHAR FROM model_output WHERE model_name = 'sentiment_keyword' GROUP BY label
  UNION ALL SELECT 'source', source, count(*)::VARCHAR FROM raw GROUP BY source
  UNION ALL SELECT 'sync', sync_log_id::VARCHAR, coalesce(name, '') || ' | ' || coalesce(strftime(sync_date, '%Y-%m-%d %H:%M:%S'), '') || ' | ' || coalesce(rows_synced::VARCHAR, '') || ' | ' || coalesce(status, '')
  FROM (SELECT * FROM sync_log JOIN sources USING (source_id) ORDER BY sync_log_id DESC NULLS LAST, sync_date DESC NULLS LAST, rows_synced DESC NULLS LAST, status DESC NULLS LAST, name DESC NULLS LAST LIMIT 30)""",
)
def state_report(spark, sf_dir):
    return tracking.state_report(*_tables(spark, sf_dir), corpus.sync_log(spark, sf_dir), corpus.sources(spark, sf_dir))


@query(
    "recent_syncs",
    "SELECT l.sync_log_id, s.name, l.rows_synced, l.status FROM (SELECT * FROM sync_log ORDER BY sync_log_id DESC LIMIT 30) l JOIN sources s USING (source_id)",
)
def recent_syncs(spark, sf_dir):
    rows = tracking.recent_syncs(corpus.sync_log(spark, sf_dir), corpus.sources(spark, sf_dir))
    return rows.select("sync_log_id", "name", "rows_synced", "status")


@query(
    "coherence_checks",
    f"""WITH {_MERGED}, l AS ({_LINK}), c AS (SELECT *, (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM gold) AS exported,
  (SELECT count(*) FROM (SELECT raw_data_id FROM model_output WHERE model_name = 'sentiment_keyword' GROUP BY 1 HAVING count(*) > 1)) AS dup FROM l)
  SELECT rows - raw_rows AS merged_minus_raw, exported - raw_rows AS exported_minus_raw, dup AS duplicate_outputs,
  CASE WHEN not_in_raw > 0 OR (rows > raw_rows AND without_id = 0) OR exported <> raw_rows OR dup > 0 THEN 'WARNING' ELSE 'OK' END AS status,
  array_to_string(list_filter([CASE WHEN not_in_raw > 0 THEN 'merged ids absent from raw' END, CASE WHEN rows > raw_rows AND without_id = 0 THEN 'merged larger than raw' END,
  CASE WHEN exported <> raw_rows THEN 'export differs from raw' END, CASE WHEN dup > 0 THEN 'duplicate keyword outputs' END], lambda x: x IS NOT NULL), '; ') AS reasons FROM c""",
)
def coherence_checks(spark, sf_dir):
    raw, _, outputs = _tables(spark, sf_dir)
    linkage = tracking.linkage_coverage(_merged(spark, sf_dir), raw)
    return tracking.coherence_checks(linkage, raw, corpus.gold(spark, sf_dir), outputs)


@query(
    "audit_stats",
    """SELECT 'action_type' AS section, action_type AS name, count(*) AS count FROM audit_log GROUP BY 2 UNION ALL SELECT 'resource_type', resource_type, count(*) FROM audit_log GROUP BY 2
  UNION ALL SELECT 'total', 'events', count(*) FROM audit_log UNION ALL SELECT 'total', 'with_ip', count(ip_address) FROM audit_log
  UNION ALL SELECT 'total', 'with_resource_id', count(resource_id) FROM audit_log
  UNION ALL SELECT 'total', 'last_24h', count(*) FROM audit_log WHERE action_date >= (SELECT max(action_date) FROM audit_log) - INTERVAL 1 DAY""",
)
def audit_stats(spark, sf_dir):
    return tracking.audit_stats(corpus.audit_log(spark, sf_dir))


@query(
    "quality_assertions",
    f"""WITH {_FLAGS}, m AS (SELECT count(*) AS n, count(*) FILTER (WHERE length(trim(title)) > 0) AS t, count(*) FILTER (WHERE length(trim(content)) > 0) AS c,
  count(*) FILTER (WHERE length(fingerprint) = 64) AS f, avg(CASE WHEN contains(lower(source), 'zzdb') THEN quality_score END) AS q, sum(tagged * analysed) AS e FROM flags)
  SELECT 'valid_titles' AS "check", t = n AS ok, t::DOUBLE AS detail FROM m UNION ALL SELECT 'valid_contents', c = n, c FROM m UNION ALL SELECT 'fingerprints', f = n, f FROM m
  UNION ALL SELECT 'synthetic_quality', q BETWEEN 0.2 AND 0.6, round(q, 10) FROM m UNION ALL SELECT 'enriched', e > 0, e FROM m""",
)
def quality_assertions(spark, sf_dir):
    return _rounded(tracking.quality_assertions(*_tables(spark, sf_dir)), "detail")


@query(
    "quality_summary",
    """WITH q AS (SELECT *, least(0.5::DOUBLE + CASE WHEN length(trim(title)) > 10 THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN length(trim(content)) > 50 THEN 0.3::DOUBLE ELSE 0 END, 1.0) AS cq FROM landed)
  SELECT source, count(*) AS rows, count(*) FILTER (WHERE cq >= 0.8) AS high_quality, count(*) - count(DISTINCT fingerprint) AS duplicates,
  round_even(avg(cq), 3) AS avg_quality, count(DISTINCT date) AS dates FROM q GROUP BY 1""",
)
def quality_summary(spark, sf_dir):
    scored = corpus.landed(spark, sf_dir).withColumn("cq", text.completeness_quality(F.col("title"), F.col("content")))
    return tracking.quality_summary(scored, "cq")


@query(
    "database_stats",
    f"""SELECT s.name, count(r.id) AS articles, (SELECT count(*) FROM raw) AS total_articles, (SELECT count(*) FROM sources WHERE active) AS active_sources,
  (SELECT count(*) FROM raw WHERE id IN (SELECT raw_data_id FROM document_topic) AND id IN {_KW}) AS enriched
  FROM sources s LEFT JOIN raw r ON r.source = s.name WHERE s.active GROUP BY 1""",
)
def database_stats(spark, sf_dir):
    return tracking.database_stats(corpus.sources(spark, sf_dir), *_tables(spark, sf_dir))


_VOLUME = """WITH r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY sync_date DESC, sync_log_id DESC) AS rn FROM sync_log WHERE status = 'OK'),
  p AS (SELECT source_id, max(rows_synced) FILTER (WHERE rn = 1) AS now, coalesce(max(rows_synced) FILTER (WHERE rn = 2), 0) AS previous FROM r WHERE rn <= 2 GROUP BY 1),
  v AS (SELECT s.name, CASE WHEN previous > 0 AND now = 0 THEN 'no volume' WHEN previous > 0 AND (now - previous) * 100.0 / previous <= -80 THEN 'volume drop' END AS anomaly
  FROM p JOIN sources s USING (source_id))"""


@query(
    "run_contract",
    f"""{_VOLUME}, {_FLAGS}, c AS (SELECT (SELECT count(*) FROM landed) AS extracted, (SELECT count(*) FROM landed WHERE {_REASON} IS NULL) AS cleaned,
  count(*) AS loaded, CAST(sum(tagged) AS BIGINT) AS tagged, CAST(sum(analysed) AS BIGINT) AS analysed FROM flags),
  d AS (SELECT *, cleaned - loaded AS deduplicated, cleaned::DOUBLE / extracted AS clean_ratio, least(tagged, analysed)::DOUBLE / loaded AS enriched_ratio FROM c),
  e AS (SELECT *, list_concat(list_filter([CASE WHEN loaded < 20 THEN 'loaded below threshold' END, CASE WHEN least(tagged, analysed) < loaded THEN 'enrichment incomplete' END,
  CASE WHEN clean_ratio < 0.9 THEN 'clean ratio below threshold' END, CASE WHEN enriched_ratio < 0.95 THEN 'enriched ratio below threshold' END], lambda x: x IS NOT NULL),
  coalesce((SELECT list('source ' || name || ': ' || anomaly ORDER BY 'source ' || name || ': ' || anomaly) FROM v WHERE anomaly IS NOT NULL), [])) AS r FROM d)
  SELECT extracted, cleaned, loaded, deduplicated, tagged, analysed, round(clean_ratio, 10) AS clean_ratio, round(enriched_ratio, 10) AS enriched_ratio,
  CASE WHEN len(r) > 0 THEN 'WARN' ELSE 'PASS' END AS status, array_to_string(r, '; ') AS reasons FROM e""",
)
def run_contract(spark, sf_dir):
    landed = corpus.landed(spark, sf_dir)
    cleaned = landed.filter(text.is_valid(F.col("title"), F.col("content")))
    volumes = source_volume_delta(corpus.sync_log(spark, sf_dir)).join(corpus.sources(spark, sf_dir), "source_id")
    anomalies = volumes.select(F.col("name").alias("source"), "anomaly")
    contract = tracking.run_contract(landed, cleaned, *_tables(spark, sf_dir), anomalies=anomalies)
    return _rounded(contract, "clean_ratio", "enriched_ratio").withColumn("reasons", F.array_join("reasons", "; "))


@query(
    "retag_before_after",
    """WITH b AS (SELECT topic, count(*) AS n FROM (SELECT topic FROM document_topic QUALIFY row_number() OVER (PARTITION BY raw_data_id ORDER BY doc_topic_id) = 1) GROUP BY 1),
  a AS (SELECT topic_1 AS topic, count(*) AS n FROM gold GROUP BY 1)
  SELECT coalesce(b.topic, a.topic) AS value, coalesce(b.n, 0) AS before, coalesce(a.n, 0) AS after, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta FROM b FULL JOIN a USING (topic)""",
)
def retag_before_after(spark, sf_dir):
    links = corpus.document_topic(spark, sf_dir)
    first = links.groupBy("raw_data_id").agg(F.min(F.struct("doc_topic_id", "topic")).alias("_f")).select(F.col("_f.topic").alias("topic"))
    return before_after(first, corpus.gold(spark, sf_dir).select(F.col("topic_1").alias("topic")), "topic")
