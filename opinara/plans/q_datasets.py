"""Sinks, incremental layers, enrichment jobs, datasets and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import text
from opinara.operators import datasets, evaluation, layers, scoring
from opinara.operators.aggregates import latency_percentiles
from opinara.plans import corpus
from opinara.plans.oracle import LADDER_LABEL, LADDER_SCORE, strip
from opinara.plans.q_joins import SPLIT_DAY, _FLAGS, _rounded, _tables
from opinara.plans.registry import query
from opinara.plans.vocabulary import LEXICON, TOPICS
from opinara.sources import sinks
from opinara.sources.merged import MergedTable
from opinara.storage import new_path


def _per_date(df):
    return df.groupBy(F.date_format("date", "yyyy-MM-dd").alias("date")).agg(F.count("*").alias("rows"))


_DATES = "SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS rows FROM {0} GROUP BY {0}.date"


@query(
    "write_landing",
    " UNION ALL ".join(f"SELECT '{f}' AS format, * FROM ({_DATES.format('articles')})" for f in ("json", "csv")),
)
def write_landing(spark, sf_dir):
    """Cleaned rows written as JSON and CSV, copies included, counted from the written files."""
    path = new_path(spark, "landing")
    clean = text.clean_articles(corpus.articles(spark, sf_dir)).select("id", "source", "title", "content", "url", "date")
    sinks.write_landing(clean, path)
    schema = "id bigint, source string, title string, content string, url string, date date"
    written = {
        "json": spark.read.schema(schema).json(f"{path}/json"),
        "csv": spark.read.schema(schema).csv(f"{path}/csv", header=True, escape='"', multiLine=True),
    }
    counts = [_per_date(df.filter("id IS NOT NULL")).select(F.lit(name).alias("format"), "date", "rows") for name, df in written.items()]
    return counts[0].unionByName(counts[1])


@query("write_silver", _DATES.format("silver"))
def write_silver(spark, sf_dir):
    path = new_path(spark, "silver")
    sinks.write_silver(corpus.silver(spark, sf_dir), path)
    return _per_date(spark.read.parquet(f"{path}/parquet"))


@query(
    "write_gold",
    f"""SELECT 'all' AS part, * FROM ({_DATES.format('gold')}) UNION ALL SELECT source, strftime(date, '%Y-%m-%d'), count(*) FROM gold
  WHERE source IN ('zzdb_synthetic', 'zzdb_csv') GROUP BY source, date""",
)
def write_gold(spark, sf_dir):
    path = new_path(spark, "gold")
    sinks.write_gold(corpus.gold(spark, sf_dir), path)
    every = _per_date(spark.read.parquet(f"{path}/all")).select(F.lit("all").alias("part"), "date", "rows")
    synthetic = (
        spark.read.parquet(f"{path}/synthetic").groupBy(F.col("source").alias("part"), F.date_format("date", "yyyy-MM-dd").alias("date"))
        .agg(F.count("*").alias("rows"))
    )
    return every.unionByName(synthetic)


def _merged_twice(spark, sf_dir):
    """First merge of the early dates, then of the layer with every date."""
    landed = corpus.landed(spark, sf_dir)
    merged = MergedTable(spark, new_path(spark, "merged"))
    merged.merge(landed.filter(F.col("date") < SPLIT_DAY))
    merged.merge(landed)
    return merged


@query(
    "write_merged",
    f"""WITH a AS (SELECT count(DISTINCT fingerprint) AS n, count(DISTINCT date) AS d FROM landed WHERE date < DATE '{SPLIT_DAY}'),
  b AS (SELECT count(DISTINCT fingerprint) AS n FROM landed), k AS (SELECT * FROM landed QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY collected_at DESC, id DESC) = 1)
  SELECT 1 AS version, n AS total_rows, 0 AS rows_before, n AS rows_added, 0 AS null_ids FROM a
  UNION ALL SELECT 2, b.n, a.n, b.n - a.n, 0 FROM a, b""",
)
def write_merged(spark, sf_dir):
    return _merged_twice(spark, sf_dir).metadata().select("version", "total_rows", "rows_before", "rows_added", "null_ids")


@query(
    "incremental_merge",
    "SELECT fingerprint AS id, id AS raw_id, length(content) AS chars, title FROM landed QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY collected_at DESC, id DESC) = 1",
)
def incremental_merge(spark, sf_dir):
    """The merged table after two merges equals one dedup over all dates."""
    return _merged_twice(spark, sf_dir).read().select("id", "raw_id", F.length("content").cast("long").alias("chars"), "title")


@query("write_predictions", "SELECT strftime(date, '%Y-%m-%d') AS date, run, count(*) AS rows FROM predictions GROUP BY predictions.date, run")
def write_predictions(spark, sf_dir):
    path = new_path(spark, "predictions")
    sinks.write_predictions(corpus.predictions(spark, sf_dir), path)
    written = spark.read.parquet(path)
    return written.groupBy(F.date_format("date", "yyyy-MM-dd").alias("date"), "run").agg(F.count("*").alias("rows"))


@query("export_context_records", "SELECT title, predicted_sentiment, confidence, p_pos, p_neu, p_neg FROM latest_run")
def export_context_records(spark, sf_dir):
    path = new_path(spark, "context")
    sinks.write_context(corpus.latest_run(spark, sf_dir), path)
    schema = "title string, predicted_sentiment string, confidence double, p_pos double, p_neu double, p_neg double"
    return spark.read.schema(schema).json(path)


@query(
    "table_counts",
    """SELECT 'raw' AS name, count(*) AS rows FROM raw UNION ALL SELECT 'document_topic', count(*) FROM document_topic
  UNION ALL SELECT 'model_output', count(*) FROM model_output UNION ALL SELECT 'source', count(*) FROM sources UNION ALL SELECT 'sync_log', count(*) FROM sync_log""",
)
def table_counts(spark, sf_dir):
    raw, links, outputs = _tables(spark, sf_dir)
    tables = {
        "raw": raw, "document_topic": links, "model_output": outputs, "source": corpus.sources(spark, sf_dir),
        "sync_log": corpus.sync_log(spark, sf_dir),
    }
    return sinks.table_counts(tables, new_path(spark, "snapshot"))


@query("archive_manifest")
def archive_manifest(spark, sf_dir):
    """Every table file against a manifest that already holds the file of the labels."""
    known = sinks.archive_manifest(spark, sf_dir, pattern="labels.parquet")
    return sinks.archive_manifest(spark, sf_dir, known, "*.parquet").select("sha256", "logical_name", "size_bytes")


@query(
    "incremental_silver",
    "SELECT id, topic_1 FROM silver WHERE id > (SELECT max(id) FROM silver WHERE date < DATE '2024-01-03')",
)
def incremental_silver(spark, sf_dir):
    silver = corpus.silver(spark, sf_dir)
    exported = corpus.raw(spark, sf_dir).filter("date < '2024-01-03'")
    return layers.above_last_exported(silver, exported).select("id", "topic_1")


@query("retag", "SELECT g.id, t.best[1].t AS topic_1, -t.best[1].s AS topic_1_score, g.sentiment FROM gold g JOIN topic_of t USING (id)")
def retag(spark, sf_dir):
    """Topics assigned anew over the whole layer; every other column is kept."""
    return scoring.retag(corpus.gold(spark, sf_dir), TOPICS).select("id", "topic_1", "topic_1_score", "sentiment")


@query(
    "reanalyze",
    f"SELECT raw_data_id, model_name, label, score FROM model_output WHERE model_name <> 'sentiment_keyword' UNION ALL SELECT id, 'sentiment_keyword', {LADDER_LABEL}, {LADDER_SCORE} FROM pass_all",
)
def reanalyze(spark, sf_dir):
    raw, _, outputs = _tables(spark, sf_dir)
    fresh = scoring.reanalyze(outputs, raw, LEXICON, F.col("id") * 2 + 1)
    return fresh.select("raw_data_id", "model_name", "label", "score")


@query(
    "enrich_backlog",
    f"WITH {_FLAGS} SELECT p.id, {LADDER_LABEL} AS sentiment, {LADDER_SCORE} AS sentiment_score FROM pass_all p JOIN flags f USING (id) WHERE f.tagged = 0 OR f.analysed = 0",
)
def enrich_backlog(spark, sf_dir):
    rows = scoring.enrich_backlog(*_tables(spark, sf_dir), LEXICON, TOPICS)
    return rows.select("id", "sentiment", "sentiment_score")


_SCORED = "SELECT id, predicted_sentiment, predicted_sentiment_score, label_3c, confidence, p_pos, p_neu, p_neg FROM latest_run"


def _scored(spark, sf_dir, rows=None):
    rows = corpus.raw(spark, sf_dir) if rows is None else rows
    return scoring.batch_score(rows.select("id", "title", "content"), scoring.lexicon_scorer(LEXICON))


@query("batch_score", "SELECT id, label_3c, confidence, p_pos, p_neu, p_neg, predicted_sentiment_score AS sentiment_score FROM latest_run")
def batch_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("id", "out.*")


@query("resume_score", f"SELECT id, confidence FROM latest_run WHERE id NOT IN (SELECT id FROM predictions WHERE run = '{corpus.RUN_3}')")
def resume_score(spark, sf_dir):
    """The small run continued over all articles: only those it lacks are scored."""
    open_rows = scoring.resume(corpus.raw(spark, sf_dir), corpus.predictions(spark, sf_dir), corpus.RUN_3)
    return _scored(spark, sf_dir, open_rows).select("id", "out.confidence")


@query("prediction_frame", _SCORED.replace("FROM", ", 'lexicon-1' AS model_version, 'run-x' AS inference_run_id FROM"))
def prediction_frame(spark, sf_dir):
    rows = scoring.prediction_frame(_scored(spark, sf_dir), "lexicon-1", "run-x")
    return rows.drop("prediction_timestamp", "inference_ms", "title")


@query(
    "upsert_predictions",
    f"""SELECT raw_data_id, model_name, label, score FROM model_output WHERE NOT (model_name = 'sentiment_scorer' AND raw_data_id IN (SELECT CAST(id AS BIGINT) FROM predictions WHERE run = '{corpus.RUN_1}'))
  UNION ALL SELECT CAST(id AS BIGINT), 'sentiment_scorer', predicted_sentiment, confidence FROM predictions WHERE run = '{corpus.RUN_1}'""",
)
def upsert_predictions(spark, sf_dir):
    """Predictions of the first run replace the stored ones; ids that are not numbers are left out."""
    run = corpus.predictions(spark, sf_dir).filter(F.col("run") == corpus.RUN_1)
    foreign = run.withColumn("id", F.concat(F.lit("https://x.example/"), "id"))
    outputs = corpus.model_output(spark, sf_dir)
    rows = scoring.upsert_predictions(outputs, run.unionByName(foreign), "sentiment_scorer", F.col("id").try_cast("bigint"))
    return rows.select("raw_data_id", "model_name", "label", "score")


@query("ia_labelled", "SELECT id, sentiment, sentiment AS sentiment_label FROM gold")
def ia_labelled(spark, sf_dir):
    spelled = F.when(F.col("sentiment") == "negatif", "NÉGATIF").when(F.col("sentiment") == "positif", " Positive").otherwise("neutral")
    gold = corpus.gold(spark, sf_dir).select("id", spelled.alias("sentiment"))
    return datasets.ia_labelled(gold)


def _keyed(spark, sf_dir):
    """Landed rows with shared urls and some blank keys."""
    return corpus.landed(spark, sf_dir).select(
        "id", "title", "content", "collected_at", "lang",
        F.when(F.col("lang") == "es", " ").otherwise(F.col("fingerprint")).alias("fingerprint"),
        F.when(F.col("lang") == "de", F.lit(None)).otherwise(F.regexp_replace("url", "..$", "")).alias("url"),
    )


_KEYED = """keyed AS (SELECT id, title, content, collected_at, lang, CASE WHEN lang = 'es' THEN NULL ELSE fingerprint END AS fingerprint,
  CASE WHEN lang = 'de' THEN NULL ELSE regexp_replace(url, '..$', '') END AS url FROM landed),
  d1 AS (SELECT * FROM keyed QUALIFY fingerprint IS NULL OR row_number() OVER (PARTITION BY fingerprint ORDER BY id) = 1),
  d2 AS (SELECT * FROM d1 QUALIFY url IS NULL OR row_number() OVER (PARTITION BY url ORDER BY fingerprint IS NULL, id) = 1),
  d3 AS (SELECT * FROM d2 QUALIFY row_number() OVER (PARTITION BY content ORDER BY url IS NULL, fingerprint IS NULL, id) = 1)"""


@query("split_dedup", f"WITH {_KEYED} SELECT id, url FROM d3")
def split_dedup(spark, sf_dir):
    return datasets.split_dedup(_keyed(spark, sf_dir)).select("id", "url")


def _split_sql(order: str, source: str = "raw") -> str:
    return f"""SELECT id, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' WHEN rn <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT id, row_number() OVER (ORDER BY {order}) AS rn, count(*) OVER () AS n FROM {source})"""


@query("temporal_split", _split_sql("collected_at, id"))
def temporal_split(spark, sf_dir):
    return datasets.temporal_split(corpus.raw(spark, sf_dir)).select("id", "split")


@query("random_split", _split_sql("md5('42-' || id), id"))
def random_split(spark, sf_dir):
    return datasets.random_split(corpus.raw(spark, sf_dir)).select("id", "split")


_LEAK = " UNION ALL ".join(
    f"""SELECT '{k}' AS key, count(*) FILTER (WHERE a AND b) AS train_val, count(*) FILTER (WHERE a AND c) AS train_test, count(*) FILTER (WHERE b AND c) AS val_test
  FROM (SELECT bool_or(split = 'train') AS a, bool_or(split = 'val') AS b, bool_or(split = 'test') AS c FROM s WHERE trim({k}) <> '' GROUP BY {k})"""
    for k in ("fingerprint", "url", "content")
)


@query("split_leakage", f"WITH s AS (SELECT l.*, x.split FROM landed l JOIN ({_split_sql('collected_at, id', 'landed')}) x USING (id)) {_LEAK}")
def split_leakage(spark, sf_dir):
    """Splits of rows that were not deduplicated, so that copies do leak."""
    return datasets.split_leakage(datasets.temporal_split(corpus.landed(spark, sf_dir)))


@query(
    "rebalance",
    """WITH r AS (SELECT id, sentiment AS label, row_number() OVER (PARTITION BY sentiment ORDER BY md5('42-' || id), id) AS rn FROM gold),
  s AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 'positif') AS p FROM r),
  e AS (SELECT p, greatest(least(CAST(ceil((0.6::DOUBLE * n - p) / (1 - 0.6::DOUBLE)) AS BIGINT), CAST(floor(1.5::DOUBLE * p) AS BIGINT)), 0) AS extra FROM s)
  SELECT id, label, CAST(unnest(range(0, 1 + CASE WHEN label = 'positif' THEN CAST(floor(extra / p) AS BIGINT) + CASE WHEN rn <= extra % p THEN 1 ELSE 0 END ELSE 0 END)) AS INTEGER) AS copy FROM r, e""",
)
def rebalance(spark, sf_dir):
    rows = corpus.gold(spark, sf_dir).select("id", F.col("sentiment").alias("label"))
    return datasets.rebalance(rows, 0.6, 2.5)


@query(
    "training_rows",
    f"""SELECT id, {strip("title || ' ' || content")} AS text, CASE sentiment WHEN 'negatif' THEN 0 WHEN 'neutre' THEN 1 ELSE 2 END AS label FROM gold""",
)
def training_rows(spark, sf_dir):
    return datasets.training_rows(corpus.gold(spark, sf_dir))


@query(
    "balanced_sample",
    "SELECT id, sentiment FROM gold QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY md5('42-' || id), id) <= 60",
)
def balanced_sample(spark, sf_dir):
    return datasets.balanced_sample(corpus.gold(spark, sf_dir).select("id", "sentiment"), 60, "sentiment")


_PER_CLASS = """WITH k AS (SELECT unnest(['negatif', 'neutre', 'positif']) AS label), c AS (SELECT label, count(*) FILTER (WHERE y_true = label AND y_pred = label) AS tp,
  count(*) FILTER (WHERE y_true <> label AND y_pred = label) AS fp, count(*) FILTER (WHERE y_true = label AND y_pred <> label) AS fn,
  count(*) FILTER (WHERE y_true = label) AS support, count(*) AS total FROM labelled, k GROUP BY label HAVING count(*) FILTER (WHERE y_true = label OR y_pred = label) > 0),
  p AS (SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall FROM c),
  s AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM p)"""


@query(
    "classification_metrics",
    f"""{_PER_CLASS} SELECT label, round(precision, 10) AS precision, round(recall, 10) AS recall, round(f1, 10) AS f1, support FROM s
  UNION ALL SELECT 'accuracy', round(sum(tp) / max(total)::DOUBLE, 10), round(sum(tp) / max(total)::DOUBLE, 10), round(sum(tp) / max(total)::DOUBLE, 10), CAST(sum(support) AS BIGINT) FROM s
  UNION ALL SELECT 'macro', round(avg(precision), 10), round(avg(recall), 10), round(avg(f1), 10), CAST(sum(support) AS BIGINT) FROM s
  UNION ALL SELECT 'weighted', round(sum(precision * support) / sum(support), 10), round(sum(recall * support) / sum(support), 10), round(sum(f1 * support) / sum(support), 10), CAST(sum(support) AS BIGINT) FROM s""",
)
def classification_metrics(spark, sf_dir):
    return _rounded(evaluation.classification_metrics(corpus.labelled(spark, sf_dir)), "precision", "recall", "f1")


@query(
    "confusion_matrix",
    f"""{_PER_CLASS}, m AS (SELECT y_true, count(*) FILTER (WHERE y_pred = 'negatif') AS negatif, count(*) FILTER (WHERE y_pred = 'neutre') AS neutre, count(*) FILTER (WHERE y_pred = 'positif') AS positif, count(*) AS n FROM labelled GROUP BY 1)
  SELECT m.y_true, negatif, neutre, positif, round(negatif / n::DOUBLE, 10) AS negatif_share, round(neutre / n::DOUBLE, 10) AS neutre_share, round(positif / n::DOUBLE, 10) AS positif_share,
  round((total - support - fp) / (total - support)::DOUBLE, 10) AS specificity, round(1 - (total - support - fp) / (total - support)::DOUBLE, 10) AS fpr FROM m JOIN s ON s.label = m.y_true""",
)
def confusion_matrix(spark, sf_dir):
    shares = [f"{c}_share" for c in ("negatif", "neutre", "positif")]
    return _rounded(evaluation.confusion_matrix(corpus.labelled(spark, sf_dir)), *shares, "specificity", "fpr")


_LONG = """WITH l AS (SELECT y_true, 'negatif' AS label, p_neg AS score FROM labelled UNION ALL SELECT y_true, 'neutre', p_neu FROM labelled UNION ALL SELECT y_true, 'positif', p_pos FROM labelled)"""


@query(
    "roc_auc",
    f"""{_LONG}, a AS (SELECT p.label, sum(CASE WHEN p.score > n.score THEN 1.0::DOUBLE WHEN p.score = n.score THEN 0.5 ELSE 0 END) / count(*) AS auc
  FROM l p JOIN l n ON n.label = p.label AND n.y_true <> n.label WHERE p.y_true = p.label GROUP BY 1)
  SELECT k.label, round(a.auc, 10) AS auc FROM (SELECT DISTINCT label FROM l) k LEFT JOIN a USING (label) UNION ALL SELECT 'macro', round(avg(auc), 10) FROM a""",
)
def roc_auc(spark, sf_dir):
    return _rounded(evaluation.roc_auc(corpus.labelled(spark, sf_dir)), "auc")


@query(
    "roc_points",
    f"""{_LONG}, t AS (SELECT label, count(*) FILTER (WHERE y_true = label) AS p, count(*) FILTER (WHERE y_true <> label) AS n FROM l GROUP BY 1)
  SELECT s.label, s.score AS threshold, round(count(*) FILTER (WHERE l.y_true <> l.label) / nullif(max(t.n), 0)::DOUBLE, 10) AS fpr, round(count(*) FILTER (WHERE l.y_true = l.label) / nullif(max(t.p), 0)::DOUBLE, 10) AS tpr
  FROM (SELECT DISTINCT label, score FROM l) s JOIN l ON l.label = s.label AND l.score >= s.score JOIN t ON t.label = s.label GROUP BY 1, 2""",
)
def roc_points(spark, sf_dir):
    return _rounded(evaluation.roc_points(corpus.labelled(spark, sf_dir)), "fpr", "tpr")


@query(
    "corpus_accuracy",
    """WITH r AS (SELECT d.lang AS prefix, l.y_true = l.y_pred AS ok FROM labelled l JOIN documents d ON CAST(d.doc_id AS VARCHAR) = l.id)
  SELECT prefix, count(*) AS n, count(*) FILTER (WHERE ok) AS ok, round_even(count(*) FILTER (WHERE ok) * 100.0::DOUBLE / count(*), 1) AS accuracy_pct FROM r GROUP BY 1
  UNION ALL SELECT 'all', count(*), count(*) FILTER (WHERE ok), round_even(count(*) FILTER (WHERE ok) * 100.0::DOUBLE / count(*), 1) FROM r""",
)
def corpus_accuracy(spark, sf_dir):
    lang = corpus.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang")
    return evaluation.corpus_accuracy(corpus.labelled(spark, sf_dir).join(lang, "id"), F.col("lang"))


@query("corpus_errors", "SELECT id, y_true, y_pred FROM labelled WHERE y_true <> y_pred")
def corpus_errors(spark, sf_dir):
    """The rows whose label was missed."""
    return evaluation.errors(corpus.labelled(spark, sf_dir)).select("id", "y_true", "y_pred")


_CHECKS = """WITH d AS (SELECT predicted_sentiment AS s, count(*)::DOUBLE / (SELECT count(*) FROM latest_run) AS share FROM latest_run GROUP BY 1),
  f AS (SELECT (SELECT max(share) FROM d) AS dominant, coalesce((SELECT share FROM d WHERE s = 'neutre'), 0) AS neutral, (SELECT avg(confidence) FROM latest_run) AS mean,
  (SELECT avg(CASE WHEN confidence < 0.55 THEN 1.0::DOUBLE ELSE 0 END) FROM latest_run) AS low, (SELECT quantile_cont(value, 0.9) FROM events) AS p90, (SELECT quantile_cont(value, 0.99) FROM events) AS p99),
  c AS (SELECT 'dominant_class' AS "check", dominant AS value, dominant > 0.85 AS alert FROM f UNION ALL SELECT 'neutral_share', neutral, neutral < 0.03 FROM f
  UNION ALL SELECT 'confidence_mean', mean, mean < 0.6 FROM f UNION ALL SELECT 'confidence_low_share', low, low > 0.2 FROM f
  UNION ALL SELECT 'latency_p90', p90, p90 > 260 FROM f UNION ALL SELECT 'latency_p99', p99, p99 > 500 FROM f)"""


def _checks(spark, sf_dir):
    latency = latency_percentiles(corpus.events(spark, sf_dir), "value")
    return evaluation.inference_checks(corpus.latest_run(spark, sf_dir), latency)


@query("inference_checks", f'{_CHECKS} SELECT "check", round(value, 10) AS value, alert FROM c')
def inference_checks(spark, sf_dir):
    return _rounded(_checks(spark, sf_dir), "value")


@query(
    "inference_verdict",
    f"{_CHECKS} SELECT count(*) FILTER (WHERE alert) AS alerts, CASE WHEN count(*) FILTER (WHERE alert) = 0 THEN 'GO' WHEN count(*) FILTER (WHERE alert) <= 2 THEN 'GO avec vigilance' ELSE 'NO-GO' END AS verdict FROM c",
)
def inference_verdict(spark, sf_dir):
    return evaluation.inference_verdict(_checks(spark, sf_dir))


@query(
    "model_gate",
    f"""{_PER_CLASS}, m AS (SELECT avg(f1) AS f1, sum(tp) / max(total)::DOUBLE AS acc, max(f1) FILTER (WHERE label = 'positif') AS fp FROM s),
  g AS (SELECT (f1 >= 0.7)::INT + (acc >= 0.65)::INT + (f1 >= 0.65)::INT + (fp >= 0.55)::INT + ((SELECT avg(value) FROM events) <= 300)::INT AS passed FROM m)
  SELECT passed, CASE WHEN passed = 5 THEN 'GO' WHEN passed >= 3 THEN 'GO avec vigilance' ELSE 'NO-GO' END AS verdict FROM g""",
)
def model_gate(spark, sf_dir):
    metrics = evaluation.classification_metrics(corpus.labelled(spark, sf_dir))

    def of(label, measure):
        return F.max(F.when(F.col("label") == label, F.col(measure)))

    facts = metrics.agg(
        of("macro", "f1").alias("train_f1_macro"), of("accuracy", "precision").alias("train_accuracy"),
        of("macro", "f1").alias("inference_f1_macro"), of("positif", "f1").alias("inference_f1_positive"),
    ).withColumn("inference_latency_ms", corpus.events(spark, sf_dir).agg(F.avg("value")).scalar())
    return evaluation.model_gate(facts)
