"""Reading layers, landed files, payloads and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.operators import layers
from opinara.plans import corpus
from opinara.plans.oracle import squeeze, strip
from opinara.plans.registry import query
from opinara.sources import files, pages, payloads, sinks
from opinara.sources import layers as layer_source
from opinara.storage import new_path, spread


def _day(column="date"):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _gold_folder(spark, sf_dir) -> str:
    path = new_path(spark, "gold-by-date")
    sinks.write_gold(corpus.gold(spark, sf_dir), path)
    return f"{path}/all"


@query("scan_all", "SELECT id, strftime(date, '%Y-%m-%d') AS date, sentiment FROM gold")
def scan_all(spark, sf_dir):
    return layer_source.read_layer(spark, _gold_folder(spark, sf_dir)).select("id", _day(), "sentiment")


@query("scan_date", "SELECT id, source FROM gold WHERE date = DATE '2024-01-12'")
def scan_date(spark, sf_dir):
    return layer_source.read_date(spark, _gold_folder(spark, sf_dir), "2024-01-12").select("id", "source")


@query("scan_date_range", "SELECT id, strftime(date, '%Y-%m-%d') AS date FROM gold WHERE gold.date BETWEEN DATE '2024-01-28' AND DATE '2024-02-05'")
def scan_date_range(spark, sf_dir):
    rows = layer_source.read_range(spark, _gold_folder(spark, sf_dir), "2024-01-28", "2024-02-05")
    return rows.select("id", _day())


@query("available_dates", "SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date FROM gold")
def available_dates(spark, sf_dir):
    return layer_source.available_dates(spark, _gold_folder(spark, sf_dir)).select(_day())


@query("latest_partition", "SELECT id, sentiment FROM gold WHERE date = (SELECT max(date) FROM gold)")
def latest_partition(spark, sf_dir):
    return layer_source.latest_partition(spark, _gold_folder(spark, sf_dir)).select("id", "sentiment")


def _guarded_sql(title: str, content: str, where: str = "true") -> str:
    """Rows passing the import guards, with the stripped columns."""
    words = "[w for w in regexp_split_to_array(content, '[ \\n\\r\\t]+') if w <> '']"
    return f"""SELECT * FROM (SELECT *, {title} AS bare_title, {content} AS bare_content FROM articles WHERE {where})
  WHERE length(bare_title) >= 10 AND length(bare_content) >= 50
  AND NOT len(list_distinct({words.replace('content', 'bare_content')})) < len({words.replace('content', 'bare_content')}) * 0.3"""


_BARE_TITLE = strip("title")
_BARE_CONTENT = strip("content")


@query(
    "csv_guarded_ingest",
    f"SELECT bare_title AS title, bare_content AS content, coalesce(CASE WHEN lang = 'en' THEN url END, 'https://landing.example') AS url FROM ({_guarded_sql(_BARE_TITLE, _BARE_CONTENT)})",
)
def csv_guarded_ingest(spark, sf_dir):
    path = new_path(spark, "landing-csv")
    rows = corpus.articles(spark, sf_dir).select(
        "title", "content", F.when(F.col("lang") == "en", F.col("url")).alias("url"), F.col("date").cast("string").alias("published_at")
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    return files.csv_guarded(spark, path, "https://landing.example").select("title", "content", "url")


_VALID = "length(t) > 3 AND length(c) > 10"


@query(
    "csv_flexible_columns",
    f"SELECT t AS title, c AS content FROM (SELECT {strip('title')} AS t, {strip('content')} AS c FROM articles) WHERE {_VALID}",
)
def csv_flexible_columns(spark, sf_dir):
    """A header of foreign names: the headline is the second column, the body the third."""
    path = new_path(spark, "flexible-csv")
    rows = corpus.articles(spark, sf_dir).select(
        F.col("id").alias("row"), F.col("title").alias("News Headline"), F.col("content").alias("BodyText")
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    return files.csv_flexible(spark, path)


@query(
    "json_items_ingest",
    f"""SELECT t AS title, c AS content FROM (SELECT {strip("CASE WHEN lang = 'es' THEN 'Kaggle' ELSE title END")} AS t,
  {strip('content')} AS c FROM articles) WHERE {_VALID}""",
)
def json_items_ingest(spark, sf_dir):
    """Lists and item objects, English under other keys, Spanish without a title."""
    named = F.col("lang")
    item = (
        F.when(named == "en", F.to_json(F.struct(F.col("title").alias("headline"), F.col("content").alias("Text"))))
        .when(named == "es", F.to_json(F.struct(F.col("content").alias("description"))))
        .otherwise(F.to_json(F.struct("title", "content")))
    )
    listed = F.concat(F.lit("["), item, F.lit("]"))
    wrapped = F.concat(F.lit('{"items":['), item, F.lit("]}"))
    path = new_path(spark, "json-items")
    corpus.articles(spark, sf_dir).select(F.when(named == "fr", wrapped).otherwise(listed).alias("value")).write.text(path)
    return files.json_articles(spark, path, lines=True)


_LOCAL = f"""SELECT 'gdelt_' || lang AS source, t AS title, CASE WHEN c = '' THEN t ELSE c END AS content, url
  FROM (SELECT lang, url, {strip('title')} AS t, CASE WHEN lang = 'de' THEN '' ELSE {strip('content')} END AS c FROM articles) WHERE length(t) > 3"""


def _event_folders(spark, sf_dir) -> str:
    """Articles landed as JSON lists below one folder per language."""
    path = new_path(spark, "event-json")
    body = F.when(F.col("lang") == "de", F.lit("")).otherwise(F.col("content"))
    item = F.to_json(F.struct(F.col("title").alias("headline"), body.alias("text"), "url"))
    rows = corpus.articles(spark, sf_dir).select(
        F.concat(F.lit("["), item, F.lit("]")).alias("value"), F.concat(F.lit("gdelt_"), "lang").alias("folder")
    )
    rows.write.partitionBy("folder").text(path)
    return path


@query("json_folder_source", _LOCAL)
def json_folder_source(spark, sf_dir):
    rows = files.folder_articles(spark, _event_folders(spark, sf_dir), lines=True)
    return rows.withColumn("source", F.regexp_replace("source", "^folder=", ""))


@query(
    "raw_layer",
    f"""SELECT source, title, content, quality_score, is_synthetic, source_type FROM raw
  UNION ALL SELECT source, title, content, 0.5, false, 'real_source' FROM ({_LOCAL})""",
)
def raw_layer(spark, sf_dir):
    local = files.folder_articles(spark, _event_folders(spark, sf_dir), lines=True)
    local = local.withColumn("source", F.regexp_replace("source", "^folder=", ""))
    columns = ("source", "title", "content", "quality_score", "is_synthetic", "source_type")
    stored = corpus.raw(spark, sf_dir).select("id", "fingerprint", "url", "collected_at", *columns)
    return layers.local_rows_appended(stored, local).select(*columns)


@query(
    "tsv_events_ingest",
    """SELECT event_type || ' by user ' || user_id AS title, 'Code: ' || event_id || ', Date: ' || strftime(ts, '%Y%m%d%H%M%S') AS content,
  'https://events.example/' || event_id AS url FROM events""",
)
def tsv_events_ingest(spark, sf_dir):
    """Event lines of 58 fields."""
    path = new_path(spark, "event-tsv")
    e = corpus.events(spark, sf_dir)
    blank = F.array_repeat(F.lit(""), 54)
    fields = F.concat(
        F.array(F.col("event_id").cast("string"), F.concat("event_type", F.lit(" by user "), F.col("user_id").cast("string")), F.date_format("ts", "yyyyMMddHHmmss")),
        blank,
        F.array(F.concat(F.lit("https://events.example/"), F.col("event_id").cast("string"))),
    )
    e.select(F.array_join(fields, "\t").alias("value")).write.text(path)
    return files.tab_events(spark, path)


@query(
    "guarded_recent_sample",
    f"""SELECT id, {strip('content')} AS content FROM (SELECT *, {strip('title')} AS bare_title, {strip('content')} AS bare_content FROM articles
  WHERE collected_at < TIMESTAMP '2024-01-28 00:30:00' - INTERVAL 1 HOUR ORDER BY collected_at DESC, id DESC LIMIT 300)
  WHERE length(bare_title) >= 10 AND length(bare_content) >= 50
  AND NOT len(list_distinct([w for w in regexp_split_to_array(bare_content, '[ \\n\\r\\t]+') if w <> ''])) < len([w for w in regexp_split_to_array(bare_content, '[ \\n\\r\\t]+') if w <> '']) * 0.3""",
)
def guarded_recent_sample(spark, sf_dir):
    docs = corpus.articles(spark, sf_dir).withColumnRenamed("collected_at", "published_at")
    now = F.lit("2024-01-28 00:30:00").cast("timestamp")
    return payloads.guarded_recent_sample(docs, now, 300).select("id", "content")


# Payload fixtures: each document is one payload whose records are the lines of its text.
_LINES = "SELECT doc_id, i, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)"


def _lines(spark, sf_dir):
    return spread(corpus.table(spark, sf_dir, "documents")).withColumn("lines", F.split("text", "\n"))


@query(
    "feed_to_articles",
    f"""SELECT doc_id, t AS title, CASE WHEN i % 2 = 0 THEN t ELSE line END AS content FROM
  (SELECT *, {strip('line')} AS t FROM ({_LINES}))
  WHERE length({strip('t')}) > 3 AND length({strip('line')}) > 10""",
)
def feed_to_articles(spark, sf_dir):
    """Every second entry has no summary, so its title stands in."""
    entry = F.transform(
        "lines",
        lambda line, i: F.struct(line.alias("title"), F.when(i % 2 == 1, F.lit("")).otherwise(line).alias("summary")),
    )
    landed = _lines(spark, sf_dir).select("doc_id", F.to_json(F.struct(entry.alias("entries"))).alias("payload"))
    return payloads.feed_articles(landed).select("doc_id", "title", "content")


_POSTS = "SELECT conv_id * 1000 + turn AS post_id, role AS channel, turn + 1 AS score, split_part(text, chr(10), 1) AS title, text AS selftext FROM conversations"


def _posts(spark, sf_dir):
    return corpus.table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("post_id"), F.col("role").alias("channel"), (F.col("turn") + 1).alias("score"),
        F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("selftext"),
    )


@query(
    "posts_to_articles",
    f"""SELECT post_id, '[' || upper(channel) || '] ' || title AS title, selftext AS content FROM ({_POSTS}) WHERE score >= 3 AND title <> '' AND length(trim(selftext)) > 10""",
)
def posts_to_articles(spark, sf_dir):
    return payloads.post_articles(_posts(spark, sf_dir), [F.col("post_id")], "post_id").select("post_id", "title", "content")


@query(
    "posts_feed_to_articles",
    f"""SELECT post_id, t AS title, c AS content FROM (SELECT post_id, '[' || upper(channel) || '] ' || title AS t,
  CASE WHEN length({squeeze('selftext')}) >= 60 THEN {squeeze('selftext')} ELSE title END AS c FROM ({_POSTS}) WHERE title <> '') WHERE length(trim(c)) > 10""",
)
def posts_feed_to_articles(spark, sf_dir):
    return payloads.post_feed_articles(_posts(spark, sf_dir), [F.col("post_id")], "post_id").select("post_id", "title", "content")


_CODES = " ".join(f"WHEN k IN ({', '.join(map(str, codes))}) THEN '{label}'" for label, codes in payloads.WEATHER_LABELS.items())


@query(
    "weather_bulletins",
    f"""SELECT event_id, 'Bulletin meteo ville' || user_id || ': ' || t || 'C - ' || label AS title,
  'Meteo du jour a ville' || user_id || '. Temperature ' || t || ' degres, conditions ' || label || '. Weather code ' || k || '. Suivi climat, precipitation, vent et alertes orage.' AS content
  FROM (SELECT event_id, user_id, k, CAST(floor(value) AS BIGINT) % 40 AS t, CASE {_CODES} ELSE 'conditions variables' END AS label
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))""",
)
def weather_bulletins(spark, sf_dir):
    readings = corpus.events(spark, sf_dir).select(
        "event_id", F.concat(F.lit("ville"), F.col("user_id").cast("string")).alias("city"),
        (F.floor("value") % 40).alias("temperature"), F.get_json_object("props", "$.k").alias("code"),
    )
    return payloads.weather_bulletins(readings).select("event_id", "title", "content")


@query(
    "nested_payload_union",
    f"""SELECT doc_id, '[CONSULT] ' || line AS title, 'Theme: ' || lang || '. Territoire: ' || source || '. Fin: .' AS content,
  CASE WHEN n > 1 AND i = n THEN 'https://consult.example' ELSE 'https://consult.example/consultations/c' || length(line) END AS url
  FROM (SELECT l.*, d.lang, d.source, len(string_split(d.text, chr(10))) AS n FROM ({_LINES}) l JOIN documents d USING (doc_id))""",
)
def nested_payload_union(spark, sf_dir):
    """The last of several lines is the finished consultation, without a slug."""

    def record(line, slug):
        theme = F.struct(F.col("lang").alias("label")).alias("thematique")
        return F.struct(line.alias("title"), theme, F.col("source").alias("territory"), slug.alias("slug"))

    size = F.size("lines")
    ongoing = F.transform(
        F.when(size > 1, F.slice("lines", F.lit(1), size - 1)).otherwise(F.col("lines")),
        lambda line: record(line, F.concat(F.lit("c"), F.length(line).cast("string"))),
    )
    finished = F.transform(F.when(size > 1, F.slice("lines", -1, 1)), lambda line: record(line, F.lit(None).cast("string")))
    landed = _lines(spark, sf_dir).select(
        "doc_id", F.to_json(F.struct(ongoing.alias("ongoing"), finished.alias("finished"))).alias("payload")
    )
    return payloads.consultation_articles(landed, "CONSULT", "https://consult.example").select("doc_id", "title", "content", "url")


@query(
    "payload_first_array",
    f"""SELECT doc_id, line AS title, line AS content, '' AS url FROM ({_LINES}) JOIN documents USING (doc_id)
  WHERE length({strip('line')}) > 10""",
)
def payload_first_array(spark, sf_dir):
    """English payloads hold articles, French an empty list before items, the others results."""
    records = F.transform("lines", lambda line: F.struct(line.alias("title"), line.alias("content")))
    none = F.filter(records, lambda r: F.lit(False))
    lang = F.col("lang")
    landed = _lines(spark, sf_dir).select(
        "doc_id",
        F.to_json(
            F.struct(
                F.when(lang == "en", records).when(lang == "fr", none).alias("articles"),
                F.when(lang == "fr", records).alias("items"),
                records.alias("results"),
            )
        ).alias("payload"),
    )
    return payloads.generic_articles(landed).select("doc_id", "title", "content", "url")


@query(
    "payload_candidate_keys",
    f"""SELECT doc_id, '[STAT series] ' || {strip('line')} AS title, {squeeze('line')} AS content, 'https://stats.example' AS url
  FROM ({_LINES}) WHERE length({strip('line')}) >= 4 AND length({squeeze('line')}) > 10""",
)
def payload_candidate_keys(spark, sf_dir):
    """Records two levels down, their title under a late key and their text under ``resume``."""
    records = F.transform("lines", lambda line: F.struct(F.lit("").alias("title"), line.alias("libelle"), line.alias("resume")))
    nested = F.struct(F.struct(records.alias("series")).alias("_embedded"))
    landed = _lines(spark, sf_dir).select("doc_id", F.to_json(nested).alias("payload"))
    return payloads.record_articles(landed, "STAT series", "https://stats.example").select("doc_id", "title", "content", "url")


@query(
    "catalogue_to_articles",
    f"""SELECT slug, '[catalogue] ' || {strip('title')} AS title, {squeeze('content')} AS content, 'https://data.example/fr/datasets/' || slug || '/' AS url
  FROM (SELECT *, source || '-' || md5(title) AS slug FROM articles WHERE {strip('title')} <> '' AND length({squeeze('content')}) >= 25
  QUALIFY row_number() OVER (PARTITION BY source || '-' || md5(title) ORDER BY id) = 1) WHERE length({strip('title')}) > 0""",
)
def catalogue_to_articles(spark, sf_dir):
    records = corpus.articles(spark, sf_dir).select(
        "id", "title", F.col("content").alias("description"), F.concat("source", F.lit("-"), F.md5("title")).alias("slug")
    )
    rows = payloads.catalogue_articles(records, "catalogue", "https://data.example", [F.col("id")])
    return rows.select("slug", "title", "content", "url")


@query(
    "pages_to_links",
    """WITH a AS (SELECT page_id, url, unnest(range(1, len(h) + 1)) AS i, unnest(h) AS href, unnest(t) AS txt FROM
  (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS t FROM pages)),
  k AS (SELECT *, CASE WHEN starts_with(href, 'http') THEN href ELSE regexp_extract(url, '^(https?://[^/?#]+)', 1) || CASE WHEN starts_with(href, '/') THEN href ELSE '/' || href END END AS link
  FROM a WHERE contains(lower(href), '/') AND NOT contains(lower(href), 'the') AND length(trim(txt)) >= 8)
  SELECT '[PAGES] ' || split_part(txt, '. ', 1) AS title, txt AS content, link AS url FROM k WHERE length(txt) > 10
  QUALIFY row_number() OVER (PARTITION BY link ORDER BY page_id, i) = 1""",
)
def pages_to_links(spark, sf_dir):
    rows = pages.link_articles(corpus.table(spark, sf_dir, "pages"), "PAGES", ("/",), ("the",), min_text=8)
    return rows.select("title", "content", "url")


@query("labelled_corpus", "SELECT CASE sentiment WHEN 'positif' THEN 'pos' WHEN 'negatif' THEN 'neg' ELSE 'neu' END AS label, " + strip("content") + " AS text FROM gold")
def labelled_corpus(spark, sf_dir):
    return files.labelled_corpus(corpus.gold(spark, sf_dir).select("content", "sentiment"))


@query(
    "run_history",
    "SELECT strftime(generated_at, '%Y-%m-%d %H:%M:%S') AS generated_at, status, loaded, array_to_string(reasons, '; ') AS reasons FROM runs ORDER BY 1 DESC LIMIT 10",
)
def run_history(spark, sf_dir):
    """Run records written as JSON beside damaged lines, read back newest first."""
    path = new_path(spark, "run-records")
    records = corpus.runs(spark, sf_dir).select(
        F.to_json(
            F.struct(F.date_format("generated_at", "yyyy-MM-dd HH:mm:ss").alias("generated_at"), "status", "reasons", "loaded")
        ).alias("value")
    )
    damaged = records.select(F.expr("substr(value, 1, 20)").alias("value"))
    records.unionByName(damaged).write.text(path)
    return files.run_history(spark, path).select("generated_at", "status", "loaded", F.array_join("reasons", "; ").alias("reasons"))
