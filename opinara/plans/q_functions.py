"""Cleaning, validity, keys and label functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import labels, lexicon, text
from opinara.operators import datasets, layers
from opinara.operators.aggregates import dated
from opinara.plans import corpus
from opinara.plans.oracle import _topic_entries, lexicon_cte, readable, sanitized, squeeze, strip, unescaped
from opinara.plans.registry import query
from opinara.plans.vocabulary import LARGE_TOPICS, LEXICON, TOPICS
from opinara.storage import spread


def _dirty(df):
    """Documents framed by a byte-order mark, a bell, a no-break space and a decomposed accent."""
    return df.withColumn("dirty", F.concat(F.lit("﻿ "), "content", F.lit("\x07 é � ")))


_DIRTY = "chr(65279) || chr(160) || content || chr(7) || ' e' || chr(769) || ' ' || chr(65533) || chr(8195)"


@query("sanitize_text", f"SELECT id, {sanitized(_DIRTY)} AS clean FROM articles")
def sanitize_text(spark, sf_dir):
    return _dirty(corpus.articles(spark, sf_dir)).select("id", text.sanitize_text(F.col("dirty")).alias("clean"))


def _stripped_html(x: str) -> str:
    """Markup removed and the entities of the pages read, with or without their semicolon."""
    for pattern in ("(?is)<script[^>]*>.*?</script>", "(?is)<style[^>]*>.*?</style>", "(?s)<!--.*?-->", "(?s)<[^>]*>"):
        x = f"regexp_replace({x}, '{pattern}', ' ', 'g')"
    entities = (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("nbsp", " "), ("copy", "©"), ("middot", "·"), ("amp", "&"))
    for entity, character in entities:
        x = f"regexp_replace({x}, '&{entity};?', '{character}', 'g')"
    return x


@query("clean_html", f"SELECT page_id, {squeeze(_stripped_html('html'))} AS clean FROM pages")
def clean_html(spark, sf_dir):
    page_text = text.normalize_ws(text.clean_html(F.col("html")))
    return spread(corpus.table(spark, sf_dir, "pages")).select("page_id", page_text.alias("clean"))


@query("normalize_ws", f"SELECT id, {squeeze('content')} AS clean FROM articles")
def normalize_ws(spark, sf_dir):
    return corpus.articles(spark, sf_dir).select("id", text.normalize_ws(F.col("content")).alias("clean"))


@query("clean_articles", f"SELECT id, {sanitized('title')} AS title, {squeeze(unescaped(sanitized('content')))} AS content, url FROM articles")
def clean_articles(spark, sf_dir):
    return text.clean_articles(corpus.articles(spark, sf_dir)).select("id", "title", "content", "url")


@query("fingerprint", "SELECT id, fingerprint FROM landed")
def fingerprint(spark, sf_dir):
    return corpus.landed(spark, sf_dir).select("id", "fingerprint")


_WORDS = "[w for w in regexp_split_to_array(content, '[ \\n\\r\\t]+') if w <> '']"


@query("repetition_guard", f"SELECT id, len(list_distinct({_WORDS})) < len({_WORDS}) * 0.3 AS repetitive FROM articles")
def repetition_guard(spark, sf_dir):
    return corpus.articles(spark, sf_dir).select("id", text.is_repetitive(F.col("content")).alias("repetitive"))


@query("valid_articles", f"SELECT id, length({strip('title')}) > 3 AND length({strip('content')}) > 10 AS valid FROM articles")
def valid_articles(spark, sf_dir):
    return corpus.articles(spark, sf_dir).select("id", text.is_valid(F.col("title"), F.col("content")).alias("valid"))


@query(
    "reject_reason",
    f"""SELECT id, CASE WHEN length({strip('title')}) > 3 AND length({strip('line')}) > 10 THEN NULL WHEN {strip('title')} = '' THEN 'empty_title'
  WHEN {strip('line')} = '' THEN 'empty_content' WHEN length({strip('title')}) <= 3 THEN 'title_too_short' WHEN length({strip('line')}) <= 10 THEN 'content_too_short'
  ELSE 'other_invalid' END AS reason FROM (SELECT id, title, url, list_extract(string_split(content, chr(10)), -1) AS line FROM articles)""",
)
def reject_reason(spark, sf_dir):
    """The last line stands for the content, so that short and empty ones occur."""
    rows = corpus.articles(spark, sf_dir).withColumn("line", F.substring_index("content", "\n", -1))
    return rows.select("id", text.reject_reason(F.col("title"), F.col("line"), F.col("url")).alias("reason"))


@query("base_quality", "SELECT id, quality_score FROM raw")
def base_quality(spark, sf_dir):
    return corpus.raw(spark, sf_dir).select("id", text.base_quality(F.col("source")).alias("quality_score"))


@query(
    "quality_filter",
    f"""SELECT id, round(least(0.5::DOUBLE + CASE WHEN length({strip('title')}) > 10 THEN 0.2 ELSE 0 END + CASE WHEN length({strip('content')}) > 50 THEN 0.3 ELSE 0 END, 1.0), 10) AS quality
  FROM landed QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY id) = 1""",
)
def quality_filter(spark, sf_dir):
    quality = text.completeness_quality(F.col("title"), F.col("content"))
    rows = datasets.quality_filter(corpus.landed(spark, sf_dir), quality)
    return rows.select("id", F.round("quality", 10).alias("quality"))


@query("source_type", "SELECT name, source_type FROM sources")
def source_type(spark, sf_dir):
    return corpus.sources(spark, sf_dir).select("name", text.source_type(F.col("name")).alias("source_type"))


@query(
    "foundation_sources",
    """WITH c AS (SELECT source_id, name, CASE WHEN contains(lower(name), 'gdelt_last15') OR contains(lower(name), 'gdelt_master') THEN 'bigdata'
  WHEN contains(lower(name), 'kaggle') THEN 'flat_files' WHEN lower(name) = 'gdelt_events' THEN 'bigdata' WHEN contains(lower(name), 'zzdb') AND contains(lower(name), 'csv') THEN 'db_non_relational'
  ELSE 'real_source' END AS foundation_type, contains(lower(name), 'kaggle') OR lower(name) = 'gdelt_events' AS frozen FROM sources)
  SELECT name, foundation_type <> 'real_source' AS is_foundation, foundation_type, frozen,
  NOT (frozen AND source_id IN (SELECT source_id FROM sync_log WHERE status = 'FOUNDATION_INTEGRATED')) AS collect FROM c""",
)
def foundation_sources(spark, sf_dir):
    """Class of each source, and whether it is still collected: frozen ones stop after their first load."""
    classed = corpus.sources(spark, sf_dir).withColumn("_c", text.foundation_class(F.col("name")))
    loaded = (
        corpus.sync_log(spark, sf_dir).filter(F.col("status") == "FOUNDATION_INTEGRATED").select("source_id").distinct()
        .withColumn("_loaded", F.lit(True))
    )
    done = F.coalesce("_loaded", F.lit(False))
    return classed.join(loaded, "source_id", "left").select("name", "_c.*", (~(F.col("_c.frozen") & done)).alias("collect"))


@query(
    "readable_text",
    f"SELECT id, {readable('head')} AS readable, {readable('whole')} AS readable_whole FROM "
    f"(SELECT id, substring({strip('content')}, 1, 400) AS head, {strip('content')} AS whole FROM articles)",
)
def readable_text(spark, sf_dir):
    """By the opening of the text, a width the caller names, and by the whole text."""
    content = F.col("content")
    return corpus.articles(spark, sf_dir).select(
        "id", text.is_readable(content, 400).alias("readable"), text.is_readable(content).alias("readable_whole")
    )


@query(
    "harmonize_id",
    """SELECT doc, CASE WHEN lang <> 'de' THEN fingerprint WHEN lang = 'de' AND source LIKE 'src1%' THEN url ELSE trim(title) END AS id
  FROM (SELECT *, id AS doc FROM landed) WHERE NOT (lang = 'de' AND source NOT LIKE 'src1%' AND trim(title) = '')""",
)
def harmonize_id(spark, sf_dir):
    """German rows lose their hash, most of them their url too."""
    german = F.col("lang") == "de"
    rows = corpus.landed(spark, sf_dir).withColumns(
        {
            "doc": F.col("id"),
            "fingerprint": F.when(german, F.lit("  ")).otherwise(F.col("fingerprint")),
            "url": F.when(german & ~F.col("source").like("src1%"), F.lit(None)).otherwise(F.col("url")),
        }
    )
    return layers.harmonize_id(rows).filter(~(german & ~F.col("source").like("src1%") & (F.trim("title") == ""))).select("doc", "id")


_SPELLED = """CASE event_type WHEN 'error' THEN ' nan' WHEN 'click' THEN '<NA>' WHEN 'view' THEN 'None' WHEN 'signup' THEN NULL ELSE ' ' || event_id || ' ' END"""


@query("normalize_id", f"SELECT event_id, CASE WHEN trim({_SPELLED}) IN ('<NA>', 'nan', 'None') OR {_SPELLED} IS NULL THEN '' ELSE trim({_SPELLED}) END AS id FROM events")
def normalize_id(spark, sf_dir):
    return corpus.events(spark, sf_dir).select("event_id", text.normalize_id(F.expr(_SPELLED.replace("event_id", "cast(event_id as string)"))).alias("id"))


@query(
    "model_texts",
    f"SELECT CAST(id AS VARCHAR) AS id, title, {strip('title || chr(32) || content')} AS text FROM raw",
)
def model_texts(spark, sf_dir):
    return datasets.model_texts(corpus.raw(spark, sf_dir))


@query(
    "dated_rows",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS dt FROM events WHERE event_type <> 'error'""",
)
def dated_rows(spark, sf_dir):
    """Times in ISO text, plain text, and unreadable for errors."""
    kind = F.col("event_type")
    shown = (
        F.when(kind == "error", "yesterday")
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    rows = corpus.events(spark, sf_dir).select("event_id", shown.alias("published_at"))
    return dated(rows).select("event_id", F.date_format("dt", "yyyy-MM-dd HH:mm:ss").alias("dt"))


@query("ascii_fold", "SELECT id, strip_accents(lower(content)) AS folded FROM articles")
def ascii_fold(spark, sf_dir):
    return corpus.articles(spark, sf_dir).select("id", text.ascii_fold(F.col("content")).alias("folded"))


# Spellings of labels as events carry them.
_LABEL = """CASE event_type WHEN 'error' THEN 'Négatif' WHEN 'click' THEN ' POSITIVE ' WHEN 'view' THEN 'neutre'
  WHEN 'signup' THEN CASE WHEN user_id < 50 THEN '5' WHEN user_id < 100 THEN 'n?gatif' ELSE 'LABEL_0' END
  ELSE CASE WHEN user_id < 50 THEN 'very_neg' WHEN user_id < 100 THEN '3' ELSE 'mixed' END END"""
_F = f"strip_accents(lower(trim({_LABEL})))"
_L = f"lower(trim({_LABEL}))"
_CLASSED = f"""CASE WHEN {_F} IN ('negatif', 'negative', 'neg') OR ({_F} LIKE 'n%' AND {_F} LIKE '%gatif') THEN 'negatif'
  WHEN {_F} IN ('positif', 'positive', 'pos') THEN 'positif' WHEN {_F} IN ('neutre', 'neutral', 'neu') THEN 'neutre'"""


def _labelled_events(spark, sf_dir, classify, name):
    rows = corpus.events(spark, sf_dir)
    return rows.select("event_id", classify(F.expr(_LABEL)).alias(name))


@query("normalize_label", f"SELECT event_id, {_CLASSED} ELSE 'neutre' END AS label FROM events")
def normalize_label(spark, sf_dir):
    return _labelled_events(spark, sf_dir, labels.normalize_label, "label")


@query("strict_label", f"SELECT event_id, {_CLASSED} END AS label FROM events")
def strict_label(spark, sf_dir):
    return _labelled_events(spark, sf_dir, labels.strict_label, "label")


@query(
    "strict_polarity",
    f"""SELECT event_id, CASE WHEN {_L} IN ('pos', 'positive', 'positif', '5', '4') THEN 'pos' WHEN {_L} IN ('neg', 'negative', 'négatif', 'negatif', '1', '2') THEN 'neg'
  WHEN {_L} IN ('neu', 'neutral', 'neutre', 'neutre.') THEN 'neu' END AS label FROM events""",
)
def strict_polarity(spark, sf_dir):
    return _labelled_events(spark, sf_dir, labels.strict_polarity, "label")


@query(
    "canonical_sentiment",
    f"""SELECT event_id, CASE WHEN {_L} IN ('positif', 'positive', 'pos', '4', '5') THEN 'positif' WHEN {_L} IN ('négatif', 'negatif', 'negative', 'neg', '1', '2') THEN 'negatif'
  WHEN {_L} IN ('neutre', 'neutral', 'neu', '3') THEN 'neutre' ELSE 'inconnu' END AS label FROM events""",
)
def canonical_sentiment(spark, sf_dir):
    return _labelled_events(spark, sf_dir, labels.canonical_sentiment, "label")


@query(
    "label_polarity",
    f"""SELECT event_id, CASE WHEN {_F} IN ('positive', 'pos', 'positif', '5', 'very_pos', '4', 'label_2') THEN 'pos' WHEN {_F} IN ('negative', 'neg', 'negatif', '1', 'very_neg', '2', 'label_0') THEN 'neg'
  WHEN {_F} IN ('neutral', 'neu', 'neutre', '3', 'label_1') THEN 'neu' WHEN regexp_matches({_F}, 'negative|negatif|very_neg') THEN 'neg'
  WHEN regexp_matches({_F}, 'positive|positif|very_pos') THEN 'pos' ELSE 'neu' END AS label FROM events""",
)
def label_polarity(spark, sf_dir):
    return _labelled_events(spark, sf_dir, labels.label_polarity, "label")


def _families(spark, sf_dir):
    """Class scores under the label family of the document's language: English names, numbers, stars, French names."""
    scored = corpus.lexicon_scores(corpus.raw(spark, sf_dir), lexicon.title_and_content())
    neg, neu, pos = (F.col("scores")[i]["score"] for i in range(3))

    def listed(*pairs):
        return F.array(*[F.struct(F.lit(label).alias("label"), value.alias("score")) for label, value in pairs])

    lang = F.col("lang")
    family = (
        F.when(lang == "en", listed(("NEGATIVE", neg * 2), ("NEUTRAL", neu * 2), ("POSITIVE", pos * 2)))
        .when(lang == "de", listed(("LABEL_0", neg), ("LABEL_1", neu), ("LABEL_2", pos)))
        .when(lang == "es", listed(("1 star", neg * 0.5), ("2 stars", neg * 0.5), ("3 stars", neu), ("4 stars", pos * 0.25), ("5 stars", pos * 0.75)))
        .otherwise(listed(("Négatif", neg), ("neutre", neu), ("positif", pos)))
    )
    return scored.withColumn("scores", family)


_SHARES = f"""SELECT id, lang, (pos + 0.5::DOUBLE) / (pos + neg + 1.5::DOUBLE) AS p, 0.5::DOUBLE / (pos + neg + 1.5::DOUBLE) AS u, (neg + 0.5::DOUBLE) / (pos + neg + 1.5::DOUBLE) AS n
  FROM ({lexicon_cte('raw', "title || ' ' || content", '*')})"""
_FOLD = """SELECT id, CASE WHEN p >= u AND p >= n THEN 'POSITIVE' WHEN u >= n THEN 'NEUTRAL' ELSE 'NEGATIVE' END AS label_3c, round_even(greatest(p, u, n), 4) AS confidence,
  round_even(p, 4) AS p_pos, round_even(u, 4) AS p_neu, round_even(n, 4) AS p_neg, round_even(p - n, 4) AS sentiment_score"""


@query("fold_probabilities", f"{_FOLD} FROM ({_SHARES})")
def fold_probabilities(spark, sf_dir):
    return labels.fold_probabilities(_families(spark, sf_dir)).select("id", "out.*")


@query(
    "fold_probabilities_generic",
    f"""{_FOLD} FROM ({_SHARES})""",
)
def fold_probabilities_generic(spark, sf_dir):
    """Named labels only: a star label has no polarity in this folding."""
    scored = corpus.lexicon_scores(corpus.raw(spark, sf_dir), lexicon.title_and_content())
    return labels.fold_probabilities_generic(scored).select("id", "out.*")


@query("refine_sentiment")
def refine_sentiment(spark, sf_dir):
    """French rule words are rare in the corpus; the rules themselves are checked on sentences in the tests."""
    folded = labels.fold_probabilities_generic(corpus.lexicon_scores(corpus.raw(spark, sf_dir), lexicon.title_and_content()))
    rows = folded.withColumn("text", lexicon.title_and_content())
    return labels.refine_sentiment(rows).select("id", "out.*")


@query("french_label", "SELECT id, predicted_sentiment AS label FROM latest_run")
def french_label(spark, sf_dir):
    return corpus.latest_run(spark, sf_dir).select("id", labels.french_label(F.col("label_3c")).alias("label"))


@query(
    "topic_scores",
    f"""SELECT id, x.t AS topic, -x.s AS score FROM (SELECT id, unnest([x for x in {_topic_entries()} if x.s < 0]) AS x
  FROM (SELECT id, strip_accents(lower(title)) AS ft, strip_accents(lower(content)) AS fc FROM raw))""",
)
def topic_scores(spark, sf_dir):
    return _topic_rows(spark, sf_dir, TOPICS)


def _topic_rows(spark, sf_dir, topics):
    scored = lexicon.add_topic_scores(corpus.raw(spark, sf_dir), topics)
    entries = scored.select("id", F.explode_outer("topic_scores").alias("t")).filter(F.col("t").isNotNull())
    return entries.select("id", "t.topic", "t.score")


@query(
    "topic_scores_large",
    f"""SELECT id, x.t AS topic, -x.s AS score FROM (SELECT id, unnest([x for x in {_topic_entries(LARGE_TOPICS)} if x.s < 0]) AS x
  FROM (SELECT id, strip_accents(lower(title)) AS ft, strip_accents(lower(content)) AS fc FROM raw))""",
)
def topic_scores_large(spark, sf_dir):
    return _topic_rows(spark, sf_dir, LARGE_TOPICS)


@query(
    "lexicon_totals",
    f"SELECT id, pos AS pos_total, neg AS neg_total FROM ({lexicon_cte('raw', 'content', 'id')})",
)
def lexicon_totals(spark, sf_dir):
    return lexicon.lexicon_totals(corpus.raw(spark, sf_dir), F.col("content"), LEXICON).select("id", "pos_total", "neg_total")
