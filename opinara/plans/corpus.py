"""Engine inputs read from, or derived by Spark from, the tables in ``sf_dir``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import labels, lexicon, text
from opinara.functions.numbers import one_of
from opinara.operators import layers
from opinara.operators.skew import drop_copies
from opinara.plans.vocabulary import LEXICON, TOPICS
from opinara.storage import spread, stage

# The corpus numbers its sources; a few get names that the source rules know.
SOURCE_NAMES = {
    "src0": "zzdb_csv",
    "src1": "kaggle_reviews",
    "src2": "openweather_api",
    "src3": "reddit_france",
    "src4": "yahoo_finance",
    "src5": "gdelt_events",
    "src6": "GDELT_Last15_English",
    "src7": "rss_french_news",
    "src8": "trustpilot_reviews",
}
# Enrichment has run up to these days; later articles form the backlog.
TAGGED_BEFORE, SCORED_BEFORE = "2024-01-29", "2024-01-30"
RUN_1, RUN_2, RUN_3 = "run-a", "run-b", "run-c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named_source(source: Column) -> Column:
    return one_of(*[(source == number, name) for number, name in SOURCE_NAMES.items()], default=source)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per document; the text stays whole."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
    return spread(table(spark, sf_dir, "documents").drop("n_chars")).select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("content"),
        named_source(F.col("source")).alias("source"),
        F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string")).alias("url"),
        "lang",
        day.cast("timestamp").alias("collected_at"),
        day.alias("date"),
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source registry: one row per distinct source of the documents."""
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("bigint")
    name = named_source(F.col("source"))
    return (
        table(spark, sf_dir, "documents")
        .select("source")
        .distinct()
        .select(
            number.alias("source_id"),
            name.alias("name"),
            text.source_type(name).alias("source_type"),
            (number % 5 != 4).alias("active"),
            F.lower(name).like("zzdb%").alias("is_synthetic"),
        )
    )


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed articles with a number of each row, ``_row``; ids may repeat."""

    def build() -> DataFrame:
        hashed = articles(spark, sf_dir).withColumn("fingerprint", text.fingerprint(F.col("title"), F.col("content")))
        return hashed.withColumn("_row", F.monotonically_increasing_id())

    return _layer(spark, sf_dir, "landed", build)


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with the content hash, before validity and dedup."""
    return _numbered(spark, sf_dir).drop("_row")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored articles: valid, one per content hash, with source facts."""

    def build() -> DataFrame:
        valid = _numbered(spark, sf_dir).filter(text.is_valid(F.col("title"), F.col("content")))
        return drop_copies(valid, ["fingerprint"], [F.col("id")], "_row").drop("_row").withColumns(
            {
                "quality_score": text.base_quality(F.col("source")),
                "source_type": text.source_type(F.col("source")),
                "is_synthetic": F.lower("source").like("zzdb%"),
            }
        )

    return _layer(spark, sf_dir, "raw", build)


def topic_links(articles_: DataFrame) -> DataFrame:
    """Assigned topics, one row per link."""
    tagged = lexicon.add_topics(articles_, TOPICS)
    return tagged.select("id", F.posexplode_outer("topics").alias("place", "link")).select(
        (F.col("id") * 2 + F.col("place")).alias("doc_topic_id"),
        F.col("id").alias("raw_data_id"),
        F.col("link.topic").alias("topic"),
        F.col("link.score").alias("confidence_score"),
        F.col("link.tagger").alias("tagger"),
    )


def document_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored topic links: those of the articles tagged so far."""

    def build() -> DataFrame:
        return topic_links(raw(spark, sf_dir).filter(F.col("date") < TAGGED_BEFORE))

    return _layer(spark, sf_dir, "document_topic", build)


def topics(spark: SparkSession) -> DataFrame:
    """Topic registry of the word table."""
    rows = [(i, name) for i, name in enumerate([*TOPICS.keywords, lexicon.FALLBACK_TOPIC], 1)]
    return spark.createDataFrame(rows, "topic_id bigint, name string")


def word_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexicon totals of title and whole text of each stored article, without the text: it is read and counted once for all runs."""

    def build() -> DataFrame:
        rows = raw(spark, sf_dir).withColumn("n_chars", F.length("content"))
        for name, subject in (("of_title", F.col("title")), ("of_text", lexicon.title_and_content())):
            counted = lexicon.lexicon_totals(rows, subject, LEXICON)
            rows = counted.withColumn(name, F.struct("pos_total", "neg_total")).drop("pos_total", "neg_total")
        return rows.select("id", "title", "lang", "date", "n_chars", "of_title", "of_text")

    return _layer(spark, sf_dir, "word_totals", build)


def model_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment outputs: a first pass over titles, a second over whole texts, and the scored run."""

    def build() -> DataFrame:
        base = word_totals(spark, sf_dir).filter(F.col("date") < SCORED_BEFORE)
        passes = [
            lexicon.add_verdict(base.select("id", "date", f"{counted}.*")).select(
                (F.col("id") * 2 + offset).alias("output_id"),
                F.col("id").alias("raw_data_id"),
                F.lit("sentiment_keyword").alias("model_name"),
                F.col("sentiment").alias("label"),
                F.col("sentiment_score").alias("score"),
                F.date_add("date", offset).cast("timestamp").alias("created_at"),
            )
            for offset, counted in enumerate(("of_title", "of_text"))
        ]
        scored = predictions(spark, sf_dir).filter(F.col("run") == RUN_2)
        learned = scored.select(
            (F.col("id").cast("bigint") + 1_000_000_000_000).alias("output_id"),
            F.col("id").cast("bigint").alias("raw_data_id"),
            F.lit("sentiment_scorer").alias("model_name"),
            F.col("predicted_sentiment").alias("label"),
            F.col("confidence").alias("score"),
            F.col("date").cast("timestamp").alias("created_at"),
        )
        return passes[0].unionByName(passes[1]).unionByName(learned)

    return _layer(spark, sf_dir, "model_output", build)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.silver(raw(spark, sf_dir), document_topic(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        return layers.gold(silver(spark, sf_dir), model_output(spark, sf_dir))

    return _layer(spark, sf_dir, "gold", build)


def lexicon_scores(df: DataFrame, subject: Column) -> DataFrame:
    """Adds ``scores`` (array of label and score) from smoothed lexicon shares."""
    return add_shares(lexicon.lexicon_totals(df, subject, LEXICON))


def add_shares(totals: DataFrame) -> DataFrame:
    """The same for rows with ``pos_total`` and ``neg_total``, which go."""
    whole = F.col("pos_total") + F.col("neg_total") + 1.5

    def share(label: str, count: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), ((count + 0.5) / whole).alias("score"))

    scores = F.array(
        share(labels.NEGATIVE, F.col("neg_total")),
        share(labels.NEUTRAL, F.lit(0)),
        share(labels.POSITIVE, F.col("pos_total")),
    )
    return totals.withColumn("scores", scores).drop("pos_total", "neg_total")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction rows of three runs: titles, whole texts, and a later small run over German texts."""

    def build() -> DataFrame:
        base = word_totals(spark, sf_dir)
        runs = (
            (RUN_1, "2024-02-01", base, "of_title"),
            (RUN_2, "2024-02-02", base, "of_text"),
            (RUN_3, "2024-02-02", base.filter(F.col("lang") == "de"), "of_text"),
        )
        frames = []
        for run, day, rows, counted in runs:
            scored = labels.fold_probabilities(add_shares(rows.select("id", "title", "n_chars", f"{counted}.*")))
            frames.append(
                scored.select(
                    F.col("id").cast("string").alias("id"),
                    labels.french_label(F.col("out.label_3c")).alias("predicted_sentiment"),
                    F.col("out.sentiment_score").alias("predicted_sentiment_score"),
                    *[f"out.{c}" for c in ("label_3c", "confidence", "p_pos", "p_neu", "p_neg")],
                    F.floor(F.col("n_chars") / 10).cast("int").alias("inference_ms"),
                    "title",
                    F.lit("lexicon-1").alias("model_version"),
                    F.lit(run).alias("run"),
                    F.lit(day).cast("date").alias("date"),
                )
            )
        return frames[0].unionByName(frames[1]).unionByName(frames[2])

    return _layer(spark, sf_dir, "predictions", build)


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(spark, sf_dir).filter(F.col("run") == RUN_2)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected class of the labelled documents beside the scored run."""
    expected = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        one_of((F.col("toxic") == 1, labels.NEGATIVE), (F.col("quality") == 1, labels.POSITIVE), default=labels.NEUTRAL)
        .alias("y_true"),
    )
    scored = latest_run(spark, sf_dir).select(
        "id", F.col("predicted_sentiment").alias("y_pred"), "p_neg", "p_neu", "p_pos"
    )
    return expected.join(scored, "id")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def sync_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("sync_log_id"),
        (F.col("user_id") % 20).alias("source_id"),
        F.col("ts").alias("sync_date"),
        F.floor("value").cast("bigint").alias("rows_synced"),
        one_of((kind == "error", "ERROR"), (kind == "signup", "FOUNDATION_INTEGRATED"), default="OK").alias("status"),
    )


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    resource = F.get_json_object("props", "$.k").cast("bigint")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("action_log_id"),
        F.col("user_id").alias("profil_id"),
        F.col("event_type").alias("action_type"),
        F.when(resource < 50, "article").otherwise("report").alias("resource_type"),
        F.when(resource >= 20, resource).alias("resource_id"),
        F.col("ts").alias("action_date"),
        F.when(F.col("value") < 30, F.concat(F.lit("10.0.0."), F.col("user_id").cast("string"))).alias("ip_address"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("profil_id"), F.col("c_name").alias("username"), F.col("c_mktsegment").alias("role")
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run record per half day of events: loaded rows, status and reasons."""
    at = F.window("ts", "12 hours")["start"].alias("generated_at")
    failed = F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0))
    loaded = F.sum(F.when(F.col("event_type") == "purchase", F.floor("value")).otherwise(0)).cast("bigint")
    return (
        events(spark, sf_dir)
        .groupBy(at)
        .agg(loaded.alias("loaded"), failed.cast("bigint").alias("errors"))
        .withColumn(
            "reasons",
            F.array_compact(
                F.array(
                    F.when(F.col("errors") > 35, F.lit("source errors")),
                    F.when(F.col("loaded") < 900, F.lit("loaded below threshold")),
                )
            ),
        )
        .withColumn("status", F.when(F.size("reasons") > 0, "WARN").otherwise("PASS"))
    )


_LAYERS: dict[tuple[str, str, str], DataFrame] = {}


def _layer(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A layer is written once per application and input folder; queries scan the files and prune columns."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LAYERS:
        _LAYERS[key] = stage(build(), name)
    return _LAYERS[key]
