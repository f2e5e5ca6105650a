"""Distributions, statistics, drift and insight facts over an enriched layer.

Every report first shrinks the layer with one map-side combining group-by; totals and shares are then computed on the
groups, as scalar subqueries, and never on a single-task window over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.labels import UNKNOWN, canonical_sentiment
from opinara.functions.lexicon import FALLBACK_TOPIC
from opinara.functions.numbers import one_of, ratio, round_even
from opinara.operators.filters import SOURCE_GROUPS, in_source_group, mentions
from opinara.operators.layers import parsed_time
from opinara.operators.skew import quantiles, top_per_group

# Thresholds of the reports.
DRIFT_ALERT_POINTS = 5.0
RISK_STEPS = ((0.45, 8), (0.35, 6), (0.25, 4))
TREND_MARGIN = 0.05
TREND_MINIMUM = 20
ECONOMIC_MINIMUM = 5
WEATHER_ALERTS = ("canicule", "alerte", "orange", "rouge", "orages", "crue", "inond")
WEATHER_MILD = r"ciel d[eé]gag[eé]|ensoleill|nuageux l[eé]ger|partiellement"
WEATHER_CITY = r"(?i)meteo\s+([A-Za-zÀ-ÿ\-]+)"
WEATHER_DEGREES = r"([\d.]+)\s*c"


def counts(df: DataFrame, *by: str | Column) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("count"))


def total_of(grouped: DataFrame, column: str = "count") -> Column:
    """Sum over the groups as a scalar subquery; the group-by shuffle is shared with the outer query."""
    return grouped.agg(F.sum(column)).scalar()


def with_share(grouped: DataFrame, name: str = "share", scale: float = 1.0) -> DataFrame:
    return grouped.withColumn(name, ratio(F.col("count"), total_of(grouped)) * scale)


def by_sentiment(df: DataFrame) -> DataFrame:
    return counts(df, "sentiment").orderBy(F.desc("count"), "sentiment")


def by_source(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("source")
        .agg(F.count("*").alias("count"), F.avg("sentiment_score").alias("avg_sentiment_score"))
        .orderBy(F.desc("count"), "source")
    )


def by_topic(df: DataFrame) -> DataFrame:
    """Counts per topic from a list column ``topics``, else from ``topic``, else no rows."""
    if "topics" in df.columns:
        rows = df.select(F.explode("topics").alias("topic"))
    elif "topic" in df.columns:
        rows = df.select("topic")
    else:
        rows = df.select(F.lit(None).cast("string").alias("topic")).limit(0)
    return counts(rows, "topic").orderBy(F.desc("count"), "topic")


def topic_list(value: Column, kind: str = "comma") -> Column:
    """Comma- or bar-joined topics as an array without blanks."""
    pieces = F.split(value, {"comma": ",", "bar": r"\|"}[kind])
    return F.filter(F.transform(pieces, F.trim), lambda t: t != "")


def top_topics(df: DataFrame, n: int) -> DataFrame:
    rows = df.filter(F.col("topic_1").isNotNull())
    return counts(rows, F.col("topic_1").alias("topic")).orderBy(F.desc("count"), "topic").limit(n)


def sentiment_distribution(df: DataFrame) -> DataFrame:
    return with_share(counts(df, "sentiment"), "percentage", 100.0).orderBy(F.desc("count"), "sentiment")


def daily_trend(df: DataFrame, date_column: str = "published_at") -> DataFrame:
    day = F.date_format(F.to_date(date_column), "yyyy-MM-dd").alias("date")
    return counts(df, day, "sentiment").orderBy("date", "sentiment")


def statistics(df: DataFrame) -> DataFrame:
    """One row: totals, score range and a map of counts per sentiment."""
    cells = df.groupBy(F.coalesce("sentiment", F.lit(UNKNOWN)).alias("sentiment"), "source").agg(
        F.count("*").alias("n"),
        F.sum("sentiment_score").alias("s"),
        F.count("sentiment_score").alias("scored"),
        F.max("sentiment_score").alias("high"),
        F.min("sentiment_score").alias("low"),
    )
    per_label = cells.groupBy("sentiment").agg(F.sum("n").alias("n"))
    spread = per_label.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("sentiment", "n")))))
    return cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_articles"),
        F.count_distinct("source").alias("total_sources"),
        ratio(F.sum("s"), F.sum("scored")).alias("avg_score"),
        F.max("high").alias("max_score"),
        F.min("low").alias("min_score"),
    ).withColumn("sentiment_distribution", spread.scalar())


def _entropy_parts(grouped: DataFrame) -> DataFrame:
    """Rows and bits of entropy from group sizes: log2(N) - sum(n log2 n) / N."""
    n = F.col("n").cast("double")
    return grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("classes"),
        (F.log2(F.sum(n)) - F.sum(n * F.log2(n)) / F.sum(n)).alias("bits"),
    )


def drift_score(rows: Column, classes: Column, bits: Column, top_topic: Column) -> list[Column]:
    """Entropy, dominance of the top topic and their mix; a single class counts as no entropy, no rows as zero."""
    spread = F.when(classes > 1, bits / F.log2(classes.cast("double"))).otherwise(0.0)
    dominance = F.coalesce(ratio(top_topic, rows), F.lit(0.0))
    empty = rows == 0

    def shown(value: Column) -> Column:
        return round_even(F.when(empty, 0.0).otherwise(value), 4)

    return [
        rows.alias("articles_total"),
        shown(F.when(classes > 1, bits).otherwise(0.0)).alias("sentiment_entropy"),
        shown(dominance).alias("topic_dominance"),
        shown((F.lit(1.0) - spread) * 0.5 + dominance * 0.5).alias("drift_score"),
    ]


def drift_cells(df: DataFrame, *by: str | Column) -> DataFrame:
    return df.groupBy(*by, F.coalesce("sentiment", F.lit(UNKNOWN)).alias("sentiment"), "topic_1").agg(
        F.count("*").alias("n")
    )


def drift_metrics(df: DataFrame) -> DataFrame:
    """One row of drift measures from a single pass over the layer."""
    cells = drift_cells(df)
    labels = _entropy_parts(cells.groupBy("sentiment").agg(F.sum("n").alias("n")))
    topics = cells.filter(F.col("topic_1").isNotNull()).groupBy("topic_1").agg(F.sum("n").alias("n"))
    return labels.withColumn("top", topics.agg(F.max("n")).scalar()).select(
        *drift_score(F.col("rows"), F.col("classes"), F.col("bits"), F.col("top"))
    )


def sentiment_drift(current: DataFrame, previous: DataFrame, threshold: float = DRIFT_ALERT_POINTS) -> DataFrame:
    """Share per label on both sides, the change in points and whether it raises an alert."""
    now = with_share(counts(current, "sentiment"), "current_pct", 100.0).select("sentiment", "current_pct")
    before = with_share(counts(previous, "sentiment"), "previous_pct", 100.0).select("sentiment", "previous_pct")
    return (
        now.join(before, "sentiment", "full")
        .na.fill(0.0, ["current_pct", "previous_pct"])
        .withColumn("delta", F.col("current_pct") - F.col("previous_pct"))
        .withColumn("alert", F.abs("delta") >= threshold)
    )


def corpus_profile(df: DataFrame, top_n: int = 8) -> DataFrame:
    """Long table (section, name, value): labels, topics, sources, scores and id quality."""
    topic = F.lower(F.trim(F.coalesce("topic_1", F.lit(""))))
    cells = (
        df.withColumn("_topic", F.when(~topic.isin("", "nan", "none", "null"), topic))
        .groupBy("sentiment", "_topic", "source")
        .agg(
            F.count("*").alias("n"),
            F.sum("sentiment_score").alias("s"),
            F.sum(F.col("sentiment_score") * F.col("sentiment_score")).alias("s2"),
        )
        .withColumn("_canonical", canonical_sentiment(F.col("sentiment")))
    )

    def table(section: str, column: str) -> DataFrame:
        grouped = cells.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("name"))
        return grouped.agg(F.sum("n").cast("double").alias("value")).select(F.lit(section).alias("section"), "name", "value")

    def facts(section: str, frame: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in frame.columns])
        return frame.select(F.inline(pairs)).select(F.lit(section).alias("section"), "name", "value")

    rows, mean = F.sum("n"), F.sum("s") / F.sum("n")
    overall = cells.agg(
        rows.alias("rows"),
        F.sum(F.when(F.lower(F.trim("sentiment")) != F.col("_canonical"), F.col("n")).otherwise(0)).alias("alias_rows"),
        F.count_distinct("_topic").alias("distinct_topics"),
        F.sum(F.when(F.col("_topic") == FALLBACK_TOPIC, F.col("n")).otherwise(0)).alias("fallback_rows"),
        mean.alias("mean_score"),
        F.sqrt(F.greatest((F.sum("s2") - rows * mean * mean) / (rows - 1), F.lit(0.0))).alias("std_score"),
    )
    per_id = df.groupBy("id").agg(F.count("*").alias("n"))
    ids = per_id.agg(
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("missing_ids"),
        F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("duplicate_ids"),
    )
    leading = table("source", "source").orderBy(F.desc("value"), "name").limit(top_n)
    parts = [
        table("label", "sentiment"), table("canonical", "_canonical"), table("topic", "_topic"), leading,
        facts("overall", overall), facts("ids", ids),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def label_mapping(df: DataFrame) -> DataFrame:
    """Raw label, the class it maps to, and its rows."""
    return counts(df, "sentiment").withColumn("canonical", canonical_sentiment(F.col("sentiment")))


def layer_profile(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and filled share of sentiment and first topic per layer."""

    def coverage(df: DataFrame, column: str) -> Column:
        if column not in df.columns:
            return F.lit(0.0)
        return F.coalesce(F.avg(F.when(F.col(column).isNotNull() & (F.col(column) != ""), 1.0).otherwise(0.0)), F.lit(0.0))

    profiles = [
        df.agg(
            F.count("*").alias("rows"), coverage(df, "sentiment").alias("sentiment_coverage"),
            coverage(df, "topic_1").alias("topic_coverage"),
        ).select(F.lit(name).alias("layer"), "rows", F.lit(len(df.columns)).alias("columns"), "sentiment_coverage", "topic_coverage")
        for name, df in layers.items()
    ]
    result = profiles[0]
    for profile in profiles[1:]:
        result = result.unionByName(profile)
    return result


def flow_kpis(df: DataFrame) -> DataFrame:
    """One row: rows, columns, coverage and distinct sources."""
    return layer_profile({"flow": df}).drop("layer").withColumn("sources", df.agg(F.count_distinct("source")).scalar())


def _largest(grouped: DataFrame, key: str) -> DataFrame:
    """One row with the key of the largest group, ties by name."""
    return grouped.agg(F.min(F.struct((-F.col("count")).alias("neg"), F.col(key).alias("key"))).alias("_m"))


def insight_facts(df: DataFrame, top_sources: int = 3) -> DataFrame:
    """One row: total, dominant label and share, mean score, top topic, leading sources."""
    cells = df.groupBy("sentiment", "topic_1", "source").agg(
        F.count("*").alias("count"), F.sum("sentiment_score").alias("s")
    )

    def largest(key: str) -> Column:
        grouped = cells.filter(F.col(key) != "").groupBy(key).agg(F.sum("count").alias("count"))
        return _largest(grouped, key).select("_m").scalar()

    leading = (
        cells.groupBy("source").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "source").limit(top_sources)
    )
    listed = leading.agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("neg"), "source"))), lambda s: s["source"]
            ),
            ",",
        )
    )
    return (
        cells.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"), ratio(F.sum("s"), F.sum("count")).alias("mean_score"))
        .withColumns({"_label": largest("sentiment"), "_topic": largest("topic_1"), "top_sources": listed.scalar()})
        .select(
            "total",
            "mean_score",
            F.col("_label.key").alias("dominant"),
            ratio(-F.col("_label.neg"), F.col("total")).alias("dominant_share"),
            F.col("_topic.key").alias("top_topic"),
            "top_sources",
        )
    )


def source_mix(df: DataFrame, n: int = 4) -> DataFrame:
    return with_share(counts(df.filter(F.col("source").isNotNull()), "source")).orderBy(F.desc("count"), "source").limit(n)


def risk_score(df: DataFrame) -> DataFrame:
    """Share of negative labels and the risk step it reaches."""
    label = F.lower(F.coalesce("sentiment", F.lit("")))
    share = F.avg(F.when(label.contains("neg") | label.contains("nég"), 1.0).otherwise(0.0))
    steps = [(F.col("negative_share") >= floor, risk) for floor, risk in RISK_STEPS]
    return df.agg(F.coalesce(share, F.lit(0.0)).alias("negative_share")).withColumn("risk", one_of(*steps, default=2))


def dated(df: DataFrame) -> DataFrame:
    """Adds ``dt`` from published_at when the frame has it, else collected_at; unreadable dates are dropped."""
    column = next(c for c in ("published_at", "collected_at") if c in df.columns)
    return df.withColumn("dt", parsed_time(F.col(column))).filter(F.col("dt").isNotNull())


def temporal_trend(df: DataFrame) -> DataFrame:
    """Mean score from the median time on against before it; no row under twenty dated rows."""
    rows = dated(df).select(F.unix_micros("dt").alias("micros"), "sentiment_score")
    median = quantiles(rows, "micros", {"median": 0.5}).scalar()
    recent = F.col("micros") >= F.col("_median")
    return (
        rows.withColumn("_median", median)
        .agg(
            F.avg(F.when(recent, F.col("sentiment_score"))).alias("score_recent"),
            F.avg(F.when(~recent, F.col("sentiment_score"))).alias("score_old"),
            F.count("*").alias("_n"),
        )
        .filter((F.col("_n") >= TREND_MINIMUM) & F.col("score_recent").isNotNull() & F.col("score_old").isNotNull())
        .withColumn(
            "trend",
            one_of(
                (F.col("score_recent") > F.col("score_old") + TREND_MARGIN, "hausse"),
                (F.col("score_recent") < F.col("score_old") - TREND_MARGIN, "baisse"),
                default="stable",
            ),
        )
        .drop("_n")
    )


def _theme_rows(df: DataFrame, patterns: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row per article and matching theme: the theme list is built per row, so nothing is joined."""
    found = F.array_compact(
        F.array(*[F.when(mentions(F.col("title"), parts), F.lit(theme)) for theme, parts in patterns.items()])
    )
    return df.withColumn("theme", F.explode_outer(found)).filter(F.col("theme").isNotNull())


def _theme_report(rows: DataFrame, titles: int, order: str) -> DataFrame:
    cells = rows.groupBy("theme", "sentiment").agg(F.count("*").alias("count"), F.sum("sentiment_score").alias("s"))
    summary = cells.groupBy("theme").agg(
        F.sum("count").alias("n"),
        (F.sum("s") / F.sum("count")).alias("mean_score"),
        F.min(F.struct((-F.col("count")).alias("neg"), F.col("sentiment").alias("key"))).alias("_m"),
    )
    samples = (
        top_per_group(rows.select("theme", order, "title"), ["theme"], [F.col(order)], titles, order)
        .groupBy("theme")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "title"))), lambda s: s["title"]), " | ").alias("sample_titles"))
    )
    return summary.join(samples, "theme").select(
        "theme", F.col("n").alias("count"), F.col("_m.key").alias("dominant_sentiment"), "mean_score", "sample_titles"
    )


def crisis_signals(df: DataFrame, patterns: dict[str, tuple[str, ...]], titles: int = 3, order: str = "id") -> DataFrame:
    """Per theme: matching articles, dominant sentiment, mean score and first titles."""
    return _theme_report(_theme_rows(df, patterns), titles, order)


def event_signals(
    df: DataFrame, patterns: dict[str, tuple[str, ...]], topic: str = "sport", bucket: str = "Sport (topic)",
    titles: int = 2, order: str = "id",
) -> DataFrame:
    """Themes of the event patterns; when none matches, one bucket of the articles on the topic."""
    themed = _theme_rows(df, patterns)
    none_matched = F.coalesce(themed.agg(F.count("*")).scalar(), F.lit(0)) == 0
    on_topic = df.filter((F.lower("topic_1") == topic) & none_matched).withColumn("theme", F.lit(bucket))
    return _theme_report(themed.unionByName(on_topic), titles, order)


def latest_weather(df: DataFrame, n: int = 8, order: str = "id") -> DataFrame:
    """Newest rows of weather sources or weather topic."""
    rows = df.filter(F.col("source").isin(*SOURCE_GROUPS["weather"]) | (F.lower("topic_1") == "meteo"))
    return dated(rows).orderBy(F.desc("dt"), F.desc(order)).limit(n)


def weather_block(df: DataFrame, n: int = 8, shown: int = 5, order: str = "id") -> DataFrame:
    """One row over the newest weather rows: count, mean score, cities, mean temperature, alerts, mild regime."""
    low = F.lower("title")
    rank = F.row_number().over(Window.orderBy(F.desc("dt"), F.desc(order)))
    newest = latest_weather(df, n, order).withColumn("place", rank)
    first = F.col("place") <= shown
    city = F.nullif(F.regexp_extract("title", WEATHER_CITY, 1), F.lit(""))
    degrees = F.try_to_number(F.regexp_extract(low, WEATHER_DEGREES, 1), F.lit("9999.99")).cast("double")
    cities = F.array_sort(F.collect_list(F.when(first & city.isNotNull(), F.struct("place", city.alias("city")))))
    return newest.agg(
        F.count("*").alias("weather_count"),
        F.avg("sentiment_score").alias("weather_mean_score"),
        F.array_join(F.transform(cities, lambda c: c["city"]), ",").alias("cities"),
        F.avg(F.when(first, degrees)).alias("avg_temp"),
        F.count_if(first & mentions(F.col("title"), WEATHER_ALERTS)).alias("alert_mentions"),
        F.count_if(first & low.rlike(WEATHER_MILD)).alias("_mild"),
        F.count_if(first).alias("_shown"),
    ).select(
        "weather_count", "weather_mean_score", "cities", "avg_temp", "alert_mentions",
        ((F.col("_mild") >= F.greatest(F.lit(1), F.floor(F.col("_shown") / 2))) & (F.col("alert_mentions") == 0)).alias("mild_regime"),
    )


def weather_week_overlap(full: DataFrame, themed: DataFrame, days: int = 7) -> DataFrame:
    """Theme rows of the week up to the newest weather row: count and mean score."""
    newest = latest_weather(full).agg(F.max("dt")).scalar()
    rows = dated(themed).select("dt", "sentiment_score").withColumn("_newest", newest)
    in_week = F.col("dt").between(F.col("_newest") - F.expr(f"INTERVAL {days} DAYS"), F.col("_newest"))
    return rows.filter(in_week).agg(F.count("*").alias("rows"), F.avg("sentiment_score").alias("mean_score"))


def participation_vs_media(df: DataFrame) -> DataFrame:
    """Share of all rows and mean score of the participatory and media sources, each in its own row."""
    groups = [(F.col("source").isin(*SOURCE_GROUPS[g]), g) for g in ("participatory", "media")]
    grouped = df.groupBy(one_of(*groups, default="other").alias("voice")).agg(
        F.count("*").alias("count"), F.avg("sentiment_score").alias("mean_score")
    )
    return with_share(grouped).filter(F.col("voice") != "other")


def economic_signal(df: DataFrame, minimum: int = ECONOMIC_MINIMUM) -> DataFrame:
    """Rows and dominant label of the economic sources; no row under five articles."""
    rows = counts(in_source_group(df, "economic"), "sentiment")
    largest = _largest(rows, "sentiment").select("_m").scalar()
    return (
        rows.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"))
        .withColumn("_m", largest)
        .filter(F.col("total") >= minimum)
        .select("total", F.col("_m.key").alias("dominant"), ratio(-F.col("_m.neg"), F.col("total")).alias("dominant_share"))
    )


def score_histogram(df: DataFrame, buckets: int = 20) -> DataFrame:
    """Rows per score bucket of [0, 1]."""
    return counts(df, F.width_bucket("sentiment_score", F.lit(0.0), F.lit(1.0), F.lit(buckets)).alias("bucket"))


def mean_by_label(df: DataFrame) -> DataFrame:
    return df.groupBy("sentiment").agg(F.count("*").alias("count"), F.avg("sentiment_score").alias("mean_score"))


def latency_percentiles(df: DataFrame, column: str, limit_ms: float = 300.0) -> DataFrame:
    """One row: mean, exact p50, p90 and p99, maximum and share within the limit."""
    exact = quantiles(df, column, {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    return df.agg(
        F.avg(column).alias("mean"), F.max(F.col(column).cast("double")).alias("max"),
        F.avg(F.when(F.col(column) <= limit_ms, 1.0).when(F.col(column).isNotNull(), 0.0)).alias("within_limit"),
    ).withColumn("_q", exact.select(F.struct("p50", "p90", "p99")).scalar()).select("mean", "_q.*", "max", "within_limit")


def latency_percentiles_approx(df: DataFrame, column: str, accuracy: int = 10000) -> DataFrame:
    """Sketch-based p50, p90 and p99 in one pass, when exact ranks are not needed."""
    return df.select(F.col(column).cast("double").alias("v")).agg(
        *[F.percentile_approx("v", p, accuracy).alias(n) for n, p in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))]
    )


def confidence_profile(df: DataFrame) -> DataFrame:
    conf = F.col("confidence")
    return df.filter(conf.isNotNull()).agg(
        F.avg(conf).alias("mean_confidence"),
        F.avg(F.when(conf < 0.55, 1.0).otherwise(0.0)).alias("share_low"),
        F.avg(F.when(conf > 0.75, 1.0).otherwise(0.0)).alias("share_high"),
    )


def topic_coherence(df: DataFrame, n: int = 5) -> DataFrame:
    """Largest topics with their dominant predicted label and its share."""
    cells = counts(df.filter(F.col("topic_1").isNotNull()), "topic_1", "predicted_sentiment")
    return (
        cells.groupBy("topic_1")
        .agg(
            F.sum("count").alias("articles"),
            F.min(F.struct((-F.col("count")).alias("neg"), F.col("predicted_sentiment").alias("key"))).alias("_m"),
        )
        .orderBy(F.desc("articles"), "topic_1")
        .limit(n)
        .select(
            "topic_1", "articles", F.col("_m.key").alias("dominant"),
            ratio(-F.col("_m.neg"), F.col("articles")).alias("dominant_share"),
        )
    )


def before_after(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Rows per value in two versions of a table."""
    old = counts(before, F.col(column).alias("value")).withColumnRenamed("count", "before")
    new = counts(after, F.col(column).alias("value")).withColumnRenamed("count", "after")
    return old.join(new, "value", "full").na.fill(0, ["before", "after"]).withColumn("delta", F.col("after") - F.col("before"))
