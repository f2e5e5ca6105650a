"""Coverage, lineage, coherence and quality reports over the operational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.numbers import one_of, ratio, round_even
from opinara.functions.text import filled, is_valid
from opinara.operators.layers import KEYWORD_MODEL, latest_output
from opinara.operators.skew import top_per_group

# Thresholds of the run contract.
MIN_LOADED, MIN_CLEAN_RATIO, MIN_ENRICHED_RATIO = 20, 0.90, 0.95
SYNTHETIC_QUALITY = (0.2, 0.6)
HIGH_QUALITY = 0.8


def _flag(keys: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct keys with a marker column; duplicates are removed before the join so it cannot multiply rows."""
    return keys.select(F.col(column).alias("id")).distinct().withColumn(name, F.lit(1))


def keyword_outputs(outputs: DataFrame) -> DataFrame:
    return outputs.filter(F.col("model_name") == KEYWORD_MODEL)


def with_enrichment(raw: DataFrame, links: DataFrame, outputs: DataFrame) -> DataFrame:
    """Adds 0/1 ``tagged`` and ``analysed`` to each article."""
    return (
        raw.join(_flag(links, "raw_data_id", "tagged"), "id", "left")
        .join(_flag(keyword_outputs(outputs), "raw_data_id", "analysed"), "id", "left")
        .na.fill(0, ["tagged", "analysed"])
    )


def enriched_count(raw: DataFrame, links: DataFrame, outputs: DataFrame) -> DataFrame:
    """Articles having both a topic and a keyword sentiment."""
    both = raw.join(links.select(F.col("raw_data_id").alias("id")), "id", "left_semi").join(
        keyword_outputs(outputs).select(F.col("raw_data_id").alias("id")), "id", "left_semi"
    )
    return both.agg(F.count("*").alias("enriched"))


def enrichment_backlog(raw: DataFrame, links: DataFrame, outputs: DataFrame) -> DataFrame:
    """Articles missing a topic or a keyword sentiment, with what is missing."""
    flagged = with_enrichment(raw, links, outputs)
    return flagged.filter((F.col("tagged") == 0) | (F.col("analysed") == 0))


def new_by_source(sources: DataFrame, raw: DataFrame, day: str) -> DataFrame:
    """Articles of one day per source; sources without any are left out."""
    return (
        sources.join(raw.filter(F.col("date") == day), sources["name"] == raw["source"], "left")
        .groupBy("name")
        .agg(F.count(raw["id"]).alias("added"))
        .filter("added > 0")
    )


def by_source_stats(sources: DataFrame, raw: DataFrame) -> DataFrame:
    """Total, distinct hashes and last collection per source; sources without articles stay."""
    per_source = (
        raw.groupBy("source", "fingerprint")
        .agg(F.count("*").alias("n"), F.max("collected_at").alias("last"))
        .groupBy("source")
        .agg(F.sum("n").alias("total"), F.count("fingerprint").alias("unique_articles"), F.max("last").alias("last_collected"))
    )
    return (
        sources.join(per_source, sources["name"] == per_source["source"], "left")
        .select("name", "total", "unique_articles", "last_collected")
        .na.fill(0, ["total", "unique_articles"])
    )


def topic_coverage(links: DataFrame) -> DataFrame:
    """Tagged articles, topics in use and mean confidence; distinct ids are counted on pre-grouped links."""
    cells = links.groupBy("raw_data_id", "topic").agg(F.count("*").alias("n"), F.sum("confidence_score").alias("s"))
    return cells.agg(
        F.count_distinct("raw_data_id").alias("tagged_articles"),
        F.count_distinct("topic").alias("topics_used"),
        ratio(F.sum("s"), F.sum("n")).alias("avg_confidence"),
    )


def sentiment_stats(outputs: DataFrame) -> DataFrame:
    return keyword_outputs(outputs).groupBy("label").agg(F.count("*").alias("count"), F.avg("score").alias("avg_score"))


def topic_distribution(topics: DataFrame, links: DataFrame) -> DataFrame:
    """Links and mean confidence per topic, unused topics with zero."""
    used = links.groupBy("topic").agg(F.count("*").alias("count"), F.avg("confidence_score").alias("avg_confidence"))
    return topics.join(used, topics["name"] == used["topic"], "left").select("name", "count", "avg_confidence").na.fill(0, ["count"])


def unique_articles(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count("*").alias("total"), F.count_distinct(filled(F.col("fingerprint"))).alias("distinct_fingerprints"))


def synthetic_status(sources: DataFrame, raw: DataFrame) -> DataFrame:
    """Articles and activity of synthetic sources."""
    marked = sources.filter(F.lower("name").like("zzdb%"))
    per_source = raw.groupBy("source").agg(F.count("*").alias("articles"))
    return (
        marked.join(per_source, marked["name"] == per_source["source"], "left")
        .select("name", "active", "articles")
        .na.fill(0, ["articles"])
    )


def enrichment_by_source(raw: DataFrame, links: DataFrame, outputs: DataFrame) -> DataFrame:
    """Added, tagged, analysed and fully enriched articles per source, counted from per-article flags."""
    flagged = with_enrichment(raw, links, outputs)
    return flagged.groupBy("source").agg(
        F.count("*").alias("collected"), F.sum("tagged").alias("tagged"), F.sum("analysed").alias("analysed"),
        F.sum(F.col("tagged") * F.col("analysed")).alias("enriched"),
    )


def session_report(raw: DataFrame, links: DataFrame, outputs: DataFrame, start: str) -> DataFrame:
    """The same counts for articles collected since the session began."""
    return enrichment_by_source(raw.filter(F.col("collected_at") >= F.lit(start).cast("timestamp")), links, outputs)


def source_sentiment_pivot(sources: DataFrame, raw: DataFrame, outputs: DataFrame) -> DataFrame:
    """Articles per source and label; an article with two outputs of one label counts once."""
    marks = keyword_outputs(outputs).groupBy(F.col("raw_data_id").alias("id")).agg(
        *[F.max(F.when(F.col("label") == label, 1).otherwise(0)).alias(name) for label, name in _PIVOT]
    )
    per_source = (
        raw.select("id", "source").join(marks, "id", "left").groupBy("source")
        .agg(F.count("*").alias("total_articles"), *[F.sum(name).alias(name) for _, name in _PIVOT])
    )
    columns = ["total_articles", *[name for _, name in _PIVOT]]
    return sources.join(per_source, sources["name"] == per_source["source"], "left").select("name", *columns).na.fill(0, columns)


_PIVOT = (("positif", "positifs"), ("negatif", "negatifs"), ("neutre", "neutres"))


def source_deltas(current: DataFrame, previous: DataFrame, include_vanished: bool = False) -> DataFrame:
    """Non-zero changes of the article count per source; vanished sources only on request."""
    kind = "full" if include_vanished else "left"
    return (
        current.select("source", F.col("articles").alias("current"))
        .join(previous.select("source", F.col("articles").alias("previous")), "source", kind)
        .na.fill(0, ["current", "previous"])
        .withColumn("delta", F.col("current") - F.col("previous"))
        .filter("delta <> 0")
    )


def linkage_coverage(merged: DataFrame, raw: DataFrame) -> DataFrame:
    """How far merged rows lead back to stored ids."""
    known = raw.select(F.col("id").alias("raw_data_id"), F.lit(1).alias("_known"))
    linked = merged.select("raw_data_id").join(known, "raw_data_id", "left")
    has_id = F.col("raw_data_id").isNotNull()
    return linked.agg(
        F.count("*").alias("rows"),
        F.count("raw_data_id").alias("with_id"),
        F.count_if(~has_id).alias("without_id"),
        F.count("_known").alias("in_raw"),
        F.count_if(has_id & F.col("_known").isNull()).alias("not_in_raw"),
        round_even(ratio(F.count("raw_data_id"), F.count("*")), 6).alias("coverage"),
    )


def row_trace(layers: dict[str, DataFrame], wanted: DataFrame) -> DataFrame:
    """Hits of the wanted hashes per layer and those present in every layer."""
    hits = {name: df.select("fingerprint").join(wanted, "fingerprint", "left_semi") for name, df in layers.items()}
    counts = [rows.agg(F.count("*").alias("hits")).select(F.lit(name).alias("layer"), "hits") for name, rows in hits.items()]
    shared = None
    for rows in hits.values():
        shared = rows.select("fingerprint") if shared is None else shared.intersect(rows.select("fingerprint"))
    result = shared.agg(F.count("*").alias("hits")).select(F.lit("all").alias("layer"), "hits")
    for count in counts:
        result = result.unionByName(count)
    return result


def article_journey(raw: DataFrame, links: DataFrame, outputs: DataFrame, day: str, n: int = 60) -> DataFrame:
    """Newest articles of a day with their most and least confident topic and latest sentiment.

    With a single topic both columns name it, unlike SILVER where the second stays empty.
    """
    newest = raw.filter(F.col("date") == day).orderBy(F.desc("id")).limit(n)
    ends = (
        links.join(newest.select(F.col("id").alias("raw_data_id")), "raw_data_id", "left_semi")
        .groupBy(F.col("raw_data_id").alias("id"))
        .agg(
            F.min(F.struct((-F.col("confidence_score")).alias("s"), "doc_topic_id", "topic")).alias("_high"),
            F.min(F.struct(F.col("confidence_score").alias("s"), "doc_topic_id", "topic")).alias("_low"),
        )
        .select("id", F.col("_high.topic").alias("topic_1"), F.col("_low.topic").alias("topic_2"))
    )
    recent = outputs.join(newest.select(F.col("id").alias("raw_data_id")), "raw_data_id", "left_semi")
    return newest.join(ends, "id", "left").join(latest_output(recent), "id", "left")


def audit_journal(log: DataFrame, accounts: DataFrame, role: str | None = None, n: int = 100) -> DataFrame:
    """Newest ``n`` audit events with their account."""
    if n < 1:
        raise ValueError("at least one event is needed")
    newest = [F.desc("action_date"), F.desc("action_log_id")]
    if role is None:  # an event has one account at most, so the newest can be taken before the join
        return log.orderBy(*newest).limit(n).join(accounts, "profil_id", "left").orderBy(*newest)
    return log.join(accounts.filter(F.col("role") == role), "profil_id").orderBy(*newest).limit(n)


def daily_lineage(sources: DataFrame, raw: DataFrame, sync: DataFrame, day: str) -> DataFrame:
    """Collected, added and duplicate rows of a day per source."""
    added = raw.filter(F.col("date") == day).groupBy("source").agg(F.count("*").alias("added"))
    collected = (
        sync.filter((F.to_date("sync_date") == F.lit(day).cast("date")) & (F.col("status") == "OK"))
        .groupBy("source_id").agg(F.sum("rows_synced").alias("collected"))
    )
    return (
        sources.join(collected, "source_id", "left").join(added, F.col("name") == F.col("source"), "left")
        .na.fill(0, ["collected", "added"])
        .filter("collected > 0 OR added > 0")
        .select(
            F.col("name").alias("source"), "collected", "added",
            F.greatest(F.col("collected") - F.col("added"), F.lit(0)).alias("duplicates"),
        )
    )


def day_totals(raw: DataFrame, sync: DataFrame, day: str) -> DataFrame:
    """Rows before, added on and after a day, and what was collected that day."""
    on_day = F.lit(day).cast("date")
    collected = sync.filter((F.to_date("sync_date") == on_day) & (F.col("status") == "OK")).agg(F.sum("rows_synced"))
    return (
        raw.agg(F.count_if(F.col("date") < on_day).alias("before"), F.count_if(F.col("date") == on_day).alias("added"))
        .withColumn("collected", F.coalesce(collected.scalar(), F.lit(0)))
        .withColumns(
            {
                "after": F.col("before") + F.col("added"),
                "duplicates": F.greatest(F.col("collected") - F.col("added"), F.lit(0)),
            }
        )
    )


def layer_totals(raw: DataFrame, links: DataFrame, outputs: DataFrame, merged: DataFrame) -> DataFrame:
    """Rows per layer: stored, tagged, scored, merged."""
    parts = {
        "raw": raw.agg(F.count("*").alias("rows")),
        "tagged": links.agg(F.count_distinct("raw_data_id").alias("rows")),
        "scored": keyword_outputs(outputs).agg(F.count_distinct("raw_data_id").alias("rows")),
        "merged": merged.agg(F.count("*").alias("rows")),
    }
    frames = [df.select(F.lit(name).alias("layer"), "rows") for name, df in parts.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def lineage_history(raw: DataFrame, sync: DataFrame, days: int = 40) -> DataFrame:
    """Collected, added and duplicate rows per day, newest days first."""
    collected = (
        sync.filter(F.col("status") == "OK").groupBy(F.to_date("sync_date").alias("day")).agg(F.sum("rows_synced").alias("collected"))
    )
    added = raw.groupBy(F.col("date").alias("day")).agg(F.count("*").alias("added"))
    return (
        collected.join(added, "day", "left").na.fill(0, ["added"])
        .withColumn("duplicates", F.greatest(F.col("collected") - F.col("added"), F.lit(0)))
        .orderBy(F.desc("day")).limit(days)
    )


def cleaning_rejects(rejected: DataFrame, reasons: tuple[str, ...], examples: int = 5, order: str = "id") -> DataFrame:
    """Rows per reject reason, absent reasons with zero, and the first ids of each as examples."""
    spark = rejected.sparkSession
    every = spark.createDataFrame([(r,) for r in reasons], "reason string")
    counted = rejected.groupBy("reason").agg(F.count("*").alias("rows"))
    samples = (
        top_per_group(rejected.select("reason", order), ["reason"], [F.col(order)], examples, order)
        .groupBy("reason").agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda i: i.cast("string")), ",").alias("examples"))
    )
    return every.join(counted, "reason", "left").join(samples, "reason", "left").na.fill(0, ["rows"]).na.fill("", ["examples"])


def ingest_rejects(lineage: DataFrame, rejected: DataFrame) -> DataFrame:
    """Per source: duplicates of the day beside rows turned away by cleaning."""
    refused = rejected.groupBy("source").agg(F.count("*").alias("rejected"))
    return (
        lineage.select("source", "collected", "added", "duplicates").join(refused, "source", "full")
        .na.fill(0, ["collected", "added", "duplicates", "rejected"])
    )


def state_report(raw: DataFrame, links: DataFrame, outputs: DataFrame, sync: DataFrame, sources: DataFrame, n_syncs: int = 30) -> DataFrame:
    """Long table (section, name, value) of totals, ranges, duplicate outputs, label counts, and the newest syncs of known sources
    by id: source, time, rows, status, and the error message if the log has one, parted by ``|``."""
    per_article = keyword_outputs(outputs).groupBy("raw_data_id").agg(F.count("*").alias("n"))

    def facts(section: str, frame: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in frame.columns])
        return frame.select(F.inline(pairs)).select(F.lit(section).alias("section"), "name", "value")

    def shown(at: Column) -> Column:
        return F.date_format(at, "yyyy-MM-dd HH:mm:ss")

    stored = raw.agg(
        F.count("*").alias("total_rows"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
        shown(F.min("collected_at")).alias("first_collected"), shown(F.max("collected_at")).alias("last_collected"),
    )
    enrichment = per_article.agg(
        F.sum("n").alias("keyword_rows"), F.count("*").alias("articles_scored"), F.count_if(F.col("n") > 1).alias("duplicate_outputs"),
    )
    tagged = links.agg(F.count("*").alias("topic_rows"), F.count_distinct("raw_data_id").alias("articles_tagged"))
    labels = (
        keyword_outputs(outputs).groupBy(F.col("label").alias("name")).agg(F.count("*").cast("string").alias("value"))
        .select(F.lit("label").alias("section"), "name", "value")
    )
    by_source = (
        raw.groupBy(F.col("source").alias("name")).agg(F.count("*").cast("string").alias("value"))
        .select(F.lit("source").alias("section"), "name", "value")
    )
    order = [F.desc(c) for c in ("sync_log_id", "sync_date", "rows_synced", "status", "name")]
    newest = sync.join(sources.select("source_id", "name"), "source_id").orderBy(*order).limit(n_syncs)
    parts = [F.col("name"), shown(F.col("sync_date")), F.col("rows_synced").cast("string"), F.col("status")]
    parts += [F.col(c) for c in ("error_message",) if c in sync.columns]
    syncs = newest.select(
        F.lit("sync").alias("section"), F.col("sync_log_id").cast("string").alias("name"),
        F.concat_ws(" | ", *[F.coalesce(p, F.lit("")) for p in parts]).alias("value"),
    )
    return (
        facts("raw", stored).unionByName(facts("enrichment", enrichment)).unionByName(facts("topics", tagged))
        .unionByName(labels).unionByName(by_source).unionByName(syncs)
    )


def recent_syncs(sync: DataFrame, sources: DataFrame, n: int = 30) -> DataFrame:
    """Newest sync records with the name of their source."""
    newest = sync.orderBy(F.desc("sync_log_id")).limit(n)
    return newest.join(sources.select("source_id", "name"), "source_id")


def _reasons(*checks: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(failed, F.lit(reason)) for failed, reason in checks]))


def coherence_checks(linkage: DataFrame, raw: DataFrame, exported: DataFrame, outputs: DataFrame) -> DataFrame:
    """One row: OK or WARNING with the reasons."""
    doubled = (
        keyword_outputs(outputs).groupBy("raw_data_id").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1)).scalar()
    )
    return (
        linkage.withColumns(
            {
                "raw_rows": raw.agg(F.count("*")).scalar(),
                "exported_rows": exported.agg(F.count("*")).scalar(),
                "duplicate_outputs": doubled,
            }
        )
        .withColumns(
            {
                "merged_minus_raw": F.col("rows") - F.col("raw_rows"),
                "exported_minus_raw": F.col("exported_rows") - F.col("raw_rows"),
            }
        )
        .withColumn(
            "reasons",
            _reasons(
                (F.col("not_in_raw") > 0, "merged ids absent from raw"),
                ((F.col("merged_minus_raw") > 0) & (F.col("without_id") == 0), "merged larger than raw"),
                (F.col("exported_minus_raw") != 0, "export differs from raw"),
                (F.col("duplicate_outputs") > 0, "duplicate keyword outputs"),
            ),
        )
        .withColumn("status", F.when(F.size("reasons") > 0, "WARNING").otherwise("OK"))
        .select("merged_minus_raw", "exported_minus_raw", "duplicate_outputs", "status", F.array_join("reasons", "; ").alias("reasons"))
    )


def run_contract(
    extracted: DataFrame, cleaned: DataFrame, loaded: DataFrame, links: DataFrame, outputs: DataFrame, anomalies: DataFrame | None = None
) -> DataFrame:
    """One record per run: stage counts, ratios, PASS or WARN and why."""
    enriched = with_enrichment(loaded, links, outputs)
    clean_ratio = F.coalesce(ratio(F.col("cleaned"), F.col("extracted")), F.lit(0.0))
    enriched_ratio = F.coalesce(ratio(F.least("tagged", "analysed"), F.col("loaded")), F.lit(0.0))
    contract = (
        enriched.agg(
            F.count("*").alias("loaded"), F.coalesce(F.sum("tagged"), F.lit(0)).alias("tagged"),
            F.coalesce(F.sum("analysed"), F.lit(0)).alias("analysed"),
        )
        .withColumns({"extracted": extracted.agg(F.count("*")).scalar(), "cleaned": cleaned.agg(F.count("*")).scalar()})
        .withColumns({"deduplicated": F.col("cleaned") - F.col("loaded"), "clean_ratio": clean_ratio, "enriched_ratio": enriched_ratio})
    )
    listed = _reasons(
        (F.col("extracted") <= 0, "nothing extracted"),
        (F.col("cleaned") > F.col("extracted"), "more cleaned than extracted"),
        (F.col("loaded") < MIN_LOADED, "loaded below threshold"),
        (F.least("tagged", "analysed") < F.col("loaded"), "enrichment incomplete"),
        (F.col("clean_ratio") < MIN_CLEAN_RATIO, "clean ratio below threshold"),
        (F.col("enriched_ratio") < MIN_ENRICHED_RATIO, "enriched ratio below threshold"),
    )
    if anomalies is not None:
        sourced = F.array_sort(F.collect_list(F.concat(F.lit("source "), "source", F.lit(": "), "anomaly")))
        listed = F.concat(listed, F.coalesce(anomalies.filter("anomaly IS NOT NULL").agg(sourced).scalar(), F.array().cast("array<string>")))
    return contract.withColumn("reasons", listed).withColumn("status", F.when(F.size("reasons") > 0, "WARN").otherwise("PASS"))


def audit_stats(log: DataFrame) -> DataFrame:
    """Long table (section, name, count): per action, per resource, and events with ip, resource id, in the last day."""
    cells = log.groupBy("action_type", "resource_type").agg(
        F.count("*").alias("n"), F.count("ip_address").alias("with_ip"), F.count("resource_id").alias("with_resource_id"),
    )

    def table(column: str) -> DataFrame:
        return cells.groupBy(F.col(column).alias("name")).agg(F.sum("n").alias("count")).select(F.lit(column).alias("section"), "name", "count")

    newest = log.agg(F.max("action_date")).scalar()
    recent = (
        log.select("action_date").filter(F.col("action_date") >= newest - F.expr("INTERVAL 1 DAY"))
        .agg(F.count("*").alias("count")).select(F.lit("total").alias("section"), F.lit("last_24h").alias("name"), "count")
    )
    totals = cells.agg(F.sum("n").alias("events"), F.sum("with_ip").alias("with_ip"), F.sum("with_resource_id").alias("with_resource_id"))
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("count")) for c in totals.columns])
    listed = totals.select(F.inline(pairs)).select(F.lit("total").alias("section"), "name", "count")
    return table("action_type").unionByName(table("resource_type")).unionByName(listed).unionByName(recent)


def quality_assertions(raw: DataFrame, links: DataFrame, outputs: DataFrame) -> DataFrame:
    """One row per check: its name, whether it holds, and the measured value."""
    synthetic = F.when(F.lower("source").contains("zzdb") | (F.col("source") == "csv_inject"), F.col("quality_score"))
    low, high = SYNTHETIC_QUALITY
    measured = with_enrichment(raw, links, outputs).agg(
        F.count("*").alias("total"),
        F.count_if(F.length(F.trim("title")) > 0).alias("titles"),
        F.count_if(F.length(F.trim("content")) > 0).alias("contents"),
        F.count_if(F.length("fingerprint") == 64).alias("fingerprints"),
        F.avg(synthetic).alias("synthetic_quality"),
        F.sum(F.col("tagged") * F.col("analysed")).alias("enriched"),
    )
    checks = {
        "valid_titles": (F.col("titles") == F.col("total"), "titles"),
        "valid_contents": (F.col("contents") == F.col("total"), "contents"),
        "fingerprints": (F.col("fingerprints") == F.col("total"), "fingerprints"),
        "synthetic_quality": (F.coalesce(F.col("synthetic_quality").between(low, high), F.lit(True)), "synthetic_quality"),
        "enriched": (F.col("enriched") > 0, "enriched"),
    }
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check"), ok.alias("ok"), F.col(column).cast("double").alias("detail"))
            for name, (ok, column) in checks.items()
        ]
    )
    return measured.select(F.inline(rows))


def quality_summary(raw: DataFrame, quality: str = "quality_score") -> DataFrame:
    """Per source: rows, high quality, mean quality (three digits), repeated hashes and distinct dates."""
    per_hash = raw.groupBy("source", "fingerprint").agg(
        F.count("*").alias("n"), F.count_if(F.col(quality) >= HIGH_QUALITY).alias("high"), F.sum(quality).alias("q"),
    )
    dates = raw.select("source", "date").distinct().groupBy("source").agg(F.count("*").alias("dates"))
    return (
        per_hash.groupBy("source")
        .agg(
            F.sum("n").alias("rows"), F.sum("high").alias("high_quality"), F.sum(F.col("n") - 1).alias("duplicates"),
            round_even(F.sum("q") / F.sum("n"), 3).alias("avg_quality"),
        )
        .join(dates, "source")
    )


def database_stats(sources: DataFrame, raw: DataFrame, links: DataFrame, outputs: DataFrame) -> DataFrame:
    """Per active source its articles; totals repeat on each row."""
    per_source = raw.groupBy("source").agg(F.count("*").alias("articles"))
    active = sources.filter("active")
    return (
        active.join(per_source, active["name"] == per_source["source"], "left").select("name", "articles").na.fill(0, ["articles"])
        .withColumns(
            {
                "total_articles": raw.agg(F.count("*")).scalar(),
                "active_sources": active.agg(F.count("*")).scalar(),
                "enriched": enriched_count(raw, links, outputs).scalar(),
            }
        )
    )


def retention_purge(
    raw: DataFrame, links: DataFrame, outputs: DataFrame, keep_days: int, today: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Articles younger than the limit, and the topics and outputs whose article remains."""
    kept = raw.filter(F.col("collected_at") >= F.date_sub(F.lit(today).cast("date"), keep_days).cast("timestamp"))
    ids = kept.select(F.col("id").alias("raw_data_id"))
    return kept, links.join(ids, "raw_data_id", "left_semi"), outputs.join(ids, "raw_data_id", "left_semi")


def split_valid(df: DataFrame) -> DataFrame:
    """Adds ``valid``; both sides of the cleaning step read the same column."""
    return df.withColumn("valid", is_valid(F.col("title"), F.col("content")))


def dominance_change(first: DataFrame, links: DataFrame) -> DataFrame:
    """Share of each topic as first link of its article against a second tagging."""
    before, after = first_topic_dist(first), first_topic_dist(links)
    return (
        before.select("topic", F.col("articles").alias("before"))
        .join(after.select("topic", F.col("articles").alias("after")), "topic", "full")
        .na.fill(0, ["before", "after"])
    )


def first_topic_dist(links: DataFrame) -> DataFrame:
    """Articles per topic, each article counted under its earliest link."""
    first = links.groupBy("raw_data_id").agg(F.min(F.struct("doc_topic_id", "topic")).alias("_f"))
    return first.groupBy(F.col("_f.topic").alias("topic")).agg(F.count("*").alias("articles"))


def readable_rank(df: DataFrame, readable: Column, priority: tuple[str, ...], avoid: tuple[str, ...], n: int) -> DataFrame:
    """Best sample rows: readable first, preferred sources, enriched, long titles."""
    place = one_of(
        (F.col("source").isin(*avoid), 99),
        *[(F.col("source") == name, rank) for rank, name in enumerate(priority)],
        default=50,
    )
    enriched = (F.col("topic_1") != "") & (F.col("sentiment") != "")
    return (
        df.withColumns({"readable": readable, "source_place": place, "enriched": enriched, "title_length": F.length(F.trim("title"))})
        .orderBy(F.desc("readable"), "source_place", F.desc("enriched"), F.desc("title_length"), "id")
        .limit(n)
    )


