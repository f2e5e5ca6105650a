"""Windowed counters and alert rules. Each works on a stream and on a table alike; a watermark on a table has no effect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.numbers import ratio
from opinara.operators.aggregates import drift_score

# How late a row may be, the evaluation window and the thresholds of the rules.
LATENESS = "1 hour"
RATE_WINDOW, RATE_STEP, RATE_SECONDS = "5 minutes", "1 minute", 300
ERROR_RATE, SOURCE_ERROR_RATE, ERROR_RATIO = 0.1, 0.05, 0.05
LATENCY_P95_SECONDS = 5.0
FAILURES_PER_MINUTE = 10.0
ENRICHMENT_FLOOR = 0.5
DRIFT_LIMIT = 0.7
SILENCE, STALL = "1 hour", "2 hours"
SKETCH = 800  # values a quantile sketch holds without loss


def _windowed(df: DataFrame, time: str, *window: str, by: tuple[str, ...] = ()):
    return df.withWatermark(time, LATENESS).groupBy(F.window(time, *window), *by)


def _flat(df: DataFrame) -> DataFrame:
    others = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *others)


def counters(df: DataFrame, by: tuple[str, ...], every: str = "1 hour", time: str = "ts") -> DataFrame:
    """Rows per time bucket and label."""
    return _flat(_windowed(df, time, every, by=by).agg(F.count("*").alias("count")))


def panes(df: DataFrame, by: tuple[str, ...] = (), time: str = "ts", every: str = RATE_STEP, **measures: Column) -> DataFrame:
    """Measures per short time bucket: every row is counted once, however many sliding windows it will lie in."""
    return _windowed(df, time, every, by=by).agg(*[m.alias(name) for name, m in measures.items()])


def sliding(parts: DataFrame, by: tuple[str, ...] = (), length: str = RATE_WINDOW, step: str = RATE_STEP, **measures: Column) -> DataFrame:
    """Sliding windows over panes; ``measures`` add up those of the panes. A second aggregation behind the first, on a stream too."""
    return parts.groupBy(F.window(F.window_time("window"), length, step), *by).agg(*[m.alias(name) for name, m in measures.items()])


def event_rate(df: DataFrame, threshold: float, by: tuple[str, ...] = (), time: str = "ts") -> DataFrame:
    """Sliding windows whose rows per second exceed the threshold."""
    counted = sliding(panes(df, by, time, n=F.count("*")), by, rate=F.sum("n") / RATE_SECONDS)
    return _flat(counted.filter(F.col("rate") > threshold))


def error_ratio(df: DataFrame, failed: Column, threshold: float = ERROR_RATIO, time: str = "ts") -> DataFrame:
    """Sliding windows in which the failed share exceeds the threshold."""
    parts = panes(df, (), time, errors=F.count_if(failed), requests=F.count("*"))
    sums = sliding(parts, errors=F.sum("errors"), requests=F.sum("requests"))
    shares = sums.withColumn("ratio", ratio(F.col("errors"), F.col("requests")))
    return _flat(shares.filter(F.col("ratio") > threshold))


def latency_sketch(value: str | Column) -> Column:
    """Quantile sketch of a pane: exact up to ``SKETCH`` values, then within 0.4 % of the rank; sketches add up."""
    return F.kll_sketch_agg_double(value, F.lit(SKETCH))


def latency_p95(df: DataFrame, value: str, threshold: float = LATENCY_P95_SECONDS, time: str = "ts") -> DataFrame:
    """Sliding windows whose 95th percentile exceeds the threshold."""
    parts = panes(df.filter(F.col(value).isNotNull()), (), time, sketch=latency_sketch(F.col(value).cast("double")))
    merged = sliding(parts, sketch=F.kll_merge_agg_double("sketch", F.lit(SKETCH)))
    p95 = merged.withColumn("p95", F.kll_sketch_get_quantile_double("sketch", F.lit(0.95).cast("double"))).drop("sketch")
    return _flat(p95.filter(F.col("p95") > threshold))


def failure_burst(df: DataFrame, threshold: float = FAILURES_PER_MINUTE, time: str = "ts") -> DataFrame:
    """Sliding windows with more failures per minute than the threshold."""
    bursts = sliding(panes(df, (), time, n=F.count("*")), per_minute=F.sum("n") * 60 / RATE_SECONDS)
    return _flat(bursts.filter(F.col("per_minute") > threshold))


def enrichment_rate(df: DataFrame, enriched: Column, every: str = "1 day", floor: float = ENRICHMENT_FLOOR, time: str = "ts") -> DataFrame:
    """Time buckets in which too few articles are enriched."""
    rates = _windowed(df, time, every).agg(F.avg(enriched.cast("double")).alias("rate"), F.count("*").alias("articles"))
    return _flat(rates.filter(F.col("rate") < floor))


def day_gauges(cells: DataFrame) -> DataFrame:
    """Enriched share and drift per window from counts per window, sentiment and topic; a window has a handful of cells.

    A second aggregation behind the counting one, so it runs on a stream as well.
    """
    cell = F.struct(F.coalesce("sentiment", F.lit("inconnu")).alias("sentiment"), F.col("topic_1").alias("topic"), F.col("n").alias("n"))
    windows = cells.groupBy("window").agg(F.sum("n").alias("rows"), F.collect_list(cell).alias("cells"))

    def sums(field: str) -> Column:
        """Rows of each value of a field; null is no value."""
        values = F.array_compact(F.array_distinct(F.transform("cells", lambda c: c[field])))
        return F.transform(values, lambda v: F.aggregate(F.filter("cells", lambda c: c[field] == v), F.lit(0).cast("bigint"), lambda total, c: total + c.n))

    counted = windows.withColumns({"labels": sums("sentiment"), "topics": sums("topic")})
    rows = F.col("rows").cast("double")
    spread = F.aggregate("labels", F.lit(0.0), lambda total, n: total + n * F.log2(n.cast("double")))
    found = F.filter("cells", lambda c: (c.topic != "autre") & (c.sentiment != "neutre"))
    enriched = F.aggregate(found, F.lit(0).cast("bigint"), lambda total, c: total + c.n)
    measures = drift_score(F.col("rows"), F.size("labels"), F.log2(rows) - spread / rows, F.array_max("topics"))
    return counted.select("window", (enriched / rows).alias("enrichment"), *measures)


def sessions(df: DataFrame, by: tuple[str, ...], gap: str, time: str = "ts") -> DataFrame:
    """Runs of activity with no pause of ``gap`` (a minute or more); a session ends ``gap`` after its last row.

    One key may own most rows, so they are merged before the shuffle. A stream does that by Spark's local merge of
    sessions. A table is first reduced to one row per key and minute: rows of a minute share a session, and each
    minute becomes a session from its first row to ``gap`` after its last one, so the result is exact. Start and end are
    aggregates, not the grouping key: a filter on the key would be applied to rows before their sessions are merged.
    """
    pause = F.expr(f"INTERVAL {gap}")
    span = lambda first, last: F.struct(F.min(first).alias("start"), (F.max(last) + pause).alias("end")).alias("window")
    if df.isStreaming:
        df.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        grouped = df.withWatermark(time, LATENESS).groupBy(F.session_window(time, gap).alias("_key"), *by)
        return _flat(grouped.agg(span(time, time), F.count("*").alias("count")).drop("_key"))
    minutes = df.groupBy(*by, F.date_trunc("minute", F.col(time))).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"), F.count("*").alias("_n")
    )
    length = (F.col("_last") + pause) - F.col("_first")
    micros = F.unix_micros(F.timestamp_seconds(F.lit(0)) + length)
    key = F.session_window("_first", F.concat(micros.cast("string"), F.lit(" microseconds"))).alias("_key")
    return _flat(minutes.groupBy(key, *by).agg(span("_first", "_last"), F.sum("_n").alias("count")).drop("_key"))


def silence(df: DataFrame, by: tuple[str, ...] = (), gap: str = SILENCE, time: str = "ts") -> DataFrame:
    """Moments at which nothing had come for ``gap``: the ends of the sessions of that gap."""
    return sessions(df, by, gap, time).select(*by, F.col("window_end").alias("silent_at"), F.col("count").alias("rows_before"))


def active_at(closed: DataFrame, instant: Column) -> DataFrame:
    """Users whose session covers an instant."""
    return closed.filter((F.col("window_start") <= instant) & (instant < F.col("window_end"))).agg(F.count("*").alias("active"))


def held_for(windows: DataFrame, minutes: int, by: tuple[str, ...] = (), step_minutes: int = 1) -> DataFrame:
    """Alerts that held over consecutive evaluations for the given time; input is the windows that met the condition.

    Consecutive evaluations share the difference between their place in time and their rank. The ranked rows are one per
    evaluation step, a number set by the length of time and not by the traffic.
    """
    tick = F.floor(F.unix_timestamp("window_end") / (60 * step_minutes))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("window_end"))
    islands = windows.withColumn("_island", tick - rank).groupBy(*by, "_island").agg(
        F.min("window_end").alias("since"), F.max("window_end").alias("until")
    )
    held = F.unix_timestamp("until") - F.unix_timestamp("since")
    return islands.filter(held >= minutes * 60).drop("_island")


def silent_hours(df: DataFrame, time: str = "ts") -> DataFrame:
    """Hours between the first and last row in which nothing came."""
    hour = F.date_trunc("hour", F.col(time))
    busy = df.groupBy(hour.alias("hour")).agg(F.count("*").alias("rows"))
    every = busy.agg(F.explode(F.sequence(F.min("hour"), F.max("hour"), F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    return every.join(busy, "hour", "left_anti")
