"""Series over days and runs: volumes, gaps, running totals, frontiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.numbers import one_of
from opinara.operators.skew import top_per_group

# Drop that raises a volume alert, in percent.
DROP_ALERT = 80.0


def source_volume_delta(sync: DataFrame, threshold: float = DROP_ALERT) -> DataFrame:
    """Newest and previous successful volume per source, change in percent, anomaly if nothing came or it fell hard.

    Only the two newest rows of a source are kept before anything is grouped, so a busy source costs no more.
    """
    ok = sync.filter(F.col("status") == "OK").select("source_id", "sync_date", "sync_log_id", "rows_synced")
    order = [F.desc("sync_date"), F.desc("sync_log_id")]
    newest = top_per_group(ok, ["source_id"], order, 2, "sync_log_id")
    stamp = F.struct("sync_date", "sync_log_id", "rows_synced")
    pairs = newest.groupBy("source_id").agg(F.max(stamp).alias("_last"), F.min(stamp).alias("_first"), F.count("*").alias("_n"))
    now, before = F.col("now"), F.col("previous")
    return (
        pairs.select(
            "source_id",
            F.col("_last.rows_synced").alias("now"),
            F.when(F.col("_n") == 2, F.col("_first.rows_synced")).otherwise(0).alias("previous"),
        )
        .withColumn("delta_pct", F.when(before > 0, (now - before) / before * 100.0))
        .withColumn(
            "anomaly",
            one_of(
                ((before > 0) & (now == 0), "no volume"),
                (F.col("delta_pct") <= -threshold, "volume drop"),
                default=None,
            ),
        )
    )


def cumulative_rows(df: DataFrame) -> DataFrame:
    """Rows per date and running total; the window runs over one row per date."""
    daily = df.groupBy("date").agg(F.count("*").alias("rows"))
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("total", F.sum("rows").over(so_far))


def runs_by_day(runs: DataFrame, only_alerts: bool = False) -> DataFrame:
    """Loaded rows, worst status, distinct reasons in order of appearance and number of runs per day."""
    chosen = runs.filter((F.col("status") == "WARN") | (F.size("reasons") > 0)) if only_alerts else runs
    day = F.to_date("generated_at").alias("day")
    totals = chosen.groupBy(day).agg(
        F.sum("loaded").alias("loaded"),
        F.when(F.max((F.col("status") == "WARN").cast("int")) == 1, "WARN").otherwise("PASS").alias("status"),
        F.count("*").alias("run_count"),
    )
    seen = (
        chosen.select(day, "generated_at", F.posexplode("reasons").alias("place", "reason"))
        .groupBy("day", "reason")
        .agg(F.min(F.struct("generated_at", "place")).alias("first"))
        .groupBy("day")
        .agg(F.array_sort(F.collect_list(F.struct("first", "reason"))).alias("_r"))
        .select("day", F.array_join(F.transform("_r", lambda r: r["reason"]), "; ").alias("reasons"))
    )
    return totals.join(seen, "day", "left").na.fill("", ["reasons"])


def run_calendar(by_day: DataFrame) -> DataFrame:
    """One row per calendar day between first and last run; absent days are marked, so is the first run after one."""
    days = by_day.agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    before = F.lag("status").over(Window.orderBy("day"))
    return (
        days.join(by_day, "day", "left")
        .withColumn("status", F.coalesce("status", F.lit("ABSENT")))
        .na.fill(0, ["loaded", "run_count"])
        .withColumn("catch_up", F.coalesce((before == "ABSENT") & (F.col("status") != "ABSENT") & (F.col("loaded") > 0), F.lit(False)))
        .select("day", "loaded", "status", "run_count", "catch_up")
    )


def growth_timeline(reports: DataFrame) -> DataFrame:
    """Last report of each day."""
    return (
        reports.groupBy(F.to_date("generated_at").alias("day"))
        .agg(F.max(F.struct("generated_at", "loaded", "status")).alias("_r"))
        .select("day", F.col("_r.loaded").alias("loaded"), F.col("_r.status").alias("status"))
    )


def pareto_frontier(df: DataFrame, group: str, cost: str, gain: str, unique: str, salts: int | None = None) -> DataFrame:
    """Rows whose gain beats every cheaper row of the group.

    First the best row per cost is kept, which combines before the shuffle. Then, as the frontier of a union is the
    frontier of the parts' frontiers, the parts of a group are thinned on their own (as many parts as shuffle
    partitions), and the last window over a hot group sees only candidates.
    """
    spread_over = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.struct((-F.col(gain)).alias("_neg"), F.col(unique), *[c for c in df.columns if c not in (group, cost, unique)])
    best_per_cost = df.groupBy(group, cost).agg(F.min(row).alias("_r"))
    kept = best_per_cost.select(*[F.col(c) if c in (group, cost) else F.col(f"_r.{c}").alias(c) for c in df.columns])
    part = F.pmod(F.xxhash64(unique), F.lit(spread_over))
    for by in ([group, "_part"], [group]):
        cheaper = Window.partitionBy(*by).orderBy(cost).rowsBetween(Window.unboundedPreceding, -1)
        kept = kept.withColumn("_part", part).withColumn("_best", F.max(gain).over(cheaper))
        kept = kept.filter(F.col("_best").isNull() | (F.col(gain) > F.col("_best"))).drop("_best", "_part")
    return kept
