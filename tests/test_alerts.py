"""Alert rules with hold times: against a walk over every instant, in batches, over a restart, and against the batch rule."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from opinara.storage import new_path
from opinara.streaming import alerts, jobs, rules
from opinara.streaming.alerts import AS_BEFORE, MET, MINUTE, NOT_MET, Episode, Hold

START = datetime(2024, 3, 1)
SCHEMA = "ts timestamp, kind string"


def walk(rule, rows, last):
    """Every instant of the grid, one after the other."""
    met_at, events, since, fired, before = dict(rows), [], None, False, False
    for at in range(min(met_at), last + 1, rule.step * MINUTE):
        met = met_at.get(at, {NOT_MET: False, MET: True, AS_BEFORE: before}[rule.silent])
        before = met
        if met:
            since = at if since is None else since
            if not fired and at - since >= rule.hold * MINUTE:
                fired = True
                events.append(("firing", since, at))
        else:
            if fired:
                events.append(("resolved", since, at))
            since, fired = None, False
    return events


@pytest.mark.parametrize("silent", [NOT_MET, MET, AS_BEFORE])
def test_episode_equals_a_walk_over_all_instants(silent):
    rng = random.Random(silent)
    for _ in range(300):
        rule = Hold(rng.choice([5, 10, 30]), rng.choice([1, 5]), silent)
        step = rule.step * MINUTE
        ats = sorted(rng.sample(range(0, 200 * step, step), rng.randint(1, 60)))
        rows = [(at, rng.random() < 0.6) for at in ats]
        last = 240 * step
        episode, events = Episode(), []
        parts = sorted(rng.sample(range(len(rows) + 1), min(3, len(rows) + 1))) + [len(rows)]
        for first, until in zip([0, *parts], parts):
            batch = rows[first:until]
            rng.shuffle(batch)
            events += episode.take(rule, batch)
        while episode.clock is not None and (due := episode.next_change(rule)) is not None and due <= last:
            events += episode.until(rule, due)
        assert events == walk(rule, rows, last)


def moments(spark, minutes, kind="error"):
    return spark.createDataFrame([(START + timedelta(minutes=m), kind) for m in minutes], SCHEMA)


def rate_alerts(stream, threshold=0.005):
    windows = rules.sliding(rules.panes(stream, n=F.count_if(F.col("kind") == "error")), n=F.sum("n"))
    return alerts.alerts(alerts.evaluations(windows, {"error_rate": F.col("n") / 300 > threshold}, F.lit("")))


def found(df):
    return sorted((r.state, r.since, r.at) for r in df.collect())


def test_alert_goes_on_after_a_restart_and_equals_the_batch_rule(spark):
    rng = random.Random(3)
    minutes = sorted(rng.uniform(0, 900) for _ in range(500)) + [1100]
    events = moments(spark, minutes)
    cuts = [0, 200, 450, 700, 1200]
    parts = [events.filter(F.col("ts").between(F.lit(START + timedelta(minutes=a)), F.lit(START + timedelta(minutes=b, microseconds=-1)))) for a, b in zip(cuts, cuts[1:])]
    whole, half = new_path(spark, "t-whole"), new_path(spark, "t-half")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(whole)
    once = jobs.run_to_table(rate_alerts(jobs.folder_stream(spark, whole, events.schema, "*.parquet", per_batch=1)), "t-once")
    base = new_path(spark, "t-restart")
    for i in (0, 2):  # two files, stop, two more files
        for part in parts[i : i + 2]:
            part.coalesce(1).write.mode("append").parquet(half)
        twice = jobs.run_to_table(rate_alerts(jobs.folder_stream(spark, half, events.schema, "*.parquet", per_batch=1)), "t-twice", base)
    assert found(once) == found(twice)
    batch = rules.held_for(rules.event_rate(events.withColumn("one", F.lit(1)), 0.005, ("one",)), 5, ("one",))
    closed = START + timedelta(minutes=1100) - timedelta(hours=1)
    held = [(r.since, r.until) for r in batch.collect() if r.until < closed]
    assert len(held) > 5
    assert [(s, a) for state, s, a in found(once) if state == "firing"] == sorted((s, s + timedelta(minutes=5)) for s, _ in held)
    assert [(s, a) for state, s, a in found(once) if state == "resolved"] == sorted((s, u + timedelta(minutes=1)) for s, u in held)


def test_stall_rule_sees_a_row_every_ninety_minutes(spark):
    """The growth rate stays low although something comes before every silence limit; steady growth raises nothing."""
    slow, path = list(range(0, 1500, 90)) + [1700], new_path(spark, "t-stall")
    rows = moments(spark, slow, "article")
    for part in (rows.filter(F.col("ts") < F.lit(START + timedelta(minutes=600))), rows.filter(F.col("ts") >= F.lit(START + timedelta(minutes=600)))):
        part.coalesce(1).write.mode("append").parquet(path)

    def stalled(threshold):
        parts = rules.panes(jobs.folder_stream(spark, path, rows.schema, "*.parquet", per_batch=1), n=F.count("*"))
        windows = rules.sliding(parts, (), "1 hour", "5 minutes", n=F.sum("n"))
        conditions = {"growth_stalled": F.col("n") / 3600 < threshold, "nothing_collected": F.col("n") == 0}
        return jobs.run_to_table(alerts.alerts(alerts.evaluations(windows, conditions, F.lit(""))), "t-stalled")

    got = stalled(1.0)
    assert [(r.rule, r.state, r.at - r.since) for r in got.filter("rule = 'growth_stalled'").collect()] == [("growth_stalled", "firing", timedelta(hours=2))]
    # Thirty minutes without a row within the hour, then a row: silence never holds for an hour, but at the end it does.
    silent = got.filter("rule = 'nothing_collected'").collect()
    assert [(r.state, r.since) for r in silent] == [("firing", START + timedelta(minutes=1505))]


def test_sliding_windows_copy_panes_not_rows(spark):
    plan = rules.event_rate(moments(spark, range(30)), 0.0)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.strip() for line in plan.splitlines()]
    aggregates = [i for i, line in enumerate(lines) if "Aggregate" in line]
    expands = [i for i, line in enumerate(lines) if "Expand" in line]
    assert len(aggregates) == 2 and len(expands) == 1 and aggregates[0] < expands[0] < aggregates[1]


def test_alerts_run_in_a_session_and_workers_built_elsewhere(spark):
    """Spark's default state store holds no timers, and a worker may not have the package: the processor travels by value."""
    from pyspark import cloudpickle

    key = alerts.PROVIDER
    wanted, path = spark.conf.get(key), new_path(spark, "t-elsewhere")
    rows = moments(spark, sorted(m + s / 4 for m in range(100, 130) for s in range(4)) + [400])
    rows.coalesce(1).write.parquet(path)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        got = jobs.run_to_table(rate_alerts(jobs.folder_stream(spark, path, rows.schema, "*.parquet")), "t-elsewhere-run", settings=alerts.STORE)
        assert spark.conf.get(key).endswith("HDFSBackedStateStoreProvider")
    finally:
        spark.conf.set(key, wanted)
    assert [(s, (since - START).total_seconds() / 60, (at - since).total_seconds() / 60) for s, since, at in found(got)] == [("firing", 101, 5), ("resolved", 101, 34)]
    assert b"handleInputRows" in cloudpickle.dumps(alerts.HoldProcessor)


def test_source_error_rate_tells_a_single_error(spark, tmp_path):
    """One error of a source in five minutes passes the query's threshold."""
    from opinara.plans.registry import QUERIES
    from opinara.plans import q_streaming  # noqa: F401

    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    events = [(i, START + timedelta(minutes=m), user, "error", 1.0, "{}") for i, (m, user) in enumerate([(0.5, 3), (30.5, 24), (300.0, 1)])]
    pq.write_table(spark.createDataFrame(events, schema).toArrow(), f"{tmp_path}/events.parquet")
    got = QUERIES["stream_source_error_rate"](spark, str(tmp_path)).groupBy("source").count().collect()
    assert {tuple(r) for r in got} == {("src3", 5), ("src4", 5)}
