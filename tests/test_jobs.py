"""Hand-computed cases of the layer, dataset, report and streaming jobs."""

from __future__ import annotations

import datetime as dt
import hashlib
import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinara.functions import lexicon
from opinara.functions.text import CONTENT_WIDTH, TITLE_WIDTH
from opinara.operators import aggregates, datasets, evaluation, filters, layers, linkage, scoring, skew, timeline, tracking
from opinara.sources import files, merged, pages, payloads, sinks
from opinara.sources import layers as layer_source
from opinara.plans import corpus
from opinara.plans.vocabulary import LEXICON
from opinara.storage import new_path, stage, work_dir
from opinara.streaming import jobs, rules


def day(n):
    return dt.date(2026, 3, n)


def at(hour, minute=0, second=0, d=1):
    return dt.datetime(2026, 3, d, hour, minute, second)


def collected(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# --- helpers -----------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, and values repeat."""
    rng = random.Random(7)
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}", rng.randrange(40), float(rng.randrange(1000))) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id bigint, key string, v bigint, x double").repartition(6)


def test_global_rank_is_exact(skewed):
    rows, df = skewed
    expected = {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])), 1)}
    ranked = skew.global_rank(df, ["v", "id"], partitions=5).select("id", "rank").collect()
    assert {r.id: r["rank"] for r in ranked} == expected


def test_quantiles_are_exact(skewed):
    rows, df = skewed
    import numpy as np

    got = skew.quantiles(df, "x", {"a": 0.0, "b": 0.5, "c": 0.9, "d": 0.99, "e": 1.0}).first()
    assert list(got) == pytest.approx(list(np.quantile([r[3] for r in rows], [0, 0.5, 0.9, 0.99, 1])))


@pytest.mark.parametrize("kind", ["double", "string", "date"])
def test_rows_are_selected_by_rank(spark, kind):
    """Ties, nulls (last), far-off values and a value that is everywhere."""
    rng = random.Random(kind)
    make = {"double": lambda: rng.choice([7.5, 7.5, rng.uniform(-1e9, 1e9), rng.random(), None]),
            "string": lambda: rng.choice(["same start, é", "same start, à", f"x{rng.random()}", "", None]),
            "date": lambda: rng.choice([day(1), day(1), day(rng.randint(1, 28)), None])}[kind]
    rows = [(i, make()) for i in range(2000)]
    rng.shuffle(rows)
    order = sorted(rows, key=lambda r: (r[1] is None, r[1].encode() if isinstance(r[1], str) else r[1] if r[1] is not None else 0, r[0]))
    df = spark.createDataFrame(rows, f"id bigint, k {kind}").repartition(5)
    ranks = [1, 2, 777, 1000, 1999, 2000, 0, 2001]
    got = skew.boundary_rows(df, F.col("k"), "id", {f"r{r}": F.lit(r) for r in ranks}, n=F.count("*")).first()
    assert [got[f"r{r}"] and tuple(got[f"r{r}"]) for r in ranks] == [(order[r - 1][1], order[r - 1][0]) if 0 < r <= 2000 else None for r in ranks]
    assert skew.boundary_rows(df.limit(0), F.col("k"), "id", {"a": F.lit(1)}, n=F.count("*")).first().a is None


def test_top_per_group_and_keep_first(skewed):
    rows, df = skewed
    best = {}
    for r in sorted(rows, key=lambda r: (-r[2], r[0])):
        best.setdefault(r[1], []).append(r[0])
    got = skew.top_per_group(df, ["key"], [F.desc("v"), F.col("id")], 4, "id", salts=7)
    assert sorted(r.id for r in got.collect()) == sorted(i for ids in best.values() for i in ids[:4])
    first = skew.keep_first(df, ["key"], [F.desc("v"), F.col("id")])
    assert sorted(r.id for r in first.collect()) == sorted(ids[0] for ids in best.values())


def test_hot_key_is_limited_before_the_shuffle(skewed):
    _, df = skewed
    plan = skew.keep_first(df, ["key"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_pareto_against_brute_force(skewed):
    rows, df = skewed
    expected = set()
    for key in {r[1] for r in rows}:
        best = None
        for r in sorted((r for r in rows if r[1] == key), key=lambda r: (r[3], -r[2], r[0])):
            if best is None or r[2] > best:
                expected.add(r[0])
                best = r[2]
    got = timeline.pareto_frontier(df, "key", "x", "v", "id", salts=5)
    assert {r.id for r in got.collect()} == expected


def test_work_dir_follows_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert work_dir(spark) == before.rstrip("/") if before else work_dir(spark)


# --- layers and merge ----------------------------------------------------------


def test_merge_keeps_newest_and_null_ids(spark):
    rows = [
        (1, "a", "2026-03-01T10:00:00.000001", day(1)), (2, "a", "2026-03-02 09:00:00", day(2)), (3, "a", "not a time", day(3)),
        (4, None, None, day(1)), (5, None, None, day(1)), (6, "b", "2026-03-01 10:00:00", day(1)), (7, "b", "2026-03-01T10:00:00", day(1)),
    ]
    df = spark.createDataFrame(rows, "raw_id bigint, id string, collected_at string, date date")
    assert collected(layers.merge_dedup(df), "raw_id") == [(2,), (4,), (5,), (7,)]
    assert collected(layers.merge_dedup(df.orderBy(F.desc("raw_id"))), "raw_id") == [(2,), (4,), (5,), (7,)]


def test_stable_id(spark):
    rows = [("f", "u", "t", "1"), (" ", "u", "t", "1"), (None, "", "t", "1"), (None, None, " ", "1"), (None, None, None, " ")]
    df = spark.createDataFrame(rows, "fingerprint string, url string, title string, id string")
    assert [r.id for r in layers.harmonize_id(df.coalesce(1)).collect()] == ["f", "u", "t", "1", None]


def gold_rows(spark, rows):
    return spark.createDataFrame(rows, "id bigint, fingerprint string, url string, title string, collected_at timestamp, date date")


def test_merged_table_is_incremental_and_idempotent(spark):
    first = [(1, "a", "u", "t", at(1), day(1)), (2, "b", "u", "t", at(1), day(1)), (3, "", "", " ", at(1), day(1))]
    second = [(4, "a", "u", "t", at(1, d=2), day(2)), (5, "c", "u", "t", at(1, d=2), day(2))]
    table = merged.MergedTable(spark, new_path(spark, "t-merged"))
    assert table.version() == 0 and table.read() is None
    one = table.merge(gold_rows(spark, first)).first()
    assert (one.version, one.total_rows, one.rows_added) == (1, 3, 3)
    two = table.merge(gold_rows(spark, first + second)).first()
    assert (two.version, two.total_rows, two.rows_before, two.rows_added) == (2, 4, 3, 1)
    assert two.dates_included == [day(1), day(2)]
    same = table.merge(gold_rows(spark, first + second)).first()
    assert (same.total_rows, same.rows_added) == (4, 0)
    assert collected(table.read(), "id", "raw_id") == [("3", 3), ("a", 4), ("b", 2), ("c", 5)]
    assert collected(table.read(1), "raw_id") == [(1,), (2,), (3,)]
    full = table.merge(gold_rows(spark, first), force_full=True).first()
    assert (full.version, full.total_rows) == (4, 3)


def test_merge_leaves_buckets_closed(spark):
    """New ids become further folders; an id that comes again opens its bucket only, and whole rows stay whole."""
    rows = [(i, f"f{i}", "t", "u", f"{i} " * 50, at(1), day(1)) for i in range(200)]
    schema = "id bigint, fingerprint string, title string, url string, content string, collected_at timestamp, date date"
    table = merged.MergedTable(spark, new_path(spark, "t-buckets"), buckets=16)
    table.merge(spark.createDataFrame(rows, schema))
    first = {(r.bucket, r.folder) for r in table.manifest()}
    more = rows + [(900 + i, f"g{i}", "t", "u", "new", at(2), day(2)) for i in range(30)]
    assert table.merge(spark.createDataFrame(more, schema)).first().buckets_opened == 0
    second = {(r.bucket, r.folder) for r in table.manifest()}
    assert first < second and table.read().count() == 230
    again = more + [(990, "f7", "t", "u", "newer", at(3), day(3))]
    assert table.merge(spark.createDataFrame(again, schema)).first().buckets_opened == 1
    third = {(r.bucket, r.folder) for r in table.manifest()}
    assert len({b for b, _ in second - third}) == 1
    got = {r.id: (r.raw_id, r.content) for r in table.read().collect()}
    assert len(got) == 230 and got["f7"] == (990, "newer") and got["f8"] == (8, "8 " * 50)
    for i in range(merged.MAX_FOLDERS):
        more.append((2000 + i, "same bucket", "t", "u", "x", at(4 + i), day(4 + i)))
        table.merge(spark.createDataFrame(more, schema))
    assert max(Counter(r.bucket for r in table.manifest()).values()) <= merged.MAX_FOLDERS + 1
    assert table.read().filter("id = 'same bucket'").collect()[0].raw_id == 2007


def test_second_merge_from_one_version_fails(spark):
    rows = [(1, "a", at(1), day(1)), (2, "b", at(1), day(1))]
    schema = "id bigint, fingerprint string, collected_at timestamp, date date"
    path = new_path(spark, "t-two")
    one, two = merged.MergedTable(spark, path), merged.MergedTable(spark, path)
    one.merge(spark.createDataFrame(rows, schema))
    late = spark.createDataFrame([*rows, (3, "c", at(2), day(2))], schema)
    other = spark.createDataFrame([*rows, (4, "d", at(3), day(3))], schema)
    publish = one._publish
    one._publish = lambda version, commit: (two.merge(other), publish(version, commit))
    with pytest.raises(merged.ConcurrentMerge):
        one.merge(late)
    assert two.version() == 2 and collected(two.read(), "id") == [("a",), ("b",), ("d",)]
    one._publish = publish
    one.merge(late)
    assert collected(one.read(), "id") == [("a",), ("b",), ("c",), ("d",)]


def test_union_is_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, id int")
    c = spark.createDataFrame([(3,)], "id int")
    assert sorted(map(str, layers.union_layers(a, b, c).collect())) == sorted(map(str, spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, s string").collect()))


def test_read_layer_dates(spark):
    base = new_path(spark, "t-layer")
    spark.createDataFrame([(1, "2026-03-01"), (2, "2026-03-03")], "id int, date string").write.partitionBy("date").parquet(base)
    spark.createDataFrame([(3, "x")], "id int, extra string").write.parquet(f"{base}/date=2026-03-05")
    spark.createDataFrame([(9,)], "id int").write.parquet(f"{base}/date=broken")
    assert collected(layer_source.available_dates(spark, base), "date") == [(day(1),), (day(3),), (day(5),)]
    assert collected(layer_source.read_range(spark, base, "2026-03-02", "2026-03-09"), "id", "extra") == [(2, None), (3, "x")]
    assert collected(layer_source.latest_partition(spark, base), "id") == [(3,)]
    with pytest.raises(layer_source.NoSuchPartition):
        layer_source.read_date(spark, base, "2026-03-02")


def test_scan_opens_the_files_of_its_dates_only(spark):
    """The columns come from the file beside the layer: damaged files of other dates do not matter."""
    base = new_path(spark, "t-gold")
    sinks.write_gold(spark.createDataFrame([(1, "a", "s", day(1)), (2, "b", "s", day(2))], "id int, title string, source string, date date"), base)
    sinks.write_gold(spark.createDataFrame([(3, "s", 0.5, day(3))], "id int, source string, score double, date date"), base)
    path, files = layer_source._file(spark, f"{base}/all/date=2026-03-02/part-broken.parquet")
    files.create(path, True).close()
    assert collected(layer_source.available_dates(spark, f"{base}/all"), "date") == [(day(1),), (day(2),), (day(3),)]
    assert layer_source.read_date(spark, f"{base}/all", "2026-03-01").collect() == [(1, "a", "s", None, day(1))]
    latest = layer_source.latest_partition(spark, f"{base}/all")
    assert collected(latest, "id", "title", "score") == [(3, None, 0.5)] and len(latest.inputFiles()) == 1


def test_empty_silver_writes_nothing(spark):
    base = new_path(spark, "t-silver")
    rows = spark.createDataFrame([(1, day(1))], "id int, date date")
    sinks.write_silver(rows, base)
    sinks.write_silver(rows.limit(0), base)
    sinks.write_silver(spark.createDataFrame([(2, day(2))], "id int, date date"), base)
    assert spark.read.parquet(f"{base}/parquet").count() == 2


def test_new_articles(spark):
    incoming = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "id int, fingerprint string")
    stored = spark.createDataFrame([("b",)], "fingerprint string")
    assert collected(linkage.new_articles(incoming, stored), "id") == [(1,), (4,)]


def test_state_report_lists_the_newest_syncs(spark):
    raw = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1))], "id long, source string, collected_at timestamp")
    links = spark.createDataFrame([], "raw_data_id long")
    outputs = spark.createDataFrame([], "raw_data_id long, model_name string, label string")
    log = [(i, i % 2, dt.datetime(2024, 1, 1, 8, 0, i), None if i == 40 else i, "OK") for i in range(42)] + [(50, 9, None, 1, "OK")]
    sync = spark.createDataFrame(log, "sync_log_id long, source_id long, sync_date timestamp, rows_synced long, status string")
    sources = spark.createDataFrame([(0, "a"), (1, None)], "source_id long, name string")
    report = tracking.state_report(raw, links, outputs, sync, sources).filter("section = 'sync'")
    rows = {r.name: r.value for r in report.collect()}
    assert sorted(rows, key=int) == [str(i) for i in range(12, 42)]  # 50 has no known source
    assert rows["41"] == " | 2024-01-01 08:00:41 | 41 | OK" and rows["40"] == "a | 2024-01-01 08:00:40 |  | OK"
    told = tracking.state_report(raw, links, outputs, sync.withColumn("error_message", F.lit("gone")), sources, 1).filter("section = 'sync'")
    assert [r.value for r in told.collect()] == [" | 2024-01-01 08:00:41 | 41 | OK | gone"]


def test_archive_skips_known_files(spark, data):
    known = sinks.archive_manifest(spark, data, pattern="nation.parquet")
    rest = sinks.archive_manifest(spark, data, known, "nation.parquet")
    assert known.count() == 1 and rest.count() == 0


def test_archive_hashes_large_files_line_by_line(spark, tmp_path):
    rng, mark = random.Random(2), b"\xef\xbb\xbf"
    files_ = {
        "a.bin": rng.randbytes(300_000), "sub x/b c.bin": b"\n\n" + rng.randbytes(5000) + b"\n", "mark.txt": mark + b"x\r\n" * 900,
        "marks.txt": mark * 2 + b"x\ny" * 900, "lines": b"\n" * 2000, "one": b"x" * 2000, "z.gz": rng.randbytes(3000), "small": b"\n", "mark": mark,
    }
    (tmp_path / "sub x").mkdir()
    for name, content in files_.items():
        (tmp_path / name).write_bytes(content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = sinks.archive_manifest(spark, str(tmp_path), whole=1000).select("logical_name", "size_bytes", "sha256").collect()
    assert sorted(map(tuple, rows)) == sorted((n.split("/")[-1], len(c), hashlib.sha256(c).hexdigest()) for n, c in files_.items())
    known = sinks.archive_manifest(spark, str(tmp_path), pattern="*.bin", whole=1000)
    assert sinks.archive_manifest(spark, str(tmp_path), known, whole=1000).count() == len(files_) - 2
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_archive_digests_refuse_parts_of_a_file():
    batch = pa.RecordBatch.from_pydict({"file": ["f", "f"], "size": [10, 10], "line": [b"\nab", b"\nc"]})
    with pytest.raises(ValueError, match="4 of 10 bytes of f"):
        list(sinks._digests([batch]))


# --- filters and contracts -------------------------------------------------------


def test_leak_and_label_contracts(spark):
    with pytest.raises(ValueError):
        filters.assert_no_leak(["id", "label"])
    filters.assert_no_leak(["id", "title"])
    with pytest.raises(ValueError):
        filters.assert_labelled(["id"])
    df = spark.createDataFrame([(1, "a", "x", "positif", "positif")], "id int, title string, content string, sentiment string, sentiment_label string")
    assert filters.app_input(df).columns == ["id", "title", "content"]


def test_ia_labelled(spark):
    df = spark.createDataFrame([(1, "positive"), (2, "négatif")], "id int, sentiment string")
    assert collected(datasets.ia_labelled(df), "id", "sentiment_label") == [(1, "positif"), (2, "negatif")]
    with pytest.raises(ValueError):
        datasets.ia_labelled(df.select("id"))


@pytest.mark.parametrize(("matches", "kept"), [(10, 30), (11, 11)])
def test_theme_boundary(spark, matches, kept):
    rows = [(i, "banque" if i < matches else "autre", "t") for i in range(30)]
    df = spark.createDataFrame(rows, "id int, topic_1 string, title string")
    assert filters.with_theme(df, ["banq"]).count() == kept


def test_bare_word_and_unknown_condition(spark):
    df = spark.createDataFrame([("positif", 1), ("neutre", None), (None, 9)], "sentiment string, n int")
    assert filters.where_sql(df, "positif").count() == 1
    assert filters.delete_where(df, "n > 5").count() == 1


# --- reports ---------------------------------------------------------------------


def drift_of(spark, rows):
    df = spark.createDataFrame(rows, "sentiment string, topic_1 string")
    return tuple(aggregates.drift_metrics(df).first())


def test_drift(spark):
    worked = [("positif", "finance"), ("positif", "finance"), ("neutre", "politique"), ("négatif", "finance")]
    assert drift_of(spark, worked) == (4, 1.5, 0.75, 0.4018)
    assert drift_of(spark, [("neutre", "a"), ("neutre", "b")]) == (2, 0.0, 0.5, 0.75)
    assert drift_of(spark, [(None, None), (None, "a")]) == (2, 0.0, 0.5, 0.75)
    assert drift_of(spark, []) == (0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize(("now", "alert"), [(550, True), (549, False)])
def test_drift_alert_boundary(spark, now, alert):
    before = spark.range(1000).select(F.when(F.col("id") < 500, "positif").otherwise("neutre").alias("sentiment"))
    after = spark.range(1000).select(F.when(F.col("id") < now, "positif").otherwise("neutre").alias("sentiment"))
    got = aggregates.sentiment_drift(after, before).filter("sentiment = 'positif'").first()
    assert got.alert is alert


def test_sentiment_drift_keeps_vanished_labels(spark):
    before = spark.createDataFrame([("positif",), ("neutre",)], "sentiment string")
    after = spark.createDataFrame([("positif",)], "sentiment string")
    got = collected(aggregates.sentiment_drift(after, before), "sentiment", "delta")
    assert got == [("neutre", -50.0), ("positif", 50.0)]


def test_topic_columns(spark):
    listed = spark.createDataFrame([(["a", "b"],), (["a"],)], "topics array<string>")
    assert collected(aggregates.by_topic(listed), "topic", "count") == [("a", 2), ("b", 1)]
    assert aggregates.by_topic(spark.createDataFrame([(1,)], "id int")).count() == 0


@pytest.mark.parametrize(("share", "risk"), [(45, 8), (44, 6), (35, 6), (34, 4), (25, 4), (24, 2)])
def test_risk_steps(spark, share, risk):
    df = spark.range(100).select(F.when(F.col("id") < share, "négatif").otherwise("neutre").alias("sentiment"))
    assert aggregates.risk_score(df).first().risk == risk


def test_trend_needs_twenty_rows(spark):
    def rows(n):
        return spark.createDataFrame([(i, at(i % 24, d=1 + i // 24), 0.9 if i >= n // 2 else 0.1) for i in range(n)], "id int, collected_at timestamp, sentiment_score double")

    assert aggregates.temporal_trend(rows(19)).count() == 0
    assert aggregates.temporal_trend(rows(20)).first().trend == "hausse"


def sync(spark, rows):
    return spark.createDataFrame(rows, "sync_log_id bigint, source_id bigint, sync_date timestamp, rows_synced bigint, status string")


def test_source_volume(spark):
    rows = [
        (1, 1, at(1), 100, "OK"), (2, 1, at(2), 20, "OK"), (3, 2, at(1), 100, "OK"), (4, 2, at(2), 21, "OK"), (5, 3, at(1), 5, "OK"),
        (6, 4, at(1), 9, "ERROR"), (7, 5, at(1), 50, "OK"), (8, 5, at(2), 0, "OK"), (9, 5, at(3), 0, "ERROR"),
    ]
    got = {r.source_id: (r.now, r.previous, r.anomaly) for r in timeline.source_volume_delta(sync(spark, rows)).collect()}
    assert got == {1: (20, 100, "volume drop"), 2: (21, 100, None), 3: (5, 0, None), 5: (0, 50, "no volume")}


@pytest.mark.parametrize(("loaded", "invalid", "status"), [(20, 2, "PASS"), (19, 0, "WARN"), (20, 3, "WARN")])
def test_run_contract_boundaries(spark, loaded, invalid, status):
    articles = spark.range(loaded).select("id", F.lit("s").alias("source"))
    extracted = spark.range(loaded + invalid)
    links = articles.select(F.col("id").alias("raw_data_id"))
    outputs = links.withColumn("model_name", F.lit("sentiment_keyword"))
    got = tracking.run_contract(extracted, articles, articles, links, outputs).first()
    assert got.status == status


def test_run_contract_without_new_rows_warns(spark):
    none = spark.range(0).select("id", F.lit("s").alias("source"))
    links = none.select(F.col("id").alias("raw_data_id"))
    got = tracking.run_contract(spark.range(5), spark.range(5), none, links, links.withColumn("model_name", F.lit("x"))).first()
    assert got.status == "WARN" and got.enriched_ratio == 0.0


def test_journey_and_silver_differ_for_one_topic(spark):
    raw = spark.createDataFrame([(1, day(1)), (2, day(1))], "id bigint, date date")
    links = spark.createDataFrame([(1, 1, "a", 0.5), (2, 2, "a", 0.5), (3, 2, "b", 0.2), (4, 2, "c", 0.2)], "doc_topic_id bigint, raw_data_id bigint, topic string, confidence_score double")
    outputs = spark.createDataFrame([], "output_id bigint, raw_data_id bigint, model_name string, label string, score double")
    silver = collected(layers.silver(raw, links), "id", "topic_1", "topic_2")
    journey = collected(tracking.article_journey(raw, links, outputs, "2026-03-01"), "id", "topic_1", "topic_2")
    assert silver == [(1, "a", ""), (2, "a", "b")] and journey == [(1, "a", "a"), (2, "a", "b")]


def test_source_deltas_option(spark):
    now = spark.createDataFrame([("a", 3), ("b", 1)], "source string, articles bigint")
    before = spark.createDataFrame([("b", 1), ("c", 4)], "source string, articles bigint")
    assert collected(tracking.source_deltas(now, before), "source", "delta") == [("a", 3)]
    assert collected(tracking.source_deltas(now, before, include_vanished=True), "source", "delta") == [("a", 3), ("c", -4)]


def test_audit_limit_is_kept(spark):
    log = spark.range(600).select(F.col("id").alias("action_log_id"), F.lit(1).alias("profil_id"), F.lit(at(1)).alias("action_date"))
    accounts = spark.createDataFrame([(1, "admin")], "profil_id int, role string")
    assert tracking.audit_journal(log, accounts, n=9999).count() == 600
    assert tracking.audit_journal(log, accounts, n=550).count() == 550
    with pytest.raises(ValueError):
        tracking.audit_journal(log, accounts, n=0)


def test_retention(spark):
    raw = spark.createDataFrame([(1, at(0, d=1)), (2, at(0, d=9)), (3, at(0, d=8))], "id bigint, collected_at timestamp")
    links = spark.createDataFrame([(1,), (2,), (7,)], "raw_data_id bigint")
    kept, topics, outputs = tracking.retention_purge(raw, links, links, 7, "2026-03-15")
    assert collected(kept, "id") == [(2,), (3,)] and collected(topics, "raw_data_id") == [(2,)] == collected(outputs, "raw_data_id")


# --- datasets and evaluation -------------------------------------------------------


def test_split_sizes_ties_and_nulls(spark):
    rows = [(i, None if i % 7 == 0 else at(i % 3)) for i in range(23)]
    df = spark.createDataFrame(rows, "id bigint, collected_at timestamp")
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or at(0), r[0]))
    expected = {r[0]: "train" if n < 18 else "val" if n < 20 else "test" for n, r in enumerate(order)}
    assert {r.id: r.split for r in datasets.temporal_split(df).collect()} == expected
    shuffled = datasets.temporal_split(df.orderBy(F.rand(1)))
    assert {r.id: r.split for r in shuffled.collect()} == expected


def test_random_split_is_reproducible(spark):
    df = spark.range(95)
    one, two = (sorted(map(tuple, datasets.random_split(d, seed=3).collect())) for d in (df, df.orderBy(F.desc("id"))))
    assert one == two and sum(s == "train" for _, s in one) == 76 and sum(s == "val" for _, s in one) == 9


def test_split_dedup_keeps_blank_keys(spark):
    rows = [(1, "f", "u1", "x"), (2, "f", "u2", "y"), (3, "", "u1", "z"), (4, None, None, "q"), (5, None, " ", "q"), (6, "g", None, "r")]
    df = spark.createDataFrame(rows, "id bigint, fingerprint string, url string, content string")
    assert collected(datasets.split_dedup(df), "id") == [(1,), (4,), (6,)]


@pytest.mark.parametrize(("target", "cap", "extra"), [(0.5, 10, 6), (0.5, 2.5, 3), (0.1, 3, 0), (0.5, 1.0, 0), (0.9, 4.5, 7)])
def test_rebalance_counts(spark, target, cap, extra):
    df = spark.range(10).select("id", F.when(F.col("id") < 2, "positif").otherwise("neutre").alias("label"))
    got = datasets.rebalance(df, target, cap)
    assert got.count() == 10 + extra
    per_row = [r["count"] for r in got.filter("label = 'positif'").groupBy("id").count().collect()]
    assert max(per_row) - min(per_row) <= 1


def test_balanced_sample(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 90, "a").otherwise("b").alias("label"))
    got = datasets.balanced_sample(df, 20).groupBy("label").count()
    assert collected(got, "label", "count") == [("a", 20), ("b", 10)]
    assert datasets.balanced_sample(df, 0).count() == 100


PAIRS = [("negatif", "negatif", 0.9, 0.05, 0.05)] * 3 + [("negatif", "neutre", 0.3, 0.4, 0.3)] + [("positif", "positif", 0.1, 0.1, 0.8)] * 2 + [("positif", "negatif", 0.6, 0.2, 0.2)]


def test_metrics(spark):
    df = spark.createDataFrame(PAIRS, "y_true string, y_pred string, p_neg double, p_neu double, p_pos double")
    got = {r.label: r for r in evaluation.classification_metrics(df).collect()}
    assert got["accuracy"].precision == pytest.approx(5 / 7)
    assert (got["negatif"].precision, got["negatif"].recall, got["negatif"].support) == (0.75, 0.75, 4)
    assert (got["neutre"].precision, got["neutre"].f1, got["neutre"].support) == (0.0, 0.0, 0)
    auc = {r.label: r.auc for r in evaluation.roc_auc(df).collect()}
    assert auc["neutre"] is None
    assert auc["negatif"] == pytest.approx(11 / 12) and auc["positif"] == pytest.approx((8 + 3) / 12)
    assert auc["macro"] == pytest.approx((auc["negatif"] + auc["positif"]) / 2)


def test_id_prefix(spark):
    df = spark.createDataFrame([("P01",), ("NE10",), ("N01",)], "id string")
    assert [r[0] for r in df.coalesce(1).select(evaluation.id_prefix(F.col("id"))).collect()] == ["P", "NE", "N"]


@pytest.mark.parametrize(("alerts", "verdict"), [(0, "GO"), (2, "GO avec vigilance"), (3, "NO-GO")])
def test_verdict(spark, alerts, verdict):
    checks = spark.range(6).select((F.col("id") < alerts).alias("alert"))
    assert evaluation.inference_verdict(checks).first().verdict == verdict


def test_scorer_failure_is_neutral(spark):
    def broken(texts):
        raise RuntimeError("no model")

    df = spark.createDataFrame([(1, "t", "c")], "id int, title string, content string")
    assert scoring.batch_score(df, broken).first().out.label_3c == "NEUTRAL"
    with pytest.raises(ValueError):
        scoring.batch_score(df.withColumn("label", F.lit(1)), broken)


def test_one_bad_text_fails_alone(spark):
    good = scoring.lexicon_scorer(LEXICON)

    def scorer(texts):
        if any("poison" in t for t in texts):
            raise RuntimeError("bad text")
        return good(texts)

    df = spark.range(200).select("id", F.lit("t").alias("title"), F.when(F.col("id") == 77, "poison").otherwise("fine").alias("content")).coalesce(1)
    out = scoring.batch_score(df, scorer)
    assert [r.id for r in out.filter("failed").collect()] == ["77"]
    assert scoring.check_failures(out).first().failed_share == 0.005
    with pytest.raises(Exception, match="failed share"):
        scoring.check_failures(out, 0.001).collect()


def test_prediction_frame_columns(spark):
    df = spark.createDataFrame([(1, "titre", "c")], "id int, title string, content string")
    frame = scoring.prediction_frame(scoring.batch_score(df, lambda texts: [[("POSITIVE", 0.91), ("NEUTRAL", 0.07), ("NEGATIVE", 0.02)]] * len(texts)), "v1", "run-1")
    row = frame.first()
    assert (row.id, row.predicted_sentiment, row.confidence, row.p_neg, row.model_version, row.inference_run_id) == ("1", "positif", 0.91, 0.02, "v1", "run-1")
    assert row.prediction_timestamp is not None and row.predicted_sentiment_score == 0.89


# --- sources -----------------------------------------------------------------------


def test_csv_guards(spark):
    path = new_path(spark, "t-csv")
    words = " ".join(f"mot{i}" for i in range(20))
    rows = [("A good title", words, None), ("short", words, None), ("A good title", "x " * 60, "u"), ("A good title", "brief", "u"), (None, words, "u"), ('Quoted "title"', words + "\nnext", "u")]
    spark.createDataFrame(rows, "title string, content string, url string").withColumn("published_at", F.lit(None).cast("string")).coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    got = collected(files.csv_guarded(spark, path, "https://d"), "title", "url")
    assert got == [("A good title", "https://d"), ('Quoted "title"', "u")]


def test_labelled_corpus_columns(spark):
    df = spark.createDataFrame([("négatif", "texte"), ("5", "nan"), ("?", "x"), ("pos", " ok ")], "label string, text string")
    assert collected(files.labelled_corpus(df), "label", "text") == [("neg", "texte"), ("pos", "ok")]
    with pytest.raises(ValueError):
        files.labelled_corpus(df.select("text"))


def test_weather_labels(spark):
    codes = ["0", "2", "3", "48", "57", "82", "86", "99", "10", "x", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, code string")
    got = [r[1] for r in df.select("i", payloads.weather_label(F.col("code"))).orderBy("i").collect()]
    assert got == ["ensoleille", "partiellement nuageux", "couvert", "brouillard", "bruine", "pluie", "neige", "orage", "conditions variables", "conditions inconnues", "conditions inconnues"]


def test_records_are_found_in_order():
    assert payloads.records_of('{"items": [], "data": {"x": 1}, "results": [{"a": 1}]}') == []
    assert payloads.records_of('{"data": {"series": [{"a": 1}, 3]}, "results": [{"b": 1}]}') == ['{"a": 1}']
    assert payloads.records_of('{"data": {"y": 1}, "results": [{"b": "é"}]}') == ['{"b": "é"}']
    assert len(payloads.records_of("[" + ",".join(['{"a":1}'] * 70) + "]")) == 70
    assert len(payloads.records_of("[" + ",".join(['{"a":1}'] * 70) + "]", 60)) == 60
    assert payloads.records_of("not json") == []


def test_page_links(spark):
    html = '<a href="/actualite/x">Un article assez long. Suite du texte</a><a href="/actualite/x">Un article assez long. Encore</a><a href="/actualite/categorie-b">Une rubrique assez longue ici</a><a href="https://o.example/actualite/y">Autre <b>article</b> tout aussi long</a><a href="z">non</a>'
    df = spark.createDataFrame([(1, "https://s.example/p?q=1", html)], "page_id bigint, url string, html string")
    got = collected(pages.link_articles(df, "S", ("/actualite/",), ("categorie-",), 25), "title", "url")
    assert got == [("[S] Autre article tout aussi long", "https://o.example/actualite/y"), ("[S] Un article assez long", "https://s.example/actualite/x")]


def test_tab_events_are_whole_unless_limited(spark):
    path = new_path(spark, "t-tsv")
    for n in range(3):
        spark.range(60).select(F.concat_ws("\t", F.col("id").cast("string"), F.lit(f"event {n} title"), F.lit("20260301"))).coalesce(1).write.text(f"{path}/f{n}")
    assert files.tab_events(spark, f"{path}/*").count() == 180
    got = files.tab_events(spark, f"{path}/*", per_file=51, total=100)
    assert got.count() == 100
    assert got.filter("title = 'event 0 title'").count() in (0, 49, 51)


def test_texts_are_whole_unless_cut(spark):
    long = " ".join(f"mot{i}" for i in range(2000))
    feed = spark.createDataFrame([(long,)], "t string").select(F.to_json(F.struct(F.array(F.struct(F.col("t").alias("title"), F.col("t").alias("summary"))).alias("entries"))).alias("payload"))
    assert payloads.feed_articles(feed).first().content == long
    row = payloads.feed_articles(feed, title_width=TITLE_WIDTH, content_width=CONTENT_WIDTH).first()
    assert (len(row.title), len(row.content)) == (TITLE_WIDTH, CONTENT_WIDTH)
    rows = spark.createDataFrame([("A good title", long)], "title string, content string")
    assert files.guarded_import(rows).first().content == long


# --- streaming ---------------------------------------------------------------------


def moments(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp, source string")


def streamed(spark, df, per_batch=1, parts=1):
    path = new_path(spark, "t-stream")
    df.repartition(parts).write.parquet(path)
    return jobs.folder_stream(spark, path, df.schema, "*.parquet", per_batch=per_batch)


def test_rate_stream_equals_batch(spark):
    rows = [(at(1, 0, s), "a") for s in range(0, 40)] + [(at(1, 30), "a"), (at(9), "b")]
    df = moments(spark, rows)
    closed = jobs.run_to_table(rules.event_rate(streamed(spark, df), 0.1, ("source",)), "t-rate")
    batch = rules.event_rate(df, 0.1, ("source",))
    assert collected(closed, *closed.columns) == collected(batch, *batch.columns) and closed.count() == 5


def test_filters_do_not_split_sessions(spark):
    df = moments(spark, [(at(1, 10 * i), "a") for i in range(5)] + [(at(9), "a")])
    closed = rules.sessions(df, ("source",), "30 minutes")
    found = closed.collect()
    for name in ("window_start", "window_end", "count"):
        for row in found:
            assert collected(closed.filter(F.col(name) <= F.lit(row[name])), *closed.columns) == sorted(tuple(r[c] for c in closed.columns) for r in found if r[name] <= row[name])
    silent = rules.silence(df, ("source",), "30 minutes")
    assert silent.filter(F.col("silent_at") < F.lit(at(2, 10))).count() == 0


def test_sessions_stream_equals_batch(spark):
    rng = random.Random(3)
    rows = [(at(0) + dt.timedelta(seconds=rng.randrange(86400)), rng.choice(["a", "a", "a", "b"])) for _ in range(400)]
    df = moments(spark, rows + [(at(12, d=3), "z")])
    closed = jobs.run_to_table(rules.sessions(streamed(spark, df, parts=2, per_batch=9), ("source",), "5 minutes"), "t-sessions")
    batch = rules.sessions(df, ("source",), "5 minutes").filter("source <> 'z'")
    assert collected(closed, *closed.columns) == collected(batch, *closed.columns)


def test_held_alerts(spark):
    ends = [at(1, m) for m in (0, 1, 2, 3, 4, 5)] + [at(2, m) for m in (0, 1, 2, 3, 4)]
    df = spark.createDataFrame([(e,) for e in ends], "window_end timestamp").withColumn("key", F.lit("k"))
    assert collected(rules.held_for(df, 5, ("key",)), "since", "until") == [(at(1, 0), at(1, 5))]


def test_late_rows(spark):
    path = new_path(spark, "t-late")
    for n, hours in enumerate(([1, 2], [9], [1, 8, 9])):
        moments(spark, [(at(h), "a") for h in hours]).coalesce(1).write.mode("append").parquet(path)
    stream = jobs.folder_stream(spark, path, moments(spark, []).schema, "*.parquet", per_batch=1)
    batches, late = jobs.late_rows(stream)
    assert collected(batches, "batch_id", "rows", "late") == [(0, 2, 0), (1, 1, 0), (2, 3, 1)]
    assert [(r.batch_id, r.ts) for r in late.collect()] == [(2, at(1))]


def test_second_ingest_adds_to_the_store(spark):
    schema = "id bigint, title string, content string, url string, source string, collected_at timestamp"
    store, folders = jobs.ArticleStore(spark, new_path(spark, "t-store")), []
    for first, n in ((0, 50), (50, 30)):
        rows = [(i, f"titre {i}", f"un contenu assez long {i}", "u", "s", at(1)) for i in range(first, first + n)]
        folders.append(new_path(spark, "t-landing"))
        spark.createDataFrame(rows, schema).repartition(2).write.json(folders[-1])
    spark_schema = spark.createDataFrame([], schema).schema
    for feed, expected in ((0, 50), (1, 80), (1, 80)):
        store.ingest(jobs.folder_stream(spark, folders[feed], spark_schema, kind="json", per_batch=1), f"feed-{feed}")
        assert store.read().select("id").distinct().count() == store.read().count() == expected


def test_replayed_batch_changes_nothing(spark):
    schema = "id bigint, title string, content string, url string, source string, collected_at timestamp"
    one = spark.createDataFrame([(1, "titre", "un contenu assez long", "u", "s", at(1)), (2, "titre", "un contenu assez long", "u", "s", at(1))], schema)
    two = spark.createDataFrame([(3, "TITRE", "un contenu assez long", "u", "s", at(2)), (4, "autre", "un contenu assez long", "u", "s", at(2)), (5, "x", "y", "u", "s", at(2))], schema)
    store = jobs.ArticleStore(spark, new_path(spark, "t-store"))
    for batch, number in ((one, 0), (two, 1), (two, 1)):
        store.add(batch, number)
    assert collected(store.read(), "id") == [(1,), (4,)]


def test_store_reads_little_however_many_batches(spark):
    schema = "id bigint, title string, content string, url string, source string, collected_at timestamp"
    store = jobs.ArticleStore(spark, new_path(spark, "t-store"), rows_per_prefix=2, fan=2)
    batch = lambda n: spark.createDataFrame([(i, f"titre {i}", f"un contenu assez long {i}", "u", "s", at(1)) for i in range(8 * n, 8 * n + 12)], schema)
    one, read = spark.createDataFrame([("ab" * 32,)], "fingerprint string"), []
    for n in range(8):
        store.add(batch(n), n)
        read.append(store.hashes.known(one, "landing", -1).count())
    listed = store.hashes._listed()
    assert [(x["level"], x["digits"]) for x in listed["layers"]] == [(2, 2), (1, 1)] and listed["merged"] == {"landing": 5}
    assert sum(x["rows"] for x in listed["layers"]) == 8 * 6 + 4 and max(read[3:]) <= 8 * 3 + 8  # three layers of a batch, few rows of the merged
    for n in (7, 6):  # replays after a merge
        store.add(batch(n), n)
    store.add(batch(0), 0, "other-feed")
    assert sorted(r.id for r in store.read().collect()) == list(range(8 * 7 + 12))
    assert store.hashes._names("layers/*") and len(store.hashes._names("batches/feed=landing/batch=*")) == 2
    listed["version"] = 1
    with pytest.raises(RuntimeError, match="another writer"):
        store.hashes._publish(listed)


def test_recent_copies_end_in_the_stream(spark):
    schema = "id bigint, title string, content string, url string, source string, collected_at timestamp"
    rows = [(i, f"titre {i % 7}", f"un contenu assez long {i % 7}", "u", "s", at(i % 5)) for i in range(40)]
    path = new_path(spark, "t-landing")
    spark.createDataFrame(rows, schema).repartition(4).write.json(path)
    stream = jobs.folder_stream(spark, path, spark.createDataFrame([], schema).schema, kind="json", per_batch=1)
    kept = jobs.ArticleStore(spark, new_path(spark, "t-store"), fan=2).ingest(stream, recent="1 day")
    assert sorted({r.title for r in kept.collect()}) == sorted(f"titre {i}" for i in range(7)) and kept.count() == 7


def test_wide_rows_are_deduplicated_without_sorting_them(spark):
    """Of equal keys the first row stays, repeated and null ids included, and only the keys are shuffled and sorted."""
    rows = [("a", 2), ("a", 1), ("a", 1), ("b", None), ("b", 3), ("c", None)]
    wide = spark.createDataFrame([(k, i, f"text {k}", n) for n, (k, i) in enumerate(rows)], "key string, id int, content string, _row bigint")
    df = stage(wide, "t-wide")
    got = skew.drop_copies(df, ["key"], [F.col("id")], "_row")
    assert sorted(r._row for r in got.collect()) == [1, 3, 5]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "Exchange hashpartitioning" not in plan


def test_texts_are_not_sorted_for_topics_and_sentiment(spark):
    raw = spark.range(9).withColumn("content", F.lit("text"))
    links = spark.createDataFrame([(1, 1, "a", 0.5), (2, 1, "b", 0.7)], "doc_topic_id bigint, raw_data_id bigint, topic string, confidence_score double")
    outputs = spark.createDataFrame([(1, 1, "sentiment_keyword", "positif", 0.9)], "output_id bigint, raw_data_id bigint, model_name string, label string, score double")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = layers.gold(layers.silver(raw, links), outputs)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        assert {r.id: (r.topic_1, r.topic_2, r.sentiment) for r in got.collect()} == {i: ("b", "a", "positif") if i == 1 else ("", "", "neutre") for i in range(9)}
        done = spark.createDataFrame([("3", "r"), ("4", "s")], "id string, run string")
        rest = scoring.resume(raw, done, "r")
        assert "SortMergeJoin" not in rest._jdf.queryExecution().executedPlan().toString()
        assert {r.id for r in rest.collect()} == set(range(9)) - {3}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_overtaken_rows_of_a_merge(spark):
    """Of an id in both tables the older row is named; at a full tie the one that was there; ids on one side and null ids are not."""
    schema = "id string, collected_at string, date date, raw_id bigint"
    day = dt.date(2024, 1, 1)
    before = spark.createDataFrame([("a", "2024-01-01", day, 1), ("b", "2024-01-03", day, 2), ("c", "2024-01-01", day, 3), ("d", "2024-01-01", day, 4), (None, "2024-01-01", day, 5)], schema)
    new = spark.createDataFrame([("a", "2024-01-02", day, 6), ("b", "2024-01-02", day, 7), ("c", "2024-01-01", day, 3), ("e", "2024-01-01", day, 9), (None, "2024-01-01", day, 10)], schema)
    assert {tuple(r) for r in layers.overtaken(before, new).collect()} == {("a", False), ("b", True), ("c", False)}


def test_landed_files_of_the_ingest_grow_in_number(spark, data, monkeypatch):
    """Each batch takes several files, as many as the articles have splits."""
    from opinara.plans.registry import QUERIES
    from opinara.plans import q_streaming  # noqa: F401

    seen = []
    wanted = jobs.folder_stream
    monkeypatch.setattr(jobs, "folder_stream", lambda s, path, *a, **b: seen.append((path, b["per_batch"])) or wanted(s, path, *a, **b))
    QUERIES["stream_ingest"](spark, data)
    path, per_batch = seen[0]
    assert per_batch > 1 and 3 < spark.read.format("binaryFile").load(f"{path}/*.json").count() <= 3 * per_batch


def test_records_of_a_batch_are_parsed_by_pieces():
    batch = pa.array(['{"series": [{"a": "' + "x" * 20_000 + '"}]}'] * 3000 + [None, "no json"])
    tracemalloc.start()
    out = payloads.record_lists(batch, None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.value_lengths().to_pylist() == [1] * 3000 + [None, 0] and peak < 40_000_000


def test_texts_of_the_corpus_are_counted_once_for_all_runs(spark, data, monkeypatch):
    counted, totals = [], lexicon.lexicon_totals
    monkeypatch.setattr(corpus, "_LAYERS", {})
    monkeypatch.setattr(lexicon, "lexicon_totals", lambda *given: counted.append(given) or totals(*given))
    outputs = corpus.model_output(spark, data)
    assert len(counted) == 2 and outputs.filter("label IS NULL OR score IS NULL").isEmpty()
    monkeypatch.undo()
    raw = corpus.raw(spark, data).filter(F.col("date") < corpus.SCORED_BEFORE)
    for offset, subject in enumerate((F.col("title"), lexicon.title_and_content())):
        want = lexicon.add_sentiment(raw, LEXICON, subject).select((F.col("id") * 2 + offset).alias("output_id"), "sentiment", "sentiment_score")
        got = outputs.filter("model_name = 'sentiment_keyword'").filter(F.col("output_id") % 2 == offset).select("output_id", "label", "score")
        assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
