"""Streaming jobs: running a rule over a landing folder, continuous ingest, drift per bucket, late rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StructField, StructType

from opinara.functions.text import clean_articles, fingerprint, is_valid
from opinara.operators.aggregates import drift_score
from opinara.operators.skew import keep_first
from opinara.storage import new_path
from opinara.streaming.hashes import FAN, ROWS_PER_PREFIX, HashStore
from opinara.streaming.rules import DRIFT_LIMIT, LATENESS


def folder_stream(spark: SparkSession, folder: str, schema: StructType, files: str = "*", kind: str = "parquet", per_batch: int | None = None) -> DataFrame:
    """Stream of the files that land in a folder."""
    reader = spark.readStream.schema(schema).format(kind).option("pathGlobFilter", files)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).load(folder)


def land_in_order(df: DataFrame, folder: str, time: str = "ts", files: int = 3) -> None:
    """Writes rows as files that land one after the other, each with a later stretch of time. The bounds are exact to the second."""
    edges = df.agg(F.unix_timestamp(F.min(time)).alias("low"), F.unix_timestamp(F.max(time)).alias("high")).select(F.struct("low", "high")).scalar()
    share = (F.unix_timestamp(time) - edges["low"]) * files / (edges["high"] - edges["low"] + 1)
    for i in range(files):
        df.filter(F.floor(share) == i).coalesce(1).write.mode("append").parquet(folder)


def _finish(spark: SparkSession, writer: DataStreamWriter, settings: dict[str, str] | None = None) -> None:
    """Runs what is available under ``settings``, with no more state partitions than twice the cores.

    The number is fixed for the life of a checkpoint; on a small cluster the default would mean many empty state stores
    to commit in every batch. The query takes its own copy of the settings when it starts.
    """
    key = "spark.sql.shuffle.partitions"
    settings = {**(settings or {}), key: str(min(int(spark.conf.get(key)), 2 * spark.sparkContext.defaultParallelism))}
    wanted = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        query = writer.trigger(availableNow=True).start()
    finally:
        for name, value in wanted.items():
            spark.conf.set(name, value)
    query.awaitTermination()


def run_to_table(stream: DataFrame, name: str, base: str | None = None, settings: dict[str, str] | None = None) -> DataFrame:
    """Processes what is available into files and returns them; closed windows only, as an append sink gives them.

    With the same ``base`` a later run goes on where the last one stopped. ``settings`` hold for the run alone.
    """
    spark = stream.sparkSession
    base = base or new_path(spark, name)
    target = f"{base}/rows"
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", f"{base}/checkpoint")
    _finish(spark, writer.outputMode("append"), settings)
    return spark.read.schema(stream.schema).parquet(target)


def run_batches(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Processes what is available batch by batch; batch numbers go on from the checkpoint's last one."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    _finish(stream.sparkSession, writer.outputMode("append"))


STORED = "id bigint, title string, content string, url string, source string, collected_at timestamp, fingerprint string, feed string, batch bigint"


def _hashed(rows: DataFrame) -> DataFrame:
    """Cleaned valid articles with their content hash."""
    hashed = clean_articles(rows).withColumn("fingerprint", fingerprint(F.col("title"), F.col("content")))
    return hashed.filter(is_valid(F.col("title"), F.col("content")))


class ArticleStore:
    """Continuous ingest of landed articles into a table that never holds a content hash twice.

    A batch writes its own folder and looks its hashes up in a store of hashes that opens only what the batch may hit, so
    replaying a batch after a failure gives the same table. Each feed (a landing folder) has its checkpoint in the store: a later
    ingest of the feed numbers its batches on, and files that were taken before are not taken again. Feeds are ingested one
    after the other.
    """

    def __init__(self, spark: SparkSession, base: str, rows_per_prefix: int = ROWS_PER_PREFIX, fan: int = FAN) -> None:
        self.spark, self.base = spark, base
        self.hashes = HashStore(spark, f"{base}/_hashes", rows_per_prefix, fan)
        spark.createDataFrame([], STORED).coalesce(1).write.mode("append").partitionBy("feed", "batch").parquet(base)

    def read(self) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(self.base)

    def add(self, batch: DataFrame, batch_id: int, feed: str = "landing") -> None:
        """Takes a batch of landed articles; of equal ones the smallest id stays."""
        self._keep(_hashed(batch), batch_id, feed)

    def _keep(self, hashed: DataFrame, batch_id: int, feed: str) -> None:
        self.hashes.compact()
        arriving = f"arriving/{feed}-{batch_id}"
        keep_first(hashed, ["fingerprint"], [F.col("id")]).write.mode("overwrite").parquet(f"{self.hashes.base}/{arriving}")
        rows = self.spark.read.schema(hashed.schema).parquet(f"{self.hashes.base}/{arriving}")
        fresh = rows.join(self.hashes.known(rows, feed, batch_id), "fingerprint", "left_anti")
        fresh.write.mode("overwrite").parquet(f"{self.base}/feed={feed}/batch={batch_id}")
        written = self.spark.read.schema(STORED).parquet(f"{self.base}/feed={feed}/batch={batch_id}")
        self.hashes.put(written, feed, batch_id)
        self.hashes.drop(arriving)

    def ingest(self, stream: DataFrame, feed: str = "landing", recent: str | None = None) -> DataFrame:
        """Takes what is new in a feed; ``feed`` is letters, digits, ``-`` and ``_``, one name for each landing folder.

        With ``recent`` (such as ``1 day``) copies that arrive within that time of the first are dropped in the stream's state,
        before they reach the store. The time is that of arrival, so no article is ever late; of copies that arrive
        together any may then be the first.
        """
        if not re.fullmatch(r"[A-Za-z0-9_-]+", feed):
            raise ValueError(f"not a feed name: {feed!r}")
        rows = _hashed(stream)
        if recent:
            arrived = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", recent)
            rows = arrived.dropDuplicatesWithinWatermark(["fingerprint"]).drop("_arrived")
        run_batches(rows, f"{self.base}/_checkpoint/{feed}", lambda batch, number: self._keep(batch, number, feed))
        return self.read()


def drift_by(cells: DataFrame, *by: str) -> DataFrame:
    """Drift measures per bucket from counts per bucket, sentiment and topic."""
    n = F.col("n").cast("double")
    labels = cells.groupBy(*by, "sentiment").agg(F.sum("n").alias("n")).groupBy(*by).agg(
        F.sum("n").alias("rows"), F.count("*").alias("classes"), (F.log2(F.sum(n)) - F.sum(n * F.log2(n)) / F.sum(n)).alias("bits")
    )
    topics = cells.filter(F.col("topic_1").isNotNull()).groupBy(*by, "topic_1").agg(F.sum("n").alias("n"))
    top = topics.groupBy(*by).agg(F.max("n").alias("top"))
    measures = drift_score(F.col("rows"), F.col("classes"), F.col("bits"), F.col("top"))
    return labels.join(top, list(by), "left").select(*by, *measures).withColumn("alert", F.col("drift_score") > DRIFT_LIMIT)


def drift_stream(stream: DataFrame, every: str = "1 day", time: str = "ts") -> DataFrame:
    """Drift per time bucket: the stream counts cells, each closed bucket is scored in its batch."""
    spark = stream.sparkSession
    target = new_path(spark, "drift")
    cells = (
        stream.withWatermark(time, LATENESS)
        .groupBy(F.window(time, every), F.coalesce("sentiment", F.lit("inconnu")).alias("sentiment"), "topic_1")
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), "sentiment", "topic_1", "n")
    )

    def score(batch: DataFrame, batch_id: int) -> None:
        drift_by(batch, "window_start").write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    run_batches(cells, new_path(cells.sparkSession, "drift-checkpoint"), score)
    return spark.read.parquet(target).drop("batch")


def late_rows(stream: DataFrame, time: str = "ts", lateness: str = LATENESS) -> tuple[DataFrame, DataFrame]:
    """(batches, late): per batch its rows, newest time and number of late rows; and the late rows themselves, with their batch.

    A row is late if it is older than the watermark that held when its batch began, so a windowed rule no longer counts it.
    Replaying a batch writes the same files again.
    """
    spark = stream.sparkSession
    target, side = new_path(spark, "batches"), new_path(spark, "late")
    schema, late_schema = "batch_id bigint, rows bigint, newest timestamp, late bigint", StructType([*stream.schema.fields, StructField("batch_id", LongType())])
    for path, kind in ((target, schema), (side, late_schema)):
        spark.createDataFrame([], kind).coalesce(1).write.partitionBy("batch_id").parquet(path)

    def split(batch: DataFrame, batch_id: int) -> None:
        earlier = spark.read.schema(schema).parquet(target).filter(F.col("batch_id") < batch_id)
        mark = earlier.agg(F.max("newest") - F.expr(f"INTERVAL {lateness}")).scalar()
        held = batch.withColumn("_mark", mark)
        behind = held.filter(F.col(time) < F.col("_mark")).drop("_mark")
        behind.write.mode("overwrite").parquet(f"{side}/batch_id={batch_id}")
        counted = held.agg(F.count("*").alias("rows"), F.max(time).alias("newest"), F.count_if(F.col(time) < F.col("_mark")).alias("late"))
        counted.coalesce(1).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    run_batches(stream, new_path(spark, "late-checkpoint"), split)
    return spark.read.schema(schema).parquet(target), spark.read.schema(late_schema).parquet(side)
