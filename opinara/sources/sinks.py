"""Writers of landing files, layers, predictions and manifests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.sources.layers import keep_schema
from opinara.storage import stage

# Columns of the context export and the synthetic sources that get a partition of their own.
CONTEXT_COLUMNS = (
    "title", "content", "predicted_sentiment", "confidence", "p_pos", "p_neu", "p_neg", "topic_1", "source", "published_at",
)
SYNTHETIC_SOURCES = ("zzdb_synthetic", "zzdb_csv")


def by_date(df: DataFrame, *columns: str) -> DataFrame:
    """Rows gathered by partition value before a write; the rebalance hint lets Spark split a hot date and join small ones."""
    return df.hint("rebalance", *[F.col(c) for c in ("date", *columns)])


def write_landing(articles: DataFrame, base: str) -> None:
    """Every cleaned row, copies included, as JSON and as CSV below its date; only the dates present are replaced."""
    rows = by_date(stage(articles, "landing"))  # written once, so that the formats do not run the plan once each
    dynamic = {"partitionOverwriteMode": "dynamic"}
    rows.write.mode("overwrite").options(**dynamic).partitionBy("date").json(f"{base}/json")
    rows.write.mode("overwrite").options(**dynamic, header=True, escape='"').partitionBy("date").csv(f"{base}/csv")


def write_silver(silver: DataFrame, base: str) -> None:
    """Parquet and CSV by date; only the dates present are replaced, so an empty frame changes nothing."""
    rows = by_date(stage(silver, "silver"))
    dynamic = {"partitionOverwriteMode": "dynamic"}
    rows.write.mode("overwrite").options(**dynamic).partitionBy("date").parquet(f"{base}/parquet")
    keep_schema(silver.sparkSession, f"{base}/parquet", silver.schema)
    rows.write.mode("overwrite").options(**dynamic, header=True, escape='"').partitionBy("date").csv(f"{base}/csv")


def write_gold(gold: DataFrame, base: str) -> None:
    """All rows by date, and the synthetic sources once more by date and source."""
    dynamic = {"partitionOverwriteMode": "dynamic"}
    gold = stage(gold, "gold")
    by_date(gold).write.mode("overwrite").options(**dynamic).partitionBy("date").parquet(f"{base}/all")
    keep_schema(gold.sparkSession, f"{base}/all", gold.schema)
    synthetic = gold.filter(F.col("source").isin(*SYNTHETIC_SOURCES))
    by_date(synthetic, "source").write.mode("overwrite").options(**dynamic).partitionBy("date", "source").parquet(
        f"{base}/synthetic"
    )


def write_predictions(predictions: DataFrame, base: str) -> None:
    by_date(predictions, "run").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "date", "run"
    ).parquet(base)


def write_context(predictions: DataFrame, base: str) -> None:
    """The context columns that are present, one JSON record per line."""
    kept = [c for c in CONTEXT_COLUMNS if c in predictions.columns]
    predictions.select(*kept).write.mode("overwrite").json(base)


def table_counts(tables: dict[str, DataFrame], base: str | None = None) -> DataFrame:
    """Snapshot of every table as CSV when a folder is given, and its rows."""
    counts = []
    for name, df in tables.items():
        if base:
            df.write.mode("overwrite").option("header", True).csv(f"{base}/{name}")
        counts.append(df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows"))
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


WHOLE_BYTES = 32 << 20  # of a file that is hashed as one value
ZIPPED = r"(?i)\.(gz|bz2|deflate|snappy|lz4|zst|passthrough)$"  # names whose lines Spark would unpack
UNSPLIT = {"spark.sql.files.maxPartitionBytes": str(1 << 42), "spark.sql.files.openCostInBytes": str(1 << 42)}
MARK = b"\xef\xbb\xbf"


def archive_manifest(spark: SparkSession, folder: str, known: DataFrame | None = None, pattern: str = "*", whole: int = WHOLE_BYTES) -> DataFrame:
    """Files not archived yet: hash, logical name, size and time; ``known`` is the manifest so far.

    Files of more than ``whole`` bytes pass through their task line by line, so its memory follows the longest line (what stands
    between two bytes 0x0A), not the file. Large files with a name of ``ZIPPED`` are read whole.
    """
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": True}
    files = spark.read.format("binaryFile").options(**options).load(folder)
    large, zipped = F.col("length") > whole, F.expr("_metadata.file_name").rlike(ZIPPED)
    hashed = [files.filter(~large).withColumn("sha256", F.sha2("content", 256))]
    if not files.filter(large).select("path").isEmpty():
        listed = files.withColumn("file", F.expr("_metadata.file_path")).drop("content").filter(large & ~zipped)
        lines = spark.read.format("text").options(**options, lineSep="\n").load(folder)
        digests = _unsplit(lines.filter((F.expr("_metadata.file_size") > whole) & ~zipped))
        hashed += [files.filter(large & zipped).withColumn("sha256", F.sha2("content", 256)), listed.join(digests, "file")]
    rows = [
        part.select(
            "sha256",
            F.regexp_extract("path", r"([^/]+)$", 1).alias("logical_name"),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
        for part in hashed
    ]
    listed = reduce(DataFrame.unionByName, rows)
    return listed if known is None else listed.join(known.select("sha256", "logical_name"), ["sha256", "logical_name"], "left_anti")


def _unsplit(lines: DataFrame) -> DataFrame:
    """file and sha256 of every file of a text scan, written; a file is one task's, as a digest is one stream."""
    conf = lines.sparkSession.conf
    before = {k: conf.get(k) for k in UNSPLIT}
    try:
        for k, v in UNSPLIT.items():
            conf.set(k, v)
        line = F.concat(F.unhex(F.lit("0A")), F.col("value").cast("binary"))
        rows = lines.select(F.expr("_metadata.file_path").alias("file"), F.expr("_metadata.file_size").alias("size"), line.alias("line"))
        return stage(rows.mapInArrow(_digests, "file string, sha256 string"), "digests")
    finally:
        for k, v in before.items():
            conf.set(k, v)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    file, size, seen, digests = None, 0, 0, []

    def digest() -> pa.RecordBatch:
        # Spark drops the last line end and a byte order mark; the size tells whether they were there.
        if size - seen not in (0, 1, 3, 4):
            raise ValueError(f"{seen} of {size} bytes of {file} were read")
        found = digests[size - seen > 1]
        found.update(b"\n" * ((size - seen) % 3))
        return pa.RecordBatch.from_pydict({"file": [file], "sha256": [found.hexdigest()]})

    for batch in batches:
        runs, begin = pc.run_end_encode(batch["file"]), 0
        for end, name in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
            data = b"".join(batch["line"].slice(begin, end - begin).to_pylist())
            if name != file:
                if file is not None:
                    yield digest()
                file, size, seen, digests = name, batch["size"][begin].as_py(), 0, [hashlib.sha256(), hashlib.sha256(MARK)]
                data = data[1:]
            for one in digests:
                one.update(data)
            seen, begin = seen + len(data), end
    if file is not None:
        yield digest()
