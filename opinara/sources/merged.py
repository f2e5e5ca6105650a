"""The all-dates table: rows by stable id in hash buckets, published as numbered versions.

A version is a list of folders per bucket. A merge sends each arriving row to its bucket. A Bloom filter per bucket, itself a table
of bit words, tells which buckets may hold an arriving id: only those are read and written anew, with the newest row per id. In
all others the arriving rows become one more folder, and every file stays as it is. Buckets with many folders are joined into one
when a merge comes by.

A merge writes data, filter, list of folders and metadata under a name of its own and then publishes it by creating the file of the
next version, which must not exist. So a failed job leaves the previous version current, and of two merges from one version the
second fails and changes nothing. The file system must refuse to create an existing file, as HDFS and local disks do.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opinara.operators.layers import harmonize_id, merge_dedup_wide, overtaken, union_layers
from opinara.storage import stage

BUCKETS, BLOOM_BITS, BLOOM_HASHES, MAX_FOLDERS = 16, 1 << 20, 4, 8


class ConcurrentMerge(RuntimeError):
    """Another merge was published since this one began; merge again."""


def bucket_of(buckets: int) -> Column:
    """Bucket of a row; rows without an id spread by their own number."""
    return F.pmod(F.coalesce(F.xxhash64("id"), F.xxhash64("raw_id")), F.lit(buckets)).cast("int")


def bloom_words(rows: DataFrame, bits: int = BLOOM_BITS) -> DataFrame:
    """Filter of the ids of each bucket, as words of 64 bits."""
    at = _bloom_places(rows, bits).groupBy("_bucket", "slot").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    return at.select(F.col("_bucket").alias("bucket"), "slot", "bits")


def _bloom_places(rows: DataFrame, bits: int) -> DataFrame:
    places = F.array(*[F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(bits)) for i in range(BLOOM_HASHES)])
    spots = rows.filter("id IS NOT NULL").select("_bucket", "id", F.explode(places).alias("place"))
    return spots.select("_bucket", "id", F.expr("shiftright(place, 6)").alias("slot"), F.expr("cast(place & 63 AS int)").alias("bit"))


class MergedTable:
    """The table below a folder; the number of buckets is set when it is created."""

    METADATA = (
        "version bigint, dates_included array<date>, total_rows bigint, rows_before bigint, rows_added bigint, null_ids bigint, "
        "last_merge timestamp, buckets_opened int, layout string"
    )
    MANIFEST = "bucket int, folder string, rows bigint, null_ids bigint"

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS, bloom_bits: int = BLOOM_BITS) -> None:
        self.spark, self.base, self.buckets, self.bloom_bits = spark, base, buckets, bloom_bits

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commits(self) -> dict[int, str]:
        """Commit of every published version."""
        path, files = self._path("log")
        if not files.exists(path):
            return {}
        lines = self.spark.read.text(f"{self.base}/log").filter("value <> ''").collect()
        return {int(version): commit for version, commit in (r.value.split() for r in lines)}

    def _publish(self, version: int, commit: str) -> None:
        path, files = self._path(f"log/{version:012d}")
        try:
            out = files.create(path, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                raise ConcurrentMerge(f"version {version} was published by another merge") from error
            raise
        out.write(bytearray(f"{version} {commit}\n".encode()))
        out.close()

    def metadata(self) -> DataFrame:
        """One row per published version; none before the first merge."""
        paths = [f"{self.base}/metadata/{commit}" for commit in self._commits().values()]
        return self.spark.read.schema(self.METADATA).parquet(*paths) if paths else self.spark.createDataFrame([], self.METADATA)

    def version(self) -> int:
        return max(self._commits(), default=0)

    def manifest(self, version: int | None = None) -> list[Row]:
        """Folders of each bucket: at most ``MAX_FOLDERS`` and one for each bucket."""
        commits = self._commits()
        current = max(commits, default=0) if version is None else version
        return self.spark.read.schema(self.MANIFEST).parquet(f"{self.base}/manifest/{commits[current]}").collect() if current else []

    def _layout(self, version: int) -> StructType:
        return StructType.fromJson(json.loads(self.metadata().filter(F.col("version") == version).first().layout))

    def _files(self, folders: list[Row], layout: StructType) -> DataFrame:
        paths = [f"{self.base}/data/{r.folder}/_bucket={r.bucket}" for r in folders]
        return self.spark.read.schema(layout).parquet(*paths) if paths else self.spark.createDataFrame([], layout)

    def read(self, version: int | None = None) -> DataFrame | None:
        current = self.version() if version is None else version
        return self._files(self.manifest(current), self._layout(current)) if current else None

    def pending_dates(self, gold: DataFrame) -> DataFrame:
        """Dates of the layer that no version holds yet."""
        merged = self.metadata().select(F.explode("dates_included").alias("date"))
        return gold.select("date").distinct().join(merged, "date", "left_anti")

    def _opened(self, rows: DataFrame, held: list[Row]) -> set[int]:
        """Buckets that may hold an arriving id, and those with too many folders that get rows."""
        folders: dict[str, list[int]] = {}
        for r in held:
            folders.setdefault(r.folder, []).append(r.bucket)
        parts = [self.spark.read.parquet(f"{self.base}/bloom/{f}").filter(F.col("bucket").isin(b)) for f, b in folders.items()]
        if not parts:
            return set()
        words = union_layers(*parts).groupBy(F.col("bucket").alias("_bucket"), "slot").agg(F.expr("bit_or(bits)").alias("bits"))
        hits = _bloom_places(rows, self.bloom_bits).join(words, ["_bucket", "slot"]).filter("shiftrightunsigned(bits, bit) & 1 = 1")
        whole = hits.groupBy("_bucket", "id").agg(F.count("*").alias("n")).filter(F.col("n") == BLOOM_HASHES)
        opened = {r[0] for r in whole.select("_bucket").distinct().collect()}
        many = {b for b in range(self.buckets) if sum(r.bucket == b for r in held) >= MAX_FOLDERS}
        return opened | (many and many & {r[0] for r in rows.select("_bucket").distinct().collect()})

    def merge(self, gold: DataFrame, force_full: bool = False) -> DataFrame:
        """Adds the new dates (or all of them) and publishes the next version; returns its metadata row."""
        version = self.version()
        held = [] if force_full else self.manifest(version)
        fresh = gold if force_full or not version else gold.join(self.pending_dates(gold), "date", "left_semi")
        arriving = harmonize_id(fresh.withColumn("raw_id", F.col("id"))).withColumn("_bucket", bucket_of(self.buckets))
        arriving = stage(arriving.withColumn("_row", F.monotonically_increasing_id()), "arriving")
        arriving = merge_dedup_wide(arriving, "_row").drop("_row")
        opened = self._opened(arriving, held)

        out = arriving
        if opened:
            before = self._files([r for r in held if r.bucket in opened], self._layout(version))
            again = arriving.filter(F.col("_bucket").isin(*opened)).drop("_bucket")
            older = stage(overtaken(before, again), "overtaken")
            newest = [df.join(older.filter(F.col("arrived") == new).select("id"), "id", "left_anti") for df, new in ((before, False), (again, True))]
            rewritten = union_layers(*newest).withColumn("_bucket", bucket_of(self.buckets))
            out = union_layers(rewritten, arriving.filter(~F.col("_bucket").isin(*opened)))
        commit = uuid.uuid4().hex
        out.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{self.base}/data/{commit}")
        written = self.spark.read.schema(out.schema).parquet(f"{self.base}/data/{commit}")
        bloom_words(written, self.bloom_bits).write.parquet(f"{self.base}/bloom/{commit}")
        sizes = written.groupBy("_bucket").agg(F.count("*").alias("rows"), F.count_if(F.col("id").isNull()).alias("null_ids")).collect()
        folders = [tuple(r) for r in held if r.bucket not in opened] + [(r["_bucket"], commit, r.rows, r.null_ids) for r in sizes]
        self.spark.createDataFrame(folders, self.MANIFEST).coalesce(1).write.parquet(f"{self.base}/manifest/{commit}")

        total, total_before = sum(f[2] for f in folders), sum(r.rows for r in self.manifest(version))
        kept = union_layers(
            gold.select("date").distinct() if force_full or not version else arriving.select("date").distinct(),
            *([] if force_full or not version else [self.metadata().filter(F.col("version") == version).select(F.explode("dates_included").alias("date"))]),
        )
        layout = json.dumps(out.drop("_bucket").schema.jsonValue())
        record = kept.agg(F.array_sort(F.collect_set("date")).alias("dates_included")).select(
            F.lit(version + 1).cast("bigint").alias("version"), "dates_included", F.lit(total).cast("bigint").alias("total_rows"),
            F.lit(total_before).cast("bigint").alias("rows_before"), F.lit(total - total_before).cast("bigint").alias("rows_added"),
            F.lit(sum(f[3] for f in folders)).cast("bigint").alias("null_ids"), F.current_timestamp().alias("last_merge"),
            F.lit(len(opened)).alias("buckets_opened"), F.lit(layout).alias("layout"),
        )
        record.coalesce(1).write.parquet(f"{self.base}/metadata/{commit}")
        self._publish(version + 1, commit)
        return self.metadata().filter(F.col("version") == version + 1)
