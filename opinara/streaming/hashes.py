"""Content hashes already stored, for continuous dedup.

The hashes of a batch are one small sorted *layer*. Every ``fan`` committed layers are merged into one of the next level, whose
folders are named by the first hex digits of the hash; a bigger layer takes more digits, so that a folder holds about
``rows_per_prefix`` hashes at any size. A batch opens only the folders that its own hashes begin with, in at most ``fan`` layers a
level. So what it reads follows its own size and, through the number of levels, the logarithm of the store's.

A batch that is replayed does not see its own hashes: layers are named by feed and batch, and only batches that a later one of their
feed has followed are merged. The list of layers is a numbered file that must not exist before; a merge that fails leaves the
last list in force, and of two writers from one list the second fails.
"""

from __future__ import annotations

import json
import math
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_PREFIX, FAN = 1 << 20, 8
#: Up to so many prefixes are named in a scan; a batch with more opens the whole layer, most of which it needs anyway.
NAMED_PREFIXES = 4096
_DIGITS = 16


class HashStore:
    """Hashes below a folder; one writer at a time."""

    def __init__(self, spark: SparkSession, base: str, rows_per_prefix: int = ROWS_PER_PREFIX, fan: int = FAN) -> None:
        self.spark, self.base, self.rows_per_prefix, self.fan = spark, base, rows_per_prefix, fan

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, pattern: str, depth: int = 1) -> list[str]:
        """Paths below the base that match a pattern, by their last ``depth`` parts."""
        path, files = self._path(pattern)
        return ["/".join(s.getPath().toString().split("/")[-depth:]) for s in files.globStatus(path) or []]

    def drop(self, name: str) -> None:
        path, files = self._path(name)
        files.delete(path, True)

    def _listed(self) -> dict:
        """Merged layers, and the last batch of each feed that is in one."""
        versions = self._names("lists/*")
        if not versions:
            return {"version": 0, "layers": [], "merged": {}}
        return json.loads(self.spark.read.text(f"{self.base}/lists/{max(versions)}").first().value)

    def _publish(self, listed: dict) -> None:
        path, files = self._path(f"lists/{listed['version']:012d}")
        draft, _ = self._path(f"drafts/{listed['version']:012d}-{listed['layers'][-1]['folder'].split('/')[-1]}")
        out = files.create(draft, False)
        out.write(bytearray((json.dumps(listed) + "\n").encode()))
        out.close()
        files.mkdirs(path.getParent())
        if files.exists(path) or not files.rename(draft, path):  # a list is whole or not there
            raise RuntimeError(f"list {listed['version']} was published by another writer")

    def _arrived(self, merged: dict[str, int]) -> list[tuple[str, int]]:
        """Feed and number of the batches that are layers of their own."""
        found = [tuple(part.split("=")[1] for part in name.split("/")) for name in self._names("batches/feed=*/batch=*", 2)]
        return sorted((feed, int(batch)) for feed, batch in found if int(batch) > merged.get(feed, -1))

    def _scan(self, folders: list[str]) -> DataFrame:
        schema = "fingerprint binary"
        paths = [f"{self.base}/{f}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _layer(self, layer: dict) -> DataFrame:
        return self.spark.read.schema("fingerprint binary, prefix string").parquet(f"{self.base}/{layer['folder']}")

    def known(self, rows: DataFrame, feed: str, batch: int) -> DataFrame:
        """Stored hashes that may be among those of ``rows`` (hex digits in ``fingerprint``), but for the batch's own."""
        listed = self._listed()
        others = [f"batches/feed={f}/batch={b}" for f, b in self._arrived(listed["merged"]) if (f, b) != (feed, batch)]
        parts = [self._scan(others)]
        for digits in sorted({layer["digits"] for layer in listed["layers"]}):
            begins = rows.select(F.substring(F.lower("fingerprint"), 1, digits).alias("p")).distinct().limit(NAMED_PREFIXES + 1).collect()
            for layer in (x for x in listed["layers"] if x["digits"] == digits):
                stored = self._layer(layer)
                if len(begins) <= NAMED_PREFIXES:
                    stored = stored.filter(F.col("prefix").isin([r.p for r in begins]))
                parts.append(stored.select("fingerprint"))
        return reduce(DataFrame.union, parts).select(F.lower(F.hex("fingerprint")).alias("fingerprint"))

    def put(self, rows: DataFrame, feed: str, batch: int) -> None:
        """Stores the hashes of a batch in place of what an earlier try of it left."""
        hashes = rows.select(F.unhex("fingerprint").alias("fingerprint")).sortWithinPartitions("fingerprint")
        hashes.write.mode("overwrite").parquet(f"{self.base}/batches/feed={feed}/batch={batch}")

    def _merge(self, parts: DataFrame, level: int, name: str) -> dict:
        rows = parts.count()
        digits = min(_DIGITS, max(1, math.ceil(math.log(max(rows, 1) / self.rows_per_prefix, 16)))) if rows else 1
        keyed = parts.withColumn("prefix", F.substring(F.lower(F.hex("fingerprint")), 1, digits))
        folder = f"layers/{name}"
        spread = keyed.hint("rebalance", F.col("prefix")).sortWithinPartitions("prefix", "fingerprint")
        spread.write.mode("overwrite").partitionBy("prefix").parquet(f"{self.base}/{folder}")
        return {"folder": folder, "level": level, "digits": digits, "rows": rows}

    def compact(self) -> None:
        """Merges committed batches, and full levels, if there are ``fan`` of them."""
        listed = self._listed()
        arrived = self._arrived(listed["merged"])
        newest = dict(arrived)
        ready = [(f, b) for f, b in arrived if b < newest[f]]
        if len(ready) < self.fan:
            return
        version, gone = listed["version"] + 1, [f"batches/feed={f}/batch={b}" for f, b in ready]
        layers = [*listed["layers"], self._merge(self._scan(gone), 1, f"{version:012d}-1")]
        while len(full := [x for x in layers if x["level"] == layers[-1]["level"]]) >= self.fan:
            level = full[0]["level"] + 1
            parts = reduce(DataFrame.union, [self._layer(x).select("fingerprint") for x in full])
            gone += [x["folder"] for x in full]
            layers = [*(x for x in layers if x not in full), self._merge(parts, level, f"{version:012d}-{level}")]
        self._publish({"version": version, "layers": layers, "merged": {**listed["merged"], **dict(ready)}})
        for name in gone:  # no list names them any more
            self.drop(name)
