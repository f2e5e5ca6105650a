"""Reading date-partitioned layers.

Dates are the names of a layer's folders, so listing one folder tells them and no file is opened. The columns of all dates are
kept beside the layer by its writers (``_schema``); a scan then opens only the files of the dates it asks for. A layer without
that file, written elsewhere, has its columns gathered from its files.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructField, StructType

PREFIX, SCHEMA_FILE = "date=", "_schema"


class NoSuchPartition(ValueError):
    """The layer has no partition for the requested dates."""


def _file(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def dates_of(spark: SparkSession, base: str) -> dict[dt.date, str]:
    """Dates of a layer, ascending, with their folders; folders not named like a date are ignored."""
    path, files = _file(spark, base)
    found = {}
    for status in files.listStatus(path) if files.exists(path) else ():
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(PREFIX):
            try:
                found[dt.date.fromisoformat(name.removeprefix(PREFIX))] = f"{base}/{name}"
            except ValueError:
                continue
    return dict(sorted(found.items()))


def _kept_schema(spark: SparkSession, base: str) -> StructType | None:
    path, files = _file(spark, f"{base}/{SCHEMA_FILE}")
    if not files.exists(path):
        return None
    stream = files.open(path)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return StructType.fromJson(json.loads(text))


def keep_schema(spark: SparkSession, base: str, schema: StructType) -> None:
    """Adds the columns of what was written to those of the layer. A column's first type stays."""
    kept = _kept_schema(spark, base)
    known = list(kept.fields) if kept else []
    names = {f.name for f in known}
    more = [f for f in schema.fields if f.name not in names and f.name != "date"]
    if kept is None or more:
        path, files = _file(spark, f"{base}/{SCHEMA_FILE}")
        out = files.create(path, True)
        out.write(bytearray(json.dumps(StructType([*known, *more]).jsonValue()).encode()))
        out.close()


def _read(spark: SparkSession, base: str, folders: list[str], every: list[str]) -> DataFrame:
    reader = spark.read.option("basePath", base)
    kept = _kept_schema(spark, base) or reader.option("mergeSchema", "true").parquet(*every).schema
    day = StructField("date", DateType())
    schema = StructType([*[f for f in kept.fields if f.name != "date"], day])
    return spark.read.option("basePath", base).schema(schema).parquet(*folders)


def read_layer(spark: SparkSession, base: str) -> DataFrame:
    """Every date partition, with the columns of all dates."""
    folders = list(dates_of(spark, base).values())
    if not folders:
        raise NoSuchPartition(f"{base}: no partition")
    return _read(spark, base, folders, folders)


def available_dates(spark: SparkSession, base: str) -> DataFrame:
    """Partition dates, ascending, from the names of the folders."""
    return spark.createDataFrame([(day,) for day in dates_of(spark, base)], "date date").coalesce(1)


def read_date(spark: SparkSession, base: str, day: str) -> DataFrame:
    return read_range(spark, base, day, day)


def read_range(spark: SparkSession, base: str, first: str, last: str) -> DataFrame:
    """Partitions between two dates inclusive; missing days are skipped, no day at all is an error."""
    every = dates_of(spark, base)
    low, high = (dt.date.fromisoformat(d) for d in (first, last))
    folders = [folder for day, folder in every.items() if low <= day <= high]
    if not folders:
        raise NoSuchPartition(f"{base}: no partition from {first} to {last}")
    return _read(spark, base, folders, list(every.values()))


def latest_partition(spark: SparkSession, base: str) -> DataFrame:
    """Rows of the newest date."""
    every = dates_of(spark, base)
    if not every:
        raise NoSuchPartition(f"{base}: no partition")
    return _read(spark, base, [every[max(every)]], list(every.values()))
