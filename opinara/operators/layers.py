"""SILVER, GOLD and merged layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.labels import NEUTRAL
from opinara.functions.text import source_type, stable_id
from opinara.operators.skew import drop_copies, keep_first

KEYWORD_MODEL = "sentiment_keyword"


def with_source(raw: DataFrame, source: DataFrame) -> DataFrame:
    """Stored articles with the facts of their source; the registry is small and Spark's size check picks the join."""
    return raw.join(source, "source_id")


def local_rows_appended(stored: DataFrame, local: DataFrame) -> DataFrame:
    """RAW layer: stored rows plus rows found in landed files, with the defaults of an unstored row.

    Local rows carry no id; they get one from their content hash, disjoint from stored ids by its sign.
    """
    defaults = {
        "id": -F.abs(F.xxhash64("source", "title", "content", "url")) - 1,
        "fingerprint": F.lit(""),
        "quality_score": F.lit(0.5),
        "is_synthetic": F.lit(False),
        "source_type": source_type(F.col("source")),
        "collected_at": F.lit(None).cast("timestamp"),
    }
    return stored.unionByName(local.withColumns(defaults), allowMissingColumns=True)


def topic_rank(links: DataFrame) -> DataFrame:
    """Rank of each topic inside its article, best first; an article has a handful of topics."""
    order = Window.partitionBy("raw_data_id").orderBy(F.desc("confidence_score"), F.col("doc_topic_id"))
    return links.withColumn("rank", F.row_number().over(order))


def best_two_topics(links: DataFrame) -> DataFrame:
    """topic_1 and topic_2 per article in one aggregate instead of two joins on ranked rows."""
    entry = F.struct(
        (-F.col("confidence_score")).alias("neg_score"),
        "doc_topic_id",
        F.col("topic").alias("name"),
        F.col("confidence_score").alias("score"),
    )
    ranked = links.groupBy(F.col("raw_data_id").alias("id")).agg(F.array_sort(F.collect_list(entry)).alias("_t"))

    def part(place: int, field: str) -> Column:
        return F.get("_t", F.lit(place))[field]

    return ranked.select(
        "id",
        part(0, "name").alias("topic_1"),
        part(0, "score").alias("topic_1_score"),
        part(1, "name").alias("topic_2"),
        part(1, "score").alias("topic_2_score"),
    )


def _hashed(narrow: DataFrame) -> DataFrame:
    """The few columns that whole texts are joined with: a hash table of each part, so the texts are shuffled but never sorted."""
    return narrow.hint("shuffle_hash")


def silver(raw: DataFrame, links: DataFrame) -> DataFrame:
    """RAW plus the two best topics; a missing topic is empty with score 0."""
    return raw.join(_hashed(best_two_topics(links)), "id", "left").na.fill(
        {"topic_1": "", "topic_2": "", "topic_1_score": 0.0, "topic_2_score": 0.0}
    )


def latest_output(outputs: DataFrame, model: str = KEYWORD_MODEL) -> DataFrame:
    """Newest output per article of one model, as a map-side combining aggregate rather than a window."""
    newest = F.max(F.struct("output_id", "label", "score")).alias("_o")
    return (
        outputs.filter(F.col("model_name") == model)
        .groupBy(F.col("raw_data_id").alias("id"))
        .agg(newest)
        .select("id", F.col("_o.label").alias("sentiment"), F.col("_o.score").alias("sentiment_score"))
    )


def gold(silver_layer: DataFrame, outputs: DataFrame) -> DataFrame:
    """SILVER plus the latest keyword sentiment; an unscored article is neutral with 0.5."""
    return silver_layer.join(_hashed(latest_output(outputs)), "id", "left").na.fill(
        {"sentiment": NEUTRAL, "sentiment_score": 0.5}
    )


def gold_wide(raw: DataFrame, links: DataFrame, outputs: DataFrame) -> DataFrame:
    """Raw rows with topics joined by a bar in score order, last output of any model and the partition date."""
    entry = F.struct((-F.col("confidence_score")).alias("neg_score"), "doc_topic_id", "topic")
    joined = links.groupBy(F.col("raw_data_id").alias("id")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda t: t["topic"]), "|").alias("topics")
    )
    last = outputs.groupBy(F.col("raw_data_id").alias("id")).agg(
        F.max(F.struct("output_id", "model_name", "label", "score")).alias("_o")
    )
    return (
        raw.join(joined, "id", "left")
        .join(last, "id", "left")
        .withColumns(
            {
                "model_name": F.col("_o.model_name"),
                "label": F.col("_o.label"),
                "score": F.col("_o.score"),
                "partition_date": F.date_format("collected_at", "yyyy-MM-dd"),
            }
        )
        .drop("_o")
    )


def union_layers(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing on one side is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def harmonize_id(df: DataFrame) -> DataFrame:
    """``id`` becomes the first non-blank of fingerprint, url, title and id."""
    return df.withColumn("id", stable_id(df))


def parsed_time(value: Column) -> Column:
    """Timestamp of ISO or plain text; unreadable text is null."""
    text = value.cast("string")
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(text)
    )


def _newest(unique: str) -> list[Column]:
    return [F.desc_nulls_last(parsed_time(F.col("collected_at"))), F.desc_nulls_last("date"), F.desc_nulls_last(unique)]


def _merge_key(unique: str) -> Column:
    """The id; a null one is replaced by a value of its own row, so those rows spread over the cluster."""
    return F.coalesce("id", F.concat(F.lit("\x00"), F.col(unique).cast("string")))


def merge_dedup(df: DataFrame, newest: list[Column] | None = None, unique: str = "raw_id") -> DataFrame:
    """Newest row per stable id; rows without an id are all kept."""
    return keep_first(df.withColumn("_key", _merge_key(unique)), ["_key"], newest or _newest(unique)).drop("_key")


def merge_dedup_wide(df: DataFrame, row: str, unique: str = "raw_id") -> DataFrame:
    """The same for a written table of whole texts, whose rows are numbered by ``row``; the texts are not shuffled for it."""
    return drop_copies(df, [_merge_key(unique)], _newest(unique), row)


def overtaken(before: DataFrame, arriving: DataFrame, unique: str = "raw_id") -> DataFrame:
    """(id, arrived) of the older row of each id that both tables hold; an id stands once in each."""
    columns = ["id", "collected_at", "date", unique]
    sides = [df.filter("id IS NOT NULL").select(*columns, F.lit(new).alias("arrived")) for df, new in ((before, False), (arriving, True))]
    rank = F.row_number().over(Window.partitionBy("id").orderBy(*_newest(unique), F.desc("arrived")))
    return union_layers(*sides).withColumn("_rank", rank).filter("_rank > 1").select("id", "arrived")


def new_dates(available: DataFrame, merged: DataFrame) -> DataFrame:
    """Dates of the layer that the merged table does not hold yet."""
    return available.select("date").distinct().join(merged.select("date").distinct(), "date", "left_anti")


def new_rows(gold_rows: DataFrame, merged: DataFrame) -> DataFrame:
    """Rows whose stable id is absent from the merged table; rows without an id are left out."""
    keyed = harmonize_id(gold_rows).filter(F.col("id").isNotNull())
    return keyed.join(merged.select("id"), "id", "left_anti")


def merge_overlap(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct ids on both sides and how many are shared, from one aggregate per id."""
    sides = new.select("id", F.lit(1).alias("n"), F.lit(0).alias("e")).unionByName(
        existing.select("id", F.lit(0).alias("n"), F.lit(1).alias("e"))
    )
    per_id = sides.filter(F.col("id").isNotNull()).groupBy("id").agg(F.max("n").alias("n"), F.max("e").alias("e"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("new_ids"),
        F.coalesce(F.sum("e"), F.lit(0)).alias("existing_ids"),
        F.coalesce(F.sum(F.col("n") * F.col("e")), F.lit(0)).alias("shared_ids"),
    )


def above_last_exported(df: DataFrame, exported: DataFrame) -> DataFrame:
    """Rows with an id above the largest exported one; everything when nothing was exported."""
    last = exported.agg(F.max("id")).scalar()
    return df.filter(F.col("id") > F.coalesce(last, F.lit(-(2**63))))
