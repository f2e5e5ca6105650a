"""Training datasets: labels, dedup, splits, sampling, rebalancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.labels import CLASSES, POSITIVE, normalize_label, strict_label
from opinara.functions.text import cut, filled, or_empty, strip, usable_id
from opinara.operators.filters import assert_labelled
from opinara.operators.skew import boundary_rows, keep_first, top_per_group, up_to

# Split shares, class numbers.
TRAIN_SHARE, VALIDATION_SHARE = 0.8, 0.1
LABEL_IDS = {label: place for place, label in enumerate(CLASSES)}


def ia_labelled(df: DataFrame) -> DataFrame:
    """Training branch: ``sentiment_label`` in three classes, ``sentiment`` kept beside it."""
    if "sentiment_label" in df.columns:
        result = df.withColumn("sentiment_label", normalize_label(F.col("sentiment_label")))
        if "sentiment" not in df.columns:
            result = result.withColumn("sentiment", F.col("sentiment_label"))
    elif "sentiment" in df.columns:
        result = df.withColumn("sentiment", normalize_label(F.col("sentiment")))
        result = result.withColumn("sentiment_label", F.col("sentiment"))
    else:
        raise ValueError("neither sentiment nor sentiment_label is present")
    assert_labelled(result.columns)
    return result


def model_texts(df: DataFrame, title_width: int | None = None, content_width: int | None = None) -> DataFrame:
    """(id, title, text) for a model: first usable id, title and content joined, blank texts dropped."""
    title, content = (or_empty(F.col(c).cast("string")) for c in ("title", "content"))
    rows = df.select(
        usable_id(df).alias("id"),
        cut(title, title_width).alias("title"),
        strip(F.concat(cut(title, title_width), F.lit(" "), cut(content, content_width))).alias("text"),
    )
    return rows.filter(F.col("text") != "")


def split_dedup(df: DataFrame, unique: str = "id", text: str = "content") -> DataFrame:
    """First row per hash, then per url, then per text; rows with a blank hash or url pass that step.

    Blank keys are replaced by the row's own id, so they neither collapse nor meet in one task. Rows that passed a step
    with a blank key come after the others in the next one. The steps see the id, the keys and a digest of the text; the whole
    rows are met once, by the ids that are left (``unique`` has no nulls and no repeats).
    """
    own = F.concat(F.lit("\x00"), F.col(unique).cast("string"))
    order: list[Column] = [F.col(unique)]
    rows = df.select(unique, filled(F.col("fingerprint")).alias("fingerprint"), filled(F.col("url")).alias("url"), F.sha2(or_empty(F.col(text)), 256).alias("_text"))
    for column in ("fingerprint", "url"):
        rows = keep_first(rows.withColumn("_key", F.coalesce(column, own)), ["_key"], order).drop("_key")
        order = [F.col(column).isNull(), *order]
    return df.join(keep_first(rows, ["_text"], order).select(unique), unique, "left_semi")


def hash_order(unique: str, seed: int) -> Column:
    """Reproducible pseudo-random sort key of a row."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(unique).cast("string")))


def ordered_split(df: DataFrame, key: Column, unique: str, train: float = TRAIN_SHARE, validation: float = VALIDATION_SHARE) -> DataFrame:
    """Adds ``split`` by exact position in the order of ``key``: truncated shares, the remainder is the test set.

    The last row of train and of validation are selected by rank, without sorting, and come back as one row; the wide rows are
    labelled by comparing with it, without a shuffle of their own.
    """
    first = F.floor(F.col("n") * train)
    ranks = {"train": first, "validation": first + F.floor(F.col("n") * validation)}
    bounds = boundary_rows(df, key, unique, ranks, n=F.count("*"))
    within = lambda name: up_to(key, unique, F.col(f"_bounds.{name}"))
    return (
        df.withColumn("_bounds", bounds.select(F.struct("train", "validation")).scalar())
        .withColumn("split", F.when(within("train"), "train").when(within("validation"), "val").otherwise("test"))
        .drop("_bounds")
    )


def temporal_split(df: DataFrame, time: str = "collected_at", unique: str = "id", **shares: float) -> DataFrame:
    """Oldest rows train, newest test; rows without a time come last."""
    return ordered_split(df, F.col(time), unique, **shares)


def random_split(df: DataFrame, unique: str = "id", seed: int = 42, **shares: float) -> DataFrame:
    return ordered_split(df, hash_order(unique, seed), unique, **shares)


def split_leakage(split: DataFrame, keys: tuple[str, ...] = ("fingerprint", "url", "content")) -> DataFrame:
    """Keys shared by two splits, per key column; each key is reduced to three marks before anything is compared."""
    reports = []
    for key in keys:
        marks = split.filter(filled(F.col(key)).isNotNull()).groupBy(F.sha2(key, 256)).agg(
            *[F.max(F.when(F.col("split") == s, 1).otherwise(0)).alias(s) for s in ("train", "val", "test")]
        )
        pairs = {"train_val": ("train", "val"), "train_test": ("train", "test"), "val_test": ("val", "test")}
        reports.append(
            marks.agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).alias(n) for n, (a, b) in pairs.items()]).select(
                F.lit(key).alias("key"), *pairs
            )
        )
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def rebalance(df: DataFrame, target: float, max_multiplier: float, label: str = "label", unique: str = "id", seed: int = 42) -> DataFrame:
    """Copies positive rows until they reach ``target`` of all rows, at most ``max_multiplier`` times their number.

    Every positive row gets the same number of copies; the remainder goes to the first rows in hash order, so exactly
    the computed number is added. ``copy`` is 0 for the original.
    """
    if not 0 < target < 1 or max_multiplier <= 1:
        return df.withColumn("copy", F.lit(0))
    positive = F.col(label) == POSITIVE
    wanted = F.ceil((F.lit(target) * F.col("n") - F.col("p")) / F.lit(1 - target))
    allowed = F.floor(F.lit(max_multiplier - 1.0) * F.col("p"))
    extra = F.greatest(F.least(wanted, allowed), F.lit(0))
    plan = df.agg(F.count("*").alias("n"), F.count_if(positive).alias("p")).select(extra.alias("extra"), "p")
    order = hash_order(unique, seed)
    # The sizes ride on the positive rows as one value, so that the rank can be an expression over them.
    sized = df.filter(positive).select(unique).withColumn("_plan", plan.select(F.struct("extra", "p")).scalar())
    remainder = F.when(F.col("plan.p") > 0, F.col("plan.extra") % F.col("plan.p")).otherwise(0)
    last = boundary_rows(sized, order, unique, {"last": remainder}, plan=F.max("_plan"))
    even = F.when(F.col("_plan.p") > 0, F.floor(F.col("_plan.extra") / F.col("_plan.p"))).otherwise(0)
    copies = F.when(positive, even + F.coalesce(up_to(order, unique, F.col("_last")).cast("int"), F.lit(0))).otherwise(0)
    return (
        df.withColumns({"_plan": plan.select(F.struct("extra", "p")).scalar(), "_last": last.scalar()})
        .withColumn("copy", F.explode_outer(F.sequence(F.lit(0), copies.cast("int"))))
        .drop("_plan", "_last")
    )


def training_rows(df: DataFrame, width: int | None = None) -> DataFrame:
    """(id, text, label) for training; unknown labels and blank texts are dropped."""
    label = strict_label(F.col("sentiment"))
    number = F.lit(None).cast("int")
    for name, value in LABEL_IDS.items():
        number = F.when(label == name, value).otherwise(number)
    text = cut(strip(F.concat(or_empty(F.col("title")), F.lit(" "), or_empty(F.col("content")))), width)
    return df.select("id", text.alias("text"), number.alias("label")).filter((F.col("text") != "") & F.col("label").isNotNull())


def balanced_sample(df: DataFrame, per_class: int, label: str = "label", unique: str = "id", seed: int = 42) -> DataFrame:
    """The same number of rows of each class, in reproducible random order; all rows when ``per_class`` is not positive."""
    if per_class <= 0:
        return df
    return top_per_group(df, [label], [hash_order(unique, seed), F.col(unique)], per_class, unique)


def quality_filter(df: DataFrame, quality: Column, minimum: float = 0.5, unique: str = "id") -> DataFrame:
    """First row per hash with enough completeness."""
    scored = df.withColumn("quality", quality)
    return keep_first(scored, ["fingerprint"], [F.col(unique)]).filter(F.col("quality") >= minimum)
