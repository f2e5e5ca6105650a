"""Classification reports from grouped counts; rows are reduced to a class-by-class table before any arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.labels import CLASSES, NEUTRAL
from opinara.functions.numbers import one_of, ratio, round_even
from opinara.operators.aggregates import with_share

# Limits of the inference checks and of the model gate.
CONFIDENCE_MEAN_MIN, CONFIDENCE_LOW_MAX = 0.60, 0.20
DOMINANT_MAX, NEUTRAL_MIN = 0.85, 0.03
LATENCY_P90_MS, LATENCY_P99_MS = 260.0, 500.0
GATE = {
    "train_f1_macro": (">=", 0.70),
    "train_accuracy": (">=", 0.65),
    "inference_f1_macro": (">=", 0.65),
    "inference_f1_positive": (">=", 0.55),
    "inference_latency_ms": ("<=", 300.0),
}


def class_counts(pairs: DataFrame) -> DataFrame:
    """Per class: true positives, false positives, false negatives, support and all rows."""
    cells = pairs.groupBy("y_true", "y_pred").agg(F.count("*").alias("n"))
    sides = F.array(F.struct(F.col("y_true").alias("label"), F.lit(1).alias("own")), F.struct(F.col("y_pred").alias("label"), F.lit(0).alias("own")))
    spread = cells.select("n", (F.col("y_true") == F.col("y_pred")).alias("hit"), F.inline(sides))
    own, hit = F.col("own") == 1, F.col("hit")

    def summed(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    per_class = spread.groupBy("label").agg(
        summed(own & hit).alias("tp"), summed(~own & ~hit).alias("fp"), summed(own & ~hit).alias("fn"), summed(own).alias("support")
    )
    return per_class.withColumn("total", cells.agg(F.sum("n")).scalar())


def _scores(counts: DataFrame) -> DataFrame:
    def zero(value: Column) -> Column:
        return F.coalesce(value, F.lit(0.0))

    return counts.withColumns(
        {
            "precision": zero(ratio(F.col("tp"), F.col("tp") + F.col("fp"))),
            "recall": zero(ratio(F.col("tp"), F.col("tp") + F.col("fn"))),
        }
    ).withColumn("f1", zero(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))


def classification_metrics(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means as rows of the same table."""
    scores = _scores(class_counts(pairs))
    measures = ("precision", "recall", "f1")
    accuracy = ratio(F.sum("tp"), F.max("total"))
    means = {
        "accuracy": [accuracy.alias(m) for m in measures],
        "macro": [F.avg(m).alias(m) for m in measures],
        "weighted": [ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
    }
    result = scores.select("label", *measures, "support")
    for name, columns in means.items():
        row = scores.agg(*columns, F.sum("support").alias("support"))
        result = result.unionByName(row.select(F.lit(name).alias("label"), *measures, "support"))
    return result


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """Raw and row-normalised counts per true class, with specificity and false positive rate."""
    cells = pairs.groupBy("y_true").pivot("y_pred", list(CLASSES)).count().na.fill(0)
    whole = sum((F.col(c) for c in CLASSES), F.lit(0))
    counts = class_counts(pairs)
    negatives = F.col("total") - F.col("support")
    specificity = F.coalesce(ratio(negatives - F.col("fp"), negatives), F.lit(0.0))
    rates = counts.select(F.col("label").alias("y_true"), specificity.alias("specificity"), (F.lit(1.0) - specificity).alias("fpr"))
    return cells.withColumns({f"{c}_share": ratio(F.col(c), whole) for c in CLASSES}).join(rates, "y_true")


def _score_groups(rows: DataFrame, probabilities: dict[str, str]) -> DataFrame:
    """Per class and distinct score: positives and negatives, with those of higher scores before them.

    Scores are rounded to four digits when folded, so a class has at most 10 001 of them however many rows there are.
    """
    long = rows.select("y_true", F.inline(F.array(*[F.struct(F.lit(c).alias("label"), F.col(p).alias("score")) for c, p in probabilities.items()])))
    hit = F.col("y_true") == F.col("label")
    groups = long.groupBy("label", "score").agg(F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))
    above = Window.partitionBy("label").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    return groups.withColumns(
        {"pos_above": F.coalesce(F.sum("pos").over(above), F.lit(0)), "neg_above": F.coalesce(F.sum("neg").over(above), F.lit(0))}
    )


PROBABILITIES = {"negatif": "p_neg", "neutre": "p_neu", "positif": "p_pos"}


def roc_auc(rows: DataFrame, probabilities: dict[str, str] = PROBABILITIES) -> DataFrame:
    """One-versus-rest area per class (null when a class is absent or alone) and their mean as ``macro``."""
    won = F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2.0))
    per_class = (
        _score_groups(rows, probabilities).groupBy("label")
        .agg(won.alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select("label", F.try_divide(F.col("won"), (F.col("p") * F.col("n")).cast("double")).alias("auc"))
    )
    return per_class.unionByName(per_class.agg(F.avg("auc").alias("auc")).select(F.lit("macro").alias("label"), "auc"))


def roc_points(rows: DataFrame, probabilities: dict[str, str] = PROBABILITIES) -> DataFrame:
    """False and true positive rate at each distinct score."""
    groups = _score_groups(rows, probabilities)
    totals = groups.groupBy("label").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return groups.join(totals, "label").select(
        "label", F.col("score").alias("threshold"),
        ratio(F.col("neg_above") + F.col("neg"), F.col("n")).alias("fpr"),
        ratio(F.col("pos_above") + F.col("pos"), F.col("p")).alias("tpr"),
    )


def corpus_accuracy(rows: DataFrame, prefix: Column) -> DataFrame:
    """Rows, correct rows and accuracy in percent per id prefix and overall."""
    cells = rows.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n"), F.count_if(F.col("y_true") == F.col("y_pred")).alias("ok"))
    overall = cells.agg(F.sum("n").alias("n"), F.sum("ok").alias("ok")).select(F.lit("all").alias("prefix"), "n", "ok")
    return cells.unionByName(overall).withColumn("accuracy_pct", round_even(F.col("ok") * 100.0 / F.col("n"), 1))


def id_prefix(value: Column) -> Column:
    """Group of a test sentence: ``NE`` or the first letter of its id."""
    return F.when(value.startswith("NE"), "NE").otherwise(F.substring(value, 1, 1))


def errors(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("y_true") != F.col("y_pred"))


def _rules(facts: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    listed = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.col(column).cast("double").alias("value"), F.coalesce(alert, F.lit(True)).alias("alert"))
            for name, column, alert in rules
        ]
    )
    return facts.select(F.inline(listed))


def inference_checks(predictions: DataFrame, latency: DataFrame) -> DataFrame:
    """Six threshold checks with their measured value; ``latency`` is one row with p90 and p99."""
    shares = with_share(predictions.groupBy("predicted_sentiment").agg(F.count("*").alias("count")))
    largest = shares.agg(F.max("share")).scalar()
    neutral = shares.agg(F.coalesce(F.max(F.when(F.col("predicted_sentiment").isin(NEUTRAL, "neutral"), F.col("share"))), F.lit(0.0))).scalar()
    facts = (
        predictions.agg(F.avg("confidence").alias("mean"), F.avg(F.when(F.col("confidence") < 0.55, 1.0).otherwise(0.0)).alias("low"))
        .withColumns({"dominant": largest, "neutral": neutral, "_l": latency.select(F.struct("p90", "p99")).scalar()})
        .select("*", "_l.p90", "_l.p99")
    )
    return _rules(
        facts,
        [
            ("dominant_class", "dominant", F.col("dominant") > DOMINANT_MAX),
            ("neutral_share", "neutral", F.col("neutral") < NEUTRAL_MIN),
            ("confidence_mean", "mean", F.col("mean") < CONFIDENCE_MEAN_MIN),
            ("confidence_low_share", "low", F.col("low") > CONFIDENCE_LOW_MAX),
            ("latency_p90", "p90", F.col("p90") > LATENCY_P90_MS),
            ("latency_p99", "p99", F.col("p99") > LATENCY_P99_MS),
        ],
    )


def inference_verdict(checks: DataFrame) -> DataFrame:
    """GO without alert, with care up to two, else NO-GO."""
    verdict = one_of((F.col("alerts") == 0, "GO"), (F.col("alerts") <= 2, "GO avec vigilance"), default="NO-GO")
    return checks.agg(F.count_if("alert").alias("alerts")).withColumn("verdict", verdict)


def model_gate(facts: DataFrame) -> DataFrame:
    """Five model checks on one row of measures: all passed GO, three or more with care, else NO-GO."""
    passed = F.lit(0)
    for name, (sign, limit) in GATE.items():
        ok = F.col(name) >= limit if sign == ">=" else F.col(name) <= limit
        passed = passed + F.coalesce(ok, F.lit(False)).cast("int")
    verdict = one_of((F.col("passed") == len(GATE), "GO"), (F.col("passed") >= 3, "GO avec vigilance"), default="NO-GO")
    return facts.select(passed.alias("passed")).withColumn("verdict", verdict)


