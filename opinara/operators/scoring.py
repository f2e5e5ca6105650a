"""Batch scoring, prediction tables and re-enrichment."""

from __future__ import annotations

import re
import sys
import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import labels, lexicon
from opinara.functions.lexicon import SentimentLexicon, TopicTable
from opinara.functions.text import cut, or_empty, strip
from opinara.operators.filters import assert_no_leak
from opinara.operators.layers import KEYWORD_MODEL
from opinara.operators.tracking import enrichment_backlog

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Scorer = Callable[[list[str]], list[list[tuple[str, float]]]]

# Answer for a text the scorer could not read.
FAILED_TEXT = [("NEUTRAL", 1.0)]


def lexicon_scorer(words: SentimentLexicon) -> Scorer:
    """Smoothed lexicon shares as class scores; the stand-in for a model."""
    positive, negative = dict(words.positive), dict(words.negative)

    def score(texts: list[str]) -> list[list[tuple[str, float]]]:
        answers = []
        for text in texts:
            tokens = re.split(r"\W+", text.lower()) if len(text.strip()) >= 10 else []
            pos = sum(positive.get(t, 0) for t in tokens)
            neg = sum(negative.get(t, 0) for t in tokens)
            whole = pos + neg + 1.5
            answers.append([("negatif", (neg + 0.5) / whole), ("neutre", 0.5 / whole), ("positif", (pos + 0.5) / whole)])
        return answers

    return score


def _answers(scorer: Scorer, texts: list[str]) -> tuple[list[list[tuple[str, float]]], list[bool]]:
    """Scores, and which texts failed: a batch that fails is tried again in halves, down to single texts."""
    try:
        return scorer(texts), [False] * len(texts)
    except Exception:
        if len(texts) == 1:
            return [FAILED_TEXT], [True]
    middle = len(texts) // 2
    halves = [_answers(scorer, part) for part in (texts[:middle], texts[middle:])]
    return halves[0][0] + halves[1][0], halves[0][1] + halves[1][1]


def _scored_batches(scorer: Scorer, model_batch: int) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for first in range(0, len(whole), model_batch):
                batch = whole.iloc[first : first + model_batch]
                start = time.perf_counter()
                scores, failed = _answers(scorer, batch["text"].tolist())
                spent = int((time.perf_counter() - start) * 1000 / len(batch))
                named = [[{"label": name, "score": float(value)} for name, value in row] for row in scores]
                yield batch.assign(scores=named, inference_ms=spent, failed=failed)

    return run


def batch_score(df: DataFrame, scorer: Scorer, max_chars: int | None = None, model_batch: int = 64) -> DataFrame:
    """Scores title and content of each row with a pluggable scorer; the input must carry no target column.

    The scorer gets ``model_batch`` texts at a time. A text it cannot score counts as neutral and has ``failed`` set; the
    other texts of its batch keep their scores. ``max_chars`` is for scorers with a bounded window; the default hands them
    the whole text.
    """
    assert_no_leak(df.columns)
    text = cut(F.concat(or_empty(F.col("title")), F.lit(" "), or_empty(F.col("content"))), max_chars)
    rows = df.select(F.col("id").cast("string").alias("id"), F.col("title"), text.alias("text"))
    scored = rows.mapInPandas(
        _scored_batches(scorer, model_batch),
        "id string, title string, text string, scores array<struct<label:string,score:double>>, inference_ms int, failed boolean",
    )
    return labels.fold_probabilities(scored).drop("text", "scores")


def check_failures(scored: DataFrame, most: float = 0.01) -> DataFrame:
    """Share of failed texts; the job fails if it exceeds ``most``."""
    share = F.avg(F.col("failed").cast("double"))
    message = F.concat(F.lit("failed share of texts: "), share.cast("string"))
    return scored.agg(F.when(share > most, F.raise_error(message).cast("double")).otherwise(F.coalesce(share, F.lit(0.0))).alias("failed_share"))


def prediction_frame(scored: DataFrame, model_version: str, run: str, at: Column | None = None) -> DataFrame:
    """Prediction rows with run, version and time beside the class probabilities."""
    out = F.col("out")
    return scored.select(
        "id",
        labels.french_label(out["label_3c"]).alias("predicted_sentiment"),
        out["sentiment_score"].alias("predicted_sentiment_score"),
        F.lit(model_version).alias("model_version"),
        F.lit(run).alias("inference_run_id"),
        (F.current_timestamp() if at is None else at).alias("prediction_timestamp"),
        *[out[c].alias(c) for c in ("label_3c", "confidence", "p_pos", "p_neu", "p_neg")],
        "inference_ms",
        "title",
    )


def resume(df: DataFrame, done: DataFrame, run: str) -> DataFrame:
    """Rows the run has not scored yet."""
    written = done.filter(F.col("run") == run).select(F.col("id").cast("string").alias("_done"))
    # A hash table of the ids in each part: the whole texts beside them are never sorted.
    return df.join(written.hint("shuffle_hash"), F.col("id").cast("string") == F.col("_done"), "left_anti")


def upsert_predictions(outputs: DataFrame, predictions: DataFrame, model: str, output_id: Column) -> DataFrame:
    """Outputs after replacing those of ``model`` for the predicted articles; only whole-number ids are written."""
    fresh = (
        predictions.withColumn("raw_data_id", strip(F.col("id").cast("string")).try_cast("bigint"))
        .filter(F.col("raw_data_id").isNotNull())
        .select(
            output_id.alias("output_id"), "raw_data_id", F.lit(model).alias("model_name"),
            F.col("predicted_sentiment").alias("label"), F.col("confidence").alias("score"),
        )
    )
    keys = fresh.select("raw_data_id", "model_name")
    kept = outputs.join(keys, ["raw_data_id", "model_name"], "left_anti")
    return kept.select("output_id", "raw_data_id", "model_name", "label", "score").unionByName(fresh)


def retag(df: DataFrame, topics: TopicTable) -> DataFrame:
    """The table with topics assigned anew, every other column kept; topic confidences follow when the table has them."""
    tagged = lexicon.add_topic_columns(df.drop("topic_1", "topic_1_score", "topic_2", "topic_2_score"), topics)
    present = [c for c in ("topic_1", "topic_2") if f"{c}_confidence" in df.columns]
    return tagged.withColumns({f"{c}_confidence": F.col(f"{c}_score") for c in present}) if present else tagged


def reanalyze(outputs: DataFrame, articles: DataFrame, words: SentimentLexicon, output_id: Column) -> DataFrame:
    """Outputs with every keyword sentiment replaced by a fresh one."""
    fresh = lexicon.add_sentiment(articles, words).select(
        output_id.alias("output_id"), F.col("id").alias("raw_data_id"), F.lit(KEYWORD_MODEL).alias("model_name"),
        F.col("sentiment").alias("label"), F.col("sentiment_score").alias("score"),
    )
    others = outputs.filter(F.col("model_name") != KEYWORD_MODEL).select(fresh.columns)
    return others.unionByName(fresh)


def enrich_backlog(raw: DataFrame, links: DataFrame, outputs: DataFrame, words: SentimentLexicon, topics: TopicTable) -> DataFrame:
    """Topics and sentiment for exactly the articles that miss either."""
    missing = enrichment_backlog(raw, links, outputs)
    return lexicon.add_topic_columns(lexicon.add_sentiment(missing, words), topics)
