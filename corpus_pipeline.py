"""A corpus cleaned for training: language, lines, near duplicates, benchmark leaks, tokens.

Each stage takes the documents its predecessor kept. A document goes if its language cannot be told (no letter, or a score
hardly above an even guess among the learnt languages), if line dedup takes its last line, if it is a near duplicate of a kept one, or if it holds a benchmark
item. Documents that no stage objects to keep their text. Stages keep rows with null columns as their operators state: a null or
empty text has no language and goes in the first stage, repeated rows of one id stay or go together, and an empty table runs
through and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import bpe, decontaminate, language, linededup, neardup
from opinara.llm.queries import TOKENIZER, fold, table
from opinara.storage import stage

#: How far above an even guess a calibrated score must be: with four languages, 0.3 against 0.25.
LEAST_GAIN = 1.2


def least_score(languages: int) -> float:
    """Score from which a language counts as told; with one language any letter is enough."""
    return min(1.0, LEAST_GAIN / languages) if languages else 1.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows of two folds in three and predicts all; rejected documents go."""
    model = language.train(docs.filter(fold(F.col("doc_id"), 3) != 1))
    sure = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least_score(len(model.languages)))
    told = language.predict(docs, model).filter(sure)
    return told.select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines within two edits of an earlier one out; a document goes if that leaves none."""
    kept = linededup.dedup_lines(docs, edits=2).filter((F.col("n_dropped") == 0) | (F.trim(F.regexp_replace("text", "\n", " ")) != ""))
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    gone = neardup.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    hits = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(hits, "doc_id", "left_anti").select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    tokenizer = bpe.broadcast_tokenizer(spark, TOKENIZER)
    coded = bpe.encode_and_decode(docs, tokenizer)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", F.size("token_ids").alias("n_tokens"), "token_ids", same.alias("round_trip"))


STAGES = [
    ("language", identify_language), ("lines", dedup_lines), ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated), ("tokens", tokenize),
]
#: Trained models, signatures and token merges have no SQL form. The operators are tested one by one; rows of the whole chain are not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
