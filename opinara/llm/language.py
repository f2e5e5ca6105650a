"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are n-grams of 1 to 3 characters of the folded text (letters in lower case, every other run one blank), hashed into
``BUCKETS`` counters. A term weighs (1 + ln tf) * idf, and a text's vector has length 1. The document frequencies behind idf
are counted over every learnable row. The weights are fitted by follow-the-regularised-leader with elastic-net penalties
(most become exactly zero) on a sample of about ``sample_per_language`` rows of each language, chosen by the hash of the key;
a fifth of the sample is set aside and fits the temperature that calibrates the scores. The ``max_languages`` most frequent
languages are learnt. The model is a table of at most ``BUCKETS`` x ``max_languages`` weights, and the task that fits it holds
at most ``max_examples`` sampled vectors, so neither grows with the corpus.

Only the folded text goes to Python, and its scores come back; all other columns stay in the JVM. Batches are worked on in
slices of about a megabyte.

Cases: a text that is null, empty or without a letter is ``und`` with score 0, as is every text when nothing could be
learned. Texts are read whole. With one language the score is 1. Ties go to the language that sorts first. Rows are
predicted one by one, so repeated rows get equal results; rows with a null language
or text teach nothing. Other columns pass through; ``lang_pred`` and ``score`` are replaced if they exist.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.flat import mix, released, slices

BUCKETS = 1 << 15
SHIFT = np.uint64(64 - 15)
FACTORS = mix(np.arange(1, 4, dtype=np.uint64)) | np.uint64(1)  # one per order
SAMPLE_PER_LANGUAGE = 400
MAX_LANGUAGES, MAX_EXAMPLES = 400, 40_000
UNKNOWN = "und"
EPOCHS, ALPHA, BETA, L1, L2 = 3, 1.0, 1.0, 0.02, 0.02


class Model(NamedTuple):
    """Languages, idf per bucket, weights (languages x buckets), biases and temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def folded(text: Column) -> Column:
    """Letters in lower case; everything between them becomes one blank. Empty without a letter (marks alone are none)."""
    letters = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "))
    return F.when(text.rlike(r"\p{L}"), letters).otherwise(F.lit(""))


def _texts(batch: pa.RecordBatch) -> Iterator[list[str]]:
    """The text column of a batch, a slice of about a megabyte at a time."""
    for part in slices([batch]):
        yield part.rows["text"].to_pylist()


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of the n-grams of a folded text. Each order adds a term, so the hash of an n-gram is built up."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    codes, found = np.zeros(len(points), np.uint64), []
    for order, factor in enumerate(FACTORS, 1):
        codes = codes[: len(points) - order + 1] + points[order - 1 :] * factor
        found.append(((codes + np.uint64(order)) * FACTORS[0]) >> SHIFT)
    counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    buckets, counts = ngram_counts(text)
    weights = (1 + np.log(counts)) * idf[buckets]
    return buckets, (weights / max(float(np.sqrt((weights * weights).sum())), 1e-12)).astype(np.float32)


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of one partition."""
    frequency, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in chain.from_iterable(_texts(batch)):
            frequency[ngram_counts(text)[0]] += 1
            rows += 1
    found = np.flatnonzero(frequency)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(found, -1)), pa.array(np.append(frequency[found], rows))], ["bucket", "documents"]
    )


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Smoothed idf per bucket over all rows; at most ``BUCKETS`` + 1 numbers reach the driver."""
    parts = texts.mapInArrow(lambda b: released(_presence(b)), "bucket long, documents long")
    totals = {r.bucket: r.documents for r in parts.groupBy("bucket").agg(F.sum("documents").alias("documents")).collect()}
    n = totals.pop(-1, 0)
    frequency = np.zeros(BUCKETS)
    frequency[list(totals)] = list(totals.values())
    return np.log((1 + n) / (1 + frequency)) + 1


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net; one pass updates per example. Returns weights and biases (unpenalised)."""
    z, n = (np.zeros((n_labels, BUCKETS), np.float64) for _ in range(2))
    z_bias, n_bias = np.zeros(n_labels), np.zeros(n_labels)

    def solve(z_: np.ndarray, n_: np.ndarray, l1: float, l2: float) -> np.ndarray:
        shrunk = np.sign(z_) * np.maximum(np.abs(z_) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(n_)) / ALPHA + l2)

    for _ in range(EPOCHS):
        for (buckets, values), label in zip(examples, labels):
            w, b = solve(z[:, buckets], n[:, buckets], L1, L2), solve(z_bias, n_bias, 0, 0)
            error = softmax(w @ values + b)
            error[label] -= 1
            gradient = error[:, None] * values
            squared = gradient * gradient
            before = n[:, buckets]
            z[:, buckets] += gradient - (np.sqrt(before + squared) - np.sqrt(before)) / ALPHA * w
            n[:, buckets] = before + squared
            z_bias += error - (np.sqrt(n_bias + error * error) - np.sqrt(n_bias)) / ALPHA * b
            n_bias += error * error
    return solve(z, n, L1, L2).astype(np.float32), solve(z_bias, n_bias, 0, 0)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss against smoothed labels, from a fixed grid."""
    if not len(labels):
        return 1.0
    grid, share = np.geomspace(0.05, 20, 121), 1 / (len(labels) + 2)  # of doubt, so that no faultless sample makes scores of 1
    target = np.full(logits.shape, share / logits.shape[1])
    target[np.arange(len(labels)), labels] += 1 - share
    losses = [-(target * np.log(softmax(logits / t) + 1e-12)).sum(axis=1).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    sample_per_language: int = SAMPLE_PER_LANGUAGE, max_languages: int = MAX_LANGUAGES, max_examples: int = MAX_EXAMPLES,
) -> Model:
    """Learn from the rows of ``docs`` that have a text with a letter and a language.

    Many languages share ``max_examples``; beyond ``max_languages`` the rarest labels (often noise) are not learnt.
    """
    rows = docs.select(docs[key].cast("string").alias("key"), folded(docs[text]).alias("text"), docs[lang].alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & (F.col("text") != ""))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    languages = sorted(r.lang for r in sizes)
    if not languages:
        return Model([], np.zeros(BUCKETS), np.zeros((0, BUCKETS), np.float32), np.zeros(0), 1.0)
    idf = inverse_frequencies(rows.select("text"))
    sample_per_language = min(sample_per_language, max(1, max_examples // len(languages)))
    # A row is drawn if its hash falls under its language's share, so the sample is about as large at every corpus size.
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r.lang, min(1.0, sample_per_language / r.n))])
    draw = F.pmod(F.xxhash64("key", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    places = F.create_map(*[F.lit(x) for i, name in enumerate(languages) for x in (name, i)])
    drawn = rows.filter(draw < share[F.col("lang")]).select("key", "text", places[F.col("lang")].alias("label"))
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vector(x, shared.value) for x in chain.from_iterable(_texts(batch))]
            columns = [pa.array([f[0].astype(np.int32).tobytes() for f in found], pa.binary()), pa.array([f[1].tobytes() for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["key"], batch["label"], *columns], ["key", "label", "buckets", "values"])

    def learn(sample: pa.Table) -> pa.Table:
        sample = sample.sort_by([(c, "ascending") for c in ("order", "key", "label")])
        pairs = zip(sample["buckets"].to_pylist(), sample["values"].to_pylist())
        examples = [(np.frombuffer(b, np.int32), np.frombuffer(v, np.float32)) for b, v in pairs]
        labels = sample["label"].to_numpy()
        aside = np.arange(len(labels)) % 5 == 4
        weights, bias = fit([e for e, a in zip(examples, aside) if not a], labels[~aside], len(languages))
        logits = np.array([weights[:, b] @ v + bias for (b, v), a in zip(examples, aside) if a]).reshape(-1, len(languages))
        return pa.table({"weights": [weights.tobytes()], "bias": [bias.tobytes()], "temperature": [temperature(logits, labels[aside])]})

    sample = drawn.mapInArrow(lambda b: released(vectors(b)), "key string, label int, buckets binary, values binary")
    sample = sample.withColumn("order", F.xxhash64("key", F.lit(6)))
    found = sample.groupBy().applyInArrow(learn, "weights binary, bias binary, temperature double").first()
    weights = np.frombuffer(found.weights, np.float32).reshape(len(languages), BUCKETS)
    return Model(languages, idf, weights, np.frombuffer(found.bias, np.float64), found.temperature)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def tell(texts: list[str], model: Model) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for folded_text in texts:
            if not folded_text or not model.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            buckets, values = vector(folded_text, model.idf)
            chances = model.probabilities(model.weights[:, buckets] @ values + model.bias)
            best = int(np.argmax(chances))
            names.append(model.languages[best])
            scores.append(float(chances[best]))
        return names, scores

    def results(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            names, scores = [], []
            for texts in _texts(pa.RecordBatch.from_arrays([column], ["text"])):
                parts = tell(texts, shared.value)
                names += parts[0]
                scores += parts[1]
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    @F.arrow_udf("lang_pred string, score double")
    def told(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return released(results(columns))

    # Not deterministic by name only, so that a filter on the results does not evaluate the function a second time.
    rows = docs.drop("lang_pred", "score")
    guess = rows.withColumn("_told", told.asNondeterministic()(folded(rows[text])))
    return guess.select(*rows.columns, F.col("_told.lang_pred").alias("lang_pred"), F.col("_told.score").alias("score"))
