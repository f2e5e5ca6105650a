"""Toxicity by the nearest labelled examples.

Terms are words (runs of letters, marks and numbers, by Unicode case folding) and their prefixes of ``PREFIX`` bytes (up to the end
of a letter), which stand for the stem of inflected words. The vocabulary holds all terms of the examples. A text's vector weighs
(1 + ln tf) * idf * (1 + ``GAIN`` * strength) and has length 1; the strength of a term (0 to 1) is the square of how far its toxic
share surely (lower end of the 95 % Wilson interval) lies above the base rate. So every term counts by its idf, and those that tell
of toxicity count more. A text is scored by the exact ``NEIGHBOURS`` nearest examples by cosine, found in an
inverted index with block maxima: a vote weighted by similarity (and by how many rows an example stands for), shrunk to the
base rate. A text that shares no term with any example has no neighbour and gets the base rate. Votes are
calibrated by a logistic curve fitted to the examples' own votes, each without itself. Evidence lists the nearest examples.

Frequencies cover every learnable row. The examples are a sample of about ``examples_per_class`` rows of each
class, drawn by the hash of the key; so index, vocabulary and their broadcast do not grow with the corpus.

Cases: null and empty texts have no term. Labels other than 0 and 1 and null keys teach nothing; a key with several labels
counts as toxic if one of them is 1; repeated rows of a key teach each. Without a toxic learnable row every score is 0. Ties in
similarity go to the example with the smaller key. Only key and text of the documents and key and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.blockmax import BlockMaxIndex
from opinara.llm.flat import PUNCTUATION, HashTable, Slice, WordHasher, slices

PREFIX, GAIN = 5, 30.0
EXAMPLES_PER_CLASS, NEIGHBOURS, PRIOR_WEIGHT = 600, 15, 0.25
BROADCAST_LABELS = 1_000_000


def _terms(part: Slice, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts of a slice, and the text of each."""
    begin, end = hasher.spans(part.data, part.starts)
    row = np.searchsorted(part.starts, begin, "right") - 1
    long = end - begin > PREFIX
    stem, limit = begin[long] + PREFIX, end[long]
    for _ in range(3):
        inside = np.flatnonzero(stem < limit)
        stem[inside] += (part.data[stem[inside]] & 0xC0) == 0x80
    # A prefix differs from the word of the same letters.
    prefixes = hasher.hashes(part.data, begin[long], stem) + np.uint64(1)
    return np.concatenate([hasher.hashes(part.data, begin, end), prefixes]), np.concatenate([row, row[long]])


def _vectors(batches: Iterator[pa.RecordBatch], table: HashTable, n_terms: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a slice with (row, term, count) of the known terms in their texts, in order of rows."""
    hasher = WordHasher(separators=PUNCTUATION)
    for part in slices(batches, fold=True):
        hashes, rows = _terms(part, hasher)
        distinct, place = np.unique(hashes, return_inverse=True)
        found = table.find(distinct)[place]
        known = found >= 0
        cells, counts = np.unique(rows[known] * n_terms + found[known], return_counts=True)
        yield part.rows, cells // n_terms, cells % n_terms, counts


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key, label, terms and their counts of every text."""
    hasher = WordHasher(separators=PUNCTUATION)
    for part in slices(batches, fold=True):
        hashes, rows = _terms(part, hasher)
        order = np.lexsort((hashes, rows))
        hashes, rows = hashes[order], rows[order]
        new = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1]))) if len(rows) else np.zeros(0, np.int64)
        starts = np.searchsorted(rows[new], np.arange(part.rows.num_rows + 1)).astype(np.int32)
        counts = np.diff(np.append(new, len(rows))).astype(np.int32)
        lists = (pa.ListArray.from_arrays(pa.array(starts), pa.array(x)) for x in (hashes[new].astype(np.int64), counts))
        yield pa.RecordBatch.from_arrays([part.rows["key"], part.rows["label"], *lists], ["key", "label", "terms", "counts"])


def at_least(hits: np.ndarray, of: np.ndarray, z: float = 1.96) -> np.ndarray:
    """Lower end of the Wilson interval of a share."""
    share = hits / of
    middle, spread = share + z * z / (2 * of), z * np.sqrt(share * (1 - share) / of + z * z / (4 * of * of))
    return (middle - spread) / (1 + z * z / of)


class Model(NamedTuple):
    """Vocabulary with idf, examples (key, label, rows each stands for) with their vectors, and the calibration."""

    terms: np.ndarray
    idf: np.ndarray
    keys: list[int]
    labels: np.ndarray
    stands_for: np.ndarray
    vectors: tuple[np.ndarray, np.ndarray, np.ndarray]
    base: float
    slope: float
    offset: float

    def index(self) -> BlockMaxIndex:
        items, terms, weights = self.vectors
        return BlockMaxIndex(len(self.terms), len(self.keys), terms, items, weights)


def weigh(rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray, n_rows: int) -> np.ndarray:
    """TF-IDF weights; each row's vector has length 1."""
    weights = (1 + np.log(counts)) * idf[terms]
    return weights / np.sqrt(np.bincount(rows, weights * weights, n_rows))[rows] if len(rows) else weights


def vote(items: np.ndarray, similarity: np.ndarray, labels: np.ndarray, stands_for: np.ndarray, base: float) -> float:
    """Share of toxic examples among neighbours, by similarity, with a little weight on the base rate."""
    weights = similarity * stands_for[items] / max(float(stands_for[items].max()), 1e-12)
    return float((weights @ labels[items] + PRIOR_WEIGHT * base) / (weights.sum() + PRIOR_WEIGHT))


def logistic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve on the votes' log odds; Newton steps with smoothed labels."""
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    x = np.log(votes / (1 - votes))
    positive, negative = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    theta = np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    weights = weights / weights.mean()
    for _ in range(50):
        p = 1 / (1 + np.exp(-(design @ theta)))
        gradient = design.T @ (weights * (p - target)) + 1e-2 * (theta - [1, 0])
        hessian = (design * (weights * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta = theta - step.clip(-1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(theta[0], 0.05)), float(theta[1])


def calibrated(v: float, slope: float, offset: float) -> float:
    v = min(max(v, 1e-6), 1 - 1e-6)
    return float(1 / (1 + np.exp(-(slope * np.log(v / (1 - v)) + offset))))


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """key, text and label of the rows to learn from. Labels are broadcast while they are few (they are counted)."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max(label).cast("int").alias("label")
    )
    few = known.count() <= BROADCAST_LABELS
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return rows.join(F.broadcast(known) if few else known, "key")


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    examples_per_class: int = EXAMPLES_PER_CLASS, gain: float = GAIN,
) -> Model:
    """Learn from the documents that have a label; the key is an integer."""
    rows = _labelled(docs, labels, key, text, label)
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    total, toxic = sum(sizes.values()), sizes.get(1, 0)
    base, none = toxic / max(total, 1), np.zeros(0)
    # A row is an example if its hash falls under its class's share: about as many at every corpus size.
    share = [min(1.0, examples_per_class / max(sizes.get(c, 0), 1)) for c in (0, 1)]
    draw = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.filter(draw < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    bags = drawn.mapInArrow(_bags, "key long, label int, terms array<long>, counts array<int>").toArrow().combine_chunks()
    bags = bags.take(pc.sort_indices(bags, [("key", "ascending"), ("label", "ascending")]))
    hashes, counts = (np.concatenate([np.zeros(0, np.int64), *(x.values.to_numpy() for x in bags[c])]) for c in ("terms", "counts"))
    vocabulary, terms = np.unique(hashes.astype(np.uint64), return_inverse=True)
    if not toxic or not len(vocabulary):
        return Model(none.astype(np.uint64), none, [], none, none, (none.astype(int),) * 2 + (none,), base, 1.0, 0.0)

    # In how many learnable rows of each class the vocabulary's terms occur.
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(shared.value)
        table, found = HashTable(shared.value), np.zeros((2, n), np.int64)
        for part, row, term, _ in _vectors(batches, table, n):
            label = part["label"].to_numpy()[row]
            for c in (0, 1):
                found[c] += np.bincount(term[label == c], minlength=n)
        held = np.flatnonzero(found.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(found[0, held]), pa.array(found[1, held])], ["term", "clean", "toxic"])

    occurs = rows.select("label", "text").mapInArrow(frequencies, "term long, clean long, toxic long")
    occurs = occurs.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    in_class = np.zeros((2, len(vocabulary)))
    for c, name in enumerate(("clean", "toxic")):
        in_class[c, occurs["term"].to_numpy()] = occurs[name].to_numpy()
    frequency = in_class.sum(axis=0).clip(min=1)
    strength = ((at_least(in_class[1], frequency) - base) / max(1 - base, 1e-9)).clip(min=0) ** 2
    idf = (np.log((1 + total) / (1 + frequency)) + 1) * (1 + gain * strength)
    items = np.repeat(np.arange(len(bags)), pc.list_value_length(bags["terms"]).to_numpy())
    weights = weigh(items, terms, counts, idf, len(bags))
    classes = bags["label"].to_numpy().astype(float)
    stands_for = 1 / np.array(share)[classes.astype(int)]
    return _calibrate(Model(vocabulary, idf, bags["key"].to_pylist(), classes, stands_for, (items, terms, weights), base, 1.0, 0.0))


def _calibrate(model: Model) -> Model:
    """Fit the logistic curve to the votes on every example by the other examples."""
    items, terms, weights = model.vectors
    index, votes, seen = model.index(), [], []
    starts = np.searchsorted(items, np.arange(len(model.keys) + 1))
    for i, (begin, end) in enumerate(zip(starts, starts[1:])):
        found, similarity = index.top(terms[begin:end], weights[begin:end], NEIGHBOURS + 1)
        others = found != i
        if others.any():
            votes.append(vote(found[others], similarity[others], model.labels, model.stands_for, model.base))
            seen.append(i)
    if not seen:
        return model
    clipped = np.array(votes).clip(1e-6, 1 - 1e-6)
    slope, offset = logistic(clipped, model.labels[seen], model.stands_for[seen])
    return model._replace(slope=slope, offset=offset)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", evidence: int = 3) -> DataFrame:
    """``key``, ``score`` and ``evidence`` (array of key and similarity of the nearest examples) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        index = model.index()
        for part, row, term, count in _vectors(batches, HashTable(model.terms), max(len(model.terms), 1)):
            weights = weigh(row, term, count, model.idf, part.num_rows)
            scores, shown = np.full(part.num_rows, model.base), [[] for _ in range(part.num_rows)]
            starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else []
            for begin, end in zip(starts, [*starts[1:], len(row)]):
                found, similarity = index.top(term[begin:end], weights[begin:end], NEIGHBOURS)
                if len(found):
                    i = row[begin]
                    scores[i] = calibrated(vote(found, similarity, model.labels, model.stands_for, model.base), model.slope, model.offset)
                    shown[i] = [{"key": model.keys[f], "similarity": float(s)} for f, s in zip(found[:evidence], similarity)]
            shown = pa.array(shown, pa.list_(pa.struct([("key", pa.int64()), ("similarity", pa.float64())])))
            yield pa.RecordBatch.from_arrays([part["key"], pa.array(scores), shown], ["key", "score", "evidence"])

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    fields = f"key {kind}, score double, evidence array<struct<key:long,similarity:double>>"
    return rows.mapInArrow(run, fields).withColumnRenamed("key", key)


def remainder(key: Column, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``: deals rows into folds."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(of))
