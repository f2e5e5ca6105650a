"""Benchmark decontamination: BM25 with block-max pruning finds test items in training passages, word overlap confirms them.

Words are runs of letters, marks and numbers of any script, by Unicode case folding. Items are sorted into classes by length (up to
32 words, then four times as many each). For a class, every document is cut into passages of twice the class's longest length
that start one such length apart, so each place an item can stand lies within one passage. Every passage queries the class's index
with its distinct words; an item's score is its BM25 sum divided by the item's score against itself, so one threshold fits items
of every length. A passage whose term maxima together stay below the threshold is left at once; else the blocks whose maxima can
reach it are opened. So all items at or above ``threshold`` are retrieved, exactly. A retrieved item is
confirmed if the passage holds enough of the word trigrams of its question and of its answer (a part of one or two words counts whole): the answer is the last line of
an item, or its last sentence, or the last quarter of its words.

Document frequencies and the mean length are counted over all items. The index is broadcast in shards, numbered by hash, of about
``SHARD_ITEMS`` items and ``SHARD_CHARS`` characters, so a broadcast does not grow with the benchmark; documents are passed over
once per shard. An item's class, score and overlaps do not depend on the items it shares a shard with.

Cases: null or empty texts and texts without a word match nothing, and so do such items; an empty benchmark or corpus gives an
empty result. Items of equal text are each reported. Rows are searched one by one; with repeated keys the best scores per key
and item are reported, rows with a null key are reported under null. Ties cannot change the result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opinara.llm.blockmax import BlockMaxIndex, ragged
from opinara.llm.flat import PUNCTUATION, HashTable, Slice, WordHasher, folded, mix, released, slices
from opinara.storage import stage

SHARD_ITEMS, SHARD_CHARS = 4_000, 4_000_000
SHORT_ITEM, LONGER_BY = 32, 4
TABLE_CELLS = 8_000_000
THRESHOLD = 0.5
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.5, 0.5
K1, B = 1.2, 0.75
GRAM = 3
_FACTORS = mix(np.arange(1, GRAM + 1, dtype=np.uint64)) | np.uint64(1)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of the runs of ``n`` words."""
    if not 0 < n <= len(words):
        return np.zeros(0, np.uint64)
    joined = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        joined += words[j : len(words) - n + 1 + j] * _FACTORS[j]
    return np.unique(mix(joined))


def question_and_answer(text: str) -> tuple[str, str]:
    """Split an item (see the module's text)."""
    lines = [line for line in text.strip().split("\n") if line.strip()]
    if len(lines) > 1:
        return "\n".join(lines[:-1]), lines[-1]
    sentences = _SENTENCE.split(text.strip())
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    words = text.split()
    cut = len(words) - max(1, len(words) // 4)
    return " ".join(words[:cut]), " ".join(words[cut:])


class Statistics(NamedTuple):
    """Number of items with words and their mean length, and in how many items each of a shard's words occurs."""

    n_items: int
    mean_length: float
    words: np.ndarray
    frequencies: np.ndarray


class Item(NamedTuple):
    """An item's id and the words of its question and of its answer."""

    item_id: int
    question: np.ndarray
    answer: np.ndarray


def overlap(part: np.ndarray, passage: np.ndarray) -> float:
    """Share of a part's word trigrams (of the whole part, if shorter) in a passage; 1 for a part without words."""
    n = min(len(part), GRAM)
    return float(np.isin(grams(part, n), grams(passage, n)).mean()) if n else 1.0


def hash_words(texts: list[str], hasher: WordHasher) -> list[np.ndarray]:
    data = [np.frombuffer(t.encode(), np.uint8) for t in folded(pa.array(texts, pa.large_string())).to_pylist()]
    starts = np.cumsum([0, *map(len, data)])
    words, first = hasher.words(Slice(None, np.concatenate([*data, np.zeros(0, np.uint8)]), starts))
    return [words[a:b] for a, b in zip(first, first[1:])]


class LengthClass:
    """BM25 impacts of items of similar length, each divided by the item's score against itself."""

    def __init__(self, items: list[Item], words: list[np.ndarray], longest: int, vocabulary: np.ndarray, idf: np.ndarray, mean_length: float) -> None:
        self.items, self.longest, self.n_terms = items, longest, len(vocabulary)
        sizes = np.array([len(w) for w in words])
        term = np.searchsorted(vocabulary, np.concatenate(words))
        pairs, tf = np.unique(np.stack([term, np.repeat(np.arange(len(items)), sizes)]), axis=1, return_counts=True)
        length = K1 * (1 - B + B * sizes / mean_length)
        impact = idf[pairs[0]] * tf * (K1 + 1) / (tf + length[pairs[1]])
        whole = np.bincount(pairs[1], impact, len(items))
        block = max(4, -(-self.n_terms * len(items) // TABLE_CELLS))
        self.index = BlockMaxIndex(self.n_terms, len(items), pairs[0], pairs[1], impact / whole[pairs[1]], block)

    def passages(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first and last-plus-one word of every passage; ``first`` has the first word of each text."""
        sizes = np.diff(first)
        counts = np.maximum(-(-sizes // self.longest) - 1, 1) * (sizes > 0)
        text = np.repeat(np.arange(len(sizes)), counts)
        place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = first[text] + place * self.longest
        return text, begin, np.minimum(begin + 2 * self.longest, first[text + 1])

    def search(self, words: np.ndarray, terms: np.ndarray, first: np.ndarray, threshold: float) -> Iterator[tuple[int, Item, float, np.ndarray]]:
        text, begin, end = self.passages(first)
        at, passage = ragged(begin, end)
        at, passage = at[known := (terms >= 0)[at]], passage[known]
        pairs = np.unique(passage * self.n_terms + terms[at])
        for i, found, scores in self.index.above_each(pairs // self.n_terms, pairs % self.n_terms, threshold):
            for item, score in zip(found, scores):
                yield text[i], self.items[item], float(score), words[begin[i] : end[i]]


class TestIndex:
    """The items of a shard by classes of length."""

    __test__ = False

    def __init__(self, items: list[tuple[int, str]], statistics: Statistics, hasher: WordHasher) -> None:
        words = hash_words([text for _, text in items], hasher)
        parts = [question_and_answer(text) for _, text in items]
        questions, answers = (hash_words([p[i] for p in parts], hasher) for i in (0, 1))
        n, df = statistics.n_items, statistics.frequencies
        order = np.argsort(statistics.words)
        vocabulary, idf = statistics.words[order], np.log(1 + (n - df[order] + 0.5) / (df[order] + 0.5))
        self.table = HashTable(vocabulary)
        by_length: dict[int, list[int]] = {}
        for i, held in enumerate(words):
            if len(held):
                longest = SHORT_ITEM
                while longest < len(held):
                    longest *= LONGER_BY
                by_length.setdefault(longest, []).append(i)
        self.classes = [
            LengthClass(
                [Item(items[i][0], questions[i], answers[i]) for i in chosen], [words[i] for i in chosen], longest, vocabulary, idf,
                statistics.mean_length,
            )
            for longest, chosen in sorted(by_length.items())
        ]

    def search(self, words: np.ndarray, first: np.ndarray, threshold: float) -> Iterator[tuple[int, Item, float, np.ndarray]]:
        """(text, item, score, words of the passage) of all passages and items at or above the threshold."""
        terms = self.table.find(words)
        for items in self.classes:
            yield from items.search(words, terms, first, threshold)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items with the hashes of their distinct words and their length in words."""
    hasher = WordHasher(separators=PUNCTUATION)
    for part in slices(batches, fold=True):
        words, first = hasher.words(part)
        found = [words[a:b] for a, b in zip(first, first[1:])]
        distinct = pa.array([np.unique(w).view(np.int64) for w in found], pa.list_(pa.int64()))
        columns = [*part.rows.columns, distinct, pa.array([len(w) for w in found], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["i", "text", "words", "size"])


def _shards(benchmark: DataFrame, item_id: str, text: str) -> Iterator[tuple[list[tuple[int, str]], Statistics]]:
    """Items with a word and the statistics of their words, in shards; the driver holds one at a time."""
    rows = benchmark.select(benchmark[item_id].cast("long").alias("i"), benchmark[text].alias("text"))
    items = rows.filter(F.col("text").isNotNull()).mapInArrow(_item_words, "i long, text string, words array<long>, size long")
    items = stage(items.filter("size > 0"), "benchmark-items")
    total = items.agg(F.count("*").alias("n"), F.sum("size").alias("words"), F.sum(F.length("text")).alias("chars")).first()
    if not total.n:
        return
    count = max(-(-total.n // SHARD_ITEMS), -(-total.chars // SHARD_CHARS))
    sharded = items.withColumn("shard", F.pmod(F.xxhash64("i", "text"), F.lit(count)))
    spread = sharded.select("shard", F.explode("words").alias("word")).groupBy("word", "shard").agg(F.count("*").alias("n"))
    frequency = spread.groupBy("word").agg(F.sum("n").alias("n"), F.collect_list("shard").alias("shards"))
    terms = stage(frequency.select("word", "n", F.explode("shards").alias("shard")), "benchmark-terms")
    for shard in range(count):
        held = sharded.filter(F.col("shard") == shard).select("i", "text").orderBy("i", "text").collect()
        counted = terms.filter(F.col("shard") == shard).select("word", "n").toArrow()
        if held:
            words, n = (counted.column(c).to_numpy() for c in ("word", "n"))
            yield [tuple(r) for r in held], Statistics(total.n, total.words / total.n, words.view(np.uint64), n)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", threshold: float = THRESHOLD, question: float = QUESTION_OVERLAP, answer: float = ANSWER_OVERLAP,
) -> DataFrame:
    """``key``, ``item_id``, ``score``, ``question_overlap`` and ``answer_overlap`` of every confirmed match."""
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    fields = f"key {kind}, item_id long, score double, question_overlap double, answer_overlap double"
    # Rows of the driver would need Python workers of their own on every executor, which then stay.
    found = spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(fields)))
    for shard in _shards(benchmark, item_id, item_text):
        held = spark.sparkContext.broadcast(shard)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            hasher = WordHasher(separators=PUNCTUATION)
            index = TestIndex(*held.value, hasher)
            for part in slices(batches, fold=True):
                words, first = hasher.words(part)
                hits = []
                for row, item, score, passage in index.search(words, first, threshold):
                    overlaps = overlap(item.question, passage), overlap(item.answer, passage)
                    if overlaps[0] >= question and overlaps[1] >= answer:
                        hits.append((row, item.item_id, score, *overlaps))
                columns = list(zip(*hits)) or [()] * 5
                keys = part.rows.column(0).take(pa.array(columns[0], pa.int64()))
                values = [pa.array(c, t) for c, t in zip(columns[1:], (pa.int64(), pa.float64(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([keys, *values], ["key", "item_id", "score", "question_overlap", "answer_overlap"])

        found = found.union(rows.mapInArrow(lambda b, run=run: released(run(b)), fields))
    best = [F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")]
    return found.groupBy("key", "item_id").agg(*best).withColumnRenamed("key", key)
