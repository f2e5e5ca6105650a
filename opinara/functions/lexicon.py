"""Lexicon sentiment and keyword topics as narrow projections: no explode and no shuffle.

Word and keyword tables are parameters. Words are placed in the plan as literals, so ``from_table`` refuses a table above its
row bound. A short keyword list is tested keyword by keyword inside the JVM; a long one becomes an automaton that finds all its
keywords in one pass over a text, broadcast once its bytes are checked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.labels import NEGATIVE, NEUTRAL, POSITIVE
from opinara.functions.numbers import one_of, round_even
from opinara.functions.text import WORD_BREAK, ascii_fold, or_empty, strip

MAX_WORDS, MAX_KEYWORDS = 20_000, 1_000_000
#: Keywords up to which each is looked for by itself; the automaton's cost does not depend on their number.
SCANNED = 64
MAX_KEYWORD_BYTES = 64 << 20

# Weights of the two strengths.
STRENGTH_WEIGHT = {"strong": 2, "moderate": 1}

# Sources whose topic is known from their name (name part, topic, score).
SOURCE_RULES = (
    ("openweather", "meteo", 1.0),
    ("weather_openmeteo", "meteo", 1.0),
    ("open-meteo", "meteo", 1.0),
    ("weather_api", "meteo", 1.0),
    ("openweathermap", "meteo", 1.0),
)

# Topic assignment.
TITLE_WEIGHT = 3
SECOND_TOPIC_FLOOR = 0.03
FALLBACK_TOPIC, FALLBACK_SCORE = "autre", 0.3


def _bounded_rows(df: DataFrame, most: int = MAX_WORDS) -> list:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a lexicon holds at most {most} rows")
    return rows


@dataclass(frozen=True)
class SentimentLexicon:
    """Weights per word; entries of the same word add up."""

    positive: dict[str, int]
    negative: dict[str, int]

    @staticmethod
    def from_entries(entries: Iterable[tuple[str, str, str]]) -> SentimentLexicon:
        """Entries are (word, ``pos``/``neg``, ``strong``/``moderate``)."""
        sides: dict[str, dict[str, int]] = {"pos": {}, "neg": {}}
        for word, polarity, strength in entries:
            side = sides[polarity]
            side[word.lower()] = side.get(word.lower(), 0) + STRENGTH_WEIGHT[strength]
        return SentimentLexicon(sides["pos"], sides["neg"])

    @staticmethod
    def from_table(df: DataFrame) -> SentimentLexicon:
        """From columns word, polarity, strength."""
        return SentimentLexicon.from_entries(map(tuple, _bounded_rows(df.select("word", "polarity", "strength"))))


@dataclass(frozen=True)
class TopicTable:
    """Keywords per topic in dictionary order; a keyword listed twice counts twice."""

    keywords: dict[str, tuple[str, ...]]
    source_rules: tuple[tuple[str, str, float], ...] = SOURCE_RULES

    @staticmethod
    def from_table(df: DataFrame, source_rules=SOURCE_RULES) -> TopicTable:
        """From columns topic, topic_order, keyword."""
        rows = _bounded_rows(df.select("topic_order", "topic", "keyword").orderBy("topic_order", "topic", "keyword"), MAX_KEYWORDS)
        topics: dict[str, list[str]] = {}
        for _, topic, keyword in rows:
            topics.setdefault(topic, []).append(keyword)
        return TopicTable({topic: tuple(listed) for topic, listed in topics.items()}, tuple(source_rules))


def _count_of(hits: Column, words: list[str]) -> Column:
    return F.size(F.filter(hits, lambda t: t.isin(*words)))


def _weighted_hits(hits: Column, weights: dict[str, int]) -> Column:
    total = F.lit(0)
    for weight in sorted(set(weights.values())):
        total = total + _count_of(hits, sorted(word for word, w in weights.items() if w == weight)) * weight
    return total


def sentiment_ladder(negative: Column, positive: Column) -> Column:
    """Decision ladder over the two totals; first true step wins, so a tie at three or more is negative."""
    total = (negative + positive).cast("double")
    neg_share, pos_share = F.try_divide(negative, total), F.try_divide(positive, total)

    def step(label: str, share: Column, start: float, slope: float, top: float) -> Column:
        score = F.least(F.lit(0.5) + (share - start) * slope, F.lit(top))
        return F.struct(F.lit(label).alias("label"), round_even(score, 3).alias("score"))

    undecided = F.struct(F.lit(NEUTRAL).alias("label"), F.lit(0.5).alias("score"))
    return one_of(
        (total == 0, undecided),
        ((negative >= 3) & (neg_share >= 0.5), step(NEGATIVE, neg_share, 0.5, 1.0, 0.95)),
        ((positive >= 3) & (pos_share >= 0.5), step(POSITIVE, pos_share, 0.5, 1.0, 0.95)),
        ((neg_share > 0.6) & (negative >= 2), step(NEGATIVE, neg_share, 0.6, 1.25, 0.95)),
        ((pos_share > 0.6) & (positive >= 2), step(POSITIVE, pos_share, 0.6, 1.25, 0.95)),
        (negative > positive, step(NEGATIVE, neg_share, 0.5, 0.8, 0.85)),
        (positive > negative, step(POSITIVE, pos_share, 0.5, 0.8, 0.85)),
        default=undecided,
    )


def lexicon_totals(df: DataFrame, text: Column, lexicon: SentimentLexicon) -> DataFrame:
    """Adds ``pos_total`` and ``neg_total``; a text under ten characters counts nothing.

    Tokens are reduced to lexicon words by one hashed membership test; weights are then counted on those few words.
    """
    known = sorted({*lexicon.positive, *lexicon.negative})
    bare = strip(or_empty(text))
    tokens = F.split(F.when(F.length(bare) >= 10, F.lower(or_empty(text))), WORD_BREAK)
    hits = F.coalesce(F.filter(tokens, lambda t: t.isin(*known)), F.array().cast("array<string>"))
    return (
        df.withColumn("_hits", hits)
        .withColumns(
            {
                "pos_total": _weighted_hits(F.col("_hits"), lexicon.positive),
                "neg_total": _weighted_hits(F.col("_hits"), lexicon.negative),
            }
        )
        .drop("_hits")
    )


def literal_list(words: tuple[str, ...]) -> Column:
    """Array of the words; folded to a constant when the plan is optimised, and one call however long the list is."""
    return F.split(F.lit("\n".join(words)), "\n") if words else F.array().cast("array<string>")


def title_and_content() -> Column:
    return F.concat(or_empty(F.col("title")), F.lit(" "), or_empty(F.col("content")))


def add_sentiment(df: DataFrame, lexicon: SentimentLexicon, text: Column | None = None) -> DataFrame:
    """Adds ``sentiment`` and ``sentiment_score`` from the lexicon."""
    return add_verdict(lexicon_totals(df, title_and_content() if text is None else text, lexicon))


def add_verdict(totals: DataFrame) -> DataFrame:
    """Adds ``sentiment`` and ``sentiment_score`` to rows with ``pos_total`` and ``neg_total``, which go."""
    return (
        totals.withColumn("_verdict", sentiment_ladder(F.col("neg_total"), F.col("pos_total")))
        .withColumns({"sentiment": F.col("_verdict.label"), "sentiment_score": F.col("_verdict.score")})
        .drop("_verdict", "pos_total", "neg_total")
    )


class KeywordHits:
    """Weighted hits per topic in one pass over title and content: distinct list entries that occur as substrings."""

    def __init__(self, keywords: tuple[tuple[str, ...], ...]) -> None:
        places: dict[str, list[int]] = {}
        for topic, listed in enumerate(keywords):
            for keyword in listed:
                places.setdefault(keyword, []).append(topic)
        self.topics = len(keywords)
        everywhere = places.pop("", [])
        self.always = np.bincount(np.array(everywhere, int), minlength=self.topics) * (TITLE_WEIGHT + 1)
        self.automaton = ahocorasick.Automaton()
        for number, keyword in enumerate(places):
            self.automaton.add_word(keyword, number)
        if places:
            self.automaton.make_automaton()
        self.of_keyword = list(places.values())

    def found(self, text: str) -> list[int]:
        """Topic of each entry that occurs."""
        if not self.of_keyword:
            return []
        return [topic for number in {n for _, n in self.automaton.iter(text)} for topic in self.of_keyword[number]]

    def count(self, title: str, content: str) -> np.ndarray:
        title_hits, content_hits = (np.bincount(np.array(self.found(t), int), minlength=self.topics) for t in (title, content))
        return (self.always + title_hits * TITLE_WEIGHT + content_hits).astype(np.int32)


def _scanned_hits(topics: TopicTable) -> Column:
    def hits(haystack: str, keywords: Column) -> Column:
        return F.size(F.filter(keywords, lambda k: F.contains(F.col(haystack), k)))

    lists = [literal_list(keywords) for keywords in topics.keywords.values()]
    return F.array(*[hits("_title", listed) * TITLE_WEIGHT + hits("_content", listed) for listed in lists])


def _automaton_hits(df: DataFrame, topics: TopicTable) -> Column:
    size = sum(len(k.encode()) for listed in topics.keywords.values() for k in listed)
    if size > MAX_KEYWORD_BYTES:
        raise ValueError(f"keywords of more than {MAX_KEYWORD_BYTES} bytes")
    shared = df.sparkSession.sparkContext.broadcast(tuple(topics.keywords.values()))

    @F.arrow_udf("array<int>")
    def hits(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        keywords = KeywordHits(shared.value)
        for titles, contents in columns:
            counts = [keywords.count(t.as_py(), c.as_py()) for t, c in zip(titles, contents)]
            ends = np.arange(0, keywords.topics * len(counts) + 1, keywords.topics, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*counts, np.zeros(0, np.int32)])))

    # Not deterministic by name only, so that the function runs once per row whatever is filtered above it.
    return hits.asNondeterministic()("_title", "_content")


def add_topic_scores(df: DataFrame, topics: TopicTable) -> DataFrame:
    """Adds ``topic_scores``: array of (neg_score, place, topic, score) of the topics that were hit.

    Hits are distinct list entries found as substrings of the folded text, the title counting three times.
    """
    few = sum(map(len, topics.keywords.values())) <= SCANNED
    sizes = F.array(*[F.lit(float(len(listed) or 1)) for listed in topics.keywords.values()])
    shares = F.zip_with("_hits", sizes, lambda hits, size: F.least(hits / size, F.lit(1.0)))
    names = literal_list(tuple(topics.keywords))
    entries = F.transform(
        "_shares",
        lambda share, place: F.struct(
            (-share).alias("neg_score"), place.alias("place"), F.get(names, place).alias("topic"), share.alias("score")
        ),
    )
    return (
        df.withColumns({"_title": ascii_fold(or_empty(F.col("title"))), "_content": ascii_fold(or_empty(F.col("content")))})
        .withColumn("_hits", _scanned_hits(topics) if few else _automaton_hits(df, topics))
        .withColumn("_shares", shares)
        .withColumn("topic_scores", F.filter(entries, lambda s: s["score"] > 0))
        .drop("_title", "_content", "_hits", "_shares")
    )


def _source_rule(source: Column, topics: TopicTable) -> Column:
    """(topic, score) of the first rule whose name part occurs in the source, else null."""
    name = F.lower(or_empty(source))
    return one_of(
        *[
            (name.contains(part), F.struct(F.lit(topic).alias("topic"), F.lit(score).alias("score")))
            for part, topic, score in topics.source_rules
        ],
        default=F.lit(None).cast("struct<topic:string,score:double>"),
    )


def add_topics(df: DataFrame, topics: TopicTable) -> DataFrame:
    """Adds ``topics``: one or two structs (topic, score, tagger), best first.

    A rule topic already scored keeps its place with the larger score; otherwise it is appended and loses a tie.
    """
    rule = F.col("_rule")
    known = F.exists(F.col("topic_scores"), lambda s: s["topic"] == rule["topic"])

    def entry(score: Column, place: Column, topic: Column) -> Column:
        return F.struct(
            (-score).alias("neg_score"), place.alias("place"), topic.alias("topic"), score.alias("score")
        )

    raised = F.transform(
        F.col("topic_scores"),
        lambda s: entry(
            F.when(s["topic"] == rule["topic"], F.greatest(s["score"], rule["score"])).otherwise(s["score"]),
            s["place"],
            s["topic"],
        ),
    )
    appended = F.array(entry(rule["score"], F.lit(len(topics.keywords)), rule["topic"]))
    candidates = one_of(
        (rule.isNull(), F.col("topic_scores")),
        (known, raised),
        default=F.concat(F.col("topic_scores"), appended),
    )

    def tagged(place: int) -> Column:
        chosen = F.col("_ranked")[place]
        by_rule = (chosen["topic"] == rule["topic"]) & (chosen["score"] == rule["score"]) if place == 0 else F.lit(False)
        tagger = F.when(F.coalesce(by_rule, F.lit(False)), "source_rule").otherwise("keyword")
        return F.struct(chosen["topic"].alias("topic"), chosen["score"].alias("score"), tagger.alias("tagger"))

    fallback = F.struct(
        F.lit(FALLBACK_TOPIC).alias("topic"), F.lit(FALLBACK_SCORE).alias("score"), F.lit("keyword_default").alias("tagger")
    )
    size = F.size("_ranked")
    return (
        add_topic_scores(df, topics)
        .withColumn("_rule", _source_rule(F.col("source"), topics))
        .withColumn("_ranked", F.slice(F.array_sort(candidates), 1, 2))
        .withColumn(
            "topics",
            one_of(
                (size == 0, F.array(fallback)),
                (
                    (size == 2) & (F.try_element_at("_ranked", F.lit(2))["score"] >= SECOND_TOPIC_FLOOR),
                    F.array(tagged(0), tagged(1)),
                ),
                default=F.array(tagged(0)),
            ),
        )
        .drop("_ranked", "_rule", "topic_scores")
    )


def add_topic_columns(df: DataFrame, topics: TopicTable) -> DataFrame:
    """Adds topic_1, topic_1_score, topic_2, topic_2_score; an absent second topic is empty with score 0."""

    def part(place: int, field: str, default: object) -> Column:
        return F.coalesce(F.get("topics", F.lit(place))[field], F.lit(default))

    return (
        add_topics(df, topics)
        .withColumns(
            {
                "topic_1": part(0, "topic", ""),
                "topic_1_score": part(0, "score", 0.0),
                "topic_2": part(1, "topic", ""),
                "topic_2_score": part(1, "score", 0.0),
            }
        )
        .drop("topics")
    )
