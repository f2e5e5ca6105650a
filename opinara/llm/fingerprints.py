"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases level by level. Runs of one symbol become one symbol. Deterministic coin tossing then gives
every symbol a label from its own and its left neighbour's bits (twice the lowest differing bit, plus that bit's value); four
rounds leave six labels. Phrases start at local maxima of the labels, so where they start depends on a few neighbours only.
A phrase's name is a hash of its symbols, and the names are the symbols of the next level. Equal substrings hence share all
phrases but those at their ends, wherever they stand.

A fingerprint is the name of the whole text (16 hex digits) and, for each of 128 bins of the names from level 2 on, 16 bits
of the smallest name (4 hex digits, 0000: none). The likeness of two fingerprints is the share of equal bins among those that
either fills, an estimate of the Jaccard similarity of the name sets.

Cases: a null or empty text has an empty set of names; two such texts are alike (1), and a text without names is unlike any
other (0). Equal texts have equal fingerprints. Order for the next document is descending key, nulls last, then text; the
last is followed by the first, and a single row by itself. Repeated rows count each. Only key and text are read; the key is an
integer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.flat import mix

LEVELS, FIRST_LEVEL = 4, 2
BINS = 128
CHUNK_CHARS = 1 << 19
_LEAST = -(1 << 63)
_ONE, _ODD = np.uint64(1), np.uint64(0x9E3779B97F4A7C15)


def _toss_table() -> np.ndarray:
    """Label from a symbol and its left neighbour, both under 128; equal ones give the symbol's last bit."""
    x = np.arange(128)
    differ = x[:, None] ^ x[None, :]
    low = np.where(differ > 0, np.log2(np.maximum(differ & -differ, 1)).astype(int), 0)
    return (2 * low + ((x[:, None] >> low) & 1)).astype(np.uint8).ravel()


TOSS = _toss_table()


def _labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels under 6 of each symbol; ``first`` marks where texts start. Neighbours within a text differ."""
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[first] = ~symbols[first]
    differ = symbols ^ left
    low_bit = differ & (~differ + _ONE)
    low = ((low_bit.astype(np.float64).view(np.int64) >> 52) - 1023).clip(0).astype(np.uint64)
    labels = (low * np.uint64(2) + ((symbols >> low) & _ONE)).astype(np.int16)
    for _ in range(3):
        left = np.empty_like(labels)
        left[1:] = labels[:-1]
        left[first] = labels[first] ^ 1
        labels = TOSS[labels * 128 + left].astype(np.int16)
    return labels


def _collapse(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of one symbol within a text becomes one symbol; returns symbols and new starts."""
    new = np.empty(len(symbols), bool)
    new[0] = True
    new[1:] = symbols[1:] != symbols[:-1]
    new[starts] = True
    if new.all():
        return symbols, starts
    places = np.flatnonzero(new)
    lengths = np.diff(np.append(places, len(symbols)))
    kept = symbols[places]
    long = lengths > 1
    kept[long] = mix(kept[long] + lengths[long].astype(np.uint64) * _ODD)
    return kept, np.searchsorted(places, starts)


def _phrases(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the next level and where the texts start in them. Texts are not empty."""
    symbols, starts = _collapse(symbols, starts)
    labels = _labels(symbols, starts)
    peak = np.zeros(len(symbols), bool)
    peak[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    peak[starts[1:] - 1] = False  # a text's last symbol starts no phrase unless it is the only one
    peak[starts] = True
    places = np.flatnonzero(peak)
    lengths = np.diff(np.append(places, len(symbols)))
    offset = np.arange(len(symbols)) - np.repeat(places, lengths)
    parts = (symbols ^ (offset.astype(np.uint64) * _ODD)) * np.uint64(0xD6E8FEB86659FD93)
    parts ^= parts >> np.uint64(32)
    parts *= np.uint64(0xD6E8FEB86659FD93)
    return mix(np.add.reduceat(parts, places) + lengths.astype(np.uint64)), np.searchsorted(places, starts)


def parse(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Root name of each text and its sketch (texts x ``BINS``, 0: no name)."""
    roots, sketches = np.zeros(len(texts), np.uint64), np.zeros((len(texts), BINS), np.uint16)
    sizes = np.array([len(t) for t in texts], np.int64)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return roots, sketches
    symbols = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = (np.cumsum(sizes) - sizes)[filled]
    found = []
    for level in range(1, LEVELS + 1):
        symbols, starts = _phrases(symbols, starts)
        if level >= FIRST_LEVEL:
            owner = np.repeat(np.arange(len(filled)), np.diff(np.append(starts, len(symbols))))
            names = mix(symbols + np.uint64(level))
            found.append((((owner.astype(np.uint64) << np.uint64(7)) | (names >> np.uint64(57))) << np.uint64(32)) | ((names >> np.uint64(20)) & np.uint64(0xFFFFFFFF)))
    sizes_above = np.diff(np.append(starts, len(symbols)))
    place = np.arange(len(symbols)) - np.repeat(starts, sizes_above)
    roots[filled] = mix(np.add.reduceat(mix(symbols ^ mix(place.astype(np.uint64))), starts) + sizes[filled].astype(np.uint64))
    keys = np.sort(np.concatenate(found))
    slot = (keys >> np.uint64(32)).astype(np.int64)
    first = np.append(True, slot[1:] != slot[:-1])
    inner = np.zeros(len(filled) * BINS, np.uint16)
    inner[slot[first]] = ((keys[first] & np.uint64(0xFFFFFFFF)) % np.uint64(65535) + _ONE).astype(np.uint16)
    sketches[filled] = inner.reshape(-1, BINS)
    return roots, sketches


def fingerprint(root: np.uint64, sketch: np.ndarray) -> str:
    return f"{int(root):016x}" + sketch.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of sketches, row by row."""
    filled = ((a != 0) | (b != 0)).sum(axis=1)
    equal = ((a == b) & (a != 0)).sum(axis=1)
    return np.where(filled > 0, equal / np.maximum(filled, 1), 1.0)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_chars`` and ``fingerprint`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches, lambda row: len(row[1])):
            texts = [t for _, t in rows]
            found = [fingerprint(*x) for x in zip(*parse(texts))]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array(list(map(len, texts)), pa.int64()), pa.array(found, pa.string())], ["key", "n_chars", "fingerprint"])

    rows = docs.select(docs[key].cast("long").alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"))
    return rows.mapInArrow(run, "key long, n_chars long, fingerprint string").withColumnRenamed("key", key)


def _chunks(batches: Iterable[pa.RecordBatch], size) -> Iterator[list[tuple]]:
    """Rows as tuples, in lists of about ``CHUNK_CHARS`` characters."""
    rows, held = [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            for row in zip(*(c.to_pylist() for c in batch.slice(first, 256).columns)):
                rows.append(row)
                held += size(row)
                if held >= CHUNK_CHARS:
                    yield rows
                    rows, held = [], 0
    if rows:
        yield rows


def edited(text: str, following: str) -> str:
    """The last third of the code points (rounded down) replaced by the first as many of the next text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _bucket(value: Column, bounds: list[int]) -> Column:
    """Number of bounds below ``value`` (bounds ascend), by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b).cast("long") for b in bounds])

    def step(state: Column, _: Column) -> Column:
        middle = F.floor((state.low + state.high) / 2).cast("int")
        below = (state.low < state.high) & (F.get(table, middle) < value)
        return F.struct(
            F.when(below, middle + 1).otherwise(state.low).alias("low"),
            F.when((state.low < state.high) & ~below, middle).otherwise(state.high).alias("high"),
        )

    rounds = F.sequence(F.lit(0), F.lit(len(bounds).bit_length()))
    return F.aggregate(rounds, F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high")), step, lambda s: s.low)


def in_order_with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows dealt by ranges of the key into partitions sorted as stated above; columns home, guest, key, text.

    The first row of a range is also sent to the range before it as its guest (the very first to the last range), so each
    partition holds what follows its last row. Only the bounds and first keys of the ranges, one per partition, reach the
    driver; texts are shuffled once.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[key].cast("long").alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"))
    rows = rows.withColumn("rank", F.coalesce("key", F.lit(_LEAST)))
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("rank", F.array(*map(F.lit, shares)), F.lit(10 * parts)).alias("x")).first().x if shares else []
    bounds = sorted(set(found or []))
    placed = rows.withColumn("home", _bucket(F.col("rank"), bounds))
    heads = {r.home: r.head for r in placed.groupBy("home").agg(F.max("rank").alias("head")).collect()}
    filled = sorted(heads)
    before = dict(zip(filled, [*filled[1:], *filled[:1]]))
    head = F.get(F.array(*[F.lit(heads.get(i)).cast("long") for i in range(len(bounds) + 1)]), F.col("home"))
    goes = F.get(F.array(*[F.lit(before.get(i)).cast("int") for i in range(len(bounds) + 1)]), F.col("home"))

    def place(home: Column, guest: bool) -> Column:
        return F.struct(home.alias("home"), F.lit(guest).alias("guest"))

    places = F.when(F.col("rank") == head, F.array(place(F.col("home"), False), place(goes, True))).otherwise(
        F.array(place(F.col("home"), False))
    )
    dealt = placed.select("key", "rank", "text", F.explode(places).alias("place")).select("place.*", "key", "rank", "text")
    dealt = dealt.repartitionById(len(bounds) + 1, F.col("home"))
    return dealt.sortWithinPartitions("guest", F.desc("rank"), F.col("key").isNull(), "text").select("guest", "key", "text")


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every row, of its edited text (see ``edited``), and likeness to that and to the next document."""

    def answer(rows: list[tuple[bool, int, str]]) -> pa.RecordBatch:
        """Results of all rows but the last, which is only what follows."""
        keys, texts = [r[1] for r in rows], [r[2] for r in rows]
        changed = [edited(*x) for x in zip(texts, texts[1:])]
        n = len(changed)
        roots, sketches = parse(texts + changed)
        prints = [fingerprint(*x) for x in zip(roots, sketches)]
        hashes = [hashlib.sha256(x.encode("utf-8")).hexdigest() for x in changed]
        columns = [
            pa.array(keys[:n], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()), pa.array(hashes, pa.string()),
            pa.array(prints[:n], pa.string()), pa.array(prints[n + 1 :], pa.string()),
            pa.array(likeness(sketches[:n], sketches[n + 1 :])), pa.array(likeness(sketches[:n], sketches[1 : n + 1])),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        ended = False
        for rows in _chunks(batches, lambda row: len(row[2])):
            if ended:
                continue
            guest = next((i for i, r in enumerate(rows) if r[0]), None)
            if guest is not None:  # only the first guest follows
                rows, ended = rows[: guest + 1], True
            rows = held + rows
            if len(rows) > 1:
                yield answer(rows)
            held = rows[-1:]

    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    fields = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_order_with_next(docs, key, text).mapInArrow(run, fields).withColumnRenamed("key", key)
