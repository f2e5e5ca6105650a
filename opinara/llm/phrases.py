"""Collocations: phrases of two and three words that stand together more often than their parts explain, per group of documents.

Texts are cut at punctuation and line ends into pieces, and these at blanks and tabs into words (A-Z folded). ``f`` counts the
occurrences of a phrase within pieces, overlaps included. A phrase of ``least`` occurrences or more is a candidate; of the ways
to cut it in two, the one with the smallest score 1000000 * f * f / (f(first part) * f(rest)), rounded down, counts. A candidate
inside a longer one that has at least half its occurrences is dropped. The best ``top`` of each group are returned.

Counting. Words are counted by text. A phrase can only be frequent if its parts are, so from one level to the next only places
are asked whose parts passed: tasks test them against bit sets of a fixed size, made of the parts that passed, and add up 32-bit
codes of the words of a phrase. Bit sets and codes can confuse words, never lose one, so these sums are upper bounds and the
phrases that reach ``least`` hold all candidates. One more scan takes the word hashes of the places that begin a candidate, as the
bit sets tell. Places and candidates are dealt by their first two words, so a place meets the one task that holds its candidates,
however many there are. That task makes its candidates, about ``MAX_KEYS`` at most, a double-array trie over word codes, two symbols
a word, advances the states of many places at once, word by word, and counts the states they reach: the exact counts. Two words of
a group with one 64-bit hash would spoil that: the word table is checked, and the corpus is hashed with another seed if there are any.

Tasks add up in batches before each shuffle, so a word or phrase that is everywhere is a row per batch. Texts are read four
times and never shuffled.

Cases: null and empty texts have no words. Rows with a null group form the group ``unknown``. Repeated rows count as often as
they stand there. Ties are ordered by phrase, in byte order. Texts are read whole. Empty tables and groups without candidates
give no rows. Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.flat import BASE, HashTable, Slice, WordHasher, mix, slices
from opinara.operators.skew import top_per_group
from opinara.storage import stage

# What ends a piece, what parts words, the share of a longer phrase that drops a shorter one.
CUTS = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
BLANKS = np.isin(np.arange(256), list(b" \t"))
INSIDE_PERCENT = 50

BITS = 26  # of a bit set: 8 MB
MAX_KEYS = 1 << 20  # about 20 MB as a trie
PACKED = 1 << 14  # places in a row
WALKED = 1 << 18  # places advanced at once
PIECE = 1 << 20  # bytes of a trie in a row
LOW_BITS = 9
PENDING = 1 << 22  # places that a task adds up at once
BIG_NODE = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words(NamedTuple):
    """Words of a slice: hashes (group included), bytes, document, and whether the next word follows in the same piece."""

    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    joined: np.ndarray


def words_of(part: Slice, hasher: WordHasher, seed: int) -> Words:
    begin, end = hasher.spans(part.data, part.starts)
    doc = np.searchsorted(part.starts, begin, "right") - 1
    groups = part.rows["group"].dictionary_encode()
    seeds = np.array([xxhash.xxh64_intdigest(g.encode(), seed) for g in groups.dictionary.to_pylist()] or [0], np.uint64)
    hashes = mix(hasher.hashes(part.data, begin, end) ^ seeds[groups.indices.to_numpy()[doc]])
    cuts = np.concatenate([[0], np.cumsum(CUTS[part.data])])
    joined = np.zeros(len(begin), bool)
    joined[:-1] = (doc[:-1] == doc[1:]) & (cuts[end[:-1]] == cuts[begin[1:]])
    return Words(hashes, begin, end, doc, joined)


def _new_hasher(seed: int) -> WordHasher:
    hasher = WordHasher(separators=CUTS | BLANKS)
    hasher.values = mix(hasher.values + np.uint64(seed))
    return hasher


def _strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """The given spans, A-Z folded."""
    ends = np.cumsum(end - begin)
    take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - (end - begin)), end - begin)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[take]]))


def _count_words(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    hasher = _new_hasher(seed)
    for part in slices(batches):
        words = words_of(part, hasher, seed)
        hashes, at, n = np.unique(words.hashes, return_index=True, return_counts=True)
        columns = [
            part.rows["group"].take(pa.array(words.doc[at])), _strings(part.data, words.begin[at], words.end[at]),
            pa.array(hashes.astype(np.int64)), pa.array(n.astype(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["group", "word", "hash", "n"])


def word_counts(rows: DataFrame, max_seeds: int = 8, count=_count_words) -> tuple[DataFrame, int]:
    """group, word, hash and n of every word, and the seed under which no two words share a hash."""
    for seed in range(max_seeds):
        counted = rows.mapInArrow(lambda b, s=seed: count(b, s), "group string, word string, hash long, n long")
        words = stage(counted.groupBy("group", "word", "hash").agg(F.sum("n").alias("n")), "words")
        if words.groupBy("hash").count().filter("count > 1").isEmpty():
            return words, seed
    raise RuntimeError("words share hashes under every seed")


def bit_set(bits: DataFrame) -> np.ndarray:
    """Set of the numbers in the column ``bit``, all below 2 ** BITS; at most 2 ** (BITS - 6) rows reach the driver."""
    parts = bits.groupBy(F.expr("shiftright(bit, 6)").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("bits"))
    table = parts.toArrow()
    found = np.zeros(1 << (BITS - 6), np.int64)
    found[table["at"].to_numpy()] = table["bits"].to_numpy()
    return found.view(np.uint64)


def _holds(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    numbers = numbers.astype(np.uint64)
    return (bits[(numbers >> np.uint64(6)).astype(np.int64)] >> (numbers & np.uint64(63))) & np.uint64(1) == 1


TURNS = (0, 13, 22)


def _phrase_bits(*codes: np.ndarray) -> np.ndarray:
    """Number of two or three 32-bit codes below 2 ** BITS; ``_phrase_bit`` is the same in SQL."""
    turned = [(c << np.uint32(t)) | (c >> np.uint32(32 - t)) if t else c for c, t in zip(codes, TURNS)]
    return reduce(np.bitwise_xor, turned) >> np.uint32(32 - BITS)


def _phrase_bit(n: int) -> Column:
    code = [f"(w{i + 1} & 4294967295)" for i in range(n)]
    turned = [f"((shiftleft({c}, {t}) & 4294967295) | shiftright({c}, {32 - t}))" for c, t in zip(code, TURNS)]
    return F.expr(f"shiftright({' ^ '.join(turned)}, {32 - BITS})").alias("bit")


def _runs(key: np.ndarray, columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows as one with their number, in the order of ``key``, which tells most rows apart; those it confuses may come again."""
    order = np.argsort(key)
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.diff(at, append=len(order)).astype(np.int64)


def _added_up(columns: list[np.ndarray]) -> pa.RecordBatch:
    """Rows of 32-bit codes, equal ones as one with their number."""
    key = (columns[0].astype(np.uint64) << np.uint64(32)) | columns[1]
    if len(columns) == 3:
        key ^= columns[2] * np.uint64(BASE)
    columns, n = _runs(key, columns)
    return pa.RecordBatch.from_arrays([*(pa.array(c.view(np.int32)) for c in columns), pa.array(n)], [*(f"w{i + 1}" for i in range(len(columns))), "n"])


def _starts(words: Words, codes: np.ndarray, frequent: np.ndarray, pairs: np.ndarray | None) -> np.ndarray:
    """Places of words that begin a pair of frequent words; with ``pairs``, a frequent pair."""
    fine = _holds(frequent, words.hashes >> np.uint64(64 - BITS))
    start = np.flatnonzero(words.joined[:-1] & fine[:-1] & fine[1:])
    return start if pairs is None else start[_holds(pairs, _phrase_bits(codes[start], codes[start + 1]))]


def _candidates(batches: Iterator[pa.RecordBatch], seed: int, frequent: np.ndarray, pairs: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Pairs of frequent words; with ``pairs``, triples of frequent pairs."""
    hasher, found, held = _new_hasher(seed), [], 0
    for part in slices(batches):
        words = words_of(part, hasher, seed)
        codes = (words.hashes >> np.uint64(32)).astype(np.uint32)
        start = _starts(words, codes, frequent, pairs)
        if pairs is not None:
            start = start[np.isin(start + 1, start, assume_unique=True)]
        found.append([codes[start + i] for i in range(2 if pairs is None else 3)])
        held += len(start)
        if held > PENDING:
            yield _added_up([np.concatenate(c) for c in zip(*found)])
            found, held = [], 0
    if held:
        yield _added_up([np.concatenate(c) for c in zip(*found)])


def _part(first: np.ndarray, second: np.ndarray, parts: int) -> np.ndarray:
    """Part to which the phrases with these first two words belong; ``_PART`` is the same in SQL."""
    return (first ^ (second >> np.uint64(7))).view(np.int64) % parts


_PART = "cast(pmod(x1 ^ shiftrightunsigned(x2, 7), {}) AS int)"


def _places(batches: Iterator[pa.RecordBatch], seed: int, frequent: np.ndarray, pairs: np.ndarray, triples: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Hashes of the words from each place on that begins a candidate, the third only where it belongs to one, equal places as one.
    A row holds up to ``PACKED`` places of a part."""
    hasher, found, held = _new_hasher(seed), [], 0
    for part in slices(batches):
        words = words_of(part, hasher, seed)
        codes = (words.hashes >> np.uint64(32)).astype(np.uint32)
        start = _starts(words, codes, frequent, pairs)
        further = np.flatnonzero(np.isin(start + 1, start, assume_unique=True))
        at = start[further]
        further = further[_holds(triples, _phrase_bits(codes[at], codes[at + 1], codes[at + 2]))]
        three = np.zeros(len(start), bool)
        three[further] = True
        third = np.zeros(len(start), np.uint64)
        third[further] = words.hashes[start[further] + 2]
        found.append([words.hashes[start], words.hashes[start + 1], third, three])
        held += len(start)
        if held > PENDING:
            yield _packed([np.concatenate(c) for c in zip(*found)], parts)
            found, held = [], 0
    if held:
        yield _packed([np.concatenate(c) for c in zip(*found)], parts)


def _packed(columns: list[np.ndarray], parts: int) -> pa.RecordBatch:
    (first, second, third, three), n = _runs(columns[0] ^ (columns[1] >> np.uint64(7)) ^ (columns[2] >> np.uint64(17)), columns)
    part = _part(first, second, parts)
    order = np.argsort(part)
    part = part[order]
    begin = np.union1d(np.flatnonzero(np.diff(part, prepend=-1)), np.arange(0, len(part), PACKED))
    ends = pa.array(np.append(begin, len(part)).astype(np.int32))
    values = [pa.array(first[order].view(np.int64)), pa.array(second[order].view(np.int64)), pa.array(third[order].view(np.int64), mask=~three[order]), pa.array(n[order])]
    return pa.RecordBatch.from_arrays([pa.array(part[begin].astype(np.int32)), *(pa.ListArray.from_arrays(ends, v) for v in values)], ["part", "x1", "x2", "x3", "n"])


def _frequent(rows: DataFrame, least: int, run, n_codes: int) -> DataFrame:
    """Phrases by codes whose sum reaches ``least``. Tasks have added up already, so no partial sums are built again."""
    codes = [f"w{i + 1}" for i in range(n_codes)]
    counted = rows.mapInArrow(run, ", ".join(f"{c} int" for c in codes) + ", n long").repartition(*codes)
    return counted.groupBy(*codes).agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select(*codes)


class PhraseTrie:
    """Double array over phrases of two and three word hashes: ``check[base[s] + symbol] == s`` is the step from state s.

    State 1 + code is the first word with that code. Each further word is two symbols, the high and the low bits of its code;
    frequent followers have small codes, so that nodes with many children are dense.
    """

    def __init__(self, alphabet: np.ndarray, codes: np.ndarray, base: np.ndarray, check: np.ndarray) -> None:
        self.alphabet, self.codes, self.base, self.check = alphabet, codes, base, check

    @classmethod
    def build(cls, phrases: np.ndarray, sizes: np.ndarray) -> tuple[PhraseTrie, np.ndarray]:
        """The trie of rows of three hashes (the third is not read where the size is 2), and the state of each row."""
        three = sizes == 3
        alphabet = np.unique(np.concatenate([phrases[:, 0], phrases[:, 1], phrases[three, 2]]))
        place = np.searchsorted(alphabet, phrases).clip(max=max(len(alphabet) - 1, 0))
        followers = np.bincount(np.concatenate([place[:, 1], place[three, 2]]), minlength=len(alphabet))
        codes = np.empty(len(alphabet), np.int64)
        codes[np.argsort(-followers, kind="stable")] = np.arange(len(alphabet))
        rows = codes[place]
        trie = cls(alphabet, codes, np.zeros(0, np.int32), np.zeros(0, np.int32))
        trie._rng = np.random.default_rng(7)
        trie._grow(1 + len(alphabet))
        trie._first = trie._top = 1 + len(alphabet)
        trie.check[1 + rows[:, 0]] = 0
        state = trie._add(1 + rows[:, 0], rows[:, 1])
        state[three] = trie._add(state[three], rows[three, 2])
        last = int(np.flatnonzero(trie.check >= 0).max(initial=0)) + 1
        trie.base, trie.check = trie.base[:last], trie.check[:last]
        return trie, state

    def _grow(self, size: int) -> None:
        more = max(size - len(self.base), 0)
        self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
        self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def _add(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        low = (1 << LOW_BITS) - 1
        return self._place(self._place(states, codes >> LOW_BITS), codes & low)

    def _place(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Gives the children of each parent their states; returns the state of each row's child."""
        steps, inverse = np.unique((parents.astype(np.int64) << 32) | symbols, return_inverse=True)
        if not len(steps):
            return np.zeros(0, np.int64)
        parent, symbol = steps >> 32, steps & 0xFFFFFFFF
        first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        sizes = np.diff(np.append(first, len(steps)))
        group = np.repeat(np.arange(len(first)), sizes)
        base = np.zeros(len(first), np.int64)
        # Nodes with many children get a stretch of their own, whose gaps others can use.
        span = symbol[first + sizes - 1] - symbol[first] + 1
        big = np.flatnonzero(sizes > BIG_NODE)
        base[big] = self._top + np.cumsum(span[big]) - span[big] - symbol[first[big]]
        self._top += int(span[big].sum())
        small = int(sizes[sizes <= BIG_NODE].sum())
        limit = self._top + small + small // 3 + 16
        self._grow(limit + int(symbol.max()) + 1)
        self._settle(np.isin(group, big), parent, base[group] + symbol)
        # The others are tried at random places, large ones first, until all their children find free states.
        for least, most in ((33, BIG_NODE), (9, 32), (3, 8), (1, 2)):
            todo, tries = np.flatnonzero((sizes >= least) & (sizes <= most)), 0
            while len(todo):
                tries += 1
                if tries % 64 == 0:
                    limit += small // 4 + 16
                    self._grow(limit + int(symbol.max()) + 1)
                base[todo] = self._rng.integers(self._first, limit, len(todo)) - symbol[first[todo]]
                waiting = np.zeros(len(first), bool)
                waiting[todo] = True
                rows = np.flatnonzero(waiting[group])
                slots = base[group[rows]] + symbol[rows]
                fits = self.check[slots] == -1
                once = np.zeros(len(rows), bool)
                once[np.unique(slots, return_index=True)[1]] = True
                fails = np.bincount(group[rows], weights=~(fits & once), minlength=len(first)) > 0
                settled = waiting & ~fails
                self._settle(settled[group], parent, base[group] + symbol)
                todo = np.flatnonzero(waiting & fails)
        slots = base[group] + symbol
        self._top = max(self._top, limit, int(slots.max()) + 1)  # the last children of a node may stand beyond the limit
        self.base[parent[first]] = base
        return slots[inverse]

    def _settle(self, rows: np.ndarray, parent: np.ndarray, slots: np.ndarray) -> None:
        self.check[slots[rows]] = parent[rows]

    def code_of(self, hashes: np.ndarray, table: HashTable) -> np.ndarray:
        """Codes of words, -1 for those in no phrase."""
        found = table.find(hashes)
        return np.where(found >= 0, self.codes[found], -1) if len(self.codes) else found

    def _step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        to = self.base[states].astype(np.int64) + symbols
        inside = (to >= 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return to, inside & (self.check[to] == states)

    def reached(self, codes: np.ndarray, joined: np.ndarray) -> list[np.ndarray]:
        """States of all places after two words, and after three."""
        return [states for _, states in self.walked(np.flatnonzero(codes >= 0), codes, joined)]

    def walked(self, at: np.ndarray, codes: np.ndarray, joined: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The places of ``at`` that are in the trie with their states after two words, and after three."""
        states = 1 + codes[at]
        alive = self.check[states] == 0
        at, states, found = at[alive], states[alive], []
        for ahead in (1, 2):
            goes = joined[at + ahead - 1]
            at, states = at[goes], states[goes]
            goes = codes[at + ahead] >= 0
            at, states = at[goes], states[goes]
            code = codes[at + ahead]
            states, alive = self._step(states, code >> LOW_BITS)
            at, states, code = at[alive], states[alive], code[alive]
            states, alive = self._step(states, code & ((1 << LOW_BITS) - 1))
            at, states = at[alive], states[alive]
            found.append((at, states))
        return found

    def to_pieces(self) -> list[bytes]:
        out = io.BytesIO()
        np.savez(out, alphabet=self.alphabet, codes=self.codes.astype(np.int32), base=self.base, check=self.check)
        return [bytes(out.getbuffer()[i : i + PIECE]) for i in range(0, out.tell(), PIECE)]

    @classmethod
    def from_pieces(cls, pieces: list[bytes]) -> PhraseTrie:
        held = np.load(io.BytesIO(b"".join(pieces)))
        return cls(held["alphabet"], held["codes"].astype(np.int64), held["base"], held["check"])


def _hashes(rows: pa.Table) -> list[np.ndarray]:
    """The columns x1 to x3 of packed rows, 0 for a missing third word."""
    return [rows[c].combine_chunks().flatten().fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("x1", "x2", "x3")]


def _three(rows: pa.Table) -> np.ndarray:
    return rows["x3"].combine_chunks().flatten().is_valid().to_numpy(zero_copy_only=False)


def _count_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id and a of the candidates of a part, in which they come before the places."""
    keys, waiting, held, trie = [], [], 0, None
    for batch in batches:
        first = batch.num_rows - batch["id"].null_count
        if first:
            keys.append(batch.slice(0, first))
        if first == batch.num_rows or not keys:  # places that only seemed to begin a candidate may be alone
            continue
        if trie is None:
            table = pa.Table.from_batches(keys)
            trie, states = PhraseTrie.build(np.stack(_hashes(table), axis=1), np.where(_three(table), 3, 2))
            known, counts, ids = HashTable(trie.alphabet), np.zeros(len(trie.check), np.int64), table["id"]
        waiting.append(batch.slice(first))
        held += len(waiting[-1]["x1"].flatten())
        if held > WALKED:
            _walk(trie, known, counts, waiting)
            waiting, held = [], 0
    if trie is not None:
        if held:
            _walk(trie, known, counts, waiting)
        yield from pa.table({"id": ids, "a": counts[states]}).filter(pc.field("a") > 0).to_batches(1 << 18)


def _walk(trie: PhraseTrie, known: HashTable, counts: np.ndarray, batches: list[pa.RecordBatch]) -> None:
    """Adds the states that places reach, each as often as its row says."""
    rows = pa.Table.from_batches(batches)
    codes = np.stack([trie.code_of(hashes, known) for hashes in _hashes(rows)], axis=1)
    joined = np.ones(codes.shape, bool)
    joined[:, 1] = _three(rows)
    n = rows["n"].combine_chunks().flatten().to_numpy()
    for at, states in trie.walked(3 * np.flatnonzero(codes[:, 0] >= 0), codes.ravel(), joined.ravel()):
        np.add.at(counts, states, n[at // 3])


def phrase_counts(docs: DataFrame, text: str = "text", group: str = "lang", least: int = 10, unknown: str = "und", max_keys: int = MAX_KEYS) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): group, word, hash and n of all words; group, phrase, x1 to x3 (hashes of the words) and a of all phrases
    of two and three words with ``least`` occurrences or more."""
    rows = docs.select(F.coalesce(docs[group].cast("string"), F.lit(unknown)).alias("group"), docs[text].alias("text"))
    spark = docs.sparkSession
    words, seed = word_counts(rows)
    often = words.filter(F.col("n") >= least).select("group", "word", "hash", F.expr("cast(shiftright(hash, 32) AS int)").alias("w"))
    frequent = spark.sparkContext.broadcast(bit_set(often.select(F.expr(f"shiftrightunsigned(hash, {64 - BITS})").alias("bit"))))
    pairs = stage(_frequent(rows, least, lambda b: _candidates(b, seed, frequent.value, None), 2), "pairs")
    fine = spark.sparkContext.broadcast(bit_set(pairs.select(_phrase_bit(2))))
    triples = stage(_frequent(rows, least, lambda b: _candidates(b, seed, frequent.value, fine.value), 3), "triples")
    whole = spark.sparkContext.broadcast(bit_set(triples.select(_phrase_bit(3))))

    def named(codes: DataFrame, n: int) -> DataFrame:
        """Codes back to words; codes that several words share give several phrases, which the exact count sorts out."""
        for i in range(1, n + 1):
            word = often.select(F.col("w").alias(f"w{i}"), F.col("group").alias(f"g{i}"), F.col("word").alias(f"t{i}"), F.col("hash").alias(f"x{i}"))
            codes = codes.join(word, f"w{i}")
            if i > 1:
                codes = codes.filter(F.col("g1") == F.col(f"g{i}")).drop(f"g{i}")
        last = F.col("x3") if n == 3 else F.lit(None).cast("long")
        return codes.select(F.col("g1").alias("group"), F.concat_ws(" ", *(f"t{i}" for i in range(1, n + 1))).alias("phrase"), "x1", "x2", last.alias("x3"))

    keys = named(pairs, 2).unionByName(named(triples, 3)).withColumn("id", F.monotonically_increasing_id())
    keys = stage(keys, "phrases")
    size = keys.count()
    parts = max(-(-size // max_keys), min(size, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    if not parts:
        return words, keys.select("group", "phrase", "x1", "x2", "x3", F.lit(0).cast("long").alias("a"))
    held = "x1 array<long>, x2 array<long>, x3 array<long>, n array<long>"
    places = rows.mapInArrow(lambda b: _places(b, seed, frequent.value, fine.value, whole.value, parts), f"part int, {held}")
    packed = keys.select(F.expr(_PART.format(parts)).alias("part"), *(F.array(x).alias(x) for x in ("x1", "x2", "x3")), F.array(F.lit(0).cast("long")).alias("n"), "id")
    dealt = packed.unionByName(places.withColumn("id", F.lit(None).cast("long")))
    dealt = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions(F.col("id").isNull())
    counted = stage(dealt.mapInArrow(_count_phrases, "id long, a long"), "phrase_sums")
    for bits in (frequent, fine, whole):
        bits.destroy()
    exact = keys.join(counted, "id").filter(F.col("a") >= least)
    return words, stage(exact.select("group", "phrase", "x1", "x2", "x3", "a"), "phrase_counts")


def _score(left: str, right: str) -> Column:
    """1000000 * a * a / (left * right), rounded down, in whole numbers of up to 38 digits."""
    whole = lambda c: f"cast({c} AS decimal(14, 0))"
    return F.expr(f"(cast(1000000 AS decimal(7, 0)) * ({whole('a')} * {whole('a')})) div ({whole(left)} * {whole(right)})")


def collocations(docs: DataFrame, text: str = "text", group: str = "lang", least: int = 10, top: int = 2000, unknown: str = "und", max_keys: int = MAX_KEYS) -> DataFrame:
    """``group``, rank, phrase, a, l, r, n (words of the group) and score of the best phrases of each group."""
    words, phrases = phrase_counts(docs, text, group, least, unknown, max_keys)
    total = words.groupBy("group").agg(F.sum("n").alias("n"))
    single = words.select("hash", "n")
    first, last = single.toDF("x1", "f1"), single.toDF("x2", "f2")
    third = single.toDF("x3", "f3")
    pairs, triples = phrases.filter("x3 IS NULL"), phrases.filter("x3 IS NOT NULL")
    head = pairs.select("x1", "x2", F.col("a").alias("f12"))
    tail = pairs.select(F.col("x1").alias("x2"), F.col("x2").alias("x3"), F.col("a").alias("f23"))
    # A longer phrase with at least half the occurrences of a shorter one inside it drops that one.
    inside = triples.select("x1", "x2", "a").unionByName(triples.select(F.col("x2").alias("x1"), F.col("x3").alias("x2"), "a"))
    inside = inside.groupBy("x1", "x2").agg(F.max("a").alias("longer"))
    two = pairs.join(inside, ["x1", "x2"], "left").filter(F.coalesce(F.col("longer") * 100 < F.col("a") * INSIDE_PERCENT, F.lit(True)))
    two = two.join(first, "x1").join(last, "x2").select("group", "phrase", "a", F.col("f1").alias("l"), F.col("f2").alias("r"))
    three = triples.join(first, "x1").join(third, "x3").join(head, ["x1", "x2"]).join(tail, ["x2", "x3"])
    three = three.withColumns({"s1": _score("f1", "f23"), "s2": _score("f12", "f3")})
    early = F.col("s1") <= F.col("s2")
    three = three.select("group", "phrase", "a", F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"))
    scored = two.unionByName(three).withColumn("score", _score("l", "r"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    best = top_per_group(scored, ["group"], order, top, "phrase")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("group").orderBy(*order)))
    return best.join(total, "group").select(F.col("group").alias(group), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
