"""Repair of the turn structure of conversations by a run-length dynamic programme.

A conversation is well formed if its roles are an optional system turn and then pairs of user and assistant. Each of its rows is
kept (cost 0), given another role (user or assistant, 1) or deleted (2); empty user and assistant turns can be inserted anywhere
(5). Blank rows and rows that repeat an earlier one of the conversation (role and text) must go; a row whose text is cut off
(does not end in ``.``, ``!`` or ``?``) costs 5 more unless it is deleted. The cheapest edits are chosen; of several, the one whose
audit (initials of the edits in order) comes first in ASCII order. No two ways have one audit: what follows from an initial is
determined by the role before.

A row is a symbol: its role's initial and its fault. What a symbol does to the four states of a conversation (nothing yet, only
a system turn, last turn by the user, last turn by the assistant) is a matrix of costs; matrices multiply by minimum and sum.
Equal consecutive symbols are one run, and a run is passed by the binary powers of its matrix, which are cached. Choices are
then unrolled from the start with the costs of what remains.

A conversation may hold any share of the rows. Rows are put in order by a range partitioning of their keys without texts and
packed into chunks of at most ``CHUNK``; a chunk is one matrix and a few counts. Per conversation only chunks are combined: the
cost of what follows each chunk, then the state in which each begins. Then all chunks are unrolled at once. Equal rows are
counted before they are shuffled and stay a number in their chunk. Texts are joined to the rows that remain.

Cases: rows are ordered by turn (nulls first), role and a hash of the text, so ties have one result; equal rows are copies, of which
all but the first are duplicates. A null text is blank. A null or empty role and one with another initial must be changed or go.
Rows with a null conversation are one conversation. A conversation without rows is not in the result, an empty table gives empty
results. Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.storage import stage

# Costs of the edits, white space, ends of sentences.
RETAG, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
WHITE, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")

CHUNK = 4096
#: Results for at most so many runs are remembered: most conversations are short, and few of them differ in their symbols.
SHORT = 24
NONE, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 50
#: State after a turn that is inserted or given another role, by the state before.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Symbols: the role's initial (``o``: another), in capitals if the text is cut off; ``x`` for rows that must go.
GONE = "x"


def _closure() -> np.ndarray:
    """Cheapest insertions from state to state."""
    steps = np.full((4, 4), FAR)
    np.fill_diagonal(steps, 0)
    for before, after in enumerate(NEXT):
        steps[before, after] = INSERT
    return product(steps, steps)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of a matrix with a matrix or with a vector of costs to come."""
    return np.minimum((a[:, :, None] + b[None]).min(axis=1) if b.ndim == 2 else (a + b).min(axis=1), FAR)


def keeps(symbol: str, state: int) -> int | None:
    """State after a row that is kept, if it may be."""
    after = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(symbol.lower())
    fits = {SYSTEM: state == NONE, USER: state != USER, ASSISTANT: state == USER}
    return after if after is not None and fits[after] else None


def moves(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(initial, state after, cost) of what can be done with a row, by initial."""
    found = [("D", state, DELETE)]
    if symbol != GONE:
        extra = TRUNCATED if symbol.isupper() else 0
        if (after := keeps(symbol, state)) is not None:
            found.append(("K", after, extra))
        found.append(("R", NEXT[state], RETAG + extra))
    return found


CLOSURE = _closure()
#: Costs to come behind the last row: insertions until the conversation may end.
END = product(CLOSURE, np.array([0, FAR, FAR, 0]))


@lru_cache(maxsize=4096)
def power(symbol: str, bit: int) -> np.ndarray:
    """Matrix of a run of 2 ** ``bit`` equal symbols, with insertions before each."""
    if bit:
        half = power(symbol, bit - 1)
        return product(half, half)
    step = np.full((4, 4), FAR)
    for state in range(4):
        for _, after, cost in moves(symbol, state):
            step[state, after] = min(step[state, after], cost)
    return product(CLOSURE, step)


def across(symbol: str, length: int, ahead: np.ndarray) -> np.ndarray:
    """Costs to come before a run, from those behind it (or a matrix before, from one behind)."""
    bit = 0
    while length:
        if length & 1:
            ahead = product(power(symbol, bit), ahead)
        length >>= 1
        bit += 1
    return ahead


Runs = tuple[tuple[str, int], ...]


def matrix(runs: Runs) -> tuple[int, ...]:
    """Costs from each state before the runs to each state behind them."""
    return (_matrix if len(runs) <= SHORT else _matrix.__wrapped__)(runs)


@lru_cache(maxsize=1 << 14)
def _matrix(runs: Runs) -> tuple[int, ...]:
    total = np.full((4, 4), FAR)
    np.fill_diagonal(total, 0)
    for symbol, length in reversed(runs):
        total = across(symbol, length, total)
    return tuple(total.ravel().tolist())


def unroll(runs: Runs, ahead: tuple[int, ...], state: int, last: bool) -> tuple[str, int]:
    """Audit and final state of the cheapest way from ``state``; ``ahead``: costs to come behind the runs."""
    return (_unroll if len(runs) <= SHORT else _unroll.__wrapped__)(runs, ahead, state, last)


@lru_cache(maxsize=1 << 14)
def _unroll(runs: Runs, ahead: tuple[int, ...], state: int, last: bool) -> tuple[str, int]:
    borders = [np.array(ahead)]
    for symbol, length in reversed(runs):
        borders.append(across(symbol, length, borders[-1]))
    borders.reverse()
    audit: list[str] = []
    for (symbol, length), behind in zip(runs, borders[1:]):
        if symbol == GONE:  # a deletion costs the same now and later, and its initial comes first
            audit.append("D" * length)
            continue
        costs = [behind]
        for _ in range(length):
            costs.append(product(power(symbol, 0), costs[-1]))
        costs = [c.tolist() for c in costs]
        while length:
            here, after = costs[length], costs[length - 1]
            options = [(name, to, cost + after[to], 1) for name, to, cost in moves(symbol, state)]
            options.append(("I", NEXT[state], INSERT + here[NEXT[state]], 0))
            name, state, _, used = min(o for o in options if o[2] == here[state])
            audit.append(name)
            length -= used
    while last and state not in (NONE, ASSISTANT):
        state = NEXT[state]
        audit.append("I")
    return "".join(audit), state


def runs_of(symbols: str, copies: list[int]) -> Runs:
    """Runs of the rows of a chunk; further copies of a row must go."""
    pairs = [pair for symbol, n in zip(symbols, copies) for pair in ((symbol, 1), (GONE, n - 1)) if pair[1]]
    return tuple((symbol, sum(n for _, n in run)) for symbol, run in groupby(pairs, key=lambda p: p[0]))


_KEY = pa.struct([("k1", pa.int64()), ("k2", pa.int64())])
_CHUNK_FIELDS = "at bigint, conv {kind}, symbols string, copies array<bigint>, keys array<struct<k1:bigint,k2:bigint>>, costs array<bigint>, counts array<bigint>, edges string, turns array<bigint>"
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


class _Chunk:
    """Rows of one conversation, in order, up to ``CHUNK``."""

    def __init__(self, conv: object) -> None:
        self.conv, self.symbols, self.copies, self.keys = conv, [], [], []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = ""
        self.low = self.high = None

    def add(self, turn: int | None, initial: str, fault: str, fresh: bool, copies: int, key: tuple[int, int]) -> None:
        if fault == "blank":
            self.counts["blank"] += copies
        else:
            self.counts["duplicate"] += copies - fresh
            self.counts["truncated"] += fresh and fault == "truncated"
        stays = fresh and fault != "blank"
        self.symbols.append((initial.upper() if fault == "truncated" else initial) if stays else GONE)
        self.copies.append(copies)
        self.keys.append(key)
        self.counts["illegal"] += copies - 1 + (bool(self.last) and self.last + initial not in ("su", "ua", "au"))
        self.first, self.last = self.first or initial, initial
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.counts["turns"] += 1


def _pack(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Chunks of a partition in order."""
    from pyspark import TaskContext

    base, number, chunk, done = TaskContext.get().partitionId() << 40, 0, None, []

    def flush() -> pa.RecordBatch:
        nonlocal done, number
        fields = {
            "at": pa.array([base + number + i for i in range(len(done))], pa.int64()),
            "conv": pa.array([c.conv for c in done], kind),
            "symbols": pa.array(["".join(c.symbols) for c in done], pa.string()),
            "copies": pa.array([c.copies for c in done], pa.list_(pa.int64())),
            "keys": pa.array([c.keys for c in done], pa.list_(_KEY)),
            "costs": pa.array([matrix(runs_of("".join(c.symbols), c.copies)) for c in done], pa.list_(pa.int64())),
            "counts": pa.array([[int(c.counts[n]) for n in _COUNTS] for c in done], pa.list_(pa.int64())),
            "edges": pa.array([c.first + c.last for c in done], pa.string()),
            "turns": pa.array([[] if c.low is None else [c.low, c.high] for c in done], pa.list_(pa.int64())),
        }
        number += len(done)
        done = []
        return pa.RecordBatch.from_arrays(list(fields.values()), list(fields))

    for batch in batches:
        rows = zip(*(batch[c].to_pylist() for c in ("conv", "turn", "initial", "fault", "fresh", "n", "k1", "k2")))
        for conv, turn, initial, fault, fresh, n, k1, k2 in rows:
            if chunk is None or conv != chunk.conv or len(chunk.symbols) == CHUNK:
                if chunk is not None:
                    done.append(chunk)
                chunk = _Chunk(conv)
            chunk.add(turn, initial, fault, fresh, n, (k1, k2))
        if done:
            yield flush()
    if chunk is not None:
        done.append(chunk)
        yield flush()


_TOTALS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, ends array<struct<at:bigint,ahead:array<bigint>,first:boolean,last:boolean>>"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation, from its chunks in order: counts, cost, and the costs to come behind each chunk."""
    for batch in batches:
        columns: list[list] = [[] for _ in range(7)]
        for chunks in batch["chunks"].to_pylist():
            counts = dict(zip(_COUNTS, (sum(c["counts"][i] for c in chunks) for i in range(len(_COUNTS)))))
            turns = [c["turns"] for c in chunks if c["turns"]]
            for a, b in zip(chunks, chunks[1:]):
                counts["illegal"] += a["edges"][1] + b["edges"][0] not in ("su", "ua", "au")
            counts["turns"] -= sum(a[1] == b[0] for a, b in zip(turns, turns[1:]))
            gaps = turns[-1][1] - turns[0][0] + 1 - counts["turns"] if turns else 0
            ahead, ends = END, []
            for i, c in reversed(list(enumerate(chunks))):
                ends.append({"at": c["at"], "ahead": ahead.tolist(), "first": i == 0, "last": i == len(chunks) - 1})
                ahead = product(np.array(c["costs"]).reshape(4, 4), ahead)
            for column, value in zip(columns, (gaps, *(counts[n] for n in _COUNTS[:4]), int(ahead[NONE]), ends)):
                column.append(value)
        ends_type = pa.list_(pa.struct([("at", pa.int64()), ("ahead", pa.list_(pa.int64())), ("first", pa.bool_()), ("last", pa.bool_())]))
        arrays = [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], ends_type)]
        yield pa.RecordBatch.from_arrays([batch["conv"], *arrays], ["conv", "gaps", *_COUNTS[:4], "cost", "ends"])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk, the state behind it for each state before it (-1: that state is not on any way)."""
    for batch in batches:
        states = []
        for symbols, copies, ahead, last in zip(*(batch[c].to_pylist() for c in ("symbols", "copies", "ahead", "last"))):
            runs = runs_of(symbols, copies)
            before = np.array(ahead)
            for symbol, length in reversed(runs):
                before = across(symbol, length, before)
            states.append([unroll(runs, tuple(ahead), s, last)[1] if before[s] < FAR else -1 for s in range(4)])
        yield pa.RecordBatch.from_arrays([batch["conv"], batch["at"], pa.array(states, pa.list_(pa.int32()))], ["conv", "at", "exits"])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state before each chunk of the conversations with several."""
    for batch in batches:
        at, entry = [], []
        for chunks in batch["chunks"].to_pylist():
            state = NONE
            for c in chunks:
                at.append(c["at"])
                entry.append(state)
                state = c["exits"][state]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(entry, pa.int32())], ["at", "entry"])


_KEPT = pa.list_(pa.struct([("pos", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("role", pa.string()), ("edit", pa.string())]))


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk its audit and the turns that remain: place, source row (null if inserted), new role (null if kept), edit."""
    for batch in batches:
        audits, kept = [], []
        for symbols, copies, keys, ahead, last, state in zip(*(batch[c].to_pylist() for c in ("symbols", "copies", "keys", "ahead", "last", "entry"))):
            audit, _ = unroll(runs_of(symbols, copies), tuple(ahead), state, last)
            sources = ((key, i == 0, symbol) for key, n, symbol in zip(keys, copies, symbols) for i in range(n))
            out = []
            for edit in audit:
                if edit == "I":
                    state = NEXT[state]
                    out.append((len(out), None, None, ROLES[state], "I"))
                    continue
                key, _, symbol = next(sources)
                if edit == "K":
                    state = keeps(symbol, state)
                    out.append((len(out), key["k1"], key["k2"], None, "K"))
                elif edit == "R":
                    state = NEXT[state]
                    out.append((len(out), key["k1"], key["k2"], ROLES[state], "R"))
            audits.append(audit)
            kept.append(out)
        yield pa.RecordBatch.from_arrays([batch["conv"], batch["at"], pa.array(audits, pa.string()), pa.array(kept, _KEPT)], ["conv", "at", "audit", "kept"])


class Repair(NamedTuple):
    """``conversations``: per conversation gaps (turn numbers missing between the least and the greatest), rows by first fault,
    illegal neighbours, cost and audit. ``turns``: what remains, in the order of ``chunk`` and ``pos``, with its edit."""

    conversations: DataFrame
    turns: DataFrame


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Find the faults of conversations and mend their structure at the least cost."""
    said, by = F.coalesce(turns[text], F.lit("")), F.coalesce(turns[role], F.lit(""))
    rows = turns.select(turns[conv].alias("conv"), turns[turn].cast("bigint").alias("turn"), by.alias("role"), said.alias("text"))
    of_row = ["conv", "turn", "role", "text"]
    rows = rows.select(
        "*", F.xxhash64("role", "text").alias("d1"), F.xxhash64(F.lit(1), "role", "text").alias("d2"),
        F.xxhash64(F.lit(2), F.col("conv").isNull(), F.col("turn").isNull(), *of_row).alias("k1"),
        F.xxhash64(F.lit(3), F.col("conv").isNull(), F.col("turn").isNull(), *of_row).alias("k2"),
    )
    solid = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(solid == "", "blank").when(F.substring(solid, -1, 1).isin(*ENDS), "").otherwise("truncated")
    first_letter = F.substring("role", 1, 1)
    initial = F.when(first_letter.isin("s", "u", "a"), first_letter).otherwise("o")
    keyed = rows.select("conv", "turn", "role", "d1", "d2", "k1", "k2", initial.alias("initial"), fault.alias("fault"))
    counted = keyed.groupBy(*keyed.columns).agg(F.count("*").alias("n"))

    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "k1", "k2")
    firsts = counted.groupBy("conv", "d1", "d2").agg(F.min(place).alias("first")).select("first.k1", "first.k2", F.lit(True).alias("fresh"))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "d1", "d2")]
    known = counted.join(firsts, ["k1", "k2"], "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))
    ordered = known.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = turns.schema[conv].dataType
    arrow_kind = pa.int64() if kind.simpleString() == "bigint" else pa.string()
    if arrow_kind == pa.string():
        ordered = ordered.withColumn("conv", F.col("conv").cast("string"))
    plain = arrow_kind == pa.int64() and "bigint" or "string"
    chunks = stage(ordered.mapInArrow(lambda b: _pack(b, arrow_kind), _CHUNK_FIELDS.format(kind=plain)), "chunks")

    parts = F.array_sort(F.collect_list(F.struct("at", "costs", "counts", "edges", "turns"))).alias("chunks")
    totals = stage(chunks.groupBy("conv").agg(parts).mapInArrow(_fold, f"conv {plain}, {_TOTALS}"), "conversation_totals")
    ends = totals.select(F.explode("ends").alias("e")).select("e.*")
    placed = chunks.select("at", "conv", "symbols", "copies", "keys").join(ends, "at")

    several = placed.filter(~(F.col("first") & F.col("last"))).mapInArrow(_exits, f"conv {plain}, at bigint, exits array<int>")
    several = several.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("at", "exits"))).alias("chunks"))
    entries = several.mapInArrow(_entries, "at bigint, entry int")
    started = placed.join(entries, "at", "left").withColumn("entry", F.coalesce("entry", F.lit(NONE)))
    chosen = started.mapInArrow(_choose, f"conv {plain}, at bigint, audit string, kept array<struct<pos:bigint,k1:bigint,k2:bigint,role:string,edit:string>>")
    chosen = stage(chosen, "chosen_edits")

    audits = chosen.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("at", "audit"))).alias("parts"))
    audits = audits.select(F.col("conv").alias("_conv"), F.array_join(F.transform("parts", lambda p: p.audit), "").alias("audit"))
    faults = totals.join(audits, F.col("conv").eqNullSafe(F.col("_conv")))
    conversations = faults.select(F.col("conv").cast(kind).alias(conv), "gaps", *_COUNTS[:4], "cost", "audit")

    kept = chosen.select("conv", "at", F.explode("kept").alias("k")).select("conv", "at", "k.*").withColumnRenamed("role", "new_role")
    texts = rows.groupBy("k1", "k2").agg(F.first("role").alias("old_role"), F.first("text").alias("text"))
    inserted = kept.filter("k1 IS NULL").select("conv", "at", "pos", "new_role", F.lit("").alias("text"), "edit")
    found = kept.filter("k1 IS NOT NULL").join(texts, ["k1", "k2"])
    found = found.select("conv", "at", "pos", F.coalesce("new_role", "old_role").alias("new_role"), "text", "edit")
    mended = found.unionByName(inserted).select(
        F.col("conv").cast(kind).alias(conv), F.col("at").alias("chunk"), "pos", F.col("new_role").alias(role), F.col("text").alias(text), "edit"
    )
    return Repair(conversations, mended)
