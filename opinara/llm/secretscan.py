"""Secrets in texts, told apart by who owns them: a corpus-wide count of the repositories and owners of every candidate.

A task finds candidates in its texts: assignments to a name such as ``password`` or ``token``, access keys, long hexadecimal
runs (the base kinds), and bare runs with letters and digits (kind ``token``). Candidates travel as hashes of their values. For
each value the corpus is asked how many repositories and how many owners hold it:

* ``copied``: more than ``max_owners`` owners hold it, as is so with examples from documentation and with public constants;
* ``live``: at most ``max_owners`` hold it and the value looks like a credential (letters, digits, variety, no filler word);
* ``weak``: all others.

Base spans are always reported, with their verdict. A bare run is reported if its value is live and either stands in a base
span elsewhere in the corpus (a credential used again without its name) or is strong by itself: long, of mixed case, of high
entropy. Values are compared without dots and equal signs at their ends.

A value or a document may make up a third of all rows: counts are combined per task before each shuffle, first per owner and
repository, then per owner, then per value, and verdicts go back by a join of two written tables, whose hot keys Spark splits.
No text is shuffled.

Cases: a null or empty text has no spans. Spans count code points, the end is exclusive. Null repositories and null owners are
one unknown repository and one unknown owner. Repeated rows get equal results, one row each, and are one holder of their values.
Rows with a null key are scanned like others. Empty tables give empty results. Only the named columns are read, so further
columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.flat import WordHasher, slices
from opinara.storage import stage

#: Base kinds in their order, then the kind this scan adds.
KINDS = ("assign", "access", "hex", "token")
TOKEN = KINDS.index("token")
# Patterns and least lengths. They work on bytes with A-Z folded (assign) or as they are. Hexadecimal and key runs
# are taken whole, so a least length in the pattern finds the same runs as a filter afterwards; an assignment that is too
# short still uses up its text.
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
HEX = re.compile(rb"[0-9a-f]{32,}")
LEAST_VALUE = 8

#: Filler words of examples.
FILLERS = re.compile(rb"example|sample|dummy|changeme|change_me|placeholder|your|test|fake|xxxx|0000|1234567|abcdef")
MAX_OWNERS = 2
STRONG_LENGTH, STRONG_BITS = 20, 4.0
LIVE_CHARACTERS = 6

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES < 58)
_UPPER, _LOWER = (_BYTES >= 65) & (_BYTES < 91), (_BYTES >= 97) & (_BYTES < 123)
_RUN = _DIGIT | _UPPER | _LOWER | np.isin(_BYTES, list(b"+/_.-"))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("live", pa.bool_()), ("strong", pa.bool_())]))
_SCHEMA = "found array<struct<start:bigint,kind:int,end:bigint,h1:bigint,h2:bigint,live:boolean,strong:boolean>>"


def base_spans(text: bytes) -> list[tuple[int, int, int, bytes]]:
    """(start, kind, end, value) of the base kinds, in bytes, ordered by start and kind."""
    found = [(m.start(), 0, m.end(), text[m.start(1) : m.end()]) for m in ASSIGN.finditer(text.translate(_FOLD)) if m.end() - m.start(1) >= LEAST_VALUE]
    found += [(m.start(), kind, m.end(), m.group()) for kind, pattern in ((1, ACCESS), (2, HEX)) for m in pattern.finditer(text)]
    return sorted(found)


def looks_live(value: bytes) -> bool:
    """Letters and digits, some variety, and no filler word."""
    if len(value) < LEAST_VALUE or len(set(value)) < LIVE_CHARACTERS:
        return False
    kinds = np.frombuffer(value, np.uint8)
    mixed = bool(_DIGIT[kinds].any() and (_UPPER | _LOWER)[kinds].any())
    return mixed and not FILLERS.search(value.translate(_FOLD))


def is_strong(value: bytes) -> bool:
    """Long, with both cases and digits, and of high entropy."""
    if len(value) < STRONG_LENGTH or b"." in value:
        return False
    kinds = np.frombuffer(value, np.uint8)
    if not (_DIGIT[kinds].any() and _UPPER[kinds].any() and _LOWER[kinds].any()):
        return False
    shares = np.bincount(kinds)[np.unique(kinds)] / len(kinds)
    return bool(-(shares * np.log2(shares)).sum() >= STRONG_BITS)


def _identity(value: bytes) -> tuple[int, int]:
    """128 bits of a value without dots and equal signs at its ends."""
    digest = xxhash.xxh3_128_digest(value.strip(b".="))
    return tuple(int.from_bytes(digest[i : i + 8], "big", signed=True) for i in (0, 8))


def _bare_runs(data: np.ndarray, starts: np.ndarray, runs: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one byte of the runs with a letter and a digit that are long enough, without dots at their ends."""
    begin, end = runs.spans(data, starts)
    sums = [np.concatenate([[0], np.cumsum(kind[data])]) for kind in (_DIGIT, _UPPER | _LOWER)]
    keep = (end - begin >= LEAST_VALUE) & np.logical_and.reduce([s[end] > s[begin] for s in sums])
    return begin[keep], end[keep]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = WordHasher(lower=False, separators=~_RUN)
    for part in slices(batches):
        begin, end = _bare_runs(part.data, part.starts, runs)
        first = np.searchsorted(begin, part.starts)
        column = []
        for i in range(len(part.starts) - 1):
            text, origin = part.text(i), int(part.starts[i])
            spans = base_spans(text)
            taken = np.zeros(len(text) + 1 if spans else 0, np.int64)
            for s, _, e, _ in spans:
                taken[s + 1 : e + 1] = 1
            taken = np.cumsum(taken)  # bytes of base spans before each byte
            for b, e in zip(begin[first[i] : first[i + 1]].tolist(), end[first[i] : first[i + 1]].tolist()):
                b, e = b - origin, e - origin
                value = text[b:e].strip(b".")
                b += text[b:e].index(value)
                e = b + len(value)
                if looks_live(value) and not (len(taken) and taken[e] > taken[b]):
                    spans.append((b, TOKEN, e, value))
            if not spans:
                column.append([])
                continue
            lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
            points = np.concatenate([[0], np.cumsum(lead)])  # code points before each byte
            column.append([
                (int(points[s]), kind, int(points[e]), *_identity(value), looks_live(value.strip(b".=")), is_strong(value.strip(b".=")))
                for s, kind, e, value in sorted(spans)
            ])
        found = pa.array(column, _SPANS)
        yield pa.RecordBatch.from_arrays([*(part.rows[c] for c in ("key", "repo", "owner")), found], ["key", "repo", "owner", "found"])


def ownership(occurrences: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per value (h1, h2): its owners, repositories, occurrences and verdict. ``occurrences`` has repo, owner, kind,
    live and strong as well."""
    flags = [F.max("based").alias("based"), F.max("live").alias("live"), F.max("strong").alias("strong")]
    by_repo = occurrences.withColumn("based", F.col("kind") < TOKEN).groupBy("h1", "h2", "owner", "repo").agg(F.count("*").alias("n"), *flags)
    by_owner = by_repo.groupBy("h1", "h2", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"), *flags)
    values = by_owner.groupBy("h1", "h2").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n"), *flags)
    verdict = F.when(F.col("n_owners") > max_owners, "copied").when(F.col("live"), "live").otherwise("weak")
    return values.withColumn("verdict", verdict)


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", repo: str = "doc_id", owner: str = "source",
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """``key`` and ``spans`` of every row: start, end (code points), kind, verdict, number of owners and of repositories of the
    value, ordered by start and kind. Base kinds are all there, bare runs as far as they are reported."""
    rows = docs.select(
        docs[key].alias("key"), docs[repo].cast("string").alias("repo"), docs[owner].cast("string").alias("owner"), docs[text].alias("text")
    )
    kind = docs.schema[key].dataType.simpleString()
    found = rows.mapInArrow(_scan, f"key {kind}, repo string, owner string, {_SCHEMA}")
    found = stage(found.withColumn("row", F.monotonically_increasing_id()), "secret_candidates")
    occurrences = found.select("row", "repo", "owner", F.explode("found").alias("f")).select("row", "repo", "owner", "f.*")
    judged = stage(ownership(occurrences, max_owners), "secret_values")
    told = occurrences.select("row", "start", "kind", "end", "h1", "h2").join(
        judged.select("h1", "h2", "n_owners", "n_repos", "verdict", "based", "strong"), ["h1", "h2"]
    )
    told = told.filter((F.col("kind") < TOKEN) | ((F.col("verdict") == "live") & (F.col("based") | F.col("strong"))))
    names = F.array(*(F.lit(k) for k in KINDS))
    span = F.struct("start", "kind", "end", "verdict", "n_owners", "n_repos")
    per_row = told.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    named = F.transform("spans", lambda s: F.struct(
        s.start.alias("start"), s.end.alias("end"), F.get(names, s.kind).alias("kind"), s.verdict.alias("verdict"),
        s.n_owners.alias("n_owners"), s.n_repos.alias("n_repos"),
    ))
    out = found.select("row", "key").join(per_row.select("row", named.alias("spans")), "row", "left")
    nothing = F.array().cast(out.schema["spans"].dataType)
    return out.select(F.col("key").alias(key), F.coalesce("spans", nothing).alias("spans"))
