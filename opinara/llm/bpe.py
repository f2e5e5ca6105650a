"""Byte-level BPE as a streaming transducer, and the way back as a state machine over bytes.

Encoding follows the merge list of a tokenizer file. The text is cut into pieces by the pattern of byte-level tokenizers;
a piece is merged by rank. From the merge list alone a *sufficient lookahead* is computed: a bound on how far to the right
of a position the bytes can lie that still influence the tokens before it. A token that ends that far before the end of what
has been read is stable, so it is emitted and forgotten. A piece of any length is thus merged in constant memory, and a text
is read in windows that end at places where no piece can cross.

Why the bound holds: compare the merges of a text and of a prefix of it. They can differ only to the right of an edge that
starts at the prefix's end. A merge (a, b) of rank j that differs and touches the edge has b at the edge, and moves the edge
left by len(a). The next differing merge at the new edge has a rank above j, and its right part starts with a. The longest
such chain of ranks, summed over the lengths of the left parts, is the lookahead. Merges never cross a boundary between
final tokens, so the rest of a text can be merged on its own after the emitted tokens are gone.

Cases: a null or empty text has no ids and decodes to the empty text. The strings of special tokens in a text become their
ids, as the tokenizers library does it. Ids decode to the text they came from; ill-formed bytes of foreign id lists become
U+FFFD. Rows are handled one by one, so repeated rows and ties need no rule. Other columns pass through; ``token_ids``
and ``decoded`` are replaced if they exist.
"""

from __future__ import annotations

import codecs
import heapq
import json
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from opinara.llm.flat import released, slices

#: Fixed value: how byte-level tokenizers cut a text into pieces.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT = regex.compile(r"(?<=\S)[ \n]")
WINDOW = 1 << 15
CACHED_PIECES = 250_000
LONG_PIECE = 64
MAX_TOKENIZER_BYTES = 64 << 20


def byte_alphabet() -> dict[str, int]:
    """Byte written by each character of a byte-level vocabulary: printable Latin-1 stands for itself, others from U+0100."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merge ranks and special tokens of a byte-level BPE tokenizer file (its JSON text)."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model, alphabet = spec["model"], byte_alphabet()
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        if spec["pre_tokenizer"].get("add_prefix_space") or not spec["pre_tokenizer"].get("use_regex", True):
            raise ValueError("prefix space and unsplit text are not supported")
        ids = model["vocab"]
        self.token_bytes = {i: bytes(alphabet[c] for c in token) for token, i in ids.items()}
        self.byte_ids = [0] * 256
        for character, byte in alphabet.items():
            self.byte_ids[byte] = ids[character]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[left], ids[right]] = rank, ids[left + right]
        self.ranks = {pair: rank for pair, (rank, _) in self.merges.items()}
        self.made = [made for _, made in sorted(self.merges.values())]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: content.encode() for content, i in self.special.items()}
        self.lookahead = sufficient_lookahead(self.merges, self.token_bytes)


def sufficient_lookahead(merges: dict[tuple[int, int], tuple[int, int]], token_bytes: dict[int, bytes]) -> int:
    """Bytes that suffice behind a token to know that it is final (see the module's text)."""
    first_part: dict[int, int] = {}  # of each merged token
    reach: dict[int, int] = {}  # of each left part: the longest chain so far that ends with it
    longest = 0
    for (left, right), (_, made) in sorted(merges.items(), key=lambda item: item[1][0]):
        behind, start = 0, right
        while True:
            behind = max(behind, reach.get(start, 0))
            if start not in first_part:
                break
            start = first_part[start]
        chain_length = len(token_bytes[left]) + behind
        reach[left] = max(reach.get(left, 0), chain_length)
        longest = max(longest, chain_length)
        first_part.setdefault(made, left)
    return longest


class MergeTransducer:
    """Merges the bytes of one piece; ``feed`` returns the ids that are stable, ``close`` the rest."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.rest = vocabulary, b""

    def feed(self, data: bytes) -> list[int]:
        self.rest += data
        limit = len(self.rest) - self.vocabulary.lookahead
        if limit < self.vocabulary.lookahead:  # wait for as much again, so that each byte is merged twice at most
            return []
        stable, end = [], 0
        for token in merge(self.rest, self.vocabulary):
            width = len(self.vocabulary.token_bytes[token])
            if end + width > limit:
                break
            stable.append(token)
            end += width
        self.rest = self.rest[end:]
        return stable

    def close(self) -> list[int]:
        data, self.rest = self.rest, b""
        return merge(data, self.vocabulary)


def merge(data: bytes, vocabulary: Vocabulary) -> list[int]:
    """Token ids of one piece: the pair of lowest rank is joined first, the leftmost among equals."""
    ids = [vocabulary.byte_ids[b] for b in data]
    if len(ids) > LONG_PIECE:
        return _merge_by_heap(ids, vocabulary.merges)
    ranks, none, made = vocabulary.ranks.get, len(vocabulary.made), vocabulary.made
    open_ranks = [ranks(pair, none) for pair in zip(ids, ids[1:])]
    while open_ranks:
        best = min(open_ranks)
        if best == none:
            break
        i = open_ranks.index(best)
        ids[i : i + 2] = [made[best]]
        del open_ranks[i]
        if i < len(open_ranks):
            open_ranks[i] = ranks((ids[i], ids[i + 1]), none)
        if i:
            open_ranks[i - 1] = ranks((ids[i - 1], ids[i]), none)
    return ids


def _merge_by_heap(ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    queue: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(ids) and (found := merges.get((ids[i], ids[after[i]]))):
            heapq.heappush(queue, (found[0], i, ids[i], ids[after[i]], found[1]))

    for i in range(len(ids)):
        offer(i)
    while queue:
        _, i, left, right, made = heapq.heappop(queue)
        j = after[i]
        if ids[i] != left or j >= len(ids) or ids[j] != right:
            continue
        ids[i], ids[j] = made, -1
        after[i] = after[j]
        if after[j] < len(ids):
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [token for token in ids if token >= 0]


class _Pieces(dict):
    """Ids of the pieces seen of late: two generations, of which the older one is forgotten when the younger one is full."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, piece: str) -> bytes:
        """The ids as 32-bit integers in bytes, which are cheap to hold and to join."""
        if (ids := self.older.get(piece)) is not None:
            self[piece] = ids
            return ids
        transducer = MergeTransducer(self.vocabulary)
        step = LONG_PIECE if len(piece) <= LONG_PIECE else max(self.vocabulary.lookahead, 1)
        parts = [array("i", transducer.feed(piece[i : i + step].encode())) for i in range(0, len(piece), step)]
        ids = b"".join([*parts, array("i", transducer.close())])
        if len(piece) <= LONG_PIECE:
            if len(self) >= CACHED_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Streams a text through the transducer window by window."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.pieces = vocabulary, _Pieces(vocabulary)
        self.find = regex.compile(PIECES).findall
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def windows(self, text: str) -> Iterator[str]:
        """Parts of a text between special tokens; a piece never crosses from one part to the next."""
        at = 0
        while len(text) - at > WINDOW:
            cut = at + WINDOW
            while cut > at and (text[cut] not in " \n" or text[cut - 1].isspace()):
                cut -= 1
            if cut == at:
                found = CUT.search(text, at + WINDOW)
                cut = found.start() if found else len(text)
            yield text[at:cut]
            at = cut
        yield text[at:]

    def stream(self, text: str) -> Iterator[bytes]:
        """Ids of the text as 32-bit integers, in parts."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            yield from self._parts(text[at : found.start()])
            yield array("i", [self.vocabulary.special[found[0]]]).tobytes()
            at = found.end()
        yield from self._parts(text[at:] if at else text)

    def _parts(self, text: str) -> Iterator[bytes]:
        for window in self.windows(text):
            yield b"".join(map(self.pieces.__getitem__, self.find(window)))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.stream(text)), np.int32)


class Decoder:
    """Ids to text: ``push`` returns the characters that are complete, ``close`` what an unfinished character becomes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        words = [vocabulary.token_bytes.get(i, b"") for i in range(max(vocabulary.token_bytes) + 1)]
        self.widths = np.array(list(map(len, words)))
        self.places = np.cumsum(self.widths) - self.widths
        self.pool = np.frombuffer(b"".join(words), np.uint8)
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: np.ndarray) -> str:
        widths = self.widths[ids]
        ends = np.cumsum(widths)
        shifts = np.repeat(self.places[ids] - ends + widths, widths)
        return self.state.decode(self.pool[shifts + np.arange(len(shifts))].tobytes())

    def close(self) -> str:
        text = self.state.decode(b"", True)
        self.state.reset()
        return text

    def decode(self, ids: np.ndarray) -> str:
        parts = [self.push(ids[i : i + WINDOW]) for i in range(0, len(ids), WINDOW)]
        return "".join(parts) + self.close()


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(source: Broadcast) -> Vocabulary:
    """One per worker process."""
    key = hash(source.value)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(source.value)
    return _LOADED[key]


def broadcast_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file's text, read by the driver; its size is checked."""
    with open(path, encoding="utf-8") as file:
        source = file.read(MAX_TOKENIZER_BYTES + 1)
    if len(source) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} is larger than {MAX_TOKENIZER_BYTES} bytes")
    return spark.sparkContext.broadcast(source)


def _added(df: DataFrame, fields: str) -> StructType:
    """Schema of ``df`` with fields at its end."""
    return StructType([*df.schema.fields, *StructType.fromDDL(fields).fields])


def _encoded(batches: Iterator[pa.RecordBatch], tokenizer: Broadcast, text: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(_vocabulary(tokenizer))
    for part in slices(batches, text):
        ids = [encoder.encode(part.text(i).decode()) for i in range(part.rows.num_rows)]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
        yield pa.RecordBatch.from_arrays([*part.rows.columns, lists], [*part.rows.schema.names, "token_ids"])


def _decoded(batches: Iterator[pa.RecordBatch], tokenizer: Broadcast, ids: str) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(_vocabulary(tokenizer))
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            lists = part.column(part.schema.get_field_index(ids))
            texts = [decoder.decode(x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32)) for x in lists]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])


def encode(docs: DataFrame, tokenizer: Broadcast, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (array of int)."""
    rows = docs.drop("token_ids")
    return rows.mapInArrow(lambda b: released(_encoded(b, tokenizer, text)), _added(rows, "token_ids array<int>"))


def decode(encoded: DataFrame, tokenizer: Broadcast, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with ``decoded`` (string); a null list decodes to the empty text."""
    rows = encoded.drop("decoded")
    return rows.mapInArrow(lambda b: released(_decoded(b, tokenizer, ids)), _added(rows, "decoded string"))


def encode_and_decode(docs: DataFrame, tokenizer: Broadcast, text: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass: a task needs one Python worker, with one vocabulary, where the two need one each."""
    rows = docs.drop("token_ids", "decoded")
    fields = _added(rows, "token_ids array<int>, decoded string")
    return rows.mapInArrow(lambda b: released(_decoded(_encoded(b, tokenizer, text), tokenizer, "token_ids")), fields)
