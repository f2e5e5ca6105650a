"""Near-duplicate documents by min-max hashing.

Words are runs without ASCII white space, A-Z folded; a document's set holds its distinct shingles of ``words`` words.
Under each of ``BANDS * PER_BAND`` permutations of the 32-bit shingle hashes both the smallest and the largest value are kept:
two samples for one evaluation. A band joins the pairs of values of ``PER_BAND`` permutations. Documents that share a band are
candidates; a pair at similarity 0.8 shares none of 96 bands with a probability of about 1e-7 (2e-6 for sets of five).

Documents with equal sets are one node. Candidates are not expanded into pairs at first: each node is compared with the
smallest node it shares a band with; the links found give components. In bands that hold several components each node is then
compared with the first and the last node, and only the bands that still hold several are expanded, across components. Rows
of open bands carry the set's size, two mixed bits of each kept value and the parities of the set: for each of ``PARITIES`` parts of
the hash range, whether it holds an odd number of elements. Two sets differ in at least as many elements as in parities, which
loses no link and, up to some ``PARITIES`` elements, tells pairs just below the threshold from links. Pairs whose sizes, parities or
bits rule the threshold out (more differing bits than at the threshold by six standard deviations) end within the join of the
band: they are never rows of their own. Each link is confirmed on the full sets of 64-bit shingle hashes.

Cases: a document without words (also null) has an empty set and is linked with nothing, not even another such; with fewer
words than a shingle, its words are its only element. Rows with the same id are one document: its first set by size and hash
counts for links, and every row is returned. Rows with a null id link with nothing, have a null component and are kept. Equal
texts are linked and the smallest id is kept. Only key and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.components import components
from opinara.llm.flat import Slice, WordHasher, mix, released, slices
from opinara.storage import stage

BANDS, PER_BAND = 96, 4
#: Longs in a plane: one mixed bit of every kept value.
PLANES, PLANE_LONGS = 2, 2 * BANDS * PER_BAND // 64
#: Parts of the hash range whose parities are kept, a power of two, and the longs they take.
PARITIES = 2048
PARITY_LONGS = PARITIES // 64
BROADCAST_IDS = 1_000_000
_GENERATOR = np.random.default_rng(20240)
FACTORS = _GENERATOR.integers(0, 1 << 32, BANDS * PER_BAND, np.uint32) | np.uint32(1)
SHIFTS = _GENERATOR.integers(0, 1 << 32, BANDS * PER_BAND, np.uint32)


def shingle_sets(part: Slice, hasher: WordHasher, words: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    hashes, first = hasher.words(part)
    factors = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    joined = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for j, factor in enumerate(factors):
        joined += hashes[j : j + len(joined)] * factor
    joined = mix(joined)
    for i in range(len(first) - 1):
        begin, end = first[i], first[i + 1]
        if end - begin >= words:
            yield np.unique(joined[begin : end - words + 1])
        elif end > begin:
            whole = (hashes[begin:end] * factors[: end - begin]).sum(dtype=np.uint64) + np.uint64(end - begin)
            yield mix(np.array([whole], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def min_max(elements: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value under every permutation x -> a * x + b of the 32-bit integers (a odd)."""
    low = np.full(len(FACTORS), 0xFFFFFFFF, np.uint32)
    high = np.zeros(len(FACTORS), np.uint32)
    folded = (elements >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(folded), 512):
        values = folded[i : i + 512, None] * FACTORS + SHIFTS
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (rows of documents): a hash of its number and its values."""
    values = (low.astype(np.uint64) << np.uint64(32)) | high
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(values), BANDS))
    for j in range(PER_BAND):
        keys = mix(keys + mix(values[:, j * BANDS : (j + 1) * BANDS]))
    return keys


def bit_planes(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Two mixed bits of every kept value (rows of documents), as longs: all first bits, then all second bits. Values that differ
    differ in a bit three times out of four, independently under each permutation."""
    mixed = mix(np.concatenate([low, high], axis=1).astype(np.uint64) + np.uint64(1))
    planes = [np.packbits((mixed >> np.uint64(i)).astype(np.uint8) & 1, axis=1) for i in range(PLANES)]
    return np.concatenate(planes, axis=1).view(np.int64)


def parities(elements: np.ndarray) -> np.ndarray:
    """Parity of the number of elements in each part of the hash range, as longs."""
    counts = np.bincount((elements & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def digest(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set."""
    sums = (mix(elements ^ np.uint64(seed)).sum(dtype=np.uint64) for seed in (0x5555, 0xAAAA0000))
    return tuple(int(x.astype(np.int64)) for x in sums)


def _sketch(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    for part in slices(batches):
        sizes, digests, lows, highs, odd = [], [], [], [], []
        for elements in shingle_sets(part, hasher, words):
            low, high = min_max(elements)
            sizes.append(len(elements))
            digests.append(digest(elements))
            lows.append(low)
            highs.append(high)
            odd.append(parities(elements))
        low, high, n = np.array(lows), np.array(highs), len(sizes)
        planes = bit_planes(low, high)
        width = planes.shape[1]
        keys = band_keys(low, high).astype(np.int64).ravel()
        columns = [
            part.rows.column(0),
            pa.array(np.array(sizes, np.int64)),
            *(pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)),
            pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * (n + 1), BANDS, dtype=np.int32)), pa.array(keys)),
            pa.ListArray.from_arrays(pa.array(np.arange(0, width * (n + 1), width, dtype=np.int32)), pa.array(planes.ravel())),
            pa.ListArray.from_arrays(pa.array(np.arange(0, PARITY_LONGS * (n + 1), PARITY_LONGS, dtype=np.int32)), pa.array(np.concatenate(odd))),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "k1", "k2", "bands", "planes", "odd"])


def _sets_of(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``doc`` and ``elements`` (sorted 64-bit hashes) of the wanted documents (doc, set).

    The ids are broadcast while they are few (they are counted), else joined by a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for part in slices(batches):
            found = list(shingle_sets(part, hasher, words))
            same = [(len(x), *digest(x)) == key for x, key in zip(found, zip(*(part.rows[c].to_pylist() for c in ("n", "k1", "k2"))))]
            mask = pa.array(same, pa.bool_())
            elements = pa.array([x.tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([part.rows["doc"].filter(mask), elements.filter(mask)], ["doc", "elements"])

    few = wanted.count() <= BROADCAST_IDS
    chosen = rows.join(F.broadcast(wanted) if few else wanted, "doc").select("doc", "text", "set.*")
    return chosen.mapInArrow(lambda b: released(run(b)), f"doc {rows.schema['doc'].dataType.simpleString()}, elements binary")


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs with 100 * intersection >= percent * union."""
    for batch in batches:
        keep = []
        for x, y in zip(batch["x"], batch["y"]):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = np.concatenate([x, y])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= percent * (len(both) - shared))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"])


def _beside(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with the values of both as x and y."""
    x = values.select(F.col("doc").alias("a"), F.col(column).alias("x"))
    y = values.select(F.col("doc").alias("b"), F.col(column).alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (smallest linked id) and ``kept`` (the id is its component) of every row."""
    if words < 1 or not 50 <= percent <= 100:
        raise ValueError("at least one word per shingle and a threshold of 50 to 100 percent are needed")
    rows = docs.select(docs[key].alias("doc"), docs[text].alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    fields = f"doc {kind}, n long, k1 long, k2 long, bands array<long>, planes array<long>, odd array<long>"
    sketches = stage(rows.mapInArrow(lambda b: released(_sketch(b, words)), fields), "sketches")

    nodes = sketches.filter("doc IS NOT NULL AND n > 0")
    of_doc = nodes.groupBy("doc").agg(F.min(F.struct("n", "k1", "k2")).alias("set"))
    classes = of_doc.groupBy("set").agg(F.min("doc").alias("node"))
    member = stage(of_doc.join(classes, "set").select("doc", "node", "set"), "members")
    # The node of a class is its smallest id; that row's sketch stands for all. Rows that repeat it do no harm.
    own = member.filter("doc = node").select("doc", "set")
    same_set = F.struct("n", "k1", "k2") == F.col("set")
    banded = sketches.join(own, "doc").filter(same_set).select("doc", F.explode("bands").alias("band")).repartition("band")
    shared = banded.groupBy("band").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first != last")
    crowded = stage(banded.join(shared.select("band", "first"), "band"), "bands")

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = stage(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct().join(own, "doc")
        sets = stage(_sets_of(rows, wanted, words), "sets")
        return stage(_beside(pairs, sets, "elements").mapInArrow(lambda b: released(_confirm(b, percent)), f"a {kind}, b {kind}"), "links")

    most = most_differences(percent)
    planes_of = sketches.join(own, "doc").filter(same_set).select("doc", "planes", "odd")

    def open_bands(links: DataFrame) -> DataFrame:
        """Rows (band, x) of the bands that hold several components, x with the component, the size, planes, parities and all its such bands."""
        labelled = crowded.join(components(links), F.col("doc") == F.col("node"), "left").select(
            "band", "doc", F.coalesce("component", "doc").alias("component")
        )
        several = labelled.groupBy("band").agg(F.min("component").alias("c"), F.max("component").alias("d")).filter("c != d")
        left = stage(labelled.join(several, "band", "left_semi"), "bands")
        every = left.groupBy("doc").agg(F.collect_set("band").alias("open"))
        carried = left.join(own, "doc").join(planes_of, "doc").join(every, "doc")
        return stage(carried.select("band", F.struct("doc", F.col("set.n").alias("n"), "component", "planes", "odd", "open").alias("x")), "bands")

    def likely(x: Column, y: Column) -> Column:
        size = (x.n * 100 >= y.n * percent) & (y.n * 100 >= x.n * percent)
        return (x.component != y.component) & size & few_apart(x, y, percent) & (differences(x.planes, y.planes) <= most)

    def compared(pairs: DataFrame) -> DataFrame:
        """Links among likely pairs (x, y)."""
        return confirmed(pairs.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct())

    first = crowded.filter("doc != first").groupBy("doc").agg(F.min("first").alias("first"))
    links = confirmed(first.select(F.col("first").alias("a"), F.col("doc").alias("b")))
    # Each document against the first and the last of each of its bands: in proportion to the bands.
    bands = open_bands(links)
    ends = bands.groupBy("band").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    stars = bands.join(ends, "band").select("x", F.explode(F.array("low", "high")).alias("y"))
    links = links.unionByName(compared(stars.filter(likely(F.col("x"), F.col("y")))))
    # What is left: bands that still hold several components. Unlikely pairs end in the join's condition, and a pair is a row
    # of the first open band it shares only.
    bands = open_bands(links).alias("l")
    other = bands.select(F.col("band").alias("beside"), F.col("x").alias("y")).alias("r")
    x, y = F.col("x"), F.col("y")
    once = first_shared(x, y) == F.col("band")
    rest = bands.join(other, (F.col("band") == F.col("beside")) & (x.component < y.component) & likely(x, y) & once)
    found = components(links.unionByName(compared(rest)))

    classes = member.join(found, "node", "left").select("doc", F.coalesce("component", "node").alias("component_id"))
    out = sketches.select("doc", "n").join(classes, "doc", "left")
    component: Column = F.coalesce("component_id", "doc")
    return out.select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"),
    )


def first_shared(x: Column, y: Column) -> Column:
    """The one band, of the open ones that two rows share, in which they are compared."""
    return F.array_min(F.array_intersect(x.open, y.open))


def few_apart(x: Column, y: Column, percent: int) -> Column:
    """Whether the parities leave room for a link: linked sets differ in (100 - percent) / (100 + percent) of both sizes' sum at most."""
    apart = reduce(Column.__add__, (F.bit_count(x.odd[i].bitwiseXOR(y.odd[i])) for i in range(PARITY_LONGS)))
    return apart * (100 + percent) <= (x.n + y.n) * (100 - percent)


def differences(x: Column, y: Column) -> Column:
    """Number of kept values in which the planes of two sets differ."""
    either = [reduce(Column.bitwiseOR, (x[p + i].bitwiseXOR(y[p + i]) for p in range(0, PLANES * PLANE_LONGS, PLANE_LONGS))) for i in range(PLANE_LONGS)]
    return reduce(Column.__add__, map(F.bit_count, either))


def most_differences(percent: int) -> int:
    """Differences of the planes of a pair at the threshold, and six standard deviations more."""
    n, p = 2 * BANDS * PER_BAND, (1 - 0.5**PLANES) * (1 - percent / 100)
    return int(np.ceil(n * p + 6 * np.sqrt(n * p * (1 - p))))
