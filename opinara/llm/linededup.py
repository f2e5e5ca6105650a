"""Line dedup over a corpus with an edit bound of one or two characters, by deletion neighbourhoods.

A line goes if an equal line, or one within ``edits`` (1 or 2), stands earlier: in a document with a smaller id, or further up
in the same document. Edits are asked only of lines whose shorter one has at least ``fuzzy_from`` characters; shorter lines
must be equal. Blank lines stay.

One edit: two lines within distance 1 have a common variant: one with a character deleted (inserted or removed character), or both with
the character at the same place deleted (replaced character). Variants of all lines would be as many as the corpus has
characters, so they are emitted for those lines only that can have a partner, and this filter loses none: cut both lines at
places that follow from the length of the shorter one; the edit falls into one block, and all to its left and right is equal.
First each line is keyed by itself without one half, then the lines that share a key by themselves without one of ``BLOCKS``
blocks, and what shares a key again emits the variants of that block. Each group of equal variants is a star around its
earliest line (replaced characters) or around the line that has nothing deleted, so no pairs are expanded. The witness found
for a line is verified by edit distance.

Two edits: of three pieces of the shorter line one stands unchanged in the other: the first (as far from the start), the last
(as far from the end), or, if there is an edit in both of these, the middle one, at most one character off. The pieces are cut for the
smallest of ``LENGTHS`` neighbouring lengths, so that a line has five or ten keys. Groups of at most ``FEW`` lines with a key in
common are compared pair by pair. The lines of larger groups go on: their edits fall into one block of ``PAIR_BLOCKS`` or into
two, and lines are keyed by what is left, between and right of these. In groups of at most ``PAIRED`` rows the blocks of each are
compared with those of the others, which makes one row for each line. In larger ones each line emits patterns: its blocks with
two wildcards, each in the place of a character or of none. Lines within two edits have a pattern in common, and all lines of a
pattern are within two edits of each other, so a pattern is a star around its earliest line.

Everything is DataFrame functions. Lines travel as two 64-bit hashes; texts are shuffled at most once, when the lines are taken
out of more documents than can be broadcast.

Cases: a null text stays null and has no lines; an empty one has one blank line. Rows with equal key and text count as one
document and lose the same lines; rows with a null key come last in the order. Lines of equal text are one class, however
many. Lines end at a line feed; a carriage return belongs to its line. Other columns pass through, but ``n_lines`` and
``n_dropped`` are replaced if they exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.storage import stage

FUZZY_FROM = 20
BLOCKS = 32
PAIR_BLOCKS, PAIRED = 8, 1024
LENGTHS, FEW = 8, 16
BROADCAST_DOCS, BROADCAST_LINES = 500_000, 4_000_000


def _part(line: Column, begin: Column, size: Column) -> Column:
    """``size`` characters from ``begin`` (counted from 0)."""
    return F.substring(line, (begin + 1).cast("int"), size.cast("int"))


def _half_keys(line: Column, n: Column, fuzzy_from: int) -> Column:
    """Keys of a line without its first and without its second half, cut for its own length and for one less."""

    def keys(shorter: Column) -> Column:
        half = F.floor(shorter / 2).cast("int")
        left = F.xxhash64(F.lit(0), shorter, _part(line, F.lit(0), half))
        right = F.xxhash64(F.lit(1), shorter, _part(line, n - (shorter - half), shorter - half))
        return F.when(shorter >= fuzzy_from, F.array(left, right)).otherwise(F.array().cast("array<bigint>"))

    return F.concat(keys(n), keys(n - 1))


def _third_keys(line: Column, n: Column, fuzzy_from: int) -> Column:
    """Keys of a line's first, middle and last piece, cut for the class of its own length and, if another, of one and two less.

    The middle piece is needed at one character off at most: two off, the first or the last piece has no edit.
    """

    def least(shorter: Column) -> Column:
        return shorter - F.pmod(shorter - fuzzy_from, F.lit(LENGTHS))

    def keys(low: Column) -> Column:
        a, b = F.floor(low / 3).cast("int"), F.floor(low * 2 / 3).cast("int")
        parts = [(0, F.lit(0), a), (2, n - (low - b), low - b), *((1, a + s, b - a) for s in (-1, 0, 1))]
        return F.array(*(F.xxhash64(F.lit(which), low, _part(line, begin, size)) for which, begin, size in parts))

    none = F.array().cast("array<bigint>")
    own = F.when(n >= fuzzy_from, keys(least(n))).otherwise(none)
    below = F.when((n - 2 >= fuzzy_from) & (least(n - 2) != least(n)), keys(least(n - 2))).otherwise(none)
    return F.array_distinct(F.concat(own, below))


def _occurrences(docs: DataFrame, fuzzy_from: int, edits: int) -> DataFrame:
    """One row per line that is not blank: where it stands, two hashes, length, half keys (keys of thirds for two edits)."""
    keys = _half_keys if edits == 1 else _third_keys
    split = docs.select("doc", "h", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = split.filter(F.trim("line") != "").withColumn("n", F.char_length("line"))
    return lines.select(
        F.struct(F.col("doc").isNull().alias("last"), "doc", "h", "pos").alias("at"),
        F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"),
        "n", keys(F.col("line"), F.col("n"), fuzzy_from).alias("halves"),
    )


def _sharing(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys another line has as well. Rows are dealt by the keys once, for counting and for joining."""
    dealt = rows.repartition(*keys)
    several = dealt.groupBy(*keys).agg(F.min("k1").alias("x"), F.max("k1").alias("y")).filter("x != y").select(*keys)
    return dealt.join(several, keys, "left_semi")


def _texts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Adds the text of each line (at, k1, k2). Their places are broadcast while few documents are wanted (counted)."""
    wanted = lines.groupBy(F.col("at.doc").alias("doc"), F.col("at.h").alias("h")).agg(
        F.collect_list(F.struct("at", "k1", "k2")).alias("wanted")
    )
    few = wanted.count() <= BROADCAST_DOCS
    wanted = (F.broadcast(wanted) if few else wanted).select(F.col("doc").alias("doc_"), F.col("h").alias("h_"), "wanted")
    held = docs.join(wanted, F.col("doc").eqNullSafe(F.col("doc_")) & (F.col("h") == F.col("h_")))
    held = held.select(F.split("text", "\n").alias("lines"), "wanted")
    out = held.select("lines", F.explode("wanted").alias("w")).select("w.*", F.get("lines", F.col("w.at.pos")).alias("line"))
    return out.dropDuplicates(["k1", "k2"])


def _block_rows(lines: DataFrame, fuzzy_from: int) -> DataFrame:
    """Each line once per block: what stands left and right of the block, hashed, and the block."""
    n = F.char_length("line")
    sized = lines.withColumn("n", n).withColumn("shorter", F.explode(F.array(F.col("n"), F.col("n") - 1)))
    cut = sized.filter(F.col("shorter") >= fuzzy_from).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
    begin = F.floor(F.col("shorter") * F.col("block") / BLOCKS)
    end = F.floor(F.col("shorter") * (F.col("block") + 1) / BLOCKS)
    more = F.col("n") - F.col("shorter")  # the longer line's block has one character more
    rest = F.col("shorter") - end
    return cut.select(
        "at", "k1", "k2", "shorter", "block", more.alias("more"),
        F.xxhash64(_part(F.col("line"), F.lit(0), begin)).alias("left"),
        F.xxhash64(_part(F.col("line"), F.col("n") - rest, rest)).alias("right"),
        _part(F.col("line"), begin, end - begin + more).alias("inner"),
    )


def _variants(blocks: DataFrame) -> DataFrame:
    """Hashed variants: the block with each character deleted in turn (place from 1), and whole (place 0) in lines that may
    be the shorter one. Lines of equal length meet at the same place, lines that differ by one at place 0."""
    inner = F.col("inner")
    places = F.sequence(F.lit(1), F.char_length(inner))
    deleted = F.transform(
        F.when(inner == "", F.array().cast("array<int>")).otherwise(places),
        lambda i: F.struct(
            F.when(F.col("more") == 0, i).otherwise(F.lit(0)).alias("place"),
            F.concat(F.substring(inner, F.lit(1), i - 1), F.substring(inner, i + 1, F.char_length(inner))).alias("variant"),
        ),
    )
    whole = F.when(F.col("more") == 0, F.array(F.struct(F.lit(0).alias("place"), inner.alias("variant"))))
    each = F.concat(deleted, F.coalesce(whole, F.array().cast("array<struct<place:int,variant:string>>")))
    rows = blocks.select("at", "k1", "k2", "shorter", "block", "left", "right", "more", F.explode(F.array_distinct(each)).alias("v"))
    key = F.struct("shorter", "block", "left", "right", F.col("v.place").alias("place"), F.xxhash64("v.variant").alias("x"), F.xxhash64(F.lit(1), "v.variant").alias("y"))
    return rows.select(key.alias("variant"), "at", "k1", "k2", ((F.col("v.place") == 0) & (F.col("more") == 0)).alias("whole"))


def _witnesses(variants: DataFrame) -> DataFrame:
    """For lines with an earlier one of equal variant: the line (at, k1, k2) and that witness.

    At place 0 all are within the bound of the whole line, elsewhere of each other.
    """
    line = F.struct("at", "k1", "k2")
    dealt = variants.repartition("variant")
    first = dealt.groupBy("variant").agg(
        F.min(F.when(~F.col("whole"), line)).alias("part"), F.min(F.when(F.col("whole"), line)).alias("center"),
        F.min(line).alias("first"), F.max(line).alias("last"),
    )
    first = first.filter("first != last")
    joined = dealt.join(first, "variant")
    at_zero = F.when(F.col("whole"), F.col("part")).otherwise(F.col("center"))
    witness = F.when(F.col("variant.place") == 0, at_zero).otherwise(F.col("first"))
    found = joined.select("at", "k1", "k2", witness.alias("witness")).filter(F.col("witness.at") < F.col("at"))
    return found.groupBy("k1", "k2").agg(F.min("at").alias("at"), F.min("witness").alias("witness"))


def _pair_rows(lines: DataFrame, fuzzy_from: int) -> DataFrame:
    """Each line once per pair of blocks (one block with itself) and shift between them: the rest, hashed, and both blocks."""
    sized = lines.withColumn("n", F.char_length("line")).withColumn("more", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    sized = sized.withColumn("shorter", F.col("n") - F.col("more")).filter(F.col("shorter") >= fuzzy_from)
    pairs = sized.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(PAIR_BLOCKS - 1))))
    pairs = pairs.withColumn("j", F.explode(F.sequence(F.col("i"), F.lit(PAIR_BLOCKS - 1))))
    i, j, more, shift, line = (F.col(c) for c in ("i", "j", "more", "shift", "line"))
    between = F.filter(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda s: F.abs(more - s) <= 1)
    cut = pairs.withColumn("shift", F.explode(F.when(i == j, F.array(more)).otherwise(between)))
    edge = lambda k: F.floor(F.col("shorter") * k / PAIR_BLOCKS).cast("int")
    two = i < j
    return cut.select(
        "at", "k1", "k2", "shorter", "i", "j",
        F.xxhash64(_part(line, F.lit(0), edge(i))).alias("left"),
        F.when(two, F.xxhash64(_part(line, edge(i + 1) + shift, edge(j) - edge(i + 1)))).otherwise(0).alias("middle"),
        F.xxhash64(_part(line, edge(j + 1) + more, F.col("shorter") - edge(j + 1))).alias("right"),
        _part(line, edge(i), edge(i + 1) - edge(i) + shift).alias("one"),
        F.when(two, _part(line, edge(j) + shift, edge(j + 1) - edge(j) + more - shift)).otherwise("").alias("other"),
    )


def _wildcards(text: Column, begin: Column) -> Column:
    """(place, rest): a wildcard in place of each character from ``begin`` (from 1) on, and before each and after the last."""
    size = F.char_length(text)

    def at(replaced: int) -> Column:
        last = size + 1 - replaced
        places = F.when(last >= begin, F.sequence(begin, F.greatest(last, begin))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda p: F.struct(
            p.alias("place"), F.concat(F.substring(text, F.lit(1), p - 1), F.substring(text, p + replaced, size)).alias("rest")))

    return F.concat(at(1), at(0))


def _third_pairs(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of lines (k1, k2 and l1, l2) that share a third in a group of at most ``FEW``, and the lines of larger groups."""
    keyed = classes.select("k1", "k2", "n", F.explode("halves").alias("third")).repartition("third")
    line = F.struct("k1", "k2")
    sizes = keyed.groupBy("third").agg(F.min(line).alias("x"), F.max(line).alias("y"), F.count("n").alias("size"))
    # The count is of n, so that both sides of the join read the same columns and the rows are shuffled once.
    shared = stage(keyed.join(sizes.filter("x != y").select("third", "size"), "third"), "line_thirds")

    few = shared.filter(F.col("size") <= FEW).groupBy("third").agg(F.collect_list(F.struct("k1", "k2", "n")).alias("lines"))
    few = few.select("lines", F.explode("lines").alias("own"))
    later = lambda o: (o > F.col("own")) & (F.abs(o.n - F.col("own.n")) <= 2)
    few = few.select("own.k1", "own.k2", F.explode(F.filter("lines", later)).alias("o"))
    pairs = few.select("k1", "k2", F.col("o.k1").alias("l1"), F.col("o.k2").alias("l2")).distinct()
    return stage(pairs, "line_pairs"), stage(shared.filter(F.col("size") > FEW).select("k1", "k2").distinct(), "line_crowds")


def _near_lines(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Lines (k1, k2) of the pairs within two edits whose partner is earlier."""
    own = texts.select("k1", "k2", "at", F.col("line").alias("own"))
    other = texts.select(F.col("k1").alias("l1"), F.col("k2").alias("l2"), F.col("at").alias("other_at"), F.col("line").alias("other"))
    near = pairs.join(own, ["k1", "k2"]).join(other, ["l1", "l2"]).filter(F.levenshtein("own", "other", 2).between(0, 2))
    going = F.when(F.col("at") > F.col("other_at"), F.struct("k1", "k2")).otherwise(F.struct(F.col("l1").alias("k1"), F.col("l2").alias("k2")))
    return near.select(going.alias("line")).select("line.*")


def _near_two(texts: DataFrame, fuzzy_from: int) -> DataFrame:
    """Lines (k1, k2) with earlier ones (l1, l2) that may be within two edits; one within them is among these, if any is."""
    keys = ["shorter", "i", "j", "left", "middle", "right"]
    line = F.struct("at", "k1", "k2")
    rows = _pair_rows(texts, fuzzy_from).repartition(*keys)
    sizes = rows.groupBy(*keys).agg(F.min("k1").alias("x"), F.max("k1").alias("y"), F.count("*").alias("size"))
    rows = stage(rows.join(sizes.filter("x != y").select(*keys, "size"), keys), "line_blocks")

    def near(o: Column) -> Column:
        one, other = F.levenshtein(o.one, F.col("own.one"), 2), F.levenshtein(o.other, F.col("own.other"), 2)
        return (o.line.at < F.col("own.line.at")) & (one >= 0) & (other >= 0) & (one + other <= 2)

    few = rows.filter(F.col("size") <= PAIRED).groupBy(*keys).agg(F.collect_list(F.struct(line.alias("line"), "one", "other")).alias("rows"))
    few = few.select("rows", F.explode("rows").alias("own"))
    few = few.select("own.line.k1", "own.line.k2", F.array_min(F.transform(F.filter("rows", near), lambda o: o.line)).alias("witness"))
    few = few.filter("witness IS NOT NULL").groupBy("k1", "k2").agg(F.min("witness").alias("witness"))

    first = _wildcards(F.col("one"), F.lit(1))
    many = rows.filter(F.col("size") > PAIRED).withColumn("first", F.explode(first))
    again = F.when(F.col("i") < F.col("j"), _wildcards(F.col("other"), F.lit(1))).otherwise(_wildcards(F.col("first.rest"), F.col("first.place")))
    many = many.withColumn("second", F.explode(again))
    text = [F.col("first.place"), F.col("second.place"), F.when(F.col("i") < F.col("j"), F.col("first.rest")).otherwise(""), F.col("second.rest")]
    pattern = F.struct(*keys, F.xxhash64(F.lit(0), *text).alias("u"), F.xxhash64(F.lit(1), *text).alias("v"))
    many = many.select(pattern.alias("pattern"), "at", "k1", "k2").repartition("pattern")
    earliest = many.groupBy("pattern").agg(F.min(line).alias("witness"), F.max("at").alias("last")).filter(F.col("witness.at") < F.col("last"))
    star = many.join(earliest, "pattern").filter(F.col("witness.at") < F.col("at"))
    found = few.unionByName(star.groupBy("k1", "k2").agg(F.min("witness").alias("witness")))
    return found.select("k1", "k2", F.col("witness.k1").alias("l1"), F.col("witness.k2").alias("l2"))


def _near_by_one(rows: DataFrame, classes: DataFrame, fuzzy_from: int) -> DataFrame:
    """Lines (k1, k2) within one edit of an earlier one."""
    halves = classes.select("k1", "k2", F.explode("halves").alias("half")).repartition("half")
    several = halves.groupBy("half").agg(F.min(F.struct("k1", "k2")).alias("x"), F.max(F.struct("k1", "k2")).alias("y")).filter("x != y")
    paired = halves.join(several.select("half"), "half", "left_semi").select("k1", "k2").distinct()
    maybe = classes.join(paired, ["k1", "k2"]).select(F.col("first").alias("at"), "k1", "k2")
    texts = stage(_texts(rows, maybe), "line_texts")
    found = _witnesses(_variants(_sharing(_block_rows(texts, fuzzy_from), ["shorter", "block", "left", "right"])))
    own = texts.select("k1", "k2", F.col("line").alias("own"))
    other = texts.select(F.struct("at", "k1", "k2").alias("witness"), F.col("line").alias("other"))
    return found.join(own, ["k1", "k2"]).join(other, "witness").filter(F.levenshtein("own", "other", 1).between(0, 1))


def _near_by_two(rows: DataFrame, classes: DataFrame, fuzzy_from: int) -> DataFrame:
    """Lines (k1, k2) within two edits of an earlier one."""
    pairs, crowds = _third_pairs(classes)
    wanted = pairs.select("k1", "k2").union(pairs.select("l1", "l2")).union(crowds).distinct()
    maybe = classes.join(wanted, ["k1", "k2"]).select(F.col("first").alias("at"), "k1", "k2")
    texts = stage(_texts(rows, maybe), "line_texts")
    crowded = _near_two(texts.join(crowds, ["k1", "k2"], "left_semi"), fuzzy_from)
    return _near_lines(texts, pairs.unionByName(crowded))


def dropped_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", fuzzy_from: int = FUZZY_FROM, edits: int = 1
) -> DataFrame:
    """doc, h (hash of the text) and pos (from 0) of every line that goes."""
    if edits not in (1, 2):
        raise ValueError("one or two edits")
    if fuzzy_from < 2:
        raise ValueError("lines under two characters cannot be compared by edits")
    rows = docs.select(docs[key].alias("doc"), docs[text].alias("text")).filter(F.col("text").isNotNull())
    rows = rows.withColumn("h", F.xxhash64("text"))
    lines = stage(_occurrences(rows, fuzzy_from, edits), "lines")
    # Lines of repeated rows are one occurrence: they stand at the same place.
    classes = lines.groupBy("k1", "k2").agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.first("n").alias("n"), F.first("halves").alias("halves")
    )
    classes = stage(classes, "line_classes")
    nearer = _near_by_one(rows, classes, fuzzy_from) if edits == 1 else _near_by_two(rows, classes, fuzzy_from)

    repeated = classes.filter("first != last").select("k1", "k2", "first", F.lit(False).alias("near"))
    near = nearer.select("k1", "k2", F.lit(None).cast(classes.schema["first"].dataType).alias("first"), F.lit(True).alias("near"))
    going = repeated.unionByName(near).groupBy("k1", "k2").agg(F.max("first").alias("first"), F.max("near").alias("near"))
    gone = lines.select("at", "k1", "k2").join(going, ["k1", "k2"]).filter(F.col("near") | (F.col("at") != F.col("first")))
    return gone.select("at.doc", "at.h", "at.pos")


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", fuzzy_from: int = FUZZY_FROM, edits: int = 1
) -> DataFrame:
    """``docs`` with the lines taken out of ``text`` (bound: ``edits``), and ``n_lines`` (before) and ``n_dropped``."""
    gone = dropped_lines(docs, key, text, fuzzy_from, edits)
    per_doc = stage(gone.groupBy("doc", "h").agg(F.collect_set("pos").alias("gone")), "gone_lines")
    # While the places are few (they are counted) they go to the documents, and no text is shuffled.
    size = per_doc.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.size("gone")), F.lit(0)).alias("lines")).first()
    per_doc = F.broadcast(per_doc) if size.docs <= BROADCAST_DOCS and size.lines <= BROADCAST_LINES else per_doc
    per_doc = per_doc.select(F.col("doc").alias("_doc"), F.col("h").alias("_h"), F.col("gone").alias("_gone"))
    own = docs[text]
    joined = docs.join(per_doc, docs[key].eqNullSafe(F.col("_doc")) & (F.xxhash64(own) == F.col("_h")), "left")
    lines = F.split(own, "\n")
    with_lines = joined.withColumn("_lines", lines)
    # The positions that stay are found by hashing, so a document's cost is in proportion to its lines.
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n")
    out = with_lines.withColumns({
        text: F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept),
        "n_lines": F.coalesce(F.size("_lines"), F.lit(0)).cast("long"),
        "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
    })
    names = dict.fromkeys([*docs.columns, "n_lines", "n_dropped"])
    return out.select(*names)
