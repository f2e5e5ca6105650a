"""Cleaning, validity and key expressions over text columns.

Everything here is a JVM expression except NFC normalisation and HTML parsing, which have no built-in. Those two hand
a Python worker only the rows that need it: a row without combining marks, or without ``<`` and ``&``, sends a null.
A batch is taken a few rows at a time.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from opinara.functions.numbers import one_of

# The two Python helpers below travel to the workers by value, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Character classes, readable by Java and RE2 alike. Blanks are every character that Python strips. They
# are written as "none of the others", most frequent letters first: a regex engine tests class members in turn, and this
# way an ordinary letter is settled by the first one.
NOT_BLANK_RANGES = (
    r"\x{21}-\x{7e}\x{a1}-\x{167f}\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}"
    r"\x{3001}-\x{10ffff}\x{00}-\x{08}\x{0e}-\x{1b}\x{7f}-\x{84}\x{86}-\x{9f}"
)
BLANK = f"[^{NOT_BLANK_RANGES}]"
BLANK_RUN = rf"\x{{20}}{BLANK}+|[^{NOT_BLANK_RANGES}\x{{20}}]{BLANK}*"
UNUSUAL = r"[^\x{20}-\x{2ff}\t\n\r]"
BLANK_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
REMOVED = r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{feff}\x{fffd}]"
WORD_BREAK = r"[^a-zA-Z0-9_\p{L}\p{N}]+"
NOT_PRINTABLE = r"[\p{C}\p{Z}\x{10000}-\x{10ffff}]"
EXOTIC = r"[\x{250}-\x{10ffff}]"
EXOTIC_BLANK = r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# Widths a caller may cut an article to, least lengths of a guarded import.
TITLE_WIDTH = 500
CONTENT_WIDTH = 2000
TITLE_LEAST = 10
CONTENT_LEAST = 50
REPETITION_FLOOR = 0.3

# Fixed value: rows that a Python worker takes into its objects at a time.
PIECE_ROWS = 256

# Reject reasons in the order they are tested.
REJECT_REASONS = (
    "empty_title",
    "empty_content",
    "title_too_short",
    "content_too_short",
    "invalid_url",
    "other_invalid",
)


def strip(text: Column) -> Column:
    """Remove Unicode blanks at both ends (plain ``trim`` would leave no-break spaces)."""
    return F.btrim(text, F.lit(BLANK_CHARS))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def filled(text: Column) -> Column:
    """The stripped text, or null when nothing is left."""
    return F.nullif(strip(text.cast("string")), F.lit(""))


def cut(text: Column, width: int | None) -> Column:
    """First ``width`` code points; ``None`` keeps the text whole."""
    return text if width is None else F.substring(text, 1, width)


def by_pieces(function, values: pa.Array, kind: pa.DataType) -> pa.Array:
    """``function`` of each value (null stays null), a few rows at a time: a batch has up to 10 000 whole texts."""
    pieces = [values.slice(i, PIECE_ROWS) for i in range(0, len(values), PIECE_ROWS)]
    return pa.concat_arrays([pa.array([], kind), *(pa.array([None if v is None else function(v) for v in p.to_pylist()], kind) for p in pieces)])


def _once(function):
    """Arrow UDF that the optimizer may neither copy nor move, so a later filter does not run it a second time."""

    def mapped(values: pa.Array) -> pa.Array:
        return by_pieces(function, values, values.type)

    return F.arrow_udf(mapped, StringType()).asNondeterministic()


_compose = _once(lambda t: unicodedata.normalize("NFC", t))


def sanitize_text(text: Column) -> Column:
    """Drop byte-order marks, control and replacement characters, compose, strip; null becomes empty.

    A text without control characters and below U+0300 needs neither: one pass tells, and only the others are rewritten
    and sent to Python.
    """
    whole = or_empty(text)
    composed = _compose(F.when(whole.rlike(UNUSUAL), F.regexp_replace(whole, REMOVED, "")))
    return strip(F.coalesce(composed, whole))


class _TextNodes(HTMLParser):
    """Collects visible text nodes; script, style and template bodies do not count as text."""

    HIDDEN = ("script", "style", "template")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.HIDDEN

    def handle_endtag(self, tag):
        if tag in self.HIDDEN and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden:
            self.nodes.append(data)


def visible_text(html: str) -> str:
    parser = _TextNodes()
    parser.feed(html)
    parser.close()
    return " ".join(parser.nodes).strip()


_visible_text = _once(visible_text)


def clean_html(text: Column) -> Column:
    """Text of the markup, nodes joined by a space; texts under five characters stay as they are."""
    whole = or_empty(text)
    short = F.length(strip(whole)) < 5
    marked = whole.contains("<") | whole.contains("&")
    parsed = _visible_text(F.when(~short & marked, whole))
    return one_of((short, whole), (marked, parsed), default=strip(whole))


def normalize_ws(text: Column) -> Column:
    """Every run of blanks becomes one space."""
    return strip(F.regexp_replace(text, BLANK_RUN, " "))


def clean_articles(df: DataFrame) -> DataFrame:
    """Sanitised title and url; content sanitised, freed of markup and with single spaces."""
    return (
        df.withColumns({"title": sanitize_text(F.col("title")), "content": sanitize_text(F.col("content"))})
        .withColumn("content", normalize_ws(clean_html(F.col("content"))))
        .withColumn("url", sanitize_text(F.col("url")))
    )


def fingerprint(title: Column, content: Column) -> Column:
    """Content hash: case does not matter, accents do."""
    return F.sha2(F.lower(F.concat(or_empty(title), F.lit("|"), or_empty(content))), 256)


def is_valid(title: Column, content: Column) -> Column:
    return (F.length(strip(or_empty(title))) > 3) & (F.length(strip(or_empty(content))) > 10)


def reject_reason(title: Column, content: Column, url: Column) -> Column:
    """Why a row fails; null for a valid one."""
    bare_title, bare_content, bare_url = (strip(or_empty(c)) for c in (title, content, url))
    empty_title, empty_content, short_title, short_content, bad_url, other = REJECT_REASONS
    return one_of(
        (is_valid(title, content), None),
        (bare_title == "", empty_title),
        (bare_content == "", empty_content),
        (F.length(bare_title) <= 3, short_title),
        (F.length(bare_content) <= 10, short_content),
        ((bare_url != "") & ~bare_url.rlike("^https?://"), bad_url),
        default=other,
    )


def words(text: Column) -> Column:
    """Blank-separated words, none of them empty."""
    return F.filter(F.split(text, f"{BLANK}+"), lambda w: w != "")


def is_repetitive(text: Column) -> Column:
    """Fewer than three distinct words in ten."""
    bag = words(text)
    return F.size(F.array_distinct(bag)) < F.size(bag) * F.lit(REPETITION_FLOOR)


def passes_guards(title: Column, content: Column, title_most: int | None = None, content_most: int | None = None) -> Column:
    """Long enough and not repetitive; upper bounds hold only where the caller names them."""
    sized = (F.length(title) >= TITLE_LEAST) & (F.length(content) >= CONTENT_LEAST)
    for text, most in ((title, title_most), (content, content_most)):
        if most is not None:
            sized &= F.length(text) <= most
    return sized & ~is_repetitive(content)


def is_readable(text: Column, sample_chars: int | None = None) -> Column:
    """Enough letters, mostly printable, few exotic characters, at most one replacement character."""
    bare = strip(or_empty(text))
    sample = cut(bare, sample_chars)
    size = F.greatest(F.length(sample), F.lit(1))

    def count(pattern: str) -> Column:
        return F.regexp_count(sample, F.lit(pattern))

    printable = F.length(sample) - count(NOT_PRINTABLE) + count(" ")
    exotic = count(EXOTIC) - count(EXOTIC_BLANK)
    return (
        (F.length(sample) >= 12)
        & (count("�") < 2)
        & (printable / size >= 0.88)
        & (exotic / size <= 0.12)
        & (count(r"\p{L}") >= 8)
    )


def base_quality(source: Column) -> Column:
    return F.when(F.lower(source).contains("zzdb"), 0.3).otherwise(0.5)


def completeness_quality(title: Column, content: Column) -> Column:
    title_bonus = F.when(F.length(strip(or_empty(title))) > 10, 0.2).otherwise(0.0)
    content_bonus = F.when(F.length(strip(or_empty(content))) > 50, 0.3).otherwise(0.0)
    return F.least(F.lit(0.5) + title_bonus + content_bonus, F.lit(1.0))


def source_type(source: Column) -> Column:
    name = F.lower(or_empty(source))
    return one_of(
        (name.contains("zzdb"), "db_non_relational"), (name.contains("kaggle"), "flat_files"), default="real_source"
    )


def foundation_class(source: Column) -> Column:
    """Struct of (is_foundation, foundation_type, frozen after first load); daily event feeds are tested first."""
    name = F.lower(source)

    def answer(member: bool, kind: str, frozen: bool) -> Column:
        return F.struct(
            F.lit(member).alias("is_foundation"), F.lit(kind).alias("foundation_type"), F.lit(frozen).alias("frozen")
        )

    return one_of(
        (name.contains("gdelt_last15") | name.contains("gdelt_master"), answer(True, "bigdata", False)),
        (name.contains("kaggle"), answer(True, "flat_files", True)),
        (name == "gdelt_events", answer(True, "bigdata", True)),
        (name.contains("zzdb") & name.contains("csv"), answer(True, "db_non_relational", False)),
        default=answer(False, "real_source", False),
    )


def stable_id(df: DataFrame, candidates: tuple[str, ...] = ("fingerprint", "url", "title", "id")) -> Column:
    """First candidate column that is present and not blank."""
    return F.coalesce(*[filled(F.col(c)) for c in candidates if c in df.columns])


def normalize_id(value: Column) -> Column:
    """Trimmed id; null and the spellings of a missing value become empty."""
    text = strip(or_empty(value.cast("string")))
    return F.when(text.isin("<NA>", "nan", "None"), "").otherwise(text)


def usable_id(df: DataFrame) -> Column:
    """First present, non-missing id among five columns."""
    names = [c for c in ("raw_data_id", "id", "fingerprint", "url", "title") if c in df.columns]
    texts = [filled(F.col(c)) for c in names]
    return or_empty(F.coalesce(*[F.when(~F.lower(t).isin("<na>", "none", "nan"), t) for t in texts]))


@cache
def accent_pairs() -> tuple[str, str]:
    """Letters whose decomposition is one base letter plus marks, and those base letters."""
    folded = {}
    for point in range(0xA0, min(sys.maxunicode, 0x2000)):
        letter = chr(point)
        base = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if len(base) == 1 and base != letter:
            folded[letter] = base
    return "".join(folded), "".join(folded.values())


def ascii_fold(text: Column) -> Column:
    """Lower case without accents, wholly inside the JVM."""
    letters, bases = accent_pairs()
    return F.lower(F.regexp_replace(F.translate(text, letters, bases), r"\p{Mn}+", ""))
