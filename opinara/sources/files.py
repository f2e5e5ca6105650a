"""Landed files to articles: CSV, JSON, tab-separated events, labelled corpora, run records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.functions.labels import strict_polarity
from opinara.functions.text import (
    cut,
    filled,
    is_valid,
    or_empty,
    passes_guards,
    strip,
)

# Positions read from an event file.
EVENT_COLUMNS = {"code": 0, "title": 1, "date": 2, "url": 57}

# JSON keys tried in order.
TITLE_KEYS = ("title", "headline", "Title")
CONTENT_KEYS = ("content", "text", "description", "Content", "Text")
TEXT_COLUMNS = ("content", "text", "cleaned", "title")
LABEL_COLUMNS = ("sentiment", "label")

RUN_SCHEMA = (
    "generated_at string, status string, reasons array<string>, loaded bigint, kpis map<string,double>,"
    " source_traceability map<string,struct<extracted:int,duration_sec:double,status:string>>"
)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header and quoted line breaks; every column text, damaged rows kept as nulls."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', mode="PERMISSIVE", encoding="UTF-8")


def guarded_import(rows: DataFrame, title_width: int | None = None, content_width: int | None = None) -> DataFrame:
    """Rows with title and content inside the import bounds and not repetitive; widths cut the texts first."""
    title = strip(cut(strip(or_empty(F.col("title"))), title_width))
    content = strip(cut(strip(or_empty(F.col("content"))), content_width))
    sized = rows.withColumns({"title": title, "content": content})
    return sized.filter(passes_guards(F.col("title"), F.col("content")) & is_valid(F.col("title"), F.col("content")))


def csv_guarded(
    spark: SparkSession, path: str, default_url: str, now: Column | None = None, title_width: int | None = None, content_width: int | None = None
) -> DataFrame:
    """Guarded CSV import; a missing url or publication time gets a default."""
    rows = guarded_import(read_csv(spark, path), title_width, content_width)
    stamp = F.current_timestamp().cast("string") if now is None else now
    return rows.withColumns(
        {"url": F.coalesce("url", F.lit(default_url)), "published_at": F.coalesce(filled(F.col("published_at")), stamp)}
    )


def csv_flexible(spark: SparkSession, path: str, title_width: int | None = None, content_width: int | None = None) -> DataFrame:
    """CSV of unknown header: the title is the first column named like one, else the first; content likewise.

    Only the header decides, on the driver; when there is a single column it serves as both.
    """
    df = read_csv(spark, path)
    names = df.columns

    def pick(parts: tuple[str, ...], default: int) -> str | None:
        named = [n for n in names if any(p in n.lower() for p in parts)]
        return named[0] if named else (names[default] if default < len(names) else None)

    title, content = pick(("title", "headline"), 0), pick(("content", "text", "body"), 1)
    rest = F.concat_ws(" ", *[F.col(f"`{n}`") for n in names[1:]]) if len(names) > 1 else F.col(f"`{title}`")
    body = rest if content is None else F.col(f"`{content}`")
    rows = df.select(
        strip(cut(or_empty(F.col(f"`{title}`")), title_width)).alias("title"),
        strip(cut(or_empty(body), content_width)).alias("content"),
    )
    return rows.filter(is_valid(F.col("title"), F.col("content")))


def _member(value: str, keys: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.get_json_object(value, f"$.{k}") for k in keys])


def json_items(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per element of a JSON list, or of the ``items`` list of a JSON object."""
    listed = F.from_json(column, "array<string>")
    wrapped = F.from_json(F.get_json_object(column, "$.items"), "array<string>")
    items = F.when(F.ltrim(column).startswith("["), listed).otherwise(wrapped)
    return df.withColumn("item", F.explode(items)).drop(column)


def read_json_documents(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per landed JSON file, or per line of a file of JSON lines, with its path."""
    return spark.read.text(path, wholetext=not lines, recursiveFileLookup=True).select(
        "value", F.col("_metadata.file_path").alias("path")
    )


def json_articles(
    spark: SparkSession, path: str, fallback_title: str = "Kaggle", lines: bool = False, title_width: int | None = None, content_width: int | None = None
) -> DataFrame:
    """Articles of list or ``items`` files with key fallbacks; content falls back to the title."""
    documents = read_json_documents(spark, path, lines).filter(~F.lower("path").contains("manifest"))
    return item_articles(json_items(documents), fallback_title, title_width, content_width).drop("path")


def item_articles(items: DataFrame, fallback_title: str = "Kaggle", title_width: int | None = None, content_width: int | None = None) -> DataFrame:
    """Title and content of JSON items by the first key that is present."""
    title = strip(cut(F.coalesce(_member("item", TITLE_KEYS), F.lit(fallback_title)), title_width))
    rows = items.withColumn("title", title)
    rows = rows.withColumn(
        "content", strip(cut(F.coalesce(_member("item", CONTENT_KEYS), F.col("title")), content_width))
    )
    return rows.drop("item").filter(is_valid(F.col("title"), F.col("content")))


def folder_articles(spark: SparkSession, path: str, lines: bool = False, title_width: int | None = None, content_width: int | None = None) -> DataFrame:
    """Recovers articles from source-named folders; content falls back to the title, the source is the folder."""
    items = json_items(read_json_documents(spark, path, lines))

    def first_filled(keys: tuple[str, ...]) -> Column:
        return F.coalesce(*[F.nullif(F.get_json_object("item", f"$.{k}"), F.lit("")) for k in keys])

    title = strip(or_empty(first_filled(("title", "headline"))))
    content = strip(or_empty(first_filled(("content", "text", "description"))))
    return (
        items.withColumns({"title": title, "content": content})
        .filter(F.length("title") > 3)
        .select(
            F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("source"),
            cut(F.col("title"), title_width).alias("title"),
            cut(F.when(F.col("content") == "", F.col("title")).otherwise(F.col("content")), content_width).alias("content"),
            or_empty(F.get_json_object("item", "$.url")).alias("url"),
        )
    )


def tab_events(
    spark: SparkSession, path: str, per_file: int | None = None, total: int | None = None, title_width: int | None = None
) -> DataFrame:
    """Every line of tab-separated event files as an article: fields 0, 1, 2 and 57.

    With ``per_file`` only the first lines of each file, with ``total`` only the first articles by path and line.
    """
    lines = spark.read.text(path).select(
        F.split("value", "\t").alias("f"), F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at")
    )

    def field(name: str) -> Column:
        return F.get("f", F.lit(EVENT_COLUMNS[name]))

    if per_file is not None:
        rank = F.row_number().over(Window.partitionBy("path").orderBy("at"))
        lines = lines.withColumn("_rank", rank).filter(F.col("_rank") <= per_file)
    rows = lines.select(
        "path",
        "at",
        cut(or_empty(field("title")), title_width).alias("title"),
        F.concat(F.lit("Code: "), field("code"), F.lit(", Date: "), F.coalesce(field("date"), F.lit("N/A"))).alias("content"),
        or_empty(field("url")).alias("url"),
    ).filter(is_valid(F.col("title"), F.col("content")))
    if total is not None:
        rows = rows.orderBy("path", "at").limit(total)
    return rows.drop("path", "at")


def labelled_corpus(df: DataFrame) -> DataFrame:
    """(label, text) from the first known column of each kind; rows without a known label or text are dropped."""
    text_column = next((c for c in TEXT_COLUMNS if c in df.columns), None)
    label_column = next((c for c in LABEL_COLUMNS if c in df.columns), None)
    if text_column is None or label_column is None:
        raise ValueError(f"labelled corpus needs one of {TEXT_COLUMNS} and one of {LABEL_COLUMNS}, has {df.columns}")
    rows = df.select(
        strict_polarity(F.col(label_column).cast("string")).alias("label"), filled(F.col(text_column)).alias("text")
    )
    return rows.filter(F.col("label").isNotNull() & F.col("text").isNotNull() & ~F.lower("text").isin("nan", "none"))


def run_history(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """Newest run records; files that are not valid JSON are skipped."""
    records = spark.read.schema(RUN_SCHEMA).json(path, mode="DROPMALFORMED")
    return records.filter(F.col("generated_at").isNotNull()).orderBy(F.desc("generated_at")).limit(n)
