"""Landed feed, post and API payloads to articles. Collection itself is not part of the engine."""

from __future__ import annotations

import json
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from opinara.functions.numbers import one_of
from opinara.functions.text import (
    by_pieces,
    clean_html,
    cut,
    filled,
    is_valid,
    normalize_ws,
    or_empty,
    passes_guards,
    strip,
)
from opinara.operators.skew import keep_first, top_per_group

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Weather codes, in the order the label is looked up.
WEATHER_LABELS = {
    "ensoleille": (0,),
    "partiellement nuageux": (1, 2),
    "couvert": (3,),
    "brouillard": (45, 48),
    "bruine": (51, 53, 55, 56, 57),
    "pluie": (61, 63, 65, 66, 67, 80, 81, 82),
    "neige": (71, 73, 75, 77, 85, 86),
    "orage": (95, 96, 99),
}
WEATHER_UNKNOWN, WEATHER_OTHER = "conditions inconnues", "conditions variables"

# Keys under which a payload may hold its records, and the keys of a record.
LIST_KEYS = ("data", "datasets", "items", "series", "results", "_embedded", "value", "content")
RECORD_TITLE_KEYS = ("title", "label", "libelle", "nom", "name", "id", "identifier")
RECORD_TEXT_KEYS = ("description", "abstract", "resume", "comment")
RECORD_URL_KEYS = ("url", "uri", "link")
POST_MINIMUM_SCORE, POST_BODY_MINIMUM = 3, 60
CATALOGUE_TEXT_MINIMUM, RECORD_TITLE_MINIMUM = 25, 4
RECENT_GUARD = "INTERVAL 1 HOUR"


def _valid(df: DataFrame) -> DataFrame:
    return df.filter(is_valid(F.col("title"), F.col("content")))


def guarded_recent_sample(df: DataFrame, now: Column, n: int, unique: str = "id", content_width: int | None = None) -> DataFrame:
    """Newest ``n`` documents older than an hour, then the import guards; the newest are taken before they are tested."""
    settled = df.filter(F.col("published_at") < now - F.expr(RECENT_GUARD))
    newest = settled.orderBy(F.desc("published_at"), F.desc(unique)).limit(n)
    bare = newest.withColumns({c: strip(or_empty(F.col(c))) for c in ("title", "content")})
    kept = bare.filter(passes_guards(F.col("title"), F.col("content")))
    return _valid(kept.withColumn("content", cut(F.col("content"), content_width)))


def _first(records: Column, limit: int | None) -> Column:
    """The first records of a list; ``None`` keeps all."""
    return records if limit is None else F.slice(records, 1, limit)


def feed_articles(
    payloads: DataFrame, column: str = "payload", limit: int | None = None, title_width: int | None = None, content_width: int | None = None
) -> DataFrame:
    """Entries of a feed: content is summary, else description, else the title."""
    schema = "entries array<struct<title:string,summary:string,description:string,link:string,published:string>>"
    entries = _first(F.from_json(column, schema)["entries"], limit)
    entry = F.col("entry")

    def present(field: str) -> Column:
        return F.nullif(entry[field], F.lit(""))

    title = strip(or_empty(entry["title"]))
    rows = payloads.withColumn("entry", F.explode(entries)).withColumns(
        {
            "title": cut(title, title_width),
            "content": cut(F.coalesce(present("summary"), present("description"), title), content_width),
            "url": or_empty(entry["link"]),
            "published_at": or_empty(entry["published"]),
        }
    )
    return _valid(rows.drop("entry", column))


def post_articles(
    posts: DataFrame, order: list[Column], unique: str, per_channel: int | None = None, minimum: int = POST_MINIMUM_SCORE,
    title_width: int | None = None, content_width: int | None = None,
) -> DataFrame:
    """Posts of a minimum score, titled with their channel; with ``per_channel`` only among the first of each channel.

    A post without text says which discussion it opens. A channel may hold most posts, so it is thinned in salted parts.
    """
    first = posts if per_channel is None else top_per_group(posts, ["channel"], order, per_channel, unique)
    scored = first.filter((F.col("score") >= minimum) & (F.col("title") != ""))
    body = F.nullif(cut(or_empty(F.col("selftext")), content_width), F.lit(""))
    return _valid(
        scored.withColumns(
            {
                "title": cut(F.concat(F.lit("["), F.upper("channel"), F.lit("] "), "title"), title_width),
                "content": F.coalesce(body, F.concat(F.lit("Discussion #"), F.col("score").cast("string"))),
            }
        )
    )


def post_feed_articles(
    posts: DataFrame, order: list[Column], unique: str, per_channel: int | None = None, title_width: int | None = None, content_width: int | None = None
) -> DataFrame:
    """Posts from a feed instead: markup is removed and a short body gives way to the title."""
    first = posts if per_channel is None else top_per_group(posts, ["channel"], order, per_channel, unique)
    text = normalize_ws(clean_html(F.col("selftext")))
    named = first.filter(F.col("title") != "").withColumn("_body", text)
    body = F.when(F.length("_body") >= POST_BODY_MINIMUM, F.col("_body")).otherwise(F.col("title"))
    return _valid(
        named.withColumns(
            {
                "content": cut(body, content_width),
                "title": cut(F.concat(F.lit("["), F.upper("channel"), F.lit("] "), "title"), title_width),
            }
        ).drop("_body")
    )


def weather_label(code: Column) -> Column:
    number = code.try_cast("int")
    cases = [(number.isin(*codes), label) for label, codes in WEATHER_LABELS.items()]
    return one_of((number.isNull(), WEATHER_UNKNOWN), *cases, default=WEATHER_OTHER)


def weather_bulletins(readings: DataFrame) -> DataFrame:
    """Bulletin title and text from city, temperature and code."""
    label = weather_label(F.col("code"))
    shown = F.coalesce(F.col("temperature").cast("string"), F.lit("N/A"))
    code = F.coalesce(F.col("code").cast("string"), F.lit("N/A"))
    return readings.withColumns(
        {
            "title": F.concat(F.lit("Bulletin meteo "), "city", F.lit(": "), shown, F.lit("C - "), label),
            "content": F.concat(
                F.lit("Meteo du jour a "), "city", F.lit(". Temperature "), shown, F.lit(" degres, conditions "), label,
                F.lit(". Weather code "), code, F.lit(". Suivi climat, precipitation, vent et alertes orage."),
            ),
        }
    )


def consultation_articles(
    payloads: DataFrame, prefix: str, base_url: str, column: str = "payload", title_width: int | None = None, content_width: int | None = None
) -> DataFrame:
    """Open and closed consultations of a payload, theme label nested one level down, titled with their platform."""
    record = "array<struct<title:string,thematique:struct<label:string>,territory:string,endDate:string,slug:string>>"
    parsed = F.from_json(column, f"ongoing {record}, finished {record}")
    empty = F.array().cast(record)
    both = F.concat(F.coalesce(parsed["ongoing"], empty), F.coalesce(parsed["finished"], empty))
    item = F.col("item")
    rows = payloads.withColumn("item", F.explode(both)).withColumns(
        {
            "title": cut(F.concat(F.lit(f"[{prefix}] "), or_empty(item["title"])), title_width),
            "content": cut(
                F.concat(
                    F.lit("Theme: "), or_empty(item["thematique"]["label"]), F.lit(". Territoire: "),
                    or_empty(item["territory"]), F.lit(". Fin: "), or_empty(item["endDate"]), F.lit("."),
                ),
                content_width,
            ),
            "url": F.coalesce(F.concat(F.lit(f"{base_url}/consultations/"), F.nullif(item["slug"], F.lit(""))), F.lit(base_url)),
        }
    )
    return _valid(rows.drop("item", column))


def generic_articles(
    payloads: DataFrame, column: str = "payload", limit: int | None = None, title_width: int | None = None, content_width: int | None = None
) -> DataFrame:
    """First non-empty list of articles, items and results."""
    record = "array<struct<title:string,content:string,url:string>>"
    parsed = F.from_json(column, f"articles {record}, items {record}, results {record}")
    lists = [F.when(F.size(parsed[k]) > 0, parsed[k]) for k in ("articles", "items", "results")]
    item = F.col("item")
    rows = payloads.withColumn("item", F.explode(_first(F.coalesce(*lists), limit))).withColumns(
        {
            "title": cut(or_empty(item["title"]), title_width),
            "content": cut(or_empty(item["content"]), content_width),
            "url": or_empty(item["url"]),
        }
    )
    return _valid(rows.drop("item", column))


def records_of(payload: str, limit: int | None = None) -> list[str]:
    """Records of the first list found under the known keys, looking into nested objects; as JSON texts."""

    def search(node: object) -> list:
        if isinstance(node, list):
            return [r for r in node[:limit] if isinstance(r, dict)]
        if not isinstance(node, dict):
            return []
        for child in (node.get(key) for key in LIST_KEYS):
            found = search(child)
            if found or isinstance(child, list):
                return found
        return []

    try:
        return [json.dumps(record, ensure_ascii=False) for record in search(json.loads(payload))]
    except ValueError:
        return []


def record_lists(payloads: pa.Array, limit: int | None) -> pa.Array:
    """Records of each payload of a batch, parsed a few payloads at a time; a null payload has none."""
    return by_pieces(lambda p: records_of(p, limit), payloads, pa.list_(payloads.type))


def _records(column: str, limit: int | None) -> Column:
    @F.arrow_udf(ArrayType(StringType()))
    def listed(payloads: pa.Array) -> pa.Array:
        return record_lists(payloads, limit)

    return listed(column)


def record_articles(
    payloads: DataFrame, tag: str, default_url: str, column: str = "payload", limit: int | None = None,
    title_width: int | None = None, content_width: int | None = None,
) -> DataFrame:
    """Articles of nested statistics payloads; a record without description keeps itself as text."""
    items = payloads.withColumn("item", F.explode_outer(_records(column, limit))).filter(F.col("item").isNotNull())
    keys = dict.fromkeys((*RECORD_TITLE_KEYS, *RECORD_TEXT_KEYS, *RECORD_URL_KEYS))
    parsed = items.withColumn("_r", F.from_json("item", ", ".join(f"{key} string" for key in keys)))

    def first_of(names: tuple[str, ...]) -> Column:
        return F.coalesce(*[F.nullif(F.col(f"_r.{name}"), F.lit("")) for name in names])

    staged = parsed.withColumns(
        {
            "_title": cut(strip(or_empty(first_of(RECORD_TITLE_KEYS))), title_width),
            "_text": first_of(RECORD_TEXT_KEYS),
            "url": F.coalesce(first_of(RECORD_URL_KEYS), F.lit(default_url)),
        }
    ).drop("_r").filter(F.length("_title") >= RECORD_TITLE_MINIMUM)
    described = normalize_ws(clean_html(F.col("_text")))
    rows = staged.withColumns(
        {
            "title": F.concat(F.lit(f"[{tag}] "), "_title"),
            "content": cut(F.when(F.col("_text").isNotNull(), described).otherwise(F.col("item")), content_width),
        }
    )
    return _valid(rows.drop("_title", "_text", "item", column))


def catalogue_articles(
    records: DataFrame, prefix: str, base_url: str, order: list[Column], title_width: int | None = None, content_width: int | None = None
) -> DataFrame:
    """Catalogue records with enough description, one per slug, titled with their catalogue."""
    cleaned = records.withColumns(
        {
            "title": strip(or_empty(F.col("title"))),
            "content": normalize_ws(clean_html(F.col("description"))),
            "slug": strip(or_empty(F.col("slug"))),
        }
    )
    kept = keep_first(
        cleaned.filter((F.col("title") != "") & (F.length("content") >= CATALOGUE_TEXT_MINIMUM)), ["slug"], order
    )
    url = F.coalesce(F.concat(F.lit(f"{base_url}/fr/datasets/"), filled(F.col("slug")), F.lit("/")), F.lit(base_url))
    rows = kept.withColumns(
        {
            "title": F.concat(F.lit(f"[{prefix}] "), cut(F.col("title"), title_width)),
            "content": cut(F.col("content"), content_width),
            "url": url,
        }
    )
    return _valid(rows.drop("description"))
