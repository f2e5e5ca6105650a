"""Landed HTML pages to link rows and articles."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.text import cut, is_valid, normalize_ws
from opinara.operators.filters import mentions
from opinara.operators.skew import keep_first
from opinara.storage import spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Anchors(HTMLParser):
    """Collects (href, text) of each link in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[tuple[str, str]] = []
        self.href: str | None = None
        self.text: list[str] = []

    def _close(self) -> None:
        if self.href is not None:
            self.links.append((self.href, " ".join(self.text)))
        self.href, self.text = None, []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self._close()
            self.href = dict(attrs).get("href")

    def handle_endtag(self, tag):
        if tag == "a":
            self._close()

    def handle_data(self, data):
        if self.href is not None and data.strip():
            self.text.append(data.strip())


def _links(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"], strict=True):
            parser = _Anchors()
            parser.feed(html or "")
            parser.close()
            parser._close()
            rows += [(page_id, url, place, href, text) for place, (href, text) in enumerate(parser.links)]
        yield pd.DataFrame(rows, columns=["page_id", "url", "place", "href", "text"])


def page_links(pages: DataFrame) -> DataFrame:
    """Every link of every page, in page order."""
    schema = "page_id bigint, url string, place int, href string, text string"
    found = spread(pages.select("page_id", "url", "html")).mapInPandas(_links, schema)
    return found.withColumn("text", normalize_ws(F.col("text")))


def absolute(href: Column, page_url: Column) -> Column:
    """Absolute form of a link relative to the site of its page."""
    site = F.regexp_extract(page_url, r"^(https?://[^/?#]+)", 1)
    path = F.when(href.startswith("/"), href).otherwise(F.concat(F.lit("/"), href))
    return F.when(href.startswith("http"), href).otherwise(F.concat(site, path))


def link_articles(
    pages: DataFrame, prefix: str, path_parts: tuple[str, ...], excluded: tuple[str, ...] = (), min_text: int = 25,
    headline_width: int | None = None, title_width: int | None = None, content_width: int | None = None,
) -> DataFrame:
    """Links that lead to articles, one per absolute url, as article rows.

    The headline is the link text up to its first sentence end.
    """
    kept = page_links(pages).filter(
        mentions(F.col("href"), path_parts) & ~mentions(F.col("href"), excluded) & (F.length("text") >= min_text)
    )
    resolved = kept.withColumn("link", absolute(F.col("href"), F.col("url")))
    unique = keep_first(resolved, ["link"], [F.col("page_id"), F.col("place")])
    headline = cut(F.substring_index("text", ". ", 1), headline_width)
    rows = unique.select(
        cut(F.concat(F.lit(f"[{prefix}] "), headline), title_width).alias("title"),
        cut(F.col("text"), content_width).alias("content"),
        F.col("link").alias("url"),
        "page_id",
    )
    return rows.filter(is_valid(F.col("title"), F.col("content")))
