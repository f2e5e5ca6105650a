"""Allow and block rules for URLs, looked up in a trie over reversed host labels and path segments.

A rule is a host and a path. It fits a URL whose host is the rule's host or a subdomain of it and whose path starts with
the rule's path, also within a segment (``/en/1`` fits ``/en/123``). Of the rules that fit, the one with the most host
labels wins, then the one with the longest path; a block entry beats an allow entry for the same host and path. URLs that
no rule fits get the default verdict.

The trie is broadcast while the rule list is at most ``MAX_BROADCAST_RULES`` long, which is counted first. A longer list is
joined instead: both sides are keyed by host suffix and whole leading path segments, and the longest fit is kept per URL.

Cases: a null URL or one without ``://`` has an empty host and path and gets the default verdict. A host without labels
fits no rule, nor does a null rule host. Rules listed twice count once; empty tables give empty results. Rows are judged one
by one; repeated rows get one result each. Only the key and the URL column are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_RULES = 200_000
ALLOW, BLOCK = "allow", "block"
_SCHEMA = "host string, path string, rule string, verdict string"


def _behind_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def _raw_host(url: Column) -> Column:
    return F.regexp_extract(_behind_scheme(url), r"^[^/?#]*", 0)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    return F.translate(_raw_host(url), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    rest = F.substring(_behind_scheme(url), F.length(_raw_host(url)) + 1, F.length(url))
    return F.coalesce(F.regexp_extract(rest, r"^[^?#]*", 0), F.lit(""))


class RuleTrie:
    """Nodes are dicts: first by host label from the right, then, below ``""``, by whole path segment.

    The rest of a rule's path behind its last ``/`` is a list of (rest, verdict) at its node, longest rest first.
    """

    def __init__(self, rules: list[tuple[str, str, str]]) -> None:
        self.root: dict = {}
        for verdict, host, path in sorted(set(rules)):
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(("host", label), {})
            *segments, rest = path.split("/")
            node = node.setdefault("paths", {})
            for segment in segments:
                node = node.setdefault(("path", segment), {})
            node.setdefault("rests", {})[rest] = (host + path, verdict)  # "block" sorts behind "allow" and wins
        self._order(self.root)

    def _order(self, top: dict) -> None:
        todo = [top]
        while todo:
            node = todo.pop()
            if "rests" in node:
                node["rests"] = sorted(node["rests"].items(), key=lambda item: -len(item[0]))
            todo += [below for name, below in node.items() if name != "rests"]

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """Rule and verdict of the longest match."""
        if not host:
            return None
        matches, node = [], self.root
        for label in reversed(host.split(".")):
            node = node.get(("host", label))
            if node is None:
                break
            if "paths" in node:
                matches.append(node["paths"])
        for paths in reversed(matches):
            if found := self._longest(paths, path):
                return found
        return None

    @staticmethod
    def _longest(node: dict, path: str) -> tuple[str, str] | None:
        best, at, segments = None, 0, path.split("/")
        for depth in range(len(segments)):
            tail = path[at:]
            best = next((rule for rest, rule in node.get("rests", ()) if tail.startswith(rest)), best)
            at += len(segments[depth]) + 1
            if depth == len(segments) - 1 or (node := node.get(("path", segments[depth]))) is None:
                break
        return best


def judge_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = ALLOW,
    max_broadcast_rules: int = MAX_BROADCAST_RULES,
) -> DataFrame:
    """``key``, host, path, rule (host and path, else null) and verdict of every row. ``rules``: verdict, host, path."""
    listed = rules.filter(F.col("host").isNotNull() & F.col("verdict").isin(ALLOW, BLOCK)).select(
        "verdict", "host", F.coalesce("path", F.lit("")).alias("path")
    )
    rows = pages.select(pages[key].alias("key"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    few = listed.limit(max_broadcast_rules + 1).collect()
    if len(few) > max_broadcast_rules:
        return _by_join(rows, listed, default).withColumnRenamed("key", key)
    trie = pages.sparkSession.sparkContext.broadcast([tuple(r) for r in few])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = RuleTrie(trie.value).find
        for batch in batches:
            found = [find(h, p) or (None, default) for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist())]
            columns = [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["key", "host", "path", "rule", "verdict"])

    kind = pages.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, {_SCHEMA}").withColumnRenamed("key", key)


def _by_join(rows: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """Each distinct host and path meets the rules that share a host suffix and all whole segments of the rule's path."""
    whole = F.regexp_extract("path", r"(?s)^(.*/)?", 1)
    keyed = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        F.col("host").alias("suffix"), whole.alias("base"), F.col("path").alias("rule_path"), "verdict"
    )
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, 1_000_000), "."))
    bases = F.transform(
        F.sequence(F.lit(0), F.size(segments) - 1),
        lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(segments, 1, i), "/"), F.lit("/"))),
    )
    urls = rows.filter(F.col("host") != "").select("host", "path").distinct()
    hits = (
        urls.select("host", "path", F.explode(suffixes).alias("suffix"))
        .select("host", "path", "suffix", F.explode(bases).alias("base"))
        .join(keyed, ["suffix", "base"])
        .filter(F.col("path").startswith(F.col("rule_path")))
    )
    order = F.struct(F.size(F.split("suffix", r"\.")), F.length("rule_path"))
    best = hits.groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("suffix", "rule_path").alias("rule"), "verdict"), order).alias("best")
    )
    joined = rows.join(best, ["host", "path"], "left")
    return joined.select(
        "key", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
