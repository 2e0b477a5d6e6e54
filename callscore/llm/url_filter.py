"""URL allow and block rules in a trie, longest match first.

A rule is a host and a path. The trie's first levels are the host's labels
from the last to the first, and below each host hang the path's segments. A
URL walks down as far as its own labels and segments go; the deepest rule it
passes decides. Between rules of the same host and path, block goes before
allow.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ref, temp_names, without

#: rules that a broadcast trie may hold; about 1 KB each in a worker
MAX_RULES = 200_000
OUTPUT = ("host", "path", "rule", "verdict")

_PARTS = re.compile(r"([^/?#]*)([^?#]*)")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    host, path = _PARTS.match(url, at + 3).groups()
    return host.encode().lower().decode(), path


def _segments(path: str) -> list[str]:
    """The path cut after each slash: '/en/x' -> ['/', 'en/', 'x']."""
    return re.findall(r"[^/]*/|[^/]+", path)


class UrlTrie:
    """Rules as (verdict, host, path); a path matches as a string prefix."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules are over {MAX_RULES}; use judge_urls_by_table")
        self.root: dict = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict!r}")
            node = self.root
            for label in reversed(host.encode().lower().decode().split(".")):
                node = node.setdefault("hosts", {}).setdefault(label, {})
            for segment in _segments(path):
                # a last segment without its slash also fits the start of a longer one
                kind = "segments" if segment.endswith("/") else "starts"
                node = node.setdefault(kind, {}).setdefault(segment, {})
            if node.get("verdict") != "block":
                node["verdict"], node["rule"] = verdict, host + path

    def match(self, host: str, path: str) -> dict | None:
        """The node of the longest rule: most host labels, then longest path."""
        node, hosts = self.root, []
        for label in reversed(host.split(".")):
            node = node.get("hosts", {}).get(label)
            if node is None:
                break
            hosts.append(node)
        segments = _segments(path)
        for node in reversed(hosts):
            best = node if "verdict" in node else None
            for segment in segments:
                starts = node.get("starts", {})
                if starts:
                    fits = max((s for s in starts if segment.startswith(s)), key=len, default=None)
                    best = starts[fits] if fits is not None else best
                node = node.get("segments", {}).get(segment)
                if node is None:
                    break
                best = node if "verdict" in node else best
            if best is not None:
                return best
        return None


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url", default: str = "allow") -> DataFrame:
    """Every row with host, path, rule (null if none fits) and verdict.

    ``rules`` are (verdict, host, path), at most ``MAX_RULES`` of them, so the
    broadcast trie has a bound; ``judge_urls_by_table`` takes any number. A rule fits its host and all subdomains if the
    URL's path starts with the rule's; the rule with the most host labels and
    then the longest path wins, and block wins a tie. Null URLs and those
    without ``://`` have an empty host and path and get ``default``, as does
    every URL that no rule fits; an empty host or path never fits a rule that
    has one. Rows, repeated or not, are judged one by one; no shuffle. Columns
    called like an output column are replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trie = shared.value
        for urls in batches:
            rows = []
            for u in urls:
                host, path = split_url(u)
                node = trie.match(host, path)
                rows.append((host, path, node and node["rule"], node["verdict"] if node else default))
            yield pd.DataFrame(rows, columns=list(OUTPUT))

    kept = without(pages, [n for n in OUTPUT if n != url.lower()])
    name = "_judged"
    while name in {c.lower() for c in kept.columns}:
        name = "_" + name
    judged = kept.withColumn(name, judge(ref(url).cast("string")))
    own = [ref(c) for c in kept.columns if c.lower() not in OUTPUT]
    return judged.select(*own, *[F.col(f"{name}.{n}").alias(n) for n in OUTPUT])


def _host(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def judge_urls_by_table(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """As ``judge_urls`` for rule tables (verdict, host, path) of any size.

    Each distinct URL meets the rules on the suffixes of its host and the
    folders of its path, by a join; of the rules that fit the longest is kept,
    and the verdict goes back to the rows by URL. Nothing is broadcast by
    hand."""
    kept = without(pages, [n for n in OUTPUT if n != url.lower()])
    key, = temp_names(kept, "url_key")
    kept = kept.withColumn(key, F.coalesce(ref(url).cast("string"), F.lit("")))
    urls = kept.select(F.col(key).alias("u")).distinct().select(
        "u", _host(F.col("u")).alias("host"), F.regexp_extract(_rest(F.col("u")), r"^[^/?#]*([^?#]*)", 1).alias("path"))
    labels, parts = F.split("host", r"\."), F.split("path", "/", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    folders = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.concat_ws("", F.transform(F.slice(parts, F.lit(1), i), lambda p: F.concat(p, F.lit("/")))))
    keys = urls.select("u", "path", F.explode(suffixes).alias("rule_host"), folders.alias("folders")).select("u", "path", "rule_host", F.explode("folders").alias("folder"))
    table = rules.select(F.translate(F.col("host"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("rule_host"), F.col("path").alias("rule_path"),
                         F.regexp_extract("path", r"^((?:.*/)?)", 1).alias("folder"), F.concat("host", "path").alias("rule"), F.col("verdict").alias("rule_verdict"))
    fits = keys.join(table, ["rule_host", "folder"]).where(F.startswith("path", "rule_path"))
    depth = F.struct(F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("length"), (F.col("rule_verdict") == "block").alias("block"),
                     F.col("rule").alias("rule"), F.col("rule_verdict").alias("verdict"))
    best = fits.groupBy("u").agg(F.max(depth).alias("best"))
    judged = urls.join(best, "u", "left").select(F.col("u").alias(key), F.struct("host", "path", F.col("best.rule").alias("rule"),
                                                 F.coalesce("best.verdict", F.lit(default)).alias("verdict")).alias("judged"))
    own = [ref(c) for c in kept.columns if c != key and c.lower() not in OUTPUT]
    return kept.join(judged, key).select(*own, *[F.col(f"judged.{n}").alias(n) for n in OUTPUT])
