"""URL filter: a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: A trie goes to every executor; a rule takes some hundred bytes there.
MAX_RULES = 1_000_000

#: (verdict, host, path) as the contract fixes them.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


class UrlTrie:
    """Rules by host, then by path.

    A host node has its labels below it and a path trie. A path node has whole
    segments below it and the beginnings of a last segment that end a rule.
    The longest host wins, then the longest path; of two rules for the same
    host and path, ``block`` wins.
    """

    def __init__(self, rules):
        self.root = self._node()
        for verdict, host, path in rules:
            host = host.translate(_LOWER)
            node = self.root
            for label in reversed(host.split(".") if host else []):
                node = node["below"].setdefault(label, self._node())
            *whole, last = path.split("/")
            at = node["paths"]
            for segment in whole:
                at = at["below"].setdefault(segment, {"below": {}, "ends": {}})
            if at["ends"].get(last, ("", ""))[1] != "block":
                at["ends"][last] = (host + path, verdict)

    @staticmethod
    def _node():
        return {"below": {}, "paths": {"below": {}, "ends": {}}}

    def find(self, host: str, path: str):
        """(rule, verdict) of the winning rule, or None."""
        node, fitting = self.root, [self.root]
        for label in reversed(host.split(".")):
            node = node["below"].get(label)
            if node is None:
                break
            fitting.append(node)
        segments = path.split("/")
        for node in reversed(fitting):
            if (found := self._longest(node["paths"], segments)) is not None:
                return found
        return None

    @staticmethod
    def _longest(at, segments):
        best = None
        for segment in segments:
            if at["ends"]:
                ends = at["ends"]
                for n in range(len(segment), -1, -1):
                    if segment[:n] in ends:
                        best = ends[segment[:n]]
                        break
            at = at["below"].get(segment)
            if at is None:
                break
        return best


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path; both empty without a ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def judge_urls(
    urls: DataFrame, rules, key: str, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``key, host, path, rule, verdict`` for each row.

    ``rules`` are ``(verdict, host, path)``; a rule fits its host and the hosts
    below it if the path starts with the rule's. The longest one decides,
    ``default`` where none fits. A missing URL or one without ``://`` has an
    empty host and path; only a rule for the empty host fits it. Repeated rows
    are judged alike, other columns ignored, an empty table gives no rows. The
    rules are broadcast; more than ``MAX_RULES`` are refused.
    """
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    trie = urls.sparkSession.sparkContext.broadcast(UrlTrie(rules))
    rows = urls.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trie.value
        for batch in batches:
            split = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [known.find(h, p) or (None, default) for h, p in split]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h for h, _ in split], pa.string()),
                    pa.array([p for _, p in split], pa.string()),
                    pa.array([r for r, _ in found], pa.string()),
                    pa.array([v for _, v in found], pa.string()),
                ],
                names=["key", "host", "path", "rule", "verdict"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(judge, f"key {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("key", key)


def op6_urls(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES, "page_id")


OP6_SQL = r"""
WITH cut AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '://((?s:.*))$', 1) AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
  END AS rule FROM parts
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
