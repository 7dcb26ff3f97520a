"""URL filtering by a trie over reversed host labels and path segments.

A rule allows or blocks a host with all its subdomains, for paths that start with the
rule's path. Rules are put into a trie: first the labels of the host from the last to
the first, then the path by segments, the last of them as a prefix. A url walks down once;
of the rules it passes, the one whose host has most labels wins, then the one of the
longest path, and of equal ones the one that allows. A trie is sent to every task, so rules are taken in
blocks of at most BLOCK_CHARS characters, and the winners of the blocks compared: the
broadcast has that bound, whatever the length of the list.

Defined results: a null url, or one without `://`, has an empty host and path and gets
the default verdict; repeated rows are judged alike; added columns (host, path, rule,
verdict) replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

BLOCK_CHARS = 8_000_000
DEFAULT = "allow"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str = "/"

    def __str__(self) -> str:
        return self.host + self.path


#: The rules of the registered query, in the order of its contract (fixed values).
RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("block", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)


class Trie:
    """Nodes are dictionaries; None leads from the labels to the path, and () to the rules that end here."""

    def __init__(self, rules: list[Rule]):
        self.top: dict = {}
        for rule in rules:
            node = self.top
            for label in reversed(rule.host.lower().split(".")) if rule.host else ():
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, rest = rule.path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            node.setdefault((), []).append((rest, rule))

    def find(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits."""
        best, rank = None, (-1, -1, False)
        node, depth, labels = self.top, 0, host.split(".") if host else []
        while True:
            if None in node:
                for rule in self._along(node[None], path):
                    if (r := (depth, len(rule.path), rule.action == "allow")) > rank:
                        best, rank = rule, r
            if depth == len(labels) or (node := node.get(labels[-1 - depth])) is None:
                return best
            depth += 1

    @staticmethod
    def _along(node: dict | None, path: str) -> Iterator[Rule]:
        for segment in path.split("/"):
            for rest, rule in node.get((), ()):
                if segment.startswith(rest):
                    yield rule
            if (node := node.get(segment)) is None:
                return


def parts_of(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, shape, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, shape, 2), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


_FOUND = StructType([StructField("rule", StringType()), StructField("action", StringType()), StructField("labels", IntegerType()), StructField("length", IntegerType())])
_FOUND_ARROW = pa.struct([("rule", pa.string()), ("action", pa.string()), ("labels", pa.int32()), ("length", pa.int32())])


def _lookup(spark, rules: list[Rule], host: Column, path: Column) -> Column:
    from pyspark.sql.pandas.functions import arrow_udf

    shared = spark.sparkContext.broadcast(Trie(rules))  # at most BLOCK_CHARS of rules

    def find(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for hosts, paths in pairs:
            found = [shared.value.find(h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True)]
            yield pa.array([r and {"rule": str(r), "action": r.action, "labels": len(r.host.split(".")) if r.host else 0, "length": len(r.path)} for r in found], _FOUND_ARROW)

    find.__annotations__ = {"pairs": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return arrow_udf(find, _FOUND)(host, path)


def blocks(rules: list[Rule], most: int = BLOCK_CHARS) -> Iterator[list[Rule]]:
    block, size = [], 0
    for rule in rules:
        if block and size + len(str(rule)) > most:
            yield block
            block, size = [], 0
        block.append(rule)
        size += len(str(rule))
    yield block


def filter_urls(pages: DataFrame, rules=RULES, url: str = "url", default: str = DEFAULT, most: int = BLOCK_CHARS) -> DataFrame:
    """pages with host, path, rule and verdict."""
    host, path = parts_of(F.col(url))
    out = pages.withColumns({"host": host, "path": path})
    found = [_lookup(pages.sparkSession, b, F.col("host"), F.col("path")) for b in blocks(list(rules), most)]
    out = out.withColumns({f"__found{i}": f for i, f in enumerate(found)})
    ranked = [F.struct(F.col(f"__found{i}.labels"), F.col(f"__found{i}.length"), (F.col(f"__found{i}.action") == "allow").alias("allow"), F.col(f"__found{i}").alias("own")) for i in range(len(found))]
    best = F.array_max(F.filter(F.array(*ranked), lambda x: x["own"].isNotNull()))
    out = out.withColumn("__best", best)
    return out.withColumns({"rule": F.col("__best.own.rule"), "verdict": F.coalesce(F.col("__best.own.action"), F.lit(default))}).drop("__best", *[f"__found{i}" for i in range(len(found))])


def op4_urls(pages: DataFrame) -> DataFrame:
    return filter_urls(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = """
WITH rules(action, rhost, rpath) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('block', 'net', '/de/'),
                                            ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
p AS (SELECT page_id, url,
        CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
        CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
      FROM pages),
hits AS (SELECT p.page_id, p.url, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(action, length(rhost || rpath)) AS action
         FROM p JOIN rules ON ('.' || host LIKE '%.' || rhost) AND starts_with(path, rpath) GROUP BY ALL)
SELECT p.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN hits ON p.page_id = hits.page_id AND p.url IS NOT DISTINCT FROM hits.url
"""
