"""URL filter: a broadcast trie over reversed host labels and path segments.

A rule (host, path, verdict) fits its host and all subdomains if the URL's path
starts with the rule's path. The rule with the longest host wins, then the one
with the longest path; of equal rules the blocking one. URLs that no rule fits
get the default verdict. A rule's path is empty or starts with ``/``.

Defined results: a null URL or one without ``://`` has an empty host and path,
which no rule fits; repeated rows are judged one by one; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rules above this many bytes are joined and not broadcast.
TRIE_BYTES = 64 << 20

Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def build_trie(rules: Sequence[Rule]) -> dict:
    """Host labels from the right, then whole path segments, then the rest of a segment.

    A node: children by label, ``paths`` where rules of that host begin. A path
    node: children by segment, ``tails`` by the rule's last, perhaps partial, segment.
    """
    root: dict = {"labels": {}}
    for host, path, verdict in rules:
        if verdict not in ("allow", "block") or (path and not path.startswith("/")):
            raise ValueError(f"not a rule: {(host, path, verdict)}")
        node = root
        for label in reversed(host.translate(str.maketrans(UPPER, LOWER)).split(".")):
            node = node["labels"].setdefault(label, {"labels": {}})
        at = node.setdefault("paths", {"segments": {}, "tails": {}, "any": None})
        if not path:
            at["any"] = "block" if "block" in (at["any"], verdict) else verdict
            continue
        *whole, tail = path[1:].split("/")
        for segment in whole:
            at = at["segments"].setdefault(segment, {"segments": {}, "tails": {}})
        at["tails"][tail] = "block" if "block" in (at["tails"].get(tail), verdict) else verdict
    return root


def _longest_path(paths: dict, path: str) -> tuple[str, str] | None:
    """The longest rule path that begins ``path``, with its verdict."""
    best = ("", paths["any"]) if paths["any"] else None
    if not path.startswith("/"):
        return best
    at, start = paths, 1
    while True:
        end = path.find("/", start)
        segment = path[start:] if end < 0 else path[start:end]
        fits = [t for t in at["tails"] if segment.startswith(t)] if len(at["tails"]) < 8 else [
            segment[:n] for n in {len(t) for t in at["tails"]} if segment[:n] in at["tails"]
        ]
        if fits:
            tail = max(fits, key=len)
            best = (path[:start] + tail, at["tails"][tail])
        if end < 0 or segment not in at["segments"]:
            return best
        at, start = at["segments"][segment], end + 1


def longest_match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits, or None."""
    node, seen, best = trie, 0, None
    for label in reversed(host.split(".")) if host else ():
        node = node["labels"].get(label)
        if node is None:
            break
        seen += len(label) + 1
        if "paths" in node and (found := _longest_path(node["paths"], path)):
            best = (host[max(0, len(host) - seen + 1):] + found[0], found[1])
    return best


def judged(
    urls: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    default: str = "allow",
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """Add host, path, rule and verdict; columns of these names are replaced."""
    if sum(len(h) + len(p) for h, p, _ in rules) > trie_bytes:
        raise ValueError("too many rules to broadcast: put them into a table, see judged_by_table")
    spark = urls.sparkSession
    trie = spark.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        root = trie.value
        for hosts, paths in parts:
            found = [longest_match(root, h, p) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(
                {
                    "rule": [f[0] if f else None for f in found],
                    "verdict": [f[1] if f else default for f in found],
                }
            )

    host, path = host_and_path(F.col(url))
    found = urls.withColumns({"host": host, "path": path}).withColumn("_found", judge("host", "path"))
    return found.withColumns({"rule": F.col("_found.rule"), "verdict": F.col("_found.verdict")}).drop("_found")


def judged_by_table(
    urls: DataFrame, rules: DataFrame, key: str, url: str = "url", default: str = "allow"
) -> DataFrame:
    """The same for a rule table (host, path, verdict) of any size: one equi-join.

    Each URL is joined by the suffixes of its host; the best rule per ``key``
    (unique) is an aggregate. Returns key, host, path, rule, verdict.
    """
    host, path = host_and_path(F.col(url))
    labels = F.split("host", "[.]")
    count = F.size("labels")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.col("count")),
        lambda i: F.array_join(F.slice("labels", i, F.col("count")), "."),
    )
    parts = urls.select(key, host.alias("host"), path.alias("path")).withColumn("labels", labels)
    parts = parts.withColumn("count", count).withColumn("rule_host", F.explode(suffixes))
    known = rules.select(
        F.translate("host", UPPER, LOWER).alias("rule_host"),
        F.col("path").alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    )
    fits = (F.col("host") != "") & F.startswith(F.col("path"), F.col("rule_path"))
    joined = parts.join(known, "rule_host", "left").withColumn("fits", F.coalesce(fits, F.lit(False)))
    order = F.struct(F.length("rule_host"), F.length("rule_path"), F.col("rule_verdict"))
    rule = F.concat("rule_host", "rule_path")
    best = joined.groupBy(key, "host", "path").agg(
        F.max_by(F.when(F.col("fits"), F.struct(rule.alias("r"), F.col("rule_verdict").alias("v"))),
                 F.when(F.col("fits"), order)).alias("best")
    )
    return best.select(
        key, "host", "path", F.col("best.r").alias("rule"),
        F.coalesce("best.v", F.lit(default)).alias("verdict"),
    )


def rules_sql(rules: Sequence[Rule]) -> tuple[str, str]:
    """DuckDB expressions over host and path for the winning rule and its verdict."""
    order = sorted(rules, key=lambda r: (-len(r[0]), -len(r[1]), r[2] == "allow"))
    fits = [
        f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in order
    ]
    rule = reduce(lambda s, x: f"{s} WHEN {x[0]} THEN '{x[1][0]}{x[1][1]}'", zip(fits, order), "CASE")
    verdict = reduce(lambda s, x: f"{s} WHEN {x[0]} THEN '{x[1][2]}'", zip(fits, order), "CASE")
    return f"{rule} END", f"{verdict} END"
