"""Allow and block rules on URLs, matched through a broadcast trie."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import ship_code

#: Largest number of rules in one broadcast trie; longer lists are matched in several.
RULES_PER_TRIE = 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class UrlTrie:
    """Host labels from the last to the first, then path segments.

    A node is ``{"next": label -> node, "paths": path node}``; a path node is
    ``{"next": segment -> path node, "tails": start of the next segment -> verdict}``.
    ``None`` among a node's keys stands for a rule without any path.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: dict = {"next": {}, "paths": None, "bare": None}
        for rule, verdict in rules:
            self._add(rule, verdict)

    def _add(self, rule: str, verdict: str) -> None:
        host, slash, path = rule.partition("/")
        node = self.root
        for label in reversed(host.split(".")):
            node = node["next"].setdefault(label, {"next": {}, "paths": None, "bare": None})
        if not slash:
            node["bare"] = self._stricter(node["bare"], (rule, verdict))
            return
        place = node["paths"] = node["paths"] or {"next": {}, "tails": {}}
        *segments, tail = path.split("/")
        for segment in segments:
            place = place["next"].setdefault(segment, {"next": {}, "tails": {}})
        place["tails"][tail] = self._stricter(place["tails"].get(tail), (rule, verdict))

    @staticmethod
    def _stricter(old: tuple[str, str] | None, new: tuple[str, str]) -> tuple[str, str]:
        return old if old and old[1] == "block" else new

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest rule that fits; of equally long ones, the one with more host."""
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node["next"].get(label)
            if node is None:
                break
            for found in self._paths(node, path):
                if best is None or len(found[0]) >= len(best[0]):
                    best = found
        return best

    @staticmethod
    def _paths(node: dict, path: str) -> Iterator[tuple[str, str]]:
        """All rules of one host that fit the path."""
        if node["bare"]:
            yield node["bare"]
        place = node["paths"]
        if place is None or not path.startswith("/"):
            return
        segments = path[1:].split("/")
        for i, segment in enumerate(segments):
            tails = place["tails"]
            if tails:
                for k in range(len(segment) + 1):
                    if segment[:k] in tails:
                        yield tails[segment[:k]]
            if i == len(segments) - 1:
                return
            place = place["next"].get(segment)
            if place is None:
                return


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case and path; both empty without ``://`` or for null."""
    known = F.coalesce(url.cast("string"), F.lit(""))
    start = F.instr(known, "://")
    rest = F.when(start > 0, F.substr(known, start + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def url_verdicts(
    pages: DataFrame,
    rules: Iterable[tuple[str, str]],
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
    rules_per_trie: int = RULES_PER_TRIE,
) -> DataFrame:
    """Judge every URL: key, host, path, rule, verdict; one row per input row.

    ``rules`` are (``host/path``, ``allow`` or ``block``) pairs. A rule fits its host and
    all subdomains when the path starts with the rule's path, and a rule without a slash
    fits any path; the longest rule wins, then the one with the longer host. If a rule
    is listed twice, ``block`` wins. Without a fitting rule the rule is null and the verdict
    ``default``. Null URLs have an empty host and path; repeated rows are judged alike;
    an empty table or rule list is allowed. There is no shuffle, so hot hosts do not matter.

    A broadcast trie holds ``rules_per_trie`` rules at most. A longer list makes several
    tries, and the longest of their matches wins, which is the same result.
    """
    host, path = host_and_path(F.col(url))
    out = pages.select(
        F.col(key).alias("key"), host.alias("host"), path.alias("path"),
        F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"),
    )
    rest = iter(rules)
    while piece := list(islice(rest, rules_per_trie)):
        out = _match(out, piece)
    return out.withColumnRenamed("key", key)


def _match(out: DataFrame, piece: list[tuple[str, str]]) -> DataFrame:
    """Replace rule and verdict where a rule of the piece wins over the earlier pieces'."""
    ship_code(out.sparkSession)
    shared = out.sparkSession.sparkContext.broadcast(UrlTrie(piece))

    @F.pandas_udf("struct<rule string, verdict string>")
    def find(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        find_one = shared.value.find
        found = [find_one(h, p) or (None, None) for h, p in zip(hosts, paths, strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    labels = F.length(F.substring_index("rule", "/", 1))
    new = F.col("found.rule")
    new_labels = F.length(F.substring_index(new, "/", 1))
    longer = F.length(new) > F.length("rule")
    same = F.length(new) == F.length("rule")
    wins = new.isNotNull() & (
        F.col("rule").isNull() | longer
        | same & (new_labels > labels)
        | same & (new_labels == labels) & (F.col("found.verdict") == "block")
    )
    found = out.withColumn("found", find("host", "path"))
    return found.select(
        "key", "host", "path",
        F.when(wins, new).otherwise(F.col("rule")).alias("rule"),
        F.when(wins, F.col("found.verdict")).otherwise(F.col("verdict")).alias("verdict"),
    )
