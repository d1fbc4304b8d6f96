"""URL filters: allow and block rules in one trie, the longest match decides.

The trie is keyed by host labels from the top-level domain down and, below each
host, by path segments. A rule fits its host and all subdomains if the URL's path
starts with the rule's path. Of the fitting rules the one with the most host labels
wins, then the one with the longest path; a block rule wins over an allow rule with
the same host and path. Rule sets are small, are checked against `MAX_RULE_CHARS`
and go to the executors once as a broadcast; the table itself is never shuffled.

Defined results: a null URL, or one without `://`, has an empty host and an empty
path, no rule and the default verdict. An empty table gives an empty result. The
output columns replace input columns of the same name; all other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
# What a broadcast rule set may hold, in characters of all hosts and paths.
MAX_RULE_CHARS = 64_000_000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass
class PathNode:
    segments: dict[str, PathNode] = field(default_factory=dict)
    # Rules that end inside a segment: rest of the rule's path -> rule.
    tails: dict[str, tuple[str, str]] = field(default_factory=dict)


@dataclass
class HostNode:
    labels: dict[str, HostNode] = field(default_factory=dict)
    paths: PathNode | None = None


def build_trie(rules: Sequence[Rule]) -> HostNode:
    if sum(len(r.name) for r in rules) > MAX_RULE_CHARS:
        raise ValueError("the rule set is too large to broadcast")
    root = HostNode()
    for rule in rules:
        if rule.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"unknown verdict {rule.verdict!r}")
        node = root
        for label in reversed(rule.host.lower().split(".")):
            node = node.labels.setdefault(label, HostNode())
        if node.paths is None:
            node.paths = PathNode()
        at = node.paths
        *whole, tail = rule.path.split("/")
        for segment in whole:
            at = at.segments.setdefault(segment, PathNode())
        if rule.verdict == BLOCK or tail not in at.tails:
            at.tails[tail] = (rule.name, rule.verdict)
    return root


def _in_path(node: PathNode, path: str) -> tuple[str, str] | None:
    best, segments, i = None, path.split("/"), 0
    while node is not None:
        rest = segments[i] if i < len(segments) else ""
        for tail in sorted(node.tails, key=len, reverse=True):
            if rest.startswith(tail):
                best = node.tails[tail]
                break
        # A rule's whole segment ends with a slash, so the last one never fits.
        node = node.segments.get(rest) if i < len(segments) - 1 else None
        i += 1
    return best


def longest_match(root: HostNode, host: str, path: str) -> tuple[str, str] | None:
    best, node = None, root
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        if node.paths is not None:
            best = _in_path(node.paths, path) or best
    return best


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """Add `host`, `path`, `rule` and `verdict` to every row of `pages`."""
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("struct<rule:string,verdict:string>")
    def verdicts(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        root = trie.value
        for hosts, paths in parts:
            found = [longest_match(root, h, p) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(
                {
                    "rule": [f[0] if f else None for f in found],
                    "verdict": [f[1] if f else default for f in found],
                }
            )

    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rest = F.when(
        F.contains(text, F.lit("://")),
        F.substring(text, F.locate("://", text) + 3, F.length(text)),
    ).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    out = pages.withColumns({"host": host, "path": path})
    out = out.withColumn("_verdict", verdicts("host", "path"))
    return out.withColumns(
        {"rule": F.col("_verdict.rule"), "verdict": F.col("_verdict.verdict")}
    ).drop("_verdict")
