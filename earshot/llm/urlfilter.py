"""URL filtering with a broadcast trie over reversed host labels and path segments.

A rule is a host, a path and a verdict. It fits its host and every subdomain when the url's path
starts with the rule's path. Of the rules that fit, the one with most host labels wins, then the
one with the longest path; among equal (host, path) pairs ``block`` wins. Urls no rule fits get
the default verdict.

Defined results: a null url, or one without ``://``, has an empty host and an empty path, and gets
the default verdict unless a rule has an empty host. Ports and user names stay part of the host.
Repeated rows are judged one by one; an empty table gives an empty result; other columns of the
table are kept only if named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm.words import lower_ascii

MAX_RULE_BYTES = 64 << 20  # the trie is broadcast; longer lists are refused


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass
class PathNode:
    segments: dict[str, PathNode] = field(default_factory=dict)
    ends: list[tuple[str, Rule]] = field(default_factory=list)  # beginnings of the next segment, longest first


@dataclass
class HostNode:
    labels: dict[str, HostNode] = field(default_factory=dict)
    paths: PathNode | None = None


class RuleTrie:
    def __init__(self, rules: Iterable[Rule]):
        self.root = HostNode()
        for rule in rules:
            self._add(rule)

    def _add(self, rule: Rule) -> None:
        if rule.verdict not in ("allow", "block"):
            raise ValueError(f"verdict of {rule.name}: {rule.verdict}")
        node = self.root
        for label in reversed(rule.host.lower().split(".")) if rule.host else ():
            node = node.labels.setdefault(label, HostNode())
        node.paths = path = node.paths or PathNode()
        *whole, rest = rule.path.split("/")
        for segment in whole:
            path = path.segments.setdefault(segment, PathNode())
        for i, (text, other) in enumerate(path.ends):
            if text == rest:
                if other.verdict == "allow" and rule.verdict == "block":
                    path.ends[i] = (rest, rule)
                return
        path.ends.append((rest, rule))
        path.ends.sort(key=lambda end: -len(end[0]))

    def find(self, host: str, path: str) -> Rule | None:
        """The rule of most host labels, then of the longest path, that fits."""
        node, best = self.root, None
        segments = path.split("/")
        if node.paths:
            best = _longest(node.paths, segments)
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            if node.paths:
                best = _longest(node.paths, segments) or best
        return best


def _longest(node: PathNode, segments: list[str]) -> Rule | None:
    best = None
    for i, segment in enumerate(segments):
        best = next((rule for text, rule in node.ends if segment.startswith(text)), best)
        if i + 1 == len(segments):  # the last segment has no slash behind it
            break
        node = node.segments.get(segment)
        if node is None:
            break
    return best


def judge_urls(
    pages: DataFrame, rules: Iterable[Rule], url: str = "url", keep: tuple[str, ...] = ("page_id",), default: str = "allow"
) -> DataFrame:
    """``keep`` columns with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    rules = list(rules)
    if sum(len(r.name) + 64 for r in rules) > MAX_RULE_BYTES:
        raise ValueError(f"rules above {MAX_RULE_BYTES} bytes are not broadcast")
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))
    part = lambda group: F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", group), F.lit(""))
    places = pages.select(*keep, lower_ascii(part(1)).alias("host"), part(2).alias("path"))
    schema = T.StructType(
        [places.schema[c] for c in keep]
        + [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = trie.value.find
        for batch in batches:
            found = [find(h, p) for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist())]
            names = pa.array([r and r.name for r in found], pa.string())
            verdicts = pa.array([r.verdict if r else default for r in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, names, verdicts], [*batch.schema.names, "rule", "verdict"])

    return places.mapInArrow(judge, schema)
