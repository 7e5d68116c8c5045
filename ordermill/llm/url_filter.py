"""URL filter: a trie over reversed host labels, then over path segments.

A rule fits its host and all subdomains, where the url's path starts with the
rule's path. Of several rules that fit, the one with more host labels wins, then
the longer path, then block before allow; without any the default holds.

Null urls, and urls without ``://``, have an empty host and path: no rule fits.
Repeated rows are judged one by one; an empty table gives no rows; of the input
only the id and url columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules in one broadcast trie. More are judged in several passes.
MAX_RULES = 200_000

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """``path`` is empty, or starts with a slash."""

    action: str
    host: str
    path: str


def parse_rule(action: str, text: str) -> Rule:
    """``net/`` or ``example.net/en/``: the host, up to the first slash, then the path."""
    if action not in (ALLOW, BLOCK):
        raise ValueError(f"action must be allow or block, got {action!r}")
    host, slash, rest = text.partition("/")
    return Rule(action, host, slash + rest)


class Trie:
    """Nodes are ``[children by host label, path node]``; path nodes are ``[children
    by segment, {last, perhaps unfinished, segment: rule}, lengths of these last
    segments, longest first]``."""

    def __init__(self, rules: Iterable[Rule]) -> None:
        self.root: list = [{}, None]
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node[0].setdefault(label, [{}, None])
            if node[1] is None:
                node[1] = [{}, {}, []]
            place = node[1]
            *whole, last = rule.path.split("/")
            for segment in whole:
                place = place[0].setdefault(segment, [{}, {}, []])
            if len(last) not in place[2]:
                place[2].append(len(last))
                place[2].sort(reverse=True)
            other = place[1].get(last)
            if other is None or rule.action == BLOCK:
                place[1][last] = rule

    def longest(self, host: str, path: str) -> tuple[int, Rule] | None:
        """The winning rule and its number of host labels."""
        node, fitting = self.root, []
        for depth, label in enumerate(reversed(host.split(".")), 1):
            node = node[0].get(label)
            if node is None:
                break
            if node[1] is not None:
                fitting.append((depth, node[1]))
        for depth, place in reversed(fitting):
            rule = _longest_path(place, path)
            if rule is not None:
                return depth, rule
        return None


def _longest_path(place: list, path: str) -> Rule | None:
    found = None
    for segment in path.split("/"):
        # One look for each length, however many rules end here.
        for length in place[2]:
            rule = place[1].get(segment[:length]) if length <= len(segment) else None
            if rule is not None:
                found = rule
                break
        place = place[0].get(segment)
        if place is None:
            break
    return found


def url_parts(df: DataFrame, url: str) -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.withColumns({"host": lower, "path": path})


_JUDGED = "host string, path string, rule string, verdict string, _labels int, _length int"


def _pass(df: DataFrame, rules: list[Rule], ids: list[str]) -> DataFrame:
    """One trie's judgement; a better one of an earlier pass stays."""
    trie = df.sparkSession.sparkContext.broadcast(Trie(rules))
    out = df.select(*ids).schema.fieldNames()
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in df.select(*ids).dtypes)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trie.value
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            old = [columns[c].to_pylist() for c in ("rule", "verdict", "_labels", "_length")]
            rows = zip(columns["host"].to_pylist(), columns["path"].to_pylist(), *old)
            new: list[tuple] = []
            for host, path, *so_far in rows:
                best = tree.longest(host, path)
                if best is not None:
                    depth, rule = best
                    mine = (depth, len(rule.path), rule.action == BLOCK)
                    if mine > (so_far[2], so_far[3], so_far[1] == BLOCK):
                        so_far = [rule.host + rule.path, rule.action, depth, len(rule.path)]
                new.append(tuple(so_far))
            judged = list(zip(*new)) if new else [[], [], [], []]
            kinds_ = (pa.string(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [columns[c] for c in out]
                + [columns["host"], columns["path"]]
                + [pa.array(v, type=k) for v, k in zip(judged, kinds_)],
                names=[*out, "host", "path", "rule", "verdict", "_labels", "_length"],
            )

    return df.mapInArrow(judge, f"{kinds}, {_JUDGED}")


def filter_urls(
    df: DataFrame,
    rules: Iterable[Rule],
    *,
    url: str = "url",
    keep: tuple[str, ...] = ("page_id",),
    default: str = ALLOW,
    max_rules: int = MAX_RULES,
) -> DataFrame:
    """``keep`` columns, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``.

    Nothing is shuffled. The rules are broadcast ``max_rules`` at a time, so the
    size of a broadcast has a bound whatever their number.
    """
    rules = list(rules)
    ids = [f"`{name}`" for name in keep]
    judged = url_parts(df.select(*ids, F.col(url).alias("_url")), "_url").select(
        *ids,
        "host",
        "path",
        F.lit(None).cast("string").alias("rule"),
        F.lit(default).alias("verdict"),
        F.lit(-1).alias("_labels"),
        F.lit(-1).alias("_length"),
    )
    for start in range(0, len(rules), max_rules):
        judged = _pass(judged, rules[start : start + max_rules], ids)
    return judged.drop("_labels", "_length")
