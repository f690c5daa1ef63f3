"""URL allow and block lists: a trie over reversed host labels, then path segments."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest text of rules (host, path and verdict characters) in one broadcast
#: trie. A longer list is applied as several tries, one after the other.
MAX_TRIE_CHARS = 8_000_000

#: The production list of the registered query: (verdict, host, path).
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def build_trie(rules: Iterable[tuple[str, str, str]]) -> dict:
    """Nested dictionaries: host labels from the last to the first, then under
    key None the path, one whole segment (ending in ``/``) per level. A node's
    "" holds {tail: (rank, rule, verdict)}, where tail is what the rule's path
    has after its last ``/``: the url's next segment must start with it. A node's
    0 holds the tails' lengths, the only beginnings of a segment worth a look.

    The rank orders fitting rules: more host labels, then the longer path. Of
    two entries for the same host and path, block wins.
    """
    root: dict = {}
    for verdict, host, path in rules:
        labels = host.split(".")
        node = root
        for label in reversed(labels):
            node = node.setdefault(label, {})
        node = node.setdefault(None, {})
        *segments, tail = path.split("/")
        for s in segments:
            node = node.setdefault(s + "/", {})
        found = ((len(labels), len(path), verdict == "block"), host + path, verdict)
        tails = node.setdefault("", {})
        node.setdefault(0, set()).add(len(tail))
        if tail not in tails or tails[tail] < found:
            tails[tail] = found
    return root


def lookup(trie: dict, host: str, path: str) -> tuple | None:
    """The highest ranked rule that fits, as (rank, rule, verdict)."""
    best = None
    node: dict | None = trie
    pieces: list[str] | None = None
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        at = node.get(None)
        if at is None:
            continue
        if pieces is None:
            *whole, last = path.split("/")
            pieces = [s + "/" for s in whole] + [last]
        for k in range(len(pieces) + 1):
            rest = pieces[k] if k < len(pieces) else ""
            for end in at.get(0, ()):
                found = at[""].get(rest[:end])
                if found and (best is None or found > best):
                    best = found
            at = at.get(rest) if rest else None
            if at is None:
                break
    return best


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for NULL or a text
    without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def blocks_of(rules: Iterable[tuple[str, str, str]], limit: int) -> Iterable[list[tuple[str, str, str]]]:
    """Consecutive runs of rules of at most ``limit`` characters each."""
    block, size = [], 0
    for rule in rules:
        if block and size + sum(map(len, rule)) > limit:
            yield block
            block, size = [], 0
        block.append(rule)
        size += sum(map(len, rule))
    yield block


def judge_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]] = RULES,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
    max_trie_chars: int = MAX_TRIE_CHARS,
) -> DataFrame:
    """``key``, host, path, rule and verdict of every row.

    The rule is the longest that fits (see ``build_trie``); without one the
    verdict is ``default``. Each trie is broadcast; its size is bounded by
    ``max_trie_chars``, and a longer list is judged trie by trie, keeping the
    best rule so far in a column. NULL urls and texts without ``://`` have an
    empty host and path, which no rule fits. A url of any length is judged whole,
    in time linear in it; equal rows get equal verdicts; an empty table gives no
    rows. Only ``key`` and ``url`` are read, whatever other columns are named.
    """
    sc = pages.sparkSession.sparkContext
    host, path = host_and_path(F.col(url))
    out = pages.select(F.col(key).alias(key), host.alias("host"), path.alias("path"))
    kind = "struct<labels:int,chars:int,block:int,rule:string,verdict:string>"
    out = out.withColumn("_best", F.lit(None).cast(kind))
    for block in blocks_of(rules, max_trie_chars):
        trie = sc.broadcast(build_trie(block))

        @F.pandas_udf(kind)
        def best_rule(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
            rows = []
            for h, p in zip(hosts, paths):
                found = lookup(trie.value, h, p)
                rows.append((*map(int, found[0]), found[1], found[2]) if found else (-1, -1, -1, None, None))
            return pd.DataFrame(rows, columns=["labels", "chars", "block", "rule", "verdict"])

        out = out.withColumn("_best", F.greatest("_best", best_rule("host", "path")))
    return out.select(
        key, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict")
    )
