"""URL rules by longest match in a trie over reversed host labels and path segments.

A rule is (verdict, host, path). It fits its host and all subdomains, where the path starts with the rule's path.
The longest rule (host and path together, then host) decides; without one the verdict is `DEFAULT`. The trie goes to
every task, so it holds `MOST_RULES` rules at most; longer lists are looked up in several tries, one pass each.

Null urls and urls without `://` have an empty host and path, which no rule fits.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, table

#: The rules that the query applies.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT = "allow"
MOST_RULES = 100_000

_LOWER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    stop = min((k for k in map(rest.find, "?#") if k >= 0), default=len(rest))
    slash = rest.find("/", 0, stop)
    host = rest[: slash if slash >= 0 else stop]
    return host.translate(_LOWER), rest[len(host) : stop]


class RuleTrie:
    """Nodes are dictionaries by host label, from the last; each holds a trie by path segment for the rules of its host.

    The last segment of a rule's path is a prefix: it is kept among the node's `tails` and looked up by length.
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(("host", label), {})
            *segments, tail = path.split("/")
            for segment in segments:
                node = node.setdefault(("path", segment), {})
            node.setdefault("tails", {})[tail] = (len(host) + len(path), len(host), host + path, verdict)

    def match(self, host: str, path: str) -> tuple | None:
        found, node = None, self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(("host", label))
            if node is None:
                break
            inner = node
            for segment in segments:
                tails = inner.get("tails", {})
                for length in range(len(segment) if tails else -1, -1, -1):
                    if rule := tails.get(segment[:length]):
                        found = max(found or rule, rule)
                        break
                inner = inner.get(("path", segment))
                if inner is None:
                    break
        return found


def judge(pages: DataFrame, rules=RULES, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of `pages` (page_id, url)."""
    rules = list(rules)
    tries = [RuleTrie(rules[at : at + MOST_RULES]) for at in range(0, len(rules), MOST_RULES)]

    def passed(trie: RuleTrie):
        def step(batch: pa.RecordBatch) -> dict:
            split = [split_url(u) for u in batch.column("url").to_pylist()]
            new = [trie.match(*s) for s in split]
            if "size" in batch.schema.names:
                old = zip(*(batch.column(c).to_pylist() for c in ("size", "host_size", "rule", "verdict")), strict=True)
                new = [max((m for m in (n, o if o[0] is not None else None) if m), default=None) for n, o in zip(new, old, strict=True)]
            cells = zip(*[m or (None,) * 4 for m in new], strict=True)
            made = dict(zip(("size", "host_size", "rule", "verdict"), cells, strict=True))
            return made | {"page_id": batch.column("page_id"), "url": batch.column("url"), "host": [s[0] for s in split], "path": [s[1] for s in split]}

        return step

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    for trie in tries:
        rows = map_batches(rows, passed(trie), "page_id long, url string, host string, path string, size long, host_size long, rule string, verdict string")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _twin() -> str:
    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    order = sorted(RULES, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1])))
    fits = [(f"(host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in order]
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    return f"""
    WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
    parts AS (SELECT page_id, translate(raw, '{upper}', '{lower}') AS host,
                     regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts)
    SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} ELSE '{DEFAULT}' END AS verdict FROM parts"""


ORACLE_SQL = {"op3_url_filter": _twin()}
