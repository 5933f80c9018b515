"""URL filtering with pattern rules that are indexed by their rarest literal token.

A rule is a pattern in the notation of ad-block lists: ``||`` is the start of a
host or of one of its labels, ``^`` a separator or an end, ``*`` anything, and the
rest is literal. Each rule is filed under the rarest token that every matching URL
must hold, by the tokens' counts in the URLs themselves. A URL's tokens fetch the
rules filed under them, and only these run as regular expressions.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.names import unused

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TOKEN = "[a-z0-9]+"
MAX_RULE_BYTES = 32 << 20  # patterns that a task holds; more must be split into several calls


@dataclass(frozen=True)
class UrlRule:
    """A named pattern with a verdict; of fitting rules the higher rank, then the longer wins."""

    name: str
    pattern: str
    verdict: str = "block"
    rank: int = 0

    def regex(self) -> str:
        body = self.pattern
        start = "^(?:[^/]*\\.)?" if body.startswith("||") else ""
        parts = re.split(r"([*^])", body.removeprefix("||"))
        special = {"*": ".*", "^": "(?:[^A-Za-z0-9]|^|$)"}
        return "(?s)" + start + "".join(special.get(part) or re.escape(part) for part in parts)

    def tokens(self) -> set[str]:
        """Tokens that stand whole in every URL that fits."""
        body = self.pattern.lower()
        anchored = body.startswith("||")
        body = body.removeprefix("||")
        found = set()
        for match in re.finditer(TOKEN, body):
            before = body[match.start() - 1] if match.start() else "^" if anchored else "*"
            after = body[match.end()] if match.end() < len(body) else "*"
            if "*" not in (before, after):
                found.add(match[0])
        return found


def host_of(url: Column) -> Column:
    """Between ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def judge_urls(
    pages: DataFrame, rules: Iterable[UrlRule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with host, path, rule, pattern and verdict of each URL.

    Input columns of these names are replaced. A URL that no rule fits, and a null
    URL, gets the default verdict and a null rule. Ties between fitting rules of
    one rank and length go to the smaller name. Repeated rows and URLs are judged
    alike; no row moves, so no host or URL can be too frequent.

    The rules are shared with every task, which ``MAX_RULE_BYTES`` bounds. Only
    tokens of rules are counted, so what reaches the driver is bounded as well.
    """
    rules = sorted(set(rules), key=lambda r: (-r.rank, -len(r.name), r.name))
    if sum(len(r.pattern) + len(r.name) for r in rules) > MAX_RULE_BYTES:
        raise ValueError("too many rules for one call: split them by rank and keep the first verdict")
    pages = pages.drop(*(c for c in ("host", "path", "rule", "pattern", "verdict") if c != url))
    target = F.concat(host_of(F.col(url)), path_of(F.col(url)))
    index = index_rules(rules, token_counts(pages.select(target.alias("target")), rules))
    found = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    found = found.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    (match,) = unused(found, "_match")
    found = found.withColumn(match, _matcher(rules, index, default)(F.concat("host", "path")))
    return found.select(*pages.columns, "host", "path", f"{match}.*")


def token_counts(targets: DataFrame, rules: list[UrlRule]) -> dict[str, int]:
    """How many URLs hold each token that some rule could be filed under."""
    wanted = sorted(set().union(*(r.tokens() for r in rules)))
    if not wanted:
        return {}
    tokens = F.array_distinct(F.regexp_extract_all(F.translate("target", UPPER, UPPER.lower()), F.lit(TOKEN), F.lit(0)))
    held = targets.select(F.explode(tokens).alias("token"))
    names = targets.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
    counted = held.groupBy("token").count().join(names, "token")
    return {row["token"]: row["count"] for row in counted.collect()}


def index_rules(rules: list[UrlRule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rule numbers by rarest token; rules without a token are under the empty one."""
    index = defaultdict(list)
    for k, rule in enumerate(rules):
        token = min(rule.tokens(), key=lambda t: (counts.get(t, 0), t), default="")
        index[token].append(k)
    return dict(index)


def _matcher(rules: list[UrlRule], index: dict[str, list[int]], default: str):
    """Arrow function that returns the first fitting rule's name, pattern and verdict."""
    fields = [pa.field(n, pa.string()) for n in ("rule", "pattern", "verdict")]
    compiled: list = []

    @F.arrow_udf("rule string, pattern string, verdict string")
    def match(target: pa.Array) -> pa.Array:
        if not compiled:
            compiled.extend(re.compile(r.regex()) for r in rules)
        token = re.compile(TOKEN, re.IGNORECASE | re.ASCII)
        rows = []
        for text in target.to_pylist():
            fetched = {"", *map(str.lower, token.findall(text))}
            candidates = sorted(k for t in fetched if t in index for k in index[t])
            first = next((k for k in candidates if compiled[k].search(text)), None)
            if first is None:
                rows.append((None, None, default))
            else:
                rows.append((rules[first].name, rules[first].pattern, rules[first].verdict))
        columns = list(zip(*rows)) if rows else [(), (), ()]
        return pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], fields=fields)

    return match
