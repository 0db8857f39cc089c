"""URL filters: path rules by host, then pattern rules found by their rarest word.

Everything here is a Spark expression; no Python runs on the executors.

A pattern rule names literal words that every url it matches holds as whole words
(runs of a-z and 0-9). Each rule is filed under the one of its words that the
fewest urls hold, counted over all urls. A url's words fetch the rules filed under
them, and only those rules' regular expressions run on it.

A null url, or one without ``://``, has an empty host and path and is allowed. Rows
are judged one by one, so repeated rows and extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.arrow import column, without


class PathRule(NamedTuple):
    verdict: str
    host: str
    path: str


class PatternRule(NamedTuple):
    words: tuple[str, ...]
    pattern: str


# The rules of the registered query, by host and start of path.
PATH_RULES = (
    PathRule("allow", "org", "/"),
    PathRule("block", "example.org", "/es/"),
    PathRule("block", "example.org", "/en/1"),
    PathRule("allow", "com", "/fr/"),
    PathRule("block", "com", "/de/"),
)

_EDGE = "[^a-z0-9]"


def phrase(*words: str) -> PatternRule:
    """A rule for the words one after another with one sign between them."""
    return PatternRule(words, f"(^|{_EDGE})" + _EDGE.join(words) + f"({_EDGE}|$)")


# What the urls of unwanted pages say.
PATTERN_RULES = (
    *(phrase(a, b) for a, b in (
        ("spam", "farm"), ("link", "farm"), ("content", "farm"), ("cheap", "pills"),
        ("buy", "pills"), ("diet", "pills"), ("ads", "track"), ("ad", "tracker"),
        ("free", "casino"), ("online", "casino"), ("payday", "loans"), ("adult", "dating"),
        ("crack", "download"), ("warez", "download"), ("fake", "watches"),
    )),
    PatternRule(("casino",), f"(^|{_EDGE})casino{_EDGE}+(bonus|slots|poker)({_EDGE}|$)"),
    PatternRule(("login", "verify"), f"(^|{_EDGE})login({_EDGE}.*{_EDGE}|{_EDGE})verify({_EDGE}|$)"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return _lower(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def words_of(url: Column) -> Column:
    """The distinct words (runs of a-z and 0-9, lower-cased) of a url."""
    return F.array_distinct(F.split(_lower(F.coalesce(url, F.lit(""))), f"{_EDGE}+"))


def _path_rule(host: Column, path: Column, rules: Sequence[PathRule]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits; nulls if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r.host + r.path)):  # the last that fits wins
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.host + rule.path).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def rarest_words(df: DataFrame, rules: Sequence[PatternRule], url: str = "url") -> dict[str, list[PatternRule]]:
    """Each rule under the one of its words that the fewest urls of ``df`` hold.

    One pass with one count for each word that some rule names, so what reaches the
    driver is bounded by the rules.
    """
    names = sorted({word for rule in rules for word in rule.words})
    if not names:
        return {}
    words = df.select(words_of(column(url)).alias("words"))
    counts = words.agg(
        *(F.count_if(F.array_contains("words", word)).alias(f"w{i}") for i, word in enumerate(names))
    ).first()
    seen = dict(zip(names, counts, strict=True))
    index: dict[str, list[PatternRule]] = {}
    for rule in rules:
        index.setdefault(min(rule.words, key=lambda word: (seen[word], word)), []).append(rule)
    return index


def _matches(url: Column, words: Column, index: dict[str, list[PatternRule]]) -> Column:
    """Whether a rule filed under one of the words matches the url."""
    if not index:
        return F.lit(False)
    entries = []
    for word, rules in sorted(index.items()):
        entries += [F.lit(word), F.array(*(F.lit(rule.pattern) for rule in rules))]
    filed = F.create_map(*entries)
    fetched = F.flatten(F.filter(F.transform(words, lambda word: F.element_at(filed, word)), lambda x: x.isNotNull()))
    return F.exists(fetched, lambda pattern: F.regexp_like(_lower(F.coalesce(url, F.lit(""))), pattern))


def judge_urls(
    df: DataFrame,
    path_rules: Sequence[PathRule] = PATH_RULES,
    pattern_rules: Sequence[PatternRule] = PATTERN_RULES,
    url: str = "url",
) -> DataFrame:
    """Append host, path, rule and verdict to every row.

    The longest path rule that fits decides; without one, a matching pattern rule
    blocks and anything else is allowed. Columns of ``df`` named like a new one give
    way to it.
    """
    index = rarest_words(df, pattern_rules, url)
    rest = without(df, ["host", "path", "rule", "verdict"])
    kept = [column(name) for name in rest]
    address = column(url) if url in rest else column(url).alias(url)
    host, path = host_and_path(address)
    parts = df.select(*kept, host.alias("host"), path.alias("path"))
    rule, verdict = _path_rule(F.col("host"), F.col("path"), path_rules)
    found = _matches(column(url), words_of(column(url)), index)
    return parts.select(
        *kept, "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(found, "block").otherwise("allow")).alias("verdict"),
    )
