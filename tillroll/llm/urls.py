"""URL filter: listed rules, and association rules over URL tokens for the rest.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; the path goes on up to ``?``, ``#`` or the end. Both are empty for a null URL
or one without ``://``. A listed rule (host, path, verdict) fits its host and all
subdomains if the path starts with the rule's; the longest that fits decides.

URLs that a listed rule decides are the labels that FP-growth learns from: every URL is
the set of its tokens (parts of the host, path words, names of parameters, fragment;
digits only as 0), and "block" or "allow" is one more item. Rules {tokens} -> block or
allow are kept if they name a part of the host, from a minimum support and confidence on,
without those that a shorter rule makes superfluous. An index by the rarest token of each
rule finds the rules whose tokens a URL holds; the most confident, then best supported one
decides, and a tie or no rule allows. Tokens of the listed rules themselves would only
repeat these rules and are no items.

FP-growth merges equal token sets into trees before its shuffle, so a host with a third of
all URLs is no hot spot; the rules that go to the driver and to every task are bounded by
support and length. Empty hosts hold no token and are allowed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Verdict, host and path of the listed rules.
LISTED = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
BLOCK, ALLOW = "block", "allow"
LEAST_SUPPORT = 0.005
LEAST_CONFIDENCE = 0.8
#: Longest rule, in tokens. With the least support it bounds the number of rules.
LONGEST_RULE = 3


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def listed_rule(host: Column, path: Column, listed=LISTED) -> Column:
    """(rule, verdict) of the longest listed rule that fits, or null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule_host, rule_path in sorted(listed, key=lambda rule: len(rule[1] + rule[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        here = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, here).otherwise(found)
    return found


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL; digits within a token become 0."""
    plain = lambda part: F.regexp_replace(F.lower(part), "[0-9]+", "0")
    named = lambda kind, parts: F.transform(parts, lambda part: F.concat(F.lit(f"{kind}:"), plain(part)))
    names = F.regexp_extract_all(F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit("")), F.lit(r"([^=&]+)(?==|&|$)"), 1)
    every = F.concat(
        named("host", F.split(host, r"[.\-:@]")),
        named("path", F.split(path, r"[/._\-]")),
        named("name", names),
        named("part", F.filter(F.array(F.regexp_extract(url, r"#(.*)$", 1)), lambda part: part != "")),
    )
    return F.array_distinct(F.filter(every, lambda token: ~token.rlike(r"^\w+:$")))


def own_tokens(listed=LISTED) -> list[str]:
    """Tokens of the listed rules' own hosts and paths."""
    hosts = {f"host:{part}" for _, host, _ in listed for part in host.split(".")}
    return sorted(hosts | {f"path:{part}" for _, _, path in listed for part in path.split("/") if part})


@dataclass
class TokenRules:
    """(tokens, verdict, confidence, support), and the rules under the rarest token of each."""

    rules: list[tuple[frozenset, str, float, float]]

    def __post_init__(self) -> None:
        held = defaultdict(int)
        for tokens, *_ in self.rules:
            for token in tokens:
                held[token] += 1
        self.index = defaultdict(list)
        for rule in self.rules:
            self.index[min(rule[0], key=lambda token: (held[token], token))].append(rule)

    def verdict(self, tokens) -> str:
        here = set(tokens)
        fitting = [rule for token in here for rule in self.index.get(token, ()) if rule[0] <= here]
        best = max((rule[2:] for rule in fitting), default=None)
        return BLOCK if best and {rule[1] for rule in fitting if rule[2:] == best} == {BLOCK} else ALLOW


def prune(found: list[tuple[frozenset, str, float, float]]) -> list[tuple[frozenset, str, float, float]]:
    """Without the rules that have a shorter one inside, of the same verdict and as confident."""
    kept: list[tuple[frozenset, str, float, float]] = []
    by_token = defaultdict(list)
    for rule in sorted(found, key=lambda rule: (len(rule[0]), sorted(rule[0]))):
        shorter = [other for token in rule[0] for other in by_token[token]]
        if any(other[0] < rule[0] and other[1] == rule[1] and other[2] >= rule[2] for other in shorter):
            continue
        kept.append(rule)
        for token in rule[0]:
            by_token[token].append(rule)
    return kept


def mine(
    labelled: DataFrame, support: float = LEAST_SUPPORT, confidence: float = LEAST_CONFIDENCE
) -> TokenRules:
    """Rules of the rows (tokens, verdict). Their number is bounded by support and length."""
    verdicts = [f"={BLOCK}", f"={ALLOW}"]
    rows = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    if rows.isEmpty():
        return TokenRules([])
    partitions = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence, numPartitions=partitions).fit(rows)
    mined = model.associationRules.filter(F.element_at("consequent", 1).isin(verdicts))
    mined = mined.filter(F.exists("antecedent", lambda token: token.startswith("host:")))
    mined = mined.filter((F.size("antecedent") <= LONGEST_RULE) & ~F.arrays_overlap("antecedent", F.array(*map(F.lit, verdicts))))
    return TokenRules(
        prune([(frozenset(row["antecedent"]), row["consequent"][0][1:], row["confidence"], row["support"]) for row in mined.collect()])
    )


def apply_rules(tokens: Column, rules: TokenRules) -> Column:
    @F.pandas_udf("string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(rules.verdict)

    return judge(tokens)


def judge_urls(pages: DataFrame, columns: list[str], url: str = "url", listed=LISTED) -> DataFrame:
    """``columns`` of every row with host, path, listed rule or null, and verdict."""
    parts = pages.select(*columns, F.col(url).alias("_url"))
    parts = parts.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    ignored = F.array(*map(F.lit, own_tokens(listed)))
    tokens = F.array_except(tokens_of(F.coalesce("_url", F.lit("")), F.col("host"), F.col("path")), ignored)
    parts = parts.withColumn("_listed", listed_rule(F.col("host"), F.col("path"), listed))
    parts = parts.withColumn("_tokens", F.when(F.col("host") != "", tokens).otherwise(F.array().cast("array<string>")))
    rules = mine(parts.filter("_listed IS NOT NULL").select(F.col("_tokens").alias("tokens"), "_listed.verdict"))
    judged = parts.withColumn("_mined", apply_rules(F.col("_tokens"), rules))
    return judged.select(
        *columns, "host", "path", F.col("_listed.rule").alias("rule"), F.coalesce("_listed.verdict", "_mined").alias("verdict")
    )
