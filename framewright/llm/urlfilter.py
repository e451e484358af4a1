"""Host block list as a cascade of Bloom filters, with rules on top; DataFrame functions only.

Level 0 holds the listed keys. Over the complete set of keys that the corpus can
ask for, level 1 holds the keys that pass level 0 but aren't listed, level 2 the
listed keys that pass level 1, and so on, until a level lets nothing wrong pass.
Membership is then exact for every key of the corpus, and a probe needs no join:
the levels are literals in the expression. A level's size follows from the number
of keys it holds; level 0's false-positive rate is chosen from the ratio of list
to universe, so that level 1 is no larger than the list. All levels together take a
few bytes per listed key (and the logarithm of the universe), whatever the corpus. A long list is
split by a hash of its keys into cascades of about `CASCADE_KEYS` keys, which are built together; a key asks its own only.
The list is given by the driver, so its size is bounded by what a driver and a plan can hold.

Defined cases: a url that is null or has no "://" has empty host and path; rules
and list don't fit an empty host, and its verdict is allow. Null ids and repeated
rows are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm import common

CASCADE_KEYS = 50_000
WORD = 32  # bits of a word of the bit array


@dataclass(frozen=True)
class BloomLevel:
    bits: int
    hashes: int
    seed: int
    words: dict[int, int]  # word index -> word, where not 0

    def might_hold(self, key: Column) -> Column:
        if not self.words:
            return F.lit(False)
        size = -(-self.bits // WORD)
        # a literal array: the optimizer folds the cast of the split text
        words = F.split(F.lit(",".join(str(self.words.get(i, 0)) for i in range(size))), ",").cast("array<long>")
        tests = [F.getbit(F.get(words, F.floor(bit / WORD).cast("int")), (bit % WORD).cast("int")) == 1 for bit in bit_positions(key, F.lit(self.bits), self.hashes, self.seed)]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


def bit_positions(key: Column, bits: Column, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * 1000 + i)), bits) for i in range(hashes)]


def part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts)).cast("int")


def by_part(key: Column, of: list[Column]) -> Column:
    """Of a key's cascade."""
    if len(of) == 1:
        return of[0]
    part, out = part_of(key, len(of)), of[-1]
    for i in range(len(of) - 2, -1, -1):
        out = F.when(part == i, of[i]).otherwise(out)
    return out


def build_level(keys: DataFrame, sizes: list[int], rate: float, seed: int) -> list[BloomLevel]:
    """A level for each cascade, of `sizes` of the keys (column key). What reaches the driver are their words: bounded by the keys."""
    hashes = max(1, round(-math.log2(rate)))
    bits = [max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2)) for n in sizes]
    key = F.col("key")
    own = F.get(F.lit(bits).cast("array<long>"), part_of(key, len(sizes)))
    words = (
        keys.select(part_of(key, len(sizes)).alias("part"), F.explode(F.array(*bit_positions(key, own, hashes, seed))).alias("bit"))
        .groupBy("part", F.floor(F.col("bit") / WORD).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % WORD).cast("int"))).alias("value"))
    )
    found: list[dict[int, int]] = [{} for _ in sizes]
    for r in words.collect():
        found[r["part"]][r["word"]] = r["value"]
    return [BloomLevel(b, hashes, seed, w) for b, w in zip(bits, found)]


def _counts(keys: DataFrame, parts: int) -> list[int]:
    out = [0] * parts
    for r in keys.groupBy(part_of(F.col("key"), parts).alias("part")).count().collect():
        out[r["part"]] = r["count"]
    return out


def build_cascade(universe: DataFrame, listed: tuple[str, ...]) -> list[list[BloomLevel]]:
    """Levels, each of one filter a cascade, for exact membership of `listed` among the keys of `universe` (column key, distinct)."""
    keys = sorted(set(listed))
    if not keys:
        return []
    parts = -(-len(keys) // CASCADE_KEYS)
    held = universe.sparkSession.createDataFrame(pd.DataFrame({"key": keys}), "key string")
    other = universe.filter(~F.col("key").isin(keys)) if len(keys) <= 1000 else universe.join(held, "key", "left_anti")
    sizes, total = _counts(held, parts), other.count()
    levels: list[list[BloomLevel]] = []
    inside, outside = held, other
    rate = min(0.5, len(keys) / (math.sqrt(2) * max(total, 1)))
    while any(sizes):  # a level holds about half of the keys of the one two before
        levels.append(build_level(inside, sizes, rate, len(levels)))
        wrong = outside.filter(by_part(F.col("key"), [x.might_hold(F.col("key")) for x in levels[-1]]))
        if parts > 1 or len(keys) > 1000:
            wrong = common.checkpoint(wrong)
        sizes, rate = _counts(wrong, parts), 0.5
        inside, outside = wrong, inside
    return levels


def in_cascade(key: Column, levels: list[list[BloomLevel]]) -> Column:
    """Exact for keys of the universe: the first level that doesn't hold the key decides."""

    def of(cascade: list[BloomLevel]) -> Column:
        out = F.lit(len(cascade) % 2 == 1)
        for i in range(len(cascade) - 1, -1, -1):
            out = F.when(~cascade[i].might_hold(key), F.lit(i % 2 == 1)).otherwise(out)
        return out

    return by_part(key, [of(list(cascade)) for cascade in zip(*levels)]) if levels else F.lit(False)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domains_of(host: Column) -> Column:
    """A host and the domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rule_fits(host: Column, path: Column, rule: str) -> Column:
    domain, slash, rest = rule.partition("/")
    return ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)


def judge_urls(pages: DataFrame, rules: dict[str, str], listed: tuple[str, ...]) -> DataFrame:
    """(page_id, host, path, rule, verdict): the longest rule ("host/path" -> allow or block) decides, else the list."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = parsed.filter("host <> ''").select("host").distinct()
    universe = common.checkpoint(hosts.select(F.explode(domains_of(F.col("host"))).alias("key")).distinct())
    levels = build_cascade(universe, listed)
    rule = F.lit(None).cast("string")
    for r in sorted(rules, key=len):
        rule = F.when(rule_fits(F.col("host"), F.col("path"), r), F.lit(r)).otherwise(rule)
    by_rule = F.lit(None).cast("string")
    for r, verdict in rules.items():
        by_rule = F.when(F.col("rule") == r, F.lit(verdict)).otherwise(by_rule)
    blocked = (F.col("host") != "") & F.exists(domains_of(F.col("host")), lambda d: in_cascade(d, levels))
    return parsed.withColumn("rule", rule).withColumn("verdict", F.coalesce(by_rule, F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))))
