"""URL rules, and exact list membership by a cascade of Bloom filters.

A cascade needs the whole universe of keys that will ever be asked. Level 1 holds the listed keys; level 2 the other keys of
the universe that level 1 lets through; level 3 the listed keys that level 2 lets through, and so on until nothing is let
through. A key's answer is the parity of the first level that does not hold it. Levels shrink geometrically, so the whole
takes a few bits per listed key and answers every key of the universe exactly, inside one expression."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm.common import with_results
from martworks.session import written

# A filter is read from memory by every task (about 8 MB of bits for so many listed keys). Keys of longer lists are dealt by hash to as many
# cascades as that takes, and pages are judged cascade by cascade.
MAX_FILTER_KEYS = 4_000_000
LATER_LEVEL_BITS = 6


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


# The rules.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case. Path: from there up to `?`, `#` or the
    end. Both empty for a null or a text without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """(name, verdict) of the longest rule that fits, else null. A rule fits its host and the subdomains of it, where the
    path starts with the rule's."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


@dataclass(frozen=True)
class Level:
    """One Bloom filter: a one-row table with its words of 64 bits, read as a scalar subquery."""

    words: DataFrame
    bits: int
    hashes: int
    number: int

    @staticmethod
    def places(key: Column, bits: int, hashes: int, number: int) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(bits).cast("long")) for i in range(hashes)]

    @classmethod
    def of(cls, keys: DataFrame, count: int, bits_per_key: float, number: int) -> Level:
        n_words = max(1, math.ceil(count * bits_per_key / 64))
        bits, hashes = n_words * 64, max(1, round(bits_per_key * math.log(2)))
        place = F.explode(F.array(*cls.places(F.col("key"), bits, hashes, number))).alias("place")
        bit = F.expr("shiftleft(1L, cast(pmod(place, 64) AS INT))")
        filled = keys.select(place).groupBy(F.shiftright("place", 6).alias("id")).agg(F.bit_or(bit).alias("word"))
        dense = keys.sparkSession.range(n_words).join(filled, "id", "left").select("id", F.coalesce("word", F.lit(0)).alias("word"))
        ordered = F.array_sort(F.collect_list(F.struct("id", "word")))
        return cls(written(dense.agg(F.transform(ordered, lambda x: x["word"]).alias("words")), "bloom-level"), bits, hashes, number)

    def may_hold(self, key: Column) -> Column:
        words = self.words.scalar()
        return reduce(Column.__and__, (
            F.call_function("getbit", F.get(words, F.shiftright(place, 6).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1
            for place in self.places(key, self.bits, self.hashes, self.number)))


@dataclass(frozen=True)
class Cascade:
    """Exact membership for every key of the universe that it was built over."""

    levels: tuple[Level, ...]

    @classmethod
    def build(cls, universe: DataFrame, listed: DataFrame) -> Cascade:
        """`universe` and `listed` have one column `key`; repeated keys and keys of the list outside the universe are no
        harm, nulls are left out. The driver sees a count per level."""
        inside = written(listed.filter(F.col("key").isNotNull()).distinct(), "bloom-keys")
        outside = written(universe.filter(F.col("key").isNotNull()).distinct().join(inside, "key", "left_anti"), "bloom-keys")
        levels: list[Level] = []
        while count := inside.count():
            # The first level faces the whole universe, a later one only what came through: about as many keys as it holds.
            ratio = 0 if levels else math.log2(max(1, outside.count()) / count)
            level = Level.of(inside, count, max(LATER_LEVEL_BITS, 1.44 * ratio + LATER_LEVEL_BITS / 2), len(levels))
            levels.append(level)
            inside, outside = written(outside.filter(level.may_hold(F.col("key"))), "bloom-keys"), inside
        return cls(tuple(levels))

    def holds(self, key: Column) -> Column:
        found = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            found = F.when(level.may_hold(key), found).otherwise(F.lit(level.number % 2 == 1))
        return F.coalesce(found, F.lit(False))


def judge(pages: DataFrame, url: str, listed: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of `pages` with `host`, `path`, `rule` (null if none fits) and `verdict`: the rule's, else `block` for a host
    among `listed` (one column `key`), else `allow`. A null or malformed url has an empty host, which a list may hold."""
    host, path = host_and_path(F.col(f"`{url}`"))
    keyed = with_results(pages, host=host, path=path)
    found = longest_rule(F.col("host"), F.col("path"), rules)
    listed = written(listed.filter(F.col("key").isNotNull()).distinct(), "bloom-list")
    parts = max(1, -(-listed.count() // MAX_FILTER_KEYS))

    def judged(part: int) -> DataFrame:
        ours = lambda key: F.pmod(F.xxhash64(key), F.lit(parts)) == part
        pages, names = (keyed, listed) if parts == 1 else (keyed.filter(ours("host")), listed.filter(ours("key")))
        cascade = Cascade.build(pages.select(F.col("host").alias("key")), names)
        own = F.when(cascade.holds(F.col("host")), "block").otherwise("allow")
        return with_results(pages, rule=found["name"], verdict=F.coalesce(found["verdict"], own))

    return reduce(DataFrame.unionByName, map(judged, range(parts)))
