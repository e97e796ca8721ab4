"""URL filters: Bloom filter cascades that are exact over the corpus's own keys.

A cascade answers "is this key listed?" for every key of a known universe, here all keys that the
corpus's URLs can ask for. Level 1 is a Bloom filter of the listed keys; level 2 one of the universe's
keys that level 1 takes for listed; level 3 one of the listed keys that level 2 takes for those; and
so on until a level has no false positive. A key belongs to the list if the first level that does not
know it has an even number. Rows are judged by look-ups in the levels' bits, without a join.

All levels of a cascade part together stay below `MOST_BITS`, because keys are dealt by hash over as
many parts as that takes; with several parts, rows go through one part at a time. So what tasks hold
has a bound, whatever the list.

Rules: a rule `host/path` fits a URL whose host is the rule's or a subdomain of it and whose path
starts with the rule's. The longest fitting rule decides (of two equally long ones that with the longer
host; a rule listed both ways blocks). Where none fits, the URL is blocked if its address (host and
path) is a listed address, else allowed.

Defined cases: a null URL, and one without "://", has an empty host and path, fits no rule and is
allowed. Empty lists allow everything. Repeated rows and repeated list entries change nothing. Null
list entries are left out. Only the named columns are used, whatever else the tables hold.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cardledger.sources.scratch import saved

MOST_BITS = 1 << 29  # of one cascade part's level: 64 MB
LATER_RATE = 0.5  # false positives of the levels after the first


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path; both empty without "://"."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _places(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(hashes)]


class Level:
    """A Bloom filter: bits set by Spark, looked up in Arrow batches."""

    def __init__(self, keys: DataFrame, n: int, rate: float, level: int):
        self.level = level
        self.hashes = max(1, round(math.log2(1 / rate)))
        self.bits = 64 * max(1, math.ceil(n * 1.4427 * math.log2(1 / rate) / 64))
        if self.bits > MOST_BITS:
            raise ValueError("a level outgrew its bound; deal the keys over more parts")
        place = F.explode(F.array(*_places(F.col("key"), level, self.hashes, self.bits)))
        words = (
            keys.select(place.alias("at"))
            .groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
        )
        self.words = np.zeros(self.bits // 64, np.int64)
        rows = words.toPandas()  # at most bits / 64 rows
        self.words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)

    def knows(self, key: Column) -> Column:
        words = self.words

        @F.pandas_udf("boolean")
        def look(*places: pd.Series) -> pd.Series:
            found = np.ones(len(places[0]), bool)
            for place in places:
                at = place.to_numpy(np.int64)
                found &= (words[at >> 6] >> (at & 63)) & 1 == 1
            return pd.Series(found)

        return look(*_places(key, self.level, self.hashes, self.bits))


class Cascade:
    """Exact membership in `listed` for every key of `universe`; both are tables of distinct `key`."""

    def __init__(self, listed: DataFrame, universe: DataFrame, part: int = 0, parts: int = 1):
        self.part, self.parts, self.levels = part, parts, []
        mine = F.pmod(F.xxhash64("key"), F.lit(parts)) == part
        inside = saved(listed.where(mine), "listed")
        outside = universe.where(mine).join(inside, "key", "left_anti")
        outside = saved(outside, "others")
        n_in, n_out = inside.count(), outside.count()
        rate = min(LATER_RATE, max(n_in, 1) / max(n_out, 1))
        sides, counts = [inside, outside], [n_in, n_out]
        # Level by level: encode one side, keep of the other what the new level mistakes.
        while counts[0]:
            self.levels.append(Level(sides[0], counts[0], rate, len(self.levels) + 1))
            wrong = saved(sides[1].where(self.levels[-1].knows(F.col("key"))), "mistaken")
            sides, counts = [wrong, sides[0]], [wrong.count(), counts[0]]
            rate = LATER_RATE

    def contains(self, key: Column) -> Column:
        """True for listed keys of this part; exact for keys of the universe."""
        mine = F.pmod(F.xxhash64(key), F.lit(self.parts)) == self.part
        answer = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels), 0, -1):
            answer = F.when(self.levels[k - 1].knows(key), answer).otherwise(F.lit(k % 2 == 0))
        return F.coalesce(mine & answer, F.lit(False))


def parts_for(n_listed: int, n_universe: int) -> int:
    rate = min(LATER_RATE, max(n_listed, 1) / max(n_universe, 1))
    return max(1, math.ceil(2 * n_listed * 1.4427 * math.log2(1 / rate) / MOST_BITS))


def mark(rows: DataFrame, keys: dict[str, str], listed: DataFrame, universe: DataFrame) -> DataFrame:
    """Add a boolean per entry of `keys` (new column: key column): is the key listed?"""
    n_parts = parts_for(listed.count(), universe.count())
    rows = rows.withColumns({flag: F.lit(False) for flag in keys})
    for part in range(n_parts):
        cascade = Cascade(listed, universe, part, n_parts)
        rows = rows.withColumns({flag: F.col(flag) | cascade.contains(F.col(key)) for flag, key in keys.items()})
        if n_parts > 1:
            rows = saved(rows, "marked")  # the next part's bits are held after this one's are gone
    return rows


def shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """Distinct (labels of the host, length of the path): what parts of a URL rules can ask for."""
    host = F.regexp_extract("rule", "^[^/]*", 0)
    rows = rules.select(
        F.size(F.split(host, r"\.")).alias("labels"), (F.length("rule") - F.length(host)).alias("path")
    ).distinct()
    return sorted((r.labels, r.path) for r in rows.collect())


def judge(
    pages: DataFrame, rules: DataFrame, addresses: DataFrame, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of `pages`.

    rules: (rule, verdict "allow" or "block"); addresses: (address) = host and path of blocked pages.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("_id"), host.alias("_host"), path.alias("_path"))
    rows = rows.withColumn("_address", F.concat("_host", "_path"))
    kept_rules = rules.select("rule", "verdict").where("rule is not null and verdict is not null")
    labels = F.split("_host", r"\.")
    asked: list[str] = []
    found = shapes(kept_rules)
    for k, (n, length) in enumerate(found):
        fits = (F.size(labels) >= n) & (F.length("_path") >= length)
        key = F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substring("_path", 1, length))
        rows = rows.withColumn(f"_key{k}", F.when(fits, key))
        asked.append(f"_key{k}")

    if asked:
        universe = rows.select(F.explode(F.array(*asked)).alias("key")).where("key is not null").distinct()
        universe = saved(universe, "keys")
        for verdict in ("allow", "block"):
            listed = kept_rules.where(F.col("verdict") == verdict).select(F.col("rule").alias("key")).distinct()
            rows = mark(rows, {f"_{verdict}{k}": key for k, key in enumerate(asked)}, listed, universe)
    universe = saved(rows.select(F.col("_address").alias("key")).distinct(), "addresses")
    listed = addresses.select(F.col("address").alias("key")).where("key is not null").distinct()
    rows = mark(rows, {"_listed": "_address"}, saved(listed, "listed"), universe)

    ranked = [
        F.when(
            F.col(f"_allow{k}") | F.col(f"_block{k}"),
            F.struct(
                F.length(key).alias("length"),
                F.lit(found[k][0]).alias("labels"),
                F.col(f"_block{k}").alias("block"),
                F.col(key).alias("rule"),
            ),
        )
        for k, key in enumerate(asked)
    ]
    best = ranked[0] if len(ranked) == 1 else F.greatest(*ranked) if ranked else F.lit(None)
    if ranked:
        rows = rows.withColumn("_best", best)
        rule = F.col("_best.rule")
        by_rule = F.when(F.col("_best").isNotNull(), F.when(F.col("_best.block"), "block").otherwise("allow"))
    else:
        rule, by_rule = F.lit(None).cast("string"), F.lit(None).cast("string")
    by_address = F.when(F.col("_listed"), "block").otherwise("allow")
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        rule.alias("rule"),
        F.coalesce(by_rule, by_address).alias("verdict"),
    )


def article(html: Column) -> Column:
    """From the first <article to the last </article>; null where a page marks none."""
    found = F.regexp_extract(html, r"(?si)<article[> \t\r\n].*</article>", 0)
    return F.when(found != "", found)


def mirrored(pages: DataFrame, url_col: str = "url", content: Column | str = "html") -> DataFrame:
    """(address): addresses whose `content` is, byte for byte, that of an alphabetically earlier address.

    Null content is like no other. However many addresses share one, they are brought down to the first
    before anything is joined.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    content = F.col(content) if isinstance(content, str) else content
    served = pages.select(F.concat(host, path).alias("address"), F.sha2(content.cast("binary"), 256).alias("_of"))
    served = saved(served.where("address <> '' and _of is not null").distinct(), "served")
    first = served.groupBy(F.col("_of").alias("_same")).agg(F.min("address").alias("_first"), F.count("*").alias("_n"))
    first = first.where("_n > 1").select("_same", "_first")  # most contents are served once, and go here
    later = served.join(first, (F.col("_of") == F.col("_same")) & (F.col("address") > F.col("_first")))
    return later.select("address").distinct()
