"""URL filter: prefix rules first, then a block list behind a blocked Bloom filter.

The block list may be far larger than memory. Its canonical URLs are hashed into
512-bit blocks (one bit in each of eight 64-bit words), one table row per block; a page URL looks up the
single row of its block, and only possible hits go on to an exact join on the
canonical URL, which removes the filter's false positives. Both lookups are equi-joins, so neither the filter nor
the list has to fit anywhere, and a hot URL or block is split like any skewed join.

Defined results: a null URL or one without ``://`` has an empty host and an empty path and gets no rule; it is
listed only if the list holds the empty canonical URL. Repeated rows are judged alike; an
empty list blocks nothing; an empty table gives an empty result. Columns named in ``carry`` are kept, others dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, pin, text_or_empty

WORDS = 8
KEYS_PER_BLOCK = 32  # 16 bits a key


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased. Path: then up to ``? #`` or the end."""
    u = text_or_empty(url)
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def canonical(host: Column, path: Column) -> Column:
    """No scheme, no leading ``www.``, no query or fragment, no closing slashes."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(verdict, host, path) rules, a short hand-written list. A rule fits its host and all subdomains if the path
    starts with the rule's path; the longest rule text wins. Gives struct(rule, verdict) or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = (((host == F.lit(rule_host)) | host.endswith("." + rule_host)) & path.startswith(rule_path))
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _masks(key: Column) -> list[Column]:
    bits = F.xxhash64(key, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
            for i in range(WORDS)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("bigint"))


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter as a table: one row per block that holds a key, eight 64-bit words each."""
    keyed = listed.select(_block(F.col("key"), blocks).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_masks(F.col("key")))])
    return keyed.groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url",
          carry: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``listed`` has one string column ``key`` of canonical URLs. Returns the carried columns, host, path, rule,
    verdict, listed (boolean)."""
    listed = pin(listed.select("key").where(F.col("key").isNotNull()).distinct())
    blocks = max(1, -(-listed.count() // KEYS_PER_BLOCK))
    host, path = host_and_path(F.col(url_col))
    rows = (pages.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)], host.alias("__host"), path.alias("__path"))
            .withColumn("__key", canonical(F.col("__host"), F.col("__path"))))
    probed = (rows.withColumn("block", _block(F.col("__key"), blocks))
              .join(pin(bloom_blocks(listed, blocks)), "block", "left"))
    possible = F.lit(True)
    for i, m in enumerate(_masks(F.col("__key"))):
        possible = possible & (F.coalesce(F.col(f"w{i}"), F.lit(0)).bitwiseAND(m) != 0)
    probed = probed.select(*rows.columns, possible.alias("__possible"))
    exact = listed.select(F.col("key").alias("__key"), F.lit(True).alias("__listed"))
    hits = probed.where("__possible").join(exact, "__key", "left").select(*rows.columns, F.coalesce("__listed", F.lit(False)).alias("__listed"))
    misses = probed.where("not __possible").select(*rows.columns, F.lit(False).alias("__listed"))
    judged = hits.unionByName(misses).withColumn("__rule", longest_rule(F.col("__host"), F.col("__path"), rules))
    return judged.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)], F.col("__host").alias("host"), F.col("__path").alias("path"),
                         F.col("__rule.rule").alias("rule"),
                         F.coalesce(F.col("__rule.verdict"), F.when(F.col("__listed"), "block").otherwise("allow")).alias("verdict"),
                         F.col("__listed").alias("listed"))
