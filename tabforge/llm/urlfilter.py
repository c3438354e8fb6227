"""URL filter: blocked Bloom filter of listed canonical URLs, then an exact hash join.

A listed entry is a host and a path start; its canonical key is the two written
together (``example.net/en/``).  It fits a URL if the URL's host is the entry's
host or a subdomain of it and the URL's path starts with the entry's path.  The
keys that can fit a URL are its host's suffixes at label borders, each with the
path's starts of the lengths that the list has for that suffix.

The Bloom filter is a table of 256-bit blocks (eight words of 32 bits): a key's
hash picks one block and one bit in each of its words.  Keys of distinct URLs are
joined with their block and dropped unless all eight bits are set; the few that
pass are joined with the list itself, which removes false positives.  The longest
entry that fits decides.  Both joins are equi-joins on a hash or a string: the
filter and the list are broadcast only while their counted size is below
BROADCAST_BYTES, else Spark shuffles them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import free_name, settle

#: Bits of the filter per listed key (about one false positive in a thousand).
BITS_PER_KEY = 16
#: Counted bytes up to which filter or list are broadcast.
BROADCAST_BYTES = 64 << 20
WORDS = 8

#: Fixed values of the contract: (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to / ? # or the end, and the path up to ? # or
    the end; both empty for null URLs and those without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One bit in each of the block's words, from 5 bits each of a second hash."""
    h = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 5 * k).bitwiseAND(F.lit(31)).cast("int")) for k in range(WORDS)]


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter's non-empty blocks: (block, w0..w7) from ``keys`` (key)."""
    made = keys.select(_block(F.col("key"), blocks).alias("block"), *[b.alias(f"w{k}") for k, b in enumerate(_bits(F.col("key")))])
    return made.groupBy("block").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)])


def candidate_keys(places: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, path, key): of each of ``places`` (host, path) the keys that could fit: its host's
    suffixes at label borders that are listed, each with the path's starts of the lengths that
    the suffix has in the list (``hosts``: suffix, lengths)."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    met = places.withColumn("suffix", F.explode(F.array_distinct(suffixes))).join(hosts, "suffix")
    short = F.filter("lengths", lambda n: n <= F.length("path"))
    met = met.withColumn("n", F.explode(short))
    return met.select("host", "path", F.concat("suffix", F.substring("path", F.lit(1), F.col("n"))).alias("key")).distinct()


def judge(pages: DataFrame, listed: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` plus host, path, rule (the longest entry that fits, else null) and verdict.

    ``listed``: host, path, verdict; hosts are compared in lower case, null or empty
    hosts and null paths never fit, repeated entries count once (of different
    verdicts the smallest by code points).  Of entries of one length the longer host
    decides; entries that are the same text as another are one entry.  URLs that are null or have no
    ``://`` have empty host and path, fit nothing and get ``default``.  An empty list
    gives ``default`` to all.  Repeated rows stay; other columns pass through, own
    columns named like the results are replaced."""
    made = ["host", "path", "rule", "verdict"]
    pages = pages.drop(*[c for c in made if c != url])
    host, path = host_and_path(F.col(url))
    entries = settle(
        listed.where("host is not null and host <> '' and path is not null")
        .select(lower_ascii(F.col("host")).alias("_h"), F.col("path").alias("_p"), "verdict")
        .withColumn("key", F.concat("_h", "_p"))
        .groupBy("key", F.length("_h").alias("host_length"), F.length("_p").alias("path_length"))
        .agg(F.min("verdict").alias("rule_verdict"))
    )
    n, chars = entries.agg(F.count(F.lit(1)), F.sum(F.length("key"))).first()
    blocks = max(1, math.ceil(n * BITS_PER_KEY / 256))
    judged = pages.withColumn("host", host).withColumn("path", path)
    if not n:
        return judged.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    # the verdict depends on host and path alone: each distinct pair is looked up once
    places = judged.select("host", "path").where("host <> ''").distinct()
    listed_hosts = entries.groupBy(F.substring("key", F.lit(1), F.col("host_length")).alias("suffix"))
    listed_hosts = listed_hosts.agg(F.collect_set("path_length").alias("lengths"))  # as many numbers as a path is long
    exact_bytes = 2 * chars + 64 * n
    wanted = candidate_keys(places, F.broadcast(listed_hosts) if exact_bytes <= BROADCAST_BYTES else listed_hosts)
    wanted = wanted.withColumn("block", _block(F.col("key"), blocks))
    filter_table = bloom_blocks(entries.select("key"), blocks)
    filter_table = F.broadcast(filter_table) if blocks * 96 <= BROADCAST_BYTES else filter_table
    possible = wanted.join(filter_table, "block")
    for k, bit in enumerate(_bits(F.col("key"))):
        possible = possible.where(F.col(f"w{k}").bitwiseAND(bit) != 0)
    exact = F.broadcast(entries) if exact_bytes <= BROADCAST_BYTES else entries
    hits = possible.select("host", "path", "key").join(exact, "key")
    # an entry's text splits into host and path in one way for a given host: the one that fits it
    hits = hits.where(
        (F.substring("path", F.lit(1), F.col("path_length")) == F.substring("key", F.col("host_length") + 1, F.col("path_length")))
        & (F.col("host").endswith(F.substring("key", F.lit(1), F.col("host_length"))))
    )
    best = F.max_by(F.struct("key", "rule_verdict"), F.struct(F.length("key"), "host_length"))
    found = free_name(judged, "_best")
    chosen = hits.groupBy("host", "path").agg(best.alias(found))
    out = judged.join(chosen, ["host", "path"], "left")
    rest = [F.col(f"`{c}`") for c in pages.columns if c not in made]
    rule, verdict = F.col(found)["key"], F.col(found)["rule_verdict"]
    return out.select(*rest, "host", "path", rule.alias("rule"), F.coalesce(verdict, F.lit(default)).alias("verdict"))


def contract_rules(spark) -> DataFrame:
    return spark.createDataFrame(list(RULES), "host string, path string, verdict string")
