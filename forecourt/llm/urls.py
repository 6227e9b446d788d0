"""URL filter: a blocked Bloom filter of listed canonical URLs before an exact hash join.

There are two kinds of listed entries. A *rule* is a host and a path with a verdict; it fits its host and all
subdomains where the url's path starts with the rule's, and the longest fitting rule wins (of equally long ones,
the one with the longer host). A *listed URL* is one canonical URL to block. A url that no rule fits is blocked if its
canonical URL is listed, else allowed.

1. Every entry is a text, its key. The keys fill a split-block Bloom filter: blocks of eight 64-bit words, one bit
   in each word of the key's block. The blocks are made by one aggregation and number at most ``MAX_BLOCKS`` (64 bytes each), so
   what is broadcast is bounded; a longer list only lets more urls through to the join.
2. A url has one key per *shape* of the rules (number of host labels, length of path) and that of its canonical URL.
   The shapes are at most the host lengths times the path lengths in use. Keys that the filter does not know are dropped;
   a url without any left is decided without a join.
3. The other keys meet the entries in an exact join. It removes the false positives; Spark splits hot keys, as both sides come
   straight from a shuffle where the entries are too many to broadcast.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; path: then up to ``?``, ``#`` or the
end. A null url or one without ``://`` has an empty host and path, which no rule fits and no list holds: allowed. The canonical URL drops
a leading ``www.`` or ``m.`` of the host, a default port, and a trailing slash, ``.html`` or ``index.html`` of the path.

Of entries with equal keys, a blocking one counts. Entries with a null or empty host, or another verdict than allow or block,
count for nothing; no entries at all allow everything. Rows are judged one by one, so ties and repeated rows (or null ids)
need no rule; other columns are ignored.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType

from forecourt.operators.skew import group_apart
from forecourt.session import materialise

WORDS = 8
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 20

#: Rules of the registered query: host, path, verdict. [fixed values]
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Names of sites whose pages the registered query lists. [fixed values]
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both as the contract of this module defines them; empty, never null."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def canonical(host: Column, path: Column) -> Column:
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(www|m)\.", "")
    return F.concat(host, F.regexp_replace(path, r"(/index\.html|\.html|/)$", ""))


def listed_urls(pages: DataFrame, names: tuple[str, ...] = LISTED_NAMES) -> DataFrame:
    """The canonical URLs of the pages of sites with one of these names, each once."""
    host, path = host_and_path(F.col("url"))
    named = F.arrays_overlap(F.split(host, r"\."), F.lit(list(names)))
    return pages.where(named).select(canonical(host, path).alias("url")).distinct()


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def entries_of(rules: DataFrame, listed: DataFrame) -> DataFrame:
    """key, rule (null for a listed URL), labels, width, verdict, weight: one row per key."""
    host = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    path = F.coalesce("path", F.lit(""))
    by_rule = rules.where(F.col("verdict").isin("allow", "block") & (F.length("host") > 0)).select(
        F.concat(F.lit("r"), host, path).alias("key"), F.concat(host, path).alias("rule"),
        F.size(F.split(host, r"\.")).alias("labels"), F.length(path).alias("width"), "verdict",
    )
    by_url = listed.where("length(url) > 0").select(
        F.concat(F.lit("u"), "url").alias("key"), F.lit(None).cast("string").alias("rule"),
        F.lit(0).alias("labels"), F.lit(0).alias("width"), F.lit("block").alias("verdict"),
    )
    same = [F.max(c).alias(c) for c in ("rule", "labels", "width", "verdict")]  # "block" is the greater verdict
    return by_rule.union(by_url).groupBy("key").agg(*same)


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(1))


def bloom_filter(entries: DataFrame, bits_per_key: int = BITS_PER_KEY, max_blocks: int = MAX_BLOCKS) -> np.ndarray:
    """Blocks by words, as 64-bit numbers; at least one block, at most ``max_blocks``."""
    n = entries.count()
    blocks = 1
    while blocks < max_blocks and blocks * WORDS * 64 < n * bits_per_key:
        blocks *= 2
    first, second = _hashes(F.col("key"))
    hashed = entries.select(F.pmod(first, F.lit(blocks)).alias("block"), second.alias("h"))
    word = [F.expr(f"bit_or(shiftleft(1L, cast(shiftright(h, {6 * i}) & 63 as int)))").alias(f"w{i}") for i in range(WORDS)]
    filled = hashed.groupBy("block").agg(*word).toArrow()  # at most max_blocks rows
    out = np.zeros((blocks, WORDS), np.int64)
    where = filled["block"].to_numpy()
    for i in range(WORDS):
        out[where, i] = filled[f"w{i}"].to_numpy()
    return out


def contains(blocks: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the keys with these hashes; never false for one that it holds."""
    mine = blocks[first % len(blocks)]
    shifts = (second[:, None] >> (6 * np.arange(WORDS))) & 63
    return ((mine >> shifts) & 1).all(axis=1)


def _may_hold(spark: SparkSession, blocks: np.ndarray):
    sent = spark.sparkContext.broadcast(blocks)

    @F.arrow_udf(ArrayType(BooleanType()))
    def may_hold(hashes: pa.Array) -> pa.Array:
        flat = hashes.flatten().to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], np.cumsum(np.diff(hashes.offsets.to_numpy())))) // 2
        found = contains(sent.value, flat[0::2], flat[1::2])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found))

    return may_hold


def _keys(shapes: list[tuple[int, int]]) -> Column:
    """The keys of a url (columns host, path)."""
    url = F.array(F.concat(F.lit("u"), canonical(F.col("host"), F.col("path"))))
    if not shapes:
        return url
    own = F.size(F.split("host", r"\."))
    known = F.arrays_zip(F.lit([s[0] for s in shapes]).alias("labels"), F.lit([s[1] for s in shapes]).alias("width"))
    fits = F.filter(known, lambda s: (s["labels"] <= own) & (s["width"] <= F.length("path")))
    suffix = lambda s: F.call_function("substring_index", F.col("host"), F.lit("."), -s["labels"])
    rules = F.transform(fits, lambda s: F.concat(F.lit("r"), suffix(s), F.substring(F.col("path"), F.lit(1), s["width"])))
    return F.concat(rules, url)


def judge(
    pages: DataFrame, rules: DataFrame, listed: DataFrame, bits_per_key: int = BITS_PER_KEY, max_blocks: int = MAX_BLOCKS
) -> DataFrame:
    """Per page row: page_id, host, path, rule, verdict, listed.

    pages: page_id, url; rules: host, path, verdict; listed: url (canonical). ``listed`` tells whether the canonical URL is.
    """
    spark = pages.sparkSession
    entries = materialise(entries_of(rules, listed), "entries")
    kinds = entries.where(F.isnotnull("rule")).select("labels", "width").distinct().collect()
    may_hold = _may_hold(spark, bloom_filter(entries, bits_per_key, max_blocks))
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col("page_id").cast("bigint"), host.alias("host"), path.alias("path"))
    keyed = urls.withColumn("keys", F.when(F.length("host") > 0, _keys(sorted((r["labels"], r["width"]) for r in kinds))).otherwise(F.array().cast("array<string>")))
    hashes = F.flatten(F.transform("keys", lambda k: F.array(*_hashes(k))))
    marked = keyed.withColumn("held", may_hold(hashes))
    passed = F.filter("keys", lambda k, i: F.get("held", i))
    # written, so that a row keeps its number
    rows = materialise(marked.select(F.monotonically_increasing_id().alias("row"), "page_id", "host", "path", passed.alias("keys")), "urls")
    hits = rows.where("size(keys) > 0").select("row", "page_id", "host", "path", F.explode("keys").alias("key"))
    exact = group_apart(entries, ["key"], *[F.max(c).alias(c) for c in ("rule", "labels", "width", "verdict")])
    order = F.struct(F.length("rule").alias("n"), (-F.col("width")).alias("w"), "rule", "verdict")
    best = hits.join(exact, "key", "left").groupBy("row", "page_id", "host", "path").agg(
        F.max(F.when(F.isnotnull("rule"), order)).alias("best"),
        F.max(F.coalesce(F.isnotnull("verdict") & F.isnull("rule"), F.lit(False))).alias("listed"),
    )
    block = F.when(F.col("listed"), "block").otherwise("allow")
    found = best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", block).alias("verdict"), "listed")
    none = rows.where("size(keys) = 0").select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"), F.lit(False).alias("listed")
    )
    return found.union(none)
