"""URL filter: a blocked Bloom filter of listed URLs, and an exact hash join for what it lets pass.

A listing is a host and the start of a path with a verdict; it fits the host and all
its subdomains where the path starts so. Every pair of a host suffix and a path start
that a URL could be listed under is looked up: first in the filter, a fixed number of
64-bit blocks of which a key touches one, then, for the few that pass, in the listing
itself. The longest listing that fits decides; a URL that none fits gets the default.
DataFrame functions only.

Defined results: a URL that is null or has no ``://`` has an empty host and path and
fits nothing; an empty path fits no listing but one with an empty path; listings that
repeat a host and path count once, and ``block`` wins between their verdicts; of two
fitting listings of one length the one with the longer host wins; listings with a null
are left out; repeated rows each give a row. A column to keep that has the name
of a result gives way to it; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskstream.llm.kept import ROW, carried, restored

#: Blocks of the filter. A block is a row of 16 bytes, so this bounds what is broadcast whatever the listing's size.
BLOCKS = 1 << 20
#: Bits that a key sets in its block, each chosen by six bits of its hash.
BITS = 4


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path (up to ``?`` or ``#``)."""
    parts = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, parts, group), F.lit("")) for group in (1, 2))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _block(key: Column) -> Column:
    return F.pmod(key, F.lit(BLOCKS))


def _bits(key: Column) -> Column:
    mask = F.lit(0).cast("long")
    for k in range(BITS):
        at = F.shiftrightunsigned(key, 24 + 6 * k).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return mask


def bloom_filter(keys: DataFrame) -> DataFrame:
    """Blocks (block, bits) of the keys, 64-bit hashes in column ``key``; at most BLOCKS rows."""
    return keys.groupBy(_block(F.col("key")).alias("block")).agg(F.bit_or(_bits(F.col("key"))).alias("bits"))


def may_contain(df: DataFrame, blocks: DataFrame, key: str = "key") -> DataFrame:
    """The rows whose key the filter holds, and a few others."""
    asked = df.withColumns({"__block": _block(F.col(key)), "__bits": _bits(F.col(key))})
    found = F.broadcast(blocks.select(F.col("block").alias("__block"), F.col("bits").alias("__held")))
    held = F.col("__held").bitwiseAND(F.col("__bits")) == F.col("__bits")
    return asked.join(found, "__block").where(held).drop("__block", "__bits", "__held")


def judge_urls(df: DataFrame, listed: DataFrame, keep: list[str], url: str = "url", default: str = "allow") -> DataFrame:
    """host, path, rule and verdict of each URL next to the columns to keep. ``listed``: host, path, verdict."""
    listed = listed.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).dropna()
    listed = listed.select(F.xxhash64("host", "path").alias("key"), F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    # As many as there are lengths of paths in the listing, so at most as the longest path has characters.
    lengths = [row[0] for row in listed.select(F.length("rule_path")).distinct().collect()]
    host, path = host_and_path(F.col(url))
    results = ["host", "path", "rule", "verdict"]
    kept, row = carried(keep, results)
    pages = df.select(row, host.alias("__host"), path.alias("__path"))

    urls = pages.select(F.col("__host").alias("host"), F.col("__path").alias("path")).where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths)).cast("array<string>")
    asked = urls.select("host", "path", F.explode(suffixes).alias("rule_host"))
    asked = asked.select("host", "path", "rule_host", F.explode(starts).alias("rule_path")).where("rule_path IS NOT NULL")
    asked = asked.withColumn("key", F.xxhash64("rule_host", "rule_path"))
    hits = may_contain(asked, bloom_filter(listed)).join(listed, ["key", "rule_host", "rule_path"])
    longest = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), "rule_host", "rule_path", "verdict")
    best = hits.groupBy("host", "path").agg(F.max(longest).alias("best"))
    best = best.select(
        F.col("host").alias("__host"),
        F.col("path").alias("__path"),
        F.concat("best.rule_host", "best.rule_path").alias("rule"),
        F.col("best.verdict").alias("verdict"),
    )
    judged = pages.join(best, ["__host", "__path"], "left")
    judged = judged.select(ROW, F.col("__host").alias("host"), F.col("__path").alias("path"), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    return restored(judged, kept, results)
