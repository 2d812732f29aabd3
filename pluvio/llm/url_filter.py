"""URL filter: host and path rules first, then a list of canonical URLs.

The list is tested in two steps. A blocked Bloom filter (eight words of 64 bits a
block, one bit in each word) is built by a grouped OR over the listed URLs and passes
possible hits; an exact hash join with the list removes the false positives. The
filter is broadcast only if its size, known from the number of listed URLs, is under
a bound; beyond it the filter stays a distributed table joined by block number.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import store, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 8
KEYS_PER_BLOCK = 32      # 512 bits for 32 keys: 16 bits a key
BROADCAST_BYTES = 64 << 20
TRACKING = r"(?i)^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    rest = F.substring_index(F.substring_index(F.substring_index(_rest(url), "/", 1), "?", 1), "#", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty without ://."""
    rest = F.substring_index(F.substring_index(_rest(url), "?", 1), "#", 1)
    slash = F.instr(rest, "/")
    return F.when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise(F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def canonical(url: Column) -> Column:
    """Scheme, leading www., default port, fragment, tracking parameters and a closing
    slash go; the other parameters are sorted. Null without host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    bare = F.substring_index(url, "#", 1)
    at = F.instr(bare, "?")
    asked = F.when(at > 0, F.substring(bare, at + 1, F.length(bare))).otherwise(F.lit(""))
    params = F.array_sort(F.filter(F.split(asked, "&", -1), lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.array_join(params, "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query))
                                       .otherwise(F.lit(""))))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, null without one. A rule is
    (verdict, host, path): it fits its host and all subdomains if the path starts with
    its path. The rules are a short configured list; ties go to the earlier one."""
    text = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def _block_and_bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    h = F.xxhash64(key)
    bits = F.xxhash64(key, F.lit(1))
    block = F.pmod(F.shiftrightunsigned(h, 1), F.lit(blocks))
    return block, [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(63) for i in range(WORDS)]


def bloom(listed: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(block, w0..w7) of the blocks with keys, and the number of blocks: a function
    of the number of keys."""
    blocks = max(1, -(-listed.count() // KEYS_PER_BLOCK))
    block, bits = _block_and_bits(F.col(key), blocks)
    words = [F.expr(f"bit_or(shiftleft(1L, cast(_b{i} as int)))").alias(f"w{i}") for i in range(WORDS)]
    return (listed.select(block.alias("block"), *[b.alias(f"_b{i}") for i, b in enumerate(bits)])
            .groupBy("block").agg(*words)), blocks


def possible_hits(df: DataFrame, key: str, filter_table: DataFrame, blocks: int,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``df`` whose key the filter doesn't rule out. Null keys never pass."""
    block, bits = _block_and_bits(F.col(key), blocks)
    ft = filter_table.select(F.col("block").alias("_block"), *[f"w{i}" for i in range(WORDS)])
    if blocks * WORDS * 8 <= broadcast_bytes:
        ft = F.broadcast(ft)
    probe = df.filter(F.col(key).isNotNull()).withColumn("_at", block)
    hit = F.lit(True)
    for i, b in enumerate(bits):
        hit = hit & (F.expr("shiftrightunsigned(w%d, cast(%s as int))" % (i, f"_bit{i}")).bitwiseAND(1) == 1)
    probe = probe.withColumns({f"_bit{i}": b for i, b in enumerate(bits)})
    return (probe.join(ft, (F.col("_at") == F.col("_block")) & hit)
            .drop("_at", "_block", *[f"_bit{i}" for i in range(WORDS)], *[f"w{i}" for i in range(WORDS)]))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url",
                listed_col: str = "url", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` plus host, path, canonical_url, rule and verdict (allow or block).
    A fitting rule decides; without one a URL is blocked if its canonical form is that
    of a listed URL. A null URL or one without :// has empty host and path, no canonical
    form, and is allowed; null list entries are ignored, repeated ones count once.
    Extra columns with the names added are replaced."""
    pages = without(pages, *[n for n in ("host", "path", "canonical_url", "rule", "verdict") if n != url_col])
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = (pages.withColumns({"host": host_of(url), "path": path_of(url), "canonical_url": canonical(url)})
            .withColumns({"rule": rule, "_ruled": verdict}))
    keys = store(listed.select(canonical(F.col(f"`{listed_col}`").cast("string")).alias("_listed"))
                 .filter(F.col("_listed").isNotNull()).distinct())
    table, blocks = bloom(keys, "_listed")
    asked = rows.filter(F.col("_ruled").isNull()).select(F.col("canonical_url").alias("_url")).distinct()
    hits = store(possible_hits(asked, "_url", table, blocks, broadcast_bytes)
                 .join(keys, F.col("_url") == F.col("_listed"), "left_semi").select("_url"))
    # hits are distinct, so the join adds no rows; a URL on many pages can be split
    return (rows.join(hits, F.col("canonical_url") == F.col("_url"), "left")
            .withColumn("verdict", F.coalesce("_ruled", F.when(F.col("_url").isNotNull(), "block").otherwise("allow")))
            .drop("_url", "_ruled"))
