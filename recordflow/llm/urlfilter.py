"""URL filter: a blocked Bloom filter before an exact join with the listed URLs.

The filter is a table of blocks of 256 bits, kept as eight 32-bit words. A URL
belongs to one block and sets or tests one bit in each word, so a probe is one
equi-join with a small table, and the filter can be larger than a machine's
memory. Only URLs whose bits are all set go on to the exact join on the
canonical URL, which removes false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_URL = 12
WORDS = 8  # 32-bit words of a block
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parameters that don't name the page.
_TRACKING = "^(utm_[^=]*|gclid|fbclid|ref|sessionid)(=.*)?$"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a last ``/``, other parameters in order; null without ``://``."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(_TRACKING)))
    host, path = F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), "/+$", "")
    full = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(F.instr(url, "://") > 0, full)


def rule_of(host: Column, path: Column, rules: list[tuple]) -> tuple[Column, Column]:
    """The longest rule that fits (host and all its subdomains, path prefix), and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def _bits(df: DataFrame, blocks: int) -> DataFrame:
    """Block number and one bit per word for the column ``url``: two hashes, the second cut into 5-bit parts."""
    h = F.xxhash64(F.col("url"), F.lit(17))
    bit = [F.expr(f"shiftleft(1, cast(shiftright(_h, {5 * i}) & 31 as int))").alias(f"b{i}") for i in range(WORDS)]
    return df.withColumn("_h", h).select("*", F.pmod(F.xxhash64("url"), F.lit(blocks)).alias("block"), *bit).drop("_h")


def bloom_filter(listed: DataFrame, n_listed: int) -> tuple[DataFrame, int]:
    """(block, w0..w7) of distinct URLs in the column ``url``, and the number of blocks."""
    blocks = max(1, -(-n_listed * BITS_PER_URL // 256))
    return _bits(listed, blocks).groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)]), blocks


def judge(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", listed_col: str = "url", rules: list[tuple] | None = None) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, listed.

    A rule that fits decides; otherwise a page is blocked when its canonical
    URL is one of ``listed`` (compared by canonical URL) and allowed when not.
    A null URL, or one without ``://``, has an empty host and path, fits no
    rule, is never listed, and is allowed. Null and repeated ids and further
    columns change nothing. An empty list blocks nothing.
    """
    keys = listed.select(canonical(F.col(listed_col)).alias("url")).where("url is not null").distinct()
    blooms, blocks = bloom_filter(keys, keys.count())
    url = F.col(url_col)
    p = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("url"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules or RULES)
    p = p.select("*", name.alias("rule"), verdict.alias("by_rule"))
    # A URL is probed once, however many pages have it.
    asked = p.where("url is not null").select("url").distinct()
    hit = None
    for i in range(WORDS):
        test = F.col(f"w{i}").bitwiseAND(F.col(f"b{i}")) != 0
        hit = test if hit is None else hit & test
    possible = _bits(asked, blocks).join(blooms, "block").where(hit).select("url")
    found = possible.join(keys, "url").select(F.col("url").alias("found"))
    out = p.join(found, F.col("url") == F.col("found"), "left")
    is_listed = F.col("found").isNotNull()
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(is_listed, F.lit("block")).otherwise("allow")).alias("verdict"), is_listed.alias("listed"))
