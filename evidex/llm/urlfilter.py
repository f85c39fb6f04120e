"""URL filters: rules on hosts and paths, and an exact list behind a blocked Bloom filter.

The listed canonical URLs set one bit in each of the eight words of one 512-bit block. Pages look up their block; only
possible hits go into the hash join with the list itself, which removes the false positives. Everything is DataFrame
functions; the filter is a table of blocks that is broadcast while its size is below a bound and joined by block beyond.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.llm.common import lower_ascii, stored_table

WORDS_PER_BLOCK = 8
URLS_PER_BLOCK = 32
BROADCAST_BLOCKS = 262_144  # 64 bytes each: 16 MB

# Query parameters that do not change what a page shows.
TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid|sessionid)"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host in lower case without `www.`, path without a last slash, query without tracking, no scheme or fragment."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks))


def _bits(key: Column) -> list[Column]:
    """One bit in each word, from 48 bits of a second hash."""
    h = F.xxhash64(key, F.lit(1))
    # A shift by a column: F.shiftleft takes only fixed distances.
    return [F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(h, 6 * i).bitwiseAND(63)).cast("int")) for i in range(WORDS_PER_BLOCK)]


def bloom_blocks(listed: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """The filter as a table: block, w0 .. w7."""
    bits = listed.select(_block(F.col(key), n_blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col(key)))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS_PER_BLOCK)])


def possible_hits(rows: DataFrame, key: str, listed: DataFrame, listed_key: str, n_listed: int) -> DataFrame:
    """The rows whose key may be listed: all that are, and few others."""
    n_blocks = max(1, math.ceil(n_listed / URLS_PER_BLOCK))
    blocks = bloom_blocks(listed, listed_key, n_blocks)
    if n_blocks <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    probe = rows.withColumn("block", _block(F.col(key), n_blocks)).join(blocks, "block")
    for i, bit in enumerate(_bits(F.col(key))):
        probe = probe.filter(F.col(f"w{i}").bitwiseAND(bit) != 0)
    return probe.select(*rows.columns)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule (verdict, "host/path") that fits, as struct(rule, verdict); null where none does.

    A rule fits its host and all subdomains, if the path starts with the rule's. The list is an argument of the job, up
    to a few hundred rules; equal lengths go by the rule itself.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], page_id: str = "page_id", url: str = "url", listed_url: str = "url"
) -> DataFrame:
    """Judge each page's url: page_id, host, path, rule, verdict.

    The longest fitting rule decides. Without one, a url whose canonical form is listed is blocked, others are allowed.
    A null url or one without `://` has an empty host and path, fits no rule and is never listed. Null and repeated
    ids and repeated urls are judged row by row; listed nulls and repeats count once or not at all. Empty tables give
    no rows or an empty list. Other columns are ignored.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), canonical(F.col("url")).alias("canonical"))
    rows = rows.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    keys = listed.select(canonical(F.col(listed_url)).alias("canonical")).filter(host_of(F.col(listed_url)) != "").distinct()
    keys = stored_table(keys, "listed")
    n_listed = keys.count()
    # Distinct keys meet, so that one url on a third of the pages is one row of the join.
    open_keys = rows.filter(F.col("fit").isNull() & (F.col("host") != "")).select("canonical").distinct()
    hits = possible_hits(open_keys, "canonical", keys, "canonical", n_listed).join(keys, "canonical", "left_semi")
    hits = hits.select("canonical", F.lit(True).alias("listed"))
    judged = rows.join(hits, "canonical", "left")
    verdict = F.when(F.col("fit").isNotNull(), F.col("fit.verdict")).when(F.col("listed"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"))
