"""URL filters: host/path rules, then a blocked Bloom filter and an exact hash join.

All of it is built-in SQL functions.  A URL no rule fits is looked up in a list of
canonical URLs: its bits are tested against a blocked Bloom filter (256-bit blocks, two
bits in each of four 64-bit lanes) whose size is bounded by ``max_blocks`` and which is
therefore safe to broadcast; only possible hits go on to the exact join with the list,
which removes the false positives.  A list too large for the bounded filter makes more
possible hits, never another result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanload.llm.common import ascii_lower, stage

LANES = 4
BITS_PER_URL = 12
MAX_RULES = 1000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One spelling of a URL: no scheme, query or fragment, no leading ``www.``, no
    trailing slashes.  Null where the URL has no host."""
    bare = F.regexp_replace(host, r"^www\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, "/+$", "")))


def _rule_parts(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def _fits(host: Column, path: Column, rule: str) -> Column:
    h, p = _rule_parts(rule)
    return ((host == h) | host.endswith(f".{h}")) & path.startswith(p)


def _masks(key: Column) -> list[Column]:
    """Two bits of each lane of the block."""
    h = F.xxhash64(key, F.lit("bits"))

    def bit(i: int) -> Column:
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(LANES)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def build_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """Rows ``_b, _w0.._w3``: the blocks of the filter that hold any bit, ``blocks`` at most."""
    masks = _masks(F.col(key))
    return (listed.select(_block(F.col(key), blocks).alias("_b"),
                          *[m.alias(f"_m{i}") for i, m in enumerate(masks)])
            .groupBy("_b").agg(*[F.bit_or(f"_m{i}").alias(f"_w{i}") for i in range(LANES)]))


def filter_urls(df: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = (),
                url: str = "url", listed_url: str = "url", max_blocks: int = 1 << 18) -> DataFrame:
    """Add ``host, path, rule, verdict`` (in place of columns of these names).

    ``rules``: (rule, ``allow`` or ``block``); a rule ``host/path`` fits its host and all
    subdomains if the URL's path starts with the rule's; the longest rule wins.  Without a
    rule the verdict is ``block`` for a URL whose canonical form is in ``listed``, else
    ``allow``.  Null URLs and URLs without ``://`` have an empty host and path, fit no rule,
    are not in any list: ``allow``.  Repeated rows are all judged; an empty list blocks nothing;
    null URLs in the list are ignored.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules; put single URLs into the list")
    lh, lp = host_of(F.col(listed_url)), path_of(F.col(listed_url))
    wanted = stage(listed.select(canonical(lh, lp).alias("_key")).where("_key is not null")
                   .distinct(), "url-list")
    n = wanted.count()
    blocks = 64
    while blocks < min(max_blocks, n * BITS_PER_URL / 256):
        blocks *= 2
    kept = [c for c in df.columns if c.lower() not in {"host", "path", "rule", "verdict"}]
    best = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        best = F.when(_fits(F.col("_host"), F.col("_path"), rule), F.lit(rule)).otherwise(best)
    ruled = F.lit(None).cast("string")
    for rule, verdict in rules:
        ruled = F.when(F.col("_rule") == rule, F.lit(verdict)).otherwise(ruled)
    own = [f"_c{i}" for i in range(len(kept))]  # under names that can't be those of the columns below
    base = (df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, own, strict=True)],
                      host_of(F.col(f"`{url}`")).alias("_host"), path_of(F.col(f"`{url}`")).alias("_path"))
            .withColumn("_rule", best)
            .withColumn("_key", F.when(F.col("_rule").isNull(),
                                       canonical(F.col("_host"), F.col("_path")))))
    bloom = F.broadcast(build_filter(wanted, "_key", blocks))  # at most max_blocks rows
    passed = F.lit(True)
    for i, m in enumerate(_masks(F.col("_key"))):
        passed = passed & (F.col(f"_w{i}").bitwiseAND(m) == m)
    tested = (base.withColumn("_b", F.coalesce(_block(F.col("_key"), blocks), F.lit(-1)))
              .join(bloom, "_b", "left")
              .withColumn("_maybe", F.coalesce(passed, F.lit(False)))
              .drop("_b", *[f"_w{i}" for i in range(LANES)]))
    sure = tested.where("not _maybe").withColumn("_hit", F.lit(False)).drop("_maybe")
    hits = (tested.where("_maybe").drop("_maybe")
            .join(wanted.withColumn("_hit", F.lit(True)), "_key", "left")
            .withColumn("_hit", F.coalesce("_hit", F.lit(False))))
    verdict = F.coalesce(ruled, F.when(F.col("_hit"), F.lit("block")).otherwise(F.lit("allow")))
    return sure.unionByName(hits).select(
        *[F.col(n).alias(c) for c, n in zip(kept, own, strict=True)], F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_rule").alias("rule"), verdict.alias("verdict"))
