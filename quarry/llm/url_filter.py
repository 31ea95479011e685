"""URL filter: rules first, then gradient-boosted trees on lexical features.

A rule ``host/path`` blocks or allows its host and all subdomains where the
URL's path starts with the rule's; the longest fitting rule decides.  The URLs
that rules decide are the labelled ones: trees trained on a bounded sample of
them judge the rest from length, depth, digit ratio, entropy, parameter counts
and statistics of the suffix (last label) of the host.

Defined results: a null URL, or one without ``://``, has empty host and path
and is judged by the trees; with no labelled URL, or one kind only, the trees
are a constant (allow, or that kind); repeated rows are judged alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import gbt
from quarry.llm.common import ascii_lower, hot_join, save

Rule = tuple[str, str, str]  # host, path, "block" or "allow"

FEATURES = ["length", "host_length", "depth", "labels", "digits", "entropy", "parameters", "hyphens", "path_length",
            "suffix_length", "suffix_urls", "suffix_digits", "suffix_depth"]
#: The regular expression that parts a URL: all before the first ``://``, the host, the path.
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def match(rules: Sequence[Rule], h: Column, p: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rh, rp, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((h == rh) | h.endswith(f".{rh}")) & p.startswith(rp)
        rule, verdict = F.when(fits, F.lit(rh + rp)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def count_of(c: Column, chars: str) -> Column:
    return (F.length(c) - F.length(F.translate(c, chars, ""))).cast("double")


def entropy(c: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(c)

    def term(x):
        p = (n - F.length(F.replace(c, x))) / n
        return -p * F.log2(p)

    return F.aggregate(F.array_distinct(F.filter(F.split(c, ""), lambda x: x != "")), F.lit(0.0), lambda a, x: a + term(x))


def features(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, url parts, rule, its verdict, and the lexical features of each URL."""
    u = F.coalesce("url", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rule, verdict = match(rules, F.col("host"), F.col("path"))
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    size = F.greatest(F.length(u), F.lit(1))
    return rows.withColumns({
        "rule": rule, "told": verdict, "suffix": F.substring_index("host", ".", -1),
        "length": F.length(u).cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"), "depth": count_of(F.col("path"), "/"),
        "labels": count_of(F.col("host"), "."), "digits": count_of(u, "0123456789") / size, "entropy": entropy(u),
        "parameters": F.when(query == "", 0.0).otherwise(count_of(query, "&") + 1), "hyphens": count_of(u, "-_"),
    })


def with_suffix(rows: DataFrame) -> DataFrame:
    """Add statistics of each URL's suffix, taken over all URLs."""
    stats = save(rows.groupBy("suffix").agg(
        F.count("*").alias("urls"), F.avg("digits").alias("suffix_digits"), F.avg("depth").alias("suffix_depth")), "url-suffixes")
    stats = stats.withColumn("suffix_urls", F.log1p(F.col("urls").cast("double")))
    return hot_join(rows, stats, "suffix", "urls").withColumn("suffix_length", F.length("suffix").cast("double"))


def train(rows: DataFrame, max_rows: int = 20_000, trees: int = 12, depth: int = 3) -> list:
    """Trees for P(block), from at most about ``max_rows`` labelled URLs of each kind (by hash of the URL)."""
    sizes = {r["told"]: r["count"] for r in rows.where("told IS NOT NULL").groupBy("told").count().collect()}
    share = F.lit(0)
    for kind, n in sizes.items():
        share = F.when(F.col("told") == kind, F.lit(min(1 << 20, -(-max_rows * (1 << 20) // n)))).otherwise(share)
    sample = rows.where(F.col("told").isNotNull() & (F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < share))
    sample = save(sample.select(*FEATURES, (F.col("told") == "block").cast("double").alias("block")), "url-sample")
    return gbt.fit(sample, FEATURES, "block", trees, depth)


def judge(pages: DataFrame, rules: Sequence[Rule], max_rows: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, block_score), one per input row."""
    rows = with_suffix(features(pages, rules))
    score = gbt.probability(train(rows, max_rows), F.col)
    return rows.withColumn("block_score", score).select(
        "page_id", "host", "path", "rule",
        F.coalesce("told", F.when(F.col("block_score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "block_score")
