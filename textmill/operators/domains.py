"""Domain blacklist: drop pages whose host or any parent domain is listed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.bloom import FALSE_POSITIVES, MAX_BYTES, bloom_filter, bloom_size, might_contain
from textmill.functions.hosts import host_of, parent_domains
from textmill.session import cut


def host_extract(df: DataFrame, url_col: str, out: str = "host", strict: bool = False) -> DataFrame:
    return df.withColumn(out, host_of(F.col(url_col), strict))


def domain_suffixes(df: DataFrame, id_col: str, url_col: str, strict: bool = False) -> DataFrame:
    """One row ``(id, domain)`` per candidate parent domain of each page's host."""
    suffixes = parent_domains(host_of(F.col(url_col), strict))
    return df.select(id_col, F.explode(suffixes).alias("domain"))


def blacklist_normalise(df: DataFrame, col: str = "value") -> DataFrame:
    """Trimmed, lower-cased, distinct entries without blanks and ``#`` comments."""
    entry = F.lower(F.trim(F.col(col)))
    return (
        df.select(entry.alias("domain"))
        .where((F.col("domain") != "") & ~F.col("domain").startswith("#"))
        .distinct()
    )


def blacklisted_hosts(df: DataFrame, blacklist: DataFrame, url_col: str, strict: bool = False) -> DataFrame:
    """The distinct hosts of ``df`` that are listed or lie under a listed domain.

    Hosts are made distinct before their suffixes are exploded, so a host that
    owns a third of all pages is one row here.
    """
    hosts = df.select(host_of(F.col(url_col), strict).alias("host")).where("host <> ''").distinct()
    suffixes = hosts.select("host", F.explode(parent_domains(F.col("host"))).alias("domain"))
    return suffixes.join(blacklist, "domain", "left_semi").select("host").distinct()


def domain_filter(df: DataFrame, blacklist: DataFrame, url_col: str = "url", strict: bool = False) -> DataFrame:
    """Pages whose host and parent domains are all unlisted; pages without a host stay.

    No broadcast is forced: adaptive execution broadcasts the listed hosts when
    their measured size allows and splits a hot host otherwise.
    """
    listed = blacklisted_hosts(df, blacklist, url_col, strict).withColumnRenamed("host", "_host")
    kept = df.withColumn("_host", host_of(F.col(url_col), strict)).join(listed, "_host", "left_anti")
    return kept.drop("_host")


def bloom_domain_filter(
    df: DataFrame, blacklist: DataFrame, url_col: str = "url", strict: bool = False,
    false_positives: float = FALSE_POSITIVES, max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """The rows of ``domain_filter`` for a list of many millions, by a Bloom filter of the list.

    Every page's parent domains meet the filter where the page is read. Only those that may
    be listed, a ``false_positives`` share of the others among them, are made distinct and
    joined with the list; a list whose filter would exceed ``max_bytes`` goes without one.
    """
    listed = cut(blacklist.select("domain").where("domain IS NOT NULL").distinct(), "listed")
    words, hashes = bloom_size(listed.count(), false_positives)
    if words * 8 > max_bytes:
        return domain_filter(df, listed, url_col, strict)
    held = cut(bloom_filter(listed, "domain", words, hashes), "bloom")
    host = host_of(F.col(url_col), strict)
    parents = df.select(host.alias("host"), F.explode(parent_domains(host)).alias("domain"))
    maybe = parents.where(might_contain(held, F.col("domain"), words, hashes)).distinct()
    hits = cut(maybe.join(listed, "domain", "left_semi").select(F.col("host").alias("_host")).distinct(), "hits")
    return df.withColumn("_host", host).join(hits, "_host", "left_anti").drop("_host")


def url_prefix_filter(df: DataFrame, blacklist: DataFrame, url_col: str = "url") -> DataFrame:
    """Drop pages under a listed ``host/path`` entry (entries without a slash are ignored here).

    Every path prefix of a URL that ends at a slash is a candidate, so the match
    is an equi-join like the one on domains.
    """
    entries = blacklist.where(F.col("domain").contains("/")).select(
        F.regexp_replace("domain", r"/+$", "").alias("prefix")
    ).distinct()
    bare = F.regexp_replace(F.lower(F.regexp_replace(F.col(url_col), r"^[^:/?#]+://", "")), r"[?#].*$", "")
    parts = F.split(F.regexp_replace(bare, r"/+$", ""), "/")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")
    )
    urls = df.select(url_col).where(F.col(url_col).isNotNull()).distinct()
    candidates = urls.select(F.col(url_col).alias("_url"), F.explode(prefixes).alias("prefix"))
    hit = candidates.join(entries, "prefix", "left_semi").select("_url").distinct()
    return df.join(hit, F.col(url_col) == F.col("_url"), "left_anti")
