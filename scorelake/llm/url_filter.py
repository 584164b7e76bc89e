"""URL rules: host and path expressions joined with a rule table by hash prefix.

Every distinct URL is expanded into the expressions that a rule could equal: a
suffix of its host, by whole labels, with a prefix of its path. Only suffix
lengths and prefix lengths that some rule has are expanded, so the expressions
of a URL are bounded by the rules and not by the URL. Expressions meet the rules
in an equi-join on the first four bytes of their digests; the full digests then
confirm, and the longest rule wins.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, checkpointed

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase


def host(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z as a-z; empty without ://."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _prefix(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def judge_urls(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict of each url.

    rules has host, path (each rule's path begins with / or is empty) and action
    (`allow` or `block`). A rule fits its host and all subdomains where the path
    begins with the rule's. The longest fitting rule wins; of equally long ones
    the one with the longer host, then `block`. Without a rule the verdict is
    `default` and the rule null. A null url, or one without ://, has an empty host
    and path and so fits no rule with a host. Repeated urls are judged once and get
    equal verdicts; null rules and repeated rules have no further effect; empty
    tables are allowed. Columns of pages named host, path, rule or verdict are
    replaced, and columns of any other name are passed on. What fits is joined back
    by plain shuffles on both sides, so adaptive execution splits the partition of
    a very frequent url; a null url is joined with nothing.
    """
    pages = pages.drop("host", "path", "rule", "verdict") if url not in ("host", "path", "rule", "verdict") else pages
    known = rules.filter("host is not null and path is not null and action is not null").select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "action")
    known = checkpointed(known.distinct().select(F.concat("host", "path").alias("rule"), "action", F.length("host").alias("host_size"), F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_size")))
    shape = known.agg(F.collect_set("labels").alias("labels"), F.collect_set("path_size").alias("sizes"), F.count("*").alias("rules")).first()
    labels, sizes = sorted(shape["labels"]), sorted(shape["sizes"])

    urls = pages.select(F.col(url).alias("url")).filter("url is not null").distinct()
    parts = urls.select("url", F.split(host(F.col("url")), r"\.").alias("labels"), path(F.col("url")).alias("path"))
    number, size = F.array(*map(F.lit, labels)).cast("array<int>"), F.array(*map(F.lit, sizes)).cast("array<int>")
    suffixes = F.transform(F.filter(number, lambda n: n <= F.size("labels")), lambda n: F.array_join(F.slice("labels", F.size("labels") - n + 1, n), "."))
    prefixes = F.transform(F.filter(size, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    wanted = parts.select("url", F.explode(expressions).alias("expression")).select("url", _digest(F.col("expression")).alias("digest")).withColumn("prefix", _prefix(F.col("digest")))
    table = known.select("rule", "action", "host_size", _digest(F.col("rule")).alias("rule_digest")).withColumn("prefix", _prefix(F.col("rule_digest")))
    met = wanted.join(bounded(table, shape["rules"], 256), "prefix").filter("digest = rule_digest")
    best = met.groupBy("url").agg(F.max(F.struct(F.length("rule").alias("size"), "host_size", "action", "rule")).alias("best"))
    best = checkpointed(best.select(F.col("url").alias("judged"), F.col("best.rule").alias("fits"), F.col("best.action").alias("action")))
    whole = pages.select(F.struct(*pages.columns).alias("page"), F.col(url).alias("url"))
    known, unknown = whole.filter("url is not null"), whole.filter("url is null")
    joined = known.join(best, F.col("url") == F.col("judged"), "left").unionByName(unknown, allowMissingColumns=True)
    return joined.select("page.*", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.col("fits").alias("rule"), F.coalesce("action", F.lit(default)).alias("verdict"))
