"""URL filter by a sort-merge range join of reversed-host keys with nested rules.

A host becomes its labels from the last to the first, each with a dot behind, so a rule's host
and all its subdomains are the keys with one prefix: an interval from the prefix to the prefix
and a byte that ends no key. Keys and interval ends are sorted together into ranges. A sweep
along the order keeps the stack of rules that are open at each key: every interval end carries
the stack that holds from there on, and a range starts with the stack that the ranges before
it leave. A second sweep does the same for the paths of each rule host.

Only distinct hosts, and distinct urls below some rule's host, are swept; ranges are cut by
Spark, so no key, host or domain is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsight.llm.store import lower_ascii, stored

DEFAULT_VERDICT = "allow"
#: Sorts behind all keys with a prefix: no UTF-8 text holds this byte.
PAST = "FF"


def url_host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(F.coalesce(found, F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _host_key(host: Column) -> Column:
    labels = F.reverse(F.split(host, r"\."))
    return F.encode(F.concat(F.array_join(labels, "."), F.lit(".")), "UTF-8")


def _path_key(host: Column, path: Column) -> Column:
    return F.encode(F.concat(host, F.lit("\0"), path), "UTF-8")


def _with_stacks(rules: DataFrame) -> DataFrame:
    """`rules` (`prefix`, `value`) with the stack of all rules that their prefix is in."""
    ends = F.explode(F.sequence(F.lit(1), F.length("prefix"))).alias("n")
    inside = rules.select("prefix", ends).select(
        "prefix", "n", F.expr("substring(prefix, 1, n)").alias("outer")
    )
    outer = rules.select(F.col("prefix").alias("outer"), "value")
    stack = F.sort_array(F.collect_list(F.struct("n", "value")))
    return inside.join(outer, "outer").groupBy("prefix").agg(stack.alias("stack"))


def sweep(points: DataFrame, rules: DataFrame) -> DataFrame:
    """`points` (`key`, distinct) with `stack`: the values of rules (`prefix`, `value`; distinct
    prefixes) that the key starts with, shortest first; keys without any are left out."""
    named = _with_stacks(rules)
    own = F.size("stack")
    starts = named.select(F.col("prefix").alias("key"), F.lit(1).alias("kind"), "stack")
    ends = named.select(
        F.concat("prefix", F.unhex(F.lit(PAST))).alias("key"),
        F.lit(0).alias("kind"),
        F.slice("stack", F.lit(1), own - 1).alias("stack"),
    )
    events = starts.union(ends)
    none = F.lit(None).cast(events.schema["stack"].dataType)
    keys = points.select("key", F.lit(2).alias("kind"), none.alias("stack"))
    ranges = stored(
        events.union(keys)
        .repartitionByRange("key", "kind")
        .withColumn("range", F.spark_partition_id()),
        "ranges",
    )
    last = F.max(F.when(F.col("kind") < 2, F.struct("key", "stack")))
    left = ranges.groupBy("range").agg(last["stack"].alias("left"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = left.select("range", F.last("left", ignorenulls=True).over(before).alias("carried"))
    along = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    open_ = F.last("stack", ignorenulls=True).over(along)
    swept = ranges.withColumn("open", open_).where("kind = 2").join(carried, "range")
    stack = F.transform(F.coalesce("open", "carried"), lambda x: x["value"])
    return swept.select("key", stack.alias("stack")).where(F.size("stack") > 0)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """Host, path and the verdict of the longest fitting rule for every row of `pages`.

    `rules` has `host`, `path` and `verdict`. A rule fits its host and all subdomains if the
    url's path starts with the rule's; the longest by characters of host and path wins, and of
    two as long the one with the longer host. Returns `page_id`, `host`, `path`, `rule` (host
    and path, else NULL) and `verdict` (the rule's, else `default`).

    A url that is NULL or has no `://` has an empty host and path, which no rule fits. Rules
    with a NULL or an empty host are ignored; a rule stated twice counts once, as `block` if its
    verdicts differ (the last verdict by code point). Tied and repeated rows and ids NULL are
    judged one by one; without rules all rows get the default. Other columns are not read.
    """
    judged = pages.select(
        F.col(id_column).alias("page_id"),
        url_host(F.col(url_column)).alias("host"),
        url_path(F.col(url_column)).alias("path"),
    )
    rules = (
        rules.where("host is not null and path is not null and verdict is not null and host != ''")
        .groupBy(lower_ascii(F.col("host")).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    hosts = judged.groupBy("host").agg(_host_key(F.first("host")).alias("key"))
    host_rules = rules.select(_host_key(F.col("host")).alias("prefix"), F.col("host").alias("value"))
    found = sweep(hosts.select("key"), host_rules.distinct())
    below = stored(hosts.join(found, "key").select("host", "stack"), "hosts")

    urls = judged.select("host", "path").distinct().join(below, "host")
    asked = urls.select("host", "path", F.explode("stack").alias("rule_host"))
    asked = stored(
        asked.withColumn("key", _path_key(F.col("rule_host"), F.col("path"))), "urls"
    )
    path_rules = rules.select(
        _path_key(F.col("host"), F.col("path")).alias("prefix"), F.col("path").alias("value")
    )
    deepest = sweep(asked.select("key").distinct(), path_rules).select(
        "key", F.element_at("stack", -1).alias("rule_path")
    )
    rule = F.concat("rule_host", "rule_path")
    best = (
        asked.join(deepest, "key")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length(rule), F.length("rule_host"), "rule_host", "rule_path")).alias("best"))
        .select("host", "path", "best.rule_host", "best.rule_path")
    )
    verdicts = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict")
    )
    best = best.join(verdicts, ["rule_host", "rule_path"])
    return judged.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
