"""URL rules as a sort-merge range join with a sorted sweep, in DataFrame functions only.

A host is turned round label by label (``a.example.org`` becomes ``org.example.a.``), so all hosts below a rule's host
form one interval of the sorted keys, and so do all paths below a rule's path. The intervals of prefixes are nested or
apart. A sweep over rules and keys in one sorted order therefore needs only a stack: opening a rule pushes it, its end
pops it. The sweep runs in every range partition at once, and the stack a partition starts with is carried over from
the partitions before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from advertlake.session import stage

RULE_SCHEMA = "host string, path string, verdict string"

# Fixed values of the query: rules and what they say.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rest_of(url: Column) -> Column:
    """What follows the first ``://``, null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(rest_of(url), "^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    behind = F.regexp_extract(rest_of(url), "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(behind, F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each closed by a dot; empty for an empty host."""
    return F.when(host == "", "").otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))
    )


def _with_stacks(prefixes: DataFrame) -> DataFrame:
    """Rules' prefixes with ``stack``: the prefixes that hold each, the outermost first, itself last.

    Meets every leading part of a prefix with the prefixes: an equi-join of as many rows as the prefixes have
    characters.
    """
    parts = prefixes.select(
        "prefix",
        F.explode(F.expr("transform(sequence(0, length(prefix)), i -> substring(prefix, 1, i))")).alias("part"),
    )
    holders = prefixes.select(F.col("prefix").alias("part"))
    return parts.join(holders, "part").groupBy("prefix").agg(F.array_sort(F.collect_list("part")).alias("stack"))


def sweep(points: DataFrame, prefixes: DataFrame, label: str) -> DataFrame:
    """Every distinct ``key`` of ``points`` that some prefix holds, with ``stack``, its prefixes from short to long.

    ``prefixes`` has distinct, non-null ``prefix`` values. Keys are distinct, so no key weighs more than another,
    whatever number of rows share it.
    """
    nested = _with_stacks(prefixes)
    as_bytes = F.col("prefix").cast("binary")
    outer = F.expr("slice(stack, 1, size(stack) - 1)")
    opening = nested.select(as_bytes.alias("key"), F.lit(1).alias("kind"), "stack")
    # no UTF-8 text has the byte FF, so this closes the interval of all that goes on from the prefix
    closing = nested.select(F.concat(as_bytes, F.expr("X'FF'")).alias("key"), F.lit(0).alias("kind"), outer.alias("stack"))
    events = opening.unionByName(closing)
    keys = points.select("key").filter("key IS NOT NULL").distinct()
    asked = keys.select(F.col("key").cast("binary").alias("key"), F.lit(2).alias("kind"), F.lit(None).cast("array<string>").alias("stack"))
    dealt = events.unionByName(asked).repartitionByRange("key")
    placed = stage(dealt.withColumn("part", F.spark_partition_id()), label)

    last = placed.filter("stack IS NOT NULL").groupBy("part").agg(F.max_by("stack", F.struct("key", "kind")).alias("left"))
    # one row per range partition
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.select("part").distinct().join(last, "part", "left")
    carried = parts.select("part", F.last("left", ignorenulls=True).over(over).alias("carried"))
    order = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = placed.withColumn("top", F.last("stack", ignorenulls=True).over(order)).filter("kind = 2")
    stacks = swept.join(carried, "part").select("key", F.coalesce("top", "carried").alias("stack"))
    return stacks.filter("size(stack) > 0").withColumn("key", F.col("key").cast("string"))


def judge_urls(pages: DataFrame, rules: DataFrame, *, default: str = "allow", by: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Every row's host, path, the rule that decides (``host`` and ``path`` joined) and the verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains where the path starts with the
    rule's; the longest host and path decide. Of rules with equal host and path ``block`` wins. A null or odd url has
    an empty host and path, which no rule fits, and gets ``default``. Repeated rows are judged each; columns other than
    ``url`` and ``by`` are left out.
    """
    given = rules.select(
        host_key(F.translate(F.col("host"), UPPER, LOWER)).alias("rule_key"),
        F.col("path").alias("rule_path"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    ).filter("rule_key <> '' AND rule_path IS NOT NULL")
    given = given.groupBy("rule_key", "rule_path").agg(F.max("verdict").alias("verdict"), F.min("rule").alias("rule"))

    rows = pages.select(*by, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    keyed = rows.withColumn("host_key", host_key(F.col("host")))

    # First the hosts: which rule hosts hold them. A space ends the host part of a key.
    hosts = sweep(keyed.select(F.col("host_key").alias("key")), given.select(F.col("rule_key").alias("prefix")).distinct(), "url-hosts")
    held = hosts.select(F.col("key").alias("host_key"), F.explode("stack").alias("rule_key"))
    # Then host and path as one key, for every rule host that holds the page's host.
    places = keyed.filter("host <> ''").select("host_key", "path").distinct().join(held, "host_key")
    places = places.withColumn("key", F.concat("rule_key", F.lit(" "), "path"))
    prefixes = given.withColumn("prefix", F.concat("rule_key", F.lit(" "), "rule_path"))
    fits = sweep(places, prefixes.select("prefix"), "url-paths")
    innermost = fits.select("key", F.try_element_at("stack", F.lit(-1)).alias("prefix")).join(prefixes, "prefix")
    decided = (
        places.join(innermost.select("key", F.col("rule"), "verdict"), "key")
        .groupBy("host_key", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "rule")).alias("found"))
    )
    decided = stage(decided, "url-verdicts")  # a shuffle of its own, so that a url of many rows can be split
    return keyed.join(decided, ["host_key", "path"], "left").select(
        *by,
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
    )
