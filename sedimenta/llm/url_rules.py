"""URL filters: sort-merge range join of pages and nested rules, native Spark.

A host is keyed by its labels in reverse (``org.example.``), so that a rule
host and all its subdomains are one interval of keys, and intervals nest.  Rule
hosts and urls are sorted together by range into partitions and swept: the
sweep keeps a stack with a place for each depth, on which a rule host replaces
what stood at its depth; of the places, those whose key begins the url's key
are open.  A second sweep does the same inside each open rule host with the
paths: the last rule path that began names its enclosing rule paths by their
lengths (at most one per character), and the longest that begins the url's
path fits.  The longest rule of all open hosts decides.

Rules of a host are never gathered; what rides along a sweep is one key per
depth, or one path with a few lengths.  Stacks that are open where a partition
begins come from the partitions before it, as one row per partition; they are
broadcast only while their counted size is bounded.  Keys are followed by the
row, so a host or url of a third of all rows spreads over partitions.

Defined cases: a null url, or one without ``://``, has an empty host and path
and no rule; it is blocked, as it cannot be fetched, while other urls without
a rule are allowed.  Rule hosts are lower-cased; rules with a null or empty
host, a null path or a null verdict are no rules.  Of rules of equal length
the larger by text decides, of equal rules ``block``.  Rows that repeat each
get a row; columns of any other name play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, durable, values

#: (verdict, host, path)
DEFAULT_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
RULES = "verdict string, host string, path string"
#: Labels in a host that the first sweep has places for, and values per
#: partition times partitions up to which carried stacks are broadcast.
MAX_LABELS = 127
MAX_BROADCAST_CARRIED = 200_000


def rules_frame(spark: SparkSession, rules=DEFAULT_RULES) -> DataFrame:
    return values(spark, list(rules), RULES)


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    return F.when(at > 0, ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def keyed_rules(rules: DataFrame) -> DataFrame:
    """(node, path, verdict, host, open): a row per rule host and path; ``open``
    are the lengths of the rule paths of the host that begin this one, its own
    with them."""
    known = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").where("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL")
    one = known.groupBy(host_key(F.col("host")).alias("node"), "path").agg(F.max("verdict").alias("verdict"), F.first("host").alias("host"))
    one = durable(one)
    # A rule path can only enclose another at a length that its host has.
    lengths = one.groupBy("node").agg(F.array_sort(F.collect_set(F.length("path"))).alias("lengths"))
    tries = one.join(lengths, "node").select("node", "path", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n"))
    tries = tries.select("node", "path", "n", F.substring(F.col("path"), F.lit(1), F.col("n")).alias("begin"))
    real = tries.join(one.select("node", F.col("path").alias("begin")), ["node", "begin"])
    opened = real.groupBy("node", "path").agg(F.array_sort(F.collect_set("n")).alias("open"))
    return durable(one.join(opened, ["node", "path"]))


def _carried(events: DataFrame, slots: list[str]) -> DataFrame:
    """(part, ``<slot>_before``): what the partitions before left in the slots."""
    last = events.groupBy("part").agg(*[F.max_by(s, F.when(F.col(s).isNotNull(), F.struct("key", "sub"))).alias(s) for s in slots])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = durable(last.select("part", *[F.last(s, ignorenulls=True).over(before).alias(f"{s}_before") for s in slots]))
    return F.broadcast(carried) if carried.count() * len(slots) <= MAX_BROADCAST_CARRIED else carried


def _swept(events: DataFrame, slots: list[str]) -> DataFrame:
    """Urls of ``events`` with the slots as the sweep has them there."""
    # Part numbers must hold still while they are read twice.
    events = durable(events.withColumn("part", F.spark_partition_id()))
    along = Window.partitionBy("part").orderBy("key", "sub", "kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = events.select("*", *[F.last(s, ignorenulls=True).over(along).alias(f"{s}_own") for s in slots]).where("kind = 1")
    both = seen.join(_carried(events, slots), "part", "left")
    return both.select(*[c for c in events.columns if c not in (*slots, "part", "kind")], *[F.coalesce(f"{s}_own", f"{s}_before").alias(s) for s in slots])


def open_hosts(pages: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(row, id, host, path, nodes): urls with the rule hosts that enclose theirs."""
    nodes = rules.select("node").distinct().withColumn("depth", F.size(F.split("node", r"\.")) - 1)
    depth = min(MAX_LABELS, nodes.agg(F.max("depth")).first()[0] or 0)
    urls = pages.select(F.col(key).alias("id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.monotonically_increasing_id().alias("row"))
    urls = urls.select(F.when(F.col("host") == "", F.lit("")).otherwise(host_key(F.col("host"))).alias("key"), F.col("path").alias("sub"), F.lit(1).alias("kind"), "row", "id", "host", "path")
    if not depth:
        return durable(urls.select("row", "id", "host", "path", F.expr("cast(array() as array<string>)").alias("nodes")))
    slots = [f"at{d}" for d in range(1, depth + 1)]
    starts = nodes.select(F.col("node").alias("key"), F.lit("").alias("sub"), F.lit(0).alias("kind"), *[F.when(F.col("depth") == d, F.col("node")).alias(s) for d, s in enumerate(slots, 1)])
    events = urls.unionByName(starts, allowMissingColumns=True).repartitionByRange("key", "sub", "row")
    opened = F.filter(F.array(*slots), lambda n: F.startswith(F.col("key"), n))
    swept = _swept(events, slots)
    return durable(swept.select("row", "id", "host", "path", opened.alias("nodes")))


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, best): the longest rule of the open hosts, of urls that have one."""
    asked = urls.select("row", "path", F.explode("nodes").alias("key"))
    asked = asked.select("key", F.col("path").alias("sub"), F.lit(1).alias("kind"), "row")
    starts = rules.select(F.col("node").alias("key"), F.col("path").alias("sub"), F.lit(0).alias("kind"), F.struct("node", "path", "open").alias("rule"))
    events = asked.unionByName(starts, allowMissingColumns=True).repartitionByRange("key", "sub", "row")
    swept = _swept(events, ["rule"]).where(F.col("rule.node") == F.col("key"))
    fits = F.filter("rule.open", lambda n: F.startswith(F.col("sub"), F.substring(F.col("rule.path"), F.lit(1), n)))
    found = swept.select("row", F.col("key").alias("node"), F.array_max(fits).alias("n"), F.col("rule.path").alias("of")).where(F.col("n").isNotNull())
    found = found.select("row", "node", F.substring(F.col("of"), F.lit(1), F.col("n")).alias("path"))
    named = found.join(rules.select("node", "path", "host", "verdict"), ["node", "path"])
    rule = F.concat("host", "path")
    return named.groupBy("row").agg(F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), "verdict")).alias("best"))


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id") -> DataFrame:
    """``key``, host, path, rule (of the longest fitting rule) and verdict."""
    known = keyed_rules(rules)
    urls = open_hosts(pages, known, key)
    best = fitting_rules(urls, known)
    return urls.join(best, "row", "left").select(
        F.col("id").alias(key), "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("host") == "", F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
