"""Line-frequency quality rules, native Spark.

Lines are normalised (lower case, blanks collapsed) and hashed.  For each
host the number of distinct document texts that hold a line is counted; exact
copies therefore count once.  Lines over the limits are removed, and a
document that keeps too small a share of its words is rejected.  ``source``
stands for the host.

The counts are sums that every task combines before the shuffle, so a line
that a third of all documents share costs one row per task.  Frequent lines
are a small set: they are broadcast when a count proves it, else joined by
shuffle with salted keys, as every frequent line is a hot key.

Defined cases: a null or empty text has no words and fails the base rules; a
null host is a host of its own; rows that repeat each get a row and count as
one text; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, covered, durable, let, plain_words, window_hashes

REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
HAS_WORD = r"[^\x20\x09-\x0D]"
MAX_BROADCAST_LINES = 200_000
SALTS = 16


@dataclass(frozen=True)
class Limits:
    """A line is frequent in its host from ``min_docs`` distinct texts and
    ``host_share`` of the host's distinct texts on, whichever is more."""

    min_docs: int = 20
    host_share: float = 0.005
    min_kept_share: float = 0.5
    min_words: int = 20
    max_repeat_percent: int = 30


def lines_of(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(HAS_WORD))


def line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(line), BLANKS, " ")))


def repeated_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words inside windows that occur twice or more in the text."""

    def repeated(hashes: Column) -> Column:
        def spans(order: Column) -> Column:
            hit = F.transform(
                order,
                lambda x, i: F.when(
                    ((i > 0) & (F.get(order, i - 1)["h"] == x["h"])) | F.coalesce(F.get(order, i + 1)["h"] == x["h"], F.lit(False)),
                    F.struct(x["p"].alias("s"), (x["p"] + window).alias("e")),
                ),
            )
            return covered(F.array_sort(F.filter(hit, lambda x: x.isNotNull())))

        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(placed, spans))

    return let(window_hashes(words, window), repeated)


def features(docs: DataFrame, limits: Limits, *keep: str) -> DataFrame:
    """Per-document base figures."""
    text = F.coalesce("text", F.lit(""))
    lines = lines_of(F.col("text"))
    rows = docs.select(*keep, F.col("text"), plain_words(F.col("text")).alias("w")).select(
        *keep,
        "text",
        F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def frequent_lines(docs: DataFrame, limits: Limits, host: str = "source") -> DataFrame:
    """(host, line, docs): lines over the limits, in the shared folder."""
    keyed = docs.select(
        F.col(host).alias("host"),
        F.xxhash64("text").alias("text_key"),
        F.array_distinct(F.transform(lines_of(F.col("text")), line_key)).alias("lines"),
    )
    texts = keyed.groupBy("host", "text_key").agg(F.first("lines").alias("lines"))
    # The host's own count rides along as line null, so texts are read once.
    held = texts.select("host", F.explode_outer(F.concat(F.array(F.lit(None).cast("long")), "lines")).alias("line"))
    counts = held.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("line").isNull() | (F.col("docs") >= limits.min_docs))
    counts = durable(counts)
    hosts = counts.where(F.col("line").isNull()).select(F.col("host").alias("of"), F.col("docs").alias("host_docs"))
    return (
        counts.where(F.col("line").isNotNull())
        .join(hosts, F.col("host").eqNullSafe(F.col("of")))
        .where(F.col("docs") >= F.col("host_docs") * limits.host_share)
        .select("host", "line", "docs")
    )


def apply_rules(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """doc_id, base figures, removed lines' effect, ``clean_text`` and ``kept``."""
    frequent = frequent_lines(docs, limits, host).select(F.col("host").alias("of"), F.col("line").alias("hot"))
    small = frequent.limit(MAX_BROADCAST_LINES + 1).count() <= MAX_BROADCAST_LINES
    held = docs.select(
        F.col(host).alias("host"),
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.monotonically_increasing_id().alias("row"),  # tells rows apart in this pass only
        F.transform(lines_of(F.col("text")), lambda x: F.struct(line_key(x).alias("line"), x.alias("whole"))).alias("lines"),
    ).select("host", "doc_id", "text_key", "row", F.explode_outer("lines").alias("x"))
    held = held.select("host", "doc_id", "text_key", "row", F.col("x.line").alias("line"), F.col("x.whole").alias("whole"))
    same = F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("hot"))
    if small:
        hits = held.join(F.broadcast(frequent), same)
    else:
        salted = frequent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = held.withColumn("own_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).join(salted, same & (F.col("own_salt") == F.col("salt")))
    hits = hits.groupBy("doc_id", "text_key", "host", "row").agg(F.sum(F.size(plain_words(F.col("whole")))).alias("n"), F.collect_set("line").alias("lines"))
    hits = hits.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), F.col("host").alias("hit_host")).agg(
        F.max("n").alias("hit_words"), F.first("lines").alias("hit_lines")
    )
    rows = features(docs, limits, "doc_id", host).withColumn("text_key", F.xxhash64("text"))
    joined = rows.join(
        hits,
        rows["doc_id"].eqNullSafe(hits["hit_id"]) & (rows["text_key"] == hits["hit_key"]) & rows[host].eqNullSafe(hits["hit_host"]),
        "left",
    )
    removed = F.coalesce("hit_words", F.lit(0)).cast("long")
    clean = F.when(
        F.col("hit_lines").isNotNull(),
        F.array_join(F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(F.col("hit_lines"), line_key(x))), "\n"),
    ).otherwise(F.col("text"))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        removed.alias("n_removed_words"),
        clean.alias("clean_text"),
    ).withColumn(
        "kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_removed_words") >= F.col("n_words") * limits.min_kept_share)
    )
