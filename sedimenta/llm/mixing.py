"""Mixing sources to target weights by systematic sampling.

Each source's target share of the mix sets the expected copies of its
documents.  Within a source documents stand in an order that does not depend
on the run, expected copies are summed along it, one offset is added, and a
document is emitted once per integer that its part of the sum crosses.  The
order puts like sizes next to each other (size classes of a quarter octave),
so the words taken stay close to the target.

The sum is split: the documents of a source and size class are dealt by a hash
of their id and text into blocks; sums inside a block, of whole blocks and of
groups of blocks are separate windows, so a source that holds a third of all
rows is many blocks, not one task.  Rows that are equal in all columns are
counted before the first shuffle.

Defined cases: null source is a source of its own, last in order; a null text
has no words; documents of no words are taken at their source's rate and add
nothing; rows that repeat are documents of their own; rows of one id, or of
none, that differ in text, source or any other column keep their own columns
(ties in size and id stand by text, then by a hash of the row); columns of any
other name play no part, and ``copy`` is called ``copy_`` where that name is
taken; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, fields_of, free_name, plain_words, row_hashes, whole_row

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_REPEATS = 2
#: Rows of a block, about.
BLOCK_ROWS = 500
#: Blocks of a group, and equal rows that are told apart at a time.
GROUP_BLOCKS = 1000
CHUNK = 4096
#: Sources times size classes up to which their figures are broadcast (some 10 MB).
MAX_BROADCAST_CLASSES = 100_000


def _hash32(*parts):
    """A number in [0, 2**32) from MD5, which other engines have too."""
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("long")


def size_class(size):
    """Number of binary digits, and the two after the first."""
    digits = F.bin(size)
    return F.concat(F.lpad(F.length(digits).cast("string"), 2, "0"), F.substring(digits, 2, 2))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(skey, source_size, docs, target): one row per source.

    Weights follow the order of sources.  A target is weight times a level;
    sources in order of size per weight reach their cap while the level that
    is left for the rest lies above it.  There is a row per source, so the
    windows over all sources are small.
    """
    stats = sizes.groupBy("skey").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    by_name = Window.orderBy("skey")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    weighed = stats.select("*", weight.cast("long").alias("weight")).withColumn("cap", F.col("source_size") * MAX_REPEATS)
    everything = Window.partitionBy(F.lit(1))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "skey")
    levelled = (
        weighed.withColumn("goal", F.sum("source_size").over(everything) * SHARE_PERCENT / 100)
        .withColumn("spent", F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("goal") - F.col("spent")) / F.col("weight_left"))
        .withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    )
    open_level = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * open_level)
    return levelled.select("skey", "source_size", "docs", target.alias("target"))


def alike_rows(docs: DataFrame) -> DataFrame:
    """(skey, doc_id, size, text_md5, row_a, row_b, n): documents, rows that are equal
    in all columns as one with their number; combined in each task before the shuffle."""
    a, b = row_hashes(docs)
    sizes = docs.select(
        F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1")).alias("skey"),
        "doc_id",
        F.size(plain_words(F.col("text"))).cast("long").alias("size"),
        F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"),
        a.alias("row_a"),
        b.alias("row_b"),
    )
    return durable(sizes.groupBy(*sizes.columns).agg(F.count("*").alias("n")))  # texts are read once


def placed_rows(alike: DataFrame, seed: int) -> DataFrame:
    """``alike`` with source_size, target, rate, offset and ``place``: how many
    documents of the source stand before it."""
    targets = durable(source_targets(alike))
    classes = durable(alike.groupBy("skey", size_class(F.col("size")).alias("class")).agg(F.sum("n").alias("rows")))
    if classes.count() <= MAX_BROADCAST_CLASSES:  # there are more classes than sources
        targets, classes = F.broadcast(targets), F.broadcast(classes)
    doc_name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    dealt = (
        alike.join(targets, "skey")
        .withColumn("class", size_class(F.col("size")))
        .join(classes, ["skey", "class"])
        # The text counts too, so that documents of one id, or of none, spread.
        .withColumn("block", F.pmod(_hash32(doc_name, F.lit(f"/{seed}/"), F.col("text_md5")), F.ceil(F.col("rows") / BLOCK_ROWS)))
        .drop("rows")
        # Dealing by source alone would do for all that follows, but not for a source of a third of all rows.
        .repartition("skey", "class", "block")
    )
    along = Window.partitionBy("skey", "class", "block").orderBy("size", "doc_id", "text_md5", "row_a", "row_b").rowsBetween(Window.unboundedPreceding, 0)
    ranked = dealt.withColumn("inside", F.sum("n").over(along) - F.col("n"))
    # Sums before a block: of whole groups of blocks, then of blocks in the group, so no window holds all blocks of a source.
    blocks = dealt.groupBy("skey", "class", "block").agg(F.sum("n").alias("rows")).withColumn("group", F.floor(F.col("block") / GROUP_BLOCKS))
    earlier = lambda w: F.coalesce(F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = blocks.groupBy("skey", "class", "group").agg(F.sum("rows").alias("rows"))
    groups = groups.select("skey", "class", "group", earlier(Window.partitionBy("skey").orderBy("class", "group")).alias("before_group"))
    blocks = blocks.select("skey", "class", "group", "block", earlier(Window.partitionBy("skey", "class", "group").orderBy("block")).alias("before_block"))
    blocks = blocks.join(groups, ["skey", "class", "group"]).select("skey", "class", "block", (F.col("before_group") + F.col("before_block")).alias("before"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _hash32(F.col("skey"), F.lit(f"#{seed}")) / F.lit(4294967296.0)
    return ranked.join(blocks, ["skey", "class", "block"]).withColumns({"place": F.col("before") + F.col("inside"), "rate": rate, "offset": offset})


def _upto(k):
    """Documents taken of the first ``k`` of a source.  They are alike in
    expected copies, so the sum up to the k-th is k times the rate, free of the
    drift of added fractions."""
    return F.floor(F.col("offset") + F.col("rate") * k)


def mix(docs: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target and ``copies`` to take, for each row."""
    placed = placed_rows(alike_rows(docs), seed)
    # Equal rows are told apart again, some thousands at a time.
    chunk = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))))
    last = F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK)
    each = chunk.withColumn("k", F.explode(F.sequence(F.col("chunk") * CHUNK + 1, last)))
    place = F.col("place") + F.col("k")
    return each.select("doc_id", "size", "source_size", "target", (_upto(place) - _upto(place - 1)).alias("copies"))


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """Rows of ``docs``, each as often as the mix takes it, with ``copy`` from 1.

    Every row keeps its own columns; rows equal in all columns (maps apart)
    are one row, taken as often as all of them are.
    """
    alike = alike_rows(docs)
    place = F.col("place")
    taken = placed_rows(alike, seed).select("row_a", "row_b", (_upto(place + F.col("n")) - _upto(place)).alias("times")).where(F.col("times") > 0)
    a, b = row_hashes(docs)
    rows = docs.select(a.alias("row_a"), b.alias("row_b"), whole_row(docs).alias("row"))
    if not alike.where(F.col("n") > 1).isEmpty():
        rows = rows.groupBy("row_a", "row_b").agg(F.first("row").alias("row"))
    copied = rows.join(taken, ["row_a", "row_b"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return copied.select(*fields_of("row", docs.columns), F.col("copy").alias(free_name("copy", docs.columns)))
