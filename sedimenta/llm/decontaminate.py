"""Benchmark decontamination: broadcast set of test n-grams, native Spark.

Benchmark texts become windows of ``n`` consecutive tokens (an item that is
shorter is one window of its own length).  Training texts are cut into windows
of all these lengths in one pass, probed by 64-bit hash, and each hash hit is
verified on the words themselves.  The distinct windows are a hash set that is
broadcast when a count proves it small.  Beyond that a bitmap of the hashes,
of bounded size, is broadcast in its place; windows that it lets through are
joined by shuffle.

Defined cases: a null or empty text has no words and no hits; an empty
benchmark hits nothing; rows that repeat (same doc_id and text) each get a
row; other columns of the input, whatever their names, play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import covered, fields_of, gram, tokens, whole_row

WINDOW = 10
#: Windows up to which the benchmark's set is broadcast (some 100 MB).
MAX_BROADCAST_WINDOWS = 500_000
#: 64-bit words of the bitmap: eight bits for each window, up to some 80 MB.
MAX_BITMAP_WORDS = 2_000_000


def _per_length(lengths: list[int], length: Column, of) -> Column:
    """``of(k)`` for the one of ``lengths`` that ``length`` is."""
    out = of(lengths[-1])
    for k in lengths[:-1]:
        out = F.when(length == k, of(k)).otherwise(out)
    return out


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(h, length, item_id, gram): the distinct windows of each item."""
    words = benchmark.select("item_id", tokens(F.col("text")).alias("w")).where(F.size("w") > 0)
    lengths = words.select("item_id", "w", F.least(F.size("w"), F.lit(n)).alias("length"))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1), lambda i: F.slice("w", i, F.col("length")))
    hashed = _per_length(list(range(1, n + 1)), F.size("g"), lambda k: F.xxhash64(*gram(F.col("g"), F.lit(0), k)))
    return lengths.select("item_id", "length", F.explode(grams).alias("g")).select(hashed.alias("h"), "length", "item_id", F.array_join("g", " ").alias("gram")).distinct()


def bitmap(windows: DataFrame, count: int) -> tuple[DataFrame, int]:
    """(slot, bits) of the windows' hashes, a row per 64-bit word that has any, and the number of words."""
    words = max(1, min(MAX_BITMAP_WORDS, count // 8))
    slots = windows.select(_slot(F.col("h"), words).alias("slot"), _bit(F.col("h")).alias("bit"))
    return slots.groupBy("slot").agg(F.bit_or("bit").alias("bits")), words


def _slot(h: Column, words: int) -> Column:
    return F.pmod(F.shiftright(h, 6), F.lit(words))


def _bit(h: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int"))


def window_hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """One row per document row: its key, words, hit spans and items.

    Columns: doc_id, text_key, n_words, spans (sorted array of (s, e), word
    positions from 0, end exclusive), items (array of item_id).
    """
    grams = benchmark_windows(benchmark, n)
    sizes = {r["length"]: r["n"] for r in grams.groupBy("length").agg(F.count("*").alias("n")).collect()}  # n rows at most
    lengths, total = sorted(sizes) or [n], sum(sizes.values())
    words = docs.select("doc_id", F.xxhash64("text").alias("text_key"), tokens(F.col("text")).alias("w"))
    # Places, not hashes, are exploded: the hash is then compiled code.  Place -1 is the document itself.
    places = F.sequence(F.lit(-1), F.greatest(F.size("w") - lengths[0], F.lit(-1)))
    cut = words.select("doc_id", "text_key", "w", F.explode_outer(places).alias("pos"))
    if len(lengths) > 1:
        each = F.explode(F.array(*[F.lit(k) for k in lengths])).alias("length")
        inside = F.when(F.col("pos") < 0, F.col("length") == lengths[0]).otherwise(F.col("pos") + F.col("length") <= F.size("w"))
        cut = cut.select("*", each).where(inside)
    else:
        cut = cut.withColumn("length", F.lit(lengths[0]))
    itself = F.col("pos") < 0
    hashed = _per_length(lengths, F.col("length"), lambda k: F.xxhash64(*gram(F.col("w"), F.col("pos"), k)))
    own_gram = _per_length(lengths, F.col("length"), lambda k: F.concat_ws(" ", *gram(F.col("w"), F.col("pos"), k)))
    cut = cut.select("doc_id", "text_key", "w", "pos", "length", hashed.alias("own_h"))
    probe = grams.select("h", F.col("length").alias("of_length"), "item_id", "gram")
    same = (F.col("own_h") == F.col("h")) & (F.col("length") == F.col("of_length"))
    if total <= MAX_BROADCAST_WINDOWS:
        # The words of a place are put together only where the hash hits: a null gram on the left ends the test.
        found = cut.join(F.broadcast(probe), same & ~itself, "left").where(itself | (F.col("gram").isNotNull() & (F.col("gram") == own_gram)))
        found = found.select("*", F.size("w").cast("long").alias("n_words"))
    else:  # a shuffled row must not carry its whole text
        bits, n_slots = bitmap(probe, total)
        near = cut.join(F.broadcast(bits), (_slot(F.col("own_h"), n_slots) == F.col("slot")) & (F.col("bits").bitwiseAND(_bit(F.col("own_h"))) != 0) & ~itself)
        near = near.select("doc_id", "text_key", "pos", "length", "own_h", own_gram.alias("own_gram"))
        own = words.select("doc_id", "text_key", F.lit(-1).alias("pos"), F.size("w").cast("long").alias("n_words"))
        found = near.join(probe, same).where(F.col("own_gram") == F.col("gram")).unionByName(own, allowMissingColumns=True)
    span = F.when(~itself, F.struct(F.col("pos").alias("s"), (F.col("pos") + F.col("length")).alias("e")))
    found = found.select("doc_id", "text_key", F.when(itself, 1).alias("own"), F.when(itself, F.col("n_words")).alias("n_words"), span.alias("span"), "item_id")
    return (
        found.groupBy("doc_id", "text_key")
        .agg(F.max("n_words").alias("n_words"), F.count("own").alias("rows"), F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("item_id").alias("items"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        .drop("copy", "rows")
    )


def report(hits: DataFrame) -> DataFrame:
    """Digest of :func:`window_hits`, a row per document row."""
    n_hit = covered(F.col("spans"))
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` without those that hold a benchmark window."""
    hits = window_hits(docs, benchmark, n).where(F.size("spans") > 0).select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct()
    named = docs.select(F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_key"), whole_row(docs).alias("row"))
    left = named.join(hits, F.col("own_id").eqNullSafe(F.col("hit_id")) & (F.col("own_key") == F.col("hit_key")), "left_anti")
    return left.select(*fields_of("row", docs.columns))
