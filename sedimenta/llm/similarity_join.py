"""N-gram Jaccard self-join by chosen paths.

A text is its set of ``SHINGLE``-word shingles; two texts are linked when the
Jaccard similarity of their sets reaches ``THRESHOLD``.  Texts of equal sets
are one representative from the start, so copies cost nothing further.

Each set is embedded as a sketch of ``SKETCH`` sampled tokens (minima of
independent hashes): two sets share a sampled token with the probability of
their similarity.  A run picks ``BRANCH`` sampled tokens and splits all sets
by them; a bucket of more than ``LEAF`` sets is split again the same way, with
a choice that depends on its path, down to ``DEPTH``.  A bucket whose child
keeps most of it is dense and is not split further.  Small, dense and last
buckets are compared by brute force, large ones in square blocks, so nothing
is capped.  Runs are repeated until a pair at the threshold is missed with a
probability below ``1 - RECALL`` (higher similarities far below it).

A pair may meet in several buckets; it counts in the first of the buckets that
both share, by size and name, which each side can tell from its own list.  So
no pair is ever a row: a block gives each set its partners by sketch, then the
texts of such sets meet once more for exact similarities, and what leaves a
block is a row per set with its links and its root in the block.  Roots are
joined into classes by label propagation with pointer jumps, in checkpoints.

Texts go by the digest of their set and rows by a hash of all their columns, so
keys may repeat or be missing.

Defined cases: a text of fewer words than a shingle is one shingle of all its
words; a text without words (null, empty) has no links and is a class of its
own; rows that repeat each get a row; copies share class and links; several
texts of one key are each in the class of their text, which ``class_key`` tells
apart; rows without a key take part, and a class of such rows only has no
``class_id``; columns of any other name play no part.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, fields_of, row_hashes, whole_row

SHINGLE = 5
THRESHOLD = 0.8
SKETCH = 64
BRANCH = 3
LEAF = 256
DEPTH = 4
DENSE = 0.6
RECALL = 0.9999
BLOCK = 512
#: Sketch agreement a pair needs for the exact check: five standard
#: deviations below the threshold.
AGREE = math.floor(SKETCH * THRESHOLD - 5 * math.sqrt(SKETCH * THRESHOLD * (1 - THRESHOLD)))

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_KNOWN_WORDS = 1_000_000


def runs_needed(recall: float = RECALL, branch: int = BRANCH, depth: int = DEPTH, similarity: float = THRESHOLD) -> int:
    """Runs after which a pair at the threshold is found with ``recall``."""
    missed = 0.0
    for _ in range(depth):
        missed = (1 - similarity * (1 - missed)) ** branch
    return max(1, math.ceil(math.log(1 - recall) / math.log(missed)))


class _Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, known: _Hashes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    out = np.full(len(h) - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        out = (out ^ h[k : len(h) - width + 1 + k]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


_RNG = np.random.default_rng(20240229)
_MUL = _RNG.integers(1, 2**63, SKETCH, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, SKETCH, np.uint64)


def sketch(found: np.ndarray) -> np.ndarray:
    out = np.full(SKETCH, 2**32 - 1, np.uint64)
    for at in range(0, len(found), 4096):
        part = found[at : at + 4096]
        out = np.minimum(out, ((_MUL[:, None] * part + _ADD[:, None]) >> np.uint64(32)).min(axis=1))
    return out.astype(np.uint32).view(np.int32)


def sketches(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc, row_a, row_b, id, size, sketch) per row; ``id`` is the digest of the
    set, null without words."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part, rows = batch.iloc[at : at + 2000], []
                for text in part["text"]:
                    s = shingles(text, known)
                    rows.append((xxhash.xxh3_128_digest(s.tobytes()), len(s), sketch(s)) if len(s) else (None, 0, None))
                digest, n, sk = zip(*rows, strict=True)
                yield part[["doc", "row_a", "row_b"]].assign(id=digest, size=n, sketch=sk)

    a, b = row_hashes(docs)
    kind = docs.schema[key].dataType.simpleString()
    # As text, so that a missing key does not turn a batch of integers into floats.
    named = docs.select(F.col(key).cast("string").alias("doc"), a.alias("row_a"), b.alias("row_b"), "text")
    found = named.mapInPandas(of, "doc string, row_a long, row_b long, id binary, size int, sketch array<int>")
    return found.withColumn("doc", F.col("doc").cast(kind))


def split_buckets(reps: DataFrame) -> DataFrame:
    """(leaf, n, id): buckets to compare, each of two sets at least."""
    runs = runs_needed()
    order = np.random.default_rng(7).permutation(SKETCH)[: runs * BRANCH]  # a run's tokens differ from the others'
    nodes = F.array(*[F.struct(F.xxhash64(F.lit(k // BRANCH), F.lit(int(i)), F.get("sketch", F.lit(int(i)))).alias("node")) for k, i in enumerate(order)])
    rows = reps.select("id", F.explode(nodes).alias("x")).select("id", F.col("x.node").alias("node"), F.lit(0).cast("long").alias("parent"), F.lit(0).cast("long").alias("parent_n"))
    leaves, above = None, None
    for depth in range(1, DEPTH + 1):
        counts = rows.groupBy("node", "parent", "parent_n").agg(F.count("*").alias("n")).where(F.col("n") > 1)
        kept = durable(rows.join(counts.select("node", "n"), "node"))
        if above is not None:
            dense = kept.where(F.col("n") >= F.col("parent_n") * DENSE).select(F.col("parent").alias("leaf")).distinct()
            whole = above.join(dense, "leaf", "left_semi")
            leaves = leaves.unionByName(whole)
            kept = kept.join(dense, kept["parent"] == dense["leaf"], "left_anti")
        large = (F.col("n") > LEAF) & F.lit(depth < DEPTH)
        done = kept.where(~large).select(F.col("node").alias("leaf"), "n", "id")
        leaves = done if leaves is None else leaves.unionByName(done)
        above = kept.where(large).select(F.col("node").alias("leaf"), "n", "id")
        if depth == DEPTH or above.isEmpty():
            break
        picks = F.array(*[F.pmod(F.xxhash64("leaf", F.lit(k)), F.lit(SKETCH)).cast("int") for k in range(BRANCH)])
        rows = (
            above.join(reps.select("id", "sketch"), "id")
            .select("id", "leaf", "n", "sketch", F.explode(F.array_distinct(picks)).alias("i"))
            .select("id", F.xxhash64("leaf", "i", F.get("sketch", F.col("i"))).alias("node"), F.col("leaf").alias("parent"), F.col("n").alias("parent_n"))
        )
    return leaves


def in_blocks(leaves: DataFrame) -> DataFrame:
    """Adds ``cell``: leaf and pair of blocks; and ``block`` 0 or 1, or 2 for
    a cell that pairs a block with itself."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id", "leaf"), blocks).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(
            F.xxhash64(F.col("leaf"), F.least(own, other), F.greatest(own, other)).alias("cell"),
            F.when(own == other, 2).when(own < other, 0).otherwise(1).alias("block"),
        ),
    )
    return leaves.withColumn("c", F.explode(cells)).select("*", "c.cell", "c.block").drop("c")


def _by_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole cells of batches that are sorted by cell."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        cell = rest["cell"].to_numpy()
        cuts = np.flatnonzero(cell[1:] != cell[:-1]) + 1
        if len(cuts):
            for a, b in zip([0, *cuts[:-1]], cuts, strict=True):
                yield rest.iloc[a:b]
            rest = rest.iloc[cuts[-1] :].reset_index(drop=True)
    if rest is not None:
        yield rest


def _pairs(block: np.ndarray) -> np.ndarray:
    """Which pairs (i < j) the cell compares."""
    m = len(block)
    upper = np.triu(np.ones((m, m), bool), 1)
    return upper if (block == 2).all() else upper & (block[:, None] != block[None, :])


def partners_by_sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each cell, the sets with a partner: cell, id, partners."""
    held: dict[str, list] = {"cell": [], "id": [], "partners": []}  # partners: bits over the cell's sets here, by id
    for group in _by_cell(batches):
        if len(group) < 2:
            continue
        ids, n = group["id"].to_numpy(), group["size"].to_numpy()
        rows = np.stack(group["sketch"].to_numpy())
        m = len(ids)
        wanted = _pairs(group["block"].to_numpy())
        wanted &= np.minimum(n[:, None], n) >= THRESHOLD * np.maximum(n[:, None], n)
        if not wanted.any():
            continue
        for a in range(0, m, 128):
            wanted[a : a + 128] &= (rows[a : a + 128, None, :] == rows[None, :, :]).sum(axis=2, dtype=np.int16) >= AGREE
        if not wanted.any():
            continue
        # Pairs that share an earlier bucket belong there.
        before = group["before"].to_numpy()
        flat = np.concatenate([np.asarray(x, np.int64) for x in before])
        if len(flat):
            names, which = np.unique(flat, return_inverse=True)
            shared = np.zeros((m, len(names)), np.float32)
            shared[np.repeat(np.arange(m), [len(x) for x in before]), which] = 1
            shared = shared[:, shared.sum(axis=0) > 1]
            wanted &= ~((shared @ shared.T) > 0)
        active = np.flatnonzero(wanted.any(axis=0) | wanted.any(axis=1))
        active = active[np.argsort(ids[active])]
        for i in active:
            held["cell"].append(group["cell"].iloc[0])
            held["id"].append(ids[i])
            held["partners"].append(np.packbits(wanted[i, active]).tobytes())
        if len(held["id"]) >= 2000:
            yield pd.DataFrame(held)
            held = {k: [] for k in held}
    if held["id"]:
        yield pd.DataFrame(held)


def similarities(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the pairs."""
    sizes = np.array([len(s) for s in sets])
    common = np.zeros(len(left))
    if len(left) > 20 * len(sets):
        # Many pairs: counts of common tokens as products, a slice of tokens at a time.
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        keep = times[token] > 1
        owner, token = owner[keep], np.unique(token[keep], return_inverse=True)[1]
        total = np.zeros((len(sets), len(sets)), np.float32)
        for at in range(0, int(token.max(initial=-1)) + 1, 4096):
            part = (token >= at) & (token < at + 4096)
            table = np.zeros((len(sets), 4096), np.float32)
            table[owner[part], token[part] - at] = 1
            total += table @ table.T
        common = total[left, right]
    else:
        for k, (i, j) in enumerate(zip(left, right, strict=True)):
            a, b = (sets[i], sets[j]) if sizes[i] < sizes[j] else (sets[j], sets[i])
            at = np.searchsorted(b, a)
            at[at == len(b)] = 0
            common[k] = (b[at] == a).sum()
    return common / (sizes[left] + sizes[right] - common)


def verified_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each cell, the sets with a link: id, links, root."""
    known = _Hashes()
    held: list[tuple] = []
    for group in _by_cell(batches):
        ids = group["id"].to_numpy()
        group = group.iloc[np.argsort(ids)]
        ids = group["id"].to_numpy()
        sets = [shingles(t, known) for t in group["text"]]
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=len(ids)) for p in group["partners"]])
        left, right = np.nonzero(bits)
        if not len(left):
            continue
        linked = similarities(sets, left, right) >= THRESHOLD - 1e-12
        left, right = left[linked], right[linked]
        links = np.bincount(left, minlength=len(ids)) + np.bincount(right, minlength=len(ids))
        low = np.arange(len(ids))  # least place, so least id, in the component, by rounds
        while True:
            new = low.copy()
            np.minimum.at(new, left, low[right])
            np.minimum.at(new, right, low[left])
            new = np.minimum(new, new[new])
            if (new == low).all():
                break
            low = new
        root = ids[low]
        held += [(ids[k], int(links[k]), root[k]) for k in np.flatnonzero(links)]
        if len(held) >= 5000:
            yield pd.DataFrame(held, columns=["id", "links", "root"])
            held = []
    if held:
        yield pd.DataFrame(held, columns=["id", "links", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the least id of each id's component of (a, b) edges."""
    edges = durable(edges.where(F.col("a") != F.col("b")).distinct())
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("root"))
    labels = durable(labels)
    while True:
        told = both.join(labels, F.col("b") == F.col("id")).select(F.col("a").alias("id"), "root")
        least = labels.unionByName(told).groupBy("id").agg(F.min("root").alias("root"))
        jump = least.select(F.col("id").alias("root"), F.col("root").alias("over"))
        new = least.join(jump, "root").select("id", F.col("over").alias("root"))
        new = durable(new.join(labels.select("id", F.col("root").alias("was")), "id"))
        if new.where(F.col("root") != F.col("was")).isEmpty():
            return new.select("id", "root")
        labels = new.select("id", "root")


def classes_of(docs: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(doc, row_a, row_b, id) of each row, and of each text's set (id, root,
    copy_of, class_id, n_links): ``id`` and ``root`` are digests, the others keys."""
    rows = durable(sketches(docs, key))
    reps = (
        rows.where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min(F.struct("row_a", "row_b")).alias("of"), F.min("doc").alias("copy_of"), F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    )
    reps = durable(reps)
    leaves = durable(split_buckets(reps))
    lists = leaves.groupBy("id").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "leaf"))).alias("all"))
    cells = in_blocks(leaves).join(lists, "id").join(reps.select("id", "size", "sketch"), "id")
    earlier = F.filter("all", lambda x: (x["n"] < -F.col("n")) | ((x["n"] == -F.col("n")) & (x["leaf"] < F.col("leaf"))))
    cells = cells.select("cell", "block", "id", "size", "sketch", F.transform(earlier, lambda x: x["leaf"]).alias("before"))
    found = cells.repartition("cell").sortWithinPartitions("cell").mapInPandas(partners_by_sketch, "cell long, id binary, partners binary")
    found = durable(found)
    wanted = reps.join(found, "id", "left_semi").select("id", F.col("of.row_a").alias("row_a"), F.col("of.row_b").alias("row_b"))
    a, b = row_hashes(docs)
    named = docs.select(a.alias("row_a"), b.alias("row_b"), "text").join(wanted, ["row_a", "row_b"]).dropDuplicates(["id"])
    texts = found.join(named.select("id", "text"), "id").select("cell", "id", "partners", "text")
    links = durable(texts.repartition("cell").sortWithinPartitions("cell").mapInPandas(verified_links, "id binary, links long, root binary"))
    roots = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    totals = links.groupBy("id").agg(F.sum("links").alias("n_links"))
    classes = reps.select("id", "copy_of").join(roots, "id", "left").join(totals, "id", "left")
    classes = durable(classes.select("id", F.coalesce("root", "id").alias("root"), "copy_of", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    least = durable(classes.groupBy("root").agg(F.min("copy_of").alias("class_id")))
    return rows.select("doc", "row_a", "row_b", "id"), classes.join(least, "root")


def join_texts(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, class_id (least key of the class), copy_of (least key of equal
    sets), n_links (other sets linked) and class_key, for each row."""
    rows, classes = classes_of(docs, key)
    alone = F.col("id").isNull()
    return rows.join(classes, "id", "left").select(
        F.col("doc").alias(key),
        F.when(alone, F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc")).otherwise(F.col("copy_of")).alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.lower(F.hex("root")).alias("class_key"),
    )


def one_of_each_class(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row of each class: that of the least key (none last), of its rows the
    one of least hash.  Rows without words are classes of their own and stay."""
    rows, classes = classes_of(docs, key)
    # Rows equal in all columns are one here, with their number.
    members = rows.where(F.col("id").isNotNull()).groupBy("id", "doc", "row_a", "row_b").agg(F.count("*").alias("times"))
    members = members.join(classes.select("id", "root"), "id").select("root", "times", F.struct(F.col("doc").isNull().alias("none"), "doc", "row_a", "row_b").alias("of"))
    members = durable(members)
    # Written before it is joined, so that the join may split the rows of a large class.
    first = durable(members.groupBy("root").agg(F.min("of").alias("first")))
    marked = members.join(first, "root").select((F.col("of") == F.col("first")).alias("stays"), "times", F.col("of.row_a").alias("row_a"), F.col("of.row_b").alias("row_b"))
    marked = durable(marked.where(~F.coalesce("stays", F.lit(True)) | (F.col("times") > 1)))
    a, b = row_hashes(docs)
    kept = docs.select(a.alias("row_a"), b.alias("row_b"), whole_row(docs).alias("row"))
    kept = kept.join(marked.where(~F.col("stays")), ["row_a", "row_b"], "left_anti")
    again = marked.where("stays")
    if not again.isEmpty():
        single = kept.join(again, ["row_a", "row_b"], "left_semi").groupBy("row_a", "row_b").agg(F.first("row").alias("row"))
        kept = kept.join(again, ["row_a", "row_b"], "left_anti").unionByName(single)
    return kept.select(*fields_of("row", docs.columns))
