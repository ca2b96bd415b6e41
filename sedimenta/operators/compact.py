"""Compaction: from overlapping mutations to one consistent row per key.

Everything is a function of DataFrames.  Rules:

* Atoms are grouped by (row_key, source_path).  ``trace_source=False`` blanks
  the path, so that files merge; tracing keeps every file's rows apart.
* A row's ``deleted_at`` is the largest of its atoms, NOT_DELETED at least.
* Of the cells of one name the newest timestamp wins.  Ties go to the larger
  kind, then value, then source, so that reruns agree.
* A range tombstone removes cells with ``min <= name <= max`` of no newer
  timestamp, names and bounds compared as their type does (``name_type``); a
  row tombstone removes cells with ``ts <= deleted_at``.
* Cell tombstones and expiring cells stay; range tombstones do not.
* A row stays even if no cell does.

At scale: newest cells and row markers are aggregates with partial sums per
task; cells are grouped by name too, so a wide row is spread until its cells
are collected.  ``cells`` stops before that, with a row per cell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bind import let
from ..functions.decode import in_order_of
from ..model import CELLS, ERROR, NOT_DELETED, RANGE

KEY = ["row_key", "source_path"]
#: Cells of a row that are held against its range tombstones together.
BLOCK = 256


@dataclass(frozen=True)
class Options:
    trace_source: bool = False
    max_row_bytes: int | None = None
    name_type: str = "BytesType"


def grouped_source(atoms: DataFrame, trace_source: bool) -> DataFrame:
    path = F.coalesce("source_path", F.lit("")) if trace_source else F.lit("")
    return atoms.where(F.col("kind") != ERROR).withColumn("source_path", path)


def row_deletes(atoms: DataFrame) -> DataFrame:
    """(row_key, source_path, deleted_at) of every row."""
    floor = F.lit(NOT_DELETED)
    return atoms.groupBy(*KEY).agg(F.coalesce(F.greatest(F.max("row_deleted_at"), floor), floor).alias("deleted_at"))


def newest_cells(atoms: DataFrame) -> DataFrame:
    """The winning cell of each (row_key, source_path, name)."""
    cells = atoms.where(F.col("kind").isin(*CELLS))
    best = F.max(F.struct("ts", "kind", "value", "ttl", "local_deletion_time", "ts_last_delete", "size")).alias("b")
    return cells.groupBy(*KEY, "name").agg(best).select(*KEY, "name", "b.*")


def newest_cells_by_window(atoms: DataFrame) -> DataFrame:
    """As :func:`newest_cells`, by ranking; it keeps columns it does not know."""
    cells = atoms.where(F.col("kind").isin(*CELLS))
    order = [F.col(c).desc_nulls_last() for c in ("ts", "kind", "value", "ttl", "local_deletion_time", "ts_last_delete", "size")]
    rank = F.row_number().over(Window.partitionBy(*KEY, "name").orderBy(*order))
    return cells.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def without_range_deleted(cells: DataFrame, atoms: DataFrame, name_type: str = "BytesType") -> DataFrame:
    """Cells that no range tombstone of their row covers.

    An anti join on the row key with the range as a residual; a few tombstones
    are broadcast by their size at run time, many are joined by key, where
    skewed keys are split.
    """
    ranges = atoms.where(F.col("kind") == RANGE).select(
        F.col("row_key").alias("_key"), F.col("source_path").alias("_path"), F.col("name").alias("_min"), "range_max", F.col("ts").alias("_ts")
    )
    ranges = ranges.groupBy("_key", "_path", "_min", "range_max").agg(F.max("_ts").alias("_ts"))
    order = in_order_of(name_type)
    ranges = ranges.select("_key", "_path", "_ts", order(F.col("_min")).alias("_low"), order(F.col("range_max")).alias("_high"))
    placed = cells.withColumn("_at", order(F.col("name")))
    covered = (
        (placed["row_key"] == ranges["_key"])
        & (placed["source_path"] == ranges["_path"])
        & placed["_at"].between(ranges["_low"], ranges["_high"])
        & (placed["ts"] <= ranges["_ts"])
    )
    return placed.join(ranges, covered, "left_anti").drop("_at")


def within_size(atoms: DataFrame, limit: int, name_type: str = "BytesType") -> DataFrame:
    """Atoms of a row up to the one whose size would pass the limit.

    Sizes of all atoms count, losers and tombstones too, in the order of name
    (row marker first) and time.  The atom that passes the limit is dropped
    but its row deletion still counts: it stays as a row marker with
    ``too_big`` true.
    """
    place = F.when(F.col("name").isNotNull(), in_order_of(name_type)(F.col("name")))
    order = [place.asc_nulls_first(), F.col("ts").asc_nulls_first(), F.col("kind").asc(), F.col("value").asc_nulls_first()]
    upto = F.sum(F.coalesce("size", F.lit(0))).over(Window.partitionBy(*KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    sized = atoms.withColumn("_upto", upto)
    before = F.col("_upto") - F.coalesce("size", F.lit(0))
    over = F.col("_upto") > limit
    kept = sized.where(~over | (before <= limit)).withColumn("too_big", over)
    return kept.withColumn("kind", F.when(over, "row").otherwise(F.col("kind"))).drop("_upto")


def without_row_deleted(cells: DataFrame, atoms: DataFrame) -> DataFrame:
    """Cells newer than their row's deletion, which comes along as ``deleted_at``."""
    return cells.join(row_deletes(atoms), KEY).where(F.col("ts") > F.col("deleted_at"))


def prepared(atoms: DataFrame, options: Options = Options()) -> DataFrame:
    atoms = grouped_source(atoms, options.trace_source)
    return atoms if options.max_row_bytes is None else within_size(atoms, options.max_row_bytes, options.name_type)


def cells(atoms: DataFrame, options: Options = Options()) -> DataFrame:
    """A row per surviving cell, with its row's ``deleted_at``."""
    atoms = prepared(atoms, options)
    return without_row_deleted(without_range_deleted(newest_cells(atoms), atoms, options.name_type), atoms)


def collect_rows(alive: DataFrame, deletes: DataFrame, order: Column | None = None) -> DataFrame:
    """ROW: all keys of ``deletes`` with their cells in order of name."""
    cell = F.struct(
        "name", "value", "ts",
        F.when(F.col("kind") == "live", F.lit(None).cast("string")).otherwise(F.col("kind")).alias("status"),
        F.col("ttl").cast("long").alias("ttl"),
        F.col("local_deletion_time").cast("long").alias("local_deletion_time"),
        "ts_last_delete", "size",
    )
    entry = F.struct((F.col("name") if order is None else order).alias("o"), cell.alias("c"))
    gathered = alive.groupBy(*KEY).agg(F.array_sort(F.collect_list(entry)).alias("_cells"))
    columns = F.transform(F.coalesce("_cells", F.expr("array()")), lambda x: x["c"])
    return deletes.join(gathered, KEY, "left").select(*KEY, "deleted_at", columns.alias("columns"))


def _uncovered(cells: Column, ranges: Column) -> Column:
    """Cells, in order, that no range covers.

    Blocks of cells are held against the ranges: of those that cover a whole
    block only the newest time counts, and the few that begin or end inside it
    are tried cell by cell.  So the work is ranges times blocks, not cells.
    """

    def in_block(k: Column) -> Column:
        places = F.sequence(k * BLOCK, F.least((k + 1) * BLOCK, F.size(cells)) - 1)

        def of(block: Column) -> Column:
            ends = F.struct(F.get(block, F.lit(0))["o"].alias("first"), F.element_at(block, -1)["o"].alias("last"))
            return let(ends, lambda e: left(block, e))

        def left(block: Column, e: Column) -> Column:
            whole = lambda r: (r["low"] <= e["first"]) & (e["last"] <= r["high"])
            near = F.filter(ranges, lambda r: (r["low"] <= e["last"]) & (e["first"] <= r["high"]))
            split = let(near, lambda n: F.struct(F.array_max(F.transform(F.filter(n, whole), lambda r: r["ts"])).alias("all"), F.filter(n, lambda r: ~whole(r)).alias("some")))
            return let(split, lambda s: F.filter(block, lambda x: ~(F.coalesce(x["ts"] <= s["all"], F.lit(False)) | F.exists(s["some"], lambda r: (r["ts"] >= x["ts"]) & (r["low"] <= x["o"]) & (x["o"] <= r["high"])))))

        return let(F.transform(places, lambda i: F.get(cells, i)), of)

    blocks = F.sequence(F.lit(0), F.floor((F.size(cells) - 1) / BLOCK).cast("int"))
    return F.when((F.size(ranges) == 0) | (F.size(cells) == 0), cells).otherwise(F.flatten(F.transform(blocks, in_block)))


def compact(atoms: DataFrame, options: Options = Options()) -> DataFrame:
    """One ROW per (row_key, source_path), its cells in the order of
    ``options.name_type``.

    Atoms are read once: the first aggregate leaves the newest cell of a name,
    the newest of equal range tombstones and the row marker, the second brings
    a row's together, and deletes are applied inside the row.  For rows too
    wide to stand in one place, :func:`cells` does the same by joins.
    """
    atoms, order = prepared(atoms, options), in_order_of(options.name_type)
    what = F.when(F.col("kind").isin(*CELLS), 0).when(F.col("kind") == RANGE, 1).otherwise(2)
    atoms = atoms.select(
        *KEY, "row_deleted_at", what.alias("what"),
        F.when(what < 2, F.col("name")).alias("name"),
        F.when(what == 1, F.col("range_max")).alias("range_max"),
        *[F.col(c) for c in ("ts", "kind", "value", "ttl", "local_deletion_time", "ts_last_delete", "size")],
    )
    best = F.max(F.struct("ts", "kind", "value", "ttl", "local_deletion_time", "ts_last_delete", "size")).alias("b")
    # Without tracing all paths are empty; rows are then dealt by their key alone, which the key order needs.
    keys = KEY if options.trace_source else ["row_key"]
    winners = atoms.groupBy(*keys, "what", "name", "range_max").agg(best, F.max("row_deleted_at").alias("deleted_at"))
    cell = F.struct(
        order(F.col("name")).alias("o"),
        "b.ts",
        F.struct(
            "name", "b.value", "b.ts",
            F.when(F.col("b.kind") != "live", F.col("b.kind")).alias("status"),
            F.col("b.ttl").cast("long").alias("ttl"),
            F.col("b.local_deletion_time").cast("long").alias("local_deletion_time"),
            "b.ts_last_delete", "b.size",
        ).alias("c"),
    )
    floor = F.lit(NOT_DELETED)
    range_ = F.struct(order(F.col("name")).alias("low"), order(F.col("range_max")).alias("high"), "b.ts")
    rows = winners.groupBy(*keys).agg(
        F.coalesce(F.greatest(F.max("deleted_at"), floor), floor).alias("deleted_at"),
        F.collect_list(F.when(F.col("what") == 0, cell)).alias("cells"),
        F.collect_list(F.when(F.col("what") == 1, range_)).alias("ranges"),
    )
    newer = F.array_sort(F.filter("cells", lambda x: x["ts"] > F.col("deleted_at")))
    alive = let(newer, lambda cells: _uncovered(cells, F.col("ranges")))
    path = F.col("source_path") if options.trace_source else F.lit("").alias("source_path")
    return rows.select("row_key", path, "deleted_at", F.transform(alive, lambda x: x["c"]).alias("columns"))


def counters(atoms: DataFrame, options: Options = Options()) -> DataFrame:
    """rows_written, rows_too_big and inputs_in_error, as one row, in one pass."""
    error = F.col("kind") == ERROR
    path = F.coalesce("source_path", F.lit("")) if options.trace_source else F.lit("")
    marked = atoms.withColumn("source_path", F.when(error, "\0").otherwise(path)).withColumn("_error", error.cast("int"))  # errors are a row of their own
    big = F.lit(0)
    if options.max_row_bytes is not None:
        marked, big = within_size(marked, options.max_row_bytes, options.name_type), F.col("too_big").cast("int")
    keys = marked.groupBy(*KEY).agg(F.max(big).alias("big"), F.sum("_error").alias("errors"))
    row = F.col("errors") == 0
    return keys.agg(
        F.count_if(row).alias("rows_written"), F.coalesce(F.sum(F.when(row, F.col("big"))), F.lit(0)).alias("rows_too_big"), F.coalesce(F.sum("errors"), F.lit(0)).alias("inputs_in_error")
    )


def require_allowed(errors: int, allowed: int = 0) -> int:
    if errors > allowed:
        raise RuntimeError(f"{errors} inputs could not be read; {allowed} are allowed")
    return errors


def check_errors(atoms: DataFrame, allowed: int = 0) -> int:
    """Raises if more inputs than ``allowed`` could not be read to their end."""
    return require_allowed(atoms.where(F.col("kind") == ERROR).count(), allowed)
