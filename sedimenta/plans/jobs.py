"""Whole jobs: snapshot of table files, typed export, copy of files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.ddl import parse_create
from ..functions.decode import signed_order
from ..model import ERROR
from ..operators.compact import Options, compact, require_allowed
from ..operators.typed_rows import as_schema, typed_rows, write_rows
from ..sources import listing
from ..sources.copy_files import MOST_TASKS, copy_files
from ..sources.json_snapshot import to_lines
from ..sources.table_files import read_tables, write_tables


@dataclass(frozen=True)
class SnapshotJob:
    """Settings of a snapshot; the defaults keep everything as bytes."""

    key_type: str = "BytesType"
    name_type: str = "BytesType"
    value_type: str = "BytesType"
    create_table: str | None = None  # sets key_type and name_type
    sink: str = "json"  # or tables
    version: str = "jb"
    dataset: str = "keyspace-dataset"
    combine: bool = False
    max_combined: int = 200
    block_size: int | None = None
    trace_source: bool = False
    legacy_names: bool = False
    sort_by_name: bool = False
    max_row_bytes: int | None = None
    allowed_errors: int = 0
    mode: str = "append"

    def types(self) -> tuple[str, str]:
        if self.create_table:
            table = parse_create(self.create_table)
            return table.key_type, table.comparator
        return self.key_type, self.name_type


def in_key_order(rows: DataFrame, by_key: bool = False) -> DataFrame:
    """Partitions by key, sorted by its bytes as signed numbers; ``by_key`` rows
    are dealt by their key already, as :func:`compact` leaves them without tracing."""
    return (rows if by_key else rows.repartition("row_key")).sortWithinPartitions(signed_order(F.col("row_key")), "source_path")


def snapshot(spark: SparkSession, paths: str | list[str], output: str, job: SnapshotJob = SnapshotJob()) -> dict:
    """Compacts table files into ``output`` and returns the counters.

    Unreadable inputs are counted as they are read, in the one pass over the
    input, and fail the job after the output is written if they are more than
    it allows.
    """
    options = {"combine": job.combine, "maxcombined": job.max_combined} | ({"blocksize": job.block_size} if job.block_size else {})
    key_type, name_type = job.types()
    read, seen = Observation(), Observation()
    atoms = read_tables(spark, paths, **options).observe(read, F.count_if(F.col("kind") == ERROR).alias("inputs_in_error"))
    rows = in_key_order(compact(atoms, Options(job.trace_source, job.max_row_bytes, name_type)), not job.trace_source)
    if job.sink == "tables":
        counted = rows.observe(seen, F.count("*").alias("rows_written"), F.lit(0).alias("rows_too_big"))
        write_tables(counted, output, job.mode, version=job.version, dataset=job.dataset)
    else:
        lines = to_lines(rows, key_type, name_type, job.value_type, job.trace_source, job.legacy_names, job.sort_by_name, job.max_row_bytes)
        counted = lines.observe(seen, F.count("*").alias("rows_written"), F.count_if("too_big").alias("rows_too_big"))
        counted.select("line").write.mode("errorifexists" if job.mode == "append" else job.mode).text(output)
    return dict(seen.get) | {"inputs_in_error": require_allowed(read.get["inputs_in_error"], job.allowed_errors)}


def export(spark: SparkSession, paths: str | list[str], create_table: str, output: str, avro_schema: str | None = None, mode: str = "errorifexists", now: int | None = None) -> str:
    """Typed rows of one format version's files, without merging them; files of
    several versions are refused before any is read."""
    listing.require_one_version(listing.data_files(spark, paths)).count()
    rows = typed_rows(read_tables(spark, paths), parse_create(create_table), now)
    return write_rows(as_schema(rows, avro_schema) if avro_schema else rows, output, mode)


def copy(
    spark: SparkSession, target: str, inputs: str | list[str] | None = None, manifest: str | None = None, base: str | None = None,
    unsnap: bool = False, overwrite: bool = False, skip_indexes: bool = True, tasks: int = MOST_TASKS,
) -> dict:
    """Copies the files below ``inputs``, or those that ``manifest`` names, and
    returns their number and bytes; exactly one of the two must be given."""
    if (inputs is None) == (manifest is None):
        raise ValueError("give either a manifest or input files")
    files = listing.read_manifest(spark, manifest) if manifest else listing.listing(spark, inputs).select("path")
    if skip_indexes:
        files = listing.without_secondary_indexes(files)
    done = copy_files(files, target, base, unsnap, overwrite, tasks)
    row = done.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return row.asDict()
