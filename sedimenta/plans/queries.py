"""A query per operator over the driver's tables; SQL twins are in ``sql``."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import decode as D
from ..functions import paths as P
from ..functions.ddl import parse_create, require_exportable
from ..model import ATOM
from ..operators import compact as C
from ..operators.typed_rows import as_schema, typed_rows
from ..sources import json_snapshot as J
from ..sources import listing as L
from ..sources.table_files import read_tables, write_tables
from ..streaming.incremental import IncrementalCompactor
from . import adapters as A
from . import jobs

ROW_LIMIT = 1500
LINE_LIMIT = 100


def _user() -> Column:
    return F.col("row_key").cast("string").cast("long").alias("user_id")


def _name() -> Column:
    return F.col("name").cast("string").alias("event_type")


def _event() -> Column:
    return F.col("value").cast("string").cast("long").alias("event_id")


def _atoms(spark, sf_dir, roles=True, trace=False) -> DataFrame:
    return C.grouped_source(A.mutations(A.read(spark, sf_dir, "events"), roles), trace)


def _shown(columns="columns") -> Column:
    """Cells as ``name=value`` in order."""
    return F.array_join(F.transform(columns, lambda c: F.concat(c["name"].cast("string"), F.lit("="), c["value"].cast("string"), F.coalesce(F.concat(F.lit(":"), c["status"]), F.lit("")))), "|")


def q01_lww(spark, sf_dir):
    return C.newest_cells(_atoms(spark, sf_dir, False)).select(_user(), _name(), _event(), F.col("ts").alias("us"))


def q02_row_delete_marker(spark, sf_dir):
    return C.row_deletes(_atoms(spark, sf_dir)).select(_user(), "deleted_at")


def q03_row_tombstone(spark, sf_dir):
    atoms = _atoms(spark, sf_dir)
    return C.without_row_deleted(C.newest_cells(atoms), atoms).select(_user(), _name(), _event())


def q04_range_tombstone(spark, sf_dir):
    atoms = _atoms(spark, sf_dir)
    return C.without_range_deleted(C.newest_cells(atoms), atoms).select(_user(), _name(), _event())


def q05_keep_cell_tombstones(spark, sf_dir):
    return C.cells(_atoms(spark, sf_dir)).groupBy("kind").agg(F.count("*").alias("n_cells"))


def q06_empty_row_kept(spark, sf_dir):
    return C.compact(_atoms(spark, sf_dir)).select(_user(), F.size("columns").cast("long").alias("n_cells"))


def q07_ordered_cells(spark, sf_dir):
    return C.compact(_atoms(spark, sf_dir, False)).select(_user(), _shown().alias("cells"))


def q08_trace_source(spark, sf_dir):
    rows = C.compact(A.mutations(A.read(spark, sf_dir, "events")), C.Options(trace_source=True))
    return rows.select(_user(), F.col("source_path").alias("day"), "deleted_at", _shown().alias("cells"))


def q09_size_limit(spark, sf_dir):
    rows = C.within_size(_atoms(spark, sf_dir), ROW_LIMIT)
    return rows.groupBy("row_key").agg(
        F.count_if(~F.col("too_big")).alias("n_atoms"), F.sum(F.when(~F.col("too_big"), F.col("size")).otherwise(0)).alias("bytes"), F.max(F.col("too_big").cast("int")).cast("long").alias("too_big")
    ).select(_user(), "n_atoms", "bytes", "too_big")


def q10_compact(spark, sf_dir):
    rows = C.compact(A.mutations(A.read(spark, sf_dir, "events")))
    return rows.select(_user(), "deleted_at", F.size("columns").cast("long").alias("n_cells"), _shown().alias("cells"))


def q11_too_large_row(spark, sf_dir):
    rows = C.compact(A.mutations(A.read(spark, sf_dir, "events")))
    return J.to_lines(rows, key_type="UTF8Type", name_type="UTF8Type", value_type="UTF8Type", max_row_bytes=LINE_LIMIT)


def q12_union_inputs(spark, sf_dir):
    events = A.read(spark, sf_dir, "events")
    halves = [A.mutations(events.where(F.col("event_id") % 2 == k), False) for k in (0, 1)]
    both = halves[0].unionByName(halves[1], allowMissingColumns=True)
    return C.newest_cells_by_window(C.grouped_source(both, False)).select(_user(), _name(), _event())


def _loaded(spark, sf_dir) -> DataFrame:
    """Snapshot lines, parsed again, of rows whose deletes are not applied."""
    atoms = _atoms(spark, sf_dir)
    rows = C.collect_rows(C.newest_cells(atoms), C.row_deletes(atoms))
    lines = J.to_lines(rows, key_type="UTF8Type", name_type="UTF8Type", value_type="UTF8Type").select(F.col("line").alias("value"))
    return J.parse_lines(lines)


def q13_cleanse(spark, sf_dir):
    rows = J.cleanse(_loaded(spark, sf_dir))
    return rows.select(F.col("key").cast("long").alias("user_id"), F.array_join(F.transform("columns", lambda c: c["name"]), ",").alias("names"))


def q14_loader_projection(spark, sf_dir):
    rows = J.as_loaded(_loaded(spark, sf_dir))
    cell = lambda n: F.try_element_at("map_columns", F.lit(n))
    return rows.select(F.col("key").cast("long").alias("user_id"), "deletedat", cell("click")["value"].cast("long").alias("click"), cell("view")["ts"].alias("view_ts"), cell("purchase")["status"].alias("purchase_status"))


def q15_cql_rows(spark, sf_dir):
    return typed_rows(A.event_row_atoms(A.read(spark, sf_dir, "events")), parse_create(A.EVENTS_DDL))


def q16_static_columns(spark, sf_dir):
    return q28_typed_rows(spark, sf_dir).select("o_custkey", F.col("segment").alias("c_mktsegment"), "o_orderkey", "o_orderpriority")


def q17_hex_key(spark, sf_dir):
    return A.read(spark, sf_dir, "customer").select("c_custkey", D.as_hex(A.text_bytes(F.col("c_name"))).alias("hex_key"))


def q18_legacy_name(spark, sf_dir):
    name = F.concat_ws("", "p_brand", F.lit("\t\""), "p_type", F.lit("\\\n"), F.lit("\x01"), "p_name")
    return A.read(spark, sf_dir, "part").select("p_partkey", D.legacy_name(name).alias("legacy"))


def q19_cast_int_long(spark, sf_dir):
    text, four, eight = F.hex(F.col("o_custkey").cast("string")), F.hex(A.fixed_bytes(F.col("o_orderkey") * -7919, 4)), F.hex(A.fixed_bytes(F.col("o_orderkey") * -7919, 8))
    return A.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        D.hex_to_text(text).alias("as_text"), D.hex_to_int(text).alias("as_int"), D.hex_to_long(text).alias("as_long"),
        D.hex_to_int(four).alias("four_int"), D.hex_to_long(eight).alias("eight_long"), D.hex_to_int(eight).alias("eight_int"), D.hex_to_long(F.lit("")).alias("nothing"),
    )


def q20_signed_key_order(spark, sf_dir):
    keyed = A.read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.unhex(F.substring(F.md5("c_name"), 1, 8)).alias("k"))
    rank = F.row_number().over(Window.partitionBy("c_nationkey").orderBy(D.signed_order(F.col("k")), "c_custkey"))
    return keyed.select("c_custkey", rank.cast("long").alias("place"))


def q21_latest_batch(spark, sf_dir):
    days = A.read(spark, sf_dir, "events").select(F.concat(F.lit("/in/batch_id="), F.date_format("ts", "yyyyMMdd")).alias("path")).distinct()
    return L.latest_batch(days)


def q22_secondary_index_filter(spark, sf_dir):
    pages = A.read(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    return L.without_secondary_indexes(pages)


def q23_distinct_globs(spark, sf_dir):
    return L.input_globs(A.read(spark, sf_dir, "pages").select(F.col("url").alias("path")))


def q24_counters(spark, sf_dir):
    return C.counters(A.mutations(A.read(spark, sf_dir, "events")), C.Options(max_row_bytes=ROW_LIMIT))


def q25_version_homogeneity(spark, sf_dir):
    files = A.read(spark, sf_dir, "orders").select(F.concat(F.lit("/in/t-"), F.when(F.col("o_orderkey") % 2 == 0, "jb").otherwise("ic"), F.lit("-"), "o_orderkey", F.lit("-Data.db")).alias("path"))
    one = L.require_one_version(files.where(P.format_version(F.col("path")) == "jb"))
    refused = _refused(lambda: L.require_one_version(files).count(), "several format versions")
    return one.groupBy(P.format_version(F.col("path")).alias("version")).agg(F.count("*").alias("files"), F.lit(refused).alias("two_refused"))


def q26_partition_info(spark, sf_dir):
    paths = A.read(spark, sf_dir, "orders").select(
        F.concat(F.lit("/w/priority="), F.substring("o_orderpriority", 1, 1), F.lit("/p-"), F.col("o_orderkey") % 10, F.lit("-Data.db")).alias("path"), F.col("o_orderkey").alias("length")
    )
    found = L.partition_info(L.filtered(paths, P.is_data_file, lambda p: ~P.is_hidden(p)))
    return found.groupBy("partition", "location").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def q27_json_round_trip(spark, sf_dir):
    rows = C.compact(A.mutations(A.read(spark, sf_dir, "events")))
    lines = J.to_lines(rows).select(F.col("line").alias("value"))
    back = J.parse_lines(lines)
    text = lambda h: D.hex_to_text(h)
    return back.select(text(F.col("key")).cast("long").alias("user_id"), F.col("deletedat").alias("deleted_at"), F.explode_outer("columns").alias("c")).select(
        "user_id", "deleted_at", text(F.col("c.name")).alias("event_type"), D.hex_to_long(F.col("c.value")).alias("event_id"), F.col("c.ts").alias("us"), "c.status"
    )


def q28_typed_rows(spark, sf_dir):
    atoms = A.order_atoms(A.read(spark, sf_dir, "orders"), A.read(spark, sf_dir, "customer"))
    return typed_rows(atoms, parse_create(A.ORDERS_DDL))


def q29_uuid_text(spark, sf_dir):
    return A.read(spark, sf_dir, "supplier").select("s_suppkey", D.uuid_text(F.unhex(F.md5("s_name"))).alias("id"), D.varint(A.fixed_bytes(F.col("s_suppkey") * -99991, 8)).cast("long").alias("number"))


def q30_table_files(spark, sf_dir):
    """q10 by way of table files: cells are written, read and compacted again."""
    path = A.shared_path(spark, "tables")
    rows = C.compact(A.mutations(A.read(spark, sf_dir, "events")))
    write_tables(rows, path)
    back = C.compact(read_tables(spark, path, combine=True))
    return back.select(_user(), "deleted_at", F.size("columns").cast("long").alias("n_cells"), _shown().alias("cells"))


def q31_cells(spark, sf_dir):
    return C.cells(A.mutations(A.read(spark, sf_dir, "events"))).select(_user(), _name(), _event(), "deleted_at")


def q32_library_lines(spark, sf_dir):
    rows = J.cleanse(_loaded(spark, sf_dir))
    return J.to_library_lines(rows)


def _refused(act, message: str) -> bool:
    """Whether ``act`` fails and says so."""
    try:
        act()
    except Exception as e:  # noqa: BLE001 - whatever the engine wraps it in
        return message in str(e)
    return False


def _rows_shown(rows: DataFrame) -> DataFrame:
    return rows.select(_user(), "deleted_at", F.size("columns").cast("long").alias("n_cells"), _shown().alias("cells"))


def _local(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)


def _below(files: DataFrame, folder: str) -> DataFrame:
    """``files`` with their paths relative to a folder."""
    return files.withColumn("path", P.relative(F.regexp_replace("path", r"^file:/+", "/"), _local(folder)))


def q33_packed_files(spark, sf_dir):
    """Files of both layouts and all codecs, cut into small splits by their index."""
    folder = A.shared_path(spark, "packed")
    A.write_packed(C.compact(A.mutations(A.read(spark, sf_dir, "events"))), folder)
    return _rows_shown(C.compact(read_tables(spark, [folder], blocksize=2048)))


def q34_packed_by_minute(spark, sf_dir):
    """Chunk maps in the folder of the minute beside; splits combined."""
    folder = A.shared_path(spark, "minutes")
    A.write_packed(C.compact(A.mutations(A.read(spark, sf_dir, "events"))), folder, minute=True)
    return _rows_shown(C.compact(read_tables(spark, folder, combine=True, blocksize=8192, maxcombined=3)))


def _nation_folder(spark, sf_dir) -> str:
    folder = A.shared_path(spark, "nations")
    A.write_files(A.nation_files(A.read(spark, sf_dir, "nation")), folder)
    return folder


def q35_directory_walk(spark, sf_dir):
    folder = _nation_folder(spark, sf_dir)
    return _below(L.without_secondary_indexes(L.data_files(spark, folder)), folder).select("path", "length")


def q36_first_file(spark, sf_dir):
    folder = _nation_folder(spark, sf_dir)
    return _below(L.first_only(L.listing(spark, folder)), folder).select("path", "length")


def q37_manifest(spark, sf_dir):
    path = A.shared_path(spark, "manifest")
    urls = A.read(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    L.write_manifest(urls.unionByName(urls), path)
    return L.read_manifest(spark, path)


def q38_copy(spark, sf_dir):
    """A tree copied below its base; again over itself; a copy onto it is refused."""
    folder, target = _nation_folder(spark, sf_dir), A.shared_path(spark, "copied")
    jobs.copy(spark, target, folder, base=_local(folder), tasks=3)
    refused = _refused(lambda: jobs.copy(spark, target, folder, base=_local(folder)), "Data.db")
    jobs.copy(spark, target, folder, base=_local(folder), overwrite=True)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(target)
    return _below(files, target).select("path", "length", F.col("content").cast("string").alias("text"), F.lit(refused).alias("again_refused"))


def q39_copy_snappy(spark, sf_dir):
    """Snappy streams of a manifest, decoded as they are copied."""
    folder, target, manifest = (A.shared_path(spark, x) for x in ("packed", "plain", "manifest"))
    nations = A.read(spark, sf_dir, "nation")
    A.write_files(nations.select(F.concat(F.lit("n-"), "n_nationkey").alias("name"), A.text_bytes(F.repeat("n_name", 100)).alias("data")), folder, snappy=True)
    L.write_manifest(L.listing(spark, folder), manifest)
    jobs.copy(spark, target, manifest=manifest, unsnap=True)
    return _below(spark.read.format("binaryFile").load(target), target).select("path", "length", F.md5("content").alias("digest"))


def q40_manifest_or_inputs(spark, sf_dir):
    refused = [_refused(lambda: jobs.copy(spark, "/nowhere", **given), "either a manifest or input files") for given in ({}, {"inputs": "/a", "manifest": "/b"})]
    return spark.range(1).select(F.lit(refused[0]).alias("none_refused"), F.lit(refused[1]).alias("both_refused"))


def q41_comparator_order(spark, sf_dir):
    """Places by typed order: reversed integers, decimals of several scales, composites."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    names = {
        "int_place": (A.fixed_bytes((cust * 7919) % 1000 - 500, 4), "ReversedType(Int32Type)"),
        "decimal_place": (F.concat(A.fixed_bytes(key % 3, 4), A.fixed_bytes(key % 400 - 200, 2)), "DecimalType"),
        "composite_place": (A.composite(A.fixed_bytes(cust % 50 - 25, 8), A.text_bytes(F.col("o_orderstatus"))), "org.x.CompositeType(org.x.LongType,org.x.ReversedType(UTF8Type))"),
    }
    orders = A.read(spark, sf_dir, "orders").select("*", *[D.sort_value(b, kind).alias(f"_{name}") for name, (b, kind) in names.items()])
    place = lambda c: F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(f"_{c}", "o_orderkey")).cast("long").alias(c)
    return orders.select("o_orderkey", *[place(c) for c in names])


def q42_rendered_order(spark, sf_dir):
    """Cells of integer names: in the order of numbers, and of the text they show as."""
    parts = A.read(spark, sf_dir, "part")
    atoms = A.live_cells(parts, A.text_bytes(F.col("p_brand")), A.fixed_bytes(F.col("p_partkey"), 4), A.text_bytes(F.col("p_size")))
    rows = C.compact(atoms, C.Options(name_type="Int32Type"))
    lines = lambda by_name: J.parse_lines(J.to_lines(rows, "UTF8Type", "Int32Type", "UTF8Type", legacy_names=by_name, sort_by_name=by_name).select(F.col("line").alias("value")))
    shown = lambda name: F.array_join(F.transform("columns", lambda c: c["name"]), ",").alias(name)
    return lines(False).select("key", shown("by_number")).join(lines(True).select("key", shown("by_text")), "key")


def q43_float_casts(spark, sf_dir):
    bits = lambda kind, c: F.java_method(F.lit(f"java.lang.{kind[0]}"), F.lit(kind[1]), c).cast("long")
    eight = F.hex(A.fixed_bytes(bits(("Double", "doubleToLongBits"), F.col("c_acctbal")), 8))
    four = F.hex(A.fixed_bytes(bits(("Float", "floatToIntBits"), F.col("c_acctbal").cast("float")), 4))
    return A.read(spark, sf_dir, "customer").select(
        "c_custkey", D.cast_hex(eight, "double").alias("eight_double"), D.cast_hex(four, "double").alias("four_double"), D.cast_hex(four, "float").cast("double").alias("four_float"),
        D.cast_hex(eight, "float").cast("double").alias("eight_float"), D.cast_hex(F.lit(""), "double").alias("nothing"),
    )


def q44_typed_values(spark, sf_dir):
    """Times, blobs, decimals, and integers of more than 15 bytes, by type."""
    millis = F.floor(A.micros(F.col("o_orderdate")) / 1000)
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    large = lambda n: F.concat(A.fixed_bytes(n, 8), F.unhex(F.lit("0000000000000000")))
    return A.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        D.value_of(A.fixed_bytes(millis, 8), "TimestampType").alias("millis"),
        D.as_hex(D.value_of(A.text_bytes(F.col("o_orderstatus")), "BytesType")).alias("blob"),
        D.value_of(F.concat(A.fixed_bytes(F.lit(2), 4), A.fixed_bytes(cents, 8)), "DecimalType").alias("price"),
        D.render(F.concat(A.fixed_bytes(F.lit(-3), 4), A.fixed_bytes(-F.col("o_custkey"), 8)), "org.x.DecimalType").alias("thousands"),
        D.value_of(large(F.col("o_orderkey")), "IntegerType").alias("large"),
        D.value_of(large(-F.col("o_orderkey")), "IntegerType").alias("large_negative"),
    )


def q45_paths(spark, sf_dir):
    escaped = F.concat(F.lit("/base/x%20y+z/"), "page_id", F.lit("/f"))
    return A.read(spark, sf_dir, "pages").select(
        "page_id", P.old_s3(F.concat(F.lit("s3://b/"), "url")).alias("old"), P.old_s3(F.concat(F.lit("h/s3://"), "url")).alias("kept"),
        P.relative(escaped, "/base").alias("below"), P.relative(F.concat(F.lit("/other/"), "page_id"), "/base").alias("outside"), P.parent(escaped).alias("folder"), P.file_name(escaped).alias("name"),
    )


def q46_key_branch(spark, sf_dir):
    """Keys by branch: all in range, and equal keys together."""
    keys = A.read(spark, sf_dir, "orders").select("o_custkey", D.key_branch(A.text_bytes(F.col("o_custkey")), 7).alias("branch"))
    return keys.groupBy("o_custkey").agg(F.count_distinct("branch").alias("branches"), F.min(F.col("branch").between(0, 6)).alias("in_range"))


STATEMENTS = (
    "CREATE TABLE ks.one (k uuid PRIMARY KEY, v blob) WITH COMPACT STORAGE",
    'CREATE TABLE ks."Two" (a int, b text, c bigint, v text, PRIMARY KEY ((a, b), c)) WITH CLUSTERING ORDER BY (c DESC)',
    "CREATE TABLE ks.three (k int PRIMARY KEY, v map<text, int>)",
    "CREATE TABLE ks.four (k timeuuid, c timestamp, s text STATIC, v decimal, PRIMARY KEY (k, c))",
)


def q47_ddl(spark, sf_dir):
    """Key type, comparator and whether rows can be exported, by statement."""
    tables = [parse_create(s) for s in STATEMENTS]
    rows = [(t.name, t.key_type, t.comparator, ",".join(t.regular), ",".join(t.static), not (_refused(lambda: require_exportable(t), "cannot be exported") or _refused(lambda: require_exportable(t), "is a collection"))) for t in tables]
    return spark.createDataFrame(rows, "name string, key_type string, comparator string, regular string, static string, exportable boolean")


ORDER_SCHEMA = json.dumps({"type": "record", "name": "order", "fields": [
    {"name": "o_custkey", "type": "long"}, {"name": "o_orderkey", "type": ["null", "long"]}, {"name": "segment", "type": ["null", "string"]}, {"name": "o_orderstatus", "type": "string"},
]})


def q48_export_job(spark, sf_dir):
    """Table files exported as rows of an Avro schema, in the sink's format, and read again."""
    tables, out = A.shared_path(spark, "tables"), A.shared_path(spark, "rows")
    write_tables(C.compact(A.order_atoms(A.read(spark, sf_dir, "orders"), A.read(spark, sf_dir, "customer"))), tables)
    kind = jobs.export(spark, tables, A.ORDERS_DDL, out, ORDER_SCHEMA)
    nested = '{"type":"record","name":"r","fields":[{"name":"x","type":{"type":"array","items":"int"}}]}'
    refused = _refused(lambda: as_schema(spark.range(1), nested), "field x of type array")
    return spark.read.format(kind).load(out).withColumn("nested_refused", F.lit(refused))


def q49_snapshot_job(spark, sf_dir):
    """Counters of a snapshot of table files, what is left in the sink, and refusals."""
    tables, out = A.shared_path(spark, "tables"), A.shared_path(spark, "again")
    write_tables(C.compact(A.mutations(A.read(spark, sf_dir, "events"))), tables)
    write_tables(C.compact(A.mutations(A.read(spark, sf_dir, "events"))), tables, "overwrite")
    job = jobs.SnapshotJob(key_type="UTF8Type", name_type="UTF8Type", value_type="UTF8Type", max_row_bytes=ROW_LIMIT)
    told = jobs.snapshot(spark, tables, out, job)
    refused = _refused(lambda: write_tables(read_rows(spark, tables), tables), tables.split("/")[-1]) and _refused(lambda: jobs.snapshot(spark, tables, out, job), "")
    left = [f for f in _names(tables) if not f.endswith("-Data.db")]
    lines = spark.read.text(out)
    return lines.agg(F.count("*").alias("lines")).select("lines", *[F.lit(v).cast("long").alias(k) for k, v in told.items()], F.lit(refused).alias("refused"), F.lit(len(left)).cast("long").alias("left_over"))


def read_rows(spark, tables: str) -> DataFrame:
    return C.compact(read_tables(spark, tables))


def _names(folder: str) -> list[str]:
    import pyarrow.fs as pafs

    from ..sources.table_files import filesystem

    store, inner = filesystem(folder)
    return [f.path for f in store.get_file_info(pafs.FileSelector(inner, recursive=True))]


def q50_key_order(spark, sf_dir):
    """Snapshot rows that stand before a smaller key of their partition: none."""
    rows = jobs.in_key_order(C.compact(A.mutations(A.read(spark, sf_dir, "events"))), True)
    placed = rows.select("row_key", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    order = D.signed_order(F.col("row_key"))
    before = F.lag(order).over(Window.partitionBy("part").orderBy("at"))
    return placed.select((before > order).alias("wrong")).agg(F.count_if("wrong").alias("out_of_order"), F.count("*").alias("n_rows"))


def q51_typed_ranges(spark, sf_dir):
    """Range tombstones over integer and composite names, by each way of compaction."""
    orders, customers = A.read(spark, sf_dir, "orders"), A.read(spark, sf_dir, "customer")
    number = F.col("o_orderkey") % 200 - 100
    four = lambda n: A.fixed_bytes(n, 4)
    bound = lambda n, end: F.concat(A.fixed_bytes(F.lit(4), 2), four(F.lit(n)), F.unhex(F.lit(end)))
    cases = {
        "int": ("Int32Type", four(number), four(F.lit(-20)), four(F.lit(30))),
        # The bounds stand before and after all names that begin with their number.
        "composite": ("CompositeType(Int32Type,UTF8Type)", A.composite(four(number), A.text_bytes(F.concat(F.lit("v"), F.col("o_orderkey") % 7))), bound(-20, "FF"), bound(30, "01")),
    }
    out = None
    for case, (kind, name, low, high) in cases.items():
        atoms = A.bounded_atoms(orders, customers, name, low, high)
        cell = F.substring(F.col("name"), 1, 4) if case == "int" else F.substring(F.col("name"), 3, 4)
        rows = C.compact(atoms, C.Options(name_type=kind)).select("row_key", F.explode("columns.name").alias("name"), F.lit("rows").alias("way"))
        for got in (rows, C.cells(atoms, C.Options(name_type=kind)).select("row_key", "name", F.lit("cells").alias("way"))):
            shown = got.groupBy("row_key", "way").agg(F.count("*").alias("n_cells"), F.sum(D.signed(cell, 4)).alias("total"))
            shown = shown.select(F.col("row_key").cast("string").cast("long").alias("c_custkey"), F.lit(case).alias("names"), "way", "n_cells", "total")
            out = shown if out is None else out.unionByName(shown)
    return out


def q52_stream(spark, sf_dir):
    """Mutations that arrive in micro-batches end as one compaction does."""
    source, state, check = (A.shared_path(spark, x) for x in ("arrivals", "state", "progress"))
    A.mutations(A.read(spark, sf_dir, "events")).repartition(3, "value").write.parquet(source)
    job = IncrementalCompactor(spark, state)
    stream = spark.readStream.schema(ATOM).option("maxFilesPerTrigger", 1).parquet(source)
    job.start(stream, check).awaitTermination()
    return _rows_shown(job.snapshot())


def q53_refused_casts(spark, sf_dir):
    kinds = ("bag", "map", "tuple", "boolean", "datetime")
    row = spark.range(1).select(F.lit("00").alias("x"))
    refused = [_refused(lambda: row.select(D.cast_hex(F.col("x"), k)).collect(), f"no cast to {k}") for k in kinds]
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(r).alias("refused")) for k, r in zip(kinds, refused, strict=True)])))


QUERIES = {name: f for name, f in sorted(globals().items()) if name[0] == "q" and name[1:3].isdigit()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q10_compact(spark, sf_dir)
