"""Driver tables read as mutations, to try the operators on.

``events`` is a mutation log: the user is the row key, the event type the cell
name.  With roles, ``signup`` deletes the row, ``error`` deletes the range
from click to purchase, and cells of small value are cell tombstones.
"""

from __future__ import annotations

import posixpath
import re
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decode import cell_size
from ..sources import layout
from ..sources.table_files import filesystem

TOMBSTONE_BELOW = 5.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(c: Column) -> Column:
    return c.cast("string").cast("binary")


def micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)


def mutations(events: DataFrame, roles: bool = True) -> DataFrame:
    """ATOMs of events; ``source_path`` is the day."""
    kind = F.lit("live")
    if roles:
        kind = (
            F.when(F.col("event_type") == "signup", "row")
            .when(F.col("event_type") == "error", "rt")
            .when(F.col("value") < TOMBSTONE_BELOW, "d")
            .otherwise("live")
        )
    atoms = events.select(
        text_bytes(F.col("user_id")).alias("row_key"),
        F.date_format("ts", "yyyy-MM-dd").alias("source_path"),
        kind.alias("kind"),
        text_bytes(F.col("event_type")).alias("event_name"),
        text_bytes(F.col("event_id")).alias("value"),
        micros(F.col("ts")).alias("us"),
    )
    is_cell = ~F.col("kind").isin("row", "rt")
    return atoms.select(
        "row_key", "source_path",
        F.when(F.col("kind") == "row", F.col("us")).alias("row_deleted_at"),
        "kind",
        F.when(F.col("kind") == "rt", F.lit("click").cast("binary")).when(is_cell, F.col("event_name")).alias("name"),
        F.when(is_cell, F.col("value")).alias("value"),
        F.when(F.col("kind") != "row", F.col("us")).alias("ts"),
        F.lit(None).cast("int").alias("ttl"), F.lit(None).cast("int").alias("local_deletion_time"), F.lit(None).cast("long").alias("ts_last_delete"),
        F.when(F.col("kind") == "rt", F.lit("purchase").cast("binary")).alias("range_max"),
        F.when(is_cell, cell_size(F.col("kind"), F.col("event_name"), F.col("value"))).when(F.col("kind") == "rt", F.lit(30)).otherwise(F.lit(0)).cast("long").alias("size"),
    )


def fixed_bytes(number: Column, width: int) -> Column:
    """Big-endian bytes of an integer."""
    return F.unhex(F.substring(F.lpad(F.hex(number.cast("long")), 16, "0"), 17 - 2 * width, 2 * width))


def composite(*parts: Column) -> Column:
    """(u16 length, bytes, 0)* of binary parts."""
    return F.concat(*[x for p in parts for x in (fixed_bytes(F.length(p), 2), p, F.unhex(F.lit("00")))])


ORDERS_DDL = (
    "CREATE TABLE shop.orders (o_custkey bigint, o_orderkey bigint, segment text STATIC, o_orderstatus text, o_orderpriority text, "
    "PRIMARY KEY (o_custkey, o_orderkey))"
)


def live_cells(rows: DataFrame, key: Column, name: Column, value: Column, ts: Column | None = None) -> DataFrame:
    return rows.select(
        key.alias("row_key"),
        F.lit("").alias("source_path"), F.lit(None).cast("long").alias("row_deleted_at"), F.lit("live").alias("kind"),
        name.alias("name"), value.alias("value"), (F.lit(1) if ts is None else ts).cast("long").alias("ts"),
        F.lit(None).cast("int").alias("ttl"), F.lit(None).cast("int").alias("local_deletion_time"), F.lit(None).cast("long").alias("ts_last_delete"),
        F.lit(None).cast("binary").alias("range_max"), cell_size(F.lit("live"), name, value).alias("size"),
    )


def order_atoms(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Cells as a table with ``ORDERS_DDL`` stores them; a customer's segment
    is static, named by a mark and an empty clustering part."""
    names = ("o_orderstatus", "o_orderpriority")
    cells = F.array(*[F.struct(F.lit(c).alias("c"), text_bytes(F.col(c)).alias("v")) for c in names])
    rows = orders.select("o_custkey", "o_orderkey", F.explode(cells).alias("x"))
    regular = live_cells(rows, fixed_bytes(F.col("o_custkey"), 8), composite(fixed_bytes(F.col("o_orderkey"), 8), text_bytes(F.col("x.c"))), F.col("x.v"))
    empty = F.unhex(F.lit(""))
    name = F.concat(F.unhex(F.lit("FFFF")), composite(empty, text_bytes(F.lit("segment"))))
    return regular.unionByName(live_cells(customers, fixed_bytes(F.col("c_custkey"), 8), name, text_bytes(F.col("c_mktsegment"))))


def event_row_atoms(events: DataFrame) -> DataFrame:
    """Cells as a table of a row per user and a column per event type stores them."""
    return live_cells(events, fixed_bytes(F.col("user_id"), 8), composite(text_bytes(F.col("event_type"))), fixed_bytes(F.col("event_id"), 8), micros(F.col("ts")))


EVENTS_DDL = "CREATE TABLE shop.events (user_id bigint PRIMARY KEY, click bigint, error bigint, purchase bigint, signup bigint, view bigint)"


def bounded_atoms(orders: DataFrame, customers: DataFrame, name: Column, low: Column, high: Column) -> DataFrame:
    """Orders as cells of their customers' rows, written at the order's number, and
    a range tombstone in each row at 40 times the customer's."""
    cells = live_cells(orders, text_bytes(F.col("o_custkey")), name, text_bytes(F.col("o_orderkey")), F.col("o_orderkey"))
    ranges = live_cells(customers, text_bytes(F.col("c_custkey")), low, F.lit(None).cast("binary"), F.col("c_custkey") * 40)
    return cells.unionByName(ranges.withColumns({"kind": F.lit("rt"), "range_max": high}))


# ------------------------------------------------------------------ files to try sources on


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder in the one that all executors share; on a local master any will do."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='sedimenta-')}"
    return f"{re.sub(r'^file:/+', 'file:///', folder).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _put(path: str, data: bytes) -> None:
    store, inner = filesystem(path)
    store.create_dir(posixpath.dirname(inner), recursive=True)
    with store.open_output_stream(inner) as f:
        f.write(data)


def write_files(files: DataFrame, folder: str, snappy: bool = False) -> int:
    """Writes (name, data) below ``folder``, as snappy streams if asked."""

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["name"], batch["data"], strict=True):
                _put(f"{folder}/{name}", layout.encode_snappy(bytes(data), 64) if snappy else bytes(data))
            yield batch[["name"]]

    return files.mapInPandas(put, "name string").count()


def nation_files(nations: DataFrame) -> DataFrame:
    """(name, data): a data file per nation in its region's folder, empty for each
    seventh, with an index, a secondary index and files that are hidden."""
    folder, stem, text = F.concat(F.lit("r="), F.col("n_regionkey"), F.lit("/")), F.concat(F.lit("n-"), F.col("n_nationkey")), F.col("n_name")
    each = [("", "-jb-1-Data.db", F.when(F.col("n_nationkey") % 7 == 0, "").otherwise(text)), ("", "-jb-1-Index.db", F.concat(F.lit("i"), F.col("n_nationkey"))),
            ("", ".idx-jb-2-Data.db", text), (".", "-jb-1-Data.db", text), ("_", "-jb-1-Data.db", text)]
    made = F.array(*[F.struct(F.concat(folder, F.lit(head), stem, F.lit(tail)).alias("name"), text_bytes(data).alias("data")) for head, tail, data in each])
    return nations.select(F.inline(made))


CODECS = (None, "SnappyCompressor", "LZ4Compressor", "org.x.DeflateCompressor")


def write_packed(rows: DataFrame, folder: str, minute: bool = False) -> int:
    """Table files of ROWs as a store leaves them: in both layouts, by every codec
    and by none, in small chunks, with an index, beside an empty file.  With
    ``minute`` the chunk maps stand in the folder of the next minute."""

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = TaskContext.get().partitionId()
        codec, version = CODECS[k % 4], ("ic", "jb")[k // 4 % 2]
        parts, entries, at, n = [], [], 0, 0
        for batch in batches:
            for key, deleted, columns in zip(batch["row_key"], batch["deleted_at"], batch["columns"], strict=True):
                whole = lambda x: None if x is None or x != x else int(x)
                cells = [
                    {"name": bytes(c["name"]), "value": bytes(c["value"] or b""), "ts": c["ts"], "kind": c["status"] or "live"} | {x: whole(c[x]) for x in ("ttl", "local_deletion_time", "ts_last_delete")}
                    for c in columns
                ]
                entries.append((bytes(key), at))
                parts.append(layout.row_bytes(bytes(key), int(deleted), cells, version))
                at += len(parts[-1])
                n += 1
        place = f"{folder}/1412000000000/201410061530" if minute else folder
        base, data = f"{place}/ks-t-{version}-{k}", b"".join(parts)
        _put(f"{base}-Index.db", layout.index_bytes(entries))
        if codec:
            data, info = layout.compressed_file(data, codec, 256)
            _put(f"{base.replace('201410061530', '201410061531')}-CompressionInfo.db", layout.compression_bytes(info))
        _put(f"{base}-Data.db", data)
        _put(f"{place}/ks-e-{version}-{k}-Data.db", b"")
        yield pd.DataFrame({"n": [n]})

    dealt = rows.select("row_key", "deleted_at", "columns").repartition(8, "row_key")
    return dealt.mapInPandas(put, "n long").agg(F.sum("n")).first()[0]
