"""JSON snapshots: one line per row, ``key TAB [source TAB] {json}``.

Lines are parsed by ``from_json`` and assembled by string expressions, since a
cell is an array of mixed types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bind import let
from ..functions.decode import legacy_name, render, too_large_message

LINE = "map<string,struct<deletedAt:bigint,columns:array<array<string>>>>"
LOADED_CELL = "struct<name:string,value:string,ts:bigint,status:string,ttl:bigint,local_deletion_time:bigint>"


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """(key, source, deletedat, columns) of snapshot lines.

    The JSON is the last field, so traced and untraced lines both load.  The
    number after ``e`` is the ttl and the next the local deletion time; the
    one after ``c`` is in ``ttl``.  A line that is not a snapshot row is
    dropped.
    """
    fields = F.split(column, "\t")
    rows = lines.select(fields.alias("f")).select(
        F.explode(F.from_json(F.element_at("f", -1), LINE, {"allowUnquotedControlChars": "true"})).alias("key", "r"),
        F.when(F.size("f") > 2, F.get("f", F.lit(1))).otherwise("").alias("source"),
    )
    cell = lambda c: F.struct(
        F.get(c, F.lit(0)).alias("name"),
        F.get(c, F.lit(1)).alias("value"),
        F.get(c, F.lit(2)).try_cast("long").alias("ts"),
        F.get(c, F.lit(3)).alias("status"),
        F.get(c, F.lit(4)).try_cast("long").alias("ttl"),
        F.get(c, F.lit(5)).try_cast("long").alias("local_deletion_time"),
    )
    return rows.select("key", "source", F.col("r.deletedAt").alias("deletedat"), F.transform("r.columns", cell).alias("columns"))


def cleanse(rows: DataFrame) -> DataFrame:
    """Drops cells with ``deletedat > ts`` (strictly) or status ``d``, and rows left empty."""
    alive = F.filter("columns", lambda c: (c["ts"] >= F.coalesce("deletedat", F.lit(-(2**63)))) & ~F.coalesce(c["status"] == "d", F.lit(False)))
    return rows.withColumn("columns", alive).where(F.size("columns") > 0)


def as_loaded(rows: DataFrame) -> DataFrame:
    """(key, deletedat, map_columns, bag_columns); the last cell of a name is the map's.

    Asking for some of these columns builds only those.
    """
    placed = F.array_sort(F.transform("columns", lambda c, i: F.struct(c["name"].alias("key"), i.alias("i"), c.alias("value"))))
    # In order of name and place, a name's last cell is followed by another name.
    last = let(placed, lambda p: F.filter(p, lambda e, i: e["key"].isNotNull() & ~F.coalesce(F.get(p, i + 1)["key"] == e["key"], F.lit(False))))
    named = F.transform(last, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    return rows.select("key", "deletedat", F.map_from_entries(named).alias("map_columns"), F.col("columns").alias("bag_columns"))


def read_snapshot(spark: SparkSession, paths, clean: bool = True) -> DataFrame:
    rows = parse_lines(spark.read.text(paths))
    return as_loaded(cleanse(rows) if clean else rows)


def quoted(text: Column) -> Column:
    """A JSON string."""
    return F.regexp_replace(F.to_json(F.struct(text.alias("s"))), r'^\{"s":|\}$', "")


def _cell_text(name: Column, value: Column, c: Column) -> Column:
    number = lambda x: F.concat(F.lit(","), F.coalesce(x, F.lit(0)).cast("string"))
    tail = (
        F.when(c["status"] == "d", ',"d"')
        .when(c["status"] == "e", F.concat(F.lit(',"e"'), number(c["ttl"]), number(c["local_deletion_time"])))
        .when(c["status"] == "c", F.concat(F.lit(',"c"'), number(c["ts_last_delete"])))
        .otherwise("")
    )
    return F.concat(F.lit("["), quoted(name), F.lit(","), quoted(F.coalesce(value, F.lit(""))), number(c["ts"]), tail, F.lit("]"))


def to_lines(
    rows: DataFrame,
    key_type: str = "BytesType",
    name_type: str = "BytesType",
    value_type: str = "BytesType",
    trace_source: bool = False,
    legacy_names: bool = False,
    sort_by_name: bool = False,
    max_row_bytes: int | None = None,
) -> DataFrame:
    """``line`` and ``too_big`` of ROWs.

    A row whose cells exceed ``max_row_bytes`` keeps its key but has an error
    in place of its cells.
    """

    def named(c: Column) -> Column:
        shown = render(c["name"], name_type)
        return legacy_name(shown) if legacy_names else shown

    columns = F.col("columns")
    if sort_by_name:
        columns = F.transform(F.array_sort(F.transform(columns, lambda c: F.struct(named(c).alias("o"), c.alias("c")))), lambda x: x["c"])
    cells = F.array_join(F.transform(columns, lambda c: _cell_text(named(c), render(c["value"], value_type), c)), ",")
    size = F.aggregate("columns", F.lit(0).cast("long"), lambda n, c: n + F.coalesce(c["size"], F.lit(0)))
    big = (size > max_row_bytes) if max_row_bytes is not None else F.lit(False)
    if max_row_bytes is not None:
        cells = F.when(big, F.concat(F.lit('"error",'), quoted(too_large_message(size, max_row_bytes)), F.lit(",0"))).otherwise(cells)
    key = render(F.col("row_key"), key_type)
    body = F.concat(F.lit("{"), quoted(key), F.lit(':{"deletedAt":'), F.col("deleted_at").cast("string"), F.lit(',"columns":['), cells, F.lit("]}}"))
    parts = [key, *([F.col("source_path")] if trace_source else []), body]
    return rows.select(F.concat_ws("\t", *parts).alias("line"), big.alias("too_big"))


def write_snapshot(rows: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    to_lines(rows, **options).select("line").write.mode(mode).text(path)


def to_library_lines(rows: DataFrame) -> DataFrame:
    """``line`` in the loader's own spacing, of (key, deletedat, columns)."""
    escape = lambda x: F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))

    def cell(c: Column) -> Column:
        number = lambda x: F.coalesce(F.concat(F.lit(","), x.cast("string")), F.lit(""))
        status = F.coalesce(F.concat(F.lit(',"'), c["status"], F.lit('"')), F.lit(""))
        return F.concat(F.lit('["'), escape(c["name"]), F.lit('","'), c["value"], F.lit('"'), number(c["ts"]), status, number(c["ttl"]), number(c["local_deletion_time"]), F.lit("]"))

    cells = F.array_join(F.transform("columns", cell), ", ")
    return rows.select(F.concat(F.lit('{"'), F.col("key"), F.lit('": {"deletedAt": '), F.col("deletedat").cast("string"), F.lit(', "columns": ['), cells, F.lit("]}}")).alias("line"))
