"""Typed rows of a table from atoms: cells of one clustering prefix are a row.

As in the export it stands for, files are not merged and row tombstones do not
count, unless atoms are compacted first; deleted cells, and expiring cells past
``now``, are dropped; range tombstones are refused.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ddl import Table, require_exportable
from ..functions.decode import composite_parts, utf8_text, value_of
from ..model import CELLS, RANGE


def _keys(table: Table, key: Column) -> list[Column]:
    if len(table.partition) == 1:
        return [value_of(key, table.stored(table.partition[0])).alias(table.partition[0])]
    parts = composite_parts(key, len(table.partition))
    return [value_of(F.get(parts, F.lit(k)), table.stored(c)).alias(c) for k, c in enumerate(table.partition)]


def typed_rows(atoms: DataFrame, table: Table, now: int | None = None) -> DataFrame:
    """A row per partition and clustering prefix; one of nulls if a partition
    holds static values only.  Static values are copied to all its rows."""
    require_exportable(table)
    n = len(table.clustering)
    clock = F.unix_timestamp() if now is None else F.lit(now)
    alive = (F.col("kind") != "d") & ~((F.col("kind") == "e") & (F.col("local_deletion_time") <= clock))
    # One expression, so that no other test can be evaluated before the refusal.
    refusal = F.raise_error(F.lit("range tombstones cannot be exported")).cast("boolean")
    wanted = F.when(F.col("kind") == RANGE, refusal).otherwise(F.col("kind").isin(*CELLS) & alive)
    source = F.coalesce("source_path", F.lit("")).alias("_source")
    parts = composite_parts(F.col("name"), n + 1)
    shift = composite_parts(F.expr("substring(name, 3)"), n + 1)
    # A static cell's name starts with a mark before empty clustering parts.
    marked = F.expr("hex(substring(name, 1, 2)) = 'FFFF'")
    named = atoms.where(wanted).select(
        "row_key", source, "ts", "value",
        marked.alias("_static"), F.when(marked, shift).otherwise(parts).alias("_p"),
    )
    column = utf8_text(F.get("_p", F.lit(n)))
    # Static cells of a partition are one group, whatever stands in their empty parts.
    clustering = [F.when(~F.col("_static"), F.get("_p", F.lit(k))).alias(f"_c{k}") for k in range(n)]
    named = named.select("row_key", "_source", "ts", "value", "_static", column.alias("_column"), *clustering)

    def latest(name: str) -> Column:
        return value_of(F.max_by(F.when(F.col("_column") == name, F.col("value")), F.when(F.col("_column") == name, F.struct("ts", "value"))), table.stored(name)).alias(name)

    if not table.static:
        named = named.where(~F.col("_static"))
    rows = named.groupBy("row_key", "_source", "_static", *[f"_c{k}" for k in range(n)]).agg(*[latest(c) for c in (*table.regular, *table.static)])
    if table.static:
        # The static group leads its partition: its values run on, and it stays only if nothing follows.
        along = Window.partitionBy("row_key", "_source").orderBy(F.desc("_static"))
        carried = {c: F.first(F.when(F.col("_static"), F.col(c)), ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)) for c in table.static}
        rows = rows.withColumns(carried | {"_next": F.lead(F.lit(1)).over(along)}).where(~F.col("_static") | F.col("_next").isNull())
    decoded = [value_of(F.col(f"_c{k}"), table.stored(c)).alias(c) for k, c in enumerate(table.clustering)]
    return rows.select(*_keys(table, F.col("row_key")), *decoded, *table.regular, *table.static)


def avro_to_ddl(schema_json: str) -> list[tuple[str, str]]:
    """(name, Spark type) of the fields of an Avro record schema."""
    kinds = {"string": "string", "int": "int", "long": "bigint", "float": "float", "double": "double", "boolean": "boolean", "bytes": "binary"}
    out = []
    for f in json.loads(schema_json)["fields"]:
        kind = f["type"]
        kind = next((k for k in kind if k != "null"), "null") if isinstance(kind, list) else kind
        kind = kind["type"] if isinstance(kind, dict) else kind
        if kind not in kinds:
            raise ValueError(f"field {f['name']} of type {kind}")
        out.append((f["name"], kinds[kind]))
    return out


def as_schema(rows: DataFrame, schema_json: str) -> DataFrame:
    return rows.select(*[F.col(n).cast(k).alias(n) for n, k in avro_to_ddl(schema_json)])


def write_rows(rows: DataFrame, path: str, mode: str = "errorifexists", format: str | None = None) -> str:
    """Avro where its module is on the class path, else Parquet; which it was."""
    if format is None:
        spark = rows.sparkSession
        try:
            spark._jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource("avro", spark._jsparkSession.sessionState().conf())
            format = "avro"
        except AnalysisException:  # no such data source
            format = "parquet"
    rows.write.mode(mode).format(format).save(path)
    return format
