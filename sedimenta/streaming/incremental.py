"""Incremental compaction of a stream of mutations.

Each micro-batch is merged into a retained state, a folder of Parquet
versions.  The state keeps, per row, the newest cell of each name, the range
tombstones and the row deletion, so a snapshot of it equals the compaction of
all mutations ever seen: tombstones are kept because older cells may still
arrive.  A batch that runs twice writes the same version again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import ATOM, RANGE, ROW
from ..operators.compact import KEY, Options, compact, grouped_source, newest_cells, row_deletes


def retained(atoms: DataFrame) -> DataFrame:
    """The fewest ATOMs that compact as ``atoms`` do, now and with any added."""
    empty = {c.split()[0]: F.lit(None).cast(c.split()[1]) for c in ATOM.split(", ")}
    names = list(empty)
    cells = newest_cells(atoms).select(*[F.col(c) if c in (*KEY, "name", "kind", "value", "ts", "ttl", "local_deletion_time", "ts_last_delete", "size") else empty[c].alias(c) for c in names])
    ranges = atoms.where(F.col("kind") == RANGE).groupBy(*KEY, "name", "range_max").agg(F.max("ts").alias("ts"), F.max("size").alias("size"))
    ranges = ranges.withColumn("kind", F.lit(RANGE)).select(*[F.col(c) if c in (*KEY, "name", "range_max", "ts", "size", "kind") else empty[c].alias(c) for c in names])
    rows = row_deletes(atoms).select(
        *KEY, F.col("deleted_at").alias("row_deleted_at"), F.lit(ROW).alias("kind"), *[empty[c].alias(c) for c in names if c not in (*KEY, "row_deleted_at", "kind")]
    )
    return cells.unionByName(ranges).unionByName(rows.select(*names))


class IncrementalCompactor:
    """Merges batches into ``path``; ``state`` and ``snapshot`` read the last version."""

    def __init__(self, spark: SparkSession, path: str, trace_source: bool = False, name_type: str = "BytesType"):
        self.spark, self.path, self.options = spark, path.rstrip("/"), Options(trace_source, name_type=name_type)

    def _versions(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"version=(\d+)", n)))

    def state(self, before: int | None = None) -> DataFrame | None:
        versions = [v for v in self._versions() if before is None or v < before]
        return self.spark.read.schema(ATOM).parquet(f"{self.path}/version={versions[-1]}") if versions else None

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        batch = grouped_source(batch, self.options.trace_source).select(*[c.split()[0] for c in ATOM.split(", ")])
        old = self.state(before=batch_id)
        merged = retained(batch if old is None else old.unionByName(batch))
        merged.write.mode("overwrite").parquet(f"{self.path}/version={batch_id}")

    def start(self, stream: DataFrame, checkpoint: str, **trigger):
        writer = stream.writeStream.foreachBatch(lambda df, k: self.merge(df, k)).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def snapshot(self) -> DataFrame | None:
        state = self.state()
        return None if state is None else compact(state, self.options)
