"""Spark data source ``tablefiles``: atoms from table files, rows to them.

Read options: ``path`` (several by comma; a folder is searched for
``*-Data.db``), ``blocksize``, ``combine`` and ``maxcombined``,
``splitcompressed``.  Split planning runs on the driver over file metadata and
indexes only, in threads; data is read on executors in Arrow batches.

An input that breaks off gives its rows up to there and one ``error`` atom,
so a job can count errors against what it allows after writing its output.
What a store fails to deliver is no such error: the task fails and runs again.

Tasks write below ``_temporary-<job>``; files get their names on commit, and
the folder goes with what failed attempts left in it.  An overwrite moves the
new files in before it removes the old.
"""

from __future__ import annotations

import io
import posixpath
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from ..model import ATOM, ROW_SCHEMA
from . import layout

# Defaults and bounds of split planning.
BLOCK = 64 * 1024 * 1024
COMBINED_BYTES, COMBINED_SPLITS = 104_857_600, 200
FULL, FUZZ = 0.99, 1.2
THREADS = 20
BATCH, BATCH_BYTES = 5000, 8 << 20

_NEXT_MINUTE = re.compile(r"(.+/-?\d+/)(\d{12})(/.+)")
_ARROW = pa.schema(
    [
        ("row_key", pa.binary()), ("source_path", pa.string()), ("row_deleted_at", pa.int64()), ("kind", pa.string()), ("name", pa.binary()),
        ("value", pa.binary()), ("ts", pa.int64()), ("ttl", pa.int32()), ("local_deletion_time", pa.int32()), ("ts_last_delete", pa.int64()),
        ("range_max", pa.binary()), ("size", pa.int64()),
    ]
)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path: local, or by its scheme."""
    return pafs.FileSystem.from_uri(path if re.match(r"^\w+://|^file:", path) else f"file://{path}")


def version_of(path: str) -> str:
    m = re.search(r"(?:^|-)([a-z]{2})-(?:tmp-)?[0-9]+-[A-Za-z]+\.db$", path.rsplit("/", 1)[-1])
    return m[1] if m else layout.CURRENT


def compression_path(store: pafs.FileSystem, path: str) -> str | None:
    """Beside the data file, else in the folder of the minute after or before."""
    beside = re.sub(r"-Data\.db$", "-CompressionInfo.db", path)
    tries = [beside]
    if m := _NEXT_MINUTE.fullmatch(beside):
        tries += [f"{m[1]}{int(m[2]) + step:012d}{m[3]}" for step in (1, -1)]
    return next((x for x in tries if store.get_file_info(x).type == pafs.FileType.File), None)


@dataclass(frozen=True)
class Split:
    path: str  # as given, with its scheme
    start: int
    length: int
    compression: str | None = None


class Combined(InputPartition):
    def __init__(self, splits: tuple[Split, ...]):
        super().__init__(None)
        self.splits = splits


def cut(length: int, offsets: Iterator[int], block: int) -> Iterator[tuple[int, int]]:
    """(start, length) of splits that begin at rows and are about a block."""
    start = 0
    if length > block * FUZZ:
        for offset in offsets:
            if offset - start >= block * FULL and length - start > block * FUZZ:
                yield start, offset - start
                start = offset
    if start < length:
        yield start, length - start


def plan_file(path: str, block: int, split_compressed: bool = True) -> list[Split]:
    store, inner = filesystem(path)
    size = store.get_file_info(inner).size or 0
    if not size:
        return []
    packed = compression_path(store, inner)
    if packed:
        with store.open_input_stream(packed) as f:
            size = layout.read_compression(io.BytesIO(f.read())).length
    index = re.sub(r"-Data\.db$", "-Index.db", inner)
    if size <= block * FUZZ or (packed and not split_compressed) or store.get_file_info(index).type != pafs.FileType.File:
        return [Split(path, 0, size, packed)]
    with store.open_input_stream(index, buffer_size=1 << 20) as f:
        return [Split(path, a, n, packed) for a, n in cut(size, layout.read_index(f), block)]


def combine(splits: list[Split], most_bytes: int, most: int) -> list[tuple[Split, ...]]:
    out: list[tuple[Split, ...]] = []
    held: list[Split] = []
    total = 0
    for s in splits:
        if held and (total + s.length > most_bytes or len(held) >= most):
            out.append(tuple(held))
            held, total = [], 0
        held.append(s)
        total += s.length
    return [*out, tuple(held)] if held else out


def list_data_files(path: str) -> list[str]:
    store, inner = filesystem(path)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    info = store.get_file_info(inner)
    if info.type == pafs.FileType.File:
        return [path]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = store.get_file_info(pafs.FileSelector(inner, recursive=True))
    names = [f.path for f in found if f.type == pafs.FileType.File and f.path.endswith("-Data.db")]
    return sorted(prefix + n for n in names if not any(p[:1] in "_." for p in n[len(inner) :].split("/") if p))


def read_split(split: Split) -> Iterator[dict]:
    store, inner = filesystem(split.path)
    version = version_of(split.path)
    try:
        with store.open_input_file(inner) as f:
            if split.compression:
                with store.open_input_stream(split.compression) as c:
                    info = layout.read_compression(io.BytesIO(c.read()))
                data: io.RawIOBase = layout.Chunks(f, info, f.size(), split.start)
            else:
                f.seek(split.start)
                data = io.BufferedReader(_Raw(f), 1 << 20)
            for atom in layout.read_rows(data, version, split.length):
                yield atom | {"source_path": split.path}
    except layout.CorruptInput as e:
        yield {"kind": "error", "source_path": split.path, "value": str(e).encode()[:500]}


class _Raw(io.RawIOBase):
    def __init__(self, f):
        self._inner = f

    def readable(self):
        return True

    def readinto(self, b):
        data = self._inner.read(len(b))
        b[: len(data)] = data
        return len(data)


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        o = self.options
        block = int(o.get("blocksize", BLOCK))
        paths = [p for p in o["path"].split(",") if p]
        compressed = o.get("splitcompressed", "true").lower() == "true"
        with ThreadPoolExecutor(THREADS) as pool:
            files = list(dict.fromkeys(f for found in pool.map(list_data_files, paths) for f in found))
            splits = [s for found in pool.map(lambda f: plan_file(f, block, compressed), files) for s in found]
        if o.get("combine", "false").lower() == "true":
            groups = combine(splits, int(o.get("blocksize", COMBINED_BYTES)), int(o.get("maxcombined", COMBINED_SPLITS)))
        else:
            groups = [(s,) for s in splits]
        return [Combined(g) for g in groups] or [Combined(())]

    def read(self, partition):
        columns: list[list] = [[] for _ in _ARROW]
        names, held = _ARROW.names, 0
        for split in partition.splits:
            for atom in read_split(split):
                for column, name in zip(columns, names):
                    column.append(atom.get(name))
                held += len(atom.get("value") or b"") + len(atom.get("name") or b"") + len(atom.get("row_key") or b"")
                if len(columns[0]) >= BATCH or held >= BATCH_BYTES:
                    yield _batch(columns)
                    columns, held = [[] for _ in _ARROW], 0
        yield _batch(columns)


def _batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


@dataclass
class Written(WriterCommitMessage):
    temporary: str | None
    final: str | None


class Writer(DataSourceWriter):
    """Data files only, a file per task; they get their names on commit."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.dataset, self.version = options["path"], options.get("dataset", "keyspace-dataset"), options.get("version", layout.CURRENT)
        self.overwrite, self.job = overwrite, uuid.uuid4().hex
        store, inner = filesystem(self.path)
        info = store.get_file_info(inner)
        if info.type != pafs.FileType.NotFound and not overwrite and store.get_file_info(pafs.FileSelector(inner)):
            raise FileExistsError(self.path)

    def write(self, iterator):
        from pyspark import TaskContext

        context = TaskContext.get()
        store, inner = filesystem(self.path)
        final = f"{inner}/{self.dataset}-{self.version}-{context.partitionId():010d}-Data.db"
        temporary = f"{inner}/_temporary-{self.job}/{context.taskAttemptId()}"
        store.create_dir(f"{inner}/_temporary-{self.job}", recursive=True)
        n = 0
        with store.open_output_stream(temporary) as out:
            for row in iterator:
                cells = [
                    {"name": bytes(c["name"]), "value": bytes(c["value"] or b""), "ts": c["ts"], "kind": c["status"] or "live", "ttl": c["ttl"], "local_deletion_time": c["local_deletion_time"], "ts_last_delete": c["ts_last_delete"]}
                    for c in row["columns"]
                ]
                out.write(layout.row_bytes(bytes(row["row_key"]), row["deleted_at"], cells, self.version))
                n += 1
        if not n:
            store.delete_file(temporary)
            return Written(None, None)
        return Written(temporary, final)

    def _clean(self, store, inner):
        folder = f"{inner}/_temporary-{self.job}"
        if store.get_file_info(folder).type == pafs.FileType.Directory:
            store.delete_dir(folder)

    def commit(self, messages):
        store, inner = filesystem(self.path)
        store.create_dir(inner)
        written = {m.final: m.temporary for m in messages if m is not None and m.temporary}
        old = [f.path for f in store.get_file_info(pafs.FileSelector(inner)) if f.type == pafs.FileType.File and f.path.endswith("-Data.db")] if self.overwrite else []
        for final, temporary in written.items():
            replace(store, temporary, final)
        for path in old:
            if posixpath.basename(path) not in {posixpath.basename(x) for x in written}:
                store.delete_file(path)
        self._clean(store, inner)

    def abort(self, messages):
        self._clean(*filesystem(self.path))


def replace(store: pafs.FileSystem, source: str, target: str) -> None:
    """Moves a file to where another may stand."""
    if store.get_file_info(target).type == pafs.FileType.File:
        store.delete_file(target)
    store.move(source, target)


class TableFiles(DataSource):
    @classmethod
    def name(cls):
        return "tablefiles"

    def schema(self):
        return ATOM

    def reader(self, schema: StructType):
        return Reader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool):
        return Writer(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TableFiles)


def read_tables(spark: SparkSession, paths: str | list[str], **options):
    register(spark)
    reader = spark.read.format("tablefiles").option("path", paths if isinstance(paths, str) else ",".join(paths))
    return reader.options(**{k: str(v) for k, v in options.items()}).load()


def write_tables(rows, path: str, mode: str = "append", **options) -> None:
    """ROWs as table files; ``mode`` append refuses a folder that has files."""
    register(rows.sparkSession)
    names = [c.split()[0] for c in ROW_SCHEMA.split(", ")]
    writer = rows.select(*names).write.format("tablefiles").mode(mode).option("path", path)
    writer.options(**{k: str(v) for k, v in options.items()}).save()
