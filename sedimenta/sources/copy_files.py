"""Distributed copy of files.

The file list is a DataFrame that is dealt round to tasks; each task streams
its files to a temporary name beside the target and moves them there.  Targets
that stand already are refused before anything is copied; the tasks themselves
replace what they find, so a task that runs again, a speculative one, or a
result that is acted on twice leaves the same whole files.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import layout
from .table_files import filesystem, replace

# Bounds of a copy.
MOST_TASKS = 800
BUFFER = 65536


def target_names(files: DataFrame, target: str, base: str | None = None) -> DataFrame:
    """(path, target): the place below ``base`` is kept, else the name only."""
    from ..functions import paths as P

    name = P.relative(F.regexp_replace("path", r"^file:/+", "/"), base) if base else P.file_name(F.col("path"))
    return files.select("path", F.concat(F.lit(target.rstrip("/") + "/"), name).alias("target"))


def _standing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [(t,) for t in batch["target"] for store, inner in [filesystem(t)] if store.get_file_info(inner).type != pafs.FileType.NotFound]
        yield pd.DataFrame(found, columns=["target"])


def _parts(f, unsnap: bool) -> Iterator[bytes]:
    return layout.snappy_blocks(f) if unsnap else iter(lambda: f.read(BUFFER), b"")


def _copy(batches: Iterator[pd.DataFrame], unsnap: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, target in zip(batch["path"], batch["target"], strict=True):
            source, inner = filesystem(path)
            store, out = filesystem(target)
            store.create_dir(posixpath.dirname(out), recursive=True)
            temporary, n = f"{posixpath.dirname(out)}/_copy-{uuid.uuid4().hex}", 0
            try:
                with source.open_input_stream(inner) as f, store.open_output_stream(temporary) as g:
                    for part in _parts(f, unsnap):
                        g.write(part)
                        n += len(part)
                replace(store, temporary, out)
            except BaseException:
                if store.get_file_info(temporary).type == pafs.FileType.File:
                    store.delete_file(temporary)
                raise
            rows.append((path, target, n))
        yield pd.DataFrame(rows, columns=["path", "target", "bytes"])


def copy_files(files: DataFrame, target: str, base: str | None = None, unsnap: bool = False, overwrite: bool = False, tasks: int = MOST_TASKS) -> DataFrame:
    """Copies when it is acted on; (path, target, bytes) of each file."""
    n = max(1, min(files.count(), tasks))
    named = target_names(files, target, base).repartition(n)
    if not overwrite:
        there = named.mapInPandas(_standing, "target string").take(1)
        if there:
            raise FileExistsError(there[0]["target"])
    return named.mapInPandas(lambda batches: _copy(batches, unsnap), "path string, target string, bytes long")
