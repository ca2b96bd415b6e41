"""Listings of files as DataFrames: filters, batches, manifests, partitions.

``binaryFile`` lists with Spark's own distributed listing; the contents are
not read, as no query asks for them.  Spark leaves out files of no bytes, so
listings and copies do too.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P

# Fixed value: what a batch folder's name looks like.
BATCH = r"batch_?id=[0-9]+/?$"


def listing(spark: SparkSession, path: str | list[str], recursive: bool = True, glob: str | None = None) -> DataFrame:
    """(path, length, modified) of files; hidden ones are left out."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    return found.where(~P.is_hidden(F.col("path")))


def data_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return listing(spark, path, glob="*-Data.db").where(F.col("length") > 0)


def filtered(files: DataFrame, *tests: Callable[[Column], Column]) -> DataFrame:
    """Files whose path passes all tests."""
    return files.where(reduce(lambda a, b: a & b, [t(F.col("path")) for t in tests], F.lit(True)))


def latest_batch(folders: DataFrame) -> DataFrame:
    """If the first folder is a batch, the greater of the first and the last; else all."""
    ends = folders.agg(F.min("path").alias("first"), F.max("path").alias("last"))
    return folders.join(F.broadcast(ends)).where(~F.col("first").rlike(BATCH) | (F.col("path") == F.col("last"))).drop("first", "last")


def first_only(files: DataFrame) -> DataFrame:
    return files.orderBy("path").limit(1)


def without_secondary_indexes(files: DataFrame) -> DataFrame:
    return files.where(~P.is_secondary_index(F.col("path")))


def input_globs(files: DataFrame) -> DataFrame:
    """Distinct ``pattern``s ``folder/*-Data.db``."""
    return files.select(P.data_glob(F.col("path")).alias("pattern")).distinct()


def partition_info(files: DataFrame) -> DataFrame:
    """(partition, location, length): the last ``name=value`` folder of each file."""
    return files.select(F.regexp_extract("path", r"([^/=]+=[^/]+)/[^/]*$", 1).alias("partition"), P.parent(F.col("path")).alias("location"), "path", "length")


def relative_paths(files: DataFrame, base: str) -> DataFrame:
    return files.select(P.relative(F.col("path"), base).alias("path"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Paths of a manifest, one a line; blank lines do not count."""
    return spark.read.text(path).select(F.trim("value").alias("path")).where(F.col("path") != "").distinct()


def write_manifest(files: DataFrame, path: str, mode: str = "errorifexists") -> None:
    files.select("path").write.mode(mode).text(path)


def require_one_version(files: DataFrame) -> DataFrame:
    """``files``; raises when read if names show more than one format version."""
    versions = files.agg(F.count_distinct(P.format_version(F.col("path"))).alias("versions"))
    check = F.when(F.col("versions") > 1, F.raise_error(F.lit("input files are of several format versions")).cast("boolean")).otherwise(F.lit(True))
    return files.join(F.broadcast(versions)).where(check).drop("versions")
