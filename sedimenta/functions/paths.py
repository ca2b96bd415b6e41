"""Path expressions for listings and copies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def data_glob(path: Column) -> Column:
    return F.concat(parent(path), F.lit("/*-Data.db"))


def relative(path: Column, base: str) -> Column:
    base = base.rstrip("/") + "/"
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.startswith(decoded, F.lit(base)), decoded.substr(F.lit(len(base) + 1), F.length(decoded))).otherwise(decoded)


def old_s3(path: Column) -> Column:
    return F.regexp_replace(path, r"^s3://", "s3n://")


def is_hidden(path: Column) -> Column:
    return file_name(path).rlike(r"^[_.]")


def is_data_file(path: Column) -> Column:
    return F.endswith(path, F.lit("-Data.db"))


def is_secondary_index(path: Column) -> Column:
    """A name with more than one dot."""
    name = file_name(path)
    return F.length(name) - F.length(F.replace(name, F.lit("."), F.lit(""))) > 1


def format_version(path: Column) -> Column:
    """Version letters in a data file's name, null if there are none."""
    name = file_name(path)
    found = F.regexp_extract(name, r"(?:^|-)([a-z]{2})-(?:tmp-)?[0-9]+-", 1)
    return F.when(found != "", found)
