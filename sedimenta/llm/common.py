"""Column helpers shared by the text operators.

Only built-in Spark expressions: no Python runs on the executors here.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Blanks between plain words, and everything that is not part of a token
#: once A-Z are lower-cased.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_TOKEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_TOKEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLANK_CHARS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Catalyst may inline a projected column into every place that uses it,
    and inside a lambda that means once per array element.  A lambda variable
    is bound to the finished value instead.

    For the same reason computed arrays are exploded with ``explode_outer``:
    for a plain ``explode`` Catalyst infers a filter on the array's size and
    pushes it, with the whole computation inlined, below the projection.
    """
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, all else kept; ``translate`` only where it is needed."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def plain_words(text: Column) -> Column:
    """Words between ASCII blanks; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters, digits and non-ASCII; a null text has none."""
    text = F.coalesce(text, F.lit(""))
    found = F.when(F.octet_length(text) == F.length(text), F.split(F.lower(text), NOT_TOKEN)).otherwise(F.transform(F.split(text, NOT_TOKEN_ANY_CASE), ascii_lower))
    return F.filter(found, lambda w: w != "")


def gram(words: Column, start: Column, length: int) -> list[Column]:
    """The items from ``start`` (from 0) on; ``slice`` would copy the list."""
    return [F.get(words, start + k) for k in range(length)]


def window_hashes(words: Column, length: int) -> Column:
    """64-bit hash of each window of ``length`` words (a power of two), by start.

    Hashes of twice the length are made from two of the last, so a window
    costs log2(length) steps.
    """
    assert length & (length - 1) == 0

    def doubled(hashes: Column, width: int) -> Column:
        if width == length:
            return F.slice(hashes, 1, F.greatest(F.size(hashes) - (length - 1), F.lit(0)))
        return let(F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + width))), lambda wide: doubled(wide, width * 2))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: doubled(hashes, 1))


def covered(starts_ends: Column) -> Column:
    """Length of the union of half-open (s, e) spans, given sorted by s."""
    return F.aggregate(
        starts_ends,
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["e"].cast("long")).alias("end"),
            (acc["total"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(acc["end"], x["s"]))).cast("long").alias("total"),
        ),
        lambda acc: acc["total"],
    )


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that none can clash with an operator's own."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def fields_of(name: str, columns: list[str]) -> list[Column]:
    """The columns of :func:`whole_row` again, from the struct called ``name``."""
    return [F.col(f"{name}.{quoted(c)}").alias(c) for c in columns]


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores added while a column is called so (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_hashes(df: DataFrame) -> list[Column]:
    """128 bits of all columns but maps, which have no hash; null, empty and order count."""
    plain = [F.col(quoted(f.name)) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in plain]) if plain else F.lit("")
    return [F.xxhash64(nulls, *plain), F.xxhash64(F.lit(1), *plain, nulls)]


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few constant rows, without a Python worker."""
    fields = StructType.fromDDL(schema).fields
    made = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields, strict=True)]) for r in rows]
    if not made:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    return spark.range(1).select(F.inline(F.array(*made)))


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.  Where that is unset, a folder of
    our own is set on a local master (as in tests) and refused on a cluster,
    whose machines would not see each other's files."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="sedimenta-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder that all executors share."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
