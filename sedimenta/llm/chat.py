"""Chat formatting in budgeted windows, native Spark.

A conversation becomes one or more training windows.  Prefix sums of turn
sizes cut it into turn-aligned spans: a window takes new turns while they,
the system turn and the repeated history stay within the budget; a turn that
alone is over it still stands alone, whole.  Later windows repeat the system
turn and as much latest history as the history budget allows, without loss;
each assistant text is a target in exactly one window.

The template is ``<turn ROLE>TEXT</turn>`` and a line feed.  In roles and
texts ``\\`` is written ``\\e``, ``<`` is ``\\l`` and ``>`` is ``\\g``, so no text
can hold a control string, and reading undoes it in one way only.

Sizes come from a counting expression of the written turn, by default its
characters by ``CHARS_PER_TOKEN``; any tokenizer's counts can be given instead
(a column of the input, for one).  Prefix sums and the history that fits before
each turn are windows over turns, so work is linear in a conversation's length.

Defined cases: a null text or role is empty; an empty text is a turn of no
characters; turns stand by ``turn`` (null first), then role and text (by their
bytes), and rows that repeat are turns of their own; columns of any other name
play no part but in the counting expression; an empty table gives an empty
result.  A conversation is one row, as its digest is of its whole text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let

BUDGET = 1024
HISTORY_BUDGET = 256
#: Characters that count as one token in budgets, where tokens are not counted.
CHARS_PER_TOKEN = 4
END = "</turn>\n"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\e"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    return F.replace(out, F.lit("\\e"), F.lit("\\"))


def _long(n: int | Column) -> Column:
    return (F.lit(n) if isinstance(n, int) else n).cast("long")


def characters(written: Column) -> Column:
    """The default count of a written turn's tokens."""
    return F.ceil(F.length(written) / CHARS_PER_TOKEN)


def head_of(role: Column) -> Column:
    return F.concat(F.lit("<turn "), escape(role), F.lit(">"))


def written(role: Column, text: Column) -> Column:
    return F.concat(head_of(role), escape(text), F.lit(END))


def window_starts(turns: Column, system: Column, budget: int, history: int) -> Column:
    """(place, back) of the turns that begin a window; ``back`` turns before fit the history."""
    room = F.greatest(_long(1), _long(budget) - system - history)

    def step(acc: Column, t: Column) -> Column:
        # The first window repeats nothing and has the whole budget.
        fits = t["upto"] - acc["before"] <= F.when(F.size(acc["starts"]) == 1, _long(budget)).otherwise(room)
        cut = (t["i"] > 0) & ~fits
        return F.struct(
            F.when(cut, F.concat(acc["starts"], F.array(F.struct(t["i"].alias("at"), t["back"].alias("back"))))).otherwise(acc["starts"]).alias("starts"),
            F.when(cut, t["upto"] - t["size"]).otherwise(acc["before"]).alias("before"),
        )

    first = F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("back")))
    return F.aggregate(turns, F.struct(first.alias("starts"), _long(0).alias("before")), step, lambda acc: acc["starts"])


def format_chat(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY_BUDGET, count: Callable[[Column], Column] = characters) -> DataFrame:
    """conv_id and ``windows``: an array of (text, n_repeated, targets).

    ``n_repeated`` leading turns of the text are repeats; ``targets`` are the
    (start, length) of what the loss covers, in code points of the text.
    ``count`` gives a written turn's tokens, one at least being counted.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.greatest(_long(1), F.coalesce(count(written(role, text)).cast("long"), _long(1)))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), size.alias("size"))
    conv = Window.partitionBy("conv_id")
    rows = rows.withColumn("upto", F.sum("size").over(conv.orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)))
    # Turns before a turn whose sizes together fit the history: sums before them lie that near.
    rows = rows.withColumn("before", F.col("upto") - F.col("size"))
    rows = rows.withColumn("back", F.count("*").over(conv.orderBy("before").rangeBetween(-history, -1)).cast("int")).drop("before")
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("upto", "turn", "role", "text", "size", "back"))).alias("t"))
    numbers = F.transform("t", lambda x, i: F.struct(i.alias("i"), x["size"].alias("size"), x["upto"].alias("upto"), x["back"].alias("back")))
    has_system = F.col("t")[0]["role"] == "system"
    system = F.when(has_system, F.col("t")[0]["size"]).otherwise(_long(0))
    convs = convs.select("conv_id", "t", F.when(has_system, 1).otherwise(0).alias("n_system"), window_starts(numbers, system, budget, history).alias("starts"))

    def one(s: Column, k: Column) -> Column:
        start, end = s["at"], F.coalesce(F.get("starts", k + 1)["at"], F.size("t"))  # end exclusive
        first = F.greatest(start - s["back"], F.col("n_system"))  # the system turn is repeated anyway
        none = F.expr("cast(array() as array<int>)")
        places = F.when(first < start, F.sequence(first, start - 1)).otherwise(none)
        repeats = F.when(start > 0, F.concat(F.when(F.col("n_system") > 0, F.array(F.lit(0))).otherwise(none), places)).otherwise(none)

        def parts(places: Column) -> Column:  # by place: a slice would go through all turns each time
            return F.transform(places, lambda i: let(F.get("t", i), lambda x: F.struct(x["role"].alias("role"), head_of(x["role"]).alias("head"), escape(x["text"]).alias("body"))))

        return let(
            F.struct(parts(repeats).alias("old"), parts(F.sequence(start, end - 1)).alias("new")),
            lambda w: F.struct(
                F.array_join(F.transform(F.concat(w["old"], w["new"]), lambda x: F.concat(x["head"], x["body"], F.lit(END))), "").alias("text"),
                F.size(w["old"]).alias("n_repeated"),
                F.aggregate(
                    w["new"],
                    F.struct(
                        F.aggregate(w["old"], _long(0), lambda n, x: n + _turn_length(x)).alias("at"),
                        F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)").alias("targets"),
                    ),
                    lambda acc, x: F.struct(
                        (acc["at"] + _turn_length(x)).alias("at"),
                        F.when(
                            x["role"] == "assistant",
                            F.concat(acc["targets"], F.array(F.struct((acc["at"] + F.length(x["head"])).alias("start"), _long(F.length(x["body"])).alias("length")))),
                        )
                        .otherwise(acc["targets"])
                        .alias("targets"),
                    ),
                    lambda acc: acc["targets"],
                ).alias("targets"),
            ),
        )

    return convs.select("conv_id", F.transform("starts", one).alias("windows"))


def _turn_length(x: Column) -> Column:
    return _long(F.length(x["head"]) + F.length(x["body"]) + len(END))


def windows(formatted: DataFrame) -> DataFrame:
    """A row per training window: conv_id, window, text, n_repeated, targets.

    A conversation has one at least; a plain explode would compute them once more for its inferred filter.
    """
    return formatted.select("conv_id", F.posexplode_outer("windows").alias("window", "w")).select("conv_id", "window", "w.*")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest of what the windows hold, parsed from their text alone."""

    def turns_of(w: Column) -> Column:
        parts = F.split(w["text"], "</turn>\n", -1)
        return F.slice(parts, w["n_repeated"] + 1, F.size(parts) - 1 - w["n_repeated"])

    def canonical(part: Column) -> Column:
        role = F.regexp_extract(part, r"^<turn ([^>]*)>", 1)
        text = F.substring_index(part, ">", -1)
        return F.concat(unescape(role), F.lit("\n"), unescape(text), F.lit("\n"))

    turns = F.flatten(F.transform("windows", turns_of))
    loss = F.transform("windows", lambda w: F.array_join(F.transform(w["targets"], lambda s: unescape(F.substring(w["text"], s["start"].cast("int") + 1, s["length"].cast("int")))), ""))
    rows = formatted.select("conv_id", turns.alias("turns"), F.array_join(loss, "").alias("loss"), F.aggregate("windows", _long(0), lambda n, w: n + F.length(w["text"])).alias("formatted_chars"))
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", canonical), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
