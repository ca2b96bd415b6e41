"""The rules of compaction, with ties and exact bounds made by hand."""

import pytest
from pyspark.sql import functions as F

from sedimenta.functions.decode import signed_order
from sedimenta.model import ATOM, NOT_DELETED
from sedimenta.operators import compact as C
from sedimenta.plans.jobs import in_key_order
from sedimenta.streaming.incremental import IncrementalCompactor, retained

COLUMNS = [c.split()[0] for c in ATOM.split(", ")]


def atom(key, kind="live", name=None, value=None, ts=None, deleted=None, top=None, path="a", size=10, **more):
    b = lambda x: x.encode() if isinstance(x, str) else x
    row = dict.fromkeys(COLUMNS) | {"row_key": b(key), "kind": kind, "name": b(name), "value": b(value), "ts": ts, "row_deleted_at": deleted, "range_max": b(top), "source_path": path, "size": size} | more
    return tuple(row[c] for c in COLUMNS)


def frame(spark, atoms):
    return spark.createDataFrame(atoms, ATOM)


def result(df):
    return {(r["row_key"].decode("latin1"), r["source_path"]): (r["deleted_at"], [(c["name"].decode(), c["value"].decode(), c["ts"], c["status"]) for c in r["columns"]]) for r in df.collect()}


ATOMS = [
    # newest wins; equal times go to the larger value
    atom("k1", name="a", value="old", ts=1), atom("k1", name="a", value="new", ts=5, path="b"), atom("k1", name="b", value="x", ts=3), atom("k1", name="b", value="y", ts=3, path="b"),
    # range tombstone: both bounds and the time inclusive
    atom("k2", name="b", value="in", ts=7), atom("k2", name="d", value="in", ts=6), atom("k2", name="c", value="later", ts=8), atom("k2", name="e", value="out", ts=1), atom("k2", name="azz", value="out", ts=1),
    atom("k2", "rt", name="b", top="d", ts=7, path="b"),
    # row tombstone: inclusive; a newer cell stays, and a row of none stays
    atom("k3", name="a", value="gone", ts=9, deleted=NOT_DELETED), atom("k3", name="b", value="kept", ts=10), atom("k3", "row", deleted=9, path="b"),
    atom("k4", name="a", value="gone", ts=3), atom("k4", "row", deleted=4),
    # cell tombstones, expiring cells and counters stay
    atom("k5", "d", name="a", value="\0\0\0\1", ts=2), atom("k5", name="a", value="v", ts=1), atom("k5", "e", name="b", value="v", ts=1, ttl=1, local_deletion_time=1), atom("k5", "c", name="c", value="v", ts=1, ts_last_delete=4),
    # an empty name, and keys of high bytes
    atom(b"\x80", name="", value="n", ts=1), atom(b"\x7f", name="a", value="n", ts=1),
]
WANTED = {
    "k1": (NOT_DELETED, [("a", "new", 5, None), ("b", "y", 3, None)]),
    "k2": (NOT_DELETED, [("azz", "out", 1, None), ("c", "later", 8, None), ("e", "out", 1, None)]),
    "k3": (9, [("b", "kept", 10, None)]),
    "k4": (4, []),
    "k5": (NOT_DELETED, [("a", "\0\0\0\1", 2, "d"), ("b", "v", 1, "e"), ("c", "v", 1, "c")]),
    "\x80": (NOT_DELETED, [("", "n", 1, None)]),
    "\x7f": (NOT_DELETED, [("a", "n", 1, None)]),
}


def test_compact(spark):
    assert {k: v for (k, _), v in result(C.compact(frame(spark, ATOMS))).items()} == WANTED
    assert result(C.compact(frame(spark, ATOMS).limit(0))) == {}


def test_ranking_is_the_same(spark):
    atoms = C.grouped_source(frame(spark, ATOMS), False)
    one, two = C.newest_cells(atoms), C.newest_cells_by_window(atoms)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.select(*one.columns).collect()))


def test_trace_keeps_files_apart(spark):
    got = result(C.compact(frame(spark, ATOMS), C.Options(trace_source=True)))
    assert got["k1", "a"][1] == [("a", "old", 1, None), ("b", "x", 3, None)] and got["k3", "b"] == (9, []) and len(got["k2", "a"][1]) == 5



def test_ranges_by_type(spark):
    """Bounds compare as their type does: negative integers, composites of unequal length, reversed types."""
    import struct

    n = lambda x: struct.pack(">i", x)
    part = lambda b, end=0: struct.pack(">H", len(b)) + b + struct.pack(">b", end)
    cases = [
        ("Int32Type", [n(x) for x in (-5, -2, 0, 1, 2)], n(-2), n(1), [n(-5), n(2)]),
        ("ReversedType(Int32Type)", [n(x) for x in (-5, -2, 0, 1, 2)], n(1), n(-2), [n(2), n(-5)]),
        ("CompositeType(UTF8Type,UTF8Type)", [part(x) + part(b"v") for x in (b"a", b"bb", b"c", b"aaa", b"d")], part(b"aaa", -1), part(b"c", 1), [part(b"a") + part(b"v"), part(b"d") + part(b"v")]),
        ("DecimalType", [struct.pack(">i", s) + bytes([u]) for s, u in ((0, 1), (1, 25), (2, 99), (0, 3))], struct.pack(">i", 1) + b"\x0a", struct.pack(">i", 1) + b"\x1a", [struct.pack(">i", 2) + bytes([99]), struct.pack(">i", 0) + b"\3"]),
    ]
    for kind, names, low, high, left in cases:
        atoms = frame(spark, [atom("k", name=x, value="v", ts=1) for x in names] + [atom("k", "rt", name=low, top=high, ts=1)])
        options = C.Options(name_type=kind)
        assert [bytes(c["name"]) for c in C.compact(atoms, options).first()["columns"]] == left, kind
        assert sorted(bytes(r["name"]) for r in C.cells(atoms, options).collect()) == sorted(left), kind
        first = C.within_size(C.grouped_source(atoms.where("kind = 'live'"), False), 10, kind).where("not too_big").collect()
        assert len(first) == 1 and bytes(first[0]["name"]) == (left[0] if kind != "CompositeType(UTF8Type,UTF8Type)" else names[0])


def test_wide_row_of_many_ranges(spark):
    """10^5 cells against 10^4 ranges in one row, as a plain sweep has it."""
    import random
    import time

    draw = random.Random(1)
    cells = {k: draw.randrange(1000) for k in range(100_000)}
    ranges = [(a := draw.randrange(100_000), a + draw.choice([3, 50, 400]), draw.randrange(800)) for _ in range(10_000)]
    name = F.lpad(F.col("k").cast("string"), 6, "0").cast("binary")
    nothing = {c: F.lit(None) for c in ("row_deleted_at", "value", "ttl", "local_deletion_time", "ts_last_delete")}
    base = {"row_key": F.lit("r").cast("binary"), "source_path": F.lit(""), "size": F.lit(1)}
    live = spark.createDataFrame(list(cells.items()), "k int, ts long").withColumns(base | nothing | {"kind": F.lit("live"), "name": name, "range_max": F.lit(None)})
    ends = spark.createDataFrame(ranges, "k int, e int, ts long").withColumns(base | nothing | {"kind": F.lit("rt"), "name": name, "range_max": F.lpad(F.col("e").cast("string"), 6, "0").cast("binary")})
    atoms = live.select(*[F.col(c).cast(t).alias(c) for c, t in (x.split() for x in ATOM.split(", "))]).unionByName(ends.select(*[F.col(c).cast(t).alias(c) for c, t in (x.split() for x in ATOM.split(", "))]))
    newest = [-1] * 101_000
    for a, e, ts in ranges:
        for k in range(a, min(e, 100_999) + 1):
            newest[k] = max(newest[k], ts)
    want = [k for k, ts in cells.items() if ts > newest[k]]
    began = time.time()
    got = [int(c["name"]) for c in C.compact(atoms).first()["columns"]]
    assert got == want and time.time() - began < 60


def test_size_limit(spark):
    atoms = [atom("k", "row", deleted=1, size=0), *[atom("k", name=f"c{k}", value="v", ts=10 + k, size=10) for k in range(5)], atom("k", "live", name="c2", value="old", ts=0, size=10, deleted=5), atom("k", "row", deleted=3, size=0)]
    got = result(C.compact(frame(spark, atoms), C.Options(max_row_bytes=30)))
    # c0, c1 and the older c2 fill the row; the newer c2 passes the limit
    assert got == {("k", ""): (5, [("c0", "v", 10, None), ("c1", "v", 11, None)])}
    assert C.counters(frame(spark, atoms), C.Options(max_row_bytes=30)).first().asDict() == {"rows_written": 1, "rows_too_big": 1, "inputs_in_error": 0}
    assert C.counters(frame(spark, atoms), C.Options(max_row_bytes=60)).first()["rows_too_big"] == 0
    # the deletion of the atom that passes the limit counts, later ones do not
    late = [atom("k", name="a", value="v", ts=9, size=10), atom("k", name="b", value="v", ts=9, size=10, deleted=7), atom("k", name="c", value="v", ts=9, size=10, deleted=8)]
    assert result(C.compact(frame(spark, late), C.Options(max_row_bytes=15)))["k", ""] == (7, [("a", "v", 9, None)])


def test_errors(spark):
    atoms = frame(spark, [*ATOMS, atom("", "error", value="broken")])
    assert C.check_errors(atoms, 1) == 1
    assert C.counters(atoms).first().asDict() == {"rows_written": len(WANTED), "rows_too_big": 0, "inputs_in_error": 1}
    with pytest.raises(RuntimeError):
        C.check_errors(atoms)
    assert len(C.compact(atoms).collect()) == len(WANTED)


def test_key_order(spark):
    keys = [b"", b"\x80", b"\xff\x01", b"\x01", b"\x7f", b"\x01\x80", b"\x01\x00"]
    df = spark.createDataFrame([(k,) for k in keys], "k binary").orderBy(signed_order(F.col("k")))
    assert [bytes(r["k"]) for r in df.collect()] == [b"", b"\x80", b"\xff\x01", b"\x01", b"\x01\x80", b"\x01\x00", b"\x7f"]
    assert in_key_order(C.compact(frame(spark, ATOMS))).count() == len(WANTED)
    plan = in_key_order(C.compact(frame(spark, ATOMS)), True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2  # by name and by row; the order needs no third


def test_retained_compacts_alike(spark):
    atoms = C.grouped_source(frame(spark, ATOMS), False)
    assert result(C.compact(retained(atoms))) == result(C.compact(atoms))


def test_stream(spark, tmp_path):
    """Batches in any order end as one compaction does."""
    source = tmp_path / "in"
    for k in range(4):
        frame(spark, ATOMS[k::4]).coalesce(1).write.mode("append").parquet(str(source))
    job = IncrementalCompactor(spark, str(tmp_path / "state"))
    assert job.snapshot() is None
    stream = spark.readStream.schema(ATOM).option("maxFilesPerTrigger", 1).parquet(str(source))
    job.start(stream, str(tmp_path / "check")).awaitTermination()
    assert {k: v for (k, _), v in result(job.snapshot()).items()} == WANTED
    assert len(job._versions()) >= 4
    job.merge(frame(spark, ATOMS[:3]), 99)
    job.merge(frame(spark, ATOMS[:3]), 99)  # again, as after a failure
    assert {k: v for (k, _), v in result(job.snapshot()).items()} == WANTED
