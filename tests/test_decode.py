"""Decoders against Python's own."""

import struct
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sedimenta.functions import decode as D
from sedimenta.functions import paths as P


def values(spark, rows, kind, *columns):
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    return [tuple(r) for r in df.select(*columns).collect()]


DOUBLES = [0.0, -0.0, 1.0, -2.5, 1e308, -1e-308, 5e-324, 2.2250738585072014e-308, 3.141592653589793, float("inf"), float("-inf"), 1e16 + 1]


def test_ieee(spark):
    got = values(spark, [struct.pack(">d", x) for x in DOUBLES], "binary", D.double_of(F.col("x")))
    assert [struct.pack(">d", x[0]) for x in got] == [struct.pack(">d", x) for x in DOUBLES]
    singles = [0.0, 1.5, -3.25, 1e-45, 3.4028234663852886e38, float("-inf")]
    assert [x[0] for x in values(spark, [struct.pack(">f", x) for x in singles], "binary", D.float_of(F.col("x")))] == [struct.unpack(">f", struct.pack(">f", x))[0] for x in singles]
    nan = values(spark, [struct.pack(">d", float("nan"))], "binary", D.double_of(F.col("x")))[0][0]
    assert nan != nan and values(spark, [b"abc"], "binary", D.double_of(F.col("x"))) == [(None,)]


def test_integers(spark):
    numbers = [0, 1, -1, 127, -128, 255, 2**31 - 1, -(2**31), 2**63 - 1, -(2**63), 10**20, -(10**20), 2**100, -(2**100)]
    packed = [n.to_bytes((n.bit_length() // 8) + 1, "big", signed=True) for n in numbers]
    assert [int(x[0]) for x in values(spark, packed, "binary", D.varint(F.col("x")))] == numbers
    assert values(spark, [b"\xff\xff\xff\xfe", b"\x01"], "binary", D.signed(F.col("x"), 4)) == [(-2,), (None,)]
    decimals = ["12.34", "-0.05", "0", "100", "-19.74532", "5E+3"]
    rows = []
    for d in decimals:
        sign, digits, exponent = Decimal(d).as_tuple()
        unscaled = int("".join(map(str, digits))) * (-1 if sign else 1)
        rows.append(struct.pack(">i", -exponent) + unscaled.to_bytes(unscaled.bit_length() // 8 + 1, "big", signed=True))
    got = [x[0] for x in values(spark, rows, "binary", D.decimal_text(F.col("x")))]
    assert got == ["12.34", "-0.05", "0", "100", "-19.74532", "5000"]


def test_hex_casts(spark):
    texts = [b"42".hex(), b"-7".hex(), "2a", "ffff", "80000000", "ffffffff00000001", "0000000100000001", "zz", "", None, "010203", b"99999999999".hex()]
    got = values(spark, texts, "string", D.hex_to_int(F.col("x")), D.hex_to_long(F.col("x")))
    assert got == [(42, 42), (-7, -7), (42, 42), (-1, -1), (-(2**31), -(2**31)), (1, -(2**32) + 1), (1, 2**32 + 1), (None, None), (None, None), (None, None), (None, None), (None, 99999999999)]
    assert values(spark, ["6869", "ff", ""], "string", D.hex_to_text(F.col("x"))) == [("hi",), (None,), (None,)]
    one = struct.pack(">d", 1.5).hex(), struct.pack(">f", -2.5).hex()
    assert values(spark, one, "string", D.hex_to_double(F.col("x")), D.hex_to_float(F.col("x"))) == [(1.5, 1.5), (-2.5, -2.5)]
    for kind in ("boolean", "map", "bag", "tuple", "datetime"):
        with pytest.raises(Exception, match="no cast"):
            values(spark, ["00"], "string", D.cast_hex(F.col("x"), kind))


def test_render(spark):
    u = uuid.UUID("12345678-1234-5678-1234-567812345678")
    cases = [("BytesType", b"\x01\xab", "01ab"), ("UTF8Type", "é".encode(), "é"), ("UTF8Type", b"\xff", "ff"), ("Int32Type", b"\0\0\0\x05", "5"), ("Int32Type", b"\x05", "05"), ("org.x.LongType", b"\xff" * 8, "-1"), ("ReversedType(UUIDType)", u.bytes, str(u)), ("BooleanType", b"\1", "true")]
    for kind, data, want in cases:
        assert values(spark, [data], "binary", D.render(F.col("x"), kind)) == [(want,)]
    name = b"\0\4\0\0\0\7\0" + b"\0\2hi\0"
    assert values(spark, [name], "binary", D.render(F.col("x"), "CompositeType(Int32Type,ReversedType(UTF8Type))")) == [("7:hi",)]
    assert D.parse_type("a.b.CompositeType(Int32Type, ReversedType(x.UTF8Type))") == ("CompositeType", [("Int32Type", []), ("ReversedType", [("UTF8Type", [])])])
    with pytest.raises(ValueError):
        D.value_of(F.lit(b""), "ListType")
    order = spark.createDataFrame([(struct.pack(">i", n),) for n in (5, -3, 0)], "x binary").orderBy(D.sort_value(F.col("x"), "Int32Type"))
    assert [struct.unpack(">i", r["x"])[0] for r in order.collect()] == [-3, 0, 5]
    assert values(spark, [name, b"\0\4\0", b""], "binary", D.composite_parts(F.col("x"), 2)) == [([b"\0\0\0\7", b"hi"],), ([None, None],), ([None, None],)]



def packed(n):
    return n.to_bytes(n.bit_length() // 8 + 1, "big", signed=True)


def test_large_numbers(spark):
    """Nothing is lost: integers of any length, decimals of any scale."""
    numbers = [0, -1, 2**119, -(2**119), 10**45 + 7, -(10**45), 2**200 - 1, -(2**200), 256**15, -(256**15)]
    assert [x[0] for x in values(spark, [packed(n) for n in numbers] + [b""], "binary", D.varint_text(F.col("x")))] == [*map(str, numbers), None]
    decimals = [(20, 1), (12, 10**29 + 1), (40, -(10**39)), (0, 10**40), (-2, 5), (30, -7), (5000, 3)]
    got = [x[0] for x in values(spark, [struct.pack(">i", s) + packed(n) for s, n in decimals] + [b"\0\0\0\1"], "binary", D.value_of(F.col("x"), "DecimalType"))]
    assert got[-1] is None and got[-2] == "3E-5000"
    for (s, n), text in zip(decimals, got):
        assert Decimal(text).as_tuple()[1] == Decimal(n).as_tuple()[1] or Decimal(text) == Decimal(n).scaleb(-s)
        assert Decimal(text) == Decimal((n < 0, tuple(map(int, str(abs(n)))), -s))


def ranked(spark, kind, rows):
    """``rows`` of (what it is worth, bytes) as Spark orders them."""
    df = spark.createDataFrame([(k, b) for k, (_, b) in enumerate(rows)], "k int, x binary")
    return [rows[r["k"]][0] for r in df.orderBy(D.sort_value(F.col("x"), kind)).collect()]


def test_order_of_types(spark):
    ints = [5, -3, 0, 2**31 - 1, -(2**31)]
    for kind, width in (("Int32Type", "i"), ("LongType", "q")):
        rows = [(n, struct.pack(f">{width}", n)) for n in ints]
        assert ranked(spark, kind, rows) == sorted(ints) and ranked(spark, f"ReversedType({kind})", rows) == sorted(ints, reverse=True)
    floats = [0.0, 1.5, -1.5, float("inf"), float("-inf"), 1e300, -1e-300]
    rows = [(n, struct.pack(">d", n)) for n in floats]
    assert ranked(spark, "DoubleType", rows) == sorted(floats) and ranked(spark, "ReversedType(DoubleType)", rows) == sorted(floats, reverse=True)
    large = [0, 1, -1, 127, 128, -128, -129, 255, 256, 10**30, -(10**30), 10**30 + 1, 2**64, -(2**64)]
    rows = [(n, packed(n)) for n in large]
    assert ranked(spark, "IntegerType", rows) == sorted(large) and ranked(spark, "ReversedType(IntegerType)", rows) == sorted(large, reverse=True)
    decimals = [Decimal(x) for x in ("0", "1", "-1", "0.1", "-0.1", "-0.12", "-0.123", "12", "120.5", "-120.5", "1E+3", "999", "-1E+3", "0.099", "1E-30")]
    rows = [(d, struct.pack(">i", -d.as_tuple()[2]) + packed(int(d.scaleb(-d.as_tuple()[2])))) for d in decimals]
    assert ranked(spark, "DecimalType", rows) == sorted(decimals) and ranked(spark, "ReversedType(DecimalType)", rows) == sorted(decimals, reverse=True)
    texts = ["", "a", "ab", "b", "é", "aa"]
    rows = [(t, t.encode()) for t in texts]
    assert ranked(spark, "ReversedType(UTF8Type)", rows) == sorted(texts, key=str.encode, reverse=True)
    times = [uuid.UUID(fields=(low, mid, 0x1000 | high, 0x80, 1, 5)) for low, mid, high in ((1, 2, 3), (2, 1, 3), (0, 0, 4), (9, 9, 0))]
    assert ranked(spark, "TimeUUIDType", [(u.time, u.bytes) for u in times]) == sorted(u.time for u in times)
    assert ranked(spark, "ReversedType(TimeUUIDType)", [(u.time, u.bytes) for u in times]) == sorted((u.time for u in times), reverse=True)
    assert ranked(spark, "Int32Type", [("odd", b"\1"), ("none", b""), (-9, struct.pack(">i", -9))]) == ["none", "odd", -9]


def test_order_of_composites(spark):
    part = lambda b, end=0: struct.pack(">H", len(b)) + b + struct.pack(">b", end)
    kind = "CompositeType(UTF8Type,ReversedType(Int32Type))"
    n = lambda x: struct.pack(">i", x)
    order = [
        b"\xff\xff" + part(b"") + part(n(1)), part(b"a", -1), part(b"a"), part(b"a") + part(n(5)), part(b"a") + part(n(-5)), part(b"a", 1),
        part(b"ab"), part(b"ab") + part(n(0)), part(b"ab") + part(n(0)) + part(b"more"), part(b"b"),
    ]
    rows = list(enumerate(order))
    assert ranked(spark, kind, rows[::-1]) == list(range(len(order)))
    with pytest.raises(ValueError):
        D.sort_value(F.lit(b""), "ReversedType(CompositeType(UTF8Type))")


def test_text_formats(spark):
    assert values(spark, ['a\tb"c\\d\x01'], "string", D.legacy_name(F.col("x"))) == [('a b\\"c\\\\d ',)]
    assert values(spark, [1234567], "long", D.too_large_message(F.col("x"), 1000)) == [("row too large: 1,234,567 bytes - limit 1,000 bytes",)]
    assert all(0 <= r[0] < 7 for r in values(spark, [b"", b"a", b"\xff"], "binary", D.key_branch(F.col("x"), 7)))
    paths = ["/a/b/ks-t-jb-12-Data.db", "/a/la-5-big-Data.db", "s3://x/s3://y", "/a/b%20c/d+e"]
    assert values(spark, paths, "string", P.format_version(F.col("x")))[:2] == [("jb",), ("la",)]
    assert values(spark, paths[2:], "string", P.old_s3(F.col("x")), P.relative(F.col("x"), "/a")) == [("s3n://x/s3://y", "s3://x/s3://y"), ("/a/b%20c/d+e", "b c/d+e")]
