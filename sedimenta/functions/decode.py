"""Typed values from bytes and bytes from text, as column expressions.

Big-endian integers, IEEE floats, UUIDs, decimals and composites are decoded
from their hexadecimal form with built-in functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let


def as_hex(b: Column) -> Column:
    return F.lower(F.hex(b))


def unsigned(b: Column) -> Column:
    """Up to 8 bytes as a long; 8 bytes wrap."""
    return F.conv(F.hex(b), 16, -10).cast("long")


def signed(b: Column, width: int) -> Column:
    """Two's complement of 1, 2, 4 or 8 bytes; null of another length."""
    value = unsigned(b)
    if width < 8:
        value = F.when(value >= 2 ** (8 * width - 1), value - 2 ** (8 * width)).otherwise(value)
    return F.when(F.length(b) == width, value)


def any_signed(b: Column) -> Column:
    """Two's complement of 1, 2, 4 or 8 bytes, whichever it is."""
    return F.coalesce(*[signed(b, w) for w in (1, 2, 4, 8)])


def wrapped_int(value: Column) -> Column:
    """The low 32 bits of a long, signed, as a narrowing cast gives them."""
    low = value.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(low >= 2**31, low - 2**32).otherwise(low).cast("int")


def _ieee(bits: Column, exponent_bits: int, mantissa_bits: int, negative: Column) -> Column:
    top, bias = 2**exponent_bits - 1, 2 ** (exponent_bits - 1) - 1
    exponent = F.shiftright(bits, mantissa_bits).bitwiseAND(F.lit(top).cast("long"))
    mantissa = bits.bitwiseAND(F.lit(2**mantissa_bits - 1).cast("long"))
    sign = F.when(negative, -1.0).otherwise(1.0)
    normal = (mantissa / 2.0**mantissa_bits + 1.0) * F.pow(F.lit(2.0), exponent - bias)
    tiny = mantissa * F.lit(2.0 ** (1 - bias - mantissa_bits))
    special = F.when(mantissa == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return sign * F.when(exponent == top, special).when(exponent == 0, tiny).otherwise(normal)


def double_of(b: Column) -> Column:
    bits = unsigned(b)
    return F.when(F.length(b) == 8, _ieee(bits, 11, 52, bits < 0))


def float_of(b: Column) -> Column:
    bits = unsigned(b)
    return F.when(F.length(b) == 4, _ieee(bits, 8, 23, bits >= 2**31).cast("float"))


def varint(b: Column) -> Column:
    """Two's complement of up to 15 bytes as decimal(38,0), else null."""
    big = lambda x: x.cast("decimal(38,0)")
    n = F.length(b)
    low = F.conv(F.hex(F.substring(b, F.greatest(n - 6, F.lit(1)), F.lit(7))), 16, 10)
    high = F.when(n > 7, F.conv(F.hex(F.substring(b, F.lit(1), n - 7)), 16, 10)).otherwise("0")
    value = big(high) * F.lit(2**56).cast("decimal(18,0)") + big(low)
    negative = F.conv(F.hex(F.substring(b, 1, 1)), 16, 10).cast("int") >= 128
    powers = F.element_at(F.array(*[F.lit(str(256**k)).cast("decimal(38,0)") for k in range(1, 16)]), F.greatest(F.least(n, F.lit(15)), F.lit(1)))
    return F.when((n >= 1) & (n <= 15), F.when(negative, big(value) - powers).otherwise(big(value)).cast("decimal(38,0)"))


def _limbs(limbs: Column, times: int, plus: Column) -> Column:
    """``limbs * times + plus`` of a number in limbs of nine digits, least first."""

    def step(acc: Column, limb: Column) -> Column:
        return let(
            limb * times + acc["carry"],
            lambda v: F.struct(F.floor(v / 10**9).alias("carry"), F.concat(acc["out"], F.array(v % 10**9)).alias("out")),
        )

    start = F.struct(plus.cast("long").alias("carry"), F.expr("cast(array() as array<bigint>)").alias("out"))
    return F.aggregate(limbs, start, step, lambda acc: F.when(acc["carry"] > 0, F.concat(acc["out"], F.array(acc["carry"]))).otherwise(acc["out"]))


def _long_varint_text(b: Column) -> Column:
    negative = unsigned(F.substring(b, 1, 1)) >= 128
    of = lambda i: unsigned(b.substr(i, F.lit(1)))
    # A negative number's magnitude is one more than its complement.
    plain = F.transform(F.sequence(F.lit(1), F.length(b)), lambda i: F.when(negative, 255 - of(i)).otherwise(of(i)))
    limbs = F.aggregate(plain, F.array(F.lit(0).cast("long")), lambda acc, x: _limbs(acc, 256, x))
    limbs = F.reverse(_limbs(limbs, 1, F.when(negative, 1).otherwise(0)))
    digits = F.array_join(F.transform(limbs, lambda x: F.lpad(x.cast("string"), 9, "0")), "")
    return F.concat(F.when(negative, "-").otherwise(""), F.regexp_replace(digits, "^0+(?=[0-9])", ""))


def varint_text(b: Column) -> Column:
    """Two's complement of any length as decimal text; null without bytes."""
    return F.when(F.length(b) > 15, _long_varint_text(b)).otherwise(varint(b).cast("string"))


#: Zeros that are written out for a scale; beyond, an exponent stands.
MOST_ZEROS = 1000


def decimal_text(b: Column) -> Column:
    """A decimal (4 bytes of scale, then a number of any length) as text, exactly."""
    scale = signed(F.substring(b, 1, 4), 4).cast("int")

    def shown(number: Column) -> Column:
        digits, sign = F.replace(number, F.lit("-"), F.lit("")), F.when(F.startswith(number, F.lit("-")), "-").otherwise("")
        padded = F.when(F.length(digits) <= scale, F.concat(F.repeat(F.lit("0"), scale - F.length(digits) + 1), digits)).otherwise(digits)
        point = F.length(padded) - scale
        return (
            F.when(F.abs(scale.cast("long")) > MOST_ZEROS, F.concat(sign, digits, F.lit("E"), (-scale.cast("long")).cast("string")))
            .when(scale <= 0, F.concat(sign, digits, F.when(digits == "0", "").otherwise(F.repeat(F.lit("0"), -scale))))
            .otherwise(F.concat(sign, padded.substr(F.lit(1), point), F.lit("."), padded.substr(point + 1, scale)))
        )

    return F.when(F.length(b) > 4, let(varint_text(b.substr(F.lit(5), F.length(b))), shown))


def uuid_text(b: Column) -> Column:
    return F.when(F.length(b) == 16, F.regexp_replace(as_hex(b), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def utf8_text(b: Column) -> Column:
    """The text, or null where the bytes are not UTF-8."""
    return F.when(F.is_valid_utf8(b.cast("string")), b.cast("string"))


def composite_parts(b: Column, arity: int) -> Column:
    """The first ``arity`` components of (u16 length, bytes, end byte)*."""
    def step(acc: Column, _: Column) -> Column:
        at = acc["at"]
        size = F.when(F.length(b) >= at + 1, unsigned(b.substr(at, F.lit(2))).cast("int"))
        part = F.when(F.length(b) >= at + 1 + size, b.substr(at + 2, size))
        return F.struct((at + 3 + size).alias("at"), F.concat(acc["parts"], F.array(part)).alias("parts"))

    start = F.struct(F.lit(1).alias("at"), F.expr("cast(array() as array<binary>)").alias("parts"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(arity)), start, step, lambda acc: acc["parts"])


# ------------------------------------------------------------------ by type name

_TEXT = {
    "BytesType": as_hex,
    "UTF8Type": utf8_text,
    "AsciiType": utf8_text,
    "Int32Type": lambda b: signed(b, 4).cast("string"),
    "LongType": lambda b: signed(b, 8).cast("string"),
    "CounterColumnType": lambda b: signed(b, 8).cast("string"),
    "BooleanType": lambda b: F.when(F.length(b) == 1, F.when(unsigned(b) == 0, "false").otherwise("true")),
    "FloatType": lambda b: float_of(b).cast("string"),
    "DoubleType": lambda b: double_of(b).cast("string"),
    "UUIDType": uuid_text,
    "TimeUUIDType": uuid_text,
    "LexicalUUIDType": uuid_text,
    "IntegerType": varint_text,
    "DecimalType": decimal_text,
    "DateType": lambda b: signed(b, 8).cast("string"),
    "TimestampType": lambda b: signed(b, 8).cast("string"),
}

_VALUE = {
    "BytesType": lambda b: b,
    "UTF8Type": utf8_text,
    "AsciiType": utf8_text,
    "Int32Type": lambda b: signed(b, 4).cast("int"),
    "LongType": lambda b: signed(b, 8),
    "CounterColumnType": lambda b: signed(b, 8),
    "BooleanType": lambda b: F.when(F.length(b) == 1, unsigned(b) != 0),
    "FloatType": float_of,
    "DoubleType": double_of,
    "UUIDType": uuid_text,
    "TimeUUIDType": uuid_text,
    "IntegerType": varint_text,  # of any length and scale, so as text
    "DecimalType": decimal_text,
    "DateType": lambda b: signed(b, 8),  # epoch milliseconds
    "TimestampType": lambda b: signed(b, 8),
}


def parse_type(name: str) -> tuple[str, list]:
    """``Composite(A, Reversed(B))`` as (name, [arguments]); packages dropped."""
    name = name.strip()
    m = re.fullmatch(r"([\w.]+)(?:\((.*)\))?", name, re.S)
    if not m:
        raise ValueError(f"not a type: {name!r}")
    inner, depth, start, parts = m[2] or "", 0, 0, []
    for k, c in enumerate(inner):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            parts.append(inner[start:k])
            start = k + 1
    if inner.strip():
        parts.append(inner[start:])
    return m[1].rsplit(".", 1)[-1], [parse_type(p) for p in parts]


def _base(kind: tuple) -> tuple:
    return _base(kind[1][0]) if kind[0] == "ReversedType" else kind


def render(b: Column, type_name: str) -> Column:
    """Bytes as text by type; what does not decode is hexadecimal."""
    name, inner = _base(parse_type(type_name))
    if name == "CompositeType":
        parts = composite_parts(b, len(inner))
        shown = [render_parsed(F.get(parts, F.lit(k)), kind) for k, kind in enumerate(inner)]
        return F.coalesce(F.when(F.length(b) > 0, F.concat_ws(":", *shown)), as_hex(b))
    return F.coalesce(_TEXT.get(name, as_hex)(b), as_hex(b))


def render_parsed(b: Column, kind: tuple) -> Column:
    return F.coalesce(_TEXT.get(_base(kind)[0], as_hex)(b), as_hex(b))


def value_of(b: Column, type_name: str) -> Column:
    """Bytes as a typed value; null where they do not decode."""
    name, _ = _base(parse_type(type_name))
    if name not in _VALUE:
        raise ValueError(f"no typed value for {type_name}")
    return _VALUE[name](b)


# ------------------------------------------------------------------ order by type


def _reversed_bytes(b: Column) -> Column:
    """Complements of the bytes and a mark above them all, as a longer name comes first."""
    return F.concat(F.transform(_bytes(b), lambda x: 255 - x), F.array(F.lit(256).cast("long")))


def _bytes(b: Column) -> Column:
    return F.when(F.length(b) > 0, F.transform(F.sequence(F.lit(1), F.length(b)), lambda i: unsigned(b.substr(i, F.lit(1))))).otherwise(F.expr("cast(array() as array<bigint>)"))


def _turned(number: Column, back: bool) -> Column:
    return F.bitwise_not(number) if back else number


def _whole(width: int):
    return lambda b, back: [_turned(signed(b, width), back)]


def _floating(width: int):
    def order(b: Column, back: bool) -> list[Column]:
        # As signed numbers the bits are in order but for negative ones, which are turned round; NaN is above all.
        top = 2 ** (8 * width - 1) - 1
        infinite = 0x7FF0000000000000 if width == 8 else 0x7F800000
        bits = signed(b, width)
        plain = bits.bitwiseAND(F.lit(top).cast("long"))
        key = F.when(plain > infinite, F.lit(top).cast("long")).when(bits < 0, bits.bitwiseXOR(F.lit(top).cast("long"))).otherwise(bits)
        return [_turned(key, back)]

    return order


def _any_whole(b: Column, back: bool) -> list[Column]:
    # The shortest form: more bytes are further from zero, equally many are in order.
    negative = unsigned(F.substring(b, 1, 1)) >= 128
    short = F.when(negative, F.regexp_replace(F.hex(b), "^(?:FF)+(?=[89A-F].)", "")).otherwise(F.regexp_replace(F.hex(b), "^(?:00)+(?=[0-7].)", ""))
    far = F.length(short) * F.when(negative, -1).otherwise(1)
    if back:
        return [F.when(F.length(b) > 0, -far), F.translate(short, "0123456789ABCDEF", "FEDCBA9876543210")]
    return [F.when(F.length(b) > 0, far), short]


def _any_decimal(b: Column, back: bool) -> list[Column]:
    scale = signed(F.substring(b, 1, 4), 4)
    number = F.when(F.length(b) > 4, varint_text(b.substr(F.lit(5), F.length(b))))
    digits = F.replace(number, F.lit("-"), F.lit(""))
    sign = F.when(digits == "0", 0).when(F.startswith(number, F.lit("-")), -1).otherwise(1) * (-1 if back else 1)
    size = F.when(digits == "0", 0).otherwise(F.length(digits) - scale)
    shown = F.regexp_replace(digits, "0+$", "")
    shown = F.when(sign < 0, F.concat(F.translate(shown, "0123456789", "9876543210"), F.lit("~"))).otherwise(shown)
    return [F.when(number.isNotNull(), sign), sign * size, shown]


def _clock(b: Column) -> Column:
    """The time of a UUID of version 1."""
    return F.conv(F.concat(F.substring(F.hex(b), 14, 3), F.substring(F.hex(b), 9, 4), F.substring(F.hex(b), 1, 8)), 16, 10).cast("long")


def _time_uuid(b: Column, back: bool) -> list[Column]:
    order = F.transform(_bytes(b), lambda x: (x + 128) % 256)
    return [F.when(F.length(b) == 16, _turned(_clock(b), back)), F.transform(order, lambda x: 255 - x) if back else order]


def _uuid(b: Column, back: bool) -> list[Column]:
    version = F.when(F.length(b) == 16, F.conv(F.substring(F.hex(b), 13, 1), 16, 10).cast("long"))
    return [_turned(version, back), F.when(version == 1, _turned(_clock(b), back)), _reversed_bytes(b) if back else b]


def _lexical_uuid(b: Column, back: bool) -> list[Column]:
    halves = [unsigned(F.substring(b, at, 8)) for at in (1, 9)]
    return [F.when(F.length(b) == 16, _turned(h, back)) for h in halves]


_ORDER = {
    "Int32Type": _whole(4), "LongType": _whole(8), "CounterColumnType": _whole(8), "DateType": _whole(8), "TimestampType": _whole(8), "BooleanType": _whole(1),
    "FloatType": _floating(4), "DoubleType": _floating(8), "IntegerType": _any_whole, "DecimalType": _any_decimal,
    "TimeUUIDType": _time_uuid, "UUIDType": _uuid, "LexicalUUIDType": _lexical_uuid,
}


def _part_order(b: Column, kind: tuple) -> Column:
    """A struct that orders as the type does: what does not decode first, by
    its bytes; the other way round for a reversed type."""
    back = False
    while kind[0] == "ReversedType":
        back, kind = not back, kind[1][0]
    by_bytes = _reversed_bytes(b) if back else b
    if kind[0] not in _ORDER:
        return F.struct(by_bytes.alias("bytes"))
    keys = _ORDER[kind[0]](b, back)
    known = F.when(keys[0].isNull(), 0).otherwise(-1 if back else 1)
    return F.struct(known.alias("known"), *[k.alias(f"k{n}") for n, k in enumerate(keys)], F.when(keys[0].isNull(), by_bytes).alias("bytes"))


def composite_ends(b: Column, arity: int) -> Column:
    """``parts``: the first components with their end byte as a sign; ``at``: where the rest begins."""

    def step(acc: Column, _: Column) -> Column:
        at = acc["at"]
        size = F.when(F.length(b) >= at + 1, unsigned(b.substr(at, F.lit(2))).cast("int"))
        part = F.when(F.length(b) >= at + 1 + size, b.substr(at + 2, size))
        end = F.signum(signed(b.substr(at + 2 + size, F.lit(1)), 1)).cast("int")
        return F.struct(F.coalesce(at + 3 + size, F.length(b) + 1).alias("at"), F.concat(acc["parts"], F.array(F.struct(part.alias("part"), end.alias("end")))).alias("parts"))

    start = F.struct(F.lit(1).alias("at"), F.expr("cast(array() as array<struct<part:binary,end:int>>)").alias("parts"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(arity)), start, step)


def sort_value(b: Column, type_name: str) -> Column:
    """An expression that orders bytes as their type does, bounds of ranges too.

    Composites go part by part: a missing part before any, then the part, then
    the end byte, by which a bound stands before or after all names that begin
    with it; static names stand before all others.
    """
    kind = parse_type(type_name)
    if _base(kind)[0] != "CompositeType":
        return _part_order(b, kind)
    if kind[0] == "ReversedType":
        raise ValueError(f"no order for {type_name}")
    arity = len(kind[1])
    static = F.hex(F.substring(b, 1, 2)) == "FFFF"

    def order(c: Column) -> Column:
        def part(k: int) -> Column:
            x = F.get(c["parts"], F.lit(k))
            return F.struct(F.when(x["part"].isNull(), 0).otherwise(1).alias("there"), _part_order(x["part"], kind[1][k]).alias("key"), x["end"].alias("end"))

        return F.struct(F.when(static, 0).otherwise(1).alias("regular"), *[part(k).alias(f"p{k}") for k in range(arity)], b.substr(c["at"] + F.when(static, 2).otherwise(0), F.length(b)).alias("rest"))

    return let(composite_ends(F.when(static, F.substring(b, F.lit(3), F.length(b))).otherwise(b), arity), order)


def in_order_of(type_name: str):
    """A function from bytes to what they sort by under the type."""
    return (lambda b: b) if type_name.rsplit(".", 1)[-1] in ("BytesType", "UTF8Type", "AsciiType") else (lambda b: sort_value(b, type_name))


# ---------------------------------------------------------------- casts from hex text


def bytes_of_hex(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.try_to_binary(text, F.lit("hex")))


def hex_to_text(text: Column) -> Column:
    return utf8_text(bytes_of_hex(text))


def hex_to_long(text: Column) -> Column:
    """Decimal text in the bytes first, else a big-endian number."""
    b = bytes_of_hex(text)
    written = utf8_text(b)
    return F.coalesce(F.when(written.rlike(r"^[+-]?[0-9]+$"), written.try_cast("long")), any_signed(b))


def hex_to_int(text: Column) -> Column:
    b = bytes_of_hex(text)
    written = utf8_text(b)
    return F.coalesce(F.when(written.rlike(r"^[+-]?[0-9]+$"), written.try_cast("int")), wrapped_int(any_signed(b)))


def hex_to_double(text: Column) -> Column:
    b = bytes_of_hex(text)
    return F.coalesce(double_of(b), float_of(b).cast("double"))


def hex_to_float(text: Column) -> Column:
    b = bytes_of_hex(text)
    return F.coalesce(float_of(b), double_of(b).cast("float"))


CASTS = {"string": hex_to_text, "int": hex_to_int, "long": hex_to_long, "float": hex_to_float, "double": hex_to_double}


def cast_hex(text: Column, to: str) -> Column:
    """Cast of hexadecimal text; types without one raise when a row is read."""
    if to in CASTS:
        return CASTS[to](text)
    return F.raise_error(F.lit(f"no cast to {to}"))


# ------------------------------------------------------------------- text formats


def legacy_name(name: Column) -> Column:
    """Blanks and control characters to spaces; backslash and quote escaped."""
    flat = F.regexp_replace(name, r"[\s\p{Cntrl}]", " ")
    return F.replace(F.replace(flat, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def signed_order(key: Column) -> Column:
    """Sort value of binary keys whose bytes compare as signed."""
    return F.when(
        F.length(key) > 0,
        F.transform(F.sequence(F.lit(1), F.length(key)), lambda i: F.pmod(unsigned(F.substring(key, i, F.lit(1))) + 128, F.lit(256)).cast("int")),
    ).otherwise(F.expr("cast(array() as array<int>)"))


def key_branch(key: Column, n: int) -> Column:
    return F.pmod(F.hash(key), F.lit(n))


def too_large_message(size: Column, limit: int) -> Column:
    return F.concat(F.lit("row too large: "), F.format_number(size, 0), F.lit(f" bytes - limit {limit:,} bytes"))


def cell_size(kind: Column, name: Column, value: Column) -> Column:
    """Bytes of a cell on disk: name, flags, time, value, and what its kind adds."""
    return (F.lit(2 + 1 + 8 + 4) + F.length(name) + F.coalesce(F.length(value), F.lit(0)) + F.when(kind.isin("e", "c"), 8).otherwise(0)).cast("long")
