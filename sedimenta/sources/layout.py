"""Binary layouts of table files: rows, atoms, index, compression.

No files of a real store were at hand: this codec follows the published
layout and is tested reader against writer.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa

# Flags of a cell, bounds of versions, marks.
FLAG_DELETED, FLAG_EXPIRING, FLAG_COUNTER, FLAG_COUNTER_UPDATE, FLAG_RANGE = 0x01, 0x02, 0x04, 0x08, 0x10
FIRST_WITHOUT_ROW_SIZE = "ja"
CURRENT = "jb"
NEVER = 0x7FFFFFFF
NOT_DELETED = -(2**63)


class CorruptInput(Exception):
    """The input breaks off or holds what no writer writes."""


class CorruptCell(CorruptInput):
    """A cell of a row whose end is known cannot be read."""


def has_row_size(version: str) -> bool:
    return version < FIRST_WITHOUT_ROW_SIZE


def _take(f: BinaryIO, n: int) -> bytes:
    if n < 0:
        raise CorruptInput(f"negative length {n}")
    parts, left = [], n
    while left:
        part = f.read(min(left, 1 << 20))
        if not part:
            raise CorruptInput(f"{left} of {n} bytes missing")
        parts.append(part)
        left -= len(part)
    return b"".join(parts)


def _short_bytes(f: BinaryIO) -> bytes:
    return _take(f, struct.unpack(">H", _take(f, 2))[0])


def _read_cell(f: BinaryIO, name: bytes) -> dict:
    flags = _take(f, 1)[0]
    if flags & FLAG_RANGE:
        top = _short_bytes(f)
        local, at = struct.unpack(">iq", _take(f, 12))
        return {"kind": "rt", "name": name, "range_max": top, "local_deletion_time": local, "ts": at, "size": 2 + len(name) + 1 + 2 + len(top) + 12}
    out = {"name": name, "size": 2 + len(name) + 1}
    if flags & (FLAG_COUNTER | FLAG_COUNTER_UPDATE):
        out["kind"] = "c"
        if flags & FLAG_COUNTER:
            (out["ts_last_delete"],) = struct.unpack(">q", _take(f, 8))
            out["size"] += 8
    elif flags & FLAG_EXPIRING:
        out["kind"] = "e"
        out["ttl"], out["local_deletion_time"] = struct.unpack(">ii", _take(f, 8))
        out["size"] += 8
    else:
        out["kind"] = "d" if flags & FLAG_DELETED else "live"
    out["ts"], n = struct.unpack(">qI", _take(f, 12))
    if n > 1 << 31:
        raise CorruptInput(f"a value of {n} bytes")
    out["value"] = _take(f, n)
    out["size"] += 12 + n
    if out["kind"] == "d" and n == 4:
        (out["local_deletion_time"],) = struct.unpack(">i", out["value"])
    return out


class _Bounded:
    """The next ``left`` bytes of a file."""

    def __init__(self, f: BinaryIO, left: int):
        self.f, self.left = f, left

    def read(self, n: int) -> bytes:
        part = self.f.read(min(n, self.left))
        self.left -= len(part)
        return part

    def drain(self) -> bool:
        """Reads what is left; whether all of it was there."""
        while self.left and self.read(1 << 20):
            pass
        return not self.left


def read_rows(f: BinaryIO, version: str, length: int | None = None) -> Iterator[dict]:
    """Atoms of the rows that begin within ``length`` bytes.

    A row without atoms gives a marker.  An error is raised where it occurs;
    what came before stands.  Rows are read cell by cell; one whose size says
    that it ends past ``length`` is refused.
    """
    at = 0
    while length is None or at < length:
        first = f.read(1)
        if not first:
            return
        key = _take(f, struct.unpack(">H", first + _take(f, 1))[0])
        at += 2 + len(key)
        row: dict = {"row_key": key}
        if has_row_size(version):
            size, _, row["row_deleted_at"], count = struct.unpack(">qiqi", _take(f, 24))
            at += 24 + size - 16
            if size < 16 or (length is not None and at > length):
                raise CorruptInput(f"a row of {size} bytes")
            cells, n, broken = _Bounded(f, size - 16), 0, None
            try:
                for n in range(1, count + 1):
                    yield row | _read_cell(cells, _short_bytes(cells))
            except CorruptInput as e:
                broken = e
            if not cells.drain():
                raise broken or CorruptInput(f"{cells.left} bytes of a row missing")
            if broken is not None:  # the next row's place is known
                yield row | {"kind": "error", "value": str(CorruptCell(str(broken))).encode()}
            if not n:
                yield row | {"kind": "row"}
        else:
            _, row["row_deleted_at"] = struct.unpack(">iq", _take(f, 12))
            at += 12
            n = 0
            while name := _short_bytes(f):
                cell = _read_cell(f, name)
                at += cell["size"]
                n += 1
                yield row | cell
            at += 2
            if not n:
                yield row | {"kind": "row"}


def cell_bytes(cell: dict) -> bytes:
    name, value, kind = cell["name"], cell.get("value") or b"", cell["kind"]
    head = struct.pack(">H", len(name)) + name
    if kind == "rt":
        top = cell["range_max"]
        return head + bytes([FLAG_RANGE]) + struct.pack(">H", len(top)) + top + struct.pack(">iq", cell.get("local_deletion_time") or 0, cell["ts"])
    flag, extra = {"live": (0, b""), "d": (FLAG_DELETED, b"")}.get(kind, (None, b""))
    if kind == "e":
        flag, extra = FLAG_EXPIRING, struct.pack(">ii", cell.get("ttl") or 0, cell.get("local_deletion_time") or 0)
    elif kind == "c":
        flag, extra = FLAG_COUNTER, struct.pack(">q", cell.get("ts_last_delete") or NOT_DELETED)
    if flag is None:
        raise ValueError(f"unknown kind {kind}")
    return head + bytes([flag]) + extra + struct.pack(">qI", cell["ts"], len(value)) + value


def row_bytes(key: bytes, deleted_at: int, cells: list[dict], version: str = CURRENT) -> bytes:
    local = NEVER if deleted_at == NOT_DELETED else min(max(deleted_at // 1_000_000, 0), NEVER)
    body = b"".join(map(cell_bytes, cells))
    head = struct.pack(">H", len(key)) + key
    if has_row_size(version):
        return head + struct.pack(">qiqi", 16 + len(body), local, deleted_at, len(cells)) + body
    return head + struct.pack(">iq", local, deleted_at) + body + b"\0\0"


# ------------------------------------------------------------------------- index


def read_index(f: BinaryIO) -> Iterator[int]:
    """Offsets of rows in the data file."""
    while first := f.read(1):
        _take(f, struct.unpack(">H", first + _take(f, 1))[0])
        offset, promoted = struct.unpack(">qi", _take(f, 12))
        _take(f, promoted)
        yield offset


def index_bytes(entries: list[tuple[bytes, int]]) -> bytes:
    return b"".join(struct.pack(">H", len(k)) + k + struct.pack(">qi", at, 0) for k, at in entries)


# ------------------------------------------------------------------- compression


@dataclass(frozen=True)
class Compression:
    codec: str
    options: dict
    chunk: int
    length: int
    offsets: tuple


def _utf(f: BinaryIO) -> str:
    return _short_bytes(f).decode()


def read_compression(f: BinaryIO) -> Compression:
    codec = _utf(f)
    options = {}
    for _ in range(struct.unpack(">i", _take(f, 4))[0]):
        name = _utf(f)
        options[name] = _utf(f)
    chunk, length, n = struct.unpack(">iqi", _take(f, 16))
    return Compression(codec, options, chunk, length, struct.unpack(f">{n}q", _take(f, 8 * n)))


def compression_bytes(c: Compression) -> bytes:
    text = lambda s: struct.pack(">H", len(s.encode())) + s.encode()
    options = b"".join(text(k) + text(v) for k, v in c.options.items())
    return text(c.codec) + struct.pack(">i", len(c.options)) + options + struct.pack(">iqi", c.chunk, c.length, len(c.offsets)) + struct.pack(f">{len(c.offsets)}q", *c.offsets)


def _snappy_length(data: bytes) -> int:
    out = shift = 0
    for byte in data:
        out |= (byte & 0x7F) << shift
        if not byte & 0x80:
            return out
        shift += 7
    raise CorruptInput("no length in a snappy block")


def decompress(codec: str, data: bytes) -> bytes:
    name = codec.rsplit(".", 1)[-1]
    try:
        if name == "SnappyCompressor":
            return pa.Codec("snappy").decompress(data, _snappy_length(data), asbytes=True)
        if name == "LZ4Compressor":
            return pa.Codec("lz4_raw").decompress(data[4:], struct.unpack("<i", data[:4])[0], asbytes=True)
        if name == "DeflateCompressor":
            return zlib.decompress(data)
    except (OSError, ValueError, struct.error, zlib.error, pa.ArrowException) as e:
        raise CorruptInput(f"a {name} chunk: {e}") from e
    raise CorruptInput(f"unknown codec {codec}")


def compress(codec: str, data: bytes) -> bytes:
    name = codec.rsplit(".", 1)[-1]
    if name == "SnappyCompressor":
        return pa.Codec("snappy").compress(data, asbytes=True)
    if name == "LZ4Compressor":
        return struct.pack("<i", len(data)) + pa.Codec("lz4_raw").compress(data, asbytes=True)
    if name == "DeflateCompressor":
        return zlib.compress(data)
    raise ValueError(f"unknown codec {codec}")


class Chunks(io.RawIOBase):
    """Uncompressed bytes of a compressed file from a place on.

    Chunk places are known, so a split begins at its own chunk.  The checksum
    after each chunk is not checked; a missing chunk is an error.
    """

    def __init__(self, f: BinaryIO, info: Compression, size: int, at: int = 0):
        self._f, self._info, self._size, self._at = f, info, size, at
        self._held, self._which = b"", -1

    def readable(self) -> bool:
        return True

    def read(self, n: int = -1) -> bytes:
        left = self._info.length - self._at
        if n == 0 or left <= 0:
            return b""
        which, inside = divmod(self._at, self._info.chunk)
        if which != self._which:
            if which >= len(self._info.offsets):
                raise CorruptInput("a chunk is missing")
            begin = self._info.offsets[which]
            end = self._info.offsets[which + 1] if which + 1 < len(self._info.offsets) else self._size
            self._f.seek(begin)
            self._held, self._which = decompress(self._info.codec, _take(self._f, end - begin - 4)), which
        out = self._held[inside : inside + (left if n < 0 else min(n, left))]
        if not out:
            raise CorruptInput("a chunk is short")
        self._at += len(out)
        return out


def compressed_file(data: bytes, codec: str, chunk: int = 65536) -> tuple[bytes, Compression]:
    parts, offsets, at = [], [], 0
    for k in range(0, len(data), chunk):
        raw = data[k : k + chunk]
        packed = compress(codec, raw) + struct.pack(">I", zlib.adler32(raw))
        offsets.append(at)
        parts.append(packed)
        at += len(packed)
    return b"".join(parts), Compression(codec, {}, chunk, len(data), tuple(offsets))


# ------------------------------------------------------------------ snappy streams

# Fixed value: what a snappy stream begins with.
SNAPPY_MAGIC = b"\x82SNAPPY\x00"


def snappy_blocks(f: BinaryIO) -> Iterator[bytes]:
    """Decoded blocks of a snappy stream (magic, versions, then sized blocks),
    one at a time; a file that is one raw block is that block."""
    codec = pa.Codec("snappy")
    head = _some(f, 16)
    if len(head) < 16 or not head.startswith(SNAPPY_MAGIC):
        data = head + b"".join(iter(lambda: f.read(1 << 20), b""))
        yield codec.decompress(data, _snappy_length(data), asbytes=True)
        return
    version, _ = struct.unpack(">ii", head[8:16])
    if version < 1:
        raise CorruptInput(f"snappy stream of version {version}")
    while size := _some(f, 4):
        if len(size) < 4 or (n := struct.unpack(">i", size)[0]) < 0:
            raise CorruptInput("a snappy block is short")
        block = _take(f, n)
        yield codec.decompress(block, _snappy_length(block), asbytes=True)


def _some(f: BinaryIO, n: int) -> bytes:
    """Up to ``n`` bytes, fewer only at the end."""
    out = b""
    while len(out) < n and (part := f.read(n - len(out))):
        out += part
    return out


def decode_snappy(data: bytes) -> bytes:
    return b"".join(snappy_blocks(io.BytesIO(data)))


def encode_snappy(data: bytes, block: int = 32768) -> bytes:
    codec, out = pa.Codec("snappy"), [SNAPPY_MAGIC, struct.pack(">ii", 1, 1)]
    for k in range(0, len(data), block):
        packed = codec.compress(data[k : k + block], asbytes=True)
        out += [struct.pack(">i", len(packed)), packed]
    return b"".join(out)
