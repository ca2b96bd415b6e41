"""Schemas and constants of the wide-column data model.

An *atom* is one mutation of one row: a cell, a cell tombstone, a range
tombstone or a bare row marker.  A *row* is the compacted result.
"""

from __future__ import annotations

#: "Not deleted": the least long.
NOT_DELETED = -(2**63)

#: Kinds of atoms: live cell, cell tombstone, expiring cell, counter cell,
#: range tombstone, row marker; ``error`` reports input that cannot be read.
LIVE, DELETED, EXPIRING, COUNTER, RANGE, ROW, ERROR = "live", "d", "e", "c", "rt", "row", "error"
CELLS = (LIVE, DELETED, EXPIRING, COUNTER)

ATOM = (
    "row_key binary, source_path string, row_deleted_at long, kind string, name binary, value binary, ts long, "
    "ttl int, local_deletion_time int, ts_last_delete long, range_max binary, size long"
)

CELL = "struct<name:binary,value:binary,ts:bigint,status:string,ttl:bigint,local_deletion_time:bigint,ts_last_delete:bigint,size:bigint>"
ROW_SCHEMA = f"row_key binary, source_path string, deleted_at long, columns array<{CELL}>"
