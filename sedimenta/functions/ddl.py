"""``CREATE TABLE`` text to key type, comparator and column roles."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Types of the query language by storage type.
TYPES = {
    "ascii": "AsciiType", "bigint": "LongType", "blob": "BytesType", "boolean": "BooleanType", "counter": "CounterColumnType",
    "decimal": "DecimalType", "double": "DoubleType", "float": "FloatType", "int": "Int32Type", "text": "UTF8Type",
    "timestamp": "TimestampType", "timeuuid": "TimeUUIDType", "uuid": "UUIDType", "varchar": "UTF8Type", "varint": "IntegerType",
}
COLLECTIONS = ("list", "set", "map")


@dataclass(frozen=True)
class Table:
    name: str
    types: dict = field(default_factory=dict)
    partition: tuple = ()
    clustering: tuple = ()
    static: tuple = ()
    descending: tuple = ()
    compact: bool = False

    @property
    def regular(self) -> tuple:
        return tuple(c for c in self.types if c not in (*self.partition, *self.clustering, *self.static))

    def stored(self, column: str) -> str:
        kind = TYPES.get(self.types[column], "BytesType")
        return f"ReversedType({kind})" if column in self.descending else kind

    @property
    def key_type(self) -> str:
        kinds = [self.stored(c) for c in self.partition]
        return kinds[0] if len(kinds) == 1 else f"CompositeType({','.join(kinds)})"

    @property
    def comparator(self) -> str:
        if self.compact:
            kinds = [self.stored(c) for c in self.clustering] or ["UTF8Type"]
            return kinds[0] if len(kinds) == 1 else f"CompositeType({','.join(kinds)})"
        return f"CompositeType({','.join([*(self.stored(c) for c in self.clustering), 'UTF8Type'])})"


def _split(text: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for k, c in enumerate(text):
        depth += (c in "(<") - (c in ")>")
        if c == "," and depth == 0:
            parts.append(text[start:k].strip())
            start = k + 1
    return [p for p in [*parts, text[start:].strip()] if p]


def _name(text: str) -> str:
    text = text.strip()
    return text[1:-1].replace('""', '"') if text.startswith('"') else text.lower()


def parse_create(statement: str) -> Table:
    head = re.match(r"\s*CREATE\s+(?:TABLE|COLUMNFAMILY)\s+(?:IF\s+NOT\s+EXISTS\s+)?([\w.\"]+)\s*\(", statement, re.I)
    if not head:
        raise ValueError("not a CREATE TABLE statement")
    depth, end = 1, head.end()
    while depth and end < len(statement):
        depth += (statement[end] == "(") - (statement[end] == ")")
        end += 1
    if depth:
        raise ValueError("unbalanced parentheses")
    body, tail = statement[head.end() : end - 1], statement[end:]
    types, static, partition, clustering = {}, [], (), ()
    for part in _split(body):
        if m := re.match(r"PRIMARY\s+KEY\s*\((.*)\)$", part, re.I | re.S):
            keys = _split(m[1])
            first = keys[0]
            partition = tuple(_name(c) for c in _split(first[1:-1])) if first.startswith("(") else (_name(first),)
            clustering = tuple(_name(c) for c in keys[1:])
            continue
        m = re.match(r"(\"[^\"]+\"|\w+)\s+([\w]+(?:\s*<.*>)?)(.*)$", part, re.S)
        if not m:
            raise ValueError(f"not a column: {part!r}")
        column = _name(m[1])
        types[column] = m[2].lower().replace(" ", "")
        if re.search(r"\bPRIMARY\s+KEY\b", m[3], re.I):
            partition = (column,)
        if re.search(r"\bSTATIC\b", m[3], re.I):
            static.append(column)
    if not partition:
        raise ValueError("no primary key")
    order = re.search(r"CLUSTERING\s+ORDER\s+BY\s*\(([^)]*)\)", tail, re.I)
    descending = tuple(_name(re.sub(r"\s+DESC$", "", x, flags=re.I)) for x in _split(order[1]) if x.upper().endswith("DESC")) if order else ()
    return Table(head[1].rsplit(".", 1)[-1].strip('"'), types, partition, clustering, tuple(static), descending, bool(re.search(r"COMPACT\s+STORAGE", tail, re.I)))


def require_exportable(table: Table) -> Table:
    if table.compact:
        raise ValueError("a table without composite cell names cannot be exported as rows")
    for column, kind in table.types.items():
        if kind.split("<")[0] in COLLECTIONS:
            raise ValueError(f"column {column} is a collection")
    return table
