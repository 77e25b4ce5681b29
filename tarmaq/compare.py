"""Compare two result tables regardless of row and column order."""

from __future__ import annotations

from datetime import date, datetime

import pyarrow as pa


def _plain(value: object) -> object:
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _rows(table: pa.Table, names: list[str]) -> list[tuple]:
    columns = [[_plain(v) for v in table.column(name).to_pylist()] for name in names]
    return sorted(zip(*columns, strict=True), key=repr)


def _kind(kind: pa.DataType) -> str:
    for test, name in [(pa.types.is_integer, "integer"), (pa.types.is_floating, "double"),
                       (pa.types.is_timestamp, "timestamp"), (pa.types.is_date, "date"),
                       (pa.types.is_boolean, "boolean")]:
        if test(kind):
            return name
    return "text" if pa.types.is_string(kind) or pa.types.is_large_string(kind) else str(kind)


def difference(found: pa.Table, wanted: pa.Table) -> str | None:
    """The first difference in names, types or rows; None if equal."""
    names = sorted(wanted.column_names)
    if sorted(found.column_names) != names:
        return f"columns {sorted(set(found.column_names) ^ set(names))}"
    for name in names:
        kinds = [_kind(table.schema.field(name).type) for table in (found, wanted)]
        if kinds[0] != kinds[1] and "null" not in kinds:
            return f"type of {name}: {kinds[0]} against {kinds[1]}"
    if found.num_rows != wanted.num_rows:
        return f"{found.num_rows} rows against {wanted.num_rows}"
    for ours, theirs in zip(_rows(found, names), _rows(wanted, names), strict=True):
        if repr(ours) != repr(theirs):
            return f"{dict(zip(names, ours))} against {dict(zip(names, theirs))}"
    return None
