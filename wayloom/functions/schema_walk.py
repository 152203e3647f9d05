"""Find linearly referenced columns by walking a schema on the driver."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed value: the field that scopes a value to a part of its line.
SCOPE_FIELD = "between"


def holds_field(data_type: T.DataType, name: str) -> bool:
    """A struct field called ``name`` exists at any depth of structs and arrays (not maps)."""
    if isinstance(data_type, T.ArrayType):
        return holds_field(data_type.elementType, name)
    if isinstance(data_type, T.StructType):
        return name in data_type.names or any(holds_field(f.dataType, name) for f in data_type)
    return False


def columns_holding(schema: T.StructType, name: str = SCOPE_FIELD) -> list[str]:
    """Top-level columns that hold the field, in schema order."""
    return [f.name for f in schema if holds_field(f.dataType, name)]


def choose_columns(existing: list[str], include: list[str] = (), exclude: list[str] = ()) -> list[str]:
    """Narrow a column list; an empty include keeps all, exclude wins, order stays."""
    unknown = sorted(set(include) - set(existing))
    if unknown:
        raise ValueError(f"columns to include are not among the existing ones: {unknown}")
    return [c for c in existing if (not include or c in include) and c not in exclude]
