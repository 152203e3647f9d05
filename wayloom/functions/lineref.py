"""Linear references: collect them, and rescope values to one piece of a line.

Both walk the column's schema on the driver and return one native expression for it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayloom.functions.binding import let, none_if_empty, pick
from wayloom.functions.schema_walk import SCOPE_FIELD

_RANGES = "array<array<double>>"


def ranges(column: Column, data_type: T.DataType) -> Column | None:
    """All non-null ``between`` arrays in a value, at any depth; None if the type has none."""
    if isinstance(data_type, T.ArrayType):
        return _ranges_of_items(column, data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _ranges_of_items(F.map_values(column), data_type.valueType)
    if not isinstance(data_type, T.StructType):
        return None
    found = []
    for field in data_type:
        child = column[field.name]
        if field.name == SCOPE_FIELD and isinstance(field.dataType, T.ArrayType):
            found.append(F.array(child.cast("array<double>")))
        else:
            nested = ranges(child, field.dataType)
            if nested is not None:
                found.append(F.coalesce(nested, F.array().cast(_RANGES)))
    return F.filter(F.concat(*found), lambda r: r.isNotNull()) if found else None


def _ranges_of_items(items: Column, item_type: T.DataType) -> Column | None:
    if ranges(items, item_type) is None:
        return None
    empty = F.array().cast(_RANGES)
    return F.flatten(F.transform(items, lambda e: F.coalesce(ranges(e, item_type), empty)))


def split_values(column: Column, data_type: T.DataType) -> Column:
    """Positions one column asks to cut at: 0, 1 and every end in it; none for a null value."""
    ends = F.array(F.lit(0.0), F.lit(1.0))
    found = ranges(column, data_type)
    if found is not None:
        inner = F.filter(F.flatten(found), lambda v: v.isNotNull() & (v != 0))
        ends = F.array_union(ends, inner)
    return F.when(column.isNotNull(), ends).otherwise(F.array().cast("array<double>"))


def all_split_values(columns: list[tuple[Column, T.DataType]]) -> Column:
    """Distinct ascending positions over several columns."""
    if not columns:
        return F.array().cast("array<double>")
    return F.sort_array(F.array_distinct(F.concat(*[split_values(c, t) for c, t in columns])))


def has_malformed(columns: list[tuple[Column, T.DataType]]) -> Column:
    """Some ``between`` does not have exactly two items."""
    found = [ranges(c, t) for c, t in columns]
    tests = [
        F.coalesce(F.exists(r, lambda v: F.size(v) != 2), F.lit(False)) for r in found if r is not None
    ]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def rescope_range(
    between: Column, start_m: Column, length_m: Column, total_m: Column, min_overlap_m: float
) -> Column:
    """``struct(applies, between)`` of one range on a piece of the line.

    A null or zero end counts as the line's own end. A range covering the piece but for less
    than the minimum loses its scope (null); one overlapping by less does not apply.
    """

    def end(index: int, default: float) -> Column:
        value = pick(between, index)
        return F.when(value != 0, value).otherwise(default) * total_m - start_m

    clipped = F.struct(
        F.greatest(end(0, 0.0), F.lit(0.0)).alias("a"), F.least(end(1, 1.0), length_m).alias("b")
    )

    def verdict(c: Column) -> Column:
        overlap = c.b - c.a
        part = F.array(F.try_divide(c.a, length_m), F.try_divide(c.b, length_m))
        return F.struct(
            (overlap >= min_overlap_m).alias("applies"),
            F.when((overlap >= min_overlap_m) & (length_m - overlap >= min_overlap_m), part).alias(SCOPE_FIELD),
        )

    return let(clipped, verdict)


def rescope(
    column: Column,
    data_type: T.DataType,
    start_m: Column,
    length_m: Column,
    total_m: Column,
    min_overlap_m: float,
) -> Column:
    """A value as it holds on one piece, with the same type.

    Parts scoped elsewhere go away, null items are dropped, and containers left empty turn
    null from the inside out.
    """

    def walk(value: Column, t: T.DataType) -> Column:
        if isinstance(t, T.ArrayType):
            return none_if_empty(
                F.filter(F.transform(value, lambda e: walk(e, t.elementType)), lambda e: e.isNotNull())
            )
        if isinstance(t, T.MapType):
            return none_if_empty(
                F.map_filter(
                    F.transform_values(value, lambda _, v: walk(v, t.valueType)), lambda _, v: v.isNotNull()
                )
            )
        if not isinstance(t, T.StructType):
            return value
        if not isinstance(_scope_type(t), T.ArrayType):
            return rebuild(value, t, None)
        scope = value[SCOPE_FIELD]
        scoped = rescope_range(scope.cast("array<double>"), start_m, length_m, total_m, min_overlap_m)
        unscoped = F.struct(F.lit(True).alias("applies"), scope.cast("array<double>").alias(SCOPE_FIELD))
        return let(
            F.when(scope.isNull(), unscoped).otherwise(scoped),
            lambda s: F.when(s.applies, rebuild(value, t, s[SCOPE_FIELD].cast(_nullable(_scope_type(t))))),
        )

    def rebuild(value: Column, t: T.StructType, scope: Column | None) -> Column:
        fields = [
            (scope if f.name == SCOPE_FIELD and scope is not None else walk(value[f.name], f.dataType)).alias(f.name)
            for f in t
        ]
        anything = lambda s: reduce(lambda a, b: a | b, [s[f.name].isNotNull() for f in t])
        return F.when(value.isNotNull(), let(F.struct(*fields), lambda s: F.when(anything(s), s)))

    return walk(column, data_type).cast(_nullable(data_type))


def _scope_type(t: T.StructType) -> T.DataType | None:
    return next((f.dataType for f in t if f.name == SCOPE_FIELD), None)


def _nullable(t: T.DataType) -> T.DataType:
    """The same type with nulls allowed anywhere, as rescoping may put them."""
    return t.toNullable() if isinstance(t, (T.ArrayType, T.MapType, T.StructType)) else t
