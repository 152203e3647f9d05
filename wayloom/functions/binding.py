"""Small helpers for composing native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use the result any number of times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that the optimizer may not inline into the lambdas reading them.

    A plain projection gets merged into the next one, which would recompute an array for
    every element of a lambda that looks it up. A one-row generator keeps the value.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def pick(array: Column, index: Column | int) -> Column:
    """Zero-based element, null when out of range (also under ANSI mode)."""
    return F.get(array, F.lit(index) if isinstance(index, int) else index)


def stretch(array: Column, first: Column, count: Column) -> Column:
    """``count`` elements from zero-based ``first``; empty when ``count`` is not positive."""
    return F.slice(array, first + 1, F.greatest(count, F.lit(0)))


def indices(count: Column) -> Column:
    """``0 .. count-1``, empty when ``count`` is not positive (``sequence`` would run down)."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def none_if_empty(collection: Column) -> Column:
    return let(collection, lambda c: F.when(F.size(c) > 0, c))


def number_text(value: Column) -> Column:
    """Shortest decimal text of a double as ids carry it: ``0.05``, ``0.00012``, ``1.2e-05``.

    Spark's own text turns to ``1.2E-4`` below a thousandth; ids keep plain digits down to
    a ten-thousandth and a two-digit exponent below that.
    """

    def plain(text: Column) -> Column:
        mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
        exponent = -F.coalesce(F.try_element_at(F.split(text, "E"), F.lit(2)).cast("int"), F.lit(0))
        digits = F.replace(mantissa, F.lit("."), F.lit(""))
        return (
            F.when(~text.contains("E-"), text)
            .when(exponent == 4, F.concat(F.lit("0.000"), digits))
            .otherwise(F.concat(mantissa, F.lit("e-"), F.lpad(exponent.cast("string"), 2, "0")))
        )

    return let(value.cast("string"), plain)


def halvings(count: Column) -> Column:
    """Powers of two from the largest within ``count`` down to 1: the steps of a search among so many."""
    powers = F.array(*(F.lit(1 << k) for k in range(30, -1, -1)))
    digits = F.length(F.bin(F.greatest(count, F.lit(1)).cast("long")))
    return F.slice(powers, 32 - digits, digits)


def leading(steps: Column, holds: Callable[[Column], Column]) -> Column:
    """How many places from the first on fulfil a condition that no place fulfils after one that doesn't.

    ``steps`` are the halvings of the number of places; ``holds`` gets a place's number, from 0, and must be
    false or null beyond the last.
    """
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(holds(n + step - 1), n + step).otherwise(n))
