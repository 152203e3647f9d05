"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int | None = None) -> DataFrame:
    """Keys with more rows than one task should hold, and the number of shares each needs.

    A task should hold ``rows_per_task`` rows, or else an even share of all rows. Fewer keys than
    there are tasks can have more than an even share, and their shares are at most twice as many as
    the tasks. So the list is short at any size, without a limit. Counts combine before their shuffle.
    """
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    if rows_per_task is not None:
        even = F.lit(rows_per_task)
    else:
        total = df.dropna(subset=keys).select(F.count(F.lit(1))).scalar()
        even = F.greatest(F.ceil(total / _tasks(df)), F.lit(1))
    shares = F.ceil(F.col("_rows") / even).cast("int").alias("_shares")
    return counts.filter(F.col("_rows") > even).select(*keys, shares)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str,
    spread_by: list[Column],
    condition: Column | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Inner or left join of ``left`` with a ``right`` that has few rows per key.

    Rows of hot keys are dealt over several shares by a hash of ``spread_by``; only the few
    right rows of those keys are repeated, once per share. All other keys join as usual.
    Both sides name the keys alike, and the result holds them once.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports inner and left, not {how}")
    hot = hot_keys(left.select(*keys), keys, rows_per_task)
    if rows_per_task is None:
        hot = F.broadcast(hot)  # fewer rows than there are tasks
    dealt_to = lambda shares: F.pmod(F.xxhash64(*spread_by), shares).cast("int")
    # Null keys match nothing, so they may go anywhere; left alone they would all go to one task.
    unmatchable = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    share = (
        F.when(unmatchable, dealt_to(F.lit(_tasks(left))))
        .when(F.col("_shares").isNull(), 0)
        .otherwise(dealt_to(F.col("_shares")))
    )
    dealt = left.join(hot, keys, "left").withColumn("_share", share).drop("_shares")
    shares = F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1)
    repeated = right.join(hot, keys, "left").withColumn("_share", F.explode(shares)).drop("_shares")
    on = [*keys, "_share"]
    if condition is None:
        return dealt.join(repeated, on, how).drop("_share")
    renamed = repeated.select(
        *[F.col(k).alias(f"_r_{k}") for k in on], *[c for c in repeated.columns if c not in on]
    )
    equal = condition
    for k in on:
        equal = (F.col(k) == F.col(f"_r_{k}")) & equal
    return dealt.join(renamed, equal, how).drop("_share", *[f"_r_{k}" for k in on])
