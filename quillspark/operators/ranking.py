"""Global places and ranks without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import storage

_BITS = 33  # of monotonically_increasing_id: above them the partition, below the place in it


def with_position(df: DataFrame, order: list[Column], name: str, parts: int | None = None) -> DataFrame:
    """The rows, written, with their 0-based place in a total order.

    One shuffle deals the rows to ranges of the whole order (Spark samples rows and
    takes composite bounds of all order columns), tasks sort their range, and the
    place is that in the range plus the rows of the ranges before: a table of as many
    rows as there were ranges.  Keys that begin alike, and equal scores with unique
    keys, spread as any others.  Rows that tie in every order column may swap.
    """
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    rows = storage.written(ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "position")
    part = F.shiftright("_id", _BITS)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = rows.withColumn("_part", part).join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    return out.withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << _BITS) - 1))).drop("_part", "_before", "_id")


def by_score(score: str, key: str) -> list[Column]:
    """Score descending, then key; NaN and null scores last."""
    s = F.col(score).cast("double")
    return [F.when(F.isnan(s), None).otherwise(s).desc_nulls_last(), F.col(key).asc_nulls_last()]


def with_rank(df: DataFrame, score: str, key: str, rank: str = "rank", parts: int | None = None) -> DataFrame:
    """0-based rank by (score DESC, key); NaN and null scores last."""
    return with_position(df, by_score(score, key), rank, parts)


def zip_rows(left: DataFrame, right: DataFrame, left_order: list[Column], right_order: list[Column], name: str = "position") -> DataFrame:
    """Rows of both sides at the same place of their orders; raises if the sides differ in length."""
    a, b = with_position(left, left_order, name), with_position(right, right_order, name)
    n, m = a.count(), b.count()
    if n != m:
        raise ValueError(f"{n} rows on the left, {m} on the right")
    return a.join(b, name)


def top_k(df: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """The k best rows; a partial top-k in each partition, then a merge."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)
