"""Samples that a rerun, and another engine, draws alike: rows in the order of a hash of their key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_key(key: str, seed: str = "_seed42") -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))


def stratified(df: DataFrame, stratum: str, key: str, n: int, seed: str = "_seed42") -> DataFrame:
    """Up to n rows of each stratum."""
    w = Window.partitionBy(stratum).orderBy(order_key(key, seed), F.col(key))
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def sample(df: DataFrame, key: str, n: int, seed: str = "_seed42", strict: bool = True) -> DataFrame:
    """n rows without replacement; strict: raises if there are fewer."""
    out = df.orderBy(order_key(key, seed), F.col(key)).limit(n)
    if strict and out.count() < n:
        raise ValueError(f"fewer than {n} rows to sample from")
    return out


def shuffled(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    return df.orderBy(F.rand(seed) if seed is not None else F.rand()).limit(n)


def golden_set(positive: DataFrame, hard: DataFrame, rest: DataFrame, key: str, sizes: tuple[int, int, int] = (50, 15, 20), seed: str = "_seed42") -> DataFrame:
    """Positives, hard negatives and random rows, each row once (first source wins), label still open."""
    parts = [sample(df, key, n, seed, strict=False).withColumn("_source", F.lit(k)) for k, (df, n) in enumerate(zip((positive, hard, rest), sizes, strict=True))]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    w = Window.partitionBy(key).orderBy("_source")
    return every.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_source").withColumn("label", F.lit(None).cast("int"))
