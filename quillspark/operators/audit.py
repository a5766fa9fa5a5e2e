"""Checks of keys, references and artefacts, and run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_anti")


def done_remaining(subset: DataFrame, state: DataFrame, key: str, done) -> DataFrame:
    joined = subset.select(key).join(state, key)
    return joined.agg(F.sum(F.when(done, 1).otherwise(0)).alias("done"), F.sum(F.when(done, 0).otherwise(1)).alias("remaining"))


def disagreement(flagged: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Keys flagged as done without a file, and files without the flag."""
    a = flagged.select(key).join(files.select(key), key, "left_anti").withColumn("problem", F.lit("no file"))
    b = files.select(key).join(flagged.select(key), key, "left_anti").withColumn("problem", F.lit("no flag"))
    return a.unionByName(b)


def summary(statuses: DataFrame) -> DataFrame:
    """ok, failed, total and success_rate of a status column."""
    ok = F.sum(F.when(F.col("status") == "ok", 1).otherwise(0))
    total = F.count(F.lit(1))
    return statuses.agg(ok.alias("ok"), (total - ok).alias("failed"), total.alias("total"), F.try_divide(100 * ok, total).alias("success_rate"))
