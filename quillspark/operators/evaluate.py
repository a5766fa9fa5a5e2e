"""Ranking and classifier evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import with_rank


def ranking_curve(scored: DataFrame, key: str, score: str = "score", label: str = "label") -> DataFrame:
    """key, k, hits, precision and recall at each place of the ranking of labelled rows.

    Running sums go bucket by bucket: hits inside a block of 10,000 places plus
    the hits of the blocks before.
    """
    ranked = with_rank(scored, score, key).withColumn("k", F.col("rank") + 1).withColumn("_block", F.floor(F.col("rank") / 10_000))
    within = F.sum(label).over(Window.partitionBy("_block").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    blocks = ranked.groupBy("_block").agg(F.sum(label).alias("_hits"))
    before = F.coalesce(F.sum("_hits").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_hits").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    blocks = blocks.select("_block", before.alias("_before"), total.alias("_total"))
    out = ranked.withColumn("_within", within).join(F.broadcast(blocks), "_block")
    hits = F.col("_within") + F.col("_before")
    return out.select(key, F.col(label), "k", hits.alias("hits"), (hits / F.col("k")).alias("precision"), F.try_divide(hits, F.col("_total")).alias("recall"))


def average_precision(curve: DataFrame, label: str = "label") -> DataFrame:
    return curve.agg(F.avg(F.when(F.col(label) == 1, F.col("precision"))).alias("average_precision"))


def at_k(curve: DataFrame, ks: list[int]) -> DataFrame:
    return curve.where(F.col("k").isin(ks)).select("k", "precision", "recall")


def precision_at_recall(curve: DataFrame, target: float) -> DataFrame:
    """One row: the smallest k that reaches the recall, and its precision; nulls if none does."""
    return curve.where(F.col("recall") >= F.lit(float(target))).agg(F.min("k").alias("k"), F.min_by("precision", "k").alias("precision"))


def confusion(df: DataFrame, predicted: str, label: str) -> DataFrame:
    def count(p, y):
        return F.sum(F.when((F.col(predicted) == p) & (F.col(label) == y), 1).otherwise(0))

    counts = df.agg(count(1, 1).alias("tp"), count(1, 0).alias("fp"), count(0, 1).alias("fn"))
    return counts.withColumn("precision", F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")))


def recall_mrr(ranked: DataFrame, relevant: DataFrame, query: str, key: str, k: int) -> DataFrame:
    """Of each query: whether a relevant item is among the first k, and one over its best rank; ranked holds 1-based ranks."""
    best = relevant.join(ranked, [query, key], "left").groupBy(query).agg(F.min("rank").alias("best"))
    return best.select(query, F.coalesce((F.col("best") <= k).cast("int"), F.lit(0)).alias("recall_at_k"), F.coalesce(F.lit(1.0) / F.col("best"), F.lit(0.0)).alias("reciprocal_rank"))
