"""An inverted index for sparse scores: postings by token in levels of falling weight.

A token's postings are dealt to levels by their weight: level l holds weights from
the token's largest over 2^l down to half of that, so a level's bound is known
before it is read, and no list is sorted.  Postings are written in ranges of
(token, level, key), so the list of a token that most documents hold spreads over
tasks and files, and Parquet skips the row groups of other tokens and levels.

A search for the k best reads levels in order of what they can add to a score,
doubling what it reads from round to round, and stops as soon as nothing unread can
lift a document into the k best; scores of those that may be among them are then
completed from the rest.  Weights and query weights are positive; zeros and nulls
add nothing and are left out, negative ones raise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEVELS = 24
#: Postings that the first round reads.
FIRST = 10_000


def build(postings: DataFrame, path: str) -> None:
    """Index of (key, token, weight) rows, one a key and token, under a path."""
    raised = F.when(F.col("weight") < 0, F.raise_error(F.lit("weights must not be negative"))).otherwise(F.col("weight"))
    rows = postings.select("key", "token", raised.cast("double").alias("weight")).where("weight > 0 and token is not null and key is not null")
    top = rows.groupBy("token").agg(F.max("weight").alias("top"))
    level = F.least(F.floor(F.log2(F.col("top") / F.col("weight"))), F.lit(LEVELS)).cast("int")
    # the join's hot tokens are split by Spark, as tokens are unique on the other side
    leveled = rows.join(top, "token").select("token", level.alias("level"), "key", "weight")
    order = ["token", "level", "key"]
    leveled.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/postings")
    spark = postings.sparkSession
    spark.read.parquet(f"{path}/postings").groupBy("token", "level").agg(F.max("weight").alias("bound"), F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/levels")


def _weighted(spark: SparkSession, path: str, query: dict, part: Column | None) -> DataFrame:
    """key and score of the postings of a part of the index."""
    rows = spark.read.parquet(f"{path}/postings").where(F.col("token").isin(list(query)))
    weights = F.create_map(*(F.lit(x) for kv in query.items() for x in kv))
    add = F.col("weight") * F.try_element_at(weights, F.col("token"))
    return (rows if part is None else rows.where(part)).groupBy("key").agg(F.sum(add).alias("score"))


def _asked(query: dict) -> dict:
    if any(w is not None and w < 0 for w in query.values()):
        raise ValueError("query weights must not be negative")
    return {t: float(w) for t, w in query.items() if w}


def scores(spark: SparkSession, path: str, query: dict) -> DataFrame:
    """key and score of all documents that hold a token of the query."""
    asked = _asked(query)
    return _weighted(spark, path, asked, None if asked else F.lit(False)) if asked else spark.read.parquet(f"{path}/postings").limit(0).select("key", F.col("weight").alias("score"))


def search(spark: SparkSession, path: str, query: dict, k: int) -> tuple[DataFrame, dict]:
    """The k best of scores by (score DESC, key), and what it took: rounds, postings read to find them, and all of the query's."""
    asked = _asked(query)
    if not asked:
        return scores(spark, path, asked), {"rounds": 0, "read": 0, "all": 0}
    # at most LEVELS + 1 rows a token of the query
    levels = [(r["bound"] * asked[r["token"]], r["token"], r["level"], r["n"]) for r in spark.read.parquet(f"{path}/levels").where(F.col("token").isin(list(asked))).collect()]
    levels.sort(key=lambda x: (-x[0], str(x[1]), x[2]))  # a token's own levels come in order, as their bounds fall
    total, budget, rounds, read, n = sum(x[3] for x in levels), FIRST, 0, 0, 0
    while True:
        rounds, before = rounds + 1, n
        while n < len(levels) and (n == before or read + levels[n][3] <= budget):  # one level more at least
            read, n = read + levels[n][3], n + 1
        unread = levels[n:]
        rest: dict = {}
        for bound, token, _, _ in unread:
            rest[token] = max(rest.get(token, 0.0), bound)
        slack = sum(rest.values()) * (1 + 1e-9)  # sums of floats may differ in the last digits
        part = _weighted(spark, path, asked, _of(levels[:n]))
        best = part.orderBy(F.col("score").desc()).limit(k)
        got = best.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).first()
        if not unread or (got["n"] == k and slack < got["least"]):
            break
        budget *= 2
    if unread:
        part = part.where(F.col("score") + slack >= F.lit(got["least"]))
        more = _weighted(spark, path, asked, _of(unread)).withColumnRenamed("score", "_more")
        part = part.join(more, "key", "left").select("key", (F.col("score") + F.coalesce("_more", F.lit(0.0))).alias("score"))
    return part.orderBy(F.col("score").desc(), "key").limit(k), {"rounds": rounds, "read": read, "all": total}


def _of(levels: list[tuple]) -> Column:
    """The postings of some levels: each token's are one run of levels, so a range of them reaches the scan."""
    if not levels:
        return F.lit(False)
    runs: dict = {}
    for _, token, level, _ in levels:
        lo, hi = runs.get(token, (level, level))
        runs[token] = (min(lo, level), max(hi, level))
    tests = [(F.col("token") == F.lit(t)) & F.col("level").between(lo, hi) for t, (lo, hi) in runs.items()]
    while len(tests) > 1:  # as a tree: a chain of some hundred tokens is too deep for the parser
        tests = [reduce(lambda a, b: a | b, tests[k : k + 2]) for k in range(0, len(tests), 2)]
    return tests[0]
