"""Dense and sparse scores, reciprocal rank fusion, recall-based sizing."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors
from .ranking import with_position, with_rank


def dense_scores(docs: DataFrame, query: list[float], key: str = "arxiv_id", vec: str = "dense_vec") -> DataFrame:
    return docs.select(key, vectors.dot(F.col(vec), F.array(*(F.lit(float(x)) for x in query))).alias("score"))


def sparse_scores(docs: DataFrame, query: dict, key: str = "arxiv_id", weights: str = "sparse_weights", match=vectors.lexical_match) -> DataFrame:
    """match: an expression of (query map, document map)."""
    if not query:
        return docs.select(key, F.lit(0.0).alias("score"))
    q = F.create_map(*(F.lit(x) for kv in query.items() for x in kv))
    return docs.select(key, F.coalesce(match(q, F.col(weights)), F.lit(0.0)).alias("score"))


def rrf_fuse(*channels: DataFrame, key: str = "arxiv_id", k: float = 60.0) -> DataFrame:
    """key, hybrid_score of rows that all channels hold: the sum of 1 / (k + rank + 1), in channel order.  Each channel is computed and ranked once."""
    ranked = [with_rank(c.select(key, F.col("score").alias(f"_s{i}")), f"_s{i}", key, f"_r{i}").select(key, f"_r{i}") for i, c in enumerate(channels)]
    both = reduce(lambda a, b: a.join(b, key), ranked)
    parts = [F.lit(1.0) / (F.lit(float(k)) + F.col(f"_r{i}") + F.lit(1.0)) for i in range(len(channels))]
    return both.select(key, reduce(lambda a, b: a + b, parts).alias("hybrid_score"))


def ranked_corpus(fused: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """fused with its 0-based rank, written once: for recommend_top_k and candidates, which take their ranks from it."""
    return fused if "rank" in fused.columns else with_rank(fused, "hybrid_score", key)


def recommend_top_k(fused: DataFrame, golden: DataFrame, target: float = 0.97, key: str = "arxiv_id", cap: float | None = None) -> int:
    """Smallest list that holds the target share of labelled positives; cap: a quantile of positive ranks that bounds it (robust sizing).

    fused may be a ranked_corpus.
    """
    ranks = ranked_corpus(fused, key).join(golden.where("label = 1").select(key), key).select("rank")
    placed = with_position(ranks, [F.col("rank")], "n")
    total = placed.count()
    if total == 0:
        raise ValueError("no labelled positive is in the corpus")
    need = min(math.ceil(float(target) * float(total)), total)
    if cap is not None:
        need = min(need, max(1, int(total * cap)))
    return int(placed.where(F.col("n") == need - 1).first()["rank"]) + 1


def candidates(fused: DataFrame, k: int, key: str = "arxiv_id") -> DataFrame:
    """The k best with their 1-based rank; fused may be a ranked_corpus."""
    # k grows with the corpus, so the list is cut by rank and not merged in one task
    return ranked_corpus(fused, key).where(F.col("rank") < k).withColumn("rank", (F.col("rank") + 1).cast("int"))


def corpus_slice(embeddings: DataFrame, papers: DataFrame, categories: list[str]) -> DataFrame:
    """Embedded papers of some categories."""
    return embeddings.join(papers.where(F.col("primary_category").isin(categories)), "arxiv_id")
