"""Embedding of texts with an injected encoder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage
from .state import insert_or_ignore

SCHEMA = "arxiv_id string, dense_vec array<float>, sparse_weights map<int,float>, status string"


def pending(papers: DataFrame, embedded: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Papers without an embedding."""
    rows = papers if categories is None else papers.where(F.col("primary_category").isin(categories))
    return rows.join(embedded.select("arxiv_id"), "arxiv_id", "left_anti").select("arxiv_id", F.concat("title", F.lit(". "), "abstract").alias("text"))


def embed(texts: DataFrame, load: Callable[[], Callable[[list[str]], dict]], batch_size: int = 64, dim: int | None = None) -> DataFrame:
    """load: called once a task; gives encode(texts) -> {dense_vecs, lexical_weights}.  A batch that fails has status and no vectors."""

    def run(frames):
        encode = load()
        for f in frames:
            for k in range(0, len(f), batch_size):
                part = f.iloc[k : k + batch_size]
                try:
                    got = encode(part["text"].tolist())
                    dense = [[float(x) for x in v] for v in got["dense_vecs"]]
                    if dim is not None and any(len(v) != dim for v in dense):
                        raise ValueError(f"vectors must have {dim} numbers")
                    sparse = [{int(i): float(w) for i, w in m.items()} for m in got["lexical_weights"]]
                    yield pd.DataFrame({"arxiv_id": part["arxiv_id"].tolist(), "dense_vec": dense, "sparse_weights": sparse, "status": "ok"})
                except Exception as e:
                    yield pd.DataFrame({"arxiv_id": part["arxiv_id"].tolist(), "dense_vec": None, "sparse_weights": None, "status": f"error: {e}"})

    rows = texts.select(F.col("arxiv_id").cast("string"), "text")
    cores = texts.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:  # a small table in few files: encoding is worth a shuffle of it
        rows = rows.repartition(cores)
    return rows.mapInPandas(run, SCHEMA)


def save_embeddings(current: DataFrame, new: DataFrame, model: str) -> DataFrame:
    """Good rows are added where the key is new; the first write stays."""
    good = new.where("status = 'ok'").select("arxiv_id", "dense_vec", "sparse_weights", F.lit(model).alias("embed_model"), F.current_timestamp().alias("embed_date"))
    return insert_or_ignore(current, good, ["arxiv_id"], [F.col("embed_date")])


def embed_in_chunks(texts: DataFrame, load: Callable, run: str, chunks: int = 16, batch_size: int = 64, dim: int | None = None) -> DataFrame:
    """The rows of embed, chunk by chunk: each is a job whose result is written under run, so a run that broke off goes on with the next chunk.

    The queue is written first; texts that come later belong to another run.
    """
    spark = texts.sparkSession
    chunk = F.pmod(F.xxhash64(F.col("arxiv_id").cast("string")), F.lit(chunks)).cast("int")
    if not storage.exists(spark, f"{run}/queue/_SUCCESS"):
        texts.select(F.col("arxiv_id").cast("string").alias("arxiv_id"), "text", chunk.alias("_chunk")).write.mode("overwrite").partitionBy("_chunk").parquet(f"{run}/queue")
    queue = spark.read.schema("arxiv_id string, text string, _chunk int").parquet(f"{run}/queue")
    done = [storage.once(spark, f"{run}/chunk-{k}", lambda k=k: embed(queue.where(F.col("_chunk") == k), load, batch_size, dim)) for k in range(chunks)]
    return reduce(DataFrame.unionByName, done)


def embed_pending(papers: DataFrame, embedded: DataFrame, load: Callable, model: str, categories: list[str] | None = None, limit: int | None = None, batch_size: int = 64, dim: int | None = None, run: str | None = None, chunks: int = 16) -> tuple[DataFrame, DataFrame]:
    """The next table and the status of each row: papers without an embedding, at most so many by id, are embedded and added.

    Rows that fail stay pending, so the next call takes them again.  The encoder sees
    each row once, as its rows are written: chunk by chunk under run, if that is given,
    so that a run that broke off goes on, or else in one job in the shared folder.
    """
    queue = pending(papers, embedded, categories)
    if limit is not None:
        queue = queue.orderBy("arxiv_id").limit(limit)
    new = embed_in_chunks(queue, load, run, chunks, batch_size, dim) if run else storage.written(embed(queue, load, batch_size, dim), "embeddings")
    return save_embeddings(embedded, new, model), new.select("arxiv_id", "status")


def hashing_encoder(dim: int = 16):
    """A loader of a deterministic stand-in encoder: signed word hashes."""

    def load():
        def encode(texts):
            dense, sparse = [], []
            for t in texts:
                v, m = [0.0] * dim, {}
                for w in (t or "").lower().split():
                    h = crc32(w.encode())
                    v[h % dim] += 1.0 if h >> 31 else -1.0
                    m[h % 30_000] = m.get(h % 30_000, 0.0) + 1.0
                norm = sum(x * x for x in v) ** 0.5 or 1.0
                dense.append([x / norm for x in v])
                sparse.append(m)
            return {"dense_vecs": dense, "lexical_weights": sparse}

        return encode

    return load
