"""The corpus pipeline: toxicity, near duplicates, repeated substrings, benchmark text, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of documents; a stage that changes texts sets n_chars anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, jaccard, packing, substring, toxicity
from quillspark.llm.work import freed, new_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
EXTRA = ("lang", "source", "n_chars")
ORACLE_SQL = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score of 0.5 or more) go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, EXTRA).where("score < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays, or one without an id if none has one."""
    return jaccard.first_of_class(docs).select(*COLUMNS)


def drop_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go, but for the first document that holds them; texts left without words go."""
    out = substring.dedup_substrings(docs, keep=EXTRA)
    return out.where("n_removed = 0 or n_words > n_removed").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"), keep=EXTRA).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", drop_substrings),
    ("benchmark decontamination", drop_benchmark),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = new_folder(spark, f"stage-{k}") + "/documents"
        with freed(spark):  # what a stage keeps beside its result goes with it
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
