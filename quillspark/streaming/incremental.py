"""Incremental loads: a directory as a stream, merged batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..operators import state


def load_new(spark: SparkSession, folder: str, schema: T.StructType, table: str, checkpoint: str, key: list[str], order: str, transform: Callable[[DataFrame], DataFrame] = lambda d: d, buckets: int = 64) -> None:
    """Takes files that the checkpoint has not seen, and merges them: the newest row of each key stays.

    The table is laid out in so many buckets by a hash of the key, and a batch reads
    and rewrites only the buckets that its keys fall in (choose buckets so that one
    is some GB).  The merged buckets are first written beside the table under the
    batch's number and then moved in, so a batch that broke off is finished from
    there, and one that is run twice leaves the same table.  ``merged_table`` reads it.
    """

    def merge(batch: DataFrame, number: int) -> None:
        side = f"{table}.batches/{number}"
        if not storage.exists(spark, f"{side}/_SUCCESS"):
            new = _bucketed(transform(batch), key, buckets)
            if storage.exists(spark, table):
                hit = [r[BUCKET] for r in new.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
                new = spark.read.parquet(table).where(F.col(BUCKET).isin(hit)).unionByName(new, allowMissingColumns=True)
            ties = [F.col(c).cast("string") for c in new.columns if c not in (*key, BUCKET)]
            rows = state.first_by(new, key, [F.col(order).desc_nulls_last(), *ties])
            rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(side)
        spark.read.parquet(side).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(table)
        storage.delete(spark, f"{table}.batches/{number - 1}")

    stream = spark.readStream.schema(schema).json(folder)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


BUCKET = "_bucket"


def _bucketed(rows: DataFrame, key: list[str], buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in key)), F.lit(buckets)).cast("int"))


def merged_table(spark: SparkSession, table: str) -> DataFrame:
    """What load_new has merged."""
    return spark.read.parquet(table).drop(BUCKET)


def newer_than(df: DataFrame, column: str, watermark) -> DataFrame:
    """Rows past a high-water mark; all of them if there is none."""
    return df if watermark is None else df.where(F.col(column) > F.lit(watermark))


def event_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Counts a window and type; works on streams and tables."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("day"), "event_type", "n")
