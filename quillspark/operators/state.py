"""Replay-safe table state: pure functions from (current, incoming) to the next table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage


def require_unique(df: DataFrame, key: list[str]) -> None:
    bad = df.groupBy(*key).count().where("count > 1").limit(1).collect()
    if bad:
        raise ValueError(f"key {key} is not unique: {bad[0]}")


def first_by(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """One row of each key, the first in a total order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def insert_or_ignore(current: DataFrame, incoming: DataFrame, key: list[str], order: list | None = None) -> DataFrame:
    """Rows with new keys are added; the first of equal incoming keys counts.

    One full join, not a union: Spark takes a union of tables that are dealt by key for
    one that is dealt so too, and a join with it breaks where a side of the union is
    planned anew while it runs.
    """
    new = first_by(incoming, key, order or [F.col(c) for c in incoming.columns if c not in key] or [F.lit(0)])
    cur, inc = current.withColumn("_cur", F.lit(True)).alias("c"), new.alias("i")
    both = cur.join(inc, reduce(lambda a, b: a & b, [F.col(f"c.{k}") == F.col(f"i.{k}") for k in key]), "full")

    def column(c: str) -> Column:
        old = F.col(f"c.{c}") if c in current.columns else F.lit(None)
        return F.when(F.col("_cur"), old).otherwise(F.col(f"i.{c}") if c in incoming.columns else F.lit(None)).alias(c)

    return both.select(*(column(c) for c in [*current.columns, *(c for c in incoming.columns if c not in current.columns)]))


def upsert(current: DataFrame, incoming: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Where a key comes in, its columns are taken over, nulls too; other columns and keys stay."""
    cur = current.withColumn("_cur", F.lit(True)).alias("c")
    inc = incoming.select(*key, *columns).withColumn("_inc", F.lit(True)).alias("i")
    both = cur.join(inc, reduce(lambda a, b: a & b, [F.col(f"c.{k}") == F.col(f"i.{k}") for k in key]), "full")
    out = []
    for c in current.columns:
        if c in key:
            out.append(F.coalesce(F.col(f"c.{c}"), F.col(f"i.{c}")).alias(c))
        elif c in columns:
            out.append(F.when(F.col("_inc"), F.col(f"i.{c}")).otherwise(F.col(f"c.{c}")).alias(c))
        else:
            out.append(F.col(f"c.{c}").alias(c))
    return both.select(*out)


def replace_by_key(current: DataFrame, incoming: DataFrame, keys: DataFrame) -> DataFrame:
    """All rows of the keys go, also if nothing comes in for them; then the incoming rows are added."""
    return current.join(keys.distinct(), keys.columns, "left_anti").unionByName(incoming, allowMissingColumns=True)


def record_ocr(local: DataFrame, stats: DataFrame, pages: DataFrame, documents: DataFrame, model: str, when=None) -> tuple[DataFrame, DataFrame]:
    """The next tables of state and of page statistics after OCR: a document's page rows are replaced together with its state.

    pages: arxiv_id, page and statistics; documents: arxiv_id, ocr_path,
    nb_pages_ocr and has_error; both as run_ocr has written them, since each is read
    for both tables.  Documents with an error on a page are not done.  commit takes
    the two tables at once.
    """
    at = F.current_timestamp() if when is None else F.lit(when).cast("timestamp")
    known = documents.select("arxiv_id")
    columns = [c for c in stats.columns if c in pages.columns]
    next_stats = replace_by_key(stats, pages.join(known, "arxiv_id", "left_semi").select(*columns), known)
    state = documents.select("arxiv_id", "ocr_path", "nb_pages_ocr", (~F.col("has_error")).alias("ocr_done"), F.lit(model).alias("ocr_model"), at.alias("ocr_date"))
    return upsert(local, state, ["arxiv_id"], ["ocr_path", "nb_pages_ocr", "ocr_done", "ocr_model", "ocr_date"]), next_stats


def update_flag(current: DataFrame, keys: DataFrame, column: str, value) -> DataFrame:
    marked = keys.distinct().withColumn("_hit", F.lit(True))
    return current.join(marked, keys.columns, "left").withColumn(column, F.when(F.col("_hit"), F.lit(value)).otherwise(F.col(column))).select(*current.columns)


def add_column(df: DataFrame, name: str, kind: str, default=None) -> DataFrame:
    """The column, if it is missing."""
    return df if name in df.columns else df.withColumn(name, F.lit(default).cast(kind))


def next_run_id(runs: DataFrame) -> int:
    return int(runs.agg(F.coalesce(F.max("run_id"), F.lit(0)).alias("m")).first()["m"]) + 1


def journal(runs: DataFrame, papers: DataFrame, source: str, n_files: int, status: str, started, notes: str | None = None) -> DataFrame:
    """The journal with a row more: counts and the high-water mark of the papers."""
    run = next_run_id(runs)
    row = papers.agg(F.count(F.lit(1)).cast("int").alias("n_papers"), F.max("updated_date").alias("watermark"))
    row = row.select(F.lit(run).alias("run_id"), F.lit(source).alias("source"), F.lit(started).cast("timestamp").alias("started_at"), F.current_timestamp().alias("completed_at"), "n_papers", F.lit(n_files).alias("n_files"), "watermark", F.lit(status).alias("status"), F.lit(notes).cast("string").alias("notes"))
    return runs.unionByName(row)


class Breach(ValueError):
    """Rows that break a table's contract: how many repeat a key, and how many lack a part of it."""

    def __init__(self, path: str, repeated: int, missing: int):
        super().__init__(f"{path}: {repeated} rows repeat a key, {missing} lack a part of one")
        self.repeated, self.missing = repeated, missing


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """The schema's columns in order, cast to its types; a null or missing one has its default."""
    given = defaults or {}

    def column(f: T.StructField) -> Column:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        return F.coalesce(c, (given[f.name] if isinstance(given[f.name], Column) else F.lit(given[f.name])).cast(f.dataType)) if f.name in given else c

    return df.select(*(column(f).alias(f.name) for f in schema.fields))


def write_checked(df: DataFrame, path: str, schema: T.StructType, key: list[str], defaults: dict | None = None) -> None:
    """Commit a table that holds its contract, or raise Breach and leave the table as it was.

    The job that writes also counts: rows whose key an earlier row has (of a window
    over the key), and rows with a null in it.
    """
    seen = Observation("contract")
    w = Window.partitionBy(*key).orderBy(F.lit(0))
    rows = conform(df, schema, defaults).withColumn("_n", F.row_number().over(w))
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in key))
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    rows = rows.observe(seen, count((F.col("_n") > 1) & ~missing).alias("repeated"), count(missing).alias("missing")).drop("_n")

    def hold() -> None:
        got = seen.get
        if got["repeated"] or got["missing"]:
            raise Breach(path, got["repeated"], got["missing"])

    commit({path: rows}, hold)


def commit(tables: dict[str, DataFrame], check: Callable[[], None] = lambda: None) -> None:
    """Write each path's next table beside it, then swap all of them; a table may be computed from itself.

    check is called when all are written; if it raises, the old tables stay.

    Once all are written, a note beside the first path lists them.  A commit that
    breaks off before the note leaves the old tables, one that breaks off after it
    is finished by ``recover``, which each commit of the same first path calls.
    """
    paths = list(tables)
    spark: SparkSession = next(iter(tables.values())).sparkSession
    recover(spark, paths[0])
    for path, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}.next")
    try:
        check()
    except Exception:
        for path in paths:
            storage.delete(spark, f"{path}.next")
        raise
    note, fs = storage.file_system(spark, f"{paths[0]}.commit")
    draft, _ = storage.file_system(spark, f"{paths[0]}.commit.draft")
    out = fs.create(draft, True)
    out.write(bytearray("\n".join(paths).encode()))
    out.close()
    fs.rename(draft, note)
    recover(spark, paths[0])


def recover(spark: SparkSession, path: str) -> None:
    """Finish the swap of a commit that had written all its tables, if one broke off; a repeated call does nothing."""
    note, fs = storage.file_system(spark, f"{path}.commit")
    if not fs.exists(note):
        return
    for one in spark.read.text(note.toString()).collect():  # as many lines as tables in the commit
        here, _ = storage.file_system(spark, one["value"])
        ready, _ = storage.file_system(spark, f"{one['value']}.next")
        old, _ = storage.file_system(spark, f"{one['value']}.old")
        if fs.exists(ready):
            if fs.exists(here):
                fs.delete(old, True)
                fs.rename(here, old)
            if not fs.rename(ready, here):
                raise OSError(f"could not commit {one['value']}")
        fs.delete(old, True)
    fs.delete(note, False)
