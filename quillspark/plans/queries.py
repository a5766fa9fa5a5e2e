"""Queries of the library's operators over the test tables, each with the SQL of the same rows."""

from __future__ import annotations

import io
import tarfile
import uuid
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import storage
from ..functions import text, vectors
from ..operators import audit, chunks, classify, curate, documents, encode, evaluate, ranking, retrieval, sampling, sparse_index, state
from ..sources import fetch, readers
from . import schema

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


folder = storage.folder


# ---- sources and sinks


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s1_json_scan(spark, sf):
    rows = t(spark, sf, "customer")
    path = folder(spark, "json")
    rows.write.mode("overwrite").json(path)
    return readers.metadata(spark, path, rows.schema)


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents)")
def s2_first_record(spark, sf):
    return t(spark, sf, "documents").select("doc_id", "lang", "source").orderBy("doc_id").limit(1)


@query("SELECT doc_id, quality, toxic FROM labels")
def s5_parquet_scan(spark, sf):
    return t(spark, sf, "labels")


@query("SELECT n_name, code FROM nation JOIN (VALUES (0, 'zero'), (1, 'one'), (2, 'two')) v(k, code) ON n_nationkey = k")
def s6_frame_scan(spark, sf):
    frame = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "k int, code string")
    return t(spark, sf, "nation").join(F.broadcast(frame), F.col("n_nationkey") == F.col("k")).select("n_name", "code")


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'failed: not found' ELSE 'ok' END AS status, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 'raw/' || doc_id || '.pdf' END AS path FROM documents")
def s7_fetch(spark, sf):
    def load():
        tried = set()

        def get(key):
            again, _ = key in tried, tried.add(key)
            if key % 7 == 0 or key % 5 == 0 and not again:  # some answer at the second call
                raise OSError("not found")
            return f"raw/{key}.pdf"

        return get

    return fetch.fetch(t(spark, sf, "documents"), load, "doc_id", pause=0, parts=4, wait=(0, 0))


@query("SELECT doc_id, CAST(k AS INT) AS page FROM (SELECT doc_id, unnest(generate_series(0, least(3, (strlen(coalesce(text, '')) // 1000) + 1) - 1)) AS k FROM documents)")
def s9_page_images(spark, sf):
    files = t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("path"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    pages = readers.pages_of(files, lambda: lambda raw, dpi: [b"image"] * (len(raw) // 1000 + 1), max_pages=3)
    return pages.select(F.col("path").cast("long").alias("doc_id"), "page")


def _archives(spark, sf) -> str:
    """An archive a page, with dotted ids that begin alike."""
    path = folder(spark, "archives")
    pages = t(spark, sf, "pages").select("page_id")

    def make(frames):
        import pandas as pd

        fs, at = readers.store(path)
        for f in frames:
            for k in f["page_id"]:
                raw = io.BytesIO()
                with tarfile.open(fileobj=raw, mode="w:gz") as tar:
                    body = f"paper {k}".encode()
                    info = tarfile.TarInfo("src/paper.tex" if k % 3 else "readme.txt")
                    info.size = len(body)
                    tar.addfile(info, io.BytesIO(body))
                readers.put(fs, f"{at}/2301.{k}.tar.gz", raw.getvalue() if k % 10 else b"broken")
            yield pd.DataFrame({"n": [len(f)]})

    pages.mapInPandas(make, "n long").agg(F.sum("n")).collect()
    return path


@query("SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 'FAIL' WHEN page_id % 3 <> 0 THEN 'OK' ELSE 'NOTEX' END AS outcome FROM pages")
def s10_archives(spark, sf):
    out = fetch.extraction_status(readers.archives(spark, _archives(spark, sf)))
    return out.select(F.regexp_extract("path", r"2301\.(\d+)\.tar\.gz$", 1).cast("long").alias("page_id"), "outcome")


@query("SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN 'paper ' || page_id END AS body FROM pages WHERE page_id % 10 <> 0")
def s8_extracted_files(spark, sf):
    """Archives are unpacked to the shared folder; their files are read back."""
    target = folder(spark, "extracted")
    out = storage.written(readers.extract(spark, _archives(spark, sf), target), "extraction")  # so that files are written once
    done = out.where("status = 'ok'").select(F.regexp_extract("folder", r"(\d+)$", 1).cast("long").alias("page_id"))
    found = spark.read.text(target, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.tex").select(F.regexp_extract(F.input_file_name(), r"/2301\.(\d+)/src/paper\.tex$", 1).cast("long").alias("page_id"), F.col("value").alias("body"))
    return done.join(found, "page_id", "left").select("page_id", "body")


@query("SELECT conv_id, text FROM conversations WHERE turn = (SELECT min(turn) FROM conversations)")
def s11_whole_text(spark, sf):
    rows = t(spark, sf, "conversations")
    first = rows.where(F.col("turn") == rows.agg(F.min("turn")).first()[0]).select("conv_id", "text")
    path = folder(spark, "texts")
    first.write.mode("overwrite").option("lineSep", "\u0001").partitionBy("conv_id").text(path)
    got = readers.whole_text(spark, path)
    return got.select(F.regexp_extract("path", r"conv_id=(\d+)", 1).cast("long").alias("conv_id"), F.regexp_replace("value", "\u0001$", "").alias("text"))


@query("SELECT 'documents' AS name, TRUE AS present UNION ALL SELECT 'no_such_table', FALSE")
def s12_table_exists(spark, sf):
    name = f"documents_{uuid.uuid4().hex}"
    t(spark, sf, "documents").createOrReplaceTempView(name)
    return spark.createDataFrame([("documents", readers.table_exists(spark, name)), ("no_such_table", readers.table_exists(spark, f"no_{name}"))], "name string, present boolean")


@query("SELECT * FROM (VALUES ('doc_id', 'bigint'), ('quality', 'int'), ('toxic', 'int')) v(col_name, data_type)")
def s13_describe(spark, sf):
    return spark.createDataFrame(t(spark, sf, "labels").dtypes, "col_name string, data_type string")


@query("SELECT page_id FROM pages WHERE page_id % 2 = 1")
def s16_recursive_glob(spark, sf):
    """A file a page, put by tasks into a bounded number of folders: a folder a page would be made, moved and listed one by one."""
    path = folder(spark, "glob")

    def make(frames):
        import pandas as pd

        fs, at = readers.store(path)
        for f in frames:
            for k in f["page_id"]:
                readers.put(fs, f"{at}/{'tex' if k % 2 == 1 else 'txt'}.d/{k % 509}/page_id={k}.txt", b"x\n")
            yield pd.DataFrame({"n": [len(f)]})

    rows, cores = t(spark, sf, "pages").select("page_id"), spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        rows = rows.repartition(cores)
    rows.mapInPandas(make, "n long").agg(F.sum("n")).collect()
    return readers.listing(spark, f"{path}/tex.d", "*.txt").select(F.regexp_extract("path", r"page_id=(\d+)\.txt$", 1).cast("long").alias("page_id"))


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def k1_create_table_as(spark, sf):
    path = folder(spark, "ctas")
    for _ in range(2):  # replaced, not appended
        t(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_EVENTS = "(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)"


def _slices(spark, sf):
    """Two loads of events: each user's first event, and each second user's second one."""
    e = t(spark, sf, "events").withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return e.where("rn = 1").select("user_id", "event_type", "value"), e.where("rn = 2 and user_id % 2 = 0").select("user_id", F.when(F.col("event_type") != "click", F.col("event_type")).alias("event_type"), "value")


@query(f"SELECT user_id, event_type FROM {_EVENTS} e WHERE rn = 1 OR (rn = 2 AND user_id % 2 = 0) AND FALSE")
def k4_insert_or_ignore(spark, sf):
    cur, new = _slices(spark, sf)
    once = state.insert_or_ignore(cur, new, ["user_id"])
    return state.insert_or_ignore(once, new, ["user_id"]).select("user_id", "event_type")


@query(f"SELECT a.user_id, CASE WHEN b.user_id IS NULL THEN a.event_type WHEN b.event_type <> 'click' THEN b.event_type END AS event_type, a.value FROM (SELECT * FROM {_EVENTS} x WHERE rn = 1) a LEFT JOIN (SELECT * FROM {_EVENTS} x WHERE rn = 2 AND user_id % 2 = 0) b ON a.user_id = b.user_id")
def k5_upsert(spark, sf):
    cur, new = _slices(spark, sf)
    return state.upsert(state.upsert(cur, new, ["user_id"], ["event_type"]), new, ["user_id"], ["event_type"])


@query(f"SELECT a.user_id, b.user_id IS NOT NULL AS ocr_done FROM (SELECT * FROM {_EVENTS} x WHERE rn = 1) a LEFT JOIN (SELECT * FROM {_EVENTS} x WHERE rn = 2 AND user_id % 2 = 0) b ON a.user_id = b.user_id")
def k6_upsert_done(spark, sf):
    cur, new = _slices(spark, sf)
    cur = state.add_column(cur.select("user_id"), "ocr_done", "boolean", False)
    return state.upsert(cur, new.select("user_id", F.lit(True).alias("ocr_done")), ["user_id"], ["ocr_done"])


@query("SELECT user_id, event_type, count(*) AS n FROM events WHERE user_id % 3 <> 0 GROUP BY ALL UNION ALL SELECT user_id, 'none', 0 FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 6 = 0)")
def k7_replace_by_key(spark, sf):
    e = t(spark, sf, "events")
    cur = e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    keys = e.where("user_id % 3 = 0").select("user_id")
    new = e.where("user_id % 6 = 0").select("user_id", F.lit("none").alias("event_type"), F.lit(0).cast("long").alias("n")).distinct()
    return state.replace_by_key(state.replace_by_key(cur, new, keys), new, keys)


@query("SELECT event_type AS topic, event_id FROM events WHERE event_type <> 'click'")
def k8_replace_topic_empty(spark, sf):
    cur = t(spark, sf, "events").select(F.col("event_type").alias("topic"), "event_id")
    return state.replace_by_key(cur, cur.limit(0), spark.createDataFrame([("click",)], "topic string"))


@query("SELECT d.doc_id, l.doc_id IS NOT NULL AS extracted FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def k9_update_flag(spark, sf):
    cur = t(spark, sf, "documents").select("doc_id", F.lit(False).alias("extracted"))
    return state.update_flag(cur, t(spark, sf, "labels").select("doc_id"), "extracted", True)


@query("SELECT doc_id, 0 AS nb_pages FROM documents")
def k10_add_drop_column(spark, sf):
    rows = t(spark, sf, "documents").select("doc_id", "lang")
    return state.add_column(state.add_column(rows, "nb_pages", "int", 0), "nb_pages", "int", 9).drop("lang", "absent")


@query("SELECT 1 AS run_id, 'dump' AS source, CAST(count(*) AS INT) AS n_papers, 0 AS n_files, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS watermark, 'success' AS status FROM orders")
def k17_journal(spark, sf):
    from .schema import INGESTION_RUNS

    papers = t(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("updated_date"))
    runs = state.journal(spark.createDataFrame([], INGESTION_RUNS), papers, "dump", 0, "success", "2026-01-01 00:00:00")
    return runs.select("run_id", "source", "n_papers", "n_files", F.col("watermark").cast("string").alias("watermark"), "status")


@query("SELECT CAST(max(conv_id) + 1 AS INT) AS run_id FROM conversations")
def k12_next_run(spark, sf):
    runs = t(spark, sf, "conversations").select(F.col("conv_id").alias("run_id"))
    return spark.createDataFrame([(state.next_run_id(runs),)], "run_id int")


@query("SELECT page_id, CAST(length(html) AS INT) AS n_chars FROM pages")
def k19_csv_stats(spark, sf):
    path = folder(spark, "csv")
    t(spark, sf, "pages").select("page_id", F.length("html").alias("n_chars")).write.mode("overwrite").csv(path, header=True)
    return spark.read.schema("page_id long, n_chars int").csv(path, header=True)


@query("SELECT CAST(sum(CASE WHEN doc_id % 7 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS ok, CAST(sum(CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS failed, count(*) AS total, 100.0::DOUBLE * sum(CASE WHEN doc_id % 7 <> 0 THEN 1 ELSE 0 END) / count(*) AS success_rate FROM documents")
def k20_summary(spark, sf):
    return audit.summary(t(spark, sf, "documents").select(F.when(F.col("doc_id") % 7 == 0, "failed").otherwise("ok").alias("status")))


# ---- predicates, joins, aggregates by the library's functions


def _topic():
    edge, past = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
    return F.col("text").rlike(f"(?i){edge}(the|de|und){past}[^\\n]{{0,40}}{edge}(of|la|die){past}")


@query(r"SELECT item_id FROM benchmark WHERE regexp_matches(text, '(?i)\b(the|de|und)\b[^\n]{0,40}\b(of|la|die)\b')")
def p11_topic_regex(spark, sf):
    return t(spark, sf, "benchmark").where(_topic()).select("item_id")


@query(r"SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)\b(the|de|und)\b[^\n]{0,40}\b(of|la|die)\b')")
def p11_topic_documents(spark, sf):
    """The topic subset of the whole texts of all documents."""
    return t(spark, sf, "documents").where(_topic()).select("doc_id")


@query("SELECT doc_id, lang || '. ' || text AS text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j4_pending_embeddings(spark, sf):
    papers = t(spark, sf, "documents").select(F.col("doc_id").alias("arxiv_id"), F.col("lang").alias("title"), F.col("text").alias("abstract"))
    return encode.pending(papers, t(spark, sf, "labels").select(F.col("doc_id").alias("arxiv_id"))).withColumnRenamed("arxiv_id", "doc_id")


@query("SELECT doc_id, lang, label FROM embeddings JOIN documents ON vec_id = doc_id WHERE lang IN ('en', 'fr')")
def j3_corpus_slice(spark, sf):
    e = t(spark, sf, "embeddings").select(F.col("vec_id").alias("arxiv_id"), "label")
    p = t(spark, sf, "documents").select(F.col("doc_id").alias("arxiv_id"), F.col("lang").alias("primary_category"))
    return retrieval.corpus_slice(e, p, ["en", "fr"]).select(F.col("arxiv_id").alias("doc_id"), F.col("primary_category").alias("lang"), "label")


@query("SELECT count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j6_orphans(spark, sf):
    return audit.orphans(t(spark, sf, "documents").select("doc_id"), t(spark, sf, "labels"), "doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS done, CAST(sum(CASE WHEN quality = 1 THEN 0 ELSE 1 END) AS BIGINT) AS remaining FROM documents JOIN labels USING (doc_id)")
def j7_done_remaining(spark, sf):
    return audit.done_remaining(t(spark, sf, "documents"), t(spark, sf, "labels"), "doc_id", F.col("quality") == 1)


@query("SELECT md5(text) AS key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def a3_duplicate_keys(spark, sf):
    return audit.duplicate_keys(t(spark, sf, "documents").select(F.md5("text").alias("key")), ["key"])


@query("SELECT doc_id, min(net) AS net FROM (SELECT doc_id, 0 AS net FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 1 FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 2 FROM labels) GROUP BY doc_id")
def a8_first_of_concat(spark, sf):
    y = t(spark, sf, "labels")
    every = y.where("quality = 1").select("doc_id", F.lit(0).alias("net")).unionByName(y.where("toxic = 1").select("doc_id", F.lit(1).alias("net"))).unionByName(y.select("doc_id", F.lit(2).alias("net")))
    return state.first_by(every, ["doc_id"], [F.col("net")])


@query("SELECT conv_id, string_agg('<!-- ===== Page ' || (turn + 1) || ' ===== -->' || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY turn, text) AS md FROM conversations GROUP BY conv_id")
def a13_join_pages(spark, sf):
    return t(spark, sf, "conversations").groupBy("conv_id").agg(text.join_pages(F.col("turn"), F.col("text")).alias("md"))


@query("SELECT doc_id, CAST(c AS BIGINT) AS n_pages, first FROM (SELECT conv_id AS doc_id, count(*) AS c, trim(arg_min(text, (turn, text)), ' ' || chr(9) || chr(10) || chr(13)) AS first FROM conversations GROUP BY 1)")
def f25_split_pages(spark, sf):
    joined = a13_join_pages(spark, sf).withColumn("pages", text.split_pages(F.col("md")))
    return joined.select(F.col("conv_id").alias("doc_id"), F.size("pages").cast("long").alias("n_pages"), F.try_element_at("pages", F.lit(1)).alias("first"))


@query("SELECT user_id, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def w1_latest_record(spark, sf):
    return curate.latest(t(spark, sf, "events").select("user_id", "event_id", "ts"), "user_id", "ts", ["event_id"])


@query("SELECT p_partkey, word, CAST(k AS INT) AS position FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) AS k FROM part)")
def w2_positions(spark, sf):
    return t(spark, sf, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("at", "word")).select("p_partkey", "word", (F.col("at") + 1).alias("position"))


#: Bytes of files of documents whose names one task takes.
NAMES = 8 << 20


def _names(spark, sf) -> DataFrame:
    """Documents as papers whose authors are the words of their whole texts, in pairs."""
    # each pair is one match: arrays that a lambda takes from outside would be computed for each of its elements where a filter is pushed below them
    pairs = F.regexp_extract_all("text", F.lit(r"[^ \t\r\n]+(?:[ \t\r\n]+[^ \t\r\n]+)?"), F.lit(0))
    docs, cores = t(spark, sf, "documents").select("doc_id", "text"), spark.sparkContext.defaultParallelism
    # a task sorts the pairs of all its texts, some ten times their bytes, so its share stays the same however large files and row groups are
    parts = max(cores, -(-storage.size(spark, f"{sf}/documents.parquet") // NAMES))
    if docs.rdd.getNumPartitions() < parts:
        docs = docs.repartition(parts)
    return docs.select(F.col("doc_id").alias("id"), F.transform(pairs, lambda p: F.split(p, r"[ \t\r\n]+")).alias("authors_parsed"))


_AUTHORS = r"""
w AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \t\r\n]+'), lambda x: x <> '') AS words FROM documents),
x AS (SELECT doc_id AS arxiv_id, CAST(k + 1 AS INT) AS position, array_to_string(words[2 * k + 1:2 * k + 2], ' ') AS name_raw FROM (SELECT doc_id, words, unnest(range((len(words) + 1) // 2)) AS k FROM w)),
e AS (SELECT *, strip_accents(lower(name_raw)) AS name_normalized FROM x),
a AS (SELECT row_number() OVER (ORDER BY name_normalized) AS author_id, min(name_raw) AS name_raw, name_normalized FROM e GROUP BY name_normalized)"""


@query(f"WITH {_AUTHORS} SELECT arxiv_id, position, name_raw, name_normalized FROM e")
def f15_author_names(spark, sf):
    return curate.exploded_authors(_names(spark, sf))


@query(f"WITH {_AUTHORS} SELECT author_id, name_raw, name_normalized FROM a")
def w3_author_ids(spark, sf):
    return curate.authors(curate.exploded_authors(_names(spark, sf)))


@query(f"WITH {_AUTHORS} SELECT arxiv_id, author_id, position FROM e JOIN a USING (name_normalized)")
def j1_author_links(spark, sf):
    e = storage.written(curate.exploded_authors(_names(spark, sf)), "authors")
    return curate.paper_authors(e, curate.authors(e))


@query(f"WITH {_AUTHORS} SELECT a.name_raw, count(*) AS n_papers FROM e JOIN a USING (name_normalized) GROUP BY author_id, a.name_raw ORDER BY n_papers DESC, a.name_raw LIMIT 5")
def j2_top_authors(spark, sf):
    e = storage.written(curate.exploded_authors(_names(spark, sf)), "authors")
    names = curate.authors(e)
    return curate.top_authors(curate.paper_authors(e, names), names)


@query("SELECT DISTINCT p_partkey AS arxiv_id, c AS category, c = split_part(p_name, ' ', 1) AS is_primary FROM (SELECT p_partkey, p_name, unnest(string_split(p_name, ' ')) AS c FROM part)")
def f6_categories(spark, sf):
    return curate.paper_categories(t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("categories")))


@query("SELECT category, count(*) AS n FROM (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS category FROM part) GROUP BY category ORDER BY n DESC, category LIMIT 50")
def t1_category_counts(spark, sf):
    c = curate.paper_categories(t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("categories")))
    return c.groupBy("category").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "category").limit(50)


@query("""
WITH r AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, o_orderpriority || ' x' AS categories, o_orderdate AS d FROM orders)
SELECT id AS arxiv_id, title, CAST(CAST(d AS DATE) AS VARCHAR) AS submitted_date, split_part(categories, ' ', 1) AS primary_category, CAST(CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS BIGINT) AS version_count,
       CASE WHEN o_orderkey % 5 = 0 THEN 'https://github.com/a-b/c.' || o_orderkey || '.' END AS github_url, o_orderkey % 5 = 0 AS has_code, o_orderkey % 4 = 0 AS no_version
FROM r""")
def f1_papers(spark, sf):
    o = t(spark, sf, "orders")
    version = F.struct(F.lit("v1").alias("version"), F.concat(F.date_format("o_orderdate", "EEE"), F.lit(", "), F.date_format("o_orderdate", "d MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias("created"))
    raw = o.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("see https://github.com/a-b/c."), F.col("o_orderkey"), F.lit("."))).alias("abstract"),
        F.concat("o_orderpriority", F.lit(" x")).alias("categories"), F.lit(None).cast("string").alias("doi"), F.lit(None).cast("string").alias("comments"), F.lit(None).cast("string").alias("license"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("update_date"), F.when(F.col("o_orderkey") % 4 == 0, F.array().cast("array<struct<version:string,created:string>>")).otherwise(F.array(version)).alias("versions"),
    )
    p = curate.papers(raw)
    return p.select("arxiv_id", "title", F.coalesce("submitted_date", "updated_date").cast("string").alias("submitted_date"), "primary_category", "version_count", "github_url", "has_code", F.col("submitted_date").isNull().alias("no_version"))


@query(r"SELECT page_id, nullif(regexp_extract(coalesce(url, ''), 'https?://[a-z]+\.[a-z]+\.example\.[a-z]+/[A-Za-z0-9_.-]+'), '') AS link FROM pages")
def f7_link_extract(spark, sf):
    got = F.regexp_extract(F.coalesce("url", F.lit("")), r"https?://[a-z]+\.[a-z]+\.example\.[a-z]+/[A-Za-z0-9_.-]+", 0)
    return t(spark, sf, "pages").select("page_id", F.nullif(got, F.lit("")).alias("link"))


# RE2's word border is ASCII, so the SQL takes whole words of letters, marks, digits and joining signs
_VERDICTS = r"SELECT conv_id, turn, coalesce(list_extract(list_filter(regexp_extract_all(lower(trim(text)), '[\p{L}\p{Nl}\p{M}\p{Nd}\p{Pc}\x{200C}\x{200D}]+'), lambda w: w IN ('yes', 'no')), -1) = 'yes', FALSE) AS verdict FROM conversations"


@query(_VERDICTS)
def l4_verdicts(spark, sf):
    return t(spark, sf, "conversations").select("conv_id", "turn", text.verdict(F.col("text")).alias("verdict"))


@query(_VERDICTS)
def l4_verdicts_whole(spark, sf):
    """l4_verdicts under the name it had when that left rows out."""
    return l4_verdicts(spark, sf)


@query("SELECT page_id, regexp_matches(html, '<.+>') AS tagged, regexp_extract(url, '([^/]+)$', 1) AS stem FROM pages")
def f24_tag_test(spark, sf):
    return t(spark, sf, "pages").select("page_id", text.has_tag(F.col("html")).alias("tagged"), text.stem(F.concat("url", F.lit(".html")), "html").alias("stem"))


@query("SELECT vec_id, list_sum([CAST(x AS DOUBLE) * 2 FOR x IN embedding]) AS s, len(embedding) AS dim FROM embeddings")
def f29_numeric_casts(spark, sf):
    e = t(spark, sf, "embeddings")
    as_map = vectors.weights(F.map_from_arrays(F.transform(F.sequence(F.lit(1), F.size("embedding")), lambda k: k.cast("long")), F.transform("embedding", lambda x: x.cast("double"))))
    total = F.aggregate(F.map_values(as_map), F.lit(0.0), lambda s, x: s + x.cast("double") * 2)
    return e.select("vec_id", total.alias("s"), F.size("embedding").cast("long").alias("dim"))


# ---- samples


@query("SELECT doc_id, lang, rn FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || '_seed42'), doc_id) AS rn FROM documents) WHERE rn <= 100")
def w4_stratified_sample(spark, sf):
    return sampling.stratified(t(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", 100)


@query("SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 70")
def t4_newest(spark, sf):
    return t(spark, sf, "documents").select("doc_id", "n_chars").orderBy(F.col("n_chars").desc(), "doc_id").limit(70).select("doc_id")


@query()
def t6_random_rows(spark, sf):
    return sampling.shuffled(t(spark, sf, "documents").select("doc_id"), 20, 42)


@query("SELECT doc_id, quality FROM (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '_seed42'), doc_id) AS rn FROM labels) WHERE rn <= 3")
def l2_few_shot_rows(spark, sf):
    golden = t(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return classify.few_shot_examples(golden, key="doc_id").select("doc_id", F.col("label").alias("quality"))


_GOLDEN = """
WITH a AS (SELECT doc_id, 0 AS src FROM documents WHERE lang = 'fr' ORDER BY md5(doc_id || '_seed42'), doc_id LIMIT 50),
b AS (SELECT doc_id, 1 AS src FROM documents WHERE lang = 'es' OR source = 'src1' ORDER BY md5(doc_id || '_seed42'), doc_id LIMIT 15),
c AS (SELECT doc_id, 2 AS src FROM documents ORDER BY md5(doc_id || '_seed42'), doc_id LIMIT 20)
SELECT doc_id, min(src) AS source, CAST(NULL AS INT) AS label FROM (FROM a UNION ALL FROM b UNION ALL FROM c) GROUP BY doc_id"""


@query(_GOLDEN)
def e4_golden_set(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "lang", "source")
    nets = [d.where("lang = 'fr'").select("doc_id", F.lit(0).alias("source")), d.where("lang = 'es' or source = 'src1'").select("doc_id", F.lit(1).alias("source")), d.select("doc_id", F.lit(2).alias("source"))]
    return sampling.golden_set(*nets, "doc_id")


# ---- retrieval and evaluation

_DENSE = "list_dot_product([CAST(x AS DOUBLE) FOR x IN e.embedding], (SELECT [CAST(x AS DOUBLE) FOR x IN embedding] FROM embeddings WHERE vec_id = 1))"
_SPARSE = """
tok AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM documents) WHERE w <> '' GROUP BY ALL),
q AS (SELECT w, n FROM tok WHERE doc_id = 1),
sp AS (SELECT e.vec_id AS id, coalesce(sum(CAST(tok.n AS DOUBLE) * q.n), 0) AS s FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id LEFT JOIN tok ON tok.doc_id = e.vec_id LEFT JOIN q USING (w) GROUP BY e.vec_id)"""
_HYBRID = f"""
de AS (SELECT e.vec_id AS id, {_DENSE} AS s FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id), {_SPARSE},
dr AS (SELECT id, row_number() OVER (ORDER BY s DESC, id) - 1 AS r FROM de),
sr AS (SELECT id, row_number() OVER (ORDER BY s DESC, id) - 1 AS r FROM sp),
f AS (SELECT dr.id, 1.0::DOUBLE / (60.0::DOUBLE + dr.r + 1) + 1.0::DOUBLE / (60.0::DOUBLE + sr.r + 1) AS hybrid_score FROM dr JOIN sr ON dr.id = sr.id)"""


def _corpus(spark, sf) -> DataFrame:
    """Embedded documents."""
    return t(spark, sf, "embeddings").join(t(spark, sf, "documents"), F.col("vec_id") == F.col("doc_id"))


def _dense(spark, sf) -> DataFrame:
    q = t(spark, sf, "embeddings").where("vec_id = 1").first()["embedding"]
    return retrieval.dense_scores(_corpus(spark, sf), q, "vec_id", "embedding")


def _words(df: DataFrame, key: str) -> DataFrame:
    """Each word of a text, one row an occurrence; a row without words has one of null."""
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: w != "")
    return df.select(key, F.explode_outer(words).alias("w"))


def _sparse(spark, sf) -> DataFrame:
    """Token counts against those of document 1: an occurrence adds the query's count of its token, so one pass and one sum a document."""
    q = _words(t(spark, sf, "documents").where("doc_id = 1"), "doc_id").groupBy("w").agg(F.count(F.lit(1)).cast("double").alias("qn"))
    hit = _words(_corpus(spark, sf).select("vec_id", "text"), "vec_id").join(q, "w", "left")
    return hit.groupBy("vec_id").agg(F.sum(F.coalesce("qn", F.lit(0.0))).alias("score"))


@query(f"SELECT e.vec_id, {_DENSE} AS score FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id")
def r1_dense_scores(spark, sf):
    return _dense(spark, sf)


@query(f"WITH {_SPARSE[1:]} SELECT id AS vec_id, s AS score FROM sp")
def r2_sparse_scores(spark, sf):
    return _sparse(spark, sf)


def _index(spark, sf) -> tuple[str, dict]:
    """An index of the corpus's token counts, and document 1's tokens as a query."""
    path = folder(spark, "index")
    counts = lambda df, key: _words(df, key).where("w is not null").groupBy(key, "w").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    sparse_index.build(counts(_corpus(spark, sf).select("vec_id", "text"), "vec_id").select(F.col("vec_id").alias("key"), F.col("w").alias("token"), "weight"), path)
    return path, {r["w"]: r["weight"] for r in counts(t(spark, sf, "documents").where("doc_id = 1"), "doc_id").collect()}  # one document's tokens


@query(f"WITH {_SPARSE[1:]} SELECT id AS vec_id, s AS score FROM sp WHERE s > 0")
def j10_index_scores(spark, sf):
    return sparse_index.scores(spark, *_index(spark, sf)).select(F.col("key").alias("vec_id"), "score")


@query(f"WITH {_SPARSE[1:]} SELECT id AS vec_id, s AS score FROM sp WHERE s > 0 ORDER BY s DESC, id LIMIT 25")
def j10_index_search(spark, sf):
    return sparse_index.search(spark, *_index(spark, sf), 25)[0].select(F.col("key").alias("vec_id"), "score")


@query("SELECT item_id, CAST(CASE WHEN item_id % 3 = 0 THEN 0 ELSE 0.5 * (1 + item_id % 5) + CASE WHEN item_id % 2 = 0 THEN 0.25 * item_id ELSE 0 END END AS DOUBLE) AS score FROM benchmark")
def r2_sparse_maps(spark, sf):
    k = F.col("item_id")
    doc = F.when(k % 3 == 0, F.create_map().cast("map<int,double>")).when(k % 2 == 0, F.create_map(F.lit(1), (1 + k % 5).cast("double"), F.lit(2), k.cast("double"))).otherwise(F.create_map(F.lit(1), (1 + k % 5).cast("double")))
    rows = t(spark, sf, "benchmark").select("item_id", doc.alias("weights"))
    return retrieval.sparse_scores(rows, {1: 0.5, 2: 0.25, 7: 9.0}, "item_id", "weights")


@query(f"WITH {_HYBRID} SELECT id AS vec_id, hybrid_score FROM f ORDER BY hybrid_score DESC, id LIMIT 25")
def r3_rrf_hybrid(spark, sf):
    return ranking.top_k(retrieval.rrf_fuse(_dense(spark, sf), _sparse(spark, sf), key="vec_id"), "hybrid_score", "vec_id", 25)


_SIZED = """
r AS (SELECT id, hybrid_score, row_number() OVER (ORDER BY hybrid_score DESC, id) - 1 AS rk FROM f),
p AS (SELECT rk, row_number() OVER (ORDER BY rk) AS n, count(*) OVER () AS tot FROM labels JOIN r ON r.id = doc_id WHERE quality = 1),
k AS (SELECT rk + 1 AS top_k FROM p WHERE n = least(ceil(0.97::DOUBLE * tot), tot))"""


@query(f"WITH {_HYBRID}, {_SIZED[1:]} SELECT CAST(top_k AS INT) AS top_k FROM k")
def r4_recommended_size(spark, sf):
    k = retrieval.recommend_top_k(_ranked(spark, sf), _labelled(spark, sf), key="vec_id")
    return spark.createDataFrame([(k,)], "top_k int")


def _ranked(spark, sf) -> DataFrame:
    return retrieval.ranked_corpus(retrieval.rrf_fuse(_dense(spark, sf), _sparse(spark, sf), key="vec_id"), "vec_id")


def _labelled(spark, sf) -> DataFrame:
    return t(spark, sf, "labels").select(F.col("doc_id").alias("vec_id"), F.col("quality").alias("label"))


@query(f"WITH {_HYBRID}, {_SIZED[1:].replace('least(ceil(0.97::DOUBLE * tot), tot)', 'least(ceil(0.97::DOUBLE * tot), tot, greatest(1, floor(tot * 0.8::DOUBLE)))')} SELECT CAST(top_k AS INT) AS top_k FROM k")
def z7_robust_size(spark, sf):
    """The size of r4 with a cap at a quantile of the positives' ranks, so outliers do not blow it up."""
    k = retrieval.recommend_top_k(_ranked(spark, sf), _labelled(spark, sf), key="vec_id", cap=0.8)
    return spark.createDataFrame([(k,)], "top_k int")


@query(f"WITH {_HYBRID}, {_SIZED[1:]} SELECT id AS vec_id, CAST(rk + 1 AS INT) AS rank FROM r, k WHERE rk < top_k")
def r5_sized_candidates(spark, sf):
    """Size and list from one ranking."""
    ranked = _ranked(spark, sf)
    k = retrieval.recommend_top_k(ranked, _labelled(spark, sf), key="vec_id")
    return retrieval.candidates(ranked, k, "vec_id").select("vec_id", "rank")


@query("SELECT doc_id, row_number() OVER (ORDER BY n_chars % 50 DESC, doc_id) - 1 AS rank FROM documents")
def w5_global_rank(spark, sf):
    rows = t(spark, sf, "documents").select("doc_id", (F.col("n_chars") % 50).cast("double").alias("score"))
    return ranking.with_rank(rows, "score", "doc_id").select("doc_id", "rank")


@query("SELECT d.doc_id, p.page_id FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS k FROM documents) d JOIN (SELECT page_id, row_number() OVER (ORDER BY length(html), page_id) AS k FROM pages) p USING (k)")
def j12_zip_rows(spark, sf):
    """Documents by falling size beside pages by rising size, as many of the longer list as of the shorter: places first, then the strict zip."""
    d = ranking.with_position(t(spark, sf, "documents").select("doc_id", "n_chars"), [F.col("n_chars").desc(), F.col("doc_id")], "a")
    p = ranking.with_position(t(spark, sf, "pages").select("page_id", F.length("html").alias("size")), [F.col("size"), F.col("page_id")], "b")
    n = min(d.count(), p.count())
    return ranking.zip_rows(d.where(F.col("a") < n), p.where(F.col("b") < n), [F.col("a")], [F.col("b")]).select("doc_id", "page_id")


@query("SELECT vec_id, score FROM (SELECT e.vec_id, " + _DENSE + " AS score FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id) ORDER BY score DESC, vec_id LIMIT 10")
def t7_top_k(spark, sf):
    return ranking.top_k(_dense(spark, sf), "score", "vec_id", 10)


_CURVE = f"""
s AS (SELECT e.vec_id AS id, {_DENSE} AS score, l.quality AS label FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id JOIN labels l ON l.doc_id = e.vec_id),
k AS (SELECT id, label, row_number() OVER (ORDER BY score DESC, id) AS k FROM s),
c AS (SELECT id, label, k, sum(label) OVER (ORDER BY k) AS hits, sum(label) OVER () AS total FROM k),
v AS (SELECT id AS vec_id, label, k, CAST(hits AS BIGINT) AS hits, CAST(hits AS DOUBLE) / k AS "precision", CAST(hits AS DOUBLE) / nullif(total, 0) AS recall FROM c)"""


def _curve(spark, sf) -> DataFrame:
    y = t(spark, sf, "labels").select(F.col("doc_id").alias("vec_id"), F.col("quality").alias("label"))
    return evaluate.ranking_curve(_dense(spark, sf).join(y, "vec_id"), "vec_id")


@query(f"WITH {_CURVE[1:]} SELECT * FROM v")
def w6_ranking_curve(spark, sf):
    return _curve(spark, sf)


@query(f'WITH {_CURVE[1:]} SELECT round(avg(CASE WHEN label = 1 THEN "precision" END), 9) AS average_precision FROM v')
def e1_average_precision(spark, sf):
    return evaluate.average_precision(_curve(spark, sf)).select(F.round("average_precision", 9).alias("average_precision"))


@query(f'WITH {_CURVE[1:]} SELECT k, "precision", recall FROM v WHERE k IN (10, 20)')
def e1_precision_at_k(spark, sf):
    return evaluate.at_k(_curve(spark, sf), [10, 20])


@query(f'WITH {_CURVE[1:]} SELECT min(k) AS k, arg_min("precision", k) AS "precision" FROM v WHERE recall >= 0.8::DOUBLE')
def e3_precision_at_recall(spark, sf):
    return evaluate.precision_at_recall(_curve(spark, sf), 0.8)


@query("SELECT tp, fp, fn, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS \"precision\", CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall FROM (SELECT CAST(count(*) FILTER (toxic = 1 AND quality = 1) AS BIGINT) AS tp, CAST(count(*) FILTER (toxic = 1 AND quality = 0) AS BIGINT) AS fp, CAST(count(*) FILTER (toxic = 0 AND quality = 1) AS BIGINT) AS fn FROM labels)")
def e2_confusion(spark, sf):
    return evaluate.confusion(t(spark, sf, "labels"), "toxic", "quality")


@query("""
WITH r AS (SELECT label AS query, vec_id, row_number() OVER (PARTITION BY label ORDER BY embedding[1] DESC, vec_id) AS rank FROM embeddings),
b AS (SELECT e.label AS query, min(r.rank) AS best FROM embeddings e JOIN labels l ON l.doc_id = e.vec_id AND l.quality = 1 LEFT JOIN r ON r.query = e.label AND r.vec_id = e.vec_id GROUP BY e.label)
SELECT query, CASE WHEN best <= 5 THEN 1 ELSE 0 END AS recall_at_k, 1.0::DOUBLE / best AS reciprocal_rank FROM b""")
def z4_recall_mrr(spark, sf):
    e = t(spark, sf, "embeddings")
    w = Window.partitionBy("label").orderBy(F.col("embedding")[0].desc(), "vec_id")
    ranked = e.select(F.col("label").alias("query"), "vec_id", F.row_number().over(w).alias("rank"))
    relevant = e.join(t(spark, sf, "labels").where("quality = 1"), F.col("vec_id") == F.col("doc_id")).select(F.col("label").alias("query"), "vec_id")
    return evaluate.recall_mrr(ranked, relevant, "query", "vec_id", 5)


# ---- classification, encoding, documents


@query("SELECT 'Title: ' || lang || chr(10) || 'Abstract: ' || substring(text, 1, 400) || chr(10) || 'Answer: ' || CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END || chr(10) AS block, doc_id FROM documents JOIN labels USING (doc_id)")
def l1_example_text(spark, sf):
    rows = t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id")
    return rows.select("doc_id", classify.example_text(F.col("lang"), F.col("text"), F.col("quality") == 1).alias("block"))


@query("""
WITH x AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '_seed42'), doc_id) AS rn FROM labels)
SELECT string_agg('Title: ' || lang || chr(10) || 'Abstract: ' || substring(text, 1, 400) || chr(10) || 'Answer: ' || CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END || chr(10), chr(10) ORDER BY 1 - quality, doc_id) AS block
FROM x JOIN documents USING (doc_id) WHERE rn <= 3""")
def l1_few_shot_block(spark, sf):
    rows = t(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    some = classify.few_shot_examples(rows, key="doc_id").join(t(spark, sf, "documents").select("doc_id", F.col("lang").alias("title"), F.col("text").alias("abstract")), "doc_id")
    return classify.few_shot_block(some, ["_order", "doc_id"])


@query("SELECT doc_id, 'rubric' || chr(10) || chr(10) || 'block' || chr(10) || chr(10) || 'Title: ' || lang || chr(10) || 'Abstract: ' || substring(text, 1, 800) || chr(10) || 'Reasoning:' AS prompt FROM documents")
def l3_prompts(spark, sf):
    return t(spark, sf, "documents").select("doc_id", classify.prompt(F.lit("rubric"), F.lit("block"), F.col("lang"), F.col("text")).alias("prompt"))


@query("SELECT doc_id, CASE WHEN lang = 'de' THEN NULL ELSE lang = 'en' END AS llm_verdict FROM documents")
def l6_classify(spark, sf):
    def generate():
        def model(prompts):
            if any("Title: de" in p for p in prompts):
                raise RuntimeError("cannot answer")
            return ["reasons. Answer: yes" if "Title: en" in p else "no yes no" for p in prompts]

        return model

    p = t(spark, sf, "documents").select("doc_id", classify.prompt(F.lit(""), F.lit(""), F.col("lang"), F.lit("")).alias("prompt"))
    return classify.classify(p, generate, "doc_id").select("doc_id", "llm_verdict")


@query("SELECT CAST(doc_id AS VARCHAR) AS arxiv_id, 'ok' AS status, 16 AS dim FROM documents")
def r7_embed(spark, sf):
    rows = t(spark, sf, "documents").select(F.col("doc_id").alias("arxiv_id"), "text")
    out = encode.embed(rows, encode.hashing_encoder(16), dim=16)
    return out.select("arxiv_id", "status", F.size("dense_vec").alias("dim"))


def _blocks(spark, sf) -> DataFrame:
    """Conversations as pages: each turn is a block, its kind by its place."""
    label = F.element_at(F.array(*map(F.lit, ["Text", "Page-Header", "Image", "Section", "Blank-Page"])), (F.col("turn") % 5 + 1).cast("int"))
    block = F.struct(F.col("turn"), label.alias("label"), F.when(label == "Image", F.lit("<img>")).otherwise(F.regexp_replace("text", "<", "")).alias("content"), F.array(F.lit(0), F.lit(0), (F.col("turn") % 3).cast("int"), F.lit(10)).alias("bbox"))
    rows = t(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    return rows.withColumn("blocks", F.transform("blocks", lambda b: F.struct(b["label"].alias("label"), b["content"].alias("content"), b["bbox"].alias("bbox"))))


_BLOCKS = "b AS (SELECT conv_id, turn, ['Text', 'Page-Header', 'Image', 'Section', 'Blank-Page'][turn % 5 + 1] AS label, replace(text, '<', '') AS content, row_number() OVER (PARTITION BY conv_id ORDER BY turn, ['Text', 'Page-Header', 'Image', 'Section', 'Blank-Page'][turn % 5 + 1], replace(text, '<', '')) AS k FROM conversations)"


@query(f"WITH {_BLOCKS} SELECT conv_id, coalesce(string_agg(CASE label WHEN 'Text' THEN '<p>' || content || '</p>' WHEN 'Image' THEN '<img src=\"block_' || k || '.webp\">' ELSE content END, '' ORDER BY k) FILTER (label NOT IN ('Blank-Page', 'Page-Header')), '') AS html FROM b GROUP BY conv_id")
def d1_blocks_html(spark, sf):
    return _blocks(spark, sf).select("conv_id", documents.blocks_html(F.col("blocks")).alias("html"))


@query(f"WITH {_BLOCKS} SELECT conv_id, 'block_' || k || '.webp' AS name FROM b WHERE label = 'Image' AND turn % 3 > 0")
def d2_figures(spark, sf):
    return _blocks(spark, sf).select("conv_id", F.explode(documents.figures(F.col("blocks"))).alias("f")).select("conv_id", F.col("f.name").alias("name"))


def _pictures(spark, sf) -> DataFrame:
    """The pages of _blocks with an image each: a grey one of 10 x 12 pixels, whose samples are the page's number and the place."""
    at = F.sequence(F.lit(0), F.lit(119))
    pixels = F.array_join(F.transform(at, lambda k: F.lpad(F.hex(F.pmod(k + F.col("conv_id"), F.lit(256))), 2, "0")), "")
    pages = _blocks(spark, sf).withColumn("image", F.concat(F.lit("P5\n10 12\n255\n").cast("binary"), F.unhex(pixels)))
    return pages.select(F.col("conv_id").alias("arxiv_id"), F.lit(0).alias("page"), "image", "blocks")


@query(f"""WITH {_BLOCKS}, f AS (SELECT conv_id, k, turn % 3 AS wide FROM b WHERE label = 'Image' AND turn % 3 > 0)
SELECT conv_id, 'p_block_' || k || '.webp' AS name, 'P5' || chr(10) || wide || ' 10' || chr(10) || '255' || chr(10) AS head,
  array_to_string(list_transform(range(10 * wide), lambda i: lpad(to_hex((conv_id + 10 * (i // wide) + i % wide) % 256), 2, '0')), '') AS pixels FROM f""")
def d2_figure_crops(spark, sf):
    """Figures are cut out of the pages' images, written, and read back."""
    crops = documents.crop_figures(_pictures(spark, sf), prefix=F.lit("p_"))
    at = folder(spark, "figures")
    saved = storage.written(documents.save_figures(crops, at), "figures")  # so that files are written once
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(at)
    head = F.regexp_extract(F.decode(F.substring("content", 1, 20), "ISO-8859-1"), "^(P5\n[0-9]+ 10\n255\n)", 1)
    found = files.select(F.regexp_extract("path", "/([0-9]+)/[^/]+$", 1).alias("arxiv_id"), F.regexp_extract("path", "([^/]+)$", 1).alias("name"), head.alias("head"), "content")
    both = saved.select("arxiv_id", "name").join(found, ["arxiv_id", "name"], "left")
    return both.select(F.col("arxiv_id").cast("long").alias("conv_id"), "name", "head", F.hex(F.expr("substring(content, length(head) + 1)")).alias("pixels"))


@query()
def d3_markdown(spark, sf):
    return documents.markdown(t(spark, sf, "pages"), "html").select("page_id", "markdown")


def _ocr_load():
    """Turns as pages: a page's text is the digest of its bytes, a figure stands on every fifth, every seventh fails."""

    def one(image):
        if len(image) % 7 == 0:
            return {"raw": None, "token_count": 0, "error": "timeout"}
        figure = '<img src="f.webp">' if len(image) % 5 == 0 else ""
        return {"raw": f"<p>{md5(image).hexdigest()}</p>{figure}", "token_count": len(image), "error": None}

    return lambda images: [one(bytes(i)) for i in images]


def _images(spark, sf) -> DataFrame:
    return t(spark, sf, "conversations").select(F.col("conv_id").alias("arxiv_id"), F.col("turn").alias("page"), F.col("text").cast("binary").alias("image"))


_PAGES = """g AS (SELECT CAST(conv_id AS VARCHAR) AS arxiv_id, CAST(turn AS INT) AS page, CAST(strlen(text) AS INT) AS size, md5(text) AS digest FROM conversations),
o AS (SELECT arxiv_id, page, CASE WHEN size % 7 <> 0 THEN size ELSE 0 END AS n_tokens, CASE WHEN size % 7 = 0 THEN '' WHEN size % 5 = 0 THEN digest || chr(10) || chr(10) || '![](f.webp)' ELSE digest END AS markdown,
  CASE WHEN size % 7 = 0 THEN 'timeout' END AS error, size % 7 <> 0 AND size >= 100 AS truncated FROM g),
s AS (SELECT arxiv_id, page, n_tokens, CAST(length(markdown) AS INT) AS n_chars, CAST(markdown LIKE '%![%' AS INT) AS n_images, markdown, error, truncated FROM o)"""


@query(f"WITH {_PAGES} SELECT * FROM s")
def d6_page_stats(spark, sf):
    return documents.ocr_pages(_images(spark, sf), _ocr_load, 100).drop("raw")


_DONE = "d AS (SELECT arxiv_id, CAST(count(*) AS INT) AS n, bool_or(error IS NOT NULL) AS bad FROM s GROUP BY arxiv_id)"


def _recorded(spark, sf) -> dict[str, DataFrame]:
    """State and statistics after OCR of all conversations but each third, which had older rows; both are committed at once."""
    local = t(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("arxiv_id")).distinct()
    local = local.select("arxiv_id", F.lit("old").alias("ocr_path"), F.lit("old").alias("ocr_model"), F.lit(None).cast("timestamp").alias("ocr_date"), F.lit(0).alias("nb_pages_ocr"), F.lit(False).alias("ocr_done"))
    stats = local.select("arxiv_id", F.lit(99).alias("page"), F.lit(1).alias("n_tokens"), F.lit(0).alias("n_chars"), F.lit(0).alias("n_images"), F.lit("old").alias("error"))
    root = folder(spark, "ocr")
    paths = {name: f"{root}/{name}" for name in ("state", "stats")}
    state.commit({paths["state"]: local, paths["stats"]: stats})
    local, stats = (spark.read.parquet(paths[x]) for x in ("state", "stats"))
    pages, saved = documents.run_ocr(_images(spark, sf).where(F.col("arxiv_id") % 3 != 0), _ocr_load, f"{root}/run", f"{root}/files", 100)
    new = state.record_ocr(local, stats, pages, saved, "stand-in", "2024-01-01")
    state.commit(dict(zip(paths.values(), new, strict=True)))
    return {name: spark.read.parquet(path) for name, path in paths.items()}


@query(f"WITH {_PAGES}, {_DONE} SELECT arxiv_id, CASE WHEN CAST(arxiv_id AS BIGINT) % 3 = 0 THEN 'old' ELSE arxiv_id END AS saved, CASE WHEN CAST(arxiv_id AS BIGINT) % 3 = 0 THEN 0 ELSE n END AS nb_pages_ocr, CAST(arxiv_id AS BIGINT) % 3 <> 0 AND NOT bad AS ocr_done, CASE WHEN CAST(arxiv_id AS BIGINT) % 3 = 0 THEN 'old' ELSE 'stand-in' END AS ocr_model FROM d")
def d8_ocr_state(spark, sf):
    return _recorded(spark, sf)["state"].select("arxiv_id", F.regexp_extract("ocr_path", "([^/]+)$", 1).alias("saved"), "nb_pages_ocr", "ocr_done", "ocr_model")


@query(f"WITH {_PAGES} SELECT arxiv_id, page, n_tokens, n_chars, n_images, error FROM s WHERE CAST(arxiv_id AS BIGINT) % 3 <> 0 UNION ALL SELECT DISTINCT arxiv_id, 99, 1, 0, 0, 'old' FROM s WHERE CAST(arxiv_id AS BIGINT) % 3 = 0")
def d8_ocr_stats(spark, sf):
    return _recorded(spark, sf)["stats"]


@query("SELECT DISTINCT CAST(conv_id AS VARCHAR) AS arxiv_id FROM conversations WHERE conv_id % 4 <> 1")
def o6_skip_finished(spark, sf):
    """Documents with a finished markdown file are not queued again; an html file alone does not count."""
    at = folder(spark, "finished")
    ids = t(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("arxiv_id")).distinct()
    some = ids.where(F.col("arxiv_id").cast("long") % 4 == 1).select("arxiv_id", F.lit("<p>x</p>").alias("html"), F.lit("x").alias("md"), F.lit(1).alias("nb_pages_ocr"), F.lit(False).alias("has_error"))
    documents.save_documents(some, at).count()
    documents.atomic_write(f"{at}/2/2.html", "no markdown yet")
    return documents.ocr_queue(ids, readers.finished(spark, at))


@query("SELECT CAST(doc_id AS VARCHAR) AS arxiv_id, CASE WHEN doc_id % 2 = 0 THEN 'old' ELSE 'new' END AS embed_model, CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 16 END AS dim FROM documents WHERE doc_id % 2 = 0 OR coalesce(text, '') NOT LIKE '%the%'")
def r9_embed_pending(spark, sf):
    """Papers without an embedding get one; those whose batch fails stay out and are pending still."""
    papers = t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("arxiv_id"), F.lit("t").alias("title"), F.coalesce("text", F.lit("")).alias("abstract"), "lang")
    old = papers.where(F.col("arxiv_id").cast("long") % 2 == 0).select("arxiv_id", F.array().cast("array<float>").alias("dense_vec"), F.lit(None).cast("map<int,float>").alias("sparse_weights"), F.lit("old").alias("embed_model"), F.lit(None).cast("timestamp").alias("embed_date"))

    def load():
        encode_all = encode.hashing_encoder(16)()

        def one(texts):
            if any("the" in x for x in texts):
                raise ValueError("stand-in failure")
            return encode_all(texts)

        return one

    table, _ = encode.embed_pending(papers, old, load, "new", batch_size=1, dim=16)
    return table.select("arxiv_id", "embed_model", F.size("dense_vec").alias("dim"))


@query("SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE lang = 'en' AND CASE WHEN quality = 1 THEN source END IS NOT NULL")
def d7_paths_for_keyword(spark, sf):
    rows = t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id").select("doc_id", F.col("lang").alias("keyword_for_ocr"), F.when(F.col("quality") == 1, F.col("source")).alias("pdf_path"))
    return fetch.paths_for_keyword(rows, "en", "doc_id").select("doc_id")


@query("SELECT d.doc_id FROM documents d LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 1) s ON d.doc_id = s.doc_id WHERE s.doc_id IS NULL")
def j5_pending_fetch(spark, sf):
    local = t(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "x").alias("pdf_path"))
    return fetch.pending(t(spark, sf, "documents").select("doc_id"), local, "doc_id")


@query("SELECT CAST(doc_id AS VARCHAR) AS arxiv_id, source AS latex_source_path FROM documents JOIN labels USING (doc_id) WHERE source IS NOT NULL AND quality = 0")
def j8_extraction_rows(spark, sf):
    rows = t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id")
    return fetch.extraction_queue(rows.select(F.col("doc_id").cast("string").alias("arxiv_id"), F.col("source").alias("latex_source_path"), (F.col("quality") == 1).alias("latex_extracted")))


@query("SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'no flag' ELSE 'no file' END AS problem FROM documents WHERE (doc_id % 2 = 0) <> (doc_id IN (SELECT doc_id FROM labels))")
def o10_audit(spark, sf):
    flagged = t(spark, sf, "documents").where("doc_id % 2 = 0").select("doc_id")
    return audit.disagreement(flagged, t(spark, sf, "labels").select("doc_id"), "doc_id")


@query()
def z1_chunks(spark, sf):
    md = documents.markdown(t(spark, sf, "pages"), "html").select("page_id", "markdown")
    named = md.join(t(spark, sf, "pages").select("page_id", F.regexp_extract("url", "([^/]*)$", 1).alias("title")), "page_id")
    return chunks.chunk_documents(named, "page_id", "markdown", 64, 128, title="title")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def z2_pending_chunks(spark, sf):
    cut = t(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, chunks.VERSION).otherwise("v0").alias("chunker_version"))
    return chunks.pending_documents(t(spark, sf, "documents").select("doc_id"), cut, "doc_id")


@query("SELECT event_id FROM events WHERE ts > (SELECT max(ts) - INTERVAL 2 DAY FROM events)")
def x1_past_watermark(spark, sf):
    from ..streaming import incremental

    e = t(spark, sf, "events")
    mark = e.agg((F.max("ts") - F.expr("INTERVAL 2 DAY")).alias("m")).first()["m"]
    return incremental.newer_than(e, "ts", mark).select("event_id")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1")
def x2_incremental_load(spark, sf):
    from ..streaming import incremental

    root = folder(spark, "stream")
    e = t(spark, sf, "events").select("user_id", "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"))
    schema = e.schema
    newest = F.concat("at", F.lpad(F.lit(1_000_000_000) - F.col("event_id"), 12, "0"))
    for half in (0, 1):
        e.where(F.col("event_id") % 2 == half).withColumn("at", newest).write.mode("append").json(f"{root}/in")
        incremental.load_new(spark, f"{root}/in", schema, f"{root}/table", f"{root}/checkpoint", ["user_id"], "at")
    return incremental.merged_table(spark, f"{root}/table").select("user_id", "event_id")


# ---- appends, digests, chunk embeddings


@query("SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 1")
def k3_insert_select(spark, sf):
    path = folder(spark, "insert")
    rows = t(spark, sf, "documents").select("doc_id", "lang")
    for half in (0, 1):
        rows.where(F.col("doc_id") % 2 == half).write.mode("append").parquet(path)
    out = spark.read.schema(rows.schema).parquet(path)
    state.require_unique(out, ["doc_id"])
    return out


@query("SELECT doc_id, lang, coalesce(source, 'unknown') AS source, FALSE AS has_code FROM documents")
def k2_checked_write(spark, sf):
    """A table under a contract: types, defaults, a key without repeats or nulls."""
    path = f"{folder(spark, 'contract')}/documents"
    kind = schema.of("doc_id bigint, lang string, source string, has_code boolean")
    state.write_checked(t(spark, sf, "documents"), path, kind, ["doc_id"], {"source": "unknown", "has_code": False})
    return spark.read.parquet(path)


@query("SELECT 'orders' AS name, (SELECT CAST(count(*) - count(DISTINCT o_custkey) AS INT) FROM orders) AS repeated UNION ALL SELECT 'lineitem', (SELECT CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS INT) FROM lineitem) UNION ALL SELECT 'events', (SELECT CAST(count(*) - count(DISTINCT user_id) AS INT) FROM events)")
def k2_breaches(spark, sf):
    """Writes whose key is none are refused, with the number of rows that repeat one; the key of lineitem holds."""
    root, found = folder(spark, "breach"), []
    for name, key in (("orders", ["o_custkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("events", ["user_id"])):
        rows = t(spark, sf, name)
        try:
            state.write_checked(rows, f"{root}/{name}", rows.schema, key)
            found.append((name, 0))
        except state.Breach as e:
            found.append((name, e.repeated))
    return spark.createDataFrame(found, "name string, repeated int")


@query("SELECT doc_id, quality AS label FROM labels")
def k13_labelled_set(spark, sf):
    path = folder(spark, "golden")
    t(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("SELECT lang, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM documents GROUP BY lang")
def a13_ordered_strings(spark, sf):
    return t(spark, sf, "documents").groupBy("lang").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


@query(f"SELECT vec_id, score FROM (SELECT e.vec_id, {_DENSE} AS score FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)) ORDER BY score DESC, vec_id LIMIT 20")
def z6_digest(spark, sf):
    """New documents that no earlier digest held, nearest to an interest vector first."""
    new = audit.orphans(_dense(spark, sf), t(spark, sf, "labels").select(F.col("doc_id").alias("vec_id")), "vec_id")
    return ranking.top_k(new, "score", "vec_id", 20)


@query()
def z3_chunk_embeddings(spark, sf):
    cut = storage.written(z1_chunks(spark, sf).select(F.concat_ws("#", "page_id", "chunk_index").alias("arxiv_id"), "page_id", "section", F.col("content").alias("text")), "chunks")  # both sides of the join read it
    vectors_of = encode.embed(cut.select("arxiv_id", "text"), encode.hashing_encoder(8), dim=8).select("arxiv_id", "dense_vec", "status")
    payload = cut.join(t(spark, sf, "pages").select("page_id", "url"), "page_id").select("arxiv_id", "page_id", "section", "url")
    return vectors_of.join(payload, "arxiv_id").select("arxiv_id", "page_id", "section", "url", F.size("dense_vec").alias("dim"), "status")


@query("SELECT doc_id, CASE WHEN n_chars >= 4000 THEN 'truncated' ELSE 'whole' END AS kind FROM documents")
def d11_truncation_flag(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") >= 4000, "truncated").otherwise("whole").alias("kind"))


@query("SELECT DISTINCT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) OVER (PARTITION BY event_type, CAST(ts AS DATE)) AS n FROM events")
def x3_daily_counts(spark, sf):
    from ..streaming import incremental

    out = incremental.event_counts(t(spark, sf, "events"))
    return out.select("event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), "n")
