"""Places by ranges, merges by buckets, commits that break off, and model work that is done once."""

import os

import pytest
from pyspark.sql import functions as F

from quillspark import storage
from quillspark.operators import chunks, curate, documents, ranking, state
from quillspark.sources import readers
from quillspark.streaming import incremental


def sizes_of_ranges(monkeypatch):
    """Row counts of the ranges that with_position makes."""
    seen = []
    real = storage.written

    def spy(df, name):
        out = real(df, name)
        if name == "position":
            seen.append([r["count"] for r in out.groupBy(F.shiftright("_id", 33)).count().collect()])
        return out

    monkeypatch.setattr(storage, "written", spy)
    return seen


def test_keys_that_begin_alike_with_one_score_spread(spark, monkeypatch):
    seen = sizes_of_ranges(monkeypatch)
    d = spark.range(40_000).select(F.format_string("arxiv:2301.%05d", F.pmod(F.col("id") * 7919, F.lit(40_000))).alias("k"), F.when(F.col("id") % 100 == 0, F.col("id").cast("double")).otherwise(1.0).alias("s"))
    out = ranking.with_rank(d, "s", "k", parts=16)
    want = {k: i for i, (k, _) in enumerate(sorted(((r["k"], r["s"]) for r in d.collect()), key=lambda r: (-r[1], r[0])))}
    assert {r["k"]: r["rank"] for r in out.collect()} == want
    assert len(seen[0]) == 16 and max(seen[0]) < 2 * 40_000 / 16


def test_names_that_begin_alike_get_ids_in_bounded_tasks(spark, monkeypatch):
    seen = sizes_of_ranges(monkeypatch)
    d = spark.range(20_000).select(F.format_string("Müller %06d", F.col("id")).alias("name_raw"), F.format_string("muller %06d", F.col("id")).alias("name_normalized"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [(r["author_id"], r["name_normalized"]) for r in curate.authors(d).orderBy("author_id").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == [(k + 1, f"muller {k:06d}") for k in range(20_000)]
    assert max(seen[0]) < 2 * 20_000 / len(seen[0]) and len(seen[0]) > 1


def test_places_with_nulls_nan_and_no_rows(spark):
    d = spark.createDataFrame([("a", None), ("b", float("nan")), ("c", 1.0), (None, 1.0), ("d", 2.0)], "k string, s double")
    assert [r["k"] for r in ranking.with_rank(d, "s", "k").orderBy("rank").collect()] == ["d", "c", None, "a", "b"]
    assert ranking.with_rank(d.limit(0), "s", "k").count() == 0


def test_chunks_are_given_on_in_pieces(spark, monkeypatch):
    """A batch of documents is not held as one table of chunks, and chunks that two sides read are cut once."""
    from types import SimpleNamespace

    import pandas as pd

    md = "\n\n".join(f"# h{k}\n\n" + "word " * 100 for k in range(50))
    seen = []
    fake = SimpleNamespace(dtypes=[("k", "bigint"), ("md", "string")], select=lambda *c: SimpleNamespace(mapInPandas=lambda run, schema: seen.append(run)))
    monkeypatch.setattr(chunks, "PIECE", 10_000)
    chunks.chunk_documents(fake, "k", "md", 64, 128)
    got = list(seen[0]([pd.DataFrame({"k": [1, 2], "md": [md, md]})]))
    assert max(sum(map(len, f["text"])) + sum(map(len, f["content"])) for f in got) < 12_000
    want = [(k, i, c["text"]) for k in (1, 2) for i, c in enumerate(chunks.split_markdown(md, 64, 128))]
    assert [tuple(r) for f in got for r in f[["k", "chunk_index", "text"]].itertuples(index=False)] == want


def test_globbed_files_stand_in_a_bounded_number_of_folders(spark, tmp_path, monkeypatch):
    from quillspark.plans import queries

    spark.range(3000).select(F.col("id").alias("page_id")).write.parquet(f"file://{tmp_path}/pages.parquet")
    monkeypatch.setattr(queries, "folder", lambda spark, name: f"file://{tmp_path}/{name}")
    got = sorted(r["page_id"] for r in queries.s16_recursive_glob(spark, f"file://{tmp_path}").collect())
    assert got == list(range(1, 3000, 2))
    assert sum(len(d) for _, d, _ in os.walk(f"{tmp_path}/glob")) <= 2 * 509 + 2


def test_names_are_cut_in_bounded_tasks(spark, tmp_path, monkeypatch):
    from quillspark.plans import queries

    spark.range(500).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "NAMES", storage.size(spark, f"file://{tmp_path}/documents.parquet") // 20)
    assert queries._names(spark, f"file://{tmp_path}").rdd.getNumPartitions() >= 20


def test_ascii_letters_are_not_looked_up(spark):
    from quillspark.functions import text

    rows = spark.createDataFrame([("Plain",), ("Édouard",), ("e\u0301",), (None,), ("",)], "s string")
    out = rows.select(text.strip_accents(F.col("s")).alias("s"))
    assert [r["s"] for r in out.collect()] == ["Plain", "Edouard", "e", None, ""]
    assert "octet_length" in out._jdf.queryExecution().optimizedPlan().toString()


def test_zip_is_strict(spark):
    a, b = spark.range(100).select(F.col("id").alias("x")), spark.range(100).select((F.col("id") * 3).alias("y"))
    got = ranking.zip_rows(a, b, [F.col("x").desc()], [F.col("y")])
    assert {(r["x"], r["y"]) for r in got.collect()} == {(99 - k, 3 * k) for k in range(100)}
    with pytest.raises(ValueError, match="100 rows on the left, 99 on the right"):
        ranking.zip_rows(a, b.where("y > 0"), [F.col("x")], [F.col("y")])


def files_of(path):
    return {os.path.join(r, f): os.stat(os.path.join(r, f)).st_mtime_ns for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def load(spark, tmp_path, rows, name):
    spark.createDataFrame(rows, "k long, v string, at long").write.mode("append").json(f"file://{tmp_path}/in")
    incremental.load_new(spark, f"file://{tmp_path}/in", spark.createDataFrame([], "k long, v string, at long").schema, f"file://{tmp_path}/table", f"file://{tmp_path}/checkpoint", ["k"], "at", buckets=16)
    return {r["k"]: r["v"] for r in incremental.merged_table(spark, f"file://{tmp_path}/table").collect()}


def test_a_batch_rewrites_its_buckets_alone(spark, tmp_path):
    want = {k: f"a{k}" for k in range(200)}
    assert load(spark, tmp_path, [(k, v, 1) for k, v in want.items()], "one") == want
    before = files_of(f"{tmp_path}/table")
    want |= {7: "b7", 1000: "b1000"}
    assert load(spark, tmp_path, [(7, "b7", 2), (1000, "b1000", 2), (8, "stale", 0)], "two") == want
    after = files_of(f"{tmp_path}/table")
    hit = {r[0] for r in incremental._bucketed(spark.createDataFrame([(7,), (1000,), (8,)], "k long"), ["k"], 16).select("_bucket").collect()}
    bucket = lambda f: int(f.split("_bucket=")[1].split("/")[0])
    assert {f: m for f, m in before.items() if bucket(f) not in hit} == {f: m for f, m in after.items() if bucket(f) not in hit}
    assert {bucket(f) for f in before} == set(range(16)) and all(f not in after for f in before if bucket(f) in hit)


def test_a_batch_that_broke_off_is_finished(spark, tmp_path, monkeypatch):
    assert load(spark, tmp_path, [(k, "a", 1) for k in range(50)], "one") == dict.fromkeys(range(50), "a")
    real = storage.delete
    monkeypatch.setattr(storage, "delete", lambda *a: (_ for _ in ()).throw(OSError("lost driver")))  # after the table was written, before the batch counts as done
    with pytest.raises(Exception):
        load(spark, tmp_path, [(1, "b", 2), (99, "b", 2)], "two")
    monkeypatch.setattr(storage, "delete", real)
    os.remove(next(iter(files_of(f"{tmp_path}/table"))))  # and as if the move had lost a bucket's file halfway
    got = load(spark, tmp_path, [(2, "c", 3)], "three")
    assert got[1] == "b" and got[99] == "b" and got[2] == "c"


def test_commits_of_two_tables_are_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    a, b = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    table = lambda x: spark.createDataFrame([(x,)], "v long").coalesce(1)
    read = lambda: [spark.read.parquet(p).first()["v"] for p in (a, b)]
    state.commit({a: table(1), b: table(1)})
    bad = table(2).select(F.raise_error(F.lit("lost")).cast("long").alias("v"))
    with pytest.raises(Exception):
        state.commit({a: table(2), b: bad})  # the second table is never written
    assert read() == [1, 1]
    monkeypatch.setattr(state, "recover", lambda *x: None)
    state.commit({a: table(3), b: table(3)})  # breaks off before the swap
    monkeypatch.undo()
    os.rename(f"{tmp_path}/a", f"{tmp_path}/a.old")  # or even in the middle of it
    state.recover(spark, a)
    assert read() == [3, 3] and sorted(x for x in os.listdir(tmp_path) if not x.startswith(".")) == ["a", "b"]


def test_archives_of_dotted_ids_keep_their_files(spark, tmp_path):
    import io
    import tarfile

    for name, body in (("2301.00001", b"one"), ("2301.00002", b"two"), ("old/2301.00001", b"three"), ("v1.2%2Fx", b"four")):
        os.makedirs(os.path.dirname(f"{tmp_path}/src/{name}"), exist_ok=True)
        with tarfile.open(f"{tmp_path}/src/{name}.tar.gz", "w:gz") as tar:
            for member in ("paper.tex", "../evil.tex"):
                info = tarfile.TarInfo(member)
                info.size = len(body)
                tar.addfile(info, io.BytesIO(body))
    got = storage.written(readers.extract(spark, f"{tmp_path}/src", f"file://{tmp_path}/out"), "x").collect()
    assert all(r["status"] == "ok" and r["n_files"] == 1 and r["has_tex"] for r in got) and len({r["folder"] for r in got}) == 4
    found = {os.path.relpath(os.path.join(r, f), f"{tmp_path}/out"): open(os.path.join(r, f), "rb").read() for r, _, fs in os.walk(f"{tmp_path}/out") for f in fs if f.endswith(".tex")}
    assert found == {"2301.00001/paper.tex": b"one", "2301.00002/paper.tex": b"two", "old%2F2301.00001/paper.tex": b"three", "v1.2%252Fx/paper.tex": b"four"}


def test_each_page_meets_the_ocr_once(spark, tmp_path):
    """50 pages, 50 calls, whatever reads the tables; a run that broke off takes its pages from what it wrote."""
    calls = spark.sparkContext.accumulator(0)

    def load():
        def ocr(images):
            calls.add(len(images))
            return [{"raw": "<p>x</p>", "token_count": 1, "error": "bad" if bytes(i) == b"7" else None} for i in images]

        return ocr

    images = spark.createDataFrame([(str(k % 10), k // 10, str(k).encode()) for k in range(50)], "arxiv_id string, page int, image binary")
    local = spark.createDataFrame([("0", "old", 0, False, "m", None), ("x", "old", 1, True, "m", None)], "arxiv_id string, ocr_path string, nb_pages_ocr int, ocr_done boolean, ocr_model string, ocr_date timestamp")
    stats = spark.createDataFrame([("0", 99, 1, 1, 0, None), ("x", 0, 1, 1, 0, None)], "arxiv_id string, page int, n_tokens int, n_chars int, n_images int, error string")
    for _ in range(2):
        pages, saved = documents.run_ocr(images, load, f"file://{tmp_path}/run", f"file://{tmp_path}/files")
        tables = state.record_ocr(local, stats, pages, saved, "new")
        state.commit({f"file://{tmp_path}/state": tables[0], f"file://{tmp_path}/stats": tables[1]})
    assert calls.value == 50
    done = {r["arxiv_id"]: r["ocr_done"] for r in spark.read.parquet(f"{tmp_path}/state").collect()}
    assert done == {str(k): k != 7 for k in range(10)} | {"x": True}
    assert spark.read.parquet(f"{tmp_path}/stats").groupBy().agg(F.count("*"), F.sum((F.col("page") == 99).cast("int"))).first() == (51, 0)


def test_index_scores_and_searches_are_those_of_brute_force(spark, tmp_path):
    import random

    from quillspark.operators import sparse_index

    rng = random.Random(3)
    docs = {k: {f"t{t}": float(rng.choice([1, 1, 1, 2, 3, 50])) for t in rng.sample(range(40), rng.randint(0, 12))} | ({"hot": 1.0} if k % 3 else {}) for k in range(2000)}
    rows = [(k, t, w) for k, d in docs.items() for t, w in d.items()] + [(1, "zero", 0.0), (None, "t1", 1.0), (2, None, 1.0)]
    path = f"file://{tmp_path}/index"
    sparse_index.build(spark.createDataFrame(rows, "key long, token string, weight double").repartition(4), path)
    for query in ({"t1": 1.0, "t2": 0.5, "hot": 0.25}, {"hot": 1.0}, {"t3": 2.0, "absent": 1.0, "t4": 0.0}, {"absent": 1.0}, {}):
        want = sorted(((k, sum(query[t] * w for t, w in d.items() if t in query)) for k, d in docs.items()), key=lambda x: (-x[1], x[0]))
        want = [(k, s) for k, s in want if s > 0]
        assert sorted(map(tuple, sparse_index.scores(spark, path, query).collect())) == sorted(want)
        for k in (1, 10, 100_000):
            assert [tuple(r) for r in sparse_index.search(spark, path, query, k)[0].collect()] == want[:k]
    with pytest.raises(ValueError):
        sparse_index.search(spark, path, {"t1": -1.0}, 3)
    with pytest.raises(Exception, match="negative"):
        sparse_index.build(spark.createDataFrame([(1, "a", -1.0)], "key long, token string, weight double"), f"{path}2")


def test_search_leaves_lists_unread(spark, tmp_path, monkeypatch):
    from quillspark.operators import sparse_index

    monkeypatch.setattr(sparse_index, "FIRST", 50)
    rare = spark.range(40).select(F.col("id").alias("key"), F.lit("rare").alias("token"), (F.lit(100.0) + F.col("id")).alias("weight"))
    hot = spark.range(20_000).select(F.col("id").alias("key"), F.lit("hot").alias("token"), F.when(F.col("id") % 5000 == 7, 8.0).otherwise(1.0).alias("weight"))
    path = f"file://{tmp_path}/index"
    sparse_index.build(rare.unionAll(hot), path)
    best, took = sparse_index.search(spark, path, {"rare": 1.0, "hot": 1.0}, 5)
    assert [tuple(r) for r in best.collect()] == [(39, 140.0), (38, 139.0), (37, 138.0), (36, 137.0), (35, 136.0)]
    assert took["all"] == 20_040 and took["read"] < 100
