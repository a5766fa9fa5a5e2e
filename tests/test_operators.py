"""Unit cases of the operators: expectations of the reference's tests, ties, nulls and replays."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quillspark.functions import text, vectors
from quillspark.operators import chunks, classify, curate, documents, encode, evaluate, ranking, retrieval, sampling, state
from quillspark.plans import flows, schema
from quillspark.sources import fetch, readers
from quillspark.streaming import incremental


def one(df):
    return df.first()[0]


def test_dense_and_sparse_scores(spark):
    d = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [0.5, 0.5])], "arxiv_id string, dense_vec array<float>")
    assert {r[0]: r[1] for r in retrieval.dense_scores(d, [1.0, 0.0]).collect()} == {"a": 1.0, "b": 0.0, "c": 0.5}
    s = spark.createDataFrame([("a", {1: 1.0}), ("b", {2: 1.0}), ("c", {})], "arxiv_id string, sparse_weights map<int,double>")
    assert {r[0]: r[1] for r in retrieval.sparse_scores(s, {1: 0.5, 2: 0.3}).collect()} == {"a": 0.5, "b": 0.3, "c": 0.0}
    assert {r[1] for r in retrieval.sparse_scores(s, {}).collect()} == {0.0}


def scores(spark, values):
    return spark.createDataFrame([(f"p{i}", float(v)) for i, v in enumerate(values)], "arxiv_id string, score double")


def test_fusion_depends_on_ranks_only(spark):
    a, b = [0.9, 0.5, 0.1], [0.8, 0.6, 0.05]
    f = lambda x, y: {r[0]: r[1] for r in retrieval.rrf_fuse(scores(spark, x), scores(spark, y)).collect()}
    got = f(a, b)
    assert got["p0"] > got["p1"] > got["p2"] and got["p0"] == pytest.approx(2 / 61)
    assert f([100 * x for x in a], b) == got


def fused(spark):
    return spark.createDataFrame([(f"p{i}", 0.9 - 0.05 * i) for i in range(10)], "arxiv_id string, hybrid_score double")


@pytest.mark.parametrize(("gold", "target", "want"), [([("p0", 1), ("p9", 1)], 1.0, 10), ([("p0", 1), ("p1", 1), ("p2", 1), ("p9", 1)], 0.75, 3), ([("p1", 1), ("zz", 1)], 0.97, 2), ([("p1", 0), ("p3", 1)], 0.97, 4)])
def test_recommended_size(spark, gold, target, want):
    assert retrieval.recommend_top_k(fused(spark), spark.createDataFrame(gold, "arxiv_id string, label int"), target) == want


def test_recommended_size_needs_a_positive(spark):
    with pytest.raises(ValueError):
        retrieval.recommend_top_k(fused(spark), spark.createDataFrame([("p1", 0)], "arxiv_id string, label int"))


def test_rank_with_many_ties_and_nan(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([0.0, 0.0, 0.0, 1.0, 2.5, rnd.random()])) for i in range(3000)] + [(3000, float("nan")), (3001, None)]
    got = {r["id"]: r["rank"] for r in ranking.with_rank(spark.createDataFrame(rows, "id long, s double"), "s", "id").collect()}
    bad = lambda s: s is None or s != s
    want = sorted(rows, key=lambda r: (bad(r[1]), 0 if bad(r[1]) else -r[1], r[0]))
    assert got == {r[0]: k for k, r in enumerate(want)}


def test_curve_and_recall(spark):
    y = spark.createDataFrame([("a", 0.9, 1), ("b", 0.8, 0), ("c", 0.7, 1), ("d", 0.1, 0)], "id string, score double, label int")
    c = evaluate.ranking_curve(y, "id")
    assert one(evaluate.average_precision(c)) == pytest.approx((1 + 2 / 3) / 2)
    assert evaluate.precision_at_recall(c, 1.0).first()[0] == 3
    assert evaluate.precision_at_recall(c.where("label = 9"), 1.0).first()[0] is None


def test_insert_or_ignore_joins_no_union(spark):
    """A chain of loads joins no union: on larger tables Spark could not zip its partitions."""
    cur, inc = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v long"), spark.createDataFrame([("a", 9, "x"), ("b", 4, "y"), (None, 5, "z")], "k string, v int, w string")
    once = state.insert_or_ignore(cur, inc, ["k"])
    assert once.dtypes == [("k", "string"), ("v", "bigint"), ("w", "string")]
    assert sorted(map(tuple, once.collect()), key=str) == sorted([("a", 1, None), ("a", 2, None), (None, 3, None), ("b", 4, "y"), (None, 5, "z")], key=str)
    twice = state.insert_or_ignore(once, inc.where("k is not null"), ["k"])
    assert "Union" not in twice._jdf.queryExecution().optimizedPlan().toString() and twice.count() == 5


def test_insert_or_ignore_keeps_the_first(spark):
    cur = spark.createDataFrame([("a", 1)], "k string, v int")
    inc = spark.createDataFrame([("a", 2), ("b", 3), ("b", 4)], "k string, v int")
    once = state.insert_or_ignore(cur, inc, ["k"])
    assert {tuple(r) for r in once.collect()} == {("a", 1), ("b", 3)}
    assert {tuple(r) for r in state.insert_or_ignore(once, inc, ["k"]).collect()} == {("a", 1), ("b", 3)}


def test_upsert_takes_nulls_and_keeps_other_columns(spark):
    cur = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    inc = spark.createDataFrame([("a", None), ("c", 5)], "k string, v int")
    got = {tuple(r) for r in state.upsert(cur, inc, ["k"], ["v"]).collect()}
    assert got == {("a", None, "x"), ("b", 2, "y"), ("c", 5, None)}


def test_replace_by_key_clears_without_new_rows(spark):
    cur = spark.createDataFrame([("t", 1), ("u", 2)], "k string, v int")
    assert [tuple(r) for r in state.replace_by_key(cur, cur.limit(0), cur.where("k = 't'").select("k")).collect()] == [("u", 2)]


def test_unique_and_commit(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    with pytest.raises(ValueError):
        state.require_unique(df, ["k"])
    path = f"file://{tmp_path}/t"
    state.commit({path: df})
    state.commit({path: spark.read.parquet(path).distinct()})  # from itself
    assert spark.read.parquet(path).count() == 1


def test_verdicts(spark):
    said = ["Answer: yes.", "tricky. no", "I cannot determine this.", "YES!", "yes, or rather no", "nothing known", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in said], "t string").select(text.verdict(F.col("t"))).collect()]
    assert got == [True, False, False, True, False, False, False]


def test_text_functions(spark):
    d = spark.createDataFrame([("François Øß", "see https://github.com/a/b-c.d. x", "Mon, 2 Apr 2007 19:18:42 GMT")], "a string, u string, d string")
    r = d.select(text.strip_accents(F.col("a")), text.link(F.col("u"), F.lit(None).cast("string")), text.mail_date(F.col("d")).cast("string"), text.link(F.lit("none"))).first()
    assert tuple(r) == ("Francois Øß", "https://github.com/a/b-c.d.", "2007-04-02", None)
    m = spark.createDataFrame([("<!-- ===== Page 1 ===== -->\n\n a \n\n<!-- ===== Page 2 ===== -->\n\nb", "<b\r>", "x")], "m string, t string, n string")
    assert m.select(text.split_pages(F.col("m"))).first()[0] == ["a", "b"]
    assert tuple(m.select(text.has_tag(F.col("t")), text.has_tag(F.col("n")), F.size(text.split_pages(F.col("n")))).first()) == (True, False, 0)
    assert spark.range(1).select(vectors.dot(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(4.0)))).first()[0] == 11.0


RAW = [
    ("1", "old", "a", "cs.LG cs.CL", None, None, None, "2020-01-01", [("v1", "Mon, 2 Apr 2007 19:18:42 GMT")], [["Müller", "K", ""]]),
    ("1", "new", None, "cs.LG  cs.LG", None, "https://github.com/x/y", None, "2021-01-01", [("v1", "Mon, 2 Apr 2007 19:18:42 GMT"), ("v2", "x")], [["Muller", "K", ""], ["Li", "A"]]),
    ("2", "t", "b", "cs.CV", None, None, None, "2019-05-05", [], []),
]


def test_curation_flow(spark):
    out = flows.build_corpus(spark.createDataFrame(RAW, schema.METADATA))
    p = {r["arxiv_id"]: r for r in out["papers"].collect()}
    assert p["1"]["title"] == "new" and p["1"]["version_count"] == 2 and p["1"]["has_code"] and p["1"]["github_url"] == "https://github.com/x/y"
    assert p["2"]["submitted_date"] is None and not p["2"]["has_code"]
    cats = {tuple(r) for r in out["paper_categories"].where("arxiv_id = '1'").collect()}
    assert cats == {("1", "cs.LG", True), ("1", "", False)}
    assert [r["name_normalized"] for r in out["authors"].orderBy("author_id").collect()] == ["li a", "muller k"]
    assert {(r["author_id"], r["position"]) for r in out["paper_authors"].collect()} == {(2, 1), (1, 2)}


def test_samples_raise_and_repeat(spark):
    d = spark.range(50).withColumnRenamed("id", "k")
    a = [r[0] for r in sampling.sample(d, "k", 5).collect()]
    assert a == [r[0] for r in sampling.sample(d.repartition(7), "k", 5).collect()]
    with pytest.raises(ValueError):
        sampling.sample(d, "k", 51)


def test_prompts(spark):
    g = spark.createDataFrame([("A", "x" * 1000, 1), ("B", "y", 0)], "title string, abstract string, label int").withColumn("_order", 1 - F.col("label"))
    block = classify.few_shot_block(g, ["_order", "title"]).first()[0]
    assert block == f"Title: A\nAbstract: {'x' * 400}\nAnswer: yes\n\nTitle: B\nAbstract: y\nAnswer: no\n"
    p = spark.range(1).select(classify.prompt(F.lit("R"), F.lit(block), F.lit("T"), F.lit("z" * 900))).first()[0]
    assert p.startswith("R\n\nTitle: A") and p.endswith("z" * 800 + "\nReasoning:")


def test_embedding_isolates_failures(spark):
    d = spark.createDataFrame([(str(i), "bad" if i == 3 else f"text {i}") for i in range(5)], "arxiv_id string, text string").coalesce(1)

    def load():
        good = encode.hashing_encoder(4)()

        def enc(texts):
            if "bad" in texts:
                raise RuntimeError("no")
            return good(texts)

        return enc

    out = encode.embed(d, load, batch_size=1, dim=4)
    assert out.where("status = 'ok'").count() == 4
    cur = spark.createDataFrame([("0", [1.0], {1: 0.5}, "m", None)], schema.ABSTRACT_EMBEDDINGS)
    got = encode.save_embeddings(cur, out, "new")
    assert got.count() == 4 and got.where("arxiv_id = '0'").first()["embed_model"] == "m"


def test_blocks(spark):
    rows = [("Blank-Page", "x", [0, 0, 1, 1]), ("Page-Header", "h", [0, 0, 1, 1]), ("Text", "plain", [0, 0, 1, 1]), ("Text", "<b>t</b>", [0, 0, 1, 1]), ("Image", "", [0, 0, 10, 10]), ("Figure", '<img alt="q">', [10, 10, 0, 0])]
    d = spark.createDataFrame([(rows,)], "blocks array<struct<label:string,content:string,bbox:array<int>>>")
    assert d.select(documents.blocks_html(F.col("blocks"))).first()[0] == '<p>plain</p><b>t</b><img src="block_5.webp"><img src="block_6.webp" alt="q">'
    assert "h" in d.select(documents.blocks_html(F.col("blocks"), edges=True, images=False)).first()[0]
    assert [f["name"] for f in d.select(documents.figures(F.col("blocks"))).first()[0]] == ["block_5.webp"]


def test_markdown_and_chunks():
    assert documents.to_markdown("<h1>T</h1><ul><li>a</li><li>b_c</li></ul><p>x <b>y</b></p>") == "# T\n\n- a\n- b\\_c\n\nx **y**"
    assert documents.to_markdown("<math>a_b</math>") == "$a_b$" and documents.to_markdown(None) == ""
    md = "# A\n\n" + "w " * 30 + "\n\n## B\n\n" + "v " * 30 + "\n\n$$x\n\ny$$"
    got = chunks.split_markdown(md, 10, 40)
    assert [c["section"] for c in got] == ["A", "A > B"] and all(md[c["char_start"] : c["char_end"]] == c["text"] for c in got)
    assert "$$x\n\ny$$" in got[-1]["text"] and chunks.split_markdown("", 10, 40) == []


def test_documents_are_written_whole(tmp_path):
    at = documents.save_document(str(tmp_path), "p1", "<p>", "md", {"block_1.webp": b"i"})
    assert sorted(os.listdir(at)) == ["block_1.webp", "p1.html", "p1.md"]


def test_ocr_counts_must_match(spark):
    d = spark.createDataFrame([("a", 0, b"x")], "arxiv_id string, page int, image binary")
    with pytest.raises(Exception, match="another number of pages"):
        documents.ocr_pages(d, lambda: lambda images: []).collect()


def test_retry_and_stages():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("later")
        return "ok"

    assert fetch.with_retry(flaky, sleep=lambda s: calls.append(s) if s > 10 else None) == "ok" and len(calls) == 3
    with pytest.raises(OSError):
        fetch.with_retry(lambda: (_ for _ in ()).throw(OSError("x")), sleep=lambda s: None)
    done = []
    with pytest.raises(RuntimeError):
        flows.run_stages([("a", lambda: done.append(1), 1), ("b", lambda: (_ for _ in ()).throw(RuntimeError()), 2), ("c", lambda: done.append(2), 1)], log=lambda m: None)
    assert done == [1]


def test_pending_and_keyword(spark):
    sub = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "arxiv_id string")
    loc = spark.createDataFrame([("1", "p"), ("2", None)], "arxiv_id string, pdf_path string")
    assert sorted(r[0] for r in fetch.pending(sub, loc).collect()) == ["2", "2", "3"]
    assert fetch.keyword(None, "t") == "t" and fetch.keyword("x", "t") == "x"


def test_malformed_json_and_table_names(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text('{"id": "1"}\n{bad\n')
    with pytest.raises(Exception):
        readers.metadata(spark, str(p)).collect()
    assert readers.metadata(spark, str(p), fail_fast=False).count() == 2
    with pytest.raises(ValueError):
        readers.table_exists(spark, "x; drop")


def test_empty_corpus_keeps_the_topic(spark):
    prev = spark.createDataFrame([("t", "1", 0.5, True, 1, 1, None)], schema.TOPIC_SUBSET)
    corpus = spark.createDataFrame([], "arxiv_id string, title string, abstract string, dense_vec array<float>, sparse_weights map<int,float>")
    assert flows.search_topic("t", corpus, [1.0], {}, corpus, prev, "", None, 2).collect() == prev.collect()


def test_topic_search(spark):
    rows = [(f"p{i}", f"t{i}", "about", [1.0 - 0.1 * i, 0.0], {1: 1.0 / (i + 1)}) for i in range(8)]
    corpus = spark.createDataFrame(rows, "arxiv_id string, title string, abstract string, dense_vec array<float>, sparse_weights map<int,float>")
    gold = spark.createDataFrame([(f"p{i}", f"t{i}", "about", int(i < 3)) for i in range(8)], "arxiv_id string, title string, abstract string, label int")
    prev = spark.createDataFrame([("t", "old", 0.5, True, 1, 1, None), ("u", "x", 0.5, True, 1, 1, None)], schema.TOPIC_SUBSET)
    got = flows.search_topic("t", corpus, [1.0, 0.0], {1: 1.0}, gold, prev, "rubric", lambda: lambda ps: ["yes" if "Title: t0" in p.rsplit("Title", 1)[0] + "Title" + p.rsplit("Title", 1)[1] and p.rsplit("Title: ", 1)[1].startswith("t0") else "no" for p in ps], 7)
    t = {r["arxiv_id"]: r for r in got.where("topic = 't'").collect()}
    assert set(t) == {"p0", "p1", "p2"} and t["p0"]["rank"] == 1 and t["p0"]["llm_verdict"] and not t["p1"]["llm_verdict"]
    assert got.where("topic = 'u'").count() == 1


def test_stream_counts(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    assert incremental.event_counts(e).agg(F.sum("n")).first()[0] == e.count()


def test_latest_breaks_ties(spark):
    d = spark.createDataFrame([("a", "2020", "x"), ("a", "2020", "y")], "id string, update_date string, title string")
    assert curate.latest(d, tie=["title"]).first()["title"] == "y"


def test_verdicts_of_whole_table(spark, tmp_path):
    import re

    from quillspark.plans import queries

    said = ["yes", "no yesé", "éno yes", "Yes. naïveno", "日本yes", "yes日本 no", "ja, yes – no", "", None, "yes\u00a0no", "nö yes"]
    spark.createDataFrame([(k, 0, x) for k, x in enumerate(said)], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r["verdict"] for r in queries.l4_verdicts_whole(spark, str(tmp_path)).collect()}
    assert got == {k: re.findall(r"\b(yes|no)\b", (x or "").lower())[-1:] == ["yes"] for k, x in enumerate(said)}


def test_topic_of_whole_documents(spark, tmp_path):
    from quillspark.plans import queries

    said = ["x " * 5000 + "the end of it", "THE of", "theof", "the " + "y" * 41 + " of", "the\nof", "_the of", None, "und so die"]
    spark.createDataFrame(list(enumerate(said)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r[0] for r in queries.p11_topic_documents(spark, str(tmp_path)).collect()) == [0, 1, 7]


def test_fetch_tries_again(spark):
    def load():
        calls = {}

        def get(key):
            calls[key] = calls.get(key, 0) + 1
            if calls[key] < key:
                raise OSError("busy")
            return str(calls[key])

        return get

    d = spark.createDataFrame([(1,), (3,), (9,)], "arxiv_id long")
    got = {r["arxiv_id"]: (r["path"], r["status"]) for r in fetch.fetch(d, load, pause=0, wait=(0, 0)).collect()}
    assert got == {1: ("1", "ok"), 3: ("3", "ok"), 9: (None, "failed: busy")}
