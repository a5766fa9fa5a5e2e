"""Figures, paced and streamed fetching, chunks, model work that is done once, ledgers and checked writes."""

import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark import storage
from quillspark.operators import chunks, documents, encode, state
from quillspark.plans import flows, schema
from quillspark.sources import fetch


# ---- figures


def test_crops_are_those_of_slices():
    rng = np.random.default_rng(1)
    decode, encode_image = documents.netpbm()
    for depth in (1, 3):
        image = rng.integers(0, 256, (9, 7, depth), dtype=np.uint8)
        assert (decode(encode_image(image)) == image).all()
        for _ in range(200):
            x0, y0 = rng.integers(-4, 10, 2)
            x1, y1 = x0 + rng.integers(1, 9), y0 + rng.integers(1, 9)
            got = documents.crop(image, [x0, y0, x1, y1])
            assert got.shape == (y1 - y0, x1 - x0, depth)
            for y in range(y0, y1):
                for x in range(x0, x1):
                    want = image[y, x] if 0 <= y < 9 and 0 <= x < 7 else 0
                    assert (got[y - y0, x - x0] == want).all()
    assert decode(b"P6 #c\n 1 # d\n1\n255\nabc").tolist() == [[[97, 98, 99]]]
    for bad in (b"", b"P3\n1 1\n255\n1", b"P5\n2 2\n255\nabc", b"P5\n1 1\n65535\nab"):
        with pytest.raises(ValueError):
            decode(bad)


def test_figures_of_pages(spark, tmp_path):
    image = b"P5\n4 4\n255\n" + bytes(range(16))
    rows = [
        ("a", 0, image, [("Image", "<div><img/></div>", [0, 0, 2, 2]), ("Text", "<img>", [0, 0, 1, 1]), ("Figure", "<IMG src='x'>", [3, 3, 6, 5])]),
        ("a", 1, image, [("Image", "<img>", [2, 2, 0, 0]), ("Image", "no tag here", [0, 0, 2, 2]), ("Image", "<img>", [1]), ("Image", "<img>", None), ("Image", None, [0, 0, 1, 1])]),
        ("b", 0, b"broken", [("Image", "<img>", [0, 0, 1, 1])]), ("c", 0, None, []), ("d", 0, None, None),
    ]
    pages = spark.createDataFrame(rows, "arxiv_id string, page int, image binary, blocks array<struct<label:string,content:string,bbox:array<int>>>")
    crops = documents.crop_figures(pages, prefix=F.concat(F.lit("page_"), F.col("page").cast("string"), F.lit("_")))
    got = {(r["arxiv_id"], r["page"], r["name"]): (r["image"], r["error"]) for r in crops.collect()}
    assert got[("a", 0, "page_0_block_1.webp")] == (b"P5\n2 2\n255\n\x00\x01\x04\x05", None)
    assert got[("a", 0, "page_0_block_3.webp")] == (b"P5\n3 2\n255\n\x0f\x00\x00\x00\x00\x00", None)
    assert got[("b", 0, None)][0] is None and "not a binary" in got[("b", 0, None)][1] and len(got) == 3
    ocr = lambda: lambda images: [{"raw": "<p>x</p>", "token_count": 1, "error": None} for _ in images]
    documents.run_ocr(pages.where("arxiv_id = 'a'").select("arxiv_id", "page", "image"), ocr, f"file://{tmp_path}/run", f"file://{tmp_path}/files", crops=crops)
    assert sorted(os.listdir(f"{tmp_path}/files/a")) == ["a.html", "a.md", "page_0_block_1.webp", "page_0_block_3.webp"]


# ---- fetching


def test_tasks_share_one_rate(spark):
    """Four tasks call in turn, retries too: no two calls within a pause."""
    tries = spark.sparkContext.accumulator(0)

    def load():
        failed = set()

        def get(key):
            now = time.time()
            tries.add(1)
            with open(log, "a") as f:
                f.write(f"{now}\n")
            if key % 5 == 0 and key not in failed:
                failed.add(key)
                raise OSError("busy")
            return "ok"

        return get

    log = f"/tmp/quillspark-calls-{os.getpid()}-{random.random()}"
    d = spark.range(20).select(F.col("id").alias("arxiv_id"))
    out = fetch.fetch(d, load, pause=0.25, parts=4, wait=(0, 0))
    assert out.where("status = 'ok'").count() == 20 and tries.value == 24
    calls = sorted(float(x) for x in open(log).read().split())
    os.remove(log)
    gaps = np.diff(calls)
    assert len(calls) == 24 and (gaps > 0.125).all() and gaps.max() < 2.5


def test_turns_are_dealt_round():
    last = {p: 0.0 for p in range(4)}
    calls = []
    now = 100.1
    for step in range(200):
        p = step * 7 % 4
        last[p] = fetch.next_turn(now + random.Random(step).random(), 3.0, p, 4, last[p])
        calls.append(last[p])
        now += 1.0
    assert len(set(calls)) == len(calls) and min(np.diff(sorted(calls))) >= 3.0 - 1e-6


def test_streams_go_on_where_they_broke(spark, tmp_path):
    body = {k: bytes(random.Random(k).randrange(256) for _ in range(5000 * (k + 1))) for k in range(4)}
    log = f"{tmp_path}/offsets"

    def load():
        def open_at(key, offset):
            with open(log, "a") as f:
                f.write(f"{key} {offset}\n")
            for a in range(offset, len(body[key]), 700):
                if a - offset > 3000:
                    raise OSError("connection lost")
                yield body[key][a : a + 700]

        return open_at

    d = spark.range(5).select(F.concat(F.col("id"), F.when(F.col("id") == 3, "").otherwise("")).cast("int").alias("arxiv_id")).where("arxiv_id < 4")
    run = lambda attempts: {r["arxiv_id"]: (r["path"], r["status"]) for r in fetch.fetch(d, fetch.to_store(load, f"file://{tmp_path}/src"), pause=0, parts=2, attempts=attempts, wait=(0, 0)).collect()}
    first = run(3)
    assert first[0][1] == first[1][1] == "ok" and first[3][1] == "failed: connection lost"
    assert not os.path.exists(f"{tmp_path}/src/3.tar.gz")
    again = run(5)
    assert all(s == "ok" for _, s in again.values())
    for k in body:
        assert open(f"{tmp_path}/src/{k}.tar.gz", "rb").read() == body[k] and again[k][0] == f"file://{tmp_path}/src/{k}.tar.gz"
    asked = [int(x.split()[1]) for x in open(log).read().splitlines() if x.startswith("3 ")]
    assert asked == sorted(asked) and len(set(asked)) == len(asked) > 4  # each call asks for what is left


# ---- chunks


def test_chunks_hold_their_budget():
    """Random documents: within the limit, in order, without gaps but blank space, tables and equations whole where they fit."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9)))
    letters = lambda s: (len(s) + 3) // 4  # noqa: E731  a counter that is no sum of its parts
    for trial in range(120):
        parts = []
        for _ in range(rng.randint(0, 14)):
            kind = rng.choice(["head", "text", "table", "equation", "long"])
            parts.append({
                "head": lambda: "#" * rng.randint(1, 4) + " " + " ".join(word() for _ in range(rng.randint(1, 4))),
                "text": lambda: " ".join(word() + rng.choice(["", "", "."]) for _ in range(rng.randint(1, 60))),
                "table": lambda: "\n".join("| " + word() + " | " + word() + " |" for _ in range(rng.randint(1, 12))),
                "equation": lambda: "$$" + word() + "\n\n" + word() + "$$",
                "long": lambda: "x" * rng.randint(100, 900),
            }[kind]())
        md = "\n\n".join(parts)
        count = [chunks.words, letters][trial % 2]
        most = rng.randint(12, 60)
        got = chunks.split_markdown(md, most // 2, most, count, rng.choice(["", "A title", "word " * 80]))
        past = 0
        for c in got:
            assert c["n_tokens"] == count(c["content"]) <= most
            assert md[c["char_start"] : c["char_end"]] == c["text"] and c["content"].endswith(c["text"])
            assert c["char_start"] >= past and not md[past : c["char_start"]].strip()
            past = c["char_end"]
        assert not md[past:].strip()
        edges = {c["char_start"] for c in got}
        for a, z in chunks.blocks_of(md):
            if count("A title > " + "x " * 40 + md[a:z]) <= most // 2 and md[a:z].startswith(("$$", "|")):
                assert not any(a < e < z for e in edges)


def test_chunks_carry_title_and_path(spark):
    md = "# A\n\nintro\n\n## B\n\n" + "b " * 20 + "\n\n# C\n\nend"
    rows = spark.createDataFrame([(1, md, "T"), (2, None, None), (3, "", "T")], "k long, md string, name string")
    got = [(r["k"], r["chunk_index"], r["section"], r["content"].split("\n")[0], r["n_tokens"]) for r in chunks.chunk_documents(rows, "k", "md", 5, 30, title="name").collect()]
    assert [g[:4] for g in got] == [(1, 0, "A", "T > A"), (1, 1, "A > B", "T > A > B"), (1, 2, "C", "T > C")] or [g[2] for g in got] == ["A", "C"]
    assert all(g[4] <= 30 for g in got)


# ---- model work


def test_embedding_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    calls = spark.sparkContext.accumulator(0)

    def load():
        good = encode.hashing_encoder(4)()

        def enc(texts):
            calls.add(len(texts))
            return good(texts)

        return enc

    papers = spark.createDataFrame([(str(k), "t", f"text {k}", "c") for k in range(60)], "arxiv_id string, title string, abstract string, primary_category string")
    none = spark.createDataFrame([], schema.ABSTRACT_EMBEDDINGS)
    real, seen = encode.embed, []

    def breaks(*a):
        seen.append(1)
        if len(seen) == 3:
            raise OSError("lost")
        return real(*a)

    monkeypatch.setattr(encode, "embed", breaks)
    with pytest.raises(OSError):
        encode.embed_pending(papers, none, load, "m", run=f"file://{tmp_path}/run", chunks=4)
    some = calls.value
    table, status = encode.embed_pending(papers, none, load, "m", run=f"file://{tmp_path}/run", chunks=4)
    assert table.count() == 60 and status.where("status = 'ok'").count() == 60 and 0 < some < 60 and calls.value == 60
    table, status = encode.embed_pending(papers, none, load, "m")
    assert table.count() == status.count() == 60 and calls.value == 120


def test_a_topic_asks_the_model_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def generate():
        def model(prompts):
            calls.add(len(prompts))
            return ["yes"] * len(prompts)

        return model

    rows = [(f"p{i}", f"t{i}", "about", [1.0 - 0.1 * i, 0.0], {1: 1.0 / (i + 1)}) for i in range(8)]
    corpus = spark.createDataFrame(rows, "arxiv_id string, title string, abstract string, dense_vec array<float>, sparse_weights map<int,float>")
    gold = spark.createDataFrame([(f"p{i}", f"t{i}", "about", int(i < 3)) for i in range(8)], "arxiv_id string, title string, abstract string, label int")
    prev = spark.createDataFrame([], schema.TOPIC_SUBSET)
    for _ in range(2):
        out = flows.search_topic("t", corpus, [1.0, 0.0], {1: 1.0}, gold, prev, "rubric", generate, 1, top_k=5, run=f"file://{tmp_path}/topic")
        assert out.count() == 5 and out.where("llm_verdict").count() == 5
    assert calls.value == 5


# ---- ledgers and contracts


def test_a_run_goes_on_after_the_last_stage_that_was_done(spark, tmp_path):
    ledger, done, broken = f"file://{tmp_path}/ledger", [], [True]

    def fetch_stage():
        done.append("fetch")

    def ocr():
        if broken[0]:
            raise RuntimeError("no server")
        done.append("ocr")

    server = []
    stage = flows.served(ocr, lambda: server.append("start"), lambda: len(server) > 0, lambda: server.append("stop"), sleep=lambda s: None)
    stages = [("fetch", fetch_stage, 3), ("ocr", stage, 2), ("index", lambda: done.append("index"), 1)]
    with pytest.raises(RuntimeError):
        flows.run_stages(stages, lambda m: None, ledger, spark)
    assert done == ["fetch"] and server == ["start", "stop"] * 2
    broken[0] = False
    flows.run_stages(stages, lambda m: None, ledger, spark)
    assert done == ["fetch", "ocr", "index"]
    rows = [(r["stage"], r["attempt"], r["status"]) for r in spark.read.parquet(ledger).orderBy("at").collect()]
    assert rows == [("fetch", 1, "started"), ("fetch", 1, "done"), ("ocr", 1, "started"), ("ocr", 1, "failed"), ("ocr", 2, "started"), ("ocr", 2, "failed"), ("ocr", 1, "started"), ("ocr", 1, "done"), ("index", 1, "started"), ("index", 1, "done")]
    waits = []
    with pytest.raises(TimeoutError):
        flows.served(lambda: None, lambda: None, lambda: False, lambda: server.append("off"), polls=30, wait=5, sleep=waits.append)()
    assert waits == [5] * 30 and server[-1] == "off"


@pytest.mark.parametrize("name", sorted(schema.KEYS))
def test_contracts_of_the_ten_tables(spark, tmp_path, name):
    kind, key = getattr(schema, name.upper()), schema.KEYS[name]
    row = lambda n: spark.range(n).select(*(F.col("id").cast("string").cast(f.dataType).alias(f.name) if f.name in key else F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields))
    path = f"file://{tmp_path}/{name}"
    flag = next((f.name for f in kind.fields if f.dataType.typeName() == "boolean"), None)
    state.write_checked(row(5), path, kind, key, {flag: False} if flag else {})
    got = spark.read.parquet(path)
    assert got.count() == 5 and got.columns == kind.names and (flag is None or got.where(F.col(flag).isNull()).count() == 0)
    bad = row(5).unionAll(row(2)).unionAll(row(1).withColumn(key[0], F.lit(None).cast(kind[key[0]].dataType)))
    with pytest.raises(state.Breach) as e:
        state.write_checked(bad, path, kind, key)
    assert (e.value.repeated, e.value.missing) == (2, 1) and spark.read.parquet(path).count() == 5
    assert not storage.exists(spark, f"{path}.next")
