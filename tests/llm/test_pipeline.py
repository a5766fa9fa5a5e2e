"""Each stage of the pipeline on planted rows."""

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F


def test_stages_take_effect(spark, tmp_path):
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghilmnoprstu"), int(rng.integers(3, 9))))
    text = lambda n=80: " ".join(word() for _ in range(n))
    passage, bench = text(40), text(20)
    rows = [(i, text() + (" idiot " if i % 4 == 0 else " ") + text(10)) for i in range(400)]
    clean = [i for i, _ in rows if i % 4]
    near = dict(rows)[1].split(" ")
    near[3] = "changed"
    rows += [(500, " ".join(near)), (501, dict(rows)[2]), (502, text() + " " + passage), (503, passage + " " + text()), (504, text(15) + " " + bench + " " + text(15)), (505, None), (506, "")]
    d = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert len(seen[0] & set(clean)) >= 0.98 * len(clean) and len(seen[0] & set(range(0, 400, 4))) <= 2
    assert seen[0] - seen[1] == {500, 501, 506} & seen[0]
    assert seen[2] == seen[1]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tmp_path}/stage2").collect()}
    assert passage in texts[502] and passage.split(" ")[0] not in texts[503].split(" ")
    assert seen[2] - seen[3] == {504} and seen[4] == seen[3]


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert out.count() > 100
