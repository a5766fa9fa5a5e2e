"""End-to-end flows over the operators."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators import classify, curate, retrieval, state


def build_corpus(raw: DataFrame) -> dict[str, DataFrame]:
    """Metadata to papers, paper_categories, authors and paper_authors."""
    clean = curate.latest(raw, tie=["title"])
    exploded = storage.written(curate.exploded_authors(clean), "authors")  # ids and links both read it
    names = curate.authors(exploded)
    return {"papers": curate.papers(clean), "paper_categories": curate.paper_categories(clean), "authors": names, "paper_authors": curate.paper_authors(exploded, names)}


def search_topic(topic: str, corpus: DataFrame, query_dense: list[float], query_sparse: dict, golden: DataFrame, previous: DataFrame, rubric: str, generate: Callable, run_id: int, top_k: int | None = None, target: float = 0.97, run: str | None = None) -> DataFrame:
    """The topic_subset table with this topic's rows replaced; an empty corpus leaves it as it is.

    Ranks and answers are written, so the model sees each candidate once, whatever
    reads the result; under run, if that is given, where a run that broke off goes on.
    """
    if corpus.isEmpty():
        return previous
    spark = corpus.sparkSession
    run = run or storage.folder(spark, "topic")
    fused = retrieval.ranked_corpus(retrieval.rrf_fuse(retrieval.dense_scores(corpus, query_dense), retrieval.sparse_scores(corpus, query_sparse)))
    k = top_k or retrieval.recommend_top_k(fused, golden, target)
    best = storage.once(spark, f"{run}/candidates", lambda: retrieval.candidates(fused, k))
    examples = classify.few_shot_examples(golden, key="arxiv_id")
    block = classify.few_shot_block(examples, ["_order", "arxiv_id"]).first()["block"]
    prompts = best.join(corpus.select("arxiv_id", "title", "abstract"), "arxiv_id").withColumn("prompt", classify.prompt(F.lit(rubric), F.lit(block), F.col("title"), F.col("abstract")))
    answers = storage.once(spark, f"{run}/answers", lambda: classify.classify(prompts, generate))
    rows = best.join(answers.select("arxiv_id", "llm_verdict"), "arxiv_id").select(F.lit(topic).alias("topic"), "arxiv_id", "hybrid_score", "llm_verdict", "rank", F.lit(run_id).alias("run_id"), F.current_timestamp().alias("created_at"))
    return state.replace_by_key(previous, rows, corpus.sparkSession.createDataFrame([(topic,)], "topic string"))


LEDGER = "stage string, attempt int, status string, at timestamp, error string"


def run_stages(stages: list[tuple[str, Callable[[], None], int]], log: Callable[[str], None] = print, ledger: str | None = None, spark: SparkSession | None = None) -> None:
    """Each stage up to its number of attempts; the first that never succeeds ends the run.

    ledger: a folder where each start, success and failure is appended; stages that
    it has as done are passed over, so a run that broke off goes on with the next.
    """

    def note(stage: str, attempt: int, status: str, error: str | None = None) -> None:
        if ledger:
            row = spark.createDataFrame([(stage, attempt, status, error)], "stage string, attempt int, status string, error string")
            row.select("stage", "attempt", "status", F.current_timestamp().alias("at"), "error").write.mode("append").parquet(ledger)

    done = set()
    if ledger and storage.exists(spark, ledger):
        done = {r["stage"] for r in spark.read.schema(LEDGER).parquet(ledger).where("status = 'done'").select("stage").distinct().collect()}  # as many as stages
    for name, call, attempts in stages:
        if name in done:
            log(f"{name}: done before")
            continue
        for k in range(1, attempts + 1):
            note(name, k, "started")
            try:
                call()
                note(name, k, "done")
                break
            except Exception as e:
                note(name, k, "failed", str(e)[:1000])
                log(f"{name}: attempt {k} of {attempts} failed: {e}")
                if k == attempts:
                    raise


def served(call: Callable[[], None], start: Callable[[], None], ready: Callable[[], bool], stop: Callable[[], None], polls: int = 30, wait: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[], None]:
    """A stage that starts a server, waits until it is ready, calls, and stops it whatever happens."""

    def stage() -> None:
        start()
        try:
            for _ in range(polls):
                if ready():
                    break
                sleep(wait)
            else:
                raise TimeoutError(f"the server was not ready after {polls} polls")
            call()
        finally:
            stop()

    return stage
