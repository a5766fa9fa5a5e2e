"""Prompts, verdicts and the classification loop, with an injected generator."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .sampling import sample


def few_shot_examples(golden: DataFrame, n_positive: int = 3, n_negative: int = 3, key: str = "title", seed: str = "_seed42") -> DataFrame:
    """Positives then negatives; raises if there are too few."""
    yes = sample(golden.where("label = 1"), key, n_positive, seed).withColumn("_order", F.lit(0))
    return yes.unionByName(sample(golden.where("label = 0"), key, n_negative, seed).withColumn("_order", F.lit(1)))


def example_text(title: Column, abstract: Column, answer: Column, abstract_chars: int = 400) -> Column:
    return F.concat(F.lit("Title: "), title, F.lit("\nAbstract: "), F.substring(abstract, 1, abstract_chars), F.lit("\nAnswer: "), F.when(answer, F.lit("yes")).otherwise(F.lit("no")), F.lit("\n"))


def few_shot_block(examples: DataFrame, order: list[str], abstract_chars: int = 400) -> DataFrame:
    """One row: the examples in order, an empty line between them.  There are a handful of examples by construction."""
    rows = examples.select(F.struct(*order, example_text(F.col("title"), F.col("abstract"), F.col("label") == 1, abstract_chars).alias("t")).alias("x"))
    return rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n").alias("block"))


def prompt(rubric: Column, block: Column, title: Column, abstract: Column, abstract_chars: int = 800) -> Column:
    return F.concat(rubric, F.lit("\n\n"), block, F.lit("\n\nTitle: "), title, F.lit("\nAbstract: "), F.substring(abstract, 1, abstract_chars), F.lit("\nReasoning:"))


def classify(prompts: DataFrame, generate: Callable[[], Callable[[list[str]], list[str]]], key: str = "arxiv_id") -> DataFrame:
    """key, answer, llm_verdict; a row whose generation fails has a null verdict.

    generate is called once a task and gives a function of a list of prompts.
    """
    kind = dict(prompts.dtypes)[key]

    def run(frames):
        model = generate()
        for f in frames:
            out = []
            try:
                out = model(f["prompt"].tolist())
            except Exception:  # one bad prompt fails alone, not its batch
                for p in f["prompt"]:
                    try:
                        out.append(model([p])[0])
                    except Exception:
                        out.append(None)
            yield pd.DataFrame({key: f[key], "answer": pd.Series(out, dtype=object, index=f.index)})

    answers = prompts.select(key, "prompt").mapInPandas(run, f"{key} {kind}, answer string")
    return answers.withColumn("llm_verdict", F.when(F.col("answer").isNotNull(), text.verdict(F.col("answer"))))


def without_examples(golden: DataFrame, examples: DataFrame, key: str) -> DataFrame:
    return golden.join(examples.select(key), key, "left_anti")
