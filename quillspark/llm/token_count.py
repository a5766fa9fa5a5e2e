"""Token counts by heap-and-linked-list byte-pair merging.

Each distinct pre-token starts as one symbol a byte; the adjacent pair of the
lowest rank is popped from a heap and merged in a linked list until none is
left.  The count is the initial symbols minus the merges: no ids are made.

Nulls count as empty texts (0 tokens).  Repeated rows are counted each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, scan
from .work import lean, one_text

SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of each row."""
    path = vocabulary or bpe.default_path()

    def run(batches):
        counter = bpe.Counter.kept(path)
        for b in batches:
            data, offs = scan.view(scan.text_column(b))
            n = counter.texts(data, offs)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(np.diff(offs)), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    return one_text(docs).mapInArrow(lean(run, keep=True), SCHEMA).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
