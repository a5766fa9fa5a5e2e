"""Fill-in-middle texts, cut at code points that a sparse checkpoint index finds.

Counting a text's code points leaves a checkpoint for every STEP bytes: how many
bytes and how many code points stand before it.  A cut at a code point is found by
a binary search in the checkpoints and a short rescan from there, so no index of
all code points is made.

Where cuts fall and which form a text takes follow from a digest of the seed and
doc_id, so they repeat on any layout; equal ids take equal numbers, a null id
stands as an empty one.  Null and empty texts, and texts that hold a sentinel, stay
plain.  Texts are never cut short; a worker holds a batch and its copy, or one long
text.  Each row gives one row, repeated ones too; an empty table gives none.  Kept
columns may have any name: one that is named like a result's own comes back as
<name>_in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan
from .work import carried, lean

#: Bytes between two checkpoints.
STEP = 1024
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
OWN = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "text")


class Checkpoints:
    """Code points before each STEP-th byte of a chunk of texts, from one count of the chunk."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs = data, offs
        self.begins = (data & 0xC0) != 0x80
        blocks = np.add.reduceat(self.begins, np.arange(0, len(data), STEP), dtype=np.int64) if len(data) else np.zeros(0, np.int64)
        self.before = np.concatenate([[0], np.cumsum(blocks)])
        self.first = self.count(offs)  # code points of the chunk before each text

    def count(self, at: np.ndarray) -> np.ndarray:
        """Code points before each byte: the checkpoint's and a rescan of fewer than STEP bytes."""
        block = at // STEP
        return self.before[block] + np.array([np.count_nonzero(self.begins[b * STEP : a]) for b, a in zip(block.tolist(), at.tolist(), strict=True)], np.int64)

    def sizes(self) -> np.ndarray:
        """Code points of each text."""
        return np.diff(self.first)

    def bytes_at(self, text: np.ndarray, units: np.ndarray) -> np.ndarray:
        """The byte where the given code point of a text begins; its end for the count of its code points."""
        want = self.first[text] + units
        block = np.searchsorted(self.before, want, "right") - 1  # the last checkpoint with at most so many before it
        out = np.empty(len(want), np.int64)
        for k, (b, w) in enumerate(zip(block.tolist(), want.tolist(), strict=True)):
            lo, left = b * STEP, w - int(self.before[b])
            near = np.flatnonzero(self.begins[lo : lo + STEP])
            out[k] = lo + int(near[left]) if left < len(near) else len(self.data)
        return np.minimum(out, self.offs[text + 1])


def draws(doc_id: Column, seed: int) -> list[Column]:
    """h1 to h4: the first four groups of eight digits of sha256("<seed>:<doc_id>")."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"_h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n (code points), form, prefix_chars, middle_chars (null if plain) and the new text.

    Of 100 texts about ``rate`` are cut, and of these about ``spm`` of 100 put the suffix first.
    """
    extra, names = carried(keep, OWN)
    kinds = dict(docs.dtypes)
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, text string" + "".join(f", {k} {kinds[c]}" for k, c in zip(names, keep, strict=True))

    def one(data: np.ndarray, offs: np.ndarray, h: list[np.ndarray]):
        marks = Checkpoints(data, offs)
        n, m = marks.sizes(), len(offs) - 1
        raw = data.tobytes()
        texts = [raw[a:z] for a, z in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
        held = np.array([not t or PREFIX in t or SUFFIX in t or MIDDLE in t for t in texts], bool)
        plain = held | (h[2] % 100 >= rate)
        lo, hi = np.minimum(h[0] % (n + 1), h[1] % (n + 1)), np.maximum(h[0] % (n + 1), h[1] % (n + 1))
        cut = np.flatnonzero(~plain)
        a, z = marks.bytes_at(cut, lo[cut]) - offs[cut], marks.bytes_at(cut, hi[cut]) - offs[cut]
        first_suffix = h[3] % 100 < spm
        out = texts
        for k, i, j in zip(cut.tolist(), a.tolist(), z.tolist(), strict=True):
            t = texts[k]
            if first_suffix[k]:
                out[k] = b"".join((SUFFIX, t[j:], PREFIX, t[:i], MIDDLE, t[i:j]))
            else:
                out[k] = b"".join((PREFIX, t[:i], SUFFIX, t[j:], MIDDLE, t[i:j]))
        form = np.where(plain, "plain", np.where(first_suffix, "spm", "psm"))
        return [pa.array(n), pa.array(form), pa.array(lo, mask=plain), pa.array(hi - lo, mask=plain), pa.array(out, pa.binary()).cast(pa.string())], m

    def run(batches):
        for b in batches:
            data, offs = scan.view(scan.text_column(b))
            h = [b.column(2 + k).to_numpy(zero_copy_only=False) for k in range(4)]
            for i, j in scan.chunks(data, offs, 4 * scan.CHUNK):
                cols, m = one(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], [x[i:j] for x in h])
                part = b.slice(i, m)
                yield pa.RecordBatch.from_arrays([part.column(0), *cols, *part.columns[6:]], names=["doc_id", *OWN[1:], *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *draws(F.col("doc_id"), seed), *extra)
    out = rows.mapInArrow(lean(run), schema)
    return out.select(*OWN, *(F.col(k).alias(v) for k, v in names.items()))


def restored(form: Column, text: Column) -> Column:
    """The text that a form was made from; no part holds a sentinel, so the sentinels part it."""
    part = F.split(F.substring(text, F.lit(4), F.length(text)), "<[PSM]>")
    return F.when(form == "psm", F.concat(part[0], part[2], part[1])).when(form == "spm", F.concat(part[1], part[2], part[0])).otherwise(text)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (SELECT doc_id, text, n, CAST('0x' || s[1:8] AS BIGINT) AS h1, CAST('0x' || s[9:16] AS BIGINT) AS h2, CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
  CASE WHEN n = 0 OR text LIKE '%<P>%' OR text LIKE '%<S>%' OR text LIKE '%<M>%' OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, text[:lo] AS a, text[lo + 1:hi] AS m, text[hi + 1:] AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM p"""
