"""Spelling variants: words one edit apart, joined by bands of letter parities.

A word's mask has a bit for each letter (code point modulo 64), set where the
letter stands an odd number of times.  One inserted or deleted code point flips
one bit, a replaced one at most two, so of three bands of a mask at least one is
equal.  Words meet in an equal band of one length class (S, or S and S + 1 code
points), and as one edit leaves the first or the second half of a word as it is,
in an equal half: that keeps buckets small whatever the letters' frequencies.  A
pair is taken in the first band and half that it shares, so it counts once; masks
are compared, then the words by edit distance.

``variants`` gives each word's form and root; ``respell`` gives texts with each
word in the spelling of its root.  Null texts have no words, null ids stand as
empty in the typing key; repeated rows count each; an empty table gives no row.
Only doc_id and text are read, so other columns may have any name.  Texts and
words may be of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between runs, after lower-casing A-Z; the contract's letters are A-Z, a-z and U+00C0 to U+00FF.
BETWEEN = "[^a-z\\u00C0-\\u00FF]+"
BANDS = 3
BAND_MASKS = [sum(1 << b for b in range(k, 64, BANDS)) for k in range(BANDS)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def typed(doc_id: Column, run: Column, every: int) -> Column:
    """The run with a code point less where ``every`` divides the crc32 of "<doc_id>:<run>"."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    return F.when(F.pmod(h, F.lit(every)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def words(docs: DataFrame, least_length: int = 5, least_count: int = 3, every: int = 97) -> DataFrame:
    """word and n of all words of so many code points and occurrences."""
    runs = docs.select("doc_id", F.explode(F.split(F.translate(F.col("text").cast("string"), UPPER, LOWER), BETWEEN)).alias("run"))
    runs = runs.where(F.length("run") >= least_length)  # a typed run is never longer
    kept = runs.select(typed(F.col("doc_id"), F.col("run"), every).alias("word")).where(F.length("word") >= least_length)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def parity_mask(word: Column) -> Column:
    """64 parities: a letter's bit is its code point modulo 64."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(c), F.lit(64)))
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda m, c: m.bitwiseXOR(bit(c)))


def band_rows(table: DataFrame) -> DataFrame:
    """word, n, mask, and per band, half and length class its bucket: a word of L code points is a short one of class L and a long one of class L - 1."""
    masked = table.select("word", "n", F.length("word").alias("_size")).withColumn("mask", parity_mask(F.col("word")))

    def one(is_long: bool, band: int, half: int) -> Column:
        size = F.col("_size") - int(is_long)
        cut = F.floor(size / 2).cast("int")  # code points of the first half; the second has the rest of size
        part = F.substring("word", F.lit(1), cut) if half == 0 else F.right(F.col("word"), size - cut)
        place = (size * 2 * BANDS + (2 * band + half)).cast("int")
        bits = F.col("mask").bitwiseAND(F.lit(_signed(BAND_MASKS[band])))
        return F.struct(place.alias("place"), F.xxhash64(place, bits, part).alias("bucket"), F.lit(is_long).alias("is_long"))

    every = [one(is_long, band, half) for is_long in (False, True) for band in range(BANDS) for half in (0, 1)]
    return masked.select("word", "n", "mask", F.inline(F.array(*every)))


def near_pairs(table: DataFrame) -> DataFrame:
    """a, a_n, b, b_n of all pairs of words one edit apart, each once (a is the shorter, or of two equal in length the smaller)."""
    rows = band_rows(table)
    a = rows.where("NOT is_long").select("place", "bucket", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("mask").alias("a_mask"))
    b = rows.select("place", "bucket", "is_long", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("mask").alias("b_mask"))
    flips = F.col("a_mask").bitwiseXOR(F.col("b_mask"))
    few = F.when(F.col("is_long"), F.bit_count(flips) == 1).otherwise((F.bit_count(flips) <= 2) & (F.col("a") < F.col("b")))
    equal = [flips.bitwiseAND(F.lit(_signed(m))) == 0 for m in BAND_MASKS]
    band, half = F.floor(F.col("place") % (2 * BANDS) / 2), F.col("place") % 2
    first_band = F.when(equal[0], 0).when(equal[1], 1).when(equal[2], 2)
    cut = F.floor(F.length("a") / 2).cast("int")
    first_half = F.when(F.substring("a", F.lit(1), cut) == F.substring("b", F.lit(1), cut), 0).otherwise(1)
    met = a.join(b, ["place", "bucket"]).where(few & (first_band == band) & (first_half == half))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n")


def forms(table: DataFrame) -> DataFrame:
    """word, n, n_near, form and form_n: the near word of largest n (ties: the smallest), if its n is at least twice the word's."""
    each = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    # the smallest of (-n, word): UTF-8 bytes stand in the order of code points
    best = near_pairs(table).select(F.inline(each)).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    better = -F.col("best.m") >= 2 * F.col("n")
    out = table.join(best, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(better, F.col("best.near")).alias("form"), F.when(better, -F.col("best.m")).alias("form_n"))


def with_roots(formed: DataFrame) -> DataFrame:
    """Adds root: the last word that a word's forms lead to.

    n at least doubles from a word to its form, so forms make no cycle and a chain
    has at most log2 of the largest n links; each round doubles the links that are
    followed, so some six rounds do.  Only words with a form are carried.
    """
    at = written(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = written(at.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "spelling-roots")
        at = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            break
    return formed.join(at.select("word", F.col("root").alias("_root")), "word", "left").withColumn("root", F.coalesce("_root", "word")).drop("_root")


def variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, every: int = 97) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of a corpus."""
    table = written(words(docs, least_length, least_count, every), "spelling-words")
    formed = written(forms(table), "spelling-forms")
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")


def respell(docs: DataFrame, groups: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and text with each lower-case word that has another root written as that; all else, capitals too, stays.

    Texts are cut into words and what stands between; only the words that change
    meet their roots, and a text is put together again by its pieces' places.  Rows
    get a number of their own, so keys may repeat or be null.
    """
    rows = written(docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key), F.col("text").cast("string").alias("text")), "respell")
    cut = F.regexp_extract_all("text", F.lit("[A-Za-z\\u00C0-\\u00FF]+|[^A-Za-z\\u00C0-\\u00FF]+"), F.lit(0))
    pieces = rows.select("_row", F.posexplode(cut).alias("_at", "piece"))
    changed = groups.where("root <> word").select(F.col("word").alias("piece"), "root")
    hits = pieces.join(changed, "piece").groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_at", "root"))).alias("_new"))
    put = F.array_join(F.transform(cut, lambda p, i: F.coalesce(F.try_element_at("_new", i), p)), "")
    return rows.join(hits, "_row", "left").select(key, F.when(F.col("_new").isNull(), F.col("text")).otherwise(put).alias("text"))


#: The same rows by other means: crc32 byte by byte, and pairs by patterns with one letter left out.
ORACLE = r"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab),
r AS (SELECT doc_id, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS k FROM r WHERE length(run) >= 5 GROUP BY ALL),
b AS (SELECT run, k, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b FROM g),
h AS (SELECT run, k, xor(list_reduce(b, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h FROM b, t),
w AS (SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, sum(k) AS n FROM h GROUP BY 1 HAVING sum(k) >= 3),
v AS MATERIALIZED (SELECT word, CAST(n AS BIGINT) AS n FROM w WHERE length(word) >= 5),
x AS MATERIALIZED (SELECT word, n, i, substring(word, 1, i - 1) AS a, substring(word, i + 1) AS z FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT s.word, o.word AS near, o.n AS near_n FROM x s JOIN x o ON s.i = o.i AND s.a = o.a AND s.z = o.z AND s.word <> o.word
  UNION SELECT s.word, o.word, o.n FROM x s JOIN v o ON s.a || s.z = o.word
  UNION SELECT o.word, s.word, s.n FROM x s JOIN v o ON s.a || s.z = o.word),
f AS (SELECT v.word, v.n, count(p.near) AS n_near, first(p.near ORDER BY p.near_n DESC, encode(p.near)) AS best, max(p.near_n) AS best_n FROM v LEFT JOIN p ON p.word = v.word GROUP BY ALL),
o AS MATERIALIZED (SELECT word, n, n_near, CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n FROM f),
c AS (SELECT word, form AS at FROM o WHERE form IS NOT NULL UNION ALL SELECT c.word, o.form FROM c JOIN o ON o.word = c.at AND o.form IS NOT NULL),
e AS (SELECT c.word, c.at AS root FROM c JOIN o ON o.word = c.at AND o.form IS NULL)
SELECT o.word, o.form, coalesce(e.root, o.word) AS root, o.n, o.n_near, o.form_n FROM o LEFT JOIN e ON e.word = o.word"""
