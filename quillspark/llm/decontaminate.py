"""Benchmark decontamination with DataFrame functions alone.

Words are lower-cased in A-Z; a benchmark item gives all its windows of
``width`` words, or one window if it has fewer.  The distinct windows form a hash
set.  A document's words are hashed once, and windows' hashes are built from those
of half their width.  A table of BITS bits a window of the set, two set for each
hash, is a scalar subquery of the plan and says which windows the set may hold
(others pass once in 60 times or less); a set of more than MOST windows is taken in
shares, each with a table and a scan of its own.  What passes meets the set in a hash
join and is then compared word by word, so collisions never count.  The set is
broadcast while it is small in bytes; a larger one meets the windows that pass in a
shuffled join.

Nulls have no words.  Each row stands for itself, also if ids repeat or are
null.  Windows of items without an id count as hits but not as items.  Items
without words have no windows; an empty benchmark hits nothing, and an empty table
gives no row.  Kept columns may have any name: one that is named like a result's
own column comes back as <name>_in.  Long texts are scanned in parts that overlap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import carried, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Separators of words, in texts without capitals A-Z.
BETWEEN = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: Bytes of windows that may be broadcast.
BROADCAST = 32 << 20
#: Bits of the table for each window of the set; windows of one scan, whose table has at most 32 MB.
BITS, MOST = 16, 1 << 24
#: Words of a text that are taken at once.
PART = 20_000


def cut_words(text: Column) -> Column:
    whole = F.coalesce(text.cast("string"), F.lit(""))
    # one table for capitals and separators: a regex for these would match at each word, which takes most of the time
    between = BETWEEN.translate({ord(c): None for c in UPPER})
    return F.filter(F.split(F.translate(whole, UPPER + between, LOWER + " " * len(between)), " "), lambda w: w != "")


def windows(benchmark: DataFrame, width: int) -> DataFrame:
    """Distinct windows with the items that hold them."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), cut_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - F.lit(width) + 1, F.lit(1)))
    rows = items.select("item", "words", F.explode(starts).alias("at")).select("item", F.slice("words", F.col("at"), F.lit(width)).alias("window"))
    return rows.groupBy("window").agg(F.collect_set("item").alias("items"))


def window_hashes(words: str, sizes: list[int]) -> tuple[list[tuple[str, Column]], dict[int, str]]:
    """Columns to add one after another, and which of them has the hashes of the windows of each size, by their start."""
    count = F.size(words)
    steps = [("_h1", F.transform(words, lambda w: F.xxhash64(w)))]
    made = {1: "_h1"}

    def joined(a: int, b: int) -> str:
        """Windows of a words and the b words after them."""
        if a + b not in made:
            n = F.greatest(count - (a + b) + 1, F.lit(0))
            steps.append((f"_h{a + b}", F.zip_with(F.slice(made[a], F.lit(1), n), F.slice(made[b], F.lit(a + 1), n), lambda x, y: F.xxhash64(x, y))))
            made[a + b] = f"_h{a + b}"
        return made[a + b]

    for n in sizes:
        half = 1
        while 2 * half <= n:
            joined(half, half)
            half *= 2
        at, rest = half, n - half
        while rest:
            half = 1 << (rest.bit_length() - 1)
            joined(at, half)
            at, rest = at + half, rest - half
    return steps, {n: made[n] for n in sizes}


def with_columns(rows: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    for name, column in steps:  # each on its own, as the next one takes it twice
        rows = rows.withColumn(name, column)
    return rows


def bit_table(hashes: DataFrame, words: int) -> DataFrame:
    """One row with an array of so many longs (a power of two): of each hash two bits are set."""
    slots = hashes.select(F.explode(F.array(*_slots(F.col("hash"), words))).alias("slot"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("slot", F.lit(64)).cast("int"))
    set_ = slots.groupBy(F.shiftright("slot", 6).alias("id")).agg(F.bit_or(one).alias("bits"))
    every = hashes.sparkSession.range(words).join(set_, "id", "left").select(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("x"))
    # a table of bounded size: at most MOST windows make it
    return every.agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["bits"]).alias("table"))


def _slots(h: Column, words: int) -> list[Column]:
    """The two bits of a hash."""
    return [F.pmod(h, F.lit(words * 64)), F.pmod(F.shiftrightunsigned(h, 29), F.lit(words * 64))]


def may_hold(table: Column, h: Column, words: int) -> Column:
    """Whether both bits of a hash are set."""
    bit = lambda slot: F.call_function("shiftright", F.get(table, F.shiftright(slot, 6).cast("int")), F.pmod(slot, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1
    first, second = _slots(h, words)
    return bit(first) & bit(second)


def hits(docs: DataFrame, benchmark: DataFrame, width: int, *keep: Column) -> DataFrame:
    """One row a document: row, doc_id, n_words, spans (start from 1, past), items, and the columns in keep."""
    found = windows(benchmark, width)
    sizes = sorted(r["n"] for r in found.select(F.size("window").alias("n")).distinct().collect())  # at most width
    steps, of_size = window_hashes("window", sizes)
    own = F.coalesce(*(F.when(F.size("window") == n, F.get(of_size[n], F.lit(0))) for n in sizes)) if sizes else F.lit(0).cast("long")
    side = written(with_columns(found, steps).select(own.alias("hash"), F.col("window").alias("wanted"), "items"), "windows")
    total = side.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.array_join("wanted", " ")) + F.octet_length(F.array_join("items", " ")) + 100).alias("bytes")).first()
    carried_names = [f"_keep_{k}" for k in range(len(keep))]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("doc"), *(c.alias(n) for c, n in zip(keep, carried_names, strict=True)), cut_words(F.col("text")).alias("words"))
    # long texts go in parts that overlap, so no row holds more than PART windows of each size
    rows = rows.withColumn("n_words", F.size("words").cast("long")).withColumn("base", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(PART))))
    rows = rows.withColumn("words", F.slice("words", F.col("base") + 1, F.lit(PART + width - 1)))
    steps, of_size = window_hashes("words", sizes)
    rows = with_columns(rows, steps).withColumn("hashes", F.array(*(F.col(of_size[n]) for n in sizes)) if sizes else F.array().cast("array<array<bigint>>"))
    each = rows.select("row", "doc", *carried_names, "n_words", "base", "words", F.posexplode_outer("hashes").alias("of", "hash_list"))
    each = each.select("row", "doc", *carried_names, "n_words", "base", "words", "of", F.posexplode_outer("hash_list").alias("at", "hash"))
    wide = F.get(F.array(*map(F.lit, sizes)), F.col("of")) if sizes else F.lit(0)
    # what is kept goes along once, also if no window passes
    once = (F.col("base") == 0) & (F.coalesce("of", F.lit(0)) == 0) & (F.coalesce("at", F.lit(0)) == 0)
    passes = max(1, -(-total["n"] // MOST))

    def spread(turn: int) -> DataFrame:
        """The windows that the turn's share of the set may hold, and once each row."""
        share = F.pmod(F.shiftright("hash", 8), F.lit(passes)) == turn
        longs = 1 << max(6, (max(total["n"] // passes, 1) * BITS // 64).bit_length())
        may = (F.col("at") < PART) & share & may_hold(bit_table(side.where(share), longs).scalar(), F.col("hash"), longs)
        may, first = F.coalesce(may, F.lit(False)), once & F.lit(turn == 0)
        kept = each.withColumn("may", may).where(F.col("may") | first)
        at = F.when(F.col("may"), F.struct((F.col("at") + 1).alias("start"), F.slice("words", F.col("at") + 1, wide).alias("window")))
        # rows without a window keep apart by their own number
        return kept.select("row", "doc", "n_words", "base", at.alias("at"), F.when(F.col("may"), F.col("hash")).otherwise(F.col("row")).alias("hash"), *(F.when(first, F.col(c)).alias(c) for c in carried_names))

    every = reduce(DataFrame.unionAll, map(spread, range(passes)))
    met = every.join(F.broadcast(side) if (total["bytes"] or 0) <= BROADCAST else side, "hash", "left")
    start = F.col("at.start") + F.col("base")
    hit = F.col("at.window") == F.col("wanted")
    slim = met.select("row", "doc", "n_words", *carried_names, F.when(hit, F.struct(start.alias("start"), (start + F.size("wanted")).alias("past"))).alias("span"), F.when(hit, F.col("items")).alias("items"))
    return slim.groupBy("row").agg(F.first("doc").alias("doc_id"), *(F.first(c, ignorenulls=True).alias(c) for c in carried_names), F.first("n_words").alias("n_words"), F.collect_set("span").alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def covered(spans: Column) -> Column:
    """Words that spans cover, each once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("past"))
    return F.aggregate(F.array_sort(spans), start, lambda acc, x: F.struct((acc["n"] + F.greatest(x["past"] - F.greatest(acc["past"], x["start"]), F.lit(0))).alias("n"), F.greatest(acc["past"], x["past"]).alias("past")), lambda acc: acc["n"])


def report(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings) and contaminated of each row."""
    return hits(docs, benchmark, width).select("doc_id", "n_words", covered(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items").withColumn("contaminated", F.col("n_hit") > 0)


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text and columns in keep of the rows without a hit."""
    kept, names = carried(keep, ("doc_id", "text"))
    rows = hits(docs, benchmark, width, F.col("text"), *kept).where(F.size("spans") == 0)
    return rows.select("doc_id", F.col("_keep_0").alias("text"), *(F.col(f"_keep_{k}").alias(name) for k, name in enumerate(names.values(), 1)))


def clean_spans(docs: DataFrame, benchmark: DataFrame, width: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """All rows; where words are hit the text is its other words in lower case A-Z, joined by one space."""
    kept, names = carried(keep, ("doc_id", "text"))
    rows = hits(docs, benchmark, width, F.col("text"), *kept)
    words = cut_words(F.col("_keep_0"))
    left = F.filter(words, lambda w, i: ~F.exists("spans", lambda s: (s["start"] <= i + 1) & (i + 1 < s["past"])))
    return rows.select("doc_id", F.when(F.size("spans") > 0, F.array_join(left, " ")).otherwise(F.col("_keep_0")).alias("text"), *(F.col(f"_keep_{k}").alias(name) for k, name in enumerate(names.values(), 1)))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    out = report(docs, benchmark)
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
w AS (
  SELECT DISTINCT item, len(words[s:s + 9]) AS size, array_to_string(words[s:s + 9], ' ') AS win
  FROM b, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS t(s)
  WHERE len(words) > 0),
p AS (
  SELECT rid, s, array_to_string(words[s:s + size - 1], ' ') AS win, size
  FROM d, (SELECT DISTINCT size FROM w), unnest(generate_series(1, len(words) - size + 1)) AS t(s)),
h AS (SELECT rid, item, s, size FROM p JOIN w USING (win, size)),
n AS (SELECT rid, count(DISTINCT k) AS n_hit FROM h, unnest(generate_series(s, s + size - 1)) AS t(k) GROUP BY rid),
i AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN i USING (rid)
"""
