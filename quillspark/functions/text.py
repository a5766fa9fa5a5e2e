"""Column functions on strings that have no single built-in."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a repository link looks in abstracts and comments.
REPOSITORY = r"https?://github\.com/[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+"
# Fixed value: the marker before each page of joined markdown.
PAGE_MARK = r"<!-- ===== Page \d+ ===== -->"


@functools.cache
def _bare_letters() -> tuple[str, str]:
    """Letters that are a base letter with marks, and their base letters, by the decompositions of Unicode."""
    pairs = []
    for c in map(chr, (*range(0x80, 0xAC00), *range(0xF900, sys.maxunicode + 1))):  # between them: syllables that are made of letters, not marks
        bare = unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x)[0] != "M"))
        if len(bare) == 1 and bare != c:
            pairs.append((c, bare))
    return "".join(c for c, _ in pairs), "".join(b for _, b in pairs)


def strip_accents(c: Column) -> Column:
    """Letters without their marks; letters that are no base letter with a mark stay.  Marks that stand by themselves go too."""
    bare = F.regexp_replace(F.translate(c, *_bare_letters()), r"\p{M}+", "")
    # texts of one byte a character are ASCII and stay: looking up each letter takes most of the time
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(bare)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def link(*texts: Column) -> Column:
    """First repository link in the texts, null if none."""
    return F.nullif(F.regexp_extract(F.concat(*(x for t in texts for x in (F.coalesce(t, F.lit("")), F.lit(" ")))), REPOSITORY, 0), F.lit(""))


def mail_date(c: Column) -> Column:
    """Date of 'Mon, 2 Apr 2007 19:18:42 GMT'."""
    return F.to_timestamp(F.regexp_replace(c, r"^[A-Za-z]{3}, | GMT$", ""), "d MMM yyyy HH:mm:ss").cast("date")


def verdict(c: Column) -> Column:
    """Whether the last stand-alone yes or no is a yes; false if there is none."""
    found = F.regexp_extract_all(F.lower(F.trim(c)), F.lit(r"(?U)\b(yes|no)\b"), 1)
    return F.coalesce(F.try_element_at(found, F.lit(-1)) == "yes", F.lit(False))


def has_tag(c: Column) -> Column:
    """Whether a tag stands on one line."""
    return c.rlike("(?d)<.+>")


def split_pages(c: Column) -> Column:
    """The bodies after each page marker, stripped."""
    parts = F.split(c, PAGE_MARK)
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), strip)


def join_pages(page: Column, body: Column) -> Column:
    """An aggregate: bodies in page order, each after its 1-based marker."""
    ordered = F.array_sort(F.collect_list(F.struct(page.alias("p"), body.alias("b"))))
    return F.array_join(F.transform(ordered, lambda x: F.concat(F.lit("<!-- ===== Page "), (x["p"] + 1).cast("string"), F.lit(" ===== -->\n\n"), x["b"])), "\n\n")


def stem(path: Column, suffix: str) -> Column:
    return F.regexp_extract(path, r"([^/]+)\." + suffix + "$", 1)
