"""Dense and sparse vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Sum of products in double precision, in order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def lexical_match(query: Column, doc: Column) -> Column:
    """Sum of products over the keys that both maps hold; 0 without any."""
    return F.aggregate(F.map_entries(query), F.lit(0.0), lambda s, e: s + F.coalesce(e["value"].cast("double") * F.try_element_at(doc, e["key"]).cast("double"), F.lit(0.0)))


def weights(c: Column) -> Column:
    """A map of any numeric kinds as int to float."""
    return c.cast("map<int,float>")


def token_counts(text: Column) -> Column:
    """Map of word to count of a text, as a simple sparse vector."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+"), lambda w: w != "")
    return F.map_from_entries(F.transform(F.array_distinct(words), lambda w: F.struct(w, F.size(F.filter(words, lambda x: x == w)))))
