"""Metadata to papers, categories and authors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .ranking import with_position
from .state import first_by


def latest(raw: DataFrame, key: str = "id", by: str = "update_date", tie: list[str] | None = None) -> DataFrame:
    """The newest record of each key; ties by the other columns given."""
    return first_by(raw, [key], [F.col(by).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in tie or [])])


def papers(clean: DataFrame) -> DataFrame:
    url = text.link(F.col("abstract"), F.col("comments"))
    return clean.select(
        F.col("id").alias("arxiv_id"), "title", "abstract",
        text.mail_date(F.try_element_at("versions", F.lit(1))["created"]).alias("submitted_date"),
        F.col("update_date").cast("date").alias("updated_date"),
        F.split_part("categories", F.lit(" "), F.lit(1)).alias("primary_category"),
        "doi", "comments", "license", F.size("versions").cast("bigint").alias("version_count"),
        url.alias("github_url"), url.isNotNull().alias("has_code"),
    )


def paper_categories(clean: DataFrame) -> DataFrame:
    """Each category of a paper once, with whether it is the first named."""
    first = F.split_part("categories", F.lit(" "), F.lit(1))
    rows = clean.select(F.col("id").alias("arxiv_id"), F.explode(F.array_distinct(F.split("categories", " "))).alias("category"), first.alias("_first"))
    return rows.select("arxiv_id", "category", (F.col("category") == F.col("_first")).alias("is_primary"))


def exploded_authors(clean: DataFrame) -> DataFrame:
    """arxiv_id, position (from 1), name_raw and name_normalized of each author."""
    # outer: for an inner explode Spark adds a filter on the array's size, which computes the array once more
    rows = clean.select(F.col("id").alias("arxiv_id"), F.posexplode_outer("authors_parsed").alias("_at", "_name")).where("_at is not null")
    raw = F.trim(F.array_join("_name", " "))
    return rows.select("arxiv_id", (F.col("_at") + 1).cast("int").alias("position"), raw.alias("name_raw")).withColumn("name_normalized", text.strip_accents(F.lower("name_raw")))


def authors(exploded: DataFrame) -> DataFrame:
    """One row of each normalised name, the smallest spelling, with an id that follows the name's order.

    Names are dealt to ranges by Spark's sampled bounds; an id is the place in the
    range plus the rows of the ranges before.  The result is a written table, so
    what joins it does not compute it anew.
    """
    names = exploded.groupBy("name_normalized").agg(F.min("name_raw").alias("name_raw"))
    placed = with_position(names, [F.col("name_normalized").asc_nulls_first()], "_at")
    return placed.select((F.col("_at") + 1).cast("bigint").alias("author_id"), "name_raw", "name_normalized")


def paper_authors(exploded: DataFrame, author_table: DataFrame) -> DataFrame:
    return exploded.join(author_table.select("author_id", "name_normalized"), "name_normalized").select("arxiv_id", "author_id", "position")


def top_authors(links: DataFrame, author_table: DataFrame, k: int = 5) -> DataFrame:
    counts = links.groupBy("author_id").agg(F.count(F.lit(1)).alias("n_papers"))
    return counts.join(author_table, "author_id").select("name_raw", "n_papers").orderBy(F.col("n_papers").desc(), "name_raw").limit(k)
