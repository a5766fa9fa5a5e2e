"""Tables of the curated corpus: columns and logical keys."""

from __future__ import annotations

from pyspark.sql import types as T


_SIMPLE = {"string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "float": T.FloatType()}


def _parts(s: str) -> list[str]:
    """Split at commas outside of angle brackets."""
    out, depth = [""], 0
    for c in s:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def _type(s: str) -> T.DataType:
    kind, _, inner = s.strip().partition("<")
    if not inner:
        return _SIMPLE[kind]
    parts = _parts(inner[:-1])
    if kind == "array":
        return T.ArrayType(_type(parts[0]))
    if kind == "map":
        return T.MapType(_type(parts[0]), _type(parts[1]))
    return T.StructType([T.StructField(n, _type(k)) for n, k in (p.split(":", 1) for p in parts)])


def of(ddl: str) -> T.StructType:
    """A schema from its text; unlike fromDDL it needs no session."""
    return T.StructType([T.StructField(n, _type(k)) for n, k in (p.split(" ", 1) for p in _parts(ddl))])


METADATA = of("id string, title string, abstract string, categories string, doi string, comments string, license string, update_date string, versions array<struct<version:string,created:string>>, authors_parsed array<array<string>>")
PAPERS = of("arxiv_id string, title string, abstract string, submitted_date date, updated_date date, primary_category string, doi string, comments string, license string, version_count bigint, github_url string, has_code boolean")
PAPER_LOCAL = of("arxiv_id string, pdf_path string, latex_source_path string, latex_extracted boolean, ocr_model string, ocr_date timestamp, ocr_path string, keyword_for_ocr string, nb_pages_pdf int, nb_pages_ocr int, ocr_done boolean")
OCR_STATS = of("arxiv_id string, page int, n_tokens int, n_chars int, n_images int, error string")
PAPER_CATEGORIES = of("arxiv_id string, category string, is_primary boolean")
AUTHORS = of("author_id bigint, name_raw string, name_normalized string")
PAPER_AUTHORS = of("arxiv_id string, author_id bigint, position int")
CHUNKS = of("chunk_id bigint, arxiv_id string, chunk_index int, char_start int, char_end int, n_tokens int, text string, section string, embed_model string, chunker_version string")
INGESTION_RUNS = of("run_id int, source string, started_at timestamp, completed_at timestamp, n_papers int, n_files int, watermark date, status string, notes string")
ABSTRACT_EMBEDDINGS = of("arxiv_id string, dense_vec array<float>, sparse_weights map<int,float>, embed_model string, embed_date timestamp")
TOPIC_SUBSET = of("topic string, arxiv_id string, hybrid_score double, llm_verdict boolean, rank int, run_id int, created_at timestamp")

KEYS = {
    "papers": ["arxiv_id"], "paper_local": ["arxiv_id"], "ocr_stats": ["arxiv_id", "page"], "paper_categories": ["arxiv_id", "category"],
    "authors": ["author_id"], "paper_authors": ["arxiv_id", "position"], "chunks": ["arxiv_id", "chunk_index"],
    "abstract_embeddings": ["arxiv_id"], "topic_subset": ["topic", "arxiv_id"],
}
