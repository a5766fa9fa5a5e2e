"""The operators' queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fim, jaccard, licenses, media, packing, pii, spelling, substring, token_count, toxicity, warc, wavelet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.features(media.write_media(table(spark, sf_dir, "documents")))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.binary_output(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    back = F.sha2(fim.restored(F.col("form"), F.col("text")), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("text", 256).alias("output_sha256"), back.alias("restored_sha256"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def queries() -> dict:
    found = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": warc.ORACLE,
        "op3_jaccard_join": jaccard.ORACLE,
        "op6_license_scan": licenses.oracle(),
        "op7_substring_dedup": substring.ORACLE,
        "op9_decontamination": decontaminate.ORACLE,
        "op11_spelling_variants": spelling.ORACLE,
        "op12_fill_in_middle": fim.ORACLE,
    }
