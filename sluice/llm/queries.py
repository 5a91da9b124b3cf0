"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import filter_audit


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pii_key(spark: SparkSession) -> str:
    """The secret of ``spark.sluice.pii.key``; the queries here run without one under a key that is none."""
    return spark.conf.get("spark.sluice.pii.key", "not-a-secret")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pseudonymise

    return pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), pii_key(spark), count="n_replaced")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import digest, round_trip

    return digest(round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import digest, round_trip

    return digest(round_trip(_table(spark, sf_dir, "pages")))


def op5_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import digest, round_trip

    return digest(round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify

    return identify(_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    return judge(_table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract

    return extract(_table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import digest, pack

    return digest(pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op10_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import audit_documents

    return audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic import digest, find, periodic_tail

    return digest(find(_table(spark, sf_dir, "documents"), words=periodic_tail))


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import digest, remove_repeats

    return digest(remove_repeats(_table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_token_files": op3_token_files,
    "op4_warc": op4_warc,
    "op5_merge_replay": op5_merge_replay,
    "op6_language": op6_language,
    "op7_quality": op7_quality,
    "op8_html_text": op8_html_text,
    "op9_packing": op9_packing,
    "op10_vector_near_dedup": op10_vector_near_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_repeated_passages": op13_repeated_passages,
}

#: The other operators are not plain SQL; they are tested against brute-force versions, round trips or held-out rows.
ORACLE_SQL: dict[str, str] = {"op11_filter_audit": filter_audit.ORACLE_SQL}
