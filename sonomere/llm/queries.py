"""One query per operator over whole tables, with production parameters."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomere.llm import (
    byte_bpe, decontamination, language_id, line_dedup, merkle, near_dups, paragraph_dedup,
    periodic_runs, quality, surrogates, token_counts, token_files, warc,
)
from sonomere.storage import new_path

TOKEN_LIMIT = 4096
END_ID = 2
# The key of a real corpus is a secret; this one makes the query's rows reproducible.
SURROGATE_KEY = b"public example key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontamination.find_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op2_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    path = new_path(spark, "token-files")
    token_files.write_token_files(
        table(spark, sf_dir, "documents"),
        path,
        public_tokenizers.path("byte_bpe_50k.json"),
        END_ID,
    )
    return token_files.read_token_files(
        spark.read.parquet(path), token_files.crc32, "ids_crc32", "bigint"
    )


def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents and which of each group stays."""
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op4_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of all documents and which of them go."""
    return paragraph_dedup.repeated_paragraphs(table(spark, sf_dir, "documents"))


def op5_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learnt from those that are not held out."""
    documents = table(spark, sf_dir, "documents")
    model = language_id.learn(documents, ~language_id.held_out())
    found = language_id.identify(documents, model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op6_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    return byte_bpe.round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op7_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    documents = table(spark, sf_dir, "documents")
    model = quality.learn(documents, table(spark, sf_dir, "labels"))
    return quality.judge(documents, model).drop("boilerplate")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates in place of personal data."""
    return surrogates.replace_entities(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op9_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated runs of lines."""
    cut = line_dedup.delete_repeated_runs(table(spark, sf_dir, "documents"), exact=True)
    return cut.select("doc_id", "n_lines", "n_deleted", F.md5("text").alias("text_md5"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, and which of them exceed a context."""
    counts = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def archived_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Pages written to web archives under ``folder`` and read back."""
    payload = F.encode("html", "UTF-8").alias("payload")
    marked = warc.with_first_of_equals(pages.select("page_id", "url", payload))
    records = warc.read_archives(warc.write_archives(marked, folder))
    kind = pages.schema["page_id"].dataType.simpleString()
    page = lambda urn: F.nullif(F.substring_index(urn, ":", -1), F.lit("")).cast(kind)
    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"),
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, archived and read back."""
    return archived_pages(table(spark, sf_dir, "pages"), new_path(spark, "archives"))


# What a leaf holds of a document, and the checksums whose documents are tampered with.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 7


def audited_documents(documents: DataFrame) -> DataFrame:
    """The manifest of documents, held against a copy of which every seventh was tampered with."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    changed = F.when(checksum % TAMPERED == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    claimed = [changed if c == "n_chars" else F.col(c) for c in LEAF_COLUMNS]
    return merkle.merkle_manifest(documents, LEAF_COLUMNS, "lang", "doc_id", claimed).drop("path")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their proofs and what an audit of a tampered copy says."""
    return audited_documents(table(spark, sf_dir, "documents"))


def periodic_digests(documents: DataFrame) -> DataFrame:
    """The runs of documents with planted ones, as counts and digests."""
    found = periodic_runs.find_periodic_runs(periodic_runs.with_planted_runs(documents))
    top = periodic_runs.longest(F.col("runs"))
    length, period = -top["less"], top["period"]
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), top["start"].alias("start"),
        length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2(periodic_runs.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents."""
    return periodic_digests(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_repair_token_files,
        op3_hyperminhash,
        op4_paragraph_minhash,
        op5_crf_language_id,
        op6_segment_tree_bpe,
        op7_line_crf_quality,
        op8_surrogates,
        op9_line_winnowing,
        op10_token_counts,
        op11_warc,
        op12_merkle_manifest,
        op13_periodic_runs,
    )
}
