"""The stages of the corpus pipeline: documents in, documents or token ids out.

Each stage works on all that the one before kept. A stage whose operator gives decisions per
document joins them back by doc_id; rows that share a doc_id share their decision.

Every stage needs the columns ``COLUMNS`` and returns them, except the last; others are dropped,
whatever they are called. Null source, lang and n_chars pass through; an empty table gives an empty
one; very long texts are worked on whole.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomere.llm import byte_bpe, decontamination, language_id, line_dedup, near_dups
from sonomere.storage import new_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# The least share of a text's words that its language must have.
LEAST_SHARE = 0.4
# Documents with this Jaccard similarity of word shingles are near copies. These bands miss three
# in a million pairs at it.
NEAR_PERCENT = 80
NEAR_SHAPE = near_dups.Shape(rows=6, bands=42)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents whose id is not in ``gone(doc_id)``; those without an id stay."""
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(COLUMNS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; null texts and texts without a letter go, and so does a text
    in which no language has ``LEAST_SHARE`` of the words: a clean one would have to be shared evenly
    by three languages. Rows without an id are judged like others; repeated rows each.
    """
    model = language_id.learn(docs, ~language_id.held_out())
    return language_id.with_main_language(docs.select(COLUMNS), model, LEAST_SHARE)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that stand earlier; a text with nothing left goes. Null and empty
    texts stay as they are; of repeated rows, which share their place, none removes the other.
    """
    return line_dedup.without_repeated_runs(docs.select(COLUMNS))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id. Documents without an id
    or a word stay; repeated rows share a decision and stay or go together.
    """
    found = near_dups.near_duplicates(docs, percent=NEAR_PERCENT, shape=NEAR_SHAPE)
    return _without(docs, found.filter("NOT kept"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Those without an id or a text stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontamination.find_items(docs, benchmark))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, n_tokens)`` of every document left, after a check that they decode to it. Null
    and empty texts have no ids; repeated rows and null ids are encoded like others.
    """
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = byte_bpe.encode(
        docs, vocabulary, public_tokenizers.PATTERN, keep_text=True, decoded=True
    )
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    broken = F.raise_error(F.lit("token ids do not decode to their text")).cast("binary")
    return decoded.select(
        "doc_id",
        F.when(same, F.col("ids")).otherwise(broken).alias("ids"),
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
    )


STAGES = [
    ("language", known_language),
    ("lines", without_repeated_lines),
    ("near copies", one_of_each),
    ("benchmark", without_benchmark),
    ("tokens", token_ids),
]

# Learnt models and token merges are beyond SQL; tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
