"""The training corpus from raw documents: five stages, each written and read by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. Stages judge every document that their predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from earshot.llm import decontaminate, langid, mixing, simhash, tokenids
from earshot.session import remove_path, scratch_path

TOKENIZER = "byte_bpe_50k.json"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the others go."""
    return langid.identified(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of operator 5 (fingerprints of three-word shingles, three bits), the one of the smallest id."""
    return simhash.keep_one(docs.select(*COLUMNS), shingle=simhash.SHINGLE, radius=simhash.RADIUS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    docs = docs.select(*COLUMNS)
    found = decontaminate.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), tuple(COLUMNS))
    return found.where(~found["contaminated"]).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_copies(docs.select(*COLUMNS))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the written token files."""
    path = scratch_path(spark, "token-ids")
    tokenids.write_tokens(docs, path, public_tokenizers.path(TOKENIZER))
    return tokenids.document_digests(tokenids.read_tokens(spark, path))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
    ("token_ids", token_ids),
]
ORACLE_SQL = None  # a trained model and seeded choices: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; tables between stages go as soon as they are read."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.select(*COLUMNS).schema).parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
