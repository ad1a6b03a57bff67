"""The corpus pipeline: five whole-table stages from ``documents`` to a token file.

Each stage reads what the stage before wrote (Parquet in the shared folder), works on all
of it, and all but the last keep the columns of ``documents``.

Defined cases: null and empty texts and texts without letters go in the first stage; rows of equal
text, or one row repeated, are one near-duplicate group, of which one row stays; a document
without an id stays if no document with an id is in its group, and its tokens come first; null
sources are a source of their own; a document that the mix repeats is written as often; an empty
table, or one that a stage empties, gives an empty token file; extra columns pass through to
the last stage; very long texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontamination, language, mixing, neardup, tokenfile
from ledgerline.llm.queries import tokenizer_file
from ledgerline.llm.tables import read, scratch, staged

#: a text whose n-grams are this far out of place in every language is in none of them
MIN_LANGUAGE_SCORE = 0.2


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and those like no language learned."""
    return language.recognised(docs, min_score=MIN_LANGUAGE_SCORE)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group of near-duplicates."""
    return neardup.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents contaminated by ``benchmark``."""
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources come near their targets."""
    return mixing.mixed(docs)


def token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token file and return its index: doc_id, start, n_tokens, ids_crc32."""
    path = scratch(spark, "token-file")
    tokenfile.write_tokens(docs, path, tokenizer_file("word_bpe_49k.json"))
    return tokenfile.token_index(tokenfile.read_tokens(spark, path))


STAGES = [
    ("language ID", in_known_language),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed_sources),
    ("token-ID / binary output", token_file),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: shingle sets, learned languages and a tokenizer are not SQL: tests/llm/test_pipeline.py
ORACLE_SQL = None
