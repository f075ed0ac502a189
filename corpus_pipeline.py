"""A corpus made ready for training: language, near duplicates, benchmark passages, secrets, tokens.

Each stage takes what the one before it kept, written as Parquet in the shared folder. All but the last return the
columns of ``documents``, others with clashing names too, as they are.

Every stage works on whole texts of any length, one row each, so a text must fit into a task; gives no rows for an empty
table; and treats repeated rows alike, so that they stay or go together. Rows without doc_id are documents of their own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from telescale.llm import decontaminate, language, pieces, secrets, simhash
from telescale.session import shared_dir

TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")

#: Fitted models and groups of near duplicates have no SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the rejected ones go, and null texts and those without a letter with them.

    A text of equal cosines has the first of these languages, and stays.
    """
    return language.known_language_only(spark, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id, with all rows of that id.

    Texts without words are near duplicates of each other. Rows without id stay, and cost no other row its place.
    """
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than traces of the benchmark. Null and empty texts hold none and stay."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of secrets, and n_chars of the marked text. Null and empty texts stay so."""
    return secrets.redact_secrets(docs, identifiers=secrets.learn_identifiers(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and whether they decode to it: doc_id, lang, source, ids, n_tokens, decodes.

    Null and empty texts have no ids. Columns that the table lacks are left out, all others are dropped.
    """
    keep = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    return pieces.checked_ids(docs, pieces.read_model(TOKENIZER), keep)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("tokens", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        written = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
    return STAGES[-1][1](spark, docs, sf_dir)
