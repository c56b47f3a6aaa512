"""From raw documents to token ids: five stages, each one of the operators in tallygrid.llm.

Every stage gets what its predecessor kept, written as Parquet and read again. All
but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.llm import bpe, decontaminate, exact, language, neardup
from tallygrid.llm.frames import fresh, keep_ids
from tallygrid.llm.queries import table
from tallygrid.session import materialize

# Below this share of letters with the winning label no language is accepted.
LEAST_SCORE = 0.3
# Words a worker of the last stage remembers: fewer than for the tokenizer alone, as the workers hold the earlier stages' models too.
WORDS = 50_000


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the texts that have a language: letters, and a label for enough of them. Learned from the rows with a lang."""
    model = language.fit(docs)
    pred, score = fresh(docs, "pred", "score")
    judged = language.predict(docs, model, columns=docs.columns, names=(pred, score))
    accepted = (F.col(pred) != language.UNKNOWN) & (F.col(score) >= LEAST_SCORE)
    return judged.filter(accepted).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, keep the longest original."""
    return exact.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, by five-word shingles and a similarity of 0.8."""
    return keep_ids(docs, neardup.near_duplicates(docs).filter("kept"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return keep_ids(docs, decontaminate.leaks(docs, benchmark), "left_anti")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit) of every remaining text, with the digests of ids and of the decoded text."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True, max_pieces=WORDS)


STAGES = [
    ("language ID", identify),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE", tokenise),
]

# SQL cannot express the first, fourth and last stage; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{at}")
    return docs
