"""A training corpus from raw documents, in five stages, each written and read again.

Quality classifier, SimHash near-dedup, benchmark decontamination, mixing to target weights, and
token shards.  Every stage works on all documents its predecessor kept.  The mixing stage repeats
or leaves out documents; the last returns one row per document of the mixed corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.llm import bytecnn, decontam, mixing, simhash, wavelet
from isotherm.llm.common import fresh, stage, table
from isotherm.llm.queries import vocabulary

#: The stages train a model, follow links to their end and solve for multipliers: no SQL twin.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = bytecnn.train(bytecnn.training_rows(docs, table(spark, sf_dir, "labels"), "quality"))
    score = fresh(docs, "__score")
    return bytecnn.score(docs, model, score).where(F.col(score) >= 0.3).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"), null_ids=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mix(docs, share=1.5, weights=(3, 1, 2), cap=2.0)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    return wavelet.read_documents(wavelet.write(docs, vocabulary("word_bpe_49k.json"), end_id=2))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_shards", token_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
