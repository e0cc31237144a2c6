"""The ``opN_*`` queries: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.llm import bytecnn, decontam, hilbertpq, interpolation, mixing, oracles, passages, permutation, pii, prefixtrie, pulearn, runs, simhash, wavelet
from isotherm.llm.common import remainder, stage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op12_hilbert_blocks": oracles.hilbert_blocks(rounds=4, parts=4, entries=256, scale=1024),
    "op13_prefix_trie": oracles.PREFIX_TRIE,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.allot(table(spark, sf_dir, "documents"), share=1.5, weights=(3, 1, 2), cap=2.0)
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


@query
def op3_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score(table(spark, sf_dir, "documents"), folds=10)


@query
def op4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passages.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "removed_spans", "removed_words")


@query
def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = permutation.search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), null_ids=True)


@query
def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the key is a parameter of the job; a secret store would supply it
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key="isotherm-demo-key")


@query
def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runs.remove(table(spark, sf_dir, "documents").select("doc_id", "text"), min_lines=1)
    return out.select("doc_id", "text", "removed_runs", "deepest_run")


@query
def op9_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = wavelet.write(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)
    return wavelet.read_documents(files)


@query
def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bytecnn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", 0.3)
    return out.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op11_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pulearn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", 0.3, 4, 2)
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


@query
def op12_hilbert_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = hilbertpq.compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label",
                                      parts=4, entries=256, rounds=4, scale=1024)
    out = hilbertpq.with_group_total(stage(codes, "pq-codes"), "label", "error", "label_error")
    return out.select("vec_id", "code", "error", "label_error",
                      F.lit(hilbertpq.codebooks_digest(books)).alias("codebooks_sha256"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"), family=20, shared=4)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
