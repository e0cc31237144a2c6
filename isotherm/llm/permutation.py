"""Approximate nearest neighbours by a permutation index.

A vector is represented by its ``prefix`` nearest pivots in order.  The index deals all vectors
into shards; a shard posts its vectors in one inverted file per pivot, each posting with the
pivot's place in the vector's order.  A query reads the inverted files of its own pivots and adds
up, posting by posting, the footrule distance of the two orders (a pivot missing from a prefix
counts as at place ``prefix``); the nearest ``share`` of the shard by footrule (ties to smaller
ids) is reranked by exact cosine in double precision.

The pivots are a bounded sample (``PIVOTS`` vectors of smallest id hash); every vector is indexed.
Queries meet shards in blocks of bounded size, and only each block's best rows leave the task.

Cases: vectors that are NULL, all zero, or that hold NULL or non-finite components take no part, nor
do those of another length than most, with which no cosine is defined, or of a NULL id.  Every other
row is indexed: rows of one id are candidates each for itself, and queries each for itself; a row is
left out of its own query only.  Equal scores go to the smaller id, then to the row read first; with
fewer candidates than ``k`` all are returned; empty tables give an empty result; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isotherm.llm.common import parts_for, ship, stage

PIVOTS, PREFIX, SHARE, LEAST = 256, 64, 0.10, 200
SHARD_ROWS, BLOCK_QUERIES = 25_000, 4_000


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ok & F.exists(vector, lambda x: x != 0)


def _unit(rows) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in rows])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _orders(unit: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of every vector, in order, ties by pivot number."""
    return np.argsort(-np.round(unit @ pivots.T, 12), axis=1, kind="stable")[:, :prefix]


def index(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, np.ndarray]:
    """The valid vectors (row, id, vec), one for every row, and the pivots."""
    v = F.col(vec_col).cast("array<double>")
    good = vectors.select(F.col(id_col).alias("id"), v.alias("vec")).where("id is not null").where(usable(F.col("vec")))
    good = stage(good.select(F.monotonically_increasing_id().alias("row"), "id", "vec"), "vectors")
    lengths = good.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return good, np.zeros((0, 0))
    good = good.where(F.size("vec") == lengths.n)
    picked = good.orderBy(F.xxhash64("id"), "id", F.xxhash64("vec")).limit(PIVOTS).collect()    # bounded
    return good, _unit([r.vec for r in picked])


def search(vectors: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = 5, prefix: int = PREFIX,
           share: float = SHARE) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found for every vector that ``is_query`` marks."""
    ship(vectors.sparkSession)
    good, pivots = index(vectors, id_col, vec_col)
    prefix = min(prefix, len(pivots))
    asked = good.where(is_query)
    rows, queries = good.count(), asked.count()
    shards, blocks = parts_for(rows, SHARD_ROWS), parts_for(queries, BLOCK_QUERIES)
    place = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("row", F.lit(2)), F.lit(blocks)).cast("int")
    left = good.select("row", "id", "vec", place.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = asked.select("row", "id", "vec", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))

    def run(mine: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "query_id": [], "row": [], "id": [], "score": []})
        if not len(mine) or not len(ask):
            return empty
        mine, ask = mine.sort_values(["id", "row"]), ask.sort_values(["id", "row"])
        ids, rows_, raw = mine["id"].to_numpy(), mine["row"].to_numpy(), np.array(mine["vec"].tolist(), np.float64)
        norms = np.sqrt((raw * raw).sum(axis=1))
        order = _orders(raw / norms[:, None], pivots, prefix)
        # inverted files: postings (row, place) sorted by pivot
        flat = order.ravel()
        by = np.argsort(flat, kind="stable")
        row, at = (by // prefix).astype(np.int32), (by % prefix).astype(np.int32)
        edge = np.searchsorted(flat[by], np.arange(len(pivots) + 1))
        take = min(len(ids), max(LEAST, int(np.ceil(share * len(ids)))) + 1)
        qraw = np.array(ask["vec"].tolist(), np.float64)
        qorder = _orders(_unit(ask["vec"].tolist()), pivots, prefix)
        number = np.arange(len(ids), dtype=np.int64)
        out = []
        for q, (qrow, qid, x) in enumerate(zip(ask["row"].to_numpy(), ask["id"].to_numpy(), qraw)):
            foot = np.zeros(len(ids), np.int32)                     # footrule up to a constant
            for spot, p in enumerate(qorder[q]):
                s = slice(edge[p], edge[p + 1])
                foot[row[s]] += np.abs(at[s] - spot) - (prefix - spot) - (prefix - at[s])
            key = foot.astype(np.int64) * len(ids) + number         # ties to smaller ids
            near = np.argpartition(key, take - 1)[:take] if take < len(ids) else number
            near = near[rows_[near] != qrow]
            score = (raw[near] * x).sum(axis=1) / (norms[near] * np.sqrt((x * x).sum()))
            best = np.lexsort((rows_[near], ids[near], -score))[:k]
            out.append(pd.DataFrame({"query": qrow, "query_id": qid, "row": rows_[near[best]], "id": ids[near[best]],
                                     "score": score[best]}))
        return pd.concat(out)

    kind = dict(good.dtypes)["id"]
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        run, f"query long, query_id {kind}, row long, id {kind}, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
