"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Both sides are lower-cased and cut into tokens (runs of letters and digits).  Every mask picks
some positions of a token window and ignores the others; the picked tokens' hashes, hashed
together, are a seed.  Training seeds are joined to benchmark seeds; a hit fixes a document, an
item and their offset (diagonal).  Around the hits the aligned tokens are compared: a document is
contaminated by an item when ``window`` aligned tokens (or the whole of a shorter item) agree in
at least ``similarity`` of the positions.

The two masks weigh four tokens; together (each alone too) they hit every 20-token window with
up to 4 substitutions and every 15-token one with up to 3, whatever their places.

Cases: NULL and token-less texts have no seeds; items below ``min_tokens`` tokens are not looked
for; a NULL ``item_id`` row takes no part; rows of NULL ``doc_id`` are searched, each text by itself,
with ``null_ids`` (the query and the pipeline set it), else they take no part in ``matches`` and are
kept by ``remove``; a row is named by its id and text, so of an id with several texts only the
contaminated ones go; rows that repeat give one match; empty tables give an empty result; other
columns are not read by ``matches`` and kept by ``remove``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import broadcast_if_small, fresh, stage

#: Positions a mask looks at; the others may differ.
MASKS = ((0, 1, 3, 4), (0, 1, 2, 5))
WINDOW, SIMILARITY, MIN_TOKENS = 20, 0.8, 8
#: Rows of benchmark seeds, and of document ids, that may be broadcast (about 32 MB each).
MAX_SEEDS, MAX_IDS = 500_000, 1_000_000


def tokens(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _masked(k: int, mask: Sequence[int]) -> Column:
    """Seeds of mask ``k`` at every position of the array ``h`` of token hashes."""
    def at(i: Column) -> Column:
        return F.xxhash64(F.lit(k), *[F.element_at("h", (i + p).cast("int")) for p in mask])

    room = F.size("h") - max(mask)
    return F.when(room > 0, F.transform(F.sequence(F.lit(1), room), at)).otherwise(F.array().cast("array<bigint>"))


def _seeds(df: DataFrame, keep: Sequence[str], masks: Sequence[Sequence[int]]) -> DataFrame:
    """One row per token position and mask: ``keep``, pos, seed."""
    hashed = df.select(*keep, F.transform(tokens("text"), lambda t: F.xxhash64(t)).alias("h"))
    lists = hashed.select(*keep, F.array(*[_masked(k, m) for k, m in enumerate(masks)]).alias("lists"))
    # the outer forms: for the inner ones the optimiser infers a filter that would hash every text again
    return (lists.select(*keep, F.explode_outer("lists").alias("list"))
            .select(*keep, F.posexplode_outer("list").alias("pos", "seed")).where("seed is not null"))


def _row() -> Column:
    """One number for a document: its id and text."""
    return F.xxhash64(F.isnull("doc_id"), "doc_id", "text")


def _found(docs: DataFrame, benchmark: DataFrame, masks: Sequence[Sequence[int]] = MASKS, window: int = WINDOW,
           similarity: float = SIMILARITY, min_tokens: int = MIN_TOKENS, null_ids: bool = False) -> DataFrame:
    """The columns of ``matches``, and ``row``, the document's number."""
    items = stage(benchmark.select("item_id", "text").where("item_id is not null")
                  .where(F.size(tokens("text")) >= min_tokens).distinct(), "items")
    targets = stage(_seeds(items, ["item_id"], masks).withColumnRenamed("pos", "item_pos"), "item-seeds")
    mine = docs.select(_row().alias("row"), "doc_id", "text")
    if not null_ids:
        mine = mine.where("doc_id is not null")
    hits = _seeds(mine, ["row"], masks).join(broadcast_if_small(targets, MAX_SEEDS), "seed")
    lines = stage(hits.select("row", "item_id", (F.col("pos") - F.col("item_pos")).alias("start")).distinct(), "hits")
    suspects = lines.select("row").distinct()
    near = mine.join(broadcast_if_small(suspects, MAX_IDS), "row", "left_semi")
    texts = near.select("row", "doc_id", tokens("text").alias("words")).distinct()
    pairs = (lines.join(texts, "row")
             .join(items.select("item_id", tokens("text").alias("item")), "item_id"))
    agree = F.transform("item", lambda t, i: F.coalesce(
        (F.get("words", (F.col("start") + i).cast("int")) == t).cast("int"), F.lit(0)))
    span = F.least(F.size("item"), F.lit(window))
    sums = F.transform(F.sequence(F.lit(1), F.size("item") - span + 1),
                       lambda i: F.aggregate(F.slice("agree", i, span), F.lit(0), lambda a, x: a + x))
    judged = (pairs.withColumn("agree", agree).withColumn("best", F.array_max(sums))
              .where(F.col("best") >= F.ceil(span * F.lit(similarity)))
              .select("row", "doc_id", "item_id", F.col("start").cast("long").alias("start"), F.size("item").alias("aligned"),
                      F.aggregate("agree", F.lit(0), lambda a, x: a + x).alias("same")))
    best = judged.groupBy("row", "doc_id", "item_id").agg(F.max(F.struct("same", "aligned", (-F.col("start")).alias("back"))).alias("b"))
    return best.select("row", "doc_id", "item_id", (-F.col("b.back")).alias("start"), F.col("b.aligned").alias("aligned"), F.col("b.same").alias("same"))


def matches(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """(doc_id, item_id, start, aligned, same): the best alignment of every contaminated pair.

    ``start`` is the token of the document under the item's first token (negative when the item
    begins before the document), ``aligned`` the tokens compared, ``same`` those that agree."""
    return _found(docs, benchmark, **how).drop("row")


def remove(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the contaminated documents."""
    name = fresh(docs, "__row")
    bad = stage(_found(docs, benchmark, **how).select(F.col("row").alias(name)).distinct(), "contaminated")
    kept = docs.withColumn(name, _row()).join(broadcast_if_small(bad, MAX_IDS), name, "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
