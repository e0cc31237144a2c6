"""Mixing sources to target weights by entropy balancing.

Document rates ``w = min(cap, exp(lambda_s * size / mean_s))`` are the closest to 1 in relative
entropy among all rates in ``[0, cap]`` that give every source its target of words; the
multipliers solve a convex dual, separable by source.  Distributed Newton steps, safeguarded by
a bracket, find them: each step is one aggregate over (source, size) cells, of which there are
at most as many as distinct lengths, whatever the number of documents.  Sums are decimals, so
reruns agree to the bit.

Rounding: cells are walked from long to short documents, a cell gets the whole number of copies
nearest to its expected words plus what earlier cells left over, and its documents share them by
rank of a hash; a source ends within half a short document of its target.

Cases: a NULL text has size 0; size 0 keeps its one copy and takes no words; a NULL source is a
source, last in order; a source without words has target 0; documents that repeat count as often
as they occur, and documents equal in id, source and text get the same copies up to one; a NULL
id is an id like any other; an empty table gives an empty result; other columns are kept by
``mix`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isotherm.functions.ids import dense_index
from isotherm.llm.common import WORD, cut, fresh, ship, stage

BUCKETS = 256
MAX_STEPS = 80
#: Repeated rows are numbered in blocks of 2^13 neighbouring rows.
BLOCK_BITS = 13


def words(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(cells: DataFrame, share: float, weights: Sequence[int], cap: float) -> DataFrame:
    """(source, docs, source_size, target): weighted shares of the words, water-filled below the cap."""
    sources = (cells.groupBy("source").agg(F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("size")).alias("source_size"))
               .withColumn("last", F.isnull("source")))
    ranked = dense_index(sources, ["last", "source"], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = cut(ranked.select("source", "docs", "source_size", weight.alias("weight"),
                               (F.col("source_size") * F.lit(float(cap))).alias("most")))
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:    # the level only rises; a source once at its cap stays there
        full = F.col("weight") * F.lit(level) >= F.col("most")
        now = ranked.agg(F.count(F.when(full, 1)).alias("n"),
                         F.sum(F.when(full, F.col("most").cast("decimal(38,3)"))).alias("at_cap"),
                         F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if now.n == capped or not now.open:
            break
        capped, level = now.n, (total - float(now.at_cap or 0)) / now.open
    return ranked.select("source", "docs", "source_size",
                         F.least(F.col("most"), F.col("weight") * F.lit(level)).alias("target"))


def _rate(cap: float) -> Column:
    """The capped exponential tilt of a cell."""
    return F.when(F.col("full"), F.lit(float(cap))).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.col("multiplier") * F.col("size") / F.col("mean"))))


def solve(cells: DataFrame, targets: DataFrame, cap: float, tolerance: float = 0.5) -> DataFrame:
    """(source, target, mean, full, multiplier): the dual solution of every source."""
    import math

    shortest = cells.where("size > 0").groupBy("source").agg(F.min("size").alias("shortest"))
    t = targets.alias("t").join(shortest.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")))
    mean, need, have = F.col("source_size") / F.col("docs"), F.col("target"), F.col("source_size").cast("double")
    room = mean / F.col("shortest")          # multiplier times (shortest / mean) spans the bracket
    state = cut(t.select("t.source", "target", mean.alias("mean"), (need >= have * cap - 1e-9).alias("full"),
                         F.lit(0.0).alias("multiplier"), (need >= have * cap - 1e-9).alias("done"),
                         F.when(need < have, -F.log(have / F.greatest(need, F.lit(1e-9))) * room).otherwise(0.0).alias("lo"),
                         F.when(need < have, 0.0).otherwise(F.lit(math.log(cap)) * room).alias("hi")))
    for _ in range(MAX_STEPS):
        if not state.where(~F.col("done")).limit(1).count():
            break
        s, c = state.alias("s"), cells.where("size > 0").alias("c")
        tilted = c.join(s.where(~F.col("s.done")), F.col("c.source").eqNullSafe(F.col("s.source")))
        rate, z = _rate(cap), F.col("size") / F.col("mean")
        mass = F.col("n") * F.col("size")
        sums = (tilted.select(F.col("s.source").alias("source"), (mass * rate).cast("decimal(30,6)").alias("g"),
                              F.when(rate < cap, mass * z * rate).otherwise(0.0).cast("decimal(30,6)").alias("h"))
                .groupBy("source").agg(F.sum("g").cast("double").alias("g"), F.sum("h").cast("double").alias("h")))
        j = state.alias("s").join(sums.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")), "left")
        over = F.col("g") - F.col("target")
        lo = F.when(over < 0, F.col("multiplier")).otherwise(F.col("lo"))
        hi = F.when(over > 0, F.col("multiplier")).otherwise(F.col("hi"))
        newton = F.col("multiplier") - F.try_divide(over, F.col("h"))
        following = F.when((newton > lo) & (newton < hi), newton).otherwise((lo + hi) / 2)
        settled = F.col("s.done") | (F.abs(over) <= tolerance) | ((hi - lo) <= 1e-12 * (1 + F.abs(hi)))
        state = cut(j.select("s.source", "target", "mean", "full",
                             F.when(settled, F.col("multiplier")).otherwise(following).alias("multiplier"),
                             settled.alias("done"), F.when(settled, F.col("lo")).otherwise(lo).alias("lo"),
                             F.when(settled, F.col("hi")).otherwise(hi).alias("hi")))
    else:
        raise RuntimeError("the dual did not settle")
    return state.select("source", "target", "mean", "full", "multiplier")


def round_cells(cells: DataFrame, solution: DataFrame, cap: float) -> DataFrame:
    """(source, size, base, extra): whole copies of a cell's documents; ``extra`` of them get one more.

    One group is the cells of one source: as many as it has distinct lengths."""
    top = int(cap)

    def walk(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
        cells_of = frames.sort_values("size", ascending=False)
        left = float(cells_of["target"].iloc[0]) - float((cells_of["n"] * cells_of["size"] * cells_of["rate"]).sum())
        copies = []
        for size, n, rate in zip(cells_of["size"], cells_of["n"], cells_of["rate"]):
            wish = n * rate + left / size
            got = int(min(top * n, max(0, wish + 0.5) // 1))
            left = (wish - got) * size
            copies.append(got)
        out = cells_of[["source", "size", "n"]].copy()
        out["copies"] = copies
        return out

    ship(cells.sparkSession)
    c, s = cells.where("size > 0").alias("c"), solution.alias("s")
    priced = (c.join(s, F.col("c.source").eqNullSafe(F.col("s.source")))
              .select("c.source", "size", "n", "target", _rate(cap).alias("rate")))
    got = priced.groupBy("source").applyInPandas(walk, "source string, size bigint, n bigint, copies bigint")
    return got.select("source", "size", F.expr("copies div n").alias("base"), (F.col("copies") % F.col("n")).alias("extra"))


def allot(docs: DataFrame, share: float = 1.5, weights: Sequence[int] = (3, 1, 2), cap: float = 2.0) -> DataFrame:
    """doc_id, key, source, size, source_size, target, copies, taken: one row per document.

    ``key`` is a hash of id, source and text, the rank order of equal sizes."""
    if cap != int(cap) or cap < 1:
        raise ValueError("the cap on copies is a whole number")
    sized = stage(docs.select("doc_id", F.col("source").cast("string").alias("source"), words("text").alias("size"),
                              F.xxhash64("doc_id", "source", "text").alias("key")), "sizes")
    cells = stage(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    targets = cut(source_targets(cells, share, weights, cap))
    plan = stage(round_cells(cells, solve(cells, targets, cap), cap), "copies")
    # rank within a cell, in buckets of the hash: a cell that holds a third of all rows is still spread
    bucket = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-2 ** 63)), 56)      # unsigned order of the key
    spread = sized.withColumn("bucket", bucket)
    counts = spread.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("m"))
    ahead = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("ahead", F.coalesce(F.sum("m").over(ahead), F.lit(0)))
    steps = (offsets.alias("o").join(plan.alias("p"), null_safe_cols("o", "p", ["source", "size"]), "left")
             .select("o.source", "o.size", "bucket", "ahead", "base", "extra"))
    known = (steps.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
             .select("b.source", "b.size", "bucket", "ahead", "base", "extra", "source_size", "target"))
    within = Window.partitionBy("d.source", "d.size", "d.bucket").orderBy("key", "doc_id")
    joined = (spread.alias("d").join(known.alias("k"), null_safe_cols("d", "k", ["source", "size", "bucket"]))
              .withColumn("place", F.col("ahead") + F.row_number().over(within)))
    copies = F.when(F.col("d.size") == 0, F.lit(1)).otherwise(
        F.col("base") + F.when(F.col("place") <= F.col("extra"), 1).otherwise(0)).cast("long")
    return (joined.select("doc_id", "key", "d.source", F.col("d.size").alias("size"), "source_size", "target",
                          copies.alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def null_safe_cols(a: str, b: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return cond


def mix(docs: DataFrame, share: float = 1.5, weights: Sequence[int] = (3, 1, 2), cap: float = 2.0) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, all columns kept."""
    # a text that occurs n times has n allotted rows of one key: they are dealt to its rows by their number
    given = stage(allot(docs, share, weights, cap).groupBy("doc_id", "key")
                  .agg(F.sum("copies").alias("given"), F.count(F.lit(1)).alias("rows")), "given")
    name = fresh(docs, "__mix")
    key, at, often, copy = f"{name}_key", f"{name}_at", f"{name}_often", f"{name}_copy"
    mine = [F.col(f"`{c}`") for c in docs.columns]
    keyed = (docs.withColumn(key, F.xxhash64("doc_id", F.col("source").cast("string"), "text"))
             .withColumn(at, F.monotonically_increasing_id()).alias("d"))
    rest = F.col("given") % F.col("rows")

    def dealt(part: DataFrame) -> DataFrame:
        """The rows that ``part`` names, with the whole copies of each and how many of them get one more."""
        g = part.select(F.col("doc_id").alias(f"{name}_id"), F.col("key").alias(f"{name}_k"),
                        F.expr("given div rows").alias(often), rest.alias(f"{name}_extra")).alias("g")
        return keyed.join(g, F.col("d.doc_id").eqNullSafe(F.col(f"g.{name}_id")) & (F.col(f"d.{key}") == F.col(f"g.{name}_k")))

    out = dealt(given.where(rest == 0)).select(*mine, often)
    uneven = given.where(rest > 0)
    if uneven.limit(1).count():
        # numbered within blocks of neighbouring rows, so one row that fills the table is still spread; the
        # stage fixes the row numbers
        block = f"{name}_block"
        open_rows = stage(dealt(uneven).select(*mine, key, at, often, f"{name}_extra", F.shiftright(at, BLOCK_BITS).alias(block)), "repeats")
        ahead = Window.partitionBy("doc_id", key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
        sums = (open_rows.groupBy("doc_id", key, block).agg(F.count(F.lit(1)).alias("m"))
                .withColumn("ahead", F.coalesce(F.sum("m").over(ahead), F.lit(0)))
                .select(F.col("doc_id").alias(f"{name}_id"), F.col(key).alias(f"{name}_k"), F.col(block).alias(f"{name}_b"),
                        F.col("ahead").alias(f"{name}_ahead")))
        number = F.row_number().over(Window.partitionBy("doc_id", key, block).orderBy(at))
        placed = open_rows.withColumn(f"{name}_number", number).join(
            sums, F.col("doc_id").eqNullSafe(F.col(f"{name}_id")) & (F.col(key) == F.col(f"{name}_k"))
            & (F.col(block) == F.col(f"{name}_b")))
        more = F.col(f"{name}_number") + F.col(f"{name}_ahead") <= F.col(f"{name}_extra")
        out = out.unionByName(placed.select(*mine, (F.col(often) + more.cast("int")).alias(often)))
    return (out.where(F.col(often) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(often).cast("int"))))
            .select(*mine))
