"""SimHash near-dedup by a segment-popcount embedding.

A fingerprint is embedded as its bit counts over two-bit segments, written as a thermometer
code (0 -> 00, 1 -> 01, 2 -> 11), so that the Manhattan distance of two count vectors is the
popcount of the xor of their codes.  That distance never exceeds the Hamming distance.  The
32-dimensional count space is cut into bands; within the limit ``d`` some band of ``(d+2)//2``
lies within Manhattan distance 1, so a range join on the unit grid of one band (a cell and the
cells next to it) finds every candidate.  The join condition then tests the Manhattan distance
of the whole vector and, exactly, the bits.

Only distinct fingerprints are joined: equal texts are one point.  Of two neighbouring cells
exactly one has an odd sum, so only odd points visit their neighbours.  The grid cells of one
band hold about 2^-22 of unrelated points each; a cell with many near copies is a plain equi-join
key, which AQE splits, and only verified links leave the join.

Cases: NULL and word-less texts have fingerprint zero and link like any other; texts with fewer
words than a shingle hash whole; repeated rows come back repeated, with one component; a NULL
``doc_id`` keeps its row and never names a component that has an id (a component of NULL ids
only has a NULL ``component_id``); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import fresh, ship, stage
from isotherm.llm.components import connected_components

SEED = 42
PIECE = 65_536
EVEN = 0x5555555555555555


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles (repeats included), as an unsigned integer."""
    words = (text or "").encode("utf-8", "replace").lower().split()   # bytes: A-Z and the six blanks only
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for lo in range(0, total, PIECE):                                 # bounded memory for long texts
        n = min(PIECE, total - lo)
        part = words[lo: lo + n + shingle - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, fp) and the columns ``keep``: the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]],
                                             names=["doc_id", "fp", *keep])

    ship(docs.sparkSession)
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"doc_id {kinds['doc_id']}", "fp bigint", *[f"`{c}` {kinds[c]}" for c in keep]])
    return docs.select("doc_id", "text", *keep).mapInArrow(run, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def thermometer(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, in thermometer code."""
    even = F.lit(_signed(EVEN))
    high = F.shiftrightunsigned(fp, 1)
    some, both = fp.bitwiseOR(high).bitwiseAND(even), fp.bitwiseAND(high).bitwiseAND(even)
    return some.bitwiseOR(F.shiftleft(both, 1))


def _bands(max_bits: int) -> list[tuple[int, int]]:
    """Segment ranges; in one of them two points within the limit are at Manhattan distance <= 1."""
    n = (max_bits + 2) // 2
    if n > 8:
        raise ValueError("max_bits above 15 leaves bands too narrow to select on")
    edges = [32 * k // n for k in range(n + 1)]
    return list(zip(edges[:-1], edges[1:]))


def links(points: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints of column ``fp`` that differ in at most ``max_bits`` bits."""
    base = points.select("fp", thermometer(F.col("fp")).alias("code"))
    posts = probes = None
    for band, (lo, hi) in enumerate(_bands(max_bits)):
        mask = _signed(sum(3 << (2 * s) for s in range(lo, hi)))
        cell = F.col("code").bitwiseAND(F.lit(mask))
        steps = []
        for s in range(lo, hi):
            low, high = F.lit(_signed(1 << (2 * s))), F.lit(_signed(2 << (2 * s)))
            # the count of a segment may move 0 <-> 1 (low bit) unless it is 2, and 1 <-> 2 unless it is 0
            steps.append(F.when(F.col("code").bitwiseAND(high) == 0, cell.bitwiseXOR(low)))
            steps.append(F.when(F.col("code").bitwiseAND(low) != 0, cell.bitwiseXOR(high)))
        own = base.select(F.lit(band).alias("band"), cell.alias("cell"), "fp", "code")
        odd = (base.where(F.bit_count(cell) % 2 == 1)
               .select("fp", "code", F.explode(F.array_compact(F.array(*steps))).alias("cell"))
               .select(F.lit(band).alias("band"), "cell", "fp", "code", F.lit(True).alias("near")))
        probe = own.withColumn("near", F.lit(False)).unionByName(odd)
        posts = own if posts is None else posts.unionByName(own)
        probes = probe if probes is None else probes.unionByName(probe)
    p, q = probes.alias("p"), posts.alias("q")
    far = F.bit_count(F.col("p.code").bitwiseXOR(F.col("q.code")))    # Manhattan distance of the counts
    bits = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("q.fp")))
    return (p.join(q, (F.col("p.band") == F.col("q.band")) & (F.col("p.cell") == F.col("q.cell"))
                   & (F.col("p.near") | (F.col("p.fp") < F.col("q.fp")))
                   & (far <= max_bits) & (bits <= max_bits))
            .select(F.col("p.fp").alias("a"), F.col("q.fp").alias("b")))


def _classes(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id, links) of every distinct fingerprint; ``root`` names its component."""
    points = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "points")
    pairs = stage(links(points, max_bits).distinct(), "links")
    degree = (pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp")))
              .groupBy("fp").agg(F.count(F.lit(1)).alias("links")))
    roots = connected_components(pairs, "a", "b").withColumnRenamed("node", "fp")
    classes = (points.join(roots, "fp", "left").join(degree, "fp", "left")
               .select("fp", "least_id", F.coalesce("root", "fp").alias("root"), F.coalesce("links", F.lit(0)).alias("links")))
    heads = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return stage(classes.join(heads, "root").select("fp", "root", "component_id", "links"), "classes")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id, links (distinct texts' fingerprints
    within ``max_bits``)."""
    prints = stage(fingerprints(docs, shingle), "fingerprints")
    return (prints.join(_classes(prints, max_bits).drop("root"), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "links"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (a NULL id after all others), and
    of rows with that id the one of the smallest row hash."""
    row = fresh(docs, "__row")
    # the flags tell apart rows that differ only in which column is NULL
    hashed = docs.withColumn(row, F.xxhash64(*[x for c in docs.columns for x in (F.isnull(f"`{c}`"), F.col(f"`{c}`"))]))
    prints = stage(fingerprints(hashed, shingle, [row]), "fingerprints")
    least = F.min(F.struct(F.isnull("doc_id").alias("late"), "doc_id", row))
    # a minimum per fingerprint first: a text that a third of all rows share is one row of the join
    firsts = prints.groupBy("fp").agg(least.alias("least"))
    heads = (firsts.join(_classes(prints, max_bits).select("fp", "root"), "fp")
             .groupBy("root").agg(F.min("least").alias("least")).select(F.col(f"least.{row}").alias(row)))
    kept = hashed.join(heads, row, "left_semi")      # the hash covers every column, the id too
    return kept.dropDuplicates([row]).select(*[F.col(f"`{c}`") for c in docs.columns])
