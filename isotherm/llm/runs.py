"""Line dedup: repeated runs of lines, by a suffix array over line ids.

Every non-blank line gets an id; a document is a sequence of ids.  Prefix doubling names the runs
of 1, 2, 4, ... lines that begin at each position by their rank in lexicographic order: the name of
2h lines is the dense rank of the pair (name at i, name at i + h).  Positions whose run is unique
leave the computation at once (every longer run from there is unique as well), so each level holds
only repeats, and the last level is reached when none is left, at the latest at the longest
document.  The positions of one name at a level are an interval of the suffix array whose longest
common prefix is at least that level's length; nested levels give nested intervals.

Of an interval of at least ``min_lines`` lines the earliest occurrence by (doc_id, position)
stays; the lines of all later copies are deleted, except lines that an earliest occurrence needs.
Neighbouring deleted lines form the maximal repeated run.

Ranks come from a distributed dense index, first occurrences from map-side minima, and every join
key is a position or a name, so no task gathers a frequent line.

Cases: NULL and empty texts have no lines and stay as they are; blank lines belong to no run and
are kept; lines are compared after trimming; a NULL ``doc_id`` ranks after all ids; rows equal in
id and text are one document and lose the same lines; an empty table gives an empty result; other
columns are kept by ``remove`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.functions.ids import dense_index
from isotherm.llm.common import fresh, ship, stage

MIN_LINES = 2


def _document() -> Column:
    """One number for a document: its id and text."""
    return F.xxhash64(F.isnull("doc_id"), "doc_id", "text")


def lines(docs: DataFrame) -> DataFrame:
    """(doc, late, doc_id, pos, d1, d2): the non-blank lines, numbered by pos."""
    split = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    kept = F.transform(split, lambda x: F.struct(F.xxhash64(x).alias("d1"), F.xxhash64(F.lit(1), x).alias("d2")))
    base = docs.select(
        _document().alias("doc"), F.isnull("doc_id").alias("late"), "doc_id", kept.alias("kept"))
    # the outer form: for the inner one the optimiser infers a filter that would split every text again
    rows = base.select("doc", "late", "doc_id", F.posexplode_outer("kept").alias("pos", "s")).where("pos is not null")
    return rows.select("doc", "late", "doc_id", "pos", "s.d1", "s.d2")


def _level(named: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows whose ``keys`` occur at more than one position, with the keys' dense rank as ``rank``."""
    at = F.struct("doc", "pos")
    repeated = named.groupBy(*keys).agg(F.min(at).alias("a"), F.max(at).alias("b")).where("a != b").select(*keys)
    ranked = dense_index(repeated, keys, "__rank").hint("shuffle_merge")
    return stage(named.join(ranked, keys).select("doc", "late", "doc_id", "pos", F.col("__rank").alias("rank"))
                 .dropDuplicates(["doc", "pos"]), name)


def levels(all_lines: DataFrame) -> list[DataFrame]:
    """Level k: (doc, late, doc_id, pos, rank) of the positions whose run of 2^k lines occurs again."""
    out = [_level(all_lines, ["d1", "d2"], "runs-0")]
    while out[-1].limit(1).count():
        here, step = out[-1], 1 << (len(out) - 1)
        following = here.select("doc", (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"))
        out.append(_level(here.join(following.hint("shuffle_merge"), ["doc", "pos"]), ["rank", "next"], f"runs-{len(out)}"))
    return out[:-1]


def _of_length(found: list[DataFrame], n: int) -> DataFrame:
    """The positions whose run of ``n`` lines may occur again; (k1, k2) names the run."""
    k = n.bit_length() - 1
    base = found[k].withColumnRenamed("rank", "k1")
    if n == 1 << k:
        return base.withColumn("k2", F.lit(0))
    tail = found[k].select("doc", (F.col("pos") - (n - (1 << k))).alias("pos"), F.col("rank").alias("k2"))
    return base.join(tail.hint("shuffle_merge"), ["doc", "pos"])


def copies(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(doc, gone, deepest): places, among the non-blank lines, of the lines to delete of every document
    with a later copy, and the length of the deepest interval that one of its positions belongs to."""
    found = levels(stage(lines(docs), "lines"))
    if min_lines.bit_length() > len(found):
        return docs.sparkSession.createDataFrame([], "doc bigint, gone array<int>, deepest int")
    place = F.struct("late", "doc_id", "doc", "pos")
    runs = _of_length(found, min_lines)
    heads = (runs.groupBy("k1", "k2").agg(F.min(place).alias("head"), F.max(place).alias("tail"))
             .where("head != tail").select("k1", "k2", "head").hint("shuffle_merge"))
    marked = runs.join(heads, ["k1", "k2"]).select(
        "doc", F.explode(F.sequence(F.col("pos"), F.col("pos") + min_lines - 1)).alias("pos"), (place == F.col("head")).alias("first"))
    gone = marked.groupBy("doc", "pos").agg(F.max("first").alias("needed")).where("not needed")
    lists = gone.groupBy("doc").agg(F.sort_array(F.collect_list("pos")).alias("gone"))
    depth = None
    for k, level in enumerate(found):
        of = level.select("doc", F.lit(1 << k).alias("n"))
        depth = of if depth is None else depth.unionByName(of)
    depth = depth.groupBy("doc").agg(F.max("n").alias("deepest"))
    return stage(lists.join(depth, "doc"), "copies")


def remove(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` without later copies of repeated line runs; removed_runs (first line, number of lines, of the
    original text) and deepest_run are appended."""
    found = copies(docs, min_lines).hint("shuffle_merge").alias("r")
    name = fresh(docs, "__doc")
    joined = docs.withColumn(name, _document()).alias("d").join(found, F.col(f"d.{name}") == F.col("r.doc"), "left")
    wide = joined.select(*[F.col(f"d.`{c}`") for c in docs.columns],
                         F.coalesce("r.deepest", F.lit(0)).alias("__deepest"), F.col("r.gone").alias("__gone"))
    run_type = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("lines", T.IntegerType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("removed_runs", run_type), T.StructField("deepest_run", T.IntegerType())])
    at, names = docs.columns.index("text"), [*docs.columns, "removed_runs", "deepest_run"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("line", pa.int32()), ("lines", pa.int32())]))
        for b in batches:
            texts, spans = [], []
            for text, gone in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                here, rows = [], text.split("\n") if gone else []
                full = [k for k, x in enumerate(rows) if x.strip(" ")]
                drop = {full[p] for p in gone or []}
                for line in sorted(drop):
                    if here and here[-1]["line"] + here[-1]["lines"] == line:
                        here[-1]["lines"] += 1
                    else:
                        here.append({"line": line, "lines": 1})
                if drop:
                    text = "\n".join([x for k, x in enumerate(rows) if k not in drop])
                texts.append(text)
                spans.append(here)
            cols = list(b.columns[:-2])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(spans, kind), b.column(b.num_columns - 2)], names=names)

    ship(docs.sparkSession)
    return wide.mapInArrow(run, schema)
