"""Conversation prefix trie by van Emde Boas recursion.

A sequence is cut at half its (power of two) depth, the halves again, down to blocks of ``BASE``
turns.  Going up, the digests of two neighbouring full blocks give the digest of the double block;
going down, the name of a cut prefix is hashed from the name of the prefix where its upper half
starts and the digest of that half.  So all upper tries and lower forests of one level are named in
one job, and a depth of D takes log2(D / BASE) jobs each way.  Inside a block, names are chained
row by row.  Names and digests are 128 bits of SHA-256.

Totals are grafted upward in the same recursion: first every block sums its own nodes, then, level by
level, the totals of the trees at the top of a lower half are added to all their ancestors in the
upper half.  A node is held by its smallest conversation, whose path names those ancestors.

No step gathers a group: turns are numbered in a range-partitioned, written frame; blocks hold BASE
turns; nodes are counted in partial aggregates; hot parents are looked up by broadcast of a bounded
list; the ids of a node's members are hashed as a sorted stream, whose pieces beyond one task are
joined in order by one stream per node.

Cases: turns are ordered by ``turn`` (NULL first), turns of equal number by the digest of their role
and text; NULL roles and texts count as empty; repeated rows are turns of their own.  Rows of a NULL
conv_id belong to no conversation.  An empty table has no node.  Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from isotherm.llm.common import WORD, parts_for, ship, stage

BASE = 16
ROOT = b"\0" * 16
#: Conversations are joined by pieces of this many turns, so that a long one is many keys.
PIECE = 4096
#: Parents of more than this share of all nodes are looked up by broadcast: at most 1 / share of them.
HOT_SHARE = 1e-3
#: Ids in one piece of a hashed stream.
STREAM = 50_000


def _digest(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turns(conv: DataFrame) -> DataFrame:
    """conv, pos (from 1 in each conversation), tok (digest of role and text), words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    tok = _digest(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "utf-8"))
    raw = conv.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", tok.alias("tok"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("row"))
    raw = stage(raw, "trie-turns")
    n = parts_for(raw.count(), 200_000, int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("tok"), F.col("row")]
    placed = raw.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def number(batches):
        part, last, at = TaskContext.get().partitionId(), None, 0
        for b in batches:
            out = []
            for c in b.column(0).to_pylist():
                at = at + 1 if c == last else 1
                last = c
                out.append(at)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out, pa.int64()), b.column(2), b.column(3), pa.array([part] * len(out), pa.int32())],
                names=["conv", "pos", "tok", "words", "part"])

    ship(conv.sparkSession)
    local = stage(placed.mapInArrow(number, "conv long, pos long, tok binary, words long, part int"), "trie-numbered")
    # a conversation in several partitions: the first of each continues the one before, so at most
    # one conversation per partition needs an offset
    runs = local.groupBy("conv", "part").agg(F.max("pos").alias("n"))
    spanning = runs.groupBy("conv").agg(F.count(F.lit(1)).alias("k"), F.collect_list(F.struct("part", "n")).alias("runs")).where("k > 1")
    before = F.transform("runs", lambda r: F.struct(
        r["part"].alias("part"),
        F.aggregate("runs", F.lit(0).cast("long"), lambda a, o: a + F.when(o["part"] < r["part"], o["n"]).otherwise(0)).alias("skip")))
    offsets = spanning.select("conv", F.inline(before))
    return (local.join(F.broadcast(offsets), ["conv", "part"], "left")
            .select("conv", (F.col("pos") + F.coalesce("skip", F.lit(0))).alias("pos"), "tok", "words"))


def rebuild(own: DataFrame, family: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose opening comes from their family's first one.

    Conversation c starts with the first h turns of c - c % family (h = crc32(decimal c) % shared) and
    goes on with its own turns after its first h.  Returns (conv, depth, tok, words) and, per
    conversation, (conv, n) with the number of its turns."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % F.lit(shared)
    base = F.col("conv") - F.col("conv") % F.lit(family)
    lengths = own.groupBy("conv").agg(F.max("pos").alias("own"))
    heads = own.where((F.col("conv") % family == 0) & (F.col("pos") < shared))
    listed = heads.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("pos", "tok", "words"))).alias("head"))
    convs = (lengths.withColumn("h", h).withColumn("base", base)
             .join(listed.withColumnRenamed("conv", "base"), "base", "left")
             .withColumn("head", F.slice(F.coalesce("head", F.array().cast(listed.schema["head"].dataType)), 1, F.col("h").cast("int")))
             .withColumn("got", F.size("head").cast("long")))
    convs = stage(convs.select("conv", "own", "h", "head", "got"), "trie-convs")
    opening = convs.select("conv", F.inline("head")).select("conv", F.col("pos").alias("depth"), "tok", "words")
    shifted = convs.where("got < h and own > h").select(
        "conv", (F.col("h") - F.col("got")).alias("back"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("own") / PIECE).cast("long"))).alias("piece"))
    rest = (own.withColumn("h", h).where("pos > h").withColumn("piece", F.floor(F.col("pos") / PIECE).cast("long"))
            .join(shifted, ["conv", "piece"], "left")
            .select("conv", (F.col("pos") - F.coalesce("back", F.lit(0))).alias("depth"), "tok", "words"))
    n = F.col("got") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return opening.unionByName(rest), convs.select("conv", n.alias("n"))


def blocks(seqs: DataFrame) -> DataFrame:
    """(conv, block, toks, words): up to BASE consecutive turns a row."""
    return (seqs.groupBy("conv", F.floor((F.col("depth") - 1) / BASE).cast("long").alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("depth", "tok", "words"))).alias("t"))
            .select("conv", "block", F.col("t.tok").alias("toks"), F.col("t.words").alias("words")))


def name_prefixes(base: DataFrame, lengths: DataFrame, levels: int) -> DataFrame:
    """``base`` with ``start``, the name of the prefix before the block, and ``end``, that of the
    prefix up to the end of a full block.  ``levels`` halvings lead from the whole to one block."""
    full = (F.size("toks") == BASE)
    short = base.where("long is null") if levels else base
    whole = _digest(F.concat(*[F.get("toks", F.lit(i)) for i in range(BASE)]))
    named = short.withColumn("start", F.lit(ROOT)).withColumn("end", F.when(full, _digest(F.lit(ROOT), whole)))
    if not levels:
        return named
    long = base.where("long")
    digests = [stage(long.where(full).select("conv", "block", whole.alias("d")), "trie-digests")]
    for _ in range(levels):                                      # up: digests of double blocks
        pair = digests[-1].groupBy("conv", F.shiftright("block", 1).alias("block")).agg(
            F.max(F.when(F.col("block") % 2 == 0, F.col("d"))).alias("a"),
            F.max(F.when(F.col("block") % 2 == 1, F.col("d"))).alias("b"))
        digests.append(stage(pair.where("a is not null and b is not null").select("conv", "block", _digest(F.col("a"), F.col("b")).alias("d")), "trie-digests"))
    top = digests[levels]
    ranges = (lengths.where(F.col("n") > BASE).join(top.select("conv", F.col("d").alias("d")), "conv", "left")
              .select("conv", "n", F.lit(0).cast("long").alias("block"), F.lit(ROOT).alias("start"),
                      F.when(F.col("d").isNotNull(), _digest(F.lit(ROOT), F.col("d"))).alias("end")))
    for level in range(levels - 1, -1, -1):                      # down: upper halves and lower forests
        upper = digests[level].where(F.col("block") % 2 == 0).select("conv", F.shiftright("block", 1).alias("block"), "d")
        at = ranges.join(upper, ["conv", "block"], "left").withColumn(
            "middle", F.when(F.col("d").isNotNull(), _digest(F.col("start"), F.col("d"))))
        first_below = (2 * F.col("block") + 1) * (BASE << level)
        halves = F.array(F.struct((2 * F.col("block")).alias("block"), F.col("start").alias("start"), F.col("middle").alias("end")),
                         F.struct((2 * F.col("block") + 1).alias("block"), F.col("middle").alias("start"), F.col("end").alias("end")))
        halves = F.when(F.col("n") > first_below, halves).otherwise(F.slice(halves, 1, 1))
        ranges = stage(at.select("conv", "n", F.inline(halves)), "trie-ranges")
    return named.unionByName(long.join(ranges.select("conv", "block", "start", "end"), ["conv", "block"]))


def chain(named: DataFrame) -> DataFrame:
    """(conv, block, long, words, names): the name of every prefix that ends in the block, then the
    name before it at index 0 of ``above``."""
    names = F.aggregate("toks", F.array("start"), lambda a, t: F.concat(a, F.array(_digest(F.element_at(a, -1), t))))
    last = F.when(F.size("toks") == BASE, F.concat(F.slice("c", 2, BASE - 1), F.array("end"))).otherwise(F.expr("slice(c, 2, size(c) - 1)"))
    return (named.withColumn("c", names).withColumn("names", last)
            .select("conv", "block", "long", "words", "names",
                    F.expr("concat(array(start), slice(names, 1, size(names) - 1))").alias("above")))


def _member_digests(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256) of the conversations that end at each node, ids ascending, comma-joined."""
    spark = ends.sparkSession
    n = parts_for(ends.count(), 200_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = ends.repartitionByRange(n, "name", "conv").sortWithinPartitions("name", "conv")
    schema = "name binary, part int, at int, piece binary, sha string"

    def pieces(batches):
        """Whole nodes as digests; the first and the last node of a task, which may go on in its
        neighbours, as pieces of joined ids."""
        part = TaskContext.get().partitionId()
        name, first, at, held, h = None, True, 0, [], None

        def row(piece, sha):
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.binary()), pa.array([part], pa.int32()), pa.array([at], pa.int32()),
                 pa.array([piece], pa.binary()), pa.array([sha], pa.string())], names=["name", "part", "at", "piece", "sha"])

        # a node that is not the task's first is hashed and its pieces are kept until the next begins
        open_rows: list = []
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k != name:
                    if name is not None:
                        if held:
                            open_rows.append(row(",".join(held).encode(), None))
                        if first:
                            yield from open_rows
                        else:
                            for r in open_rows:
                                h.update((b"," if h_used else b"") + r.column(3)[0].as_py())
                                h_used = True
                            yield row(None, h.hexdigest())
                        first = False
                    name, at, held, open_rows, h, h_used = k, 0, [], [], hashlib.sha256(), False
                held.append(str(c))
                if len(held) == STREAM:
                    open_rows.append(row(",".join(held).encode(), None))
                    at, held = at + 1, []
                    if first:
                        yield from open_rows
                        open_rows = []
        if name is not None:
            if held:
                open_rows.append(row(",".join(held).encode(), None))
            yield from open_rows

    found = stage(placed.mapInArrow(pieces, schema), "trie-ends")

    def join(batches):
        name, h = None, None
        for b in batches:
            for k, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k != name:
                    if name is not None:
                        yield pa.RecordBatch.from_pydict({"name": pa.array([name], pa.binary()), "sha": [h.hexdigest()]})
                    name, h, sep = k, hashlib.sha256(), b""
                h.update(sep + piece)
                sep = b","
        if name is not None:
            yield pa.RecordBatch.from_pydict({"name": pa.array([name], pa.binary()), "sha": [h.hexdigest()]})

    streams = (found.where("sha is null").select("name", "part", "at", "piece").repartition("name")
               .sortWithinPartitions("name", "part", "at").select("name", "piece"))
    return (found.where("sha is not null").select("name", "sha")
            .unionByName(streams.mapInArrow(join, "name binary, sha string")))


def _graft(paths: DataFrame, nodes: DataFrame, levels: int) -> DataFrame:
    """(name, leaves, saved): totals of every node's subtree, itself included.

    ``nodes``: name, conv, depth, leaf, cost.  ``paths``: conv, block, long, names."""
    place = ((F.col("depth") - 1) % BASE).cast("int")
    held = (nodes.groupBy("conv", F.floor((F.col("depth") - 1) / BASE).cast("long").alias("block"))
            .agg(F.collect_list(F.struct(place.alias("i"), "leaf", "cost")).alias("own")))
    below = lambda f: F.transform("names", lambda _, i: F.aggregate(
        "own", F.lit(0).cast("long"), lambda a, o: a + F.when(o["i"] >= i, o[f]).otherwise(F.lit(0).cast("long"))))
    totals = (paths.join(held, ["conv", "block"])
              .select(F.inline(F.arrays_zip(F.col("names").alias("name"), below("leaf").alias("leaves"), below("cost").alias("saved"))))
              .groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    if not levels:
        return totals
    tops = nodes.where((F.col("depth") > BASE) & ((F.col("depth") - 1) % BASE == 0)).select(
        "name", "conv", ((F.col("depth") - 1) / BASE).cast("long").alias("top"))
    long = paths.where("long").select("conv", "block", "names")
    totals = stage(totals, "trie-totals")
    for level in range(levels):
        size = 1 << level
        lower = tops.where(F.col("top") % (2 * size) == size)
        trees = lower.join(totals, "name").select("conv", "top", "leaves", "saved")
        # every tree meets the blocks of the upper half on its own conversation's path, one key a block
        above = trees.withColumn("hi", F.explode(F.sequence(F.lit(0), F.lit((size - 1) // 1024)))).withColumn(
            "lo", F.explode(F.sequence(F.lit(0), F.lit(min(size, 1024) - 1)))).select(
            "conv", (F.col("top") - size + F.col("hi") * 1024 + F.col("lo")).alias("block"), "leaves", "saved")
        add = (above.join(long, ["conv", "block"]).select(F.explode("names").alias("name"), "leaves", "saved")
               .groupBy("name").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        totals = stage(totals.join(add, "name", "left").select(
            "name", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "trie-totals")
    return totals


def trie(seqs: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv, depth, tok, words) sequences; ``lengths`` has every conversation
    with its number of turns, 0 included.  The root's words are none."""
    lengths = stage(lengths, "trie-lengths")
    deepest = lengths.agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("k"), F.min("conv").alias("c")).first()
    if not deepest.k:
        return seqs.sparkSession.createDataFrame([], NODES)
    levels = 0
    while BASE << levels < deepest.n:
        levels += 1
    base = blocks(seqs).withColumn("long", F.lit(None).cast("boolean"))
    if levels:
        # blocks of conversations longer than one block, told by a second block or a full first one
        last = lengths.where(F.col("n") > BASE).select("conv", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BASE).cast("long"))).alias("block"))
        base = base.drop("long").join(last.withColumn("long", F.lit(True)), ["conv", "block"], "left")
    base = stage(base, "trie-blocks")
    paths = stage(chain(name_prefixes(base, lengths, levels)), "trie-paths")
    each = paths.select("conv", "block", F.posexplode(F.arrays_zip(F.col("names").alias("name"), F.col("above").alias("up"), F.col("words").alias("words"))))
    nodes = (each.groupBy(F.col("col.name").alias("name"))
             .agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.any_value("col.up").alias("up"),
                  F.any_value("col.words").alias("words"), F.any_value(F.col("block") * BASE + F.col("pos") + 1).alias("depth")))
    nodes = stage(nodes, "trie-nodes")
    children = nodes.groupBy(F.col("up").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stage(nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")
    valued = nodes.select("name", "conv", "depth", (F.col("n_children") == 0).cast("long").alias("leaf"),
                          ((F.col("n_convs") - 1) * F.col("words")).alias("cost"))
    totals = _graft(paths, valued, levels)

    # names of the nodes where conversations end
    tip = F.element_at("names", -1)
    last = paths.join(lengths.where("n > 0").select("conv", F.floor((F.col("n") - 1) / BASE).cast("long").alias("block")),
                      ["conv", "block"], "left_semi").select(tip.alias("name"), "conv")
    ends = _member_digests(stage(last.unionByName(lengths.where("n = 0").select(F.lit(ROOT).alias("name"), "conv")), "trie-tips"))

    full = nodes.join(totals, "name")
    firsts = full.where("depth = 1").agg(F.count(F.lit(1)), F.sum("leaves"), F.sum("saved")).first()
    root = seqs.sparkSession.createDataFrame(
        [(ROOT, deepest.c, deepest.k, None, 0, firsts[0], firsts[1] or 1, firsts[2] or 0)],
        "name binary, conv long, n_convs long, up binary, depth long, n_children long, leaves long, saved long")
    every = stage(full.select(*root.columns).unionByName(root), "trie-full")

    # the parent's conversation: parents of many children by broadcast, the others by shuffle
    parents = every.where("n_children > 0").select(F.col("name").alias("up"), F.col("conv").alias("parent_conv_id"), "n_children")
    limit = max(1.0, HOT_SHARE * every.count())
    hot = F.broadcast(parents.where(F.col("n_children") > limit).drop("n_children"))
    cool = parents.where(F.col("n_children") <= limit).drop("n_children")
    linked = reduce(DataFrame.unionByName, [
        every.join(hot, "up"), every.join(hot, "up", "left_anti").where("up is not null").join(cool, "up"),
        every.where("up is null").withColumn("parent_conv_id", F.lit(None).cast("long"))])
    return (linked.join(ends, "name", "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
                    F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))


NODES = T.StructType([*(T.StructField(c, T.LongType()) for c in (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
    T.StructField("ends_sha256", T.StringType())])


def conversation_trie(conv: DataFrame, family: int = 20, shared: int = 4) -> DataFrame:
    """Trie of all conversations of (conv_id, turn, role, text), openings taken from their family."""
    return trie(*rebuild(stage(turns(conv), "trie-own"), family, shared))
