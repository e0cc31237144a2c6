"""Vector code compression: integer product quantisation over Hilbert-sorted flat blocks.

Vectors become integers ``floor(scale * x)`` and are cut into ``parts`` equal consecutive parts.  The
parts are sorted along a Hilbert curve (of their most variable dimensions) and written as flat blocks
of up to ``BLOCK`` parts, each with the corners of its bounding box and its componentwise sums.  In
every round the distances from a block's box to the codebook entries bound all its members at once:
an entry whose nearest box point is farther than another entry's farthest one is struck off.  If one
entry is left, the block's sums go to it without looking at its members; else a small exact integer
kernel compares the members with the shortlist only.  Rounds read the written blocks; what travels is
one partial sum per task, entry and position, so the driver sees codebook-sized frames alone.

Everything is exact: bounds carry a margin, and the kernel works in doubles where every sum is an
integer below 2**53, else in 64-bit integers, else in Python's.

Cases: a vector that is NULL or holds a NULL or non-finite component is left out.  Vectors of unequal
length, or of one that ``parts`` does not divide, are filled up with zeros to the common part width;
an empty vector is all zeros.  Codebooks start from the ``entries`` smallest rows by id (NULL ids
last, rows of one id by their vector); with fewer rows they have fewer entries.  Distances tie to the
lower index; an unused entry stays.  Repeated rows, ids and vectors are rows like any other: the sort
key ends in a row number, so equal vectors spread over tasks.  An error beyond 64 bits is NULL.  An
empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import broadcast_if_small, parts_for, ship, stage

BLOCK = 512
#: Magnitude below which components are kept as 32-bit and distances fit 64-bit integers.
NARROW = 1 << 24
LIMB = 10 ** 18
CURVE_DIMS = 16
#: Label sums up to this many rows are broadcast; beyond it the rows of a label are salted.
SMALL_LABELS, SALTS = 200_000, 32


def hilbert_key(grid: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each row of ``grid`` (unsigned cells of ``bits`` bits),
    as a signed 64-bit integer that sorts in curve order."""
    x = grid.astype(np.uint32).T.copy()
    dims = len(x)
    if dims == 0:
        return np.zeros(len(grid), np.int64)
    for b in range(bits - 1, 0, -1):                 # undo the rotations, coarse to fine
        low = np.uint32((1 << b) - 1)
        for i in range(dims):
            high = (x[i] >> np.uint32(b)) & np.uint32(1) == 1
            swap = np.where(high, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, dims):                         # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint32(b)) & np.uint32(1) == 1, np.uint32((1 << b) - 1), np.uint32(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint32(b)) & np.uint32(1)).astype(np.uint64)
    return (key ^ np.uint64(1 << 63)).view(np.int64)


def integers(x: Iterable[float], scale: int, width: int) -> list[int]:
    """``floor(scale * x)`` exactly, filled up with zeros."""
    out = []
    for v in x:
        a, b = float(v).as_integer_ratio()
        out.append(a * scale // b)
    return out + [0] * (width - len(out))


def _bound(*arrays: np.ndarray) -> int:
    return max((int(np.abs(a).max()) for a in arrays if a.size), default=0)


def nearest(v: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (lower on ties) and its squared distance, exactly."""
    top, width = _bound(v, book), max(1, v.shape[1])
    if 4 * width * top * top < 1 << 53:
        v, book = v.astype(np.float64), book.astype(np.float64)   # every sum is an exact integer
    elif 4 * width * top * top < 1 << 62:
        v, book = v.astype(np.int64), book.astype(np.int64)
    else:
        v, book = v.astype(object), book.astype(object)
    if v.dtype == object:
        d = np.stack([((v - e) ** 2).sum(axis=1) for e in book], axis=1)
    else:
        d = (v * v).sum(axis=1)[:, None] - 2 * (v @ book.T) + (book * book).sum(axis=1)[None]
    at = np.argmin(d, axis=1)
    found = d[np.arange(len(v)), at]
    return at, found if found.dtype == object else found.astype(np.int64)


def shortlist(lo: np.ndarray, hi: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entries that may be nearest to some point of the box, in index order."""
    if _bound(lo, hi, book) > 1 << 100:              # squares of such doubles lose the bounds
        return np.arange(len(book))
    lo, hi, c = lo.astype(np.float64), hi.astype(np.float64), book.astype(np.float64)
    near = np.maximum(np.maximum(lo - c, c - hi), 0)
    far = np.maximum(np.abs(c - lo), np.abs(c - hi))
    least, most = (near * near).sum(axis=1), (far * far).sum(axis=1)
    return np.flatnonzero(least * (1 - 1e-9) <= most.min() * (1 + 1e-9))


def _pack(values: np.ndarray, wide: bool) -> bytes:
    return ",".join(map(str, values.ravel().tolist())).encode() if wide else values.astype("<i4").tobytes()


def _unpack(data: bytes, wide: bool, rows: int, width: int) -> np.ndarray:
    if not wide:
        return np.frombuffer(data, "<i4").reshape(rows, width).astype(np.int64)
    flat = [int(x) for x in data.decode().split(",") if x]
    out = np.empty(rows * width, object)
    out[:] = flat
    return out.reshape(rows, width)


def _spread(rows: DataFrame) -> tuple[int, dict[int, tuple[float, float]]]:
    """Longest vector, and each position's mean and deviation: one row a position at the driver."""
    def partial(batches):
        n = s = q = np.zeros(0)
        for b in batches:
            at, flat = np.asarray(b.column(0).offsets), b.column(0).flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(at)
            pos = np.arange(len(flat)) - np.repeat(at[:-1] - at[0], sizes)
            x = np.clip(flat.astype(np.float64), -1e100, 1e100)
            got = [np.bincount(pos, weights=w) for w in (np.ones(len(x)), x, x * x)]
            size = max(len(n), len(got[0]))
            n, s, q = (np.pad(a, (0, size - len(a))) + np.pad(g, (0, size - len(g))) for a, g in zip((n, s, q), got, strict=True))
        yield pa.RecordBatch.from_pydict({"pos": np.arange(len(n)), "n": n, "s": s, "q": q})

    sums = (rows.select("v").mapInArrow(partial, "pos long, n double, s double, q double")
            .groupBy("pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect())
    return len(sums), {r.pos: (r.s / r.n, max(r.q / r.n - (r.s / r.n) ** 2, 0.0) ** 0.5) for r in sums}


def _part_rows(rows: DataFrame, scale: int, parts: int, width: int, stats: dict) -> DataFrame:
    """(part, wide, key, row, vals): every part of every vector with its place on the curve."""
    dims = []
    for p in range(parts):
        mine = sorted((k for k in range(p * width, (p + 1) * width) if k in stats), key=lambda k: -stats[k][1])
        dims.append(sorted(mine[:CURVE_DIMS]))
    bits = [min(16, 64 // max(1, len(d))) for d in dims]

    def run(batches):
        for b in batches:
            ids, vecs = b.column(0), b.column(1).to_pylist()
            x = np.zeros((len(vecs), parts * width))
            for i, v in enumerate(vecs):
                x[i, : len(v)] = v
            wide_at = np.abs(x).reshape(len(vecs), parts, width).max(axis=2, initial=0) * scale >= NARROW - 1
            whole = np.floor(np.clip(x * scale, -NARROW, NARROW)).astype(np.int64)
            exact = {i: integers(vecs[i], scale, parts * width) for i in np.flatnonzero(wide_at.any(axis=1))}
            for p in range(parts):
                cut = slice(p * width, (p + 1) * width)
                mean, dev = (np.array([stats[k][j] for k in dims[p]]) for j in (0, 1))
                unit = (x[:, dims[p]] - mean) / np.maximum(dev, 1e-300) / 5 + 0.5
                grid = np.clip(np.nan_to_num(unit) * (1 << bits[p]), 0, (1 << bits[p]) - 1).astype(np.uint32)
                vals = [_pack(np.array(exact[i][cut], object), True) if wide_at[i, p] else whole[i, cut].astype("<i4").tobytes()
                        for i in range(len(vecs))]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([p] * len(vecs), pa.int32()), "wide": pa.array(wide_at[:, p]),
                    "key": pa.array(hilbert_key(grid, bits[p])), "row": ids, "vals": pa.array(vals, pa.binary())})

    return rows.select("row", "v").mapInArrow(run, "part int, wide boolean, key long, row long, vals binary")


def _blocks(sorted_parts: DataFrame, width: int) -> DataFrame:
    """Flat blocks of consecutive sorted parts, with box, sums, members and row numbers."""
    def run(batches):
        held: list[tuple[int, bytes]] = []
        last = None

        def block():
            wide = last[1]
            if wide:
                v = np.concatenate([_unpack(x, True, 1, width) for _, x in held])
            else:
                v = _unpack(b"".join(x for _, x in held), False, len(held), width)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([last[0]], pa.int32()), "wide": [wide], "n": pa.array([len(held)], pa.int32()),
                "lo": [_pack(v.min(axis=0), wide)], "hi": [_pack(v.max(axis=0), wide)],
                "sums": [",".join(map(str, v.sum(axis=0).tolist())).encode()], "vals": [_pack(v, wide)],
                "rows": [np.array([r for r, _ in held], "<i8").tobytes()]})

        for b in batches:
            for part, wide, row, vals in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                if held and (last != (part, wide) or len(held) == BLOCK):
                    yield block()
                    held = []
                last = (part, wide)
                held.append((row, vals))
        if held:
            yield block()

    return sorted_parts.mapInArrow(
        run, "part int, wide boolean, n int, lo binary, hi binary, sums binary, vals binary, rows binary")


def _each_block(batches, books, width: int):
    for b in batches:
        for r in b.to_pylist():
            book = books[r["part"]]
            near = shortlist(*(_unpack(r[c], r["wide"], 1, width)[0] for c in ("lo", "hi")), book)
            yield r, book, near


def _limbs(x: int) -> Iterator[tuple[int, int]]:
    k = 0
    while not -LIMB < x < LIMB:
        x, low = divmod(x, LIMB)
        yield k, low
        k += 1
    yield k, x


def _sums(blocks: DataFrame, shared, width: int) -> DataFrame:
    """Exact sums and counts of the parts nearest to each entry: (part, entry, pos, limb, value)."""
    def run(batches):
        total: dict[tuple[int, int], list[int]] = {}
        for r, book, near in _each_block(batches, shared.value, width):
            if len(near) == 1:
                got = {int(near[0]): [r["n"], *(int(x) for x in r["sums"].decode().split(",") if x)]}
            else:
                v = _unpack(r["vals"], r["wide"], r["n"], width)
                at, _ = nearest(v, book[near])
                got = {}
                for k in np.unique(at):
                    mine = v[at == k]
                    got[int(near[k])] = [len(mine), *mine.sum(axis=0).tolist()]
            for entry, add in got.items():
                old = total.get((r["part"], entry))
                total[r["part"], entry] = [a + b for a, b in zip(old, add, strict=True)] if old else add
        out = [(p, e, pos - 1, limb, value) for (p, e), sums in total.items() for pos, x in enumerate(sums)
               for limb, value in _limbs(x)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
                names=["part", "entry", "pos", "limb", "value"])

    return (blocks.mapInArrow(run, "part int, entry int, pos int, limb int, value long")
            .groupBy("part", "entry", "pos", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")))


def _codes(blocks: DataFrame, shared, width: int) -> DataFrame:
    def run(batches):
        for r, book, near in _each_block(batches, shared.value, width):
            at, err = nearest(_unpack(r["vals"], r["wide"], r["n"], width), book[near])
            yield pa.RecordBatch.from_pydict({
                "row": np.frombuffer(r["rows"], "<i8"), "part": pa.array([r["part"]] * r["n"], pa.int32()),
                "code": pa.array(near[at], pa.int32()),
                "err": pa.array([int(e) if e < 1 << 63 else None for e in err], pa.int64())})

    return blocks.mapInArrow(run, "row long, part int, code int, err long")


def _books(entries: list[list[list[int]]], width: int) -> list[np.ndarray]:
    out = []
    for part in entries:
        wide = any(abs(x) >= 1 << 62 for e in part for x in e)
        a = np.empty((len(part), width), object if wide else np.int64)
        for i, e in enumerate(part):
            a[i] = e
        out.append(a)
    return out


def compress(df: DataFrame, id_col: str, vec_col: str, *keep: str, parts: int = 4, entries: int = 256,
             rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, list[list[list[int]]]]:
    """Rows ``id, keep..., code, error`` and the final codebooks (part, entry, position).

    ``id`` and ``keep`` come back under their own names; ``code`` has two hex digits a part."""
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256: a code is one byte")
    spark = df.sparkSession
    ship(spark)
    v = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    names = {f"c{i}": c for i, c in enumerate((id_col, *keep))}
    kept = df.where(F.col(f"`{vec_col}`").isNotNull() & finite)
    # the row number is written with the rows, so that all later passes agree on it
    rows = stage(kept.select(*[F.col(f"`{c}`").alias(a) for a, c in names.items()],
                             F.col(f"`{vec_col}`").alias("v"), F.monotonically_increasing_id().alias("row")), "pq-rows")
    numbers = rows.select("row", F.col("v").cast("array<double>").alias("v"))
    length, stats = _spread(numbers)
    width = -(-length // parts)

    first = rows.orderBy(F.col("c0").asc_nulls_last(), "v", "row").select("v").limit(entries).collect()
    whole = [integers(r.v, scale, parts * width) for r in first]
    books = [[w[p * width: (p + 1) * width] for w in whole] for p in range(parts)]

    n = parts_for(rows.count() * parts, 200_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["part", "wide", "key", "row"]
    placed = _part_rows(numbers, scale, parts, width, stats).repartitionByRange(n, *order).sortWithinPartitions(*order)
    blocks = stage(_blocks(placed, width), "pq-blocks")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(_books(books, width))    # entries x parts x width integers
        total: dict[tuple[int, int], dict[int, int]] = {}
        for r in _sums(blocks, shared, width).collect():               # codebook-sized
            at = total.setdefault((r.part, r.entry), {})
            at[r.pos] = at.get(r.pos, 0) + int(r.value) * LIMB ** r.limb
        for (p, e), sums in total.items():
            books[p][e] = [sums[k] // sums[-1] for k in range(width)]
        shared.unpersist()
    shared = spark.sparkContext.broadcast(_books(books, width))
    digits = [F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == p, F.col("code"))))), 2, "0") for p in range(parts)]
    error = F.when(F.count("err") == parts, F.sum(F.col("err").cast("decimal(38,0)")))
    codes = (_codes(blocks, shared, width).groupBy("row")
             .agg(F.concat(*digits).alias("code"), error.try_cast("long").alias("error")))
    out = rows.drop("v").join(codes, "row").select(*[F.col(a).alias(c) for a, c in names.items()], "code", "error")
    return out, books


def codebooks_digest(books: list[list[list[int]]]) -> str:
    """SHA-256 of all entries' components by part, entry and position, joined by commas."""
    h, sep = hashlib.sha256(), ""
    for part in books:
        for entry in part:
            for x in entry:
                h.update(f"{sep}{x}".encode())
                sep = ","
    return h.hexdigest()


def with_group_total(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over rows of equal ``group`` (NULLs together) as ``name``; NULL
    where a member is NULL or the sum leaves 64 bits.  A hot group is summed in partial aggregates and
    spread by salt."""
    total = F.when(F.count(value) == F.count(F.lit(1)), F.sum(F.col(value).cast("decimal(38,0)"))).try_cast("long")
    sums = stage(df.groupBy(F.col(group).alias("__g")).agg(total.alias(name)), "group-totals")
    small = broadcast_if_small(sums, SMALL_LABELS)
    if small is not sums:
        return df.join(small, F.col(group).eqNullSafe(F.col("__g")), "left").drop("__g")
    salted = sums.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = df.withColumn("__t", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SALTS)).cast("int"))
    return (left.join(salted, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__t") == F.col("__s")), "left")
            .drop("__g", "__s", "__t"))

