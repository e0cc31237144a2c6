"""Language-model scoring by deleted interpolation of bigrams and unigrams.

P(w | v) = a_b * c(v w) / c(v) + (1 - a_b) * U(w), with b the bucket of log2 c(v), the context's
frequency, and U(w) = u * c(w) / N + (1 - u) / (V + 1).  The weights a_b and u are learned by
expectation-maximisation on documents kept out of the counts they are learned against (one more
fold of the training documents); scoring then uses the counts of all training documents.  A
document's first token follows a start mark, and its end counts as a token.

Counts cover the whole corpus and nothing of them is broadcast: documents are dealt into blocks
of about ``BLOCK_BYTES``; a block lists its distinct keys (64-bit hashes of words and of word
pairs) with their counts, split by key range; the task of a range adds the blocks' counts and
answers every block with totals in the order of its request.  A key, however frequent, is one
entry per block.  EM runs on a histogram of bounded size (``STEPS`` per octave of either
probability, and the context's bucket).

Cases: NULL texts are empty: one token, the end; a NULL ``doc_id`` is never held out (its crc32
is NULL) and trains; rows that repeat count as often as they occur; with no training document all
counts are 0 and both scores are those of the uniform part; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import parts_for, remainder, ship, stage

BLOCK_BYTES = 8_000_000
SMOOTH, BUCKETS, STEPS, ROUNDS = 0.1, 24, 8, 60
END = np.uint64(xxhash.xxh64_intdigest(b"\n end", 7))
START = np.uint64(xxhash.xxh64_intdigest(b"\n start", 7))
#: Part of a document: held out from all learning, counted, or kept back for the mixture weights.
HELD, COUNTED, TUNING = 0, 1, 2


def _hashes(text: str | None) -> np.ndarray:
    """A hash for every token of the text, the end mark last."""
    words = (text or "").encode("utf-8", "replace").lower().split()       # A-Z and the six blanks
    h = np.empty(len(words) + 1, np.uint64)
    h[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(7)), np.uint64, len(words))
    h[-1] = END
    return h << np.uint64(1)                                              # even: a word


def _pairs(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    x = before * np.uint64(0x9E3779B97F4A7C15) ^ (after + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x | np.uint64(1)                                               # odd: a pair


def _block_tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, contexts, documents' ends) of a block, one entry a token."""
    parts = [_hashes(t) for t in texts]
    words = np.concatenate(parts)
    ends = np.cumsum([len(p) for p in parts])
    context = np.empty_like(words)
    context[1:] = words[:-1]
    context[np.concatenate([[0], ends[:-1]])] = START << np.uint64(1)
    return words, context, ends


def _keys(words: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block in order, and their counts.  A start mark is counted as a context."""
    starts = context[context == START << np.uint64(1)]
    allk = np.concatenate([words, starts, _pairs(context, words)])
    allk.sort()
    first = np.concatenate([[True], allk[1:] != allk[:-1]])
    at = np.flatnonzero(first)
    return allk[at], np.diff(np.append(at, len(allk))).astype(np.uint32)


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the key ranges begin among a block's sorted keys."""
    edges = np.array([k * (1 << 64) // parts for k in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte planes apart (the high ones are mostly zero)."""
    import zlib
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return b"".join([len(keys).to_bytes(8, "little"), zlib.compress(np.ascontiguousarray(steps[:, 5:].T).tobytes(), 1),
                     np.ascontiguousarray(steps[:, :5].T).tobytes()])


def _unpack(data: bytes) -> np.ndarray:
    import zlib
    n = int.from_bytes(data[:8], "little")
    split = len(data) - 5 * n
    steps = np.empty((n, 8), np.uint8)
    steps[:, 5:] = np.frombuffer(zlib.decompress(data[8:split]), np.uint8).reshape(3, n).T
    steps[:, :5] = np.frombuffer(data[split:], np.uint8).reshape(5, n).T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _small(x: np.ndarray) -> bytes:
    """Counts, four bytes each while all fit, else eight; the first byte says which."""
    import zlib
    kind = "<u4" if int(x.max(initial=0)) < 1 << 32 else "<u8"
    return kind[2:].encode() + zlib.compress(x.astype(kind).tobytes(), 1)


def _large(b: bytes) -> np.ndarray:
    import zlib
    return np.frombuffer(zlib.decompress(b[1:]), f"<u{b[:1].decode()}")


def requests(blocks: DataFrame, parts: int) -> DataFrame:
    """(block, part, role, keys, counts): each block's distinct keys, by key range."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        words, context, _ = _block_tokens(frame["text"].tolist())
        keys, counts = _keys(words, context)
        cut = _cuts(keys, parts)
        return pd.DataFrame({"block": frame["block"].iloc[0], "part": np.arange(parts), "role": frame["role"].iloc[0],
                             "keys": [_pack(keys[a:b]) for a, b in zip(cut[:-1], cut[1:])],
                             "counts": [_small(counts[a:b]) for a, b in zip(cut[:-1], cut[1:])]})

    return blocks.groupBy("block").applyInPandas(run, "block bigint, part int, role int, keys binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """(block, part, all, tuned, tokens, types): totals over the training blocks, and over the
    tuning ones, for each block's keys; the range's training tokens and distinct words on one row."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [_unpack(k) for k in frame["keys"]]
        counts = [_large(c).astype(np.int64) for c in frame["counts"]]
        role = np.repeat(frame["role"].to_numpy(), [len(k) for k in keys])
        flat, n = np.concatenate(keys), np.concatenate(counts)
        known, inv = np.unique(flat, return_inverse=True)
        train = np.bincount(inv, np.where(role != HELD, n, 0), len(known)).astype(np.int64)
        tuned = np.bincount(inv, np.where(role == TUNING, n, 0), len(known)).astype(np.int64)
        word = (known & np.uint64(1) == 0) & (known != START << np.uint64(1))
        ends = np.cumsum([0] + [len(k) for k in keys])
        out = frame[["block", "part"]].copy()
        out["totals"] = [_small(train[inv[a:b]]) for a, b in zip(ends[:-1], ends[1:])]
        out["tuned"] = [_small(tuned[inv[a:b]]) for a, b in zip(ends[:-1], ends[1:])]
        out["tokens"], out["types"], out["tuning"] = 0, 0, 0
        out.loc[out.index[0], ["tokens", "types", "tuning"]] = [int(train[word].sum()), int((train[word] > 0).sum()), int(tuned[word].sum())]
        return out

    return asked.groupBy("part").applyInPandas(
        run, "block bigint, part int, totals binary, tuned binary, tokens bigint, types bigint, tuning bigint")


def _joined(frame: pd.DataFrame, reply: pd.DataFrame):
    """The block's tokens with c(word), c(context), c(pair) over training and over tuning documents."""
    words, context, ends = _block_tokens(frame["text"].tolist())
    keys, _ = _keys(words, context)
    reply = reply.sort_values("part")
    total = np.concatenate([_large(x) for x in reply["totals"]]).astype(np.float64)
    tuned = np.concatenate([_large(x) for x in reply["tuned"]]).astype(np.float64)
    at = [np.searchsorted(keys, k) for k in (words, context, _pairs(context, words))]
    return ends, [total[a] for a in at], [tuned[a] for a in at]


def _bucket(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64) + (n > 0), BUCKETS - 1)


def histogram(blocks: DataFrame, replies: DataFrame, tokens: int, types: int) -> DataFrame:
    """(bucket, p2, p1, n): tuning tokens by context bucket and rounded log2 of both estimates (-1: zero)."""

    def run(frame: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame({"bucket": [], "p2": [], "p1": [], "n": []})
        _, (cw, cv, cp), (tw, tv, tp) = _joined(frame, reply)
        cw, cv, cp = cw - tw, cv - tv, cp - tp                       # counts without the tuning documents
        step = lambda p: np.where(p > 0, np.round(-np.log2(np.maximum(p, 1e-300)) * STEPS), -1).astype(np.int64)
        p2 = np.divide(cp, cv, out=np.zeros_like(cp), where=cv > 0)
        t = pd.DataFrame({"bucket": _bucket(cv), "p2": step(p2), "p1": step(cw / max(tokens, 1))})
        return t.groupby(["bucket", "p2", "p1"]).size().rename("n").reset_index()

    got = blocks.where(F.col("role") == TUNING).groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(
        run, "bucket bigint, p2 bigint, p1 bigint, n bigint")
    return got.groupBy("bucket", "p2", "p1").agg(F.sum("n").alias("n"))


def fit(table: pd.DataFrame, types: int) -> tuple[np.ndarray, float]:
    """Mixture weights (a by bucket, u) by expectation-maximisation on the histogram."""
    a, u = np.full(BUCKETS, 0.3), 0.9
    a[0] = 0.0                                                       # an unseen context has no estimate
    if not len(table):
        return a * 0, u
    table = table.sort_values(["bucket", "p2", "p1"])
    b, n = table["bucket"].to_numpy(), table["n"].to_numpy(float)
    p2, p1 = (np.where(table[c] < 0, 0.0, 2.0 ** (-table[c].to_numpy(float) / STEPS)) for c in ("p2", "p1"))
    weight = np.bincount(b, n, BUCKETS)
    for _ in range(ROUNDS):
        uni = u * p1 + (1 - u) / (types + 1)
        mixed = a[b] * p2 + (1 - a[b]) * uni
        pair = a[b] * p2 / mixed
        low = (1 - pair)
        word = low * u * p1 / uni
        a = np.where(weight > 0, np.bincount(b, n * pair, BUCKETS) / np.maximum(weight, 1), 0)
        u = float(np.clip((n * word).sum() / max((n * low).sum(), 1e-9), 1e-4, 1 - 1e-4))
    return np.minimum(a, 0.999), u


def score(docs: DataFrame, folds: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    ship(spark)
    fold = remainder("doc_id", folds)
    role = (F.when(fold == 0, HELD).when(fold == folds - 1, TUNING).otherwise(COUNTED)).cast("int")
    size = docs.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    n = parts_for(size, block_bytes)
    # a block holds documents of one role
    slot = F.pmod(F.xxhash64(F.col("doc_id"), F.crc32(F.col("text").cast("binary"))), F.lit(n)) * 3 + role
    blocks = docs.select("doc_id", "text", role.alias("role"), slot.alias("block"))
    asked = requests(blocks, n)
    replies = stage(answers(asked), "counts")
    total = replies.agg(F.sum("tokens").alias("n"), F.sum("types").alias("v"), F.sum("tuning").alias("t")).first()
    train, types, tuning = total.n or 0, total.v or 0, total.t or 0
    replies = replies.select("block", "part", "totals", "tuned")
    # the histogram is bounded by its steps, whatever the corpus
    a, u = fit(histogram(blocks, replies, train - tuning, types).toPandas(), types)

    def run(frame: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        ends, (cw, cv, cp), _ = _joined(frame, reply)
        base = np.log10((cw + SMOOTH) / (train + SMOOTH * (types + 1)))
        p2 = np.divide(cp, cv, out=np.zeros_like(cp), where=cv > 0)
        weight = np.where(cv > 0, a[_bucket(cv)], 0)
        model = np.log10(weight * p2 + (1 - weight) * (u * cw / max(train, 1) + (1 - u) / (types + 1)))
        begin = np.concatenate([[0], ends[:-1]])
        return pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["role"] == HELD, "n_tokens": ends - begin,
                             "n_known": np.add.reduceat((cw > 0).astype(np.int64), begin),
                             "train_tokens": train, "base_score": np.add.reduceat(base, begin),
                             "score": np.add.reduceat(model, begin)})

    kind = dict(docs.dtypes)["doc_id"]
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(
        run, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
