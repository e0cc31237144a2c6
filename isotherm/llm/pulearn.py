"""Toxicity: non-negative positive-unlabelled learning with numpy classifiers.

Learning sees confirmed toxic texts (positives) and texts whose label is hidden (unlabelled).  With
``prior`` the share of toxic texts among all, the risk of the negative class is estimated as the
unlabelled texts' loss as negatives less ``prior`` times the positives' loss as negatives.  That
difference cannot be negative in truth; where a batch makes it so, the classifier is pushed back up
instead of following it down (the non-negative correction).

Features are the lower-cased text's byte 4- and 5-grams, word borders included, hashed into
``2**BITS`` slots, each counted once a document.  Slots whose rate among the positives stands out
against the rate among the unlabelled texts are kept; ``CLASSIFIERS`` logistic classifiers, each
started and shuffled by its own seed, are fitted on those and their log-odds averaged.

The classifiers are fitted in the driver on a bounded sample: at most ``TRAIN_POSITIVE`` confirmed
toxic and ``TRAIN_UNLABELLED`` other rows of the training folds, those of smallest hash, and as many
of either as ``TRAIN_BYTES`` holds.  Scoring is one narrow pass over whole texts: the model is a few
MB of fixed size, and a text of any length is read in overlapping pieces.

Cases: a NULL text counts as empty, and an empty text scores the classifiers' bias alone.  A NULL
label or one that is neither 0 nor 1 is no label; conflicting labels of an id are averaged, a tie
counts as toxic.  ``prior`` is the positives' share of the ids marked 0 or 1 in the training folds
unless given (``DEFAULT_PRIOR`` where only one class is marked).  Without a confirmed toxic text, or
without unlabelled ones, every score is the prior's lower bound.  Equal texts score alike.  NULL ids
are scored and may serve as unlabelled texts.  Only ``doc_id`` and ``text`` are read; other columns,
of whatever name, are not touched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.llm.common import remainder, ship

BITS, GRAMS, PIECE = 20, (4, 5), 1 << 20
TRAIN_POSITIVE, TRAIN_UNLABELLED, TRAIN_BYTES = 1500, 6000, 24_000_000
CLASSIFIERS, DEFAULT_PRIOR, LEAST_PRIOR = 3, 0.1, 0.005
#: A slot is kept if it is this many times as frequent among the positives, and this significant.
LIFT, DEVIATIONS = 3.0, 6.0
#: Share of a row's features that a training step sees, so that few of them are enough for a verdict.
SHOWN = 0.4


@dataclass
class Model:
    slot: np.ndarray      # (2**BITS,) feature number or -1
    weight: np.ndarray    # (features,)
    bias: float
    constant: float | None = None


def _pieces(texts: Iterable[str | None]) -> Iterator[tuple[int, bytes]]:
    """(text number, bytes) in pieces that overlap by a gram less one byte."""
    longest = max(GRAMS)
    for i, t in enumerate(texts):
        data = b" " + (t or "").lower().encode("utf-8", "replace") + b" "
        for lo in range(0, max(1, len(data) - longest + 1), PIECE):
            yield i, data[lo: lo + PIECE + longest - 1]


def _buffers(texts: Iterable[str | None]) -> Iterator[list[tuple[int, bytes]]]:
    held, size = [], 0
    for piece in _pieces(texts):
        held.append(piece)
        size += len(piece[1])
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _distinct(a: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting is several times faster here than ``np.unique``'s hashing."""
    a = np.sort(a)
    return a[np.append(True, a[1:] != a[:-1])] if len(a) else a


def grams(texts: Iterable[str | None], slot: np.ndarray | None = None) -> np.ndarray:
    """Distinct (text number, slot) pairs as one sorted int64 array, ``text << 32 | slot``; with
    ``slot`` only the slots it names, renumbered by it."""
    found = []
    for part in _buffers(texts):
        raw = np.frombuffer(b"".join(p for _, p in part), np.uint8).astype(np.uint32)
        sizes = np.array([len(p) for _, p in part])
        owner = np.repeat(np.array([i for i, _ in part], np.int64), sizes)
        room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(raw))
        for n in GRAMS:
            if len(raw) < n:
                continue
            h = np.zeros(len(raw) - n + 1, np.uint32)
            for j in range(n):
                h *= np.uint32(0x01000193)
                h ^= raw[j: len(raw) - n + 1 + j]
            h = ((h ^ np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
            inside = room[: len(h)] >= n
            if slot is not None:
                h = slot[h]
                inside &= h >= 0
            found.append(_distinct(owner[: len(h)][inside] << np.int64(32) | h[inside].astype(np.int64)))
    return _distinct(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _rows(pairs: np.ndarray, n: int) -> list[np.ndarray]:
    at = np.searchsorted(pairs >> 32, np.arange(n + 1))
    ids = (pairs & 0xFFFFFFFF).astype(np.int64)
    return [ids[at[i]: at[i + 1]] for i in range(n)]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logits(rows: list[np.ndarray], w: np.ndarray, b: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-odds of each row, and the rows' features with their row numbers."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return b + np.bincount(owner, weights=w[ids], minlength=len(rows)), ids, owner


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], features: int, prior: float,
        seed: int, epochs: int = 15, batch: int = 64, rate: float = 0.01, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """One logistic classifier by Adam on the non-negative risk."""
    rng = np.random.default_rng(seed)
    theta = np.append(rng.normal(0, 0.01, features), np.log(prior / (1 - prior)))
    first, second, step, p_at = np.zeros_like(theta), np.zeros_like(theta), 0, 0
    p_order = rng.permutation(len(positive))
    for epoch in range(epochs):
        order = rng.permutation(len(unlabelled))
        for lo in range(0, len(order), 4 * batch):
            us = [unlabelled[i] for i in order[lo: lo + 4 * batch]]
            ps = [positive[p_order[(p_at + i) % len(positive)]] for i in range(batch)]
            p_at += batch
            ps, us = ([r[rng.random(len(r)) < SHOWN] for r in rows] for rows in (ps, us))
            zp, ids_p, own_p = _logits(ps, theta[:-1], theta[-1])
            zu, ids_u, own_u = _logits(us, theta[:-1], theta[-1])
            sp, su = _sigmoid(zp), _sigmoid(zu)
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if negative >= 0:
                gp, gu = prior * (sp - 1) / len(ps) - prior * sp / len(ps), su / len(us)
            else:
                gp, gu = prior * sp / len(ps), -su / len(us)
            g = decay * theta
            g[-1] = gp.sum() + gu.sum()
            g[:-1] += np.bincount(ids_p, weights=gp[own_p], minlength=features)
            g[:-1] += np.bincount(ids_u, weights=gu[own_u], minlength=features)
            step += 1
            first = 0.9 * first + 0.1 * g
            second = 0.99 * second + 0.01 * g * g
            theta -= rate * (1 - 0.9 * epoch / epochs) * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def train(positive: list[str | None], unlabelled: list[str | None], prior: float) -> Model:
    """Classifiers of confirmed toxic texts against unlabelled ones, averaged."""
    prior = float(np.clip(prior, LEAST_PRIOR, 0.5))
    empty = np.full(1 << BITS, -1, np.int32)
    if not positive or not unlabelled:
        return Model(empty, np.zeros(0), 0.0, LEAST_PRIOR)
    pos, unl = grams(positive), grams(unlabelled)
    n, m = len(positive), len(unlabelled)
    in_pos = (np.bincount(pos & 0xFFFFFFFF, minlength=1 << BITS) + 0.5) / (n + 1)
    in_all = (np.bincount(unl & 0xFFFFFFFF, minlength=1 << BITS) + 0.5) / (m + 1)
    spread = np.sqrt(in_all * (1 - in_all) * (1 / n + 1 / m))
    keep = np.flatnonzero((in_pos > LIFT * in_all) & (in_pos - in_all > DEVIATIONS * spread))
    slot = empty
    slot[keep] = np.arange(len(keep), dtype=np.int32)
    p_rows, u_rows = ([slot[r][slot[r] >= 0] for r in _rows(x, k)] for x, k in ((pos, n), (unl, m)))
    fits = [fit(p_rows, u_rows, len(keep), prior, seed) for seed in range(CLASSIFIERS)]
    return Model(slot, np.mean([w for w, _ in fits], axis=0), float(np.mean([b for _, b in fits])))


def score_texts(m: Model, texts: list[str | None]) -> np.ndarray:
    if m.constant is not None:
        return np.full(len(texts), m.constant)
    pairs = grams(texts, m.slot)
    return _sigmoid(m.bias + np.bincount(pairs >> 32, weights=m.weight[pairs & 0xFFFFFFFF], minlength=len(texts)))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(F.col("doc_id"), F.col("text"), F.lit("pu")).alias("h"), "text")


def _texts(rows: DataFrame, docs: DataFrame, n: int, max_bytes: int) -> list[str | None]:
    """Texts of the ``n`` of ``rows`` (h, n) of smallest hash, in hash order, as many as ``max_bytes``
    holds.  Only hashes and lengths are sorted and joined; the chosen texts are then picked out of
    ``docs`` by a broadcast of at most ``n`` hashes."""
    sized = rows.orderBy("h", "n").limit(n).collect()
    chosen, total = {}, 0
    for r in sized:                                  # at most n (hash, length) pairs
        if total + r.n <= max_bytes:
            total += r.n
            chosen[r.h] = chosen.get(r.h, 0) + 1
    if not chosen:
        return []
    wanted = docs.sparkSession.createDataFrame([(h,) for h in chosen], "h long")
    got = _keyed(docs).join(F.broadcast(wanted), "h").groupBy("h").agg(F.max("text").alias("text")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.h) for _ in range(chosen[r.h])]


def training_texts(docs: DataFrame, labels: DataFrame, target: str, folds: int, held: int,
                   prior: float | None) -> tuple[list[str | None], list[str | None], float]:
    """Confirmed texts, unlabelled texts and the class prior, all from the training folds."""
    marked = (labels.select("doc_id", F.col(target).alias("y"))
              .where(F.col("y").isin(0, 1) & (remainder("doc_id", folds) != held))
              .groupBy("doc_id").agg((F.avg("y") >= 0.5).alias("toxic")))
    mine = docs.select("doc_id", "text").where(F.coalesce(remainder("doc_id", folds) != held, F.lit(True)))
    if prior is None:
        r = marked.agg(F.count_if("toxic").alias("p"), F.count(F.lit(1)).alias("n")).first()
        prior = r.p / r.n if 0 < r.p < r.n else DEFAULT_PRIOR
    rows = _keyed(mine).select("doc_id", "h", F.octet_length(F.coalesce("text", F.lit(""))).alias("n"))
    positive = rows.join(marked.where("toxic").select("doc_id"), "doc_id", "left_semi")
    return (_texts(positive, mine, TRAIN_POSITIVE, TRAIN_BYTES // 3),
            _texts(rows, mine, TRAIN_UNLABELLED, TRAIN_BYTES - TRAIN_BYTES // 3), prior)


def score(docs: DataFrame, model: Model, score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of each whole text appended; one narrow pass."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)   # 4 MB of slots and the kept weights
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    text_at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                scores = pa.array(score_texts(shared.value, b.column(text_at).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns, scores], names=[*b.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, target: str = "toxic", threshold: float = 0.3, folds: int = 4,
             held: int = 2, prior: float | None = None) -> DataFrame:
    """doc_id, score and predicted of every row, learned outside the held-out fold."""
    model = train(*training_texts(docs, labels, target, folds, held, prior))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
