"""Quality classifier: a byte-level convolutional network in numpy.

Every document is read whole as UTF-8 bytes.  Two banks of learned filters slide over it:

* byte filters, ``WIDTH`` bytes wide at every second byte (a table per filter position and
  byte value, so a convolution is ``WIDTH`` table look-ups);
* echo filters over ``CELL``-byte cells, whose input channels say how many bytes of the cell
  equal the byte ``lag`` places earlier (repetition is invisible to plain byte filters).

Each filter is max-pooled over overlapping chunks (``CHUNK`` bytes, every ``CHUNK/2``), the
chunks' rectified maxima are combined by their mean and their maximum over the document, and a
logistic layer turns those into one probability.  All weights, filters included, are learned
by back-propagation (Adam) on a bounded sample of labelled documents.

Cases: a NULL text counts as empty; an empty text scores the learned bias alone; texts of any
length are covered to the end (a short last chunk is padded with byte 0).  With no usable
label, or labels of one class only, the score is the constant (positives + 1) / (labels + 2).
Conflicting labels of one id are averaged, a tie counts as 1; NULL labels are ignored; rows
that repeat are scored alike.  Only ``doc_id`` and ``text`` are read, other columns never are.
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

WIDTH, STRIDE, CELL, CHUNK = 8, 2, 16, 512
HALF = CHUNK // 2
LAGS = np.arange(2, 18)
#: Bounds of the training sample: documents of either class, and bytes of text in all.
TRAIN_POSITIVE, TRAIN_NEGATIVE, TRAIN_BYTES = 900, 700, 8_000_000
BLOCK_HALVES = 64


@dataclass
class Model:
    table: np.ndarray   # (WIDTH, 256, filters)
    echo: np.ndarray    # (lags, echo filters)
    bias: np.ndarray    # (all filters,)
    out: np.ndarray     # (2 * all filters,)
    out_bias: float
    constant: float | None = None


def new_model(filters: int = 20, echoes: int = 8, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    return Model(rng.normal(0, 0.3, (WIDTH, 256, filters)).astype(np.float32),
                 rng.normal(0, 0.1, (len(LAGS), echoes)).astype(np.float32),
                 np.zeros(filters + echoes, np.float32),
                 rng.normal(0, 0.1, 2 * (filters + echoes)).astype(np.float32), 0.0)


def _frame(text: bytes) -> tuple[np.ndarray, int]:
    """Bytes padded to whole half chunks (at least two) plus a filter's width, and the halves."""
    halves = max(2, -(-len(text) // HALF))
    buf = np.zeros(halves * HALF + WIDTH, np.uint8)
    buf[: len(text)] = np.frombuffer(text, np.uint8)
    return buf, halves


def _echoes(buf: np.ndarray, start: int, halves: int) -> np.ndarray:
    """(cells, lags): the share of a cell's bytes that equal the byte ``lag`` places earlier."""
    lo = start * HALF
    part = buf[lo: lo + halves * HALF]
    out = np.empty((len(part) // CELL, len(LAGS)), np.float32)
    for k, lag in enumerate(LAGS):
        same = np.zeros(len(part), np.uint8)
        head = max(0, lag - lo)
        same[head:] = (part[head:] == buf[lo + head - lag: lo + len(part) - lag]) & (part[head:] != 0)
        out[:, k] = same.reshape(-1, CELL).sum(axis=1, dtype=np.uint16)
    return out / CELL


def _half_maxima(m: Model, text: bytes, keep: bool = False):
    """Maximum of every filter over each half chunk; with ``keep`` also where it was reached."""
    buf, halves = _frame(text)
    nf = m.table.shape[2]
    top = np.empty((halves, len(m.bias)), np.float32)
    at = np.empty((halves, len(m.bias)), np.int64) if keep else None
    for s in range(0, halves, BLOCK_HALVES):
        n = min(BLOCK_HALVES, halves - s)
        lo = s * HALF
        z = m.table[0].take(buf[lo: lo + n * HALF: STRIDE], axis=0)
        for j in range(1, WIDTH):
            z += m.table[j].take(buf[lo + j: lo + j + n * HALF: STRIDE], axis=0)
        z = z.reshape(n, HALF // STRIDE, nf)
        cells = _echoes(buf, s, n)
        e = (cells @ m.echo).reshape(n, HALF // CELL, -1)
        top[s: s + n, :nf], top[s: s + n, nf:] = z.max(axis=1), e.max(axis=1)
        if keep:
            base = np.arange(s, s + n)[:, None]
            at[s: s + n, :nf] = base * (HALF // STRIDE) + z.argmax(axis=1)
            at[s: s + n, nf:] = base * (HALF // CELL) + e.argmax(axis=1)
    return (top, at, buf) if keep else top


def _document_vector(m: Model, top: np.ndarray):
    left, right = top[:-1], top[1:]
    chunk = np.maximum(left, right) + m.bias
    act = np.maximum(chunk, 0)
    act = act / (1 + act)           # keeps one loud filter from drowning the others
    return np.concatenate([act.mean(axis=0), act.max(axis=0)]), chunk, act


def score_text(m: Model, text: str | None) -> float:
    if m.constant is not None:
        return m.constant
    data = (text or "").encode("utf-8", "replace")
    logit = m.out_bias
    if data:
        logit += float(_document_vector(m, _half_maxima(m, data))[0] @ m.out)
    return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def train(samples: list[tuple[str, int]], steps: int = 260, rate: float = 0.02, batch: int = 24,
          seed: int = 11) -> Model:
    """Fit all weights by back-propagation; both classes weigh alike in all."""
    positives = sum(y for _, y in samples)
    if positives in (0, len(samples)):
        m = new_model()
        m.constant = (positives + 1) / (len(samples) + 2)
        return m
    m, rng = new_model(), np.random.default_rng(seed)
    texts = [(t or "").encode("utf-8", "replace") for t, _ in samples]
    weight = {1: 0.5 * len(samples) / positives, 0: 0.5 * len(samples) / (len(samples) - positives)}
    nf = m.table.shape[2]
    params = {"table": m.table, "echo": m.echo, "bias": m.bias, "out": m.out, "out_bias": np.zeros(1, np.float32)}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    step = 0
    while step < steps:
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            grad = {k: np.zeros_like(v) for k, v in params.items()}
            for i in order[lo: lo + batch]:
                y = samples[i][1]
                if not texts[i]:
                    p = 1 / (1 + np.exp(-float(params["out_bias"][0])))
                    grad["out_bias"] += weight[y] * (p - y)
                    continue
                top, at, buf = _half_maxima(m, texts[i], keep=True)
                vec, chunk, act = _document_vector(m, top)
                p = 1 / (1 + np.exp(-np.clip(vec @ m.out + params["out_bias"][0], -30, 30)))
                d = np.float32(weight[y] * (p - y))
                grad["out"] += d * vec
                grad["out_bias"] += d
                k = act.shape[1]
                dact = np.repeat((d * m.out[:k] / len(act))[None], len(act), axis=0)
                dact[act.argmax(axis=0), np.arange(k)] += d * m.out[k:]
                dchunk = dact * (chunk > 0) * (1 - act) ** 2
                grad["bias"] += dchunk.sum(axis=0)
                src = np.where(top[:-1] >= top[1:], at[:-1], at[1:])
                rows, cols = np.nonzero(np.abs(dchunk) > 1e-7)
                for f_lo, f_hi, kind in ((0, nf, "table"), (nf, k, "echo")):
                    pick = (cols >= f_lo) & (cols < f_hi)
                    r, c = rows[pick], cols[pick]
                    where, g = src[r, c], dchunk[r, c]
                    if kind == "table":
                        for j in range(WIDTH):
                            np.add.at(grad["table"][j], (buf[where * STRIDE + j], c), g)
                    elif len(r):
                        spots, inv = np.unique(where, return_inverse=True)
                        for spot, cell in enumerate(spots):
                            x = _cell(buf, cell)
                            sel = inv == spot
                            np.add.at(grad["echo"].T, c[sel] - nf, g[sel, None] * x[None])
            step += 1
            lr = rate * max(0.1, 1 - 0.9 * step / steps)
            for k, v in params.items():
                g = grad[k] / batch
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                v -= (lr * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
            m.out_bias = float(params["out_bias"][0])
    return m


def _cell(buf: np.ndarray, cell: int) -> np.ndarray:
    lo = cell * CELL
    part, out = buf[lo: lo + CELL], np.zeros(len(LAGS), np.float32)
    for k, lag in enumerate(LAGS):
        head = max(0, lag - lo)
        if head < CELL:
            out[k] = ((part[head:] == buf[lo + head - lag: lo + CELL - lag]) & (part[head:] != 0)).sum()
    return out / CELL


def training_rows(docs: DataFrame, labels: DataFrame, target: str = "quality", folds: int = 5,
                  positive: int = TRAIN_POSITIVE, negative: int = TRAIN_NEGATIVE,
                  max_bytes: int = TRAIN_BYTES) -> list[tuple[str, int]]:
    """The bounded training sample: per class the labelled ids of smallest hash outside the held-out
    fold, then as many of their texts, in hash order, as ``max_bytes`` holds."""
    marked = (labels.select("doc_id", F.col(target).alias("y"))
              .where(F.col("y").isin(0, 1) & (remainder("doc_id", folds) != 0))
              .groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
              .withColumn("h", F.xxhash64(F.col("doc_id"), F.lit("sample"))))
    # either class of the labelled documents that are here at all
    mine = docs.select("doc_id", "text").alias("d")
    present = marked.join(mine.select("doc_id"), "doc_id", "left_semi")
    chosen = (present.where("y = 1").orderBy("h", "doc_id").limit(positive)
              .unionByName(present.where("y = 0").orderBy("h", "doc_id").limit(negative)))
    ids = [(r.doc_id, r.y, r.h) for r in chosen.collect()]   # at most positive + negative ids
    if not ids:
        return []
    spark = docs.sparkSession
    picked = spark.createDataFrame(ids, chosen.schema)
    sized = (mine.join(F.broadcast(picked), "doc_id")
             .select("doc_id", "y", "h", F.octet_length(F.coalesce("text", F.lit(""))).alias("n"))
             .groupBy("doc_id", "y", "h").agg(F.max("n").alias("n")).collect())
    sized.sort(key=lambda r: (r.h, r.doc_id))
    total, keep = 0, []
    for r in sized:
        if total + r.n <= max_bytes:
            total += r.n
            keep.append((r.doc_id, r.y, r.h))
    if not keep:
        return []
    rows = (mine.join(F.broadcast(spark.createDataFrame(keep, chosen.schema)), "doc_id")
            .groupBy("doc_id", "y", "h").agg(F.max("text").alias("text")).collect())
    rows.sort(key=lambda r: (r.h, r.doc_id))
    return [(r.text or "", r.y) for r in rows]


def score(docs: DataFrame, model: Model, score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of each whole text appended; one narrow pass, no shuffle."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)   # a fixed, small set of weights
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    text_at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            scores = pa.array([score_text(m, t.as_py()) for t in b.column(text_at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], names=[*b.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, target: str = "quality", threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted of every document, from a network fitted on the labelled sample."""
    model = train(training_rows(docs, labels, target))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
