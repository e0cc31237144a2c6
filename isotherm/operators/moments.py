"""Mergeable pairwise moments and shared cross products (AGG-22, AGG-23, FSEL-01, FSEL-05, ML-10, ML-11).

Correlations of K columns with missing values and least-squares fits of nested
column sets need the same thing: sums of products of pairs of columns.  Each row
becomes one vector and Spark's Gramian adds up the outer products per partition
and merges the small matrices in a tree, so a pass sends one matrix a partition,
whatever the number of pairs, and all windows or column sets come from one pass.

For pairwise-complete moments the vector holds, per column and window, the
presence flag m, the shifted value x and its square, zero where absent.  The
products give, for any pair (a, b) on the rows where both are there: the count
m_a m_b, the sums x_a m_b, the squares x_a^2 m_b and the products x_a x_b.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A variance below this share of the mean square is rounding: the column is constant there.
CONSTANT = 1e-12


def gramian(df: DataFrame, values: Sequence[Column]) -> np.ndarray:
    """Sum over rows of the outer product of ``values`` (doubles without NULLs): one pass, merged in a
    tree, ``len(values)`` squared numbers at the driver."""
    vectors = df.select(array_to_vector(F.array(*values)).alias("__v"))
    if vectors.isEmpty():
        return np.zeros((len(values), len(values)))
    rows = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "__v"), 0, len(values))
    return rows.computeGramianMatrix().toArray()


def _number(c: str) -> Column:
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)


@dataclass
class PairMoments:
    """Moments of every pair of ``cols`` over the rows where both are present, per window."""
    cols: list[str]
    windows: list[str]
    gram: np.ndarray

    def _block(self, window: str, a: int, b: int, kind_a: int, kind_b: int) -> float:
        k = len(self.cols)
        base = self.windows.index(window) * 3 * k
        return float(self.gram[base + kind_a * k + a, base + kind_b * k + b])

    def correlation(self, a: str, b: str, window: str = "all") -> float | None:
        """Pearson's r; None with fewer than two complete rows or a constant side."""
        i, j = self.cols.index(a), self.cols.index(b)
        at = lambda p, q, kp, kq: self._block(window, p, q, kp, kq)
        n = at(i, j, 0, 0)
        if n < 2:
            return None
        sx, sy, sxx, syy, sxy = at(i, j, 1, 0), at(j, i, 1, 0), at(i, j, 2, 0), at(j, i, 2, 0), at(i, j, 1, 1)
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        if vx <= CONSTANT * sxx or vy <= CONSTANT * syy:
            return None
        return (sxy - sx * sy / n) / float(np.sqrt(vx) * np.sqrt(vy))

    def count(self, a: str, b: str, window: str = "all") -> int:
        return round(self._block(window, self.cols.index(a), self.cols.index(b), 0, 0))


def pair_moments(df: DataFrame, cols: Sequence[str], windows: Mapping[str, Column] | None = None) -> PairMoments:
    """Moments of all pairs of ``cols`` in one pass after one for the shifts; ``windows`` names row
    conditions (NULL: not in it), by default one window ``all``."""
    cols, windows = list(cols), dict(windows or {"all": F.lit(True)})
    # values are shifted by a value near the middle of each column, so that squares do not cancel;
    # an existing value, so that a constant column becomes exactly zero
    middles = df.agg(*[F.avg(_number(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.min(_number(c)).alias(f"l{i}") for i, c in enumerate(cols)],
                     *[F.max(_number(c)).alias(f"h{i}") for i, c in enumerate(cols)]).first()
    shift = [0.0 if middles[f"m{i}"] is None or not np.isfinite(middles[f"m{i}"])
             else middles[f"l{i}"] if middles[f"l{i}"] == middles[f"h{i}"] else middles[f"m{i}"] for i in range(len(cols))]
    zero, one = F.lit(0.0), F.lit(1.0)
    values: list[Column] = []
    for cond in windows.values():
        inside = F.coalesce(cond, F.lit(False))
        x = [F.when(inside, _number(c) - F.lit(s)) for c, s in zip(cols, shift, strict=True)]
        values += [F.when(v.isNotNull(), one).otherwise(zero) for v in x]
        values += [F.coalesce(v, zero) for v in x]
        values += [F.coalesce(v * v, zero) for v in x]
    return PairMoments(cols, list(windows), gramian(df, values))


def correlation_rows(m: PairMoments, pairs: Sequence[tuple[str, str]], window: str = "all") -> list[tuple[str, str, float | None]]:
    return [(a, b, m.correlation(a, b, window)) for a, b in pairs]


def redundancy_rows(m: PairMoments, narrow: str, wide: str, threshold: float) -> list[tuple]:
    """FSEL-05: pairs above the threshold in either window, with both r and whether the redundancy is
    lasting (above it in the wide window) or comes from the narrow one."""
    out = []
    for a, b in combinations(m.cols, 2):
        rn, rw = m.correlation(a, b, narrow), m.correlation(a, b, wide)
        strong = lambda r: r is not None and abs(r) > threshold
        if strong(rn) or strong(rw):
            out.append((a, b, rn, rw, "lasting" if strong(rw) else "narrow window"))
    return out


@dataclass
class CrossProducts:
    """X'X with the constant, the columns and the label of least squares; adds over disjoint rows."""
    names: list[str]            # "(constant)", columns, label last
    gram: np.ndarray

    def __add__(self, other: CrossProducts) -> CrossProducts:
        assert self.names == other.names
        return CrossProducts(self.names, self.gram + other.gram)

    @property
    def rows(self) -> int:
        return round(float(self.gram[0, 0]))

    def solve(self, columns: Sequence[str]) -> dict[str, float]:
        """Least-squares coefficients of the label on the constant and ``columns``; a column that is
        constant or a combination of others gets the smallest coefficients that fit."""
        at = [0, *[self.names.index(c) for c in columns]]
        a, y = self.gram[np.ix_(at, at)], self.gram[at, -1]
        # centre and scale by the columns' own moments, so that the cut of small directions is relative
        n = a[0, 0]
        mean = a[0, 1:] / n
        centred = a[1:, 1:] - n * np.outer(mean, mean)
        scale = np.sqrt(np.maximum(np.diag(centred), 0))
        used = scale > np.sqrt(CONSTANT * np.maximum(np.diag(a)[1:], 0))
        inv = np.where(used, 1 / np.where(used, scale, 1), 0)
        target = (y[1:] - mean * y[0]) * inv
        beta = np.linalg.pinv(centred * np.outer(inv, inv), rcond=1e-10, hermitian=True) @ target * inv
        return {"(constant)": float(y[0] / n - mean @ beta), **{c: float(b) for c, b in zip(columns, beta, strict=True)}}

    def rmse(self, coefficients: Mapping[str, float]) -> float:
        """Root mean square error of a linear prediction on these rows, from the cross products alone."""
        w = np.zeros(len(self.names))
        for c, b in coefficients.items():
            w[self.names.index(c)] = -b
        w[-1] = 1.0
        return float(np.sqrt(max(0.0, w @ self.gram @ w) / self.gram[0, 0]))


def cross_products(df: DataFrame, columns: Mapping[str, Column], label: Column) -> CrossProducts:
    """One pass over the rows with a label; ``columns`` must not be NULL (see ``present``)."""
    names = ["(constant)", *columns, "(label)"]
    data = df.where(label.isNotNull())
    return CrossProducts(names, gramian(data, [F.lit(1.0), *[c.cast("double") for c in columns.values()], label.cast("double")]))


def centres(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Mean of each column's finite values, 0 where there is none."""
    r = df.agg(*[F.avg(_finite(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: r[f"m{i}"] or 0.0 for i, c in enumerate(cols)}


def _finite(c: str) -> Column:
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def present(cols: Sequence[str], middle: Mapping[str, float]) -> dict[str, Column]:
    """Per column its distance from ``middle`` (0 where missing) and, as ``<c>__missing``, the missing
    flag.  A model that imputes any constant and adds the flag spans the same space, so its predictions
    are the same; near-zero means keep the cross products well conditioned."""
    out: dict[str, Column] = {}
    for c in cols:
        out[c] = F.coalesce(_finite(c) - F.lit(float(middle[c])), F.lit(0.0))
        out[f"{c}__missing"] = _finite(c).isNull().cast("double")
    return out


def levels(df: DataFrame, col: str, most: int = 10_000) -> list[str]:
    """Distinct values of a category, sorted; more than ``most`` is an error, not a cut."""
    found = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{col} has more than {most} values: not a category for one-hot columns")
    return sorted(found)


def one_hot(col: str, values: Sequence[str]) -> dict[str, Column]:
    return {f"{col}={v}": F.coalesce(F.col(col) == v, F.lit(False)).cast("double") for v in values}


def linear_prediction(coefficients: Mapping[str, float], columns: Mapping[str, Column]) -> Column:
    out = F.lit(coefficients["(constant)"])
    for c, b in coefficients.items():
        if c != "(constant)" and b:
            out = out + F.lit(b) * columns[c]
    return out
