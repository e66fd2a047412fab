"""Vector expressions on array<double> columns and vectorised distance helpers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, even where `body` uses it for every array element."""
    return F.transform(F.array(value), body)[0]


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def total(a) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def l2_normalized(a) -> Column:
    return bound(l2_norm(a), lambda norm: F.when(norm > 0, F.transform(a, lambda x: x / norm)).otherwise(a))


def to_text(a) -> Column:
    """Space-separated text form of a vector."""
    return F.array_join(F.transform(a, lambda x: x.cast("string")), " ")


def from_text(text) -> Column:
    """Vector from its text form; trailing spaces are ignored, other text raises."""
    return F.split(F.rtrim(text), " ").cast("array<double>")


SLACK = 1e-11  # of squared norms, well above their rounding


def squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all rows of `a` to all rows of `b` up to rounding, and a bound on the rounding."""
    norms = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    return np.maximum(norms - 2 * (a @ b.T), 0), SLACK * norms


def nearest_rows(rows: np.ndarray, book: np.ndarray, metric: str = "l2") -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest row of `book` for every row, the first one on ties, and its distance.

    For l2 a matrix product finds the few candidates, whose distances are then measured directly.
    """
    if metric == "l1":
        dist = np.stack([np.abs(rows - center).sum(axis=1) for center in book], axis=1)
        word = dist.argmin(1)
        return word, dist[np.arange(len(rows)), word]
    origin = book.mean(0)
    near, slack = squares(rows - origin, book - origin)
    row, col = np.nonzero(near - slack <= (near + slack).min(1)[:, None])
    gap = rows[row] - book[col]
    dist = np.sqrt((gap * gap).sum(1))
    order = np.lexsort((col, dist, row))
    first = order[np.searchsorted(row[order], np.arange(len(rows)))]
    return col[first], dist[first]


def nearest_center(vec, centers: Sequence[Sequence[float]], metric: str = "l2") -> Column:
    """struct(word, dist): index of the nearest center (first one on ties) and its distance; null for a null vector.

    `centers` is a fitted codebook, k rows fixed by the caller, so it travels with the
    task; the rows are processed one Arrow batch at a time.
    """
    book = np.asarray(centers, dtype=float)

    @F.pandas_udf("struct<word: int, dist: double>")
    def assign(vectors: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"word": pd.array([pd.NA] * len(vectors), "Int32"), "dist": np.full(len(vectors), np.nan)})
        there = np.flatnonzero(vectors.notna().to_numpy())
        if len(there) and len(book):
            rows = np.concatenate(vectors.iloc[there].to_numpy()).astype(float).reshape(len(there), book.shape[1])
            word, dist = nearest_rows(rows, book, metric)
            out.loc[there, "word"], out.loc[there, "dist"] = word.astype(np.int32), dist
        return out

    found = assign(vec)
    return F.when(F.isnotnull(vec), found)
