"""Gaussian mixtures by expectation maximisation, started from the principal directions of the data.

Start. The mean and covariance are summed in one pass; their decomposition gives the directions in which the rows
spread most. The widest directions are cut into ranges of about equal numbers of rows, some cells for each component in
all, and the moments of the cells, numbers of fixed size, are merged on the driver, always the two whose merging adds least to
the squared errors, until the means of k are left to start from (after Maitra, "Initializing partition-optimization algorithms", 2009).
Coarse and fine cells make a start each (CELLS); after a few rounds of all, the likeliest goes on.

Rounds. The vectors are packed into matrices once and kept. A round is one pass: every task adds up each component's
responsibilities, weighted vectors and weighted outer products, all components of some rows at once, and the driver
gets the sums of fixed size. Rounds end when the mean log-likelihood gains
less than `tolerance`. Covariances get `ridge` times the data's mean variance on the diagonal.

Rows with a null vector take no part; a table with fewer distinct rows than components gives fewer components.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.vectors import dot
from tidemark.operators.gram import merged, moments
from tidemark.session import spread

CELLS = (1, 4, 16)  # cells for each component
TRIAL_ROUNDS = 6
TILE = 1 << 15  # numbers of a matrix that a round works on at once
EPSILON = float(np.finfo(float).eps)
SUMS = "component int, n double, mean array<double>, scatter array<double>, log_likelihood double"


@dataclass
class Mixture:
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray

    def roots(self, exact: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Per component a matrix whose product with (row - mean) has the squared length of the exponent, and the log of
        weight over norm. `exact` needs full rank; otherwise directions of no spread are left out, as the library does.
        """
        width, roots, logs = self.means.shape[1], [], []
        for s in self.covariances:
            if exact:
                lower = np.linalg.cholesky(s)
                roots.append(np.linalg.inv(lower))
                logs.append(np.log(np.diag(lower)).sum())
                continue
            size, axes = np.linalg.eigh(s)
            wide = size > EPSILON * size.max() * width
            if not np.isnan(size).any() and not wide.any():
                raise ValueError("a component without any spread")
            roots.append(np.where(wide, np.where(wide, size, 1.0) ** -0.5, 0.0)[:, None] * axes.T)
            logs.append(0.5 * np.log(size[wide]).sum())
        return np.array(roots), np.log(self.weights) - 0.5 * width * np.log(2 * np.pi) - np.array(logs)


def matrices(rows: DataFrame, vec: str = "vec") -> RDD:
    """The vectors as matrices of one Arrow batch each, kept for the rounds (on disk where memory is short)."""

    def run(batches):
        for batch in batches:
            if n := len(batch[0]):
                flat = batch[0].flatten().to_numpy(zero_copy_only=False)  # missing numbers are NaN
                yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int32()), "flat": pa.array([flat.tobytes()], pa.binary())})

    packed = spread(rows.select(vec).mapInArrow(run, "n int, flat binary"))
    return packed.rdd.map(lambda r: np.frombuffer(r["flat"]).reshape(r["n"], -1)).persist(StorageLevel.MEMORY_AND_DISK)


def round_sums(blocks: RDD, model: Mixture, least: float = 0.0):
    """(n, first, second, log-likelihood): responsibilities of all rows summed per component, with the vectors and outer
    products they weigh, measured from the component's mean. `least` is added to every weighted density, as the library does.

    Where no component is much narrower than the data, exponents and sums are two matrix products with the coordinates
    and their products in units of the data's spread; else differences from each mean are taken row by row.
    """
    roots, logs = model.roots(exact=not least)
    quadratic = products(model, roots, logs)

    def responsibilities(shares):
        top = 0.0 if least else shares.max(0)
        shares -= top
        np.exp(shares, out=shares)
        shares += least
        whole = shares.sum(0)
        shares /= whole
        return shares, float((np.log(whole) + top).sum())

    def apart_sums(parts):
        means = model.means
        k, width = means.shape
        step = max(16, TILE // (k * width))
        n, first, second, likelihood = np.zeros(k), np.zeros((k, width)), np.zeros((k, width, width)), 0.0
        for block in parts:
            for at in range(0, len(block), step):
                apart = np.ascontiguousarray(block[at : at + step].T)[None] - means[:, :, None]
                z = roots @ apart
                shares, log = responsibilities(logs[:, None] - 0.5 * np.einsum("kdr,kdr->kr", z, z))
                weighted = apart * shares[:, None]
                n += shares.sum(1)
                first += weighted.sum(2)
                second += weighted @ apart.transpose(0, 2, 1)
                likelihood += log
        yield n, first, second, likelihood

    def product_sums(parts):
        center, unit, factors = quadratic
        k, width = model.means.shape
        step = max(16, TILE // factors.shape[1])
        total, likelihood = np.zeros(factors.shape), 0.0
        made = np.ones((factors.shape[1], step))
        for block in parts:
            for at in range(0, len(block), step):
                y = ((block[at : at + step] - center) / unit).T
                terms = made[:, : y.shape[1]]
                terms[1 : width + 1] = y
                place = width + 1
                for i in range(width):
                    np.multiply(y[i:], y[i], out=terms[place : place + width - i])
                    place += width - i
                shares, log = responsibilities(factors @ terms)
                total += shares @ terms.T
                likelihood += log
        n, first, second = total[:, 0], total[:, 1 : width + 1], np.zeros((k, width, width))
        rows, columns = np.triu_indices(width)
        second[:, rows, columns] = second[:, columns, rows] = total[:, width + 1 :]
        m = (model.means - center) / unit
        cross = m[:, :, None] * first[:, None, :]
        second += n[:, None, None] * m[:, :, None] * m[:, None, :] - cross - cross.transpose(0, 2, 1)
        yield n, (first - n[:, None] * m) * unit, second * unit[:, None] * unit, likelihood

    summed = blocks.mapPartitions(apart_sums if quadratic is None else product_sums)
    return summed.treeReduce(lambda a, b: tuple(x + y for x, y in zip(a, b, strict=True)))


NARROW = 1e6  # at which ratio of variances exponents are no longer put together from products


def products(model: Mixture, roots: np.ndarray, logs: np.ndarray):
    """(center, unit, [component, term]): factors of 1, the coordinates and their products in an exponent; None if one is too narrow."""
    center = model.weights @ model.means
    unit = np.sqrt(model.weights @ (np.einsum("kii->ki", model.covariances) + (model.means - center) ** 2))
    unit = np.where(unit > 0, unit, 1.0)
    scaled, m = roots * unit, (model.means - center) / unit
    inverse = scaled.transpose(0, 2, 1) @ scaled
    if not np.abs(inverse).max() <= NARROW:
        return None
    towards = np.einsum("kij,kj->ki", inverse, m)
    rows, columns = np.triu_indices(m.shape[1])
    squares = inverse[:, rows, columns] * np.where(rows == columns, -0.5, -1.0)
    return center, unit, np.hstack([(logs - 0.5 * (towards * m).sum(1))[:, None], towards, squares])


def moved(model: Mixture, sums, floor: float) -> Mixture:
    """The mixture of a round's sums; components without rows are left out."""
    n, first, second, _ = sums
    filled = ~(n <= 0)
    total, n = n[filled].sum(), n[filled]
    step = first[filled] / n[:, None]
    covariances = second[filled] / n[:, None, None] - step[:, :, None] * step[:, None, :]
    return Mixture(n / total, model.means[filled] + step, covariances + floor * np.eye(step.shape[1]))


def weighted_sums(rows: DataFrame, shares, n_components: int):
    """Per component the moments of all rows, weighted by `shares(vecs)` = (weights [row, component], log-likelihoods)."""

    def run(batches):
        total, likelihood = [None] * n_components, 0.0
        for batch in batches:
            column = batch[0]
            if not len(column):
                continue
            vecs = column.flatten().to_numpy().reshape(len(column), -1)
            weights, logs = shares(vecs)
            likelihood += float(logs.sum())
            for c in range(n_components):
                w = weights[:, c]
                n = w.sum()
                if n > 0:
                    mean = w @ vecs / n
                    apart = vecs - mean
                    total[c] = merged(total[c], (n, mean, (apart * w[:, None]).T @ apart))
        yield packed(total, likelihood)

    def add(batches):
        total, likelihood = [None] * n_components, 0.0
        for batch in batches:
            for r in batch.to_pylist():
                likelihood += take(r, total)
        yield packed(total, likelihood)

    cores = rows.sparkSession.sparkContext.defaultParallelism
    total, likelihood = [None] * n_components, 0.0
    made = rows.mapInArrow(run, SUMS).repartition(cores).mapInArrow(add, SUMS)
    for r in made.collect():  # a row per component and core
        likelihood += take(r, total)
    return total, likelihood


def packed(total: list, likelihood: float) -> pa.RecordBatch:
    filled = [(c, t) for c, t in enumerate(total) if t is not None]
    number = pa.list_(pa.float64())
    return pa.RecordBatch.from_pydict(
        {
            "component": pa.array([-1, *(c for c, _ in filled)], pa.int32()),
            "n": pa.array([0.0, *(float(t[0]) for _, t in filled)], pa.float64()),
            "mean": pa.array([[], *(t[1] for _, t in filled)], number),
            "scatter": pa.array([[], *(t[2].ravel() for _, t in filled)], number),
            "log_likelihood": pa.array([likelihood] + [0.0] * len(filled), pa.float64()),
        }
    )


def take(r, total: list) -> float:
    if r["component"] >= 0:
        mean = np.array(r["mean"])
        total[r["component"]] = merged(total[r["component"]], (r["n"], mean, np.array(r["scatter"]).reshape(len(mean), -1)))
    return r["log_likelihood"]


def from_sums(total: list, floor: float) -> Mixture:
    filled = [t for t in total if t is not None and t[0] > 0]
    n = sum(t[0] for t in filled)
    width = len(filled[0][1])
    return Mixture(
        np.array([t[0] / n for t in filled]),
        np.array([t[1] for t in filled]),
        np.array([t[2] / t[0] + floor * np.eye(width) for t in filled]),
    )


def cuts_along(rows: DataFrame, directions: np.ndarray, mean: np.ndarray, parts: list[int], vec: str) -> list[list[float]]:
    """Quantiles of the projections on each direction, from mergeable sketches."""
    shift = [float(d @ mean) for d in directions]
    projected = [dot(vec, F.array(*map(F.lit, map(float, d)))) - s for d, s in zip(directions, shift, strict=True)]
    aggregates = [
        F.percentile_approx(p, [j / n for j in range(1, n)], 10_000).alias(f"q{i}") for i, (p, n) in enumerate(zip(projected, parts, strict=True))
    ]
    found = rows.agg(*aggregates).first()
    return [list(found[f"q{i}"]) for i in range(len(parts))]


def parts_of(k: int, spread: np.ndarray) -> list[int]:
    """How many ranges each direction is cut into, k cells in all: the widest range left is cut by the next prime factor."""
    parts = [1] * len(spread)
    factors, rest, f = [], k, 2
    while rest > 1:
        while rest % f == 0:
            factors.append(f)
            rest //= f
        f += 1
    for f in sorted(factors, reverse=True):
        at = max(range(len(parts)), key=lambda i: spread[i] / parts[i])
        parts[at] *= f
    used = [n for n in parts if n > 1]
    return parts[: max(i for i, n in enumerate(parts) if n > 1) + 1] if used else [1]


def svd_start(rows: DataFrame, k: int, ridge: float = 1e-6, vec: str = "vec", each: int = 16, found=None) -> tuple[Mixture, float, int] | None:
    """Components from cells along the principal directions, the diagonal floor of covariances, and the number of rows.

    `found` are the moments of the rows where they are known already.
    """
    rows = rows.select(vec).where(f"{vec} IS NOT NULL")
    found = found or moments(rows, vec)
    if found is None:
        return None
    n, mean, cov = found
    size, axes = np.linalg.eigh(cov)
    order = np.argsort(-size)
    spread, directions = np.sqrt(np.maximum(size[order], 0)), axes[:, order].T
    directions = directions * np.where(directions[np.arange(len(mean)), abs(directions).argmax(1)] < 0, -1, 1)[:, None]
    parts = parts_of(each * k, spread)
    floor = ridge * max(float(np.trace(cov)) / len(mean), 1e-12)
    cut = [i for i, p in enumerate(parts) if p > 1]
    edges = cuts_along(rows, directions[cut], mean, [parts[i] for i in cut], vec) if cut else []

    def shares(vecs):
        cell = np.zeros(len(vecs), int)
        for i, e in zip(cut, edges, strict=True):
            cell = cell * parts[i] + np.searchsorted(e, (vecs - mean) @ directions[i], side="left")
        return np.eye(each * k)[cell], np.zeros(len(vecs))

    total, _ = weighted_sums(rows, shares, each * k)
    total = fewest([t for t in total if t is not None], k, spread)
    # Covariances start wide, as those of all rows; the cells' own ones hold on to the cells.
    return from_sums([(t[0], t[1], cov * t[0]) for t in total], floor), floor, n


def fewest(cells: list, k: int, spread: np.ndarray) -> list:
    """At most k sets of moments: the two whose merging adds least to the squared errors are merged, again and again."""
    cells, scale = list(cells), 1 / np.maximum(spread.max(), 1e-300)
    while len(cells) > k or (len(cells) > 1 and closest(cells, scale)[0] <= 1e-24):
        _, i, j = closest(cells, scale)
        cells[i] = merged(cells[i], cells[j])
        del cells[j]
    return cells


def closest(cells: list, scale: float) -> tuple[float, int, int]:
    n, means = np.array([c[0] for c in cells]), np.array([c[1] for c in cells]) * scale
    gap = ((means[:, None] - means[None]) ** 2).sum(2) * (n[:, None] * n[None] / (n[:, None] + n[None]))
    gap[np.tril_indices(len(cells))] = np.inf
    at = int(gap.argmin())
    return float(gap.flat[at]), at // len(cells), at % len(cells)


def rounds(blocks: RDD, model: Mixture, floor: float, n: int, iters: int, tolerance: float) -> tuple[Mixture, list[float]]:
    """At most `iters` rounds from `model`: the last model whose likelihood is known, and the likelihoods."""
    history: list[float] = []
    for _ in range(iters):
        sums = round_sums(blocks, model)
        history.append(sums[-1])
        if len(history) > 1 and history[-1] - history[-2] < tolerance * n:
            return model, history
        model = moved(model, sums, floor)
    return model, history


def fit_from(blocks: RDD, model: Mixture, iters: int, tolerance: float = 0.01) -> tuple[Mixture, float]:
    """(mixture, log-likelihood) as the library's rounds give them: until the likelihood moves by `tolerance` or less."""
    likelihood, before = -np.finfo(float).max, 0.0
    for _ in range(iters):
        if not abs(likelihood - before) > tolerance:
            break
        sums = round_sums(blocks, model, EPSILON)
        before, likelihood = likelihood, sums[-1]
        model = moved(model, sums, 0.0)
    return model, likelihood


def fit(
    rows: DataFrame, k: int, iters: int = 100, tolerance: float = 1e-6, ridge: float = 1e-6, vec: str = "vec", cells=CELLS
) -> tuple[Mixture | None, list[float]]:
    """(mixture, log-likelihoods per round): expectation maximisation from the likeliest of the starts."""
    rows = spread(rows.select(vec).where(f"{vec} IS NOT NULL")).persist()
    found = moments(rows, vec)
    if found is None:
        rows.unpersist()
        return None, []
    started = [svd_start(rows, k, ridge, vec, each, found) for each in cells]
    blocks, tried = matrices(rows, vec), []
    for start, floor, n in started:
        tried.append(rounds(blocks, start, floor, n, min(iters, TRIAL_ROUNDS), tolerance) if len(cells) > 1 else (start, []))
    model, before = max(tried, key=lambda t: t[1][-1] if t[1] else 0.0)
    model, history = rounds(blocks, model, floor, n, iters - len(before), tolerance)
    blocks.unpersist()
    rows.unpersist()
    return model, before + history


def report(spark, model: Mixture, history: list[float]) -> DataFrame:
    """(component, weight, mean, log_likelihood, rounds)."""
    rows = [] if model is None else [
        (c, float(w), [float(x) for x in m], history[-1], len(history)) for c, (w, m) in enumerate(zip(model.weights, model.means, strict=True))
    ]
    return spark.createDataFrame(rows, "component int, weight double, mean array<double>, log_likelihood double, rounds int")
