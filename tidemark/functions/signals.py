"""Features of sampled signals as column expressions.

Only the Fourier transform and the linear-prediction solve run in NumPy, one Arrow
batch at a time; everything else is a built-in expression on the arrays they return.
Definitions are the textbook ones; spectra cover bins 0 .. n/2.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.vectors import bound, dot, total

ROLLOFF = 0.85
PEAK_SHARE = 0.1
FLOOR = 1e-12


def by_length(batch: pd.Series, one) -> pd.Series:
    """`one` on stacks of equally long rows: a matrix in, a row of results per row out."""
    out = pd.Series([np.array([])] * len(batch), index=batch.index, dtype=object)
    lengths = batch.map(lambda x: -1 if x is None else len(x))
    for length, rows in batch.groupby(lengths):
        if length > 0:
            out.loc[rows.index] = pd.Series(list(one(np.stack(rows.to_list()).astype(float))), index=rows.index)
        elif length < 0:
            out.loc[rows.index] = None
    return out


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def magnitudes(samples: pd.Series) -> pd.Series:
    """Magnitude spectrum of each row; rows may differ in length."""
    return by_length(samples, lambda rows: np.abs(np.fft.rfft(rows, axis=1)))


def frames(samples, size: int) -> Column:
    """array<array<double>>: consecutive frames of `size` samples; the last is filled up with zeros."""
    count = F.ceil(F.size(samples) / size).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    def frame(i):
        own = F.slice(samples, i * size + 1, F.lit(size))
        return F.concat(own, F.array_repeat(F.lit(0.0), size - F.size(own)))

    return F.transform(starts, frame)


def framed(df: DataFrame, key: str, samples: str, size: int) -> DataFrame:
    """(key, frame, samples): one row per frame; a recording without samples has one row of nulls."""
    return df.select(key, F.posexplode_outer(frames(F.col(samples), size)).alias("frame", samples))


def powers(mags) -> Column:
    return F.transform(mags, lambda m: m * m)


def bins(values) -> Column:
    """Bin numbers as doubles, one per value."""
    return F.transform(values, lambda _, i: i.cast("double"))


def centroid(mags) -> Column:
    return bound(powers(mags), lambda power: F.try_divide(dot(bins(power), power), total(power)))


def rolloff(mags) -> Column:
    """Smallest bin at which the cumulated power reaches 85 percent of all power."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("bin"), F.lit(0).alias("i"))

    def first_reaching(limit):
        return F.aggregate(
            powers(mags),
            start,
            lambda s, p: F.struct(
                (s["sum"] + p).alias("sum"),
                F.when((s["bin"] < 0) & (s["sum"] + p >= limit), s["i"]).otherwise(s["bin"]).alias("bin"),
                (s["i"] + 1).alias("i"),
            ),
        )["bin"]

    return bound(total(powers(mags)) * ROLLOFF, first_reaching)


def inner_bins(values) -> Column:
    """Positions that have a neighbor on both sides (0-based); empty for short arrays."""
    n = F.size(values)
    return F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))


def at(values, i) -> Column:
    return F.get(values, i)


def compactness(mags) -> Column:
    """Summed distance of each log magnitude from the mean of itself and its neighbors, in decibels."""
    return bound(
        F.transform(mags, lambda m: 20 * F.log10(F.greatest(m, F.lit(FLOOR)))),
        lambda logs: F.aggregate(
            inner_bins(logs),
            F.lit(0.0),
            lambda s, i: s + F.abs(at(logs, i) - (at(logs, i - 1) + at(logs, i) + at(logs, i + 1)) / 3),
        ),
    )


def mean(values) -> Column:
    return F.try_divide(total(values), F.size(values))


def central_moment(values, order: int) -> Column:
    power = F.lit(float(order))
    return bound(
        mean(values),
        lambda m: F.try_divide(F.aggregate(values, F.lit(0.0), lambda s, x: s + F.pow(x - m, power)), F.size(values)),
    )


def variability(mags) -> Column:
    """Standard deviation of the magnitudes."""
    return F.sqrt(central_moment(mags, 2))


def root_mean_square(samples) -> Column:
    return F.sqrt(F.try_divide(dot(samples, samples), F.size(samples)))


def zero_crossings(samples) -> Column:
    """Sign changes between neighbors; a zero sample counts as positive."""
    later = F.slice(samples, F.lit(2), F.greatest(F.size(samples) - 1, F.lit(0)))
    now = F.slice(samples, F.lit(1), F.greatest(F.size(samples) - 1, F.lit(0)))
    changes = F.zip_with(now, later, lambda a, b: ((a >= 0) != (b >= 0)).cast("bigint"))
    return F.aggregate(changes, F.lit(0).cast("bigint"), lambda s, x: s + x)


def frame_energy(samples, size: int) -> Column:
    """Root mean square of every frame."""
    return F.transform(frames(samples, size), root_mean_square)


def centred(values) -> Column:
    return bound(mean(values), lambda m: F.transform(values, lambda x: x - m))


def low_energy_share(samples, size: int) -> Column:
    """Share of frames whose energy lies below the mean frame energy."""
    return bound(
        frame_energy(samples, size),
        lambda energy: bound(
            mean(energy),
            lambda average: F.try_divide(F.size(F.filter(energy, lambda e: e < average)), F.size(energy)),
        ),
    )


def autocorrelation(values, lags: int) -> Column:
    """Mean product of the values with themselves, shifted by 1 .. lags positions."""
    shifts = F.array(*[F.lit(lag) for lag in range(1, lags + 1)])

    def one(x, lag):
        length = F.greatest(F.size(x) - lag, F.lit(0))
        return F.try_divide(dot(F.slice(x, F.lit(1), length), F.slice(x, lag + 1, length)), F.size(x))

    return bound(values, lambda x: F.transform(shifts, lambda lag: one(x, lag)))


def beat_histogram(samples, frame: int, lags: int) -> Column:
    """Autocorrelation of the centred frame energies: strength of each beat period, in frames."""
    energy = bound(frame_energy(samples, frame), centred)
    return F.transform(autocorrelation(energy, lags), lambda x: F.greatest(x, F.lit(0.0)))


def strongest_beat(histogram) -> Column:
    """Beat period with the strongest entry, the shortest one on ties."""
    return F.array_position(histogram, F.array_max(histogram))


def mel(hertz: float) -> float:
    return 2595 * math.log10(1 + hertz / 700)


def mel_bank(n_bins: int, rate: float, filters: int) -> list[list[float]]:
    """Triangular filters, evenly spaced on the mel scale from 0 to half the sample rate."""
    top = mel(rate / 2)
    edges = [700 * (10 ** (top * i / (filters + 1) / 2595) - 1) for i in range(filters + 2)]
    step = rate / 2 / (n_bins - 1)

    def weight(hertz, low, mid, high):
        return max(0.0, min((hertz - low) / (mid - low), (high - hertz) / (high - mid)))

    return [[weight(b * step, *edges[f : f + 3]) for b in range(n_bins)] for f in range(filters)]


def cosine_rows(n_out: int, n_in: int) -> list[list[float]]:
    """Rows of the type-II discrete cosine transform."""
    return [[math.cos(math.pi * k * (i + 0.5) / n_in) for i in range(n_in)] for k in range(n_out)]


def constant_q_kernel(n_bins: int, low: float, per_octave: int, count: int) -> list[list[float]]:
    """Triangles around geometrically spaced bins; their width grows with the center."""
    rows = []
    for i in range(count):
        mid = low * 2 ** (i / per_octave)
        half = mid * (2 ** (1 / per_octave) - 1)
        rows.append([max(0.0, 1 - abs(b - mid) / max(half, 1.0)) for b in range(n_bins)])
    return rows


def times(matrix: list[list[float]], vec) -> Column:
    """Constant matrix times a vector column."""
    rows = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in matrix])
    return bound(vec, lambda v: F.transform(rows, lambda row: dot(row, v)))


def mfcc(mags, n_bins: int, rate: float, filters: int = 13, count: int = 5) -> Column:
    """Cosine transform of the log mel energies, for spectra of `n_bins` at one sample rate."""
    energies = times(mel_bank(n_bins, rate, filters), powers(mags))
    logs = F.transform(energies, lambda e: F.log(F.greatest(e, F.lit(FLOOR))))
    return times(cosine_rows(count, filters), logs)


def constant_q(mags, n_bins: int, low: float = 2.0, per_octave: int = 3, count: int = 12) -> Column:
    return times(constant_q_kernel(n_bins, low, per_octave, count), mags)


def by_shape(mags: pd.Series, rate: pd.Series, one) -> pd.Series:
    """`one(matrix, n_bins, rate)` on stacks of rows of one length and sample rate; null without two bins or a rate."""
    lengths = mags.map(lambda x: 0 if x is None else len(x))
    usable = (lengths > 1) & rate.notna() & (rate > 0)
    out = pd.Series([None] * len(mags), index=mags.index, dtype=object)
    for (n, hertz), rows in mags[usable].groupby([lengths[usable], rate[usable]]):
        out.loc[rows.index] = pd.Series(list(one(np.stack(rows.to_list()).astype(float), n, hertz)), index=rows.index)
    return out


def mel_matrix(n_bins: int, rate: float, filters: int) -> np.ndarray:
    """`mel_bank` for any number of bins, as a matrix."""
    top = mel(rate / 2)
    edges = np.array([700 * (10 ** (top * i / (filters + 1) / 2595) - 1) for i in range(filters + 2)])[:, None]
    hertz = np.arange(n_bins)[None] * (rate / 2 / (n_bins - 1))
    rising, falling = (hertz - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - hertz) / (edges[2:] - edges[1:-1])
    return np.maximum(0.0, np.minimum(rising, falling))


def cepstra(filters: int = 13, count: int = 5):
    """An expression of (spectrum, sample rate): `mfcc` for recordings of any lengths and rates, a batch at a time."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(mags: pd.Series, rate: pd.Series) -> pd.Series:
        cosines = np.array(cosine_rows(count, filters)).T

        def one(rows, n, hertz):
            return np.log(np.maximum(rows * rows @ mel_matrix(n, hertz, filters).T, FLOOR)) @ cosines

        return by_shape(mags, rate, one)

    return lambda mags, rate: run(mags, rate.cast("double"))


def constant_qs(low: float = 2.0, per_octave: int = 3, count: int = 12):
    """An expression of (spectrum, sample rate): `constant_q` for recordings of any lengths."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(mags: pd.Series, rate: pd.Series) -> pd.Series:
        mid = low * 2 ** (np.arange(count) / per_octave)[:, None]
        half = np.maximum(mid * (2 ** (1 / per_octave) - 1), 1.0)
        return by_shape(mags, rate, lambda rows, n, _: rows @ np.maximum(0.0, 1 - abs(np.arange(n)[None] - mid) / half).T)

    return lambda mags, rate: run(mags, rate.cast("double"))


def linear_prediction(samples, order: int) -> Column:
    """Coefficients that predict a sample from the `order` before it (autocorrelation method)."""
    lag = np.abs(np.subtract.outer(np.arange(order), np.arange(order)))

    def stacked(rows):
        n = rows.shape[1]
        if n <= order:
            return np.zeros((len(rows), order))
        r = np.stack([np.einsum("ij,ij->i", rows[:, : n - shift], rows[:, shift:]) for shift in range(order + 1)], 1)
        inverse = np.linalg.pinv(r[:, lag], rcond=np.finfo(float).eps * order)  # least squares where singular
        return np.einsum("ijk,ik->ij", inverse, r[:, 1:])

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(batch: pd.Series) -> pd.Series:
        found = by_length(batch, stacked)
        return found.map(lambda x: np.zeros(order) if x is not None and not len(x) else x)

    return solve(samples)


def spectrum_moments(mags) -> Column:
    """Sum, mean bin, spread, skewness and kurtosis of the magnitudes as weights over the bins."""
    weight = total(mags)

    def moment(center, order):
        offsets = F.transform(bins(mags), lambda b: F.pow(b - center, F.lit(float(order))))
        return F.try_divide(dot(offsets, mags), weight)

    def around(center):
        spread = moment(center, 2)
        return F.array(
            weight,
            center,
            spread,
            F.try_divide(moment(center, 3), F.pow(spread, F.lit(1.5))),
            F.try_divide(moment(center, 4), spread * spread),
        )

    return bound(F.try_divide(dot(bins(mags), mags), weight), around)


def peaks(mags) -> Column:
    """Bins larger than both neighbors and at least a tenth of the largest magnitude."""
    return bound(
        F.array_max(mags) * PEAK_SHARE,
        lambda limit: F.filter(
            inner_bins(mags),
            lambda i: (at(mags, i) > at(mags, i - 1)) & (at(mags, i) > at(mags, i + 1)) & (at(mags, i) >= limit),
        ),
    )
