"""Signal features that look across frames, and the assembled feature row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import signals
from tidemark.session import via_table


def frame_spectra(recordings: DataFrame, key: str, samples: str, size: int) -> DataFrame:
    """(key, frame, mags): spectrum of every frame."""
    return signals.framed(recordings, key, samples, size).select(
        key, "frame", signals.magnitudes(samples).alias("mags")
    )


def flux(spectra: DataFrame, key: str) -> DataFrame:
    """(key, flux): squared change of the spectrum from frame to frame, averaged over a recording.

    Each frame meets its successor through an equi-join on its number, so a long
    recording is not gathered into one task; a recording of one frame has a null flux.
    The spectra are written once, since both sides of the join read them.
    """
    known = via_table(spectra, "spectra")
    later = known.select(key, (F.col("frame") - 1).alias("frame"), F.col("mags").alias("_next"))
    change = F.zip_with("mags", "_next", lambda a, b: (b - a) * (b - a))
    met = known.join(later, [key, "frame"], "left")
    return met.groupBy(key).agg(F.avg(F.when(F.col("_next").isNotNull(), signals.total(change))).alias("flux"))


def area_moments(spectra: DataFrame, key: str) -> DataFrame:
    """(key, area, x_mean, y_mean, xy): moments of the frame-by-bin magnitude picture; null without samples."""
    bins = signals.bins(F.col("mags"))
    per_frame = spectra.select(
        key,
        F.col("frame").cast("double").alias("x"),
        signals.total("mags").alias("m"),
        signals.dot(bins, F.col("mags")).alias("ym"),
    )
    sums = per_frame.groupBy(key).agg(
        F.sum("m").alias("area"),
        F.sum(F.col("x") * F.col("m")).alias("_x"),
        F.sum("ym").alias("_y"),
        F.sum(F.col("x") * F.col("ym")).alias("_xy"),
    )
    return sums.select(
        key,
        "area",
        F.try_divide("_x", "area").alias("x_mean"),
        F.try_divide("_y", "area").alias("y_mean"),
        F.try_divide("_xy", "area").alias("xy"),
    )


def feature_rows(recordings: DataFrame, classes: list, order: int = 10) -> DataFrame:
    """(rec_id, zero_crossings, lpc1, label_index): the two features the classifier reads; unknown labels are null."""
    index: Column = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label"))
    return recordings.select(
        "rec_id",
        signals.zero_crossings(F.col("samples")).alias("zero_crossings"),
        signals.linear_prediction(F.col("samples"), order)[0].alias("lpc1"),
        F.when(index > 0, index - 1).alias("label_index"),
    )
