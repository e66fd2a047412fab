"""Sliding-window counts for tables and streams, and top-k per window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.relational import top_rows_per

WINDOW = ["window_start", "window_end"]


def window_counts(
    df: DataFrame, keys: list[str], length: int, slide: int, ts: str = "ts", lateness: str = "10 minutes"
) -> DataFrame:
    """(window_start, window_end, keys, n) in epoch seconds: rows per sliding window and key.

    Works on a table and on a stream. On a table the rows are first counted per pane of
    one slide, so a dense stream is reduced before it is spread over its windows. On a
    stream the built-in window does the spreading and a watermark bounds the state.
    """
    if df.isStreaming:
        span = F.window(ts, f"{length} seconds", f"{slide} seconds")
        counted = df.withWatermark(ts, lateness).groupBy(span.alias("w"), *keys).agg(F.count("*").alias("n"))
        return counted.select(
            F.unix_timestamp("w.start").alias("window_start"), F.unix_timestamp("w.end").alias("window_end"), *keys, "n"
        )
    if length % slide:
        raise ValueError("the window length must be a multiple of the slide")
    pane = F.expr(f"(unix_micros({ts}) - pmod(unix_micros({ts}), {slide}000000L)) div {slide}000000L")
    panes = df.select(*keys, pane.alias("_pane")).groupBy("_pane", *keys).agg(F.count("*").alias("_n"))
    starts = F.explode(F.sequence(F.col("_pane") - (length // slide - 1), F.col("_pane")))
    return (
        panes.select(starts.alias("_w"), *keys, "_n")
        .groupBy("_w", *keys)
        .agg(F.sum("_n").alias("n"))
        .select(
            (F.col("_w") * slide).alias("window_start"), (F.col("_w") * slide + length).alias("window_end"), *keys, "n"
        )
    )


def top_per_window(counts: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The k most frequent keys of each window, by count, then by key."""
    return top_rows_per(counts, WINDOW, [F.col("n").desc(), F.col(key)], k)


def window_messages(counts: DataFrame, key: str, k: int = 10) -> DataFrame:
    """One text line per top key and window."""
    top = top_per_window(counts, key, k)
    return top.select(*WINDOW, "rank", F.format_string("%s (%s tweets)", F.col(key), F.col("n")).alias("message"))
