"""Small scalar expressions shared by several queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names and ratings for sentiment classes 0 to 4.
SENTIMENT_NAMES = ["very negative", "negative", "neutral", "positive", "very positive"]
SENTIMENT_RATINGS = [1.0, 2.0, 3.0, 4.0, 5.0]


def category_index(value, categories: Sequence[str]) -> Column:
    """0-based position in a fixed list, -1 when absent."""
    return F.array_position(F.array(*[F.lit(c) for c in categories]), value) - 1


def category_name(index, categories: Sequence[str]) -> Column:
    return F.try_element_at(F.array(*[F.lit(c) for c in categories]), (index + 1).cast("int"))


def sentiment_css(score) -> Column:
    name = category_name(F.when(score.between(0, 4), score), SENTIMENT_NAMES)
    return F.coalesce(F.concat(F.lit("sentiment : "), name), F.lit(""))


def sentiment_rating(score) -> Column:
    return F.when(score.between(0, 4), score + F.lit(1.0)).otherwise(0.0).cast("double")


def decided_sentiment(score) -> Column:
    """Neutral and unknown classes become -1."""
    return F.when(score.isin(0, 1, 3, 4), score).otherwise(F.lit(-1))


def json_threshold(text, path: str, threshold: float) -> Column:
    """Whether a number inside a JSON text reaches the threshold; null when it is missing."""
    return F.get_json_object(text, path).cast("double") >= threshold


def hashed_percent(key) -> Column:
    """A repeatable number 0..99 from a numeric id (multiplicative hash modulo a large prime).

    The remainder comes first: a large id times the factor would not fit 64 bits.
    """
    prime = F.lit(1_000_003)
    return F.pmod(F.pmod(F.pmod(key, prime) * 7919, prime), F.lit(100))


def random_split_name(key, shares: dict[str, float]) -> Column:
    """Name of the split a row falls in; stable under re-partitioning, unlike a sampled split."""
    roll, edge = hashed_percent(key), 0.0
    out = None
    for name, share in shares.items():
        edge += share * 100
        case = roll < round(edge)
        out = F.when(case, name) if out is None else out.when(case, name)
    return out


def digit_split_name(digit) -> Column:
    """About 60/20/20 by the last digit of a key."""
    return F.when(digit < 6, "train").when(digit < 8, "validation").otherwise("test")
