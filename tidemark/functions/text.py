"""Text expressions; all of them are built-in column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_tokens(text, separator: str = " ") -> Column:
    """Tokens of `text`; empty tokens are dropped wherever they occur."""
    return F.filter(F.split(text, separator), lambda token: token != "")


def tokens(df: DataFrame, text: str = "text", out: str = "token", separator: str = " ") -> DataFrame:
    """One row per token; all other columns but the text are kept."""
    return df.withColumn(out, F.explode(split_tokens(F.col(text), separator))).drop(text)


def hashtags(df: DataFrame, text: str = "text", out: str = "topic") -> DataFrame:
    return tokens(df, text, out).filter(F.col(out).startswith("#"))


def letter_words(text) -> Column:
    """Lower-cased runs of three or more letters, in any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{3,}"), F.lit(0))


def words(df: DataFrame, text: str = "text", out: str = "token") -> DataFrame:
    return df.withColumn(out, F.explode(letter_words(F.col(text)))).drop(text)


def letters_only(text) -> Column:
    """Remove everything but ASCII letters."""
    return F.regexp_replace(text, "[^a-zA-Z]", "")


def spaced_letters(text) -> Column:
    """Replace everything but ASCII letters by a space and lower-case the rest."""
    return F.lower(F.regexp_replace(text, "[^a-zA-Z]", " "))


def is_word(token) -> Column:
    return token.rlike(r"^\p{L}+$")


def clean_tokens(text, stop_words: Sequence[str] | None = None) -> Column:
    """Keep letter-only tokens longer than two characters, lower-case and re-join them."""
    kept = F.filter(F.split(text, r"[ \n]"), lambda token: is_word(token) & (F.length(token) > 2))
    lowered = F.transform(kept, lambda token: F.lower(token))
    if stop_words:
        lowered = F.filter(lowered, lambda token: ~token.isin(*stop_words))
    return F.array_join(lowered, " ")


def letter_number(name) -> Column:
    """1..26 for the first ASCII letter of a name, null when it has none."""
    first = F.lower(F.substring(letters_only(name), 1, 1))
    return F.when(first != "", F.ascii(first) - 96)


def contains_any(text, words_: Sequence[str]) -> Column:
    """Whether the lower-cased text contains any of the (lower-case) words."""
    lowered = F.lower(text)
    found = F.lit(False)
    for word in words_:
        found = found | lowered.contains(word)
    return found


def path_label(path) -> Column:
    """Second to last segment: the folder a file lies in."""
    return F.element_at(F.split(path, "/"), -2)


def path_id(path) -> Column:
    return F.element_at(F.split(path, "/"), -1)
