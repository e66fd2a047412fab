"""Functions that `spark.sql` can call: native SQL functions, and one Python table function.

The SQL functions are expressions with a name; Catalyst puts them into the plan like any other expression.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

#: Name and parameters, what it returns, and its expression.
SCALARS = [
    ("is_word(s STRING)", "BOOLEAN", r"s RLIKE '^\\p{L}+$'"),
    ("letters_of(s STRING)", "STRING", "regexp_replace(s, '[^a-zA-Z]', '')"),
    ("signal_rms(x ARRAY<DOUBLE>)", "DOUBLE", "sqrt(aggregate(x, 0D, (a, v) -> a + v * v) / nullif(size(x), 0))"),
    (
        "signal_zero_crossings(x ARRAY<DOUBLE>)",
        "INT",
        "CASE WHEN size(x) < 2 THEN 0 ELSE size(filter(sequence(1, size(x) - 1), i -> (x[i - 1] >= 0) <> (x[i] >= 0))) END",
    ),
]
TABLES = [
    (
        "words_of(s STRING)",
        "TABLE (position INT, token STRING)",
        "SELECT pos, col FROM (SELECT posexplode(filter(split(s, ' '), t -> t <> '')))",
    )
]


@udtf(returnType="position int, token string")
class TokenPositions:
    """Tokens of a text with their places, for texts that need a separator pattern of their own."""

    def eval(self, text: str, separator: str):
        import re

        for position, token in enumerate(t for t in re.split(separator, text or "") if t):
            yield position, token


def register(spark: SparkSession) -> None:
    """Make all of them known to the session; a later call replaces them."""
    for signature, returns, body in SCALARS + TABLES:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")
    spark.udtf.register("token_positions", TokenPositions)
