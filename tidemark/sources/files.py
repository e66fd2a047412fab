"""Readers for delimited, nested and free-form text, and the matching writers."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import path_id, path_label
from tidemark.functions.vectors import from_text
from tidemark.session import path_exists

RATINGS = "user_id bigint, item_id bigint, rating double, ts bigint"


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Lines `user::item::rating::timestamp`; further fields of a line are ignored."""
    return spark.read.csv(path, sep="::", schema=RATINGS)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Lines `id::name`."""
    return spark.read.csv(path, sep="::", schema="item_id bigint, title string")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Lines `id::item::brand`."""
    return spark.read.csv(path, sep="::", schema="id bigint, item string, brand string")


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """Lines `user,item,rating`; a line of any other shape fails the read."""
    return spark.read.csv(path, schema="user_id bigint, item_id bigint, rating double", mode="FAILFAST")


def read_feature_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Header CSV with a row name and one number per column."""
    schema = "name string, " + ", ".join(f"{c} double" for c in columns)
    return spark.read.csv(path, header=True, schema=schema)


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    """`;`-separated, quoted, with header; quotes inside a value are doubled."""
    schema = "username string, caption string, tag string, tag_id int, link string"
    return spark.read.csv(path, sep=";", quote='"', escape='"', header=True, schema=schema)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """One space-separated vector per line; text that is no number fails the read."""
    return spark.read.text(path).select(array_to_vector(from_text(F.col("value"))).alias("features"))


def read_labelled_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Lines `label,v1 v2 ...`."""
    parts = F.split("value", ",", 2)
    return spark.read.text(path).select(
        parts[0].cast("double").alias("label"), array_to_vector(from_text(parts[1])).alias("features")
    )


def _with_empty(scanned: DataFrame) -> DataFrame:
    """Every file of the scan's listing: Spark lists empty files but hands out no row for them."""
    plain = lambda path: F.regexp_replace(path, "^([a-z]+:)/+", "$1/")  # noqa: E731  file:/x and file:///x are one
    listed = scanned.sparkSession.createDataFrame([(p,) for p in scanned.inputFiles()], "path string")
    found = scanned.withColumn("_found", plain("path")).drop("path")
    return listed.join(found, plain("path") == F.col("_found"), "left").drop("_found")


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, label, id, text): one row per file, labelled by the folder it lies in; an empty file has empty text."""
    rows = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    found = _with_empty(rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))
    return found.select(
        "path", path_label(F.col("path")).alias("label"), path_id(F.col("path")).alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, parent, length) of all files below a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = _with_empty(files.select(F.col("_metadata.file_path").alias("path"), "length"))
    return found.select(
        "path", path_id(F.col("path")).alias("name"), path_label(F.col("path")).alias("parent"),
        F.coalesce("length", F.lit(0)).alias("length"),
    )


def load_personal_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings above zero; a file without any is an error."""
    rated = read_ratings(spark, path).filter(F.col("rating") > 0)
    if rated.isEmpty():
        raise ValueError(f"no ratings above zero in {path}")
    return rated


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """(word): whitespace-separated words, each once."""
    words = F.explode(F.filter(F.split(F.trim("value"), r"\s+"), lambda w: w != ""))
    return spark.read.text(path).select(words.alias("word")).distinct()


def _attribute_type(declared: str) -> tuple[str, list[str] | None]:
    """Spark type of a declared attribute, and its allowed values when it is nominal."""
    if declared.startswith("{"):
        return "string", [v.strip() for v in declared.strip("{}").split(",")]
    kind = declared.split()[0].lower()
    known = {"numeric": "double", "real": "double", "integer": "bigint", "string": "string", "date": "date"}
    return known[kind], None


def _declared(lines: list[str]) -> list[tuple[str, str, list | None]]:
    """(name, declaration, nested attributes) in order; nested ones stand between a relational one and its end."""
    top: list = []
    open_: list | None = None
    for line in lines:
        words = line.split(None, 2)
        if words[0].lower() == "@end":
            open_ = None
        elif words[0].lower() == "@attribute":
            nested: list | None = [] if words[2].lower().startswith("relational") else None
            (top if open_ is None else open_).append((words[1].replace(".", "_"), words[2], nested))
            if nested is not None:
                open_ = nested
    return top


def _checked(value: Column, name: str, allowed: list[str] | None) -> Column:
    if allowed is None:
        return value
    bad = F.raise_error(F.concat(F.lit(f"value of {name} is not declared: "), value))
    return F.when(value.isNull() | value.isin(*allowed), value).otherwise(bad)


def _header_lines(spark: SparkSession, path: str) -> list[str]:
    """The lines up to and with `@data`, read from the start of the file until it is found."""
    n = 64
    while True:
        lines = [r.value for r in spark.read.text(path).head(n)]
        ends = [k for k, line in enumerate(lines) if line.strip().lower() == "@data"]
        if ends or len(lines) < n:
            return lines[: ends[0] + 1] if ends else lines
        n *= 4


def read_header_typed(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """Text table whose header declares numeric, nominal, string, date and relational attributes.

    The header is read on the driver and becomes the schema; the data lines are parsed
    where they lie. A relational cell holds lines of its own and becomes an array of structs.
    With the header in a file of its own, every non-blank line of `path` is data. Otherwise the
    lines above and with `@data` are the header, and a data line that begins with an unquoted `%`
    is a comment, as the format has it.
    """
    lines = _header_lines(spark, header or path)
    declared = _declared([line for line in lines if line.lstrip().startswith("@")])
    options = {"quote": "'", "escape": "", "mode": "FAILFAST", "dateFormat": "yyyy-MM-dd"}
    columns = [f"{n} {'string' if nested else _attribute_type(d)[0]}" for n, d, nested in declared]
    body = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    if header is None:  # header lines can only stand in the file's first block
        above = (F.col("_metadata.file_block_start") == 0) & F.col("value").isin(lines)
        body = body.filter(~above & ~F.col("value").startswith("%"))
    row = body.select(F.from_csv("value", ", ".join(columns), options).alias("r"))

    def cell(name, declaration, nested):
        value = F.col(f"r.{name}")
        if nested is None:
            return _checked(value, name, _attribute_type(declaration)[1]).alias(name)
        schema = ", ".join(f"{n} {_attribute_type(d)[0]}" for n, d, _ in nested)

        def inner(line):
            fields = F.from_csv(line, schema, options)
            return F.struct(*[_checked(fields[n], n, _attribute_type(d)[1]).alias(n) for n, d, _ in nested])

        return F.transform(F.split(value, re.escape("\\n")), inner).alias(name)

    return row.select(*[cell(*attribute) for attribute in declared])


# --- sinks --------------------------------------------------------------------------


def write_delimited(df: DataFrame, path: str, separator: str) -> None:
    """Rows as text lines with a separator of any length; an earlier output is replaced."""
    df.select(F.concat_ws(separator, *df.columns).alias("value")).write.mode("overwrite").text(path)


def materialize_once(spark: SparkSession, path: str, stage: Callable[[], DataFrame]) -> DataFrame:
    """The table at `path`; the stage only runs when a finished table is not there yet."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        stage().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
