"""Loader for the parquet tables, and the inputs derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import spread


def with_event_time(df: DataFrame) -> DataFrame:
    """Cast zone-less timestamps to UTC timestamps; a watermark accepts no other type."""
    df.sparkSession.conf.set("spark.sql.session.timeZone", "UTC")
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in zoneless})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return with_event_time(spark.read.parquet(f"{folder}/{name}.parquet"))


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as an unbounded source (written as a pattern: a stream takes no single file)."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return with_event_time(spark.readStream.schema(schema).parquet(f"{folder}/{name}[.]parquet"))


def rating_value(quantity) -> F.Column:
    """Quantity 1..50 banded to a rating 1..5."""
    return F.least(F.lit(5), 1 + F.floor((quantity - 1) / 10)).cast("double")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """(user_id, item_id, rating, digit): one row per purchased line."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("item_id"), rating_value(F.col("l_quantity")).alias("rating")
    )
    buyers = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id")
    )
    return lines.join(buyers, "l_orderkey").select(
        "user_id", "item_id", "rating", (F.col("l_orderkey") % 10).alias("digit")
    )


RATINGS_SQL = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(least(5, 1 + floor((l_quantity - 1) / 10)) AS DOUBLE) AS rating,
         l_orderkey % 10 AS digit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def post_text(events: DataFrame) -> DataFrame:
    """Short posts with two hashtags each, made of the event columns."""
    return events.select(
        "event_id",
        "ts",
        F.format_string(
            "#%s user%s #k%s", "event_type", "user_id", F.get_json_object("props", "$.k")
        ).alias("text"),
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return post_text(table(spark, folder, "events"))


def posts_stream(spark: SparkSession, folder: str) -> DataFrame:
    return post_text(table_stream(spark, folder, "events"))


POSTS_SQL = """posts AS (
  SELECT event_id, ts,
         '#' || event_type || ' user' || user_id || ' #k' || json_extract_string(props, '$.k') AS text
  FROM events)"""


def friend_links(spark: SparkSession, folder: str) -> DataFrame:
    """Part and supplier numbers read as one id space: every line links two ids."""
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")
    )


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """(doc_id, text, columns): spread over the cores, since all work on texts is heavy per row."""
    return spread(table(spark, folder, "documents").select("doc_id", "text", *columns))


def descriptors(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, image_id, label, vec): ten consecutive vectors make one image."""
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.floor(F.col("vec_id") / 10).cast("bigint").alias("image_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )


def recordings(spark: SparkSession, folder: str) -> DataFrame:
    """(rec_id, label, sample_rate, samples): each vector read as 64 samples per second."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("rec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.lit(64.0).alias("sample_rate"),
        F.col("embedding").cast("array<double>").alias("samples"),
    )
