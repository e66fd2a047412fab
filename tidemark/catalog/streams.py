"""Sliding windows over posts, as table queries and as real streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog.registry import query
from tidemark.catalog.text import NB_PREDICT_SQL
from tidemark.functions import text
from tidemark.plans import textmodel
from tidemark.session import shared_path
from tidemark.sources.tables import POSTS_SQL, posts, posts_stream, table, table_stream
from tidemark.streaming import sinks, windows

TOKENS_SQL = POSTS_SQL + ", tokens AS (SELECT ts, unnest(string_split(text, ' ')) AS token FROM posts)"


def counts_sql(source: str, keys: str, length: int, slide: int) -> str:
    """Rows per sliding window: every row is repeated for the windows that hold it."""
    micros = slide * 1_000_000
    return f"""counts AS (SELECT (epoch_us(ts) // {micros} - k) * {slide} AS window_start,
      (epoch_us(ts) // {micros} - k) * {slide} + {length} AS window_end, {keys}, count(*) AS n
      FROM {source}, (SELECT unnest(generate_series(0, {length // slide - 1})) AS k) GROUP BY ALL)"""


def top_sql(length: int, slide: int) -> str:
    return (
        f"WITH {TOKENS_SQL}, tags AS (SELECT ts, token AS topic FROM tokens WHERE token LIKE '#%'), "
        + counts_sql("tags", "topic", length, slide)
        + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, topic) AS rank FROM counts)
        """
    )


TOP = " SELECT window_start, window_end, topic, n, rank FROM ranked WHERE rank <= 10"


def top_hashtags(spark, folder, length, slide):
    tags = text.hashtags(posts(spark, folder).select("ts", "text"))
    return windows.top_per_window(windows.window_counts(tags, ["topic"], length, slide), "topic")


@query("hashtag_top30", top_sql(30, 2) + TOP)
def hashtag_top30(spark, folder):
    return top_hashtags(spark, folder, 30, 2)


@query("hashtag_top10", top_sql(10, 2) + TOP)
def hashtag_top10(spark, folder):
    return top_hashtags(spark, folder, 10, 2)


@query(
    "keyword_window_counts",
    f"WITH {TOKENS_SQL}, hits AS (SELECT * FROM tokens WHERE contains(token, 'k1')), "
    + counts_sql("hits", "token", 10, 2)
    + " SELECT window_start, window_end, token, n FROM counts",
)
def keyword_window_counts(spark, folder):
    listed = text.tokens(posts(spark, folder).select("ts", "text"))
    return windows.window_counts(listed.filter(F.col("token").contains("k1")), ["token"], 10, 2)


ITEMS = ["click", "error", "purchase", "signup", "view"]
BRANDS = ["k1", "k2", "k3", "k4", "k5", "k6", "k7", "k8"]


def mentions(rows):
    """One row per item and brand that a post names, wherever in the post they stand."""
    lowered = F.lower("text")

    def named(names, out):
        return F.explode(F.filter(F.array(*map(F.lit, names)), lambda name: F.contains(lowered, name))).alias(out)

    return rows.select("ts", "text", named(ITEMS, "item")).select("ts", "item", named(BRANDS, "brand"))


def in_sql(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


MENTIONS_SQL = f"""WITH {POSTS_SQL}, mentions AS (SELECT ts, item, brand FROM posts,
  (SELECT unnest({in_sql(ITEMS)}) AS item), (SELECT unnest({in_sql(BRANDS)}) AS brand)
  WHERE contains(lower(text), item) AND contains(lower(text), brand))"""


@query(
    "item_brand_window",
    MENTIONS_SQL + ", " + counts_sql("mentions", "item, brand", 20, 4) + " SELECT window_start, window_end, item, brand, n FROM counts",
)
def item_brand_window(spark, folder):
    return windows.window_counts(mentions(posts(spark, folder)), ["item", "brand"], 20, 4)


# --- real streams -------------------------------------------------------------------


@query(
    "stream_keyword_filter",
    f"WITH {POSTS_SQL} SELECT event_id, epoch_us(ts) AS micros, text FROM posts "
    "WHERE contains(lower(text), 'purchase') OR contains(lower(text), 'k77')",
)
def stream_keyword_filter(spark, folder):
    kept = posts_stream(spark, folder).filter(text.contains_any(F.col("text"), ["purchase", "k77"]))
    rows = kept.select("event_id", F.unix_micros("ts").alias("micros"), "text")
    path = shared_path(spark, "keyword-filter")
    sinks.append_batches(rows, path, "keyword-filter")
    return sinks.read_batches(spark, path, rows.schema).drop("batch_id")


@query(
    "stream_keyword_sink",
    MENTIONS_SQL + " SELECT item AS keyword, brand, epoch_us(ts) AS micros FROM mentions",
)
def stream_keyword_sink(spark, folder):
    """One query and one folder per keyword, for all keywords at once."""
    found = mentions(posts_stream(spark, folder))
    rows = found.select(F.unix_micros("ts").alias("micros"), "brand", F.col("item").alias("keyword"))
    path = shared_path(spark, "keyword-sink")
    sinks.append_batches(rows, path, "keyword-sink", by=["keyword"])
    return sinks.read_batches(spark, path, rows.schema).drop("batch_id")


@query(
    "stream_topk_messages",
    top_sql(10, 2)
    + " SELECT window_start, window_end, rank, topic || ' (' || n || ' tweets)' AS message FROM ranked WHERE rank <= 10",
)
def stream_topk_messages(spark, folder):
    """Counts kept in stream state, their changes appended to a table, the top 10 read from it."""
    tags = text.hashtags(posts_stream(spark, folder).select("ts", "text"))
    counts = windows.window_counts(tags, ["topic"], 10, 2)
    path = shared_path(spark, "window-counts")
    sinks.append_batches(counts, path, "window-counts", mode="update")
    versions = sinks.read_batches(spark, path, counts.schema)
    current = sinks.latest_versions(versions, [*windows.WINDOW, "topic"])
    return windows.window_messages(current, "topic")


@query(
    "stream_closed_top",
    top_sql(10, 2) + TOP + " AND window_end * 1000 <= (SELECT epoch_ms(max(ts)) FROM posts) - 600000",
)
def stream_closed_top(spark, folder):
    """The top 10 of every window that the watermark has closed, written once as it closes."""
    tags = text.hashtags(posts_stream(spark, folder).select("ts", "text"))
    counts = windows.window_counts(tags, ["topic"], 10, 2, lateness="10 minutes")
    path = shared_path(spark, "closed-top")
    sinks.append_closed_top(counts, path, "closed-top", "topic")
    schema = T.StructType([*counts.schema.fields, T.StructField("rank", T.LongType())])
    return sinks.read_batches(spark, path, schema).drop("batch_id")


@query("stream_score_text", NB_PREDICT_SQL)
def stream_score_text(spark, folder):
    """Score documents as they arrive with a model trained beforehand and kept as tables."""
    train = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = textmodel.nb_fit(train, textmodel.token_rows(train, keep=("lang",)), "lang")
    path = shared_path(spark, "scored")
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("label", T.StringType()),
            T.StructField("prediction", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def score(batch, batch_id):
        batch = batch.persist()
        terms = textmodel.term_frequency(batch)
        scores = textmodel.nb_scores(model, terms, batch)
        named = textmodel.nb_predict(scores).join(batch.select("doc_id", F.col("lang").alias("label")), "doc_id")
        named.select([f.name for f in schema]).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        batch.unpersist()

    arriving = table_stream(spark, folder, "documents").select("doc_id", "text", "lang")
    sinks.run_batches(arriving, score, "score-text")
    return sinks.read_batches(spark, path, schema).select(
        "doc_id", "label", "prediction", F.round("score", 3).alias("score")
    )
