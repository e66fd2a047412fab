import datetime
import random

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.streaming import sinks, windows

SCHEMA = "ts timestamp, text string"


def posts(n=300, seed=4):
    rnd = random.Random(seed)
    start = datetime.datetime(2024, 5, 1, 12)
    return [
        (start + datetime.timedelta(seconds=rnd.random() * 120), f"#{rnd.choice('abc')} x #{rnd.choice('de')}")
        for _ in range(n)
    ]


def in_files(spark, tmp_path, rows, parts=3):
    """One parquet folder per slice of time, so that a stream takes several batches."""
    folder = tmp_path / "in"
    folder.mkdir()
    ordered = sorted(rows)
    size = -(-len(ordered) // parts)
    for i in range(parts):
        spark.createDataFrame(ordered[i * size : (i + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def key(df):
    return sorted(tuple(r) for r in df.collect())


def by_hand(rows, length, slide):
    counts = {}
    for ts, words in rows:
        at = ts.replace(tzinfo=datetime.timezone.utc).timestamp()
        start = int(at // slide) * slide
        for s in range(start - length + slide, start + slide, slide):
            for topic in words.split():
                if topic.startswith("#"):
                    counts[s, s + length, topic] = counts.get((s, s + length, topic), 0) + 1
    return counts


def test_window_counts_by_hand(spark):
    rows = posts()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.createDataFrame([(t.replace(tzinfo=datetime.timezone.utc), w) for t, w in rows], SCHEMA)
    got = windows.window_counts(text.hashtags(df), ["topic"], 30, 2)
    assert {tuple(r)[:3]: r.n for r in got.collect()} == by_hand(rows, 30, 2)


def test_stream_of_several_batches_equals_table(spark, tmp_path):
    folder = in_files(spark, tmp_path, posts())
    table = windows.window_counts(text.hashtags(spark.read.parquet(folder)), ["topic"], 10, 2)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    counts = windows.window_counts(text.hashtags(source), ["topic"], 10, 2)
    out = str(tmp_path / "out")
    sinks.append_batches(counts, out, "several", mode="update", checkpoint=str(tmp_path / "cp"))
    versions = sinks.read_batches(spark, out, counts.schema)
    assert versions.select("batch_id").distinct().count() >= 3
    current = sinks.latest_versions(versions, [*windows.WINDOW, "topic"])
    assert key(current.select(*table.columns)) == key(table)
    assert key(windows.window_messages(current, "topic", 2)) == key(windows.window_messages(table, "topic", 2))


def test_top_per_window_breaks_ties_by_name(spark):
    counts = spark.createDataFrame(
        [(0, 10, "b", 2), (0, 10, "a", 2), (0, 10, "c", 5), (2, 12, "a", 1)],
        "window_start bigint, window_end bigint, topic string, n bigint",
    )
    got = [(r.window_start, r["rank"], r.topic) for r in windows.top_per_window(counts, "topic", 2).collect()]
    assert sorted(got) == [(0, 1, "c"), (0, 2, "a"), (2, 1, "a")]


def test_replayed_batch_replaces_its_own_rows(spark, tmp_path):
    folder = in_files(spark, tmp_path, posts(40), parts=2)
    out = str(tmp_path / "out")
    for attempt in ("first", "second"):  # a lost checkpoint makes the stream start over
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        tags = text.hashtags(source).withColumn("keyword", F.col("topic"))
        sinks.append_batches(tags, out, "replay", by=["keyword"], checkpoint=str(tmp_path / attempt))
    assert sinks.read_batches(spark, out, tags.schema).count() == 80


def test_keyword_filter(spark):
    df = spark.createDataFrame([("Red Shirt",), ("blue",), (None,)], "text string")
    assert df.filter(text.contains_any(F.col("text"), ["shirt", "green"])).count() == 1


def test_a_query_with_an_interval_is_stopped_after_its_time(spark):
    seen = []
    stream = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    query = sinks.run_batches(stream, lambda batch, n: seen.append(n), "timed", interval="1 second", timeout=6)
    assert seen and not query.isActive
