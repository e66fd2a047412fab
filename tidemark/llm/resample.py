"""Importance resampling toward a target distribution: array-scored weights, distributed quickselect.

Weights. Features are all runs of one to three consecutive words; a feature's bucket is the CRC-32 of its
bytes modulo the number of buckets. The buckets of the source and of the target texts are counted in
dense arrays, one per task, that are summed to one array each; the gains of all buckets are again one
array of fixed size, and a document's weight is the sum of the gains its features look up. The CRC of a
run is put together from those of its words (a CRC is linear over GF(2)), so no run is ever spelled out.

Draw. Every document gets a Gumbel draw from a hash of its id; the k highest scores are a weighted sample
without replacement. The k-th composite key (score descending, doc_id, n_features, row) is found by
quickselect over the table: random pivot keys from the range still open, then one count of all rows
that come before, at or after each pivot, which leaves the one range between two pivots that
holds the k-th key. Rounds grow with the logarithm of the table. Only the rows up to that key, the
winners, are sorted and ranked, by ranges of the key.

Defined cases: a text without words (null, empty) has no features and weight 0; a row with a null id has a
null score and takes no part in the draw; rows that share an id are drawn one by one (ties go to fewer
features, then to any); without documents of at least `min_words` words nothing is drawn; an
empty target makes all target counts 0; an empty table gives an empty table; further columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices
from tidemark.operators.ordered import running_rank
from tidemark.session import via_table

BUCKETS = 10_000
LONGEST = 3
SEED = 42
MIN_WORDS = 20
PERCENT = 5
PIVOTS = 24
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8
CACHE_BYTES = 16 << 20
STEP = 64  # bytes a CRC is moved on at once
KEY = ["_down", "doc_id", "n_features", "_row"]


def shift_tables() -> np.ndarray:
    """[length, byte place, byte value]: the CRC-32 operator for `length` further zero bytes."""
    byte = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
    step = byte ^ byte[0]  # the linear part
    tables = np.empty((STEP + 1, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32)[None] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(STEP):
        tables[n + 1] = step[tables[n] & 0xFF] ^ (tables[n] >> 8)
    return tables


def shifted(crc: np.ndarray, length: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The share of `crc` in the CRC of a string that goes on for `length` bytes."""
    out, left = crc, length
    while len(left) and left.max() > 0:
        n = np.minimum(left, STEP)
        out = reduce(np.bitwise_xor, (tables[n, k, (out >> np.uint32(8 * k)) & 0xFF] for k in range(4)))
        left = left - n
    return out


class Words:
    """CRC and length of words seen; forgets all of them beyond a number of bytes."""

    def __init__(self):
        self.known, self.size = {}, 0

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        missing = set(words).difference(self.known)
        self.known.update((w, zlib.crc32(w) | len(w) << 32) for w in missing)
        self.size += sum(len(w) + 150 for w in missing)
        both = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        if self.size > CACHE_BYTES:
            self.known, self.size = {}, 0
        return (both & np.uint64(0xFFFFFFFF)).astype(np.uint32), (both >> np.uint64(32)).astype(np.int64)


def feature_buckets(texts: list, cache: Words, tables: np.ndarray, buckets: int):
    """(words per text, text of each feature, bucket of each feature)."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        found = WORD.findall((t or "").encode().lower())
        counts[k] = len(found)
        words += found
    crc, length = cache.of(words)
    owner = np.repeat(np.arange(len(texts)), counts)
    space = np.uint32(zlib.crc32(b" "))
    owners, places, run = [owner], [crc % buckets], crc
    for n in range(2, LONGEST + 1):
        end = slice(n - 1, None)
        spaced = shifted(run[:-1], np.ones(max(len(run) - 1, 0), np.int64), tables) ^ space
        run = shifted(spaced, length[end], tables) ^ crc[end]
        inside = owner[end] == owner[: len(run)]
        owners.append(owner[end][inside])
        places.append(run[inside] % buckets)
    return counts, np.concatenate(owners), np.concatenate(places)


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket; one dense array per task, summed by bucket."""

    def run(batches):
        cache, tables, total = Words(), shift_tables(), np.zeros(buckets, np.int64)
        for _, some in text_slices(batches):
            total += np.bincount(feature_buckets(some, cache, tables, buckets)[2], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[at])})

    rows = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target, with one count added to every bucket."""
    all_source, all_target, n = float(source.sum()), float(target.sum()), len(source)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (all_source + n) / ((s + 1.0) * (all_target + n))))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""

    def run(batches):
        cache, tables = Words(), shift_tables()
        for batch, texts in text_slices(batches):
            counts, owner, place = feature_buckets(texts, cache, tables, len(gain))
            n = len(texts)
            # Sums of whole numbers in doubles are exact below 2 ** 53.
            weight = np.bincount(owner, gain[place].astype(float), n).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "n_words": pa.array(counts),
                    "n_features": pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                    "weight": pa.array(weight),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int) -> Column:
    """floor(1000 x a Gumbel draw) from a hash of the seed and the id."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def key_of(row) -> Column:
    return F.struct(*[F.lit(row[c]).cast("long").alias(c) for c in KEY])


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS, seed: int = 0):
    """The k-th row (from 1) of `rows` in the order of KEY, which is unique; None if there are fewer.

    Every round draws `pivots` random keys from the range still open and counts, over all rows of that
    range, how many come before each of them; only these counts and the pivots reach the driver.
    """
    at = F.struct(*KEY)
    low, high, before = None, None, 0  # the k-th key lies strictly between; `before` rows are up to and with `low`
    while k > 0:
        open_ = rows
        if low is not None:
            open_ = open_.where(at > key_of(low))
        if high is not None:
            open_ = open_.where(at < key_of(high))
        seed += 1
        drawn = open_.select(*KEY).orderBy(F.xxhash64("_row", F.lit(seed)), "_row").limit(pivots).collect()
        if not drawn:
            break
        drawn.sort(key=lambda r: tuple(r[c] for c in KEY))
        less = open_.agg(*[F.count_if(at < key_of(r)).alias(f"less{j}") for j, r in enumerate(drawn)]).first()
        for r, place in zip(drawn, [before + n + 1 for n in less], strict=True):  # one row equals a pivot: itself
            if place == k:
                return r
            if place > k:
                high = r
                break
            low, before = r, place
    return None


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of `docs`; the rank is null for undrawn ones."""
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = weighted(docs, gain).withColumn("score", F.col("weight") + gumbel(seed))
    able = F.col("score").isNotNull() & (F.col("n_words") >= min_words)
    rows = via_table(
        scored.withColumns(
            {"_down": F.when(able, -F.col("score")), "_row": F.monotonically_increasing_id()}
        ).drop("n_words"),
        "scored",
    )
    able_rows = rows.where(F.col("_down").isNotNull())
    last = kth_key(able_rows, percent * able_rows.count() // 100) if percent else None
    out = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    drawn = F.col("_down").isNotNull() & (F.struct(*KEY) <= key_of(last))
    winners = running_rank(rows.where(drawn), [], KEY, "rank").select(*out, F.col("rank").cast("long").alias("rank"))
    return winners.unionAll(rows.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank")))


SQL = r"""WITH RECURSIVE
texts AS (
  SELECT doc_id, lower_az AS text, 0 AS target FROM (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)
  UNION ALL
  SELECT NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 1 FROM benchmark),
words AS (
  SELECT doc_id, target, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
starts AS (
  SELECT doc_id, target, w, unnest(range(1, len(w) + 1)) AS i FROM words),
runs AS (
  SELECT doc_id, target, array_to_string(w[i:i + n - 1], ' ') AS f
  FROM starts, (SELECT unnest([1, 2, 3]) AS n) WHERE i + n - 1 <= len(w)),
features AS (
  SELECT f, row_number() OVER () AS id, hex(f) AS code, octet_length(encode(f)) AS size FROM (SELECT DISTINCT f FROM runs)),
steps AS (
  SELECT 0 AS n, b AS seed, CASE WHEN b = 256 THEN 4294967295 ELSE b END AS x FROM (SELECT unnest(range(0, 257)) AS b)
  UNION ALL
  SELECT n + 1, seed, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END FROM steps
  WHERE n < 8 * (SELECT max(size) FROM features)),
bytes AS (
  SELECT id, size - i AS gone, CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT) AS b
  FROM (SELECT id, size, code, unnest(range(0, size)) AS i FROM features)),
parts AS (
  SELECT id, bit_xor(s.x) AS x FROM bytes JOIN steps s ON s.n = 8 * gone AND s.seed = b GROUP BY id),
buckets AS (
  SELECT f.f, xor(xor(p.x, s.x), 4294967295) % 10000 AS bucket
  FROM features f JOIN parts p USING (id) JOIN steps s ON s.n = 8 * f.size AND s.seed = 256),
sizes AS (
  SELECT bucket, count(*) FILTER (target = 0) AS s, count(*) FILTER (target = 1) AS t FROM runs JOIN buckets USING (f) GROUP BY 1),
totals AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM sizes),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((sizes.t + 1)::DOUBLE * (totals.s + 10000)::DOUBLE / ((sizes.s + 1)::DOUBLE * (totals.t + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM sizes, totals),
weights AS (
  SELECT doc_id, sum(gain) AS weight, count(*) AS n FROM runs JOIN buckets USING (f) JOIN gains USING (bucket) WHERE target = 0 GROUP BY 1),
scored AS (
  SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words d LEFT JOIN weights USING (doc_id) WHERE target = 0),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored s LEFT JOIN ranked USING (doc_id)"""
