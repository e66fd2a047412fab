"""Content-addressed web archive: payload bytes once per digest, record headers apart.

`write_archive` makes two tables: `payloads` (SHA-256, byte count, zstd-packed bytes; one row per
distinct payload) and `headers` (one row per record with its exact WARC/1.1 header bytes).
`read_archive` joins them, unpacks and verifies every payload against its digest and length, and
gives back each original record. Only packed payloads are shuffled, and a payload that very many
records share stays one row until the join, whose skewed side adaptive execution splits.

Defined cases: null payload = empty payload; null URL = no target line; among records of one payload
the largest id is the response (null ids only when there is no other), and records with equal id and
payload are all responses of the one stored copy; an empty table gives empty tables. Input columns
are taken by name, others are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_path

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # of base32, for the SQL
DATE = "2024-01-01T00:00:00Z"


class DigestMismatch(ValueError):
    """A stored payload does not match its digest or length."""


def base32(body: bytes) -> str:
    return base64.b32encode(hashlib.sha1(body).digest()).decode()


def describe(batches):
    for batch in batches:
        bodies = [b or b"" for b in batch.column("body").to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {
                "record_id": batch.column("record_id"),
                "uri": batch.column("uri"),
                "digest": pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary()),
                "n_bytes": pa.array(map(len, bodies), pa.int64()),
                "sha1": pa.array(map(base32, bodies), pa.string()),
            }
        )


def header_bytes(revisit: Column) -> Column:
    """The exact header block of a record as it stands in the archive."""
    name = lambda c: F.concat(F.lit("<urn:record:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value)
    return F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("record_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, line("WARC-Refers-To", name(F.col("owner")))),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
        F.lit("\r\n"),
    ).cast("binary")


def pack(batches):
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        bodies = [b or b"" for b in batch.column("body").to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {
                "record_id": batch.column("record_id"),
                "digest": pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary()),
                "packed": pa.array([packer.compress(b) for b in bodies], pa.binary()),
            }
        )


def write_archive(
    pages: DataFrame, path: str, key="page_id", url="url", payload="html", min_dedupe_bytes: int = 0
) -> None:
    """Write `path`/payloads and `path`/headers.

    Records whose payload is smaller than `min_dedupe_bytes` are all responses; their bytes
    are still stored once.
    """
    spark = pages.sparkSession
    records = pages.select(
        F.col(key).cast("long").alias("record_id"),
        F.regexp_replace(F.col(url).cast("string"), "[\r\n]", "%0A").alias("uri"),
        F.col(payload).cast("binary").alias("body"),
    )
    records.mapInArrow(describe, "record_id long, uri string, digest binary, n_bytes long, sha1 string").write.parquet(
        f"{path}/facts"
    )
    known = spark.read.parquet(f"{path}/facts")  # narrow; read twice below
    owners_path = f"{path}/owners"
    known.groupBy("digest").agg(F.max("record_id").alias("owner")).write.parquet(owners_path)
    owners = spark.read.parquet(owners_path)
    revisit = (F.col("n_bytes") >= min_dedupe_bytes) & ~F.col("record_id").eqNullSafe(F.col("owner"))
    known.join(owners, "digest").select(
        "record_id", "digest", header_bytes(revisit).alias("header")
    ).write.parquet(f"{path}/headers")
    packed = records.select("record_id", "body").mapInArrow(pack, "record_id long, digest binary, packed binary")
    held = owners.select(F.col("digest").alias("own_digest"), "owner")
    (
        packed.join(held, F.col("record_id").eqNullSafe(F.col("owner")) & (F.col("digest") == F.col("own_digest")), "semi")
        .dropDuplicates(["record_id", "digest"])  # the same record twice; already dealt by these two
        .select("digest", "packed")
        .write.option("compression", "none")
        .parquet(f"{path}/payloads")
    )


def unpack(batches):
    import zstandard

    opener = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        packed, digests = batch.column("packed").to_pylist(), batch.column("digest").to_pylist()
        for header, digest, body in zip(batch.column("header").to_pylist(), digests, packed, strict=True):
            payload = opener.decompress(body)
            if hashlib.sha256(payload).digest() != digest:
                raise DigestMismatch(digest.hex())
            fields = dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:-2])
            if fields["WARC-Type"] == "response" and int(fields["Content-Length"]) != len(payload):
                raise DigestMismatch(digest.hex())
            out.append((fields, payload, header))
        ids = [_number(f["WARC-Record-ID"]) for f, _, _ in out]
        yield pa.RecordBatch.from_pydict(
            {
                "page_id": pa.array(ids, pa.int64()),
                "url": pa.array([f.get("WARC-Target-URI") for f, _, _ in out], pa.string()),
                "record_type": pa.array([f["WARC-Type"] for f, _, _ in out], pa.string()),
                "refers_to": pa.array([_number(f.get("WARC-Refers-To")) for f, _, _ in out], pa.int64()),
                "stated_digest": pa.array([f["WARC-Payload-Digest"][5:] for f, _, _ in out], pa.string()),
                "header": pa.array([h for _, _, h in out], pa.binary()),
                "payload": pa.array([p for _, p, _ in out], pa.binary()),
            }
        )


def _number(name: str | None) -> int | None:
    text = name[len("<urn:record:") : -1] if name else "none"
    return None if text == "none" else int(text)


RECORD = (
    "page_id long, url string, record_type string, refers_to long, stated_digest string, header binary, payload binary"
)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record with its header and its whole payload (a revisit's is the one it refers to)."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    return headers.join(payloads, "digest").select("digest", "header", "packed").mapInArrow(unpack, RECORD)


def page_digests(records: DataFrame) -> DataFrame:
    """Per record: byte count and base32 SHA-1 of the payload read back, checked against its header."""

    def run(batches):
        for batch in batches:
            payloads = batch.column("payload").to_pylist()
            sums = list(map(base32, payloads))
            if sums != batch.column("stated_digest").to_pylist():
                raise DigestMismatch("a header states another digest")
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column("page_id"),
                    "payload_bytes": pa.array(map(len, payloads), pa.int64()),
                    "payload_digest": pa.array(sums, pa.string()),
                    "record_type": batch.column("record_type"),
                    "refers_to": batch.column("refers_to"),
                }
            )

    return records.mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write the pages to a fresh archive in the shared folder and read them back."""
    path = shared_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return page_digests(read_archive(pages.sparkSession, path))


LETTERS = " || ".join(
    f"substr('{ALPHABET}', 1 + ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31)::INT, 1)"
    for g in range(8)
    for s in (15, 10, 5, 0)
)

SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS h,
             max(page_id) OVER (PARTITION BY body) AS owner FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {LETTERS} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM owner THEN owner END AS refers_to
FROM q
"""
