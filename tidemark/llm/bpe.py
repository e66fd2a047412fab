"""Byte-level BPE by ranks, encoded and decoded by DuckDB queries inside each partition.

The merge table has a row for every pair of tokens whose joined bytes are a token. A recursive query
holds the token rows of each word; one round joins all neighbouring pairs of positions with the
merge table, takes each word's pair of lowest rank (the leftmost among equals) and contracts it;
words without a pair leave the recursion. Decoding joins id rows with the vocabulary and aggregates
their bytes in order of position. Every task works on slices of its own partition, with a DuckDB
of one thread and bounded memory; ids of units seen before come from a bounded table.

The recursion runs once per merge, so its time grows with the square of a single word's bytes.

Defined cases: null or empty text has no ids (the digests are those of the empty string); an empty
table gives an empty table; rows are encoded one by one whatever their ids.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Recent, array_slices, binaries, gathered, text_bytes, unit_bounds, worker_state

CACHE_BYTES = 80 << 20  # of known units in one generation
WORD_BYTES = 1 << 19  # of words merged by one query
IDS_AT_ONCE = 1 << 20  # of decimals made, and ids decoded, at once
TEXT_BYTES = 2 << 20  # of texts handled at once
WHITE = "\t\n\v\f\r "

ENCODE = """
WITH RECURSIVE state(word, ids, done) AS (
    SELECT word, ids, false FROM words
    UNION ALL
    SELECT word, CASE WHEN best IS NULL THEN ids
                 ELSE ids[:(best % 65536) - 1] || [(best // 65536)::INT] || ids[(best % 65536) + 2:] END, best IS NULL
    FROM state LEFT JOIN (
        SELECT word, min(merged::BIGINT * 65536 + spot) AS best
        FROM (SELECT word, generate_subscripts(ids, 1) AS spot, unnest(ids)::BIGINT * 4194304 + unnest(ids[2:]) AS pair
              FROM state WHERE len(ids) > 1 AND NOT done) JOIN merges USING (pair)
        GROUP BY word) USING (word)
    WHERE NOT done
)
SELECT ids FROM state WHERE done ORDER BY word
"""
ENCODE_LONG = ENCODE.replace("65536", "4294967296")  # positions of words over 65,535 bytes

DECODE = """
SELECT string_agg(letters, '') AS letters, list(spot) AS spots, doc
FROM (SELECT doc, spot, letters FROM ids JOIN vocabulary USING (id) ORDER BY spot) GROUP BY doc ORDER BY doc
"""
DECODE_SORTING = """
SELECT string_agg(letters, '' ORDER BY spot) AS letters, doc FROM ids JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def unit_bytes(unit: str) -> int:
    """About what a known unit and its ids take in memory."""
    return 230 + 5 * len(unit)


class Decimals:
    """Ids as decimals joined by spaces, for many ids at once."""

    def __init__(self, n_ids: int):
        self.digits = pa.array([b"%d " % i for i in range(n_ids)], pa.large_binary())

    def letters(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids, a space after each, and the bounds between them."""
        return gathered(self.digits, pa.array(ids))

    def digest(self, ids: np.ndarray) -> str:
        """The SHA-256 of one sequence's decimals, a piece of it at a time."""
        sha = hashlib.sha256()
        for at in range(0, len(ids), IDS_AT_ONCE):
            letters = self.letters(ids[at : at + IDS_AT_ONCE])[0]
            sha.update(letters if at + IDS_AT_ONCE < len(ids) else letters[:-1])
        return sha.hexdigest()

    def digests(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The SHA-256 of every sequence's decimals; the sequences lie between neighbouring bounds."""
        if len(ids) > IDS_AT_ONCE:
            return [self.digest(ids[a:b]) for a, b in pairwise(bounds.tolist())]
        letters, places = self.letters(ids)
        return [hashlib.sha256(letters[a : max(a, b - 1)]).hexdigest() for a, b in pairwise(places[bounds].tolist())]


class DuckBpe:
    """Encoder and decoder for one rank file and splitting pattern."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        ranks = load_ranks(path)
        self.pattern = regex.compile(pattern)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        pairs, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 22 | right)
                    merged.append(rank)
        self._store("merges", pair=pa.array(pairs, pa.int64()), merged=pa.array(merged, pa.int32()))
        self._store(
            "vocabulary",
            id=pa.array(ranks.values(), pa.int32()),
            letters=pa.array([t.decode("latin-1") for t in ranks], pa.string()),  # one letter per byte
        )
        self.recent = Recent(CACHE_BYTES, unit_bytes)  # unit to packed ids
        self.decimals = Decimals(max(ranks.values()) + 1)

    def close(self) -> None:
        self.db.close()

    def _store(self, name: str, **columns) -> None:
        self._view("incoming", **columns)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _view(self, name: str, **columns) -> None:
        self.db.register(name, pa.table(columns))

    def encode_packed(self, words: list[bytes]) -> list[bytes]:
        """Ids of each non-empty word, merged on its own, as packed 32-bit integers."""
        out = []
        ends = np.cumsum(list(map(len, words)), dtype=np.int64)
        cuts = (np.flatnonzero(np.diff(ends // WORD_BYTES)) + 1).tolist()
        for start, end in pairwise([0, *cuts, len(words)] if words else []):
            some = words[start:end]
            sizes = np.array(list(map(len, some)), np.int64)
            flat = self.single[np.frombuffer(b"".join(some), np.uint8)]
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            self._view(
                "words",
                word=pa.array(np.arange(len(some), dtype=np.int32)),
                ids=pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            )
            query = ENCODE if sizes.max() < 65536 else ENCODE_LONG
            ids = self.db.sql(query).to_arrow_table()["ids"].combine_chunks()
            bounds = (4 * np.append(0, np.cumsum(pa.compute.list_value_length(ids).to_numpy()))).tolist()
            letters = ids.flatten().to_numpy().astype("<i4").tobytes()
            out += [letters[a:b] for a, b in pairwise(bounds)]
        return out

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        return [np.frombuffer(p, "<i4").tolist() for p in self.encode_packed(words)]

    def pieces(self, parts: list[str]) -> tuple[list[str], list[str], np.ndarray]:
        """The units in another order, the pattern's matches in all of them, and the bounds of each unit's matches.

        Units that begin with white space and end without are searched as one text, which `units` may cut again.
        """
        joined, alone = [], []
        for u in parts:
            (joined if u[0] in WHITE and not u[-1].isspace() else alone).append(u)
        found = self.pattern.findall("".join(joined))
        ends, stops = (np.cumsum(list(map(len, x)), dtype=np.int64) for x in (joined, found))
        counts = np.searchsorted(stops, ends, "right")
        if not np.array_equal(np.append(0, stops)[counts], ends):  # a match over an end, or letters without a match
            joined, alone, found, counts = [], parts, [], counts[:0]
        single = list(map(self.pattern.findall, alone))
        bounds = np.concatenate([[0], counts, len(found) + np.cumsum(list(map(len, single)), dtype=np.int64)])
        return joined + alone, found + list(chain.from_iterable(single)), bounds

    def _learn(self, missing: list[str]) -> None:
        known = self.recent.known
        parts, pieces, bounds = self.pieces(missing)
        words = self.recent.missing(set(pieces))
        known.update(zip(words, self.encode_packed([w.encode() for w in words]), strict=True))
        packed = list(map(known.__getitem__, pieces))
        known.update((u, b"".join(packed[a:b])) for u, (a, b) in zip(parts, pairwise(bounds.tolist()), strict=True) if b - a > 1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the bounds between the texts."""
        letters, bounds = text_bytes(texts)
        places, first = unit_bounds(letters, bounds)
        parts = binaries(letters, places).dictionary_encode()
        here = parts.dictionary.cast(pa.large_string()).to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.recent.known.get, here))
        self._learn(self.recent.missing({u for u, ids in zip(here, found, strict=True) if ids is None}))
        known = self.recent.known
        found = [known[u] if ids is None else ids for u, ids in zip(here, found, strict=True)]
        packed, ends = gathered(pa.array(found, pa.large_binary()), parts.indices)
        self.recent.trim(here)
        return np.frombuffer(packed, "<i4"), ends[first] // 4

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """The bytes of each id sequence."""
        sizes = [len(p) // 4 for p in packed]
        return self.decode_ids(np.frombuffer(b"".join(packed), "<i4"), np.append(0, np.cumsum(sizes, dtype=np.int64)))

    def decode_ids(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of the id sequences between neighbouring bounds."""
        docs = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
        out = [[] for _ in range(len(bounds) - 1)]
        for at in range(0, len(ids), IDS_AT_ONCE):
            some = ids[at : at + IDS_AT_ONCE]
            spots = np.arange(len(some), dtype=np.int32)
            self._view("ids", doc=pa.array(docs[at : at + IDS_AT_ONCE]), spot=pa.array(spots), id=pa.array(some))
            found = self.db.sql(DECODE).to_arrow_table()
            if not np.array_equal(found["spots"].combine_chunks().flatten().to_numpy(), spots):
                found = self.db.sql(DECODE_SORTING).to_arrow_table()  # the engine took the sorted rows in another order
            for doc, text in zip(found["doc"].to_pylist(), found["letters"].to_pylist(), strict=True):
                out[doc].append(text.encode("latin-1"))
        return list(map(b"".join, out))


def bpe(docs: DataFrame, ranks: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Per row: count and digest of the ids, digest of the decoded bytes, and the ids if asked for."""

    def run(batches):
        coder = worker_state("bpe:" + ranks, lambda: DuckBpe(ranks, pattern))
        for batch, texts in array_slices(batches, size=TEXT_BYTES):
            ids, bounds = coder.encode(texts)
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(np.diff(bounds)),
                "ids_sha256": pa.array(coder.decimals.digests(ids, bounds)),
                "decoded_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in coder.decode_ids(ids, bounds)]),
            }
            if keep_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))
