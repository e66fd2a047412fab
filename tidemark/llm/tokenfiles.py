"""Token ids as flat unsigned integer files with 64-bit document offsets.

Documents are dealt by ranges of their id, sorted, encoded and written by the task that holds them:
`part-N.bin` (16-bit ids where the vocabulary fits, else 32-bit), `part-N.idx` (64-bit offsets of the
documents inside the part) and `part-N.doc` (64-bit document ids). A task writes under a name of its
own and renames at the end, so a lost or repeated attempt leaves the same files. The token count of
every part, one row each, gives the parts' bases by prefix sums. Readers map the files into memory.

Encoding is the library's, word by word: none of the tokenizer's pieces holds white space, and
normalisation does not reach over it, so the ids of a text are those of its words in turn. Words seen
before come from a bounded table.

Defined cases: null text = empty text = only the end id; null ids come first; rows with equal ids
follow each other in the order of their texts; an empty table writes no part and reads as no rows.
"""

from __future__ import annotations

import re
import uuid
import zlib
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (
    ASCII_SPACE,
    PLAIN_WORD,
    Recent,
    array_slices,
    binaries,
    byte_letters,
    gathered,
    text_bytes,
    worker_state,
)
from tidemark.session import shared_path

CACHE_WORDS = 400_000  # in one generation; long words count as several
TEXT_BYTES = 2 << 20  # of texts handled at once

#: Letters that normalisation only lowers, and marks that make one piece of their own.
LETTERS_AND_MARKS = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)")


def word_weight(word: bytes) -> int:
    return 1 + len(word) // 100


def cut_words(letters: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts without the white space between them, their bounds, and the number of words before each of the texts' bounds.

    The tokenizer lowers case itself, after composing letters; only the spelling of its special
    strings matters, and that of words with other characters, which may compose in one case only.
    So the words of plain ASCII are lowered, but in texts with "<|".
    """
    inside = ~ASCII_SPACE[letters]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    begins = bounds[bounds < len(letters)]
    start[begins] = inside[begins]
    first = np.searchsorted(np.flatnonzero(start), bounds)
    words = letters[inside]
    places = np.append(np.flatnonzero(start[inside]), len(words))
    kept = np.zeros(len(places), bool)
    kept[np.searchsorted(places, np.flatnonzero(words >= 0x80), "right") - 1] = True
    special = np.flatnonzero((letters[:-1] == ord("<")) & (letters[1:] == ord("|")))
    for text in np.unique(np.searchsorted(bounds, special[~np.isin(special + 1, bounds)], "right") - 1):
        kept[first[text] : first[text + 1]] = True
    capitals = np.flatnonzero(words - np.uint8(ord("A")) < 26)
    words[capitals[~kept[np.searchsorted(places, capitals, "right") - 1]]] |= 0x20
    return words, places, first


class WordEncoder:
    """Ids of words as packed bytes; library calls only for words not in the bounded table."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.recent = Recent(CACHE_WORDS, word_weight)
        self.spelled = byte_letters("".join(filter(PLAIN_WORD.fullmatch, map(chr, range(256)))))

    def learn(self, missing: list[bytes]) -> None:
        known, model, spelled = self.recent.known, self.tokenizer.model, self.spelled
        bases, rest, joined = set(), set(), []
        for word in missing:
            found = LETTERS_AND_MARKS.fullmatch(word.decode())
            if found is None:
                rest.add(word)
                continue
            base, marks = found.group(1).lower().encode(), found.group(2).encode()
            bases.add(base)  # lower-case letters: normalised, and one piece
            if marks:
                rest.add(marks)
            if marks or base != word:
                joined.append((word, base, marks))
        bases, rest = self.recent.missing(bases), self.recent.missing(rest)
        ids = [[t.id for t in model.tokenize(w.decode().translate(spelled))] for w in bases]
        ids += [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)]
        packed = np.fromiter(chain.from_iterable(ids), self.dtype).tobytes()
        ends = (np.cumsum([0, *map(len, ids)]) * self.dtype.itemsize).tolist()
        known.update((w, packed[a:b]) for w, (a, b) in zip(bases + rest, pairwise(ends), strict=True))
        known.update((w, known[base] + known[marks] if marks else known[base]) for w, base, marks in joined)

    def encode_array(self, texts: pa.Array) -> tuple[bytes, np.ndarray]:
        """Packed ids of all texts, and the bounds between the texts, in ids."""
        words, places, first = cut_words(*text_bytes(texts))
        parts = binaries(words, places).dictionary_encode()
        here = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.recent.known.get, here))
        self.learn(self.recent.missing({w for w, ids in zip(here, found, strict=True) if ids is None}))
        known = self.recent.known
        found = [known[w] if ids is None else ids for w, ids in zip(here, found, strict=True)]
        packed, ends = gathered(pa.array(found, pa.large_binary()), parts.indices)
        self.recent.trim(here)
        return packed, ends[first] // self.dtype.itemsize

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        packed, bounds = self.encode_array(pa.array(texts, pa.large_string()))
        return [packed[a:b] for a, b in pairwise((bounds * self.dtype.itemsize).tolist())]


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> list[dict]:
    """Write the files below `path`; the parts in order, each with its base, docs and tokens."""

    def run(batches):
        encoder = worker_state("words:" + tokenizer, lambda: WordEncoder(tokenizer))
        part = TaskContext.get().partitionId()
        files, root = _filesystem(path)
        files.create_dir(root)
        own = f"{root}/.{part}-{uuid.uuid4().hex}"
        sinks, offset, nulls, n_docs = None, 0, 0, 0
        for batch, texts in array_slices(batches, size=TEXT_BYTES):
            if sinks is None:
                sinks = {kind: files.open_output_stream(f"{own}.{kind}") for kind in ("bin", "idx", "doc")}
                sinks["idx"].write(np.zeros(1, "<u8").tobytes())
            packed, bounds = encoder.encode_array(texts)
            tokens = np.insert(np.frombuffer(packed, encoder.dtype), bounds[1:], end_id)  # after each document
            sinks["bin"].write(tokens.tobytes())
            sinks["idx"].write((bounds[1:] + np.arange(1, len(bounds)) + offset).astype("<u8").tobytes())
            ids = batch.column("doc_id")
            sinks["doc"].write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            offset, nulls, n_docs = offset + len(tokens), nulls + ids.null_count, n_docs + len(texts)
        if sinks is None:
            return
        for kind, sink in sinks.items():
            sink.close()
            files.move(f"{own}.{kind}", f"{root}/part-{part:06d}.{kind}")
        row = {"part": part, "n_docs": n_docs, "n_tokens": offset, "n_nulls": nulls, "width": encoder.dtype.itemsize}
        yield pa.RecordBatch.from_pylist([row], pa.schema([(k, pa.int64()) for k in row]))

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
    )
    rows = ordered.mapInArrow(run, "part long, n_docs long, n_tokens long, n_nulls long, width long").collect()
    parts, base = [], 0
    for row in sorted(rows, key=lambda r: r["part"]):  # one row per partition
        parts.append({**row.asDict(), "base": base})
        base += row["n_tokens"]
    return parts


def _mapped(path: str, dtype: str) -> np.ndarray:
    """The file as an array: mapped into memory where it is local, read otherwise."""
    files, name = _filesystem(path)
    if files.type_name == "local":
        return np.memmap(name, dtype, "r") if files.get_file_info(name).size else np.empty(0, dtype)
    with files.open_input_file(name) as source:
        return np.frombuffer(source.read(), dtype)


def read_token_files(spark: SparkSession, path: str, parts: list[dict]) -> DataFrame:
    """Per document: id, start in the whole sequence, number of ids and their CRC-32 as 32-bit ids."""
    n = max(1, len(parts))

    def run(batches):
        for batch in batches:
            for k in batch.column("id").to_pylist():
                if k < len(parts):
                    yield from documents(parts[k])

    def documents(part):
        name = f"{path}/part-{part['part']:06d}"
        ids = _mapped(name + ".bin", f"<u{part['width']}")
        offsets, docs = _mapped(name + ".idx", "<u8"), _mapped(name + ".doc", "<i8")
        for at in range(0, len(docs), 4096):
            some = offsets[at : at + 4097].astype(np.int64)
            sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(some[:-1], some[1:], strict=True)]
            null = np.arange(at, at + len(some) - 1) < part["n_nulls"]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(docs[at : at + 4096].astype(np.int64), mask=null),
                    "start": pa.array(some[:-1] + part["base"]),
                    "n_tokens": pa.array(np.diff(some)),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )

    return spark.range(0, n, 1, n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the documents' ids to fresh files in the shared folder and read them back."""
    path = shared_path(docs.sparkSession, "tokens")
    return read_token_files(docs.sparkSession, path, write_token_files(docs, path, tokenizer, end_id))
