"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import types
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import bounded_batches

SLICE_BYTES = 1 << 20  # text handled at once inside a task, besides a single longer text
BITMAP_BITS = 1 << 24  # a fixed 2 MB, whatever the input
U64 = np.uint64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def compact(df: DataFrame, rows: int, per_file: int = 200_000, waves: int = 1) -> DataFrame:
    """Fewer partitions before a table of about `rows` rows is written, so that it is few files.

    At least `waves` tasks per core stay.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(waves * cores, -(-rows // per_file)))


def id_remainder(column: str | Column, divisor: int) -> Column:
    """crc32 of the id's decimal text modulo `divisor`; null for a null id."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary")) % divisor


def is_remainder(column: str | Column, divisor: int, remainder: int) -> Column:
    return F.coalesce(id_remainder(column, divisor) == remainder, F.lit(False))


def is_training(column: str | Column, divisor: int, remainder: int) -> Column:
    """Rows that may be learned from; a null id is neither held out nor learned from."""
    return F.coalesce(id_remainder(column, divisor) != remainder, F.lit(False))


def worker_state(name: str, make: Callable):
    """A value kept by the Python worker between tasks (task functions travel by value, so
    module globals do not outlive a task).

    A worker keeps one value: another name, or a task that cuts texts without asking for one, drops it.
    """
    home = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker"))
    if getattr(home, "name", None) != name:
        drop_state(home)
        home.name, home.value = name, make()
    home.task = task_number()
    return home.value


def task_number() -> int | None:
    task = TaskContext.get()
    return task and task.taskAttemptId()


def drop_state(home=None) -> None:
    """Forget the kept value unless this task has asked for it; a value may have something to close."""
    home = home or sys.modules.get("_tidemark_worker")
    if home is None or getattr(home, "name", None) is None:
        return
    getattr(home.value, "close", lambda: None)()
    home.name = home.value = None


def drop_others_state() -> None:
    home = sys.modules.get("_tidemark_worker")
    if home is not None and getattr(home, "name", None) is not None and home.task != task_number():
        drop_state(home)


class Recent:
    """Values by key in two generations: once its keys weigh more than `limit`, the younger one becomes the older one.

    `known` holds every key asked for last; keys of twice `limit` and one slice's stay in memory. A key weighs 1, or
    what `weight` says of it, such as the bytes that it and its value take.
    """

    def __init__(self, limit: int, weight: Callable | None = None):
        self.limit, self.known, self.old = limit, {}, {}
        self.weight, self.weighed, self.size = weight, 0, 0

    def missing(self, keys: set) -> list:
        """Keys without a value; those of the older generation come back into the younger one."""
        known, old = self.known, self.old
        fresh = keys.difference(known)
        known.update((k, old[k]) for k in fresh if k in old)
        return [k for k in fresh if k not in known]

    def trim(self, keys: set) -> None:
        """Call after a slice with its keys."""
        new = len(self.known) - self.weighed  # the latest entries of the table
        self.size += new if self.weight is None else sum(map(self.weight, islice(reversed(self.known), new)))
        self.weighed += new
        if self.size > self.limit:
            self.old, self.known = self.known, {k: self.known[k] for k in keys}
            self.weighed = self.size = 0


def release_memory() -> None:
    """Give back to the system what earlier tasks of this Python worker have freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # of the GNU C library
        trim(0)


def array_slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES):
    """(slice of the batch, its texts as an Arrow array) pieces of about `size` bytes."""
    drop_others_state()
    release_memory()
    for batch in batches:
        texts = batch.column(column)
        if not len(texts):
            continue
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
        piece = (np.cumsum(lengths) - lengths) // size
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(texts)], strict=True):
            yield batch.slice(start, end - start), texts.slice(start, end - start)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES):
    """(slice of the batch, its texts) pieces of about `size` bytes; a null text comes as None."""
    for batch, texts in array_slices(batches, column, size):
        yield batch, texts.to_pylist()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and the places in it between the texts; a null text is empty."""
    plain = pa.compute.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, letters = plain.buffers()
    bounds = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    size = bounds[-1] - bounds[0]
    return np.frombuffer(letters, np.uint8, size, bounds[0]) if size else np.empty(0, np.uint8), bounds - bounds[0]


def binaries(letters: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The pieces of a byte array between neighbouring bounds."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, *map(pa.py_buffer, (bounds, letters))])


def gathered(values: pa.Array, at: pa.Array) -> tuple[bytes, np.ndarray]:
    """The large binary values at the given places one after the other, and the bounds between them."""
    found = values.take(at)
    _, bounds, letters = found.buffers()
    bounds = np.frombuffer(bounds, np.int64)[: len(found) + 1]
    return letters.to_pybytes()[: bounds[-1]] if bounds[-1] else b"", bounds


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the whole word."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def word_codes(words: list, cache: dict) -> np.ndarray:
    """A stable 64-bit code per word (bytes)."""
    import xxhash

    missing = set(words).difference(cache)
    cache.update((w, xxhash.xxh64_intdigest(w)) for w in missing)
    return np.fromiter(map(cache.__getitem__, words), U64, len(words))


class WordCodes:
    """Stable 64-bit codes of words (bytes); all are forgotten once they take more than `limit` bytes."""

    def __init__(self, limit: int = 24 << 20):
        self.limit, self.size, self.known = limit, 0, {}

    def of(self, words: list) -> np.ndarray:
        import xxhash

        if self.size > self.limit:
            self.size, self.known = 0, {}
        missing = set(words).difference(self.known)
        self.known.update((w, xxhash.xxh64_intdigest(w)) for w in missing)
        self.size += sum(len(w) + 150 for w in missing)
        return np.fromiter(map(self.known.__getitem__, words), U64, len(words))


def window_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """One code per window of `width` consecutive codes, in order of the windows."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    total = np.zeros(n, U64)
    for j in range(width):
        total = total * U64(0x9E3779B97F4A7C15) + codes[j : j + n]
        total ^= total >> U64(29)
    return mix(total)


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """A fixed-size bit table of the values of a long column, for skipping rows that cannot match.

    Built by a grouped bit_or, so at most BITMAP_BITS / 64 rows reach the driver.
    """
    slot = F.pmod(F.col(column), F.lit(BITMAP_BITS))
    rows = (
        hashes.where(F.col(column).isNotNull())
        .groupBy((slot / 64).cast("int").alias("at"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))")).alias("bits"))
        .toPandas()
    )
    words = np.zeros(BITMAP_BITS // 64, np.int64)
    words[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return words


def in_bitmap(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each int64 value may be among those the bitmap was made from."""
    slot = np.mod(values.astype(np.int64), BITMAP_BITS)
    return (words[slot // 64] >> (slot % 64)) & 1 == 1


def without_ids(docs: DataFrame, ids: DataFrame, once: bool = False) -> DataFrame:
    """Rows of `docs` whose doc_id is not in `ids`; rows with a null id stay.

    With `once`, rows that share a doc_id and a text stay once. A bit table of fixed size
    tells which rows cannot be concerned; only the others are shuffled.
    """
    concerned = ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    again = docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id") if once else None
    bits = bitmap(concerned.unionAll(again) if once else concerned, "doc_id")

    def part(wanted: bool):
        def run(batches):
            for batch in batches:
                column = batch.column("doc_id")
                hit = in_bitmap(bits, column.fill_null(0).to_numpy(zero_copy_only=False))
                hit &= ~np.asarray(column.is_null())
                yield batch.filter(pa.array(hit == wanted))

        return docs.mapInArrow(run, docs.schema)

    unsure = part(True).join(concerned.distinct(), "doc_id", "anti").select(*docs.columns)
    return part(False).unionAll(unsure.dropDuplicates(["doc_id", "text"]) if once else unsure)


def like(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """A batch from `batch`'s doc_id and further columns."""
    return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **columns})


ASCII_UNIT = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
STABLE_CUT = re.compile(r"(?<=\S)(?=[\t-\r ])")
RARE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def units(text: str) -> list[str]:
    """Cut a text before every ASCII white-space character that follows a non-space.

    No piece of the byte-level pre-tokenizer's pattern continues over such a place, and the
    pattern only looks ahead inside a run of white space; so the units can be encoded one by one.
    """
    if not RARE_SPACE.search(text):
        return ASCII_UNIT.findall(text)
    return [u for u in STABLE_CUT.split(text) if u]


ASCII_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
RARE_ENDS = np.array([int.from_bytes(c.encode()) for c in map(chr, range(0x3001)) if RARE_SPACE.match(c)])


def after_rare_space(letters: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each of the places (above 0) in UTF-8 bytes follows a character of RARE_SPACE."""
    code, rare = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    for back in (1, 2, 3):
        code += letters[np.maximum(at - back, 0)].astype(np.int64) << 8 * (back - 1)
        rare |= (at >= back) & np.isin(code, RARE_ENDS)
    return rare


def unit_bounds(letters: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bounds of the `units` of all texts in their UTF-8 bytes, and the number of units before each of the texts' bounds."""
    space = ASCII_SPACE[letters]
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    cut[:1] = False
    before = np.flatnonzero(cut) - 1
    unsure = before[(letters[before] >= 0x80) | (letters[before] >> 2 == 0x1C >> 2)] + 1
    cut[unsure[after_rare_space(letters, unsure)]] = False
    cut[bounds[bounds < len(letters)]] = True
    places = np.append(np.flatnonzero(cut), len(letters))
    return places, np.searchsorted(places, bounds)


#: Lower-case letters of one code point each that normalisation leaves as they are.
PLAIN_WORD = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+")
PLAIN_UNIT = re.compile(r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")


def byte_letters(characters: str) -> dict[int, str]:
    """How the byte-level pre-tokenizer of the library spells each of the characters."""
    from tokenizers.pre_tokenizers import ByteLevel

    speller = ByteLevel(add_prefix_space=False, use_regex=False)
    return {ord(c): speller.pre_tokenize_str(c)[0][0] for c in characters}
