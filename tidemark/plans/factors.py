"""Rounds of alternating least squares over ratings packed once.

Ratings are dealt by ranges of users, and once more by ranges of items, and packed into chunks of whole users (items)
with the list of the items (users) each chunk needs. A half round is one pass over the chunks of one side: a task gathers
the factors that its chunk needs from the files of the other side, solves the normal equations of the chunk's users
(items) and writes one file of theirs in the shared folder. Nothing is shuffled between rounds, and the factors
of a round are written once, not once per block of the other side.

Factors start where `pyspark.ml.recommendation.ALS` starts them, and the equations are its own: 64-bit sums,
regularised by the number of ratings, factors kept as 32-bit numbers. A number without ratings has no factors.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import filesystem, shared_path, via_table

CHUNK = 1 << 20  # ratings solved at once, besides a single user or item with more
AT_ONCE = 1 << 17  # ratings multiplied out at once
PART = 1 << 18  # numbers in a file of the starting factors
PACKED = "to binary, counts binary, by binary, at binary, rating binary"
WRITTEN = "first long, n long"


class Factors(NamedTuple):
    """Factors of consecutive numbers: files of float32 rows, each from `first` on; a missing number's row is NaN."""

    path: str
    rank: int
    parts: list[tuple[int, int]]  # (first, numbers in the file), ascending

    def rows(self, numbers: np.ndarray, opened: dict | None = None) -> np.ndarray:
        """The factors of ascending numbers; NaN where there are none. Files stay open in `opened`."""
        opened = {} if opened is None else opened
        out = np.full((len(numbers), self.rank), np.nan, np.float32)
        firsts = np.array([first for first, _ in self.parts], np.int64)
        part = np.searchsorted(firsts, numbers, "right") - 1
        cuts = np.searchsorted(part, np.arange(len(firsts) + 1))
        for k in np.unique(part[part >= 0]).tolist():
            first, n = self.parts[k]
            at = numbers[cuts[k] : cuts[k + 1]].astype(np.int64) - first
            inside = int(np.searchsorted(at, n))
            path = f"{self.path}/part-{first:010d}"
            matrix = opened[path] if path in opened else mapped(path, n, self.rank)
            if isinstance(matrix, np.memmap):
                opened[path] = matrix
            out[cuts[k] : cuts[k] + inside] = matrix[at[:inside]]
        return out

    def drop(self) -> None:
        files, root = filesystem(self.path)
        files.delete_dir(root)


def mapped(path: str, n: int, rank: int) -> np.ndarray:
    """The file as a matrix: mapped into memory where it is local, read otherwise."""
    files, name = filesystem(path)
    if files.type_name == "local":
        return np.memmap(name, "<f4", "r", shape=(n, rank))
    with files.open_input_file(name) as source:
        return np.frombuffer(source.read(), "<f4").reshape(n, rank)


def write_part(path: str, numbers: np.ndarray, rows: np.ndarray) -> tuple[int, int]:
    """Write the rows of ascending numbers as one file, under a name of its own until it is whole."""
    first, n = int(numbers[0]), int(numbers[-1] - numbers[0]) + 1
    full = np.full((n, rows.shape[1]), np.nan, "<f4")
    full[numbers - first] = rows
    files, root = filesystem(path)
    files.create_dir(root)
    own = f"{root}/.{uuid.uuid4().hex}"
    with files.open_output_stream(own) as sink:
        sink.write(full.tobytes())
    files.move(own, f"{root}/part-{first:010d}")
    return first, n


def written(frame: DataFrame, path: str, rank: int) -> Factors:
    """The factors whose files the tasks of `frame` (first, n) write: one small row per file reaches the driver."""
    return Factors(path, rank, sorted((r["first"], r["n"]) for r in frame.collect()))


def as_batch(made: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"first": [f for f, _ in made], "n": [n for _, n in made]}, pa.schema([("first", pa.int64()), ("n", pa.int64())]))


def packed(coded: DataFrame, to: str, by: str) -> DataFrame:
    """Ratings as chunks of whole `to` numbers: the numbers, their counts, the `by` numbers needed, and where each rating finds its own."""

    def chunk(rows):
        numbers, counts = np.unique(rows[0], return_counts=True)
        needed, at = np.unique(rows[1], return_inverse=True)
        columns = [numbers.astype("<i4"), counts.astype("<i4"), needed.astype("<i4"), at.astype("<i4"), rows[2]]
        return pa.RecordBatch.from_pydict({k: [c.tobytes()] for k, c in zip(("to", "counts", "by", "at", "rating"), columns, strict=True)})

    def run(batches):
        held, n, limit = [], 0, CHUNK
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += batch.num_rows
            if n >= limit:
                rows = [np.concatenate(c) for c in zip(*held, strict=True)]
                cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last number may go on in the next batch
                if cut:
                    yield chunk([c[:cut] for c in rows])
                held, n = [[c[cut:] for c in rows]], n - cut
                limit = max(CHUNK, 2 * n)
        if n:
            yield chunk([np.concatenate(c) for c in zip(*held, strict=True)])

    chosen = coded.select(F.col(to).alias("to"), F.col(by).alias("by"), F.col("rating").cast("float").alias("rating"))
    tasks = max(coded.sparkSession.sparkContext.defaultParallelism, coded.count() // (4 * CHUNK) + 1)
    ordered = chosen.repartitionByRange(tasks, "to").sortWithinPartitions("to", "by")
    return via_table(ordered.mapInArrow(run, PACKED), "packed-ratings")


def solve(counts: np.ndarray, at: np.ndarray, rating: np.ndarray, known: np.ndarray, reg: float) -> np.ndarray:
    """Factors of every number of a chunk: least squares over its ratings, those with equally many ratings together."""
    rank = known.shape[1]
    out = np.empty((len(counts), rank), np.float32)
    starts = np.cumsum(counts, dtype=np.int64) - counts
    order = np.argsort(counts, kind="stable")
    sizes, firsts = np.unique(counts[order], return_index=True)
    for d, a, b in zip(sizes.tolist(), firsts, [*firsts[1:], len(order)], strict=True):
        step = max(1, AT_ONCE // d)
        for lo in range(a, b, step):
            some = order[lo : min(b, lo + step)]
            sums = np.zeros((len(some), rank + 1, rank + 1))
            for begin in range(0, d, AT_ONCE):
                spots = starts[some][:, None] + np.arange(begin, min(d, begin + AT_ONCE))
                x = np.empty((*spots.shape, rank + 1))
                x[..., :rank], x[..., rank] = known[at[spots]], rating[spots]
                sums += x.transpose(0, 2, 1) @ x
            left = sums[:, :rank, :rank] + reg * d * np.eye(rank)
            out[some] = np.linalg.solve(left, sums[:, :rank, rank:])[..., 0]
    return out


def half_round(chunks: DataFrame, other: Factors, reg: float) -> Factors:
    """Factors of the numbers that `chunks` hold, given those of the other side."""
    path = shared_path(chunks.sparkSession, "factors")

    def run(batches):
        opened: dict = {}
        for batch in batches:
            for cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                to, counts, by, at = (np.frombuffer(c, "<i4") for c in cells[:4])
                solved = solve(counts, at, np.frombuffer(cells[4], "<f4"), other.rows(by, opened), reg)
                yield as_batch([write_part(path, to, solved)])

    return written(chunks.mapInArrow(run, WRITTEN), path, other.rank)


def start(coded: DataFrame, rank: int, seed: int) -> Factors:
    """The library's starting factors of the users: a fit of no rounds over one row per user."""
    path = shared_path(coded.sparkSession, "factors")
    users = coded.select("user_id_no").distinct().select("user_id_no", F.col("user_id_no").alias("item_id_no"), F.lit(0.0).alias("rating"))
    blank = ALS(rank=rank, maxIter=0, seed=seed, userCol="user_id_no", itemCol="item_id_no", ratingCol="rating").fit(users)

    def run(batches):
        part, numbers, rows = None, [], []
        for batch in batches:
            ids = batch.column("id").to_numpy()
            features = batch.column("features").flatten().to_numpy().reshape(len(ids), rank)
            for k in np.unique(ids // PART).tolist():
                if k != part and numbers:
                    yield as_batch([write_part(path, np.concatenate(numbers), np.concatenate(rows))])
                    numbers, rows = [], []
                part, here = k, ids // PART == k
                numbers.append(ids[here])
                rows.append(features[here])
        if numbers:
            yield as_batch([write_part(path, np.concatenate(numbers), np.concatenate(rows))])

    dealt = blank.userFactors.select("id", "features").repartition(F.floor(F.col("id") / PART)).sortWithinPartitions("id")
    return written(dealt.mapInArrow(run, WRITTEN), path, rank)


def fit(by_user: DataFrame, by_item: DataFrame, first: Factors, iters: int, reg: float) -> tuple[Factors, Factors]:
    """Factors of users and items after `iters` rounds; the files of a round go when the next one has been written."""
    users, items = first, None
    for _ in range(iters):
        last = users, items
        items = half_round(by_item, users, reg)
        users = half_round(by_user, items, reg)
        for old in last:
            if old is not None:
                old.drop()
    return users, items


def predicted(coded: DataFrame, users: Factors, items: Factors) -> DataFrame:
    """`coded` with the product of the factors of its numbers (user_id_no, item_id_no); rows without factors drop out."""
    kept = [c for c in coded.columns if c not in ("user_id_no", "item_id_no")]

    def run(batches):
        opened: dict = {}
        for batch in batches:
            sides = []
            for name, side in (("user_id_no", users), ("item_id_no", items)):
                numbers, at = np.unique(batch.column(name).to_numpy(), return_inverse=True)
                sides.append(side.rows(numbers, opened)[at])
            values = np.einsum("ij,ij->i", *sides)
            known = pa.array(~np.isnan(values))
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(values.astype(np.float64))], [*kept, "prediction"])
            yield out.filter(known)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema if f.name in kept]
    return coded.mapInArrow(run, ", ".join([*kinds, "prediction double"]))
