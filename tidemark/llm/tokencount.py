"""Token counts of whole texts, huge ones by overlapping chunks that are spliced where both agree.

A text longer than `chunk` characters is encoded in chunks that overlap. Two neighbours are spliced
at the first place of their overlap where both have a token boundary and the text goes from a
non-space to an ASCII white-space character: no piece of the byte-level pre-tokenizer's pattern
reaches over such a place, so what stands before and after it is encoded alike whatever surrounds
it. Where an overlap holds no such place, it is doubled, at most to the end of the text.

Shorter texts are one chunk. They are encoded unit by unit between such places, with the counts of
units seen before in a bounded table.

Defined cases: null or empty text has 0 bytes and 0 tokens; repeated rows and null ids are counted
row by row; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import PLAIN_UNIT, STABLE_CUT, byte_letters, like, text_slices, units, worker_state

CHUNK, OVERLAP = 32_768, 256  # characters
CACHE_UNITS = 500_000


def spans_of(tokenizer, text: str) -> np.ndarray:
    offsets = tokenizer.encode(text, add_special_tokens=False).offsets
    return np.array(offsets, np.int64).reshape(-1, 2)


def boundaries(spans: np.ndarray) -> np.ndarray:
    """Places where a token starts and all tokens before it have ended."""
    ended = np.maximum.accumulate(spans[:, 1])[:-1]
    return spans[1:, 0][spans[1:, 0] >= ended]


def splice_point(text: str, left: np.ndarray, right: np.ndarray, low: int, high: int) -> int | None:
    """The first proven boundary common to both encodings in (low, high); spans are absolute."""
    both = np.intersect1d(boundaries(left), boundaries(right))
    for at in both[(both > low) & (both < high)].tolist():
        if STABLE_CUT.match(text, at):
            return at
    return None


def count_spliced(text: str, encode, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of `text`, where encode(piece) gives an (n, 2) array of token spans in characters."""
    n, total, start, done = len(text), 0, 0, 0
    left, left_end = None, 0
    while True:
        width = overlap
        while True:
            end = min(n, start + chunk + width)
            if left is None or left_end < end:
                left, left_end = encode(text[start:end]) + start, end
            if left_end == n:
                return total + int((left[:, 0] >= done).sum())
            middle = start + chunk
            right_end = min(n, max(middle + chunk + overlap, left_end))
            right = encode(text[middle:right_end]) + middle
            at = splice_point(text, left, right, max(middle, done), left_end)
            if at is not None:
                break
            width *= 2
        total += int(((left[:, 0] >= done) & (left[:, 0] < at)).sum())
        done = at
        if at < middle + chunk:
            start, left, left_end = middle, right, right_end
        else:  # the overlap had grown past the next chunk: begin anew at the proven place
            start, left = at, None


class UnitCounter:
    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, int] = {}
        letters = filter(PLAIN_UNIT.fullmatch, map(chr, range(256)))
        self.spelled = byte_letters(" " + "".join(letters))

    def count(self, texts: list[str]) -> list[int]:
        parts = [units(t) for t in texts]
        here = set().union(*parts)
        missing = list(here.difference(self.known))
        model, spelled = self.tokenizer.model, self.spelled
        plain = [u for u in missing if PLAIN_UNIT.fullmatch(u)]  # one piece of letters each
        self.known.update((u, len(model.tokenize(u.translate(spelled)))) for u in plain)
        rest = [u for u in missing if u not in self.known]
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        self.known.update(zip(rest, map(len, found), strict=True))
        get = self.known.__getitem__
        out = [sum(map(get, p)) for p in parts]
        if len(self.known) > CACHE_UNITS:  # keep what this slice used: the common units are in it
            self.known = {u: self.known[u] for u in here}
        return out


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    def run(batches):
        counter = worker_state("units:" + tokenizer, lambda: UnitCounter(tokenizer))
        for batch, texts in text_slices(batches):
            texts = [t or "" for t in texts]
            short = iter(counter.count([t for t in texts if len(t) <= chunk]))
            counts = [
                next(short)
                if len(t) <= chunk
                else count_spliced(t, lambda piece: spans_of(counter.tokenizer, piece), chunk, overlap)
                for t in texts
            ]
            yield like(
                batch,
                n_bytes=pa.array([len(t.encode()) for t in texts], pa.int64()),
                n_tokens=pa.array(counts, pa.int64()),
                over_limit=pa.array([c > limit for c in counts], pa.bool_()),
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
