"""Quality rules on repetition inside a text, from a suffix array over its words.

Texts of a slice are laid end to end and sorted by prefix doubling (only positions whose order is
still open are sorted again). Neighbours in the array give the longest-common-prefix values; the
interval of largest value that holds a suffix is the one it shares with a neighbour, so the spans of
the maximal repeats are [i, i + max(lcp before, lcp after)). Their union gives the covered share,
their maximum the longest repeat. No shuffle; memory is a few arrays per slice of words.

Defined cases: null or empty text has no words and fails the base rules; rows with equal or null ids
are judged one by one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import like, text_slices

SPACES = "\t\n\v\f\r "
SYMBOLS = "#*$%&|<>"
MIN_REPEAT = 8  # words: shorter repeats do not count as spans
MAX_COVERED = 0.2  # share of the words inside repeated spans
MAX_LONGEST = 100  # words
RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_words long, longest_repeat long"
)


def suffix_array(codes: np.ndarray, doc: np.ndarray, ends: np.ndarray):
    """Sorted suffixes of all documents (a suffix stops at its document's end) and the rank tables.

    `ends[i]` is the end of the document that holds position i. Suffixes are ordered by document
    first. Table k holds ranks by the first 2**k words, equal exactly for equal prefixes.
    """
    n = len(codes)
    order = np.lexsort((codes, doc))
    head = np.ones(n, bool)
    head[1:] = (np.diff(doc[order]) != 0) | (np.diff(codes[order]) != 0)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    tables, width = [rank.astype(np.int32)], 1
    at = np.arange(n)
    while True:
        size = np.bincount(rank, minlength=n)
        at = at[size[rank[at]] > 1]
        if not len(at):
            break
        follow = np.where(at + width < ends[at], rank[np.minimum(at + width, n - 1)] + 1, 0)
        by = np.lexsort((follow, rank[at]))
        at, follow = at[by], follow[by]
        old = rank[at]
        new_group = np.ones(len(at), bool)
        new_group[1:] = np.diff(old) != 0
        step = np.arange(len(at))
        place = old + step - np.maximum.accumulate(np.where(new_group, step, 0))
        head = new_group.copy()
        head[1:] |= np.diff(follow) != 0
        rank = rank.copy()
        rank[at] = place[np.maximum.accumulate(np.where(head, step, 0))]
        tables.append(rank.astype(np.int32))
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, tables


def longest_common_prefixes(order: np.ndarray, tables: list[np.ndarray], doc: np.ndarray) -> np.ndarray:
    """Common words of each suffix with the one before it in the array; 0 for the first."""
    n = len(order)
    lcp = np.zeros(n, np.int64)
    pair = np.flatnonzero(tables[0][order[1:]] == tables[0][order[:-1]]) + 1
    a, b = order[pair - 1], order[pair]
    length = np.zeros(len(pair), np.int64)
    for level in range(len(tables) - 1, -1, -1):
        table = np.append(tables[level], -1)
        left, right = a + length, b + length
        # A position past the text belongs to the next document, whose ranks differ from all here.
        same = (table[np.minimum(left, n)] == table[np.minimum(right, n)]) & (left < n) & (right < n)
        length += np.where(same, 1 << level, 0)
    lcp[pair] = length
    return lcp


def repeats(codes: np.ndarray, lengths: np.ndarray, window: int, min_repeat: int):
    """Per document: words in repeated windows, words in repeated spans, longest repeat."""
    docs, n = len(lengths), len(codes)
    if not n:
        zero = np.zeros(docs, np.int64)
        return zero, zero, zero
    doc = np.repeat(np.arange(docs), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    order, tables = suffix_array(codes, doc, ends)
    lcp = longest_common_prefixes(order, tables, doc)
    reach = np.empty(n, np.int64)
    reach[order] = np.maximum(lcp, np.append(lcp[1:], 0))

    def covered(least: int, most: int | None) -> np.ndarray:
        start = np.flatnonzero(reach >= least)
        stop = start + (reach[start] if most is None else most)
        open_spans = np.cumsum(np.bincount(start, minlength=n + 1) - np.bincount(stop, minlength=n + 1))[:n]
        return np.bincount(doc, weights=open_spans > 0, minlength=docs).astype(np.int64)

    longest = np.zeros(docs, np.int64)
    np.maximum.at(longest, doc, reach)
    return covered(window, window), covered(min_repeat, None), longest


def quality(
    docs: DataFrame, min_repeat=MIN_REPEAT, max_covered=MAX_COVERED, max_longest=MAX_LONGEST, extra: str = ""
) -> DataFrame:
    """One row of counts and verdicts per document. `extra` names input columns to pass on
    (comma-separated, with types), for callers that filter by the verdict."""
    names = [c.split()[0] for c in extra.split(",")] if extra else []

    def run(batches):
        for batch, texts in text_slices(batches):
            codes, lengths, chars, symbols, dups = [], [], [], [], []
            known: dict = {}
            for text in texts:
                text = text or ""
                words = text.encode().split()  # ASCII white space only, on bytes
                codes.extend([known.setdefault(w, len(known)) for w in words])
                lengths.append(len(words))
                chars.append(len(text) - sum(map(text.count, SPACES)))
                symbols.append(sum(map(text.count, SYMBOLS)))
                lines = [line for line in text.split("\n") if line.strip(SPACES)] if "\n" in text else ()
                dups.append(len(lines) - len(set(lines)))
            n_words = np.array(lengths, np.int64)
            windows, covered, longest = repeats(np.array(codes, np.int64), n_words, 5, min_repeat)
            failed = (n_words < 10) | (100 * windows > 20 * n_words)
            kept = ~failed & (covered <= max_covered * n_words) & (longest <= max_longest)
            yield like(
                batch,
                n_words=pa.array(n_words),
                word_chars=pa.array(chars, pa.int64()),
                n_symbols=pa.array(symbols, pa.int64()),
                n_dup_lines=pa.array(dups, pa.int64()),
                n_repeat_words=pa.array(windows),
                base_failed=pa.array(failed),
                kept=pa.array(kept),
                covered_words=pa.array(covered),
                longest_repeat=pa.array(longest),
                **({"text": batch.column("text")} if "text" in names else {}),
                **{c: batch.column(c) for c in names if c != "text"},
            )

    columns = ["doc_id", "text", *[c for c in names if c != "text"]]
    chosen = docs.select(*columns).withColumn("doc_id", docs["doc_id"].cast("long"))
    return chosen.mapInArrow(run, RESULT + (", " + extra if extra else ""))
