"""Benchmark decontamination by template windows with slot consistency.

Texts become template tokens: numbers, names (capitalised words inside a sentence) and units after a
number are typed placeholders, everything else is its lower-case word; the replaced words are the
slots. In scripts without spaces every character is a token. Windows of `width` template tokens are hashed, and documents' windows are hash-joined with the
benchmark items'. Matches of one document and item with the same offset between their positions form
an alignment. An alignment counts if its slots are consistent: each value of the item always meets
the same value in the document, as when a question is asked again with other numbers and names. Where a
value meets itself and others too, only the windows that hold another than its most frequent partner are
left out, and none whose slots all equal the item's own; an alignment in which a value meets several
others and never itself does not count. An
item leaks into a document if its consistent alignments cover at least `min_share` of its windows, or if
one of them holds a passage of PASSAGE tokens, whatever the item's length.

Windows that cannot match are dropped before the shuffle by a bit table of fixed size built from the
benchmark's window hashes; it may let others pass, never the reverse, so the join stays exact at any
size of the benchmark. A document's position in the table is its row's id; rows that share an id are
one document.

An item's first window is searched with both readings of a capitalised first word, sentence start and
name, as a quotation may follow a colon or a comma.

Items of fewer than `width` template tokens are matched as one window of their own length; items of
fewer than MIN_TOKENS tokens, or windows with fewer than MIN_WORDS words outside placeholders, are
too common to tell and are not searched. Null or empty texts match nothing; rows with a null id are
not reported; an empty benchmark or table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, bitmap, in_bitmap, mix, text_slices, window_codes, word_codes
from tidemark.session import shared_path

WIDTH = 8
MIN_TOKENS = 5
MIN_WORDS = 3
MIN_SHARE = 0.3
PASSAGE = 50  # tokens in a row, each in a matched window of one alignment, that are a leak of any item
CACHE_WORDS = 200_000

#: Scripts written without spaces (Thai to Lao, Myanmar, Khmer, kana, Han): every character is a token.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
LETTER = rf"[^\W\d_{UNSPACED}]"
TOKEN = re.compile(rf"\d+(?:[.,:/]\d+)*|{LETTER}+(?:['’]{LETTER}+)*|[{UNSPACED}]|[.!?\n]|[%$€£°]")
WORD, NUMBER, CAPITAL, STOP, UNIT = range(5)
UNITS = frozenset(
    """% $ € £ ° percent dollar dollars cent cents euro euros pound pounds km kilometer kilometers kilometre kilometres
    m meter meters metre metres cm mm mile miles foot feet inch inches yard yards kg kilogram kilograms g gram grams mg
    ton tons tonne tonnes l liter liters litre litres ml gallon gallons hour hours minute minutes second seconds day days
    week weeks month months year years mph kmh degree degrees watt watts volt volts""".split()
)
SPELLED = frozenset(
    """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen
    eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million""".split()
)
PLACEHOLDER = {NUMBER: 0x6E756D62, CAPITAL: 0x6E616D65, UNIT: 0x756E6974}


class Templates:
    """Template codes of texts; what a token is by itself comes from a bounded table."""

    def __init__(self):
        self.known: dict[str, int] = {}  # token to its place in the two arrays
        self.codes, self.kinds = np.empty(0, U64), np.empty(0, np.int8)

    def _learn(self, tokens: list[str]) -> None:
        kinds = []
        for place, token in enumerate(tokens, len(self.codes)):
            low = token.lower()
            if token in ".!?\n":
                kind = STOP
            elif token[0].isdigit() or low in SPELLED:
                kind = NUMBER
            elif low in UNITS:
                kind = UNIT
            else:
                kind = CAPITAL if token[0].isupper() and not (len(token) > 1 and token.isupper()) else WORD
            kinds.append(kind)
            self.known[token] = place
        self.codes = np.append(self.codes, word_codes([t.lower().encode() for t in tokens], {}))
        self.kinds = np.append(self.kinds, np.array(kinds, np.int8))

    def tokens(self, texts: list[str]):
        """All texts laid end to end, sentence ends left out: template codes, codes of the words as
        they stand, which are placeholders, which are capitalised, the text of each token, and the texts' token counts."""
        parts = [TOKEN.findall(t) for t in texts]
        here = set().union(*parts)
        if len(self.known) > CACHE_WORDS:
            self.__init__()
        self._learn([t for t in here if t not in self.known])
        sizes = np.array(list(map(len, parts)), np.int64)
        place = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64, sizes.sum())
        raw, kind = self.codes[place], self.kinds[place]
        before = np.empty_like(kind)
        before[1:] = kind[:-1]
        before[(np.cumsum(sizes) - sizes)[sizes > 0]] = STOP
        slot = (kind == NUMBER) | ((kind == CAPITAL) & (before != STOP)) | ((kind == UNIT) & (before == NUMBER))
        template = raw.copy()
        for k, code in PLACEHOLDER.items():
            template[slot & (kind == k)] = code
        real = kind != STOP
        owner = np.repeat(np.arange(len(texts)), sizes)[real]
        return template[real], raw[real], slot[real], (kind == CAPITAL)[real], owner, np.bincount(owner, minlength=len(texts))


def window_rows(texts: DataFrame, key: str, sizes: list[int], keep: np.ndarray | None, items: bool = False):
    """(key, size, at, hash, slots, total) of the windows of each text, of the given sizes.

    With `items`, a text is taken in windows of the largest size or, if it is shorter, in one window
    of its own length if that is among the sizes. With `keep`, only windows whose hash is in the bit
    table. A window needs enough words outside placeholders.
    """

    def run(batches):
        templates = Templates()
        for batch, rows in text_slices(batches):
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            template, raw, slot, capital, owner, counts = templates.tokens([t or "" for t in rows])
            first = np.cumsum(counts) - counts
            words = np.concatenate([[0], np.cumsum(~slot)])
            for size in sizes:
                if len(template) < size:
                    continue
                fits = owner[: len(owner) - size + 1] == owner[size - 1 :]
                fits &= words[size:] - words[:-size] >= min(size, MIN_WORDS)
                if items and size < max(sizes):
                    fits &= (counts == size)[owner[: len(fits)]]
                start = np.flatnonzero(fits)
                hashes = mix(window_codes(template, size) + U64(size)).astype(np.int64)[start]
                total = np.bincount(owner[start], minlength=len(counts))
                named = np.empty(0, np.int64)
                if items:  # quoted inside a sentence, an item's first word is read as a name
                    named = start[(start == first[owner[start]]) & capital[start] & ~slot[start]]
                    other = template.copy()
                    other[named] = PLACEHOLDER[CAPITAL]
                    again = mix(window_codes(other, size) + U64(size)).astype(np.int64)[named]
                    start, hashes = np.append(start, named), np.append(hashes, again)
                if keep is not None:
                    some = in_bitmap(keep, hashes)
                    start, hashes = start[some], hashes[some]
                text = owner[start]
                slots = [raw[a : a + size][slot[a : a + size]].astype(np.int64) for a in start.tolist()]
                for k, a in enumerate(named.tolist(), len(start) - len(named)):
                    slots[k] = np.append(raw[a].astype(np.int64), slots[k])
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(keys[text].astype(np.int64)),
                        "size": pa.array(np.full(len(start), size, np.int64)),
                        "at": pa.array(start - first[text]),
                        "hash": pa.array(hashes),
                        "slots": pa.array(slots, pa.list_(pa.int64())),
                        "total": pa.array(total[text].astype(np.int64)),
                    }
                )

    return texts.select(F.col(key).cast("long").alias(key), "text").mapInArrow(
        run, "key long, size long, at long, hash long, slots array<long>, total long"
    )


def sound_places(windows):
    """Places of the windows to keep of an alignment with conflicting slots; null for null."""
    if windows is None:
        return None
    partners: dict[int, Counter] = {}
    for w in windows:
        for pair in w["slots"]:
            partners.setdefault(pair["item_slots"], Counter())[pair["doc_slots"]] += 1
    if any(len(c) > 1 and value not in c for value, c in partners.items()):
        return []
    best = {value: max(c, key=lambda p: (c[p], p == value, p)) for value, c in partners.items()}
    pairs = [(w["item_at"], [(s["item_slots"], s["doc_slots"]) for s in w["slots"]]) for w in windows]
    return sorted({at for at, some in pairs if all(a == b for a, b in some) or all(best[a] == b for a, b in some)})


def passage(places, width: int):
    """Tokens of the longest stretch that the windows at `places` cover without a gap."""

    def step(seen, at):
        start = F.when(at - seen["last"] <= width, seen["start"]).otherwise(at)
        return F.struct(
            start.alias("start"), at.alias("last"), F.greatest(seen["best"], at - start + width).alias("best")
        )

    far = F.lit(-(1 << 40))
    first = F.struct(far.alias("start"), far.alias("last"), F.lit(0).cast("long").alias("best"))
    return F.aggregate(F.array_sort(places), first, step, lambda seen: seen["best"])


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, item_id, matched_windows, item_windows, alignments) of every leak."""
    spark = docs.sparkSession
    path = shared_path(spark, "items")
    items = benchmark.where(F.col("item_id").isNotNull()).dropDuplicates(["item_id", "text"])
    window_rows(items, "item_id", list(range(min(MIN_TOKENS, width), width + 1)), None, items=True).write.parquet(path)
    items = spark.read.parquet(path)
    keep = bitmap(items, "hash")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most `width` values
    found = window_rows(docs.where(F.col("doc_id").isNotNull()), "doc_id", sizes, keep)
    left = found.select(F.col("key").alias("doc_id"), F.col("at").alias("doc_at"), "hash", F.col("slots").alias("doc_slots"))
    right = items.select(
        F.col("key").alias("item_id"), F.col("at").alias("item_at"), "hash", F.col("slots").alias("item_slots"),
        F.col("total").alias("item_windows"),
    )
    met = left.join(right, "hash").withColumn("shift", F.col("doc_at") - F.col("item_at"))
    window = F.struct("item_at", F.arrays_zip("item_slots", "doc_slots").alias("slots"))
    aligned = met.groupBy("doc_id", "item_id", "shift").agg(
        F.collect_set(window).alias("windows"), F.max("item_windows").alias("item_windows")
    )
    pairs = F.array_distinct(F.flatten("windows.slots"))
    values = F.transform(pairs, lambda p: p["item_slots"])
    consistent = F.size(pairs) == F.size(F.array_distinct(values))
    sound = F.udf(sound_places, "array<long>")(F.when(~consistent, F.col("windows")))
    return (
        aligned.withColumn("places", F.coalesce(sound, F.array_distinct("windows.item_at")))
        .where(F.size("places") > 0)
        .groupBy("doc_id", "item_id")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("matched_windows"),
            F.max("item_windows").alias("item_windows"),
            F.count("*").alias("alignments"),
            F.max(passage(F.col("places"), width)).alias("passage"),
        )
        .where((F.col("matched_windows") >= F.lit(min_share) * F.col("item_windows")) | (F.col("passage") >= PASSAGE))
        .drop("passage")
    )
