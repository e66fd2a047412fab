"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding maps look-alike letters of other scripts, accents, and digits or signs that stand for letters
to one plain letter each (i, l, 1 and ! are one class), on the lexicon and on the text alike. Lexicon
terms are words and word beginnings, weighted by log odds from labelled rows; every term stays that a
likelihood-ratio test finds to go with toxic texts, however weak beside the strongest. A match counts where it is a whole
word, or the beginning of one, and not part of an exception phrase; a word counts once, by its strongest
term. Two figures per text, the
total weight and the weight per hundred words, go through a fitted logistic curve.

What is learned from is bounded: about `per_class` labelled rows of each class, drawn by hash; lexicon
terms number at most `max_terms`. Scoring covers whole texts.

Defined cases: null or empty text has no matches and gets the curve's value for that; several labels
of one document count as the largest; null labels and ids are never learned from; with no usable
label of either class the lexicon is empty and all scores are 0; repeated rows are scored one by one.
"""

from __future__ import annotations

import math
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import like, text_slices

PER_CLASS = 10_000
MAX_TERMS = 2_000
MIN_TOXIC = 3  # toxic texts that must hold a term
SURE = 20.0  # least likelihood ratio (chi square of one degree, p < 1e-5), since very many terms are tried
LEAST_WEIGHT = 0.5  # of a term
STEMS = (5, 6)  # letters of word beginnings that are terms, written with a star

#: Harmless phrases that hold a word which is an insult elsewhere.
EXCEPTIONS = (
    "trash can", "trash bin", "white trash bag", "clown fish", "class clown", "pond scum", "soap scum",
    "sore loser", "kill time", "scum of the earth novel",
)

#: Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "α": "a", "β": "b", "ε": "e", "η": "n",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "l": "i", "|": "i",
}
SIGN = re.compile(r"[@$!](?=\w)")  # a sign that stands for a letter has more of the word after it
SIGNS = {"@": "a", "$": "s", "!": "i"}
WORD = re.compile(r"\w+")


def fold_table() -> dict[int, str]:
    """Code point to folded letter, for cased look-alikes and accented Latin letters."""
    table = {}
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFKD", chr(code))[0].lower()
        if base != chr(code) and base.isascii():
            table[code] = LOOK_ALIKES.get(base, base)
    for letter, plain in LOOK_ALIKES.items():
        table[ord(letter)] = table[ord(letter.upper()[0])] = plain
    for code in range(ord("A"), ord("Z") + 1):
        low = chr(code).lower()
        table[code] = LOOK_ALIKES.get(low, low)
    return table


FOLD = fold_table()


def fold(text: str) -> str:
    if "@" in text or "$" in text or "!" in text:
        text = SIGN.sub(lambda m: SIGNS[m.group()], text)
    return text.translate(FOLD)


class Matcher:
    """Aho-Corasick automaton over folded terms (weights) and exception phrases."""

    def __init__(self, weights: dict[str, float], exceptions=EXCEPTIONS):
        import ahocorasick

        found: dict[str, list] = {}
        for term, weight in weights.items():
            found.setdefault(term.rstrip("*"), []).append((weight, term.endswith("*")))
        for phrase in {fold(e) for e in exceptions}:
            found.setdefault(phrase, []).append((None, False))
        self.automaton = ahocorasick.Automaton()
        for text, kinds in found.items():
            self.automaton.add_word(text, (len(text), kinds))
        self.empty = not found
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the strongest match at each word outside exception phrases."""
        if self.empty:
            return []
        best, spared, n = {}, [], len(folded)
        for last, (size, kinds) in self.automaton.iter(folded):
            start, end = last - size + 1, last + 1
            if start and folded[start - 1].isalnum():
                continue
            whole = end == n or not folded[end].isalnum()
            for weight, stem in kinds:
                if weight is None:
                    if whole:
                        spared.append((start, end))
                elif (whole or stem) and weight > best.get(start, (0, 0.0))[1]:
                    best[start] = (end, weight)
        found = [(start, end, weight) for start, (end, weight) in best.items()]
        if spared:
            found = [h for h in found if not any(s <= h[0] and h[1] <= e for s, e in spared)]
        return found

    def features(self, text: str | None) -> tuple[float, float]:
        """log(1 + weight) and log(1 + weight per hundred words)."""
        if not text:
            return 0.0, 0.0
        total = sum(w for _, _, w in self.hits(fold(text)))
        return math.log1p(total), math.log1p(100 * total / len(text.split())) if total else 0.0


def sampled(docs: DataFrame, labels: DataFrame, training, per_class: int) -> DataFrame:
    """Labelled training rows: about `per_class` ids of each class, drawn by hash, so their list is broadcast."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .where(F.col("toxic").isin(0, 1) & training)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, per_class / sizes.get(1, 1)).otherwise(per_class / sizes.get(0, 1))
    drawn = known.where(draw < share).limit(4 * per_class)  # far above what the draw gives: a proven bound
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.join(F.broadcast(drawn), "doc_id")


def term_counts(rows: DataFrame) -> DataFrame:
    """Texts of each class that hold each folded word; summed inside a task first."""

    def run(batches):
        for batch, texts in text_slices(batches):
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(texts, batch.column("toxic").to_pylist(), strict=True):
                words = set(WORD.findall(fold(text or "")))
                for term in words.union(w[:k] + "*" for w in words for k in STEMS if len(w) > k):
                    counts.setdefault(term, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_pydict(
                {
                    "term": pa.array(counts, pa.string()),
                    "clean": pa.array([c for c, _ in counts.values()], pa.int64()),
                    "toxic": pa.array([t for _, t in counts.values()], pa.int64()),
                }
            )

    pairs = rows.mapInArrow(run, "term string, clean long, toxic long")
    return pairs.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def lexicon(rows: DataFrame, max_terms: int = MAX_TERMS) -> dict[str, float]:
    """Term to weight, of at most `max_terms` terms."""
    sizes = rows.agg(F.sum(F.lit(1) - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")).first()
    if not sizes["clean"] or not sizes["toxic"]:
        return {}

    def odds(n, total):
        return F.log((F.col(n) + 0.5) / (F.lit(float(total)) - F.col(n) + 0.5))

    weight = odds("toxic", sizes["toxic"]) - odds("clean", sizes["clean"])
    whole = float(sizes["toxic"] + sizes["clean"])
    held = F.col("toxic") + F.col("clean")

    def cell(found, expected):
        return F.when(found > 0, found * F.log(found / expected)).otherwise(0.0)

    ratio = F.lit(0.0)
    for n in ("toxic", "clean"):
        share = float(sizes[n]) / whole
        ratio += cell(F.col(n), held * share) + cell(sizes[n] - F.col(n), (F.lit(whole) - held) * share)
    chosen = (
        term_counts(rows)
        .withColumn("weight", weight)
        .where((F.col("toxic") >= MIN_TOXIC) & (F.col("weight") >= LEAST_WEIGHT) & (2 * ratio >= SURE))
        .orderBy(F.desc("weight"), "term")
        .limit(max_terms)
        .collect()
    )
    return {r["term"]: r["weight"] for r in chosen}


def measured(rows: DataFrame, weights: dict[str, float], exceptions) -> DataFrame:
    def run(batches):
        matcher = Matcher(weights, exceptions)
        for batch, texts in text_slices(batches):
            found = [matcher.features(t) for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "total": pa.array([f[0] for f in found], pa.float64()),
                    "density": pa.array([f[1] for f in found], pa.float64()),
                    "toxic": batch.column("toxic"),
                }
            )

    # Equal figures are one row with a count, so few rows reach the driver.
    exact = rows.mapInArrow(run, "total double, density double, toxic int")
    at = [F.round(c, 2).alias(c) for c in ("total", "density")]
    return exact.groupBy(*at, "toxic").agg(F.count("*").alias("n"))


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights (bias first) by Newton steps on the class-balanced, slightly damped likelihood."""
    x = np.column_stack([np.ones(len(x)), x])
    side = np.where(y == 1, n / max(1, n[y == 1].sum()), n / max(1, n[y == 0].sum())) * n.sum() / 2
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (side * (y - p)) - 0.5 * beta
        curve = (x * (side * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(beta))
        move = np.linalg.solve(curve, slope)
        beta += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return beta


class ToxicModel:
    def __init__(self, weights: dict[str, float], beta: np.ndarray | None, exceptions=EXCEPTIONS):
        self.weights, self.beta, self.exceptions = weights, beta, tuple(exceptions)


def fit(docs, labels, training, per_class=PER_CLASS, max_terms=MAX_TERMS, exceptions=EXCEPTIONS) -> ToxicModel:
    rows = sampled(docs, labels, training, per_class)
    weights = lexicon(rows, max_terms)
    if not weights:
        return ToxicModel({}, None, exceptions)
    found = measured(rows, weights, exceptions).toPandas()  # grouped figures of at most 2 * per_class ids
    beta = logistic(found[["total", "density"]].to_numpy(), found["toxic"].to_numpy(), found["n"].to_numpy(float))
    return ToxicModel(weights, beta, exceptions)


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, score in 0..1 and predicted label of every row."""

    def run(batches):
        matcher = Matcher(model.weights, model.exceptions)
        for batch, texts in text_slices(batches):
            if model.beta is None:
                scores = np.zeros(len(texts))
            else:
                x = np.array([matcher.features(t) for t in texts]).reshape(-1, 2)
                scores = 1 / (1 + np.exp(-np.clip(model.beta[0] + x @ model.beta[1:], -30, 30)))
            yield like(batch, score=pa.array(scores), predicted=pa.array((scores >= 0.5).astype(np.int32)))

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, score double, predicted int")
