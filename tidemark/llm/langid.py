"""Language identification by a byte convolutional network, trained and applied in numpy.

Filters of several widths run over the bytes of fixed-length windows; each filter's maximum over the
window, rectified, feeds a softmax. A filter is a table of one weight per place and byte value, so a
convolution is a sum of table rows. Training sees windows cut at hashed places from a sample of
labelled rows: about `per_language` rows of each of the `max_languages` commonest languages, which
bounds what reaches the driver. Prediction covers the whole of every text: consecutive windows in
batches, class probabilities averaged by the bytes of each window.

Defined cases: null text or text without a letter gives `und` with score 0; a table without usable
labels gives `und` everywhere; null labels and null ids are never learned from; rows are predicted
one by one whatever their ids; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import like, text_slices

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
PER_LANGUAGE = 600
MAX_LANGUAGES = 200
CUTS = 2  # training windows of each sampled row
ROUNDS = 8
UNKNOWN = "und"


class ByteConvNet:
    """Weights: `tables[w]` of shape (w, 256, FILTERS), `bias`, `out` and `out_bias`."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        for table in self.tables:
            table[:, 0] = 0  # padding
        n = FILTERS * len(WIDTHS)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.3, (n, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def pooled(self, windows: np.ndarray):
        """Maximum of each filter over each window (B, n) and the place where it was found."""
        tops, places = [], []
        for width, table in zip(WIDTHS, self.tables, strict=True):
            span = windows.shape[1] - width + 1
            total = table[0][windows[:, :span]]
            for j in range(1, width):
                total += table[j][windows[:, j : j + span]]
            place = total.argmax(1)
            places.append(place)
            tops.append(np.take_along_axis(total, place[:, None], 1)[:, 0])
        return np.concatenate(tops, 1) + self.bias, places

    def maxima(self, windows: np.ndarray) -> np.ndarray:
        """As `pooled`, without the places."""
        tops = []
        for width, table in zip(WIDTHS, self.tables, strict=True):
            span = windows.shape[1] - width + 1
            total = table[0][windows[:, :span]]
            for j in range(1, width):
                total += table[j][windows[:, j : j + span]]
            tops.append(total.max(1))
        return np.concatenate(tops, 1) + self.bias

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        logits = np.maximum(features, 0) @ self.out + self.out_bias
        logits -= logits.max(1, keepdims=True)
        found = np.exp(logits)
        return found / found.sum(1, keepdims=True)

    def predict(self, windows: np.ndarray, batch: int = 64) -> np.ndarray:
        parts = [self.probabilities(self.maxima(windows[i : i + batch])) for i in range(0, len(windows), batch)]
        return np.concatenate(parts) if parts else np.empty((0, len(self.languages)), np.float32)

    def train(self, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = ROUNDS, seed: int = 7):
        """Adam on the weighted cross entropy; gradients of a filter only touch its best place."""
        rng = np.random.default_rng(seed)
        values = [*self.tables, self.bias, self.out, self.out_bias]
        first = [np.zeros_like(v) for v in values]
        second = [np.zeros_like(v) for v in values]
        step, lines = 0, np.arange(FILTERS)
        for round_no in range(rounds):
            rate = 0.02 * (1 - round_no / rounds) + 0.001
            order = rng.permutation(len(windows))
            for at in range(0, len(order), 64):
                some = order[at : at + 64]
                x, y = windows[some], labels[some]
                features, places = self.pooled(x)
                error = self.probabilities(features)
                error[np.arange(len(some)), y] -= 1
                error *= (weights[some] / len(some))[:, None].astype(np.float32)
                active = np.maximum(features, 0)
                back = (error @ self.out.T) * (features > 0)
                slopes = []
                for k, (width, place) in enumerate(zip(WIDTHS, places, strict=True)):
                    slope = np.zeros_like(self.tables[k])
                    part = back[:, k * FILTERS : (k + 1) * FILTERS]
                    for j in range(width):
                        byte = np.take_along_axis(x, place + j, 1)
                        np.add.at(slope[j], (byte, np.broadcast_to(lines, byte.shape)), part)
                    slope[:, 0] = 0
                    slopes.append(slope)
                slopes += [back.sum(0), active.T @ error, error.sum(0)]
                step += 1
                for v, m, s, g in zip(values, first, second, slopes, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)


def windows_of(raw: bytes) -> np.ndarray:
    """The bytes in consecutive windows; the last is filled up with zeros."""
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, WINDOW)


def training_rows(docs: DataFrame, training, per_language: int, max_languages: int):
    """A bounded sample: (language, a few passages cut at hashed places) of each chosen row."""
    usable = docs.where(training & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages)
    seen = {r["lang"]: r["n"] for r in counts.collect()}  # at most max_languages rows
    if not seen:
        return [], []
    share = F.create_map(*[F.lit(x) for lang, n in seen.items() for x in (lang, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    # Hashed places, a window each; a text shorter than a window is taken from its start.
    room = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    cuts = [
        F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(20 + k)), room) + 1).cast("int"), F.lit(WINDOW))
        for k in range(CUTS)
    ]
    rows = (
        usable.where(F.col("lang").isin(list(seen)) & (draw < share[F.col("lang")]))
        .select("lang", F.array(*cuts).alias("cuts"), F.xxhash64("doc_id", F.lit(31)).alias("at"))
        .orderBy("at", "cuts")
        .limit(2 * per_language * len(seen))
        .collect()
    )
    return sorted(seen), [(r["lang"], cut) for r in rows for cut in r["cuts"]]


def fit(languages: list[str], rows: list[tuple[str, str]], seed: int = 7) -> ByteConvNet | None:
    """Train on (language, passage) pairs; every second passage is also cut short at random."""
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    number = {lang: k for k, lang in enumerate(languages)}
    windows, labels = [], []
    for k, (lang, cut) in enumerate(rows):
        raw = cut.encode().lower()
        windows.append(windows_of(raw)[0])
        labels.append(number[lang])
        if k % 2:
            start = int(rng.integers(0, max(1, len(raw) - 12)))
            windows.append(windows_of(raw[start : start + int(rng.integers(8, 80))])[0])
            labels.append(number[lang])
    labels = np.array(labels)
    weights = len(labels) / (len(languages) * np.maximum(1, np.bincount(labels, minlength=len(languages))))
    net = ByteConvNet(languages, seed)
    net.train(np.stack(windows), labels, weights[labels])
    return net


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def predict_texts(net: ByteConvNet | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each whole text."""
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    rows = [k for k, t in enumerate(texts) if net and has_letter(t)]
    if not rows:
        return langs, scores
    raws = [texts[k].encode().lower() for k in rows]
    parts = [windows_of(r) for r in raws]
    starts = np.cumsum([0] + [len(p) for p in parts])
    sizes = np.concatenate([np.minimum(WINDOW, len(r) - WINDOW * np.arange(len(p))) for r, p in zip(raws, parts, strict=True)])
    weighted = net.predict(np.concatenate(parts)) * sizes[:, None]
    means = np.add.reduceat(weighted, starts[:-1], 0) / np.add.reduceat(sizes, starts[:-1])[:, None]
    for k, mean in zip(rows, means, strict=True):
        best = int(mean.argmax())
        langs[k], scores[k] = net.languages[best], float(min(1.0, mean[best]))
    return langs, scores


def identify(docs: DataFrame, net: ByteConvNet | None, extra: str = "") -> DataFrame:
    """One row per document; `extra` names input columns to pass on, with types."""
    names = [c.split()[0] for c in extra.split(",")] if extra else []

    def run(batches):
        for batch, texts in text_slices(batches):
            langs, scores = predict_texts(net, texts)
            yield like(
                batch,
                lang_pred=pa.array(langs, pa.string()),
                score=pa.array(scores, pa.float64()),
                **{c: batch.column(c) for c in names},
            )

    columns = ["text", *[c for c in names if c != "text"]]
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)
    schema = "doc_id long, lang_pred string, score double"
    return chosen.mapInArrow(run, schema + (", " + extra if extra else ""))


def languages(
    docs: DataFrame, training, per_language: int = PER_LANGUAGE, max_languages: int = MAX_LANGUAGES, extra: str = ""
) -> DataFrame:
    """Learn from the rows where `training` holds, then predict every row of `docs`."""
    net = fit(*training_rows(docs, training, per_language, max_languages))
    return identify(docs, net, extra)
