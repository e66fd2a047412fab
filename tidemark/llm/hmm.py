"""Hidden Markov language model over whole texts, trained and applied on Spark.

Tokens are the words of a text, A-Z lowered, and one end token. A hidden state emits a word class; the
class emits the word by its share of the class's training tokens. The commonest `own_classes` tokens
are classes of their own, all others fall into `suffix_classes` classes by a hash of their last three
bytes, so the model has a fixed size while word counts stay a table as large as the vocabulary.

Training: one pass counts the training tokens; one pass writes every text as class numbers; then
`rounds` of Baum-Welch, in which every partition adds up its expected counts and Spark sums them. In
training, sequences are cut into pieces of SEGMENT tokens; all tokens count. Scoring runs the scaled
forward recursion over the whole uncut sequence.

Word counts are looked up in two ways with the same outcome: the `head` commonest tokens (a bounded
list) inside the task, all others by a join on the token, in which no token can be frequent.

Defined cases: null or empty text is the end token alone; a null id is neither trained on nor held
out; without training rows all counts are 0 and the model is uniform; rows that share an id are
scored one by one; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices
from tidemark.session import via_table

END = b""  # no word is empty
STATES = 6
ROUNDS = 3
HEAD = 100_000
OWN_CLASSES = 2_000
SUFFIX_CLASSES = 2_048
SEGMENT = 2_048
AT_ONCE = 300_000  # tokens in one run of the recursions
GATHERED = 1_500_000  # tokens sorted by sequence length together
COUNTED = 300_000  # distinct tokens a task sums up before it passes them on


def tokens_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c) over all tokens of `docs`; summed inside each task first."""

    def run(batches):
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_pydict(
                {"token": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())}
            )

        for _, texts in text_slices(batches):
            for text in texts:
                counts.update(tokens_of(text))
            if len(counts) > COUNTED:
                yield out()
                counts.clear()
        yield out()

    return docs.mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("c"))


class Vocabulary:
    """The bounded part of the vocabulary, and the classes' sizes."""

    def __init__(self, head: dict[bytes, int], total: int, distinct: int, own: list[bytes], sizes: np.ndarray):
        self.head, self.total, self.distinct = head, total, distinct
        self.own = {token: k for k, token in enumerate(own)}
        self.suffix_classes = len(sizes) - len(own)
        self.sizes = sizes  # training tokens of each class
        self.n_classes = len(sizes)
        self.shares = np.zeros(len(sizes))  # log10 of what a token's count + 1 is divided by; 0 for own classes

    def class_of(self, token: bytes) -> int:
        own = self.own.get(token)
        return len(self.own) + zlib.crc32(token[-3:]) % self.suffix_classes if own is None else own


def vocabulary(counts: DataFrame, head: int, own_classes: int, suffix_classes: int) -> Vocabulary:
    """Counts of at most `head` of the commonest tokens and the sizes of the classes reach the driver.

    The head is all tokens above a count, found from a histogram of the counts' logarithms, so no
    task sends more than its share of it.
    """
    whole = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    step = F.floor(F.log2("c") * 32)
    least, taken = None, 0
    for r in counts.groupBy(step.alias("at")).agg(F.count("*").alias("v")).orderBy(F.desc("at")).collect():
        if taken + r["v"] > head:
            break
        least, taken = r["at"], taken + r["v"]
    top = [] if least is None else counts.where(step >= least).collect()
    known = {bytes(r["token"]): r["c"] for r in sorted(top, key=lambda r: (-r["c"], bytes(r["token"])))}
    own = list(dict.fromkeys([END, *list(known)[:own_classes]]))
    suffix = F.pmod(F.crc32(F.substring("token", -3, 3)), F.lit(suffix_classes)).cast("int")
    rows = counts.groupBy(suffix.alias("at")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    sizes, kinds = np.zeros(suffix_classes), np.zeros(suffix_classes)
    for r in rows:
        sizes[r["at"]], kinds[r["at"]] = r["n"], r["v"]
    for token in own:  # counted under their suffix above, but classes of their own
        if token in known:
            at = zlib.crc32(token[-3:]) % suffix_classes
            sizes[at] -= known[token]
            kinds[at] -= 1
    own_sizes = np.array([known.get(t, 0) for t in own], float)
    out = Vocabulary(known, whole["n"] or 0, whole["v"], own, np.concatenate([own_sizes, sizes]))
    out.shares[len(own) :] = np.log10(sizes + kinds + 1)  # one more for all unknown words of the class
    return out


ENCODED = (
    "row_id long, doc_id long, training boolean, n_tokens long, known long, base double, inner double, "
    "classes binary, tail array<struct<token: binary, n: long>>"
)


def encoded(docs: DataFrame, training: Column, words: Vocabulary) -> DataFrame:
    """Every text as class numbers, with the sums over its head tokens and its other tokens.

    `base` is the sum of log10(c + 1) over head tokens; `inner` that over head tokens in shared
    classes less the class terms of all tokens.
    """

    def run(batches):
        cache: dict[bytes, tuple] = {}
        row = (TaskContext.get().partitionId() + 1) << 40
        head, own, shares = words.head, words.own, words.shares

        def facts(token):
            c = head.get(token)
            at = words.class_of(token)
            log = math.log10(c + 1) if c is not None else 0.0
            return at, log, (0.0 if token in own else log) - shares[at], c is not None

        for batch, texts in text_slices(batches):
            if len(cache) > 400_000:
                cache.clear()
            out = []
            for text in texts:
                tokens = tokens_of(text)
                for t in set(tokens).difference(cache):
                    cache[t] = facts(t)
                found = list(map(cache.__getitem__, tokens))
                at, log, inner, known = zip(*found, strict=True)
                n_known = sum(known)
                tail = Counter(t for t, k in zip(tokens, known, strict=True) if not k) if n_known < len(tokens) else {}
                out.append((len(tokens), n_known, math.fsum(log), math.fsum(inner), np.array(at, "<u2").tobytes(), tail))
            rows = np.arange(row, row + len(texts))
            row += len(texts)
            tails = [item for o in out for item in o[5].items()]
            ends = np.append(0, np.cumsum([len(o[5]) for o in out])).astype(np.int32)
            kind = [pa.array([t for t, _ in tails], pa.binary()), pa.array([n for _, n in tails], pa.int64())]
            yield pa.RecordBatch.from_pydict(
                {
                    "row_id": pa.array(rows, pa.int64()),
                    "doc_id": batch.column("doc_id"),
                    "training": batch.column("training"),
                    "n_tokens": pa.array([o[0] for o in out], pa.int64()),
                    "known": pa.array([o[1] for o in out], pa.int64()),
                    "base": pa.array([o[2] for o in out], pa.float64()),
                    "inner": pa.array([o[3] for o in out], pa.float64()),
                    "classes": pa.array([o[4] for o in out], pa.binary()),
                    "tail": pa.ListArray.from_arrays(
                        pa.array(ends), pa.StructArray.from_arrays(kind, names=["token", "n"])
                    ),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", training.alias("training"))
    return rows.mapInArrow(run, ENCODED)


class Hmm:
    """Start (K), transition (K, K) and emission (classes, K) probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @staticmethod
    def first(states: int, sizes: np.ndarray, seed: int = 5) -> Hmm:
        rng = np.random.default_rng(seed)
        emit = (sizes + 1)[:, None] * rng.random((len(sizes), states)) ** 2 + 1e-9
        move = np.full((states, states), 0.4 / max(1, states - 1)) + np.eye(states) * 0.6
        return Hmm(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))

    def forward(self, packed: Packed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled forward values, their scales and the emissions, in the packed layout."""
        seen = self.emit[packed.values]
        alpha, scale = np.empty_like(seen), np.empty(len(seen))
        now = self.start * seen[: packed.active[0]]
        for t, (at, n) in enumerate(zip(packed.offsets.tolist(), packed.active.tolist(), strict=True)):
            if t:
                now = (now[:n] @ self.move) * seen[at : at + n]
            total = now.sum(1)
            now = now / total[:, None]
            alpha[at : at + n], scale[at : at + n] = now, total
        return alpha, scale, seen

    def log10_likelihoods(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 likelihood of each non-empty sequence; memory is bounded by AT_ONCE tokens."""
        out = np.zeros(len(sequences))
        for some in groups([len(s) for s in sequences]):
            if len(some) == 1 and len(sequences[some[0]]) > AT_ONCE:
                out[some[0]] = self._long(sequences[some[0]])
                continue
            packed = Packed([sequences[k] for k in some])
            _, scale, _ = self.forward(packed)
            out[some] = np.bincount(packed.owner, weights=np.log10(scale), minlength=len(some))
        return out

    def _long(self, sequence: np.ndarray) -> float:
        """One long sequence in blocks that hand over their last forward value."""
        total, carried = 0.0, None
        for at in range(0, len(sequence), AT_ONCE):
            part = Packed([sequence[at : at + AT_ONCE]])
            begin = self if carried is None else Hmm(carried @ self.move, self.move, self.emit)
            alpha, scale, _ = begin.forward(part)
            total, carried = total + float(np.log10(scale).sum()), alpha[-1]
        return total

    def expected(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Baum-Welch counts of the sequences, flat: start, transitions, emissions."""
        states, classes = len(self.start), len(self.emit)
        start, move = np.zeros(states), np.zeros((states, states))
        emit = np.zeros((states, classes))
        for some in groups([len(s) for s in sequences]):
            packed = Packed([sequences[k] for k in some])
            alpha, scale, seen = self.forward(packed)
            beta = np.ones_like(alpha)
            offsets, active = packed.offsets.tolist(), packed.active.tolist()
            ahead = seen / scale[:, None]  # becomes emission x beta / scale of each position
            for t in range(len(active) - 2, -1, -1):
                at, after, n = offsets[t], offsets[t + 1], active[t + 1]
                ahead[after : after + n] *= beta[after : after + n]
                beta[at : at + n] = ahead[after : after + n] @ self.move.T
            first = active[0]
            here = np.concatenate([np.arange(a, a + n) for a, n in zip(offsets[:-1], active[1:], strict=True)] or [[]]).astype(int)
            move += self.move * (alpha[here].T @ ahead[first:])
            gamma = alpha * beta
            start += gamma[:first].sum(0)
            for k in range(states):
                emit[k] += np.bincount(packed.values, weights=gamma[:, k], minlength=classes)
        return np.concatenate([start, move.ravel(), emit.ravel()])

    def updated(self, counts: np.ndarray, sizes: np.ndarray) -> Hmm:
        """The next model; every class keeps a little of its share in every state."""
        k = len(self.start)
        start, move = counts[:k] + 1e-3, counts[k : k + k * k].reshape(k, k) + 1e-3
        prior = (sizes + 1) / (sizes + 1).sum()
        emit = counts[k + k * k :].reshape(k, -1).T + prior[:, None]
        return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


class Packed:
    """Sequences, longest first, laid out step by step: all first tokens, all second ones, ..."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array(list(map(len, sequences)))
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        self.active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
        self.offsets = np.cumsum(self.active) - self.active
        flat = np.concatenate([sequences[k] for k in order]).astype(np.int64)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = self.offsets[step] + np.repeat(np.arange(len(lengths)), lengths)
        self.values, self.owner = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
        self.values[place], self.owner[place] = flat, np.repeat(order, lengths)


def groups(lengths: list[int]):
    """Indexes of sequences of about equal length, at most AT_ONCE tokens a group unless it is one."""
    some, size = [], 0
    for k in np.argsort(lengths, kind="stable").tolist():
        if some and size + lengths[k] > AT_ONCE:
            yield some
            some, size = [], 0
        some.append(k)
        size += lengths[k]
    if some:
        yield some


def sequences_of(batches, cut: int | None):
    """(rows of batches, their class sequences) in pieces of about GATHERED tokens."""
    for batch in batches:
        column = batch.column("classes")
        start, size = 0, 0
        lengths = np.asarray(pa.compute.binary_length(column)) // 2
        for k, n in enumerate([*lengths.tolist(), None]):
            if n is None or (size and size + n > GATHERED):
                found = [np.frombuffer(b, "<u2") for b in column.slice(start, k - start).to_pylist()]
                if cut:
                    found = [s[i : i + cut] for s in found for i in range(0, len(s), cut)]
                yield batch.slice(start, k - start), found
                start, size = k, 0
            size += n or 0


def expected_counts(rows: DataFrame, model: Hmm) -> np.ndarray:
    """The sum over all partitions of their Baum-Welch counts; one number per parameter arrives."""
    size = len(model.start) * (1 + len(model.start) + len(model.emit))

    def run(batches):
        total = np.zeros(size)
        for _, sequences in sequences_of(batches, SEGMENT):
            total += model.expected(sequences)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at.astype(np.int32)), "value": pa.array(total[at])})

    summed = rows.select("classes").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    found = summed.toPandas()
    out = np.zeros(size)
    out[found["at"].to_numpy(int)] = found["value"].to_numpy(float)
    return out


def scored(rows: DataFrame, model: Hmm) -> DataFrame:
    names = "row_id doc_id n_tokens known base inner".split()

    def run(batches):
        for batch, sequences in sequences_of(batches, None):
            yield pa.RecordBatch.from_pydict(
                {**{c: batch.column(c) for c in names}, "path": pa.array(model.log10_likelihoods(sequences))}
            )

    return rows.select(*names, "classes").mapInArrow(
        run, "row_id long, doc_id long, n_tokens long, known long, base double, inner double, path double"
    )


def language_model(
    docs: DataFrame,
    training: Column,
    states: int = STATES,
    rounds: int = ROUNDS,
    head: int = HEAD,
    own_classes: int = OWN_CLASSES,
    suffix_classes: int = SUFFIX_CLASSES,
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    counts = via_table(token_counts(docs.where(training).select("text")), "counts")
    words = vocabulary(counts, head, own_classes, suffix_classes)
    rows = via_table(encoded(docs, training, words), "classes")
    model = Hmm.first(states, words.sizes)
    learning = rows.where("training")
    for _ in range(rounds):
        model = model.updated(expected_counts(learning, model), words.sizes)
    tail = rows.select("row_id", F.explode("tail").alias("t")).select("row_id", "t.token", "t.n")
    rare = (
        tail.join(counts, "token")
        .groupBy("row_id")
        .agg(F.sum("n").alias("rare"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_sum"))
    )
    rare_sum = F.coalesce("rare_sum", F.lit(0.0))
    return scored(rows, model).join(rare, "row_id", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rare", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + rare_sum - F.col("n_tokens") * math.log10(words.total + words.distinct + 1)).alias("base_score"),
        (F.col("path") + F.col("inner") + rare_sum).alias("score"),
    )
