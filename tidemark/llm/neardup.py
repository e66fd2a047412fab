"""Near-duplicate classes by DartMinHash signatures, banded joining and exact verification.

Signature. A document is its weighted set of five-word shingles; the weight is how often a shingle
occurs. Every unit strip of an element's weight receives hashed darts along the rank axis, a Poisson
process whose gaps are exponential draws from hashes of (element, strip, dart number); a last strip
of less than unit width keeps the darts that fall inside it. Darts with rank up to
theta = t / total weight, t = k ln k + 2 k, are thrown, each at a hashed coordinate, and the earliest
per coordinate is kept. If a coordinate stays empty, theta is doubled for that document. The
earliest dart per coordinate does not depend on theta, so two documents agree in a coordinate with
probability equal to their weighted Jaccard similarity, at a cost of the set's size plus t.

Classes. Equal texts are one representative first. Bands of the signature deal representatives to
buckets; in every bucket all members meet its centre, the member that collides most over all its
buckets, so a bucket of m gives fewer than m pairs. Pairs whose signatures agree too little are dropped
(at six standard errors below the threshold); of the rest, each document's best pair is verified first
on the exact weighted Jaccard similarity of the two texts, then every pair not yet implied by the
classes found. Buckets whose other members are still in several classes are then compared in full, cut
into blocks of bounded rows and bytes that meet in pairs. A block holds its members' shingles, so all pairs between
classes are verified where two blocks meet, and only links that join two classes there are handed on, fewer than
the blocks have members. So every pair of a bucket is verified, implied or dropped by its signatures. Classes are the connected components of the verified links, found by repeated least-label
steps on tables in the shared folder.

Defined cases: a text without words (null, empty, only white space) is a class of its own; texts of
fewer than five words are one shingle; rows that share an id are one document; rows with a null id
have a null class; equal rows fall together; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, bitmap, compact, in_bitmap, mix, text_slices, window_codes, word_codes
from tidemark.session import via_table

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
LEAST_AGREEMENT = 0.56  # of the coordinates; six standard errors below 0.8 at 120 coordinates
BLOCK = 512  # members of a bucket that are compared with as many others at once
BLOCK_BYTES = 8 << 20  # of their shingles, about
CACHE_WORDS = 200_000
GOLDEN = U64(0x9E3779B97F4A7C15)


def shingles(text: str | None, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle codes in order, and their counts."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, U64), np.empty(0, np.int64)
    return np.unique(window_codes(word_codes(words, cache), min(WORDS, len(words))), return_counts=True)


def unit(hashes: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((hashes >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def dart_signatures(elements: list[np.ndarray], weights: list[np.ndarray], k: int) -> np.ndarray:
    """One row of `k` 64-bit values per weighted set; a set without weight has zeros."""
    n = len(elements)
    best = np.full(n * k, np.inf)
    out = np.zeros(n * k, U64)
    totals = np.array([w.sum() for w in weights], float)
    theta = np.divide(k * np.log(k) + 2 * k, totals, out=np.zeros(n), where=totals > 0)
    todo = np.flatnonzero(totals > 0)
    while len(todo):
        sizes = np.array([len(elements[d]) for d in todo])
        owner = np.repeat(todo, sizes)
        code, weight = (np.concatenate([x[d] for d in todo]) for x in (elements, weights))
        strips = np.ceil(weight).astype(np.int64)
        owner, weight, code = (np.repeat(x, strips) for x in (owner, weight, code))
        strip = np.arange(len(owner)) - np.repeat(np.cumsum(strips) - strips, strips)
        width = np.minimum(1.0, weight - strip)
        seed = mix(code + GOLDEN * strip.astype(U64))
        rank, number = np.zeros(len(owner)), 0
        while len(owner):
            number += 1
            dart = mix(seed + U64(3 * int(GOLDEN) * number % (1 << 64)))
            rank = rank - np.log(unit(dart))
            inside = rank <= theta[owner]
            owner, seed, rank, dart, width = owner[inside], seed[inside], rank[inside], dart[inside], width[inside]
            hit = slice(None) if (width == 1).all() else unit(mix(dart + GOLDEN)) <= width
            place = owner[hit] * k + (mix(dart[hit] ^ GOLDEN) % U64(k)).astype(np.int64)
            np.minimum.at(best, place, rank[hit])
            first = rank[hit] == best[place]
            out[place[first]] = dart[hit][first]
        todo = todo[np.isinf(best.reshape(n, k)[todo]).any(1)]
        theta[todo] *= 2
    return out.reshape(n, k)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key per band."""
    keys = np.empty((len(signatures), bands), U64)
    for b in range(bands):
        total = np.full(len(signatures), U64(b + 1))
        for r in range(rows):
            total = mix(total * GOLDEN + signatures[:, b * rows + r])
        keys[:, b] = total
    return keys.astype(np.int64)


def signature_rows(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, digest, keys, sketch) of every document with words; 16 bits per coordinate are kept."""

    def run(batches):
        import hashlib

        cache: dict = {}
        for batch, texts in text_slices(batches):
            if len(cache) > CACHE_WORDS:
                cache.clear()
            sets = [shingles(t, cache) for t in texts]
            has = [k for k, (codes, _) in enumerate(sets) if len(codes)]
            signatures = dart_signatures([sets[k][0] for k in has], [sets[k][1] for k in has], bands * rows)
            keys = band_keys(signatures, bands, rows)
            small = signatures.astype("<u2")
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(has, pa.int64())),
                    "digest": pa.array([hashlib.md5(texts[k].encode()).digest() for k in has], pa.binary()),
                    "keys": pa.array(list(keys), pa.list_(pa.int64())),
                    "sketch": pa.array([s.tobytes() for s in small], pa.binary()),
                }
            )

    return docs.mapInArrow(run, "doc_id long, digest binary, keys array<long>, sketch binary")


def agreement(pairs: DataFrame) -> DataFrame:
    """Share of equal coordinates of two sketches."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1)
                    for c in ("sketch_a", "sketch_b")
                )
                yield pa.RecordBatch.from_pydict(
                    {"a": batch.column("a"), "b": batch.column("b"), "share": pa.array((a == b).mean(1))}
                )

    return pairs.mapInArrow(run, "a long, b long, share double")


def counted_apart(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A weighted set as a plain one: every repeat of a shingle is an element of its own; ascending."""
    repeat = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(mix(np.repeat(codes, counts) + GOLDEN * repeat.astype(U64)))


def element_sets(texts: DataFrame) -> DataFrame:
    """(rep, elements) from (doc_id, text): the packed elements of every text."""

    def run(batches):
        cache: dict = {}
        for batch, some in text_slices(batches):
            if len(cache) > CACHE_WORDS:
                cache.clear()
            made = [counted_apart(*shingles(t, cache)).tobytes() for t in some]
            yield pa.RecordBatch.from_pydict({"rep": batch["doc_id"], "elements": pa.array(made, pa.binary())})

    return texts.select("doc_id", "text").mapInArrow(run, "rep long, elements binary")


def block_links(rep, label, sketch, elements, left, right, similarity: float) -> list[tuple[int, int]]:
    """Links between members of two blocks that join all classes of them that any pair links.

    Pairs of one class, or of classes that links found here have joined, are not looked at.
    """
    sizes = np.array([len(e) for e in elements])
    flat = np.concatenate([elements[k] for k in right])
    owner = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    parent = {int(x): int(x) for x in label}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for x in left:
        share = (sketch[x] == sketch[right]).mean(1)
        mine = root(int(label[x]))
        near = [j for j in np.flatnonzero(share >= LEAST_AGREEMENT) if root(int(label[right[j]])) != mine]
        if not near:
            continue
        start, end = np.searchsorted(flat, elements[x]), np.searchsorted(flat, elements[x], "right")
        n = end - start
        places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - start, n)
        common = np.bincount(owner[places], minlength=len(right))
        for j in near:
            y = right[j]
            a, b = root(int(label[x])), root(int(label[y]))
            if a != b and common[j] >= similarity * (sizes[x] + sizes[y] - common[j]):
                parent[max(a, b)] = min(a, b)
                links.append((min(int(rep[x]), int(rep[y])), max(int(rep[x]), int(rep[y]))))
    return links


def crossing(members: DataFrame, labels: DataFrame, sketches: DataFrame, docs: DataFrame, similarity: float, rows: int) -> DataFrame:
    """(a, b): links that join the classes of the members (key, rep) of every bucket wherever any pair of it does."""
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("label", "rep").alias("label")
    )
    several = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    mixed = via_table(compact(named.join(several.select("key"), "key", "semi"), rows, waves=2), "mixed")
    ids = mixed.select(F.col("rep").alias("a"), F.col("rep").alias("b")).distinct()
    sets = via_table(compact(element_sets(needed_texts(docs, ids, rows)), rows, 20_000, waves=2), "elements")
    held = mixed.join(sets, "rep").join(sketches, "rep")
    sizes = mixed.join(sets.select("rep", F.length("elements").alias("size")), "rep").groupBy("key").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    dealt = (
        held.join(sizes, "key")
        .withColumn("own", F.pmod(F.xxhash64("key", "rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    )
    met = dealt.groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(
        F.collect_list(F.struct("rep", "label", "own", "sketch", "elements")).alias("rows")
    )

    def run(batches):
        for batch in batches:
            for i, j, some in zip(*(batch.column(c) for c in ("i", "j", "rows")), strict=True):
                block = some.values.flatten()
                rep, label, own = (np.asarray(c) for c in block[:3])
                sketch = np.frombuffer(b"".join(block[3].to_pylist()), "<u2").reshape(len(rep), -1)
                elements = [np.frombuffer(e, U64) for e in block[4].to_pylist()]
                left, right = np.flatnonzero(own == i.as_py()), np.flatnonzero(own == j.as_py())
                if len(left) and len(right):
                    links = block_links(rep, label, sketch, elements, left, right, similarity)
                    yield pa.RecordBatch.from_pydict(
                        {"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())}
                    )

    return met.select("i", "j", "rows").mapInArrow(run, "a long, b long").where("a < b").distinct()


def weighted_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(x[1][i], y[1][j]).sum())
    total = int(x[1].sum() + y[1].sum()) - common
    return common / total if total else 0.0


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose whole texts are similar enough; one row of two texts at a time."""

    def run(batches):
        cache: dict = {}
        for batch in batches:
            kept = []
            for k, (x, y) in enumerate(zip(batch.column("text_a"), batch.column("text_b"), strict=True)):
                if len(cache) > CACHE_WORDS:
                    cache.clear()
                if weighted_jaccard(shingles(x.as_py(), cache), shingles(y.as_py(), cache)) >= similarity:
                    kept.append(k)
            yield pa.RecordBatch.from_pydict({c: batch.column(c).take(pa.array(kept, pa.int64())) for c in ("a", "b")})

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node each node is connected with, over links (a, b).

    Every round takes the least label among neighbours, then the label of that label; a round's
    result is a table in the shared folder, and the loop ends when no label changes.
    """
    rows = links.count()
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    both = via_table(compact(both.distinct(), rows), "links")
    first = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label"))
    labels = via_table(compact(first, rows), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node").agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = lower.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")
        )
        stepped = via_table(compact(moved, rows), "labels")
        labels = stepped.select("node", "label")
        if stepped.where("old <> label").isEmpty():
            return labels


def merged(labels: DataFrame, links: DataFrame, rows: int) -> DataFrame:
    """`labels` (node, label) after the further links (a, b), which connect whole classes."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
    classes = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")
    )
    further = components(via_table(compact(classes.where("a <> b").distinct(), rows), "links"))
    moved = labels.join(further.select(F.col("node").alias("label"), F.col("label").alias("lower")), "label", "left")
    known = moved.select("node", F.coalesce("lower", "label").alias("label"))
    return via_table(compact(known.unionAll(further.join(labels, "node", "anti")), rows), "labels")


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, class_id) of every row: the least id among the documents it is linked with."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = chosen.where(F.col("doc_id").isNotNull())
    n_docs = named.count()
    signed = via_table(compact(signature_rows(named, bands, rows), n_docs, 50_000, waves=4), "signatures")
    # Equal texts have equal keys and sketches, so any of them will do.
    reps = signed.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")
    )
    reps = via_table(compact(reps, n_docs, 50_000, waves=2), "representatives")
    dealt = reps.select("rep", F.explode("keys").alias("key"))
    sizes = dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = via_table(compact(dealt.join(sizes, "key"), n_docs, waves=2), "met")
    weights = met.groupBy("rep").agg(F.sum("n").alias("weight"))
    centres = (
        met.select("key", "rep").join(weights, "rep").groupBy("key")
        .agg(F.max_by("rep", F.struct("weight", F.xxhash64("rep"), "rep")).alias("centre"))
    )
    members = via_table(compact(met.select("key", "rep").join(centres, "key").where("rep <> centre"), n_docs, waves=2), "members")
    pairs = members.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()
    sketches = reps.groupBy("rep").agg(F.first("sketch").alias("sketch"))
    agreed = agreement(
        pairs.join(sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("sketch_a")), "a")
        .join(sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("sketch_b")), "b")
        .select("a", "b", "sketch_a", "sketch_b")
    )
    close = via_table(compact(agreed.where(F.col("share") >= LEAST_AGREEMENT), n_docs, waves=2), "close")
    n_close = close.count()
    texts = needed_texts(named, close, n_close)
    best = close.groupBy("b").agg(F.max_by("a", F.struct("share", -F.col("a"))).alias("a")).select("a", "b")
    links = via_table(compact(verified(best, texts, similarity), n_close, waves=4), "links")
    labels = components(links)
    label_of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
    rest = (
        close.select("a", "b").join(best, ["a", "b"], "anti")
        .join(label_of("a"), "a", "left").join(label_of("b"), "b", "left")
        .where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b"))
    )
    more = via_table(compact(verified(rest, texts, similarity), n_close, waves=4), "links")
    if not more.isEmpty():
        labels = merged(labels, more, n_close)
    crossed = via_table(compact(crossing(members.select("key", "rep"), labels, sketches, named, similarity, n_docs), n_docs), "links")
    if not crossed.isEmpty():
        labels = merged(labels, crossed, n_docs)
    # Documents of one text share its representative; documents of several texts join their classes.
    copies = signed.join(reps.select("digest", "rep"), "digest").where("doc_id <> rep").select(
        F.col("doc_id").alias("node"), "rep"
    )
    copies = copies.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "node", F.coalesce("label", "rep").alias("label")
    )
    classes = labels.unionAll(copies).groupBy("node").agg(F.min("label").alias("label"))
    return chosen.select("doc_id").join(
        classes.select(F.col("node").alias("doc_id"), "label"), "doc_id", "left"
    ).select("doc_id", F.coalesce("label", "doc_id").alias("class_id"))


def needed_texts(docs: DataFrame, pairs: DataFrame, n_pairs: int) -> DataFrame:
    """Texts of the documents in `pairs`, one row per id and text.

    A bit table of fixed size drops most other documents before anything is shuffled.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    keep = bitmap(ids, "doc_id")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(keep, batch.column("doc_id").to_numpy(zero_copy_only=False))))

    some = docs.mapInArrow(run, "doc_id long, text string").join(ids, "doc_id", "semi")
    return via_table(compact(some.dropDuplicates(["doc_id", "text"]), n_pairs, 20_000, waves=2), "texts")
