"""Exact n-gram Jaccard self-join by a token-group matrix; documents come back with their component.

A document is the set of its distinct four-word shingles. Equal sets are one node. Two nodes link when
100 |x n y| >= 85 |x u y|; components are those of all links.

Order. Shingles are ordered by how often they occur, rare ones first: a fixed array of SLOTS counters over all
documents gives each shingle a class, and ties are broken by its code. Any fixed order keeps the join exact; this one keeps
shared passages out of the prefixes.

Groups. Similar nodes are brought together first: nodes that agree in a pair of minimum hashes meet the most
typical node of that bucket, are verified exactly, and verified links make first components. A component's nodes of like
size form groups of at most about GROUP_TOKENS shingles; a node linked with nothing so far is a group by itself. For
every group the union of its members' shingles is stored.

Matrix. Two sets that link share a shingle among the first |x| - ceil(0.85 |x|) + 1 of either, and from the first one
they share at least 85 (|x| + |y|) / 185 shingles of both must follow. The token-group matrix has a row for each shingle that such
prefixes of a group's members hold, with the sizes of these members and how much of them follows; shingles that only one
component holds are left out, as a component needs no more links within itself. Queries are the nodes' prefixes; of two
components the smaller one asks. A query that meets a group is held against the group's token union: a member of size s can
only link if the query shares at least 85 (|x| + s) / 185 shingles with the union. The union is first a bit table of fixed
size, which no shingle of the union is missing from, and for groups that pass it the union itself. Only groups that reach
the bound for their least size are opened, and their members compared exactly; one link between a query and a group is
enough, as the group is one component.

So every pair of different components is linked or excluded by exact bounds; the minimum hashes only decide how little is left to the
matrix. A cluster whose texts are alike but not linked by any path costs queries x groups.

Defined cases: a text without words (null, empty, only white space) has no shingles and is alone; with fewer than four words the
whole sequence is one shingle; every row stands for itself, also if it shares its id, and its component_id is the least id of the rows
it is connected with; a row with a null id has a null component and links nothing; an empty table gives an empty table; only doc_id
and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, WordCodes, bitmap, compact, in_bitmap, mix, text_slices, window_codes
from tidemark.llm.neardup import components, merged
from tidemark.session import via_table

WORDS = 4
SHARE = 85  # of 100
SLOTS, CHUNK = 1 << 20, 1 << 14
KEYS = 6  # buckets of a node; each agrees in two minimum hashes
LEAST_AGREEMENT = 7  # of the 2 * KEYS minimum hashes, before the two sets are fetched
GROUP_TOKENS = 1 << 15
BITS = 4096  # of the bit table of a set or union
SEEDS = np.arange(1, 2 * KEYS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, words: WordCodes) -> np.ndarray:
    """Distinct shingle codes in ascending order."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, U64)
    return np.unique(window_codes(words.of(found), min(WORDS, len(found))))


def slot_classes(docs: DataFrame) -> np.ndarray:
    """How frequent the shingles of every slot are, as a class of 0 to 255.

    Each task counts into one array and hands it on in pieces; pieces are summed as they arrive, so
    what a task holds and what reaches the driver has a fixed size.
    """
    kind = "chunk int, counts binary"

    def pieces(total: np.ndarray):
        for c in range(SLOTS // CHUNK):
            part = total[c * CHUNK : (c + 1) * CHUNK]
            if part.any():
                yield pa.RecordBatch.from_pydict(
                    {"chunk": pa.array([c], pa.int32()), "counts": pa.array([part.astype("<i8").tobytes()], pa.binary())}
                )

    def count(batches):
        words, total = WordCodes(), np.zeros(SLOTS, np.int64)
        for _, texts in text_slices(batches):
            codes = [shingle_set(t, words) for t in texts]
            total += np.bincount((np.concatenate(codes) % U64(SLOTS)).astype(np.int64), minlength=SLOTS)
        yield from pieces(total)

    def add(batches):
        sums: dict = {}
        for batch in batches:
            for c, counts in zip(batch["chunk"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                sums[c] = sums.get(c, 0) + np.frombuffer(counts, "<i8")
        for c, total in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"chunk": pa.array([c], pa.int32()), "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())}
            )

    out = np.zeros(SLOTS)
    rows = docs.select("text").mapInArrow(count, kind).repartition(SLOTS // CHUNK, "chunk").mapInArrow(add, kind)
    for row in rows.collect():  # SLOTS counters in all
        out[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], "<i8")
    return np.minimum(4 * np.log2(out + 1), 255).astype(np.uint8)


def prefix_size(n: int) -> int:
    """How many of a set's rarest shingles a link must meet one of."""
    return n - -(-SHARE * n // 100) + 1


def least_overlap(n, other):
    """Shingles that sets of these sizes share at least if they link."""
    return -(-SHARE * (n + other) // (100 + SHARE))


def signatures(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """Per row: size and digest of its set, its prefix (rarest first), minimum hashes and how usual its shingles are."""
    kind = "doc_id long, digest binary, n long, prefix array<long>, hashes array<long>, usual double"

    def run(batches):
        words = WordCodes()
        for batch, texts in text_slices(batches):
            sets = [shingle_set(t, words) for t in texts]
            digests, prefixes, hashes, usual = [], [], [], []
            for codes in sets:
                if not len(codes):
                    for column in (digests, prefixes, hashes, usual):
                        column.append(None)
                    continue
                cls = classes[codes % U64(SLOTS)]
                rare = np.argsort(cls, kind="stable")[: prefix_size(len(codes))]  # codes ascend within a class
                digests.append(hashlib.md5(codes.tobytes()).digest())
                prefixes.append(codes[rare].view(np.int64))
                hashes.append(np.array([mix(codes + s).min() for s in SEEDS]).view(np.int64))
                usual.append(float(cls.mean()))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "digest": pa.array(digests, pa.binary()),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "prefix": pa.array(prefixes, pa.list_(pa.int64())),
                    "hashes": pa.array(hashes, pa.list_(pa.int64())),
                    "usual": pa.array(usual, pa.float64()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(run, kind)


def sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, rows: int, bits: bool = False) -> DataFrame:
    """(node, n, codes) of the wanted nodes, from their texts; with `bits`, the bit table of the codes in their place.

    A bit table of fixed size drops most other documents before they are cut into shingles.
    """
    needed = nodes.join(wanted.select("node").distinct(), "node").select("node", "doc_id", "digest")
    keep = bitmap(needed, "doc_id")

    def run(batches):
        words = WordCodes()
        for batch, texts in text_slices(b.filter(pa.array(in_bitmap(keep, b["doc_id"].to_numpy(zero_copy_only=False)))) for b in batches):
            sets = [shingle_set(t, words) for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "digest": pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "codes": pa.array([(bit_table(s) if bits else s).tobytes() for s in sets], pa.binary()),
                }
            )

    made = docs.mapInArrow(run, "doc_id long, digest binary, n long, codes binary")
    some = made.join(needed, ["doc_id", "digest"]).select("node", "n", "codes").dropDuplicates(["node"])
    return via_table(compact(some, rows, 20_000, waves=2), "sets")


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two ascending sets; the smaller one is looked up in the larger one."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = shared(x, y)
    return 100 * both >= SHARE * (len(x) + len(y) - both)


def codes_of(cell) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), U64)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link."""

    def run(batches):
        for batch in batches:
            kept = [linked(codes_of(x), codes_of(y)) for x, y in zip(batch["x"], batch["y"], strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    of = lambda c, to: sets.select(F.col("node").alias(c), F.col("codes").alias(to))
    return pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def star_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): every node and the most typical one of each of its buckets, if their hashes agree enough."""
    key = F.expr(
        f"transform(sequence(0, {KEYS - 1}), k -> xxhash64(k, element_at(hashes, 2 * k + 1), element_at(hashes, 2 * k + 2)))"
    )
    dealt = nodes.select("node", "n", "usual", F.explode(key).alias("key"))
    heads = (
        dealt.groupBy("key").agg(F.max_by("node", F.struct("usual", "n", "node")).alias("head"), F.count("*").alias("m"))
        .where("m > 1").drop("m")
    )
    pairs = dealt.join(heads, "key").where("node <> head").select("node", "head").distinct()
    hashes = nodes.select("node", "hashes")
    agreed = F.aggregate(
        F.zip_with("hashes", "head_hashes", lambda x, y: (x == y).cast("int")), F.lit(0), lambda a, x: a + x
    )
    return (
        pairs.join(hashes, "node")
        .join(hashes.select(F.col("node").alias("head"), F.col("hashes").alias("head_hashes")), "head")
        .where(agreed >= LEAST_AGREEMENT)
        .select(F.col("node").alias("a"), F.col("head").alias("b"))
    )


def in_groups(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, n, comp, part, weight, prefix): components cut into groups by size class and number of shingles."""
    placed = (
        nodes.select("node", "n").join(labels, "node", "left").withColumn("comp", F.coalesce("label", "node")).drop("label")
        .withColumn("kind", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / SHARE))))
    )
    sizes = placed.groupBy("comp", "kind").agg(F.ceil(F.sum("n") / GROUP_TOKENS).alias("parts"), F.count("*").alias("m"))
    weights = sizes.groupBy("comp").agg(F.sum("m").alias("weight"))
    return (
        placed.join(sizes.drop("m"), ["comp", "kind"]).join(weights, "comp")
        .withColumn("part", F.shiftleft("kind", 40) + F.pmod(F.xxhash64("node"), F.col("parts")))
        .select("node", "n", "comp", "part", "weight").join(nodes.select("node", "prefix"), "node")
    )


def shared_tokens(members: DataFrame) -> DataFrame:
    """(token, node, n, rest, comp, part, weight) for the prefix shingles that more than one component holds.

    `rest` is the number of the node's shingles from this one on.
    """
    held = members.select("comp", F.explode("prefix").alias("token")).groupBy("token").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high")
    )
    several = via_table(held.where("low < high").select("token"), "tokens")
    keep = bitmap(several, "token")
    kind = "token long, node long, n long, rest long, comp long, part long, weight long"

    def run(batches):
        for batch in batches:
            prefix = batch["prefix"]
            token = prefix.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(prefix.offsets.to_numpy())
            row = np.repeat(np.arange(len(lengths)), lengths)
            place = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            hit = np.flatnonzero(in_bitmap(keep, token))
            rest = batch.select(["node", "n", "comp", "part", "weight"]).take(pa.array(row[hit]))
            follow = rest["n"].to_numpy() - place[hit]
            yield pa.RecordBatch.from_pydict(
                {
                    "token": pa.array(token[hit]), "node": rest["node"], "n": rest["n"], "rest": pa.array(follow, pa.int64()),
                    "comp": rest["comp"], "part": rest["part"], "weight": rest["weight"],
                }
            )

    return via_table(members.mapInArrow(run, kind).join(several, "token", "semi"), "probes")


def candidates(probes: DataFrame) -> DataFrame:
    """(node, comp, part): queries and the groups of other components that their prefixes meet in the matrix."""
    matrix = probes.groupBy("token", "comp", "part").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("weight").alias("weight"), F.max("rest").alias("follow")
    )
    asked = probes.select("token", "node", F.col("n").alias("x"), "rest", F.col("comp").alias("own"), F.col("weight").alias("own_weight"))
    smaller = F.struct("own_weight", "own") < F.struct("weight", "comp")
    sizes = (100 * F.col("x") >= SHARE * F.col("low")) & (100 * F.col("high") >= SHARE * F.col("x"))
    least = F.greatest("low", F.ceil(SHARE * F.col("x") / 100))  # the smallest member that can link
    enough = (100 + SHARE) * F.least("rest", "follow") >= SHARE * (F.col("x") + least)
    return asked.join(matrix, "token").where(smaller & sizes & enough).select("node", "comp", "part").distinct()


def bit_table(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(BITS, bool)
    out[(codes % U64(BITS)).astype(np.int64)] = True
    return np.packbits(out)


def reachable(n: np.ndarray, low: np.ndarray, overlap: np.ndarray) -> np.ndarray:
    """Whether queries of n shingles that share at most `overlap` with a union can link with a member of `low` or more."""
    return overlap >= least_overlap(n, np.maximum(low, -(-SHARE * n // 100)))


def likely(asked: DataFrame, members: DataFrame, docs: DataFrame, nodes: DataFrame, rows: int) -> DataFrame:
    """The (node, comp, part) that the bit tables of query and token union leave: a bit of the query that the union
    lacks is a shingle that it lacks."""
    groups = asked.select("comp", "part").distinct()
    inside = members.select("node", "n", "comp", "part").join(groups, ["comp", "part"])
    wanted = asked.select("node").unionAll(inside.select("node"))
    tables = sets_of(docs, nodes, wanted, rows, bits=True)

    def unite(batches):
        for batch in batches:
            unions = [np.bitwise_or.reduce(np.frombuffer(b"".join(t.as_py()), np.uint8).reshape(-1, BITS // 8)).tobytes() for t in batch["tables"]]
            yield pa.RecordBatch.from_pydict({**{c: batch[c] for c in ("comp", "part", "low")}, "union": pa.array(unions, pa.binary())})

    gathered = inside.join(tables.select("node", "codes"), "node").groupBy("comp", "part").agg(
        F.min("n").alias("low"), F.collect_list("codes").alias("tables")
    )
    unions = gathered.mapInArrow(unite, "comp long, part long, low long, union binary")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, union = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("codes", "union"))
                n, low = batch["n"].to_numpy(), batch["low"].to_numpy()
                kept = reachable(n, low, n - np.bitwise_count(x & ~union).sum(1, dtype=np.int64))
                yield batch.select(["node", "comp", "part"]).filter(pa.array(kept))

    joined = asked.join(tables, "node").join(unions, ["comp", "part"])
    return joined.select("node", "comp", "part", "n", "low", "codes", "union").mapInArrow(run, "node long, comp long, part long")


def grouped_sets(members: DataFrame, wanted: DataFrame, sets: DataFrame) -> DataFrame:
    """(comp, part, low, union, members): the token union and the members' sets of every wanted group."""
    some = members.select("node", "comp", "part").join(wanted.select("comp", "part").distinct(), ["comp", "part"])
    gathered = some.join(sets, "node").groupBy("comp", "part").agg(
        F.min("n").alias("low"), F.collect_list(F.struct("node", "codes")).alias("members")
    )

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                codes = batch["members"][k].values.field(1)
                union = np.unique(np.frombuffer(b"".join(codes.to_pylist()), U64))
                one = batch.slice(k, 1)
                yield pa.RecordBatch.from_pydict(
                    {"comp": one["comp"], "part": one["part"], "low": one["low"], "union": pa.array([union.tobytes()], pa.binary()), "members": one["members"]}
                )

    return via_table(
        gathered.select("comp", "part", "low", "members").mapInArrow(
            run, "comp long, part long, low long, union binary, members array<struct<node: long, codes: binary>>"
        ),
        "groups",
    )


def qualifying(asked: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """The (node, comp, part) whose group's token union shares enough with the query."""

    def run(batches):
        for batch in batches:
            kept = []
            for x, union, low in zip(batch["codes"], batch["union"], batch["low"].to_pylist(), strict=True):
                x = codes_of(x)
                kept.append(bool(reachable(len(x), low, shared(x, codes_of(union)))))
            yield batch.select(["node", "comp", "part"]).filter(pa.array(kept, pa.bool_()))

    rows = asked.join(sets.select("node", "codes"), "node").join(groups.select("comp", "part", "low", "union"), ["comp", "part"])
    return rows.select("node", "comp", "part", "codes", "low", "union").mapInArrow(run, "node long, comp long, part long")


def opened(asked: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): a query and the first member of an opened group that it links with."""

    def run(batches):
        for batch in batches:
            a, b = [], []
            for node, x, members in zip(batch["node"].to_pylist(), batch["codes"], batch["members"], strict=True):
                x, inside = codes_of(x), members.values
                for other, y in zip(inside.field(0), inside.field(1), strict=True):
                    if linked(x, codes_of(y)):
                        a.append(node)
                        b.append(other.as_py())
                        break
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = asked.join(sets.select("node", "codes"), "node").join(groups.select("comp", "part", "members"), ["comp", "part"])
    return rows.select("node", "codes", "members").mapInArrow(run, "a long, b long")


def connected(docs: DataFrame, nodes: DataFrame, n_nodes: int) -> DataFrame:
    """(node, label) of the nodes that link with another one."""
    pairs = via_table(compact(star_pairs(nodes), n_nodes, waves=2), "pairs")
    n_pairs = pairs.count()
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    sets = sets_of(docs, nodes, wanted, n_pairs)
    links = via_table(compact(verified(pairs, sets), n_pairs, waves=2), "links")
    labels = components(links)
    members = via_table(compact(in_groups(nodes, labels), n_nodes, 50_000, waves=2), "members")
    asked = via_table(compact(candidates(shared_tokens(members)), n_nodes, waves=2), "asked")
    n_asked = asked.count()
    if not n_asked:
        return labels
    asked = via_table(compact(likely(asked, members, docs, nodes, n_asked), n_asked, waves=2), "likely")
    inside = members.join(asked.select("comp", "part").distinct(), ["comp", "part"]).select("node")
    sets = sets_of(docs, nodes, asked.select("node").unionAll(inside), n_asked)
    groups = grouped_sets(members, asked, sets)
    enough = via_table(compact(qualifying(asked, groups, sets), n_asked, waves=2), "enough")
    more = via_table(compact(opened(enough, groups, sets), n_asked, waves=2), "links")
    return labels if more.isEmpty() else merged(labels, more, n_asked)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_docs = chosen.count()
    signed = via_table(compact(signatures(chosen, slot_classes(chosen)), n_docs, 50_000, waves=4), "signatures")
    usable = signed.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    nodes = usable.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n", "prefix", "hashes", "usual")]
    )
    nodes = via_table(compact(nodes, n_docs, 50_000, waves=2).withColumn("node", F.monotonically_increasing_id()), "nodes")
    named = chosen.where("doc_id IS NOT NULL")
    labels = connected(named, nodes, n_docs)
    placed = nodes.select("digest", "doc_id", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    known = placed.select("digest", "label").join(least, "label").select("digest", "component_id")
    found = signed.select("doc_id", "n", "digest").join(known, "digest", "left")
    own: Column = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
