"""Pessimistic error pruning of a fitted decision tree.

The tree is the one Spark has grown. One scoring pass over the training rows counts the classes at every leaf, and
those counts, leaves x classes numbers, are summed up the tree on the driver. A subtree becomes a leaf if the errors
to expect of that leaf are no more than those to expect of its own leaves. The errors to expect of a node are the upper
confidence limit of the errors seen, as C4.5 takes it (Quinlan, "C4.5: Programs for Machine Learning", 1993). The pruned tree scores
through the grown one: each of its leaves answers for the pruned node it lies under.

A leaf that no training row reaches expects no errors. Without training rows the tree becomes one leaf that answers
the first class.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import sqrt
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONFIDENCE = 0.25
MARGIN = 0.1  # errors by which a leaf may be worse than its subtree
MAX_LEAVES = 1 << 16  # counts of so many leaves reach the driver


@dataclass
class Node:
    """A node of the grown tree: leaves are numbered from the left, `counts` holds training rows per class."""

    left: Node | None = None
    right: Node | None = None
    leaf: int | None = None
    counts: list[int] | None = None

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()


def extra_errors(n: float, errors: float, confidence: float = CONFIDENCE) -> float:
    """How many more errors to expect among `n` rows than the `errors` seen: to the upper confidence limit."""
    if n <= 0 or confidence > 0.5:
        return 0.0
    if errors < 1:
        none = n * (1 - confidence ** (1 / n))
        return none if errors == 0 else none + errors * (extra_errors(n, 1, confidence) - none)
    if errors + 0.5 >= n:
        return max(n - errors, 0.0)
    z = NormalDist().inv_cdf(1 - confidence)
    f = (errors + 0.5) / n
    limit = (f + z * z / (2 * n) + z * sqrt(f / n - f * f / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return limit * n - errors


def expected_errors(counts: list[int], confidence: float = CONFIDENCE) -> float:
    n = sum(counts)
    errors = n - max(counts, default=0)
    return errors + extra_errors(n, errors, confidence)


def grown(model) -> Node:
    """The shape of a fitted Spark tree; its leaves are numbered as its leaf column numbers them."""
    numbers = iter(range(1 << 62))

    def walk(node) -> Node:
        if node.getClass().getSimpleName() == "LeafNode":
            return Node(leaf=next(numbers))
        left = walk(node.leftChild())
        return Node(left, walk(node.rightChild()))

    return walk(model._java_obj.rootNode())


def fill(node: Node, at_leaf: dict[int, list[int]], n_classes: int) -> None:
    if node.left is None:
        node.counts = at_leaf.get(node.leaf, [0] * n_classes)
        return
    fill(node.left, at_leaf, n_classes)
    fill(node.right, at_leaf, n_classes)
    node.counts = [a + b for a, b in zip(node.left.counts, node.right.counts, strict=True)]


def pruned(node: Node, confidence: float = CONFIDENCE, margin: float = MARGIN) -> tuple[Node, float]:
    """The pruned tree and the errors to expect of it; subtrees are pruned before what holds them."""
    as_leaf = expected_errors(node.counts, confidence)
    if node.left is None:
        return node, as_leaf
    left, left_errors = pruned(node.left, confidence, margin)
    right, right_errors = pruned(node.right, confidence, margin)
    if as_leaf <= left_errors + right_errors + margin:
        return Node(leaf=node.leaves()[0].leaf, counts=node.counts), as_leaf
    return Node(left, right, counts=node.counts), left_errors + right_errors


@dataclass
class PrunedTree:
    """A fitted model whose last stage is a tree, and what each of the tree's leaves answers after pruning."""

    model: object
    answers: list[tuple[int, list[float]]]  # by leaf of the grown tree: leaf of the pruned one, class shares
    leaves: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds probabilities, the prediction and the pruned leaf."""
        table = F.array(*[F.struct(F.lit(n).alias("leaf"), F.array(*map(F.lit, p)).alias("p")) for n, p in self.answers])
        scored = self.model.transform(df).drop("probability", "rawPrediction", "prediction")
        out = scored.withColumn("_at", F.get(table, F.col("_leaf").cast("int"))).withColumns(
            {"probabilities": F.col("_at.p"), "pruned_leaf": F.col("_at.leaf")}
        )
        best = F.array_position("probabilities", F.array_max("probabilities")) - 1
        return out.withColumn("prediction", best.cast("double")).drop("_at", "_leaf")


def prune(model, tree, train: DataFrame, n_classes: int, confidence: float = CONFIDENCE, margin: float = MARGIN) -> PrunedTree:
    """Prune `tree`, a fitted decision tree inside `model` (or the same), by the class counts of `train` (label)."""
    tree.setLeafCol("_leaf")
    counts = model.transform(train).where("label IS NOT NULL").groupBy(
        F.col("_leaf").cast("int").alias("leaf"), F.col("label").cast("int").alias("label")
    ).count()
    root = grown(tree)
    every = root.leaves()
    if len(every) > MAX_LEAVES:
        raise ValueError(f"a tree of more than {MAX_LEAVES} leaves cannot be pruned here")
    at_leaf: dict[int, list[int]] = {}
    for r in counts.collect():  # leaves x classes
        at_leaf.setdefault(r["leaf"], [0] * n_classes)[r["label"]] = r["count"]
    fill(root, at_leaf, n_classes)
    small, _ = pruned(root, confidence, margin)
    answers: list = [None] * len(every)

    def cover(full: Node, kept: Node, number: list[int]) -> None:
        if kept.left is None:
            n = sum(kept.counts)
            shares = [c / n for c in kept.counts] if n else [1.0] + [0.0] * (n_classes - 1)
            for leaf in full.leaves():
                answers[leaf.leaf] = (number[0], shares)
            number[0] += 1
        else:
            cover(full.left, kept.left, number)
            cover(full.right, kept.right, number)

    cover(root, small, [0])
    return PrunedTree(model, answers, len(small.leaves()))
