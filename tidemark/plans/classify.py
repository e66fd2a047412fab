"""Classifiers over feature arrays: forests, trees, naive Bayes variants, grids and folds."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.vectors import bound, total
from tidemark.operators import evaluate

# The forest grid of the image classifier (224 fits).
FOREST_GRID = [
    (trees, subset, impurity, depth)
    for trees in range(4, 11)
    for subset in ("all", "sqrt", "log2", "onethird")
    for impurity in ("gini", "entropy")
    for depth in range(3, 7)
]

LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßñéèç"


def letter_shares(text) -> Column:
    """Share of each letter among the counted letters of a text, as array<double>."""
    letters = F.array(*[F.lit(c) for c in LETTERS])
    counts = bound(
        F.lower(text),
        lambda lowered: F.transform(letters, lambda c: F.length(lowered) - F.length(F.replace(lowered, c))),
    )
    return bound(
        counts,
        lambda n: bound(F.greatest(total(n), F.lit(1.0)), lambda all_: F.transform(n, lambda x: x / all_)),
    )


def with_letter_shares(docs: DataFrame, text: str = "text", out: str = "vec") -> DataFrame:
    return docs.withColumn(out, letter_shares(F.col(text))).drop(text)


def labelled(df: DataFrame, label: str, classes: list[str], vec: str = "vec") -> DataFrame:
    """Add numeric label (position in the class list) and the vector column the estimators read."""
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    return df.withColumns({"label": index.cast("double"), "features": array_to_vector(vec)})


MAX_CLASSES = 10_000


def class_list(df: DataFrame, label: str) -> list[str]:
    """Distinct labels in order; the class list is part of the model. More than MAX_CLASSES labels are an error."""
    rows = df.select(label).distinct().orderBy(label).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return [row[0] for row in rows]


def forest(trees: int = 10, subset: str = "auto", impurity: str = "gini", depth: int = 5, seed: int = 1):
    return RandomForestClassifier(
        numTrees=trees, featureSubsetStrategy=subset, impurity=impurity, maxDepth=depth, maxBins=100, seed=seed
    )


def forest_grid(
    train: DataFrame,
    test: DataFrame,
    grid: Iterable[tuple[int, str, str, int]] = FOREST_GRID,
    seed: int = 1,
    at_once: int = 8,
) -> tuple[DataFrame, tuple[int, str, str, int]]:
    """One row per trial with its test error and confusion counts, and the parameters of the best, the first on ties.

    Both tables are persisted once; `at_once` fits run at the same time. Trials that differ in depth alone share the fit
    of the deepest: the library grows trees level by level, so the others are its first levels (`cut_forests`).
    """
    spark = train.sparkSession
    train, test = train.persist(), test.persist()
    grid = list(grid)
    depths: dict[tuple, list[int]] = {}
    for trees, subset, impurity, depth in grid:
        depths.setdefault((trees, subset, impurity), []).append(depth)

    def trials(setting):
        """The class counts of the trials of one setting, by depth."""
        wanted = sorted(set(depths[setting]))
        fitted = forest(*setting, wanted[-1], seed).fit(train)
        cells: dict[int, list] = {}
        if len(wanted) > 1 and level_at_once(fitted, wanted[-1]):
            counts = evaluate.confusion_counts(cut_forests(fitted, wanted, test), "depth")
            for c in counts.orderBy("label", "prediction").collect():  # depths x classes x classes rows
                cells.setdefault(c["depth"], []).append((c["label"], c["prediction"], c["n"]))
            return {depth: cells.get(depth, []) for depth in wanted}
        for depth in wanted:
            model = fitted if depth == wanted[-1] else forest(*setting, depth, seed).fit(train)
            counts = evaluate.confusion_counts(model.transform(test)).orderBy("label", "prediction")
            cells[depth] = [tuple(c) for c in counts.collect()]  # classes x classes rows
        return cells

    with ThreadPoolExecutor(at_once) as pool:
        by_setting = dict(zip(depths, pool.map(trials, depths), strict=True))
    train.unpersist()
    test.unpersist()
    found = []
    for trees, subset, impurity, depth in grid:
        cells = by_setting[trees, subset, impurity][depth]
        wrong = sum(n for label, prediction, n in cells if label != prediction)
        found.append((wrong / max(1, sum(n for *_, n in cells)), cells))
    rows = [(number, *setting, *result) for number, (setting, result) in enumerate(zip(grid, found, strict=True), 1)]
    schema = (
        "trial int, trees int, subset string, impurity string, depth int, error double, "
        "confusion array<struct<label: double, prediction: double, n: bigint>>"
    )
    best = min(range(len(grid)), key=lambda k: found[k][0])
    return spark.createDataFrame(rows, schema), grid[best]


def level_at_once(fitted, depth: int) -> bool:
    """Whether all nodes of a level fit the memory in which the library splits nodes together.

    Beyond it nodes are split in groups, whose order a forest's depth may change, and with it the features drawn.
    """
    bytes_of_node = 8 * fitted.numFeatures * fitted.getMaxBins() * (fitted.numClasses + 1)
    return fitted.getNumTrees * 2 ** (depth - 1) * bytes_of_node <= fitted.getMaxMemoryInMB() << 20


def tree_counts(node) -> tuple:
    """(class counts of the training rows, left, right) of a fitted node; leaves have no children."""
    if node.subtreeDepth() == 0:
        text = node.impurityStats().toString()
        return np.array([float(x) for x in text[text.index("[") + 1 : text.index("]")].split(",")]), None, None
    left, right = tree_counts(node.leftChild()), tree_counts(node.rightChild())
    return left[0] + right[0], left, right


def cut_tree(node: tuple, depth: int) -> tuple[list[np.ndarray], bool]:
    """For every leaf below `node`, the counts of the leaf it lies under in the tree grown only `depth` levels on.

    As the library prunes, two leaves that answer the same class are one. The flag tells whether the node is a leaf then.
    """
    counts, left, right = node
    if left is None:
        return [counts], True
    (a, a_leaf), (b, b_leaf) = cut_tree(left, max(0, depth - 1)), cut_tree(right, max(0, depth - 1))
    if depth == 0 or (a_leaf and b_leaf and a[0].argmax() == b[0].argmax()):
        return [counts] * (len(a) + len(b)), True
    return a + b, False


def cut_forests(fitted, depths: list[int], test: DataFrame) -> DataFrame:
    """(depth, label, prediction) of every row of `test`, by the forest grown to each of `depths`, given the deepest."""
    trees = [tree_counts(t._java_obj.rootNode()) for t in fitted.trees]
    votes = []
    for depth in depths:
        counts = [np.array(cut_tree(t, depth)[0]) for t in trees]
        votes.append([c / np.maximum(c.sum(1, keepdims=True), 1e-300) for c in counts])

    def run(batches):
        for batch in batches:
            leaves = batch.column("leaves").flatten().to_numpy().reshape(batch.num_rows, len(trees)).astype(np.int64)
            for depth, shares in zip(depths, votes, strict=True):
                total = sum(s[leaves[:, t]] for t, s in enumerate(shares))
                columns = [pa.array(np.full(batch.num_rows, depth, np.int32)), batch.column("label"), pa.array(total.argmax(1).astype(np.float64))]
                yield pa.RecordBatch.from_arrays(columns, ["depth", "label", "prediction"])

    fitted.setLeafCol("_leaves")
    scored = fitted.transform(test).select("label", vector_to_array("_leaves").alias("leaves"))
    return scored.mapInArrow(run, "depth int, label double, prediction double")


def gaussian_parameters(df: DataFrame, label: str, vec: str = "vec") -> DataFrame:
    """(label, i, mean, variance): what Gaussian naive Bayes learns, as one grouped aggregate."""
    width = df.agg(F.max(F.size(vec))).first()[0] or 0
    cells = [
        F.struct(F.lit(i).alias("i"), F.avg(F.get(vec, i)).alias("mean"), F.var_pop(F.get(vec, i)).alias("variance"))
        for i in range(width)
    ]
    if not cells:
        return df.select(label, F.lit(0).alias("i"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("variance")).limit(0)
    return df.groupBy(label).agg(F.array(*cells).alias("_c")).select(label, F.inline("_c"))


def gaussian_bayes() -> NaiveBayes:
    return NaiveBayes(modelType="gaussian")


def quantile_cuts(df: DataFrame, bins: int = 5, vec: str = "vec") -> list[list[float]]:
    """Cut points of every coordinate, from one mergeable sketch each."""
    at = [i / bins for i in range(1, bins)]
    long = df.select(F.posexplode(vec).alias("i", "x"))
    rows = long.groupBy("i").agg(F.percentile_approx("x", at, 10000).alias("cuts")).orderBy("i").collect()
    return [list(row.cuts) for row in rows]


def binned(vec, cuts: list[list[float]]) -> Column:
    """Bin number of every coordinate, as array<double>."""
    edges = F.array(*[F.array(*map(F.lit, c)).cast("array<double>") for c in cuts])
    return F.zip_with(vec, edges, lambda x, e: F.size(F.filter(e, lambda cut: cut < x)).cast("double"))


def one_hot(numbers, bins: int) -> Column:
    slots = F.sequence(F.lit(0), F.lit(bins - 1))
    return F.flatten(F.transform(numbers, lambda b: F.transform(slots, lambda j: (j == b).cast("double"))))


@dataclass
class Discretized:
    """A classifier behind a quantile discretiser; the cuts are part of the model."""

    cuts: list[list[float]]
    bins: int
    hot: bool
    model: object = None

    def prepare(self, df: DataFrame, vec: str = "vec") -> DataFrame:
        numbers = binned(F.col(vec), self.cuts)
        return df.withColumn("features", array_to_vector(one_hot(numbers, self.bins) if self.hot else numbers))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.prepare(df))


def discretized_bayes(train: DataFrame, bins: int = 5, smoothing: float = 1.0) -> Discretized:
    """Discretise every coordinate, one-hot encode the bins, then multinomial naive Bayes."""
    out = Discretized(quantile_cuts(train, bins), bins, hot=True)
    out.model = NaiveBayes(smoothing=smoothing).fit(out.prepare(train))
    return out


def discretized_tree(train: DataFrame, bins: int = 5, depth: int = 5) -> Discretized:
    """The default tree learner over discretised coordinates."""
    out = Discretized(quantile_cuts(train, bins), bins, hot=False)
    tree = DecisionTreeClassifier(impurity="entropy", maxDepth=depth, seed=1)
    out.model = tree.fit(out.prepare(train))
    return out


def pooled_folds(df: DataFrame, folds: int, learners: dict, fold: str = "fold") -> DataFrame:
    """(model, label, prediction) of every row, scored by the model that did not see its fold.

    A row without a label or fold is scored by nothing and left out.
    """
    usable = df.dropna(subset=["label", fold])
    scored = []
    for name, fit in learners.items():
        for k in range(folds):
            model = fit(usable.filter(F.col(fold) != k))
            held = model.transform(usable.filter(F.col(fold) == k))
            scored.append(held.select(F.lit(name).alias("model"), "label", "prediction"))
    return reduce(DataFrame.unionAll, scored)


def cross_validated(df: DataFrame, estimator, folds: int = 4, fold: str = "fold"):
    """Cross validation over folds the caller has dealt (column `fold`)."""
    judge = MulticlassClassificationEvaluator(metricName="accuracy")
    runner = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=judge,
        numFolds=folds,
        foldCol=fold,
        seed=1,
    )
    return runner.fit(df.withColumn(fold, F.col(fold).cast("int")))
