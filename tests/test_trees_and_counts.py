"""Pruned trees, mergeable sketches, counted drops, SQL names and top lists of closed windows."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.functions import sqlnames
from tidemark.operators import counted, sketches
from tidemark.plans import pruning
from tidemark.streaming import sinks, windows


def random_tree(rng, depth):
    if depth == 0 or rng.random() < 0.25:
        return pruning.Node(counts=[rng.randint(0, 12), rng.randint(0, 4), rng.randint(0, 2)])
    return pruning.Node(random_tree(rng, depth - 1), random_tree(rng, depth - 1))


def plain_limit(n, e):
    """The upper confidence limit of e errors among n, as a share found by bisection of the normal tail."""
    z = 0.6744897501960817  # the upper quarter of the normal distribution
    low, high = 0.0, 1.0
    for _ in range(200):
        p = (low + high) / 2
        if (p - (e + 0.5) / n) > z * math.sqrt(p * (1 - p) / n):
            high = p
        else:
            low = p
    return low * n


def test_errors_to_expect_are_the_confidence_limit():
    for n, e in ((20, 3), (100, 10), (7, 1), (50, 49)):
        assert e + pruning.extra_errors(n, e) == pytest.approx(plain_limit(n, e), rel=1e-6)
    assert pruning.extra_errors(6, 0) == pytest.approx(6 * (1 - 0.25 ** (1 / 6)))
    assert pruning.extra_errors(5, 5) == 0 and pruning.extra_errors(0, 0) == 0 and pruning.extra_errors(9, 2, 0.6) == 0


def test_pruning_equals_the_best_of_all_choices():
    """Every subtree is kept or replaced; a plain recursion over (errors, shape) agrees."""

    def plain(node):
        leaf = pruning.expected_errors(counts(node))
        if node.left is None:
            return leaf, "leaf"
        a, b = plain(node.left), plain(node.right)
        return (leaf, "leaf") if leaf <= a[0] + b[0] + 0.1 else (a[0] + b[0], (a[1], b[1]))

    def counts(node):
        if node.left is None:
            return node.counts
        return [x + y for x, y in zip(counts(node.left), counts(node.right))]

    shape = lambda n: "leaf" if n.left is None else (shape(n.left), shape(n.right))
    rng, changed = random.Random(3), 0
    for _ in range(200):
        tree = random_tree(rng, 5)
        for k, leaf in enumerate(tree.leaves()):
            leaf.leaf = k
        pruning.fill(tree, {n.leaf: n.counts for n in tree.leaves()}, 3)
        small, errors = pruning.pruned(tree)
        assert (pytest.approx(errors), shape(small)) == plain(tree)
        changed += shape(small) != shape(tree)
    assert changed > 50


def test_a_pruned_spark_tree_answers_by_its_nodes(spark):
    rng = np.random.default_rng(2)
    x = rng.random((600, 3))
    label = np.where(rng.random(600) < 0.15, rng.integers(0, 3, 600), (x[:, 0] * 3).astype(int))  # noise to prune away
    rows = spark.createDataFrame([(float(y), [float(v) for v in p]) for y, p in zip(label, x)], "label double, vec array<double>")
    rows = rows.withColumn("features", array_to_vector("vec")).cache()
    tree = DecisionTreeClassifier(maxDepth=9, impurity="entropy", seed=1).fit(rows)
    small = pruning.prune(tree, tree, rows, 3)
    assert len(small.answers) == len(pruning.grown(tree).leaves()) > 3 * small.leaves >= 9
    scored = small.transform(rows).collect()
    by_leaf = {}
    for r in scored:
        by_leaf.setdefault(r["pruned_leaf"], []).append(r)
    assert len(by_leaf) == small.leaves
    for some in by_leaf.values():
        shares = [sum(r["label"] == k for r in some) / len(some) for k in range(3)]
        assert some[0]["probabilities"] == pytest.approx(shares) and some[0]["prediction"] == int(np.argmax(shares))
    test = rng.random((400, 3))
    held = spark.createDataFrame([([float(v) for v in p],) for p in test], "vec array<double>").withColumn("features", array_to_vector("vec"))
    truth = (test[:, 0] * 3).astype(int)
    right = lambda model: np.mean([r["prediction"] for r in model.transform(held).collect()] == truth)
    assert right(small) > right(tree)
    assert pruning.prune(tree, tree, rows.limit(0), 3).leaves == 1


def test_sketches_of_days_merge_into_months(spark):
    rng = random.Random(1)
    rows = [(d, rng.randrange(20_000), rng.choice([None, 1, 2])) for d in range(30) for _ in range(2000)]
    df = spark.createDataFrame(rows, "day int, user long, kind int")
    stored = sketches.distinct_sketches(df, ["day"], ["user", "kind"]).cache()
    assert stored.count() == 30
    whole = sketches.estimates(sketches.union(stored, [], ["user", "kind"]), ["user", "kind"]).first()
    exact = len({u for _, u, _ in rows})
    assert whole["n_rows"] == len(rows) and abs(whole["user"] - exact) < 4 * sketches.standard_error() * exact and whole["kind"] == 2
    weeks = sketches.estimates(sketches.union(stored, [F.floor(F.col("day") / 7).alias("week")], ["user"]), ["user"])
    for r in weeks.collect():
        n = len({u for d, u, _ in rows if d // 7 == r["week"]})
        assert abs(r["user"] - n) < 4 * sketches.standard_error() * n
    none = spark.createDataFrame([(1, None)], "day int, user long")
    assert sketches.estimates(sketches.distinct_sketches(none, ["day"], ["user"]), ["user"]).first()["user"] == 0


def test_dropped_rows_are_counted_in_the_run_that_uses_the_rest(spark, tmp_path):
    captions = spark.createDataFrame([("anna",), ("{\"id\": 7}",), ("123",), (None,), ("Éa",)], "username string")
    images = spark.createDataFrame([([1.0],), ([],), (None,)], "vec array<double>")
    kept, of_captions = counted.user_numbers(captions)
    vectors, of_images = counted.described(images)
    both = kept.select(F.col("user_id").cast("double").alias("x")).unionAll(vectors.select(F.col("vec")[0].alias("x")))
    both.write.parquet(str(tmp_path / "out"))  # one action
    assert of_captions.get == {"rows": 5, "dropped": 2} and of_images.get == {"rows": 3, "dropped": 2}
    assert sorted(r["user_id"] for r in kept.collect()) == [1, 1, 9]


def test_functions_by_name_in_sql(spark):
    sqlnames.register(spark)
    one = spark.sql(
        "SELECT is_word('Straße') AS a, is_word('a1') AS b, letters_of('x-1y') AS c, signal_rms(array(3D, 4D)) AS d, "
        "signal_zero_crossings(array(1D, -1D, -2D, 3D)) AS e, signal_zero_crossings(array(1D)) AS f"
    ).first()
    assert (one["a"], one["b"], one["c"], one["e"], one["f"]) == (True, False, "xy", 2, 0) and one["d"] == pytest.approx(math.sqrt(12.5))
    spark.createDataFrame([(1, "a  b c"), (2, ""), (3, None)], "id int, text string").createOrReplaceTempView("texts")
    native = spark.sql("SELECT id, position, token FROM texts, LATERAL words_of(text)").collect()
    own = spark.sql("SELECT id, position, token FROM texts, LATERAL token_positions(text, ' +')").collect()
    want = [(1, 0, "a"), (1, 1, "b"), (1, 2, "c")]
    assert sorted(map(tuple, native)) == sorted(map(tuple, own)) == want


def test_top_lists_are_written_once_as_windows_close(spark, tmp_path):
    start = datetime.datetime(2024, 5, 1, 12, tzinfo=datetime.timezone.utc)
    steps = [[(0, "a"), (1, "b"), (4, "a"), (5, "c")], [(30, "b"), (31, "b"), (33, "a")], [(100, "z")]]
    source = str(tmp_path / "in")
    out, seen = str(tmp_path / "out"), []
    for rows in steps:
        made = [(start + datetime.timedelta(seconds=s), t) for s, t in rows]
        spark.createDataFrame(made, "ts timestamp, topic string").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("ts timestamp, topic string").parquet(source)
        counts = windows.window_counts(stream, ["topic"], 10, 10, lateness="5 seconds")
        sinks.append_closed_top(counts, out, "closed", "topic", k=1, checkpoint=str(tmp_path / "cp"))
        read = spark.read.schema("window_start long, topic string, n long, rank long").parquet(out)
        seen.append(sorted((r["window_start"] - int(start.timestamp()), r["topic"], r["n"], r["rank"]) for r in read.collect()))
    assert seen[0] == []  # the first window is still open
    assert seen[1] == [(0, "a", 2, 1)]
    assert seen[2] == [(0, "a", 2, 1), (30, "b", 2, 1)]  # and none is written twice
