import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import letter_words
from tidemark.operators import evaluate
from tidemark.operators.relational import stratified_folds
from tidemark.plans import classify, cluster, recommend, textmodel


SCORES = """
  ada  tea 4.5  ada  rye 4.0  ada  gin 1.5  ada  rum 2.0  ada  ale 1.0
  bo   tea 4.0  bo   rye 4.5  bo   gin 1.0  bo   ale 1.5
  cy   tea 1.0  cy   rye 1.5  cy   gin 4.5  cy   rum 4.0  cy   ale 4.5
  dee  rye 1.0  dee  gin 4.0  dee  rum 4.5  dee  ale 5.0
  eli  tea 5.0  eli  rye 4.0  eli  gin 1.0  eli  rum 1.0
  fay  tea 1.5  fay  gin 5.0  fay  rum 4.0  fay  ale 4.0
"""


def drinkers(spark):
    """Six people, five drinks: ada, bo and eli like tea and rye, the others gin, rum and ale."""
    words = SCORES.split()
    people, drinks = (list(dict.fromkeys(words[k::3])) for k in (0, 1))
    rows = [
        (700 + people.index(p), 31 + drinks.index(d), float(score))
        for p, d, score in zip(words[::3], words[1::3], words[2::3], strict=True)
    ]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")


def test_als_reproduces_training_ratings(spark):
    rows = drinkers(spark)
    model = recommend.fit_als(rows, rank=10, iters=20, reg=0.01)
    assert evaluate.mse(rows, recommend.pair_predictions(model, rows)).first().mse < 5e-2


def test_als_drops_unknown_and_ranks_unrated(spark):
    rows = drinkers(spark)
    model = recommend.fit_als(rows, rank=3, iters=15, reg=0.05)
    strangers = spark.createDataFrame([(999, 31), (700, 99), (700, 31)], "user_id bigint, item_id bigint")
    assert recommend.predict(model, strangers).count() == 1
    items = spark.createDataFrame([(i, f"t{i}") for i in range(31, 36)], "item_id bigint, title string")
    known = rows.filter("NOT (user_id = 704 AND item_id = 32)")  # eli has not scored rye and ale
    again = recommend.fit_als(known, rank=3, iters=15, reg=0.05)
    top = recommend.top_unrated(again, items, known, 704).orderBy("rank").collect()
    assert [(r["rank"], r.item_id) for r in top] == [(1, 32), (2, 35)]
    n = known.filter("user_id = 704").count()
    assert recommend.user_scores(again, known.union(known), 704).count() == 2 * n  # repeated ratings stay


def test_als_takes_ids_beyond_32_bits(spark):
    big = 2**40
    rows = drinkers(spark).select((F.col("user_id") + big).alias("user_id"), (F.col("item_id") + big).alias("item_id"), "rating")
    model = recommend.fit_als(rows, rank=3, iters=10, reg=0.05)
    assert recommend.predict(model, rows).filter(F.col("user_id") > big).count() == rows.count()
    assert evaluate.mse(rows, recommend.pair_predictions(model, rows)).first().mse < 0.5


def test_grid_search_beats_the_mean(spark):
    rnd = random.Random(2)
    rows = [(u, i, 5.0 if (u % 2) == (i % 2) else 1.0) for u in range(20) for i in range(20) if rnd.random() < 0.7]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    train, val = df.filter((F.col("user_id") + F.col("item_id")) % 5 != 0), df.filter((F.col("user_id") + F.col("item_id")) % 5 == 0)
    trials, model = recommend.grid_search(train, val, [(4, 0.05, 10), (4, 10.0, 5)])
    errors = [r.rmse for r in trials.orderBy("trial").collect()]
    assert errors[0] < errors[1]
    base = evaluate.baseline(train, val, F.lit(errors[0])).first()
    assert base.improvement > 50


def test_factor_rounds_hand_back_their_shuffle_files(spark):
    import time
    from pathlib import Path

    df = spark.createDataFrame([(u, i, float((u * i) % 5)) for u in range(30) for i in range(20)], "user_id int, item_id int, rating double")
    coded, _, _ = recommend.numbered(df)
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = [Path(str(f)) for f in env.blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {f.name.split("_")[1] for d in folders for f in d.glob("*/shuffle_*.data")}
    before = shuffles()
    kept = recommend._fit(coded, 4, 5, 0.1, 1)  # rounds 1 to 4 held eight sets of files with a checkpoint every five rounds
    for _ in range(50):
        if left_few := len(shuffles() - before) <= 6:
            break
        time.sleep(0.1)
    assert left_few and kept.rank == 4


def test_full_grids_have_the_stated_size():
    assert len(recommend.GRID) == 8 and len(classify.FOREST_GRID) == 224


def blobs(spark, n=60):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=2) + 10 * (i % 3)], i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, vec array<double>, label int")


def test_clusterings_find_three_blobs(spark):
    rows = blobs(spark)
    report = cluster.cluster_report(cluster.fit_kmeans(rows, 3, 25), rows).collect()
    assert sorted(r.size for r in report) == [20, 20, 20]
    again = cluster.wssse(rows, [r.center for r in report]).first()
    assert again.wssse == pytest.approx(report[0].cost)
    centers = cluster.fit_kmedians(rows, "id", 3, iters=10)
    assert sorted(round(c[0] / 10) for c in centers) == [0, 1, 2]
    weights = cluster.mixture_report(cluster.fit_mixture(rows, 3), rows).collect()
    assert sum(r.weight for r in weights) == pytest.approx(1.0)
    assert sum(r.size for r in cluster.cluster_report(cluster.fit_bisecting(rows, 4), rows).collect()) == 60


def test_kmedians_step_by_hand(spark):
    rows = blobs(spark, 31)
    centers = [[0.0, 0.0], [10.0, 10.0], [20.0, 20.0]]
    got = {(r.word, r.i): r.median for r in cluster.kmedians_step(rows, centers).collect()}
    data = np.array([r.vec for r in rows.collect()])
    word = np.array([[abs(p - np.array(c)).sum() for c in centers] for p in data]).argmin(axis=1)
    for w in range(3):
        for i in range(2):
            assert got[w, i] == pytest.approx(np.median(data[word == w][:, i]))


def test_medians_from_counts_equal_ordered_ones(spark, monkeypatch):
    from tidemark.operators import selection
    from tidemark.plans import mixture

    rng = np.random.default_rng(5)
    data = np.column_stack([rng.normal(size=3000) * 1e4, rng.integers(-2, 3, 3000) * 1.0, rng.choice([0.0, -0.0, 1e300, -1e-300, np.inf], 3000)])
    data = np.vstack([data, data[:7] + 1e-9])
    rows = spark.createDataFrame([(i, [None if i % 50 == 0 and j == 0 else float(v) for j, v in enumerate(r)]) for i, r in enumerate(data)]
                                 + [(9999, None)], "id bigint, vec array<double>")
    centers = [[-5e3, 0.0, 0.0], [5e3, 0.0, 0.0], [9e9, 0.0, 0.0]]
    right = {(r.word, r.i): r.median for r in cluster.kmedians_step(rows, centers).collect()}
    blocks = mixture.matrices(rows.where("vec IS NOT NULL"))
    for most in (selection.FEW, 5):  # with few rows at hand, ranges are cut down to single numbers
        monkeypatch.setattr(selection, "FEW", most)
        assert selection.cluster_medians(blocks, centers, selection.limits(blocks)) == right
    ordered = []
    monkeypatch.setattr(cluster, "exact_median", lambda *a, **k: ordered.append(a))
    assert len(cluster.fit_kmedians(blobs(spark), "id", 3, iters=2)) == 3 and not ordered  # a round orders nothing


def sentences(spark, n=240):
    rnd = random.Random(6)
    words = {"en": ["the", "cloud", "house", "river"], "de": ["der", "wolke", "haus", "fluss"]}
    rows = []
    for i in range(n):
        lang = "en" if i % 3 else "de"
        rows.append((i, " ".join(rnd.choice(words[lang]) for _ in range(12)), lang))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_both_text_classifiers_learn(spark):
    docs = stratified_folds(sentences(spark), "lang", "doc_id", 3)
    train, test = docs.filter("fold > 0"), docs.filter("fold = 0")
    model = textmodel.nb_fit(train, textmodel.term_frequency(train, keep=("lang",)), "lang")
    named = textmodel.nb_predict(textmodel.nb_scores(model, textmodel.term_frequency(test), test))
    right = named.join(test, "doc_id").filter("lang = prediction").count()
    assert right == test.count()
    listed = docs.withColumn("tokens", letter_words(F.col("text")))
    fitted = textmodel.hashed_classifier("lang", 1 << 12).fit(listed.filter("fold > 0"))
    scored = textmodel.label_names(["de", "en"]).transform(fitted.transform(listed.filter("fold = 0")))
    assert scored.filter("lang = predicted_label").count() == test.count()


def test_text_without_known_tokens_gets_the_prior(spark):
    train = sentences(spark)
    model = textmodel.nb_fit(train, textmodel.term_frequency(train, keep=("lang",)), "lang")
    odd = spark.createDataFrame([(1, "zzz"), (2, "")], "doc_id bigint, text string")
    got = textmodel.nb_predict(textmodel.nb_scores(model, textmodel.term_frequency(odd), odd)).collect()
    assert [r.prediction for r in got] == ["en", "en"]


def shares(spark):
    rows = classify.with_letter_shares(sentences(spark))
    return classify.labelled(rows, "lang", ["de", "en"])


def test_letter_shares(spark):
    df = spark.createDataFrame([(1, "Aab, Ä!"), (2, "123"), (3, "")], "id int, text string")
    rows = {r.id: r.vec for r in classify.with_letter_shares(df).collect()}
    assert rows[1][0] == 0.5 and rows[1][1] == 0.25 and rows[1][classify.LETTERS.index("ä")] == 0.25
    assert sum(rows[2]) == 0 and sum(rows[3]) == 0


def test_classifiers_beat_the_majority(spark):
    rows = stratified_folds(shares(spark), "lang", "doc_id", 4).persist()
    train, test = rows.filter("fold > 0"), rows.filter("fold = 0")
    for scored in (
        classify.forest(5, depth=3).fit(train).transform(test),
        classify.gaussian_bayes().fit(train).transform(test),
        classify.discretized_bayes(train).transform(test),
        classify.discretized_tree(train).transform(test),
    ):
        assert evaluate.error_rate(scored).first().accuracy > 0.9
    assert classify.cross_validated(rows, classify.gaussian_bayes()).avgMetrics[0] > 0.9
    trials, best = classify.forest_grid(train, test, [(2, "sqrt", "gini", 3), (3, "sqrt", "entropy", 3)])
    assert trials.count() == 2 and best[2] in ("gini", "entropy")


def test_trials_of_one_setting_share_the_deepest_fit(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    points = rnd.normal(size=(400, 6))
    labels = (points[:, 0] + points[:, 1] * points[:, 2] + rnd.normal(size=400) > 0).astype(int) + (points[:, 3] > 1)
    rows = classify.labelled(
        spark.createDataFrame([(str(c), [float(x) for x in p]) for c, p in zip(labels, points, strict=True)], "lang string, vec array<double>"),
        "lang", ["0", "1", "2"],
    ).persist()
    train, test = rows, rows.unionAll(rows.limit(50))
    grid = [(3, subset, "gini", depth) for subset in ("all", "sqrt") for depth in (2, 3, 5)]
    want = [evaluate.confusion_counts(classify.forest(*g).fit(train).transform(test)).orderBy("label", "prediction").collect() for g in grid]
    fits = []
    real = classify.forest
    monkeypatch.setattr(classify, "forest", lambda *setting: fits.append(setting) or real(*setting))
    trials, _ = classify.forest_grid(train, test, grid)
    got = [[tuple(c) for c in r.confusion] for r in trials.orderBy("trial").collect()]
    assert got == [[tuple(c) for c in w] for w in want] and len(fits) == 2


def test_gaussian_parameters_equal_the_library(spark):
    rows = shares(spark)
    fitted = classify.gaussian_bayes().fit(rows)
    learned = {(r.label, r.i): r.mean for r in classify.gaussian_parameters(rows, "label").collect()}
    theta = fitted.theta.toArray()
    assert all(theta[int(label)][i] == pytest.approx(mean) for (label, i), mean in learned.items())
