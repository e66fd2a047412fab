import random
import statistics
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalar, text, vectors
from tidemark.operators import evaluate, graph, neighbors, ordered, relational, skew
from tidemark.plans import cluster, textmodel


# --- skewed joins -------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, monkeypatch, how):
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 10)
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(45).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(
        spark.createDataFrame([(0, 777)], "k bigint, v bigint")
    )
    assert skew.hot_keys(left, "k").filter("k = 0").count() == 1
    got = skew.salted_join(left, right, "k", F.col("id"), how).select("id", "k", "v")
    want = left.join(right, "k", how).select("id", "k", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_salted_join_refuses_outer(spark):
    with pytest.raises(ValueError):
        skew.salted_join(spark.range(1), spark.range(1), "id", F.col("id"), "full")


# --- running values ------------------------------------------------------------------


def timeline(spark):
    rnd = random.Random(5)
    rows = [(i, 0 if i % 3 else rnd.randrange(4), rnd.randrange(500), rnd.choice([None, 1.0, 2.0])) for i in range(600)]
    return rows, spark.createDataFrame(rows, "id int, k int, t int, v double")


def test_running_sum_and_last_known(spark):
    rows, df = timeline(spark)
    both = ordered.running(df, ["k"], ["t", "id"], sums={"s": F.col("id")}, lasts={"last": F.col("v")})
    got = {r.id: (r.s, r.last) for r in both.collect()}
    assert len(got) == len(rows)
    for k in {r[1] for r in rows}:
        total, last = 0, None
        for i, _, t, v in sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0])):
            total, last = total + i, last if v is None else v
            assert got[i] == (total, last)


def test_running_keeps_null_groups_orders_and_values(spark):
    rows = [(1, None, 3, 5), (2, None, None, 1), (3, "a", 2, None), (4, "a", None, None), (5, "a", 9, 4), (6, None, 1, None)]
    df = spark.createDataFrame(rows, "id int, k string, t int, v int")
    df.createOrReplaceTempView("timeline")
    over = "OVER (PARTITION BY k ORDER BY t, id ROWS UNBOUNDED PRECEDING)"
    want = spark.sql(f"SELECT id, k, t, v, sum(v) {over} AS s, last_value(v, true) {over} AS l FROM timeline")
    got = ordered.running(df, ["k"], ["t", "id"], sums={"s": F.col("v")}, lasts={"l": F.col("v")})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 6
    ranked = ordered.running_rank(df, ["k"], ["t", "id"], "n").collect()
    assert {r.id: r.n for r in ranked} == {2: 1, 6: 2, 1: 3, 4: 1, 3: 2, 5: 3}
    medians = ordered.exact_median(df, ["k"], "v").collect()
    assert {r.k: r.median for r in medians} == {None: 3.0, "a": 4.0}


@pytest.fixture
def uncoalesced(spark):
    """Small shuffle slices stay apart, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_group_at_one_time_spans_several_slices(spark, uncoalesced):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.lit(7).alias("t"), "id")
    slices = ordered.sliced(df.repartition(8), ["k"], ["t", "id"]).groupBy("_slice").count().collect()
    assert len(slices) > 1 and max(r["count"] for r in slices) < 15_000
    got = ordered.running_sum(df, ["k"], ["t", "id"], F.col("id"), "s").agg(F.max("s")).first()[0]
    assert got == 20_000 * 19_999 // 2


def test_row_numbers(spark):
    df = spark.range(0, 5000, 7).select((F.col("id") * F.col("id")).alias("x"))
    got = sorted((r.x, r.n) for r in relational.row_numbers(df, "x", "n").collect())
    assert [n for _, n in got] == list(range(1, len(got) + 1))


def test_exact_median_with_a_dominant_value(spark):
    rnd = random.Random(3)
    rows = [("a", 5.0) for _ in range(400)] + [("a", rnd.random() * 100) for _ in range(501)]
    rows += [("b", float(x)) for x in (1, 2, 3, 10)] + [("c", 7.5), ("b", None)]
    got = {r.k: r.median for r in ordered.exact_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    for k in "abc":
        assert got[k] == statistics.median(v for q, v in rows if q == k and v is not None)


def test_stratified_folds_are_even(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") < 700, "x").otherwise("y").alias("label"))
    sizes = relational.stratified_folds(df, "label", "id", 4).groupBy("label", "fold").count().collect()
    for label in "xy":
        counts = [r["count"] for r in sizes if r.label == label]
        assert len(counts) == 4 and max(counts) - min(counts) <= 1


# --- friends --------------------------------------------------------------------------


def mutual_by_hand(links):
    friends = {}
    for a, b in links:
        if a != b:
            friends.setdefault(a, set()).add(b)
            friends.setdefault(b, set()).add(a)
    pairs = {(min(a, b), max(a, b)) for a, b in links if a != b}
    return {p: sorted(friends[p[0]] & friends[p[1]]) for p in pairs}


def test_mutual_friends_with_hub_one_sided_and_self_links(spark, monkeypatch):
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 5)
    rnd = random.Random(1)
    links = [(0, i) for i in range(1, 60)]  # one user knows everybody
    links += [(rnd.randrange(60), rnd.randrange(60)) for _ in range(200)]
    links += [(3, 3), (70, 71)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    want = mutual_by_hand(links)
    got = {}
    for r in graph.mutual_friends(df).collect():
        got.setdefault((r.u1, r.u2), []).append(r.friend)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    counts = {(r.u1, r.u2): r.n_mutual for r in graph.mutual_friend_counts(df).collect()}
    assert counts == {k: len(v) for k, v in want.items()}


def test_degrees_are_counted_once(spark, monkeypatch):
    plans = {}
    real = graph.via_table

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(graph, "via_table", noted)
    links = spark.createDataFrame([(a, b) for a, b in combinations(range(6), 2)], "a bigint, b bigint")
    assert graph.triangles(graph.friend_pairs(links)).count() == 20
    assert "Generate explode(array(u1" in plans["degrees"] and "Generate explode(array(u1" not in plans["edges"]


def test_links_from_lists(spark):
    lists = spark.createDataFrame([("a", ["b", "c"]), ("b", ["c"])], "user string, friends array<string>")
    got = {(r.u1, r.u2, r.friend) for r in graph.mutual_friends(graph.from_lists(lists)).collect()}
    assert got == {("a", "b", "c"), ("a", "c", "b"), ("b", "c", "a")}


def test_paths_of_one_user_are_dealt_to_many_keys(spark, monkeypatch):
    monkeypatch.setattr(graph, "PATHS", 40)
    # Thirty users know each other; each also has many friends of their own, so all point among themselves.
    links = [(a, b) for a, b in combinations(range(30), 2)] + [(a, 1000 + 50 * a + k) for a in range(30) for k in range(5)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {(r.x, r.y, r.z) for r in graph.triangles(graph.friend_pairs(df)).collect()}
    assert len(got) == 30 * 29 * 28 // 6 and {tuple(sorted(t)) for t in got} == set(combinations(range(30), 3))


# --- neighbors ------------------------------------------------------------------------


def cloud(n, width, seed, twins=0):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, width)) + 20 * rng.integers(0, 3, size=(n, 1))
    points[:twins] = points[0]
    return points


def frame(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, vec array<double>")


@pytest.mark.parametrize("k, exclude", [(1, True), (4, True), (3, False)])
def test_knn_join_is_exact(spark, k, exclude):
    points = cloud(150, 3, 7, twins=50)  # a third of the points coincide
    rows = frame(spark, points)
    found = neighbors.knn_join(rows, rows, k, exclude, n_centers=6, block_rows=16)  # several blocks a cell
    got = {(r.query, r["rank"]): (r.neighbor, r.dist) for r in found.collect()}
    assert len(got) == k * len(points)
    for q, p in enumerate(points):
        dist = np.sqrt(((points - p) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(len(points)), dist)) if not (exclude and i == q)]
        assert [got[q, j + 1][0] for j in range(k)] == order[:k]
        assert got[q, 1][1] == pytest.approx(dist[order[0]])


def test_knn_with_fewer_rows_than_k(spark):
    rows = frame(spark, cloud(3, 2, 1))
    assert neighbors.knn_join(rows, rows, 5, True).count() == 6


def test_blocks_hold_few_rows_and_equal_vectors_few_copies(spark):
    points = cloud(200, 3, 5, twins=120)
    _, cells, blocks = neighbors.prepared(frame(spark, points), 2, 4, 16)
    assert cells.count() == 80 + 3
    assert max(len(r.ids) for r in blocks.collect()) < 40 and blocks.count() > 4


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(40, 6)) * 100
    return middles[rng.integers(0, 40, size=n)] + rng.normal(size=(n, 6))


def test_few_cells_are_visited_on_clustered_points(spark, monkeypatch):
    sent = []
    real = neighbors.met
    monkeypatch.setattr(neighbors, "met", lambda s, *a: sent.append(s.count()) or real(s, *a))
    for n in (400, 1600):
        rows = frame(spark, clustered(n, 3))
        assert neighbors.knn_join(rows, rows, 1, True, n_centers=60).count() == n
        assert sum(sent) <= n * 60 / 3  # of all query-cell pairs
        sent.clear()
        assert neighbors.knn_approx(rows, rows, 1, 4, True, n_centers=60).count() == n
        assert sent == [4 * n]  # as many cells per query at any size
        sent.clear()


def test_knn_approx_recall(spark):
    rows = frame(spark, cloud(400, 4, 3))
    exact = {r.query: r.neighbor for r in neighbors.knn_join(rows, rows, 1, True).collect()}
    found = {r.query: r.neighbor for r in neighbors.knn_approx(rows, rows, 1, 8, True).collect()}
    assert sum(exact[q] == found.get(q) for q in exact) / len(exact) >= 0.9


def test_distance_profile(spark):
    points = cloud(70, 2, 9)
    got = {r.id: r for r in neighbors.distance_profile(frame(spark, points), block_rows=16).collect()}
    assert len(got) == 70
    for q, p in enumerate(points):
        dist = np.delete(np.sqrt(((points - p) ** 2).sum(axis=1)), q)
        assert got[q].nearest_dist == pytest.approx(dist.min())
        assert got[q].mean_square == pytest.approx((dist**2).mean())


# --- evaluation -----------------------------------------------------------------------


def test_repeated_pairs_multiply(spark):
    ratings = spark.createDataFrame([(1, 1, 5.0), (1, 1, 3.0), (1, 2, 4.0), (2, 2, 1.0)], "user_id int, item_id int, rating double")
    preds = spark.createDataFrame([(1, 1, 4.0), (1, 1, 2.0), (1, 2, 4.5)], "user_id int, item_id int, prediction double")
    joined = ratings.join(preds, ["user_id", "item_id"]).select(F.pow(F.col("rating") - F.col("prediction"), 2).alias("e"))
    errors = [r.e for r in joined.collect()]
    got = evaluate.mse(ratings, preds).first()
    assert (got.n_pairs, got.mse) == (5, pytest.approx(sum(errors) / 5))
    over = evaluate.rmse_over(ratings, preds).first()
    assert (over.n_rows, over.rmse) == (4, pytest.approx((sum(errors) / 4) ** 0.5))


def test_class_report_counts_missing_classes(spark):
    scored = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "label string, prediction string")
    rows = {r.cls: r for r in evaluate.class_report(scored).collect()}
    assert rows["a"].recall == 0.5 and rows["a"].precision == 1.0
    assert rows["b"].recall == 1.0 and rows["b"].fp_rate == 0.5
    matrix = {r.label: (r.a, r.b, r.c) for r in evaluate.confusion_matrix(scored, ["a", "b", "c"]).collect()}
    assert matrix == {"a": (1, 1, 0), "b": (0, 1, 0)}


def test_roc_area(spark):
    rows = [(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.1), (1, 0.1)]
    pairs = [(p, n) for y, p in rows if y for z, n in rows if not z]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    area = evaluate.roc_area(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()[0]
    assert area == pytest.approx(want)


def test_best_trial_takes_the_first_on_ties(spark):
    trials = spark.createDataFrame([(1, 0.5), (2, 0.25), (3, 0.25)], "trial int, error double")
    assert relational.best_trial(trials, "error", "trial").first().trial == 2


def test_matching_names_keep_or_drop_multiplicity(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",)], "tag string")
    right = spark.createDataFrame([("a",), ("a",), ("a",), ("c",)], "tag string")
    assert [tuple(r) for r in relational.matching_names(left, right, "tag").collect()] == [("a", 6)]
    assert relational.matching_names(left, right, "tag", distinct=True).first().n_matches == 1


def test_lookup_keeps_unknown_rows(spark):
    rows, names = spark.range(20), spark.range(10).withColumn("name", F.lit("x"))
    found = relational.lookup(rows, names, "id").collect()
    assert sum(r.name == "x" for r in found) == 10 and len(found) == 20


def test_large_ids_are_split_and_dealt(spark):
    df = spark.createDataFrame([(2 * 10**15 + k, "x") for k in range(40)], "id long, label string")
    sizes = relational.stratified_folds(df, "label", "id", 4).groupBy("fold").count().collect()
    assert [r["count"] for r in sizes] == [10] * 4
    names = df.select(scalar.random_split_name(F.col("id"), {"train": 0.7, "test": 0.3}).alias("s")).distinct().collect()
    assert {r.s for r in names} == {"train", "test"}


def test_squared_error_of_equal_large_numbers_is_zero(spark):
    rows = spark.createDataFrame([(1, 1, 1000.1)] * 3, "user_id int, item_id int, rating double")
    same = rows.withColumnRenamed("rating", "prediction")
    found = evaluate.rmse_over(rows, same).first()
    assert found.n_pairs == 9 and 0 <= found.rmse < 1e-9


# --- text and scalars -------------------------------------------------------------------


def test_tokens_drop_empty_ones(spark):
    df = spark.createDataFrame([("a  b ",), (" ",)], "text string")
    assert [r.token for r in text.tokens(df).collect()] == ["a", "b"]


def test_clean_tokens_and_letters(spark):
    df = spark.createDataFrame([("The CAT é can't été R2 xy",)], "text string")
    row = df.select(
        text.clean_tokens(F.col("text")).alias("c"), text.clean_tokens(F.col("text"), ["the"]).alias("s"),
        text.letter_number(F.lit('{"x": 1}')).alias("x"), text.letter_number(F.lit("123")).alias("none"),
    ).first()
    assert row.c == "the cat été" and row.s == "cat été"
    assert row.x == 24 and row.none is None


def test_sentiment_scalars(spark):
    df = spark.createDataFrame([(i,) for i in (-1, 0, 2, 4, 5)], "s int")
    rows = df.select(scalar.sentiment_css(F.col("s")), scalar.sentiment_rating(F.col("s")), scalar.decided_sentiment(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [
        ("", 0.0, -1), ("sentiment : very negative", 1.0, 0), ("sentiment : neutral", 3.0, -1),
        ("sentiment : very positive", 5.0, 4), ("", 0.0, -1),
    ]


def test_json_threshold(spark):
    df = spark.createDataFrame([('{"cls1":{"positive":0.5}}',), ('{"cls1":{"positive":0.49}}',), ('{"cls1":{}}',)], "j string")
    got = [r[0] for r in df.select(scalar.json_threshold(F.col("j"), "$.cls1.positive", 0.5)).collect()]
    assert got == [True, False, None]


def test_longest_sentence_decides(spark):
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1)], "token string, polarity int")
    talks = spark.createDataFrame(
        [(1, "Bad. This one is good good!"), (2, ""), (3, None), (4, "good aa. bad xxx"), (5, "bad bad bad bad")],
        "id int, text string",
    )
    rows = {r.id: r for r in textmodel.document_sentiment(talks, ["id"], lexicon).collect()}
    assert [rows[i].score for i in range(1, 6)] == [4, 0, 0, 3, 0]
    assert rows[2].is_empty and rows[3].is_empty and not rows[5].is_empty
    assert rows[2].rating == 1.0


# --- vectors ------------------------------------------------------------------------------


def test_nearest_center_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 0.0],)], "vec array<double>")
    got = [(r.word, r.dist) for r in cluster.assigned(df, [[1.0, 0.0], [-1.0, 0.0], [3.0, 0.0]]).collect()]
    assert got == [(0, 1.0), (2, 0.0)]


def test_histograms_sum_to_one_and_skip_empty_images(spark):
    rows = spark.createDataFrame([(1, [0.0]), (1, [9.0]), (1, [8.0]), (2, []), (3, None)], "image_id int, vec array<double>")
    got = {(r.image_id, r.word): r.share for r in cluster.word_histogram(rows, [[0.0], [10.0], [50.0]]).collect()}
    assert got == {(1, 0): pytest.approx(1 / 3), (1, 1): pytest.approx(2 / 3), (1, 2): 0.0}


def test_l2_normalize_keeps_zero_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r[0] for r in df.select(vectors.l2_normalized(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_catalog_product_numbers_brand_by_brand(spark):
    items = spark.createDataFrame([("a",), ("b",), ("a",)], "item string")
    brands = spark.createDataFrame([("x y",), ("z",)], "brand string")
    got = relational.catalog_product(items, brands, "item", "brand").orderBy("seq").collect()
    assert [tuple(r) for r in got] == [(1, "a", "x y"), (2, "b", "x y"), (3, "a", "z"), (4, "b", "z")]


def test_triangles_stay_bounded_for_a_hub(spark):
    """A star has no triangle, and its center points to nobody."""
    star = spark.createDataFrame([(0, i) for i in range(1, 500)], "a bigint, b bigint")
    assert graph.triangles(graph.friend_pairs(star)).count() == 0


def test_hand_count_matches_networks_of_three():
    assert mutual_by_hand(list(combinations(range(3), 2))) == {(0, 1): [2], (0, 2): [1], (1, 2): [0]}


def test_tokens_counted_without_documents_equal_those_grouped_by_them(spark):
    from tidemark.plans import textmodel

    docs = spark.createDataFrame([(1, "a", "x y x"), (1, "a", "x y"), (2, None, "y z"), (3, "b", None)], "doc_id long, lang string, text string")
    rows = textmodel.token_rows(docs, keep=("lang",))
    assert rows.columns == ["lang", "token", "tf"]
    once = textmodel.nb_counts(rows, "lang").collect()
    assert sorted(once, key=str) == sorted(textmodel.nb_counts(textmodel.term_frequency(docs, keep=("lang",)), "lang").collect(), key=str)


def test_folder_files_hold_few_documents_and_kept_rows_lie_in_parts(spark, tmp_path, monkeypatch):
    from tidemark.catalog import files
    from tidemark.plans import cluster

    docs = spark.createDataFrame([(i, f"text {i}", "de") for i in range(20)], "doc_id long, text string, lang string").coalesce(1)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(files, "FILE_DOCS", 3)
    path = files.documents_by_folder(spark, str(tmp_path))
    assert max(r.value.count(files.RECORD_END) for r in spark.read.text(f"{path}/lang=de", wholetext=True).collect()) <= 3
    assert sum(r.n_docs for r in files.scan_whole_files(spark, str(tmp_path)).collect()) == 20
    vectors = spark.range(100).selectExpr("array(double(id)) vec").coalesce(1)
    assert cluster.in_parts(vectors).rdd.getNumPartitions() == 1
    monkeypatch.setattr(cluster, "PART_ROWS", 10)
    assert cluster.in_parts(vectors).rdd.getNumPartitions() >= 10
