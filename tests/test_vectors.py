"""Neighbors far from the origin, cells in two levels, hashing, mixtures and linkage against plain versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import gram, graph, hashing, neighbors
from tidemark.plans import linkage, mixture


def frame(spark, points, extra=()):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame([*rows, *extra], "id bigint, vec array<double>")


def plain_nearest(points, queries=None, k=1, exclude=True):
    out = {}
    for q, p in enumerate(points if queries is None else queries):
        dist = np.sqrt(((points - p) ** 2).sum(1))
        out[q] = [int(i) for i in np.lexsort((np.arange(len(points)), dist)) if not (exclude and i == q)][:k]
    return out


def got(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query"], r["rank"])):
        out.setdefault(r["query"], []).append(r["neighbor"])
    return out


@pytest.mark.parametrize("offset, n_centers", [(0.0, 12), (5e7, 12), (5e7, None)])
def test_exact_neighbors_far_from_the_origin(spark, offset, n_centers):
    points = np.random.default_rng(3).random((800, 2)) * 10 + offset
    found = neighbors.knn_join(frame(spark, points), frame(spark, points), 2, True, n_centers=n_centers)
    assert got(found) == plain_nearest(points, k=2)


@pytest.mark.parametrize("offset", [0.0, 5e7])
def test_mean_squared_distance_far_from_the_origin(spark, offset):
    points = np.random.default_rng(4).random((300, 2)) * 10 + offset
    rows = {r["id"]: r for r in neighbors.distance_profile(frame(spark, points)).collect()}
    for q in range(0, 300, 7):
        d2 = ((np.delete(points, q, 0) - points[q]) ** 2).sum(1)
        assert rows[q]["mean_square"] == pytest.approx(d2.mean(), rel=1e-9)
        assert rows[q]["nearest_dist"] == pytest.approx(np.sqrt(d2.min()))


def test_distance_profile_measures_every_pair(spark):
    """Distances are measured for all pairs of rows of different ids; repeated ids are one point, missing numbers have no distance."""
    points = np.round(np.random.default_rng(6).random((90, 2)) * 10, 1)
    extra = [(3, [50.0, 50.0]), (4, [float(x) for x in points[4]]), (200, [None, 1.0]), (None, [0.0, 0.0]), (201, None)]
    rows = [*enumerate(points), (3, np.array([50.0, 50.0])), (4, points[4])]
    got = {r["id"]: r for r in neighbors.distance_profile(frame(spark, points, extra), block_rows=16).collect()}
    assert set(got) == {*range(90), 200}
    for q in range(90):
        pairs = [(float(np.sqrt(((p - o) ** 2).sum())), j) for i, p in rows if i == q for j, o in rows if j != q]
        assert (got[q]["nearest_dist"], got[q]["nearest"]) == min(pairs)
        assert got[q]["mean_square"] == pytest.approx(np.mean([d * d for d, _ in pairs]))
    assert got[200][1:] == (None, None, None)
    blocks = neighbors.packed(frame(spark, points).withColumn("cell", F.lit(0)), ["cell"], 16)
    shelf = neighbors.shelved(blocks.select("cell", "ids", "flat"), 2)
    measured = [neighbors.profile(0, ids, vecs, shelf, {})["n"].sum() for ids, vecs in shelf.blocks(0, {})]
    assert sum(measured) == 90 * 89


def clustered(n, seed, width=6):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(40, width)) * 100
    return middles[rng.integers(0, 40, size=n)] + rng.normal(size=(n, width))


def test_cells_in_two_levels(spark):
    points = clustered(900, 5)
    points[700:] = points[0]
    rows = frame(spark, points)
    queries = points[::9] + 0.01
    found = neighbors.knn_join(frame(spark, queries), rows, 3, False, n_centers=60, max_centers=5, block_rows=32)
    assert got(found) == plain_nearest(points, queries, 3, False)
    assert got(neighbors.knn_join(rows, rows, 2, True, n_centers=40, max_centers=4)) == plain_nearest(points, k=2)
    cells, placed, _ = neighbors.prepared(rows, 1, 60, 32, max_centers=5)
    assert cells.inner is not None and placed.select("cell").distinct().count() > 15
    few = neighbors.knn_approx(rows, rows, 1, 3, True, n_centers=60, max_centers=5)
    exact = plain_nearest(points)
    assert np.mean([got_q == exact[q] for q, got_q in got(few).items()]) > 0.9


def test_nulls_and_empty_tables(spark):
    points = np.random.default_rng(1).random((40, 3))
    odd = [(None, [0.0, 0.0, 0.0]), (77, None)]
    rows, empty = frame(spark, points, odd), frame(spark, [])
    for n_centers in (None, 4):
        assert got(neighbors.knn_join(rows, rows, 1, True, n_centers=n_centers)) == plain_nearest(points)
        assert neighbors.knn_join(rows, empty, 1, n_centers=n_centers).count() == 0
        assert neighbors.knn_join(empty, rows, 1, n_centers=n_centers).count() == 0
    assert neighbors.knn_approx(rows, empty, 1).count() == neighbors.knn_approx(empty, rows, 1).count() == 0
    assert hashing.knn_lsh(rows, empty).count() == hashing.knn_lsh(empty, rows).count() == 0
    assert len(got(hashing.knn_lsh(rows, rows, 1, True))) == 40
    assert neighbors.distance_profile(empty).count() == 0


def test_recall_at_twenty_thousand_rows(spark):
    points = clustered(20_000, 8, 8)
    rows = frame(spark, points)
    asked = rows.where("id % 20 = 0")
    exact = got(neighbors.knn_join(asked, rows, 1, True))
    cells, _, _ = neighbors.prepared(rows, 1, None, neighbors.BLOCK_ROWS)
    probes = len(cells.centers) // 16  # well under a tenth of the cells
    found = got(neighbors.knn_approx(asked, rows, 1, probes, True))
    assert len(cells.centers) > 100 and np.mean([found.get(q) == n for q, n in exact.items()]) >= 0.9
    hashed = got(hashing.knn_lsh(asked, rows, 1, True))
    assert np.mean([hashed.get(q) == n for q, n in exact.items()]) >= 0.9
    assert hashing.compared(asked, rows).first()["n"] < len(exact) * len(points) / 10


def test_searches_write_no_copies_per_cell(spark, monkeypatch):
    """On vectors without clusters nearly all cells are visited; queries are still written once, not once per cell."""
    points = np.random.default_rng(14).normal(size=(900, 12))
    rows, sizes, real = frame(spark, points), [], neighbors.via_table

    def counted(df, name):
        out = real(df, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(neighbors, "via_table", counted)
    assert got(neighbors.knn_join(rows, rows, 2, True, n_centers=30)) == plain_nearest(points, k=2)
    assert max(sizes) <= 900
    sizes.clear()
    assert neighbors.knn_approx(rows, rows, 2, 10, True, n_centers=30).count() == 1800
    assert max(sizes) <= 900


def test_blocks_are_read_where_files_cannot_be_mapped(spark, monkeypatch):
    from pyarrow import fs

    points = np.random.default_rng(15).normal(size=(200, 3))
    _, _, blocks = neighbors.prepared(frame(spark, points), 1, 4, 16)
    shelf = neighbors.shelved(blocks, 3)

    def held():
        opened = {}
        return sorted((i, *v) for c in np.unique(shelf.cells) for ids, vecs in shelf.blocks(c, opened) for i, v in zip(ids.tolist(), vecs.tolist()))

    mapped = held()
    assert mapped == [(i, *p) for i, p in enumerate(points.tolist())]
    monkeypatch.setattr(neighbors, "filesystem", lambda path: (fs.SubTreeFileSystem("/", fs.LocalFileSystem()), path.removeprefix("file:").lstrip("/")))
    assert held() == mapped


def test_buckets_keep_their_size(spark):
    sizes = []
    for n in (1000, 4000):
        points = np.vstack([clustered(n, 6), np.tile(clustered(1, 7), (300, 1))])  # and one very common vector
        rows = frame(spark, points)
        base = rows.where(F.col("id") < n)
        dealt = hashing.buckets(base, base.limit(0), n, 4, 16, 1)
        counts = [r["count"] for r in dealt.groupBy("tab", "node").count().collect()]
        assert sum(counts) == 4 * n and max(counts) <= 16 and np.mean(counts) > 3
        sizes.append(hashing.compared(rows.where("id % 10 = 0"), rows, tables=4, leaf=16).first()["n"] / (n + 300) * 10)
    assert max(sizes) <= 4 * 16  # compared per query at any size


def test_moments_equal_numpy_far_from_the_origin(spark):
    points = clustered(500, 2) + 1e7
    n, mean, cov = gram.moments(frame(spark, points, [(1, None)]).repartition(7))
    assert n == 500 and np.allclose(mean, points.mean(0)) and np.allclose(cov, np.cov(points.T, bias=True), rtol=1e-6, atol=1e-3)
    assert gram.moments(frame(spark, [])) is None


def plain_rounds(points, model, floor, rounds):
    """Expectation maximisation by whole matrices."""
    w, m, s = model.weights, model.means, model.covariances
    logs = []
    for _ in range(rounds):
        dens = np.column_stack([
            wk * np.exp(-0.5 * np.einsum("ij,jk,ik->i", points - mk, np.linalg.inv(sk), points - mk)) / np.sqrt(np.linalg.det(2 * np.pi * sk))
            for wk, mk, sk in zip(w, m, s)
        ])
        logs.append(np.log(dens.sum(1)).sum())
        r = dens / dens.sum(1, keepdims=True)
        n = r.sum(0)
        w, m = n / len(points), (r.T @ points) / n[:, None]
        s = np.array([((points - mk) * r[:, [k]]).T @ (points - mk) / n[k] + floor * np.eye(points.shape[1]) for k, mk in enumerate(m)])
    return logs


def test_hash_tables_hold_a_row_searched_for_itself_once_and_cut_by_products(spark, monkeypatch):
    points = clustered(600, 4, 3)
    rows = frame(spark, np.vstack([points, points[:1], points[:1], points[:1]]))
    written = {}
    real = hashing.via_table
    monkeypatch.setattr(hashing, "via_table", lambda df, name: written.setdefault(name, real(df, name)) if name == "hash-buckets" else kept(real(df, name), name))

    def kept(df, name):
        assert "vec" not in df.columns or name == "hash-base"  # vectors are not written again at every depth
        return df

    got = {(r["query"], r["neighbor"]): r["dist"] for r in hashing.knn_lsh(rows, rows, 1, True, tables=4, leaf=8).collect()}
    assert len(got) == 603 and written["hash-buckets"].count() == 4 * 603
    monkeypatch.undo()
    apart = hashing.knn_lsh(rows, rows.select("*"), 1, True, tables=4, leaf=8)  # as two tables
    assert {(r["query"], r["neighbor"]): r["dist"] for r in apart.collect()} == got
    monkeypatch.setattr(hashing, "BLOCK_ROWS", 3)  # nearly all buckets in joined blocks
    assert {(r["query"], r["neighbor"]): r["dist"] for r in hashing.knn_lsh(rows, rows, 1, True, tables=4, leaf=8).collect()} == got


def test_mixture_rounds_equal_whole_matrices(spark):
    rng = np.random.default_rng(0)
    points = np.vstack([rng.normal(size=(150, 3)) * [1, 2, 0.5] + c for c in ([0, 0, 0], [8, 0, 1], [0, 9, -3], [9, 9, 9])])
    rows = frame(spark, points, [(1, None)])
    start, floor, n = mixture.svd_start(rows, 4)
    assert n == 600 and start.weights.sum() == pytest.approx(1) and len(start.weights) == 4
    model, history = mixture.fit(rows, 4, iters=6, tolerance=-1.0, cells=(16,))
    assert history == pytest.approx(plain_rounds(points, start, floor, 6))
    assert all(b >= a - 1e-6 for a, b in zip(history, history[1:]))
    found = sorted(tuple(np.round(m / 9)) for m in mixture.fit(rows, 4)[0].means)
    assert found == [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 1)]


def test_mixture_rounds_equal_the_library(spark):
    from pyspark.ml.clustering import GaussianMixture

    from tidemark.plans import cluster

    rng = np.random.default_rng(3)
    points = rng.normal(size=(400, 3)) * [10, 3e4, 0.02] + rng.integers(0, 3, 400)[:, None] * [40, 1e5, 0.1]
    rows = frame(spark, points)
    found = cluster.fit_mixture(rows, 3, seed=2, iters=30)
    kept = cluster.features(rows).persist()
    right = GaussianMixture(k=3, seed=2, maxIter=30).fit(kept)
    assert found.log_likelihood == pytest.approx(right.summary.logLikelihood, rel=1e-9)
    assert found.mixture.weights == pytest.approx(np.array(right.weights), rel=1e-6)
    assert np.allclose(found.mixture.means, [g.mean.toArray() for g in right.gaussians], rtol=1e-6)


def test_mixture_sums_by_products_equal_differences_and_leave_narrow_components(spark, monkeypatch):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(500, 4)) * [10, 3e4, 0.03, 1] + [25, 5e4, 5, 1e3]
    blocks = mixture.matrices(frame(spark, points))
    assert sum(len(b) for b in blocks.collect()) == 500
    model = mixture.Mixture(np.full(5, 0.2), points[:5], np.array([np.diag([100, 9e8, 9e-4, 1.0])] * 5))
    assert mixture.products(model, *model.roots()) is not None
    one = mixture.round_sums(blocks, model)
    monkeypatch.setattr(mixture, "NARROW", 0.0)
    for a, b in zip(one, mixture.round_sums(blocks, model), strict=True):
        assert np.allclose(a, b, rtol=1e-9, atol=1e-9 * np.abs(b).max())
    monkeypatch.undo()
    thin = mixture.Mixture(model.weights, model.means, np.vstack([model.covariances[:4], model.covariances[4:] * 1e-9]))
    assert mixture.products(thin, *thin.roots()) is None


def test_mixture_start_is_no_worse_than_random_ones(spark):
    """Over two sets of points, against the median of seven starts from random rows after as many rounds."""
    gain = 0.0
    for seed in (10, 12):
        points = clustered(600, seed, 3)
        _, history = mixture.fit(frame(spark, points), 10)
        rng, others = np.random.default_rng(5), []
        for _ in range(7):
            picked = points[rng.choice(len(points), 10, replace=False)]
            start = mixture.Mixture(np.full(10, 0.1), picked, np.array([np.cov(points.T)] * 10))
            others.append(plain_rounds(points, start, 1e-3, len(history))[-1])
        gain += history[-1] - np.median(others)
    assert gain >= 0


def test_mixture_of_few_or_no_rows(spark):
    assert mixture.fit(frame(spark, []), 3) == (None, [])
    model, _ = mixture.fit(frame(spark, [[1.0, 2.0]] * 5), 3)
    assert np.allclose(model.means, [[1.0, 2.0]])
    assert mixture.parts_of(10, np.array([4.0, 1.0])) == [5, 2] and mixture.parts_of(4, np.array([1.0, 0.9])) == [2, 2]
    assert mixture.report(spark, None, []).count() == 0


def plain_tree(points):
    """Kruskal over all pairs."""
    n = len(points)
    links = sorted((float(np.sqrt(((points[i] - points[j]) ** 2).sum())), i, j) for i in range(n) for j in range(i + 1, n))
    label, out = list(range(n)), []
    for d, i, j in links:
        if label[i] != label[j]:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
            out.append((d, i, j))
    return out


@pytest.mark.parametrize("kind, few", [("clusters", 0), ("grid", 10_000)])
def test_linkage_equals_a_plain_version(spark, monkeypatch, kind, few):
    monkeypatch.setattr(linkage, "FEW", few)
    if kind == "clusters":
        points = clustered(500, 11, 3)
        points[20:40] = points[20]
    else:  # very many equal distances
        points = np.array([[x, y] for x in range(15) for y in range(12)], float)
    rows = frame(spark, points, [(None, [0.0] * points.shape[1]), (999, None)])
    tree = linkage.spanning_tree(rows, n_centers=20, block_rows=32)
    want = plain_tree(points)
    links = sorted((r["dist"], r["a"], r["b"]) for r in tree.collect())
    assert [d for d, _, _ in links] == pytest.approx([d for d, _, _ in want])
    if kind == "clusters":
        assert [(a, b) for d, a, b in links if d] == [(a, b) for d, a, b in want if d]
    steps = linkage.merges(tree).orderBy("step").collect()
    assert [r["step"] for r in steps] == list(range(1, len(points))) and [r["height"] for r in steps] == sorted(d for d, _, _ in links)
    height = want[len(want) * 3 // 4][0]
    label = {i: i for i in range(len(points))}
    for d, i, j in want:
        if d <= height:
            low, high = sorted((label[i], label[j]))
            label = {k: low if v == high else v for k, v in label.items()}
    assert {r["id"]: r["cluster"] for r in linkage.clusters(rows, tree, height).collect() if r["id"] != 999} == label


def test_small_buckets_are_cut_by_one_task(spark, monkeypatch):
    """Buckets cut within a task are those that rounds over all buckets make, and take fewer tables."""
    rows, names, real = frame(spark, clustered(900, 17, 4)), [], hashing.via_table
    monkeypatch.setattr(hashing, "via_table", lambda df, name: names.append(name) or real(df, name))
    found, written = [], []
    for held in (hashing.HELD, 40):  # at 40 most cuts are made by rounds
        monkeypatch.setattr(hashing, "HELD", held)
        pairs = hashing.candidate_blocks(rows.where("id % 3 = 0"), rows, 2, 4, 8, 1)
        met = {(q, i) for r in pairs.collect() for q in r.qids for i in r.ids}
        found.append((met, sorted(map(tuple, hashing.nearest_of(pairs, 2, True).collect()))))
        written.append(len(names))
        names.clear()
    assert found[0] == found[1] and written[0] < written[1]


def test_linkage_meets_few_points_and_takes_few_jobs(spark, monkeypatch):
    """Leaves meet only with the points near their sides, and the number of jobs does not grow with rounds over all points."""
    rng = np.random.default_rng(21)
    points = np.stack([np.round(rng.random(1500) * 300, 2), rng.integers(0, 8, 1500)], 1).astype(float)
    points[1400:1450] = points[:50]
    reached = []
    real = linkage.meetings
    monkeypatch.setattr(linkage, "meetings", lambda *a: reached.append(real(*a)) or reached[-1])
    odd = [(5000, [None, 1.0]), (5001, [float("nan"), 1.0])]
    spark.sparkContext.setJobGroup("linkage", "linkage")
    links = sorted((r["dist"], r["a"], r["b"]) for r in linkage.spanning_tree(frame(spark, points, odd), n_centers=15).collect())
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("linkage")
    spark.sparkContext.setJobGroup("other", "other")
    want = plain_tree(points)
    assert [d for d, _, _ in links] == pytest.approx([d for d, _, _ in want])
    assert [x[1:] for x in links if x[0]] == [x[1:] for x in want if x[0]]
    (pairs,) = reached
    assert len(pairs[0]) < 15 * 14 and max(pairs[2]) < 20
    assert len(jobs) < 40  # each round over all points took some twenty


def test_linkage_of_one_or_no_point(spark):
    assert linkage.spanning_tree(frame(spark, [])).count() == 0
    assert linkage.spanning_tree(frame(spark, [[1.0, 2.0]])).count() == 0
    assert linkage.spanning_tree(frame(spark, [[1.0, 2.0]] * 4)).count() == 3


def test_components_of_chains(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    labels = {r["node"]: r["label"] for r in graph.components(links).collect()}
    assert labels == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}
    assert graph.components(links.limit(0)).count() == 0


@pytest.mark.parametrize("metric", ["l1", "l2"])
def test_nearest_centers_far_from_the_origin(spark, metric):
    from tidemark.functions.vectors import nearest_center

    rng = np.random.default_rng(2)
    book = np.round(rng.random((40, 3)) * 10) + 5e7
    book[7] = book[3]  # the first one wins
    points = np.vstack([rng.random((200, 3)) * 10 + 5e7, book])
    rows = frame(spark, points, [(900, None)])
    found = {r["id"]: r["a"] for r in rows.select("id", nearest_center(F.col("vec"), book.tolist(), metric).alias("a")).collect()}
    gaps = points[:, None] - book[None]
    dist = abs(gaps).sum(2) if metric == "l1" else np.sqrt((gaps**2).sum(2))
    assert [found[k]["word"] for k in range(240)] == dist.argmin(1).tolist() and found[900] is None
    assert [found[k]["dist"] for k in range(240)] == pytest.approx(dist.min(1).tolist())


def test_queries_are_routed_in_parts_of_bounded_size(spark, monkeypatch):
    """No part of a batch hands on more than its share of numbers, however many cells every query visits."""
    rng = np.random.default_rng(5)
    vecs = rng.normal(size=(600, 3))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "id long, vec array<double>")
    asked = pd.DataFrame({"row": range(600), "vec": list(vecs), "bound": np.inf})
    monkeypatch.setattr(neighbors, "TILE", 1000)
    sizes = [len(part) for part in neighbors.tiles(asked, 50)]
    assert sum(sizes) == 600 and max(sizes) == 20
    got = {(r.query, r.neighbor) for r in neighbors.knn_join(rows, rows, 1, True, n_centers=50).collect()}
    gap = ((vecs[:, None] - vecs[None]) ** 2).sum(2)
    np.fill_diagonal(gap, np.inf)
    assert got == set(enumerate(gap.argmin(1).tolist()))
    direct = {(r.query, r.neighbor) for r in neighbors.knn_join(rows, rows, 1, True).collect()}
    assert direct == got
    twice = spark.createDataFrame([(1, [0.0, 0.0]), (1, [9.0, 9.0]), (2, [0.0, 1.0]), (3, [9.0, 8.5])], "id long, vec array<double>")
    found = sorted((r.query, r.neighbor, r.dist) for r in neighbors.knn_join(twice, twice, 1, True, n_centers=2).collect())
    assert found == [(1, 3, 0.5), (2, 1, 1.0), (3, 1, 0.5)]


def test_components_of_long_paths_take_few_rounds(spark, monkeypatch):
    """Nodes merge along paths, so rounds grow with the logarithm of their length, not with the length."""
    monkeypatch.setattr(graph, "FEW", 20)
    rounds = []
    once = graph.merged
    monkeypatch.setattr(graph, "merged", lambda edges, number: rounds.append(number) or once(edges, number))
    links = [(i, i + 1) for i in range(1000, 1600)] + [(5, 5), (7, None), (None, 8), (3, 2), (2, 3)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 1000 for i in range(1000, 1601)}, 5: 5, 2: 2, 3: 2}
    assert 1 <= len(rounds) <= 6
