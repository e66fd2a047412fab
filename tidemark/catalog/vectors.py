"""Vector conversions, neighbors and clustering on embeddings and line items."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.functions import vectors
from tidemark.operators import hashing, neighbors
from tidemark.plans import classify, cluster, linkage, mixture
from tidemark.session import via_table
from tidemark.sources.tables import descriptors, documents, table

# --- conversions -----------------------------------------------------------------

VEC_SQL = "v AS (SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


@query(
    "vector_codec",
    f"WITH {VEC_SQL} SELECT vec_id, CAST(len(e) AS INT) AS width, round(list_sum(e), 6) AS total FROM v",
)
def vector_codec(spark, folder):
    """Array to vector to text and back."""
    rows = descriptors(spark, folder).select("vec_id", array_to_vector("vec").alias("features"))
    as_text = rows.select("vec_id", vectors.to_text(vector_to_array("features")).alias("text"))
    back = as_text.select("vec_id", vectors.from_text(F.col("text")).alias("vec"))
    return back.select("vec_id", F.size("vec").alias("width"), F.round(vectors.total("vec"), 6).alias("total"))


@query(
    "l2_normalize",
    f"""WITH {VEC_SQL}, n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v)
    SELECT vec_id, round(norm, 6) AS norm, round(list_sum(e) / norm, 6) AS total, round(e[1] / norm, 6) AS first FROM n""",
)
def l2_normalize(spark, folder):
    rows = descriptors(spark, folder).select(
        "vec_id", vectors.l2_norm("vec").alias("norm"), vectors.l2_normalized(F.col("vec")).alias("unit")
    )
    return rows.select(
        "vec_id",
        F.round("norm", 6).alias("norm"),
        F.round(vectors.total("unit"), 6).alias("total"),
        F.round(F.col("unit")[0], 6).alias("first"),
    )


COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "feature_matrix",
    """SELECT l_orderkey, l_linenumber, round(l_quantity + l_extendedprice + l_discount + l_tax, 4) AS total,
    CAST(4 AS INT) AS width FROM lineitem""",
)
def feature_matrix(spark, folder):
    lines = table(spark, folder, "lineitem")
    bound = lines.select("l_orderkey", "l_linenumber", F.array(*COLUMNS).alias("vec"))
    return bound.select(
        "l_orderkey", "l_linenumber", F.round(vectors.total("vec"), 4).alias("total"), F.size("vec").alias("width")
    )


# --- neighbors ---------------------------------------------------------------------


def embedded(spark, folder):
    return descriptors(spark, folder).select(F.col("vec_id").alias("id"), "vec")


KNN_SQL = f"""WITH {VEC_SQL}, d AS (SELECT a.vec_id AS query, b.vec_id AS neighbor,
    sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS dist
  FROM v a JOIN v b ON a.vec_id != b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY dist, neighbor) AS rank FROM d)
SELECT query, rank, neighbor, round(dist, 6) AS dist FROM r WHERE rank <= """


@query("knn_bruteforce", KNN_SQL + "1")
def knn_bruteforce(spark, folder):
    """The nearest other vector of every vector (k = 1)."""
    rows = embedded(spark, folder)
    found = neighbors.knn_join(rows, rows, k=1, exclude_self=True)
    return found.withColumn("dist", F.round("dist", 6))


def probes(n: int) -> int:
    """A twelfth of the cells, of which there are about as many as the square root of the rows; four of them at least."""
    return max(4, math.isqrt(n) // 12)


def letter_vectors(spark, folder):
    """(id, vec): the letter shares of every document."""
    docs = documents(spark, folder)
    rows = classify.with_letter_shares(docs).select(F.col("doc_id").alias("id"), "vec")
    return via_table(rows, "letter-vectors")


def recall(exact, found):
    """(n, recall) of the approximate neighbors: a neighbor at the exact distance is right."""
    best = exact.select("query", F.col("dist").alias("least"))
    right = F.coalesce(F.col("dist") <= F.col("least") * (1 + 1e-9) + 1e-12, F.lit(False)).cast("int")
    return best.join(found.select("query", "dist"), "query", "left").agg(F.count("*").alias("n"), F.avg(right).alias("recall"))


@query("knn_approx")
def knn_approx(spark, folder):
    """The nearest other document by letter shares, from a twelfth of the cells per query."""
    rows = letter_vectors(spark, folder)
    return neighbors.knn_approx(rows, rows, k=1, probes=probes(rows.count()), exclude_self=True)


ASKED_SQL = "SELECT count(*) AS n, true AS enough FROM documents WHERE doc_id % 20 = 0"


@query("knn_approx_recall", ASKED_SQL)
def knn_approx_recall(spark, folder):
    """Whether a twelfth of the cells holds the nearest document for nine of ten queries (every twentieth document)."""
    rows = letter_vectors(spark, folder)
    asked = rows.where("id % 20 = 0")
    exact = neighbors.knn_join(asked, rows, k=1, exclude_self=True)
    found = neighbors.knn_approx(asked, rows, k=1, probes=probes(rows.count()), exclude_self=True)
    return recall(exact, found).select("n", (F.col("recall") >= 0.9).alias("enough"))


@query("knn_lsh")
def knn_lsh(spark, folder):
    """The nearest other document by letter shares, from hash tables."""
    rows = letter_vectors(spark, folder)
    return hashing.knn_lsh(rows, rows, k=1, exclude_self=True)


def order_points(spark, folder):
    """(id, vec): price, day and customer of every order."""
    orders = table(spark, folder, "orders").withColumns({"id": F.col("o_orderkey"), "day": F.unix_date(F.to_date("o_orderdate"))})
    return via_table(cluster.points(orders, ["o_totalprice", "day", "o_custkey"], "id"), "order-points")


@query("knn_lsh_recall", "SELECT count(*) AS n, true AS enough, true AS few FROM orders WHERE o_orderkey % 20 = 0")
def knn_lsh_recall(spark, folder):
    """Whether the hash tables find the nearest order for nine of ten queries (every twentieth order), and
    compare less than a tenth of all pairs where there are 2,000 orders or more."""
    rows = order_points(spark, folder)
    asked = rows.where("id % 20 = 0")
    exact = neighbors.knn_join(asked, rows, k=1, exclude_self=True)
    blocks = hashing.candidate_blocks(asked, rows, 1, hashing.TABLES, hashing.LEAF, seed=1)
    blocks = via_table(blocks.select("qids", "qflat", "ids", "flat"), "hash-blocks")
    found = recall(exact, hashing.nearest_of(blocks, 1, exclude_self=True))
    pairs = hashing.pair_count(blocks).scalar()
    n = rows.count()
    few = (F.lit(n) < 2000) | (pairs < F.col("n") * F.lit(n) / 10)
    return found.select("n", (F.col("recall") >= 0.9).alias("enough"), few.alias("few"))


@query(
    "pairwise_distance",
    """WITH d AS (SELECT a.s_suppkey AS id, b.s_suppkey AS other,
      sqrt(pow(a.s_acctbal - b.s_acctbal, 2) + pow(a.s_nationkey - b.s_nationkey, 2)) AS dist
      FROM supplier a JOIN supplier b ON a.s_suppkey != b.s_suppkey)
    SELECT id, arg_min(other, row(dist, other)) AS nearest, round(min(dist), 4) AS nearest_dist,
      round(avg(dist * dist), 1) AS mean_square FROM d GROUP BY 1""",
)
def pairwise_distance(spark, folder):
    suppliers = table(spark, folder, "supplier")
    rows = cluster.points(suppliers.withColumnRenamed("s_suppkey", "id"), ["s_acctbal", "s_nationkey"], "id")
    profile = neighbors.distance_profile(rows)
    return profile.select(
        "id",
        "nearest",
        F.round("nearest_dist", 4).alias("nearest_dist"),
        F.round("mean_square", 1).alias("mean_square"),
    )


# --- clustering -----------------------------------------------------------------------

ASSIGNED_SQL = f"""WITH {VEC_SQL},
c AS (SELECT label AS word, list(m ORDER BY i) AS c FROM (
  SELECT label, i, avg(e[i]) AS m FROM v, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2) GROUP BY 1),
d AS (SELECT vec_id, word, list_sum(list_transform(list_zip(e, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2 FROM v, c),
a AS (SELECT vec_id, arg_min(word, row(d2, word)) AS word, min(d2) AS d2 FROM d GROUP BY 1)"""


@query(
    "visual_word_histogram",
    ASSIGNED_SQL
    + """, h AS (SELECT vec_id // 10 AS image_id, word, count(*) AS n FROM a GROUP BY 1, 2),
    t AS (SELECT image_id, sum(n) AS total FROM h GROUP BY 1)
    SELECT t.image_id, CAST(c.word AS INT) AS word, round(coalesce(h.n, 0) / total, 6) AS share
    FROM t CROSS JOIN c LEFT JOIN h ON h.image_id = t.image_id AND h.word = c.word""",
)
def visual_word_histogram(spark, folder):
    rows = descriptors(spark, folder)
    histogram = cluster.word_histogram(rows, cluster.label_centers(rows, "label"))
    return histogram.withColumn("share", F.round("share", 6))


@query("wssse", ASSIGNED_SQL + " SELECT count(*) AS n, round(sum(d2), 6) AS wssse FROM a")
def wssse(spark, folder):
    rows = descriptors(spark, folder)
    return cluster.wssse(rows, cluster.label_centers(rows, "label")).withColumn("wssse", F.round("wssse", 6))


@query("kmeans_vocab")
def kmeans_vocab(spark, folder, k=400):
    """A codebook of `k` words; fewer only where there are fewer distinct descriptors."""
    rows = via_table(descriptors(spark, folder).select("vec"), "descriptors")
    return cluster.cluster_report(cluster.fit_kmeans(rows, k, 20), rows)


def measures(spark, folder):
    return cluster.points(table(spark, folder, "lineitem"), COLUMNS)


@query("kmeans_features")
def kmeans_features(spark, folder):
    rows = measures(spark, folder)
    return cluster.cluster_report(cluster.fit_kmeans(rows, 3, 25), rows)


@query("bisecting_hierarchy")
def bisecting_hierarchy(spark, folder):
    rows = measures(spark, folder)
    return cluster.cluster_report(cluster.fit_bisecting(rows, 4), rows)


@query("gmm_svd")
def gmm_svd(spark, folder):
    """Ten components over the line items, started along the principal directions."""
    model, history = mixture.fit(measures(spark, folder), 10)
    return mixture.report(spark, model, history)


def customer_points(spark, folder):
    customers = table(spark, folder, "customer").withColumnRenamed("c_custkey", "id")
    return via_table(cluster.points(customers, ["c_acctbal", "c_nationkey"], "id"), "customers")


@query("single_linkage")
def single_linkage(spark, folder):
    """The merges of the customers' single-linkage hierarchy, in order, with their heights."""
    return linkage.merges(linkage.spanning_tree(customer_points(spark, folder)))


@query(
    "linkage_clusters",
    """WITH RECURSIVE p AS (SELECT c_custkey AS id, c_acctbal AS x, c_nationkey AS y FROM customer),
    near AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON abs(a.x - b.x) <= 4 AND abs(a.y - b.y) <= 4
      AND sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 4),
    reach AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON n.a = r.b)
    SELECT a AS id, min(b) AS cluster, count(*) AS size FROM reach GROUP BY 1""",
)
def linkage_clusters(spark, folder):
    """The clusters of that hierarchy at height 4."""
    points = customer_points(spark, folder)
    found = via_table(linkage.clusters(points, linkage.spanning_tree(points), 4.0), "linkage-clusters")
    return found.join(found.groupBy("cluster").agg(F.count("*").alias("size")), "cluster").select("id", "cluster", "size")


@query("gmm_features")
def gmm_features(spark, folder):
    rows = measures(spark, folder)
    return cluster.mixture_report(cluster.fit_mixture(rows, 10, iters=100), rows)


def flag_centers(spark, folder):
    rows = table(spark, folder, "lineitem")
    return cluster.label_centers(cluster.points(rows, COLUMNS, "l_returnflag"), "l_returnflag")


@query(
    "kmedians_step",
    """WITH c AS (SELECT row_number() OVER (ORDER BY l_returnflag) - 1 AS word, avg(l_quantity) AS a, avg(l_extendedprice) AS b,
        avg(l_discount) AS c, avg(l_tax) AS d FROM lineitem GROUP BY l_returnflag),
    d AS (SELECT l.*, arg_min(word, row(abs(l_quantity - a) + abs(l_extendedprice - b) + abs(l_discount - c) + abs(l_tax - d), word)) AS word
      FROM (SELECT row_number() OVER () AS r, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) l, c GROUP BY ALL),
    p AS (SELECT word, unnest([0, 1, 2, 3]) AS i, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS x FROM d)
    SELECT CAST(word AS INT) AS word, CAST(i AS INT) AS i, round(quantile_cont(x, 0.5), 6) AS median FROM p GROUP BY 1, 2""",
)
def kmedians_step(spark, folder):
    step = cluster.kmedians_step(measures(spark, folder), flag_centers(spark, folder))
    return step.withColumn("median", F.round("median", 6))


@query(
    "median",
    "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median FROM lineitem GROUP BY 1",
)
def median(spark, folder):
    from tidemark.operators.ordered import exact_median

    lines = table(spark, folder, "lineitem")
    return exact_median(lines, ["l_returnflag"], "l_extendedprice").withColumn("median", F.round("median", 4))


@query("kmedians")
def kmedians(spark, folder):
    lines = table(spark, folder, "lineitem")
    keyed = lines.withColumn("k", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    rows = via_table(cluster.points(keyed, COLUMNS, "k"), "points")
    centers = cluster.fit_kmedians(rows, "k", 4, iters=25)
    sizes = cluster.assigned(rows.select("vec"), centers, "l1").groupBy("word").agg(
        F.count("*").alias("size"), F.sum("dist").alias("cost")
    )
    listed = F.array(*[F.array(*map(F.lit, c)) for c in centers])
    return sizes.withColumn("center", F.element_at(listed, F.col("word") + 1))
