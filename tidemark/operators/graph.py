"""Mutual friends over an undirected friendship graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import hot_among, salted_join
from tidemark.session import via_table

PATHS = 1_000_000  # two-step paths of one user that one sub-key makes at most, about


def friend_pairs(links: DataFrame) -> DataFrame:
    """Distinct pairs u1 < u2; one-sided links count as friendship, self links are dropped."""
    return (
        links.filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("u1"), F.greatest("a", "b").alias("u2"))
        .distinct()
    )


def from_lists(lists: DataFrame, user: str = "user", friends: str = "friends") -> DataFrame:
    """Links from rows that hold a user and the list of that user's friends."""
    return lists.select(F.col(user).alias("a"), F.explode(friends).alias("b"))


def triangles(pairs: DataFrame) -> DataFrame:
    """Every set of three mutually connected users once, as (x, y, z).

    Each pair is directed from the user with fewer friends to the one with more.
    A user then points to at most sqrt(2 * pairs) others, however many friends they
    have, so the two-step paths that the join forms stay bounded for hubs as well.
    """
    counted = pairs.select(F.explode(F.array("u1", "u2")).alias("user")).groupBy("user").agg(F.count("*").alias("deg"))
    ends = via_table(counted, "degrees")  # read by both joins and for the hubs
    first = ends.select(F.col("user").alias("u1"), F.col("deg").alias("d1"))
    second = ends.select(F.col("user").alias("u2"), F.col("deg").alias("d2"))
    upward = F.struct(F.col("d1"), F.col("u1")) < F.struct(F.col("d2"), F.col("u2"))
    hubs = via_table(hot_among(ends, "user", "deg"), "hubs")
    with_first = salted_join(pairs, first, "u1", F.col("u2"), hot=hubs.withColumnRenamed("user", "u1"))
    with_both = salted_join(with_first, second, "u2", F.col("u1"), hot=hubs.withColumnRenamed("user", "u2"))
    directed = with_both.select(
        F.when(upward, F.col("u1")).otherwise(F.col("u2")).alias("low"),
        F.when(upward, F.col("u2")).otherwise(F.col("u1")).alias("high"),
    )
    edges = via_table(directed.where("low IS NOT NULL"), "edges")  # read twice by the paths, once for the degrees
    # A user who points to d others makes d * d paths: these are dealt over d * d / PATHS sub-keys.
    out = edges.groupBy("low").agg(F.count("*").alias("d"))
    deals = out.select("low", F.ceil(F.col("d") * F.col("d") / PATHS).cast("int").alias("deals"))
    spread = edges.join(deals, "low")
    one = spread.select(
        F.col("low").alias("x"), F.col("high").alias("y"), F.pmod(F.xxhash64("high"), F.col("deals")).cast("int").alias("deal")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("deals") - 1))
    two = spread.select(F.col("low").alias("x"), F.col("high").alias("z"), every.alias("deal"))
    paths = one.join(two, ["x", "deal"]).filter(F.col("y") < F.col("z"))
    closing = pairs.select(F.col("u1").alias("y"), F.col("u2").alias("z"))
    return paths.join(closing, ["y", "z"], "left_semi").select("x", "y", "z")


def mutual_friends(links: DataFrame) -> DataFrame:
    """(u1, u2, friend): one row per pair of friends and friend they share."""
    return shared_friends(friend_pairs(links))


def shared_friends(pairs: DataFrame) -> DataFrame:
    found = triangles(pairs)

    def row(a, b, c):
        return F.struct(F.least(a, b).alias("u1"), F.greatest(a, b).alias("u2"), F.col(c).alias("friend"))

    return found.select(F.explode(F.array(row("x", "y", "z"), row("x", "z", "y"), row("y", "z", "x"))).alias("m")).select(
        "m.*"
    )


def mutual_friend_counts(links: DataFrame) -> DataFrame:
    """Every pair of friends with the number, the smallest, the largest and the sum of shared friends."""
    pairs = via_table(friend_pairs(links), "friend-pairs")
    shared = shared_friends(pairs).groupBy("u1", "u2").agg(
        F.count("*").alias("n_mutual"),
        F.min("friend").alias("first_friend"),
        F.max("friend").alias("last_friend"),
        F.sum("friend").alias("friend_sum"),
    )
    return pairs.join(shared, ["u1", "u2"], "left").na.fill(0, ["n_mutual", "friend_sum"])


FEW = 10_000  # links that the driver joins at once


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of links (a, b) is connected with.

    In a round every node points to its neighbor of the least hash and nodes are merged along these pointers. Each
    merges with at least one other, so at most about half are left whatever the length of the paths; hashes differ by round, which
    keeps pointer chains short. The last FEW links are joined on the driver.
    """
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = links.select("a", "b").unionAll(turned).where("a IS NOT NULL AND b IS NOT NULL").distinct()
    edges = via_table(both, "component-links")
    names = edges.select(F.col("a").alias("node"), F.col("a").alias("at")).distinct()  # what each node is merged into so far
    edges, number = edges.where("a <> b"), 0
    while True:
        few = edges.where("a < b").limit(FEW + 1).collect()
        if len(few) <= FEW:
            moved = joined_at_once(edges.sparkSession, few, names.schema["at"].dataType.simpleString())
        else:
            moved = via_table(merged(edges, number), "component-moves")
        names = names.join(moved.select(F.col("node").alias("at"), "to"), "at", "left").select("node", F.coalesce("to", "at").alias("at"))
        names = via_table(names, "component-names")
        if len(few) <= FEW:
            break
        left = edges.join(moved.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        both = left.join(moved.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        edges = via_table(both.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "component-links")
        number += 1
    least = names.groupBy("at").agg(F.min("node").alias("label"))
    return names.join(least, "at").select("node", "label")


def merged(edges: DataFrame, number: int) -> DataFrame:
    """(node, to): every node and a node that it is merged into, along up to eight pointers to neighbors of least hash."""
    order = lambda c: F.struct(F.xxhash64(c, F.lit(number)), F.col(c))
    points = via_table(edges.groupBy("a").agg(F.min_by("b", order("b")).alias("to")).withColumnRenamed("a", "node"), "component-points")
    after = lambda p: p.select(F.col("node").alias("to"), F.col("to").alias("next"))
    # Two nodes that point to each other are the only circle: the lesser one stays.
    stays = (F.col("next") == F.col("node")) & (order("node") < order("to"))
    points = points.join(after(points), "to").select("node", F.when(stays, F.col("node")).otherwise(F.col("to")).alias("to"))
    for _ in range(3):
        points = via_table(points, "component-points")
        points = points.join(after(points), "to").select("node", F.col("next").alias("to"))
    return points


def joined_at_once(spark, few: list, kind: str) -> DataFrame:
    """(node, to) of at most FEW links (a, b)."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for r in few:
        a, b = sorted((root(r["a"]), root(r["b"])))
        parent[b] = a
    return spark.createDataFrame([(x, root(x)) for x in parent], f"node {kind}, to {kind}")
