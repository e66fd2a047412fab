"""Single-linkage hierarchy of points: a minimum spanning tree from small trees over boxes of points.

Points are dealt to the leaves of a k-d tree whose cuts come from a sample, so a leaf holds a bounded number of rows. A task finds
the minimum spanning tree of a leaf's points (Prim). No link between two points of a leaf that its own tree lacks is in
the tree of all points. A leaf's link is certain where one of the parts it joins is nearer to its other points than to the
edge of the leaf's region; the other links stay open.

What joins two leaves is bounded from above: points taken from the sides of the boxes give links between neighboring leaves, which
with the longest link of each leaf's tree lead from any leaf to any other. A link longer than the longest step of
that way is not in the tree. So two leaves meet only if their boxes are that near, and only with their points that
near to the other box; a link between them that the tree of these points lacks is not in the tree of all either. The
open links of all leaves and pairs, between the parts that certain links have made, are few; Borůvka rounds thin them to
FEW, of which the driver takes the rest of the tree. On points of many dimensions boxes exclude little, and all leaves meet in pairs.

Links are ordered by (distance, smaller id, larger id), so the tree is the same however rows are dealt. Equal points are
linked with their least id at distance 0 first. Sorted by distance the tree's links are the merges of the
hierarchy and their heights; the clusters at a height are the components of the links up to it.

Points with a null id or vector take no part, nor do vectors with a number that is null or not finite, besides being linked
with their equals; a single point has no link; an empty table gives none.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark.functions.vectors import SLACK, squares
from tidemark.operators.graph import components
from tidemark.operators.neighbors import BLOCK_ROWS, matrix, usable
from tidemark.operators.ordered import running_rank
from tidemark.session import bounded_batches, via_table

FEW = 1_000_000  # open links that the driver takes
MAX_LEAVES = 2048  # the driver compares the boxes of all
DRAWN = 64  # sampled points a leaf
SHOWN = 64  # points a leaf shows to its neighbors
INTS, REALS = pa.list_(pa.int64()), pa.list_(pa.float64())
BOX = {"leaf": pa.int32(), "lo": REALS, "hi": REALS, "longest": pa.float64(), "shown": REALS}
SURE = {"sure_a": INTS, "sure_b": INTS, "sure_dist": REALS}
OPEN = {"dist": pa.float64(), "a": pa.int64(), "b": pa.int64(), "part_a": pa.int64(), "part_b": pa.int64()}
LEAF = BOX | {"ids": INTS, "flat": REALS, "part": INTS} | SURE | {f"open_{c}": pa.list_(t) for c, t in OPEN.items()}
SIDE = {"one": pa.int32(), "other": pa.int32(), "reach": pa.float64(), "first": pa.bool_(), "ids": INTS, "flat": REALS, "part": INTS}


class Regions(NamedTuple):
    """A k-d tree: a row goes right of a node where its number in `dim` is above `cut`; a negative child is a leaf's complement."""

    dim: np.ndarray
    cut: np.ndarray
    child: np.ndarray  # [nodes, 2]
    low: np.ndarray  # [leaves, width]: all rows of a leaf are above
    high: np.ndarray  # and not above

    @classmethod
    def of(cls, drawn: np.ndarray, most: float) -> Regions:
        """Cuts in the middle of the widest side until a leaf has at most `most` of the drawn rows."""
        width = drawn.shape[1]
        dim, cut, child, low, high = [], [], [], [], []
        todo = [(drawn, np.full(width, -np.inf), np.full(width, np.inf), None)]
        while todo:
            rows, lo, hi, above = todo.pop()
            side = int((rows.max(0) - rows.min(0)).argmax())
            values = np.sort(rows[:, side])
            if len(rows) <= most or values[0] == values[-1]:
                place = ~len(low)
                low.append(lo)
                high.append(hi)
            else:
                at = values[(len(values) - 1) // 2]
                at = at if at < values[-1] else values[np.searchsorted(values, at) - 1]
                place, right = len(dim), rows[:, side] > at
                dim.append(side)
                cut.append(at)
                child.append([0, 0])
                lower, upper = hi.copy(), lo.copy()
                lower[side] = upper[side] = at
                todo += [(rows[~right], lo, lower, (place, 0)), (rows[right], upper, hi, (place, 1))]
            if above:
                child[above[0]][above[1]] = place
        return cls(np.array(dim, int), np.array(cut), np.array(child, int).reshape(-1, 2), np.array(low), np.array(high))

    def leaf(self, vecs: np.ndarray) -> np.ndarray:
        node = np.full(len(vecs), 0 if len(self.dim) else -1)
        inner = np.flatnonzero(node >= 0)
        while len(inner):
            k = node[inner]
            node[inner] = self.child[k, (vecs[inner, self.dim[k]] > self.cut[k]).astype(int)]
            inner = inner[node[inner] >= 0]
        return ~node

    def margin(self, leaf: int, vecs: np.ndarray) -> np.ndarray:
        """How far every row of a leaf is at least from all rows of other leaves."""
        return np.minimum(vecs - self.low[leaf], self.high[leaf] - vecs).min(1)


def numbers(column, width: int) -> np.ndarray:
    """The vectors of an Arrow column as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, width)


def small_tree(vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, dist) of the minimum spanning tree of rows in order of their ids, a < b as places, links by (dist, a, b)."""
    n = len(vecs)
    if n < 2:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    rest, place = np.array(vecs.T, order="C")[:, 1:].copy(), np.arange(1, n)
    best, link = np.full(n - 1, np.inf), np.zeros(n - 1, int)
    a, b, dist = np.empty(n - 1, int), np.empty(n - 1, int), np.empty(n - 1)
    now, at = 0, vecs[0]
    for step in range(n - 1):
        m = n - 1 - step
        near, old, to = rest[0, :m] - at[0], best[:m], link[:m]
        near *= near
        for row, x in zip(rest[1:, :m], at[1:]):
            gap = row - x
            gap *= gap
            near += gap
        np.sqrt(near, out=near)
        shorter = near < old
        same = near == old
        if same.any():  # of equally short links to a row the one with the least other end comes first
            shorter |= same & (now < to)
        old[shorter] = near[shorter]
        to[shorter] = now
        j = int(old.argmin())
        ties = np.flatnonzero(old == old[j])
        if len(ties) > 1:
            p, q = place[ties], to[ties]
            j = int(ties[np.lexsort((np.maximum(p, q), np.minimum(p, q)))[0]])
        now, at = int(place[j]), rest[:, j].copy()
        a[step], b[step], dist[step] = min(now, to[j]), max(now, to[j]), old[j]
        last = m - 1
        rest[:, j], place[j], best[j], link[j] = rest[:, last], place[last], best[last], link[last]
    order = np.lexsort((b, a, dist))
    return a[order], b[order], dist[order]


def root(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = x = parent[parent[x]]
    return x


def certain(a, b, dist, margin) -> tuple[np.ndarray, np.ndarray]:
    """Which links of a leaf's tree, in order, are in the tree of all points, and the part of every row that these make."""
    whole, parts, margin = list(range(len(margin))), list(range(len(margin))), margin.tolist()
    sure = np.zeros(len(a), bool)
    for k, (i, j, d) in enumerate(zip(a.tolist(), b.tolist(), dist.tolist())):
        i, j = root(whole, i), root(whole, j)
        if max(margin[i], margin[j]) * (1 - SLACK) > d:  # no way out of this part is as short
            sure[k] = True
            parts[root(parts, int(b[k]))] = root(parts, int(a[k]))
        whole[j], margin[i] = i, min(margin[i], margin[j])
    return sure, np.array([root(parts, x) for x in range(len(parts))], np.int64)


def shown(vecs: np.ndarray) -> np.ndarray:
    """At most about SHOWN rows that lie farthest out on the sides."""
    each = max(1, SHOWN // (2 * vecs.shape[1]))
    if len(vecs) <= 2 * each:
        return vecs
    sides = range(min(vecs.shape[1], SHOWN // 2))
    ends = [np.argpartition(s * vecs[:, i], each)[:each] for i in sides for s in (1, -1)]
    return vecs[np.unique(np.concatenate(ends))]


def trees(placed: DataFrame, regions: Regions, width: int, tasks: int) -> DataFrame:
    """A row per leaf of (leaf, id, vec): its points in order of their ids, their parts, box and links."""

    def run(table):
        leaf, ids, vecs = table["leaf"][0].as_py(), table["id"].to_numpy(), numbers(table["vec"], width)
        order = np.lexsort((*vecs.T[::-1], ids))
        ids, vecs = ids[order], vecs[order]
        a, b, dist = small_tree(vecs)
        sure, part = certain(a, b, dist, regions.margin(leaf, vecs))
        part = (leaf << 32) + part
        box = {"leaf": leaf, "lo": vecs.min(0), "hi": vecs.max(0), "longest": dist.max(initial=0.0), "shown": shown(vecs).ravel()}
        left = a[~sure], b[~sure]
        links = {"sure_a": ids[a[sure]], "sure_b": ids[b[sure]], "sure_dist": dist[sure], "open_dist": dist[~sure]}
        links |= {f"open_{c}": ids[x] for c, x in zip("ab", left)} | {f"open_part_{c}": part[x] for c, x in zip("ab", left)}
        return one_row(box | {"ids": ids, "flat": vecs.ravel(), "part": part} | links, LEAF)

    return placed.repartition(tasks, "leaf").groupBy("leaf").applyInArrow(run, from_arrow_schema(pa.schema(LEAF)))


def one_row(values: dict, kinds: dict) -> pa.Table:
    return pa.table([pa.array([values[c]], t) for c, t in kinds.items()], pa.schema(kinds))


def outside(vecs: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The distance of every row to a box."""
    gap = np.maximum(np.maximum(lo - vecs, vecs - hi), 0)
    return np.sqrt((gap * gap).sum(1))


def meetings(lo: np.ndarray, hi: np.ndarray, longest: np.ndarray, ends: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, reach): pairs of leaves between which a link of the tree can be, and how long it is at most."""
    n, width = lo.shape
    gap = np.zeros((n, n))
    for d in range(width):
        apart = np.maximum(lo[:, None, d] - hi[None, :, d], lo[None, :, d] - hi[:, None, d])
        gap += np.maximum(apart, 0, out=apart) ** 2
    gap = np.sqrt(gap, out=gap)
    # The shortest links found between the ends of neighbors; every leaf has the next one as a neighbor, so all are connected.
    way, known = np.full((n, n), np.inf), min(n, 4 * width + 8)
    flat, sizes = np.concatenate(ends), np.array([len(e) for e in ends])
    starts, origin = np.cumsum(sizes) - sizes, flat.mean(0)
    for i in range(n):
        near = np.unique([*np.argpartition(gap[i], known - 1)[:known], min(i + 1, n - 1)])
        near = near[near != i]
        if len(near):
            rows = np.concatenate([np.arange(starts[j], starts[j] + sizes[j]) for j in near])
            square, slack = squares(ends[i] - origin, flat[rows] - origin)
            least = np.minimum.reduceat((square + slack).min(0), np.cumsum(sizes[near]) - sizes[near])
            way[i, near] = np.maximum(np.sqrt(least) * (1 + SLACK), np.maximum(longest[i], longest[near]))
    way = np.minimum(way, way.T)
    # The longest step of the best way between all leaves, leaf by leaf along the tree of these ways.
    best, link, seen, most = way[0].copy(), np.zeros(n, int), [0], np.zeros((n, n))
    best[0] = np.inf
    for _ in range(n - 1):
        j = int(best.argmin())
        step = np.maximum(most[link[j], seen], best[j])
        most[j, seen], most[seen, j] = step, step
        seen.append(j)
        closer = way[j] < best
        closer[seen] = False
        best[closer], link[closer] = way[j][closer], j
        best[j] = np.inf
    most *= 1 + 1e-9
    i, j = np.nonzero(np.triu(gap <= most, 1))
    return i, j, most[i, j]


def between(leaves: DataFrame, boxes: list, width: int, tasks: int) -> DataFrame:
    """OPEN links between leaves: the links of the trees of two leaves' points that are near to each other's boxes."""
    boxes = sorted(boxes, key=lambda r: r["leaf"])
    names = np.array([r["leaf"] for r in boxes])
    lo, hi = (np.array([r[c] for r in boxes], float) for c in ("lo", "hi"))
    i, j, reach = meetings(lo, hi, np.array([r["longest"] for r in boxes]), [matrix(r["shown"], len(r["shown"]) // width) for r in boxes])
    mine, others, far = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([reach, reach])
    order = np.argsort(mine, kind="stable")
    mine, others, far = mine[order], others[order].astype(np.int32), far[order]
    starts = np.searchsorted(mine, np.arange(len(names) + 1))

    def sides(batches):
        for batch in batches:
            for leaf, ids, flat, part in zip(*(batch[c] for c in ("leaf", "ids", "flat", "part")), strict=True):
                at = int(np.searchsorted(names, leaf.as_py()))
                ids, flat, part = (c.values.to_numpy() for c in (ids, flat, part))
                vecs = matrix(flat, len(ids))
                for k in range(starts[at], starts[at + 1]):
                    other, most = int(others[k]), float(far[k])
                    near = outside(vecs, lo[other], hi[other]) <= most
                    if near.any():
                        pair = {"one": min(at, other), "other": max(at, other), "reach": most, "first": at < other}
                        some = {"ids": ids[near], "flat": vecs[near].ravel(), "part": part[near]}
                        yield one_row(pair | some, SIDE).to_batches()[0]

    def links(table):
        if table.num_rows < 2:
            return pa.schema(OPEN).empty_table()
        columns = (table[c].combine_chunks() for c in ("ids", "flat", "part"))
        ids, flat, part = (c.flatten().to_numpy() for c in columns)
        vecs, first = matrix(flat, len(ids)), np.repeat(table["first"].to_numpy(), [len(x) for x in table["ids"]])
        order = np.lexsort((*vecs.T[::-1], ids))
        ids, vecs, part, first = ids[order], vecs[order], part[order], first[order]
        a, b, dist = small_tree(vecs)
        kept = (first[a] != first[b]) & (dist <= table["reach"][0].as_py())
        a, b = a[kept], b[kept]
        return pa.table([dist[kept], ids[a], ids[b], part[a], part[b]], pa.schema(OPEN))

    bounded_batches(leaves.sparkSession)
    sent = leaves.select("leaf", "ids", "flat", "part").mapInArrow(sides, from_arrow_schema(pa.schema(SIDE)))
    return sent.repartition(tasks, "one", "other").groupBy("one", "other").applyInArrow(links, from_arrow_schema(pa.schema(OPEN)))


def spanning_tree(points: DataFrame, n_centers: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b, dist): the links of the minimum spanning tree, a < b; `n_centers` or more leaves, of up to 2 * `block_rows` rows otherwise."""
    spark = points.sparkSession
    rows = via_table(usable(points), "linkage-points")
    first = via_table(rows.groupBy("vec").agg(F.min("id").alias("head")), "linkage-heads")
    equal = rows.join(first, "vec").where(F.col("id") != F.col("head"))
    tree = equal.select(F.col("head").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("dist"))
    told = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))  # a NaN is above infinity
    first = first.where(told).select(F.col("head").alias("id"), "vec")
    size = first.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("width")).first()
    n, width = size["n"], size["width"]
    if not n or not width:
        return tree
    most = 2 * n / n_centers if n_centers else max(2 * block_rows, 2 * n / MAX_LEAVES)
    wanted = DRAWN * 2 * n / most
    drawn = first.where(F.pmod(F.xxhash64("id", "vec"), F.lit(n)) < wanted).select("vec").toArrow() if wanted < n else first.select("vec").toArrow()
    drawn = numbers(drawn["vec"], width)
    regions = Regions.of(drawn, most * len(drawn) / n) if len(drawn) else Regions.of(np.zeros((1, width)), 1)

    def deal(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("leaf", pa.array(regions.leaf(numbers(batch["vec"], width)).astype(np.int32)))

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    placed = first.select("id", "vec").mapInArrow(deal, "id long, vec array<double>, leaf int")
    leaves = via_table(trees(placed, regions, width, tasks), "linkage-leaves")
    inner = leaves.select(F.explode(F.arrays_zip(*[F.col(f"open_{c}").alias(c) for c in OPEN])).alias("l")).select("l.*")
    boxes = leaves.select(*BOX).collect()  # at most about MAX_LEAVES
    left = via_table(inner.unionAll(between(leaves, boxes, width, tasks)).where("part_a <> part_b"), "linkage-open")
    sure = leaves.select(F.explode(F.arrays_zip(*[F.col(c).alias(c[5:]) for c in SURE])).alias("l")).select("l.*")
    return tree.unionAll(sure).unionAll(tree_of(left))


def tree_of(links: DataFrame) -> DataFrame:
    """(a, b, dist): the minimum spanning tree of parts that `links` (OPEN) connect; a list of at most FEW is taken on the driver."""
    found = None
    while links.count() > FEW:
        turned = links.select("dist", "a", "b", F.col("part_b").alias("part_a"), F.col("part_a").alias("part_b"))
        best = links.unionAll(turned).groupBy("part_a").agg(F.min(F.struct("dist", "a", "b", "part_b")).alias("l"))
        best = via_table(best.select(F.col("part_a"), "l.*"), "linkage-links")
        taken = best.select("a", "b", "dist").distinct()
        found = taken if found is None else found.unionAll(taken)
        into = via_table(components(best.select(F.col("part_a").alias("a"), F.col("part_b").alias("b"))), "linkage-parts")
        for c in ("part_a", "part_b"):
            links = links.join(into.select(F.col("node").alias(c), F.col("label").alias("_into")), c).drop(c).withColumnRenamed("_into", c)
        links = via_table(links.where("part_a <> part_b").select(*OPEN), "linkage-open")
        if links.isEmpty():
            return found
    rest = links.toArrow()
    dist, a, b = (rest[c].to_numpy() for c in ("dist", "a", "b"))
    parts, ends = np.unique(np.concatenate([rest["part_a"].to_numpy(), rest["part_b"].to_numpy()]), return_inverse=True)
    ends, parent, kept = ends.reshape(2, -1), list(range(len(parts))), []
    order = np.lexsort((b, a, dist))
    for k, i, j in zip(order.tolist(), ends[0][order].tolist(), ends[1][order].tolist()):
        i, j = root(parent, i), root(parent, j)
        if i != j:
            parent[j] = i
            kept.append(k)
    taken = links.sparkSession.createDataFrame(rest.select(["a", "b", "dist"]).take(pa.array(kept, pa.int64())))
    return taken if found is None else found.unionAll(taken)


def merges(tree: DataFrame) -> DataFrame:
    """(step, a, b, height): the links in the order in which single linkage merges clusters."""
    ranked = running_rank(tree.withColumnRenamed("dist", "height"), [], ["height", "a", "b"], "step")
    return ranked.select("step", "a", "b", "height")


def clusters(points: DataFrame, tree: DataFrame, height: float) -> DataFrame:
    """(id, cluster): the clusters at a height, each named by its least id."""
    found = components(tree.where(F.col("dist") <= height).select("a", "b"))
    ids = usable(points).select("id").distinct()
    return ids.join(found.select(F.col("node").alias("id"), "label"), "id", "left").select("id", F.coalesce("label", "id").alias("cluster"))
