"""DBSCAN on cells (J10), exact, without a table of all pairs within eps.

Points fall into grid cells whose diagonal is at most eps.  Then

* a cell with ``min_samples`` points has only core points, without looking at any pair;
* the points of the other cells (fewer than ``min_samples`` each) count their neighbours, cell by
  cell: a cell wholly within eps counts as a whole, only others are compared point by point;
* the core points of a cell are one cluster, and two cells belong together if their nearest
  core points are within eps: decided by their boxes where these are all within eps or all beyond,
  by at most ``SMALL`` x ``SMALL`` comparisons where both are small, and else by halving both
  at the median of their widest side and asking again, which takes log2(points / SMALL) rounds;
* the clusters are the connected components of cells;
* a point that is not core takes the smallest cluster with a core point within eps.

Work per point is bounded by ``min_samples`` and the number of neighbouring cells, so a blob in
one cell costs what its points cost anywhere else.
"""
from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread_out, written
from .graph import connected_components
from .ordering import sequence_index_sized
from .tree import distance, farthest, nearest, usable

SMALL = 64


def _box(points: DataFrame, keys: list[str], dims: int) -> DataFrame:
    """Number, bounding box and smallest id of the points of each group."""
    return points.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.min(F.col("v")[i]) for i in range(dims)]).alias("lo"),
        F.array(*[F.max(F.col("v")[i]) for i in range(dims)]).alias("hi"), F.min("id").alias("first_id"))


def _named(nodes: DataFrame, side: str, *cols: str) -> DataFrame:
    return nodes.select(*[F.col(c).alias(f"{c}_{side}") for c in cols])


def _neighbour_cells(cells: DataFrame, dims: int, eps: float) -> DataFrame:
    """(a, b) in both directions, a = b included, for cells whose boxes are within eps: an
    equi-join on the first coordinates' cell numbers moved by every offset within reach."""
    reach, axes = math.floor(math.sqrt(dims) * (1 + 1e-9)) + 1, min(dims, 3)
    moves = F.array(*[F.array(*[F.lit(o).cast("long") for o in offset])
                      for offset in itertools.product(range(-reach, reach + 1), repeat=axes)])
    at = F.slice("cell", 1, axes)
    asked = cells.select(F.col("cell").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"),
                         F.explode(F.transform(moves, lambda m: F.zip_with(at, m, lambda x, y: x + y))).alias("at"))
    there = cells.select(F.col("cell").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), at.alias("at"))
    return spread_out(asked, "at").join(spread_out(there, "at"), "at").where(nearest(F.col("lo_a"), F.col("hi_a"), F.col("lo_b"), F.col("hi_b"), dims) <= eps).select("a", "b")


def _near_points(points: DataFrame, pairs: DataFrame, cells: DataFrame, members: DataFrame, eps: float, dims: int,
                 cols: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Of ``points`` (id, v, cell) and the cells in reach (with their columns ``cols``): those wholly within
    eps of the point, and the single ``members`` within eps of the others."""
    reach = spread_out(points, "cell").join(spread_out(pairs.withColumnRenamed("a", "cell"), "cell"), "cell").drop("cell")
    reach = reach.join(cells.select(F.col("cell").alias("b"), "lo", "hi", *cols), "b")
    v = F.col("v")
    reach = reach.where(nearest(v, v, F.col("lo"), F.col("hi"), dims) <= eps)
    whole = farthest(v, v, F.col("lo"), F.col("hi"), dims) <= eps
    single = (reach.where(~whole).drop("lo", "hi").join(members.select(F.col("cell").alias("b"), F.col("v").alias("w")), "b")
              .where(distance(v, F.col("w"), dims) <= eps))
    return reach.where(whole), single


def _joined_cells(core: DataFrame, cells: DataFrame, pairs: DataFrame, eps: float, dims: int) -> DataFrame:
    """(a, b) for core cells a < b with core points within eps of each other."""
    points = core.withColumn("path", F.lit(0).cast("long"))
    nodes = cells.withColumn("path", F.lit(0).cast("long"))
    pairs = pairs.where("a < b").select("a", "b", F.lit(0).cast("long").alias("pa"), F.lit(0).cast("long").alias("pb"))
    joined = None
    while True:
        small = nodes.where(F.col("n") <= SMALL).select("cell", "path")
        lists = points.join(small, ["cell", "path"]).groupBy("cell", "path").agg(F.collect_list("v").alias("pts"))
        full = nodes.join(lists, ["cell", "path"], "left")
        side = lambda s: _named(full.withColumnsRenamed({"cell": s, "path": f"p{s}"}), s, "lo", "hi", "pts", s, f"p{s}").withColumnsRenamed(
            {f"{s}_{s}": s, f"p{s}_{s}": f"p{s}"})
        box = [F.col(c) for c in ("lo_a", "hi_a", "lo_b", "hi_b")]
        asked = (spread_out(pairs.join(side("a"), ["a", "pa"]), "b", "pb").join(side("b"), ["b", "pb"])
                 .where(nearest(*box, dims) <= eps)
                 .withColumn("all", farthest(*box, dims) <= eps)
                 .withColumn("listed", F.col("pts_a").isNotNull() & F.col("pts_b").isNotNull()))
        some = F.exists("pts_a", lambda x: F.exists("pts_b", lambda y: distance(x, y, dims) <= eps))
        asked = written(asked.select("a", "b", "pa", "pb", "listed",
                                         (F.col("all") | F.when(F.col("listed"), some).otherwise(F.lit(False))).alias("yes")))
        found = asked.where("yes").select("a", "b").distinct()
        joined = found if joined is None else joined.unionByName(found)
        left = asked.where("not yes and not listed").select("a", "b", "pa", "pb").join(found, ["a", "b"], "left_anti")
        left = written(left)
        if left.isEmpty():
            return joined
        # Halve the nodes still in question, each along its widest side.
        ask = left.select(F.col("a").alias("cell"), F.col("pa").alias("path")).union(left.select("b", "pb")).distinct()
        width = F.zip_with("hi", "lo", lambda x, y: x - y)
        widest = F.array_position(width, F.array_max(width)).cast("int")
        open_points = points.join(nodes.join(ask, ["cell", "path"]).select("cell", "path", widest.alias("axis")), ["cell", "path"])
        cut = sequence_index_sized(open_points.withColumn("x", F.element_at("v", F.col("axis"))).drop("axis"), ["x", "id"], ["cell", "path"], "pos", "size")
        points = written(cut.select("id", "v", "cell", (F.col("path") * 2 + (F.col("pos") * 2 > F.col("size")).cast("int")).alias("path")))
        nodes = written(_box(points, ["cell", "path"], dims))
        child = lambda s: nodes.select(F.col("cell").alias(s), F.floor(F.col("path") / 2).alias(f"p{s}"), F.col("path").alias(f"c{s}"))
        pairs = left.join(child("a"), ["a", "pa"]).join(child("b"), ["b", "pb"]).select("a", "b", F.col("ca").alias("pa"), F.col("cb").alias("pb"))


def dbscan(df: DataFrame, id_col: str, vec: str, eps: float, min_samples: int) -> DataFrame:
    """(id, cluster, is_core) per row: a core point has at least ``min_samples`` points within ``eps``
    (itself included); a cluster's id is the smallest id of its core points; other points within
    eps of a core point take the smallest such cluster; noise is -1, and so are rows whose vector
    is missing or not finite.  Ids are numbers and unique; an empty table gives no rows."""
    p = usable(df.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v")), "v")
    head = p.agg(F.max(F.size("v")).alias("d"), F.max(F.array_max(F.transform("v", F.abs))).alias("far")).first()
    rest = df.select(F.col(id_col).alias("id"))
    if head["d"] is None:
        return rest.select(F.col("id").alias(id_col), F.lit(-1).cast("long").alias("cluster"), F.lit(False).alias("is_core"))
    dims = head["d"]
    side = eps / math.sqrt(dims) * (1 - 1e-9)  # so that rounding keeps a cell's points within eps
    if head["far"] / side >= 2.0 ** 53:
        raise ValueError("eps is too small beside the coordinates")
    points = written(p.withColumn("cell", F.transform("v", lambda x: F.floor(x / side))))
    cells = written(_box(points, ["cell"], dims))
    pairs = written(_neighbour_cells(cells, dims, eps))

    sparse = points.join(cells.where(F.col("n") < min_samples).select("cell"), "cell")
    whole, single = _near_points(sparse, pairs, cells, points, eps, dims, ("n",))
    counts = whole.select("id", "n").unionByName(single.select("id", F.lit(1).cast("long").alias("n"))).groupBy("id").agg(F.sum("n").alias("n"))
    enough = written(counts.where(F.col("n") >= min_samples).select("id"))
    core = written(points.join(cells.where(F.col("n") >= min_samples).select("cell"), "cell").select("id", "v", "cell")
                       .unionByName(sparse.join(enough, "id").select("id", "v", "cell")))

    core_cells = written(_box(core, ["cell"], dims))
    is_core = core_cells.select("cell")
    between = pairs.join(is_core.withColumnRenamed("cell", "a"), "a").join(is_core.withColumnRenamed("cell", "b"), "b")
    edges = _joined_cells(core, core_cells, between, eps, dims)
    first = core_cells.select("cell", "first_id")
    edges = (edges.join(_named(first, "a", "cell", "first_id").withColumnRenamed("cell_a", "a"), "a")
             .join(_named(first, "b", "cell", "first_id").withColumnRenamed("cell_b", "b"), "b").select("first_id_a", "first_id_b"))
    loops = first.select(F.col("first_id").alias("first_id_a"), F.col("first_id").alias("first_id_b"))
    comp = connected_components(edges.union(loops), "first_id_a", "first_id_b")
    cluster = written(core_cells.join(comp.withColumnRenamed("id", "first_id"), "first_id").select("cell", "lo", "hi", F.col("component").alias("cluster")))

    outer = sparse.join(enough, "id", "left_anti")
    whole, single = _near_points(outer, pairs, cluster, core, eps, dims, ("cluster",))
    border = whole.select("id", "cluster").unionByName(single.select("id", "cluster")).groupBy("id").agg(F.min("cluster").alias("cluster"))
    known = (core.join(cluster.select("cell", "cluster"), "cell").select("id", "cluster", F.lit(True).alias("is_core"))
             .unionByName(border.select("id", "cluster", F.lit(False).alias("is_core"))))
    return rest.join(known, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce(F.col("cluster").cast("long"), F.lit(-1).cast("long")).alias("cluster"),
        F.coalesce("is_core", F.lit(False)).alias("is_core"))
