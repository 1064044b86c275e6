"""Merkle manifest of a dataset: digests of rows, per-group trees under one root, and a proof
of membership for every row by pointer jumping.

Rows are leaves, ordered by key within their group.  While a level has several nodes, every
``FAN`` consecutive ones become one node of the next level; what remains is the group's
subroot, and the subroots, ordered by group, are the leaves of a tree of the same kind.

Proofs.  Every node but the root starts with a pointer to its parent and one segment, the
siblings before and after it.  A round joins the pointer table with itself: a node takes over
its target's pointer and appends the target's segments, so the distance doubles and a tree of
depth d takes about log2(d) rounds.  The leaves of a run share their parent and so their
whole path above it; they jump last, a run at a time, which keeps proofs (a few KB a leaf, more
than the rows themselves) out of every shuffle.

Scale: positions come from one range partitioning with an offset per task and group, levels
are grouped by (tree, position / FAN), so no group of a shuffle exceeds ``FAN`` members and a
group with a third of all rows spreads like the others.  Many nodes point to few targets after
some rounds; finished pointers stay out of the join, and the targets are then a table that
Spark's run-time size check broadcasts.  Every level and round is written to the shared folder.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

FAN = 16
_TOP = -1  # number of the tree over the subroots


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value (numbers in decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Hex SHA-256 of the values' fields, which no other list of values shares."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def _joined(raws: Column) -> Column:
    """Hex text of an array of digests, one after another."""
    return F.array_join(F.transform(raws, _hex), "")


def _node(members: Column) -> Column:
    return F.unhex(F.sha2(_joined(F.transform(members, lambda m: m["digest"])), 256))


def _segment(members: Column, at: Column) -> Column:
    """Siblings of member ``at`` (from 0) as hex text before and after it."""
    digests = F.transform(members, lambda m: m["digest"])
    return F.struct(_joined(F.slice(digests, F.lit(1), at)).alias("before"),
                    _joined(F.slice(digests, at + 2, F.lit(FAN))).alias("after"))


def _levels(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def _positions(leaves: DataFrame) -> DataFrame:
    """Add ``t`` (number of the row's group, in order), ``n`` (rows of the group) and ``p``
    (position in it).  Rows equal in every column are told apart by their place in the scan."""
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["g_set", "g", F.col("key").asc_nulls_first(), "digest", "row"]
    local = (leaves.withColumn("row", F.monotonically_increasing_id())
             .repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("row")
             .withColumn("pid", F.spark_partition_id()).withColumn("mid", F.monotonically_increasing_id()))
    local = stored(local, "merkle-leaves")
    counts = local.groupBy("g_set", "g", "pid").agg(F.count(F.lit(1)).alias("c"), F.min("mid").alias("first"))
    group = Window.partitionBy("g_set", "g")
    before = group.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.select("g_set", "g", "pid", "first", F.sum("c").over(group).alias("n"),
                                  F.coalesce(F.sum("c").over(before), F.lit(0)).alias("off")), "merkle-counts")
    groups = counts.groupBy("g_set", "g").agg(F.min("pid").alias("in_pid"))
    # A group's number: groups that start in earlier tasks, then those before it in its own task.
    starts = groups.groupBy("in_pid").agg(F.count(F.lit(1)).alias("c")).select(
        "in_pid", F.coalesce(F.sum("c").over(Window.orderBy("in_pid").rowsBetween(Window.unboundedPreceding, -1)),
                             F.lit(0)).alias("base"))  # a row per task
    in_task = Window.partitionBy("in_pid").orderBy("g_set", "g")
    numbers = groups.withColumn("k", F.row_number().over(in_task)).join(starts, "in_pid").select(
        "g_set", "g", (F.col("base") + F.col("k") - 1).alias("t"))
    offsets = counts.join(numbers, ["g_set", "g"])
    return local.join(offsets, ["g_set", "g", "pid"]).select(
        "t", "n", (F.col("off") + F.col("mid") - F.col("first")).alias("p"), "key", "digest", "claim")


@dataclass
class Manifest:
    """``runs``: the leaves, up to ``FAN`` in a row (``t, n, run, members``); ``paths``: for each
    inner node its segments up to the root (``t, l, p, sub, seg``); ``root``: its digest or None."""
    runs: DataFrame
    paths: DataFrame
    root: bytes | None


def _grow(nodes: DataFrame, top: int, level: int) -> list[DataFrame]:
    """Stored runs of each level above ``nodes`` (``t, n, p, digest`` at ``level``), while there
    are several nodes; ``top`` is the most that a tree has."""
    out = []
    for k in range(level, level + _levels(top)):
        runs = (nodes.where("n > 1").groupBy("t", "n", F.floor(F.col("p") / FAN).alias("run"))
                .agg(F.sort_array(F.collect_list(F.struct("p", "digest"))).alias("members"))
                .select("t", F.lit(k).alias("l"), "n", "run", "members", _node(F.col("members")).alias("digest")))
        out.append(stored(runs, f"merkle-level-{k}"))
        nodes = out[-1].select("t", F.ceil(F.col("n") / FAN).alias("n"), F.col("run").alias("p"), "digest")
    return out


def _edges(runs: DataFrame) -> DataFrame:
    """A row per member of the runs: itself, its pointer to the parent, and its segment.  The
    parent that ends a group's tree is a leaf of the tree over the subroots."""
    last = (F.col("t") != _TOP) & (F.col("n") <= FAN)
    member = F.posexplode("members").alias("i", "m")
    return runs.select("t", "l", "n", "run", "members", member).select(
        "t", "l", F.col("m.p").alias("p"),
        F.when(last, F.lit(_TOP)).otherwise(F.col("t")).alias("at"),
        F.when(last, F.lit(0)).otherwise(F.col("l") + 1).alias("al"),
        F.when(last, F.col("t")).otherwise(F.col("run")).alias("ap"),
        F.when((F.col("t") == _TOP) & (F.col("l") == 0), F.col("m.digest")).alias("sub"),
        F.array(_segment(F.col("members"), F.col("i"))).alias("seg"))


def _jump(edges: DataFrame, depth: int, root_level: int) -> DataFrame:
    """Every node's segments up to the root: pointers doubled until all of them end there."""
    ended = (F.col("at") == _TOP) & (F.col("al") == root_level)
    reach = 1
    paths = stored(edges, "merkle-pointers")
    while reach < depth:
        target = paths.select(F.col("t").alias("at"), F.col("l").alias("al"), F.col("p").alias("ap"),
                              F.col("at").alias("bt"), F.col("al").alias("bl"), F.col("ap").alias("bp"),
                              F.col("sub").alias("sub2"), F.col("seg").alias("seg2"))
        jumped = paths.where(~ended).join(target, ["at", "al", "ap"]).select(
            "t", "l", "p", F.col("bt").alias("at"), F.col("bl").alias("al"), F.col("bp").alias("ap"),
            F.coalesce("sub", "sub2").alias("sub"), F.concat("seg", "seg2").alias("seg"))
        paths = stored(paths.where(ended).unionByName(jumped), "merkle-pointers")
        reach *= 2
    return paths.select("t", "l", "p", "sub", "seg")


def build_manifest(docs: DataFrame, leaf: Column, key: str = "doc_id", group: str = "source",
                   claim: Column | None = None) -> Manifest:
    """Trees over the rows of ``docs``: ``leaf`` is a row's digest in hex.

    ``claim`` is a second digest that ``prove`` checks against the same proof, as of a copy
    of the row that may have been changed (null: the leaf itself).  A null group comes first, the
    others in bytewise order; null keys come first in their group; equal keys go by digest.  Extra
    columns are not read.  An empty table has no leaves, and ``root`` is None.
    """
    claim = F.lit(None).cast("string") if claim is None else claim
    # Groups as two columns, so that null is a key like any other.
    leaves = docs.select(F.col(f"`{group}`").isNotNull().alias("g_set"), F.coalesce(F.col(f"`{group}`").cast("string"), F.lit("")).alias("g"),
                         F.col(f"`{key}`").alias("key"), F.unhex(leaf).alias("digest"), F.unhex(claim).alias("claim"))
    placed = _positions(leaves)
    runs = stored(
        placed.groupBy("t", "n", F.floor(F.col("p") / FAN).alias("run"))
        .agg(F.sort_array(F.collect_list(F.struct("p", "key", "digest", "claim"))).alias("members"))
        .withColumn("digest", _node(F.col("members"))), "merkle-runs")
    most, groups = runs.agg(F.max("n"), F.max("t") + 1).first()
    if most is None:
        none = "t long, l int, p long, sub binary, seg array<struct<before:string,after:string>>"
        return Manifest(runs, docs.sparkSession.createDataFrame([], none), None)
    first = runs.where("n > 1").select("t", F.ceil(F.col("n") / FAN).alias("n"), F.col("run").alias("p"), "digest")
    grown = _grow(first, -(-most // FAN), 1)
    alone = runs.where("n = 1").select(F.col("t").alias("p"), F.col("members")[0]["digest"].alias("digest"))
    subroots = [alone, first.where("n = 1").select(F.col("t").alias("p"), "digest"),
                *[g.where(F.col("n") <= FAN).select(F.col("t").alias("p"), "digest") for g in grown]]
    roots = subroots[0]
    for s in subroots[1:]:
        roots = roots.unionByName(s)
    roots = stored(roots, "merkle-subroots")
    over = _grow(roots.select(F.lit(_TOP).cast("long").alias("t"), F.lit(groups).cast("long").alias("n"), "p", "digest"), groups, 0)
    root = (over[-1] if over else roots).select("digest").first()[0]
    levels = [*grown, *over]
    if not levels:
        none = "t long, l int, p long, sub binary, seg array<struct<before:string,after:string>>"
        return Manifest(runs, docs.sparkSession.createDataFrame([], none), bytes(root))
    edges = _edges(levels[0])
    for g in levels[1:]:
        edges = edges.unionByName(_edges(g))
    return Manifest(runs, _jump(edges, len(levels), len(over)), bytes(root))


def prove(manifest: Manifest) -> DataFrame:
    """A row per leaf: ``key, leaf, subroot, root, proof, folded`` (digests in hex).

    ``proof`` is an array of siblings ``before`` and ``after``, from the leaf's level to the
    root's; ``folded`` is the root recomputed from the claimed digest (the leaf where there is none)
    and the proof.  It equals ``root`` if and only if the claim is the leaf.
    """
    root = F.lit(None if manifest.root is None else manifest.root.hex()).cast("string")
    # The node above a run: a leaf of the tree over the subroots where the group's tree ends.
    ends = F.col("n") <= FAN
    above = manifest.runs.select("n", "members", F.when(ends, F.lit(_TOP)).otherwise(F.col("t")).alias("t"),
                                 F.when(ends, F.lit(0)).otherwise(F.lit(1)).alias("l"),
                                 F.when(ends, F.col("t")).otherwise(F.col("run")).alias("p"))
    reached = above.join(manifest.paths, ["t", "l", "p"], "left")
    path = F.coalesce("seg", F.array().cast("array<struct<before:string,after:string>>"))

    def proven(m: Column, i: Column) -> Column:
        own = F.when(F.col("n") > 1, F.array(_segment(F.col("members"), i))).otherwise(F.array())
        return F.struct(m["key"].alias("key"), _hex(m["digest"]).alias("leaf"), _hex(F.coalesce(m["claim"], m["digest"])).alias("start"),
                        F.concat(own, F.col("path")).alias("proof"))

    rows = reached.withColumn("path", path).select(
        F.coalesce(_hex(F.col("sub")), root).alias("subroot"), F.inline(F.transform("members", proven)))
    return rows.select("key", "leaf", "subroot", root.alias("root"), "proof", fold(F.col("start"), F.col("proof")).alias("folded"))


def fold(leaf: Column, proof: Column) -> Column:
    """Root that a leaf's digest (hex) and a proof lead to."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def siblings_digest(proof: Column) -> Column:
    """Hex SHA-256 of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)
