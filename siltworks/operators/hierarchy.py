"""Parent-child links to full hierarchies.

``resolve_forest`` gives every node its root, depth and, if asked for, its exact
path. Each node has at most one parent, so the links form trees and loops with
trees hanging from them. Depth is unknown and may be thousands, so the walk is not
one join per level:

1. Splitters are chosen by hash (one node in ``every``); they and all roots are stops.
2. Every other node walks up to its next stop. Walks double their stride each
   round, so a gap of g nodes takes log2(g) joins; gaps are short, as splitters
   are dense.
3. The reduced graph has only the splitters, each pointing to the next stop above
   it; it is solved in the same way, on a fraction of the nodes.
4. A node's depth, root and path are its stop's plus its own walk.

A stop that is a root points to itself, and whether a key is a splitter is told by
its hash, so neither takes a join of its own.

Loops: once a round brings no walker to a stop, all walkers point to walkers, so none
will ever stop. In step 2 these are the nodes on or below loops without a splitter, in step
3 those on or below loops with one. Both get root ``cycle`` and depth -1.

Paths are expanded in a second pass over the nodes that proved to hang from a root,
so no path is ever grown around a loop. Rows that carry pieces of paths are only
joined by sort-merge, which spills: a few MB of written paths can be a hundred times
as much in memory, so their written size says nothing about a broadcast.

Skew: a parent with very many children is the key of a join whose other side is
unique, so AQE splits the large side and repeats one row. Every round is written
to the shared folder, so no lineage grows and lost executors cost one round.

Defined results: blank or unknown parents make roots; a node whose parent is
itself is a loop; repeated deliveries count once (the smallest link wins if they
differ); nodes without id are dropped, as nothing can name them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import BROADCAST_BYTES, Stages, unless_large

CYCLE = "cycle"
#: parts tree and node in a key; alone it is the stop of those who have none
_SEP = "\x1f"


def _walk(pointers: DataFrame, stages: Stages, with_path: bool) -> tuple[DataFrame, float]:
    """(node, stop, dist[, seg]): each node's next stop above, null in loops; and its bytes.

    ``pointers`` has (node, next, dist, stopped[, seg]); next is stopped or is a
    node of pointers. seg lists the nodes from next down to, not including, node.
    """
    state, before = stages.put(pointers), -1
    while True:
        own, going = F.length("node") + F.length("next") + 32, ~F.col("stopped")
        held = state.agg(F.count(F.when(going, 1)).alias("n"), F.coalesce(F.sum(own), F.lit(0)).alias("size"), F.coalesce(F.sum(F.when(going, own)), F.lit(0)).alias("going")).first()
        size = float("inf") if with_path else held["size"]
        # if nobody came to a stop, the walkers point to walkers only, and so they will for ever
        if held["n"] in (0, before):
            break
        before = held["n"]
        a, b = state.where("NOT stopped"), unless_large(state, size)
        if size > BROADCAST_BYTES >= held["going"] and not with_path:
            a, b = F.broadcast(a), state  # few still walk, as measured: nothing is shuffled for them
        cols = [F.col("a.node"), F.col("b.next"), (F.col("a.dist") + F.col("b.dist")).alias("dist"), F.col("b.stopped")]
        if with_path:
            cols.append(F.concat("b.seg", "a.seg").alias("seg"))
        moved = a.alias("a").join(b.alias("b"), F.col("a.next") == F.col("b.node")).select(*cols)
        old, state = state, stages.put(state.where("stopped").unionByName(moved))
        stages.drop(old)
    return state.withColumn("next", F.when(F.col("stopped"), F.col("next"))).withColumnRenamed("next", "stop").drop("stopped"), size


def _solve(nodes: DataFrame, stages: Stages, every: int, with_path: bool) -> DataFrame:
    """(node, root, dist[, seg]) of nodes (node, parent): root is null in and below loops."""
    bigint = lambda n: F.lit(n).cast("bigint")
    chosen = lambda c: F.pmod(F.xxhash64(c), F.lit(every)) == 0
    is_root = F.col("parent").isNull()
    none = F.array().cast("array<string>")
    seg = lambda c: [c.alias("seg")] if with_path else []
    carried = ["seg"] * with_path

    walked, size = _walk(
        nodes.where(is_root | ~chosen("node")).select(
            "node", F.coalesce("parent", "node").alias("next"), F.when(is_root, bigint(0)).otherwise(bigint(1)).alias("dist"), (is_root | chosen("parent")).alias("stopped"), *seg(F.when(is_root, none).otherwise(F.array("parent")))
        ),
        stages, with_path,
    )

    # the reduced graph: splitters, each with the next stop above, and the roots that the hash chose
    above = unless_large(walked, size).select(F.col("node").alias("parent"), "stop", F.col("dist").alias("more"), *[F.col(c).alias("up") for c in carried])
    direct = chosen("parent")
    hop = nodes.where(~is_root & chosen("node")).join(above, "parent", "left").select(
        "node",
        F.when(direct, F.col("parent")).otherwise(F.coalesce("stop", F.lit(_SEP))).alias("next"),
        F.when(direct, bigint(1)).otherwise(F.coalesce("more", bigint(0)) + 1).alias("dist"),
        *seg(F.when(direct, F.array("parent")).otherwise(F.concat(F.coalesce("up", none), F.array("parent")))),
    )
    tops = nodes.where(is_root & chosen("node")).select("node", F.col("node").alias("next"), bigint(0).alias("dist"), *seg(none))
    solved, size = _walk(hop.unionByName(tops).withColumn("stopped", (F.col("next") == F.col("node")) & (F.col("dist") == 0) | (F.col("next") == _SEP) | ~chosen("next")), stages, with_path)
    solved = solved.select("node", F.nullif("stop", F.lit(_SEP)).alias("root"), "dist", *carried)

    # expand: a stop that is no splitter is a root itself, the others' answers are looked up
    far = F.col("stop").isNotNull() & chosen("stop")  # a null has a hash too
    answer = unless_large(solved, size).select(F.col("node").alias("stop"), "root", F.col("dist").alias("above"), *[F.col(c).alias("up") for c in carried])
    near = walked.where(~far).select("node", F.col("stop").alias("root"), "dist", *carried)
    found = walked.where(far).join(answer, "stop").select("node", "root", (F.col("dist") + F.col("above")).alias("dist"), *seg(F.concat("up", *carried)))
    return near.unionByName(found).unionByName(solved.where(~F.col("node").eqNullSafe(F.col("root"))))


def resolve_forest(links: DataFrame, with_path: bool = False, every: int = 16) -> DataFrame:
    """(tree, node, root_node, node_depth[, path]) of links (tree, node, parent).

    node and parent are strings, unique within their tree; path lists the nodes
    from the root to the node and is empty for nodes in loops.
    """
    stages = Stages(links.sparkSession, "hierarchy")
    key = lambda c: F.concat(F.coalesce("tree", F.lit("")), F.lit(_SEP), c)
    given = links.where("node IS NOT NULL").select(key("node").alias("node"), key("parent").alias("parent")).groupBy("node").agg(F.min("parent").alias("parent"))
    # a parent that is no node makes a root
    known = given.select(F.col("node").alias("parent"), F.lit(True).alias("known")).hint("merge")
    nodes = stages.put(given.join(known, "parent", "left").select("node", F.when(F.col("known"), F.col("parent")).alias("parent")))
    out = _solve(nodes, stages, every, False)
    none = F.array().cast("array<string>")
    if with_path:
        out = stages.put(out)
        looped = out.where("root IS NULL")
        rooted = nodes.join(looped.select("node").hint("merge"), "node", "left_anti")
        out = looped.withColumn("seg", none).unionByName(_solve(stages.put(rooted), stages, every, True))
    bare = lambda c: F.substring_index(c, _SEP, -1)
    in_loop = F.col("root").isNull()
    cols = [
        F.substring_index("node", _SEP, 1).alias("tree"),
        bare("node").alias("node"),
        F.when(in_loop, F.lit(CYCLE)).otherwise(bare("root")).alias("root_node"),
        F.when(in_loop, F.lit(-1)).otherwise(F.col("dist")).cast("bigint").alias("node_depth"),
    ]
    if with_path:
        cols.append(F.when(in_loop, none).otherwise(F.transform(F.concat("seg", F.array("node")), bare)).alias("path"))
    return out.select(*cols)


def descendants(paths: DataFrame) -> DataFrame:
    """(tree, node, descendant, distance): all pairs of resolved paths.

    Read off the paths, so every pair is made once, where its path lies; nothing
    is joined. The result has as many rows as all depths together.
    """
    up = paths.where(F.size("path") > 1).select("tree", F.col("node").alias("descendant"), "node_depth", F.posexplode("path").alias("place", "node"))
    return up.where(F.col("place") < F.col("node_depth")).select("tree", "node", "descendant", (F.col("node_depth") - F.col("place")).alias("distance"))
