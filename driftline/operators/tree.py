"""Trees and graphs held as parent pointers and edges: climbs, walks, closures.  Climbs are bounded in depth, walks and closures are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.core.store import cut


def climb(nodes: DataFrame, goal: DataFrame, depth: int = 5) -> DataFrame:
    """id, ancestor, steps: the nearest ancestor of each node (id, parent) among ``goal`` (id); null if none within ``depth`` steps.

    Pointers are doubled: after round k a node points to its nearest goal within 2**k steps, or to its
    ancestor that many steps up, so depth 5 takes three self-joins.  A node's id is unique; a cycle ends at the depth.
    """
    goal = goal.select(F.col("id").alias("_goal")).distinct()
    met = nodes.join(goal, nodes["parent"] == goal["_goal"], "left")
    at = met.select("id", F.col("parent").alias("at"), F.lit(1).alias("steps"), F.col("_goal").isNotNull().alias("hit"))
    reach = 1
    while reach < depth:
        at = cut(at, "climb")
        up = at.select(F.col("id").alias("_id"), F.col("at").alias("_at"), F.col("steps").alias("_steps"), F.col("hit").alias("_hit"))
        # what has arrived has nothing to look up
        on = at.join(up, F.when(~F.col("hit"), F.col("at")) == F.col("_id"), "left")
        moved = lambda old, new: F.when(F.col("hit"), F.col(old)).otherwise(F.col(new))
        at = on.select("id", moved("at", "_at").alias("at"), F.when(F.col("hit"), F.col("steps")).otherwise(F.col("steps") + F.col("_steps")).alias("steps"), F.coalesce(moved("hit", "_hit"), F.lit(False)).alias("hit"))
        reach *= 2
    there = F.col("hit") & (F.col("steps") <= depth)
    return at.select("id", F.when(there, F.col("at")).alias("ancestor"), F.when(there, F.col("steps")).alias("steps"))


def tree_paths(nodes: DataFrame, key: list[str], order: Column) -> DataFrame:
    """Nodes (key, id, parent) reachable from a root (null parent) with ``level`` and a ``path`` that sorts depth-first.

    ``order`` is the sort text of a node among its siblings.  One join a level, until a level is empty.  A node of a key is
    in one row: it has one parent, so no walk from a root meets a cycle.
    """
    n = cut(nodes.select(*key, "id", "parent", order.alias("_o")), "nodes")
    level = n.filter("parent IS NULL").select(*key, "id", F.lit(0).alias("level"), F.col("_o").alias("path"))
    out, k = level, 0
    while not level.isEmpty():
        k += 1
        up = level.select(*key, F.col("id").alias("parent"), F.col("path").alias("_p"))
        level = cut(n.join(up, [*key, "parent"]).select(*key, "id", F.lit(k).alias("level"), F.concat("_p", F.lit("/"), "_o").alias("path")), "level")
        out = out.unionByName(level)
        if k % 16 == 0:  # a deep tree must not make a long plan
            out = cut(out, "levels")
    return out


#: Steps that a round of a closure takes before it writes what it found.
HOPS = 3


def reachable(edges: DataFrame, start: DataFrame) -> DataFrame:
    """id, level: what can be reached from ``start`` (id) over edges (src, dst), at the least number of steps.

    A round takes HOPS steps from what was new at the last step of the one before, until nothing is; cycles end
    as what was seen is never expanded again.
    """
    e = cut(edges.filter("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct(), "edges")
    seen = cut(start.select("id").distinct().withColumn("level", F.lit(0)), "seen")
    edge, k = seen, 0
    while not edge.isEmpty():
        at, steps = edge.select("id"), []
        for hop in range(1, HOPS + 1):
            at = e.join(at.select(F.col("id").alias("src")), "src").select(F.col("dst").alias("id")).distinct().join(seen.select("id"), "id", "left_anti")
            steps.append(at.withColumn("level", F.lit(k + hop)))
        found = steps[0]
        for step in steps[1:]:
            found = found.unionByName(step)
        # what is met again within the round keeps its first step
        found = cut(found.groupBy("id").agg(F.min("level").alias("level")), "frontier")
        k += HOPS
        edge = found.filter(F.col("level") == k)
        seen = seen.unionByName(found)
        if k % (5 * HOPS) == 0:  # a long chain must not make a long plan
            seen = cut(seen, "seen")
    return seen
