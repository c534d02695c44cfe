"""Parent-child tables flattened by pointer doubling; closures of hierarchies whose nodes have several parents.

Each round joins the table to itself on the highest ancestor known so far, so depth d takes log2(d) rounds instead of d
joins, and nothing is collected. Rounds are checkpointed: without it the plan would double every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.sources.storage import cut_lineage, stored


def root_paths(edges: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, path): the path runs from the node up to its root. A parent that is no node itself ends the path.

    Any depth. A node with several parents has one path per way up. A round settles at least the nodes whose way up is
    shortest among the open ones, so a round that settles none means a cycle, which raises.
    """
    base = edges.select(F.col(node).alias("node"), F.col(parent).alias("up")).distinct()
    known = base.select(F.col("node").alias("up")).distinct()
    rooted = base.join(known.withColumn("__is_node", F.lit(True)), "up", "left")
    state = cut_lineage(rooted.select(
        "node", F.array("node").alias("path"), F.when(F.col("__is_node"), F.col("up")).alias("next")
    ))
    before = None
    while True:
        still = state.where("next is not null").select("node").distinct().count()
        if not still:
            return state.select(F.col("node").alias(node), "path")
        if still == before:
            raise ValueError("hierarchy has a cycle")
        before = still
        above = state.select(F.col("node").alias("next"), F.col("path").alias("up_path"), F.col("next").alias("up_next"))
        state = cut_lineage(state.join(above, "next", "left").select(
            "node", F.concat("path", F.coalesce("up_path", F.expr("array()"))).alias("path"),
            F.col("up_next").alias("next"),
        ))


def resolve_root(edges: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root, depth)."""
    return root_paths(edges, node, parent).select(
        node, F.element_at("path", -1).alias("root"), (F.size("path") - 1).alias("depth")
    )


def flatten_levels(edges: DataFrame, node: str, parent: str, levels: int, under: object | None = None) -> DataFrame:
    """(node, level_1 = root .. level_n); levels below the node repeat it. ``under`` keeps one sub-tree.

    A path with more than ``levels`` nodes would lose its end: the query fails and says so.
    """
    paths = root_paths(edges, node, parent).withColumn("path", F.reverse("path"))
    if under is not None:
        paths = paths.where(F.array_contains("path", F.lit(under)))
    longer = F.raise_error(F.concat(F.lit(f"more than {levels} levels: "), F.concat_ws(" > ", "path")))
    paths = paths.withColumn("path", F.when(F.size("path") <= levels, F.col("path")).otherwise(longer))
    deepest = F.element_at("path", -1)
    return paths.select(node, *[
        F.coalesce(F.try_element_at("path", F.lit(i)), deepest).alias(f"level_{i}") for i in range(1, levels + 1)
    ])


def closure(edges: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, ancestor, depth) for every ancestor of every node, at its least depth. Nodes may have several parents.

    After the round with h steps all pairs of at most h steps are known. A pair of h + 1 to 2 h steps has a shortest way whose last h steps are a pair
    of exactly h, so only those are joined to the known ones: depth d takes log2(d) rounds, and a pair is met once for each node that its shortest ways
    have at that place. Each round stores its new pairs only. Ancestors without parents lead no further and are not joined.
    Null parents are no edges; an edge that is given twice counts once. A node that is its own ancestor raises.
    """
    base = edges.select(F.col(node).alias("node"), F.col(parent).alias("ancestor")).dropna().distinct()
    inner = base.select(F.col("node").alias("ancestor")).distinct().withColumn("inner", F.lit(True))
    found = stored(base.join(inner, "ancestor", "left").select("node", "ancestor", F.lit(1).alias("depth"), F.coalesce("inner", F.lit(False)).alias("inner")))
    pairs, steps = found, 1
    while True:
        cycle = found.where("node = ancestor").limit(1).collect()
        if cycle:
            raise ValueError(f"hierarchy has a cycle through {cycle[0].node}")
        last = found.where(F.col("depth") == steps)
        if last.isEmpty():
            return pairs.select(F.col("node").alias(node), "ancestor", "depth")
        upper = last.select(F.col("node").alias("middle"), "ancestor", F.col("depth").alias("more"), "inner")
        lower = pairs.where("inner").select("node", F.col("ancestor").alias("middle"), "depth")
        longer = lower.join(upper, "middle").select("node", "ancestor", (F.col("depth") + F.col("more")).alias("depth"), "inner")
        # dealt by node first: one aggregation behind the shuffle instead of one on either side of it
        least = pairs.unionByName(longer).repartition("node").groupBy("node", "ancestor").agg(F.min("depth").alias("depth"), F.max("inner").alias("inner"))
        found = stored(least.where(F.col("depth") > steps))
        pairs, steps = pairs.unionByName(found), 2 * steps


def described_levels(edges: DataFrame, node: str, parent: str, texts: DataFrame, code: str, text: str, levels: int) -> DataFrame:
    """(node, level_1 .. level_n, level_1_text .. level_n_text): a level's code and its description; levels below the node repeat it.

    ``texts`` (code, text), unique on the code; codes without one have a null description. A node with several parents has the nearest way
    up of each pair, so levels must have one node each: a second one at the same level raises, and so does a node below the last level.
    """
    above = closure(edges, node, parent).select(F.col(node).alias("node"), "ancestor", "depth")
    own = edges.select(F.col(node).alias("node")).union(edges.select(F.col(parent))).dropna().distinct()
    held = above.unionByName(own.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth")))
    named = held.join(texts.select(F.col(code).alias("ancestor"), F.col(text).alias("text")), "ancestor", "left")
    per = named.groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("place"), "ancestor", "text"))).alias("way"))  # as long as the hierarchy is deep
    problem = F.raise_error(F.concat(F.lit("more than one node a level, or too many levels: "), F.concat_ws(" > ", F.col("way.ancestor"))))
    fits = (F.size("way") <= levels) & (F.size(F.array_distinct("way.place")) == F.size("way"))
    per = per.withColumn("way", F.when(fits, F.col("way")).otherwise(problem))
    at = lambda i: F.coalesce(F.try_element_at("way", F.lit(i)), F.element_at("way", -1))
    return per.select(
        F.col("node").alias(node), *[at(i)["ancestor"].alias(f"level_{i}") for i in range(1, levels + 1)],
        *[at(i)["text"].alias(f"level_{i}_text") for i in range(1, levels + 1)])
