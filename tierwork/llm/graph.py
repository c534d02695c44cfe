"""Connected components of links between keys of any ordered type, by joins and minima."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.sources.storage import cut_lineage


TASK_ROWS = 1 << 17  # rows of links that a task takes


def packed(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as few tasks as so many short rows need, one a core at least: every task leaves files of its own in each shuffle that follows."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS)))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(key, root) for every key that appears in ``links`` (a, b): root is the least key reachable.

    Each round links all greater neighbours of a key to its least neighbour, then all lesser ones; every round is checkpointed, and
    rounds end when nothing changes. Links are packed into few tasks. Minima are summed before they are shuffled, and joins are split by Spark, so a key with very many
    links is no single group. Self links and repeated links change nothing; links with a null are ignored; no links give no rows.
    """
    links = links.select("a", "b").where("a <> b")
    links = cut_lineage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(links)
    first = state[0]
    links = packed(links, first)
    while state[0]:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = cut_lineage(packed(packed(large, first).distinct(), first))
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        small = small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(least.select("a", F.col("low").alias("b")))
        links = cut_lineage(packed(packed(small, first).distinct(), first))
        new = _state(links)
        if new == state:
            break
        state = new
    stars = links.select(F.col("a").alias("key"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("key"), "root").distinct())


def spanning(row: np.ndarray, col: np.ndarray, n: int) -> np.ndarray:
    """Least linked place for each of n places, over all paths of the pairs."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, row, low[col])
        np.minimum.at(new, col, low[row])
        new = new[new]
        if (new == low).all():
            return low
        low = new
