"""Embedding near-dedup by collision counting on one-dimensional projections.

Unit vectors are projected on random directions. The difference of two projections has the vectors' distance as its standard deviation, so close pairs
fall into each other's window on most projections, far pairs on few. For every query vector the collisions in its windows are counted per
candidate; pairs whose count passes a bound, set from the binomial law so that pairs just at the threshold pass with a given
probability, are verified by their exact cosine. A few further projections, cut into ranges, decide which vectors meet in a task at all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.llm.graph import components, spanning
from tierwork.sources.storage import cut_lineage

FIRST, ALL = 12, 48  # projections counted for all pairs of a task, and for those that pass the first count
RECALL = 0.998  # of pairs just at the threshold, for each of the two counts
WIDE = 3.3  # windows of the dividing projections, in standard deviations of a pair at the threshold
MOST_DIVIDING = 4
CELL = 4096  # queries, and candidates, in one task


def least_count(n: int, p: float, recall: float = RECALL) -> int:
    """Greatest count that Binomial(n, p) reaches with probability ``recall`` or more."""
    tail = 1.0
    for c in range(n + 1):
        if tail < recall:
            return c - 1
        tail -= math.comb(n, c) * p**c * (1 - p) ** (n - c)
    return n


def directions(size: int, count: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(size, count))


def linked_pairs(q: np.ndarray, qp: np.ndarray, c: np.ndarray, cp: np.ndarray, cosine: float, block: int = 512):
    """(query row, candidate row) with cosine at or above the bound, of pairs whose window collisions pass the counts."""
    width = math.sqrt(2 - 2 * cosine)
    p = math.erf(1 / math.sqrt(2))
    need_first, need = least_count(FIRST, p), least_count(ALL, p)
    order = [np.argsort(cp[:, j], kind="stable") for j in range(FIRST)]
    inverse = [np.argsort(o) for o in order]
    found = []
    for at in range(0, len(q), block):
        part = qp[at: at + block]
        counts = np.zeros((len(part), len(c)), dtype=np.int8)
        for j in range(FIRST):
            line = cp[order[j], j]
            lo, hi = np.searchsorted(line, part[:, j] - width, "left"), np.searchsorted(line, part[:, j] + width, "right")
            inside = (inverse[j] >= lo[:, None]) & (inverse[j] < hi[:, None])
            counts += inside
        row, col = np.nonzero(counts >= need_first)
        for i in range(0, len(row), 1 << 15):
            r, k = row[i: i + (1 << 15)], col[i: i + (1 << 15)]
            met = (np.abs(part[r] - cp[k]) <= width).sum(axis=1) >= need
            r, k = r[met], k[met]
            same = np.einsum("ij,ij->i", q[at + r], c[k]) >= cosine
            found.append((at + r[same], k[same]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98,
) -> DataFrame:
    """Per row: id, n_links (rows linked directly), component_id (least id linked over any path, its own included), kept (id = component_id).

    Only rows of equal, non-null label and equal length are compared. Null, empty and zero vectors and vectors with null or non-finite components link
    with nothing. Equal vectors of a label are one class, however many; they link with each other. Rows with a null id are counted as links and can join
    others, their component is the least non-null id, and they are not kept. Repeated rows are rows; empty tables give none; extra columns are ignored.
    Recall of links is set by ``RECALL`` per count; precision is exact.
    """
    ok = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.col("label").isNotNull() & ok & F.coalesce((norm > 0) & (norm < F.lit(float("inf"))), F.lit(False))
    name = F.concat(F.hex(F.xxhash64("label", "v")), F.lit("."), F.hex(F.xxhash64(F.lit(1), "v", "label")))
    rows = cut_lineage(rows.withColumn("cls", F.when(fine, name)))
    classes = rows.where("cls is not null").groupBy("cls").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least_id"))
    width = math.sqrt(2 - 2 * cosine)
    ends = WIDE * width

    def project(batches):
        for b in batches:
            values, sizes = b.column(2).flatten().to_numpy(zero_copy_only=False), b.column(2).value_lengths().to_numpy(zero_copy_only=False)
            begin = np.cumsum(sizes) - sizes
            units, lines = [None] * len(b), [None] * len(b)
            for size in np.unique(sizes):
                of = np.flatnonzero(sizes == size)
                v = values[begin[of][:, None] + np.arange(size)]
                v = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
                p = v @ directions(int(size), ALL + MOST_DIVIDING)
                for i, x, y in zip(of, v, p):
                    units[i], lines[i] = x, y
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(units, pa.list_(pa.float64())), pa.array(lines, pa.list_(pa.float64())), b.column(3)],
                                             ["cls", "label", "u", "p", "copies"])

    kind = classes.schema["label"].dataType.simpleString()
    made = classes.select("cls", "label", "v", "copies").mapInArrow(
        project, f"cls string, label {kind}, u array<double>, p array<double>, copies long").withColumn("size", F.size("u"))
    made = cut_lineage(made)
    # as many dividing projections as bring a label's vectors down to a task; each keeps about half of them in reach
    per = made.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "cuts", F.least(F.lit(MOST_DIVIDING), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / (4 * CELL))))).cast("int")).drop("n")
    made = made.join(per, ["label", "size"])
    lines = range(1, MOST_DIVIDING + 1)
    cut = lambda i, shift: F.when(F.lit(i) <= F.col("cuts"), F.floor((F.element_at("p", ALL + i) + F.lit(shift)) / F.lit(2 * ends))).otherwise(F.lit(0))
    asked = made.select("cls", "u", "p", F.struct("label", "size", *[cut(i, 0.0).alias(f"at{i}") for i in lines]).alias("cell"))
    offered = made
    for i in lines:  # every range that the window around the projection touches
        offered = offered.withColumn(f"at{i}", F.explode(F.sequence(cut(i, -ends), cut(i, ends))))
    offered = offered.select("cls", "u", "p", "copies", F.struct("label", "size", *[f"at{i}" for i in lines]).alias("cell"))
    sizes = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("a")).join(
        offered.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("b")), "cell")
    sizes = cut_lineage(sizes)
    span = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asked = asked.join(sizes, "cell").select("cell", "cls", "u", "p", F.pmod(F.xxhash64("cls"), F.col("a")).alias("i"), span("b").alias("j"))
    named = [F.col(x).alias(x) for x in ("cls", "u", "p", "copies")]  # columns of their own, apart from the queries'
    offered = offered.join(sizes, "cell").select("cell", *named, F.pmod(F.xxhash64("cls"), F.col("b")).alias("j"), span("a").alias("i"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        q, c = left.combine_chunks(), right.combine_chunks()
        names = lambda t: t["cls"].to_numpy(zero_copy_only=False)
        if not q.num_rows or not c.num_rows:
            return pa.table({"cls": pa.array([], pa.string()), "links": pa.array([], pa.int64()), "other": pa.array([], pa.string())})
        grid = lambda t, n: np.ascontiguousarray(t[n].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1))
        row, col = linked_pairs(grid(q, "u"), grid(q, "p")[:, :ALL], grid(c, "u"), grid(c, "p")[:, :ALL], cosine)
        qn, cn = names(q), names(c)
        other = qn[row] != cn[col]
        row, col = row[other], col[other]
        n = np.bincount(row, c["copies"].to_numpy()[col], minlength=len(qn)).astype(np.int64)
        both, at = np.unique(np.concatenate((qn, cn)).astype(str), return_inverse=True)
        low = spanning(at[row], at[len(qn) + col], len(both))
        far = np.flatnonzero(low != np.arange(len(both)))
        some = np.flatnonzero(n)
        return pa.table({
            "cls": pa.array([*qn[some], *both[far]], pa.string()), "links": pa.array([*n[some].tolist(), *([0] * len(far))], pa.int64()),
            "other": pa.array([*([None] * len(some)), *both[low[far]]], pa.string())})

    keys = ("cell", "i", "j")
    met = cut_lineage(asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(compare, "cls string, links long, other string"))
    roots = components(met.where("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    links = met.where("links > 0").groupBy("cls").agg(F.sum("links").alias("links"))
    placed = classes.select("cls", "copies", "least_id").join(roots.withColumnRenamed("key", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    placed = cut_lineage(placed.join(least, "root").join(links, "cls", "left").select(
        "cls", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    out = rows.select("id", "cls").join(placed, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
