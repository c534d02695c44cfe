"""Mixing sources to target weights: capped water-filling and seeded repetitions, in DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwork.llm.frames import WORD, numbered, own_name
from tierwork.sources.storage import cut_lineage

# rows of a source that are put in order together; a larger source is cut into more pieces along its seeded order
PIECE_ROWS = 2000


def water_level(sources: DataFrame, total: float) -> float:
    """Level L with sum(min(weight * L, cap)) = total; infinite when all caps together do not reach it.

    A source whose share passes its cap is clamped and the rest is shared anew by weight; the level only rises, so
    each round clamps at least one source more, or ends. A round is one aggregate over the sources.
    """
    level = None
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("cap")
        r = sources.agg(
            F.sum(F.when(~over, F.col("weight"))).alias("free"), F.sum(F.when(over, F.col("cap"))).alias("clamped")).first()
        if not r.free:
            return math.inf
        new = (total - (r.clamped or 0)) / r.free
        if level is not None and new <= level:
            return level
        level = new


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_epochs: float) -> DataFrame:
    """(source, source_size, n_docs, target) from rows (source, size).

    Sources in code-point order, null last, get ``weights`` in turn; together they share ``share`` times all words; no
    target exceeds ``max_epochs`` times its source. Without words every target is 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ordered = cut_lineage(numbered(per, F.col("source").asc_nulls_last(), "place"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = ordered.withColumn("weight", weight).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, share * words)
    target = F.col("cap") if math.isinf(level) else F.least(F.col("weight") * F.lit(level), F.col("cap"))
    return sources.select("source", "source_size", "n_docs", target.cast("double").alias("target"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2.0, seed: int = 17,
) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, copies.

    ``copies`` is how often the mix takes the document: floor(target / source_size) for all of a source, and once more for the
    first documents of the source in an order drawn from seed and id, as long as that brings the source nearer to its target. So a
    source misses its target by at most half of one document. Reruns agree. The order is summed in pieces of about
    ``PIECE_ROWS`` rows, so that a source with a third of all rows is no single group.

    Null text has size 0. Null source is a source, last in order. Repeated rows are separate rows; rows with equal id draw the
    same place and are ordered by size, then by hash of their text. Null ids are one id. An empty table gives no rows. Other columns are ignored.
    """
    return _planned(docs, id_col, text_col, source_col, weights, share, max_epochs, seed).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies")


def _planned(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2.0, seed: int = 17,
) -> DataFrame:
    """(id, source, th, size, source_size, target, copies) per row, as :func:`mix` says; th: hash of the text."""
    draw = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = cut_lineage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.xxhash64(text_col).alias("th"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(draw, 1, 15), 16, 10).cast("long").alias("place")))
    targets = cut_lineage(source_targets(rows, weights, share, max_epochs))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_docs") / PIECE_ROWS))).cast("int")
    full = rows.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "r.*", "source_size", "target", F.floor(F.col("place") / F.pow(F.lit(2.0), F.lit(60) - bits)).alias("piece"))
    pieces = full.groupBy("source", "piece").agg(F.sum("size").alias("piece_size"))
    along = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("pieces_before", F.coalesce(F.sum("piece_size").over(along), F.lit(0))).drop("piece_size")
    within = Window.partitionBy("source", "piece").orderBy("place", "id", "size", "th").rowsBetween(Window.unboundedPreceding, -1)
    summed = full.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = summed.alias("f").join(
        pieces.alias("p"), F.col("f.source").eqNullSafe(F.col("p.source")) & (F.col("f.piece") == F.col("p.piece"))
    ).select("f.*", (F.col("f.before") + F.col("p.pieces_before")).alias("words_before"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - whole * F.col("source_size")
    more = (F.col("size") > 0) & (2 * F.col("words_before") + F.col("size") <= 2 * rest)
    return placed.select(
        "id", "source", "th", "size", "source_size", "target", (whole + more.cast("int")).cast("int").alias("copies"))


def repeat_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: rows of ``docs`` with their columns, each as often as :func:`mix` takes it.

    Rows are met again by id, source and hash of the text. Rows that share all three take together as many copies as :func:`mix` plans for them: where
    it plans one more for some of them only (one group of a source at most), they are numbered, and the first ones take it.
    """
    i, s, th, least, more, no = (own_name(docs, x) for x in ("_id", "_source", "_th", "_least", "_more", "_no"))
    plan = _planned(docs, id_col, text_col, source_col, **how).groupBy(F.col("id").alias(i), F.col("source").alias(s), F.col("th").alias(th)).agg(
        F.min("copies").alias(least), (F.sum("copies") - F.count(F.lit(1)) * F.min("copies")).alias(more))
    plan = cut_lineage(plan.where((F.col(least) > 0) | (F.col(more) > 0)))
    columns = [F.col(f"d.`{c}`") for c in docs.columns]

    def met(part: DataFrame) -> DataFrame:
        on = F.col(f"d.`{id_col}`").eqNullSafe(F.col(f"p.{i}")) & F.col(f"d.`{source_col}`").eqNullSafe(F.col(f"p.{s}")) & (F.xxhash64(f"d.`{text_col}`") == F.col(f"p.{th}"))
        return docs.alias("d").join(part.alias("p"), on)

    out = met(plan.where(F.col(more) == 0)).select(*columns, F.col(f"p.{least}").alias(least))
    split = plan.where(F.col(more) > 0)
    if not split.isEmpty():
        group, row = own_name(docs, "_group"), own_name(docs, "_row")
        some = met(split.withColumn(group, F.xxhash64(i, s, th))).select(*columns, least, more, group, F.monotonically_increasing_id().alias(row))
        some = numbered(cut_lineage(some), F.struct(group, row), no)
        first = some.groupBy(F.col(group).alias(i)).agg(F.min(no).alias(s))
        some = some.join(first, F.col(group) == F.col(i))
        out = out.union(some.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(least) + (F.col(no) - F.col(s) < F.col(more)).cast("int")))
    return out.where(F.col(least) > 0).withColumn(least, F.explode(F.sequence(F.lit(1), F.col(least)))).select(*[F.col(f"`{c}`") for c in docs.columns])
