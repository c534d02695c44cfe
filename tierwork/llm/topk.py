"""Exact top-k search by inner product: MaxScore over the components of integer vectors.

A component is a term, a query's component its weight, a candidate's component the posting. The greatest and least posting of each term in a block of
candidates bound what the term can add. Terms are ordered by the width of that bound; the last ones, which together cannot lift a candidate
over the query's k-th score when all others are at their least, are non-essential. Essential terms are summed for all candidates of a block;
others are probed, widest first, only for candidates that can still reach the k-th score. Where that are many pairs of a
block, as with dense vectors, gathering them costs more than it saves: then the other terms are summed for the whole block, and these scores raise the k-th score before
any pair is looked at. All pairs of a query and a candidate block are bounded or summed, so the work is queries times candidates, in products of matrices.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

CELL = 8192  # queries, and candidates, that meet in one task
BLOCK = 2048  # candidates whose bounds are taken together
FIRST = 256  # candidates of a first block, which gives the first k-th scores
PROBED = 64  # one pair in so many at most is probed; in blocks with more the other terms are summed for all
CROWDED = 4  # times k pairs a query over the k-th score, beyond which a block gives a new k-th score first
PROBES = 4  # steps in which non-essential terms are probed


def _top(query, score, ident, k):
    """The k best (query, score, ident) per query: score down, ident up."""
    order = np.lexsort((ident, -score, query))
    query, score, ident = query[order], score[order], ident[order]
    begin = np.searchsorted(query, query)  # first place of each query
    keep = np.arange(len(query)) - begin < k
    return query[keep], score[keep], ident[keep]


def _merged(best, row, score, ident, limit, k):
    """(best, limit) with further pairs: the k best per query, and the k-th scores so far."""
    best = _top(np.concatenate((best[0], row)), np.concatenate((best[1], score.astype(float))), np.concatenate((best[2], ident)), k)
    count = np.bincount(best[0], minlength=len(limit))
    full = np.flatnonzero(count >= k)
    limit = limit.copy()
    limit[full] = np.maximum(limit[full], best[1][np.searchsorted(best[0], full) + k - 1])
    return best, limit


def maxscore(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, chunk: int = 512):
    """(query row, score, id) of each query's k best vectors with another id. Integer arrays (rows, terms)."""
    big = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1])
    kind = np.float32 if big < 2**24 else np.float64  # sums are exact integers in either
    q_all, v_all, parts = queries.astype(kind), vectors.astype(kind), []
    for at in range(0, len(q_all), chunk):
        q, own = q_all[at: at + chunk], query_ids[at: at + chunk]
        m = len(q)
        best = (np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int64))
        limit = np.full(m, -np.inf)
        edges = [0, *range(FIRST, len(v_all), BLOCK), len(v_all)] if len(v_all) > FIRST else [0, len(v_all)]
        for lo, hi in zip(edges, edges[1:]):
            v, vid = v_all[lo:hi], ids[lo:hi]
            high, low = v.max(axis=0), v.min(axis=0)
            upper, lower = np.maximum(q * high, q * low), np.minimum(q * high, q * low)
            order = np.argsort(lower - upper, axis=1, kind="stable")  # widest first
            up, down = np.take_along_axis(upper, order, 1), np.take_along_axis(lower, order, 1)
            # reach[i]: all terms from place i on at their most, those before at their least
            rest = np.concatenate((np.cumsum(up[:, ::-1], axis=1)[:, ::-1], np.zeros((m, 1), dtype=kind)), axis=1)
            least = np.concatenate((np.zeros((m, 1), dtype=kind), np.cumsum(down, axis=1)), axis=1)
            essential = ((rest + least) >= limit[:, None]).sum(axis=1)  # places before it: reach falls along the order
            essential = np.minimum(essential, q.shape[1])
            place = np.empty_like(order)
            np.put_along_axis(place, order, np.arange(q.shape[1])[None, :], 1)
            partial = np.where(place < essential[:, None], q, 0) @ v.T
            may = partial >= (limit - rest[np.arange(m), essential])[:, None]
            if PROBED * np.count_nonzero(may) > may.size:
                score = partial + np.where(place < essential[:, None], 0, q) @ v.T
                if len(v) > k and np.count_nonzero(score >= limit[:, None]) > CROWDED * k * m:
                    score[own[:, None] == vid[None, :]] = -np.inf
                    limit = np.maximum(limit, np.partition(score, len(v) - k, axis=1)[:, len(v) - k])
                row, col = np.nonzero(score >= limit[:, None])
                ok = vid[col] != own[row]
                row, col = row[ok], col[ok]
                best, limit = _merged(best, row, score[row, col], vid[col], limit, k)
                continue
            row, col = np.nonzero(may)
            ok = vid[col] != own[row]
            row, col = row[ok], col[ok]
            score = partial[row, col]
            left = q.shape[1] - essential
            for p in range(PROBES):
                begin, end = essential + left * p // PROBES, essential + left * (p + 1) // PROBES
                if not len(row) or not (end > begin).any():
                    continue
                asked = np.where((place >= begin[:, None]) & (place < end[:, None]), q, 0)
                for i in range(0, len(row), 1 << 16):
                    s = slice(i, i + (1 << 16))
                    score[s] += np.einsum("ij,ij->i", asked[row[s]], v[col[s]])
                keep = score + rest[row, end[row]] >= limit[row]
                row, col, score = row[keep], col[keep], score[keep]
            best, limit = _merged(best, row, score, vid[col], limit, k)
        parts.append((best[0] + at, best[1], best[2]))
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3)) if parts else (np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int64))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column; shorter ones are extended by zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=values.dtype)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose id is divisible by ``every``.

    Components are floor(scale * x), x in double precision; the score is their inner product, an exact integer while sums stay below
    2**53. Ties go to the smaller id. A query's own id is no candidate. Vectors that are null or hold null or non-finite components, and rows
    with a null id, take no part; shorter vectors are extended by zeros; empty vectors score 0. Rows that repeat id and vector count once; rows that share an id
    with different vectors are queries (and candidates) of their own. A query without candidates gives no rows; extra columns are ignored.

    Queries and candidates meet in cells of about ``CELL`` each, dealt by hash; each cell gives k rows per query, which are merged.
    """
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & fine)
    rows = rows.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v")).distinct().withColumn("h", F.xxhash64("id", "v"))
    asked = F.col("id") % every == 0
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(asked, 1)).alias("q"), F.max(F.size("v")).alias("width")).first()
    n_q, n_c, width = max(1, -(-size.q // CELL)), max(1, -(-size.n // CELL)), int(size.width or 0)
    span = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = rows.where(asked).select("id", "h", "v", F.pmod("h", F.lit(n_q)).cast("int").alias("i"), span(n_c).alias("j"))
    found_in = rows.select("id", "v", F.pmod(F.xxhash64("h"), F.lit(n_c)).cast("int").alias("j"), span(n_q).alias("i"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        q, c = left.combine_chunks(), right.combine_chunks()
        qid = q["id"].to_numpy()
        one = lambda t: t["v"].chunk(0) if t.num_rows else pa.array([], pa.list_(pa.int64()))
        row, score, ident = maxscore(_matrix(one(q), width), qid, _matrix(one(c), width), c["id"].to_numpy(), k)
        return pa.table({"query_id": qid[row], "h": q["h"].to_numpy()[row], "vec_id": ident.astype(np.int64), "score": score.astype(np.int64)})

    schema = StructType([StructField(x, LongType()) for x in ("query_id", "h", "vec_id", "score")])
    best = queries.groupBy("i", "j").cogroup(found_in.groupBy("i", "j")).applyInArrow(cell, schema)
    place = F.row_number().over(Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
