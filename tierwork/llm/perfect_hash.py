"""Exact dedup against a history: a minimal perfect hash per shard of its distinct digests, looked up with a check of every byte.

A shard holds the digests of one remainder of their first eight bytes. Its n digests fall into buckets; larger buckets go first, and each takes the
least seed that sends its digests to free slots of the n slots; buckets of one digest take the slots that are left over. So every slot is taken
once, and a digest is found by one seed and one slot. As any digest leads to some slot, the slot's whole digest decides membership.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.llm.frames import stored
from tierwork.llm.words import mix

WIDTH = 32  # bytes of a digest
SHARD_DIGESTS = 1 << 16  # digests of a shard, and digests looked up in it by one task, on average
BUCKET = 3  # digests of a bucket, on average
SPREAD = 256  # parts a text's rows are dealt to before they are counted, and where the results meet them again
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _words(digests: np.ndarray) -> np.ndarray:
    """Four numbers of each digest (rows of WIDTH bytes)."""
    return np.ascontiguousarray(digests).view("<u8").reshape(-1, WIDTH // 8)


def _slots(words: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """Slot of each digest under the seed of its bucket; negative seeds name a slot."""
    seeds = seeds.astype(np.int64)
    drawn = mix(words[:, 2] + seeds.view(np.uint64) * _STEP) + mix(words[:, 3] ^ seeds.view(np.uint64))
    return np.where(seeds < 0, -seeds - 1, (drawn % np.uint64(max(n, 1))).astype(np.int64))


def _buckets(words: np.ndarray, n: int) -> np.ndarray:
    return (words[:, 1] % np.uint64(max(1, -(-n // BUCKET)))).astype(np.int64)


def perfect_hash(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seed of each bucket, slot of each digest) for distinct digests; the slots are 0 to n - 1, each once.

    Buckets of one size try seeds together: of those whose slots are all free and distinct, the first that asks for a slot takes it.
    """
    n, words = len(digests), _words(digests)
    bucket = _buckets(words, n)
    seeds, slot = np.zeros(max(1, -(-n // BUCKET)), dtype=np.int64), np.empty(n, dtype=np.int64)
    order = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=len(seeds))
    start = np.cumsum(size) - size
    taken, first = np.zeros(n, dtype=bool), np.empty(n, dtype=np.int64)
    for k in range(int(size.max(initial=0)), 1, -1):
        waiting, seed = np.flatnonzero(size == k), 0
        while len(waiting):
            member = order[start[waiting][:, None] + np.arange(k)]
            at = _slots(words[member.ravel()], np.full(member.size, seed), n).reshape(-1, k)
            line = np.sort(at, axis=1)
            good = ~taken[at].any(axis=1) & (line[:, 1:] != line[:, :-1]).all(axis=1)
            asking = np.flatnonzero(good)
            first[at[asking].ravel()] = len(waiting)
            np.minimum.at(first, at[asking].ravel(), np.repeat(asking, k))
            won = asking[(first[at[asking]] == asking[:, None]).all(axis=1)]
            taken[at[won].ravel()] = True
            slot[member[won].ravel()] = at[won].ravel()
            seeds[waiting[won]] = seed
            waiting = np.delete(waiting, won)
            seed += 1
            if seed >= 1 << 31:
                raise ValueError("digests of one bucket do not part; are they distinct?")
    single = np.flatnonzero(size == 1)
    left = np.flatnonzero(~taken)
    seeds[single] = -left - 1
    slot[order[start[single]]] = left
    return seeds, slot


def find(digests: np.ndarray, seeds: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Slot of each digest, or -1 where the slot's digest differs in any byte; ``slots``: the digest that each slot holds."""
    if not len(slots):
        return np.full(len(digests), -1)
    words = _words(digests)
    at = _slots(words, seeds[_buckets(words, len(slots))], len(slots))
    return np.where((slots[at] == digests).all(axis=1), at, -1)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Digests of a binary column as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, WIDTH)


def shard_of(digest: Column, shards: int) -> Column:
    """Remainder of the first digits of a digest."""
    return (F.conv(F.substring(F.hex(digest), 1, 15), 16, 10).cast("long") % shards).cast("int")


class History:
    """Distinct digests with their winners: one row per slot (shard, slot, seed, digest, best, n), written to a shared folder.

    ``best``: struct (id, row) of the winner; ``n``: how many rows have the digest; ``seed``: that of the shard's bucket numbered as the slot.
    """

    def __init__(self, slots: DataFrame, shards: int):
        self.slots, self.shards = slots, shards


def build_history(groups: DataFrame) -> History:
    """History of ``groups`` (digest, best, n), digests distinct. Shards are as many as the digests ask for, each built in a task."""
    shards = max(1, math.ceil(groups.count() / SHARD_DIGESTS))
    rows = groups.select(shard_of(F.col("digest"), shards).alias("shard"), "digest", "best", "n")

    def build(shard: pa.Table) -> pa.Table:
        seeds, slot = perfect_hash(_matrix(shard["digest"]))
        by_slot = pa.array(np.argsort(slot))
        n = len(slot)
        out = shard.take(by_slot)
        return pa.table({
            "shard": out["shard"], "slot": pa.array(np.arange(n), pa.int64()), "seed": pa.array(np.resize(np.append(seeds, np.zeros(n, np.int64)), n), pa.int64()),
            "digest": out["digest"], "best": out["best"], "n": out["n"]})

    best = rows.schema["best"].dataType.simpleString()
    built = rows.groupBy("shard").applyInArrow(build, f"shard int, slot long, seed long, digest binary, best {best}, n long")
    return History(stored(built, "history"), shards)


def look_up(parts: DataFrame, history: History) -> DataFrame:
    """Rows of ``parts`` (digest, ...) with ``slot`` (null: not in the history).

    A task gets the digests of a shard, or a share of them where they are many; the shard's slots go along with every share.
    """
    shares = max(1, math.ceil(parts.count() / (history.shards * SHARD_DIGESTS)))
    share = (F.conv(F.substring(F.hex("digest"), 17, 15), 16, 10).cast("long") % shares).cast("int")
    left = parts.withColumn("_shard", shard_of(F.col("digest"), history.shards)).withColumn("_share", share)
    right = history.slots.select(
        F.col("shard").alias("_shard"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("_share"), "slot", "seed", F.col("digest").alias("held"))

    def meet(asked: pa.Table, shard: pa.Table) -> pa.Table:
        shard = shard.take(pc.sort_indices(shard, [("slot", "ascending")]))
        seeds = shard["seed"].to_numpy()
        at = find(_matrix(asked["digest"]), seeds, _matrix(shard["held"])) if len(asked) else np.zeros(0, np.int64)
        return asked.drop_columns(["_shard", "_share"]).append_column("slot", pa.array(at, pa.int64(), mask=at < 0))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    return left.groupBy("_shard", "_share").cogroup(right.groupBy("_shard", "_share")).applyInArrow(meet, f"{kinds}, slot long")


def _grouped(parts: DataFrame) -> DataFrame:
    return parts.groupBy("digest").agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def exact_dedup(docs: DataFrame, historical: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, known (whether the text is in the history).

    Rows where ``historical`` holds are the history: their distinct digests are put into a perfect hash. Digests of the other rows are
    looked up; members join the group of their slot, nonmembers are grouped by themselves. Of equal texts the row with the greatest id
    stays, whether historical or new (``keep_id``, null only if all ids of the group are); of several rows with that id, the one that was
    read last. Texts are equal when their SHA-256 is.

    A null text counts as empty. A null id is less than all others. ``historical`` null counts as false. Repeated rows are rows of their own: exactly one row of a
    group is kept. An empty table gives no rows, other columns are ignored.

    A text's rows are dealt to ``SPREAD`` parts that are counted apart, so no text, however frequent, is one group; the rows' ids and digests, not
    their texts, are shuffled.
    """
    # written once: row numbers must not change when a task is run again
    rows = stored(docs.select(
        F.col(id_col).alias("id"), F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)).alias("digest"),
        F.coalesce(historical, F.lit(False)).alias("old"), F.monotonically_increasing_id().alias("row")), "digests")
    part = F.pmod(F.xxhash64("row"), F.lit(SPREAD)).cast("int")
    rows = rows.withColumn("part", part)
    parts = stored(rows.groupBy("digest", "part", "old").agg(
        F.max(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("n")), "digest-parts")

    old = _grouped(parts.where("old"))
    history = build_history(old)
    met = stored(look_up(parts.where(~F.col("old")).select("digest", "best", "n"), history), "looked-up")
    members = _grouped(met.where(F.col("slot").isNotNull()).select("digest", "best", "n"))
    fresh = _grouped(met.where(F.col("slot").isNull()).select("digest", "best", "n"))
    known = _grouped(history.slots.select("digest", "best", "n").unionByName(members))
    groups = known.withColumn("known", F.lit(True)).unionByName(fresh.withColumn("known", F.lit(False)))

    told = parts.select("digest", "part").distinct().join(groups, "digest")
    return rows.join(told, ["digest", "part"]).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("n").cast("long").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "known")

