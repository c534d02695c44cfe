"""Cross-tokenizer alignment: where two tokenizations of one text end tokens at the same byte, found by galloping intersection.

The end offsets of both tokenizations are two sorted lists. Each end of the shorter one is looked for in the longer one from a place known to
lie before it: steps double until they pass it, then the last step is halved down. Ends in both lists cut the text into groups; the
ranks of two neighbouring common ends tell which tokens of either side a group holds.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.llm.frames import stored
from tierwork.llm.words import row_pieces, text_buffers

MOST_PIECES, MOST_IDS = 200_000, 1 << 22  # pieces of text and tokens of them kept in a worker; beyond that all are forgotten, results do not change
JOINED = 1 << 15  # characters of new pieces that are tokenized at once
SLICE = 1 << 19  # bytes of texts whose tokens are held at once, or one text
HEAD = 1 << 18  # id pairs whose counts every task gets; all others are met by a join
LINKS = 1 << 17  # links whose counts are looked up at once, or those of one text
STRIDES = (4096, 64, 1)
_CUT = re.compile(r"(?<=\S) (?=\S)")
_BLANK = "▁"


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each of the sorted ``short``, the first place in the sorted ``long`` from ``start`` on that holds no less.

    ``start``: a place for each, not beyond the answer. All searches advance in step. First every 4096th is looked for, then every 64th,
    then all: each from the answer of the last one before it, so that a search is as long as the logarithm of the distance between neighbours.
    """
    out = np.asarray(start, dtype=np.int64).copy()
    if not len(short) or not len(long):
        return out
    before = 0
    for stride in STRIDES:
        which = np.arange(0, len(short), stride)
        if before:
            out[which] = np.maximum(out[which], out[which - which % before])
        before = stride
        x, low = short[which], out[which]
        # low: everything before it is less than x; low + step: to be tried
        high, step, open_ = low.copy(), 1, np.arange(len(which))
        while len(open_):
            at = high[open_]
            less = at < len(long)
            less[less] = long[at[less]] < x[open_[less]]
            open_ = open_[less]
            low[open_] = high[open_] + 1
            high[open_] += step
            step *= 2
        np.minimum(high, len(long), out=high)
        open_ = np.flatnonzero(low < high)
        while len(open_):
            mid = (low[open_] + high[open_]) >> 1
            less = long[mid] < x[open_]
            low[open_[less]] = mid[less] + 1
            high[open_[~less]] = mid[~less]
            open_ = open_[low[open_] < high[open_]]
        out[which] = low
    return out


def common_ends(a: np.ndarray, b: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in a, places in b) of the ends found in both, in order. ``a_at``, ``b_at``: first place of each text and the end.

    Ends of later texts are greater. In each text the shorter list drives.
    """
    n_a, n_b = np.diff(a_at), np.diff(b_at)
    found = []
    for drives, other, at, other_at, mine in ((a, b, a_at, b_at, n_a <= n_b), (b, a, b_at, a_at, n_a > n_b)):
        n = np.diff(at)
        which = np.flatnonzero(np.repeat(mine, n))
        place = gallop(drives[which], other, np.repeat(other_at[:-1], n)[which])
        same = place < len(other)
        same[same] = other[place[same]] == drives[which[same]]
        found.append((which[same], place[same]))
    left = np.concatenate([found[0][0], found[1][1]])
    right = np.concatenate([found[0][1], found[1][0]])
    order = np.argsort(left, kind="stable")
    return left[order], right[order]


def _byte_level() -> dict[str, int]:
    """Characters that byte-level vocabularies write for bytes: printable ones stand for themselves, the rest follow from 256 on."""
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file; a text is tokenized with a blank before it."""

    def __init__(self, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(raw.decode())
        self.model.encode_special_tokens = True
        told = json.loads(raw)
        byte_of = _byte_level()
        pieces = {i: bytes(byte_of[c] for c in p) for p, i in told["model"]["vocab"].items() if all(c in byte_of for c in p)}
        pieces |= {t["id"]: t["content"].encode() for t in told.get("added_tokens") or []}
        self.bytes_of = [pieces.get(i, b"") for i in range(max(pieces) + 1)]

    def encode(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch([" " + p for p in parts], add_special_tokens=False)]


class Pieces:
    """A SentencePiece model with byte pieces; it puts the blank before a text by itself."""

    def __init__(self, raw: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.bytes_of = []
        for i in range(self.model.get_piece_size()):
            p = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes_of.append(bytes([int(p[3:5], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(p.replace(_BLANK, " ").encode())

    def encode(self, parts: list[str]) -> list[list[int]]:
        return self.model.encode(parts, num_threads=1)


class Aligner:
    """Both tokenizers with the length in bytes of each token, and the tokens of the pieces of text met so far.

    A text is cut at every single blank between two other characters. No token of either side reaches over such a blank (checked on the
    vocabularies), and both put a blank before what they get; so the tokens of a text are those of its pieces, one after the other.
    """

    def __init__(self, raw_a: bytes, raw_b: bytes):
        self.sides = (ByteLevel(raw_a), Pieces(raw_b))
        self.lengths = [np.array([len(x) for x in s.bytes_of], dtype=np.int64) for s in self.sides]
        # a token with a blank behind another character would be lost by a cut there
        self.cuts = not any(re.search(r"\S ", x.decode("utf-8", "replace")) for s in self.sides for x in s.bytes_of)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.n = [0, 0]
        self.ids = [[np.zeros(0, dtype=np.int32)] for _ in self.sides]
        self.at = [[np.zeros(1, dtype=np.int64)] for _ in self.sides]
        self.exact = [np.zeros(0, dtype=bool)]

    def _learn(self, pieces: list[str]) -> None:
        """Tokens of new pieces. Those without white space at their ends are tokenized many at once, as a text that is cut between them."""
        joined, single = [], []
        for p in pieces:
            (single if p[0].isspace() or p[-1].isspace() else joined).append(p)
        batches, at, size = [], 0, 0
        for i, p in enumerate(joined):
            size += len(p)
            if size >= JOINED:
                batches.append(joined[at: i + 1])
                at, size = i + 1, 0
        for batch in [*batches, joined[at:], *([p] for p in single)]:
            if batch:
                self._add(batch)

    def _add(self, batch: list[str]) -> None:
        raw = b" " + " ".join(batch).encode()
        ends = np.cumsum([len(p.encode()) + 1 for p in batch])
        found, exact = [], True
        for model, lengths in zip(self.sides, self.lengths):
            ids = model.encode([" ".join(batch)])[0]
            exact &= b"".join(map(model.bytes_of.__getitem__, ids)) == raw
            ids = np.array(ids, dtype=np.int32)
            found.append((ids, np.searchsorted(np.cumsum(lengths[ids]), ends) + 1 if len(batch) > 1 else np.array([len(ids)])))
        if not exact and len(batch) > 1:
            for half in (batch[: len(batch) // 2], batch[len(batch) // 2:]):
                self._add(half)
            return
        for side, (ids, places) in enumerate(found):
            self.at[side].append(self.n[side] + places)
            self.ids[side].append(ids)
            self.n[side] += len(ids)
        self.exact.append(np.full(len(batch), exact))
        self.known.update(zip(batch, range(len(self.known), len(self.known) + len(batch))))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides, and the first place of each text and the end; texts whose tokens do not give back their bytes have none."""
        if len(self.known) > MOST_PIECES or max(self.n) > MOST_IDS:
            self._forget()
        pieces = [(_CUT.split(t) if self.cuts else [t]) if t else [] for t in texts]
        flat = list(chain.from_iterable(pieces))
        new = set(flat).difference(self.known)
        if new:
            self._learn(list(new))
            for held in (*self.ids, *self.at, self.exact):
                held[:] = [np.concatenate(held)]
        met = np.fromiter(map(self.known.__getitem__, flat), dtype=np.int64, count=len(flat))
        piece_at = np.cumsum([0, *map(len, pieces)])
        doubtful = np.unique(np.searchsorted(piece_at, np.flatnonzero(~self.exact[0][met]), side="right") - 1).tolist()
        empty = [d for d in doubtful if not self._gives_back(texts[d], met[piece_at[d]:piece_at[d + 1]])]
        if empty:
            stays = np.ones(len(texts), dtype=bool)
            stays[empty] = False
            per = np.diff(piece_at)
            met = met[np.repeat(stays, per)]
            piece_at = np.append(0, np.cumsum(np.where(stays, per, 0)))
        ids, at = [], []
        for (all_ids,), (starts,) in zip(self.ids, self.at):
            n = starts[met + 1] - starts[met]
            ends = np.append(0, np.cumsum(n))
            ids.append(all_ids[np.repeat(starts[met] - ends[:-1], n) + np.arange(ends[-1])].astype(np.int64))
            at.append(ends[piece_at])
        return ids, at

    def _gives_back(self, text: str, met: np.ndarray) -> bool:
        """Whether the tokens of both sides are the text, byte for byte, also where those of a piece are not."""
        whole = b" " + text.encode()
        return all(
            b"".join(model.bytes_of[i] for m in met for i in ids[at[m]:at[m + 1]]) == whole for model, (ids,), (at,) in zip(self.sides, self.ids, self.at))

    def align(self, texts: list[str]):
        """(ids a, ids b, first place of each text in a and in b, places of common ends in a and in b)."""
        ids, at = self.encode(texts)
        ends = [np.cumsum(n[i]) for n, i in zip(self.lengths, ids)]
        return *ids, *at, *common_ends(*ends, *at)


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))


def _aligned(aligner: Aligner, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (id, text) -> smaller batches (id, ids_a, ids_b, ends_a, ends_b)."""
    for b in batches:
        at, _ = text_buffers(b.column(1))
        for lo, hi in row_pieces(at, SLICE):
            a, b_ids, a_at, b_at, left, right = aligner.align(b.column(1).slice(lo, hi - lo).to_pylist())
            group_at = np.searchsorted(left, a_at)
            doc = np.repeat(np.arange(hi - lo), np.diff(group_at))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), _lists(a, a_at), _lists(b_ids, b_at), _lists(left + 1 - a_at[doc], group_at), _lists(right + 1 - b_at[doc], group_at)],
                ["id", "ids_a", "ids_b", "ends_a", "ends_b"])


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, first place of each row and the end) of a list column without nulls."""
    at = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]].astype(np.int64), at - at[0]


_said: list[list[str]] = [[]]


def _spellings(n: int) -> list[str]:
    """Decimal ids below n with a comma behind them, then with a bar, then with a semicolon."""
    if len(_said[0]) != 3 * n:
        _said[0] = [f"{i}{mark}" for mark in ",|;" for i in range(n)]
    return _said[0]


def _digested(vocabulary: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Aligned batches -> (id, n_a, n_b, n_groups, groups_sha256, links): a link is the id pair of the tokens that end together, a * 2^32 + b.

    Every common end is the end of one token on either side, as no token is empty: a link per group.
    """
    said = _spellings(vocabulary)
    for batch in batches:
        (a, a_at), (b, b_at), (ends_a, g_at), (ends_b, _) = (_flat(batch.column(i)) for i in range(1, 5))
        doc = np.repeat(np.arange(len(batch)), np.diff(g_at))
        a_end, b_end = ends_a + a_at[doc], ends_b + b_at[doc]
        # a token's place in the written groups: the tokens of its side before it, and those of the other side's groups that come before
        a_place = np.arange(len(a)) + np.repeat(np.append(0, b_end)[:-1], np.diff(a_end, prepend=0))
        b_place = np.arange(len(b)) + np.repeat(a_end, np.diff(b_end, prepend=0))
        code = np.empty(len(a) + len(b), dtype=np.int64)
        code[a_place], code[b_place] = a, b
        code[a_place[a_end - 1]] += vocabulary
        code[b_place[b_end - 1]] += 2 * vocabulary
        text, at = list(map(said.__getitem__, code.tolist())), (a_at + b_at).tolist()
        digest = [hashlib.sha256("".join(text[s:e])[:-1].encode()).hexdigest() if e > s else "" for s, e in zip(at, at[1:])]
        links = a[a_end - 1] << 32 | b[b_end - 1]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(np.diff(x), pa.int64()) for x in (a_at, b_at, g_at)), pa.array(digest, pa.string()),
             pa.ListArray.from_arrays(pa.array(g_at, pa.int32()), pa.array(links, pa.int64()))],
            ["id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])


def _tokenized(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, made: str, then=None) -> DataFrame:
    raw = []
    for path in (path_a, path_b):
        with open(path, "rb") as f:
            raw.append(f.read())
    shared = docs.sparkSession.sparkContext.broadcast(tuple(raw))  # the size of the vocabulary files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)  # for this task only: workers live on, and later stages need the room
        found = _aligned(aligner, batches)
        return then(max(map(len, aligner.lengths)), found) if then else found

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {made}")


def align_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids_a, ids_b (tokens of both sides), ends_a, ends_b (how many tokens of either side lie before the end of each group).

    ``path_a``: a byte-level BPE file, whose text gets a blank before it; ``path_b``: a SentencePiece model, which adds the blank. Special tokens in a
    text are plain text. Group g holds the tokens ends[g - 1] to ends[g] of either side: the tokens that overlap are ranges of ranks.

    Null and empty texts, and texts that either side's tokens do not give back byte for byte, have empty lists. Rows are independent: repeated rows and
    ids are repeated in the result, an empty table gives none, other columns are ignored. Texts are tokenized piece by piece, in slices. The two files are
    read once, by the driver.
    """
    made = "ids_a array<int>, ids_b array<int>, ends_a array<int>, ends_b array<int>"
    return _tokenized(docs, path_a, path_b, id_col, text_col, made).withColumnRenamed("id", id_col)


def _least_of_head(counts: DataFrame, most: int) -> int:
    """Least count such that at most ``most`` pairs have it or more: from how many pairs lie in each eighth of a power of two."""
    step = F.floor(F.log2("n") * 8).cast("int")
    pairs = {r.step: r.pairs for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs")).collect()}  # 8 * 63 rows at most
    total, least = 0, 1 << 62
    for s in sorted(pairs, reverse=True):
        total += pairs[s]
        if total > most:
            return least
        least = int(np.ceil(2 ** (s / 8) - 1e-6))
    return 1


def alignment_counts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, from the groups of :func:`align_tokens`.

    A link is a pair of tokens that end together, its count how many links of the whole table have the same two ids. ``n_best``: links whose count is the
    greatest of all links of their second id. ``groups_sha256``: digest of the groups as text, empty without tokens. Rows as in :func:`align_tokens`.

    Pair counts are summed in every task before they are shuffled. At most ``head`` of the most frequent pairs go to all tasks, with the greatest
    count of each second id (as many as the vocabulary has); all other pairs are rare and are met by a join, so that no pair is a large group.
    """
    spark = docs.sparkSession
    made = "n_a long, n_b long, n_groups long, groups_sha256 string, links array<long>"
    # written once: tokens are the dear part, and row numbers must not change when a task is run again
    rows = stored(_tokenized(docs, path_a, path_b, id_col, text_col, made, _digested).withColumn("row", F.monotonically_increasing_id()), "alignment")
    counts = stored(rows.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    second = F.expr("pair & 4294967295").cast("int")
    best = {r.b: r.n for r in counts.groupBy(second.alias("b")).agg(F.max("n").alias("n")).collect()}  # the size of a vocabulary
    least = _least_of_head(counts, head)
    top = sorted((r.pair, r.n) for r in counts.where(F.col("n") >= least).collect())  # at most `head` rows
    most = np.zeros(max(best, default=0) + 1, dtype=np.int64)
    for b, n in best.items():
        most[b] = n
    shared = spark.sparkContext.broadcast((np.array([p for p, _ in top], dtype=np.int64), np.array([n for _, n in top], dtype=np.int64), most))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, most = shared.value
        for b in (b.slice(lo, hi - lo) for b in batches for lo, hi in row_pieces(_flat(b.column(1))[1], LINKS)):
            links, at = _flat(b.column(1))
            place = np.searchsorted(pair, links)
            known = place < len(pair)
            known[known] = pair[place[known]] == links[known]
            count = np.zeros(len(links), dtype=np.int64)
            count[known] = n[place[known]]
            sums = [np.append(0, np.cumsum(x))[at] for x in (count, known & (count == most[links & 0xFFFFFFFF]), ~known)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(sums[1]), pa.int64()), pa.array(np.diff(sums[0]), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(sums[2], pa.int32()), pa.array(links[~known], pa.int64()))],
                ["row", "head_best", "head_sum", "rare"])

    scored = stored(rows.select("row", "links").mapInArrow(score, "row long, head_best long, head_sum long, rare array<long>"), "alignment-scores")
    rare = scored.select("row", F.explode("rare").alias("pair")).join(counts.where(F.col("n") < least), "pair")
    highest = counts.groupBy(second.alias("b")).agg(F.max("n").alias("most"))
    rare = rare.join(highest, second == F.col("b")).groupBy("row").agg(
        F.sum("n").alias("rare_sum"), F.sum((F.col("n") == F.col("most")).cast("long")).alias("rare_best"))
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).cast("long")
    return rows.drop("links").join(scored.drop("rare"), "row").join(rare, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), plus("head_best", "rare_best").alias("n_best"),
        plus("head_sum", "rare_sum").alias("count_sum"), "groups_sha256")
