"""LM scoring: a log-bilinear neural model of word pairs, trained in numpy with noise-contrastive estimation, beside exact word counts.

The model's context is the word before. Words are classes: the end of a text (also the context of a first word), all rarer words together, and
the most frequent words. A rarer word's probability is that of its class times its add-one share among rarer words, so that
every text has a normalised probability. How often class follows class is counted over the whole training corpus (the model's sufficient
statistic); the parameters are fitted to these counts, and one matrix product over all contexts gives all normalised log-probabilities.

Word counts are exact for every word: the most frequent ones (a fixed number) are looked up in a broadcast table, rarer ones are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.llm.frames import block_rows, crc_rest, sum_blocks
from tierwork.llm.words import words
from tierwork.sources.storage import cut_lineage

CLASSES = 1024  # with the two below
END, RARE = 0, 1
HEAD_WORDS = 1 << 18  # most words whose counts every task holds (20 bytes each)
STEPS = 16  # steps per doubling of a count, when the least count of these words is chosen
WIDTH = 4096
END_HASH = np.uint64(0x1F83D9ABFB41BD6B)


class LogBilinear:
    """score(word | before) = (R[before] C) . Q[word] + b[word]."""

    def __init__(self, classes: int, size: int = 24, seed: int = 3):
        r = np.random.default_rng(seed)
        self.p = {"R": r.normal(0, 0.1, (classes, size)), "C": np.eye(size), "Q": r.normal(0, 0.1, (classes, size)), "b": np.zeros(classes)}

    def log_probabilities(self) -> np.ndarray:
        """(before, word): normalised, natural logarithm."""
        s = self.p["R"] @ self.p["C"] @ self.p["Q"].T + self.p["b"]
        s -= s.max(axis=1, keepdims=True)
        return s - np.log(np.exp(s).sum(axis=1, keepdims=True))

    def train(self, pairs: np.ndarray, steps: int = 2500, rows: int = 1024, noise: int = 64, rate: float = 0.02, seed: int = 4) -> None:
        """Noise-contrastive estimation: pairs drawn by ``pairs`` (counts, before x word) against ``noise`` words drawn by frequency."""
        r = np.random.default_rng(seed)
        flat = np.flatnonzero(pairs)
        if not len(flat):
            return
        by = np.cumsum(pairs.reshape(-1)[flat], dtype=float)
        q = pairs.sum(axis=0) + 0.5
        q = q / q.sum()
        log_noise, cum_noise = np.log(noise * q), np.cumsum(q)
        self.p["b"] = np.log(q)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            drawn = flat[np.minimum(np.searchsorted(by, r.random(rows) * by[-1], side="right"), len(flat) - 1)]
            before, word = drawn // pairs.shape[1], drawn % pairs.shape[1]
            other = np.minimum(np.searchsorted(cum_noise, r.random(noise), side="right"), len(q) - 1)
            R, C, Q, b = (self.p[k] for k in "RCQb")
            hr = R[before]
            h = hr @ C
            s = np.einsum("rd,rd->r", h, Q[word]) + b[word] - log_noise[word]
            t = h @ Q[other].T + b[other] - log_noise[other]
            ds = -1 / (1 + np.exp(s)) / rows  # pull real pairs up, noise down
            dt = 1 / (1 + np.exp(-t)) / rows
            dh = ds[:, None] * Q[word] + dt @ Q[other]
            g = {k: np.zeros_like(x) for k, x in self.p.items()}
            np.add.at(g["Q"], word, ds[:, None] * h)
            np.add.at(g["Q"], other, dt.T @ h)
            np.add.at(g["b"], word, ds)
            np.add.at(g["b"], other, dt.sum(axis=0))
            g["C"] = hr.T @ dh
            np.add.at(g["R"], before, dh @ C.T)
            now = rate * (1 - 0.95 * step / steps)
            for k, x in g.items():
                m[k] += 0.1 * (x - m[k])
                v[k] += 0.01 * (x * x - v[k])
                self.p[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)


def _word_counts(texts: DataFrame) -> DataFrame:
    """(h, c): exact count of each word and of text ends, added per task before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, times = [], []
            for _, _, _, h in words(b.column(0)):
                u, n = np.unique(h, return_counts=True)
                found.append(u)
                times.append(n)
            found.append(np.array([END_HASH], dtype=np.uint64))
            times.append(np.array([len(b)]))
            u, at = np.unique(np.concatenate(found), return_inverse=True)
            n = np.bincount(at, np.concatenate(times))
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "c"])

    return texts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _head(counts: DataFrame) -> DataFrame:
    """The words counted at least so often that they are ``HEAD_WORDS`` at most: from how many words have which count, no sort."""
    step = F.floor(F.log2("c") * STEPS)
    per = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect()  # 64 * STEPS rows at most
    least, held = per[0].step + 1 if per else 0, 0
    for r in per:
        held += r.n
        if held > HEAD_WORDS:
            break
        least = r.step
    return counts.where(step >= least)


class _Table:
    """Classes and counts of the head words, by search in the sorted hashes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        # END is looked up apart; the most frequent other words are classes of their own
        rank = np.lexsort((hashes, -counts))[: CLASSES - 2]
        self.classes = np.full(len(hashes), RARE, dtype=np.int32)
        self.classes[rank] = np.arange(2, 2 + len(rank))
        self.classes = self.classes[order]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, found)."""
        if not len(self.hashes):
            return np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=bool)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return at, self.hashes[at] == h


def _sequences(table: _Table, column: pa.Array):
    """Per piece of a batch: (first row, row after the last, row of each token, its class, the class before, log10(count + 1), found, hashes)."""
    for lo, hi, first, h in words(column):
        n = np.diff(first) + 1  # with the end
        ends = np.cumsum(n) - 1
        word = np.ones(int(n.sum()), dtype=bool)
        word[ends] = False
        cls = np.full(len(word), END, dtype=np.int32)
        found = np.ones(len(word), dtype=bool)
        count = np.zeros(len(word), dtype=np.int64)
        at, ok = table.find(h)
        cls[word] = np.where(ok, table.classes[at], RARE) if len(table.classes) else RARE
        found[word] = ok
        count[word] = np.where(ok, table.counts[at], 0) if len(table.counts) else 0
        before = np.concatenate((np.zeros(1, dtype=np.int32), cls[:-1]))  # an end (or the beginning) stands before a first word
        hashes = np.zeros(len(word), dtype=np.uint64)
        hashes[word] = h
        yield lo, hi, np.repeat(np.arange(lo, hi), n), cls, before, count, found, hashes


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, **how,
) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from all rows whose id's CRC32 modulo ``folds`` is not ``held``. Tokens are the words (A-Z lower-cased) and one end. base_score sums
    log10((c + 1) / (N + V + 1)) over the tokens; score is the model's log10 probability of the text. Null text is empty: one token. A null id counts
    as the empty text in the fold. Repeated rows are counted and scored each. Without training rows N and V are 0. Empty tables give no rows, other
    columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    held_out = crc_rest("id", folds) == held
    learn = rows.where(~held_out).select("text")
    counts = cut_lineage(_word_counts(learn))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    end = int(END_HASH.view(np.int64))
    head = _head(counts.where(F.col("h") != end)).toPandas()
    ends = total.n and counts.where(F.col("h") == end).first().c
    table = _Table(head["h"].to_numpy(dtype=np.int64).view(np.uint64), head["c"].to_numpy(dtype=np.int64))
    shared = spark.sparkContext.broadcast(table)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for b in batches:
            for _, _, _, cls, before, *_ in _sequences(shared.value, b.column(0)):
                pairs += np.bincount(before.astype(np.int64) * CLASSES + cls, minlength=CLASSES * CLASSES)
        yield block_rows(pairs, WIDTH)

    pairs = sum_blocks(learn.mapInArrow(count_pairs, "block int, data binary"), CLASSES * CLASSES, WIDTH).reshape(CLASSES, CLASSES)
    model = LogBilinear(CLASSES)
    model.train(pairs, **how)
    logs = spark.sparkContext.broadcast((model.log_probabilities() / np.log(10)).astype(np.float32))
    named = min(len(head), CLASSES - 2)
    rare_tokens = int(pairs[:, RARE].sum())
    log_rare = float(np.log10(rare_tokens + max(0, total.v - (total.n > 0) - named) + 1))  # add-one, and one word never met
    log_base = float(np.log10(total.n + total.v + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, log = shared.value, logs.value
        for b in batches:
            n = len(b)
            out = np.zeros((4, n))
            tails = []
            for lo, hi, row, cls, before, count, found, h in _sequences(table, b.column(1)):
                c = np.where((cls == END), ends, count)
                lc = np.log10(c + 1.0)
                rare = cls == RARE
                add = lambda w: np.bincount(row - lo, w, minlength=hi - lo)  # noqa: B023, E731
                out[0, lo:hi] = add(None)
                out[1, lo:hi] = add((c > 0).astype(float))
                out[2, lo:hi] = add(lc)
                out[3, lo:hi] = add(log[before, cls] + np.where(rare, lc - log_rare, 0.0))
                of = np.flatnonzero(~found)
                tails.append((np.bincount(row[of] - lo, minlength=hi - lo), h[of]))
            sizes = np.concatenate([t[0] for t in tails]) if tails else np.zeros(0, dtype=np.int64)
            values = np.concatenate([t[1] for t in tails]) if tails else np.zeros(0, dtype=np.uint64)
            tail = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(out[0].astype(np.int64)), pa.array(out[1].astype(np.int64)), pa.array(out[2] - out[0] * log_base), pa.array(out[3]), tail],
                ["id", "held_out", "n_tokens", "n_known", "base", "score", "tail"])

    kind = rows.schema["id"].dataType.simpleString()
    asked = rows.withColumn("held_out", held_out)
    scored = asked.mapInArrow(score, f"id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, tail array<long>")
    scored = cut_lineage(scored.withColumn("row", F.monotonically_increasing_id()))
    tail = scored.select("row", F.explode("tail").alias("h")).join(counts, "h").groupBy("row").agg(
        F.sum(F.log10(F.col("c") + 1.0)).alias("more"), F.count(F.lit(1)).alias("met"))
    more = F.coalesce(F.col("more"), F.lit(0.0))
    return scored.drop("tail").join(tail, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(int(total.n)).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"))
