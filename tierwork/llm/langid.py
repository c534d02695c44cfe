"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

The network reads each word byte by byte in both directions, labels every byte with language probabilities, and a document's probabilities are
pooled from all its bytes (normalised geometric mean). A word met several times in a batch is read once and counted as often as it occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from tierwork.llm.frames import crc_rest, own_name
from tierwork.llm.words import hash_parts, lower, row_pieces, spans, text_buffers
from tierwork.llm.worker import store

LONGEST = 24  # bytes read together; longer words are read in parts
TOGETHER = 12 << 20  # bytes of texts whose repeated words are read once
UNKNOWN = "und"


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


class ByteGru:
    """Parameters of both directions and of the output layer; ``hidden`` units per direction."""

    def __init__(self, classes: int, hidden: int = 12, seed: int = 5):
        r = np.random.default_rng(seed)
        n = lambda *s: r.normal(0, 0.3, s).astype(np.float32)
        self.hidden = hidden
        self.p = {"xf": n(256, 3 * hidden), "uf": n(hidden, 3 * hidden), "xb": n(256, 3 * hidden), "ub": n(hidden, 3 * hidden),
                  "o": n(2 * hidden, classes), "ob": np.zeros(classes, dtype=np.float32)}

    def _run(self, x: np.ndarray, u: np.ndarray, data: np.ndarray, keep: bool):
        """Hidden states (time, rows, hidden) of one direction; with ``keep`` also what the way back needs."""
        rows, steps = data.shape
        hid, h = self.hidden, np.zeros((rows, self.hidden), dtype=np.float32)
        out, kept = np.empty((steps, rows, hid), dtype=np.float32), []
        for t in range(steps):
            a, g = x[data[:, t]], h @ u
            rz = _sigmoid(a[:, : 2 * hid] + g[:, : 2 * hid])
            r, z = rz[:, :hid], rz[:, hid:]
            n = np.tanh(a[:, 2 * hid:] + r * g[:, 2 * hid:])
            if keep:
                kept.append((h, r, z, n, g[:, 2 * hid:]))
            h = n + z * (h - n)
            out[t] = h
        return out, kept

    def _back(self, u, data, kept, dh_out, dx, du):
        """Through time, last step first: adds to the gradients dx (by byte) and du."""
        hid, dh = self.hidden, np.zeros_like(dh_out[0])
        for t in range(data.shape[1] - 1, -1, -1):
            h, r, z, n, gn = kept[t]
            dh = dh + dh_out[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            da = np.concatenate((dr, dz, dn), axis=1)
            dg = np.concatenate((dr, dz, dn * r), axis=1)
            np.add.at(dx, data[:, t], da)
            du += h.T @ dg
            dh = dh * z + dg @ u.T

    def log_probabilities(self, data: np.ndarray) -> np.ndarray:
        """(rows, classes): log-probabilities summed over the bytes of each row; rows have one length."""
        f, _ = self._run(self.p["xf"], self.p["uf"], data, False)
        b, _ = self._run(self.p["xb"], self.p["ub"], data[:, ::-1], False)
        s = np.concatenate((f, b[::-1]), axis=2) @ self.p["o"] + self.p["ob"]
        s -= s.max(axis=2, keepdims=True)
        return (s - np.log(np.exp(s).sum(axis=2, keepdims=True))).sum(axis=0)

    def gradients(self, data: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
        f, kf = self._run(self.p["xf"], self.p["uf"], data, True)
        b, kb = self._run(self.p["xb"], self.p["ub"], data[:, ::-1], True)
        h = np.concatenate((f, b[::-1]), axis=2)
        s = h @ self.p["o"] + self.p["ob"]
        s -= s.max(axis=2, keepdims=True)
        e = np.exp(s)
        q = e / e.sum(axis=2, keepdims=True)
        rows = np.arange(len(label))
        loss = -np.log(q[:, rows, label] + 1e-9).mean()
        q[:, rows, label] -= 1
        ds = q / (q.shape[0] * q.shape[1])
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["o"] = np.einsum("trh,trc->hc", h, ds)
        g["ob"] = ds.sum(axis=(0, 1))
        dh = ds @ self.p["o"].T
        self._back(self.p["uf"], data, kf, dh[:, :, : self.hidden], g["xf"], g["uf"])
        self._back(self.p["ub"], data[:, ::-1], kb, dh[::-1, :, self.hidden:], g["xb"], g["ub"])
        return float(loss), g

    def train(self, words: list[tuple[np.ndarray, np.ndarray]], steps: int, rows: int = 256, rate: float = 0.01, seed: int = 6) -> None:
        """Adam over batches of words of one length. ``words``: per length (bytes, class), where longer lengths are drawn by their bytes."""
        words = [(d, c) for d, c in words if len(d)]
        if not words:
            return
        r = np.random.default_rng(seed)
        share = np.array([d.size for d, _ in words], dtype=float)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            data, label = words[r.choice(len(words), p=share / share.sum())]
            pick = r.integers(0, len(data), rows)
            _, g = self.gradients(data[pick], label[pick])
            now = rate * (1 - 0.9 * step / steps)
            for k, x in g.items():
                m[k] += 0.1 * (x - m[k])
                v[k] += 0.001 * (x * x - v[k])
                self.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def _by_length(texts: list[str], label: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    groups: dict[int, tuple[list, list]] = {n: ([], []) for n in range(1, LONGEST + 1)}
    for lo, _, first, part, s, e in spans(pa.array(texts, pa.string()), LONGEST):
        row = np.searchsorted(first, np.arange(len(s)), side="right") - 1 + lo
        part, labels = lower(part), np.array(label)[row]
        for n, (data, cls) in groups.items():
            of = np.flatnonzero(e - s == n)
            data.append(part[s[of][:, None] + np.arange(n)])
            cls.append(labels[of])
    return [(np.concatenate(d), np.concatenate(c)) for d, c in groups.values() if d]


def fit(learn: DataFrame, steps: int = 1200, sample_docs: int = 200, sample_chars: int = 4000, hidden: int = 12) -> tuple[list[str], ByteGru | None]:
    """(languages, network) from rows (id, text, lang) with texts and languages.

    Learns from a bounded sample: of each language the ``sample_docs`` documents with the least hash of id and text, the first ``sample_chars``
    characters of each. Every language of the rows is learned; languages weigh the same in training.
    """
    keyed = learn.withColumn("draw", F.xxhash64("id", "text"))
    ranked = keyed.select("lang", "draw").withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("draw")))
    upto = ranked.where(F.col("place") <= sample_docs).groupBy("lang").agg(F.max("draw").alias("upto"))
    drawn = keyed.join(F.broadcast(upto), "lang").where("draw <= upto")  # one row per language
    got = drawn.groupBy("lang", "draw").agg(F.first(F.substring("text", 1, sample_chars)).alias("text")).orderBy("lang", "draw").collect()
    names = sorted({r.lang for r in got})
    if not names:
        return [], None
    sizes = {n: max(1, sum(len(r.text) for r in got if r.lang == n)) for n in names}
    most = max(sizes.values())
    texts, label = [], []
    for r in got:  # a language with little text is repeated
        for _ in range(max(1, min(50, round(most / sizes[r.lang])))):
            texts.append(r.text)
            label.append(names.index(r.lang))
    net = ByteGru(len(names), hidden)
    net.train(_by_length(texts, label), steps)
    return names, net


def _pooled(net: ByteGru, column: pa.Array, classes: int) -> np.ndarray:
    """(rows, classes): probabilities pooled over all bytes of each text; zeros for texts without words."""
    pieces, known, order = [], [], []
    for lo, hi, first, part, s, e in spans(column, LONGEST):
        part = lower(part)
        hashes = hash_parts(part, s, e)
        names, at = np.unique(hashes, return_index=True)
        data = part[np.minimum(s[at][:, None] + np.arange(LONGEST), max(0, len(part) - 1))] if len(at) else np.zeros((0, LONGEST), dtype=np.uint8)
        known.append(names)
        sizes = (e - s).astype(np.uint8)
        order.append((data, sizes[at]))
        pieces.append((lo, hi, first, hashes, sizes))
    total = np.zeros((len(column), classes))
    if not known or not sum(map(len, known)):
        return total
    names, at = np.unique(np.concatenate(known), return_index=True)
    data, size = np.concatenate([d for d, _ in order])[at], np.concatenate([n for _, n in order])[at]
    said = np.zeros((len(names), classes), dtype=np.float32)
    for n in range(1, LONGEST + 1):
        of = np.flatnonzero(size == n)
        for i in range(0, len(of), 4096):
            said[of[i: i + 4096]] = net.log_probabilities(data[of[i: i + 4096], :n])
    for lo, hi, first, hashes, lengths in pieces:
        rows = np.repeat(np.arange(lo, hi), np.diff(first))
        found = said[np.searchsorted(names, hashes)]
        length = np.bincount(rows, lengths, minlength=len(column))[lo:hi]
        for c in range(classes):
            total[lo:hi, c] += np.bincount(rows, found[:, c], minlength=len(column))[lo:hi] / np.maximum(1, length)
    full = np.zeros(len(column), dtype=bool)
    for lo, hi, first, *_ in pieces:
        full[lo:hi] = np.diff(first) > 0
    total -= total.max(axis=1, keepdims=True)
    total = np.exp(total)
    return np.where(full[:, None], total / total.sum(axis=1, keepdims=True), 0.0)


def predict(docs: DataFrame, languages: list[str], net: ByteGru | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (pooled probability of the prediction) added under free names; returned names are the last two columns.

    Null texts and texts without a letter get ``und`` and 0; so does everything if no language was learned.
    """
    pred, score, letters = own_name(docs, "lang_pred"), own_name(docs, "score"), own_name(docs, "_letters")
    rows = docs.withColumn(letters, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    if net is None:
        return rows.drop(letters).withColumn(pred, F.lit(UNKNOWN)).withColumn(score, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast((languages, net.p, net.hidden))
    of, at, names_out = len(docs.columns), docs.columns.index(text_col), [*docs.columns, pred, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store("language")  # makes room: nothing is kept here
        names, params, hidden = shared.value
        n = ByteGru(len(names), hidden)
        n.p = params
        for b in batches:
            texts = b.column(at)
            p = np.concatenate([_pooled(n, texts.slice(lo, hi - lo), len(names)) for lo, hi in row_pieces(text_buffers(texts)[0], TOGETHER)] or [np.zeros((0, len(names)))])
            ok = b.column(of).to_numpy(zero_copy_only=False) & p.any(axis=1)
            best = p.argmax(axis=1)
            said = pa.array([names[i] if k else UNKNOWN for i, k in zip(best, ok)], pa.string())
            value = pa.array(np.where(ok, p[np.arange(len(p)), best], 0.0), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:of], said, value], names_out)

    schema = StructType(list(docs.schema.fields)).add(pred, StringType()).add(score, DoubleType())
    return rows.mapInArrow(run, schema)


def _learnable(rows: DataFrame, folds: int, held: int) -> DataFrame:
    return rows.where((crc_rest("id", folds) != held) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))


def keep_identified(
    docs: DataFrame, least_score: float, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held: int = 2, **how,
) -> DataFrame:
    """The rows of ``docs`` (all columns) whose language is recognised with at least ``least_score``; learns like :func:`identify`.

    Null texts and texts without a letter go, and so does everything if nothing could be learned.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    said = predict(docs, *fit(_learnable(rows, folds, held), **how), text_col)
    pred, score = said.columns[-2:]
    return said.where((F.col(pred) != UNKNOWN) & (F.col(score) >= least_score)).drop(pred, score)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held: int = 2, **how) -> DataFrame:
    """Per row: id, held_out, lang_pred, score. Learns from rows whose id's CRC32 modulo ``folds`` is not ``held``, with text and language.

    Only the text is read for a prediction. Null or letterless texts: ``und``, score 0. Repeated rows are predicted alike; a null id counts as the
    empty text in the fold. Empty tables give no rows, other columns are ignored. Texts of any length are read whole.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    held_out = crc_rest("id", folds) == held
    languages, net = fit(_learnable(rows, folds, held), **how)
    said = predict(rows.select("id", "text"), languages, net)
    return said.select(F.col("id").alias(id_col), held_out.alias("held_out"), "lang_pred", "score")
