"""Fill-in-middle: texts cut at drawn code points, the cuts found by a piecewise-linear learned rank index.

The boundaries of code points are the key set of the index: rank (how many code points stand before) -> byte offset. Segments are fitted
greedily: a segment grows while one slope keeps every offset in it within ``BOUND`` bytes. What the segments miss is stored as one byte per
boundary, so a cut is predicted by its segment and then corrected exactly, without walking the text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.llm.words import row_pieces, text_buffers

BOUND = 126  # bytes a segment may miss a boundary by; with rounding a residual fits into one signed byte
BLOCK = 1 << 20  # bytes whose boundaries are listed at once; a segment ends with its block
SENTINELS = ("<P>", "<S>", "<M>")


class RankIndex:
    """Offsets of sorted boundaries by rank: per segment its first rank, first offset and slope; per boundary its residual."""

    def __init__(self, bound: int = BOUND):
        self.bound = bound
        self._first: list[int] = []
        self._place: list[int] = []
        self._slope: list[float] = []
        self._residuals: list[np.ndarray] = []
        self.size = 0

    def _segment(self, at: np.ndarray, s: int) -> tuple[int, float]:
        """(end, slope) of the longest segment from boundary ``s``: the cone of slopes that miss no boundary by more than the bound."""
        low, high, e, step = -np.inf, np.inf, s + 1, 256
        while e < len(at) and low <= high:
            stop = min(len(at), e + step)
            run, rise = np.arange(e - s, stop - s), at[e:stop] - at[s]
            lows = np.maximum.accumulate(np.maximum((rise - self.bound) / run, low))
            highs = np.minimum.accumulate(np.minimum((rise + self.bound) / run, high))
            empty = lows > highs
            fits = int(empty.argmax()) if empty[-1] else stop - e
            if fits:
                low, high = lows[fits - 1], highs[fits - 1]
            e += fits
            if empty[-1]:
                break
            step = min(2 * step, 1 << 16)
        return e, float(low + high) / 2 if e > s + 1 else 0.0

    def add(self, at: np.ndarray) -> None:
        """Further boundaries, in order, all beyond the ones added before."""
        s = 0
        while s < len(at):
            e, slope = self._segment(at, s)
            self._first.append(self.size + s)
            self._place.append(int(at[s]))
            self._slope.append(slope)
            self._residuals.append((at[s:e] - at[s] - np.rint(slope * np.arange(e - s)).astype(np.int64)).astype(np.int8))
            s = e
        self.size += len(at)

    def done(self) -> RankIndex:
        self.first, self.place = np.array(self._first, dtype=np.int64), np.array(self._place, dtype=np.int64)
        self.slope = np.array(self._slope)
        self.residual = np.concatenate(self._residuals) if self._residuals else np.zeros(0, dtype=np.int8)
        return self

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        """Offsets by the segments alone: none is further from the truth than the bound (and half a byte of rounding)."""
        seg = np.searchsorted(self.first, ranks, side="right") - 1
        return self.place[seg] + np.rint(self.slope[seg] * (ranks - self.first[seg])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets."""
        return self.predict(ranks) + self.residual[ranks]


def index_texts(data: np.ndarray, at: np.ndarray) -> tuple[RankIndex, np.ndarray]:
    """Index of all code point boundaries (and the end) of texts that lie one after another in UTF-8 bytes; first rank of each text and the end."""
    index, ranks = RankIndex(), np.empty(len(at), dtype=np.int64)
    for lo in range(0, len(data), BLOCK):
        hi = min(lo + BLOCK, len(data))
        found = np.flatnonzero((data[lo:hi] & 0xC0) != 0x80) + lo
        a, b = np.searchsorted(at, [lo, hi])
        ranks[a:b] = index.size + np.searchsorted(found, at[a:b])
        index.add(found)
    ranks[np.searchsorted(at, len(data)):] = index.size
    index.add(np.array([len(data)], dtype=np.int64))
    return index.done(), ranks


def _draws(id_col: str, seed: int) -> list[Column]:
    """Four numbers below 2^32 for a row, from the hash of seed and id; a null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 90, suffix_first_percent: int = 20, seed: int = 1,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """Per row: id, n (code points), form, prefix_chars, middle_chars, output.

    Two of four numbers drawn from seed and id cut a text into prefix, middle and suffix, possibly empty ones; the third one leaves all but ``percent``
    of the texts plain, the fourth puts the suffix first (``spm``) in ``suffix_first_percent`` of the rest, else the prefix (``psm``).
    Texts that contain a sentinel stay plain, so :func:`restored` is exact.

    Null and empty texts are plain with n = 0 and an empty output; plain rows have null prefix_chars and middle_chars. A null id draws like an
    empty one. Rows are independent: repeated rows and ids are repeated in the result, an empty table gives none, other columns are
    ignored. Texts are read in slices of some MB; a longer text is a slice by itself, of which the index keeps one byte a code point.
    """
    p, s, m = (x.encode() for x in sentinels)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    h1, h2, h3, h4 = _draws(id_col, seed)
    holds = F.lit(False)
    for x in sentinels:
        holds = holds | F.contains(text, F.lit(x))
    form = F.when((text == "") | holds | (h3 % 100 >= percent), "plain").when(h4 % 100 < suffix_first_percent, "spm").otherwise("psm")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends, data = text_buffers(b.column(1))
            for lo, hi in row_pieces(ends):
                part, at = data[ends[lo]:ends[hi]], ends[lo: hi + 1] - ends[lo]
                index, rank = index_texts(part, at)
                n = np.diff(rank)
                said = b.column(2).slice(lo, hi - lo).to_pylist()
                cut = np.stack([b.column(i).slice(lo, hi - lo).to_numpy() % (n + 1) for i in (3, 4)])
                first, last = cut.min(axis=0), cut.max(axis=0)
                x, y = index.offsets(rank[:-1] + first).tolist(), index.offsets(rank[:-1] + last).tolist()
                raw, at, out = part.tobytes(), at.tolist(), []
                for i, kind in enumerate(said):
                    if kind == "plain":
                        out.append(raw[at[i]:at[i + 1]])
                        continue
                    prefix, middle, suffix = raw[at[i]:x[i]], raw[x[i]:y[i]], raw[y[i]:at[i + 1]]
                    out.append(b"".join((p, prefix, s, suffix, m, middle) if kind == "psm" else (s, suffix, p, prefix, m, middle)))
                plain = np.array([kind == "plain" for kind in said], dtype=bool)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), b.column(2).slice(lo, hi - lo), pa.array(first, pa.int64(), mask=plain),
                    pa.array(last - first, pa.int64(), mask=plain), pa.array(out, pa.string())],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text an output was made of. Sentinels do not overlap and no text contains one, so each stands exactly where it was put."""
    p, s, m = map(F.lit, sentinels)
    one, two = F.lit(1), F.lit(2)
    middle = F.split_part(output, m, two)
    psm = F.concat(
        F.split_part(F.split_part(output, s, one), p, two), middle, F.split_part(F.split_part(output, s, two), m, one))
    spm = F.concat(
        F.split_part(F.split_part(output, p, two), m, one), middle, F.split_part(F.split_part(output, p, one), s, two))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
