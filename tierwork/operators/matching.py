"""Exact and edit-distance matching of facts to a lookup, in ordered passes.

All passes read the same fact columns, so a pass's answer for a (control, match) pair does not depend on the passes
before it. All passes are therefore solved once per distinct pair, fuzzy ones together with the pass as a part of the control; the
answers are joined back, and the first pass with an answer wins: the result equals running the passes one after the other on
what is still unmatched, in one linear plan.

The fuzzy join (``similar_texts``) is exact and does not compare all pairs of a control group. With similarity >= t, a lookup text of
length n tolerates k = floor((1 - t) * floor(n / t)) edits. k edits cannot touch all of k + 1 disjoint pieces of it, so every partner contains one
of them near its place. Any k + 1 disjoint pieces will do: a text is indexed by those that fewest facts contain (the least level of
frequency at which k + 1 disjoint pieces exist). Pieces and substrings meet in an equi-join; the edit distance is computed only for those pairs.

Where only the best partner is wanted (``closest_texts``) a likely partner, one that shares many trigrams, bounds the search first: a text that has a
partner looks only as far as a better one could be. In a round a text meets the lookup texts of its control of each length it can reach, in cells of a
bounded number of pairs. A pair is first ruled out by bits: an edit takes away and adds at most one occurrence of a character, two of bigrams and three
of trigrams; only what is left is compared. The bits of a block of pairs are compared at once (numpy, inside tasks). Nothing depends on pieces being
rare, and no pair leaves a cell without being within its bound. Thresholds are whole percents, so that no boundary case depends on floating point.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.operators.ordered import keep_first
from tierwork.sources.storage import cut_lineage

NAN = "nan"
PIECE_SIZES = (1, 2, 3, 5)
FIRST_EDITS = 2  # of the first round of a search
FEW_TEXTS = 64  # lookup texts of a control up to which a text meets them all in the first round
CELL_PAIRS = 1 << 24  # pairs that meet in a cell, about
LIKELY_EDITS = 2  # difference of length up to which a likely partner is looked for
JOINED_PAIRS = 1 << 12  # pairs of a control and length up to which they meet in a join
BLOCK_PAIRS = 1 << 16  # pairs of a cell that are tested at once
BIT_WORDS = {1: 4, 2: 6, 3: 8}  # words of 64 bits for the occurrences of characters, bigrams and trigrams in a text


@dataclass(frozen=True)
class MatchPass:
    """``thresholds`` in percent, highest first; 100 alone means exact."""

    control: str
    match: str
    lookup_control: str
    lookup_match: str
    thresholds: tuple[int, ...] = (100,)
    keep_missing: bool = False


def _edits(n: Column, pct: Column) -> Column:
    """Most edits a text of length n can be away from a partner at this similarity."""
    return F.floor((100 - pct) * F.floor(n * 100 / pct) / 100).cast("int")


def _piece_size(n: Column, k: Column) -> Column:
    """Characters of a piece: the greatest size of which k + 1 pieces fit into n characters."""
    size = F.lit(PIECE_SIZES[0])
    for x in PIECE_SIZES[1:]:
        size = F.when(x * (k + 1) <= n, x).otherwise(size)
    return size


def _grams(text: str, size: str, at: str, piece: str) -> list[Column]:
    """All substrings of a size with their places."""
    places = F.explode(F.sequence(F.lit(0), F.length(text) - F.col(size)))
    return [places.alias(at), F.substr(F.col(text), F.col(at) + 1, F.col(size)).alias(piece)]


def _taken(places: Column, level: Column, size: Column, out: Column, add) -> Column:
    """Disjoint pieces of at most a level from left to right, gathered into ``out`` by ``add``."""
    fits = lambda acc, x: (x["level"] <= level) & (x["at"] >= acc["free"])
    begin = F.struct(F.lit(0).alias("free"), out.alias("out"))
    return F.aggregate(places, begin, lambda acc, x: F.when(
        fits(acc, x), F.struct((x["at"] + size).alias("free"), add(acc["out"], x["at"]).alias("out"))).otherwise(acc))["out"]


def _facing(texts: DataFrame, lookup: DataFrame) -> DataFrame:
    """(control, a, b, most): pairs among which are all of at most ``most`` edits, the smaller bound of both texts.

    Inputs: (control, a, most), (control, b, k), distinct and not empty.
    """
    sized = lookup.withColumn("n", F.length("b")).withColumn("size", _piece_size(F.col("n"), F.col("k")))
    used = sized.select("control", "size").distinct()
    spread = texts.join(used, "control").where(F.length("a") >= F.col("size"))
    at, piece = _grams("a", "size", "at", "piece")
    faced = spread.select("control", "a", "most", "size", at).withColumn("piece", piece)
    seen = faced.groupBy("control", "piece").agg((F.floor(F.log2(F.count(F.lit(1)))) + 1).cast("int").alias("level"))

    at, piece = _grams("b", "size", "at", "piece")
    places = sized.select("control", "b", "n", "k", "size", at).withColumn("piece", piece).join(seen, ["control", "piece"], "left").groupBy(
        "control", "b", "n", "k", "size").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("level", F.lit(0)).alias("level")))).alias("places"))
    size, all_ = F.col("size"), F.col("places")
    needed = F.least(F.col("k") + 1, "n")  # partners share a character at least, so all single characters are enough
    levels = F.array_sort(F.array_distinct(F.transform(all_, lambda x: x["level"])))
    enough = F.filter(levels, lambda f: _taken(all_, f, size, F.lit(0), lambda n, _: n + 1) >= needed)[0]
    index = places.withColumn("level", enough).withColumn(
        "start", F.explode(_taken(all_, F.col("level"), size, F.array().cast("array<int>"), F.array_append))).select(
        "control", "b", "n", "k", "start", F.substr("b", F.col("start") + 1, size).alias("piece"))

    off, longer = F.col("at") - F.col("start"), F.length("a") - F.col("n")
    most = F.least("most", "k")
    near = F.abs(off) + F.abs(longer - off) <= most  # the edits before the piece and behind it
    return faced.join(index, ["control", "piece"]).where(near).select("control", "a", "b", most.alias("most")).distinct()


def _scored(facing: DataFrame) -> DataFrame:
    """Pairs within their bound: d and longest added."""
    d = F.levenshtein("a", "b").alias("d")
    return facing.select("control", "a", "b", "most", d, F.greatest(F.length("a"), F.length("b")).alias("longest")).where("d <= most").drop("most")


def _enough(pct: Column | int) -> Column:
    return (F.col("longest") - F.col("d")) * 100 >= F.col("longest") * pct


def similar_texts(pairs: DataFrame, lookup: DataFrame, pct: int) -> DataFrame:
    """All (control, a, b, similarity) with equal control and similarity >= pct/100. Inputs: (control, a), (control, b)."""
    if not 0 < pct <= 100:
        raise ValueError("threshold must be in 1..100 percent")
    texts = pairs.where(F.length("a") > 0).select("control", "a", _edits(F.length("a"), F.lit(pct)).alias("most")).distinct()
    rows = lookup.where(F.length("b") > 0).select("control", "b", _edits(F.length("b"), F.lit(pct)).alias("k")).distinct()
    return _scored(_facing(texts, rows)).where(_enough(pct)).select(
        "control", "a", "b", (1.0 - F.col("d") / F.col("longest").cast("double")).alias("similarity"))


def _with_bits(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the bits of a text (all 0 where ``few``): out0, out1 ... for its grams by size, each with the number it occurs at; the last grams of a text are shorter."""
    words, at = [], F.sequence(F.lit(1), F.length(text))
    for size, n in BIT_WORDS.items():
        gram = lambda i: F.xxhash64(F.substr(F.col(text), i, F.lit(size)))  # noqa: B023, E731
        nth = lambda g, i: i - F.array_position(f"__g{size}", g)  # noqa: B023, E731  grams are sorted, equal ones follow each other
        df = df.withColumn(f"__g{size}", F.when(~F.col("few"), F.sort_array(F.transform(at, gram))))
        df = df.withColumn(f"__p{size}", F.transform(f"__g{size}", lambda g, i: F.pmod(F.xxhash64(g, nth(g, i)), F.lit(64 * n)).cast("int")))  # noqa: B023
        words += [F.expr(f"coalesce(aggregate(filter(__p{size}, p -> p div 64 = {no}), 0L, (bits, p) -> bits | shiftleft(1L, p % 64)), 0L)") for no in range(n)]
    return df.withColumns({f"{out}{no}": w for no, w in enumerate(words)}).drop(*[f"__{c}{size}" for c in "gp" for size in BIT_WORDS])


def _may_be_near(most: Column) -> Column:
    """Whether the bits x (of a) and y (of b) let two texts be at most ``most`` edits apart: true for all that are."""
    lost = lambda one, two, no: F.bit_count(F.col(f"{one}{no}").bitwiseAND(F.bitwise_not(f"{two}{no}")))
    tests, first = [], 0
    for size, n in BIT_WORDS.items():
        tests += [reduce(add, [lost(one, two, no) for no in range(first, first + n)]) <= size * most for one, two in ("xy", "yx")]
        first += n
    return reduce(lambda one, two: one & two, tests)


def _cell_pairs(likeliest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``_may_be_near`` for the pairs of whole cells: (control, a, b, most) of those that the bits let through; ``likeliest``: for each a the b with most of its trigrams.

    Rows come sorted by cell (control, n, p, q), those of ``side`` 0 (text a, most) before those of 1 (text b). The pairs of a cell are tested in
    blocks of BLOCK_PAIRS; once few of a block are left, only those. A block's pairs leave before the next one, a cell stays in memory.
    """
    parts, words = [], 0
    for size, n in BIT_WORDS.items():
        parts.append((size, range(words, words + n)))
        words += n
    tests = [(size, of, forth) for forth in (True, False) for size, of in parts]
    block = BLOCK_PAIRS

    def shared(x: np.ndarray, y: np.ndarray, of: range) -> np.ndarray:
        n = np.bitwise_count(x[of[0]] & y[of[0]]).astype(np.uint16)
        for no in of[1:]:
            n += np.bitwise_count(x[no] & y[no])
        return n

    def likely(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(len(most)), shared(x[:, :, None], y[:, None, :], parts[-1][1]).argmax(axis=1)

    def near(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        no_x, no_y, ok, i, j = ~x, ~y, None, None, None
        for size, of, forth in tests:
            one, two = (x, no_y) if forth else (no_x, y)
            if i is None:
                passed = shared(one[:, :, None], two[:, None, :], of) <= size * most[:, None]
                ok = passed if ok is None else ok & passed
                if np.count_nonzero(ok) * 16 < ok.size:
                    i, j = np.nonzero(ok)
            else:
                passed = shared(one[:, i], two[:, j], of) <= size * most[i]
                i, j = i[passed], j[passed]
        return np.nonzero(ok) if i is None else (i, j)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the cell that may go on in the next batch
        for batch in itertools.chain(batches, [None]):
            if batch is None and held is None:
                return
            new = [] if batch is None else [pa.Table.from_batches([batch])]
            rows = pa.concat_tables([held, *new] if held is not None else new).combine_chunks()
            if not len(rows):
                continue
            changes = np.zeros(len(rows) - 1, dtype=bool)
            for key in ("control", "n", "p", "q"):
                changes |= pc.not_equal(rows[key][1:], rows[key][:-1]).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(changes) + 1, [len(rows)]])
            if batch is not None:
                held, starts = rows.slice(starts[-2]), starts[:-1]
            bits = np.stack([rows[f"w{no}"].to_numpy() for no in range(words)]).view(np.uint64)
            most, side = rows["most"].to_numpy(), rows["side"].to_numpy()
            texts, controls = rows["text"], rows["control"]
            lefts, rights, n = [], [], 0

            def out() -> pa.RecordBatch:
                i, j = np.concatenate(lefts), np.concatenate(rights)  # noqa: B023
                return pa.Table.from_arrays(  # noqa: B023
                    [controls.take(i), texts.take(i), texts.take(j), pa.array(most[i])], ["control", "a", "b", "most"]).combine_chunks().to_batches()[0]  # noqa: B023

            for start, end in itertools.pairwise(starts.tolist()):
                middle = start + int(np.searchsorted(side[start:end], 1))
                if middle in (start, end):
                    continue
                step = max(1, block // (end - middle))
                for at in range(start, middle, step):
                    to = min(at + step, middle)
                    i, j = (likely if likeliest else near)(bits[:, at:to], bits[:, middle:end], most[at:to])
                    if len(i):
                        lefts.append(i + at)
                        rights.append(j + middle)
                        n += len(i)
                    if n >= block:
                        yield out()
                        lefts, rights, n = [], [], 0
            if n:
                yield out()

    return run


def _tasks(df: DataFrame) -> int:
    """Tasks for few bytes with much work."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def _met(asking: DataFrame, lookup: DataFrame, sizes: DataFrame, likeliest: bool = False) -> DataFrame:
    """(control, a, b, d, longest) of the asked pairs that are at most ``most`` edits apart; ``likeliest``: of a few of them, found by their bits.

    Inputs: (control, a, few, n, most, x0 ...): a text asks for all partners of length n; (control, b, n, y0 ...), distinct; ``sizes``: (control, n, nb), lookup texts
    per length. The texts that ask for a length and its lookup texts are dealt over p x q cells. Few pairs meet in a join, the others in blocks.
    """
    tasks, side = _tasks(asking), math.isqrt(CELL_PAIRS)
    cells = asking.groupBy("control", "n", "few").agg(F.count(F.lit(1)).alias("na")).join(sizes, ["control", "n"])
    cells = cut_lineage(cells.select(
        "control", "n", (F.col("few") | (F.col("na") * F.col("nb") <= JOINED_PAIRS)).alias("joined"),
        F.ceil(F.col("na") / side).cast("int").alias("ps"), F.ceil(F.col("nb") / side).cast("int").alias("qs")))
    key = ["control", "n", "p", "q"]
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    one = lambda text, c: F.pmod(F.xxhash64(text), F.col(c)).cast("int")
    left = asking.drop("few").join(cells, ["control", "n"]).withColumn("p", one("a", "ps")).withColumn("q", every("qs")).drop("ps", "qs")
    right = lookup.join(cells, ["control", "n"]).withColumn("q", one("b", "qs")).withColumn("p", every("ps")).drop("ps", "qs")

    # few bytes, many pairs: the number of tasks is given, so that they are not put together by their size
    words = range(sum(BIT_WORDS.values()))
    rows = left.where("not joined").select(*key, F.lit(0).alias("side"), F.col("a").alias("text"), "most", *[F.col(f"x{no}").alias(f"w{no}") for no in words]).unionByName(
        right.where("not joined").select(*key, F.lit(1).alias("side"), F.col("b").alias("text"), F.lit(0).alias("most"), *[F.col(f"y{no}").alias(f"w{no}") for no in words]))
    met = rows.repartition(tasks, *key).sortWithinPartitions(*key, "side").mapInArrow(_cell_pairs(likeliest), "control string, a string, b string, most int")
    if not likeliest:
        small, of_small = left.where("joined").drop("joined").repartition(tasks, *key), right.where("joined").drop("joined").repartition(tasks, *key)
        met = met.unionByName(small.join(of_small, key).where(_may_be_near(F.col("most"))).select("control", "a", "b", "most"))
    longest = F.greatest(F.length("a"), F.length("b"))
    return met.select("control", "a", "b", F.expr("levenshtein(a, b, most)").alias("d"), longest.alias("longest")).where("d >= 0")


def _likely_pairs(texts: DataFrame, lookup: DataFrame, sizes: DataFrame) -> DataFrame:
    """As ``_near_pairs``, for each text only its likeliest partners of about its length: what is found bounds the search, nothing more."""
    most = F.floor((100 - F.col("pct")) * F.greatest(F.length("a"), F.col("n")) / 100).cast("int")
    off = F.abs(F.length("a") - F.col("n"))
    asking = texts.where(~F.col("few")).join(sizes, "control").withColumn("most", most).where((off <= LIKELY_EDITS) & (off <= F.col("most")) & (F.col("most") > 0))
    return _met(asking.drop("pct", "nb"), lookup, sizes, likeliest=True)


def _near_pairs(texts: DataFrame, lookup: DataFrame, sizes: DataFrame, done: int, edits: int) -> DataFrame:
    """(control, a, b, d, longest) of the pairs that may be a text's best, if any of more than ``done`` edits is possible at their lengths.

    Inputs: (control, a, pct, few, best, x0 ...), (control, b, n, y0 ...), distinct; ``sizes``: (control, n, nb), lookup texts per length. ``best``: d and longest of
    the partner a text has, or null: then only pairs of up to ``edits`` edits.
    """
    longest = F.greatest(F.length("a"), F.col("n"))
    cap = F.when(~F.col("few") & F.col("best").isNull(), edits)
    most = F.least(F.floor((100 - F.col("pct")) * longest / 100), F.floor(F.col("best.d") * longest / F.col("best.longest")), cap).cast("int")
    asking = texts.join(sizes, "control").withColumn("most", most).where((F.col("most") > done) & (F.abs(F.length("a") - F.col("n")) <= F.col("most")))
    return _met(asking.drop("pct", "best", "nb"), lookup, sizes)


def closest_texts(pairs: DataFrame, lookup: DataFrame) -> DataFrame:
    """(control, a, b, similarity): for each a the most similar b of its control, the least of equally similar ones.

    Inputs: (control, a, pct), (control, b, pct): ``pct`` is the least similarity in percent and a function of the control. Texts without such a partner give no
    row. Equal texts go first; then the likeliest partners, by their bits, give most texts one whose distance bounds the search: with a partner at d edits of L characters
    a text of m characters looks for partners of n characters at up to d * max(m, n) / L edits, none beyond is more similar, or as similar, and is done after one round. The
    others look up to 2, 8, 32 ... edits until they have found one. Texts of controls with few lookup texts take one round. A round is checkpointed. Pairs are compared by
    bits, in blocks, so a round's work grows with the texts still open times the lookup texts of the lengths they reach.
    """
    texts = pairs.where(F.length("a") > 0).select("control", "a", "pct").distinct()
    rows = cut_lineage(lookup.where(F.length("b") > 0).select("control", "b", F.length("b").alias("n")).distinct())
    sizes = cut_lineage(rows.groupBy("control", "n").agg(F.count(F.lit(1)).alias("nb")))
    held = sizes.groupBy("control").agg((F.sum("nb") <= FEW_TEXTS).alias("few"))
    exact = texts.join(rows.select("control", F.col("b").alias("a")), ["control", "a"], "left_semi")
    best = exact.select("control", "a", F.col("a").alias("b"), F.lit(0).alias("d"), F.length("a").alias("longest"))
    widest = _edits(F.length("a"), F.col("pct"))
    closer = lambda found: cut_lineage(keep_first(found, ["control", "a"], [F.col("d") / F.col("longest"), "b"]))
    known = lambda texts, found: texts.join(
        found.select("control", "a", F.struct("d", "longest").alias("best")), ["control", "a"], "left")
    open_ = texts.join(exact, ["control", "a"], "left_anti").join(held, "control").where(widest > 0)
    open_ = cut_lineage(_with_bits(open_.repartition(_tasks(texts), "control", "a"), "a", "x"))
    rows = cut_lineage(_with_bits(rows.join(held, "control").repartition(_tasks(texts), "control", "b"), "b", "y").drop("few"))
    found, done, edits = None, 0, FIRST_EDITS
    if not open_.where(~F.col("few")).isEmpty():
        found = closer(_likely_pairs(open_, rows, sizes))
    open_ = known(open_, found) if found is not None else open_.withColumn("best", F.lit(None).cast("struct<d: int, longest: int>"))
    open_ = cut_lineage(open_)
    while not open_.isEmpty():
        near = _near_pairs(open_, rows, sizes, done, edits)
        found = closer(near if found is None else found.unionByName(near))
        # the longest partner that could be as good has as many more characters as edits
        further = F.floor(F.col("best.d") * F.length("a") / (F.col("best.longest") - F.col("best.d")))
        left = known(open_.where(~F.col("few") & F.col("best").isNull() & (widest > edits)).drop("best"), found)
        open_ = cut_lineage(left.where(F.coalesce(further, widest) > edits))
        done, edits = edits, 4 * edits
    if found is not None:
        best = best.unionByName(found)
    return best.select("control", "a", "b", (1.0 - F.col("d") / F.col("longest").cast("double")).alias("similarity"))


def _pass_pairs(facts: DataFrame, p: MatchPass) -> DataFrame:
    """Distinct (control, a) of a pass, lower-cased; the missing marker takes part only where the pass says so."""
    pairs = facts.select(F.lower(p.control).alias("control"), F.lower(p.match).alias("a")).dropna().distinct()
    return pairs if p.keep_missing else pairs.where((F.col("control") != NAN) & (F.col("a") != NAN))


def _pass_lookup(lookup: DataFrame, p: MatchPass, values: Sequence[str]) -> DataFrame:
    return keep_first(
        lookup.select(F.lower(p.lookup_control).alias("control"), F.lower(p.lookup_match).alias("b"), *values).dropna(subset=["control", "b"]),
        ["control", "b"], list(values))


def _fuzzy_answers(facts: DataFrame, lookup: DataFrame, passes: Sequence[tuple[int, MatchPass]]) -> DataFrame:
    """Best partners of all fuzzy passes in one search: (number, control, a, b, similarity)."""
    own = lambda n: F.concat(F.lit(f"{n}|"), F.col("control")).alias("control")
    pairs = rows = None
    for n, p in passes:
        low = F.lit(min(p.thresholds)).alias("pct")
        some = _pass_pairs(facts, p).where(F.col("a") != NAN).select(own(n), "a", low)
        held = lookup.select(F.lower(p.lookup_control).alias("control"), F.lower(p.lookup_match).alias("b")).dropna().select(own(n), "b", low)
        pairs, rows = (some, held) if pairs is None else (pairs.unionByName(some), rows.unionByName(held))
    cut = F.instr("control", "|")
    return cut_lineage(closest_texts(cut_lineage(pairs), rows).select(
        F.substr("control", F.lit(1), cut - 1).cast("int").alias("number"), F.substr(F.col("control"), cut + 1).alias("control"), "a", "b", "similarity"))


def _equal_texts(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    return pairs.join(rows.select("control", F.col("b").alias("a")), ["control", "a"], "left_semi").select(
        "control", "a", F.col("a").alias("b"), F.lit(1.0).alias("similarity")
    )


def _hits(facts: DataFrame, lookup: DataFrame, p: MatchPass, values: Sequence[str], number: int, fuzzy: DataFrame | None) -> DataFrame:
    """Distinct pairs of one pass with the winning lookup row: c{number}, a{number}, provenance and values."""
    rows = _pass_lookup(lookup, p, values)
    low = min(p.thresholds)
    label = f"mt={p.control}|{p.match}"
    if low == 100:
        best, code, kind = _equal_texts(_pass_pairs(facts, p), rows), F.lit(1), F.lit(label)
    else:
        best = fuzzy.where(F.col("number") == number).drop("number")
        if p.keep_missing:
            best = best.unionByName(_equal_texts(_pass_pairs(facts, p).where(F.col("a") == NAN), rows))
        step = F.lit(f"{low / 100:.1f}")
        for t in sorted(p.thresholds):
            step = F.when(F.round(F.col("similarity") * 100, 6) >= t, F.lit(f"{t / 100:.1f}")).otherwise(step)
        code = F.lit(2)
        kind = F.concat(F.lit(f"{label}:th="), step, F.lit(":lv="), F.format_number("similarity", 2))
    return best.join(rows, ["control", "b"]).select(
        F.col("control").alias(f"c{number}"), F.col("a").alias(f"a{number}"),
        F.struct(code.alias("is_matched"), kind.alias("matched_type"), *values).alias(f"hit{number}"),
    )


def match_cascade(facts: DataFrame, lookup: DataFrame, passes: Sequence[MatchPass], values: Sequence[str]) -> DataFrame:
    """Facts plus ``is_matched`` (0 none, 1 exact, 2 fuzzy), ``matched_type`` (pass, threshold, similarity) and values.

    The winner of a fuzzy pass is the most similar text, then the smallest text. All fuzzy passes share the rounds of one search.
    """
    loose = [(n, p) for n, p in enumerate(passes) if min(p.thresholds) < 100]
    fuzzy = _fuzzy_answers(facts, lookup, loose) if loose else None
    out = facts
    for number, p in enumerate(passes):
        best = _hits(facts, lookup, p, values, number, fuzzy)
        cond = (F.lower(p.control) == F.col(f"c{number}")) & (F.lower(p.match) == F.col(f"a{number}"))
        out = out.join(best, cond, "left")
    hit = F.coalesce(*[F.col(f"hit{n}") for n in range(len(passes))])
    return out.select(
        *facts.columns, F.coalesce(hit["is_matched"], F.lit(0)).alias("is_matched"),
        hit["matched_type"].alias("matched_type"), *[hit[v].alias(v) for v in values],
    )


def match_cleaned(facts: DataFrame, margins: DataFrame, text: str, values: Sequence[str]) -> DataFrame:
    """Distance-0 matching of descriptions after cleaning: an equi-join on the cleaned text."""
    def clean(c: str) -> Column:
        return F.regexp_replace(F.lower(F.trim(c)), r"[^0-9a-z]+", " ")

    rows = keep_first(margins.select(clean(text).alias("__t"), *values), ["__t"], list(values))
    return facts.withColumn("__t", clean(text)).join(rows, "__t", "left").drop("__t")


def inherit_from_parent(result: DataFrame, items: DataFrame, sku: str, parent_sku: str, values: Sequence[str]) -> DataFrame:
    """Local SKUs absent from the result take the values of their manufacturer SKU, marked ``mt=child``."""
    absent = items.select(sku, parent_sku).distinct().join(result.select(sku), sku, "left_anti")
    parent = result.select(F.col(sku).alias(parent_sku), *values)
    return absent.join(parent, parent_sku).select(sku, *values, F.lit("mt=child").alias("matched_type"))


def append_manual(result: DataFrame, manual: DataFrame, sku: str, values: Sequence[str]) -> DataFrame:
    """Rows of a manual sheet whose SKU is not in the result, marked ``mt=manual``."""
    extra = manual.select(sku, *values).join(result.select(sku), sku, "left_anti").withColumn(
        "matched_type", F.lit("mt=manual")
    )
    return result.select(sku, *values, "matched_type").unionByName(extra)


def vendor_fallback(df: DataFrame, master: str, internal: str, into: str) -> DataFrame:
    """Master name unless missing, else the internal one, and a 0/1 flag that tells which."""
    use = F.col(master).isNotNull() & (F.lower(master) != NAN)
    return df.withColumn(into, F.when(use, F.col(master)).otherwise(F.col(internal))).withColumn(
        f"{into}_is_internal", F.when(use, 0).otherwise(1)
    )
