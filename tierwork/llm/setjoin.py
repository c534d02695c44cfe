"""N-gram Jaccard join: size-aware, light sets by fixed-size subsets, heavy sets by inverted lists.

Two sets with a and b shingles link when ``num / den`` of their union is common, that is when they share at least
``ceil(num * (a + b) / (num + den))`` shingles.

* Light sets (up to a size that the cost model picks) post every subset of each size that an overlap with a partner needs. Two light sets
  that link share one of these subsets; sets that share one are candidates.
* Heavy sets, and light ones that could link with heavy ones, post the shingles of their prefix: in one order of all shingles, rare ones first,
  the first ``n - ceil(n * num / den) + 1``. Sets that link share a prefix shingle. Candidates come from scanning these lists.

Equal sets are one class, named by 64 bits (two different sets share a name with probability 2**-64). Lists are scanned star-wise: every member is compared with one anchor of its list, links are joined to
components, and only lists that still hold several components are looked at again. There all members outside the main component are compared with all
members: pair by pair in short lists; in long lists first with those of nearest counters, then, where that was not all, with every
member, in cells of bounded size that give back only what spans the linked sets. Before texts are compared, counters of shingles by hash rule out pairs
that differ by too many (never a pair that links). So groups of near copies give links in proportion to their size, and no link between
different components is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.llm.frames import block_rows, discard, may_be_among, may_contain, own_name, settled, stored, sum_blocks
from tierwork.llm.graph import components, packed, spanning
from tierwork.llm.words import mix, shingle_sets

BITS, WIDTH = 21, 4096  # counters of the shingle sketch: fixed, so are its sum and its broadcast
SIZES = 4096  # set sizes counted for the cost model
MOST_LIGHT = 32  # sizes the cost model may call light
STAR_ROUNDS = 2
COUNTERS = 64  # per set, of its shingles by hash: two sets differ by at least as many shingles as their counters differ
NEAREST = 2  # candidates with the nearest counters that a set gives per cell of a long list
FEW = 32  # members up to which a list's last pairs are compared pair by pair; longer lists meet in cells
BLOCK, SETS = 1 << 20, 1024  # about so many shingles, and sets, on one side of a cell
POSTED = 1 << 16  # classes that a task remembers to have posted
_SKETCH_BLOCKS = (1 << BITS) // WIDTH


def overlap(a: int, b: int, num: int, den: int) -> int:
    return -(-num * (a + b) // (num + den))


def subset_sizes(n: int, num: int, den: int) -> list[int]:
    """Sizes of the subsets a light set of size n posts: the overlaps its possible partners need."""
    return sorted({overlap(n, m, num, den) for m in range(max(1, -(-n * num // den)), n * den // num + 1)})


def subset_count(n: int, num: int, den: int) -> int:
    return sum(math.comb(n, s) for s in subset_sizes(n, num, den) if s <= n)


def prefix_size(n: int, num: int, den: int) -> int:
    return n - -(-n * num // den) + 1


def light_bound(sizes: np.ndarray, list_length: float, num: int, den: int) -> int:
    """Largest light size: the one with the least cost, counting rows posted and, for lists, the members met in a scan."""
    rows = np.asarray(sizes, dtype=float)
    heavy = np.array([0.0] + [prefix_size(n, num, den) * (1 + list_length) for n in range(1, len(rows))])
    best, least = 0, float((rows * heavy).sum())
    light = 0.0
    for x in range(1, min(MOST_LIGHT, len(rows) - 1) + 1):
        light += rows[x] * subset_count(x, num, den)
        both = -(-(x + 1) * num // den)
        cost = light + float((rows[both:] * heavy[both:]).sum())
        if cost < least:
            best, least = x, cost
    return best


def subset_keys(items: np.ndarray, num: int, den: int) -> np.ndarray:
    """One key per subset: the sum of its mixed members, by leaving members out."""
    n, parts = len(items), mix(items ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    whole, out = parts.sum(dtype=np.uint64), []
    for s in subset_sizes(n, num, den):
        if s > n:
            continue
        if s == n:
            sums = np.array([whole])
        else:
            left = np.array(list(combinations(range(n), n - s)))
            sums = whole - parts[left].sum(axis=1, dtype=np.uint64)
        out.append(mix(sums + np.uint64(s * 0x9E3779B97F4A7C15 % 2**64)))
    return np.concatenate(out)


def _sketch(texts: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents per shingle counter, sets per size), over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sizes = np.zeros(1 << BITS, dtype=np.int64), np.zeros(SIZES, dtype=np.int64)
        held, n = [], 0
        for b in batches:
            for _, items in shingle_sets(b.column(0), k):
                sizes[min(len(items), SIZES - 1)] += 1
                held.append(items)
                n += len(items)
                if n >= 1 << 20:
                    counts += np.bincount(np.concatenate(held) >> np.uint64(64 - BITS), minlength=1 << BITS)
                    held, n = [], 0
        if held:
            counts += np.bincount(np.concatenate(held) >> np.uint64(64 - BITS), minlength=1 << BITS)
        yield block_rows(np.concatenate((counts, sizes)), WIDTH)

    total = sum_blocks(texts.mapInArrow(run, "block int, data binary"), (1 << BITS) + SIZES, WIDTH)
    return total[: 1 << BITS], total[1 << BITS:]


def _signatures(rows: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(id, th, n, cls, few, hist, posts) per row: size, a 64-bit name of the set (null for an empty one), 8 and 64 counters, and the keys it posts
    (none where the task has posted the same set before)."""
    counts, sizes = _sketch(rows.select("text"), k)
    levels = np.minimum(255, 2 * np.log2(1 + counts)).astype(np.uint8)
    usual = counts.sum() / len(counts)
    by_count = np.sort(counts[counts > 0])
    rare = by_count[np.searchsorted(np.cumsum(by_count), 0.1 * counts.sum())] if len(by_count) else 0
    bound = light_bound(sizes, 1 + rare / max(1.0, usual), num, den)
    shared = rows.sparkSession.sparkContext.broadcast(levels.tobytes())  # 2**BITS bytes
    both = -(-(bound + 1) * num // den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = np.frombuffer(shared.value, dtype=np.uint8), set()
        for b in batches:
            n, cls, few, hist, posts = [], [], [], [], []
            for _, items in shingle_sets(b.column(2), k):
                n.append(len(items))
                if not len(items):
                    cls.append(None)
                    few.append(None)
                    hist.append(None)
                    posts.append(np.zeros(0, dtype=np.uint64))
                    continue
                cls.append(int(mix(mix(items).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(items))).view(np.int64)[0]))
                counters = np.bincount(mix(items) >> np.uint64(58), minlength=COUNTERS)
                hist.append(np.minimum(counters, 32767).astype(np.int16).tobytes())
                few.append(int(np.minimum(counters.reshape(8, -1).sum(axis=1), 127).astype(np.uint8).view(np.int64)[0]))
                if cls[-1] in seen:
                    posts.append(np.zeros(0, dtype=np.uint64))
                    continue
                if len(seen) < POSTED:
                    seen.add(cls[-1])
                keys = []
                if len(items) <= bound:
                    keys.append(subset_keys(items, num, den))
                if len(items) >= both:
                    upto = prefix_size(len(items), num, den)
                    # level, then the hash itself, which orders shingles of a level at random
                    order = (level[items >> np.uint64(64 - BITS)].astype(np.uint64) << np.uint64(56)) | (mix(items) >> np.uint64(8))
                    keys.append(items[np.argpartition(order, upto - 1)[:upto]] if upto < len(items) else items)
                posts.append(np.concatenate(keys))
            ends = np.cumsum([0, *map(len, posts)])
            values = pa.array(np.concatenate(posts).view(np.int64)) if posts else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(few, pa.int64()), pa.array(hist, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                ["id", "th", "n", "cls", "few", "hist", "posts"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "th", "text").mapInArrow(run, f"id {kind}, th long, n long, cls long, few long, hist binary, posts array<long>")


def _shared_keys(posted: DataFrame) -> DataFrame:
    """(elem, cls) of ``posted``, each once, whose elem several classes post: dealt by elem once and read in order, so of a list only its last row is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        elem, cls, met = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), False  # the last row, and whether one before it has its elem
        for b in batches:
            elem, cls = np.concatenate((elem, b.column(0).to_numpy())), np.concatenate((cls, b.column(1).to_numpy()))
            if not len(elem):
                continue
            first = np.ones(len(elem), dtype=bool)
            first[1:] = (elem[1:] != elem[:-1]) | (cls[1:] != cls[:-1])
            elem, cls = elem[first], cls[first]
            same = elem[1:] == elem[:-1]
            keep = np.append(same, False)
            keep[1:] |= same
            keep[0] |= met
            met = bool(keep[-1])
            yield pa.RecordBatch.from_arrays([pa.array(elem[:-1][keep[:-1]]), pa.array(cls[:-1][keep[:-1]])], ["elem", "cls"])
            elem, cls = elem[-1:], cls[-1:]
        if met:
            yield pa.RecordBatch.from_arrays([pa.array(elem), pa.array(cls)], ["elem", "cls"])

    return posted.select("elem", "cls").repartition("elem").sortWithinPartitions("elem", "cls").mapInArrow(run, "elem long, cls long")


def _most_apart(a, b, num: int, den: int):
    """Shingles by which two sets that link can differ at most."""
    return a + b - 2 * -(-num * (a + b) // (num + den))


def _apart(one: pa.Array, two: pa.Array) -> np.ndarray:
    grid = lambda x: np.frombuffer(b"".join(x.to_pylist()), dtype=np.int16).reshape(-1, COUNTERS).astype(np.int32)
    return np.abs(grid(one) - grid(two)).sum(axis=1)


def _possible(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (cls, b, and further columns) that their counters let link."""
    one = classes.select("cls", F.col("n").alias("n1"), F.col("hist").alias("h1"))
    two = classes.select(F.col("cls").alias("b"), F.col("n").alias("n2"), F.col("hist").alias("h2"))
    met, names = pairs.join(one, "cls").join(two, "b"), pairs.columns
    met = met.select(*names, "n1", "n2", "h1", "h2")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in met.schema.fields[: len(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = dict(zip(b.schema.names, b.columns))
            n1, n2 = of["n1"].to_numpy(), of["n2"].to_numpy()
            keep = _apart(of["h1"], of["h2"]) <= _most_apart(n1, n2, num, den) if len(b) else np.zeros(0, dtype=bool)
            yield b.select(names).filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(run, kinds)


def _verify(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets link, by their shingles."""
    met = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b").select("b", "a", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one = {}
            keep = np.zeros(len(b), dtype=bool)
            keys, anchor = b.column(0).to_pylist(), None
            for (row, x), i in zip(shingle_sets(b.column(2), k), range(len(b))):
                if keys[i] != anchor:
                    anchor, one = keys[i], next(s for _, s in shingle_sets(b.column(3).slice(i, 1), k))
                common = len(x) + len(one) - len(np.union1d(x, one))
                keep[row] = common >= overlap(len(x), len(one), num, den)
            yield pa.RecordBatch.from_arrays([b.column(1).filter(pa.array(keep)), b.column(0).filter(pa.array(keep))], ["a", "b"])

    return met.sortWithinPartitions("b").mapInArrow(run, "a long, b long")


def _links_between(left: list[np.ndarray], right: list[np.ndarray], num: int, den: int, columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """(left place, right place) of the sets that link: overlaps by products of incidence matrices, some shingles at a time."""
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    both = np.concatenate([*left, *right])
    _, at, times = np.unique(both, return_inverse=True, return_counts=True)
    seen = np.flatnonzero(times > 1)  # shingles of one set only are in no overlap
    number = np.full(len(times), -1)
    number[seen] = np.arange(len(seen))
    at = number[at]
    row = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    row, at = row[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    for first in range(0, len(seen), columns):
        part = slice(*np.searchsorted(at, (first, first + columns)))
        grid = np.zeros((len(left) + len(right), columns), dtype=np.float32)
        grid[row[part], at[part] - first] = 1
        common += grid[: len(left)] @ grid[len(left):].T
    return np.nonzero((num + den) * common.astype(np.int64) >= num * (sizes[0][:, None] + sizes[1][None, :]))


def _dealt(members: DataFrame, outside, of: DataFrame, columns: list[str]):
    """Both sides of long lists dealt to cells (elem, i, j) of bounded size: members outside the main component, and all members."""
    blocks = lambda size, sets: F.greatest(F.lit(1), F.ceil(size / BLOCK), F.ceil(sets / SETS)).cast("int")
    sized = members.withColumn("na", blocks(F.col("size") - F.col("main_size"), F.col("met") - F.col("main_met"))).withColumn(
        "nb", blocks(F.col("size"), F.col("met")))
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = sized.where(outside).select("elem", "cls", "root", F.pmod(F.xxhash64("cls"), F.col("na")).cast("int").alias("i"), span("nb").alias("j"))
    right = sized.select("elem", "cls", "root", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int").alias("j"), span("na").alias("i"))
    full = lambda side: side.join(of, "cls").select(*[F.col(c).alias(c) for c in ("elem", "i", "j", "cls", "root", *columns)])
    keys = ("elem", "i", "j")
    return full(left).groupBy(*keys).cogroup(full(right).groupBy(*keys))


def _nearest(members: DataFrame, outside, classes: DataFrame, num: int, den: int) -> DataFrame:
    """(cls, b, more): for members outside the main component of a long list the sets of other components that their counters let link, nearest
    first, ``NEAREST`` per cell; ``more``: the cell has further ones."""
    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        grid = lambda t: np.frombuffer(b"".join(t["hist"].to_pylist()), dtype=np.int16).reshape(-1, COUNTERS).astype(np.int32)
        (g1, g2), (c1, c2), (r1, r2), (n1, n2) = ((f(one), f(two)) for f in (
            grid, lambda t: t["cls"].to_numpy(), lambda t: t["root"].to_numpy(), lambda t: t["n"].to_numpy()))
        out: list[list] = [[], [], []]
        for x in range(len(g1)):
            apart = np.abs(g2 - g1[x]).sum(axis=1)
            of = np.flatnonzero((apart <= _most_apart(n1[x], n2, num, den)) & (r2 != r1[x]))
            for y in of[np.argsort(apart[of], kind="stable")[:NEAREST]]:
                for column, v in zip(out, (c1[x], c2[y], len(of) > NEAREST)):
                    column.append(v)
        return pa.table({"cls": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64()), "more": pa.array(out[2], pa.bool_())})

    return _dealt(members, outside, classes.select("cls", "n", "hist"), ["n", "hist"]).applyInArrow(compare, "cls long, b long, more boolean")


def _compare_lists(members: DataFrame, outside, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links of long lists, as few as keep what is linked together: members outside the main component against all members of the list.

    Both sides are dealt to blocks of about ``BLOCK`` shingles or ``SETS`` sets, so a list of any length meets in cells of bounded size, and no pairs leave a cell.
    """
    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        names = [t["cls"].to_numpy() for t in (one, two)]
        sets = [[x for chunk in t["text"].chunks for _, x in shingle_sets(chunk, k)] for t in (one, two)]
        if not sets[0] or not sets[1]:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        row, col = _links_between(*sets, num, den)
        both, at = np.unique(np.concatenate(names), return_inverse=True)
        low = spanning(at[row], at[len(names[0]) + col], len(both))
        far = np.flatnonzero(low != np.arange(len(both)))
        return pa.table({"a": both[low[far]], "b": both[far]})

    return _dealt(members, outside, texts, ["text"]).applyInArrow(compare, "a long, b long")


def _texts_of(rows: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, text) of the wanted classes: their texts are picked out while the documents are read, before anything is shuffled."""
    wanted = stored(classes.join(wanted.select("cls").distinct(), "cls").select("cls", F.col("of.id").alias("wid"), F.col("of.th").alias("wth")), "setjoin-wanted")
    met = may_contain(rows, "th", wanted.select("wth")).alias("r").join(wanted.alias("w"), (F.col("r.th") == F.col("w.wth")) & F.col("r.id").eqNullSafe(F.col("w.wid")))
    texts = stored(met.groupBy("cls").agg(F.first("text").alias("text")), "setjoin-texts")
    discard(wanted)
    return texts


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 80, den: int = 100,
) -> DataFrame:
    """Per row: id, n_shingles, component_id (least id of the rows linked to it, directly or over others, its own included), set_id, text_key.

    Words are lower-cased (A-Z only). A text with fewer words than a shingle is one shingle; null texts and texts without words have none and link with
    nothing. Repeated rows and equal texts are linked like any equal sets; rows with equal ids keep their own rows. Rows with a null id take part; their
    component is the least id that is not null, or null. Empty tables give no rows; other columns are ignored.
    ``set_id`` names the component also where ids are null or repeated (null for rows that link with nothing by having no words);
    ``text_key`` is a 64-bit hash of the text.

    Each stored table is deleted after its last use, the files of a shuffle after the action: disk holds one step at a time, and only the result stays.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    signed = stored(_signatures(rows, shingle, num, den), "setjoin-signatures")
    classes = stored(signed.where("n > 0").groupBy("cls").agg(
        F.min("n").alias("n"), F.min(F.struct("id", "th")).alias("of"), F.min("id").alias("least_id"), F.min("few").alias("few"), F.min("hist").alias("hist")), "setjoin-classes")
    shared = stored(_shared_keys(signed.select("cls", F.explode("posts").alias("elem"))), "setjoin-keys")
    sets = stored(signed.select("id", "th", "n", "cls"), "setjoin-sets")
    discard(signed)
    members = stored(shared.join(classes.select("cls", "n", "few"), "cls"), "setjoin-lists")
    discard(shared)

    def near(m, n, x, y):
        """Sizes that can link, and eight counters (a byte each, 127 at most) that do not already differ too much."""
        byte = lambda c, i: F.shiftright(c, 8 * i).bitwiseAND(F.lit(127))
        apart = reduce(lambda a, b: a + b, [F.abs(byte(x, i) - byte(y, i)) for i in range(8)])
        most = m + n - 2 * F.ceil(num * (m + n) / F.lit(num + den))
        return (F.greatest(m, n) * num <= F.least(m, n) * den) & (apart <= most)


    def still_open(roots: DataFrame) -> DataFrame:
        """Members of lists that hold several components, with their component and the most frequent one of their list."""
        placed = members.join(roots.withColumnRenamed("key", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        per = placed.groupBy("elem", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("size"))
        lists = per.groupBy("elem").agg(
            F.max(F.struct("c", "root", "size")).alias("x"), F.sum("c").alias("met"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
        return stored(placed.join(lists.select("elem", F.col("x.root").alias("main"), F.col("x.size").alias("main_size"), F.col("x.c").alias("main_met"), "met", "size"), "elem"), "setjoin-open")

    tried: list[DataFrame] = []
    links: list[DataFrame] = []

    def verify(pairs: DataFrame) -> None:
        """Pairs (cls, b), each once and not tried before, to links."""
        pairs = pairs.select(F.least("cls", "b").alias("a"), F.greatest("cls", "b").alias("b")).distinct()
        for done in tried:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = settled(pairs)
        pairs = packed(pairs, pairs.count())
        texts = _texts_of(rows, classes, pairs.select(F.col("a").alias("cls")).union(pairs.select("b")))
        tried.append(pairs)
        found = settled(_verify(pairs, texts, shingle, num, den))
        discard(texts)
        links.append(packed(found, found.count()))

    all_links = lambda: reduce(DataFrame.union, links)
    open_lists, last = members.withColumn("root", F.col("cls")), None
    for turn in range(STAR_ROUNDS):
        drawn = F.min(F.struct(F.xxhash64(F.lit(turn), "root", "cls").alias("draw"), F.col("cls").alias("b"), F.col("n").alias("bn"), F.col("few").alias("bfew"), F.col("root").alias("broot")))
        anchors = open_lists.groupBy("elem").agg(drawn.alias("x")).select("elem", "x.*")
        found = open_lists.join(anchors, "elem").where((F.col("root") != F.col("broot")) & near(F.col("n"), F.col("bn"), F.col("few"), F.col("bfew")))
        found = found.groupBy("cls", "b").agg(F.count(F.lit(1)).alias("met"))
        # of the anchors that a set meets and could link with, the one met in most lists
        best = _possible(found, classes, num, den).groupBy("cls").agg(F.max(F.struct("met", "b")).alias("x"))
        verify(best.select("cls", F.col("x.b").alias("b")))
        if last is not None:
            discard(last)
        open_lists = last = still_open(components(all_links()))
    # what is left: pairs of different components, one of them outside the main component of a list
    outside = F.col("root") != F.col("main")
    one, two = open_lists.where(outside & (F.col("met") <= FEW)).alias("o"), open_lists.where(F.col("met") <= FEW).alias("t")
    pairs = one.join(two, (F.col("o.elem") == F.col("t.elem")) & (F.col("o.root") != F.col("t.root")) & near(F.col("o.n"), F.col("t.n"), F.col("o.few"), F.col("t.few")))
    pairs = pairs.select(F.least("o.cls", "t.cls").alias("cls"), F.greatest("o.cls", "t.cls").alias("b")).distinct()
    nearest = settled(_nearest(open_lists.where(F.col("met") > FEW), outside, classes, num, den))
    verify(_possible(pairs, classes, num, den).union(nearest.select("cls", "b")))
    # sets of long lists with further candidates: against all members of their lists, if still outside. Where another component has become the main one,
    # such a set may be inside it now, and its partner in what was the main component before, which asked nothing: so these ask as well
    mains = lambda name: open_lists.where(F.col("met") > FEW).groupBy("elem").agg(F.first("main").alias(name))
    before = settled(mains("was"))
    discard(open_lists)
    roots = components(all_links())
    open_lists = still_open(roots)
    discard(members)
    wide = nearest.where("more").select("cls").distinct().withColumn("wide", F.lit(True))
    now = roots.select(F.col("key").alias("was"), F.col("root").alias("now"))
    moved = before.join(mains("main"), "elem").join(now, "was", "left").select("elem", "main", F.coalesce("now", "was").alias("was")).where("was <> main").drop("main")
    asked = open_lists.where(F.col("met") > FEW).join(wide, "cls", "left").join(settled(moved), "elem", "left").withColumn("wide", F.coalesce("wide", F.lit(False)))
    asked = asked.withColumn("asks", outside & (F.col("wide") | F.coalesce(F.col("root") == F.col("was"), F.lit(False))))
    held = asked.groupBy("elem").agg(F.max("wide").alias("wide"), F.max("asks").alias("asks")).where("wide AND asks").select("elem")
    asked = settled(asked.join(held, "elem", "left_semi"))
    discard(open_lists)
    texts = _texts_of(rows, classes, asked)
    links.append(settled(_compare_lists(asked, F.col("asks"), texts, shingle, num, den)))
    discard(texts)
    links = all_links()
    roots = components(links)
    placed = classes.select("cls", "least_id").join(roots.withColumnRenamed("key", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = settled(placed.join(least, "root").select("cls", "root", "component_id"))
    out = sets.join(named, "cls", "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")))
    kept = stored(out.select("id", "n", "component_id", "root", "th"), "setjoin-components")
    discard(classes, sets)
    out = kept.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("root").alias("set_id"), F.col("th").alias("text_key"))
    out._stored_at = kept._stored_at
    return out


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` (all columns) with one row of each component: that with the least id (null last), then the least hash of its text.

    Rows that repeat id and text are one document and stay once if chosen, whatever their other columns say. Null texts and texts without words link with
    nothing and all stay.
    """
    key, th = own_name(docs, "_key"), own_name(docs, "_th")
    worded = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    named = jaccard_components(docs.where(worded), id_col, text_col, **how)
    found = named.select(F.col(id_col).alias("id"), F.col("text_key").alias("th"), "set_id")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("x")
    chosen = found.groupBy("set_id").agg(least).select(F.col("x.id").alias("id"), F.col("x.th").alias("th"))
    times = found.groupBy("id", "th").agg(F.count(F.lit(1)).alias("times")).alias("f")
    once = chosen.withColumn("chosen", F.lit(True)).alias("c")
    doubtful = times.join(once, F.col("f.id").eqNullSafe(F.col("c.id")) & (F.col("f.th") == F.col("c.th")), "left").where("chosen IS NULL OR times > 1")
    doubtful = settled(doubtful.select(F.xxhash64("f.id", "f.th").alias("key")))
    chosen = stored(chosen, "setjoin-chosen")
    discard(named)
    mine = docs.where(worded).withColumn(th, F.xxhash64(text_col))
    mine = mine.withColumn(key, may_be_among(F.xxhash64(id_col, th), doubtful))
    # rows that surely stay are not shuffled: only those whose key may be another set's choice, or a repeated one, meet the choice
    met = mine.where(F.col(key)).alias("m").join(chosen.alias("c"), (F.col(f"m.{th}") == F.col("c.th")) & F.col(f"m.`{id_col}`").eqNullSafe(F.col("c.id"))).select("m.*")
    kept = mine.where(~F.col(key)).unionByName(met.dropDuplicates([th, id_col]))
    return kept.drop(th, key).unionByName(docs.where(~worded))
