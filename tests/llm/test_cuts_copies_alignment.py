"""Fill-in-middle, exact dedup against a history, token alignment: odd rows, brute force, and the structures they use."""

import collections
import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_operators import SCHEMA, doc_rows
from tierwork.llm import align, fim, perfect_hash
from tierwork.llm.queries import QUERIES

ROOT = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  two  blanks ", "a\tb\r\nc\n\n\nd", "<|endoftext|> plain <s> </s>", "é😀漢字かな", "▁ low line", "x" * 3000, "don't we'll I'd", "é ‍ ﻿", "\x00\x01"]


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, 1, 2, 3, 4, 5) for r in doc_rows()], SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# 11 fill-in-middle

def cut(i, t, percent=90, seed=1):
    h = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    t = t or ""
    n = len(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(x in t for x in fim.SENTINELS) or h3 % 100 >= percent:
        return n, "plain", None, None, t
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return n, "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


def test_cuts_of_odd_rows(docs, none):
    got = sorted(map(tuple, fim.fill_in_middle(docs).collect()), key=str)
    assert got == sorted(((r[0], *cut(r[0], r[1])) for r in doc_rows()), key=str)
    assert fim.fill_in_middle(none).count() == 0


def test_cuts_of_many_scripts_and_restoring(spark):
    r = random.Random(5)
    bits = ["plain words ", "é", "😀", "漢字かな交じり文", "<", "P>", "<P", "S", ">", "\n", "ß" * 40, "a" * 300, "😀" * 300, "\x00"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.choice([0, 1, 3, 40, 900])))) for i in range(300)]
    rows.append((1000, "漢a" * (fim.BLOCK // 3)))  # longer than a block, characters of several bytes over its end
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (0, 90, 100):
        made = fim.fill_in_middle(df, percent=percent, seed=9).withColumn("back", fim.restored(F.col("output"), F.col("form")))
        got = {x.doc_id: x for x in made.collect()}
        for i, t in rows:
            assert tuple(got[i])[1:6] == cut(i, t, percent, 9) and got[i].back == t


def test_rank_index_is_exact_and_its_segments_keep_the_bound():
    g = np.random.default_rng(3)
    for steps in (np.ones(100_000), g.integers(1, 5, 100_000), np.repeat(g.integers(1, 5, 50), 2000), np.array([]), np.array([4]), np.where(g.random(100_000) < 0.02, 2, 1)):
        at = np.cumsum(np.append(0, steps)).astype(np.int64)
        index = fim.RankIndex()
        for part in np.array_split(at, 3):
            index.add(part)
        index.done()
        ranks = np.arange(len(at))
        assert (index.offsets(ranks) == at).all() and abs(index.predict(ranks) - at).max() <= fim.BOUND + 1
        assert index.residual.dtype == np.int8 and len(index.first) <= 3 + len(at) / fim.BOUND * 4
    assert len(fim.index_texts(np.full(1 << 19, 97, dtype=np.uint8), np.array([0, 1 << 19]))[0].first) == 2  # one line for plain letters, and the end


# 12 exact dedup

def groups(rows):
    """{(id, text): (keep id, size)}; null ids are least."""
    of = collections.defaultdict(list)
    for i, t in rows:
        of[t or ""].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in of.items()}


@pytest.mark.parametrize("old", ["true", "false", "cast(null as boolean)", "doc_id % 2 = 0", "doc_id > 4"])
def test_equal_texts_of_odd_rows(docs, old):
    rows = [(r[0], r[1]) for r in doc_rows()]
    want = groups(rows)
    got = perfect_hash.exact_dedup(docs, F.expr(old)).collect()
    texts = {sha(t): t for t in want}
    assert len(got) == len(rows) and all((r.keep_id, r.group_size) == want[texts[r.text_sha256]] for r in got)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len(want) and all(r.doc_id == r.keep_id for r in kept)


def test_equal_texts_of_an_empty_table(none):
    assert perfect_hash.exact_dedup(none, F.lit(True)).count() == 0 and perfect_hash.exact_dedup(none, F.lit(False)).count() == 0


def test_a_text_that_a_third_of_all_rows_have_in_several_shards(spark, monkeypatch):
    monkeypatch.setattr(perfect_hash, "SHARD_DIGESTS", 64)
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "often").otherwise(F.concat(F.lit("t"), F.col("id") % 1700)).alias("text"))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = groups(rows)
    text = dict(rows)
    for old in (F.col("doc_id") % 2 == 0, F.col("doc_id") < 300):
        got = perfect_hash.exact_dedup(df, old).collect()
        assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {i: want[t] for i, t in rows}
        assert sorted(r.doc_id for r in got if r.kept) == sorted(k for k, _ in want.values())
    flag = {r.doc_id: r.known for r in got}
    seen = {t for i, t in rows if i < 300}
    assert all(flag[i] == (text[i] in seen) for i in flag)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 3000])
def test_perfect_hash_takes_every_slot_once_and_refuses_strangers(n):
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(2 * n)), dtype=np.uint8).reshape(-1, 32)
    mine, strangers = digests[:n], digests[n:]
    seeds, slot = perfect_hash.perfect_hash(mine)
    assert sorted(slot) == list(range(n))
    held = mine[np.argsort(slot)]
    assert (perfect_hash.find(mine, seeds, held) == slot).all() and (perfect_hash.find(strangers, seeds, held) == -1).all()
    if n:
        near = mine.copy()
        near[:, 0] ^= 1  # leads to the same slot; only the check of the bytes tells
        assert (perfect_hash.find(near, seeds, held) == -1).all()


# 13 alignment

def aligned(rows):
    """Brute force: {id: (n_a, n_b, n_groups, n_links, n_best, count_sum, digest)}."""
    a_model, b_model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    with open(A) as f:
        vocab = {i: p for p, i in json.load(f)["model"]["vocab"].items()}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    a_bytes = lambda i: bytes(byte_of[c] for c in vocab[i])
    b_bytes = lambda i: bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
    made, count = {}, collections.Counter()
    for i, t in rows:
        a, b, links, said = [], [], [], ""
        if t:
            a, b = a_model.encode(" " + t, add_special_tokens=False).ids, b_model.encode(t)
            if not b"".join(map(a_bytes, a)) == b"".join(map(b_bytes, b)) == (" " + t).encode():
                a, b = [], []
        if a:
            ends, at = ({}, {}), [0, 0]
            for side, (ids, size) in enumerate(((a, a_bytes), (b, b_bytes))):
                for k, x in enumerate(ids):
                    at[side] += len(size(x))
                    ends[side][at[side]] = k
            done, out = [0, 0], []
            for e in sorted(ends[0].keys() & ends[1].keys()):
                x, y = ends[0][e], ends[1][e]
                links.append((a[x], b[y]))
                out.append(",".join(map(str, a[done[0]:x + 1])) + "|" + ",".join(map(str, b[done[1]:y + 1])))
                done = [x + 1, y + 1]
            said = sha(";".join(out))
        count.update(links)
        made[i] = (len(a), len(b), links, said)
    best = collections.Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return {i: (n_a, n_b, len(ls), len(ls), sum(count[x] == best[x[1]] for x in ls), sum(count[x] for x in ls), said) for i, (n_a, n_b, ls, said) in made.items()}


def answers(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


def test_token_alignment_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()]
    assert answers(QUERIES["op13_token_alignment"](spark, ROOT)) == aligned(rows)


@pytest.mark.parametrize("head", [0, 5, 1 << 18])
def test_alignment_of_odd_texts_whatever_pairs_are_sent_to_all_tasks(spark, head):
    r = random.Random(1)
    rows = list(enumerate(ODD + ["".join(r.choice(["the cat ", "1234 ", "\n", "Zürich ", "😀", "  ", "It's "]) for _ in range(60)) for _ in range(20)]))
    df = spark.createDataFrame([(i, t, 7, 8) for i, t in rows], "doc_id long, text string, row long, pair long")
    want = aligned(rows)
    assert answers(align.alignment_counts(df, A, B, head=head)) == want
    assert want[2][0] and not want[1][0] and not want[7][0]


def test_alignment_of_repeated_rows_and_of_an_empty_table(docs, none):
    got = align.alignment_counts(docs, A, B).collect()
    assert len(got) == len(doc_rows()) and len({tuple(r) for r in got if r.doc_id == 2}) == 1
    assert align.alignment_counts(none, A, B).count() == 0 and align.align_tokens(none, A, B).count() == 0


def test_groups_of_a_text(spark):
    r = align.align_tokens(spark.createDataFrame([(1, "Zürich's  trains, unbelievable")], "doc_id long, text string"), A, B).first()
    with open(A, "rb") as f, open(B, "rb") as g:
        a_bytes, b_bytes = align.ByteLevel(f.read()).bytes_of, align.Pieces(g.read()).bytes_of
    assert len(r.ends_a) == len(r.ends_b) and r.ends_a[-1] == len(r.ids_a) and r.ends_b[-1] == len(r.ids_b)
    for lo, hi, lo_b, hi_b in zip([0, *r.ends_a], r.ends_a, [0, *r.ends_b], r.ends_b):
        assert b"".join(a_bytes[i] for i in r.ids_a[lo:hi]) == b"".join(b_bytes[i] for i in r.ids_b[lo_b:hi_b])


def test_texts_are_tokenized_piece_by_piece_with_the_same_tokens(monkeypatch):
    r = random.Random(2)
    with open(A, "rb") as f, open(B, "rb") as g:
        aligner = align.Aligner(f.read(), g.read())
    bits = ["some words ", "it's ", "x y", "  ", "\n\n", "1 2", "Ärger ", "a b c d ", " 's", " ...", "\x1c ", " \x85", "\u3000", "<s> ", "日本 語"]
    texts = ["".join(r.choice(bits) for _ in range(400)) for _ in range(20)] + ["y" * 5000, "é " * 3000, "a ▁ b", "", *filter(None, ODD)]
    pieces = aligner.encode(texts)
    assert aligner.cuts and len(aligner.known) > 100
    monkeypatch.setattr(align, "MOST_PIECES", 3)  # forgets all before every slice
    for t in texts:
        aligner.encode([t])
    again = aligner.encode(texts)
    aligner.cuts = False
    aligner._forget()
    whole = aligner.encode(texts)
    for got in (pieces, again):
        assert all((x == y).all() for x, y in zip([*whole[0], *whole[1]], [*got[0], *got[1]]))


def test_galloping_finds_what_sorting_finds():
    g = np.random.default_rng(4)
    for n, m in ((0, 5), (5, 0), (1, 1), (100, 100), (3000, 90_000), (20_000, 20_000)):
        short, long = np.unique(g.integers(0, 10**6, n)), np.unique(g.integers(0, 10**6, m))
        want = np.searchsorted(long, short)
        assert (align.gallop(short, long, np.zeros(len(short), dtype=np.int64)) == want).all()
        assert (align.gallop(short, long, np.maximum(0, want - g.integers(0, 50, len(want)))) == want).all()
        at, bt = np.array([0, 0, len(short), len(short)]), np.array([0, 0, len(long), len(long)])
        for x, y, i, j in ((short, long, at, bt), (long, short, bt, at)):
            left, right = align.common_ends(x, y, i, j)
            assert (x[left] == y[right]).all() and len(left) == len(np.intersect1d(short, long))
