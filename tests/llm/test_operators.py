"""Operators on small tables: nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwork.llm import bpe, frames, graph, langid, lines, mixing, neardup, neural_lm, secrets, setjoin, topk, urls
from tierwork.llm import words as w

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kinds int, _key int, score int, id int, h int"
KEY = "AKIA" + "A1B2" * 4


def doc_rows():
    long = " ".join(f"word{i % 977} of a long text" for i in range(40_000))
    return [
        (1, "The cat sat on the mat and the dog ran away.", "en", "a"), (2, "The cat sat on the mat and the dog ran away.", "en", "a"),
        (2, "The cat sat on the mat and the dog ran away.", "en", "a"), (3, None, None, None), (4, "", "en", "b"), (5, " \t\n ", None, "b"),
        (6, "12 34 !!", "en", None), (None, "Le chat est sur la table et le chien dort.", "fr", "b"), (7, long, "en", "c"),
        (8, "é😀 password: abcdef1 " + KEY, "fr", "c"), (9, "Le chien dort et le chat mange la souris.", "fr", "c")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, 1, 2, 3, 4, 5) for r in doc_rows()], SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# words, shingles, frames, graph

def test_words_are_hashed_alike_wherever_they_stand():
    import pyarrow as pa

    long = "x" * (w.WINDOW + 10)
    texts = ["Ab ab\tAB", None, "", "ab", long + " ab " + long, "a b"]
    got = {r: h for lo, hi, at, hs in w.words(pa.array(texts)) for r, h in ((r, hs[at[r - lo]: at[r - lo + 1]]) for r in range(lo, hi))}
    assert [len(got[i]) for i in range(6)] == [3, 0, 0, 1, 3, 2]
    assert len({*got[0], *got[3], got[4][1]}) == 1 and got[4][0] == got[4][2] != got[3][0]
    assert len(w.shingles(got[0], 3)) == 1 and len(w.shingles(got[5], 3)) == 1 and not len(w.shingles(got[2], 3))


def test_components_by_paths_cycles_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 202), (202, 200), (None, 3)]
    got = {r.key: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160)) and got[202] == 200
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_numbering_and_sums(spark):
    got = frames.numbered(spark.createDataFrame([(x,) for x in ("b", None, "a", "é", "Z")], "s string"), F.col("s").asc_nulls_last(), "no")
    assert {r.s: r.no for r in got.collect()} == {"Z": 0, "a": 1, "b": 2, "é": 3, None: 4}


# 1 secrets

def test_trigram_queries_are_derived_from_patterns():
    q = secrets.trigram_query
    assert q("AKIA[A-Z0-9]+") == {frozenset({"aki", "kia"})}
    assert q("[0-9a-f]{24,}") == secrets.ANY and q("(abc)?x") == secrets.ANY and q("ab|cdef") == secrets.ANY
    assert q("(foo|bar)baz") == {frozenset({"foo", "oob", "oba", "baz"}), frozenset({"bar", "arb", "rba", "baz"})}
    assert q("api_?key.*=") == {frozenset({"api", "pik", "ike", "key"}), frozenset({"api", "pi_", "i_k", "_ke", "key"})}


def test_secrets_of_odd_rows(docs, none):
    rules = secrets.BASE + secrets.MORE
    found = {}
    for r in secrets.find_secrets(docs).withColumn("said", secrets.joined(F.col("found"), rules)).collect():
        found.setdefault(r.doc_id, []).append(r.said)
    assert found[8] == ["assign:3:20,access:21:41"] and len(found[2]) == 2 and len(found[None]) == 1
    assert all(x == "" for k, v in found.items() if k != 8 for x in v)
    assert secrets.find_secrets(none).count() == 0


def test_secrets_equal_a_scan_without_index(spark):
    r = random.Random(3)
    bits = ["password", "PassWd", "token", "api_key", "APIKEY", "=", ":", " ", "'", '"', "abc", "abcdef", KEY, "AKIA", "0123456789abcdef" * 2, "é", "😀", "\n", "secret", "-----BEGIN RSA PRIVATE KEY-----"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(300)]
    rules = secrets.BASE + secrets.MORE

    def scan(t):
        out = []
        for no, rule in enumerate(rules):
            for m in re.finditer(rule.pattern, t):
                if len(m[rule.group]) >= rule.least:
                    out.append((m.start(), no, m.end()))
        return sorted(out)

    got = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {x.doc_id: [tuple(s) for s in x.found] for x in got.collect()} == {i: scan(t) for i, t in enumerate(texts)}
    index = secrets.trigram_index(spark.createDataFrame([(1, "aAab")], "k int, t string"), F.col("k"), F.col("t"))
    assert sorted(x.gram for x in index.collect()) == ["aaa", "aab"]


# 2 sets

def test_jaccard_of_odd_rows(docs, none):
    rows = sorted(setjoin.jaccard_components(docs, shingle=3, num=90).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in rows]
    assert got[:6] == [(1, 9, 1), (2, 9, 1), (2, 9, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5)]
    assert got[6] == (6, 1, 6) and got[-1][0] is None and got[-1][2] is None
    assert setjoin.jaccard_components(none).count() == 0
    kept = setjoin.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9]


@pytest.mark.parametrize("num", [60, 80, 90])
def test_jaccard_equals_brute_force_on_small_and_large_sets(spark, num):
    from tests.llm.test_queries import linked

    r = random.Random(num)
    base = [[f"w{r.randint(0, 400)}" for _ in range(n)] for n in (1, 2, 4, 6, 9, 12, 15, 20, 30, 60, 120)]
    texts = []
    for b in base:
        for _ in range(12):
            t = list(b)
            for _ in range(r.randint(0, 3) if t else 0):
                i = r.randrange(len(t) or 1)
                t[i:i + r.randint(0, 1)] = [f"x{r.randint(0, 5)}"] * r.randint(0, 2)
            texts.append(" ".join(t + ["common passage that very many of the texts share"] * r.randint(0, 1)))
    rows = list(enumerate(texts))
    got = setjoin.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2, num=num)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got.collect()} == linked(rows, 2, num, 100)


def test_jaccard_when_another_component_becomes_the_main_one(spark, monkeypatch):
    """Per group: x and five near copies, a and two near copies, and m, which links with x and with these; all 10 are in the same lists."""
    from tests.llm.test_queries import linked

    monkeypatch.setattr(setjoin, "FEW", 4)
    monkeypatch.setattr(setjoin, "STAR_ROUNDS", 1)
    texts = []
    for g in range(12):
        x, m, a = set(range(12)), {0, 1, 2, *range(12, 21)}, set(range(18, 30))  # words that are missing
        gone = [x, *(x - {i % 3} | {30 + 3 * i + j for j in range(3)} for i in range(5)), a, a - {28} | {45}, a - {29} | {46}, m]
        texts += [" ".join(f"g{g}w{i}" for i in range(100) if i not in d) for d in gone]
        # these make the missing words frequent, so that no prefix holds them
        texts += [" ".join([*(f"g{g}w{i}" for i in range(47)), *(f"g{g}f{f}x{i}" for i in range(100))]) for f in range(12)]
    rows = list(enumerate(texts))
    got = setjoin.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), shingle=1, num=80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == linked(rows, 1, 80, 100)


def test_rounds_of_components_leave_few_files(spark, monkeypatch):
    parts, keep = [], graph.cut_lineage

    def spy(df):
        out = keep(df)
        parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(graph, "cut_lineage", spy)
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {r.key: r.root for r in graph.components(spark.createDataFrame([(1, 2), (3, 2), (9, 8)], "a long, b long")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8}
    assert len(parts) > 2 and max(parts[1:]) <= spark.sparkContext.defaultParallelism


def test_keys_that_several_classes_post(spark):
    r = random.Random(5)
    rows = [(r.randint(-40, 40) * 2**40, r.choice((r.randint(0, 3), r.randint(0, 60)))) for _ in range(300)] + [(7, c % 20) for c in range(200)] + [(8, 1)] * 9
    of: dict[int, set] = {}
    for e, c in rows:
        of.setdefault(e, set()).add(c)
    conf, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n in (1, 7, 1000):
            spark.conf.set(conf, n)
            got = [(x.elem, x.cls) for x in setjoin._shared_keys(spark.createDataFrame(rows, "elem long, cls long")).collect()]
            assert len(got) == len(set(got)) and set(got) == {(e, c) for e, cs in of.items() if len(cs) > 1 for c in cs}
    finally:
        spark.conf.set(conf, before)


def test_near_duplicates_do_not_shuffle_or_store_every_text(spark):
    """Also: repeated rows, null ids and columns that no Arrow batch holds; the files that stay are few."""
    from pathlib import Path

    from tierwork.sources.storage import shared_dir

    r = random.Random(9)
    word = lambda: f"{r.getrandbits(240):060x}"
    texts = [[word() for _ in range(100)] for _ in range(300)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, " ".join(texts[i])) for i in range(20)]  # exact copies
    rows += [(-1 - i, " ".join([word(), *texts[i][1:]])) for i in range(10, 30)]  # near ones, with the least ids
    rows += [rows[i] for i in (40, 40, 41, 2)] + [(None, rows[50][1]), (None, " ".join([word(), *texts[60][1:]])), (None, word()), (77, " "), (78, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("c", F.expr("make_interval(0, 1, 0, 2)"))
    least = {i: -1 - i if 10 <= i < 30 else i for i in range(300)}
    want = sorted([*least.values(), 77, 78, None], key=str)
    files = lambda: {f.getPath(): f.length() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()) if "shuffle_" in f.getName()}
    folders = lambda: {f.name for f in Path(shared_dir(spark).removeprefix("file://")).iterdir() if "setjoin" in f.name}
    shuffled, stored = files(), folders()
    got = setjoin.keep_one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((x.doc_id for x in got.select("doc_id", "text").collect()), key=str) == want
    assert sum(n for f, n in files().items() if f not in shuffled) < 0.5 * sum(len(t or "") for _, t in rows)
    assert {x.rpartition("-")[0] for x in folders() - stored} == {"setjoin-chosen"}


def test_boundary_follows_cost():
    sizes = np.zeros(200, dtype=int)
    sizes[5] = sizes[150] = 1000
    assert setjoin.light_bound(sizes, 5.0, 90, 100) >= 5
    sizes[:] = 0
    sizes[150] = 1000
    assert setjoin.light_bound(sizes, 1.0, 60, 100) == 0
    assert setjoin.subset_count(9, 90, 100) == 1 and setjoin.prefix_size(10, 90, 100) == 2


# 3, 4 vectors

def test_top_k_with_ties_bad_vectors_and_repeats(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [-1.0, 0.5]), (4, None), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, []), (9, [2.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, h int, rank int")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, k=4, every=20).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 9, 8192), (0, 2, 1, 4096), (0, 3, 2, 4096), (0, 4, 8, 0)]
    assert topk.top_k(df.limit(0)).count() == 0


def test_maxscore_prunes_nothing_it_needs():
    r = np.random.default_rng(1)
    v = r.integers(-20, 21, (3000, 16)) * (r.random((3000, 16)) < 0.4)
    ids = r.permutation(3000)
    row, score, ident = topk.maxscore(v[:70], ids[:70], v, ids, 5)
    full = v[:70] @ v.T
    for q in range(70):
        want = sorted(((-full[q, i], ids[i]) for i in range(3000) if ids[i] != ids[q]))[:5]
        assert [(-s, i) for s, i in zip(score[row == q], ident[row == q])] == want


def test_maxscore_of_dense_vectors_sums_blocks_and_gathers_no_pairs(monkeypatch):
    r = np.random.default_rng(2)
    v = np.floor(64 * r.normal(0, 0.125, (3000, 64))).astype(np.int64)
    v[40:90] = v[:50]  # ties
    ids = r.permutation(3000)
    ids[7] = ids[8]
    monkeypatch.setattr(np, "einsum", None)
    row, score, ident = topk.maxscore(v[:70], ids[:70], v, ids, 20)
    full = v[:70] @ v.T
    for q in range(70):
        want = sorted((-full[q, i], ids[i]) for i in range(3000) if ids[i] != ids[q])[:20]
        assert [(-s, i) for s, i in zip(score[row == q], ident[row == q])] == want


def test_near_vectors_of_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.01], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1),
            (7, [0.0, 0.0], 1), (8, [None, 1.0], 1), (9, [float("nan"), 1.0], 1), (None, [1.0, 0.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (12, [0.0, 1.0], 1)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, label int, cls int, kept string")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()))
    assert got == [(0, 4, 1, False), (1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (3, 4, 1, False)] + [(i, 0, i, True) for i in range(4, 13)]
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_near_vectors_across_ranges_and_cells(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CELL", 40)
    r = np.random.default_rng(2)
    centres = r.normal(size=(30, 16))
    x = (centres[r.integers(0, 30, 900)] + r.normal(size=(900, 16)) * 0.13).astype(np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.98
    np.fill_diagonal(link, False)
    got = neardup.near_duplicates(spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int"))
    n = got.orderBy("vec_id").toPandas()["n_links"].to_numpy()
    assert (n <= link.sum(axis=1)).all() and n.sum() >= 0.9 * link.sum()


# 5 bpe

def test_transducer_equals_merging_on_random_ranks():
    r = random.Random(8)
    ranks = {bytes([b]): b for b in b"abc"}
    while len(ranks) < 40:
        t = r.choice(list(ranks)) + r.choice(list(ranks))
        if len(t) <= 8:
            ranks.setdefault(t, 200 + len(ranks))
    made = bpe.Transducer(ranks)
    usable = {t: i for t, i in ranks.items() if made.merged(t) == [i]}
    made = bpe.Transducer(usable)
    for _ in range(4000):
        piece = bytes(r.choice(b"abc") for _ in range(r.randint(1, 40)))
        assert made.encode(piece) == ([usable[piece]] if piece in usable else made.merged(piece))


def test_utf8_machine_at_every_cut_and_on_broken_bytes():
    data = "aé€😀\u0800\U0010ffffz".encode()
    for i in range(len(data) + 1):
        for j in range(i, len(data) + 1):
            m = bpe.Utf8Machine()
            assert m.feed(data[:i]) + m.feed(data[i:j]) + m.feed(data[j:]) + m.close() == data.decode()
    m = bpe.Utf8Machine()
    assert m.feed(b"a\xff\xe2\x82") + m.feed(b"x") + m.feed(b"\xf0\x9f") + m.close() == "a\ufffd\ufffdx\ufffd"


def test_bpe_of_odd_rows(docs, none):
    import public_tokenizers as P

    args = (P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rows = bpe.digest_documents(docs, *args).collect()
    n = {r.doc_id: r.n_tokens for r in rows}
    assert len(rows) == len(doc_rows()) and n[3] == n[4] == 0 and n[7] > 200_000
    assert {r.doc_id: r.decoded_chars for r in rows}[7] == len(doc_rows()[8][1])
    assert bpe.digest_documents(none, *args).count() == 0


# 6 language

def test_gradients_equal_differences():
    net = langid.ByteGru(3, hidden=3, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    data, label = np.array([[97, 98, 97, 99], [98, 98, 99, 97]]), np.array([0, 2])
    _, g = net.gradients(data, label)
    for name, at in (("xf", (97, 4)), ("uf", (1, 7)), ("xb", (98, 1)), ("ub", (2, 5)), ("o", (4, 2)), ("ob", (0,))):
        keep, loss = net.p[name][at], []
        for step in (1e-3, -1e-3):
            net.p[name][at] = keep + step
            loss.append(net.gradients(data, label)[0])
        net.p[name][at] = keep
        assert g[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-3, rel=2e-2, abs=1e-5)


def test_language_of_odd_rows(docs, none):
    got = {}
    for r in langid.identify(docs, steps=60).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert all(got[i] == [("und", 0.0)] for i in (3, 4, 5, 6)) and len(got[2]) == 2 and len(set(got[2])) == 1
    assert all(p in ("en", "fr") and 0 < s <= 1 for i in (1, 7, 8, 9, None) for p, s in got[i])
    assert langid.identify(none).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}
    kept = langid.keep_identified(docs, 0.3, steps=60)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 7, 8, 9, None}


# 7 lines

def test_lines_common_on_one_host_only(spark):
    rows = [(i, f"Menu\ntext {i}\n\n  Menu \r\nend {i}", "a") for i in range(10)] + [(10 + i, f"Menu\npage {i}" if i == 0 else f"page {i}", "b") for i in range(20)]
    rows += [(40, None, "a"), (41, "", "a"), (42, "Menu", None)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, _host int, _gone int")
    out = lines.drop_boilerplate(df, ratio=0.5, least_pages=5, dropped_col="n")
    got = {r.doc_id: (r.text, r.n) for r in out.collect()}
    assert out.columns == [*df.columns, "n"] and got[3] == ("text 3\n\nend 3", 2) and got[10] == ("Menu\npage 0", 0)
    assert got[40] == (None, 0) and got[41] == ("", 0) and got[42] == ("Menu", 0) and len(got) == len(rows)
    assert lines.drop_boilerplate(df.limit(0)).count() == 0


# 8 urls

def test_longest_rule_wins_for_hosts_and_subdomains(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.example.net", "/", "block"), ("example.net", "/en/x", "block"), ("b.net", "", "allow"), (None, "/", "block"), ("net", "/", "block")]
    urls_ = ["http://example.net/en/1", "HTTP://WWW.Example.NET/en/x?y", "x://net/", "http://net", "http://a.example.net/en/q", "http://b.net", "http://xb.net/p#f",
             "no scheme", None, "", "http://", "http://bexample.net/en/1", "http://example.net./en/", "http://org/"]
    want = {0: "example.net/en/", 1: "example.net/en/x", 2: "net/", 3: None, 4: "example.net/en/", 5: "b.net", 6: "net/", 11: "net/"}
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls_)], "page_id long, url string, host int")
    out = urls.judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert {r.page_id: r.rule for r in out} == {i: want.get(i) for i in range(len(urls_))}
    assert {r.page_id: (r.host, r.path) for r in out}[1] == ("www.example.net", "/en/x") and {r.page_id: r.verdict for r in out}[13] == "allow"
    assert urls.judge_urls(df.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def test_sweep_equals_comparing_all(spark):
    r = random.Random(4)
    label = lambda: r.choice(["a", "b", "c", "aa"])
    rules = list({(".".join(label() for _ in range(r.randint(1, 3))), r.choice(["/", "/x", "/x/y"]), r.choice(["allow", "block"])) for _ in range(40)})
    pages = [(i, f"s://{'.'.join(label() for _ in range(r.randint(1, 5)))}{r.choice(['', '/', '/x', '/x/y/z'])}") for i in range(600)]

    def judge(url):
        host, _, path = url[4:].partition("/")
        path = "/" + path if "/" in url[4:] else ""
        fit = [x for x in rules if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])]
        best = min(fit, key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0]), x[0] + x[1], x[2]), default=None)
        return (best[0] + best[1], best[2]) if best else (None, "allow")

    got = urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert {x.page_id: (x.rule, x.verdict) for x in got.collect()} == {i: judge(u) for i, u in pages}


# 9 language model

def test_nce_learns_pairs_and_probabilities_are_normalised():
    pairs = np.array([[0, 0, 90, 10], [0, 0, 0, 0], [50, 0, 0, 50], [10, 0, 90, 0]]) * 10
    m = neural_lm.LogBilinear(4, size=8)
    m.train(pairs, steps=1500, rows=128, noise=8)
    p = np.exp(m.log_probabilities())
    assert p.sum(axis=1) == pytest.approx(np.ones(4)) and p[0, 2] > 0.75 and p[2, 3] > 0.3 and p[3, 2] > 0.75


def test_lm_of_odd_rows(docs, none, monkeypatch):
    want = {}
    for few in (neural_lm.HEAD_WORDS, 5):  # counts from the broadcast table, and from the join
        monkeypatch.setattr(neural_lm, "HEAD_WORDS", few)
        rows = neural_lm.score_documents(docs, steps=50).collect()
        got = sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
        want = want or got
        assert got == want and len(rows) == len(doc_rows()) and all(math.isfinite(r.score) for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[3].n_tokens == by[4].n_tokens == by[5].n_tokens == 1 and by[7].n_tokens == 200_001
    assert neural_lm.score_documents(none).count() == 0


# 10 mixing

def test_water_filling_clamps_and_reshares(spark):
    sizes = spark.createDataFrame([("a", 100)] * 3 + [("b", 10)] * 2 + [(None, 50)], "source string, size long")
    t = {r.source: r.target for r in mixing.source_targets(sizes, (5, 2, 1), 1.5, 2.0).collect()}
    assert t["b"] == 40.0 and sum(t.values()) == pytest.approx(1.5 * 370) and t["a"] / t[None] == pytest.approx(5.0)
    assert {r.target for r in mixing.source_targets(sizes, (5, 2, 1), 3.0, 2.0).collect()} == {600.0, 40.0, 100.0}


def test_mix_of_odd_rows(docs, none, spark):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(doc_rows()) and sorted(rows, key=str) == sorted(mixing.mix(docs.repartition(5)).collect(), key=str)
    assert {r.size for r in rows if r.doc_id in (3, 4, 5)} == {0} and max(r.copies for r in rows) <= 2
    assert mixing.mix(none).count() == 0 and mixing.repeat_documents(docs).columns == docs.columns
    even = spark.createDataFrame([(i, "a b c " * (1 + i % 9), f"s{i % 4}") for i in range(4000)], "doc_id long, text string, source string")
    got = mixing.mix(even).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("n")).collect()
    assert all(abs(r.t - r.n) <= 27 for r in got)
    assert mixing.repeat_documents(even).count() == mixing.mix(even).agg(F.sum("copies")).first()[0]


def test_repeats_follow_the_plan_where_rows_share_an_id(spark):
    rows = [(None, f"a b c d {s}{0 if s == 'z' else i}", s, i) for s in "xyz" for i in range(40)]  # 40 texts, in z one
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _no int")
    planned = {r.source: (r.t, r.n) for r in mixing.mix(df).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("n")).collect()}
    out = mixing.repeat_documents(df)
    got = {r.source: 5 * r["count"] for r in out.groupBy("source").count().collect()}
    assert got == {s: n for s, (_, n) in planned.items()} and all(abs(t - got[s]) <= 2.5 for s, (t, _) in planned.items())
    assert out.columns == df.columns and out.where("source = 'y'").distinct().count() == 40
