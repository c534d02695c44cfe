"""The llm queries against their SQL, or against brute force where SQL cannot say it, on the smallest given tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.oracle import compare, connect
from tierwork.llm import bpe
from tierwork.llm.queries import ORACLE, QUERIES

ROOT = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def linked(rows, shingle, num, den):
    """{id: (set size, least id of its component)} by comparing all sets that share a shingle."""
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[j:j + shingle]) for j in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, ROOT, QUERIES[name], ORACLE[name]) == ""


def test_every_operator_has_its_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_jaccard_join_equals_brute_force(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op2_jaccard_join"](spark, ROOT).collect()}
    assert got == linked([(i, t) for i, t, _ in docs], 3, 90, 100)


def test_near_vectors_equal_brute_force(spark):
    rows = spark.read.parquet(f"{ROOT}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.stack(rows["embedding"]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = (x @ x.T >= 0.98) & (rows["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :])
    np.fill_diagonal(link, False)
    got = QUERIES["op4_near_vectors"](spark, ROOT).toPandas().sort_values("vec_id")
    assert (got["n_links"].to_numpy() <= link.sum(axis=1)).all()
    assert got["n_links"].sum() >= 0.99 * link.sum()
    assert (got["kept"] == (got["vec_id"] == got["component_id"])).all()


def test_bpe_equals_the_library(spark, docs):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    lib = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for i, t, _ in docs:
        ids = lib.encode_ordinary(t or "")
        want[i] = (len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode()))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op5_bpe"](spark, ROOT).collect()} == want


def test_languages_of_held_out_documents(spark, docs):
    lang = {i: g for i, _, g in docs}
    rows = QUERIES["op6_language_id"](spark, ROOT).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_lm_counts_and_scores(spark, docs):
    count, n_docs = collections.Counter(), 0
    learned = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    for i, t, _ in docs:
        if learned(i):
            count.update(words(t))
            n_docs += 1
    n, v = sum(count.values()) + n_docs, len(count) + 1
    rows = {r.doc_id: r for r in QUERIES["op9_lm_score"](spark, ROOT).collect()}
    for i, t, _ in docs:
        w, r = words(t), rows[i]
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [*(count[x] for x in w), n_docs])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not learned(i), len(w) + 1, sum(x in count for x in w) + 1, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # the model says more than single words do


def test_pipeline_equals_brute_force(spark, docs):
    import corpus_pipeline

    table = spark.read.parquet(f"{ROOT}/documents.parquet")
    language, line_dedup, near, mix, encode = [f for _, f in corpus_pipeline.STAGES]
    kept = language(spark, table, ROOT)
    assert kept.columns == table.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert all(i in ids for i, t, g in docs if g and t and re.search(r"[^\W\d_]", t) and len(words(t)) >= 20)
    once = near(spark, line_dedup(spark, table, ROOT), ROOT)
    assert once.columns == table.columns
    want = linked([(r.doc_id, r.text) for r in line_dedup(spark, table, ROOT).collect()], 5, 80, 100)
    assert sorted(r.doc_id for r in once.collect()) == sorted({c for _, c in want.values()})
    mixed = mix(spark, once, ROOT)
    assert mixed.columns == table.columns
    assert max(collections.Counter(r.doc_id for r in mixed.select("doc_id").collect()).values()) <= 2
    assert encode(spark, mixed, ROOT).count() == mixed.count()
    assert corpus_pipeline.run(spark, ROOT).columns == encode(spark, mixed, ROOT).columns
