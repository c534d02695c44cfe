"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's regex gives a Boolean query over trigrams. Postings of these trigrams are intersected per document, and only documents that
satisfy a rule's query are searched with its regex. Rules whose regex forces no trigram search every document.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANY = frozenset([frozenset()])  # the query that every text satisfies


@dataclass(frozen=True)
class SecretRule:
    """A regex and, where a group must be long enough to count, that group and its least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The patterns and least lengths of the three base kinds. A hex or access match is the whole run of its class, so a
# least length inside the pattern drops the same matches as a check afterwards.
BASE = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    SecretRule("private_key", r"-----BEGIN (?:[A-Z]{2,12} ){0,3}PRIVATE KEY-----"),
    SecretRule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("maps_key", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("payment", r"[sr]k_live_[A-Za-z0-9]{16,}"),
)
_EXACT = 64  # alternatives of a fixed text that are followed before they become "anything"


def _least(q: frozenset) -> frozenset:
    return frozenset(c for c in q if not any(o < c for o in q))


def _both(a: frozenset, b: frozenset) -> frozenset:
    return _least(frozenset(x | y for x in a for y in b))


def _grams(texts: set[str]) -> frozenset:
    """Any of the texts: the trigrams of each, as one clause; a text under three characters asks for nothing."""
    return _least(frozenset(frozenset(t[i:i + 3] for i in range(len(t) - 2)) for t in texts))


def _node(op, arg) -> tuple[set[str] | None, frozenset]:
    """(all texts that the node can match, lower case, or None) and the query that its matches satisfy."""
    if op is sre.LITERAL:
        return {chr(arg).lower()}, ANY
    if op is sre.IN and all(k is sre.LITERAL for k, _ in arg) and len(arg) <= 8:
        return {chr(v).lower() for _, v in arg}, ANY
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        if all(t is not None for t, _ in parts):
            return set().union(*(t for t, _ in parts)), ANY
        return None, _least(frozenset().union(*((_grams(t) if t is not None else q) for t, q in parts)))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, getattr(sre, "POSSESSIVE_REPEAT", None)):
        low, high, inner = arg
        texts, query = _sequence(inner)
        if texts is not None and high == 1:
            return texts | ({""} if low == 0 else set()), ANY
        return None, ANY if low == 0 else (_grams(texts) if texts is not None else query)
    if op is sre.AT:
        return {""}, ANY
    return None, ANY


def _sequence(nodes) -> tuple[set[str] | None, frozenset]:
    run, query, whole = {""}, ANY, True
    for op, arg in nodes:
        texts, q = _node(op, arg)
        if texts is not None and len(run) * len(texts) <= _EXACT:
            run = {a + b for a in run for b in texts}
            continue
        query = _both(_both(query, _grams(run)), _grams(texts) if texts is not None else q)
        run, whole = {""}, False
    return (run, ANY) if whole else (None, _both(query, _grams(run)))


def trigram_query(pattern: str) -> frozenset[frozenset[str]]:
    """Alternatives, each a set of lower-case trigrams that must all occur; an empty set among them: no trigram is forced."""
    texts, query = _sequence(sre_parser.parse(pattern))
    return _grams(texts) if texts is not None else query


def trigram_index(docs: DataFrame, key: Column, text: Column, trigrams: Sequence[str] | None = None) -> DataFrame:
    """Postings (gram, key): each trigram of the lower-cased text once per row; of all trigrams, or of the given ones."""
    folded = F.lower(text)
    if trigrams is None:
        grams = F.array_distinct(F.regexp_extract_all(folded, F.lit("(?s)(?=(...))"), F.lit(1)))
    else:
        grams = F.filter(F.array(*map(F.lit, sorted(trigrams))), lambda g: F.contains(folded, g))
    return docs.select(key.alias("key"), F.explode(grams).alias("gram"))


def candidates(index: DataFrame, queries: dict[str, frozenset]) -> DataFrame:
    """(key, kinds): the rules whose query a key's postings satisfy. Rows per key are bounded by the rules' trigrams."""
    clauses = [(g, kind, no, len(c)) for kind, q in queries.items() for no, c in enumerate(sorted(map(sorted, q))) for g in c]
    asked = F.broadcast(index.sparkSession.createDataFrame(clauses, "gram string, kind string, clause int, n int"))  # as large as the rules
    met = index.join(asked, "gram").groupBy("key", "kind", "clause").agg(F.countDistinct("gram").alias("met"), F.first("n").alias("n"))
    return met.where(F.col("met") == F.col("n")).groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: SecretRule, no: int) -> Column:
    """Array of (start, no, end) of a rule's matches, in code points: lengths of the pieces between matches and of the matches, summed."""
    pattern = F.lit(rule.pattern)
    matches, pieces = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern, -1)
    held = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    parts = F.zip_with(F.zip_with(pieces, matches, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("len"))), held,
                       lambda x, h: F.struct(x["gap"].alias("gap"), x["len"].alias("len"), F.length(h).alias("held")))
    parts = F.filter(parts, lambda x: x["len"].isNotNull())
    empty = F.array().cast("array<struct<start:int,no:int,end:int>>")
    begin = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc, x):
        start, end = acc["at"] + x["gap"], acc["at"] + x["gap"] + x["len"]
        span = F.array(F.struct(start.alias("start"), F.lit(no).alias("no"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["held"] >= rule.least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.when(F.size(matches) > 0, F.aggregate(parts, begin, step, lambda acc: acc["out"])).otherwise(empty)


def joined(spans: Column, rules: Sequence[SecretRule]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat(F.element_at(names, s["no"] + 1), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[SecretRule] = BASE + MORE) -> DataFrame:
    """One row per row of ``docs``: id and ``found``, an array of (start, no, end) ordered by start, then by place of the rule.

    ``no`` is the place of the rule in ``rules``; positions are code points, end exclusive. Null text is the empty text and holds nothing.
    Rows are met again by a hash of id and text: rows that share it (repeated rows, or a collision) share candidates only, and each is
    searched by itself. Empty tables give no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("id", "text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = {k: q for k, q in queries.items() if frozenset() not in q}
    if asked:
        grams = {g for q in asked.values() for c in q for g in c}
        rows = rows.join(candidates(trigram_index(rows, F.col("key"), F.col("text"), grams), asked), "key", "left")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    none = F.array().cast("array<struct<start:int,no:int,end:int>>")
    found = [
        F.when(F.array_contains("kinds", r.kind), _spans(F.col("text"), r, no)).otherwise(none) if r.kind in asked
        else F.when(F.col("text").rlike(r.pattern), _spans(F.col("text"), r, no)).otherwise(none)
        for no, r in enumerate(rules)]
    return rows.select(F.col("id").alias(id_col), F.array_sort(F.concat(*found)).alias("found"))
