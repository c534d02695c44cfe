"""URL filters as a sort-merge range join: reversed hosts turn host rules into intervals, a sorted sweep keeps the open rules on a stack."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.llm.frames import own_name
from tierwork.sources.storage import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SAMPLE_KEYS = 4096  # hosts drawn (by hash) to place the range bounds; the bounds only balance tasks
MOST_RANGES = 512


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each closed by a dot: a host and all its subdomains are the keys that begin with the host's key."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (range, key, kind, rules): rules of a key come before the host of that key; those open at a key are its beginnings."""
    at, stack = None, []
    for b in batches:
        keys, opened = [], []
        cols = [b.column(i).to_pylist() for i in range(4)]
        for part, key, kind, rules in zip(*cols):
            if part != at:
                at, stack = part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, rules))
            elif stack:
                keys.append(key)
                opened.append([r for _, rs in stack for r in rs])
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(opened, pa.list_(_RULE))], ["key", "open"])


_RULE = pa.struct([("host", pa.string()), ("path", pa.string()), ("verdict", pa.string())])


def open_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, open): for each distinct key of ``hosts`` below a rule's key, all rules (host, path, verdict) whose interval holds it.

    Keys are cut into ranges at drawn keys. Rules are sorted in with the hosts of their range; those whose interval reaches over the lower
    bound of a range are among the beginnings of that bound (as many as it has labels) and are added there.
    """
    spark = hosts.sparkSession
    drawn = sorted(r.key for r in hosts.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_KEYS).collect())
    n = max(1, min(MOST_RANGES, spark.sparkContext.defaultParallelism, len(drawn) // 4))
    bounds = sorted({drawn[i * len(drawn) // n] for i in range(1, n)})
    part = lambda key: F.size(F.filter(F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<string>"), lambda b: b <= key))
    by_key = rules.groupBy("key").agg(F.collect_set(F.struct("host", "path", "verdict")).alias("rules"))
    begun = [(no + 1, b[: i + 1]) for no, b in enumerate(bounds) for i, ch in enumerate(b) if ch == "."]
    over = spark.createDataFrame(begun, "part int, key string").where(part(F.col("key")) < F.col("part"))
    carried = by_key.join(over, "key").select("part", "key", F.lit(0).alias("kind"), "rules")
    own = by_key.select(part(F.col("key")).alias("part"), "key", F.lit(0).alias("kind"), "rules")
    asked = hosts.select(part(F.col("key")).alias("part"), "key", F.lit(1).alias("kind"), F.lit(None).cast(by_key.schema["rules"].dataType).alias("rules"))
    swept = own.unionByName(carried).unionByName(asked).repartition("part").sortWithinPartitions("part", "key", "kind")
    return swept.mapInArrow(_sweep, "key string, open array<struct<host:string,path:string,verdict:string>>")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (host + path, or null), verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains where the url's path begins with the rule's path. The longest
    rule (host and path together) wins; of equally long ones that with the longer host, then the smaller text, then the smaller verdict. Without
    a rule the verdict is ``default``. Null urls and urls without ``://`` have empty host and path. Rules with a null are ignored, repeated ones count once.
    Distinct hosts are swept, so a host with a third of all pages costs one key there; the join back to the pages is split by Spark.
    """
    key = own_name(pages, "_key")
    rows = pages.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path")).withColumn(key, host_key(F.col("host")))
    hosts = cut_lineage(rows.select(F.col(key).alias("key")).distinct())
    given = rules.select("host", "path", "verdict").dropna().withColumn("key", host_key(F.col("host")))
    met = rows.join(open_rules(hosts, given).withColumnRenamed("key", key), key, "left")
    fits = F.filter("open", lambda r: F.startswith(F.col("path"), r["path"]))
    ranked = F.transform(fits, lambda r: F.struct(
        (-F.length(r["host"]) - F.length(r["path"])).alias("a"), (-F.length(r["host"])).alias("b"), F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict")))
    best = F.array_min(ranked)
    return met.select(
        F.col("id").alias(id_col), "host", "path", best["rule"].alias("rule"), F.coalesce(best["verdict"], F.lit(default)).alias("verdict"))
