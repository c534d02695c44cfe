"""Line dedup by site-relative frequency, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.llm.frames import own_name
from tierwork.sources.storage import cut_lineage

RATIO = 0.1  # a line on more than this share of its host's pages is boilerplate
LEAST_PAGES = 8  # and on at least so many pages, so that hosts with few pages keep their text


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _name(line: Column) -> Column:
    return F.xxhash64(_trimmed(line))


def drop_boilerplate(
    docs: DataFrame, host: Column | str = "source", text_col: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES,
    dropped_col: str | None = None,
) -> DataFrame:
    """``docs`` with the boilerplate lines of each host taken out of the text; with ``dropped_col`` also how many a row lost.

    A line (cut at line feeds, compared without surrounding spaces, tabs and carriage returns) is boilerplate on a host when the host's rows that
    contain it, divided by all its rows, exceed ``ratio``, and at least ``least_pages`` rows contain it. Blank lines are no lines: they are neither counted nor dropped. Other
    lines keep their text and order. Null text stays null and counts as a page. A null host is a host. Repeated rows count as often as
    they occur. Rows keep all their columns; empty tables give no rows.

    Lines go by 64-bit hash. Counts are added per task before they are shuffled, hits come back as one short list per text (a host has at most its mean
    number of lines divided by ``ratio`` boilerplate lines), and texts are met by hash of host and text, not by host, so that a host with a third of all
    rows is spread over all tasks.
    """
    h, key, gone = own_name(docs, "_host"), own_name(docs, "_key"), own_name(docs, "_gone")
    host = F.col(host) if isinstance(host, str) else host
    rows = docs.withColumn(h, host.cast("string")).withColumn(key, F.xxhash64(h, text_col))
    names = F.array_distinct(F.transform(F.filter(F.split(text_col, "\n"), lambda x: _trimmed(x) != ""), _name))
    lines = cut_lineage(rows.select(F.col(h).alias("host"), F.col(key).alias("key"), F.explode(names).alias("line")))
    pages = rows.groupBy(F.col(h).alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    found = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
    common = found.alias("f").join(pages.alias("p"), F.col("f.host").eqNullSafe(F.col("p.host"))).where(
        F.col("n") / F.col("pages") > ratio).select("f.host", "line")
    hits = lines.alias("l").join(common.alias("c"), (F.col("l.line") == F.col("c.line")) & F.col("l.host").eqNullSafe(F.col("c.host"))).groupBy(
        F.col("l.key").alias(key)).agg(F.collect_set("l.line").alias(gone))
    met = rows.join(cut_lineage(hits), key, "left")
    keep = F.filter(F.split(text_col, "\n"), lambda x: ~F.array_contains(gone, _name(x)) | (_trimmed(x) == ""))
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.array_join(keep, "\n"))
    out = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if dropped_col:
        out.append(F.when(F.col(gone).isNull(), F.lit(0)).otherwise(F.size(F.split(text_col, "\n")) - F.size(keep)).cast("long").alias(dropped_col))
    return met.select(*out)
