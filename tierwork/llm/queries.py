"""Queries of the llm operators over the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwork.llm import align, bpe, fim, langid, lines, mixing, neardup, neural_lm, perfect_hash, secrets, setjoin, topk, urls
from tierwork.llm.frames import crc_rest
from tierwork.llm.ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, root: str) -> DataFrame:
            ship(spark)
            return fn(spark, root)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.strip()
        return fn

    return wrap


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def _secret_sql() -> str:
    """Per rule: pieces between matches and matches, their lengths summed to positions."""
    spans = []
    for no, r in enumerate(secrets.BASE + secrets.MORE):
        p = r.pattern.replace("(?i:password|passwd|secret|token|api_?key)", "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]").replace("'", "''")
        spans.append(f"""
        SELECT rid, {no} AS no, '{r.kind}' AS kind, m[i] AS hit, g[i] AS held,
               list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s
        FROM (SELECT rid, m, g, p, unnest(range(1, len(m) + 1)) AS i FROM (
                SELECT rid, regexp_extract_all(text, '{p}', 0) AS m, regexp_extract_all(text, '{p}', {r.group}) AS g,
                       string_split_regex(text, '{p}') AS p FROM d))
        WHERE length(g[i]) >= {r.least}""")
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    spans AS ({' UNION ALL '.join(spans)}),
    said AS (SELECT rid, no, kind, s, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + length(hit) AS BIGINT) AS span FROM spans),
    per AS (SELECT rid, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
                   string_agg(span, ',' ORDER BY s, no) FILTER (no < 3) AS base, string_agg(span, ',' ORDER BY s, no) AS spans
            FROM said GROUP BY rid)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN per USING (rid)"""


@query("op1_secret_scan", _secret_sql())
def op1_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    rules = secrets.BASE + secrets.MORE
    found = secrets.find_secrets(table(spark, root, "documents"), rules=rules)
    base = F.filter("found", lambda s: s["no"] < len(secrets.BASE))
    count = lambda no: F.size(F.filter("found", lambda s: s["no"] == no)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.joined(base, rules), 256).alias("base_sha256"), secrets.joined(F.col("found"), rules).alias("spans"))


URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@query("op8_url_filter", """
    WITH u AS (
      SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
    r AS (SELECT *, CASE
            WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
""")
def op8_url_filter(spark: SparkSession, root: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, root, "pages"), rules)


@query("op10_mix_sources", r"""
    WITH d AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS place FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
    l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM w WINDOW o AS (ORDER BY cap / weight, source)),
    m AS (SELECT arg_min(level, cap / weight) FILTER (weight * level <= cap) AS level FROM l),
    t AS (SELECT source, source_size, least(weight * m.level, cap)::DOUBLE AS target FROM w, m),
    c AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
                 coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           CAST(size * (whole + CASE WHEN 2 * before + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
""")
def op10_mix_sources(spark: SparkSession, root: str) -> DataFrame:
    mixed = mixing.mix(table(spark, root, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


@query("op2_jaccard_join")
def op2_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    return setjoin.jaccard_components(table(spark, root, "documents"), shingle=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")


@query("op5_bpe")
def op5_bpe(spark: SparkSession, root: str) -> DataFrame:
    import public_tokenizers

    return bpe.digest_documents(table(spark, root, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op6_language_id")
def op6_language_id(spark: SparkSession, root: str) -> DataFrame:
    return langid.identify(table(spark, root, "documents"))


@query("op9_lm_score")
def op9_lm_score(spark: SparkSession, root: str) -> DataFrame:
    return neural_lm.score_documents(table(spark, root, "documents"))


@query("op3_top_k", """
    WITH ok AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
          FROM ok q JOIN ok c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""")
def op3_top_k(spark: SparkSession, root: str) -> DataFrame:
    return topk.top_k(table(spark, root, "embeddings"))


@query("op4_near_vectors")
def op4_near_vectors(spark: SparkSession, root: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, root, "embeddings"))


@query("op7_line_dedup", r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
    e AS (SELECT rid, source, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line FROM d WHERE text IS NOT NULL),
    t AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM e),
    p AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
    n AS (SELECT source, bare, count(DISTINCT rid) AS n FROM t WHERE bare <> '' GROUP BY source, bare),
    b AS (SELECT n.source, bare FROM n JOIN p ON n.source IS NOT DISTINCT FROM p.source WHERE n >= 8 AND n / pages > 0.1::DOUBLE),
    k AS (SELECT t.rid, t.pos, t.line, b.bare IS NOT NULL AS gone FROM t LEFT JOIN b ON t.bare = b.bare AND t.source IS NOT DISTINCT FROM b.source),
    g AS (SELECT rid, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS text FROM k GROUP BY rid)
    SELECT doc_id, coalesce(n_dropped, 0) AS n_dropped, CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(g.text, '')) END AS text_sha256
    FROM d LEFT JOIN g USING (rid)
""")
def op7_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    cleaned = lines.drop_boilerplate(table(spark, root, "documents"), dropped_col="n_dropped")
    return cleaned.select("doc_id", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


@query("op11_fill_in_middle", """
    WITH h AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
    d AS (SELECT doc_id, text, n, CAST('0x' || hex[1:8] AS BIGINT) % (n + 1) AS x, CAST('0x' || hex[9:16] AS BIGINT) % (n + 1) AS y,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || hex[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                      WHEN CAST('0x' || hex[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
    c AS (SELECT *, least(x, y) AS a, abs(x - y) AS m FROM d)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN m END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
                            WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, a + m + 1) || '<M>' || substr(text, a + 1, m)
                            ELSE '<S>' || substr(text, a + m + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, m) END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM c
""")
def op11_fill_in_middle(spark: SparkSession, root: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, root, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query("op12_exact_dedup", """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY text)
""")
def op12_exact_dedup(spark: SparkSession, root: str) -> DataFrame:
    # every row takes part: those of even checksum stand for the history, the others for a new load
    told = perfect_hash.exact_dedup(table(spark, root, "documents"), historical=crc_rest("doc_id", 2) == 0)
    return told.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, root: str) -> DataFrame:
    import public_tokenizers

    return align.alignment_counts(table(spark, root, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
