"""Quality rules of single documents, and of the hosts that they come from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS, Aside, cut, if_small, only, table, whole, words

SYMBOLS = "[#*$%&|<>]"
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def rule_metrics(df: DataFrame, *, text: str = "text", min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """df with a struct _m: counts of words, their characters, symbols, repeated lines, words in repeated 3-word windows, base_failed.

    A null or empty text has no words and so fails. Windows are compared by 64-bit hashes; a text with a
    repeated one sorts its (hash, position) pairs, so a long text costs n log n. Repeated rows are measured
    each for itself, an empty table gives an empty result, and a column of df named _m is replaced; other
    names cannot clash. There is no exchange.
    """
    given = Aside(df)
    t = whole(given.of(text))
    full = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(WS)) != "")
    first = given.df.select("*", words(t).alias("_w"), full.alias("_full"))
    hashes = F.expr("CASE WHEN size(_w) >= 3 THEN transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])) ELSE CAST(array() AS array<bigint>) END")
    second = first.select(
        *given.own,
        F.size("_w").cast("long").alias("_n"),
        F.length(F.array_join("_w", "")).cast("long").alias("_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("_dup"),
        hashes.alias("_h"),
    )
    pairs = F.expr(
        "CASE WHEN size(_h) > 1 AND size(array_distinct(_h)) < size(_h)"
        " THEN array_sort(arrays_zip(_h, sequence(0, size(_h) - 1))) END"
    )
    third = second.select(*[c for c in second.columns if c != "_h"], pairs.alias("_s"))
    repeated = (
        "filter(sequence(0, size(_s) - 1), k -> (k > 0 AND _s[k]._h = _s[greatest(k - 1, 0)]._h)"
        " OR (k < size(_s) - 1 AND _s[k]._h = _s[least(k + 1, size(_s) - 1)]._h))"
    )
    # Windows start at rising positions; each adds its words beyond the one before.
    covered = F.expr(
        f"coalesce(aggregate(array_sort(transform({repeated}, k -> _s[k]['1'])), named_struct('n', 0L, 'last', -3),"
        " (a, p) -> named_struct('n', a.n + least(3, p - a.last), 'last', p)).n, 0L)"
    )
    fourth = third.select(*[c for c in third.columns if c != "_s"], covered.alias("_repeat"))
    failed = (F.col("_n") < min_words) | (100 * F.col("_repeat") > max_repeat_percent * F.col("_n"))
    made = F.struct(*[F.col(a).alias(b) for a, b in zip(("_n", "_chars", "_symbols", "_dup", "_repeat"), METRICS, strict=False)], failed.alias("base_failed"))
    return fourth.select(*given.back("_m"), made.alias("_m"))


def host_verdicts(df: DataFrame, *, host: str = "source", failed: str = "_failed", max_rate: float = 0.8) -> DataFrame:
    """For each host: _host, host_docs, host_failed, host_rate (shrunk), host_rejected.

    The prior Beta(a, b) has the mean of all documents; its weight a + b comes from the spread of the hosts'
    rates beyond what chance gives to hosts of their sizes, kept between 1 and 10,000 documents; where there
    is no such spread it is 10,000. A null host is a host of its own, repeated rows count each, an empty
    table has no hosts. Other columns are not read. Hosts are counted by partial sums, so one that holds a
    third of all rows costs no more than others.
    """
    hosts = cut(only(df, _host=host, _f=failed).groupBy("_host").agg(F.count(F.lit(1)).alias("host_docs"), F.count_if("_f").alias("host_failed")))
    rate = F.col("host_failed") / F.col("host_docs")
    total = hosts.agg(F.sum("host_docs").alias("n"), F.sum("host_failed").alias("k"), F.var_pop(rate).alias("v"), F.avg(1 / F.col("host_docs")).alias("inv")).first()
    n, mean = total.n or 0, (total.k or 0) / max(total.n or 0, 1)
    extra = (total.v or 0.0) - mean * (1 - mean) * (total.inv or 0.0)
    weight = min(max(mean * (1 - mean) / extra - 1, 1.0), 1e4) if n and extra > 0 else 1e4
    shrunk = (F.col("host_failed") + F.lit(mean * weight)) / (F.col("host_docs") + F.lit(weight))
    return hosts.select("_host", "host_docs", "host_failed", shrunk.alias("host_rate"), (shrunk > max_rate).alias("host_rejected"))


def judged(df: DataFrame, *, host: str = "source", failed: str = "_failed", max_rate: float = 0.8) -> DataFrame:
    """df with host_rate and _kept: false if it failed itself or its host is rejected.

    df is read twice and so should be a table or a checkpoint. Null hosts are judged as one host, repeated
    rows each for itself, and an empty table gives an empty result. Columns of df named host_rate or _kept
    are replaced; other names cannot clash.
    """
    verdicts = host_verdicts(df, host=host, failed=failed, max_rate=max_rate).select("_host", "host_rate", "host_rejected")
    verdicts = if_small(cut(verdicts))
    given = Aside(df)
    joined = given.df.join(verdicts, given.of(host).eqNullSafe(F.col("_host")), "left")
    kept = ~given.of(failed) & ~F.coalesce("host_rejected", F.lit(False))
    return joined.select(*given.back("host_rate", "_kept"), "host_rate", kept.alias("_kept"))


def op3_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    metrics = cut(rule_metrics(docs).select("doc_id", "source", "_m.*"))
    return judged(metrics, failed="base_failed").select("doc_id", *METRICS, F.col("_kept").alias("kept"), "host_rate")


OP3_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, source FROM documents),
w AS (SELECT doc_id, source, t, [x FOR x IN regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS ls FROM d),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
cov AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS p FROM rep, range(3) r(k)) GROUP BY doc_id),
m AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN ws]), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source AS s, count(*) AS n, count(*) FILTER (base_failed) AS k FROM f GROUP BY 1),
p AS (SELECT sum(k) / sum(n) AS mean, var_pop(k / n) - sum(k) / sum(n) * (1 - sum(k) / sum(n)) * avg(1 / n) AS extra FROM h),
q AS (SELECT mean, CASE WHEN extra > 0 THEN least(greatest(mean * (1 - mean) / extra - 1, 1.0), 1e4) ELSE 1e4 END AS weight FROM p),
v AS (SELECT s, (k + mean * weight) / (n + weight) AS host_rate FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_rate > 0.8 AS kept, host_rate
FROM f LEFT JOIN v ON f.source IS NOT DISTINCT FROM v.s
"""
