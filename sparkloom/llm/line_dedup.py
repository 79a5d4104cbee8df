"""Removal of lines that other documents already hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Aside, WS, ascii_lower, col, only, parts, table, whole

WORD = 64


def _lines(t: Column) -> Column:
    return F.split(t, "\n", -1)


def keep_bitmaps(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", min_chars: int = 10, salts: int = 16) -> DataFrame:
    """For each document that loses lines: _id, _th, n_dropped and keep, its bitmap of kept lines.

    keep is an array of (word, bits), 64 lines a word; a word that is not listed has all bits set, and a
    document that is not listed keeps every line. A line's key is the stripped line with A-Z lower-cased;
    keys under min_chars code points never count. The smallest id keeps its lines. Rows with one id are one
    document; those without an id keep their lines and never are the first. Null and empty texts, and empty
    tables, give no rows; a long text costs its length; other columns are not read. Keys are compared by 96 bits of hashes.

    The rows are dealt by fixed ranges of a hash of (key, salt), which is uniform, so that no pass over the
    data has to find the ranges. They are sorted by document and position, and first occurrences stream by: no
    task holds a key's rows at once, and a line that a third of all documents hold is spread over the salts.
    """
    n = parts(df.sparkSession)
    stripped = F.btrim(F.col("_line"), F.lit(WS))
    docs = only(df, _id=doc_id, _t=text).select("_id", whole("_t").alias("_t")).select("_id", "_t", F.xxhash64("_t").alias("_th"))
    rows = (
        docs.select("_id", "_th", F.posexplode(_lines(F.col("_t"))).alias("_pos", "_line"))
        .where(F.length(stripped) >= min_chars)
        .select("_id", "_th", "_pos", ascii_lower(stripped).alias("_key"))
        .select("_id", "_th", "_pos", F.xxhash64("_key").alias("_h1"), F.hash("_key").alias("_h2"), F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_salt"))
        .withColumn("_range", _range(F.xxhash64("_h1", "_salt"), n))
        .repartitionById(n, "_range")
    )
    stream = Window.partitionBy("_range", "_h1", "_salt", "_h2").orderBy(F.asc_nulls_last("_id"), "_pos")
    so_far = (Window.unboundedPreceding, 0)
    seen = rows.withColumn("_first", F.first("_id").over(stream.rowsBetween(*so_far)))
    # Within a salt, later documents are repeats. The first of each salt then meet: at most `salts` documents a key.
    late = seen.where(F.col("_id") > F.col("_first")).select("_id", "_th", "_pos")
    early = seen.where(F.coalesce(F.col("_id") == F.col("_first"), F.lit(False))).select("_id", "_th", "_pos", "_h1", "_h2", _range(F.col("_h1"), n).alias("_range")).repartitionById(n, "_range")
    meet = Window.partitionBy("_range", "_h1", "_h2").orderBy("_id", "_pos")
    early = early.withColumn("_first", F.first("_id").over(meet.rowsBetween(*so_far)))
    dropped = late.unionByName(early.where(F.col("_id") > F.col("_first")).select("_id", "_th", "_pos"))
    bit = F.expr(f"shiftleft(1L, _pos % {WORD})")
    return (
        dropped.repartition(n, "_id", "_th")
        .groupBy("_id", "_th", F.floor(F.col("_pos") / WORD).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .groupBy("_id", "_th")
        .agg(F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"), F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits"))).alias("keep"))
    )


def _range(h: Column, n: int) -> Column:
    """The number of the range, of n equal ones, that a uniform 64-bit hash lies in."""
    return F.shiftright(F.shiftrightunsigned(h, 33) * F.lit(n), 31).cast("int")


def drop_lines(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """df with _n_lines, _n_dropped and _kept, the text without its repeated lines.

    A null or empty text counts as one empty line and stays. Rows alike in id and text get the same, rows
    without an id keep all lines, and an empty table gives an empty result. A long text costs its length.
    Columns of df under one of the three names are replaced; other names cannot clash. df is read twice.
    """
    maps = keep_bitmaps(df, text=text, doc_id=doc_id, **how).select(F.col("_id").alias("_id2"), F.col("_th").alias("_th2"), F.col("keep").alias("_keep"), F.col("n_dropped").alias("_gone"))
    given = Aside(df)
    t = whole(given.of(text))
    rows = given.df.withColumn("_th", F.xxhash64(t))
    gone = F.expr(
        f"flatten(transform(_keep, k -> transform(filter(sequence(0, {WORD - 1}), b -> getbit(k.bits, b) = 0), b -> k.word * {WORD} + b)))"
    )
    joined = rows.join(maps, given.of(doc_id).eqNullSafe(F.col("_id2")) & (F.col("_th") == F.col("_th2")), "left")
    split = joined.select(*given.own, "_keep", "_gone", _lines(t).alias("_lines"))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), gone), lambda i: F.col("_lines")[i])
    made = split.select(
        *given.own,
        F.size("_lines").cast("long").alias("_a"),
        F.coalesce("_gone", F.lit(0)).cast("long").alias("_b"),
        F.when(F.col("_keep").isNull(), t).otherwise(F.array_join(left, "\n")).alias("_c"),
    )
    return made.select(*given.back("_n_lines", "_n_dropped", "_kept"), F.col("_a").alias("_n_lines"), F.col("_b").alias("_n_dropped"), F.col("_c").alias("_kept"))


def op8_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_lines(docs).select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("_kept", 256).alias("kept_sha256"))


OP8_SQL = """
WITH lines AS (
  SELECT doc_id, pos, l, lower_key FROM (
    SELECT doc_id, pos, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_key
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
                 unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents))),
first AS (SELECT lower_key, min(doc_id) AS first_id FROM lines WHERE length(lower_key) >= 10 GROUP BY 1),
flagged AS (
  SELECT l.*, coalesce(l.doc_id > f.first_id, false) AS gone
  FROM lines l LEFT JOIN first f ON l.lower_key = f.lower_key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""
