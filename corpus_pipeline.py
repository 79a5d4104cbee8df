"""From documents to token ids: quality rules, repeated lines, near copies, benchmark passages, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import bpe, common, decontamination, line_dedup, near, quality
from sparkloom.llm.common import Aside

#: Lines, groups and token ids have no common SQL; the tests hold every stage against a plain version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules themselves and whose host is not rejected.

    Null and empty texts have no words and so go. Repeated rows and ties are judged each for itself, null hosts
    as one host; a long text costs n log n; of an empty table nothing is left. Other columns stay, whatever
    their names.
    """
    kept = Aside(docs)
    measured = quality.rule_metrics(kept.df.select("*", kept.of("source").alias("host"), kept.of("text").alias("text")))
    rows = common.land(measured.select(*kept.own, "host", F.col("_m.base_failed").alias("failed")))
    return quality.judged(rows, host="host", failed="failed").where("_kept").select(*kept.back())


def line_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one holds; n_chars, where there is one, counts what is left.

    A null text becomes an empty one. Rows alike in id and text lose the same lines, rows without an id none; a
    long text costs its length; an empty table stays one. Other columns stay, whatever their names.
    """
    kept = Aside(docs)
    left = line_dedup.drop_lines(kept.df.select("*", kept.of("text").alias("text"), kept.of("doc_id").alias("doc_id")))
    new = {"text": F.col("_kept"), "n_chars": F.length("_kept").cast("long")}
    return left.select(*[new.get(n.lower(), F.col(c)).alias(n) for c, n in zip(kept.own, kept.names, strict=True)])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that five-word shingles with a similarity of 0.8 or more tie together.

    Texts without words, null ones too, are one group. Rows without an id stay; of rows with one id one stays,
    repeated or not. A long text costs its length; an empty table stays one. Other columns stay, whatever
    their names.
    """
    return near.drop_alike(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    Null and empty texts hold none and stay. Rows alike in id and text go or stay together; a long text costs
    its length; an empty table stays one. Other columns stay, whatever their names.
    """
    return decontamination.drop_overlaps(docs, common.table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (uint32, little-endian) and the digest of the bytes that they decode to, for each row.

    Null and empty texts have no ids, repeated rows stay, a long text costs its length, an empty table stays
    one. Other columns are not read.
    """
    kept = Aside(docs)
    return bpe.encode(kept.df.select(kept.of("doc_id").alias("doc_id"), kept.of("text").alias("text")), texts=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_removal),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", decontaminated),
    ("byte_bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents; each reads what the one before it wrote to the shared folder.

    A run has folders of its own, so that runs side by side do not meet. What a stage wrote is removed when
    the next one has written its own, and what it needed on the way with it; the last such table stays, for the result reads it.
    """
    docs, kept = common.table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        before, kept = kept, common.Scratch(spark)
        with common.scratch(spark):
            docs = kept.land(stage(spark, docs, sf_dir))
        if before:
            before.remove()
    return STAGES[-1][1](spark, docs, sf_dir)
