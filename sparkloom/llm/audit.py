"""How filters act on each other: what each removes in any order, alone, and for nothing."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Aside, cut, if_small, table, whole, words

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: A text that more than one in so many rows have is joined by broadcast; there are fewer such texts than that.
HOT = 1000
#: Rows without an id, which no label fits, are dealt over so many keys.
SPREAD = 64


def contract_filters(text: Column) -> dict[str, Column]:
    """A to D of the query, by letter; E needs the whole table, see repeats."""
    w = F.col("_w")
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(w) < 50,
        "B": 100 * F.size(F.array_distinct(w)) < 65 * F.size(w),
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", part: str = "source") -> DataFrame:
    """_id, _part, _digest and _mask (bit k: the k-th of contract_filters fails) for each row. Texts end here; no exchange."""
    given = Aside(df)
    t = whole(given.of(text))
    rows = given.df.select(given.of(doc_id).alias("_id"), F.coalesce(given.of(part), F.lit("")).alias("_part"), t.alias("_t"), words(t).alias("_w"))
    bits = [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(contract_filters(F.col("_t")).values())]
    return rows.select("_id", "_part", F.unhex(F.sha2("_t", 256)).alias("_digest"), sum(bits[1:], bits[0]).alias("_mask"))


def repeats(rows: DataFrame) -> DataFrame:
    """rows (_id, _digest and others, a checkpoint) with _again: whether a smaller id has the same digest.

    A digest that more than one in HOT rows has is looked up in a broadcast table, which has fewer rows than
    HOT; the others, whose groups are small, are joined. A null id is never smaller nor larger. Rows alike
    in id and text are not smaller than each other.
    """
    groups = cut(rows.groupBy("_digest").agg(F.min("_id").alias("_least"), F.max("_id").alias("_most"), F.count(F.lit(1)).alias("_n")).where("_least < _most"))
    hot = F.broadcast(groups.where(F.col("_n") > rows.count() / HOT).select(F.col("_digest").alias("_digest2"), "_least"))
    cold = groups.where(F.col("_n") <= rows.count() / HOT).select(F.col("_digest").alias("_digest2"), "_least")
    same = F.col("_digest") == F.col("_digest2")
    again = F.coalesce(F.col("_id") > F.col("_least"), F.lit(False)).alias("_again")
    few = rows.join(hot, same, "left_anti").join(cold, same, "left")
    return few.select(*rows.columns, again).unionByName(rows.join(hot, same).select(*rows.columns, again))


def labelled(rows: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """rows with _good and _toxic, never null: what any label of the id says. Null ids have none."""
    given = Aside(labels)
    says = lambda name: F.coalesce(F.max(given.of(name) == 1), F.lit(False))
    known = given.df.where(given.of(doc_id).isNotNull()).groupBy(given.of(doc_id).alias("_id2")).agg(says(quality).alias("_g"), says(toxic).alias("_x"))
    spread = F.when(F.col("_id").isNull(), F.pmod(F.xxhash64("_digest"), F.lit(SPREAD)) + 1).otherwise(0)
    known = if_small(cut(known)).withColumn("_z2", F.lit(0).cast("long"))
    joined = rows.withColumn("_z", spread.cast("long")).join(known, (F.col("_id") == F.col("_id2")) & (F.col("_z") == F.col("_z2")), "left")
    return joined.select(*rows.columns, F.coalesce("_g", F.lit(False)).alias("_good"), F.coalesce("_x", F.lit(False)).alias("_toxic"))


def audit(cells: DataFrame, names: str, orders: list[str] | None = None) -> DataFrame:
    """part, filter_order, step, filter, MEASURES and shapley of cells: part, mask, n, good, toxic.

    Bit k of a mask says that filter names[k] fails; a part's masks need not differ. Every order of the
    filters is one of `orders` (all, if none are given), a text of names. All masks are laid against the
    steps of all orders; over the steps of an order a running bit_or holds the filters that failed before,
    so that each row knows whether its filter removes, comes too late or keeps. That table depends on the
    number of filters alone (2**5 * 120 * 5 rows for five), is worked out once, and meets the cells by
    their masks; sums by part, order and step follow, and for shapley sums over the orders of each part and
    filter. A part has as many rows as orders have steps, however many documents it has. No cells, no rows.
    """
    spark = cells.sparkSession
    orders = orders or ["".join(p) for p in permutations(names)]
    steps = spark.createDataFrame([(o, k + 1, f, 1 << names.index(f)) for o in orders for k, f in enumerate(o)], "filter_order string, step int, filter string, _bit int")
    long = steps.select("*", F.explode(F.sequence(F.lit(0), F.lit((1 << len(names)) - 1))).alias("_mask"))
    before = Window.partitionBy("filter_order", "_mask").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    hit = F.col("_mask").bitwiseAND(F.col("_bit"))
    judged = long.select("*", hit.alias("_hit"), F.coalesce(F.bit_or(hit).over(before), F.lit(0)).alias("_before"))
    fails, first = F.col("_hit") != 0, F.col("_before") == 0
    flags = {"_kept": first & ~fails, "_removed": first & fails, "_redundant": fails & ~first, "_alone": F.col("_mask") == F.col("_bit")}
    told = cut(judged.select("filter_order", "step", "filter", "_mask", *[c.alias(n) for n, c in flags.items()]))
    summed = cells.groupBy("part", F.col("mask").alias("_mask")).agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    total = lambda flag, c: F.sum(F.when(F.col(flag), F.col(c)).otherwise(0)).cast("long")
    measures = (("_kept", "n"), ("_removed", "n"), ("_redundant", "n"), ("_alone", "n"), ("_removed", "good"), ("_removed", "toxic"))
    out = summed.join(if_small(told), "_mask").groupBy("part", "filter_order", "step", "filter").agg(*[total(*m).alias(n) for m, n in zip(measures, MEASURES, strict=True)])
    every = Window.partitionBy("part", "filter")
    return out.select("part", "filter_order", "step", "filter", *MEASURES, F.sum("removed").over(every).alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", part: str = "source") -> DataFrame:
    """audit of the filters A to E over docs, by part.

    Null and empty texts have no words and no characters: they fail A, and E if a smaller id has one; a null
    part is the empty text's. Rows without an id have no labels and repeat nothing; repeated rows count each.
    A long text costs its length, an empty table gives an empty result. Other columns are not read, so
    their names cannot clash. What is exchanged are ids, digests and masks; a part that holds a third of
    all rows is summed where its rows are, and so is a text with many copies, see repeats.
    """
    rows = cut(failures(docs, text=text, doc_id=doc_id, part=part))
    full = labelled(repeats(rows), labels)
    mask = F.col("_mask") + F.when(F.col("_again"), 16).otherwise(0)
    counts = [F.count(F.lit(1)).alias("n"), F.count_if("_good").alias("good"), F.count_if("_toxic").alias("toxic")]
    return audit(full.groupBy(F.col("_part").alias("part"), mask.alias("mask")).agg(*counts), "ABCDE")


def op13_filter_audit(spark, sf_dir):
    return audit_filters(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels"))


_ORDERS = ", ".join(f"('{''.join(p)}')" for p in permutations("ABCDE"))
OP13_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT doc_id, part, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
             100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c,
             regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > least, false) AS e FROM w),
l AS (SELECT doc_id, coalesce(max(quality) FILTER (quality = 1), 0) = 1 AS good, coalesce(max(toxic) FILTER (toxic = 1), 0) = 1 AS toxic FROM labels GROUP BY doc_id),
g AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed,
             coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM f LEFT JOIN l USING (doc_id)),
m AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM g GROUP BY ALL),
s AS (SELECT o AS filter_order, CAST(k AS INT) AS step, o[k] AS filter, o[:k - 1] AS earlier FROM (VALUES {_ORDERS}) v(o), range(1, 6) r(k)),
j AS (SELECT part, filter_order, step, filter, n, good, toxic, contains(failed, filter) AS fails, failed = filter AS alone, earlier <> '' AND regexp_matches(failed, '[' || earlier || '0]') AS late FROM m, s),
x AS (SELECT part, filter_order, step, filter, CAST(coalesce(sum(n) FILTER (NOT fails AND NOT late), 0) AS BIGINT) AS kept,
             CAST(coalesce(sum(n) FILTER (fails AND NOT late), 0) AS BIGINT) AS removed, CAST(coalesce(sum(n) FILTER (fails AND late), 0) AS BIGINT) AS redundant,
             CAST(coalesce(sum(n) FILTER (alone), 0) AS BIGINT) AS unique_fails, CAST(coalesce(sum(good) FILTER (fails AND NOT late), 0) AS BIGINT) AS good_lost,
             CAST(coalesce(sum(toxic) FILTER (fails AND NOT late), 0) AS BIGINT) AS toxic_lost FROM j GROUP BY ALL)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM x
"""
