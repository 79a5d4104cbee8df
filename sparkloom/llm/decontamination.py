"""Training documents that hold passages of a benchmark, some words changed or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Aside, col, cut, if_small, only, table, whole

#: The words of a seed, from its start; those between are ignored. Any 8 to 13 words of which a fifth at most
#: are changed still hold a seed of one of these two, as a test finds by trying all ways to change them.
MASKS = ((0, 1, 2, 4), (0, 2, 5, 6))


def benchmark_words(c: Column) -> Column:
    """Runs of letters and digits in lower case."""
    clean = F.btrim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def _span(mask: tuple[int, ...]) -> int:
    return mask[-1] + 1


def _seeds(w: str) -> Column:
    """Hashes of all seeds of the words in column w: those of the first mask by position, then those of the next."""
    each = []
    for k, mask in enumerate(MASKS):
        at = ", ".join(f"{w}[i + {m}]" if m else f"{w}[i]" for m in mask)
        each.append(f"CASE WHEN size({w}) >= {_span(mask)} THEN transform(sequence(0, size({w}) - {_span(mask)}), i -> xxhash64({at}, {k})) ELSE CAST(array() AS array<bigint>) END")
    return F.expr(f"concat({', '.join(each)})")


def _place(n: Column, at: Column) -> Column:
    """The position of a seed among n words from its place in the array of _seeds."""
    first = F.greatest(n - (_span(MASKS[0]) - 1), F.lit(0))
    return F.when(at < first, at).otherwise(at - first)


def _bytes(df: DataFrame, words_: str) -> int:
    """About what rows with these words take in memory."""
    return df.agg(F.coalesce(F.sum(64 + 40 * F.size(words_) + F.octet_length(F.array_join(words_, ""))), F.lit(0))).first()[0]


def find_overlaps(
    df: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = 13,
    least: float = 0.8,
    min_words: int = 5,
    verbatim_below: int = 8,
    broadcast_bytes: int = 64 << 20,
    salts: int = 8,
) -> DataFrame:
    """A row for each document and item that overlap: _id, _th, item_id, start, matched, window.

    They overlap if, in some alignment, `window` consecutive words of the item (all, if it is shorter) agree
    with the document's in the share `least`; of items under verbatim_below words all must agree. With the
    values given here seeds miss none of these. start is the place of the item's first word among the
    document's words (below 0 if the document begins later), matched the most words of a window that agree;
    of alignments that agree as well, the first.

    A document is an id and a text, an item is an id and its words: repeated rows are one each, an id that
    several texts have stands for each of them in rows of their own, a null id is an id like any other.
    Null or empty texts, items of under min_words words and empty tables give no rows. A long text costs
    its length, and a shared passage one comparison for each alignment. Other columns are not read, so
    their names do not matter.

    Seeds are 64-bit hashes. The benchmark's are broadcast if they are measured at broadcast_bytes or less;
    a larger benchmark is joined by an exchange of seeds, in which each is spread over `salts` keys.
    """
    items = only(benchmark, _item=item_id, _bt=item_text).select("_item", benchmark_words(whole("_bt")).alias("_bw")).where(F.size("_bw") >= min_words).distinct()
    items = cut(items.withColumn("_bh", F.xxhash64("_bw")))
    tests = items.select("_item", "_bh", F.size("_bw").alias("_bn"), _seeds("_bw").alias("_seeds")).select("_item", "_bh", "_bn", F.posexplode("_seeds").alias("_k", "_seed"))
    tests = tests.select("_item", "_bh", _place(F.col("_bn"), F.col("_k")).alias("_bpos"), "_seed")
    docs = only(df, _id=doc_id, _t=text).select("_id", whole("_t").alias("_t")).select("_id", "_t", F.xxhash64("_t").alias("_th"))
    worded = docs.select("_id", "_th", benchmark_words(F.col("_t")).alias("_w"))
    # explode_outer: for a plain explode Spark infers a filter on the array's size, which computes it again.
    # Words end before the seeds are dealt out, as else each seed's row would carry all of them.
    rows = worded.select("_id", "_th", F.size("_w").alias("_n"), _seeds("_w").alias("_seeds")).select("_id", "_th", "_n", F.posexplode_outer("_seeds").alias("_k", "_seed"))
    weight = tests.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col("_item").cast("string"))), F.lit(0))).first()
    if 48 * weight[0] + weight[1] <= broadcast_bytes:
        met = rows.join(F.broadcast(tests), "_seed")
    else:
        spread = tests.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = rows.withColumn("_salt", F.pmod(F.xxhash64("_id", "_k"), F.lit(salts)).cast("int")).join(spread, ["_seed", "_salt"])
    shift = _place(F.col("_n"), F.col("_k")) - F.col("_bpos")
    # Each alignment once, however many seeds it has, and where in the item these are.
    hits = met.groupBy("_id", "_th", "_item", "_bh", shift.alias("_shift")).agg(F.min("_bpos").alias("_from"), F.max("_bpos").alias("_to"))
    hits = cut(hits)
    named = hits.select(F.col("_id").alias("_id2"), F.col("_th").alias("_th2")).distinct()
    found = docs.join(if_small(cut(named)), F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_th") == F.col("_th2")), "left_semi")
    found = found.select(F.col("_id").alias("_id2"), F.col("_th").alias("_th2"), "_t").distinct().select("_id2", "_th2", benchmark_words(F.col("_t")).alias("_w"))
    known = items.withColumnsRenamed({"_item": "_item2", "_bh": "_bh2"})
    pairs = hits.join(found, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_th") == F.col("_th2")))
    pairs = pairs.join(F.broadcast(known) if _bytes(known, "_bw") <= broadcast_bytes else known, F.col("_item").eqNullSafe(F.col("_item2")) & (F.col("_bh") == F.col("_bh2")))
    # A window with enough words holds a seed, so what counts lies within a window of the first and the last hit.
    size = F.least(F.lit(window), F.size("_bw"))
    begin = F.greatest(F.lit(0), F.col("_from") - F.lit(window - 1))
    end = F.least(F.size("_bw"), F.col("_to") + F.lit(window + max(map(_span, MASKS)) - 1))
    aligned = pairs.select("_id", "_th", "_item", "_bh", "_shift", size.alias("_size"), F.size("_bw").alias("_bn"), "_w", F.slice("_bw", begin + 1, end - begin).alias("_bw"), (F.col("_shift") + begin).alias("_at"))
    same = F.expr("transform(sequence(0, size(_bw) - 1), j -> CASE WHEN _at + j >= 0 AND _at + j < size(_w) AND get(_w, _at + j) = _bw[j] THEN 1 ELSE 0 END)")
    compared = aligned.select("_id", "_th", "_item", "_bh", "_shift", "_size", "_bn", same.alias("_same"))
    most = F.expr(
        "aggregate(sequence(0, size(_same) - 1), named_struct('now', 0, 'most', 0), (a, j) -> named_struct("
        "'now', a.now + _same[j] - CASE WHEN j >= _size THEN get(_same, j - _size) ELSE 0 END,"
        "'most', greatest(a.most, a.now + _same[j] - CASE WHEN j >= _size THEN get(_same, j - _size) ELSE 0 END)), a -> a.most)"
    )
    # The threshold comes after the aggregate: before it, Spark would compute the comparison once more for it.
    rank = F.struct(most.cast("long").alias("matched"), (-F.col("_shift")).cast("long").alias("back"))
    best = compared.groupBy("_id", "_th", "_item", "_bh", "_size", "_bn").agg(F.max(rank).alias("_rank"))
    enough = F.when(F.col("_bn") < verbatim_below, F.col("_bn")).otherwise(F.ceil(F.lit(least) * F.col("_size")))
    made = best.select("_id", "_th", F.col("_item").alias("item_id"), (-F.col("_rank.back")).alias("start"), F.col("_rank.matched").alias("matched"), F.col("_size").cast("long").alias("window"), enough.alias("_enough"))
    return made.where(F.col("matched") >= F.col("_enough")).drop("_enough")


def drop_overlaps(df: DataFrame, benchmark: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """The rows of df without those that find_overlaps names. Columns stay as they are, under whatever names.

    Rows alike in id and text go or stay together; of rows alike in id alone only those with a passage go. A
    null or empty text holds none and stays. An empty table, or an empty benchmark, gives df as it is.
    """
    bad = cut(find_overlaps(df, benchmark, text=text, doc_id=doc_id, **how).select("_id", "_th").distinct())
    given = Aside(df)
    rows = given.df.withColumn("_th2", F.xxhash64(whole(given.of(text))))
    clean = rows.join(if_small(bad), given.of(doc_id).eqNullSafe(F.col("_id")) & (F.col("_th2") == F.col("_th")), "left_anti")
    return clean.select(*given.back())


def op9_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_overlaps(docs, table(spark, sf_dir, "benchmark")).select(F.col("_id").alias("doc_id"), "item_id", "start", "matched", "window")


# Not by the masks: of 5 words that all agree, or of 8 to 13 of which a fifth differ, three in a row agree.
OP9_SQL = r"""
WITH d AS (SELECT doc_id, [x FOR x IN string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') IF x <> ''] AS w FROM documents),
b AS (SELECT * FROM (SELECT DISTINCT item_id, [x FOR x IN string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') IF x <> ''] AS w FROM benchmark) WHERE len(w) >= 5),
ds AS (SELECT *, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT *, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d)),
bs AS (SELECT *, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM b)),
h AS (SELECT DISTINCT ds.doc_id, bs.item_id, ds.w AS dw, bs.w AS bw, ds.i - bs.i AS sh FROM ds JOIN bs ON ds.s = bs.s),
e AS (SELECT doc_id, item_id, dw, bw, sh, least(13, len(bw)) AS z, [CASE WHEN sh + j >= 1 AND sh + j <= len(dw) AND dw[sh + j] = bw[j] THEN 1 ELSE 0 END FOR j IN range(1, len(bw) + 1)] AS m FROM h),
r AS (SELECT doc_id, item_id, dw, bw, sh, z, list_max([list_sum(m[j:j + z - 1]) FOR j IN range(1, len(m) - z + 2)]) AS most FROM e),
g AS (SELECT *, row_number() OVER (PARTITION BY doc_id, dw, item_id, bw ORDER BY most DESC, sh) AS n FROM r WHERE most >= CASE WHEN len(bw) < 8 THEN len(bw) ELSE ceil(0.8 * z) END)
SELECT doc_id, item_id, CAST(sh AS BIGINT) AS start, CAST(most AS BIGINT) AS matched, CAST(z AS BIGINT) AS "window" FROM g WHERE n = 1
"""
