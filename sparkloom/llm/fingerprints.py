"""Fingerprints of documents as sums of their paragraphs' vectors: the order does not matter, and paragraphs can be added and taken away."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import if_small, land, only, table, whole, words

#: Lanes are numbers modulo 2**32. The first EXACT tell multisets of paragraphs apart; each shingle adds 1 or -1 to each of the others.
MASK = (1 << 32) - 1
EXACT, LIKE = 8, 128
#: Words of a paragraph's shingles.
WORDS = 3
_BOTH = (1 << 32) + 1


def paragraph_vectors(rows: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """keys and _lanes, the sum of the vectors of the text's paragraphs, for each combination of the keys.

    A paragraph is a line that is not empty, as it stands. Its vector has EXACT lanes from four hashes of all
    of it, and LIKE lanes that count, up or down by the bits of a shingle's hashes, its runs of three words
    (fewer words: one run of all; none: no run). Two bits of a hash are counted in one long, 32 bits apart.
    """
    lines = rows.select(*keys, F.explode(F.split(F.col(text), "\n", -1)).alias("_line"))
    split = lines.select(*keys, "_line", words(F.col("_line")).alias("_w"))
    runs = F.expr(
        f"CASE WHEN size(_w) >= {WORDS} THEN transform(sequence(0, size(_w) - {WORDS}), i -> xxhash64({', '.join(f'_w[i + {k}]' for k in range(WORDS))}))"
        " WHEN size(_w) = 2 THEN array(xxhash64(_w[0], _w[1])) WHEN size(_w) = 1 THEN array(xxhash64(_w[0])) END"
    )
    whole_ = [F.xxhash64(F.lit(str(k)), "_line").alias(f"_x{k}") for k in range(EXACT // 2)]
    each = split.select(*keys, (F.col("_line") != "").alias("_there"), *whole_, F.posexplode_outer(runs).alias("_p", "_h0"))
    both = each.select(*keys, (F.col("_there") & (F.coalesce("_p", F.lit(0)) == 0)).alias("_once"), *[f"_x{k}" for k in range(EXACT // 2)], "_h0", F.xxhash64("_h0").alias("_h1"))
    run = F.col("_h0").isNotNull()
    exact = [F.when(F.col("_once"), F.shiftrightunsigned(f"_x{k}", 32 * half).bitwiseAND(MASK)).otherwise(0) for k in range(EXACT // 2) for half in (0, 1)]
    bits = [F.when(run, F.shiftrightunsigned(f"_h{k}", b).bitwiseAND(_BOTH)).otherwise(0) for k in range(LIKE // 64) for b in range(32)]
    sums = [*exact, *bits, run.cast("long")]
    got = both.groupBy(*keys).agg(*[F.sum(c).alias(f"_s{k}") for k, c in enumerate(sums)])
    counts = [F.shiftrightunsigned(f"_s{EXACT + 32 * k + b % 32}", 32 * (b // 32)).bitwiseAND(MASK) for k in range(LIKE // 64) for b in range(64)]
    lanes = [F.col(f"_s{k}") for k in range(EXACT)] + [2 * c - F.col(f"_s{len(sums) - 1}") for c in counts]
    return got.select(*keys, F.array(*[c.bitwiseAND(MASK) for c in lanes]).alias("_lanes"))


def nothing() -> Column:
    """The fingerprint of no paragraphs."""
    return F.array_repeat(F.lit(0).cast("long"), EXACT + LIKE)


def plus(a: Column, b: Column) -> Column:
    """The fingerprint of both together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(MASK))


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of a without the paragraphs of b, which a must hold."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(MASK))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine that the lanes of shingles estimate, within about 0.09; 1 for equal fingerprints, 0 where one has no words."""
    signed = lambda x: F.when(x > MASK >> 1, x - (MASK + 1)).otherwise(x).cast("double")
    of = lambda c: F.transform(F.slice(c, EXACT + 1, LIKE), signed)
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(of(a), of(a)) * dot(of(b), of(b)))
    return F.when(a == b, 1.0).when(size == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(of(a), of(b)) / size)))


def hexadecimal(lanes: Column) -> Column:
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def fingerprints(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """_id and _lanes for each row of df.

    Null and empty texts have the fingerprint of nothing. Repeated rows and tied ids are rows like any other.
    A long text costs its length; texts are not exchanged, but one row of sums for each. An empty table
    gives an empty result; other columns are not read, so their names cannot clash.
    """
    rows = only(df, _id=doc_id, _t=text).select(F.monotonically_increasing_id().alias("_row"), "_id", whole("_t").alias("_t"))
    return paragraph_vectors(rows, ["_row", "_id"], "_t").drop("_row")


def in_turn(docs: DataFrame) -> DataFrame:
    """The order of docs' (_id, _h, _n), rows alike in both once: _k, _z and _h (an exact key of non-null values), _n, _times, the key and _n of the one before (_pk, _pz, _ph, _pn).

    Ids rise, nulls come last, ties go by the texts' hashes; before the first stands the last. Rows are sorted
    by ranges in many tasks and numbered by what each of these holds; no task sees all.
    """
    key = [F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("_k"), F.col("_id").isNull().alias("_z"), "_h"]
    once = docs.groupBy("_id", "_h").agg(F.first("_n").alias("_n"), F.count(F.lit(1)).alias("_times"))
    sorted_ = land(once.orderBy(F.col("_id").asc_nulls_last(), "_h").select(*key, "_n", "_times", F.monotonically_increasing_id().alias("_at")))
    task = F.shiftright("_at", 33)
    counts = sorted_.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_c"))  # a row for each task
    starts = counts.select("_task", (F.sum("_c").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))).alias("_start"))
    total = sorted_.count()
    place = F.coalesce("_start", F.lit(0)) + F.col("_at").bitwiseAND((1 << 33) - 1)
    rows = sorted_.join(F.broadcast(starts), task == F.col("_task")).select("_k", "_z", "_h", "_n", "_times", place.alias("_place"))
    before = rows.select(F.pmod(F.col("_place") + 1, F.lit(max(total, 1))).alias("_place"), *[F.col(f"_{c}").alias(f"_p{c}") for c in "kzhn"])
    return rows.join(before, "_place")


def edits(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """_id, n_chars, edited_sha256, _lanes, _edited_lanes and _next_lanes for each row of df: the last floor(n_chars / 4) characters are replaced by the first as many, or all, of the next document.

    The edited text's fingerprint is the document's without the paragraphs from the cut on, and with those
    that stand there now; the paragraphs before the cut are summed once for both. Documents stand in the
    order of in_turn; rows alike in id and text have one place there and equal results, as many as there are
    rows. A document alone follows itself. Null and empty texts have no paragraphs and stay as they are; a
    long text costs its length. An empty table gives an empty result. Other columns are not read. Each text
    is exchanged once, each beginning once, and after that fingerprints alone.
    """
    docs = only(df, _id=doc_id, _t=text).select("_id", F.xxhash64(whole("_t")).alias("_h"), whole("_t").alias("_t"))
    turn = land(in_turn(docs.select("_id", "_h", F.length("_t").cast("long").alias("_n"))))
    keyed = docs.select("_id", "_h", "_t", F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("_k"), F.col("_id").isNull().alias("_z"))
    if not turn.where("_times > 1").isEmpty():
        keyed = keyed.dropDuplicates(["_k", "_z", "_h"])
    rows = keyed.join(if_small(turn), ["_k", "_z", "_h"])
    moved = lambda n: F.floor(F.col(n) / 4).cast("int")
    heads = rows.select(F.col("_pk").alias("_k"), F.col("_pz").alias("_z"), F.col("_ph").alias("_h"), F.substr("_t", F.lit(1), moved("_pn")).alias("_head"))
    both = rows.join(heads.hint("merge"), ["_k", "_z", "_h"])
    kept = both.select("*", F.substr("_t", F.lit(1), (F.col("_n") - moved("_n")).cast("int")).alias("_kept"))
    # The cut may fall inside a paragraph: what of it stays is its tail.
    cut_ = kept.select("*", F.substring_index("_kept", "\n", -1).alias("_tail"), F.substr("_t", (F.col("_n") - moved("_n") + 1).cast("int")).alias("_gone"))
    before = F.substr("_kept", F.lit(1), F.length("_kept") - F.length("_tail"))
    texts = F.array(before, F.concat("_tail", "_gone"), F.concat("_tail", "_head"))
    own = ["_k", "_z", "_h", "_pk", "_pz", "_ph", "_id", "_n", "_times", "_sha"]
    pieces = cut_.withColumn("_sha", F.sha2(F.concat("_kept", "_head"), 256)).select(*own, F.posexplode(texts).alias("_part", "_text"))
    sums = paragraph_vectors(pieces, [*own, "_part"], "_text")
    part = lambda k: F.max_by("_lanes", F.when(F.col("_part") == k, 1)).alias(f"_l{k}")
    rows = sums.groupBy(*own).agg(part(0), part(1), part(2)).select(*own, plus(F.col("_l0"), F.col("_l1")).alias("_lanes"), "_l1", "_l2")
    rows = rows.select("*", plus(minus(F.col("_lanes"), F.col("_l1")), F.col("_l2")).alias("_edited"))
    # A document's fingerprint goes to its own place and to that of the one before.
    facts = ("_id", "_n", "_times", "_sha", "_edited")
    mine = F.struct(F.col("_k"), F.col("_z"), F.col("_h"), F.struct("_lanes", *facts).alias("_own"), F.lit(None).cast("array<bigint>").alias("_next"))
    other = F.struct(F.col("_pk").alias("_k"), F.col("_pz").alias("_z"), F.col("_ph").alias("_h"), F.lit(None).cast(rows.select(F.struct("_lanes", *facts).alias("s")).schema[0].dataType).alias("_own"), F.col("_lanes").alias("_next"))
    sent = rows.select(F.inline(F.array(mine, other)))
    met = sent.groupBy("_k", "_z", "_h").agg(F.max_by("_own", F.when(F.col("_own").isNotNull(), 1)).alias("_own"), F.max_by("_next", F.when(F.col("_next").isNotNull(), 1)).alias("_next"))
    out = met.select(F.explode(F.array_repeat("_own", F.col("_own._times").cast("int"))).alias("_own"), "_next")
    return out.select("_own._id", F.col("_own._n").alias("n_chars"), F.col("_own._sha").alias("edited_sha256"), "_own._lanes", F.col("_own._edited").alias("_edited_lanes"), F.col("_next").alias("_next_lanes"))


def op12_fingerprints(spark, sf_dir):
    got = edits(table(spark, sf_dir, "documents"))
    near = [likeness(F.col("_lanes"), F.col(f"_{x}_lanes")).alias(f"near_{x}") for x in ("edited", "next")]
    return got.select(F.col("_id").alias("doc_id"), "n_chars", "edited_sha256", hexadecimal(F.col("_lanes")).alias("fingerprint"), hexadecimal(F.col("_edited_lanes")).alias("edited_fingerprint"), *near)
