"""Secrets in texts: known forms, and strings that look random."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Aside, table, whole

# The forms of the contract. For access and hex a run of the least length is the same match.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Candidate strings for the entropy test; any other string of these characters is shorter.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
WINDOW = 20
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-"
#: By what a whole candidate consists of, the first that fits: the bits a character that a window must reach, and
#: its changes between digits, small letters, capitals and signs, where one from or to a digit counts as three.
#: Names and paths have long runs of letters, and digits at their end. Digits alone are never a secret.
CLASSES = (
    ("^[0-9]+$", None, None),
    ("^(?:[a-z]+|[A-Z]+)$", 4.0, 0),
    ("^[0-9A-Fa-f]+$", 3.0, 12),
    ("^(?:[0-9a-z]+|[0-9A-Z]+)$", 3.5, 12),
    ("^[A-Za-z]+$", 3.8, 12),
    ("", 3.6, 14),
)
#: Candidates that are random in form only: UUIDs, alphabets and counts in order, and those with a word for a sample between signs.
ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    r"|^(?:(?:abcdefghijklmnopqrstuvwxyz|zyxwvutsrqponmlkjihgfedcba|qwertyuiop|asdfghjkl|zxcvbnm|0123456789|1234567890)[+/_-]*)+$"
    r"|(?:^|[+/_-])(?:example|sample|placeholder|changeme|dummy)(?:$|[+/_-])"
)


def _found(t: Column, pattern: str, kind: str, least_value: int = 0) -> Column:
    """array<struct<start, kind, end>> of the matches, in code points; kind is an index into KINDS.

    The texts between matches, with the matches, give the places. least_value: of group 2's length.
    """
    matches = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(t, F.lit(pattern), F.lit(2)) if least_value else matches
    lens = F.transform(F.arrays_zip(F.split(t, pattern, -1).alias("g"), matches.alias("m"), values.alias("v")), lambda x: F.struct(F.length(x["g"]).alias("g"), F.length(x["m"]).alias("m"), F.length(x["v"]).alias("v"), x["m"].alias("s")))
    first = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,kind:int,end:int,s:string>>)").alias("out"))
    k = F.lit(KINDS.index(kind))

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["g"]
        end = start + F.coalesce(x["m"], F.lit(0))
        new = F.when(x["m"].isNotNull() & (x["v"] >= least_value), F.concat(a["out"], F.array(F.struct(start.alias("start"), k.alias("kind"), end.alias("end"), x["s"].alias("s"))))).otherwise(a["out"])
        return F.struct(end.alias("at"), new.alias("out"))

    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int,s:string>>)")
    return F.when(t.rlike(pattern), F.aggregate(lens, first, step, lambda a: a["out"])).otherwise(none)


def _random(s: str) -> str:
    """SQL for whether some window of WINDOW characters of s has the entropy and the changes of s's class.

    With n a character's count, a window's entropy is log2(W) - sum(n log2 n) / W. The counts of all characters
    are the state that moves along s: each step takes from one and adds to another, and the sum follows from
    these two counts alone. Changes between classes of characters move along in the same way.
    """

    def by_class(values: list) -> str:
        return "CASE " + " ".join(f"WHEN {s} RLIKE '{c[0]}' THEN {'NULL' if v is None else v}" for c, v in zip(CLASSES, values, strict=True)) + " END"

    def kind(i: str) -> str:
        return f"(CASE WHEN g.c[{i}] < 10 THEN 0 WHEN g.c[{i}] < 36 THEN 1 WHEN g.c[{i}] < 62 THEN 2 ELSE 3 END)"

    def change(i: str, j: str) -> str:
        return f"(CASE WHEN {kind(i)} = {kind(j)} THEN 0 WHEN least({kind(i)}, {kind(j)}) = 0 THEN 3 ELSE 1 END)"

    most = by_class([None if bits is None else f"{WINDOW * (math.log2(WINDOW) - bits) + 1e-9!r}D" for _, bits, _ in CLASSES])
    least = by_class([changes for _, _, changes in CLASSES])
    weights = ", ".join(f"{0.0 if n < 2 else n * math.log2(n)!r}D" for n in range(WINDOW + 1))
    given = f"named_struct('c', transform(split({s}, ''), y -> instr('{ALPHABET}', y) - 1), 'most', {most}, 'least', {least}, 'f', array({weights}))"
    leaves, gone, held = f"i >= {WINDOW}", f"get(g.c, i - {WINDOW})", f"get(a.counts, get(g.c, i - {WINDOW}))"
    # n: the count of the character that enters, after the other has left and before it does.
    step = (
        "named_struct('counts', transform(a.counts, (m, k) -> m + CASE WHEN k = g.c[i] THEN 1 ELSE 0 END"
        f" - CASE WHEN {leaves} AND k = {gone} THEN 1 ELSE 0 END),"
        f" 'sum', a.sum - CASE WHEN {leaves} THEN get(g.f, {held}) - get(g.f, {held} - 1) ELSE 0D END + get(g.f, n + 1) - get(g.f, n),"
        f" 'changes', a.changes + CASE WHEN i > 0 THEN {change('i', 'greatest(i - 1, 0)')} ELSE 0 END"
        f" - CASE WHEN {leaves} THEN {change(f'greatest(i - {WINDOW}, 0)', f'greatest(i - {WINDOW - 1}, 0)')} ELSE 0 END)"
    )
    entering = f"transform(array(a.counts[g.c[i]] - CASE WHEN {leaves} AND {gone} = g.c[i] THEN 1 ELSE 0 END), n -> {step})"
    judged = f"transform({entering}, b -> named_struct('counts', b.counts, 'sum', b.sum, 'changes', b.changes, 'found', a.found OR (i >= {WINDOW - 1} AND b.sum <= g.most AND b.changes >= g.least)))[0]"
    start = f"named_struct('counts', array_repeat(0, {len(ALPHABET)}), 'sum', 0D, 'changes', 0, 'found', false)"
    run = f"transform(array({given}), g -> g.most IS NOT NULL AND aggregate(sequence(0, size(g.c) - 1), {start}, (a, i) -> {judged}, a -> a.found))[0]"
    return f"NOT {s} RLIKE '{ALLOWED}' AND {run}"


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat(F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["kind"] + 1), F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")


def find_secrets(df: DataFrame, *, text: str = "text") -> DataFrame:
    """df with _base and _spans, arrays of (start, kind, end), each in the order of start and kind.

    Offsets are code points and the end is exclusive. _base has the known forms; _spans adds candidate
    strings that look random, are not allow-listed and touch no base span. A null or empty text has none.
    Everything happens within a row: there is no exchange, and a long text costs its length. Repeated rows are
    scanned each for itself, and an empty table gives an empty result. Columns of df named _base or _spans are
    replaced; other names cannot clash.
    """
    given = Aside(df)
    t = whole(given.of(text))
    first = given.df.select("*", _found(t, ASSIGN, "assign", 6).alias("_a"), _found(t, ACCESS, "access").alias("_k"), _found(t, HEX, "hex").alias("_h"), _found(t, CANDIDATE, "entropy").alias("_c"))
    bare = "transform({0}, x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end))"
    second = first.select(*given.own, F.array_sort(F.expr(bare.format("concat(_a, _k, _h)"))).alias("_base"), "_c")
    apart = F.expr(f"filter(_c, x -> NOT exists(_base, b -> b.start < x.end AND x.start < b.end) AND {_random('x.s')})")
    third = second.select(*given.own, "_base", F.when(F.size("_c") > 0, apart).otherwise(F.col("_c")).alias("_c"))
    return third.select(*given.back("_base", "_spans"), "_base", F.array_sort(F.concat("_base", F.expr(bare.format("_c")))).alias("_spans"))


def op4_secret_scans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    count = lambda k: F.size(F.filter("_base", lambda x: x["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return find_secrets(docs).select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans"))
