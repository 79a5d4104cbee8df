"""Joins and the cube: against SQL on the tables, against plain loops on odd rows, and their plans and tasks."""

import random

import pytest
from pyspark.sql import functions as F

from sparkloom.operators.cubes import cube_distinct, dense_ids
from sparkloom.operators.joins import asof_join, heavy_keys, overlap_join, overlap_pairs, skew_join
from sparkloom.plans import tables
from sparkloom.sources.shared import Scratch

from .conftest import same_rows


@pytest.fixture
def scratch(spark):
    with Scratch(spark) as made:
        yield made


@pytest.mark.parametrize("name", sorted(tables.QUERIES))
def test_sql(spark, sf, duck, name):
    same_rows(tables.QUERIES[name](spark, sf).toPandas(), duck.sql(tables.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", ["campaign_shipments", "overlapping_shipments", "skewed_suppliers", "orders_asof_events"])
def test_no_cross_join(spark, sf, name):
    plan = tables.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def asof(left, right):
    out = []
    for k, t, x in left:
        fit = [(u, i, v) for j, u, i, v in right if None not in (j, u, k, t) and j == k and u <= t]
        out.append((k, t, x, max(fit)[2] if fit else None))
    return sorted(out, key=str)


def test_asof(spark, scratch):
    rng = random.Random(1)
    key = lambda: rng.choice([1, 1, 1, 1, 2, 3, None])
    left = [(key(), rng.choice([rng.randrange(300), None]), "x") for _ in range(300)] + [(1, 50, "same")] * 3
    right = [(key(), rng.choice([rng.randrange(300), None]), i, f"r{i}") for i in range(200)] + [(5, 1, 900, "alone")]
    # More ranges than keys, so that a hot key and its last value go over their borders.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        l, r = spark.createDataFrame(left, "k int, t int, x string").repartition(3), spark.createDataFrame(right, "k int, t int, i int, v string").repartition(3)
        args = {"left_key": F.col("k"), "left_at": F.col("t"), "right_key": F.col("k"), "right_at": F.col("t"), "tie": F.col("i"), "take": ("v",), "scratch": scratch}
        got = asof_join(l, r, **args)
        assert sorted(((x.k, x.t, x.x, x.found.v if x.found else None) for x in got.collect()), key=str) == asof(left, right)
        assert asof_join(l.limit(0), r, **args).count() == 0
        assert {x.found for x in asof_join(l, r.limit(0), **args).collect()} == {None}
        late = asof_join(l.where("k = 1 AND t = 299"), spark.createDataFrame([(1, 0, 1, "first")], r.schema), **args)
        assert all(x.found.v == "first" for x in late.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("rows_per_bin", [5, 10_000])
@pytest.mark.parametrize("keyed", [False, True])
def test_overlaps(spark, rows_per_bin, keyed):
    rng = random.Random(2)

    def some(n, name):
        out = [(f"{name}{i}", rng.randrange(3), s := rng.randrange(200), s + rng.choice([0, 1, 5, 150])) for i in range(n)]
        return out + [(f"{name}e", 1, 9, 3), (f"{name}n", 1, None, 5), (f"{name}m", 1, 5, None), (f"{name}k", None, 1, 100), out[0]]

    one, two = some(60, "a"), some(70, "b")
    schema = "id string, k int, s int, e int"
    a, b = spark.createDataFrame(one, schema), spark.createDataFrame(two, schema)
    on = [(F.col("k"), F.col("k"))] if keyed else []
    got = overlap_join(a, b, a_from=F.col("s"), a_to=F.col("e"), b_from=F.col("s"), b_to=F.col("e"), on=on, rows_per_bin=rows_per_bin)
    fine = lambda x: None not in x[2:] and x[2] <= x[3]
    want = [(x[0], y[0]) for x in filter(fine, one) for y in filter(fine, two) if x[2] <= y[3] and y[2] <= x[3] and (not keyed or x[1] is not None and x[1] == y[1])]
    assert sorted((r.a.id, r.b.id) for r in got.collect()) == sorted(want) and want
    assert overlap_join(a.limit(0), b, a_from=F.col("s"), a_to=F.col("e"), b_from=F.col("s"), b_to=F.col("e")).count() == 0


@pytest.mark.parametrize("rows_per_bin", [5, 10_000])
@pytest.mark.parametrize("keyed", [False, True])
def test_pairs_of_one_table(spark, rows_per_bin, keyed):
    rng = random.Random(5)
    some = lambda s, most: (rng.randrange(40), rng.choice([1, 2, 3]), rng.randrange(3), s, s + rng.choice([-40, -3, 0, 1, 5, most]))
    rows = [some(rng.randrange(200), 150) for _ in range(90)] + [(None, 1, 1, 0, 190), (7, None, 1, 0, 180), (8, 1, None, 0, 170), (9, 1, 1, None, 5), (9, 2, 1, 5, None)]
    rows += rows[:3] + [(50 + i, 1, 1, 60, 70) for i in range(4)]
    df = spark.createDataFrame(rows, "id int, line int, k int, s int, e int")
    got = overlap_pairs(df, start=F.col("s"), end=F.col("e"), order=("id", "line"), on=[F.col("k")] if keyed else [], rows_per_bin=rows_per_bin).collect()

    def before(x, y):
        return None not in (x[0], y[0]) and (x[0] < y[0] or (x[0] == y[0] and None not in (x[1], y[1]) and x[1] < y[1]))

    whole = [x for x in rows if None not in x[3:]]
    want = [(x, y) for x in whole for y in whole if before(x, y) and x[3] <= y[4] and y[3] <= x[4] and (not keyed or x[2] is not None and x[2] == y[2])]
    first = lambda x, y: (x, y) if (x[3], 0) <= (y[3], 0) else (y, x)
    assert sorted(((tuple(r.a), tuple(r.b)) for r in got), key=str) == sorted((first(*p) for p in want), key=str) and len(want) > 300
    assert all((r.since, r.till) == (max(r.a.s, r.b.s), min(r.a.e, r.b.e)) and (not keyed or tuple(r.key) == (r.a.k,)) for r in got)
    assert overlap_pairs(df.limit(0), start=F.col("s"), end=F.col("e"), order=("id",)).count() == 0


def exchanged(node):
    """Rows written by all exchanges of a plan that has run."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return exchanged(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return exchanged(node.plan())
    own = node.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
    return own + sum(exchanged(node.children().apply(i)) for i in range(node.children().size()))


def test_long_shipments_are_not_laid_out_again_and_again(spark, tmp_path):
    """Shipments that are long beside the finest bins: each of many parts has few of them, so few bins do."""
    import datetime

    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng, n = random.Random(6), 40_000
    names = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    made = [(rng.choice([None, *range(5000)]), rng.randrange(1, 8), rng.randrange(2000), float(rng.randrange(-20, 500)), datetime.datetime(1995, 1, 1) + datetime.timedelta(rng.randrange(2500))) for _ in range(n - 2)]
    made += made[:2]
    pq.write_table(pa.Table.from_pydict(dict(zip(names, map(list, zip(*made, strict=True)), strict=True))), tmp_path / "lineitem.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = tables.QUERIES["overlapping_shipments"](spark, str(tmp_path))
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert 2 * n <= exchanged(got._jdf.queryExecution().executedPlan()) < 3 * n
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    assert sorted(map(tuple, rows)) == sorted(con.sql(tables.ORACLE_SQL["overlapping_shipments"]).fetchall()) and rows


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skewed_keys(spark, how):
    rng = random.Random(3)
    left = [(i, 7 if i % 3 == 0 else rng.randrange(50, 400), rng.choice(["x", "x", None])) for i in range(3000)] + [(1, 7, "x")] * 5
    right = [(k, "x", f"r{k}-{j}") for k in (7, *range(50, 300)) for j in range(2)] + [(7, None, "never")]
    l, r = spark.createDataFrame(left, "id long, k int, z string").repartition(5), spark.createDataFrame(right, "k2 int, z2 string, v string")
    got = skew_join(l, r, [("k", "k2"), ("z", "z2")], how, share=0.01).select("l.id", "l.k", "l.z", "r.v").collect()
    by = {}
    for k, z, v in right:
        by.setdefault((k, z), []).append(v)
    want = [(i, k, z, v) for i, k, z in left for v in (by.get((k, z), []) if z is not None else []) or ([None] if how == "left" else [])]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert skew_join(l.limit(0), r, [("k", "k2")]).count() == 0


def test_a_third_of_rows_on_one_key(spark):
    """The key with a third of all rows is dealt over many tasks, where a plain join has it in one."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(n) for n in names]
    try:
        for n, v in zip(names, ("false", "40", "-1"), strict=True):
            spark.conf.set(n, v)
        l = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k"))
        r = spark.range(70_000).select((F.col("id")).alias("k2"), F.lit("v").alias("v"))
        most = lambda df: df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        assert heavy_keys(l, F.col("k")) == [(7, 334)]
        assert most(l.join(r, l.k == r.k2)) > 20_000
        made = skew_join(l, r, [("k", "k2")], share=0.01)
        assert made.count() == 60_000 and most(made) < 6_000
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)


def test_cube(spark, duck, scratch):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(3), rng.choice([True, False]), rng.choice([None, *(f"v{rng.randrange(10**6)}" for _ in range(3)), "often"])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "x string, y int, z boolean, v string")
    frame = df.toPandas()  # noqa: F841  read by name below
    import duckdb

    want = duckdb.sql("SELECT x, y, z, grouping(x) * 4 + grouping(y) * 2 + grouping(z) AS grouping_id, count(*) AS n_rows, count(DISTINCT v) AS n_distinct FROM frame GROUP BY CUBE (x, y, z)").fetchall()
    got = cube_distinct(df, ("x", "y", "z"), "v", scratch)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert [tuple(r) for r in cube_distinct(df.limit(0), ("x", "y"), "v", scratch).collect()] == [(None, None, 3, 0, 0)]
    ids = sorted((r.id, r.v) for r in dense_ids(df, "v", scratch).collect())
    assert [i for i, _ in ids] == list(range(len({r[3] for r in rows} - {None}))) and [v for _, v in ids] == sorted({r[3] for r in rows} - {None})
    wide = spark.range(100_000).select(F.lit(1).alias("x"), (F.col("id") * 1_000_003).alias("v"))
    assert {tuple(r) for r in cube_distinct(wide, ("x",), "v", scratch).collect()} == {(1, 0, 100_000, 100_000), (None, 1, 100_000, 100_000)}
