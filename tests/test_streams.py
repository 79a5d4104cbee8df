"""Streams: keyed state, sessions, and the relay as a source and a sink, over restarts."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from sparkloom.plans import streams
from sparkloom.sources.datasource import Relay, listed, target_rows
from sparkloom.sources.ledger import KEY_HEADER, idempotency_key
from sparkloom.streaming import feeds
from sparkloom.streaming.runs import run_to_end, state_session

from .conftest import same_rows


@pytest.mark.parametrize("name", sorted(streams.QUERIES))
def test_sql(spark, sf, duck, name):
    got, want = streams.QUERIES[name](spark, sf).toPandas(), duck.sql(streams.ORACLE_SQL[name]).df()
    same_rows(got, want)
    if name == "event_sessions":
        assert 0 < got.groupby("user_id")["late"].first().sum() < 50 and (got["rows"] > 1).any()
    else:
        assert set(got["action"]) == {"ok", "failed", "held"}


HOUR = feeds.HOUR


def test_back_off_over_restarts(spark, tmp_path):
    own, at = state_session(spark), lambda h: 10**15 + int(h * HOUR)
    parts = [
        [(1, 1, at(0), True), (1, 2, at(1), True), (1, 3, at(6), True), (2, 4, at(0), False)],
        [(1, 5, at(17), False), (1, 6, at(18), True), (1, 7, at(5), True), (2, 8, at(1), None), (None, 9, at(2), True)],
        [(1, 10, at(18.5), False), (2, 11, at(400), True)],
        [(1, 12, at(401), True), (3, 13, at(600), True), (3, 14, None, True)],
    ]
    want = [
        (None, 9, "failed", 1, at(8)), (1, 1, "failed", 1, at(6)), (1, 2, "held", 1, at(6)), (1, 3, "failed", 2, at(18)), (1, 5, "held", 2, at(18)), (1, 6, "failed", 3, at(42)), (1, 7, "late", 2, at(18)),
        (1, 10, "held", 3, at(42)), (1, 12, "failed", 1, at(407)), (2, 4, "ok", 0, 0), (2, 8, "ok", 0, 0), (2, 11, "failed", 1, at(406)), (3, 13, "failed", 1, at(606)),
    ]
    read, told = [], []
    for part in parts:
        spark.createDataFrame(part, "feed long, attempt long, us long, bad boolean").write.mode("append").parquet(str(tmp_path / "in"))
        rows = own.readStream.schema("feed long, attempt long, us long, bad boolean").parquet(str(tmp_path / "in"))
        made = feeds.back_off(rows, feed=F.col("feed"), attempt=F.col("attempt"), at=F.timestamp_micros("us"), failed=F.col("bad"), delay="20 hours")
        progress = run_to_end(made, str(tmp_path / "out"), str(tmp_path / "mark"))
        read.append(sum(p["numInputRows"] for p in progress))
        told.append({k: sum(p["stateOperators"][0][k] for p in progress) for k in ("numRowsRemoved", "numRowsUpdated", "numRowsTotal")})
    got = spark.read.schema(feeds.SCHEMA).parquet(str(tmp_path / "out")).collect()
    assert read == [4, 5, 2, 2] and sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert told[2]["numRowsRemoved"] > 0  # in the third run the watermark passes the times at which feeds are forgotten


def test_steps():
    state, told = (0, 0, 0), []
    for h, bad in [(0, True), (6, True), (18, True), (42, True), (90, True), (186, True), (282, False), (283, True), (500, False)]:
        state, action = feeds.step(state, h * HOUR + 1, bad, forget=200 * HOUR)
        told.append((action, state[0], (state[1] - h * HOUR) // HOUR if state[1] else 0))
    assert told == [("failed", 1, 6), ("failed", 2, 12), ("failed", 3, 24), ("failed", 4, 48), ("failed", 5, 96), ("failed", 6, 96), ("ok", 0, 0), ("failed", 1, 6), ("ok", 0, 0)]


@pytest.fixture
def service(spark):
    """Lists `targets`; notes how often it was asked, and the posts by key."""
    known = {"targets": [], "asked": 0, "status": 200, "posts": []}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            known["asked"] += 1
            self.answer(known["status"], json.dumps({"targets": known["targets"]}))

        def do_POST(self):
            known["posts"].append((self.headers.get(KEY_HEADER), self.rfile.read(int(self.headers["Content-Length"])).decode()))
            self.answer(200, "{}")

        def answer(self, status, body):
            self.send_response(status)
            self.send_header("Content-Length", str(len(body.encode())))
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *args):
            pass

    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    spark.dataSource.register(Relay)
    yield {"endpoint": f"http://127.0.0.1:{made.server_address[1]}/relay-ingest", "token": "t"}, known
    made.shutdown()


def test_filters_reach_the_source(spark, sf, duck, service):
    options, known = service
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    known["targets"] = [{"id": r.page_id, "feed_url": r.url} for r in pages] + [{"id": 5, "feed_url": ""}, {"id": None, "feed_url": "http://a/f"}, {}, {"id": "odd", "feed_url": 7}]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        load = lambda: spark.read.format("relay").options(**options, rows="targets").load()  # noqa: E731  anew for each query, see Targets
        eligible = load().where("eligible = true AND feed_id <> '\"odd\"'")
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        # What the source has taken over, Spark does not filter any more.
        assert "Filter (" not in plan(load().where("eligible = true")) and "eligible" not in plan(eligible).split("Filter (")[1].splitlines()[0]
        got = eligible.selectExpr("CAST(feed_id AS BIGINT) AS feed_id", "get_json_object('{\"u\":' || feed_url || '}', '$.u') AS feed_url").toPandas()
        same_rows(got, duck.sql("SELECT page_id AS feed_id, url AS feed_url FROM pages WHERE page_id <> 0 AND url <> ''").df())
        hosts = {r[2] for r in target_rows(known["targets"])}
        assert load().rdd.getNumPartitions() == len(hosts) > 3
        one = next(h for h in sorted(filter(None, hosts)))
        mine = load().where(F.col("host") == one)
        assert mine.rdd.getNumPartitions() == 1 and mine.count() == sum(r[2] == one for r in target_rows(known["targets"]))
        two = sorted(filter(None, hosts))[:2]
        assert load().where(F.col("host").isin(two)).rdd.getNumPartitions() == 2
        assert load().where("host IS NULL").count() == 3 and load().where("host IS NOT NULL").count() == len(known["targets"]) - 3
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    with pytest.raises(Exception, match="filterPushdown.enabled"):
        load().count()


def test_lists():
    assert target_rows(listed(200, '{"targets":[{"id":"0","feed_url":"http://[bad"}]}', None)) == [(0, 0, None, True, '"0"', '"http://[bad"')]
    assert listed(200, "{}", None) == []
    for answer in ((500, "{}", None), (200, "[1]", None), (None, None, "x"), (200, '{"targets":null}', None), (200, '{"targets":[5]}', None)):
        with pytest.raises(Exception, match="."):
            listed(*answer)


def test_source_and_sink_over_restarts(spark, service, tmp_path):
    options, known = service
    log = str(tmp_path / "log")

    def run(mark="mark"):
        rows = spark.readStream.format("relay").options(**options, log=log).load()
        ready = rows.where("eligible").select(F.concat(F.lit('{"relay_results":[{"feed_id":'), "feed_id", F.lit(',"xml":"<a/>"}]}')).alias("envelope"), idempotency_key("stream", F.col("ord"), F.col("poll").cast("string"), F.col("feed_id")).alias("key"))
        query = ready.writeStream.format("relay").options(**options, log=log).option("checkpointLocation", str(tmp_path / mark)).trigger(availableNow=True).start()
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    known["targets"] = [{"id": k, "feed_url": f"http://h{k % 3}/f"} for k in range(7)]
    assert run() == 7 and len(known["posts"]) == 6
    known["targets"] = [{"id": 10, "feed_url": "http://h/f"}]
    assert run() == 1 and len(known["posts"]) == 7 and len({k for k, _ in known["posts"]}) == 7
    known["targets"] = []
    assert run() == 0 and len(known["posts"]) == 7  # nothing new, and nothing again
    known["status"] = 500
    assert run() == 0 and len(known["posts"]) == 7
    batches = sorted((tmp_path / "log" / "batches").glob("*.json"))
    assert [json.loads(p.read_text())["sent"] for p in batches] == [6, 1]
    assert len(list((tmp_path / "log" / "lists").glob("*.json"))) <= 1  # committed lists go; the last one when the next batch begins


def test_a_range_is_read_again_from_the_log(spark, service, tmp_path):
    """A batch that was planned and not committed is the same rows after a restart, whatever the service lists by then."""
    options, known = service
    log, seen = str(tmp_path / "log"), []

    def run(fail):
        def each(df, number):
            seen.append((number, sorted(r.feed_id for r in df.collect())))
            if fail:
                raise RuntimeError("gone")

        rows = spark.readStream.format("relay").options(**options, log=log).load()
        query = rows.writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start()
        if fail:
            with pytest.raises(Exception, match="gone"):
                query.awaitTermination()
        else:
            query.awaitTermination()

    known["targets"] = [{"id": 1, "feed_url": "http://a/f"}, {"id": 2, "feed_url": "http://a/f"}]
    run(True)
    known["targets"] = [{"id": 3, "feed_url": "http://a/f"}]
    run(False)
    assert seen[:2] == [(0, ["1", "2"])] * 2 and [s for s in seen[2:] if s[1]] in ([], [(1, ["3"])])
