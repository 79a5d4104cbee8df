"""Settings, discovery, outcomes and side effects of a run."""

import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from sparkloom.functions.variants import counter, parsed, truthy
from sparkloom.operators import targets as T
from sparkloom.operators.config import Config, ConfigurationError
from sparkloom.operators.outcomes import accepted, increments, totals
from sparkloom.plans.relay import DiscoveryError, run_relay
from sparkloom.sources.responses import SpeculationError, ask_each, land
from sparkloom.sources.transports import Http, Recorded

CONFIG = Config("http://h/relay-ingest", "secret")


@pytest.mark.parametrize(
    ("endpoint", "discovery", "ingest"),
    [
        ("https://h/relay-ingest", "https://h/relay-ingest", None),
        ("https://h/scheduler", "https://h/scheduler?action=relay-targets", "https://h/scheduler?action=relay-ingest"),
        ("https://h//", "https://h/api/public/relay-ingest", None),
        ("https://h/scheduler/", "https://h/scheduler/api/public/relay-ingest", None),
        ("https://h/Scheduler", "https://h/Scheduler/api/public/relay-ingest", None),
    ],
)
def test_addresses(endpoint, discovery, ingest):
    c = Config.of({"ENDPOINT_URL": f"\t{endpoint} \n", "RUNNER_TOKEN": " t "})
    assert (c.discovery_url, c.ingest_url, c.token) == (discovery, ingest or discovery, "t")


@pytest.mark.parametrize("settings", [{}, {"ENDPOINT_URL": "x"}, {"ENDPOINT_URL": " ", "RUNNER_TOKEN": "t"}])
def test_missing_settings(settings):
    with pytest.raises(ConfigurationError):
        Config.of(settings)


def test_token_stays_with_the_service():
    assert "secret" not in repr(CONFIG) and "secret" not in str(CONFIG.feed_headers())
    assert CONFIG.service_headers()["Authorization"] == "Bearer secret"


def test_truthiness(spark):
    cases = {"0": False, "0.0": False, '""': False, "false": False, "null": False, "[]": False, "{}": False, '"0"': True, '" "': True, "[null]": True, '{"a":1}': True, "1": True, "-0.5": True, "true": True}
    got = spark.createDataFrame([(k,) for k in cases], "j string").select("j", truthy(parsed("j")).alias("t")).collect()
    assert {r.j: r.t for r in got} == cases
    assert spark.range(1).select(truthy(F.lit(None).cast("variant"))).first()[0] is False


def test_counters(spark):
    cases = {"{}": 0, '{"n":3}': 3, '{"n":null}': None, '{"n":"3"}': None, '{"n":true}': 1, "[1]": None, "bad": None, '{"n":[1]}': None, '{"n":1.5}': 1.5}
    got = spark.createDataFrame([(k,) for k in cases], "j string").select("j", counter(parsed("j"), "n").alias("n")).collect()
    assert {r.j: None if r.n is None else float(r.n) for r in got} == cases


def test_acceptance_is_never_null(spark):
    cases = [(200, "<rss/>", True), (200, "a < b", True), (200, "plain", False), (200, "", False), (204, "<a/>", False), (None, None, False), (200, None, False)]
    got = spark.createDataFrame(cases, "s int, b string, want boolean").select("want", accepted(F.col("s"), F.col("b")).alias("got")).collect()
    assert all(r.got is r.want for r in got)


@pytest.mark.parametrize(
    ("status", "body", "state"),
    [
        (500, '{"targets":[]}', T.REFUSED), (None, None, T.REFUSED), (200, "no", T.UNREADABLE), (200, "[1]", T.UNREADABLE), (200, "{}", T.NOTHING), (200, '{"targets":[]}', T.NOTHING),
        (200, '{"targets":{}}', T.NOTHING), (200, '{"targets":""}', T.NOTHING), (200, '{"targets":null}', T.WRONG_TYPE), (200, '{"targets":5}', T.WRONG_TYPE), (200, '{"targets":true}', T.WRONG_TYPE),
        (200, '{"targets":"abc"}', T.WRONG_TARGET), (200, '{"targets":{"x":1}}', T.WRONG_TARGET), (200, '{"targets":[5]}', T.WRONG_TARGET), (200, '{"targets":[{}]}', T.LISTED),
    ],
)
def test_discovery_states(spark, status, body, state):
    assert spark.createDataFrame([(status, body)], "s int, b string").select(T.discovery_state(F.col("s"), F.col("b"))).first()[0] == state


def answered(targets, **more):
    return Recorded({CONFIG.discovery_url: (200, json.dumps({"targets": targets}), None)} | more)


def test_a_whole_run(spark, tmp_path):
    listed = [{"id": 1, "feed_url": "http://a/f"}, {"id": "x", "feed_url": "http://b/f"}, {"id": 0, "feed_url": "http://a/f"}, {"id": 2, "feed_url": 5}, {"id": 1, "feed_url": "http://a/f"}]
    feeds = {"http://a/f": (200, "<rss/>", None), "http://b/f": (200, "plain", None)}

    class Service(Recorded):
        def ask(self, url, headers, seconds, data=None):
            if data is None:
                assert ("Authorization" in headers) == (url == CONFIG.discovery_url)
                return super().ask(url, headers, seconds)
            (one,) = json.loads(data)["relay_results"]
            return (200, '{"processed":3,"added":null}' if one != {"feed_id": 1, "xml": "<rss/>"} else '{"processed":2,"added":1}', None)

    said = []
    made = run_relay(spark, CONFIG, Service(answered(listed).answers | feeds), str(tmp_path / "l"), say=said.append)
    assert tuple(made.first()) == (5, 4, 4, 2, 2)
    assert said == ["[INFO] Discovered 5 targets.", "[INFO] Batch sync complete: 4 targets processed, 2 entries added, 2 errors."]


def test_nothing_to_do_and_failures(spark, tmp_path):
    said = []
    assert run_relay(spark, CONFIG, answered([]), str(tmp_path / "a"), say=said.append) is None
    assert said == ["[INFO] Discovered 0 targets.", "[INFO] No targets pending rescue."]
    with pytest.raises(DiscoveryError):
        run_relay(spark, CONFIG, Recorded({CONFIG.discovery_url: (503, "", None)}), str(tmp_path / "b"), say=said.append)
    assert said[-1] == "[ERROR] Target discovery failed with status 503."
    with pytest.raises(DiscoveryError):
        run_relay(spark, CONFIG, Recorded({}), str(tmp_path / "c"), say=said.append)
    assert said[-1] == "[ERROR] Failed to discover targets."
    assert tuple(run_relay(spark, CONFIG, answered([{}]), str(tmp_path / "d"), say=said.append).first()) == (1, 0, 0, 0, 0)


def test_totals_do_not_depend_on_order_or_partitions(spark):
    rows = [(i, i % 3 != 0, 200, "<", None, 200, json.dumps({"processed": i, "added": None if i % 5 == 0 else 1}), None) for i in range(50)]
    df = spark.createDataFrame(rows, "ord int, eligible boolean, fetch_status int, fetch_body string, fetch_error string, post_status int, post_body string, post_error string")
    got = {tuple(totals(increments(x)).first()) for x in (df, df.repartition(7, "ord"), df.orderBy(F.desc("ord")).coalesce(1))}
    assert len(got) == 1 and got.pop()[4] <= 50


@pytest.fixture
def server():
    calls = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            calls.append(("GET", self.path, self.headers.get("Authorization")))
            if self.path.startswith("/to/"):
                return self.answer(302, b"", self.path.removeprefix("/to/"))
            if self.path == "/cut":
                return self.answer(500, b"half", length=100)
            if self.path == "/large":
                return self.answer(200, b"x" * 3000)
            if self.path == "/latin":
                return self.answer(200, "<\u00e9>".encode("latin-1"), kind="text/xml")
            self.answer(404 if self.path == "/gone" else 200, b'{"targets":[{"id":7,"feed_url":"u"}]}' if "relay" in self.path else b"<feed/>")

        def do_POST(self):
            calls.append(("POST", self.path, self.rfile.read(int(self.headers["Content-Length"])).decode()))
            if self.path == "/again":
                return self.answer(307, b"", "/in")
            self.answer(200, b'{"processed":1}')

        def answer(self, status, body, to=None, length=None, kind=None):
            self.send_response(status)
            self.send_header("Content-Length", str(length or len(body)))
            if to:
                self.send_header("Location", to)
            if kind:
                self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    made = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_address[1]}", calls
    made.shutdown()


def test_http(server):
    base, _ = server
    assert Http().ask(f"{base}/f", {}, 5) == (200, "<feed/>", None)
    assert Http().ask(f"{base}/gone", {}, 5)[0] == 404
    assert Http().ask("file:///etc/hostname", {}, 5)[2].startswith("scheme not allowed")
    assert Http(("example.invalid",)).ask(f"{base}/f", {}, 5)[2].startswith("host not allowed")


def test_nothing_escapes_a_request(server):
    base, calls = server
    status, _, error = Http().ask(f"{base}/cut", {}, 5)
    assert status is None and error
    assert Http(most_bytes=1000).ask(f"{base}/large", {}, 5)[2] == "more than 1000 bytes"
    assert Http(most_bytes=3000).ask(f"{base}/large", {}, 5)[0] == 200
    assert Http().ask(f"{base}/latin", {}, 5)[1] == "<\u00e9>"
    assert Http().ask(f"{base}/to//to//to/x", {}, 5)[0] in (200, None)


def test_redirects(server):
    base, calls = server
    token = {"Authorization": "Bearer secret"}
    assert Http().ask(f"{base}/to//f", token, 5) == (200, "<feed/>", None)
    assert calls[-1] == ("GET", "/f", "Bearer secret")
    other = base.replace("127.0.0.1", "localhost")
    assert Http().ask(f"{base}/to/{other}/f", token, 5)[0] == 200
    assert calls[-1] == ("GET", "/f", None)
    n = len(calls)
    assert Http(("127.0.0.1",)).ask(f"{base}/to/{other}/f", token, 5)[2] == "host not allowed: localhost"
    assert Http().ask(f"{base}/to/file:///etc/hostname", token, 5)[2] == "scheme not allowed: file"
    assert len(calls) == n + 2
    assert Http().ask(f"{base}/again", token, 5, "{}")[1] == '{"processed":1}'
    assert [c[:2] for c in calls[-2:]] == [("POST", "/again"), ("POST", "/in")] and calls[-1][2] == "{}"


def test_a_landing_that_broke_off(spark, tmp_path):
    rows = spark.createDataFrame([(1, "http://a/f", None)], "ord long, url string, data string")
    asked = ask_each(rows, Recorded({"http://a/f": (200, "<a/>", None)}), {}, 5)
    (tmp_path / "f" / "_temporary").mkdir(parents=True)
    assert land(asked, str(tmp_path / "f")).count() == 1
    (tmp_path / "p" / "_temporary").mkdir(parents=True)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        land(asked, str(tmp_path / "p"), repeatable=False)


def test_each_post_is_sent_once(spark, server, tmp_path):
    base, calls = server
    rows = spark.createDataFrame([(k, f"{base}/in", str(k)) for k in range(20)], "ord long, url string, data string")
    landed = land(ask_each(rows, Http(), {}, 5, per_host=None), str(tmp_path / "p"))
    assert landed.count() == 20 and landed.where("status = 200").count() == 20
    land(ask_each(rows, Http(), {}, 5), str(tmp_path / "p")).count()
    assert sorted(int(c[2]) for c in calls) == list(range(20))


def test_speculation_is_refused(spark):
    rows = spark.createDataFrame([], "ord long, url string, data string")

    class Conf:
        sparkSession = type("S", (), {"conf": type("C", (), {"get": staticmethod(lambda *_: "true")})})

    with pytest.raises(SpeculationError):
        ask_each(Conf(), Http(), {}, 5)
    assert ask_each(rows, Http(), {}, 5).count() == 0


def test_data_source(spark, server):
    from sparkloom.sources.datasource import Relay

    base, calls = server
    spark.dataSource.register(Relay)
    options = {"endpoint": f"{base}/relay-ingest", "token": "t"}
    listed = T.listed_targets(spark.read.format("relay").options(**options).load())
    assert [r.i for r in listed.select(F.to_json("feed_id").alias("i")).collect()] == ["7"]
    spark.createDataFrame([("{}",), ("[]",)], "envelope string").write.format("relay").options(**options).mode("append").save()
    assert sorted(c[2] for c in calls if c[0] == "POST") == ["[]", "{}"]


def test_stream(spark, tmp_path):
    from sparkloom.streaming.relay import relay_stream

    spark.createDataFrame([(1, 1, "http://a/f"), (2, 0, "http://a/f"), (3, 3, "http://x/f")], "ord long, i int, u string").write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("ord long, i int, u string").parquet(str(tmp_path / "in"))
    coming = rows.selectExpr("ord", "parse_json(to_json(struct(i))):i feed_id", "parse_json(to_json(struct(u))):u feed_url")
    got = []
    answers = {"http://a/f": (200, "<a/>", None), CONFIG.ingest_url: (200, '{"processed":2,"added":1}', None)}
    query = relay_stream(coming, CONFIG, Recorded(answers), str(tmp_path / "l"), str(tmp_path / "c"), done=lambda df, _: got.append(tuple(df.first())))
    query.awaitTermination(120)
    assert got == [(3, 2, 2, 1, 1)]
