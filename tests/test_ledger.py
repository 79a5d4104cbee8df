"""Posts under keys: runs that die go on where they were, and a service that honours keys acts on each once."""

import json
import os
import subprocess
import sys
import threading
from collections import Counter
from dataclasses import dataclass
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from sparkloom.operators.config import Config
from sparkloom.plans import relay
from sparkloom.sources import ledger as L
from sparkloom.sources.transports import Recorded

CONFIG = Config("https://h/relay-ingest", "t")


@dataclass(frozen=True)
class Service:
    """Notes each post in a folder. The first time that it sees `deadly`, it takes the worker down after it has acted."""

    folder: str
    deadly: str = ""

    def ask(self, url, headers, seconds, data=None):
        key = headers.get(L.KEY_HEADER, "none")
        with open(f"{self.folder}/{key}", "a") as f:
            f.write(f"{data}\n")
        mark = f"{self.folder}/died"
        if data == self.deadly and not os.path.exists(mark):
            open(mark, "w").close()
            os._exit(1)
        return (200, '{"processed":1}', None) if data != "refuse" else (500, "", None)

    def acted(self):
        return {n: open(f"{self.folder}/{n}").read().splitlines() for n in os.listdir(self.folder) if n != "died"}


@pytest.fixture
def posts(spark):
    rows = [(k, "https://h/in", "refuse" if k == 3 else str(k)) for k in range(40)]
    return spark.createDataFrame(rows, "ord long, url string, data string").repartition(4, "ord")


def test_a_run_that_dies_between_sending_and_telling(spark, posts, tmp_path):
    (tmp_path / "s").mkdir()
    service, book = Service(str(tmp_path / "s"), "11"), L.Ledger(spark, str(tmp_path / "l"))
    with pytest.raises(Exception, match="exited unexpectedly|crashed|EOF"):
        book.post(posts, service, {}, 5, scope="b", side_by_side=4)
    sent, known = service.acted(), {r.key for r in book.outcomes.collect()}
    left = {r.key for r in book.open().collect()}
    assert left and len(left) + len(known) == 40 and set(sent) >= known
    assert {k for k, v in sent.items() if v == ["11"]} <= left  # open, though it was sent
    alone = {r.ord: r for r in book.post(posts, service, {}, 5, scope="b", honoured=False).collect()}
    assert service.acted() == sent and sum(r.error == L.SAID_OPEN for r in alone.values()) == len(left)
    made = {r.ord: r for r in book.post(posts, service, {}, 5, scope="b").collect()}
    assert len(made) == 40 and {o for o, r in made.items() if r.status != 200} == {3} and book.open().count() == 0
    acted = service.acted()  # one file a key: a service that honours keys acts 40 times
    assert len(acted) == 40 and all(len(set(v)) == 1 for v in acted.values())
    assert all(len(acted[k]) == 1 for k in known)
    before = sum(map(len, acted.values()))
    assert book.post(posts, service, {}, 5, scope="b").count() == 40 and sum(map(len, service.acted().values())) == before
    assert {r.state: r.n for r in book.state().groupBy("state").agg(F.count("*").alias("n")).collect()} == {L.ANSWERED: 39, L.REFUSED: 1}


def test_keys(spark):
    rows = spark.createDataFrame([("a", 1, "u", "d"), ("a", 1, "u", "d"), ("a", 2, "u", "d"), ("b", 1, "u", "d"), ("a", 1, "v", "d"), ("a", 1, "u", "e")], "s string, ord long, url string, data string")
    assert [n for _, n in Counter(r[0] for r in rows.select(L.idempotency_key(F.col("s"), F.col("ord"), F.col("url"), F.col("data"))).collect()).most_common()] == [2, 1, 1, 1, 1]


def test_outcomes_told_twice(spark):
    rows = [("k", 1, None, None, "timed out", "1"), ("k", 1, 500, "", None, "2"), ("k", 1, 200, "{}", None, "3"), ("m", 2, None, None, "x", "2"), ("m", 2, None, None, "w", "1")]
    df = spark.createDataFrame(rows, L.OUTCOME)
    assert sorted(map(tuple, L.settled(df).collect())) == [("k", 1, 500, "", None, 3), ("m", 2, None, None, "w", 2)]
    want = spark.createDataFrame([("k",), ("m",), ("o",)], "key string")
    assert sorted((r.key, r.state, r.recorded) for r in L.states(want, df).collect()) == [("k", "refused", 3), ("m", "unknown", 2), ("o", "open", 0)]


def test_a_batch_with_keys(spark, tmp_path):
    listed = [{"id": k, "feed_url": "http://a/f"} for k in range(1, 6)] + [{"id": 9, "feed_url": "http://b/f"}]
    answers = {CONFIG.discovery_url: (200, json.dumps({"targets": listed}), None), "http://a/f": (200, "<a/>", None), "http://b/f": (404, "", None)}

    class Both(Recorded):
        def ask(self, url, headers, seconds, data=None):
            return super().ask(url, headers, seconds) if data is None else (200 if L.KEY_HEADER in headers else 400, '{"processed":2,"added":1}', None)

    said = []
    made = relay.run_relay(spark, CONFIG, Both(answers), str(tmp_path / "l"), say=said.append, keys=True)
    assert tuple(made.first()) == (6, 6, 10, 5, 1) and said[-1].startswith("[INFO] Batch sync complete: 10 ")


@pytest.fixture
def served():
    listed, calls = {"status": 200, "body": "{}"}, []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            feed = self.path == "/feed"
            self.answer(200 if feed else listed["status"], "<a/>" if feed else listed["body"])

        def do_POST(self):
            calls.append((self.headers.get(L.KEY_HEADER), self.rfile.read(int(self.headers["Content-Length"])).decode()))
            self.answer(200, '{"processed":1,"added":2}')

        def answer(self, status, body):
            self.send_response(status)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *args):
            pass

    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_address[1]}", listed, calls
    made.shutdown()


@pytest.mark.filterwarnings("ignore:the token is sent")
def test_exit_codes(spark, served, tmp_path):
    base, listed, calls = served
    said = []

    def run(**more):
        return relay.main({"ENDPOINT_URL": f"{base}/relay-ingest", "RUNNER_TOKEN": "t", "RELAY_LANDING": str(tmp_path / str(len(said)))} | more, say=said.append)

    assert run(RUNNER_TOKEN=" ") == 1 and said == ["[ERROR] Missing required runner configuration."]
    for status, body, code, last in (
        (503, "", 1, "[ERROR] Target discovery failed with status 503."),
        (200, "no", 1, "[ERROR] Failed to discover targets."),
        (200, "[1]", 1, "[ERROR] Failed to discover targets."),
        (200, "{}", 0, "[INFO] No targets pending rescue."),
        (200, '{"targets":{}}', 0, "[INFO] No targets pending rescue."),
    ):
        listed.update(status=status, body=body)
        assert run() == code and said[-1] == last
    for body in ('{"targets":null}', '{"targets":"abc"}'):
        listed.update(body=body)
        with pytest.raises(relay.DiscoveryError):
            run()
    listed.update(body=json.dumps({"targets": [{"id": 1, "feed_url": f"{base}/feed"}, {"id": 2, "feed_url": 5}]}))
    assert run() == 0 and said[-2:] == ["[INFO] Discovered 2 targets.", "[INFO] Batch sync complete: 1 targets processed, 2 entries added, 1 errors."]
    assert calls == [(None, '{"relay_results":[{"feed_id":1,"xml":"<a/>"}]}')]
    assert run(RELAY_KEYS="honoured") == 0 and len(calls[-1][0]) == 64


def test_the_command(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("ENDPOINT_URL", "RUNNER_TOKEN")}
    got = subprocess.run([sys.executable, "-m", "sparkloom.plans.relay"], capture_output=True, text=True, env=env, cwd=os.path.dirname(os.path.dirname(__file__)), timeout=120)
    assert (got.returncode, got.stdout) == (1, "[ERROR] Missing required runner configuration.\n")
