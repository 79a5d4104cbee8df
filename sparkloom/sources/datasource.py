"""The service as a Spark data source named relay: its targets as a table or a stream, and texts handed on to it from either."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

from pyarrow import fs
from pyspark.sql import Row
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from ..operators.config import DISCOVERY_SECONDS, INGEST_SECONDS, Config
from .ledger import KEY_HEADER
from .transports import Http

RESPONSE = "status int, body string, error string"
TARGET = "poll bigint, ord bigint, host string, eligible boolean, feed_id string, feed_url string"
#: Targets of one host that a partition has at most.
SLICE = 10_000


class DiscoveryFailedError(RuntimeError):
    """The service did not list its targets."""


def listed(status: int | None, body: str | None, error: str | None) -> list[dict]:
    """The members of a response's list, all of them objects; anything else is an error. A missing list is an empty one."""
    document = json.loads(body) if status == 200 and body else None
    if not isinstance(document, dict):
        raise DiscoveryFailedError(error or f"status {status}, or no document")
    members = document.get("targets", [])
    if not isinstance(members, list) or not all(isinstance(m, dict) for m in members):
        raise DiscoveryFailedError("the list is none, or a target is no object")
    return members


def target_rows(members: list[dict], poll: int = 0) -> list[tuple]:
    """Rows of TARGET. feed_id and feed_url are JSON texts; eligible, whether both count as values."""
    rows = []
    for k, m in enumerate(members):
        feed_id, url = m.get("id"), m.get("feed_url")
        try:
            host = urlsplit(url).hostname if isinstance(url, str) else None
        except ValueError:
            host = None
        rows.append((poll, k, host, bool(feed_id) and bool(url), json.dumps(feed_id), json.dumps(url)))
    return rows


class Some(InputPartition):
    """Targets of one host."""

    def __init__(self, rows: list[tuple]):
        self.rows = rows


def by_host(rows: list[tuple]) -> list[InputPartition]:
    """One partition for each host, more where it has many targets; so requests to a host can be told apart and bounded."""
    hosts: dict[str | None, list[tuple]] = {}
    for r in rows:
        hosts.setdefault(r[2], []).append(r)
    return [Some(own[k : k + SLICE]) for own in hosts.values() for k in range(0, len(own), SLICE)] or [Some([])]


class Relay(DataSource):
    """Options endpoint and token; hosts, a comma-separated list of those that may be reached.

    rows=response (the default) reads one row, the response that lists the targets; rows=targets reads its
    targets, by host. As a stream it always reads targets; log, a folder that outlives the driver, holds
    what was listed, and keep (0) how many lists that are done with stay there. Written to, it posts the column
    envelope of each row, under the key in column key if there is one; a stream's log has the batches' totals.
    """

    @classmethod
    def name(cls) -> str:
        return "relay"

    def schema(self) -> str:
        return TARGET if self.options.get("rows") == "targets" or self.options.get("log") else RESPONSE

    def _with(self) -> tuple[Config, Http]:
        config = Config.of({"ENDPOINT_URL": self.options.get("endpoint", ""), "RUNNER_TOKEN": self.options.get("token", "")})
        return config, Http(tuple(h for h in self.options.get("hosts", "").split(",") if h))

    def reader(self, schema: StructType) -> DataSourceReader:
        return (Targets if self.options.get("rows") == "targets" else Discovery)(*self._with())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return Polls(*self._with(), self.options["log"], int(self.options.get("keep", "0")))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return Ingest(*self._with())

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return Posts(*self._with(), self.options["log"])


class Discovery(DataSourceReader):
    """One row: the response that lists the targets. Each action asks again."""

    def __init__(self, config: Config, http: Http):
        self.config, self.http = config, http

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def ask(self) -> tuple:
        return self.http.ask(self.config.discovery_url, self.config.service_headers(), DISCOVERY_SECONDS)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield self.ask()


class Targets(Discovery):
    """The targets of one response, a partition for each host. Filters on host and eligible are taken over: other hosts get no partition.

    Spark asks for spark.sql.python.filterPushdown.enabled. Each query must load the table anew: Spark 4.1
    keeps what one query has pushed into a loaded table for the next.
    """

    def __init__(self, config: Config, http: Http):
        super().__init__(config, http)
        self.wanted: list[tuple[int, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        at = {("host",): 2, ("eligible",): 3}
        for f in filters:
            column = at.get(getattr(f, "attribute", None))
            if column is None:
                yield f
            elif isinstance(f, EqualTo):
                self.wanted.append((column, frozenset([f.value])))
            elif isinstance(f, In):
                self.wanted.append((column, frozenset(f.value)))
            elif isinstance(f, EqualNullSafe):
                self.wanted.append((column, frozenset([f.value])))
            elif isinstance(f, IsNotNull):
                self.wanted.append((column, frozenset()))  # any value but null
            else:
                yield f

    def _wants(self, row: tuple) -> bool:
        return all(row[c] in values if values else row[c] is not None for c, values in self.wanted)

    def partitions(self) -> list[InputPartition]:
        return by_host([r for r in target_rows(listed(*self.ask())) if self._wants(r)])

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from partition.rows


class _Log:
    """Small JSON documents under numbers, in a folder of any file system that pyarrow knows. A document is there whole or not at all."""

    def __init__(self, uri: str, kind: str):
        self.uri, self.kind = uri, kind

    def _at(self) -> tuple[fs.FileSystem, str]:
        files, path = fs.FileSystem.from_uri(self.uri)
        files.create_dir(at := f"{path}/{self.kind}", recursive=True)
        return files, at

    def numbers(self) -> list[int]:
        files, at = self._at()
        names = [f.base_name for f in files.get_file_info(fs.FileSelector(at))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def write(self, number: int, document) -> None:
        files, at = self._at()
        with files.open_output_stream(f"{at}/.{number}.tmp") as f:
            f.write(json.dumps(document).encode())
        files.move(f"{at}/.{number}.tmp", f"{at}/{number:020d}.json")

    def read(self, number: int):
        files, at = self._at()
        with files.open_input_stream(f"{at}/{number:020d}.json") as f:
            return json.loads(f.read())

    def remove(self, number: int) -> None:
        files, at = self._at()
        files.delete_file(f"{at}/{number:020d}.json")


class Polls(DataSourceStreamReader):
    """Targets as they are listed. An offset is the number of a list; (start, end] is the same rows whenever it is read.

    The service lists what is pending and keeps no positions, so each list is written to the log before it
    gets a number, and a batch that is run again reads the log and does not ask. A list that failed or is
    empty gets no number. What a batch has committed goes from the log, but for the last `keep`; of that no
    restart asks again.
    """

    def __init__(self, config: Config, http: Http, log: str, keep: int):
        self.discovery, self.log, self.mark, self.keep = Discovery(config, http), _Log(log, "lists"), _Log(log, "done"), keep

    def _last(self) -> int:
        return max([*self.log.numbers(), *self.mark.numbers()], default=0)

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def latestOffset(self) -> dict:
        last = self._last()
        try:
            members = listed(*self.discovery.ask())
        except (DiscoveryFailedError, ValueError):
            members = []
        if members:
            last += 1
            self.log.write(last, members)
        return {"poll": last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        numbers = range(start["poll"] + 1, end["poll"] + 1)
        return by_host([r for n in numbers for r in target_rows(self.log.read(n), n)])

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from partition.rows

    def commit(self, end: dict) -> None:
        known = self.mark.numbers()
        if end["poll"] and end["poll"] not in known:
            self.mark.write(end["poll"], {})
        for n in known:
            if n < end["poll"]:
                self.mark.remove(n)
        for n in self.log.numbers():
            if n <= end["poll"] - self.keep:
                self.log.remove(n)


class Sent(WriterCommitMessage):
    def __init__(self, sent: int, failed: int):
        self.sent, self.failed = sent, failed


class Ingest(DataSourceWriter):
    """Posts column `envelope` of each row once per run of its task; failures are counted, not raised. For totals use plans.relay."""

    def __init__(self, config: Config, http: Http):
        self.config, self.http = config, http

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        sent = failed = 0
        for row in iterator:
            key = {KEY_HEADER: row["key"]} if "key" in row else {}
            status = self.http.ask(self.config.ingest_url, self.config.service_headers() | key, INGEST_SECONDS, row["envelope"])[0]
            sent, failed = sent + 1, failed + (status != 200)
        return Sent(sent, failed)

    @staticmethod
    def _totals(messages: list[WriterCommitMessage | None]) -> dict[str, int]:
        done = [m for m in messages if isinstance(m, Sent)]
        return {"sent": sum(m.sent for m in done), "failed": sum(m.failed for m in done)}

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        print(json.dumps(self._totals(messages)))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """What has been posted stays posted."""


class Posts(DataSourceStreamWriter):
    """The same for a stream. A batch that is run again posts again, under the same keys if its rows have any; its totals are kept once."""

    def __init__(self, config: Config, http: Http, log: str):
        self.ingest, self.log = Ingest(config, http), _Log(log, "batches")

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        return self.ingest.write(iterator)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        if batchId not in self.log.numbers():
            self.log.write(batchId, Ingest._totals(messages))

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        """What has been posted stays posted."""
