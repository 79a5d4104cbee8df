"""Settings of a run: where the service is, and who asks."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffixes and queries that tell the service's two addresses, and the client's time limits.
BOTH, SCHEDULER, DEFAULT = "/relay-ingest", "/scheduler", "/api/public/relay-ingest"
ASK_TARGETS, ASK_INGEST = "?action=relay-targets", "?action=relay-ingest"
DISCOVERY_SECONDS, FETCH_SECONDS, INGEST_SECONDS = 15, 20, 30
ACCEPT = "application/rss+xml, application/atom+xml, application/xml, text/xml;q=0.9, */*;q=0.8"
LANGUAGE = "en-US,en;q=0.9"
# Fixed values too: what a run says.
SAID_REFUSED = "[ERROR] Target discovery failed with status {}."
SAID_UNREADABLE, SAID_MISSING = "[ERROR] Failed to discover targets.", "[ERROR] Missing required runner configuration."
SAID_DISCOVERED, SAID_NOTHING = "[INFO] Discovered {} targets.", "[INFO] No targets pending rescue."
SAID_TOTALS = "[INFO] Batch sync complete: %d targets processed, %d entries added, %d errors."
USER_AGENT = "sparkloom-relay/1.0"


class ConfigurationError(ValueError):
    """A setting is missing; nothing has been asked or sent."""


def addresses(endpoint: str | Column) -> tuple[Column, Column]:
    """The addresses for discovery and ingest, as columns."""
    e = F.col(endpoint) if isinstance(endpoint, str) else endpoint
    plain = F.concat(F.regexp_replace(e, "/+$", ""), F.lit(DEFAULT))

    def pick(query: str) -> Column:
        return F.when(e.endswith(BOTH), e).when(e.endswith(SCHEDULER), F.concat(e, F.lit(query))).otherwise(plain)

    return pick(ASK_TARGETS), pick(ASK_INGEST)


@dataclass(frozen=True)
class Config:
    """Stripped endpoint and token; the token is not shown when the object is printed, and is never a column."""

    endpoint: str
    token: str = field(repr=False)
    user_agent: str = USER_AGENT

    @classmethod
    def of(cls, settings: Mapping[str, str] = os.environ) -> Config:
        """From ENDPOINT_URL and RUNNER_TOKEN; refuses to go on if one of them is empty."""
        made = cls(settings.get("ENDPOINT_URL", "").strip(), settings.get("RUNNER_TOKEN", "").strip())
        if not made.endpoint or not made.token:
            raise ConfigurationError(SAID_MISSING)
        return made

    def _address(self, query: str) -> str:
        if self.endpoint.endswith(BOTH):
            return self.endpoint
        return self.endpoint + query if self.endpoint.endswith(SCHEDULER) else self.endpoint.rstrip("/") + DEFAULT

    @property
    def discovery_url(self) -> str:
        return self._address(ASK_TARGETS)

    @property
    def ingest_url(self) -> str:
        return self._address(ASK_INGEST)

    def service_headers(self) -> dict[str, str]:
        return {"Authorization": f"Bearer {self.token}", "Content-Type": "application/json"}

    def feed_headers(self) -> dict[str, str]:
        """For third parties: without the token."""
        return {"User-Agent": self.user_agent, "Accept": ACCEPT, "Accept-Language": LANGUAGE}
