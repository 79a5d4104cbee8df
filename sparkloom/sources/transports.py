"""Ways to ask and to send. All return (status, text, error) and never raise for one request."""

from __future__ import annotations

import codecs
import http.client
import urllib.error
import urllib.request
from dataclasses import dataclass
from urllib.parse import urljoin, urlsplit

Response = tuple[int | None, str | None, str | None]
#: Redirects that are followed for one request.
MOST_REDIRECTS = 30


class _Refused(Exception):
    """An address that must not be asked."""


class _Stay(urllib.request.HTTPRedirectHandler):
    """Redirects are answers; Http follows them itself."""

    def redirect_request(self, *args):
        return None


def text_of(body: bytes, headers: http.client.HTTPMessage | None) -> str:
    """The body by the charset that the headers name; without one texts are ISO-8859-1, and all else UTF-8."""
    charset = headers.get_content_charset() if headers else None
    if charset is None and headers is not None and headers.get_content_maintype() == "text" and "content-type" in headers:
        charset = "iso-8859-1"
    try:
        codecs.lookup(charset or "utf-8")
    except LookupError:
        charset = None
    return body.decode(charset or "utf-8", "replace")


@dataclass(frozen=True)
class Http:
    """Over http and https alone; with `hosts`, to these hosts alone, redirects included. Bodies of over most_bytes are errors.

    A redirect to another host, port or scheme goes without the authorisation. 307 and 308 repeat the request
    as it was; after a 303, and after a 301 or 302 to a post, the next one is a get.
    """

    hosts: tuple[str, ...] = ()
    most_bytes: int = 64 << 20

    def _checked(self, url: str) -> tuple[str, str | None, int | None]:
        parts = urlsplit(url)
        if parts.scheme not in ("http", "https"):
            raise _Refused(f"scheme not allowed: {parts.scheme}")
        if self.hosts and parts.hostname not in self.hosts:
            raise _Refused(f"host not allowed: {parts.hostname}")
        return parts.scheme, parts.hostname, parts.port

    def ask(self, url: str, headers: dict[str, str], seconds: float, data: str | None = None) -> Response:
        try:
            body, opener = None if data is None else data.encode(), urllib.request.build_opener(_Stay)
            for _ in range(MOST_REDIRECTS + 1):
                here = self._checked(url)
                try:
                    answer = opener.open(urllib.request.Request(url, body, headers), timeout=seconds)
                except urllib.error.HTTPError as e:
                    answer = e
                with answer:
                    to = answer.headers.get("Location") if answer.headers else None
                    if answer.status not in (301, 302, 303, 307, 308) or to is None:
                        got = answer.read(self.most_bytes + 1)
                        if len(got) > self.most_bytes:
                            return None, None, f"more than {self.most_bytes} bytes"
                        if (answer.fp if isinstance(answer, urllib.error.HTTPError) else answer).length:
                            return None, None, "the body is cut short"
                        return answer.status, text_of(got, answer.headers), None
                url = urljoin(url, to)
                if answer.status in (301, 302, 303) and body is not None:
                    body, headers = None, {k: v for k, v in headers.items() if k.lower() != "content-type"}
                if self._checked(url) != here:
                    headers = {k: v for k, v in headers.items() if k.lower() != "authorization"}
            return None, None, "too many redirects"
        except _Refused as e:
            return None, None, str(e)
        except Exception as e:  # one request's failure is a row's, never a task's: a task that fails is run again
            return None, None, f"{type(e).__name__}: {e}"[:500]


@dataclass(frozen=True)
class Recorded:
    """Answers from memory, by address; any other address is an error. For tests and replays."""

    answers: dict[str, Response]

    def ask(self, url: str, headers: dict[str, str], seconds: float, data: str | None = None) -> Response:
        return self.answers.get(url, (None, None, "not recorded"))
