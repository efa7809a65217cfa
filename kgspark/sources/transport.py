"""Fetching public URLs: every hop is checked and pinned to a checked address, responses are bounded, outcomes are named."""

from __future__ import annotations

import http.client
import ipaddress
import re
import socket
import ssl
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from email.utils import parsedate_to_datetime
from urllib.parse import urljoin, urlsplit

from ..functions.urls import CONTENT_TYPES, MAX_RESPONSE, SOFT_MARKS, STRONG_MARKS, canonical_link, main_text, sanitized

REDIRECTS, MAX_REDIRECTS, CHUNK = (301, 302, 303, 307, 308), 5, 1 << 16
#: Kinds of failure; those of the second group are worth another try at once.
KINDS = ("invalid_input", "invalid_url", "dns", "http_error", "access_challenge", "response_too_large", "unsupported_content", "extraction_failed")
TRY_AGAIN = ("timeout", "connection", "request", "download_failed", "unknown")


class FetchError(RuntimeError):
    """A failed request; ``kind`` is one of the named kinds."""

    def __init__(self, kind: str, message: str = ""):
        super().__init__(message or kind)
        self.kind = kind


@dataclass
class Response:
    status: int
    headers: dict[str, str] = field(default_factory=dict)
    chunks: Iterator[bytes] = iter(())
    url: str = ""

    def header(self, name: str) -> str:
        return next((v for k, v in self.headers.items() if k.lower() == name.lower()), "")


def resolve(host: str, port: int) -> list[str]:
    try:
        found = socket.getaddrinfo(host, port, type=socket.SOCK_STREAM)
    except socket.gaierror as e:
        raise FetchError("dns", f"no address for {host}") from e
    return list(dict.fromkeys(str(x[4][0]) for x in found if x[0] in (socket.AF_INET, socket.AF_INET6)))


def request(url: str, address: str, headers: dict[str, str], timeout: float) -> Response:
    """One GET at an address that was checked; TLS is verified for the URL's host."""
    at = urlsplit(url)
    port = at.port or (443 if at.scheme == "https" else 80)
    try:
        sock = socket.create_connection((address, port), timeout=timeout)
        if at.scheme == "https":
            sock = ssl.create_default_context().wrap_socket(sock, server_hostname=at.hostname)
        connection = http.client.HTTPConnection(at.hostname, port, timeout=timeout)
        connection.sock = sock
        connection.request("GET", (at.path or "/") + (f"?{at.query}" if at.query else ""), headers=headers | {"Connection": "close"})
        reply = connection.getresponse()
    except TimeoutError as e:
        raise FetchError("timeout", str(e)) from e
    except OSError as e:
        raise FetchError("connection", str(e)) from e
    except http.client.HTTPException as e:
        raise FetchError("request", str(e)) from e
    return Response(reply.status, dict(reply.getheaders()), iter(lambda: reply.read(CHUNK), b""), url)


#: What every request says; a profile for a host and its subdomains may say otherwise.
DEFAULT_HEADERS = {"Accept": "text/html,application/xhtml+xml,text/plain;q=0.9,*/*;q=0.1", "User-Agent": "kgspark"}


def headers_for(url: str, profiles: dict[str, dict[str, str]] | None = None) -> dict[str, str]:
    """The headers of the longest host suffix that has a profile, else the default."""
    host = (urlsplit(url).hostname or "").rstrip(".").lower()
    fit = [s for s in profiles or {} if host == s or host.endswith(f".{s}")]
    return dict(profiles[max(fit, key=len)]) if fit else dict(DEFAULT_HEADERS)


def _origin(url: str) -> tuple[str, str, int] | None:
    at = urlsplit(url)
    if at.scheme not in ("http", "https") or not at.hostname:
        return None
    return at.scheme, at.hostname.rstrip(".").lower(), at.port or (443 if at.scheme == "https" else 80)


def public_get(url: str, timeout: float = 10, *, headers: Callable[[str], dict[str, str]] = headers_for, origin: str | None = None, resolver=resolve, requester=request) -> Response:
    """A GET that only reaches public addresses: each hop is http(s) without credentials, of ``origin`` if given, and all its addresses are global."""
    for _ in range(MAX_REDIRECTS + 1):
        at = urlsplit(url)
        where = _origin(url)
        if where is None or at.username is not None or at.password is not None:
            raise FetchError("invalid_url", "only http(s) URLs without credentials")
        if origin is not None and where != _origin(origin):
            raise FetchError("invalid_url", "outside of the given origin")
        addresses = resolver(where[1], where[2])
        if not addresses:
            raise FetchError("dns", f"no address for {where[1]}")
        if not all(ipaddress.ip_address(a).is_global for a in addresses):
            raise FetchError("invalid_url", "not a public address")
        reply = requester(url, addresses[0], headers(url), timeout)
        target = reply.header("Location")
        if reply.status not in REDIRECTS or not target:
            reply.url = url
            return reply
        url = sanitized(urljoin(url, target)) or ""
        if not url:
            raise FetchError("invalid_url", "a redirect to no valid URL")
    raise FetchError("request", "too many redirects")


def bounded_text(reply: Response, limit: int = MAX_RESPONSE) -> str:
    """The text of a response of an allowed type and size, bytes that aren't in its encoding replaced."""
    kind, _, rest = reply.header("Content-Type").partition(";")
    if kind.strip().lower() not in CONTENT_TYPES:
        raise FetchError("unsupported_content", kind)
    declared = reply.header("Content-Length")
    if declared.isdigit() and int(declared) > limit:
        raise FetchError("response_too_large")
    held, size = [], 0
    for chunk in reply.chunks:
        size += len(chunk)
        if size > limit:
            raise FetchError("response_too_large")
        held.append(chunk)
    charset = re.search(r"charset=[\"']?([\w-]+)", rest, re.I)
    try:
        return b"".join(held).decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        return b"".join(held).decode("utf-8", "replace")


def is_challenge(page: str, url: str) -> bool:
    low = page[:200_000].lower()
    return "/cdn-cgi/challenge-platform/" in urlsplit(url).path.lower() or any(m in low for m in STRONG_MARKS) or sum(m in low for m in SOFT_MARKS) >= 2


def retry_time(header: str, now: datetime) -> datetime | None:
    """A Retry-After header as a time, never before ``now``."""
    try:
        when = now + timedelta(seconds=int(header)) if header.strip().isdigit() else parsedate_to_datetime(header)
    except (ValueError, TypeError, OverflowError):
        return None
    return max(when if when.tzinfo else when.replace(tzinfo=UTC), now)


def fetch_document(url: str | None, timeout: float = 10, *, get: Callable[..., Response] = public_get, now: Callable[[], datetime] = lambda: datetime.now(UTC)) -> dict:
    """The outcome of one URL: content, final_url and canonical_url, or error_type with http_status and retry_at; never an exception."""
    if not url:
        return {"error_type": "invalid_input"}
    safe = sanitized(url)
    if not safe:
        return {"error_type": "invalid_url"}
    try:
        reply = get(safe, timeout)
        if reply.status >= 400:
            return {"error_type": "http_error", "http_status": reply.status, "retry_at": retry_time(reply.header("Retry-After"), now())}
        page, final = bounded_text(reply), sanitized(reply.url or safe) or safe
        if not page:
            return {"error_type": "download_failed"}
        if is_challenge(page, final):
            return {"error_type": "access_challenge", "final_url": final}
        plain = reply.header("Content-Type").lower().startswith("text/plain")
        text = " ".join(re.sub(r"(?i)https?://\S+", "", page if plain else main_text(page) or "").split())
        if not text:
            return {"error_type": "extraction_failed"}
        return {"content": text, "final_url": final, "canonical_url": canonical_link(page, final), "http_status": reply.status}
    except FetchError as e:
        return {"error_type": e.kind, "error_message": str(e)}
    except TimeoutError as e:
        return {"error_type": "timeout", "error_message": str(e)}
    except OSError as e:
        return {"error_type": "connection", "error_message": str(e)}
    except ValueError as e:
        return {"error_type": "download_failed", "error_message": str(e)}
    except Exception as e:
        return {"error_type": "unknown", "error_message": str(e)}


def worth_another_try(result: dict) -> bool:
    status = result.get("http_status")
    if result.get("error_type") == "http_error":
        return status == 408 or (status or 0) >= 500
    return result.get("error_type") in TRY_AGAIN
