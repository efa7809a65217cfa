"""URL identity as Arrow-batched functions (host encoding and escapes have no JVM counterpart)."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import quote, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_SCHEME = re.compile(r"[a-zA-Z][a-zA-Z0-9+.-]*://")
_BAD_ESCAPE = re.compile(r"%(?![0-9A-Fa-f]{2})")


def _parts(url: str | None):
    """(split URL, ASCII host, port) of an http(s) URL, https by default; None if it isn't one."""
    text = (url or "").strip()
    if not text:
        return None
    try:
        split = urlsplit(text if _SCHEME.match(text) else f"https://{text}")
        host, port = split.hostname, split.port
        if split.scheme not in ("http", "https") or not host or re.search(r'[\s"<>]', host):
            return None
        return split, host.encode("idna").decode("ascii"), port
    except ValueError:
        return None


def _escape(part: str, safe: str) -> str:
    return quote(_BAD_ESCAPE.sub("%25", part), safe=safe + "%")


def sanitized(url: str | None) -> str | None:
    """Safe form: no user info, ASCII host, only valid escapes; the port stays."""
    found = _parts(url)
    if not found:
        return None
    split, host, port = found
    path, mark, params = split.path.rpartition(";") if ";" in split.path.rpartition("/")[2] else (split.path, "", "")
    shown = _escape(path, "/") + mark + params
    return urlunsplit((split.scheme, host if port is None else f"{host}:{port}", shown, _escape(split.query, "=&?"), _escape(split.fragment, "")))


def document_key(url: str | None) -> str | None:
    """The resource a URL names: sanitised, no default port, no fragment, at least ``/``."""
    safe = sanitized(url)
    if safe is None:
        return None
    split = urlsplit(safe)
    default = (split.scheme, split.port) in (("http", 80), ("https", 443))
    host = split.hostname if split.port is None or default else f"{split.hostname}:{split.port}"
    return urlunsplit((split.scheme, host, split.path or "/", split.query, ""))


def organization_site(url: str | None) -> str | None:
    """The https root of a site: no leading www., no default port."""
    found = _parts(url)
    if not found:
        return None
    _, host, port = found
    return f"https://{host.removeprefix('www.')}" + (f":{port}" if port and port not in (80, 443) else "")


class _Canonical(HTMLParser):
    href: str | None = None

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        if self.href is None and tag == "link" and "canonical" in (own.get("rel") or "").lower().split() and own.get("href"):
            self.href = own["href"]


def canonical_link(html: str | None, url: str | None) -> str | None:
    """The first canonical link of a page, resolved against its URL and sanitised."""
    if not html:
        return None
    parser = _Canonical()
    parser.feed(html)
    return sanitized(urljoin(url or "", parser.href.strip())) if parser.href else None


def _series(f):
    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(f)

    return run


class _Text(HTMLParser):
    """The blocks of a page's main part: headings, paragraphs, list items, cells and quotations outside of scripts, menus and the like."""

    SKIP = {"script", "style", "noscript", "template", "nav", "header", "footer", "aside", "form", "button", "select", "svg", "iframe", "head"}
    BLOCK = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "td", "th", "pre", "div", "article", "section", "main", "br", "figcaption", "dd", "dt"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.links, self.blocks, self.linked, self.main = [], 0, [""], [0], []

    def _end_block(self):
        if self.blocks[-1].strip():
            self.blocks.append("")
            self.linked.append(0)

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.hidden.append(tag)
        elif tag in ("article", "main"):
            self._end_block()
            self.main.append([len(self.blocks) - 1, None])
        elif tag in self.BLOCK:
            self._end_block()
        self.links += tag == "a"

    def handle_endtag(self, tag):
        if tag in self.hidden:
            while self.hidden.pop() != tag:
                pass
        elif tag in self.BLOCK:
            self._end_block()
            if tag in ("article", "main") and self.main and self.main[-1][1] is None:
                self.main[-1][1] = len(self.blocks) - 1
        if tag == "a":
            self.links = max(0, self.links - 1)

    def handle_data(self, data):
        if not self.hidden:
            self.blocks[-1] += data
            self.linked[-1] += len(data.strip()) * (self.links > 0)


def main_text(page: str | None) -> str | None:
    """The text of a page's main part, a line for each block, without its URLs; null if there is none.

    Blocks that are mostly links are menus and go.  If the page marks an article or a main part, only that counts.
    """
    if not page:
        return None
    parser = _Text()
    parser.feed(page)
    parser.close()
    lo, hi = parser.main[0] if parser.main else (0, None)
    kept = [" ".join(re.sub(r"(?i)https?://\S+", "", b).split()) for b, n in list(zip(parser.blocks, parser.linked))[lo:hi] if 2 * n <= len(b.strip())]
    return "\n".join(b for b in kept if b) or None


_PAGE_TEXT = _series(main_text)


def page_text(html: Column) -> Column:
    return _PAGE_TEXT(html)


_SANITIZED, _KEY, _SITE = _series(sanitized), _series(document_key), _series(organization_site)


@F.pandas_udf(StringType())
def _canonical_link(html: pd.Series, url: pd.Series) -> pd.Series:
    return pd.Series([canonical_link(h, u) for h, u in zip(html, url)], dtype=object)


def sanitize_url(c: Column) -> Column:
    return _SANITIZED(c)


def document_url(c: Column) -> Column:
    return _KEY(c)


def organization_url(c: Column) -> Column:
    return _SITE(c)


def page_canonical(html: Column, url: Column) -> Column:
    return _canonical_link(html, url)


def redact_credentials(c: Column) -> Column:
    """A URL without its user info."""
    return F.regexp_replace(c, r"^([a-zA-Z][a-zA-Z0-9+.-]*://)[^/?#]*@", "$1")


def origin(c: Column) -> Column:
    """struct(scheme, host, port): host without a trailing dot, the effective port."""
    scheme = F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(c, r"^[^/]*//(?:[^/?#]*@)?([^/?#:]+)", 1)), r"\.$", "")
    port = F.regexp_extract(c, r"^[^/]*//[^/?#]*:(\d+)(?:[/?#]|$)", 1)
    known = F.when(port != "", port.cast("int")).when(scheme == "https", 443).when(scheme == "http", 80)
    return F.when(scheme.isin("http", "https") & (host != ""), F.struct(scheme.alias("scheme"), host.alias("host"), known.alias("port")))


def url_domain(c: Column) -> Column:
    """The third ``/``-separated part, ``unknown`` if there is none."""
    return F.coalesce(F.nullif(F.split_part(c, F.lit("/"), F.lit(3)), F.lit("")), F.lit("unknown"))


#: Marks of a bot challenge; one strong mark, or two of the others.
STRONG_MARKS = ("cf-chl-", "/cdn-cgi/challenge-platform/", 'id="challenge-form"', "id='challenge-form'")
SOFT_MARKS = (
    "verify you are human", "checking your browser", "enable javascript and cookies", "g-recaptcha",
    "hcaptcha", "cf-turnstile", "attention required! | cloudflare",
)


def access_challenge(html: Column, url: Column) -> Column:
    """Whether a page is a bot challenge, by its first 200,000 characters and its URL's path."""
    low = F.lower(F.substring(html, 1, 200_000))
    path = F.lower(F.regexp_extract(url, r"^[^/]*//[^/?#]*([^?#]*)", 1))
    strong = F.lit(False)
    for m in STRONG_MARKS:
        strong = strong | low.contains(m)
    soft = sum((low.contains(m).cast("int") for m in SOFT_MARKS), F.lit(0))
    return F.coalesce(path.contains("/cdn-cgi/challenge-platform/") | strong | (soft >= 2), F.lit(False))


def retry_after(header: Column, now: Column) -> Column:
    """A Retry-After header as a time, seconds or an HTTP date, never before ``now``; null if it is neither."""
    seconds = F.when(header.rlike(r"^\s*\d{1,9}\s*$"), now + F.make_dt_interval(secs=F.trim(header).try_cast("int")))
    date = F.regexp_extract(header, r"^\s*\w{3}, (\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2}) GMT\s*$", 1)
    when = F.coalesce(seconds, F.try_to_timestamp(date, F.lit("dd MMM yyyy HH:mm:ss")))
    return F.when(when.isNotNull(), F.greatest(when, now))


#: What a fetched document may be, and how large.
CONTENT_TYPES, MAX_RESPONSE = ("text/html", "application/xhtml+xml", "text/plain"), 5 * 1024 * 1024


def decoded(body: Column) -> Column:
    """The text of a body of at most MAX_RESPONSE bytes, bytes that are no UTF-8 replaced; null beyond that."""
    return F.when(F.octet_length(body) <= MAX_RESPONSE, F.make_valid_utf8(body.cast("string")))


def fetch_problem(content_type: Column, size: Column) -> Column:
    """unsupported_content, response_too_large or null."""
    kind = F.lower(F.trim(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1))))
    return F.when(~kind.isin(*CONTENT_TYPES), "unsupported_content").when(size > MAX_RESPONSE, "response_too_large")


def valid_iri(c: Column) -> Column:
    """An absolute http(s) IRI without forbidden characters, bad escapes or user info; else null."""
    fine = c.rlike(r"^https?://[^/?#@]+([/?#]|$)") & ~c.rlike(r"[\x00-\x20<>\"{}|^`\\]") & ~c.rlike("%(?![0-9A-Fa-f]{2})")
    return F.when(fine, c)
