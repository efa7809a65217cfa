"""Text canonicalisation, identity text and hash identifiers as column functions."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as Python's str.split has it.
SPACES = r"[\x09-\x0D\x1C-\x20\x85\p{Z}]+"


def collapse(c: Column) -> Column:
    """White space runs to one blank, none at the ends; JVM only."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def _canonical(value: str | None) -> str | None:
    if value is None:
        return None
    value = value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return " ".join(html.unescape(value.replace("&amp;", "&").replace("\xa0", " ")).split())


@F.pandas_udf(StringType())
def _canonical_udf(s: pd.Series) -> pd.Series:
    return s.map(_canonical)


#: Texts that hold nothing to decode need no Python.
_PLAIN = r"^[\x09-\x0D\x20-\x25\x27-\x7E]*$"


def canonical_text(c: Column) -> Column:
    """Entities decoded (``&amp;`` twice), white space collapsed; for text that may hold entities."""
    plain = c.rlike(_PLAIN)
    return F.when(plain, collapse(c)).otherwise(_canonical_udf(F.when(~plain, c)))


def analysis_text(c: Column) -> Column:
    """A canonical text without its http(s) URLs."""
    return collapse(F.regexp_replace(c, r"(?i)https?://\S+", ""))


def claim_problem(c: Column) -> Column:
    """Why a canonical text is no claim: empty, url_only, no_alphanumeric; null if it is one."""
    return (
        F.when(F.coalesce(c, F.lit("")) == "", "empty")
        .when(analysis_text(c) == "", "url_only")
        .when(~c.rlike(r"[\p{L}\p{N}]"), "no_alphanumeric")
    )


@F.pandas_udf(StringType())
def _identity_udf(s: pd.Series) -> pd.Series:
    word = re.compile(r"\w+")
    return s.map(lambda v: None if v is None else " ".join(word.findall(unicodedata.normalize("NFKC", v).casefold())))


def identity_text(c: Column) -> Column:
    """Case-folded compatibility form, word characters only, joined by blanks."""
    plain = c.rlike(r"^[\x00-\x7F]*$")
    words = F.array_join(F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9_]+)"), F.lit(1)), " ")
    return F.when(plain, words).otherwise(_identity_udf(F.when(~plain, c)))


def digest(namespace: str, *values: Column) -> Column:
    """SHA-256 of the compact JSON array [namespace, values...]."""
    return F.sha2(F.to_json(F.array(F.lit(namespace), *values)), 256)


def stable_hash(**values: Column) -> Column:
    """SHA-256 of a compact JSON object with sorted keys, nulls included."""
    fields = F.struct(*[values[k].alias(k) for k in sorted(values)])
    return F.sha2(F.to_json(fields, {"ignoreNullFields": "false"}), 256)


def as_uuid(hex_digest: Column) -> Column:
    """The first 128 bits of a digest in UUID form; stable whenever it is computed again."""
    return F.regexp_replace(F.substring(hex_digest, 1, 32), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


#: The rating labels that count as normalised.
NORMALIZED_RATINGS = (
    "misinformed_or_potentially_misleading", "not_misleading", "uncertain", "not_credible",
    "not_verifiable", "credible", "mostly_credible",
)


def rating_label(c: Column) -> Column:
    """A raw label in the normalised vocabulary, else null."""
    low = F.lower(collapse(c))
    plain = F.regexp_replace(collapse(F.translate(low, "-/", "__")), " ", "_")
    return F.when(low == "false", "not_credible").when(low == "true", "credible").when(plain.isin(*NORMALIZED_RATINGS), plain)


def label_segment(c: Column) -> Column:
    """A model label as an IRI segment: lower case, blanks to ``_``, the rest percent-encoded but ``-._~``."""
    encoded = F.url_encode(F.regexp_replace(F.lower(F.trim(c)), " ", "_"))
    return F.replace(F.replace(F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A")), F.lit("+"), F.lit("%20"))


#: What a wiki text loses or keeps, in this order (links keep their label, italics and bold their text).
WIKI_RULES = (
    (r"\[\[([^>]+)>>[^\]]*\]\]", "$1"),
    (r"\{\{[^}]*\}\}", ""),
    (r"\(%[^)]*%\)", ""),
    (r"//([^/]+)//", "$1"),
    (r"\*\*([^*]+)\*\*", "$1"),
)


def strip_wiki(c: Column) -> Column:
    """A wiki text as plain text; headings and lone marks stay as they are."""
    for pattern, to in WIKI_RULES:
        c = F.regexp_replace(c, pattern, to)
    return collapse(c)


@F.pandas_udf(StringType())
def _unescape_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else html.unescape(v))


#: Link targets, and what a bare URL is made of.
HREF, BARE_URL = r"""(?i)href\s*=\s*['"]([^'"]+)['"]""", r"(https?://[\p{L}\p{N}_\-.~:/?#\[\]@!$&'()*+,;=%]+)"


def extract_urls(c: Column) -> Column:
    """Link targets first, then bare URLs, each once, in order; entities are decoded before."""
    c = F.when(c.contains("&"), _unescape_udf(F.when(c.contains("&"), c))).otherwise(c)
    return F.array_distinct(F.concat(F.regexp_extract_all(c, F.lit(HREF), F.lit(1)), F.regexp_extract_all(c, F.lit(BARE_URL), F.lit(1))))


def register(spark) -> list[str]:
    """Make the engine's scalar functions known to SQL; returns their names."""
    from . import urls

    table = {
        "canonical_text": _canonical_udf, "identity_text": _identity_udf, "html_unescape": _unescape_udf,
        "sanitize_url": urls._SANITIZED, "document_url": urls._KEY, "organization_url": urls._SITE, "page_canonical": urls._canonical_link, "page_text": urls._PAGE_TEXT,
    }
    for name, f in table.items():
        spark.udf.register(name, f)
    return sorted(table)


def full_uri(c: Column, base: str) -> Column:
    """Absolute IRIs as they are, others under ``base``."""
    return F.when(c.startswith("http"), c).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(c, "^/+", "")))


def factor_title(value: Column, category: Column | None = None) -> Column:
    """How a factor value is shown: Unknown if empty, climate flags in words, else words with capitals."""
    words = F.initcap(F.regexp_replace(F.lower(F.translate(value, "_-", "  ")), r"\s+", " "))
    title = F.when(F.coalesce(value, F.lit("")) == "", "Unknown").otherwise(words)
    if category is None:
        return title
    climate = category == "climate_related"
    return F.when(climate & (value == "true"), "Climate Related").when(climate & (value == "false"), "Not Climate Related").otherwise(title)
