"""String functions as pure Column expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character Python's str.isspace() accepts.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0 "
    "           "
    "    　"
)
# The same characters for use inside a Spark SQL string literal.
WHITESPACE_SQL = "".join(f"\\u{ord(char):04x}" for char in WHITESPACE)


def ustrip(col: Column | str) -> Column:
    """Strip Unicode whitespace from both ends, like ``str.strip()``."""
    return F.btrim(col, F.lit(WHITESPACE))


def nullif_blank(col: Column) -> Column:
    """Strip; blank becomes NULL."""
    return F.nullif(ustrip(col), F.lit(""))


def percent_decode(col: Column | str) -> Column:
    """Percent-decode: ``+`` stays, broken escapes stay, bad UTF-8 becomes U+FFFD."""
    safe = F.regexp_replace(col, "%(?![0-9A-Fa-f]{2})", "%25")
    decoded = F.url_decode(F.replace(safe, F.lit("+"), F.lit("%2B")))
    # Most URLs carry no escape at all: skip the regex and the decoder for them.
    plain = F.col(col) if isinstance(col, str) else col
    return F.when(plain.contains("%"), decoded).otherwise(plain)


def url_key(col: Column | str) -> Column:
    """Comparison key of a URL: stripped, then percent-decoded."""
    return percent_decode(ustrip(col))


def last_segment(col: Column | str) -> Column:
    """Text after the last ``/`` (the whole value if there is none)."""
    return F.substring_index(col, "/", -1)


def host_of(col: Column | str) -> Column:
    """Lower-case host of an absolute URL, NULL without one.

    Works on raw URLs with spaces, which ``try_parse_url`` rejects.
    """
    authority = F.regexp_extract(col, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    bare = F.regexp_replace(authority, r"^.*@|:\d*$", "")
    return F.nullif(F.lower(bare), F.lit(""))


def in_domain(url: Column | str, domain: str) -> Column:
    """True when the URL's host is ``domain`` or lies under it."""
    host = host_of(url)
    return (host == domain) | host.endswith("." + domain)


def media_provider(url: Column, site_domain: str) -> Column:
    """``unknown`` / ``internal`` / ``external`` for a media URL."""
    own = url.contains(site_domain) | url.contains("static")
    return (
        F.when(url.isNull() | (url == ""), "unknown")
        .when(own, "internal")
        .otherwise("external")
    )


def label_for(key: Column, labels: dict[str, str], default: str = "unknown") -> Column:
    """Look ``key`` up in a small fixed map; a literal map needs no join."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(default))
