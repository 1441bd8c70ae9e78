"""Normal form and fingerprint of URLs (RFC 3986), as Column expressions.

Two spellings of one address get the same normal form: scheme and host in lower
case, no default port, no dot segments, no fragment, one spelling of escapes, and
query parameters in order of name and value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from presslake.functions.text import ustrip

# Characters that never need an escape, and those that may stand
# raw in a path (RFC 3986, 2.3 and 3.3).
UNRESERVED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-._~"
PATH_CHARS = "!$&'()*+,;=:@/"
DEFAULT_PORTS = {"http": "80", "https": "443", "ftp": "21"}

_REST = 2_147_483_647  # up to the end

# The five parts of a URI reference (RFC 3986, appendix B).
_PARTS = r"\A(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#[\s\S]*)?\z"
_AUTHORITY = r"\A(?:([\s\S]*)@)?([\s\S]*?)(?::([0-9]*))?\z"

# Escapes of unreserved characters, and those with a digit in lower case.
_OWN = "2[DEde]|3[0-9]|4[1-9A-Fa-f]|5[0-9AFaf]|6[1-9A-Fa-f]|7[0-9AEae]"
_ODD = f"%(?:{_OWN}|[0-9A-Fa-f][a-f]|[a-f][0-9A-F])"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _decoder(chars: str) -> Column:
    """Two hex digits to the character they stand for, as a literal map."""
    return F.create_map(*[F.lit(x) for char in chars for x in (f"{ord(char):02X}", char)])


def _respelled(col: Column, found: str, spell: Callable[[Column], Column]) -> Column:
    """``col`` with ``spell`` of the two digits for each escape that ``found`` matches; the rest is not looked at."""

    def one(part: Column) -> Column:
        return F.when(
            part.rlike(rf"\A{found}"), F.concat(spell(F.substring(part, 2, 2)), F.substring(part, 4, _REST))
        ).otherwise(part)

    return F.array_join(F.transform(F.split(col, f"(?={found})", -1), one), "")


def escaped(col: Column, raw: str = "") -> Column:
    """``col`` with one spelling of each character.

    Unreserved characters stand for themselves, and so do those of ``raw`` where
    they stand for themselves already. Everything else is an upper-case escape of
    its UTF-8 bytes. An escape that is there stays an escape unless its character
    is unreserved; a ``%`` that starts none becomes ``%25``.
    """
    # Escape everything; what was an escape before is now %25 and two hex digits.
    every = F.replace(F.replace(F.url_encode(col), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    # The encoder leaves letters, digits and ".-_" as they are.
    plain = _decoder("~" + raw)
    codes = "|".join(f"{ord(char):02X}" for char in "~" + raw)
    kept = _respelled(every, f"%(?:{codes})", lambda code: plain[code])
    again = F.regexp_replace(kept, "%25([0-9A-Fa-f]{2})", "%$1")
    own = _decoder(UNRESERVED)
    return _respelled(again, _ODD, lambda code: F.coalesce(own[F.upper(code)], F.concat(F.lit("%"), F.upper(code))))


def without_dot_segments(path: Column) -> Column:
    """An absolute path with ``.`` and ``..`` resolved (RFC 3986, 5.2.4)."""

    def step(kept: Column, segment: Column) -> Column:
        # The first entry is the empty text before the leading slash; it never goes.
        return (
            F.when(segment == ".", kept)
            .when(segment == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1))))
            .otherwise(F.concat(kept, F.array(segment)))
        )

    def resolved(segments: Column) -> Column:
        kept = F.aggregate(F.slice(segments, 2, F.size(segments)), F.slice(segments, 1, 1), step)
        # A path that ends in a dot segment names the folder, with its slash.
        ends = F.element_at(segments, -1).isin(".", "..")
        return F.array_join(F.concat(kept, F.when(ends, F.array(F.lit(""))).otherwise(F.slice(segments, 1, 0))), "/")

    return _once(
        path,
        lambda p: F.when(p.rlike(r"(?:\A|/)\.\.?(?:/|\z)"), _once(F.split(p, "/", -1), resolved)).otherwise(p),
    )


def sorted_query(query: Column) -> Column:
    """Parameters by name and value; ``a`` is ``a=``, ``+`` a blank, empty parts go."""

    def parameter(part: Column) -> Column:
        name = F.substring_index(part, "=", 1)
        value = F.substring(part, F.char_length(name) + 2, F.lit(_REST))
        spelled = (escaped(F.replace(x, F.lit("+"), F.lit(" "))) for x in (name, value))
        name, value = (F.replace(x, F.lit("%20"), F.lit("+")) for x in spelled)
        return F.struct(name.alias("name"), value.alias("value"))

    parts = F.filter(F.split(query, "&", -1), lambda part: part != "")
    ordered = F.array_sort(F.transform(parts, parameter))
    return F.array_join(F.transform(ordered, lambda p: F.concat(p["name"], F.lit("="), p["value"])), "&")


def canonical_url(url: Column | str) -> Column:
    """The normal form of a URL; NULL stays NULL.

    User names and non-ASCII hosts keep their spelling. References without a host
    (``mailto:x``, ``../a``) keep their path but for its escapes.
    """
    names = ["scheme", "authority", "path", "query"]
    parts = _once(ustrip(url), lambda text: F.struct(*(F.regexp_extract(text, _PARTS, i + 1).alias(n) for i, n in enumerate(names))))
    return _once(parts, lambda part: _recomposed(*(part[name] for name in names)))


def _recomposed(scheme: Column, authority: Column, path: Column, query: Column) -> Column:
    """The normal form of the parts of one URL, as they were spelled."""
    scheme = F.lower(scheme)
    user, host, port = (F.regexp_extract(authority, _AUTHORITY, i) for i in (1, 2, 3))
    ports = F.create_map(*[F.lit(x) for item in DEFAULT_PORTS.items() for x in item])
    has_host = authority != ""
    spelled = F.when(path == "", "").otherwise(escaped(path, PATH_CHARS))
    rooted = F.when(path == "", "/").otherwise(without_dot_segments(spelled))
    query = F.when(query == "", "").otherwise(sorted_query(query))
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(has_host, "//").otherwise(""),
        F.when(authority.contains("@"), F.concat(user, F.lit("@"))).otherwise(""),
        F.lower(host),
        F.when((port == "") | port.eqNullSafe(ports[scheme]), "").otherwise(F.concat(F.lit(":"), port)),
        F.when(has_host, rooted).otherwise(spelled),
        _once(query, lambda q: F.when(q == "", "").otherwise(F.concat(F.lit("?"), q))),
    )


def url_fingerprint(url: Column | str) -> Column:
    """SHA-256 of the normal form, 32 bytes: equal for all spellings of one address."""
    return F.unhex(F.sha2(canonical_url(url), 256))
