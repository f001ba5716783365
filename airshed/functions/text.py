"""Text, path and key expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed.functions._util import col

# Fixed value: partition segment in object keys, e.g. ``.../date=2022-04-01/part-0.csv``.
DATE_IN_PATH = r"date=(\d{4}-\d{2}-\d{2})/"


def strip_ws(c) -> Column:
    """Trim leading/trailing whitespace (spaces, tabs, newlines)."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def country_of(c, sep: str = ",") -> Column:
    """Last comma segment, trimmed: ``'Tătărași Sud, Iași, Romania'`` -> ``'Romania'``."""
    return strip_ws(F.element_at(F.split(col(c), sep), -1))


def decode_key(c) -> Column:
    """URL-decode an object key (``+`` -> space).

    A ``%`` that does not start a two-hex-digit escape is kept literally
    (escaped as ``%25`` first), so a malformed escape leaves the rest of the
    key decoded instead of failing.
    """
    safe = F.regexp_replace(col(c), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), col(c))


def encode_city(c) -> Column:
    """Strip, then encode for a query string: letters, digits and ``-._~`` stay, a space becomes ``+``."""
    form = F.url_encode(strip_ws(c))  # leaves ``*`` and escapes ``~``
    return F.replace(F.replace(form, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def file_name(c) -> Column:
    """Last ``/`` segment; a folder marker ``a/`` gives ``''``."""
    return F.element_at(F.split(col(c), "/"), -1)


def starts_with_any(c, prefixes: Iterable[str]) -> Column:
    """Case-sensitive ``startswith`` against any of ``prefixes``."""
    prefixes = list(prefixes)
    if not prefixes:
        return F.lit(False)
    cond = col(c).startswith(prefixes[0])
    for p in prefixes[1:]:
        cond = cond | col(c).startswith(p)
    return cond


def remap_prefix(c, src: str, dst: str) -> Column:
    """``dst + key[len(src):]`` (the caller keeps only keys below ``src``)."""
    return F.concat(F.lit(dst), F.substr(col(c), F.lit(len(src) + 1)))


def graft(c, dst: str) -> Column:
    """Drop the first path segment and place the rest below ``dst``."""
    return F.concat(F.lit(dst.rstrip("/") + "/"), F.regexp_replace(col(c), r"^[^/]*/", ""))


def first_non_empty(*cs) -> Column:
    """First value that is neither NULL nor empty text, then stripped; ``''`` if none."""
    return strip_ws(F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cs], F.lit("")))


def strip_slash(c) -> Column:
    """``rstrip('/')``."""
    return F.regexp_replace(col(c), r"/+$", "")


def date_from_path(c) -> Column:
    """``yyyy-MM-dd`` from a ``date=`` path segment, NULL when absent."""
    return F.nullif(F.regexp_extract(col(c), DATE_IN_PATH, 1), F.lit(""))


def name_matches(c, names: Iterable[str], case_sensitive: bool = True) -> Column:
    """Set membership, exact or case-insensitive."""
    names = list(names)
    if case_sensitive:
        return col(c).isin(names)
    return F.lower(col(c)).isin([n.lower() for n in names])
