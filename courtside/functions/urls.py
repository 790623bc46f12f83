"""Link extraction and URL rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtside.functions.text import MAX_ATTRIBUTES, RE_COMMENTS, RE_HIDDEN_BLOCKS, RE_TAG, decode_entities

# The first href of one tag (C11), in double quotes, single quotes or bare; the
# group holds the value with its quotes.  Attributes before it are passed over
# whole, so neither ``data-href`` nor an ``href=`` inside another value counts.
RE_ANCHOR = r"(?i)^<a\s"
RE_ANCHOR_HREF = (
    r"""(?i)^<a(?:\s+[^\s>=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?){0,%d}?\s+href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""" % MAX_ATTRIBUTES
)
RE_QUOTES = r"""^["']|["']$"""
RE_TRAILING_SLASH = r"/+$"
RE_SCHEME_HOST = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"
RE_PLAYER_ID = r"player/(\d+)/"


def anchor_hrefs(html: Column | str) -> Column:
    """``array<string>`` of every anchor href in document order (C11).

    What a page only quotes, in scripts, styles, templates, comments or
    attribute values, holds no anchors: the page is cut into tags first.
    Entities in a value are decoded as an HTML parser does.
    """
    h = F.regexp_replace(F.coalesce(_col(html), F.lit("")), RE_HIDDEN_BLOCKS, "")
    tags = F.regexp_extract_all(F.regexp_replace(h, RE_COMMENTS, ""), F.lit(RE_TAG), 0)
    anchors = F.filter(tags, lambda t: t.rlike(RE_ANCHOR))
    values = F.filter(F.transform(anchors, lambda t: F.regexp_extract(t, RE_ANCHOR_HREF, 1)), lambda v: v != "")
    return F.transform(values, lambda v: decode_entities(F.regexp_replace(v, RE_QUOTES, "")))


def strip_trailing_slash(url: Column | str) -> Column:
    """Normalise a link by removing trailing slashes."""
    return F.regexp_replace(_col(url), RE_TRAILING_SLASH, "")


def scheme_host(url: Column | str) -> Column:
    """``https://host`` part of an absolute URL, ``''`` otherwise."""
    return F.regexp_extract(_col(url), RE_SCHEME_HOST, 1)


def absolutize(href: Column | str, base_url: Column | str) -> Column:
    """Resolve root-relative and protocol-relative hrefs against the base.

    Only ``/path`` and ``//host/path`` are resolved; any other relative form is
    kept as written (and so never matches an absolute page URL).
    """
    h = _col(href)
    base = _col(base_url)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    return (F.when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
             .when(h.startswith("/"), F.concat(scheme_host(base), h))
             .otherwise(h))


def prefix_if_relative(url: Column | str, base: str) -> Column:
    """Prefix a fixed base when the URL starts with ``/``."""
    u = _col(url)
    return F.when(u.startswith("/"), F.concat(F.lit(base), u)).otherwise(u)


def join_url(base_url: Column | str, path: Column | str) -> Column:
    """``urljoin(base, path)`` for the seed forms (A1).

    Absolute paths are kept, root-relative ones replace the base path, and a
    relative path replaces the last segment of the base.
    """
    b = _col(base_url)
    p = _col(path)
    base_dir = F.regexp_replace(b, r"[^/]*$", "")
    return (F.when(p.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), p)
             .when(p.startswith("/"), F.concat(scheme_host(b), p))
             .otherwise(F.concat(base_dir, p)))


def last_segment(url: Column | str) -> Column:
    """Node id = last path segment after trailing slashes are removed (C14)."""
    return F.element_at(F.split(strip_trailing_slash(url), "/"), -1)


def player_id(url: Column | str) -> Column:
    """Numeric id from ``.../player/<id>/...``; ``''`` when absent."""
    return F.regexp_extract(_col(url), RE_PLAYER_ID, 1)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
