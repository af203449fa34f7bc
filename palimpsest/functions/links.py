"""Column expressions over dump listings: links, file names, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the dump site.
HREF_PATTERN = 'href="(.+?)"'
HISTORY_NEEDLE = "pages-meta-history"
HISTORY_SUFFIX = ".bz2"
LATEST = "latest"
DUMP_HOST = "https://dumps.wikimedia.org"
WIKI = "enwiki"


def _text(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def hrefs(html: Column) -> Column:
    """All ``href`` values of an HTML text, in order, as an array.

    ``(?d)`` makes only ``\\n`` a line end, so a link may hold any other
    separator.
    """
    return F.regexp_extract_all(html, F.lit("(?d)" + HREF_PATTERN), F.lit(1))


def is_history_link(
    url: Column, needle: str = HISTORY_NEEDLE, suffix: str = HISTORY_SUFFIX
) -> Column:
    return url.contains(needle) & url.endswith(suffix)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dump_page_url(date: Column | str, host: str = DUMP_HOST, wiki: str = WIKI) -> Column:
    """The listing page of the dump of ``date`` (``YYYYMMDD`` or ``latest``)."""
    return F.format_string("%s/%s/%s/", F.lit(host), F.lit(wiki), _text(date))


def manifest_url(date: Column | str, host: str = DUMP_HOST, wiki: str = WIKI) -> Column:
    """The checksum manifest of the dump of ``date``."""
    name = F.format_string("%s-%s-md5sums.txt", F.lit(wiki), _text(date))
    return F.concat(dump_page_url(date, host, wiki), name)


def full_url(
    partial: Column,
    date: Column | str,
    host: str = DUMP_HOST,
    wiki: str = WIKI,
    on_unexpected: str = "raise",
) -> Column:
    """Absolute URL of a listing link.

    Dated listings link with a path from the root, the ``latest`` one with bare
    file names. Any other pairing means that the site has changed: the job
    fails, or the URL is null with ``on_unexpected="null"``.
    """
    if on_unexpected not in ("raise", "null"):
        raise ValueError("on_unexpected is 'raise' or 'null'")
    rooted = partial.startswith("/")
    latest = _text(date) == F.lit(LATEST)
    url = F.when(~latest & rooted, F.concat(F.lit(host), partial)).when(
        latest & ~rooted, F.concat(dump_page_url(LATEST, host, wiki), partial)
    )
    if on_unexpected == "raise":
        message = F.concat(F.lit("unexpected link in the dump listing: "), partial)
        url = url.when(partial.isNotNull(), F.raise_error(message).cast("string"))
    return url
