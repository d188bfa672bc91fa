"""URL helpers: strict host (F6), lenient host and path (F7, F8), row key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The strict parser trims control characters and blanks at both ends, accepts these
# schemes only, reads the authority after "//" (user-info and port are not host, a port is a
# number or empty, a bracketed host is an IPv6 address) and finds an empty host without one.
OUTER_BLANKS = "".join(map(chr, range(0x21)))
STRICT_HOST = (r"(?is)^(?:url:)?(?:https?|ftp):"
               r"(?://(?:[^/?#]*@)?(\[[0-9a-f:.]+(?:%[^\]/?#]*)?\]|[^/?#:\[]*)(?::\+?[0-9]{0,9})?(?:[/?#].*)?|[^/].*|/[^/].*|/)?$")
SCHEME_SEP = "://"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_host(url) -> Column:
    """host of a well-formed URL (empty where it names none), NULL when the URL is malformed (P5).

    One pass of the pattern: it gives an array of one host, or an empty one for a malformed URL.
    """
    found = F.regexp_extract_all(F.btrim(_col(url), F.lit(OUTER_BLANKS)), F.lit(STRICT_HOST), F.lit(1))
    return F.try_element_at(found, F.lit(1))


def _after_scheme(url) -> Column:
    return F.regexp_replace(_col(url), r"^.*?://", "")


def lenient_host(url) -> Column:
    """text after the first ``://`` (or the whole string) up to the first ``/``; port kept."""
    return F.split(_after_scheme(url), "/", 2)[0]


def lenient_path(url) -> Column:
    """F8: the rest after the first ``/`` with exactly one leading ``/``; empty without any ``/``."""
    rest = _after_scheme(url)
    tail = F.try_element_at(F.split(rest, "/", 2), F.lit(2))
    return (F.when(tail.isNull(), F.lit(""))
            .when(tail.startswith("/"), tail)
            .otherwise(F.concat(F.lit("/"), tail)))


def row_key(url) -> Column:
    """lower-case hex MD5 of the full URL (UTF-8 bytes)."""
    return F.md5(_col(url).cast("binary"))
