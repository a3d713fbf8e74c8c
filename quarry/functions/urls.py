"""URL expressions: key normalisation, source domain and validity.

All three are pure Catalyst expressions (regexp / btrim / lower), so they run
inside whole-stage codegen and push no Python worker into the plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import bind, strip

# URL grammar pieces (RFC 3986 scheme syntax, C0 controls that a
# URL splitter strips, and the maximum accepted URL length).
SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
LEADING_C0_RE = r"^[\x00-\x20]+"
UNSAFE_RE = r"[\t\r\n]"
FRAGMENT_RE = r"(?s)#.*$"
EMPTY_QUERY_RE = r"^([^?]*)\?$"
PATH_RE = r"^(?:[a-z][a-z0-9+.\-]*:)?(?://[^/?]*)?([^?]*)"
AUTHORITY_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
# scheme, user info, host (name, IPv4 or bracketed IPv6), port up to 65535
VALID_URL_RE = (r"^(?i:https?)://(?:[^/?#@\s]*@)?(?:\[[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*\]|[^\s/?#@:\[\]<>\\^|%\"`{}]+)"
                r"(?::0*(?:[0-9]{1,4}|[1-5][0-9]{4}|6[0-4][0-9]{3}|65[0-4][0-9]{2}|655[0-2][0-9]|6553[0-5])?)?(?:[/?#]|$)")
MAX_URL_LENGTH = 2083


def url_key(url: Column) -> Column:
    """Canonical key of a URL: trim, drop the fragment, drop one trailing
    slash unless the path is empty or ``/``.  An empty query marker ``?`` is
    dropped and the scheme is lower-cased, as a URL split/unsplit would."""
    s = strip(url)
    s = F.regexp_replace(s, LEADING_C0_RE, "")
    s = F.regexp_replace(s, UNSAFE_RE, "")
    s = F.regexp_replace(s, FRAGMENT_RE, "")
    s = F.regexp_replace(s, EMPTY_QUERY_RE, "$1")

    def with_scheme(s: Column) -> Column:
        return bind(F.regexp_extract(s, SCHEME_RE, 1), lambda sc: F.when(sc == "", s).otherwise(
            F.concat(F.lower(sc), s.substr(F.length(sc) + 1, F.lit(2 ** 31 - 1)))))

    def drop_slash(k: Column) -> Column:
        drop = k.endswith("/") & ~F.regexp_extract(k, PATH_RE, 1).isin("", "/")
        return F.when(drop, k.substr(F.lit(1), F.length(k) - 1)).otherwise(k)

    return F.when(url.isNotNull(), bind(bind(s, with_scheme), drop_slash))


def source_domain(url: Column) -> Column:
    """Network location (host, with port and userinfo) of a URL; null when
    there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), AUTHORITY_RE, 1), F.lit(""))


def url_is_valid(url: Column) -> Column:
    """http(s) URL with a host and at most the accepted length."""
    return F.coalesce(url.rlike(VALID_URL_RE) & (F.length(url) <= MAX_URL_LENGTH), F.lit(False))
