"""URL and domain functions: Column expressions, and a pandas UDF for international names only."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lanternflow import vocab
from lanternflow.functions.base import let

LABEL = r"[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
#: scheme, user part, host, port text, rest
URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:\[\]]*)(?::([^/?#]*))?([/?#][\s\S]*)?$"


@F.pandas_udf(StringType())
def _unescaped(raw: pd.Series) -> pd.Series:
    return raw.map(html.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def _idna(host: pd.Series) -> pd.Series:
    def one(h: str) -> str | None:
        try:
            return h.encode("idna").decode("ascii")
        except (UnicodeError, ValueError):
            return None

    return host.map(one, na_action="ignore")


def prepared(raw: Column) -> Column:
    """Trimmed, without angle brackets and quotes, out of a markdown link, with a scheme."""
    s = F.trim(F.regexp_replace(F.trim(raw), "^[<>\"']+|[<>\"']+$", ""))
    s = F.when(s.rlike(r"^\s*\[[^\]]+\]\([^)]+\)\s*$"), F.trim(F.regexp_extract(s, r"^\s*\[[^\]]+\]\(([^)]+)\)\s*$", 1))).otherwise(s)
    return F.when(s.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), s).otherwise(F.concat(F.lit("https://"), s))


def _host(s: Column) -> Column:
    h = F.regexp_replace(F.lower(F.regexp_extract(s, URL, 2)), r"\.+$", "")
    return F.regexp_replace(h, r"^www\.", "")


def _origin(s: Column, host: Column, suffixes: Sequence[str]) -> Column:
    port = F.regexp_extract(s, URL, 3)
    number = port.try_cast("int")
    good = host.rlike(rf"^{LABEL}(?:\.{LABEL})*$") & host.contains(".") & ~host.isin(*suffixes) & ~host.rlike(r"^[0-9.]+$")
    good = good & ((port == "") | (number.between(0, 65535) & port.rlike("^[0-9]+$")))
    tail = F.when((port == "") | number.isin(0, 80, 443), "").otherwise(F.concat(F.lit(":"), number.cast("string")))
    return F.when(good, F.concat(F.lit("https://"), host, tail))


def normalize_domain(raw: Column, suffixes: Sequence[str] = vocab.TWO_LABEL_SUFFIXES, international: bool = False) -> Column:
    """``https://host[:port]``, or null for what is no web origin with a public suffix.

    The built-in path covers ASCII; ``international`` adds HTML entities and IDNA, by pandas UDFs that run for rows that
    need them only."""
    if international:  # UDFs can't stand in a lambda
        s = prepared(F.when(raw.contains("&"), _unescaped(raw)).otherwise(raw))
        host = _host(s)
        return _origin(s, F.when(host.rlike(r"[^\x00-\x7F]"), _idna(host)).otherwise(host), suffixes)
    return let(prepared(raw), lambda s: let(_host(s), lambda host: _origin(s, host, suffixes)))


def host_of(origin: Column) -> Column:
    return F.lower(F.regexp_extract(origin, URL, 2))


def registered_domain(origin: Column, suffixes: Sequence[str] = vocab.TWO_LABEL_SUFFIXES, hosted: str = vocab.HOSTED_SUFFIX) -> Column:
    """The suffix and one label more of a normalised origin; hosted shops keep their own name."""

    def of(host: Column) -> Column:
        two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
        return F.when(host == "", None).when(host.endswith(hosted), host).when(two.isin(*suffixes), three).otherwise(two)

    return let(host_of(origin), of)


def same_registered_domain(a: Column, b: Column) -> Column:
    """Two unknown domains count as the same."""
    return registered_domain(a).eqNullSafe(registered_domain(b))


def asset_key(url: Column) -> Column:
    """Scheme and host in lower case, path as it is, no query or fragment."""
    bare = F.regexp_replace(url, r"[?#][\s\S]*$", "")
    head = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)"
    return F.concat(F.lower(F.regexp_extract(bare, head, 1)), F.regexp_replace(bare, head, ""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def in_suffix(origin: Column, suffix: str = ".in") -> Column:
    return host_of(origin).endswith(suffix)


def _profile(host: Column, path: Column) -> Column:
    platform = F.coalesce(*[F.when((host == h) | host.endswith("." + h), F.lit(p)) for h, p in vocab.SOCIAL_HOSTS.items()])

    def judged(platform: Column, low: Column) -> Column:
        starts = lambda names: F.coalesce(*[F.when(low.startswith(n), True) for n in names], F.lit(False))
        bad = low.isin(*vocab.SOCIAL_GENERIC) | path.rlike("(?i)" + vocab.SOCIAL_REJECT) | low.contains("shopify") | starts(("/hashtag/", "/search"))
        bad = bad | ((platform == "facebook") & low.isin(*vocab.FACEBOOK_PAGES))
        for name, starts_with in vocab.SOCIAL_FORBIDDEN.items():
            bad = bad | ((platform == name) & starts(starts_with))
        for name, starts_with in vocab.SOCIAL_REQUIRED.items():
            bad = bad | ((platform == name) & ~starts(starts_with))
        canonical = F.concat(F.lit("https://"), F.when(platform == "twitter", "x.com").otherwise(host), path)
        return F.when(platform.isNotNull() & ~bad, F.struct(platform.alias("platform"), canonical.alias("url")))

    return let(platform, lambda p: let(F.lower(path), lambda low: judged(p, low)))


def social_profile(url: Column) -> Column:
    """struct(platform, url) of an absolute profile url, else null."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r"^m\.", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    return let(host, lambda h: let(path, lambda p: _profile(h, p)))


def submitted_social_bad(platform: str, url: Column) -> Column:
    """What a finished export must not hold for a platform; empty values pass."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    hosts = vocab.SUBMISSION_HOSTS.get(platform, ())
    known = F.coalesce(*[F.when((host == h) | host.endswith("." + h), True) for h in hosts], F.lit(False)) if hosts else F.lit(False)
    path = F.lower(F.regexp_replace(path_of(url), "^/+|/+$", ""))
    web = url.rlike("(?i)^https?://")
    return (F.coalesce(url, F.lit("")) != "") & (~web | ~known | (path == "") | path.isin("login", "settings", "share", "intent") | url.rlike("(?i)" + vocab.SHARE_URL))


def forbidden_logo(url: Column) -> Column:
    """The path, never the host, names an icon or a payment mark."""
    path = F.lower(path_of(url))
    return path.endswith("favicon.ico") | path.rlike(vocab.REJECT_LOGO)


def retry_reason(error: Column) -> Column:
    """Class of an error text; the first that fits, in this order."""
    return let(F.lower(F.coalesce(error, F.lit(""))), _reason)


def _reason(e: Column) -> Column:
    has = lambda *names: F.coalesce(*[F.when(e.contains(n), True) for n in names], F.lit(False))
    return (
        F.when(has("robots.txt"), "ROBOTS_BLOCKED")
        .when(has("429"), "HTTP_429")
        .when(e.rlike(r"http\s+5\d\d"), "HTTP_5XX")
        .when(has("timeout", "timed out"), "TIMEOUT")
        .when(has("name or service not known", "nodename nor servname", "dns", "getaddrinfo"), "DNS_ERROR")
        .when(has("ssl", "certificate", "tls"), "SSL_ERROR")
        .when(has("connect", "network", "transporterror"), "CONNECTION_ERROR")
        .otherwise("OTHER_TRANSIENT")
    )
