"""URL parts and link policies. Parsing never raises: a malformed URL has null parts."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import filled

#: Query parameters that identify a vacancy across a redirect.
IDENTITY = ("ref", "JobId", "emp", "WVID", "VACANCY_ID")
_PARTS = r"\A(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?\z"


def _part(url: Column | str, k: int) -> Column:
    return F.regexp_extract(filled(url), f"(?s){_PARTS}", k)


def scheme(url: Column | str) -> Column:
    return F.lower(_part(url, 1))


def authority(url: Column | str) -> Column:
    """Host with user and port, as the link policies compare it."""
    return _part(url, 2)


def path(url: Column | str) -> Column:
    return _part(url, 3)


def query(url: Column | str) -> Column:
    return _part(url, 4)


def is_web(url: Column | str) -> Column:
    """Absolute http or https with a host."""
    return scheme(url).isin("http", "https") & (authority(url) != "")


def is_safe(url: Column | str) -> Column:
    """What a browser on an https page would open: relative links resolve to the page, other schemes do not.

    As browsers do, tabs and line ends anywhere and controls and spaces at the ends are ignored. http and https need a host.
    """
    x = F.regexp_replace(F.regexp_replace(filled(url), r"[\t\n\r]", ""), r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")
    return (x != "") & ((scheme(x) == "") | x.rlike(r"(?i)\Ahttps?:[/\\]*[^/\\?#]"))


def parameter(url: Column | str, key: str, any_case: bool = False) -> Column:
    """The first nonempty value of a query parameter, decoded; empty if there is none."""
    flag = "(?i)" if any_case else ""
    raw = F.regexp_extract(query(url), rf"{flag}(?:\A|&)\Q{key}\E=([^&]+)", 1)
    return F.coalesce(F.try_url_decode(raw), raw)


def has_parameter(url: Column | str, key: str) -> Column:
    """Whether the key is there in any case, with or without a value."""
    return query(url).rlike(rf"(?i)(\A|&)\Q{key}\E(=|&|\z)")


def slug(url: Column | str) -> Column:
    """The last segment of the path."""
    return F.element_at(F.split(F.rtrim(path(url), F.lit("/")), "/"), -1)


def _resolve(href: pd.Series, page: pd.Series) -> pd.Series:
    def join(h, p):
        try:
            return urljoin(p or "", h or "")
        except ValueError:
            return None

    return pd.Series([join(h, p) for h, p in zip(href, page, strict=True)])


def resolved(href: Column | str, page: Column | str) -> Column:
    """A link resolved against its page; no built-in does this."""
    return F.pandas_udf(_resolve, "string")(href, page)


def same_site(url: Column | str, page: Column | str) -> Column:
    """An advert link must stay on its page's host, over http or https."""
    return scheme(url).isin("http", "https") & (authority(url) == authority(page))


def redirect_kept(requested: Column | str, final: Column | str) -> Column:
    """A redirect must keep the host, the identity parameters and a `-v<number>` in the path."""
    kept = authority(requested) == authority(final)
    for key in IDENTITY:
        kept &= parameter(requested, key) == parameter(final, key)
    version = lambda u: F.regexp_extract(path(u), r"-v(\d+)", 1)
    return kept & ((version(requested) == "") | (version(requested) == version(final)))


def destination(method: Column | str, fixed_route: Column | str, observed: Column | str, stable: Column) -> Column:
    """The link to show: for session-bound portals the registered board, unless a fresh session proved the link."""
    bound = (filled(method) == "itrent") & (has_parameter(observed, "usession") | ~stable)
    return F.when(bound, filled(fixed_route)).otherwise(filled(observed))


def destination_problem(link: Column | str, method: Column | str, fixed_route: Column | str, stable: Column) -> Column:
    """Why a shown link breaks the policy, or null: not absolute http(s), or session-bound instead of the registered board."""
    return F.when(~is_web(link), "link_not_web").when(filled(link) != destination(method, fixed_route, link, stable), "link_bound_to_session")


def advert_link(href: Column | str, page: Column | str) -> Column:
    """A listed link resolved against its page, or null where it leaves the page's site."""
    target = resolved(href, page)
    return F.when(same_site(target, page), target)
