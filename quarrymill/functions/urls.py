"""Column functions on URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track clicks, besides all that begin with utm_.
TRACKING = ("gclid", "fbclid", "msclkid", "mc_cid", "mc_eid")


def _parts(c: Column) -> tuple[Column, Column, Column, Column]:
    url = F.trim(c)
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    return scheme, host, path, query


def normalize(c: Column) -> Column:
    """One spelling of a web address: lower-case scheme and host, no default port, fragment or tracking, sorted parameters, no slash at the end.

    Anything but http and https comes back as it is; null stays null.
    """
    scheme, host, path, query = _parts(c)
    host = F.regexp_replace(host, r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(path, r"/{2,}", "/"), r"/+$", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(?i:utm_[^=]*|" + "|".join(TRACKING) + ")(=|$)")))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(scheme.isin("http", "https"), F.concat(scheme, F.lit("://"), host, path, tail)).otherwise(c)


def host(c: Column) -> Column:
    """The lower-case host without port; empty where there is none."""
    return F.regexp_replace(F.coalesce(_parts(c)[1], F.lit("")), r":\d+$", "")


def path(c: Column) -> Column:
    return F.coalesce(_parts(c)[2], F.lit(""))


def family(c: Column) -> Column:
    """What the language versions of a page share: the normal form without query and leading language segment."""
    bare = F.regexp_replace(normalize(c), r"\?.*$", "")
    return F.regexp_replace(bare, r"^(https?://[^/]+)/(ar|de|en|es|fr)(/|$)", "$1$3")


def on_host(c: Column, suffix: str) -> Column:
    """Whether a URL's host is `suffix` or below it."""
    h = host(c)
    return (h == suffix) | F.endswith(h, F.lit("." + suffix))


def page_type(c: Column) -> Column:
    """A page's kind by its path."""
    p = F.lower(path(c))
    return (
        F.when(p.rlike(r"\.pdf$"), "pdf").when(p.rlike(r"/(news|events)(/|$)"), "news_or_event").when(p.rlike(r"/(apply|admissions?)(/|$)"), "admission")
        .when(p.rlike(r"/(people-and-units|labs)(/|$)"), "unit").when(p.rlike(r"/(study|research)(/|$)"), "study_or_research").when(p.isin("", "/"), "home").otherwise("page")
    )


def path_language(c: Column) -> Column:
    """The language code that leads a path; null where there is none."""
    return F.nullif(F.regexp_extract(path(c), r"^/(ar|de|en|es|fr)(?:/|$)", 1), F.lit(""))
