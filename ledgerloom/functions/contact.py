"""E-mail addresses, hosts and their relations as Spark columns.

All lists are parameters; the defaults stand in ``constants``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .text import col, strip


@dataclass(frozen=True)
class Lists:
    """The word lists that decide about addresses and pages."""

    blocked_domains: list[str] = field(default_factory=lambda: list(C.BLOCKED_EMAIL_DOMAINS))
    blocked_locals: list[str] = field(default_factory=lambda: list(C.BLOCKED_LOCALS))
    blocked_urls: list[str] = field(default_factory=lambda: list(C.BLOCKED_URL_PARTS))
    noise_sources: list[str] = field(default_factory=lambda: list(C.NOISE_SOURCE_DOMAINS))
    free_mail: list[str] = field(default_factory=lambda: list(C.FREE_MAIL_DOMAINS))
    blog_hosts: list[str] = field(default_factory=lambda: list(C.BLOG_HOSTS))
    news_words: list[str] = field(default_factory=lambda: list(C.NEWS_WORDS))
    business_locals: list[str] = field(default_factory=lambda: list(C.BUSINESS_LOCALS))
    contact_words: list[str] = field(default_factory=lambda: list(C.CONTACT_WORDS))
    contact_stopwords: list[str] = field(default_factory=lambda: list(C.CONTACT_STOPWORDS))


DEFAULT = Lists()
#: Marks that no local part begins or ends with.
_OUTER_MARKS = r"^[.\-_%+]|[.\-_%+]$"


def _text(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(""))


def local_part(email: str | Column) -> Column:
    """What stands before the first @ (all of it without one)."""
    return F.substring_index(_text(email), "@", 1)


def domain_part(email: str | Column) -> Column:
    """What stands after the first @, '' without one."""
    return F.regexp_extract(_text(email), r"(?s)^[^@]*@(.*)$", 1)


def url_host(url: str | Column, lower: bool = True) -> Column:
    """The authority of a URL, port included, without 'www.' anywhere; '' if there is none."""
    host = F.regexp_extract(_text(url), r"^(?:[A-Za-z][\w+.\-]*:)?//([^/?#]*)", 1)
    return F.replace(F.lower(host) if lower else host, F.lit("www."), F.lit(""))


def domain_base(domain: str | Column) -> Column:
    """A domain without the usual endings, wherever they stand, and without outer dots."""
    base = _text(domain)
    for ending in C.DOMAIN_ENDINGS:
        base = F.replace(base, F.lit(ending), F.lit(""))
    return F.regexp_replace(base, r"^\.+|\.+$", "")


def _within(a: Column, b: Column) -> Column:
    return (a != "") & (b != "") & (a.contains(b) | b.contains(a))


def related(a: str | Column, b: str | Column) -> Column:
    """Do two domains, or their bases, contain each other? Never for an empty one."""
    x, y = _text(a), _text(b)
    return (x != "") & (y != "") & (_within(x, y) | _within(domain_base(x), domain_base(y)))


def in_domains(domain: str | Column, domains: list[str]) -> Column:
    """Is a domain one of those given or below one of them?

    The suffixes of the domain are compared with a constant set, so the cost
    doesn't grow with the length of the list.
    """
    if not domains:
        return F.lit(False)
    labels = F.split(_text(domain), r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    return F.arrays_overlap(suffixes, F.array(*(F.lit(d) for d in domains)))


def contains_any(c: str | Column, parts: list[str]) -> Column:
    """Does a text contain one of the parts, anywhere?"""
    if not parts:
        return F.lit(False)
    return _text(c).rlike("|".join(re.escape(p) for p in parts))


def blocked_domain(domain: str | Column, lists: Lists = DEFAULT) -> Column:
    d = _text(domain)
    academic = d.rlike("(" + "|".join(re.escape(s) for s in C.ACADEMIC_SUFFIXES) + ")$")
    return academic | contains_any(d, lists.news_words) | in_domains(d, lists.blocked_domains)


def clean_email(c: str | Column) -> Column:
    return F.regexp_replace(strip(c), r"[.,;:'\"]+$", "")


def extract_emails(c: str | Column, lists: Lists = DEFAULT) -> Column:
    """The acceptable addresses of a text as an array, in order of appearance, without repeats.

    NULL gives an empty array. Case is kept; the checks ignore it.
    """
    found = F.array_distinct(F.transform(F.regexp_extract_all(_text(c), F.lit(C.EMAIL_PATTERN), F.lit(0)), clean_email))

    def good(e: Column) -> Column:
        low = F.lower(e)
        domain = domain_part(low)
        return (
            domain.contains(".")
            & ~blocked_domain(domain, lists)
            & ~local_part(low).isin(lists.blocked_locals or [""])
            & ~domain.rlike(r"\.(png|jpg|gif|pdf|webp)$")
            & ~low.contains("@2x")
            & ~low.contains("@3x")
            & ~local_part(low).rlike(_OUTER_MARKS)
        )

    return F.filter(found, good)


def valid_email(c: str | Column, lists: Lists = DEFAULT) -> Column:
    """Is an address worth keeping? False for NULL."""
    e = F.regexp_replace(strip(F.lower(_text(c))), r"[.,;:]+$", "")
    local, domain = local_part(e), domain_part(e)
    return (
        domain.contains(".")
        & ~blocked_domain(domain, lists)
        & ~local.isin(lists.blocked_locals or ["@"])
        & ~domain.rlike(r"\.(png|jpg|gif|pdf|zip|webp)$")
        & (F.length(e) <= 80)
        & (F.length(local) >= 1)
        & ~local.rlike(_OUTER_MARKS)
    )


def cross_domain_noise(email: str | Column, url: str | Column, lists: Lists = DEFAULT) -> Column:
    """Does a company's address stand on a page that has nothing to do with it?

    Free mail, blogs and missing hosts are never noise.
    """
    domain, host = domain_part(F.lower(_text(email))), url_host(url)
    return (domain != "") & ~domain.isin(lists.free_mail or [""]) & (host != "") & ~in_domains(host, lists.blog_hosts) & ~related(domain, host)


def source_domain(text: str | Column) -> Column:
    """The host a snippet speaks of: its first web link, else what follows its URL label; '' if none."""
    t = _text(text)
    link = F.regexp_extract(t, r"(?:^|\s)(https?://\S+)", 1)
    label = F.regexp_extract(t, r"(?s)(?:Source URL:|Homepage:)\s*(\S+)", 1)
    return url_host(F.when(link != "", link).otherwise(label), lower=False)


def rule_verdict(email: str | Column, snippet: str | Column, lists: Lists = DEFAULT) -> Column:
    """TRUE, FALSE, or NULL where the rules can't tell."""
    domain, source = domain_part(F.lower(_text(email))), source_domain(snippet)
    return (
        F.when((source != "") & in_domains(source, lists.noise_sources), F.lit(False))
        .when(domain.isin(lists.free_mail or [""]), F.lit(None).cast("boolean"))
        .when(related(domain, source), F.lit(True))
    )


def accepted_email(email: str | Column, snippet: str | Column, classifier: Column | None = None, lists: Lists = DEFAULT) -> Column:
    """The rules' verdict, else the classifier's, else true."""
    parts = [rule_verdict(email, snippet, lists), *([] if classifier is None else [classifier]), F.lit(True)]
    return F.coalesce(*parts)


def score_email(email: str | Column, url: str | Column, method: str | Column, flagged: str | Column | None = None, lists: Lists = DEFAULT) -> Column:
    """How good an address is, as an INT; the parts are summed.

    Flagged is a column, the prefix in the method, or both. NULLs count as ''.
    """
    e, m = F.lower(_text(email)), _text(method)
    local, domain = local_part(e), domain_part(e)
    is_flagged = m.contains(C.FLAG_MARK)
    if flagged is not None:
        is_flagged = is_flagged | F.coalesce(col(flagged), F.lit(False))
    points = lambda when, n: F.when(when, F.lit(n)).otherwise(F.lit(0))
    total = (
        points(is_flagged, C.SCORE_FLAGGED)
        + points(related(domain, url_host(url)), C.SCORE_DOMAIN_MATCH)
        + points(F.replace(m, F.lit(C.FLAG_PREFIX), F.lit("")).isin("homepage", "homepage_direct"), C.SCORE_HOMEPAGE)
        + points(domain.isin(lists.free_mail or [""]), C.SCORE_FREE_MAIL)
        + F.when(local.isin(lists.business_locals or [""]), F.lit(C.SCORE_BUSINESS_LOCAL))
        .when(local.rlike(r"^[\p{L}\p{N}]{2,20}$"), F.lit(C.SCORE_PERSONAL_LOCAL))
        .otherwise(F.lit(0))
    )
    return F.when(domain == "", F.lit(C.SCORE_MALFORMED)).otherwise(total)
