"""Finding e-mail addresses for companies: queries, search results, pages; the order of discovery is the contract.

All phases are joins on tables of search results and pages, which any source may
fill. Order keys make 'first seen' and the caps deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import contact
from ..functions.contact import Lists
from ..functions.text import filled, strip
from ..sources.html import contact_links

#: Results per query and engine that the quick flow looks at.
QUICK_DEPTH = 5
HIT = ["company_key", "email", "source_url", "method", "flagged"]


def usable_homepage(c: str = "homepage") -> Column:
    """The homepage if it can be visited, else NULL."""
    h = strip(F.coalesce(c, F.lit("")))
    return F.when(~h.isin(C.UNUSABLE_HOMEPAGES) & h.startswith("http"), h)


def search_address(road: str = "road_address", lot: str = "lot_address") -> Column:
    """The address to search a company by: its road address, else its lot address, else ''."""
    return F.coalesce(F.when(filled(road), F.col(road)), F.when(filled(lot), F.col(lot)), F.lit(""))


def search_queries(companies: DataFrame, with_site: bool = True) -> DataFrame:
    """company_key, query_no, query: three queries per company, and two within its homepage's site."""
    name = F.coalesce("company_name", F.lit(""))
    h = strip(F.coalesce("homepage", F.lit("")))
    site = F.regexp_replace(F.regexp_extract(h, r"^(?:[A-Za-z][\w+.\-]*:)?//([^/?#]*)", 1), r"^www\.", "")
    general = [F.concat(name, F.lit(" 이메일")), F.concat(name, F.lit(" 공식 홈페이지")), F.concat(F.lit('"'), name, F.lit('" "@"'))]
    within = [F.when(site != "", F.concat(F.lit("site:"), site, F.lit(tail))) for tail in (" 이메일", " contact")]
    rows = companies.select("company_key", F.posexplode(F.array(*general, *(within if with_site else []))).alias("query_no", "query"))
    return rows.where("query is not null")


def candidate_urls(companies: DataFrame, search_results: DataFrame, lists: Lists = contact.DEFAULT) -> DataFrame:
    """company_key, url, snippet, engine, place: the acceptable results of all queries, each URL of a company where it was first seen."""
    engines = [*C.ENGINES, C.SITE_ENGINE]
    number = F.create_map(*(F.lit(x) for k, (n, _) in enumerate(engines) for x in (n, k)))
    depth = F.create_map(*(F.lit(x) for n, d in engines for x in (n, d)))
    results = search_results.withColumn("engine_no", F.try_element_at(number, F.col("engine"))).where(F.col("rank") <= F.try_element_at(depth, F.col("engine")))
    queries = search_queries(companies)
    site_query = F.col("query_no") >= 3
    joined = queries.join(results, "query").where(site_query == (F.col("engine") == C.SITE_ENGINE[0]))
    snippet = F.concat_ws(" ", "title", "snippet", F.nullif(F.coalesce("address", F.lit("")), F.lit("")))
    order = F.struct("query_no", "engine_no", "rank")
    good = joined.where((F.coalesce("url", F.lit("")) != "") & ~contact.contains_any("url", lists.blocked_urls))
    visited = companies.select("company_key", usable_homepage().alias("_home"))
    first = good.join(visited, "company_key").where(F.col("_home").isNull() | (F.col("_home") != F.col("url")))
    first = first.groupBy("company_key", "url").agg(F.min(order).alias("order"), F.min_by(snippet, order).alias("snippet"), F.min_by("engine", order).alias("engine"))
    return first.withColumn("place", F.row_number().over(W.partitionBy("company_key").orderBy("order"))).drop("order")


def page_emails(visits: DataFrame, pages: DataFrame, lists: Lists = contact.DEFAULT) -> DataFrame:
    """The addresses of visited pages and of their contact pages, without third parties': visit columns, page_no, pos, email, source_url."""
    wanted = pages.join(visits.select("url").distinct(), "url", "left_semi")
    links = contact_links(wanted, tuple(lists.contact_words), tuple(lists.contact_stopwords))
    every = visits.withColumn("page_no", F.lit(0)).withColumn("page_url", F.col("url"))
    further = visits.join(links, "url").withColumn("page_no", F.col("position")).withColumn("page_url", F.col("link")).drop("position", "link")
    seen = every.unionByName(further).join(pages.select(F.col("url").alias("page_url"), "html"), "page_url")
    found = seen.select("*", F.posexplode(contact.extract_emails("html", lists)).alias("pos", "email")).drop("html")
    return found.where(~contact.cross_domain_noise("email", "page_url", lists)).withColumn("source_url", F.col("page_url")).drop("page_url")


def discover(companies: DataFrame, search_results: DataFrame, pages: DataFrame, lists: Lists = contact.DEFAULT, most_emails: int = C.MAX_EMAILS, visits: int = C.MAX_VISITS, classifier=None) -> DataFrame:
    """company_key, email, source_url, method, flagged, place: the addresses found for each company in order of discovery.

    Phases: the homepage and its contact pages; the snippets of all results; the
    first results' pages. Each address counts where it is first seen; page visits
    stop once ``most_emails`` different addresses are known, but a company whose
    snippets already reach that still has its first page visited, and the first
    hit there examined. ``classifier(company, email, snippet) -> Column`` decides where
    the rules can't; without it such addresses are accepted. Only valid
    addresses come out, but invalid ones use up the cap.
    """
    names = companies.select("company_key", F.coalesce("company_name", F.lit("")).alias("company_name"))
    homes = companies.select("company_key", usable_homepage().alias("url")).where("url is not null")
    zero = page_emails(homes, pages, lists).select("company_key", "email", "source_url", F.lit("homepage_direct").alias("method"), F.concat(F.lit("Homepage: "), "url").alias("context"), F.struct(F.lit(0).alias("phase"), F.lit(0).alias("a"), F.col("page_no").alias("b"), F.col("pos").alias("c")).alias("order"))
    found = candidate_urls(companies, search_results, lists)
    snippets = found.select("company_key", "url", "snippet", "engine", "place", F.posexplode(contact.extract_emails("snippet", lists)).alias("pos", "email"))
    two = snippets.select("company_key", "email", F.col("url").alias("source_url"), F.concat("engine", F.lit("_snippet")).alias("method"), F.col("snippet").alias("context"), F.struct(F.lit(2).alias("phase"), F.col("place").alias("a"), F.lit(0).alias("b"), F.col("pos").alias("c")).alias("order"))
    binary = F.lower("url").rlike("(" + "|".join(s.replace(".", r"\.") for s in C.BINARY_SUFFIXES) + ")$")
    visited = found.where(F.col("place") <= visits).where(~binary).select("company_key", "url", "place")
    firsts = visited.groupBy("company_key").agg(F.min("place").alias("_first_visit"))
    three = page_emails(visited, pages, lists).select("company_key", "email", "source_url", F.lit("homepage").alias("method"), F.concat(F.lit("Source URL: "), "source_url").alias("context"), F.struct(F.lit(3).alias("phase"), F.col("place").alias("a"), F.col("page_no").alias("b"), F.col("pos").alias("c")).alias("order"))
    hits = zero.unionByName(two).unionByName(three).join(firsts, "company_key", "left")
    per = W.partitionBy("company_key").orderBy("order")
    hits = hits.withColumn("is_new", F.row_number().over(W.partitionBy("company_key", "email").orderBy("order")) == 1)
    before = F.sum(F.col("is_new").cast("int")).over(per.rowsBetween(W.unboundedPreceding, -1))
    visit_no = F.sum((F.col("order.phase") == 3).cast("int")).over(per.rowsBetween(W.unboundedPreceding, W.currentRow))
    hits = hits.withColumn("_before", F.coalesce(before, F.lit(0))).withColumn("_visit", visit_no)
    on_first = (F.col("_visit") == 1) & (F.col("order.a") == F.col("_first_visit"))
    kept = hits.where("is_new").where((F.col("order.phase") < 3) | (F.col("_before") < most_emails) | on_first)
    kept = kept.join(names, "company_key")
    verdict = None if classifier is None else classifier(F.col("company_name"), F.col("email"), F.col("context"))
    accepted = contact.accepted_email("email", "context", verdict, lists)
    out = kept.where(contact.valid_email("email", lists)).withColumn("flagged", ~accepted)
    return out.select(*HIT, F.row_number().over(per).alias("place"))


def failures(companies: DataFrame, search_results: DataFrame, pages: DataFrame) -> DataFrame:
    """company_key, error_message of companies a search or homepage visit of which failed.

    Sources report a failure as a row with ``error_message`` set; tables without that column have none.
    """
    none = companies.select("company_key", F.lit("").alias("error_message")).limit(0)
    out = [none]
    if "error_message" in search_results.columns:
        failed = search_results.where("error_message is not null").select("query", "error_message")
        out.append(search_queries(companies).join(failed, "query").select("company_key", "error_message"))
    if "error_message" in pages.columns:
        failed = pages.where("error_message is not null").select("url", "error_message")
        out.append(companies.select("company_key", usable_homepage().alias("url")).join(failed, "url").select("company_key", "error_message"))
    return reduce(DataFrame.unionByName, out).groupBy("company_key").agg(F.min("error_message").alias("error_message"))


def rendered_method(method: str = "method", flagged: str = "flagged") -> Column:
    """The method as reports show it: flagged addresses carry a prefix."""
    return F.when(F.coalesce(F.col(flagged), F.lit(False)), F.concat(F.lit(C.FLAG_PREFIX), F.col(method))).otherwise(F.col(method))


def first_hit(companies: DataFrame, search_results: DataFrame, pages: DataFrame, lists: Lists = contact.DEFAULT) -> DataFrame:
    """One address per company, the first found: homepage, then per query the engines' snippets.

    The quick flow: two queries, snippet results without a URL count too, no classifier.
    """
    homes = companies.select("company_key", usable_homepage().alias("url")).where("url is not null")
    zero = page_emails(homes, pages, lists).where(contact.valid_email("email", lists)).select("company_key", "email", "source_url", F.lit("homepage_direct").alias("method"), F.struct(F.lit(-1).alias("a"), F.lit(0).alias("b"), F.col("page_no").alias("c"), F.col("pos").alias("d")).alias("order"))
    engines = [n for n, _ in C.ENGINES if n != "naver_local"]
    number = F.create_map(*(F.lit(x) for k, n in enumerate(engines) for x in (n, k)))
    results = search_results.withColumn("engine_no", F.try_element_at(number, F.col("engine"))).where(f"engine_no is not null and rank <= {QUICK_DEPTH}")
    queries = search_queries(companies, with_site=False).where("query_no < 2")
    good = queries.join(results, "query").where(~contact.contains_any("url", lists.blocked_urls))
    snippet = F.concat_ws(" ", "title", "snippet")
    found = good.select("company_key", F.coalesce("url", F.lit("")).alias("source_url"), F.concat("engine", F.lit("_snippet")).alias("method"), "query_no", "engine_no", "rank", F.posexplode(contact.extract_emails(snippet, lists)).alias("pos", "email"))
    rest = found.where(contact.valid_email("email", lists)).select("company_key", "email", "source_url", "method", F.struct(F.col("query_no").alias("a"), F.col("engine_no").alias("b"), F.col("rank").alias("c"), F.col("pos").alias("d")).alias("order"))
    every = zero.unionByName(rest)
    best = every.groupBy("company_key").agg(F.min_by(F.struct("email", "source_url", "method"), "order").alias("h"))
    return best.select("company_key", "h.*")
