"""Fetching what registries, listings, search engines and homepages publish. Transports are injected; none is built in.

A transport is named 'module:function', so that tasks on any executor import it:
``get(url, params) -> bytes`` for pages, ``stream(url) -> iterable of bytes`` for files.
Failures become rows with ``error_message``, never exceptions, so one page doesn't stop a run.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .html import table_rows
from .readers import land
from .rest import _transport, read_rest

#: Bytes of a chunk of a downloaded file, pages of a listing, and tries per page.
CHUNK, MOST_PAGES, TRIES = 8192, 50, 2
#: The mark a failed download leaves in place of its file.
FAILED_MARK = "_DOWNLOAD_FAILED.txt"


@dataclass(frozen=True)
class Service:
    """A paged registry service: page size, names of its parameters, fixed ones, and the most pages it is asked for (0: all)."""

    source_id: str
    page_size: int
    page_param: str = "page"
    size_param: str = "perPage"
    params: dict[str, str] = field(default_factory=dict)
    pages: int = 0


# --- fixed values: parameters of the two plain services ---
SERVICES = {
    "15086381": Service("15086381", 500, params={"returnType": "JSON"}),
    "15065485": Service("15065485", 1000, "pageNo", "numOfRows", {"sDate": "20030101", "eDate": "20101231", "ncrAreaName": "서울", "_type": "json"}, pages=1),
}


def read_service(spark: SparkSession, service: Service, url: str, transport: str, key: str) -> DataFrame:
    """(page, record) of a service; no key gives no rows, a page that fails a row with NULL record."""
    rows = read_rest(spark, url, transport, page_size=str(service.page_size), page_param=service.page_param, size_param=service.size_param, params=json.dumps(service.params), key=key)
    return rows.where(F.col("page") <= service.pages) if service.pages else rows


def land_text(spark: SparkSession, path: str, chunks: Iterator[bytes]) -> int:
    """Write bytes to a file of Spark's file systems, chunk by chunk; their number."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    n = 0
    try:
        for chunk in chunks:
            out.write(bytearray(chunk))
            n += len(chunk)
    finally:
        out.close()
    return n


def land_json(df: DataFrame, path: str) -> None:
    """Rows as one JSON array, the form the JSON registries are read in; row by row through the driver, never all at once."""

    def lines() -> Iterator[bytes]:
        yield b"["
        for n, row in enumerate(df.select(F.to_json(F.struct("*")).alias("j")).toLocalIterator()):
            yield (("," if n else "") + row["j"]).encode()
        yield b"]"

    land_text(df.sparkSession, path, lines())


def download(spark: SparkSession, url: str, raw_dir: str, source_id: str, day: str, name: str, transport: str, force: bool = False, required: bool = False) -> str:
    """Fetch a registry's file into its snapshot of a day: 'kept', 'written' or the error.

    On failure a mark stands in the folder instead, and the error is raised if the source is ``required``.
    """
    folder = f"{raw_dir.rstrip('/')}/{source_id}/{day}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path, part = hadoop.Path(f"{folder}/{name}"), hadoop.Path(f"{folder}/_{name}.part")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not force and fs.exists(path):
        return "kept"
    try:
        land_text(spark, part.toString(), _transport(transport)(url))
        fs.delete(path, False)
        fs.rename(part, path)
        return "written"
    except Exception as e:
        fs.delete(part, False)
        land_text(spark, f"{folder}/{FAILED_MARK}", iter([f"{url}\n{e}".encode()]))
        if required:
            raise
        return f"{type(e).__name__}: {e}"


def decoded(raw: bytes) -> str:
    """A page's text: the charset its head declares, else UTF-8, else the Korean code page; undecodable bytes are replaced."""
    named = re.search(rb"charset\s*=\s*[\"']?\s*([A-Za-z0-9_\-]+)", raw[:4096])
    for charset in [named.group(1).decode().lower()] if named else []:
        try:
            return raw.decode({"euc-kr": "cp949", "ks_c_5601-1987": "cp949"}.get(charset, charset))
        except (LookupError, UnicodeDecodeError):
            pass
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("cp949", "replace")


def _fetched(transport: str, requests: Iterator[tuple[str, dict]]) -> Iterator[tuple[str | None, str | None]]:
    get = _transport(transport)
    for url, params in requests:
        text = error = None
        for _ in range(TRIES):
            try:
                text, error = decoded(get(url, params)), None
                break
            except Exception as e:  # noqa: BLE001
                error = f"{type(e).__name__}: {e}"
        yield text, error


def fetch_pages(urls: DataFrame, transport: str) -> DataFrame:
    """(url, html, error_message) of the different URLs, fetched host by host, so that no two tasks ask one host at a time."""
    wanted = urls.select("url").where("url is not null").distinct().repartition(F.regexp_extract("url", r"//([^/?#]*)", 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = list(_fetched(transport, ((u, {}) for u in pdf["url"])))
            yield pd.DataFrame({"url": pdf["url"], "html": [t for t, _ in got], "error_message": [e for _, e in got]})

    return wanted.mapInPandas(run, "url string, html string, error_message string")


def crawl_listing(spark: SparkSession, url: str, transport: str, columns: list[str], most_pages: int = MOST_PAGES, **table) -> DataFrame:
    """The rows of a listing's pages up to the first that has none or fails: page, row_no and ``columns``; see ``table_rows``."""
    pages = spark.range(1, most_pages + 1).select(F.col("id").cast("int").alias("page")).coalesce(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = list(_fetched(transport, ((url, {"page": int(p)}) for p in pdf["page"])))
            yield pd.DataFrame({"page": pdf["page"], "html": [t for t, _ in got]})

    rows = table_rows(pages.mapInPandas(run, "page int, html string").where("html is not null"), columns, **table)
    there = rows.select("page").distinct()
    gap = spark.range(1, most_pages + 2).select(F.col("id").cast("int").alias("page")).join(there, "page", "left_anti").agg(F.min("page").alias("_end"))
    return rows.crossJoin(F.broadcast(gap)).where("page < _end").drop("_end")


def land_listing(spark: SparkSession, url: str, transport: str, raw_dir: str, source_id: str, day: str, columns: list[str]) -> str:
    """Crawl a listing and land its rows as the source's snapshot."""
    return land(crawl_listing(spark, url, transport, columns).orderBy("page", "row_no").select(*columns), raw_dir, source_id, day)


def search(queries: DataFrame, transport: str, engines: list[tuple[str, int]] | None = None) -> DataFrame:
    """search_results of the different queries on every engine, in the form ``discover`` reads.

    The transport gets (engine, {'query', 'display'}) and returns a JSON list of
    objects with url, title, snippet, address. A failure is one row with ``error_message``.
    """
    asked = queries.select("query").distinct()
    every = engines or [*C.ENGINES, C.SITE_ENGINE]
    columns = ["query", "engine", "rank", "url", "title", "snippet", "address", "error_message"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for query in pdf["query"]:
                for engine, depth in every:
                    ((text, error),) = _fetched(transport, [(engine, {"query": query, "display": depth})])
                    if error:
                        out.append((query, engine, 0, None, None, None, None, error))
                        continue
                    out += [(query, engine, k, *(x.get(c) for c in columns[3:7]), None) for k, x in enumerate(json.loads(text)[:depth], 1)]
            yield pd.DataFrame(out, columns=columns)

    return asked.mapInPandas(run, "query string, engine string, rank int, url string, title string, snippet string, address string, error_message string")
