"""Paged REST registries as a Spark data source. The transport is injected; none is built in."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: transport(url, params) -> response text; raises on failure.
Transport = Callable[[str, dict], str]


def items_of(text: str) -> tuple[list[dict], int | None]:
    """The records of a response and its total count, whichever envelope it came in.

    Known envelopes: data/totalCount; response.body.items[.item]/totalCount; a
    service name with head and row blocks; XML with item elements.
    """
    stripped = text.lstrip("﻿ \r\n\t")
    if stripped.startswith("<"):
        root = ET.fromstring(stripped)
        total = root.findtext(".//totalCount")
        items = [{c.tag: (c.text or "").strip() for c in item} for item in root.iter("item")]
        return items, int(total) if total and total.strip().isdigit() else None
    body = json.loads(stripped)
    if isinstance(body, list):
        return body, None
    if "data" in body:
        return body["data"] or [], _number(body.get("totalCount"))
    if "response" in body:
        inner = (body["response"] or {}).get("body") or {}
        items = inner.get("items") or []
        items = items.get("item", []) if isinstance(items, dict) else items
        return items if isinstance(items, list) else [items], _number(inner.get("totalCount"))
    for block in body.values():
        if isinstance(block, list):
            rows = next((b["row"] for b in block if isinstance(b, dict) and "row" in b), None)
            heads = next((b["head"] for b in block if isinstance(b, dict) and "head" in b), [])
            total = next((h["list_total_count"] for h in heads if isinstance(h, dict) and "list_total_count" in h), None)
            if rows is not None:
                return rows, _number(total)
    return [], 0


def _number(x) -> int | None:
    try:
        return int(x)
    except (TypeError, ValueError):
        return None


def _transport(name: str) -> Transport:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class _Page(InputPartition):
    """Page ``number``; ``onward``: and those after it up to an empty one. ``counted``: by the total it is the last."""

    def __init__(self, number: int, onward: bool = False, counted: bool = False):
        self.number, self.onward, self.counted = number, onward, counted


class PagedRest(DataSource):
    """Format 'paged_rest': one row of JSON text per record, one partition per page if the total is known.

    Options: url, transport ('module:function'), page_size, page_param,
    size_param, params (JSON), retries, key. With no key the source is empty. The
    first page tells the total, and by its rows how many a page really holds; the
    last page's partition reads on until an empty page, as later pages may hold fewer.
    With no total (or 0), or if the first page fails, one partition reads page after
    page until an empty one, or one that repeats the page before. A page that fails
    after the retries is reported as a row with NULL record without failing the
    others. Where no total is known, a second failure in a row ends the reading: if
    the last row is NULL, the pages from it on are missing.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> str:
        return "page int, record string"

    def reader(self, schema) -> DataSourceReader:
        return _Pages(dict(self.options))


class _Pages(DataSourceReader):
    def __init__(self, options: dict):
        self.o = options
        self.size = int(options.get("page_size", 1000))

    def _get(self, page: int) -> tuple[list[dict], int | None]:
        params = {**json.loads(self.o.get("params", "{}")), self.o.get("page_param", "page"): page, self.o.get("size_param", "perPage"): self.size}
        if self.o.get("key"):
            params["serviceKey"] = self.o["key"]
        for left in range(int(self.o.get("retries", 3)) - 1, -1, -1):
            try:
                return items_of(_transport(self.o["transport"])(self.o["url"], params))
            except Exception:
                if not left:
                    raise
        return [], 0

    def partitions(self):
        if "key" in self.o and not self.o["key"]:
            return [_Page(0)]
        try:
            first, total = self._get(1)
        except Exception:  # noqa: BLE001
            return [_Page(1, onward=True)]
        if not total:
            return [_Page(1, onward=True)]
        pages = max(1, -(-total // (len(first) or self.size)))
        return [*(_Page(n) for n in range(1, pages)), _Page(pages, onward=True, counted=True)]

    def read(self, partition):
        number, before, failed = partition.number, None, False
        while number:
            beyond = number > partition.number
            try:
                items, _ = self._get(number)
            except Exception:  # noqa: BLE001
                if beyond and (failed or partition.counted):
                    return
                yield (number, None)
                failed = True
            else:
                if beyond and items == before:
                    return
                for item in items:
                    yield (number, json.dumps(item, ensure_ascii=False))
                if not items:
                    return
                before, failed = items, False
            if not partition.onward:
                return
            number += 1


def read_rest(spark: SparkSession, url: str, transport: str, **options: str) -> DataFrame:
    """(page, record) of a paged service; record is JSON text, NULL for a page that couldn't be read."""
    spark.dataSource.register(PagedRest)
    return spark.read.format("paged_rest").options(url=url, transport=transport, **options).load()
