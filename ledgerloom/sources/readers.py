"""Reading registries' files: CSV of either encoding, spreadsheets, JSON, envelopes, Parquet; and writing them."""

from __future__ import annotations

import csv
import io
import logging
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import islice
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .spec import SPECS, SourceSpec, empty_unified, normalize_source
from .xlsx import read_xlsx

log = logging.getLogger(__name__)


def _listed(spark: SparkSession, path: str) -> list[str]:
    """Files below a path, in lexical order."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.getFileStatus(p).isDirectory() else [path]


def latest_snapshot(spark: SparkSession, raw_dir: str, source_id: str) -> str | None:
    """The newest dated folder of a source: the last in lexical order."""
    days = [p for p in _listed(spark, f"{raw_dir.rstrip('/')}/{source_id}") if p.rstrip("/").rsplit("/", 1)[-1][:1].isdigit()]
    return days[-1] if days else None


def snapshot_file(spark: SparkSession, folder: str, prefer_json: bool = False) -> str | None:
    """The file to read of a snapshot: the last CSV or spreadsheet by name, JSON first if preferred; all parts of a landed table."""
    files = _listed(spark, folder)
    if any(f.rsplit("/", 1)[-1].startswith("part-") for f in files):
        return f"{folder.rstrip('/')}/part-*.csv"
    tables = [f for f in files if f.lower().endswith((".csv", ".xlsx", ".xls"))]
    json_files = [f for f in files if f.lower().endswith(".json")]
    pick = (json_files or tables) if prefer_json else (tables or json_files)
    return pick[-1] if pick else None


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Per file of a path or pattern: its path, whether it is valid UTF-8, and its first line. Large files are read in blocks."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    return lines.groupBy("path").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.min_by("value", F.when(F.col("at") == 0, F.col("n"))).alias("head")).orderBy("path")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header (or several, by a pattern), all strings, missing values ''; each file UTF-8, or else the Korean code page.

    Encoding and header are told file by file, in Spark; only paths and headers
    are collected. Files with one header are read together, blocks of UTF-8 in
    parallel, Korean files one per task in Arrow batches; undecodable bytes
    become replacement characters. A column that a file lacks is ''. Files
    without a header give no columns.
    """
    kinds: dict[str | None, list[str]] = {}
    for f in _files(spark, path).collect():
        if f["head"] is not None:
            kinds.setdefault(f["head"].lstrip("\ufeff") if f["utf8"] else None, []).append(unquote(f["path"]))
    parts = [_utf8(spark, paths) for head, paths in kinds.items() if head is not None]
    parts += [_korean(spark, kinds[None])] if None in kinds else []
    if not parts:
        return spark.read.options(header=True, inferSchema=False, multiLine=True, escape='"').csv(path)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).na.fill("")


def _utf8(spark: SparkSession, paths: list[str]) -> DataFrame:
    df = spark.read.options(header=True, inferSchema=False, multiLine=True, escape='"').csv(paths)
    return df.toDF(*(c.lstrip("\ufeff") for c in df.columns))


def _korean(spark: SparkSession, paths: list[str]) -> DataFrame:
    files = spark.read.format("binaryFile").load(paths)
    heads = files.select("path", "content").mapInPandas(_decoded_headers, "path string, names array<string>").orderBy("path").collect()
    names = list(dict.fromkeys(n for h in heads for n in h["names"]))
    cells = files.select("content").mapInPandas(_decoded_rows, "cells map<string,string>")
    return cells.select(*(F.coalesce(F.try_element_at("cells", F.lit(n)), F.lit("")).alias(n) for n in names))


def _decoded(content) -> Iterator[list[str]]:
    return (r for r in csv.reader(io.StringIO(bytes(content).decode("cp949", "replace"), newline="")) if r)


def _names(cells: list[str]) -> list[str]:
    return [c or f"_c{i}" for i, c in enumerate(cells)]


def _decoded_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"path": pdf["path"], "names": [_names(next(_decoded(c), [])) for c in pdf["content"]]})


def _decoded_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for content in pdf["content"]:
            rows = _decoded(content)
            names = _names(next(rows, []))
            while chunk := [dict(zip(names, r, strict=False)) for r in islice(rows, 10_000)]:
                yield pd.DataFrame({"cells": chunk})


def land(df: DataFrame, raw_dir: str, source_id: str, day: str) -> str:
    """Write fetched rows as a source's snapshot of a day, in as many CSV files as the table has partitions; its folder.

    The files are UTF-8 without a byte order mark, which only single-file readers need.
    """
    folder = f"{raw_dir.rstrip('/')}/{source_id}/{day}"
    df.write.mode("overwrite").options(header=True, escape='"').csv(folder)
    return folder


def read_json_records(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of records, all strings, missing values ''."""
    df = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    flat = [F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType)) else F.col(f"`{c}`") for c in df.columns]
    return df.select(*flat).na.fill("")


def read_envelope(spark: SparkSession, path: str, fields: Iterable[str]) -> DataFrame:
    """Records in response.body.items.item, an object or an array of objects; all strings, nulls as text."""
    item = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    raw = spark.read.text(path, wholetext=True)
    inner = F.get_json_object("value", "$.response.body.items.item")
    many = F.coalesce(F.from_json(inner, T.ArrayType(item)), F.array(F.from_json(inner, item)))
    rows = raw.where(inner.isNotNull()).select(F.inline(many))
    return rows.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("None")).alias(c) for c in rows.columns))


def read_parquets(spark: SparkSession, path: str) -> DataFrame:
    """Normalized files as one table, in one scan; ``row_ordinal`` sorts as their names do, then as their rows."""
    if not any(f.endswith(".parquet") for f in _listed(spark, path)):
        raise FileNotFoundError(f"no Parquet file in {path}")
    df = spark.read.options(mergeSchema=True, recursiveFileLookup=True, pathGlobFilter="*.parquet").parquet(path)
    return df.withColumn("row_ordinal", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))


def read_source(spark: SparkSession, spec: SourceSpec, raw_dir: str, collected_on: str) -> DataFrame:
    """The newest snapshot of a registry in the unified schema; FileNotFoundError if there is none."""
    folder = latest_snapshot(spark, raw_dir, spec.source_id)
    path = snapshot_file(spark, folder, spec.kind != "table") if folder else None
    if path is None:
        raise FileNotFoundError(f"no snapshot of {spec.source_id} in {raw_dir}")
    low = path.lower()
    if low.endswith(".json"):
        names = [a[0] for r in spec.rules if r.exact for a in r.alternatives]
        df = read_envelope(spark, path, names) if spec.kind == "envelope" else read_json_records(spark, path)
    elif low.endswith((".xlsx", ".xls")):
        df = read_xlsx(spark, path)
    else:
        df = read_csv(spark, path)
    return normalize_source(df, spec, collected_on) if df.columns else empty_unified(spark)


def normalize_all(spark: SparkSession, raw_dir: str, out_dir: str, collected_on: str, source_ids: Iterable[str] | None = None, force: bool = False) -> dict[str, str]:
    """Write every registry's unified table; an existing one is kept unless forced. One that fails doesn't stop the others.

    Returns the outcome by source: 'written', 'kept', 'unknown' or the error.
    """
    out = {}
    for source_id in source_ids or SPECS:
        if source_id not in SPECS:
            out[source_id] = "unknown"
            continue
        target = f"{out_dir.rstrip('/')}/{source_id}.parquet"
        if not force and _listed(spark, target):
            out[source_id] = "kept"
            continue
        try:
            read_source(spark, SPECS[source_id], raw_dir, collected_on).write.mode("overwrite").parquet(target)
            out[source_id] = "written"
        except Exception as e:  # noqa: BLE001
            log.warning("source %s failed: %s", source_id, e)
            out[source_id] = f"{type(e).__name__}: {e}".splitlines()[0]
    return out


def write_partitioned(unified: DataFrame, path: str) -> None:
    """One folder per registry; only the registries in the table are replaced."""
    unified.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_dataset_id").parquet(path)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a written folder in the place of another; the old one is kept until the new one is complete."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    new, old = hadoop.Path(source), hadoop.Path(target)
    fs = new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = hadoop.Path(target.rstrip("/") + ".old")
    if fs.exists(old) and not fs.rename(old, aside) or not fs.rename(new, old):
        raise OSError(f"{target} could not be replaced")
    fs.delete(aside, True)


def korean_labels(df: DataFrame) -> DataFrame:
    return df.toDF(*(C.KOREAN_LABEL.get(c, c) for c in df.columns))
