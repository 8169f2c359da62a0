"""Top N items within every group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import contact
from ..functions.text import strip

#: Fixed values of the synthetic tables: their free-mail hosts.
FREE_MAIL = ["freemail.example", "postbox.test"]


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group in the given order, with their rank from 1.

    ``order`` must be total within a group (end it with an identifier), else ties
    fall arbitrarily. NULLs in group columns form a group of their own. A filter
    on row_number makes Spark keep n rows per group in every task before the
    shuffle (WindowGroupLimit), so a group of any size reaches its task as n rows
    per map task. An empty table gives an empty result; ``rank`` replaces a
    column of that name.
    """
    numbered = df.withColumn(rank, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return numbered.where(F.col(rank) <= n)


def latest_per(df: DataFrame, keys: list[str], newest: str, keep: list[str]) -> DataFrame:
    """Of each key the row with the highest ``newest``: partial aggregation, no sort, no hot task."""
    packed = F.max_by(F.struct(*keep), F.col(newest)).alias("_row")
    return df.groupBy(*keys).agg(F.max(newest).alias(newest), packed).select(*keys, newest, "_row.*")


def best_addresses(emails: DataFrame, n: int = 3, lists: contact.Lists | None = None) -> DataFrame:
    """The best-scoring collected addresses of every company.

    Input: seq, company_key, email, source_url, method, flagged, status; other
    columns are ignored. Output: company_key, seq, address, score, rank.
    Addresses are compared without outer white space and case; '' and NULL are
    none. Of each (company, address) the row with the highest seq counts, and
    only if it is 'collected'; scores of -100 and less are left out; ties go to
    the lower seq. Rows with the same seq and address count as one of them.
    """
    lists = lists or contact.Lists(free_mail=FREE_MAIL)
    address = F.lower(strip(F.coalesce("email", F.lit(""))))
    rows = emails.select("company_key", "seq", address.alias("address"), "source_url", "method", "flagged", "status")
    last = latest_per(rows.where("address != ''"), ["company_key", "address"], "seq", ["source_url", "method", "flagged", "status"])
    score = contact.score_email("address", "source_url", "method", "flagged", lists)
    scored = last.where("status = 'collected'").select("company_key", "seq", "address", score.alias("score")).where("score > -100")
    return top_n(scored, ["company_key"], [F.desc("score"), F.asc("seq")], n)


def p3_found(spark, sf_dir: str) -> DataFrame:
    return best_addresses(spark.read.parquet(f"{sf_dir}/emails.parquet")).select("company_key", "seq")


_BASE = "trim(replace(replace(replace(replace({0}, 'co.kr', ''), 'com', ''), 'net', ''), 'kr', ''), '.')"
P3_SQL = f"""
WITH rows_ AS (
  SELECT company_key, seq, lower(regexp_replace(coalesce(email, ''), '^[\\s\\x{{3000}}\\x{{a0}}]+|[\\s\\x{{3000}}\\x{{a0}}]+$', '', 'g')) AS address,
         coalesce(source_url, '') AS url, coalesce(method, '') AS method, coalesce(flagged, false) AS flagged, status
  FROM emails),
last_ AS (
  SELECT * FROM rows_ WHERE address <> ''
  QUALIFY row_number() OVER (PARTITION BY company_key, address ORDER BY seq DESC) = 1),
parts AS (
  SELECT *, split_part(address, '@', 1) AS local_,
         CASE WHEN address LIKE '%@%' THEN substr(address, strpos(address, '@') + 1) ELSE '' END AS domain_,
         replace(lower(regexp_extract(url, '^(?:[A-Za-z][\\w+.\\-]*:)?//([^/?#]*)', 1)), 'www.', '') AS host_
  FROM last_ WHERE status = 'collected'),
bases AS (SELECT *, {_BASE.format('domain_')} AS db, {_BASE.format('host_')} AS hb FROM parts),
scored AS (
  SELECT company_key, seq, CASE WHEN domain_ = '' THEN -999 ELSE
    (CASE WHEN flagged OR contains(method, 'AI 필터링 걸림') THEN -100 ELSE 0 END)
    + (CASE WHEN host_ <> '' AND domain_ <> '' AND (contains(host_, domain_) OR contains(domain_, host_)
        OR (db <> '' AND hb <> '' AND (contains(hb, db) OR contains(db, hb)))) THEN 50 ELSE 0 END)
    + (CASE WHEN replace(method, '[AI 필터링 걸림] ', '') IN ('homepage', 'homepage_direct') THEN 30 ELSE 0 END)
    + (CASE WHEN domain_ IN ('freemail.example', 'postbox.test') THEN -5 ELSE 0 END)
    + (CASE WHEN local_ IN ('biz','sales','info','contact','ceo','marketing','cs','support','service','inquiry','admin',
        'business','trade','export','import','office','sal') THEN 20
       WHEN regexp_full_match(local_, '[\\p{{L}}\\p{{N}}]{{2,20}}') THEN 10 ELSE 0 END) END AS score
  FROM bases)
SELECT company_key, seq FROM scored WHERE score > -100
QUALIFY row_number() OVER (PARTITION BY company_key ORDER BY score DESC, seq) <= 3
"""
