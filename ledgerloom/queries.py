"""The core's queries and their SQL, for the entry module.

The registries' rows stand in `companies` (row_id gives the file order), the
log of attempts in `emails`, snippets in `documents`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import constants as C
from .functions import contact
from .functions import text as T
from .operators import drift, picks, sampling
from .operators import master as M
from .operators.category import categorize
from .plans import discovery, report, table_flow
from .session import settled
from .sources import html
from .sources.spec import SPECS, empty_unified, normalize_source
from .streaming import state as S

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _in(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _case(pairs: dict, column: str, default: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in pairs.items()) + f" ELSE {default} END"


_SPACE = "[\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


_PRIORITY = _case(C.SOURCE_PRIORITY, "source_dataset_id", str(C.UNKNOWN_PRIORITY))
_NULLS = " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in C.UNIFIED_COLUMNS)
_INDUSTRY = "CASE " + " ".join(f"WHEN substr({_strip('industry_code')}, 1, 2) IN ({_in(f'{i:02d}' for i in range(a, b + 1))}) THEN '{c}'" for a, b, c in C.INDUSTRY_RANGES) + " END"
_CATEGORY = f"coalesce({_INDUSTRY}, {_case(C.SOURCE_CATEGORY, 'source_dataset_id', 'NULL')}, '{C.SERVICES}')"
_MASTER = f"""
master AS (
  SELECT * EXCLUDE (source_ids, category), {_CATEGORY} AS category,
         (SELECT string_agg(DISTINCT s.source_dataset_id, ',' ORDER BY s.source_dataset_id) FROM companies s WHERE s.company_key = c.company_key) AS source_ids
  FROM companies c
  QUALIFY row_number() OVER (PARTITION BY company_key ORDER BY {_PRIORITY}, length(coalesce(registered_on, '')) DESC, {_NULLS}, row_id) = 1)"""


def _master(spark: SparkSession, d: str) -> DataFrame:
    return categorize(_best(spark, d))


def _best(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "companies").withColumn("row_ordinal", F.col("row_id"))
    return M.build_master(rows)


# --- master ---


@query(f"WITH {_MASTER} SELECT category, count(*) AS n FROM master GROUP BY category")
def category_counts(spark, d):
    return M.value_counts(_master(spark, d), "category")


@query(f"WITH {_MASTER} SELECT company_key, row_id, source_ids, category FROM master")
def dedup_best_record(spark, d):
    return _master(spark, d).select("company_key", "row_id", "source_ids", "category")


@query("SELECT company_key, row_id FROM companies QUALIFY row_number() OVER (PARTITION BY company_key ORDER BY row_id) = 1")
def dedup_keep_first(spark, d):
    return M.keep_first(table(spark, d, "companies"), ["company_key"], "row_id").select("company_key", "row_id")


@query("SELECT company_key, string_agg(DISTINCT source_dataset_id, ',' ORDER BY source_dataset_id) AS source_ids FROM companies GROUP BY company_key")
def source_list(spark, d):
    return M.source_list(table(spark, d, "companies"))


@query("""SELECT count(*) AS rows_in, count(DISTINCT company_key) AS rows_out, count(*) - count(DISTINCT company_key) AS duplicates,
  round((count(*) - count(DISTINCT company_key)) * 100.0 / count(*), 6) AS duplicate_pct FROM companies""")
def dedup_ratio(spark, d):
    return M.dedup_ratio(table(spark, d, "companies")).withColumn("duplicate_pct", F.round("duplicate_pct", 6))


@query(f"SELECT row_id, CAST({_NULLS} AS INTEGER) AS nulls FROM companies")
def null_count(spark, d):
    df = table(spark, d, "companies")
    return df.select("row_id", M.null_count(df, C.UNIFIED_COLUMNS).alias("nulls"))


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (coalesce(CAST({c} AS VARCHAR), '') = '') AS \"empty\" FROM companies" for c in C.UNIFIED_COLUMNS))
def empty_counts(spark, d):
    return M.empty_counts(table(spark, d, "companies"), C.UNIFIED_COLUMNS)


@query(f"WITH {_MASTER} SELECT count(*) AS companies, count(*) FILTER (contains(source_ids, ',')) AS multi_source FROM master")
def multi_source_count(spark, d):
    return M.multi_source_count(_best(spark, d))


# --- names, keys, regions, numbers ---

_FORMS = "|".join(x.replace("(", "\\(").replace(")", "\\)") for x in C.LEGAL_FORMS)
_MARKS = "".join("\\" + c if c in "[]()'\"<>.,-" else c for c in C.NAME_MARKS).replace("'", "''")


def _norm(c: str, more: str = "") -> str:
    s = f"regexp_replace(coalesce({c}, ''), '{_FORMS}{more}', '', 'g')"
    s = f"regexp_replace({s}, '[{_MARKS}]', '', 'g')"
    return f"lower(regexp_replace({s}, '{_SPACE}+', '', 'g'))"


@query(f"SELECT row_id, {_norm('company_name')} AS name_key, {_norm('company_name', '|㈜')} AS table_name_key FROM companies")
def normalize_names(spark, d):
    return table(spark, d, "companies").select("row_id", T.normalized_name("company_name").alias("name_key"), T.normalized_name("company_name", True).alias("table_name_key"))


_DIGITS = "regexp_replace(coalesce(biz_reg_no, ''), '[^0-9]', '', 'g')"


@query(f"""SELECT row_id, CASE WHEN length({_DIGITS}) = 10 THEN {_DIGITS}
  ELSE substr(sha256({_norm('company_name')} || '|' || {_strip("coalesce(province, '')")} || '|' || {_strip("coalesce(district, '')")}), 1, 16) END AS made_key FROM companies""")
def company_key(spark, d):
    return table(spark, d, "companies").select("row_id", T.company_key("biz_reg_no", "company_name", "province", "district").alias("made_key"))


_PROVINCE = "CASE " + " ".join(f"WHEN starts_with({_strip('road_address')}, '{k}') THEN '{v}'" for k, v in C.PROVINCES.items()) + " END"
_WORD2 = f"string_split_regex({_strip('road_address')}, '{_SPACE}+')[2]"


@query(f"SELECT row_id, {_PROVINCE} AS province_found, CASE WHEN regexp_matches({_WORD2}, '[시군구]$') THEN {_WORD2} END AS district_found FROM companies")
def lookup_region(spark, d):
    return table(spark, d, "companies").select("row_id", T.province_of("road_address").alias("province_found"), T.district_of("road_address").alias("district_found"))


@query(f"SELECT row_id, {_INDUSTRY} AS by_code, {_CATEGORY} AS category_found FROM companies")
def categorize_rows(spark, d):
    return table(spark, d, "companies").select("row_id", T.industry_category("industry_code").alias("by_code"), T.category_of("source_dataset_id", "industry_code").alias("category_found"))


@query("SELECT row_id, try_cast(CASE WHEN regexp_full_match(trim(replace(registered_on, ',', '')), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN trim(replace(registered_on, ',', '')) END AS DOUBLE) AS as_number FROM companies")
def numeric_coerce(spark, d):
    return table(spark, d, "companies").select("row_id", T.number("registered_on").alias("as_number"))


@query(f"SELECT row_id, CASE {_strip('operating_status')} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.STATUS_NAMES.items()) + f" ELSE {_strip('operating_status')} END AS status_name FROM companies")
def status_names(spark, d):
    return table(spark, d, "companies").select("row_id", T.status_name("operating_status").alias("status_name"))


# --- sampling ---

_ACTIVE = f"coalesce(operating_status IN ({_in(C.ACTIVE_STATUSES)}), false)"
_POOL = f"pool AS (SELECT *, {_ACTIVE} AS is_active FROM master WHERE {_ACTIVE} OR coalesce(operating_status, '') = '')"


@query(f"WITH {_MASTER}, {_POOL} SELECT company_key, is_active FROM pool")
def active_filter(spark, d):
    return sampling.active_first(_master(spark, d)).select("company_key", "is_active")


_DECILE1 = """d1 AS (SELECT p.* FROM pool p JOIN (SELECT category, CASE WHEN count(employees) > 10 THEN quantile_cont(employees, 0.1) END AS cut FROM pool GROUP BY category) c USING (category)
  WHERE employees IS NULL OR cut IS NULL OR employees > cut)"""
_DECILE2 = """d2 AS (SELECT p.* FROM d1 p JOIN (SELECT category, CASE WHEN count(capital) > 10 THEN quantile_cont(capital, 0.1) END AS cut FROM d1 GROUP BY category) c USING (category)
  WHERE capital IS NULL OR cut IS NULL OR capital > cut)"""


def _survivors(spark, d):
    pool = sampling.active_first(_master(spark, d))
    for c in ("employees", "capital"):
        pool = sampling.without_bottom_decile(pool, c, ["category"])
    return pool


@query(f"WITH {_MASTER}, {_POOL}, {_DECILE1}, {_DECILE2} SELECT company_key FROM d2")
def bottom_decile(spark, d):
    return _survivors(spark, d).select("company_key")


def _hash(seed: int) -> str:
    return f"sha256('{seed}|' || company_key)"


_METRO = f"coalesce(province IN ({_in(C.METRO_PROVINCES)}), false)"
_QUOTA = "quota(category, target, metro_share) AS (VALUES " + ", ".join(f"('{c}', {int(q * 1.5)}, {int(int(q * 1.5) * C.METRO_SHARE)})" for c, q in C.QUOTAS.items()) + ")"
_STRATA = f"""strata AS (
  SELECT p.*, q.target, CASE WHEN NOT k.has_region THEN 'all' WHEN {_METRO} THEN 'metro' ELSE 'rest' END AS stratum,
         CASE WHEN NOT k.has_region THEN q.target WHEN {_METRO} THEN q.metro_share ELSE q.target - q.metro_share END AS share_
  FROM d2 p JOIN quota q USING (category) JOIN (SELECT category, bool_or(province IS NOT NULL) AS has_region FROM d2 GROUP BY category) k USING (category)),
heads AS (SELECT * FROM strata QUALIFY row_number() OVER (PARTITION BY category, stratum ORDER BY is_active DESC, registered_on DESC NULLS LAST, company_key) <= floor(share_ * 1.2)),
drawn AS (SELECT * FROM heads QUALIFY row_number() OVER (PARTITION BY category, stratum ORDER BY {_hash(C.SEED)}, company_key) <= share_)"""


@query(f"WITH {_MASTER}, {_POOL}, {_DECILE1}, {_DECILE2}, {_QUOTA}, {_STRATA} SELECT company_key, category FROM drawn")
def stratified_sample(spark, d):
    return sampling.stratified(_survivors(spark, d)).select("company_key", "category")


_CAP = """{name} AS (SELECT p.* FROM {of} p JOIN (SELECT category, greatest(1, floor(0.05 * count(*))) AS cap FROM {of} GROUP BY category) c USING (category)
  QUALIFY industry_code IS NULL OR row_number() OVER (PARTITION BY category, industry_code ORDER BY {hash}, company_key) <= cap)"""


@query(f"WITH {_MASTER}, {_CAP.format(name='capped', of='master', hash=_hash(C.SEED))} SELECT company_key FROM capped")
def industry_cap(spark, d):
    return sampling.industry_capped(_master(spark, d), ["category"]).select("company_key")


@query(f"""WITH {_MASTER}, {_POOL}, {_DECILE1}, {_DECILE2}, {_QUOTA}, {_STRATA}, {_CAP.format(name='capped', of='drawn', hash=_hash(C.SEED))}
SELECT company_key, category FROM capped QUALIFY row_number() OVER (PARTITION BY category ORDER BY {_hash(C.SEED + 1)}, company_key) <= target""")
def sample_candidates(spark, d):
    return sampling.sample_candidates(_master(spark, d)).select("company_key", "category")


@query(f"WITH {_MASTER} SELECT company_key FROM (SELECT company_key FROM master ORDER BY company_key LIMIT 200 OFFSET 100) t")
def slice_rows(spark, d):
    return sampling.slice_rows(_best(spark, d), [F.asc("company_key")], 100, 300).select("company_key")


@query(f"""WITH {_MASTER}, {_POOL} SELECT company_key, registered_on FROM (SELECT company_key, registered_on FROM pool ORDER BY is_active DESC, registered_on DESC NULLS LAST, company_key LIMIT 100) t""")
def newest_first(spark, d):
    """Report of the 100 newest active companies: the limit is the feature."""
    pool = sampling.active_first(_master(spark, d))
    return pool.orderBy(*sampling.newest_first()).limit(100).select("company_key", "registered_on")


# --- attempts ---

_STATE = """state AS (SELECT *, count(*) OVER (PARTITION BY company_key, email) - 1 AS retries FROM emails
  QUALIFY row_number() OVER (PARTITION BY company_key, email ORDER BY seq DESC) = 1)"""
_STATUS_RANK = _case({s: i for i, s in enumerate(C.STATUS_PRECEDENCE)}, "status", str(len(C.STATUS_PRECEDENCE)))
_PER_COMPANY = f"per AS (SELECT company_key, status, retries FROM state QUALIFY row_number() OVER (PARTITION BY company_key ORDER BY {_STATUS_RANK}, email) = 1)"


def _state(spark, d):
    return S.state_view(table(spark, d, "emails"))


@query(f"WITH {_STATE} SELECT company_key, email, seq, status, retries AS retry_count FROM state")
def state_latest(spark, d):
    return _state(spark, d).select("company_key", "email", "seq", "status", "retry_count")


@query(f"WITH {_STATE} SELECT status, count(DISTINCT company_key) AS companies FROM state GROUP BY status")
def status_counts(spark, d):
    return S.status_counts(_state(spark, d))


@query("SELECT count(DISTINCT company_key) AS companies FROM emails")
def total_processed(spark, d):
    return S.total_processed(_state(spark, d))


@query(f"WITH {_STATE} SELECT DISTINCT company_key FROM state WHERE status = 'failed'")
def companies_by_status(spark, d):
    return S.companies_by_status(_state(spark, d), "failed")


@query(f"WITH {_STATE}, {_PER_COMPANY} SELECT company_key, status, retries AS retry_count FROM per")
def company_status(spark, d):
    return S.company_status(_state(spark, d))


_KEYS = "keys AS (SELECT DISTINCT company_key FROM companies)"


@query(f"WITH {_STATE}, {_PER_COMPANY}, {_KEYS} SELECT company_key FROM keys LEFT JOIN per USING (company_key) WHERE status IS NULL OR (status = 'failed' AND retries < 2)")
def worklist(spark, d):
    return S.worklist(table(spark, d, "companies").select("company_key").distinct(), _state(spark, d))


@query(f"WITH {_STATE}, {_PER_COMPANY}, {_KEYS} SELECT company_key FROM keys LEFT JOIN per USING (company_key) WHERE status IS NULL OR status = 'failed'")
def retry_failed(spark, d):
    return S.worklist(table(spark, d, "companies").select("company_key").distinct(), _state(spark, d), retry_failed=True)


@query(f"""WITH {_STATE}, r AS (SELECT count(DISTINCT company_key) FILTER (status = 'collected') AS found, count(DISTINCT company_key) AS companies,
  {' + '.join(f"count(DISTINCT company_key) FILTER (status = '{s}')" for s in C.STATUSES)} AS status_sum FROM state)
SELECT found, companies, status_sum, round(found * 100.0 / companies, 6) AS rate_of_companies, round(found * 100.0 / status_sum, 6) AS rate_of_statuses FROM r""")
def hit_rates(spark, d):
    return S.hit_rates(_state(spark, d)).withColumns({c: F.round(c, 6) for c in ("rate_of_companies", "rate_of_statuses")})


@query("""WITH per AS (SELECT company_key, max(CASE WHEN status = 'collected' THEN 1 ELSE 0 END) AS hit FROM emails GROUP BY company_key)
SELECT count(*) AS outcomes, CAST(sum(hit) AS BIGINT) AS hits, round(sum(hit) * 100.0 / count(*), 6) AS hit_rate FROM per""")
def run_hit_rate(spark, d):
    return S.run_hit_rate(table(spark, d, "emails")).withColumn("hit_rate", F.round("hit_rate", 6))


# --- addresses ---

_BASE = "trim(replace(replace(replace(replace({0}, 'co.kr', ''), 'com', ''), 'net', ''), 'kr', ''), '.')"
_URL_HOST = "replace(lower(regexp_extract(coalesce(source_url, ''), '^(?:[A-Za-z][\\w+.\\-]*:)?//([^/?#]*)', 1)), 'www.', '')"
_PARTS = f"""parts AS (SELECT *, split_part(lower(email), '@', 1) AS local_, CASE WHEN email LIKE '%@%' THEN substr(lower(email), strpos(email, '@') + 1) ELSE '' END AS domain_, {_URL_HOST} AS host_ FROM {{of}}),
bases AS (SELECT *, {_BASE.format('domain_')} AS db, {_BASE.format('host_')} AS hb,
  host_ <> '' AND domain_ <> '' AND (contains(host_, domain_) OR contains(domain_, host_) OR ({_BASE.format('domain_')} <> '' AND {_BASE.format('host_')} <> ''
  AND (contains({_BASE.format('host_')}, {_BASE.format('domain_')}) OR contains({_BASE.format('domain_')}, {_BASE.format('host_')})))) AS related_ FROM parts)"""
_SCORE = f"""CASE WHEN domain_ = '' THEN -999 ELSE
  (CASE WHEN coalesce(flagged, false) OR contains(coalesce(method, ''), '{C.FLAG_MARK}') THEN -100 ELSE 0 END) + (CASE WHEN related_ THEN 50 ELSE 0 END)
  + (CASE WHEN replace(coalesce(method, ''), '{C.FLAG_PREFIX}', '') IN ('homepage', 'homepage_direct') THEN 30 ELSE 0 END)
  + (CASE WHEN domain_ IN ({_in(C.FREE_MAIL_DOMAINS)}) THEN -5 ELSE 0 END)
  + (CASE WHEN local_ IN ({_in(C.BUSINESS_LOCALS)}) THEN 20 WHEN regexp_full_match(local_, '[\\p{{L}}\\p{{N}}]{{2,20}}') THEN 10 ELSE 0 END) END"""


@query(f"WITH {_PARTS.format(of='emails')} SELECT seq, {_SCORE} AS score FROM bases")
def score_email(spark, d):
    return table(spark, d, "emails").select("seq", contact.score_email("email", "source_url", "method", "flagged").alias("score"))


_PICKS = f"""{_STATE}, {_PARTS.format(of='state')}, scored AS (SELECT *, {_SCORE} AS score,
  CASE WHEN domain_ IN ({_in(C.FREE_MAIL_DOMAINS)}) THEN '#' || seq ELSE domain_ END AS grp FROM bases WHERE status = 'collected' AND email <> ''),
firsts AS (SELECT * FROM scored WHERE score > -100 QUALIFY row_number() OVER (PARTITION BY company_key, grp ORDER BY score DESC, seq) = 1),
picks AS (SELECT *, row_number() OVER (PARTITION BY company_key ORDER BY score DESC, seq) AS rank_ FROM firsts QUALIFY rank_ <= 2)"""


@query(f'WITH {_PICKS} SELECT company_key, seq, score, CAST(rank_ AS INTEGER) AS "rank" FROM picks')
def best_picks(spark, d):
    return picks.best_picks(_state(spark, d)).select("company_key", "seq", "score", "rank")


def _blocked(c: str) -> str:
    sub = " OR ".join(f"{c} = '{b}' OR ends_with({c}, '.{b}')" for b in C.BLOCKED_EMAIL_DOMAINS)
    return f"(regexp_matches({c}, '\\.ac\\.kr$|\\.edu$|{'|'.join(C.NEWS_WORDS)}') OR {sub})"


_CLEAN = f"regexp_replace({_strip('lower(email)')}, '[.,;:]+$', '')"


@query(f"""WITH e AS (SELECT seq, {_CLEAN} AS e FROM emails), p AS (SELECT seq, e, split_part(e, '@', 1) AS l, CASE WHEN e LIKE '%@%' THEN substr(e, strpos(e, '@') + 1) ELSE '' END AS dm FROM e)
SELECT seq, contains(dm, '.') AND NOT {_blocked('dm')} AND l NOT IN ({_in(C.BLOCKED_LOCALS)}) AND NOT regexp_matches(dm, '\\.(png|jpg|gif|pdf|zip|webp)$')
  AND length(e) <= 80 AND length(l) >= 1 AND NOT regexp_matches(l, '^[.\\-_%+]|[.\\-_%+]$') AS valid FROM p""")
def valid_emails(spark, d):
    return table(spark, d, "emails").select("seq", contact.valid_email("email").alias("valid"))


def _below(c: str, domains) -> str:
    return "(" + " OR ".join(f"{c} = '{b}' OR ends_with({c}, '.{b}')" for b in domains) + ")"


@query(f"WITH {_PARTS.format(of='emails')} SELECT seq, domain_ <> '' AND domain_ NOT IN ({_in(C.FREE_MAIL_DOMAINS)}) AND host_ <> '' AND NOT {_below('host_', C.BLOG_HOSTS)} AND NOT related_ AS noise FROM bases")
def cross_domain(spark, d):
    return table(spark, d, "emails").select("seq", contact.cross_domain_noise("email", "source_url").alias("noise"))


@query(f"WITH {_PARTS.format(of='emails')} SELECT seq, host_ AS host, hb AS host_base, db AS domain_base FROM bases")
def domain_base(spark, d):
    host = contact.url_host("source_url")
    return table(spark, d, "emails").select("seq", host.alias("host"), contact.domain_base(host).alias("host_base"), contact.domain_base(contact.domain_part(F.lower("email"))).alias("domain_base"))


@query(f"WITH {_PARTS.format(of='emails')} SELECT seq, {_blocked('domain_')} AS blocked FROM bases")
def domain_suffix_block(spark, d):
    return table(spark, d, "emails").select("seq", contact.blocked_domain(contact.domain_part(F.lower("email"))).alias("blocked"))


@query("SELECT seq, " + " OR ".join(f"contains(coalesce(source_url, ''), '{b}')" for b in C.BLOCKED_URL_PARTS) + " AS blocked FROM emails")
def url_blocklist(spark, d):
    return table(spark, d, "emails").select("seq", contact.contains_any("source_url", C.BLOCKED_URL_PARTS).alias("blocked"))


_SOURCE_HOST = "replace(regexp_extract(coalesce(regexp_extract(coalesce(source_url, ''), '^(https?://\\S+)', 1), ''), '^(?:[A-Za-z][\\w+.\\-]*:)?//([^/?#]*)', 1), 'www.', '')"


@query(f"""WITH s AS (SELECT *, {_SOURCE_HOST} AS sh, CASE WHEN email LIKE '%@%' THEN substr(lower(email), strpos(email, '@') + 1) ELSE '' END AS dm FROM emails),
b AS (SELECT *, {_BASE.format('dm')} AS db, {_BASE.format('sh')} AS sb FROM s)
SELECT seq, CASE WHEN sh <> '' AND {_below('sh', C.NOISE_SOURCE_DOMAINS)} THEN false WHEN dm IN ({_in(C.FREE_MAIL_DOMAINS)}) THEN NULL
  WHEN dm <> '' AND sh <> '' AND (contains(dm, sh) OR contains(sh, dm) OR (db <> '' AND sb <> '' AND (contains(db, sb) OR contains(sb, db)))) THEN true END AS verdict FROM b""")
def rule_verdict(spark, d):
    return table(spark, d, "emails").select("seq", contact.rule_verdict("email", "source_url").alias("verdict"))


_FOUND = f"""found AS (SELECT doc_id, regexp_replace(trim(e), '[.,;:''"]+$', '') AS email FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{C.EMAIL_PATTERN}')) AS e FROM documents WHERE text IS NOT NULL) t),
parted AS (SELECT DISTINCT doc_id, email, split_part(lower(email), '@', 1) AS l, substr(lower(email), strpos(email, '@') + 1) AS dm FROM found),
good AS (SELECT doc_id, email, dm FROM parted WHERE contains(dm, '.') AND NOT {_blocked('dm')} AND l NOT IN ({_in(C.BLOCKED_LOCALS)})
  AND NOT regexp_matches(dm, '\\.(png|jpg|gif|pdf|webp)$') AND NOT contains(lower(email), '@2x') AND NOT contains(lower(email), '@3x') AND NOT regexp_matches(l, '^[.\\-_%+]|[.\\-_%+]$'))"""


@query(f"WITH {_FOUND} SELECT doc_id, email FROM good")
def extract_emails(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(contact.extract_emails("text")).alias("email"))


@query(f"WITH {_FOUND} SELECT dm AS domain, count(*) AS n FROM good GROUP BY dm")
def email_domain_counts(spark, d):
    found = table(spark, d, "documents").select("doc_id", F.explode(contact.extract_emails("text")).alias("email"))
    return found.groupBy(contact.domain_part(F.lower("email")).alias("domain")).agg(F.count("*").alias("n"))


# --- reports ---


@query(f"WITH {_MASTER}, {_PICKS} SELECT m.company_key, m.category, p.seq FROM master m JOIN picks p USING (company_key)")
def master_join(spark, d):
    return report.with_master(_master(spark, d), picks.best_picks(_state(spark, d))).select("company_key", "category", "seq")


@query(f"""WITH {_MASTER}, {_PICKS}, j AS (SELECT m.company_name, p.seq FROM master m JOIN picks p USING (company_key)),
n AS (SELECT company_name, row_number() OVER (ORDER BY min(seq), company_name) AS no FROM j GROUP BY company_name)
SELECT j.seq, CAST(n.no AS INTEGER) AS no FROM j JOIN n ON j.company_name IS NOT DISTINCT FROM n.company_name""")
def dense_number(spark, d):
    joined = report.with_master(_master(spark, d), picks.best_picks(_state(spark, d)))
    return report.dense_numbers(joined, "seq").select("seq", "no")


_QUOTAS = "quota(category, quota) AS (VALUES " + ", ".join(f"('{c}', {q})" for c, q in C.QUOTAS.items()) + ")"


@query(f"""WITH {_MASTER}, {_PICKS}, {_QUOTAS}, j AS (SELECT m.category, count(*) AS pick_rows, count(DISTINCT m.company_name) AS companies FROM master m JOIN picks p USING (company_key) GROUP BY m.category)
SELECT q.category, CAST(q.quota AS BIGINT) AS quota, coalesce(pick_rows, 0) AS pick_rows, coalesce(companies, 0) AS companies, coalesce(companies, 0) - q.quota AS delta FROM quota q LEFT JOIN j USING (category)""")
def quota_summary(spark, d):
    return report.quota_summary(_master(spark, d), picks.best_picks(_state(spark, d)))


@query(f"WITH {_MASTER} SELECT (SELECT count(DISTINCT company_key) FROM emails) AS processed, count(*) AS candidates, round((SELECT count(DISTINCT company_key) FROM emails) * 100.0 / count(*), 6) AS progress_pct FROM master")
def progress(spark, d):
    return report.progress(_state(spark, d), _best(spark, d)).withColumn("progress_pct", F.round("progress_pct", 6))


@query(f"""WITH {_STATE}, known AS (SELECT {_norm('company_name', '|㈜')} AS n, count(*) AS k FROM state GROUP BY 1)
SELECT c.row_id, coalesce(known.k, 0) AS known_results FROM companies c LEFT JOIN known ON known.n = {_norm('c.company_name', '|㈜')} AND known.n <> ''""")
def existing_lookup(spark, d):
    state = _state(spark, d)
    rows = table(spark, d, "companies").select("row_id", F.col("company_name").alias("_name"))
    found = table_flow.existing_results(rows, state.select("company_name", "email", "source_url", "method", "status"))
    return found.groupBy("row_id").agg(F.count("known_status").alias("known_results"))


# --- discovery: the documents are what searches and visits bring ---

_ANY_HOST = "replace(lower(regexp_extract(coalesce({0}, ''), '^(?:[A-Za-z][\\w+.\\-]*:)?//([^/?#]*)', 1)), 'www.', '')"
_HOME = f"CASE WHEN {_ANY_HOST.format('homepage')} <> '' THEN 'http://' || {_ANY_HOST.format('homepage')} END"
_NO_AT_FIRST = "regexp_extract({0}, '^[^@]*@(.*)$', 1)"
_FIRMS = f"""firms AS (SELECT company_key, company_name, {_HOME} AS homepage FROM companies QUALIFY row_number() OVER (PARTITION BY company_key ORDER BY row_id) = 1)"""
_RESULTS = """results AS (
  SELECT query, engine, row_number() OVER (PARTITION BY query, engine ORDER BY doc_id) AS rank, url, text AS snippet FROM (
    SELECT doc_id, coalesce(company_name, '') || ' 이메일' AS query, ['naver_webkr', 'naver_local', 'duckduckgo'][doc_id % 3 + 1] AS engine, url, text
    FROM documents JOIN firms USING (company_key)) t)"""
_PAGES = f"""pages AS (
  SELECT url, text AS html FROM documents WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1
  UNION ALL SELECT 'http://' || {_ANY_HOST.format('url')}, text FROM documents WHERE {_ANY_HOST.format('url')} <> ''
  QUALIFY row_number() OVER (PARTITION BY {_ANY_HOST.format('url')} ORDER BY doc_id) = 1)"""


def _discovery_tables(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Firms with their homepage's root; every document a result of its firm's first query; documents and hosts' first documents as pages."""
    firms = M.keep_first(table(spark, d, "companies").select("company_key", "company_name", "homepage", "row_id"), ["company_key"], "row_id")
    root = lambda c: F.when(contact.url_host(c) != "", F.concat(F.lit("http://"), contact.url_host(c)))
    firms = firms.select("company_key", "company_name", root("homepage").alias("homepage"))
    docs = table(spark, d, "documents").select("doc_id", "company_key", "url", "text")
    engine = F.element_at(F.array(*(F.lit(e) for e in ("naver_webkr", "naver_local", "duckduckgo"))), (F.col("doc_id") % 3 + 1).cast("int"))
    asked = docs.join(firms, "company_key").select("doc_id", F.concat(F.coalesce("company_name", F.lit("")), F.lit(" 이메일")).alias("query"), engine.alias("engine"), "url", F.col("text").alias("snippet"))
    results = asked.withColumn("rank", F.row_number().over(W.partitionBy("query", "engine").orderBy("doc_id"))).withColumns({"title": F.lit(None).cast("string"), "address": F.lit(None).cast("string")})
    first = lambda rows: M.keep_first(rows, ["url"], "doc_id").select("url", F.col("text").alias("html"))
    pages = first(docs.where("url is not null")).unionByName(first(docs.withColumn("url", root("url")).where("url is not null")))
    return firms, results.drop("doc_id"), pages


@query(f"""WITH {_FIRMS}, named AS (SELECT company_key, coalesce(company_name, '') AS n, regexp_replace(replace(coalesce(homepage, ''), 'http://', ''), '^www\\.', '') AS site FROM firms),
q AS (SELECT company_key, unnest([n || ' 이메일', n || ' 공식 홈페이지', '"' || n || '" "@"', CASE WHEN site <> '' THEN 'site:' || site || ' 이메일' END, CASE WHEN site <> '' THEN 'site:' || site || ' contact' END]) AS query, unnest([0, 1, 2, 3, 4]) AS query_no FROM named)
SELECT company_key, query_no, query FROM q WHERE query IS NOT NULL""")
def search_queries(spark, d):
    return discovery.search_queries(_discovery_tables(spark, d)[0]).select("company_key", "query_no", "query")


_ENGINE_NO = "CASE engine WHEN 'naver_webkr' THEN 0 WHEN 'naver_local' THEN 1 WHEN 'duckduckgo' THEN 3 END"
_DEPTH = "CASE engine WHEN 'naver_webkr' THEN 10 ELSE 5 END"
_URL_OK = "coalesce(url, '') <> '' AND NOT (" + " OR ".join(f"contains(url, '{b}')" for b in C.BLOCKED_URL_PARTS) + ")"
_VISITABLE = f"CASE WHEN {_strip("coalesce(homepage, '')")} NOT IN ({_in(C.UNUSABLE_HOMEPAGES)}) AND starts_with({_strip("coalesce(homepage, '')")}, 'http') THEN {_strip("coalesce(homepage, '')")} END"
_CANDIDATES = f"""homes AS (SELECT company_key, {_VISITABLE} AS home FROM firms),
asked AS (SELECT company_key, coalesce(company_name, '') || ' 이메일' AS query FROM firms),
seen AS (SELECT a.company_key, r.url, ' ' || coalesce(r.snippet, '') AS snippet, engine, {_ENGINE_NO} AS engine_no, rank
  FROM asked a JOIN results r USING (query) JOIN homes h USING (company_key) WHERE rank <= {_DEPTH} AND {_URL_OK} AND (home IS NULL OR home <> url)),
placed AS (SELECT company_key, url, snippet, engine, row_number() OVER (PARTITION BY company_key ORDER BY engine_no, rank) AS place FROM (
  SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY company_key, url ORDER BY engine_no, rank) = 1) t)"""


@query(f"WITH {_FIRMS}, {_RESULTS}, {_CANDIDATES} SELECT company_key, url, engine, CAST(place AS INTEGER) AS place FROM placed")
def candidate_urls(spark, d):
    firms, results, _ = _discovery_tables(spark, d)
    return discovery.candidate_urls(firms, results).select("company_key", "url", "engine", "place")


def _extracted(name: str, of: str, text: str) -> str:
    """The acceptable addresses of each row's text with the place of their first appearance."""
    return f"""{name}_raw AS (SELECT k, unnest(regexp_extract_all(t, '{C.EMAIL_PATTERN}')) AS e, unnest(range(len(regexp_extract_all(t, '{C.EMAIL_PATTERN}')))) AS i FROM (SELECT DISTINCT {text} AS k, {text} AS t FROM {of}) x),
{name}_clean AS (SELECT k, regexp_replace(trim(e), '[.,;:''"]+$', '') AS email, min(i) AS pos FROM {name}_raw GROUP BY 1, 2),
{name} AS (SELECT k, email, pos FROM (SELECT *, split_part(lower(email), '@', 1) AS l, substr(lower(email), strpos(email, '@') + 1) AS dm FROM {name}_clean) y
  WHERE contains(dm, '.') AND NOT {_blocked('dm')} AND l NOT IN ({_in(C.BLOCKED_LOCALS)}) AND NOT regexp_matches(dm, '\\.(png|jpg|gif|pdf|webp)$')
    AND NOT contains(lower(email), '@2x') AND NOT contains(lower(email), '@3x') AND NOT regexp_matches(l, '^[.\\-_%+]|[.\\-_%+]$'))"""


def _noise(email: str, url: str) -> str:
    dm, host = f"substr(lower({email}), strpos({email}, '@') + 1)", _ANY_HOST.format(url)
    db, hb = _BASE.format(dm), _BASE.format(host)
    related = f"(contains({host}, {dm}) OR contains({dm}, {host}) OR ({db} <> '' AND {hb} <> '' AND (contains({hb}, {db}) OR contains({db}, {hb}))))"
    return f"({dm} NOT IN ({_in(C.FREE_MAIL_DOMAINS)}) AND {host} <> '' AND NOT {_below(host, C.BLOG_HOSTS)} AND NOT {related})"


def _valid(email: str) -> str:
    e = f"regexp_replace(lower({email}), '[.,;:]+$', '')"
    l, dm = f"split_part({e}, '@', 1)", f"substr({e}, strpos({e}, '@') + 1)"  # noqa: E741
    return f"(contains({dm}, '.') AND NOT {_blocked(dm)} AND {l} NOT IN ({_in(C.BLOCKED_LOCALS)}) AND NOT regexp_matches({dm}, '\\.(png|jpg|gif|pdf|zip|webp)$') AND length({e}) <= 80 AND length({l}) >= 1 AND NOT regexp_matches({l}, '^[.\\-_%+]|[.\\-_%+]$'))"


_HITS = f"""{_extracted('on_page', 'pages', 'html')}, {_extracted('in_snippet', 'placed', 'snippet')},
visits AS (SELECT company_key, url, place FROM placed WHERE place <= {C.MAX_VISITS} AND NOT regexp_matches(lower(url), '\\.(pdf|jpg|png|gif|zip)$')),
zero AS (SELECT company_key, email, home AS source_url, 'homepage_direct' AS method, 0 AS phase, 0 AS a, pos AS c FROM homes JOIN pages p ON p.url = home JOIN on_page o ON o.k = p.html WHERE NOT {_noise('email', 'home')}),
two AS (SELECT company_key, email, url AS source_url, engine || '_snippet' AS method, 2 AS phase, place AS a, pos AS c FROM placed JOIN in_snippet ON k = snippet),
three AS (SELECT company_key, email, v.url AS source_url, 'homepage' AS method, 3 AS phase, place AS a, pos AS c FROM visits v JOIN pages p ON p.url = v.url JOIN on_page o ON o.k = p.html WHERE NOT {_noise('email', 'v.url')})"""


@query(f"""WITH {_FIRMS}, {_RESULTS}, {_PAGES}, {_CANDIDATES}, {_HITS},
hits AS (SELECT *, row_number() OVER (PARTITION BY company_key, email ORDER BY phase, a, c) = 1 AS is_new FROM (SELECT * FROM zero UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three) t),
counted AS (SELECT *, coalesce(sum(CAST(is_new AS INTEGER)) OVER (PARTITION BY company_key ORDER BY phase, a, c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_,
  sum(CASE WHEN phase = 3 THEN 1 ELSE 0 END) OVER (PARTITION BY company_key ORDER BY phase, a, c ROWS UNBOUNDED PRECEDING) AS visit_no FROM hits),
kept AS (SELECT c.* FROM counted c LEFT JOIN (SELECT company_key, min(place) AS first_visit FROM visits GROUP BY 1) f USING (company_key)
  WHERE is_new AND (phase < 3 OR before_ < {C.MAX_EMAILS} OR (visit_no = 1 AND a = first_visit)))
SELECT company_key, email, source_url, method, CAST(row_number() OVER (PARTITION BY company_key ORDER BY phase, a, c) AS INTEGER) AS place FROM kept WHERE {_valid('email')}""")
def discover_hits(spark, d):
    return discovery.discover(*_discovery_tables(spark, d)).select("company_key", "email", "source_url", "method", "place")


@query(f"""WITH {_FIRMS}, {_RESULTS}, {_PAGES}, {_CANDIDATES}, {_extracted('on_page', 'pages', 'html')}, {_extracted('in_snippet', '(SELECT DISTINCT coalesce(snippet, \'\') AS snippet FROM results) z', 'snippet')},
every_ AS (
  SELECT company_key, email, home AS source_url, 'homepage_direct' AS method, -1 AS a, 0 AS b, 0 AS c, pos FROM homes JOIN pages p ON p.url = home JOIN on_page o ON o.k = p.html WHERE NOT {_noise('email', 'home')}
  UNION ALL
  SELECT company_key, email, coalesce(url, ''), engine || '_snippet', 0, {_ENGINE_NO}, rank, pos FROM asked JOIN results USING (query) JOIN in_snippet ON k = coalesce(snippet, '')
  WHERE engine <> 'naver_local' AND rank <= {discovery.QUICK_DEPTH} AND NOT ({" OR ".join(f"contains(coalesce(url, ''), '{b}')" for b in C.BLOCKED_URL_PARTS)}))
SELECT company_key, email, source_url, method FROM every_ WHERE {_valid('email')} QUALIFY row_number() OVER (PARTITION BY company_key ORDER BY a, b, c, pos) = 1""")
def first_hit(spark, d):
    return discovery.first_hit(*_discovery_tables(spark, d)).select("company_key", "email", "source_url", "method")


@query("""SELECT 'https://' || company_key || '.example/a/b' AS url, CAST(n AS INTEGER) AS position, link FROM (SELECT DISTINCT company_key FROM companies) c,
LATERAL (SELECT unnest([1, 2, 3, 4, 5]) AS n, unnest(['https://' || company_key || '.example/contact', 'https://' || company_key || '.example/a/about.html', 'https://' || company_key || '.example/x', 'https://' || company_key || '.example/1?company', 'https://' || company_key || '.example/a/c/contact']) AS link)""")
def contact_links(spark, d):
    """The contact links of one made page per company: order, relative links, words in texts, other hosts, stopwords, repeats, the limit."""
    page = (
        '<a href="/contact">x</a><a href="about.html">x</a><a href="http://elsewhere.example/contact">x</a><a href="/privacy/contact">x</a><a>contact</a><a href="/x">오시는길</a>'
        '<a href="/contact">again</a><a href="../1?company">x</a><a href="/none">none</a><a href="c/contact">x</a><a href="/sixth/contact">x</a>'
    )
    keys = table(spark, d, "companies").select("company_key").distinct()
    return html.contact_links(keys.select(F.concat(F.lit("https://"), "company_key", F.lit(".example/a/b")).alias("url"), F.lit(page).alias("html")))


@query(f"WITH {_FIRMS} SELECT row_id, CASE WHEN {_strip("coalesce(road_address, '')")} <> '' THEN road_address WHEN {_strip("coalesce(lot_address, '')")} <> '' THEN lot_address ELSE '' END AS address FROM companies")
def search_addresses(spark, d):
    return table(spark, d, "companies").select("row_id", discovery.search_address().alias("address"))


@query(f"""WITH {_FIRMS}, {_STATE}, hits AS (SELECT company_key, email, source_url, method FROM state WHERE status = 'collected' AND email <> ''),
errors AS (SELECT company_key, min(error_message) AS error_message FROM emails WHERE error_message IS NOT NULL GROUP BY 1)
SELECT company_key, email, 'collected' AS status FROM firms JOIN hits USING (company_key)
UNION ALL SELECT company_key, '', CASE WHEN trim(coalesce(company_name, '')) = '' THEN 'skipped' WHEN error_message IS NOT NULL THEN 'failed' ELSE 'not_found' END
FROM firms LEFT JOIN errors USING (company_key) WHERE company_key NOT IN (SELECT company_key FROM hits)""")
def outcome_rows(spark, d):
    firms = _discovery_tables(spark, d)[0]
    hits = _state(spark, d).where("status = 'collected' and email != ''")
    errors = table(spark, d, "emails").where("error_message is not null").groupBy("company_key").agg(F.min("error_message").alias("error_message"))
    return S.outcome_rows(firms, hits, "2025-01-01T00:00:00", errors).select("company_key", "email", "status")


@query(f"WITH {_STATE}, {_PER_COMPANY}, {_KEYS} SELECT company_key FROM keys LEFT JOIN per USING (company_key) WHERE status IS NULL OR (status = 'failed' AND retries < 2)")
def worklist_compacted(spark, d):
    """The work list of a log whose older half was compacted is that of the whole log."""
    log = table(spark, d, "emails")
    older = F.col("seq") <= log.agg((F.max("seq") / 2).alias("m")).scalar()
    kept = S.compacted(log.where(older)).unionByName(log.where(~older).drop("retry_count"), allowMissingColumns=True)
    return S.worklist(table(spark, d, "companies").select("company_key").distinct(), S.state_view(kept))


_QUOTA_ROWS = ", ".join(f"('{c}', {q}, {k})" for k, (c, q) in enumerate(C.QUOTAS.items(), 1))


@query(f"""WITH {_MASTER}, {_PICKS}, quota(category, quota, place) AS (VALUES {_QUOTA_ROWS}),
j AS (SELECT m.category, count(*) AS pick_rows, count(DISTINCT m.company_name) AS companies FROM master m JOIN picks p USING (company_key) GROUP BY m.category),
r AS (SELECT count(DISTINCT company_key) FILTER (status = 'collected') AS found, {' + '.join(f"count(DISTINCT company_key) FILTER (status = '{s}')" for s in C.STATUSES)} AS processed FROM state)
SELECT 1 AS part, q.place, q.category, CAST(q.quota AS BIGINT) AS quota, coalesce(pick_rows, 0) AS pick_rows, coalesce(companies, 0) AS companies, coalesce(companies, 0) - q.quota AS delta,
  NULL::BIGINT AS processed, NULL::BIGINT AS found, NULL::DOUBLE AS hit_rate, NULL::BIGINT AS pick_companies, NULL::BIGINT AS emails FROM quota q LEFT JOIN j USING (category)
UNION ALL SELECT 2, 1, NULL, NULL, NULL, NULL, NULL, processed, found, round(found * 100.0 / processed, 6), NULL, NULL FROM r
UNION ALL SELECT 3, 1, NULL, NULL, (SELECT count(*) FROM picks), NULL, NULL, NULL, NULL, NULL, (SELECT count(DISTINCT company_key) FROM picks), (SELECT count(DISTINCT email) FROM picks)""")
def report_summary(spark, d):
    state = _state(spark, d)
    out = report.summary(_master(spark, d), state, picks.best_picks(state))
    return out.drop("hit_rate_text").withColumn("hit_rate", F.round("hit_rate", 6))


# --- raw registries ---

#: Headers under which each registry's rows are read, and the columns they hold.
_RAW = {
    "15105482": {"사업자등록번호": "biz_reg_no", "회사명": "company_name_raw", "대표자": "representative", "업종코드": "industry_code", "도로명 주소": "road_address", "지번 주소": "lot_address", "종업원수": "employees", "가동상태": "operating_status", "설립일": "registered_on"},
    "15057023": {"CMPNY_NM": "company_name_raw", "REFINE_ROADNM_ADDR": "road_address", "REFINE_LOTNO_ADDR": "lot_address", "TELNO": "phone", "INDUTYPE_CD_INFO": "industry_code", "EMPLY_CNT": "employees", "FACTRY_REGIST_DE": "registered_on"},
    "15052274": {"사업자 번호": "biz_reg_no", "업체": "company_name_raw", "대표자명": "representative", "소재지 주소": "road_address", "연락처": "phone", "직원수": "employees"},
    "innobiz": {"회사명": "company_name_raw", "지역": "province", "인증일": "registered_on"},
    "15118569": {"사업자등록": "biz_reg_no", "상호": "company_name_raw", "대표": "representative", "주소": "road_address", "전화": "phone", "등록일": "registered_on"},
    "15086381": {"기업명": "company_name_raw", "대표자": "representative", "소재지": "road_address", "전화번호": "phone", "인력": "employees"},
    "15099307": {"사업자번호": "biz_reg_no", "업체명": "company_name_raw", "소재": "road_address", "신고일": "registered_on"},
    "15065485": {"ncrGsKname": "company_name_raw", "ncrGsMaster": "representative", "ncrGsAddr": "road_address", "ncrGsRegdate": "registered_on", "ncrMasterNum": "biz_reg_no", "ncrOffTel": "phone"},
    "15071341": {"사업장명": "company_name_raw", "전화번호": "phone", "지번주소": "lot_address", "도로명주소": "road_address", "영업상태명": "operating_status", "인허가일자": "registered_on"},
}
_SHOWN = ["company_name", "representative", "industry_code", "province", "district", "road_address", "lot_address", "phone", "employees", "registered_on", "operating_status"]


def _normalized_sql(source: str) -> str:
    has = set(_RAW[source].values())
    text = lambda c: f"coalesce({c}, '')" if c in has else "NULL"
    address = "coalesce(road_address, '')" if "road_address" in has else "coalesce(lot_address, '')"
    word = f"string_split_regex({_strip(address)}, '{_SPACE}+')[2]"
    by_address = SPECS[source].region_from_address
    province = "CASE " + " ".join(f"WHEN starts_with({_strip(address)}, '{k}') THEN '{v}'" for k, v in C.PROVINCES.items()) + " END" if by_address else text("province")
    district = f"CASE WHEN regexp_matches({word}, '[시군구]$') THEN {word} END" if by_address else "NULL"
    digits = "regexp_replace(coalesce(biz_reg_no, ''), '[^0-9]', '', 'g')" if "biz_reg_no" in has else "''"
    status = text("operating_status")
    if SPECS[source].map_status:
        status = f"CASE {_strip(status)} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.STATUS_NAMES.items()) + f" ELSE {_strip(status)} END"
    number = "employees" if "employees" in has else "NULL::DOUBLE"
    columns = {c: text(c) for c in ("representative", "industry_code", "road_address", "lot_address", "phone", "registered_on")} | {"company_name": _strip("coalesce(company_name_raw, '')"), "province": province, "district": district, "employees": number, "operating_status": status}
    made = f"SELECT row_id, '{source}' AS source_dataset_id, {digits} AS digits, " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM companies WHERE source_dataset_id = '{source}'"
    key = f"CASE WHEN length(digits) = 10 THEN digits ELSE substr(sha256({_norm('company_name')} || '|' || {_strip("coalesce(province, '')")} || '|' || {_strip("coalesce(district, '')")}), 1, 16) END"
    return f"SELECT source_dataset_id, {key} AS company_key, {', '.join(_SHOWN)} FROM ({made}) t QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY row_id) = 1"


@query(" UNION ALL ".join(_normalized_sql(s) for s in _RAW))
def normalize_registries(spark, d):
    """Every registry's rows, under headers of its own, through its header rules into the unified schema."""
    rows, parts = table(spark, d, "companies"), []
    for source, headers in _RAW.items():
        value = lambda c: F.col(c).cast("decimal(20,2)").cast("string") if c == "employees" else F.col(c)
        raw = rows.where(F.col("source_dataset_id") == source).select(F.col("row_id").alias("row_ordinal"), *(value(c).alias(h) for h, c in headers.items()))
        parts.append(normalize_source(raw, SPECS[source], "2025-01-01"))
    return reduce(DataFrame.unionByName, parts).select("source_dataset_id", "company_key", *_SHOWN)


@query("""WITH c AS (SELECT 'customer' AS source, c_name AS name, c_nationkey AS nation, CAST(round(c_acctbal, 2) AS DOUBLE) AS capital FROM customer
UNION ALL SELECT 'supplier', s_name, s_nationkey, CAST(round(s_acctbal, 2) AS DOUBLE) FROM supplier)
SELECT c.source, c.name, n.n_name AS nation_name, c.capital FROM c LEFT JOIN nation n ON c.nation = n.n_nationkey""")
def unify_sources(spark, d):
    one = table(spark, d, "customer").select(F.lit("customer").alias("source"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.round("c_acctbal", 2).alias("capital"))
    two = table(spark, d, "supplier").select(F.lit("supplier").alias("source"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.round("s_acctbal", 2).alias("capital"))
    nations = F.broadcast(table(spark, d, "nation"))
    both = one.unionByName(two, allowMissingColumns=True)
    return both.join(nations, both.nation == nations.n_nationkey, "left").select("source", "name", F.col("n_name").alias("nation_name"), "capital")


@query()
def conform_raw(spark, d):
    """Every registry's files in the unified schema, by its header rules: all readable records, one row per company_key of a registry.

    A registry that has no ``SourceSpec`` has no rules to be read by, and gives no rows.
    """
    raw = table(spark, d, "raw_records")
    changes, parts = settled(drift.schema_changes(raw)), []
    for (source,) in raw.where(F.col("source_dataset_id").isin(list(SPECS))).select("source_dataset_id").distinct().orderBy("source_dataset_id").collect():
        wide = drift.unified_records(raw.where(F.col("source_dataset_id") == source), changes).withColumn("row_ordinal", F.col("rec_id"))
        parts.append(normalize_source(wide.drop("rec_id", "source_dataset_id", "file_seq"), SPECS[source], "2025-01-01"))
    return reduce(DataFrame.unionByName, parts, empty_unified(spark))


@query()
def p1_found(spark, d):
    return drift.schema_changes(table(spark, d, "raw_records"))


@query()
def p1_unified(spark, d):
    return drift.unified_records(table(spark, d, "raw_records"))
