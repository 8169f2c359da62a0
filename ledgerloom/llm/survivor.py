"""The best representative of each duplicate group, field by field, by token-level consensus.

Progressive alignment along a star: the group's centre (its most supported, or
most trusted, value) is the profile's first sequence, and every other different
value is aligned with it token by token; tokens that the centre lacks open
columns of their own. Every column is voted on, and the existing value closest
to the winning tokens survives. Each value meets the centre and its votes only,
so votes are sums: groups of any size give the same result, in one task or in many.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import filled, real_date, strip
from ..session import settled

#: Different values up to which a group is handled in one task; larger ones are spread, with the same result.
TOGETHER = 64
#: A plausible head count.
EMPLOYEES = (1, 50_000)

_TOKEN = re.compile(r"\w+|[^\w\s]")


def tokens(value: str) -> list[str]:
    return _TOKEN.findall(value.lower())


def align(centre: list[str], seq: list[str]) -> list[tuple[int, int, str]]:
    """Needleman-Wunsch of a token sequence with the centre, as votes (column, insertion, token).

    Column i is the centre's token i ('' votes for leaving it out), with
    insertion 0; what is inserted after it (-1: before the first) is numbered from 1.
    """
    n, m = len(centre), len(seq)
    cost = [[-i - j if not i or not j else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            fit = 2 if centre[i - 1] == seq[j - 1] else -1
            cost[i][j] = max(cost[i - 1][j - 1] + fit, cost[i - 1][j] - 1, cost[i][j - 1] - 1)
    matched, between = [], defaultdict(list)
    i, j = n, m
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + (2 if centre[i - 1] == seq[j - 1] else -1):
            i, j = i - 1, j - 1
            matched.append((i, 0, seq[j]))
        elif i and cost[i][j] == cost[i - 1][j] - 1:
            i -= 1
            matched.append((i, 0, ""))
        else:
            j -= 1
            between[i - 1].append(seq[j])
    return matched[::-1] + [(at, k, t) for at, ts in sorted(between.items()) for k, t in enumerate(reversed(ts), 1)]


def distance(a: list[str], b: list[str]) -> int:
    """Edit distance of token sequences."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def elect(values: list[str], support: list[int], dominance: bool) -> int:
    """The index of the value closest to the consensus; ``values`` stand in order of trust, which settles ties."""
    seqs = [tokens(v) for v in values]
    order = range(len(values)) if dominance else sorted(range(len(values)), key=lambda k: (-support[k], k))
    centre = seqs[order[0]]
    columns: dict[tuple[int, int], dict[str, tuple]] = defaultdict(dict)
    for k in range(len(values)):
        for i, j, t in align(centre, seqs[k]):
            n, first = columns[i, j].get(t, (0, k))
            columns[i, j][t] = (n + support[k], min(first, k))
    total = sum(support)
    consensus = []
    for at, votes in sorted(columns.items()):
        if at[1]:
            # Whoever inserts nothing here votes for nothing; the centre, the most trusted one, is among them.
            votes[""] = (total - sum(n for n, _ in votes.values()), -1)
        best = min(votes, key=lambda t: (votes[t][1], t)) if dominance else min(votes, key=lambda t: (-votes[t][0], t))
        consensus += [best] if best else []
    rank = {k: r for r, k in enumerate(order)}
    return min(range(len(values)), key=lambda k: (distance(seqs[k], consensus), rank[k]))


_OUT = "group_key string, field_name string, value string, row_id bigint, support bigint"


def consensus_survivors(rows: DataFrame, dominance: bool = True, together: int = TOGETHER) -> DataFrame:
    """One existing value per (group_key, field_name): group_key, field_name, value, row_id, support.

    Input: group_key, field_name, value STRING, trust STRING (sorts the most
    trusted first; total within a group), row_id BIGINT. NULL or blank values take no
    part; groups without a usable value give no row; NULL keys give none.

    With ``dominance`` the most trusted value that votes in a column wins it, as
    if every value outweighed all less trusted ones together; all win by the most trusted value
    then, which survives. Otherwise every row has a vote, ties go to the token
    that sorts first, and of values equally close the more supported, then the more trusted.

    Equal values are merged in Spark first (the most trusted row stands for
    them). Groups of up to ``together`` different values are elected in one
    task; of larger ones values, votes and distances are rows of their own.
    """
    usable = rows.where(filled("value") & F.col("group_key").isNotNull())
    merged = usable.groupBy("group_key", "field_name", "value").agg(F.min(F.struct("trust", "row_id")).alias("_best"), F.count("*").alias("support"))
    merged = settled(merged.select("group_key", "field_name", "_best.trust", "value", "_best.row_id", "support"))
    # A list of at most ``together`` + 1 values, whatever the group's size.
    member = F.struct("trust", "value", "row_id", "support")
    sizes = merged.groupBy("group_key", "field_name").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > together)
    key = ["group_key", "field_name"]
    if large.isEmpty():
        small, spread_out = merged, None
    else:
        large = settled(large.drop("n"))
        small, spread_out = merged.join(large, key, "left_anti"), _spread(merged.join(large, key, "left_semi"), dominance)
    packed = small.groupBy(*key).agg(F.sort_array(F.collect_list(member)).alias("members"))
    several = F.size("members") > 1
    alone = packed.where(~several).select(*key, F.inline("members")).select("group_key", "field_name", "value", "row_id", "support")
    voted = packed.where(several).mapInPandas(_elections(dominance), _OUT)
    out = alone.unionByName(voted)
    return out if spread_out is None else out.unionByName(spread_out)


def _elections(dominance: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            best = []
            for members in pdf["members"]:
                kept = members[elect([m["value"] for m in members], [m["support"] for m in members], dominance)]
                best.append((kept["value"], kept["row_id"], sum(m["support"] for m in members)))
            yield pd.DataFrame({"group_key": pdf["group_key"], "field_name": pdf["field_name"], **dict(zip(("value", "row_id", "support"), zip(*best, strict=True), strict=True))})

    return run


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            out += [(r.group_key, r.field_name, i, j, t, r.support, r.trust) for i, j, t in align(tokens(r.centre), tokens(r.value))]
        yield pd.DataFrame(out, columns=["group_key", "field_name", "at", "insertion", "token", "support", "trust"])


def _distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        far = [distance(tokens(v), list(c)) for v, c in zip(pdf["value"], pdf["consensus"], strict=True)]
        yield pdf.drop(columns="consensus").assign(far=far)


def _spread(merged: DataFrame, dominance: bool) -> DataFrame:
    """The same election with one row per value and vote: sums and minima, which Spark combines before it shuffles."""
    key = ["group_key", "field_name"]
    order = F.struct("trust") if dominance else F.struct((-F.col("support")).alias("s"), F.col("trust").alias("t"))
    groups = merged.groupBy(*key).agg(F.min_by("value", order).alias("centre"), F.sum("support").alias("total"))
    votes = merged.join(groups, key).select(*key, "value", "centre", "support", "trust").mapInPandas(_votes, "group_key string, field_name string, at int, insertion int, token string, support bigint, trust string")
    counted = votes.groupBy(*key, "at", "insertion", "token").agg(F.sum("support").alias("n"), F.min("trust").alias("trust"))
    column = counted.groupBy(*key, "at", "insertion").agg(
        F.sum("n").alias("voted"), F.min_by(F.struct("token", "n"), F.struct("trust", "token") if dominance else F.struct((-F.col("n")).alias("n"), F.col("token").alias("t"))).alias("best")
    )
    # Whoever inserts nothing votes for nothing: as '' sorts first it wins ties, and with dominance the centre always wins.
    silent = F.col("total") - F.col("voted")
    kept = F.when(F.col("insertion") == 0, F.col("best.token")).when(F.lit(not dominance) & (F.col("best.n") > silent), F.col("best.token")).otherwise("")
    won = column.join(groups.select(*key, "total"), key).select(*key, "at", "insertion", kept.alias("token")).where("token != ''")
    consensus = won.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("at", "insertion", "token"))).alias("c")).select(*key, F.transform("c", lambda x: x["token"]).alias("consensus"))
    compared = merged.join(consensus, key, "left").withColumn("consensus", F.coalesce("consensus", F.array().cast("array<string>")))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in merged.schema)
    far = compared.mapInPandas(_distances, f"{kinds}, far int")
    best = far.groupBy(*key).agg(F.min_by(F.struct("value", "row_id"), F.struct(F.col("far").alias("f"), order.alias("o"))).alias("b"), F.sum("support").alias("support"))
    return best.select(*key, "b.value", F.col("b.row_id").cast("bigint").alias("row_id"), "support")


def usable_homepage(c: str) -> Column:
    """The homepage if it names a host with at least two labels besides a leading www; e-mail addresses are none."""
    s = strip(c)
    label = r"[\p{L}\p{N}](?:[\p{L}\p{N}\-]*[\p{L}\p{N}])?"
    host = rf"(?i)^(?:[a-z][a-z0-9+.\-]*:)?(?://)?(?:www\.)?(?:{label}\.)+\p{{L}}[\p{{L}}\p{{N}}\-]*\.?(?::\d*)?(?:[/?#].*)?$"
    only_www = r"(?i)^(?:[a-z][a-z0-9+.\-]*:)?(?://)?www\.\p{L}[\p{L}\p{N}\-]*\.?(?::\d*)?(?:[/?#].*)?$"
    return F.when(s.rlike(host) & ~s.rlike(only_www), s)


def field_values(companies: DataFrame, registries: DataFrame) -> DataFrame:
    """The usable homepage and employees of every row of a company_key with two or more rows, with the row's trust.

    Trust is the registry's priority, then the newest real registered_on that
    isn't after collected_on, then the lowest row_id, as text that sorts so.
    """
    ranks = registries.select(F.col("source_dataset_id").alias("_source"), F.col("priority").alias("_priority"))
    many = companies.groupBy("company_key").agg(F.count("*").alias("_n")).where("_n >= 2 and company_key is not null").select("company_key")
    date = real_date("registered_on")
    day = F.datediff(F.when(date <= real_date("collected_on"), date), F.lit("0001-01-01").cast("date"))
    trust = F.concat(
        F.format_string("%010d", F.coalesce("_priority", F.lit(C.UNKNOWN_PRIORITY)).cast("bigint")),
        F.format_string("%010d", F.coalesce(F.lit(9_999_999) - day, F.lit(9_999_999_999)).cast("bigint")),
        F.format_string("%020d", F.col("row_id")),
    )
    heads = F.when(F.col("employees").between(*EMPLOYEES), F.format_string("%s", F.col("employees")))
    fields = F.explode(F.array(F.struct(F.lit("homepage").alias("field_name"), usable_homepage("homepage").alias("value")), F.struct(F.lit("employees").alias("field_name"), heads.alias("value"))))
    needed = companies.select("company_key", "row_id", "source_dataset_id", "homepage", "employees", "registered_on", "collected_on")
    rows = needed.join(ranks, F.col("source_dataset_id") == F.col("_source"), "left").select("company_key", "row_id", trust.alias("trust"), fields.alias("f"))
    rows = rows.select(F.col("company_key").alias("group_key"), "row_id", "trust", "f.*").where("value is not null")
    return rows.join(many.withColumnRenamed("company_key", "group_key"), "group_key", "left_semi")


def _best(spark, sf_dir: str, dominance: bool) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return consensus_survivors(field_values(read("companies"), read("registries")), dominance).withColumnRenamed("group_key", "company_key")


def p4_found(spark, sf_dir: str) -> DataFrame:
    return _best(spark, sf_dir, True).select("company_key", "field_name", "row_id")


def p4_consensus(spark, sf_dir: str) -> DataFrame:
    """The value that most rows' tokens agree on, whatever their trust."""
    return _best(spark, sf_dir, False).select("company_key", "field_name", "value", "row_id", "support")


_DATE = """try_cast(CASE
  WHEN regexp_full_match({0}, '[0-9]{{8}}') THEN {0}[1:4] || '-' || {0}[5:6] || '-' || {0}[7:8]
  WHEN regexp_matches({0}, '^[0-9]{{4}}[^0-9]') THEN regexp_replace({0}, '^([0-9]{{4}})[-./년 ]+([0-9]{{1,2}})[-./월 ]+([0-9]{{1,2}}).*$', '\\1-\\2-\\3')
  END AS DATE)"""
P4_SQL = f"""
WITH base AS (
  SELECT c.*, coalesce(r.priority, 99) AS prio, trim(registered_on) AS reg, trim(homepage) AS hp,
         count(*) OVER (PARTITION BY company_key) AS n
  FROM companies c LEFT JOIN registries r USING (source_dataset_id)),
dated AS (SELECT *, {_DATE.format('reg')} AS d0 FROM base WHERE n >= 2),
ranked AS (SELECT *, CASE WHEN d0 <= CAST(collected_on AS DATE) THEN d0 END AS d FROM dated),
vals AS (
  SELECT company_key, row_id, prio, d, 'homepage' AS field_name FROM ranked
  WHERE regexp_matches(regexp_replace(lower(hp), '^(https?://)?(www[.])?', ''), '^[a-z0-9-]+([.][a-z0-9-]+)+([:/].*)?$') AND NOT contains(hp, '@')
  UNION ALL
  SELECT company_key, row_id, prio, d, 'employees' FROM ranked WHERE employees BETWEEN 1 AND 50000)
SELECT company_key, field_name, row_id FROM vals
QUALIFY row_number() OVER (PARTITION BY company_key, field_name ORDER BY prio, d DESC NULLS LAST, row_id) = 1
"""
