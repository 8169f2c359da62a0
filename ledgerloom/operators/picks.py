"""The best addresses of each company, with different domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import contact


def best_picks(emails: DataFrame, max_picks: int = C.MAX_PICKS, strict_flagged: bool = False, lists: contact.Lists = contact.DEFAULT) -> DataFrame:
    """At most ``max_picks`` collected addresses per company by score, none of a domain already picked unless it is free mail.

    Input: company_key, email, source_url, method, status, seq, optionally
    flagged. Adds score and rank. Ties go to the lower seq. Scores of -100 and
    less are left out; ``strict_flagged`` leaves out every flagged address.

    A domain's best address stands before its others, so picking greedily is the
    same as keeping each domain's first and then the company's first: two window
    filters, both pruned before the shuffle.
    """
    flagged = "flagged" if "flagged" in emails.columns else None
    score = contact.score_email("email", "source_url", "method", flagged, lists)
    rows = emails.where("status = 'collected' and email != ''").withColumn("score", score).where(f"score > {C.SCORE_FLAGGED}")
    if strict_flagged:
        marked = F.coalesce("method", F.lit("")).contains(C.FLAG_MARK)
        rows = rows.where(~(marked | F.coalesce(F.col(flagged), F.lit(False)) if flagged else marked))
    domain = contact.domain_part(F.lower("email"))
    free = domain.isin(lists.free_mail or [""])
    # Free-mail addresses don't crowd each other out: each is a domain of its own.
    group = F.when(free, F.concat(F.lit("#"), F.col("seq").cast("string"))).otherwise(domain)
    order = [F.desc("score"), F.asc("seq")]
    rows = rows.withColumn("_domain", group)
    first = rows.withColumn("_n", F.row_number().over(W.partitionBy("company_key", "_domain").orderBy(*order))).where("_n = 1")
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("company_key").orderBy(*order)))
    return ranked.where(F.col("rank") <= max_picks).drop("_domain", "_n")
