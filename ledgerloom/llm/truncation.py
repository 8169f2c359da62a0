"""Text cut off by field limits or during transfer, and how often each source cuts.

Two kinds of evidence are added as log-odds:

* Lengths. Per source and unit (characters, UTF-8 bytes) a log-normal length
  distribution is fitted by maximum likelihood with the texts at a candidate
  limit right-censored. Every limit that gains enough likelihood over an
  uncensored fit is kept: a source may have one in characters and one in bytes,
  or have changed it. A text's posterior of being censored at a limit is the
  share of the texts at that length that the fitted density doesn't explain.
* Endings. Counts over the whole corpus say which words start sentences and
  which end them, and which fragments close texts (signatures, labels,
  addresses, links). An unfinished sentence is the beginning of sentences that
  go on elsewhere; a closing line isn't.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled
from ..session import settled
from .spread import for_counting, spread

#: Cells of each count table; their number doesn't grow with the corpus (10 x 8 MB as they are counted, 10 x 4 MB as they are used).
CELLS = 1 << 20
STARTS, OPEN_STARTS, ENDS, INNER, OPEN_ENDS, LOOSE, PHRASE_ENDS, PHRASE_ENDS_AGAIN, START_PIECES, INNER_PIECES = range(10)
TABLES = 10
#: Word tables share cells, so that a cell compares a word's roles; phrases are counted under two hashes.
_SEED = {PHRASE_ENDS: 1, PHRASE_ENDS_AGAIN: 2}
#: Words of a phrase: what ends a sentence depends on a little context.
PHRASE = 3
#: Letters of a word's beginnings that are counted: a cut word is one of them.
LONGEST_PIECE = 16
#: Texts may be shorter than the limit by this much, where blanks or half a character at the cut were dropped.
SLACK = {"chars": 2, "bytes": 4}
#: A limit holds at least this many texts, gains this much log-likelihood, and cuts at least this share of the source's texts that are longer.
LEAST_AT_LIMIT, LEAST_GAIN, LEAST_CUT = 5, 12.0, 0.05
#: Sources with a limit up to which their limits are broadcast (some 50 bytes each).
MOST_BROADCAST = 20_000
#: Log-odds of a text of a source without a limit, of one that stays below its source's limit, and bounds of what one kind of evidence may say.
PRIOR, PRIOR_BELOW_LIMIT, BOUND = -0.7, -2.5, 5.0

_MARKER = re.compile(r"(?:\s*(?:…|\.{2,}|\[(?:…|\.{2,})\]|\((?:계속|중략|이하 생략|continued)\)|\[?(?:더\s?보기|자세히 보기|read more)\]?|»))+\s*$", re.I)
_RESIDUE = re.compile(r"(?:�+|&(?:[A-Za-z]{1,7}|#x?[0-9A-Fa-f]*)?|<(?:[A-Za-z/!][^<>]*)?|\\(?:u[0-9A-Fa-f]{0,3}|x[0-9A-Fa-f]?)?|[\ud800-\udfff])$")
_TERMINATED = re.compile(r"[.?!。！？;][\"”’'」』)\]]*$")
_SPLIT = re.compile(r"(?<=[.?!。！？])[\"”’'」』)\]]*\s+|[\r\n  ]+")
_LEFT_OPEN = re.compile(r"\S[,:(]$|\s[\"“‘'(]$")
_ADDRESS = re.compile(r"(?:[\w.+-]+@|https?://|www\.)[\w-]+(?:\.[\w-]+)+\S*$|^(?:\+?\d[\d) .~-]{6,}\d)$")
_PARTIAL_LINK = re.compile(r"(?:@|://|www\.)[\w.-]*\.$")
_STRIP = ".,;:?!\"'“”‘’()[]<>「」『』。！？…"


def _unmarked(text: str) -> str:
    """The text without marks of a cut at its end; its last letters tell, unless the marks, of up to 16 letters each, may begin before them."""
    tail = text[-64:]
    m = _MARKER.search(tail)
    if m is None:
        return text
    return text[: len(text) - len(tail) + m.start()] if m.start() > 16 else _MARKER.sub("", text)


def _word(w: str) -> str:
    return w.strip(_STRIP).lower() or w.lower()


def _phrase(words: list[str]) -> str:
    return re.sub(r"\d+", "0", " ".join(words[-PHRASE:]))


def _parts(text: str) -> list[str]:
    return [p for p in (x.strip() for x in _SPLIT.split(text)) if p]


def _count(text: str, tables: list[Counter]) -> None:
    parts = _parts(text)
    for n, part in enumerate(parts):
        words = [_word(w) for w in part.split()]
        if _TERMINATED.search(part) and not part.endswith("..") or n < len(parts) - 1 and not _open(part):
            tables[STARTS][words[0]] += 1
            tables[ENDS][words[-1]] += 1
            tables[INNER].update(words[:-1])
            tables[PHRASE_ENDS][_phrase(words)] += 1
        elif n < len(parts) - 1:
            tables[LOOSE][words[0]] += 1
        else:
            tables[OPEN_STARTS][words[0]] += 1
            tables[OPEN_ENDS][words[-1]] += 1


def _open(part: str) -> bool:
    return not _TERMINATED.search(part)


def ending_counts(texts: DataFrame) -> DataFrame:
    """(cell, n): word counts by role over all texts; each task counts into tables of a fixed size."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TABLES * CELLS, np.int64)
        for batch in batches:
            tables = [Counter() for _ in range(TABLES)]
            for text in batch.column(0).to_pylist():
                if text and text.strip():
                    _count(_unmarked(text.rstrip()), tables)
            for whole, pieces in ((STARTS, START_PIECES), (INNER, INNER_PIECES)):
                for word, n in tables[whole].items():
                    for i in range(1, min(len(word), LONGEST_PIECE + 1)):
                        tables[pieces][word[:i]] += n
            for phrase, n in tables[PHRASE_ENDS].items():
                tables[PHRASE_ENDS_AGAIN][phrase] += n
            for k, table in enumerate(tables):
                for word, n in table.items():
                    total[k * CELLS + xxhash.xxh64_intdigest(word, _SEED.get(k, 0)) % CELLS] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["cell", "n"])

    return for_counting(texts).mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


class Endings:
    """How likely an ending is cut, from the corpus' counts."""

    def __init__(self, cells: np.ndarray, counts: np.ndarray):
        # Only ratios of counts matter, so seven digits will do; counts of any size fit.
        table = np.zeros(TABLES * CELLS, np.float32)
        table[cells] = counts
        self.tables = table.reshape(TABLES, CELLS)
        sums = self.tables.sum(axis=1, dtype=np.float64)
        # Sentences that are cut, at most: all open ends whose first word also starts finished sentences.
        both = np.minimum(self.tables[OPEN_STARTS], self.tables[STARTS])
        self.rate = max(1e-5, float(both.sum(dtype=np.float64)) / max(1, sums[STARTS]))
        self.inner_rate = self.rate * sums[STARTS] / max(1, sums[INNER] + sums[ENDS])
        self.parts = max(1.0, sums[STARTS] / max(1, sums[OPEN_STARTS]))

    def n(self, table: int, word: str) -> float:
        import xxhash

        return float(self.tables[table][xxhash.xxh64_intdigest(word, _SEED.get(table, 0)) % CELLS])

    def log_odds(self, part: str) -> float:
        """Of an open last part: is it an unfinished sentence rather than a closing line?"""
        words = [_word(w) for w in part.split()]
        first, last = words[0], words[-1]
        finished, inner = self.n(ENDS, last), self.n(INNER, last)
        phrase = _phrase(words)
        # Two independent cells per phrase: the lesser count is the better one.
        if len(words) > PHRASE and min(self.n(PHRASE_ENDS, phrase), self.n(PHRASE_ENDS_AGAIN, phrase)) >= 3:
            return -BOUND  # a whole sentence without its full stop
        if finished >= 3 and finished > 4 * inner and len(words) > 1:
            return -BOUND if len(words) <= PHRASE else -2.0
        started, opened, loose = self.n(STARTS, first), self.n(OPEN_STARTS, first), self.n(LOOSE, first)
        alone = len(words) == 1
        cut = self.rate * (started + (self.n(START_PIECES, first) / 4 if alone else 0)) + 0.02
        closing = max(0.0, opened - 1 - 8 * cut) + loose / self.parts + 0.02
        odds = math.log(cut / closing)
        if alone:
            return max(-BOUND, min(BOUND, odds))
        cut_last = self.inner_rate * (inner + self.n(INNER_PIECES, last) / 4) + 0.02
        closing_last = max(0.0, self.n(OPEN_ENDS, last) - 1 - 3 * cut_last) + 0.02
        at_end = math.log(cut_last / closing_last)
        # A fragment that begins like many sentences isn't made a closing line by how it breaks off.
        odds += max(at_end, -1.0) if odds > 1.5 else at_end
        known = sum(self.n(INNER, w) > 0 for w in words[:-1])
        odds += 0.7 * (known - (len(words) - 1 - known))
        if _ADDRESS.search(words[-1]) and started <= self.n(OPEN_STARTS, first):
            odds -= 4.5
        return max(-BOUND, min(BOUND, odds))


def ending_evidence(text: str, endings: Endings) -> float:
    """Log-odds of having been cut, from how a text ends."""
    body = text.rstrip()
    if _RESIDUE.search(body):
        return 2 * BOUND
    bare = _unmarked(body).rstrip()
    marked = bare != body
    parts = _parts(bare)
    if not parts:
        return -BOUND
    last = parts[-1]
    if _TERMINATED.search(last):
        return BOUND if _PARTIAL_LINK.search(last) and not marked else -2 * BOUND
    if _LEFT_OPEN.search(last):
        return BOUND
    odds = endings.log_odds(last.rstrip(" -"))
    return odds + (1.5 if marked and odds > 0 else 0.0)


def _bare(text_col: str) -> Column:
    return F.regexp_replace(F.col(text_col), r"(?:\s*(?:…|\.{3}))\s*$", "")


def lengths(docs: DataFrame, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(source, unit, length, n): different texts of each length in every source, without what stands for a cut.

    Copies of one text are no sign of a limit, so each counts once: hashes and
    lengths are shuffled, no texts.
    """
    bare = docs.where(filled(text_col)).select(F.col(source_col).alias("source"), _bare(text_col).alias("_bare"))
    texts = bare.select("source", F.xxhash64("_bare").alias("_text"), F.char_length("_bare").alias("chars"), F.octet_length("_bare").alias("bytes")).distinct()
    both = texts.groupBy("source", "chars", "bytes").agg(F.count("*").alias("n"))
    units = F.explode(F.array(*(F.struct(F.lit(u).alias("unit"), F.col(u).alias("length")) for u in SLACK))).alias("u")
    return both.select("source", "n", units).groupBy("source", "u.unit", "u.length").agg(F.sum("n").alias("n"))


def _fit(x: np.ndarray, n: np.ndarray, cens: np.ndarray, limit: float) -> tuple[float, float, float]:
    """(mu, sigma, log-likelihood) of log-lengths, those marked right-censored at the limit; EM."""
    from statistics import NormalDist

    norm = NormalDist()
    total, seen, weight = n.sum(), x[~cens], n[~cens]
    held = n[cens].sum()
    if not len(seen):
        return 0.0, 1.0, -math.inf
    mu = (n * x).sum() / total
    sd = max(1e-3, math.sqrt((n * (x - mu) ** 2).sum() / total))
    for _ in range(100 if held else 1):
        if held:
            z = (limit - mu) / sd
            tail = max(1e-12, 1 - norm.cdf(z))
            up = norm.pdf(z) / tail
            mean, square = mu + sd * up, sd * sd * (1 + z * up) + mu * mu + 2 * mu * sd * up
        else:
            mean = square = 0.0
        new = ((weight * seen).sum() + held * mean) / total
        var = ((weight * seen**2).sum() + held * square) / total - new * new
        moved = abs(new - mu)
        mu, sd = new, max(1e-3, math.sqrt(max(var, 1e-6)))
        if moved < 1e-6:
            break
    z = (seen - mu) / sd
    ll = (weight * (-0.5 * z * z - math.log(sd) - seen)).sum()
    if held:
        ll += held * math.log(max(1e-12, 1 - norm.cdf((limit - mu) / sd)))
    return mu, sd, float(ll)


def _limits(rows: pd.DataFrame) -> pd.DataFrame:
    """The candidate limits of one source, the largest pile first: what a censored fit explains."""
    found = []
    for unit, own in rows.groupby("unit"):
        own = own.sort_values("length")
        size, n = own["length"].to_numpy(), own["n"].to_numpy().astype(float)
        slack, total = SLACK[unit], n.sum()
        sums = np.concatenate([[0.0], np.cumsum(n)])
        within = lambda low, high: sums[np.searchsorted(size, high, "right")] - sums[np.searchsorted(size, low)]  # noqa: B023, E731
        for limit in size[n >= LEAST_AT_LIMIT]:
            pile = within(limit - slack, limit)
            around = (within(0.8 * limit, 1.2 * limit) - pile) / max(1.0, 0.4 * limit - slack - 1) * (slack + 1)
            if pile < max(5 * (around + 0.5), LEAST_CUT * (total - within(0, limit))):
                continue
            near = (size >= limit - slack) & (size <= limit)
            x = np.log(np.where(near, limit, size))
            mu, sd, likely = _fit(x, n, near, math.log(limit))
            gain = likely - _fit(x, n, np.zeros(len(x), bool), math.log(limit))[2]
            dense = total * math.exp(-0.5 * ((math.log(limit) - mu) / sd) ** 2) / (sd * limit * math.sqrt(2 * math.pi)) * (slack + 1)
            if gain >= LEAST_GAIN:
                found.append((pile, unit, int(limit), min(0.995, max(0.05, 1 - max(dense, around) / pile))))
    out = []
    for pile, unit, limit, posterior in sorted(found, reverse=True):
        # One pile is seen at neighbouring lengths, and in both units where texts are ASCII.
        if all(abs(limit - other) > SLACK[unit] + SLACK[kind] for kind, other, _, _ in out):
            out.append((unit, limit, posterior, float(pile)))
    return pd.DataFrame([(rows["source"].iloc[0], k, *x) for k, x in enumerate(out)], columns=["source", "place", "unit", "limit", "posterior", "pile"])


def _there(length: Column, unit: Column, limit: Column) -> Column:
    return length.between(limit - F.when(unit == "bytes", SLACK["bytes"]).otherwise(SLACK["chars"]), limit)


def _own(rows: pd.DataFrame) -> pd.DataFrame:
    """The candidates that aren't explained by larger ones: at least half of their texts lie at none of those."""
    first = rows.iloc[0]
    kept: list[int] = []
    for k in sorted({k for ks in rows["at"] for k in ks}):
        mine = rows[[k in ks for ks in rows["at"]]]
        alone = mine[[not set(kept) & set(ks) for ks in mine["at"]]]
        if 2 * alone["n"].sum() >= mine["n"].sum():
            kept.append(k)
    return pd.DataFrame([(first["source"], k) for k in kept], columns=["source", "place"])


def field_limits(docs: DataFrame, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(source, unit, limit, posterior) of every limit of every source; posterior: of a text at the limit being cut.

    Texts cut to so many characters have like numbers of bytes. So where a source
    has several candidates, a candidate counts only if most of its texts don't
    lie at a larger one too.
    """
    kind = "source string, place int, unit string, limit bigint, posterior double, pile double"
    found = settled(lengths(docs, text_col, source_col).groupBy("source").applyInPandas(_limits, kind))
    several = found.groupBy("source").agg(F.collect_list(F.struct("place", "unit", "limit")).alias("candidates")).where("size(candidates) > 1")
    out = ["source", "unit", "limit", "posterior"]
    if several.isEmpty():
        return found.select(*out)
    bare = _bare(text_col)
    texts = docs.where(filled(text_col)).select(F.col(source_col).alias("_source"), F.char_length(bare).alias("chars"), F.octet_length(bare).alias("bytes"))
    texts = texts.join(several, F.col("_source").eqNullSafe(F.col("source")))
    at = F.transform(F.filter("candidates", lambda c: _there(F.when(c["unit"] == "bytes", F.col("bytes")).otherwise(F.col("chars")), c["unit"], c["limit"])), lambda c: c["place"])
    counted = texts.select("source", F.array_sort(at).alias("at")).where("size(at) > 0").groupBy("source", "at").agg(F.count("*").alias("n"))
    own = counted.groupBy("source").applyInPandas(_own, "source string, place int").alias("o")
    f, alone = found.alias("f"), found.where("place = 0").alias("a").select(F.col("a.source").alias("source"), "place")
    kept = own.select("source", "place").unionByName(alone).distinct().alias("o")
    return f.join(kept, F.col("f.source").eqNullSafe(F.col("o.source")) & (F.col("f.place") == F.col("o.place"))).select(*(f"f.{c}" for c in out))


def _at(text: str, limits: list[dict]) -> float | None:
    """The greatest posterior of the limits that a text lies at."""
    bare = _unmarked(text)
    size = {"chars": len(bare), "bytes": len(bare.encode("utf-8", "surrogatepass"))}
    return max((x["posterior"] for x in limits if x["limit"] - SLACK[x["unit"]] <= size[x["unit"]] <= x["limit"] + (2 if x["unit"] == "bytes" else 0)), default=None)


def truncated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, at_limit, probability) of every text that was cut.

    NULL, empty and blank texts were not cut. A text is cut from a probability of
    one half. Counts are over all texts and collected as tables of fixed size;
    the limits are a short list per source. Repeated rows come out again.
    """
    sc = docs.sparkSession.sparkContext
    source = spread(docs.select(id_col, source_col, text_col))
    counts = ending_counts(source.select(text_col)).toArrow()
    endings = sc.broadcast(Endings(counts.column("cell").to_numpy(), counts.column("n").to_numpy()))
    limits = settled(field_limits(source, text_col, source_col).groupBy(F.col("source").alias("_source")).agg(F.collect_list(F.struct("unit", "limit", "posterior")).alias("limits")))
    # One row per source with a limit: usually few, but only broadcast if they are.
    limits = F.broadcast(limits) if limits.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else limits
    rows = source.join(limits, F.col(source_col).eqNullSafe(F.col("_source")), "left").drop("_source")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = endings.value
        for batch in batches:
            texts, limits = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep, at_limit, chance = [], [], []
            for k, text in enumerate(texts):
                if not text or not text.strip():
                    continue
                there = _at(text, limits[k]) if limits[k] else None
                by_length = math.log(there / (1 - there)) if there else PRIOR if not limits[k] else PRIOR_BELOW_LIMIT
                odds = by_length + ending_evidence(text, model)
                if odds > 0:
                    keep.append(k)
                    at_limit.append(there is not None)
                    chance.append(1 / (1 + math.exp(-odds)))
            hit = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([hit.column(0), hit.column(1), pa.array(at_limit, pa.bool_()), pa.array(chance, pa.float64())], names=[id_col, "source", "at_limit", "probability"])

    kind = source.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, source string, at_limit boolean, probability double")


def cut_rates(docs: DataFrame) -> DataFrame:
    """(source, texts, cut, cut_share): how often each source cuts, of its texts that aren't blank."""
    all_texts = docs.where(filled("text")).groupBy("source").agg(F.count("*").alias("texts"))
    cut = truncated(docs).groupBy("source").agg(F.count("*").alias("cut"))
    a, b = all_texts.alias("a"), cut.alias("b")
    n = F.coalesce("b.cut", F.lit(0))
    return a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")), "left").select("a.source", "texts", n.alias("cut"), (n / F.col("texts")).alias("cut_share"))


def p10_found(spark, sf_dir: str) -> DataFrame:
    return truncated(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id").distinct()


def p10_rates(spark, sf_dir: str) -> DataFrame:
    return cut_rates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
