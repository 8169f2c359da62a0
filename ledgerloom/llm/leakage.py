"""Evaluation texts leaking into training text.

A *run* is a stretch of an item's words that stands in a text: its first and its
last word stand there unchanged; at most one word in WORDS_PER_ERROR of it is
changed, replaced, lost or interrupted, and towards either end never more words
than stand unchanged there; and Myers' bit-parallel edit distance between its
letters and the text's is at most CHANGED of them. A document is a
case if one run, or two that follow each other in item and text, cover half of
the item's words.

Pigeonhole: the longer of the runs has at least a quarter of the words, and an
error budget by its length. The item is cut into pieces so short that any such
run holds budget + 1 of them, so one of them is unchanged. All pieces are
searched at once; every hit is grown word by word to the run it belongs to, and
each run verified. The other run may hold no piece; it is searched for only
where the first one leaves less than its share missing.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import settled
from .spread import spread

#: Words of a run of which one may be changed.
WORDS_PER_ERROR = 8
#: An item's words are covered if this share of them stands in the runs.
SHARE = 0.5
#: Share of a run's letters that may differ.
CHANGED = 0.3
#: Letters by which changed words may be longer than the text's, beside being doubled or lost.
SLACK = 6
#: Letters of all items up to which they are broadcast and searched by one automaton; more are joined by their pieces.
MOST_BROADCAST = 4_000_000
#: Letters of a piece by which the join finds it; and bits of the table that drops places no piece starts at, of a fixed size.
PROBE, FILTER_BITS = 8, 1 << 24


@lru_cache(maxsize=1)
def _patterns():
    import regex

    return regex.compile(r"\p{M}+"), regex.compile(r"[^\p{L}\p{N}]+")


def folded(text: str) -> str:
    """The text without marks, in one width and case; spaces and punctuation stay."""
    if text.isascii():
        return text.lower()
    marks, _ = _patterns()
    return unicodedata.normalize("NFC", marks.sub("", unicodedata.normalize("NFKD", text))).casefold()


def letters(text: str) -> str:
    """Only the letters and digits of a text, in one width and case."""
    return _patterns()[1].sub("", folded(text))


def words(text: str) -> list[str]:
    return [w for w in (_patterns()[1].sub("", x) for x in folded(text).split()) if w]


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance by Myers' bit vectors; Python's integers hold any length."""
    if not a or not b:
        return len(a) + len(b)
    masks: dict[str, int] = defaultdict(int)
    for i, ch in enumerate(a):
        masks[ch] |= 1 << i
    full, high = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score = full, 0, len(a)
    for ch in b:
        eq = masks.get(ch, 0)
        vertical = eq | minus
        eq |= ((eq & plus) + plus) ^ plus
        up, down = minus | ~(eq | plus) & full, plus & eq
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1 | 1) & full, down << 1 & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
    return score


def budget(n: int) -> int:
    """Changed words a run of n words may hold."""
    return (n + WORDS_PER_ERROR // 2) // WORDS_PER_ERROR


def needed(n: int) -> int:
    """Words of an item of n that must stand in a document."""
    return max(1, int(np.ceil(n * SHARE)))


@lru_cache(maxsize=4096)
def piece_words(n: int) -> int:
    """Words of a piece such that any run of at least half of what is needed holds budget + 1 whole ones."""
    return max(1, min((m + 1) // (budget(m) + 2) for m in range(-(-needed(n) // 2), n + 1)))


def pieces(item: list[str]) -> list[tuple[int, str]]:
    """(number of its first word, letters) of an item's pieces; they don't overlap."""
    w = piece_words(len(item))
    return [(k, "".join(item[k : k + w])) for k in range(0, len(item) - w + 1, w)]


class Text:
    """A text's letters, and where its words begin and end."""

    def __init__(self, text: str):
        self.parts = [p for p in _patterns()[1].split(folded(text)) if p]
        self.s = "".join(self.parts)
        self._back: str | None = None
        self._edges: set[int] | None = None

    def back(self) -> str:
        self._back = self.s[::-1] if self._back is None else self._back
        return self._back

    def is_word(self, start: int, end: int) -> bool:
        """Do these letters stand as a word (or words) of their own?"""
        if self._edges is None:
            self._edges = {0}
            at = 0
            for p in self.parts:
                at += len(p)
                self._edges.add(at)
        return start in self._edges and end in self._edges


class Item:
    """An item's words, in both directions."""

    def __init__(self, item: list[str]):
        self.words, self.n = item, len(item)
        self.back = [w[::-1] for w in reversed(item)]
        self.need = needed(self.n)

    def covered(self, text: Text, hits: list[tuple[int, int]]) -> bool:
        """Do one or two runs cover half of the words? ``hits``: (place in the text, first word) of unchanged pieces."""
        known: set[tuple[int, int]] = set()
        runs = []
        for p, k in hits:
            if (k, p) not in known:
                runs += self._runs(text, k, p, known)
        longest = max((r[-1][0] - r[0][0] + 1 for r in runs), default=0)
        if longest >= self.need:
            return True
        if 2 * longest < self.need:
            return False
        return any(self._both(text.s, a, b) >= self.need for a in runs for b in runs if a is not b) or self._completed(text, runs, known)

    def _runs(self, text: Text, k: int, p: int, known: set) -> list[list[tuple[int, int]]]:
        """The verified runs around word k at p, as lists of (unchanged word, place)."""
        s = text.s
        ahead = _grown(self.words, s, k, p)
        start = len(s) - p - len(self.words[k])
        behind = [(self.n - 1 - j, len(s) - at - len(self.back[j])) for j, at in _grown(self.back, text.back(), self.n - 1 - k, start)]
        seen = behind[:0:-1] + ahead
        known.add((k, p))
        out = []
        for run in self._parts(seen, s):
            _, low, high = self._span(run)
            if run[-1][0] > run[0][0] or text.is_word(low, high):
                out.append(run)
                known.update(run)
        return out

    def _span(self, run: list[tuple[int, int]]) -> tuple[str, int, int]:
        """The letters of a run's words, and where it starts and ends in the text."""
        a, b = run[0][0], run[-1][0]
        return "".join(self.words[a : b + 1]), run[0][1], run[-1][1] + len(self.words[b])

    def _gaps(self, run: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(index before it, letters of text in it, changed words) of each interruption of a run."""
        out = []
        for i, ((k, p), (j, q)) in enumerate(zip(run, run[1:], strict=False)):
            between = q - p - len(self.words[k])
            if j > k + 1 or between:
                out.append((i, between, max(1, j - k - 1)))
        return out

    def _parts(self, run: list[tuple[int, int]], s: str) -> list[list[tuple[int, int]]]:
        """The longest parts of unchanged words in a row that keep to the budget of their length, none within another.

        Towards neither end may there be more changed than unchanged words; the edit distance verifies each.
        """
        gaps = self._gaps(run)
        if not gaps:
            return [run]
        # Only whole stretches between interruptions matter: a part that ends within one lies within another part.
        firsts, lasts = [0, *(g[0] + 1 for g in gaps)], [*(g[0] for g in gaps), len(run) - 1]
        out, reached = [], -1
        for x, i in enumerate(firsts):
            for y in range(len(lasts) - 1, max(x, reached + 1) - 1, -1):
                j, inside = lasts[y], gaps[x:y]
                n = run[j][0] - run[i][0] + 1
                if sum(g[2] for g in inside) <= budget(n) and _balanced([(g[0] + 1 - i, g[2]) for g in inside]) and _balanced([(j - g[0], g[2]) for g in reversed(inside)]) and self._close(run[i : j + 1], s):
                    out.append(run[i : j + 1])
                    reached = y
                    break
        return out

    def _close(self, run: list[tuple[int, int]], s: str) -> bool:
        own, low, high = self._span(run)
        return edit_distance(own, s[low:high]) <= CHANGED * len(own)

    def _both(self, s: str, a: list[tuple[int, int]], b: list[tuple[int, int]]) -> int:
        """Words that run a and then run b cover; where they overlap, one of them is shortened."""
        span = lambda r: r[-1][0] - r[0][0] + 1
        most = lambda r: max(map(span, self._parts(r, s)), default=0) if r else 0
        _, low, _ = self._span(b)
        _, _, high = self._span(a)
        first = [x for x in a if x[0] < b[0][0] and x[1] + len(self.words[x[0]]) <= low]
        then = [x for x in b if x[0] > a[-1][0] and x[1] >= high]
        return max(most(first) + span(b) if first else 0, span(a) + most(then) if then else 0)

    def _completed(self, text: Text, runs: list, known: set) -> bool:
        """Is there a second run, without a piece, that completes one of the runs?"""
        s = text.s
        for run in runs:
            a, b, (_, low, high) = run[0][0], run[-1][0] + 1, self._span(run)
            missing = self.need - (b - a)
            if 2 * (b - a) < self.need:
                continue
            # Any run of several words within its budget holds two neighbouring ones unchanged.
            m = min(missing, 2)
            for first, last, start, end in ((b, self.n, high, len(s)), (0, a, 0, low)):
                if last - first < missing or end <= start:
                    continue
                for k in range(first, last - m + 1):
                    piece = "".join(self.words[k : k + m])
                    p = s.find(piece, start, end)
                    while p >= 0:
                        if (k, p) not in known:
                            for other in self._runs(text, k, p, known):
                                if max(self._both(s, run, other), self._both(s, other, run)) >= self.need:
                                    return True
                        p = s.find(piece, p + 1, end)
        return False


def _grown(item: list[str], s: str, k: int, p: int) -> list[tuple[int, int]]:
    """Word k at p and the unchanged words that follow it in item and text, over changed ones: (word, place)."""
    seen = []
    n = len(item)
    most = budget(n)
    while k < n:
        w = item[k]
        if s.startswith(w, p):
            seen.append((k, p))
            p += len(w)
            k += 1
            continue
        k, p = _resumed(item, s, k, p, most)
        if k < 0:
            break
    return seen


def _balanced(gaps: list[tuple[int, int]]) -> bool:
    """Do never more changed than unchanged words stand between an end of a run and one of its gaps? (unchanged before it, changed in it)"""
    changed = 0
    for before, in_it in gaps:
        changed += in_it
        if changed > before:
            return False
    return True


def _resumed(item: list[str], s: str, k: int, p: int, most: int) -> tuple[int, int]:
    """(word, place) where the item goes on in the text after as few changed words as possible, or (-1, -1)."""
    skipped = 0
    for j in range(k, min(len(item), k + most + 1)):
        w, after = item[j], item[j + 1] if j + 1 < len(item) else ""
        low, high = p + (j == k), p + 2 * skipped + SLACK
        best = -1
        # A word of one letter, or two by chance, is no evidence: the next one must follow unless the item ends.
        probe = w + after if len(w) < 3 else w
        at = s.find(probe, low, high + len(probe))
        while at >= 0:
            if best < 0 or abs(at - p - skipped) < abs(best - p - skipped):
                best = at
            at = s.find(probe, at + 1, high + len(probe))
        if best >= 0:
            return j, best
        skipped += len(w)
    return -1, -1


class Items:
    """The items' pieces in one automaton."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        split = {i: w for i, t in items if (w := words(t or ""))}
        self.items = {i: Item(w) for i, w in split.items()}
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, w in split.items():
            for k, piece in pieces(w):
                where[piece].append((i, k))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def found(self, text: str) -> list[int]:
        """The items that a text holds."""
        if self.empty:
            return []
        t = Text(text)
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for end, (length, places) in self.automaton.iter(t.s):
            for item, k in places:
                hits[item].append((end - length + 1, k))
        return [i for i, h in hits.items() if self.items[i].covered(t, h)]


_built: dict[str, Items] = {}


def _automaton(name: str, rows: list[tuple]) -> Items:
    """The automaton of one call, built once per Python worker."""
    if name not in _built:
        _built.clear()
        _built[name] = Items(rows)
    return _built[name]


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(doc_id, item_id) of each document that holds at least half of an item's words in order, in one or two runs.

    Case, width, spacing, line breaks, marks and punctuation don't count; a few
    words may be changed (``budget``). A run of one word must stand as a word.
    NULL and empty texts hold nothing, items without a letter or digit are
    nowhere; repeated rows give one result. Whole documents are searched, in one
    pass. Items of up to ``most_broadcast`` letters are broadcast; more are
    joined by their pieces, with the same result.
    """
    texts = spread(docs.select(id_col, text_col))
    held = items.select("item_id", F.col("text").alias("_text")).where("_text is not null")
    size = held.agg(F.coalesce(F.sum(F.length("_text")), F.lit(0))).first()[0]
    return (_searched if size <= most_broadcast else _joined)(texts, held, id_col).distinct()


def _searched(texts: DataFrame, items: DataFrame, id_col: str) -> DataFrame:
    """All items against all texts by one automaton."""
    rows = texts.sparkSession.sparkContext.broadcast([tuple(r) for r in items.collect()])
    name, item_type = uuid.uuid4().hex, to_arrow_type(items.schema["item_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _automaton(name, rows.value)
        for batch in batches:
            which, found = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                for i in known.found(text) if text else ():
                    which.append(k)
                    found.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int64())), pa.array(found, item_type)], names=[id_col, "item_id"])

    return texts.mapInArrow(run, _schema(texts, id_col, items))


def _schema(texts: DataFrame, id_col: str, items: DataFrame) -> str:
    return f"`{id_col}` {texts.schema[id_col].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}"


def _probes(s: str, lengths: list[int]) -> np.ndarray:
    """Hashes of a text's stretches of each length, wherever they start."""
    codes = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, total, power = [], np.zeros(len(codes) + 1, np.uint64), np.uint64(1)
    for n in range(1, min(PROBE, len(codes)) + 1):
        total = total[: len(codes) - n + 1] + codes[n - 1 :] * power
        power = power * np.uint64(0x9E3779B97F4A7C15)
        if n in lengths:
            mixed = (total + np.uint64(n)) * np.uint64(0xFF51AFD7ED558CCD)
            out.append((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53))
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


@lru_cache(maxsize=4096)
def _item(text: str) -> tuple[Item, list[tuple[int, str]]]:
    w = words(text)
    return Item(w), pieces(w)


def _places(s: str, piece: str) -> Iterator[int]:
    p = s.find(piece)
    while p >= 0:
        yield p
        p = s.find(piece, p + 1)


def _joined(texts: DataFrame, items: DataFrame, id_col: str) -> DataFrame:
    """The same by a join: texts and items meet by the first letters of pieces, then each pair is verified.

    What is broadcast is a table of FILTER_BITS bits, whatever the number of items.
    """
    spark = texts.sparkSession
    item_kind, id_kind = items.schema["item_id"].dataType.simpleString(), texts.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, length, probe = [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                for start in {p[:PROBE] for _, p in pieces(w)} if (w := words(text)) else ():
                    which.append(k)
                    length.append(len(start))
                    probe.append(int(_probes(start, [len(start)])[0]))
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(which, pa.int64())).columns, pa.array(length, pa.int32()), pa.array(probe, pa.int64())], names=["item_id", "_text", "length", "probe"])

    known = settled(items.mapInArrow(cut, f"item_id {item_kind}, _text string, length int, probe bigint"))
    cells = known.select("length", F.pmod("probe", F.lit(FILTER_BITS)).cast("int").alias("cell")).distinct().toArrow()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    at = cells.column("cell").to_numpy()
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    table, lengths = spark.sparkContext.broadcast(bits), sorted(set(cells.column("length").to_pylist()))

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = table.value
        for batch in batches:
            keep, found = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                probes = np.unique(_probes(letters(text), lengths)) if text else np.empty(0, np.int64)
                cell = probes & (FILTER_BITS - 1)
                probes = probes[b[cell >> 3] >> (cell & 7) & 1 > 0]
                if len(probes):
                    keep.append(k)
                    found.append(probes)
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(keep, pa.int64())).columns, pa.array(found, pa.list_(pa.int64()))], names=[id_col, "_body", "probes"])

    # Only texts with a place where a piece may start; equal rows are one.
    near = settled(texts.toDF(id_col, "_body").mapInArrow(starts, f"`{id_col}` {id_kind}, _body string, probes array<bigint>").withColumn("_uid", F.xxhash64(id_col, "_body")).dropDuplicates(["_uid"]))
    pairs = near.select("_uid", F.explode("probes").alias("probe")).join(known.select("item_id", "probe"), "probe").select("_uid", "item_id").distinct()
    whole = pairs.join(near.select("_uid", id_col, "_body"), "_uid").join(known.select("item_id", "_text").distinct(), "item_id").select(id_col, "_body", "item_id", "_text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k, (body, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                (item, own), t = _item(text), Text(body)
                hits = sorted((p, n) for n, piece in own for p in _places(t.s, piece))
                if hits and item.covered(t, hits):
                    keep.append(k)
            hit = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([hit.column(0), hit.column(2)], names=[id_col, "item_id"])

    return whole.mapInArrow(verify, _schema(texts, id_col, items))


def p9_found(spark, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return leaks(read("documents"), read("eval_items"))
