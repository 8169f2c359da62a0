"""Text that was decoded with the wrong character encoding: finding and restoring it.

1. Count adjacent character pairs over the whole corpus. The pairs of values
   written in the corpus's own scripts are the model; the characters of all
   values are what the model is held against. The mutual information
   log(pairs in the model / pairs expected from the characters of all values)
   is about 0 for ordinary pairs and far below for pairs that only garbling
   brings together.
2. In each value, the runs whose summed shortfall is greatest are isolated
   (maximum-scoring segments).
3. Only there, the inverse of each common mistake is tried, also twice. A run is
   garbled if an inverse turns it into characters the model knows, or if it
   holds what no writer types: replacement, private or control characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import for_counting, spread

#: Cells of the pair table: its size doesn't grow with the corpus (4 MB).
CELLS = 1 << 20
#: Share of own-script characters from which a value is part of the model.
TRUSTED = 0.8
#: Pseudo-observations of a pair, spread as its character classes suggest.
PRIOR = 5.0
#: Summed shortfall (nats) from which a run is tried, and what each pair may fall short of.
SUSPECT, TOLERANCE = 1.0, 0.7
#: Share of a restored run's characters that the model must know.
KNOWN = 0.9

#: The mistakes: (wrong decoder, right decoder) as Python names.
MISTAKES = [
    ("cp1252", "utf-8"), ("cp1252", "cp949"), ("mac_roman", "cp949"), ("mac_roman", "utf-8"), ("gb18030", "cp949"),
    ("cp949", "utf-8"), ("big5", "cp949"), ("shift_jis", "cp949"), ("euc_jp", "cp949"), ("gb18030", "utf-8"),
    ("shift_jis", "utf-8"), ("cp437", "cp949"), ("cp437", "utf-8"), ("cp1251", "cp949"), ("koi8_r", "cp949"),
]

_HANGUL, _LETTER, _DIGIT, _MARK, _SPACE, _LATIN1, _LATIN, _HAN, _KANA, _FORM, _BROKEN, _REST = range(12)
CLASSES = 12


def _class_table() -> np.ndarray:
    t = np.full(0x10000, _REST, np.uint8)
    t[0x21:0x7F] = _MARK
    t[0x30:0x3A] = _DIGIT
    t[0x41:0x5B] = t[0x61:0x7B] = _LETTER
    t[0:0x21] = _SPACE
    t[[0x3000, 0x2002, 0x2003, 0x2009]] = _SPACE
    t[0x80:0xA0] = _BROKEN
    t[0xA0:0x100] = _LATIN1
    t[0x100:0x370] = _LATIN
    t[0x3040:0x3100] = _KANA
    t[0x3130:0x3190] = t[0xAC00:0xD7A4] = t[0x1100:0x1200] = _HANGUL
    t[0x3200:0x3300] = t[0xFF00:0xFFEF] = _FORM
    t[0x3400:0xA000] = t[0xF900:0xFB00] = _HAN
    t[0xE000:0xF900] = t[0xFFFD] = _BROKEN
    return t


CLASS = _class_table()
OWN = np.isin(np.arange(CLASSES), [_HANGUL, _LETTER, _DIGIT, _MARK, _SPACE, _FORM])


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts in a row (beyond the basic plane folded into it), and where each text starts."""
    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return (joined & 0xFFFF).astype(np.int64), starts


def _cells(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * 1_000_003 + b * 7_919) & (CELLS - 1)


#: Where the parts of the counted table start: pairs, characters, trusted characters, class pairs of trusted and of all values; and its end.
PARTS = (0, CELLS, CELLS + 0x10000, CELLS + 0x20000, CELLS + 0x20000 + CLASSES * CLASSES, CELLS + 0x20000 + 2 * CLASSES * CLASSES)


def _values(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields)))
    return df.select(id_col, each.alias("v")).select(id_col, "v.*").where("value != ''")


def pair_counts(values: DataFrame) -> DataFrame:
    """(cell, n): counts of pairs in trusted values, of characters in all and in trusted values, of class pairs; see PARTS.

    Every task counts into tables of a fixed size before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(PARTS[-1], np.int64)
        pairs, chars, trusted_chars, trusted_classes, classes = (table[i:j] for i, j in zip(PARTS, PARTS[1:], strict=False))
        for batch in batches:
            texts = batch.column(0).to_pylist()
            codes, starts = _codes(texts)
            if not len(codes):
                continue
            kinds = CLASS[codes]
            own = np.add.reduceat(OWN[kinds].astype(np.int64), starts[:-1])
            trusted = np.repeat(own >= TRUSTED * np.diff(starts), np.diff(starts))
            inside = np.ones(len(codes) - 1, bool)
            inside[starts[1:-1] - 1] = False
            good = inside & trusted[:-1]
            a, b = codes[:-1][good], codes[1:][good]
            pairs += np.bincount(_cells(a, b), minlength=CELLS)
            chars += np.bincount(codes, minlength=0x10000)
            trusted_chars += np.bincount(codes[trusted], minlength=0x10000)
            both = kinds[:-1].astype(np.int64) * CLASSES + kinds[1:]
            trusted_classes += np.bincount(both[good], minlength=CLASSES * CLASSES)
            classes += np.bincount(both[inside], minlength=CLASSES * CLASSES)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(table[at])], names=["cell", "n"])

    return for_counting(spread(values.select("value"))).mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


class Model:
    """Mutual information of adjacent characters, and which characters the corpus knows."""

    def __init__(self, cells: np.ndarray, counts: np.ndarray):
        table = np.zeros(PARTS[-1])
        table[cells] = counts
        self.pairs, self.chars, trusted, trusted_classes, classes = (table[i:j].astype(np.float32) for i, j in zip(PARTS, PARTS[1:], strict=False))
        self.total = max(1.0, float(self.chars.sum(dtype=np.float64)))
        self.ratio = ((trusted_classes + 0.5) / (classes + 0.5)).clip(1e-3, 1).reshape(CLASSES, CLASSES)
        self.known, self.seen = trusted > 0, self.chars > 0
        self.trusted = trusted

    def shortfall(self, codes: np.ndarray) -> np.ndarray:
        """-log(model / expected) of each adjacent pair, less the tolerance."""
        a, b = codes[:-1], codes[1:]
        expected = self.chars[a] * self.chars[b] / self.total
        seen = self.pairs[_cells(a, b)]
        return np.log((expected + PRIOR) / (seen + PRIOR * self.ratio[CLASS[a], CLASS[b]])) - TOLERANCE


def heaviest(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """The maximum-scoring segments of weights, left to right, as (first, last + 1, sum): all maximal ones of Ruzzo and Tompa.

    Each weight above 0 starts a candidate, which joins earlier ones while that
    makes a heavier segment. Candidates wait in a list ordered by what was summed
    before them, so joining looks back only over those it swallows.
    """
    waiting: list[tuple[int, int, float, float]] = []  # first, last + 1, sum before it, sum to its end
    total = 0.0
    for i, w in enumerate(weights):
        before, total = total, total + w
        if w <= 0:
            continue
        first, low = i, before
        while True:
            # The nearest candidate that starts lower than this one; those between can't join with it.
            k = len(waiting) - 1
            while k >= 0 and waiting[k][2] >= low:
                k -= 1
            if k < 0 or waiting[k][3] >= total:
                break
            first, low = waiting[k][0], waiting[k][2]
            del waiting[k:]
        waiting.append((first, i + 1, low, total))
    return [(a, b, float(high - low)) for a, b, low, high in waiting]


def _encode(s: str, name: str) -> bytes | None:
    """The bytes a wrong decoder made ``s`` of; undefined bytes of the Western page went through as they were."""
    try:
        return s.encode(name)
    except UnicodeEncodeError:
        if name != "cp1252":
            return None
    out = bytearray()
    for ch in s:
        try:
            out += ch.encode(name)
        except UnicodeEncodeError:
            if ord(ch) > 0xFF:
                return None
            out.append(ord(ch))
    return bytes(out)


def _decode(raw: bytes, name: str) -> str | None:
    """Decoded text; a character cut off at either end is dropped, anything else broken is no text."""
    try:
        return raw.decode(name)
    except UnicodeDecodeError as e:
        if e.start >= len(raw) - 3 and e.start > 2:
            try:
                return raw[: e.start].decode(name)
            except UnicodeDecodeError:
                return None
    return None


def _plausible(s: str, model: Model) -> bool:
    """Mostly syllables that the model knows; the rest own script, or a minority of foreign letters seen elsewhere."""
    syllables = [ord(c) for c in s if "가" <= c <= "힣"]
    foreign = [ord(c) & 0xFFFF for c in s if not OWN[CLASS[ord(c) & 0xFFFF]]]
    if CLASS[foreign].tolist().count(_BROKEN) or 2 * len(foreign) > len(syllables) or not all(model.seen[foreign]):
        return False
    return bool(syllables) and sum(bool(model.known[c]) for c in syllables) >= KNOWN * len(syllables)


def _certain(text: str, wrong: str, right: str) -> bool:
    """Letters of any script out of at least three UTF-8 sequences: no accident in single-byte text."""
    odd = [c for c in text if not c.isascii()]
    return right == "utf-8" and wrong in ("cp1252", "mac_roman") and len(odd) >= 3 and all(c.isalpha() and ord(c) > 0xFF for c in odd)


#: Letters of European languages with their marks, which UTF-8 writes in two bytes.
_ACCENTED = re.compile(r"[\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f\u0218-\u021b]")


def _accented(text: str, word: str, wrong: str, right: str) -> bool:
    """Latin letters with marks out of two-byte UTF-8 sequences, within a word of Latin letters or several of them: no accident either."""
    odd = [c for c in text if not c.isascii()]
    if right != "utf-8" or wrong not in ("cp1252", "mac_roman", "cp437") or not odd or not all(_ACCENTED.fullmatch(c) for c in odd):
        return False
    return sum(c.isascii() and c.isalpha() for c in word) >= 2 or len(odd) >= 2


def restored(run: str, model: Model) -> str | None:
    """The run with one or two mistakes undone, if that makes plausible text."""
    tried = {run}
    layer = [run]
    for _ in range(2):
        found = []
        for s in layer:
            for wrong, right in MISTAKES:
                raw = _encode(s, wrong)
                t = _decode(raw, right) if raw is not None else None
                if t is None or t in tried:
                    continue
                tried.add(t)
                if _plausible(t, model) or _certain(t, wrong, right) or _accented(t, run, wrong, right):
                    return t
                found.append(t)
        layer = found
    return None


#: Bytes that may lead a character of own script in UTF-8, and partial texts kept while lost bytes are guessed.
_LEADS, _BEAM = (0xEA, 0xEB, 0xEC, 0xED, 0xE3, 0xEF), 12


def regrown(word: str, model: Model) -> str | None:
    """UTF-8 read as the Korean code page, with single bytes lost: the likeliest text, or None.

    Each replacement character stands for one byte. Every character that fits the
    bytes left and that the model knows is a candidate; the best row of
    characters by the model's pairs wins.
    """
    raw: list[int | None] = []
    for ch in word:
        if ch == "\ufffd":
            raw.append(None)
            continue
        try:
            raw += ch.encode("cp949")
        except UnicodeEncodeError:
            return None
    if 2 * raw.count(None) > len(raw):
        return None
    beams = [(0.0, 0, "")]
    done: list[tuple[float, str]] = []
    while beams:
        grown = []
        for score, i, text in beams:
            if i == len(raw):
                done.append((score, text))
                continue
            options = [chr(raw[i])] if raw[i] is not None and raw[i] < 0x80 else _fitting(raw[i : i + 3], model)
            for c in options:
                a, b = ord(text[-1]) if text else 0x20, ord(c)
                pair = float(model.pairs[_cells(np.int64(a), np.int64(b))])
                odds = np.log((pair + 1e-3 * model.trusted[b] / 100 + 1e-6) / (model.trusted[a] + 1))
                grown.append((score + odds, i + (1 if ord(c) < 0x80 else 3), text + c))
        beams = sorted(grown, reverse=True)[:_BEAM]
    good = [(s, t) for s, t in done if _plausible(t, model)]
    return max(good)[1] if good else None


def _fitting(raw: list[int | None], model: Model) -> list[str]:
    """Known characters whose three bytes agree with those left."""
    if len(raw) < 3:
        return []
    rest = range(0x80, 0xC0)
    out = []
    for a in _LEADS if raw[0] is None else (raw[0],):
        for b in rest if raw[1] is None else (raw[1],):
            for c in rest if raw[2] is None else (raw[2],):
                n = (a & 0xF) << 12 | (b & 0x3F) << 6 | (c & 0x3F)
                if a & 0xF0 == 0xE0 and b & 0xC0 == c & 0xC0 == 0x80 and model.known[n] and OWN[CLASS[n]]:
                    out.append(chr(n))
    return out


_BROKEN_CHARS = re.compile("[�-\x80-\x84\x86-\x9f]")
#: A marked Latin letter's two bytes as the Western pages show them: a pair that no language writes, however rare it is in the corpus.
_TWO_BYTES = re.compile("|".join(f"[{bytes([0xC3, 0xC4, 0xC5]).decode(page)}][{re.escape(bytes(range(0x80, 0xC0)).decode(page, 'ignore'))}]" for page in ("latin_1", "cp1252", "mac_roman", "cp437")))
_TOKEN = re.compile(r"[^\x00-\x20　()\[\],]+")


def examine(text: str, model: Model, weights: np.ndarray | None = None) -> tuple[bool, str | None]:
    """(is garbled, restored text or NULL) of one value."""
    if weights is None:
        codes, _ = _codes([text])
        weights = model.shortfall(codes) if len(codes) > 1 else np.zeros(0)
    runs = [(i, j + 1) for i, j, s in heaviest(weights) if s >= SUSPECT]
    runs += [m.span() for pattern in (_BROKEN_CHARS, _TWO_BYTES) for m in pattern.finditer(text)]
    if not runs:
        return False, None
    # A mistake concerns words; those a run touches are tried, wider first: a word's ASCII part may be half of a character.
    spans = [m.span() for m in _TOKEN.finditer(text) if not text[slice(*m.span())].isascii()]
    touched = [(i, j) for i, j in spans if any(a < j and i < b for a, b in runs)]
    garbled, lost, out, last = False, False, [], 0
    for i, j in touched:
        word = text[i:j]
        fixed, missing = restored(word, model), False
        if fixed is None:
            parts = re.split(r"([\x21-\x7e]+)", word)
            mended = [p if p.isascii() else restored(p, model) for p in parts]
            if any(m is not None and not p.isascii() for p, m in zip(parts, mended, strict=True)):
                missing = any(m is None for m in mended)
                fixed = "".join(p if m is None else m for p, m in zip(parts, mended, strict=True))
        if _BROKEN_CHARS.search(word) and (fixed is None or "\ufffd" in fixed):
            fixed = regrown(word, model)
            missing = fixed is None
        garbled |= fixed is not None or missing
        lost |= missing
        out += [text[last:i], word if fixed is None else fixed]
        last = j
    if not garbled:
        return False, None
    return True, None if lost else "".join(out) + text[last:]


def garbled_values(df: DataFrame, fields: list[str], id_col: str = "row_id") -> DataFrame:
    """(id, field_name, value, restored) of each garbled value; restored is NULL where text was lost.

    NULL and '' are no case; a repeated row comes out again; very long values are
    examined whole. The counts over all values are collected as one table of
    CELLS fixed cells and broadcast. An empty table gives an empty result.
    """
    values = _values(df, id_col, fields)
    counts = pair_counts(values).toArrow()
    model = df.sparkSession.sparkContext.broadcast(Model(counts.column("cell").to_numpy(), counts.column("n").to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            codes, starts = _codes(texts)
            kinds = CLASS[codes]
            odd = np.add.reduceat((~OWN[kinds]).astype(np.int64), starts[:-1]) > 0 if len(codes) else np.zeros(0, bool)
            weights = m.shortfall(codes) if len(codes) > 1 else np.zeros(0)
            rows, fixed = [], []
            for k in np.flatnonzero(odd | _heavy(weights, starts)):
                is_garbled, text = examine(texts[k], m, weights[starts[k] : starts[k + 1] - 1])
                if is_garbled:
                    rows.append(k)
                    fixed.append(text)
            hit = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*hit.columns, pa.array(fixed, pa.string())], names=[id_col, "field_name", "value", "restored"])

    kind = values.schema[id_col].dataType.simpleString()
    return spread(values).mapInArrow(run, f"`{id_col}` {kind}, field_name string, value string, restored string")


def _heavy(weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Texts with any suspicious pair; pairs across texts don't count."""
    if len(starts) < 2:
        return np.zeros(0, bool)
    w = np.append(weights, 0.0)
    w[starts[1:] - 1] = 0.0
    return np.maximum.reduceat(w, starts[:-1]) >= SUSPECT


def p7_found(spark, sf_dir: str) -> DataFrame:
    found = garbled_values(spark.read.parquet(f"{sf_dir}/companies.parquet"), ["company_name_raw", "road_address"])
    return found.select("row_id", "field_name").distinct()
