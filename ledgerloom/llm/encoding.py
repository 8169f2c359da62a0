"""Encoding of a corpus with a public byte-level BPE, as a monoid of joinable halves.

A text is encoded by halves, recursively. Two encoded neighbours are joined by
encoding a window around their border again. The window grows outwards until it
starts and ends where the tokenizer's pattern must cut, whatever stands on
either side, so no token outside can change:

* no alternative of the pattern goes from one class of characters (letter,
  digit, space, other) to another, except from one space into what follows, and
  from an apostrophe into a contraction;
* so between two characters of different classes there is always a cut, unless
  the first is a space or an apostrophe.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .spread import spread

#: Characters of a text that is encoded in one go; longer ones, the average document among them, by halves.
LEAF = 256
#: Ids of one batch of results, whose places in it are 32-bit numbers.
MOST_IDS = 1 << 28


def default_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Codec:
    """A byte-level BPE given as ranks; ids are the ranks. Texts of special tokens are ordinary text."""

    def __init__(self, path: str, leaf: int = LEAF):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.leaf = leaf
        # Positions of certain cuts: letter | non-letter, digit | non-digit, other | letter, digit or space.
        self.cut = regex.compile(r"(?<=\p{L})(?!\p{L})(?=.)|(?<=\p{N})(?!\p{N})(?=.)|(?<=[^\s\p{L}\p{N}'])(?=[\s\p{L}\p{N}])", regex.DOTALL)

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.bpe.encode_ordinary(text)
        middle = len(text) // 2
        left, right = text[:middle], text[middle:]
        return self.join(left, self.encode(left), right, self.encode(right))

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """The ids of ``left + right``, of which only those near the border are made anew."""
        if not left or not right:
            return left_ids or right_ids
        whole, border, reach = left + right, len(left), 16
        while True:
            # Cuts seen in the window; its own ends are no evidence, so they don't count.
            low, high = max(0, border - reach), min(len(whole), border + reach)
            cuts = [low + m.start() for m in self.cut.finditer(whole[low:high]) if 0 < m.start() < high - low]
            start = max((c for c in cuts if c < border), default=None)
            end = min((c for c in cuts if c > border), default=None)
            if (start is not None or low == 0) and (end is not None or high == len(whole)):
                break
            reach *= 2
        start, end = 0 if start is None else start, len(whole) if end is None else end
        keep = self._cover(left_ids, len(whole[start:border].encode()), from_end=True)
        skip = self._cover(right_ids, len(whole[border:end].encode()), from_end=False)
        return left_ids[: len(left_ids) - keep] + self.bpe.encode_ordinary(whole[start:end]) + right_ids[skip:]

    def _cover(self, ids: list[int], n_bytes: int, from_end: bool) -> int:
        """How many ids at one end make up ``n_bytes``: a cut never stands within a token."""
        n = 0
        while n_bytes > 0:
            n_bytes -= len(self.bytes_of[ids[-1 - n] if from_end else ids[n]])
            n += 1
        assert n_bytes == 0, "a token crosses a certain cut"
        return n

    def decode(self, ids) -> str:
        """The text of ids; concatenation is all a join of decoded parts needs."""
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str, leaf: int = LEAF) -> Codec:
    return Codec(path, leaf)


def _parted(lists: Iterator[np.ndarray], most: int) -> Iterator[list[np.ndarray]]:
    """The lists in groups of at most ``most`` numbers, a longer one alone; at least one group."""
    part: list[np.ndarray] = []
    n = 0
    for x in lists:
        if part and n + len(x) > most:
            yield part
            part, n = [], 0
        part.append(x)
        n += len(x)
    yield part


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF, most: int = MOST_IDS) -> DataFrame:
    """(doc_id, ids) of every row: the ids of the whole text without special tokens.

    NULL and '' give the empty list; blank texts and texts of special tokens are
    encoded as they stand; repeated rows give repeated rows. ``path`` names the
    vocabulary on every executor.
    """
    where = path or default_path()
    source = docs.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(where, leaf).encode
        for batch in batches:
            lists = (np.asarray(encode(t), dtype=np.int32) if t else np.empty(0, np.int32) for t in batch.column(1).to_pylist())
            first = 0
            for part in _parted(lists, most):
                offsets = np.zeros(len(part) + 1, np.int32)
                np.cumsum([len(x) for x in part], out=offsets[1:])
                values = np.concatenate(part) if part else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=[id_col, "ids"])
                first += len(part)

    id_type = source.schema[id_col].dataType.simpleString()
    return spread(source).mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text): the texts of encoded documents; the empty or NULL list gives ''."""
    where = path or default_path()
    source = encoded.select(id_col, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(where).decode
        for batch in batches:
            texts = [decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return source.mapInArrow(run, f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, text string")


def p8_ids(spark, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
