"""Byte-level BPE by tree reduction.

A text is encoded in halves, down to leaves, and neighbours are joined by encoding a window
around their seam anew. The window grows until what lies outside is proved to stay:

* between words, the window ends before a blank that follows a non-blank: whatever
  stands around, the pattern never matches across that place, and a match depends on nothing before it;
* inside one long match, the window ends between two tokens that are the encoding of their
  own bytes: a token sequence is the encoding of its bytes if and only if each of its
  neighbouring pairs is.

Decoding joins the bytes of the tokens up the same kind of tree.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from aerolake.llm.common import held, mapped

#: Characters of a leaf, bytes of a leaf inside one match, tokens of a leaf of decoding.
LEAF_CHARS = 8192
LEAF_BYTES = 512
LEAF_TOKENS = 4096

_RUN = re.compile(r"\s\s")
_SAFE = re.compile(r"\S(?=[ \n])")


class Codec:
    """Encodes and decodes by the ranks of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pattern = public_tokenizers.PATTERN
        self.full = tiktoken.Encoding("full", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # Where no two blanks stand side by side, the look-ahead never matters, and without it the pattern is faster.
        self.plain = tiktoken.Encoding("plain", pat_str=pattern.replace(r"|\s+(?!\S)", ""), mergeable_ranks=ranks, special_tokens={})
        self.bytes = {i: b for b, i in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}

    def leaf(self, text: str) -> list[int]:
        return (self.full if _RUN.search(text) else self.plain).encode_ordinary(text)

    def encode(self, text: str, leaf: int = LEAF_CHARS) -> list[int]:
        if len(text) <= leaf:
            return self.leaf(text)
        middle = len(text) // 2
        return self._join(text, middle, self.encode(text[:middle], leaf), self.encode(text[middle:], leaf), leaf)

    def _join(self, text: str, middle: int, left: list[int], right: list[int], leaf: int) -> list[int]:
        low, high = self._window(text, middle)
        spare = len(text[low:middle].encode())
        while spare > 0:
            spare -= len(self.bytes[left.pop()])
        over, skip = len(text[middle:high].encode()), 0
        while over > 0:
            over -= len(self.bytes[right[skip]])
            skip += 1
        between = text[low:high]
        left += self.leaf(between) if len(between) <= leaf else self._long(between)
        left += right[skip:]
        return left

    @staticmethod
    def _window(text: str, middle: int) -> tuple[int, int]:
        """The closest places around the seam where a blank follows a non-blank, or the text's ends."""
        size, low, high = 32, 0, len(text)
        while size < 2 * middle:
            found = [m.end() for m in _SAFE.finditer(text, max(0, middle - size), middle) if m.end() < middle]
            if found:
                low = found[-1]
                break
            size *= 2
        found = _SAFE.search(text, middle)
        return low, found.end() if found else high

    def _long(self, text: str) -> list[int]:
        """A window without a safe place, so with some very long match."""
        out: list[int] = []
        for match in _matches().finditer(text):
            out += self.piece(match.group().encode())
        return out

    def piece(self, data: bytes) -> list[int]:
        """The tokens of one match."""
        if len(data) <= LEAF_BYTES:
            return self.full._encode_single_piece(data)
        middle = len(data) // 2
        left, right = self.piece(data[:middle]), self.piece(data[middle:])
        size = 1
        while size < len(left) or size < len(right):
            near = self.full._encode_single_piece(b"".join(self.bytes[t] for t in left[-size:] + right[:size]))
            if (size >= len(left) or self._pair(left[-size - 1], near[0])) and (size >= len(right) or self._pair(near[-1], right[size])):
                return left[:-size] + near + right[size:]
            size *= 2
        return self.full._encode_single_piece(data)

    def _pair(self, a: int, b: int) -> bool:
        if (found := self.pairs.get((a, b))) is None:
            found = self.full._encode_single_piece(self.bytes[a] + self.bytes[b]) == [a, b]
            if len(self.pairs) < 1_000_000:
                self.pairs[a, b] = found
        return found

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_TOKENS:
            return b"".join(map(self.bytes.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=1)
def _matches():
    return regex.compile(public_tokenizers.PATTERN)


def codec(path: str) -> Codec:
    """One for each Python worker."""
    return held(path, lambda: Codec(path))


def encode_documents(docs: DataFrame, path: str | None = None, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row with ``ids`` (array of int), the tokens of its text; none for a null or empty text.

    Strings of special tokens are ordinary text. The columns named in keep stay, all by default; an ``ids`` column of the input is replaced.
    Repeated rows are encoded each. An empty table gives no rows.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return mapped(docs, column, {"ids": ArrayType(IntegerType())}, lambda texts: [[codec(path).encode(t or "") for t in texts]], keep)


def decode_documents(rows: DataFrame, path: str | None = None, column: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Each row with ``decoded`` (binary), the bytes of its tokens; null ids give no bytes, an id outside the vocabulary is an error."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return mapped(rows, column, {"decoded": BinaryType()}, lambda rows: [[codec(path).decode(ids or []) for ids in rows]], keep)


def bpe_digest(docs: DataFrame) -> DataFrame:
    encoded = encode_documents(docs, keep=["doc_id"])
    return decode_documents(encoded).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
