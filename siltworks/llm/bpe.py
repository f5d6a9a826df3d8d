"""Encoding of a corpus with a public byte-level BPE vocabulary.

``BacktrackingBpe`` gives exactly the merges of byte pair encoding without running
them. A run of tokens is the encoding of its text if and only if each pair of
neighbours is compatible, that is, encodes to just itself. So the encoder takes at
every place the longest token that matches there (found by one pass of an
Aho-Corasick automaton), keeps it if it is compatible with the token before, else
tries the next shorter prefix token, and steps back if none is left. No place is
left twice by the same way, so the work is linear in the text.

Texts are first parted by the vocabulary's own pattern; merges never cross parts.
Parts recur, so each worker remembers the encodings of the parts seen last.

Decoding joins the tokens' bytes through an offset table: all tokens' bytes stand
in one array, and a token is the slice between two offsets.

Defined results: null and empty texts have no tokens. Strings of special tokens in
a text are ordinary text.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import ship, spread

#: where the vocabulary files lie; a parameter of all functions here
TOKENIZERS = os.environ.get("SILT_TOKENIZERS", "/opt/tokenizers")
# Fixed value: the pattern that parts texts before byte_bpe_50k merges.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_REMEMBERED = 1 << 17
#: longer parts are rare and not worth remembering
_SHORT = 48


class BacktrackingBpe:
    """Encoder and decoder over ranks (bytes -> id, ids in the order of merging)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import ahocorasick
        import regex

        self.ranks = ranks
        tokens = sorted(ranks, key=ranks.get)
        n = max(ranks.values()) + 1
        self.offsets = np.zeros(n + 1, np.int64)
        for t in tokens:
            self.offsets[ranks[t] + 1] = len(t)
        self.offsets = np.cumsum(self.offsets)
        self.bytes = b"".join(tokens)
        self.part = regex.compile(pattern)
        self.size = {i: len(t) for t, i in ranks.items()}
        # the longest shorter token that a token begins with, or -1
        self.shorter = np.full(n, -1, np.int64)
        for t, i in ranks.items():
            for k in range(len(t) - 1, 0, -1):
                if (j := ranks.get(t[:k])) is not None:
                    self.shorter[i] = j
                    break
        self._split_tokens(tokens)
        self.automaton = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.automaton.add_word(t.decode("latin-1"), (len(t), i))
        self.automaton.make_automaton()
        self._compatible: dict[tuple[int, int], bool] = {}
        self.encode_part = lru_cache(_REMEMBERED)(self._encode_part)

    def _split_tokens(self, tokens: list[bytes]) -> None:
        """The pair that each token is merged from; single bytes are their own."""
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for t in tokens:
            i = self.ranks[t]
            if len(t) == 1:
                self.halves[i] = (i, i)
                continue
            # left halves from the longest down: the right one is the compatible pair
            left = self.shorter[i]
            while left >= 0:
                right = self.ranks.get(t[self.size[left] :])
                if right is not None and left < i and right < i and self._pair_ok(int(left), right):
                    self.halves[i] = (int(left), right)
                    self.merged[int(left), right] = i
                    break
                left = self.shorter[left]
            else:
                self.halves[i] = (i, i)

    def _pair_ok(self, a: int, b: int) -> bool:
        """Whether the text of a and b encodes to just a and b.

        Undo merges at the seam, the latest first: if the tokens that touch could
        have been merged before the one undone last was made, the seam is wrong.
        """
        limit = 1 << 60
        while True:
            made = self.merged.get((a, b))
            if made is not None and made < limit:
                return False
            if a > b:
                limit = a
                a = self.halves[a][1]
                if a == limit:
                    limit = b + 1
                    b = self.halves[b][0]
                    if b + 1 == limit:
                        return True
            else:
                limit = b + 1
                b = self.halves[b][0]
                if b + 1 == limit:
                    limit = a
                    a = self.halves[a][1]
                    if a == limit:
                        return True

    def compatible(self, a: int, b: int) -> bool:
        got = self._compatible.get((a, b))
        if got is None:
            if len(self._compatible) >= 1 << 20:
                self._compatible.clear()
            got = self._compatible[a, b] = self._pair_ok(a, b)
        return got

    def _encode_part(self, part: str) -> tuple[int, ...]:
        raw = part.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)
        if whole is not None:
            return (whole,)
        n = len(raw)
        longest, length = [-1] * n, [0] * n
        for end, (k, i) in self.automaton.iter(raw.decode("latin-1")):
            at = end - k + 1
            if k > length[at]:
                length[at], longest[at] = k, i
        out: list[int] = []
        open_ = bytearray(b"\x01") * (n + 1)
        at, token = 0, longest[0]
        while at < n:
            end = at + self.size[token]
            if open_[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
                continue
            shorter = int(self.shorter[token])
            if shorter >= 0:
                token = shorter
                continue
            open_[at] = 0  # nothing goes on from here
            token = out.pop()
            at -= self.size[token]
            # the token popped failed: try the next shorter one in its place
            while (s := int(self.shorter[token])) < 0:
                open_[at] = 0
                token = out.pop()
                at -= self.size[token]
            token = s
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if text:
            part, long = self.encode_part, self._encode_part
            for p in self.part.findall(text):
                out += part(p) if len(p) <= _SHORT else long(p)
        return out

    def count(self, text: str | None) -> int:
        part, long = self.encode_part, self._encode_part
        return sum(len(part(p) if len(p) <= _SHORT else long(p)) for p in self.part.findall(text)) if text else 0

    def decode(self, ids) -> str:
        o = self.offsets
        return b"".join(self.bytes[o[i] : o[i + 1]] for i in ids).decode("utf-8", "replace")


def read_ranks(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> dict[bytes, int]:
    """A vocabulary's tokens with their ids."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return {base64.b64decode(t): int(i) for t, i in (line.split() for line in f if line.strip())}


@lru_cache(4)
def encoder(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> BacktrackingBpe:
    """The encoder of a vocabulary, built once a worker."""
    return BacktrackingBpe(read_ranks(name, folder))


def encode_texts(docs: DataFrame, row_id: str, text: str, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(<row_id>, ids): the token ids of each text. Narrow: nothing is shuffled."""
    ship(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(name, folder)
        for b in batches:
            yield pd.Series([e.encode(t) if isinstance(t, str) else [] for t in b])

    return spread(docs.select(row_id, text)).select(F.col(row_id), ids(F.col(text)).alias("ids"))


def count_tokens(docs: DataFrame, row_id: str, text: str, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(<row_id>, n_tokens): the number of tokens of each text."""
    ship(docs.sparkSession)

    @F.pandas_udf("bigint")
    def n(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(name, folder)
        for b in batches:
            yield pd.Series([e.count(t) if isinstance(t, str) else 0 for t in b], dtype="int64")

    return spread(docs.select(row_id, text)).select(F.col(row_id), n(F.col(text)).alias("n_tokens"))
