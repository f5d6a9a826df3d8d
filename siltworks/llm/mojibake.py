"""Garbled text from wrong character encodings.

A hidden Markov model labels the characters of a text. Its states are *clean* and
one per encoding pair (what the bytes were, what they were read as). A pair's
state emits units: the one or more characters that one written character became.
A unit's probability is that of the character it decodes to, in the corpus's own
clean text; the clean state's is that of the characters as they stand. Viterbi
finds the best labelling; each labelled span gets its state's inverse transform.

Only characters beyond ASCII are steps of the chain: all encodings here agree on
ASCII, so it tells nothing and is skipped at no cost. Character statistics are
counted over the whole corpus, with the classes of their neighbours, and leave out
characters that could be part of a garbled unit, so that damage does not train the
clean state.

Defined results: null, empty and ASCII texts are clean; a U+FFFD is always damage
that cannot be undone; letters that merely are rare stay, as a lone Ã or √ decodes
to nothing. Repeated deliveries of a record count once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import ship, spread

#: UTF-8 bytes read as these, each with the bytes it leaves undefined kept as controls
UTF8_AS = ("cp1252", "cp1250", "cp1251", "cp437", "mac_roman", "cp850", "iso8859_2", "koi8_r", "cp866")
#: (written as, read as) of single-byte encodings
SINGLE = (("cp1251", "cp1252"), ("cp1253", "cp1252"), ("cp1250", "cp1252"), ("koi8_r", "cp1252"), ("cp1252", "cp1251"), ("cp1252", "cp1250"), ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("mac_roman", "cp1252"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("koi8_r", "cp1251"), ("cp1251", "koi8_r"))
#: pairs whose writing has no Latin letters: their words do not mix with ASCII ones
_OTHER_SCRIPT = {"cp1251", "cp1253", "koi8_r"}

ENTER, LEAVE = math.log(1e-4), math.log(0.05)
_FLOOR = 0.01
#: share of the neighbour-free estimate in a character's probability
_MIX = 0.02
#: share of all characters that a character between given neighbours must exceed to count
_DAMAGE = 5e-5
_RUN = re.compile(r"[^\x00-\x7f]+")


def _bytes_to_chars(encoding: str) -> list[str]:
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


def _chars_to_bytes(encoding: str) -> dict[str, int]:
    table = {c: b for b, c in enumerate(_bytes_to_chars(encoding)) if b >= 128}
    if encoding == "cp1252":  # latin-1 is the same but for the controls
        table |= {chr(b): b for b in range(128, 160)}
    return table


class _Utf8As:
    """Units of UTF-8 read as a single-byte encoding, once or twice."""

    whole = False

    def __init__(self, encoding: str, twice: bool = False):
        self.name = f"utf_8>{encoding}" + ">utf_8>cp1252" * twice
        self.table = _chars_to_bytes(encoding)
        self.twice = _Utf8As("cp1252") if twice else None
        self.mixes: bool | None = None
        #: its letters alone make valid sequences, of scripts that nobody wrote
        self.letters = encoding in ("cp1251", "koi8_r", "cp866")

    def once(self, s: str, i: int) -> tuple[str, int] | None:
        b = self.table.get(s[i])
        if b is None or not 0xC2 <= b <= 0xF4:
            return None
        n = 2 if b < 0xE0 else 3 if b < 0xF0 else 4
        if i + n > len(s):
            return None
        raw = [b]
        for c in s[i + 1 : i + n]:
            x = self.table.get(c)
            if x is None or not 0x80 <= x <= 0xBF:
                return None
            raw.append(x)
        try:
            c = bytes(raw).decode("utf-8")
        except UnicodeDecodeError:
            return None
        if self.letters and not (c < "\u0530" or "\u2000" <= c < "\u2600"):
            return None
        return c, i + n

    def unit(self, s: str, i: int) -> tuple[str, int] | None:
        if not self.twice:
            return self.once(s, i)
        inner, j = [], i
        for _ in range(4):
            if j >= len(s) or not (got := self.twice.once(s, j)):
                return None
            inner.append(got[0])
            j = got[1]
            if len(inner) >= 2 and (u := self.once("".join(inner), 0)):
                return u[0], j
        return None


class _Stripped:
    """UTF-8 read as latin-1 whose control characters then were dropped.

    The unit is the lead that is left; what it was is not known, only how likely
    one of the characters is that begin so.
    """

    name = "utf_8>latin_1>stripped"
    whole, mixes = False, None

    def __init__(self) -> None:
        self.begins: dict[str, list[str]] = {}
        for c in map(chr, [*range(0x80, 0x800), *range(0x2000, 0x2070)]):
            b = c.encode("utf-8")
            if all(0x80 <= x <= 0x9F for x in b[1:]):
                self.begins.setdefault(chr(b[0]), []).append(c)

    def unit(self, s: str, i: int) -> tuple[list[str], int] | None:
        kept = self.begins.get(s[i])
        # E2 80 A6, an ellipsis, keeps its last byte
        if s[i] == "â" and s[i + 1 : i + 2] == "¦":
            return ["…"], i + 2
        if not kept or (i + 1 < len(s) and 0x80 <= ord(s[i + 1]) <= 0xBF):
            return _LATIN1.unit(s, i)
        return kept, i + 1


class _Single:
    """Single-byte text read as another single-byte encoding.

    All of a word is read in the same way, so the state holds for whole runs.
    """

    whole = True

    def __init__(self, written: str, read: str):
        self.name = f"{written}>{read}"
        back = _chars_to_bytes(read)
        there = _bytes_to_chars(written)
        self.map = {c: there[b] for c, b in back.items() if there[b] != c}
        #: whether its words mix with ASCII letters; None if both occur
        self.mixes = False if written in _OTHER_SCRIPT else True if read in _OTHER_SCRIPT else None

    def unit(self, s: str, i: int) -> tuple[str, int] | None:
        c = self.map.get(s[i])
        return (c, i + 1) if c else None


class _Lost:
    """Replacement marks: bytes that could not be read and are gone."""

    name = "lost"
    whole, mixes = False, None

    def unit(self, s: str, i: int) -> tuple[str, int] | None:
        return ("\ufffd", i + 1) if s[i] == "\ufffd" else None


_LATIN1 = _Utf8As("cp1252")
PAIRS = [*map(_Utf8As, UTF8_AS), _Utf8As("cp1252", twice=True), _Stripped(), *[_Single(*p) for p in SINGLE], _Lost()]
_FREE = [q for q, p in enumerate(PAIRS, 1) if not p.whole]
NAMES = ["clean"] + [p.name for p in PAIRS]
_CERTAIN = [p for p in PAIRS if isinstance(p, _Utf8As) and not p.twice]


@lru_cache(maxsize=1 << 14)
def _class(c: str) -> str:
    """What a neighbour is: edge, lower, upper, digit or other."""
    if not c or c.isspace():
        return "e"
    if c.islower():
        return "l"
    if c.isalpha():
        return "u"
    if c.isdigit():
        return "d"
    return "o"


class Characters:
    """How often each character stands between which neighbours, in clean text."""

    def __init__(self, counts: dict[tuple[str, str, str], int]):
        self.n = sum(counts.values()) or 1
        # what damage leaves behind is rare everywhere: take its share off all counts
        off = int(_DAMAGE * self.n)
        counts = {k: n - off for k, n in counts.items() if n > off}
        self.joint = counts
        self.single: Counter = Counter()
        around: Counter = Counter()
        for (c, a, b), k in counts.items():
            self.single[c] += k
            around[a, b] += k
        self.around = {k: (v + 1) / (self.n + 36) for k, v in around.items()}
        self.memo: dict = {}

    def log(self, c: str, a: str, b: str) -> float:
        key = (c, a, b)
        if (got := self.memo.get(key)) is None:
            p1 = (self.single.get(c, 0) + _FLOOR) / (self.n + 1)
            pj = (1 - _MIX) * self.joint.get(key, 0) / self.n + _MIX * p1 * self.around.get((a, b), 1 / (self.n + 36))
            if "\x80" <= c <= "\x9f":
                pj = 1e-10
            if a == "l" and (c.isupper() or (not c.isalpha() and c in "¹²³£¥¿¡¢ª")):
                pj *= 1e-3  # a capital or a sign inside a word
            got = self.memo[key] = math.log(pj)
        return got


def count_characters(texts) -> Counter:
    """Characters beyond ASCII with their neighbours' classes, but for those in possible units."""
    seen: Counter = Counter()
    for t in texts:
        if not isinstance(t, str) or t.isascii():
            continue
        for m in _RUN.finditer(t):
            run, at = m[0], m.start()
            free = [True] * len(run)
            for p in _CERTAIN:
                for i in range(len(run) - 1):
                    if u := p.once(run, i):
                        free[i : u[1]] = [False] * (u[1] - i)
            for i, ok in enumerate(free):
                if ok and run[i] != "\ufffd":
                    c = run[i] if run[i] <= "\uffff" else "\U00010000"
                    seen[c, _class(t[at + i - 1 : at + i]), _class(t[at + i + 1 : at + i + 2])] += 1
    return seen


def label(text: str, chars: Characters) -> list[tuple[int, int, str, str]]:
    """The damaged spans of a text as (begin, end, encoding pair, restored)."""
    k = len(PAIRS) + 1
    v = [0.0] + [ENTER] * (k - 1)
    #: for every position after a unit: state -> (position before, state before, restored)
    back: list[dict[int, dict[int, tuple[int, int, str]]]] = []
    runs = [(m.start(), m[0]) for m in _RUN.finditer(text)]
    ends: list[list[float]] = []
    for at, run in runs:
        n = len(run)
        score = [[-math.inf] * k for _ in range(n + 1)]
        score[0] = v
        how: dict[int, dict[int, tuple[int, int, str]]] = {}
        before = _class(text[at - 1 : at])
        after = text[at + n : at + n + 1]
        mixed = bool((at and text[at - 1].isascii() and text[at - 1].isalpha()) or (after.isascii() and after.isalpha()))
        for i in range(n):
            row = score[i]
            # states of whole runs are left only between runs
            best_from = max(range(1, k) if not i else _FREE, key=row.__getitem__)
            a = before if i == 0 else _class(run[i - 1])
            # clean
            stay, leave = row[0], row[best_from] + LEAVE
            e = chars.log(run[i], a, _class(run[i + 1] if i + 1 < n else after))
            s, f = (stay, 0) if stay >= leave else (leave, best_from)
            if s + e > score[i + 1][0]:
                score[i + 1][0] = s + e
                how.setdefault(i + 1, {})[0] = (i, f, run[i])
            enter = max(row[0], leave) + ENTER
            enter_from = 0 if row[0] >= leave else best_from
            for q in range(1, k):
                p = PAIRS[q - 1]
                u = p.unit(run, i)
                if u is None:
                    continue
                c, j = u
                s, f = (row[q], q) if row[q] >= enter or (p.whole and i) else (enter, enter_from)
                b = _class(run[j] if j < n else after)
                if p.name == "lost":
                    e = -1.0
                elif isinstance(c, list):
                    e = math.log(sum(math.exp(chars.log(x, a, b)) for x in c))
                    c = c[0] if len(c) == 1 else "\ufffd"
                else:
                    e = chars.log(c, a, b)
                    if p.mixes is not None and p.mixes != mixed:
                        e -= 6.0
                if s + e > score[j][q]:
                    score[j][q] = s + e
                    how.setdefault(j, {})[q] = (i, f, c)
        back.append(how)
        v = list(score[n])
        ends.append(v)
        top = max(v)
        v = [x if x > -math.inf else top + ENTER * 4 for x in v]
    # back through the runs
    state = max(range(k), key=lambda q: v[q] + (LEAVE if q else 0.0)) if runs else 0
    spans: list[tuple[int, int, str, str]] = []
    for r in range(len(runs) - 1, -1, -1):
        at, run = runs[r]
        i = len(run)
        if ends[r][state] == -math.inf:
            state = max(range(k), key=ends[r].__getitem__)
        while i > 0:
            b, f, c = back[r][i][state]
            if state:
                spans.append((at + b, at + i, NAMES[state], c))
            i, state = b, f
    return spans[::-1]


def restore(text: str, spans: list[tuple[int, int, str, str]]) -> str | None:
    """The text with each span decoded; None if some of it is lost."""
    if any(c == "\ufffd" for *_, c in spans):
        return None
    out, at = [], 0
    for a, b, _, c in spans:
        out += [text[at:a], c]
        at = b
    return "".join(out) + text[at:]


def find_mojibake(fields: DataFrame) -> DataFrame:
    """(field_name, row_id, encodings, n_spans, restored) of the damaged fields.

    ``fields`` has (field_name, row_id, text). restored is null where the damage
    cannot be undone. Two passes over the fields: the first counts characters (its
    result has at most one row per character of the basic plane and pair of
    neighbour classes, so it may be collected), the second labels. Nothing but
    those counts and the damaged fields is shuffled.
    """
    ship(fields.sparkSession)
    own = spread(fields.select("field_name", "row_id", "text").where(F.col("text").rlike(r"[^\x00-\x7F]")))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for b in batches:
            seen.update(count_characters(b["text"]))
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["c", "a", "b", "n"])

    stats = own.select("text").mapInPandas(counted, "c string, a string, b string, n bigint").groupBy("c", "a", "b").agg(F.sum("n").alias("n"))
    table = {(r.c, r.a, r.b): r.n for r in stats.collect()}
    shared = fields.sparkSession.sparkContext.broadcast(table)

    def labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chars = Characters(shared.value)
        for b in batches:
            rows = []
            for name, row, text in zip(b["field_name"], b["row_id"], b["text"]):
                if spans := label(text, chars):
                    rows.append((name, row, ",".join(sorted({s[2] for s in spans})), len(spans), restore(text, spans)))
            yield pd.DataFrame(rows, columns=["field_name", "row_id", "encodings", "n_spans", "restored"])

    found = own.mapInPandas(labelled, "field_name string, row_id bigint, encodings string, n_spans int, restored string")
    return found.dropDuplicates(["field_name", "row_id"])
