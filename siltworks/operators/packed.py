"""Several values packed into one field.

``split_packed`` parses each field with a parsing expression grammar. Its
alternatives are ordered; the first that matches wins and a failed one gives back
what it consumed:

    field   <- list / values
    list    <- ws open values close ws END          open/close enclose everything
    values  <- item (separator item)* END
    item    <- ws quoted ws &(separator / END)       else backtrack
             / ws bracketed ws &(separator / END)    else backtrack
             / ws bare                              error flag if it began as quoted or with a bracket that never closes
    quoted  <- q (escape / doubled q / !q any)* q    q of " ' and paired “ ” „ « »
    bracketed <- [ (bracketed / escape / any)* ]     [ of ( [ {; separators inside belong to the value
    bare    <- (escape / entity / shielded / !separator any)*
    shielded <- &boundary quoted &(any separator / comma / ws / END)   kept as written
    separator <- ; | + > newline tab full-width ; and written-out hierarchy signs

Commas separate only if the field has no other separator outside quotes, and
blanks only if asked for (``blanks``) and neither others nor commas do; so a field
is parsed with the widest class of separators that occurs in it, at most three
times.

The grammar is recursive descent over one string, so it runs in Python workers
over Arrow batches; the work a row is linear in its length for well-formed input,
and a malformed quote costs at most one more scan of its item. Where a quote of some
kind can close at the latest and which bracket closes which is looked up in tables
that one pass over the field makes.

Defined results: null and blank fields have no values; a repeated delivery of a
row counts once; values of equal text keep their own positions.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import ship, shuffle_width

# What separates, encloses and quotes.
HARD = ";|+>\n\r\t\v\f；｜＞›»→"
HIERARCHY = ("&gt;", "&#62;", "&#x3e;", "->", "=>")
COMMA = ",，、"
ENCLOSERS = {"[": "]", "{": "}", "(": ")", "<": ">"}
BRACKETS = "[{("
QUOTES = {'"': '"', "'": "'", "“": "”", "„": "“", "‘": "’", "«": "»", "`": "`"}
_ENTITY = re.compile(r"&(?:[A-Za-z]{2,8}|#\d{1,7}|#[xX][0-9A-Fa-f]{1,6});")
_JSON_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
_INVISIBLE = "﻿​‌‍⁠"


def _strip(s: str) -> str:
    return s.strip().strip(_INVISIBLE).strip()


class _Field:
    """The grammar over one field's text; ``level`` is the class of separators."""

    def __init__(self, text: str, level: int, in_list: bool):
        self.s, self.n, self.level, self.in_list = text, len(text), level, in_list
        self.closes: dict[int, int] | None = None
        self.last: dict[tuple[str, bool], int] = {}

    def separator(self, i: int) -> int:
        """Length of the separator at i, or 0. Nothing separates at level -1."""
        c = self.s[i]
        if self.level < 0:
            return 0
        if c == "&":
            return next((len(h) for h in HIERARCHY if h[0] == "&" and self.s[i : i + len(h)].lower() == h), 0)
        if c in "-=" and self.s[i + 1 : i + 2] == ">":
            return 2
        if c in HARD:
            return 1
        if self.level >= 1 and c in COMMA:
            return 1
        return int(self.level >= 2 and c.isspace())

    def blank(self, i: int) -> int:
        while i < self.n and (self.s[i].isspace() or self.s[i] in _INVISIBLE) and not self.separator(i):
            i += 1
        return i

    def escape(self, i: int) -> tuple[str, int] | None:
        if self.s[i] != "\\" or i + 1 >= self.n:
            return None
        c = self.s[i + 1]
        if self.in_list:
            if c == "u" and re.fullmatch("[0-9A-Fa-f]{4}", self.s[i + 2 : i + 6]):
                return chr(int(self.s[i + 2 : i + 6], 16)), i + 6
            c = _JSON_ESCAPES.get(c, c)
        return c, i + 2

    def ends(self, i: int, loose: bool) -> int | None:
        """Where what may follow a closing quote begins, if it does so at i."""
        if loose:
            return i if i == self.n or self.s[i].isspace() or self.s[i] in COMMA or self.separator(i) else None
        j = self.blank(i)
        return j if j == self.n or self.separator(j) else None

    def last_end(self, close: str, loose: bool) -> int:
        """The last place at which a quote of this kind may close; -1 if there is none."""
        got = self.last.get((close, loose))
        if got is None:
            got = self.s.rfind(close)
            while got >= 0 and self.ends(got + 1, loose) is None:
                got = self.s.rfind(close, 0, got)
            self.last[close, loose] = got
        return got

    def bracketed(self, i: int) -> tuple[str, int] | None:
        if i >= self.n or self.s[i] not in BRACKETS:
            return None
        if self.closes is None:
            self.closes = _pairs(self.s)
        end = self.closes.get(i)
        if end is None or (j := self.ends(end + 1, False)) is None:
            return None
        inner = _Field(self.s[i + 1 : end], -1, self.in_list)
        return inner.bare(0)[0], j

    def quoted(self, i: int, loose: bool = False) -> tuple[str, int] | None:
        if i >= self.n or self.s[i] not in QUOTES:
            return None
        close, out, i = QUOTES[self.s[i]], [], i + 1
        if i > self.last_end(close, loose):
            return None
        while i < self.n:
            if e := self.escape(i):
                out.append(e[0])
                i = e[1]
            elif self.s[i] == close:
                if self.s[i + 1 : i + 2] == close and close in "\"'":
                    out.append(close)
                    i += 2
                    continue
                if (j := self.ends(i + 1, loose)) is not None:
                    return "".join(out), j
                if close not in "'’":
                    return None
                out.append(close)  # an apostrophe
                i += 1
            elif self.s[i] == "&" and (m := _ENTITY.match(self.s, i)):
                out.append(html.unescape(m[0]))
                i = m.end()
            else:
                out.append(self.s[i])
                i += 1
        return None

    def bare(self, i: int) -> tuple[str, int]:
        out: list[str] = []
        start = i
        while i < self.n and not self.separator(i):
            if self.s[i] in QUOTES and (i == start or self.s[i - 1].isspace() or self.s[i - 1] in COMMA) and (q := self.quoted(i, loose=True)):
                out.append(self.s[i : q[1]])
                i = q[1]
            elif e := self.escape(i):
                out.append(e[0])
                i = e[1]
            elif self.s[i] == "&" and (m := _ENTITY.match(self.s, i)):
                out.append(html.unescape(m[0]))
                i = m.end()
            else:
                out.append(self.s[i])
                i += 1
        return "".join(out), i

    def values(self) -> tuple[list[tuple[str, bool]], bool]:
        """The values with their error flags, and whether any separator occurred."""
        out, i, parted = [], 0, False
        while True:
            i = self.blank(i)
            got = self.quoted(i) or self.bracketed(i)
            began = not got and i < self.n and (self.s[i] in QUOTES and self.s[i] != "'" or self.s[i] in BRACKETS and i not in self.closes)
            text, i = got or self.bare(i)
            if text := _strip(text):
                out.append((text, began))
            if i >= self.n:
                return out, parted
            parted = True
            i += self.separator(i)


def parse_field(text: str | None, blanks: bool = False) -> list[tuple[str, bool]]:
    """The values of one packed field, in order, each with its error flag."""
    if not text or not (s := _strip(text)):
        return []
    enclosed = len(s) > 1 and ENCLOSERS.get(s[0]) == s[-1] and s[-2:-1] != "\\" and _balanced(s)
    body = s[1:-1] if enclosed else s
    got: list[tuple[str, bool]] = []
    for level in (0, 1, 2) if blanks else (0, 1):
        got, parted = _Field(body, level, enclosed and s[0] == "[").values()
        if parted:
            break
    return got


def _pairs(s: str) -> dict[int, int]:
    """The closing bracket of each bracket that closes; brackets in double quotes or escaped do not count."""
    out: dict[int, int] = {}
    open_: list[int] = []
    i = 0
    while i < len(s):
        c = s[i]
        if c == "\\":
            i += 1
        elif c == '"':
            end = s.find('"', i + 1)
            i = end if end > 0 else i
        elif c in BRACKETS:
            open_.append(i)
        elif open_ and c in "]})" and ENCLOSERS[s[open_[-1]]] == c:
            out[open_.pop()] = i
        i += 1
    return out


def _balanced(s: str) -> bool:
    """The first bracket closes with the last character, not before."""
    depth, i, quote = 0, 0, ""
    while i < len(s):
        c = s[i]
        if c == "\\":
            i += 1
        elif quote:
            quote = "" if c == quote else quote
        elif c == '"':
            quote = c
        elif c == s[0]:
            depth += 1
        elif c == ENCLOSERS[s[0]]:
            depth -= 1
            if not depth and i < len(s) - 1:
                return False
        i += 1
    return depth == 0


def split_packed(fields: DataFrame, blanks_in: tuple[str, ...] = ()) -> DataFrame:
    """(field_name, row_id, pos, term, malformed, n_terms) of (field_name, row_id, packed).

    One row a value; pos counts from 0, n_terms is the number of the field's
    values, so ``n_terms >= 2`` keeps the packed ones. Deliveries of one row that
    repeat its text are parsed once.
    """
    blanks_in = tuple(blanks_in)
    ship(fields.sparkSession)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for name, row, text in zip(b["field_name"], b["row_id"], b["packed"]):
                got = parse_field(text, name in blanks_in)
                for pos, (term, bad) in enumerate(got):
                    for c, v in zip(cols, (name, row, pos, term, bad, len(got))):
                        c.append(v)
            yield pd.DataFrame(dict(zip(("field_name", "row_id", "pos", "term", "malformed", "n_terms"), cols)))

    # of fixed width: small texts carry much work, and must not be coalesced into few tasks
    whole = fields.where(F.col("packed").isNotNull()).repartition(shuffle_width(fields.sparkSession), "field_name", "row_id")
    once = whole.groupBy("field_name", "row_id").agg(F.min("packed").alias("packed"))
    return once.mapInPandas(parse, "field_name string, row_id bigint, pos bigint, term string, malformed boolean, n_terms int")
