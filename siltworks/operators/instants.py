"""Mixed timestamp formats and time zones to UTC instants.

``to_instants`` reduces each value to a mask of character classes (digits 9,
letters A, the rest as it is). A mask fixes where every part of a value stands, so
it is mapped to a plan once per worker; all values of the same mask are then
converted together, by slicing columns of code points and by numpy arithmetic.
Local times go through transition tables: for each zone the instants at which its
offset changes, taken from one version of the zone database.

Defined results: null, blank, unreadable and impossible values (month 13,
30 February, hour 25) have no instant; 24:00:00 is the next day's midnight, second
60 the next minute's first; a local time that occurs twice means the first, one
that is skipped moves forward by the gap; digits beyond microseconds are cut off;
values without a zone where no zone is known are UTC; slashed days with the year
last put the day first if told so.
"""

from __future__ import annotations

import re
import struct
import zoneinfo
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..runtime import ship, spread

# Names of months and weekdays, abbreviations of zones (hours from UTC).
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
ABBREVIATIONS = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "west": 1, "bst": 1, "cet": 1, "cest": 2, "met": 1, "mest": 2, "eet": 2, "eest": 3, "msk": 3, "sast": 2, "ist": 5.5, "npt": 5.75, "jst": 9, "kst": 9, "awst": 8, "acst": 9.5, "acdt": 10.5, "aest": 10, "aedt": 11, "nzst": 12, "nzdt": 13,
    "nst": -3.5, "ndt": -2.5, "ast": -4, "adt": -3, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7, "akst": -9, "akdt": -8, "hst": -10,
}
_MONTH = {m[:k]: i + 1 for i, m in enumerate(MONTHS) for k in {3, 4 if m == "september" else 3, len(m)}}
_WEEKDAY = {d[:k] for d in WEEKDAYS for k in (2, 3, 4, len(d))}
_EDGE = " \t\n\r\v\f   　​﻿"
_US = 1_000_000
#: plans and zone tables that a worker remembers; free text brings ever new masks and names
_PLANS, _ZONES = 4096, 1024


def _second(year: int) -> int:
    """The first second of a year."""
    return int(datetime(year, 1, 1, tzinfo=timezone.utc).timestamp())


class ZoneTable:
    """A zone's offsets by wall-clock time, in seconds.

    ``offsets[i]`` holds from ``walls[i-1]`` to ``walls[i]`` on the wall. A change's
    threshold is the later of the two wall times at its instant: so repeated times
    take the offset before the change (the first), and so do skipped ones (moved
    forward by the gap).

    Beyond the changes that the zone's file lists a rule holds for ever. It depends
    only on the weekday of 1 January and on whether the year is a leap year, so the
    table lists the rule's changes until each of these 14 kinds of years has come,
    and later years are looked up as the first one of their kind.
    """

    def __init__(self, name: str):
        zone = zoneinfo.ZoneInfo(name)

        def offset(t: int) -> int:
            return int(zone.utcoffset(datetime.fromtimestamp(t, timezone.utc).astimezone(zone)).total_seconds())

        at, first = _tzif(name) or ([], offset(-(2**31)))
        now, now_offset = (at[-1][0], at[-1][1]) if at else (-(2**31), first)
        year = max(datetime.fromtimestamp(now, timezone.utc).year, 2037) + 1
        self.like: dict[tuple[int, bool], int] = {}
        while len(self.like) < 14:
            start = datetime(year, 1, 1)
            self.like.setdefault((start.weekday(), (start.replace(year=year + 1) - start).days == 366), _second(year))
            year += 1
        self.end = _second(year)
        for t in range(now + 1, self.end + 86400, 20 * 86400):
            o = offset(t)
            if o != now_offset:
                low, high = now, t
                while high - low > 1:
                    mid = (low + high) // 2
                    low, high = (mid, high) if offset(mid) == now_offset else (low, mid)
                at.append((high, o))
                now_offset = o
            now = t
        self.offsets = np.array([first, *(o for _, o in at)], np.int64)
        walls = np.array([t + max(a, b) for (t, b), a in zip(at, self.offsets)], np.int64)
        self.walls = np.maximum.accumulate(walls) if len(walls) else walls

    def of(self, wall: np.ndarray) -> np.ndarray:
        """The offsets at wall-clock times."""
        late = wall >= self.end
        if late.any():
            wall = wall.copy()
            years, which = np.unique(wall[late].astype("datetime64[s]").astype("datetime64[Y]").astype(np.int64) + 1970, return_inverse=True)
            moved = []
            for y in years.tolist():
                leap = y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)
                start = int(np.datetime64(f"{y:04d}-01-01", "s").astype(np.int64))
                moved.append(self.like[(start // 86400 + 3) % 7, leap] - start)
            wall[late] += np.array(moved, np.int64)[which]
        return self.offsets[np.searchsorted(self.walls, wall, side="right")]


@lru_cache(_ZONES)
def zone_table(name: str, version: str = "") -> ZoneTable | None:
    """A zone's table, None if it is unknown; the database's version keeps tables of two versions apart."""
    try:
        return ZoneTable(name)
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
        return None


def _tzif(name: str) -> tuple[list[tuple[int, int]], int] | None:
    """The changes that a zone's file lists, and the offset before the first."""
    for root in zoneinfo.TZPATH:
        try:
            data = open(f"{root}/{name}", "rb").read()
            break
        except OSError:
            continue
    else:
        try:
            from importlib.resources import files

            data = files("tzdata.zoneinfo").joinpath(name).read_bytes()
        except (ModuleNotFoundError, FileNotFoundError, OSError):
            return None
    head = ">4s1c15x6l"

    def counts(i: int):
        return struct.unpack_from(head, data, i)[2:]

    utc, std, leap, n, kinds, chars = counts(0)
    i = 44 + n * 5 + kinds * 6 + chars + leap * 8 + std + utc
    if data[4:5] < b"2" or data[i : i + 4] != b"TZif":
        return None
    utc, std, leap, n, kinds, chars = counts(i)
    i += 44
    times = struct.unpack_from(f">{n}q", data, i)
    which = struct.unpack_from(f">{n}B", data, i + 8 * n)
    info = [struct.unpack_from(">lBB", data, i + 9 * n + 6 * k) for k in range(kinds)]
    first = next((o for o, dst, _ in info if not dst), info[0][0])
    return [(t, info[w][0]) for t, w in zip(times, which)], first


@lru_cache(1)
def zone_version() -> str:
    """The version of the zone database in use, which keys the tables."""
    for root in zoneinfo.TZPATH:
        for name in ("+VERSION", "version", "tzdata.zi"):
            try:
                if m := re.search(r"20\d\d[a-z]", open(f"{root}/{name}").readline()):
                    return m[0]
            except OSError:
                continue
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "unknown"


# --- masks and plans ---------------------------------------------------------

_PARTS = re.compile(r"9+|A[A_/+\-]*/[A_/]*[A_]|A+|.", re.S)


def mask_of(value: str) -> str:
    """The value with each digit as 9 and each letter as A."""
    return "".join("9" if "0" <= c <= "9" else "A" if c.isalpha() else " " if c.isspace() else c for c in value)


class _Plan:
    """Where a mask's parts stand: slices of the value by name."""

    def __init__(self, mask: str):
        self.n = len(mask)
        self.at: dict[str, tuple[int, int]] = {}
        self.words: list[tuple[str, int, int]] = []
        self.day_month = ""
        self.ok = self._match(mask)

    def _match(self, mask: str) -> bool:
        parts = [(m[0], m.start(), m.end()) for m in _PARTS.finditer(mask)]
        # a number is (length), a word 'A', a zone name '/', the rest itself
        kinds = [str(len(p)) if p[0] == "9" else "/" if "/" in p and p[0] == "A" else "A" if p[0] == "A" else p for p, _, _ in parts]
        i = 0

        def put(name: str, k: int) -> None:
            self.at[name] = parts[k][1:]

        def word(name: str, k: int) -> None:
            self.words.append((name, *parts[k][1:]))

        def like(*pattern: str, at: int | None = None) -> bool:
            j = i if at is None else at
            if len(kinds) < j + len(pattern):
                return False
            return all(kinds[j + k] in p.split("~") for k, p in enumerate(pattern))

        if len(kinds) == 1 and kinds[0].isdigit():
            n = int(kinds[0])
            if n >= 9:
                self.at["epoch"] = parts[0][1:]
                return n <= 19
            a = parts[0][1]
            if n not in (4, 6, 8):
                return False
            for name, x, y in (("year", 0, 4), ("month", 4, 6), ("day", 6, 8)):
                if n >= y:
                    self.at[name] = (a + x, a + y)
            return True

        if like("A", ",", " ") or like("A", ",", "1~2"):
            word("weekday", 0)
            i = 3 if kinds[2] == " " else 2
        elif like("A", " ", "1~2", " ", "A"):
            word("weekday", 0)
            i = 2

        if like("4", "-", "2", "-", "1~2") or like("4", "/", "1~2", "/", "1~2") or like("4", ".", "2", ".", "2"):
            put("year", i), put("month", i + 2), put("day", i + 4)
            i += 5
        elif like("4", "-", "A", "2", "-", "1"):
            word("week_mark", i + 2), put("year", i), put("week", i + 3), put("week_day", i + 5)
            i += 6
        elif like("4", "-", "3"):
            put("year", i), put("ordinal", i + 2)
            i += 3
        elif like("4", "-", "2") or like("4", "/", "2"):
            put("year", i), put("month", i + 2)
            i += 3
        elif like("8", "A"):
            a = parts[i][1]
            self.at |= {"year": (a, a + 4), "month": (a + 4, a + 6), "day": (a + 6, a + 8)}
            i += 1
        elif like("1~2", "/", "1~2", "/", "4"):
            put("left", i), put("right", i + 2), put("year", i + 4)
            i += 5
        elif like("1~2", ".", "1~2", ".", "4"):
            put("day", i), put("month", i + 2), put("year", i + 4)
            i += 5
        elif like("1~2", " ~-~.", "A", " ~-", "4") or like("1~2", "A", "4"):
            k = 0 if kinds[i + 1] == "A" else 1
            put("day", i), word("month", i + 1 + k), put("year", i + 2 + 2 * k)
            i += 3 + 2 * k
        elif like("A", " ", "1~2", ",", " ", "4"):
            word("month", i), put("day", i + 2), put("year", i + 5)
            i += 6
        elif like("A", " ", "1~2", " ", "4"):
            word("month", i), put("day", i + 2), put("year", i + 4)
            i += 5
        elif like("A", " ", "4"):
            word("month", i), put("year", i + 2)
            i += 3
        elif like("4"):
            put("year", i)
            i += 1
        else:
            return False
        if i == len(kinds):
            return True
        if "day" not in self.at and "ordinal" not in self.at and "left" not in self.at and "week" not in self.at:
            return False

        # time
        if like("A", "6~4~2~1"):
            word("time_mark", i)
            i += 1
            if like("6~4") and not like("6~4", ":"):
                a, b = parts[i][1:]
                self.at |= {"hour": (a, a + 2), "minute": (a + 2, a + 4)} | ({"second": (a + 4, a + 6)} if b - a == 6 else {})
                i += 1
        elif like(" ", "1~2", ":"):
            i += 1
        elif like(",", " ", "1~2", ":"):
            i += 2
        if "hour" not in self.at and like("1~2", ":", "2"):
            put("hour", i), put("minute", i + 2)
            i += 3
            if like(":", "2"):
                put("second", i + 1)
                i += 2
        elif "hour" not in self.at and any(n == "time_mark" for n, _, _ in self.words) and like("2"):
            put("hour", i)
            i += 1
        if "hour" in self.at and i + 1 < len(kinds) and kinds[i] in ".," and kinds[i + 1].isdigit():
            put("fraction", i + 1)
            i += 2
        # half of the day, zone
        if "hour" in self.at:
            if like(" ", "A") and parts[i + 1][2] - parts[i + 1][1] == 2 or like("A") and parts[i][2] - parts[i][1] == 2:
                k = i + (kinds[i] == " ")
                word("half_or_zone", k)
                i = k + 1
            if like(" ") and i + 1 < len(kinds):
                i += 1
            if like("A", "+~-") and i + 2 < len(kinds):
                word("zone_mark", i)
                i += 1
            if like("A"):
                word("zone", i)
                i += 1
            elif like("/"):
                word("zone_name", i)
                i += 1
            elif like("+~-~−", "2", ":", "2"):
                put("sign", i), put("zone_hour", i + 1), put("zone_minute", i + 3)
                i += 4
            elif like("+~-~−", "4~2~1"):
                put("sign", i)
                a, b = parts[i + 1][1:]
                self.at["zone_hour"] = (a, min(b, a + 2))
                if b - a == 4:
                    self.at["zone_minute"] = (a + 2, b)
                i += 2
        return i == len(kinds)


@lru_cache(_PLANS)
def plan_of(mask: str) -> _Plan:
    return _Plan(mask)


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970 of proleptic Gregorian dates."""
    y = y - (m <= 2)
    era = y // 400
    of_era = y - era * 400
    of_year = (153 * (m + np.where(m > 2, -3, 9)) + 2) // 5 + d - 1
    return era * 146097 + of_era * 365 + of_era // 4 - of_era // 100 + of_year - 719468


def _convert(values: list[str], plan: _Plan, zones: np.ndarray, day_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(microseconds since 1970, valid) of values that share a mask."""
    n = len(values)
    codes = np.array(values, f"U{plan.n}").view(np.uint32).reshape(n, plan.n).astype(np.int64)
    ok = np.ones(n, bool)

    def number(name: str, otherwise: int) -> np.ndarray:
        if name not in plan.at:
            return np.full(n, otherwise, np.int64)
        a, b = plan.at[name]
        out = np.zeros(n, np.int64)
        for k in range(a, b):
            out = out * 10 + codes[:, k] - 48
        return out

    if "epoch" in plan.at:
        width = plan.at["epoch"][1] - plan.at["epoch"][0]
        t = number("epoch", 0)
        # 9 to 11 digits are seconds, 12 to 14 milli-, 15 to 17 micro-, more nanoseconds
        us = t * _US if width <= 11 else t * 1000 if width <= 14 else t if width <= 17 else t // 1000
        return us, ok & (us < 253402300800 * _US)

    words: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for name, a, b in plan.words:
        words[name] = np.unique([v[a:b] if name == "zone_name" else v[a:b].lower() for v in values], return_inverse=True)

    def look(name: str, table, missing):
        distinct, which = words[name]
        return np.array([table(w) if callable(table) else table.get(w, missing) for w in distinct])[which]

    y, mo, d = number("year", 0), number("month", 1), number("day", 1)
    if "month" in words:
        mo = look("month", _MONTH, 0)
    if "left" in plan.at:
        one, two = number("left", 1), number("right", 1)
        d, mo = np.where(day_first, one, two), np.where(day_first, two, one)
    if "weekday" in words:
        ok &= look("weekday", lambda w: w in _WEEKDAY, False)
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    if "ordinal" in plan.at:
        o = number("ordinal", 1)
        ok &= (o >= 1) & (o <= 365 + leap)
        days = _days(y, np.ones(n, np.int64), np.ones(n, np.int64)) + o - 1
    elif "week" in plan.at:
        week, day = number("week", 1), number("week_day", 1)
        ok &= look("week_mark", lambda w: w == "w", False) & (week >= 1) & (week <= 53) & (day >= 1) & (day <= 7)
        fourth = _days(y, np.ones(n, np.int64), np.full(n, 4, np.int64))
        days = fourth - (fourth + 3) % 7 + (week - 1) * 7 + day - 1
    else:
        long = np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31], np.int64)[np.clip(mo, 0, 12)] + (leap & (mo == 2))
        ok &= (mo >= 1) & (mo <= 12) & (d >= 1) & (d <= long)
        days = _days(y, np.clip(mo, 1, 12), d)
    ok &= y >= 1

    h, mi, s = number("hour", 0), number("minute", 0), number("second", 0)
    if "time_mark" in words:
        ok &= look("time_mark", lambda w: w == "t", False)
    us = np.zeros(n, np.int64)
    if "fraction" in plan.at:
        a, b = plan.at["fraction"]
        for k in range(a, min(b, a + 6)):
            us = us * 10 + codes[:, k] - 48
        us *= 10 ** max(0, 6 - (b - a))
    zone = np.array(zones, dtype=object)
    fixed = np.zeros(n, bool)
    shift = np.zeros(n, np.int64)
    half = np.zeros(n, bool)
    if "half_or_zone" in words:
        pm, am = look("half_or_zone", lambda w: w == "pm", False), look("half_or_zone", lambda w: w == "am", False)
        half = pm | am
        ok &= ~half | ((h >= 1) & (h <= 12))
        h = np.where(half, h % 12 + 12 * pm, h)
        named = look("half_or_zone", lambda w: ABBREVIATIONS.get(w, np.nan), np.nan).astype(float)
        ok &= half | ~np.isnan(named)
        fixed |= ~half
        shift = np.where(half, shift, np.nan_to_num(named) * 3600).astype(np.int64)
    ok &= ((h <= 23) | ((h == 24) & (mi == 0) & (s == 0) & (us == 0))) & (mi <= 59) & (s <= 60)
    if "zone" in words:
        named = look("zone", lambda w: ABBREVIATIONS.get(w, np.nan), np.nan).astype(float)
        ok &= ~np.isnan(named)
        fixed[:] = True
        shift = (np.nan_to_num(named) * 3600).astype(np.int64)
    if "zone_mark" in words:
        ok &= look("zone_mark", lambda w: w in ("gmt", "utc", "ut"), False)
    if "sign" in plan.at:
        minutes = number("zone_minute", 0)
        off = number("zone_hour", 0) * 3600 + minutes * 60
        ok &= (off <= 18 * 3600) & (minutes <= 59)
        fixed[:] = True
        shift = np.where(codes[:, plan.at["sign"][0]] == ord("+"), off, -off)
    if "zone_name" in words:
        distinct, which = words["zone_name"]
        zone = distinct.astype(object)[which]
        ok &= np.array([zone_table(z, zone_version()) is not None for z in distinct])[which]
    wall = days * 86400 + h * 3600 + mi * 60 + s
    local = ~fixed
    if local.any():
        for z in {z for z in zone[local] if z}:
            tab = zone_table(z, zone_version())
            if tab is not None:
                here = local & (zone == z)
                shift[here] = tab.of(wall[here])
    utc = wall - shift
    ok &= (utc >= -62135596800) & (utc < 253402300800)
    return utc * _US + us, ok


def parse_instants(values, zones, day_first) -> list[str | None]:
    """Each value's instant as ``2015-03-01T04:05:06.000000Z``, or None."""
    n = len(values)
    out: list[str | None] = [None] * n
    by_mask: dict[str, list[int]] = {}
    texts: list[str] = [""] * n
    for i, v in enumerate(values):
        if isinstance(v, str) and (t := v.strip(_EDGE)):
            texts[i] = t
            by_mask.setdefault(mask_of(t), []).append(i)
    zones, first = np.asarray(zones, dtype=object), np.array([bool(x) if x is not None and x == x else False for x in day_first])
    for mask, rows in by_mask.items():
        plan = plan_of(mask)
        if not plan.ok:
            continue
        at = np.array(rows)
        us, ok = _convert([texts[i] for i in rows], plan, zones[at], first[at])
        written = np.datetime_as_string(us.astype("datetime64[us]"), unit="us")
        for i, w, good in zip(rows, written, ok):
            if good:
                out[i] = f"{w}Z"
    return out


def to_instants(values: DataFrame) -> DataFrame:
    """(field_name, row_id, value, utc) of (field_name, row_id, value, tz, day_first).

    utc is null where the value names no moment. One row a row; the mask plans and
    zone tables live in the worker, so nothing is shuffled.
    """

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tz = [z if isinstance(z, str) and z else None for z in b["tz"]]
            yield pd.DataFrame({"field_name": b["field_name"], "row_id": b["row_id"], "value": b["value"], "utc": parse_instants(b["value"].tolist(), tz, b["day_first"].tolist())})

    ship(values.sparkSession)
    return spread(values.select("field_name", "row_id", "value", "tz", "day_first")).mapInPandas(convert, "field_name string, row_id bigint, value string, utc string")
