"""JSON of any shape as its terminal texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ARR, _MAP = "array<string>", "map<string,string>"


def flatten_json(text: Column, exclude: tuple[str, ...] = ()) -> Column:
    """All terminal values, as texts, level by level; members of excluded names are left out.

    A level opens objects and arrays together, as often as the text can be deep. Null
    and unreadable texts give null; nulls and blanks inside are dropped.
    """
    head = lambda x: F.substring(F.ltrim(x), 1, 1)
    nested = lambda x: head(x).isin("[", "{")
    none = F.array().cast(_ARR)

    def inside(x: Column) -> Column:
        entries = F.map_entries(F.from_json(x, _MAP))
        kept = F.filter(entries, lambda e: ~e["key"].isin(*exclude)) if exclude else entries
        return F.coalesce(F.when(head(x) == "[", F.from_json(x, _ARR)).otherwise(F.transform(kept, lambda e: e["value"])), F.array(x))

    def step(acc: Column, _: Column) -> Column:
        found = F.flatten(F.transform(acc["open"], inside))
        return F.when(F.size(acc["open"]) == 0, acc).otherwise(
            F.transform(F.array(found), lambda v: F.struct(F.filter(v, nested).alias("open"), F.concat(acc["out"], F.filter(v, lambda x: x.isNotNull() & ~nested(x) & (F.trim(x) != ""))).alias("out")))[0]
        )

    depth = F.length(F.regexp_replace(text, r"[^\[{]", ""))
    start = F.struct(F.filter(F.array(text), nested).alias("open"), none.alias("out"))
    return F.when(F.try_parse_json(text).isNotNull(), F.aggregate(F.sequence(F.lit(0), depth), start, step, lambda acc: acc["out"]))
