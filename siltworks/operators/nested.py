"""Deeply nested semi-structured records to related flat tables.

``flatten_lists`` projects a column of JSON texts into one row per member of any
of the named lists, at any depth. It is one higher-order projection: a row's open
objects are an array of structs that carry their ancestor's key; nested
``transform`` calls attach the holder's key and the position, ``flatten`` combines
the arrays, ``aggregate`` repeats the step once per level that the text itself can
have, and one ``inline`` emits the rows. No Python; the work is the size of the
text times its depth. The one shuffle drops repeated deliveries; its width is
fixed, as small texts carry much work and must not be coalesced into few tasks.

A list is read in whatever shape it is written: an array, an array of arrays, an
object keyed by numbers, a single object, an object whose one member packs the
list (``{"layer": [...]}``), any of these as a string of JSON, and any number of them
around each other. Nulls and members that are no objects have no position.

The text itself may be packed too: as a string of JSON, as arrays, or both, with
white space or a byte order mark around it.

Defined results: null, empty and incomplete texts have no rows; an object without
key has key ''; objects may hold lists however deep inside members of any name; a
repeated delivery counts once; clashing extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import shuffle_width

_SPACE = " \t\n\r\ufeff"
_MAP, _ARR = "map<string,string>", "array<string>"
_ITEM = "array<struct<m:map<string,string>,inner:array<string>>>"
_ROW = "array<struct<parent_id:string,list_name:string,pos:bigint,object_id:string,attrs:map<string,string>>>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with value computed once; lambdas know no common subexpressions."""
    return F.transform(F.array(value), body)[0]


def _trim(text: Column) -> Column:
    """Without the white space of JSON, or a byte order mark, at both ends."""
    return F.trim(text, F.lit(_SPACE))


def _head(text: Column) -> Column:
    return F.substring(F.ltrim(text, F.lit(_SPACE)), 1, 1)


def _unpacked(text: Column) -> Column:
    """A trimmed text without the JSON strings around it; null if one is not complete."""
    once = lambda t, _: F.when(t.startswith('"'), _trim(F.try_variant_get(F.try_parse_json(t), "$", "string"))).otherwise(t)
    # each round takes at least the quotes off
    return F.when(text.startswith('"'), F.aggregate(F.sequence(F.lit(1), F.length(text)), text, once)).otherwise(text)


def _read(texts: Column, lists: tuple[str, ...]) -> Column:
    """Each text as an object's map, or as the texts that it packs."""
    nothing, no_map = F.lit(None).cast(_ARR), F.lit(None).cast(_MAP)

    def of_object(m: Column) -> Column:
        keys = F.map_keys(m)
        packs = F.forall(keys, lambda k: k.rlike("^[0-9]+$")) | ((F.size(m) == 1) & ~keys[0].isin(*lists) & _head(F.map_values(m)[0]).isin("[", "{") & F.try_parse_json(F.map_values(m)[0]).isNotNull())
        return F.when(packs, F.struct(no_map.alias("m"), F.map_values(m).alias("inner"))).otherwise(F.struct(m.alias("m"), nothing.alias("inner")))

    def of_text(x: Column) -> Column:
        return (
            F.when(_head(x) == "{", _let(F.from_json(x, _MAP), of_object))
            .when(_head(x) == "[", F.struct(no_map.alias("m"), F.from_json(x, _ARR).alias("inner")))
        )

    bare = F.transform(texts, lambda x: F.when(_head(x) == '"', _unpacked(_trim(x))).otherwise(x))
    return F.filter(F.transform(bare, of_text), lambda s: s.isNotNull())


def _members(text: Column, lists: tuple[str, ...]) -> Column:
    """All members of a list as maps, in written order, every packing taken off."""

    def opened(s: Column) -> Column:
        return F.when(s["m"].isNotNull(), F.array(s)).otherwise(F.coalesce(_read(s["inner"], lists), F.array().cast(_ITEM)))

    def step(acc: Column, _: Column) -> Column:
        more = lambda got: F.struct(got.alias("got"), F.exists(got, packed).alias("packed"))
        return F.when(acc["packed"], _let(F.flatten(F.transform(acc["got"], opened)), more)).otherwise(acc)

    def to_the_end(got: Column) -> Column:
        # each packing takes a bracket or a brace, so no more rounds can be needed; when nothing is packed they idle
        rounds = F.sequence(F.lit(1), F.length(F.regexp_replace(text, r"[^\[{]", "")) + 1)
        return F.aggregate(rounds, F.struct(got.alias("got"), F.lit(True).alias("packed")), step, lambda acc: acc["got"])

    packed = lambda s: s["m"].isNull()
    # one round opens a plain array; few lists are packed further
    once = F.flatten(F.transform(_read(F.array(text), lists), opened))
    got = _let(once, lambda g: F.when(F.exists(g, packed), to_the_end(g)).otherwise(g))
    return F.transform(F.filter(got, lambda s: s["m"].isNotNull()), lambda s: s["m"])


def flatten_lists(records: DataFrame, row_id: str, body: str, lists: tuple[str, ...], key: str = "object_id") -> DataFrame:
    """Rows (<row_id>, parent_id, list_name, pos, object_id, attrs) of all list members.

    attrs has the member's own fields as text, nested ones as JSON.
    """
    lists = tuple(lists)
    no_maps = F.array().cast("array<map<string,string>>")

    def rows_of(objects: Column) -> Column:
        def held(m: Column) -> Column:
            own = F.coalesce(m[key], F.lit(""))
            return F.flatten(
                F.transform(
                    F.filter(F.map_entries(m), lambda e: e["key"].isin(*lists) & _head(e["value"]).isin("[", "{", '"')),
                    lambda e: F.transform(
                        _members(e["value"], lists),
                        lambda x, i: F.struct(own.alias("parent_id"), e["key"].alias("list_name"), i.cast("bigint").alias("pos"), F.coalesce(x[key], F.lit("")).alias("object_id"), x.alias("attrs")),
                    ),
                )
            )

        return F.flatten(F.transform(objects, held))

    def within(objects: Column) -> Column:
        """Objects inside members that are no list: they may hold lists too."""
        texts = F.flatten(F.transform(objects, lambda m: F.transform(F.filter(F.map_entries(m), lambda e: ~e["key"].isin(*lists) & _head(e["value"]).isin("[", "{", '"')), lambda e: _unpacked(_trim(e["value"])))))
        flat = F.flatten(F.transform(texts, lambda x: F.when(_head(x) == "[", F.coalesce(F.from_json(x, _ARR), F.array().cast(_ARR))).otherwise(F.array(x))))
        opened = F.transform(flat, lambda x: F.when(_head(x) == "{", F.from_json(x, _MAP)).when(_head(x) == "[", F.create_map(F.lit(""), x)))
        return F.filter(opened, lambda m: m.isNotNull())

    def next_state(acc: Column, _: Column) -> Column:
        def grown(rows: Column) -> Column:
            below = F.transform(rows, lambda r: r["attrs"])
            return F.struct(F.concat(below, within(acc["open"])).alias("open"), F.concat(acc["rows"], rows).alias("rows"))

        return F.when(F.size(acc["open"]) == 0, acc).otherwise(_let(F.coalesce(rows_of(acc["open"]), F.array().cast(_ROW)), grown))

    # each level opens a brace or a bracket, so a text cannot be deeper than these
    levels = F.length(F.regexp_replace("doc", r"[^{\[]", ""))
    opened = F.when(F.col("doc").startswith("["), F.create_map(F.lit(""), F.col("doc"))).otherwise(F.from_json("doc", _MAP))
    start = F.struct(F.coalesce(F.array(opened), no_maps).alias("open"), F.array().cast(_ROW).alias("rows"))
    docs = (
        records.select(F.col(row_id).alias("row"), _unpacked(_trim(F.col(body))).alias("doc"))
        .where(F.try_parse_json("doc").isNotNull() & (F.col("doc").startswith("{") | F.col("doc").startswith("[")))
        .repartition(shuffle_width(records.sparkSession), "row")
        .groupBy("row").agg(F.min("doc").alias("doc"))
    )
    out = docs.select("row", F.aggregate(F.sequence(F.lit(1), levels), start, next_state, lambda acc: acc["rows"]).alias("rows")).where(F.size("rows") > 0)
    return out.select(F.col("row").alias(row_id), F.inline("rows"))
