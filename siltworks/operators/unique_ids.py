"""Extraction of unique identifiers from documents.

Tokens come from the document's URL, its element texts and its attributes; the
text of known identifier elements stays whole, other texts are parted at blanks.
Each token is classified, and what URLs contain (base and query values) is
classified in turn, until nothing new is found: a worklist in the row, as narrow
array expressions. One value is reported once a document, as it was found first.

Defined results: documents without content report what their URL holds; JSON
objects are no tokens; null URLs and texts give nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identifiers as I
from .shred import tagged_texts

_TOKEN = "array<struct<tag:string,text:string>>"
_FOUND = "array<struct<tag:string,extraction_type:string,match_type:string,original_text:string,potential_identifier:string>>"


def tokens(url: Column, nodes: Column, exclude: tuple[str, ...] = ()) -> Column:
    """All tokens of a document in order, the URL first."""
    texts = tagged_texts(nodes, exclude)
    parted = F.flatten(F.transform(texts, lambda t: F.when(I.is_rule_tag(t["tag"]), F.array(t)).otherwise(F.transform(F.split(t["text"], r"\s+"), lambda w: F.struct(t["tag"].alias("tag"), w.alias("text"))))))
    first = F.when(url.isNotNull() & (url != ""), F.array(F.struct(F.lit("").alias("tag"), url.alias("text")))).otherwise(F.array().cast(_TOKEN))
    return F.concat(first, F.coalesce(parted, F.array().cast(_TOKEN)))


def classify(t: Column) -> Column:
    """The identifiers in one token (struct<tag, text>)."""
    tag, text = t["tag"], t["text"]

    def rows(extraction: str, matches: Column) -> Column:
        return F.transform(matches, lambda m: F.struct(tag.alias("tag"), F.lit(extraction).alias("extraction_type"), m["match_type"].alias("match_type"), F.regexp_replace(text, r"[\r\n]+", " ").alias("original_text"), m["value"].alias("potential_identifier")))

    pair = lambda k, v: F.struct(k.alias("match_type"), v.alias("value"))
    none = F.array().cast("array<struct<match_type:string,value:string>>")
    url = I.tidy(I.unquote(text))
    as_url = F.when(I.is_url(text) & (url != "") & (url != "http://dx.doi.org"), F.array(pair(I.url_kind(I.base_url(url)), url))).otherwise(none)
    cool = F.when(I.is_cool_uri(text), F.array(pair(F.lit("cooluri"), I.tidy(text)))).otherwise(none)
    found = I.by_pattern(text)
    ruled = F.concat(rows("extract", as_url), rows("rule_set", found), rows("rule_set", F.array(pair(F.lit("text"), text))))
    plain = F.concat(rows("extract", as_url), rows("extract", cool), rows("regex", found))
    out = F.when(I.is_rule_tag(tag), ruled).otherwise(plain)
    # objects in JSON are no identifiers
    return F.when((F.trim(text) == "") | text.rlike(r"^\s*\{.*:.*\}\s*$"), F.array().cast(_FOUND)).otherwise(F.filter(out, lambda x: x["potential_identifier"] != ""))


def inner_tokens(ts: Column) -> Column:
    """What the URLs among the tokens contain, as tokens of their own."""
    return F.flatten(F.transform(F.filter(ts, lambda t: I.is_url(t["text"])), lambda t: F.transform(F.filter(I.url_parts(t["text"]), lambda v: v != t["text"]), lambda v: F.struct(t["tag"].alias("tag"), v.alias("text")))))


def all_tokens(ts: Column) -> Column:
    """The tokens, then what their URLs contain, then what these contain, and so on to the end."""

    def step(acc: Column, _: Column) -> Column:
        # a part is shorter than its URL, so this ends; a token again is not opened again
        more = lambda ts: F.struct(ts.alias("open"), F.concat(acc["found"], ts).alias("found"))
        return F.when(F.size(acc["open"]) == 0, acc).otherwise(F.transform(F.array(F.array_except(inner_tokens(acc["open"]), acc["found"])), more)[0])

    # a part is what a ? or = parts off, or the text without them; escaped ones come to light with their %
    marks = F.transform(ts, lambda t: F.length(F.regexp_replace(t["text"], "[^?=%#;]", "")))
    start = F.struct(F.array_distinct(ts).alias("open"), F.array_distinct(ts).alias("found"))
    return F.aggregate(F.sequence(F.lit(0), F.coalesce(F.array_max(marks), F.lit(0)) + 1), start, step, lambda acc: acc["found"])


def extract_identifiers(shredded: DataFrame, doc_id: str, url: str = "url", exclude_tags: tuple[str, ...] = ()) -> DataFrame:
    """(<doc_id>, tag, extraction_type, match_type, original_text, potential_identifier).

    ``shredded`` has nodes. Only found identifiers are shuffled, to keep the first of
    each value.
    """
    # one row a token from here: the patterns then run in generated code
    token = shredded.select(doc_id, F.posexplode(all_tokens(tokens(F.col(url), F.col("nodes"), exclude_tags))).alias("at", "t"))
    row = token.select(doc_id, "at", F.posexplode(classify(F.col("t"))).alias("nth", "f")).select(doc_id, F.struct("at", "nth").alias("at"), "f.*")
    row = row.where(~I.excluded(F.col("match_type"), F.col("potential_identifier")))
    # the first of a value in its document; documents are whole on one row, so the groups are small
    first = row.groupBy(doc_id, "potential_identifier").agg(F.min(F.struct("at", "tag", "extraction_type", "match_type", "original_text")).alias("f"))
    return first.select(doc_id, "f.tag", "f.extraction_type", "f.match_type", "f.original_text", "potential_identifier")
