"""Recognising unique identifiers in tokens, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import looks_like_date
from .text import strip_terminal
from .url import base_url, param_pairs, unquote

# Patterns by kind in the order of their test, tags whose text is an
# identifier by itself, what ends a token, and texts that never are identifiers.
DOI_URL = r"""(?i)https?://(?:dx\.)?doi\.org/10[.][0-9]{4,}(?:[/][0-9]+)*/(?:(?!["&'])\S)+"""
URN = r"""(?i)^[a-z0-9.#]{0,}:[a-z0-9][a-z0-9.-]{0,31}:[a-z0-9_()+,\-.:=@;$!*'%/?#\[\]]+"""
URN_ALONE = r"""(?i)^[a-z0-9]{0,}:[a-z0-9][a-z0-9\-]{0,31}:[a-z0-9()+,\-.:=@;$_!*'%/?#\[\]]+"""
UUID = r"(?i)[a-f\d]{8}(?:-[a-f\d]{4}){3}-[a-f\d]{12}"
DOI = r"""(?i)(?:doi:)?10[.][0-9]{4,}(?:[/][0-9]+)*/(?:(?!["&'])\S)+"""
MD5 = r"(?i)\b[a-f0-9]{32}\b"
PATTERNS = (("doi", DOI_URL), ("urn", URN), ("uuid", UUID), ("doi", DOI), ("md5", MD5))
RULE_TAGS = ("fileIdentifier/CharacterString", "identifier/", "dataSetURI/CharacterString", "parentIdentifier/CharacterString", "Entry_ID", "dc/identifier", "Layer/Name", "dataset/ID", "@URI", "@IDNo", "@ID", "datsetid")
TOKEN_ENDS = '(){}[],~|":&-<>.'
EXCLUDED_PARTS = (
    "urn:ogc:def", "codeList", "http://www.isotc211.org/2005", ".xsd", ".dtd", "schema", "19115-2", "ISO19115", "19115:2003", "unknown", "localhost", "urn:oasis:names:tc:ebxml", "EPSG:", "CRS:", "SRS:", "mailto", "Cor.1", "gml:", "xs:", ".sld", "tns:", "ns:", "pds:", "ds:", "rdf:", "rdfs:", "xmlns:", "xlink:", "xsd:",
    "descending:", "ascending:", "ddi:codebook:", "file://", "git://", "various", "foo/bar", "[user", "gravatar.", "avatar", "{searchTerms", "xmlmetadata", "coremetadata", "StructMetadata", "meters", "missing", "Downloadable Data", "local", "inapplicable", "dcterms:URI", "HH:MM:SS",
)
EXCLUDED_URLS = ("http://dx.doi.org",)
# ccTLDs are any two letters; these are the generic ones
GENERIC_TLDS = "com|net|org|edu|gov|mil|aero|asia|biz|cat|coop|info|int|jobs|mobi|museum|name|post|pro|tel|travel|xxx|test|example|invalid|local"


def is_rule_tag(tag: Column, rules=RULE_TAGS) -> Column:
    """Whether an element's path is one that holds identifiers."""
    out = F.lit(False)
    for r in rules:
        out = out | F.contains(tag, F.lit(r))
    return out


def has_scale(c: Column) -> Column:
    """Map scales like 1:100,000."""
    return c.rlike(r"1:\d*(?:,\d{3})+")


def tidy(c: Column) -> Column:
    """A token without marks around it; '' for scales and dates; only up to the first blank."""
    t = F.trim(strip_terminal(c, TOKEN_ENDS))
    return F.when((t == "") | has_scale(t) | looks_like_date(t), "").otherwise(F.substring_index(t, " ", 1))


def is_urn(c: Column) -> Column:
    return c.rlike(URN)


def is_cool_uri(c: Column) -> Column:
    """A path: it begins with a slash and ends with one or with a file name."""
    last = F.substring_index(c, "/", -1)
    return (F.instr(c, "/") > 0) & c.startswith("/") & (c.endswith("/") | (F.instr(last, ".") > 0))


def is_url(c: Column) -> Column:
    """An absolute URL with a host that could exist; URNs and mail addresses are none."""
    scheme = c.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:/")
    legal = ~c.rlike(r"[\s<>\"{}|\\^`]")
    host = c.rlike(rf"(?i)https?:/{{1,3}}[^\s/]|//(?:[^/@\s]*@)?[a-z0-9.\-]+[.](?:{GENERIC_TLDS}|[a-z]{{2}})(?:[:/?#]|$)")
    return F.coalesce(~F.contains(c, F.lit("mailto:")) & ~c.rlike(URN_ALONE) & scheme & legal & host, F.lit(False))


def url_kind(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("dx.doi.org")), "doi").when(F.contains(c, F.lit("hdl.handle.net")), "hdl").otherwise("url")


def url_parts(c: Column) -> Column:
    """The texts inside a URL that may be identifiers too: its query's values and its base."""
    u = tidy(unquote(c))
    return F.filter(F.transform(F.concat(F.flatten(F.transform(param_pairs(u), lambda x: F.split(x["v"], " "))), F.array(base_url(u))), tidy), lambda v: v != "")


def by_pattern(c: Column) -> Column:
    """array<struct<match_type, value>>: each pattern's first match, with URNs and URLs told apart."""

    def one(kind: str, pattern: str) -> Column:
        m = F.regexp_extract(c, pattern if pattern.startswith("(?i)^") else pattern, 0)
        urn = is_urn(m)
        pair = lambda k, v: F.struct(k.alias("match_type"), v.alias("value"))
        none = F.lit(None).cast("struct<match_type:string,value:string>")
        as_urn = F.when(urn, pair(F.lit("urn"), m)).otherwise(none)
        as_url = F.when(is_url(m) & ~urn, pair(url_kind(m), m)).otherwise(none)
        t = tidy(m)
        plain = F.when((t != "") & (F.lit(kind != "urn") | urn), pair(F.lit(kind), t)).otherwise(none)
        return F.when(m != "", F.array(as_urn, as_url, plain)).otherwise(F.array(none))

    found = F.array_compact(F.flatten(F.array(*[one(k, p) for k, p in PATTERNS])))
    return F.when(looks_like_date(c) | c.isNull(), F.array().cast("array<struct<match_type:string,value:string>>")).otherwise(F.array_distinct(found))


def excluded(match_type: Column, value: Column, parts=EXCLUDED_PARTS, urls=EXCLUDED_URLS) -> Column:
    """URLs are excluded if they equal a known one, all others if they contain a known part."""
    low = F.lower(value)
    has = F.lit(False)
    for p in parts:
        has = has | F.contains(low, F.lit(p.lower()))
    return F.when(match_type == "url", value.isin(*urls)).otherwise(has)


def first_pattern(url: Column) -> Column:
    """struct<match_type, value>: the first pattern that a URL's path or query holds."""
    parts = F.array(F.regexp_extract(url, "^[^?]*", 0), F.regexp_extract(url, r"\?(.*)$", 1))
    none = F.lit(None).cast("struct<match_type:string,value:string>")
    hits = F.flatten(F.transform(parts, lambda p: F.array(*[F.when(F.regexp_extract(p, pattern, 0) != "", F.struct(F.lit(kind).alias("match_type"), F.regexp_extract(p, pattern, 0).alias("value"))).otherwise(none) for kind, pattern in PATTERNS])))
    return F.get(F.array_compact(hits), F.lit(0))


def at_paths(nodes: Column, paths) -> Column:
    """Identifiers in the texts of elements whose local path ends with one of these: array<struct<match_type, value>>."""
    hit = lambda n: F.exists(F.array(*[F.lit(p) for p in paths]), lambda p: (n["path"] == p) | n["path"].endswith(F.concat(F.lit("/"), p)))
    texts = F.filter(F.transform(F.filter(nodes, hit), lambda n: F.trim(n["value"])), lambda v: F.coalesce(v, F.lit("")) != "")
    return F.array_distinct(F.flatten(F.transform(texts, by_pattern)))
