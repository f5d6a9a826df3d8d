"""XML by the JVM's XPath, for well-formed texts; anything else gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import well_formed


def parseable(content: Column) -> Column:
    """The text without DOCTYPE if it is well-formed, else null."""
    bare = F.regexp_replace(content, r"(?s)<!DOCTYPE[^>\[]*(?:\[.*?\])?\s*>", "")
    return F.when(well_formed(bare), bare)


def local_path(tags) -> str:
    """XPath of local names; ``@x`` is an attribute, ``*``, ``..``, ``.`` and ``//*`` stay."""
    steps = [t if t in ("*", "..", ".", "//*") else f"@*[local-name()='{t[1:]}']" if t.startswith("@") else f"*[local-name()='{t}']" for t in tags]
    return "/".join(steps)


def rooted(path: str) -> str:
    """A path for Spark's XPath, whose context is the document: ``@x`` means the root element's."""
    if path.startswith("@"):
        return f"/*/@*[local-name()='{path[1:].split(':')[-1]}']"
    return path


def items(xml: Column, path: str) -> Column:
    """The trimmed texts of all matches that have text."""
    got = F.xpath(xml, F.lit(path if path.endswith("text()") or "/@" in path or path.startswith("@") else f"{path}/text()"))
    return F.filter(F.transform(got, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != ""))


def item(xml: Column, path: str) -> Column:
    """The first match's text, '' if there is none."""
    return F.coalesce(F.get(items(xml, path), F.lit(0)), F.lit(""))


def attribs(xml: Column, path: str) -> Column:
    """All values of an attribute, with white space collapsed."""
    return F.transform(F.xpath(xml, F.lit(path)), lambda v: F.trim(F.regexp_replace(v, r"\s+", " ")))


def namespaces(content: Column) -> Column:
    """map<prefix, uri>: first declaration of each URI; the default one is named default."""
    raw = F.regexp_extract_all(content, F.lit(r"""xmlns(?::[\w.\-]+)?\s*=\s*(?:"[^"]*"|'[^']*')"""), 0)
    one = F.transform(raw, lambda x: F.struct(F.when(F.instr(x, "xmlns:") == 1, F.regexp_extract(x, r"^xmlns:([\w.\-]+)", 1)).otherwise("default").alias("p"), F.regexp_extract(x, r"""=\s*["']([^"']*)""", 1).alias("u")))
    first = F.filter(one, lambda x, i: F.size(F.filter(F.slice(one, F.lit(1), i), lambda y: y["u"] == x["u"])) == 0)
    named = F.transform(first, lambda x, i: F.struct(F.when(F.size(F.filter(F.slice(first, F.lit(1), i), lambda y: y["p"] == x["p"])) > 0, F.concat(x["p"], i.cast("string"))).otherwise(x["p"]).alias("p"), x["u"].alias("u")))
    return F.map_from_entries(named)


def element_tag(c: Column) -> Column:
    """The local name of ``{uri}name``."""
    return F.substring_index(c, "}", -1)


def tidy_map(m: Column) -> Column:
    """A map without empty values."""
    return F.map_filter(m, lambda k, v: v.isNotNull() & (v != ""))


def header_map(headers: Column) -> Column:
    """``name: value`` lines as a map with lower-case names; the last of a name wins."""
    pairs = F.transform(F.filter(headers, lambda h: F.instr(h, ":") > 0), lambda h: F.struct(F.lower(F.trim(F.substring_index(h, ":", 1))).alias("k"), F.trim(F.regexp_extract(h, r"^[^:]*:(.*)$", 1)).alias("v")))
    last = F.filter(pairs, lambda x, i: F.size(F.filter(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["k"] == x["k"])) == 0)
    return F.map_from_entries(last)


def http_method(c: Column) -> Column:
    return F.when(F.lower(c) == "get", "HTTP GET").when(F.lower(c) == "post", "HTTP POST").otherwise(c)
