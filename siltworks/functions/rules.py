"""Declarative identification rules, compiled to column expressions.

A rule names a standard and says when a document follows it, as a tree of
predicates over its content and URL. Rules are objects of this module or YAML files;
``compile_match`` turns them into one array expression per document, so all rules
are evaluated in one narrow projection. Predicates that test the root element's
name compare the name that was read once, instead of running XPath.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .xml import rooted


@dataclass(frozen=True)
class Contains:
    """The content or URL contains a text, in any case."""

    of: str
    value: str


@dataclass(frozen=True)
class Matches:
    """The content or URL matches a pattern; case counts."""

    of: str
    pattern: str


@dataclass(frozen=True)
class XPath:
    """An XPath over the content is true, or finds something."""

    path: str


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Any_:
    parts: tuple


def all_of(*p) -> All:
    return All(p)


def any_of(*p) -> Any_:
    return Any_(p)


def content(v: str) -> Contains:
    return Contains("content", v)


def url(v: str) -> Contains:
    return Contains("url", v)


@dataclass(frozen=True)
class Rule:
    """One standard's rule. Values are (predicate, text) defaults and XPaths, in order."""

    protocol: str
    kind: str
    name: str
    when: object
    request: str = ""
    versions: tuple = ()
    language: tuple = ()
    dialect: tuple = ()
    errors: object = None
    order: int = field(default=0, compare=False)


#: columns that predicates read: content, url, xml (well-formed content or null), root;
#: upper_content and upper_url where they are at hand, so that they are not made anew in every condition
COLUMNS = {"content": "content", "url": "url", "xml": "xml", "root": "root"}
_ROOT_TEST = re.compile(r"""^/\*\[\s*local-name\(\)\s*=\s*["']([^"']+)["']\s*\]$""")
ROOT_PATTERN = r"(?s)^\s*(?:<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[.*?\])?\s*>|\s)*<(?:[\w.\-]+:)?([\w.\-]+)"


def root_name(content_: Column) -> Column:
    """The local name of the first element."""
    return F.regexp_extract(content_, ROOT_PATTERN, 1)


def compile_predicate(p, cols: dict[str, str] = COLUMNS) -> Column:
    """A predicate as a boolean that is never null."""
    if isinstance(p, Contains):
        upper = F.col(cols[f"upper_{p.of}"]) if f"upper_{p.of}" in cols else F.upper(F.col(cols[p.of]))
        return F.coalesce(F.contains(upper, F.lit(p.value.upper())), F.lit(False))
    if isinstance(p, Matches):
        return F.coalesce(F.col(cols[p.of]).rlike(p.pattern), F.lit(False))
    if isinstance(p, XPath):
        if m := _ROOT_TEST.match(p.path.strip()):
            return F.coalesce(F.col(cols["xml"]).isNotNull() & (F.col(cols["root"]) == m[1]), F.lit(False))
        return F.coalesce(F.xpath_boolean(F.col(cols["xml"]), F.lit(rooted(p.path))), F.lit(False))
    if isinstance(p, All):
        return reduce(lambda a, b: a & b, [compile_predicate(x, cols) for x in p.parts], F.lit(True))
    if isinstance(p, Any_):
        return reduce(lambda a, b: a | b, [compile_predicate(x, cols) for x in p.parts], F.lit(False))
    raise TypeError(p)


def compile_values(values: tuple, cols: dict[str, str] = COLUMNS) -> Column:
    """All values that apply, defaults first; null if none does."""
    out = []
    for v in values:
        if isinstance(v, tuple):
            out.append(F.when(compile_predicate(v[0], cols), F.array(F.lit(v[1]))).otherwise(F.array().cast("array<string>")))
        elif v.lstrip().startswith("concat("):
            out.append(F.array(F.regexp_replace(F.trim(F.xpath_string(F.col(cols["xml"]), F.lit(rooted(v)))), r"\s+", " ")))
        else:
            out.append(F.transform(F.xpath(F.col(cols["xml"]), F.lit(rooted(v))), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))))
    if not out:
        return F.lit(None).cast("array<string>")
    kept = F.filter(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in out]), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.when(F.size(kept) > 0, kept)


def compile_match(rules: list[Rule], cols: dict[str, str] = COLUMNS) -> Column:
    """The identities of a document, as an array of structs in the order of the rules.

    Versions, languages, dialects and errors are computed only where a rule matches.
    """
    none = F.lit(None).cast("struct<rule_order:int,protocol:string,kind:string,name:string,request:string,dialect:array<string>,version:array<string>,language:array<string>,error:boolean>")
    found = []
    for i, r in enumerate(rules):
        error = compile_predicate(r.errors, cols) if r.errors is not None else F.lit(False)
        hit = F.struct(
            F.lit(i).alias("rule_order"), F.lit(r.protocol).alias("protocol"), F.lit(r.kind).alias("kind"), F.lit(r.name).alias("name"), F.when(F.lit(r.request) != "", F.lit(r.request)).alias("request"),
            compile_values(r.dialect, cols).alias("dialect"), compile_values(r.versions, cols).alias("version"), compile_values(r.language, cols).alias("language"), F.when(error, F.lit(True)).alias("error"),
        )
        found.append(F.when(compile_predicate(r.when, cols), hit).otherwise(none))
    return F.array_compact(F.array(*found))


def urn(identity: Column) -> Column:
    """urn:<protocol>:<name>:<version>, with UNK for what is not known."""
    part = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("UNK"))
    return F.concat_ws(":", F.lit("urn"), part(identity["protocol"]), part(identity["name"]), part(F.get(identity["version"], F.lit(0))))


# --- rules from YAML ------------------------------------------------------------------


def _predicate(node) -> object:
    kind = node.get("type")
    if kind == "complex":
        group = [_predicate(x) for x in node.get("filters") or []]
        return All(tuple(group)) if node.get("operator") == "ands" else Any_(tuple(group))
    if kind == "simple":
        return Contains(node.get("object", "content"), str(node["value"]))
    if kind == "regex":
        return Matches(node.get("object", "content"), str(node["value"]))
    if kind == "xpath":
        return XPath(str(node["value"]))
    raise ValueError(f"unknown filter type {kind!r}")


def _groups(node) -> object | None:
    """Sibling operators of a filter block are alternatives; within ands all must hold."""
    if not node:
        return None
    out = []
    for op, filters in node.items():
        parts = tuple(_predicate(x) for x in filters or [])
        out.append(All(parts) if op == "ands" else Any_(parts))
    return out[0] if len(out) == 1 else Any_(tuple(out))


def _values(node) -> tuple:
    out: list = []
    for block in ("defaults", "checks"):
        for filters in ((node or {}).get(block) or {}).values():
            for f in filters or []:
                out.append((_predicate(f), str(f.get("text", ""))) if block == "defaults" else str(f["value"]))
    if (node or {}).get("text"):
        out.insert(0, (All(()), str(node["text"])))
    return tuple(out)


def load_rules(*texts: str) -> list[Rule]:
    """Rules of YAML texts, in the order of the texts. Options without filters never match."""
    import yaml

    rules: list[Rule] = []
    for t in texts:
        for standard in yaml.safe_load(t) or []:
            for kind, options in standard.items():
                if kind == "name":
                    continue
                for o in options or []:
                    when = _groups(o.get("filters"))
                    if when is None:
                        continue
                    errors = (o.get("errors") or {}).get("filters")
                    rules.append(Rule(str(standard["name"]), kind, str(o["name"]), when, str(o.get("request") or ""), _values(o.get("versions")), _values(o.get("language")), _values(o.get("dialect")), _groups(errors), len(rules)))
    return rules
