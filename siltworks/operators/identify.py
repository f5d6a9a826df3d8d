"""Identification of documents: all rules in one projection, first match, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, compile_match, root_name
from ..functions.standards import STANDARD
from ..functions.xml import parseable

#: protocol -> reader
ROUTES = {"OGC": "ogc", "ISO": "iso", "FGDC": "fgdc", "DIF": "dif", "DC": "dc", "OAI-PMH": "oaipmh", "OpenSearch": "opensearch", "UNIDATA": "thredds", "OPeNDAP": "ncml", "RDF": "rdf", "RSS": "feed", "ATOM": "feed"}


def identify(docs: DataFrame, rules: list[Rule] = STANDARD, content: str = "content", url: str = "url") -> DataFrame:
    """Adds identities, all matching rules in order: null content matches nothing.

    Narrow: each document meets every rule where it lies; rules are expressions,
    not rows, so nothing is joined.
    """
    named = docs.withColumn("_content", F.col(content)).withColumn("_url", F.col(url)).withColumn("_xml", parseable(F.col(content))).withColumn("_root", root_name(F.col(content)))
    cols = {"content": "_content", "url": "_url", "xml": "_xml", "root": "_root", "upper_content": "_upper", "upper_url": "_upper_url"}
    named = named.withColumn("_upper", F.upper("_content")).withColumn("_upper_url", F.upper("_url"))
    return named.withColumn("identities", compile_match(rules, cols)).drop(*cols.values())


def first_identity(identities: Column) -> Column:
    return F.get(identities, F.lit(0))


def route(identity: Column, ignore: tuple[str, ...] = (), parse_as_xml: tuple[str, ...] = ()) -> Column:
    """The reader for an identity: null for ignored protocols and those without reader."""
    p = identity["protocol"]
    out = F.when(p.isin(*ignore), F.lit(None)) if ignore else F.when(F.lit(False), F.lit(None))
    for name, reader in ROUTES.items():
        out = out.when(p == name, F.when((identity["name"] == "CSW") & (identity["kind"] == "resultset"), F.lit("csw")).otherwise(F.lit(reader)))
    if parse_as_xml:
        out = out.when(p.isin(*parse_as_xml), "xml")
    return out.cast("string")


def routed(rules: list[Rule]) -> list[str]:
    """Every reader that route() can give for what these rules identify."""
    return list(dict.fromkeys("csw" if r.name == "CSW" and r.kind == "resultset" else ROUTES[r.protocol] for r in rules if r.protocol in ROUTES))
