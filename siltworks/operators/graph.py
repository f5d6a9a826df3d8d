"""Entities and edges to RDF triples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ontology's prefixes and the predicate of each entity column.
PREFIXES = {
    "bcube": "http://purl.org/BCube/#", "vcard": "http://www.w3.org/TR/vcard-rdf/#", "esip": "http://purl.org/esip/#", "bibo": "http://purl.org/ontology/bibo/#", "dcat": "http://www.w3.org/TR/vocab-dcat/#", "http": "http://www.w3.org/2011/http#",
    "dc": "http://purl.org/dc/elements/1.1/", "dcterms": "http://purl.org/dc/terms/", "foaf": "http://xmlns.com/foaf/0.1/", "xsd": "http://www.w3.org/2001/XMLSchema#", "owl": "http://www.w3.org/2002/07/owl#", "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
}
TYPES = {"catalog_records": "dcat:CatalogRecord", "webpages": "bibo:WebPage", "urls": "bcube:Url", "layers": "bcube:Layer", "services": "bcube:service", "datasets": "dcat:Dataset", "keywords": "bcube:thesaurusSubset", "publishers": "foaf:Organization", "items": "dcat:Dataset", "rss_items": "dcat:Dataset", "coverages": "bcube:Layer"}
PREDICATES = {
    "title": "dcterms:title", "description": "dc:description", "abstract": "dc:description", "id": "dcterms:identifier", "identifier": "dcterms:identifier", "dateCreated": "bcube:dateCreated", "lastUpdated": "bcube:lastUpdated", "rdf_type": "rdf:type", "spatial_wkt": "dc:spatial", "west": "esip:westBound", "east": "esip:eastBound", "south": "esip:southBound", "north": "esip:northBound",
    "startDate": "esip:startDate", "endDate": "esip:endDate", "partOf": "dc:partOf", "hasType": "bcube:hasType", "hasValue": "bcube:hasValue", "name": "foaf:name", "vcard_hasURL": "vcard:hasURL", "atTime": "bcube:atTime", "httpStatusCode": "http:statusCodeValue", "reasonPhrase": "http:reasonPhrase",
    "statusFamilyCode": "bcube:HTTPStatusFamilyCode", "statusFamilyType": "bcube:HTTPStatusFamilyType", "hasUrlSource": "bcube:hasUrlSource", "hasConfidence": "bcube:hasConfidence", "validatedOn": "bcube:validatedOn", "dc_identifier": "dc:identifier",
}
_TYPED = {"west": "float", "east": "float", "south": "float", "north": "float", "startDate": "date", "endDate": "date"}


def expand(prefixed: Column) -> Column:
    """prefix:name as a URI; unknown prefixes stay as they are."""
    table = F.create_map(*[F.lit(x) for kv in PREFIXES.items() for x in kv])
    uri = table[F.substring_index(prefixed, ":", 1)]
    return F.when(uri.isNotNull(), F.concat(uri, F.regexp_extract(prefixed, "^[^:]*:(.*)$", 1))).otherwise(prefixed)


def _uri(p: str) -> str:
    a, b = p.split(":", 1)
    return PREFIXES[a] + b


def entity_triples(entities: DataFrame, kind: str) -> DataFrame:
    """(s, p, o, o_kind, o_datatype) of one entity type: its type and every non-empty attribute.

    One projection: attributes become an array of structs, lists several of them.
    """

    def said(values: Column, predicate: str, datatype: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(predicate).alias("p"), v.alias("o"), F.lit("literal").alias("o_kind"), datatype.alias("o_datatype")))

    rows = [F.array(F.struct(F.lit(PREFIXES["owl"] + "a").alias("p"), F.lit(_uri(TYPES[kind])).alias("o"), F.lit("uri").alias("o_kind"), F.lit(None).cast("string").alias("o_datatype")))]
    for c, t in entities.dtypes:
        if c not in PREDICATES:
            continue
        values = F.col(c) if t.startswith("array") else F.array(F.col(c))
        dt = F.lit(PREFIXES["xsd"] + _TYPED[c] if c in _TYPED else None).cast("string")
        full = F.filter(F.transform(values, lambda v: v.cast("string")), lambda v: v.isNotNull() & (v != ""))
        rows.append(said(full, _uri(PREDICATES[c]), dt))
    return entities.where("object_id IS NOT NULL").select(F.col("object_id").alias("s"), F.inline(F.concat(*rows)))


def edge_triples(edges: DataFrame) -> DataFrame:
    """Relations; whether the target exists is not asked here."""
    return edges.where("src_id IS NOT NULL AND dst_id IS NOT NULL").select(F.col("src_id").alias("s"), expand(F.col("relate")).alias("p"), F.col("dst_id").alias("o"), F.lit("uri").alias("o_kind"), F.lit(None).cast("string").alias("o_datatype"))


def to_triples(described: dict[str, DataFrame]) -> DataFrame:
    """The graph of a reader's entities: a set, so equal triples are one."""
    parts = [entity_triples(described[k], k) for k in TYPES if k in described and "object_id" in described[k].columns]
    if "edges" in described:
        parts.append(edge_triples(described["edges"]))
    return reduce(DataFrame.unionByName, parts).distinct()


def n_triples(triples: DataFrame) -> DataFrame:
    """One line of N-Triples (a subset of Turtle) per triple."""
    esc = F.col("o")
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        esc = F.replace(esc, F.lit(a), F.lit(b))
    literal = F.concat(F.lit('"'), esc, F.lit('"'), F.when(F.col("o_datatype").isNotNull(), F.concat(F.lit("^^<"), F.col("o_datatype"), F.lit(">"))).otherwise(""))
    o = F.when(F.col("o_kind") == "uri", F.concat(F.lit("<"), F.col("o"), F.lit(">"))).otherwise(literal)
    return triples.select(F.concat(F.lit("<"), F.col("s"), F.lit("> <"), F.col("p"), F.lit("> "), o, F.lit(" .")).alias("value"))
