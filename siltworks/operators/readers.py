"""Documents to entities: one projection per entity type over a document's nodes.

Each reader takes a DataFrame with (doc_id, url, harvest_date, nodes, namespaces), as
``shred`` makes it, and returns a dict of DataFrames with fixed schemas: datasets,
services, layers, keywords, publishers, urls, webpages, catalog_records, edges,
items. All are narrow higher-order projections; what is read of each of many items of
a document is read from the item's own slice of the nodes (``each``), so the work is
in proportion to the document. ids are hashes of the document and
the entity's place or natural key, so a retried task makes the same ids. Missing
values are null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import short_date, time_range, timestamp
from ..functions.geo import bbox_wkt, epsg, gml_polygon, reprojected
from ..functions.text import normalize_subjects
from ..functions.ogc_params import default_params
from ..functions.url import ogc_request, opensearch_link, sha_urn, template_params, thredds_urls, uuid_urn
from ..functions.xml import http_method
from ..runtime import Stages
from .shred import Nodes, at_each, each, text_of, xml_values

READERS: dict[str, Callable[[DataFrame], dict[str, DataFrame]]] = {}


def reader(name: str):
    """Registers a reader: the way to plug in one's own."""

    def keep(f):
        READERS[name] = f
        return f

    return keep


def _n() -> Nodes:
    return Nodes(F.col("nodes"))


def _blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _id(kind: str, *parts) -> Column:
    return uuid_urn(F.col("doc_id"), F.lit(kind), *parts)


def url_entity(link: Column, source: str = "Harvested", confidence: str = "Good") -> Column:
    """A URL's entity with the constants of a successful harvest."""
    sha = sha_urn(link)
    return F.struct(
        uuid_urn(F.col("doc_id"), F.lit("url"), sha).alias("object_id"), link.alias("vcard_hasURL"), F.col("harvest_date").alias("atTime"), F.lit(200).alias("httpStatusCode"), F.lit("OK").alias("reasonPhrase"),
        F.lit(200).alias("statusFamilyCode"), F.lit("Success message").alias("statusFamilyType"), F.lit(source).alias("hasUrlSource"), F.lit(confidence).alias("hasConfidence"), F.col("harvest_date").alias("validatedOn"), sha.alias("dc_identifier"),
    )


_KEEP = ["doc_id", "url", "harvest_date"]


def _each(docs: DataFrame, found: Column, *keep: str, **more) -> DataFrame:
    return each(docs, found, [*_KEEP, *keep], **more)


def _url_id(link: Column) -> Column:
    return uuid_urn(F.col("doc_id"), F.lit("url"), sha_urn(link))


def urls_of(docs: DataFrame, links: Column, source: str = "Harvested", confidence: str = "Good", rows: DataFrame | None = None) -> DataFrame:
    """URL entities of the harvested URL and of ``links`` (of ``rows``, if they are not the documents), each once a row."""
    other = F.array_distinct(F.filter(links, lambda x: x.isNotNull() & (x != "") & ~F.coalesce(x == F.col("url"), F.lit(False))))
    own = docs.where("url IS NOT NULL").select("doc_id", url_entity(F.col("url")).alias("u"))
    more = (docs if rows is None else rows).withColumn("link", F.explode(other)).select("doc_id", url_entity(F.col("link"), source, confidence).alias("u"))
    return own.unionAll(more).select("doc_id", "u.*")


def _catalog(docs: DataFrame, kind: str) -> DataFrame:
    return docs.select("doc_id", _id("catalog").alias("object_id"), F.lit(kind).alias("rdf_type"), F.col("harvest_date").alias("dateCreated"), F.col("harvest_date").alias("lastUpdated"))


def edges(docs: DataFrame, *pairs: tuple[Column, str, Column]) -> DataFrame:
    """(doc_id, src_id, relate, dst_id) of (source, relate, target or array of targets)."""

    def of(src: Column, rel: str, dst: Column) -> Column:
        return F.transform(dst, lambda d: F.struct(src.alias("src_id"), F.lit(rel).alias("relate"), d.alias("dst_id")))

    all_ = F.flatten(F.array(*[of(*p) for p in pairs]))
    return docs.select("doc_id", F.inline(all_))


# --- items: Dublin Core, DIF, feeds --------------------------------------------------------



def _item_id() -> Column:
    """The id of an item, in a row of ``each``."""
    return _id("item", F.col("e.dewey")).alias("object_id")


def dc_item(n: Nodes) -> Column:
    return F.struct(
        n.text("title").alias("title"), n.text("creator").alias("creator"), n.texts("subject").alias("subjects"), n.text("description").alias("abstract"), n.text("date").alias("date"),
        n.text("language").alias("language"), n.text("publisher").alias("publisher"), n.texts("type").alias("types"), n.texts("source").alias("sources"),
    )


@reader("dc")
def read_dc(docs: DataFrame) -> dict[str, DataFrame]:
    """Dublin Core records, wherever a dc element stands."""
    n = _n()
    items = _each(docs, n.named("dc")).select("doc_id", _item_id(), dc_item(at_each()).alias("i")).select("doc_id", "object_id", "i.*")
    return {"items": items, "catalog_records": _catalog(docs, "DC"), "urls": urls_of(docs, F.array().cast("array<string>"))}


def dif_item(n: Nodes) -> Column:
    sp = lambda k: n.text("Spatial_Coverage", k)
    begin, end = n.text("Temporal_Coverage", "Start_Date"), n.text("Temporal_Coverage", "End_Date")
    box = [sp(f"{s}_{a}") for s, a in (("Westernmost", "Longitude"), ("Southernmost", "Latitude"), ("Easternmost", "Longitude"), ("Northernmost", "Latitude"))]

    def dist(e: Column) -> Column:
        d = n.at(e)
        return F.struct(d.text("URL").alias("url"), d.text("Description").alias("description"), d.text("URL_Content_Type", "Type").alias("content_type"))

    return F.struct(
        n.text("Entry_ID").alias("id"), n.text("Entry_Title").alias("title"), F.concat(n.texts("Keyword"), n.texts("ISO_Topic_Category")).alias("keywords"), n.text("Summary").alias("abstract"), n.text("Originating_Center").alias("organization"),
        _blank(bbox_wkt(*box)).alias("bbox"), F.when(begin.isNotNull() & end.isNotNull(), F.array(begin, end)).alias("temporal"), F.transform(n.elems("Related_URL"), dist).alias("distributions"),
    )


@reader("dif")
def read_dif(docs: DataFrame) -> dict[str, DataFrame]:
    n = _n()
    items = _each(docs, n.named("DIF")).select("doc_id", _item_id(), dif_item(at_each()).alias("i")).select("doc_id", "object_id", "i.*")
    return {"items": items, "catalog_records": _catalog(docs, "DIF"), "urls": urls_of(docs, n.texts("DIF", "Related_URL", "URL"))}


def atom_entry(n: Nodes) -> Column:
    def link(e: Column) -> Column:
        a = n.at(e)
        return F.struct(a.attr("href").alias("href"), a.attr("rel").alias("rel"), a.attr("type").alias("type"))

    def content(e: Column) -> Column:
        return F.struct(F.trim(e["value"]).alias("content"), n.at(e).attr("type").alias("content_type"))

    own = n.children
    named = lambda *names: F.filter(own(), lambda c: c["name"].isin(*names))
    subjects = F.transform(named("category"), lambda c: F.coalesce(n.at(c).attr("term"), F.trim(c["value"])))
    return F.struct(
        n.text("title").alias("title"), n.text("id").alias("id"), n.text("creator").alias("creator"), F.coalesce(n.text("author", "name"), n.text("author")).alias("author"), n.text("date").alias("date"), n.text("updated").alias("updated"), n.text("published").alias("published"),
        F.concat(subjects, n.texts("subject")).alias("subjects"), F.transform(named("content", "summary"), content).alias("contents"), F.transform(named("link"), link).alias("links"),
    )


def rss_item(n: Nodes) -> Column:
    return F.struct(
        n.text("title").alias("title"), n.text("language").alias("language"), n.text("author").alias("author"), n.text("encoded").alias("encoded"), F.coalesce(n.text("guid"), n.text("id")).alias("id"), n.text("creator").alias("creator"), n.texts("category").alias("subjects"),
        F.coalesce(n.text("pubDate"), n.text("published")).alias("published"), n.text("date").alias("timestamp"), F.concat(n.texts("link"), n.texts("docs")).alias("links"),
    )


@reader("feed")
def read_feed(docs: DataFrame) -> dict[str, DataFrame]:
    """Atom and RSS feeds: header, totals and items; the dialect by the namespaces."""
    n = _n()
    atom = F.exists(F.map_values("namespaces"), lambda u: F.contains(F.lower(u), F.lit("atom"))) | (F.size(n.elems("feed")) > 0)
    number = lambda name: F.get(F.transform(n.named(name), lambda e: F.trim(e["value"])), F.lit(0)).try_cast("int")
    top = lambda name: F.coalesce(n.text("feed", name), n.text("rss", "channel", name))
    head = docs.select("doc_id", F.when(atom, "atom").otherwise("rss").alias("dialect"), top("title").alias("title"), F.coalesce(top("subtitle"), top("description")).alias("description"), number("totalResults").alias("total"), number("startIndex").alias("subtotal"), number("itemsPerPage").alias("per_page"))
    entries = _each(docs, n.named("entry")).select("doc_id", _item_id(), atom_entry(at_each()).alias("i")).select("doc_id", "object_id", "i.*")
    items = _each(docs, n.named("item")).select("doc_id", _item_id(), rss_item(at_each()).alias("i")).select("doc_id", "object_id", "i.*")
    return {"services": head, "items": entries, "rss_items": items, "urls": urls_of(docs, F.array().cast("array<string>"))}


# --- FGDC ---------------------------------------------------------------------------------


@reader("fgdc")
def read_fgdc(docs: DataFrame) -> dict[str, DataFrame]:
    """Catalog record, dataset, publisher, distribution URLs, web pages and keyword sets.

    A record is a document's root or stands among a catalogue's search results.
    """
    rows = _each(docs, F.filter(F.col("nodes"), lambda x: (x["kind"] == "elem") & (x["name"] == "metadata") & ((x["parent_id"] == -1) | x["path"].endswith("/SearchResults/metadata"))))
    n, own = at_each(), F.col("e.dewey")
    i = lambda *p: n.text("idinfo", *p)
    cite = lambda *p: i("citation", "citeinfo", *p)
    box = {k: i("spdom", "bounding", f"{k}bc") for k in ("west", "south", "east", "north")}
    single, begin, end = i("timeperd", "timeinfo", "sngdate", "caldate"), i("timeperd", "timeinfo", "rngdates", "begdate"), i("timeperd", "timeinfo", "rngdates", "enddate")
    ds, pub, cat = _id("dataset", own), _id("publisher", own), _id("catalog", own)
    dataset = rows.select(
        "doc_id", ds.alias("object_id"), i("datsetid").alias("identifier"), cite("title").alias("title"), i("descript", "abstract").alias("description"), _blank(bbox_wkt(box["west"], box["south"], box["east"], box["north"])).alias("spatial_wkt"),
        *[box[k].try_cast("double").alias(k) for k in ("west", "east", "south", "north")], _blank(short_date(F.coalesce(begin, single))).alias("startDate"), _blank(short_date(end)).alias("endDate"), F.col("harvest_date").alias("dateCreated"),
    )
    publisher = rows.select("doc_id", pub.alias("object_id"), cite("pubinfo", "publish").alias("name"), cite("pubinfo", "pubplace").alias("location"))
    dist = n.texts("distinfo", "stdorder", "digform", "digtopt", "onlinopt", "computer", "networka", "networkr")
    online = n.texts("idinfo", "citation", "citeinfo", "onlink")
    new = lambda a: F.array_distinct(F.filter(a, lambda x: ~F.coalesce(x == F.col("url"), F.lit(False))))
    pages = F.array_except(new(online), new(dist))
    page_ids = F.transform(pages, lambda x: _id("webpage", sha_urn(x)))
    short = F.create_map(F.lit("stratum"), F.lit("strat"), F.lit("temporal"), F.lit("temp"))

    def keys(e: Column) -> Column:
        tag = F.coalesce(short[e["name"]], e["name"])
        vals = lambda suffix: F.filter(F.transform(F.filter(n.at(e).children(), lambda x: x["name"] == F.concat(tag, F.lit(suffix))), text_of), lambda v: F.coalesce(v, F.lit("")) != "")
        return F.struct(_id("keywords", e["dewey"]).alias("object_id"), F.get(vals("kt"), F.lit(0)).alias("partOf"), e["name"].alias("hasType"), vals("key").alias("hasValue"))

    groups = F.flatten(F.transform(n.elems("idinfo", "keywords"), lambda g: n.at(g).children()))
    sets = F.filter(F.transform(groups, keys), lambda s: F.size(s["hasValue"]) > 0)
    return {
        "catalog_records": rows.select("doc_id", cat.alias("object_id"), F.lit("FGDC:CSDGM").alias("rdf_type"), F.col("harvest_date").alias("dateCreated"), F.col("harvest_date").alias("lastUpdated")),
        "datasets": dataset,
        "publishers": publisher,
        "urls": urls_of(docs, F.concat(dist, online), rows=rows),
        "webpages": rows.select("doc_id", F.explode(page_ids).alias("object_id")),
        "keywords": rows.select("doc_id", F.inline(sets)),
        "edges": edges(
            rows,
            (cat, "bcube:originatedFrom", F.array(_url_id(F.col("url")))),
            (ds, "bcube:hasMetadataRecord", F.array(cat)),
            (ds, "dcterms:publisher", F.array(pub)),
            (ds, "dcterms:references", F.transform(new(dist), _url_id)),
            (ds, "dcterms:references", page_ids),
            (ds, "dc:conformsTo", F.transform(sets, lambda s: s["object_id"])),
            (cat, "foaf:primaryTopic", F.array(ds)),
        ),
    }


# --- ISO ----------------------------------------------------------------------------------

_CS = "CharacterString"


def iso_party(n: Nodes) -> Column:
    """A responsible party with its nested contact."""
    a = ("contactInfo", "CI_Contact", "address", "CI_Address")
    return F.struct(
        n.text("individualName", _CS).alias("individual"), n.text("organisationName", _CS).alias("organization"), n.text("positionName", _CS).alias("position"), n.attr("role", "CI_RoleCode", "codeListValue").alias("role"),
        F.struct(n.text("contactInfo", "CI_Contact", "phone", "CI_Telephone", "voice", _CS).alias("phone"), n.text(*a, "deliveryPoint", _CS).alias("street"), n.text(*a, "city", _CS).alias("city"), n.text(*a, "country", _CS).alias("country"), n.text(*a, "electronicMailAddress", _CS).alias("email")).alias("contact"),
    )


def iso_identifiers(n: Nodes) -> Column:
    """A record's own identifiers: file identifier, citation code, data set URI."""
    return F.array_compact(F.array(n.text("fileIdentifier", _CS), n.text("identificationInfo", "MD_DataIdentification", "citation", "CI_Citation", "identifier", "MD_Identifier", "code", _CS), n.text("dataSetURI", _CS)))


def iso_dataset(n: Nodes) -> Column:
    """One MD_DataIdentification: texts, extent (a polygon before a box), times."""
    ex = ("extent", "EX_Extent")
    geo = (*ex, "geographicElement")
    box = {k: n.text(*geo, "EX_GeographicBoundingBox", f, "Decimal") for k, f in (("west", "westBoundLongitude"), ("south", "southBoundLatitude"), ("east", "eastBoundLongitude"), ("north", "northBoundLatitude"))}
    poly = (*geo, "EX_BoundingPolygon", "polygon", "Polygon")
    inner = F.filter(n.named("pos", "posList"), lambda x: F.contains(x["path"], F.lit("/".join(poly))))
    ring = reprojected(_blank(gml_polygon(F.transform(inner, lambda x: F.trim(x["value"])))), n.attr(*poly, "srsName"))
    time = (*ex, "temporalElement", "EX_TemporalExtent", "extent", "TimePeriod")
    iso_time = lambda c: F.date_format(timestamp(c), "yyyy-MM-dd'T'HH:mm:ss")
    cite = ("citation", "CI_Citation")
    return F.struct(
        n.text(*cite, "identifier", "MD_Identifier", "code", _CS).alias("identifier"), n.text(*cite, "title", _CS).alias("title"), n.text("abstract", _CS).alias("description"),
        F.coalesce(ring, _blank(bbox_wkt(box["west"], box["south"], box["east"], box["north"]))).alias("spatial_wkt"), *[box[k].try_cast("double").alias(k) for k in ("west", "east", "south", "north")],
        iso_time(n.text(*time, "beginPosition")).alias("startDate"), iso_time(n.text(*time, "endPosition")).alias("endDate"),
    )


def iso_keywords(n: Nodes) -> Column:
    """The keyword sets of an identification, and one of its topic categories."""

    def one(e: Column) -> Column:
        k = n.at(e)
        return F.struct(_id("keywords", e["dewey"]).alias("object_id"), k.text("MD_Keywords", "thesaurusName", "CI_Citation", "title", _CS).alias("partOf"), k.attr("MD_Keywords", "type", "MD_KeywordTypeCode", "codeListValue").alias("hasType"), k.texts("MD_Keywords", "keyword", _CS).alias("hasValue"))

    topics = n.texts("topicCategory", "MD_TopicCategoryCode")
    iso = F.struct(_id("keywords", F.concat(n.root["dewey"], F.lit("topics"))).alias("object_id"), F.lit("IsoTopicCategories").alias("partOf"), F.lit(None).cast("string").alias("hasType"), topics.alias("hasValue"))
    return F.filter(F.concat(F.transform(n.elems("descriptiveKeywords"), one), F.array(iso)), lambda s: F.size(s["hasValue"]) > 0)


@reader("iso")
def read_iso(docs: DataFrame) -> dict[str, DataFrame]:
    """19115 records, data series with their records, and 19119 services."""
    n, at, dewey = _n(), at_each(), F.col("e.dewey")
    ident = _each(docs, n.named("MD_DataIdentification"))
    datasets = ident.select("doc_id", _id("dataset", dewey).alias("object_id"), iso_dataset(at).alias("d"), F.col("harvest_date").alias("dateCreated")).select("doc_id", "object_id", "d.*", "dateCreated")
    parties = _each(docs, n.named("CI_ResponsibleParty")).select("doc_id", _id("publisher", dewey).alias("object_id"), iso_party(at).alias("p"))
    publishers = parties.where("p.role = 'publisher'").select("doc_id", "object_id", F.col("p.organization").alias("name"), F.col("p.contact.city").alias("location"))

    def operation(e: Column) -> Column:
        o = at.at(e)

        def param(x: Column) -> Column:
            q = at.at(x)
            return F.struct(
                q.text("name", "aName", _CS).alias("name"), q.text("direction", "SV_ParameterDirection").alias("direction"), q.text("optionality", _CS).alias("optional"), F.coalesce(q.text("repeatability", "Boolean"), q.text("repeatability", _CS)).alias("cardinality"), q.text("valueType", "TypeName", "aName", _CS).alias("valueType")
            )

        return F.struct(o.text("operationName", _CS).alias("name"), o.attr("DCP", "DCPList", "codeListValue").alias("method"), o.text("connectPoint", "CI_OnlineResource", "linkage", "URL").alias("url"), F.transform(o.elems("parameters", "SV_Parameter"), param).alias("parameters"))

    srv = _each(docs, n.named("SV_ServiceIdentification"))
    services = srv.select("doc_id", _id("service", dewey).alias("object_id"), at.text("citation", "CI_Citation", "title", _CS).alias("title"), at.text("abstract", _CS).alias("description"), F.transform(at.elems("containsOperations", "SV_OperationMetadata"), operation).alias("operations"))

    # a record's links are those of its own subtree
    records = _each(docs, n.named("MD_Metadata", "MI_Metadata"))
    links = F.filter(F.transform(F.filter(at.named("URL"), lambda x: x["path"].endswith("MD_DigitalTransferOptions/onLine/CI_OnlineResource/linkage/URL")), text_of), lambda v: F.coalesce(v, F.lit("")) != "")
    url_ids = F.transform(F.array_distinct(links), _url_id)
    edge = lambda src, rel, dst: F.struct(src.alias("src_id"), F.lit(rel).alias("relate"), dst.alias("dst_id"))
    cited = F.flatten(F.transform(at.named("MD_DataIdentification"), lambda e: F.transform(url_ids, lambda u: edge(_id("dataset", e["dewey"]), "dcterms:references", u))))

    # a series: its own record and those that it is made of
    series = _each(docs, n.named("DS_Series"))
    below = lambda *p: F.flatten(F.array(*[at.elems(*p, m, "identificationInfo", "MD_DataIdentification") for m in ("MD_Metadata", "MI_Metadata")]))
    ids = lambda found: F.transform(found, lambda e: _id("dataset", e["dewey"]))
    head, parts = F.get(ids(below("seriesMetadata")), F.lit(0)), ids(below("composedOf", "DS_DataSet", "has"))
    own, cat = _id("dataset", dewey), _id("catalog")
    return {
        "catalog_records": _catalog(docs, "ISO 19115:2003/19139"),
        "datasets": datasets,
        "series": series.select("doc_id", head.alias("object_id"), parts.alias("children")),
        "keywords": ident.select("doc_id", F.inline(iso_keywords(at))),
        "publishers": publishers,
        "parties": parties.select("doc_id", "object_id", "p.*"),
        "services": services,
        "urls": urls_of(docs, links, rows=records),
        "identifiers": records.select("doc_id", F.explode(iso_identifiers(at)).alias("identifier")),
        "edges": edges(ident, (own, "bcube:hasMetadataRecord", F.array(cat)), (cat, "foaf:primaryTopic", F.array(own)), (own, "dc:conformsTo", F.transform(iso_keywords(at), lambda s: s["object_id"])))
        .unionByName(records.select("doc_id", F.inline(cited)))
        .unionByName(edges(series, (head, "bcube:contains", parts))),
    }


# --- services: OpenSearch, OAI-PMH, CSW, OGC -----------------------------------------------


@reader("opensearch")
def read_opensearch(docs: DataFrame) -> dict[str, DataFrame]:
    """Descriptions: service, tags, one generated URL and page per template; results: items."""
    n = _n()
    o = lambda *p: n.text("OpenSearchDescription", *p)
    desc = docs.where(F.size(n.elems("OpenSearchDescription")) > 0)
    services = desc.select("doc_id", _id("service").alias("object_id"), F.lit("OpenSearch1.1:Description").alias("rdf_type"), o("ShortName").alias("title"), _blank(F.concat_ws(" ", o("LongName"), o("Description"))).alias("description"), F.col("harvest_date").alias("dateCreated"))
    keywords = desc.where(o("Tags").isNotNull()).select("doc_id", _id("keywords").alias("object_id"), F.lit(None).cast("string").alias("partOf"), F.lit("tags").alias("hasType"), F.filter(F.split(o("Tags"), r"[\s,]+"), lambda t: t != "").alias("hasValue"))

    def endpoint(e: Column) -> Column:
        u = n.at(e)
        return F.struct(u.attr("type").alias("mimeType"), u.attr("template").alias("template"), opensearch_link(u.attr("template")).alias("url"), template_params(u.attr("template")).alias("parameters"))

    ends = F.transform(n.elems("OpenSearchDescription", "Url"), endpoint)
    links = F.array_distinct(F.filter(F.transform(ends, lambda e: e["url"]), lambda u: u.isNotNull()))
    url_ids = F.transform(links, _url_id)
    feed = read_feed(docs)
    return {
        "services": services,
        "keywords": keywords,
        "endpoints": desc.select("doc_id", F.inline(ends)),
        "urls": urls_of(desc, links, "Generated", "Not Sure"),
        "webpages": desc.select("doc_id", F.explode(F.transform(links, lambda x: _id("webpage", sha_urn(x)))).alias("object_id")),
        "items": feed["items"],
        "rss_items": feed["rss_items"],
        "edges": edges(desc, (_id("service"), "bcube:originatedFrom", F.array(_url_id(F.col("url")))), (_id("service"), "dcterms:references", url_ids)),
    }


@reader("oaipmh")
def read_oaipmh(docs: DataFrame) -> dict[str, DataFrame]:
    """Identify answers give a service, record lists their headers with Dublin Core items."""
    n = _n()
    i = lambda p: n.text("OAI-PMH", "Identify", p)
    ident = docs.where(F.size(n.elems("OAI-PMH", "Identify")) > 0)
    services = ident.select("doc_id", _id("service").alias("object_id"), F.lit("OAI-PMH:Identify").alias("rdf_type"), i("repositoryName").alias("title"), i("protocolVersion").alias("version"), F.coalesce(i("baseURL"), n.text("OAI-PMH", "request")).alias("base_url"))
    rec = _each(docs, F.filter(F.col("nodes"), lambda x: (x["kind"] == "elem") & x["path"].isin("OAI-PMH/ListRecords/record", "OAI-PMH/GetRecord/record")))
    at = at_each()
    items = rec.withColumn("d", F.get(at.elems("metadata", "dc"), F.lit(0))).select("doc_id", at.text("header", "identifier").alias("identifier"), at.text("header", "datestamp").alias("datestamp"), _item_id(), dc_item(at.at(F.col("d"))).alias("i")).select("doc_id", "object_id", "identifier", "datestamp", "i.*")
    return {"services": services, "items": items, "urls": urls_of(docs, F.array().cast("array<string>")), "edges": edges(ident, (_id("service"), "bcube:originatedFrom", F.array(_url_id(F.col("url")))))}


@reader("csw")
def read_csw(docs: DataFrame) -> dict[str, DataFrame]:
    """Catalogue results: totals and schema, and the records by their own readers."""
    at = at_each()
    head = _each(docs, _n().named("SearchResults")).select("doc_id", at.attr("numberOfRecordsMatched").try_cast("int").alias("total"), at.attr("numberOfRecordsReturned").try_cast("int").alias("subtotal"), at.attr("recordSchema").alias("record_schema"))
    iso, dif, fgdc = read_iso(docs), read_dif(docs), read_fgdc(docs)
    both = {k: iso[k].unionByName(fgdc[k]) for k in ("datasets", "keywords", "publishers", "edges")}
    return both | {"services": head, "items": dif["items"], "webpages": fgdc["webpages"], "catalog_records": iso["catalog_records"].unionByName(fgdc["catalog_records"]), "urls": iso["urls"].unionByName(fgdc["urls"]).unionByName(dif["urls"]).distinct()}


# Services and versions that are read, namespaces and root elements of the services.
OGC_VERSIONS = {"WMS": ("1.1.1", "1.3.0"), "WFS": ("1.0.0", "1.1.0"), "WCS": ("1.0.0", "1.1.0", "1.1.1", "1.1.2"), "CSW": ("2.0.2",), "SOS": ("1.0.0",)}
_SPACE_SERVICE = (("opengis.net/cat/csw", "CSW"), ("opengis.net/sos", "SOS"), ("opengis.net/wcs", "WCS"), ("opengis.net/wfs", "WFS"), ("opengis.net/wmts", "WMTS"), ("opengis.net/wms", "WMS"))
_ROOT_SERVICE = (("WMS", ("WMS_Capabilities", "WMT_MS_Capabilities")), ("WFS", ("WFS_Capabilities",)), ("WCS", ("WCS_Capabilities", "CoverageDescription", "CoverageDescriptions")))
_FORMATS = {"XMLSCHEMA": "text/xml", "GML2": "text/xml; subtype=gml/2.1.2"}


def ogc_service(root: Column, stated: Column) -> Column:
    """The service that a root element belongs to: by its name, its namespace, else as the document states it."""
    by_name = F.lit(None).cast("string")
    for name, roots in _ROOT_SERVICE:
        by_name = F.when(root["name"].isin(*roots), name).otherwise(by_name)
    by_space = F.lit(None).cast("string")
    for uri, name in _SPACE_SERVICE:
        by_space = F.when(F.contains(F.lower(root["qname"]), F.lit(uri)), name).otherwise(by_space)
    said = F.regexp_extract(F.upper(stated), "(WMS|WFS|WCS|CSW|SOS)", 1)
    return F.coalesce(by_name, F.when(root["name"] == "Capabilities", F.coalesce(by_space, _blank(said))))


def ogc_layer(n: Nodes) -> Column:
    """A layer, feature type, coverage or offering: names, texts, boxes, times."""
    e = n.root
    geo = lambda k, a: F.coalesce(n.text("EX_GeographicBoundingBox", k), n.attr("LatLonBoundingBox", a), n.attr("LatLongBoundingBox", a))
    corner = lambda tag: F.coalesce(n.text("WGS84BoundingBox", tag), n.text("WGS84BoundingBox", tag))
    low, high = F.split(corner("LowerCorner"), r"\s+"), F.split(corner("UpperCorner"), r"\s+")
    env = F.transform(n.elems("lonLatEnvelope", "pos"), lambda p: F.split(F.trim(p["value"]), r"\s+"))
    pick = lambda *c: F.coalesce(*c).try_cast("double")
    west, south = pick(geo("westBoundLongitude", "minx"), F.get(low, F.lit(0)), F.get(F.get(env, F.lit(0)), F.lit(0))), pick(geo("southBoundLatitude", "miny"), F.get(low, F.lit(1)), F.get(F.get(env, F.lit(0)), F.lit(1)))
    east, north = pick(geo("eastBoundLongitude", "maxx"), F.get(high, F.lit(0)), F.get(F.get(env, F.lit(1)), F.lit(0))), pick(geo("northBoundLatitude", "maxy"), F.get(high, F.lit(1)), F.get(F.get(env, F.lit(1)), F.lit(1)))
    times = F.filter(F.transform(F.filter(n.children(), lambda c: c["name"].isin("Dimension", "Extent") & (F.lower(F.coalesce(n.at(c).attr("name"), F.lit(""))) == "time")), lambda c: F.trim(c["value"])), lambda v: v.isNotNull())
    span = time_range(F.get(times, F.lit(0)))
    return F.struct(
        _id("layer", e["dewey"]).alias("object_id"), F.coalesce(n.text("Name"), n.text("name"), n.text("Identifier")).alias("name"), F.coalesce(n.text("Title"), n.text("label")).alias("title"), F.coalesce(n.text("Abstract"), n.text("description")).alias("description"),
        _blank(bbox_wkt(west, south, east, north)).alias("spatial_wkt"), west.alias("west"), south.alias("south"), east.alias("east"), north.alias("north"), F.concat(n.texts("CRS"), n.texts("SRS"), n.texts("DefaultSRS")).alias("crs"), n.attrs("MetadataURL", "OnlineResource", "href").alias("metadata_urls"), span["begin"].alias("startDate"), span["end"].alias("endDate"),
    )


def merge_params(defaults: Column, found: Column) -> Column:
    """Default parameters, each overridden by the found one of the same name in any case."""

    def one(d: Column) -> Column:
        f = F.get(F.filter(found, lambda x: F.lower(x["name"]) == F.lower(d["name"])), F.lit(0))
        return F.struct(d["name"].alias("name"), F.coalesce(f["format"], d["format"]).alias("format"), F.coalesce(f["values"], d["values"]).alias("values"))

    return F.transform(defaults, one)


def ogc_coverage(n: Nodes) -> Column:
    """A described coverage, of either version of the schema."""
    ends = lambda *p: F.transform(n.elems(*p), lambda e: F.split(text_of(e), r"\s+"))
    low = F.coalesce(F.get(ends("lonLatEnvelope", "pos"), F.lit(0)), F.get(ends("Domain", "SpatialDomain", "BoundingBox", "LowerCorner"), F.lit(0)))
    high = F.coalesce(F.get(ends("lonLatEnvelope", "pos"), F.lit(1)), F.get(ends("Domain", "SpatialDomain", "BoundingBox", "UpperCorner"), F.lit(0)))
    side = lambda a, k: F.get(a, F.lit(k)).try_cast("double")
    west, south, east, north = side(low, 0), side(low, 1), side(high, 0), side(high, 1)
    moments = F.concat(*[n.texts(*p) for p in (("domainSet", "temporalDomain", "timePosition"), ("domainSet", "temporalDomain", "timePeriod", "beginPosition"), ("domainSet", "temporalDomain", "timePeriod", "endPosition"), ("Domain", "TemporalDomain", "TimePosition"), ("Domain", "TemporalDomain", "TimePeriod", "BeginPosition"), ("Domain", "TemporalDomain", "TimePeriod", "EndPosition"))])
    span = time_range(F.array_join(moments, ","))
    return F.struct(
        _id("coverage", n.root["dewey"]).alias("object_id"), F.coalesce(n.text("name"), n.text("Identifier")).alias("name"), F.coalesce(n.text("label"), n.text("Title")).alias("title"), F.coalesce(n.text("description"), n.text("Abstract")).alias("description"),
        _blank(bbox_wkt(west, south, east, north)).alias("spatial_wkt"), west.alias("west"), south.alias("south"), east.alias("east"), north.alias("north"), span["begin"].alias("startDate"), span["end"].alias("endDate"),
        F.concat(n.texts("supportedFormats", "formats"), n.texts("SupportedFormat")).alias("formats"), F.concat(n.texts("supportedCRSs", "requestResponseCRSs"), n.texts("supportedCRSs", "nativeCRSs"), n.texts("SupportedCRS")).alias("crs"),
    )


@reader("ogc")
def read_ogc(docs: DataFrame, versions: dict[str, tuple[str, ...]] | None = OGC_VERSIONS) -> dict[str, DataFrame]:
    """Capabilities of all OGC services: service, keywords, layers, operations, generated URLs, metadata records; described coverages.

    Services and versions that are not among ``versions`` are left out; None reads all.
    """
    n = _n()
    root = F.get(F.filter(F.col("nodes"), lambda x: (x["kind"] == "elem") & (x["parent_id"] == -1)), F.lit(0))
    at = n.at(F.col("root"))
    caps = docs.withColumn("root", root).where("root IS NOT NULL").withColumn("service", ogc_service(F.col("root"), at.text("ServiceIdentification", "ServiceType"))).withColumn("version", at.attr("version"))
    described = caps.where(F.col("root.name").isin("CoverageDescription", "CoverageDescriptions"))
    caps = caps.where("service IS NOT NULL").where(~F.col("root.name").isin("CoverageDescription", "CoverageDescriptions"))
    if versions is not None:
        known = F.lit(False)
        for name, vs in versions.items():
            known = known | (F.col("service") == name) & F.col("version").isin(*vs)
        caps = caps.where(known)
    s = lambda *p: F.coalesce(*[at.text(sec, *p) for sec in ("Service", "ServiceIdentification")])
    services = caps.select(
        "doc_id", _id("service").alias("object_id"), "service", "version", F.coalesce(s("Title"), at.text("Service", "label")).alias("title"), F.coalesce(s("Abstract"), at.text("Service", "description")).alias("description"), F.coalesce(s("AccessConstraints"), s("accessConstraints")).alias("rights"),
        F.coalesce(at.text("Service", "ContactInformation", "ContactPersonPrimary", "ContactPerson"), at.text("ServiceProvider", "ServiceContact", "IndividualName")).alias("contact"),
    )
    words = F.concat(at.texts("Service", "KeywordList", "Keyword"), at.texts("ServiceIdentification", "Keywords", "Keyword"), at.texts("Service", "keywords", "keyword"))
    keywords = caps.where(F.size(words) > 0).select("doc_id", _id("keywords").alias("object_id"), F.lit(None).cast("string").alias("partOf"), F.lit("service").alias("hasType"), normalize_subjects(words).alias("hasValue"))

    # leaves and groups alike: whatever has a name can be asked for
    e = at_each()
    layer = F.filter(at.named("Layer", "FeatureType", "CoverageOfferingBrief", "CoverageSummary", "ObservationOffering"), lambda x: F.exists(n.at(x).children(), lambda c: c["name"].isin("Name", "name", "Identifier")))
    found = _each(caps, layer, "service", "version").select("doc_id", "url", "harvest_date", "service", "version", ogc_layer(e).alias("l"), _id("service").alias("service_id"))
    layers = found.select("doc_id", "service", "version", "l.*", "service_id")
    made = _blank(ogc_request(F.col("url"), F.col("l.name"), [F.col(f"l.{k}").cast("string") for k in ("west", "south", "east", "north")], F.col("service"), F.col("version")))
    asked = found.withColumn("made", made)
    links = F.array_distinct(F.filter(F.col("l.metadata_urls"), lambda u: u != ""))
    noted = found.select("doc_id", "url", "harvest_date", F.col("l.object_id").alias("layer_id"), F.explode(links).alias("link"))
    record = _id("record", sha_urn(F.col("link")))
    records = noted.select("doc_id", record.alias("object_id"), F.lit(None).cast("string").alias("rdf_type"), F.col("harvest_date").alias("dateCreated"), F.col("harvest_date").alias("lastUpdated")).distinct()

    # operations with their methods, formats and parameters; what is found overrides the defaults
    ops = F.filter(at.named("Operation", "GetCapabilities", "GetMap", "GetFeatureInfo", "GetLegendGraphic", "DescribeLayer", "GetStyles", "DescribeFeatureType", "GetFeature", "LockFeature", "Transaction", "GetCoverage", "DescribeCoverage"), lambda x: x["path"].rlike(r"/Capability/Request/[^/]+$|/OperationsMetadata/Operation$"))
    kinds = F.create_map(*[F.lit(z) for kv in _FORMATS.items() for z in kv])
    none = F.array().cast("array<string>")

    def param(x: Column) -> Column:
        p = n.at(x)
        return F.struct(p.attr("name").alias("name"), F.lit(None).cast("string").alias("format"), F.concat(p.texts("Value"), p.texts("AllowedValues", "Value")).alias("values"))

    def methods(o: Column) -> Column:
        op = n.at(o)
        name = F.coalesce(op.attr("name"), o["name"])
        stated = F.transform(op.elems("Parameter"), param)
        usual = F.transform(default_params(F.col("service"), F.col("version"), name), lambda d: F.struct(d["name"].alias("name"), _blank(d["format"]).alias("format"), none.alias("values")))
        extra = F.filter(stated, lambda x: ~F.exists(usual, lambda d: F.lower(d["name"]) == F.lower(x["name"])))
        parameters = F.when(usual.isNull(), stated).otherwise(F.concat(merge_params(usual, stated), extra))
        formats = F.transform(op.texts("Format"), lambda f: F.coalesce(kinds[f], f))
        return F.transform(op.named("Get", "Post"), lambda m: F.struct(name.alias("name"), http_method(m["name"]).alias("protocol"), F.coalesce(n.at(m).attr("OnlineResource", "href"), n.at(m).attr("href"), n.at(m).attr("onlineResource")).alias("url"), formats.alias("mimeType"), parameters.alias("parameters")))

    operations = caps.select("doc_id", F.inline(F.flatten(F.transform(ops, methods))))
    me = _id("service")
    return {
        "services": services,
        "keywords": keywords,
        "layers": layers,
        "coverages": _each(described, n.named("CoverageOffering", "CoverageDescription")).where(F.size(at_each().elems("name")) + F.size(at_each().elems("Identifier")) > 0).select("doc_id", ogc_coverage(at_each()).alias("c")).select("doc_id", "c.*"),
        "operations": operations,
        "catalog_records": records,
        "urls": urls_of(docs, F.array(F.col("made")), "Generated", "Not Sure", asked).unionByName(noted.select("doc_id", url_entity(F.col("link")).alias("u")).select("doc_id", "u.*")).distinct(),
        "edges": edges(caps, (me, "bcube:contains", F.transform(layer, lambda x: _id("layer", x["dewey"]))), (me, "bcube:originatedFrom", F.array(_url_id(F.col("url")))), (me, "dc:conformsTo", F.when(F.size(words) > 0, F.array(_id("keywords"))).otherwise(none)))
        .unionByName(edges(asked.where("made IS NOT NULL"), (F.col("l.object_id"), "dcterms:references", F.array(_url_id(F.col("made"))))))
        .unionByName(edges(noted, (record, "dc:describes", F.array(F.col("layer_id"))), (record, "bcube:originatedFrom", F.array(_url_id(F.col("link")))))),
    }


# --- THREDDS, NCML, RDF, anything -----------------------------------------------------------


@reader("thredds")
def read_thredds(docs: DataFrame) -> dict[str, DataFrame]:
    """Services, datasets, metadata and catalog references with URLs and parent/child ids."""
    n = _n()
    base = F.filter(n.named("service"), lambda e: F.coalesce(n.at(e).attr("base"), F.lit("")) != "")
    bases = F.transform(base, lambda e: F.struct(n.at(e).attr("name").alias("name"), n.at(e).attr("base").alias("base")))
    top = docs.select("doc_id", _id("service").alias("object_id"), F.lit("UNIDATA:THREDDS 1.0").alias("rdf_type"), n.attr("catalog", "name").alias("title"), n.attr("catalog", "version").alias("version"))
    at = at_each()
    service_rows = _each(docs, n.named("service")).select("doc_id", at.attr("name").alias("name"), at.attr("serviceType").alias("type"), at.attr("base").alias("url"))

    def own_id(x: Nodes) -> Column:
        return F.coalesce(_blank(x.attr("ID")), _blank(x.attr("name")), F.substring(F.sha2(F.concat(F.col("doc_id").cast("string"), x.root["dewey"]), 256), 1, 8))

    def parent_id(e: Column) -> Column:
        up = n.parent_of(e)
        return F.when(up["name"].isin("dataset", "catalogRef"), own_id(n.at(up)))

    inner = ("dataset", "catalogRef", "metadata")
    elems = _each(docs.withColumn("bases", bases), n.named(*inner), "bases", parent=parent_id)
    name = F.coalesce(at.text("serviceName"), at.attr("serviceName"), at.attr("access", "serviceName"))
    # the element's own service, or all of them
    named = F.filter("bases", lambda b: b["name"] == name)
    use = F.array_distinct(F.transform(F.when(F.size(named) > 0, named).otherwise(F.col("bases")), lambda b: b["base"]))
    href = F.when(F.col("e.name") == "dataset", F.coalesce(at.attr("urlPath"), at.attr("access", "urlPath"))).otherwise(at.attr("href"))
    kids = F.transform(F.filter(at.children(), lambda c: c["name"].isin(*inner)), lambda c: own_id(at.at(c)))
    # the element's own attributes, then the texts and attributes of its plain children, as <tag> and <tag>_<attribute>
    renamed = lambda k: F.when(k == "serviceType", "type").when(k.isin("href", "base", "urlPath"), "url").otherwise(k)
    entry = lambda k, v: F.struct(k.alias("k"), v.alias("v"))
    of_child = lambda c: F.concat(F.array(entry(c["name"], text_of(c))), F.transform(at.at(c).attributes(), lambda a: entry(F.concat_ws("_", c["name"], renamed(a["name"])), text_of(a))))
    plain = F.filter(at.children(), lambda c: ~c["name"].isin(*inner))
    said = F.filter(F.concat(F.transform(at.attributes(), lambda a: entry(renamed(a["name"]), text_of(a))), F.flatten(F.transform(plain, of_child))), lambda x: F.coalesce(x["v"], F.lit("")) != "")
    keys = F.transform("said", lambda x: x["k"])
    first = F.map_from_entries(F.filter("said", lambda x, i: F.array_position(keys, x["k"]) == i + 1))
    endpoints = elems.withColumn("said", said).select(
        "doc_id", F.col("e.name").alias("tag"), own_id(at).alias("id"), F.coalesce(at.attr("name"), at.attr("title")).alias("name"), href.alias("path"), F.when(F.col("e.name") != "metadata", thredds_urls(F.col("url"), F.col("e.name"), href, use)).alias("urls"),
        F.col("parent").alias("childOf"), kids.alias("parentOf"), at.text("dataSize").try_cast("double").alias("dataSize"), F.coalesce(at.text("date"), at.attr("date")).alias("date"), first.alias("attributes"),
    )
    return {"services": top, "thredds_services": service_rows, "endpoints": endpoints, "urls": urls_of(docs, F.array().cast("array<string>"))}


@reader("ncml")
def read_ncml(docs: DataFrame) -> dict[str, DataFrame]:
    """A file's location and variables with their attributes; values are left out."""
    n = _n()

    def attribute(e: Column) -> Column:
        a = n.at(e)
        return F.struct(a.attr("name").alias("name"), a.attr("type").alias("type"), a.attr("value").alias("value"))

    def variable(e: Column) -> Column:
        v = n.at(e)
        return F.struct(v.attr("name").alias("name"), v.attr("type").alias("type"), v.attr("shape").alias("shape"), F.transform(v.elems("attribute"), attribute).alias("attributes"))

    return {"datasets": docs.select("doc_id", n.attr("netcdf", "location").alias("location"), F.transform(n.elems("netcdf", "variable"), variable).alias("variables")), "urls": urls_of(docs, F.array().cast("array<string>"))}


@reader("xml")
def read_xml(docs: DataFrame) -> dict[str, DataFrame]:
    """Any XML: its values with their qualified paths."""
    return {"values": docs.select("doc_id", F.inline(xml_values(F.col("nodes"))))}


@reader("rdf")
def read_rdf(docs: DataFrame) -> dict[str, DataFrame]:
    """RDF is recognised but not described further: only its URL is an entity."""
    return {"urls": urls_of(docs, F.array().cast("array<string>"))}


def describe(routed: DataFrame, names: list[str] | None = None) -> dict[str, dict[str, DataFrame]]:
    """The entities of all routed documents (column reader), by reader and entity type.

    The nodes are written once, so no document is parsed twice, whatever number of
    entity types is read.
    """
    staged = Stages(routed.sparkSession, "nodes").put(routed)
    return {r: READERS[r](staged.where(F.col("reader") == r)) for r in names or READERS}
