"""Operators on documents that the tables do not show: rules from YAML, broken XML, whole readers, streams."""

import pytest
from pyspark.sql import functions as F
from siltworks.functions import rules as R
from siltworks.functions.standards import STANDARD
from siltworks.functions.xml import namespaces
from siltworks.operators import graph, readers
from siltworks.operators.identify import first_identity, identify
from siltworks.operators.shred import parse_nodes, shred
from siltworks.plans.general import table
from siltworks.sources import io
from siltworks.streaming import harvest

YAML = """
- name: Demo
  service:
    - name: S
      request: Get
      filters:
        ands:
          - {type: simple, object: content, value: 'URN:DEMO'}
          - type: complex
            operator: ors
            filters:
              - {type: regex, object: url, value: 'v[0-9]'}
              - {type: xpath, object: content, value: '/*[local-name() = "demo"]'}
      versions:
        defaults: {ors: [{type: simple, object: content, value: 'urn:demo:1', text: '1'}]}
        checks: {ors: [{type: xpath, value: '@version'}]}
      errors: {filters: {ors: [{type: simple, object: content, value: '<error'}]}}
    - name: Never
      filters:
"""

ISO = '<gmd:MD_Metadata xmlns:gmd="http://www.isotc211.org/2005/gmd" xmlns:gco="c"><gmd:language><gco:CharacterString>eng</gco:CharacterString></gmd:language><gmd:metadataStandardName><gco:CharacterString>ISO 19115</gco:CharacterString></gmd:metadataStandardName><gmd:metadataStandardVersion><gco:CharacterString>2003</gco:CharacterString></gmd:metadataStandardVersion></gmd:MD_Metadata>'
WMS = '<!DOCTYPE WMT_MS_Capabilities SYSTEM "http://schemas.opengis.net/wms/1.1.1/WMS_MS_Capabilities.dtd"><WMT_MS_Capabilities version="1.1.1"><Service><Title>t</Title></Service></WMT_MS_Capabilities>'
FEED = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>a</title></entry></feed>'
SEARCH = '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:o="http://a9.com/-/spec/opensearch/1.1/"><o:itemsPerPage>1</o:itemsPerPage></feed>'
CASES = [
    (ISO, "http://h.test/", "ISO", "19115", ["ISO 19115 2003"]),
    (WMS, "http://h.test/?request=GetCapabilities", "OGC", "WMS", ["1.1.1"]),
    (FEED, "http://h.test/", "ATOM", "ATOM", None),
    (SEARCH, "http://h.test/", "OpenSearch", "OpenSearch", None),
    ("<gmd:CI_Citation xmlns:gmd='http://www.isotc211.org/2005/gmd'/>", "http://h.test/", None, None, None),
    ("<broken", "http://h.test/", None, None, None),
    (None, "http://h.test/", None, None, None),
    ("<x/>", "https://zenodo.org/1", "Zenodo", "Zenodo", None),
]


def test_standard_rules(spark):
    df = spark.createDataFrame([(i, c, u) for i, (c, u, *_) in enumerate(CASES)], "i int, content string, url string")
    got = {r.i: r.m for r in identify(df).select("i", first_identity(F.col("identities")).alias("m")).collect()}
    for i, (_, _, protocol, name, version) in enumerate(CASES):
        m = got[i]
        assert (m and m.protocol, m and m.name, m and m.version) == (protocol, name, version)
    assert len(STANDARD) == 55


def test_rules_from_yaml(spark):
    rules = R.load_rules(YAML)
    assert [r.name for r in rules] == ["S"]
    rows = [(1, "<demo xmlns='urn:demo:1' version='7'><error/></demo>", "http://x/v"), (2, "<other xmlns='urn:demo'/>", "http://x/v1"), (3, "<other xmlns='urn:demo'/>", "http://x/v")]
    got = {r.i: [(m.name, m.version, m.error) for m in r.identities] for r in identify(spark.createDataFrame(rows, "i int, content string, url string"), rules).collect()}
    assert got == {1: [("S", ["1", "7"], True)], 2: [("S", None, None)], 3: []}


@pytest.mark.parametrize(
    "text, want",
    [
        ("<a><b>x</b><b>y", [("a", None), ("a/b", "x"), ("a/b", "y")]),
        ("<a><b>x</a>z</b>", [("a", None), ("a/b", "x")]),
        ("<a>1 &lt; 2<b/>tail</a>", [("a", "1 < 2"), ("a/b", None)]),
        ("<a><![CDATA[<x>]]></a>", [("a", "<x>")]),
        ("<!-- c --><?p q?><A q='1'/>", [("A", None), ("A/@q", "1")]),
        ("<a b=", []),
        ("", []),
        (None, []),
        ("plain", []),
    ],
)
def test_tolerant_parser(text, want):
    assert [(n[5], n[8]) for n in parse_nodes(text)[0]] == want


def test_namespaces(spark):
    df = spark.createDataFrame([("<a xmlns='u1' xmlns:p='u2'><b xmlns='u3' xmlns:q='u2'/></a>",)], "x string")
    assert df.select(namespaces(F.col("x")).alias("n")).first().n == {"default": "u1", "p": "u2", "default2": "u3"}


FGDC = """<metadata><idinfo><datsetid>D1</datsetid><citation><citeinfo><title>T</title><onlink>http://p.test/1</onlink><onlink>http://h.test/d</onlink><pubinfo><publish>P</publish><pubplace>L</pubplace></pubinfo></citeinfo></citation>
<spdom><bounding><westbc>-1</westbc><eastbc>0</eastbc><northbc>2</northbc><southbc>0</southbc></bounding></spdom><timeperd><timeinfo><rngdates><begdate>2001</begdate><enddate>20020304</enddate></rngdates></timeinfo></timeperd>
<keywords><theme><themekt>K</themekt><themekey>a</themekey><themekey>b</themekey></theme><stratum><stratkt>S</stratkt><stratkey>c</stratkey></stratum></keywords></idinfo>
<distinfo><stdorder><digform><digtopt><onlinopt><computer><networka><networkr>http://d.test/x</networkr></networka></computer></onlinopt></digtopt></digform></stdorder></distinfo></metadata>"""


def test_fgdc_reader_and_graph(spark):
    docs = shred(spark.createDataFrame([(1, "http://h.test/d", "2015", FGDC)], "doc_id bigint, url string, harvest_date string, content string"), "content")
    found = readers.read_fgdc(docs)
    d = found["datasets"].first()
    assert (d.title, d.identifier, d.west, d.east, d.startDate, d.endDate) == ("T", "D1", -1.0, 0.0, "2001-01-01T00:00:00", "2002-03-04T00:00:00")
    assert d.spatial_wkt == "POLYGON ((-1 0,-1 2,0 2,0 0,-1 0))"
    assert {(k.partOf, k.hasType, tuple(k.hasValue)) for k in found["keywords"].collect()} == {("K", "theme", ("a", "b")), ("S", "stratum", ("c",))}
    urls = {u.vcard_hasURL: u.object_id for u in found["urls"].collect()}
    assert set(urls) == {"http://h.test/d", "http://d.test/x", "http://p.test/1"}
    e = {(x.relate, x.dst_id) for x in found["edges"].collect()}
    assert ("dcterms:references", urls["http://d.test/x"]) in e and ("dcterms:publisher", found["publishers"].first().object_id) in e
    ids = {r.object_id for k in ("datasets", "publishers", "webpages", "keywords", "urls", "catalog_records") for r in found[k].collect()}
    assert {x for _, x in e} <= ids
    lines = [r.value for r in graph.n_triples(graph.to_triples(found)).collect()]
    assert len(lines) == len(set(lines)) and any('"-1.0"^^<http://www.w3.org/2001/XMLSchema#float>' in x for x in lines)


def test_csw_and_series(spark):
    body = '<csw:GetRecordsResponse xmlns:csw="c"><csw:SearchResults numberOfRecordsMatched="7" numberOfRecordsReturned="1" recordSchema="gmd">' + ISO.replace("</gmd:MD_Metadata>", "<gmd:identificationInfo><gmd:MD_DataIdentification><gmd:abstract><gco:CharacterString>A</gco:CharacterString></gmd:abstract></gmd:MD_DataIdentification></gmd:identificationInfo></gmd:MD_Metadata>") + "</csw:SearchResults></csw:GetRecordsResponse>"
    docs = shred(spark.createDataFrame([(1, "http://h.test/", None, body)], "doc_id bigint, url string, harvest_date string, content string"), "content")
    found = readers.read_csw(docs)
    assert found["services"].first()[1:] == (7, 1, "gmd")
    assert found["datasets"].first().description == "A"


DOC = "doc_id bigint, url string, harvest_date string, content string"
WMS_CAPS = """<WMS_Capabilities xmlns="http://www.opengis.net/wms" xmlns:x="http://www.w3.org/1999/xlink" version="1.3.0"><Service><Title>T</Title><Abstract>A</Abstract><KeywordList><Keyword>k1</Keyword></KeywordList></Service>
<Capability><Request><GetMap><Format>image/png</Format><DCPType><HTTP><Get><OnlineResource x:href="http://h.test/map?"/></Get></HTTP></DCPType></GetMap></Request>
<Layer><Title>group</Title><Layer><Name>a</Name><Title>one</Title><EX_GeographicBoundingBox><westBoundLongitude>-1</westBoundLongitude><eastBoundLongitude>2</eastBoundLongitude><southBoundLatitude>-3</southBoundLatitude><northBoundLatitude>4</northBoundLatitude></EX_GeographicBoundingBox><MetadataURL><OnlineResource x:href="http://m.test/a.xml"/></MetadataURL></Layer></Layer></Capability></WMS_Capabilities>"""


def test_ogc_layers_have_urls_and_records(spark):
    docs = shred(spark.createDataFrame([(1, "http://h.test/ows?x=1", "2015", WMS_CAPS), (2, "http://h.test/ows", "2015", WMS_CAPS.replace("1.3.0", "9.9.9"))], DOC), "content")
    found = readers.read_ogc(docs)
    assert [(s.doc_id, s.service, s.title) for s in found["services"].collect()] == [(1, "WMS", "T")]
    assert {s.doc_id for s in readers.read_ogc(docs, None)["services"].collect()} == {1, 2}
    urls = {u.vcard_hasURL: u for u in found["urls"].where("doc_id = 1").collect()}
    made = "http://h.test/ows?service=WMS&version=1.3.0&request=GetMap&layers=a&width=500&height=500&styles=&format=image%2Fpng&crs=CRS%3A84&bbox=-1.0%2C-3.0%2C2.0%2C4.0"
    assert set(urls) == {"http://h.test/ows?x=1", made, "http://m.test/a.xml"}
    assert (urls[made].hasUrlSource, urls[made].hasConfidence) == ("Generated", "Not Sure")
    layer, record, service = found["layers"].first(), found["catalog_records"].first(), found["services"].first()
    e = {(x.src_id, x.relate, x.dst_id) for x in found["edges"].collect()}
    assert e == {
        (service.object_id, "bcube:contains", layer.object_id), (service.object_id, "bcube:originatedFrom", urls["http://h.test/ows?x=1"].object_id), (service.object_id, "dc:conformsTo", found["keywords"].first().object_id),
        (layer.object_id, "dcterms:references", urls[made].object_id), (record.object_id, "dc:describes", layer.object_id), (record.object_id, "bcube:originatedFrom", urls["http://m.test/a.xml"].object_id),
    }
    op = found["operations"].first()
    assert (op.name, op.protocol, op.url, op.mimeType) == ("GetMap", "HTTP GET", "http://h.test/map?", ["image/png"])
    assert [p.name for p in op.parameters] == ["service", "request", "version"]


def test_capabilities_by_namespace(spark):
    cap = '<c:Capabilities xmlns:c="{0}" xmlns:ows="o" version="{1}"><ows:ServiceIdentification><ows:Title>t</ows:Title>{2}</ows:ServiceIdentification><ows:OperationsMetadata><ows:Operation name="GetRecords"><ows:DCP><ows:HTTP><ows:Post href="http://p.test"/></ows:HTTP></ows:DCP><ows:Parameter name="resultType"><ows:Value>hits</ows:Value><ows:Value>results</ows:Value></ows:Parameter></ows:Operation></ows:OperationsMetadata></c:Capabilities>'
    rows = [cap.format("http://www.opengis.net/cat/csw/2.0.2", "2.0.2", ""), cap.format("http://www.opengis.net/sos/1.0", "1.0.0", ""), cap.format("http://www.opengis.net/wcs/1.1.1", "1.1.1", ""), cap.format("urn:other", "2.0.2", "<ows:ServiceType>urn:x:CSW</ows:ServiceType>"), cap.format("urn:other", "1", "")]
    docs = shred(spark.createDataFrame([(i, "http://h.test/", None, c) for i, c in enumerate(rows)], DOC), "content")
    found = readers.read_ogc(docs)
    assert {r.doc_id: r.service for r in found["services"].collect()} == {0: "CSW", 1: "SOS", 2: "WCS", 3: "CSW"}
    op = found["operations"].where("doc_id = 0").first()
    assert (op.name, op.protocol, op.url, [(p.name, list(p["values"])) for p in op.parameters]) == ("GetRecords", "HTTP POST", "http://p.test", [("resultType", ["hits", "results"])])


def test_described_coverages(spark):
    one = '<CoverageDescription xmlns="http://www.opengis.net/wcs" version="1.0.0"><CoverageOffering><name>c</name><label>l</label><description>d</description><lonLatEnvelope><pos>-1 -2</pos><pos>3 4</pos></lonLatEnvelope><domainSet><temporalDomain><timePosition>2001-01-01</timePosition><timePosition>2003-05-06</timePosition></temporalDomain></domainSet><supportedCRSs><requestResponseCRSs>EPSG:4326</requestResponseCRSs></supportedCRSs><supportedFormats><formats>GeoTIFF</formats></supportedFormats></CoverageOffering></CoverageDescription>'
    two = '<CoverageDescriptions xmlns="http://www.opengis.net/wcs/1.1" xmlns:o="o"><CoverageDescription><o:Title>t</o:Title><Identifier>i</Identifier><Domain><SpatialDomain><o:BoundingBox><o:LowerCorner>0 1</o:LowerCorner><o:UpperCorner>2 3</o:UpperCorner></o:BoundingBox></SpatialDomain></Domain><SupportedFormat>a</SupportedFormat><SupportedFormat>b</SupportedFormat></CoverageDescription></CoverageDescriptions>'
    docs = shred(spark.createDataFrame([(1, "u", None, one), (2, "u", None, two)], DOC), "content")
    got = {r.doc_id: r for r in readers.read_ogc(docs)["coverages"].collect()}
    assert (got[1].name, got[1].title, got[1].description, got[1].west, got[1].north, got[1].formats, got[1].crs) == ("c", "l", "d", -1.0, 4.0, ["GeoTIFF"], ["EPSG:4326"])
    assert (str(got[1].startDate), str(got[1].endDate)) == ("2001-01-01 00:00:00", "2003-05-06 00:00:00")
    assert (got[2].name, got[2].title, got[2].spatial_wkt, got[2].formats) == ("i", "t", "POLYGON ((0.0 1.0,0.0 3.0,2.0 3.0,2.0 1.0,0.0 1.0))", ["a", "b"])


def test_csw_with_fgdc_records(spark):
    body = '<csw:GetRecordsResponse xmlns:csw="c"><csw:SearchResults numberOfRecordsMatched="2" numberOfRecordsReturned="2" recordSchema="s">' + FGDC + FGDC.replace("<title>T<", "<title>U<") + "</csw:SearchResults></csw:GetRecordsResponse>"
    found = readers.read_csw(shred(spark.createDataFrame([(1, "http://h.test/", None, body)], DOC), "content"))
    ds = found["datasets"].collect()
    assert sorted(d.title for d in ds) == ["T", "U"] and len({d.object_id for d in ds}) == 2
    assert found["keywords"].count() == 4 and {x.src_id for x in found["edges"].where("relate = 'dcterms:publisher'").collect()} == {d.object_id for d in ds}


def test_series_and_its_records(spark):
    rec = lambda t: f"<MD_Metadata><identificationInfo><MD_DataIdentification><abstract><CharacterString>{t}</CharacterString></abstract></MD_DataIdentification></identificationInfo></MD_Metadata>"
    body = f"<DS_Series><composedOf><DS_DataSet><has>{rec('a')}</has></DS_DataSet></composedOf><composedOf><DS_DataSet><has>{rec('b')}</has></DS_DataSet></composedOf><seriesMetadata>{rec('s')}</seriesMetadata></DS_Series>"
    found = readers.read_iso(shred(spark.createDataFrame([(1, "http://h.test/", None, body)], DOC), "content"))
    ids = {d.description: d.object_id for d in found["datasets"].collect()}
    s = found["series"].first()
    assert (s.object_id, s.children) == (ids["s"], [ids["a"], ids["b"]])
    assert {x.dst_id for x in found["edges"].where("relate = 'bcube:contains'").collect()} == {ids["a"], ids["b"]}


def test_thredds_attributes(spark):
    body = '<catalog><service name="A" serviceType="OPENDAP" base="/a/"/><dataset name="d" urlPath="x.nc"><dataSize units="Mb">7</dataSize><access serviceName="A" urlPath="y.nc"/><dataset name="in"/></dataset></catalog>'
    e = {r.name: r for r in readers.read_thredds(shred(spark.createDataFrame([(1, "http://h.test/catalog.xml", None, body)], DOC), "content"))["endpoints"].collect()}
    assert e["d"].attributes == {"name": "d", "url": "x.nc", "dataSize": "7", "dataSize_units": "Mb", "access_serviceName": "A", "access_url": "y.nc"}
    assert (e["d"].parentOf, e["in"].childOf, e["in"].attributes) == (["in"], "d", {"name": "in"})


def test_readers_take_time_in_proportion_to_the_document(spark):
    import time

    def took(n: int) -> float:
        body = '<catalog><service name="A" base="/a/"/><dataset name="top">' + "".join(f'<dataset name="d{i}" ID="k{i}" urlPath="{i}.nc"><dataSize units="Mb">{i}</dataSize></dataset>' for i in range(n)) + "</dataset></catalog>"
        docs = shred(spark.createDataFrame([(1, "http://h.test/catalog.xml", None, body)], DOC), "content", ["doc_id", "url", "harvest_date"]).cache()
        docs.count()
        began = time.perf_counter()
        assert readers.read_thredds(docs)["endpoints"].where("childOf = 'top' AND attributes['dataSize'] IS NOT NULL").count() == n
        return time.perf_counter() - began

    took(100)
    small, large = took(1_000), took(10_000)
    assert large < 25 * max(small, 0.5), (small, large)


def test_identifiers_in_nested_urls(spark):
    """Redirects of redirects, escaped once more at each level, down to the identifier."""
    from urllib.parse import quote

    from siltworks.operators.unique_ids import extract_identifiers

    urls = ["http://a0.test/x?id=10.5072/abc7"]
    for k in range(1, 6):
        urls.append(f"http://a{k}.test/go?u={quote(urls[-1], safe='')}")
    docs = shred(spark.createDataFrame([(1, urls[-1], "<r><t>none</t></r>"), (2, None, "<r/>"), (3, "", None)], "doc_id bigint, url string, content string"), "content")
    got = {(r.match_type, r.potential_identifier) for r in extract_identifiers(docs, "doc_id").collect()}
    assert ("doi", "10.5072/abc7") in got
    assert {("url", f"http://a{k}.test/{'go' if k else 'x'}") for k in range(6)} <= got


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1", "url": "u", "raw_content": "<a/>"}')
    assert io.read_responses(spark, str(tmp_path / "a.json")).first().raw_content == "<a/>"
    (tmp_path / "d.xml").write_bytes(b"<a>\\n\xff</a>")
    assert io.read_documents(spark, str(tmp_path / "d.xml")).first().raw_content == "<a> �</a>"
    (tmp_path / "p.csv").write_text('url|md5\n"u"|"m"\n')
    assert io.read_piped(spark, str(tmp_path / "p.csv")).first().asDict() == {"url": "u", "md5": "m"}
    (tmp_path / "w.txt").write_text("a\n\n b \n")
    assert [r.word for r in io.read_word_list(spark, str(tmp_path / "w.txt")).collect()] == ["a", "b"]
    made = []
    for _ in range(2):
        out = io.stage(spark, str(tmp_path / "stage"), lambda: made.append(1) or spark.range(3))
    assert out.count() == 3 and made == [1]
    io.write_lines(spark.range(2), str(tmp_path / "lines"))
    io.write_scores(spark.createDataFrame([(1, 2, 0.5)], "a int, b int, score double"), str(tmp_path / "s"), "a")
    assert spark.read.text(str(tmp_path / "s")).first().value == "0.5,2"
    io.write_scores(spark.range(50).selectExpr("id AS a", "id + 1 AS b", "0.25D AS score"), str(tmp_path / "sb"), "a", buckets=4)
    assert len(list((tmp_path / "sb").glob("bucket=*"))) <= 4
    assert {r.value for r in spark.read.text(str(tmp_path / "sb")).select("value").collect()} == {f"{i},0.25,{i + 1}" for i in range(50)}


def test_relational_tables(spark):
    """Written to a database and read back, whole and in parallel ranges."""
    url, rows = "jdbc:derby:memory:silt;create=true", spark.range(100).selectExpr("id AS k", "concat('v', id) AS v")
    io.write_table(rows, url, "t", "overwrite", driver="org.apache.derby.jdbc.EmbeddedDriver")
    for options in ({}, {"key": "k", "bounds": (0, 100), "partitions": 4}):
        got = io.read_table(spark, url, "t", driver="org.apache.derby.jdbc.EmbeddedDriver", **options)
        assert got.rdd.getNumPartitions() == options.get("partitions", 1)
        assert sorted(tuple(r) for r in got.collect()) == sorted((i, f"v{i}") for i in range(100))


def test_stream(spark, small, tmp_path):
    raw = table(spark, small, "harvest_records", ["url", "raw_content", "content_type", "loaded_at"])
    raw.write.parquet(str(tmp_path / "in"))
    stream = harvest.identified(harvest.read_stream(spark, str(tmp_path / "in"), raw.schema), late="3650 days")
    q = stream.writeStream.format("memory").queryName("harvest_out").outputMode("append").start()
    try:
        q.processAllAvailable()
        got = spark.table("harvest_out")
        assert got.count() == raw.select("url").distinct().count()
    finally:
        q.stop()


def test_time_limit():
    import time

    from siltworks.runtime import time_limited

    assert time_limited(lambda x: x + 1, 1)(1) == 2
    assert time_limited(lambda: time.sleep(5) or 1, 0.05)() is None


def test_harvest_graph_has_every_reader(spark, tmp_path):
    from collections import Counter

    from siltworks.plans import catalogue

    iso = '<gmd:MD_Metadata xmlns:gmd="urn:x-gmd" xmlns:gco="c"><gmd:identificationInfo><gmd:MD_DataIdentification><gmd:abstract><gco:CharacterString>A</gco:CharacterString></gmd:abstract></gmd:MD_DataIdentification></gmd:identificationInfo></gmd:MD_Metadata>'
    bodies = {
        "opensearch": '<OpenSearchDescription xmlns="urn:x-osd:1.1"><ShortName>o</ShortName></OpenSearchDescription>', "oaipmh": '<OAI-PMH xmlns="urn:x-oai"><Identify><repositoryName>r</repositoryName></Identify></OAI-PMH>', "ogc": '<WMS_Capabilities xmlns="urn:x-wms" version="1.3.0"><Service><Title>w</Title></Service></WMS_Capabilities>',
        "iso": iso, "fgdc": "<metadata><idinfo><descript><abstract>f</abstract></descript></idinfo></metadata>", "thredds": '<catalog xmlns="urn:x-thredds" name="t"><service name="a" base="/b/"/></catalog>', "feed": '<feed xmlns="urn:x-atom"><title>f</title></feed>',
    }
    rows = [(i, f"http://h.test/{r}", b, ["text/xml"]) for i, (r, b) in enumerate(bodies.items())]
    spark.createDataFrame(rows, "record_id bigint, url string, raw_content string, content_type array<string>").write.parquet(f"{tmp_path}/harvest_records.parquet")
    parts = catalogue.harvest_triples(spark, str(tmp_path))
    assert set(parts) == set(bodies)
    got = Counter(x.p.rpartition("/")[2] for x in parts["feed"].collect())
    assert (got["#hasURL"], got["owl#a"]) == (1, 1)
