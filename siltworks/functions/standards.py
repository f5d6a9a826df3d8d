"""The rules of the standards that harvested responses follow."""

from __future__ import annotations

from .rules import Rule, XPath, all_of, any_of, content, url

# Fixed values below: names, namespaces, tags and paths of the standards.


def _root(name: str) -> XPath:
    return XPath(f'/*[local-name() = "{name}"]')


def _ln(*names: str) -> str:
    return "/".join(f'*[local-name()="{n}"]' for n in names)


GETCAPABILITIES = any_of(url("REQUEST=GETCAPABILITIES"), content("<GetCapabilities>"), content('name="GetCapabilities"'))
WMS_DTD = content('<!DOCTYPE WMT_MS_Capabilities SYSTEM "http://schemas.opengis.net/wms/1.1.1/WMS_MS_Capabilities.dtd"')
DESCRIBE_SENSOR = content('Operation name="DescribeSensor"')
DAP_ERRORS = any_of(content('<property name="requires_authorization"'), content("<variables vocabulary="), content("<dap:Error"), _root("Error"))
OSD = "http://a9.com/-/spec/opensearch/1.1/"
THREDDS = "http://www.unidata.ucar.edu/namespaces/thredds/InvCatalog/v1.0"
OAI_DC = "http://www.openarchives.org/OAI/2.0/oai_dc/"
ISO_LANGUAGE = ("/*/" + _ln("language", "CharacterString") + "/text()",)
OAI_PREFIX = ('/*/*[local-name()="request"]/@*[local-name()="metadataPrefix"]',)
CSW_SCHEMA = ('//*/*[local-name()="SearchResults"]/@*[local-name()="recordSchema"]',)


def _ogc(name: str) -> any_of:
    return content(f"http://www.opengis.net/{name}")


def _iso(*pairs: tuple[str, str]):
    return any_of(*[all_of(_root(r), content(ns)) for r, ns in pairs])


def _simple(protocol: str, kind: str, *texts, name: str = "") -> Rule:
    return Rule(protocol, kind, name or protocol, any_of(*[t if not isinstance(t, str) else content(t) for t in texts]))


def _iso_version(at: str) -> tuple[str, ...]:
    one = lambda n: f"{at}/" + _ln(n, "CharacterString") + "/text()"
    return (f'concat({one("metadataStandardName")}, " ", {one("metadataStandardVersion")})',)


STANDARD: list[Rule] = [
    Rule("OGC", "service", "WMS", all_of(any_of(_ogc("wms"), WMS_DTD), GETCAPABILITIES), "GetCapabilities", versions=("@version",)),
    Rule("OGC", "service", "WCS", all_of(_ogc("wcs"), GETCAPABILITIES), "GetCapabilities", versions=("@version",)),
    Rule("OGC", "service", "WFS", all_of(_ogc("wfs"), GETCAPABILITIES), "GetCapabilities", versions=("@version",)),
    Rule("OGC", "service", "SOS", all_of(any_of(_ogc("sos"), DESCRIBE_SENSOR), GETCAPABILITIES), "GetCapabilities", versions=("@version",)),
    Rule("OGC", "service", "CSW", all_of(_ogc("cat/csw"), any_of(url("SERVICE=CSW"), content("<csw:Capabilities")), GETCAPABILITIES), "GetCapabilities", versions=("@version",)),
    Rule("OGC", "service", "WMTS", all_of(any_of(_ogc("wmts"), content('Operation name="GetTile"')), GETCAPABILITIES), "GetCapabilities"),
    Rule("OGC", "dataset", "WMS", all_of(_ogc("wms"), WMS_DTD, GETCAPABILITIES), "GetCapabilities"),
    Rule("OGC", "dataset", "WCS", all_of(_ogc("wcs"), any_of(url("REQUEST=DESCRIBECOVERAGE"), content("<CoverageDescription"))), "DescribeCoverage"),
    Rule("OGC", "dataset", "WFS", all_of(_ogc("wfs"), GETCAPABILITIES), "GetCapabilities"),
    Rule("OGC", "dataset", "SOS", all_of(_ogc("sos"), DESCRIBE_SENSOR, GETCAPABILITIES), "GetCapabilities"),
    Rule("OGC", "resultset", "CSW", all_of(content("GetRecordsResponse"), _ogc("cat/csw/")), "GetRecords", dialect=CSW_SCHEMA),
    Rule("OGC", "resultset", "CSW", all_of(content("GetRecordsByIdResponse"), _ogc("cat/csw/")), "GetRecordById", dialect=CSW_SCHEMA),
    Rule("ISO", "metadata", "19115", _iso(("MI_Metadata", 'xmlns="http://www.isotc211.org/2005/gmi'), ("MD_Metadata", 'xmlns="http://www.isotc211.org/2005/gmd'), ("MI_Metadata", 'xmlns:gmi="http://www.isotc211.org/2005/gmi"'), ("MD_Metadata", 'xmlns:gmd="http://www.isotc211.org/2005/gmd"')), versions=_iso_version("/*"), language=ISO_LANGUAGE),
    Rule("ISO", "metadata", "Data Series", _iso(("DS_Series", 'xmlns="http://www.isotc211.org/2005/gmi"'), ("DS_Series", 'xmlns="http://www.isotc211.org/2005/gmd"')), versions=_iso_version('/*/*[local-name()="seriesMetadata"]/*[local-name()="MD_Metadata" or local-name()="MI_Metadata"]'), language=ISO_LANGUAGE),
    Rule("ISO", "metadata", "19119", _iso(("SV_ServiceIdentification", "http://www.isotc211.org/2005/srv")), language=ISO_LANGUAGE),
    Rule("FGDC", "metadata", "FGDC", any_of(*[XPath(f'/metadata/metainfo/metstdv[text()="{v}"]') for v in ("FGDC-STD-001-1998", "FGDC-STD-012-2002")]), versions=('concat(//metstdn/text(), ", ", //metstdv/text())',)),
    Rule("DIF", "metadata", "DIF", all_of(content("http://gcmd.gsfc.nasa.gov/Aboutus/xml/dif/"), _root("DIF"), content("<Entry_ID>")), versions=("concat(/*/" + _ln("Metadata_Name") + ", /*/" + _ln("Metadata_Version") + ")",)),
    Rule("DC", "metadata", "DublinCore", all_of(content(OAI_DC), _root("dc")), versions=((content(OAI_DC), "2.0"),)),
    Rule("OAI-PMH", "service", "Identify", all_of(content('xmlns="http://www.openarchives.org/OAI/'), content("<Identify>")), "Identify", versions=("/*/" + _ln("Identify", "protocolVersion") + "/text()",), errors=content('<error code="')),
    Rule("OAI-PMH", "resultset", "OAI-PMH", any_of(content("<ListRecords>"), url("verb=ListRecords")), "ListRecords", dialect=OAI_PREFIX),
    Rule("OAI-PMH", "resultset", "OAI-PMH", any_of(content("<GetRecord>"), url("verb=GetRecord")), "GetRecord", dialect=OAI_PREFIX),
    Rule("OpenSearch", "service", "OpenSearchDescription", all_of(content(f'xmlns="{OSD}"'), _root("OpenSearchDescription")), versions=((content(OSD), "1.1"),), language=("/*/" + _ln("Language") + "/text()",), errors=any_of(content("OpenSearch Exception"), content("REQUEST_EXCEPTION:"))),
    Rule("OpenSearch", "resultset", "OpenSearch", all_of(content(OSD), content("http://www.w3.org/2005/Atom"), content("<feed"), XPath('//*[local-name()="itemsPerPage"]')), dialect=((all_of(), "ATOM"),)),
    Rule("UNIDATA", "service", "THREDDS-Catalog", content(THREDDS), versions=((content(THREDDS), "1.0"), "@version"), errors=DAP_ERRORS),
    Rule("OPeNDAP", "dataset", "NCML", all_of(content("http://xml.opendap.org/ns/DAP"), content("http://www.unidata.ucar.edu/namespaces/netcdf/ncml-"), _root("netcdf")), errors=DAP_ERRORS),
    Rule("OPeNDAP", "metadata", "DDX", all_of(content("http://xml.opendap.org/ns/DAP"), _root("Dataset")), errors=DAP_ERRORS),
    Rule("RDF", "dataset", "RDF", all_of(_root("RDF"), content("http://www.w3.org/1999/02/22-rdf-syntax-ns#"), content("<dcat:Dataset rdf:about=")), language=("@xml:lang",)),
    Rule("RSS", "resultset", "RSS", any_of(content("<rss"), content("http://api.npr.org/nprml"))),
    # a feed that declares the search namespace is a search result, not a plain feed
    Rule("ATOM", "resultset", "ATOM", all_of(content("http://www.w3.org/2005/Atom"), content("<feed"), XPath(f'count(/*/namespace::*[. = "{OSD}"]) < 1'))),
    _simple("WADL", "service", "http://wadl.dev.java.net"),
    _simple("WSDL", "service", "http://schemas.xmlsoap.org/wsdl/"),
    _simple("PDS", "service", "http://pds.nasa.gov/pds4/pds/v1"),
    _simple("CAP-ALERT", "service", "http://www.incident.com/cap/1.0", "urn:oasis:names:tc:emergency:cap:"),
    _simple("MARC 21 Format", "metadata", "http://www.loc.gov/MARC21/slim"),
    Rule("DDI", "metadata", "DDI", all_of(content("http://www.ddialliance.org/Specification/DDI-Codebook"), _root("codeBook"))),
    _simple("KML", "dataset", "http://earth.google.com/kml"),
    _simple("ArcGISExplorerDocument", "service", "http://www.esri.com/schemas/ArcGIS/"),
    Rule("ESRI MapServer Info", "service", "ESRI MapServer Info", all_of(content("EsriPropertyType="), content("ArcGISFormat"), content("<Esri>"))),
    _simple("Microsoft", "dataset", "urn:schemas-microsoft-com:office:office", name="Microsoft Document"),
    _simple("WordPress", "service", "http://archipelago.phrasewise.com/rsd", url("?rsd"), url("rsd.xml")),
    _simple("LOC-METS", "metadata", "http://www.loc.gov/METS_Profile/"),
    _simple("DataCite", "metadata", "http://datacite.org/schema/"),
    _simple("EML", "metadata", "eml://ecoinformatics.org/eml-"),
    _simple("QuakeML", "service", "http://anss.org/xmlns/catalog", "http://anss.org/xmlns/tensor", "http://quakeml.org/xmlns/bed/"),
    _simple("NIEM", "metadata", "http://niem.gov/"),
    _simple("Disco", "metadata", "http://schemas.xmlsoap.org/disco/"),
    _simple("SOAP", "service", "http://schemas.xmlsoap.org/soap"),
    Rule("Sitemap", "metadata", "Sitemap", all_of(content("http://www.sitemaps.org/schemas/sitemap/"), content("<urlset"))),
    _simple("waterML", "service", "http://www.cuahsi.org/waterML/"),
    _simple("ECHO", "service", "http://echo.nasa.gov/"),
    _simple("MODAPS", "service", "http://modapsws.gsfc.nasa.gov/xsd"),
    _simple("IOOS", "service", "http://www.noaa.gov/ioos/"),
    _simple("Zenodo", "service", url("zenodo.org/")),
    _simple("Ferret ToolsUi", "service", url("http://ferret.pmel.noaa.gov/thredds/view/ToolsUI.jnlp?"), name="Ferret ToolsUI"),
    Rule("HDF-XML", "file", "HDF-XML", all_of(_root("HDF5-File"), content('xmlns:hdf5="http://hdfgroup.org/DTDs/HDF5-File'))),
]
