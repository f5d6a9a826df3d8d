"""URL expressions: decoding, parts, parameters, classification, request building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unquote(c: Column) -> Column:
    """Percent-decoded; plus signs and invalid escapes stay."""
    safe = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), c)


def base_url(c: Column) -> Column:
    """Scheme, host and path."""
    return F.regexp_extract(c, r"^[^?#;]*", 0)


def query_string(c: Column) -> Column:
    return F.regexp_extract(c, r"^[^?#]*\?([^#]*)", 1)


def path_of(c: Column) -> Column:
    return F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def host_of(c: Column) -> Column:
    return F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def _unplus(c: Column) -> Column:
    return unquote(F.replace(c, F.lit("+"), F.lit(" ")))


def param_pairs(c: Column) -> Column:
    """Parameters in order, as array<struct<k,v>>; blank values are dropped."""
    parts = F.filter(F.split(query_string(c), "[&;]"), lambda p: F.instr(p, "=") > 0)
    pairs = F.transform(parts, lambda p: F.struct(_unplus(F.regexp_extract(p, "^([^=]*)=", 1)).alias("k"), _unplus(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)).alias("v")))
    return F.filter(pairs, lambda x: x["v"] != "")


def params(c: Column, lower_keys: bool = False) -> Column:
    """Parameters as map<string, array<string>>."""
    pairs = param_pairs(c)
    if lower_keys:
        pairs = F.transform(pairs, lambda x: F.struct(F.lower(x["k"]).alias("k"), x["v"].alias("v")))
    keys = F.array_distinct(F.transform(pairs, lambda x: x["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.transform(F.filter(pairs, lambda x: x["k"] == k), lambda x: x["v"]))))


def break_url(c: Column) -> Column:
    """struct(base, values): the URL without its query, and the query's values in order."""
    return F.struct(base_url(c).alias("base"), F.transform(param_pairs(c), lambda x: x["v"]).alias("values"))


def sha_urn(c: Column) -> Column:
    return F.concat(F.lit("urn:sha:"), F.sha2(c, 224))


def uuid_urn(*parts: Column) -> Column:
    """A URN made of the parts, the same in every run, in the form of a UUID."""
    h = F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *cut))


def short_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8)


def signature(c: Column) -> Column:
    """Host and path segments, sorted and joined: equal for reordered paths."""
    return F.array_join(F.array_sort(F.filter(F.split(F.concat(host_of(c), path_of(c)), "/"), lambda s: s != "")), "")


def service_protocol(c: Column) -> Column:
    """OGC or OAI-PMH by the names of the parameters, else ''."""
    keys = F.transform(param_pairs(c), lambda x: F.lower(x["k"]))
    return F.when(F.arrays_overlap(keys, F.array(*map(F.lit, ("service", "version", "request")))), "OGC").when(F.array_contains(keys, "verb"), "OAI-PMH").otherwise("")


def _first(c: Column, key: str) -> Column:
    return F.get(F.transform(F.filter(param_pairs(c), lambda x: F.lower(x["k"]) == key), lambda x: x["v"]), F.lit(0))


def service_url(c: Column) -> Column:
    """The description request of the service that a URL belongs to; null for others."""
    proto = service_protocol(c)
    ogc = F.concat(base_url(c), F.lit("?"), F.concat_ws("&", F.concat(F.lit("Service="), _first(c, "service")), F.concat(F.lit("Version="), _first(c, "version")), F.lit("Request=GetCapabilities")))
    return F.when(proto == "OGC", ogc).when(proto == "OAI-PMH", F.concat(base_url(c), F.lit("?verb=Identify")))


def append_params(c: Column, service: str, version: str, request: str) -> Column:
    return F.concat(c, F.when(F.instr(c, "?") > 0, "&").otherwise("?"), F.lit(f"SERVICE={service}&VERSION={version}&REQUEST={request}"))


def urlencode(pairs: list[tuple[str, Column]]) -> Column:
    return F.concat_ws("&", *[F.concat(F.lit(k + "="), F.url_encode(v.cast("string"))) for k, v in pairs])


def ogc_request(url: Column, layer: Column, bbox: list[Column], service: Column, version: Column) -> Column:
    """The data request for a layer: map, feature or coverage; '' for CSW and SOS."""
    box = F.concat_ws(",", *bbox)
    common = [("service", service), ("version", version)]
    crs = F.when(version == "1.3.0", F.lit("crs=CRS%3A84")).otherwise(F.lit("srs=EPSG%3A4326"))
    wms = F.concat_ws("&", urlencode([*common, ("request", F.lit("GetMap")), ("layers", layer), ("width", F.lit(500)), ("height", F.lit(500)), ("styles", F.lit("")), ("format", F.lit("image/png"))]), crs, urlencode([("bbox", box)]))
    wfs = urlencode([*common, ("request", F.lit("GetFeature")), ("featureid", layer), ("typenames", F.lit("namespace:featuretype"))])
    wcs = urlencode([*common, ("request", F.lit("GetCoverage")), ("coverage", layer), ("width", F.lit(500)), ("height", F.lit(500)), ("crs", F.lit("CRS:84")), ("bbox", box), ("format", F.lit("GTiff"))])
    q = F.when(service == "WMS", wms).when(service == "WFS", wfs).when(service == "WCS", wcs)
    return F.coalesce(F.concat(base_url(url), F.lit("?"), q), F.lit(""))


def splice(source: Column, rel: Column) -> Column:
    """A relative path resolved against a catalog's URL.

    Absolute links stay. If the path begins with a segment of the source's path, it
    takes that segment's place; else it is appended to the source's folder.
    """
    rel0 = F.regexp_replace(rel, "^/", "")
    head = F.substring_index(rel0, "/", 1)
    segs = F.split(path_of(source), "/")
    at = F.array_position(segs, head)
    root = F.regexp_extract(source, r"^[^/]*//[^/?#]*", 0)
    spliced = F.concat(root, F.array_join(F.slice(segs, F.lit(1), F.greatest(at.cast("int") - 1, F.lit(0))), "/"), F.lit("/"), rel0)
    folder = F.regexp_replace(F.replace(base_url(source), F.lit("catalog.xml"), F.lit("")), "[^/]*$", "")
    return F.when(rel.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), rel).when((at > 0) & (head != ""), spliced).otherwise(F.concat(folder, rel0))


def thredds_params(service: Column) -> Column:
    """The capabilities request that fits a THREDDS service base, else ''."""
    s = F.lower(service)
    q = lambda name, v: F.lit(f"?service={name}&request=getcapabilities&version={v}")
    return F.when(F.contains(s, F.lit("wms")), q("wms", "1.3.0")).when(F.contains(s, F.lit("wfs")), q("wfs", "1.1.0")).when(F.contains(s, F.lit("wcs")), q("wcs", "1.1.2")).otherwise("")


def thredds_urls(source: Column, tag: Column, href: Column, bases: Column) -> Column:
    """All URLs of a catalog's element: each service base with a dataset's path, or the one link of a catalog reference."""
    base = lambda b: F.regexp_replace(b, "/$", "")
    data = F.transform(bases, lambda b: F.concat(splice(source, F.concat(base(b), F.lit("/"), href)), thredds_params(b)))
    return F.when(href.isNull(), F.array().cast("array<string>")).when(tag == "catalogRef", F.array(splice(source, href))).otherwise(F.array_distinct(data))


def opensearch_link(template: Column, limit: int = 5) -> Column:
    """A search request from a template: fixed parameters stay, a count becomes ``limit``, the search terms stay empty; null without scheme."""
    held = lambda v: v.rlike(r"^\{.*\}$")
    pairs = param_pairs(template)
    kept = F.filter(pairs, lambda x: ~held(x["v"]) & ~x["v"].startswith("{") & ~x["v"].endswith("}"))
    count = F.transform(F.filter(pairs, lambda x: held(x["v"]) & F.contains(x["v"], F.lit("count"))), lambda x: F.struct(x["k"].alias("k"), F.lit(str(limit)).alias("v")))
    terms = F.transform(F.slice(F.filter(pairs, lambda x: held(x["v"]) & F.contains(x["v"], F.lit("searchTerms"))), 1, 1), lambda x: F.struct(x["k"].alias("k"), F.lit("").alias("v")))
    q = F.array_join(F.transform(F.concat(kept, count, terms), lambda x: F.concat(F.url_encode(x["k"]), F.lit("="), F.url_encode(x["v"]))), "&")
    return F.when(template.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(base_url(template), F.lit("?"), q))


def template_params(template: Column) -> Column:
    """A template's parameters: array<struct<name, prefix, type, format>>."""
    held = F.filter(param_pairs(template), lambda x: x["v"].rlike(r"^\{.*\}$"))

    def one(x: Column) -> Column:
        inner = F.regexp_replace(x["v"], r"^\{|\??\}$", "")
        prefix = F.when(F.instr(inner, ":") > 0, F.substring_index(inner, ":", 1)).otherwise("")
        kind = F.substring_index(inner, ":", -1)
        full = F.concat_ws(":", F.nullif(prefix, F.lit("")), kind)
        fmt = F.when(full == "geo:box", "west, south, east, north").when(full.isin("time:start", "time:stop", "time:end"), "YYYY-MM-DDTHH:mm:ssZ").otherwise("")
        return F.struct(x["k"].alias("name"), prefix.alias("prefix"), kind.alias("type"), fmt.alias("format"))

    return F.transform(held, one)
