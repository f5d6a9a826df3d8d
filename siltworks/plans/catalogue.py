"""Queries of the document operators over the test tables, each beside its SQL.

Where the tables have no text of an operator's kind, a query first writes such text
from relational columns (XML, URLs, identifiers) and then reads it back with the
operator; its SQL gives the columns themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import clean as C
from ..functions import dates as D
from ..functions import geo as G
from ..functions import identifiers as I
from ..functions import jsontext as J
from ..functions import ogc_params as O
from ..functions import rules as R
from ..functions import text as T
from ..functions import url as U
from ..functions import xml as X
from ..operators import graph, readers, similarity
from ..operators.identify import first_identity, identify, route, routed
from ..operators.shred import Nodes, html_text, shred, tagged_texts, xml_values
from ..operators.unique_ids import extract_identifiers
from ..runtime import Stages, table
from ..sources import io

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


c, lit = F.col, F.lit

#: a raw response cleaned, in SQL
_BOM = r"regexp_replace(raw_content, '^\x{FEFF}', '')"
_CLEAN = rf"""trim(regexp_replace(regexp_replace(regexp_replace(
  CASE WHEN NOT starts_with({_BOM}, '<![CDATA[') THEN {_BOM} WHEN regexp_matches({_BOM}, '(?s)^<!\[CDATA\[.*?\]\]>$') THEN regexp_extract({_BOM}, '(?s)^<!\[CDATA\[(.*?)\]\]>$', 1) END,
  '\\{{1,2}}ufffd|\x{{FFFD}}', ' ', 'g'), '\\[nt]', ' ', 'g'), '\s+', ' ', 'g'), ' ')"""


def _harvest(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    return table(spark, sf, "harvest_records", ["record_id", "url", "raw_content", "content_type", *cols])


def _content(raw: DataFrame) -> DataFrame:
    return raw.withColumn("content", C.collapse_space(C.strip_replacement_marks(C.unwrap_cdata(C.strip_bom(c("raw_content"))))))


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    """Harvested responses as readers take them."""
    raw = _content(_harvest(spark, sf, "harvest_date")).select(c("record_id").alias("doc_id"), "url", "harvest_date", "content")
    return shred(raw, "content", ["doc_id", "url", "harvest_date", "content"])


def _xml(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else lit(p) for p in parts])


def _el(tag: str, value) -> Column:
    v = value if isinstance(value, Column) else lit(value)
    return F.concat(lit(f"<{tag}>"), v.cast("string"), lit(f"</{tag}>"))


def _written(df: DataFrame, doc_id: str, xml: Column, url: Column | None = None) -> DataFrame:
    """Documents written from columns, shredded."""
    docs = df.select(c(doc_id).alias("doc_id"), (url if url is not None else F.concat(lit("http://x.test/"), c(doc_id).cast("string"))).alias("url"), lit("2015-01-01").alias("harvest_date"), xml.alias("content"))
    return shred(docs, "content", ["doc_id", "url", "harvest_date"])


# --- cleaning ------------------------------------------------------------------------


@query(rf"SELECT record_id, {_CLEAN} AS content FROM harvest_records")
def clean_content(spark, sf):
    """Raw responses without wrapper, marks and runs of white space."""
    return _content(_harvest(spark, sf)).select("record_id", "content")


@query(rf"SELECT record_id, CASE WHEN NOT starts_with(raw_content, '<![CDATA[') THEN raw_content WHEN regexp_matches(raw_content, '(?s)^<!\[CDATA\[.*?\]\]>$') THEN regexp_extract(raw_content, '(?s)^<!\[CDATA\[(.*?)\]\]>$', 1) END AS inside FROM harvest_records")
def cdata_unwrap(spark, sf):
    return _harvest(spark, sf).select("record_id", C.unwrap_cdata(c("raw_content")).alias("inside"))


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\\[nt]', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ') AS text FROM documents")
def collapse_whitespace(spark, sf):
    return table(spark, sf, "documents", ["doc_id", "text"]).select("doc_id", C.collapse_space(c("text")).alias("text"))


@query("""SELECT record_id, CASE WHEN len(list_filter(content_type, lambda x: contains(lower(x), 'xml'))) > 0 THEN 'xml' ELSE '' END AS datatype FROM harvest_records
UNION ALL SELECT -event_id, CASE WHEN json_valid(props) THEN 'json' ELSE '' END FROM events""")
def sniff_type(spark, sf):
    """By header for responses, by what parses for event properties."""
    by_head = _harvest(spark, sf).select("record_id", C.sniff_type(lit(None).cast("string"), F.concat_ws(" ", "content_type")).alias("datatype"))
    by_body = table(spark, sf, "events", ["event_id", "props"]).select((-c("event_id")).alias("record_id"), C.sniff_type(c("props"), lit(None)).alias("datatype"))
    return by_head.unionAll(by_body)


@query(rf"SELECT record_id, substr({_CLEAN}, greatest(instr({_CLEAN}, '<'), 1)) AS content FROM harvest_records WHERE raw_content IS NOT NULL")
def strip_invalid_start(spark, sf):
    """Junk is put before each response and cut off again."""
    junk = _content(_harvest(spark, sf)).where("raw_content IS NOT NULL")
    return junk.select("record_id", C.strip_invalid_start(F.concat(lit("HTTP/1.1 200 OK "), c("content")), lit("xml")).alias("content"))


# --- URLs ----------------------------------------------------------------------------


def _urls(spark, sf):
    return table(spark, sf, "url_entities", ["url_id", "vcard_hasurl"]).withColumnRenamed("vcard_hasurl", "u")


@query(r"SELECT url_id, regexp_extract(vcard_hasurl, '^[^?#;]*') AS base, regexp_extract(vcard_hasurl, '^[^?#]*\?([^#]*)', 1) AS query, regexp_extract(vcard_hasurl, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1) AS host FROM url_entities")
def url_parts(spark, sf):
    return _urls(spark, sf).select("url_id", U.base_url(c("u")).alias("base"), U.query_string(c("u")).alias("query"), U.host_of(c("u")).alias("host"))


@query(r"""SELECT url_id, url_decode(replace(regexp_extract(p, '^([^=]*)=', 1), '+', ' ')) AS k, url_decode(replace(regexp_extract(p, '(?s)^[^=]*=(.*)$', 1), '+', ' ')) AS v
FROM (SELECT url_id, unnest(regexp_split_to_array(regexp_extract(vcard_hasurl, '^[^?#]*\?([^#]*)', 1), '[&;]')) p FROM url_entities) WHERE contains(p, '=') AND regexp_extract(p, '(?s)^[^=]*=(.*)$', 1) <> ''""")
def url_params_exploded(spark, sf):
    return _urls(spark, sf).select("url_id", F.inline(U.param_pairs(c("u"))))


@query(r"""WITH p AS (SELECT url_id, lower(url_decode(replace(regexp_extract(p, '^([^=]*)=', 1), '+', ' '))) k, url_decode(replace(regexp_extract(p, '(?s)^[^=]*=(.*)$', 1), '+', ' ')) v
FROM (SELECT url_id, unnest(regexp_split_to_array(regexp_extract(vcard_hasurl, '^[^?#]*\?([^#]*)', 1), '[&;]')) p FROM url_entities) WHERE contains(p, '=') AND regexp_extract(p, '(?s)^[^=]*=(.*)$', 1) <> '')
SELECT url_id, k, CAST(count(*) AS BIGINT) AS n FROM p GROUP BY url_id, k""")
def url_param_map(spark, sf):
    """Parameters as a multimap with lower-case names: number of values by name."""
    m = _urls(spark, sf).where("u IS NOT NULL").select("url_id", F.explode(U.params(c("u"), lower_keys=True)).alias("k", "v"))
    return m.select("url_id", "k", F.size("v").cast("bigint").alias("n"))


@query("SELECT p_partkey, p_name FROM part")
def url_unquote(spark, sf):
    p = table(spark, sf, "part", ["p_partkey", "p_name"])
    return p.select("p_partkey", U.unquote(F.replace(F.url_encode("p_name"), lit("+"), lit("%20"))).alias("p_name"))


@query(r"""SELECT url_id, array_to_string(list_sort(list_filter(string_split(regexp_extract(vcard_hasurl, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1) || regexp_extract(vcard_hasurl, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/'), lambda s: s <> '')), '') AS signature FROM url_entities""")
def url_sorted_signature(spark, sf):
    return _urls(spark, sf).select("url_id", U.signature(c("u")).alias("signature"))


@query()
def url_sha_urn(spark, sf):
    """SHA-224 names of URLs (DuckDB has no SHA-224)."""
    return _urls(spark, sf).select("url_id", U.sha_urn(c("u")).alias("urn"))


@query("SELECT url_id, 'urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS urn FROM (SELECT url_id, sha256(coalesce(vcard_hasurl, '') || '|url') h FROM url_entities)")
def url_uuid_urn(spark, sf):
    """Ids that are the same in every run."""
    return _urls(spark, sf).select("url_id", U.uuid_urn(c("u"), lit("url")).alias("urn"))


_KEYS = r"[lower(url_decode(replace(regexp_extract(p, '^([^=]*)=', 1), '+', ' '))) FOR p IN regexp_split_to_array(regexp_extract(vcard_hasurl, '^[^?#]*\?([^#]*)', 1), '[&;]') IF contains(p, '=') AND regexp_extract(p, '(?s)^[^=]*=(.*)$', 1) <> '']"


@query(f"SELECT url_id, CASE WHEN len(list_intersect(k, ['service', 'version', 'request'])) > 0 THEN 'OGC' WHEN list_contains(k, 'verb') THEN 'OAI-PMH' ELSE '' END AS protocol FROM (SELECT url_id, coalesce({_KEYS}, []) k FROM url_entities WHERE vcard_hasurl IS NOT NULL)")
def service_url_classify(spark, sf):
    return _urls(spark, sf).where("u IS NOT NULL").select("url_id", U.service_protocol(c("u")).alias("protocol"))


@query("SELECT o_orderkey, 'http://h.test/ows?Service=WMS&Version=1.' || (o_orderkey % 4) || '&Request=GetCapabilities' AS url FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'http://h.test/oai?verb=Identify' FROM orders WHERE o_orderkey % 2 = 1")
def service_url_rebuild(spark, sf):
    k = c("o_orderkey")
    ogc = F.concat(lit("http://h.test/ows?request=GetMap&VERSION=1."), (k % 4).cast("string"), lit("&service=WMS&layers=l"), k.cast("string"))
    return table(spark, sf, "orders", ["o_orderkey"]).select("o_orderkey", U.service_url(F.when(k % 2 == 0, ogc).otherwise(F.concat(lit("http://h.test/oai?verb=GetRecord&identifier="), k.cast("string")))).alias("url"))


@query("""SELECT n_nationkey, 'http://h.test/ows?' || CASE n_regionkey % 3
 WHEN 0 THEN 'service=WMS&version=1.3.0&request=GetMap&layers=' || replace(url_encode(n_name), '%20', '+') || '&width=500&height=500&styles=&format=image%2Fpng&crs=CRS%3A84&bbox=' || (0 - n_nationkey) || '%2C' || (0 - n_regionkey) || '%2C' || n_nationkey || '%2C' || n_regionkey
 WHEN 1 THEN 'service=WFS&version=1.1.0&request=GetFeature&featureid=' || replace(url_encode(n_name), '%20', '+') || '&typenames=namespace%3Afeaturetype'
 ELSE 'service=WCS&version=1.0.0&request=GetCoverage&coverage=' || replace(url_encode(n_name), '%20', '+') || '&width=500&height=500&crs=CRS%3A84&bbox=' || (0 - n_nationkey) || '%2C' || (0 - n_regionkey) || '%2C' || n_nationkey || '%2C' || n_regionkey || '&format=GTiff' END AS url FROM nation""")
def ogc_request_url(spark, sf):
    n = table(spark, sf, "nation")
    s = F.element_at(F.array(*map(lit, ("WMS", "WFS", "WCS"))), (c("n_regionkey") % 3 + 1).cast("int"))
    v = F.element_at(F.array(*map(lit, ("1.3.0", "1.1.0", "1.0.0"))), (c("n_regionkey") % 3 + 1).cast("int"))
    box = [(-c("n_nationkey")).cast("string"), (-c("n_regionkey")).cast("string"), c("n_nationkey").cast("string"), c("n_regionkey").cast("string")]
    return n.select("n_nationkey", U.ogc_request(lit("http://h.test/ows?x=1"), c("n_name"), box, s, v).alias("url"))


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'http://h.test/thredds/dodsC/f' || s_suppkey || '.nc' WHEN 1 THEN 'http://h.test/thredds/cat/sub/g' || s_suppkey || '.nc' ELSE 'ftp://o.test/' || s_suppkey END AS url FROM supplier""")
def thredds_link_splice(spark, sf):
    k = c("s_suppkey").cast("string")
    rel = F.when(c("s_suppkey") % 3 == 0, F.concat(lit("/thredds/dodsC/f"), k, lit(".nc"))).when(c("s_suppkey") % 3 == 1, F.concat(lit("sub/g"), k, lit(".nc"))).otherwise(F.concat(lit("ftp://o.test/"), k))
    return table(spark, sf, "supplier", ["s_suppkey"]).select("s_suppkey", U.splice(lit("http://h.test/thredds/cat/catalog.xml"), rel).alias("url"))


@query("SELECT p_partkey, 'http://h.test/s?v=' || p_size || '&n=5&q=' AS url FROM part")
def opensearch_link_from_template(spark, sf):
    t = F.concat(lit("http://h.test/s?q={searchTerms}&n={count?}&b={geo:box?}&v="), c("p_size").cast("string"))
    return table(spark, sf, "part", ["p_partkey", "p_size"]).select("p_partkey", U.opensearch_link(t).alias("url"))


# --- text --------------------------------------------------------------------------------


@query(r"SELECT set_id, regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(bcube_hasvalue, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&apos;', ''''), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '_', ' '), '[;|>+:=(){}]', ',', 'g') AS normalized FROM keyword_sets".replace('\\"', '"'))
def keyword_normalize(spark, sf):
    return table(spark, sf, "keyword_sets", ["set_id", "bcube_hasvalue"]).select("set_id", T.normalize_keywords(c("bcube_hasvalue")).alias("normalized"))


@query("SELECT DISTINCT item_id, CAST(list_sort(list_distinct([replace(s, '_', ' ') FOR s IN subjects IF s IS NOT NULL AND s <> ''])) AS VARCHAR[]) AS terms FROM atom_items WHERE subjects IS NOT NULL")
def normalize_subjects(spark, sf):
    a = table(spark, sf, "atom_items", ["item_id", "subjects"]).where("subjects IS NOT NULL")
    return a.select("item_id", T.normalize_subjects(c("subjects")).alias("terms")).distinct()


@query(r"SELECT doc_id, CASE WHEN t = '-' THEN '' ELSE t END AS text FROM (SELECT doc_id, trim(replace(regexp_replace(text, '[;|>+:=.,()/?!\[\]{}]', ' ', 'g'), ' - ', ' '), ' ') t FROM documents)")
def remove_punctuation(spark, sf):
    return table(spark, sf, "documents", ["doc_id", "text"]).select("doc_id", T.remove_punctuation(c("text")).alias("text"))


@query("""SELECT doc_id, trim(text, '(){}[].,~|":&-') AS text FROM documents""")
def strip_terminal_punct(spark, sf):
    return table(spark, sf, "documents", ["doc_id", "text"]).select("doc_id", T.strip_terminal(c("text")).alias("text"))


@query("SELECT url_id, CAST(len(regexp_split_to_array(vcard_hasurl, '[/:.]')) AS BIGINT) AS n, regexp_split_to_array(vcard_hasurl, '[/:.]')[-1] AS last FROM url_entities WHERE vcard_hasurl IS NOT NULL")
def split_words(spark, sf):
    w = T.split_words(c("u"))
    return _urls(spark, sf).where("u IS NOT NULL").select("url_id", F.size(w).cast("bigint").alias("n"), F.element_at(w, -1).alias("last"))


_STOPS = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in T.STOPWORDS.items() if k != "en") + f" ELSE {T.STOPWORDS['en']} END"


@query(rf"SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(trim(text, ' '), '[ \t\n\x0B\f\r]+'), lambda w: w <> '' AND NOT list_contains({_STOPS}, w)), ' ') AS text FROM documents WHERE text IS NOT NULL")
def remove_stopwords(spark, sf):
    """Every document without the stopwords of its language; of those without language, the English ones."""
    d = table(spark, sf, "documents", ["doc_id", "text", "lang"]).where("text IS NOT NULL")
    out = T.remove_stopwords(c("text"))
    for k in T.STOPWORDS:
        out = F.when(c("lang") == k, T.remove_stopwords(c("text"), k)).otherwise(out)
    return d.select("doc_id", out.alias("text"))


@query("SELECT l_orderkey, l_linenumber, 'ship ' || l_returnflag || l_linestatus || l_partkey || ' of' AS text FROM lineitem")
def remove_numeric(spark, sf):
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "l_quantity"])
    t = F.concat(lit("ship "), c("l_quantity").cast("string"), lit(" "), c("l_returnflag"), c("l_linestatus"), c("l_partkey").cast("string"), lit(" -12 of 1,000"))
    return li.select("l_orderkey", "l_linenumber", T.remove_numeric(t).alias("text"))


_TOKENS = r"regexp_extract_all(text, '[\p{L}\p{N}]+(?:[-''’_.][\p{L}\p{N}]+)*|[^ \t\n\x0B\f\r\p{L}\p{N}]')"


@query(rf"SELECT w AS word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest({_TOKENS}) w FROM documents) WHERE regexp_matches(w, '[\p{{L}}\p{{N}}]') GROUP BY w")
def bag_of_words(spark, sf):
    """Words of the whole corpus with their counts."""
    d = table(spark, sf, "documents", ["text"])
    return d.select(F.explode(T.words(c("text"), resplit=False)).alias("word")).groupBy("word").agg(F.count(lit(1)).alias("n"))


@query(f"SELECT doc_id, list_filter({list(T.MIMETYPES)}, lambda m: contains(text, m)) AS found, regexp_replace(text, '{'|'.join(m.replace('+', '[+]').replace('.', '[.]') for m in sorted(T.MIMETYPES, key=lambda m: (-len(m), m)))}', '', 'g') AS text FROM documents WHERE text IS NOT NULL")
def extract_mimetypes(spark, sf):
    m = T.extract_mimetypes(c("text"))
    return table(spark, sf, "documents", ["doc_id", "text"]).where("text IS NOT NULL").select("doc_id", m["found"].alias("found"), m["text"].alias("text"))


_VOTES = ", ".join(f"{{'n': len(list_filter(ws, lambda w: list_contains({v}, w))), 'lang': '{k}'}}" for k, v in sorted(T.STOPWORDS.items()))


@query(rf"""WITH t AS (SELECT lang, [lower(w) FOR w IN {_TOKENS} IF regexp_full_match(w, '\p{{L}}+')] ws FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL),
best AS (SELECT lang, list_max([{_VOTES}]) b FROM t)
SELECT lang, CASE WHEN b.n > 0 THEN b.lang END AS guess, CAST(count(*) AS BIGINT) AS n FROM best GROUP BY ALL""")
def language_guess(spark, sf):
    """The language of each document by its stopwords, against the given one."""
    d = table(spark, sf, "documents", ["doc_id", "text", "lang"]).where("text IS NOT NULL AND lang IS NOT NULL")
    return d.groupBy("lang", T.language(c("text")).alias("guess")).agg(F.count(lit(1)).alias("n"))


@query(r"SELECT doc_id, trim(regexp_replace(text, 'application/xml|text/xml|image/png', '', 'g'), ' ') AS text FROM documents")
def remove_tokens(spark, sf):
    d = table(spark, sf, "documents", ["doc_id", "text"])
    return d.select("doc_id", F.trim(T.remove_tokens(c("text"), ("application/xml", "text/xml", "image/png"))).alias("text"))


@query("SELECT event_id, [json_extract_string(props, '$.k')] AS terms FROM events")
def flatten_json(spark, sf):
    """Terminal values of nested JSON, without those of excluded names."""
    e = table(spark, sf, "events", ["event_id", "props"])
    doc = F.concat(lit('{"a": [{"p": '), c("props"), lit('}, null, []], "url": ["no"], "b": " "}'))
    return e.select("event_id", J.flatten_json(doc, ("url",)).alias("terms"))


@query()
def bag_of_descriptions(spark, sf):
    """The bag of words of each description, without its URLs."""
    d = table(spark, sf, "descriptions", ["desc_id", "body"]).distinct()
    return d.select("desc_id", T.collapse_to_bag(J.flatten_json(c("body"), ("urls", "vcard:hasURL"))).alias("bag"))


@query("SELECT p_partkey, ['Z' || p_size] AS terms FROM part")
def pos_terms(spark, sf):
    """Tokens tagged by the built-in tagger, only the names."""
    p = table(spark, sf, "part", ["p_partkey", "p_size"])
    tagged = T.tagged(p.withColumn("t", F.concat(lit("at Z"), c("p_size").cast("string"), lit("/depth: 12"))), "t", ["p_partkey"])
    return tagged.select("p_partkey", T.by_pos(c("terms"), ("NAME",)).alias("terms"))


# --- geometry and dates ----------------------------------------------------------------------


@query("SELECT c_custkey, printf('POLYGON ((%d %d,%d %d,%d %d,%d %d,%d %d))', w, s, w, n, e, n, e, s, w, s) AS wkt FROM (SELECT c_custkey, -(c_custkey % 180) w, -(c_custkey % 90) s, c_custkey % 180 e, c_nationkey n FROM customer)")
def bbox_wkt(spark, sf):
    k = c("c_custkey")
    return table(spark, sf, "customer", ["c_custkey", "c_nationkey"]).select("c_custkey", G.bbox_wkt(-(k % 180), -(k % 90), k % 180, c("c_nationkey")).alias("wkt"))


@query("SELECT dataset_id, CASE WHEN esip_westbound IS NULL OR esip_southbound IS NULL OR esip_eastbound IS NULL OR esip_northbound IS NULL THEN '' ELSE 'POLYGON ((' || esip_westbound || ' ' || esip_southbound || ',' || esip_westbound || ' ' || esip_northbound || ',' || esip_eastbound || ' ' || esip_northbound || ',' || esip_eastbound || ' ' || esip_southbound || ',' || esip_westbound || ' ' || esip_southbound || '))' END AS wkt FROM datasets")
def dataset_wkt(spark, sf):
    d = table(spark, sf, "datasets", ["dataset_id", "esip_westbound", "esip_southbound", "esip_eastbound", "esip_northbound"])
    return d.select("dataset_id", G.bbox_wkt(c("esip_westbound"), c("esip_southbound"), c("esip_eastbound"), c("esip_northbound")).alias("wkt"))


@query("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'epsg:' || c_custkey WHEN 1 THEN 'EPSG:' || c_custkey WHEN 2 THEN 'EPSG:4326' WHEN 3 THEN '' ELSE 'EPSG:4326' END AS epsg FROM customer")
def epsg_alias(spark, sf):
    k = c("c_custkey").cast("string")
    named = F.when(c("c_custkey") % 5 == 0, F.concat(lit("epsg:"), k)).when(c("c_custkey") % 5 == 1, F.concat(lit("urn:ogc:def:crs:EPSG:6.9:"), k)).when(c("c_custkey") % 5 == 2, "CRS:84").when(c("c_custkey") % 5 == 3, F.concat(lit("SRID "), k)).otherwise("urn:ogc:def:crs:OGC:1.3:CRS84")
    return table(spark, sf, "customer", ["c_custkey"]).select("c_custkey", G.epsg(named).alias("epsg"))


@query("SELECT s_suppkey, 'POLYGON ((0 0,' || s_suppkey || ' 0,' || s_suppkey || ' ' || s_nationkey || ',0 0))' AS wkt FROM supplier")
def gml_polygon(spark, sf):
    k, n = c("s_suppkey").cast("string"), c("s_nationkey").cast("string")
    return table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"]).select("s_suppkey", G.gml_polygon(F.array(lit("0 0"), F.concat(k, lit(" 0")), F.concat(k, lit(" "), n))).alias("wkt"))


@query("SELECT o_custkey, min(o_orderdate)::TIMESTAMP AS first_at, max(o_orderdate)::TIMESTAMP AS last_at FROM orders GROUP BY o_custkey")
def time_range_minmax(spark, sf):
    """Begin and end of a written list of moments."""
    o = table(spark, sf, "orders", ["o_custkey", "o_orderdate"]).groupBy("o_custkey").agg(F.array_join(F.collect_list(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")), ",").alias("t"))
    r = D.time_range(F.concat("t", lit(",never")))
    return o.select("o_custkey", r["begin"].cast("timestamp_ntz").alias("first_at"), r["end"].cast("timestamp_ntz").alias("last_at"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(date_trunc('year', o_orderdate), '%Y-%m-%dT00:00:00') WHEN 1 THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%dT00:00:00') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00') ELSE '' END AS d FROM orders""")
def fgdc_date_convert(spark, sf):
    o, k = table(spark, sf, "orders", ["o_orderkey", "o_orderdate"]), c("o_orderkey")
    d = F.when(k % 4 == 0, F.date_format("o_orderdate", "yyyy")).when(k % 4 == 1, F.date_format("o_orderdate", "yyyyMM")).when(k % 4 == 2, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("unknown")
    return o.select("o_orderkey", D.short_date(d).alias("d"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN strftime(o_orderdate, '%Y-%m-%d') || ' in ' || o_orderkey ELSE '' END AS text FROM orders")
def strip_dates(spark, sf):
    """Texts that are dates as a whole become empty, others stay."""
    o, k = table(spark, sf, "orders", ["o_orderkey", "o_orderdate"]), c("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(k % 3 == 0, day).when(k % 3 == 1, F.date_format("o_orderdate", "d MMM yyyy")).otherwise(F.concat(day, lit(" in "), k.cast("string")))
    return o.select("o_orderkey", D.strip_dates(text).alias("text"))


# --- rules ---------------------------------------------------------------------------------------

_R = R.Rule
#: rules of the invented standards in the test harvest, in the product's own form
HARVEST_RULES = [
    _R("OpenSearch", "service", "OpenSearchDescription", R.all_of(R.content('xmlns="urn:x-osd'), R.content("<opensearchdescription")), versions=((R.content("urn:x-osd:1.1"), "1.1"),)),
    _R("OAI-PMH", "service", "Identify", R.all_of(R.content("urn:x-oai"), R.content("<Identify>")), "Identify"),
    _R("OGC", "service", "WMS", R.all_of(R.content("urn:x-wms"), R.any_of(R.url("REQUEST=GETCAPABILITIES"), R.content("<WMS_Capabilities"))), "GetCapabilities"),
    _R("ISO", "metadata", "19115", R.content("urn:x-gmd")),
    _R("FGDC", "metadata", "FGDC", R.Matches("content", "^<metadata>.*<idinfo>")),
    _R("UNIDATA", "service", "THREDDS-Catalog", R.content("urn:x-thredds"), errors=R.content("<service")),
    _R("ATOM", "resultset", "ATOM", R.all_of(R.content("urn:x-atom"), R.content("<feed"))),
    _R("Any", "file", "XML", R.Matches("content", "^<")),
]
_UP = "upper(content)"
_WHEN = [
    f"contains({_UP}, 'XMLNS=\"URN:X-OSD') AND contains({_UP}, '<OPENSEARCHDESCRIPTION')", f"contains({_UP}, 'URN:X-OAI') AND contains({_UP}, '<IDENTIFY>')", f"contains({_UP}, 'URN:X-WMS') AND (contains(upper(url), 'REQUEST=GETCAPABILITIES') OR contains({_UP}, '<WMS_CAPABILITIES'))",
    f"contains({_UP}, 'URN:X-GMD')", "regexp_matches(content, '^<metadata>.*<idinfo>')", f"contains({_UP}, 'URN:X-THREDDS')", f"contains({_UP}, 'URN:X-ATOM') AND contains({_UP}, '<FEED')", "regexp_matches(content, '^<')",
]
_H = f"(SELECT record_id, url, {_CLEAN} content FROM harvest_records)"


def _identified(spark, sf):
    return identify(_content(_harvest(spark, sf)), HARVEST_RULES)


@query("SELECT record_id, protocol, name, CAST(rule_order AS BIGINT) AS rule_order FROM (" + " UNION ALL ".join(f"SELECT record_id, '{r.protocol}' protocol, '{r.name}' AS name, {i} rule_order FROM {_H} WHERE {w}" for i, (r, w) in enumerate(zip(HARVEST_RULES, _WHEN))) + ")")
def identify_all(spark, sf):
    """All matching rules of every response."""
    return _identified(spark, sf).select("record_id", F.inline("identities")).select("record_id", "protocol", "name", c("rule_order").cast("bigint").alias("rule_order"))


_FIRST = "CASE " + " ".join(f"WHEN {w} THEN '{r.protocol}'" for r, w in zip(HARVEST_RULES, _WHEN)) + " END"


@query(f"SELECT record_id, {_FIRST} AS protocol FROM {_H}")
def identify_first_match(spark, sf):
    return _identified(spark, sf).select("record_id", first_identity(c("identities"))["protocol"].alias("protocol"))


@query(f"SELECT protocol, CAST(count(*) AS BIGINT) AS n_docs, CAST(count(DISTINCT url) AS BIGINT) AS n_urls FROM (SELECT url, {_FIRST} protocol FROM {_H}) GROUP BY protocol")
def identity_rollup(spark, sf):
    return _identified(spark, sf).groupBy(first_identity(c("identities"))["protocol"].alias("protocol")).agg(F.count(lit(1)).alias("n_docs"), F.countDistinct("url").alias("n_urls"))


@query(f"SELECT record_id, CASE {_FIRST} WHEN 'OpenSearch' THEN 'opensearch' WHEN 'OAI-PMH' THEN 'oaipmh' WHEN 'OGC' THEN 'ogc' WHEN 'ISO' THEN 'iso' WHEN 'FGDC' THEN 'fgdc' WHEN 'UNIDATA' THEN 'thredds' WHEN 'Any' THEN 'xml' END AS reader FROM {_H}")
def route_documents(spark, sf):
    """The reader for each response; feeds are ignored, the unknown are read as XML."""
    return _identified(spark, sf).select("record_id", route(first_identity(c("identities")), ignore=("ATOM",), parse_as_xml=("Any",)).alias("reader"))


#: a small response of each standard: content, url, protocol and name that the catalogue of rules must give first
_GETCAP = "http://h.test/ows?request=GetCapabilities"
_GMD = "http://www.isotc211.org/2005/gmd"
STANDARD_SAMPLES = [
    ('<WMS_Capabilities xmlns="http://www.opengis.net/wms" version="1.3.0"/>', _GETCAP, "OGC", "WMS"),
    ('<WCS_Capabilities xmlns="http://www.opengis.net/wcs" version="1.0.0"/>', _GETCAP, "OGC", "WCS"),
    ('<WFS_Capabilities xmlns="http://www.opengis.net/wfs" version="1.1.0"/>', _GETCAP, "OGC", "WFS"),
    ('<Capabilities xmlns="http://www.opengis.net/sos/1.0"><GetCapabilities></GetCapabilities></Capabilities>', "", "OGC", "SOS"),
    ('<csw:Capabilities xmlns:csw="http://www.opengis.net/cat/csw/2.0.2"/>', _GETCAP, "OGC", "CSW"),
    ('<Capabilities xmlns="http://www.opengis.net/wmts/1.0"/>', _GETCAP, "OGC", "WMTS"),
    ('<CoverageDescription xmlns="http://www.opengis.net/wcs"/>', "", "OGC", "WCS"),
    ('<csw:GetRecordsResponse xmlns:csw="http://www.opengis.net/cat/csw/2.0.2"/>', "", "OGC", "CSW"),
    (f'<gmd:MD_Metadata xmlns:gmd="{_GMD}"/>', "", "ISO", "19115"),
    (f'<DS_Series xmlns="{_GMD}"/>', "", "ISO", "Data Series"),
    ('<srv:SV_ServiceIdentification xmlns:srv="http://www.isotc211.org/2005/srv"/>', "", "ISO", "19119"),
    ("<metadata><metainfo><metstdv>FGDC-STD-001-1998</metstdv></metainfo></metadata>", "", "FGDC", "FGDC"),
    ('<DIF xmlns="http://gcmd.gsfc.nasa.gov/Aboutus/xml/dif/"><Entry_ID>1</Entry_ID></DIF>', "", "DIF", "DIF"),
    ('<oai_dc:dc xmlns:oai_dc="http://www.openarchives.org/OAI/2.0/oai_dc/"/>', "", "DC", "DublinCore"),
    ('<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><Identify></Identify></OAI-PMH>', "", "OAI-PMH", "Identify"),
    ("<OAI-PMH><ListRecords></ListRecords></OAI-PMH>", "", "OAI-PMH", "OAI-PMH"),
    ("<OAI-PMH/>", "http://h.test/oai?verb=GetRecord", "OAI-PMH", "OAI-PMH"),
    ('<OpenSearchDescription xmlns="http://a9.com/-/spec/opensearch/1.1/"/>', "", "OpenSearch", "OpenSearchDescription"),
    ('<feed xmlns="http://www.w3.org/2005/Atom" xmlns:o="http://a9.com/-/spec/opensearch/1.1/"><o:itemsPerPage>1</o:itemsPerPage></feed>', "", "OpenSearch", "OpenSearch"),
    ('<catalog xmlns="http://www.unidata.ucar.edu/namespaces/thredds/InvCatalog/v1.0"/>', "", "UNIDATA", "THREDDS-Catalog"),
    ('<netcdf xmlns="http://www.unidata.ucar.edu/namespaces/netcdf/ncml-2.2" xmlns:d="http://xml.opendap.org/ns/DAP/3.2"/>', "", "OPeNDAP", "NCML"),
    ('<Dataset xmlns="http://xml.opendap.org/ns/DAP/3.2"/>', "", "OPeNDAP", "DDX"),
    ('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dcat="d"><dcat:Dataset rdf:about="x"/></rdf:RDF>', "", "RDF", "RDF"),
    ('<rss version="2.0"/>', "", "RSS", "RSS"),
    ('<feed xmlns="http://www.w3.org/2005/Atom"/>', "", "ATOM", "ATOM"),
    ('<application xmlns="http://wadl.dev.java.net/2009/02"/>', "", "WADL", "WADL"),
    ('<definitions xmlns="http://schemas.xmlsoap.org/wsdl/"/>', "", "WSDL", "WSDL"),
    ('<kml xmlns="http://earth.google.com/kml/2.2"/>', "", "KML", "KML"),
    ('<codeBook xmlns="http://www.ddialliance.org/Specification/DDI-Codebook/2.1/"/>', "", "DDI", "DDI"),
    ('<resource xmlns="http://datacite.org/schema/kernel-3"/>', "", "DataCite", "DataCite"),
    ('<eml xmlns="eml://ecoinformatics.org/eml-2.1.0"/>', "", "EML", "EML"),
    ('<q xmlns="http://quakeml.org/xmlns/bed/1.2"/>', "", "QuakeML", "QuakeML"),
    ('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"/>', "", "Sitemap", "Sitemap"),
    ('<e:Envelope xmlns:e="http://schemas.xmlsoap.org/soap/envelope/"/>', "", "SOAP", "SOAP"),
    ("<html/>", "https://zenodo.org/record/1", "Zenodo", "Zenodo"),
    ('<HDF5-File xmlns:hdf5="http://hdfgroup.org/DTDs/HDF5-File"/>', "", "HDF-XML", "HDF-XML"),
    ("<other/>", "http://h.test/", None, None),
    ("plain text", "", None, None),
]


@query("SELECT p_partkey, s[1] AS protocol, s[2] AS name FROM (SELECT p_partkey, [" + ", ".join("[NULL, NULL]" if p is None else f"['{p}', '{n}']" for *_, p, n in STANDARD_SAMPLES) + f"][p_partkey % {len(STANDARD_SAMPLES)} + 1] s FROM part)")
def identify_standards(spark, sf):
    """The whole catalogue of rules over a response of every kind."""
    sample = F.get(F.array(*[F.struct(lit(x).alias("content"), lit(u).alias("url")) for x, u, *_ in STANDARD_SAMPLES]), (c("p_partkey") % len(STANDARD_SAMPLES)).cast("int"))
    docs = table(spark, sf, "part", ["p_partkey"]).withColumn("s", sample).select("p_partkey", "s.*")
    return identify(docs).select("p_partkey", first_identity(c("identities")).alias("i")).select("p_partkey", c("i.protocol").alias("protocol"), c("i.name").alias("name"))


@query("SELECT doc_id, contains(upper(text), 'WMS') AND (contains(upper(text), 'LAYERS') OR contains(upper(url), '/DOC/1')) AS hit FROM documents")
def rule_simple_match(spark, sf):
    d = table(spark, sf, "documents", ["doc_id", "text", "url"])
    p = R.all_of(R.content("wms"), R.any_of(R.content("layers"), R.url("/doc/1")))
    out = d.select("doc_id", R.compile_predicate(p, {"content": "text", "url": "url"}).alias("hit"), "text", "url")
    # SQL's null is the rule's false
    return out.select("doc_id", F.when(c("text").isNotNull(), c("hit")).alias("hit"))


@query("SELECT doc_id, coalesce(regexp_matches(text, 'EPSG:[0-9]{4}'), false) AS hit FROM documents")
def rule_regex_match(spark, sf):
    d = table(spark, sf, "documents", ["doc_id", "text"])
    return d.select("doc_id", R.compile_predicate(R.Matches("content", "EPSG:[0-9]{4}"), {"content": "text"}).alias("hit"))


def _order_xml(spark, sf):
    o = table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey"])
    doc = _xml('<?xml version="1.0"?><!DOCTYPE x><a:Order xmlns:a="urn:o" version="', F.when(c("o_orderkey") % 3 == 0, "").otherwise(c("o_orderstatus")), '"><a:Status>', c("o_orderstatus"), "</a:Status><a:Priority> ", c("o_orderpriority"), " </a:Priority>", F.when(c("o_orderkey") % 5 == 0, "<broken").otherwise(""), "</a:Order>")
    return o.withColumn("content", doc)


@query("SELECT o_orderkey, o_orderkey % 5 <> 0 AND o_orderstatus = 'F' AS is_final, o_orderkey % 5 <> 0 AS is_order FROM orders")
def rule_xpath_match(spark, sf):
    """XPath rules on well-formed and broken XML with a DOCTYPE."""
    o = _order_xml(spark, sf).withColumn("xml", X.parseable(c("content"))).withColumn("root", R.root_name(c("content")))
    cols = {"xml": "xml", "root": "root"}
    return o.select("o_orderkey", R.compile_predicate(R.XPath('/*/*[local-name()="Status"][text()="F"]'), cols).alias("is_final"), R.compile_predicate(R.XPath('/*[local-name()="Order"]'), cols).alias("is_order"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN ['9'] WHEN o_orderkey % 3 = 0 THEN ['9'] ELSE ['9', o_orderstatus] END AS version FROM orders")
def version_default_vs_check(spark, sf):
    """Default versions before those found in the document."""
    o = _order_xml(spark, sf).withColumn("xml", X.parseable(c("content")))
    return o.select("o_orderkey", R.compile_values(((R.content("urn:o"), "9"), "@version"), {"xml": "xml", "content": "content"}).alias("version"))


@query("SELECT o_orderkey, 'urn:OGC:' || o_orderstatus || ':' || CASE WHEN o_orderkey % 2 = 0 THEN '1.3.0' ELSE 'UNK' END AS urn FROM orders")
def identity_urn(spark, sf):
    o = table(spark, sf, "orders", ["o_orderkey", "o_orderstatus"])
    return o.select("o_orderkey", R.urn(F.struct(lit("OGC").alias("protocol"), c("o_orderstatus").alias("name"), F.when(c("o_orderkey") % 2 == 0, F.array(lit("1.3.0"))).alias("version"))).alias("urn"))


# --- XML -------------------------------------------------------------------------------------------


def _lines_xml(spark, sf):
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"])
    item = _xml('<x:Item no="', c("l_linenumber").cast("string"), '"><x:Part>', c("l_partkey").cast("string"), "</x:Part><Flag>", c("l_returnflag"), "</Flag></x:Item>")
    g = li.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", item.alias("x")))), lambda s: s["x"]), "").alias("x"))
    return g.withColumn("content", _xml('<Order xmlns:x="urn:x">', c("x"), "</Order>"))


_LINES = "SELECT l_orderkey, list({0} ORDER BY l_linenumber, l_partkey, l_returnflag) AS {1} FROM lineitem GROUP BY l_orderkey"


@query(_LINES.format("CAST(l_partkey AS VARCHAR)", "parts"))
def xml_items(spark, sf):
    p = "/Order/" + X.local_path(["Item", "Part"])
    return _lines_xml(spark, sf).select("l_orderkey", X.items(c("content"), p).alias("parts"))


@query("SELECT l_orderkey, CAST(arg_min(l_partkey, (l_linenumber, l_partkey)) AS VARCHAR) AS part FROM lineitem GROUP BY l_orderkey")
def xml_item_first(spark, sf):
    return _lines_xml(spark, sf).select("l_orderkey", X.item(c("content"), "/Order/" + X.local_path(["Item", "Part"])).alias("part"))


@query(_LINES.format("CAST(l_linenumber AS VARCHAR)", "numbers"))
def xml_attribs(spark, sf):
    return _lines_xml(spark, sf).select("l_orderkey", X.attribs(c("content"), "/Order/" + X.local_path(["Item", "@no"])).alias("numbers"))


@query(_LINES.format("CAST(l_partkey AS VARCHAR)", "parts"))
def shred_texts(spark, sf):
    """The same by the tolerant parser's nodes."""
    s = shred(_lines_xml(spark, sf), "content", ["l_orderkey"])
    return s.select("l_orderkey", Nodes(c("nodes")).texts("Order", "Item", "Part").alias("parts"))


@query("""SELECT n_nationkey, tag, text FROM (SELECT n_nationkey, 'Nation/@key' tag, CAST(n_nationkey AS VARCHAR) AS text FROM nation UNION ALL SELECT n_nationkey, 'Nation/Name', n_name FROM nation UNION ALL SELECT n_nationkey, 'Nation/Region/Key', CAST(n_regionkey AS VARCHAR) FROM nation)""")
def xml_shred_paths(spark, sf):
    """Texts and attributes with their paths; an excluded subtree stays out."""
    n = table(spark, sf, "nation")
    doc = _xml('<Nation key="', c("n_nationkey").cast("string"), '"><!-- no --><Name>', c("n_name"), "</Name><Skip><A>x</A></Skip><Region><Key>", c("n_regionkey").cast("string"), "</Key></Nation>")
    return _written(n, "n_nationkey", doc).select(c("doc_id").alias("n_nationkey"), F.inline(tagged_texts(c("nodes"), ("Skip",))))


@query("SELECT r_regionkey, '{urn:r}Region/{urn:r}Name' AS xpath, r_name AS value FROM region")
def xml_qualified_values(spark, sf):
    doc = _xml('<Region xmlns="urn:r"><Name>', c("r_name"), "</Name></Region>")
    return _written(table(spark, sf, "region"), "r_regionkey", doc).select(c("doc_id").alias("r_regionkey"), F.inline(xml_values(c("nodes"))))


@query("SELECT r_regionkey, 'default' AS prefix, 'urn:r' || r_regionkey AS uri FROM region UNION ALL SELECT r_regionkey, 'a', 'urn:a' FROM region")
def xml_namespaces(spark, sf):
    doc = _xml('<Region xmlns="urn:r', c("r_regionkey").cast("string"), '" xmlns:a="urn:a"><a:Name xmlns:b="urn:a">x</a:Name></Region>')
    return table(spark, sf, "region").select("r_regionkey", F.explode(X.namespaces(doc)).alias("prefix", "uri"))


@query("SELECT p_partkey, p_name || ' & ' || p_type AS plain, ['http://h.test/' || p_partkey] AS links FROM part")
def html_to_text(spark, sf):
    p = table(spark, sf, "part", ["p_partkey", "p_name", "p_type"])
    doc = _xml("<div><script>x=1</script><p>", c("p_name"), "</p> &amp; <a class=q href='http://h.test/", c("p_partkey").cast("string"), "'>", c("p_type"), "</a></div>")
    return html_text(p.withColumn("html", doc), "html", ["p_partkey"])


@query("SELECT o_orderkey, 'HTTP ' || CASE WHEN o_orderkey % 2 = 0 THEN 'GET' ELSE 'POST' END AS method, 'v' || o_orderkey AS host FROM orders")
def headers_and_methods(spark, sf):
    k = c("o_orderkey")
    h = X.header_map(F.array(F.concat(lit("Host: v"), k.cast("string")), lit("X-A: 1"), lit("junk")))
    return table(spark, sf, "orders", ["o_orderkey"]).select("o_orderkey", X.http_method(F.when(k % 2 == 0, "get").otherwise("Post")).alias("method"), h["host"].alias("host"))


# --- identifiers ---------------------------------------------------------------------------------------


def _id_docs(spark, sf):
    """A document for each customer that holds one identifier of each kind."""
    cu = table(spark, sf, "customer", ["c_custkey", "c_name"])
    h = F.md5(c("c_custkey").cast("string"))
    uid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    key = c("c_custkey").cast("string")
    doc = _xml("<r><t>see (doi:10.5072/abc", key, ") or ", uid, ", scale 1:100,000 on 2014-01-02</t><m>", h, "</m><Entry_ID>set ", key, "</Entry_ID><u>urn:x-set:a", key, "</u><w>http://h.test/q?id=10.5072/zz", key, "&amp;n=EPSG:4326</w></r>")
    return _written(cu.withColumn("h", h).withColumn("uid", uid), "c_custkey", doc, F.concat(lit("http://h.test/d/"), key))


def _ids(kind: str):
    def q(spark, sf):
        return extract_identifiers(_id_docs(spark, sf), "doc_id").where(c("match_type") == kind).select(c("doc_id").alias("c_custkey"), "tag", "potential_identifier")

    q.__name__ = f"ids_{kind}"
    q.__doc__ = f"Identifiers of kind {kind} found in written documents."
    return q


_CU = "FROM (SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR)) h FROM customer)"
_UID = "h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32]"
ids_uuid = query(f"SELECT c_custkey, 'r/t' AS tag, {_UID} AS potential_identifier {_CU}")(_ids("uuid"))
ids_md5 = query(f"SELECT c_custkey, 'r/m' AS tag, h AS potential_identifier {_CU}")(_ids("md5"))
ids_urn = query("SELECT c_custkey, 'r/u' AS tag, 'urn:x-set:a' || c_custkey AS potential_identifier FROM customer")(_ids("urn"))
ids_doi = query("SELECT c_custkey, 'r/t' AS tag, 'doi:10.5072/abc' || c_custkey AS potential_identifier FROM customer UNION ALL SELECT c_custkey, 'r/w', '10.5072/zz' || c_custkey FROM customer")(_ids("doi"))
ids_rule_tag = _ids("text")
ids_rule_tag.__name__ = "ids_rule_tag"
ids_rule_tag = query("SELECT c_custkey, 'r/Entry_ID' AS tag, 'set ' || c_custkey AS potential_identifier FROM customer")(ids_rule_tag)
ids_url = query("SELECT c_custkey, '' AS tag, 'http://h.test/d/' || c_custkey AS potential_identifier FROM customer UNION ALL SELECT c_custkey, 'r/w', 'http://h.test/q?id=10.5072/zz' || c_custkey || '&n=EPSG:4326' FROM customer UNION ALL SELECT c_custkey, 'r/w', 'http://h.test/q' FROM customer")(_ids("url"))


@query("SELECT c_custkey, 'md5' AS match_type, md5(CAST(c_custkey AS VARCHAR)) AS value FROM customer")
def ids_first_pattern(spark, sf):
    """The first identifier in a URL's path or query."""
    cu = table(spark, sf, "customer", ["c_custkey"])
    return cu.select("c_custkey", I.first_pattern(F.concat(lit("http://h.test/a/"), F.md5(c("c_custkey").cast("string")), lit("?x=10.5072/abc"))).alias("f")).select("c_custkey", "f.*")


@query("SELECT c_custkey, 'urn' AS match_type, 'urn:x-set:a' || c_custkey AS value FROM customer")
def ids_at_paths(spark, sf):
    """Identifiers only in elements of given paths."""
    return _id_docs(spark, sf).select(c("doc_id").alias("c_custkey"), F.inline(I.at_paths(c("nodes"), ("r/u",))))


@query()
def ids_harvested(spark, sf):
    """Identifiers of all harvested responses, by kind and tag."""
    return extract_identifiers(_docs(spark, sf), "doc_id").groupBy("match_type", "extraction_type", "tag").agg(F.count(lit(1)).alias("n"))


@query("SELECT url_id, NOT (contains(lower(dc_identifier), 'ns:') OR contains(lower(dc_identifier), 'epsg:')) AS kept FROM url_entities WHERE dc_identifier IS NOT NULL")
def ids_excludes(spark, sf):
    u = table(spark, sf, "url_entities", ["url_id", "dc_identifier"]).where("dc_identifier IS NOT NULL")
    return u.select("url_id", (~I.excluded(lit("urn"), c("dc_identifier"), parts=("ns:", "EPSG:"))).alias("kept"))


@query(r"SELECT url_id, CASE WHEN p IS NULL THEN NULL ELSE contains(p, '/') AND starts_with(p, '/') AND (ends_with(p, '/') OR contains(regexp_extract(p, '([^/]*)$', 1), '.')) END AS is_path FROM (SELECT url_id, regexp_extract(vcard_hasurl, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1) p FROM url_entities)")
def cool_uri(spark, sf):
    return _urls(spark, sf).select("url_id", I.is_cool_uri(U.path_of(c("u"))).alias("is_path"))


@query("SELECT l_orderkey, md5(CAST(l_partkey % 50 AS VARCHAR)) AS value, 'Order/l' || min(l_linenumber) AS tag FROM lineitem GROUP BY l_orderkey, l_partkey % 50")
def ids_dedup_first(spark, sf):
    """Of equal values in a document the first counts."""
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber"])
    tag = F.concat(lit("l"), c("l_linenumber").cast("string"))
    item = F.concat(lit("<"), tag, lit(">"), F.md5((c("l_partkey") % 50).cast("string")), lit("</"), tag, lit(">"))
    g = li.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", item.alias("x")))), lambda s: s["x"]), "").alias("x"))
    docs = _written(g, "l_orderkey", _xml("<Order>", c("x"), "</Order>"), lit(None).cast("string"))
    return extract_identifiers(docs, "doc_id").select(c("doc_id").alias("l_orderkey"), c("potential_identifier").alias("value"), "tag")


# --- readers ---------------------------------------------------------------------------------------------

_TAG = "trim(regexp_extract(content, '<{0}>([^<]*)', 1))"


def _cut(tag: str) -> str:
    return f"nullif({_TAG.format(tag)}, '')"


@query(f"SELECT record_id AS doc_id, {_cut('title')} AS title, {_cut('abstract')} AS description FROM {_H} WHERE regexp_matches(content, '^<metadata>')")
def reader_fgdc(spark, sf):
    docs = _docs(spark, sf).where(c("content").startswith("<metadata>"))
    # the harvest writes the citation below idinfo or, in cut records, not at all
    return readers.read_fgdc(docs)["datasets"].select("doc_id", "title", "description")


@query(f"SELECT record_id AS doc_id, {_cut('repositoryName')} AS title, {_cut('protocolVersion')} AS version FROM {_H} WHERE contains(content, '<Identify>')")
def reader_oai(spark, sf):
    return readers.read_oaipmh(_docs(spark, sf))["services"].select("doc_id", "title", "version")


@query(f"SELECT record_id AS doc_id, {_cut('ShortName')} AS title, {_cut('Description')} AS description FROM {_H} WHERE regexp_matches(content, '^<OpenSearchDescription[^<>]*>')")
def reader_osdd(spark, sf):
    return readers.read_opensearch(_docs(spark, sf))["services"].select("doc_id", "title", "description")


@query(f"SELECT record_id AS doc_id, regexp_extract(content, '<WMS_Capabilities[^>]*version=\"([^\"]*)\"', 1) AS version, {_cut('Title')} AS title, {_cut('Abstract')} AS description FROM {_H} WHERE regexp_matches(content, '^<WMS_Capabilities[^<>]*>')")
def reader_ogc_service(spark, sf):
    s = readers.read_ogc(_docs(spark, sf))["services"].where("service = 'WMS'")
    return s.select("doc_id", "version", "title", "description")


@query(f"SELECT record_id AS doc_id, nullif(trim(regexp_extract(content, '<entry><title>([^<]*)', 1)), '') AS title FROM (SELECT record_id, replace(content, '> <', '><') content FROM {_H}) WHERE contains(content, '<entry>')")
def reader_atom(spark, sf):
    return readers.read_feed(_docs(spark, sf))["items"].select("doc_id", "title")


@query(f"""SELECT record_id AS doc_id, regexp_extract(content, '<dataset[^<>]*name="([^"]*)"', 1) AS name, regexp_extract(content, '<dataset[^<>]*ID="([^"]*)"', 1) AS id FROM {_H} WHERE regexp_matches(content, '<dataset [^<>]*>')""")
def reader_thredds(spark, sf):
    e = readers.read_thredds(_docs(spark, sf))["endpoints"]
    return e.where("tag = 'dataset'").select("doc_id", "name", "id")


@query("SELECT p_partkey AS doc_id, p_name AS title, p_brand AS creator, [p_type, 'x'] AS subjects FROM part")
def reader_dc(spark, sf):
    p = table(spark, sf, "part")
    doc = _xml("<oai_dc:dc xmlns:oai_dc='o' xmlns:dc='d'><dc:title>", c("p_name"), "</dc:title><dc:creator>", c("p_brand"), "</dc:creator><dc:subject>", c("p_type"), "</dc:subject><dc:subject>x</dc:subject></oai_dc:dc>")
    return readers.read_dc(_written(p, "p_partkey", doc))["items"].select("doc_id", "title", "creator", "subjects")


@query("SELECT p_partkey AS doc_id, 'id' || p_partkey AS id, p_name AS title, printf('POLYGON ((%d %d,%d %d,%d %d,%d %d,%d %d))', -p_size, 0, -p_size, 9, p_size, 9, p_size, 0, -p_size, 0) AS bbox, ['2001', '2002'] AS temporal FROM part")
def reader_dif(spark, sf):
    p, s = table(spark, sf, "part"), c("p_size").cast("string")
    doc = _xml("<DIF><Entry_ID>id", c("p_partkey").cast("string"), "</Entry_ID><Entry_Title>", c("p_name"), "</Entry_Title><Temporal_Coverage><Start_Date>2001</Start_Date><End_Date>2002</End_Date></Temporal_Coverage><Spatial_Coverage><Southernmost_Latitude>0</Southernmost_Latitude><Northernmost_Latitude>9</Northernmost_Latitude><Westernmost_Longitude>-", s, "</Westernmost_Longitude><Easternmost_Longitude>", s, "</Easternmost_Longitude></Spatial_Coverage></DIF>")
    return readers.read_dif(_written(p, "p_partkey", doc))["items"].select("doc_id", "id", "title", "bbox", "temporal")


@query("SELECT c_custkey AS doc_id, c_name AS title, 'id' || c_custkey AS identifier, CAST(-c_nationkey AS DOUBLE) AS west, CAST(c_nationkey AS DOUBLE) AS east, '2010-01-02T00:00:00' AS \"startDate\" FROM customer")
def reader_iso(spark, sf):
    cu, k = table(spark, sf, "customer"), c("c_nationkey").cast("string")
    cs = lambda v: _el("gco:CharacterString", v)
    doc = _xml(
        "<gmd:MD_Metadata xmlns:gmd='g' xmlns:gco='c'><gmd:fileIdentifier>", cs("f"), "</gmd:fileIdentifier><gmd:identificationInfo><gmd:MD_DataIdentification><gmd:citation><gmd:CI_Citation><gmd:title>", cs(c("c_name")), "</gmd:title><gmd:identifier><gmd:MD_Identifier><gmd:code>", cs(F.concat(lit("id"), c("c_custkey").cast("string"))), "</gmd:code></gmd:MD_Identifier></gmd:identifier></gmd:CI_Citation></gmd:citation><gmd:extent><gmd:EX_Extent><gmd:geographicElement><gmd:EX_GeographicBoundingBox><gmd:westBoundLongitude><gco:Decimal>-", k,
        "</gco:Decimal></gmd:westBoundLongitude><gmd:eastBoundLongitude><gco:Decimal>", k, "</gco:Decimal></gmd:eastBoundLongitude></gmd:EX_GeographicBoundingBox></gmd:geographicElement><gmd:temporalElement><gmd:EX_TemporalExtent><gmd:extent><TimePeriod><beginPosition>2010-01-02</beginPosition></TimePeriod></gmd:extent></gmd:EX_TemporalExtent></gmd:temporalElement></gmd:EX_Extent></gmd:extent></gmd:MD_DataIdentification></gmd:identificationInfo></gmd:MD_Metadata>",
    )
    return readers.read_iso(_written(cu, "c_custkey", doc))["datasets"].select("doc_id", "title", "identifier", "west", "east", "startDate")


@query("SELECT s_suppkey AS doc_id, 'L' || k AS name, s_name || k AS title, CAST(-k AS DOUBLE) AS west, CAST(k AS DOUBLE) AS north FROM supplier, (VALUES (1), (2)) v(k)")
def reader_ogc_layers(spark, sf):
    s = table(spark, sf, "supplier")
    layer = lambda k: _xml("<Layer><Name>L", str(k), "</Name><Title>", c("s_name"), str(k), f"</Title><EX_GeographicBoundingBox><westBoundLongitude>-{k}</westBoundLongitude><eastBoundLongitude>{k}</eastBoundLongitude><southBoundLatitude>-{k}</southBoundLatitude><northBoundLatitude>{k}</northBoundLatitude></EX_GeographicBoundingBox></Layer>")
    doc = _xml('<WMS_Capabilities version="1.3.0"><Service><Title>t</Title></Service><Capability><Layer><Title>group</Title>', layer(1), layer(2), "</Layer></Capability></WMS_Capabilities>")
    return readers.read_ogc(_written(s, "s_suppkey", doc))["layers"].select("doc_id", "name", "title", "west", "north")


@query("SELECT o_orderkey AS doc_id, o_orderstatus AS location, ['v', 'w'] AS variables FROM orders")
def reader_ncml(spark, sf):
    doc = _xml('<netcdf location="', c("o_orderstatus"), '"><variable name="v" type="float"><attribute name="units" value="m"/><values>1 2</values></variable><variable name="w"/></netcdf>')
    return readers.read_ncml(_written(table(spark, sf, "orders", ["o_orderkey", "o_orderstatus"]), "o_orderkey", doc))["datasets"].select("doc_id", "location", F.transform("variables", lambda v: v["name"]).alias("variables"))


@query("SELECT c_custkey AS doc_id, c_name AS title, 'd' || c_custkey AS link FROM customer")
def reader_rss(spark, sf):
    doc = _xml("<rss><channel><title>f</title><item><title>", c("c_name"), "</title><link>d", c("c_custkey").cast("string"), "</link></item></channel></rss>")
    return readers.read_feed(_written(table(spark, sf, "customer"), "c_custkey", doc))["rss_items"].select("doc_id", "title", F.get("links", lit(0)).alias("link"))


@query("SELECT o_orderkey AS doc_id, count(*)::INT AS total, list('k' || l_linenumber ORDER BY l_linenumber) AS kids FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def parent_child_ids(spark, sf):
    """Children of nested catalog elements, by their ids."""
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"]).groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("n"))
    o = table(spark, sf, "orders", ["o_orderkey"]).join(li, c("o_orderkey") == c("l_orderkey"))
    doc = _xml('<catalog><dataset ID="top">', F.array_join(F.transform("n", lambda i: F.concat(lit('<dataset ID="k'), i.cast("string"), lit('" urlPath="p"/>'))), ""), "</dataset></catalog>")
    e = readers.read_thredds(_written(o, "o_orderkey", doc))["endpoints"].where("id = 'top'")
    return e.select("doc_id", F.size("parentOf").alias("total"), c("parentOf").alias("kids"))


@query("SELECT s_suppkey AS doc_id, CASE WHEN s_nationkey % 2 = 0 THEN ['http://h.test/a/' || s_suppkey || '.nc'] ELSE ['http://h.test/a/' || s_suppkey || '.nc', 'http://h.test/b/' || s_suppkey || '.nc'] END AS urls FROM supplier")
def service_base_lookup(spark, sf):
    """A dataset's own service base, or all of them if it names none."""
    s = table(spark, sf, "supplier")
    doc = _xml('<catalog><service name="A" base="/a/"/><service name="B" base="/b/"/><dataset name="d" urlPath="', c("s_suppkey").cast("string"), '.nc">', F.when(c("s_nationkey") % 2 == 0, "<serviceName>A</serviceName>").otherwise(""), "</dataset></catalog>")
    e = readers.read_thredds(_written(s, "s_suppkey", doc, lit("http://h.test/catalog.xml")))["endpoints"]
    return e.select("doc_id", "urls")


def _fgdc_docs(spark, sf):
    """A record for each part, with a publisher, links and keywords."""
    k = c("p_partkey").cast("string")
    doc = _xml(
        "<metadata><idinfo><citation><citeinfo><title>", c("p_name"), "</title><onlink>http://p.test/", k, "</onlink><pubinfo><publish>", c("p_brand"), "</publish><pubplace>", c("p_name"), "</pubplace></pubinfo></citeinfo></citation><keywords><theme><themekt>", c("p_brand"), "</themekt><themekey>", c("p_type"),
        "</themekey><themekey>x</themekey></theme><place><placekt>none</placekt></place></keywords></idinfo><distinfo><stdorder><digform><digtopt><onlinopt><computer><networka><networkr>http://d.test/", k, "</networkr></networka></computer></onlinopt></digtopt></digform></stdorder></distinfo></metadata>",
    )
    return _written(table(spark, sf, "part"), "p_partkey", doc)


@query("SELECT p_partkey AS doc_id, p_brand AS set_of, 'theme' AS kind, [p_type, 'x'] AS words FROM part")
def reader_fgdc_keywords(spark, sf):
    return readers.read_fgdc(_fgdc_docs(spark, sf))["keywords"].select("doc_id", c("partOf").alias("set_of"), c("hasType").alias("kind"), c("hasValue").alias("words"))


@query("SELECT p_partkey AS doc_id, p_brand AS name, p_name AS location FROM part")
def reader_fgdc_publishers(spark, sf):
    return readers.read_fgdc(_fgdc_docs(spark, sf))["publishers"].select("doc_id", "name", "location")


@query("SELECT p_partkey AS doc_id, unnest(['bcube:originatedFrom', 'bcube:hasMetadataRecord', 'dcterms:publisher', 'dcterms:references', 'dcterms:references', 'dc:conformsTo', 'foaf:primaryTopic']) AS relate, unnest(['urls', 'catalog_records', 'publishers', 'urls', 'webpages', 'keywords', 'datasets']) AS target FROM part")
def reader_fgdc_edges(spark, sf):
    """The edges of each record with the table in which their target is found.

    Seven tables are read from each document, so it is parsed once and written. Catalyst
    judges rows made of a document's nodes by the size of the document, and would
    broadcast the edges of millions.
    """
    found = readers.read_fgdc(Stages(spark, "fgdc").put(_fgdc_docs(spark, sf)))
    targets = None
    for k in ("datasets", "catalog_records", "publishers", "urls", "webpages", "keywords"):
        t = found[k].select(c("object_id").alias("dst_id"), lit(k).alias("target"))
        targets = t if targets is None else targets.unionAll(t)
    return found["edges"].hint("merge").join(targets, "dst_id").select("doc_id", "relate", "target")


@query("SELECT c_custkey AS doc_id, 'T' || k AS title FROM customer, (VALUES (1), (2)) v(k)")
def reader_csw_records(spark, sf):
    """Search results that hold records of another standard."""
    doc = _xml('<GetRecordsResponse><SearchResults numberOfRecordsMatched="2">', *[_xml(f"<metadata><idinfo><citation><citeinfo><title>T{k}</title></citeinfo></citation></idinfo></metadata>") for k in (1, 2)], "</SearchResults></GetRecordsResponse>")
    return readers.read_csw(_written(table(spark, sf, "customer", ["c_custkey"]), "c_custkey", doc))["datasets"].select("doc_id", "title")


@query("SELECT o_orderkey AS doc_id, 'oai:' || o_orderkey AS identifier, o_orderpriority AS title FROM orders")
def reader_oai_records(spark, sf):
    doc = _xml("<OAI-PMH><ListRecords><record><header><identifier>oai:", c("o_orderkey").cast("string"), "</identifier></header><metadata><dc><title>", c("o_orderpriority"), "</title></dc></metadata></record></ListRecords></OAI-PMH>")
    return readers.read_oaipmh(_written(table(spark, sf, "orders", ["o_orderkey", "o_orderpriority"]), "o_orderkey", doc))["items"].select("doc_id", "identifier", "title")


@query("SELECT s_suppkey AS doc_id, 'GetMap' AS name, 'HTTP GET' AS protocol, 'http://h.test/' || s_suppkey AS url, ['text/xml', 'image/png'] AS formats, ['service', 'request', 'version', 'format', 'layers', 'bbox', 'height', 'width', 'styles', 'srs', 'transparent', 'bgcolor', 'elevation', 'time'] AS parameters FROM supplier")
def reader_ogc_operations(spark, sf):
    doc = _xml('<WMT_MS_Capabilities version="1.1.1"><Service><Title>t</Title></Service><Capability><Request><GetMap><Format>XMLSCHEMA</Format><Format>image/png</Format><DCPType><HTTP><Get><OnlineResource href="http://h.test/', c("s_suppkey").cast("string"), '"/></Get></HTTP></DCPType></GetMap></Request></Capability></WMT_MS_Capabilities>')
    ops = readers.read_ogc(_written(table(spark, sf, "supplier", ["s_suppkey"]), "s_suppkey", doc))["operations"]
    return ops.select("doc_id", "name", "protocol", "url", c("mimeType").alias("formats"), F.transform("parameters", lambda p: p["name"]).alias("parameters"))


@query("SELECT s_suppkey AS doc_id, 'http://x.test/' || s_suppkey AS url, 'Harvested' AS source FROM supplier UNION ALL SELECT s_suppkey, 'http://x.test/' || s_suppkey || '?service=WFS&version=1.1.0&request=GetFeature&featureid=f' || s_nationkey || '&typenames=namespace%3Afeaturetype', 'Generated' FROM supplier")
def reader_ogc_urls(spark, sf):
    """The harvested URL and the request that is made for a feature type."""
    doc = _xml('<WFS_Capabilities version="1.1.0"><FeatureTypeList><FeatureType><Name>f', c("s_nationkey").cast("string"), "</Name></FeatureType></FeatureTypeList></WFS_Capabilities>")
    urls = readers.read_ogc(_written(table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"]), "s_suppkey", doc))["urls"]
    return urls.select("doc_id", c("vcard_hasURL").alias("url"), c("hasUrlSource").alias("source"))


@query("SELECT n_nationkey, 'FORMAT' AS name, CASE WHEN n_regionkey % 2 = 0 THEN n_name ELSE 'text/xml' END AS format FROM nation UNION ALL SELECT n_nationkey, 'VERSION', '1.0' FROM nation")
def param_merge_left(spark, sf):
    """Default parameters overridden by those found, whatever their case."""
    p = lambda n, f: F.struct(n.alias("name"), f.alias("format"), F.array().cast("array<string>").alias("values"))
    found = F.when(c("n_regionkey") % 2 == 0, F.array(p(lit("format"), c("n_name")))).otherwise(F.array().cast("array<struct<name:string,format:string,values:array<string>>>"))
    merged = readers.merge_params(F.array(p(lit("FORMAT"), lit("text/xml")), p(lit("VERSION"), lit("1.0"))), found)
    return table(spark, sf, "nation").select("n_nationkey", F.inline(merged)).select("n_nationkey", "name", "format")


@query("""SELECT n_nationkey, unnest(p[1]) AS name, unnest(p[2]) AS type FROM (SELECT n_nationkey, CASE n_nationkey % 4
 WHEN 0 THEN [['service', 'request', 'version', 'info_format', 'feature_count'], ['string', 'string', 'string', 'string', 'int']] WHEN 1 THEN [['service', 'request', 'version', 'typename', 'format'], ['string', 'string', 'string', 'string', 'string']]
 WHEN 2 THEN [['service', 'request', 'version'], ['string', 'string', 'string']] END p FROM nation) WHERE p IS NOT NULL""")
def param_defaults(spark, sf):
    """The parameters that a service's request takes by default; none for unknown services."""
    asked = F.array(*[F.struct(*map(lit, x)) for x in (("wms", "1.1.1", "GetFeatureInfo"), ("WFS", "1.0.0", "DescribeFeatureType"), ("wcs", "1.0.0", "GetCoverage"), ("wps", "1.0.0", "Execute"))])
    n = table(spark, sf, "nation", ["n_nationkey"]).withColumn("a", F.get(asked, (c("n_nationkey") % 4).cast("int")))
    return n.select("n_nationkey", F.inline(O.default_params(c("a.col1"), c("a.col2"), c("a.col3")))).select("n_nationkey", "name", "type")


# --- graph -----------------------------------------------------------------------------------------------


@query("""SELECT s, p, o, o_datatype FROM (SELECT 'urn:c:' || c_custkey s, unnest([('http://www.w3.org/2002/07/owl#a', 'http://www.w3.org/TR/vocab-dcat/#Dataset', NULL), ('http://purl.org/dc/terms/title', c_name, NULL), ('http://purl.org/esip/#westBound', CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR), 'http://www.w3.org/2001/XMLSchema#float')]) r, r[1] p, r[2] o, r[3] o_datatype FROM customer)""")
def triples_unpivot(spark, sf):
    """Entities as triples: type, attributes, typed bounds."""
    cu = table(spark, sf, "customer").select(F.concat(lit("urn:c:"), c("c_custkey").cast("string")).alias("object_id"), c("c_name").alias("title"), c("c_nationkey").cast("double").alias("west"), lit(None).cast("string").alias("description"))
    return graph.entity_triples(cu, "datasets").select("s", "p", "o", "o_datatype")


@query("SELECT 'urn:o:' || o_orderkey AS s, 'http://purl.org/dc/terms/references' AS p, 'urn:c:' || o_custkey AS o FROM orders")
def entities_edges(spark, sf):
    e = table(spark, sf, "orders", ["o_orderkey", "o_custkey"]).select(F.concat(lit("urn:o:"), c("o_orderkey").cast("string")).alias("src_id"), lit("dcterms:references").alias("relate"), F.concat(lit("urn:c:"), c("o_custkey").cast("string")).alias("dst_id"))
    return graph.edge_triples(e).select("s", "p", "o")


@query("SELECT '<urn:n:' || n_nationkey || '> <http://purl.org/dc/terms/title> \"' || n_name || '\" .' AS value FROM nation UNION ALL SELECT '<urn:n:' || n_nationkey || '> <http://www.w3.org/2002/07/owl#a> <http://purl.org/BCube/#service> .' FROM nation")
def n_triples(spark, sf):
    n = table(spark, sf, "nation").select(F.concat(lit("urn:n:"), c("n_nationkey").cast("string")).alias("object_id"), c("n_name").alias("title"))
    return graph.n_triples(graph.entity_triples(n, "services"))


def harvest_triples(spark, sf) -> dict[str, DataFrame]:
    """The triples of all responses, by the reader that described them."""
    docs = _identified(spark, sf).select(c("record_id").alias("doc_id"), "url", F.lit(None).cast("string").alias("harvest_date"), "content", route(first_identity(c("identities"))).alias("reader"))
    shredded = shred(docs.where("reader IS NOT NULL"), "content", ["doc_id", "url", "harvest_date", "reader"])
    return {r: graph.to_triples(found) for r, found in readers.describe(shredded, routed(HARVEST_RULES)).items()}


@query()
def harvest_graph(spark, sf):
    """The whole way: clean, identify, route, describe, triples; counts by predicate."""
    parts = list(harvest_triples(spark, sf).values())
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("p", "o_kind").agg(F.count(lit(1)).alias("n"))


@query("SELECT DISTINCT url_id, vcard_hasurl AS url, 'Harvested' AS source, 'Good' AS confidence, 200 AS status, 'OK' AS reason FROM url_entities WHERE vcard_hasurl <> ''")
def url_entities_projection(spark, sf):
    """The harvest manifest of every URL."""
    u = table(spark, sf, "url_entities", ["url_id", "vcard_hasurl"]).where("vcard_hasurl <> ''").distinct()
    made = u.select(c("url_id").alias("doc_id"), c("vcard_hasurl").alias("url"), lit("2015-01-01").alias("harvest_date"))
    return made.select("doc_id", readers.url_entity(c("url")).alias("e")).select(c("doc_id").alias("url_id"), c("e.vcard_hasURL").alias("url"), c("e.hasUrlSource").alias("source"), c("e.hasConfidence").alias("confidence"), c("e.httpStatusCode").alias("status"), c("e.reasonPhrase").alias("reason"))


# --- similarity ---------------------------------------------------------------------------------------------


@query("SELECT min(doc_id) AS keep_id, md5(text) AS digest, CAST(count(*) AS BIGINT) AS n FROM documents WHERE text IS NOT NULL GROUP BY md5(text) HAVING count(*) > 1")
def exact_dups(spark, sf):
    d = table(spark, sf, "documents", ["doc_id", "text"]).where("text IS NOT NULL")
    return d.groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("keep_id"), F.count(lit(1)).alias("n")).where("n > 1").select("keep_id", "digest", "n")


_BITS = ", ".join(f"sum(n * (2 * ((h{i // 32} >> {i % 32}) & 1) - 1)) b{i}" for i in range(64))
_HALF = [" + ".join(f"CASE WHEN b{i} > 0 THEN {1 << (i % 32)}::BIGINT ELSE 0 END" for i in range(32 * k, 32 * k + 32)) for k in (0, 1)]
_PRINTS = rf"""w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(trim(lower(text), ' '), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) w FROM documents WHERE text IS NOT NULL),
counted AS (SELECT doc_id, w, count(*) n FROM w GROUP BY ALL),
half AS (SELECT doc_id, n, ('0x' || md5(w)[1:8])::BIGINT h0, ('0x' || md5(w)[9:16])::BIGINT h1 FROM counted),
bits AS (SELECT doc_id, {_BITS} FROM half GROUP BY doc_id),
prints AS (SELECT d.doc_id, coalesce({_HALF[0]}, 0) hi, coalesce({_HALF[1]}, 0) lo FROM (SELECT doc_id FROM documents WHERE text IS NOT NULL) d LEFT JOIN bits USING (doc_id))"""


@query(f"WITH {_PRINTS} SELECT doc_id, hi, lo FROM prints")
def simhash_fingerprint(spark, sf):
    return similarity.simhash_rows(table(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text")


@query(f"WITH {_PRINTS}, reps AS (SELECT hi, lo, min(doc_id) id FROM prints GROUP BY hi, lo) SELECT x.id AS a, y.id AS b, CAST(bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) AS INT) AS distance FROM reps x JOIN reps y ON x.id < y.id AND bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) <= 3")
def simhash_near_dups(spark, sf):
    """Pairs of representatives within three bits."""
    prints = similarity.simhash_rows(table(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text")
    return similarity.near_duplicates(prints, "doc_id", 3)


@query(f"WITH {_PRINTS}, reps AS (SELECT hi, lo, min(doc_id) id FROM prints GROUP BY hi, lo) SELECT x.id AS a, y.id AS b, CAST(bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) AS INT) AS distance FROM reps x JOIN reps y ON x.id < y.id AND bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) <= 10")
def simhash_near_dups_10(spark, sf):
    """Pairs of representatives within ten bits."""
    prints = similarity.simhash_rows(table(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text")
    return similarity.near_duplicates(prints, "doc_id", 10)


@query(f"""WITH {_PRINTS}, reps AS (SELECT hi, lo, min(doc_id) id, min(source) s0, max(source) s1 FROM prints JOIN documents USING (doc_id) GROUP BY hi, lo)
SELECT x.id AS a, y.id AS b, CAST(bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) AS INT) AS distance FROM reps x JOIN reps y ON x.id < y.id AND bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) <= 3 WHERE NOT (x.s0 = x.s1 AND y.s0 = y.s1 AND x.s0 = y.s0)""")
def simhash_across_sources(spark, sf):
    """Pairs within three bits, leaving out those of which all documents have the same source."""
    d = table(spark, sf, "documents", ["doc_id", "text", "source"]).where("text IS NOT NULL")
    prints = similarity.simhash_rows(d, "doc_id", "text").join(d.select("doc_id", "source"), "doc_id")
    return similarity.near_duplicates(prints, "doc_id", 3, apart="source")


@query(f"WITH {_PRINTS} SELECT doc_id, min(doc_id) OVER (PARTITION BY hi, lo) AS class_id FROM prints")
def simhash_classes(spark, sf):
    """Every document with the smallest one of the same fingerprint."""
    return similarity.classes(similarity.simhash_rows(table(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text"), "doc_id")


_WEIGHTS = r"""tok AS (SELECT dataset_id, unnest(regexp_extract_all(lower(title), '[\p{L}\p{N}_]{2,}')) term FROM t), n AS (SELECT count(*) n_docs FROM t),
tf AS (SELECT dataset_id, term, count(*) tf FROM tok GROUP BY ALL), df AS (SELECT term, count(*) df FROM tf GROUP BY term),
raw AS (SELECT dataset_id, term, tf * (ln((n_docs + 1.0) / (df + 1.0)) + 1.0) w FROM tf JOIN df USING (term), n),
weights AS (SELECT dataset_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY dataset_id)) weight FROM raw)"""
_TITLES = "t AS (SELECT min(dataset_id) dataset_id, dcterms_title title FROM datasets WHERE dcterms_title IS NOT NULL GROUP BY dcterms_title)"


def _titles(spark, sf):
    """Distinct titles with their smallest id: copies are one representative."""
    return table(spark, sf, "datasets", ["dataset_id", "dcterms_title"]).where("dcterms_title IS NOT NULL").groupBy("dcterms_title").agg(F.min("dataset_id").alias("dataset_id"))


@query(f"WITH {_TITLES}, {_WEIGHTS} SELECT dataset_id, term, round(weight, 6) AS weight FROM weights")
def tfidf_weights(spark, sf):
    return similarity.tfidf(_titles(spark, sf), "dataset_id", "dcterms_title").select("dataset_id", "term", F.round("weight", 6).alias("weight"))


@query(f"WITH {_TITLES}, {_WEIGHTS} SELECT a.dataset_id AS a, b.dataset_id AS b, round(sum(a.weight * b.weight), 5) AS score FROM weights a JOIN weights b ON a.term = b.term AND a.dataset_id < b.dataset_id GROUP BY ALL HAVING sum(a.weight * b.weight) >= 0.95")
def tfidf_pairs(spark, sf):
    """Pairs of titles with a cosine of 0.95 or more."""
    w = similarity.tfidf(_titles(spark, sf), "dataset_id", "dcterms_title")
    return similarity.similar_pairs(w, "dataset_id", 0.95).select("a", "b", F.round("score", 5).alias("score"))


@query(f"""WITH {_TITLES}, {_WEIGHTS}, pairs AS (SELECT a.dataset_id doc, b.dataset_id other, round(sum(a.weight * b.weight), 5) score FROM weights a JOIN weights b ON a.term = b.term AND a.dataset_id <> b.dataset_id GROUP BY ALL HAVING sum(a.weight * b.weight) >= 0.1)
SELECT doc, other, score, CAST(row_number() OVER (PARTITION BY doc ORDER BY score DESC, other) AS INT) AS place FROM pairs""")
def tfidf_ranked(spark, sf):
    """For each title all others with a cosine of 0.1 or more, the most similar first."""
    w = similarity.tfidf(_titles(spark, sf), "dataset_id", "dcterms_title")
    return similarity.ranked_pairs(w, "dataset_id", 0.1, 5)


# --- sources ----------------------------------------------------------------------------------------------------


@query("SELECT event_id, event_type FROM events ORDER BY event_id OFFSET 10 LIMIT 50")
def field_projection_sample(spark, sf):
    """A field list with a slice, as a sampling spec asks for."""
    return io.project_sample(table(spark, sf, "events"), ["event_id", "event_type"], start=10, size=50)


@query("SELECT doc_id, source FROM documents WHERE contains(text, 'WMS') OR contains(text, 'OAI-PMH')")
def term_query(spark, sf):
    return io.project_sample(table(spark, sf, "documents"), ["doc_id", "source"], {"text": ["WMS", "OAI-PMH"]})


@query("SELECT l.doc_id, l.toxic, d.source FROM labels l JOIN documents d ON d.doc_id = l.doc_id")
def digest_join(spark, sf):
    """A list of keys looked up among the documents."""
    return io.lookup_by_digest(table(spark, sf, "labels", ["doc_id", "toxic"]), table(spark, sf, "documents", ["doc_id", "source"]), "doc_id").select("doc_id", "toxic", "source")


@query("SELECT url, max(record_id) AS record_id FROM (SELECT url, arg_max(record_id, (tstamp, record_id)) record_id FROM harvest_records GROUP BY url) GROUP BY url")
def upsert_latest(spark, sf):
    """Of re-harvested URLs the newest record."""
    h = table(spark, sf, "harvest_records", ["url", "record_id", "tstamp"]).withColumn("v", F.struct("tstamp", "record_id"))
    half = c("record_id") % 2 == 0
    return io.upsert(h.where(half), h.where(~half), "url", "v").select("url", "record_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_not_done(spark, sf):
    return io.not_done(table(spark, sf, "documents", ["doc_id"]), table(spark, sf, "labels", ["doc_id"]), "doc_id").select("doc_id")
