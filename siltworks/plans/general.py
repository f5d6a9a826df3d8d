"""Queries of the general record problems p2 to p6 over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hierarchy import descendants, resolve_forest
from ..operators.instants import to_instants
from ..operators.nested import flatten_lists
from ..operators.orphans import Target, orphan_edges
from ..operators.packed import split_packed
from ..runtime import table

_EDGE_SPACE = r"^[\s\p{Z}\x{200B}\x{FEFF}]+|[\s\p{Z}\x{200B}\x{FEFF}]+$"


# --- p2: references to records that do not exist -----------------------------

#: relate -> table that it points into
RELATES = {
    "bcube:originatedFrom": "url_entities",
    "dcterms:references": "url_entities",
    "bcube:hasMetadataRecord": "descriptions",
    "dcterms:publisher": "publishers",
    "dc:conformsTo": "keyword_sets",
    "foaf:primaryTopic": "datasets",
}
#: src_kind -> table whose record holds the reference
SOURCES = {"dataset": "datasets", "description": "descriptions"}


def orphans(spark: SparkSession, sf: str) -> DataFrame:
    edges = table(spark, sf, "relationships", ["edge_id", "src_id", "src_kind", "relate", "object_id", "recorded_at"])
    names = dict.fromkeys(RELATES.values())
    targets = [Target(n, table(spark, sf, n, ["object_id", "loaded_at", "deleted_at"])) for n in names]
    return orphan_edges(edges, targets, RELATES, SOURCES)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Edges whose target was not there when they were recorded."""
    return orphans(spark, sf).where("orphan = 'direct'").select("edge_id")


def p2_report(spark: SparkSession, sf: str) -> DataFrame:
    """Direct and inherited orphans per target table and month."""
    return (
        orphans(spark, sf)
        .groupBy(F.col("target").alias("target_table"), F.date_format("recorded_at", "yyyy-MM").alias("period"))
        .agg(
            F.count(F.when(F.col("orphan") == "direct", 1)).alias("n_direct"),
            F.count(F.when(F.col("orphan") == "inherited", 1)).alias("n_inherited"),
        )
    )


# --- p3: several values in one field -------------------------------------------


def packed_terms(spark: SparkSession, sf: str) -> DataFrame:
    kw = table(spark, sf, "keyword_sets", ["set_id", "bcube_hasvalue"])
    ds = table(spark, sf, "descriptions", ["desc_id", "tags"])
    fields = kw.select(F.lit("bcube_hasvalue").alias("field_name"), F.col("set_id").alias("row_id"), F.col("bcube_hasvalue").alias("packed")).unionAll(
        ds.select(F.lit("tags").alias("field_name"), F.col("desc_id").alias("row_id"), F.col("tags").alias("packed"))
    )
    return split_packed(fields, blanks_in=("tags",))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each value of the fields that hold two or more."""
    return packed_terms(spark, sf).where("n_terms >= 2").select("field_name", "row_id", "pos", "term")


def p3_terms(spark: SparkSession, sf: str) -> DataFrame:
    """How often each term stands, and how often in malformed quotes."""
    return packed_terms(spark, sf).groupBy("field_name", "term").agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("malformed"), 1)).alias("n_malformed"))


# --- p4: hierarchies ------------------------------------------------------------


def hierarchy_links(spark: SparkSession, sf: str) -> DataFrame:
    """(tree, node, parent) of the THREDDS catalogs and of the harvest."""
    raw = table(spark, sf, "thredds_nodes", ["node_id", "catalog_url", "thredds_id", "childof"]).where("node_id IS NOT NULL").distinct()
    ids = raw.where("thredds_id IS NOT NULL AND catalog_url IS NOT NULL").groupBy("catalog_url", F.col("thredds_id").alias("wanted")).agg(F.min("node_id").alias("parent_id")).hint("merge")
    wanted = F.regexp_replace("childof", _EDGE_SPACE, "")
    thredds = (
        raw.select("node_id", "catalog_url", F.when(wanted != "", wanted).alias("wanted"))
        .join(ids, ["catalog_url", "wanted"], "left")
        .select(F.lit("thredds").alias("tree"), F.col("node_id").cast("string").alias("node"), F.col("parent_id").cast("string").alias("parent"))
    )
    up = F.get_json_object("harvest_details", "$.parent_url")
    harvest = table(spark, sf, "harvest_records", ["url", "harvest_details"]).where("url IS NOT NULL").select(
        F.lit("harvest").alias("tree"), F.col("url").alias("node"), F.when(F.trim(up) != "", up).alias("parent")
    )
    return thredds.unionAll(harvest)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Root and depth of every node; nodes on and below loops are marked."""
    return resolve_forest(hierarchy_links(spark, sf))


def p4_paths(spark: SparkSession, sf: str) -> DataFrame:
    """The full path of every node, from its root."""
    return resolve_forest(hierarchy_links(spark, sf), with_path=True).select("tree", "node", "root_node", "node_depth", F.to_json("path").alias("path"))


def p4_descendants(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of a node and one of its descendants, with their distance."""
    return descendants(resolve_forest(hierarchy_links(spark, sf), with_path=True))


# --- p5: nested records ------------------------------------------------------------

LISTS = ("relationships", "urls", "layers", "webpages")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """One row per member of a list, with the key of the object that holds it."""
    rows = flatten_lists(table(spark, sf, "descriptions", ["desc_id", "body"]), "desc_id", "body", LISTS)
    return rows.select("desc_id", "parent_id", "list_name", "pos", "object_id")


def _p5_table(name: str, **fields: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = flatten_lists(table(spark, sf, "descriptions", ["desc_id", "body"]), "desc_id", "body", LISTS)
        return rows.where(F.col("list_name") == name).select("desc_id", "parent_id", "pos", "object_id", *[F.col("attrs")[k].alias(a) for a, k in fields.items()])

    query.__doc__ = f"The flat table of the {name}."
    return query


#: the columns of each list's flat table, by the members' fields
_P5_FIELDS = {
    "relationships": {"relate": "relate"},
    "urls": {"url": "vcard:hasURL", "at_time": "bcube:atTime", "url_source": "bcube:hasUrlSource", "status": "http:statusCodeValue"},
    "layers": {"title": "dc:title", "description": "dc:description", "style": "style"},
    "webpages": {"title": "dc:title"},
}


# --- p6: instants -----------------------------------------------------------------


def instants(spark: SparkSession, sf: str) -> DataFrame:
    """Every written moment with its provider's zone and order of days."""
    ds = table(spark, sf, "datasets", ["dataset_id", "provider_id", "esip_startdate", "esip_enddate", "caldate"])
    names = ("esip_startdate", "esip_enddate", "caldate")
    written = ds.select("dataset_id", "provider_id", F.inline(F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(n).alias("value")) for n in names]))).select("field_name", F.col("dataset_id").alias("row_id"), "value", "provider_id")
    at = table(spark, sf, "atom_items", ["item_id", "provider_id", "published"]).select(F.lit("published").alias("field_name"), F.col("item_id").alias("row_id"), F.col("published").alias("value"), "provider_id")
    # providers are a fixed table; Catalyst broadcasts it by its measured size
    own = table(spark, sf, "providers", ["provider_id", "tz", "day_first"]).groupBy("provider_id").agg(F.min("tz").alias("tz"), F.max("day_first").alias("day_first"))
    return to_instants(written.unionAll(at).where("value IS NOT NULL AND row_id IS NOT NULL").join(own, "provider_id", "left"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """The UTC instant of every value that names one."""
    return instants(spark, sf).where("utc IS NOT NULL").select("field_name", "row_id", "utc").distinct()


def p6_unreadable(spark: SparkSession, sf: str) -> DataFrame:
    """The values that name no moment, with their number."""
    return instants(spark, sf).where("utc IS NULL AND trim(value) <> ''").groupBy("field_name", "value").agg(F.countDistinct("row_id").alias("n_rows"))


QUERIES = {
    f.__name__: f
    for f in (p2_found, p2_report, p3_found, p3_terms, p4_found, p4_paths, p4_descendants, p5_found, p6_found, p6_unreadable)
} | {f"p5_{n}": _p5_table(n, **f) for n, f in _P5_FIELDS.items()}


# --- the same in SQL, where SQL can say it -----------------------------------------

_EDGES_SQL = """
tgt AS (
  SELECT 'url_entities' tab, object_id o, loaded_at, deleted_at FROM url_entities UNION ALL
  SELECT 'descriptions', object_id, loaded_at, deleted_at FROM descriptions UNION ALL
  SELECT 'publishers', object_id, loaded_at, deleted_at FROM publishers UNION ALL
  SELECT 'keyword_sets', object_id, loaded_at, deleted_at FROM keyword_sets UNION ALL
  SELECT 'datasets', object_id, loaded_at, deleted_at FROM datasets),
spans AS (SELECT tab, right(regexp_replace(lower(o), '[^0-9a-f]', '', 'g'), 32) k, loaded_at, deleted_at FROM tgt),
edge AS (
  SELECT DISTINCT edge_id, recorded_at, right(regexp_replace(lower(object_id), '[^0-9a-f]', '', 'g'), 32) k,
    CASE lower(trim(src_kind)) WHEN 'dataset' THEN 'datasets' WHEN 'description' THEN 'descriptions' END src_tab,
    right(regexp_replace(lower(src_id), '[^0-9a-f]', '', 'g'), 32) src_k,
    CASE regexp_replace(lower(relate), '[^a-z0-9]', '', 'g')
      WHEN 'bcubeoriginatedfrom' THEN 'url_entities' WHEN 'dctermsreferences' THEN 'url_entities' WHEN 'bcubehasmetadatarecord' THEN 'descriptions'
      WHEN 'dctermspublisher' THEN 'publishers' WHEN 'dcconformsto' THEN 'keyword_sets' WHEN 'foafprimarytopic' THEN 'datasets' END tab
  FROM relationships WHERE relate IS NOT NULL AND object_id IS NOT NULL),
judged AS (
  SELECT *, EXISTS (SELECT 1 FROM spans s WHERE s.tab = e.tab AND s.k = e.k AND s.loaded_at <= e.recorded_at AND (s.deleted_at IS NULL OR s.deleted_at > e.recorded_at)) alive
  FROM edge e WHERE tab IS NOT NULL)"""

_LINKS_SQL = """
t AS (SELECT DISTINCT node_id, catalog_url, thredds_id, regexp_replace(childof, '^\\s+|\\s+$', '', 'g') up FROM thredds_nodes WHERE node_id IS NOT NULL),
link(tree, node, parent) AS (
  SELECT 'thredds', CAST(c.node_id AS VARCHAR), CAST(min(p.node_id) AS VARCHAR)
  FROM t c LEFT JOIN t p ON p.catalog_url = c.catalog_url AND p.thredds_id = c.up AND c.up <> '' GROUP BY c.node_id
  UNION ALL
  SELECT 'harvest', h.url, min(p.url) FROM harvest_records h LEFT JOIN harvest_records p ON p.url = json_extract_string(h.harvest_details, '$.parent_url') AND trim(p.url) <> ''
  WHERE h.url IS NOT NULL GROUP BY h.url)"""

#: the members of all lists: a value is opened as long as it packs others, an object gives its lists
_MEMBERS_SQL = r"""
doc AS (SELECT desc_id, min(body) body FROM descriptions WHERE json_valid(body) GROUP BY desc_id),
step(desc_id, list_name, parent_id, list_place, place, v) AS (
  SELECT desc_id, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]), CAST(body AS JSON) FROM doc
  UNION ALL (
  SELECT desc_id, list_name, parent_id, list_place, list_append(place, 0), CAST(v->>'$' AS JSON) FROM step
  WHERE json_type(v) = 'VARCHAR' AND regexp_matches(v->>'$', '^\s*["\[{]') AND json_valid(v->>'$')
  UNION ALL
  SELECT s.desc_id, CASE WHEN enters THEN e.key WHEN packs THEN s.list_name END, CASE WHEN enters THEN coalesce(s.v->>'$.object_id', '') WHEN packs THEN s.parent_id END,
    CASE WHEN enters THEN list_append(s.place, e.id) WHEN packs THEN s.list_place END, list_append(s.place, e.id), e.value
  FROM (SELECT *, (json_type(v) = 'ARRAY' OR len(list_filter(json_keys(v), lambda k: NOT regexp_full_match(k, '[0-9]+'))) = 0
    OR len(json_keys(v)) = 1 AND json_keys(v)[1] NOT IN ('relationships', 'urls', 'layers', 'webpages') AND json_type(json_extract(v, '$.*')[1]) IN ('ARRAY', 'OBJECT')) packs FROM step WHERE json_type(v) IN ('ARRAY', 'OBJECT')) s, LATERAL json_each(s.v) e,
  LATERAL (SELECT json_type(s.v) = 'OBJECT' AND NOT (s.packs AND s.list_name IS NOT NULL) AND e.key IN ('relationships', 'urls', 'layers', 'webpages') enters) x)),
member AS (SELECT *, row_number() OVER (PARTITION BY desc_id, list_place ORDER BY place) - 1 pos FROM step WHERE list_name IS NOT NULL AND json_type(v) = 'OBJECT' AND NOT (json_type(v) = 'ARRAY' OR len(list_filter(json_keys(v), lambda k: NOT regexp_full_match(k, '[0-9]+'))) = 0
    OR len(json_keys(v)) = 1 AND json_keys(v)[1] NOT IN ('relationships', 'urls', 'layers', 'webpages') AND json_type(json_extract(v, '$.*')[1]) IN ('ARRAY', 'OBJECT')))"""


def _p5_sql(name: str, **fields: str) -> str:
    attrs = ", ".join(f"v->>'$.\"{k}\"' AS {a}" for a, k in fields.items())
    return f"WITH RECURSIVE {_MEMBERS_SQL} SELECT desc_id, parent_id, pos, coalesce(v->>'$.object_id', '') AS object_id, {attrs} FROM member WHERE list_name = '{name}'"


SQL = {
    "p2_found": f"WITH {_EDGES_SQL} SELECT DISTINCT edge_id FROM judged WHERE NOT alive",
    "p2_report": f"""
WITH RECURSIVE {_EDGES_SQL},
faulty(tab, k) AS (
  SELECT DISTINCT src_tab, src_k FROM judged WHERE NOT alive AND src_tab IS NOT NULL AND src_k IS NOT NULL
  UNION
  SELECT j.src_tab, j.src_k FROM judged j JOIN faulty f ON j.tab = f.tab AND j.k = f.k WHERE j.alive AND j.src_tab IS NOT NULL AND j.src_k IS NOT NULL)
SELECT j.tab AS target_table, strftime(recorded_at, '%Y-%m') AS period, count(*) FILTER (NOT alive) AS n_direct, count(*) FILTER (alive) AS n_inherited
FROM judged j WHERE NOT alive OR EXISTS (SELECT 1 FROM faulty f WHERE f.tab = j.tab AND f.k = j.k)
GROUP BY ALL""",
    "p4_found": f"""
WITH RECURSIVE {_LINKS_SQL},
down(tree, node, root_node, node_depth) AS (
  SELECT tree, node, node, CAST(0 AS BIGINT) FROM link WHERE parent IS NULL
  UNION ALL
  SELECT l.tree, l.node, d.root_node, d.node_depth + 1 FROM down d JOIN link l ON l.tree = d.tree AND l.parent = d.node)
SELECT * FROM down
UNION ALL
SELECT tree, node, 'cycle', CAST(-1 AS BIGINT) FROM link WHERE (tree, node) NOT IN (SELECT (tree, node) FROM down)""",
    "p4_paths": f"""
WITH RECURSIVE {_LINKS_SQL},
down(tree, node, root_node, node_depth, path) AS (
  SELECT tree, node, node, CAST(0 AS BIGINT), [node] FROM link WHERE parent IS NULL
  UNION ALL
  SELECT l.tree, l.node, d.root_node, d.node_depth + 1, list_append(d.path, l.node) FROM down d JOIN link l ON l.tree = d.tree AND l.parent = d.node)
SELECT tree, node, root_node, node_depth, CAST(to_json(path) AS VARCHAR) AS path FROM down
UNION ALL
SELECT tree, node, 'cycle', CAST(-1 AS BIGINT), '[]' FROM link WHERE (tree, node) NOT IN (SELECT (tree, node) FROM down)""",
    "p4_descendants": f"""
WITH RECURSIVE {_LINKS_SQL},
ok(tree, node) AS (
  SELECT tree, node FROM link WHERE parent IS NULL
  UNION ALL
  SELECT l.tree, l.node FROM ok d JOIN link l ON l.tree = d.tree AND l.parent = d.node),
tied AS (SELECT l.* FROM link l JOIN ok USING (tree, node) WHERE parent IS NOT NULL),
pair(tree, node, descendant, distance) AS (
  SELECT tree, parent, node, CAST(1 AS BIGINT) FROM tied
  UNION ALL
  SELECT p.tree, t.parent, p.descendant, p.distance + 1 FROM pair p JOIN tied t ON t.tree = p.tree AND t.node = p.node)
SELECT * FROM pair""",
    "p5_found": f"WITH RECURSIVE {_MEMBERS_SQL} SELECT desc_id, parent_id, list_name, pos, coalesce(v->>'$.object_id', '') AS object_id FROM member",
} | {f"p5_{n}": _p5_sql(n, **f) for n, f in _P5_FIELDS.items()}
