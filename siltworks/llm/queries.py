"""Queries of the training-text problems p1 and p7 to p10, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table
from .abuse import score_documents
from .bpe import count_tokens, encode_texts
from .copies import count_copies, find_copies, text_key, url_key
from .mojibake import find_mojibake
from .packing import pack

# --- p1: copies under other spellings -------------------------------------------


def _resources(spark: SparkSession, sf: str):
    rows = table(spark, sf, "url_entities", ["url_id", "vcard_hasurl", "dc_identifier"])
    return rows, "url_id", {"u": url_key(F.col("vcard_hasurl")), "i": text_key(F.col("dc_identifier"))}


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every copy with the smallest id of its copies."""
    return find_copies(*_resources(spark, sf)).where("id > keep_id").select("keep_id", F.col("id").alias("dup_id"))


def p1_resources(spark: SparkSession, sf: str) -> DataFrame:
    """One row per resource, with its number of copies and its first spelling."""
    counted = count_copies(*_resources(spark, sf))
    first = table(spark, sf, "url_entities", ["url_id", "vcard_hasurl", "dc_identifier"]).groupBy(F.col("url_id").alias("keep_id")).agg(F.min("vcard_hasurl").alias("vcard_hasurl"), F.min("dc_identifier").alias("dc_identifier"))
    return counted.join(first, "keep_id")


# --- p7: wrong encodings ----------------------------------------------------------


def mojibake(spark: SparkSession, sf: str) -> DataFrame:
    ds = table(spark, sf, "datasets", ["dataset_id", "dc_description", "dcterms_title"])
    names = ("dc_description", "dcterms_title")
    fields = ds.select("dataset_id", F.inline(F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(n).alias("text")) for n in names])))
    return find_mojibake(fields.select("field_name", F.col("dataset_id").alias("row_id"), "text"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """The damaged fields."""
    return mojibake(spark, sf).select("field_name", F.col("row_id").alias("dataset_id"))


def p7_restored(spark: SparkSession, sf: str) -> DataFrame:
    """The damaged fields with their encodings and, where possible, the original text."""
    return mojibake(spark, sf).withColumnRenamed("row_id", "dataset_id")


# --- p8: tokens ---------------------------------------------------------------------


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The token ids of every document."""
    return encode_texts(table(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text")


# --- p9: packing --------------------------------------------------------------------


def p9_packed(spark: SparkSession, sf: str) -> DataFrame:
    """Where every document lies, for every kind of container."""
    # containers are a fixed table of a few rows
    kinds = {r.container_kind: r.capacity_tokens for r in table(spark, sf, "containers", ["container_kind", "capacity_tokens"]).collect() if r.container_kind}
    sizes = count_tokens(table(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text")
    return pack(sizes, "doc_id", "n_tokens", kinds)


def p9_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Number of containers of each kind and how full they are."""
    cap = table(spark, sf, "containers", ["container_kind", "capacity_tokens"]).groupBy("container_kind").agg(F.max("capacity_tokens").alias("capacity"))
    used = p9_packed(spark, sf).where("bin_id IS NOT NULL").groupBy("container_kind", "bin_id").agg(F.sum("n_tokens").alias("n"))
    by_kind = used.groupBy("container_kind").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n").alias("n_tokens"))
    return by_kind.join(cap, "container_kind").select("container_kind", "capacity", "n_containers", "n_tokens", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity")), 6).alias("fill"))


# --- p10: abuse ---------------------------------------------------------------------


def scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", ["doc_id", "source", "text"])
    return score_documents(docs, table(spark, sf, "labels", ["doc_id", "toxic"]))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """The documents with an abusive passage."""
    return scores(spark, sf).where("abusive").select("doc_id")


def p10_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's score."""
    return scores(spark, sf).select("doc_id", F.round("score", 6).alias("score"), "abusive")


def p10_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Share of abusive documents per source."""
    return scores(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count(F.when(F.col("abusive"), 1)).alias("n_abusive"), F.round(F.avg(F.col("abusive").cast("double")), 6).alias("rate"))


QUERIES = {f.__name__: f for f in (p1_found, p1_resources, p7_found, p7_restored, p8_ids, p9_packed, p9_fill, p10_found, p10_scores, p10_rates)}

_COPIES_SQL = r"""
bare AS (SELECT DISTINCT url_id, vcard_hasurl u, dc_identifier, regexp_replace(vcard_hasurl, '#.*', '', 's') b FROM url_entities WHERE url_id IS NOT NULL),
cut AS (SELECT *, CASE WHEN instr(b, '://') > 0 THEN split_part(b, '://', 1) ELSE '' END s, CASE WHEN instr(b, '://') > 0 THEN b[instr(b, '://') + 3:] ELSE b END r FROM bare),
part AS (SELECT *, split_part(r, '?', 1) h, CASE WHEN instr(r, '?') > 0 THEN r[instr(r, '?') + 1:] ELSE '' END q FROM cut),
key AS (
  SELECT url_id id, nullif(lower(regexp_replace(dc_identifier, '[^\p{L}\p{N}]', '', 'g')), '') i,
    CASE WHEN regexp_replace(u, '[^\p{L}\p{N}]', '', 'g') <> '' THEN
      lower(regexp_replace(s, '[^\p{L}\p{N}]', '', 'g')) || '|' || lower(regexp_replace(url_decode(regexp_extract(h, '^[^/\\]*')), '[^\p{L}\p{N}]', '', 'g')) || '|' ||
      lower(regexp_replace(url_decode(regexp_replace(h, '^[^/\\]*', '')), '[^\p{L}\p{N}]', '', 'g')) || '|' ||
      array_to_string(list_sort(list_distinct(list_filter([lower(regexp_replace(url_decode(p), '[^\p{L}\p{N}]', '', 'g')) FOR p IN regexp_split_to_array(q, '[&;]')], lambda x: x <> ''))), '|') END u
  FROM part),
star AS (SELECT min(id) OVER (PARTITION BY u) a, id b FROM key WHERE u IS NOT NULL UNION SELECT min(id) OVER (PARTITION BY i), id FROM key WHERE i IS NOT NULL),
link AS (SELECT a, b FROM star WHERE a <> b UNION SELECT b, a FROM star WHERE a <> b),
reach(id, other) AS (SELECT a, a FROM link UNION SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.other),
comp AS (SELECT id, min(other) keep_id FROM reach GROUP BY id)"""

SQL = {
    "p1_found": f"WITH RECURSIVE {_COPIES_SQL} SELECT keep_id, id AS dup_id FROM comp WHERE id > keep_id",
    "p1_resources": f"""WITH RECURSIVE {_COPIES_SQL},
kept AS (SELECT k.id, coalesce(c.keep_id, k.id) keep_id FROM (SELECT DISTINCT url_id id FROM url_entities WHERE url_id IS NOT NULL) k LEFT JOIN comp c ON c.id = k.id)
SELECT keep_id, n_copies, min(vcard_hasurl) AS vcard_hasurl, min(dc_identifier) AS dc_identifier
FROM (SELECT keep_id, count(*) n_copies FROM kept GROUP BY keep_id) JOIN url_entities ON url_id = keep_id GROUP BY keep_id, n_copies""",
}
