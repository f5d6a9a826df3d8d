"""References to records that do not exist.

``orphan_edges`` finds, for every edge of a reference table, whether the record
it names was alive in its target table when the edge was recorded, and then
cascades: a record with an orphaned reference is itself orphaned, so the edges
that point at it inherit the fault. Each round semi-joins the links with the last
round's records until no record is added (the fixpoint).

Liveness is a running maximum, not an interval join. Life spans and edges of a
key are sorted together by time; the record is alive at time t exactly if the
greatest end among the spans that began by t lies after t. One shuffle, one sort,
constant memory a key, no product of edges and spans.

Skew: a hot key's edges are spread over as many salts as they would fill tasks, and
only its spans are repeated per salt. Repeated deliveries of an edge count once.

Defined results: an edge whose relate or object_id is null is no reference; a
relate that belongs to no target table is skipped; an object_id without 32 hex
digits names nothing, so its edge is an orphan; an edge without recorded_at is
recorded before everything and so an orphan; a span without loaded_at never
begins. Further columns, also with clashing names, are ignored. Empty tables
give empty results, or orphans only where just the targets are empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..runtime import HOT_LEAST, Stages, hot_keys, salts_of

_FOREVER = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class Target:
    """A table that references may name: its rows' key and life span."""

    name: str
    rows: DataFrame
    key: str = "object_id"
    begin: str = "loaded_at"
    end: str = "deleted_at"


def uuid_key(c) -> F.Column:
    """The 16 bytes of the UUID in a text, in any case and dress; null if it has none."""
    c = F.col(c) if isinstance(c, str) else c
    found = F.regexp_extract(c, r"(?i)[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}", 0)
    bare = F.right(F.regexp_replace(c, "(?i)[^0-9a-f]", ""), F.lit(32))
    key = F.when(found != "", F.regexp_replace(found, "-", "")).when(F.length(bare) == 32, bare)
    return F.unhex(key)


def relate_key(c) -> F.Column:
    """A relate without case, white space and punctuation."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def orphan_edges(
    edges: DataFrame,
    targets: list[Target],
    relates: dict[str, str],
    sources: dict[str, str],
    least: int = HOT_LEAST,
) -> DataFrame:
    """Rows (edge_id, target, recorded_at, orphan, depth) of all orphaned edges.

    ``edges`` has edge_id, src_id, src_kind, relate, object_id, recorded_at;
    ``relates`` maps a relate to a target's name, ``sources`` a src_kind to the
    target table whose records it names. orphan is ``direct`` (depth 0) or
    ``inherited`` (depth = rounds the fault needed to arrive). Each edge_id comes
    once for each kind of fault that its deliveries have. ``least`` is the number of
    edges below which a key is never hot.
    """
    spark = edges.sparkSession
    at = {t.name: i for i, t in enumerate(targets)}
    kind = F.create_map(*[x for r, n in relates.items() for x in (F.lit("".join(filter(str.isalnum, r)).lower()), F.lit(at[n]))])
    src = F.create_map(*[x for k, n in sources.items() for x in (F.lit(k), F.lit(at[n]))])
    e = edges.where(F.col("relate").isNotNull() & F.col("object_id").isNotNull()).select(
        "edge_id",
        src[F.lower(F.trim("src_kind"))].cast("tinyint").alias("src"),
        uuid_key("src_id").alias("src_key"),
        kind[relate_key("relate")].cast("tinyint").alias("kind"),
        F.coalesce(uuid_key("object_id"), F.lit(b"")).alias("key"),
        "recorded_at",
    ).where("kind IS NOT NULL")
    spans = None
    for t in targets:
        s = t.rows.select(F.lit(at[t.name]).cast("tinyint").alias("kind"), uuid_key(t.key).alias("key"), F.col(t.begin).alias("t"), F.coalesce(F.col(t.end), F.lit(_FOREVER).cast("timestamp_ntz")).alias("until"))
        spans = s if spans is None else spans.unionAll(s)
    spans = spans.where("key IS NOT NULL AND t IS NOT NULL AND until > t")

    hot = hot_keys(e, "kind", "key", least=least)
    salts = salts_of(hot, "kind", "key")
    e = e.withColumn("salt", F.pmod(F.xxhash64("edge_id"), salts).cast("int"))
    spans = spans.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)) if hot else F.lit(0))

    both = spans.unionByName(e.withColumn("t", F.col("recorded_at")).withColumn("is_edge", F.lit(True)), allowMissingColumns=True)
    # at one moment spans come first: a record loaded at t is there at t
    w = Window.partitionBy("kind", "key", "salt").orderBy("t", F.col("is_edge").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    judged = (
        both.withColumn("last_end", F.max("until").over(w))
        .where("is_edge")
        .select("edge_id", "src", "src_key", "kind", "key", "recorded_at", F.coalesce(F.col("last_end") > F.col("recorded_at"), F.lit(False)).alias("alive"))
    )
    stages = Stages(spark, "orphans")
    judged = stages.put(judged)

    names = F.element_at(F.array(*[F.lit(t.name) for t in targets]), F.col("kind").cast("int") + 1)
    once = ["edge_id"]
    direct = judged.where("NOT alive").dropDuplicates(once).select("edge_id", names.alias("target"), "recorded_at", F.lit("direct").alias("orphan"), F.lit(0).alias("depth"))

    fed = sorted({at[n] for n in sources.values()})
    live = judged.where("alive").where(F.col("kind").isin(fed))
    links = stages.put(live.where("src IS NOT NULL AND src_key IS NOT NULL").select("src", "src_key", F.col("kind").alias("dst"), F.col("key").alias("dst_key")).distinct())
    frontier = stages.put(judged.where("NOT alive AND src IS NOT NULL AND src_key IS NOT NULL").select("src", "src_key").distinct().withColumn("depth", F.lit(0)))
    seen, depth = frontier, 0
    while True:
        depth += 1
        reached = (
            links.join(frontier.select(F.col("src").alias("dst"), F.col("src_key").alias("dst_key")), ["dst", "dst_key"], "left_semi")
            .select("src", "src_key").distinct()
            .join(seen, ["src", "src_key"], "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        frontier = stages.put(reached)
        if frontier.isEmpty():
            break
        seen = seen.unionAll(frontier)
    faulty = seen.select(F.col("src").alias("kind"), F.col("src_key").alias("key"), "depth")
    inherited = (
        live.join(faulty, ["kind", "key"])
        .dropDuplicates(once)
        .select("edge_id", names.alias("target"), "recorded_at", F.lit("inherited").alias("orphan"), (F.col("depth") + 1).alias("depth"))
    )
    return direct.unionAll(inherited)
