"""Duplicates hidden by formatting differences.

Records are copies if one of their canonical keys agrees; copies of copies are
copies. ``find_copies`` works in three steps.

1. Rows collapse to distinct combinations of keys, each with the smallest id and
   the number of rows. Keys that hold more than a task's share of the rows are found
   exactly with partial counts; their rows are aggregated on two levels, first by
   salt, then by key; all others take one shuffle.
2. Combinations that share a key are linked to the smallest id that has it (a
   star, never all pairs; hot hubs are broadcast), and linked groups are contracted to their components:
   in each round every vertex joins its neighbour of highest random priority, so
   the number of vertices falls geometrically, whatever the shape of the chains.
3. The smallest id of a component represents it; the rows of other ids are its
   copies, their number is the sum over the component's combinations. Hot combinations are looked up by broadcast (there are few by the
   definition of hot), the others by one join.

Defined results: null and empty keys match nothing, so a row without keys is its
own resource; repeated deliveries of an id are one copy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import HOT_LEAST, Stages, hot_keys, is_hot, salts_of

_NOT_ALNUM = r"[^\p{L}\p{N}]"


def alnum(c: Column) -> Column:
    """Only the letters and digits, in lower case."""
    return F.lower(F.regexp_replace(c, _NOT_ALNUM, ""))


def decoded(c: Column) -> Column:
    """Percent escapes as their characters; what is no escape stays."""
    safe = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), c)


def url_key(c: Column) -> Column:
    """Scheme, host, path and set of parameters of a URL, as only letters and digits.

    Separators are looked for before escapes are decoded; fragments do not count;
    parameters are parted by & or ; and sorted, empty and repeated ones dropped.
    """
    bare = F.regexp_replace(c, "#.*", "")
    scheme = F.when(F.instr(bare, "://") > 0, F.substring_index(bare, "://", 1)).otherwise("")
    rest = F.when(F.instr(bare, "://") > 0, F.regexp_replace(bare, r"(?s)^.*?://", "")).otherwise(bare)
    before = F.substring_index(rest, "?", 1)
    query = F.when(F.instr(rest, "?") > 0, F.regexp_replace(rest, r"(?s)^[^?]*\?", "")).otherwise("")
    host = F.regexp_extract(before, r"(?s)^[^/\\]*", 0)
    path = F.regexp_replace(before, r"(?s)^[^/\\]*", "")
    params = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(query, "[&;]"), lambda p: alnum(decoded(p))), lambda p: p != "")))
    parts = F.concat_ws("\x1f", alnum(scheme), alnum(decoded(host)), alnum(decoded(path)), F.concat_ws("\x1e", params))
    return F.when(alnum(c) != "", parts)


def text_key(c: Column) -> Column:
    """The letters and digits of an identifier; null if it has none."""
    k = alnum(c)
    return F.when(k != "", k)


def _digest(c: Column) -> Column:
    return F.when(c.isNotNull(), F.unhex(F.md5(c)))


def _counted(rows: DataFrame, keys: list[str], hot: dict[int, int]) -> DataFrame:
    """Smallest id and number of rows of each key: hot keys on two levels."""
    agg = [F.min("id").alias("id"), F.sum("n").cast("bigint").alias("n")]
    one = rows.withColumn("n", F.lit(1))
    if not hot:
        return one.groupBy(*keys).agg(*agg)
    warm = is_hot(hot, *keys)
    first = one.where(warm).withColumn("salt", F.pmod(F.xxhash64("id"), salts_of(hot, *keys))).groupBy(*keys, "salt").agg(*agg)
    return one.where(~warm).groupBy(*keys).agg(*agg).unionByName(first.groupBy(*keys).agg(*agg))


def _star(groups: DataFrame, key: str, least: int) -> DataFrame:
    """Edges (a, b) from each id that has a key to the smallest id that has it."""
    own = groups.where(F.col(key).isNotNull()).select(key, "id")
    hub = own.groupBy(key).agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("m")).where("m > 1").select(key, "a")
    hot = hot_keys(own, key, least=least)  # one url under very many identifiers, or the reverse
    if not hot:
        return own.join(hub, key).select("a", F.col("id").alias("b"))
    warm = is_hot(hot, key)
    cold = own.where(~warm).join(hub.where(~warm), key)
    # as few hubs as there are hot keys: safe to broadcast
    return cold.unionByName(own.where(warm).join(F.broadcast(hub.where(warm)), key)).select("a", F.col("id").alias("b"))


def _components(edges: DataFrame, stages: Stages) -> DataFrame:
    """(v, root) of the vertices of edges (a, b): root is any vertex of the component."""
    edges = stages.put(edges.where("a <> b").distinct())
    maps: list[DataFrame] = []
    rounds = 0
    while not edges.isEmpty():
        rounds += 1
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(rounds)).alias("r"), F.col(c).alias("v"))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        to = stages.put(best.select(F.col("a").alias("v"), F.when(F.col("m") < rank("a"), F.col("m.v")).otherwise(F.col("a")).alias("to")))
        maps.append(to)
        old = edges
        edges = stages.put(
            edges.join(to.select(F.col("v").alias("a"), F.col("to").alias("ra")), "a")
            .join(to.select(F.col("v").alias("b"), F.col("to").alias("rb")), "b")
            .where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
        stages.drop(old)
    out = None
    for to in reversed(maps):
        # to: this round's vertices; out: where the next rounds took what they became
        here = to.select("v", F.col("to").alias("root"))
        if out is not None:
            here = here.join(out.select(F.col("v").alias("root"), F.col("root").alias("last")), "root", "left").select("v", F.coalesce("last", "root").alias("root"))
        out = stages.put(here)
    return out


@dataclass(frozen=True)
class _Collapsed:
    """Rows (id, keys) of a table and their combinations of keys (keys, n, keep_id)."""

    rows: DataFrame
    groups: DataFrame
    names: list[str]
    hot: dict[int, int]

    @property
    def keyed(self) -> DataFrame:
        return self.rows.where(" OR ".join(f"{k} IS NOT NULL" for k in self.names))

    @property
    def alone(self) -> DataFrame:
        return self.rows.where(" AND ".join(f"{k} IS NULL" for k in self.names))


def _collapse(records: DataFrame, row_id: str, keys: dict[str, Column], least: int, once: bool) -> _Collapsed:
    """``once`` takes out repeated deliveries beforehand, which only their number needs."""
    stages = Stages(records.sparkSession, "copies")
    names = list(keys)
    rows = records.where(F.col(row_id).isNotNull()).select(F.col(row_id).alias("id"), *[_digest(c).alias(k) for k, c in keys.items()])
    rows = stages.put(rows.distinct() if once else rows)
    found = _Collapsed(rows, rows, names, {})
    hot = hot_keys(found.keyed, *names, least=least)
    groups = stages.put(_counted(found.keyed, names, hot))
    edges = _star(groups, names[0], least)
    for k in names[1:]:
        edges = edges.unionAll(_star(groups, k, least))
    comp = _components(edges, stages)
    if comp is not None:
        keep = comp.groupBy("root").agg(F.min("v").alias("keep_id"))
        groups = groups.join(comp.join(keep, "root").select(F.col("v").alias("id"), "keep_id"), "id", "left").select(*names, "n", F.coalesce("keep_id", "id").alias("keep_id"))
    else:
        groups = groups.select(*names, "n", F.col("id").alias("keep_id"))
    return _Collapsed(rows, groups, names, hot)


def find_copies(records: DataFrame, row_id: str, keys: dict[str, Column], least: int = HOT_LEAST) -> DataFrame:
    """(id, keep_id) of every input id, once: keep_id is the smallest id among its copies, itself included.

    ``keys`` are named canonical keys; ``least`` is the number of rows below which a
    key is never hot.
    """
    got = _collapse(records, row_id, keys, least, once=False)
    same = lambda g: [got.keyed[k].eqNullSafe(g[k]) for k in got.names]
    groups, keyed, warm = got.groups, got.keyed, is_hot(got.hot, *got.names)
    cold = groups.where(~warm) if got.hot else groups
    found = keyed.where(~warm).join(cold, same(cold)) if got.hot else keyed.join(cold, same(cold))
    out = found.select("id", "keep_id")
    if got.hot:
        few = groups.where(warm)  # at most as many as hot keys: safe to broadcast
        out = out.unionAll(keyed.where(warm).join(F.broadcast(few), same(few)).select("id", "keep_id"))
    return out.unionAll(got.alone.select("id", F.col("id").alias("keep_id"))).groupBy("id").agg(F.min("keep_id").alias("keep_id"))


def count_copies(records: DataFrame, row_id: str, keys: dict[str, Column], least: int = HOT_LEAST) -> DataFrame:
    """(keep_id, n_copies): one row per resource, counted by the aggregation of the keys.

    Equal deliveries of an id count once; an id that comes with several contents counts
    with each of them.
    """
    got = _collapse(records, row_id, keys, least, once=True)
    counted = got.groups.groupBy("keep_id").agg(F.sum("n").cast("bigint").alias("n_copies"))
    return counted.unionAll(got.alone.select(F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("n_copies"))).groupBy("keep_id").agg(F.sum("n_copies").cast("bigint").alias("n_copies"))
