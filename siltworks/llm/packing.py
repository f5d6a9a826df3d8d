"""Filling fixed-capacity containers with items.

Best-fit decreasing: items in falling size, each into the open bin with the least
remaining capacity that still takes it, else into a new bin. A segment tree over
the remaining capacities finds that bin in logarithmic time: its leaves hold the
open bins by remaining capacity, its nodes whether any lie below.

Bins of different items do not depend on each other, so the corpus is packed in
independent shards of about ``shard_items`` items by a hash of the item. The loss
is at most one badly filled bin a shard and capacity, far below a thousandth; a
shard fits any worker, and no key can make one larger, as items and not keys are
spread.

Only an item larger than the capacity is split: into full pieces, which fill bins
of their own, and one rest, which is packed like any item.

Defined results: an item of size 0 needs no room and is listed with bin null; an
item of unknown size is not packed either; ties of size go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import ship

SHARD_ITEMS = 20_000


class BinTree:
    """Open bins by remaining capacity, under a segment tree of counts."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.bins: dict[int, list[int]] = {}

    def add(self, room: int, bin_: int) -> None:
        self.bins.setdefault(room, []).append(bin_)
        i, c = room + self.width, self.count
        while i:
            c[i] += 1
            i >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, bin) of the tightest bin with room for size, removed from the tree."""
        i, c = size + self.width, self.count
        if not c[i]:
            # up to the first right neighbour that holds a bin, then down its left edge
            while True:
                if i & (i + 1) == 0:
                    return None
                if i & 1 or not c[i + 1]:
                    i >>= 1
                    if i & (i + 1) == 0:
                        return None
                    continue
                i += 1
                break
            while i < self.width:
                i <<= 1
                if not c[i]:
                    i += 1
        room = i - self.width
        bin_ = self.bins[room].pop()
        while i:
            c[i] -= 1
            i >>= 1
        return room, bin_


def best_fit_decreasing(sizes: Iterable[int], capacity: int) -> list[int]:
    """The bin of each item; sizes must fall and lie between 1 and capacity."""
    tree, out, n = BinTree(capacity), [], 0
    for s in sizes:
        got = tree.take(s)
        if got is None:
            room, bin_ = capacity, n
            n += 1
        else:
            room, bin_ = got
        out.append(bin_)
        if room > s:
            tree.add(room - s, bin_)
    return out


def _pack(ids: np.ndarray, sizes: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Pieces of one shard with their bins; -1 for items that need no room."""
    full = sizes // capacity
    rest = sizes - full * capacity
    # full pieces fill their bins; pieces are numbered from the text's beginning
    who = np.repeat(np.arange(len(ids)), full)
    first = np.cumsum(full) - full
    piece = np.arange(len(who)) - np.repeat(first, full)
    left = np.flatnonzero(rest)
    order = left[np.lexsort((ids[left], -rest[left]))]
    bins = np.array(best_fit_decreasing(rest[order].tolist(), capacity), np.int64)
    none = np.flatnonzero(sizes == 0)
    zero = np.zeros(len(none), np.int64)
    return {
        "id": np.concatenate([ids[who], ids[order], ids[none]]),
        "piece": np.concatenate([piece, full[order], zero]),
        "begin": np.concatenate([piece * capacity, full[order] * capacity, zero]),
        "n": np.concatenate([np.full(len(who), capacity, np.int64), rest[order], zero]),
        "bin": np.concatenate([np.arange(len(who), dtype=np.int64), bins + len(who), zero - 1]),
    }


def pack(items: DataFrame, row_id: str, size: str, containers: dict[str, int], shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(container_kind, bin_id, <row_id>, piece, begin, n_tokens): who lies where.

    ``containers`` maps a kind to its capacity. bin_id is unique within the kind.
    One shuffle of (id, size) rows, by shard; the size is read once, as it may be
    dear: items without size go through the shards like all others.
    """
    spark = items.sparkSession
    ship(spark)
    kinds = {k: int(v) for k, v in containers.items() if v and int(v) > 0}
    shards = max(1, -(-items.count() // shard_items))
    kind = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("capacity")) for k, v in kinds.items()]))
    own = items.select(F.col(row_id).cast("bigint").alias("id"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("size"))
    sharded = own.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards))).withColumn("k", kind).select("id", "size", "shard", "k.*")

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        got = _pack(pdf["id"].to_numpy(), np.maximum(pdf["size"].to_numpy(), 0), int(pdf["capacity"].iloc[0]))
        bins = pd.Series((int(pdf["shard"].iloc[0]) << 32) + got["bin"], dtype="Int64").mask(got["bin"] < 0)
        return pd.DataFrame({"container_kind": pdf["kind"].iloc[0], "bin_id": bins, "id": got["id"], "piece": got["piece"], "begin": got["begin"], "n_tokens": got["n"]})

    schema = "container_kind string, bin_id bigint, id bigint, piece bigint, begin bigint, n_tokens bigint"
    return sharded.groupBy("kind", "shard").applyInPandas(packed, schema).withColumnRenamed("id", row_id)
