"""Sharding by best-fit-decreasing bin packing of indivisible groups (rows of equal text).

Items sorted by size, largest first, each enter the bin with the least remaining capacity
that still holds them; bins are kept in a balanced search tree by remaining capacity.

``into_shards`` fills a fixed number of shards evenly: a group larger than an even share of
what is not yet placed gets a shard of its own, and for the others the capacity is the least
one, found by bisection, at which the packing needs no more bins.  Its items are bounded in number:
a group above ``1 / parcels`` of all bytes is an item of its own (there are fewer than
``parcels``), all other groups are dealt by hash into ``parcels`` items.  So the packing is
the same small job for any input.  Beside the shards of such large groups, loads differ by
about a parcel, or by the size of the groups that are items of their own.

``by_capacity`` opens as many shards of a given capacity as it needs.  Groups are dealt by
hash into zones of about ``zone_groups``; zones are packed in parallel, and each leaves at
most one shard little filled.

Defined cases: a null text has no bytes and equals the empty one; a row's size is its bytes
plus 1; a group larger than the capacity is a shard of its own; repeated rows are rows of
one group; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pontualis.llm.tables import with_running
from pontualis.sources.scratch import materialize


class BinTree:
    """Bins by (remaining capacity, number): a treap whose priorities are hashed numbers."""

    def __init__(self) -> None:
        self.root: list | None = None

    @staticmethod
    def _split(node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[2], right = BinTree._split(node[2], key)
            return node, right
        left, node[1] = BinTree._split(node[1], key)
        return left, node

    @staticmethod
    def _merge(a, b):
        if a is None or b is None:
            return a or b
        if a[3] > b[3]:
            a[2] = BinTree._merge(a[2], b)
            return a
        b[1] = BinTree._merge(a, b[1])
        return b

    def add(self, remaining: int, number: int) -> None:
        key = (remaining, number)
        left, right = self._split(self.root, key)
        priority = number * 0x9E3779B97F4A7C15 % (1 << 64)
        self.root = self._merge(self._merge(left, [key, None, None, priority]), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the tightest bin with at least ``size`` left."""
        node, best = self.root, None
        while node is not None:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        if best is not None:
            left, rest = self._split(self.root, best)
            _, right = self._split(rest, (best[0], best[1] + 1))
            self.root = self._merge(left, right)
        return best


def best_fit(sizes: Iterable[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each of ``sizes``, which come largest first; None if over ``most`` bins."""
    tree, bins, out = BinTree(), 0, []
    for size in sizes:
        found = tree.take(size)
        if found is None:
            if most is not None and bins == most:
                return None
            found, bins = (max(capacity, size), bins), bins + 1
        tree.add(found[0] - size, found[1])
        out.append(found[1])
    return out


def even_bins(sizes: Sequence[int], bins: int) -> list[int]:
    """Best fit with the least capacity that bisection finds to need no more than ``bins``.

    An item above an even share of itself and all smaller ones has a bin of its own, or its
    size would be the capacity of every bin and leave the last ones empty.
    """
    rest, alone = sum(sizes), 0
    while alone < len(sizes) and sizes[alone] * (bins - alone) > rest:
        rest -= sizes[alone]
        alone += 1
    others = _least_capacity(sizes[alone:], bins - alone)
    return [*range(alone), *(alone + b for b in others)]


def _least_capacity(sizes: Sequence[int], bins: int) -> list[int]:
    if not sizes:
        return []
    low = max(sizes[0], -(-sum(sizes) // bins))
    high = low + sizes[0]
    while (packed := best_fit(sizes, high, bins)) is None:
        high *= 2
    while low < high:
        middle = (low + high) // 2
        tried = best_fit(sizes, middle, bins)
        if tried is None:
            low = middle + 1
        else:
            packed, high = tried, middle
    return packed


def _rows(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return df.select(F.col(id_column).alias("id"),
                     (F.octet_length(text).cast("long") + 1).alias("size"),
                     F.crc32(text).alias("crc"), F.sha2(text, 256).alias("sha"))


def _slots(placed: DataFrame) -> DataFrame:
    """Gapless positions in each shard, in a seeded order."""
    mixed = F.xxhash64("id", "sha")
    bucket = F.shiftrightunsigned(mixed, 52).cast("int")
    return with_running(placed, ["shard"], [mixed, F.col("id")], bucket, F.lit(1), "slot")


def into_shards(df: DataFrame, shards: int, *, id_column: str = "doc_id",
                text_column: str = "text", parcels: int = 4096) -> DataFrame:
    """One row per input row: ``id, size, crc, sha, shard, slot``."""
    spark = df.sparkSession
    rows = materialize(_rows(df, id_column, text_column)
                       .withColumn("parcel", F.pmod(F.xxhash64("sha"), F.lit(parcels))), "sizes")
    sums = rows.groupBy("sha", "parcel").agg(F.sum("size").alias("size"))
    total = sums.agg(F.sum("size")).first()[0] or 0
    large = F.col("size") * parcels > total
    # Two tables of fewer than ``parcels`` rows each.
    own = sums.filter(large).select("sha", "size").collect()
    dealt = sums.filter(~large).groupBy("parcel").agg(F.sum("size").alias("size")).collect()
    items = sorted([(-r.size, r.sha, None) for r in own]
                   + [(-r.size, "", r.parcel) for r in dealt],
                   key=lambda x: (x[0], x[1], -1 if x[2] is None else x[2]))
    shard = even_bins([-x[0] for x in items], shards)
    groups = [(x[1], s) for x, s in zip(items, shard, strict=True) if x[2] is None]
    hashed = [(x[2], s) for x, s in zip(items, shard, strict=True) if x[2] is not None]
    by_group = spark.createDataFrame(groups, "sha string, group_shard int")
    by_parcel = spark.createDataFrame(hashed, "parcel long, parcel_shard int")
    placed = (rows.join(F.broadcast(by_group), "sha", "left")
              .join(F.broadcast(by_parcel), "parcel", "left")
              .select("id", "size", "crc", "sha",
                      F.coalesce("group_shard", "parcel_shard").alias("shard")))
    return _slots(placed)


def by_capacity(df: DataFrame, capacity: int, *, id_column: str = "doc_id",
                text_column: str = "text", zone_groups: int = 50_000) -> DataFrame:
    """One row per input row: ``id, size, crc, sha, shard, slot``; shards are numbered from 0."""
    rows = materialize(_rows(df, id_column, text_column), "sizes")
    sums = rows.groupBy("sha").agg(F.sum("size").alias("size"))
    zones = -(-sums.count() // zone_groups) or 1

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "sha"], ascending=[False, True])
        return group.assign(bin=best_fit(group["size"].tolist(), capacity))

    packed = materialize(
        sums.withColumn("zone", F.pmod(F.xxhash64("sha"), F.lit(zones)))
        .groupBy("zone").applyInPandas(pack, "sha string, size long, zone long, bin long"),
        "packed")
    counts = packed.groupBy("zone").agg((F.max("bin") + 1).alias("bins"))
    before = W.orderBy("zone").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("zone", F.coalesce(F.sum("bins").over(before), F.lit(0)).alias("base"))
    shard: Column = (F.col("base") + F.col("bin")).cast("long")
    found = packed.join(bases, "zone").select("sha", shard.alias("shard"))
    # A text that many rows share is met by one row here; AQE splits its side of the join.
    return _slots(rows.join(found, "sha").select("id", "size", "crc", "sha", "shard"))
