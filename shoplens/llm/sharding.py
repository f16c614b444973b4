"""Shards of near equal bytes by best-fit decreasing over indivisible groups.

Rows with equal texts form a group that is never divided. Groups larger than
``1 / fine`` of a shard are items of their own (there are at most ``shards *
fine`` of them, as their sizes add up to no more than all bytes); all smaller
groups are gathered by a hash of their text into ``shards * fine`` bundles.
So the items are bounded by the shard count, not by the data, and the packing
runs on the driver: items in descending order enter the bin with the tightest
remaining capacity, found in a balanced tree. An item above the even share of
what is left gets a shard of its own; for the others the capacity is the
smallest for which best-fit decreasing needs no more than the remaining shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import number_rows, save, text_key

SHARDS, FINE = 24, 400


class RoomTree:
    """Balanced (AVL) search tree of (room, bin): the tightest room that holds a size."""

    class Node:
        __slots__ = ("key", "left", "right", "height")

        def __init__(self, key):
            self.key, self.left, self.right, self.height = key, None, None, 1

    def __init__(self):
        self.root = None

    @staticmethod
    def _height(n):
        return n.height if n else 0

    def _fix(self, n):
        n.height = 1 + max(self._height(n.left), self._height(n.right))
        lean = self._height(n.left) - self._height(n.right)
        if lean > 1:
            if self._height(n.left.left) < self._height(n.left.right):
                n.left = self._turn_left(n.left)
            return self._turn_right(n)
        if lean < -1:
            if self._height(n.right.right) < self._height(n.right.left):
                n.right = self._turn_right(n.right)
            return self._turn_left(n)
        return n

    def _turn_right(self, n):
        top = n.left
        n.left, top.right = top.right, n
        self._fix(n)
        return self._fix(top)

    def _turn_left(self, n):
        top = n.right
        n.right, top.left = top.left, n
        self._fix(n)
        return self._fix(top)

    def add(self, key):
        def go(n):
            if n is None:
                return self.Node(key)
            if key < n.key:
                n.left = go(n.left)
            else:
                n.right = go(n.right)
            return self._fix(n)
        self.root = go(self.root)

    def remove(self, key):
        def smallest(n):
            return n if n.left is None else smallest(n.left)

        def go(n, key):
            if key < n.key:
                n.left = go(n.left, key)
            elif key > n.key:
                n.right = go(n.right, key)
            elif n.left is None or n.right is None:
                return n.left or n.right
            else:
                n.key = smallest(n.right).key
                n.right = go(n.right, n.key)
            return self._fix(n)
        self.root = go(self.root, key)

    def tightest(self, size):
        """The smallest (room, bin) with room >= size, or None."""
        n, found = self.root, None
        while n:
            if n.key[0] >= size:
                n, found = n.left, n.key
            else:
                n = n.right
        return found


def best_fit(items: list[tuple[int, object]], capacity: int, limit: int | None = None) -> dict | None:
    """Bin of each item, items in the given (descending) order; None if over ``limit`` bins."""
    tree, place, bins = RoomTree(), {}, 0
    for size, name in items:
        spot = tree.tightest(size)
        if spot is None:
            if size > capacity or bins == limit:
                return None
            spot = (capacity, bins)
            bins += 1
        else:
            tree.remove(spot)
        place[name] = spot[1]
        tree.add((spot[0] - size, spot[1]))
    return place


def pack_into(items: list[tuple[int, object]], shards: int) -> dict:
    """Best-fit decreasing with the smallest capacity that needs at most ``shards`` bins.

    Items larger than the even share of what is left have bins of their own,
    the first ones, so that they do not set the capacity of the others.
    """
    items = sorted(items, key=lambda x: (-x[0], x[1]))
    own, rest = {}, sum(s for s, _ in items)
    while len(own) < len(items) and items[len(own)][0] * (shards - len(own)) > rest:
        size, name = items[len(own)]
        own[name] = len(own)
        rest -= size
    items, shards = items[len(own):], shards - len(own)
    if not items:
        return own
    low = max([-(-sum(s for s, _ in items) // shards), *(s for s, _ in items[:1]), 1])
    high, best = low, best_fit(items, low, shards)
    step = max(1, low // 1000)
    while best is None:  # a capacity that does
        low, high = high + 1, high + step
        step *= 2
        best = best_fit(items, high, shards)
    while low < high:
        mid = (low + high) // 2
        found = best_fit(items, mid, shards)
        if found is None:
            low = mid + 1
        else:
            high, best = mid, found
    return own | {name: k + len(own) for name, k in best.items()}


def assign_shards(docs: DataFrame, shards: int = SHARDS, fine: int = FINE) -> DataFrame:
    """Shard and slot of every row of ``docs`` (doc_id, text; others are ignored).

    Size is the UTF-8 length of the text (null: 0) plus 8. Equal texts stay in
    one shard; null and empty texts are one group. Slots are 0, 1, ... within
    a shard, ordered by group, then doc_id; repeated rows get slots of their
    own. A group larger than an even share has a shard to itself; the other shards
    share the rest evenly.
    An empty table gives no rows. Texts are hashed where they are read and not
    shuffled; groups are pre-aggregated before the shuffle.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(raw).cast("long") + 8).alias("size"),
                       F.crc32(raw).alias("text_crc32"), text_key(F.col("text")).alias("group"))
    rows = save(rows, "shard-rows")
    groups = save(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large_from = -(-total // (shards * fine)) + 1
    bundle = F.pmod(F.xxhash64("group"), F.lit(shards * fine))
    # at most shards * fine large groups, and as many bundles
    large = {r["group"]: r["bytes"] for r in groups.where(F.col("bytes") >= large_from).collect()}
    small = {r["bundle"]: r["bytes"] for r in groups.where(F.col("bytes") < large_from)
             .groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes")).collect()}
    items = [(b, ("group", g)) for g, b in large.items()] + [(b, ("bundle", k)) for k, b in small.items()]
    place = pack_into(items, shards)
    of_group = spark.createDataFrame([(g, s) for (kind, g), s in place.items() if kind == "group"], "group long, g_shard int")
    of_bundle = spark.createDataFrame([(k, s) for (kind, k), s in place.items() if kind == "bundle"], "bundle long, b_shard int")
    placed = (rows.withColumn("bundle", bundle)
              .join(F.broadcast(of_group), "group", "left").join(F.broadcast(of_bundle), "bundle", "left")
              .select("doc_id", "size", "text_crc32", "group", F.coalesce("g_shard", "b_shard").alias("shard")))
    return number_rows(placed, "shard", ["group", "doc_id"], "slot", "shard-slots").drop("group")
