"""Operator 11: shards of near-equal bytes that keep equal texts together (law ``bytes``).

Equal texts form one atomic group (a null text counts as the empty one). Groups stand in the order of their
smallest doc_id, then of their digest, and shards are runs of that order:

1. A group of more than an even share of what is left gets a shard of its own, since no partition can have
   a smaller largest shard; the rest is cut into the remaining shards.
2. The smallest capacity for which a greedy walk needs no more shards than there are is found by binary search.
3. The order is cut at that capacity. Within it each cut goes to the group boundary nearest to an even share
   of what is left, so that the last shards do not run short.

The walk needs group boundaries (byte offsets in the order), of which there may be billions. The driver holds a
bounded ``Skeleton`` of them instead: the first and last boundary in each of ``CELLS`` cells of the offset axis.
A walk over it gives bounds of every cut; cells that could still change the answer are read again in finer
cells until none is left. Each round is one aggregation that returns at most about ``CELLS`` rows.

Cases: a null text has 0 bytes, so size 1. Rows that share a doc_id are placed one by one, repeated rows too. A null
doc_id sorts before all others. An empty table gives no row. With fewer groups than shards, the other shards
stay empty. Extra columns are passed over by ``assign`` and kept by ``write``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import in_order, ranked, stage, table

#: Cells of the offset axis that the driver holds at a time (three numbers each).
CELLS = 1 << 15


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32 and digest of each row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))


def groups_of(rows: DataFrame) -> DataFrame:
    """(digest, first, bytes) of each atomic group."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes"))


def offsets(groups: DataFrame) -> DataFrame:
    """Groups in order with ``start``, the bytes of all groups before them."""
    rows = in_order(groups, [F.col("first"), F.col("digest")], "shard-groups").withColumn("_range", F.shiftright("_id", 33))
    sums = rows.groupBy("_range").agg(F.sum("bytes").alias("_sum"))
    base = sums.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_base"))  # a row per range
    inside = Window.partitionBy("_range").orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("_to", F.sum("bytes").over(inside)).join(base, "_range")
            .select("digest", "bytes", (F.col("_base") + F.col("_to") - F.col("bytes")).alias("start")))


class Skeleton:
    """Bounds of the group boundaries 0 < ... < total, exact where a cell holds at most two of them."""

    def __init__(self, placed: DataFrame, total: int, cells: int = CELLS):
        self.placed, self.total, self.cells = placed, total, cells
        self.width = -(-total // cells)
        self.open: list[tuple[int, int]] = []
        found = self._read(self.width, [(0, total)])
        self.lows, self.highs, self.counts = map(list, zip(*found))
        if total > self.highs[-1]:  # the end is a boundary too
            self.lows.append(total)
            self.highs.append(total)
            self.counts.append(1)

    def _read(self, width: int, spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        inside = F.lit(False)
        for a, b in spans:
            inside = inside | F.col("start").between(a, b)
        cell = F.expr(f"start div {width}L")
        rows = (self.placed.where(inside).groupBy(cell.alias("cell"))
                .agg(F.min("start").alias("low"), F.max("start").alias("high"), F.count("*").alias("n")).collect())
        return sorted((r.low, r.high, r.n) for r in rows)

    def below(self, x: int) -> tuple[int, int]:
        """Bounds of the largest boundary that is at most x."""
        i = bisect_right(self.lows, x) - 1
        if self.highs[i] <= x:
            return self.highs[i], self.highs[i]
        if self.counts[i] <= 2:
            return self.lows[i], self.lows[i]
        return self.lows[i], x

    def above(self, x: int) -> tuple[int, int]:
        """Bounds of the smallest boundary that is at least x."""
        i = bisect_left(self.highs, x)
        if self.lows[i] >= x:
            return self.lows[i], self.lows[i]
        if self.counts[i] <= 2:
            return self.highs[i], self.highs[i]
        return x, self.highs[i]

    def ask(self, a: int, b: int | None = None) -> None:
        """The next ``refine`` reads the cells that a..b touches."""
        i, j = bisect_left(self.highs, a), bisect_right(self.lows, a if b is None else b) - 1
        wanted = [k for k in range(i, j + 1) if self.counts[k] > 2]
        if wanted:
            self.open.append((self.lows[wanted[0]], self.highs[wanted[-1]]))

    def refine(self) -> bool:
        """Read what was asked for in finer cells; False if nothing was open."""
        spans: list[tuple[int, int]] = []
        for a, b in sorted(self.open):
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
            else:
                spans.append((a, b))
        self.open = []
        if not spans:
            return False
        length = sum(b - a + 1 for a, b in spans)
        self.width = max(1, min(self.width // 2, -(-length // self.cells)))
        kept = [(a, b, n) for a, b, n in zip(self.lows, self.highs, self.counts) if not any(s <= a <= t for s, t in spans)]
        self.lows, self.highs, self.counts = map(list, zip(*sorted(kept + self._read(self.width, spans))))
        return True


def walk(axis: Skeleton, capacity: int, shards: int, side: int) -> list[int]:
    """Ends of the shards of a greedy walk: lower bounds of them (side 0) or upper bounds (side 1)."""
    ends, at = [], 0
    for _ in range(shards):
        at = axis.total if at + capacity >= axis.total else axis.below(at + capacity)[side]
        ends.append(at)
    return ends


def smallest(low: int, high: int, holds) -> int:
    while low < high:
        mid = (low + high) // 2
        if holds(mid):
            high = mid
        else:
            low = mid + 1
    return low


def smallest_capacity(axis: Skeleton, largest: int, shards: int) -> int:
    """The least capacity whose greedy walk ends in time; ``largest`` is the largest group."""
    low = max(-(-axis.total // shards), largest)
    high = low + largest  # each shard but the last takes more than an even share
    while True:
        sure = smallest(low, high, lambda c: walk(axis, c, shards, 0)[-1] >= axis.total)
        maybe = smallest(low, sure, lambda c: walk(axis, c, shards, 1)[-1] >= axis.total)
        if sure == maybe:
            return sure
        low, high = maybe, sure
        for a, b in zip([0, *walk(axis, maybe, shards, 0)], [0, *walk(axis, sure, shards, 1)]):
            axis.ask(min(a + maybe, axis.total), min(b + sure, axis.total))
        axis.refine()


def cuts(axis: Skeleton, capacity: int, shards: int) -> list[int]:
    """Offsets where shards 1, 2, ... begin: as near to even shares as the capacity allows."""
    while True:
        least = [axis.total]  # the first offset from which the rest still fits in so many shards
        for _ in range(shards - 1):
            x = max(0, least[-1] - capacity)
            a, b = axis.above(x)
            if a < b:
                axis.ask(x)
            least.append(b)
        least.reverse()
        out, at = [], 0
        for j in range(shards - 1):
            even = at + (axis.total - at) // (shards - j)
            most = min(at + capacity, axis.total)
            for x in (even, most):
                if len(set(axis.below(x))) > 1:
                    axis.ask(x)
            if len(set(axis.above(even))) > 1:
                axis.ask(even)
            low, high, last = axis.below(even)[0], axis.above(even)[1], axis.below(most)[0]
            near = low if even - low <= high - even else high
            at = max(at, min(last, max(near, least[j])))
            out.append(at)
        if not axis.refine():
            return out


def placed_groups(rows: DataFrame, shards: int = 16, cells: int = CELLS) -> DataFrame:
    """(digest, shard, start) of each group of ``rows`` (as ``sized`` makes them)."""
    groups = stage(groups_of(rows), "shard-sums")
    # A group of more than an even share stands alone; there are fewer than ``shards`` of them.
    top = groups.orderBy(F.col("bytes").desc(), F.col("first"), F.col("digest")).limit(shards).collect()
    left, alone = groups.agg(F.sum("bytes")).first()[0] or 0, []
    while len(alone) < min(shards - 1, len(top)) and top[len(alone)].bytes * (shards - len(alone)) > left:
        left -= top[len(alone)].bytes
        alone.append(bytes(top[len(alone)].digest))
    rest = groups.where(~F.col("digest").isin(alone)) if alone else groups
    free = shards - len(alone)
    placed = stage(offsets(rest), "shard-offsets")
    begins = []
    if left:
        axis = Skeleton(placed, left, cells)
        begins = cuts(axis, smallest_capacity(axis, top[len(alone)].bytes, free), free)
    shard = F.lit(0)
    for at in begins:
        shard = shard + F.when(F.col("start") >= at, 1).otherwise(0)
    out = placed.select("digest", shard.cast("int").alias("shard"), "start")
    if alone:
        own = F.array_position(F.array(*[F.lit(d) for d in alone]), F.col("digest"))
        out = out.unionAll(groups.where(F.col("digest").isin(alone))
                           .select("digest", (own + F.lit(free - 1)).cast("int").alias("shard"), F.lit(0).cast("long").alias("start")))
    return out


def assign(docs: DataFrame, shards: int = 16, cells: int = CELLS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (from 0 in each shard, in the order of the groups, then doc_id)."""
    rows = stage(sized(docs), "shard-rows")
    placed = rows.join(placed_groups(rows, shards, cells), "digest")
    out = ranked(placed, ["shard"], [F.col("start"), F.col("doc_id")], "shard-slots")
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - 1).alias("slot"))


def write(docs: DataFrame, path: str, shards: int = 16) -> None:
    """Write whole documents as Parquet below ``path``, a folder per shard, each file a range of its order."""
    rows = docs.withColumn("_digest", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    placed = placed_groups(stage(sized(docs), "shard-rows"), shards).select(
        F.col("digest").alias("_digest"), F.col("shard").alias("_shard"), F.col("start").alias("_start"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["_shard", "_start", "doc_id"]
    (rows.join(placed, "_digest").repartitionByRange(parts, *order).sortWithinPartitions(*order)
     .withColumn("shard", F.col("_shard")).drop("_digest", "_start", "_shard").write.mode("overwrite").partitionBy("shard").parquet(path))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 15 of near-equal bytes, equal texts together."""
    return assign(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
