"""Operator 2: minimax contiguous sharding of atomic groups.

Groups of equal texts stand in one order: those heavier than an equal share first, heaviest first, then all others by a
60-bit hash of their text. A heavy group is a shard of its own. For the others, the smallest shard capacity for which a
greedy walk needs no more shards than there are is found by binary search. Under that capacity every cut goes to the end
of a group nearest to equal shares, so that the least load is raised too and no shard is left empty.

The group sizes stay distributed: the driver sees sums over intervals of the hash, splits only the intervals in which a
cut still in question would fall, and asks again, so it never holds more than a few thousand sums whatever the table's
size.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

KEY_BITS, FIRST_BITS, STEP_BITS = 60, 12, 6
OVERHEAD = 16


class _Spans:
    """Ascending intervals of the key that cover all groups, as (low, high, bytes, largest group, is one group, bits)."""

    def __init__(self, rows: list[tuple]):
        self.rows = sorted(rows)
        self.start = [0, *accumulate(r[2] for r in self.rows)]
        self.total = self.start[-1]

    def walk(self, capacity: int, shards: int, hopeful: bool) -> tuple[bool, list[int], set[int]]:
        """(do `shards` shards suffice, position of each cut, intervals cut inside).

        Where a shard fills up inside an interval of several groups, the hopeful walk cuts right there and the other
        one before the interval: the true walk lies between the two.
        """
        at, cuts, inside = 0, [], set()
        for _ in range(shards):
            end = at + capacity
            if end >= self.total:
                return True, cuts, inside
            k = bisect_right(self.start, end) - 1
            if self.start[k] != end and not self.rows[k][4]:
                inside.add(k)
            if self.start[k] == end or self.rows[k][4] or not hopeful:
                end = self.start[k]
            if end <= at:
                break
            at = end
            cuts.append(at)
        return False, cuts, inside

    def least(self, low: int, shards: int, hopeful: bool) -> int:
        high = self.total
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if self.walk(mid, shards, hopeful)[0] else (mid + 1, high)
        return low

    def even(self, capacity: int, shards: int) -> tuple[list[int], set[int]]:
        """(cuts nearest to equal shares with no shard above the capacity, intervals that a cut or a bound falls inside)."""
        inside: set[int] = set()

        def end_of(x: float, up: bool) -> int:
            """The end of a group at x, or the next one above or below."""
            k = bisect_right(self.start, x) - 1
            if k >= len(self.rows) or self.start[k] == x:
                return self.start[min(k, len(self.rows))]
            if not self.rows[k][4]:
                inside.add(k)
            return self.start[k + 1] if up else self.start[k]

        # the least position of each cut from which the rest still fits
        first, at = [0] * shards, self.total
        for k in range(shards - 1, 0, -1):
            at = end_of(max(0, at - capacity), True)
            first[k] = at
        cuts, at = [], 0
        for k in range(1, shards):
            target = self.total * k / shards
            low, high = end_of(target, False), end_of(target, True)
            near = low if target - low <= high - target else high
            most = end_of(min(self.total, at + capacity), False)
            at = min(max(near, first[k]), max(most, at))
            cuts.append(at)
        return cuts, inside


def _sums(groups: DataFrame, within: dict[int, list[int]]) -> list[tuple]:
    """The sums of finer intervals: all of 2**(KEY_BITS - FIRST_BITS) keys, or those in the intervals that `within` names by their bits. One job in either case."""
    if not within:
        bits, span = F.lit(FIRST_BITS), F.shiftright("key", KEY_BITS - FIRST_BITS)
    else:
        bits = span = F.lit(None)
        for own, spans in within.items():
            inside, finer = F.shiftright("key", KEY_BITS - own).isin(spans), min(KEY_BITS, own + STEP_BITS)
            bits, span = F.when(inside, finer).otherwise(bits), F.when(inside, F.shiftright("key", KEY_BITS - finer)).otherwise(span)
    rows = groups.select("key", "bytes", bits.cast("int").alias("bits"), span.cast("long").alias("span")).filter("bits is not null")
    rows = rows.groupBy("bits", "span").agg(F.min("key"), F.max("key"), F.sum("bytes"), F.max("bytes"), F.count("*"))
    return [(r[2], r[3], r[4], r[5], r[6] == 1, r[0]) for r in rows.collect()]  # 2**FIRST_BITS sums, then 2**STEP_BITS for each interval looked into


def _split(groups: DataFrame, spans: _Spans, which: set[int]) -> _Spans:
    """The intervals with some of them looked into."""
    coarse: dict[int, list[int]] = {}
    for k in sorted(which):
        coarse.setdefault(spans.rows[k][5], []).append(spans.rows[k][0] >> (KEY_BITS - spans.rows[k][5]))
    return _Spans([r for k, r in enumerate(spans.rows) if k not in which] + _sums(groups, coarse))


def minimax_cuts(groups: DataFrame, shards: int, most: int = 2048) -> tuple[int, list[int]]:
    """(smallest capacity, last key of every shard but the final one) for groups (key, bytes) in key order, none of them heavier than an equal share."""
    rows = _sums(groups, {})
    if not rows:
        return 0, []
    spans, largest, capacity = _Spans(rows), max(r[3] for r in rows), None
    while capacity is None:
        first = spans.least(max(largest, -(-spans.total // shards)), shards, True)  # no smaller capacity can do
        _, cuts, inside = spans.walk(first, shards, True)
        if not inside:  # the hopeful walk is the true one
            capacity = first
            break
        sure = spans.least(first, shards, False)  # this capacity does, wherever the groups end
        low, high = spans.walk(first, shards, False)[1], spans.walk(sure, shards, True)[1]
        low += low[-1:] * (len(high) - len(low)) if low else [0] * len(high)
        between = {k for a, b in zip(low, high) for k in range(max(0, bisect_right(spans.start, a) - 1), min(len(spans.rows), bisect_right(spans.start, b)))}  # noqa: B905
        between = {k for k in between if not spans.rows[k][4]}
        _, even = spans.even(sure, shards)  # most of these are asked for in the end
        spans = _split(groups, spans, (inside | between | even) if len(between) <= most else inside | even)
    while True:
        cuts, inside = spans.even(capacity, shards)
        if not inside:
            return capacity, [spans.rows[bisect_left(spans.start, c)][0] - 1 if c < spans.total else spans.rows[-1][1] for c in cuts]
        spans = _split(groups, spans, inside)


def heavy_groups(groups: DataFrame, shards: int) -> list[int]:
    """Keys of the groups that get a shard of their own, heaviest first: fewer than `shards`.

    A group heavier than an equal share of what it and all lighter groups weigh is one; the shares of the others are
    then worked out anew. Only groups above an equal share of the rest are looked at, fewer than there are shards.
    """
    alone: list[int] = []
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = groups.orderBy(F.desc("bytes"), "key").limit(shards - 1).collect() if shards > 1 else []  # the heaviest ones, one a shard
    for r in large:
        if r.bytes * (shards - len(alone)) <= total:
            break
        alone.append(r.key)
        total -= r.bytes
    return alone


def text_key(doc_id: Column, text: Column) -> Column:
    """60 bits; equal texts have equal keys. A null text stands alone, by its id."""
    return F.shiftrightunsigned(F.when(text.isNull(), F.xxhash64(F.lit("null"), doc_id)).otherwise(F.xxhash64(text)), 64 - KEY_BITS)


def shard_documents(docs: DataFrame, shards: int = 40, part_rows: int = 50_000) -> DataFrame:
    """Put every row into a shard so that the shards' bytes are near equal and equal texts share a shard.

    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null under this law), group_key.
    Size is the text's UTF-8 bytes (null: none) plus 16. A null text has the CRC of the empty text and is a group of
    its own (by doc_id). Rows that repeat are placed as often as they occur, in one shard. A group of copies larger
    than an equal share has a shard of its own and the others share the rest evenly; no shard is empty if there are at
    least as many groups as shards. Slots run from 0 without gaps in each shard, by a hash of the row, then doc_id and
    CRC; a null or repeated doc_id is nothing special. An empty table gives an empty result; other columns are ignored.
    """
    text = F.col("text").cast("binary")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        text_key(F.col("doc_id"), F.col("text")).alias("group_key"),
    )
    columns = ["doc_id", "size", "text_crc32", "group_key"]
    rows = cut(rows.groupBy(*columns).agg(F.count("*").alias("times")), "sizes")  # rows that repeat are one with their count
    groups = cut(rows.groupBy(F.col("group_key").alias("key")).agg(F.sum(F.col("size") * F.col("times")).alias("bytes")), "groups")
    alone = heavy_groups(groups, shards)
    cuts = minimax_cuts(groups.filter(~F.col("key").isin(alone)) if alone else groups, shards - len(alone))[1]
    shard = F.lit(len(alone))
    if cuts:
        bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
        shard = shard + F.size(F.filter(bounds, lambda c: c < F.col("group_key")))
    for k, key in enumerate(alone):
        shard = F.when(F.col("group_key") == key, k).otherwise(shard)
    rows = rows.withColumn("shard", shard.cast("int"))

    parts = max(64, rows.count() // (shards * part_rows))  # a shard's rows are numbered in parts, so no task takes a whole shard
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(*columns), F.lit(parts)))
    sizes = rows.groupBy("shard", "_part").agg(F.sum("times").alias("_n"))
    sizes = cut(sizes.select("shard", "_part", (F.sum("_n").over(Window.partitionBy("shard").orderBy("_part")) - F.col("_n")).alias("_before")), "parts")
    own = Window.partitionBy("shard", "_part").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "group_key", "size").rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumn("_first", F.sum("times").over(own) - F.col("times")).join(sizes, ["shard", "_part"])
    first = F.col("_before") + F.col("_first")
    slot = F.explode(F.sequence(first.cast("long"), (first + F.col("times") - 1).cast("long")))
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "group_key")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
