"""Shards of near equal bytes: minimax partition of ordered groups of equal texts, in DataFrame operations only.

Groups of equal texts are atomic, ordered by their first document. The smallest capacity is searched with which a greedy
pass over the groups needs no more than the wanted number of shards. A greedy pass looks up, `shards` times, the last
group that ends within what the shard may hold; each look-up reads only the blocks of running sums that can hold the
answer. A round tries `PROBES` capacities at once, so 6 bits of the search are settled by `shards` small jobs.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbline.llm.common import carried, dealt_in_order, row_numbers, settle

PROBES = 63
#: Blocks of the running sums whose bounds the driver holds, whatever the number of groups.
BLOCKS = 4096


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1), text_crc32 and a digest by which equal texts meet; null counts as empty."""
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.unhex(F.sha2(raw, 256)).alias("digest"),
    )


def running_groups(sized: DataFrame) -> DataFrame:
    """One row per text, in order of the first doc_id (null first): digest and `before`, `upto`, the bytes before and with it.

    Sums run within range-split parts; one number per part is summed across them.
    """
    groups = sized.groupBy("digest").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes"))
    dealt = dealt_in_order(groups.withColumn("all", F.lit(0)), "all", "first", "digest")
    inside = Window.partitionBy("all", "_part").orderBy("first", "digest").rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumn("upto", F.sum("bytes").over(inside)).join(
        carried(dealt, "all", F.sum("bytes"), F.sum), ["all", "_part"]
    )
    upto = F.coalesce("_before", F.lit(0)) + F.col("upto")
    return settle(summed.select("digest", (upto - F.col("bytes")).alias("before"), upto.alias("upto")), "shard-sums")


class _Sums:
    """Look-ups in the running sums: the last group end that is at most a given number."""

    def __init__(self, groups: DataFrame):
        spark = groups.sparkSession
        self.total, self.largest = groups.agg(F.max("upto"), F.max(F.col("upto") - F.col("before"))).first()
        self.total, self.largest = self.total or 0, self.largest or 0
        self.width = max(1, -(-self.total // BLOCKS))
        block = F.floor(F.col("upto") / F.lit(self.width)).cast("long")
        ends = groups.select("upto", block.alias("block")).repartitionByRange("block").sortWithinPartitions("block")
        self.ends, self.spark = settle(ends, "shard-ends"), spark
        bounds = self.ends.groupBy("block").agg(F.min("upto").alias("least")).collect()  # BLOCKS + 1 rows at most
        self.blocks = sorted((row.least, row.block) for row in bounds)
        self.leasts = [least for least, _ in self.blocks]

    def last_ends(self, limits: list[int]) -> list[int]:
        """For each limit the largest group end up to it, 0 if there is none."""
        asked, found = {}, {}
        for limit in sorted(set(limits)):
            at = bisect_right(self.leasts, limit) - 1
            if at < 0:
                found[limit] = 0
            elif limit >= self.total:
                found[limit] = self.total
            else:
                asked[limit] = self.blocks[at][1]
        if asked:
            rows = ", ".join(f"({limit}L, {block}L)" for limit, block in asked.items())
            ask = self.spark.sql(f"SELECT * FROM VALUES {rows} AS asked(`limit`, block)")
            near = self.ends.filter(F.col("block").isin(sorted(set(asked.values()))))
            rows = near.join(F.broadcast(ask), "block").filter(F.col("upto") <= F.col("limit")).groupBy("limit").agg(F.max("upto")).collect()
            found |= {row[0]: row[1] for row in rows}
        return [found[limit] for limit in limits]


def cuts(sums: _Sums, shards: int) -> list[int]:
    """Ends of the first shards - 1 shards under the smallest capacity that suffices."""

    def greedy(capacities: list[int]) -> list[list[int]]:
        ends = [[0] for _ in capacities]
        for _ in range(shards):
            for own, end in zip(ends, sums.last_ends([own[-1] + c for own, c in zip(ends, capacities)])):
                own.append(end)
        return ends

    low = max(sums.largest, -(-sums.total // shards))  # no capacity below can do
    high = min(sums.total, -(-sums.total // shards) + sums.largest)  # this one always does
    while low < high:
        step = max(1, -(-(high - low) // (PROBES + 1)))
        tried = list(range(low, high, step))
        fits = [capacity for capacity, ends in zip(tried, greedy(tried)) if ends[-1] == sums.total]
        if fits:
            high = fits[0]
        low = max([low, *(capacity + 1 for capacity in tried if capacity < high)])
    return greedy([high])[0][1:shards]


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law (`bytes`), shard, slot (gapless from 0 in each shard) and grown_shard (null).

    The largest shard is as small as any contiguous cut allows that keeps equal texts together. Null text counts as
    empty, a null doc_id comes first, repeated rows are rows of their own, further columns are left out. An empty table
    gives no rows. Where one text outweighs a shard's share, it has a shard to itself, or shares it with neighbours.
    """
    sized = settle(measured(docs), "shard-sizes")
    groups = running_groups(sized)
    ends = cuts(_Sums(groups), shards)
    number = sum(((F.col("before") >= end).cast("int") for end in ends), F.lit(0))
    placed = sized.join(groups.select("digest", number.alias("shard")), "digest").drop("digest")
    return row_numbers(placed, "shard", "doc_id", "text_crc32", "size").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("_number").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
