"""Left joins to a table that is unique by key, when neither side's size nor the keys' spread is known."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup side with at most this many rows (tens of MB as a hash table) is sent to every executor.
BROADCAST_ROWS = 200_000

# Places are narrower: as many of these take the same room.
BROADCAST_PLACES = 500_000

# Bits of a sieve over the keys of a larger lookup side: at most a million words, some 50 MB as a hash table.
SIEVE_BITS = 1 << 26

# Keys treated on their own: at most this many, and only keys with at least this many rows. By counting, any other key
# then holds less than one row in HOT_KEYS, or fewer rows than HOT_ROWS.
HOT_KEYS = 10_000
HOT_ROWS = 10_000


def fits_broadcast(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Measure the table, reading at most one row past the bound."""
    return table.limit(max_rows + 1).count() <= max_rows


def heaviest(counted: DataFrame, count: str) -> DataFrame:
    """The hot rows of a table that has one row per key and its number of facts."""
    return counted.where(F.col(count) >= HOT_ROWS).orderBy(F.desc(count)).limit(HOT_KEYS)


def left_by_shuffle(facts: DataFrame, table: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """facts ⟕ table over a shuffle in which no key is hot.

    `hot` holds the table's rows for the hot keys; it is bounded and broadcast, so those facts find their match in
    place. They, and facts with a null key, still pass the shuffle, but without a key: they are dealt out by the
    number of their input partition, which a rerun of the task does not change. AQE could not split a hot key here,
    because the table side usually ends in an aggregate.
    """
    payload = [c for c in table.columns if c not in keys]
    near = hot.select(*keys, *[F.col(c).alias(f"_near_{c}") for c in payload], F.lit(True).alias("_found"))
    marked = facts.join(F.broadcast(near), list(keys), "left")
    settled = reduce(or_, [F.col(k).isNull() for k in keys], F.col("_found").isNotNull())
    dealt = marked.withColumns(
        {
            "_deal": F.when(settled, F.spark_partition_id()).otherwise(-1),
            **{f"_key_{k}": F.when(~settled, F.col(k)) for k in keys},
        }
    )
    far = table.select(
        F.lit(-1).alias("_deal"),
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.col(c).alias(f"_far_{c}") for c in payload],
    )
    joined = dealt.join(far, ["_deal", *[f"_key_{k}" for k in keys]], "left")
    return joined.select(*facts.columns, *[F.coalesce(f"_near_{c}", f"_far_{c}").alias(c) for c in payload])


def left_by_sieve(facts: DataFrame, table: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """facts ⟕ table, when few facts find a match: the others are not shuffled.

    One bit per hash of the table's keys is broadcast, whose size is bounded however large the table is. A fact whose bit
    is not set has no match and stays in place; the others, with what the hash lets through by chance, are joined by
    `left_by_shuffle`. Facts are read once for each of the two.
    """
    types = dict(facts.dtypes)

    def hashed(columns: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(SIEVE_BITS))

    def bit(place: Column) -> Column:
        return place.bitwiseAND(F.lit(63)).cast("int")

    place = hashed([F.col(k).try_cast(types[k]) for k in keys])
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit(place))
    words = table.groupBy(F.shiftright(place, 6).alias("_word")).agg(F.bit_or(one).alias("_bits"))
    own = hashed([F.col(k) for k in keys])
    marked = facts.withColumn("_word", F.shiftright(own, 6)).join(F.broadcast(words), "_word", "left")
    may = F.coalesce(F.getbit("_bits", bit(own)) == 1, F.lit(False))
    payload = [F.lit(None).cast(kind).alias(c) for c, kind in table.dtypes if c not in keys]
    apart = marked.where(~may).select(*facts.columns, *payload)
    return left_by_shuffle(marked.where(may).select(*facts.columns), table, keys, hot).unionByName(apart)


def left_lookup(facts: DataFrame, table: DataFrame, key: str, *, small: bool) -> DataFrame:
    """facts ⟕ table: broadcast when the table was found small, else by shuffle with the hot keys apart."""
    if small:
        return facts.join(F.broadcast(table), key, "left")
    counted = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_facts"))
    hot = table.join(F.broadcast(heaviest(counted, "_facts").select(key)), key, "left_semi")
    return left_by_shuffle(facts, table, [key], hot)
