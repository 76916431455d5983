"""Exact duplicates by MSD radix partitioning, without a digest deciding equality.

Documents are split by the length of their normalised text, then by successive digits of its bytes. A digit is a run of
bytes, 16 times as long in each round, so the number of rounds grows with the logarithm of the longest text. A group
leaves when it has one member, or when its text has ended: its members are then equal byte by byte. Only groups with
several members are written on, with what is left of their texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.llm.common import SPACES, broadcast_if_small, free_name, settle

FIRST_DIGIT = 32
DIGIT_GROWTH = 16


def normalised(text: Column) -> Column:
    """The text without white space, as bytes; null counts as empty."""
    kept = F.coalesce(text, F.lit(""))
    for space in SPACES:
        kept = F.replace(kept, F.lit(space), F.lit(""))
    return F.encode(kept, "UTF-8")


def _repeated(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Keys that several rows have, pre-aggregated next to the scan; broadcast if they are counted to be few."""
    again = rows.groupBy(*keys).agg(F.min("row").alias("group"), F.count("*").alias("members")).filter("members > 1")
    return broadcast_if_small(settle(again, "radix-groups"), width + 64)


def classes(docs: DataFrame) -> DataFrame:
    """Every row of `docs` as row, doc_id, n_chars, text_sha256 and group: rows with equal texts have the same group.

    `row` numbers rows, so null or repeated doc_ids are no trouble; the digest is output only.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(text).cast("long").alias("n_chars"),
        normalised(F.col("text")).alias("_bytes"),
    )
    size, head = F.octet_length("_bytes").alias("size"), F.substring("_bytes", 1, FIRST_DIGIT).alias("digit")
    heads = read.select(size, head).groupBy("size", "digit").agg(F.count("*").alias("members")).filter("members > 1")
    heads = broadcast_if_small(settle(heads, "radix-heads"), FIRST_DIGIT + 64)
    split = read.select("doc_id", "n_chars", F.sha2("_bytes", 256).alias("text_sha256"), size, head, "_bytes")
    rest = F.expr(f"CASE WHEN members > 1 THEN substring(_bytes, {FIRST_DIGIT + 1}) END").alias("rest")
    rows = split.join(heads, ["size", "digit"], "left").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", "text_sha256", "size", "digit", "members", rest
    )
    rows = settle(rows, "radix-rows")
    own = ["row", "doc_id", "n_chars", "text_sha256"]
    done = [rows.filter("members IS NULL").select(*own, F.col("row").alias("group"))]
    open_ = rows.filter("members > 1").select(*own, "size", "digit", "rest")
    keys, taken, digit = ["size", "digit"], FIRST_DIGIT, FIRST_DIGIT
    while True:
        # Members of a group share all bytes that were taken; where the text ends there, they are equal.
        met = open_.join(_repeated(open_, keys, digit), keys, "left")
        digit *= DIGIT_GROWTH
        ended = F.col("members").isNull() | (F.col("size") <= taken)
        step = met.select(
            *own,
            "size",
            F.coalesce("group", "row").alias("group"),
            ended.alias("ended"),
            F.substring("rest", 1, digit).alias("digit"),
            F.expr(f"substring(rest, {digit + 1})").alias("rest"),
        )
        step = settle(step, "radix-rows")
        done.append(step.filter("ended").select(*own, "group"))
        open_ = step.filter("NOT ended").select(*own, "size", F.col("group").alias("prefix"), "digit", "rest")
        keys, taken = ["prefix", "digit"], taken + digit
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done)


def duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of `docs` (columns doc_id and text).

    Of equal texts the row with the most code points stays, then the smallest doc_id (null last). Of repeated rows with
    the same doc_id one stays. Null text counts as empty; empty texts equal each other. Further columns are left out.
    """
    rows = classes(docs)
    best = F.struct(-F.col("n_chars"), F.coalesce("doc_id", F.lit(2**63 - 1)), "row", "doc_id")
    stay = settle(
        rows.groupBy("group").agg(F.min(best).alias("best"), F.count("*").alias("group_size")).filter("group_size > 1"),
        "radix-stay",
    ).select("group", F.col("best.row").alias("keep_row"), F.col("best.doc_id").alias("keep_id"), "group_size")
    met = rows.join(broadcast_if_small(stay, 64), "group", "left")
    alone = F.col("group_size").isNull()
    return met.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that stay: one of each group of equal texts, chosen as in `duplicates`.

    Rows are known by doc_id (null or not) and the digest of their normalised text; of repeated rows one stays.
    """
    known = ["doc_id", "text_sha256"]
    found = duplicates(docs).groupBy(*known).agg(F.count("*").alias("rows"), F.max("kept").alias("stays"))
    some = settle(found.filter("NOT stays OR rows > 1"), "radix-gone")
    names = {c: free_name(docs, f"_{c}") for c in known}
    digest, nth = free_name(docs, "_digest"), free_name(docs, "_nth")
    own = [F.col(c).alias(names[c]) for c in known]
    gone = broadcast_if_small(some.filter("NOT stays").select(*own), 96)
    again = broadcast_if_small(some.filter("stays").select(*own), 96)
    rows = docs.withColumn(digest, F.sha2(normalised(F.col("text")), 256))

    def of(keys: DataFrame) -> Column:
        return rows["doc_id"].cast("long").eqNullSafe(keys[names["doc_id"]]) & (rows[digest] == keys[names["text_sha256"]])

    left, columns = rows.join(gone, of(gone), "left_anti"), [f"`{c}`" for c in docs.columns]
    if again.isEmpty():
        return left.select(*columns)
    best = Window.partitionBy("doc_id", digest).orderBy(F.char_length("text").desc_nulls_last())
    repeated = rows.join(again, of(again), "left_semi").withColumn(nth, F.row_number().over(best)).filter(F.col(nth) == 1)
    single = left.join(again, of(again), "left_anti")
    return single.select(*columns).unionByName(repeated.select(*columns))
