"""Near duplicates: banded MinHash, odd sketches, exact confirmation.

1. Texts with the same shingle set are one node. Each node gets MinHash samples, folded into band keys and into an odd
   sketch: a bitmap in which every sample flips one bit. Two sketches' XOR population count estimates how many samples
   differ, so it estimates a high similarity precisely. A second odd sketch folds the set itself; its XOR count is never
   more than the number of shingles that only one side has, so it refutes pairs without any loss.
2. In each bucket of a band all nodes are held against one of them. Pairs that the sketches allow are confirmed on full
   sets. Confirmed links make components.
3. Buckets that still hold several components are searched through in blocks of bounded size: a block hands on just
   enough of the allowed pairs to join its components. When these are confirmed, a last search hands on every allowed
   pair between different components. So a group of near copies costs links in proportion to its size, and still no
   link between components that shares a bucket is missed.

As many bands of 5 samples are made as it takes for a pair just at the threshold to share no bucket with a chance under
1e-6 (24 at 0.85, 35 at 0.8); more similar pairs miss more rarely. The sample sketch refutes a true link with a chance
below 1e-6. All else is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import broadcast_if_small, map_arrow, settle, ship, slices, utf8
from kerbline.llm.components import components
from kerbline.llm.shingles import distinct, mix, shingles, words

#: MinHash samples of a band, and the chance that a link at the threshold shares no band.
ROWS, MISS = 5, 1e-6
#: Bits of the sketch of the samples and of that of the whole set.
SAMPLE_BITS, SET_BITS = 256, 2048
#: Nodes of a block in a bucket.
BLOCK = 512


class MinHash:
    """Samples and band keys for links at `percent`."""

    def __init__(self, percent: int):
        self.percent = percent
        self.bands = int(np.ceil(np.log(MISS) / np.log1p(-((percent / 100) ** ROWS))))
        self.samples = self.bands * ROWS
        rng = np.random.default_rng(85)
        self._xor = rng.integers(0, 1 << 32, self.samples, np.uint32)
        self._odd = rng.integers(0, 1 << 31, self.samples, np.uint32) * np.uint32(2) + np.uint32(1)
        self._place = np.arange(self.samples, dtype=np.uint64) << np.uint64(32)

    def of(self, shingle_set: np.ndarray) -> np.ndarray:
        """One least value per sample; long sets go in runs so that memory stays bounded."""
        low = np.full(self.samples, 0xFFFFFFFF, np.uint32)
        values = (shingle_set >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(values), 2048):
            x = (values[at : at + 2048, None] ^ self._xor) * self._odd
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            np.minimum(low, x.min(axis=0), out=low)
        return low

    def band_keys(self, samples: np.ndarray) -> np.ndarray:
        keys = mix(np.arange(1, self.bands + 1, dtype=np.uint64))
        for row in range(ROWS):
            keys = mix(keys + samples[row::ROWS].astype(np.uint64))
        return keys.view(np.int64)

    def sketch(self, samples: np.ndarray) -> np.ndarray:
        return odd_sketch(mix(samples.astype(np.uint64) + self._place), SAMPLE_BITS)

    def most_bits(self) -> int:
        """Most differing bits that the sample sketches of a link may show: 5 standard deviations of the number of samples
        that differ, then 3 of the number of bits that these flip."""
        share = 1 - self.percent / 100
        differ = self.samples * share + 5 * (self.samples * share * (1 - share)) ** 0.5
        odd = (1 - np.exp(-4 * differ / SAMPLE_BITS)) / 2
        return int(np.ceil(SAMPLE_BITS * odd + 3 * (SAMPLE_BITS * odd * (1 - odd)) ** 0.5))


def odd_sketch(values: np.ndarray, bits: int) -> np.ndarray:
    """Bits that an odd number of the values fall on, as bytes."""
    return np.packbits(np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1)


def most_differing(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that just one of two linked sets of n and m may have: 100 * |A & B| >= percent * |A | B|."""
    return (100 - percent) * (n + m) // (100 + percent)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingles of each text that has words."""
    found, edges = shingles(*words(*utf8(batch.column("text"))), size)
    for row, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if a < b:
            yield row, distinct(found[a:b])


def _key(shingle_set: np.ndarray) -> bytes:
    return hashlib.blake2b(shingle_set.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, set_key, bands, sample_sketch and set_sketch of every row; null but for the count without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(percent)
        for batch in batches:
            for part in slices(batch, "text"):
                counts = [0] * part.num_rows
                keys, bands, sampled, whole = ([None] * part.num_rows for _ in range(4))
                for row, found in _sets(part, size):
                    samples = minhash.of(found)
                    counts[row], keys[row], bands[row] = len(found), _key(found), minhash.band_keys(samples)
                    sampled[row] = minhash.sketch(samples).tobytes()
                    whole[row] = odd_sketch(found, SET_BITS).tobytes()
                kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip((counts, keys, bands, sampled, whole), kinds)]
                names = ["doc_id", "n_shingles", "set_key", "bands", "sample_sketch", "set_sketch"]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)

    schema = "doc_id long, n_shingles long, set_key binary, bands array<long>, sample_sketch binary, set_sketch binary"
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def shingle_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """set_key and the set (sorted 64-bit hashes) of the texts whose doc_id is in `wanted`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [(_key(s), s.tobytes()) for _, s in _sets(part, size)]
                columns = [pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["set_key", "set"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    met = own.join(wanted, own["doc_id"].eqNullSafe(wanted["wanted_id"]), "left_semi").select("text")
    return map_arrow(met, run, "set_key binary, set binary")


def _allowed(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of nodes that neither sketch refutes."""
    sketches = nodes.select("node", "n_shingles", "sample_sketch", "set_sketch")
    met = pairs
    for side in ("a", "b"):
        met = met.join(sketches.toDF(side, f"n_{side}", f"s_{side}", f"w_{side}"), side)
    limit = MinHash(percent).most_bits()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            differ = {k: _differing(*(_bitmap(batch.column(f"{k}_{side}")) for side in "ab")) for k in "sw"}
            keep = (differ["s"] <= limit) & (differ["w"] <= most_differing(n, m, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return map_arrow(met, run, "a long, b long")


def _bitmap(column: pa.Array) -> np.ndarray:
    """Sketches of equal length as rows of 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _differing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.bitwise_count(left ^ right).sum(axis=-1, dtype=np.int64)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    met = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(met, run, "a long, b long")


def _block_pairs(percent: int, every: bool) -> Callable:
    """The search through one pair of blocks of a bucket: `every` allowed pair of different components, or just enough."""
    limit = MinHash(percent).most_bits()

    def run(key: tuple, block: pa.Table) -> pa.Table:
        node, component, n, side = (block.column(c).to_numpy() for c in ("node", "component", "n_shingles", "side"))
        sampled, whole = (_bitmap(block.column(c).combine_chunks()) for c in ("sample_sketch", "set_sketch"))
        left = np.flatnonzero(side != 1)
        right = np.flatnonzero(side != 0)
        found: list[tuple[int, int]] = []
        label = np.unique(component, return_inverse=True)[1]
        for i in left.tolist():
            others = right[right > i] if key[1] == key[2] else right
            others = others[label[others] != label[i]]
            if not len(others):
                continue
            near = _differing(whole[others], whole[i]) <= most_differing(n[others], n[i], percent)
            others = others[near]
            others = others[_differing(sampled[others], sampled[i]) <= limit]
            for j in others.tolist():
                if every:
                    found.append((i, j))
                elif label[i] != label[j]:
                    found.append((i, j))
                    label[label == label[j]] = label[i]
        a = node[np.array([i for i, _ in found], np.int64)]
        b = node[np.array([j for _, j in found], np.int64)]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _across(members: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int, every: bool) -> DataFrame:
    """Allowed pairs of nodes that share a bucket and are in different components."""
    placed = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (
        placed.groupBy("bucket")
        .agg(F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("bucket", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    mixed = broadcast_if_small(settle(mixed, "near-mixed"), 32)
    block = F.pmod(F.hash("node"), "blocks")
    # A node of block k meets block j in the group (min(j, k), max(j, k)).
    dealt = placed.join(mixed, "bucket").withColumn("own", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    dealt = dealt.select(
        "bucket",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        "node",
        "component",
    ).join(nodes.select("node", "n_shingles", "sample_sketch", "set_sketch"), "node")
    ship(members.sparkSession)
    pairs = dealt.groupBy("bucket", "low", "high").applyInArrow(_block_pairs(percent, every), "a long, b long")
    return pairs.distinct()


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `docs` (columns doc_id and text).

    Two texts are linked if 100 * |A & B| >= percent * |A | B| of their sets of `size`-word shingles. component_id is
    the smallest doc_id that links lead to. A text with fewer words is one shingle; without words (or null) it is linked
    with nothing and its component is its own doc_id. Rows with a null doc_id take part and have their component's id;
    if no member has one, it is null and kept is false. Repeated rows are equal texts: each shows the same component.
    Further columns are left out. An empty table gives no rows.
    """
    signed = settle(signatures(docs, size, percent), "near-signatures")
    own = signed.select("doc_id", "n_shingles", "set_key")
    first = settle(own.filter("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("first_id")), "near-first")
    numbered = settle(first.select("*", F.monotonically_increasing_id().alias("node")), "near-numbers")
    # A set's row: that of its first doc_id; where ids repeat or are null, any of the rows, as all say the same.
    nodes = signed.join(numbered, "set_key").filter(F.col("doc_id").eqNullSafe(F.col("first_id")))
    nodes = settle(nodes.drop("doc_id").dropDuplicates(["node"]), "near-nodes")
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("members"), F.min("node").alias("pivot"))
    shared = broadcast_if_small(settle(shared.filter("members > 1").drop("members"), "near-buckets"), 32)
    members = settle(banded.join(shared, "bucket"), "near-members")
    wanted = members.select("node").distinct().join(nodes.select("node", "first_id"), "node")
    wanted = broadcast_if_small(settle(wanted.select(F.col("first_id").alias("wanted_id")).distinct(), "near-wanted"), 16)
    sets = shingle_sets(docs, wanted, size).join(nodes.select("set_key", "node"), "set_key").select("node", "set")
    sets = settle(sets.dropDuplicates(["node"]), "near-sets")

    pairs = members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = settle(_confirmed(_allowed(pairs, nodes, percent), sets, percent), "near-links")
    labels = components(links)
    for every in (False, True):
        pairs = settle(_across(members, labels, nodes, percent, every), "near-pairs")
        if pairs.isEmpty():
            break
        more = settle(_confirmed(pairs, sets, percent), "near-links")
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(links)
    named = nodes.select("node", "set_key", "first_id").join(labels, "node")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = named.join(settle(least, "near-least"), "component").select("set_key", "component_id")
    alone = first.withColumnRenamed("first_id", "alone_id")
    met = own.join(broadcast_if_small(settle(linked, "near-linked"), 64), "set_key", "left").join(
        broadcast_if_small(alone, 64), "set_key", "left"
    )
    component = F.coalesce("component_id", "alone_id", "doc_id")
    return met.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


def deduplicated(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, that stay: of each component the document with the smallest doc_id.

    Rows without a doc_id can't be named by a component; they stay, as do rows that share a doc_id with one that stays.
    """
    found = near_duplicates(docs, size=size, percent=percent).filter("NOT kept AND doc_id IS NOT NULL")
    gone = broadcast_if_small(settle(found.select(F.col("doc_id").alias("_gone")).distinct(), "near-gone"), 16)
    return docs.join(gone, F.col("doc_id").cast("long") == gone["_gone"], "left_anti")
