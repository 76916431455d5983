"""I-Match fingerprints with several randomised lexicons.

A document's terms are its words whose inverse document frequency lies in a band. Each lexicon keeps a random share of
all terms; a document's distinct terms in it are sorted and hashed. The fingerprint is the list of these hashes. Lexicons
keep shares from a half down to 1/1024, so that likeness falls by degrees: of two texts that differ in k terms, a lexicon
with share p agrees with a chance of (1 - p)^k.

Document frequencies cover the whole corpus and are exact for each 64-bit hash of a term. A task sums up what it has read in
a map of bounded size, so a term is shuffled once per task or map. The terms in the band are written. Up to
BROADCAST_TERMS of them go to every executor as sorted hashes, 8 bytes each. A larger band stays where it is: the texts'
terms are dealt out by key to meet it, and what was found comes back to each text. Both ways give the same fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import map_arrow, settle, slices, utf8
from kerbline.llm.shingles import distinct, mix, words

#: Frequencies are counted by so many leading bits of a term's hash: all of them.
SLOT_BITS = 64
#: Terms that a task holds counts of before it hands them on; 2^20 take 16 MB, and three times that while they are merged.
HELD_TERMS = 1 << 20
#: Leading bits of a term's hash by which counts are dealt: a row of the shuffle has a task's counts of one range.
RANGE_BITS = 12
#: Terms in more than this share of all documents, or in a single one, say nothing.
MOST_SHARE, LEAST_DOCUMENTS = 0.2, 2
#: Terms in the band up to which they are sent out whole, 64 MB.
BROADCAST_TERMS = 8 << 20
#: Lexicons: for each power of two from 1 to POWERS, so many keep a share of 2^-power.
POWERS, EACH = 10, 6
LEXICONS = POWERS * EACH
#: Hexadecimal digits of a lexicon's hash. A lexicon without any of the text's terms shows dots.
DIGITS = 6
_NOTHING = "." * DIGITS

_SEEDS = mix(np.arange(1, EACH + 1, dtype=np.uint64))
#: A 64-bit hash has a field of its own for each power, as 1 + 2 + ... + 10 = 55; a term is kept where the field is 0.
_FIELDS = [(np.uint64(p * (p - 1) // 2), np.uint64((1 << p) - 1)) for p in range(1, POWERS + 1)]


def _summed(terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms in order, and the sum of each one's counts."""
    order = np.argsort(terms)
    terms = terms[order]
    first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    return terms[first], np.add.reduceat(counts[order], first)


def _packed(terms: np.ndarray, counts: np.ndarray) -> bytes:
    """Terms in order and their counts. The steps from term to term and the counts are parted into planes of equal bytes,
    so that those that are zero take next to nothing in the shuffle."""
    steps = np.diff(terms, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    return np.concatenate([steps, counts.astype(np.uint32).view(np.uint8).reshape(-1, 4)], 1).T.tobytes()


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(raw, np.uint8).reshape(12, -1).T
    steps, counts = (np.ascontiguousarray(part) for part in (rows[:, :8], rows[:, 8:]))
    return np.cumsum(steps.view(np.uint64).ravel()), counts.view(np.uint32).ravel().astype(np.int64)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """term (its hash as a signed number) and the number of documents that have it. Every task counts its documents before
    anything is shuffled."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                terms, edges = words(*utf8(part.column("text")))
                if not len(terms):
                    continue
                own = np.concatenate([distinct(terms[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()) if a < b])
                own.sort()
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                held.append((own[first], np.diff(first, append=len(own))))
                size += len(first)
                if size > HELD_TERMS:
                    held = [_summed(*map(np.concatenate, zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD_TERMS // 2:
                        yield from held
                        held, size = [], 0
        if held:
            yield _summed(*map(np.concatenate, zip(*held)))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for terms, n in counts(batches):
            place = (terms >> np.uint64(64 - RANGE_BITS)).astype(np.int32)
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            ends = np.append(first[1:], len(terms))
            for at in range(0, len(first), 256):
                own = range(at, min(at + 256, len(first)))
                packed = [_packed(terms[first[k] : ends[k]], n[first[k] : ends[k]]) for k in own]
                columns = [pa.array(place[first[at : at + 256]]), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["range", "packed"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("range", "packed"))))
        for _, own in groupby(rows, key=lambda r: r[0]):
            terms, n = _summed(*map(np.concatenate, zip(*(_unpacked(raw) for _, raw in own))))
            yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], names=["term", "documents"])

    ranges = map_arrow(docs.select("text"), dealt, "range int, packed binary").repartition("range")
    return map_arrow(ranges.sortWithinPartitions("range"), summed, "term long, documents long")


class Band:
    """Tells which terms are among the kept ones. A map of leading bits, eight times as many as terms, turns most others
    away before they are searched."""

    def __init__(self, kept: np.ndarray):
        self.kept = kept
        self.shift = np.uint64(64 - min(27, max(16, 8 * len(kept)).bit_length()))
        self.near = np.zeros(1 << (64 - int(self.shift)), bool)
        self.near[kept >> self.shift] = True

    def holds(self, terms: np.ndarray) -> np.ndarray:
        found = self.near[terms >> self.shift]
        at = np.flatnonzero(found)
        if len(at):
            own = terms[at]
            place = np.searchsorted(self.kept, own)
            found[at] = self.kept[np.minimum(place, len(self.kept) - 1)] == own
        return found


@dataclass(frozen=True)
class Lexicon:
    """The sorted hashes of the terms in the band, sent to every executor once."""

    terms: Broadcast

    def band(self) -> Band:
        return Band(np.frombuffer(self.terms.value, np.uint64))


def _print_of(kept: np.ndarray) -> list[str]:
    """The hash of each lexicon's share of some sorted distinct terms."""
    spread = [mix(kept ^ seed) for seed in _SEEDS]
    hashes = []
    for place, field in _FIELDS:
        for own in spread:
            some = kept[(own >> place) & field == 0]
            hashes.append(hashlib.blake2b(some.tobytes(), digest_size=DIGITS // 2).hexdigest() if len(some) else _NOTHING)
    return hashes


def fingerprints(data: np.ndarray, offsets: np.ndarray, band: Band) -> list[list[str]]:
    """Per text the hash of each lexicon's distinct sorted terms. Of texts without a kept term all words count."""
    terms, edges = words(data, offsets)
    inside = band.holds(terms)
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        own = terms[a:b]
        kept = distinct(own[inside[a:b]])
        out.append(_print_of(kept if len(kept) else distinct(own)))
    return out


def likeness(left: list[str], right: list[str]) -> float:
    """How alike two fingerprints are, from 0 to 1; equal ones are alike at 1.

    It is the largest share of agreeing lexicons within two neighbouring powers, of those in which either text has terms:
    lexicons with many terms tell near texts apart, those with few show that far ones have something in common. Powers in
    which less than half of the lexicons hold a term don't count, unless none does better.
    """
    if left == right:
        return 1.0
    same = [a == b != _NOTHING for a, b in zip(left, right)]
    held = [a != _NOTHING or b != _NOTHING for a, b in zip(left, right)]
    found = []
    for at in range(0, LEXICONS - EACH, EACH):
        full = sum(held[at : at + 2 * EACH])
        if full >= EACH:
            found.append(sum(same[at : at + 2 * EACH]) / full)
    return max(found) if found else sum(same) / max(1, sum(held))


#: Sort key of a null doc_id, and ranges of doc_id per shuffle partition.
_NULL_ID = -(2**63)
RANGES = 2


def with_next(docs: DataFrame) -> DataFrame:
    """key, doc_id, text, part, extra: documents dealt into ranges of doc_id, each with the first document of the next.

    Within a part, sorted by extra, key and text, the following row is a document's next one; the last part is followed
    by the first document of all. Rows with `extra` are there to be next only. Bounds are doc_ids, so that the documents
    at a bound are the first of their part.
    """
    own = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    parts = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)]
    least, bounds = own.agg(F.min("key"), F.percentile_approx("key", shares, 100 * parts)).first()
    starts = sorted({least, *(bounds or [])} - {None})
    known = F.array(*(F.lit(b).cast("long") for b in starts))
    part = F.size(F.filter(known, lambda b: b <= F.col("key"))) - 1
    heads = own.filter(F.array_contains(known, F.col("key"))).groupBy("key", "doc_id").agg(F.min("text").alias("text"))
    before = F.pmod(part - 1, F.lit(max(1, len(starts))))
    return own.select("*", part.alias("part"), F.lit(0).alias("extra")).unionByName(
        heads.select("*", before.alias("part"), F.lit(1).alias("extra"))
    )


_NAMES = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_RESULT = (
    "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _half_replaced(text: str, after: str) -> str:
    """The text with its last half replaced by as much of the next one's start."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _with_lexicon(dealt: DataFrame, found: Lexicon) -> DataFrame:
    """The result where every executor has the band: one pass over the dealt documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band, last = found.band(), None
        for batch in batches:
            for part in slices(batch, "text"):
                prints = fingerprints(*utf8(part.column("text")), band)
                rows = zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "extra")), prints)
                edits, out = [], []
                for row in rows:
                    if last and not last[2]:
                        edits.append(_half_replaced(last[1], row[1]))
                        out.append((last[0], len(last[1]), last[3], likeness(last[3], row[3])))
                    last = row
                edited = pa.array(edits, pa.string())
                others = fingerprints(*utf8(edited), band)
                columns = [
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array([o[1] for o in out], pa.int64()),
                    edited,
                    pa.array(["".join(o[2]) for o in out], pa.string()),
                    pa.array(["".join(p) for p in others], pa.string()),
                    pa.array([likeness(o[2], p) for o, p in zip(out, others)], pa.float64()),
                    pa.array([o[3] for o in out], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    return map_arrow(dealt.select("doc_id", "text", "extra"), run, _RESULT)


def _texts_in_order(dealt: DataFrame) -> DataFrame:
    """row, next, doc_id, text and edited of every dealt row, written; next and edited are null for rows that are there to be
    next only. A row's number is that of its task and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = row = TaskContext.get().partitionId() << 40
        last = None
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for doc, text, extra in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "extra"))):
                    if last:
                        own = not last[2]
                        out.append((row - 1, row if own else None, *last[:2], _half_replaced(last[1], text) if own else None))
                    last, row = (doc, text, extra), row + 1
                yield from _rows(out)
        if row > first:
            yield from _rows([(row - 1, None, *last[:2], None)])

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
    names = ["row", "next", "doc_id", "text", "edited"]

    def _rows(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names=names)

    schema = "row long, next long, doc_id long, text string, edited string"
    return settle(map_arrow(dealt.select("doc_id", "text", "extra"), run, schema), "imatch-texts")


def _terms_of(texts: DataFrame, common: Broadcast) -> DataFrame:
    """row and term of every distinct term of a text that is not among the common ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skipped = np.frombuffer(common.value, np.uint64)
        for batch in batches:
            for part in slices(batch, "text"):
                terms, edges = words(*utf8(part.column("text")))
                own = [distinct(terms[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                rows = np.repeat(part.column("row").to_numpy(), [len(x) for x in own])
                flat = np.concatenate(own) if own else terms
                rare = ~np.isin(flat, skipped)
                columns = [pa.array(rows[rare], pa.int64()), pa.array(flat[rare].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "term"])

    return map_arrow(texts, run, "row long, term long")


def _printed(texts: DataFrame, kept: DataFrame, common: Broadcast) -> DataFrame:
    """row and print of some texts (row, text), by terms that meet the band by key. A task holds the distinct terms of one
    text at a time; a common term is no key, as texts leave it out."""
    met = _terms_of(texts, common).join(kept.select("term"), "term", "left_semi")
    lists = met.groupBy("row").agg(F.collect_list("term").alias("terms"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                terms, edges = words(*utf8(part.column("text")))
                found = []
                for place, own in enumerate(part.column("terms")):
                    if own.is_valid:
                        some = np.sort(own.values.to_numpy().view(np.uint64))
                    else:
                        some = distinct(terms[edges[place] : edges[place + 1]])
                    found.append("".join(_print_of(some)))
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(found, pa.string())], names=["row", "print"])

    return map_arrow(texts.join(lists, "row", "left").select("row", "text", "terms"), run, "row long, print string")


def _by_key(dealt: DataFrame, kept: DataFrame, common: Broadcast) -> DataFrame:
    """The result where the band is too large to be sent out."""
    texts = _texts_in_order(dealt)
    own = settle(_printed(texts.select("row", "text"), kept, common), "imatch-prints")
    edited = texts.filter("next IS NOT NULL").select("row", F.col("edited").alias("text"))
    edited = _printed(edited, kept, common).select("row", F.col("print").alias("edited_print"))
    after = own.select(F.col("row").alias("next"), F.col("print").alias("next_print"))
    rows = texts.filter("next IS NOT NULL").join(own, "row").join(edited, "row").join(after, "next")

    def split(text: str) -> list[str]:
        return [text[at : at + DIGITS] for at in range(0, len(text), DIGITS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, others, nexts = (list(map(split, batch.column(c).to_pylist())) for c in ("print", "edited_print", "next_print"))
            columns = [
                *(batch.column(c) for c in ("doc_id", "n_chars", "edited", "print", "edited_print")),
                pa.array(list(map(likeness, mine, others)), pa.float64()),
                pa.array(list(map(likeness, mine, nexts)), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    n_chars = F.char_length("text").cast("long").alias("n_chars")
    return map_arrow(rows.select("doc_id", n_chars, "edited", "print", "edited_print", "next_print"), run, _RESULT)


def fingerprint_with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited and near_next of every row of `docs`.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many of the next document's text,
    in order of doc_id (null first; of repeated doc_ids by text); the last document is followed by the first, a single
    one by itself. Null text counts as empty. A text without words has a fingerprint of its own kind, equal to that of
    any other such text. Further columns are left out. An empty table gives no rows.
    """
    most = max(2, int(MOST_SHARE * docs.count()))
    frequent = settle(document_frequencies(docs).filter(F.col("documents") >= LEAST_DOCUMENTS), "imatch-terms")
    kept = frequent.filter(F.col("documents") <= most)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = with_next(docs).repartition(partitions, "part").sortWithinPartitions("part", "extra", "key", "text")
    if kept.count() <= BROADCAST_TERMS:
        return _with_lexicon(dealt, _sent(kept))
    # At most 1 / MOST_SHARE times the distinct terms of a mean document.
    common = _hashes(frequent.filter(F.col("documents") > most))
    return _by_key(dealt, kept, docs.sparkSession.sparkContext.broadcast(common.tobytes()))


def _hashes(terms: DataFrame) -> np.ndarray:
    """Sorted hashes of a bounded list of terms."""
    return np.sort(terms.select("term").toArrow().column("term").to_numpy().view(np.uint64))


def _sent(kept: DataFrame) -> Lexicon:
    return Lexicon(kept.sparkSession.sparkContext.broadcast(_hashes(kept).tobytes()))
