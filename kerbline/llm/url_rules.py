"""URL filters by a bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL (host, then path). All globs are packed one after another into 64-bit words;
a set bit says that the glob up to that token fits what has been read. One byte of input moves all globs at once:

    bits = ((bits << 1) & takes[byte]) | (bits & stays[byte])

Globs know `?` (one byte but `/`), `*` (any bytes but `/`) and `**` (any bytes).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.llm.common import free_name, lower_ascii, map_arrow, utf8


@dataclass(frozen=True)
class Rule:
    """A verdict for URLs that fit the glob. Of several rules the one with the longest name wins, then the first."""

    name: str
    glob: str
    verdict: str


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host with all its subdomains and for paths that start with `path`.

    The canonical URL has a dot before the host, so `*.host` is the host itself or a subdomain; `*` can't leave the host.
    """
    return Rule(host + path, f"*.{host}{path}**", verdict)


def _tokens(glob: str) -> Iterator[bytes | None]:
    """Bytes of the glob one by one; wildcards as `*`, `**` and None for `?`."""
    raw, at = glob.encode(), 0
    while at < len(raw):
        one = raw[at : at + 1]
        if one == b"*":
            star = b"**" if raw[at : at + 2] == b"**" else b"*"
            yield star
            at += len(star)
        else:
            yield None if one == b"?" else one
            at += 1


class Automaton:
    """All globs in one row of bits per URL."""

    def __init__(self, rules: Iterable[Rule]):
        self.rules = sorted(rules, key=lambda rule: -len(rule.name))
        places: list[tuple[int, bytes | None]] = []  # bit, what it takes
        stars: list[tuple[int, bytes]] = []  # bit, the star it stays on
        starts, ends, bit = [], [], -1
        for rule in self.rules:
            bit += 1
            starts.append(bit)
            for token in _tokens(rule.glob):
                if token in (b"*", b"**"):
                    stars.append((bit, token))
                else:
                    bit += 1
                    places.append((bit, token))
            ends.append(bit)
        self.words = bit // 64 + 1
        self.takes, self.stays = (np.zeros((256, self.words), np.uint64) for _ in range(2))
        not_slash = np.arange(256) != ord("/")
        for at, token in places:
            self._set(self.takes, not_slash if token is None else np.arange(256) == token[0], at)
        for at, star in stars:
            self._set(self.stays, not_slash if star == b"*" else np.ones(256, bool), at)
        self.start = np.zeros((1, self.words), np.uint64)
        for at in starts:
            self._set(self.start, np.ones(1, bool), at)
        self.ends = ends

    @staticmethod
    def _set(masks: np.ndarray, rows: np.ndarray, bit: int) -> None:
        masks[rows, bit // 64] |= np.uint64(1 << bit % 64)

    def fits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Index of the winning rule per text, -1 if none fits. All texts move in step, the longest first."""
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = offsets[:-1][order], sizes[order]
        bits = np.repeat(self.start, len(order), axis=0)
        for step in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -step, "left"))  # texts longer than step
            byte, now = data[starts[:live] + step], bits[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            bits[:live] = (moved & self.takes[byte]) | (now & self.stays[byte])
        found = np.full(len(order), -1)
        for k, at in reversed(list(enumerate(self.ends))):
            found[(bits[:, at // 64] >> np.uint64(at % 64)) & np.uint64(1) == 1] = k
        out = np.empty_like(found)
        out[order] = found
        return out


def host_of(url: Column) -> Column:
    """From the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def judge(urls: DataFrame, rules: Sequence[Rule], *, url: str = "url", default: str = "allow") -> DataFrame:
    """The rows with host, path, rule (null if none fits) and verdict (`default` if none fits).

    Columns of these names are replaced. A null URL, or one without `://`, has an empty host and path; such rows get
    the default, as do all rows if there are no rules. No row is lost; nothing is shuffled; an empty table stays empty.
    """
    keep = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    parts = urls.select(*[F.col(f"`{c}`") for c in keep], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    whole = free_name(parts, "_canonical")
    canonical = parts.withColumn(whole, F.concat(F.lit("."), "host", "path"))
    schema = T.StructType([*parts.schema.fields, *(T.StructField(c, T.StringType()) for c in ("rule", "verdict"))])
    rules, names = list(rules), parts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(rules) if rules else None
        for batch in batches:
            if automaton and batch.num_rows:
                found = automaton.fits(*utf8(batch.column(whole)))
            else:
                found = np.full(batch.num_rows, -1)
            hits = [automaton.rules[k] if k >= 0 else None for k in found.tolist()]
            columns = [batch.column(c) for c in names]
            columns.append(pa.array([hit and hit.name for hit in hits], pa.string()))
            columns.append(pa.array([hit.verdict if hit else default for hit in hits], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "rule", "verdict"])

    return map_arrow(canonical, run, schema)
