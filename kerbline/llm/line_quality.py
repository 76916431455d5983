"""Quality of texts, line first: lines that break a rule go, and a text goes that loses too much of itself.

Words are runs of bytes other than \\x20 and \\x09 to \\x0D, lines are parted by \\n. A line with a word breaks a rule by

* punctuation: more noise marks (`#*$%&|<>!?`) than words, and at least NOISE_MARKS of them;
* navigation: several separator words, one for every NAVIGATION words or fewer, as in `Home | News | About`;
* boilerplate: the line equals an earlier one, or contains one of the phrases (A-Z lower-cased), or more than half of its
  words repeat the word before them.

Lines without a word break no rule. The cleaned text has the other lines, in order. A text is rejected at once if it has
too few words or its words mostly lie in repeated windows (the base rules, on the whole text), and else if its removed
lines held more than LOST_PERCENT of its words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kerbline.llm.common import map_arrow, slices, utf8

#: Characters that count as symbols, and word limits of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, REPEATED_PERCENT = 50, 50
#: Marks that make noise where they outnumber a line's words.
NOISE = SYMBOLS + "!?"
NOISE_MARKS = 3
#: Words that part the entries of a menu, and the most words that one of them stands for.
SEPARATORS = ("|", "»", "›", "·", "•")
NAVIGATION = 5
#: Phrases of lines that no author wrote; in lower case.
PHRASES = (
    "all rights reserved",
    "click here to",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "use of cookies",
)
LOST_PERCENT = 50
RULES = ("punctuation", "navigation", "boilerplate")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_NOISE = np.isin(np.arange(256), [ord(c) for c in NOISE])
_CONTINUES = (np.arange(256) & 0xC0) == 0x80
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NEWLINE = 10


def _codes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For byte strings that lie side by side: a number for each, the same for equal ones, and the distinct ones."""
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    coded = strings.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _per(owner: np.ndarray, size: int, weight: np.ndarray | None = None) -> np.ndarray:
    """Sum (or count) of what each owner has."""
    found = np.bincount(owner, minlength=size) if weight is None else np.bincount(owner, weight, size)
    return found.astype(np.int64)


def _packed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """A number for each pair, the same for equal pairs, without gaps."""
    return np.unique(high * (low.max(initial=0) + 1) + low, return_inverse=True)[1]


class _Slice:
    """The words and lines of some texts, found by one pass over their bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        data, size = self.data, len(offsets) - 1
        self.size = size
        # Lines: every text is one at least, and every line feed begins another.
        feeds = np.flatnonzero(data == _NEWLINE)
        self.line_starts = np.sort(np.concatenate([self.offsets[:-1], feeds + 1]), kind="stable")
        self.line_text = np.sort(np.concatenate([np.arange(size), np.searchsorted(self.offsets, feeds, "right") - 1]), kind="stable")
        last = np.append(self.line_text[1:] != self.line_text[:-1], True) if size else np.zeros(0, bool)
        self.line_ends = np.where(last, self.offsets[self.line_text + 1], np.append(self.line_starts[1:], 0) - 1) if size else last
        self.lines = len(self.line_starts)
        # Words.
        self.inside = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)  # a text may end within what looks like a word
        edge[self.offsets] = True
        first, end = self.inside.copy(), self.inside.copy()
        first[1:] &= ~self.inside[:-1] | edge[1:-1]
        end[:-1] &= ~self.inside[1:] | edge[1:-1]
        starts = np.flatnonzero(first)
        self.words = len(starts)
        self.word_text = np.searchsorted(self.offsets, starts, "right") - 1
        self.word_line = self._line_of(starts)
        letters = np.cumsum(self.inside)
        self.word, distinct = _codes(data[self.inside], letters[end])
        self.separator = np.isin(self.word, np.flatnonzero(np.isin(distinct.to_numpy(zero_copy_only=False), [s.encode() for s in SEPARATORS])))

    def _line_of(self, at: np.ndarray) -> np.ndarray:
        """The line that a byte is in; of lines that begin at one place, all but the last are empty."""
        return np.searchsorted(self.line_starts, at, "right") - 1

    def _text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, "right") - 1

    def base(self) -> dict[str, np.ndarray]:
        """The five counts of every text."""
        symbols = np.flatnonzero(_SYMBOL[self.data])
        return {
            "n_words": _per(self.word_text, self.size),
            "word_chars": _per(self._text_of(np.flatnonzero(self.inside & ~_CONTINUES[self.data])), self.size),
            "n_symbols": _per(self._text_of(symbols), self.size),
            "n_dup_lines": _per(self.line_text[self.again()], self.size),
            "n_repeat_words": self._repeated(),
        }

    def _repeated(self) -> np.ndarray:
        """Words of each text that lie in a window of three words which the text has several times."""
        covered = np.zeros(self.words, bool)
        if self.words > 2:
            window = _packed(_packed(self.word[:-2], self.word[1:-1]), self.word[2:])
            whole = np.flatnonzero(self.word_text[:-2] == self.word_text[2:])
            window = _packed(self.word_text[whole], window[whole])
            often = whole[np.bincount(window)[window] > 1] if len(window) else whole
            for k in range(3):
                covered[often + k] = True
        return _per(self.word_text[covered], self.size)

    def again(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their text."""
        code, _ = _codes(self.data[self.data != _NEWLINE], np.cumsum(self.line_ends - self.line_starts))
        full = np.flatnonzero(_per(self.word_line, self.lines))
        _, earliest = np.unique(_packed(self.line_text[full], code[full]), return_index=True)
        first = np.zeros(len(full), bool)
        first[earliest] = True
        return full[~first]

    def broken(self) -> dict[str, np.ndarray]:
        """For every rule whether a line breaks it."""
        words = _per(self.word_line, self.lines)
        noise = _per(self._line_of(np.flatnonzero(_NOISE[self.data])), self.lines)
        parts = _per(self.word_line[self.separator], self.lines)
        same = np.zeros(self.words, bool)
        same[1:] = (self.word[1:] == self.word[:-1]) & (self.word_line[1:] == self.word_line[:-1])
        boilerplate = 2 * _per(self.word_line[same], self.lines) > words
        boilerplate[self.again()] = True
        boilerplate[self._with_phrase()] = True
        return {
            "punctuation": (noise > words) & (noise >= NOISE_MARKS) & (words > 0),
            "navigation": (parts > 1) & (NAVIGATION * parts >= words),
            "boilerplate": boilerplate & (words > 0),
        }

    def _with_phrase(self) -> np.ndarray:
        lower = _LOWER[self.data].tobytes()
        found = []
        for phrase in PHRASES:
            at = lower.find(phrase.encode())
            while at >= 0:
                line = int(np.searchsorted(self.line_starts, at, "right")) - 1
                if at + len(phrase) <= self.line_ends[line]:
                    found.append(line)
                at = lower.find(phrase.encode(), at + 1)
        return np.array(found, np.int64)

    def without(self, gone: np.ndarray) -> list[bytes]:
        """The texts without these lines."""
        starts, ends, raw, out = self.line_starts, self.line_ends, self.data.tobytes(), []
        at = np.searchsorted(self.line_text, np.arange(self.size + 1))
        for k in range(self.size):
            rest = np.arange(at[k], at[k + 1])[~gone[at[k] : at[k + 1]]]
            if len(rest) == at[k + 1] - at[k]:
                out.append(raw[self.offsets[k] : self.offsets[k + 1]])
            else:
                out.append(b"\n".join(raw[starts[line] : ends[line]] for line in rest.tolist()))
        return out


SCHEMA = T.StructType(
    [
        *(T.StructField(c, T.LongType()) for c in COUNTS),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        *(T.StructField(f"{rule}_lines", T.LongType()) for rule in RULES),
        T.StructField("lost_words", T.LongType()),
        T.StructField("cleaned", T.StringType()),
    ]
)


def _judged(data: np.ndarray, offsets: np.ndarray, wanted: Sequence[str]) -> dict[str, object]:
    texts = _Slice(data, offsets)
    found: dict[str, object] = texts.base()
    broken = texts.broken()
    gone = np.logical_or.reduce([broken[rule] for rule in RULES])
    lost = _per(texts.word_text[gone[texts.word_line]], texts.size)
    failed = (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > REPEATED_PERCENT * found["n_words"])
    found |= {f"{rule}_lines": _per(texts.line_text[broken[rule]], texts.size) for rule in RULES}
    found |= {"lost_words": lost, "base_failed": failed, "kept": ~failed & (100 * lost <= LOST_PERCENT * found["n_words"])}
    if "cleaned" in wanted:
        found["cleaned"] = pa.array(texts.without(gone), pa.binary()).cast(pa.string())
    return found


def judged(docs: DataFrame, text: str = "text", results: Sequence[str] = tuple(SCHEMA.names)) -> DataFrame:
    """`docs` with the asked `results`: the five base counts, base_failed, kept, lines broken by each rule, the words that
    the removed lines held, and the cleaned text.

    Null text counts as empty; it has no words, so it is rejected. A line that breaks several rules counts for each, its
    words once. Texts are read whole, whatever their length; repeated rows are judged alike. An empty table gives no rows.
    Columns of `docs` with a result's name give way to the result; all others are kept whatever their names.
    """
    fields = [SCHEMA[name] for name in results]
    kept = [c for c in docs.columns if c not in results or c == text]
    rows = docs.select(*(f"`{c}`" for c in kept))
    names = [c for c in kept if c not in results]
    schema = T.StructType([*(rows.schema[c] for c in names), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found = _judged(*utf8(part.column(text)), results)
                own = [pa.array(found[f.name]) if isinstance(found[f.name], np.ndarray) else found[f.name] for f in fields]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *own], names=schema.names)

    return map_arrow(rows, run, schema)
