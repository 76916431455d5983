"""Language identification by a bidirectional gated recurrent network over bytes.

Each direction reads a text's bytes with a gated recurrent unit (update gate, reset gate, candidate), whose squashing
function is x / (1 + |x|), as numpy has it at a tenth of the cost of tanh. Every position gets a label distribution from
both states; a document's distribution is the mean over its positions. The network is trained in numpy by backpropagation
through time on windows from all over a bounded sample of labelled rows. A text of any length is read whole, in windows
of WINDOW bytes whose states warm up on MARGIN bytes of context at either side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm.common import free_name, map_arrow, slices, utf8

#: Name of a text that has no letter (or is null).
UNDETERMINED = "und"
WINDOW, MARGIN = 384, 16
#: Windows that move in step; more take more memory, fewer more time.
LANES = 1024
HIDDEN = 12
#: Bound of the training sample: rows per language, and windows of TRAIN_WINDOW bytes from them.
SAMPLE_ROWS, SAMPLE_WINDOWS, TRAIN_WINDOW = 400, 800, 64
EPOCHS, BATCH, RATE = 5, 128, 0.01

F32 = np.float32


@dataclass
class Network:
    """Weights by name. Gates are stored in the order update, reset, candidate."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 10) -> Network:
        rng = np.random.default_rng(seed)
        weights = {}
        for way in ("f", "b"):
            weights[f"{way}_in"] = rng.normal(0, 0.3, (256, 3 * hidden))
            weights[f"{way}_own"] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden))
            weights[f"{way}_bias"] = np.zeros(3 * hidden)
        weights["out"] = rng.normal(0, 0.3, (2 * hidden, len(languages)))
        weights["out_bias"] = np.zeros(len(languages))
        return cls(languages, {k: v.astype(F32) for k, v in weights.items()})

    # -- training ------------------------------------------------------------------------------------------------------

    def _forward(self, data: np.ndarray, way: str) -> dict[str, np.ndarray]:
        """States of one direction for windows of equal length (time, window), kept for the way back."""
        w = self.weights
        hidden = w[f"{way}_own"].shape[0]
        steps, lanes = data.shape
        kept = {k: np.empty((steps, lanes, hidden), F32) for k in ("before", "update", "reset", "candidate", "inner")}
        states, state = np.empty((steps, lanes, hidden), F32), np.zeros((lanes, hidden), F32)
        into = w[f"{way}_in"] + w[f"{way}_bias"]
        for t in range(steps) if way == "f" else reversed(range(steps)):
            x, own = into[data[t]], state @ w[f"{way}_own"]
            update = _gate(x[:, :hidden] + own[:, :hidden])
            reset = _gate(x[:, hidden : 2 * hidden] + own[:, hidden : 2 * hidden])
            inner = own[:, 2 * hidden :]
            candidate = _squash(x[:, 2 * hidden :] + reset * inner)
            for name, value in zip(kept, (state, update, reset, candidate, inner)):
                kept[name][t] = value
            state = update * state + (1 - update) * candidate
            states[t] = state
        return kept | {"states": states}

    def _backward(self, data: np.ndarray, way: str, kept: dict[str, np.ndarray], grad: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of one direction's weights, through time, from those of its states."""
        own = self.weights[f"{way}_own"]
        hidden = own.shape[0]
        d_own, d_x = np.zeros_like(own), np.empty((*data.shape, 3 * hidden), F32)
        carry = np.zeros(grad.shape[1:], F32)
        for t in reversed(range(len(data))) if way == "f" else range(len(data)):
            before, update, reset, candidate, inner = (kept[k][t] for k in ("before", "update", "reset", "candidate", "inner"))
            d = grad[t] + carry
            d_candidate = d * (1 - update) * (1 - np.abs(candidate)) ** 2
            d_update = d * (before - candidate) * _gate_slope(update)
            d_reset = d_candidate * inner * _gate_slope(reset)
            d_x[t] = np.concatenate([d_update, d_reset, d_candidate], 1)
            d_gates = np.concatenate([d_update, d_reset, d_candidate * reset], 1)
            d_own += before.T @ d_gates
            carry = d * update + d_gates @ own.T
        flat = d_x.reshape(-1, 3 * hidden)
        byte = data.reshape(-1)
        d_in = np.stack([np.bincount(byte, column, 256) for column in flat.T], 1).astype(F32)
        return {f"{way}_in": d_in, f"{way}_own": d_own, f"{way}_bias": flat.sum(0)}

    def gradients(self, data: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of all positions' labels for windows data (time, window), and its gradients."""
        kept = {way: self._forward(data, way) for way in ("f", "b")}
        both = np.concatenate([kept["f"]["states"], kept["b"]["states"]], 2)
        logits = both @ self.weights["out"] + self.weights["out_bias"]
        logits -= logits.max(2, keepdims=True)
        share = np.exp(logits)
        share /= share.sum(2, keepdims=True)
        rows = np.arange(data.shape[1])
        loss = float(-np.log(share[:, rows, label] + 1e-9).mean())
        share[:, rows, label] -= 1
        share /= data.size
        found = {"out": both.reshape(-1, both.shape[2]).T @ share.reshape(-1, share.shape[2]), "out_bias": share.sum((0, 1))}
        back = share @ self.weights["out"].T
        hidden = both.shape[2] // 2
        found |= self._backward(data, "f", kept["f"], back[:, :, :hidden])
        found |= self._backward(data, "b", kept["b"], back[:, :, hidden:])
        return loss, found

    def train(self, windows: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        """Adam over shuffled batches of windows (window, time)."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, last = 0, epochs * -(-len(windows) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                _, found = self.gradients(np.ascontiguousarray(windows[some].T), label[some])
                size = max(1.0, float(np.sqrt(sum((g**2).sum() for g in found.values()))))
                step += 1
                rate = RATE * (1 - step / (last + 1))
                for k, g in found.items():
                    g = g / size
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g**2
                    up = rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                    self.weights[k] = (self.weights[k] - up).astype(F32)

    # -- reading -------------------------------------------------------------------------------------------------------

    def reader(self) -> Reader:
        return Reader(self)


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    """Between 0 and 1."""
    return 0.5 + 0.5 * _squash(x)


def _gate_slope(gate: np.ndarray) -> np.ndarray:
    return 0.5 * (1 - np.abs(2 * gate - 1)) ** 2


class Reader:
    """Label shares of texts, averaged over their positions; all windows of a slice move in step.

    Byte 256 stands for what lies outside the text. Every gate has arrays of its own, so that all steps run over whole
    arrays in place.
    """

    def __init__(self, network: Network):
        w = network.weights
        self.hidden = n = w["f_own"].shape[0]
        nothing = np.zeros((1, n), F32)
        self.into, self.own = {}, {}
        for way in "fb":
            into = w[f"{way}_in"] + w[f"{way}_bias"]
            columns = [slice(k * n, (k + 1) * n) for k in range(3)]
            self.into[way] = [np.concatenate([into[:, c], nothing]) for c in columns]
            self.own[way] = [np.ascontiguousarray(w[f"{way}_own"][:, c]) for c in columns]
        self.out, self.bias = w["out"], w["out_bias"]

    def _states(self, data: np.ndarray, way: str, first: int, last: int) -> np.ndarray:
        """States at the steps from first to last of windows data (time, window)."""
        steps, lanes = data.shape
        states, state = np.empty((last - first, lanes, self.hidden), F32), np.zeros((lanes, self.hidden), F32)
        update, reset, candidate, size = (np.empty_like(state) for _ in range(4))

        def squash(x: np.ndarray) -> None:
            np.abs(x, out=size)
            np.add(size, 1, out=size)
            np.divide(x, size, out=x)

        def gate(x: np.ndarray, k: int, at: np.ndarray) -> None:
            np.matmul(state, self.own[way][k], out=x)
            np.add(x, self.into[way][k].take(at, 0), out=x)
            squash(x)
            np.multiply(x, 0.5, out=x)
            np.add(x, 0.5, out=x)

        for t in range(last) if way == "f" else range(steps - 1, first - 1, -1):
            at = data[t]
            gate(update, 0, at)
            gate(reset, 1, at)
            np.matmul(state, self.own[way][2], out=candidate)
            np.multiply(candidate, reset, out=candidate)
            np.add(candidate, self.into[way][2].take(at, 0), out=candidate)
            squash(candidate)
            np.subtract(state, candidate, out=state)
            np.multiply(state, update, out=state)
            np.add(state, candidate, out=state)
            if first <= t < last:
                states[t - first] = state
        return states

    def shares(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean label distribution of each text's positions; zeros for an empty text."""
        sizes = np.diff(offsets)
        windows = -(-sizes // WINDOW)
        text = np.repeat(np.arange(len(sizes)), windows)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        start = offsets[:-1][text] + nth * WINDOW
        size = np.minimum(WINDOW, offsets[1:][text] - start)
        sums = np.zeros((len(sizes), len(self.bias)))
        order = np.argsort(size, kind="stable")
        padded = np.concatenate([data, np.zeros(1, np.uint8)])
        for at in range(0, len(order), LANES):
            own = order[at : at + LANES]
            steps = int(size[own].max())
            place = start[own] + np.arange(-MARGIN, steps + MARGIN)[:, None]
            inside = (place >= offsets[:-1][text[own]]) & (place < offsets[1:][text[own]])
            window = np.where(inside, padded[np.where(inside, place, -1)].astype(np.int64), 256)
            logits = self._states(window, "f", MARGIN, MARGIN + steps) @ self.out[: self.hidden]
            logits += self._states(window, "b", MARGIN, MARGIN + steps) @ self.out[self.hidden :]
            logits += self.bias
            np.exp(logits, out=logits)
            logits /= logits.sum(2, keepdims=True)
            logits[np.arange(steps)[:, None] >= size[own]] = 0
            np.add.at(sums, text[own], logits.sum(0))
        return sums / np.maximum(sizes, 1)[:, None]


# -- on Spark --------------------------------------------------------------------------------------------------------------


def fold(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the doc_id as text, modulo 4; rows of fold 2 are held out. Null is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4, F.lit(0)).cast("int")


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """About `rows` (text, lang) of each language, spread over the whole table; held-out rows are left out.

    Languages are counted first; then rows are kept by a hash of doc_id and text against a threshold. At most 4 times
    `rows` of a language come to the driver, however large the table is.
    """
    lang, text = F.col("lang"), F.col("text")
    usable = docs.filter((fold() != 2) & lang.isNotNull() & text.rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}
    chance = F.xxhash64(F.lit(7), "doc_id", "text") / F.lit(float(2**63)) * 0.5 + 0.5
    share = F.create_map(*(F.lit(v) for k, n in sorted(counts.items()) for v in (k, min(1.0, rows / n)))) if counts else None
    if share is None:
        return []
    kept = usable.filter(chance < F.element_at(share, lang)).select("text", "lang")
    found = [(r[0], r[1]) for r in kept.limit(4 * rows * len(counts)).collect()]
    return sorted(found, key=lambda r: (r[1], r[0]))


def windows_of(texts: list[tuple[str, str]], languages: list[str], most: int = SAMPLE_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """`most` windows per language at random places of its texts, and their labels; a short text is repeated to fill one."""
    rng = np.random.default_rng(12)
    found, label = [], []
    for k, language in enumerate(languages):
        own = [np.frombuffer(t.encode(), np.uint8) for t, other in texts if other == language]
        own = [np.resize(t, TRAIN_WINDOW) if len(t) < TRAIN_WINDOW else t for t in own if len(t)]
        sizes = np.array([len(t) for t in own], float)
        for pick in rng.choice(len(own), most, p=np.sqrt(sizes) / np.sqrt(sizes).sum()).tolist():
            at = int(rng.integers(0, len(own[pick]) - TRAIN_WINDOW + 1))
            found.append(own[pick][at : at + TRAIN_WINDOW])
            label.append(k)
    return np.array(found), np.array(label)


def fit(docs: DataFrame) -> Network | None:
    """The network trained on `docs` (doc_id, text, lang); None if no row can be learned from."""
    texts = sample(docs)
    languages = sorted({lang for _, lang in texts})
    if not languages:
        return None
    network = Network.fresh(languages)
    network.train(*windows_of(texts, languages))
    return network


def predict(
    spark: SparkSession, docs: DataFrame, network: Network | None, *, label: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """`docs` with lang_pred and score (columns of these names are replaced), or by what names they are asked for. Only the
    text is looked at; all other columns are kept whatever their names.

    Text that is null or has no letter gets `und` and score 0, as does every text if nothing could be learned. The score
    is the pooled share of the predicted language; of equal shares the first name wins. Rows with null or repeated ids
    stay as they are.
    """
    kept = docs.select(*(f"`{c}`" for c in docs.columns if c not in (label, score)))
    lettered = free_name(kept, "_letters")
    known = kept.withColumn(lettered, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = network and network.reader()
        for batch in batches:
            for part in slices(batch, "text"):
                letters = part.column(lettered).to_pylist()
                best, likely = [0] * len(letters), [0.0] * len(letters)
                if reader:
                    shares = reader.shares(*utf8(part.column("text")))
                    best, likely = shares.argmax(1).tolist(), np.clip(shares.max(1), 0, 1).tolist()
                sure = [bool(reader) and ok for ok in letters]
                columns = [part.column(c) for c in names]
                columns.append(pa.array([network.languages[b] if ok else UNDETERMINED for b, ok in zip(best, sure)], pa.string()))
                columns.append(pa.array([s if ok else 0.0 for s, ok in zip(likely, sure)], pa.float64()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, label, score])

    schema = kept.withColumns({label: F.lit(None).cast("string"), score: F.lit(None).cast("double")}).schema
    return map_arrow(known, run, schema)
