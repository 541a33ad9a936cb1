"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes in both directions and labels every
position; a document's probabilities are the mean over its letters. It is
trained here, in numpy, by backpropagation through time with Adam, on a bounded
sample of labelled documents (`per_language` and `chars`, documented bounds of
the fit only); every document is predicted from its whole text. Gates and
activations are piecewise linear, so that a step is a few cheap array operations
over thousands of windows.

Defined results: null and texts without a letter are `und` with score 0; a
corpus without labels predicts `und` for every text; equal texts get equal
predictions to the last bit, whatever texts stand beside them (windows are run
in blocks of one size, padded, since the rounding of a matrix product depends on
its size); labels, sources and ids are never inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedplan.llm.words import bytes_of, slices, small_batches

UNKNOWN = "und"
PAD = 256
#: Labels that a model may have: a corpus with more distinct labels is refused.
MOST_LABELS = 500
#: Windows that the network runs at once, always.
BLOCK = 1024


@dataclass(frozen=True)
class Training:
    """Documents of each language and characters of each that the fit sees; units of each direction; bytes of a
    window; windows of a step; steps; step size; seed."""

    per_language: int = 400
    chars: int = 600
    units: int = 8
    window: int = 64
    batch: int = 256
    steps: int = 400
    rate: float = 0.02
    seed: int = 3


def windows(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts in rows of `size` (padded), and the text of each row."""
    length = np.diff(bounds)
    rows = -(-length // size)
    text = np.repeat(np.arange(len(length)), rows)
    out = np.full(int(rows.sum()) * size, PAD, np.int32)
    shift = np.repeat((np.cumsum(rows) - rows) * size - bounds[:-1], length)
    out[np.arange(len(data)) + shift] = data
    return out.reshape(-1, size), text


#: Positions that are pooled: ASCII letters and bytes of other characters.
LETTERS = np.zeros(257, np.float32)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


class Direction:
    """One gated recurrent layer: `x` has the rows of the bytes, `u` the recurrent weights (update, reset, candidate)."""

    def __init__(self, x: np.ndarray, u: np.ndarray):
        self.x, self.u = x, u

    def run(self, columns: np.ndarray, keep: bool) -> tuple[np.ndarray, list[tuple]]:
        """States after each column of bytes (time first); with `keep`, what backpropagation needs."""
        steps, rows = columns.shape
        units = self.u.shape[0]
        h = np.zeros((rows, units), np.float32)
        states = np.empty((steps, rows, units), np.float32)
        kept = []
        for t in range(steps):
            a = self.x.take(columns[t], 0)
            g = h @ self.u
            gates = a[:, : 2 * units] + g[:, : 2 * units]
            np.clip(gates, 0, 1, out=gates)
            z, r = gates[:, :units], gates[:, units:]
            n = r * g[:, 2 * units :]
            n += a[:, 2 * units :]
            np.clip(n, -1, 1, out=n)
            new = h - n
            new *= z
            new += n
            if keep:
                kept.append((h, z, r, n, g[:, 2 * units :]))
            h = states[t] = new
        return states, kept

    def back(self, columns: np.ndarray, kept: list[tuple], d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of `x` and `u`: backpropagation through time."""
        units = self.u.shape[0]
        dx, du = np.zeros_like(self.x), np.zeros_like(self.u)
        dh = np.zeros(d_states.shape[1:], np.float32)
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, n, gn = kept[t]
            dh = dh + d_states[t]
            dz = dh * (h - n) * ((z > 0) & (z < 1))
            dn = dh * (1 - z) * (np.abs(n) < 1)
            dr = dn * gn * ((r > 0) & (r < 1))
            dg = np.concatenate([dz, dr, dn * r], 1)
            da = np.concatenate([dz, dr, dn], 1)
            for j in range(3 * units):
                dx[:, j] += np.bincount(columns[t], weights=da[:, j], minlength=len(dx))
            du += h.T @ dg
            dh = dh * z + dg @ self.u.T
        return dx, du


class Network:
    """Both directions and the labels of a position."""

    def __init__(self, labels: list[str], units: int, seed: int):
        rng = np.random.default_rng(seed)
        self.labels = labels
        make = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
        self.parts = []
        for _ in range(2):
            x = make(PAD + 1, 3 * units, scale=0.3)
            x[:, : 2 * units] += 0.5
            self.parts += [x, make(units, 3 * units, scale=0.5 / np.sqrt(units))]
        self.parts += [make(2 * units, len(labels), scale=0.3), np.zeros(len(labels), np.float32)]

    def _directions(self) -> tuple[Direction, Direction]:
        return Direction(*self.parts[:2]), Direction(*self.parts[2:4])

    @staticmethod
    def _softmax(logits: np.ndarray) -> np.ndarray:
        logits -= logits.max(-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(-1, keepdims=True)
        return logits

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Sum over the letters of each row of the probabilities of their labels, then the number of letters."""
        columns = np.ascontiguousarray(rows.T)
        forward, backward = self._directions()
        v, c = self.parts[4:]
        units = len(v) // 2
        ahead, _ = forward.run(columns, False)
        behind, _ = backward.run(columns[::-1], False)
        total = np.zeros((len(rows), len(c) + 1), np.float32)
        for t in range(len(columns)):
            p = self._softmax(ahead[t] @ v[:units] + behind[-1 - t] @ v[units:] + c)
            letter = LETTERS.take(columns[t])
            p *= letter[:, None]
            total[:, :-1] += p
            total[:, -1] += letter
        return total

    def gradients(self, rows: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over the letters, and its gradients."""
        columns = np.ascontiguousarray(rows.T)
        forward, backward = self._directions()
        v, c = self.parts[4:]
        units = len(v) // 2
        ahead, kept_ahead = forward.run(columns, True)
        behind, kept_behind = backward.run(columns[::-1], True)
        both = np.concatenate([ahead, behind[::-1]], 2)
        p = self._softmax(both @ v + c)
        letters = LETTERS.take(columns)
        count = max(float(letters.sum()), 1.0)
        own = p[:, np.arange(len(label)), label]
        loss = float(-(np.log(own + 1e-9) * letters).sum() / count)
        p[:, np.arange(len(label)), label] -= 1
        p *= letters[:, :, None] / count
        dv = both.reshape(-1, 2 * units).T @ p.reshape(-1, len(c))
        d_both = p @ v.T
        dx1, du1 = forward.back(columns, kept_ahead, d_both[:, :, :units])
        dx2, du2 = backward.back(columns[::-1], kept_behind, d_both[::-1, :, units:])
        return loss, [dx1, du1, dx2, du2, dv, p.sum((0, 1))]

    def fit(self, rows: np.ndarray, label: np.ndarray, how: Training) -> list[float]:
        """Adam over shuffled steps with a falling rate; the loss of each step."""
        rng = np.random.default_rng(how.seed)
        first = [np.zeros_like(p) for p in self.parts]
        second = [np.zeros_like(p) for p in self.parts]
        losses: list[float] = []
        while len(losses) < how.steps:
            order = rng.permutation(len(rows))
            for start in range(0, len(rows), how.batch)[: how.steps - len(losses)]:
                at = order[start : start + how.batch]
                loss, grads = self.gradients(rows[at], label[at])
                losses.append(loss)
                t = len(losses)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
                for p, g, m, s in zip(self.parts, grads, first, second, strict=True):
                    g = g * min(1.0, 1.0 / (norm + 1e-12))
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    p -= how.rate * (1 - 0.95 * t / how.steps) * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
        return losses


def train(texts: list[str], labels: list[str], how: Training) -> Network | None:
    """A network for the labels that occur; None without any text."""
    names = sorted(set(labels))
    # one text in eight is seen in capitals too
    texts, labels = texts + [t.upper() for t in texts[::8]], labels + labels[::8]
    data, bounds = bytes_of(pa.array(texts, pa.large_string()))
    rows, text = windows(data, bounds, how.window)
    if not len(rows) or not names:
        return None
    network = Network(names, how.units, how.seed)
    place = {n: i for i, n in enumerate(names)}
    network.fit(rows, np.array([place[x] for x in labels])[text], how)
    return network


def sample(docs: DataFrame, label_column: str, text_column: str, how: Training) -> tuple[list[str], list[str]]:
    """Parts of labelled texts, about `per_language` of each label, drawn by hash: the same for any partitioning."""
    text, label = F.col(text_column), F.col(label_column)
    known = docs.where(label.isNotNull() & (F.length(F.coalesce(text, F.lit(""))) > 0))
    # copies are drawn together and count once
    different = known.groupBy(label.cast("string").alias("label"), F.xxhash64(text).alias("hash")).agg(F.count(F.lit(1)))
    counts = different.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LABELS + 1).collect()
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    if not counts:
        return [], []
    rates = F.create_map(*(F.lit(x) for r in counts for x in (r["label"], min(1.0, how.per_language / r["n"]))))
    drawn = F.pmod(F.xxhash64(text), F.lit(1 << 30)) / F.lit(float(1 << 30))
    start = F.pmod(F.xxhash64(F.lit(1), text), F.greatest(F.length(text) - how.chars, F.lit(0)) + 1) + 1
    part = text.substr(start.cast("int"), F.lit(how.chars)).alias("part")
    chosen = known.where(drawn < F.element_at(rates, label.cast("string"))).select(label.cast("string").alias("label"), part, drawn.alias("at"))
    # distinct, and a bound on what reaches the driver, whatever the texts are
    rows = chosen.distinct().orderBy("at", "label", "part").limit(2 * how.per_language * len(counts)).collect()
    return [r["part"] for r in rows], [r["label"] for r in rows]


def _block(rows: np.ndarray) -> np.ndarray:
    """The windows, padded to a whole block."""
    missing = BLOCK - len(rows)
    return np.concatenate([rows, np.full((missing, rows.shape[1]), PAD, rows.dtype)]) if missing else rows


def predicted(text: Column, network: Network | None, window: int) -> Column:
    """Struct of the label and its probability."""

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names: list[str] = []
            scores: list[float] = []
            for part in slices([pa.record_batch([texts], ["t"])], "t", 1 << 20):
                n = part.num_rows
                if network is None:
                    names += [UNKNOWN] * n
                    scores += [0.0] * n
                    continue
                data, bounds = bytes_of(part.column("t"))
                rows, at = windows(data, bounds, window)
                total = np.zeros((n, len(network.labels) + 1))
                for start in range(0, len(rows), BLOCK):
                    here = at[start : start + BLOCK]
                    np.add.at(total, here, network.probabilities(_block(rows[start : start + BLOCK]))[: len(here)])
                letters = total[:, -1]
                mean = total[:, :-1] / np.maximum(letters, 1)[:, None]
                best = mean.argmax(1)
                names += [network.labels[b] for b in best]
                scores += np.clip(mean[np.arange(n), best], 0, 1).tolist()
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return label(text)


def held_out(id_column: str) -> Column:
    """A third of the documents that no fit sees."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def with_languages(
    docs: DataFrame,
    column: str = "language",
    label_column: str = "lang",
    id_column: str = "doc_id",
    text_column: str = "text",
    how: Training | None = None,
) -> DataFrame:
    """The documents with a struct (lang_pred, score), from a network trained on those that are not held out. Nothing
    but the sample is shuffled."""
    small_batches(docs.sparkSession)
    how = how or Training()
    fit = docs.where(F.col(id_column).isNotNull() & ~held_out(id_column))
    network = train(*sample(fit, label_column, text_column, how), how)
    lettered = F.coalesce(F.col(text_column).rlike(r"\p{L}"), F.lit(False))
    raw = f"__{column}"
    out = docs.withColumn(raw, predicted(F.col(text_column), network, how.window))
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return out.withColumn(column, F.when(lettered, F.col(raw)).otherwise(unknown)).drop(raw)


def languages(docs: DataFrame, id_column: str = "doc_id", label_column: str = "lang", text_column: str = "text", how: Training | None = None) -> DataFrame:
    """One row per document."""
    found = with_languages(docs.select(id_column, text_column, label_column), "__l", label_column, id_column, text_column, how)
    return found.select(id_column, held_out(id_column).alias("held_out"), "__l.lang_pred", "__l.score")
