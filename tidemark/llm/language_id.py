"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample of
labelled windows. It labels every byte position of every whole text; a text's probability of a
language is the mean over its positions. Texts run in lanes of ``SPAN`` bytes, so that
many texts share each step and a very long text is just many lanes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.common import flat_bytes, without

#: bytes in a lane, lanes in a block, and hidden units in each direction
SPAN = 96
LANES = 4096
HIDDEN = 8

UNKNOWN = "und"


def _squash(x: np.ndarray, room: np.ndarray) -> np.ndarray:
    """x / (1 + |x|) in place: the cheap activation of candidates, and of gates after a shift to 0..1."""
    np.abs(x, out=room)
    room += 1
    x /= room
    return x


@dataclass
class Direction:
    """One gated recurrent layer: update gate, reset gate and candidate, in rows of equal number."""

    inputs: np.ndarray  # (3 * hidden, 256): the weights of each byte, bias included
    states: np.ndarray  # (3 * hidden, hidden)

    def run(self, codes: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list[tuple]]:
        """States after each step, (time, hidden, lanes) for codes (time, lanes); and, to ``keep``, what each step made."""
        k, lanes = self.states.shape[1], codes.shape[1]
        outs, steps, h = np.empty((len(codes), k, lanes), np.float32), [], np.zeros((k, lanes), np.float32)
        a, u, room = (np.empty((3 * k, lanes), np.float32) for _ in range(3))
        for t, code in enumerate(codes):
            np.take(self.inputs, code, axis=1, out=a, mode="clip")
            np.matmul(self.states, h, out=u)
            gates, n, memory = a[: 2 * k], a[2 * k :], u[2 * k :]
            gates += u[: 2 * k]
            _squash(gates, room[: 2 * k])
            gates += 1
            gates *= 0.5
            z, r = gates[:k], gates[k:]
            np.multiply(r, memory, out=room[:k])
            n += room[:k]
            _squash(n, room[:k])
            after = outs[t]
            np.subtract(h, n, out=after)
            after *= z
            after += n
            if keep:
                steps.append((h, z.copy(), r.copy(), n.copy(), memory.copy()))
            h = after
        return outs, steps

    def gradient(self, codes: np.ndarray, steps: list[tuple], outer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of both weights; ``outer`` (time, hidden, lanes) is the gradient of the outputs."""
        k = self.states.shape[1]
        into, d_states, dh = np.empty((len(steps), 3 * k, codes.shape[1]), np.float32), np.zeros_like(self.states), 0
        for t in range(len(steps) - 1, -1, -1):
            h, z, r, n, u = steps[t]
            dh = dh + outer[t]
            # the slope of x / (1 + |x|) is (1 - |output|) squared; a gate is half of it, shifted
            dn = dh * (1 - z) * (1 - np.abs(n)) ** 2
            dz = dh * (h - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            dr = dn * u * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            into[t] = np.concatenate([dz, dr, dn])
            du = np.concatenate([dz, dr, dn * r])
            d_states += du @ h.T
            dh = dh * z + self.states.T @ du
        flat = codes.ravel()
        d_inputs = np.stack([np.bincount(flat, into[:, i].ravel(), 256) for i in range(3 * k)]).astype(np.float32)
        return d_inputs, d_states


@dataclass
class Network:
    labels: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # (labels, 2 * hidden)
    bias: np.ndarray  # (labels, 1)

    @classmethod
    def new(cls, labels: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def made(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        ways = [Direction(made(3 * hidden, 256, scale=0.5), made(3 * hidden, hidden, scale=hidden**-0.5)) for _ in range(2)]
        return cls(labels, *ways, made(len(labels), 2 * hidden, scale=0.3), np.zeros((len(labels), 1), np.float32))

    @classmethod
    def of(cls, labels: list[str], weights: list[np.ndarray]) -> Network:
        return cls(labels, Direction(*weights[:2]), Direction(*weights[2:4]), *weights[4:])

    def weights(self) -> list[np.ndarray]:
        return [self.forward.inputs, self.forward.states, self.backward.inputs, self.backward.states, self.out, self.bias]

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Probability of each label at every position: (time, labels, lanes) for codes (time, lanes)."""
        k = self.forward.states.shape[1]
        scores = self.out[:, :k] @ self.forward.run(codes)[0]
        scores += self.out[:, k:] @ self.backward.run(codes[::-1])[0][::-1]
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def gradients(self, codes: np.ndarray, weight: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over the positions of ``weight`` (time, lanes), and its gradient for each weight."""
        k = self.forward.states.shape[1]
        ahead, ahead_steps = self.forward.run(codes, keep=True)
        back, back_steps = self.backward.run(codes[::-1], keep=True)
        states = np.concatenate([ahead, back[::-1]], axis=1)
        scores = self.out @ states + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        p = np.exp(scores)
        p /= p.sum(axis=1, keepdims=True)
        lanes, total = np.arange(codes.shape[1]), weight.sum()
        loss = float(-(np.log(p[:, target, lanes] + 1e-12) * weight).sum() / total)
        p[:, target, lanes] -= 1
        p *= (weight / total)[:, None, :]
        d_states = self.out.T @ p
        grads_ahead = self.forward.gradient(codes, ahead_steps, d_states[:, :k])
        grads_back = self.backward.gradient(codes[::-1], back_steps, d_states[::-1, k:])
        d_out = np.einsum("tlb,tkb->lk", p, states, optimize=True)
        return loss, [*grads_ahead, *grads_back, d_out, p.sum(axis=(0, 2))[:, None]]

    def fit(self, codes: np.ndarray, weight: np.ndarray, target: np.ndarray, steps: int, batch: int, rate: float, seed: int = 11) -> None:
        """Adam, with a falling rate, over batches in which the labels take equal parts."""
        rng = np.random.default_rng(seed)
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights()]
        lanes = [np.flatnonzero(target == i) for i in range(len(self.labels))]
        for step in range(1, steps + 1):
            own = np.concatenate([rng.choice(x, -(-batch // len(lanes))) for x in lanes])
            _, grads = self.gradients(np.ascontiguousarray(codes[:, own]), weight[:, own], target[own])
            slower = rate * (1 - 0.9 * step / steps)
            for w, g, (m, v) in zip(self.weights(), grads, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= slower * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)


def lanes_of(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, row) of every lane of ``SPAN`` bytes; a row's last lane may be shorter."""
    lengths = np.diff(offsets)
    counts = -(-lengths // SPAN)
    row = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return offsets[row] + nth * SPAN, row


def _block(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights (time, lanes); beyond the end of a row the code is 0 and the weight 0."""
    at = starts[None, :] + np.arange(SPAN)[:, None]
    inside = at < ends[None, :]
    codes = np.where(inside, flat[np.minimum(at, len(flat) - 1)], 0).astype(np.intp)
    return codes, inside.astype(np.float32)


def _labels_of(shared):
    """``shared`` is a broadcast of (labels, weights)."""

    def label(column: pa.Array) -> tuple[list[str], list[float]]:
        net = Network.of(*shared.value)
        flat, offsets = flat_bytes(column)
        starts, row = lanes_of(flat, offsets)
        sums = np.zeros((len(offsets) - 1, len(net.labels)))
        for at in range(0, len(starts), LANES):
            own = row[at : at + LANES]
            codes, weight = _block(flat, starts[at : at + LANES], offsets[own + 1])
            pooled = np.einsum("tlb,tb->bl", net.positions(codes), weight)
            np.add.at(sums, own, pooled)
        means = sums / np.maximum(1, np.diff(offsets))[:, None]
        best = means.argmax(axis=1)
        return [net.labels[i] for i in best], np.minimum(1, np.round(means.max(axis=1), 6)).tolist()

    return label


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_windows(labelled: DataFrame, lang_col: str, text_col: str, windows: int, chars: int) -> DataFrame:
    """At most ``windows`` rows (lang, window) per language, of ``chars`` characters each.

    A row is drawn by the hash of its text, one per language and bucket, so the choice does not depend on
    partitions and is pre-aggregated where the rows are.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & has_letters(F.col(text_col)))
    drawn = F.xxhash64(text_col)
    start = F.pmod(F.xxhash64(drawn), F.greatest(F.lit(1), F.length(text_col) - chars)) + 1
    cut = rows.select(
        F.col(lang_col).cast("string").alias("lang"), F.pmod(drawn, F.lit(windows)).alias("bucket"), drawn.alias("h"),
        F.substring(F.col(text_col), start.cast("int"), F.lit(chars)).alias("window"),
    )
    return cut.groupBy("lang", "bucket").agg(F.min(F.struct("h", "window")).alias("one")).select("lang", "bucket", F.col("one.window").alias("window"))


def fit_network(
    labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", windows: int = 256, chars: int = 288, steps: int = 300,
    batch: int = 64, rate: float = 0.03,
) -> Network | None:
    """Train on at most ``windows`` windows of ``chars`` characters per language; the bound is the sample's only limit.

    Rows without a language, without text or without letters take no part; None when nothing is left.
    """
    sample = sorted(training_windows(labelled, lang_col, text_col, windows, chars).collect())
    if not sample:
        return None
    labels = sorted({row[0] for row in sample})
    flat, offsets = flat_bytes(pa.array([row[2] for row in sample], pa.string()))
    starts, row = lanes_of(flat, offsets)
    codes, weight = _block(flat, starts, offsets[row + 1])
    target = np.array([labels.index(r[0]) for r in sample])[row]
    network = Network.new(labels)
    network.fit(codes, weight, target, steps, batch, rate)
    return network


def identify_language(docs: DataFrame, network: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    ``lang_pred`` is the label of the highest mean probability over all bytes of the text (ties: the first
    label), ``score`` that probability, 0 to 1. A text that is null, empty or has no letters gets ``und`` and 0, and
    so does every text where there is no network. Columns of these two names are replaced; others pass through.
    Repeated rows get equal results; an empty table gives an empty result.
    """
    docs = without(docs, "lang_pred", "score")
    if network is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast((network.labels, network.weights()))
    label = _labels_of(shared)
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = label(batch.column(text_col))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[f.name for f in schema.fields]
            )

    labelled = docs.mapInArrow(run, schema)
    known = has_letters(F.col(text_col))
    return labelled.withColumns({
        "lang_pred": F.when(known, F.col("lang_pred")).otherwise(F.lit(UNKNOWN)), "score": F.when(known, F.col("score")).otherwise(F.lit(0.0)),
    })
