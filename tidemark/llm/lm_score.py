"""Document scores by masked pseudo-likelihood of a bidirectional window network.

Words are hashed to a fixed vocabulary. The network sees the words around a position, never the one at it, and
predicts its class; inside a class a word has its share of the corpus counts. A text's score is the
sum of the log-probabilities of all its words. Counts cover all texts. For training, texts are dealt by a hash into parts of one
size, whose number grows with the corpus; each part trains on its own texts, and the weights are averaged after each
round. Over the rounds every position of every text is a target once.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidemark.llm.common import without
from tidemark.llm.text_hashes import chunks

VOCABULARY = 1 << 14
CLASSES = 64
#: words seen to each side, embedding and hidden units, positions in a block
REACH = 2
EMBEDDING = 16
HIDDEN = 32
BLOCK = 4096
#: equal pieces in which counts and weights are gathered, each in a task of its own
PIECES = 64
#: words of a part that trains by itself
PART_WORDS = 4_000_000
PAD = VOCABULARY
OFFSETS = (*range(-REACH, 0), *range(1, REACH + 1))


@dataclass
class Vocabulary:
    """Class of each word, and the log of its share of the class's counts."""

    classes: np.ndarray
    log_share: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        """Classes of about equal mass, from the most common words down; frequent words have a class of their own."""
        smooth = counts + 0.5
        order = np.lexsort((np.arange(len(smooth)), -smooth))
        mass = np.cumsum(smooth[order]) / smooth.sum()
        classes = np.empty(len(smooth), np.int64)
        classes[order] = np.minimum(CLASSES - 1, np.floor(CLASSES * (mass - smooth[order] / smooth.sum()))).astype(np.int64)
        return cls(classes, np.log(smooth / np.bincount(classes, smooth, CLASSES)[classes]))


def new_weights(seed: int = 5) -> list[np.ndarray]:
    """Embeddings, input layer and bias, output layer and bias."""
    rng, width = np.random.default_rng(seed), len(OFFSETS) * EMBEDDING
    made = [rng.standard_normal(s) * k for s, k in (((VOCABULARY + 1, EMBEDDING), 0.3), ((width, HIDDEN), width**-0.5))]
    return [x.astype(np.float32) for x in (*made, np.zeros(HIDDEN), rng.standard_normal((HIDDEN, CLASSES)) * 0.1, np.zeros(CLASSES))]


def _softsign(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def gradients(weights: list[np.ndarray], context: np.ndarray, target: np.ndarray) -> tuple[float, np.ndarray, list[np.ndarray]]:
    """Mean loss, its gradient for the embeddings of every context word, and for the other weights."""
    emb, w1, b1, w2, b2 = weights
    x = emb[context].reshape(len(context), -1)
    h = _softsign(x @ w1 + b1)
    scores = h @ w2 + b2
    scores -= scores.max(axis=1, keepdims=True)
    p = np.exp(scores)
    p /= p.sum(axis=1, keepdims=True)
    each = np.arange(len(target))
    loss = float(-np.log(p[each, target] + 1e-12).mean())
    p[each, target] -= 1
    p /= len(target)
    dz = (p @ w2.T) * (1 - np.abs(h)) ** 2
    return loss, (dz @ w1.T).reshape(*context.shape, EMBEDDING), [x.T @ dz, dz.sum(axis=0), h.T @ p, p.sum(axis=0)]


class Trainer:
    """Adagrad from given weights; embeddings change only where words occur."""

    def __init__(self, weights: list[np.ndarray], rate: float) -> None:
        self.weights, self.rate = [w.copy() for w in weights], rate
        self.sums = [np.full(w.shape, 1e-6, np.float32) for w in weights]

    def step(self, context: np.ndarray, target: np.ndarray) -> float:
        loss, d_emb, others = gradients(self.weights, context, target)
        words, at = np.unique(context, return_inverse=True)
        flat = d_emb.reshape(-1, EMBEDDING)
        at = at.ravel()
        summed = np.stack([np.bincount(at, flat[:, i], len(words)) for i in range(EMBEDDING)], axis=1).astype(np.float32)
        self.sums[0][words] += summed * summed
        self.weights[0][words] -= self.rate * summed / np.sqrt(self.sums[0][words])
        for w, s, g in zip(self.weights[1:], self.sums[1:], others):
            s += g * g
            w -= self.rate * g / np.sqrt(s)
        return loss


def _ids(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(24) & np.uint64(VOCABULARY - 1)).astype(np.int64)


def _padded(ids: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with padding around every row, the place of each word in them, and its row."""
    row = np.repeat(np.arange(len(words) - 1), np.diff(words))
    place = np.arange(len(ids)) + REACH * (row + 1)
    out = np.full(len(ids) + REACH * len(words), PAD, np.int64)
    out[place] = ids
    return out, place, row


def _context(padded: np.ndarray, place: np.ndarray) -> np.ndarray:
    return padded[place[:, None] + np.array(OFFSETS)]


def _sum_pieces(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for piece, weight, packed in zip(*(c.to_pylist() for c in batch.columns)):
                values = np.frombuffer(zlib.decompress(packed), dtype).astype(float) * weight
                if piece in sums:
                    sums[piece][0] += weight
                    sums[piece][1] += values
                else:
                    sums[piece] = [weight, values]
        for piece, (weight, values) in sums.items():
            yield _piece(piece, weight, values / max(weight, 1e-9))

    return run


_PIECE = "piece int, weight double, packed binary"


def _piece(piece: int, weight: float, values: np.ndarray) -> pa.RecordBatch:
    packed = zlib.compress(np.ascontiguousarray(values).tobytes(), 1)
    return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([float(weight)]), pa.array([packed])], names=["piece", "weight", "packed"])


def _gathered(pieces: DataFrame, dtype: str, parts: int) -> dict[int, tuple[float, np.ndarray]]:
    """Weighted means of the pieces of ``parts`` parts, in two levels; their number and size are those of one model."""
    some = F.pmod(F.spark_partition_id(), F.lit(max(1, math.isqrt(parts))))
    halfway = pieces.withColumn("some", some).repartition("piece", "some").drop("some").mapInArrow(_sum_pieces(dtype), _PIECE)
    rows = halfway.repartition("piece").mapInArrow(_sum_pieces("float64"), _PIECE).collect()
    return {r["piece"]: (r["weight"], np.frombuffer(zlib.decompress(r["packed"]))) for r in rows}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(VOCABULARY, np.int64)
    for batch in batches:
        for _, hashes, _ in chunks(batch.column(0)):
            counts += np.bincount(_ids(hashes), minlength=VOCABULARY)
    if counts.any():
        for i, part in enumerate(np.split(counts, PIECES)):
            yield _piece(i, 1.0, part)


def word_counts(texts: DataFrame) -> np.ndarray:
    """Counts of all words of all texts, by hashed word."""
    # the mean times the number of partitions, rounded, is the exact sum up to 2 ** 52
    found = _gathered(texts.mapInArrow(_count, _PIECE), "int64", PIECES**2)
    return np.concatenate([np.rint(found[i][0] * found[i][1]) if i in found else np.zeros(VOCABULARY // PIECES) for i in range(PIECES)])


def _train(shared, stride: int, rate: float, round_: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, classes = shared.value
        trainer, seen, waiting = Trainer(weights, rate), 0, []
        for batch in batches:
            for _, hashes, words in chunks(batch.column(0)):
                ids = _ids(hashes)
                padded, place, row = _padded(ids, words)
                # every stride-th word of every text, another one in every round
                nth = np.arange(len(ids)) - words[row]
                own = np.flatnonzero((nth + round_) % stride == 0)
                waiting.append((_context(padded, place[own]), classes[ids[own]]))
                if sum(len(t) for _, t in waiting) >= BLOCK:
                    seen += _learn(trainer, waiting, BLOCK)
        if waiting:
            seen += _learn(trainer, waiting, 1)
        if seen:
            flat = np.concatenate([w.ravel() for w in trainer.weights])
            for i, part in enumerate(np.array_split(flat, PIECES)):
                yield _piece(i, seen, part)

    return run


def _learn(trainer: Trainer, waiting: list, least: int) -> int:
    """Steps over whole blocks of what waits; the rest goes on waiting unless ``least`` lets it through."""
    context, target = (np.concatenate(x) for x in zip(*waiting))
    waiting.clear()
    seen = 0
    for at in range(0, len(target), BLOCK):
        block = slice(at, at + BLOCK)
        if len(target[block]) >= least:
            trainer.step(context[block], target[block])
            seen += len(target[block])
        else:
            waiting.append((context[block], target[block]))
    return seen


@dataclass
class Model:
    weights: list[np.ndarray]
    vocabulary: Vocabulary


def fit_lm(docs: DataFrame, text_col: str = "text", rounds: int = 2, stride: int = 2, rate: float = 0.05, part_words: int = PART_WORDS) -> Model:
    """Counts over all texts; then ``rounds`` passes in which each part trains on every ``stride``-th position and the weights are averaged.

    With as many rounds as the stride every position is a target once. Rows are dealt by a hash of all their columns into parts of about ``part_words`` words and lie in its order
    there, so the model does not depend on the table's partitions but for the rounding of sums. What is gathered grows with the number of parts: one set of weights each. Texts that are
    null or hold no words add nothing; without any words the first weights are returned.
    """
    spark, texts = docs.sparkSession, docs.select(F.col(text_col).cast("string"))
    counts = word_counts(texts)
    vocabulary = Vocabulary.of(counts)
    parts = max(1, math.ceil(counts.sum() / part_words))
    dealt = docs.select(F.col(text_col).cast("string").alias("text"), F.xxhash64(*[F.col(c) for c in docs.columns]).alias("h"))
    dealt = dealt.repartitionById(parts, F.pmod("h", F.lit(parts)).cast("int")).sortWithinPartitions("h", "text").select("text")
    weights = new_weights()
    for round_ in range(rounds):
        shared = spark.sparkContext.broadcast((weights, vocabulary.classes))
        found = _gathered(dealt.mapInArrow(_train(shared, stride, rate, round_), _PIECE), "float32", parts)
        if found:
            flat = np.concatenate([found[i][1] for i in range(PIECES)]).astype(np.float32)
            ends = np.cumsum([w.size for w in weights])[:-1]
            weights = [part.reshape(w.shape) for part, w in zip(np.split(flat, ends), weights)]
    return Model(weights, vocabulary)


def position_scores(tables: list[np.ndarray], weights: list[np.ndarray], context: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Log-probability of the class at each position; ``tables`` hold each word's part of the input layer, by offset."""
    _, _, b1, w2, b2 = weights
    h = np.repeat(b1[None, :], len(context), axis=0)
    for j, part in enumerate(tables):
        h += part[context[:, j]]
    h /= 1 + np.abs(h)
    scores = h @ w2
    scores += b2
    scores -= scores.max(axis=1, keepdims=True)
    own = scores[np.arange(len(classes)), classes].astype(float)
    return own - np.log(np.exp(scores).sum(axis=1))


def _score(shared, text_col: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, classes, log_share = shared.value
        layers = weights[1].reshape(len(OFFSETS), EMBEDDING, HIDDEN)
        tables = [weights[0] @ layer for layer in layers]
        for batch in batches:
            tokens, sums = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for first, hashes, words in chunks(batch.column(text_col)):
                ids = _ids(hashes)
                padded, place, row = _padded(ids, words)
                each = np.empty(len(ids))
                for at in range(0, len(ids), BLOCK):
                    block = slice(at, at + BLOCK)
                    each[block] = position_scores(tables, weights, _context(padded, place[block]), classes[ids[block]])
                each += log_share[ids]
                rows = len(words) - 1
                tokens[first : first + rows] = np.diff(words)
                sums[first : first + rows] = np.bincount(row, each, rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens), pa.array(np.round(sums, 4))], names=names)

    return run


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``log_prob`` (the sum over all tokens) and ``mean_log_prob`` (null where there are none).

    Tokens are runs of characters other than U+0020 and U+0009 to U+000D, A-Z lower-cased; each is predicted from the two before and after it,
    and its logarithm is natural. Null, empty and blank texts have 0 tokens and a sum of 0. Texts of any length are scored whole; repeated rows get equal
    scores. Columns of these names are replaced, others pass through. An empty table gives an empty result.
    """
    docs = without(docs, "n_tokens", "log_prob", "mean_log_prob")
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.vocabulary.classes, model.vocabulary.log_share))
    schema = StructType([*docs.schema.fields, StructField("n_tokens", LongType()), StructField("log_prob", DoubleType())])
    scored = docs.mapInArrow(_score(shared, text_col, [f.name for f in schema.fields]), schema)
    return scored.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
