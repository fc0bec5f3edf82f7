"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Tokens are runs of lower-case letters (hashed into ``WORDS`` slots), runs of capitals, digits or other signs (by kind and length,
signs by their bytes), and one token for a word that repeats the word before it.

Random indexing: every slot has a fixed sparse vector of ``SPARSE`` signs among ``DIMS`` places; the context vector of a slot is the sum
of those of the tokens next to it, over all documents. Each task adds up its own table, so what is shuffled is bounded by WORDS x
DIMS numbers for each task. A document is the mean of its tokens' scaled context vectors, joined by that of their sparse vectors
and the log of its length.

The network learns on the driver from a bounded sample of labelled documents (about ``MAX_LABELLED``, evenly by the hash of the id). A
temperature fitted on a held-back fifth of them calibrates its probabilities.

A null text is empty; an empty text has the zero vector and gets the network's score of that. Without labels of both kinds every score is the
share of label 1 (0.5 without any). Rows of one document with different labels: the mean label, a half counting as 1. Repeated
rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.batches import Block, binary_column, byte_blocks, mixed, span_hashes
from clickloom.session import scratch_path, stored

WORDS = 4096
DIMS = 48
SPARSE = 4
HIDDEN = 32
MAX_LABELLED = 12_000
BLOCK = 1 << 19
_KIND = np.full(256, 3, np.uint8)  # 0 gap, 1 lower-case or beyond ASCII, 2 capital, 3 sign, 4 digit
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(97, 123), *range(128, 256)]] = 1
_KIND[65:91] = 2
_KIND[48:58] = 4
_REPEAT = 0
_U64 = np.uint64


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Slot and owning text of every token of a block."""
    kind = _KIND[block.data]
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.ones(len(kind), bool)
    first[1:] = kind[1:] != kind[:-1]
    inner = block.offsets[1:-1]
    first[inner[inner < len(kind)]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(kind))
    solid = kind[starts] != 0
    starts, ends = starts[solid], ends[solid]
    what = kind[starts]
    h = span_hashes(block.data, starts, ends)
    shape = mixed(what.astype(np.uint64) * _U64(64) + np.minimum(ends - starts, 6).astype(np.uint64))
    h = np.where((what == 2) | (what == 4), shape, h)
    owner = block.owner(starts)
    # words: runs of tokens without a gap; a word equal to the one before it is marked at its first token
    glued = np.zeros(len(starts), bool)
    glued[1:] = (starts[1:] == ends[:-1]) & (owner[1:] == owner[:-1])
    word_start = np.flatnonzero(~glued)
    word_end = np.append(word_start[1:], len(starts)) - 1
    words = span_hashes(block.data, starts[word_start], ends[word_end]) if len(starts) else np.zeros(0, np.uint64)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (owner[word_start[1:]] == owner[word_start[:-1]])
    slot = (h % _U64(WORDS - 1)).astype(np.int64) + 1
    slot[word_start[again]] = _REPEAT
    return slot, owner


def sparse_vectors() -> tuple[np.ndarray, np.ndarray]:
    """The places and signs of each slot's fixed vector."""
    h = mixed(np.arange(WORDS * SPARSE, dtype=np.uint64) + _U64(1)).reshape(WORDS, SPARSE)
    return (h % _U64(DIMS)).astype(np.int64), np.where((h >> _U64(40)) & _U64(1), 1.0, -1.0)


def index_table() -> np.ndarray:
    places, signs = sparse_vectors()
    table = np.zeros((WORDS, DIMS))
    np.add.at(table, (np.arange(WORDS)[:, None], places), signs)
    return table


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The context vectors of all slots over all documents, scaled to length one."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((WORDS, DIMS))
        for batch in batches:
            for block in byte_blocks(batch.column(0), BLOCK):
                slot, owner = tokens(block)
                side = owner[1:] == owner[:-1]
                _add_neighbours(table, slot[:-1][side], slot[1:][side])
        if table.any():
            used = np.flatnonzero(table.any(axis=1))
            columns = [pa.array(used.astype(np.int32)), *(pa.array(table[used, i]) for i in range(DIMS))]
            yield pa.RecordBatch.from_arrays(columns, ["slot", *(f"c{i}" for i in range(DIMS))])

    schema = "slot int, " + ", ".join(f"c{i} double" for i in range(DIMS))
    sums = docs.select(f"`{text_col}`").mapInArrow(add_up, schema).groupBy("slot").agg(*(F.sum(f"c{i}").alias(f"c{i}") for i in range(DIMS)))
    table = np.zeros((WORDS, DIMS))
    for row in sums.collect():  # at most WORDS rows
        table[row[0]] = row[1:]
    norms = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.where(norms > 0, norms, 1)


def _add_neighbours(table: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Add to each token's slot the fixed vector of the token beside it."""
    cells, times = np.unique(left * WORDS + right, return_counts=True)
    a, b = cells // WORDS, cells % WORDS
    places, signs = sparse_vectors()
    for of, by in ((a, b), (b, a)):
        at = (of[:, None] * DIMS + places[by]).ravel()
        table += np.bincount(at, weights=(signs[by] * times[:, None]).ravel(), minlength=WORDS * DIMS).reshape(WORDS, DIMS)


def pooled(block: Block, vectors: np.ndarray) -> np.ndarray:
    """A row for each text: the mean of its tokens' rows of ``vectors``, and its length."""
    slot, owner = tokens(block)
    cells, times = np.unique(owner * WORDS + slot, return_counts=True)
    of = cells // WORDS
    sums = np.zeros((len(block), vectors.shape[1]))
    if len(cells):
        heads = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        sums[of[heads]] = np.add.reduceat(vectors[cells % WORDS] * times[:, None], heads, axis=0)
    counts = np.bincount(owner, minlength=len(block))
    return np.column_stack([sums / np.maximum(counts, 1)[:, None], np.log1p(counts) / 10])


@dataclass
class Network:
    """Two layers; ``constant`` replaces them where nothing could be learned."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, back: np.ndarray, epochs: int = 40, step: float = 3e-3) -> Network:
    """Adam on the rows that are not held back; the temperature is that of the least log loss on those that are."""
    width = x.shape[1]
    rng = np.random.default_rng(5)
    if not len(y) or y.min() == y.max():
        return Network(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0, constant=float(y[0]) if len(y) else 0.5)
    own = ~back if (~back).any() and len(set(y[~back])) == 2 else np.ones(len(y), bool)
    scale = x[own].std(axis=0)
    net = Network(x[own].mean(axis=0), np.where(scale > 1e-9, scale, 1), rng.normal(0, (2 / width) ** 0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    z, t = (x[own] - net.mean) / net.scale, y[own]
    parts = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second, at = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for i in range(0, len(z), 128):
            rows, at = order[i : i + 128], at + 1
            hidden = np.maximum(z[rows] @ parts[0] + parts[1], 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ parts[2] + parts[3], -60, 60))) - t[rows]) / len(rows)
            inner = np.outer(error, parts[2]) * (hidden > 0)
            slopes = [z[rows].T @ inner + 1e-4 * parts[0], inner.sum(axis=0), hidden.T @ error + 1e-4 * parts[2], error.sum(keepdims=True)]
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                parts[k] -= step * (first[k] / (1 - 0.9**at)) / (np.sqrt(second[k] / (1 - 0.999**at)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = parts[0], parts[1], parts[2], float(parts[3][0])
    if back.any():
        logits, truth = net.logits(x[back]), y[back]
        losses = {t: np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in np.geomspace(0.5, 5, 40)}
        net.temperature = float(min(losses, key=losses.get))
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network

    def scores(self, block: Block) -> np.ndarray:
        return self.network.scores(pooled(block, self.vectors))


def train(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MAX_LABELLED) -> QualityModel:
    """Word vectors from the texts of ``corpus`` (all of ``docs``, if not given), the network from ``labels`` of ``docs``."""
    context = word_vectors(docs if corpus is None else corpus, text_col)
    index = index_table()
    vectors = np.column_stack([context, index / np.linalg.norm(index, axis=1, keepdims=True).clip(1)])
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    marks = stored(marks, scratch_path(docs.sparkSession, "labels"))
    share = min(1.0, most / max(1, marks.count()))
    pick = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30))
    # about ``most`` rows of two numbers, whatever the size of ``labels``
    chosen = F.broadcast(marks.where(pick < int(share * (1 << 30))))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(chosen, "id")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in byte_blocks(batch.column("text"), BLOCK):
                found = pooled(block, shared.value).astype(np.float32)
                own = batch.slice(block.rows.start, len(block))
                vector = binary_column(found.ravel(), np.arange(len(found) + 1) * found.shape[1])
                yield pa.RecordBatch.from_arrays([own.column("id"), own.column("label"), vector], ["id", "label", "vector"])

    id_type = docs.schema[id_col].dataType.simpleString()
    points = rows.mapInArrow(vectorise, f"id {id_type}, label int, vector binary").groupBy("id").agg(F.min("vector").alias("vector"), F.min("label").alias("label"))
    found = sorted(points.collect(), key=lambda r: r.id)
    x = np.stack([np.frombuffer(r.vector, np.float32) for r in found]).astype(float) if found else np.zeros((0, vectors.shape[1] + 1))
    y = np.array([r.label for r in found], float)
    return QualityModel(vectors, fit(x, y, np.arange(len(y)) % 5 == 4))


def with_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with its score, in place of a column so named."""
    docs = docs.drop(score_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in byte_blocks(batch.column(place), BLOCK):
                own = batch.slice(block.rows.start, len(block))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(shared.value.scores(block))], [*own.schema.names, score_col])

    return docs.mapInArrow(judge, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))
