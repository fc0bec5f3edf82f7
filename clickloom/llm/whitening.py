"""Embedding whitening by a bit-sliced scatter.

Each entry c becomes the integer x = floor(1024 * c) + 100000. The sums of all products x_i * x_j are counted, not multiplied: a task takes
blocks of ``BLOCK_ROWS`` vectors, shifts every dimension by its least entry of the block, packs each bit plane of each dimension across the rows into
64-bit words, and adds the popcounts of the AND of two planes with the weight of their bits. Blocks are brought back to unshifted sums with exact
integers, and Spark adds the sums of the tasks as decimals, one row for each pair of dimensions. So the sums depend neither on how rows are
dealt nor on their order. The driver gets that matrix, whose size is the square of the dimension and not of the data, centres it as integers
(n * sum(x_i x_j) - S_i S_j) and has its eigenvectors found in double precision. A second pass projects the rows.

Rows whose vector is null or empty, or holds a null, a NaN or an infinite entry, are dropped, as are those with an entry whose x lies beyond 2**62, and
those whose length is not the commonest one (of equally common lengths the largest). Repeated rows and ids count each; a null id stays null. A component whose eigenvalue is zero, as
far as doubles tell (``FLAT`` of the largest), has a null ``whitened`` and is left out of ``identity_error``. A deviation beyond a long is null. No
rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.ann import matrix
from clickloom.session import scratch_path, stored

SCALE, SHIFT = 1024, 100_000
BLOCK_ROWS = 4096
COMPONENTS = 8
FLAT = 1e-12
MOST = 2.0**62
_LONG = 1 << 63


def usable(vector: Column) -> Column:
    fits = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < MOST))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fits, F.lit(False))


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as a written table."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.where(usable(v)).select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), v.alias("v"))
    rows = stored(rows, scratch_path(vectors.sparkSession, "whiten-vectors"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("v") == (common[0].n if common else 0))


def integers(c: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def planes(u: np.ndarray, bits: int) -> np.ndarray:
    """Bit ``b`` of dimension ``i`` over all rows as the words of row ``i * bits + b``; ``u`` is unsigned, a row for each vector."""
    rows, dims = u.shape
    out = np.zeros((dims * bits, -(-rows // 64) * 8), np.uint8)
    for b in range(bits):
        out[b::bits, : -(-rows // 8)] = np.packbits(((u >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T, axis=1)
    return out.view(np.uint64)


def products(u: np.ndarray) -> np.ndarray:
    """The exact sums over rows of u_i * u_j, from AND and popcount of bit planes. Symmetric; Python integers if a long might overflow."""
    rows, dims = u.shape
    bits = max(1, int(u.max(initial=0)).bit_length())
    sliced = planes(u, bits)
    wide = 2 * bits + rows.bit_length() > 62
    weights = np.array([1 << b for b in range(bits)], object if wide else np.int64)
    sums = np.zeros((dims, dims), weights.dtype)
    for i in range(dims):
        for b in range(bits):
            own = sliced[i * bits + b]
            if own.any():
                counts = np.bitwise_count(sliced[i * bits :] & own).sum(axis=1, dtype=np.int64)
                sums[i, i:] += (counts.reshape(dims - i, bits).astype(weights.dtype) * weights).sum(axis=1) * weights[b]
    return np.triu(sums) + np.triu(sums, 1).T


def block_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of the products of all columns of (1, x), as Python integers: row 0 holds n and the sums of the columns."""
    low = x.min(axis=0)
    u = (x - low).astype(np.uint64)
    rows, low = len(x), low.astype(object)
    u_sums = u.astype(object).sum(axis=0)
    out = np.zeros((x.shape[1] + 1,) * 2, object)
    out[0, 0] = rows
    out[0, 1:] = out[1:, 0] = u_sums + rows * low
    out[1:, 1:] = products(u).astype(object) + np.outer(low, u_sums) + np.outer(u_sums, low) + rows * np.outer(low, low)
    return out


def scatter(rows: DataFrame) -> np.ndarray | None:
    """The sums of products of (1, x) over all rows, as Python integers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                sums = block_sums(integers(matrix(batch.column("v").slice(at, BLOCK_ROWS))))
                total = sums if total is None else total + sums
        if total is not None:
            i, j = np.triu_indices(len(total))
            # a decimal has 38 digits: high and low halves are added apart
            high, low = zip(*(divmod(s, 1 << 62) for s in total[i, j]), strict=True)
            columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(h) for h in high], pa.decimal128(38, 0)), pa.array([Decimal(s) for s in low], pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "high", "low"])

    parts = rows.select("v").mapInArrow(add, "i int, j int, high decimal(38,0), low decimal(38,0)")
    found = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()  # a row for each pair of dimensions
    if not found:
        return None
    out = np.zeros((max(r.j for r in found) + 1,) * 2, object)
    for r in found:
        out[r.i, r.j] = out[r.j, r.i] = (int(r.high) << 62) + int(r.low)
    return out


@dataclass
class Whitening:
    """What a row needs: n, the sums S, unit components (a row each), their eigenvalues, and e / trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        """A column for each component; NaN where its eigenvalue is zero."""
        mean = np.array([s / self.n for s in self.sums])
        scale = np.where(self.values > FLAT * self.values.max(initial=0), self.values, np.nan)
        return (x - mean) @ self.components.T / np.sqrt(scale)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums over dimensions of (n * x - S)^2, null beyond a long."""
        far = max(self.n * abs(int(v)) for v in (x.max(initial=0), x.min(initial=0))) + max(abs(s) for s in self.sums)
        kind = np.int64 if far * far * x.shape[1] < _LONG else object
        d = x.astype(kind) * self.n - self.sums.astype(kind)
        return [int(s) if s < _LONG else None for s in (d * d).sum(axis=1)]


def fitted(sums: np.ndarray, components: int = COMPONENTS) -> Whitening:
    """Eigenvectors of the covariance, which is centred as integers before it is divided."""
    n, s = sums[0, 0], sums[0, 1:]
    centred = n * sums[1:, 1:] - np.outer(s, s)
    covariance = np.array([[c / (n * n) for c in row] for row in centred.tolist()])
    values, vectors = np.linalg.eigh(covariance)
    trace = float(covariance.trace())
    order = np.argsort(-values, kind="stable")[:components]
    values = np.maximum(values[order], 0)
    return Whitening(n, s, vectors[:, order].T, values, values / trace if trace > 0 else np.zeros(len(order)))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(shared.value.values) + 1,) * 2)
        for batch in batches:
            if batch.num_rows:
                white = np.nan_to_num(shared.value.apply(integers(matrix(batch.column("v")))))
                white = np.column_stack([np.ones(len(white)), white])
                total += white.T @ white
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(x.ravel()) for x in (i, j, total)], ["i", "j", "s"])

    found = rows.select("v").mapInArrow(add, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    sums = np.zeros((len(model.values) + 1,) * 2)
    for r in found:
        sums[r.i, r.j] = r.s / model.n
    covariance = sums[1:, 1:] - np.outer(sums[0, 1:], sums[0, 1:])
    whole = model.values > FLAT * model.values.max(initial=0)
    return float(np.abs(covariance - np.eye(len(covariance)))[np.ix_(whole, whole)].max(initial=0))


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each row that takes part and each of its first components: vec_id, component, n, deviation, whitened, explained, identity_error."""
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = usable_vectors(vectors, id_col, vector_col)
    sums = scatter(rows)
    if sums is None:
        return vectors.sparkSession.createDataFrame([], schema)
    model = fitted(sums, components)
    shared = vectors.sparkSession.sparkContext.broadcast((model, identity_error(rows, model)))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, error = shared.value
        k = len(model.values)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                own = batch.slice(at, BLOCK_ROWS)
                x = integers(matrix(own.column("v")))
                each = pa.array(np.repeat(np.arange(len(x)), k))
                n = len(each)
                columns = [
                    own.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(n, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(each),
                    pa.array(model.apply(x).ravel(), from_pandas=True),
                    pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(n, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
