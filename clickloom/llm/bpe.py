"""Byte-level BPE by a rank file: encode and decode.

Two tiers look up a piece of text (a match of the split pattern): a minimal perfect hash over the vocabulary resolves a piece
that is a token itself; others are merged by a heap over linked bytes, the pair of lowest rank first, the leftmost of
equals. Texts go through ``ChunkEncoder``, which has each different chunk of a block split and looked up once.

A null text is empty and has no ids. Ids beyond the vocabulary raise an error when decoded. Repeated rows are treated alike; extra columns are kept by
``encoded`` and ``decoded``, but for those named like a result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickloom.llm.batches import binary_column, byte_blocks, list_offsets, mixed, ragged, span_hashes
from clickloom.llm.chunks import ChunkEncoder

_U64 = np.uint64
KEYS_PER_BUCKET = 4
_STEP = _U64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ids."""
    with open(path, "rb") as lines:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [found[i] for i in range(len(found))]


@dataclass(frozen=True)
class PerfectHash:
    """A minimal perfect hash of byte strings: bucket, displacement, slot.

    ``moves`` has for each bucket the number that sends its keys to slots of their own; in buckets of one key it is
    the slot itself, as -1 - slot.
    """

    moves: np.ndarray
    size: int

    @staticmethod
    def build(hashes: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
        """The function for different 64-bit hashes, and the slot of each."""
        n = len(hashes)
        buckets = max(1, n // KEYS_PER_BUCKET)
        bucket = (hashes % _U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        firsts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        moves, slots, taken = np.zeros(buckets, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        for b in np.argsort(-np.diff(firsts), kind="stable"):
            keys = order[firsts[b] : firsts[b + 1]]
            if len(keys) < 2:
                break
            tried = np.arange(1, 129, dtype=np.uint64)
            while True:
                at = (mixed(hashes[keys] + tried[:, None] * _STEP) % _U64(n)).astype(np.int64)
                free = ~taken[at].any(axis=1)
                free &= (np.diff(np.sort(at, axis=1), axis=1) > 0).all(axis=1)
                if free.any():
                    break
                tried = tried + _U64(len(tried))
            move, at = int(tried[free.argmax()]), at[free.argmax()]
            moves[b], slots[keys], taken[at] = move, at, True
        free = iter(np.flatnonzero(~taken).tolist())
        for b in np.flatnonzero(np.diff(firsts) == 1):
            key = order[firsts[b]]
            slots[key] = next(free)
            moves[b] = -1 - slots[key]
        return PerfectHash(moves, n), slots

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """The slot each hash would have; only the owner of a slot is a key."""
        moves = self.moves[(hashes % _U64(len(self.moves))).astype(np.int64)]
        at = (mixed(hashes + moves.astype(np.uint64) * _STEP) % _U64(max(self.size, 1))).astype(np.int64)
        return np.where(moves < 0, -1 - moves, at)


def _hashed(pieces: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
    return span_hashes(np.frombuffer(b"".join(pieces), np.uint8), np.append(0, ends[:-1]), ends)


def vocabulary_table(tokens: list[bytes]) -> tuple[PerfectHash, np.ndarray]:
    """The perfect hash of a vocabulary and the id that owns each slot."""
    found, slots = PerfectHash.build(_hashed(tokens))
    owner = np.zeros(len(tokens), np.int64)
    owner[slots] = np.arange(len(tokens))
    return found, owner


class Codec:
    def __init__(self, tokens: list[bytes], pattern: str, table: tuple[PerfectHash, np.ndarray]) -> None:
        import regex

        self.tokens, self.split = tokens, regex.compile(pattern).findall
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.hash, self.owner = table
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.chunks = ChunkEncoder(self._encode_chunks)

    def merged(self, piece: bytes) -> list[int]:
        """The ids of a piece that is no token itself."""
        rank, n = self.rank, len(piece)
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            left = parts[i]
            if left is None or (j := after[i]) == n or len(left) + len(parts[j]) != size:
                continue  # one of the two has been merged since
            parts[i] = left = left + parts[j]
            parts[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get(left + parts[k])) is not None:
                    heapq.heappush(heap, (r, i, size + len(parts[k])))
            if (h := before[i]) >= 0 and (r := rank.get(parts[h] + left)) is not None:
                heapq.heappush(heap, (r, h, len(parts[h]) + size))
        return [rank[p] for p in parts if p is not None]

    def _encode_chunks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.split(x) for x in texts]
        pieces = [p.encode() for own in found for p in own]
        place = self.owner[self.hash(_hashed(pieces))].tolist()
        tokens, merged = self.tokens, self.merged
        lists = [[at] if tokens[at] == p else merged(p) for at, p in zip(place, pieces, strict=True)]
        counts = list_offsets(np.array([len(x) for x in lists], np.int64))
        bounds = list_offsets(np.array([len(own) for own in found], np.int64))
        return np.array([i for x in lists for i in x], np.uint32), np.diff(counts[bounds])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of lists of ids, and where each list's bytes start (one more entry at the end)."""
        lengths = self.lengths[ids]
        return self.flat[ragged(self.starts[ids], lengths)], list_offsets(lengths)[offsets]


_CODECS: dict[tuple[str, str], Codec] = {}


@dataclass(frozen=True)
class SharedCodec:
    """What tasks need to set up a codec; the hash is built once, on the driver, and broadcast (as large as the vocabulary)."""

    rank_path: str
    pattern: str
    table: Broadcast

    @staticmethod
    def of(spark: SparkSession, rank_path: str, pattern: str) -> SharedCodec:
        return SharedCodec(rank_path, pattern, spark.sparkContext.broadcast(vocabulary_table(read_ranks(rank_path))))

    def on_worker(self) -> Codec:
        key = self.rank_path, self.pattern
        if key not in _CODECS:
            _CODECS[key] = Codec(read_ranks(self.rank_path), self.pattern, self.table.value)
        return _CODECS[key]


def encoded(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids``: little-endian unsigned 32-bit integers."""
    docs = docs.drop("ids")
    place = docs.columns.index(text_col)
    shared = SharedCodec.of(docs.sparkSession, rank_path, pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.on_worker()
        for batch in batches:
            for block in byte_blocks(batch.column(place)):
                own = batch.slice(block.rows.start, len(block))
                ids, offsets = codec.chunks(block)
                yield pa.RecordBatch.from_arrays([*own.columns, binary_column(ids.astype("<u4"), offsets)], [*own.schema.names, "ids"])

    return docs.mapInArrow(encode, T.StructType([*docs.schema.fields, T.StructField("ids", T.BinaryType())]))


def decoded(rows: DataFrame, rank_path: str, pattern: str, out_col: str = "decoded") -> DataFrame:
    """``rows`` with the bytes that their ``ids`` stand for."""
    rows = rows.drop(out_col)
    place = rows.columns.index("ids")
    shared = SharedCodec.of(rows.sparkSession, rank_path, pattern)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.on_worker()
        for batch in batches:
            for block in byte_blocks(batch.column(place)):
                own = batch.slice(block.rows.start, len(block))
                data, offsets = codec.decode(np.frombuffer(block.data.tobytes(), "<u4"), block.offsets // 4)
                yield pa.RecordBatch.from_arrays([*own.columns, binary_column(data, offsets)], [*own.schema.names, out_col])

    return rows.mapInArrow(decode, T.StructType([*rows.schema.fields, T.StructField(out_col, T.BinaryType())]))


def round_trip(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    shared = SharedCodec.of(docs.sparkSession, rank_path, pattern)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.on_worker()
        for batch in batches:
            for block in byte_blocks(batch.column(1)):
                ids, offsets = codec.chunks(block)
                data, bounds = codec.decode(ids, offsets)
                raw, ends = memoryview(ids.astype("<u4")).cast("B"), (offsets * 4).tolist()
                own, cuts = memoryview(data), bounds.tolist()
                digest = lambda view, at: [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(at, at[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[block.rows], pa.array(np.diff(offsets)), pa.array(digest(raw, ends), pa.string()), pa.array(digest(own, cuts), pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    id_type = docs.schema[id_col].dataType.simpleString()
    found = docs.select(docs[f"`{id_col}`"], docs[f"`{text_col}`"]).mapInArrow(check, f"id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return found.withColumnRenamed("id", id_col)
