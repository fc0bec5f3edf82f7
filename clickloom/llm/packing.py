"""Packing by lexical retrieval: documents that share words share training sequences.

Documents are tokenised once and placed into shards of about ``SHARD_TOKENS`` tokens, related ones together; the number of shards grows
with the corpus. A binary tree of as many leaves as shards splits the documents by a random projection of their BM25 weights, each node at
the median of the main direction; at most ``LEAF_SAMPLE`` documents a leaf, taken evenly, fix the tree, and every document goes
down it. A leaf that holds several shards' worth, as of copies, is dealt at random. Neighbours in other shards are not looked up. Each shard has an inverted index with BM25 weights whose document frequencies and mean length come from the whole
corpus; tokens are the terms. A seed document opens a window of ``LENGTH`` ids. While the window has room, the unused document that BM25
ranks highest for all terms of the seed is added (of equal scores the smaller id); the document that does not fit is cut, and its rest opens the next
window. Where no unused document shares a term, the next one by id is taken. What is left at the end of a shard is cut into sequences of
powers of two, so that nothing is padded.

Every term is indexed with its BM25 weight, however many documents have it. The end id that closes a document is no term.

A null text is empty and has the end id only. Rows of one id are packed each for itself. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.batches import byte_blocks, different, ragged
from clickloom.llm.chunks import with_end_ids, worker_encoder
from clickloom.session import scratch_path, stored

LENGTH = 2048
END_ID = 1
SHARD_TOKENS = 1 << 20
LEAF_SAMPLE, MOST_LEAVES = 16, 1 << 14
SKETCH = 64
TERMS_AT_ONCE = 1 << 15
K1, B = 1.2, 0.75
COMMON = 0.2
_TOKENISED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("term", pa.int32())])


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row (doc_id, n tokens, compressed ids) for each document and, with ``term`` set, rows of how many of a task's documents have it."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = worker_encoder(tokenizer_path)
        size = max(size, end_id + 1)
        seen = np.zeros(size, np.int64)
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for block in byte_blocks(batch.column(1)):
                ids, offsets = with_end_ids(*encoder(block), end_id)
                inner = np.delete(ids, offsets[1:] - 1).astype(np.int64)  # without the end ids
                held = different(np.repeat(np.arange(len(block)) * size, np.diff(offsets) - 1) + inner)
                seen += np.bincount(held % size, minlength=size)
                small = ids.astype(np.uint16 if size <= 1 << 16 else np.uint32)
                packed = [packer.compress(small[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[block.rows], pa.array(np.diff(offsets)), pa.array(packed, pa.binary()), pa.nulls(len(block), pa.int32())], schema=_TOKENISED)
        terms = np.flatnonzero(seen)
        if len(terms):
            yield pa.RecordBatch.from_arrays([pa.nulls(len(terms), pa.int64()), pa.array(seen[terms]), pa.nulls(len(terms), pa.binary()), pa.array(terms.astype(np.int32))], schema=_TOKENISED)

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(encode, "doc_id bigint, n bigint, ids binary, term int").withColumn("lot", F.xxhash64("doc_id", F.monotonically_increasing_id()))


class Index:
    """The inverted index of a shard: for each term the documents that have it and their BM25 weights."""

    def __init__(self, documents: list[np.ndarray], idf: np.ndarray, mean_length: float) -> None:
        lengths = np.array([len(d) for d in documents])
        tokens = np.concatenate([d[:-1] for d in documents]).astype(np.int64)
        owner = np.repeat(np.arange(len(documents)), lengths - 1)
        heavy = idf[tokens] > 0
        cells, tf = np.unique(tokens[heavy] * len(documents) + owner[heavy], return_counts=True)
        term, self.doc = np.divmod(cells, len(documents))
        norm = K1 * (1 - B + B * lengths[self.doc] / mean_length)
        self.weight = idf[term] * tf * (K1 + 1) / (tf + norm)
        self.first = np.searchsorted(term, np.arange(len(idf) + 1))
        by_doc = np.argsort(self.doc, kind="stable")
        self.term_of = term[by_doc]
        self.first_of = np.searchsorted(self.doc[by_doc], np.arange(len(documents) + 1))
        self.n = len(documents)
        # the postings of common terms as whole rows, which are added faster
        common = np.flatnonzero(np.diff(self.first) >= max(1, self.n * COMMON))
        self.row = np.full(len(idf), -1)
        self.row[common] = np.arange(len(common))
        row = self.row[term]
        self.rows = np.zeros((len(common), self.n))
        self.rows[row[row >= 0], self.doc[row >= 0]] = self.weight[row >= 0]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for all terms of ``seed``."""
        terms = self.term_of[self.first_of[seed] : self.first_of[seed + 1]]
        row = self.row[terms]
        rare = terms[row < 0]
        posts = ragged(self.first[rare], self.first[rare + 1] - self.first[rare])
        return np.bincount(self.doc[posts], self.weight[posts], self.n) + self.rows[row[row >= 0]].sum(axis=0)


def nearest(scores: np.ndarray, k: int = 24) -> np.ndarray:
    """The documents of the k highest scores, and all that tie with the last of them, by falling score and then by place."""
    least = np.partition(scores, -k)[-k] if len(scores) > k else -np.inf
    best = np.flatnonzero(scores >= max(least, np.nextafter(0, 1)))
    return best[np.argsort(-scores[best], kind="stable")]


def packed_shard(documents: list[np.ndarray], idf: np.ndarray, mean_length: float, length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """The pieces (document, start, length, sequence, offset) of a shard."""
    index = Index(documents, idf, mean_length)
    free = np.ones(len(documents), bool)
    pieces, sequence, after = [], 0, 0
    seed, start = -1, 0
    while True:
        if seed < 0:
            while after < len(free) and not free[after]:
                after += 1
            if after == len(free):
                break
            seed, start = after, 0
            free[seed] = False
        take = min(length, len(documents[seed]) - start)
        pieces.append((seed, start, take, sequence, 0))
        filled, rest, rest_start = take, (seed if start + take < len(documents[seed]) else -1), start + take
        if filled < length:
            scores = index.scores(seed)
            scores[~free] = 0
            ranked = iter(nearest(scores).tolist())
            while filled < length:
                near = next(ranked, -1)
                if near < 0 or not scores[near] > 0 or not free[near]:
                    # the list is used up: rank again, or go on by id where nothing shares a term
                    scores[~free] = 0
                    near = int(scores.argmax())
                    if not scores[near] > 0:
                        while after < len(free) and not free[after]:
                            after += 1
                        if after == len(free):
                            break
                        near = after
                free[near] = False
                take = min(length - filled, len(documents[near]))
                pieces.append((near, 0, take, sequence, filled))
                filled += take
                if take < len(documents[near]):
                    rest, rest_start = near, take
        sequence += 1
        seed, start = rest, rest_start
        if filled < length:  # the shard's end
            last = [p for p in pieces if p[3] == sequence - 1]
            return [p for p in pieces if p[3] < sequence - 1] + powers_of_two(last, filled, sequence - 1)
    return pieces


def powers_of_two(pieces: list[tuple[int, int, int, int, int]], filled: int, sequence: int) -> list[tuple[int, int, int, int, int]]:
    """The pieces of a sequence of ``filled`` ids, cut into sequences whose lengths are powers of two."""
    out, at = [], 0
    queue = [(doc, start, n) for doc, start, n, _, _ in pieces]
    for bit in reversed(range(filled.bit_length())):
        room = filled & (1 << bit)
        at = 0
        while at < room:
            doc, start, n = queue.pop(0)
            take = min(n, room - at)
            out.append((doc, start, take, sequence, at))
            at += take
            if take < n:
                queue.insert(0, (doc, start + take, n - take))
        sequence += bool(room)
    return out


class Sketches:
    """Random projections of the BM25 weights of documents, of length 1; alike in all tasks."""

    def __init__(self, idf: np.ndarray, mean_length: float) -> None:
        self.idf, self.mean = idf, mean_length
        self.signs = np.random.default_rng(11).integers(0, 2, (len(idf), SKETCH), np.int8).astype(np.float32) * 2 - 1

    def __call__(self, documents: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(documents), SKETCH), np.float32)
        lengths = np.array([len(d) for d in documents])
        first = 0
        while first < len(documents):
            # about TERMS_AT_ONCE tokens, at least a document
            last = max(first + 1, int(np.searchsorted(np.cumsum(lengths[first:]), TERMS_AT_ONCE, "right")) + first)
            own = np.repeat(np.arange(first, last), lengths[first:last] - 1)
            cells = np.sort(own * len(self.idf) + np.concatenate([d[:-1] for d in documents[first:last]]))
            heads = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])) if len(cells) else cells
            doc, term = np.divmod(cells[heads], len(self.idf))
            tf = np.diff(np.append(heads, len(cells)))
            weight = self.idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / self.mean))
            starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else doc
            if len(doc):
                out[doc[starts]] = np.add.reduceat(weight.astype(np.float32)[:, None] * self.signs[term], starts)
            first = last
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def split_tree(sketches: np.ndarray, tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and cuts of a complete binary tree (node k has the children 2k + 1 and 2k + 2), halving the tokens at each node."""
    directions = np.zeros(((1 << depth) - 1, SKETCH), np.float32)
    cuts = np.full(len(directions), np.inf, np.float32)
    members = {0: np.arange(len(sketches))}
    for node in range(len(directions)):
        mine = members.pop(node, np.zeros(0, np.int64))
        if len(mine) < 2:
            continue
        centred = sketches[mine] - sketches[mine].mean(axis=0)
        direction = np.linalg.eigh(centred.T @ centred)[1][:, -1].astype(np.float32)
        along = (sketches[mine] * direction).sum(axis=1)
        order = np.argsort(along, kind="stable")
        total = np.cumsum(tokens[mine][order])
        directions[node], cuts[node] = direction, along[order[np.searchsorted(total, total[-1] / 2)]]
        right = along > cuts[node]
        members[2 * node + 1], members[2 * node + 2] = mine[~right], mine[right]
    return directions, cuts


def leaves(sketches: np.ndarray, directions: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The leaf of each sketch; equal sketches have equal leaves."""
    node = np.zeros(len(sketches), np.int64)
    for _ in range((len(cuts) + 1).bit_length() - 1):
        node = 2 * node + 1 + ((sketches * directions[node]).sum(axis=1) > cuts[node])
    return node - len(cuts)


def _ids(ids: pa.ChunkedArray | pa.Array, lengths: np.ndarray) -> list[np.ndarray]:
    unpacker = zstandard.ZstdDecompressor()
    raw = [unpacker.decompress(x.as_py()) for x in ids]
    return [np.frombuffer(x, np.uint16 if len(x) == 2 * n else np.uint32) for x, n in zip(raw, lengths, strict=True)]


def placed(documents: DataFrame, shared: Broadcast, shards: int, shard_tokens: int) -> DataFrame:
    """``documents`` with the shard of each one."""
    if shards == 1:
        return documents.select(F.lit(0).cast("bigint").alias("shard"), "doc_id", "n", "ids", "lot")
    spark = documents.sparkSession
    depth = (min(shards, MOST_LEAVES) - 1).bit_length()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches = Sketches(*shared.value[:2])
        for batch in batches:
            found = sketches(_ids(batch["ids"], batch["n"].to_numpy()))
            yield pa.RecordBatch.from_arrays([batch["lot"], batch["n"], pa.array([x.tobytes() for x in found], pa.binary())], ["lot", "n", "sketch"])

    share = min(1.0, LEAF_SAMPLE * (1 << depth) / max(1, documents.count()))
    some = documents.where(F.pmod("lot", F.lit(1 << 20)) < max(1, int(share * (1 << 20)))).select("n", "ids", "lot").mapInArrow(sketch, "lot bigint, n bigint, sketch binary")
    sample = sorted(some.collect())  # LEAF_SAMPLE a leaf
    vectors = np.array([np.frombuffer(r.sketch, np.float32) for r in sample], np.float32).reshape(-1, SKETCH)
    tree = spark.sparkContext.broadcast(split_tree(vectors, np.array([r.n for r in sample]), depth))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches = Sketches(*shared.value[:2])
        for batch in batches:
            leaf = leaves(sketches(_ids(batch["ids"], batch["n"].to_numpy())), *tree.value)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), batch["doc_id"], batch["n"], batch["ids"], batch["lot"]], ["leaf", "doc_id", "n", "ids", "lot"])

    rows = documents.select("doc_id", "n", "ids", "lot").mapInArrow(place, "leaf bigint, doc_id bigint, n bigint, ids binary, lot bigint")
    rows = stored(rows, scratch_path(spark, "placed"))  # so that each document goes down the tree once
    tokens = dict(rows.groupBy("leaf").agg(F.sum("n")).collect())  # MOST_LEAVES rows at most
    parts = [max(1, round(tokens.get(leaf, 0) / shard_tokens)) for leaf in range(1 << depth)]
    first = np.cumsum([0, *parts])[:-1].tolist()
    known = spark.createDataFrame(list(zip(range(1 << depth), first, parts, strict=True)), "leaf bigint, first bigint, parts bigint")
    shard = F.col("first") + F.pmod(F.col("lot"), F.col("parts"))
    return rows.join(F.broadcast(known), "leaf").select(shard.alias("shard"), "doc_id", "n", "ids", "lot")


def packed(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, length: int = LENGTH, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, their ids (32-bit, little-endian)."""
    spark = docs.sparkSession
    rows = stored(tokenised(docs, tokenizer_path, end_id, id_col, text_col), scratch_path(spark, "tokenised"))
    documents = rows.where(F.col("term").isNull())
    n_docs, n_tokens = documents.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = rows.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row for each id of the vocabulary at most
    size = max([end_id, *(t for t, _ in counts)]) + 1
    seen = np.zeros(size)
    for term, n in counts:
        seen[term] = n
    idf = np.where(seen > 0, np.log1p((n_docs - seen + 0.5) / (seen + 0.5)), 0)
    shared = spark.sparkContext.broadcast((idf, n_tokens / max(1, n_docs), size))
    shards = max(1, -(-n_tokens // shard_tokens))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        idf, mean, _ = shared.value
        group = group.sort_by([("doc_id", "ascending"), ("lot", "ascending")])
        lengths = group["n"].to_numpy()
        wide = _ids(group["ids"], lengths)
        pieces = packed_shard(wide, idf, mean, length)
        doc = np.array([p[0] for p in pieces])
        texts = [wide[d][s : s + n].astype("<u4").tobytes() for d, s, n, _, _ in pieces]
        base = key[0].as_py() << 32
        columns = [
            group["doc_id"].combine_chunks().take(pa.array(doc)),
            pa.array([p[1] for p in pieces], pa.int64()),
            pa.array([p[2] for p in pieces], pa.int64()),
            pa.array([zlib.crc32(x) for x in texts], pa.int64()),
            pa.array(lengths[doc].astype(np.int64)),
            pa.array([base + p[3] for p in pieces], pa.int64()),
            pa.array([p[4] for p in pieces], pa.int64()),
        ]
        return pa.Table.from_arrays(columns + [pa.array(texts, pa.binary())] * with_ids, names)

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint" + ", ids binary" * with_ids
    return placed(documents, shared, shards, shard_tokens).groupBy("shard").applyInArrow(pack, schema)
