"""Alignment of two tokenizers' ids by interval coalescing.

A is a byte-level BPE of the tokenizers library and encodes a space and the text; B is a sentencepiece model and encodes the text, to which it adds the
space itself. So both cover the same bytes. All tokens of A and B are sorted by start (lexsort), the ends get a running maximum, and a group
breaks where a start reaches it: there tokens of both end. Within a group every token of A is linked with every one of B.

Texts are cut into chunks where both tokenizers surely have a boundary: A splits texts by a pattern before it merges, and B only merges what is one of its pieces, which
``Aligner`` looks through. Chunks are encoded and aligned on their own, each different one once in a worker. What a worker remembers is bounded by
chunks, pairs and bytes.

Two passes over the texts. The first counts for each linked pair of ids the documents that hold it, combined in the task. Spark adds the counts and finds the
highest of each A id. The second sums the counts over the links of each document. The table of counts goes to the tasks in slices of about
``MOST_PAIRS`` pairs by hash, one pass for each slice, so what is sent at once does not grow with the input.

Special tokens' strings in a text are plain text. A text that is null or empty, or whose ids do not give back its bytes in A or in B, has no tokens: its
counts are 0 and ``groups_sha256`` is ''. Repeated rows and ids count as documents of their own; a null id stays null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.batches import Block, byte_blocks, different, list_offsets, ragged, span_hashes
from clickloom.llm.chunks import library_encoder
from clickloom.session import scratch_path, stored

MOST_PAIRS = 1 << 22
MOST_CHUNKS = 600_000
MOST_CACHED = 8_000_000
FLUSH = 2_000_000
SPACE, LINE_END = 32, 10
#: U+2581, which stands for a space in pieces
MARK = "▁"


def byte_alphabet() -> dict[str, int]:
    """The character for each byte in byte-level vocabularies: itself if it prints, else the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Entries:
    """The bytes of each id of a vocabulary."""

    def __init__(self, entries: list[bytes]) -> None:
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.starts = list_offsets(self.lengths)[:-1]
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.starts[ids], self.lengths[ids])]


def library_entries(path: str) -> Entries:
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    alphabet = byte_alphabet()
    entries = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        entries[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
    return Entries(entries)


def coalesced(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number of each token of A and of B. Groups are numbered by place."""
    start, end = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    order = np.lexsort((end, start))
    reached = np.maximum.accumulate(end[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = start[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group[: len(starts_a)], group[len(starts_a) :]


def spaced(block: Block) -> Block:
    """The same texts with a space before each; an empty one stays empty."""
    lengths = np.diff(block.offsets)
    more = list_offsets(lengths + (lengths > 0))
    data = np.full(more[-1], SPACE, np.uint8)
    data[ragged(more[1:] - lengths, lengths)] = block.data
    return Block(data, more, block.rows)


_SOLID = np.zeros(256, bool)
_SOLID[33:127] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def chunk_starts(block: Block, signs: np.ndarray) -> np.ndarray:
    """Where chunks of a block with spaces begin: each text; a space or single line end after a character that surely is no white space (ASCII, or of two
    bytes beyond U+00BF); what follows that line end; a sign after an ASCII letter."""
    data, n = block.data, len(block.data)
    cut = np.zeros(n + 1, bool)
    if n:
        shown = _SOLID[data]
        shown[1:] |= (data[1:] >= 128) & (data[1:] < 192) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
        cut[1:n] = shown[:-1] & ((data[1:] == SPACE) | (signs[data[1:]] & _LETTER[data[:-1]]))
        ahead = _SOLID[data] | ((data >= 0xC3) & (data <= 0xDF))
        alone = np.flatnonzero(shown[:-2] & (data[1:-1] == LINE_END) & ahead[2:]) + 1
        cut[alone] = cut[alone + 1] = True
        cut[block.offsets[:-1][np.diff(block.offsets) > 0]] = True
    return np.flatnonzero(cut[:n])


class _Grown:
    """An array that grows at its end."""

    def __init__(self, dtype: type, columns: int = 0) -> None:
        self.data, self.n = np.zeros((1024, columns) if columns else 1024, dtype), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            room = np.zeros((max(2 * len(self.data), self.n + len(more)), *self.data.shape[1:]), self.data.dtype)
            room[: self.n] = self.data[: self.n]
            self.data = room
        self.data[self.n : self.n + len(more)] = more
        self.n += len(more)


class Aligner:
    """The alignment of each different chunk that a worker has met."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece

        self.encode_a = library_encoder(path_a)[0]
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        texts = [name for i, name in enumerate(names) if not self.pieces.is_byte(i)]
        if any(MARK in name.lstrip(MARK) or "\n" in name for name in texts):
            raise ValueError("a piece reaches over a space or line end, so texts cannot be cut into chunks")
        self.signs = _SOLID & ~_LETTER
        self.signs[48:58] = False
        self.signs[[ord(y) for name in texts for x, y in pairwise(name) if x.isascii() and x.isalpha() and y.isascii()]] = False
        #: what the library puts before a text that begins with a line end
        self.lead = len(self.pieces.encode("\n"))
        self.size_b = len(names)
        self.bytes_a = library_entries(path_a)
        self.bytes_b = Entries([bytes([int(name[3:5], 16)]) if self.pieces.is_byte(i) else name.replace(MARK, " ").encode() for i, name in enumerate(names)])
        self.with_text = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.whole, self.counts = _Grown(bool), _Grown(np.int64, 4)
        self.text: list[str] = []
        self.text_size = 0
        self.pairs, self.times, self.first = _Grown(np.int64), _Grown(np.int64), _Grown(np.int64)
        self.first.add(np.zeros(1, np.int64))
        self.table: object = None

    def _encode_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """After a line end, which no piece reaches over, a chunk is encoded as in its text."""
        found = [ids[self.lead :] for ids in self.pieces.encode(["\n" + t for t in texts], num_threads=1)]
        return np.array([i for ids in found for i in ids], np.int64), np.array([len(ids) for ids in found], np.int64)

    def _learn(self, block: Block, hashes: list[int], starts: np.ndarray, ends: np.ndarray) -> None:
        raw = block.data.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        n = len(texts)
        ids_a, n_a = self.encode_a(texts)
        ids_a = ids_a.astype(np.int64)
        ids_b, n_b = self._encode_b(texts)
        owner_a, owner_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        lengths = ends - starts
        whole = np.ones(n, bool)
        for entries, ids, owner in ((self.bytes_a, ids_a, owner_a), (self.bytes_b, ids_b, owner_b)):
            size = np.bincount(owner, entries.lengths[ids], n).astype(np.int64)
            whole &= size == lengths
            fit = size == lengths
            given = entries.joined(ids[fit[owner]])
            wanted = block.data[ragged(starts[fit], lengths[fit])]
            whole[np.repeat(np.flatnonzero(fit), lengths[fit])[given != wanted]] = False
        keep_a, keep_b = whole[owner_a], whole[owner_b]
        ids_a, ids_b, owner_a, owner_b = ids_a[keep_a], ids_b[keep_b], owner_a[keep_a], owner_b[keep_b]
        ends_a, ends_b = np.cumsum(self.bytes_a.lengths[ids_a]), np.cumsum(self.bytes_b.lengths[ids_b])
        group_a, group_b = coalesced(ends_a - self.bytes_a.lengths[ids_a], ends_a, ends_b - self.bytes_b.lengths[ids_b], ends_b)
        groups = int(group_a[-1]) + 1 if len(group_a) else 0
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        owner = np.zeros(groups, np.int64)
        owner[group_a] = owner_a
        counts = np.column_stack([np.bincount(owner_a, minlength=n), np.bincount(owner_b, minlength=n), np.bincount(owner, minlength=n), np.bincount(owner, in_a * in_b, n).astype(np.int64)])
        # every token of A with all of B in its group
        partners = in_b[group_a]
        pair = np.repeat(ids_a, partners) * self.size_b + ids_b[ragged((np.cumsum(in_b) - in_b)[group_a], partners)]
        held, times = np.unique(np.repeat(owner_a, partners) * (1 << 40) + pair, return_counts=True)
        text = self._text(ids_a, ids_b, in_a, in_b, owner, n) if self.with_text else []

        self.known.update(zip(hashes, range(len(self.known), len(self.known) + n), strict=True))
        self.whole.add(whole)
        self.counts.add(counts)
        self.first.add(self.pairs.n + np.cumsum(np.bincount(held >> 40, minlength=n)))
        self.pairs.add(held & ((1 << 40) - 1))
        self.times.add(times)
        self.text += text
        self.text_size += sum(map(len, text))

    @staticmethod
    def _text(ids_a: np.ndarray, ids_b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, owner: np.ndarray, n: int) -> list[str]:
        """The groups of each chunk as a1,a2|b1;a3|b2,b3."""
        a, b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        parts: list[str] = []
        i = j = 0
        for x, y in zip(in_a.tolist(), in_b.tolist(), strict=True):
            parts.append(f"{a[i]}|{b[j]}" if x == y == 1 else f"{','.join(a[i : i + x])}|{','.join(b[j : j + y])}")
            i, j = i + x, j + y
        bounds = np.searchsorted(owner, np.arange(n + 1)).tolist()
        return [";".join(parts[p:q]) for p, q in zip(bounds[:-1], bounds[1:], strict=True)]

    def chunks(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The known chunk at each place of a block with spaces, and the text it is in."""
        starts = chunk_starts(block, self.signs)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(block.data))
        different, first, which = np.unique(span_hashes(block.data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) + len(different) > MOST_CHUNKS or self.pairs.n > MOST_CACHED or self.text_size > 8 * MOST_CACHED:
            self._forget()
        hashes = different.tolist()
        if missing := [i for i, h in enumerate(hashes) if h not in self.known]:
            self._learn(block, [hashes[i] for i in missing], starts[first[missing]], ends[first[missing]])
        place = np.fromiter(map(self.known.__getitem__, hashes), np.int64, len(hashes))[which]
        return place, block.owner(starts)

    def pairs_of(self, chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the given chunks, linked pair, and how often it is linked there."""
        first = self.first.data
        n = first[chunk + 1] - first[chunk]
        at = ragged(first[chunk], n)
        return np.repeat(np.arange(len(chunk)), n), self.pairs.data[at], self.times.data[at]

    def sums(self, chunks: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """(sum of counts, links of the highest count) of every known chunk; those of ``chunks`` are right. They are kept for the same ``table``."""
        keys, documents, best = table
        if self.table is not table:
            self.table, self.done, self.sum = table, _Grown(bool), _Grown(np.int64, 2)
        new = len(self.known) - self.done.n
        self.done.add(np.zeros(new, bool))
        self.sum.add(np.zeros((new, 2), np.int64))
        todo = chunks[~self.done.data[chunks]]
        if len(todo) and len(keys):
            which, pair, times = self.pairs_of(todo)
            at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
            times = times * (keys[at] == pair)
            self.sum.data[todo] = np.column_stack([np.bincount(which, times * x[at], len(todo)) for x in (documents, best)])
        self.done.data[todo] = True
        return self.sum.data


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def worker_aligner(path_a: str, path_b: str, with_text: bool) -> Aligner:
    """This Python worker's aligner; the groups of a chunk are written out only if asked for."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    aligner = _ALIGNERS[path_a, path_b]
    if aligner.with_text != with_text:
        aligner.with_text = with_text
        aligner._forget()
    return aligner


def unbroken(aligner: Aligner, place: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Which of n texts have tokens: all their chunks give back their bytes."""
    has = np.zeros(n, bool)
    has[owner] = True
    has[owner[~aligner.whole.data[place]]] = False
    return has


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(pair, a, n, best): how many documents hold the ids a and b linked, pair = a * (ids of B) + b, and whether no other pair of a has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_aligner(path_a, path_b, False)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def combined() -> tuple[np.ndarray, np.ndarray]:
            pairs, which = np.unique(np.concatenate([w[0] for w in waiting]), return_inverse=True)
            return pairs, np.bincount(which, np.concatenate([w[1] for w in waiting])).astype(np.int64)

        def rows(pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(pairs // aligner.size_b), pa.array(n)], ["pair", "a", "n"])

        for batch in batches:
            for block in byte_blocks(batch.column("text")):
                place, owner = aligner.chunks(spaced(block))
                has = unbroken(aligner, place, owner, len(block))[owner]
                each = different(owner[has] * len(aligner.known) + place[has])
                owner, place = np.divmod(each, max(1, len(aligner.known)))
                which, pair, _ = aligner.pairs_of(place)
                held = different(owner[which] * (1 << 40) + pair) & ((1 << 40) - 1)
                waiting.append(np.unique(held, return_counts=True))
                if sum(len(w[0]) for w in waiting) > FLUSH:
                    waiting = [combined()]
                    if len(waiting[0][0]) > FLUSH // 2:
                        yield rows(*waiting.pop())
        if waiting:
            yield rows(*combined())

    parts = docs.select("text").mapInArrow(count, "pair bigint, a bigint, n bigint")
    totals = parts.groupBy("pair", "a").agg(F.sum("n").alias("n"))
    # an A id has as many pairs as B has ids at most
    return totals.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", most_pairs: int = MOST_PAIRS) -> DataFrame:
    """For each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    counts = stored(pair_counts(docs, path_a, path_b), scratch_path(spark, "pair-counts"))
    slices = max(1, -(-counts.count() // most_pairs))
    columns = ["n_a", "n_b", "n_groups", "n_links"]
    schema = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"

    def measured(number: int) -> DataFrame:
        part = counts.where(F.pmod(F.xxhash64("pair"), F.lit(slices)) == number).select("pair", "n", "best").toArrow()
        table = [part[c].to_numpy().astype(np.int64) for c in ("pair", "n", "best")]
        order = np.argsort(table[0])
        shared = spark.sparkContext.broadcast(tuple(x[order] for x in table))

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = worker_aligner(path_a, path_b, True)
            for batch in batches:
                for block in byte_blocks(batch.column("text")):
                    own = batch.slice(block.rows.start, len(block))
                    place, owner = aligner.chunks(spaced(block))
                    has = unbroken(aligner, place, owner, len(block))
                    sums = aligner.sums(different(place), shared.value)
                    place, owner = place[has[owner]], owner[has[owner]]
                    numbers = [np.bincount(owner, x[place], len(block)).astype(np.int64) for x in (*aligner.counts.data.T, sums[:, 1], sums[:, 0])]
                    bounds, parts = np.searchsorted(owner, np.arange(len(block) + 1)).tolist(), [aligner.text[i] for i in place.tolist()]
                    digests = [hashlib.sha256(";".join(parts[p:q]).encode()).hexdigest() if q > p else "" for p, q in zip(bounds[:-1], bounds[1:], strict=True)]
                    found = [own.column("row"), own.column("doc_id"), *map(pa.array, numbers), pa.array(digests, pa.string())]
                    yield pa.RecordBatch.from_arrays(found, ["row", "doc_id", *columns, "n_best", "count_sum", "groups_sha256"])

        return docs.mapInArrow(measure, schema)

    found = measured(0)
    if slices > 1:
        for number in range(1, slices):
            found = found.unionByName(stored(measured(number), scratch_path(spark, "pair-slice")))
        same = [F.max(c).alias(c) for c in ("doc_id", *columns, "groups_sha256")]
        found = found.groupBy("row").agg(*same, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found.select("doc_id", *columns, "n_best", "count_sum", "groups_sha256")
