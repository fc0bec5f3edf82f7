"""Encode texts chunk by chunk, each different chunk once.

The public byte-level and word-level tokenizers split a text before they merge, and none of their pieces begins before
white space and ends after it but at the start of the piece, and none goes on from a letter to a sign. So a text can be cut before a run
of white space, and between a letter and a sign, without changing its ids. ``ChunkEncoder`` finds the cuts of a block of texts with array operations, hashes the chunks, has the
chunks that it has not met encoded, and lays out the ids by copying. The hashes it knows are a sorted array, not a dictionary. Its memory is bounded: it forgets all
chunks when it knows ``MOST_CHUNKS`` or ``MOST_IDS``. A text that holds a string of a special token is not cut but encoded whole, where such strings count.

A cut is made only before an ASCII white-space byte after a character that surely is none: an ASCII character, or one of
two UTF-8 bytes beyond U+00BF; or before an ASCII sign after an ASCII letter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from clickloom.llm.batches import ASCII_SPACE, Block, list_offsets, ragged, span_hashes

MOST_CHUNKS = 800_000
MOST_IDS = 8_000_000
AT_ONCE = 200
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
"""Texts to (all their ids one after the other, how many each has)."""


def chunk_bounds(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Start of each chunk, and the number of chunks of each text. An empty text has none."""
    data = block.data
    n = len(data)
    cut = np.zeros(n, bool)
    if n:
        space = ASCII_SPACE[data]
        solid = (data < 128) & ~space
        # a continuation byte after a lead byte C3 to DF
        two = np.zeros(n, bool)
        two[1:] = (data[1:] >= 128) & (data[1:] < 192) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
        cut[1:] = (space[1:] & (solid | two)[:-1]) | (_SIGN[data[1:]] & _LETTER[data[:-1]])
        firsts = block.offsets[:-1]
        cut[firsts[np.diff(block.offsets) > 0]] = True
    starts = np.flatnonzero(cut)
    return starts, np.diff(np.searchsorted(starts, block.offsets))


class ChunkEncoder:
    """``specials`` are strings that must not be cut; ``encode_whole`` has the ids of a text that holds one."""

    def __init__(self, encode: Encode, dtype: type = np.uint32, most: int = MOST_CHUNKS, specials: tuple[str, ...] = (), encode_whole: Callable[[str], list[int]] | None = None) -> None:
        self.encode, self.dtype, self.most = encode, dtype, most
        self.specials, self.encode_whole = [s.encode() for s in specials], encode_whole
        self._forget()

    def _forget(self) -> None:
        # hashes of the known chunks in order, and where each one stands in starts and counts
        self.hashes = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, self.dtype)
        self.starts = np.zeros(1 << 14, np.int64)
        self.counts = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _learn(self, block: Block, at: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = block.data.tobytes()
        ids, counts = self.encode([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        first, n = len(self.hashes), len(hashes)
        while len(self.starts) < first + n:
            self.starts, self.counts = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.counts, 2 * len(self.counts))
        while len(self.ids) < self.used + len(ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[first : first + n] = self.used + np.cumsum(counts) - counts
        self.counts[first : first + n] = counts
        self.used += len(ids)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.places = np.insert(self.places, at, np.arange(first, first + n))

    def __call__(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the block's texts, and where each text's ids start (one more entry at the end)."""
        if self.encode_whole is None or not (whole := self._with_specials(block)):
            return self._by_chunks(block)
        ids, offsets = self._by_chunks(block)
        parts = np.split(ids, offsets[1:-1])
        for i in whole:
            parts[i] = np.array(self.encode_whole(block.text(i)), self.dtype)
        return np.concatenate(parts), list_offsets(np.array([len(p) for p in parts], np.int64))

    def _with_specials(self, block: Block) -> list[int]:
        """The texts that hold a special string."""
        raw, found = block.data.tobytes(), set()
        for s in self.specials:
            at = raw.find(s)
            while at >= 0:
                i = int(block.owner(np.array([at]))[0])
                if at + len(s) <= block.offsets[i + 1]:
                    found.add(i)
                at = raw.find(s, at + 1)
        return sorted(found)

    def _by_chunks(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        starts, per_text = chunk_bounds(block)
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(block) + 1, np.int64)
        ends = np.append(starts[1:], len(block.data))
        different, first, which = np.unique(span_hashes(block.data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) + len(different) > self.most or self.used > MOST_IDS:
            self._forget()
        at = np.searchsorted(self.hashes, different)
        missing = np.ones(len(different), bool)
        inside = at < len(self.hashes)
        missing[inside] = self.hashes[at[inside]] != different[inside]
        if missing.any():
            self._learn(block, at[missing], different[missing], starts[first[missing]], ends[first[missing]])
            at = np.searchsorted(self.hashes, different)
        place = self.places[at][which]
        counts = self.counts[place].astype(np.int64)
        ids = self.ids[ragged(self.starts[place], counts)]
        return ids, list_offsets(counts)[list_offsets(per_text)]


def special_tokens(tokenizer: Tokenizer) -> dict[str, int]:
    return {token.content: i for i, token in tokenizer.get_added_tokens_decoder().items()}


def library_encoder(path: str) -> tuple[Encode, int, tuple[str, ...]]:
    """The tokenizers library's encoding by the vocabulary file at ``path``, the number of ids and the special tokens.

    Strings of special tokens in a text are ordinary text.
    """
    tokenizer = Tokenizer.from_file(path)
    special = special_tokens(tokenizer)
    mark, mark_id = next(iter(special.items()), (None, None))

    def plain(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenizer.encode_special_tokens = True
        found = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def together(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One call for many texts: a special token after each one keeps them apart."""
        tokenizer.encode_special_tokens = False
        ids = np.array(tokenizer.encode_batch_fast([mark.join(texts) + mark], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(ids == mark_id)
        return ids[ids != mark_id], np.diff(ends, prepend=-1) - 1

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for i in range(0, len(texts), AT_ONCE):
            some = texts[i : i + AT_ONCE]
            parts.append(plain(some) if mark is None or any(s in x for x in some for s in special) else together(some))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    return encode, tokenizer.get_vocab_size(), tuple(special)


@lru_cache(maxsize=1)
def _plain_tokenizer(path: str) -> Tokenizer:
    """Loaded only where a text holds a special token's string, as a vocabulary takes tens of megabytes."""
    return Tokenizer.from_file(path)


_ENCODERS: dict[tuple[str, bool], tuple[ChunkEncoder, int]] = {}


def worker_encoder(path: str, specials: bool = True) -> tuple[ChunkEncoder, int]:
    """This Python worker's encoder of a vocabulary file, and the number of ids.

    With ``specials``, as in a plain call of the library, a special token's string in a text has that token's id; without, it is ordinary text.
    """
    if (path, specials) not in _ENCODERS:
        encode, size, names = library_encoder(path)
        _ENCODERS[path, specials] = ChunkEncoder(encode, specials=names if specials else (), encode_whole=lambda text: _plain_tokenizer(path).encode(text, add_special_tokens=False).ids), size
    return _ENCODERS[path, specials]


def with_end_ids(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same lists, each with ``end_id`` appended."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, ids.dtype)
    lengths = np.diff(offsets)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), lengths)] = ids
    return out, offsets + np.arange(n + 1)
