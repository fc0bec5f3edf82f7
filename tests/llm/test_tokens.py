from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as public
import pytest
import tiktoken
from tokenizers import Tokenizer

from clickloom.llm import bpe, chunks, packing, token_files
from clickloom.llm.batches import byte_blocks
from clickloom.session import scratch_path

ODD = ["", None, "  a  b ", "\n\n x  y  z", "it's 's we'll  '", "''s a'S", "<|endoftext|> a", "a <|startoftext|> b<|endoftext|>", "x<|endoftext|", "|>", "é́ ́a É", "a\x0b\x0c b\r\n", "\u3000 x \u00a0 y\u0085 z", "Aİ ß ΑΣ Σ", "日本 語 12 345", "x" * 3000 + " y", "  ", "\t", "a.b,c!?d 1.5%", "don't you'd I'm"]


@pytest.fixture
def texts(spark):
    rng = random.Random(5)
    signs = "ab cd' .!éß\n\t\u3000日1٣😀\u0301"
    rows = [(i, "".join(rng.choices(signs, k=rng.randint(0, 60)))) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), dict(rows)


def library_ids(name, texts):
    tokenizer = Tokenizer.from_file(public.path(name))
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in texts]


def test_token_files_round_trip(spark, texts):
    docs, by_id = texts
    manifest = token_files.write_token_files(docs, scratch_path(spark, "files"), public.path("word_bpe_49k.json"), length=16)
    rows = {r.doc_id: r for r in token_files.read_documents(manifest).collect()}
    start = 0
    for doc_id, ids in zip(sorted(by_id), library_ids("word_bpe_49k.json", [by_id[i] for i in sorted(by_id)]), strict=True):
        assert (rows[doc_id].start, rows[doc_id].n_tokens, rows[doc_id].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    for row in manifest.collect():
        file = token_files.SequenceFile(row.sequences)
        count = -(-row.n_tokens // 16)
        ids, mask = file.sequence(count - 1)
        mapped = file.source.size()
        assert not ids.flags.owndata and not mask.flags.owndata and abs(ids.ctypes.data - mask.ctypes.data) < mapped
        assert len(ids) == 16 and mask.sum() == row.n_tokens - 16 * (count - 1)
        assert (file.tokens(0, row.n_tokens)[-int(mask.sum()) :] == ids[mask]).all()


def test_token_files_of_odd_rows(spark, odd_docs):
    for docs in (odd_docs, odd_docs.limit(0)):
        manifest = token_files.write_token_files(docs, scratch_path(spark, "files"), public.path("word_bpe_49k.json"))
        rows = sorted(token_files.read_documents(manifest).collect(), key=lambda r: r.start)
        assert len(rows) == docs.count()
        assert [r.start for r in rows] == (np.cumsum([0, *(r.n_tokens for r in rows)])[:-1]).tolist()


def check_packing(pieces, want, length):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
    for doc_id, ids in want.items():
        own = sorted(by_doc[doc_id], key=lambda p: p.start)
        assert b"".join(p.ids for p in own) == ids.tobytes()
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(ids)}
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        total = sum(p.length for p in own)
        assert total <= length and total & (total - 1) == 0


def test_packing_keeps_every_id_once_without_padding(spark, texts):
    docs, by_id = texts
    pieces = packing.packed(docs, public.path("byte_bpe_50k.json"), length=64, shard_tokens=1500).collect()
    check_packing(pieces, dict(zip(by_id, library_ids("byte_bpe_50k.json", by_id.values()), strict=True)), 64)


def test_packing_of_odd_rows(odd_docs):
    rows = packing.packed(odd_docs, public.path("byte_bpe_50k.json")).collect()
    assert sum(p.length for p in rows) == sum(len(x) for x in library_ids("byte_bpe_50k.json", [r.text for r in odd_docs.collect()]))
    assert packing.packed(odd_docs.limit(0), public.path("byte_bpe_50k.json")).count() == 0


def test_packing_puts_documents_that_share_words_together():
    rng = np.random.default_rng(2)
    topics = [np.concatenate([rng.integers(10 * t, 10 * t + 10, 20), [500 + i]]) for i, t in enumerate(rng.permutation(np.arange(40) % 8))]
    seen = np.bincount(np.concatenate([np.unique(d) for d in topics]), minlength=600)
    idf = np.where(seen, np.log1p((40 - seen + 0.5) / (seen + 0.5)), 0)
    pieces = packing.packed_shard(topics, idf, 21.0, 64)
    first = [p for p in pieces if p[4] == 0 and p[1] == 0]
    mates = [(topics[a[0]][0] // 10, topics[b[0]][0] // 10) for a in first for b in pieces if b[3] == a[3] and 0 < b[4] < 22]
    assert np.mean([a == b for a, b in mates]) > 0.7


def test_packing_scores_terms_that_many_documents_have(spark):
    common = [f"alpha beta gamma delta {'x' * i}" for i in range(6)]
    other = [f"{i}{i}{i}" for i in range(6)]
    docs = spark.createDataFrame([(i, (common, other)[i % 2][i // 2]) for i in range(12)], "doc_id bigint, text string")
    rows = packing.packed(docs, public.path("byte_bpe_50k.json"), length=16).collect()
    first = {p.sequence_id: p.doc_id for p in rows if p.offset == 0}
    assert next(p.doc_id for p in sorted(rows, key=lambda p: p.offset) if p.offset and p.sequence_id == min(first)) % 2 == 0


def test_packing_asks_with_every_term_of_the_seed():
    rng = np.random.default_rng(4)
    documents = [np.array([*rng.integers(0, 60, 40), 99]) for _ in range(30)]
    seen = np.bincount(np.concatenate([np.unique(d[:-1]) for d in documents]), minlength=100)
    idf = np.where(seen, np.log1p((30 - seen + 0.5) / (seen + 0.5)), 0)
    index = packing.Index(documents, idf, 41.0)
    for seed in documents:
        want = []
        for d in documents:
            tf = np.bincount(d[:-1], minlength=100)[np.unique(seed[:-1])]
            want.append((idf[np.unique(seed[:-1])] * tf * 2.2 / (tf + 1.2)).sum())
        assert np.allclose(index.scores(next(i for i, d in enumerate(documents) if d is seed)), want)


def test_packing_breaks_ties_by_the_smaller_place():
    rng = np.random.default_rng(6)
    for _ in range(50):
        scores = rng.integers(0, 4, 100) / 2
        want = sorted((i for i in range(100) if scores[i] > 0), key=lambda i: (-scores[i], i))
        got = packing.nearest(scores, 24).tolist()
        assert len(got) >= min(24, len(want)) and got == want[: len(got)]
    assert packing.nearest(np.zeros(30)).tolist() == []


def test_an_encoder_with_little_memory_or_plain_specials(monkeypatch):
    texts = [t or "" for t in ODD] * 2
    whole = next(byte_blocks(pa.array(texts)))
    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    for specials in (True, False):
        tokenizer.encode_special_tokens = not specials
        monkeypatch.setattr(chunks, "MOST_IDS", 5)
        encoder, _ = chunks.worker_encoder(public.path("byte_bpe_50k.json"), specials)
        for _ in range(2):
            ids, offsets = encoder(whole)
            assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_places_related_documents_in_one_shard(spark):
    rng = random.Random(3)
    topics = [[f"w{t}x{rng.randint(0, 10**6)}" for _ in range(12)] for t in range(16)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(topics[i % 16], k=12))) for i in range(640)], "doc_id bigint, text string")
    rows = packing.packed(docs, public.path("byte_bpe_50k.json"), length=256, shard_tokens=4000).collect()
    assert len({p.sequence_id >> 32 for p in rows}) > 8
    mates = {}
    for p in rows:
        mates.setdefault(p.sequence_id, set()).add(p.doc_id)
    pairs = [(a, b) for own in mates.values() for a in own for b in own if a < b]
    assert np.mean([a % 16 == b % 16 for a, b in pairs]) > 0.7


def test_byte_bpe_equals_the_library(spark, texts):
    docs, by_id = texts
    path = public.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.round_trip(docs, path, public.PATTERN).collect():
        text = by_id[r.doc_id] or ""
        ids = np.array(library.encode_ordinary(text), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_byte_bpe_of_odd_rows(odd_docs):
    path = public.path("byte_bpe_50k.tiktoken")
    ids = bpe.encoded(odd_docs.withColumnRenamed("score", "ids"), path, public.PATTERN)
    for r in bpe.decoded(ids, path, public.PATTERN).collect():
        assert bytes(r.decoded).decode() == (r.text or "")
    assert bpe.round_trip(odd_docs.limit(0), path, public.PATTERN).count() == 0


def test_perfect_hash_is_minimal():
    hashes = np.unique(np.random.default_rng(4).integers(0, 1 << 63, 5000).astype(np.uint64))
    found, slots = bpe.PerfectHash.build(hashes)
    assert sorted(slots.tolist()) == list(range(len(hashes)))
    assert (found(hashes) == slots).all()


@pytest.mark.parametrize("most", [3, 40, 100_000])
def test_chunk_cache_forgets_and_grows(most):
    rng = random.Random(9)
    texts = [" ".join(rng.choices(["ab", "c,d", "été", "x" * 40, "7", "q\n"], k=rng.randint(0, 30))) for _ in range(400)]
    encode, _, _ = chunks.library_encoder(public.path("byte_bpe_50k.json"))
    encoder = chunks.ChunkEncoder(encode, most=most)
    expected = [ids[:-1] for ids in library_ids("byte_bpe_50k.json", texts)]
    for _ in range(2):  # the second time from what is known
        found = []
        for block in byte_blocks(pa.array(texts), 500):
            ids, offsets = encoder(block)
            found += np.split(ids, offsets[1:-1])
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(found, expected, strict=True))
        assert (np.diff(encoder.hashes.astype(object)) > 0).all() and sorted(encoder.places) == list(range(len(encoder.hashes)))
