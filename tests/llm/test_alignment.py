from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers as public
import sentencepiece
from tokenizers import Tokenizer

from clickloom.llm import alignment

ODD = ["", None, " ", "   ", "a ", " a", "  a  b ", "x\n\n y z\r\n", "\t a \n b", "it's 'll don't", "<s> a </s> <unk> <0x0A> <|endoftext|> b", "a▁b c", "été à Noël  ça", "日本 語 12 345 　 x", "ﬁ ½ Ａ é", "😀 😀😀 a😀 b", "x" * 500 + " y", "def f( x ):\r\n  return x;\r", "it's a a a it's", "\x00 a\x7f b"]


def brute(rows):
    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    alphabet = alignment.byte_alphabet()
    found, documents = [], Counter()
    for doc_id, text in rows:
        groups = []
        if text:
            a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
            bytes_a = [bytes(alphabet[c] for c in tokenizer.id_to_token(i)) for i in a]
            names = [pieces.id_to_piece(i) for i in b]
            bytes_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names, strict=True)]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends_a, ends_b, at = set(), set(), 0
                for ends, parts in ((ends_a, bytes_a), (ends_b, bytes_b)):
                    at = 0
                    for p in parts:
                        ends.add(at := at + len(p))
                cuts = sorted(ends_a & ends_b)
                place = {}
                for side, ids, parts in (("a", a, bytes_a), ("b", b, bytes_b)):
                    at = 0
                    for i, p in zip(ids, parts, strict=True):
                        place.setdefault(next(c for c in cuts if at < c), {"a": [], "b": []})[side].append(i)
                        at += len(p)
                groups = [place[c] for c in cuts]
        links = [(x, y) for g in groups for x in g["a"] for y in g["b"]]
        documents.update(set(links))
        found.append((doc_id, groups, links))
    best = Counter()
    for (a, _), n in documents.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, groups, links in found:
        digest = hashlib.sha256(";".join(f"{','.join(map(str, g['a']))}|{','.join(map(str, g['b']))}" for g in groups).encode()).hexdigest() if groups else ""
        out.append((str(doc_id), sum(len(g["a"]) for g in groups), sum(len(g["b"]) for g in groups), len(groups), len(links), sum(documents[x] == best[x[0]] for x in links), sum(documents[x] for x in links), digest))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def rows_of_texts():
    rng = random.Random(8)
    signs = "ab cd' .!éß\n\t\r　日1٣😀́   "
    words = "the of and tokenizer alignment pre-token naïve 2024 foo_bar http://x.y/z, it's “quoted” straße".split()
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(250)]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(100)]
    return [(i, t) for i, t in enumerate([*texts, *ODD, *ODD[:8]])] + [(None, "the end"), (3, "the end")]


def test_alignment_equals_brute_force(spark, monkeypatch):
    rows = rows_of_texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    paths = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
    want = brute(rows)
    assert got(alignment.aligned(docs, *paths)) == want
    assert got(alignment.aligned(docs, *paths, most_pairs=300)) == want  # counts sent in slices


def test_forgetting_changes_nothing():
    aligner = alignment.Aligner(public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model"))
    assert alignment.MOST_CHUNKS > 0 and aligner.size_b == 32_000
    import pyarrow as pa

    from clickloom.llm.batches import byte_blocks

    texts = [t for _, t in rows_of_texts()]
    seen = []
    for most in (alignment.MOST_CHUNKS, 3):
        alignment.MOST_CHUNKS, before = most, alignment.MOST_CHUNKS
        parts = []
        for block in byte_blocks(pa.array(texts), 200):
            place, owner = aligner.chunks(alignment.spaced(block))
            parts += [(block.rows.start + o, aligner.text[p]) for p, o in zip(place.tolist(), owner.tolist(), strict=True)]
        seen.append(parts)
        alignment.MOST_CHUNKS = before
    assert seen[0] == seen[1]


def test_alignment_of_odd_tables(spark, odd_docs):
    paths = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
    clashing = odd_docs.selectExpr("doc_id", "text", "lang as row", "score as n_a", "1 as pair", "2 as count_sum")
    short = clashing.where("length(text) < 1000 or text is null")
    assert got(alignment.aligned(short, *paths)) == brute([(r.doc_id, r.text) for r in short.collect()])
    assert alignment.aligned(clashing, *paths).count() == odd_docs.count()
    assert alignment.aligned(clashing.limit(0), *paths).collect() == []
