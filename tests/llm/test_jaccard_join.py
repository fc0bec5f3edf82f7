from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from clickloom.llm import jaccard_join
from tests.llm.conftest import WORDS


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    own = list(range(len(rows)))

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                own[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[root(i)].append(doc_id)
    least = {k: min((d for d in ids if d is not None), default=None) for k, ids in groups.items()}
    return sorted((str(d), len(sets[i]), str(least[root(i)])) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


@pytest.fixture
def corpus():
    """Texts of 4 to 400 words with chains of near copies, most of them at the ends, where an edit changes one or two shingles, and a passage in a third of all."""
    rng = random.Random(4)
    passage = rng.choices(WORDS, k=60)
    texts = []
    for i in range(160):
        words = rng.choices(WORDS, k=rng.choice((4, 9, 11, 13, 19, 21, 25, 29, 31, 33, 60, 150, 400)))
        if i % 3 == 0:
            words = words[: len(words) // 2] + passage + words[len(words) // 2 :]
        texts.append(" ".join(words))
    for i in range(90):
        words = texts[i].split()
        for _ in range(4):
            words = list(words)
            if (kind := rng.randrange(4)) == 0:
                words[-1] = rng.choice(WORDS)
            elif kind == 1:
                words.append(rng.choice(WORDS))
            elif kind == 2:
                words = words[1:]
            else:
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            texts.append(" ".join(words))
    base = rng.choices(WORDS, k=200)
    for _ in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        texts.append(" ".join(words))
    texts += texts[:30]
    rng.shuffle(texts)
    return [(i * 2 + 5, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("limits", "boundary"), [({}, None), ({"LIST_MOST": 4, "BLOCK_ROWS": 8}, 0), ({"LIST_MOST": 2, "BLOCK_ROWS": 16, "PAIRS_A_ROW": 0}, 29)])
def test_join_equals_brute_force(spark, corpus, monkeypatch, limits, boundary):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard_join, name, value)
    if boundary is not None:
        monkeypatch.setattr(jaccard_join, "boundary", lambda light, heavy: boundary)
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string").repartition(3)
    want = brute_components(corpus)
    assert len({c for _, _, c in want}) < len(want) - 100
    assert got(jaccard_join.mark_components(docs)) == want


def test_join_of_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    clashing = odd_docs.selectExpr("doc_id", "text", "lang as node", "score as n", "1 as row", "2 as key", "3 as component")
    assert got(jaccard_join.mark_components(clashing)) == brute_components(rows)
    assert jaccard_join.mark_components(odd_docs.limit(0)).count() == 0


def test_subsets_are_shared_exactly_by_linked_sets():
    rng = np.random.default_rng(2)
    for n in range(1, 24):
        for m in range(n, 26):
            for both in range(max(0, n - 3), n + 1):
                common = rng.integers(0, 1 << 63, both, dtype=np.uint64)
                a, b = (np.sort(np.append(common, rng.integers(0, 1 << 63, k - both, dtype=np.uint64))) for k in (n, m))
                found = [dict(zip(keys.ravel().tolist(), same.tolist(), strict=True)) for keys, same in map(jaccard_join.subset_keys, (a[None], b[None]))]
                # a key of two sizes ties members of both only, so between two sets of one size it says nothing
                tied = any(found[0][k] or n != m for k in found[0].keys() & found[1].keys())
                linked = 100 * both >= 90 * (n + m - both)
                if not n == m == both:
                    assert tied == linked, (n, m, both)
        assert len(found[0]) == jaccard_join.subset_count(n)


def test_linked_sets_share_a_part_and_pass_the_sketch():
    rng = np.random.default_rng(3)
    for n in (*range(9, 60), 300, 999, 5000):
        pool = np.unique(rng.integers(0, 1 << 63, 2 * n + 50, dtype=np.uint64))
        rng.shuffle(pool)
        for m in {n, n + n // 20, n * 10 // 9}:
            both = jaccard_join.needed(n, m)
            if both > n:
                continue
            a, b = np.sort(pool[:n]), np.sort(np.append(pool[:both], pool[n : n + m - both]))
            assert set(jaccard_join.part_keys(a).tolist()) & set(jaccard_join.part_keys(b).tolist())
            sketches = [np.frombuffer(jaccard_join.sketch(s), np.uint8) for s in (a, b)]
            offsets = np.cumsum([0, *map(len, sketches)])
            differ = jaccard_join.cells_differing(np.concatenate(sketches), offsets, np.array([0]), np.array([1]))[0]
            assert differ <= len(np.setxor1d(a, b)) <= (n + m) // 19


def test_boundary_is_the_cheapest():
    assert jaccard_join.boundary([0, 1, 50], [0, 9, 9]) == 1
    assert jaccard_join.boundary([0, 5, 1], [0, 4, 9]) == 2
    assert jaccard_join.boundary([0] * 30, [0] * 30) == 29
