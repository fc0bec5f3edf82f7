from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np

from clickloom.llm import bloom, exact_dups, near_dups


def test_exact_copies_of_odd_rows(odd_docs):
    marked = exact_dups.mark_copies(odd_docs).collect()
    assert len(marked) == odd_docs.count()
    by_text = defaultdict(list)
    for r in odd_docs.collect():
        by_text[r.text or ""].append(r.doc_id)
    want = sorted(
        (str(i), str(keep), len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest())
        for t, ids in by_text.items()
        for keep in [max((i for i in ids if i is not None), default=None)]
        for i in ids
    )
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in marked) == want


def test_a_full_filter_changes_no_result(spark, prose):
    docs = spark.createDataFrame(prose, "doc_id bigint, text string")
    wide, narrow = (sorted(exact_dups.mark_copies(docs, most_blocks=n).collect()) for n in (bloom.MAX_BLOCKS, 1))
    assert wide == narrow and any(r.group_size > 1 for r in wide)


def test_only_possible_copies_shuffle(spark, prose):
    docs = spark.createDataFrame(prose, "doc_id bigint, text string")
    alone, repeated = exact_dups.split_by_filter(docs, "text")
    assert alone.count() + repeated.count() == len(prose)
    assert repeated.count() < len(prose) / 3
    assert "hashpartitioning" not in alone._jdf.queryExecution().executedPlan().toString()


def test_without_copies_keeps_the_largest_id_and_all_columns(odd_docs):
    left = exact_dups.without_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["1", "4", "5", "6", "7", "8", "9", "None", "10"])


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    own = list(range(len(rows)))

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                own[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[root(i)].append(doc_id)
    least = {k: min((d for d in ids if d is not None), default=None) for k, ids in groups.items()}
    return sorted((str(d), len(sets[i]), str(least[root(i)]), d == least[root(i)]) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


def test_near_copies_equal_brute_force(spark, prose):
    docs = spark.createDataFrame(prose, "doc_id bigint, text string").repartition(3)
    assert got(near_dups.mark_near_copies(docs)) == brute_components(prose)


def test_near_copies_of_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(near_dups.mark_near_copies(odd_docs)) == brute_components(rows)
    left = near_dups.without_near_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert {4, 8} & {r.doc_id for r in left.collect()} == set()
    assert {1, 2, 3, 5, 6, 7, 9, None, 10} <= {r.doc_id for r in left.collect()}


def test_one_row_of_each_component_stays(spark, prose):
    """Repeated and null ids, columns named like ours: of each component one row, of the smallest id, and every clean row stays."""
    base, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(1, base), (2, base + " x"), (2, other), (None, base + " y"), (None, "quite another text of six"), (3, base), (1, base), (None, None), (4, ""), (4, "")]
    rows += [(None, f"only null {other} z"), (None, f"only null {other} z z")] + [(i + 10, t) for i, t in prose]
    docs = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id bigint, text string, node string").selectExpr("*", "1 as component", "2 as band", "doc_id as row", "true as kept")
    left = near_dups.without_near_copies(docs)
    assert left.columns == docs.columns
    left = [(r.doc_id, r.text) for r in left.collect()]
    components = {}
    sets = [shingles(t) for _, t in rows]
    own = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = own[i], own[j]
                own = [b if x == a else x for x in own]
    for i, row in enumerate(rows):
        components.setdefault(own[i] if sets[i] else ("none", i), []).append(row)
    want = [min(members, key=lambda r: (r[0] is None, r[0] or 0))[0] for members in components.values()]
    assert sorted(map(str, want)) == sorted(str(i) for i, _ in left)
    assert len(left) == len(components) and (2, other) in left and (None, "quite another text of six") in left
    assert near_dups.without_near_copies(docs.limit(0)).collect() == []


def test_near_copies_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_dups.mark_near_copies(docs).count() == 0
    assert exact_dups.mark_copies(docs).count() == 0


def test_blocks_of_a_bucket_see_all_pairs(spark, prose, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", 8)
    docs = spark.createDataFrame(prose, "doc_id bigint, text string")
    assert got(near_dups.mark_near_copies(docs)) == brute_components(prose)


def test_near_copies_in_small_batches(spark, prose):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.getAll.get(key)
    spark.conf.set(key, 20_000)
    try:
        assert got(near_dups.mark_near_copies(spark.createDataFrame(prose, "doc_id bigint, text string").coalesce(2))) == brute_components(prose)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_bayes_bounds_miss_few():
    rng = np.random.default_rng(1)
    left = rng.integers(0, 1 << 32, (20_000, near_dups.HASHES), dtype=np.uint32)
    for share, low, high in ((0.75, 0.9999, 1), (0.2, 0, 0.01)):
        right = np.where(rng.random(left.shape) < share, left, left + np.uint32(1))
        assert low <= len(near_dups.bayes_test(left, right)) / len(left) <= high
