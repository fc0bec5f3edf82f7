"""Jaccard join of word-shingle sets: subsets for light sets, inverted lists for heavy ones.

A document's set holds the 64-bit hashes of its different three-word shingles; documents with equal sets are one node. Two sets of n and m shingles
link if 100 * intersection >= 90 * union, that is if they share c(n, m) = ceil(90 * (n + m) / 190) shingles.

* **Light** sets, of ``x`` shingles at most: for each size m that a partner may have, all subsets of c(n, m) shingles are enumerated and
  keyed by both sizes. Two sets of these sizes share such a subset exactly if they link, so a key needs no pairs and no check: its members are tied to its least node.
* **Heavy** sets, of more than ``x``: their inverted lists are scanned. A set of n shingles is posted under its n - ceil(0.9 n) + 1 rarest ones (sets
  that link share one of those). Lists hold the light sets that a heavy one may link with, too.
* **The boundary** ``x`` is the one of least cost: rows enumerated below, list entries read above, both counted on the corpus. It is ``LIGHT_MOST`` at most, where
  a set has hundreds of subsets.

Rare is what lies in a rare one of ``CELLS`` cells, counted over all documents; any order gives the right result. A list of more than ``LIST_MOST`` sets, such as that of a passage that
stands in many documents, is not compared as a whole: its sets are posted by parts. Linked sets of sizes below a and b differ in d = (a + b) / 19
shingles at most, so of d + 1 parts, dealt by hash, one is equal. Hence sets that only share the passage do not meet.

What meets is compared in place, in blocks of ``BLOCK_ROWS`` for long lists, by size and by the parities of hash cells: the number of cells whose parity
differs is no more than the shingles that do, so this loses no link. What passes is decided on the full sets. To spare pairs within a large group of near copies, lists
of parts first test each set with their least; then only sets of different components are compared, and where more than ``PAIRS_A_ROW`` pairs
a row pass, only the best of each component, in up to ``ROUNDS`` rounds, before the rest. No link between different components is left out.

Case: only A-Z are lowered. Words end at space and tab to carriage return. Fewer than three words are one shingle; no word or a null text is an
empty set, linked with nothing. Equal sets share a component, so repeated rows do. A null id counts for a component's id only if it has no other. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import bloom
from clickloom.llm.batches import binary_column, byte_blocks, column_bytes, list_offsets, mixed, ragged
from clickloom.llm.near_dups import connected, node_of, shingle_hashes, shingle_sets
from clickloom.session import scratch_path, stored

WORDS = 3
SHARE, OF = 90, 100
LIGHT_MOST = 29
CELLS = 1 << 20
PIECE = 1 << 14
LIST_MOST = 64
SKETCH_BYTES = 128
BLOCK_ROWS = 1024
PAIRS_A_ROW = 4
PAIRS_AT_ONCE = 1 << 18
ROUNDS = 3
_U64 = np.uint64


def needed(n: int, m: int) -> int:
    """How many shingles sets of n and m must share."""
    return -(-SHARE * (n + m) // (SHARE + OF))


def posted(n: int) -> int:
    """Under how many shingles a set of n is posted."""
    return n - -(-SHARE * n // OF) + 1


def partner_sizes(n: int) -> list[int]:
    """The sizes of sets that may link with a different set of n."""
    return [m for m in range(-(-SHARE * n // OF), n * OF // SHARE + 1) if needed(n, m) < max(n, m)]


def subset_count(n: int) -> int:
    return sum(comb(n, needed(n, m)) for m in partner_sizes(n) if needed(n, m) <= n)


@cache
def _left_out(n: int, r: int) -> np.ndarray:
    return np.array(list(combinations(range(n), r)), np.int64).reshape(-1, r)


def subset_keys(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sets of one size, a row each: the keys of their subsets, and for each key whether both sizes are the same."""
    n = sets.shape[1]
    spread = mixed(sets)
    total = spread.sum(axis=1)
    keys, same = [np.zeros((len(sets), 0), np.uint64)], [np.zeros(0, bool)]
    for m in partner_sizes(n):
        if (c := needed(n, m)) <= n:
            out = spread[:, _left_out(n, n - c)].sum(axis=2) if n > c else np.zeros((len(sets), 1), np.uint64)
            salt = mixed(np.array([min(n, m) << 32 | max(n, m)], np.uint64))
            keys.append(mixed((total[:, None] - out) ^ salt))
            same.append(np.full(out.shape[1], m == n))
    return np.concatenate(keys, axis=1), np.concatenate(same)


def size_class(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each size, and where the classes begin: linked sets are in one class or in neighbouring ones."""
    begins = [1]
    while begins[-1] <= int(n.max(initial=0)) or len(begins) < 3:
        begins.append(begins[-1] * OF // SHARE + 1)
    begins += [begins[-1] * OF // SHARE + 1, (begins[-1] * OF // SHARE + 1) * OF // SHARE + 1]
    return np.searchsorted(begins, n, "right") - 1, np.array(begins, np.int64)


def part_keys(shingles: np.ndarray) -> np.ndarray:
    """The keys of a set's parts: those shared with its own class and the next, and those shared with the class before."""
    own, begins = size_class(np.array([len(shingles)]))
    keys = []
    for low in range(max(0, int(own[0]) - 1), int(own[0]) + 1):
        parts = (int(begins[low + 1]) + int(begins[low + 2]) - 2) * (OF - SHARE) // (OF + SHARE) + 1
        part = (mixed(shingles ^ _U64(0xA5A5A5A5A5A5A5A5)) % _U64(parts)).astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, part, mixed(shingles))
        keys.append(mixed(sums ^ mixed(np.arange(parts, dtype=np.uint64) + _U64(low << 32) + _U64(1))))
    return np.concatenate(keys)


def sketch_bytes(n: int) -> int:
    """About a bit for each shingle, a power of two."""
    return max(SKETCH_BYTES, 1 << max(0, (n - 1).bit_length() - 3))


def sketch(shingles: np.ndarray) -> bytes:
    """The parity of the number of shingles in each hash cell. Halves of a longer sketch add up to the shorter one."""
    cells = 8 * sketch_bytes(len(shingles))
    odd = np.bincount((shingles >> _U64(20)).astype(np.int64) & (cells - 1), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def cells_differing(data: np.ndarray, offsets: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each pair of rows of a binary column of sketches, in how many cells their parities differ."""
    width = np.diff(offsets)
    least = np.minimum(width[x], width[y])
    out = np.zeros(len(x), np.int64)
    for w in np.unique(least).tolist():
        chosen = np.flatnonzero(least == w)
        rows = np.unique(np.concatenate([x[chosen], y[chosen]]))
        folded = np.zeros((len(rows), w), np.uint8)
        for own in np.unique(width[rows]).tolist():
            some = np.flatnonzero(width[rows] == own)
            whole = data[ragged(offsets[rows[some]], np.full(len(some), own))].reshape(len(some), own // w, w)
            folded[some] = np.bitwise_xor.reduce(whole, axis=1)
        words = folded.view(np.uint64)
        for at in range(0, len(chosen), 65536):
            part = chosen[at : at + 65536]
            unlike = words[np.searchsorted(rows, x[part])] ^ words[np.searchsorted(rows, y[part])]
            out[part] = np.bitwise_count(unlike).sum(axis=1, dtype=np.int64)
    return out


def cell_counts(texts: DataFrame) -> np.ndarray:
    """How many (document, shingle) fall into each cell. Tasks send their counts in pieces, which are added in two steps; the driver gets CELLS numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for block in byte_blocks(batch.column("text")):
                hashes, _ = shingle_hashes(block, WORDS)
                total += np.bincount((hashes & _U64(CELLS - 1)).astype(np.int64), minlength=CELLS)
        if total.any():
            pieces = total.reshape(-1, PIECE)
            salt = int(total.sum()) & 31
            yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array([salt] * len(pieces), pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary())], ["piece", "salt", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for piece, salt, counts in zip(*(batch.column(c).to_pylist() for c in ("piece", "salt", "counts")), strict=True):
                sums[piece, salt] = sums.get((piece, salt), 0) + np.frombuffer(counts, np.int64)
        if sums:
            pieces, salts = zip(*sums, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.int32()), pa.array(salts, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["piece", "salt", "counts"])

    schema = "piece int, salt int, counts binary"
    parts = texts.mapInArrow(count, schema).repartition("piece", "salt").mapInArrow(add, schema)
    found = parts.withColumn("salt", F.lit(0)).repartition("piece").mapInArrow(add, schema).collect()
    total = np.zeros((CELLS // PIECE, PIECE), np.int64)
    for r in found:
        total[r.piece] += np.frombuffer(r.counts, np.int64)
    return total.ravel()


def _lists(values: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([*values, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(list_offsets(np.array([len(v) for v in values], np.int64)), pa.int32()), pa.array(flat))


def prints(docs: DataFrame, load: np.ndarray) -> DataFrame:
    """(row, doc_id, node, n, rare, small, sketch): ``rare`` are the shingles a set is posted under, ``small`` the whole of a set that may be light."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(load, np.iinfo(np.uint32).max).astype(np.uint32))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = shared.value
        for batch in batches:
            for block in byte_blocks(batch.column("text")):
                own = batch.slice(block.rows.start, len(block))
                sets = list(shingle_sets(block, WORDS))
                rare = []
                for s in sets:
                    weight = load[(s & _U64(CELLS - 1)).astype(np.int64)]
                    if (k := posted(len(s)) if len(s) else 0) < len(s):
                        near = np.flatnonzero(weight <= np.partition(weight, k - 1)[k - 1])
                        rare.append(s[near[np.lexsort((s[near], weight[near]))[:k]]])
                    else:
                        rare.append(s)
                small = [s if len(s) <= LIGHT_MOST else s[:0] for s in sets]
                nodes = pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())
                columns = [own.column("row"), own.column("doc_id"), nodes, pa.array([len(s) for s in sets], pa.int64()), _lists(rare), _lists(small), pa.array([sketch(s) for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "node", "n", "rare", "small", "sketch"])

    return docs.mapInArrow(describe, "row bigint, doc_id bigint, node bigint, n bigint, rare array<bigint>, small array<bigint>, sketch binary")


def light_rows(nodes: DataFrame) -> DataFrame:
    """(key, node, n, same) of the subsets of light sets."""

    def enumerate_subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids = batch.column("n").to_numpy(), batch.column("node").to_numpy()
            flat, first = batch.column("small").flatten().to_numpy().view(np.uint64), list_offsets(sizes)
            for n in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == n)
                step = max(1, PAIRS_AT_ONCE // max(1, subset_count(n)))
                for at in range(0, len(rows), step):
                    some = rows[at : at + step]
                    keys, same = subset_keys(flat[ragged(first[some], sizes[some])].reshape(len(some), n))
                    k = keys.shape[1]
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(ids[some], k)), pa.array(np.full(keys.size, n)), pa.array(np.tile(same, len(some)))], ["key", "node", "n", "same"])

    return nodes.select("node", "n", "small").mapInArrow(enumerate_subsets, "key bigint, node bigint, n bigint, same boolean")


def ties(rows: DataFrame) -> DataFrame:
    """(a, b): each member of a subset's key with the least one. A key of two sizes ties only if it has members of both."""
    keys = rows.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("top"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("same").alias("same"))
    keys = keys.where("a < top and (same or low < high)").select("key", "a")
    return rows.join(keys, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()


def boundary(light: list[int], heavy: list[int]) -> int:
    """The largest light size of least cost, from the cost of each size as a light and as a heavy one."""
    costs = [sum(light[: x + 1]) + sum(heavy[x + 1 :]) for x in range(len(light))]
    return max(x for x in range(len(light)) if costs[x] == min(costs))


def near_pairs(table: pa.Table, x0: int, everything: bool) -> pa.RecordBatch:
    """Pairs that pass, of rows ordered by (key, i, j, n): a, b and, where a group has too many, its key as ``open``."""
    key, i, j, block, node, component, n = (table[c].to_numpy() for c in ("key", "i", "j", "block", "node", "component", "n"))
    data, offsets = column_bytes(table["sketch"])
    group = np.append(0, np.cumsum((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
    place = (group << 32) + n
    ends = np.searchsorted(place, (group << 32) + n * OF // SHARE, "right")
    partners = np.maximum(ends - np.arange(len(n)) - 1, 0)
    totals = np.append(0, np.cumsum(partners))
    found = [(np.zeros(0, np.int64),) * 3]
    first = 0
    while first < len(n):
        last = max(first + 1, int(np.searchsorted(totals, totals[first] + PAIRS_AT_ONCE, "right")) - 1)
        rows = np.arange(first, last)
        x, y = np.repeat(rows, partners[rows]), ragged(rows + 1, partners[rows])
        fit = (component[x] != component[y]) & ((i[x] == j[x]) | (block[x] != block[y])) & (n[y] > x0)
        x, y = x[fit], y[fit]
        differ = cells_differing(data, offsets, x, y)
        fit = differ * (OF + SHARE) <= (n[x] + n[y]) * (OF - SHARE)
        found.append((x[fit], y[fit], differ[fit]))
        first = last
    x, y, differ = (np.concatenate(f) for f in zip(*found, strict=True))
    many = np.bincount(group[x], minlength=group[-1] + 1) > PAIRS_A_ROW * np.bincount(group)
    if everything:
        many[:] = False
    kept = ~many[group[x]]
    if len(rest := np.flatnonzero(~kept)):
        # of each component in such a group the pair that leaves it and differs least
        which = np.tile(rest, 2)
        leaves = np.concatenate([component[x[rest]], component[y[rest]]])
        order = np.lexsort((which, differ[which], leaves, group[x[which]]))
        keys = np.column_stack([group[x[which]], leaves])[order]
        kept[which[order[np.append(True, (keys[1:] != keys[:-1]).any(axis=1))]]] = True
    a, b = node[x[kept]], node[y[kept]]
    both = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)]), axis=0)
    opened = np.unique(key[np.isin(group, np.flatnonzero(many))])
    columns = [np.concatenate([both[:, 0], np.zeros(len(opened), np.int64)]), np.concatenate([both[:, 1], np.zeros(len(opened), np.int64)]), np.concatenate([np.zeros(len(both), np.int64), opened])]
    is_pair = np.arange(len(columns[0])) < len(both)
    return pa.RecordBatch.from_arrays([pa.array(columns[0], mask=~is_pair), pa.array(columns[1], mask=~is_pair), pa.array(columns[2], mask=is_pair)], ["a", "b", "open"])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], work: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hand rows ordered by ``keys`` on in tables that end where a group ends."""
    waiting: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        waiting = table if waiting is None else pa.concat_tables([waiting, table])
        same = np.logical_and.reduce([(c := waiting[k].to_numpy())[::-1] == c[-1] for k in keys])
        if whole := len(waiting) - int(np.argmin(np.append(same, False))):
            yield work(waiting.slice(0, whole))
            waiting = waiting.slice(whole)
    if waiting is not None and len(waiting):
        yield work(waiting)


class _Join:
    """The tables of one run, under scratch folders."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str) -> None:
        self.spark = docs.sparkSession
        self.docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
        self.prints = self.keep(prints(self.docs, cell_counts(self.docs.select("text"))), "prints")
        firsts = self.prints.where("node is not null").groupBy("node").agg(F.min("row").alias("row"))
        # the row number is unique, so a set with a third of all rows is not one task's work here
        self.nodes = self.keep(self.prints.join(firsts.select("row"), "row").select("node", "doc_id", "n", "rare", "small", "sketch"), "nodes")
        self.sets: DataFrame | None = None

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return stored(df, scratch_path(self.spark, f"join-{name}"))

    def cut(self, lists: DataFrame, posts: DataFrame) -> int:
        """The boundary between light and heavy sets."""
        small = posts.where(F.col("n") <= LIGHT_MOST).join(lists, "key", "left").groupBy("n").agg(F.sum(F.coalesce("size", F.lit(1))).alias("read"))
        read = {r.n: int(r.read) for r in small.collect()}  # a row for each small size
        held = {r.n: r["count"] for r in self.nodes.where(F.col("n") <= LIGHT_MOST).groupBy("n").count().collect()}
        sizes = range(LIGHT_MOST + 1)
        return boundary([held.get(n, 0) * subset_count(n) for n in sizes], [read.get(n, 0) for n in sizes])

    def again(self, wanted: DataFrame, column: str, kind: str, value: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
        """(node, column) of the wanted nodes, computed from their texts. A Bloom filter of one document of each lets the others pass by unread."""
        wanted = self.keep(wanted.join(self.nodes.select("node", "doc_id"), "node"), "wanted")
        blocks = bloom.block_count(wanted.count())
        bits = self.keep(bloom.key_filter(wanted.select(*bloom.cell(F.xxhash64("doc_id"), blocks))), "wanted-bits")
        rows = bloom.tested(self.docs.select("doc_id", "text"), F.xxhash64("doc_id"), bits, blocks, "maybe").where("maybe").select("text")

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in byte_blocks(batch.column("text")):
                    found = [s for s in shingle_sets(block, WORDS) if len(s)]
                    values = [value(s) for s in found]
                    flat = np.concatenate([*values, np.zeros(0, np.uint64)])
                    out = _lists(values) if kind == "array<bigint>" else binary_column(flat, list_offsets(np.array([len(v) for v in values], np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in found], pa.int64()), out], ["node", column])

        # rows of one set are alike; those of a large group of copies meet only after they are thinned to the wanted nodes
        found = rows.mapInArrow(describe, f"node bigint, {column} {kind}").join(wanted.select("node"), "node", "left_semi")
        return self.keep(found.dropDuplicates(["node"]), column)

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that link, decided on full sets."""
        pairs = self.keep(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("node"), "node", "left_anti")
        if not wanted.isEmpty():
            more = self.again(wanted, "shingles", "binary", lambda s: s)
            self.sets = more if self.sets is None else self.sets.unionByName(more)
        if self.sets is None:
            return pairs
        left, right = (self.sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")

        def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sure = []
                for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                    x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                    both = int((x[at] == y).sum())
                    sure.append(OF * both >= SHARE * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(sure, pa.bool_()))

        checked = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(decide, "a bigint, b bigint")
        return self.keep(checked, "links")

    def passing(self, pairs: DataFrame) -> DataFrame:
        """Those of the different pairs (a, b) whose sketches do not rule them out."""
        left, right = (self.nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")
        fit = F.least("n_a", "n_b") * OF >= F.greatest("n_a", "n_b") * SHARE

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                k = batch.num_rows
                data, offsets = column_bytes(pa.concat_arrays([batch.column("sketch_a"), batch.column("sketch_b")]))
                differ = cells_differing(data, offsets, np.arange(k), np.arange(k) + k)
                sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
                yield batch.select(["a", "b"]).filter(pa.array(differ * (OF + SHARE) <= sizes * (OF - SHARE)))

        joined = pairs.join(left, "a").join(right, "b").where(fit).select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
        return joined.mapInArrow(test, "a bigint, b bigint")

    def meetings(self, members: DataFrame, components: DataFrame | None, x0: int, everything: bool) -> DataFrame:
        """(a, b, open) of the lists that hold several components."""
        rows = members.withColumn("component", F.col("node"))
        if components is not None:
            rows = members.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
        blocks = F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int")
        several = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("n").alias("most"), blocks.alias("blocks"))
        rows = rows.join(several.where((F.col("low") < F.col("high")) & (F.col("most") > x0)).select("key", "blocks"), "key")
        rows = rows.join(self.nodes.select("node", "sketch"), "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component", "n", "sketch")
        dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n", "node")
        found = dealt.mapInArrow(lambda batches: whole_groups(batches, ("key", "i", "j"), lambda t: near_pairs(t, x0, everything)), "a bigint, b bigint, open bigint")
        return self.keep(found.distinct(), "meetings")


def mark_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles and component_id, the smallest id that links reach."""
    job = _Join(docs, id_col, text_col)
    posts = job.nodes.select("node", "n", F.explode("rare").alias("key"))
    lists = job.keep(posts.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "lists")
    x0 = job.cut(lists, posts)
    found = job.keep(ties(job.keep(light_rows(job.nodes.where((F.col("n") > 0) & (F.col("n") <= x0))), "subsets")), "ties")

    posts = posts.where(F.col("n") * OF >= (x0 + 1) * SHARE).join(lists, "key")
    members = job.keep(posts.select("key", "node", "n", "size"), "members")
    crowded = members.where(F.col("size") > LIST_MOST).select("node").distinct()
    members = members.where(F.col("size") <= LIST_MOST).select("key", "node", "n")
    if not crowded.isEmpty():
        parts = job.again(crowded, "parts", "array<bigint>", part_keys).join(job.nodes.select("node", "n"), "node").select(F.explode("parts").alias("key"), "node", "n")
        shared = parts.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("leader")).where("size > 1")
        parts = job.keep(parts.join(shared, "key"), "parts")
        led = parts.where((F.col("size") > LIST_MOST) & (F.col("node") != F.col("leader"))).select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        found = found.unionByName(job.confirmed(job.passing(led)))
        members = members.unionByName(parts.select("key", "node", "n"))

    components = None if found.isEmpty() else connected(found, job.keep)
    for number in range(ROUNDS + 1):
        met = job.meetings(members, components, x0, everything=number == ROUNDS)
        new = job.confirmed(met.where("a is not null").select("a", "b"))
        if not new.isEmpty():
            found = job.keep(found.unionByName(new), "found")
            components = connected(found, job.keep)
        opened = met.where("open is not null").select(F.col("open").alias("key")).distinct()
        if opened.isEmpty():
            break
        members = job.keep(members.join(opened, "key", "left_semi"), "open")

    placed = job.prints.select("doc_id", "n", "node")
    placed = placed.withColumn("component", F.col("node")) if components is None else placed.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = job.keep(placed.select("doc_id", "n", "component"), "components")
    ids = job.keep(placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id")), "ids")
    named = placed.join(ids, "component", "left")
    component_id = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), component_id.alias("component_id"))
