"""Near duplicates: banded MinHash, sequential Bayesian tests of signatures, exact check of full sets.

A document's set holds the 64-bit hashes of its different five-word shingles. Documents with equal sets are one node. Each node has a
signature of ``HASHES`` minima, cut into ``BANDS`` bands; nodes that share a band are candidates. A pair with similarity 0.75
shares none with a probability of 5e-6, less above.

Pairs are tested in three rounds, so that a large group of near copies needs no pairs among itself:

1. in every bucket each node with the bucket's least node. The links found give components;
2. in buckets of three or more nodes that still hold several components, of each component the pair to another one whose sketches agree most;
3. in those that hold several components after that, all pairs of nodes of different ones. The rows bring their sets along, so that a pair is
   decided where it is met and only links are written.

In rounds 2 and 3 large buckets are cut into blocks of about ``BLOCK_ROWS`` nodes, and a task compares two blocks; sizes and sketches (a byte
of each minimum) rule out most pairs.

So every pair in a bucket is either tested or already in one component. A test compares signatures in batches of ``BATCH`` minima and stops when
the posterior probability (uniform prior) that the similarity reaches 0.75 falls below ``MISS``. Survivors are decided on the full
sets: 100 * intersection >= 75 * union. Components come from alternating large and small stars.

Case: only A-Z are lowered. Words end at space and tab to carriage return. Fewer than five words are one shingle; no word or a null text is an
empty set, linked with nothing. Rows of one id and text are linked by their equal sets and share a component. A null id counts for a
component's id only if it has no other. Extra columns are ignored by ``mark_near_copies`` and kept by ``without_near_copies``, which judges each row by its own
text: rows of one id with different texts are different documents, and of a component one row stays, that of the smallest id (null ids last; of
equal ids with different sets the one of the smaller set hash).
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm import bloom
from clickloom.llm.batches import ASCII_SPACE, Block, binary_column, byte_blocks, column_bytes, list_offsets, lower_ascii, mixed, ragged, runs, span_hashes
from clickloom.session import scratch_path, stored

WORDS = 5
HASHES, BANDS = 128, 32
ROWS = HASHES // BANDS
SHARE, OF = 75, 100
BATCH = 16
MISS = 1e-7
SKETCH = 64
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 1 << 18
PAIRS_AT_ONCE = 1 << 20
_U64 = np.uint64
_STEPS = mixed(np.arange(1, WORDS + 1, dtype=np.uint64)) | _U64(1)
_FACTORS = mixed(np.arange(1000, 1000 + HASHES, dtype=np.uint64)) | _U64(1)


def shingle_hashes(block: Block, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a block's texts one after the other, repeats included, and where each text's start."""
    data = lower_ascii(block.data)
    starts, ends = runs(~ASCII_SPACE[data], block.offsets)
    words = span_hashes(data, starts, ends)
    first = np.searchsorted(starts, block.offsets)
    counts = np.diff(first)
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    at = ragged(first[:-1], shingles)
    length = np.repeat(np.minimum(counts, size), shingles)
    total = mixed(length.astype(np.uint64))
    for j in range(size):
        more = length > j
        total[more] += words[at[more] + j] * _STEPS[j]
    return mixed(total), list_offsets(shingles)


def shingle_sets(block: Block, size: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted set of each text."""
    hashes, offsets = shingle_hashes(block, size)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        own = np.sort(hashes[a:b])
        yield own[np.append(True, own[1:] != own[:-1])] if b > a else own


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima of HASHES hash functions, 32 bits each."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        np.minimum(low, np.multiply.outer(_FACTORS, shingles[i : i + 1024]).min(axis=1), out=low)
    return (low >> _U64(32)).astype(np.uint32)


def node_of(shingles: np.ndarray) -> int:
    """A 64-bit hash of a set."""
    sums = np.array([mixed(shingles).sum(), mixed(shingles ^ _U64(0x5851F42D4C957F2D)).sum()])
    return int(mixed(sums * np.array([1, 31], np.uint64)).sum().view(np.int64))


def prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, node, n, sig, sketch) of each row; without shingles, node and what follows n are null."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in byte_blocks(batch.column("text")):
                own = batch.slice(block.rows.start, len(block))
                nodes, counts, sigs, sketches = [], [], [], []
                for shingles in shingle_sets(block):
                    counts.append(len(shingles))
                    sig = signature(shingles) if len(shingles) else None
                    nodes.append(None if sig is None else node_of(shingles))
                    sigs.append(None if sig is None else sig.tobytes())
                    sketches.append(None if sig is None else sig[:SKETCH].astype(np.uint8).tobytes())
                columns = [own.column("row"), own.column("doc_id"), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), pa.array(sigs, pa.binary()), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "node", "n", "sig", "sketch"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(describe, "row bigint, doc_id bigint, node bigint, n bigint, sig binary, sketch binary")


def least_matches(miss: float = MISS, share: float = SHARE / OF) -> list[int]:
    """For each number of minima compared (BATCH, 2 BATCH, ...): with fewer matches the similarity is held to be below ``share``.

    With m of n matches and a uniform prior the similarity is Beta(m + 1, n - m + 1) distributed; that it reaches ``share`` has the probability that
    a binomial variable of n + 1 trials is m at most.
    """
    least = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * share**m * (1 - share) ** (n + 1 - m)
        least.append(m)
    return least


def bayes_test(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows of two signature matrices may be similar enough; most rows are given up after a batch or two."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for i, least in enumerate(least_matches()):
        part = slice(i * BATCH, (i + 1) * BATCH)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def _sizes_fit(a: str, b: str):
    return F.least(a, b) * OF >= F.greatest(a, b) * SHARE


class _Job:
    """The tables of one run, under one scratch folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str) -> None:
        self.docs, self.id_col, self.text_col, self.spark = docs, id_col, text_col, docs.sparkSession
        self.prints = self.keep(prints(docs, id_col, text_col), "prints")
        firsts = self.prints.where("node is not null").groupBy("node").agg(F.min("row").alias("row"))
        # the row number is unique, so a set with a third of all rows is not one task's work here
        self.nodes = self.keep(self.prints.join(firsts.select("row"), "row").select("node", "doc_id", "n", "sig", "sketch"), "nodes")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return stored(df, scratch_path(self.spark, f"near-{name}"))

    def buckets(self) -> DataFrame:
        """(band, node, leader, size) of bands that two or more nodes share."""
        bands = F.array(*(F.xxhash64(F.substring("sig", 4 * ROWS * i + 1, 4 * ROWS), F.lit(i)) for i in range(BANDS)))
        rows = self.nodes.select("node", F.explode(bands).alias("band"))
        shared = self.keep(rows.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("leader")).where("size > 1"), "bands")
        return self.keep(rows.join(shared, "band"), "members")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the different pairs (a, b) that are similar enough."""
        sigs = self.nodes.select("node", "n", "sig")
        left, right = (sigs.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")) for x in "ab")
        sized = pairs.join(left, "a").join(right, "b").where(_sizes_fit("n_a", "n_b"))

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).take(pa.array(bayes_test(x, y)))

        maybe = self.keep(sized.select("a", "b", "sig_a", "sig_b").mapInArrow(test, "a bigint, b bigint"), "survivors")
        sets = self.sets(maybe.select(F.col("a").alias("node")).union(maybe.select("b")).distinct())
        left, right = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")

        def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sure = []
                for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                    x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    sure.append(OF * both >= SHARE * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(sure, pa.bool_()))

        checked = maybe.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(confirm, "a bigint, b bigint")
        return self.keep(checked, "links")

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(node, shingles) of the wanted nodes. A Bloom filter of one document of each lets the other texts pass by unread."""
        wanted = self.keep(wanted.join(self.nodes.select("node", "doc_id"), "node"), "wanted")
        blocks = bloom.block_count(wanted.count())
        key = lambda c: F.xxhash64(F.col(c))
        bits = self.keep(bloom.key_filter(wanted.select(*bloom.cell(key("doc_id"), blocks))), "wanted-bits")
        rows = self.docs.select(F.col(f"`{self.id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{self.text_col}`").alias("text"))
        rows = bloom.tested(rows, key("doc_id"), bits, blocks, "maybe").where("maybe").select("text")

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in byte_blocks(batch.column("text")):
                    found = [x for x in shingle_sets(block) if len(x)]
                    nodes = pa.array([node_of(x) for x in found], pa.int64())
                    flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
                    yield pa.RecordBatch.from_arrays([nodes, binary_column(flat, list_offsets(np.array([len(x) for x in found], np.int64)))], ["node", "shingles"])

        sets = rows.mapInArrow(describe, "node bigint, shingles binary").join(wanted.select("node"), "node", "left_semi")
        return self.keep(sets.dropDuplicates(["node"]), "sets")

    def unsettled(self, members: DataFrame, components: DataFrame) -> DataFrame:
        """(band, node, component, n, sketch, blocks) of buckets of three or more nodes that hold several components."""
        rows = members.where("size > 2").join(components, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
        rows = self.keep(rows.join(self.nodes.select("node", "n", "sketch"), "node"), "placed")
        # a block has about BLOCK_ROWS nodes or BLOCK_SHINGLES shingles, whichever is less
        blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
        several = rows.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), blocks.alias("blocks")).where("low <> high")
        return self.keep(rows.join(self.keep(several.select("band", "blocks"), "several"), "band"), "unsettled")

    def best_pairs(self, rows: DataFrame) -> DataFrame:
        """Of each component in a bucket the pair (a, b) to another component whose sketches agree most."""
        return _in_blocks(rows, []).mapInArrow(lambda batches: pairs_in_buckets(batches, best_of_components), "a bigint, b bigint").distinct()

    def other_links(self, rows: DataFrame) -> DataFrame:
        """The links (a, b) between components. The rows bring their sets: what may be similar is decided in place."""
        sets = self.sets(rows.select("node").distinct())
        dealt = _in_blocks(rows.join(sets, "node"), ["shingles"])
        return self.keep(dealt.mapInArrow(lambda batches: pairs_in_buckets(batches, links_of_sets), "a bigint, b bigint").distinct(), "other-links")


def _in_blocks(rows: DataFrame, more: list[str]) -> DataFrame:
    """The rows of each bucket dealt to every pair (i, j) of its blocks."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component", "n", "sketch", *more)
    return rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")


def best_of_components(table: pa.Table, group: np.ndarray, x: np.ndarray, y: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Of each component in a group the pair (x, y) of rows, among those that leave it, that agrees most."""
    component = table["component"].to_numpy()
    which = np.tile(np.arange(len(x)), 2)
    leaves = np.concatenate([component[x], component[y]])
    order = np.lexsort((which, -agree[which], leaves, group[x][which]))
    keys = np.column_stack([group[x][which], leaves])[order]
    return np.unique(which[order[np.append(True, (keys[1:] != keys[:-1]).any(axis=1))]])


def links_of_sets(table: pa.Table, group: np.ndarray, x: np.ndarray, y: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Which of the pairs (x, y) of rows, ordered by x, are links."""
    data, bounds = column_bytes(table["shingles"])
    flat, bounds = np.frombuffer(data.tobytes(), np.uint64), bounds // 8
    linked = np.zeros(len(x), bool)
    heads = np.append(np.flatnonzero(np.append(True, x[1:] != x[:-1])), len(x))
    for a, b in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
        own, others = flat[bounds[x[a]] : bounds[x[a] + 1]], y[a:b]
        lengths = bounds[others + 1] - bounds[others]
        theirs = flat[ragged(bounds[others], lengths)]
        at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
        both = np.add.reduceat((own[at] == theirs).astype(np.int64), np.cumsum(lengths) - lengths)
        linked[a:b] = OF * both >= SHARE * (len(own) + lengths - both)
    return np.flatnonzero(linked)


def pairs_in_buckets(batches: Iterator[pa.RecordBatch], choose) -> Iterator[pa.RecordBatch]:
    """From rows ordered by (band, i, j): those pairs of each such group that ``choose`` takes among the possible ones."""
    least = least_sketch_matches()
    waiting: pa.Table | None = None

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        band, i, j, block, node, component, n = (table[c].to_numpy() for c in ("band", "i", "j", "block", "node", "component", "n"))
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
        change = np.flatnonzero((band[1:] != band[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        ends = np.repeat(np.append(change, len(band)), np.diff(np.append(np.append(0, change), len(band))))
        after = ends - np.arange(len(band)) - 1
        totals = np.cumsum(after)
        first = 0
        while first < len(band):
            last = max(first + 1, int(np.searchsorted(totals, (totals[first - 1] if first else 0) + PAIRS_AT_ONCE, "right")))
            rows = np.arange(first, last)
            x, y = np.repeat(rows, after[rows]), ragged(rows + 1, after[rows])
            fit = (component[x] != component[y]) & ((i[x] == j[x]) | (block[x] != block[y]))
            fit &= np.minimum(n[x], n[y]) * OF >= np.maximum(n[x], n[y]) * SHARE
            x, y = x[fit], y[fit]
            agree = np.concatenate([(sketch[x[k : k + 65536]] == sketch[y[k : k + 65536]]).sum(axis=1) for k in range(0, len(x), 65536)] or [np.zeros(0, int)])
            x, y, agree = x[agree >= least], y[agree >= least], agree[agree >= least]
            if len(x):
                chosen = choose(table, ends, x, y, agree)
                x, y = x[chosen], y[chosen]
            a, b = node[x], node[y]
            both = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])
            first = last

    for batch in batches:
        table = pa.Table.from_batches([batch])
        waiting = table if waiting is None else pa.concat_tables([waiting, table])
        keys = [waiting[c].to_numpy() for c in ("band", "i", "j")]
        whole = len(waiting) - int(np.argmin(np.append(np.logical_and.reduce([k[::-1] == k[-1] for k in keys]), False)))
        if whole:
            yield from pairs(waiting.slice(0, whole))
            waiting = waiting.slice(whole)
    if waiting is not None and len(waiting):
        yield from pairs(waiting)


def least_sketch_matches(miss: float = MISS) -> int:
    """Equal bytes of two sketches: fewer, and the similarity is held to be below the threshold."""
    tail, m = 0.0, -1
    while tail < miss:
        m += 1
        tail += comb(SKETCH + 1, m) * (SHARE / OF) ** m * (1 - SHARE / OF) ** (SKETCH + 1 - m)
    return m


def connected(links: DataFrame, keep) -> DataFrame:
    """(node, component) of the nodes of links (a, b); the component is its least node. ``keep`` stores a table."""
    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        # large star: link the larger neighbours of a node to its least neighbour or itself
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = keep(large, "large")
        # small star: link a node and its smaller neighbours to the least of them
        low = keep(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = keep(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now


def _placed(job: _Job) -> DataFrame:
    """(doc_id, n, node, component) of each row; without shingles the last two are null."""
    members = job.buckets()
    links = job.links(members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct())
    components = connected(links, job.keep)
    links = job.keep(links.unionByName(job.links(job.best_pairs(job.unsettled(members, components)))), "links")
    components = connected(links, job.keep)
    links = links.unionByName(job.other_links(job.unsettled(members, components)))
    components = connected(links, job.keep)
    placed = job.prints.select("doc_id", "n", "node").join(components, "node", "left").select("doc_id", "n", "node", F.coalesce("component", "node").alias("component"))
    return job.keep(placed, "components")


def mark_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id (the smallest id of its component) and kept."""
    job = _Job(docs, id_col, text_col)
    placed = _placed(job)
    ids = job.keep(placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id")), "ids")
    named = placed.join(ids, "component", "left")
    component_id = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, and all rows without a word. Texts that surely stay are not shuffled."""
    job = _Job(docs, id_col, text_col)
    rows = _placed(job).where("component is not null").select("component", "doc_id", "node")
    # the smallest id, then the smallest set hash: two steps, each with a fixed-size aggregate
    several = rows.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("least")).where("size > 1")
    several = job.keep(rows.join(several.select("component", "least"), "component"), "several")
    stays = several.where(F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("component").agg(F.min("node").alias("stays"))
    marks = several.join(stays, "component").select(F.col("doc_id").alias("__id"), F.col("node").alias("__set"), (F.col("doc_id").eqNullSafe(F.col("least")) & (F.col("node") == F.col("stays"))).alias("__stays"))
    marks = job.keep(marks.distinct(), "marks")
    blocks = bloom.block_count(marks.count())
    key = F.xxhash64(F.col(f"`{id_col}`").cast("bigint"))
    bits = job.keep(bloom.key_filter(marks.select(*bloom.cell(F.xxhash64("__id"), blocks))), "marked-bits")
    marked = bloom.tested(docs, key, bits, blocks, "__maybe")
    own = F.col("__own").eqNullSafe(F.col("__id")) & F.col("__node").eqNullSafe(F.col("__set"))
    rest = with_node(marked.where("__maybe").drop("__maybe"), text_col).withColumn("__own", F.col(f"`{id_col}`").cast("bigint")).join(marks, own, "left")
    alone = rest.where("__stays is null").select(docs.columns)
    # of rows with one id and one set, which are copies, one stays
    first = rest.where("__stays").dropDuplicates(["__own", "__node"]).select(docs.columns)
    return marked.where(~F.col("__maybe")).drop("__maybe").unionByName(alone).unionByName(first)


def with_node(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with the hash of each text's set as ``__node``, null without a word."""
    place = docs.columns.index(text_col)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in byte_blocks(batch.column(place)):
                own = batch.slice(block.rows.start, len(block))
                nodes = pa.array([node_of(s) if len(s) else None for s in shingle_sets(block)], pa.int64())
                yield pa.RecordBatch.from_arrays([*own.columns, nodes], [*own.schema.names, "__node"])

    return docs.mapInArrow(describe, T.StructType([*docs.schema.fields, T.StructField("__node", T.LongType())]))
