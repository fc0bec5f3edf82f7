"""Approximate nearest neighbours by a permutation index.

Pivots are the centroids of a bounded sample (``SAMPLE`` vectors with the smallest hashes). A vector is represented by the order of all
pivots by nearness and posted in the inverted files of its ``POSTED`` nearest pivots. A query reads the files of the nearest half of the
pivots (more, if those hold too few vectors), ranks each file by footrule distance between the orders, and
reranks the best quarter (``LEAST_KEPT`` at least) by exact cosine in double precision.

Files are split by hash into blocks of about ``BLOCK_ROWS`` vectors, and queries into blocks as well, so that a file with a third of all vectors is
the work of many tasks. Every vector is indexed. Results: query_id, rank, vec_id, score.

Vectors that are null, zero, or hold a null or non-finite component take no part, nor do those whose length is not the commonest one (of
equally common lengths the largest). Rows with one id count as one: as a query the least vector, as a candidate the nearest. A query without candidates has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import scratch_path, stored

PIVOTS = 64
SAMPLE = 4096
POSTED = 2
PROBED_SHARE = 0.5
KEPT_SHARE = 0.25
LEAST_KEPT = 64
BLOCK_ROWS = 8192


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the vectors that take part, as a written table."""
    v = F.col(f"`{vector_col}`")
    rows = vectors.where(F.col(f"`{id_col}`").isNotNull() & F.coalesce(_usable(v), F.lit(False))).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.cast("array<double>").alias("v"))
    rows = stored(rows, scratch_path(vectors.sparkSession, "vectors"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("v") == (common[0].n if common else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def find_pivots(rows: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Centroids of the sample by spherical k-means; fewer where there are few vectors."""
    found = rows.orderBy(F.xxhash64("v", "id"), "id").limit(sample).select("v").collect()
    if not found:
        return np.zeros((0, 1))
    points = unit(np.array([r.v for r in found]))
    centres = points[: max(1, min(pivots, len(points) // 32))]
    for _ in range(6):
        nearest = (points @ centres.T).argmax(axis=1)
        sums = np.stack([points[nearest == i].sum(axis=0) if (nearest == i).any() else centres[i] for i in range(len(centres))])
        centres = unit(np.where((sums * sums).sum(axis=1, keepdims=True) > 0, sums, centres))
    return centres


def orders(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pivots of each vector from nearest to farthest, and the place of each pivot in that order."""
    by_nearness = np.argsort(-(unit(x) @ pivots.T), axis=1, kind="stable")
    place = np.empty_like(by_nearness)
    np.put_along_axis(place, by_nearness, np.arange(len(pivots))[None, :].repeat(len(x), axis=0), axis=1)
    return by_nearness, place


def ordered(rows: DataFrame, pivots: np.ndarray, lists: np.ndarray | None, enough: int) -> DataFrame:
    """(id, v, places, files): ``files`` are the nearest POSTED pivots or, given the sizes ``lists`` of the files, those that a query reads."""
    shared = rows.sparkSession.sparkContext.broadcast((pivots, lists))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, lists = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                own = batch.slice(at, 4096)
                near, places = orders(matrix(own.column("v")), pivots)
                if lists is None:
                    files = [x.tolist() for x in near[:, :POSTED]]
                else:
                    held = np.cumsum(lists[near], axis=1)
                    half = int(np.ceil(PROBED_SHARE * len(pivots)))
                    read = np.maximum(half, (held < POSTED * enough).sum(axis=1) + 1)
                    files = [x[:n].tolist() for x, n in zip(near, read, strict=True)]
                columns = [own.column("id"), own.column("v"), pa.array([p.tobytes() for p in places.astype(np.uint16)], pa.binary()), pa.array(files, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "v", "places", "files"])

    return rows.mapInArrow(place, "id bigint, v array<double>, places binary, files array<int>")


def search_block(posts: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k nearest of a block's vectors for each of its queries."""
    out = {"query_id": [], "vec_id": [], "score": []}
    if posts.num_rows and queries.num_rows:
        posts = posts.sort_by([("id", "ascending")])
        ids, x = posts["id"].to_numpy(), matrix(posts["v"].combine_chunks())
        places = np.frombuffer(b"".join(posts["places"].to_pylist()), np.uint16).reshape(len(ids), -1).astype(np.int16)
        norms = np.sqrt((x * x).sum(axis=1))
        for query, v, p in zip(queries["id"].to_pylist(), matrix(queries["v"].combine_chunks()), queries["places"].to_pylist(), strict=True):
            other = np.flatnonzero(ids != query)
            keep = max(LEAST_KEPT, k, int(np.ceil(KEPT_SHARE * len(other))))
            footrule = np.abs(places[other] - np.frombuffer(p, np.uint16).astype(np.int16)).sum(axis=1, dtype=np.int32)
            best = other[np.argsort(footrule, kind="stable")[:keep]]
            scores = (x[best] * v).sum(axis=1) / (norms[best] * np.sqrt((v * v).sum()))
            first: dict[int, float] = {}
            for i in np.lexsort((ids[best], -scores)).tolist():
                first.setdefault(int(ids[best[i]]), float(scores[i]))
                if len(first) == k:
                    break
            out["query_id"] += [query] * len(first)
            out["vec_id"] += first
            out["score"] += first.values()
    return pa.table(out, pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """The k nearest ``vectors`` of each of ``queries``, not counting the query's own id; ties go to the smaller id."""
    spark = vectors.sparkSession
    rows = usable_vectors(vectors, id_col, vector_col)
    asked = usable_vectors(queries, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    found = find_pivots(rows, pivots)
    if not len(found):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    asked = asked.where(F.size("v") == found.shape[1])
    posts = stored(ordered(rows, found, None, 0).withColumn("file", F.explode("files")).drop("files"), scratch_path(spark, "posts"))
    sizes = np.zeros(len(found), np.int64)
    for file, n in posts.groupBy("file").count().collect():  # a row for each pivot
        sizes[file] = n
    blocks = F.array(*(F.lit(max(1, -(-int(n) // BLOCK_ROWS))) for n in sizes))[F.col("file")]
    asked = stored(ordered(asked, found, sizes, k + 1).withColumn("file", F.explode("files")).drop("files"), scratch_path(spark, "queries"))
    query_blocks = max(1, -(-asked.select("id").distinct().count() // BLOCK_ROWS))
    posts = posts.withColumn("block", F.pmod(F.xxhash64("id"), blocks)).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - F.lit(1).cast("bigint")))).withColumn("query_block", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int"))
    keys = ["file", "block", "query_block"]
    search = lambda left, right: search_block(left, right, k)
    near = posts.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
