"""Language identification by the nearest of several centroids per language.

A text is the TF-IDF vector of its byte trigrams (letters only, other characters are gaps), hashed into ``SLOTS`` and scaled to
length one. Document frequencies come from all training rows. For each language a bounded sample of training rows
(about ``SAMPLE`` at most, evenly by hash) is clustered into ``CENTROIDS`` centroids by spherical k-means. A text gets the language of
the centroid with the largest cosine. It is rejected when its cosine distance is beyond the language's radius: the lowest cosine
of the language's sample, divided by four, is accepted, so that rare but proper texts stay.

Null texts and texts without a letter get ``und``, score 0, and are rejected. Rows with a null language teach nothing. With no training
row at all every text is ``und``. Ties go to the language first in order. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.batches import Block, binary_column, byte_blocks, lower_ascii
from clickloom.session import scratch_path, stored

SLOTS = 4096
SAMPLE = 300
CENTROIDS = 4
ROUNDS = 8
BLOCK = 1 << 19
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ASCII = np.zeros(256, bool)
_ASCII[[*range(65, 91), *range(97, 123)]] = True


def trigram_counts(block: Block) -> np.ndarray:
    """A row of SLOTS counts for each text of a block."""
    n = len(block)
    signs = np.where(_LETTER[block.data], lower_ascii(block.data), 32)
    # a gap before and after each text, so that no trigram joins two texts
    lengths = np.diff(block.offsets)
    padded = np.full(len(signs) + 2 * n, 32, np.uint32)
    at = np.arange(len(signs)) + np.repeat(2 * np.arange(n) + 1, lengths)
    padded[at] = signs
    if len(padded) < 3:
        return np.zeros((n, SLOTS), np.float32)
    a, b, c = padded[:-2], padded[1:-1], padded[2:]
    slot = (a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)) >> np.uint32(20)
    owner = np.repeat(np.arange(n), lengths + 2)[:-2]
    ends = np.cumsum(lengths + 2)
    proper = (b != 32) | ((a != 32) & (c != 32))
    proper[ends[:-1] - 1] = False
    proper[ends[:-1] - 2] = False
    cells = np.bincount((owner * SLOTS + slot)[proper], minlength=n * SLOTS)
    return cells.reshape(n, SLOTS).astype(np.float32)


def has_letter(block: Block) -> np.ndarray:
    seen = np.zeros(len(block), bool)
    seen[np.unique(block.owner(np.flatnonzero(_ASCII[block.data])))] = True
    wide = np.zeros(len(block), bool)
    wide[np.unique(block.owner(np.flatnonzero(block.data >= 128)))] = True
    for i in np.flatnonzero(wide & ~seen):
        seen[i] = any(sign.isalpha() for sign in block.text(i))
    return seen


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts) * idf
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(norms > 0, norms, 1)


def document_frequencies(texts: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many of the texts each slot occurs, and how many texts there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for block in byte_blocks(batch.column(0), BLOCK):
                seen += (trigram_counts(block) > 0).sum(axis=0)
                texts += len(block)
        yield pa.RecordBatch.from_pydict({"slot": np.arange(-1, SLOTS, dtype=np.int32), "n": np.concatenate([[texts], seen])})

    rows = texts.select(f"`{text_col}`").mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(SLOTS + 1, np.int64)
    for slot, n in rows:  # SLOTS + 1 of them
        found[slot + 1] = n
    return found[1:], int(found[0])


@dataclass(frozen=True)
class LanguageModel:
    """``centroids`` has a row for each centroid, ``owner`` its language's place in ``languages``, ``floor`` the least cosine that is accepted."""

    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floor: np.ndarray

    def predict(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text the language's place (-1: none), the cosine and whether it is rejected."""
        lettered = has_letter(block)
        if not self.languages:
            return np.full(len(block), -1), np.zeros(len(block)), np.ones(len(block), bool)
        near = weighted(trigram_counts(block), self.idf) @ self.centroids.T
        best = near.argmax(axis=1)
        cosine = np.clip(near[np.arange(len(block)), best], 0, 1).astype(float)
        language = self.owner[best]
        return np.where(lettered, language, -1), np.where(lettered, cosine, 0.0), ~lettered | (cosine < self.floor[language])


def clustered(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; starts from the vector nearest the mean, then each time from the one farthest from all starts."""
    starts = [int((vectors @ vectors.mean(axis=0)).argmax())]
    while len(starts) < min(k, len(vectors)):
        starts.append(int((vectors @ vectors[starts].T).max(axis=1).argmin()))
    centres = vectors[starts]
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(axis=1)
        sums = np.stack([vectors[nearest == i].sum(axis=0) if (nearest == i).any() else centres[i] for i in range(len(centres))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = sums / np.where(norms > 0, norms, 1)
    return centres.astype(np.float32)


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> LanguageModel:
    """Learn from the rows whose text and language are not null."""
    rows = rows.where(F.col(f"`{text_col}`").isNotNull() & F.col(f"`{lang_col}`").isNotNull()).select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    seen, texts = document_frequencies(rows, "text")
    idf = np.log((1 + texts) / (1 + seen)).astype(np.float32) + np.float32(1)
    pick = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30))
    sizes = stored(rows.groupBy("lang").agg((F.lit(sample * float(1 << 30)) / F.count(F.lit(1))).alias("below")), scratch_path(rows.sparkSession, "languages"))
    chosen = rows.select("lang", "text", pick.alias("pick")).join(sizes, "lang").where(F.col("pick") < F.col("below")).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in byte_blocks(batch.column("text"), BLOCK):
                if (found := weighted(trigram_counts(block), idf)[(own := has_letter(block))]).size:
                    lang = batch.column("lang")[block.rows].filter(pa.array(own))
                    vector = binary_column(found.ravel(), np.arange(len(found) + 1) * SLOTS)
                    yield pa.RecordBatch.from_arrays([lang, vector], ["lang", "vector"])

    def centroids(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        points = np.stack([np.frombuffer(v, np.float32) for v in sorted(group["vector"])])
        centres = clustered(points, CENTROIDS)
        floor = float((points @ centres.T).max(axis=1).min()) / 4
        return pd.DataFrame({"lang": key[0], "centroid": [c.tobytes() for c in centres], "floor": floor})

    # copies of one text share a hash, so a copied text could be over-chosen: each vector counts once
    points = chosen.mapInArrow(vectors, "lang string, vector binary").distinct()
    found = sorted(points.groupBy("lang").applyInPandas(centroids, "lang string, centroid binary, floor double").collect(), key=lambda r: (r.lang, bytes(r.centroid)))
    languages = tuple(sorted({r.lang for r in found}))
    at = {lang: i for i, lang in enumerate(languages)}
    floors = {r.lang: r.floor for r in found}
    centres = np.stack([np.frombuffer(r.centroid, np.float32) for r in found]) if found else np.zeros((0, SLOTS), np.float32)
    return LanguageModel(languages, idf, centres, np.array([at[r.lang] for r in found], int), np.array([floors[x] for x in languages]))


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected, in place of columns so named."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["lang_pred", "score", "rejected"]
    docs = docs.drop(*names)
    place = docs.columns.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        called = np.array([*model.languages, "und"], object)
        for batch in batches:
            for block in byte_blocks(batch.column(place), BLOCK):
                language, cosine, rejected = model.predict(block)
                own = batch.slice(block.rows.start, len(block))
                new = [pa.array(called[language], pa.string()), pa.array(cosine), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays([*own.columns, *new], [*own.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return docs.mapInArrow(predict, schema)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by
