"""Token ids in Arrow files of equal-length sequences, and random access to them.

Documents are ordered by id over range partitions; each partition becomes one Arrow file (the stream format with its footer) of record batches of
``BATCH`` sequences: ``ids``, a fixed-size list of unsigned integers, and ``mask``, a fixed-size list of bytes, 0 where the
last sequence of a file is padded, else 1. The ids of a partition's documents fill its sequences without a gap. A second Arrow file
beside it lists the documents: id, place of the first token in the file, number of tokens. Local files are read by memory
map, ids and masks without copying; others through pyarrow's file systems.

A task writes files whose names no other attempt uses and reports them in its row of the manifest, which is committed by Spark:
what a failed attempt leaves is in no manifest. Files go to the shared folder given.

A null text is empty and has the end id only. Rows of one id are kept, in the order of the texts' hashes; null ids come first. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.batches import byte_blocks
from clickloom.llm.chunks import with_end_ids, worker_encoder

LENGTH = 2048
BATCH = 64
END_ID = 1
MANIFEST = "part int, sequences string, documents string, n_tokens bigint, n_docs bigint"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Append ids; whole batches of sequences go to the file as they fill."""

    def __init__(self, path: str, dtype: np.dtype, length: int = LENGTH) -> None:
        self.length, self.dtype, self.tokens = length, dtype, 0
        kind = pa.list_(pa.field("item", pa.from_numpy_dtype(dtype), nullable=False), length)
        self.schema = pa.schema([("ids", kind), ("mask", pa.list_(pa.field("item", pa.uint8(), nullable=False), length))])
        files, at = pafs.FileSystem.from_uri(path)
        self.sink = files.open_output_stream(at)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def append(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.dtype))
        self.held += len(ids)
        self.tokens += len(ids)
        whole = self.length * BATCH
        if self.held >= whole:
            ids = np.concatenate(self.waiting)
            for i in range(0, len(ids) - whole + 1, whole):
                self._write(ids[i : i + whole], whole)
            self.waiting, self.held = [ids[len(ids) // whole * whole :]], len(ids) % whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = (np.arange(len(ids)) < real).astype(np.uint8)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((ids, mask), self.schema, strict=True)]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        ids = np.concatenate([np.zeros(0, self.dtype), *self.waiting])
        if len(ids):
            self._write(np.pad(ids, (0, -len(ids) % self.length)), len(ids))
        self.file.close()
        self.sink.close()


class SequenceFile:
    """Random access to a file of sequences; arrays are views of the mapped file where it is local."""

    def __init__(self, path: str) -> None:
        files, at = pafs.FileSystem.from_uri(path)
        self.source = pa.memory_map(at) if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(at)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self._at, self._ids = -1, np.zeros(0)

    def batch(self, i: int) -> np.ndarray:
        if self._at != i:
            self._at, self._ids = i, self.file.get_batch(i).column("ids").flatten().to_numpy(zero_copy_only=True)
        return self._ids

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and the boolean mask of the i-th sequence, as views of the file."""
        rows = self.file.get_batch(i // BATCH)
        ids, mask = (rows.column(c)[i % BATCH].values.to_numpy(zero_copy_only=True) for c in ("ids", "mask"))
        return ids, mask.view(bool)

    def tokens(self, start: int, n: int) -> np.ndarray:
        whole = self.length * BATCH
        first, last = start // whole, (start + n - 1) // whole
        parts = [self.batch(i)[max(0, start - i * whole) : start + n - i * whole] for i in range(first, last + 1)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def close(self) -> None:
        self._ids = None
        self.source.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files into ``folder`` and return their manifest, which is also kept there."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = worker_encoder(tokenizer_path)
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        paths = [f"{folder}/part-{part:06d}-{name}.{kind}.arrow" for kind in ("sequences", "documents")]
        writer = listed = None
        docs = 0
        for batch in batches:
            for block in byte_blocks(batch.column(1)):
                if writer is None:
                    files, at = pafs.FileSystem.from_uri(folder)
                    files.create_dir(at, recursive=True)
                    writer = SequenceWriter(paths[0], np.dtype(np.uint16 if max(size, end_id + 1) <= 1 << 16 else np.uint32), length)
                    files, at = pafs.FileSystem.from_uri(paths[1])
                    sink = files.open_output_stream(at)
                    listed = pa.ipc.new_file(sink, _DOCS)
                ids, offsets = with_end_ids(*encoder(block), end_id)
                own = batch.column(0)[block.rows]
                listed.write_batch(pa.RecordBatch.from_arrays([own, pa.array(offsets[:-1] + writer.tokens), pa.array(np.diff(offsets))], schema=_DOCS))
                writer.append(ids)
                docs += len(block)
        if writer:
            writer.close()
            listed.close()
            sink.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "sequences": paths[0], "documents": paths[1], "n_tokens": writer.tokens, "n_docs": docs}], schema=pa.schema([("part", pa.int32()), ("sequences", pa.string()), ("documents", pa.string()), ("n_tokens", pa.int64()), ("n_docs", pa.int64())]))

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # the salt lets range partitioning cut a run of rows with one id
    rows = rows.withColumn("order", F.xxhash64("text")).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(1009)))
    ordered = rows.repartitionByRange("id", "order", "salt").sortWithinPartitions("id", "order", "salt").select("id", "text")
    manifest = f"{folder}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return docs.sparkSession.read.schema(MANIFEST).parquet(manifest)


def read_documents(manifest: DataFrame) -> DataFrame:
    """Every document as its files hold it: doc_id, start (tokens of all documents before it), n_tokens, ids_crc32."""
    # one row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sequences = SequenceFile(row["sequences"])
                files, at = pafs.FileSystem.from_uri(row["documents"])
                with files.open_input_file(at) as source:
                    listed = pa.ipc.open_file(source)
                    for i in range(listed.num_record_batches):
                        docs = listed.get_batch(i)
                        starts, counts = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                        crcs = [zlib.crc32(sequences.tokens(s, n).astype("<u4").tobytes()) for s, n in zip(starts.tolist(), counts.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(starts + row["base"]), pa.array(counts), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                sequences.close()

    spread = files.repartition(max(1, manifest.count()))
    return spread.select("sequences", "documents", "base").mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
