"""Token files: Arrow stream files of equal-length sequences and masks.

A data set is a folder of Arrow IPC files. A file holds record batches of two fixed-size-list columns, ``ids`` and ``mask``,
``length`` values a row, uncompressed and aligned, so that a memory-mapped file gives every sequence and mask as a view, by its number,
without copying. The documents lie end to end in ascending id order. The mask (bits) is set for the ids of texts, not for a document's
closing id and not for padding, which only the end of a file has. Beside each file an Arrow file of the same stem lists its documents (id, first position, number of ids).

Documents are dealt to tasks by ranges of the id, rows of one id by their text and a seeded number, so that a hot id is split. Every task encodes
and writes its own range, one batch in memory at a time. File names carry an attempt's own mark, and the index names
the files of the attempts that Spark committed: a lost executor's half-written file is never read, and a repeated task changes nothing.
Files go to the shared folder through Arrow's file systems, so any store that these reach serves.

Defined results: a null or empty text is one closing id; null ids come first; rows of one id lie together, ordered by a hash of their text; repeated
rows are written once each; an empty table gives an empty index and no file. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import on_workers, pin, shuffle_partitions, text_or_empty
from .packing import encoder

#: Ids in a record batch.
BATCH_IDS = 1 << 19


def _open_store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class SequenceWriter:
    """One file of sequences, and its list of documents, written batch by batch."""

    def __init__(self, store: fs.FileSystem, path: str, id_type: pa.DataType, length: int, dtype: np.dtype):
        self.length, self.dtype = length, np.dtype(dtype)
        self.rows = max(1, BATCH_IDS // length)
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(self.dtype), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.documents = pa.schema([("doc_id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.streams = [store.open_output_stream(f"{path}{end}") for end in (".arrow", ".documents.arrow")]
        self.files = [pa.ipc.new_file(s, schema) for s, schema in zip(self.streams, (self.schema, self.documents))]
        self.held: list[np.ndarray] = []
        self.ends: list[int] = []
        self.size = self.at = 0
        self.listed: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> tuple[int, int]:
        """Append one document, its closing id last. Returns its first position in the file and its length."""
        first = self.at
        self.held.append(ids.astype(self.dtype))
        self.size += len(ids)
        self.at += len(ids)
        self.ends.append(self.size - 1)
        self.listed.append((doc, first, len(ids)))
        if self.size >= self.rows * self.length:
            self._flush(self.size // self.length * self.length)
        return first, len(ids)

    def _flush(self, upto: int) -> None:
        """Write the first ``upto`` held ids, padded to whole sequences; the rest stays."""
        ids = np.concatenate(self.held)
        ends = np.array(self.ends, np.int64)
        whole = -(-upto // self.length) * self.length
        out, mask = np.zeros(whole, self.dtype), np.zeros(whole, bool)
        out[:upto], mask[:upto] = ids[:upto], True
        mask[ends[ends < upto]] = False
        step = self.rows * self.length
        for a in range(0, whole, step):
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x[a:a + step]), self.length) for x in (out, mask)]
            self.files[0].write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.held, self.size = [ids[upto:]], len(ids) - upto
        self.ends = (ends[ends >= upto] - upto).tolist()
        if self.listed:
            self.files[1].write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.listed), self.documents)], schema=self.documents))
            self.listed = []

    def close(self) -> None:
        if self.size or self.listed:
            self._flush(self.size)
        for f in (*self.files, *self.streams):
            f.close()


class SequenceFile:
    """A written file, memory-mapped where it is local: sequences and masks by number, as views."""

    def __init__(self, path: str):
        store, at = _open_store(path)
        self.source = pa.memory_map(at) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(at)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.firsts = np.cumsum([0] + [self.file.get_batch(k).num_rows for k in range(self.file.num_record_batches)])

    def __len__(self) -> int:
        return int(self.firsts[-1])

    def sequence(self, n: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """(ids, mask) of sequence n, both views of the file: nothing is copied or unpacked."""
        k = int(np.searchsorted(self.firsts, n, side="right")) - 1
        row, batch = n - int(self.firsts[k]), self.file.get_batch(k)
        at = slice(row * self.length, (row + 1) * self.length)
        return batch.column("ids").flatten().to_numpy(zero_copy_only=True)[at], batch.column("mask").flatten()[at]

    def batches(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """ids and unpacked mask, batch by batch."""
        for k in range(self.file.num_record_batches):
            batch = self.file.get_batch(k)
            yield batch.column("ids").flatten().to_numpy(zero_copy_only=True), batch.column("mask").flatten().to_numpy(zero_copy_only=False)

    def close(self) -> None:
        self.source.close()


def write(docs: DataFrame, folder: str | None = None, length: int = 2048, closing_id: int = 0, tokenizer_path: str | None = None,
          dtype: str = "uint16", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the data set; returns its manifest, one row a file: file, first_id_at (ids before it), n_ids, n_documents.

    ``dtype`` must hold all ids of the vocabulary (an id that does not fit is an error)."""
    spark = on_workers(docs.sparkSession)
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    slim = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    keys = ["doc_id", "_text", "_salt"]
    dealt = (slim.withColumn("_text", F.xxhash64("text")).withColumn("_salt", F.rand(1))
             .repartitionByRange(shuffle_partitions(spark), *[F.col(k).asc_nulls_first() for k in keys])
             .sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys]).drop("_text", "_salt"))
    most = np.iinfo(dtype).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer, part, n = encoder(tokenizer_path), None, TaskContext.get().partitionId(), 0
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            if writer is None:
                store, path = _open_store(folder)
                store.create_dir(path, recursive=True)
                writer = SequenceWriter(store, f"{path}/{name}", batch.schema.field("doc_id").type, length, dtype)
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.append(encode(text.as_py()), np.uint32(closing_id))
                if int(ids.max()) > most:
                    raise ValueError(f"id {int(ids.max())} does not fit {dtype}")
                writer.add(doc, ids)
                n += 1
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "file": [f"{folder}/{name}.arrow"], "n_ids": pa.array([writer.at], pa.int64()), "n_documents": pa.array([n], pa.int64())})

    parts = pin(dealt.mapInArrow(run, "part bigint, file string, n_ids bigint, n_documents bigint"))
    rows = sorted(parts.collect(), key=lambda r: r["part"])  # one row a file, as many as the session has shuffle partitions
    before, out = 0, []
    for r in rows:
        out.append((r["file"], before, r["n_ids"], r["n_documents"]))
        before += r["n_ids"]
    return spark.createDataFrame(out, "file string, first_id_at bigint, n_ids bigint, n_documents bigint")


def read_documents(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32: read back from the files of a manifest.

    A document's bounds come from the closing marks of the masks; the list beside the file gives its id and must agree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("file").to_pylist(), batch.column("first_id_at").to_pylist()):
                yield from _documents_of(path, before)

    spark = on_workers(manifest.sparkSession)
    files = max(1, min(manifest.count(), shuffle_partitions(spark)))
    dealt = manifest.select("file", "first_id_at").repartition(files)
    return dealt.mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def _documents_of(path: str, before: int) -> Iterator[pa.RecordBatch]:
    """The documents of one file. Holds one batch of sequences and the checksum of the document that is open."""
    store, at = _open_store(path)
    with store.open_input_file(at.removesuffix(".arrow") + ".documents.arrow") as f:
        listed = pa.ipc.open_file(f).read_all()
    left = sum(listed.column("n_tokens").to_pylist())
    held, crcs, sizes, crc, size = SequenceFile(path), [], [], 0, 0
    whole = len(held) == -(-left // held.length)
    for ids, mask in held.batches():
        real, text = ids[:left].astype("<u4"), mask[:left]
        left -= len(real)
        begin = 0
        for end in (np.flatnonzero(~text) + 1).tolist():
            crcs.append(zlib.crc32(real[begin:end].data, crc))
            sizes.append(size + end - begin)
            begin, crc, size = end, 0, 0
        if begin < len(real):
            crc, size = zlib.crc32(real[begin:].data, crc), size + len(real) - begin
    held.close()
    starts = np.cumsum([0, *sizes])[:-1]
    if not whole or left or size or listed.column("n_tokens").to_pylist() != sizes or listed.column("start").to_pylist() != starts.tolist():
        raise ValueError(f"{path}: the masks and the list of documents differ")
    rows = pa.table({"doc_id": listed.column("doc_id"), "start": pa.array(starts + before, pa.int64()), "n_tokens": pa.array(sizes, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())})
    yield from rows.to_batches(max_chunksize=1 << 14)
