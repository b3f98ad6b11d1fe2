"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of whole documents in ascending order of id:

    magic "PFOR1", then 3 zero bytes
    blocks of 1024 ids each (the last one filled up with its minimum):
        minimum uint32, width uint8, zero uint8, exceptions uint16,
        1024 differences of ``width`` bits, lowest bit first,
        exception places uint16 each, exception differences uint32 each
    block index: start of each block, uint64
    document table: id int64, 1 if the id is null uint8, number of ids int64, each as one array
    footer: ids, blocks, documents, start of the block index, uint64 each

The width of a block is what 95 % of its differences need; the others are exceptions.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerofuse.llm.tokens import encoder
from aerofuse.session import materialize, shared_folder

MAGIC = b"PFOR1\0\0\0"
BLOCK = 1024
COVERED = 0.95  # share of a block's differences that its width must hold
FILE_IDS = 4_000_000  # a file is closed once it holds so many ids
_HEAD = np.dtype([("minimum", "<u4"), ("width", "u1"), ("zero", "u1"), ("exceptions", "<u2")])
_FOOTER = "<4Q"


def encode(ids: np.ndarray, doc_ids: list, counts: np.ndarray) -> bytes:
    """A whole file."""
    parts, starts, at = [MAGIC], [], len(MAGIC)
    n_blocks = -(-len(ids) // BLOCK)
    for lo in range(0, n_blocks, 256):
        some = ids[lo * BLOCK : (lo + 256) * BLOCK].astype(np.uint32)
        for block in _encode_blocks(some):
            starts.append(at)
            parts.append(block)
            at += len(block)
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], "u1")
    parts += [np.array(starts, "<u8").tobytes(), known.tobytes(), nulls.tobytes(), counts.astype("<i8").tobytes()]
    parts.append(struct.pack(_FOOTER, len(ids), n_blocks, len(doc_ids), at))
    return b"".join(parts)


def _encode_blocks(ids: np.ndarray) -> Iterator[bytes]:
    missing = -len(ids) % BLOCK
    if missing:
        last = ids[len(ids) - (BLOCK - missing) :]
        ids = np.concatenate([ids, np.full(missing, last.min(), np.uint32)])
    ids = ids.reshape(-1, BLOCK)
    minima = ids.min(axis=1)
    rest = ids - minima[:, None]
    limit = np.partition(rest, int(COVERED * BLOCK) - 1, axis=1)[:, int(COVERED * BLOCK) - 1]
    widths = np.ceil(np.log2(limit.astype(np.float64) + 1)).astype(np.int64)
    packed: list = [b""] * len(ids)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        if width:
            bits = (rest[rows][:, :, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
            whole = np.packbits(bits.astype(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
            for row, data in zip(rows, whole, strict=True):
                packed[row] = data.tobytes()
    for row, minimum, width, data in zip(rest, minima, widths, packed, strict=True):
        places = np.flatnonzero(row >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
        head = np.array([(minimum, width, 0, len(places))], _HEAD).tobytes()
        yield head + data + places.astype("<u2").tobytes() + row[places].astype("<u4").tobytes()


class File:
    """A file read back: its documents, and ids of any range without unpacking the rest."""

    def __init__(self, data: bytes) -> None:
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a file of token-id blocks")
        self.data = data
        self.n_ids, self.n_blocks, n_docs, at = struct.unpack_from(_FOOTER, data, len(data) - struct.calcsize(_FOOTER))
        self.starts = np.frombuffer(data, "<u8", self.n_blocks, at)
        at += 8 * self.n_blocks
        ids = np.frombuffer(data, "<i8", n_docs, at).tolist()
        nulls = np.frombuffer(data, "u1", n_docs, at + 8 * n_docs)
        self.doc_ids = [None if null else d for d, null in zip(ids, nulls, strict=True)]
        self.counts = np.frombuffer(data, "<i8", n_docs, at + 9 * n_docs)

    def ids(self, begin: int, end: int) -> np.ndarray:
        lo, hi = begin // BLOCK, -(-end // BLOCK)
        if end <= begin:
            return np.zeros(0, np.uint32)
        heads = [np.frombuffer(self.data, _HEAD, 1, int(s))[0] for s in self.starts[lo:hi]]
        out = np.zeros((hi - lo, BLOCK), np.uint32)
        widths = np.array([h["width"] for h in heads], np.int64)
        for width in np.unique(widths[widths > 0]):
            for some in np.array_split(rows := np.flatnonzero(widths == width), -(-len(rows) // 256)):
                size = BLOCK * int(width) // 8
                raw = np.stack([np.frombuffer(self.data, np.uint8, size, int(self.starts[lo + r]) + 8) for r in some])
                bits = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(some), BLOCK, width)
                value = np.zeros((len(some), BLOCK), np.uint32)
                for j in range(width):
                    value |= bits[:, :, j].astype(np.uint32) << np.uint32(j)
                out[some] = value
        for k, head in enumerate(heads):
            n = int(head["exceptions"])
            if n:
                at = int(self.starts[lo + k]) + 8 + BLOCK * int(head["width"]) // 8
                places = np.frombuffer(self.data, "<u2", n, at)
                out[k, places] = np.frombuffer(self.data, "<u4", n, at + 2 * n)
            out[k] += head["minimum"]
        return out.reshape(-1)[begin - lo * BLOCK : end - lo * BLOCK]


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = 0, file_ids: int = FILE_IDS,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all texts and write them to files under ``folder``; returns the written list of files.

    A null text counts as empty: its document is the end id alone. Documents come in ascending order of id, null
    ids first, equal ids in the order of a hash of their text. A task that is repeated writes files of new
    names; the returned list (folder, shard, part, file, documents, ids) names those that count. The folder
    must be one that all executors reach, by a path or an address that pyarrow's file systems know.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        own, shard, part = encoder(path), TaskContext.get().partitionId(), 0
        ids, doc_ids, counts, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            name = f"{shard:07d}-{part:05d}-{uuid.uuid4().hex}.pfor"
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(encode(np.concatenate(ids), doc_ids, np.concatenate(counts)))
            return pa.RecordBatch.from_pydict(
                {"shard": [shard], "part": [part], "file": [name], "documents": [len(doc_ids)], "ids": [held]})

        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                some = batch.slice(lo, 1000)
                found, n = own.encode(some.column(1))
                with_end = np.insert(found.astype(np.uint32), np.cumsum(n), end_id)
                ids.append(with_end)
                counts.append(n + 1)
                doc_ids += some.column(0).to_pylist()
                held += len(with_end)
                if held >= file_ids:
                    yield close()
                    part += 1
                    ids, doc_ids, counts, held = [], [], [], 0
        if doc_ids:
            yield close()

    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(laid.mapInArrow(write, "shard long, part long, file string, documents long, ids long"), "pfor-files")


def read_documents(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                file = File(content.as_py())
                begins = np.concatenate([[0], np.cumsum(file.counts)]).astype(np.int64)
                lo = 0
                while lo < len(file.counts):  # some documents at a time
                    hi = max(lo + 1, int(np.searchsorted(begins, begins[lo] + (1 << 20), "right")) - 1)
                    hi = min(hi, len(file.counts))
                    raw = memoryview(file.ids(int(begins[lo]), int(begins[hi])).astype("<u4").tobytes())
                    at = 4 * (begins[lo : hi + 1] - begins[lo])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * (hi - lo)), pa.array(file.doc_ids[lo:hi], pa.int64()),
                         pa.array(begins[lo:hi]), pa.array(file.counts[lo:hi]),
                         pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64())],
                        names=["file", "doc_id", "begin", "n_tokens", "ids_crc32"])
                    lo = hi

    earlier = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, so this one window is short; it holds no document.
    placed = files.select("file", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    rows = content.mapInArrow(read, "file string, doc_id long, begin long, n_tokens long, ids_crc32 long")
    return rows.join(placed, "file").select("doc_id", (F.col("before") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/pfor-{uuid.uuid4().hex}"
