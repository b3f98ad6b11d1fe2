"""Packing of documents into token sequences, each window filled with lexical neighbours of its seed.

A document's ids are those of the tokenizer and one end id. Its windows of full length are sequences of their
own; what is left over, its remainder, is packed:

1. Documents are laid out by a MinHash of their ids, so that documents with common terms lie close, and cut into
   shards of about SHARD_IDS ids. Equal hashes are told apart by document id, so a hot group fills several
   shards.
2. Each shard holds an inverted index of its remainders: for every term (a token id) the documents and
   their BM25 weights. Document frequencies and the mean length cover the whole corpus.
3. The longest unused remainder is the seed of a window. Its QUERY_TERMS most telling terms are looked up, and
   the unused neighbours fill the window in order of score, then the longest other unused ones. The
   last of them is cut where the window is full; its rest stays unused.
4. The last window of a shard, if not full, is cut into sequences whose lengths are powers of two, so that
   nothing is padded.

A null or empty text is the end id alone. Rows of equal id or text are packed as they are; no row is dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerofuse.llm.text import mix
from aerofuse.llm.tokens import encoder
from aerofuse.session import materialize

WINDOW = 2048
END_ID = 1
SHARD_IDS = 2_000_000
QUERY_TERMS = 16
K1, B = 1.2, 0.75

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [c.split()[0] for c in _PIECES.split(", ")]


def encoded(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, near (MinHash of the ids), n, ids (little-endian, as wide as the vocabulary needs); written once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        terms = max(own.tokenizer.get_vocab_size(), end_id + 1)
        hashes = (mix(np.arange(terms, dtype=np.uint64)) >> np.uint64(1)).astype(np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                some = batch.slice(lo, 1000)
                ids, counts = own.encode(some.column(1))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
                at = np.concatenate([[0], np.cumsum(counts)])
                near = np.minimum.reduceat(hashes[ids], at[:-1])
                data = pa.py_buffer(ids.tobytes())
                offsets = pa.py_buffer((at * ids.itemsize).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(near), pa.array(counts), pa.Array.from_buffers(pa.binary(), len(counts), [None, offsets, data])],
                    names=["doc_id", "near", "n", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(work, "doc_id long, near long, n long, ids binary"), "encoded")


def _document_frequency(rows: DataFrame, dtype, terms: int) -> tuple[np.ndarray, int, float]:
    """In how many documents each term occurs, the number of documents and their mean length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, distinct = np.zeros(terms, np.int64), _Distinct(terms)
        for batch in batches:
            for ids in batch.column(0):
                total[distinct.of(np.frombuffer(ids.as_buffer(), dtype))[0]] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    found = rows.select("ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(terms, np.int64)
    for row in found.collect():  # at most one row per id of the vocabulary
        out[row["term"]] = row["n"]
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("n").alias("mean")).first()
    return out, size["n"], float(size["mean"] or 1)


class _Distinct:
    """Distinct terms of a text and their counts, by a mark per term instead of sorting."""

    def __init__(self, terms: int) -> None:
        self.marked = np.zeros(terms, bool)
        self.place = np.zeros(terms, np.int64)

    def of(self, ids: np.ndarray, counted: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        self.marked[ids] = True
        found = np.flatnonzero(self.marked)
        self.marked[found] = False
        if not counted:
            return found, None
        self.place[found] = np.arange(len(found))
        return found, np.bincount(self.place[ids], minlength=len(found))


class Index:
    """BM25 inverted index of one shard."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean: float) -> None:
        docs, terms, weights = [], [], []
        distinct = _Distinct(len(idf))
        for k, ids in enumerate(texts):
            term, count = distinct.of(ids, counted=True)
            docs.append(np.full(len(term), k, np.int32))
            terms.append(term)
            weights.append(count * (K1 + 1) / (count + K1 * (1 - B + B * len(ids) / mean)))
        doc, term = np.concatenate(docs), np.concatenate(terms)
        weight = np.concatenate(weights) * idf[term]
        ends = np.cumsum([len(d) for d in docs])
        # The terms of each document that tell most about it, for its query.
        self.query = [term[a:b][np.argsort(-weight[a:b], kind="stable")[:QUERY_TERMS]] for a, b in zip(ends - [len(d) for d in docs], ends, strict=True)]
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.first = np.searchsorted(term[order], np.arange(len(idf) + 1))

    def neighbours(self, seed: int) -> np.ndarray:
        """Documents that share a query term with the seed, the best first, ties by place."""
        parts = [slice(self.first[t], self.first[t + 1]) for t in self.query[seed]]
        doc = np.concatenate([self.doc[p] for p in parts])
        score = np.bincount(doc, np.concatenate([self.weight[p] for p in parts]))
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


def pack(texts: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard; sequences are numbered from 0."""
    pieces, sequence = [], 0
    left = np.zeros(len(texts), np.int64)  # ids of each document that are not packed yet, its last ones
    for k, ids in enumerate(texts):
        for start in range(0, len(ids) - window + 1, window):
            pieces.append((k, start, window, sequence, 0))
            sequence += 1
        left[k] = len(ids) % window
    index = Index([ids[len(ids) - n :] if n else ids[:0] for ids, n in zip(texts, left.tolist(), strict=True)], idf, mean)
    by_length = np.argsort(-left, kind="stable").tolist()
    next_longest = 0
    filled, offset = [], 0

    def take(k: int) -> None:
        nonlocal offset
        n = min(int(left[k]), window - offset)
        filled.append((k, len(texts[k]) - int(left[k]), n, sequence, offset))
        left[k] -= n
        offset += n

    while True:
        while next_longest < len(by_length) and left[by_length[next_longest]] == 0:
            next_longest += 1
        if next_longest == len(by_length):
            break
        seed = by_length[next_longest]
        take(seed)
        found = index.neighbours(seed)
        for k in found[left[found] > 0].tolist():
            if offset == window:
                break
            take(k)
        k = next_longest
        while offset < window and k < len(by_length):
            if left[by_length[k]]:
                take(by_length[k])
            k += 1
        if offset == window:
            pieces += filled
            filled, offset = [], 0
            sequence += 1
    # The last window is cut at powers of two.
    room = 1 << (offset.bit_length() - 1) if offset else 0
    used = 0
    for k, start, n, _, _ in filled:
        while n:
            part = min(n, room - used)
            pieces.append((k, start, part, sequence, used))
            start, n, used, offset = start + part, n - part, used + part, offset - part
            if used == room:
                sequence += 1
                room, used = 1 << (offset.bit_length() - 1) if offset else 0, 0
    return pieces


def packed(docs: DataFrame, path: str, end_id: int = END_ID, window: int = WINDOW, shard_ids: int = SHARD_IDS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and the crc32 of its ids."""
    own = encoder(path)
    dtype, terms = own.dtype, max(own.tokenizer.get_vocab_size(), end_id + 1)
    rows = encoded(docs, path, end_id, id_col, text_col)
    frequency, n_docs, mean = _document_frequency(rows, dtype, terms)
    idf = np.log1p((n_docs - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 36  # each partition numbers its own sequences

        def shard(doc_ids: list, texts: list) -> pa.RecordBatch:
            nonlocal sequence
            pieces = np.array(pack(texts, idf, mean, window), np.int64).reshape(-1, 5)
            crc = [zlib.crc32(texts[k][a : a + n].astype("<u4").tobytes()) for k, a, n in pieces[:, :3].tolist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            columns = [pa.array(doc_ids, pa.int64()).take(pa.array(pieces[:, 0])), pieces[:, 1], pieces[:, 2],
                       pa.array(crc, pa.int64()), sizes[pieces[:, 0]], pieces[:, 3] + sequence, pieces[:, 4]]
            sequence += int(pieces[:, 3].max()) + 1
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_NAMES)

        doc_ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids.append(doc_id)
                texts.append(np.frombuffer(ids.as_py(), dtype))
                held += len(texts[-1])
                if held >= shard_ids:
                    yield shard(doc_ids, texts)
                    doc_ids, texts, held = [], [], 0
        if texts:
            yield shard(doc_ids, texts)

    order = ["near", "doc_id", F.xxhash64("ids")]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    return laid.mapInArrow(work, _PIECES)
