"""Benchmark passages in documents, found by Wu-Manber search over words.

Test items are cut into windows of 10 consecutive words; an item of fewer words is one window. The windows of
one length are searched together: a table of shifts, indexed by the block of the last two words of the text
window, tells how far the search may jump; at shift zero the bucket of windows that end in this block is
compared word by word, and at last the letters are compared.

Null or empty texts have no words and no hits; so have items without words. Items that repeat an id or a
text are kept apart by id only. Items without id are searched like the others: their words count as hit and their
spans have a null item, but they have no place in the sorted ids; where items are counted, all of them are one.
Documents may repeat; each row is searched alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerofuse.llm.names import fresh
from aerofuse.llm.text import blocks, utf8, words
from aerofuse.session import materialize

WINDOW = 10
BLOCK_ITEMS = 4_000  # items that are searched at once
BLOCK_CHARS = 16_000_000  # and code points of them
TABLE_BITS = 16
LANE = 512  # window ends that one cursor of the search walks over
_FACTOR = np.uint64(0x9FB21C651E98DF25)
_SHIFT = np.uint64(64 - TABLE_BITS)

SPANS = "array<struct<item:string,start:int,length:int>>"


def _block(hashes: np.ndarray, at: np.ndarray, two: bool) -> np.ndarray:
    """Table index of the block of words that ends at ``at``."""
    value = hashes[at]
    if two:
        value = value + (hashes[at - 1] << np.uint64(1))
    return (value * _FACTOR) >> _SHIFT


@dataclass
class Table:
    """Shifts and buckets for windows of one length."""

    length: int
    patterns: np.ndarray  # word hashes, one row a window
    texts: list  # the windows' words, one string each
    items: list  # for each window, the ids of the items that hold it
    shift: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)  # windows by the block they end in
    first: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        m, two = self.length, self.length > 1
        width = 2 if two else 1
        self.shift = np.full(1 << TABLE_BITS, m - width + 1, np.int64)
        flat = self.patterns.reshape(-1)
        rows = np.arange(len(self.patterns)) * m
        for last in range(width - 1, m):
            np.minimum.at(self.shift, _block(flat, rows + last, two), m - 1 - last)
        ends = _block(flat, rows + m - 1, two)
        self.order = np.argsort(ends, kind="stable")
        self.first = np.searchsorted(ends[self.order], np.arange((1 << TABLE_BITS) + 1, dtype=np.uint64))

    def search(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (first word, window) where the word hashes of a window occur within one text."""
        m, two = self.length, self.length > 1
        cursor, stop = _lanes(first[:-1] + m - 1, first[1:])
        found = []
        while len(cursor):
            block = _block(hashes, cursor, two)
            jump = self.shift[block]
            here = jump == 0
            if here.any():
                found.append((cursor[here], block[here]))
            cursor = cursor + np.maximum(jump, 1)
            going = cursor < stop
            cursor, stop = cursor[going], stop[going]
        places, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for ends, block in found:
            lo, n = self.first[block], self.first[block + np.uint64(1)] - self.first[block]
            for k in range(int(n.max())):  # the k-th window of each bucket
                some = np.flatnonzero(n > k)
                window = self.order[lo[some] + k]
                begin = ends[some] - m + 1
                same = (hashes[begin[:, None] + np.arange(m)] == self.patterns[window]).all(axis=1)
                places.append(begin[same])
                windows.append(window[same])
        return np.concatenate(places), np.concatenate(windows)


def _lanes(begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut the ranges into lanes of at most LANE places, so that many cursors move at once."""
    n = np.maximum(-(-(stop - begin) // LANE), 0)
    lane = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    cursor = np.repeat(begin, n) + lane * LANE
    return cursor, np.minimum(cursor + LANE, np.repeat(stop, n))


def tables_of(items: list[tuple[str | None, str]], window: int = WINDOW) -> list[Table]:
    """Search tables, one for each length of window, of (id, text) items."""
    data, offsets = utf8(pa.array([text for _, text in items], pa.string()))
    hashes, starts, ends, first = words(data, offsets)
    by_length: dict[int, dict[tuple, tuple[str, set]]] = {}
    raw = bytes(data)
    for k, (item, _) in enumerate(items):
        lo, hi = int(first[k]), int(first[k + 1])
        m = min(window, hi - lo)
        for a in range(lo, hi - m + 1) if m else ():
            text = " ".join(_lower(raw[starts[j] : ends[j]]) for j in range(a, a + m))
            by_length.setdefault(m, {}).setdefault(tuple(hashes[a : a + m].tolist()), (text, set()))[1].add(item)
    return [
        Table(m, np.array(list(found), np.uint64).reshape(len(found), m), [t for t, _ in found.values()],
              [sorted(i, key=lambda item: (item is None, item or "")) for _, i in found.values()])
        for m, found in sorted(by_length.items())
    ]


def _lower(word: bytes) -> str:
    return word.lower().decode("utf-8")  # bytes.lower changes A-Z only


def _search(texts: pa.Array, tables: list[Table]) -> Iterator[tuple[int, int, np.ndarray, list]]:
    """For each text its number in the array, its number of words, the first word of it, and the hits of every table:
    (table, first words counted over all texts, windows)."""
    data, offsets = utf8(texts)
    seen: dict = {}
    for lo, hi in blocks(offsets):
        part = data[offsets[lo] : offsets[hi]]
        hashes, starts, ends, first = words(part, offsets[lo : hi + 1] - offsets[lo])
        own: list = [[] for _ in range(hi - lo)]
        for number, table in enumerate(tables):
            places, windows = table.search(hashes, first)
            same = np.zeros(len(places), bool)
            for k, (place, window) in enumerate(zip(places.tolist(), windows.tolist(), strict=True)):
                # The letters decide; equal stretches of text are compared once.
                key = (number, window, part[starts[place] : ends[place + table.length - 1]].tobytes())
                if key not in seen:
                    text = " ".join(_lower(part[starts[j] : ends[j]].tobytes()) for j in range(place, place + table.length))
                    seen[key] = text == table.texts[window]
                same[k] = seen[key]
            places, windows = places[same], windows[same]
            owner = np.searchsorted(first, places, "right") - 1
            order = np.argsort(owner, kind="stable")
            at = np.searchsorted(owner[order], np.arange(hi - lo + 1))
            for doc in np.unique(owner).tolist():
                some = order[at[doc] : at[doc + 1]]
                own[doc].append((table, places[some] - first[doc], windows[some]))
        for doc in range(hi - lo):
            yield lo + doc, int(first[doc + 1] - first[doc]), own[doc]


def _merged(hits: list) -> list[dict]:
    """The words inside any hit, as stretches that do not meet."""
    if not hits:
        return []
    start = np.concatenate([places for _, places, _ in hits])
    end = np.concatenate([places + table.length for table, places, _ in hits])
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    last = np.append(new[1:], len(start)) - 1
    return [{"s": s, "e": e} for s, e in zip(start[new].tolist(), reach[last].tolist(), strict=True)]


def word_count(text: Column | str) -> Column:
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([n for _, n, _ in _search(texts, [])], pa.int64())

    return F.arrow_udf(count, "long")(text)


_FOUND = "n_words:long,covered:array<struct<s:int,e:int>>,items:array<string>"


def _hits(text: Column, tables: list[Table], with_spans: bool) -> Column:
    """struct(n_words, covered, items, and with_spans all spans) of these tables; a null item stands for those without id."""
    covered = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
    kind = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))

    def find(texts: pa.Array) -> pa.Array:
        sizes, ranges, items, spans = [], [], [], []
        for _, n_words, hits in _search(texts, tables):
            sizes.append(n_words)
            ranges.append(_merged(hits))
            items.append(sorted({i for table, _, windows in hits for w in np.unique(windows).tolist() for i in table.items[w]},
                                key=lambda item: (item is None, item or "")))
            if with_spans:
                spans.append([{"item": i, "start": p, "length": table.length} for table, places, windows in hits
                              for p, w in zip(places.tolist(), windows.tolist(), strict=True) for i in table.items[w]])
        columns = [pa.array(sizes, pa.int64()), pa.array(ranges, covered), pa.array(items, pa.list_(pa.string()))]
        names = ["n_words", "covered", "items"]
        if with_spans:
            columns.append(pa.array(spans, kind))
            names.append("spans")
        return pa.StructArray.from_arrays(columns, names)

    return F.arrow_udf(find, f"struct<{_FOUND}{',spans:' + SPANS if with_spans else ''}>")(text)


def item_blocks(items: DataFrame, block_items: int, item_col: str, text_col: str) -> tuple[int, Iterator[list[tuple[str | None, str]]]]:
    """The number of blocks and the blocks, one after another: distinct test items, about ``block_items`` and at most about
    BLOCK_CHARS code points of them in each (more only where one item is longer)."""
    rows = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where(F.col("text").isNotNull()).distinct()
    size = rows.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    n = max(1, -(-size["items"] // block_items), -(-size["chars"] // BLOCK_CHARS))
    number = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return n, ([(r["item"], r["text"]) for r in rows.where(number == k).toLocalIterator()] for k in range(n))


def _by_block(docs: DataFrame, blocks_of_items: Iterator[list], window: int, text_col: str, with_spans: bool, names: list[str]) -> DataFrame:
    """``docs`` with the hits of all blocks in a column, searched block by block.

    A search leaves the hits of the distinct texts that have any, under the digest of the text; they are united and joined
    back at the end, so neither the driver nor a task holds more than one block.
    """
    found, key = names
    kept = ["covered", "items", *(["spans"] if with_spans else [])]
    parts = []
    for k, block in enumerate(blocks_of_items):
        searched = docs.select(F.sha2(F.col(text_col), 256).alias("digest"), _hits(F.col(text_col), tables_of(block, window), with_spans).alias("hits"))
        hit = searched.where(F.size("hits.covered") > 0).select("digest", *(f"hits.{c}" for c in kept))
        parts.append(materialize(hit.dropDuplicates(["digest"]), f"hits-{k}"))
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    united = materialize(every.groupBy("digest").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in kept)), "hits")
    whole = united.select(F.col("digest").alias(key), F.struct(*kept).alias(found))
    joined = docs.withColumn(key, F.sha2(F.col(text_col), 256)).join(whole, key, "left")
    fields = united.schema
    return joined.withColumn(found, F.struct(word_count(text_col).alias("n_words"), *(
        F.coalesce(F.col(f"{found}.{c}"), F.array().cast(fields[c].dataType)).alias(c) for c in kept))).select(*docs.columns, found)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_items: int = BLOCK_ITEMS,
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  into: str = "contamination", with_spans: bool = False) -> DataFrame:
    """``docs`` with one more column ``into``: struct(n_words, n_hit, items, unnamed), and with_spans all spans.

    n_hit counts the words inside any occurrence, items are the sorted ids with occurrences (nulls left out), unnamed
    tells whether an item without id occurs; spans hold every place of every item, a null item for those without id.
    Items of one block take one scan of the texts; more blocks are searched one after another.
    """
    n, searched = item_blocks(items, block_items, item_col, item_text_col)
    names = fresh(["_found", "_digest"], docs)
    found = names[0]
    if n == 1:
        wide = docs.withColumn(found, _hits(F.col(text_col), tables_of(next(searched), window), with_spans))
    else:
        wide = _by_block(docs, searched, window, text_col, with_spans, names)

    # Stretches of one block do not meet, those of several blocks are joined in order.
    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    n_hit = F.aggregate(F.array_sort(f"{found}.covered"), nothing, lambda x, r: F.struct(
        (x.n + F.greatest(r.e - F.greatest(r.s, x.upto), F.lit(0))).alias("n"), F.greatest(r.e, x.upto).alias("upto"))).n
    ids = F.col(f"{found}.items")
    result = F.struct(
        F.col(f"{found}.n_words").alias("n_words"), n_hit.cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.array_compact(ids))).alias("items"),
        F.exists(ids, lambda i: i.isNull()).alias("unnamed"), *([F.col(f"{found}.spans").alias("spans")] if with_spans else []))
    return wide.withColumn(into, result).drop(found)


def remove_hits(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a window of any item; columns and other rows stay as they are."""
    [leak] = fresh(["_leak"], docs)
    marked = contamination(docs, items, into=leak, **options)
    return marked.where(F.col(f"{leak}.n_hit") == 0).drop(leak)
