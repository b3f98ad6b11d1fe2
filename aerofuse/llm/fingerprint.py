"""Document fingerprints from improbable byte windows.

Every 64-byte window of a text has an entropy; how rare this entropy is among all windows of the corpus ranks it
(nearly constant windows are left out). Among each 64 neighbouring windows the rarest is noted; windows noted
at least 16 times are the features. Each feature sets 5 bits of a 2048-bit Bloom filter; after 160 features a
new filter is chained. Two fingerprints are compared filter by filter: the common bits beyond what chance
explains, as a share of the most there can be; each filter of the shorter digest takes its best partner.

Texts of few such neighbourhoods have shorter windows (SHORT), by a rule on their own length: all of 2 bytes below
32 bytes; those of 8 bytes from 16 to 255, of which the least hash of each four neighbours is taken; 64 bytes from
128 on. The ranges overlap, so texts on both sides of a border have features in common.

A text without features (one byte, or long and constant) has one feature, the whole text; a null or empty
text has none, its fingerprint is empty, and it is like another empty one only.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerofuse.llm.text import blocks, mix, numbers, utf8
from aerofuse.session import materialize

SIZE = 64  # bytes of a window, and windows among which the rarest is noted
POPULAR = 16
SHORT = [(2, 2, 32, 1), (8, 16, 256, 4)]  # bytes of a window, least and end of the texts' bytes, windows among which one is taken
LEAST_LONG = 128  # shorter texts have no 64-byte windows
FILTER_BITS, FILTER_FEATURES, HASHES = 2048, 160, 5
LEVELS = 1000  # entropy is counted in thousandths of its maximum
LEAST_LEVEL = 100  # windows below carry no information
CHANCE = 0.3  # share of the possible overlap that counts as chance
_NONE = np.int64(1) << 60
_BLOCK = 1 << 17
_SEEDS = numbers(SIZE // 8, 5)
# c * log2(c) in fixed point, so that running sums are exact; the step from c to c + 1 of it.
_TERMS = np.round(np.arange(SIZE + 1) * np.log2(np.maximum(np.arange(SIZE + 1), 1)) * (1 << 20)).astype(np.int64)
_STEPS = np.diff(_TERMS)


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Entropy level of each 64-byte window."""
    n = len(data) - SIZE + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    before = np.zeros(len(data), np.uint8)  # equal bytes among the 63 before
    after = np.zeros(len(data), np.uint8)
    for lag in range(1, SIZE):
        equal = (data[lag:] == data[:-lag]).view(np.uint8)
        before[lag:] += equal
        after[:-lag] += equal
    enter, leave = _STEPS[before], _STEPS[after]
    total = np.empty(n, np.int64)
    total[0] = enter[:SIZE].sum()
    np.cumsum(enter[SIZE:] - leave[: n - 1], out=total[1:])
    total[1:] += total[0]
    bits = np.log2(SIZE) - total / (SIZE << 20)
    return (bits * (LEVELS / np.log2(SIZE)) + 1e-6).astype(np.int64)


def _slices(n: int) -> Iterator[tuple[int, int]]:
    """Ranges of windows of a long text."""
    for lo in range(0, n, _BLOCK):
        yield lo, min(lo + _BLOCK, n)


def level_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many windows of all texts have each entropy level."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for lo, hi in blocks(offsets, _BLOCK):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                if hi - lo == 1:
                    for a, b in _slices(len(part) - SIZE + 1):
                        total += np.bincount(entropy_levels(part[a : b + SIZE - 1]), minlength=LEVELS + 1)
                elif len(part) >= SIZE:
                    total += np.bincount(entropy_levels(part)[_inside(at, SIZE, len(part) - SIZE + 1)], minlength=LEVELS + 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["level", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "level long, n long")
    counts = np.zeros(LEVELS + 1, np.int64)
    for row in rows.groupBy("level").agg(F.sum("n").alias("n")).collect():  # at most 1001 rows
        counts[row["level"]] = row["n"]
    return counts


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, the rarest first; levels that are left out have none."""
    order = np.argsort(counts, kind="stable")
    ranks = np.empty(LEVELS + 1, np.int64)
    ranks[order] = np.arange(LEVELS + 1)
    ranks[:LEAST_LEVEL] = LEVELS + 1
    return ranks


def _inside(at: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` starts begin a stretch of ``size`` bytes within one text."""
    edge = np.zeros(n + 1, np.int32)
    fits = np.diff(at) >= size
    np.add.at(edge, at[:-1][fits], 1)
    np.add.at(edge, at[1:][fits] - size + 1, -1)
    return np.cumsum(edge[:-1]) > 0


def _noted(data: np.ndarray, ranks: np.ndarray, inside: np.ndarray | None, full: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """How often each window is the rarest of its neighbours, and the sort keys of all windows."""
    keys = ranks[entropy_levels(data)]
    keys = np.where(keys > LEVELS, _NONE, (keys << 32) + np.arange(len(keys)))
    if inside is not None:
        keys[~inside] = _NONE
    least, width = keys, 1
    while width < SIZE:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if full is not None:
        least = least[full[: len(least)]]
    least = least[least < _NONE] & 0xFFFFFFFF
    return np.bincount(least, minlength=len(keys)), keys


def _short_features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes from the windows of SHORT, and the text that has each."""
    hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    sizes = np.diff(at)
    for size, least, end, among in SHORT:
        some = np.flatnonzero((sizes >= least) & (sizes < end))
        if not len(some):
            continue
        own = np.concatenate([data[at[k] : at[k + 1]] for k in some.tolist()]).astype(np.uint64)
        text = np.repeat(some, sizes[some])
        n = len(own) - size + 1
        value = np.zeros(n, np.uint64)
        for j in range(size):
            value |= own[j : j + n] << np.uint64(8 * j)
        found = mix(mix(value + _SEEDS[size - 1]) + np.uint64(size))
        taken = np.zeros(n, bool)
        groups = n - among + 1  # a group may not reach into the next text
        if groups > 0:
            inside = text[:groups] == text[size + among - 2 :]
            lowest = np.min([found[j : j + groups] for j in range(among)], axis=0)
            for j in range(among):
                taken[j : j + groups] |= inside & (found[j : j + groups] == lowest)
        hashes.append(found[taken])
        owners.append(text[:n][taken])
    return np.concatenate(hashes), np.concatenate(owners)


def _features(data: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of some texts in order, and how many each text has."""
    n = len(data) - SIZE + 1
    picked = [np.zeros(0, np.int64)]
    if len(at) == 2:
        times = np.zeros(max(n, 0), np.int16)
        for a, b in _slices(n - SIZE + 1):
            some, _ = _noted(data[a : b + 2 * SIZE - 2], ranks, None, None)
            times[a : a + len(some)] += some.astype(np.int16)
        picked.append(np.flatnonzero(times >= POPULAR))
        keys = None
    elif n >= SIZE:
        inside = _inside(at, SIZE, n)
        times, keys = _noted(data, ranks, inside, _inside(at, 2 * SIZE - 1, n))
        picked.append(np.flatnonzero(times >= POPULAR))
    else:
        keys = None
    places = picked[-1]
    counts = np.diff(np.searchsorted(places, at))
    short, short_owner = _short_features(data, at)
    has_short = np.bincount(short_owner, minlength=len(counts)) > 0
    # Texts without any: their rarest window, or all of the text.
    whole: dict[int, np.uint64] = {}
    extra: dict[int, int] = {}
    for k in np.flatnonzero((counts == 0) & (np.diff(at) > 0)).tolist():
        lo, hi = int(at[k]), int(at[k + 1])
        if hi - lo >= LEAST_LONG:
            own = keys[lo : hi - SIZE + 1] if keys is not None else None
            if own is None:
                best, lowest = -1, LEVELS + 1
                for a, b in _slices(hi - lo - SIZE + 1):
                    level = ranks[entropy_levels(data[lo + a : lo + b + SIZE - 1])]
                    if level.min() < lowest:
                        best, lowest = a + int(level.argmin()), level.min()
            else:
                best = int(own.argmin()) if own.min() < _NONE else -1
            if best >= 0:
                extra[k] = lo + best
                continue
        if has_short[k]:
            continue
        digest = hashlib.blake2b(data[lo:hi].tobytes(), digest_size=8).digest()
        whole[k] = np.frombuffer(digest, np.uint64)[0]
    owner = np.repeat(np.arange(len(counts)), counts)
    if extra:
        places = np.concatenate([places, np.array(list(extra.values()), np.int64)])
        owner = np.concatenate([owner, np.array(list(extra), np.int64)])
    bytes_ = data[places[:, None] + np.arange(SIZE)] if len(places) else np.zeros((0, SIZE), np.uint8)
    parts = np.ascontiguousarray(bytes_).view(np.uint64)
    hashes = np.zeros(len(places), np.uint64)
    for j, seed in enumerate(_SEEDS):
        hashes = mix(hashes ^ (parts[:, j] + seed))
    hashes, owner = np.concatenate([hashes, short]), np.concatenate([owner, short_owner])
    if whole:
        hashes = np.concatenate([hashes, np.array(list(whole.values()), np.uint64)])
        owner = np.concatenate([owner, np.array(list(whole), np.int64)])
    order = np.argsort(owner, kind="stable")
    return hashes[order], np.bincount(owner, minlength=len(counts))


def digests(texts: list, ranks: np.ndarray) -> list[np.ndarray]:
    """The chained filters of each text: one row of 256 bytes each."""
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    out = []
    for lo, hi in blocks(offsets, _BLOCK):
        hashes, counts = _features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ranks)
        filters = -(-counts // FILTER_FEATURES)
        base = np.cumsum(filters) - filters
        first = np.cumsum(counts) - counts
        number = np.repeat(base, counts) + (np.arange(len(hashes)) - np.repeat(first, counts)) // FILTER_FEATURES
        bits = np.zeros((int(filters.sum()), FILTER_BITS), bool)
        for k in range(HASHES):
            bits[number, ((hashes >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits, axis=1)
        out += [packed[b : b + f] for b, f in zip(base.tolist(), filters.tolist(), strict=True)]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised bit overlap of two digests, 0 to 1."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    wide_a, wide_b = a.view(np.uint64), b.view(np.uint64)
    set_a, set_b = np.bitwise_count(wide_a).sum(1, dtype=np.int64), np.bitwise_count(wide_b).sum(1, dtype=np.int64)
    total = 0.0
    for row, n in zip(wide_a, set_a.tolist(), strict=True):
        common = np.bitwise_count(wide_b & row).sum(1, dtype=np.int64)
        most = np.minimum(n, set_b)
        chance = n * set_b / FILTER_BITS
        floor = chance + CHANCE * (most - chance)
        total += float(np.clip((common - floor) / np.maximum(most - floor, 1e-9), 0, 1).max())
    return total / len(a)


def written(digest: np.ndarray) -> str:
    return base64.b64encode(digest.tobytes()).decode()


_RESULT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_PLAIN = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: list, texts: list, nexts: list, own: list, following: list, ranks: np.ndarray) -> list[pa.Array]:
    edited = [t[: len(t) - len(t) // 4] + u[: len(t) // 4] for t, u in zip(texts, nexts, strict=True)]
    changed = digests(edited, ranks)
    columns = [
        ids, [len(t) for t in texts], [hashlib.sha256(e.encode()).hexdigest() for e in edited],
        [written(d) for d in own], [written(d) for d in changed],
        [likeness(d, e) for d, e in zip(own, changed, strict=True)],
        [likeness(d, e) for d, e in zip(own, following, strict=True)],
    ]
    return [pa.array(c, t) for c, (_, t) in zip(columns, _RESULT, strict=True)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its fingerprint, and likeness to an edited text and to the next document.

    The next document is that of the next greater id (null ids first, equal ids by a hash of their text); after
    the last comes the first. The edited text has its last quarter replaced by as much of the next one's
    beginning. Documents are sorted by ranges of id; within a range each meets the next one as the rows
    pass by, and the last of a range meets the first of the next range in a second, small step.
    """
    ranks = ranks_of(level_counts(docs, text_col))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, begun = TaskContext.get().partitionId(), None, False

        def edge(kind: int, row: tuple) -> pa.RecordBatch:
            values = [row[0], None, None, None, None, None, None, kind, shard, row[1]]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, (_, t) in zip(values, _EDGES, strict=True)], names=[n for n, _ in _EDGES])

        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                some = batch.slice(lo, 500)
                ids = some.column(0).to_pylist()
                texts = [t or "" for t in some.column(1).to_pylist()]
                own = digests(texts, ranks)
                if not begun:
                    yield edge(1, (ids[0], texts[0]))
                    begun = True
                if held is not None:
                    ids, texts, own = [held[0], *ids], [held[1], *texts], [held[2], *own]
                held = (ids[-1], texts[-1], own[-1])
                if len(ids) > 1:
                    plain = _compared(ids[:-1], texts[:-1], texts[1:], own[:-1], own[1:], ranks)
                    n = len(ids) - 1
                    rest = [pa.array([0] * n, pa.int64()), pa.array([shard] * n, pa.int64()), pa.nulls(n, pa.string())]
                    yield pa.RecordBatch.from_arrays(plain + rest, names=[n for n, _ in _EDGES])
        if held is not None:
            yield edge(2, held[:2])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, nexts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            both = digests(texts + nexts, ranks)
            columns = _compared(batch.column(0).to_pylist(), texts, nexts, both[: len(texts)], both[len(texts) :], ranks)
            yield pa.RecordBatch.from_arrays(columns, names=[n for n, _ in _RESULT])

    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    done = materialize(laid.mapInArrow(walk, f"{_PLAIN}, kind long, shard long, text string"), "fingerprints")
    firsts = done.where("kind = 1").select("shard", F.col("text").alias("next_text"))
    by_shard = Window.orderBy("shard")  # one row per range
    following = firsts.select(
        "shard", F.coalesce(F.lead("shard").over(by_shard), F.min("shard").over(Window.partitionBy())).alias("next"))
    lasts = done.where("kind = 2").select("shard", "doc_id", "text").join(following, "shard")
    met = lasts.join(firsts.withColumnRenamed("shard", "next"), "next").select("doc_id", "text", "next_text")
    return done.where("kind = 0").select(*(n for n, _ in _RESULT)).union(met.mapInArrow(close, _PLAIN))


_EDGES = [*_RESULT, ("kind", pa.int64()), ("shard", pa.int64()), ("text", pa.string())]
