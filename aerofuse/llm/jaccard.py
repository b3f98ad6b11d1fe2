"""Join of near-equal texts on sets of five-word shingles, with Bayesian pruning of candidates.

Texts with equal shingle sets form a class. The MinHash values of one text per class are compared:

1. 24 bands of 4 values put classes into buckets; two sets of similarity 0.8 miss each other in all of them
   with probability 3e-6.
2. Within a bucket, values are compared in steps of 16. After each step the number of equal values gives a
   posterior (uniform prior) that the similarity reaches the threshold; below the tolerance a pair is dropped.
3. Pairs that stay connect classes into groups. Within a group the pairs are pruned likewise, and those that
   stay are verified on the whole shingle sets.

No pair becomes a row: a bucket or a group is dealt out in blocks, every two blocks meet once in one task's
memory, and each task returns one row per class with its number of links and the least class it is linked to.

A null or empty text, or one without words, has no shingles and no links; its class is that of equal texts. A
text of fewer than five words is one shingle. Rows of equal text are in one class; rows of one id and different
texts keep their own classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerofuse.llm.components import components
from aerofuse.llm.names import fresh
from aerofuse.llm.text import blocks, mix, numbers, utf8, windows, words
from aerofuse.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS, BAND_VALUES = 24, 4
VALUES = BANDS * BAND_VALUES
STEP = 16  # MinHash values compared at a time
TOLERANCE = 1e-4  # posterior below which a pair is dropped
BLOCK = 128  # classes of a bucket or group that stand in one block
_PAIRS = 1 << 17  # pairs compared at a time

_FACTORS = (numbers(VALUES, 101) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADDED = (numbers(VALUES, 202) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = utf8(texts)
    for lo, hi in blocks(offsets):
        hashes, _, _, first = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        whole = windows(hashes, SHINGLE)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                yield np.unique(whole[a : b - SHINGLE + 1])
            elif b > a:
                yield windows(hashes[a:b], b - a) ^ np.uint64(b - a)
            else:
                yield np.zeros(0, np.uint64)


def minhash(shingles: np.ndarray) -> np.ndarray:
    out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(short), 2048):
        np.minimum(out, (short[lo : lo + 2048, None] * _FACTORS + _ADDED).min(axis=0), out=out)
    return out


def class_key(shingles: np.ndarray, text: str | None) -> bytes:
    """128 bits of the shingle set, or of the text where it has no words."""
    raw = shingles.tobytes() if len(shingles) else b"text:" + (text or "").encode()
    return hashlib.blake2b(raw, digest_size=16, person=b"set" if len(shingles) else b"text").digest()


def sketch(text: Column) -> Column:
    """struct(cls, n, values): class key, number of shingles, MinHash values (none without shingles)."""

    def make(texts: pa.Array) -> pa.Array:
        keys, sizes, values = [], [], []
        for k, shingles in enumerate(shingle_sets(texts)):
            keys.append(class_key(shingles, None if len(shingles) else texts[k].as_py()))
            sizes.append(len(shingles))
            if len(shingles):
                values.append(minhash(shingles).view(np.int32))
        ends = np.concatenate([[0], np.cumsum([VALUES if n else 0 for n in sizes])]).astype(np.int32)
        flat = np.concatenate(values) if values else np.zeros(0, np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
            ["cls", "n", "values"])

    return F.arrow_udf(make, "struct<cls:binary,n:long,values:array<int>>")(text)


def _shingles_of(text: Column) -> Column:
    """struct(cls, shingles)."""

    def make(texts: pa.Array) -> pa.Array:
        sets = list(shingle_sets(texts))
        keys = [class_key(s, None if len(s) else texts[k].as_py()) for k, s in enumerate(sets)]
        return pa.StructArray.from_arrays(
            [pa.array(keys, pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
            ["cls", "shingles"])

    return F.arrow_udf(make, "struct<cls:binary,shingles:array<bigint>>")(text)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """After each step, the least number of equal values with posterior P(similarity >= threshold) >= tolerance.

    With a uniform prior the similarity given m of n equal values is Beta(m + 1, n - m + 1), whose upper tail at
    t is the probability that a Binomial(n + 1, t) is at most m.
    """
    needed = []
    for n in range(STEP, VALUES + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        needed.append(m)
    return needed


def survivors(left: np.ndarray, right: np.ndarray, values: np.ndarray, needed: list[int]) -> np.ndarray:
    """Which of the pairs (left[i], right[i]) remain when their values are compared step by step."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int32)
    for k, least in enumerate(needed):
        part = slice(k * STEP, (k + 1) * STEP)
        equal = equal + (values[left[alive], part] == values[right[alive], part]).sum(axis=1)
        keep = equal >= least
        alive, equal = alive[keep], equal[keep]
    return alive


def _pairs(sizes: np.ndarray, own: np.ndarray, same: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs to compare in each of several consecutive groups of rows, some at a time.

    A group of one block meets itself; one of two blocks meets across, so rows of one block do not pair again.
    """
    begin = np.cumsum(sizes) - sizes
    group = np.repeat(np.arange(len(sizes)), sizes)
    row = np.arange(len(group))
    later = np.repeat(begin + sizes, sizes) - row - 1  # rows after this one in its group
    at = 0
    while at < len(row):
        stop = max(at + 1, int(np.searchsorted(np.cumsum(later[at:]), _PAIRS, "right")) + at)
        n = later[at:stop]
        left = np.repeat(row[at:stop], n)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        good = same[group[left]] | (own[left] != own[right])
        yield left[good], right[good]
        at = stop


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least row that each row is connected to."""
    root = np.arange(n)
    while len(left):
        least = np.minimum(root[left], root[right])
        np.minimum.at(root, root[left], least)
        np.minimum.at(root, root[right], least)
        while (root[root] != root).any():
            root = root[root]
        open_ = root[left] != root[right]
        left, right = left[open_], right[open_]
    return root


def _compared(rows: DataFrame, threshold: float, tolerance: float, exact: bool) -> DataFrame:
    """Compare the classes of each (bucket, low, high) block pair: rows (cls, root, links), those with links only.

    ``rows`` has bucket, low, high, block, cls, values and, if the pairs are to be verified, shingles.
    """
    needed = least_matches(threshold, tolerance)

    def work(table: pa.Table) -> pa.RecordBatch:
        groups = np.stack([np.asarray(table.column(c)) for c in ("bucket", "low", "high")])
        change = np.flatnonzero((groups[:, 1:] != groups[:, :-1]).any(axis=0)) + 1
        sizes = np.diff(np.concatenate([[0], change, [table.num_rows]]))
        first = np.cumsum(sizes) - sizes
        own = np.asarray(table.column("block"))
        values = table.column("values").combine_chunks().flatten().to_numpy().reshape(-1, VALUES)
        sets = [s.values.to_numpy() for s in table.column("shingles").combine_chunks()] if exact else None
        found = [(np.zeros(0, np.int64),) * 2]
        for left, right in _pairs(sizes, own, groups[1, first] == groups[2, first]):
            alive = survivors(left, right, values, needed)
            left, right = left[alive], right[alive]
            if exact:
                linked = np.fromiter((_similar(sets[a], sets[b], threshold) for a, b in zip(left, right, strict=True)), bool, len(left))
                left, right = left[linked], right[linked]
            found.append((left, right))
        left, right = (np.concatenate(x) for x in zip(*found, strict=True))
        links = np.bincount(left, minlength=table.num_rows) + np.bincount(right, minlength=table.num_rows)
        root = _forest(table.num_rows, left, right)
        some = np.flatnonzero(links)
        keys = table.column("cls").combine_chunks()
        return pa.RecordBatch.from_arrays(
            [keys.take(pa.array(some)), keys.take(pa.array(root[some])), pa.array(links[some], pa.int64())],
            names=["cls", "root", "links"])

    kept = ["bucket", "low", "high", "block", "cls", "values"] + ["shingles"] * exact
    dealt = rows.select(*kept).repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return dealt.mapInArrow(_by_group(work), "cls binary, root binary, links long")


def _by_group(work: Callable[[pa.Table], pa.RecordBatch]) -> Callable:
    """Run ``work`` on runs of whole (bucket, low, high) groups of sorted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last group of what is held may go on in the next batch.
            last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in range(3))
            same = np.ones(batch.num_rows, bool)
            for k in range(3):
                same &= np.asarray(batch.column(k)) == last[k]
            begin = int(np.flatnonzero(same)[0])
            if begin or (held and tuple(held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in range(3)) != last):
                done = [*held, batch.slice(0, begin)] if begin else held
                yield work(pa.Table.from_batches(done))
                held = []
            held.append(batch.slice(begin))
        if held:
            yield work(pa.Table.from_batches(held))

    return run


def _similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= threshold * (len(a) + len(b) - both) - 1e-9


def _in_blocks(rows: DataFrame, size: str) -> DataFrame:
    """Deal the rows of each bucket of ``size`` classes into blocks and repeat each row for every block it meets."""
    n = F.greatest(F.lit(1), F.ceil(F.col(size) / F.lit(BLOCK)).cast("int"))
    dealt = rows.withColumn("blocks", n).withColumn("block", F.pmod(F.xxhash64("cls", F.lit(7)), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashed: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, cls, n, values, and with ``hashed`` h, a hash of the text; written once."""
    made = docs.select(F.col(id_col).cast("long").alias("doc_id"), sketch(F.col(text_col)).alias("s"), F.xxhash64(text_col).alias("h"))
    return materialize(made.select("doc_id", "s.cls", "s.n", "s.values", *(["h"] if hashed else [])), "sketches")


def near_classes(docs: DataFrame, drawn: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per class: cls, class_id (least doc_id), n, n_links (other classes within the threshold), root.

    ``drawn`` are the sketches of ``docs``; root is the least class of the group of linked classes.
    """
    classes = materialize(
        drawn.groupBy("cls").agg(F.min("doc_id").alias("class_id"), F.first("n").alias("n"), F.first("values").alias("values")),
        "classes")
    some = classes.where(F.col("n") > 0)
    number = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    keys = some.select("cls", "values", number).select(
        "cls", F.xxhash64("band", F.slice("values", F.col("band") * BAND_VALUES + 1, BAND_VALUES)).alias("bucket"))
    sizes = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    shared = materialize(keys.join(sizes, "bucket"), "buckets")
    candidates = _in_blocks(shared, "size").join(some.select("cls", "values"), "cls")
    stars = _compared(candidates, threshold, tolerance, exact=False).select("cls", "root").distinct()
    groups = components(materialize(stars.select(F.col("cls").alias("a"), F.col("root").alias("b")), "stars"), "groups")
    sized = groups.join(groups.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "root")
    members = materialize(
        sized.select(F.col("node").alias("cls"), "root", "size").join(some.select("cls", "class_id", "values"), "cls"), "members")
    # One document of each class brings its shingles; a document of the same id and another class drops out.
    texts = docs.select(F.col(id_col).cast("long").alias("class_id"), F.col(text_col).alias("text"))
    # The list of wanted documents grows with the input, so it is never broadcast.
    wanted = members.select("class_id").distinct().hint("merge")
    sets = texts.join(wanted, texts["class_id"].eqNullSafe(wanted["class_id"]), "left_semi").select(
        "class_id", _shingles_of(F.col("text")).alias("s")).select("class_id", "s.cls", "s.shingles")
    full = members.join(sets.select("cls", "shingles").dropDuplicates(["cls"]), "cls")
    verified = _compared(
        _in_blocks(full.withColumn("bucket", F.xxhash64("root")), "size"), threshold, tolerance, exact=True)
    links = materialize(verified.groupBy("cls", "root").agg(F.sum("links").alias("links")), "links")
    joined = components(links.select(F.col("cls").alias("a"), F.col("root").alias("b")), "joined")
    counted = links.groupBy("cls").agg(F.sum("links").alias("n_links"))
    found = joined.withColumnRenamed("node", "cls").join(counted, "cls", "left")
    return classes.select("cls", "class_id", "n").join(found, "cls", "left").select(
        "cls", "class_id", "n", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "cls").alias("root"))


def near_join(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, group_id, n_links.

    class_id is the least id among rows of equal shingle sets, group_id the least id among all classes that are
    linked, directly or through others, n_links the number of other classes with similarity >= threshold. Classes are told
    apart by their shingles: where rows of different texts share an id, two classes may have the same class_id.
    """
    drawn = sketches(docs, id_col, text_col)
    classes = materialize(near_classes(docs, drawn, threshold, id_col=id_col, text_col=text_col), "near-classes")
    least = classes.groupBy("root").agg(F.min("class_id").alias("group_id"))
    named = classes.join(least, "root").select("cls", "class_id", "group_id", "n_links")
    return drawn.select("doc_id", "cls").join(named, "cls").select("doc_id", "class_id", "group_id", "n_links")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, that of the least id; columns stay as they are.

    Of rows that share this id and are in the group one stays, the one whose text has the least hash; rows of the id
    in other groups are judged there. A group whose rows have no id at all keeps one of them.
    """
    drawn = sketches(docs, id_col, text_col, hashed=True)
    classes = materialize(near_classes(docs, drawn, threshold, id_col=id_col, text_col=text_col), "near-classes")
    first = F.min(F.struct(F.col("class_id").isNull().alias("none"), "class_id", "cls")).alias("x")
    chosen = classes.groupBy("root").agg(first).select("x.class_id", "x.cls")
    least = drawn.join(chosen, "cls").where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.min("h").alias("h"))
    kept_id, kept_hash = fresh(["_id", "_hash"], docs)
    kept = materialize(least.select(F.col("doc_id").alias(kept_id), F.col("h").alias(kept_hash)), "kept")
    same = F.col(id_col).cast("long").eqNullSafe(F.col(kept_id)) & (F.xxhash64(text_col) == F.col(kept_hash))
    # The list of kept documents grows with the input, so it is never broadcast.
    rows = docs.join(kept.hint("merge"), same, "left_semi")
    if drawn.groupBy("doc_id", "h").count().where("count > 1").isEmpty():
        return rows
    return rows.dropDuplicates([id_col, text_col])
