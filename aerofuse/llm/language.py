"""Language of texts by the nearest of several centroids per language.

A text is a vector of hashed letter pairs and triples, weighted log(1 + count) times the inverse document
frequency over all training texts, of length one. Each language has up to three centroids, found by
spherical k-means on a bounded sample of its training texts (SAMPLE, a parameter of ``fit``). The language of
the centroid with the greatest cosine wins.

A text is rejected if it is too far from every centroid for its length: its cosine is below half the first
percentile of the sample's own cosines in its class of length (or what that of the nearest class suggests). A null text and one without any letter are
``und``, with score 0, and rejected. Without labelled texts every text is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerofuse.llm.names import fresh

SAMPLE = 600  # training texts per language that centroids are fitted on
CLUSTERS = 3
DIMENSIONS = 4096
MOST_LANGUAGES = 1_000
UNKNOWN = "und"
LENGTHS = 24  # classes of length: powers of two of the number of pairs and triples
_ROWS = 256


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


_BLOCK = 1 << 20  # code points of a huge text whose pairs and triples are made at a time


def _grams(text: str, block: int = _BLOCK) -> Iterator[np.ndarray]:
    """Table places of all letter pairs and triples, other characters counting as one blank, by the blocks they begin in."""
    text = text.lower()
    n, blank = len(text), np.array([32], np.uint32)
    for a in range(0, n + 1, block):  # the text stands between two blanks, so its code point k is at place k + 1
        b = min(a + block, n + 1)
        points = np.frombuffer(text[max(a - 1, 0) : b + 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        points = np.where(letter, points, blank)
        left, right = int(a == 0), int(b >= n)
        padded = np.concatenate([blank[:left], points, blank[:right]]).astype(np.uint32)
        known = np.concatenate([np.zeros(left, bool), letter, np.zeros(right, bool)])
        p, t = b - a, min(b, n) - a  # pairs and triples that begin here
        pair = padded[:p] * np.uint32(0x9E3779B1) + padded[1 : p + 1] * np.uint32(0x85EBCA77)
        triple = pair[:t] * np.uint32(0xC2B2AE3D) + padded[2 : t + 2] * np.uint32(0x27D4EB2F)
        pair, triple = pair[known[:p] | known[1 : p + 1]], triple[known[:t] | known[1 : t + 1] | known[2 : t + 2]]
        yield np.concatenate([pair, triple ^ np.uint32(0x5BD1E995)]) >> np.uint32(20)


def _counts(texts: list) -> np.ndarray:
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for k, text in enumerate(texts):
        for grams in _grams(text or ""):
            out[k] += np.bincount(grams, minlength=DIMENSIONS)
    return out


@dataclass
class Model:
    languages: list
    owner: np.ndarray  # language of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray  # least cosine, by class of length

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def predict(self, texts: list) -> tuple[list, np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        names, scores, rejected = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        for lo in range(0, len(texts), _ROWS):
            counts = _counts(texts[lo : lo + _ROWS])
            size = counts.sum(axis=1)
            if not len(self.languages):
                names += [UNKNOWN] * len(counts)
                continue
            cosine = self.vectors(counts) @ self.centroids.T
            best = cosine.argmax(axis=1)
            value = np.clip(cosine[np.arange(len(best)), best], 0, 1)
            some = size > 0
            names += [self.languages[self.owner[b]] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
            part = slice(lo, lo + len(counts))
            scores[part] = np.where(some, value, 0)
            rejected[part] = ~some | (value < self.floor[_length(size)])
        return names, scores, rejected


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _length(size: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(size, 1)).astype(np.int64), 0, LENGTHS - 1)


def _cluster(rows: np.ndarray, clusters: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; the first centre is the mean's nearest row, each further one the row farthest from all."""
    chosen = [int((rows @ rows.mean(axis=0)).argmax())]
    while len(chosen) < min(clusters, len(rows)):
        chosen.append(int((rows @ rows[chosen].T).max(axis=1).argmin()))
    centres = rows[chosen]
    for _ in range(rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        centres = _unit(np.stack([rows[nearest == k].mean(axis=0) if (nearest == k).any() else centres[k] for k in range(len(centres))]))
    return centres


def _document_frequency(train: DataFrame) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo in range(0, len(texts), _ROWS):
                total += (_counts(texts[lo : lo + _ROWS]) > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS)), pa.array(total)], names=["place", "n"])

    rows = train.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros(DIMENSIONS)
    for row in rows.collect():  # one row per dimension
        out[row["place"]] = row["n"]
    return out


def fit(labelled: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model of all labelled texts; rows without text or language are no part of it.

    Document frequencies cover every row. The centroids and the rejection limits are fitted on at most
    ``sample`` distinct texts per language, those of least hash.
    """
    train = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull())
    copies = train.groupBy("lang", F.xxhash64("text")).agg(F.count(F.lit(1)).alias("n"))
    found = copies.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct")).limit(MOST_LANGUAGES + 1).collect()
    sizes = {r["lang"]: r["distinct"] for r in found}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    total = sum(r["n"] for r in found)
    idf = (np.log((1 + total) / (1 + _document_frequency(train))) + 0.1).astype(np.float32)
    model = Model([], np.zeros(0, np.int64), np.zeros((0, DIMENSIONS), np.float32), idf, np.zeros(LENGTHS))
    if not sizes:
        return model
    # A fifth more than wanted by the hash, each text once, then exactly so many at most.
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, 1.2 * sample / n)))
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    drawn = train.where(place < share[F.col("lang")] * (1 << 30)).groupBy("lang", place.alias("place"), F.xxhash64("text").alias("hash")).agg(
        F.min("text").alias("text"))

    def vector(texts: pa.Array) -> pa.Array:
        parts = [_counts([t]) for t in texts.to_pylist()]
        flat = np.concatenate(parts).reshape(-1) if parts else np.zeros(0, np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(parts) + 1) * DIMENSIONS, pa.int32()), pa.array(flat, pa.float32()))

    def centres(table: pa.Table) -> pa.Table:
        counts = table.column("counts").combine_chunks().flatten().to_numpy().reshape(-1, DIMENSIONS)
        counts = counts[np.lexsort((table.column("hash").to_numpy(), table.column("place").to_numpy()))][:sample]
        counts = counts[counts.sum(axis=1) > 0]
        lang = table.column("lang")[0].as_py()
        if not len(counts):
            return pa.table({"lang": pa.array([], pa.string()), "centre": pa.array([], pa.list_(pa.float32())),
                             "length": pa.array([], pa.list_(pa.int64())), "cosine": pa.array([], pa.list_(pa.float64()))})
        rows = model.vectors(counts)
        found = _cluster(rows, clusters)
        own = (rows @ found.T).max(axis=1)
        n = len(found)
        return pa.table({
            "lang": [lang] * n, "centre": pa.array(list(found), pa.list_(pa.float32())),
            "length": pa.array([_length(counts.sum(axis=1)).tolist()] + [[]] * (n - 1), pa.list_(pa.int64())),
            "cosine": pa.array([own.tolist()] + [[]] * (n - 1), pa.list_(pa.float64()))})

    found = drawn.select("lang", "place", "hash", F.arrow_udf(vector, "array<float>")("text").alias("counts")).groupBy("lang").applyInArrow(
        centres, "lang string, centre array<float>, length array<bigint>, cosine array<double>")
    rows = sorted(found.collect(), key=lambda r: (r["lang"], r["centre"]))  # a few centroids per language
    model.languages = sorted({r["lang"] for r in rows})
    model.owner = np.array([model.languages.index(r["lang"]) for r in rows], np.int64)
    model.centroids = np.array([r["centre"] for r in rows], np.float32).reshape(len(rows), DIMENSIONS)
    length = np.array([x for r in rows for x in r["length"]], np.int64)
    cosine = np.array([x for r in rows for x in r["cosine"]])
    measured = [k for k in range(LENGTHS) if (length == k).sum() >= 20]
    for k in measured:
        model.floor[k] = 0.5 * np.quantile(cosine[length == k], 0.01)
    # A class with few texts takes the limit of the next shorter one; below the shortest the limit falls with
    # the root of the length, as cosines do.
    for k in range(measured[0] + 1 if measured else LENGTHS, LENGTHS):
        model.floor[k] = model.floor[k] if k in measured else model.floor[k - 1]
    for k in range(measured[0] - 1 if measured else -1, -1, -1):
        model.floor[k] = model.floor[k + 1] / np.sqrt(2)
    return model


def identify(text: Column | str, model: Model) -> Column:
    """struct(lang_pred, score, rejected) of each text."""

    def predict(texts: pa.Array) -> pa.Array:
        names, scores, rejected = model.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)],
                                          ["lang_pred", "score", "rejected"])

    return F.arrow_udf(predict, "struct<lang_pred:string,score:double,rejected:boolean>")(text)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept out of the training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text is rejected; columns stay as they are."""
    [found] = fresh(["_language"], docs)
    marked = docs.withColumn(found, identify(F.col(text_col), model))
    return marked.where(~F.col(f"{found}.rejected")).drop(found)
