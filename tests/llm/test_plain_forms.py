"""Operators without a statement against plain forms of their method: windows and filters, TF-IDF and cosines,
BM25 scores, features of URLs."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pytest

from aerofuse.llm import fingerprint, language, url_filter
from aerofuse.llm.deploy import prepare_tasks
from aerofuse.llm.text import mix


def _words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(1, 9))) for _ in range(n))


# op1


def _hash(window: bytes) -> int:
    value = np.zeros(1, np.uint64)
    for part, seed in zip(np.frombuffer(window, np.uint64), fingerprint._SEEDS, strict=True):
        value = mix(value ^ (part + seed))
    return int(value[0])


def _short_hash(window: bytes) -> int:
    value = np.frombuffer(window, np.uint64)
    return int(mix(mix(value + fingerprint._SEEDS[7]) + np.uint64(8))[0])


def _bits(hashes: list[int]) -> list[set[int]]:
    """Positions set in each chained filter."""
    chained = [hashes[k : k + 160] for k in range(0, len(hashes), 160)]
    return [{(h >> (11 * k)) % 2048 for h in some for k in range(5)} for some in chained]


def _long_features(text: bytes, ranks: np.ndarray) -> list[int]:
    windows = [text[k : k + 64] for k in range(len(text) - 63)]
    rank = [int(ranks[fingerprint.entropy_levels(np.frombuffer(w, np.uint8))[0]]) for w in windows]
    noted: Counter = Counter()
    for k in range(len(windows) - 63):
        best = min(range(k, k + 64), key=lambda j: (rank[j], j))
        if rank[best] <= 1000:
            noted[best] += 1
    return [_hash(windows[k]) for k in sorted(noted) if noted[k] >= 16]


def _short_features(text: bytes) -> list[int]:
    hashes = [_short_hash(text[k : k + 8]) for k in range(len(text) - 7)]
    taken = {j for k in range(len(hashes) - 3) for j in range(k, k + 4) if hashes[j] == min(hashes[k : k + 4])}
    return [hashes[k] for k in sorted(taken)]


def test_windows_and_filters_of_fingerprints():
    rng = random.Random(3)
    texts = [_words(rng, n) for n in (60, 400, 2500, 90)] + ["ab" * 400 + _words(rng, 80)]
    texts += [_words(rng, 60)[:n] for n in (32, 50, 99, 127)]
    counts = sum(np.bincount(fingerprint.entropy_levels(np.frombuffer(t.encode(), np.uint8)), minlength=1001) for t in texts)
    ranks = fingerprint.ranks_of(counts)
    for text, digest in zip(texts, fingerprint.digests(texts, ranks), strict=True):
        data = text.encode()
        assert not 128 <= len(data) < 256  # there both kinds of windows count
        expected = _bits(_long_features(data, ranks) if len(data) >= 256 else _short_features(data))
        assert [set(np.flatnonzero(np.unpackbits(row)).tolist()) for row in digest] == expected
    assert max(map(len, fingerprint.digests(texts, ranks))) > 1  # a chain


def test_likeness_of_fingerprints():
    rng = np.random.default_rng(5)
    for _ in range(40):
        a, b = (rng.random((rng.integers(1, 4), 2048)) < rng.uniform(0.02, 0.4) for _ in range(2))
        b[0] |= a[0] & (rng.random(2048) < 0.7)
        short, long = sorted(([set(np.flatnonzero(r).tolist()) for r in x] for x in (a, b)), key=len)
        best = []
        for row in short:
            shares = []
            for other in long:
                most, chance = min(len(row), len(other)), len(row) * len(other) / 2048
                floor = chance + 0.3 * (most - chance)
                shares.append(min(1, max(0, (len(row & other) - floor) / (most - floor))))
            best.append(max(shares))
        assert fingerprint.likeness(np.packbits(a, axis=1), np.packbits(b, axis=1)) == pytest.approx(sum(best) / len(best))


# op3


def _places(text: str) -> Counter:
    """Table places of letter pairs and triples that hold a letter; other characters are one blank each."""
    points = [32, *(ord(c) if c.isalpha() else 32 for c in text.lower()), 32]
    out: Counter = Counter()
    for k in range(len(points) - 1):
        pair = (points[k] * 0x9E3779B1 + points[k + 1] * 0x85EBCA77) % 2**32
        if points[k : k + 2] != [32, 32]:
            out[pair >> 20] += 1
        if k + 2 < len(points) and points[k : k + 3] != [32, 32, 32]:
            triple = (pair * 0xC2B2AE3D + points[k + 2] * 0x27D4EB2F) % 2**32 ^ 0x5BD1E995
            out[triple >> 20] += 1
    return out


def test_weights_and_cosines_of_languages(spark):
    prepare_tasks(spark)
    rng = random.Random(8)
    letters = {"one": "abcdefgh", "two": "mnopqrstü"}
    rows = [(k, " ".join("".join(rng.choices(letters[lang], k=rng.randint(2, 7))) for _ in range(rng.randint(5, 60))) + ("!" * (k % 3)), lang)
            for k, lang in enumerate(["one", "two"] * 30)]
    train = spark.createDataFrame([*rows, (98, None, "one"), (99, "no language", None)], "doc_id long, text string, lang string")
    model = language.fit(train)
    found: Counter = Counter()
    for _, text, _ in rows:
        found.update(_places(text).keys())
    assert np.allclose(model.idf, [math.log((1 + len(rows)) / (1 + found[p])) + 0.1 for p in range(language.DIMENSIONS)], atol=1e-5)
    texts = [t for _, t, _ in rows[:12]] + ["abc mno", "zzz", "x", "12 34"]
    names, scores, rejected = model.predict(texts)
    for text, name, score, out in zip(texts, names, scores, rejected, strict=True):
        vector = {p: math.log1p(n) * float(model.idf[p]) for p, n in _places(text).items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        if not vector:
            assert (name, score, out) == ("und", 0, True)
            continue
        cosines = [sum(v * float(c[p]) for p, v in vector.items()) / norm / np.linalg.norm(c) for c in model.centroids]
        assert score == pytest.approx(max(0, max(cosines)), abs=1e-5)
        assert cosines[[k for k, o in enumerate(model.owner) if model.languages[o] == name][0]] <= max(cosines) + 1e-6
        assert max(c for c, o in zip(cosines, model.owner, strict=True) if model.languages[o] == name) == pytest.approx(max(cosines), abs=1e-5)
    assert [names[k] for k in range(12)] == [lang for _, _, lang in rows[:12]]


# op5


def test_neighbours_by_plain_bm25():
    pytest.importorskip("public_tokenizers")
    from aerofuse.llm import packing

    rng = np.random.default_rng(2)
    terms = 400
    texts = [np.minimum(rng.zipf(1.3, rng.integers(0, 120)), terms - 1).astype(np.uint16) for _ in range(80)]
    texts[7] = texts[3].copy()  # a tie
    frequency = Counter(t for ids in texts for t in set(ids.tolist()))
    mean = sum(map(len, texts)) / len(texts)
    idf = np.array([math.log1p((len(texts) - frequency[t] + 0.5) / (frequency[t] + 0.5)) for t in range(terms)])

    def weights(ids: np.ndarray) -> dict[int, float]:
        return {t: idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ids) / mean)) for t, n in Counter(ids.tolist()).items()}

    own = [weights(ids) for ids in texts]
    index = packing.Index(texts, idf, mean)
    for seed, weight in enumerate(own):
        if not weight:
            continue
        asked = sorted(weight, key=lambda t: (-weight[t], t))[: packing.QUERY_TERMS]
        score = {k: sum(other[t] for t in asked if t in other) for k, other in enumerate(own) if any(t in other for t in asked)}
        found = index.neighbours(seed).tolist()
        assert sorted(found) == sorted(score)
        assert [score[k] for k in found] == pytest.approx(sorted(score.values(), reverse=True))


# op8

URLS = [
    "https://www.Example.com/en/page-12.html?a=1&b=2#top", "http://shop.net/es/a//b/2024/", "ftp://x", "no host/at?all", "://", "", None,
    "https://a.b.c.org?x=", "http://host.com/#f?a=1&b=2", "https://example.com/en/?q=a%20b&&c", "http://ünï.net/fr/ä-ö-9", "https://h.io/?",
]


def _entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def test_features_of_urls(spark):
    frame = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "page long, url string").withColumns(
        {"host": url_filter.host_of(url_filter.F.col("url")), "path": url_filter.path_of(url_filter.F.col("url"))})
    rows = {r["page"]: r for r in url_filter.lexical(frame).collect()}
    for k, url in enumerate(URLS):
        row, url = rows[k], url or ""
        parts = urlsplit(url) if "://" in url and not url.startswith("://") else urlsplit("")
        host, path = re.sub("[A-Z]", lambda m: m[0].lower(), parts.netloc), parts.path
        query = (re.search(r"\?([^#]*)", url) or [None, ""])[1]
        expected = {
            "host": host, "path": path, "suffix": host.split(".")[-1], "length": len(url), "host_length": len(host), "labels": len(host.split(".")),
            "depth": len(re.findall("/[^/]", path)), "digits": len(re.findall("[0-9]", url)) / max(len(url), 1),
            "letters": len(re.findall("[A-Za-z]", url)) / max(len(url), 1), "hyphens": url.count("-"), "parameters": query.count("&") + 1 if query else 0,
            "fragment": float("#" in url), "secure": float(url.startswith("https")), "suffix_length": len(host.split(".")[-1]),
            "last_digits": len(re.findall("[0-9]", path.split("/")[-1])),
        }
        assert {x: row[x] for x in expected} == pytest.approx(expected), url
        assert row["entropy"] == pytest.approx(_entropy(url) if url else 0.0)


def test_shares_of_suffixes(spark):
    rows = [("com", "block")] * 3 + [("com", "allow")] + [("org", "allow")] * 2 + [(None, "block")]
    found = url_filter._shares(spark.createDataFrame(rows, "suffix string, verdict string"), "suffix", "share").collect()
    assert {r["suffix"]: r["share"] for r in found} == pytest.approx({"com": 4 / 6, "org": 1 / 4, None: 2 / 3})
