"""Fingerprints, language, repeated lines, near duplicates and leaks against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerofuse.llm import components, decontaminate, fingerprint, jaccard, language, line_runs
from tests.llm.conftest import DOCS, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=0, max_size=400))
def test_running_entropy(data):
    x = np.frombuffer(data, np.uint8)
    expected = []
    for t in range(len(x) - 63):
        counts = Counter(x[t : t + 64].tolist()).values()
        expected.append(int(-sum(c / 64 * math.log2(c / 64) for c in counts) / 6 * 1000 + 1e-6))
    assert np.abs(fingerprint.entropy_levels(x) - np.array(expected, np.int64).reshape(-1)).max(initial=0) <= 1


def test_fingerprints(awkward, awkward_rows, nothing, many_shards):
    rows = fingerprint.fingerprints(awkward).collect()
    assert len(rows) == len(awkward_rows)
    by_hash = defaultdict(set)
    known = {(r[0], len(r[1] or "")) for r in awkward_rows}
    for r in rows:
        assert (r["doc_id"], r["n_chars"]) in known
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["n_chars"] < 4:
            assert r["near_edited"] == 1  # nothing is replaced
        by_hash[(r["doc_id"], r["n_chars"])].add(r["fingerprint"])
    assert all(len(f) == 1 for f in by_hash.values())
    ordered = {r["doc_id"]: r for r in rows}
    text = {r[0]: r[1] or "" for r in awkward_rows}
    for a, b in zip(range(5, 16), range(6, 17), strict=True):
        cut = len(text[a]) // 4
        edited = text[a][: len(text[a]) - cut] + text[b][:cut]
        assert ordered[a]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert ordered[5]["near_next"] > 0.7  # a near copy
    assert ordered[10]["near_next"] < 0.5
    assert fingerprint.fingerprints(nothing).count() == 0


def test_short_texts_are_like_their_near_copies():
    rng = random.Random(4)
    ranks = fingerprint.ranks_of(np.arange(fingerprint.LEVELS + 1)[::-1])
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400))
    other = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ-") for _ in range(400))
    for n in range(4, 256):
        text = long[:n]
        edited, unlike, longer = text[: n - n // 4] + other[: n // 4], other[:n], long[: n + 1]
        # Alone and among others, the digest is the same.
        digests = fingerprint.digests([text, edited, unlike, longer], ranks)
        assert all((fingerprint.digests([t], ranks)[0] == d).all() for t, d in zip([text, edited, unlike, longer], digests, strict=True))
        assert all(len(d) == 1 for d in digests)
        own, near, far, next_ = digests
        assert fingerprint.likeness(own, own) == 1
        assert fingerprint.likeness(own, near) > 0.3, n
        assert fingerprint.likeness(own, next_) > 0.6, n
        assert fingerprint.likeness(own, far) < 0.1, n


def test_slices_of_a_long_text_change_nothing():
    rng = random.Random(3)
    long = " ".join(rng.choice(["red", "green", "blue", "seventeen", "of"]) + str(rng.randrange(999)) for _ in range(60_000))
    ranks = fingerprint.ranks_of(np.arange(fingerprint.LEVELS + 1)[::-1])
    whole = fingerprint.digests([long], ranks)[0]
    old, fingerprint._BLOCK = fingerprint._BLOCK, 1 << 14
    try:
        assert (fingerprint.digests([long], ranks)[0] == whole).all()
    finally:
        fingerprint._BLOCK = old


def test_rarest_window_at_the_end_of_a_long_text(monkeypatch):
    ranks = fingerprint.ranks_of(np.arange(fingerprint.LEVELS + 1)[::-1])
    tail = "".join(chr(97 + k % 26) for k in range(20))  # too short for a popular window
    texts = ["x" * n + tail for n in (300, 1000, 5000, 200_000)]
    among_others = fingerprint.digests(["y" * 200, *texts[:1]], ranks)[1]
    for block in (1 << 17, 1 << 9):
        monkeypatch.setattr(fingerprint, "_BLOCK", block)
        for text in texts:
            assert (fingerprint.digests([text], ranks)[0] == among_others).all()


def test_language(spark, awkward, nothing):
    rng = random.Random(1)
    kinds = {"aa": "ka lo mi nu".split(), "bb": "strö wech übt gran".split(), "cc": "qui eau oux elle".split()}
    rows = []
    for k in range(300):
        lang = ["aa", "bb", "cc"][k % 3]
        rows.append((k, " ".join("".join(rng.choice(kinds[lang]) for _ in range(3)) for _ in range(40)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = language.held_out()
    model = language.fit(docs.where(~held), sample=40)
    found = docs.where(held).select("lang", language.identify("text", model).alias("f")).select("lang", "f.*").collect()
    assert sum(r["lang"] == r["lang_pred"] and not r["rejected"] for r in found) >= 0.97 * len(found)
    odd = spark.createDataFrame([(None,), ("",), ("12 %",), ("漢字漢字" * 50,)], "text string")
    results = [tuple(r["f"]) for r in odd.select(language.identify("text", model).alias("f")).collect()]
    assert results[:3] == [("und", 0.0, True)] * 3
    assert results[3][2]  # far from everything
    assert awkward.select(language.identify("text", language.fit(nothing)).alias("f")).where("f.lang_pred != 'und'").count() == 0
    kept = language.keep_identified(awkward, language.fit(awkward))
    assert kept.columns == awkward.columns and kept.where("text IS NULL OR text = ''").count() == 0


def test_copies_of_a_drawn_text_are_one_of_the_sample(spark):
    rng = random.Random(6)
    some = [" ".join("".join(rng.choice("ka lo mi nu re so ti wa".split()) for _ in range(3)) for _ in range(30)) for _ in range(300)]
    texts = spark.createDataFrame([(t, "aa") for t in some], "text string, lang string")
    from pyspark.sql import functions as F

    least = texts.orderBy(F.pmod(F.xxhash64("text"), F.lit(1 << 30))).first()["text"]  # is drawn for certain
    many = texts.union(spark.createDataFrame([(least, "aa")] * 30_000, "text string, lang string"))
    model = language.fit(many, sample=40)
    assert len(np.unique(model.centroids.round(4), axis=0)) == language.CLUSTERS


def deleted_lines(rows, least):
    """Brute force: stretches of ``least`` words that occurred before."""
    lines = {k: (t or "").split("\n") for k, t in enumerate(t for _, t in rows)}
    spans = []
    for k, own in lines.items():
        size = [len(x.split()) for x in own]
        for a in range(len(own)):
            for b in range(a, len(own)):
                if sum(size[a : b + 1]) >= least:
                    if sum(size[a:b]) < least or sum(size[a + 1 : b + 1]) < least:
                        spans.append((k, a, b))
                    if sum(size[a:b]) >= least:
                        break
    first = {}
    for k, a, b in spans:
        key = tuple(lines[k][a : b + 1])
        first[key] = min(first.get(key, (k, a)), (k, a))
    gone = defaultdict(set)
    for k, a, b in spans:
        if first[tuple(lines[k][a : b + 1])] != (k, a):
            gone[k] |= set(range(a, b + 1))
    return ["\n".join(x for i, x in enumerate(own) if i not in gone[k]) for k, own in lines.items()]


@pytest.mark.parametrize("seed", range(4))
def test_line_runs_against_brute_force(spark, many_shards, seed):
    rng = random.Random(seed)
    rows = [(k, "\n".join(rng.choice(["a b c", "d e", "f", "", f"only {k} {rng.random()}"]) for _ in range(rng.randrange(1, 25)))) for k in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in line_runs.without_copies(docs, min_words=7).collect()}
    assert [found[k] for k, _ in rows] == deleted_lines(rows, 7)


def test_line_runs_of_awkward_texts(awkward, nothing):
    rows = line_runs.without_copies(awkward).collect()
    assert len(rows) == awkward.count()
    assert [r["text"] for r in rows if r["doc_id"] == 1] == [prose(1)] * 2  # rows of one id and text
    assert [r["text"] for r in rows if r["doc_id"] == 2] == [""]
    assert [r["text"] for r in rows if r["doc_id"] == 14] == [prose(14)]
    assert line_runs.without_copies(nothing).count() == 0


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def test_near_join_against_brute_force(spark, awkward, nothing, many_shards):
    rng = random.Random(5)
    rows = []
    for group in range(12):
        base = [f"g{group}w{j}" for j in range(rng.choice([30, 60, 300]))]
        for k in range(rng.choice([1, 2, 40])):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = f"x{rng.random()}"
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + k, t) for k, t in enumerate(["", None, "...", "one two", "One two!"])]
    found = {r["doc_id"]: r for r in jaccard.near_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: shingles(t) or (t or "",) for i, t in rows}
    classes = defaultdict(list)
    for i, s in sets.items():
        classes[s].append(i)
    reps = {s: min(v) for s, v in classes.items()}
    links = defaultdict(set)
    worded = [s for s in classes if isinstance(s, frozenset)]
    for s in worded:
        for t in worded:
            if s is not t and len(s & t) >= 0.8 * len(s | t):
                links[reps[s]].add(reps[t])
    for i, s in sets.items():
        reach, todo = {reps[s]}, [reps[s]]
        while todo:
            todo += (new := [x for x in links[todo.pop()] if x not in reach])
            reach |= set(new)
        assert (found[i]["class_id"], found[i]["n_links"], found[i]["group_id"]) == (reps[s], len(links[reps[s]]), min(reach))
    assert jaccard.near_join(nothing).count() == 0
    kept = jaccard.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 6 not in ids and {5, 7, 9, 12, 13, 14, 15} <= set(ids)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(40)] + [(200, 200)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert found == root


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.lists(st.integers(0, 3), max_size=9), max_size=5))
def test_search_against_brute_force(text, items):
    own = " ".join("abcd"[k] for k in text).upper()
    given_items = [(str(k), "-".join("abcd"[x] for x in item)) for k, item in enumerate(items)]
    import pyarrow as pa

    [(_, n, hits)] = decontaminate._search(pa.array([own]), decontaminate.tables_of(given_items, window=4))
    found = [(i, p, table.length) for table, places, windows in hits for p, w in zip(places.tolist(), windows.tolist(), strict=True) for i in table.items[w]]
    expected = set()
    w = words(own)
    for name, item in given_items:
        pattern = words(item)
        m = min(4, len(pattern))
        for a in range(len(pattern) - m + 1) if m else ():
            expected |= {(name, p, m) for p in range(len(w) - m + 1) if w[p : p + m] == pattern[a : a + m]}
    assert n == len(w) and set(found) == expected
    covered = {p + k for _, p, m in expected for k in range(m)}
    assert [x for r in decontaminate._merged(hits) for x in range(r["s"], r["e"])] == sorted(covered)


@pytest.mark.parametrize("block_items", [1, 4000])
def test_contamination_of_awkward_texts(spark, awkward, nothing, block_items):
    items = spark.createDataFrame([(1, prose(1, 20)), (2, "ONE"), (None, "one"), (3, None), (4, "..."), (2, "one")], "item_id long, text string")
    marked = decontaminate.contamination(awkward, items, block_items=block_items, into="leak")
    rows = [(r["doc_id"], r["leak"]["n_hit"], r["leak"]["items"]) for r in marked.collect()]
    assert len(rows) == awkward.count()
    assert {r for r in map(str, rows) if "(10," in r or "(11," in r} == {"(10, 1, ['2'])", "(11, 1, ['2'])"}
    assert [r[1:] for r in rows if r[0] in (1, 2, 14)] == [(20, ["1"])] * 4
    assert [r[1:] for r in rows if r[0] in (3, 4, 5)] == [(0, [])] * 3
    assert decontaminate.contamination(nothing, items).count() == 0
    assert decontaminate.remove_hits(awkward, spark.createDataFrame([], "item_id long, text string")).count() == awkward.count()
    assert spark.createDataFrame([], DOCS).columns == decontaminate.remove_hits(awkward, items).columns


def test_items_without_id_are_searched(spark, nothing, tmp_path):
    passage = prose(21, 20)
    texts = [(1, passage), (2, "lone"), (3, "named"), (4, "named and lone"), (5, "clean")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "n", "h", "s", "c") for i, t in texts], DOCS)
    items = spark.createDataFrame([(None, passage), (None, "lone"), (7, "named")], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.remove_hits(docs, items).collect()] == [5]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    from aerofuse.llm.queries import QUERIES

    rows = QUERIES["op7_wu_manber"](spark, str(tmp_path)).collect()
    sha = lambda ids: hashlib.sha256(ids.encode()).hexdigest()
    assert {r["doc_id"]: (r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows} == {
        1: (20, 1, sha(""), True), 2: (1, 1, sha(""), True), 3: (1, 1, sha("7"), True),
        4: (2, 2, sha("7"), True), 5: (0, 0, sha(""), False)}


def test_grams_of_a_text_in_blocks():
    rng = random.Random(8)
    for n in (0, 1, 2, 3, 10, 64, 200):
        text = "".join(rng.choice("abΣé İ1\n") for _ in range(n))
        whole = np.sort(np.concatenate(list(language._grams(text))))
        for block in (1, 2, 3, 7, 63, 64):
            assert (np.sort(np.concatenate(list(language._grams(text, block)))) == whole).all()
        lower = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
        grams = [lower[k : k + m] for m in (2, 3) for k in range(len(lower) - m + 1)]
        assert len(whole) == sum(g != " " * len(g) for g in grams)


def test_rows_that_share_an_id_are_kept_by_their_class(spark):
    a, b = prose(31, 400), prose(32, 400)
    near = b.replace("word32x7b", "other")
    docs = spark.createDataFrame([(5, a), (5, near), (3, b), (3, b), (None, prose(33)), (None, prose(33))], "doc_id long, text string")
    kept = jaccard.keep_one(docs).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(5, a), (3, b), (0, prose(33))])
    found = Counter((r["doc_id"], r["group_id"], r["n_links"]) for r in jaccard.near_join(docs).collect())
    assert found == {(5, 5, 0): 1, (5, 3, 1): 1, (3, 3, 1): 2, (None, None, 0): 2}


CLASHING = ["_language", "_leak", "into", "_leak_0", "_found_0", "_found", "_digest", "_kept", "_id", "_hash", "_d", "_h", "_runs", "_key", "_doc", "_deleted",
            "cls", "values", "s", "e", "n", "rank", "run", "h_", "_KEY_"]


def test_stages_keep_columns_of_any_name(spark, awkward, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    spark.createDataFrame([(1, prose(14, 20))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    wide = docs.select("*", *(F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))).alias(c) for c in CLASHING))
    for _, stage in pipeline.STAGES[:-1]:
        plain = Counter((r["doc_id"], r["text"]) for r in stage(spark, docs, str(tmp_path)).collect())
        out = stage(spark, wide, str(tmp_path))
        assert out.columns == wide.columns
        rows = out.collect()
        assert Counter((r["doc_id"], r["text"]) for r in rows) == plain
        assert all(r[c] == f"{c} of {'?' if r['doc_id'] is None else r['doc_id']}" for r in rows for c in CLASHING)
    assert pipeline.STAGES[-1][1](spark, wide, str(tmp_path)).count() > 0


def test_hits_of_a_repeated_item_are_stretches(spark):
    items = spark.createDataFrame([(k, "again") for k in range(300)] + [(1000, "again and again"), (None, "again")], "item_id long, text string")
    text = "again " * 50_000 + "and again, never"
    docs = spark.createDataFrame([(1, text), (2, "again and")], "doc_id long, text string")
    rows = {r["doc_id"]: r["leak"] for r in decontaminate.contamination(docs, items, into="leak").collect()}
    assert rows[1]["n_hit"] == 50_002 and len(rows[1]["items"]) == 301 and rows[1]["unnamed"]
    assert rows[2]["n_hit"] == 1 and len(rows[2]["items"]) == 300
    some = decontaminate.contamination(docs.where("doc_id = 2"), items, into="leak", with_spans=True, block_items=100).first()["leak"]
    assert len(some["spans"]) == 301 and {(s["start"], s["length"]) for s in some["spans"]} == {(0, 1)}


def test_blocks_of_items_give_what_one_search_gives(spark):
    texts = [(k, " and ".join(prose(s, 15) for s in (k % 4, 40 + k))) for k in range(12)] * 2 + [(50, None), (51, ""), (52, "lone end")]
    docs = spark.createDataFrame([(i, t, "own", 7) for i, t in texts], "doc_id long, text string, _found string, _digest long")
    items = spark.createDataFrame(
        [(k, prose(k, 15)) for k in range(3)] * 2 + [(9, prose(45, 15)), (None, prose(46, 15)), (8, "lone"), (5, "never")], "item_id long, text string")

    def of(**options):
        rows = decontaminate.contamination(docs, items, into="leak", with_spans=True, **options).collect()
        return sorted((r["doc_id"], r["_found"], r["_digest"], r["leak"]["n_words"], r["leak"]["n_hit"], r["leak"]["items"], r["leak"]["unnamed"],
                       sorted((s["item"] or "", s["start"], s["length"]) for s in r["leak"]["spans"])) for r in rows)

    one = of()
    # Nine of the twelve texts hold one of the items 0 to 2, each text twice, and one is the lone word.
    assert len(one) == len(texts) and sum(r[4] > 0 for r in one) == 19
    assert of(block_items=2) == one and of(block_items=1) == one
    sizes = [len(b) for b in decontaminate.item_blocks(items, 2, "item_id", "text")[1]]
    assert sum(sizes) == 7  # repeated items are searched once
