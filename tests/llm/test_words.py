"""Spelling variants, collocations and quality rules against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerofuse.llm import automata, collocations, quality_rules, spelling
from aerofuse.llm.deploy import prepare_tasks


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_hand(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        others = [(-counts[x], x) for x in counts if near(w, x)]
        best = min(others, default=None)
        formed = best is not None and -best[0] >= ratio * n
        out[w] = [best[1] if formed else None, n, len(others), -best[0] if formed else None]
    rows = {}
    for w, (form, n, k, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows[w] = (form, root, n, k, form_n)
    return rows


@pytest.mark.parametrize("shard_words", [1, 3, 40, 100_000])
def test_variants_equal_brute_force(spark, shard_words):
    draw = random.Random(shard_words)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(1, 7))) for _ in range(160)}
    words |= {"aaaaaa", "aaaaa", "aaaa", "aaba", "abab", "", "z" * 3000, "z" * 2999, "z" * 1500 + "y" + "z" * 1499}
    words.discard("")
    counts = {w: 5 ** draw.randint(1, 5) + draw.randint(0, 2) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
           for r in spelling.variants(df, shard_words=shard_words).collect()}
    assert got == variants_by_hand(counts)


def counts_by_hand(rows, min_length, min_count):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lower(text)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += len(run) >= min_length
    return {w: n for w, n in found.items() if n >= min_count}


def test_counts_of_awkward_rows(spark, awkward, awkward_rows, nothing, many_shards):
    rows = [r[:2] for r in awkward_rows] + [(k, "Éclair ÉCLAIR naïveté spelling spelling") for k in range(100, 700)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit(1), "n": F.lit(2), "id": F.lit(3)})
    got = {r["word"]: r["n"] for r in spelling.word_counts(df).collect()}
    assert got == counts_by_hand(rows, 6, 5) and len(got) >= 3
    assert {r["word"]: r["n"] for r in spelling.word_counts(awkward, 4, 2).collect()} == counts_by_hand([r[:2] for r in awkward_rows], 4, 2)
    full = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.spelling_variants(df).collect()}
    assert full == variants_by_hand(got)
    assert spelling.spelling_variants(nothing).count() == 0


def test_no_row_meets_more_words_than_there_are_characters(spark):
    """A very frequent word and all its variants: groups stay as small as the alphabet."""
    words = [("hot" + c + d + "word", 5) for c in "abcdefghij" for d in "abcdefghij"]
    nodes = spelling.trie_nodes(spark.createDataFrame(words, "key string, n long"), 100)
    back = spelling.trie_nodes(spark.createDataFrame([(w[::-1],) for w, _ in words], "key string"), 100)
    both = nodes.withColumnRenamed("key", "word").join(
        back.select(F.reverse("key").alias("word"), F.col("nodes").alias("back")), "word").withColumn("n", F.lit(5))
    largest = spelling._pairs(both).groupBy("prefix", "suffix").count().agg(F.max("count")).first()[0]
    assert largest <= 10
    assert {r["n_near"] for r in spelling.neighbours(both).collect()} == {18}


# Automata and collocations.


@pytest.mark.parametrize("seed", range(40))
def test_automata_keep_sequences_sums_and_parts(seed):
    draw = random.Random(seed)
    words = sorted({b"w%d" % draw.randint(0, 20) for _ in range(draw.choice([1, 2, 3, 6]))})
    known = {}
    for _ in range(draw.randint(0, 40)):
        n = draw.randint(1, 4)
        known[tuple(draw.randint(1, len(words)) for _ in range(n)) + (0,) * (4 - n)] = draw.choice([1, 1, 1, 2, 300, 70_000])
    rows = np.array(sorted(known), np.int64).reshape(-1, 4)
    weights = np.array([known[tuple(r)] for r in rows.tolist()], np.int64)
    automaton = automata.Automaton.load(automata.Automaton.of_sorted(words, rows, weights).dump())
    found, weight = automaton.sequences()
    assert (found == rows).all() and (weight == weights).all()
    asked = np.array([[(draw.randint(1, len(words)) if draw.random() < 0.9 else -1) if j < n else 0 for j in range(4)]
                      for n in [draw.randint(1, 4) for _ in range(60)]])
    assert automaton.compose(asked).tolist() == [known.get(tuple(a), 0) for a in asked.tolist()]
    named, twice, weight = automata.united([automaton.dump()] * 2)
    assert named == words and (twice == rows).all() and (weight == 2 * weights).all()
    for depth in (1, 2, 3, 4):
        some, n = automata.prefix_weights(rows, weights, depth)
        expected = defaultdict(int)
        for r, w in known.items():
            expected[r[:depth]] += w * (r[depth - 1] > 0)
        assert {tuple(r): k for r, k in zip(some.tolist(), n.tolist(), strict=True)} == {r: k for r, k in expected.items() if k}
    # Equal endings are one state.
    for layer in automaton.layers:
        states = [tuple(zip(*(x[a:b].tolist() for x in (layer.label, layer.weight, layer.target)), strict=True))
                  for a, b in zip(layer.first[:-1], layer.first[1:], strict=True)]
        assert len(states) == len(set(states))


def phrases_by_hand(rows, min_count):
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, 5):
                for p in range(len(w) - m + 1):
                    f[lang or "und"][tuple(w[p : p + m])] += 1
    out = {}
    for lang, own in f.items():
        candidates = {g: a for g, a in own.items() if len(g) > 1 and a >= min_count}
        kept = []
        for g, a in candidates.items():
            cuts = [(2_000_000 * a // (own[g[:k]] + own[g[k:]]), k, own[g[:k]], own[g[k:]]) for k in range(1, len(g))]
            score, _, l, r = min(cuts)
            inside = any(100 * b >= 80 * a and len(h) > len(g) and any(h[p : p + len(g)] == g for p in range(len(h) - len(g) + 1))
                         for h, b in candidates.items())
            if not inside:
                kept.append((-score, -a, " ".join(g).encode(), l, r))
        n = sum(a for g, a in own.items() if len(g) == 1)
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept), 1):
            out[(lang, rank)] = (phrase.decode(), -a, l, r, n, -score)
    return out


def rows_of_collocations(df):
    return {(r["lang"], r["rank"]): tuple(r[c] for c in ("phrase", "a", "l", "r", "n", "score")) for r in df.collect()}


@pytest.fixture
def running_text():
    draw = random.Random(4)
    words = ["the", "The", "a", "é", "漢字", "x\x01y", "of", " ", "in"] + [f"w{k}" for k in range(12)]
    rows = []
    for k in range(60):
        w = draw.choices(words, [40, 10, 9, 8, 7, 6, 5, 4, 3] + [2] * 12, k=draw.choice([0, 1, 3, 80, 400]))
        rows.append((draw.choice(["en", "en", "de", None]), "".join(x + draw.choice([" ", " ", " ", "  ", "\t", ". ", "\n"]) for x in w)))
    return rows + [("en", None), (None, None), ("fr", ""), ("fr", " .\n"), ("en", "the " * 9000 + "end"), ("en", "x" * 300_000)]


@pytest.mark.parametrize("sizes", [(37, 400, 7), (5000, 20_000, 100), (collocations.SHARD_WORDS, collocations.RANGE_BYTES, collocations.PART_ROWS)])
def test_collocations_equal_brute_force(spark, running_text, sizes, many_shards):
    shard_words, range_bytes, part_rows = sizes
    df = spark.createDataFrame([(1, *r) for r in running_text], "doc_id long, lang string, text string").withColumns(
        {"f": F.lit(1), "size": F.lit(2), "range": F.lit(3), "phrase": F.lit("p")}).repartition(3)
    prepare_tasks(spark)
    got = collocations.collocations(df, 3, 10_000, shard_words=shard_words, range_bytes=range_bytes, part_rows=part_rows)
    assert rows_of_collocations(got) == phrases_by_hand(running_text, 3)


def test_borders_split_even_one_frequent_word(spark, running_text):
    prepare_tasks(spark)
    texts = spark.createDataFrame(running_text, "lang string, text string").where("length(text) > 0")
    cuts = collocations.borders(texts, 400, 16)
    assert sum(b[:1] == (b"the",) for b in cuts["en"]) > 3 and all(list(b) == sorted(set(b)) for b in cuts.values())


def test_collocations_of_awkward_rows(awkward, awkward_rows, nothing):
    assert rows_of_collocations(collocations.collocations(awkward, 2, 50_000)) == phrases_by_hand([(r[2], r[1]) for r in awkward_rows], 2)
    assert collocations.collocations(nothing).count() == 0


# Quality rules.


def base_by_hand(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    three = Counter(tuple(w[p : p + 3]) for p in range(len(w) - 2))
    hit = {p + k for p in range(len(w) - 2) if three[tuple(w[p : p + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab# \n\t\x0b\x1c é|", max_size=120))
def test_counts_of_a_text(text):
    assert quality_rules._counts_of(text)[:5] == base_by_hand(text)


def test_binomial_tail_is_exact():
    for n, p in ((1, 0.5), (30, 0.1), (200, 0.03)):
        for k in (0, 1, n // 10, n // 2, n):
            exact = sum(math.comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1))
            assert quality_rules.binomial_tail(k, n, p) == pytest.approx(float(exact), rel=1e-9)


def test_no_rung_is_certified_beyond_the_bound():
    # 0 of 97 is likelier than 0.05 at 3 per cent, 0 of 99 is not; the second rung rejects too many good texts.
    assert quality_rules.best_rung([0, 0, 97], [5, 0, 0], 0.03, 0.05) == -1
    assert quality_rules.best_rung([0, 0, 99], [5, 0, 0], 0.03, 0.05) == 0
    assert quality_rules.best_rung([0, 9, 190], [5, 5, 0], 0.03, 0.05) == 0
    assert quality_rules.best_rung([0, 0, 199], [5, 5, 0], 0.03, 0.05) == 1
    assert quality_rules.best_rung([0, 0, 0], [5, 5, 0], 0.03, 0.05) == -1


def test_false_rejection_stays_below_the_bound():
    """True rates at the bound: rungs above it are taken in at most 5 per cent of the draws, but for chance."""
    draw, wrong = np.random.default_rng(1), 0
    for _ in range(2000):
        good = draw.multinomial(400, [0.01, 0.021, 0.969])  # the second rung's true rate is 3.1 per cent
        wrong += quality_rules.best_rung(good.tolist(), [5, 50, 0], 0.03, 0.05) == 1
    assert wrong / 2000 < 0.07


def test_rules_on_labelled_texts(spark, awkward, awkward_rows, nothing, many_shards):
    prepare_tasks(spark)
    draw = random.Random(2)
    rows, labels = [], []
    for k in range(1400):
        words = [f"w{draw.randint(0, 10**6)}" + "x" * draw.randint(0, 5) for _ in range(60)]
        bad = k % 7 == 0
        text = " ".join(w + "&&" if bad else w for w in words) + (" | " if k % 11 == 0 else "")
        rows.append((k, text, "en" if k % 20 else "xx"))
        labels += [(k, int(not bad))] if k % 2 else []
    rows += [(5000 + k, rows[7][1], "en") for k in range(300)]  # copies of a bad text, labelled good: one text
    labels += [(5000 + k, 1) for k in range(300)] + [(None, 1), (3, None), (10**9, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {"good": F.lit(1), "rung": F.lit(2), "stratum": F.lit(3), "shares": F.lit(4), "chosen": F.lit(5)}).repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs, known).collect()}
    text = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows)
    for k, r in got.items():
        assert tuple(r[c] for c in quality_rules.COUNTS[:5]) == base_by_hand(text[k])
    assert all(not r["kept"] for k, r in got.items() if k % 7 == 0 and k < 1400 and k % 20)
    clean = [r["kept"] for k, r in got.items() if k % 7 and k < 1400]
    assert sum(clean) > 0.97 * len(clean)
    assert {r["chosen"] for k, r in got.items() if k % 20 == 0 and k < 1400} == {-1}  # too few labels
    odd = quality_rules.judge(awkward, spark.createDataFrame([(5, 1), (1, 0)], "doc_id long, quality int")).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_repeat_words"]) for r in odd) == Counter(
        (r[0], base_by_hand(r[1])[0], base_by_hand(r[1])[4]) for r in awkward_rows)
    assert all(r["kept"] != r["base_failed"] for r in odd)
    assert quality_rules.judge(nothing, known).count() == 0
    assert quality_rules.judge(awkward, known.limit(0)).count() == len(awkward_rows)
