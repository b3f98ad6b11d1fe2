"""Quality rules whose cutoffs are chosen under a bound on the good documents they reject.

A document that fails the base rules (fewer than 50 words, or more than half of its words in repeated three-word
windows) is never kept. The others are judged by six shares, each a whole number per mille: symbols, punctuation marks,
capitals and digits of the characters in words, repeated lines of the lines with words, and words in repeated windows.

Per stratum (the language; null: ``und``) the labelled texts that pass the base rules are halved by the md5 of the text,
copies counted once:

1. The first half gives a ladder of rules. Rung t rejects what exceeds, in any share, the value that at most
   LADDER[t] per mille of its good texts exceed; each rung rejects at least what the one before does.
2. The second half, which had no say in the ladder, tests the rungs in order: a rung is certified if k or fewer
   rejections among its n good texts are less likely than the error level when the true rate is ALPHA, by the exact
   binomial tail (the upper Clopper-Pearson bound is then below ALPHA). The first rung that fails ends the test, so
   the rungs of one stratum need no correction; the error level is DELTA divided by the number of strata tested.
3. Of the certified rungs the one counts whose share of rejected bad texts exceeds that of good ones most (ties: the
   mildest). So, with probability 1 - DELTA, in no stratum more than ALPHA of the good documents are rejected.

A stratum with too few labels certifies nothing and rejects by the base rules only. A null or empty text has no words and
fails the base rules. Rows of equal id are judged alone; a label counts for each text of its id, a label without id or quality
for none, and a text that is labelled both ways counts in both. Without labels, or with empty tables, nothing is certified.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerofuse.session import broadcast_if_small, materialize, materialize_counted

ALPHA = 0.03  # share of the good documents of a stratum that may be rejected
DELTA = 0.05  # probability that any stratum exceeds it
LADDER = (0, 1, 2, 5, 10, 20, 50)  # per mille
NO_STRATUM = "und"
MIN_WORDS, MAX_REPEATED = 50, 50  # words, and per cent of words in repeated windows
_SYMBOLS = b"#*$%&|<>"
_MARKS = b".,;:!?"
_CAPITALS, _DIGITS = bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A))
_BLANKS = b" \t\n\x0b\x0c\r"
WINDOW = 3

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_capitals", "n_digits"]
SHARES = {  # per mille: part, whole
    "symbols": ("n_symbols", "word_chars"), "marks": ("n_marks", "word_chars"), "capitals": ("n_capitals", "word_chars"),
    "digits": ("n_digits", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeat_words": ("n_repeat_words", "n_words"),
}


class _Numbers(dict):
    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def repeated_words(words: list) -> int:
    """How many words lie in a window of three words that occurs twice or more."""
    if len(words) <= WINDOW:
        return 0
    numbers = _Numbers()
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    _, window, count = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    hit = np.zeros(len(words), bool)
    for k in range(WINDOW):
        hit[k : k + len(again)] |= again
    return int(hit.sum())


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def _counts_of(text: str | None) -> tuple:
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode()
    words = data.split()  # of bytes, at ASCII blanks only
    n_lines, n_dup = _lines(text)

    def among(some: bytes) -> int:
        return len(data) - len(data.translate(None, some))

    return (len(words), len(text) - among(_BLANKS), among(_SYMBOLS), n_dup, repeated_words(words), n_lines, among(_MARKS),
            among(_CAPITALS), among(_DIGITS))


def counts(text: Column | str) -> Column:
    """struct of COUNTS of each whole text."""

    def count(texts: pa.Array) -> pa.Array:
        table = np.array([_counts_of(t.as_py()) for t in texts], np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(table[:, k]) for k in range(len(COUNTS))], COUNTS)

    return F.arrow_udf(count, f"struct<{','.join(f'{c}:long' for c in COUNTS)}>")(text)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum, digest, the counts, base_failed and the shares, one row per row of ``docs``; written once."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit(NO_STRATUM)).alias("stratum"),
        F.md5(F.col(text_col)).alias("digest"), counts(F.col(text_col)).alias("c"))
    flat = rows.select("doc_id", "stratum", "digest", "c.*").withColumn("base_failed", base_failed())
    shares = F.array(*(F.expr(f"1000 * {part} DIV greatest({whole}, 1)").cast("int") for part, whole in SHARES.values()))
    return materialize(flat.withColumn("shares", shares), "measured")


def labelled(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality") -> DataFrame:
    """stratum, good, tested, shares: one row per labelled text that passes the base rules."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(quality_col) > 0).alias("good")).where("good IS NOT NULL").distinct()
    half = F.substring("digest", 1, 1) >= "8"
    return rows.where(~F.col("base_failed")).join(known, "doc_id").select(
        "stratum", "good", half.alias("tested"), "digest", "shares").dropDuplicates(["stratum", "good", "digest"]).drop("digest")


def ladder(texts: DataFrame, rungs: tuple = LADDER) -> DataFrame:
    """stratum, cutoffs: for each share the largest value that every rung allows, from the texts not kept for the test."""
    good = texts.where(F.col("good") & ~F.col("tested")).select("stratum", F.posexplode("shares").alias("rule", "value"))
    histogram = good.groupBy("stratum", "rule", "value").agg(F.count(F.lit(1)).alias("n"))  # at most 1,001 values a rule
    rule = Window.partitionBy("stratum", "rule")
    above = histogram.withColumn("above", F.sum("n").over(rule.orderBy(F.desc("value"))) - F.col("n")).withColumn(
        "all", F.sum("n").over(rule))
    limits = [F.min(F.when(F.col("above") * 1000 <= rung * F.col("all"), F.col("value"))) for rung in rungs]
    each = above.groupBy("stratum", "rule").agg(F.array(*limits).alias("limits"))
    return each.groupBy("stratum").agg(F.array_sort(F.collect_list(F.struct("rule", "limits"))).alias("x")).select(
        "stratum", F.col("x.limits").alias("cutoffs"))


def rung_of(shares: str = "shares", cutoffs: str = "cutoffs", rungs: int = len(LADDER)) -> Column:
    """The first rung that rejects; ``rungs`` if none does."""
    first = F.expr(
        f"array_min(transform(sequence(0, {rungs - 1}), t -> "
        f"IF(exists(transform({shares}, (v, r) -> v > {cutoffs}[r][t]), x -> x), t, {rungs})))")
    return F.coalesce(first, F.lit(rungs)).cast("int")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X of n trials with probability p."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def best_rung(good: list[int], bad: list[int], alpha: float, level: float) -> int:
    """The rung to use, from the good and bad texts that each rung rejects first (last: none does); -1 for none."""
    n, m = sum(good), sum(bad)
    best, chosen, k, caught = 0.0, -1, 0, 0
    for t in range(len(good) - 1):
        k, caught = k + good[t], caught + bad[t]
        if not n or binomial_tail(k, n, alpha) > level:
            break
        gain = (caught / m if m else 0.0) - k / n
        if gain > best + 1e-12:
            best, chosen = gain, t
    return chosen


def certified(texts: DataFrame, cutoffs: DataFrame, alpha: float = ALPHA, delta: float = DELTA, rungs: int = len(LADDER)) -> DataFrame:
    """stratum, cutoffs, chosen: the rung of each stratum that the held-out texts certify; -1 for none."""
    cutoffs, strata = materialize_counted(cutoffs, "cutoffs")
    cutoffs = broadcast_if_small(cutoffs, strata)
    held = texts.where("tested").join(cutoffs, "stratum").select("stratum", "good", rung_of(rungs=rungs).alias("rung"))
    numbers = held.groupBy("stratum", "good", "rung").agg(F.count(F.lit(1)).alias("n"))
    tested = numbers.where("good").select("stratum").distinct().count()
    level = delta / max(tested, 1)

    def choose(table: pa.Table) -> pa.Table:
        found = {True: [0] * (rungs + 1), False: [0] * (rungs + 1)}
        for row in table.to_pylist():
            found[row["good"]][row["rung"]] += row["n"]
        return pa.table({"stratum": table.column("stratum").slice(0, 1),
                         "chosen": pa.array([best_rung(found[True], found[False], alpha, level)], pa.int32())})

    rung = numbers.groupBy("stratum").applyInArrow(choose, "stratum string, chosen int")  # two numbers a rung
    return materialize(cutoffs.join(rung, "stratum", "left").select(
        "stratum", "cutoffs", F.coalesce("chosen", F.lit(-1)).alias("chosen")), "certified")


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id",
          text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, counts, base_failed, kept, rung (the first that rejects) and chosen."""
    rows = measured(docs, id_col, text_col, stratum_col)
    texts = materialize(labelled(rows, labels, id_col), "labelled")
    rules = certified(texts, ladder(texts), alpha, delta)
    met = rows.join(rules, "stratum", "left").withColumn("rung", rung_of())
    rejected = F.coalesce(F.col("rung") <= F.col("chosen"), F.lit(False))
    return met.select("doc_id", *COUNTS[:5], "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"), "rung",
                      F.coalesce("chosen", F.lit(-1)).alias("chosen"))
