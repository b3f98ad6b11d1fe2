"""Spelling variants of words, found by a dictionary of trie-node pairs.

The words are put into a trie, and read backwards into a second one; nodes have numbers. A word that leaves out
its character at place i is the pair (node of the characters before i, node of those after i, read backwards), a
whole word is the pairs of all its cuts. So words that differ by

- one replaced character meet in the pair of their left-out places, of which at most as many words as there are
  characters can meet;
- one inserted character meet where the left-out pair of the longer is a cut of the shorter, of which there is one
  a pair. Where equal characters follow each other, only the last of them is left out, so they meet once.

Joining on the two integers gives exact neighbours without comparing letters. No pair of words becomes a row: every
word of a group gets the number of its partners there and the most frequent one, and the groups of a word
are added up.

Trie numbers: words are laid out in sorted ranges, each range is numbered by one pass over its words (a node is new
where a word leaves the one before it), and nodes that reach over a range's border get the number of the border.

A null or empty text has no words. Rows of equal id or text count each for itself; a null id counts as an
empty one in the hash that deletes characters. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerofuse.session import materialize, materialize_counted

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5  # a form occurs at least this many times as often as its variant
SHARD_WORDS = 100_000  # words numbered by one task at a time
RUN = "[a-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROUNDS = 64  # chains of forms grow n by RATIO each step, so far fewer are needed

WHOLE, LEFT_OUT, LEFT_OUT_AGAIN = 0, 1, 2


def planted_deletions(word: Column, doc_id: Column, every: int = 199) -> Column:
    """``word``, without one character where the crc32 of ``<doc_id>:<word>`` is a multiple of ``every``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % every == 0, shorter).otherwise(word)


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """word, n: the words of all texts with one character left out now and then (see ``planted_deletions``)."""
    runs = F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(RUN), F.lit(0))
    found = docs.select(F.col(id_col).alias("doc_id"), F.explode(runs).alias("run")).where(F.length("run") >= min_length)
    words = found.select(planted_deletions(F.col("run"), F.col("doc_id")).alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _common(a: str, b: str) -> int:
    return len(commonprefix([a, b]))


def border_numbers(ends: list[tuple[int, str, str]]) -> dict[int, tuple[str, list, str, list]]:
    """For each range (number, first word, last word), in order: what it shares with its neighbours.

    That is the common prefix with the range before, the numbers of its nodes, and the same for the range after. A
    node that reaches over several borders has the number of the first.
    """
    out: dict = {shard: ("", [], "", []) for shard, _, _ in ends}
    shared: list = []
    through = 0  # nodes of the last border that also reach over the next
    for (before, first, last), (after, start, _) in zip(ends, ends[1:]):
        through = min(len(shared), _common(first, last))
        n = _common(last, start)
        shared = [shared[i] if i < through else -(after << 32 | (i + 1)) for i in range(n)]
        out[before] = (*out[before][:2], start[:n], shared)
        out[after] = (start[:n], shared, "", [])
    return out


def trie_nodes(words: DataFrame, rows: int, key: str = "key", shard_words: int = SHARD_WORDS) -> DataFrame:
    """``key`` (distinct), id (in the order of keys) and nodes: the trie node of every prefix, from the empty one on."""
    shards = max(1, -(-rows // shard_words))
    laid = materialize(words.select(key).repartitionByRange(shards, key).withColumn("shard", F.spark_partition_id()), "trie")
    ends = laid.groupBy("shard").agg(F.min(key).alias("low"), F.max(key).alias("high")).orderBy("shard").collect()
    borders = border_numbers([tuple(r) for r in ends])  # as long as there are ranges, not words

    def number(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        before, path, after, beyond = borders[shard]
        keys = sorted(table.column(key).to_pylist())  # code points, the order of Spark's strings
        path, last, fresh, nodes, offsets = [0, *path], before, shard << 40, [], [0]
        for word in keys:
            same = _common(last, word)
            path = path[: same + 1]
            if same < len(word):
                known = _common(word, after)
                path += beyond[same:known]
                made = len(word) + 1 - len(path)
                path += range(fresh + 1, fresh + made + 1)
                fresh += made
            nodes.append(np.array(path, np.int64))
            offsets.append(offsets[-1] + len(path))
            last = word
        flat = pa.array(np.concatenate(nodes))
        ids = pa.array((shard << 40) + np.arange(len(keys), dtype=np.int64))
        return pa.table({key: pa.array(keys, pa.string()), "id": ids,
                         "nodes": pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), flat).cast(pa.list_(pa.int64()))})

    return laid.groupBy("shard").applyInArrow(number, f"{key} string, id long, nodes array<bigint>")


def _pairs(words: DataFrame) -> DataFrame:
    """prefix, suffix, id, n, kind: the node pairs of every word (word, id, n, nodes, back)."""
    letters = words.withColumn("letters", F.split("word", "")).withColumn("size", F.length("word"))
    pair = "named_struct('prefix', nodes[i], 'suffix', back[{rest}], 'kind', {kind})"
    left_out = pair.format(
        rest="size - 1 - i", kind=f"IF(i = size - 1 OR letters[i + 1] <> letters[i], {LEFT_OUT}, {LEFT_OUT_AGAIN})")
    whole = pair.format(rest="size - i", kind=str(WHOLE))
    both = F.concat(F.expr(f"transform(sequence(0, size - 1), i -> {left_out})"), F.expr(f"transform(sequence(0, size), i -> {whole})"))
    return letters.select("id", "n", F.explode(both).alias("x")).select("x.prefix", "x.suffix", "x.kind", "id", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """id, n_near, best (n, id): of every word with neighbours their number and the most frequent (ties: least id)."""
    met = _pairs(words).groupBy("prefix", "suffix").agg(
        F.collect_list(F.struct("id", "n", "kind")).alias("met")).where(F.size("met") > 1)
    partner = (f"(m.kind <> {WHOLE} AND x.kind <> {WHOLE} AND m.id <> x.id) OR (m.kind = {WHOLE} AND x.kind = {LEFT_OUT})"
               f" OR (m.kind = {LEFT_OUT} AND x.kind = {WHOLE})")
    seen = met.select("met", F.explode("met").alias("m")).select(
        "m.id", F.expr(f"transform(filter(met, x -> {partner}), x -> struct(x.n AS n, -x.id AS id))").alias("near"))
    some = seen.where(F.size("near") > 0).select("id", F.size("near").cast("long").alias("k"), F.array_max("near").alias("best"))
    return some.groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best")).select(
        "id", "n_near", F.struct(F.col("best.n").alias("n"), (-F.col("best.id")).alias("id")).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """id, root: the end of each chain of (id, form), by pointer doubling."""
    links = materialize(forms.select("id", F.col("form").alias("root")), "forms-0")
    for k in range(1, _ROUNDS):
        above = links.select(F.col("id").alias("root"), F.col("root").alias("higher"))
        met = links.join(above, "root", "left")
        if met.where("higher IS NOT NULL").isEmpty():
            break
        links = materialize(met.select("id", F.coalesce("higher", "root").alias("root")), f"forms-{k}")
    return links


def variants(counts: DataFrame, ratio: int = RATIO, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``counts`` (distinct word, n).

    Two words are near if one inserted, deleted or replaced code point makes them equal. The form is the near word of
    largest n (ties: least in code-point order) if that is at least ``ratio`` times the word's own n, else null;
    the root is where the chain of forms ends, the word itself if it has none.
    """
    counts, rows = materialize_counted(counts, "words")
    forward = trie_nodes(counts.select(F.col("word").alias("key")), rows, shard_words=shard_words)
    backward = trie_nodes(counts.select(F.reverse("word").alias("key")), rows, shard_words=shard_words)
    numbered = materialize(
        counts.join(forward.withColumnRenamed("key", "word"), "word").join(
            backward.select(F.reverse("key").alias("word"), F.col("nodes").alias("back")), "word"), "trie-words")
    near = materialize(neighbours(numbered), "neighbours")
    names = numbered.select("id", "word", "n")
    own = names.join(near, "id", "left").withColumn("formed", F.coalesce(F.col("best.n") >= ratio * F.col("n"), F.lit(False)))
    own = own.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                     F.when(F.col("formed"), F.col("best.id")).alias("form_id"), F.when(F.col("formed"), F.col("best.n")).alias("form_n"))
    own = materialize(own, "variants")
    roots = _roots(own.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    named = own.join(roots, "id", "left")
    form = names.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    root = names.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    return named.join(form, "form_id", "left").join(root, "root", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Variants of the words of all texts, see ``word_counts`` and ``variants``."""
    return variants(word_counts(docs, min_length, min_count, id_col, text_col), ratio)
