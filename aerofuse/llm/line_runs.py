"""Repeated runs of lines, found by prefix doubling over the lines of all documents; later copies are deleted.

A run counts if it holds at least MIN_WORDS words. A line goes if it lies in an occurrence of such a run that
is not the first one (in order of document id, a hash of the text, line number). Built from DataFrame functions only:

1. Lines that occur once end every repeated run, so only the others take part. They get ranks in the order
   of their hashes (128 bits).
2. Prefix doubling: with ranks of the first h lines of every suffix, the pairs (rank here, rank h lines on)
   order the suffixes by 2h lines. Pairs that occur once are suffixes without a partner and drop out; the
   others get new ranks by a range sort of the distinct pairs. Suffixes never reach into the next document.
3. A longest-common-prefix interval of depth n holds the suffixes with equal first n lines, which two overlapping
   ranks of 2^k <= n lines tell. For every line the shortest stretch of MIN_WORDS words that begins or
   ends there is looked up; the first occurrence of its interval stays, and the stretches of the others,
   joined where they overlap, are the maximal repeated runs to delete.

A null text has no lines. An empty text has one empty line, which holds no words. Rows of equal id and text count
as one document, so none of them goes for the other's sake. Documents without repeats are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerofuse.llm.names import fresh
from aerofuse.session import materialize, materialize_counted

MIN_WORDS = 50
DOC = ["doc_id", "h"]


def _text_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def _ranked(keys: DataFrame, columns: list[str], label: str) -> DataFrame:
    """The keys that occur more than once, with ranks in their order."""
    repeated = keys.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ordered = repeated.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return materialize(ordered.select(*columns, F.monotonically_increasing_id().alias("rank")), label)


def _repeated_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, h, i, words, rank of every line that occurs more than once."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _text_hash(id_col, text_col).alias("h"),
        F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("i", "line"))
    lines = materialize(rows.select(
        *DOC, "i", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), F.col("line")).alias("b"),
        F.regexp_count("line", F.lit(r"\S+")).cast("long").alias("words")), "lines")
    ranks = _ranked(lines, ["a", "b"], "line-ranks")
    joined = lines.join(ranks, ["a", "b"]).select(*DOC, "i", "words", "rank")
    return joined.repartition(*DOC).dropDuplicates([*DOC, "i"])


def _stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """doc_id, h, s, n: shortest stretches of ``min_words`` words that begin or end at each line."""
    by_doc = Window.partitionBy(*DOC).orderBy("i")
    run = [*DOC, "run"]
    within = Window.partitionBy(*run)
    upto = within.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    total = lines.withColumn("run", F.col("i") - F.row_number().over(by_doc)).withColumn("upto", F.sum("words").over(upto))
    total = total.withColumn("before", F.col("upto") - F.col("words")).withColumn("back", -F.col("before"))
    # Frames end a fixed number of words away from the current row and begin at the edge, so they only grow.
    far = within.orderBy("back").rangeBetween(Window.unboundedPreceding, -min_words)
    near = within.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words)
    edges = total.withColumn("next", F.min("i").over(far)).withColumn("previous", F.max("i").over(near))
    edges = edges.withColumn("all", F.sum("words").over(within)).withColumn("lo", F.min("i").over(within)).withColumn(
        "hi", F.max("i").over(within))
    end = F.coalesce(F.col("next") - 1, F.when(F.col("all") - F.col("before") >= min_words, F.col("hi")))
    begin = F.coalesce(F.col("previous") + 1, F.when(F.col("upto") >= min_words, F.col("lo")))
    both = F.array(F.struct(F.col("i").alias("s"), (end - F.col("i") + 1).alias("n")),
                   F.struct(begin.alias("s"), (F.col("i") - begin + 1).alias("n")))
    found = edges.select(*DOC, F.explode(both).alias("x")).select(*DOC, "x.s", "x.n").where("s IS NOT NULL AND n IS NOT NULL")
    return found.dropDuplicates([*DOC, "s", "n"])


def _doubled(suffixes: DataFrame, h: int, label: str) -> tuple[DataFrame, int]:
    """Ranks by 2h lines of the suffixes that are still shared."""
    on = Window.partitionBy(*DOC).orderBy("i").rangeBetween(h, h)
    pairs = suffixes.select(*DOC, "i", F.col("rank").alias("a"), F.max("rank").over(on).alias("b")).where("b IS NOT NULL")
    ranks = _ranked(pairs, ["a", "b"], f"{label}-ranks")
    return materialize_counted(pairs.join(ranks, ["a", "b"]).select(*DOC, "i", "rank"), label)


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h, s, e: the maximal runs of lines (s up to but not including e) that are later copies."""
    lines = materialize(_repeated_lines(docs, id_col, text_col), "repeated-lines")
    stretches, n = materialize_counted(_stretches(lines, min_words), "stretches")
    longest = stretches.agg(F.max("n")).first()[0] or 0
    suffixes, h, occurrences = lines.select(*DOC, "i", "rank"), 1, None
    while n and h <= longest:
        here = stretches.where((F.col("n") >= h) & (F.col("n") < 2 * h))
        head = suffixes.select(*DOC, F.col("i").alias("s"), F.col("rank").alias("a"))
        tail = suffixes.select(*DOC, F.col("i").alias("t"), F.col("rank").alias("b"))
        found = _at(_at(here, head, "s").withColumn("t", F.col("s") + F.col("n") - h), tail, "t").select(*DOC, "s", "n", "a", "b")
        occurrences = found if occurrences is None else occurrences.union(found)
        if 2 * h <= longest:
            suffixes, left = _doubled(suffixes, h, f"suffixes-{2 * h}")
            if not left:
                break
        h *= 2
    if occurrences is None:
        return lines.select(*DOC, F.col("i").alias("s"), F.col("i").alias("e")).limit(0)
    occurrences = materialize(occurrences.withColumn("place", F.struct(*DOC, "s")), "occurrences")
    interval = ["n", "a", "b"]
    firsts = occurrences.groupBy(*interval).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    later = occurrences.join(firsts.drop("copies"), interval).where(~F.col("place").eqNullSafe(F.col("first")))
    spans = later.select(*DOC, "s", (F.col("s") + F.col("n")).alias("e")).groupBy(*DOC, "s").agg(F.max("e").alias("e"))
    ordered = Window.partitionBy(*DOC).orderBy("s")
    reach = F.max("e").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("fresh", F.coalesce(F.col("s") > reach, F.lit(True)).cast("int"))
    numbered = marked.withColumn("k", F.sum("fresh").over(ordered))
    return numbered.groupBy(*DOC, "k").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("k")


def _at(rows: DataFrame, suffixes: DataFrame, place: str) -> DataFrame:
    """Join on the document and a line number; ids may be null."""
    other = suffixes.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), F.col(place).alias("_p"), *(
        c for c in suffixes.columns if c not in (*DOC, place)))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")) & (F.col(place) == F.col("_p"))
    return rows.join(other, same).drop("_d", "_h", "_p")


def without_copies(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                   into: str = "lines_deleted") -> DataFrame:
    """``docs`` with later copies of repeated runs cut out of the text, and one more column: lines deleted.

    A document that loses every line has an empty text.
    """
    doc, h, found, key = fresh(["_doc", "_h", "_runs", "_key"], docs)
    runs = later_copies(docs, min_words, id_col, text_col)
    packed = runs.groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias(found)).select(
        F.col("doc_id").alias(doc), F.col("h").alias(h), found)
    keyed = docs.withColumn(key, _text_hash(id_col, text_col))
    joined = keyed.join(
        packed.hint("merge"), F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(h)), "left")
    kept = F.filter(F.split(F.col(text_col), "\n", -1), lambda x, i: ~F.exists(found, lambda r: (i >= r.s) & (i < r.e)))
    deleted = F.aggregate(found, F.lit(0), lambda n, r: n + r.e - r.s)
    text = F.when(F.col(found).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return joined.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns),
                         F.coalesce(deleted, F.lit(0)).alias(into))
