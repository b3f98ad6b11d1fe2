"""Collocations of every language: phrases of two to four words that occur together more often than their parts.

Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line ends, pieces into words at blanks and
tabs. Phrases are counted with weighted acyclic automata:

1. A task turns SHARD_WORDS words of running text into the sequences of up to four words that begin at each of
   them (shorter at the end of a piece), sorts them and builds their automaton. A phrase's count is the weight of all
   sequences that begin with it, so one sequence a word holds the counts of all four lengths.
2. The automata are cut at the same borders everywhere, so each prefix range of a language is a group of its
   own: its automata are united, weights summed, and phrases with enough occurrences read off. A phrase that reaches over
   a border has a part of its count in each of the ranges, whatever that is, and the parts are added.
3. The frequent phrases are laid out in sorted ranges, one automaton each. A candidate's parts (each cut into a first
   part and a rest) are sent to the range that they fall into and composed with its automaton; a range that is asked
   for more often is repeated, and the questions are dealt among its copies.

A border is a sequence, so not even a very frequent word or phrase is one task's work: its continuations are
spread over ranges, and equal sequences are one row a shard. Borders come from a sample of the texts, which decides how
the work is spread and nothing else.

A null or empty text has no words, a null language is ``und``. Rows of equal id or text each count for themselves. Other
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerofuse.llm.automata import DEPTH, Automaton, prefix_weights, summed, united
from aerofuse.session import materialize, materialize_counted

MIN_COUNT = 30
TOP = 2000
NO_LANGUAGE = "und"
SCALE = 2_000_000  # a score is this times a / (l + r), rounded down
COVERED = 80  # per cent of a phrase's occurrences that lie in a longer one, for it to go
SHARD_WORDS = 1_000_000  # words of running text in one automaton
RANGE_BYTES = 8 << 20  # text whose sequences fall into one prefix range
RANGE_KEYS = 16  # sampled sequences a range, from which the borders are taken
PART_ROWS = 400_000  # frequent phrases, and questions, of one composition
_DEALT = 16
_CHUNK = 1 << 17  # bytes of text taken apart at a time

_PLAIN = bytearray(range(256))
_PLAIN[0x41:0x5B] = bytes(range(0x61, 0x7B))
_PLAIN[0x09] = 0x20
for _byte in b".,;:!?\n\x0b\x0c\r":
    _PLAIN[_byte] = 0x0A
_PLAIN = bytes(_PLAIN)


def _chunks(data: bytes) -> Iterator[bytes]:
    """``data`` cut at blanks and piece ends into parts of about _CHUNK bytes; words stay whole."""
    lo = 0
    while len(data) - lo > _CHUNK:
        cut = max(data.rfind(b" ", lo, lo + _CHUNK), data.rfind(b"\n", lo, lo + _CHUNK))
        if cut <= lo:
            later = [p for p in (data.find(b" ", lo + _CHUNK), data.find(b"\n", lo + _CHUNK)) if p >= 0]
            cut = min(later, default=len(data))
        yield data[lo:cut]
        lo = cut
    yield data[lo:]


class _Numbers(dict):
    """Words numbered from 1 in the order they come; 0 ends a piece, -1 is nothing."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0, b"": -1})

    def __missing__(self, word):
        number = self[word] = len(self) - 1
        return number


class Shard:
    """Running text of some languages, as word numbers."""

    def __init__(self) -> None:
        self.numbers = _Numbers()
        self.parts: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, words: list[bytes]) -> None:
        found = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        found = found[found >= 0]
        self.parts.setdefault(lang, []).append(found)
        self.size += len(found)

    def words(self) -> tuple[list[bytes], np.ndarray]:
        """The sorted words, and the place, from 1, of each number among them."""
        named = [(w, n) for w, n in self.numbers.items() if n > 0]
        named.sort()
        place = np.zeros(len(named) + 1, np.int64)
        place[np.array([n for _, n in named], np.int64)] = np.arange(1, len(named) + 1)
        return [w for w, _ in named], place

    def sequences(self, lang: str, place: np.ndarray, skipped: int = 0) -> np.ndarray:
        """The sequences that begin at each word, but for the last ``skipped`` entries."""
        ids = place[np.concatenate(self.parts[lang])]
        n = len(ids)
        ids = np.concatenate([ids, np.zeros(DEPTH, ids.dtype)])
        out = np.stack([ids[k : k + n] for k in range(DEPTH)], axis=1)
        for k in range(1, DEPTH):
            out[out[:, k - 1] == 0, k] = 0
        out = out[: n - skipped]
        return out[out[:, 0] > 0]


def shards(rows: Iterator[tuple[str, str | None]], shard_words: int) -> Iterator[tuple[Shard, str | None]]:
    """Shards of (language, text) rows, each with the language whose last words go on in the next one, if any."""
    shard = Shard()
    for lang, text in rows:
        if not text:
            continue
        for chunk in _chunks(text.encode().translate(_PLAIN)):
            shard.add(lang, chunk.replace(b"\n", b" \n ").split(b" "))
            if shard.size >= shard_words:
                # Sequences of the last words need those of the next chunk.
                tail = np.concatenate(shard.parts[lang])[-(DEPTH - 1) :]
                names = {n: w for w, n in shard.numbers.items()}
                yield shard, lang
                shard = Shard()
                shard.add(lang, [names[n] for n in tail.tolist()])
        shard.add(lang, [b"\n"])
    if shard.size:
        yield shard, None


def _border_key(border: tuple[bytes, ...], words: list[bytes]) -> tuple[int, ...]:
    """The least sequence of numbers that does not stand before ``border``."""
    key: list = []
    for word in border:
        at = bisect_left(words, word)
        key.append(at + 1)
        if at == len(words) or words[at] != word:
            break
    return tuple(key + [0] * (DEPTH - len(key)))


def _cut(sequences: np.ndarray, borders: list[tuple[bytes, ...]], words: list[bytes]) -> np.ndarray:
    """Where each range begins among sorted sequences, with the ends."""
    at, lo = [0], 0
    rows = np.ascontiguousarray(sequences.astype(">u4")).view(f"V{4 * DEPTH}").reshape(-1)
    keys = [np.array(_border_key(b, words), ">u4").tobytes() for b in borders]
    for key in keys:
        hi = len(rows)
        while lo < hi:  # ranges are few, sequences many
            middle = (lo + hi) // 2
            if rows[middle].tobytes() < key:
                lo = middle + 1
            else:
                hi = middle
        at.append(lo)
    return np.array([*at, len(rows)])


def _slice(words: list[bytes], sequences: np.ndarray, weights: np.ndarray) -> Automaton:
    used = np.unique(sequences)
    used = used[used > 0]
    number = np.zeros(len(words) + 1, np.int64)
    number[used] = np.arange(1, len(used) + 1)
    return Automaton.of_sorted([words[k - 1] for k in used.tolist()], number[sequences], weights)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)


def borders(texts: DataFrame, range_bytes: int, range_keys: int) -> dict[str, list[tuple[bytes, ...]]]:
    """For each language the ascending sequences at which its prefix ranges begin, but for the first range."""
    size = texts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    ranges = -(-(size["bytes"] or 0) // range_bytes)
    if ranges < 2:
        return {}
    wanted = ranges * range_keys
    share = min(1.0, (2_000 + wanted / 8) / size["n"])
    step = max(1, int(size["bytes"] * share / 8 / wanted))  # a word for every eight bytes, at the least

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = step // 2
        for shard, _ in shards(_rows(batches), 100_000):
            words, place = shard.words()
            for lang in shard.parts:
                found = shard.sequences(lang, place)
                some = found[at % step :: step]
                at += len(found)
                keys = [b" ".join(words[k - 1] for k in row if k).decode() for row in some.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.string())], names=["lang", "key"])

    sample = texts.sample(share, seed=1) if share < 1 else texts
    drawn: dict = {}
    for row in sample.mapInArrow(draw, "lang string, key string").collect():  # about ``wanted`` short rows
        drawn.setdefault(row["lang"], []).append(tuple(row["key"].encode().split(b" ")))
    total = sum(map(len, drawn.values()))
    out = {}
    for lang, keys in drawn.items():
        keys.sort()
        n = -(-len(keys) * ranges // total)
        out[lang] = sorted({keys[len(keys) * k // n] for k in range(1, n)})
    return out


def shard_automata(texts: DataFrame, cuts: dict[str, list[tuple[bytes, ...]]], shard_words: int) -> DataFrame:
    """lang, range, automaton: one row per shard and prefix range that holds any of its sequences."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, open_ in shards(_rows(batches), shard_words):
            words, place = shard.words()
            for lang in shard.parts:
                found = shard.sequences(lang, place, DEPTH - 1 if lang == open_ else 0)
                found, weights = summed(found, np.ones(len(found), np.int64))
                at = _cut(found, cuts.get(lang, []), words)
                numbers = np.flatnonzero(np.diff(at)).tolist()
                data = [_slice(words, found[at[k] : at[k + 1]], weights[at[k] : at[k + 1]]).dump() for k in numbers]
                if data:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(data), pa.string()), pa.array(numbers, pa.int32()), pa.array(data, pa.binary())],
                        names=["lang", "range", "automaton"])

    return texts.mapInArrow(build, "lang string, range int, automaton binary")


class _Binaries(Sequence):
    """The values of a column, made one at a time."""

    def __init__(self, column: pa.ChunkedArray) -> None:
        self.column = column

    def __len__(self) -> int:
        return len(self.column)

    def __getitem__(self, k):
        if k >= len(self):
            raise IndexError(k)
        return self.column[k].as_py()


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, shard_words: int = SHARD_WORDS, range_bytes: int = RANGE_BYTES,
                  range_keys: int = RANGE_KEYS, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, size, phrase, f: phrases of one to four words with ``min_count`` occurrences; size 0 counts all words."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).alias("text"))
    texts = texts.where(F.length("text") > 0)
    cuts = borders(texts, range_bytes, range_keys)

    def unite(key: tuple, table: pa.Table) -> pa.Table:
        lang, number = key[0].as_py(), key[1].as_py()
        own = cuts.get(lang, [])
        edges = own[max(number - 1, 0) : number + 1] if own else []
        words, found, weights = united(_Binaries(table.column("automaton")))
        sizes, phrases, counts = [0], [""], [int(weights.sum())]
        for depth in range(1, DEPTH + 1):
            some, n = prefix_weights(found, weights, depth)
            # What begins a border has occurrences in other ranges, too.
            shared = {b[:depth] for b in edges}
            keep = n >= min_count
            for edge in shared:
                key = [bisect_left(words, w) + 1 for w in edge]
                if len(key) == depth and all(k <= len(words) and words[k - 1] == w for k, w in zip(key, edge, strict=True)):
                    keep |= (some == key).all(axis=1)
            for row, f in zip(some[keep].tolist(), n[keep].tolist(), strict=True):
                sizes.append(depth)
                phrases.append(b" ".join(words[k - 1] for k in row).decode())
                counts.append(f)
        return pa.table({"lang": pa.array([lang] * len(sizes), pa.string()), "size": pa.array(sizes, pa.int32()),
                         "phrase": pa.array(phrases, pa.string()), "f": pa.array(counts, pa.int64())})

    # As many partitions as there are ranges, since AQE does not cut one that several large ranges fall into.
    ranges = sum(len(own) + 1 for own in cuts.values())
    built = shard_automata(texts, cuts, shard_words)
    if ranges > 1:
        built = built.repartition(ranges, "lang", "range")
    parts = built.groupBy("lang", "range").applyInArrow(
        unite, "lang string, size int, phrase string, f long")
    total = parts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return total.where((F.col("size") == 0) | (F.col("f") >= min_count))


def _composed(counts: DataFrame, rows: int, questions: DataFrame, part_rows: int) -> DataFrame:
    """``questions`` (lang, phrase, part, k, half) with f, the count of ``part``; all parts are among ``counts``."""
    laid = materialize(
        counts.select("lang", "phrase", "f").repartitionByRange(max(1, -(-rows // part_rows)), "lang", "phrase").withColumn(
            "range", F.spark_partition_id()), "phrases")
    firsts = laid.groupBy("range").agg(F.min(F.struct("lang", "phrase")).alias("first")).orderBy("range").collect()
    begin = [((r["first"]["lang"] or "").encode(), r["first"]["phrase"].encode()) for r in firsts]  # one a range
    number = [r["range"] for r in firsts]

    def place(lang: pa.Array, part: pa.Array) -> pa.Array:
        pairs = zip(lang.to_pylist(), part.to_pylist(), strict=True)
        return pa.array([number[max(bisect_right(begin, (a.encode(), b.encode())) - 1, 0)] for a, b in pairs], pa.int32())

    sent = materialize(questions.withColumn("range", F.arrow_udf(place, "int")("lang", "part")), "questions")
    asked = sent.groupBy("range").agg(F.ceil(F.count(F.lit(1)) / F.lit(part_rows)).cast("int").alias("copies"))
    dealt = sent.join(F.broadcast(asked), "range").withColumn(
        "copy", F.pmod(F.xxhash64("lang", "phrase"), F.col("copies")).cast("int")).drop("copies")
    copied = laid.join(F.broadcast(asked), "range").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")

    def compose(known: pa.Table, wanted: pa.Table) -> pa.Table:
        langs = known.column("lang").to_pylist()
        phrases, f = known.column("phrase").to_pylist(), np.asarray(known.column("f"))
        asked_lang, asked_part = wanted.column("lang").to_pylist(), wanted.column("part").to_pylist()
        answer = np.zeros(wanted.num_rows, np.int64)
        for lang in set(asked_lang):
            rows = [k for k, x in enumerate(langs) if x == lang]
            words = sorted({w for k in rows for w in phrases[k].encode().split(b" ")})
            numbers = {w: k + 1 for k, w in enumerate(words)}
            automaton = Automaton.of_sorted(words, *summed(_numbered([phrases[k] for k in rows], numbers), f[rows]))
            some = [k for k, x in enumerate(asked_lang) if x == lang]
            answer[some] = automaton.compose(_numbered([asked_part[k] for k in some], numbers))
        return wanted.select(["lang", "phrase", "a", "k", "half"]).append_column("f", pa.array(answer))

    return copied.groupBy("range", "copy").cogroup(dealt.groupBy("range", "copy")).applyInArrow(
        compose, "lang string, phrase string, a long, k int, half int, f long")


def _numbered(phrases: list[str], numbers: dict[bytes, int]) -> np.ndarray:
    out = np.zeros((len(phrases), DEPTH), np.int64)
    for k, phrase in enumerate(phrases):
        for j, word in enumerate(phrase.encode().split(b" ")):
            out[k, j] = numbers.get(word, -1)
    return out


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, covered: int = COVERED, shard_words: int = SHARD_WORDS,
                 range_bytes: int = RANGE_BYTES, part_rows: int = PART_ROWS, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of every language.

    a is the phrase's count, l and r those of its parts at the cut with the least score (ties: the earliest), n the number
    of words of the language, score floor(SCALE * a / (l + r)). Phrases that lie in a longer candidate with at
    least ``covered`` per cent of their occurrences are left out. Order: score, a, phrase.
    """
    counts, rows = materialize_counted(
        phrase_counts(docs, min_count, shard_words, range_bytes, text_col=text_col, lang_col=lang_col), "phrase-counts")
    words = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    candidates = counts.where("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a"))
    spelled = candidates.withColumn("w", F.split("phrase", " "))
    halves = "array(struct(k, 0 AS half, array_join(slice(w, 1, k), ' ') AS part), struct(k, 1 AS half, array_join(slice(w, k + 1, size - k), ' ') AS part))"
    questions = spelled.select("lang", "phrase", "a", F.explode(F.expr(
        f"flatten(transform(sequence(1, size - 1), k -> {halves}))")).alias("q")).select("lang", "phrase", "a", "q.k", "q.half", "q.part")
    answers = _composed(counts.where("size >= 1"), rows, questions, part_rows)
    cut = answers.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("half") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("half") == 1, F.col("f"))).alias("r"))
    score = F.expr(f"CAST({SCALE} AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(19, 0)) DIV CAST(l + r AS DECIMAL(19, 0))").cast("long")
    least = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    inner = "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), p -> array_join(slice(w, p, m), ' '))))"
    longer = spelled.where("size > 2").select("lang", F.explode(F.expr(inner)).alias("phrase"), F.col("a").alias("longer"))
    over = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = least.join(over, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * covered))
    by_score = [F.desc("x.score"), F.desc("a"), "phrase"]
    # First among some dealings of each language, so that the last step meets at most _DEALT * top rows.
    dealt = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_DEALT))).orderBy(*by_score)
    some = kept.withColumn("rank", F.row_number().over(dealt)).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by_score)).cast("long")).where(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "x.l", "x.r", "n", "x.score")
